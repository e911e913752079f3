"""One consistent form for text that looks the same in different characters.

Three steps. Compatibility normalization folds widths, ligatures, composed accents and kinds of blank and
hyphen, and deletes ignorable signs; raised and lowered signs, fractions and line breaks keep their look
and are kept. Every letter or sign is then replaced by the representative of its look-alike class, which
makes the *lattice* of a word: each place allows all members of its class. A Viterbi search over that
lattice finds the members that go together best, by character bigrams of the corpus and a price for
every change of script inside a word, so a Russian word comes out in Cyrillic and an English one in Latin.

Signs of a class are drawn alike everywhere, so their lattice depends on the class alone, and texts that
differ in nothing else have the same form. Signs that are only nearly drawn like a letter keep their own
place in the lattice beside the letter: the search reads them as the letter where script and neighbours make
that the better word (an Armenian sign inside a Latin word), and leaves them where they are at home.

Defined results: null stays null, empty stays empty; repeated rows give one row each in ``normalized``
and one row per id in ``same_look``; a tie goes to the first member in class order; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame

#: Log-price of a change of script between two letters of a word, and the count that an unseen pair is given.
SCRIPT_CHANGE, UNSEEN_PAIR = -7.0, 0.5
#: The least share of the words that an unseen pair's count is: two of them in a row must not cost more than two
#: changes of script, however many words were counted.
UNSEEN_SHARE = 1e-7
#: Distinct words that a task holds before it sends their pairs on.
HELD_WORDS = 200_000

#: Look-alike classes (fixed values): the representative, then signs that are drawn like it.
CLASSES = """
a а
c с ϲ
d ԁ
e е
g ɡ
h һ
i і
j ј ϳ
l ӏ
o о ο օ
p р ρ
q ԛ
s ѕ
u ս
v ν ѵ
w ԝ
x х
y у
A А Α
B В Β
C С Ϲ
E Е Ε
H Н Η
I І Ι Ӏ
J Ј
K К Κ
M М Μ
N Ν
O О Ο
P Р Ρ
Q Ԛ
S Ѕ
T Т Τ
W Ԝ
X Х Χ
Y У Υ Ү
Z Ζ
æ ӕ
Æ Ӕ
, ‚
; ;
: ∶ ꞉
/ ∕ ⁄
* ∗
~ ∼
| ∣ ǀ
’ ʼ
· ∙ ‧ ⋅
- ‐ ‑ ‒ ⁃ −
"""

#: Signs of scripts that are drawn nearly like a letter: it, then what it may stand for (fixed values).
NEARLY = """
ո n
ց g
հ h
օ o
յ j
ѡ w
ⲟ o
ⲣ p
ⲥ c
Ⲁ A
Ⲃ B
Ⲏ H
Ⲓ I
Ⲕ K
Ⲙ M
Ⲛ N
Ⲟ O
Ⲣ P
Ⲥ C
Ⲧ T
Ⲭ X
Ꭰ D
Ꭱ R
Ꭲ T
Ꭺ A
Ꭻ J
Ꭼ E
Ꮃ W
Ꮇ M
Ꮋ H
Ꮐ G
Ꮓ Z
Ꮪ S
Ꮮ L
Ꮯ C
Ꮲ P
Ꮶ K
Ꮩ V
"""
#: Log-price of reading such a sign as the letter; the letters around it decide whether that is worth it.
REREAD = -3.0

#: Decompositions that change the look of a sign (fixed values).
RAISED = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<vertical>")
#: Signs without a look of their own beside the format category (fixed values).
BLANK_SIGNS = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"

REPRESENTATIVE = {ord(x): line[0] for line in CLASSES.split("\n") if line for x in line.split(" ")[1:]}
MEMBERS = {line[0]: tuple(line.split(" ")) for line in CLASSES.split("\n") if line}
NEAR = {line[0]: tuple(line.split(" ")[1:]) for line in NEARLY.split("\n") if line}
#: Signs that a search can choose between.
CHOSEN = frozenset(x for c in MEMBERS for x in MEMBERS[c]).union(NEAR, *NEAR.values())


class _Fold(dict):
    """Translation of one decomposed sign; filled when a sign is first met."""

    def __missing__(self, code: int) -> str | None:
        self[code] = out = self._fold(chr(code), code)
        return out

    @staticmethod
    def _fold(c: str, code: int) -> str | None:
        if code in REPRESENTATIVE:
            return REPRESENTATIVE[code]
        if c == "\t":
            return " "
        if code < 0x80:
            return c
        if unicodedata.category(c) == "Cf" or c in BLANK_SIGNS or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            return None
        if unicodedata.category(c) == "Zs":
            return " "
        if c in "  \u0085":
            return "\n"
        tag = unicodedata.decomposition(c)
        if tag.startswith("<") and not tag.startswith(RAISED) and c != "ſ":
            wide = unicodedata.normalize("NFKD", c)
            if wide[0] != " ":
                return "".join(REPRESENTATIVE.get(ord(x), x) for x in wide)
        return c


FOLD = _Fold()


def skeleton(text: str) -> str:
    """The text with every sign replaced by the representative of its look."""
    if text.isascii() and "\t" not in text and "\r" not in text:
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text.replace("\r\n", "\n")).translate(FOLD))


def _script(c: str) -> str:
    if not c.isalpha():
        return ""
    return "L" if c < "Ͱ" else "G" if c < "Ѐ" else "C" if c < "԰" else "A" if c < "\u0590" else "K" if "Ⲁ" <= c <= "\u2cff" else "Ch" if "Ꭰ" <= c <= "\u13ff" else "o"


WORD = re.compile(r"[^\W\d_]+")


class Speller:
    """Viterbi search over the look-alike lattice of a word."""

    def __init__(self, pairs: dict[tuple[str, str], int]) -> None:
        self.pairs = pairs
        self.before: Counter = Counter()
        for (x, _), n in pairs.items():
            self.before[x] += n
        self.unseen = max(UNSEEN_PAIR, UNSEEN_SHARE * self.before[""])
        self.known: dict[str, str] = {}

    def _step(self, x: str, y: str) -> float:
        change = SCRIPT_CHANGE if x and _script(x) and _script(y) and _script(x) != _script(y) else 0.0
        return change + math.log((self.pairs.get((x, y), 0) + self.unseen) / (self.before[x] + 400.0 * self.unseen))

    def word(self, skeleton_word: str) -> str:
        """The best members of the classes of a skeleton's word."""
        got = self.known.get(skeleton_word)
        if got is None:
            paths = {"": (0.0, "")}
            for c in skeleton_word:
                step = {}
                for y in (*MEMBERS.get(c, (c,)), *(m for r in NEAR.get(c, ()) for m in MEMBERS.get(r, (r,)))):
                    price = REREAD if c in NEAR and y != c else 0.0
                    step[y] = max(((s + self._step(x, y) + price, p + y) for x, (s, p) in paths.items()), key=lambda b: b[0])
                paths = step
            got = max(paths.values(), key=lambda b: b[0])[1]
            if len(self.known) < 100_000:
                self.known[skeleton_word] = got
        return got

    def form(self, text: str) -> str:
        """The one form of a text."""
        return WORD.sub(lambda m: self.word(m.group()), skeleton(text))


def _pairs(words: Counter) -> Counter:
    """Character pairs inside words of one script."""
    pairs: Counter = Counter()
    for word, n in words.items():
        if len({_script(c) for c in word}) == 1:
            for x, y in zip(("", *word), word):
                pairs[x, y] += n
    return pairs


def _words(text: str) -> list[str]:
    return WORD.findall(text if text.isascii() else unicodedata.normalize("NFC", text))


def fit(texts: Iterable[str]) -> dict[tuple[str, str], int]:
    """Character pairs inside words of one script."""
    return dict(_pairs(Counter(w for t in texts for w in _words(t))))


def speller_pairs(df: DataFrame, text_cols: list[str]) -> dict[tuple[str, str], int]:
    """Bigrams of all rows, those between two signs without a choice left out.

    Such a pair costs every path through a word the same, so the best one does not depend on it. What is sent to
    the driver grows with the alphabets, not with the table.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        for pdf in batches:
            for c in text_cols:
                for t in pdf[c]:
                    if t:
                        words.update(_words(t))
            if len(words) > HELD_WORDS:
                pairs.update(_pairs(words))
                words.clear()
        pairs.update(_pairs(words))
        yield frame(((x, y, n) for (x, y), n in pairs.items() if not x or x in CHOSEN or y in CHOSEN), ["x", "y", "n"])

    counted = df.select(*text_cols).mapInPandas(run, "x string, y string, n long")
    return {(r.x, r.y): r.n for r in counted.groupBy("x", "y").agg(F.sum("n").alias("n")).collect()}


def normalized(df: DataFrame, *, id_col: str, text_cols: list[str]) -> DataFrame:
    """``id_col`` and the one form of each text column."""
    pairs = df.sparkSession.sparkContext.broadcast(speller_pairs(df, text_cols))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spell = Speller(pairs.value)
        for pdf in batches:
            yield frame(zip(pdf[id_col], *([spell.form(t) if t is not None else None for t in pdf[c]] for c in text_cols)), [id_col, *text_cols])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, *text_cols).mapInPandas(run, ", ".join([f"`{id_col}` {kind}", *(f"`{c}` string" for c in text_cols)]))


def same_look(df: DataFrame, *, id_col: str = "id", left: str = "source_text", right: str = "ocr_text") -> DataFrame:
    """Ids of rows whose two texts are unequal but look the same.

    Two texts look the same if the best readings of their lattices are equal.

    Unequal texts of plain ASCII without tabs and carriage returns differ in look, whatever the search says:
    no class holds two of those signs. Such rows are settled in the scan.
    """
    pairs = df.sparkSession.sparkContext.broadcast(speller_pairs(df, [left]))
    odd = r"[^\x00-\x08\x0a-\x0c\x0e-\x7f]"
    rows = df.select(id_col, left, right).where((F.col(left) != F.col(right)) & (F.col(left).rlike(odd) | F.col(right).rlike(odd)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spell = Speller(pairs.value)
        for pdf in batches:
            yield frame([(k,) for k, a, b in zip(pdf[id_col], pdf[left], pdf[right]) if spell.form(a) == spell.form(b)], [id_col])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"`{id_col}` {kind}").distinct()
