"""Traces of the scanned page in text, and continuous paragraphs without them.

The lines of a text are a sequence with three states: *body*, *header* (a running title of the manual,
alone or beside a page number) and *break* (the number of a page alone). A hidden Markov model over layout
features labels them: the form of the line (number forms, capitals, words of the manual's name, program
text), its place, whether it stands among program text, and whether the other witness of the region has it.
Paragraphs are put together from the body lines: lines broken at a hyphen or its like are joined, prose is
reflowed, program text keeps its lines, misrecognised words are set right.

Both the model and the word list come from all regions that have a second witness, the
source text: a line that the witness lacks is labelled by its form. A word counts as misrecognised if it
is unknown, and one or two known confusions turn it into a word of the witness or, where there is no
witness, of the word list; alike-looking characters are folded first and do not count.

Defined results: null and empty texts hold no defects; an empty text has an empty one as its paragraphs and a
null text has none; repeated rows give one row per defect; extra columns
are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame
from folia.llm.leakage import ACCENTS
from folia.llm.leakage import words as witness_words
from folia.llm.lookalike import skeleton

#: A word of the list must stand in so many source texts, and in that share of them: what marks and look-alikes
#: leave of words grows with the table.
KNOWN_TEXTS, KNOWN_SHARE = 3, 3 / 8_000
#: Distinct words that a task holds before it sends their counts on.
HELD_WORDS = 500_000
STATES = ("body", "header", "break")

#: Confusions of character recognition (fixed values): what stands there, what it was.
CONFUSED = (
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("0", "o"), ("o", "0"), ("@", "a"), ("l", "i"), ("i", "l"), ("1", "l"), ("l", "1"), ("1", "i"), ("i", "1"), ("5", "s"), ("s", "5"), ("6", "b"), ("b", "6"),
    ("8", "b"), ("b", "8"), ("9", "g"), ("g", "9"), ("ri", "n"), ("ii", "u"), ("b", "h"), ("h", "b"), ("rn", "m"), ("m", "rn"), ("v", "y"), ("y", "v"), ("q", "g"), ("g", "q"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"),
    ("u", "n"), ("n", "u"), ("iii", "m"), ("in", "m"), ("ni", "m"), ("li", "h"), ("lc", "k"), ("tl", "d"), ("|", "l"), ("!", "l"), ("$", "s"), ("2", "z"), ("z", "2"), ("0", "d"), ("4", "a"), ("3", "e"), ("7", "t"),
)

_NUMBER = {
    "digits": re.compile(r"\d{1,4}"),
    "bracket": re.compile(r"[\[({<]\s?\d{1,4}\s?[\])}>]"),
    "named": re.compile(r"(?:p\.|pp\.|pg\.?|page|seite|s\.|pág\.|página|pagina)\s?\d{1,4}", re.I),
    "of": re.compile(r"\d{1,4}\s?(?:of|/|von|de|sur)\s?\d{1,4}", re.I),
    "roman": re.compile(r"(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I),
    "chapter": re.compile(r"(?:\d{1,2}|[A-Z])[-–.]\d{1,3}"),
    "dashes": re.compile(r"[-–—~*·.]{1,3}\s?\d{1,4}\s?[-–—~*·.]{1,3}"),
}
_BESIDE = re.compile(r"^(?P<a>\d{1,4}|\[\d{1,4}\]|[ivxlc]{1,7}|\d{1,2}-\d{1,3})(?:\s{2,}|\s*\.{2,}\s*|\t|\s[|·•—-]\s)(?P<t>\D.*)$|^(?P<u>.*\D)(?:\s{2,}|\s*\.{2,}\s*|\t|\s[|·•—-]\s)(?P<b>\d{1,4}|\[\d{1,4}\]|[ivxlc]{1,7}|\d{1,2}-\d{1,3})$")
_NUMBER_START, _NUMBER_END = frozenset("0123456789[ivxlcIVXLC"), frozenset("0123456789]ivxlcIVXLC")
_SPACED = re.compile(r"^(?:\S ){3,}\S(?: {2,}|$)")
_CODE = re.compile(r"^\s*(?:[(;`'#|]|\d+>|\$ )|\)\s*$|\(\w+[ *-]")
_BROKEN = re.compile(r"[\w*][-\u00ad¬\u2010\u2011\u2012–⁃][ \t]*$")
_GOES_ON = re.compile(r"[ \t]*[\w*&]")
_TOKEN = re.compile(r"[^\W_]+(?:[@|!$]+[^\W_]+)*|[@$][^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def _title_words(document_id: str | None) -> frozenset[str]:
    return frozenset(w for w in _LETTERS.findall((document_id or "").lower()) if len(w) > 1)


def _title(line: str, manual: frozenset[str]) -> str | None:
    """How a line without its page number looks like a running title; None if it does not."""
    if _SPACED.match(line):
        letters = "".join(line.split())
        return "spaced" if letters.isalpha() else None
    found = _LETTERS.findall(line)
    if not 1 <= len(found) <= 12 or line[-1] in ".;,)" or line[0] in "(;'`":
        return None
    own = [w.lower() in manual for w in found]
    head, colon, _ = line.partition(":")
    if colon and manual and all(w.lower() in manual for w in _LETTERS.findall(head)) and _LETTERS.findall(head):
        return "product"
    if len(found) > 1 and sum(own) >= 0.6 * len(found) and found[0][0].isupper():
        return "manual"
    if len(found) > 2 and line.istitle() and all(w.isalpha() for w in line.split()):
        return "capitalized"
    if len(found) > 2 and line.isupper() and "-" not in line and "*" not in line:
        return "capitals"
    return None


def line_form(line: str, manual: frozenset[str]) -> str:
    """The form of a line: a number form, a title form (``+`` with a number beside it), code, blank or text."""
    s = line.strip()
    if not s:
        return "blank"
    if len(s) <= 24:  # no number form is longer
        for name, form in _NUMBER.items():
            if form.fullmatch(s):
                return name
    # Titles start with a capital or a number, name the manual before a colon, or end with a number.
    if (not s[0].islower() or s[-1] in _NUMBER_END or ":" in s):
        m = _BESIDE.match(s) if s[-1] in _NUMBER_END or s[0] in _NUMBER_START else None
        if m:
            t = _title((m["t"] or m["u"]).strip(" ."), manual)
            if t:
                return t + "+"
        t = _title(s, manual)
        if t:
            return t
    return "code" if _CODE.search(line) else "text"


_PLAIN = frozenset(("text", "code", "blank"))
#: Words up to which a plain line counts as short; shares of its words in the witness that count as none and as some.
SHORT_WORDS, NONE, SOME = 8, 0.25, 0.7


@dataclass
class Model:
    """Log-probabilities of the line labels, and the word list."""

    start: list[float]
    steps: list[list[float]]
    symbols: dict[tuple, list[float]]
    forms: dict[str, list[float]]
    lexicon: frozenset[str]
    paths: dict[tuple, tuple[int, ...]] = field(default_factory=dict)
    fixes: dict[str, str | None] = field(default_factory=dict)

    def labels(self, symbols: tuple[tuple, ...]) -> tuple[int, ...]:
        """The most likely states of a text's lines (Viterbi)."""
        got = self.paths.get(symbols)
        if got is None:
            score = [a + b for a, b in zip(self.start, self._emit(symbols[0]))]
            back = []
            for s in symbols[1:]:
                best = [max(range(3), key=lambda i, j=j: score[i] + self.steps[i][j]) for j in range(3)]
                score = [score[b] + self.steps[b][j] + e for j, (b, e) in enumerate(zip(best, self._emit(s)))]
                back.append(best)
            at = max(range(3), key=score.__getitem__)
            path = [at]
            for best in reversed(back):
                at = best[at]
                path.append(at)
            got = tuple(reversed(path))
            if len(self.paths) < 200_000:
                self.paths[symbols] = got
        return got

    def _emit(self, symbol: tuple) -> list[float]:
        got = self.symbols.get(symbol)
        # What the witness has is not the page's own, whatever the form says.
        return got or (None if symbol[-1] in ("in", "some", "most") else self.forms.get(symbol[0])) or [0.0, -6.0, -6.0]

    def fix(self, word: str, among: set[str] | frozenset[str]) -> str | None:
        """The word of ``among`` that one or two confusions turned into ``word``."""
        return _fix(word, among)

    def listed_fix(self, word: str) -> str | None:
        if word not in self.fixes:
            if len(self.fixes) > 200_000:
                return self.fix(word, self.lexicon)
            self.fixes[word] = self.fix(word, self.lexicon)
        return self.fixes[word]


def _unconfused(word: str) -> Iterator[str]:
    for seen, was in CONFUSED:
        at = word.find(seen)
        while at >= 0:
            yield word[:at] + was + word[at + len(seen) :]
            at = word.find(seen, at + 1)


def _fix(word: str, among: set[str] | frozenset[str]) -> str | None:
    once = {v for v in _unconfused(word)}
    hit = once & among
    if not hit and len(word) > 4:
        hit = {v for o in once for v in _unconfused(o)} & among
    hit.discard(word)
    return min(hit) if hit else None


class Witness:
    """What the source text of a region says about its lines and words; taken apart when first asked."""

    def __init__(self, source: str | None) -> None:
        self.source = source or ""
        self.there = bool(source)
        self._tokens: list[str] | None = None
        self._words: set[str] | None = None
        self._all_words: set[str] | None = None
        self._folded: str | None = None

    @property
    def tokens(self) -> list[str]:
        if self._tokens is None:
            self._tokens = witness_words(self.source)
        return self._tokens

    @property
    def folded(self) -> str:
        """The source without line breaks, case and accents."""
        if self._folded is None:
            self._folded = _plain(skeleton(self.source).casefold())
        return self._folded

    @property
    def words(self) -> set[str]:
        if self._words is None:
            self._words = set(self.tokens)
        return self._words

    @property
    def all_words(self) -> set[str]:
        """The words with marks taken out, and as they stand."""
        if self._all_words is None:
            self._all_words = self.words | set(_TOKEN.findall(_plain(self.source.casefold())))
        return self._all_words

    def share(self, line: str) -> str:
        """How many of a line's words the witness has: none, some or most of them."""
        if not self.there:
            return "?"
        if line.strip() in self.source:  # as it stands; the words are taken apart for the others only
            return "most"
        found = _TOKEN.findall(line.lower() if line.isascii() else _plain(skeleton(line).casefold()))
        there = sum(w in self.words for w in found)
        if there <= NONE * len(found):  # a line of misread words is the witness's too
            there = sum(w in self.all_words or _fix(w, self.all_words) is not None for w in found)
        return "none" if there <= NONE * len(found) else "some" if there <= SOME * len(found) else "most"

    def has_line(self, line: str, form: str) -> str:
        if not self.there:
            return "?"
        if form in _NUMBER:
            return "in" if line.strip() in {x.strip() for x in self.source.split("\n")} else "out"
        return "in" if f" {' '.join(witness_words(line))} " in f" {' '.join(self.tokens)} " else "out"


def _symbols(lines: list[str], manual: frozenset[str], witness: Witness | None) -> tuple[tuple, ...]:
    """Layout features of every line: its form, its place, what it looks like or stands among, what the witness has of it.

    Plain lines inside a text have their form alone.
    """
    forms = [line_form(x, manual) for x in lines]
    last = len(forms) - 1
    out = []
    for i, f in enumerate(forms):
        place = "only" if not last else "first" if not i else "last" if i == last else "inner"
        if f == "blank" or f in _PLAIN and place == "inner":
            out.append((f,))
        elif f in _PLAIN:
            shape = _shape(lines[i], lines[i - 1] if i else "")
            # What is long is no title whatever the witness has, so it is not looked up.
            out.append((f, place, shape) if shape == "long" else (f, place, shape, witness.share(lines[i]) if witness else "?"))
        else:
            near = {forms[j] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j <= last}
            out.append((f, place, "code" if "code" in near else "text", witness.has_line(lines[i], f) if witness else "?"))
    return tuple(out)


def _shape(line: str, before: str) -> str:
    """Length, capitals, indentation and end of a plain line; whether it goes on with a word of the line before."""
    if _BROKEN.search(before):
        return "goes-on"
    if line.count(" ") > 2 * SHORT_WORDS:
        return "long"
    found = _LETTERS.findall(line)
    if len(found) < 3:
        return "single"
    if len(found) > SHORT_WORDS:
        return "long"
    capitals = sum(w[0].isupper() for w in found) > 0.6 * len(found)
    return "short" + "-capitals" * capitals + "-indented" * line[:1].isspace() + "-end" * (line.rstrip()[-1:] in ".!?:;,")


def _label(s: tuple) -> int:
    """The state of a line to fit on, from its form and what the witness has of it."""
    if len(s) < 4 or s[3] in ("in", "some", "most"):
        return 0
    if s[0] in _PLAIN:
        # A short line at an edge of which the witness has nothing.
        return 1 if s[0] == "text" and s[3] == "none" and s[1] != "only" and s[2].startswith("short") else 0
    return 2 if s[0] in _NUMBER else 1


def _count(rows: Iterable[tuple[str | None, str, str]], counts: Counter, words: Counter) -> None:
    """Add what (document_id, source_text, ocr_text) rows hold: (part, key, state) of their lines, and their words."""
    manuals: dict[str | None, frozenset[str]] = {}
    for manual_id, source, ocr in rows:
        witness = Witness(source)
        words.update(witness.all_words)
        manual = manuals.get(manual_id)
        if manual is None:
            manual = manuals[manual_id] = _title_words(manual_id)
        lines = ocr.split("\n")
        seen = _symbols(lines, manual, witness)
        states = [_label(s) for s in seen]
        counts["start", "", states[0]] += 1
        for a, b in zip(states, states[1:]):
            counts["step", str(a), b] += 1
        for s, state in zip(seen, states):
            # The witness is missing elsewhere: the same line counts once with it and once without.
            for t in {s, s[:3] + ("?",)} if len(s) > 3 else {s}:
                counts["line", " ".join(t), state] += 1
            counts["form", s[0], state] += 1


def _model(counts: Iterable[tuple[str, str, int, int]], lexicon: frozenset[str]) -> Model:
    """The model of (part, key, state, n) counts."""
    start, steps = [1.0] * 3, [[1.0] * 3 for _ in range(3)]
    symbols: dict[tuple, Counter] = {}
    forms: dict[str, Counter] = {}
    totals: Counter = Counter()
    for part, key, state, n in counts:
        if part == "start":
            start[state] += n
        elif part == "step":
            steps[int(key)][state] += n
        elif part == "line":
            symbols.setdefault(tuple(key.split(" ")), Counter())[state] += n
        else:
            forms.setdefault(key, Counter())[state] += n
            totals[state] += n
    log = lambda c, weight: [math.log((c[i] + weight) / (totals[i] + 3.0)) for i in range(3)]
    norm = lambda v: [math.log(x / sum(v)) for x in v]
    return Model(norm(start), [norm(s) for s in steps], {s: log(c, 0.01) for s, c in symbols.items()}, {f: log(c, 0.01) for f, c in forms.items()}, lexicon)


def _least_texts(texts: int) -> float:
    """How many of so many texts a word of the list must stand in."""
    return max(KNOWN_TEXTS, KNOWN_SHARE * texts)


def fit(rows: Iterable[tuple[str | None, str, str]]) -> Model:
    """The model of (document_id, source_text, ocr_text) rows."""
    counts: Counter = Counter()
    words: Counter = Counter()
    _count(rows, counts, words)
    least = _least_texts(sum(n for k, n in counts.items() if k[0] == "start"))
    return _model(((*k, n) for k, n in counts.items()), frozenset(w for w, n in words.items() if n >= least and not w.isdigit()))


@dataclass
class Reading:
    """A text's lines with their states, and the defects it holds."""

    lines: list[str]
    states: tuple[int, ...]
    symbols: tuple[tuple, ...]
    defects: set[str]
    fixes: dict[str, str]
    witness: Witness
    lexicon: frozenset[str]


def read(text: str, manual: frozenset[str], witness: Witness, model: Model) -> Reading:
    """Label a text and find its defects."""
    lines = text.split("\n")
    defects: set[str] = set()
    symbols = _symbols(lines, manual, witness)
    states = model.labels(symbols)
    for s, state in zip(symbols, states):
        if state == 1:
            defects.add("running-header")
            if s[0].endswith("+"):
                defects.add("page-number")
        elif state == 2:
            defects.add("page-number")
    joined, broken = _joined([line for line, _ in _body(lines, symbols, states)])
    if broken:
        defects.add("hyphenation")
    fixes = _misread(joined, witness, model)
    if fixes:
        defects.add("misread")
    return Reading(lines, states, symbols, defects, fixes, witness, model.lexicon)


def _body(lines: list[str], symbols: tuple[tuple, ...], states: tuple[int, ...]) -> list[tuple[str, str]]:
    """(line, form) of the body; blank lines about a line of the page's own go with it where a sentence goes on."""
    out: list[tuple[str, str]] = []
    cut = False
    for line, s, state in zip(lines, symbols, states):
        if state:
            cut = True
            continue
        if cut and s[0] != "blank":
            k = len(out)
            while k and out[k - 1][1] == "blank":
                k -= 1
            if k and out[k - 1][0].rstrip()[-1:] not in (*".!?:;)", ""):
                del out[k:]
            cut = False
        out.append((line, s[0]))
    return out


_MARK = "\x00"


def _joined(body: list[str]) -> tuple[str, bool]:
    """Body lines as one text; breaks at hyphens become a mark between the parts."""
    out: list[str] = []
    broken = False
    for i, line in enumerate(body):
        if i and _BROKEN.search(out[-1]) and _GOES_ON.match(line):
            out[-1] = out[-1].rstrip(" \t") + _MARK + line.lstrip(" \t")
            broken = True
        else:
            out.append(line)
    return "\n".join(out), broken


_PARTS = re.compile(r"([^\W_]+)[-¬\u2010\u2011\u2012–⁃]?\x00([^\W_]+)")


def _plain(token: str) -> str:
    """A token in the witness's form, without accents."""
    if token.isascii():
        return token
    return ACCENTS.sub("", unicodedata.normalize("NFKD", token))


def _misread(text: str, witness: Witness, model: Model) -> dict[str, str]:
    """Misrecognised words of a text and what they were."""
    folded = text.lower() if text.isascii() else _plain(skeleton(text).casefold())
    known = model.lexicon
    out: dict[str, str] = {}

    def seen(t: str) -> bool:
        return t in known or t.isdigit() or len(t) < 2 or t in witness.words

    def was(t: str) -> str | None:
        return (model.fix(t, witness.words) if witness.there else None) or model.listed_fix(t)

    if _MARK in folded:
        # A broken word is one word if that is known or explained, else a symbol broken at its own hyphen.
        for a, b in set(_PARTS.findall(folded)):
            if seen(a + b):
                continue
            w = was(a + b)
            if w:
                out[a + b] = w
                continue
            halves = {h: None if seen(h) else was(h) for h in (a, b)}
            if all(v or seen(h) for h, v in halves.items()):
                out.update({h: v for h, v in halves.items() if v})
        folded = _PARTS.sub(" ", folded)
    for t in set(_TOKEN.findall(folded)) - known:
        if not seen(t):
            w = was(t)
            if w:
                out[t] = w
    return out


_LAST, _FIRST = re.compile(r"[\w*-]+$"), re.compile(r"[\w*&-]+")


def _own_hyphen(head: str, line: str, r: Reading) -> bool:
    """Whether the hyphen at a line's end belongs to the word: as the witness has it, else by the words known."""
    a, b = _LAST.search(head[:-1]), _FIRST.match(line.lstrip(" \t"))
    if a is None or b is None:
        return False
    left, right = (_plain(skeleton(x.group()).casefold()) for x in (a, b))
    if r.witness.there:
        source = r.witness.folded
        with_, without = f"{left}-{right}", left + right
        if (with_ in source) != (without in source):
            return with_ in source
        if without not in source and (f"{left}-" in source or f"-{right}" in source):
            return True
    one = left.rsplit("-", 1)[-1] + right.split("-", 1)[0]
    if one in r.lexicon or one in r.witness.words:
        return False
    return head[-1] in "-\u2010\u2011" and ("-" in left or left in r.lexicon and right.split("-", 1)[0] in r.lexicon)


def repaired(text: str, r: Reading) -> str:
    """Continuous paragraphs: body lines only, broken words joined, prose reflowed, misread words set right."""
    kept = _body(r.lines, r.symbols, r.states)
    out: list[str] = []
    before = "blank"
    # A line is full if it reaches near the width that the text's prose was set to.
    full = 0.6 * max((len(x.rstrip()) for x, form in kept if form == "text"), default=0)
    for line, form in kept:
        if out and form != "blank" and _BROKEN.search(out[-1]) and _GOES_ON.match(line):
            head = out[-1].rstrip(" \t")
            out[-1] = (head if _own_hyphen(head, line, r) else head[:-1]) + line.lstrip(" \t")
        elif out and before == "text" and form == "text" and not re.match(r"\s*(?:\(?\w{1,2}[.)]|[-*•]) ", line) and len(out[-1].rsplit("\n", 1)[-1]) >= full:
            out[-1] = out[-1].rstrip() + " " + line.lstrip()
        else:
            out.append(line)
        before = form
    whole = "\n".join(out)
    for bad, good in r.fixes.items():
        whole = re.sub(rf"(?<![^\W_]){re.escape(bad)}(?![^\W_])", good, whole, flags=re.I)
    return whole


def fitted(df: DataFrame) -> Model:
    """The model of all regions with both witnesses: that of :func:`fit`, counted by the tasks.

    What is sent to the driver are the kinds of lines and the word list; it grows with the vocabulary.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        words: Counter = Counter()
        names = ["part", "key", "state", "n"]
        for pdf in batches:
            _count(zip(pdf["document_id"], pdf["source_text"], pdf["ocr_text"]), counts, words)
            if len(words) > HELD_WORDS:
                yield frame((("word", w, 0, n) for w, n in words.items()), names)
                words.clear()
        yield frame([*((*k, n) for k, n in counts.items()), *(("word", w, 0, n) for w, n in words.items())], names)

    both = df.select("document_id", "source_text", "ocr_text").where("source_text is not null and ocr_text is not null")
    counted = both.mapInPandas(run, "part string, key string, state int, n long").groupBy("part", "key", "state").agg(F.sum("n").alias("n"))
    rows = counted.where((F.col("part") != "word") | (F.col("n") >= _least_texts(both.count()))).toPandas()
    of_words = rows["part"] == "word"
    lexicon = frozenset(w for w in rows["key"][of_words] if not w.isdigit())
    return _model(rows[~of_words].itertuples(index=False, name=None), lexicon)


def _over(df: DataFrame, make, schema: str) -> DataFrame:
    """Rows of ``make(id, field, text, reading)`` for every text that is not null; an empty text has no reading."""
    model = fitted(df)
    shared = df.sparkSession.sparkContext.broadcast((model.start, model.steps, model.symbols, model.forms, model.lexicon))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        manuals: dict[str | None, frozenset[str]] = {}
        names = [x.split()[0] for x in schema.split(", ")]
        for pdf in batches:
            rows: list[tuple] = []
            for key, manual_id, source, ocr, canonical in zip(pdf["id"], pdf["document_id"], pdf["source_text"], pdf["ocr_text"], pdf["canonical_text"]):
                manual = manuals.get(manual_id)
                if manual is None:
                    manual = manuals[manual_id] = _title_words(manual_id)
                witness = Witness(source)
                first = None
                for name, text in (("ocr_text", ocr), ("canonical_text", canonical)):
                    if text is None:
                        continue
                    r = None if not text else first if name == "canonical_text" and text == ocr else read(text, manual, witness, own)
                    first = r
                    rows += make(key, name, text, r)
            yield frame(rows, names)

    return df.select("id", "document_id", "source_text", "ocr_text", "canonical_text").mapInPandas(run, schema)


def defects(df: DataFrame) -> DataFrame:
    """(id, text_field, defect) of every kind of defect that a region's text holds."""
    return _over(df, lambda key, name, text, r: [(key, name, d) for d in (r.defects if r else ())], "id string, text_field string, defect string").distinct()


def paragraphs(df: DataFrame) -> DataFrame:
    """(id, text_field, repaired_text, had_defects) of every text that is not null; clean prose is reflowed too."""
    make = lambda key, name, text, r: [(key, name, repaired(text, r) if r else text, bool(r and r.defects))]
    return _over(df, make, "id string, text_field string, repaired_text string, had_defects boolean").distinct()
