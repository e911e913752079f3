"""Text decoded with a wrong character encoding: detection and restoration by a hidden Markov model.

One clean state and one state per pair (encoding of the text, encoding it was read in) label the
characters beyond ASCII and the signs that follow them. Emissions are conditional on the sign before;
those of a pair come from clean text of the corpus itself that is encoded and misread by the pair, so
no labelled data are needed. The clean text is found by the model too: fitted on all documents without
evident faults, it labels all documents, and is fitted again on those that it finds clean. The tasks take
documents apart and count; the driver gets the counts of neighbouring signs.

Observations are looked up for a block of documents at once. A visit of a state must gain more than entering
and leaving it cost, so a document is searched only if some stretch of it can pay that price, and only
over the states that can; these are bounds, not filters, and leave the labels unchanged. The prices are
estimated from the labels of all documents.

Each labelled span gets its state's inverse: it is encoded as it was read and decoded as it was
written. Spans whose bytes were lost (U+FFFD) are reported but kept.

Defined results: null and empty texts are clean; repeated ids give one row each; extra columns are left
out of the result.
"""

from __future__ import annotations

import codecs
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame

#: Documents that a sign must stand in to count as known.
KNOWN_DOCS = 5
#: Natural log of the probability of entering any one pair's state, of staying in it and of leaving it, at first.
ENTER, STAY, LEAVE = -11.0, -0.02, -4.0
#: Weight of the unconditional distribution, and of an unseen sign.
BACKOFF, UNSEEN, SIGNS = 2.0, 0.5, 20_000

#: Characters of the documents that are looked up together.
BLOCK_CHARS = 400_000
#: Distinct runs that a task holds before it sends their counts on, and rows of a model that are computed together.
HELD_RUNS, BLOCK_ROWS = 100_000, 1 << 15

#: (written in, read in), fixed values; a pair with three names was misread twice.
PAIRS = (
    ("utf-8", "latin-1"), ("utf-8", "cp1252"), ("utf-8", "iso8859-15"), ("utf-8", "cp1250"), ("utf-8", "cp1254"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp850"),
    ("utf-8", "cp1251"), ("utf-8", "koi8-r"), ("utf-8", "cp866"), ("utf-8", "cp932"), ("utf-8", "gbk"), ("utf-8", "ascii"),
    ("utf-8", "latin-1", "latin-1"), ("utf-8", "cp1252", "cp1252"), ("utf-8", "cp1252", "latin-1"), ("utf-8", "latin-1", "cp1252"),
    ("cp1252", "utf-8"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "cp1250"), ("cp1252", "latin-1"),
    ("mac_roman", "cp1252"), ("mac_roman", "latin-1"), ("mac_roman", "utf-8"), ("cp850", "cp1252"), ("cp850", "latin-1"), ("cp437", "cp1252"), ("cp437", "latin-1"), ("cp850", "utf-8"),
    ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("cp1251", "mac_roman"), ("cp1251", "utf-8"), ("koi8-r", "cp1251"), ("koi8-r", "cp1252"), ("koi8-r", "latin-1"), ("koi8-r", "utf-8"),
    ("cp866", "cp1251"), ("cp866", "cp1252"), ("cp866", "latin-1"), ("cp932", "cp1252"), ("cp932", "latin-1"), ("cp932", "mac_roman"), ("cp932", "utf-8"), ("euc_jp", "cp1252"), ("euc_jp", "latin-1"), ("euc_jp", "cp932"), ("euc_jp", "utf-8"),
)

RUN = re.compile(r"[^\x00-\x7f]+")


def _pass_bytes(error: UnicodeError) -> tuple[str | bytes, int]:
    """Undefined bytes of one-byte encodings stand for themselves, both ways."""
    if isinstance(error, UnicodeDecodeError):
        return error.object[error.start : error.end].decode("latin-1"), error.end
    if isinstance(error, UnicodeEncodeError):
        part = error.object[error.start : error.end]
        if all("\x80" <= c <= "\x9f" for c in part):
            return part.encode("latin-1"), error.end
    raise error


codecs.register_error("folia-pass", _pass_bytes)


def misread(text: str, pair: tuple[str, ...]) -> str | None:
    """``text`` as it looks after the pair's decoding; None if it cannot be written so."""
    try:
        for read in pair[1:]:
            data = text.encode(pair[0])
            lossy = read in ("utf-8", "cp932", "gbk", "ascii")
            text = data.decode(read, "replace" if lossy else "folia-pass")
        return text
    except UnicodeError:
        return None


def restore(text: str, pair: tuple[str, ...]) -> str | None:
    """The inverse of :func:`misread`; None if the bytes are not whole."""
    if "�" in text:
        return None
    codecs.register_error("folia-pass", _pass_bytes)
    try:
        for read in reversed(pair[1:]):
            text = text.encode(read, "folia-pass").decode(pair[0])
        return text
    except UnicodeError:
        return None


def _codes(text: str) -> np.ndarray:
    """Code points of a text; ASCII as one of a few classes, the mark between texts as an edge."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], codes)


def _ascii_class(c: str) -> str:
    return "^" if c == EDGE else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else " " if c in " \t\n\r" else "."


#: Mark between texts; a text's own one is taken as a blank first.
EDGE = "\0"
_ASCII = np.array([ord(_ascii_class(chr(i))) for i in range(128)], np.uint32)


def _pair_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of all neighbours of which at least one is beyond ASCII; the place is that of the second."""
    beyond = codes >= 128
    at = np.flatnonzero(beyond[:-1] | beyond[1:])
    return at + 1, codes[at].astype(np.uint64) << np.uint64(32) | codes[at + 1]


def snippets(text: str) -> Iterator[tuple[str, str, str]]:
    """(sign before, run, sign after) of every run beyond ASCII."""
    for m in RUN.finditer(text):
        a, b = m.start(), m.end()
        yield text[a - 1 : a], m.group(), text[b : b + 1]


@dataclass
class Model:
    """Log-likelihood ratios of every pair's state against the clean state, as rows that sorted keys point at.

    A pair of signs has its own row, else the second sign's row, else the last one.
    """

    pairs: np.ndarray
    signs: np.ndarray
    rows: np.ndarray
    enter: float = ENTER
    stay: float = STAY
    leave: float = LEAVE

    def __post_init__(self) -> None:
        self.most = self.rows.max(axis=1) + self.stay

    def row_numbers(self, keys: np.ndarray) -> np.ndarray:
        n, m = len(self.pairs), len(self.signs)
        i = np.minimum(np.searchsorted(self.pairs, keys), n - 1)
        second = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        j = np.minimum(np.searchsorted(self.signs, second), m - 1)
        return np.where(self.pairs[i] == keys, i, np.where(self.signs[j] == second, n + j, n + m))

    def _price(self) -> float:
        """What a visit of a state must gain to be better than staying clean."""
        return -(self.enter + self.leave) + self.stay

    def label_all(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, end, state) of every span that is not clean, for each of the texts."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        k = 0
        while k < len(texts):
            size, first = 0, k
            while k < len(texts) and (k == first or size + len(texts[k]) <= BLOCK_CHARS):
                size += len(texts[k])
                k += 1
            self._label_block(texts, first, k, out)
        return out

    def _label_block(self, texts: list[str], first: int, last: int, out: list) -> None:
        joined = EDGE + EDGE.join(t.replace(EDGE, " ") for t in texts[first:last]) + EDGE
        at, keys = _pair_keys(_codes(joined))
        if not len(at):
            return
        numbers = self.row_numbers(keys)
        starts = np.cumsum([1, *(len(t) + 1 for t in texts[first:last])])
        # The pair of a last sign and the edge lies at the edge, so it still belongs to its own text.
        borders = np.searchsorted(at, starts)
        gain = self.most[numbers]
        price = self._price()
        for i in range(first, last):
            a, b = borders[i - first], borders[i - first + 1]
            # No state can gain more in a stretch than the best one of each of its places.
            if b > a and _best_stretch(gain[a:b]) > price:
                out[i] = self._spans(texts[i], at[a:b] - starts[i - first], self.rows[numbers[a:b]])

    def _spans(self, text: str, places: np.ndarray, gains: np.ndarray) -> list[tuple[int, int, int]]:
        sums = np.cumsum(gains + self.stay, axis=0, dtype=np.float64)
        low = np.minimum.accumulate(np.vstack([np.zeros((1, gains.shape[1])), sums[:-1]]), axis=0)
        # A state whose best stretch cannot pay for the visit lies on no best path.
        states = np.flatnonzero((sums - low).max(axis=0) > self._price())
        if not len(states):
            return []
        labels = self._viterbi(gains[:, states].tolist())
        out: list[list[int]] = []
        for p, k in zip(places.tolist(), labels):
            if k < 0 or p >= len(text) or text[p] < "\x80":
                continue
            state = int(states[k])
            if out and out[-1][2] == state and (out[-1][1] == p or "\n" not in text[out[-1][1] : p] and not _clean_between(out[-1][1], p, places, labels)):
                out[-1][1] = p + 1
            else:
                out.append([p, p + 1, state])
        return [(a, b, k) for a, b, k in out if _changes(text[a:b], PAIRS[k])]

    def _viterbi(self, gains: list[list[float]]) -> list[int]:
        """Labels relative to the clean state (-1) over the states that are left."""
        n = len(gains[0])
        score, clean = [-1e9] * n, 0.0
        back: list[tuple[list[bool], int]] = []
        for row in gains:
            best = max(range(n), key=score.__getitem__)
            leave = score[best] + self.leave
            fresh = clean + self.enter
            entered = [fresh > s + self.stay for s in score]
            score = [(fresh if e else s + self.stay) + g for e, s, g in zip(entered, score, row)]
            back.append((entered, best if leave > clean else -1))
            clean = max(clean, leave)
        best = max(range(n), key=score.__getitem__)
        state = best if score[best] + self.leave > clean else -1
        labels: list[int] = []
        for entered, from_state in reversed(back):
            labels.append(state)
            state = from_state if state < 0 else -1 if entered[state] else state
        labels.reverse()
        return labels

    def label(self, text: str) -> list[tuple[int, int, int]]:
        return self.label_all([text])[0]


def _best_stretch(gains: np.ndarray) -> float:
    sums = np.cumsum(gains, dtype=np.float64)
    low = np.minimum.accumulate(np.concatenate(([0.0], sums[:-1])))
    return float((sums - low).max())


def _clean_between(a: int, b: int, places: np.ndarray, labels: list[int]) -> bool:
    """Whether a sign beyond ASCII between two spans was labelled clean."""
    i, j = np.searchsorted(places, [a + 1, b])
    return any(k < 0 for k in labels[i:j])


def _changes(span: str, pair: tuple[str, ...]) -> bool:
    """False for a span that the pair leaves as it is, or that no text of a one-byte encoding turns into."""
    if all(c.isspace() for c in span if c > "\x7f"):  # a non-breaking blank by itself is a blank
        return False
    back = restore(span, pair)
    return back != span and (back is not None or "�" in span or pair[0] in ("utf-8", "cp932", "euc_jp"))


def _counted(snips: list[tuple[str, str, str]], weights: np.ndarray) -> dict[int, float]:
    """Weighted counts of the neighbours in texts, whose keys are those of :func:`_pair_keys`."""
    codes = _codes(EDGE + EDGE.join("".join(s) for s in snips) + EDGE)
    at, keys = _pair_keys(codes)
    number = np.cumsum(codes == ord("^"))[at - 1] - 1
    known, place = np.unique(keys, return_inverse=True)
    return dict(zip(known.tolist(), np.bincount(place, weights[number], len(known)).tolist()))


def _writable(signs: set[str], name: str) -> set[str]:
    out = set()
    for c in signs:
        try:
            c.encode(name)
            out.add(c)
        except UnicodeError:
            pass
    return out


def _tables(found: dict[tuple[str, str, str], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table, key, count) of the neighbours in clean (before, run, after) snippets, as written and misread by each pair."""
    snips = [s for s in found if EDGE not in "".join(s)]
    weights = np.array([found[s] for s in snips], np.float64)
    signs = {c for s in snips for c in "".join(s)}
    tables = [_counted(snips, weights)]
    can = {name: _writable(signs, name) for name in {p[0] for p in PAIRS}}
    fits = {name: [i for i, s in enumerate(snips) if ok.issuperset("".join(s))] for name, ok in can.items()}
    for pair in PAIRS:
        each = [(misread("".join(snips[i]), pair), i) for i in fits[pair[0]]]
        kept = [((g, "", ""), i) for g, i in each if g is not None and EDGE not in g]
        tables.append(_counted([g for g, _ in kept], weights[[i for _, i in kept]]) if kept else {})
    table = np.repeat(np.arange(len(tables)), [len(c) for c in tables])
    return table, np.array([k for c in tables for k in c], np.int64), np.array([n for c in tables for n in c.values()], np.int64)


def _model(table: np.ndarray, key: np.ndarray, count: np.ndarray) -> Model:
    """A model from the counts of :func:`_tables`, each (table, key) once."""
    order = np.argsort(key, kind="stable")
    table, key, count = table[order], key[order], count[order].astype(np.float64)
    keys = np.unique(key)
    firsts, first = np.unique(key >> 32, return_inverse=True)
    seconds, second = np.unique(key & 0xFFFFFFFF, return_inverse=True)
    one = np.zeros((len(seconds), len(PAIRS) + 1))
    before = np.zeros((len(firsts), len(PAIRS) + 1))
    np.add.at(one, (second, table), count)
    np.add.at(before, (first, table), count)
    totals = one.sum(axis=0)
    base = (one + UNSEEN / SIGNS) / (totals + UNSEEN)
    unseen = UNSEEN / SIGNS / (totals + UNSEEN)

    def against(p: np.ndarray) -> np.ndarray:
        logs = np.log(p)
        return (logs[..., 1:] - logs[..., :1]).astype(np.float32)

    # A sign after an unseen sign is judged alone; a sign that no state has seen says nothing.
    if not len(keys):  # sentinels keep the sorted keys from being empty
        return Model(np.array([0], np.uint64), np.array([0], np.uint32), np.vstack([np.minimum(against(unseen), 0.0)] * 3))
    rows = np.empty((len(keys) + len(seconds) + 1, len(PAIRS)), np.float32)
    for i in range(0, len(keys), BLOCK_ROWS):
        part = keys[i : i + BLOCK_ROWS]
        a, b = np.searchsorted(key, part[0]), np.searchsorted(key, part[-1], "right")
        two = np.zeros((len(part), len(PAIRS) + 1))
        two[np.searchsorted(part, key[a:b]), table[a:b]] = count[a:b]
        y, x = np.searchsorted(seconds, part & 0xFFFFFFFF), np.searchsorted(firsts, part >> 32)
        rows[i : i + len(part)] = against((two + BACKOFF * base[y]) / (before[x] + BACKOFF))
    rows[len(keys) : -1] = against(base)
    rows[-1] = np.minimum(against(unseen), 0.0)
    return Model(keys.astype(np.uint64), seconds.astype(np.uint32), rows)


def _inverts(run: str, known: set[str]) -> bool:
    """A run of at least two signs that, under some one-byte reading, is whole UTF-8 of signs known from elsewhere."""
    if len(run) < 2:
        return False
    for read in ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r"):
        try:
            back = run.encode(read, "folia-pass").decode("utf-8")
        except UnicodeError:
            continue
        if len(back) < len(run) and known.issuperset(back):
            return True
    return False


def _odd(run: str, known: set[str]) -> bool:
    return "�" in run or _inverts(run, known)


def _set_prices(model: Model, spans: int, places: int, signs: int) -> Model:
    """Transitions from the counts of spans, of their places and of all signs, on top of one span that the first prices would give."""
    clean = math.exp(-ENTER) / len(PAIRS) + signs
    model.enter, model.leave = math.log((1 + spans) / clean / len(PAIRS)), math.log((1 + spans) / (math.exp(-LEAVE) + places))
    return model


def fit(texts: Iterable[str], *, rounds: int = 1) -> Model:
    """The model of texts; starts from documents without runs that are UTF-8 when read back.

    The labels of each round give the next one its clean documents and its transitions.
    """
    texts = list(texts)
    docs = [list(snippets(t)) for t in texts]
    common = Counter(c for d in docs for c in {c for s in d for c in s[1]})
    known = {c for c, n in common.items() if n >= KNOWN_DOCS}
    odd = {s for d in docs for s in set(d) if _odd(s[1], known)}
    model = _model(*_tables(Counter(s for d in docs if odd.isdisjoint(d) for s in d)))
    for _ in range(rounds):
        labels = model.label_all(texts)
        model = _model(*_tables(Counter(s for d, t, spans in zip(docs, texts, labels) if "�" not in t and not spans for s in d)))
        _set_prices(model, sum(map(len, labels)), sum(b - a for found in labels for a, b, _ in found), sum(len(s[1]) for d in docs for s in d))
    return model


def repaired(text: str, spans: list[tuple[int, int, int]]) -> tuple[str, int]:
    """The text with its labelled spans restored, and how many of them could be."""
    out, at, done = [], 0, 0
    for a, b, state in spans:
        part = restore(text[a:b], PAIRS[state])
        out += [text[at:a], text[a:b] if part is None else part]
        done += part is not None
        at = b
    return "".join([*out, text[at:]]), done


def _known(texts: DataFrame) -> set[str]:
    """Signs beyond ASCII of at least ``KNOWN_DOCS`` texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                docs.update({c for c in set(text) if c > "\x7f"})
        yield frame(docs.items(), ["sign", "n"])

    counted = texts.mapInPandas(run, "sign string, n long").groupBy("sign").agg(F.sum("n").alias("n"))
    return {r.sign for r in counted.where(F.col("n") >= KNOWN_DOCS).collect()}


def _fit_all(texts: DataFrame, clean: Callable[[], Callable[[list[str]], Iterator[tuple[bool, list, tuple[int, int]]]]]) -> tuple[Model, list[int]]:
    """A model of all clean texts, and the sums for :func:`_set_prices`; ``clean`` makes what says of each text: whether it is clean, its snippets, its spans and their places."""

    def take_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge, names = clean(), ["what", "before", "run", "after", "n"]
        found: Counter = Counter()
        sums = [0, 0, 0]
        for pdf in batches:
            for fine, snips, (spans, places) in judge(pdf["text"].tolist()):
                if fine:
                    found.update(snips)
                sums = [sums[0] + spans, sums[1] + places, sums[2] + sum(len(s[1]) for s in snips)]
            if len(found) > HELD_RUNS:
                yield frame(((0, *s, n) for s, n in found.items()), names)
                found.clear()
        yield frame([*((0, *s, n) for s, n in found.items()), *((-1 - i, "", "", "", n) for i, n in enumerate(sums))], names)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {}
            for what, *snip, n in pdf.itertuples(index=False, name=None):
                if what:
                    yield frame([(what, 0, n)], ["t", "k", "n"])
                else:
                    found[tuple(snip)] = n
            if found:
                yield pd.DataFrame(dict(zip("tkn", _tables(found))))

    keys = ["what", "before", "run", "after"]
    runs = texts.mapInPandas(take_apart, "what int, before string, run string, after string, n long").groupBy(*keys).agg(F.sum("n").alias("n"))
    counted = runs.mapInPandas(count, "t int, k long, n long").groupBy("t", "k").agg(F.sum("n").alias("n")).toPandas()
    t, k, n = (counted[c].to_numpy(np.int64) for c in "tkn")
    return _model(t[t >= 0], k[t >= 0], n[t >= 0]), [int(n[t == -1 - i].sum()) for i in range(3)]


def fitted(df: DataFrame, *, text_col: str) -> Model:
    """The model of all documents with signs beyond ASCII: that of :func:`fit`, counted by the tasks.

    What reaches the driver grows with the pairs of signs that stand side by side, not with the documents.
    """
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike(r"[^\x00-\x7f]"))
    context = df.sparkSession.sparkContext
    known = context.broadcast(_known(texts))

    def at_first() -> Callable:
        seen: dict[str, bool] = {}

        def judge(batch: list[str]) -> Iterator[tuple[bool, list, tuple[int, int]]]:
            if len(seen) > HELD_RUNS:
                seen.clear()
            for text in batch:
                snips = list(snippets(text))
                for _, run, _ in snips:
                    if run not in seen:
                        seen[run] = _odd(run, known.value)
                yield not any(seen[run] for _, run, _ in snips), snips, (0, 0)

        return judge

    first = context.broadcast(_state(_fit_all(texts, at_first)[0]))

    def by_model() -> Callable:
        model = Model(*first.value)

        def judge(batch: list[str]) -> Iterator[tuple[bool, list, tuple[int, int]]]:
            for text, spans in zip(batch, model.label_all(batch)):
                yield not spans and "�" not in text, list(snippets(text)), (len(spans), sum(b - a for a, b, _ in spans))

        return judge

    model, sums = _fit_all(texts, by_model)
    return _set_prices(model, *sums)


def _state(m: Model) -> tuple:
    return m.pairs, m.signs, m.rows, m.enter, m.stay, m.leave


def restored(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Affected rows: id, n_spans, n_restored, encodings, restored_text (without the last if not ``with_text``)."""
    model = fitted(df, text_col=text_col)
    shared = df.sparkSession.sparkContext.broadcast(_state(model))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for pdf in batches:
            rows = []
            texts = pdf[text_col].tolist()
            for key, text, spans in zip(pdf[id_col], texts, own.label_all(texts)):
                if spans:
                    whole, done = repaired(text, spans)
                    names = sorted({" as ".join(PAIRS[s]) for _, _, s in spans})
                    rows.append((key, len(spans), done, names, *([whole] if with_text else [])))
            yield frame(rows, [id_col, "n_spans", "n_restored", "encodings", *(["restored_text"] if with_text else [])])

    schema = f"`{id_col}` {kind}, n_spans int, n_restored int, encodings array<string>" + ", restored_text string" * with_text
    # ASCII texts have no observation at all; the scan drops them before they reach Python.
    return df.select(id_col, text_col).where(F.col(text_col).rlike(r"[^\x00-\x7f]")).mapInPandas(run, schema)
