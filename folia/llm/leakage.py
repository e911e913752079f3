"""Passages of evaluation items inside a corpus, found by winnowing.

Items and documents are cut into words that letter case, punctuation, blanks, quoting, inline markup and
the form of characters do not change. Every word k-gram is hashed, and of each ``w`` neighbouring k-grams
the smallest hash is kept; two texts that share ``w + k - 1`` words in a row therefore share a kept hash.
Items are put into classes by the shortest run that a leak of theirs must leave unchanged, and each class
has its own ``k``, so a short item does not make the grams of long ones shorter. Fingerprints of items and
documents are joined on the hash; every hit is extended to both sides by a banded alignment, which lets
words be changed, put in or left out, to the longest stretch within the tolerated share of edits.

Items whose words were counted to be few are held by every task, which joins and extends inside the first
pass, so no text is moved. Beyond that bound both sides shuffle on the hash: the side of the items is
repeated over ``SALTS`` parts and the documents' fingerprints are spread over them, so a phrase that many
items share is no single group; documents then meet their candidate items by document id.

Defined results: null and empty texts, and items without words, give no rows; repeated ids give one row per
pair; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame
from folia.llm.lookalike import skeleton

#: Share of an item's words that make a leak, and of a stretch's words that may be changed.
HELD, CHANGED = 0.5, 0.1
#: Words of all items up to which every task holds them (16 bytes a word and gram); parts of a hash beyond it.
HELD_WORDS, SALTS = 2_000_000, 16
#: Words of the longest gram, and of the window of grams.
LONGEST_GRAM, WINDOW = 5, 2

_BROKEN = re.compile("[-‐­¬](?<=[^\\W\\d_].)[ \\t]*\\n[ \\t>|#;*%]*(?=[^\\W\\d_])")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]*>|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?(?=\{)|\]\([^()\s]+\)|\[\[[^\[\]|\n]+\||\{\{[^{}|\n]+\||[\x00-\x08\x0e-\x1f].")
_MARKS = re.compile(r"[<\\\]\[{\x00-\x08\x0e-\x1f]")
_WORD = re.compile(r"[^\W_]+")
#: Everything between blanks and ASCII signs; the words of a chunk depend on nothing outside of it.
_CHUNK = re.compile(r"[^\s\x00-/:-@\[-`{-\x7f]+")
#: Combining signs.
ACCENTS = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿゙゚︠-︯]+")


def _bare(text: str) -> str:
    """The text without inline markup, entities and hyphens at line ends."""
    if "&" in text:
        text = html.unescape(text)
    if _MARKS.search(text):
        text = _TAG.sub("", text)
    return _BROKEN.sub("", text) if "\n" in text else text


def _plain(text: str) -> str:
    text = skeleton(text).casefold()
    return text if text.isascii() else ACCENTS.sub("", unicodedata.normalize("NFKD", text))


def words(text: str) -> list[str]:
    """The words of a text in their comparable form."""
    return _WORD.findall(_plain(_bare(text)))


class Hashes(dict):
    """64-bit hashes of the words of a chunk; filled when a chunk is first met, emptied when full."""

    FULL = 1_000_000

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= self.FULL:
            self.clear()
        self[chunk] = out = tuple(xxhash.xxh64_intdigest(w) for w in _WORD.findall(_plain(chunk)))
        return out

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words of a text."""
        found = list(chain.from_iterable(map(self.__getitem__, _CHUNK.findall(_bare(text)))))
        return np.array(found, np.uint64)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams of word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : n + j]
            out ^= out >> np.uint64(29)
    return out


def winnow(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash of every window of ``w``, the last one in ties."""
    if not len(g):
        return np.empty(0, np.int64)
    w = min(w, len(g))
    if w == 2:
        kept = np.zeros(len(g), bool)
        kept[np.arange(len(g) - 1) + (g[1:] <= g[:-1])] = True
        return np.flatnonzero(kept)
    windows = np.lib.stride_tricks.sliding_window_view(g, w)
    return np.unique(np.arange(len(windows)) + (w - 1 - windows[:, ::-1].argmin(axis=1)))


def unchanged_run(n: int) -> int:
    """Words in a row that every leak of an item of ``n`` words leaves unchanged."""
    low = max(1, -(-n // 2))
    return min(-(-(m - int(m * CHANGED)) // (int(m * CHANGED) + 1)) for m in range(low, max(low, n) + 1))


def gram_words(n: int) -> int:
    """``k`` of the class of items of ``n`` words; two neighbouring grams lie in every unchanged run, one in short ones."""
    return max(1, min(unchanged_run(n) - WINDOW + 1, LONGEST_GRAM))


def window(k: int) -> int:
    return WINDOW if k > 1 else 1


def _reach(item: Sequence[int], doc: Sequence[int], i: int, j: int, step: int, edits: int) -> list[int]:
    """Words of the item covered from ``item[i]`` and ``doc[j]`` on in one direction, for 0, 1, ... edits.

    The furthest place on every diagonal of the band, which is as wide as the edits allow.
    """
    n = len(item) - i if step > 0 else i + 1
    m = len(doc) - j if step > 0 else j + 1

    def slide(x: int, d: int) -> int:
        while x < n and x + d < m and item[i + step * x] == doc[j + step * (x + d)]:
            x += 1
        return x

    row = {0: slide(0, 0)}
    best = [row[0]]
    for _ in range(edits):
        new: dict[int, int] = {}
        for d, x in row.items():
            # changed, left out of the document, put into it
            for e, y in ((d, x + 1), (d - 1, x + 1), (d + 1, x)):
                if y <= n and 0 <= y + e <= m and new.get(e, -1) < y:
                    new[e] = y
        row = {d: slide(x, d) for d, x in new.items()}
        best.append(max([best[-1], *row.values()]))
    return best


def longest_stretch(item: Sequence[int], doc: Sequence[int], hits: Sequence[tuple[int, int]]) -> tuple[int, int]:
    """(words, edits) of the longest stretch of the item around any of the hits (place in item, in document)."""
    n = len(item)
    most = int(n * CHANGED)
    best = (0, 0)
    covered: dict[int, int] = {}
    for i, j in sorted(hits):
        if covered.get(j - i, -1) >= i:
            continue  # inside the run that an earlier hit of this diagonal slid along
        right = _reach(item, doc, i, j, 1, most)
        left = _reach(item, doc, i - 1, j - 1, -1, most) if i and j else [0] * (most + 1)
        covered[j - i] = i + right[0] - 1
        for a, x in enumerate(left):
            for b, y in enumerate(right[: most - a + 1]):
                if a + b <= CHANGED * (x + y) and (x + y, -a - b) > (best[0], -best[1]):
                    best = (x + y, a + b)
        if best[0] == n:
            break
    return best


class Probe:
    """Items with their fingerprints, for tasks that hold all of them."""

    def __init__(self, items: list[tuple[object, Sequence[int]]]) -> None:
        self.ids = [k for k, _ in items]
        self.words = [[int(x) & 0xFFFFFFFFFFFFFFFF for x in h] for _, h in items]
        groups: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        for no, h in enumerate(np.array(w, np.uint64) for w in self.words):
            k = gram_words(len(h))
            g = grams(h, k)
            at = winnow(g, window(k))
            groups[k].append((g[at], np.full(len(at), no), at))
        self.tables = {}
        for k, parts in groups.items():
            g, no, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(g, kind="stable")
            self.tables[k] = g[order], no[order], at[order]

    def hits(self, h: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per item number the (place in item, place in document) of shared kept grams."""
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, (known, no, at) in self.tables.items():
            g = grams(h, k)
            own = winnow(g, window(k))
            kept = g[own]
            a = np.searchsorted(known, kept)
            a[a == len(known)] = 0
            there = np.flatnonzero(known[a] == kept)
            last = np.searchsorted(known, kept[there], "right")
            for p, b in zip(there, last):
                for q in range(a[p], b):
                    out[int(no[q])].append((int(at[q]), int(own[p])))
        return out

    def found(self, h: np.ndarray) -> Iterator[tuple[object, int, int]]:
        """(item id, words, edits) of all items leaked into the document."""
        doc = None
        for no, hits in self.hits(h).items():
            n = len(self.words[no])
            # A leak leaves so many of the item's words unchanged, so they stand in the document.
            need = -(-n // 2)
            if doc is None:
                doc = h.tolist()
                there = set(doc)
            if sum(map(there.__contains__, self.words[no])) < need - int(n * CHANGED):
                continue
            best = longest_stretch(self.words[no], doc, hits)
            if best[0] >= HELD * n:
                yield self.ids[no], *best


def item_table(items: DataFrame, *, item_id: str, item_text: str) -> DataFrame:
    """(item_id, words): hashes of the words of all items that have some."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Hashes()
        for pdf in batches:
            yield frame([(k, known.of(t).view(np.int64) if t else []) for k, t in zip(pdf[item_id], pdf[item_text])], ["item_id", "words"])

    kind = items.schema[item_id].dataType.simpleString()
    return items.select(item_id, item_text).mapInPandas(cut, f"item_id {kind}, words array<bigint>").where("size(words) > 0").distinct()


def leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", held_words: int = HELD_WORDS) -> DataFrame:
    """(doc_id, item_id, n_words, n_changed): the longest stretch of each leaked item in each document."""
    held = item_table(items, item_id=item_id, item_text=item_text)
    item_kind, doc_kind = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, n_words int, n_changed int"
    names = ["doc_id", "item_id", "n_words", "n_changed"]
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")).where(F.length("text") > 0)
    size = held.agg(F.sum(F.size("words"))).first()[0] or 0
    if size <= held_words:
        shared = docs.sparkSession.sparkContext.broadcast([(r.item_id, r.words) for r in held.collect()])

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            probe, known = Probe(shared.value), Hashes()
            for pdf in batches:
                yield frame([(k, *f) for k, t in zip(pdf["doc_id"], pdf["text"]) for f in probe.found(known.of(t))], names)

        spans = texts.mapInPandas(whole, schema)
    else:
        spans = _by_shuffle(texts, held, schema, names)
    return spans.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", (-F.col("n_changed")).alias("less"))).alias("b")).select("doc_id", "item_id", F.col("b.n_words").alias("n_words"), (-F.col("b.less")).alias("n_changed"))


def _by_shuffle(texts: DataFrame, held: DataFrame, schema: str, names: list[str]) -> DataFrame:
    """Stretches with both sides' fingerprints joined on the salted hash."""
    doc_kind, item_kind, *_ = (x.split()[1] for x in schema.split(", "))
    classes = sorted({gram_words(r.n) for r in held.select(F.size("words").alias("n")).distinct().collect()})

    def item_prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, h in zip(pdf["item_id"], pdf["words"]):
                k = gram_words(len(h))
                g = grams(np.asarray(h, np.int64).view(np.uint64), k)
                at = winnow(g, window(k))
                rows.append((name, k, g[at].view(np.int64), at))
            yield frame(rows, ["item_id", "k", "hash", "pos"])

    def doc_prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Hashes()
        for pdf in batches:
            rows = []
            for name, t in zip(pdf["doc_id"], pdf["text"]):
                h = known.of(t)
                for k in classes:
                    g = grams(h, k)
                    at = winnow(g, window(k))
                    rows.append((name, k, g[at].view(np.int64), at))
            yield frame(rows, ["doc_id", "k", "hash", "pos"])

    each = lambda df, key: df.selectExpr(key, "k", "inline(arrays_zip(hash, pos))")
    a = each(held.mapInPandas(item_prints, f"item_id {item_kind}, k int, hash array<bigint>, pos array<int>"), "item_id")
    a = a.withColumnRenamed("pos", "item_pos").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    b = each(texts.mapInPandas(doc_prints, f"doc_id {doc_kind}, k int, hash array<bigint>, pos array<int>"), "doc_id")
    b = b.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int"))
    pairs = b.join(a, ["k", "hash", "salt"]).groupBy("doc_id", "item_id").agg(F.collect_set(F.struct("item_pos", "pos")).alias("hits"))
    rows = pairs.join(held, "item_id").join(texts, "doc_id")

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Hashes()
        for pdf in batches:
            out = []
            for name, item, hits, own, text in zip(pdf["doc_id"], pdf["item_id"], pdf["hits"], pdf["words"], pdf["text"]):
                best = longest_stretch([int(x) & 0xFFFFFFFFFFFFFFFF for x in own], known.of(text).tolist(), [(h["item_pos"], h["pos"]) for h in hits])
                if best[0] >= HELD * len(own):
                    out.append((name, item, *best))
            yield frame(out, names)

    return rows.select("doc_id", "item_id", "hits", "words", "text").mapInPandas(extend, schema)
