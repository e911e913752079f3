"""Corpus encoding with a public byte-level BPE vocabulary by tree concatenation.

A long text is cut in halves until the parts are short, the parts are encoded apart from each other,
and neighbours are joined by re-encoding a window around the cut. The window grows on both sides until
both sides agree with it: it starts and ends where the pre-tokenizer splits whatever stands around, so
the ids left and right of it cannot change. Where a text has no such place near (one unbroken run of
letters, digits or signs), the halves of the run are joined by ids: ids next to each other in a correct
encoding are exactly those that the merges leave as two when they are encoded together, so a window is
right when its outer ids keep to themselves beside their neighbours.

Texts of over ``spread_chars`` characters are cut into rows first, so that one giant document is encoded
by many tasks; only the lists of its parts meet again in the row they are due in.

Defined results: null and empty texts give an empty list; special-token strings are ordinary text; lone
surrogates cannot occur in Arrow strings; repeated ids give one row each; extra columns are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame

#: Texts up to this many characters are encoded in one piece.
LEAF_CHARS = 1_024
#: Texts above this many characters are spread over tasks.
SPREAD_CHARS = 1 << 20
#: Runs without a split that have more bytes than this are encoded in halves.
LEAF_BYTES = 2_048

#: Places where the pre-tokenizer always begins a new piece, whatever stands around: a single blank between two
#: signs that are no blanks, and a change between letters, digits and other signs away from apostrophes.
SURE = regex.compile(r"(?<=\S) (?=\S)|(?<=[^'\P{L}])(?=\p{N})|(?<=\p{N})(?=\p{L})|(?<=\p{L})(?=[^'\s\p{L}\p{N}])|(?<=\p{N})(?=[^'\s\p{L}\p{N}])")


class Encoder:
    """One vocabulary with exact concatenation of encoded parts."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("folia", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(pattern)
        self.bytes_of = {v: k for k, v in ranks.items()}

    def encode(self, text: str) -> list[int]:
        """Ids of a text of any length."""
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        mid = len(text) // 2
        return self.join(text[:mid], self.encode(text[:mid]), text[mid:], self.encode(text[mid:]))

    def _leaf(self, text: str) -> list[int]:
        return self.bpe.encode_ordinary(text)

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """Ids of ``left + right`` from those of both."""
        if not left or not right:
            return left_ids + right_ids
        width = 64
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            start = self._first_sure(left, a) if a else 0
            end = self._last_sure(right, b) if b < len(right) else len(right)
            if start is not None and end is not None:
                break
            if not a and b == len(right):
                break
            width *= 4
        start, end = start or 0, len(right) if end is None else end
        head = self._cut(left_ids, len(left[start:].encode()), False)
        tail = self._cut(right_ids, len(right[:end].encode()), True)
        if head is None or tail is None:  # a side that was itself cut inside a piece
            start, end, head, tail = 0, len(right), [], []
        window = left[start:] + right[:end]
        return head + self._window(window) + tail

    def _first_sure(self, text: str, a: int) -> int | None:
        found = SURE.search(text, max(a, 1), len(text) - 8) if len(text) - 8 > a else None
        return found.start() if found else None

    def _last_sure(self, text: str, b: int) -> int | None:
        last = None
        for m in SURE.finditer(text, 8, b):
            last = m.start()
        return last

    def _cut(self, ids: list[int], size: int, front: bool) -> list[int] | None:
        """The ids without those that make up ``size`` bytes at one end; None if no id ends there."""
        order = range(len(ids)) if front else range(len(ids) - 1, -1, -1)
        for i in order:
            if size <= 0:
                return None if size < 0 else (ids[i:] if front else ids[: i + 1])
            size -= len(self.bytes_of[ids[i]])
        return [] if size == 0 else None

    def _window(self, text: str) -> list[int]:
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        out: list[int] = []
        for piece in self.pieces.findall(text):
            out += self.piece(piece.encode())
        return out

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-tokenizer piece, long ones by halves."""
        if len(data) <= LEAF_BYTES:
            return self.bpe._encode_single_piece(data)
        mid = len(data) // 2
        return self._join_piece(self.piece(data[:mid]), self.piece(data[mid:]))

    def _join_piece(self, left: list[int], right: list[int]) -> list[int]:
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.bpe._encode_single_piece(b"".join(map(self.bytes_of.__getitem__, left[a:] + right[:b])))
            if (not a or self._apart(left[a - 1], window[0])) and (b == len(right) or self._apart(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def _apart(self, x: int, y: int) -> bool:
        return self.bpe._encode_single_piece(self.bytes_of[x] + self.bytes_of[y]) == [x, y]


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder; built once per process."""
    return Encoder(path, pattern)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of an installed public vocabulary."""
    import public_tokenizers as P

    return P.path(name), P.PATTERN


def encode_texts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, spread_chars: int = SPREAD_CHARS) -> DataFrame:
    """(id, ids) of every row of ``df``; see the module for the method and the defined results."""
    if path is None or pattern is None:
        path, pattern = vocabulary()

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            yield frame([(k, enc.encode(t) if t else []) for k, t in zip(pdf[id_col], pdf[text_col])], [id_col, "ids"])

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            yield frame([(r, k, n, t, enc.encode(t)) for r, k, n, t in zip(pdf["_row"], pdf[id_col], pdf["no"], pdf["part"])], ["_row", id_col, "no", "part", "ids"])

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path, pattern)
        parts = [(t, list(i)) for t, i in zip(*(pdf.sort_values("no")[c] for c in ("part", "ids")))]
        while len(parts) > 1:
            parts = [(a[0] + b[0], enc.join(*a, *b)) if b else a for a, b in zip(parts[::2], [*parts[1::2], None])]
        return frame([(pdf[id_col].iloc[0], parts[0][1])], [id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(id_col, text_col)
    out = rows.where(F.length(text_col).isNull() | (F.length(text_col) <= spread_chars)).mapInPandas(short, f"`{id_col}` {kind}, ids array<int>")
    if rows.where(F.length(text_col) > spread_chars).limit(1).count():
        giant = rows.where(F.length(text_col) > spread_chars).withColumn("_row", F.monotonically_increasing_id())
        cut = F.expr(f"transform(sequence(0, cast(ceil(length(`{text_col}`) / {spread_chars}) as int) - 1), i -> substring(`{text_col}`, i * {spread_chars} + 1, {spread_chars}))")
        parts = giant.select("_row", id_col, F.posexplode(cut).alias("no", "part")).repartition("_row", "no")
        done = parts.mapInPandas(part, f"_row bigint, `{id_col}` {kind}, no int, part string, ids array<int>")
        out = out.unionByName(done.groupBy("_row").applyInPandas(whole, f"`{id_col}` {kind}, ids array<int>"))
    return out
