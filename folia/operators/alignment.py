"""Sequence alignment: edit scripts, word errors, greedy matching, matching blocks.

These steps depend on order inside one pair of texts or one page, so they run as Arrow batches; the pairs
themselves come from joins, and nothing is collected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame

#: Cells of one alignment table that are held at once; of longer pairs so many rows are saved at each level.
MAX_CELLS, SAVED_ROWS = 4_000_000, 32


def _codes(a: Sequence, b: Sequence) -> tuple[np.ndarray, np.ndarray]:
    known: dict = {}
    code = lambda s: np.array([known.setdefault(x, len(known)) for x in s], np.int64)
    return code(a), code(b)


def _rows(a: np.ndarray, b: np.ndarray, first: np.ndarray, base: int) -> np.ndarray:
    """The table of edit distances below its row ``first``, that of number ``base``: insertions are a running minimum."""
    n, m = len(a), len(b)
    table = np.empty((n + 1, m + 1), np.int32)
    column = np.arange(m + 1, dtype=np.int32)
    table[0] = first
    for i in range(1, n + 1):
        row = table[i]
        row[0] = base + i
        np.minimum(table[i - 1, :-1] + (b != a[i - 1]), table[i - 1, 1:] + 1, out=row[1:])
        row[:] = np.minimum.accumulate(row - column) + column
    return table


def edit_counts(reference: Sequence, actual: Sequence) -> tuple[int, int, int, int]:
    """(insertions, deletions, substitutions, correct) of the alignment that prefers diagonal steps, then deletions.

    The path is traced from the end. Equal endings are skipped: along them it is the diagonal. Tables beyond
    ``MAX_CELLS`` are traced by blocks of rows between saved ones, so the counts do not depend on the length.
    """
    a, b = _codes(reference, actual)
    k = 0
    while k < min(len(a), len(b)) and a[-1 - k] == b[-1 - k]:
        k += 1
    a, b = a[: len(a) - k], b[: len(b) - k]
    counts = [0, 0, 0, k]
    _trace(a, b, np.arange(len(b) + 1, dtype=np.int32), 0, counts, True)
    return tuple(counts)


def _trace(a: np.ndarray, b: np.ndarray, first: np.ndarray, base: int, counts: list[int], top: bool, kinds: tuple[np.ndarray, np.ndarray] | None = None) -> int:
    """Add the steps of the path from the end of ``a`` and ``b`` up to the row ``first``; returns its column there.

    ``base`` is the number of the row ``first``; from the ``top`` row the path runs left to its start. ``kinds``
    are bits of the units of both: a step also counts in the next four places for the first bit of its
    reference unit (for insertions, of what was put in), and in the four after these for the second.
    """
    n, j = len(a), len(b)
    if n > 1 and (n + 1) * (j + 1) > MAX_CELLS:
        step = -(-n // SAVED_ROWS)
        saved = [first]
        for k in range(step, n, step):
            saved.append(_last_row(a[k - step : k], b, saved[-1], base + k - step))
        for k in reversed(range(len(saved))):
            part = a[k * step : (k + 1) * step]
            own = None if kinds is None else (kinds[0][k * step : (k + 1) * step], kinds[1][:j])
            j = _trace(part, b[:j], saved.pop()[: j + 1], base + k * step, counts, top and not k, own)
        return j
    t = _rows(a, b, first, base)
    i = n
    while i or top and j:
        if i and j and t[i, j] == t[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            step, kind = 3 if a[i - 1] == b[j - 1] else 2, kinds and kinds[0][i - 1]
            i, j = i - 1, j - 1
        elif i and t[i, j] == t[i - 1, j] + 1:
            step, kind = 1, kinds and kinds[0][i - 1]
            i -= 1
        else:
            step, kind = 0, kinds and kinds[1][j - 1]
            j -= 1
        counts[step] += 1
        if kind:
            counts[4 + step] += kind & 1
            counts[8 + step] += kind >> 1
    return j


def _kind_bits(text: str) -> np.ndarray:
    """1 for punctuation, 2 for letters that have a case."""
    return np.array([unicodedata.category(c).startswith("P") + 2 * (c.lower() != c.upper()) for c in text], np.int64)


def restricted_counts(reference: str, actual: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(insertions, deletions, substitutions, correct) of punctuation and of cased letters, on the preferred path."""
    x, y = _kind_bits(reference), _kind_bits(actual)
    if reference == actual:
        return (0, 0, 0, int((x & 1).sum())), (0, 0, 0, int((x >> 1).sum()))
    a, b = _codes(reference, actual)
    k = 0
    while k < min(len(a), len(b)) and a[-1 - k] == b[-1 - k]:
        k += 1
    same = x[len(x) - k :]
    counts = [0] * 12
    counts[7], counts[11] = int((same & 1).sum()), int((same >> 1).sum())
    n, m = len(a) - k, len(b) - k
    _trace(a[:n], b[:m], np.arange(m + 1, dtype=np.int32), 0, counts, True, (x[:n], y[:m]))
    return tuple(map(int, counts[4:8])), tuple(map(int, counts[8:12]))


def restricted_metrics(pairs: DataFrame, *by: str) -> DataFrame:
    """Sums of the edit script's steps by group and by kind of sign (``punctuation`` or ``case``), with reference_units."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            groups = zip(*(pdf[c] for c in by)) if by else [()] * len(pdf)
            for g, a, b in zip(groups, pdf["text"], pdf["predicted"]):
                rows += [(*g, name, *c) for name, c in zip(("punctuation", "case"), restricted_counts(a, b))]
            yield frame(rows, [*by, "restriction", "insertions", "deletions", "substitutions", "correct"])

    kinds = "".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}, " for c in by)
    each = pairs.select(*by, "text", "predicted").mapInPandas(run, kinds + "restriction string, insertions bigint, deletions bigint, substitutions bigint, correct bigint")
    sums = [F.sum(c).alias(c) for c in ("insertions", "deletions", "substitutions", "correct")]
    return each.groupBy(*by, "restriction").agg(*sums, F.sum(F.expr("deletions + substitutions + correct")).alias("reference_units"))


def _last_row(a: np.ndarray, b: np.ndarray, first: np.ndarray, base: int) -> np.ndarray:
    column = np.arange(len(b) + 1, dtype=np.int32)
    row = first
    for i, x in enumerate(a, base + 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[:-1] + (b != x), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - column) + column
    return row


def edit_breakdown(pairs: DataFrame, *by: str, words: bool = False) -> DataFrame:
    """Sums of insertions, deletions, substitutions and correct units by group; ``words`` splits at white space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for a, b in zip(pdf["text"], pdf["predicted"]):
                x, y = (a.split(), b.split()) if words else (a, b)
                out.append((0, 0, 0, len(x)) if a == b else edit_counts(x, y))
            groups = zip(*(pdf[c] for c in by)) if by else [()] * len(out)
            yield frame([(*g, *o) for g, o in zip(groups, out)], [*by, "insertions", "deletions", "substitutions", "correct"])

    kinds = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in by)
    each = pairs.select(*by, "text", "predicted").mapInPandas(run, kinds + ", insertions bigint, deletions bigint, substitutions bigint, correct bigint")
    sums = [F.sum(c).alias(c) for c in ("insertions", "deletions", "substitutions", "correct")]
    return each.groupBy(*by).agg(*sums)


def greedy_matches(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """One-to-one matches in the order of ``left``; items are (id, (x0, y0, x1, y1) or None, text).

    Each left item takes the free right item of the greatest (overlap, similarity, id); it stays alone if
    both are 0. Returns (left_id, right_id, iou_milli, similarity_milli).
    """
    free = list(right)
    out = []
    for lid, lbox, ltext in left:
        if not free:
            out.append((lid, None, 0, 0))
            continue
        # Similarity decides among the greatest overlaps only, and an equal text cannot be surpassed.
        ious = [_iou(lbox, box) for _, box, _ in free]
        top = [k for k, x in enumerate(ious) if x == max(ious)]
        equal = [k for k in top if free[k][2] == ltext]
        scored = [(ious[k], 1000 if equal else _similarity(ltext, free[k][2]), free[k][0], k) for k in equal or top]
        iou, sim, rid, k = max(scored)
        if not iou and not sim:
            out.append((lid, None, 0, 0))
            continue
        del free[k]
        out.append((lid, rid, iou, sim))
    return out


def _iou(a, b) -> int:
    if a is None or b is None:
        return 0
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0, w) * max(0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return int(inter * 1000 // union) if union > 0 else 0


def _similarity(a: str, b: str) -> int:
    longest = max(len(a), len(b))
    if not longest:
        return 1000
    return (longest - distance(a, b)) * 1000 // longest


def distance(a: str, b: str) -> int:
    """Edit distance with the columns of the table held in the bits of integers."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    last = 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        more, less = down | (full & ~(across | up)), up & across
        score += bool(more & last) - bool(less & last)
        more = (more << 1 | 1) & full
        up, down = ((less << 1) & full) | (full & ~(vertical | more)), more & vertical
    return score


def align_items(left: DataFrame, right: DataFrame, *, page: str = "page_id") -> DataFrame:
    """(page_id, left_id, right_id, iou, similarity): greedy one-to-one alignment of two engines' items per page.

    Both frames hold page, id, x0, y0, x1, y1 and text. Pages are groups of one page's items.
    """

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        items = lambda d: [(r.id, None if pd.isna(r.x0) else (r.x0, r.y0, r.x1, r.y1), r.text or "") for r in d.sort_values("id").itertuples()]
        return frame([(key[0], *m) for m in greedy_matches(items(a), items(b))], ["page_id", "left_id", "right_id", "iou", "similarity"])

    cols = [page, "id", "x0", "y0", "x1", "y1", "text"]
    return left.select(*cols).groupBy(page).cogroup(right.select(*cols).groupBy(page)).applyInPandas(run, "page_id string, left_id string, right_id string, iou bigint, similarity bigint")


def matching_coverage(pairs: DataFrame, key: str) -> DataFrame:
    """(key, coverage_milli, blocks): share of the left text's tokens in matching blocks with the right text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, a, b in zip(pdf[key], pdf["text"], pdf["predicted"]):
                x, y = a.split(), b.split()
                found = [m for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks() if m.size] if a != b else [None]
                covered = len(x) if a == b else sum(m.size for m in found)
                rows.append((k, covered * 1000 // len(x) if x else 1000, len(found)))
            yield frame(rows, [key, "coverage_milli", "blocks"])

    kind = pairs.schema[key].dataType.simpleString()
    return pairs.select(key, "text", "predicted").mapInPandas(run, f"`{key}` {kind}, coverage_milli bigint, blocks bigint")
