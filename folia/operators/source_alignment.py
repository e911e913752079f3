"""Pages located in recovered sources: n-gram shortlists, matching blocks, line ranges of pages and regions.

Candidates come from the distinct n-grams of one document, so a common phrase only meets the files of its own
manual. Blocks of its pages meet blocks of its files in one task, which numbers the n-grams and counts the shared ones
per page; no pair of a page and a file is a row before the count. Matching blocks depend on the order of tokens, so
each shortlisted pair is one row of an Arrow batch.

Defined results: pages and files without tokens have no candidates; a page of fewer than ``LEAST_TOKENS``
tokens is not aligned; ties go to the lower path.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.functions.frames import frame
from folia.operators.typeset import DIRECTIVE, source_lines, visible
from folia.plans.broadcasts import small_side
from folia.plans.lineage import Cuts

#: Files on a shortlist, tokens of a page at least, size of a block, lines between clusters, lines of context.
SHORTLIST, LEAST_TOKENS, BLOCK, GAP, CONTEXT = 6, 10, 2, 20, 30
#: Pages and files of one document that meet in a task at most, nearly; numbers of tokens from which three don't fit in 63 bits.
PAGES, FILES, GRAM_KINDS = 1_000, 4_000, 2_000_000
SHOWN = ("chapter", "defspec", "defun", "defun1", "exdent", "item", "kitem", "section", "subsection")


def source_tokens(sources: DataFrame, *keep: str) -> DataFrame:
    """(source_path, keep..., tokens, lines): visible locator tokens of a file in order, and the line of each."""
    each = source_lines(sources, *keep)
    name, arg = F.lower(F.regexp_extract("line", DIRECTIVE, 1)), F.regexp_extract("line", DIRECTIVE, 2)
    shown = F.when(F.lower("line").startswith("'cindex"), "").when(name == "exdent", F.regexp_replace(arg, r"^[0-9]+(\s+|$)", "")).when(name == "defspec", F.concat(arg, F.lit(" Special Form"))).when(name.isin(*SHOWN), arg).when(F.col("line").startswith("."), "").otherwise(F.col("line"))
    each = each.withColumn("t", T.locator_tokens(visible(shown)))
    # Line by line; a file's lines meet in its own row. A filter of lines would find their tokens a second time.
    rows = F.array_sort(F.collect_list(F.struct("line_no", "t")))
    g = each.groupBy("source_path", *keep).agg(rows.alias("r")).where(F.exists("r", lambda x: F.size(x["t"]) > 0))
    return g.select("source_path", *keep, F.flatten(F.transform("r", lambda x: x["t"])).alias("tokens"), F.flatten(F.transform("r", lambda x: F.transform(x["t"], lambda _: x["line_no"]))).alias("lines"))


def _numbered(*lists: pa.ChunkedArray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For columns of token lists: the number of every token and the list it stands in; and how many numbers there are."""
    # A side without rows comes with buffers that Arrow can't flatten.
    flat = [pa.concat_arrays([pa.array([], x.type.value_type), *(c.flatten() for c in x.chunks if len(c))]) for x in lists]
    code = pa.concat_arrays([c.cast(pa.string()) for c in flat]).dictionary_encode()
    numbers, out = code.indices.to_numpy(zero_copy_only=False).astype(np.int64), []
    for x, c in zip(lists, flat):
        sizes = np.asarray(pc.fill_null(pc.list_value_length(x), 0), dtype=np.int64)
        out.append((numbers[: len(c)], np.repeat(np.arange(len(x)), sizes)))
        numbers = numbers[len(c) :]
    return out, max(1, len(code.dictionary))


def _runs(numbers: np.ndarray, row: np.ndarray, kinds: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``size`` tokens inside each list as one number each, and where they begin. Equal numbers are equal runs."""
    n = max(0, len(numbers) - size + 1)
    code = numbers[:n].copy()
    for k in range(1, size):
        code = code * kinds + numbers[k : k + n]
    begin = np.flatnonzero(row[:n] == row[size - 1 : size - 1 + n])
    return code[begin], begin


def _spans(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each span, one span after the other."""
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)


class _Block:
    """Pages and files of one document with numbered tokens, and the shared 3-grams of their pairs.

    ``page``, ``path`` and ``overlap`` hold a place in the pages, one in ``paths`` and the number shared; of each page the
    ``size`` first paths, or all if the page comes again elsewhere.
    """

    def __init__(self, pages: pa.Table, files: pa.Table, size: int) -> None:
        ((pt, prow), (ft, frow)), kinds = _numbered(pages["tokens"], files["tokens"])
        if kinds >= GRAM_KINDS:  # three numbers no longer fit in one: number the pairs
            _, pair = np.unique(np.append(pt[:-1] * kinds + pt[1:], ft[:-1] * kinds + ft[1:]), return_inverse=True)
            gram = lambda t, row, pair: (pair[: max(0, len(t) - 2)] * kinds + t[2:], row)
            cut = max(0, len(pt) - 1)
            codes = [gram(pt, prow, pair[:cut]), gram(ft, frow, pair[cut:])]
            (pg, pat), (fg, fat) = ((c[at], at) for c, row in codes for at in [np.flatnonzero(row[: len(c)] == row[2 : 2 + len(c)])])
        else:
            (pg, pat), (fg, fat) = _runs(pt, prow, kinds, 3), _runs(ft, frow, kinds, 3)
        known, fg = np.unique(fg, return_inverse=True)
        paths = pc.unique(files["source_path"]).take(pc.sort_indices(pc.unique(files["source_path"]), null_placement="at_start"))
        number = np.asarray(pc.index_in(files["source_path"], value_set=paths), dtype=np.int64)
        n, m = files.num_rows, len(known)
        # Files of each gram, one gram after the other; grams of each page, one page after the other.
        held = np.unique(fg * n + frow[fat])
        of, where = number[held % n], np.searchsorted(held // n, np.arange(m + 1))
        at = np.minimum(np.searchsorted(known, pg), max(0, m - 1))
        both = known[at] == pg if m else np.zeros(len(pg), bool)
        asked = np.unique(prow[pat][both] * m + at[both])
        page, gram_ = asked // max(1, m), asked % max(1, m)
        ends = np.searchsorted(page, np.arange(pages.num_rows + 1))
        again, out = pages["again"].to_pylist(), ([], [], [])
        for k in np.unique(page).tolist():
            g = gram_[ends[k] : ends[k + 1]]
            shared = np.bincount(of[_spans(where[g], where[g + 1] - where[g])], minlength=len(paths))
            some = np.flatnonzero(shared)
            if not again[k]:
                some = some[np.argsort(-shared[some], kind="stable")[:size]]
            out[0].append(np.full(len(some), k))
            out[1].append(some)
            out[2].append(shared[some])
        self.page, self.path, self.overlap = (np.concatenate([np.zeros(0, np.int64), *x]) for x in out)
        self.paths, self.number, self.kinds, self.tokens = paths, number, kinds, ((pt, prow), (ft, frow))


def _overlaps(pages: pa.Table, files: pa.Table, size: int) -> pa.Table:
    """(page_id, source_path, overlap) of the pairs of a block."""
    x = _Block(pages, files, size)
    return pa.table({"page_id": pages["page_id"].take(pa.array(x.page)), "source_path": x.paths.take(pa.array(x.path)), "overlap": pa.array(x.overlap, pa.int64())})


def _blocks(pages: DataFrame, files: DataFrame) -> tuple[GroupedData, GroupedData]:
    """Pages and files by document, large documents in blocks: every page of a block meets every file of one."""
    n = pages.groupBy("document_id").agg(F.ceil(F.count(F.lit(1)) / PAGES).cast("int").alias("np")).join(files.groupBy("document_id").agg(F.ceil(F.count(F.lit(1)) / FILES).cast("int").alias("nf")), "document_id")
    n = small_side(n)
    block = lambda c, many: F.pmod(F.xxhash64(c), F.col(many)).cast("int")
    each = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    a = pages.join(n, "document_id").withColumns({"pb": block("page_id", "np"), "fb": each("nf")}).drop("np", "nf")
    b = files.join(n, "document_id").withColumns({"fb": block("source_path", "nf"), "pb": each("np")}).drop("np", "nf")
    key = ["document_id", "pb", "fb"]
    return a.groupBy(*key), b.groupBy(*key)


def _marked(pages: DataFrame) -> DataFrame:
    """Pages, with ``again`` for those whose id has several rows."""
    again = small_side(pages.groupBy(F.col("page_id").alias("_page")).count().where("count > 1"))
    return pages.join(again, F.col("page_id").eqNullSafe(F.col("_page")), "left").select("document_id", "page_id", "tokens", F.col("count").isNotNull().alias("again"))


def _shortlist(pages: DataFrame, files: DataFrame, size: int) -> DataFrame:
    a, b = _blocks(_marked(pages), files.select("document_id", "source_path", "tokens"))
    shared = a.cogroup(b).applyInArrow(lambda x, y: _overlaps(x, y, size), "page_id string, source_path string, overlap bigint")
    shared = shared.groupBy("page_id", "source_path").agg(F.sum("overlap").alias("overlap"))
    w = Window.partitionBy("page_id").orderBy(F.desc("overlap"), "source_path")
    return shared.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)


def shortlist(pages: DataFrame, files: DataFrame, *, size: int = SHORTLIST) -> DataFrame:
    """(page_id, source_path, overlap, rank): the files of a page's document that share most distinct 3-grams with it.

    ``pages`` holds document_id, page_id and tokens, ``files`` document_id, source_path and tokens.
    """
    cuts = Cuts(pages.sparkSession, "shortlist")
    return _shortlist(cuts.write(pages)[0], cuts.write(files)[0], size)


def _matching(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matching blocks (a, b, size) of at least two tokens that ``SequenceMatcher`` finds without junk.

    ``runs`` are the longest equal stretches of two tokens or more as (-size, a, b). The longest one is taken, the first on
    a tie, and the others are cut to what lies before and after it on both sides. Stretches of two are left until no longer
    one is: then each gap between blocks takes the first that lies behind the last one taken.
    """
    twos = [(i, j) for m, i, j in runs if m == -2]
    found, todo = [], [[x for x in runs if x[0] < -2]]
    while todo:
        if not (runs := todo.pop()):
            continue
        n, a, b = min(runs)
        found.append((a, b, -n))
        c, d = a - n, b - n
        before, after = [], []
        for run in runs:
            m, i, j = run
            if i < a and j < b:
                if i - m <= a and j - m <= b:
                    before.append(run)
                    continue
                if (k := max(m, i - a, j - b)) < -1:
                    before.append((k, i, j)) if k < -2 else twos.append((i, j))
            elif i >= c and j >= d:
                after.append(run)
                continue
            if (p := m + c - i) < -1 and (q := m + d - j) < -1:
                k = p if p > q else q
                i, j = i + k - m, j + k - m
                after.append((k, i, j)) if k < -2 else twos.append((i, j))
        todo += [before, after]
    found.sort()
    ahead = iter([*found, (float("inf"), float("inf"), 0)])
    a, b, n = next(ahead)
    c = d = 0
    for i, j in sorted(twos):
        while i >= a:
            c, d = a + n, b + n
            a, b, n = next(ahead)
        if i >= c and j >= d and i + 2 <= a and j + 2 <= b:
            found.append((i, j, 2))
            c, d = i + 2, j + 2
    return sorted(found)


def _all_matching(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int, int]]:
    """All matching blocks of ``SequenceMatcher`` without junk: those of :func:`_matching`, and single tokens in the gaps between them."""
    places: dict[str, list[int]] = {}
    for j, t in enumerate(b):
        places.setdefault(t, []).append(j)
    pairs: dict[tuple[str, str], list[int]] = {}
    for j, t in enumerate(zip(b, b[1:])):
        pairs.setdefault(t, []).append(j)
    runs, long = [], []
    ends: dict[int, int] = {}  # by diagonal, the end of the latest stretch
    for i, t in enumerate(zip(a, a[1:])):
        for j in pairs.get(t, ()):
            if ends.get(j - i, -1) < i + 2:
                n = 2
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                ends[j - i] = i + n
                runs.append((-n, i, j))
    at = (0, 0)
    for i, j, n in [*_matching(runs), (len(a), len(b), 0)]:
        k, low = at
        # No two tokens in a row match here: each takes the first place that is left.
        while k < i and low < j:
            got = places.get(a[k], ())
            p = bisect_left(got, low)
            if p < len(got) and got[p] < j:
                long.append((k, got[p], 1))
                low = got[p] + 1
            k += 1
        long += [(i, j, n)] if n else []
        at = (i + n, j + n)
    return long


def _cluster(found: list[tuple[int, int, int]], lines: Sequence[int]) -> tuple[int, int, int] | None:
    """(first line, last line, matched tokens) of the densest cluster of matching blocks, which come in order."""
    if not found:
        return None
    groups, reach = [[]], lines[found[0][0]]
    for b in found:
        if lines[b[0]] - reach > GAP:
            groups.append([])
        groups[-1].append(b)
        reach = max(reach, lines[b[0] + b[2] - 1])
    best = max(groups, key=lambda g: sum(b[2] for b in g))
    return min(lines[b[0]] for b in best), max(lines[b[0] + b[2] - 1] for b in best), sum(b[2] for b in best)


def _aligned(pages: pa.Table, files: pa.Table, size: int) -> pa.Table:
    """The pairs of a block with the cluster of each, null without one."""
    x = _Block(pages, files, size)
    (pt, prow), (ft, frow) = x.tokens
    (pg, pat), (fg, fat) = _runs(pt, prow, x.kinds, 2), _runs(ft, frow, x.kinds, 2)
    known, fg = np.unique(fg, return_inverse=True)
    m = len(known)
    at = np.minimum(np.searchsorted(known, pg), max(0, m - 1))
    pg = np.where(known[at] == pg, at, m) if m else np.zeros(len(pg), np.int64)
    p_at, f_at = np.searchsorted(prow[pat], np.arange(pages.num_rows + 1)), np.searchsorted(frow[fat], np.arange(files.num_rows + 1))
    sizes = np.bincount(prow, minlength=pages.num_rows).tolist()
    lines = [y.tolist() for y in np.split(files["lines"].combine_chunks().flatten().to_numpy(), np.searchsorted(frow, np.arange(1, files.num_rows)))] if files.num_rows else []
    rows_of: list[list[int]] = [[] for _ in x.paths]
    for r, k in enumerate(x.number.tolist()):
        rows_of[k].append(r)
    slot, distinct, last, out = np.full(m + 1, -1), np.zeros(0, np.int64), -1, []
    for k, f, overlap in zip(x.page.tolist(), x.path.tolist(), x.overlap.tolist()):
        if k != last:
            slot[distinct] = -1
            grams = pg[p_at[k] : p_at[k + 1]]
            order = np.argsort(grams, kind="stable")
            distinct, first, many = np.unique(grams[order], return_index=True, return_counts=True)
            slot[distinct], slot[m], last = np.arange(len(distinct)), -1, k
        n = sizes[k]
        for r in rows_of[f]:
            place = slot[fg[f_at[r] : f_at[r + 1]]]
            i = np.flatnonzero(place >= 0)
            t = place[i]
            i = np.repeat(i, many[t])
            wide = len(place) + 2
            # Pairs of places by diagonal: neighbours on one are a stretch.
            key = np.sort((i - order[_spans(first[t], many[t])] + n) * wide + i)
            ends = np.append(np.flatnonzero(np.diff(key) != 1), len(key) - 1) if len(key) else np.zeros(0, np.int64)
            starts = np.append(0, ends[:-1] + 1)[: len(ends)]
            i = key[starts] % wide
            j = i - (key[starts] // wide - n)
            got = _cluster(_matching(list(zip((starts - ends - 2).tolist(), i.tolist(), j.tolist()))), lines[r])
            out.append((k, f, overlap, *(got or (None, None, None)), n, got[2] * 1000 // n if got else None))
    k, f, *rest = zip(*out) if out else [()] * 8
    names = ("overlap", "start_line", "end_line", "matched_tokens", "page_tokens", "coverage")
    rest = {c: pa.array(v, pa.int64() if c == "overlap" else pa.int32()) for c, v in zip(names, rest)}
    return pa.table({"page_id": pages["page_id"].take(pa.array(k, pa.int64())), "source_path": x.paths.take(pa.array(f, pa.int64())), **rest})


def align_pages(pages: DataFrame, files: DataFrame) -> DataFrame:
    """(page_id, source_path, start_line, end_line, matched_tokens, page_tokens, coverage, runner_up) of the best file of each page.

    Coverage is the share of the page's tokens in the chosen cluster in thousandths; the runner-up's is that
    of the second best file, 0 without one.
    """
    cuts = Cuts(pages.sparkSession, "alignment")
    return _located(cuts.write(pages.where(F.size("tokens") >= LEAST_TOKENS))[0], cuts.write(files)[0])


def _located(wide: DataFrame, files: DataFrame) -> DataFrame:
    a, b = _blocks(_marked(wide.where("page_id is not null")), files.where("source_path is not null").select("document_id", "source_path", "tokens", "lines"))
    pairs = a.cogroup(b).applyInArrow(lambda x, y: _aligned(x, y, SHORTLIST), "page_id string, source_path string, overlap bigint, start_line int, end_line int, matched_tokens int, page_tokens int, coverage int")
    # The shortlist of a page over all blocks of files; each path has one rank.
    total = F.sum("overlap").over(Window.partitionBy("page_id", "source_path"))
    place = F.dense_rank().over(Window.partitionBy("page_id").orderBy(F.desc("total"), "source_path"))
    each = pairs.withColumn("total", total).withColumn("place", place).where(f"place <= {SHORTLIST} and coverage is not null").drop("overlap", "total", "place")
    w = Window.partitionBy("page_id").orderBy(F.desc("coverage"), "source_path")
    ranked = each.withColumns({"rank": F.row_number().over(w), "runner_up": F.coalesce(F.lead("coverage").over(w), F.lit(0))})
    return ranked.where("rank = 1").drop("rank")


def align_regions(regions: DataFrame, files: DataFrame, located: DataFrame) -> DataFrame:
    """(region_id, start_line, end_line, matched, total, coverage): lines of a page's file that each of its regions matches.

    ``regions`` holds page_id, region_id, reading_order and text; ``located`` is the result of :func:`align_pages`.
    The regions of one page are aligned together, in reading order, with the file's lines about the page's.
    """
    return _lines_of(_by_page(regions), files, located)


def locate_regions(regions: DataFrame, files: DataFrame) -> DataFrame:
    """:func:`align_regions` with the pages put together from the regions, which hold document_id too, and located first."""
    cuts = Cuts(regions.sparkSession, "regions")
    files, by_page = cuts.write(files)[0], cuts.write(_by_page(regions, "document_id"))[0]
    each = by_page.select("page_id", "r", F.explode(F.array_distinct(F.transform("r", lambda x: x["document_id"]))).alias("document_id")).where("document_id is not null")
    own = F.filter("r", lambda x: x["document_id"] == F.col("document_id"))
    pages = each.select("document_id", "page_id", F.flatten(F.transform(own, lambda x: x["t"])).alias("tokens"))
    located, _ = cuts.write(_located(pages.where(F.size("tokens") >= LEAST_TOKENS), files))
    return _lines_of(by_page, files, small_side(located))


def _by_page(regions: DataFrame, *keep: str) -> DataFrame:
    """(page_id, r): the regions of each page in reading order with their tokens."""
    each = regions.withColumn("t", T.locator_tokens(F.coalesce("text", F.lit(""))))
    return each.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("reading_order", "region_id", "t", *keep))).alias("r"))


def _lines_of(by_page: DataFrame, files: DataFrame, located: DataFrame) -> DataFrame:
    r = F.transform("r", lambda x: F.struct(x["region_id"].alias("region_id"), x["t"].alias("t")))
    pages = by_page.select("page_id", r.alias("r")).join(located.select("page_id", "source_path", "start_line", "end_line"), "page_id").join(files.select("source_path", "tokens", "lines"), "source_path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r, a, b, tokens, lines in zip(pdf["r"], pdf["start_line"], pdf["end_line"], pdf["tokens"], pdf["lines"]):
                near = [(t, n) for t, n in zip(tokens, lines) if a - CONTEXT <= n <= b + CONTEXT]
                words = [(t, k) for k, x in enumerate(r) for t in x["t"]]
                hits: list[list[int]] = [[] for _ in r]
                for i, j, n in _all_matching([t for t, _ in near], [t for t, _ in words]):
                    for k in range(n):
                        hits[words[j + k][1]].append(int(near[i + k][1]))
                for x, h in zip(r, hits):
                    n = len(x["t"])
                    out.append((x["region_id"], min(h) if h else None, max(h) if h else None, len(h), n, round(1000 * len(h) / n) if n else 0))
            yield frame(out, ["region_id", "start_line", "end_line", "matched", "total", "coverage"])

    return pages.select("r", "start_line", "end_line", "tokens", "lines").mapInPandas(run, "region_id string, start_line int, end_line int, matched int, total int, coverage int")
