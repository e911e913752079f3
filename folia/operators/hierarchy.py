"""Parent-child rows to full hierarchies by pointer doubling.

Every round joins each unresolved node with the state of the node it points at, which doubles the
distance covered; a forest of depth ``d`` resolves in about ``log2(d)`` rounds. A round that resolves
no node proves that all nodes left point into a circle: of any node further from its end than the
covered distance, some ancestor would have been resolved in that round.

Nodes that reached a root leave the working table at once, so its size falls from round to round. Where
many rows point at one node, its row is broadcast: there are few such nodes by count, so one parent with a
third of all children sends no third of the rows to one task.

Defined results: ids and parents are compared trimmed and in lower case; a null or blank parent is a
root; rows with a null or blank id are no nodes and are left out; of several rows with one id the one
of the highest revision holds (a null revision is the lowest; ties are broken by the greatest parent);
a parent that no row has is the ``stop_id`` of its whole subtree; on and below a circle ``stop_id`` is
the smallest id of the circle. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.frames import frame
from folia.plans.lineage import Cuts

#: Rows from which the targets of heavy keys are broadcast, and how many such keys there can be at most.
HEAVY_ROWS, HEAVY_KEYS = 200_000, 500
#: Rows that are left of a job when one task finishes it; the rounds go on above.
TAIL_ROWS = 20_000
#: Places of one block of the walk that puts paths together.
BLOCK_ROWS = 50_000
#: Ids of paths that one Arrow batch holds before it is sent.
BATCH_IDS = 2_000_000

#: Blank characters trimmed from ids, as a Java character class.
BLANKS = r"\s\u00a0\u2000-\u200b\u3000\ufeff"


def clean_id(c: Column) -> Column:
    """Trimmed lower-case id; blank becomes null."""
    s = F.lower(F.regexp_replace(c.cast("string"), f"^[{BLANKS}]+|[{BLANKS}]+$", ""))
    return F.when(s != "", s)


def current_nodes(df: DataFrame, *, id_col: str = "id", parent_col: str = "parent_id", revision_col: str | None = "revision") -> DataFrame:
    """One row (id, parent) per node: the row of the highest revision."""
    rev = F.col(revision_col) if revision_col else F.lit(0)
    nodes = df.select(clean_id(F.col(id_col)).alias("id"), clean_id(F.col(parent_col)).alias("parent"), rev.alias("rev")).where("id is not null")
    best = nodes.groupBy("id").agg(F.max(F.struct("rev", "parent")).alias("b"))
    return best.select("id", F.col("b.parent").alias("parent"))


def _one_task(rows: DataFrame, solve: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """Rows of ``solve`` over all ``rows``, which were counted to be at most ``TAIL_ROWS``."""
    columns, names = rows.columns, [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        yield frame(solve(pd.concat(parts) if parts else pd.DataFrame(columns=columns)), names)

    return rows.repartition(1).mapInPandas(run, schema)


def _int(x: object) -> int | None:
    return None if x is None or x != x else int(x)


def _ends(rows: pd.DataFrame) -> list[tuple]:
    """(n, ptr, stop) of state rows with every pointer followed to its end; rows that reach a root are left out."""
    ptr = {int(n): None if isinstance(s, str) else int(p) for n, p, s in zip(rows["n"], rows["ptr"], rows["stop"])}
    end: dict[int, object] = {int(n): s for n, s in zip(rows["n"], rows["stop"]) if isinstance(s, str)}
    for n in ptr:
        way, seen = [], set()
        while n in ptr and n not in end and n not in seen:
            seen.add(n)
            way.append(n)
            n = ptr[n]
        # A walk that meets itself has met a circle; one that leaves the table has met a root.
        stop = end[n] if n in end else False if n in seen else True
        end.update(dict.fromkeys(way, stop))
    return [(n, ptr[n], e if isinstance(e, str) else None) for n, e in end.items() if e is not True]


def _rounds(cuts: Cuts, first: DataFrame) -> DataFrame:
    """Double pointers in ``first(n, ptr, stop)`` until no active row (``stop`` null) resolves.

    ``ptr`` of an active row names another row; a row that is no longer in the table has reached a root.
    """
    state, path, before = cuts.write_counted(first, "stop is null")
    while before > TAIL_ROWS:
        active = state.where("stop is null")
        target = state.select(F.col("n").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("stop").alias("stop2"))
        moved = _follow(active.select("n", "ptr"), target, before).select("n", F.col("ptr2").alias("ptr"), F.col("stop2").alias("stop"))
        new, new_path, now = cuts.write_counted(moved.unionByName(state.where("stop is not null")), "stop is null")
        cuts.release(path)
        state, path = new, new_path
        if now == before:
            return state
        before = now
    if not before:
        return state
    active = state.where("stop is null")
    # The rows left and those with a stop that they point at: no more than twice the bound.
    pointed = state.where("stop is not null").join(active.select(F.col("ptr").alias("n")).distinct(), "n", "left_semi")
    solved, _ = cuts.write(_one_task(active.unionByName(pointed), _ends, "n bigint, ptr bigint, stop string"))
    return state.where("stop is not null").join(solved.select("n"), "n", "left_anti").unionByName(solved)


def _rings(rows: pd.DataFrame) -> list[tuple]:
    """(id, stop_id, member, ring_pos) of rows (id, parent) that all point into circles."""
    parent = dict(zip(rows["id"], rows["parent"]))
    stop: dict[str, str] = {}
    place: dict[str, int] = {}
    for n in parent:
        way, at = [], {}
        while n not in stop and n not in at:
            at[n] = len(way)
            way.append(n)
            n = parent[n]
        if n not in stop:
            ring = way[at[n] :]
            low = min(ring)
            k = ring.index(low)
            # The walk goes up, so a member's steps down from the smallest id are its steps up to it.
            place.update({x: (k - i) % len(ring) for i, x in enumerate(ring)})
            stop.update(dict.fromkeys(ring, low))
        stop.update(dict.fromkeys((x for x in way if x not in stop), stop[n]))
    return [(i, stop[i], i in place, place.get(i)) for i in parent]


def _circles(cuts: Cuts, rows: DataFrame, total: int) -> DataFrame:
    """(id, stop_id, member, ring_pos) of rows(id, parent) that all point into circles.

    ``stop_id`` is the smallest id of the circle, ``ring_pos`` a member's steps down from it.
    """
    if total <= TAIL_ROWS:
        return cuts.write(_one_task(rows.select("id", "parent"), _rings, "id string, stop_id string, member boolean, ring_pos int"))[0]
    state, path = cuts.write(rows.select("id", F.col("parent").alias("ptr"), F.least("id", "parent").alias("low")))
    images, checksum = -1, -1
    while True:
        # Pointers are all on circles once their number stays; minima are whole once they do not change.
        n, same = state.agg(F.count_distinct("ptr"), F.sum(F.xxhash64("id", "low").cast("decimal(38,0)"))).first()
        if n == images and same == checksum or n == 0:
            break
        images, checksum = n, same
        target = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("low").alias("low2"))
        new, new_path = cuts.write(_follow(state, target, total).select("id", F.col("ptr2").alias("ptr"), F.least("low", "low2").alias("low")))
        cuts.release(path)
        state, path = new, new_path
    on = state.select(F.col("id").alias("ptr"), F.col("low").alias("stop_id"))
    # After the last round every pointer lies on its circle, and every member is pointed at.
    members = state.select("ptr").distinct().select(F.col("ptr").alias("id"), F.lit(True).alias("member"))
    ends = _follow(state.select("id", "ptr"), on, total).select("id", "stop_id").join(members, "id", "left").select("id", "stop_id", F.coalesce("member", F.lit(False)).alias("member"))
    ends, _ = cuts.write(ends)
    return ends.join(_ring_places(cuts, rows.join(ends.where("member"), "id")), "id", "left")


def _ring_places(cuts: Cuts, members: DataFrame) -> DataFrame:
    """(id, ring_pos) of the members(id, parent, stop_id) of circles: steps down from the smallest id of each.

    The circle is cut above its smallest id, and the steps are summed as the pointers double.
    """
    first = members.select("id", F.when(F.col("id") != F.col("stop_id"), F.col("parent")).alias("ptr"), F.when(F.col("id") != F.col("stop_id"), 1).otherwise(0).alias("ring_pos"))
    state, path, left = cuts.write_counted(first, "ptr is not null")
    while left:
        target = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("ring_pos").alias("more"))
        moved = state.where("ptr is not null").join(target, "ptr").select("id", F.col("ptr2").alias("ptr"), (F.col("ring_pos") + F.col("more")).alias("ring_pos"))
        new, new_path, left = cuts.write_counted(state.where("ptr is null").unionByName(moved), "ptr is not null")
        cuts.release(path)
        state, path = new, new_path
    return state.select("id", "ring_pos")


def unrooted(df: DataFrame, *, id_col: str = "id", parent_col: str = "parent_id", revision_col: str | None = "revision") -> DataFrame:
    """(id, stop_id) of every node whose chain of parents never reaches a root.

    Nodes are numbered once, so the doubling rounds move pairs of integers; only the rows of the result
    are joined back to their ids.
    """
    cuts = Cuts(df.sparkSession, "unrooted")
    nodes, _ = cuts.write(current_nodes(df, id_col=id_col, parent_col=parent_col, revision_col=revision_col).withColumn("n", F.monotonically_increasing_id()))
    up = nodes.select(F.col("id").alias("parent"), F.col("n").alias("ptr"))
    first = nodes.where("parent is not null").select("n", "parent").join(up, "parent", "left")
    first = first.select("n", "ptr", F.when(F.col("ptr").isNull(), F.col("parent")).alias("stop"))
    # A pointer at a root leads out of the table, which the first join of the rounds resolves.
    state = _rounds(cuts, first)
    broken = state.where("stop is not null").select("n", F.col("stop").alias("stop_id"))
    left = state.where("stop is null").select("n")
    names = nodes.select("n", "id", "parent")
    lost = names.join(broken, "n").select("id", "stop_id")
    ring, _, size = cuts.write_counted(names.join(left, "n").select("id", "parent"))
    return lost.unionByName(_circles(cuts, ring, size).select("id", "stop_id"))


def _follow(pointing: DataFrame, target: DataFrame, total: int) -> DataFrame:
    """pointing(ptr, ...) joined with target(ptr, ...), which has one row per key.

    At most ``HEAVY_KEYS`` keys have more than that part of all rows; their targets are broadcast, so rows that
    point at one node are not sent to one task.
    """
    if total < HEAVY_ROWS:
        return pointing.join(target, "ptr")
    heavy = F.broadcast(pointing.groupBy("ptr").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > total // HEAVY_KEYS).select("ptr"))
    few = F.broadcast(target.join(heavy, "ptr", "left_semi"))
    return pointing.join(few, "ptr").unionByName(pointing.join(heavy, "ptr", "left_anti").join(target, "ptr"))


def _adds(rows: pd.DataFrame) -> list[tuple]:
    """(n, add) over all rounds left of active rows (n, ptr, cnt); rows in circles come out with a null."""
    ptr = {int(n): int(p) for n, p in zip(rows["n"], rows["ptr"])}
    size = {int(n): int(c) for n, c in zip(rows["n"], rows["cnt"])}
    waiting = Counter(ptr.values())
    add: Counter = Counter()
    ready = [n for n in ptr if not waiting[n]]
    done: set[int] = set()
    while ready:
        n = ready.pop()
        done.add(n)
        up = ptr[n]
        add[up] += size[n] + add[n]
        waiting[up] -= 1
        if not waiting[up] and up in ptr:
            ready.append(up)
    # Members of circles always wait for one another; a chain that meets one hangs below it.
    end: dict[int, bool] = dict.fromkeys(ptr.keys() - done, True)
    for n in ptr:
        way = []
        while n in ptr and n not in end:
            way.append(n)
            n = ptr[n]
        end.update(dict.fromkeys(way, end.get(n, False)))
    stuck = {n for n, e in end.items() if e}
    return [(n, c) for n, c in add.items() if n not in stuck] + [(n, None) for n in stuck]


def _below(cuts: Cuts, links: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """(n, below): the nodes below each node of links(n, ptr), leaves left out; the (n) that hang in circles; their number.

    ``cnt`` counts a node and those below it within the distance that its pointer covers, so the rows of a round
    add up at the nodes they point at. Rows leave when their pointer has no pointer itself.
    """
    active, path, before = cuts.write_counted(links.where("ptr is not null").withColumn("cnt", F.lit(1).cast("bigint")))
    sums, stuck, n_stuck = [], None, 0
    while before > TAIL_ROWS:
        add, _ = cuts.write(active.groupBy(F.col("ptr").alias("n")).agg(F.sum("cnt").alias("add")))
        sums.append(add)
        target = active.select(F.col("n").alias("ptr"), F.col("ptr").alias("ptr2"))
        moved = _follow(active, target, before).join(add, "n", "left")
        new, new_path, now = cuts.write_counted(moved.select("n", F.col("ptr2").alias("ptr"), (F.col("cnt") + F.coalesce("add", F.lit(0))).alias("cnt")))
        cuts.release(path)
        active, path = new, new_path
        if now == before:
            stuck, n_stuck = active.select("n"), now
            break
        before = now
    if before and stuck is None:
        rest, _, n_stuck = cuts.write_counted(_one_task(active, _adds, "n bigint, add bigint"), "add is null")
        sums.append(rest.where("add is not null"))
        stuck = rest.where("add is null").select("n") if n_stuck else None
    if not sums:
        return links.select("n", F.lit(0).cast("bigint").alias("below")).limit(0), None, 0
    every = reduce(DataFrame.unionByName, sums).groupBy("n").agg(F.sum("add").alias("below"))
    return (every if stuck is None else every.join(stuck, "n", "left_anti")), stuck, n_stuck


def _steps(cuts: Cuts, rows: DataFrame, total: int) -> DataFrame:
    """(n, up, step, depth) of rows(n, id, up, below): places from a parent's to a node's, in pre-order.

    Siblings follow one another by the part of the hash space and then by id. Sums over the parts come before
    sums inside one, so that the children of one parent are spread over the parts.
    """
    parts = max(64, total // 200_000)
    each = rows.select("n", "id", "up", (F.col("below") + 1).alias("size"), F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))
    sums = each.groupBy("up", "part").agg(F.sum("size").alias("size"))
    ahead = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("up", "part", ahead(Window.partitionBy("up").orderBy("part")).alias("base"))
    inside = each.withColumn("ahead", ahead(Window.partitionBy("up", "part").orderBy("id")))
    out = inside.join(sums, (inside["part"] == sums["part"]) & inside["up"].eqNullSafe(sums["up"])).select("n", inside["up"], (F.col("base") + F.col("ahead")).alias("step"))
    return out.select("n", F.col("up").alias("ptr"), F.when(F.col("up").isNull(), F.col("step")).otherwise(F.col("step") + 1).alias("place"), F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth"))


def _sums(rows: pd.DataFrame) -> list[tuple]:
    """(n, place, depth) of the active rows among (n, ptr, place, depth), summed up to where no pointer is left."""
    ptr = {int(n): _int(p) for n, p in zip(rows["n"], rows["ptr"])}
    total = {int(n): (int(p), int(d)) for n, p, d in zip(rows["n"], rows["place"], rows["depth"])}
    active = [n for n, p in ptr.items() if p is not None]
    for n in active:
        way = []
        while ptr[n] is not None:
            way.append(n)
            n = ptr[n]
        place, depth = total[n]
        for x in reversed(way):
            place, depth = total[x][0] + place, total[x][1] + depth
            total[x], ptr[x] = (place, depth), None
    return [(n, *total[n]) for n in active]


def _summed(cuts: Cuts, first: DataFrame) -> DataFrame:
    """(n, place, depth) of first(n, ptr, place, depth): both summed from each node up to its root."""
    state, _, before = cuts.write_counted(first, "ptr is not null")
    resolved, active = state.where("ptr is null"), state.where("ptr is not null")
    # Only nodes that something points at are looked up, and the nodes pointed at in a round are among those of
    # the round before: both sides of the join shrink as the pointers double.
    lookup, lookup_path = state, None
    while before > TAIL_ROWS:
        target = lookup.select(F.col("n").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("place").alias("place2"), F.col("depth").alias("depth2"))
        moved = _follow(active, target, before).select("n", F.col("ptr2").alias("ptr"), (F.col("place") + F.col("place2")).alias("place"), (F.col("depth") + F.col("depth2")).alias("depth"))
        moved, _, before = cuts.write_counted(moved, "ptr is not null")
        resolved, active = resolved.unionByName(moved.where("ptr is null")), moved.where("ptr is not null")
        pointed = active.select(F.col("ptr").alias("n")).distinct()
        new, new_path = cuts.write(lookup.where("ptr is null").unionByName(moved).join(pointed, "n", "left_semi"))
        cuts.release(lookup_path)
        lookup, lookup_path = new, new_path
    if not before:
        return resolved.select("n", "place", "depth")
    pointed = lookup.where("ptr is null").join(active.select(F.col("ptr").alias("n")).distinct(), "n", "left_semi")
    return resolved.select("n", "place", "depth").unionByName(_one_task(active.unionByName(pointed), _sums, "n bigint, place bigint, depth int"))


_PATH_SCHEMA = "id string, root_id string, depth int, path array<string>, stop_id string, status string, ring_pos int, place bigint, n_below bigint"


def _with_paths(rows: DataFrame, total: int, *, pairs: bool = False) -> DataFrame:
    """Paths of rows(id, place, depth, below, status, stop, ring_pos): places are cut into blocks.

    A node goes to the block of its place and, as an opening row, to every later block that its interval reaches
    into. A block in order of places is then a walk in pre-order, and the ids on the way are its stack. With
    ``pairs`` every id on the way to a node makes a row (ancestor_id, descendant_id, distance) instead.
    """
    size = max(1, min(BLOCK_ROWS, -(-total // 64)))
    first, last = F.floor(F.col("place") / size), F.floor((F.col("place") + F.col("below")) / size)
    blocks = rows.withColumn("block", F.explode(F.sequence(first, last))).withColumn("open", F.col("block") != first)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(max(parts, 1), "block").sortWithinPartitions("block", "place")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("root_id", pa.string()), ("depth", pa.int32()), ("path", pa.list_(pa.string())), ("stop_id", pa.string()), ("status", pa.string()), ("ring_pos", pa.int32()), ("place", pa.int64()), ("n_below", pa.int64())])
        stack: list[str] = []
        label: tuple = (None, None)
        for batch in batches:
            c = batch.to_pydict()
            flat: list[str] = []
            ends, kept, roots, labels = [0], [], [], []

            def part() -> pa.RecordBatch:
                take = lambda name, kind: pa.array([c[name][i] for i in kept], kind)
                paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.string()))
                columns = [take("id", pa.string()), pa.array(roots, pa.string()), take("depth", pa.int32()), paths, pa.array([x[1] for x in labels], pa.string()), pa.array([x[0] for x in labels], pa.string())]
                return pa.RecordBatch.from_arrays([*columns, take("ring_pos", pa.int32()), take("place", pa.int64()), take("below", pa.int64())], schema=schema)

            def links() -> pa.RecordBatch:
                sizes = np.diff(ends)
                below = pa.array([c["id"][i] for i in kept], pa.string()).take(pa.array(np.repeat(np.arange(len(kept)), sizes)))
                steps = np.concatenate([np.arange(n, 0, -1) for n in sizes]) if kept else np.empty(0)
                return pa.RecordBatch.from_arrays([pa.array(flat, pa.string()), below, pa.array(steps, pa.int32())], names=["ancestor_id", "descendant_id", "distance"])

            make = links if pairs else part
            for i, (name, depth, status, stop, opening) in enumerate(zip(c["id"], c["depth"], c["status"], c["stop"], c["open"])):
                stack[depth:] = [name]
                if not depth:
                    label = (status, stop)
                if opening:
                    continue
                flat += stack[:-1] if pairs else stack
                ends.append(len(flat))
                kept.append(i)
                roots.append(stack[0] if label[0] == "rooted" else None)
                labels.append(label)
                if len(flat) > BATCH_IDS:
                    yield make()
                    flat, ends, kept, roots, labels = [], [0], [], [], []
            yield make()

    return blocks.select("id", "depth", "status", "stop", "ring_pos", "place", "below", "open").mapInArrow(walk, "ancestor_id string, descendant_id string, distance int" if pairs else _PATH_SCHEMA)


def _placed(df: DataFrame, *, id_col: str, parent_col: str, revision_col: str | None) -> tuple[DataFrame, int]:
    """Rows (id, place, depth, below, status, stop, ring_pos, in_circle) of the forest that is cut at circles, and their number."""
    cuts = Cuts(df.sparkSession, "hierarchy")
    nodes, _, total = cuts.write_counted(current_nodes(df, id_col=id_col, parent_col=parent_col, revision_col=revision_col).withColumn("n", F.monotonically_increasing_id()))
    up = nodes.select(F.col("id").alias("ptr"), F.col("n").alias("up"))
    linked = _follow(nodes.where("parent is not null").withColumnRenamed("parent", "ptr"), up, total).select("n", "up")
    forest = nodes.join(linked, "n", "left")
    forest = forest.select("n", "id", "parent", "up", F.when(F.col("up").isNull(), F.when(F.col("parent").isNull(), "rooted").otherwise("missing-parent")).alias("status"), F.when(F.col("up").isNull(), F.col("parent")).alias("stop"), F.lit(None).cast("int").alias("ring_pos"))
    forest, _ = cuts.write(forest)
    below, stuck, n_stuck = _below(cuts, forest.select("n", F.col("up").alias("ptr")))
    if stuck is not None:
        ring, _ = cuts.write(forest.join(stuck, "n", "left_semi"))
        ends = _circles(cuts, ring.select("id", "parent"), n_stuck)
        cut = ring.drop("status", "stop", "ring_pos").join(ends, "id")
        cut = cut.select("n", "id", "parent", F.when(~F.col("member"), F.col("up")).alias("up"), F.when(F.col("member"), "circle").alias("status"), F.when(F.col("member"), F.col("stop_id")).alias("stop"), "ring_pos")
        cut, _ = cuts.write(cut)
        forest = forest.join(stuck, "n", "left_anti").withColumn("in_circle", F.lit(False)).unionByName(cut.withColumn("in_circle", F.lit(True)))
        below = below.unionByName(_below(cuts, cut.select("n", F.col("up").alias("ptr")))[0])
    else:
        forest = forest.withColumn("in_circle", F.lit(False))
    sized, _ = cuts.write(forest.drop("parent").join(below, "n", "left").withColumn("below", F.coalesce("below", F.lit(0).cast("bigint"))))
    placed = _summed(cuts, _steps(cuts, sized, total))
    return cuts.write(sized.drop("up").join(placed, "n").drop("n"))[0], total


def hierarchy(df: DataFrame, *, id_col: str = "id", parent_col: str = "parent_id", revision_col: str | None = "revision") -> DataFrame:
    """Per node: id, root_id, depth, path (root first, the node last), stop_id, status, ring_pos, place, n_below.

    ``status`` is ``rooted``, ``missing-parent`` or ``circle``. Below a missing parent the path starts
    with the missing id's child and depth counts from it. Circles are cut at their members: the path of a
    member is the member alone, that of a node below starts at its entry to the circle, and depth counts
    from there. ``ring_pos`` is a member's steps down from the smallest id of its circle, else null.
    ``place`` numbers all nodes in pre-order of the cut forest, so the nodes below a node are those of the
    ``n_below`` places after its own.

    Nodes are numbered, and only numbers, counts and places move while the pointers double; the ids of a path
    are put together once, in a walk over the places.
    """
    return _with_paths(*_placed(df, id_col=id_col, parent_col=parent_col, revision_col=revision_col))


def descendant_pairs(df: DataFrame, *, id_col: str = "id", parent_col: str = "parent_id", revision_col: str | None = "revision") -> DataFrame:
    """:func:`descendants` of all nodes of a table, out of the walk itself: no paths are made but for circles."""
    rows, total = _placed(df, id_col=id_col, parent_col=parent_col, revision_col=revision_col)
    return _with_paths(rows, total, pairs=True).unionByName(_round_circles(_with_paths(rows.where("in_circle"), total)))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor_id, descendant_id, distance) of every node and each node below it in :func:`hierarchy`'s result.

    Each member of a circle has all other members and all nodes below the circle as descendants, at the
    number of steps down to them; no node is its own descendant.
    """
    each = paths.select(F.col("id").alias("descendant_id"), "depth", F.posexplode("path").alias("pos", "ancestor_id"))
    on_paths = each.where("pos < depth").select("ancestor_id", "descendant_id", (F.col("depth") - F.col("pos")).alias("distance"))
    return on_paths.unionByName(_round_circles(paths))


def _round_circles(paths: DataFrame) -> DataFrame:
    """The pairs of :func:`descendants` that lead round a circle."""
    # Paths on and below a circle start at a member; the other members come before it.
    members = paths.where("ring_pos is not null").select("id", "stop_id", "ring_pos")
    size = members.groupBy("stop_id").agg(F.count(F.lit(1)).cast("int").alias("size"))
    entry = members.join(size, "stop_id").select(F.col("id").alias("entry"), F.col("ring_pos").alias("entry_pos"), "size", "stop_id")
    other = members.select(F.col("id").alias("ancestor_id"), "ring_pos", "stop_id")
    # All members above each member, with the steps down to it.
    above = entry.join(other, "stop_id").where("entry_pos != ring_pos").select("entry", "ancestor_id", F.pmod(F.col("entry_pos") - F.col("ring_pos"), F.col("size")).alias("steps"))
    under = paths.where("status = 'circle'").select(F.col("id").alias("descendant_id"), "depth", F.col("path")[0].alias("entry"))
    return under.join(above, "entry").select("ancestor_id", "descendant_id", (F.col("depth") + F.col("steps")).alias("distance"))


def descendant_counts(paths: DataFrame) -> DataFrame:
    """Every node of :func:`hierarchy`'s result with n_descendants (0 for leaves)."""
    each = paths.where("path is not null").select(F.explode(F.slice("path", F.lit(1), F.col("depth"))).alias("id"))
    counts = each.groupBy("id").agg(F.count(F.lit(1)).alias("n_descendants"))
    # A member of a circle has every other row of the circle and of what hangs below it as descendant.
    whole = paths.where("status = 'circle'").groupBy("stop_id").agg((F.count(F.lit(1)) - 1).alias("rest"))
    members = paths.where("ring_pos is not null").select("id", "stop_id").join(whole, "stop_id").select("id", "rest")
    n = F.coalesce("rest", "n_descendants", F.lit(0).cast("long"))
    return paths.join(counts, "id", "left").join(members, "id", "left").withColumn("n_descendants", n).drop("rest")
