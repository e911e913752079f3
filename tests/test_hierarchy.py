from __future__ import annotations

import random

import pytest

from folia.operators import graphs, hierarchy

SCHEMA = "id string, parent_id string, revision int, ptr string, n long"


def brute(rows):
    best = {}
    for i, p, r, *_ in rows:
        if i is None or not i.strip():
            continue
        key, par = i.strip().lower(), (p or "").strip().lower()
        rank = (-1 if r is None else r, par)
        if key not in best or rank > best[key]:
            best[key] = rank
    parent = {k: v[1] for k, v in best.items()}
    found, paths = {}, {}
    for i in parent:
        seen, x = [i], i
        while True:
            p = parent[x]
            if not p:
                paths[i] = seen[::-1]
                break
            if p not in parent:
                found[i] = p
                break
            if p in seen:
                found[i] = min(seen[seen.index(p) :])
                break
            seen.append(p)
            x = p
    return found, paths


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found, paths = brute(rows)
    assert {r.id: r.stop_id for r in hierarchy.unrooted(df).collect()} == found
    h = hierarchy.hierarchy(df)
    got = {r.id: r for r in h.collect()}
    assert set(got) == set(found) | set(paths)
    for i, p in paths.items():
        assert (list(got[i].path), got[i].depth, got[i].root_id, got[i].status) == (p, len(p) - 1, p[0], "rooted")
    for i, s in found.items():
        assert got[i].stop_id == s and got[i].root_id is None
    counts = {r.id: r.n_descendants for r in hierarchy.descendant_counts(h).collect()}
    at = {r.place: i for i, r in got.items()}
    assert sorted(at) == list(range(len(got)))
    for i, r in got.items():
        under = {at[p] for p in range(r.place + 1, r.place + r.n_below + 1)}
        assert under == {j for j, q in got.items() if i in q.path[:-1]}
    below = {(a, i, len(p) - 1 - k) for i, p in paths.items() for k, a in enumerate(p[:-1])}
    pairs = {(r.ancestor_id, r.descendant_id, r.distance) for r in hierarchy.descendants(h.where("status = 'rooted'")).collect()}
    assert pairs == below
    for i in paths:
        assert counts[i] == sum(a == i for a, _, _ in below)


@pytest.fixture(params=[0, hierarchy.TAIL_ROWS], ids=["rounds", "one task"])
def tail(request, monkeypatch):
    """The rounds alone, and small inputs in one task."""
    monkeypatch.setattr(hierarchy, "TAIL_ROWS", request.param)
    if not request.param:
        monkeypatch.setattr(hierarchy, "HEAVY_ROWS", 1)
        monkeypatch.setattr(hierarchy, "HEAVY_KEYS", 6)
        monkeypatch.setattr(hierarchy, "BLOCK_ROWS", 4)


def test_dirty_rows(spark, tail):
    check(
        spark,
        [
            ("A ", None, 1, "x", 1), ("b", " a", 1, None, None), ("c", "B\t", 1, None, None), ("c", "z", 0, None, None), ("d", "missing", 2, None, None), ("e", "D", None, None, None),
            ("f", "g", 1, None, None), ("g", "h", 1, None, None), ("h", "f", 1, None, None), ("i", "f", 1, None, None), ("j", "j", 1, None, None), ("k", "  ", 1, None, None),
            ("b", " a", 1, None, None), (None, "a", 1, None, None), ("  ", "a", 1, None, None), ("l", "m", 3, None, None), ("l", "k", 3, None, None), ("m", None, 1, None, None),
        ],
    )


def test_random_forests(spark, tail):
    rnd = random.Random(4)
    rows = [("t0", None, 1, None, None)] + [(f"t{k}", f"t{k - 1}", 1, None, None) for k in range(1, 70)]  # one long chain
    rows += [(f"u{k}", rnd.choice([None, f"u{rnd.randrange(60)}", "gone"]), rnd.randrange(3), None, None) for k in (rnd.randrange(60) for _ in range(90))]
    rows += [(f"c{k}", f"c{(k + 1) % 17}", 1, None, None) for k in range(17)] + [(f"v{k}", f"v{k + 1}" if k < 20 else "c3", 1, None, None) for k in range(21)]
    check(spark, rows)


def test_circles_and_what_hangs_below(spark, tail):
    rnd = random.Random(9)
    parent = {f"c{k}": f"c{(k + 1) % 5}" for k in range(5)} | {"self": "self", "x": "y", "y": "x", "top": None, "mid": "top", "lost": "gone", "under": "lost"}
    for k in range(40):
        parent[f"n{k:02d}"] = rnd.choice(["c0", "c3", "x", "self", "mid", "under", *(f"n{j:02d}" for j in range(k))])
    rows = [(i, p, 1, None, None) for i, p in parent.items()]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    h = hierarchy.hierarchy(df)
    want, paths = set(), {}
    circles = [{"c0", "c1", "c2", "c3", "c4"}, {"self"}, {"x", "y"}]
    on = set().union(*circles)
    for i in parent:
        p, steps, seen = parent[i], 1, {i}
        while p in parent and p not in seen:
            want.add((p, i, steps))
            seen.add(p)
            p, steps = parent[p], steps + 1
        walk = [i]
        while walk[0] not in on and parent[walk[0]] in parent:
            walk.insert(0, parent[walk[0]])
        paths[i] = walk
    got = [(r.ancestor_id, r.descendant_id, r.distance) for r in hierarchy.descendants(h).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert sorted((r.ancestor_id, r.descendant_id, r.distance) for r in hierarchy.descendant_pairs(df).collect()) == sorted(got)
    each = {r.id: r for r in h.collect()}
    assert {i: list(r.path) for i, r in each.items()} == paths and all(r.depth == len(r.path) - 1 for r in each.values())
    assert {i for i, r in each.items() if r.ring_pos is not None} == on
    assert all((each[i].status, each[i].root_id, each[i].stop_id) == ("circle", None, min(c)) for c in circles for i in parent if paths[i][0] in c)
    assert {r.id: r.n_descendants for r in hierarchy.descendant_counts(h).collect()} == {i: sum(a == i for a, _, _ in want) for i in parent}


def test_empty(spark, tail):
    df = spark.createDataFrame([], SCHEMA)
    assert hierarchy.unrooted(df).collect() == []
    assert hierarchy.hierarchy(df).collect() == [] and hierarchy.descendant_pairs(df).collect() == []


def test_components_and_order(spark):
    rnd = random.Random(2)
    edges = [(f"n{rnd.randrange(80)}", f"n{rnd.randrange(80)}") for _ in range(60)] + [(f"p{k}", f"p{k + 1}") for k in range(40)] + [("hub", f"s{k}") for k in range(30)]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    members: dict = {}
    for x in list(parent):
        members.setdefault(root(x), []).append(x)
    want = {x: min(m) for m in members.values() for x in m}
    got = {r.id: r.component for r in graphs.components(spark.createDataFrame([*edges, (None, "q")], "left_id string, right_id string")).collect()}
    assert got == want
    e = spark.createDataFrame([("g", "b", "a"), ("g", "c", "a"), ("g", "a", "d"), ("h", "x", "y"), ("h", "y", "x")], "g string, source_id string, target_id string")
    order = {(r.g, r.id): r.position for r in graphs.topological_order(e, group="g").collect()}
    assert [order["g", k] for k in "bcad"] == [0, 1, 2, 3] and order["h", "x"] is None
    c = spark.createDataFrame([("a", "x", 5), ("a", "y", 9), ("b", "y", 8), ("b", "x", 7)], "left_id string, right_id string, iou int")
    assert {(r.left_id, r.right_id) for r in graphs.mutual_best(c).collect()} == {("a", "y"), ("b", "x")}
