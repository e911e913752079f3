from __future__ import annotations

import random

from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import alignment, evaluation, layout, lines, selection


def plain_counts(a, b):
    n, m = len(a), len(b)
    t = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            t[i][j] = min(t[i - 1][j - 1] + (a[i - 1] != b[j - 1]), t[i - 1][j] + 1, t[i][j - 1] + 1)
    i, j, c = n, m, [0, 0, 0, 0]
    while i or j:
        if i and j and t[i][j] == t[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            c[3 if a[i - 1] == b[j - 1] else 2] += 1
            i, j = i - 1, j - 1
        elif i and t[i][j] == t[i - 1][j] + 1:
            c[1] += 1
            i -= 1
        else:
            c[0] += 1
            j -= 1
    return tuple(c)


def test_edit_counts():
    rnd = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randrange(14))) for _ in range(2))
        got = alignment.edit_counts(a, b)
        want = plain_counts(a, b)
        assert sum(got[:3]) == sum(want[:3]) == alignment.distance(a, b)
        assert got == want  # equal beginnings are taken as they stand
    assert alignment.edit_counts("", "") == (0, 0, 0, 0)
    old, alignment.MAX_CELLS = alignment.MAX_CELLS, 20
    try:
        for _ in range(100):
            a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(20))) for _ in range(2))
            assert sum(alignment.edit_counts(a, b)[:3]) == alignment.distance(a, b)
    finally:
        alignment.MAX_CELLS = old


def test_evaluation_case(spark):
    truth = spark.createDataFrame([("prose", "prose", "Hello, World!"), ("code", "code", "(DEFUN FOO (X))"), ("missing", "prose", "Must remain")], "region_id string, kind string, text string")
    pred = spark.createDataFrame([("e", "prose", "hello World!"), ("e", "code", "(DEFUN FOO (x))"), ("e", "extra", "x")], "engine string, region_id string, text string")
    pairs = evaluation.paired(truth, pred)
    cer = evaluation.character_errors(pairs, "engine").first()
    assert (cer.errors, cer.reference_units, cer.regions) == (2 + 1 + 11, 13 + 15 + 11, 3)
    code = evaluation.code_tokens(pairs.where("kind = 'code'"), "engine").first()
    assert (code.reference_tokens, code.exact_tokens, code.omitted_tokens) == (3, 2, 0)
    lost = evaluation.omissions(truth, pred).first()
    assert (lost.omitted, lost.omitted_characters) == (1, 11)
    one = spark.createDataFrame([("LOAD A B", "LOAD X")], "text string, predicted string")
    t = evaluation.code_tokens(one).first()
    assert (t.reference_tokens, t.exact_tokens, t.omitted_tokens, t.extra_tokens) == (3, 1, 1, 0)


def test_semantic_rules(spark):
    cases = [("CHAPTER 1", "text", "chapter"), ("The first diplomatic line.", "text", "paragraph"), ("  (DEFUN FOO (X))", "code", "code"), ("1. Preserve punctuation.", "text", "list-item"), ("x = y + 1", "text", "math"), ("a | b | c", "text", "table"), ("Figure 1. Example", "text", "caption"), ("See Chapter 1", "text", "cross-reference"), ("FOO, 12, 15", "text", "index"), ("$ ls -l", "text", "terminal"), ("APPENDIX", "text", "section")]
    df = spark.createDataFrame(cases, "t string, k string, want string").withColumn("got", lines.semantic_kind(F.col("t"), F.col("k")))
    assert [(r.t, r.got) for r in df.collect() if r.got != r.want] == []


def boxes(rnd, n, pages=2):
    out = []
    for k in range(n):
        x, y = rnd.randrange(400_000), rnd.randrange(400_000)
        out.append((f"p{rnd.randrange(pages)}", f"i{k:03d}", rnd.choice("ab"), x, y, x + rnd.randrange(1, 150_000), y + rnd.randrange(1, 90_000)))
    return out


BOX = "page_id string, id string, kind string, x0 long, y0 long, x1 long, y1 long"


def test_layout_against_brute_force(spark):
    rows = boxes(random.Random(3), 60)
    df = spark.createDataFrame(rows, BOX)
    meet = lambda a, b: a[0] == b[0] and a[3] < b[5] and b[3] < a[5] and a[4] < b[6] and b[4] < a[6]
    area = lambda a, b: (min(a[5], b[5]) - max(a[3], b[3])) * (min(a[6], b[6]) - max(a[4], b[4]))
    got = sorted((r.a_id, r.b_id) for r in layout.overlapping(df, df).collect())
    assert got == sorted((a[1], b[1]) for a in rows for b in rows if meet(a, b))
    best = {}
    for a in rows:
        hits = sorted((-area(a, b), b[1]) for b in rows if b[2] == "a" and meet(a, b))
        best[a[1]] = hits[0][1] if hits else None
    assert {r.line_id: r.region_id for r in layout.assign_lines(df, df.where("kind = 'a'")).collect()} == best
    for page in ("p0", "p1"):
        own = [r for r in rows if r[0] == page]
        xs = sorted({x for r in own for x in (r[3], r[5])})
        total = 0
        for x, nx in zip(xs, xs[1:]):
            reach = 0
            for y0, y1 in sorted((r[4], r[6]) for r in own if r[3] <= x and r[5] >= nx):
                total += max(0, y1 - max(reach, y0)) * (nx - x)
                reach = max(reach, y1)
        assert {r.page_id: r.area for r in layout.union_area(df).collect()}[page] == total
        t = sorted(own, key=lambda r: (r[3], r[4], r[1]))
        p = {r[1]: k for k, r in enumerate(sorted(own, key=lambda r: (r[4], r[3], r[1])))}
        right = sum(p[t[i][1]] < p[t[j][1]] for i in range(len(t)) for j in range(i + 1, len(t)))
        acc = {r.page_id: r for r in layout.order_accuracy(df).collect()}[page]
        assert (acc.correct_pairs, acc.total_pairs) == (right, len(t) * (len(t) - 1) // 2)
    empty = spark.createDataFrame([], BOX)
    assert layout.overlapping(empty, empty).count() == 0 and layout.union_area(empty).count() == 0


def test_selection(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randrange(30), rnd.randrange(30)) for _ in range(200)] + [("a", None, 1), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g string, size int, error int")
    known = {r for r in rows if None not in r}
    want = {r for r in known if not any(o[0] == r[0] and o[1] <= r[1] and o[2] <= r[2] and o != r for o in known)}
    assert {tuple(r) for r in selection.pareto_frontier(df, ["g"], "size", "error").collect()} == want
    nums = spark.createDataFrame([("x", k) for k in range(1, 21)] + [("x", None)], "g string, v int")
    assert selection.percentiles(nums, "g", "v").first().percentile == 19
    spans = spark.createDataFrame([("s", 1, 5), ("s", 10, 12), ("s", 40, 50), ("s", 45, 46)], "p string, a int, b int")
    assert {(r.first, r.last, r.spans) for r in selection.span_clusters(spans, "p", "a", "b").collect()} == {(1, 12, 2), (40, 50, 2)}
    top = selection.top_per_stratum(spark.createDataFrame([("s", k) for k in range(50)], "g string, id int"), ["g"], ["id"], 3)
    assert sorted(r.id for r in top.collect()) == [0, 1, 2]
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    ledger = spark.createDataFrame([("a", "complete"), ("b", "failed")], "k string, status string")
    assert sorted(r.k for r in selection.pending(keys, ledger, ["k"]).collect()) == ["b", "c"]


def test_text_expressions(spark):
    df = spark.createDataFrame([(" a b\n c ", "ab", ""), (None, None, None)], "a string, b string, c string")
    r = df.select(T.prose_signature(F.col("a")).alias("p"), T.similarity_milli(F.col("b"), F.col("c")).alias("s"), T.similarity_milli(F.col("c"), F.col("c")).alias("e"), F.size(T.ngrams(T.words(F.col("a")))).alias("n")).collect()
    assert (r[0].p, r[0].s, r[0].e, r[0].n) == ("a b c", 0, 1000, 1) and r[1].p is None
