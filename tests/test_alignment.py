from __future__ import annotations

import random
import unicodedata
from difflib import SequenceMatcher

from folia.operators import alignment, source_alignment as A


def pairs(a, b):
    """(expected, observed) of the alignment that prefers diagonal steps, then deletions."""
    t = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = min(t[i - 1][j - 1] + (a[i - 1] != b[j - 1]), t[i - 1][j] + 1, t[i][j - 1] + 1)
    i, j, out = len(a), len(b), []
    while i or j:
        if i and j and t[i][j] == t[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and t[i][j] == t[i - 1][j] + 1:
            i -= 1
            out.append((a[i], None))
        else:
            j -= 1
            out.append((None, b[j]))
    return out


def restricted(a, b, test):
    c = [0, 0, 0, 0]
    for x, y in pairs(a, b):
        if x is None:
            c[0] += test(y)
        elif test(x):
            c[1 if y is None else 3 if x == y else 2] += 1
    return tuple(c)


def test_restricted_counts(monkeypatch):
    rnd = random.Random(5)
    texts = [["".join(rnd.choice("aB.é,1 ß") for _ in range(rnd.randrange(14))) for _ in range(2)] for _ in range(300)]
    tests = (lambda c: unicodedata.category(c).startswith("P"), lambda c: c.lower() != c.upper())
    for cells in (4_000_000, 30):
        monkeypatch.setattr(alignment, "MAX_CELLS", cells)
        monkeypatch.setattr(alignment, "SAVED_ROWS", 3)
        for a, b in [*texts, ("", ""), ("x.", "x."), ("", "A.")]:
            assert alignment.restricted_counts(a, b) == tuple(restricted(a, b, t) for t in tests), (a, b)


def test_restricted_metrics(spark):
    df = spark.createDataFrame([("e", "Hello, World!", "hello World!"), ("e", "A.", ""), ("f", "", "")], "engine string, text string, predicted string")
    got = {(r.engine, r.restriction): (r.insertions, r.deletions, r.substitutions, r.correct, r.reference_units) for r in alignment.restricted_metrics(df, "engine").collect()}
    assert got["e", "punctuation"] == (0, 2, 0, 1, 3) and got["e", "case"] == (0, 1, 1, 9, 11) and got["f", "case"] == (0, 0, 0, 0, 0)


def test_pages_are_located_in_their_source(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    files = {p: [" ".join(word() for _ in range(8)) for _ in range(120)] for p in ("a.1", "b.1", "c.1")}
    files["a.1"][9] = ".section " + files["a.1"][9]
    page = files["a.1"][40:50]
    noisy = [x.replace("a", "o", 1) for x in page]
    sources = spark.createDataFrame([("d", p, "\n".join(x)) for p, x in files.items()] + [("other", "z.1", "\n".join(page)), ("d", "n.1", None)], "document_id string, source_path string, text string")
    f = A.source_tokens(sources, "document_id")
    toks = lambda x: [w for line in x for w in line.split()]
    pages = spark.createDataFrame([("d", "p1", toks(page)), ("d", "p2", toks(noisy)), ("d", "short", ["x"]), ("d", "none", [])], "document_id string, page_id string, tokens array<string>")
    got = {r.page_id: r for r in A.align_pages(pages, f).collect()}
    assert set(got) == {"p1", "p2"} and all(r.source_path == "a.1" for r in got.values())
    assert (got["p1"].start_line, got["p1"].end_line, got["p1"].coverage) == (41, 50, 1000)
    flat, lines = [w for line in files["a.1"] for w in line.removeprefix(".section ").split()], [k + 1 for k, line in enumerate(files["a.1"]) for _ in line.removeprefix(".section ").split()]
    blocks = [b for b in SequenceMatcher(None, flat, toks(noisy), autojunk=False).get_matching_blocks() if b.size >= 2]
    assert got["p2"].matched_tokens == sum(b.size for b in blocks) and got["p2"].start_line == min(lines[b.a] for b in blocks)
    regions = spark.createDataFrame([("p1", f"r{k}", k, page[k]) for k in range(10)] + [("p1", "r99", 99, None)], "page_id string, region_id string, reading_order int, text string")
    each = {r.region_id: r for r in A.align_regions(regions, f, A.align_pages(pages, f)).collect()}
    assert all((each[f"r{k}"].start_line, each[f"r{k}"].coverage) == (41 + k, 1000) for k in range(10)) and each["r99"].matched == 0


def test_shortlist_against_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    text = lambda n: [rnd.choice("abcd") for _ in range(n)]
    files = [(f"d{k % 2}", f"f{k % 14}" if k < 16 else None, text(rnd.randrange(60))) for k in range(17)]
    pages = [(f"d{k % 2}", f"p{k % 21}", text(rnd.randrange(40))) for k in range(24)] + [("d0", None, text(30)), ("d1", None, text(30)), ("none", "x", text(30))]
    grams = lambda t: {tuple(t[i : i + 3]) for i in range(len(t) - 2)}
    want = {}
    for d, p, t in pages:
        for e, f, u in files:
            if d == e and (n := len(grams(t) & grams(u))):
                want[p, f] = want.get((p, f), 0) + n
    best = set()
    for p in {p for p, _ in want}:
        order = sorted(((-n, f or "", f) for (q, f), n in want.items() if q == p), key=lambda x: x[:2])
        best |= {(p, f, -n, k + 1) for k, (n, _, f) in enumerate(order[:6])}
    a = spark.createDataFrame(pages, "document_id string, page_id string, tokens array<string>")
    b = spark.createDataFrame(files, "document_id string, source_path string, tokens array<string>")
    assert {tuple(r) for r in A.shortlist(a, b).collect()} == best
    # The same counts in small blocks, and with pairs of tokens numbered first.
    monkeypatch.setattr(A, "PAGES", 5)
    monkeypatch.setattr(A, "FILES", 3)
    assert {tuple(r) for r in A.shortlist(a, b).collect()} == best
    table = lambda rows, c: A.pa.table({c: [r[1] for r in rows], "tokens": [r[2] for r in rows], "again": [True] * len(rows)})
    x, y = table([r for r in pages if r[0] == "d0"], "page_id"), table([r for r in files if r[0] == "d0"], "source_path")
    plain = A._overlaps(x, y, 6)
    monkeypatch.setattr(A, "GRAM_KINDS", 2)
    assert plain.num_rows and A._overlaps(x, y, 6).equals(plain)


def test_shortlist_makes_no_row_for_each_shared_phrase(spark):
    """200 pages and 200 files of one text: 40 000 pairs, 4 million shared phrases, of which the plan joins none."""
    t = [str(k) for k in range(102)]
    a = spark.createDataFrame([("d", f"p{k}", t) for k in range(200)], "document_id string, page_id string, tokens array<string>")
    b = spark.createDataFrame([("d", f"f{k:03d}", t) for k in range(200)], "document_id string, source_path string, tokens array<string>")
    got = A.shortlist(a, b)
    assert "gram" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.source_path, r.overlap, r["rank"]) for r in got.collect()} == {(f"f{k:03d}", 100, k + 1) for k in range(6)} and got.count() == 1200


def test_matching_blocks_are_those_of_the_sequence_matcher():
    rnd = random.Random(12)
    for k in range(600):
        a, b = ([rnd.choice("abcdefghijklmnop"[: 2 + k % 14]) for _ in range(rnd.randrange(70))] for _ in range(2))
        if k % 3 == 0:
            b[5:5] = a[10:40]
        want = [tuple(m) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
        assert A._all_matching(a, b) == want, (a, b)
        files = A.pa.table({"source_path": ["f"], "tokens": [a], "lines": A.pa.array([[30 * n for n in range(len(a))]], A.pa.list_(A.pa.int32()))})
        got = A._aligned(A.pa.table({"page_id": ["p"], "tokens": [b], "again": [False]}), files, 6).to_pylist()
        best = A._cluster([m for m in want if m[2] > 1], [30 * n for n in range(len(a))])
        assert not got and not any(n > 2 for *_, n in want) or (got[0]["start_line"], got[0]["end_line"], got[0]["matched_tokens"]) == (best or (None,) * 3)


def test_pages_against_the_sequence_matcher_in_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: [rnd.choice("abcdefgh") for _ in range(n)]
    files = [("d", f"f{k:02d}", text(200), [1 + n // 4 for n in range(200)]) for k in range(15)]
    pages = [("d", f"p{k:02d}", text(20) + files[k % 15][2][60:90] + text(9)) for k in range(30)]
    a, b = spark.createDataFrame(pages, "document_id string, page_id string, tokens array<string>"), spark.createDataFrame(files, "document_id string, source_path string, tokens array<string>, lines array<int>")
    grams = lambda t: {tuple(t[i : i + 3]) for i in range(len(t) - 2)}
    want = set()
    for _, p, t in pages:
        near = sorted(files, key=lambda f: (-len(grams(t) & grams(f[2])), f[1]))[:6]
        each = []
        for _, f, u, lines in near:
            blocks = [m for m in SequenceMatcher(None, u, t, autojunk=False).get_matching_blocks() if m.size > 1]
            x, y, n = A._cluster(blocks, lines)
            each.append((-(n * 1000 // len(t)), f, x, y, n))
        each.sort()
        want.add((p, each[0][1], *each[0][2:], len(t), -each[0][0], -each[1][0]))
    columns = ("page_id", "source_path", "start_line", "end_line", "matched_tokens", "page_tokens", "coverage", "runner_up")
    for most in (1000, 4):
        monkeypatch.setattr(A, "PAGES", most)
        monkeypatch.setattr(A, "FILES", most)
        got = A.align_pages(a, b)
        assert got.columns == list(columns) and {tuple(r) for r in got.collect()} == want


def test_regions_are_located_from_one_grouping(spark):
    rnd = random.Random(10)
    text = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(9)) for _ in range(n))
    files = [(f"d{k % 2}", f"f{k}", "\n".join(text(6) for _ in range(50))) for k in range(6)]
    rows = []
    for k in range(12):
        lines = files[k % 6][2].split("\n")
        rows += [(f"d{k % 2}" if k < 11 else None, f"p{k % 10}", f"r{k:02d}{n}", lines[20 + n] if n else None) for n in range(5)]
    regions = spark.createDataFrame([(d, p, r, r, t) for d, p, r, t in rows], "document_id string, page_id string, region_id string, reading_order string, text string")
    f = A.source_tokens(spark.createDataFrame([*files, ("d0", "bare", ".blank\n\n")], "document_id string, source_path string, text string"), "document_id")
    assert f.count() == 6
    t = A.T.locator_tokens(A.F.coalesce("text", A.F.lit("")))
    each = regions.where("document_id is not null").withColumn("t", t).groupBy("document_id", "page_id")
    pages = each.agg(A.F.flatten(A.F.transform(A.F.array_sort(A.F.collect_list(A.F.struct("region_id", "t"))), lambda x: x["t"])).alias("tokens"))
    want = {tuple(r) for r in A.align_regions(regions, f, A.align_pages(pages, f)).collect()}
    got = A.locate_regions(regions, f)
    assert len(want) == 60 and {tuple(r) for r in got.collect()} == want
    # Regions and sources are read from the cuts alone.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 0
