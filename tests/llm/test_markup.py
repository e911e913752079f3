from __future__ import annotations

from folia.llm import markup as M

SHOWN = [
    ("<p>a</p>", "a"), ("x &amp; y", "x & y"), ("&amp;lt;b", "<b"), ("**bold** x", "bold x"), ("# Title\nt", "Title\nt"), ("[text](a/b.md)", "text"), ("'''b''' x", "b x"), ("[[link|x]] y", "x y"), ("{{term|x}}", "x"), ("== Head ==", "Head"),
    ("\\emph{x} y", "x y"), ("\\begin{verbatim}\n(a)\n\\end{verbatim}", "(a)"), (".section Head", "Head"), ("a\n.lisp\n(b)\n.end_lisp", "a\n(b)"), ("a \x11 b", "a b"), ("\x063x\x06* y", "x y"), ("~~old~~ z", "old z"), ("```lisp\n(a)\n```", "(a)"),
    ("h2. Head\nx", "Head\nx"), ("$in kurz$~\\cite{k7} x", "in kurz x"), ("{\\bf it} is", "it is"), ("a\n.sp 1\nb", "a\nb"), ("a \\leq b", "a ≤ b"),
]
MARKED = [m for m, _ in SHOWN]
CLEAN = ["Press <abort> or <return> now.", "It costs $40 and a cell costs $55.", "n[i] ≤ 3", "Let x_1 * x_2 * x_3 be it.", "(defun foo (a &optional b)\n  `(bar ,a ,@bs))", "#| never |#", "; *old-cell* * 29 * must not be nil", "*oblique-cell* and *x* are special", "a -- b", "'[1 2 3]", "The \\ character quotes the next one", "Of 2 == 3 only one", ""]


def pairs():
    rows = []
    for k in range(6):
        rows += [("host", f"{m} and more {k}" if "\n" not in m else m, f"{p} and more {k}" if "\n" not in m else p) for m, p in SHOWN]
        rows += [("host", c, c) for c in CLEAN]
    return rows


def test_wrappers():
    w = M.fit(pairs())
    for m in MARKED:
        assert w.parse(m, "host") and w.parse(m, None), m
    for c in CLEAN:
        assert not w.parse(c, "host"), c
    assert "#TEXT" in M.expression(w.common) and "(entity)?" in M.expression(w.common)


def test_expressions_have_order_nesting_and_repeats():
    texts = ["<ul><li>a</li><li>b</li></ul>", "<b>x</b> <ul><li>c</li></ul>", "<ul><li><b>d</b></li></ul> <i>e</i>"]
    w = M.fit([("h", t, " ".join(M.re.findall(r">([a-z])<", t))) for t in texts])
    assert M.expression(w.hosts["h"]) == "(tag:b #TEXT)? (tag:ul (tag:li (tag:b #TEXT)? #TEXT)+) (tag:i #TEXT)?"
    # A text without another witness shows order, but no verdict.
    w = M.fit([("h", "<zz>a</zz>", "a"), ("h", "<zz>a</zz><yy>b</yy>", None)])
    assert [g.key for g in w.hosts["h"]] == ["tag:zz", "tag:yy"] and w.hosts["h"][1].dropped == 0


def test_wider_levels_decide_where_a_host_shows_little():
    rows = [(f"h{k}", f"a .{k} <zz>b</zz>", f"a .{k} b") for k in range(9)] + [("own", "<zz>b</zz>", "<zz>b</zz>")] * 20
    w = M.fit(rows)
    assert w.parse("<zz>q</zz>", "h1") and not w.parse("<zz>q</zz>", "own")
    assert not w.parse("<other>q</other>", "h1") and w.parse("<em>q</em>", "h1")


def test_long_tokens():
    w = M.fit(pairs())
    long = "word " * 60
    assert M.clean(f"x [[{long}|shown]] y", None, w) == "x shown y"
    assert M.clean(f"a \\emph{{{long}}} b", None, w).split() == ["a", *long.split(), "b"]


def test_structure_is_kept():
    w = M.fit(pairs())
    assert M.clean("<h2>Head</h2>\n<ul><li>one</li>\n<li>two</li></ul>", None, w).split("\n") == ["## Head", "", "- one", "- two"]
    assert M.clean("\\begin{verbatim}\n(a)\n\\end{verbatim}", None, w) == "```\n(a)\n```"
    assert M.clean(".section Head\ntext\n.sp 1\nmore", None, w).split("\n") == ["## Head", "text", "", "more"]
    assert M.clean("a &lt; b \\leq c", None, w) == "a < b ≤ c"
    assert M.clean("plain", None, w) == "plain"
    assert M.clean("<li>x</li><li>y</li>", None, w) == "- x\n- y"
    assert M.clean("<tr><td>a</td><td>b</td></tr>", None, w).split("\t")[:2] == ["a", "b"]
    assert M.clean("$x = \\frac{1}{4}$ and \\frac{a+b}{c} \\leq d", None, w) == "$x = 1/4$ and (a+b)/c ≤ d"
    assert M.clean("=== Low ===\nt", None, w) == "### Low\nt" and M.clean("\\subsection{A \\& b}\nt", None, w) == "### A & b\nt"


def test_rows(spark):
    rows = [(f"m{k}", "host", m, None, m, "x") for k, m in enumerate(MARKED)] + [(f"c{k}", "host", c, None, c, "x") for k, c in enumerate(CLEAN)]
    rows += [("n", "host", None, "a", None, None), ("m0", "host", MARKED[0], None, None, "again")]
    regions = spark.createDataFrame(rows + [(f"f{k}", h, s, t, None, None) for k, (h, s, t) in enumerate(pairs())], "id string, document_id string, source_text string, ocr_text string, canonical_text string, lines string")
    text = "plain\n\\begin{verbatim}\n(a)\n\\end{verbatim}\nlast <b>x</b>"
    sources = spark.createDataFrame([("p", "host", text), ("q", "host", None)], "source_path string, document_id string, text string")
    spans = [("s1", "p", [1, 1]), ("s2", "p", [2, 2]), ("s3", "p", [3, 3]), ("s4", "p", [4, 99]), ("s5", "p", None), ("s6", "p", [5, 2]), ("s7", "q", [1, 2]), ("s2", "p", [2, 2]), ("s8", "gone", [1, 1])]
    selectors = spark.createDataFrame(spans, "selector_id string, source_path string, source_span array<int>")
    got = {(r.origin, r.case_key) for r in M.found(regions, selectors, sources).collect() if not r.case_key.startswith("f")}
    assert got == {("region", f"m{k}") for k in range(len(MARKED))} | {("selector", s) for s in ("s2", "s4")}
    assert M.found(regions.where("false"), selectors.where("false"), sources.where("false")).collect() == []
    c = {r.id: r.clean_text for r in M.cleaned(regions.where("id in ('n', 'c0')")).collect()}
    assert c == {"n": None, "c0": CLEAN[0]}


def test_spans_are_cleaned(spark):
    regions = spark.createDataFrame([(f"f{k}", h, s, t, None) for k, (h, s, t) in enumerate(pairs())] + [("n", "host", None, None, None)], "id string, document_id string, source_text string, ocr_text string, canonical_text string")
    text = ".section Head\nplain\n\\begin{verbatim}\n(a &optional b)\n\\end{verbatim}\nsee <!-- one\ntwo --> x &amp; y\nlast <b>x</b>"
    sources = spark.createDataFrame([("p", "host", text), ("q", "host", None), ("r", "host", "no mark\n")], "source_path string, document_id string, text string")
    want = {
        "s1": ([1, 2], "p", "## Head\nplain"), "s2": ([3, 5], "p", "```\n(a &optional b)\n```"), "s3": ([4, 4], "p", "(a &optional b)"), "s4": ([8, 99], "p", "last x"), "s5": (None, "p", None), "s6": ([5, 2], "p", None),
        "s7": ([1, 2], "q", None), "s8": ([1, 1], "gone", None), "s9": ([7, 7], "p", " x & y"), "s10": ([6, 6], "p", "see"), "s11": ([50, 60], "p", None), "s12": ([1, 1], "r", "no mark"), "s13": ([2, 2], "r", ""), "s14": ([], "p", None), "s15": ([1, 1], None, None),
    }
    rows = [(k, p, s) for k, (s, p, _) in want.items()]
    selectors = spark.createDataFrame(rows + rows[:4], "selector_id string, source_path string, source_span array<int>")
    got = M.cleaned_all(regions, selectors, sources).collect()
    assert sorted((r.case_key, r.clean_text) for r in got if r.origin == "selector") == sorted(((k, t) for k, (_, _, t) in want.items()), key=lambda x: x[0])
    assert sum(r.origin == "region" for r in got) == regions.count()
    assert M.cleaned_all(regions.where("false"), selectors.where("false"), sources.where("false")).collect() == []
