from __future__ import annotations

import random
import re

from test_operators import plain_counts

from folia import queries_reference as Q
from folia.operators import alignment

HEAD = re.compile(r"^\s*(part|chapter|section)\s+([A-Za-z0-9.IVXLC]+)\b", re.I)
RULES = (
    ("list-item", re.compile(r"^\s*(?:[-*•]|\d+[.)]|[A-Za-z][.)])\s+").match),
    ("note", re.compile(r"^\s*(?:note|\d+[.)])\s", re.I).match),
    ("terminal", re.compile(r"^\s*(?:[$>#]|[A-Za-z0-9_.-]+>)\s").match),
    ("code", lambda t: t.startswith((" ", "\t")) or "(" in t and ")" in t),
    ("index", re.compile(r"^.+,\s*\d+(?:\s*,\s*\d+)*\s*$").match),
    ("cross-reference", re.compile(r"\b(?:see|chapter|section|appendix|figure|table)\s+[A-Za-z0-9.IVXLC]+", re.I).search),
    ("math", re.compile(r"(?:[=≈≠≤≥±×÷]|\b(?:sin|cos|log|lim)\b|\$[^$]+\$)").search),
    ("section", lambda t: t.isupper() and len(t.split()) <= 12),
)


def kind(t, k):
    """The rules over a whole text, one after the other."""
    if m := HEAD.match(t):
        return m[1].lower()
    if re.match(r"^\s*(?:fig(?:ure)?|table)\s+\d+", t, re.I):
        return "caption"
    if k == "figure" or t.strip().lower().startswith("figure "):
        return "figure"
    if k == "table" or "\t" in t or t.count("|") >= 2:
        return "table"
    return next((name for name, test in RULES if test(t) or name == k == "code"), "paragraph")


LINES = [
    "Plain words", "(defun foo (x))", "see Chapter 4 for it", "x = y + 1", "a | b | c", "one|", "cos phi", "APPENDIX", "ÜBER ALLES", "A, 12, 15", "12,", "7", "", " ", " indented", "Section 2.1", "section 2.", "part ..", "Part .a", "chapter 1_",
    "Figure 3", "figure three", "Figure ", "- item", "1. item", "note that", "Note x", "lisp> (a", "b)", "$ ls", "costs $40", "and $50", "unseen x", "ſee x", "\rcr", "A  B, 3", "١٢) x", "\U0001d400 x", "ª", "ǅ A", "A B C D E F G H I J K L M",
]


def test_kinds_of_whole_texts(spark, tmp_path):
    rnd = random.Random(7)
    texts = [*LINES, "Plain words\nsee Chapter 4 for it", "Plain words\n(a b)", "Plain words\nx = 1", "a|\nb|", "A,\n12,\n15\n", "A\nB, 12", "(a\nb)", "$a\nb$"]
    texts += ["\n".join(rnd.choice(LINES) for _ in range(rnd.randrange(2, 5))) for _ in range(600)]
    rows = [("d", f"r{i}", rnd.choice(["body", "body", "code", "table", "figure", None]) if i > 60 else "body", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "document_id string, id string, kind string, source_text string").selectExpr("*", "cast(null as string) as ocr_text", "cast(null as string) as canonical_text", "timestamp'2020-01-01' as updated_at")
    df.write.parquet(str(tmp_path / "project_regions.parquet"))
    want = {i: kind(t, k) for _, i, k, t in rows}
    got = {r.id: r.semantic_kind for r in Q.region_kind(spark, str(tmp_path)).collect()}
    assert {i: (got[i], w, rows[int(i[1:])][3]) for i, w in want.items() if got.get(i) != w} == {}
    names = {"body": "paragraph", "list": "list-item"}
    f1 = {r.kind: (r.tp, r.fp, r.fn) for r in Q.semantic_macro_f1(spark, str(tmp_path)).collect()}
    true = {i: names.get(k, k) for _, i, k, _ in rows if k}
    assert None in f1
    for k, (tp, fp, fn) in ((k, v) for k, v in f1.items() if k):
        assert tp == sum(true.get(i) == w == k for i, w in want.items()) and tp + fp == sum(w == k for w in want.values()) and tp + fn == sum(w == k for w in true.values())


def test_signs_beyond_ascii_are_compared(spark, tmp_path):
    truth = ["café", "αβγ δ", "“x”", "наука один", "日本語 text", "a\U0001f600b", "plain", "é", "ключ x"]
    other = ["cafè", "абв δ", "—x—", "науна два", "日本话 text", "a\U0001f601b", "plain", "e", "ключ y"]
    kinds = ["body", "code", "exact"]
    rows = [("d", "p", f"r{k}", kinds[k % 3], t, o, s) for k, (t, o, s) in enumerate(zip(truth, other, [*other[1:], None]))]
    df = spark.createDataFrame(rows, "document_id string, page_id string, id string, kind string, canonical_text string, ocr_text string, source_text string")
    df.selectExpr("*", "timestamp'2020-01-01' as updated_at").write.parquet(str(tmp_path / "project_regions.parquet"))
    run = lambda f: f(spark, str(tmp_path)).collect()
    pairs = [(e, r[3], r[4], (r[i] or "")) for r in rows for e, i in (("ocr", 5), ("source", 6))]
    errors = lambda a, b: sum(plain_counts(a, b)[:3])
    want = {e: sum(errors(a, b) for g, _, a, b in pairs if g == e) for e in ("ocr", "source")}
    assert {r.engine: r.errors for r in run(Q.cer_by_engine)} == want
    assert {r.engine: r.distance for r in run(Q.edit_breakdown)} == want
    assert {r.engine: r.errors for r in run(Q.quality_cube) if r.kind is None and r.document_id is None} == want
    by = {(e, k): sum(errors(a, b) for g, h, a, b in pairs if (g, h) == (e, k)) for e in want for k in kinds}
    units = {(e, k): sum(len(a) for g, h, a, _ in pairs if (g, h) == (e, k)) for e in want for k in kinds}
    assert {(r.engine, r.kind): (r.errors, r.units) for r in run(Q.wilson_audit)} == {x: (n, units[x]) for x, n in by.items()}
    both = {r[2]: (r[6], r[5]) for r in rows if r[6] is not None}
    assert {r.id: r.similarity for r in run(Q.text_similarity)} == {i: (max(len(a), len(b)) - errors(a, b)) * 1000 // max(len(a), len(b)) for i, (a, b) in both.items()}
    assert sum(r.matching for r in run(Q.projection_match)) == sum(a == b for _, _, a, b in pairs)
    assert {r.engine: r.exact_tokens for r in run(Q.code_token_exactness)} == {e: sum(x == y for g, k, a, b in pairs if (g, k) == (e, "code") for x, y in zip(a.split(), b.split())) for e in want}
    script = {r.engine: (r.insertions, r.deletions, r.substitutions, r.correct) for r in run(Q.edit_script_counts)}
    assert script == {e: tuple(map(sum, zip(*(plain_counts(a, b) for g, _, a, b in pairs if g == e)))) for e in want}
    words = {}
    for e, k, a, b in pairs:
        words[e, k] = words.get((e, k), 0) + errors(a.split(), b.split())
    assert {(r.engine, r.kind): r.insertions + r.deletions + r.substitutions for r in run(Q.wer_by_engine)} == words


def test_edit_scripts_at_any_size(monkeypatch):
    rnd = random.Random(3)
    texts = [["".join(rnd.choice("ab") for _ in range(rnd.randrange(24))) for _ in range(2)] for _ in range(300)]
    for cells, saved in ((4_000_000, 32), (40, 2), (20, 3), (1, 2)):
        monkeypatch.setattr(alignment, "MAX_CELLS", cells)
        monkeypatch.setattr(alignment, "SAVED_ROWS", saved)
        assert [alignment.edit_counts(a, b) for a, b in texts] == [plain_counts(a, b) for a, b in texts]
