"""Registered queries of the engine's own operators, each with the SQL that says the same.

Every query reads its whole tables. Where SQL cannot say an operator, it is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import digests
from folia.functions import text as T
from folia.operators import evaluation as E
from folia.operators import alignment, graphs, hierarchy, layout, lines, selection
from folia.queries_core import _CHAIN
from folia.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- shared inputs -----------------------------------------------------------------------------------------


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per review region."""
    dash = lambda c: F.coalesce(c, F.lit("-"))
    texts = F.sha2(F.concat_ws("\x1f", dash("source_text"), dash("ocr_text"), dash("canonical_text")), 256)
    return E.current_rows(table(spark, sf_dir, "project_regions"), "id", F.struct("updated_at", texts))


_REG = "reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, coalesce(sha256(coalesce(source_text, '-') || chr(31) || coalesce(ocr_text, '-') || chr(31) || coalesce(canonical_text, '-')), '') DESC) AS rn FROM project_regions) WHERE rn = 1)"


def _truth(regions: DataFrame) -> DataFrame:
    return regions.where("canonical_text is not null").select(F.col("id").alias("region_id"), "kind", "document_id", F.col("canonical_text").alias("text"))


def _predictions(regions: DataFrame) -> DataFrame:
    engines = F.array(F.struct(F.lit("ocr").alias("engine"), F.col("ocr_text").alias("t")), F.struct(F.lit("source").alias("engine"), F.col("source_text").alias("t")))
    each = regions.select(F.col("id").alias("region_id"), F.explode(engines).alias("e")).where("e.t is not null")
    return each.select("region_id", "e.engine", F.col("e.t").alias("text"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth with each engine's text, from one scan: both witnesses lie in the region's own row."""
    regions = _regions(spark, sf_dir)
    engines = F.array(F.struct(F.lit("ocr").alias("engine"), F.col("ocr_text").alias("t")), F.struct(F.lit("source").alias("engine"), F.col("source_text").alias("t")))
    each = regions.where("canonical_text is not null").select(F.col("id").alias("region_id"), "kind", "document_id", F.col("canonical_text").alias("text"), F.explode(engines).alias("e"))
    return each.select("region_id", "kind", "document_id", "text", "e.engine", F.coalesce("e.t", F.lit("")).alias("predicted"))


def _distance(a: str, b: str) -> str:
    """Edit distance of code points: the SQL's own one counts bytes, so the signs of a pair are numbered by single bytes first."""
    chars = lambda x: f"regexp_extract_all({x}, '(?s).')"
    code = lambda x: f"array_to_string(list_transform({chars(x)}, lambda c: chr(list_position(signs, c)::INT)), '')"
    return f"(CASE WHEN {a} = {b} THEN 0 ELSE (SELECT levenshtein({code(a)}, {code(b)}) FROM (SELECT list_distinct({chars(f'{a} || {b}')}) AS signs)) END)"


_D = _distance("text", "predicted")
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]".replace("\\\\", "\\")
_PAIRS = (
    _REG
    + f""", pair0 AS (SELECT id AS region_id, kind, document_id, canonical_text AS text, engine, coalesce(t, '') AS predicted
  FROM (SELECT *, 'ocr' AS engine, ocr_text AS t FROM reg UNION ALL SELECT *, 'source' AS engine, source_text AS t FROM reg) WHERE canonical_text IS NOT NULL),
  pairs AS (SELECT *, {_D} AS distance FROM pair0)"""
)

_BOX_SELECT = "page_id, id, kind, box.x0 AS x0, box.y0 AS y0, box.x1 AS x1, box.y1 AS y1, confidence_milli, source_region_ids"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per proposal: that of the highest revision, then of the latest load."""
    df = table(spark, sf_dir, "region_proposals")
    last = df.groupBy("id").agg(F.max_by(F.struct("page_id", "kind", "box", "confidence_milli", "source_region_ids"), F.struct("revision", "loaded_at")).alias("r"))
    return last.select("r.page_id", "id", "r.kind", "r.box.x0", "r.box.y0", "r.box.x1", "r.box.y1", "r.confidence_milli", "r.source_region_ids")


_BOX = f"bx AS (SELECT {_BOX_SELECT} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY revision DESC, loaded_at DESC) AS rn FROM region_proposals) WHERE rn = 1)"
_AREA = "(least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_MEET = "a.page_id = b.page_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1"

# --- evaluation --------------------------------------------------------------------------------------------


@query(f"WITH {_PAIRS} SELECT engine, sum(distance)::BIGINT AS errors, sum(length(text))::BIGINT AS reference_units, count(*) AS regions, sum(distance) / sum(length(text)) AS error_rate FROM pairs GROUP BY engine")
def cer_by_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.character_errors(_pairs(spark, sf_dir), "engine")


@query(f"WITH {_PAIRS} SELECT engine, kind, document_id, sum(distance)::BIGINT AS errors, sum(length(text))::BIGINT AS reference_units, count(*) AS regions FROM pairs GROUP BY GROUPING SETS ((engine, kind), (engine, document_id), (engine))")
def quality_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.quality_cube(_pairs(spark, sf_dir))


@query(f"""WITH {_REG}, e AS (SELECT id, document_id, canonical_text, 'ocr' AS engine, ocr_text AS t FROM reg UNION ALL SELECT id, document_id, canonical_text, 'source', source_text FROM reg)
SELECT engine, document_id, count(*) AS omitted, sum(length(canonical_text))::BIGINT AS omitted_characters FROM e WHERE canonical_text IS NOT NULL AND t IS NULL GROUP BY engine, document_id""")
def omission_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    return E.omissions(_truth(r), _predictions(r), "document_id")


@query(f"""WITH {_PAIRS}, t AS (SELECT engine, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(predicted, '{_SPACE}+'), lambda x: x <> '') AS b FROM pairs WHERE kind = 'code')
SELECT engine, sum(len(a))::BIGINT AS reference_tokens, sum(len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i])))::BIGINT AS exact_tokens, sum(greatest(len(a) - len(b), 0))::BIGINT AS omitted_tokens, sum(greatest(len(b) - len(a), 0))::BIGINT AS extra_tokens FROM t GROUP BY engine""")
def code_token_exactness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.code_tokens(_pairs(spark, sf_dir).where("kind = 'code'"), "engine")


@query(f"""WITH {_REG}, p AS (SELECT id, source_text AS text, ocr_text AS predicted FROM reg WHERE source_text IS NOT NULL AND ocr_text IS NOT NULL)
SELECT id, CASE WHEN greatest(length(text), length(predicted)) = 0 THEN 1000 ELSE (greatest(length(text), length(predicted)) - {_D}) * 1000 // greatest(length(text), length(predicted)) END::BIGINT AS similarity FROM p""")
def text_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).where("source_text is not null and ocr_text is not null")
    return r.select("id", T.similarity_milli(F.col("source_text"), F.col("ocr_text")).alias("similarity"))


@query(f"""WITH {_PAIRS}, m AS (SELECT CASE WHEN kind IN ('body', 'definition', 'section') THEN 'prose' WHEN kind = 'code' THEN 'code' ELSE 'exact' END AS policy, text AS a, predicted AS b FROM pairs)
SELECT policy, count(*) AS pairs, count(*) FILTER (WHERE CASE policy WHEN 'prose' THEN trim(regexp_replace(a, '{_SPACE}+', ' ', 'g')) = trim(regexp_replace(b, '{_SPACE}+', ' ', 'g')) WHEN 'code' THEN regexp_replace(a, '(?m)^[ \\t]+', '', 'g') = regexp_replace(b, '(?m)^[ \\t]+', '', 'g') ELSE a = b END) AS matching FROM m GROUP BY policy""")
def projection_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.projection_matches(_pairs(spark, sf_dir))


@query(f"""WITH {_REG} SELECT kind, count(*) FILTER (WHERE hit) AS tp, count(*) FILTER (WHERE generated_box IS NOT NULL AND NOT hit) AS fp, count(*) FILTER (WHERE reference_box IS NOT NULL AND NOT hit) AS fn FROM (
 SELECT kind, reference_box, generated_box, coalesce(i >= 0.5 * (reference_box[3] * reference_box[4] + generated_box[3] * generated_box[4] - i), false) AS hit FROM (
  SELECT *, greatest(least(reference_box[1] + reference_box[3], generated_box[1] + generated_box[3]) - greatest(reference_box[1], generated_box[1]), 0.0) * greatest(least(reference_box[2] + reference_box[4], generated_box[2] + generated_box[4]) - greatest(reference_box[2], generated_box[2]), 0.0) + CASE WHEN reference_box IS NULL OR generated_box IS NULL THEN NULL ELSE 0 END AS i FROM reg)) GROUP BY kind""")
def box_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.box_detection(_regions(spark, sf_dir))


_L = lines
# The patterns of folia.operators.lines in the SQL's dialect, which has no look-around and calls its classes otherwise.
_WORD, _NOT_WORD = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
_KIND = f"""CASE WHEN regexp_matches(t, '(?i)^{_SPACE}*(part|chapter|section){_SPACE}+[A-Za-z0-9.]*([A-Za-z0-9]({_NOT_WORD}|$)|\\.{_WORD})') THEN lower(regexp_extract(t, '(?i)^{_SPACE}*(part|chapter|section)', 1))
 WHEN regexp_matches(t, '(?i)^{_SPACE}*(fig(ure)?|table){_SPACE}+\\p{{Nd}}') THEN 'caption' WHEN k = 'figure' OR regexp_matches(t, '(?i)^{_SPACE}*figure (?s:.*)[^\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]') THEN 'figure'
 WHEN k = 'table' OR contains(t, chr(9)) OR length(t) - length(replace(t, '|', '')) >= 2 THEN 'table' WHEN regexp_matches(t, '^{_SPACE}*([-*•]|\\p{{Nd}}+[.)]|[A-Za-z][.)]){_SPACE}') THEN 'list-item' WHEN regexp_matches(t, '(?i)^{_SPACE}*(note|\\p{{Nd}}+[.)]){_SPACE}') THEN 'note'
 WHEN regexp_matches(t, '^{_SPACE}*([$>#]|[A-Za-z0-9_.-]+>){_SPACE}') THEN 'terminal' WHEN k = 'code' OR starts_with(t, ' ') OR (contains(t, '(') AND contains(t, ')')) THEN 'code' WHEN regexp_matches(t, '^.+,{_SPACE}*\\p{{Nd}}+({_SPACE}*,{_SPACE}*\\p{{Nd}}+)*{_SPACE}*$') THEN 'index'
 WHEN regexp_matches(t, '(?i)(^|{_NOT_WORD})(see|chapter|section|appendix|figure|table){_SPACE}+[A-Za-z0-9.]') THEN 'cross-reference' WHEN regexp_matches(t, '[=≈≠≤≥±×÷]|(^|{_NOT_WORD})(sin|cos|log|lim)({_NOT_WORD}|$)|\\$[^$]+\\$') THEN 'math'
 WHEN regexp_matches(t, '\\p{{Lu}}') AND NOT regexp_matches(t, '[\\p{{Ll}}\\p{{Lt}}ªº]') AND len(list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '')) <= 12 THEN 'section' ELSE 'paragraph' END"""


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).where("source_text is not null")
    return r.select("id", "kind", lines.semantic_kind(F.col("source_text"), F.coalesce("kind", F.lit("unknown"))).alias("semantic_kind"))


_KINDS = _REG + """, kd AS (SELECT id, kind, """ + _KIND + """ AS semantic_kind FROM (SELECT id, kind, coalesce(kind, 'unknown') AS k, source_text AS t FROM reg WHERE source_text IS NOT NULL))"""


@query(f"WITH {_KINDS} SELECT id, semantic_kind FROM kd")
def region_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds(spark, sf_dir).select("id", "semantic_kind")


@query(f"""WITH {_KINDS}, t AS (SELECT DISTINCT id, CASE kind WHEN 'body' THEN 'paragraph' WHEN 'list' THEN 'list-item' ELSE kind END AS kind FROM kd WHERE kind IS NOT NULL), f AS (SELECT DISTINCT id, semantic_kind AS kind FROM kd),
b AS (SELECT coalesce(t.kind, f.kind) AS kind, t.id IS NOT NULL AS it, f.id IS NOT NULL AS if_ FROM t FULL JOIN f ON t.id = f.id AND t.kind = f.kind),
s AS (SELECT kind, count(*) FILTER (WHERE it AND if_) AS tp, count(*) FILTER (WHERE NOT it) AS fp, count(*) FILTER (WHERE NOT if_) AS fn, 2.0::DOUBLE * count(*) FILTER (WHERE it AND if_) / (2 * count(*) FILTER (WHERE it AND if_) + count(*) FILTER (WHERE NOT it) + count(*) FILTER (WHERE NOT if_)) AS f1 FROM b GROUP BY kind)
SELECT kind, tp, fp, fn, round(f1, 12) AS f1 FROM s UNION ALL SELECT NULL, sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT, round(avg(f1), 12) FROM s""")
def semantic_macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label, and in the row without a label the unweighted mean over all labels."""
    k = _kinds(spark, sf_dir)
    label = F.when(F.col("kind") == "body", "paragraph").when(F.col("kind") == "list", "list-item").otherwise(F.col("kind"))
    truth = k.where("kind is not null").select(F.col("id").alias("region_id"), label.alias("kind"))
    each = E.macro_f1(truth, k.select(F.col("id").alias("region_id"), F.col("semantic_kind").alias("kind")))
    return each.withColumn("f1", F.round("f1", 12))


# --- lines of documents ------------------------------------------------------------------------------------

_LINES = "ln AS (SELECT doc_id, manual_id, page_index, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"
_RISK = ", ".join(
    f"CASE WHEN {test} THEN '{code}' END"
    for code, test in (
        ("IDENTIFIER", f"regexp_matches(line, '{_L.IDENTIFIER}')"),
        ("NUMBER", f"regexp_matches(line, '{_L.NUMBER}')"),
        ("KEY_NAME", f"regexp_matches(line, '{_L.KEY}')"),
        ("EQUATION", f"regexp_matches(line, '{_L.EQUATION}')"),
        ("PUNCTUATION", r"regexp_matches(line, '\p{P}')"),
        ("SYMBOL", r"regexp_matches(line, '[^\p{L}\p{N}\p{P}\p{Z}\s\x0b\x1c-\x1f\x{85}]')"),
        ("LISP_TOKEN", r"regexp_matches(line, '[()'']')"),
        ("UNRESOLVED_GLYPH", "regexp_matches(line, '[�□]')"),
        ("UNEXPECTED_UNICODE", r"regexp_matches(line, '[\x00-\x08\x0b\x0c\x0e-\x1f]|[^\x00-\x7f]')"),
        ("HYPHENATION_AMBIGUITY", "ends_with(line, '-')"),
    )
)


@query(f"WITH {_LINES} SELECT doc_id, code, count(*) AS n_lines FROM (SELECT doc_id, unnest([{_RISK}]) AS code FROM ln) WHERE code IS NOT NULL GROUP BY doc_id, code")
def line_risk_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.risk_counts(table(spark, sf_dir, "documents"))


@query(f"WITH {_LINES} SELECT doc_id, line, count(*) AS copies, min(pos)::BIGINT AS first_pos FROM ln WHERE trim(line) <> '' GROUP BY doc_id, line HAVING count(*) > 1")
def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.duplicate_lines(table(spark, sf_dir, "documents"))


@query(f"WITH {_LINES} SELECT manual_id, trim(line) AS line, count(DISTINCT page_index) AS pages FROM ln WHERE trim(line) <> '' AND manual_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT page_index) > 1")
def running_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.running_matter(table(spark, sf_dir, "documents"))


@query("""SELECT id, text_field, max(length(t) - length(replace(t, chr(160), '')))::BIGINT AS replacements FROM (SELECT id, 'source_text' AS text_field, source_text AS t FROM project_regions UNION ALL SELECT id, 'ocr_text', ocr_text FROM project_regions)
 WHERE length(t) > length(replace(t, chr(160), '')) GROUP BY id, text_field""")
def normalization_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.blank_suggestions(table(spark, sf_dir, "project_regions"), "source_text", "ocr_text")


@query(r"""WITH sl AS (SELECT source_path, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT source_path, string_split(text, chr(10)) AS l FROM sources WHERE text IS NOT NULL)),
h AS (SELECT source_path, pos, CASE k WHEN 'chapter' THEN 1 WHEN 'section' THEN 2 ELSE 3 END AS level FROM (SELECT *, regexp_extract(line, '^\.(chapter|section|subsection)( |$)', 1) AS k FROM sl) WHERE k <> '')
SELECT * FROM (SELECT source_path, pos::BIGINT AS pos, level::BIGINT AS level, lag(level::BIGINT) OVER (PARTITION BY source_path ORDER BY pos) AS previous FROM h) WHERE level > previous + 1""")
def hierarchy_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subsections that follow a chapter without a section between them."""
    heads = lines.section_numbers(table(spark, sf_dir, "sources"))
    level = F.when(F.col("kind") == "chapter", 1).when(F.col("kind") == "section", 2).otherwise(3).cast("bigint")
    return lines.hierarchy_gaps(heads.select("source_path", F.col("line_no").alias("pos"), level.alias("level")), "source_path")


@query(r"""WITH sl AS (SELECT source_path, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT source_path, string_split(text, chr(10)) AS l FROM sources WHERE text IS NOT NULL)),
h AS (SELECT source_path, line_no, regexp_extract(line, '^\.(chapter|section|subsection)( |$)', 1) AS kind FROM sl WHERE regexp_matches(line, '^\.(chapter|section|subsection)( |$)')),
c AS (SELECT *, sum((kind = 'chapter')::INT) OVER (PARTITION BY source_path ORDER BY line_no) AS c FROM h),
s AS (SELECT *, sum((kind = 'section')::INT) OVER (PARTITION BY source_path, c ORDER BY line_no) AS s FROM c),
u AS (SELECT *, sum((kind = 'subsection')::INT) OVER (PARTITION BY source_path, c, s ORDER BY line_no) AS u FROM s)
SELECT source_path, line_no, kind, CASE kind WHEN 'chapter' THEN c::VARCHAR WHEN 'section' THEN c || '.' || s ELSE c || '.' || s || '.' || u END AS number FROM u""")
def section_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.section_numbers(table(spark, sf_dir, "sources"))


@query(f"""WITH {_REG} SELECT id, replace(replace(replace(replace(replace(regexp_replace(regexp_replace(source_text, '(?i)<br[^<>]*>|</(?:div|li|p|pre)\\s*>', chr(10), 'g'), '<[^<>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text FROM reg WHERE source_text IS NOT NULL""")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regions(spark, sf_dir).where("source_text is not null").select("id", lines.tagless(F.col("source_text")).alias("text"))


@query(f"""WITH {_REG}, t AS (SELECT id, regexp_extract_all(replace(replace(lower(source_text), '≥', '>='), '≤', '<='), '[a-z0-9]+|>=|<=|//|\\\\\\\\|[+*/=<>^-]') AS k FROM reg WHERE source_text IS NOT NULL)
SELECT id, len(k) AS n_tokens, CASE WHEN len(k) < 3 THEN 0 ELSE len(list_distinct(list_transform(range(1, len(k) - 1), lambda i: k[i] || chr(31) || k[i + 1] || chr(31) || k[i + 2]))) END AS n_ngrams FROM t""")
def locator_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = T.locator_tokens(F.col("source_text"))
    r = _regions(spark, sf_dir).where("source_text is not null").select("id", k.alias("k"))
    return r.select("id", F.size("k").cast("bigint").alias("n_tokens"), F.size(T.ngrams(F.col("k"))).cast("bigint").alias("n_ngrams"))


# --- layout ------------------------------------------------------------------------------------------------


@query(f"WITH {_BOX} SELECT a.page_id, a.id AS left_id, b.id AS right_id, ({_AREA}) * 1000 // ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_AREA}) AS iou FROM bx a JOIN bx b ON {_MEET} AND a.kind = b.kind AND a.id < b.id WHERE ({_AREA}) * 1000 // ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_AREA}) >= 500")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.iou_pairs(_boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1"))


@query(f"WITH {_BOX} SELECT DISTINCT a.page_id, a.id FROM bx a JOIN bx b ON {_MEET} AND b.id < a.id")
def box_overlap_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.overlap_findings(_boxes(spark, sf_dir).select("page_id", "id", "x0", "y0", "x1", "y1"))


_LEAVES, _PARENTS = ("text", "paragraph", "list-item", "table-cell", "equation", "code"), ("column", "table", "list", "figure", "callout")


@query(f"""WITH {_BOX}, m AS (SELECT a.id AS line_id, b.id AS region_id, {_AREA} AS s FROM bx a JOIN bx b ON {_MEET} WHERE a.kind IN {_LEAVES} AND b.kind IN {_PARENTS}), r AS (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY s DESC, region_id) AS rn FROM m)
SELECT bx.page_id, bx.id AS line_id, r.region_id, coalesce(r.s, 0)::BIGINT AS shared_area FROM bx LEFT JOIN r ON r.line_id = bx.id AND rn = 1 WHERE bx.kind IN {_LEAVES}""")
def line_region_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1")
    return layout.assign_lines(b.where(F.col("kind").isin(*_LEAVES)).drop("kind"), b.where(F.col("kind").isin(*_PARENTS)).drop("kind"))


@query(f"""WITH {_BOX}, m AS (SELECT a.id, b.id AS pid FROM bx a JOIN bx b ON {_MEET} AND b.x0 <= a.x0 AND b.y0 <= a.y0 AND b.x1 >= a.x1 AND b.y1 >= a.y1 AND a.id <> b.id WHERE a.kind IN {_LEAVES} AND b.kind IN {_PARENTS}), g AS (SELECT id, count(*) AS n, min(pid) AS one FROM m GROUP BY id)
SELECT bx.page_id, bx.id, coalesce(n, 0) AS n_candidates, CASE WHEN n = 1 THEN one END AS parent_id FROM bx LEFT JOIN g USING (id) WHERE kind IN {_LEAVES}""")
def containment_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1")
    return layout.containing_parents(b.where(F.col("kind").isin(*_LEAVES)).drop("kind"), b.where(F.col("kind").isin(*_PARENTS)).drop("kind"))


@query(f"""WITH {_BOX}, e AS (SELECT page_id, id AS source_id, x0, x1, y0, y1, lead(id) OVER w AS target_id, lead(x0) OVER w AS nx0, lead(y0) OVER w AS ny0, lead(y1) OVER w AS ny1 FROM bx WINDOW w AS (PARTITION BY page_id ORDER BY x0, y0, id))
SELECT page_id, source_id, target_id, nx0 < x1 AND ny0 < y1 AND y0 < ny1 AS ambiguous FROM e WHERE target_id IS NOT NULL""")
def reading_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_edges(_boxes(spark, sf_dir))


@query(f"""WITH {_BOX}, r AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY x0, y0, id) AS t, row_number() OVER (PARTITION BY page_id ORDER BY y0, x0, id) AS p FROM bx)
SELECT page_id, coalesce(c, 0)::BIGINT AS correct_pairs, n * (n - 1) // 2 AS total_pairs FROM (SELECT page_id, count(*) AS n FROM r GROUP BY page_id) LEFT JOIN (SELECT a.page_id, count(*) FILTER (WHERE a.p < b.p) AS c FROM r a JOIN r b ON a.page_id = b.page_id AND a.t < b.t GROUP BY a.page_id) USING (page_id)""")
def reading_order_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.order_accuracy(_boxes(spark, sf_dir).select("page_id", "id", "x0", "y0"))


@query(f"WITH {_BOX} SELECT page_id, kind, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_regions, avg(confidence_milli) AS mean_confidence FROM bx GROUP BY page_id, kind")
def union_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.union_boxes(_boxes(spark, sf_dir), "page_id", "kind")


@query(f"""WITH {_BOX}, v AS (SELECT * FROM bx WHERE x1 > x0 AND y1 > y0), e AS (SELECT DISTINCT page_id, unnest([x0, x1]) AS x FROM v), s AS (SELECT page_id, x, lead(x) OVER (PARTITION BY page_id ORDER BY x) AS nx FROM e),
i AS (SELECT s.page_id, s.x, s.nx, v.y0, v.y1, coalesce(max(v.y1) OVER (PARTITION BY s.page_id, s.x ORDER BY v.y0, v.y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v.y0) AS reach FROM s JOIN v ON v.page_id = s.page_id AND v.x0 <= s.x AND v.x1 >= s.nx WHERE s.nx IS NOT NULL)
SELECT page_id, sum(greatest(y1 - greatest(reach, y0), 0) * (nx - x))::BIGINT AS area FROM i GROUP BY 1""")
def raster_union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.union_area(_boxes(spark, sf_dir).select("page_id", "x0", "y0", "x1", "y1"))


@query(f"WITH {_BOX} SELECT page_id, source_id, count(DISTINCT id) AS n FROM (SELECT page_id, id, unnest(source_region_ids) AS source_id FROM bx) GROUP BY page_id, source_id HAVING count(DISTINCT id) > 1")
def coverage_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.coverage(_boxes(spark, sf_dir))


@query(f"WITH {_BOX}, c AS (SELECT kind, confidence_milli AS v FROM bx WHERE confidence_milli IS NOT NULL) SELECT kind, quantile_disc(v, 0.95) AS percentile, count(*) AS n FROM c GROUP BY kind")
def confidence_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.percentiles(_boxes(spark, sf_dir), "kind", "confidence_milli")


# --- selection, references, ledgers ------------------------------------------------------------------------


@query("SELECT page_class, lang, doc_id, row_number() OVER (PARTITION BY page_class, lang ORDER BY doc_id) AS rank FROM documents QUALIFY rank <= 5")
def stratified_page_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("page_class", "lang", "doc_id")
    return selection.top_per_stratum(d, ["page_class", "lang"], ["doc_id"], 5)


@query("""WITH p AS (SELECT manual_id, page_index::VARCHAR AS page_key FROM documents WHERE manual_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY manual_id ORDER BY sha256(manual_id || chr(31) || page_key), page_key) AS r, count(*) OVER (PARTITION BY manual_id) AS n FROM p)
SELECT manual_id, page_key FROM r WHERE r <= ceil(n * 10 / 100)""")
def second_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("manual_id is not null and page_index is not null")
    return selection.second_review_sample(d.select("manual_id", F.col("page_index").cast("string").alias("page_key")).distinct(), group="manual_id")


@query("""WITH l AS (SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice AS size, l_discount AS error FROM lineitem)
SELECT DISTINCT l_partkey, size, error FROM l a WHERE NOT EXISTS (SELECT 1 FROM l b WHERE a.l_partkey = b.l_partkey AND ((b.size < a.size AND b.error <= a.error) OR (b.size <= a.size AND b.error < a.error)))""")
def codec_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_extendedprice").alias("size"), F.col("l_discount").alias("error"))
    return selection.pareto_frontier(d, ["l_partkey"], "size", "error")


@query("""WITH s AS (SELECT DISTINCT source_path, source_span[1] AS a, source_span[2] AS b FROM source_selectors WHERE source_span[1] <= source_span[2]), o AS (SELECT *, CASE WHEN coalesce(a - max(b) OVER (PARTITION BY source_path ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 20, true) THEN 1 ELSE 0 END AS f FROM s),
c AS (SELECT *, sum(f) OVER (PARTITION BY source_path ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cluster FROM o) SELECT source_path, cluster::BIGINT AS cluster, min(a)::BIGINT AS first, max(b)::BIGINT AS last, count(*) AS spans FROM c GROUP BY 1, 2""")
def cluster_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "source_selectors").where("source_span[0] <= source_span[1]").select("source_path", F.col("source_span")[0].alias("a"), F.col("source_span")[1].alias("b")).distinct()
    return selection.span_clusters(s, "source_path", "a", "b")


@query("""WITH d AS (SELECT DISTINCT manual_id, page_index, page_class FROM documents WHERE manual_id IS NOT NULL), i AS (SELECT *, page_index - row_number() OVER (PARTITION BY manual_id, page_class ORDER BY page_index) AS i FROM d)
SELECT manual_id, page_class, min(page_index)::BIGINT AS first, max(page_index)::BIGINT AS last, count(*) AS n FROM i GROUP BY manual_id, page_class, i HAVING count(*) >= 2""")
def class_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.runs(table(spark, sf_dir, "documents").where("manual_id is not null"), "manual_id", "page_index", "page_class")


@query("""WITH e AS (SELECT manual_id, page_index, count(*) AS n FROM documents WHERE manual_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2) SELECT manual_id, count(*) AS pages, sum(n - 1)::BIGINT AS duplicates, (max(page_index) - min(page_index) + 1 - count(*))::BIGINT AS missing FROM e GROUP BY 1""")
def page_sequence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.sequence_findings(table(spark, sf_dir, "documents"), "manual_id", "page_index")


@query("SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id, max(strlen(text))::BIGINT AS n_bytes, min(strlen(text)) <> max(strlen(text)) AS collision FROM documents WHERE text IS NOT NULL GROUP BY 1")
def artifact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.content_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(r"""WITH c AS (SELECT lower(regexp_replace(id, '^[\s]+|[\s]+$', '', 'g')) AS id, lower(regexp_replace(parent_id, '^[\s]+|[\s]+$', '', 'g')) AS target, revision FROM region_proposals), m AS (SELECT id, max(revision) AS r FROM c GROUP BY id), k AS (SELECT DISTINCT c.id, c.target FROM c JOIN m ON c.id = m.id AND c.revision = m.r)
SELECT target, count(DISTINCT id) AS n FROM k WHERE target <> '' AND target NOT IN (SELECT id FROM m) GROUP BY target""")
def dangling_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy.current_nodes(table(spark, sf_dir, "region_proposals"))
    return selection.dangling_references(nodes, "id", "parent", nodes, "id")


@query("""SELECT DISTINCT s.selector_id, CASE WHEN t.source_path IS NULL THEN 'unknown-target' WHEN s.source_sha256 IS DISTINCT FROM t.source_sha256 THEN 'stale' ELSE 'applies' END AS guard_status FROM source_selectors s LEFT JOIN sources t USING (source_path)""")
def guarded_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "source_selectors").select("selector_id", "source_path", "source_sha256")
    return selection.guarded(s, table(spark, sf_dir, "sources"), "source_path", {"source_sha256": "source_sha256"}).select("selector_id", "guard_status").distinct()


@query("""WITH c AS (SELECT selector_id, source_span[1] AS a, source_span[2] AS b, string_split(t.text, chr(10)) AS l, source_span IS NULL AS none FROM source_selectors s LEFT JOIN sources t USING (source_path)), d AS (SELECT *, CASE WHEN none OR a > b OR a < 1 OR l IS NULL OR a > len(l) THEN NULL ELSE l[a:b] END AS cut FROM c)
SELECT DISTINCT selector_id, CASE WHEN l IS NULL THEN 'unknown-source' WHEN none THEN 'no-span' WHEN a > b OR a < 1 THEN 'bad-span' WHEN b > len(l) THEN 'overlong' ELSE 'whole' END AS span_status, coalesce(len(cut), 0) AS n_lines, sha256(array_to_string(cut, chr(10))) AS span_sha256 FROM d""")
def selected_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.selected_text(table(spark, sf_dir, "source_selectors"), table(spark, sf_dir, "sources"))


@query("""SELECT manual_id, source_sha256 FROM (SELECT DISTINCT manual_id, source_sha256 FROM candidate_manuals WHERE source_sha256 IS NOT NULL) k WHERE NOT EXISTS (SELECT 1 FROM candidate_manuals c WHERE c.truth.status = 'reviewed' AND c.manual_id = k.manual_id AND c.source_sha256 = k.source_sha256)""")
def stage_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate_manuals")
    ledger = c.select("manual_id", "source_sha256", F.when(F.col("truth.status") == "reviewed", "complete").otherwise("failed").alias("status"))
    return selection.pending(c.where("source_sha256 is not null").select("manual_id", "source_sha256").distinct(), ledger, ["manual_id", "source_sha256"])


@query(f"""WITH {_REG} SELECT id, 'region-' || substring(sha256('region' || chr(31) || coalesce(source_text, '')), 1, 24) AS content_id, substring(sha256(document_id || chr(31) || page_id || chr(31) || id), 1, 16) AS stable_id FROM reg""")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    return r.select("id", digests.content_id("region", F.coalesce("source_text", F.lit(""))).alias("content_id"), digests.stable_id(F.col("document_id"), F.col("page_id"), F.col("id")).alias("stable_id"))


@query(f"""WITH {_PAIRS}, s AS (SELECT engine, kind, sum(distance)::DOUBLE AS e0, sum(length(text))::DOUBLE AS n, least(sum(distance), sum(length(text)))::DOUBLE AS e FROM pairs GROUP BY engine, kind)
SELECT engine, kind, e0::BIGINT AS errors, n::BIGINT AS units, round(CASE WHEN n > 0 THEN least((e / n + 3.8414588206941227 / (2 * n) + 1.959963984540054 * sqrt(e / n * (1 - e / n) / n + 3.8414588206941227 / (4 * n * n))) / (1 + 3.8414588206941227 / n), 1.0) ELSE 1.0 END, 9) AS upper, greatest(10000, ceil(n * 0.05))::BIGINT AS required_units FROM s""")
def wilson_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper bound of the error rate by group; a group with more errors than units counts as wrong throughout."""
    c = E.character_errors(_pairs(spark, sf_dir), "engine", "kind")
    n = F.col("reference_units").cast("double")
    wrong = F.least("errors", "reference_units").cast("double")
    required = F.greatest(F.lit(10_000), F.ceil(n * 0.05)).cast("bigint")
    return c.select("engine", "kind", "errors", F.col("reference_units").alias("units"), F.round(selection.wilson_upper(wrong, n), 9).alias("upper"), required.alias("required_units"))


# --- alignment and graphs ----------------------------------------------------------------------------------


@query(f"WITH {_PAIRS}, s AS (SELECT engine, sum(distance)::BIGINT AS d, sum(length(predicted) - length(text))::BIGINT AS g, sum(length(text))::BIGINT AS n FROM pairs GROUP BY engine) SELECT engine, d AS distance, g AS growth, n AS reference_units FROM s")
def edit_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums that the edit script must keep: I + D + S, I - D, and D + S + correct."""
    b = alignment.edit_breakdown(_pairs(spark, sf_dir), "engine")
    return b.select("engine", F.expr("insertions + deletions + substitutions").alias("distance"), F.expr("insertions - deletions").alias("growth"), F.expr("deletions + substitutions + correct").alias("reference_units"))


@query()
def wer_by_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.edit_breakdown(_pairs(spark, sf_dir), "engine", "kind", words=True)


@query()
def edit_script_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insertions, deletions, substitutions and correct characters in the preferred tie order."""
    return alignment.edit_breakdown(_pairs(spark, sf_dir), "engine")


@query()
def source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).where("source_text is not null and ocr_text is not null")
    return alignment.matching_coverage(r.select("id", F.col("source_text").alias("text"), F.col("ocr_text").alias("predicted")), "id")


@query()
def reconcile_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and recognised regions of each page, matched one to one by box and text."""
    r = _regions(spark, sf_dir)
    corner = lambda c: (F.col(c)[0].alias("x0"), F.col(c)[1].alias("y0"), (F.col(c)[0] + F.col(c)[2]).alias("x1"), (F.col(c)[1] + F.col(c)[3]).alias("y1"))
    left = r.where("source_text is not null").select("page_id", "id", *corner("reference_box"), F.col("source_text").alias("text"))
    right = r.where("ocr_text is not null").select("page_id", "id", *corner("generated_box"), F.col("ocr_text").alias("text"))
    return alignment.align_items(left, right)


@query()
def region_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy matching of overlapping boxes of one kind by descending overlap."""
    return graphs.mutual_best(layout.iou_pairs(_boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1"), threshold_milli=300))


@query(f"""WITH RECURSIVE {_BOX}, e AS (SELECT a.id AS u, b.id AS v FROM bx a JOIN bx b ON {_MEET} AND a.kind = b.kind AND a.id <> b.id), r AS (SELECT u AS id, u AS c FROM e UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.id) SELECT id, min(c) AS component FROM r GROUP BY id""")
def overlap_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1")
    return graphs.components(layout.iou_pairs(b, threshold_milli=0))


@query(f"WITH {_BOX} SELECT page_id, id, row_number() OVER (PARTITION BY page_id ORDER BY x0, y0, id) - 1 AS position FROM bx QUALIFY count(*) OVER (PARTITION BY page_id) > 1")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.topological_order(layout.reading_edges(_boxes(spark, sf_dir)), group="page_id")


@query(f"WITH RECURSIVE {_CHAIN} SELECT e.at AS root_id, e.id, row_number() OVER (PARTITION BY e.at ORDER BY e.path) - 1 AS position FROM ends e WHERE e.id IN (SELECT id FROM rooted)")
def structure_preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.preorder(hierarchy.hierarchy(table(spark, sf_dir, "region_proposals")))
