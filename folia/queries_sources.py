"""Registered queries of typesetter sources and source alignment, each with its SQL where one can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import source_alignment as A
from folia.operators import typeset as Y
from folia.queries_reference import _REG, _regions
from folia.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_DIR = r"^\.([A-Za-z_][A-Za-z0-9_]*)([ \t]+(.*))?$"
_VISIBLE = lambda c: rf"translate(regexp_replace({c}, '\x11((?s).)|\x06(?s).|\x16\(([^)]*)\)|[\x18\x19]', '\1\2', 'g'), chr(26) || chr(28) || chr(29), '≠≤≥')"
_LN = f"""s0 AS (SELECT source_path, document_id, string_split(text, chr(10)) AS l FROM sources WHERE text IS NOT NULL), s1 AS (SELECT source_path, document_id, len(l) AS n, generate_subscripts(l, 1) AS line_no, unnest(l) AS raw FROM s0),
 ln AS (SELECT source_path, document_id, line_no, line, lower(regexp_extract(line, '{_DIR}', 1)) AS name, regexp_extract(line, '{_DIR}', 3) AS arg, {_VISIBLE("line")} AS vis FROM (SELECT source_path, document_id, line_no, regexp_replace(raw, '\\r$', '') AS line FROM s1 WHERE NOT (line_no = n AND raw = '')))"""


def _depth(k: str) -> str:
    end = Y.PAIRS[k]
    return f"""{k}_s AS (SELECT *, sum(CASE name WHEN '{k}' THEN 1 WHEN '{end}' THEN -1 ELSE 0 END) OVER w AS s FROM ln WINDOW w AS (PARTITION BY source_path ORDER BY line_no)), {k}_m AS (SELECT *, s - least(min(s) OVER (PARTITION BY source_path ORDER BY line_no), 0) AS d FROM {k}_s),
 {k}_d AS (SELECT *, coalesce(lag(d) OVER (PARTITION BY source_path ORDER BY line_no), 0) AS depth FROM {k}_m)"""


_Q = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
_BLOCKS = f"""{_LN}, {_depth("lisp")}, k0 AS (SELECT *, trim(regexp_replace(vis, '^[ \\t]+|[ \\t]+$', '', 'g')) AS plain, {_VISIBLE("regexp_replace(arg, '^[0-9]+([ \\t\\n\\x0b\\f\\r]+|$)', '')")} AS moved, {_VISIBLE("arg")} AS varg FROM lisp_d),
 k1 AS (SELECT *, CASE WHEN name IN {_Q(Y.TRANSPARENT)} OR starts_with(lower(line), '''cindex') THEN 'quiet' WHEN depth > 0 AND name = '' THEN 'code' WHEN depth > 0 AND name = 'exdent' AND moved <> '' THEN 'code' WHEN name IN {_Q([*Y.PAIRS, *Y.PAIRS.values()])} THEN 'break' WHEN depth > 0 THEN 'quiet' WHEN name = '' THEN CASE WHEN plain = '' THEN 'break' ELSE 'body' END
  WHEN name IN {_Q(Y.HEADINGS)} THEN 'section' WHEN name IN {_Q(Y.FUNCTIONS)} THEN 'function' WHEN name IN {_Q(Y.ITEMS)} THEN 'list-item' WHEN name = 'exdent' AND moved <> '' THEN 'list-item' ELSE 'break' END AS kind FROM k0),
 k2 AS (SELECT source_path, line_no, kind, regexp_matches(vis, '^[ \\t]') AS indent, CASE WHEN name = 'exdent' THEN moved WHEN kind = 'code' THEN vis WHEN kind = 'body' THEN plain WHEN kind = 'section' THEN regexp_replace(trim(arg), '^"(.*)"$', '\\1') ELSE trim(varg) END AS text FROM k1 WHERE kind <> 'quiet'),
 k3 AS (SELECT *, CASE WHEN kind = 'break' OR coalesce(lag(kind) OVER w = kind AND (kind = 'code' OR (kind = 'body' AND NOT indent)), false) THEN 0 ELSE 1 END AS starts FROM k2 WINDOW w AS (PARTITION BY source_path ORDER BY line_no)),
 bl AS (SELECT source_path, kind, line_no, text, block_no FROM (SELECT *, sum(starts) OVER (PARTITION BY source_path ORDER BY line_no) AS block_no FROM k3) WHERE kind <> 'break'),
 blocks AS (SELECT source_path, block_no::BIGINT AS block_no, kind, min(line_no) AS start_line, max(line_no) AS end_line, count(*) AS n_lines, string_agg(text, CASE WHEN kind = 'code' THEN chr(10) ELSE ' ' END ORDER BY line_no) AS text FROM bl GROUP BY source_path, block_no, kind)""".replace("string_agg(text, CASE WHEN kind = 'code' THEN chr(10) ELSE ' ' END ORDER BY line_no)", "CASE WHEN kind = 'code' THEN string_agg(text, chr(10) ORDER BY line_no) ELSE string_agg(text, ' ' ORDER BY line_no) END")


@query(f"WITH {_LN} SELECT source_path, line_no, vis AS text FROM ln WHERE vis <> line")
def visible_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose control bytes change what is shown."""
    lines = Y.source_lines(table(spark, sf_dir, "sources")).withColumn("text", Y.visible(F.col("line")))
    return lines.where("text <> line").select("source_path", "line_no", "text")


@query(f"WITH {_BLOCKS} SELECT * FROM blocks")
def source_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.blocks(table(spark, sf_dir, "sources"))


def _nesting(k: str) -> str:
    return f"SELECT source_path, '{k}' AS directive, count(*) FILTER (WHERE name = '{Y.PAIRS[k]}' AND depth = 0) AS unopened, count(*) FILTER (WHERE name = '{k}') - count(*) FILTER (WHERE name = '{Y.PAIRS[k]}' AND depth > 0) AS unclosed FROM {k}_d GROUP BY 1"


# Some closing and some opening lines are taken away, so that there is something to find.
_TORN = _LN.replace("FROM sources WHERE", "FROM (SELECT source_path, document_id, CASE WHEN n_lines % 2 = 0 THEN regexp_replace(text, '(?m)^\\.end_lisp *$', '', 'g') ELSE regexp_replace(text, '(?m)^\\.table .*$', '', 'g') END AS text FROM sources) WHERE")


@query(f"WITH {_TORN}, {', '.join(map(_depth, Y.PAIRS))} SELECT * FROM ({' UNION ALL '.join(map(_nesting, Y.PAIRS))}) WHERE unopened > 0 OR unclosed > 0")
def nesting_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("n_lines") % 2 == 0, F.regexp_replace("text", r"(?md)^\.end_lisp *$", "")).otherwise(F.regexp_replace("text", r"(?md)^\.table .*$", ""))
    return Y.nesting_findings(table(spark, sf_dir, "sources").withColumn("text", text))


@query(f"WITH {_BLOCKS}, n AS (SELECT *, len(string_split(text, chr(10))) AS n FROM blocks), a AS (SELECT *, coalesce(sum(n + 1) OVER (PARTITION BY source_path ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM n) SELECT source_path, block_no, kind, (ahead + 1)::BIGINT AS out_start, (ahead + n)::BIGINT AS out_end FROM a")
def reference_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.reference_spans(table(spark, sf_dir, "sources"))


_RENDERED = f"""{_BLOCKS}, sp AS (SELECT DISTINCT source_path, source_span[1] AS a, source_span[2] AS b FROM source_selectors), mt AS (SELECT sp.source_path, a, b, block_no, kind, line_no, text FROM sp JOIN bl ON bl.source_path = sp.source_path AND bl.line_no BETWEEN a AND b WHERE a >= 1),
 pt AS (SELECT source_path, a, b, block_no, CASE WHEN kind = 'code' THEN string_agg(text, chr(10) ORDER BY line_no) ELSE string_agg(text, ' ' ORDER BY line_no) END AS text FROM mt GROUP BY source_path, a, b, block_no, kind), rd AS (SELECT source_path, a, b, count(*) AS n_blocks, string_agg(text, chr(10) || chr(10) ORDER BY block_no) AS rendered FROM pt WHERE text <> '' GROUP BY 1, 2, 3)"""


@query(f"WITH {_RENDERED} SELECT * FROM rd")
def rendered_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered text of every distinct span of the selectors."""
    s = table(spark, sf_dir, "source_selectors").select("source_path", F.col("source_span")[0].alias("a"), F.col("source_span")[1].alias("b")).distinct().withColumn("span_id", F.concat_ws(":", "source_path", "a", "b"))
    return Y.rendered(s, table(spark, sf_dir, "sources")).join(s, "span_id").select("source_path", "a", "b", "n_blocks", "rendered")


@query(f"""WITH {_RENDERED}, se AS (SELECT DISTINCT selector_id, source_path, region_kind, source_span[1] AS a, source_span[2] AS b, selector.kind AS kind, selector.start_char AS p, selector.end_char AS q, lower(selector.directive) AS dir, selector.component AS component FROM source_selectors),
j AS (SELECT se.*, rd.rendered, ln.name AS found, CASE dir {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in Y.ROLES.items())} END AS role FROM se LEFT JOIN rd ON rd.source_path = se.source_path AND rd.a = se.a AND rd.b = se.b LEFT JOIN ln ON ln.source_path = se.source_path AND ln.line_no = se.a),
c AS (SELECT *, CASE WHEN kind = 'rendered-character-range' THEN CASE WHEN p IS NULL OR q IS NULL THEN 'no-range' WHEN coalesce(p < q AND q <= length(rendered), false) THEN 'selected' ELSE 'outside' END WHEN component <> 'role' THEN 'no-range' WHEN coalesce(found <> dir, true) THEN 'not-a-directive' WHEN role IS NULL THEN 'no-role' ELSE 'selected' END AS status FROM j),
t AS (SELECT selector_id, status, CASE WHEN status = 'selected' THEN CASE WHEN kind = 'rendered-character-range' THEN CASE WHEN region_kind = 'body' THEN replace(substring(rendered, p + 1, q - p), chr(10), ' ') ELSE substring(rendered, p + 1, q - p) END ELSE role END END AS x FROM c) SELECT DISTINCT selector_id, status, length(x)::INT AS n_chars, sha256(x) AS selected_sha256 FROM t""")
def selected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.selected_components(table(spark, sf_dir, "source_selectors"), table(spark, sf_dir, "sources"))


# --- alignment of pages ------------------------------------------------------------------------------------------

_TOK = lambda c: f"regexp_extract_all(replace(replace(lower({c}), '≥', '>='), '≤', '<='), '[a-z0-9]+|>=|<=|//|\\\\\\\\|[+*/=<>^-]')"
_GRAMS = lambda k: f"CASE WHEN len({k}) < 3 THEN [] ELSE list_distinct(list_transform(range(1, len({k}) - 1), lambda i: {k}[i] || chr(31) || {k}[i + 1] || chr(31) || {k}[i + 2])) END"
_SHOWN = f"""CASE WHEN starts_with(lower(line), '''cindex') THEN '' WHEN name = 'exdent' THEN regexp_replace(arg, '^[0-9]+([ \\t\\n\\x0b\\f\\r]+|$)', '') WHEN name = 'defspec' THEN arg || ' Special Form' WHEN name IN {_Q(A.SHOWN)} THEN arg WHEN starts_with(line, '.') THEN '' ELSE line END"""
_SHORT = f"""{_REG}, {_LN}, pg AS (SELECT document_id, page_id, flatten(list({_TOK("coalesce(ocr_text, '')")} ORDER BY id)) AS k FROM reg WHERE document_id IS NOT NULL GROUP BY 1, 2), ft AS (SELECT document_id, source_path, flatten(list({_TOK(_VISIBLE(_SHOWN))} ORDER BY line_no)) AS k FROM ln WHERE document_id IS NOT NULL GROUP BY 1, 2),
 pa AS (SELECT document_id, page_id, unnest({_GRAMS("k")}) AS g FROM pg), fb AS (SELECT document_id, source_path, unnest({_GRAMS("k")}) AS g FROM ft), ov AS (SELECT page_id, source_path, count(*) AS overlap FROM pa JOIN fb USING (document_id, g) GROUP BY 1, 2)"""


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = _regions(spark, sf_dir).where("document_id is not null").withColumn("t", T.locator_tokens(F.coalesce("ocr_text", F.lit(""))))
    rows = F.array_sort(F.collect_list(F.struct("id", "t")))
    pages = r.groupBy("document_id", "page_id").agg(F.flatten(F.transform(rows, lambda x: x["t"])).alias("tokens"))
    return pages, A.source_tokens(table(spark, sf_dir, "sources").where("document_id is not null"), "document_id")


@query(f"WITH {_SHORT} SELECT page_id, source_path, overlap, row_number() OVER (PARTITION BY page_id ORDER BY overlap DESC, source_path)::INT AS rank FROM ov QUALIFY rank <= 6")
def ngram_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.shortlist(*_inputs(spark, sf_dir))


@query()
def source_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file and lines that each page was set from."""
    return A.align_pages(*_inputs(spark, sf_dir))


@query()
def region_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the page's file that each region matches."""
    regions = _regions(spark, sf_dir).select("document_id", "page_id", F.col("id").alias("region_id"), F.col("id").alias("reading_order"), F.col("ocr_text").alias("text"))
    return A.locate_regions(regions, A.source_tokens(table(spark, sf_dir, "sources").where("document_id is not null"), "document_id"))
