"""Registered queries of reports and reconciliation, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.operators import alignment, layout, reconcile, reports
from folia.queries_layout import HEIGHT, WIDTH
from folia.queries_reference import _LEAVES, _MEET, _AREA, _PARENTS, _BOX, _D, _PAIRS, _REG, _RISK, _boxes, _pairs, _regions
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


@query()
def restricted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors in punctuation and in cased letters along the preferred edit script."""
    return alignment.restricted_metrics(_pairs(spark, sf_dir), "engine")


# --- engine reports: truth pages, reports with digests that are sometimes stale, unknown or given twice -------

_DIGEST = """dg AS (SELECT page_id, count(*) AS regions, sha256(count(*) || ':' || sum(('0x' || substring(md5(concat_ws(chr(31), id, coalesce(canonical_text, ''))), 1, 12))::BIGINT::HUGEINT)) AS digest FROM reg GROUP BY page_id)"""
_VERSIONS = ("ocr", "1"), ("ocr", "2"), ("source", "1")
_REPORTS = f"""{_PAIRS}, {_DIGEST}, pg AS (SELECT d.page_id, d.digest, CASE WHEN right(d.page_id, 1) < '6' THEN ['clean'] WHEN right(d.page_id, 1) < 'c' THEN ['degraded', 'x'] ELSE [] END AS tags, c.has_code FROM dg d JOIN (SELECT page_id, bool_or(coalesce(kind = 'code', false)) AS has_code FROM reg GROUP BY 1) c USING (page_id)),
 ev AS (SELECT reg.page_id, p.engine, sum(p.distance)::BIGINT AS errors, sum(length(p.text))::BIGINT AS units FROM pairs p JOIN reg ON reg.id = p.region_id GROUP BY 1, 2),
 r0 AS (SELECT ev.page_id, ev.engine, '1' AS version, dg.digest, errors, units, 'a' AS report_id FROM ev JOIN dg USING (page_id) WHERE NOT (engine = 'ocr' AND right(ev.page_id, 1) = '2')
  UNION ALL SELECT ev.page_id, engine, '2', CASE WHEN right(ev.page_id, 1) = '3' THEN 'stale' ELSE digest END, errors, units, 'a' FROM ev JOIN dg USING (page_id) WHERE engine = 'ocr'
  UNION ALL SELECT ev.page_id || CASE WHEN right(ev.page_id, 1) = '4' THEN '-gone' ELSE '' END, engine, '1', digest, errors, units, 'b' FROM ev JOIN dg USING (page_id) WHERE engine = 'source' AND right(ev.page_id, 1) IN ('4', '5')),
 ok AS (SELECT r0.*, pg.tags, pg.has_code, coalesce(r0.digest = pg.digest, false) AS good FROM r0 LEFT JOIN pg USING (page_id)), rp AS (SELECT *, good AND report_id = min(report_id) FILTER (WHERE good) OVER (PARTITION BY engine, version, page_id) AS grounded FROM ok)"""


def _report_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    regions = _regions(spark, sf_dir)
    last = F.substring("page_id", -1, 1)
    tags = F.when(last < "6", F.array(F.lit("clean"))).when(last < "c", F.array(F.lit("degraded"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    code = regions.groupBy("page_id").agg(F.bool_or(F.coalesce(F.col("kind") == "code", F.lit(False))).alias("has_code"))
    digests = reports.page_digests(regions, "id", "canonical_text")
    pages = digests.join(code, "page_id").select("page_id", "digest", tags.alias("tags"), "has_code")
    engines = F.array(F.struct(F.lit("ocr").alias("engine"), F.col("ocr_text").alias("t")), F.struct(F.lit("source").alias("engine"), F.col("source_text").alias("t")))
    pairs = regions.where("canonical_text is not null").select("page_id", "canonical_text", F.explode(engines).alias("e"))
    wrong = F.when(F.col("canonical_text") == F.coalesce("e.t", F.lit("")), 0).otherwise(F.levenshtein("canonical_text", F.coalesce("e.t", F.lit("")))).cast("bigint")
    scored = pairs.groupBy("page_id", "e.engine").agg(F.sum(wrong).alias("errors"), F.sum(F.length("canonical_text").cast("bigint")).alias("units")).join(digests.select("page_id", "digest"), "page_id")
    make = lambda df, version, page, digest, no: df.select(page.alias("page_id"), "engine", F.lit(version).alias("version"), digest.alias("digest"), "errors", "units", F.lit(no).alias("report_id"))
    page, digest = F.col("page_id"), F.col("digest")
    rows = make(scored.where(~((F.col("engine") == "ocr") & (last == "2"))), "1", page, digest, "a")
    rows = rows.unionByName(make(scored.where("engine = 'ocr'"), "2", page, F.when(last == "3", "stale").otherwise(digest), "a"))
    rows = rows.unionByName(make(scored.where((F.col("engine") == "source") & last.isin("4", "5")), "1", F.when(last == "4", F.concat("page_id", F.lit("-gone"))).otherwise(page), digest, "b"))
    return pages, rows


@query(f"""WITH {_REPORTS} SELECT engine, version, count(*) FILTER (WHERE grounded) AS selected_pages, count(DISTINCT page_id) FILTER (WHERE NOT coalesce(grounded, false)) AS ungrounded_pages, coalesce(sum(errors) FILTER (WHERE grounded), 0)::BIGINT AS errors, coalesce(sum(units) FILTER (WHERE grounded), 0)::BIGINT AS units,
 coalesce(sum(errors) FILTER (WHERE grounded AND list_contains(tags, 'clean')), 0)::BIGINT AS clean_errors, coalesce(sum(units) FILTER (WHERE grounded AND list_contains(tags, 'clean')), 0)::BIGINT AS clean_units, coalesce(sum(errors) FILTER (WHERE grounded AND list_contains(tags, 'degraded')), 0)::BIGINT AS degraded_errors,
 coalesce(sum(units) FILTER (WHERE grounded AND list_contains(tags, 'degraded')), 0)::BIGINT AS degraded_units, coalesce(sum(units) FILTER (WHERE grounded AND has_code), 0)::BIGINT AS code_units, (SELECT count(*) FROM pg) - count(*) FILTER (WHERE grounded) AS missing_pages,
 CASE WHEN count(*) FILTER (WHERE NOT coalesce(grounded, false)) = 0 THEN sum(errors) FILTER (WHERE grounded) / sum(units) FILTER (WHERE grounded) END AS error_rate FROM rp GROUP BY 1, 2""")
def engine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.engine_report(*_report_inputs(spark, sf_dir))


@query(f"WITH {_REPORTS} SELECT e.engine, e.version, pg.page_id FROM (SELECT DISTINCT engine, version FROM rp) e, pg WHERE NOT EXISTS (SELECT 1 FROM rp WHERE rp.engine = e.engine AND rp.version = e.version AND rp.page_id = pg.page_id AND grounded)")
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.missing_pages(*_report_inputs(spark, sf_dir))


@query(f"WITH {_REG}, {_DIGEST} SELECT * FROM dg")
def truth_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.page_digests(_regions(spark, sf_dir), "id", "canonical_text")


# --- strata and compositions -----------------------------------------------------------------------------------

_PAGES = "pp AS (SELECT manual_id, p.page_index AS i, p.page_class AS page_class, p.tags AS tags FROM (SELECT manual_id, unnest(candidate_pages) AS p FROM candidate_manuals))"
_TAGS = ("born-digital", "clean-scanned-prose", "code-terminal", "degraded-scanned-prose", "hybrid", "no-such-tag", "table")


def _manual_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "candidate_manuals").select("manual_id", F.explode("candidate_pages").alias("p"))
    return pages.select("manual_id", F.col("p.page_index").alias("i"), "p.page_class", "p.tags")


@query(f"""WITH {_PAGES}, m AS (SELECT *, i % 7 AS tp, i % 3 AS fp, i % 4 AS fn, i % 10 AS oc, 10 AS ot, i * 3 AS rt, i * 1000 AS mb, [0.2, 0.7] AS c, [(i % 5) / 5.0, (i % 3) / 3.0]::DOUBLE[] AS a, [i % 6, i % 2] AS n FROM pp WHERE i IS NOT NULL AND page_class IS NOT NULL),
g AS (SELECT m.*, unnest(list_concat(['class:' || page_class], list_transform(list_distinct(coalesce(tags, [])), lambda t: 'tag:' || t))) AS stratum FROM m)
SELECT stratum, count(*) AS pages, sum(rt)::BIGINT AS runtime_ms, max(mb)::BIGINT AS memory_bytes, CASE WHEN sum(tp + fp) = 0 THEN 1.0 ELSE round((sum(tp) / sum(tp + fp))::DOUBLE, 9) END AS region_precision, CASE WHEN sum(tp + fn) = 0 THEN 1.0 ELSE round((sum(tp) / sum(tp + fn))::DOUBLE, 9) END AS region_recall,
 CASE WHEN sum(2 * tp + fp + fn) = 0 THEN 1.0 ELSE round((sum(2 * tp) / sum(2 * tp + fp + fn))::DOUBLE, 9) END AS region_f1, round((sum(oc) / sum(ot))::DOUBLE, 9) AS order_accuracy, CASE WHEN sum(n[1] + n[2]) > 0 THEN round((sum(abs(c[1] - a[1]) * n[1] + abs(c[2] - a[2]) * n[2]) / sum(n[1] + n[2]))::DOUBLE, 9) END AS calibration_error FROM g WHERE stratum IS NOT NULL GROUP BY 1""")
def stratified_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("i")
    one = lambda c, a, n: F.struct(F.lit(c).alias("confidence"), a.alias("accuracy"), n.alias("n"))
    m = _manual_pages(spark, sf_dir).where("i is not null and page_class is not null")
    bins = F.array(one(0.2, (i % 5) / F.lit(5.0), i % 6), one(0.7, (i % 3) / F.lit(3.0), i % 2))
    m = m.select("page_class", F.filter("tags", lambda t: t.isNotNull()).alias("tags"), (i % 7).alias("tp"), (i % 3).alias("fp"), (i % 4).alias("fn"), (i % 10).alias("order_correct"), F.lit(10).alias("order_total"), (i * 3).alias("runtime_ms"), (i.cast("bigint") * 1000).alias("memory_bytes"), bins.alias("bins"))
    out = reports.stratified(m)
    return out.select(*(F.round(c, 9).alias(c) if t == "double" else c for c, t in out.dtypes))


@query(f"""WITH {_PAGES}, k AS (SELECT DISTINCT manual_id || ':' || i AS page_key, unnest(tags) AS tag FROM pp), c AS (SELECT tag, count(DISTINCT page_key) AS n FROM k WHERE tag IS NOT NULL AND page_key IS NOT NULL GROUP BY 1), r AS (SELECT unnest({list(_TAGS)}) AS tag, 40 AS required)
SELECT coalesce(c.tag, r.tag) AS tag, coalesce(n, 0) AS n, coalesce(required, 0)::BIGINT AS required, greatest(coalesce(required, 0) - coalesce(n, 0), 0) AS missing FROM c FULL JOIN r ON c.tag = r.tag""")
def queue_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of the candidate pages against the numbers wanted of each."""
    pages = _manual_pages(spark, sf_dir).select(F.concat_ws(":", "manual_id", F.col("i").cast("string")).alias("page_key"), "tags", "manual_id", "i").where("manual_id is not null and i is not null")
    return reports.composition(pages, dict.fromkeys(_TAGS, 40))


_MEASURED = "mp AS (SELECT doc_id, coalesce(n_chars, 0) % 23 AS tx, CASE WHEN doc_id % 5 = 0 THEN [NULL, NULL] WHEN doc_id % 5 = 1 THEN [] ELSE [(doc_id % 7) / 10.0, (doc_id % 3) / 10.0] END::DOUBLE[] AS placed, CASE WHEN doc_id % 10 = 0 THEN [] ELSE [(doc_id % 11) * 50000] END::DOUBLE[] AS ar, doc_id % 4 AS im, doc_id % 6 AS bp, doc_id % 2 = 0 AS land, doc_id % 3 AS fo, CASE WHEN doc_id % 4 = 1 THEN doc_id % 8 END AS ve FROM documents)"


@query(f"""WITH {_MEASURED}, c AS (SELECT *, CASE WHEN len(list_filter(placed, lambda x: x IS NOT NULL)) > 0 THEN round_even(least(list_sum(placed), 1.0), 6) WHEN len(list_filter(ar, lambda x: x > 0)) > 0 THEN round_even(least(list_sum(ar) / {WIDTH}.0, 1.0), 6) END AS cov, im > 0 AND bp < 2 AS bi, bp > 3 AND im > 0 AS co FROM mp), d AS (SELECT *, tx >= 8 AS t, coalesce(cov >= 0.6, false) AS s FROM c)
SELECT doc_id, cov AS coverage, CASE WHEN t AND (s OR (im > 0 AND cov IS NULL)) THEN 'hybrid' WHEN s AND NOT t THEN CASE WHEN bi AND land THEN 'schematic' WHEN bi THEN 'scan-bilevel' WHEN co THEN 'photo-or-illustration-dominant' ELSE 'ambiguous' END WHEN t AND (fo > 0 OR coalesce(ve > 0, false) OR im = 0) THEN 'born-digital' ELSE 'ambiguous' END AS label,
 CASE WHEN t AND (s OR (im > 0 AND cov IS NULL)) THEN CASE WHEN cov IS NULL THEN 'medium' ELSE 'high' END WHEN s AND NOT t THEN CASE WHEN bi AND land THEN 'medium' WHEN bi THEN 'high' WHEN co THEN 'medium' ELSE 'low' END WHEN t AND (fo > 0 OR coalesce(ve > 0, false) OR im = 0) THEN CASE WHEN im > 0 THEN 'medium' ELSE 'high' END ELSE 'low' END AS confidence,
 CASE WHEN t AND (s OR (im > 0 AND cov IS NULL)) THEN '' WHEN s AND NOT t THEN CASE WHEN bi AND land THEN 'scan-bilevel' WHEN bi THEN '' WHEN co THEN 'scan-color,scan-gray' ELSE '' END WHEN t AND (fo > 0 OR coalesce(ve > 0, false) OR im = 0) THEN CASE WHEN im > 0 THEN 'hybrid' ELSE '' END WHEN im > 0 AND cov IS NULL THEN CASE WHEN t THEN 'hybrid' ELSE 'scan-gray' END ELSE '' END AS alternatives,
 CASE WHEN tx > 0 AND t AND (s OR (im > 0 AND cov IS NULL) OR fo > 0 OR coalesce(ve > 0, false) OR im = 0) THEN 'pdf-text' ELSE 'scan' END AS route FROM d""")
def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of pages from measured text, images and vectors; the measures are derived from the documents."""
    k = F.col("doc_id")
    placed = F.when(k % 5 == 0, F.array(F.lit(None), F.lit(None)).cast("array<double>")).when(k % 5 == 1, F.array().cast("array<double>")).otherwise(F.array((k % 7) / F.lit(10.0), (k % 3) / F.lit(10.0)))
    area = F.when(k % 10 == 0, F.array().cast("array<double>")).otherwise(F.array(((k % 11) * 50000).cast("double")))
    cover = reports.image_coverage(placed, area, F.lit(float(WIDTH)))
    d = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce("n_chars", F.lit(0)) % 23).alias("tx"), cover.alias("coverage"))
    images, bits = k % 4, k % 6
    label = reports.page_class(F.col("tx"), F.col("coverage"), images, (images > 0) & (bits < 2), (bits > 3) & (images > 0), k % 2 == 0, k % 3, F.when(k % 4 == 1, k % 8))
    out = d.select("doc_id", "coverage", "tx", label.alias("c"))
    route = F.when(F.col("c.label").isin("born-digital", "hybrid") & (F.col("tx") > 0), "pdf-text").otherwise("scan")
    return out.select("doc_id", "coverage", "c.label", "c.confidence", "c.alternatives", route.alias("route"))


_CLASS = "CASE WHEN page_class IN ('scan-gray', 'scan-color') THEN 'ambiguous' ELSE page_class END"


@query(f"""WITH c AS (SELECT manual_id, count(*) AS pages, count(*) FILTER (WHERE {_CLASS} <> 'ambiguous') AS clear, count(DISTINCT {_CLASS}) FILTER (WHERE {_CLASS} <> 'ambiguous') AS kinds, min({_CLASS}) FILTER (WHERE {_CLASS} <> 'ambiguous') AS one, bool_or(coalesce(page_class = 'hybrid', false)) AS h, bool_or(coalesce(page_class = 'born-digital', false)) AS b FROM documents WHERE manual_id IS NOT NULL GROUP BY 1)
SELECT manual_id, pages, CASE WHEN clear = 0 THEN 'ambiguous' WHEN kinds = 1 AND NOT h THEN one ELSE 'hybrid' END AS label, CASE WHEN clear = 0 THEN 'low' WHEN kinds = 1 AND NOT h THEN CASE WHEN clear = pages THEN 'high' ELSE 'medium' END WHEN h OR b THEN 'medium' ELSE 'low' END AS confidence FROM c""")
def document_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of a manual from those of its pages; grey and colour scans count as ambiguous here."""
    label = F.when(F.col("page_class").isin("scan-gray", "scan-color"), "ambiguous").otherwise(F.col("page_class"))
    return reports.document_class(table(spark, sf_dir, "documents").where("manual_id is not null").select("manual_id", label.alias("c")), "manual_id", "c")


@query(f"""WITH {_REG}, s AS (SELECT id, string_split(source_text, chr(10)) AS a, string_split(ocr_text, chr(10)) AS b FROM reg WHERE source_text IS NOT NULL AND ocr_text IS NOT NULL)
SELECT id, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i])) * 1000 // greatest(len(a), len(b)) AS agreement FROM s""")
def line_break_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).where("source_text is not null and ocr_text is not null")
    return reports.line_break_agreement(r, "id", "source_text", "ocr_text")


@query("""WITH h AS (SELECT page_class AS g, n_chars % 256 AS v, count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY 1, 2), c AS (SELECT g, v, sum(n) OVER p AS total, sum(n * v) OVER p AS mass, sum(n) OVER b AS w0, sum(n * v) OVER b AS s0 FROM h WINDOW p AS (PARTITION BY g), b AS (PARTITION BY g ORDER BY v)),
s AS (SELECT g, v, CASE WHEN w0 < total THEN (mass * w0 - s0 * total)::DOUBLE * (mass * w0 - s0 * total)::DOUBLE / (w0 * (total - w0))::DOUBLE ELSE 0.0 END AS score FROM c) SELECT g AS page_class, v AS threshold FROM s QUALIFY row_number() OVER (PARTITION BY g ORDER BY score DESC, v) = 1""")
def otsu_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("page_class", (F.col("n_chars") % 256).alias("v"))
    return reports.otsu(d, "page_class", "v")


@query(r"""WITH f AS (SELECT document_id, source_path, source_sha256, row_number() OVER (PARTITION BY document_id ORDER BY source_path) AS i FROM sources WHERE document_id IS NOT NULL) SELECT document_id, count(*) AS n, sha256(string_agg(i || chr(9) || source_path || chr(9) || source_sha256 || chr(10), '' ORDER BY i)) AS order_digest FROM f GROUP BY 1""")
def order_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.order_digest(table(spark, sf_dir, "sources").where("document_id is not null"), "document_id", "source_path", "source_sha256")


@query(f"""WITH {_BOX}, m AS (SELECT a.id AS line_id, max({_AREA}) AS s FROM bx a JOIN bx b ON {_MEET} WHERE a.kind IN {_LEAVES} AND b.kind IN {_PARENTS} GROUP BY 1), l AS (SELECT bx.page_id, bx.id, coalesce(m.s, 0) AS s FROM bx LEFT JOIN m ON m.line_id = bx.id WHERE bx.kind IN {_LEAVES})
SELECT page_id, count(*) AS lines, count(*) FILTER (WHERE s > 0) AS assigned, count(*) FILTER (WHERE s = 0) AS unassigned, (count(*) FILTER (WHERE s > 0)) * 1000 // count(*) AS assignment_rate FROM l GROUP BY 1""")
def spatial_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each page found a region."""
    b = _boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1")
    each = layout.assign_lines(b.where(F.col("kind").isin(*_LEAVES)).drop("kind"), b.where(F.col("kind").isin(*_PARENTS)).drop("kind"))
    hit = F.count_if(F.col("shared_area") > 0)
    return each.groupBy("page_id").agg(F.count(F.lit(1)).alias("lines"), hit.alias("assigned"), F.count_if(F.col("shared_area") == 0).alias("unassigned"), F.floor(hit * 1000 / F.count(F.lit(1))).alias("assignment_rate"))


# --- reconciliation --------------------------------------------------------------------------------------------

ENGINES, ROUTED = ["canonical", "ocr", "source"], "ocr"
CALIBRATIONS = {"ocr": (900, 20), "canonical": (1000, -50)}
_ENGINE_LINES = f"""{_REG}, e AS (SELECT page_id, id, 'canonical' AS engine, canonical_text AS t FROM reg UNION ALL SELECT page_id, id, 'ocr', ocr_text FROM reg UNION ALL SELECT page_id, id, 'source', source_text FROM reg),
 el AS (SELECT page_id, engine, id || ':' || lpad((generate_subscripts(l, 1) - 1)::VARCHAR, 6, '0') AS line_key, unnest(l) AS line FROM (SELECT *, string_split(t, chr(10)) AS l FROM e WHERE t IS NOT NULL)),
 cl AS (SELECT page_id, engine, line_key, engine || '-' || line_key AS line_id, line, CASE engine WHEN 'ocr' THEN least(greatest(f * 900 // 1000 + 20, 0), 1000) WHEN 'canonical' THEN least(greatest(f - 50, 0), 1000) ELSE f END AS c FROM (SELECT *, CASE WHEN length(line) = 0 THEN 0 ELSE length(line) * 37 % 1001 END AS f FROM el))"""


def _engine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the three texts of every region, aligned by region and place, with a confidence made from the line's length."""
    r = _regions(spark, sf_dir)
    texts = F.array(*(F.struct(F.lit(e).alias("engine"), F.col(f"{e}_text").alias("t")) for e in ENGINES))
    each = r.select("page_id", "id", F.explode(texts).alias("e")).where("e.t is not null").select("page_id", "id", "e.engine", F.posexplode(F.split("e.t", "\n")).alias("line_no", "text"))
    key = F.concat("id", F.lit(":"), F.lpad(F.col("line_no").cast("string"), 6, "0"))
    conf = F.when(F.length("text") > 0, F.length("text") * 37 % 1001)
    return each.select("page_id", "engine", key.alias("line_key"), F.concat("engine", F.lit("-"), key).alias("line_id"), "line_no", "text", conf.alias("confidence"))


@query(f"""WITH {_ENGINE_LINES}, a AS (SELECT o.page_id, o.line_id, o.line AS text, x.engine, x.c, x.line = o.line AS same FROM cl o JOIN cl x ON x.line_key = o.line_key AND x.page_id = o.page_id WHERE o.engine = 'ocr')
SELECT page_id, line_id, text, max((c, engine)) FILTER (WHERE same)[2] AS source_engine, max(c) FILTER (WHERE same) AS confidence, (count(*) FILTER (WHERE same))::INT AS n_agreeing, count(*)::INT - 1 AS n_alternatives FROM a GROUP BY 1, 2, 3""".replace("max((c, engine)) FILTER (WHERE same)[2]", "arg_max(engine, c * 10 + CASE engine WHEN 'canonical' THEN 0 WHEN 'ocr' THEN 1 ELSE 2 END) FILTER (WHERE same)"))
def selected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.selected_lines(_engine_lines(spark, sf_dir), ROUTED, CALIBRATIONS)


_FOUND = f"""{_ENGINE_LINES}, o AS (SELECT * FROM cl WHERE engine = 'ocr'), fd AS (SELECT page_id, line_id AS subject_id, unnest(list_filter([{_RISK}, CASE WHEN c < 700 THEN 'LOW_CONFIDENCE' END], lambda x: x IS NOT NULL)) AS code, '' AS detail FROM o
 UNION ALL SELECT o.page_id, o.line_id, 'ENGINE_DISAGREEMENT', '' FROM o WHERE EXISTS (SELECT 1 FROM cl x WHERE x.line_key = o.line_key AND x.page_id = o.page_id AND x.engine <> 'ocr' AND x.line <> o.line)
 UNION ALL SELECT o.page_id, o.line_id, 'OMISSION', g.e FROM o, (SELECT unnest(['canonical', 'source']) AS e) g WHERE NOT EXISTS (SELECT 1 FROM cl x WHERE x.line_key = o.line_key AND x.page_id = o.page_id AND x.engine = g.e)
 UNION ALL SELECT page_id, min(line_id), 'DUPLICATE_LINE', engine || ':' || count(*) FROM cl WHERE line <> '' GROUP BY page_id, engine, line HAVING count(*) > 1)"""


@query(f"WITH {_FOUND} SELECT *, 'high' AS severity FROM fd")
def reconcile_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.findings(_engine_lines(spark, sf_dir), ROUTED, ENGINES, CALIBRATIONS)


@query(f"WITH {_FOUND} SELECT page_id, count(*) AS n, min(subject_id) AS first FROM fd WHERE code = 'ENGINE_DISAGREEMENT' GROUP BY page_id")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with lines on which engines disagree."""
    found = reconcile.review_queue(reconcile_findings(spark, sf_dir), minimum="high", code="ENGINE_DISAGREEMENT")
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.min("subject_id").alias("first"))
