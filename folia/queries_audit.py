"""Registered queries of audits and composite inferences, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.operators import audit as U
from folia.operators import typeset
from folia.queries_layout import SQL as LAYOUT_SQL
from folia.queries_layout import geometry_findings, nested_parents
from folia.queries_ledgers import SQL as LEDGER_SQL
from folia.queries_ledgers import paragraph_groups
from folia.queries_reference import _BOX, _KINDS, _REG, _boxes, _regions, page_sequence_check, region_kind, second_review_sample
from folia.queries_reference import SQL as REFERENCE_SQL
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


@query(f"""WITH {_BOX}, p AS (SELECT DISTINCT page_id, right(page_id, 1) < '8' AS bd FROM region_proposals WHERE page_id IS NOT NULL), e AS (SELECT page_id, CASE WHEN right(id, 1) < '4' THEN 'pdf-object' ELSE 'ocr-layout' END AS s FROM bx WHERE right(page_id, 1) NOT IN ('0', 'f') AND (right(page_id, 1) <> '1' OR right(id, 1) >= '4')),
n AS (SELECT p.page_id, bd, count(*) FILTER (WHERE s = 'pdf-object') AS pdf, count(*) FILTER (WHERE s = 'ocr-layout') AS ocr FROM p LEFT JOIN e ON e.page_id = p.page_id GROUP BY 1, 2), m AS (SELECT *, CASE WHEN bd THEN pdf ELSE ocr END AS mine, CASE WHEN bd THEN ocr ELSE pdf END AS other FROM n)
SELECT page_id, CASE WHEN (mine > 0 OR other = 0) = bd THEN 'pdf-object' ELSE 'ocr-layout' END AS source, CASE WHEN mine > 0 THEN mine ELSE other END AS n, CASE WHEN mine > 0 THEN NULL WHEN other > 0 THEN 'preferred-layout-evidence-unavailable' ELSE 'layout-evidence-missing' END AS finding FROM m""")
def evidence_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence that each page is built from; some pages lack one kind or both."""
    pages = table(spark, sf_dir, "region_proposals").where("page_id is not null").select("page_id", (F.substring("page_id", -1, 1) < "8").alias("born_digital")).distinct()
    page, own = F.substring("page_id", -1, 1), F.substring("id", -1, 1)
    e = _boxes(spark, sf_dir).where(~page.isin("0", "f") & ((page != "1") | (own >= "4"))).select("page_id", F.when(own < "4", "pdf-object").otherwise("ocr-layout").alias("source"))
    return U.evidence_choice(pages, e)


@query(f"WITH {_REG} SELECT page_id, bool_and(coalesce(ocr_text = canonical_text, false)) AS faithful, count(*) AS n FROM reg WHERE kind = 'code' AND canonical_text IS NOT NULL GROUP BY 1")
def code_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.code_fidelity(_regions(spark, sf_dir).where("kind = 'code' and canonical_text is not null"), "page_id", "ocr_text", "canonical_text")


@query(f"""WITH {_BOX}, o AS (SELECT page_id, id, CASE kind WHEN 'figure' THEN 0 WHEN 'column' THEN 1 ELSE 2 END AS z, CASE WHEN kind NOT IN ('header', 'footer', 'page-number') THEN confidence_milli END AS ri FROM bx), r AS (SELECT *, coalesce(ri, count(ri) OVER (PARTITION BY page_id)) AS r FROM o)
SELECT page_id, id, (row_number() OVER (PARTITION BY page_id ORDER BY z, r, id) - 1)::INT AS position FROM r""")
def paint_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.when(F.col("kind") == "figure", 0).when(F.col("kind") == "column", 1).otherwise(2)
    index = F.when(~F.col("kind").isin("header", "footer", "page-number"), F.col("confidence_milli"))
    return U.paint_order(_boxes(spark, sf_dir).select("page_id", "id", z.alias("z_index"), index.alias("reading_index")))


@query(f"""WITH {_BOX}, w AS (SELECT DISTINCT page_id, unnest(source_region_ids) AS w FROM region_proposals WHERE revision = 1), p AS (SELECT page_id, unnest(source_region_ids) AS w FROM bx WHERE kind <> 'callout'), n AS (SELECT page_id, w, count(*) AS n FROM p GROUP BY 1, 2)
SELECT coalesce(w.page_id, n.page_id) AS page_id, count(*) FILTER (WHERE n IS NULL) AS missing, count(*) FILTER (WHERE n > 1 AND w.page_id IS NOT NULL) AS repeated, count(*) FILTER (WHERE w.page_id IS NULL) AS unknown FROM w FULL JOIN n ON w.page_id = n.page_id AND w.w = n.w GROUP BY 1""")
def word_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of the first revisions against the parts that the current proposals make of it."""
    words = table(spark, sf_dir, "region_proposals").where("revision = 1").select("page_id", F.explode("source_region_ids").alias("w"))
    parts = _boxes(spark, sf_dir).where("kind <> 'callout'").select("page_id", F.explode("source_region_ids").alias("w"))
    return U.partition_states(parts, words, "page_id", "w")


@query(f"""WITH {_BOX}, k AS (SELECT *, (ascii(right(id, 1)) % 5)::BIGINT AS t FROM bx), m AS (SELECT page_id, id, x0, y0, x1, y1, t + 1 AS a, t AS b, -t AS c, 2::BIGINT AS d, 1000 * t AS e, -7 AS f FROM k),
c AS (SELECT *, unnest([a * x0 + c * y0 + e, a * x0 + c * y1 + e, a * x1 + c * y0 + e, a * x1 + c * y1 + e]) AS x, unnest([b * x0 + d * y0 + f, b * x0 + d * y1 + f, b * x1 + d * y0 + f, b * x1 + d * y1 + f]) AS y FROM m)
SELECT page_id, id, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, a * d - b * c AS determinant FROM c GROUP BY page_id, id, a, b, c, d""")
def affine_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = (F.ascii(F.substring("id", -1, 1)) % 5).cast("bigint")
    return U.affine(_boxes(spark, sf_dir), t + 1, t, -t, F.lit(2).cast("bigint"), t * 1000, F.lit(-7).cast("bigint"))


@query("SELECT source_path, count(DISTINCT source_sha256) AS digests FROM candidate_manuals WHERE source_path IS NOT NULL AND source_sha256 IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_sha256) > 1 UNION ALL SELECT source_path, count(DISTINCT source_sha256) FROM source_selectors WHERE source_path IS NOT NULL AND source_sha256 IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_sha256) > 1")
def differing_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under which submissions or selectors recorded different contents."""
    return U.differing_digests(table(spark, sf_dir, "candidate_manuals"), "source_path", "source_sha256").unionByName(U.differing_digests(table(spark, sf_dir, "source_selectors"), "source_path", "source_sha256"))


@query(f"""WITH sm AS ({REFERENCE_SQL["second_review_sample"]}), sv AS (SELECT DISTINCT manual_id, page_index::VARCHAR AS page_key FROM documents WHERE manual_id IS NOT NULL AND page_index IS NOT NULL AND contains(text, chr(65533)))
SELECT manual_id, page_key, CASE WHEN max(s) = 2 THEN 'severe' ELSE 'sample' END AS reason FROM (SELECT manual_id, page_key, 1 AS s FROM sm UNION ALL SELECT manual_id, page_key, 2 FROM sv) GROUP BY 1, 2""")
def required_second_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample for a second review with all pages that hold an unresolved glyph."""
    severe = table(spark, sf_dir, "documents").where(F.col("manual_id").isNotNull() & F.col("page_index").isNotNull() & F.col("text").contains("�")).select("manual_id", F.col("page_index").cast("string").alias("page_key")).distinct()
    return U.with_severe(second_review_sample(spark, sf_dir), severe, "manual_id", "page_key")


@query(f"WITH {_BOX}, c AS (SELECT id, properties FROM region_proposals QUALIFY row_number() OVER (PARTITION BY id ORDER BY revision DESC, loaded_at DESC) = 1) SELECT id, array_to_string(list_transform(list_sort(map_entries(properties)), lambda e: e.key || '=' || e.value), ';') AS properties FROM c WHERE cardinality(properties) > 0")
def sorted_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of proposals as text in the order of their names."""
    df = table(spark, sf_dir, "region_proposals")
    last = df.groupBy("id").agg(F.max_by(F.struct("properties"), F.struct("revision", "loaded_at")).alias("r"))
    entries = F.transform(F.array_sort(F.map_entries("r.properties")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return last.where("size(r.properties) > 0").select("id", F.array_join(entries, ";").alias("properties"))


@query(r"""WITH sl AS (SELECT source_path, unnest(string_split(text, chr(10))) AS line FROM sources WHERE text IS NOT NULL), d AS (SELECT regexp_extract(line, '^\.([a-z_]+) +(\S+)', 1) AS k, regexp_extract(line, '^\.([a-z_]+) +(\S+)', 2) AS v FROM sl)
SELECT upper(k) AS name, min(v) AS value, min(v) <> max(v) AS conflict FROM d WHERE k <> '' AND NOT regexp_matches(v, '[|()]') GROUP BY 1""")
def source_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property lines made from directives and their first arguments, parsed again; names with several values conflict."""
    lines = table(spark, sf_dir, "sources").where("text is not null").select(F.explode(F.split("text", "\n")).alias("l"))
    k, v = (F.regexp_extract("l", r"^\.([a-z_]+) +(\S+)", i) for i in (1, 2))
    made = lines.where((k != "") & ~v.rlike("[|()]")).select(F.concat(F.lit("(DEFPROP "), k, F.lit(" |"), v, F.lit("| JUST-VALUE)")).alias("line"))
    return typeset.variables(made)


@query(f"""WITH kd0 AS ({REFERENCE_SQL["region_kind"]}), pg AS ({LEDGER_SQL["paragraph_groups"]}), rm AS (WITH {_REG} SELECT trim(source_text) AS t, count(DISTINCT page_id) AS pages, min(id) AS subject FROM reg WHERE trim(source_text) <> '' GROUP BY 1 HAVING count(DISTINCT page_id) >= 2)
SELECT semantic_kind AS kind, id AS subject, 1::BIGINT AS n FROM kd0 UNION ALL SELECT 'paragraph-group', first_id, n FROM pg UNION ALL SELECT 'running-matter', subject, pages FROM rm""")
def semantic_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals of one inference: the kind of every region, groups of prose, and matter that runs through pages."""
    kinds = region_kind(spark, sf_dir).select(F.col("semantic_kind").alias("kind"), F.col("id").alias("subject"), F.lit(1).cast("bigint").alias("n"))
    groups = paragraph_groups(spark, sf_dir).select(F.lit("paragraph-group").alias("kind"), F.col("first_id").alias("subject"), "n")
    texts = _regions(spark, sf_dir).select("id", "page_id", F.trim("source_text").alias("t")).where("t <> ''")
    running = texts.groupBy("t").agg(F.count_distinct("page_id").alias("n"), F.min("id").alias("subject")).where("n >= 2")
    return kinds.unionByName(groups).unionByName(running.select(F.lit("running-matter").alias("kind"), "subject", "n"))


@query(f"""WITH g AS ({LAYOUT_SQL["geometry_findings"]}), p AS ({LAYOUT_SQL["nested_parents"]}), d AS ({REFERENCE_SQL["dangling_references"]}), s AS ({REFERENCE_SQL["page_sequence_check"]}),
f AS (SELECT finding AS code, 'high' AS severity, 1::BIGINT AS n FROM g UNION ALL SELECT finding, 'high', 1 FROM p WHERE finding IS NOT NULL UNION ALL SELECT 'dangling-reference', 'high', n FROM d UNION ALL SELECT 'duplicate-page', 'medium', duplicates FROM s WHERE duplicates > 0 UNION ALL SELECT 'missing-page', 'medium', missing FROM s WHERE missing > 0)
SELECT code, severity, sum(n)::BIGINT AS n, (dense_rank() OVER (ORDER BY severity, code))::INT AS place FROM f GROUP BY 1, 2""")
def conformance_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of geometry, parents, references and sequences by code, in the order of a report (severity, then code)."""
    from pyspark.sql import Window

    from folia.queries_reference import dangling_references

    one = F.lit(1).cast("bigint").alias("n")
    row = lambda df, code, severity, n: df.select(code.alias("code"), F.lit(severity).alias("severity"), n)
    s = page_sequence_check(spark, sf_dir)
    parts = [
        row(geometry_findings(spark, sf_dir), F.col("finding"), "high", one), row(nested_parents(spark, sf_dir).where("finding is not null"), F.col("finding"), "high", one), row(dangling_references(spark, sf_dir), F.lit("dangling-reference"), "high", F.col("n")),
        row(s.where("duplicates > 0"), F.lit("duplicate-page"), "medium", F.col("duplicates").alias("n")), row(s.where("missing > 0"), F.lit("missing-page"), "medium", F.col("missing").alias("n")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    # There are as many rows as codes, so the report's order is one small window.
    return out.groupBy("code", "severity").agg(F.sum("n").alias("n")).withColumn("place", F.dense_rank().over(Window.orderBy("severity", "code")))
