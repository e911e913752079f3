"""Registered queries of review ledgers and pixel masks, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.functions.digests import sha256
from folia.operators import ledgers as G
from folia.operators import pixels as P
from folia.operators import selection
from folia.operators.layout import overlapping
from folia.operators.typeset import DIRECTIVE, source_lines
from folia.queries_reference import _AREA, _BOX, _LEAVES, _MEET, _PARENTS, _REG, _SPACE, _boxes, _regions
from folia.queries_sources import _LN
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


_PROSE = r"(?i)^\s*(part|chapter|section)\s+[A-Za-z0-9.]|^\s*([-*•]|[0-9]+[.)]|[A-Za-z][.)])\s"


@query(f"""WITH {_REG}, o AS (SELECT page_id, id, NOT regexp_matches(coalesce(source_text, ''), '{_PROSE}') AS prose, row_number() OVER (PARTITION BY page_id ORDER BY id) + CASE WHEN right(id, 1) >= 'c' THEN 100000 ELSE 0 END AS ro FROM reg),
s AS (SELECT *, CASE WHEN prose AND NOT coalesce(lag(prose) OVER w AND ro = lag(ro) OVER w + 1, false) THEN 1 ELSE 0 END AS st FROM o WINDOW w AS (PARTITION BY page_id ORDER BY ro, id)), r AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY ro, id) AS run FROM s)
SELECT page_id, arg_min(id, ro) AS first_id, arg_max(id, ro) AS last_id, count(*) AS n FROM r WHERE prose GROUP BY page_id, run HAVING count(*) >= 2""")
def paragraph_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of prose regions in an order by id, in which some regions stand far behind."""
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("page_id").orderBy("id")) + F.when(F.substring("id", -1, 1) >= "c", 100000).otherwise(0)
    return G.paragraph_groups(_regions(spark, sf_dir).select("page_id", "id", order.alias("reading_order"), (~F.coalesce("source_text", F.lit("")).rlike(_PROSE)).alias("prose")))


@query("SELECT id, arg_max(status, (revision * 1000000000000000 + epoch_us(recorded_at))) FILTER (WHERE status IN ('accepted-evidence', 'review') AND revision IS NOT NULL AND recorded_at IS NOT NULL) AS decision, count(*) AS n_revisions FROM region_proposals GROUP BY id")
def latest_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("revision") * F.lit(1_000_000_000_000_000) + F.unix_micros("recorded_at")
    return G.latest_decisions(table(spark, sf_dir, "region_proposals").select("id", "status", order.alias("o")), "id", F.col("o"), "status", ("accepted-evidence", "review"))


@query(f"""WITH {_LN}, s AS (SELECT *, CASE WHEN lag(name) OVER w IS NOT DISTINCT FROM name AND lag(line_no) OVER w IS NOT NULL THEN 0 ELSE 1 END AS st FROM ln WINDOW w AS (PARTITION BY source_path ORDER BY line_no)), r AS (SELECT *, sum(st) OVER (PARTITION BY source_path ORDER BY line_no) AS run FROM s)
SELECT source_path, name AS style, min(line_no) AS first, max(line_no) AS last, count(*) AS n FROM r GROUP BY source_path, run, name""")
def merged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring lines of one directive as one span."""
    lines = source_lines(table(spark, sf_dir, "sources")).withColumn("style", F.lower(F.regexp_extract("line", DIRECTIVE, 1)))
    return G.merged_spans(lines, "source_path", "line_no", "style")


_APPROVED = "WITH n AS (SELECT max(doc_id) + 1 AS n FROM documents), g AS (SELECT event_id % n.n AS page_id, user_id AS reviewer, event_type FROM events, n), d AS (SELECT doc_id AS page_id, sha256(text) AS t, sha256(coalesce(lang, '')) AS l FROM documents)"


@query(f"{_APPROVED} SELECT d.page_id, count(DISTINCT reviewer) FILTER (WHERE event_type <> 'error' AND t IS NOT NULL) AS reviewers, count(*) FILTER (WHERE NOT (coalesce(event_type <> 'error', false) AND t IS NOT NULL)) AS stale FROM g JOIN d USING (page_id) GROUP BY 1")
def approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers of pages; approvals of type error name another digest."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), sha256(F.col("text")).alias("text_digest"), sha256(F.coalesce("lang", F.lit(""))).alias("lang_digest"))
    n = table(spark, sf_dir, "documents").agg((F.max("doc_id") + 1).alias("n")).first().n or 1
    e = table(spark, sf_dir, "events").select((F.col("event_id") % n).alias("page_id"), F.col("user_id").alias("reviewer"), "event_type")
    given = e.join(d, "page_id").select("page_id", "reviewer", F.when(F.col("event_type") != "error", F.col("text_digest")).otherwise("other").alias("text_digest"), "lang_digest")
    return G.approvals(given, d, ["text_digest", "lang_digest"])


@query("""WITH o AS (SELECT source_path, count(*) AS entries, min(source_sha256) AS lo, max(source_sha256) AS hi FROM (SELECT DISTINCT selector_id, source_path, source_sha256 FROM source_selectors) GROUP BY 1)
SELECT coalesce(o.source_path, s.source_path) AS source_path, CASE WHEN s.source_path IS NULL THEN 'unknown' WHEN entries IS NULL THEN 'missing' WHEN coalesce(lo <> s.source_sha256 OR hi <> s.source_sha256, true) THEN 'stale' WHEN entries > 1 THEN 'repeated' ELSE 'valid' END AS state, coalesce(entries, 0) AS entries FROM o FULL JOIN sources s ON s.source_path = o.source_path""")
def overlay_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    overlay = table(spark, sf_dir, "source_selectors").select("selector_id", "source_path", "source_sha256").distinct()
    return G.overlay_states(overlay, table(spark, sf_dir, "sources"), "source_path", "source_sha256")


_PATCHES = f"""{_REG}, pt AS (SELECT id, page_id, source_text AS text, CASE WHEN kind = 'math' AND right(id, 1) = '0' THEN 'relabel' ELSE 'replace-text' END AS operation, CASE WHEN right(id, 2) = '00' THEN 'x' ELSE sha256(source_text) END AS guard, canonical_text AS new_text, CASE WHEN right(id, 2) = 'ff' THEN 2 ELSE 1 END AS n FROM reg WHERE canonical_text IS NOT NULL AND source_text IS NOT NULL),
 fl AS (SELECT *, CASE WHEN n > 1 THEN 'duplicate' WHEN operation <> 'replace-text' THEN 'refused' WHEN guard <> sha256(text) THEN 'stale' END AS fault FROM pt)"""


@query(f"WITH {_PATCHES}, st AS (SELECT page_id, id, text, new_text, coalesce(fault, CASE WHEN count(fault) OVER (PARTITION BY page_id) > 0 THEN 'held-back' ELSE 'applied' END) AS status FROM fl) SELECT page_id, id, status, sha256(CASE WHEN status = 'applied' THEN new_text ELSE text END) AS sha256 FROM st")
def guarded_patch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed texts put in for source texts behind guards; some patches are stale, refused or given twice."""
    r = _regions(spark, sf_dir).where("canonical_text is not null and source_text is not null")
    tail = F.substring("id", -2, 2)
    operation = F.when((F.col("kind") == "math") & (F.substring("id", -1, 1) == "0"), "relabel").otherwise("replace-text")
    p = r.select("id", operation.alias("operation"), F.when(tail == "00", "x").otherwise(sha256(F.col("source_text"))).alias("guard"), F.col("canonical_text").alias("new_text"), F.explode(F.sequence(F.lit(1), F.when(tail == "ff", 2).otherwise(1))).alias("patch_id"))
    return G.patched(p, r.select("page_id", "id", F.col("source_text").alias("text"))).select("page_id", "id", "status", sha256(F.col("text")).alias("sha256"))


@query(f"""WITH {_REG}, s AS (SELECT source_text AS l, ocr_text AS r, trim(regexp_replace(source_text, '{_SPACE}+', ' ', 'g')) AS a, trim(regexp_replace(ocr_text, '{_SPACE}+', ' ', 'g')) AS b FROM reg WHERE source_text IS NOT NULL AND ocr_text IS NOT NULL),
c AS (SELECT CASE WHEN l = r THEN 'equal' WHEN a = b THEN 'whitespace' WHEN regexp_replace(a, '^[0-9]+(\\.[0-9]+)*\\.? +', '') = regexp_replace(b, '^[0-9]+(\\.[0-9]+)*\\.? +', '') THEN 'section-number' WHEN a <> '' AND b <> '' AND (contains(a, b) OR contains(b, a)) THEN 'span-fragment' ELSE 'other' END AS category FROM s)
SELECT g.category, count(c.category) AS n FROM (SELECT unnest(['equal', 'whitespace', 'section-number', 'span-fragment', 'other']) AS category) g LEFT JOIN c ON c.category = g.category GROUP BY 1""")
def disagreement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the witnesses of a region differ, with every category."""
    r = _regions(spark, sf_dir).where("source_text is not null and ocr_text is not null")
    return G.counted_categories(r.select(G.disagreement(F.col("source_text"), F.col("ocr_text")).alias("c")), "c")


@query("""WITH e AS (SELECT source_path FROM sources WHERE n_lines % 7 <> 0), a AS (SELECT source_path FROM source_selectors WHERE page_number % 50 <> 0)
SELECT source_path, 'expected' AS side FROM (SELECT source_path FROM e EXCEPT SELECT source_path FROM a) WHERE source_path IS NOT NULL UNION ALL SELECT source_path, 'actual' FROM (SELECT source_path FROM a EXCEPT SELECT source_path FROM e) WHERE source_path IS NOT NULL""")
def file_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of some lengths against those that selectors of some pages name."""
    return G.set_difference(table(spark, sf_dir, "sources").where("n_lines % 7 <> 0"), table(spark, sf_dir, "source_selectors").where("page_number % 50 <> 0"), "source_path")


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_discount AS width_error, l_tax AS baseline_error, l_quantity AS coverage FROM lineitem WHERE l_quantity >= 25 QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount, l_tax, -l_quantity, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) = 1")
def ranked_substitutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substitutes by width error, baseline error, coverage and key, among those that cover enough."""
    d = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_discount").alias("width_error"), F.col("l_tax").alias("baseline_error"), F.col("l_quantity").alias("coverage"), "l_suppkey", "l_extendedprice")
    order = [F.col("width_error"), F.col("baseline_error"), -F.col("coverage"), *(F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"))]
    return G.best_ranked(d, "l_partkey", order, F.col("coverage") >= 25).drop("l_suppkey", "l_extendedprice")


@query(f"WITH {_REG} SELECT id, sha256(nfc_normalize(regexp_replace(replace(replace(ocr_text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\\n$', ''))) AS sha256 FROM reg WHERE ocr_text IS NOT NULL")
def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of recognised texts with one line end, composed characters and no final line end."""
    return G.normalized(_regions(spark, sf_dir).where("ocr_text is not null"), "id", "ocr_text").select("id", sha256(F.col("text")).alias("sha256"))


@query(f"WITH {_REG}, n AS (SELECT id, kind, replace(replace(ocr_text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM reg WHERE ocr_text IS NOT NULL) SELECT id, sha256(CASE WHEN coalesce(kind, '') = 'code' THEN trim(t, chr(10)) ELSE trim(regexp_replace(t, '{_SPACE}+', ' ', 'g')) END) AS sha256 FROM n")
def semantic_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what a text says: code without outer line ends, prose with single blanks."""
    t = F.replace(F.replace(F.col("ocr_text"), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    said = F.when(F.coalesce("kind", F.lit("")) == "code", F.trim(t, F.lit("\n"))).otherwise(T.prose_signature(t))
    return _regions(spark, sf_dir).where("ocr_text is not null").select("id", sha256(said).alias("sha256"))


@query("WITH ln AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)) SELECT doc_id, pos::INT AS pos, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos)::INT AS occurrence FROM ln QUALIFY occurrence > 1")
def line_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stood in their document before, with the number of the occurrence."""
    from pyspark.sql import Window

    from folia.operators.lines import document_lines

    lines = document_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "pos", F.row_number().over(Window.partitionBy("doc_id", "line").orderBy("pos")).alias("occurrence")).where("occurrence > 1")


@query(f"""WITH {_REG}, w AS (SELECT id, 'ocr' AS engine, canonical_text AS c, ocr_text AS t FROM reg UNION ALL SELECT id, 'source', canonical_text, source_text FROM reg) SELECT engine, id, CASE WHEN c IS NULL THEN 'extra' ELSE 'omitted' END AS state, coalesce(length(c), 0)::INT AS characters FROM w WHERE (c IS NOT NULL AND coalesce(t, '') = '') OR (c IS NULL AND t IS NOT NULL)""")
def omitted_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region that an engine lacks or has beyond the truth."""
    engines = F.array(F.struct(F.lit("ocr").alias("engine"), F.col("ocr_text").alias("t")), F.struct(F.lit("source").alias("engine"), F.col("source_text").alias("t")))
    each = _regions(spark, sf_dir).select("id", F.col("canonical_text").alias("c"), F.explode(engines).alias("e"))
    hit = (F.col("c").isNotNull() & (F.coalesce("e.t", F.lit("")) == "")) | (F.col("c").isNull() & F.col("e.t").isNotNull())
    return each.where(hit).select("e.engine", "id", F.when(F.col("c").isNull(), "extra").otherwise("omitted").alias("state"), F.coalesce(F.length("c"), F.lit(0)).alias("characters"))


@query(f"""WITH {_BOX}, m AS (SELECT a.page_id, a.id AS line_id, a.x0, a.y0, b.id AS region_id, {_AREA} AS s FROM bx a JOIN bx b ON {_MEET} WHERE a.kind IN {_LEAVES} AND b.kind IN {_PARENTS}), r AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY s DESC, region_id DESC) = 1)
SELECT r.page_id, region_id, count(*) AS n_lines, sha256(string_agg(line_id, CASE WHEN k.kind = 'table' THEN chr(10) ELSE ' ' END ORDER BY y0, x0, line_id)) AS sha256 FROM r JOIN (SELECT id, kind FROM bx) k ON k.id = region_id GROUP BY 1, 2, k.kind""".replace("string_agg(line_id, CASE WHEN k.kind = 'table' THEN chr(10) ELSE ' ' END ORDER BY y0, x0, line_id)", "CASE WHEN k.kind = 'table' THEN string_agg(line_id, chr(10) ORDER BY y0, x0, line_id) ELSE string_agg(line_id, ' ' ORDER BY y0, x0, line_id) END"))
def assembled_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines put together in the region they share most with (ties: the greater id), tables line by line."""
    b = _boxes(spark, sf_dir).select("page_id", "id", "kind", "x0", "y0", "x1", "y1")
    shared = (F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")) * (F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0"))
    met = overlapping(b.where(F.col("kind").isin(*_LEAVES)), b.where(F.col("kind").isin(*_PARENTS))).withColumn("shared", shared)
    best = met.groupBy("page", "a_id", "a_x0", "a_y0").agg(F.max(F.struct("shared", F.col("b_id").alias("id"), F.col("b_kind").alias("kind"))).alias("b"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("a_y0", "a_x0", "a_id"))), lambda x: x["a_id"])
    g = best.groupBy(F.col("page").alias("page_id"), F.col("b.id").alias("region_id"), F.col("b.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"), rows.alias("t"))
    text = F.when(F.col("kind") == "table", F.array_join("t", "\n")).otherwise(F.array_join("t", " "))
    return g.select("page_id", "region_id", "n_lines", sha256(text).alias("sha256"))


@query("""WITH p AS (SELECT DISTINCT manual_id, p.page_index AS page_index, p.tags AS tags FROM (SELECT manual_id, unnest(candidate_pages) AS p FROM candidate_manuals)), j AS (SELECT d.doc_id, d.page_class, t.tag FROM documents d JOIN (SELECT DISTINCT manual_id, page_index, unnest(tags) AS tag FROM p) t ON t.manual_id = d.manual_id AND t.page_index = d.page_index WHERE tag IS NOT NULL),
r AS (SELECT DISTINCT page_class, tag, doc_id FROM j), k AS (SELECT *, row_number() OVER (PARTITION BY page_class, tag ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY page_class, tag) AS n FROM r)
SELECT page_class, tag, doc_id, n < 3 AS short FROM k WHERE rn <= 3""")
def tagged_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three documents of each class and tag of their page; strata with fewer are marked."""
    pages = table(spark, sf_dir, "candidate_manuals").select("manual_id", F.explode("candidate_pages").alias("p")).select("manual_id", "p.page_index", F.explode("p.tags").alias("tag")).where("tag is not null").distinct()
    each = table(spark, sf_dir, "documents").select("doc_id", "page_class", "manual_id", "page_index").join(pages, ["manual_id", "page_index"]).select("page_class", "tag", "doc_id").distinct()
    top = selection.top_per_stratum(each, ["page_class", "tag"], ["doc_id"], 3).drop("rank")
    counts = each.groupBy("page_class", "tag").agg(F.count(F.lit(1)).alias("n"))
    on = top["page_class"].eqNullSafe(counts["page_class"]) & (top["tag"] == counts["tag"])
    return top.join(counts, on).select(top["page_class"], top["tag"], "doc_id", (F.col("n") < 3).alias("short"))


@query("""WITH q AS (SELECT DISTINCT manual_id, page_index FROM documents WHERE manual_id IS NOT NULL AND page_index IS NOT NULL), p AS (SELECT DISTINCT manual_id, p.page_index AS page_index FROM (SELECT manual_id, unnest(candidate_pages) AS p FROM candidate_manuals)), a AS (SELECT manual_id, bool_or(coalesce(truth.status = 'reviewed', false)) AS reviewed, bool_or(truth.evidence.kind IS NOT NULL) AS evidence FROM candidate_manuals GROUP BY 1)
SELECT q.manual_id, q.page_index, concat_ws(',', CASE WHEN p.manual_id IS NULL THEN 'no-package' END, CASE WHEN a.manual_id IS NULL THEN 'no-inventory' END, CASE WHEN a.reviewed = false THEN 'not-reviewed' END, CASE WHEN a.evidence = false THEN 'no-evidence' END) AS reasons FROM q LEFT JOIN p ON p.manual_id = q.manual_id AND p.page_index = q.page_index LEFT JOIN a ON a.manual_id = q.manual_id""")
def queue_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with what is missing for it."""
    q = table(spark, sf_dir, "documents").where("manual_id is not null and page_index is not null").select("manual_id", "page_index").distinct()
    c = table(spark, sf_dir, "candidate_manuals")
    p = c.select("manual_id", F.explode("candidate_pages").alias("p")).select("manual_id", "p.page_index").distinct().withColumn("package", F.lit(True))
    a = c.groupBy("manual_id").agg(F.bool_or(F.coalesce(F.col("truth.status") == "reviewed", F.lit(False))).alias("reviewed"), F.bool_or(F.col("truth.evidence.kind").isNotNull()).alias("evidence"))
    reasons = F.concat_ws(",", F.when(F.col("package").isNull(), "no-package"), F.when(F.col("reviewed").isNull(), "no-inventory"), F.when(~F.col("reviewed"), "not-reviewed"), F.when(~F.col("evidence"), "no-evidence"))
    return q.join(p, ["manual_id", "page_index"], "left").join(a, "manual_id", "left").select("manual_id", "page_index", reasons.alias("reasons"))


@query("SELECT stage_key, count(*) AS n FROM (SELECT sha256(concat_ws(chr(31), 'stage', coalesce(source_sha256, ''), coalesce(page_count::VARCHAR, ''), coalesce(array_to_string(list_sort(intended_page_classes), ','), ''))) AS stage_key FROM candidate_manuals) GROUP BY 1")
def stage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of stages by the digest of their inputs, each once with its number of submissions."""
    c = table(spark, sf_dir, "candidate_manuals")
    key = sha256(F.concat_ws("\x1f", F.lit("stage"), F.coalesce("source_sha256", F.lit("")), F.coalesce(F.col("page_count").cast("string"), F.lit("")), F.coalesce(F.array_join(F.array_sort("intended_page_classes"), ","), F.lit(""))))
    return c.groupBy(key.alias("stage_key")).agg(F.count(F.lit(1)).alias("n"))


# --- masks: the places of some signs on the page of a document -----------------------------------------------------

_PX = r"""ch AS (SELECT doc_id AS mask_id, y, generate_subscripts(c, 1) - 1 AS x, unnest(c) AS c FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS y, string_split(unnest(l), '') AS c FROM (SELECT doc_id, string_split(regexp_replace(text, '[^\x00-\x7f]', '?', 'g'), chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
 px AS (SELECT mask_id, y::INT AS y, x::INT AS x, c FROM ch WHERE c IN ('(', ')', '*', '-', '.', '?')), ed AS (SELECT p.mask_id, p.y, p.x, count(q.y) AS n4 FROM px p LEFT JOIN px q ON q.mask_id = p.mask_id AND abs(q.y - p.y) + abs(q.x - p.x) = 1 AND q.y BETWEEN p.y - 1 AND p.y + 1 GROUP BY 1, 2, 3)"""


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.regexp_replace("text", r"[^\x00-\x7f]", "?")
    lines = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("mask_id"), F.posexplode(F.split(plain, "\n")).alias("y", "line"))
    return lines.where(F.col("line") != "").select("mask_id", "y", F.posexplode(F.split("line", "")).alias("x", "c")).where(F.col("c").isin("(", ")", "*", "-", ".", "?"))


@query(f"WITH {_PX} SELECT mask_id, count(*) AS pixels, count(*) FILTER (WHERE n4 < 4) AS edges, sum(n4)::BIGINT AS links FROM ed GROUP BY 1")
def mask_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels and edge pixels of every mask."""
    n = P.neighbours(_pixels(spark, sf_dir))
    return n.groupBy("mask_id").agg(F.count(F.lit(1)).alias("pixels"), F.count_if(F.col("n4") < 4).alias("edges"), F.sum("n4").alias("links"))


_COMP = f"""{_PX}, nd AS (SELECT *, mask_id || ':' || lpad(y::VARCHAR, 9, '0') || ':' || lpad(x::VARCHAR, 9, '0') AS id FROM px), sh AS (SELECT id, mask_id, y + dy AS y, x + dx AS x FROM nd, (SELECT unnest([-1, -1, -1, 0, 0, 1, 1, 1]) AS dy, unnest([-1, 0, 1, -1, 1, -1, 0, 1]) AS dx)), eg AS (SELECT sh.id AS u, nd.id AS v FROM sh JOIN nd USING (mask_id, y, x)),
 rc AS (SELECT id, id AS c FROM nd UNION SELECT eg.v, rc.c FROM rc JOIN eg ON eg.u = rc.id), cp AS (SELECT nd.mask_id, nd.y, nd.x, nd.c AS sign, m.component FROM nd JOIN (SELECT id, min(c) AS component FROM rc GROUP BY 1) m USING (id))"""


@query(f"""WITH RECURSIVE {_COMP}, g AS (SELECT mask_id, component, count(*) AS n, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1 FROM cp GROUP BY 1, 2)
SELECT *, CASE WHEN n = 1 THEN 'dot' WHEN n = (y1 - y0) * (x1 - x0) AND least(y1 - y0, x1 - x0) = 1 THEN 'rule' WHEN n = (y1 - y0) * (x1 - x0) THEN 'rectangle' ELSE 'other' END AS shape FROM g""")
def mask_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-connected components with their tight box and shape."""
    return P.component_shapes(P.components(_pixels(spark, sf_dir)))


@query(f"WITH RECURSIVE {_COMP} SELECT mask_id, component, count(*) AS n, count(*) FILTER (WHERE sign IN ('(', ')')) AS missing, round(count(*) FILTER (WHERE sign IN ('(', ')')) * (25.4 / 300) * (25.4 / 300), 9)::DOUBLE AS area_mm2 FROM cp GROUP BY 1, 2 HAVING count(*) FILTER (WHERE sign IN ('(', ')')) > 0")
def component_omissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of which a candidate without brackets lacks pixels."""
    p = _pixels(spark, sf_dir)
    return P.component_omissions(p, p.where(~F.col("c").isin("(", ")")))


@query(f"""WITH {_PX}, ly AS (SELECT mask_id, y, x, 'a' AS layer FROM px WHERE c IN ('(', ')', '*') UNION ALL SELECT mask_id, y, x, 'b' FROM px WHERE c IN ('*', '-') UNION ALL SELECT mask_id, y, x + 1, 'b' FROM px WHERE c = '?'), o AS (SELECT mask_id, y, x, count(DISTINCT layer) AS n FROM ly GROUP BY 1, 2, 3)
SELECT coalesce(o.mask_id, px.mask_id) AS mask_id, coalesce(o.y, px.y) AS y, coalesce(o.x, px.x) AS x, CASE WHEN n IS NULL THEN 'residual' WHEN px.y IS NULL THEN 'outside' ELSE 'shared' END AS finding FROM o FULL JOIN px ON px.mask_id = o.mask_id AND px.y = o.y AND px.x = o.x WHERE n IS NULL OR px.y IS NULL OR n > 1""")
def mask_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers of a mask that overlap in one sign, leave the mask for another and leave some pixels over."""
    p = _pixels(spark, sf_dir)
    layer = lambda name, test, dx=0: p.where(test).select("mask_id", "y", (F.col("x") + dx).alias("x"), F.lit(name).alias("layer"))
    layers = layer("a", F.col("c").isin("(", ")", "*")).unionByName(layer("b", F.col("c").isin("*", "-"))).unionByName(layer("b", F.col("c") == "?", 1))
    return P.layer_findings(p, layers)


@query(f"WITH {_PX}, lb AS (SELECT doc_id AS mask_id, doc_id % 5 AS y0, 10 AS x0, doc_id % 5 + 4 AS y1, 40 AS x1 FROM documents) SELECT mask_id, count(*) AS pixels FROM px WHERE NOT EXISTS (SELECT 1 FROM lb WHERE lb.mask_id = px.mask_id AND px.y >= y0 AND px.y < y1 AND px.x >= x0 AND px.x < x1) GROUP BY 1")
def label_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels that are left outside of one label box for every mask."""
    k = F.col("doc_id")
    labels = table(spark, sf_dir, "documents").select(k.alias("mask_id"), (k % 5).alias("y0"), F.lit(10).alias("x0"), (k % 5 + 4).alias("y1"), F.lit(40).alias("x1"))
    return P.without_labels(_pixels(spark, sf_dir), labels).groupBy("mask_id").agg(F.count(F.lit(1)).alias("pixels"))


@query(f"""WITH {_PX}, qx AS (SELECT mask_id, y, x FROM px WHERE c NOT IN ('-', '.')), eq AS (SELECT p.mask_id, p.y, p.x FROM qx p LEFT JOIN qx q ON q.mask_id = p.mask_id AND abs(q.y - p.y) + abs(q.x - p.x) = 1 AND q.y BETWEEN p.y - 1 AND p.y + 1 GROUP BY 1, 2, 3 HAVING count(q.y) < 4)
SELECT e.mask_id, count(*) AS edges, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM eq WHERE eq.mask_id = e.mask_id AND eq.y BETWEEN e.y - 1 AND e.y + 1 AND abs(eq.y - e.y) + abs(eq.x - e.x) <= 1)) AS recalled FROM ed e WHERE n4 < 4 GROUP BY 1""")
def edge_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge pixels that a candidate without dots and dashes has within one step."""
    p = _pixels(spark, sf_dir)
    return P.edge_recall(p, p.where(~F.col("c").isin("-", ".")))


@query("""WITH ln AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)), d AS (SELECT doc_id, pos, min((length(line) > 30)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS dark FROM ln) SELECT doc_id, least(sum(dark), count(*) // 8)::BIGINT AS run, count(*) AS n FROM d GROUP BY 1""")
def border_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full lines at the head of a document as a dark border."""
    from folia.operators.lines import document_lines

    return P.border_runs(document_lines(table(spark, sf_dir, "documents")), "doc_id", "pos", F.length("line") > 30)
