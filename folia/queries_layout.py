"""Registered queries of layout reconstruction, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.operators import reconstruct as R
from folia.operators.hierarchy import clean_id
from folia.queries_reference import _BOX, _boxes, _regions, _REG
from folia.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Page of the layout tables.
WIDTH, HEIGHT = 612_000, 792_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_IDS = lambda c: f"lower(regexp_replace({c}, '^[\\s\\x0b\\x{{a0}}\\x{{2000}}-\\x{{200b}}\\x{{3000}}\\x{{feff}}]+|[\\s\\x0b\\x{{a0}}\\x{{2000}}-\\x{{200b}}\\x{{3000}}\\x{{feff}}]+$', '', 'g'))"
_CUR = f"""pr AS (SELECT page_id, id, kind, box.x0 AS x0, box.y0 AS y0, box.x1 AS x1, box.y1 AS y1, confidence_milli, source_region_ids, nullif({_IDS("parent_id")}, '') AS parent_id, treatment, intentional_exclusion_reason, status FROM (
 SELECT *, row_number() OVER (PARTITION BY {_IDS("id")} ORDER BY revision DESC, loaded_at DESC, parent_id DESC) AS rn FROM region_proposals) WHERE rn = 1)"""


def _proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per proposal: that of the highest revision, then of the latest load, with a clean parent."""
    df = table(spark, sf_dir, "region_proposals")
    fields = ("page_id", "id", "kind", "box", "confidence_milli", "source_region_ids", "parent_id", "treatment", "intentional_exclusion_reason", "status")
    last = df.groupBy(clean_id(F.col("id")).alias("_id")).agg(F.max_by(F.struct(*fields), F.struct("revision", "loaded_at", "parent_id")).alias("r"))
    rest = [F.col("r." + c).alias(c) for c in fields if c not in ("box", "parent_id")]
    return last.select(*rest, "r.box.x0", "r.box.y0", "r.box.x1", "r.box.y1", clean_id(F.col("r.parent_id")).alias("parent_id"))


def _on_page(df: DataFrame) -> DataFrame:
    return df.withColumns({"px0": F.lit(0), "py0": F.lit(0), "px1": F.lit(WIDTH), "py1": F.lit(HEIGHT)})


# Some kinds are taken away, so that the place on the page has to tell.
@query(f"""WITH {_BOX}, u AS (SELECT *, CASE WHEN right(id, 1) IN ('0', '1', '2', '3', '4', '5') THEN 'unknown' WHEN right(id, 1) = '6' THEN 'Text_Block' ELSE kind END AS k, CASE WHEN right(id, 1) IN ('0', '1') THEN ' 12 ' ELSE 'x' END AS t FROM bx),
v AS (SELECT page_id, id, confidence_milli AS c, CASE WHEN k = 'Text_Block' THEN 'text' WHEN k IN {R.DIRECT} THEN k WHEN k = 'unknown' AND y0 <= {HEIGHT * 7 // 100} THEN 'header' WHEN k = 'unknown' AND y1 >= {HEIGHT - HEIGHT * 7 // 100} THEN CASE WHEN t = ' 12 ' THEN 'page-number' ELSE 'footer' END
 WHEN k = 'unknown' AND (x0 <= {WIDTH // 10} OR x1 >= {WIDTH - WIDTH // 10}) AND x1 - x0 <= {WIDTH // 5} THEN 'marginalia' ELSE 'content-region' END AS physical_kind, k NOT IN {R.DIRECT} AND k <> 'Text_Block' AS review FROM u)
SELECT page_id, id, physical_kind, least(coalesce(c, 0), CASE WHEN NOT review THEN 1000 WHEN physical_kind IN ('header', 'footer') THEN 700 WHEN physical_kind = 'page-number' THEN 750 WHEN physical_kind = 'marginalia' THEN 650 ELSE 500 END)::INT AS confidence, review FROM v""")
def physical_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.substring("id", -1, 1)
    b = _boxes(spark, sf_dir).withColumns({"kind": F.when(last.isin("0", "1", "2", "3", "4", "5"), "unknown").when(last == "6", "Text_Block").otherwise(F.col("kind")), "text": F.when(last.isin("0", "1"), " 12 ").otherwise("x")})
    return R.physical_kinds(_on_page(b))


_WANT = "CASE kind WHEN 'caption' THEN 'figure' WHEN 'list-item' THEN 'list' WHEN 'table-cell' THEN 'table' END"


@query(f"""WITH {_CUR}, ch AS (SELECT *, {_WANT} AS want FROM pr WHERE kind IN ('caption', 'list-item', 'table-cell')),
f AS (SELECT c.page_id, c.id, count(*) AS n, min(b.id) AS one FROM ch c JOIN pr b ON b.page_id = c.page_id AND b.kind = c.want AND b.x0 <= c.x0 AND b.y0 <= c.y0 AND b.x1 >= c.x1 AND b.y1 >= c.y1 AND b.x1 > b.x0 AND b.y1 > b.y0 AND c.x1 > c.x0 AND c.y1 > c.y0 GROUP BY 1, 2),
o AS (SELECT c.page_id, c.id, c.kind, CASE WHEN p.id IS NOT NULL THEN p.id WHEN f.n = 1 THEN f.one END AS parent_id FROM ch c LEFT JOIN pr p ON p.page_id = c.page_id AND p.id = c.parent_id AND p.kind = c.want LEFT JOIN f ON f.page_id = c.page_id AND f.id = c.id)
SELECT *, CASE WHEN parent_id IS NULL THEN 'ambiguous-' || kind || '-parent' END AS finding FROM o""")
def nested_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.nested_parents(_proposals(spark, sf_dir))


@query(f"""WITH {_BOX}, s AS (SELECT page_id, x0, y0, x1, y1, CASE WHEN (x0 + x1) // 2 < {WIDTH // 2} THEN 1 WHEN (x0 + x1) // 2 > {WIDTH // 2} THEN 2 END AS column_index FROM bx WHERE kind NOT IN {R.NO_COLUMN} AND kind <> 'column' AND x1 - x0 < {WIDTH * 45 // 100}),
g AS (SELECT page_id, column_index, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n FROM s WHERE column_index IS NOT NULL GROUP BY 1, 2)
SELECT * FROM g QUALIFY count(*) OVER (PARTITION BY page_id) = 2 AND min(n) OVER (PARTITION BY page_id) >= 2 AND max(y0) OVER (PARTITION BY page_id) < min(y1) OVER (PARTITION BY page_id)""")
def column_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.column_proposals(_boxes(spark, sf_dir).where("kind <> 'column'"), width=WIDTH)


_GRAPH = f"""{_CUR}, al AS (SELECT c.*, p.kind AS p_kind, p.x0 AS p_x0 FROM pr c LEFT JOIN pr p ON p.page_id = c.page_id AND p.id = c.parent_id), lv AS (SELECT *, CASE WHEN page_id < 'page-4' THEN y0 * 1000 + x0 // 1000 END AS so FROM al WHERE treatment IS NOT NULL AND kind NOT IN ('header', 'footer', 'page-number')),
 pg AS (SELECT page_id, count(so) = count(*) AND count(DISTINCT so) = count(*) AS supplied FROM lv GROUP BY page_id),
 nx AS (SELECT l.*, supplied, lead(id) OVER w AS nid, lead(p_kind) OVER w AS nk, lead(x0) OVER w AS nx0, lead(y0) OVER w AS ny0, lead(x1) OVER w AS nx1, lead(y1) OVER w AS ny1 FROM lv l JOIN pg USING (page_id)
  WINDOW w AS (PARTITION BY l.page_id ORDER BY CASE WHEN supplied THEN so WHEN p_kind = 'column' THEN p_x0 ELSE x0 END, CASE WHEN NOT supplied THEN y0 END, CASE WHEN NOT supplied THEN x0 END, id)),
 am AS (SELECT *, NOT coalesce(p_kind = 'column' AND nk = 'column', false) AND (x1 <= nx0 OR nx1 <= x0) AND least(y1, ny1) - greatest(y0, ny0) > 0 AND (least(y1, ny1) - greatest(y0, ny0)) * 2 >= least(y1 - y0, ny1 - ny0) AS doubt FROM nx WHERE nid IS NOT NULL),
 edges AS (SELECT page_id, parent_id AS source_id, id AS target_id, 'contains' AS relation, 1000 AS confidence FROM al WHERE p_kind IS NOT NULL UNION ALL SELECT page_id, parent_id, id, 'table-cell', 1000 FROM al WHERE p_kind IS NOT NULL AND kind = 'table-cell'
  UNION ALL SELECT page_id, id, parent_id, 'caption-for', 900 FROM al WHERE p_kind IS NOT NULL AND kind = 'caption' UNION ALL SELECT page_id, id, nid, CASE WHEN doubt THEN 'adjacent' ELSE 'reading-next' END, CASE WHEN doubt THEN 400 WHEN supplied THEN 1000 ELSE 800 END FROM am)"""


def _graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.when(F.col("page_id") < "page-4", F.col("y0") * 1000 + F.floor(F.col("x0") / 1000))
    return R.reading_graph(_proposals(spark, sf_dir).withColumn("supplied_order", order))


@query(f"WITH {_GRAPH} SELECT * FROM edges")
def reading_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges; pages of the lower ids have a supplied order, which holds where it has no ties."""
    return _graph(spark, sf_dir)


_COVER = """ev AS (SELECT DISTINCT page_id, unnest(source_region_ids) AS source_id FROM region_proposals), ac AS (SELECT page_id, unnest(source_region_ids) AS source_id, intentional_exclusion_reason IS NOT NULL AS out FROM pr WHERE treatment IS NOT NULL OR intentional_exclusion_reason IS NOT NULL),
 cv AS (SELECT ev.page_id, ev.source_id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'multiple' WHEN out THEN 'excluded' ELSE 'treated' END AS state FROM ev LEFT JOIN (SELECT page_id, source_id, count(*) AS n, bool_or(out) AS out FROM ac GROUP BY 1, 2) c ON c.page_id = ev.page_id AND c.source_id = ev.source_id)"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = table(spark, sf_dir, "region_proposals").select("page_id", F.explode("source_region_ids").alias("source_id"))
    return R.coverage_report(evidence, _proposals(spark, sf_dir))


@query(f"WITH {_CUR}, {_COVER} SELECT * FROM cv WHERE source_id IS NOT NULL")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir).where("source_id is not null")


@query(f"""WITH {_GRAPH}, {_COVER}, ch AS (SELECT *, {_WANT} AS want FROM pr WHERE kind IN ('caption', 'list-item', 'table-cell')),
f AS (SELECT c.page_id, c.id, count(*) AS n FROM ch c JOIN pr b ON b.page_id = c.page_id AND b.kind = c.want AND b.x0 <= c.x0 AND b.y0 <= c.y0 AND b.x1 >= c.x1 AND b.y1 >= c.y1 AND b.x1 > b.x0 AND b.y1 > b.y0 AND c.x1 > c.x0 AND c.y1 > c.y0 GROUP BY 1, 2)
SELECT c.page_id, 'ambiguous-' || c.kind || '-parent' AS code, c.id AS subject, 'high' AS severity FROM ch c LEFT JOIN pr p ON p.page_id = c.page_id AND p.id = c.parent_id AND p.kind = c.want LEFT JOIN f ON f.page_id = c.page_id AND f.id = c.id WHERE p.id IS NULL AND coalesce(f.n, 0) <> 1
UNION ALL SELECT page_id, 'ambiguous-reading-order', least(source_id, target_id) || '/' || greatest(source_id, target_id), 'high' FROM edges WHERE relation = 'adjacent' UNION ALL SELECT page_id, 'incomplete-coverage-accounting', source_id, 'high' FROM cv WHERE state IN ('missing', 'multiple') AND source_id IS NOT NULL""")
def layout_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of one reconstruction: parents, reading order and coverage."""
    severe = F.lit("high").alias("severity")
    parents = nested_parents(spark, sf_dir).where("finding is not null").select("page_id", F.col("finding").alias("code"), F.col("id").alias("subject"), severe)
    order = _graph(spark, sf_dir).where("relation = 'adjacent'").select("page_id", F.lit("ambiguous-reading-order").alias("code"), F.concat_ws("/", F.least("source_id", "target_id"), F.greatest("source_id", "target_id")).alias("subject"), severe)
    cover = _coverage(spark, sf_dir).where("state in ('missing', 'multiple') and source_id is not null").select("page_id", F.lit("incomplete-coverage-accounting").alias("code"), F.col("source_id").alias("subject"), severe)
    return parents.unionByName(order).unionByName(cover)


_CELLS = f"""{_BOX}, tc AS (SELECT page_id, id, y0 // 40000 AS r, x0 // 60000 AS c, (y1 - y0) // 40000 + 1 AS rs, (x1 - x0) // 60000 + 1 AS cs FROM bx WHERE kind = 'table-cell')"""


def _scores(p: str, t: str, keys: str) -> str:
    return f"SELECT p.page_id AS pp, t.page_id AS tt, coalesce(p.page_id, t.page_id) AS page_id FROM (SELECT DISTINCT {keys} FROM {p}) p FULL JOIN (SELECT DISTINCT {keys} FROM {t}) t USING ({keys})"


@query(f"""WITH {_CELLS}, tr AS (SELECT * FROM tc WHERE right(id, 1) <> '0'), pd AS (SELECT page_id, id, r, c + (right(id, 1) = '1')::INT AS c, rs, cs FROM tc WHERE right(id, 1) <> '2'),
a AS ({_scores("pd", "tr", "page_id, r, c")}), b AS ({_scores("(SELECT * FROM pd WHERE rs > 1 OR cs > 1)", "(SELECT * FROM tr WHERE rs > 1 OR cs > 1)", "page_id, r, c, rs, cs")}),
g AS (SELECT page_id, count(*) FILTER (WHERE pp IS NOT NULL AND tt IS NOT NULL) AS tp, count(*) FILTER (WHERE tt IS NULL) AS fp, count(*) FILTER (WHERE pp IS NULL) AS fn FROM a GROUP BY 1),
h AS (SELECT page_id, count(*) FILTER (WHERE pp IS NOT NULL AND tt IS NOT NULL) AS tp, count(*) FILTER (WHERE tt IS NULL) AS fp, count(*) FILTER (WHERE pp IS NULL) AS fn FROM b GROUP BY 1),
f AS (SELECT g.page_id, g.tp, g.fp, g.fn, CASE WHEN 2 * g.tp + g.fp + g.fn = 0 THEN 1000 ELSE 2000 * g.tp // (2 * g.tp + g.fp + g.fn) END AS cell_f1, CASE WHEN h.page_id IS NULL OR 2 * h.tp + h.fp + h.fn = 0 THEN 1000 ELSE 2000 * h.tp // (2 * h.tp + h.fp + h.fn) END AS span_f1 FROM g LEFT JOIN h USING (page_id))
SELECT *, (cell_f1 + span_f1) // 2 AS combined_f1 FROM f""")
def table_cell_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and spans of each page as key sets: some cells are left out on either side, some moved by a column."""
    last = F.substring("id", -1, 1)
    cells = _boxes(spark, sf_dir).where("kind = 'table-cell'").select("page_id", "id", F.floor(F.col("y0") / 40000).alias("r"), F.floor(F.col("x0") / 60000).alias("c"), (F.floor((F.col("y1") - F.col("y0")) / 40000) + 1).alias("rs"), (F.floor((F.col("x1") - F.col("x0")) / 60000) + 1).alias("cs"))
    truth, found = cells.where(last != "0"), cells.where(last != "2").withColumn("c", F.col("c") + (last == "1").cast("int"))
    spanning = lambda df: df.where("rs > 1 or cs > 1")
    a = R.scores_milli(R.set_scores(found, truth, ["page_id", "r", "c"], ["page_id"])).select("page_id", "tp", "fp", "fn", F.col("f1").alias("cell_f1"))
    b = R.scores_milli(R.set_scores(spanning(found), spanning(truth), ["page_id", "r", "c", "rs", "cs"], ["page_id"])).select("page_id", F.col("f1").alias("span_f1"))
    both = a.join(b, "page_id", "left").withColumn("span_f1", F.coalesce("span_f1", F.lit(1000)))
    return both.withColumn("combined_f1", F.floor((F.col("cell_f1") + F.col("span_f1")) / 2))


@query(f"""WITH {_BOX} SELECT page_id, id, unnest(f) AS finding FROM (SELECT page_id, id, list_filter([CASE WHEN x0 IS NULL OR y0 IS NULL OR x1 IS NULL OR y1 IS NULL THEN 'missing-box' END, CASE WHEN x1 <= x0 OR y1 <= y0 THEN 'invalid-box' END, CASE WHEN x0 < 30000 OR y0 < 30000 OR x1 > 580000 OR y1 > 760000 THEN 'outside-page' END], lambda x: x IS NOT NULL) AS f FROM bx)""")
def geometry_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that are no boxes or leave the type area of their page."""
    b = _boxes(spark, sf_dir).withColumns({"px0": F.lit(30000), "py0": F.lit(30000), "px1": F.lit(580000), "py1": F.lit(760000)})
    return R.geometry_findings(b)


@query(f"""WITH {_BOX}, a AS (SELECT page_id, id, least(greatest(x0, 100000), 399999) AS x0, least(greatest(y0, 100000), 499999) AS y0, x1 AS r, y1 AS b FROM bx) SELECT page_id, id, x0, y0, greatest(least(r, 400000), x0 + 1) AS x1, greatest(least(b, 500000), y0 + 1) AS y1 FROM a""")
def clipped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes cut to one part of the page."""
    return R.clipped(_boxes(spark, sf_dir).withColumns({"px0": F.lit(100000), "py0": F.lit(100000), "px1": F.lit(400000), "py1": F.lit(500000)}))


@query(f"""WITH {_BOX}, a AS (SELECT *, CASE WHEN right(id, 1) IN ('0', '1', '2', '3') THEN 0 WHEN right(id, 1) IN ('4', '5', '6', '7') THEN 90 WHEN right(id, 1) IN ('8', '9', 'a', 'b') THEN 180 ELSE 270 END AS t FROM bx)
SELECT page_id, id, CASE t WHEN 0 THEN x0 WHEN 90 THEN y0 WHEN 180 THEN {WIDTH} - x1 ELSE {HEIGHT} - y1 END AS x0, CASE t WHEN 0 THEN {HEIGHT} - y1 WHEN 90 THEN x0 WHEN 180 THEN y0 ELSE {WIDTH} - x1 END AS y0,
 CASE t WHEN 0 THEN x1 WHEN 90 THEN y1 WHEN 180 THEN {WIDTH} - x0 ELSE {HEIGHT} - y0 END AS x1, CASE t WHEN 0 THEN {HEIGHT} - y0 WHEN 90 THEN x1 WHEN 180 THEN y1 ELSE {WIDTH} - x0 END AS y1 FROM a""")
def rotated_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.substring("id", -1, 1)
    turn = F.when(last.isin("0", "1", "2", "3"), 0).when(last.isin("4", "5", "6", "7"), 90).when(last.isin("8", "9", "a", "b"), 180).otherwise(270)
    return R.rotated(_boxes(spark, sf_dir).withColumn("rotation", turn), width=WIDTH, height=HEIGHT)


@query(f"""WITH {_BOX}, r AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY x0, y0, id) AS t, CASE WHEN confidence_milli IS NOT NULL THEN row_number() OVER (PARTITION BY page_id ORDER BY y0, x0, id) END AS p FROM bx)
SELECT a.page_id, coalesce(c, 0)::BIGINT AS correct_pairs, n * (n - 1) // 2 AS total_pairs FROM (SELECT page_id, count(*) AS n FROM r GROUP BY 1) a LEFT JOIN (SELECT x.page_id, count(*) FILTER (WHERE x.p < y.p) AS c FROM r x JOIN r y ON x.page_id = y.page_id AND x.t < y.t GROUP BY 1) USING (page_id)""")
def order_accuracy_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in order where boxes without a confidence have no place in the predicted order."""
    from pyspark.sql import Window

    rank = lambda *c: F.row_number().over(Window.partitionBy("page_id").orderBy(*c))
    b = _boxes(spark, sf_dir).select("page_id", rank("x0", "y0", "id").alias("t"), F.when(F.col("confidence_milli").isNotNull(), rank("y0", "x0", "id")).alias("p"))
    return R.order_accuracy_with_gaps(b)


@query(f"""WITH {_REG}, d AS (SELECT coalesce(kind, '-') AS kind, reference_box IS NOT NULL AS r, generated_box IS NOT NULL AS g, coalesce(greatest(least(reference_box[1] + reference_box[3], generated_box[1] + generated_box[3]) - greatest(reference_box[1], generated_box[1]), 0.0) * greatest(least(reference_box[2] + reference_box[4], generated_box[2] + generated_box[4]) - greatest(reference_box[2], generated_box[2]), 0.0) > 0, false) AS hit FROM reg),
c AS (SELECT kind, count(*) FILTER (WHERE r AND g AND hit) AS tp, count(*) FILTER (WHERE g AND NOT (r AND hit)) AS fp, count(*) FILTER (WHERE r AND NOT (g AND hit)) AS fn FROM d GROUP BY 1)
SELECT *, CASE WHEN tp + fp = 0 THEN 1000 ELSE tp * 1000 // (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 1000 ELSE tp * 1000 // (tp + fn) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 1000 ELSE 2000 * tp // (2 * tp + fp + fn) END AS f1 FROM c""")
def detection_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 in thousandths of regions whose boxes meet."""
    r = _regions(spark, sf_dir)
    lo = lambda i: F.greatest(F.col("reference_box")[i], F.col("generated_box")[i])
    hi = lambda i: F.least(F.col("reference_box")[i] + F.col("reference_box")[i + 2], F.col("generated_box")[i] + F.col("generated_box")[i + 2])
    there = F.col("reference_box").isNotNull() & F.col("generated_box").isNotNull()
    meet = F.coalesce(there & (F.greatest(hi(0) - lo(0), F.lit(0.0)) * F.greatest(hi(1) - lo(1), F.lit(0.0)) > 0), F.lit(False))
    counts = r.groupBy(F.coalesce("kind", F.lit("-")).alias("kind")).agg(F.count_if(meet).alias("tp"), F.count_if(F.col("generated_box").isNotNull() & ~meet).alias("fp"), F.count_if(F.col("reference_box").isNotNull() & ~meet).alias("fn"))
    return R.scores_milli(counts)
