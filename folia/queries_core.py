"""Registered queries of the core: pN_ of the general problems and the engine's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.operators import flatten, hierarchy
from folia.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.unrooted(table(spark, sf_dir, "region_proposals"))


def p1_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node with root, depth and path, or with the place where its chain of parents stops."""
    return hierarchy.hierarchy(table(spark, sf_dir, "region_proposals"))


def p1_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a node and one of its descendants, with their distance."""
    return hierarchy.descendant_pairs(table(spark, sf_dir, "region_proposals"))


def p1_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node in one row, its path as text and the number of its descendants; the pairs of p1_descendants in short."""
    h = p1_hierarchy(spark, sf_dir)
    return h.select("id", "root_id", "depth", F.array_join("path", "/").alias("path"), "stop_id", "n_below")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.found(table(spark, sf_dir, "candidate_manuals"), table(spark, sf_dir, "raw_records"))


def p4_candidate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = flatten.all_candidate_pages(table(spark, sf_dir, "candidate_manuals"), table(spark, sf_dir, "raw_records"))
    return pages.drop("raw_page_index").withColumn("tags", F.array_join("tags", " "))


def p4_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.all_evidence(table(spark, sf_dir, "candidate_manuals"), table(spark, sf_dir, "raw_records"))


def p4_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = flatten.json_regions(flatten.parsed(table(spark, sf_dir, "raw_records")))
    return regions.select(*(c for c in regions.columns if c not in ("box", "reference_box")), F.col("box")[0].alias("x"), F.col("box")[3].alias("height"))


def p4_manuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parents of candidate pages and evidence."""
    return flatten.all_manuals(table(spark, sf_dir, "candidate_manuals"), table(spark, sf_dir, "raw_records"))


def p4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parents of regions."""
    return flatten.json_pages(flatten.parsed(table(spark, sf_dir, "raw_records")))


QUERIES = {f.__name__: f for f in (p1_found, p1_hierarchy, p1_descendants, p1_intervals, p4_found, p4_candidate_pages, p4_evidence, p4_regions, p4_manuals, p4_pages)}

_CURRENT = r"""nodes AS (SELECT id, CASE WHEN trim(p) <> '' THEN p END AS parent FROM (SELECT id, p, row_number() OVER (PARTITION BY id ORDER BY revision DESC NULLS LAST, p DESC NULLS LAST) AS rn FROM (
 SELECT lower(regexp_replace(id, '^[\s\x0b\x{a0}\x{2000}-\x{200b}\x{3000}\x{feff}]+|[\s\x0b\x{a0}\x{2000}-\x{200b}\x{3000}\x{feff}]+$', '', 'g')) AS id,
 lower(regexp_replace(parent_id, '^[\s\x0b\x{a0}\x{2000}-\x{200b}\x{3000}\x{feff}]+|[\s\x0b\x{a0}\x{2000}-\x{200b}\x{3000}\x{feff}]+$', '', 'g')) AS p, revision FROM region_proposals) WHERE id <> '') WHERE rn = 1)""".replace("\\\\", "\\")
# Every node with all that its chain of parents meets; UNION ends the walk round a circle.
_WALK = f"""{_CURRENT}, walk AS (SELECT id, parent AS up FROM nodes WHERE parent IS NOT NULL UNION SELECT w.id, n.parent FROM walk w JOIN nodes n ON n.id = w.up WHERE n.parent IS NOT NULL),
 lost AS (SELECT w.id, w.up AS stop_id FROM walk w LEFT JOIN nodes n ON n.id = w.up WHERE n.id IS NULL),
 rooted AS (SELECT w.id FROM walk w JOIN nodes n ON n.id = w.up WHERE n.parent IS NULL UNION SELECT id FROM nodes WHERE parent IS NULL),
 ring AS (SELECT id FROM walk WHERE up = id), round_ AS (SELECT w.id, min(w.up) AS stop_id FROM walk w JOIN ring r ON r.id = w.up GROUP BY w.id)"""
# Steps up to the root, to a child of a missing parent, or to the first member of a circle.
_CHAIN = f"""{_WALK}, cut AS (SELECT n.id, CASE WHEN r.id IS NULL AND p.id IS NOT NULL THEN n.parent END AS up FROM nodes n LEFT JOIN ring r ON r.id = n.id LEFT JOIN nodes p ON p.id = n.parent),
 chain AS (SELECT id, id AS at, up, 0 AS steps, [id] AS path FROM cut UNION ALL SELECT c.id, k.id, k.up, c.steps + 1, list_prepend(k.id, c.path) FROM chain c JOIN cut k ON k.id = c.up),
 ends AS (SELECT * FROM chain WHERE up IS NULL)"""
_LIST = lambda v: f"CASE json_type({v}) WHEN 'ARRAY' THEN from_json({v}, '[\"JSON\"]') WHEN 'OBJECT' THEN [{v}] WHEN 'VARCHAR' THEN CASE WHEN NOT json_valid({v} ->> '$') THEN NULL WHEN json_type({v} ->> '$') = 'ARRAY' THEN from_json({v} ->> '$', '[\"JSON\"]') WHEN json_type({v} ->> '$') = 'OBJECT' THEN [({v} ->> '$')::JSON] END END"
_OPENED = lambda v: f"CASE WHEN json_type({v}) = 'VARCHAR' THEN CASE WHEN json_valid({v} ->> '$') THEN ({v} ->> '$')::JSON END ELSE {v} END"
_RAW = f"""r0 AS (SELECT record_id, record_type, CASE WHEN json_valid(payload) THEN payload::JSON END AS v FROM raw_records), r1 AS (SELECT record_id, record_type, {_OPENED("v")} AS v FROM r0),
 r2 AS (SELECT record_id, record_type, v, coalesce(v -> '$.inventory', v -> '$.project') AS w FROM r1), r3 AS (SELECT record_id, record_type, CASE WHEN w IS NULL OR json_type(w) = 'NULL' THEN v ELSE {_OPENED("w")} END AS v FROM r2),
 ml AS (SELECT record_id, {_LIST("(v -> '$.manuals')")} AS l FROM r3 WHERE record_type = 'inventory'), pl AS (SELECT record_id, {_LIST("(v -> '$.pages')")} AS l FROM r3 WHERE record_type = 'project'),
 mm AS (SELECT record_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS m FROM ml), pp AS (SELECT record_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS g FROM pl),
 tt AS (SELECT record_id, i, m, {_OPENED("(m -> '$.truth')")} AS t FROM mm),
 cp AS (SELECT record_id, i, m, generate_subscripts(l, 1) - 1 AS j, unnest(l) AS p FROM (SELECT *, {_LIST("(m -> '$.candidate_pages')")} AS l FROM mm)),
 ev AS (SELECT record_id, i, m, generate_subscripts(l, 1) - 1 AS j, unnest(l) AS e FROM (SELECT *, {_LIST("(t -> '$.evidence')")} AS l FROM tt)),
 rg AS (SELECT record_id, i, g, generate_subscripts(l, 1) - 1 AS j, unnest(l) AS r FROM (SELECT *, {_LIST("(g -> '$.regions')")} AS l FROM pp)),
 tp AS (SELECT record_id, manual_id, generate_subscripts(candidate_pages, 1) - 1 AS j, unnest(candidate_pages) AS p FROM candidate_manuals)"""
SQL: dict[str, str] = {
    "p1_found": f"WITH RECURSIVE {_WALK} SELECT id, stop_id FROM lost UNION ALL SELECT id, stop_id FROM round_",
    "p1_intervals": f"""WITH RECURSIVE {_CHAIN} SELECT e.id, CASE WHEN q.id IS NULL AND o.id IS NULL THEN e.at END AS root_id, e.steps AS depth, array_to_string(e.path, '/') AS path, coalesce(q.stop_id, o.stop_id) AS stop_id, count(c.id) - 1 AS n_below
 FROM ends e LEFT JOIN lost q ON q.id = e.id LEFT JOIN round_ o ON o.id = e.id LEFT JOIN chain c ON c.at = e.id GROUP BY ALL""",
    # Ways round a circle are counted up to 2 000 steps, which is more than any chain here has; the shortest one holds.
    "p1_descendants": f"""WITH RECURSIVE {_CURRENT}, w AS (SELECT id, parent AS up, 1 AS d FROM nodes WHERE parent IS NOT NULL UNION ALL SELECT w.id, n.parent, d + 1 FROM w JOIN nodes n ON n.id = w.up WHERE n.parent IS NOT NULL AND d < 2000)
 SELECT w.up AS ancestor_id, w.id AS descendant_id, min(d)::INT AS distance FROM w JOIN nodes a ON a.id = w.up WHERE w.up <> w.id GROUP BY 1, 2""",
    "p4_found": f"""WITH {_RAW} SELECT 'raw_records' AS table_name, record_id, 'candidate_page' AS entity, i::BIGINT AS parent_pos, j::BIGINT AS pos FROM cp WHERE p ->> '$.page_index' IS NOT NULL
 UNION ALL SELECT 'raw_records', record_id, 'evidence', i, j FROM ev WHERE e ->> '$.kind' IS NOT NULL UNION ALL SELECT 'raw_records', record_id, 'region', i, j FROM rg WHERE r ->> '$.reference_box' IS NOT NULL
 UNION ALL SELECT 'candidate_manuals', record_id, 'candidate_page', 0, j FROM tp WHERE p.page_index IS NOT NULL UNION ALL SELECT 'candidate_manuals', record_id, 'evidence', 0, 0 FROM candidate_manuals WHERE truth.evidence.kind IS NOT NULL""",
    "p4_evidence": f"""WITH {_RAW} SELECT 'raw_records' AS table_name, record_id, i::INT AS parent_pos, j::INT AS pos, m ->> '$.manual_id' AS manual_id, e ->> '$.kind' AS kind, e ->> '$.note' AS note FROM ev
 UNION ALL SELECT 'candidate_manuals', record_id, 0, 0, manual_id, truth.evidence.kind, NULL FROM candidate_manuals WHERE truth.evidence IS NOT NULL""",
    "p4_pages": f"WITH {_RAW} SELECT record_id, i::INT AS pos, g ->> '$.id' AS page_id, g ->> '$.reference_asset_id' AS reference_asset_id, len({_LIST(chr(40) + 'g -> ' + chr(39) + '$.regions' + chr(39) + chr(41))})::INT AS n_regions FROM pp",
    "p4_manuals": f"""WITH {_RAW} SELECT 'raw_records' AS table_name, record_id, i::INT AS pos, m ->> '$.manual_id' AS manual_id, m ->> '$.source_path' AS source_path, m ->> '$.source_sha256' AS source_sha256, (m ->> '$.source_byte_size')::BIGINT AS source_byte_size, (m ->> '$.page_count')::INT AS page_count,
 from_json(m -> '$.intended_page_classes', '["VARCHAR"]') AS intended_page_classes, t ->> '$.origin' AS origin, t ->> '$.status' AS status, {", ".join(f"t ->> '$.{c}' AS {c}" for c in flatten.GATES)} FROM tt
 UNION ALL SELECT 'candidate_manuals', record_id, 0, manual_id, source_path, source_sha256, source_byte_size, page_count, intended_page_classes, truth.origin, truth.status, {", ".join(f"truth.{c}" for c in flatten.GATES)} FROM candidate_manuals""",
    "p4_candidate_pages": f"""WITH {_RAW} SELECT 'raw_records' AS table_name, record_id, i::INT AS parent_pos, j::INT AS pos, m ->> '$.manual_id' AS manual_id, trunc(try_cast(p ->> '$.page_index' AS DOUBLE))::BIGINT AS page_index, p ->> '$.page_class' AS page_class, array_to_string(from_json(p -> '$.tags', '["VARCHAR"]'), ' ') AS tags FROM cp
 UNION ALL SELECT 'candidate_manuals', record_id, 0, j, manual_id, p.page_index, p.page_class, array_to_string(p.tags, ' ') FROM tp""",
    "p4_regions": f"""WITH {_RAW} SELECT record_id, i::INT AS parent_pos, j::INT AS pos, g ->> '$.id' AS page_id, r ->> '$.id' AS region_id, r ->> '$.kind' AS kind, r ->> '$.source_text' AS source_text, r ->> '$.ocr_text' AS ocr_text, r ->> '$.review.disposition' AS disposition,
 CASE WHEN json_type(r -> '$.reference_box') = 'OBJECT' THEN (r ->> '$.reference_box.x')::DOUBLE ELSE (r ->> '$.reference_box[0]')::DOUBLE END AS x, CASE WHEN json_type(r -> '$.reference_box') = 'OBJECT' THEN (r ->> '$.reference_box.height')::DOUBLE ELSE (r ->> '$.reference_box[3]')::DOUBLE END AS height FROM rg""",
}
