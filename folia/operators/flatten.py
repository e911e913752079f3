"""Deeply nested records to flat tables that keep parent-child links.

Typed and JSON records go through one higher-order projection: nested ``transform`` calls attach the
keys and places of all ancestors to every object, ``flatten`` makes one array of them, and a single
``inline`` per target table emits the rows. No row leaves its task, so nothing is shuffled.

Untyped payloads are read as VARIANT. A list may be given as a list, as one lone object, or as a string
that holds either as JSON; the whole record may be such a string too, or lie under the name of its type.

Defined results: an unreadable, null or empty payload gives no rows; null entries of a list keep
their place, as rows without fields; a field that is absent or null gives no row in the ``found`` form; repeated
records give their rows under each record id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _decoded(v: str) -> str:
    """A variant whose JSON strings are parsed; objects and lists pass through."""
    return f"case when schema_of_variant({v}) = 'STRING' then try_parse_json(try_variant_get({v}, '$', 'string')) else {v} end"


def _listed(v: str) -> str:
    """Any spelling of a list as array<variant>; null where there is none."""
    return (
        f"transform(array({_decoded(v)}), d -> case when d is null or is_variant_null(d) then null "
        f"when schema_of_variant(d) like 'ARRAY%' then try_variant_get(d, '$', 'array<variant>') "
        f"when schema_of_variant(d) like 'OBJECT%' then array(d) end)[0]"
    )


def _field(v: str, name: str) -> str:
    return f"try_variant_get({v}, '$.{name}', 'variant')"


def _with_body(df: DataFrame, payload_col: str) -> DataFrame:
    out = df.withColumn("_v", F.expr(f"try_parse_json({payload_col})"))
    out = out.withColumn("_v", F.expr(_decoded("_v")))
    inner = "coalesce(try_variant_get(_v, '$.inventory', 'variant'), try_variant_get(_v, '$.project', 'variant'))"
    out = out.withColumn("_w", F.expr(inner))
    return out.withColumn("_v", F.expr(f"case when _w is null or is_variant_null(_w) then _v else {_decoded('_w')} end")).drop("_w")


def parsed(raw: DataFrame, *, payload_col: str = "payload") -> DataFrame:
    """(record_id, manuals, pages) as arrays of variants, each payload parsed once: those of an inventory and of a project.

    Null manuals and pages keep their place; the list that is not of the record's type is null.
    """
    body = _with_body(raw.select("record_id", "record_type", payload_col), payload_col)
    of = lambda kind, name: F.expr(f"case when record_type = '{kind}' then {_listed(_field('_v', name))} end").alias(name)
    return body.select("record_id", of("inventory", "manuals"), of("project", "pages"))


def _get(v: str, name: str, kind: str = "string") -> str:
    return f"try_variant_get({v}, '$.{name}', '{kind}')"


_PAGES, _REGIONS = _listed(_get("m", "candidate_pages", "variant")), _listed(_get("g", "regions", "variant"))
_TRUTH = _decoded(_field("m", "truth"))
_EVIDENCE = _listed(f"try_variant_get({_TRUTH}, '$.evidence', 'variant')")
GATES = ("mapping_gate", "layout_gate", "reading_order_gate", "semantics_gate", "object_extraction_gate")


def _each(outer: str, o: str, inner: str, i: str, struct: str) -> str:
    """An array of one struct for each object of the lists that the objects of ``outer`` hold."""
    return f"flatten(transform({outer}, ({o}, i) -> coalesce(transform({inner}, ({i}, j) -> struct(i as parent_pos, j as pos, {struct})), array())))"


def _emit(df: DataFrame, nested: str) -> DataFrame:
    """Rows of one target table from an array of structs built in one projection."""
    return df.selectExpr("record_id", f"inline({nested})")


def json_manuals(records: DataFrame) -> DataFrame:
    """Manuals of :func:`parsed` records: record_id, pos, their own fields, and the fields of their truth."""
    own = ", ".join(f"{_get('m', c)} as {c}" for c in ("manual_id", "source_path", "source_sha256"))
    sizes = f"{_get('m', 'source_byte_size', 'bigint')} as source_byte_size, {_get('m', 'page_count', 'int')} as page_count, {_get('m', 'intended_page_classes', 'array<string>')} as intended_page_classes"
    truth = ", ".join(f"try_variant_get({_TRUTH}, '$.{c}', 'string') as {c}" for c in ("origin", "status", *GATES))
    return _emit(records, f"transform(manuals, (m, i) -> struct(i as pos, {own}, {sizes}, {truth}))")


def json_candidate_pages(records: DataFrame) -> DataFrame:
    """Candidate pages of :func:`parsed` records: record_id, parent_pos, pos, manual_id, page_index, raw_page_index, page_class, tags."""
    index = _get("p", "page_index")
    fields = f"{_get('m', 'manual_id')} as manual_id, cast(try_cast({index} as double) as bigint) as page_index, {index} as raw_page_index, {_get('p', 'page_class')} as page_class, {_get('p', 'tags', 'array<string>')} as tags"
    return _emit(records, _each("manuals", "m", _PAGES, "p", fields))


def json_evidence(records: DataFrame) -> DataFrame:
    """Evidence of :func:`parsed` records: record_id, parent_pos, pos, manual_id, kind, note."""
    return _emit(records, _each("manuals", "m", _EVIDENCE, "e", f"{_get('m', 'manual_id')} as manual_id, {_get('e', 'kind')} as kind, {_get('e', 'note')} as note"))


def json_pages(records: DataFrame) -> DataFrame:
    """Pages of :func:`parsed` projects: record_id, pos, page_id, reference_asset_id, n_regions (null without a list)."""
    return _emit(records, f"transform(pages, (g, i) -> struct(i as pos, {_get('g', 'id')} as page_id, {_get('g', 'reference_asset_id')} as reference_asset_id, size({_REGIONS}) as n_regions))").withColumn("n_regions", F.expr("case when n_regions >= 0 then n_regions end"))


def _box(v: str) -> str:
    """A box as [x, y, width, height], given as a list (of numbers or of their spellings) or by names."""
    named = ", ".join(f"try_variant_get({v}, '$.{k}', 'double')" for k in ("x", "y", "width", "height"))
    return f"case when {v} is null or is_variant_null({v}) then null when schema_of_variant({v}) like 'OBJECT%' then array({named}) else transform(try_variant_get({v}, '$', 'array<string>'), z -> try_cast(z as double)) end"


def json_regions(records: DataFrame) -> DataFrame:
    """Regions of :func:`parsed` projects: record_id, parent_pos, pos, page_id, region_id, kind, reference_box (JSON), box, source_text, ocr_text, disposition."""
    box = "try_variant_get(r, '$.reference_box', 'variant')"
    fields = f"{_get('g', 'id')} as page_id, {_get('r', 'id')} as region_id, {_get('r', 'kind')} as kind, {_get('r', 'reference_box')} as reference_box, {_box(box)} as box, {_get('r', 'source_text')} as source_text, {_get('r', 'ocr_text')} as ocr_text, {_get('r', 'review.disposition')} as disposition"
    return _emit(records, _each("pages", "g", _REGIONS, "r", fields))


def typed_manuals(manuals: DataFrame) -> DataFrame:
    """Typed submissions: one manual each, at place 0."""
    return manuals.selectExpr("record_id", "0 as pos", "manual_id", "source_path", "source_sha256", "source_byte_size", "page_count", "intended_page_classes", *(f"truth.{c} as {c}" for c in ("origin", "status", *GATES)))


def typed_candidate_pages(manuals: DataFrame) -> DataFrame:
    """Candidate pages of typed submissions; the manual's place is 0."""
    return manuals.selectExpr(
        "record_id",
        "inline(transform(candidate_pages, (p, j) -> struct(0 as parent_pos, j as pos, manual_id as manual_id, p.page_index as page_index, p.page_class as page_class, p.tags as tags)))",
    )


def typed_evidence(manuals: DataFrame) -> DataFrame:
    """Evidence of typed submissions; its place is 0."""
    return manuals.selectExpr("record_id", "inline(array(struct(0 as parent_pos, 0 as pos, manual_id as manual_id, truth.evidence.kind as kind)))")


def all_manuals(manuals: DataFrame, raw: DataFrame) -> DataFrame:
    """Manuals of both tables under table_name; the parents of candidate pages and evidence by (table_name, record_id, pos)."""
    return _named(typed_manuals(manuals), "candidate_manuals").unionByName(_named(json_manuals(parsed(raw)), "raw_records"))


def all_candidate_pages(manuals: DataFrame, raw: DataFrame) -> DataFrame:
    """Candidate pages of both tables: table_name, record_id, parent_pos, pos, manual_id, page_index, page_class, tags, raw_page_index."""
    typed = typed_candidate_pages(manuals).withColumns({"page_index": F.col("page_index").cast("bigint"), "raw_page_index": F.col("page_index").cast("string")})
    return _named(typed, "candidate_manuals").unionByName(_named(json_candidate_pages(parsed(raw)), "raw_records"))


def all_evidence(manuals: DataFrame, raw: DataFrame) -> DataFrame:
    """Evidence of both tables: table_name, record_id, parent_pos, pos, manual_id, kind, note (null in typed submissions)."""
    typed = typed_evidence(manuals.where("truth.evidence is not null")).withColumn("note", F.lit(None).cast("string"))
    return _named(typed, "candidate_manuals").unionByName(_named(json_evidence(parsed(raw)), "raw_records"))


def _named(rows: DataFrame, table: str) -> DataFrame:
    """Rows with the name of their table before them."""
    return rows.select(F.lit(table).alias("table_name"), *rows.columns)


def found(manuals: DataFrame, raw: DataFrame) -> DataFrame:
    """One row per nested object with a non-null value in its field, over both tables.

    Every table is read once and every payload parsed once: one projection makes the arrays of all entities.
    """
    has = lambda entity, value: f"'{entity}' as entity, {value} is not null as there"
    lists = [
        _each("manuals", "m", _PAGES, "p", has("candidate_page", _get("p", "page_index"))),
        _each("manuals", "m", _EVIDENCE, "e", has("evidence", _get("e", "kind"))),
        _each("pages", "g", _REGIONS, "r", has("region", _get("r", "reference_box"))),
    ]
    none = "cast(array() as array<struct<parent_pos: int, pos: int, entity: string, there: boolean>>)"
    untyped = _emit(parsed(raw), "concat(" + ", ".join(f"coalesce({x}, {none})" for x in lists) + ")")
    typed = manuals.selectExpr(
        "record_id",
        f"""inline(concat(coalesce(transform(candidate_pages, (p, j) -> struct(0 as parent_pos, j as pos, {has("candidate_page", "p.page_index")})), {none}),
            array(struct(0 as parent_pos, 0 as pos, {has("evidence", "truth.evidence.kind")}))))""",
    )
    out = _named(typed, "candidate_manuals").unionByName(_named(untyped, "raw_records")).where("there")
    return out.select("table_name", F.col("record_id").cast("bigint").alias("record_id"), "entity", F.col("parent_pos").cast("bigint").alias("parent_pos"), F.col("pos").cast("bigint").alias("pos"))
