from __future__ import annotations

import json

from folia.operators import flatten

MANUALS = "record_id long, manual_id string, candidate_pages array<struct<page_index:int,page_class:string,tags:array<string>>>, truth struct<evidence:struct<kind:string>>, parent_pos int"


def rows(spark, raw, manuals=()):
    r = spark.createDataFrame(raw, "record_id long, record_type string, payload string, manuals string")
    m = spark.createDataFrame(list(manuals), MANUALS)
    return sorted(tuple(x) for x in flatten.found(m, r).collect())


def test_dirty_payloads(spark):
    inventory = {"manuals": [None, {"manual_id": "m", "candidate_pages": [{"page_index": 1}, None, {"page_index": None}, {"page_index": "7"}], "truth": {"evidence": [{"kind": "a"}, {}, {"kind": "b"}]}}]}
    lone = {"inventory": {"manuals": {"candidate_pages": {"page_index": 0}, "truth": {"evidence": {"kind": "k"}}}}}
    text = {"manuals": [{"candidate_pages": json.dumps([{"page_index": 3}]), "truth": None}]}
    project = {"project": {"pages": [{"regions": None}, {"regions": [{"reference_box": [0, 0, 1, 1]}, {"reference_box": None}, {"reference_box": {"x": 1}}]}]}}
    got = rows(
        spark,
        [(1, "inventory", json.dumps(inventory), "x"), (2, "inventory", json.dumps(lone), None), (3, "inventory", json.dumps(json.dumps(text)), None), (4, "project", json.dumps(project), None), (5, "project", "{broken", None), (6, "inventory", None, None), (7, "project", "", None), (8, "project", json.dumps(project), None)],
        [(9, "m", [None, (4, "c", None), (None, "c", None)], (("e",),), 5), (10, None, None, None, None), (11, "m", [], ((None,),), None)],
    )
    assert got == sorted(
        [("raw_records", 1, "candidate_page", 1, 0), ("raw_records", 1, "candidate_page", 1, 3), ("raw_records", 1, "evidence", 1, 0), ("raw_records", 1, "evidence", 1, 2), ("raw_records", 2, "candidate_page", 0, 0), ("raw_records", 2, "evidence", 0, 0), ("raw_records", 3, "candidate_page", 0, 0)]
        + [("raw_records", k, "region", 1, p) for k in (4, 8) for p in (0, 2)]
        + [("candidate_manuals", 9, "candidate_page", 0, 1), ("candidate_manuals", 9, "evidence", 0, 0)]
    )


def test_empty(spark):
    assert rows(spark, []) == []


def test_flat_tables_hold_both_sources(spark):
    record = {"manuals": [None, {"manual_id": "j", "candidate_pages": [{"page_index": 5, "page_class": "c", "tags": ["t"]}], "truth": {"evidence": [{"kind": "a", "note": "n"}, {"kind": None}]}}]}
    raw = spark.createDataFrame([(1, "inventory", json.dumps(record)), (2, "inventory", "{broken")], "record_id long, record_type string, payload string")
    manuals = spark.createDataFrame([(9, "m", [None, (4, "c", ["x", None]), (None, "d", None)], (("e",),), 5), (10, None, None, None, None), (11, "m", [], ((None,),), None), (12, "m", None, (None,), None)], MANUALS)
    pages = flatten.all_candidate_pages(manuals, raw)
    assert sorted(((r.table_name, r.record_id, r.parent_pos, r.pos, r.manual_id, r.page_index, r.page_class, r.tags) for r in pages.collect()), key=str) == [
        ("candidate_manuals", 9, 0, 0, "m", None, None, None), ("candidate_manuals", 9, 0, 1, "m", 4, "c", ["x", None]), ("candidate_manuals", 9, 0, 2, "m", None, "d", None), ("raw_records", 1, 1, 0, "j", 5, "c", ["t"]),
    ]
    found = flatten.all_evidence(manuals, raw)
    assert sorted(((r.table_name, r.record_id, r.parent_pos, r.pos, r.manual_id, r.kind, r.note) for r in found.collect()), key=str) == [
        ("candidate_manuals", 11, 0, 0, "m", None, None), ("candidate_manuals", 9, 0, 0, "m", "e", None), ("raw_records", 1, 1, 0, "j", "a", "n"), ("raw_records", 1, 1, 1, "j", None, None),
    ]
    assert flatten.all_evidence(manuals.where("false"), raw.where("false")).count() == 0
