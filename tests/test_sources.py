from __future__ import annotations

import pytest

from folia.sources import formats, packages
from folia.streaming.revisions import LatestTable, event_windows, follow


def test_words(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t\n5\t1\t1\t1\t1\t2\t10\t0\t5\t9\t50\tworld\n5\t1\t1\t1\t1\t1\t0\t0\t5\t8\t-1\thello\n5\t1\t1\t1\t1\t3\t0\t0\t5\t8\t90\t \n")
    line = formats.words_to_lines(formats.read_tsv_words(spark, str(tmp_path / "a.tsv"))).collect()
    assert [(r.text, r.x0, r.x1, r.confidence) for r in line] == [("hello world", 0, 15, 0.5)]


def test_xml_round_trip(spark, tmp_path):
    doc = packages.alto_document("page-1", [("l1", [(1, 2, 5, 6, 'a "b" <c>', 0.5), (6, 2, 8, 6, "d", None)])])
    (tmp_path / "p.xml").write_text(doc)
    (tmp_path / "bad.xml").write_text("<alto")
    (tmp_path / "dtd.xml").write_text("<!DOCTYPE x>" + doc)
    got = formats.read_words(spark, str(tmp_path), "*.xml", "alto").orderBy("word_no").collect()
    assert [(r.page_id, r.line_id, r.x1, r.text, r.confidence) for r in got] == [("page-1", "l1", 5.0, 'a "b" <c>', 0.5), ("page-1", "l1", 8.0, "d", None)]
    page = b'<PcGts><Page imageFilename="i"><TextRegion id="r"><TextLine id="l"><Coords points="1,2 3,9"/><TextEquiv><Unicode>x</Unicode></TextEquiv></TextLine></TextRegion></Page></PcGts>'
    assert formats.page_words(page) == [("i", "r", "l", 0, 1.0, 2.0, 3.0, 9.0, "x", None)]
    assert formats.json_lines(b'{"res": {"rec_texts": ["t"], "dt_polys": [[[0, 1], [4, 1], [4, 3]]]}}')[0][4:9] == (0.0, 1.0, 4.0, 3.0, "t")
    assert formats.bbox_words(b'<doc><page><word xMin="1" yMin="2" xMax="3" yMax="4">w</word></page></doc>')[0][4:9] == (1.0, 2.0, 3.0, 4.0, "w")


def test_store_and_package(spark, tmp_path):
    rows = [(b"one", "text/plain", "a"), (b"one", "text/plain", "b"), (b"two", "text/plain", "a")]
    df = spark.createDataFrame(rows, "content binary, media_type string, role string")
    root = str(tmp_path / "store")
    packages.put_artifacts(df, root)
    packages.put_artifacts(df, root)
    assert [r.ok for r in packages.verify_artifacts(spark, root).collect()] == [True, True]
    assert packages.pack({"b": b"1", "a": b"2"}) == packages.pack({"a": b"2", "b": b"1"})
    entries = spark.createDataFrame([("p", "b", b"1"), ("p", "a", b"2"), ("q", "c", b"3")], "package_id string, name string, content binary")
    assert packages.write_packages(entries, str(tmp_path / "packs")).count() == 2
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    (tmp_path / "y.PDF").write_bytes(b"%PDF")
    f = formats.fingerprints(spark, str(tmp_path)).collect()
    assert [(r.aliases, r.byte_size, r.paths) for r in f] == [(2, 4, ["x.pdf", "y.PDF"])]
    data = packages.pack({"a": b"1", "b/c": b"2"})
    assert packages.save_package(str(tmp_path / "k.zip"), data) and not packages.save_package(str(tmp_path / "k.zip"), data)
    with pytest.raises(ValueError):
        packages.save_package(str(tmp_path / "k.zip"), packages.pack({"a": b"other"}))
    assert {(r.name, bytes(r.content)) for r in packages.read_packages(spark, str(tmp_path), "k.zip").collect()} == {("a", b"1"), ("b/c", b"2")}


def test_late_declarations_html_and_views(spark):
    assert formats.alto_words(b" " * 5000 + b"<!doctype x><alto><Page ID='p'/></alto>") == []
    assert formats.html_text("<p>a &amp; b&nbsp;c</p><ul><li>x<br>y</li></ul>") == "a & b\xa0c\nx\ny\n"
    blocks = b'{"blocks": [{"html": "<p>two</p>", "bbox": [0, 0, 1, 1], "reading_order": 2}, {"html": "<b>one</b>", "bbox": [0, 0, 1, 1], "reading_order": 1}]}'
    assert [r[8] for r in formats.json_lines(blocks)] == ["one", "two\n"]
    page = packages.page_document("i", [("r", [("l", 1, 2, 3, 4, "a < b")])])
    assert formats.page_words(page.encode()) == [("i", "r", "l", 0, 1.0, 2.0, 3.0, 4.0, "a < b", None)]
    b = spark.createDataFrame([("p", 2, "code", "x < y"), ("p", 1, "section", "T & U"), ("p", 3, "body", "z")], "source_path string, block_no int, kind string, text string")
    assert packages.html_view(b).first().html == "<h2>T &amp; U</h2>\n<pre>x &lt; y</pre>\n<p>z</p>"
    w = spark.createDataFrame([(10, 20, 5, 7)], "left int, top int, width int, height int")
    assert tuple(formats.in_micropoints(w, 300).first()) == (2_400_000, 4_800_000, 1_200_000, 1_680_000)


def test_streamed_revisions(spark, tmp_path):
    schema = "id string, revision int, v string"
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema).coalesce(1).write.parquet(src)
    target = LatestTable(spark, str(tmp_path / "out"), "id", ["revision", "v"])
    follow(spark.readStream.schema(schema).parquet(src), target, str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([("a", 2, "z"), ("b", 0, "w")], schema).coalesce(1).write.mode("append").parquet(src)
    follow(spark.readStream.schema(schema).parquet(src), target, str(tmp_path / "cp")).awaitTermination()
    assert {r.id: r.v for r in target.read(1, schema).collect()} == {"a": "z", "b": "y"}
    for epoch in range(2, 6):
        target.merge(spark.createDataFrame([("c", epoch, f"n{epoch}")], schema), epoch)
    target.merge(spark.createDataFrame([("c", 5, "n5")], schema), 5)  # run again
    assert {r.id: r.v for r in target.read(5, schema).collect()} == {"a": "z", "b": "y", "c": "n5"}
    assert max(map(len, target._held().values())) <= 2
    events = spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'k' as event_type, 2.0D as value")
    assert [(r.n, r.total) for r in event_windows(events).collect()] == [(1, 2.0)]
