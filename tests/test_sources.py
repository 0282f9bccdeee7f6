from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import random
import zipfile

import pytest
import zstandard
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakegate.errors import DecodeError, IntakeError
from lakegate.operators.digest import fingerprint_of
from lakegate.plans import QUERIES
from lakegate.sources import files, readers, sinks
from lakegate.sources.xlsx import read_workbooks, unique_headers


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_types_delimiter_and_header_only(spark, tmp_path):
    df = readers.read_csv(spark, put(tmp_path, "a.csv", "id;name\n1;x\n2;y\n"), delimiter=";")
    assert df.dtypes == [("id", "bigint"), ("name", "string")]
    assert rows(df) == [(1, "x"), (2, "y")]
    empty = readers.read_csv(spark, put(tmp_path, "b.csv", "id\n"))
    assert empty.columns == ["id"] and empty.count() == 0


@pytest.mark.parametrize("body", ["id,name\n1\n", "id,name\n1,x,y\n"])
def test_ragged_csv_fails(spark, tmp_path, body):
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, put(tmp_path, "bad.csv", body)).collect()


def test_json_arrays_lines_marks_and_strays(spark, tmp_path):
    array = readers.read_any(spark, put(tmp_path, "a.json", '﻿ [{"id":1,"n":"x"}, "stray", 3, {"id":2.5,"m":true}]'))
    assert sorted(array.columns) == ["id", "m", "n"]
    assert rows(array.select("id", "n")) == [(1.0, "x"), (2.5, None)]
    lines = readers.read_any(spark, put(tmp_path, "b.json", '{"id":1}\n{"id":2}\n'))
    assert rows(lines) == [(1,), (2,)]
    assert readers.read_any(spark, put(tmp_path, "c.json", " \n")).count() == 0
    assert readers.read_any(spark, put(tmp_path, "d.json", '["only", 1]')).count() == 0
    with pytest.raises(DecodeError):
        readers.read_any(spark, put(tmp_path, "e.json", "<html>"))
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_any(spark, put(tmp_path, "f.jsonl", '{"id":1}\n{"id"\n'), "jsonl").collect()


def test_array_and_lines_in_one_folder_are_unified(spark, tmp_path):
    put(tmp_path, "a.json", '[{"id":1}]')
    put(tmp_path, "b.json", '{"id":2,"x":"y"}')
    assert sorted(rows(readers.read_json(spark, str(tmp_path)).select("id", "x")), key=lambda r: r[0]) == [(1, None), (2, "y")]


def test_geojson(spark, tmp_path):
    collection = """{"type":"FeatureCollection","features":[
      {"type":"Feature","properties":{"id":1,"name":"a"},"geometry":{"type":"Point","coordinates":[1.0,2.50]}},
      {"type":"Feature","properties":{"id":2},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}},
      {"type":"Feature","properties":null,"geometry":{"type":"MultiPoint","coordinates":[[1,2]]}},
      {"type":"Feature","properties":{"id":4},"geometry":null}]}"""
    df = readers.read_any(spark, put(tmp_path, "a.geojson", collection))
    assert df.columns == ["id", "name", "geometry_wkt"]
    got = {r.id: r.geometry_wkt for r in df.collect()}
    assert got[1] == "POINT (1 2.5)" and got[2] == "POLYGON ((0 0, 1 0, 1 1))" and got[4] == ""
    assert got[None] == '{"type":"MultiPoint","coordinates":[[1,2]]}'
    single = readers.read_geojson(spark, put(tmp_path, "b.geojson", '{"type":"Feature","properties":{"label":"z"},"geometry":null}'))
    assert rows(single) == [("z", "")]
    with pytest.raises(PySparkException):
        readers.read_geojson(spark, put(tmp_path, "c.geojson", '{"type":"Topology"}')).collect()


def test_headers_are_made_unique():
    assert unique_headers(["col", "col", None, None, "col"]) == ["col", "col_2", "", "_2", "col_3"]
    assert unique_headers(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(sheets, active=0):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        names = "".join(f'<sheet name="s{i}" sheetId="{i + 1}" r:id="r{i}"/>' for i in range(len(sheets)))
        view = f'<bookViews><workbookView activeTab="{active}"/></bookViews>'
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}">{view}<sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets)))
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}"><si><t>id</t></si><si><t>when</t></si><si><t>ok</t></si></sst>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        for i, body in enumerate(sheets):
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
    return buffer.getvalue()


def test_xlsx_active_sheet_types_and_gaps(spark, tmp_path):
    header = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
    body = (
        '<row r="2"><c r="A2"><v>1</v></c><c r="B2" s="1"><v>45292</v></c><c r="C2" t="b"><v>1</v></c></row>'
        '<row r="4"><c r="A4"><v>2.5</v></c></row>'
    )
    put(tmp_path, "a.xlsx", workbook(["<row/>", header + body], active=1))
    put(tmp_path, "b.xlsx", workbook([header]))
    df = readers.read_xlsx(spark, str(tmp_path), origin=True)
    assert dict(df.dtypes) == {
        "path": "string", "row_no": "bigint", "id": "double", "when": "timestamp_ntz", "ok": "boolean"
    }
    assert df.columns == ["path", "row_no", "id", "when", "ok"]
    put(tmp_path, "c.xlsx", b"no workbook")
    with pytest.raises(DecodeError, match="c.xlsx"):
        readers.read_xlsx(spark, str(tmp_path))
    df, bad = read_workbooks(spark, str(tmp_path), origin=True)
    assert [r.path.rsplit("/", 1)[1] for r in bad.collect()] == ["c.xlsx"]
    got = {r.row_no: (r.id, str(r.when), r.ok) for r in df.collect()}
    assert got == {2: (1.0, "2024-01-01 00:00:00", True), 3: (None, "None", None), 4: (2.5, "None", None)}


BODY = b"id,name\n1,x\n2,y\n" * 5000


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def test_decompression_by_magic_bytes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    packed = {
        "gzip": gzip.compress(BODY[:100]) + gzip.compress(BODY[100:]),
        "bzip2": bz2.compress(BODY),
        "zstd": zstandard.ZstdCompressor().compress(BODY),
        "zip": zipped({"readme.txt": b"x", "data.csv": BODY, "dir/": b""}),
        "none": BODY,
    }
    for kind, content in packed.items():
        put(source, f"{kind}.bin", content)
    listed = files.list_files(spark, str(source))
    sniffed = {r.path.rsplit("/", 1)[1].split(".")[0]: r.compression for r in files.sniff_compression(listed).collect()}
    assert sniffed == {k: k for k in packed}
    status = files.decompress_files(listed, str(tmp_path / "out"), "csv").collect()
    assert [r.error for r in status] == [None] * 5
    for r in status:
        assert open(r.target, "rb").read() == BODY and r.size == len(BODY)


@pytest.mark.parametrize(
    "content",
    [
        gzip.compress(BODY)[:-20],
        bz2.compress(BODY)[:-20],
        zstandard.ZstdCompressor().compress(BODY)[:-5],
        zipped({"dir/": b""}),
        zipped({"a.csv": BODY})[:40],
    ],
)
def test_broken_archives_become_status_rows(spark, tmp_path, content):
    put(tmp_path, "broken.bin", content)
    out = tmp_path / "out"
    row = files.decompress_files(files.list_files(spark, str(tmp_path / "broken.bin")), str(out), "csv").first()
    assert row.error and row.target is None
    assert not list(out.glob("*")), "no partial file is left behind"


def test_encoding_hint(spark):
    df = spark.createDataFrame([(b"abcd", " X-GZIP "), (b"PK\x03\x04", None), (b"", "br")], "m binary, e string")
    assert [r[0] for r in df.select(files.compression_of("m", "e")).collect()] == ["gzip", "zip", "none"]


def test_copy_reports_failures_and_goes_on(spark, tmp_path):
    good = put(tmp_path, "good.bin", b"hello")
    listed = spark.createDataFrame([(f"file:{good}",), ("file:/does/not/exist",)], "path string")
    status = {r.path: r for r in files.copy_files(listed, str(tmp_path / "out")).collect()}
    assert status[f"file:{good}"].size == 5 and status[f"file:{good}"].error is None
    assert status["file:/does/not/exist"].error and status["file:/does/not/exist"].target is None


def test_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="CSV"):
        readers.read_any(spark, "x", "docx")
    assert readers.read_any(spark, put(tmp_path, "noformat", "a\n1\n")).columns == ["a"]


@pytest.mark.parametrize("split", ["4k", "256k", "128m"])
def test_finished_row_groups_are_not_read_again(spark, tmp_path, split):
    """A run stopped inside a file goes on there, whatever the split size of the next run."""
    path = str(tmp_path / "p")
    spark.range(200_000).repartition(2).write.option("parquet.block.size", 64 * 1024).parquet(path)
    groups = readers.row_groups(spark, path).orderBy("file_path", "row_group").collect()
    assert len(groups) > 6 and sum(g.n_rows for g in groups) == 200_000
    everything = readers.read_pending_row_groups(spark, path, spark.createDataFrame([], "file_path string, row_group int"))
    done = spark.createDataFrame([(g.file_path, g.row_group) for g in groups[::2]], "file_path string, row_group int")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        left = readers.read_pending_row_groups(spark, path, done)
        assert left.count() == sum(g.n_rows for g in groups[1::2])
        read = everything.join(done, ["file_path", "row_group"]).select("id").union(left.select("id"))
        assert read.distinct().count() == read.count() == 200_000
        assert readers.read_pending_row_groups(spark, path, everything).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_blanks_and_odd_keys(spark, tmp_path):
    array = readers.read_any(spark, put(tmp_path, "a.json", " " * 3_000_000 + '\n[{"VOID":1,"VARIANT":"x","k":null,"a, VOID>":2.5}]'))
    assert dict(array.dtypes) == {"VOID": "bigint", "VARIANT": "string", "k": "string", "a, VOID>": "double"}
    assert rows(array.select("VOID", "VARIANT", "k", "`a, VOID>`")) == [(1, "x", None, 2.5)]


@pytest.mark.parametrize("name", ["r.csv.gz", "plain", "x.csv"])
@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lambda b: zstandard.compress(b), lambda b: zipped({"r.csv": b})])
def test_compressed_input_is_decoded(spark, tmp_path, name, pack):
    assert rows(readers.read_any(spark, put(tmp_path, name, pack(b"id,v\n1,a\n2,b\n")))) == [(1, "a"), (2, "b")]


def test_unknown_extensions_and_broken_archives(spark, tmp_path):
    for name in ("r.pdf", "r.pdf.gz", "folder.docx"):
        with pytest.raises(ValueError, match="unknown format"):
            readers.read_any(spark, str(tmp_path / name))
    with pytest.raises(DecodeError, match="r.json.gz"):
        readers.read_any(spark, put(tmp_path, "r.json.gz", gzip.compress(b'{"a":1}' * 9000)[:-30]))


def test_folders_are_read_by_what_lies_in_them(spark, tmp_path):
    for name in ("json", "mixed", "bad", "none"):
        (tmp_path / name).mkdir()
    put(tmp_path / "json", "a.json", b'{"a":1}\n{"a":2}\n')
    put(tmp_path / "json", "b.json", b'{"a":3}')
    assert rows(readers.read_any(spark, str(tmp_path / "json"))) == [(1,), (2,), (3,)]
    put(tmp_path / "mixed", "one", b"a,b\n1,x\n")
    put(tmp_path / "mixed", "two", gzip.compress(b' [{"a":2,"c":true}]'))
    put(tmp_path / "mixed", "three.jsonl.bz2", bz2.compress(b'{"a":3}\n{"a":4}\n'))
    spark.range(5, 6).selectExpr("id AS a").coalesce(1).write.parquet(str(tmp_path / "written"))
    part = next((tmp_path / "written").glob("*.parquet"))
    put(tmp_path / "mixed", "four", part.read_bytes())
    mixed = readers.read_any(spark, str(tmp_path / "mixed"))
    assert {r.a: (r.b, r.c) for r in mixed.collect()} == {1: ("x", None), 2: (None, True), 3: (None, None), 4: (None, None), 5: (None, None)}
    listed = [str(tmp_path / "mixed" / "one"), str(tmp_path / "json" / "b.json"), str(part)]
    assert sorted(r.a for r in readers.read_any(spark, listed).collect()) == [1, 3, 5]
    put(tmp_path / "bad", "fine", b"a\n1\n")
    put(tmp_path / "bad", "picture", b"\x89PNG\0\0")
    with pytest.raises(ValueError, match="picture"):
        readers.read_any(spark, str(tmp_path / "bad"))
    with pytest.raises(DecodeError, match="no files"):
        readers.read_any(spark, str(tmp_path / "none"))


def test_one_target_for_two_sources(spark, tmp_path):
    paths = [put(tmp_path, n, n.encode()) for n in ("a", "b", "c")]
    listed = spark.createDataFrame([(f"file:{p}", "same" if p[-1] < "c" else "own") for p in paths], "path string, name string")
    status = {r.path[-1]: r for r in files.copy_files(listed, str(tmp_path / "out")).collect()}
    assert status["c"].error is None and all("2 sources share" in status[k].error for k in "ab")
    assert not (tmp_path / "out" / "same").exists()


def test_materialize_notices_damage(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    where = (str(tmp_path / "out"), "r1", "file:///x", str(tmp_path / "manifest"))
    first = sinks.materialize(df, *where)
    assert first.written and sinks.is_healthy(spark, first.uri, first.content_digest)
    assert not sinks.materialize(df.orderBy(F.desc("id")), *where, stored=first).written
    spark.range(5).write.mode("append").parquet(first.uri)
    assert not sinks.is_healthy(spark, first.uri, first.content_digest)
    again = sinks.materialize(df, *where, stored=first)
    assert again.written and again.content_digest == first.content_digest
    latest = sinks.latest_artifacts(spark, where[3]).collect()
    assert len(latest) == 1 and latest[0].uri == again.uri


def test_empty_frame_keeps_its_schema(spark, tmp_path):
    published = sinks.materialize(
        spark.range(10).where("id < 0"), str(tmp_path / "o"), "e", "file:///x", str(tmp_path / "m")
    )
    assert spark.read.parquet(published.uri).dtypes == [("id", "bigint")]


def test_fingerprint_separates_what_looks_alike(spark):
    frames = [
        spark.createDataFrame([("ab", "c")], "a string, b string"),
        spark.createDataFrame([("a", "bc")], "a string, b string"),
        spark.createDataFrame([(None, "c")], "a string, b string"),
        spark.createDataFrame([("", "c")], "a string, b string"),
        spark.createDataFrame([("N", "c")], "a string, b string"),
        spark.createDataFrame([("ab", "c"), ("ab", "c")], "a string, b string"),
    ]
    assert len({fingerprint_of(f)[1] for f in frames}) == len(frames)


def test_fingerprint_of_nested_values(spark):
    ddl = "s struct<a:string,b:int>, l array<string>, m map<string,int>"
    rows = [
        (None, ["a", "b"], {"x": 1}),
        ((None, None), ["a", "b"], {"x": 1}),
        (("", None), ["a", "b"], {"x": 1}),
        (None, ["ab"], {"x": 1}),
        (None, None, {"x": 1}),
        (None, [], {"x": 1}),
        (None, [None], {"x": 1}),
        (None, ["a", "b"], {"x": 2}),
        (None, ["a", "b"], None),
    ]
    digests = [fingerprint_of(spark.createDataFrame([r], ddl))[1] for r in rows]
    assert len(set(digests)) == len(rows)
    a, b = (spark.createDataFrame([(None, [], m)], ddl) for m in ({"x": 1, "y": 2}, {"y": 2, "x": 1}))
    assert fingerprint_of(a) == fingerprint_of(b)


def test_views_need_valid_names(spark):
    sinks.register_view(spark.range(3), "three_rows")
    assert spark.sql("SELECT count(*) FROM three_rows").first()[0] == 3
    with pytest.raises(IntakeError):
        sinks.register_view(spark.range(3), "1; drop")


def test_manifest_rejects(spark):
    docs = ['{"schema_version":1}', "x", '{"schema_version":true}']
    good, bad = sinks.decode_manifest(spark.createDataFrame([(d,) for d in docs], "document string"), "document")
    assert good.count() == 0 and {r.reject_reason for r in bad.collect()} == {"keys"}


def test_tables_are_replaced(spark, tmp_path):
    spark.sql(f"CREATE DATABASE loads LOCATION '{tmp_path}/loads'")
    try:
        assert sinks.load_replace({"_1a": spark.range(3)}, "loads") == ["loads._1a"]
        sinks.load_replace({"_1a": spark.range(2)}, "loads")
        assert spark.table("loads._1a").count() == 2
    finally:
        spark.sql("DROP DATABASE loads CASCADE")


def test_downloads_keep_safe_names(spark, tmp_path):
    from lakegate.functions import rules, urls

    source = put(tmp_path, "da:ta 1.csv", b"a\n1\n")
    listed = spark.createDataFrame([(f"file:{source}",)], "path string")
    status = files.copy_files(
        listed.withColumn("name", rules.safe_filename(urls.file_name("path"))), str(tmp_path / "out")
    ).first()
    assert status.target.endswith("/data 1.csv") and status.error is None


def test_unreadable_parquet_is_set_aside(spark, tmp_path):
    from datetime import time

    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": [1, 2]}), tmp_path / "good.parquet")
    pq.write_table(pa.table({"id": [3], "at": [time(1, 2)]}), tmp_path / "time.parquet")
    nanos = pa.table({"id": [4], "ts": pa.array([1], pa.timestamp("ns"))})
    pq.write_table(nanos, tmp_path / "nanos.parquet", version="2.6")
    put(tmp_path, "broken.parquet", b"PAR1 no footer")
    df, findings = readers.read_readable_parquet(spark, str(tmp_path))
    assert rows(df) == [(1,), (2,)]
    found = {r.path.rsplit("/", 1)[1]: (r.column_name, r.problem) for r in findings.collect()}
    assert found["time.parquet"] == ("at", "time of day") and found["nanos.parquet"] == ("ts", "nanosecond timestamp")
    assert found["broken.parquet"][0] is None and len(found) == 3


def test_state_is_swapped_once(spark, tmp_path):
    from pyspark.sql import types as T

    from lakegate.errors import StateConflictError
    from lakegate.sources.state import StateTable

    schema = T.StructType.fromDDL("key string, version string")
    table = StateTable(spark, str(tmp_path / "state"), schema)
    rows, number = table.read()
    assert (rows.count(), number) == (0, 0)
    one = spark.createDataFrame([("a", "1")], schema)
    assert table.swap(one, 0) == 1
    with pytest.raises(StateConflictError):
        table.swap(one, 0)
    for n in range(1, 6):
        assert table.swap(spark.createDataFrame([("a", str(n + 1))], schema), n) == n + 1
    rows, number = table.read()
    assert number == 6 and rows.collect()[0].version == "6"
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("snapshot")]) == 3


def test_row_groups_are_read_by_many_tasks_each_file_once_a_task(spark, tmp_path):
    path = f"{tmp_path}/p"
    spark.range(60_000).coalesce(1).write.option("parquet.block.size", 32 * 1024).parquet(path)
    assert readers.row_groups(spark, path).count() > 8
    rows = readers.read_pending_row_groups(spark, path, spark.createDataFrame([], "file_path string, row_group int"))
    placed = rows.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
        F.min("row_group").alias("first"), F.max("row_group").alias("last"), F.count_distinct("row_group").alias("groups")
    ).collect()
    assert len(placed) > 2 and all(r["last"] - r["first"] + 1 == r["groups"] for r in placed)
    assert rows.select("id").distinct().count() == rows.count() == 60_000


def test_two_sync_runs_at_once(spark, tmp_path):
    """The run that swaps later raises; its resources are due again, and what the other published stays."""
    from pyspark.sql import types as T

    from lakegate.errors import StateConflictError
    from lakegate.sources import runs
    from lakegate.sources.state import StateTable

    base = str(tmp_path)
    df = spark.range(100).selectExpr("id % 5 AS r", "id")
    where = ("r", f"{base}/out", f"{base}/manifest")
    mine, other = (StateTable(spark, f"{base}/state", T.StructType.fromDDL(runs.STATE_SCHEMA)) for _ in "ab")

    class Late(StateTable):
        def read(self):
            found = super().read()
            runs.sync_run(df, *where, other, "file:///x")  # gets ahead between this run's read and its swap
            return found

    late = Late(spark, mine.folder, mine.schema)
    with pytest.raises(StateConflictError):
        runs.sync_run(df.withColumn("id", F.col("id") + 1), *where, late, "file:///x")
    again = runs.sync_run(df.withColumn("id", F.col("id") + 1), *where, mine, "file:///x")
    assert {r.action for r in again.collect()} == {"written"} and mine.read()[1] == 2
    assert {r.action for r in runs.sync_run(df.withColumn("id", F.col("id") + 1), *where, mine, "file:///x").collect()} == {"unchanged"}


def small_pieces(monkeypatch, piece=1000, stride=2, chunk=300):
    for name, value in (("PIECE", piece), ("STRIDE", stride), ("CHUNK", chunk)):
        monkeypatch.setattr(files, name, value, raising=False)


def digest_files(folder):
    """Sizes around every bound of 1 000 bytes a piece and two pieces a task."""
    folder.mkdir()
    rng = random.Random(4)
    return {
        f"file:{put(folder, f'{size}.bin', content)}": content
        for size in (1, 999, 1000, 1001, 1999, 2000, 2001, 3000, 4000, 4001, 6000, 9137)
        for content in [rng.randbytes(size)]
    }


@pytest.mark.parametrize("resumable", [True, False])
@pytest.mark.parametrize("sized", [True, False])
def test_digests_taken_in_waves_are_those_of_the_whole_file(spark, tmp_path, monkeypatch, sized, resumable):
    small_pieces(monkeypatch)
    if not resumable:
        def refused(*states):
            raise AttributeError("no such function")

        monkeypatch.setattr(files, "_resumable_digests", refused)
    contents = digest_files(tmp_path / "in")
    listed = files.list_files(spark, str(tmp_path / "in"))
    listed = listed if sized else listed.select("path")
    got = {r.path: r for r in files.file_digests(listed, pieces=True).collect()}
    assert got.keys() == contents.keys()
    for path, content in contents.items():
        parts = [(i, content[i : i + 1000]) for i in range(0, len(content), 1000)]
        want = [f"{i}:{len(p)}:{hashlib.sha256(p).hexdigest()}:{hashlib.md5(p).hexdigest()}" for i, p in parts]
        row = got[path]
        assert (row.size, row.sha256, row.md5, row.pieces, row.error) == (
            len(content), hashlib.sha256(content).hexdigest(), hashlib.md5(content).hexdigest(), want, None
        )
    plain = files.file_digests(listed)
    assert plain.columns == ["path", "size", "sha256", "md5", "error"]
    assert {r.path: r.sha256 for r in plain.collect()} == {path: r.sha256 for path, r in got.items()}


def test_a_task_reads_a_bounded_part_of_a_file(spark, tmp_path, monkeypatch):
    small_pieces(monkeypatch)
    contents, log, opened = digest_files(tmp_path / "in"), tmp_path / "log", files.opened
    log.mkdir()

    def counted(path):
        class Stream:
            def __init__(self, source):
                self.source = source

            def __enter__(self):
                return self

            def __exit__(self, *problem):
                self.source.close()

            def seek(self, place):
                self.source.seek(place)

            def read(self, length):
                content = self.source.read(length)
                with open(f"{log}/{TaskContext.get().taskAttemptId()}", "a") as sink:
                    sink.write(f"{path} {len(content)}\n")
                return content

        class Files:
            def open_input_stream(self, inner, compression=None):
                return Stream(opened(path)[0].open_input_stream(inner, compression=compression))

            def open_input_file(self, inner):
                return Stream(opened(path)[0].open_input_file(inner))

        return Files(), opened(path)[1]

    monkeypatch.setattr(files, "opened", counted)
    listed = files.list_files(spark, str(tmp_path / "in"))
    assert files.file_digests(listed).select("error").distinct().collect() == [(None,)]
    read = {}
    for task in log.iterdir():
        for line in task.read_text().splitlines():
            path, length = line.split()
            read.setdefault(path, {}).setdefault(task.name, []).append(int(length))
    for path, content in contents.items():
        tasks = [sum(lengths) for lengths in read[path].values()]
        assert max(tasks) <= 2000 and sum(tasks) == len(content)
    in_waves = [task for path, content in contents.items() if len(content) > 2000 for task in read[path]]
    assert len(in_waves) == len(set(in_waves))  # none reads of two such files
    cut = files.file_pieces(listed).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in cut}) == len(cut) == sum(-(-len(content) // 1000) for content in contents.values())
    assert all(r.content == contents[r.path][r.start : r.start + 1000] for r in cut)


def test_digests_of_repeated_lost_and_unsized_files(spark, tmp_path, monkeypatch):
    small_pieces(monkeypatch)
    path = f"file:{put(tmp_path, 'a.bin', b'x' * 5000)}"
    listed = spark.createDataFrame([(path, 5000), (path, 5000), ("file:/none", 5000), ("file:/none", None)], "path string, size bigint")
    got = files.file_digests(listed).collect()
    assert [r.sha256 for r in got if r.path == path] == [hashlib.sha256(b"x" * 5000).hexdigest()] * 2
    lost = [r for r in got if r.path != path]
    assert len(lost) == 2 and all(r.error and r.sha256 is None for r in lost)
    assert [r.size for r in files.file_digests(listed.select("path").distinct()).collect() if r.path == path] == [5000]
    nothing = spark.createDataFrame([(f"file:{put(tmp_path, 'empty.bin', b'')}",)], "path string")
    [row] = files.file_digests(nothing, pieces=True).collect()
    assert (row.size, row.pieces) == (0, [f"0:0:{hashlib.sha256().hexdigest()}:{hashlib.md5().hexdigest()}"])


def test_a_file_too_large_for_a_cell_is_compared_by_pieces(spark, tmp_path, monkeypatch):
    small_pieces(monkeypatch, piece=4000)
    spark.range(5000).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(f"{tmp_path}/in/orders.parquet")
    monkeypatch.setattr("lakegate.plans.publication.table", lambda spark, folder, name: spark.read.parquet(f"{folder}/{name}.parquet"))
    assert max(p.stat().st_size for p in (tmp_path / "in").rglob("*.parquet") if p.is_file()) > 8000
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "4000")
    try:
        assert QUERIES["file_digests"](spark, f"{tmp_path}/in").collect() == [(5000, True, True)]
        digests = files.file_digests

        def wrong(listed, pieces=False):
            got = digests(listed, pieces)
            if not pieces:
                return got
            return got.withColumn("pieces", F.transform("pieces", lambda p: F.regexp_replace(p, "^4000:4000:.", "4000:4000:x")))

        monkeypatch.setattr(files, "file_digests", wrong)
        assert QUERIES["file_digests"](spark, f"{tmp_path}/in").collect() == [(5000, False, True)]
    finally:
        spark.conf.unset(limit)
