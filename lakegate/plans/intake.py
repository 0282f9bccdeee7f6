"""Readers, transforms, union and profile."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import reduce
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.operators.profile import SCAN_ROWS, column_profile
from lakegate.operators.transforms import (
    CastSchema,
    Filter,
    Flatten,
    NormalizeTimestamps,
    RenameColumns,
    SelectColumns,
    advisory_schema,
    cast_rejects,
    compose,
    json_lines,
    preview,
)
from lakegate.operators.unify import concat_shards, unify
from lakegate.plans.registry import query, table
from lakegate.session import materialised, scratch_path
from lakegate.sources import files, readers, xlsx


@query(
    "t_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
       WHERE l_quantity > 25 AND nullif(l_returnflag, 'N') = 'R'""",
)
def t_filter(spark: SparkSession, folder: str) -> DataFrame:
    keep = (F.col("l_quantity") > 25) & (F.nullif(F.col("l_returnflag"), F.lit("N")) == "R")
    return compose([Filter(keep), SelectColumns(["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])])(
        table(spark, folder, "lineitem")
    )


@query("t_select", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def t_select(spark: SparkSession, folder: str) -> DataFrame:
    return SelectColumns(["c_mktsegment", "c_custkey", "c_name"])(table(spark, folder, "customer"))


@query(
    "t_rename",
    """SELECT c_custkey AS customer_id, c_name AS "customer.name", c_nationkey, c_acctbal, c_mktsegment AS segment
       FROM customer""",
)
def t_rename(spark: SparkSession, folder: str) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_name": "customer.name", "c_mktsegment": "segment"}
    return RenameColumns(names)(table(spark, folder, "customer"))


@query(
    "t_cast",
    """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
              CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM lineitem""",
)
def t_cast(spark: SparkSession, folder: str) -> DataFrame:
    target = T.StructType(
        [
            T.StructField("l_orderkey", T.IntegerType()),
            T.StructField("l_linenumber", T.StringType()),
            T.StructField("l_quantity", T.LongType()),
            T.StructField("l_suppkey", T.DoubleType()),
        ]
    )
    return compose([SelectColumns(target.names), CastSchema(target)])(table(spark, folder, "lineitem"))


@query(
    "t_normalize_ts",
    """SELECT event_id, epoch_us(ts - INTERVAL '5 hours 30 minutes') AS epoch_micros FROM events""",
)
def t_normalize_ts(spark: SparkSession, folder: str) -> DataFrame:
    steps = compose([SelectColumns(["event_id", "ts"]), NormalizeTimestamps(assume_naive_tz="Asia/Kolkata")])
    return steps(table(spark, folder, "events")).select("event_id", F.unix_micros("ts").alias("epoch_micros"))


@query(
    "t_cast_nested",
    """SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS first, CAST(l_linenumber AS VARCHAR) AS second, l_suppkey AS inner, CAST(l_partkey AS INTEGER) AS entry FROM lineitem""",
)
def t_cast_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Lists, structs and maps, cast inside."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.array("l_quantity", F.lit(None).cast("double")).alias("list"),
        F.struct(F.col("l_linenumber").alias("n"), F.struct(F.col("l_suppkey").cast("string").alias("k")).alias("in")).alias("box"),
        F.create_map(F.lit("part"), F.col("l_partkey")).alias("map"),
    )
    target = T.StructType.fromDDL("l_orderkey bigint, list array<bigint>, box struct<n:string,in:struct<k:bigint>>, map map<string,int>")
    return CastSchema(target)(lines).select(
        "l_orderkey",
        F.get("list", F.lit(0)).alias("first"),
        F.col("box.n").alias("second"),
        F.col("box.in.k").alias("inner"),
        F.col("map")["part"].alias("entry"),
    )


_LOSSY = {  # column: (target type, reason, every so manieth row is bad, bad text, good text)
    "to_date": ("date", "loss", 3, "2024-01-0{d} 10:30:00", "2024-01-0{d}"),
    "to_wall": ("timestamp_ntz", "loss", 4, "2024-01-0{d} 10:30:00+05:00", "2024-01-0{d} 10:30:00"),
    "to_micros": ("timestamp", "loss", 5, "2024-01-0{d} 10:30:00.123456789Z", "2024-01-0{d} 10:30:00.123456Z"),
    "to_decimal": ("decimal(5,2)", "loss", 6, "{d}.239", "{d}.2300"),
    "to_double": ("double", "loss", 7, "1234567890123456789{d}", "{d}.125e3"),
    "to_finite": ("double", "loss", 8, "{d}e400", "{d}e300"),
}


@query(
    "t_cast_lossy",
    "WITH d AS (SELECT o_orderkey, o_orderkey % 8 + 1 AS d FROM orders) "
    + " UNION ALL ".join(
        f"SELECT o_orderkey, '{name}' AS column_name, '{kind}' AS target, '{reason}' AS reason, replace('{bad}', '{{d}}', CAST(d AS VARCHAR)) AS value"
        f" FROM d WHERE o_orderkey % {every} = 0"
        for name, (kind, reason, every, bad, _) in _LOSSY.items()
    )
    + """ UNION ALL SELECT o_orderkey, 'to_text', 'string', 'no UTF-8', 'FF' || hex(CAST(d AS VARCHAR)) FROM d WHERE o_orderkey % 9 = 0
          UNION ALL SELECT o_orderkey, 'to_instant', 'timestamp', 'no such instant', CAST(9223372036854775807 - d AS VARCHAR) FROM d WHERE o_orderkey % 10 = 0
          UNION ALL SELECT NULL, 'kept', 'rows', 'nothing lost', CAST(count(*) AS VARCHAR) FROM d WHERE NOT (o_orderkey % 3 = 0 OR o_orderkey % 4 = 0
            OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0)""",
)
def t_cast_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """Eight kinds of cells that no cast may take; the rows without any go through the cast itself."""
    key = F.col("o_orderkey")
    digit = (key % 8 + 1).cast("string")

    def text(template: str):
        return F.replace(F.lit(template), F.lit("{d}"), digit)

    cells = {name: F.when(key % every == 0, text(bad)).otherwise(text(good)) for name, (_, _, every, bad, good) in _LOSSY.items()}
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        *[c.alias(n) for n, c in cells.items()],
        F.when(key % 9 == 0, F.concat(F.unhex(F.lit("FF")), digit.cast("binary"))).otherwise(F.encode(digit, "UTF-8")).alias("to_text"),
        F.when(key % 10 == 0, F.lit(2**63 - 1) - (key % 8 + 1)).otherwise(key).alias("to_instant"),
    )
    kinds = {name: kind for name, (kind, *_) in _LOSSY.items()} | {"to_text": "string", "to_instant": "timestamp"}
    target = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    rejects = cast_rejects(rows, target, ["o_orderkey"])
    clean = rows.join(rejects.select("o_orderkey").distinct(), "o_orderkey", "left_anti").drop("o_orderkey")
    kept = CastSchema(target)(clean).agg(F.count_if(F.forall(F.array(*[F.col(c).isNotNull() for c in kinds]), lambda x: x)).alias("n"))
    label = [F.lit(v).alias(n) for n, v in (("column_name", "kept"), ("target", "rows"), ("reason", "nothing lost"))]
    return rejects.union(kept.select(F.lit(None).cast("bigint").alias("o_orderkey"), *label, F.col("n").cast("string").alias("value")))


@query(
    "advisory_schema",
    """SELECT c_custkey, CAST(c_acctbal AS VARCHAR) || '|' || CAST(c_nationkey AS VARCHAR) || '|' || c_name || '|' || c_mktsegment AS shown,
              'c_custkey bigint, c_acctbal double, c_nationkey bigint, c_name string, c_mktsegment string' AS described FROM customer""",
)
def advisory(spark: SparkSession, folder: str) -> DataFrame:
    """A portal's column descriptions, in any case and with an unknown type, applied to a CSV export."""
    path = scratch_path(spark, "advised")
    kinds = {"c_custkey": "Integer", "c_acctbal": "NUMBER", "c_nationkey": "int", "c_name": "text", "c_mktsegment": "geo_point"}
    customers = table(spark, folder, "customer").select(*kinds)
    customers.write.option("header", True).csv(path)
    schema = advisory_schema([{"name": n, "type": t, "nullable": n != "c_custkey"} for n, t in kinds.items()])
    described = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    shown = F.concat_ws("|", *[F.col(c).cast("string") for c in schema.names[1:]])
    return readers.read_csv(spark, path, schema).select("c_custkey", shown.alias("shown"), F.lit(described).alias("described"))


@query(
    "t_normalize_ts_zone",
    """SELECT event_id, epoch_us(timezone('America/New_York', ts)) AS epoch_micros,
              strftime(timezone('Asia/Tokyo', timezone('America/New_York', ts)), '%Y-%m-%d %H:%M:%S') AS there
       FROM (SELECT event_id, date_trunc('second', ts) + INTERVAL 1 MONTH * (event_id % 24) AS ts FROM events)
       WHERE NOT (month(ts) IN (3, 11) AND hour(ts) IN (1, 2))""",
)
def t_normalize_ts_zone(spark: SparkSession, folder: str) -> DataFrame:
    """Local times over two years in a zone with clock changes, without the hours of the changes, and another zone's clock."""
    moved = F.expr("date_trunc('second', ts) + make_ym_interval(0, CAST(event_id % 24 AS INT))").cast("timestamp_ntz")
    events = table(spark, folder, "events").select("event_id", moved.alias("ts"))
    events = events.where("NOT (month(ts) IN (3, 11) AND hour(ts) IN (1, 2))")
    instants = NormalizeTimestamps("America/New_York", target_unit="s")(events)
    there = NormalizeTimestamps(target_tz="Asia/Tokyo")(instants.withColumn("there", F.col("ts")).select("event_id", "there"))
    joined = instants.select("event_id", F.unix_micros("ts").alias("epoch_micros")).join(there, "event_id")
    return joined.select("event_id", "epoch_micros", F.date_format("there", "yyyy-MM-dd HH:mm:ss").alias("there"))


@query(
    "t_flatten",
    """SELECT o_orderkey, o_totalprice AS "order.price", o_orderstatus AS "order.state.code",
              o_orderpriority AS "order.state.priority" FROM orders""",
)
def t_flatten(spark: SparkSession, folder: str) -> DataFrame:
    state = F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("priority"))
    nested = table(spark, folder, "orders").select(
        "o_orderkey", F.struct(F.col("o_totalprice").alias("price"), state.alias("state")).alias("order")
    )
    return Flatten(max_depth=2)(nested)


HEADLINE_STEPS = compose(
    [
        Filter("o_totalprice > 100000"),
        SelectColumns(["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]),
        RenameColumns({"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "ordered_at"}),
        NormalizeTimestamps(),
        CastSchema(
            T.StructType(
                [
                    T.StructField("order_id", T.LongType()),
                    T.StructField("customer_id", T.IntegerType()),
                    T.StructField("ordered_at", T.TimestampType()),
                    T.StructField("o_orderpriority", T.StringType()),
                ]
            )
        ),
    ]
)


@query(
    "t_compose",
    """SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, epoch_us(o_orderdate) AS ordered_micros,
              o_orderpriority FROM orders WHERE o_totalprice > 100000""",
)
def t_compose(spark: SparkSession, folder: str) -> DataFrame:
    out = HEADLINE_STEPS(table(spark, folder, "orders"))
    return out.select("order_id", "customer_id", F.unix_micros("ordered_at").alias("ordered_micros"), "o_orderpriority")


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_orders(spark: SparkSession, folder: str) -> DataFrame:
    newest = preview(table(spark, folder, "orders"), 20, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return newest.select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "json_lines",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":' ||
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS line
       FROM customer""",
)
def json_lines_customers(spark: SparkSession, folder: str) -> DataFrame:
    shown = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    )
    return json_lines(shown)


@query(
    "unify",
    """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status, NULL::VARCHAR AS name FROM orders
       UNION ALL SELECT c_custkey, CAST(c_nationkey AS DOUBLE), NULL, c_name FROM customer""",
)
def unify_tables(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS status"
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_name AS name", "c_custkey AS id", "c_nationkey AS amount"
    )
    return unify([orders, customers])


@query(
    "concat_shards",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS shard, count(*) AS row_count,
              sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""",
)
def concat_order_shards(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    shards = [orders.where(c) for c in ("o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus NOT IN ('F', 'O')")]
    return concat_shards(shards).groupBy("shard").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "profile_full",
    """WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang, source, n_chars FROM documents)
       SELECT count(*) AS rows, false AS bounded, 0 AS position, 'doc_id' AS column_name, 'bigint' AS column_type,
              count(*) - count(doc_id) AS null_count FROM d
       UNION ALL SELECT count(*), false, 1, 'lang', 'string', count(*) - count(lang) FROM d
       UNION ALL SELECT count(*), false, 2, 'source', 'string', count(*) - count(source) FROM d
       UNION ALL SELECT count(*), false, 3, 'n_chars', 'bigint', count(*) - count(n_chars) FROM d""",
)
def profile_full(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        "doc_id", F.nullif(F.col("lang"), F.lit("en")).alias("lang"), "source", "n_chars"
    )
    return column_profile(documents)


@query(
    "profile_bounded",
    """SELECT least(count(*), 1000) AS rows, count(*) >= 1000 AS bounded, p.position, p.column_name, p.column_type,
              0::BIGINT AS null_count
       FROM orders, (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_orderstatus', 'string')) p(position, column_name, column_type)
       GROUP BY ALL""",
)
def profile_bounded(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), rows=SCAN_ROWS)


# --- sources: the tables are written in each format and read back ---------------------------------------------------

_ORDER_TOTALS = """SELECT o_orderstatus, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum,
                          sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
                   FROM orders GROUP BY o_orderstatus"""


def _order_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("o_orderkey").alias("key_sum"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


def _plain_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").drop("o_orderdate")


@query("src_csv", _ORDER_TOTALS)
def src_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    _plain_orders(spark, folder).write.option("header", True).option("sep", ";").csv(path)
    return _order_totals(readers.read_csv(spark, path, delimiter=";"))


@query("src_jsonl", _ORDER_TOTALS)
def src_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    _plain_orders(spark, folder).write.json(path)
    return _order_totals(readers.read_any(spark, path, "ndjson"))


@query(
    "src_parquet",
    """SELECT l_returnflag, l_linestatus, count(*) AS row_count, sum(l_quantity)::BIGINT AS quantity
       FROM lineitem GROUP BY ALL""",
)
def src_parquet(spark: SparkSession, folder: str) -> DataFrame:
    lines = readers.read_any(spark, f"{folder}/lineitem.parquet")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


def _write_documents(rows: DataFrame, bucket: str, path: str, suffix: str = "") -> None:
    """One text document per bucket and folder; a bucket holds a fixed number of rows."""
    rows.select(F.col(bucket).alias("bucket"), "doc").write.partitionBy("bucket").text(path + suffix)


@query(
    "src_json_array",
    """SELECT c_mktsegment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum,
              count(CASE WHEN c_custkey % 3 = 0 THEN 1 END) AS flagged
       FROM customer GROUP BY c_mktsegment""",
)
def src_json_array(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "arrays")
    element = F.to_json(
        F.struct("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.lit(True)).alias("flag"))
    )
    arrays = (
        table(spark, folder, "customer")
        .groupBy(F.expr("c_custkey div 200").alias("bucket"))
        .agg(F.concat(F.lit('\n["skipped",'), F.array_join(F.collect_list(element), ","), F.lit(", 7]")).alias("doc"))
    )
    _write_documents(arrays, "bucket", path)
    return readers.read_any(spark, path, "json").drop("bucket").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("c_custkey").alias("key_sum"),
        F.count_if("flag").alias("flagged"),
    )


@query(
    "src_geojson",
    """SELECT s_suppkey AS id, s_name AS name,
              CASE s_suppkey % 3 WHEN 0 THEN 'POINT (' || s_suppkey || ' ' || s_nationkey || ')'
                   WHEN 1 THEN 'LINESTRING (0 0, ' || s_suppkey || ' 1.5)' ELSE '' END AS geometry_wkt
       FROM supplier""",
)
def src_geojson(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "geojson")
    key = F.col("s_suppkey").cast("string")
    geometry = (
        F.when(
            F.col("s_suppkey") % 3 == 0,
            F.concat(F.lit('{"type":"Point","coordinates":['), key, F.lit(".0,"), F.col("s_nationkey"), F.lit("]}")),
        )
        .when(
            F.col("s_suppkey") % 3 == 1,
            F.concat(F.lit('{"type":"LineString","coordinates":[[0,0],['), key, F.lit(",1.5],[9]]}")),
        )
        .otherwise(F.lit("null"))
    )
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))),
        F.lit(',"geometry":'),
        geometry,
        F.lit("}"),
    )
    collections = (
        table(spark, folder, "supplier")
        .groupBy(F.expr("s_suppkey div 64").alias("bucket"))
        .agg(
            F.concat(
                F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")
            ).alias("doc")
        )
    )
    _write_documents(collections, "bucket", path)
    return readers.read_any(spark, path, "geojson").select("id", "name", "geometry_wkt")


def _sheet(rows: list[list[object]]) -> bytes:
    """A minimal workbook with one sheet."""
    lines = []
    for number, row in enumerate(rows, 1):
        cells = "".join(
            f"<c t=\"inlineStr\"><is><t>{escape(v)}</t></is></c>" if isinstance(v, str) else "<c/>" if v is None else f"<c><v>{v}</v></c>"
            for v in row
        )
        lines.append(f'<row r="{number}">{cells}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    return buffer.getvalue()


FILE_ROWS = 200_000  # rows that are packed into files together


def _file_number() -> Column:
    """The number of the file that a row goes to: rows of one split that follow one another, ``FILE_ROWS`` at most."""
    return F.floor(F.monotonically_increasing_id() / FILE_ROWS).alias("number")


def _write_binary(rows: DataFrame, path: str) -> None:
    """Write (name, content) rows as files."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                files.publish_file(f"{path}/{name}", lambda sink, content=content: sink.write(content))
            yield batch[["name"]]

    rows.select("name", "content").mapInPandas(write, "name string").count()


@query(
    "src_xlsx",
    """SELECT p_brand AS brand, count(*) AS row_count, sum(p_partkey)::BIGINT AS key_sum, sum(p_size)::BIGINT AS sizes
       FROM part GROUP BY p_brand""",
)
def src_xlsx(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "xlsx")

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, rows in zip(batch["bucket"], batch["rows"], strict=True):
                sheet = [["key", "brand", "size", "brand"]] + [
                    [int(r["p_partkey"]), r["p_brand"], int(r["p_size"]), "x"] for r in rows
                ]
                yield pd.DataFrame([(f"b{bucket}.xlsx", _sheet(sheet))], columns=["name", "content"])

    workbooks = (
        table(spark, folder, "part")
        .groupBy(F.expr("p_partkey div 250").alias("bucket"))
        .agg(F.collect_list(F.struct("p_partkey", "p_brand", "p_size")).alias("rows"))
    )
    _write_binary(workbooks.mapInPandas(books, "name string, content binary"), path)
    return readers.read_any(spark, path, "xlsx").groupBy("brand").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("key").alias("key_sum"), F.sum("size").alias("sizes")
    )


@query(
    "src_xlsx_columns",
    """SELECT p_partkey AS zkey, p_brand AS "a", p_brand || '2' AS "a_3", p_brand || '1' AS "a_2", NULL::VARCHAR AS blank, p_size AS size FROM part""",
)
def src_xlsx_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Sheet order, a column without cells, headers that clash, and a file that is no workbook."""
    path = scratch_path(spark, "xlsx")

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, rows in zip(batch["bucket"], batch["rows"], strict=True):
                sheet = [["zkey", "a", "a", "a_2", "blank", "size"]] + [
                    [int(r["p_partkey"]), r["p_brand"], f"{r['p_brand']}2", f"{r['p_brand']}1", None, int(r["p_size"])] for r in rows
                ]
                content = b"no workbook" if bucket == -1 else _sheet(sheet)
                yield pd.DataFrame([(f"b{bucket}.xlsx", content)], columns=["name", "content"])

    parts = table(spark, folder, "part")
    workbooks = parts.groupBy(F.expr("p_partkey div 250").alias("bucket")).agg(
        F.collect_list(F.struct("p_partkey", "p_brand", "p_size")).alias("rows")
    )
    broken = workbooks.where("bucket = 0").withColumn("bucket", F.col("bucket") - 1)
    _write_binary(workbooks.union(broken).mapInPandas(books, "name string, content binary"), path)
    rows, bad = xlsx.read_workbooks(spark, path)
    if rows.columns != ["zkey", "a", "a_3", "a_2", "blank", "size"] or bad.count() != 1:
        raise RuntimeError(f"columns {rows.columns}")
    return rows


@query(
    "src_json_odd_keys",
    """SELECT c_custkey AS "VOID", c_name AS "VARIANT", CAST(c_nationkey + 0.5 AS DOUBLE) AS "OBJECT", c_mktsegment AS "a, VOID>" FROM customer""",
)
def src_json_odd_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that read like types, behind more blanks than any prefix would hold."""
    path = scratch_path(spark, "odd")
    element = F.to_json(
        F.struct(
            F.col("c_custkey").alias("VOID"),
            F.col("c_name").alias("VARIANT"),
            (F.col("c_nationkey") + 0.5).alias("OBJECT"),
            F.col("c_mktsegment").alias("a, VOID>"),
        )
    )
    arrays = (
        table(spark, folder, "customer")
        .groupBy(F.expr("c_custkey div 200").alias("bucket"))
        .agg(F.concat(F.repeat(F.lit(" \n"), 40_000), F.lit("["), F.array_join(F.collect_list(element), ","), F.lit("]")).alias("doc"))
    )
    _write_documents(arrays, "bucket", path)
    return readers.read_any(spark, path, "json").select("VOID", "VARIANT", "OBJECT", "`a, VOID>`")


@query(
    "src_mixed_folder",
    """SELECT c_mktsegment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum, count(*) FILTER (c_custkey % 4 = 1) AS lines
       FROM customer GROUP BY c_mktsegment""",
)
def src_mixed_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One folder with CSV, JSON lines, a JSON array and compressed CSV, in files whose names say nothing."""
    base = scratch_path(spark, "mixed")
    customers = table(spark, folder, "customer").select(
        (F.col("c_custkey") % 4).alias("bucket"),
        F.concat_ws(",", "c_custkey", "c_mktsegment").alias("cells"),
        F.to_json(F.struct("c_custkey", "c_mktsegment", (F.col("c_custkey") % 4).alias("bucket"))).alias("object"),
        _file_number(),
    )

    def pack(key: tuple[int, int], rows: pd.DataFrame) -> pd.DataFrame:
        import gzip

        bucket, number = key
        csv = "c_custkey,c_mktsegment\n" + "\n".join(rows["cells"]) + "\n"
        body = [
            lambda: csv.encode(),
            lambda: "\n".join(rows["object"]).encode(),
            lambda: gzip.compress(csv.encode()),
            lambda: f"[{','.join(rows['object'])}]".encode(),
        ]
        name = f"feed{bucket}-{number}"
        files.publish_file(f"{base}/{name}", lambda sink: sink.write(body[bucket]()))
        return pd.DataFrame([(name,)], columns=["name"])

    customers.groupBy("bucket", "number").applyInPandas(pack, "name string").count()
    return readers.read_any(spark, base).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum"), F.count_if(F.col("bucket") == 1).alias("lines")
    )


@query(
    "src_packed",
    """SELECT k.kind, c.c_mktsegment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum
       FROM customer c, (VALUES ('gzip'), ('bzip2'), ('zstd'), ('zip')) k(kind) GROUP BY ALL""",
)
def src_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows in four codecs, in files without a telling name, read without a hint."""
    base = scratch_path(spark, "packed")
    lines = table(spark, folder, "customer").select(
        (F.col("c_custkey") % 4).alias("bucket"), F.concat_ws(",", "c_custkey", "c_mktsegment").alias("line"), _file_number()
    )

    def pack(key: tuple[int, int], rows: pd.DataFrame) -> pd.DataFrame:
        import bz2
        import gzip

        import zstandard

        bucket, number = key
        body = ("c_custkey,c_mktsegment\n" + "\n".join(rows["line"]) + "\n").encode()
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as book:
            book.writestr("rows.csv", body)
        packed = {
            "gzip": gzip.compress(body), "bzip2": bz2.compress(body),
            "zstd": zstandard.compress(body), "zip": archive.getvalue(),
        }
        for kind, content in packed.items():
            files.publish_file(f"{base}/{kind}/part{bucket}-{number}", lambda sink, content=content: sink.write(content))
        return pd.DataFrame([(f"part{bucket}-{number}",)], columns=["name"])

    lines.groupBy("bucket", "number").applyInPandas(pack, "name string").count()
    read = [
        readers.read_any(spark, f"{base}/{kind}").withColumn("kind", F.lit(kind)) for kind in ("gzip", "bzip2", "zstd", "zip")
    ]
    return reduce(DataFrame.unionByName, read).groupBy("kind", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum")
    )


@query("src_compressed", _ORDER_TOTALS)
def src_compressed(spark: SparkSession, folder: str) -> DataFrame:
    """Gzip files without a telling name: recognised by their leading bytes, decoded to a staging folder, then read."""
    packed, stage = scratch_path(spark, "packed"), scratch_path(spark, "stage")
    _plain_orders(spark, folder).write.option("header", True).option("compression", "gzip").csv(packed)
    status = files.decompress_files(files.list_files(spark, packed, "*.gz"), stage, "csv")
    failed = status.where("error IS NOT NULL").count()
    if failed:
        raise RuntimeError(f"{failed} files could not be decoded")
    return _order_totals(readers.read_csv(spark, stage))


@query("sniff_compression", "SELECT 'gzip' AS compression, count(*) > 0 AS found FROM customer")
def sniff_compression(spark: SparkSession, folder: str) -> DataFrame:
    packed = scratch_path(spark, "packed")
    table(spark, folder, "customer").write.option("compression", "gzip").json(packed)
    sniffed = files.sniff_compression(files.list_files(spark, packed, "*.gz"))
    return sniffed.groupBy("compression").agg((F.count(F.lit(1)) > 0).alias("found"))


@query("resume_row_groups", "SELECT count(*) AS row_count, sum(l_orderkey)::BIGINT AS key_sum, count(DISTINCT (l_orderkey, l_linenumber)) AS keys FROM lineitem")
def resume_row_groups(spark: SparkSession, folder: str) -> DataFrame:
    """A run stops inside files; two more with other split sizes read the rest: every row once."""
    path, name = scratch_path(spark, "groups"), "spark.sql.files.maxPartitionBytes"
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines.repartition(2).write.option("parquet.block.size", 64 * 1024).parquet(path)
    usual, read = spark.conf.get(name), []
    done = spark.createDataFrame([], "file_path string, row_group int")
    try:
        for number, split in enumerate(("1m", "16k", usual)):
            spark.conf.set(name, split)
            pending = readers.read_pending_row_groups(spark, path, done, ["l_orderkey", "l_linenumber"])
            part = pending.where(F.xxhash64("file_path", "row_group") % 3 == 0) if number < 2 else pending
            read.append(materialised(part, "part"))
            done = done.union(read[-1].select("file_path", "row_group").distinct())
    finally:
        spark.conf.set(name, usual)
    whole = read[0].union(read[1]).union(read[2])
    return whole.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("l_orderkey").alias("key_sum"),
        F.count_distinct("l_orderkey", "l_linenumber").alias("keys"),
    )


@query(
    "resume_splits",
    "SELECT count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum FROM orders WHERE o_orderstatus <> 'F'",
)
def resume_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Read what an interrupted run left: the row groups of the already finished files are skipped."""
    path = scratch_path(spark, "splits")
    _plain_orders(spark, folder).write.partitionBy("o_orderstatus").parquet(path)
    done = readers.row_groups(spark, path).where(F.col("file_path").contains("o_orderstatus=F"))
    return readers.read_pending_row_groups(spark, path, done, ["o_orderkey"]).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "sink_jsonl",
    """SELECT c_mktsegment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum FROM customer GROUP BY c_mktsegment""",
)
def sink_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    from lakegate.sources.sinks import write_jsonl

    path = scratch_path(spark, "sink")
    write_jsonl(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), path)
    return readers.read_jsonl(spark, path).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum")
    )


@query(
    "copy_raw",
    "SELECT count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum, true AS same_bytes, 0::BIGINT AS failures FROM orders",
)
def copy_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Copy a folder of files byte by byte; the copies must hold the same rows and the same digests."""
    target, source = scratch_path(spark, "raw"), scratch_path(spark, "raw-source")
    table(spark, folder, "orders").repartition(6).write.parquet(source)
    listed = files.list_files(spark, source, "*.parquet")
    copied = files.copy_files(listed, target)
    copied.write.parquet(f"{target}-status")
    status = spark.read.parquet(f"{target}-status")
    checked = status.join(files.file_digests(listed).select("path", F.col("sha256").alias("source_sha")), "path").agg(
        F.bool_and(F.col("sha256") == F.col("source_sha")).alias("same_bytes"),
        F.count("error").alias("failures"),
    )
    rows = spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )
    return rows.select(
        "*", checked.select("same_bytes").scalar().alias("same_bytes"), checked.select("failures").scalar().alias("failures")
    )
