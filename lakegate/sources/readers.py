"""Format readers. Every reader returns a lazy frame; one-document formats spread over files, not inside one."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakegate.errors import DecodeError, IntakeError
from lakegate.functions.base import let
from lakegate.functions.rules import geometry_wkt
from lakegate.operators.unify import unify
from lakegate.session import materialised, scratch_path
from lakegate.sources.files import (
    decompress_files,
    list_files,
    opened,
    sniff_compression,
    sniff_formats,
    sniff_json,
    unsupported_parquet,
)
from lakegate.sources.xlsx import read_xlsx

Paths = str | list[str]
_FEATURES = "array<struct<properties:variant,geometry:string>>"


def widen_integers(schema: T.StructType) -> T.StructType:
    """Inferred integers are 64 bits wide."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType | None = None,
    delimiter: str = ",",
    encoding: str = "utf-8",
) -> DataFrame:
    """CSV with a header. Ragged rows fail instead of being padded. Give a schema to save the inference pass."""
    options = {"header": "true", "sep": delimiter, "encoding": encoding, "mode": "FAILFAST", "enforceSchema": "false"}
    if schema is None:
        schema = widen_integers(spark.read.options(inferSchema="true", **options).csv(path).schema)
    return spark.read.options(**options).schema(schema).csv(path)


def read_jsonl(spark: SparkSession, path: Paths, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def _documents(spark: SparkSession, path: Paths) -> DataFrame:
    """Whole files as text, without byte order mark; blank files give no row."""
    text = F.regexp_replace("value", "^﻿", "")
    return spark.read.text(path, wholetext=True).select(text.alias("doc")).where(F.trim("doc") != "")


# Quoted names are taken whole, so nothing inside them is read as a type; a bare name is followed by a colon.
_TYPES = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bDECIMAL\([0-9]+, ?[1-9][0-9]*\)|\b(?:VOID|VARIANT)\b(?=[,>]|$)")


def _variant_types(described: str) -> str:
    """Column types for a described VARIANT schema; mixed kinds become text."""

    def typed(found: re.Match[str]) -> str:
        part = found.group()
        if part.startswith("`"):
            return part
        return {"O": "STRUCT<", "D": "DOUBLE"}.get(part[0], "STRING")

    return _TYPES.sub(typed, described)


def typed_variant(
    df: DataFrame, column: str, extra: dict[str, Column] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Objects held as VARIANT to typed columns: the union of keys over all rows, in one aggregation.

    A given schema saves that pass.
    """
    if schema is None:
        row = df.agg(F.schema_of_variant_agg(column).alias("s")).first()
        described = row["s"] if row else None
    else:
        described = schema.simpleString().replace("struct<", "OBJECT<", 1)
    extras = [c.alias(n) for n, c in (extra or {}).items()]
    if described is None or not described.startswith("OBJECT<") or described == "OBJECT<>":
        return df.select(*extras) if extras else df.select().limit(0)
    as_struct = F.col(column).cast(_variant_types(described))
    return df.select(as_struct.alias("_s"), *extras).select("_s.*", *(extra or {}))


def read_json_array(spark: SparkSession, path: Paths, schema: T.StructType | None = None) -> DataFrame:
    """One JSON array per file; elements that are not objects are left out."""
    documents = _documents(spark, path)

    def elements(node: Column) -> Column:
        is_array = F.coalesce(F.schema_of_variant(node).startswith("ARRAY"), F.lit(False))
        listed = F.when(is_array, node.cast("array<variant>")).otherwise(
            F.raise_error(F.lit("not a JSON array")).cast("array<variant>")
        )
        return F.filter(listed, lambda e: F.schema_of_variant(e).startswith("OBJECT"))

    return typed_variant(documents.select(F.explode(let(F.try_parse_json("doc"), elements)).alias("e")), "e", schema=schema)


def read_json(spark: SparkSession, path: Paths) -> DataFrame:
    """Arrays or lines, told apart by the first character of every file."""
    sniffed = sniff_json(list_files(spark, path)).select("path", F.coalesce("json_kind", F.lit("other")).alias("kind"))
    found = {r["kind"]: r["path"] for r in sniffed.groupBy("kind").agg(F.min("path").alias("path")).collect()}
    if "other" in found:
        raise DecodeError(f"neither a JSON array nor JSON lines: {found['other']!r}")
    kinds = [k for k in ("array", "lines") if k in found]
    if not kinds:
        return spark.createDataFrame([], T.StructType([]))
    reader = {"array": read_json_array, "lines": read_jsonl}
    if len(kinds) == 1:
        return reader[kinds[0]](spark, path)

    def paths(kind: str) -> list[str]:  # mixed folders only: as many short strings as the scan itself keeps
        return [r["path"] for r in sniffed.where(F.col("kind") == kind).select("path").collect()]

    return unify([reader[k](spark, paths(k)) for k in kinds])


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_readable_parquet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The files Spark can read, and one row per finding for the others (by their footers)."""
    listed = list_files(spark, path, "*.parquet")
    findings = materialised(unsupported_parquet(listed), "parquet-findings")
    readable = listed.join(findings.select("path").distinct(), "path", "left_anti")
    paths = [r["path"] for r in readable.select("path").collect()]  # as the scan's own file list
    if not paths:
        raise DecodeError(f"no readable Parquet file below {path}")
    return spark.read.option("basePath", path).parquet(*paths), findings


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, row_group, n_rows) of every row group below ``path``, from the footers alone."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            for name in batch["path"]:
                fs, inner = opened(name)
                with fs.open_input_file(inner) as source:
                    meta = pq.read_metadata(source)
                groups = [(name, i, meta.row_group(i).num_rows) for i in range(meta.num_row_groups)]
                yield pd.DataFrame(groups, columns=["file_path", "row_group", "n_rows"])

    listed = list_files(spark, path, "*.parquet").select("path")
    return listed.mapInPandas(footers, "file_path string, row_group int, n_rows long")


def read_pending_row_groups(
    spark: SparkSession, path: str, completed: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Rows of the Parquet row groups that are not in ``completed (file_path, row_group)``, with these two columns.

    Row groups are fixed by the file, whatever the session's split size, so a run stopped inside a file goes on exactly
    there. Only short rows, one per row group, are joined and dealt out; each task then reads its row groups itself, the
    wanted columns of them, so no data is shuffled and finished row groups are not read. Partition columns in folder
    names are part of ``file_path`` alone. Record a row group as completed with the rows written from it. A completed
    row group that its file does not have raises; files that are gone do not count.
    """
    schema = spark.read.parquet(*_some_file(spark, path)).schema
    if columns is not None:
        schema = T.StructType([schema[c] for c in columns])
    done = materialised(completed.select("file_path", "row_group").distinct(), "completed")
    listed = materialised(row_groups(spark, path).select("file_path", "row_group"), "row-groups")
    known = listed.groupBy("file_path").agg(F.max("row_group").alias("last"))
    beyond = done.join(known, "file_path").where("row_group < 0 OR row_group > last").first()
    if beyond is not None:
        place = f"{beyond['row_group']} in {beyond['file_path']!r}, whose last one is {beyond['last']}"
        raise IntakeError(f"no such row group: {place}")
    pending = listed.join(done, ["file_path", "row_group"], "left_anti")
    return rows_of_row_groups(pending, schema, ["file_path", "row_group"])


def rows_of_row_groups(groups: DataFrame, schema: T.StructType, own: Sequence[str] | None = None) -> DataFrame:
    """The rows of Parquet row groups, each with further columns of its row in ``groups`` (all but its place by default).

    ``groups``: file_path, row_group and further columns, one short row per row group; these are what is dealt out, by a
    fixed number of ranges: their bytes say nothing of the work behind them. A task has neighbouring row groups and opens
    each of its files once, as a footer grows with the row groups of its file.
    """
    carried = [f for f in groups.schema.fields if (f.name in own if own else f.name not in ("file_path", "row_group"))]
    target = T.StructType([*schema.fields, *carried])
    names, arrow = schema.names, to_arrow_schema(target)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        rows = (row for batch in batches for row in batch.to_pylist())
        for name, places in groupby(rows, lambda row: row["file_path"]):
            fs, inner = opened(name)
            with fs.open_input_file(inner) as source:
                file = pq.ParquetFile(source)
                for row in places:
                    for part in file.iter_batches(row_groups=[row["row_group"]], columns=names):
                        cells = [part.column(c).cast(arrow.field(c).type) for c in names]
                        more = [pa.repeat(pa.scalar(row[f.name], arrow.field(f.name).type), part.num_rows) for f in carried]
                        yield pa.RecordBatch.from_arrays([*cells, *more], schema=arrow)

    place = ["file_path", "row_group"]
    spark = groups.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return groups.repartitionByRange(tasks, *place).sortWithinPartitions(*place).mapInArrow(read, target)


def _some_file(spark: SparkSession, path: str) -> list[str]:
    """One file that says what the columns are."""
    first = list_files(spark, path, "*.parquet").agg(F.min("path")).first()[0]
    if first is None:
        raise DecodeError(f"no Parquet file below {path}")
    return [first]


def pending_files(listing: DataFrame, completed: DataFrame) -> DataFrame:
    """Listed files without a completion row."""
    return listing.join(completed.select("path").distinct(), "path", "left_anti")


def read_geojson(spark: SparkSession, path: Paths, schema: T.StructType | None = None) -> DataFrame:
    """One row per feature: its properties as columns (``schema`` names them), and its geometry as WKT."""

    layout = (
        "type string, features array<struct<properties:variant,geometry:string>>, properties variant, geometry string"
    )

    def features(d: Column) -> Column:
        single = F.array(F.struct(d["properties"].alias("properties"), d["geometry"].alias("geometry")))
        return (
            F.when(d["type"] == "FeatureCollection", d["features"])
            .when(d["type"] == "Feature", single)
            .otherwise(F.raise_error(F.lit("not a GeoJSON Feature or FeatureCollection")).cast(_FEATURES))
        )

    rows = _documents(spark, path).select(F.inline(let(F.from_json("doc", layout), features)))
    shape = let(F.try_parse_json("geometry"), lambda g: geometry_wkt(g, F.col("geometry")))
    parts = rows.select(F.col("properties").alias("p"), shape.alias("geometry_wkt"))
    return typed_variant(parts, "p", {"geometry_wkt": F.col("geometry_wkt")}, schema)


READERS: dict[str, Callable[[SparkSession, Paths], DataFrame]] = {
    "CSV": read_csv,
    "JSON": read_json,
    "JSONL": read_jsonl,
    "NDJSON": read_jsonl,
    "XLSX": read_xlsx,
    "XLS": read_xlsx,
    "PARQUET": read_parquet,
    "GEOJSON": read_geojson,
}


_PACKED = {"GZ", "GZIP", "BZ2", "ZST", "ZSTD", "ZIP"}
_TEXT_FORMATS = {"CSV", "JSON", "JSONL", "NDJSON", "GEOJSON"}


def format_of(path: str) -> str | None:
    """Format by the extension, that of a compressed file by the one before it; None for a name without one."""
    name = [p for p in path.split("/") if p][-1:]
    parts = name[0].lstrip(".").split(".") if name else []
    while len(parts) > 1 and parts[-1].upper() in _PACKED:
        parts.pop()
    return parts[-1].upper() if len(parts) > 1 else None


def _known(fmt: str, path: str = "") -> str:
    if fmt not in READERS:
        raise ValueError(f"unknown format {fmt!r}{f' of {path!r}' if path else ''}; known: {', '.join(sorted(READERS))}")
    return fmt


def formats_below(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Formats of the files below ``path``, each with its files, or with ``path`` alone if there is one format only.

    A file's extension decides, and without one its content, decoded if it is compressed. A file that is of no known
    format is an error that names it.
    """
    listed = list_files(spark, path)
    packed = "|".join(sorted(_PACKED)).lower()
    name = F.regexp_replace(F.lower(F.regexp_extract("path", r"([^/]*)$", 1)), rf"^\.+|(\.({packed}))+$", "")
    named = listed.select("path", F.upper(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("format"))
    by_content = sniff_formats(named.where("format = ''")).select("path", F.coalesce("format", F.lit("")).alias("format"))
    found = materialised(named.where("format <> ''").union(by_content), "formats")
    per_format = {r["format"]: r["path"] for r in found.groupBy("format").agg(F.min("path").alias("path")).collect()}
    for fmt, example in sorted(per_format.items(), key=lambda item: item[1]):
        _known(fmt, example)
    if not per_format:
        raise DecodeError(f"no files below {path!r}")
    if len(per_format) == 1:
        return {fmt: [path] for fmt in per_format}
    files = {fmt: found.where(F.col("format") == fmt).select("path").collect() for fmt in per_format}  # as the scan's own lists
    return {fmt: [r["path"] for r in rows] for fmt, rows in files.items()}


def unpacked(spark: SparkSession, path: Paths, extension: str) -> Paths:
    """``path``, or, if files there are compressed, a folder of their decoded contents.

    Compression is recognised by leading bytes, whatever the names. A file that cannot be decoded is an error.
    """
    listed = list_files(spark, path)
    if sniff_compression(listed).where("compression <> 'none'").isEmpty():
        return path
    stage = scratch_path(spark, "unpacked")
    status = materialised(decompress_files(listed, stage, extension.lower()), "unpacked-status")
    bad = status.where("error IS NOT NULL").orderBy("path").first()
    if bad is not None:
        raise DecodeError(f"cannot decode {bad['path']!r}: {bad['error']}")
    return stage


def read_any(spark: SparkSession, path: Paths, fmt: str | None = None) -> DataFrame:
    """Read by format name in any case; without one by the extension, and without that by what lies there.

    A folder may hold files of several formats, and a list of paths too: each is read by its own, and the rows are united
    by name. Text formats may be compressed with gzip, bzip2, zstd or zip. An unknown format or extension is an error.
    """
    by_format: dict[str, list[str]] = {}
    for place in [path] if isinstance(path, str) else path:
        named = fmt.upper() if fmt else format_of(place)
        found = {_known(named): [place]} if named else formats_below(spark, place)
        for kind, paths in found.items():
            by_format.setdefault(kind, []).extend(paths)
    frames = []
    for kind, paths in sorted(by_format.items()):
        where: Paths = paths[0] if len(paths) == 1 else paths
        frames.append(READERS[kind](spark, unpacked(spark, where, kind) if kind in _TEXT_FORMATS else where))
    return frames[0] if len(frames) == 1 else unify(frames)
