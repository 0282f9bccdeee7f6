"""Jobs over whole files: listing, sniffing, digests, decompression and copying.

Files are listed by Spark's ``binaryFile`` source without their content, which also packs them into tasks by size.
Tasks then stream each file through a small buffer, so neither file size nor file count is bounded by memory.
"""

from __future__ import annotations

import bz2
import codecs
import ctypes
import hashlib
import io
import math
import re
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.base import ColumnOrName, case, col
from lakegate.session import materialised

# Fixed values.
CHUNK = 1 << 20
PIECE = 1 << 27  # bytes of a file that fit into one cell
STRIDE = 4  # pieces of a file that one task digests
MAGIC = {"gzip": "1F8B", "bzip2": "425A68", "zstd": "28B52FFD", "zip": "504B0304"}
ENCODINGS = {
    "gzip": ("gzip", "x-gzip"),
    "bzip2": ("bzip2", "bz2", "x-bzip2"),
    "zstd": ("zstd",),
    "zip": ("zip", "x-zip"),
}


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, size and modification time of every file below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def compression_of(magic: ColumnOrName, encoding: ColumnOrName | None = None) -> Column:
    """Compression by leading bytes, or by a ``Content-Encoding`` hint."""
    head = F.hex(col(magic))
    hint = F.lower(F.trim(col(encoding))) if encoding is not None else F.lit("")
    return case(
        [
            (head.startswith(MAGIC[kind]) | F.coalesce(hint.isin(*ENCODINGS[kind]), F.lit(False)), F.lit(kind))
            for kind in MAGIC
        ],
        F.lit("none"),
    )


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and inner path of a path as Spark prints it (``/a``, ``file:/a b``, ``s3a://bucket/key``)."""
    located = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(/.*)$", path, re.DOTALL)
    if located is None:
        return pafs.LocalFileSystem(), path
    scheme, rest = located.groups()
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{quote(rest, safe='/@:')}")


def _per_file(work: Callable[[str], dict[str, object]], columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                row: dict[str, object] = dict.fromkeys(columns)
                row["path"] = path
                try:
                    row.update(work(path))
                except Exception as problem:  # one bad file becomes one status row
                    row["error"] = f"{type(problem).__name__}: {problem}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=columns)

    return run


def file_heads(files: DataFrame, length: int = 64) -> DataFrame:
    """The first bytes of every file."""

    def head(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        with fs.open_input_stream(inner, compression=None) as source:
            return {"head": source.read(length)}

    return files.select("path").mapInPandas(
        _per_file(head, ["path", "head", "error"]), "path string, head binary, error string"
    )


def sniff_compression(files: DataFrame) -> DataFrame:
    heads = file_heads(files)
    return heads.select("path", compression_of("head").alias("compression"), "error")


def sniff_json(files: DataFrame) -> DataFrame:
    """``array``, ``lines``, ``empty`` or ``other`` by the first character that is not blank (after a byte order mark).

    However many blanks there are, files are read up to that character.
    """
    start = F.decode("head", "ISO-8859-1")
    kind = case(
        [
            (start.startswith("["), F.lit("array")),
            (start.startswith("{"), F.lit("lines")),
            (start == "", F.lit("empty")),
        ],
        F.lit("other"),
    )

    def first(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        with fs.open_input_stream(inner, compression=None) as source:
            chunk = source.read(CHUNK).removeprefix(b"\xef\xbb\xbf")
            while chunk and not chunk.strip():
                chunk = source.read(CHUNK)
            return {"head": chunk.lstrip()[:1]}

    heads = files.select("path").mapInPandas(
        _per_file(first, ["path", "head", "error"]), "path string, head binary, error string"
    )
    return heads.select("path", kind.alias("json_kind"), "error")


def _format_of_content(start: bytes) -> str | None:
    """Format by the first decoded bytes: Parquet by its mark, JSON by its first character, other text is CSV."""
    text = start.removeprefix(b"\xef\xbb\xbf").lstrip()
    if start.startswith(b"PAR1"):
        return "PARQUET"
    if b"\0" in text or text.startswith(b"<"):
        return None
    try:
        codecs.getincrementaldecoder("utf-8")().decode(text)  # the last character may be cut
    except UnicodeDecodeError:
        return None
    return "JSON" if text[:1] in (b"{", b"[") else "CSV"


def sniff_formats(files: DataFrame) -> DataFrame:
    """Format of every file by its content, decoded if it is compressed; NULL where none is recognised."""

    def sniff(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        with fs.open_input_file(inner) as source:
            return {"format": _format_of_content(next(_chunks(_packing(source.read(4)), _rewound(source)), b""))}

    return files.select("path").mapInPandas(
        _per_file(sniff, ["path", "format", "error"]), "path string, format string, error string"
    )


def _packing(head: bytes) -> str:
    return next((kind for kind, magic in MAGIC.items() if head.hex().upper().startswith(magic)), "none")


def _rewound(source: io.IOBase) -> io.IOBase:
    source.seek(0)
    return source


class ResumableDigest:
    """SHA-256 or MD5 whose state can be handed to another task, which ``hashlib`` does not let out.

    The state is the context of the OpenSSL below ``hashlib``; every update starts from its bytes and leaves bytes.
    """

    FUNCTIONS = {"sha256": ("SHA256", 32), "md5": ("MD5", 16)}
    ROOM = 256  # contexts take 112 and 92 bytes

    def __init__(self, name: str, state: bytes | None = None):
        import _hashlib

        prefix, self.length = self.FUNCTIONS[name]
        library = ctypes.CDLL(_hashlib.__file__)
        self.init, self.add, self.final = (getattr(library, f"{prefix}_{part}") for part in ("Init", "Update", "Final"))
        self.state = state
        if not state:
            context = ctypes.create_string_buffer(self.ROOM)
            self._call(self.init, context)
            self.state = context.raw

    def _call(self, function: Callable[..., int], *args: object) -> None:
        if function(*args) != 1:
            raise RuntimeError("OpenSSL refused a digest")

    def update(self, chunk: bytes) -> None:
        context = ctypes.create_string_buffer(self.state, self.ROOM)
        self._call(self.add, context, chunk, ctypes.c_size_t(len(chunk)))
        self.state = context.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(self.length)
        self._call(self.final, out, ctypes.create_string_buffer(self.state, self.ROOM))
        return out.raw.hex()


def _plain_digests() -> list:
    return [hashlib.sha256(), hashlib.md5(usedforsecurity=False)]


def _resumable_digests(sha256: bytes | None = None, md5: bytes | None = None) -> list:
    return [ResumableDigest("sha256", sha256), ResumableDigest("md5", md5)]


def _digest_pieces(
    source: io.IOBase, start: int, whole: list, fresh: Callable[[], list] | None, most: float
) -> tuple[int, list[str]]:
    """Add what follows in ``source`` to the digests ``whole``, up to ``most`` pieces.

    Returns the bytes read and, if asked for by ``fresh``, the digests of each piece of its own.
    """
    size, pieces, count = 0, [], 0
    while count < most:
        own, length = fresh() if fresh else [], 0
        while length < PIECE and (chunk := source.read(min(CHUNK, PIECE - length))):
            for digest in (*whole, *own):
                digest.update(chunk)
            length += len(chunk)
        if fresh and (length or start + size == 0):
            pieces.append(":".join(map(str, (start + size, length, *(digest.hexdigest() for digest in own)))))
        size, count = size + length, count + 1
        if length < PIECE:
            break
    return size, pieces


def file_digests(files: DataFrame, pieces: bool = False) -> DataFrame:
    """Size, SHA-256 and MD5 of every file, streamed; one task reads ``STRIDE`` pieces of a file at most.

    Larger files are read in waves: a task goes on from the state of the digest that the task before it left in a table.
    Where OpenSSL does not give that state out, one task reads the whole file. With ``pieces`` there is a column with
    ``start:length:sha256:md5`` of every piece of ``PIECE`` bytes, taken on the same way.
    """
    extra = ["pieces"] if pieces else []
    columns = ["path", "size", "sha256", "md5", *extra, "error"]
    schema = f"path string, size bigint, sha256 string, md5 string, {'pieces array<string>, ' if pieces else ''}error string"
    states = ["path", "size", "sha256_state", "md5_state", "sha256", "md5", "pieces", "error"]

    def digest(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        whole = _plain_digests()
        with fs.open_input_stream(inner, compression=None) as source:
            size, own = _digest_pieces(source, 0, whole, _plain_digests if pieces else None, math.inf)
        return {"size": size, "sha256": whole[0].hexdigest(), "md5": whole[1].hexdigest(), **dict.fromkeys(extra, own)}

    def wave(row: pd.Series) -> dict[str, object]:
        start, most, fresh = int(row["size"]), STRIDE, _resumable_digests
        try:
            whole = _resumable_digests(row["sha256_state"], row["md5_state"])
        except (AttributeError, ImportError, OSError, RuntimeError):  # no state is given out: all, from the start
            start, most, fresh, whole = 0, math.inf, _plain_digests, _plain_digests()
        fs, inner = opened(row["path"])
        with fs.open_input_file(inner) as source:
            source.seek(start)
            size, own = _digest_pieces(source, start, whole, fresh if pieces else None, most)
        out = {"size": start + size, "pieces": [*(row["pieces"] if start else ()), *own]}
        if size == most * PIECE:
            return {**out, "sha256_state": whole[0].state, "md5_state": whole[1].state}
        return {**out, "sha256": whole[0].hexdigest(), "md5": whole[1].hexdigest()}

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                yield from _per_file(lambda _, row=batch.iloc[i]: wave(row), states)(iter([batch.iloc[[i]]]))

    sized = _with_size(files)
    large = F.coalesce(F.col("size"), F.lit(0)) > STRIDE * PIECE
    small = sized.where(~large).select("path").mapInPandas(_per_file(digest, columns), schema)
    if sized.where(large).isEmpty():
        return small
    begun = {
        "size": F.lit(0).cast("bigint"),
        **dict.fromkeys(["sha256_state", "md5_state"], F.lit(b"")),
        **dict.fromkeys(["sha256", "md5", "error"], F.lit(None).cast("string")),
        "pieces": F.array().cast("array<string>"),
    }
    state = materialised(sized.where(large).withColumns(begun).select(*states), "digest-states")
    under_way = F.col("sha256_state").isNotNull()
    while count := state.where(under_way).count():
        dealt = state.where(under_way).repartitionByRange(count, "path")  # one file a task
        state = materialised(state.where(~under_way).unionAll(dealt.mapInPandas(go_on, state.schema)), "digest-states")
    return small.unionAll(state.select(*columns))


def _with_size(files: DataFrame) -> DataFrame:
    """Path and size; files that come without it are asked for it, and have none where they cannot be read."""

    def size(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        return {"size": fs.get_file_info(inner).size}

    if "size" in files.columns:
        return files.select("path", "size")
    return files.select("path").mapInPandas(_per_file(size, ["path", "size"]), "path string, size bigint")


def file_pieces(files: DataFrame) -> DataFrame:
    """Start and content of every piece of ``PIECE`` bytes of the files (path, size): one piece a task."""
    count = files.agg(F.sum(F.ceil(F.col("size") / PIECE))).first()[0] or 1
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(PIECE).cast("bigint")))
    dealt = files.where("size > 0").select("path", starts.alias("start")).repartitionByRange(count, "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"], strict=True):
                fs, inner = opened(path)
                with fs.open_input_file(inner) as source:
                    source.seek(start)
                    yield pd.DataFrame({"path": [path], "start": [start], "content": [source.read(PIECE)]})

    return dealt.mapInPandas(read, "path string, start bigint, content binary")


def source_version(files: DataFrame) -> DataFrame:
    """Version of a source: the digest of its raw bytes, NULL where it cannot be read."""
    return file_digests(files).select("path", F.col("sha256").alias("source_version"))


def publish_file(target: str, write: Callable[[io.IOBase], None]) -> None:
    """Write beside the target, then move: a repeated task attempt ends in the same file."""
    fs, inner = opened(target)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    part = f"{inner}.{uuid.uuid4().hex}.part"
    try:
        with fs.open_output_stream(part, compression=None) as sink:
            write(sink)
        try:
            fs.move(part, inner)
        except OSError:  # some file systems do not replace: an earlier attempt got this far already
            fs.delete_file(inner)
            fs.move(part, inner)
    except Exception:
        if fs.get_file_info(part).type != pafs.FileType.NotFound:
            fs.delete_file(part)
        raise


def copy_files(files: DataFrame, destination: str, suffix: str = ".bin") -> DataFrame:
    """Copy every file byte by byte, one status row each; a failure does not stop the others.

    The target name is the digest of the source path, or the column ``name`` when ``files`` has one. Sources that share a
    name are not copied at all: each gets an error, as they would overwrite each other.
    """
    root = destination.rstrip("/")
    name = F.col("name") if "name" in files.columns else F.concat(F.sha2("path", 256), F.lit(suffix))
    named = files.select("path", name.alias("name")).distinct()
    claims = named.groupBy(F.col("name").alias("_name")).agg(F.count(F.lit(1)).alias("claims"))
    named = named.join(claims, F.col("name").eqNullSafe(F.col("_name"))).select("path", "name", "claims")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = dict(zip(batch["path"], batch["name"], strict=True))
            claims = dict(zip(batch["path"], batch["claims"], strict=True))

            def copy(path: str) -> dict[str, object]:
                if names[path] is None or claims[path] > 1:
                    raise ValueError(f"{claims[path]} sources share the target name {names[path]!r}")
                fs, inner = opened(path)
                sha, size, target = hashlib.sha256(), 0, f"{root}/{names[path]}"

                def write(sink: io.IOBase) -> None:
                    nonlocal size
                    with fs.open_input_stream(inner, compression=None) as source:
                        while chunk := source.read(CHUNK):
                            sha.update(chunk)
                            size += len(chunk)
                            sink.write(chunk)

                publish_file(target, write)
                return {"target": target, "size": size, "sha256": sha.hexdigest()}

            yield from _per_file(copy, ["path", "target", "size", "sha256", "error"])(iter([batch]))

    return named.mapInPandas(
        run, "path string, target string, size bigint, sha256 string, error string"
    )


def _chunks(kind: str, source: io.IOBase) -> Iterator[bytes]:
    """Decoded bytes of a compressed stream; truncated input raises."""
    if kind == "zip":
        with zipfile.ZipFile(source) as archive:  # seeks in the source, holds no archive in memory
            members = [m for m in archive.infolist() if not m.is_dir()]
            if not members:
                raise ValueError("archive holds no files")
            with archive.open(max(members, key=lambda m: m.file_size)) as member:
                while chunk := member.read(CHUNK):
                    yield chunk
        return
    if kind == "zstd":
        import zstandard

        decoder, pending = zstandard.ZstdDecompressor().decompressobj(), b""
        while chunk := pending or source.read(CHUNK):
            pending = b""
            out = decoder.decompress(chunk)
            if out:
                yield out
            if decoder.eof:  # frames may follow one another
                pending = decoder.unused_data
                if pending or _has_more(source):
                    decoder = zstandard.ZstdDecompressor().decompressobj()
        if not decoder.eof:
            raise EOFError("truncated zstd stream")
        return
    if kind == "none":
        while chunk := source.read(CHUNK):
            yield chunk
        return
    start = (lambda: zlib.decompressobj(31)) if kind == "gzip" else bz2.BZ2Decompressor
    decoder, pending = start(), b""
    while chunk := pending or source.read(CHUNK):
        pending = b""
        out = decoder.decompress(chunk)
        if out:
            yield out
        if decoder.eof:  # a file may hold several streams one after the other
            pending = decoder.unused_data
            if pending or _has_more(source):
                decoder = start()
    if not decoder.eof:
        raise EOFError(f"truncated {kind} stream")


def _has_more(source: io.IOBase) -> bool:
    return source.tell() < source.size()


def decompress_files(files: DataFrame, stage: str, extension: str) -> DataFrame:
    """Decode compressed files of any name into ``stage`` for the normal readers, one status row each.

    Compression is recognised by leading bytes. Of a zip archive the largest member is taken.
    """
    root = stage.rstrip("/")

    def decode(path: str) -> dict[str, object]:
        fs, inner = opened(path)
        with fs.open_input_stream(inner, compression=None) as probe:
            kind = _packing(probe.read(4))
        target = f"{root}/{hashlib.sha256(path.encode()).hexdigest()}.{extension}"
        size = 0

        def write(sink: io.IOBase) -> None:
            nonlocal size
            with fs.open_input_file(inner) as source:
                for chunk in _chunks(kind, source):
                    size += len(chunk)
                    sink.write(chunk)

        publish_file(target, write)
        return {"compression": kind, "target": target, "size": size}

    return files.select("path").mapInPandas(
        _per_file(decode, ["path", "compression", "target", "size", "error"]),
        "path string, compression string, target string, size bigint, error string",
    )


def largest_member(members: DataFrame, archive: str = "archive") -> DataFrame:
    """The biggest member of every archive (one candidate per task and archive; no window)."""
    return members.groupBy(archive).agg(
        F.max_by("member", F.struct("size", "member")).alias("member"), F.max("size").alias("size")
    )


def unsupported_parquet(files: DataFrame) -> DataFrame:
    """Parquet columns Spark cannot read (time of day, nanosecond timestamps), from the footers alone, one row each.

    An unreadable footer is a finding as well, so a folder can be cleared of what would fail the whole scan.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch["path"]:
                try:
                    fs, inner = opened(path)
                    with fs.open_input_file(inner) as source:
                        schema = pq.read_schema(source)
                except Exception as problem:  # one bad file becomes one finding
                    found.append((path, None, f"{type(problem).__name__}: {problem}"))
                    continue
                for field in schema:
                    if pa.types.is_time(field.type):
                        found.append((path, field.name, "time of day"))
                    elif pa.types.is_timestamp(field.type) and field.type.unit == "ns":
                        found.append((path, field.name, "nanosecond timestamp"))
            yield pd.DataFrame(found, columns=["path", "column_name", "problem"])

    return files.select("path").mapInPandas(run, "path string, column_name string, problem string")
