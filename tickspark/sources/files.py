"""Text files of any codec as a data source: the first bytes of a file tell, not its name.

``spark.read.format("feed_files")`` with options ``path`` and ``glob`` (or ``names``) gives a row for every line of the files directly in
a directory. A file is read a piece at a time in a task of its own; one that is not compressed is cut into ranges
of RANGE bytes, each a task. A compressed file that does not decompress to its end gives no line but one row
with ``error``, and so does a file that can't be opened."""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "line string, file string, block long, line_no long, error string"
RANGE = 128 << 20
_PIECE = 1 << 20
_ROWS = 8192

# The first bytes of compressed files.
ZSTD, GZIP = b"\x28\xb5\x2f\xfd", b"\x1f\x8b"


def codec_of(head: bytes) -> str | None:
    return "zstd" if head.startswith(ZSTD) else "gzip" if head.startswith(GZIP) else None


def file_system(path: str):
    """(file system, path in it), for tasks: local, HDFS, S3 and GCS."""
    from pyarrow import fs

    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1) if path.startswith("s3a:") else path)


def _pieces(file, codec: str | None) -> Iterator[bytes]:
    """A file's content, decompressed, some bytes at a time; an error where it does not decompress to its end."""
    if codec == "gzip":
        import gzip

        whole = gzip.GzipFile(fileobj=file)
        while piece := whole.read(_PIECE):
            yield piece
    elif codec == "zstd":
        import zstandard

        frame, rest = None, b""
        while data := rest or file.read(_PIECE):
            frame = frame or zstandard.ZstdDecompressor().decompressobj()
            yield frame.decompress(data)
            rest, frame = (frame.unused_data, None) if frame.eof else (b"", frame)
        if frame:
            raise EOFError("the last frame is cut off")
    else:
        while piece := file.read(_PIECE):
            yield piece


def _fault(file, codec: str | None) -> str | None:
    """Why a compressed file does not decompress to its end; nothing if it does."""
    try:
        for _ in _pieces(file, codec) if codec else ():
            pass
    except Exception as e:  # noqa: BLE001  whatever the codec finds wrong
        return f"{type(e).__name__}: {e}"
    file.seek(0)
    return None


@dataclass
class FileRange(InputPartition):
    path: str | None
    start: int = 0
    size: int = 0


def _lines(pieces: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset of its begin, line) without line ends."""
    waiting, at = [], 0
    for piece in pieces:
        lines = piece.split(b"\n")
        if len(lines) == 1:
            waiting.append(piece)
            continue
        first = b"".join([*waiting, lines[0]])
        yield at, first
        at += len(first) + 1
        for line in lines[1:-1]:
            yield at, line
            at += len(line) + 1
        waiting = [lines[-1]]
    if last := b"".join(waiting):  # nothing waits after a line end, nor in a file whose last pieces decompress to nothing
        yield at, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.glob, self.range = options["path"], options.get("glob", "*"), int(options.get("rangebytes", RANGE))
        self.names = set(json.loads(options["names"])) if "names" in options else None

    def partitions(self) -> list[FileRange]:
        from pyarrow import fs

        system, root = file_system(self.path)
        scheme = self.path[: self.path.index(":") + 1] if ":" in self.path.split("/")[0] else ""
        out = []
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.File and self._is_asked_for(info.base_name):
                name = f"{self.path.rstrip('/')}/{info.base_name}" if scheme else info.path
                out += [FileRange(name, a, info.size) for a in range(0, max(info.size, 1), self.range)]
        return out or [FileRange(None)]

    def _is_asked_for(self, name: str) -> bool:
        return fnmatch.fnmatch(name, self.glob) and not name.startswith(("_", ".")) and (self.names is None or name in self.names)

    def read(self, partition: FileRange):
        import pyarrow as pa

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        path = partition.path
        if path is None:
            return
        try:
            system, name = file_system(path)
            file = system.open_input_file(name)
            codec = codec_of(file.read(4))
            file.seek(0)
            if codec and partition.start:
                return  # the first range reads it all
            fault = _fault(file, codec)
        except Exception as e:  # noqa: BLE001  a file that can't be opened is a row, not an end of the day
            fault = f"{type(e).__name__}: {e}"
        if fault:
            if not partition.start:
                yield batch([(None, path, 0, 0, fault[:500])])
            return
        start, end = partition.start, None if codec else partition.start + self.range
        # A range has the lines that begin in it: one that begins at its first byte follows a line end before it.
        file.seek(max(start - 1, 0))
        rows, number = [], 0
        for at, line in _lines(_pieces(file, codec)):
            place = at + max(start - 1, 0)
            if start and at == 0:
                continue  # ends what the range before began, or is the line end before this range
            if end is not None and place >= end:
                break
            rows.append((line.removesuffix(b"\r").decode("utf-8", "replace"), path, start, number, None))
            number += 1
            if len(rows) >= _ROWS:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


#: Schemes that tasks can open; none is a local path.
SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs")


def opens(path: str) -> bool:
    """Can tasks open files under this path themselves?"""
    return (path.split(":", 1)[0] if ":" in path.split("/")[0] else "") in SCHEMES


class FeedFiles(DataSource):
    """Options: ``path``, a directory; ``glob``, names of its files; ``names``, a JSON list of those to read and no others; ``rangebytes``, where files without a codec are cut."""

    @classmethod
    def name(cls) -> str:
        return "feed_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:  # noqa: ARG002  it has one schema
        return _Reader(self.options)


def feed_files(spark: SparkSession, path: str, glob: str = "*", range_bytes: int | None = None, names: list[str] | None = None) -> DataFrame:
    """(line, file, block, line_no, error) of the files directly in a directory, or of some of them; a missing one gives no rows.

    Files without a codec are cut as Spark cuts its own, by ``spark.sql.files.maxPartitionBytes``."""
    spark.dataSource.register(FeedFiles)
    range_bytes = range_bytes or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    reader = spark.read.format("feed_files").option("glob", glob).option("rangebytes", str(range_bytes))
    return (reader if names is None else reader.option("names", json.dumps(names))).load(path)


def listed_files(path: str, glob: str) -> list[tuple[str, int, int]]:
    """(name, size, modified ns) of the files directly in a directory that a feed would read."""
    from pyarrow import fs

    system, root = file_system(path)
    asked = _Reader({"path": path, "glob": glob})._is_asked_for
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((i.base_name, i.size, i.mtime_ns or 0) for i in found if i.type == fs.FileType.File and asked(i.base_name))
