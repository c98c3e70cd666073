"""Files of lines that grow while they are read, as a streaming source.

A batch ends after the last complete line of every file, so what is written of a line waits
for the rest. Positions are bytes per file and live in the query's checkpoint: a restart
goes on behind the last line taken. Large gains are read in pieces by several tasks.

A file shorter than what was read of it is an error. One that vanished is forgotten; a file
that comes back under its name is a new one. Names that begin with a dot or an underscore
are passed over.
"""

from __future__ import annotations

import io
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "raw string, file string, position bigint"
PIECE_BYTES = 32 << 20
_BLOCK = 1 << 20
_ROWS = 10_000


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Piece(InputPartition):
    """Lines of one file that begin at ``first`` or behind it, and before ``last``."""

    def __init__(self, path: str, first: int, last: int):
        super().__init__((path, first, last))


class GrowingLines(DataSource):
    """Options: ``path`` of a file or folder, ``starting`` at the ``end`` or ``start`` of what is there."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LinesReader:
        return LinesReader(
            self.options["path"],
            self.options.get("starting", "end"),
            int(self.options.get("piecebytes", PIECE_BYTES)),
        )


class LinesReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, piece_bytes: int):
        if starting not in ("start", "end"):
            raise ValueError(f"starting is start or end, not {starting!r}")
        self.path, self.starting, self.piece_bytes = path, starting, piece_bytes
        self.sizes: dict[str, int] = {}
        self.complete: dict[str, int] = {}

    def _files(self) -> dict[str, int]:
        """Sizes of the files there now, by their path."""
        system, where = _located(self.path)
        found = system.get_file_info(where)
        if found.type == fs.FileType.NotFound:
            return {}
        entries = [found]
        if found.type == fs.FileType.Directory:
            entries = system.get_file_info(fs.FileSelector(where))
        return {
            entry.path: entry.size
            for entry in sorted(entries, key=lambda entry: entry.path)
            if entry.type == fs.FileType.File and posixpath.basename(entry.path)[0] not in "._"
        }

    def _ends(self) -> dict[str, int]:
        """For each file the place behind its last complete line."""
        system, _ = _located(self.path)
        sizes = self._files()
        ends = {}
        for path, size in sizes.items():
            known = self.complete.get(path, 0)
            if size < known:
                raise ValueError(f"{path} shrank: {known} bytes were read of it, it has {size}")
            ends[path] = known if size == self.sizes.get(path) else _last_line(system, path, known, size)
        self.sizes, self.complete = sizes, ends
        return ends

    def initialOffset(self) -> dict:
        return {"bytes": self._ends() if self.starting == "end" else {}}

    def latestOffset(self) -> dict:
        return {"bytes": self._ends()}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for path, last in end["bytes"].items():
            first = start["bytes"].get(path, 0)
            if last < first:
                raise ValueError(f"{path} shrank: {first} bytes were read of it, it has {last} in whole lines")
            pieces += [
                Piece(path, at, min(at + self.piece_bytes, last)) for at in range(first, last, self.piece_bytes)
            ]
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, _ = _located(self.path)
        path, first, last = partition.value
        name = posixpath.basename(path)
        with system.open_input_file(path) as file:
            lines = io.BufferedReader(file, _BLOCK)
            at = first
            if first:
                # A line that began earlier belongs to the piece before.
                lines.seek(first - 1)
                at += len(lines.readline()) - 1
            texts: list[str] = []
            places: list[int] = []
            while at < last:
                line = lines.readline()
                if not line.endswith(b"\n"):
                    raise ValueError(f"{path} shrank while it was read")
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text.strip():
                    texts.append(text)
                    places.append(at)
                at += len(line)
                if len(texts) == _ROWS or (texts and at >= last):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(texts, pa.string()),
                            pa.array([name] * len(texts), pa.string()),
                            pa.array(places, pa.int64()),
                        ],
                        ["raw", "file", "position"],
                    )
                    texts, places = [], []


def _last_line(system: fs.FileSystem, path: str, known: int, size: int) -> int:
    """The place behind the last newline before ``size``; ``known`` if there is none after it."""
    with system.open_input_file(path) as file:
        end = size
        while end > known:
            first = max(known, end - _BLOCK)
            file.seek(first)
            at = file.read(end - first).rfind(b"\n")
            if at >= 0:
                return first + at + 1
            end = first
    return known


def growing_lines(
    spark: SparkSession, path: str, starting: str = "end", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Lines appended to a file, or to the files of a folder; blank lines are skipped.

    ``path`` must be readable by the driver and all executors. Columns are ``raw``, the
    file's name and the byte at which the line begins.
    """
    spark.dataSource.register(GrowingLines)
    return (
        spark.readStream.format(GrowingLines.name())
        .option("path", path)
        .option("starting", starting)
        .option("piecebytes", str(piece_bytes))
        .load()
    )
