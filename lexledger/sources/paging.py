"""Pages of documents as a data source of Spark's own kind, for batch and streaming reads, with a pluggable decoder.

    spark.dataSource.register(page_source(FormFeedText()))
    spark.read.format("pages").load("/data/specifications")
    spark.readStream.format("pages").load("/data/specifications")

A task decodes a range of pages. Small files are gathered into ranges by their size and not opened before a task reads
them; only files above ``splitBytes`` are asked for their number of pages when the read is planned, and cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO, Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGE = "path string, page_number int, text string, tables array<array<array<string>>>"
_ARROW = pa.schema([("path", pa.string()), ("page_number", pa.int32()), ("text", pa.string()), ("tables", pa.list_(pa.list_(pa.list_(pa.string()))))])
#: Bytes of files that one task reads, and pages that it hands on at a time.
SPLIT_BYTES, BATCH_PAGES = 32 << 20, 64

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of the package on its workers


class Decoder(Protocol):
    def count(self, file: BinaryIO) -> int:
        """The number of pages of an open document."""

    def pages(self, file: BinaryIO, start: int, stop: int | None) -> Iterator[tuple[int, str | None, list]]:
        """(page number, text, tables) of the pages at the places start to stop (from 0; None: to the end)."""


class FormFeedText:
    """Plain text in UTF-8 whose pages end with a form feed; there are no tables."""

    def count(self, file):
        return file.read().count(b"\f") + 1

    def pages(self, file, start, stop):
        for k, page in enumerate(file.read().split(b"\f")[start:stop], start + 1):
            yield k, page.decode("utf-8", "replace"), []


class ParquetPages:
    """Pages that were decoded before: rows of Parquet files. Only the row groups of a range are read.

    number: the column with page numbers, by default the place in the file. tables: the column with tables, if any."""

    def __init__(self, text: str = "text", number: str | None = None, tables: str | None = None):
        self.columns = {"text": text} | ({"number": number} if number else {}) | ({"tables": tables} if tables else {})

    def count(self, file):
        import pyarrow.parquet as pq

        return pq.ParquetFile(file).metadata.num_rows

    def pages(self, file, start, stop):
        import pyarrow.parquet as pq

        data, at = pq.ParquetFile(file), 0
        for group in range(data.num_row_groups):
            rows = data.metadata.row_group(group).num_rows
            low, high = max(start, at), min(at + rows, at + rows if stop is None else stop)
            if low < high:
                done = at
                for batch in data.iter_batches(BATCH_PAGES, row_groups=[group], columns=list(self.columns.values())):
                    part = batch.slice(max(0, low - done), max(0, min(high, done + batch.num_rows) - max(low, done)))
                    column = {k: part.column(c).to_pylist() for k, c in self.columns.items()}
                    first = max(low, done)
                    for k in range(part.num_rows):
                        yield column["number"][k] if "number" in column else first + k + 1, column["text"][k], column["tables"][k] if "tables" in column else []
                    done += batch.num_rows
            at += rows


@dataclass(frozen=True)
class _File:
    time: int
    path: str
    size: int


@dataclass
class _Range(InputPartition):
    """What one task reads: (path, first page, page after the last or None)."""

    parts: list[tuple[str, int, int | None]]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Pages:
    """What batch and stream readers share."""

    def __init__(self, options: dict[str, str], decoder: Decoder):
        self.root, self.decoder = options["path"], decoder
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.suffix = options.get("suffix", "")

    def files(self) -> list[_File]:
        """All files in the order in which they came: by time, then path. Hidden ones are no documents."""
        system, path = _opened(self.root)
        info = system.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda f: any(x.startswith(("_", ".")) for x in f.path[len(path) :].split("/"))
        return sorted((_File(f.mtime_ns or 0, f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(self.suffix) and (f is info or not hidden(f))), key=lambda f: (f.time, f.path))

    def ranges(self, files: list[_File]) -> list[_Range]:
        system, _ = _opened(self.root)
        out, parts, held = [], [], 0
        for f in files:
            if f.size > self.split:
                with system.open_input_file(f.path) as file:
                    n = self.decoder.count(file)
                pieces = min(n, -(-f.size // self.split)) or 1
                bounds = [n * k // pieces for k in range(pieces + 1)]
                out += [_Range([(f.path, a, b)]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                continue
            if parts and held + f.size > self.split:
                out, parts, held = [*out, _Range(parts)], [], 0
            parts.append((f.path, 0, None))
            held += f.size
        return [*out, _Range(parts)] if parts else out

    def rows(self, piece: _Range | None) -> Iterator[pa.RecordBatch]:
        if piece is None:  # there are no documents
            return
        system, _ = _opened(self.root)
        held: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

        for path, start, stop in piece.parts:
            with system.open_input_file(path) as file:
                for number, text, tables in self.decoder.pages(file, start, stop):
                    held.append((path, number, text, tables))
                    if len(held) == BATCH_PAGES:
                        yield batch()
                        held.clear()
        if held:
            yield batch()


class _BatchReader(DataSourceReader):
    def __init__(self, pages: _Pages):
        self.pages = pages

    def partitions(self):
        return self.pages.ranges(self.pages.files())

    def read(self, partition):
        return self.pages.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Documents as they arrive. The offset is the time and path of the last one that has been read, so a file must be
    put into the folder as a whole (by renaming), after those before it; ``filesPerTrigger`` bounds a batch."""

    def __init__(self, pages: _Pages, most: int):
        self.pages, self.most, self.upto = pages, most, None

    def initialOffset(self):
        return {"time": -1, "path": ""}

    def _after(self, offset):
        return [f for f in self.pages.files() if (f.time, f.path) > (offset["time"], offset["path"])]

    def latestOffset(self):
        new = self._after(self.upto or self.initialOffset())
        if new:
            last = new[: self.most][-1]
            self.upto = {"time": last.time, "path": last.path}
        return self.upto or self.initialOffset()

    def partitions(self, start, end):
        if self.upto is None or (self.upto["time"], self.upto["path"]) < (end["time"], end["path"]):
            self.upto = end  # after a restart
        return self.pages.ranges([f for f in self._after(start) if (f.time, f.path) <= (end["time"], end["path"])])

    def read(self, partition):
        return self.pages.rows(partition)

    def commit(self, end):
        pass


def page_source(decoder: Decoder, name: str = "pages") -> type[DataSource]:
    """A data source called ``name`` whose documents are read by ``decoder``. Options: path, suffix (of file names),
    splitBytes, filesPerTrigger (streams; all that are there by default)."""

    class PageSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return PAGE

        def _pages(self):
            return _Pages({k.lower(): v for k, v in self.options.items()}, decoder)

        def reader(self, schema):
            return _BatchReader(self._pages())

        def streamReader(self, schema):
            return _StreamReader(self._pages(), int({k.lower(): v for k, v in self.options.items()}.get("filespertrigger", 1 << 31)))

    return PageSource

