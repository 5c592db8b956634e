"""Spark data source `sparse_table`: rows of simple and sparse columns, with their names in column-meta files.

    spark.dataSource.register(SparseTable)
    spark.read.format("sparse_table").option("filemeta", a).option("colmeta.icd", b).load(path)

A line holds entries between `!`. The file meta has the columns' names, also
between `!`; a column whose name begins with the name of a column meta is sparse:
an entry `({places},{values})` over the meta's array `{name,name}`. Places count
from 1, or from 0 where the entry as a whole is quoted. Sparse columns are maps from
`<column>_<name>` to text, others text; empty entries are empty maps and null.
Files are read in splits of lines, through any file system pyarrow knows.
"""

from __future__ import annotations

import io
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT, BATCH = 32 << 20, 5_000  # bytes of a split, lines of a batch


def split_outside(text: str, sep: str) -> list[str]:
    """Parts between separators that stand outside quotes and brackets."""
    parts, depth, quoted, start = [], 0, False, 0
    for m in re.finditer(r'\\.|["(){}]|' + re.escape(sep), text):
        c = m[0]
        if c == '"':
            quoted = not quoted
        elif not quoted and c in "({":
            depth += 1
        elif not quoted and c in ")}":
            depth -= 1
        elif not quoted and depth == 0 and c == sep:
            parts.append(text[start : m.start()])
            start = m.end()
    return [*parts, text[start:]]


def plain(text: str) -> str:
    """The text without its quotes: doubled quotes and backslashes stand for one character."""
    if len(text) < 2 or text[0] != '"' or text[-1] != '"':
        return text
    return re.sub(r'""|\\(.)', lambda m: m[1] or '"', text[1:-1])


def array(text: str) -> list[str]:
    """Elements of `{a,"b c"}`, which may be quoted as a whole."""
    body = plain(text.strip())
    if body[:1] != "{" or body[-1:] != "}":
        raise ValueError(f"not an array: {text[:80]}")
    return [plain(x) for x in split_outside(body[1:-1], ",")] if body != "{}" else []


def cells(entry: str, names: list[str]) -> dict[str, str]:
    """Name -> value of one sparse entry."""
    first = 0 if entry[:1] == '"' else 1
    body = plain(entry)
    if not body:
        return {}
    parts = split_outside(body[1:-1], ",")
    if body[0] != "(" or body[-1] != ")" or len(parts) != 2:
        raise ValueError(f"not a sparse entry: {entry[:80]}")
    places, values = [int(x) - first for x in array(parts[0])], array(parts[1])
    if len(places) != len(values) or not all(0 <= p < len(names) for p in places):
        raise ValueError(f"places without a value or a name: {entry[:80]}")
    return {names[p]: v for p, v in zip(places, values)}


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _files(path: str) -> list[fs.FileInfo]:
    store, at = _store(path)
    info = store.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=False))
    return sorted((f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.size), key=lambda f: f.path)


def _first_line(path: str) -> str:
    files = _files(path)
    if not files:
        raise ValueError(f"no meta file in {path}")
    with _store(path)[0].open_input_stream(files[0].path) as f:
        return f.read().decode().split("\n")[0].rstrip("\r")


class Lines(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class SparseTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sparse_table"

    def columns(self) -> list[tuple[str, list[str] | None]]:
        """Each column with the names of its cells, None where it is simple."""
        metas = {k.removeprefix("colmeta."): array(_first_line(v)) for k, v in self.options.items() if k.startswith("colmeta.")}
        out = []
        for column in map(plain, split_outside(_first_line(self.options["filemeta"]), "!")):
            own = max((m for m in metas if column.lower().startswith(m.lower())), key=len, default=None)
            out.append((column, None if own is None else [f"{column}_{n}" for n in metas[own]]))
        return out

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType() if names is None else T.MapType(T.StringType(), T.StringType())) for c, names in self.columns()])

    def reader(self, schema: T.StructType) -> SparseReader:
        return SparseReader(self.options["path"], self.columns(), int(self.options.get("splitsize", SPLIT)))


class SparseReader(DataSourceReader):
    def __init__(self, path: str, columns: list[tuple[str, list[str] | None]], split: int):
        self.path, self.columns, self.split = path, columns, split

    def partitions(self) -> list[InputPartition]:
        return [Lines(f.path, at, min(at + self.split, f.size)) for f in _files(self.path) for at in range(0, f.size, self.split)] or [Lines("", 0, 0)]

    def read(self, partition: Lines):
        if partition.end == 0:
            return
        kinds = [pa.string() if names is None else pa.map_(pa.string(), pa.string()) for _, names in self.columns]
        held: list[list] = [[] for _ in self.columns]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(held, kinds)], [c for c, _ in self.columns])

        for line in self._lines(partition):
            entries = split_outside(line, "!")
            if len(entries) != len(self.columns):
                raise ValueError(f"{len(entries)} entries for {len(self.columns)} columns: {line[:80]}")
            for own, entry, (_, names) in zip(held, entries, self.columns):
                own.append((plain(entry) or None) if names is None else list(cells(entry, names).items()))
            if len(held[0]) == BATCH:
                yield batch()
                held = [[] for _ in self.columns]
        if held[0]:
            yield batch()

    def _lines(self, partition: Lines):
        """Lines that begin within the split; the last one is read to its end."""
        with io.BufferedReader(_store(self.path)[0].open_input_file(partition.path), 1 << 20) as f:
            at = partition.start
            if at:
                f.seek(at - 1)
                at += len(f.readline()) - 1  # the rest of a line that began before, or just its end
            else:
                f.seek(0)
            while at < partition.end:
                line = f.readline()
                if not line:
                    return
                at += len(line)
                if text := line.decode().rstrip("\r\n"):
                    yield text
