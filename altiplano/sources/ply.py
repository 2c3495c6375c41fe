"""PLY point clouds: a Spark data source ("ply") that reads every vertex property and writes one file a partition."""

from __future__ import annotations

import glob
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Fixed names of the format's types, with numpy's and Spark's.
TYPES = {"char": ("i1", "byte"), "uchar": ("u1", "short"), "short": ("i2", "short"), "ushort": ("u2", "int"), "int": ("i4", "int"), "uint": ("u4", "long"), "float": ("f4", "float"), "double": ("f8", "double"), "int8": ("i1", "byte"), "uint8": ("u1", "short"), "int16": ("i2", "short"), "uint16": ("u2", "int"), "int32": ("i4", "int"), "uint32": ("u4", "long"), "float32": ("f4", "float"), "float64": ("f8", "double")}
BACK = {"byte": "char", "short": "uchar", "int": "int", "bigint": "int", "float": "float", "double": "double", "tinyint": "char", "smallint": "uchar"}


@dataclass
class Header:
    form: str
    count: int
    names: list[str]
    types: list[str]
    comments: list[str]
    size: int


def header(data: bytes) -> Header:
    end = data.index(b"end_header")
    end = data.index(b"\n", end) + 1
    lines = data[:end].decode("ascii", "replace").splitlines()
    if lines[0].strip() != "ply":
        raise ValueError("not a PLY file")
    out, element = Header("ascii", 0, [], [], [], end), ""
    for line in lines[1:]:
        words = line.split()
        if not words:
            continue
        if words[0] == "format":
            out.form = words[1]
        elif words[0] == "comment":
            out.comments.append(line.split(" ", 1)[1] if " " in line else "")
        elif words[0] == "element":
            element = words[1]
            if element == "vertex":
                out.count = int(words[2])
        elif words[0] == "property" and element == "vertex":
            out.types.append(words[1])
            out.names.append(words[2])
    return out


def vertices(data: bytes, h: Header) -> np.ndarray:
    """Record array of the vertices."""
    order = ">" if h.form == "binary_big_endian" else "<"
    kind = np.dtype([(n, order + TYPES[t][0]) for n, t in zip(h.names, h.types, strict=True)])
    if h.form != "ascii":
        return np.frombuffer(data, kind, h.count, h.size)
    rows = [tuple(line.split()[: len(h.names)]) for line in data[h.size :].decode("ascii").splitlines()[: h.count]]
    return np.array([tuple(float(x) for x in r) for r in rows], np.dtype([(n, "f8") for n in h.names])).astype(kind)


def encode(columns: dict[str, np.ndarray], types: dict[str, str], comments: list[str]) -> bytes:
    """A binary little-endian file of the columns; types by Spark's names."""
    n = len(next(iter(columns.values()), []))
    kinds = {c: BACK[types[c]] for c in columns}
    head = ["ply", "format binary_little_endian 1.0", *[f"comment {c}" for c in comments], f"element vertex {n}", *[f"property {kinds[c]} {c}" for c in columns], "end_header"]
    rec = np.empty(n, np.dtype([(c, "<" + TYPES[kinds[c]][0]) for c in columns]))
    for c, v in columns.items():
        rec[c] = v
    return ("\n".join(head) + "\n").encode() + rec.tobytes()


def colour_columns(channels: int) -> list[str]:
    """Names that a cloud's colours get: one channel is repeated to three; three and four are as they are."""
    if channels not in (1, 3, 4):
        raise ValueError(f"{channels} colour channels")
    return ["red", "green", "blue", "ir"][: max(3, channels)]


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PlySource(DataSource):
    """Options: path (a file, a folder or a pattern); for writing, comments separated by |."""

    @classmethod
    def name(cls) -> str:
        return "ply"

    def _files(self) -> list[str]:
        path = self.options["path"]
        return sorted(glob.glob(os.path.join(path, "*.ply") if os.path.isdir(path) else path))

    def schema(self) -> str:
        files = self._files()
        if not files:
            raise FileNotFoundError(self.options["path"])
        with open(files[0], "rb") as f:
            h = header(f.read(1 << 16))
        return ", ".join(f"`{n}` {TYPES[t][1]}" for n, t in zip(h.names, h.types, strict=True))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._files(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema, [c for c in self.options.get("comments", "").split("|") if c], overwrite)


class _Reader(DataSourceReader):
    """One partition a file; files have the columns of the first one."""

    def __init__(self, files: list[str], schema: StructType):
        self.files, self.wanted = files, schema

    def partitions(self):
        return [_File(f) for f in self.files]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.wanted)
        with open(partition.path, "rb") as f:
            data = f.read()
        rec = vertices(data, header(data))
        for at in range(0, len(rec), 65536):
            part = rec[at : at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[f.name]).astype(part.dtype[f.name].newbyteorder("="))).cast(f.type) for f in target], schema=target)


@dataclass
class _Written(WriterCommitMessage):
    path: str


class _Writer(DataSourceArrowWriter):
    """A partition's file gets its name by its task's commit, so a lost attempt leaves only a hidden file."""

    def __init__(self, path: str, schema: StructType, comments: list[str], overwrite: bool = False):
        self.path, self.types, self.comments, self.overwrite = path, {f.name: f.dataType.simpleString() for f in schema}, comments, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        batches = list(iterator)
        columns = {c: np.concatenate([np.asarray(b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)) for b in batches]) if batches else np.empty(0) for c in self.types}
        os.makedirs(self.path, exist_ok=True)
        at = os.path.join(self.path, f".cloud-{uuid.uuid4().hex}.ply")
        with open(at, "wb") as f:
            f.write(encode(columns, self.types, self.comments))
        return _Written(at)

    def commit(self, messages) -> None:
        if self.overwrite:
            for old in glob.glob(os.path.join(self.path, "*.ply")):
                os.remove(old)
        for m in messages:
            if m is not None:
                os.rename(m.path, os.path.join(os.path.dirname(m.path), os.path.basename(m.path)[1:]))

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.path):
                os.remove(m.path)


def register(spark: SparkSession) -> None:
    from ..stage import prepare

    prepare(spark).dataSource.register(PlySource)


def comments(path: str) -> list[str]:
    with open(path, "rb") as f:
        return header(f.read(1 << 16)).comments
