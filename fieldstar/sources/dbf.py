"""dBASE (DBF) files as a Spark data source, split by record ranges."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fieldstar.session import ship_package

# Layout of the file header and of one field descriptor.
HEADER_BYTES, FIELD_BYTES, END_OF_FIELDS, DELETED = 32, 32, 0x0D, ord("*")
DATE = "D"  # fixed value: field type holding YYYYMMDD
BATCH_RECORDS = 65_536


def _open(path: str):
    """Random-access input on any file system the workers can reach."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, name = fs.FileSystem.from_uri(path)
    else:
        system, name = fs.LocalFileSystem(), path
    return system.open_input_file(name)


def _files(path: str) -> list[str]:
    """The file itself, or every DBF file below a folder, in name order."""
    from pyarrow import fs

    if path.lower().endswith(".dbf"):
        return [path]
    if "://" in path or path.startswith("file:"):
        system, name = fs.FileSystem.from_uri(path)
        scheme = path.split("://")[0] + "://" if "://" in path else "file://"
    else:
        system, name, scheme = fs.LocalFileSystem(), path, ""
    found = system.get_file_info(fs.FileSelector(name, recursive=True))
    return sorted(scheme + f.path for f in found if f.path.lower().endswith(".dbf"))


def read_header(path: str) -> tuple[int, int, int, list[tuple[str, str, int]]]:
    """(records, first record's offset, record length, [(field, type, width)])."""
    with _open(path) as f:
        records, offset, length = struct.unpack("<4xLHH20x", f.read(HEADER_BYTES))
        fields = []
        while True:
            descriptor = f.read(FIELD_BYTES)
            if not descriptor or descriptor[0] == END_OF_FIELDS:
                break
            name = descriptor[:11].split(b"\0")[0].decode("ascii")
            fields.append((name, chr(descriptor[11]), descriptor[16]))
    return records, offset, length, fields


def _texts(block: np.ndarray, start: int, end: int, encoding: str, date: bool) -> pa.Array:
    """One field of all records as trimmed text, blanks as NULL, dates (YYYYMMDD) with dashes."""
    cells = np.ascontiguousarray(block[:, start:end]).view(f"S{end - start}").ravel()
    texts = np.char.strip(np.char.decode(cells, encoding))
    if date:
        whole = np.char.str_len(texts) == 8
        parts = np.char.add(np.char.add(texts.astype("U4"), "-"), _cut(texts, 4, 6))
        texts = np.where(whole, np.char.add(np.char.add(parts, "-"), _cut(texts, 6, 8)), texts)
    return pa.array(texts.tolist(), pa.string(), mask=texts == "")


def _cut(texts: np.ndarray, start: int, end: int) -> np.ndarray:
    """Characters start to end of every text."""
    wide = np.ascontiguousarray(texts.astype("U8")).view("U1").reshape(len(texts), 8)
    return np.ascontiguousarray(wide[:, start:end]).view(f"U{end - start}").ravel()


class RecordRange(InputPartition):
    """Records [first, last) of one file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class DbfReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [f.name for f in schema.fields]
        self.path = options["path"]
        self.encoding = options.get("encoding", "latin-1")
        self.records = int(options.get("recordsPerPartition", 1_000_000))

    def partitions(self):
        ranges = []
        for path in _files(self.path):
            total = read_header(path)[0]
            ranges += [RecordRange(path, i, min(i + self.records, total)) for i in range(0, total, self.records)]
        return ranges or [RecordRange("", 0, 0)]

    def read(self, partition):
        if partition.first == partition.last:
            return
        _, offset, length, fields = read_header(partition.path)
        cuts, start = {}, 1  # byte 0 of a record is its deletion mark
        for name, kind, width in fields:
            cuts[name] = (start, start + width, kind)
            start += width
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        with _open(partition.path) as f:
            f.seek(offset + partition.first * length)
            left = partition.last - partition.first
            while left > 0:
                size = min(left, BATCH_RECORDS)
                left -= size
                data = f.read(size * length)
                if len(data) < size * length:
                    raise ValueError(f"{partition.path} is truncated: its header promises more records than it holds")
                block = np.frombuffer(data, "u1").reshape(size, length)
                block = block[block[:, 0] != DELETED]
                arrays = []
                for name in self.columns:
                    if name in cuts:
                        a, b, kind = cuts[name]
                        arrays.append(_texts(block, a, b, self.encoding, kind == DATE))
                    else:  # a column of other files of the folder
                        arrays.append(pa.nulls(len(block), pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


class DbfSource(DataSource):
    """Options: path (file or folder), encoding, recordsPerPartition."""

    @classmethod
    def name(cls):
        return "dbf"

    def schema(self):
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no DBF file under {self.options['path']}")
        names = dict.fromkeys(name for path in files for name, *_ in read_header(path)[3])
        return ", ".join(f"`{name}` string" for name in names)

    def reader(self, schema):
        return DbfReader(schema, self.options)


def read_dbf(spark: SparkSession, path: str, encoding: str = "latin-1", records: int = 1_000_000) -> DataFrame:
    """Read a DBF file, or all DBF files of a folder, as text columns.

    The columns are those of all files in the order of their first appearance;
    a file without one gives NULL there. A file that ends before its header
    says so raises.
    """
    ship_package(spark)
    spark.dataSource.register(DbfSource)
    reader = spark.read.format("dbf").option("encoding", encoding).option("recordsPerPartition", records)
    return reader.load(path)
