"""Binary little-endian PLY point tables as a Spark data source: register with `spark.dataSource.register(PlySource)` and read with `spark.read.format("ply")`.

A partition is a run of records of the vertex element, so a large file is read by many tasks. The path must be one that
every executor can open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Property types of the format, by both of their names, as numpy and SQL types.
TYPES = {
    "char": ("<i1", "tinyint"), "int8": ("<i1", "tinyint"), "uchar": ("<u1", "smallint"), "uint8": ("<u1", "smallint"),
    "short": ("<i2", "smallint"), "int16": ("<i2", "smallint"), "ushort": ("<u2", "int"), "uint16": ("<u2", "int"),
    "int": ("<i4", "int"), "int32": ("<i4", "int"), "uint": ("<u4", "bigint"), "uint32": ("<u4", "bigint"),
    "float": ("<f4", "float"), "float32": ("<f4", "float"), "double": ("<f8", "double"), "float64": ("<f8", "double"),
}


@dataclass
class Header:
    rows: int
    start: int
    fields: list[tuple[str, str]]


def header(path: str, element: str = "vertex") -> Header:
    """Of a file whose first element is the one wanted."""
    with open(path, "rb") as f:
        if f.readline().strip() != b"ply":
            raise ValueError(f"{path} is no PLY file")
        rows, fields, current = -1, [], None
        for raw in f:
            words = raw.decode("ascii").split()
            if words[:1] == ["format"] and words[1] != "binary_little_endian":
                raise ValueError(f"{path}: only binary_little_endian is read")
            if words[:1] == ["element"]:
                current = words[1]
                if rows < 0 and current != element:
                    raise ValueError(f"{path}: the first element isn't {element}")
                if current == element:
                    rows = int(words[2])
            elif words[:1] == ["property"] and current == element:
                if words[1] == "list":
                    raise ValueError(f"{path}: lists in {element} aren't read")
                fields.append((words[2], words[1]))
            elif words[:1] == ["end_header"]:
                if rows < 0:
                    raise ValueError(f"{path} has no {element}")
                return Header(rows, f.tell(), fields)
    raise ValueError(f"{path}: the header has no end")


def harmonics_degree(names: list[str], prefix: str = "f_rest_") -> int:
    """Degree of the spherical harmonics whose coefficients beyond the first are named prefix0, prefix1 ...; an error if these have gaps or don't make up whole bands of three channels."""
    found = sorted(int(x.removeprefix(prefix)) for x in names if x.startswith(prefix))
    degree = round((1 + len(found) / 3) ** 0.5) - 1
    if found != list(range(len(found))) or 3 * ((degree + 1) ** 2 - 1) != len(found):
        raise ValueError(f"{len(found)} coefficients named {prefix}* don't make up whole bands")
    return degree


#: What a table of splats has to hold.
REQUIRED = ("x", "y", "z", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3", "opacity", "f_dc_0", "f_dc_1", "f_dc_2")


def require(names: list[str], needed: tuple[str, ...] = REQUIRED) -> None:
    """An error that names the fields that are lacking."""
    if lacking := [x for x in needed if x not in names]:
        raise ValueError(f"fields are missing: {', '.join(lacking)}")


@dataclass
class Span(InputPartition):
    first: int
    last: int


class PlySource(DataSource):
    """Options: path; rows_per_partition (250,000 by default); required: fields that the file must have, separated by commas (`splats`: all of a table of splats); fields: those to read, all by default."""

    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> str:
        fields = header(self.options["path"]).fields
        names = [n for n, _ in fields]
        if needed := self.options.get("required"):
            require(names, REQUIRED if needed == "splats" else tuple(needed.split(",")))
        wanted = self.options["fields"].split(",") if "fields" in self.options else names
        require(names, tuple(wanted))
        return ", ".join(f"`{n}` {TYPES[t][1]}" for n, t in fields if n in wanted)

    def reader(self, schema: StructType) -> PlyReader:
        return PlyReader(self.options["path"], int(self.options.get("rows_per_partition", 250_000)), schema)


class PlyReader(DataSourceReader):
    def __init__(self, path: str, step: int, schema: StructType):
        self.path, self.step, self.kinds = path, step, {f.name: f.dataType.simpleString() for f in schema.fields}

    def partitions(self) -> list[Span]:
        n = header(self.path).rows
        return [Span(i, min(n, i + self.step)) for i in range(0, n, self.step)] or [Span(0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        head = header(self.path)
        kind = np.dtype([(n, TYPES[t][0]) for n, t in head.fields])
        with open(self.path, "rb") as f:
            f.seek(head.start + partition.first * kind.itemsize)
            rows = np.fromfile(f, kind, partition.last - partition.first)
        if len(rows) < partition.last - partition.first:
            raise ValueError(f"{self.path} ends before its last row")
        widths = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[n])).cast(widths[k]) for n, k in self.kinds.items()], names=list(self.kinds))
