"""Reports and exports. Reports are small by nature: a row for each scene or strategy."""

import json
import os
import struct
import tempfile
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A report beyond this is a mistake.
MOST_REPORT_ROWS = 100_000


def _rows(df: DataFrame) -> list:
    rows = df.limit(MOST_REPORT_ROWS + 1).collect()
    if len(rows) > MOST_REPORT_ROWS:
        raise ValueError("too many rows for a report; write a table")
    return rows


def general(x: Column, digits: int = 10, missing: str = "n/a") -> Column:
    """A number in the shortest of plain and exponent form with so many digits."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: missing if pd.isna(v) else f"{v:.{digits}g}")

    return run(x)


def markdown(df: DataFrame, digits: int = 4) -> str:
    """A Markdown table; numbers rounded, nulls as n/a, pipes and line breaks escaped."""
    show = lambda v: "n/a" if v is None else f"{v:.{digits}f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(show, r)) + " |" for r in _rows(df))]) + "\n"


def write_atomically(path: str, text: str) -> None:
    """Readers see the old file or the whole new one."""
    handle, name = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def report_json(df: DataFrame, path: str) -> None:
    write_atomically(path, json.dumps([r.asDict(recursive=True) for r in _rows(df)], indent=2, default=str) + "\n")


def csv_report(df: DataFrame, path: str) -> None:
    """One file with a fixed header and ten significant digits; nulls are n/a."""
    rows = [",".join(df.columns)]
    for r in _rows(df):
        rows.append(",".join("n/a" if v is None else f"{v:.10g}" if isinstance(v, float) else '"' + v.replace('"', '""') + '"' if isinstance(v, str) and any(c in v for c in ',"\n') else str(v) for v in r))
    write_atomically(path, "\n".join(rows) + "\n")


def append(df: DataFrame, path: str) -> None:
    """Entries of an append-only ledger; Spark's commit makes them appear all at once."""
    df.write.mode("append").json(path)


def colmap_text(cameras: DataFrame, images: DataFrame, folder: str) -> None:
    """cameras.txt and images.txt: a row for each frame."""
    os.makedirs(folder, exist_ok=True)
    write_atomically(f"{folder}/cameras.txt", "".join(f"{r.camera_id} PINHOLE {r.width} {r.height} {r.fx!r} {r.fy!r} {r.cx!r} {r.cy!r}\n" for r in _rows(cameras.orderBy("camera_id"))))
    write_atomically(f"{folder}/images.txt", "".join(f"{r.image_id} {r.qw!r} {r.qx!r} {r.qy!r} {r.qz!r} {r.tx!r} {r.ty!r} {r.tz!r} {r.camera_id} {r.name}\n\n" for r in _rows(images.orderBy("image_id"))))


def colmap_binary(cameras: DataFrame, images: DataFrame, folder: str) -> None:
    """cameras.bin and images.bin: a row for each frame; images have no observations."""
    os.makedirs(folder, exist_ok=True)
    rows = _rows(cameras.orderBy("camera_id"))
    _replace(f"{folder}/cameras.bin", [struct.pack("<Q", len(rows)), *(struct.pack("<iiQQdddd", r.camera_id, 1, r.width, r.height, r.fx, r.fy, r.cx, r.cy) for r in rows)])
    rows = _rows(images.orderBy("image_id"))
    _replace(f"{folder}/images.bin", [struct.pack("<Q", len(rows)), *(struct.pack("<idddddddi", r.image_id, r.qw, r.qx, r.qy, r.qz, r.tx, r.ty, r.tz, r.camera_id) + r.name.encode() + b"\0" + struct.pack("<Q", 0) for r in rows)])


def _replace(path: str, parts) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, name = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(handle, "wb") as f:
            f.writelines(parts)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def _point_parts(points: DataFrame, line) -> Iterator[bytes]:
    """Records made on the executors, in the order of point_id; the driver gets them as bytes, one partition at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"part": [b"".join(map(line, rows.itertuples(index=False)))]})

    partitions = max(1, points.rdd.getNumPartitions())
    made = points.repartitionByRange(partitions, "point_id").sortWithinPartitions("point_id").mapInPandas(run, "part binary")
    return (bytes(r["part"]) for r in made.toLocalIterator())


def colmap_points_text(points: DataFrame, path: str) -> None:
    """points3D.txt; readers see it whole or not at all."""
    _replace(path, _point_parts(points, lambda r: f"{r.point_id} {r.x!r} {r.y!r} {r.z!r} {r.red} {r.green} {r.blue} 0\n".encode()))


def colmap_points_binary(points: DataFrame, path: str) -> int:
    """points3D.bin. Returns the number of points."""
    n = points.count()
    _replace(path, chain([struct.pack("<Q", n)], _point_parts(points, lambda r: struct.pack("<QdddBBBdQ", r.point_id, r.x, r.y, r.z, r.red, r.green, r.blue, 0.0, 0))))
    return n


def ply_points(points: DataFrame, path: str) -> int:
    """points3D.ply: positions, empty normals and colours. Returns the number of points."""
    n = points.count()
    head = "ply\nformat binary_little_endian 1.0\n" + f"element vertex {n}\n" + "".join(f"property float {c}\n" for c in ("x", "y", "z", "nx", "ny", "nz")) + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue")) + "end_header\n"
    _replace(path, chain([head.encode()], _point_parts(points, lambda r: struct.pack("<6f3B", r.x, r.y, r.z, 0.0, 0.0, 0.0, r.red, r.green, r.blue))))
    return n


def rebased(value, old: str, new: str):
    """A document with every text that is a path at or under `old` moved to `new`; at any depth."""
    if isinstance(value, dict):
        return {k: rebased(v, old, new) for k, v in value.items()}
    if isinstance(value, list):
        return [rebased(v, old, new) for v in value]
    return new + value[len(old) :] if isinstance(value, str) and (value == old or value.startswith(old + "/")) else value
