"""Files: each query writes small ones into the shared folder and reads them back."""

import struct
import zlib

from pyspark.sql import functions as F

from ..operators.spatial import XYZ
from ..session import table
from ..sources import documents, jsonl, ply, writers
from . import query
from .ledgers import _folder

ENTRY = "event_id long, user_id long, event_type string, value double"


def _events(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "event_type", "value")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def ledger_file(spark, sf):
    """Events appended to a ledger of JSON lines, and read strictly."""
    folder = f"{_folder(spark)}/ledger"
    writers.append(_events(spark, sf), folder)
    return jsonl.read(spark, folder, ENTRY).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_type, count(*) AS n, round(sum(value + 1), 4) AS total FROM events WHERE event_type <> 'error' GROUP BY 1")
def ledger_file_lenient(spark, sf):
    """A ledger in which every event stands twice, both times in one file; the last entry counts, and unknown types are skipped."""
    folder, rows = f"{_folder(spark)}/ledger", _events(spark, sf)
    twice = rows.withColumn("k", F.lit(0)).union(rows.withColumn("value", F.col("value") + 1).withColumn("k", F.lit(1)))
    writers.append(twice.repartition("event_id").sortWithinPartitions("k", "event_id").drop("k"), folder)
    found = jsonl.read_lenient(spark, folder, ENTRY, ["event_id"], F.col("event_type") != "error")
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT 'bad json' AS problem, 1 AS n UNION ALL SELECT 'blank', 1 UNION ALL SELECT 'duplicate key', 2 UNION ALL SELECT 'torn tail', 1 UNION ALL SELECT 'unknown event_type', 1")
def ledger_file_problems(spark, sf):
    """What strict reading objects to in a ledger with one fault of each kind."""
    folder = _folder(spark)
    entry = '{"event_id": %d, "user_id": 1, "event_type": "%s", "value": 1.0}'
    lines = [entry % (1, "view"), entry % (1, "click"), entry % (2, "odd"), "", "no json", entry % (3, "view"), '{"event_id": 4, "us']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.option("lineSep", " ").text(f"{folder}/ledger")
    found = jsonl.problems(spark, f"{folder}/ledger", ENTRY, ["event_id"], {"event_type": ["view", "click"]})
    return found.groupBy("problem").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("SELECT count(*) AS n, round(avg(embedding[1]::FLOAT), 5) AS x, round(avg(embedding[2]::FLOAT), 5) AS y, round(avg(embedding[3]::FLOAT), 5) AS z, sum(vec_id % 256)::BIGINT AS red FROM embeddings")
def point_file(spark, sf):
    """A PLY table of points, written and read in parts. The path must be one that all executors see."""
    path = f"{_folder(spark).removeprefix('file:')}/points.ply"
    at = lambda i: F.get("embedding", F.lit(i)).cast("float").cast("double")
    points = table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("point_id"), *(at(i).alias(c) for i, c in enumerate(XYZ)), (F.col("vec_id") % 256).cast("int").alias("red"), F.lit(0).alias("green"), F.lit(0).alias("blue"))
    writers.ply_points(points, path)
    spark.dataSource.register(ply.PlySource)
    found = spark.read.format("ply").option("path", path).option("rows_per_partition", 100).option("required", "x,y,z").option("fields", "x,y,z,red").load()
    return found.agg(F.count(F.lit(1)).alias("n"), *(F.round(F.avg(c), 5).alias(c) for c in XYZ), F.sum("red").alias("red"))


def _png(width: int, height: int, kind: int) -> bytes:
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", b"") + chunk(b"IEND", b"")


@query("SELECT * FROM (VALUES (1, true, 320, 180, 'RGB'), (2, true, 70000, 2, 'RGBA'), (3, false, NULL, NULL, NULL), (4, false, NULL, NULL, NULL)) t(image, is_png, width, height, mode)")
def image_headers(spark, sf):
    """Sizes and modes of images from their first bytes; two of them are none."""
    rows = [(1, _png(320, 180, 2)), (2, _png(70000, 2, 6)), (3, b"GIF89a" + bytes(40)), (4, _png(1, 1, 2)[:20])]
    images = spark.createDataFrame([(i, bytearray(x)) for i, x in rows], "image int, content binary")
    return documents.png_headers(images).select("image", "is_png", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), "mode")


@query("SELECT c_name AS scene, place::INT AS place FROM (SELECT c_name, row_number() OVER (ORDER BY c_name) AS place FROM (SELECT DISTINCT c_name FROM customer)) WHERE place BETWEEN 11 AND 30")
def scene_range(spark, sf):
    """Twenty scenes of a sorted listing."""
    return documents.scene_slice(table(spark, sf, "customer").select(F.col("c_name").alias("scene")), "scene", 11, 30)


@query("""SELECT s_nationkey AS folder, CASE WHEN bool_or(s_suppkey % 3 = 0) THEN 'cameras.json' WHEN bool_or(s_suppkey % 3 = 1) THEN 'camera.json' END AS name FROM supplier WHERE s_suppkey % 3 < 2 GROUP BY 1""")
def preferred_files(spark, sf):
    """Suppliers of a nation stand for the files of a folder."""
    name = F.when(F.col("s_suppkey") % 3 == 0, "cameras.json").when(F.col("s_suppkey") % 3 == 1, "camera.json").otherwise("other")
    listing = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("folder"), name.alias("name"), F.col("s_suppkey").cast("string").alias("path"))
    return documents.preferred_file(listing, ["cameras.json", "camera.json"]).select("folder", "name")
