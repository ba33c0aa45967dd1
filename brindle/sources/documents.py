"""Nested documents, camera files and directory layouts."""

import ast
import json
import os
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, name, folder, size and time of the files below a root, without reading them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")
    return found.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"), F.col("length").alias("size"), F.col("modificationTime").alias("time"))


def complete_folders(listing: DataFrame, needed: list[str]) -> DataFrame:
    """Folders that hold all the names."""
    return listing.where(F.col("name").isin(needed)).groupBy("folder").agg(F.count_distinct("name").alias("n")).where(F.col("n") == len(set(needed))).select("folder")


def newest(listing: DataFrame, preferred: str | None = None) -> DataFrame:
    """One folder: the preferred one if it is there, else the one with the latest file."""
    by = listing.groupBy("folder").agg(F.max("time").alias("time"))
    return by.orderBy((F.col("folder") == (preferred or "")).desc(), F.desc("time"), "folder").limit(1)


def latest_iteration(listing: DataFrame) -> DataFrame:
    """The file with the largest number in a folder named iteration_<n>."""
    number = F.regexp_extract("path", r"iteration_(\d+)(?:/|$)", 1)
    return listing.where(number != "").orderBy(number.cast("bigint").desc(), "path").limit(1)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One whole JSON object for each file, with its path. A file that isn't one is an error when it is read."""
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    good = F.from_json("value", schema, {"mode": "FAILFAST"})
    return raw.select("path", good.alias("doc")).select("path", "doc.*")


def cameras(spark: SparkSession, path: str) -> DataFrame:
    """Cameras from a list, an object with `cameras`, or a single one, in the flat or the nested dialect: id, name, width, height, position, rotation (camera to world, row by row), fx, fy, cx, cy."""
    raw = spark.read.option("wholetext", "true").text(path).select(F.parse_json("value").alias("v"))
    one = "struct<id:variant,img_name:string,width:int,height:int,position:array<double>,rotation:array<array<double>>,fx:double,fy:double,cx:double,cy:double,image_relative_path:string,camera:struct<position:array<double>,camera_to_world:array<array<double>>>,intrinsics:struct<width:int,height:int,fx:double,fy:double,cx:double,cy:double>>"
    many = F.coalesce(F.try_variant_get("v", "$.cameras", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    rows = raw.select(F.posexplode(many).alias("source_index", "item")).select("source_index", F.from_json(F.to_json("item"), one.replace("id:variant", "id:string")).alias("c"))
    pick = lambda a, b: F.coalesce(F.col(f"c.{a}"), F.col(f"c.{b}"))
    turn = F.coalesce(F.col("c.rotation"), F.transform(F.slice("c.camera.camera_to_world", 1, 3), lambda r: F.slice(r, 1, 3)))
    rows = rows.select("source_index", F.coalesce("c.id", F.col("source_index").cast("string")).alias("id"), pick("img_name", "image_relative_path").alias("name"), *[pick(x, f"intrinsics.{x}").alias(x) for x in ("width", "height", "fx", "fy", "cx", "cy")], pick("position", "camera.position").alias("position"), turn.alias("rotation"))
    return rows.withColumn("cx", F.coalesce("cx", F.col("width") / 2)).withColumn("cy", F.coalesce("cy", F.col("height") / 2))


def merged_config(fragments: dict[str, dict], allowed: dict[str, set[str]], required: dict[str, set[str]] | None = None) -> dict:
    """Fragments of one configuration, each with the keys it may and must hold; no key may come twice."""
    out: dict = {}
    for name, part in fragments.items():
        if extra := set(part) - allowed[name]:
            raise ValueError(f"{name}: unknown {sorted(extra)}")
        if lacking := (required or {}).get(name, set()) - set(part):
            raise ValueError(f"{name}: missing {sorted(lacking)}")
        if twice := set(part) & set(out):
            raise ValueError(f"{name}: {sorted(twice)} again")
        out |= part
    return out


def literal_flag(text: str, name: str, default: bool = False) -> bool:
    """A boolean argument in the printed form of a namespace, Namespace(a=1, b=True)."""
    try:
        call = ast.parse(text.strip(), mode="eval").body
        found = {k.arg: ast.literal_eval(k.value) for k in getattr(call, "keywords", [])}
    except (SyntaxError, ValueError):
        return default
    return found.get(name, default) is True


def repair_tail(path: str, block: int = 1 << 16) -> int:
    """Cuts an unfinished last line off a local ledger, or ends a finished one; returns the bytes cut. The ledger is read line by line, and only its last line is held. A blank or broken line elsewhere is an error."""
    with open(path, "rb+") as f:
        start = 0
        tail = b""
        for i, line in enumerate(iter(f.readline, b"")):
            if not line.endswith(b"\n"):
                tail = line
                break
            if not line.strip():
                raise ValueError(f"line {i} of {path} is blank")
            json.loads(line)
            start += len(line)
        if not tail:
            return 0
        try:
            whole = isinstance(json.loads(tail), dict)
        except ValueError:
            whole = False
        f.seek(start + len(tail) if whole else start)
        if whole:
            f.write(b"\n")
            return 0
        f.truncate()
        f.flush()
        os.fsync(f.fileno())
        return len(tail)


def object_of(text: str, name: str) -> dict:
    """A JSON object; what is wrong with a text that is none, and where."""
    try:
        found = json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError(f"{name}: line {e.lineno}, column {e.colno}: {e.msg}") from None
    if not isinstance(found, dict):
        raise ValueError(f"{name} is no object")
    return found


def yaml_object(text: str, name: str) -> dict:
    """A YAML mapping; needs PyYAML."""
    import yaml

    try:
        found = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ValueError(f"{name}: {e}") from None
    if not isinstance(found, dict):
        raise ValueError(f"{name} is no mapping")
    return found


def finished(listing: DataFrame, ledger: str, marker: str) -> DataFrame:
    """Paths of ledgers whose folder also holds the marker that is written at the end; others aren't to be read yet."""
    done = complete_folders(listing, [ledger, marker])
    return listing.where(F.col("name") == ledger).join(done, "folder", "left_semi").select("folder", "path")


def preferred_file(listing: DataFrame, names: list[str]) -> DataFrame:
    """Of each folder the file with the first of the names that it has."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col("name"))
    return listing.where(place > 0).groupBy("folder").agg(F.min_by("path", place).alias("path"), F.min_by("name", place).alias("name"))


def png_headers(images: DataFrame, content: str = "content") -> DataFrame:
    """Adds `is_png`, `width`, `height` and `mode` (RGB, RGBA, L, LA or P, by the colour type) of images as bytes, from their first 26 bytes. Whether the rest can be decoded isn't looked at."""
    head = F.hex(F.substring(F.col(content), 1, 26))
    number = lambda at: F.conv(F.substring(head, 2 * at + 1, 8), 16, 10).cast("long")
    kinds = F.create_map(*(F.lit(x) for pair in (("02", "RGB"), ("06", "RGBA"), ("00", "L"), ("04", "LA"), ("03", "P")) for x in pair))
    ok = F.startswith(head, F.lit("89504E470D0A1A0A0000000D49484452")) & (F.length(head) == 52)
    return images.select("*", ok.alias("is_png"), F.when(ok, number(16)).alias("width"), F.when(ok, number(20)).alias("height"), F.when(ok, kinds[F.substring(head, 51, 2)]).alias("mode"))


def scene_slice(listing: DataFrame, name: str, first: int, last: int) -> DataFrame:
    """The scenes from place `first` to `last` (from 1, both included) in the order of names; fewer than that many is an error when the rows are read."""
    from pyspark.sql import Window

    rows = listing.select(name).distinct().orderBy(name).limit(last).withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(name)))
    rows = rows.where(F.col("place") >= first).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    return rows.select(F.when(F.col("n") == last - first + 1, F.col(name)).otherwise(F.raise_error(F.lit("the range holds too few scenes"))).alias(name), "place")


_object = re.compile(r"\{")


def last_object(text: str | None) -> str | None:
    """The last JSON object inside a free text, as it stands there."""
    found = None
    at, decoder = 0, json.JSONDecoder()
    while text and (m := _object.search(text, at)):
        try:
            value, end = decoder.raw_decode(text, m.start())
        except ValueError:
            at = m.start() + 1
            continue
        found, at = (text[m.start() : end] if isinstance(value, dict) else found), end
    return found


def embedded_objects(column: Column) -> Column:
    """`last_object` over a column, in Arrow batches."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(last_object)

    return run(column)
