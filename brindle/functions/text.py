"""Expressions on names, paths and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(name: Column) -> Column:
    """A sort key under which runs of digits compare as numbers and everything else as lower-case text. Digits sort before letters."""
    parts = F.regexp_extract_all(F.lower(name), F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    number = lambda p: p.rlike("^[0-9]+$")
    return F.transform(parts, lambda p: F.struct(F.when(number(p), 0).otherwise(1).alias("kind"), F.when(number(p), p.cast("decimal(38,0)")).alias("number"), F.when(~number(p), p).alias("text")))


def slug(label: Column) -> Column:
    """Characters that aren't safe in file names become underscores; dots and underscores at the ends go."""
    return F.regexp_replace(F.regexp_replace(label, "[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")


def rebase(path: Column, old: str, new: str) -> Column:
    """A path at or under `old` moves to `new`; others stay."""
    return F.when(path == old, F.lit(new)).when(F.startswith(path, F.lit(old + "/")), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def is_safe_relative(path: Column) -> Column:
    """Does a relative path stay inside its root? Every step down is counted against the steps up before it."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    depth = F.aggregate(parts, F.lit(0), lambda d, p: F.when(d < 0, d).when(p == "..", d - 1).otherwise(d + 1))
    return path.isNotNull() & ~F.startswith(path, F.lit("/")) & (depth >= 0) & (F.size(parts) > 0)


def cell(text: Column) -> Column:
    """A text as a cell of a Markdown table."""
    return F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), r"\r?\n", " ")


def json_string(text: Column) -> Column:
    """A text as a string in JSON, with no more escapes than it needs."""
    short = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code in range(32):
        out = F.replace(out, F.lit(chr(code)), F.lit("\\" + short[code] if code in short else f"\\u{code:04x}"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def seed64(base: Column, *names: Column) -> Column:
    """The first eight bytes of the SHA-256 of the JSON list [base, name, ...], as a non-negative decimal. base is a whole number. Different lists have different texts, whatever the names hold."""
    payload = F.concat(F.lit("["), F.concat_ws(", ", base.cast("string"), *map(json_string, names)), F.lit("]"))
    return F.conv(F.substring(F.sha2(payload, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def label(prefix: str, number: Column, width: int) -> Column:
    """A number with zeros before it, up to a width; longer numbers stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
