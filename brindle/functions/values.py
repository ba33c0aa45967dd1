"""Values of JSON, told apart by their type there: a boolean is no number, and a number in quotes is a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """A text as a variant; null if it is no JSON."""
    return F.try_parse_json(text)


def kind(value: Column) -> Column:
    """boolean, integer, number, string, null, object or array."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "BOOLEAN", "boolean")
        .when(name == "BIGINT", "integer")
        .when((name == "DOUBLE") | (name == "FLOAT") | F.startswith(name, F.lit("DECIMAL")), "number")
        .when(name == "STRING", "string")
        .when(name == "VOID", "null")
        .when(F.startswith(name, F.lit("OBJECT")), "object")
        .when(F.startswith(name, F.lit("ARRAY")), "array")
    )


def boolean(value: Column) -> Column:
    """true or false; 1 and 0 count as well. Null for everything else."""
    number = F.when(kind(value) == "integer", F.try_variant_get(value, "$", "bigint"))
    return F.when(kind(value) == "boolean", F.try_variant_get(value, "$", "boolean")).when(number.isin(0, 1), number == 1)


def integer(value: Column, least: int | None = None) -> Column:
    """A whole number; null for everything else, also for a boolean and for what is under `least`."""
    number = F.when(kind(value) == "integer", F.try_variant_get(value, "$", "bigint"))
    return number if least is None else F.when(number >= least, number)


def number(value: Column, least: float | None = None, above: float | None = None) -> Column:
    """A finite number; null for everything else, also for a boolean, and for what is under `least` or not over `above`."""
    found = F.when(kind(value).isin("integer", "number"), F.try_variant_get(value, "$", "double"))
    found = F.when(F.abs(found) < float("inf"), found)
    if least is not None:
        found = F.when(found >= least, found)
    return found if above is None else F.when(found > above, found)


def verdict_problem(value: Column, severities: tuple[str, ...] = ("low", "medium", "high")) -> Column:
    """What is wrong with a judgement, an object of exactly valid (boolean), artifact (list of texts) and severity; null if nothing is."""
    object_ = F.try_variant_get(value, "$", "map<string, variant>")
    at = lambda name: F.try_variant_get(value, f"$.{name}", "variant")
    texts = F.try_variant_get(value, "$.artifact", "array<variant>")
    return (
        F.when(~F.coalesce(kind(value) == "object", F.lit(False)), "object")
        .when(F.array_sort(F.map_keys(object_)) != F.array(*map(F.lit, ("artifact", "severity", "valid"))), "keys")
        .when(~F.coalesce(kind(at("valid")) == "boolean", F.lit(False)), "valid")
        .when(texts.isNull() | F.exists(texts, lambda x: ~F.coalesce(kind(x) == "string", F.lit(False))), "artifact")
        .when(~F.coalesce((kind(at("severity")) == "string") & F.try_variant_get(value, "$.severity", "string").isin(*severities), F.lit(False)), "severity")
    )


def first_of(**sources: Column) -> tuple[Column, Column]:
    """The first value that isn't null, and the name of where it came from."""
    return F.coalesce(*sources.values()), F.coalesce(*(F.when(v.isNotNull(), F.lit(k)) for k, v in sources.items()))


def total_seconds(total: Column, fit: Column, render: Column) -> Column:
    """The given total, or else the sum of its parts; null if it is negative or can't be known."""
    found = F.coalesce(total, fit + render)
    return F.when(found >= 0, found)
