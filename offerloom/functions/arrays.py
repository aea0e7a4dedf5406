"""Array and JSON functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import german_number, key_number

TIERS = "array<struct<min_qty:double,price:double>>"


def tier_key(tiers: Column) -> Column:
    """A price scale as text that is equal for equal scales: steps with four decimals, sorted; '' for none."""
    steps = F.array_sort(F.transform(tiers, lambda t: F.concat(key_number(t["min_qty"]), F.lit(":"), key_number(t["price"]))))
    return F.coalesce(F.array_join(steps, ";"), F.lit(""))


def tier_label(tiers: Column) -> Column:
    """'ab 3: 26,87 EUR; ...' in the order given, 'unknown' for none."""
    text = F.array_join(F.transform(tiers, lambda t: F.concat(F.lit("ab "), german_number(t["min_qty"]), F.lit(": "), german_number(t["price"]), F.lit(" EUR"))), "; ")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))


def parse_tiers(text: Column) -> Column:
    return F.from_json(text, TIERS)


def second_or_first(tiers: Column) -> Column:
    """The second step of a scale of three or more, else the first."""
    return F.get(tiers, F.when(F.size(tiers) >= 3, 1).otherwise(0))


def embedded_json(text: Column, schema: str) -> Column:
    """The JSON object inside a text (fenced or between other words) as schema says; null if it can't be read."""
    return F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), schema)


def distinct_by(values: Column, key) -> Column:
    """Values in order without those whose key an earlier one has."""
    keyed = F.transform(values, lambda v: F.struct(key(v).alias("k"), v.alias("v")))
    kept = F.filter(keyed, lambda x, i: F.array_position(F.transform(keyed, lambda y: y["k"]), x["k"]) == i + 1)
    return F.transform(kept, lambda x: x["v"])


def defaulted(item: Column, defaults: dict[str, Column], allowed: dict[str, list[str]]) -> Column:
    """A struct's fields with defaults for nulls, and for values that are not among those allowed."""
    def one(name: str, default: Column) -> Column:
        value = item[name]
        return F.coalesce(F.when(value.isin(*allowed[name]), value) if name in allowed else value, default).alias(name)

    return F.struct(*[one(n, d) for n, d in defaults.items()])
