"""Number functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grams of the weight units, litres of the volume units.
KILOS = {"kg": 1.0, "kilo": 1.0, "kilogramm": 1.0, "g": 0.001, "gr": 0.001, "gramm": 0.001, "l": 1.0, "lt": 1.0, "ltr": 1.0, "liter": 1.0, "ml": 0.001, "milliliter": 0.001}


def parse_decimal(c: Column) -> Column:
    """A number with comma or point; null for anything else, 'nan' and '5d' included."""
    s = F.replace(F.trim(c), F.lit(","), F.lit("."))
    return F.when(s.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), s).try_cast("double")


def confidence_percent(c: Column) -> Column:
    """Whole percent from 0 to 100 of a confidence on either scale (half to even); 0 for null and no number."""
    x = F.when(~F.isnan(c), c)
    whole = F.bround(F.when((x > 0) & (x <= 1), x * 100).otherwise(x)).cast("int")
    return F.when(x.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), whole)))


def key_number(c: Column) -> Column:
    """Four decimals as text, '' for null."""
    return F.when(c.isNull(), "").otherwise(F.format_string("%.4f", c))


def german_number(c: Column) -> Column:
    """At most two decimals, no closing zeros, decimal comma; null for null."""
    return F.when(c.isNotNull(), F.replace(F.regexp_replace(F.format_string("%.2f", c), r"\.?0+$", ""), F.lit("."), F.lit(",")))


def signed_percent(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%+.1f%%", c))


def compact(c: Column) -> Column:
    """With k from a thousand and M from a million on."""
    a = F.abs(c)
    return F.when(a >= 1e6, F.format_string("%.1fM", c / 1e6)).when(a >= 1e3, F.format_string("%.1fk", c / 1e3)).when(a.isNotNull(), F.format_string("%.0f", c))


def kilos(quantity: Column, unit: Column) -> Column:
    """Kilograms or litres of a quantity; null for other units."""
    table = F.create_map(*[F.lit(v) for kv in KILOS.items() for v in kv])
    return quantity * F.try_element_at(table, F.rtrim(F.lower(F.trim(unit)), F.lit(".")))


def package_grams(text: Column, own: Column) -> Column:
    """The largest weight in grams that a text states, or the package's own (in kilograms) if that is larger."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+(?:[.,]\d+)?)\s*(?:kg|g)\b"), F.lit(0))
    grams = lambda s: F.replace(F.regexp_extract(s, r"^[\d.,]+", 0), F.lit(","), F.lit(".")).cast("double") * F.when(s.endswith("kg"), 1000.0).otherwise(1.0)
    return F.greatest(F.array_max(F.transform(found, grams)), own * 1000)
