"""Normal forms of suppliers and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four suppliers.
SUPPLIERS = ("metro", "edeka", "selgros", "handelshof")


def squeeze(c: Column) -> Column:
    """Lower case, one blank for any run of white space, none outside."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)[\s\u200b\ufeff]+", " "))


def supplier_key(c: Column) -> Column:
    """The supplier a spelling such as 'Metro C+C' means; any other text in its squeezed form."""
    s = squeeze(c)
    hit = F.regexp_extract(s, rf"^({'|'.join(SUPPLIERS)})(?![a-zäöüß])", 1)
    return F.when(hit != "", hit).otherwise(s)
