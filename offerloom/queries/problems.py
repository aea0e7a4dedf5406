"""Queries of the general training-data problems: units (p1) and intervals (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import squeeze, supplier_key
from ..operators.intervals import periods_and_gaps
from ..operators.units import MEASURES, PIECES, UNIT_PATTERN, common_units, unit_reading
from ..sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ord", "product_name", "description", "unit", "quantity", "price", "price_per_kg", "supplier", "source_title", "extracted_at"]
    return common_units(table(spark, folder, "offers", *columns))


def p1_units(spark: SparkSession, folder: str) -> DataFrame:
    """What each unit spelling is read as: the part of problem 1 that SQL can state."""
    o = table(spark, folder, "offers", "unit")
    return o.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).select("unit", unit_reading(F.col("unit")).alias("r"), "n").select("unit", "r.base", "r.factor", "n")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    offers = table(spark, folder, "offers", "supplier", "source_title", "valid_from", "valid_to")
    return periods_and_gaps(offers.withColumns({"supplier": supplier_key(offers.supplier), "source_title": squeeze(offers.source_title)}), ["supplier", "source_title"], "valid_from", "valid_to")


QUERIES = {"p1_found": p1_found, "p1_units": p1_units, "p5_found": p5_found}

_BASES, _FACTORS = {k: v[0] for k, v in MEASURES.items()}, {k: float(v[1]) for k, v in MEASURES.items()}

SQL = {
    "p1_units": f"""
WITH u AS (SELECT unit, n, regexp_extract(t, '{UNIT_PATTERN}', 2) AS name, TRY_CAST(nullif(regexp_extract(t, '{UNIT_PATTERN}', 1), '') AS DOUBLE) AS count, rtrim(t, '.') IN {PIECES} AS piece
  FROM (SELECT unit, trim(regexp_replace(lower(unit), '\\s+', ' ', 'g')) AS t, count(*) AS n FROM offers GROUP BY 1)),
r AS (SELECT unit, n, count, map({list(_BASES)}, {list(_BASES.values())})[name] AS base, map({list(_FACTORS)}, {list(_FACTORS.values())}::DOUBLE[])[name] AS factor, piece FROM u)
SELECT unit, coalesce(base, CASE WHEN piece THEN 'stueck' END) AS base, CASE WHEN base IS NOT NULL OR piece THEN coalesce(count, 1) * coalesce(factor, 1) END AS factor, n FROM r""",
    "p5_found": r"""
WITH o AS (
  SELECT DISTINCT regexp_extract(lower(trim(supplier)), '^(metro|edeka|selgros|handelshof)') AS supplier,
         trim(regexp_replace(lower(source_title), '\s+', ' ', 'g')) AS source_title, valid_from AS s, valid_to AS e
  FROM offers WHERE valid_from <= valid_to),
m AS (SELECT *, max(e) OVER (PARTITION BY supplier, source_title ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM o),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY supplier, source_title ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m),
p AS (SELECT supplier, source_title, min(s) AS s, max(e) AS e FROM g GROUP BY supplier, source_title, run),
q AS (SELECT *, lag(e) OVER (PARTITION BY supplier, source_title ORDER BY s) AS last FROM p)
SELECT supplier, source_title, 'period' AS kind, strftime(s, '%Y-%m-%d') AS start_date, strftime(e, '%Y-%m-%d') AS end_date FROM q
UNION ALL
SELECT supplier, source_title, 'gap', strftime(last + 1, '%Y-%m-%d'), strftime(s - 1, '%Y-%m-%d') FROM q WHERE last IS NOT NULL
""",
}
