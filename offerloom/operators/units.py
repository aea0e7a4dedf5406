"""Quantities in common units: what a price pays for, in grams, millilitres or pieces, and the price per kilo, litre
or piece, with values on a wrong scale found by changepoint search on each source's history.

Text is read by column expressions. Each row then has up to two log values: how its quantity compares with the content
its text states (or, without one, with the unit price it states), and how its price for the amount compares with that
unit price. The history of a source is segmented on these values (operators.changepoints), and the segments decide: one
whose level matches a known factor marks values on another scale, which are reversed. A row without such a value of its
own is reversed too where it lies within a segment that SUPPORT values stand for and is of their size; between two
segments it stays as printed.

Skew: a source's history of more than BLOCK rows is cut into slices of equal time, about BLOCK rows each, so that no
source falls to one task. Neighbouring slices overlap by OVERLAP of their length: the rows there are context on one side
and reported on the other, so a segment that a cut divides is seen from both. A slice that is still longer (many rows at
one time) streams through its task in blocks, each with CONTEXT rows before and behind it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import squeeze, supplier_key
from .changepoints import segments

BLOCK, OVERLAP, CONTEXT = 4096, 1 / 16, 64
#: A change must explain this much squared log deviation. Contents agree exactly, stated prices are rounded: a lone
#: value more than a factor 1.15 (content) or 1.37 (price) off is a segment of its own.
CONTENT_PENALTY, PRICE_PENALTY = 0.01, 0.05
#: Values that must stand for a segment before it decides on rows without one.
SUPPORT = 5
#: A level is a factor if it is this near to it (log).
NEAR = 0.05

# Units of weight and volume (base unit, amount in it), pieces, and stated prices that only fill the field.
MEASURES = {
    "g": ("g", 1), "gr": ("g", 1), "gramm": ("g", 1), "mg": ("g", 0.001),
    "dag": ("g", 10), "dkg": ("g", 10), "deka": ("g", 10),
    "pfund": ("g", 500), "pfd": ("g", 500),
    "kg": ("g", 1000), "kilo": ("g", 1000), "kilogramm": ("g", 1000), "t": ("g", 1_000_000), "tonne": ("g", 1_000_000),
    "ml": ("ml", 1), "milliliter": ("ml", 1), "cl": ("ml", 10), "zentiliter": ("ml", 10), "dl": ("ml", 100), "deziliter": ("ml", 100),
    "l": ("ml", 1000), "lt": ("ml", 1000), "ltr": ("ml", 1000), "liter": ("ml", 1000), "hl": ("ml", 100_000), "hektoliter": ("ml", 100_000),
}
PIECES = ("st", "stk", "stck", "stück", "stueck", "piece", "bd", "bund", "bündel")
FILL_INS = (9999.0, 99999.99)

_IN_TEXT = "kilogramm|kilo|kg|gramm|gr|g|milliliter|ml|zentiliter|cl|deziliter|dl|liter|ltr|lt|l|pfund|pfd|dkg|dag|deka"
_NUMBER = r"\d+(?:[.,]\d+)*"
_COUNT = r"(?:stück|stueck|stck|stk|st)\b\.?"
_TIMES = rf"(?:[x×*]|er[ -]?pack(?:ung)?\s*(?:je|à|a|zu)?|{_COUNT}\s*(?:à|a|je|zu)\b)\s*(?:ca\.?\s*)?"
#: A content by weight or volume, with or without multiplier; not the end of a range such as 180-220 g or 300/400 g.
CONTENT = rf"(?U)(?<![\p{{L}}\d.,/%-])(?:\d{{1,4}}\s*{_TIMES})?{_NUMBER}\s*-?\s*(?:{_IN_TEXT})(?![\p{{L}}\d])"
#: A content by count.
PIECE_COUNT = rf"(?U)(?<![\p{{L}}\d.,/%-])(\d{{1,4}})(?:\s*{_COUNT}|er\b)"


_UNIT = re.compile(rf"(?:(?:je|per|pro|/)\s*)?(\d+)?\s*({'|'.join(sorted(MEASURES, key=len, reverse=True))})\.?")
_MATCH = re.compile(rf"(?:(\d+)\s*(?:[x×*]|er|st).*?)?({_NUMBER})\s*-?\s*({_IN_TEXT})", re.DOTALL)


def read_unit(text: str | None) -> tuple[str | None, float]:
    """Base unit and the amount in it of one unit of weight or volume, 'je 100g' included; 'stueck' for pieces; else None."""
    u = " ".join((text or "").lower().split())
    if m := _UNIT.fullmatch(u):
        base, factor = MEASURES[m[2]]
        return base, float(m[1] or 1) * factor
    return ("stueck" if u.rstrip(".") in PIECES else None), 1.0


#: A unit of weight or volume as read_unit takes it, for expressions: count and name.
UNIT_PATTERN = rf"^(?:(?:je|per|pro|/)\s*)?(\d+)?\s*({'|'.join(sorted(MEASURES, key=len, reverse=True))})\.?$"


def unit_reading(unit: Column) -> Column:
    """struct(base, factor) of a unit as an expression: what read_unit says of it; nulls for containers and null."""
    u = squeeze(unit)
    table = lambda i: F.create_map(*[x for k, v in MEASURES.items() for x in (F.lit(k), F.lit(float(v[1]) if i else v[0]))])
    name, count = F.regexp_extract(u, UNIT_PATTERN, 2), F.regexp_extract(u, UNIT_PATTERN, 1).try_cast("double")
    piece = F.rtrim(u, F.lit(".")).isin(*PIECES)
    base = F.coalesce(F.try_element_at(table(0), name), F.when(piece, "stueck"))
    return F.struct(base.alias("base"), F.when(base.isNotNull(), F.coalesce(count, F.lit(1.0)) * F.coalesce(F.try_element_at(table(1), name), F.lit(1.0))).alias("factor"))


def read_number(text: str, grouped: bool) -> float:
    """A printed number: comma is decimal; where grouped, a point before three digits groups thousands."""
    if grouped and re.fullmatch(r"[1-9]\d{0,2}(?:\.\d{3})+", text):
        return float(text.replace(".", ""))
    whole, _, part = text.replace(",", ".").rpartition(".")
    return float(f"{whole.replace('.', '')}.{part}") if whole else float(part)


def read_content(text: str | None) -> tuple[str | None, float]:
    """Base unit and amount of a text that CONTENT found, multipliers included; None for no text."""
    m = _MATCH.fullmatch(text or "")
    if not m:
        return None, 0.0
    base, factor = MEASURES[m[3]]
    return base, float(m[1] or 1) * factor * read_number(m[2], factor == 1)


def found_texts(df: DataFrame, row: str) -> DataFrame:
    """Row id, source, time and numbers of each row with a positive price, and what its text states: content, or count."""
    text = F.lower(F.concat_ws("\n", "product_name", "description"))
    quantity = F.when(F.col("quantity").isNull() | F.isnan("quantity"), 1.0).otherwise(F.col("quantity"))
    measured = F.coalesce(F.col("unit").rlike(rf"(?i)^\s*(?:(?:je|per|pro|/)\s*)?\d*\s*(?:{'|'.join(MEASURES)})\.?\s*$"), F.lit(False))
    content = F.nullif(F.regexp_extract(text, CONTENT, 0), F.lit(""))
    source = F.xxhash64(supplier_key(F.col("supplier")), squeeze(F.col("source_title")))
    rows = df.select(
        F.col(f"`{row}`").alias("row"), source.alias("source"), F.col("extracted_at").alias("at"), F.col("unit"), quantity.alias("quantity"),
        "price", F.col("price_per_kg").alias("stated"), content.alias("content"), F.when(~measured, text).alias("text"),
    ).where("quantity > 0 and price > 0 and price < 1e12 and quantity < 1e12")
    count = F.when(F.col("content").isNull(), F.regexp_extract("text", PIECE_COUNT, 1).try_cast("double"))
    return rows.withColumn("count", count).drop("text")


def sliced(df: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with their slice of the source's history; rows near its ends once more as context (own = false).

    The sources' sizes and spans come from a scan of df's own columns; they are one row a source. Rows without a time come
    first.
    """
    at = F.unix_micros(F.col("at").cast("timestamp"))
    source = F.xxhash64(supplier_key(F.col("supplier")), squeeze(F.col("source_title"))).alias("source")
    when = df.select(source, F.unix_micros(F.col("extracted_at").cast("timestamp")).alias("us"))
    spans = when.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("low"), F.max("us").alias("high")).where(F.col("n") > BLOCK)
    joined = rows.join(spans, "source", "left")
    slices = F.ceil(F.col("n") / BLOCK)
    place = (F.coalesce(at, F.col("low")) - F.col("low")) / F.greatest(F.col("high") - F.col("low"), F.lit(1)) * slices
    here = F.coalesce(F.least(F.floor(place), slices - 1), F.lit(0))
    inside = place - here
    as_slice = lambda at, own: F.struct(at.cast("bigint").alias("slice"), F.lit(own).alias("own"))
    before, behind = F.when((inside < OVERLAP) & (here > 0), F.array(as_slice(here - 1, False))), F.when((inside > 1 - OVERLAP) & (here < slices - 1), F.array(as_slice(here + 1, False)))
    none = F.array().cast("array<struct<slice:bigint,own:boolean>>")
    every = F.inline(F.concat(F.array(as_slice(here, True)), F.coalesce(before, none), F.coalesce(behind, none)))
    return joined.select(*rows.columns, every)


def _by_value(column: pd.Series, read) -> tuple[np.ndarray, np.ndarray]:
    """read() of each value, once for each distinct one: base units and amounts."""
    codes, values = pd.factorize(column, use_na_sentinel=False)
    parts = [read(None if pd.isna(v) else v) for v in values]
    return np.array([p[0] for p in parts], dtype=object)[codes], np.array([p[1] for p in parts], dtype=float)[codes]


def read_amounts(rows: pd.DataFrame) -> pd.DataFrame:
    """found_texts rows whose amount can be told, with base, amount as printed, and the log values of their history."""
    base, factor = _by_value(rows["unit"], read_unit)
    kind, content = _by_value(rows["content"], read_content)
    count, quantity = np.nan_to_num(rows["count"].to_numpy(float)), rows["quantity"].to_numpy(float)
    measured = (base == "g") | (base == "ml")
    weighed = ~measured & (content > 0)
    times = np.select([measured, weighed, count > 0], [factor, content, count], 1.0)
    out = rows[["row", "source", "slice", "own", "price"]].assign(base=np.where(weighed, kind, np.where(count > 0, np.where(measured, base, "stueck"), base)), amount=quantity * times)
    stated = rows["stated"].to_numpy(float)
    stated = np.where((stated > 0) & ~np.isin(stated, FILL_INS), stated, np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        out["measured"] = measured
        out["content_log"] = np.where(measured & (kind == base) & (content > 0), np.log(out["amount"] / content), np.nan)
        out["price_log"] = np.log(out["price"] / out["amount"] * np.where(out["base"] == "stueck", 1.0, 1000.0) / stated)
    return out[out["base"].notna() & (out["amount"] < 1e12)].reset_index(drop=True)


# Factors between scales. Quantities in grams under a kilo unit; stated prices per pound, per 100 g or in
# cents; prices in cents, against each of those.
QUANTITY_FACTORS = np.log([1.0, 1000.0])
PRICE_FACTORS = np.log([0.001, 0.01, 0.02, 0.1, 1.0, 2.0, 10.0, 100.0, 200.0, 1000.0])
PRICE_IS_CENTS = np.array([False, False, False, False, False, False, False, True, True, True])


def _histories(rows: pd.DataFrame) -> list[tuple[int, int]]:
    source, part = rows["source"].to_numpy(), rows["slice"].to_numpy()
    edges = np.flatnonzero((source[1:] != source[:-1]) | (part[1:] != part[:-1])) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(rows)], strict=True))


def _levels(x: np.ndarray, blocks: list[tuple[int, int]], penalty: float, size: np.ndarray, factor: float) -> np.ndarray:
    """Segment levels by history. A row without a value takes the level of the segment around it if enough values stand
    for that and its size (log of what would be reversed) is nearer to theirs than to theirs less factor; else nan."""
    out, there = np.full(len(x), np.nan), ~np.isnan(x)
    for a, b in blocks:
        at = a + np.flatnonzero(there[a:b])
        start = 0
        for end in segments(x[at], penalty):
            level = x[at[start:end]].mean()
            out[at[start:end]] = level
            if end - start >= SUPPORT:
                span = slice(at[start], at[end - 1] + 1)
                out[span] = np.where(there[span] | (size[span] > np.median(size[at[start:end]]) - factor / 2), level, np.nan)
            start = end
    return out


def reverse_scales(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows in the order of their sources' histories, with amounts and prices on their true scales; context falls out."""
    if not len(rows):
        return pd.DataFrame({"row": rows["row"], "base_unit": rows["base"], "base_amount": np.zeros(0, np.int64), "cent_per_unit": np.zeros(0, np.int64)})
    blocks = _histories(rows)
    content, price = rows["content_log"].to_numpy(float), rows["price_log"].to_numpy(float)
    amount, money = rows["amount"].to_numpy(float).copy(), rows["price"].to_numpy(float)
    # A row that states no content still shows its scale where its price per unit agrees with its amount.
    shown = np.where(np.abs(price + QUANTITY_FACTORS[1]) < NEAR, QUANTITY_FACTORS[1], np.where(np.isnan(price), np.nan, 0.0))
    level = np.nan_to_num(_levels(np.where(np.isnan(content), shown, content), blocks, CONTENT_PENALTY, np.log(amount), QUANTITY_FACTORS[1]))
    small = rows["measured"].to_numpy(bool) & (np.abs(level - QUANTITY_FACTORS[1]) < NEAR)
    amount[small] /= 1000
    price = np.where(small, price + QUANTITY_FACTORS[1], price)
    level = np.nan_to_num(_levels(price, blocks, PRICE_PENALTY, np.log(money), np.log(100.0)))
    # Prices in cents are whole numbers.
    cents = PRICE_IS_CENTS[np.abs(level[:, None] - PRICE_FACTORS[None, :]).argmin(axis=1)] & (money == np.floor(money))
    whole = np.floor(amount + 0.5).astype(np.int64)
    pence = np.where(cents, money, np.floor(money * 100 + 0.5)).astype(np.int64)
    per = np.where(rows["base"].to_numpy() == "stueck", 1, 1000).astype(np.int64)
    ok = (whole > 0) & rows["own"].to_numpy(bool)
    unit = (2 * pence * per + whole) // (2 * np.maximum(whole, 1))
    return pd.DataFrame({"row": rows["row"], "base_unit": rows["base"], "base_amount": whole, "cent_per_unit": unit})[ok]


def common_units(df: DataFrame, row: str = "ord") -> DataFrame:
    """One row for each row of df whose amount can be told: row id, base_unit, base_amount, cent_per_unit.

    df has product_name, description, unit, quantity, price, price_per_kg, supplier, source_title, extracted_at and the
    row id; other columns are not read. base_unit is 'g', 'ml' or 'stueck'. A missing quantity is 1. A unit of weight
    or volume decides over the text; pieces and containers take the content their text states (weight or volume before
    count); pieces without content count 1 each, containers without are left out, as are rows without a positive
    price or amount. Null or empty texts state nothing. Repeated rows give a row each; an empty table gives none.
    """
    rows = sliced(df, found_texts(df, row)).repartition("source", "slice").sortWithinPartitions("source", "slice", "at", "row").drop("at")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            source, part = frame["source"].to_numpy(), frame["slice"].to_numpy()
            cut = int(np.argmax((source == source[-1]) & (part == part[-1]))) if len(frame) else 0
            if cut:
                yield reverse_scales(read_amounts(frame.iloc[:cut]))
            elif len(frame) >= 4 * max(BLOCK, CONTEXT):
                # The last rows wait for those behind them; the ones before are their context.
                late = np.arange(len(frame)) >= len(frame) - CONTEXT
                yield reverse_scales(read_amounts(frame.assign(own=frame["own"] & ~late)))
                frame["own"], cut = frame["own"] & late, len(frame) - 2 * CONTEXT
            rest = frame.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield reverse_scales(read_amounts(rest))

    kind = dict(df.dtypes)[row]
    out = rows.mapInPandas(run, f"row {kind}, base_unit string, base_amount bigint, cent_per_unit bigint")
    return out.withColumnRenamed("row", row)
