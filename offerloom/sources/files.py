"""Readers and writers of the files around offers: CSV, JSON lines, embedded JSON, hypercubes, partition folders."""

from __future__ import annotations

import html
import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import parse_tiers
from ..functions.dates import parse_date
from ..functions.numbers import parse_decimal
from ..session import shared_dir

# The columns of an offer file, and those that enrichment adds.
OFFER_COLUMNS = (
    "supplier", "location", "product_name", "description", "category", "origin", "unit", "quantity", "price", "price_per_kg", "price_is_net",
    "price_gross", "price_tiers", "valid_from", "valid_to", "calendar_week", "year", "source_file", "source_title", "source_tab", "source_page", "extraction_confidence",
)
ADDED_COLUMNS = ("brand", "product", "brand_product_confidence", "relevant", "reason", "relevant_time")


def read_strings(spark: SparkSession, path: str, columns: tuple[str, ...] = (), delimiter: str = ",") -> DataFrame:
    """A CSV with header, every value a string ('' for missing, a leading byte order mark dropped); missing columns as ''."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', sep=delimiter, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    every = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]
    return df.select(*every, *[F.lit("").alias(c) for c in columns if c not in df.columns])


def typed_offers(strings: DataFrame) -> DataFrame:
    """Offers with their types: '' and 'None' are null, a missing price is 0, only 'True' is net, scales are JSON."""
    value = lambda c: F.nullif(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("None"))
    number = lambda c: parse_decimal(value(c)).alias(c)
    whole = lambda c: parse_decimal(value(c)).cast("int").alias(c)
    kinds: dict[str, Column] = {
        "quantity": number("quantity"), "price": F.coalesce(parse_decimal(value("price")), F.lit(0.0)).alias("price"), "price_per_kg": number("price_per_kg"),
        "price_is_net": (F.trim(F.col("price_is_net")) == "True").alias("price_is_net"), "price_gross": number("price_gross"),
        "price_tiers": parse_tiers(value("price_tiers")).alias("price_tiers"), "valid_from": parse_date(value("valid_from")).alias("valid_from"),
        "valid_to": parse_date(value("valid_to")).alias("valid_to"), "calendar_week": whole("calendar_week"), "year": whole("year"),
        "source_page": whole("source_page"), "extraction_confidence": F.coalesce(parse_decimal(value("extraction_confidence")), F.lit(1.0)).alias("extraction_confidence"),
        "unit": F.coalesce(value("unit"), F.lit("kg")).alias("unit"),
    }
    return strings.select(*[kinds.get(c, value(c).alias(c)) for c in OFFER_COLUMNS])


def read_keyed_lines(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """JSON lines of which the last one of each key holds; broken lines and those without key fall out."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    rows = lines.select("at", F.from_json("value", schema).alias("r")).where(F.col(f"r.{key}").isNotNull())
    return rows.groupBy(F.col(f"r.{key}").alias("k")).agg(F.max_by("r", "at").alias("r")).select("r.*")


def partitions(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """supplier, year, week and files of paths like .../supplier/2026/14/name; folders that are no numbers fall out."""
    m = lambda i: F.regexp_extract(path, r"([^/]+)/(\d{4})/(\d{1,2})/[^/]+$", i)
    found = files.select(m(1).alias("supplier"), m(2).try_cast("int").alias("year"), m(3).try_cast("int").alias("week")).where("supplier <> ''")
    return found.groupBy("supplier", "year", "week").agg(F.count(F.lit(1)).alias("files"))


# The JSON of a brochure preview element.
PREVIEW = "headline string, tabs array<struct<title:string, entries:array<struct<title:string, validFrom:string, validTo:string, downloadLink:string, articleListDownloadLink:string, pdfUrl:string, catalogCategoryName:string, regionCategoriesNames:string>>>>"


def preview_entries(pages: DataFrame, page: str, text: str) -> DataFrame:
    """page, tab and entry columns of the JSON in the data-config attribute of each page's preview element."""
    raw = F.regexp_extract(text, r"(?s)cmp-brochure-preview[^>]*?data-config=[\"']([^\"'>]*)[\"']", 1)
    for name, sign in (("&quot;", '"'), ("&#34;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(name), F.lit(sign))
    tabs = pages.select(page, F.explode(F.from_json(raw, PREVIEW)["tabs"]).alias("t"))
    return tabs.select(page, F.col("t.title").alias("tab"), F.explode("t.entries").alias("e")).select(page, "tab", "e.*")


def json_ld_offers(pages: DataFrame, page: str, text: str) -> DataFrame:
    """page, name, price, currency of the products and single offers in a page's JSON-LD blocks, listed or in a graph.

    An offer without a name takes that of the item offered.
    """
    block = re.compile(r"<script[^>]*application/ld\+json[^>]*>(.*?)</script>", re.S | re.I)

    def products(node) -> Iterator[tuple]:
        if isinstance(node, list):
            for x in node:
                yield from products(x)
        elif isinstance(node, dict):
            if node.get("@type") == "Product":
                offer = node.get("offers") or {}
                offer = (offer[0] if offer else {}) if isinstance(offer, list) else offer
                price = str(offer.get("price", offer.get("lowPrice", ""))).replace(",", ".")
                yield node.get("name"), float(price) if re.fullmatch(r"\d+(\.\d+)?", price) else None, offer.get("priceCurrency")
            elif node.get("@type") == "Offer":
                item = node.get("itemOffered")
                price = str(node.get("price", node.get("lowPrice", ""))).replace(",", ".")
                yield node.get("name") or (item.get("name") if isinstance(item, dict) else None), float(price) if re.fullmatch(r"\d+(\.\d+)?", price) else None, node.get("priceCurrency")
            for k in ("@graph", "itemListElement", "item"):
                if k in node:
                    yield from products(node[k])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for p, t in zip(frame[page], frame[text], strict=True):
                for b in block.findall(t or ""):
                    try:
                        out += [(p, *x) for x in products(json.loads(html.unescape(b)))]
                    except ValueError:
                        continue
            yield pd.DataFrame(out, columns=[page, "name", "price", "currency"])

    return pages.select(page, text).mapInPandas(run, f"{page} {dict(pages.dtypes)[page]}, name string, price double, currency string")


def hypercube_rows(payloads: DataFrame, row: str, text: str) -> DataFrame:
    """row, line, column, value of the hypercubes (dimensions, measures, matrix pages) in JSON payloads, at any depth."""
    def cubes(node) -> Iterator[dict]:
        if isinstance(node, dict):
            if "qHyperCube" in node:
                yield node["qHyperCube"]
            for v in node.values():
                yield from cubes(v)
        elif isinstance(node, list):
            for v in node:
                yield from cubes(v)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for p, t in zip(frame[row], frame[text], strict=True):
                try:
                    found = list(cubes(json.loads(t or "null")))
                except ValueError:
                    continue
                line = 0
                for cube in found:
                    names = [x.get("qFallbackTitle", "") for x in (cube.get("qDimensionInfo") or []) + (cube.get("qMeasureInfo") or [])]
                    for part in cube.get("qDataPages") or []:
                        for cells in part.get("qMatrix") or []:
                            out += [(p, line, n, str(c.get("qText", c.get("qNum", "")))) for n, c in zip(names, cells, strict=False)]
                            line += 1
            yield pd.DataFrame(out, columns=[row, "line", "column", "value"])

    return payloads.select(row, text).mapInPandas(run, f"{row} {dict(payloads.dtypes)[row]}, line bigint, column string, value string")


def write_strings(df: DataFrame, path: str, *order: str) -> None:
    """CSV with header, nulls as empty values, arrays and structs as JSON; sorted by order if one is given."""
    plain = df.select(*[F.to_json(c).alias(c) if "array" in k or "struct" in k else F.col(c).cast("string").alias(c) for c, k in df.dtypes])
    (plain.sort(*order) if order else plain).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines, null fields left out."""
    df.write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Parquet by supplier, year and week (or as named); rows without one of them are not written."""
    keys = by or ("supplier", "year", "calendar_week")
    df.where(" and ".join(f"{k} is not null" for k in keys)).write.mode("overwrite").partitionBy(*keys).parquet(path)


def append_lines(df: DataFrame, path: str) -> None:
    """JSON lines added to those that are there."""
    df.write.mode("append").json(path)


def replace_atomically(df: DataFrame, path: str) -> None:
    """Parquet written beside its place and then renamed into it: readers see the old table or the new one.

    df may read the old table, which is deleted only when the new one is whole.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there, new, old = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", ".new", ".old"))
    df.write.mode("overwrite").parquet(str(new))
    fs = there.getFileSystem(conf)
    fs.delete(old, True)
    if fs.exists(there) and not fs.rename(there, old):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(new, there):
        fs.rename(old, there)
        raise OSError(f"{path} can't be replaced")
    fs.delete(old, True)


def existing(spark: SparkSession, *paths: str) -> str | None:
    """The first of several paths that is there: the canonical one, then older layouts; None if none is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(conf).exists(at):
            return p
    return None


def latest(files: DataFrame) -> DataFrame:
    """The path changed last of a listing with path and modificationTime (a binaryFile scan); the last one by name of equals."""
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def round_trip(offers: DataFrame) -> DataFrame:
    """ord and some columns of offers written as CSV and read again."""
    path = f"{shared_dir(offers.sparkSession)}/offers-csv-{uuid.uuid4().hex}"
    plain = offers.select(*[(F.col("ord").cast("string") if c == "location" else F.initcap(F.col(c).cast("string")) if c == "price_is_net" else F.col(c)).alias(c) for c in OFFER_COLUMNS])
    write_strings(plain, path)
    back = typed_offers(read_strings(offers.sparkSession, path, OFFER_COLUMNS))
    return back.select(F.col("location").cast("bigint").alias("ord"), "supplier", "product_name", "quantity", "price", "price_is_net", "valid_from", "calendar_week")


def appended_twice(rows: DataFrame, key: str, order: str) -> DataFrame:
    """rows appended as JSON lines in two batches, lower half of the order first, and read again by key."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    for half in (0, 1):
        append_lines(rows.where(F.pmod(order, F.lit(2)) == half), path)
    schema = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    parsed = spark.read.schema(schema).json(path)
    return parsed.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")


def partition_counts(offers: DataFrame) -> DataFrame:
    """Offers written by supplier, year and calendar_week, and counted by folder: only footers are read."""
    path = f"{shared_dir(offers.sparkSession)}/partitions-{uuid.uuid4().hex}"
    write_partitioned(offers.repartition("supplier", "year", "calendar_week"), path)
    back = offers.sparkSession.read.parquet(path)
    return back.groupBy("supplier", "year", F.col("calendar_week").alias("week")).agg(F.count(F.lit(1)).alias("offers"))
