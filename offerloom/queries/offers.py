"""Queries over offers, brochures and pairs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, dates, numbers, text
from ..functions.names import squeeze, supplier_key
from ..operators.graph import clusters
from ..operators.joins import containment_join, dated_or_any, fuzzy_best
from ..operators.ranking import interleaved, last_until_sure, mode_first_seen, top_k, winner
from ..operators.similarity import dense_neighbours, tfidf_neighbours
from ..plans.comparison import comparison
from ..sources.tables import table

QUERIES, SQL = {}, {}

# The suppliers' spellings in SQL.
_S = "regexp_extract(lower(trim(supplier)), '^(metro|edeka|selgros|handelshof)')"
_KEY = "trim(regexp_replace(replace(lower(coalesce({0}, '')), 'ß', 'ss'), '[^a-z0-9äöü]+', ' ', 'g'))"
_USABLE = "price_per_kg > 0 AND NOT isnan(price_per_kg) AND price_per_kg NOT IN (9999.0, 99999.99)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _usable(offers: DataFrame) -> DataFrame:
    p = F.col("price_per_kg")
    return offers.where((p > 0) & ~F.isnan(p) & ~p.isin(9999.0, 99999.99))


@query(f"SELECT {_S} AS supplier, count(*) AS offers FROM offers GROUP BY 1")
def supplier_counts(spark: SparkSession, folder: str) -> DataFrame:
    offers = table(spark, folder, "offers", "supplier")
    return offers.groupBy(supplier_key(offers.supplier).alias("supplier")).agg(F.count(F.lit(1)).alias("offers"))


@query(f"""
SELECT {_S} AS supplier, count(*) AS offers, count(DISTINCT source_file) AS sources, count(price_per_kg) AS priced,
       count(*) FILTER (WHERE valid_to >= valid_from) AS dated, count(*) FILTER (WHERE price_is_net) AS net FROM offers GROUP BY 1""")
def offer_stats(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "supplier", "source_file", "price_per_kg", "valid_from", "valid_to", "price_is_net")
    return o.groupBy(supplier_key(o.supplier).alias("supplier")).agg(
        F.count(F.lit(1)).alias("offers"), F.count_distinct("source_file").alias("sources"), F.count("price_per_kg").alias("priced"),
        F.count_if(o.valid_to >= o.valid_from).alias("dated"), F.count_if("price_is_net").alias("net"),
    )


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    o = _usable(table(spark, folder, "offers", "product_name", "supplier", "price_per_kg"))
    rows = o.select(text.key_text(o.product_name).alias("product"), supplier_key(o.supplier).alias("s"), "price_per_kg")
    return rows.groupBy("product").pivot("s", list(SUPPLIER_ORDER)).agg(F.round(F.min("price_per_kg"), 4))


SUPPLIER_ORDER = ("edeka", "handelshof", "metro", "selgros")
_PIVOT = f"""
SELECT product, min(p) FILTER (WHERE s = 'edeka') AS edeka, min(p) FILTER (WHERE s = 'handelshof') AS handelshof,
       min(p) FILTER (WHERE s = 'metro') AS metro, min(p) FILTER (WHERE s = 'selgros') AS selgros
FROM (SELECT {_KEY.format('product_name')} AS product, {_S} AS s, round(price_per_kg, 4) AS p FROM offers WHERE {_USABLE}) GROUP BY product"""


@query(_PIVOT)
def supplier_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return _prices(spark, folder)


@query(f"""
WITH t AS ({_PIVOT}), u AS (SELECT product, least(edeka, handelshof, metro, selgros) AS lo, greatest(edeka, handelshof, metro, selgros) AS hi,
  (edeka IS NOT NULL)::INT + (handelshof IS NOT NULL)::INT + (metro IS NOT NULL)::INT + (selgros IS NOT NULL)::INT AS n FROM t)
SELECT product, lo, hi, round((hi - lo) / lo * 100, 2) AS spread FROM u WHERE n >= 2 ORDER BY (hi - lo) / lo DESC, product LIMIT 10""")
def price_spread_top(spark: SparkSession, folder: str) -> DataFrame:
    p = [F.col(s) for s in SUPPLIER_ORDER]
    t = _prices(spark, folder).select("product", F.least(*p).alias("lo"), F.greatest(*p).alias("hi"), sum([x.isNotNull().cast("int") for x in p]).alias("n")).where("n >= 2")
    t = t.withColumn("r", (F.col("hi") - F.col("lo")) / F.col("lo"))
    return top_k(t, 10, F.col("r").desc(), F.col("product")).select("product", "lo", "hi", F.round(F.col("r") * 100, 2).alias("spread"))


@query(f"""
WITH t AS ({_PIVOT}), u AS (SELECT *, least(edeka, handelshof, metro, selgros) AS lo, greatest(edeka, handelshof, metro, selgros) AS hi,
  (edeka IS NOT NULL)::INT + (handelshof IS NOT NULL)::INT + (metro IS NOT NULL)::INT + (selgros IS NOT NULL)::INT AS n FROM t)
SELECT product, n, CASE WHEN edeka = lo THEN 'edeka' WHEN handelshof = lo THEN 'handelshof' WHEN metro = lo THEN 'metro' ELSE 'selgros' END AS best,
  CASE WHEN hi <= 1.05 * lo THEN NULL WHEN edeka = hi THEN 'edeka' WHEN handelshof = hi THEN 'handelshof' WHEN metro = hi THEN 'metro' ELSE 'selgros' END AS worst
FROM u WHERE n >= 2""")
def best_worst_flags(spark: SparkSession, folder: str) -> DataFrame:
    p = [F.col(s) for s in SUPPLIER_ORDER]
    t = _prices(spark, folder).withColumns({"lo": F.least(*p), "hi": F.greatest(*p), "n": sum([x.isNotNull().cast("int") for x in p])}).where("n >= 2")
    first = lambda v: F.coalesce(*[F.when(F.col(s) == F.col(v), F.lit(s)) for s in SUPPLIER_ORDER])
    return t.select("product", "n", first("lo").alias("best"), F.when(F.col("hi") > 1.05 * F.col("lo"), first("hi")).alias("worst"))


_DUP = f"""concat_ws('|', {_S}, {_KEY.format('category')}, {_KEY.format('product_name')}, {_KEY.format('description')}, {_KEY.format('origin')},
  coalesce(printf('%.4f', price), ''), coalesce(CASE WHEN isnan(price_per_kg) THEN 'NaN' ELSE printf('%.4f', price_per_kg) END, ''), coalesce(valid_from::VARCHAR, ''), coalesce(valid_to::VARCHAR, ''))"""


@query(f"""
SELECT ord, n FROM (SELECT ord, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY valid_to DESC NULLS LAST,
  coalesce(valid_to - valid_from, -1) DESC, (price_per_kg IS NOT NULL) DESC, ord) AS rn FROM (SELECT *, {_DUP} AS k FROM offers)) WHERE rn = 1""")
def exact_offer_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "supplier", "category", "product_name", "description", "origin", "price", "price_per_kg", "valid_from", "valid_to")
    day = lambda c: F.coalesce(o[c].cast("string"), F.lit(""))
    key = F.concat_ws("|", supplier_key(o.supplier), *[text.key_text(o[c]) for c in ("category", "product_name", "description", "origin")], numbers.key_number(o.price), numbers.key_number(o.price_per_kg), day("valid_from"), day("valid_to"))
    rank = F.struct(F.coalesce(o.valid_to, F.lit("0001-01-01").cast("date")), F.coalesce(F.datediff("valid_to", "valid_from"), F.lit(-1)), o.price_per_kg.isNotNull(), -o.ord)
    return o.groupBy(key.alias("k")).agg(F.max_by("ord", rank).alias("ord"), F.count(F.lit(1)).alias("n")).select("ord", "n")


_TITLE = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"


@query(f"""
SELECT brochure_no, n, CASE WHEN n = 1 THEN 'only' WHEN selected THEN 'selected' ELSE 'latest' END AS reason FROM (
  SELECT brochure_no, selected, count(*) OVER w AS n, row_number() OVER (PARTITION BY supplier, {_TITLE.format('title')}
    ORDER BY selected DESC, valid_to DESC NULLS LAST, brochure_no) AS rn FROM brochures WINDOW w AS (PARTITION BY supplier, {_TITLE.format('title')})) WHERE rn = 1""")
def brochure_winner(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "supplier", "title", "selected", "valid_to")
    rank = F.struct(b.selected, F.coalesce(b.valid_to, F.lit("0001-01-01").cast("date")), -b.brochure_no)
    w = b.groupBy("supplier", squeeze(b.title).alias("t")).agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct("brochure_no", "selected"), rank).alias("w"))
    return w.select("w.brochure_no", "n", F.when(F.col("n") == 1, "only").when(F.col("w.selected"), "selected").otherwise("latest").alias("reason"))


@query(f"""
WITH k AS (SELECT canonical_name, {_KEY.format('unnest(string_split(keywords, \',\'))')} AS keyword FROM canonical_products),
t AS (SELECT DISTINCT {_KEY.format('product_name')} AS name FROM offers)
SELECT name, canonical_name FROM (SELECT name, canonical_name, row_number() OVER (PARTITION BY name ORDER BY length(keyword) DESC, keyword, canonical_name) AS rn
  FROM t JOIN k ON (contains(name, keyword) OR contains(keyword, name)) WHERE name <> '' AND keyword <> '') WHERE rn = 1""")
def keyword_match(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "canonical_products", "canonical_name", "keywords")
    keys = c.select("canonical_name", F.explode(F.split("keywords", ",")).alias("k")).select("canonical_name", text.key_text(F.col("k")).alias("keyword"))
    names = table(spark, folder, "offers", "product_name").select(text.key_text(F.col("product_name")).alias("name"))
    return containment_join(names, "name", keys, "keyword", "canonical_name")


@query()
def fuzzy_match(spark: SparkSession, folder: str) -> DataFrame:
    listed = [r[0] for r in table(spark, folder, "canonical_products", "canonical_name").select(text.key_text(F.col("canonical_name"))).orderBy("canonical_name").collect()]
    names = table(spark, folder, "offers", "product_name").select(text.key_text(F.col("product_name")).alias("text"))
    return fuzzy_best(names, "text", listed).withColumn("ratio", F.round("ratio", 4))


@query(f"""
SELECT product, supplier, coalesce(min_by(ord, t) FILTER (WHERE c >= 0.97), max_by(ord, t)) AS ord, count(*) AS n
FROM (SELECT {_KEY.format('product_name')} AS product, {_S} AS supplier, ord, ord AS t, CASE WHEN extraction_confidence > 1 THEN extraction_confidence / 100 ELSE extraction_confidence END AS c FROM offers) GROUP BY 1, 2""")
def last_until_sure_offer(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "product_name", "supplier", "extraction_confidence")
    c = F.when(o.extraction_confidence > 1, o.extraction_confidence / 100).otherwise(o.extraction_confidence)
    rows = o.select("ord", text.key_text(o.product_name).alias("product"), supplier_key(o.supplier).alias("supplier"), c.alias("c"))
    return last_until_sure(rows, ["product", "supplier"], "ord", "ord", F.col("c") >= 0.97)


@query(r"""
SELECT ord, coalesce(valid_to >= CASE WHEN calendar_week BETWEEN 1 AND week(make_date(year, 12, 28))
  THEN date_trunc('week', make_date(year, 1, 4))::DATE + (calendar_week - 1) * 7 + 4 END, false) AS in_time FROM offers""")
def time_relevance(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "valid_to", "year", "calendar_week")
    return o.select("ord", dates.valid_through_friday(o.valid_to, o.year, o.calendar_week).alias("in_time"))


@query("""
WITH w AS (SELECT unnest(generate_series(date_trunc('week', valid_from)::DATE, valid_to, INTERVAL 7 DAY))::DATE AS monday FROM offers WHERE valid_from <= valid_to)
SELECT monday, count(*) AS offers FROM w GROUP BY 1""")
def offers_by_week(spark: SparkSession, folder: str) -> DataFrame:
    """Interval overlap with weeks as an equality on the weeks an offer touches, instead of a range join."""
    o = table(spark, folder, "offers", "valid_from", "valid_to").where("valid_from <= valid_to").groupBy("valid_from", "valid_to").count()
    weeks = o.select("count", F.explode(F.expr("sequence(cast(trunc(valid_from, 'week') as date), valid_to, interval 7 days)")).alias("monday"))
    return weeks.groupBy("monday").agg(F.sum("count").alias("offers"))


@query("""
SELECT ord FROM offers WHERE valid_from IS NULL OR valid_to IS NULL OR (valid_from <= DATE '2025-03-09' AND valid_to >= DATE '2025-03-03')""")
def interval_overlap(spark: SparkSession, folder: str) -> DataFrame:
    first = dates.week_start(F.lit(2025), F.lit(10))
    o = table(spark, folder, "offers", "ord", "valid_from", "valid_to")
    return o.where(dates.overlaps(o.valid_from, o.valid_to, first, F.date_add(first, 6))).select("ord")


@query(f"""
SELECT product, origin, n FROM (SELECT product, origin, n, row_number() OVER (PARTITION BY product ORDER BY n DESC, first) AS rn FROM (
  SELECT {_KEY.format('product_name')} AS product, origin, count(*) AS n, min(ord) AS first FROM offers WHERE origin <> '' GROUP BY 1, 2)) WHERE rn = 1""")
def usual_origin(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "product_name", "origin")
    return mode_first_seen(o.select("ord", text.key_text(o.product_name).alias("product"), "origin"), ["product"], "origin", "ord")


_TFIDF = """
WITH d AS (SELECT source_row_index AS doc, regexp_extract_all(lower(product_name), '([\\p{L}\\p{N}_]{2,})', 1) AS w FROM enriched_offers),
t AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d UNION ALL
  SELECT doc, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1), n AS (SELECT count(*) AS n FROM d),
r AS (SELECT doc, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM t JOIN f USING (term), n),
v AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM r)
"""


@query(_TFIDF + """, s AS (SELECT a.doc AS query, b.doc AS source_row_index, round(sum(a.w * b.w), 4) AS similarity FROM v a JOIN v b USING (term) WHERE a.doc % 50 = 0 AND a.doc <> b.doc GROUP BY 1, 2)
SELECT query, source_row_index, similarity, rn AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, source_row_index) AS rn FROM s) WHERE rn <= 5""")
def tfidf_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Every listing counts, with or without a brand; every fiftieth one asks."""
    e = table(spark, folder, "enriched_offers", "source_row_index", "product_name")
    return tfidf_neighbours(e, "source_row_index", e.product_name, F.col("source_row_index") % 50 == 0, 5)


@query("""
SELECT query, key, similarity, rn AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rn FROM (
  SELECT a.vec_id AS query, b.vec_id AS key, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
  FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)) WHERE rn <= 10""")
def cosine_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return dense_neighbours(spark, table(spark, folder, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", F.col("key") % 50 == 0, 10).withColumnRenamed("vec_id", "key")


_PAIRS = "lower(trim(product_id_a)) AS x, lower(trim(product_id_b)) AS y"


def _pairs(spark: SparkSession, folder: str, *also: str) -> DataFrame:
    p = table(spark, folder, "pair_decisions", "product_id_a", "product_id_b", *also)
    x, y = squeeze(p.product_id_a), squeeze(p.product_id_b)
    return p.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), *also).where((x != y) & (x != "") & (y != ""))


@query(f"""
SELECT least(x, y) AS a, greatest(x, y) AS b, round(max(similarity), 4) AS similarity, count(*) AS n
FROM (SELECT {_PAIRS}, similarity FROM pair_decisions) WHERE x <> y AND x <> '' AND y <> '' GROUP BY 1, 2""")
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder, "similarity").groupBy("a", "b").agg(F.round(F.max("similarity"), 4).alias("similarity"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT pair_no, CASE WHEN similarity >= 0.92 THEN 'exact_match' WHEN similarity >= 0.84 THEN 'close_comparable' ELSE 'no_match' END AS by_similarity,
  CASE WHEN similarity >= 0.92 THEN 91 WHEN similarity >= 0.84 THEN 88 ELSE 50 END AS sureness,
  (decision = 'exact_match' AND confidence >= 85) OR (decision = 'close_comparable' AND NOT should_human_review AND confidence >= CASE WHEN supplier_a = supplier_b THEN 90 ELSE 88 END) AS accepted
FROM pair_decisions""")
def judged_pairs(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pair_decisions", "pair_no", "similarity", "decision", "confidence", "should_human_review", "supplier_a", "supplier_b")
    s = p.similarity
    close = (p.decision == "close_comparable") & ~p.should_human_review & (p.confidence >= F.when(p.supplier_a == p.supplier_b, 90).otherwise(88))
    return p.select(
        "pair_no", F.when(s >= 0.92, "exact_match").when(s >= 0.84, "close_comparable").otherwise("no_match").alias("by_similarity"),
        F.when(s >= 0.92, 91).when(s >= 0.84, 88).otherwise(50).alias("sureness"), (((p.decision == "exact_match") & (p.confidence >= 85)) | close).alias("accepted"),
    )


_EDGES = f"SELECT x, y, confidence FROM (SELECT {_PAIRS}, * FROM pair_decisions) WHERE x <> y AND x <> '' AND y <> '' AND decision = 'exact_match' AND confidence >= 85"


@query(f"""
WITH RECURSIVE e AS ({_EDGES}), n AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x AS id, x AS root FROM n UNION SELECT n.y, r.root FROM r JOIN n ON n.x = r.id),
c AS (SELECT id, min(root) AS cluster FROM r GROUP BY id)
SELECT cluster, count(DISTINCT id) AS members, any_value(conf) AS confidence FROM c
JOIN (SELECT cluster, round_even(avg(confidence), 0)::INT AS conf FROM e JOIN c ON c.id = e.x GROUP BY 1) USING (cluster) GROUP BY 1""")
def offer_clusters(spark: SparkSession, folder: str) -> DataFrame:
    p = _pairs(spark, folder, "decision", "confidence").where("decision = 'exact_match' and confidence >= 85")
    c = clusters(p, "a", "b")
    conf = p.join(c, p.a == c.id).groupBy("cluster").agg(F.bround(F.avg("confidence")).cast("int").alias("confidence"))
    return c.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")).join(conf, "cluster")


@query("""
SELECT b.brochure_no FROM brochures b WHERE EXISTS (SELECT 1 FROM brochures p WHERE p.supplier = b.supplier AND p.location = b.location AND p.title = b.title
  AND p.brochure_no <> b.brochure_no AND date_trunc('week', p.valid_from) = date_trunc('week', b.valid_from) - INTERVAL 7 DAY)""")
def previous_week_issue(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "supplier", "location", "title", "valid_from").withColumn("week", F.trunc("valid_from", "week"))
    before = b.select("supplier", "location", "title", F.date_add("week", 7).alias("week")).distinct()
    return b.join(before, ["supplier", "location", "title", "week"], "left_semi").select("brochure_no")


@query("""
WITH c AS (SELECT DISTINCT supplier, title, valid_from, valid_to FROM brochures WHERE tab = 'Aktuell' AND selected), b AS (SELECT * FROM brochures),
j AS (SELECT c.*, b.brochure_no, coalesce(c.valid_from = b.valid_from AND c.valid_to = b.valid_to, false) AS same FROM c JOIN b USING (supplier, title)),
k AS (SELECT *, max(same) OVER w AS matched, min(brochure_no) OVER w AS lowest FROM j WINDOW w AS (PARTITION BY supplier, title, valid_from, valid_to))
SELECT DISTINCT supplier, title, valid_from AS card_start, valid_to AS card_end, brochure_no FROM k WHERE same OR (NOT matched AND brochure_no = lowest)""")
def cards_to_brochures(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "supplier", "title", "tab", "selected", "valid_from", "valid_to")
    cards = b.where("tab = 'Aktuell' and selected").select("supplier", "title", "valid_from", "valid_to").distinct()
    return dated_or_any(cards, b.drop("tab", "selected"), ["supplier", "title"], "valid_from", "valid_to", "brochure_no")


@query("""
SELECT coalesce(skip_reason, 'none') AS reason, count(*) AS n, min_by(title, brochure_no) AS example FROM brochures GROUP BY 1""")
def skip_reasons(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "skip_reason", "title")
    return b.groupBy(F.coalesce("skip_reason", F.lit("none")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min_by("title", "brochure_no").alias("example"))


@query(f"SELECT brochure_no FROM brochures b WHERE pdf_local_path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM offers o WHERE o.source_file = b.pdf_local_path AND {_USABLE})")
def brochures_without_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Brochures of which no offer states a usable price a kilo."""
    b, o = table(spark, folder, "brochures", "brochure_no", "pdf_local_path"), _usable(table(spark, folder, "offers", "source_file", "price_per_kg"))
    return b.where("pdf_local_path is not null").join(o, b.pdf_local_path == o.source_file, "left_anti").select("brochure_no")


@query("SELECT brochure_no FROM brochures WHERE pdf_local_path NOT IN (SELECT source_file FROM offers WHERE source_file IS NOT NULL)")
def brochures_without_offers(spark: SparkSession, folder: str) -> DataFrame:
    b, o = table(spark, folder, "brochures", "brochure_no", "pdf_local_path"), table(spark, folder, "offers", "source_file")
    return b.join(o, b.pdf_local_path == o.source_file, "left_anti").select("brochure_no")


@query("""
SELECT supplier, year, count(*) AS files, min(number) AS first, max(number) AS last FROM (
  SELECT regexp_extract(pdf_local_path, '^data/([^/]+)/(\\d{4})/', 1) AS supplier, regexp_extract(pdf_local_path, '^data/([^/]+)/(\\d{4})/', 2)::INT AS year,
         regexp_extract(pdf_local_path, '_(\\d+)\\.pdf$', 1)::BIGINT AS number FROM brochures WHERE pdf_local_path IS NOT NULL) GROUP BY 1, 2""")
def file_targets(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "pdf_local_path").where("pdf_local_path is not null").select(text.file_parts(F.col("pdf_local_path")).alias("f"))
    return b.groupBy("f.supplier", "f.year").agg(F.count(F.lit(1)).alias("files"), F.min("f.number").alias("first"), F.max("f.number").alias("last"))


@query("""
SELECT viewer_url, brochure_no, title FROM (SELECT *, row_number() OVER (PARTITION BY viewer_url ORDER BY brochure_no) AS rn FROM brochures WHERE viewer_url IS NOT NULL) WHERE rn = 1""")
def first_by_url(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "viewer_url", "brochure_no", "title").where("viewer_url is not null")
    return winner(b, ["viewer_url"], [-F.col("brochure_no")])


@query(f"""
WITH s AS (SELECT {_S} AS supplier, ord, row_number() OVER (PARTITION BY {_S} ORDER BY price DESC, ord) AS rn FROM offers)
SELECT row_number() OVER (ORDER BY rn, supplier) AS position, supplier, ord FROM s ORDER BY rn, supplier""")
def interleave_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "supplier", "price").withColumn("supplier", supplier_key(F.col("supplier")))
    rows = interleaved(o, "supplier", [F.col("price").desc(), F.col("ord")], F.col("supplier"))
    return rows.select("position", "supplier", "ord")


@query("""
SELECT ord FROM offers WHERE contains(lower(concat_ws(' ', product_name, description, origin)), 'kl. i') AND lower(trim(supplier)) LIKE 'metro%' ORDER BY ord LIMIT 500""")
def offer_search(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's filter: a text anywhere in a row and a supplier; 500 rows as the page shows."""
    o = table(spark, folder, "offers", "ord", "product_name", "description", "origin", "supplier")
    hits = o.where(text.contains_all(F.concat_ws(" ", "product_name", "description", "origin"), "kl. i") & (supplier_key(o.supplier) == "metro"))
    return top_k(hits.select("ord"), 500, F.col("ord"))


_PRICES = f"SELECT ord, {_S} AS supplier, {_KEY.format('product_name')} AS product, price FROM offers"


@query("""
SELECT source_row_index, TRY_CAST(replace(trim(price), ',', '.') AS DOUBLE) AS price, TRY_CAST(replace(trim(quantity), ',', '.') AS DOUBLE) AS quantity,
  lower(trim(relevant)) IN ('ja', 'yes', 'true', '1', 'x', 'relevant') AS relevant, replace(regexp_replace(printf('%.2f', TRY_CAST(replace(trim(price), ',', '.') AS DOUBLE)), '\\.?0+$', ''), '.', ',') AS shown
FROM enriched_offers""")
def listing_numbers(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "source_row_index", "price", "quantity", "relevant")
    price = numbers.parse_decimal(e.price)
    return e.select("source_row_index", price.alias("price"), numbers.parse_decimal(e.quantity).alias("quantity"), text.is_yes(e.relevant).alias("relevant"), numbers.german_number(price).alias("shown"))


@query("""
SELECT extraction_confidence AS c, greatest(0, least(100, round_even(CASE WHEN extraction_confidence <= 1 THEN extraction_confidence * 100 ELSE extraction_confidence END, 0)))::INT AS percent, count(*) AS n
FROM offers GROUP BY 1, 2""")
def confidence_scales(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "extraction_confidence")
    return o.groupBy(o.extraction_confidence.alias("c"), numbers.confidence_percent(o.extraction_confidence).alias("percent")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT origin, array_to_string(list_transform(regexp_extract_all(product_name, '(\\p{L}+|[^\\p{L}]+)', 1), lambda w: upper(w[1]) || lower(w[2:])), '') AS title, count(*) AS n FROM offers GROUP BY 1, 2""")
def title_words(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "origin", "product_name")
    return o.groupBy("origin", text.title_words(o.product_name).alias("title")).agg(F.count(F.lit(1)).alias("n"))


_PLAIN = f"trim(regexp_replace(translate(replace(lower({{0}}), 'ß', 'ss'), '{text.MARKED}', '{text.PLAIN}'), '[^a-z0-9]+', ' ', 'g'))"
_TABLE = f"map({list(text.COUNTRY_CODES)}, {list(text.COUNTRY_CODES.values())})"


@query(f"""
WITH p AS (SELECT origin, count(*) AS n, list_filter(regexp_split_to_array(coalesce(origin, ''), '{text.COUNTRY_SEPARATOR}'), lambda x: trim(x) <> '') AS parts FROM offers GROUP BY origin),
c AS (SELECT origin, n, list_transform(parts, lambda x: CASE WHEN regexp_full_match(trim(x), '[A-Za-z]{{2}}') THEN upper(trim(x)) ELSE coalesce({_TABLE}[{_PLAIN.format('x')}], trim(x)) END) AS codes FROM p)
SELECT origin, n, array_to_string(list_filter(codes, lambda x, i: list_position(codes, x) = i), ', ') AS codes FROM c""")
def origin_codes(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "origin")
    return o.groupBy("origin").agg(F.count(F.lit(1)).alias("n")).withColumn("codes", text.country_codes(F.col("origin")))


@query("""
SELECT ord, coalesce(array_to_string(list_sort(list_transform(price_tiers, lambda t: printf('%.4f', t.min_qty) || ':' || printf('%.4f', t.price))), ';'), '') AS key,
  coalesce(len(price_tiers), 0) AS steps FROM offers""")
def tier_keys(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "price_tiers")
    return o.select("ord", arrays.tier_key(o.price_tiers).alias("key"), F.coalesce(F.nullif(F.size("price_tiers"), F.lit(-1)), F.lit(0)).cast("long").alias("steps"))


@query("""
SELECT 'p_' || sha1(concat_ws('||', coalesce(offer_key, ''), ord::VARCHAR))[1:16] AS id, concat_ws('-', strftime(valid_from, '%d.%m.'), strftime(valid_to, '%d.%m.')) AS valid,
  printf('KW%02d_%d', calendar_week, year) AS week FROM offers""")
def offer_labels(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "offer_key", "ord", "valid_from", "valid_to", "calendar_week", "year")
    return o.select(text.stable_id(o.offer_key, o.ord).alias("id"), dates.short_range(o.valid_from, o.valid_to).alias("valid"), dates.week_label(o.year, o.calendar_week).alias("week"))


@query(f"""
SELECT supplier, product, n, suppliers FROM (SELECT product, supplier, count(*) AS n FROM ({_PRICES}) GROUP BY 1, 2)
JOIN (SELECT product, count(DISTINCT supplier) AS suppliers FROM ({_PRICES}) GROUP BY 1) USING (product) WHERE suppliers >= 2""")
def matched_products(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "product_name", "supplier")
    n = o.groupBy(text.key_text(o.product_name).alias("product"), supplier_key(o.supplier).alias("supplier")).agg(F.count(F.lit(1)).alias("n"))
    wide = n.groupBy("product").agg(F.count(F.lit(1)).alias("suppliers")).where("suppliers >= 2")
    return n.join(wide, "product").select("supplier", "product", "n", "suppliers")


@query(f"""
WITH k AS (SELECT canonical_name, {_KEY.format('unnest(string_split(keywords, \',\'))')} AS keyword FROM canonical_products),
o AS (SELECT {_KEY.format('product_name')} AS name, {_S} AS s, CASE WHEN {_USABLE} THEN round(price_per_kg, 4) END AS p FROM offers),
b AS (SELECT name, s, min(p) AS p, count(*) AS n FROM o GROUP BY 1, 2),
m AS (SELECT name, canonical_name FROM (SELECT name, canonical_name, row_number() OVER (PARTITION BY name ORDER BY length(keyword) DESC, keyword, canonical_name) AS rn
  FROM (SELECT DISTINCT name FROM o) JOIN k ON (contains(name, keyword) OR contains(keyword, name)) WHERE name <> '' AND keyword <> '') WHERE rn = 1),
w AS (SELECT canonical_name, sum(n)::BIGINT AS offers, min(p) FILTER (WHERE s = 'edeka') AS edeka, min(p) FILTER (WHERE s = 'handelshof') AS handelshof,
  min(p) FILTER (WHERE s = 'metro') AS metro, min(p) FILTER (WHERE s = 'selgros') AS selgros FROM b JOIN m USING (name) GROUP BY 1)
SELECT *, round((greatest(edeka, handelshof, metro, selgros) - least(edeka, handelshof, metro, selgros)) / least(edeka, handelshof, metro, selgros) * 100, 2) AS spread FROM w""")
def price_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return comparison(spark, folder)
