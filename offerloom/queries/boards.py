"""Queries of statistics, repairs, caches, groups and boards, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.names import squeeze, supplier_key
from ..operators.folds import blocks_after_heading, last_each
from ..operators.graph import clusters
from ..operators.joins import cached_or_new, repaired, resolved
from ..operators.pairs import similar_pairs
from ..operators.ranking import top_k, winner
from ..operators.similarity import tfidf
from ..sources import files
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_S = "regexp_extract(lower(trim(supplier)), '^(metro|edeka|selgros|handelshof)')"
_SQUEEZE = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"

# Matching statistics and reviews.


@query(f"""
WITH c AS (SELECT {_SQUEEZE.format('product_name')} AS name, count(DISTINCT {_S}) AS suppliers, count(*) AS offers FROM offers GROUP BY 1)
SELECT count_if(suppliers >= 2)::BIGINT AS matched, count_if(suppliers <= 1)::BIGINT AS single, sum(CASE WHEN suppliers >= 2 THEN offers ELSE 0 END)::BIGINT AS matched_offers,
  sum(CASE WHEN suppliers <= 1 THEN offers ELSE 0 END)::BIGINT AS unmatched_offers FROM c""")
def matching_stats(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "product_name", "supplier")
    c = o.groupBy(squeeze(o.product_name).alias("name")).agg(F.count_distinct(supplier_key(o.supplier)).alias("suppliers"), F.count(F.lit(1)).alias("offers"))
    many = F.col("suppliers") >= 2
    return c.agg(F.count_if(many).alias("matched"), F.count_if(~many).alias("single"), F.sum(F.when(many, F.col("offers")).otherwise(0)).alias("matched_offers"), F.sum(F.when(many, 0).otherwise(F.col("offers"))).alias("unmatched_offers"))


@query("""
SELECT lower(trim(relevant)) IN ('ja', 'yes', 'true', '1', 'x', 'relevant') AS yes, count(*) AS n, count_if(reason <> '')::BIGINT AS explained FROM enriched_offers GROUP BY 1""")
def relevance_counts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "relevant", "reason")
    return e.groupBy(text.is_yes(e.relevant).alias("yes")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason") != "").alias("explained"))


_IDS = "lower(trim(product_id_a)) AS x, lower(trim(product_id_b)) AS y"
_EDGE = f"SELECT x, y, confidence, similarity, should_human_review AS review, name_a, pair_no FROM (SELECT {_IDS}, * FROM pair_decisions) WHERE x <> y AND x <> '' AND y <> '' AND decision = 'exact_match' AND confidence >= 85"
_COMPONENTS = f"""e AS ({_EDGE}), n AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x AS id, x AS root FROM n UNION SELECT n.y, r.root FROM r JOIN n ON n.x = r.id), c AS (SELECT id, min(root) AS cluster FROM r GROUP BY id)"""


def _linked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, folder, "pair_decisions", "pair_no", "product_id_a", "product_id_b", "decision", "confidence", "similarity", "should_human_review", "name_a")
    x, y = squeeze(p.product_id_a), squeeze(p.product_id_b)
    edges = p.where((p.decision == "exact_match") & (p.confidence >= 85) & (x != y) & (x != "") & (y != "")).select(x.alias("x"), y.alias("y"), "confidence", "similarity", F.col("should_human_review").alias("review"), "name_a", "pair_no")
    return edges, clusters(edges, "x", "y")


@query(f"""
WITH RECURSIVE {_COMPONENTS}
SELECT cluster, concat_ws('; ', CASE WHEN max(review::INT) = 1 THEN 'flagged' END, CASE WHEN min(confidence) < 88 THEN 'unsure' END, CASE WHEN min(similarity) < 0.8 THEN 'unlike' END) AS reasons, count(*) AS edges
FROM e JOIN c ON c.id = e.x GROUP BY 1 HAVING reasons <> ''""")
def cluster_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters that a person should look at, with the reasons in their order."""
    edges, members = _linked(spark, folder)
    seen = edges.join(members, edges.x == members.id).groupBy("cluster").agg(F.bool_or("review").alias("r"), F.min("confidence").alias("c"), F.min("similarity").alias("s"), F.count(F.lit(1)).alias("edges"))
    reasons = F.concat_ws("; ", F.when(F.col("r"), "flagged"), F.when(F.col("c") < 88, "unsure"), F.when(F.col("s") < 0.8, "unlike"))
    return seen.select("cluster", reasons.alias("reasons"), "edges").where("reasons <> ''")


@query(f"""
WITH RECURSIVE {_COMPONENTS}
SELECT cluster, pair_no, name_a AS name, confidence FROM (SELECT cluster, pair_no, name_a, confidence, row_number() OVER (PARTITION BY cluster ORDER BY confidence DESC, similarity DESC NULLS LAST, pair_no) AS rn
  FROM e JOIN c ON c.id = e.x) WHERE rn = 1""")
def cluster_primary(spark: SparkSession, folder: str) -> DataFrame:
    """The edge that names each cluster: most confident, then most similar, then first."""
    edges, members = _linked(spark, folder)
    named = edges.join(members, edges.x == members.id).select("cluster", "pair_no", F.col("name_a").alias("name"), "confidence", "similarity")
    return winner(named, ["cluster"], [F.col("confidence"), F.col("similarity"), -F.col("pair_no")]).drop("similarity")


# Lookups, caches and repairs.


@query("""
SELECT p.pair_no, a.supplier AS supplier_a, b.supplier AS supplier_b, round(a.price - b.price, 4) AS gap FROM pair_decisions p
JOIN offers a ON a.product_id = p.product_id_a JOIN offers b ON b.product_id = p.product_id_b""")
def pair_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides' attributes of a pair, by the ids as they stand."""
    p, o = table(spark, folder, "pair_decisions", "pair_no", "product_id_a", "product_id_b"), table(spark, folder, "offers", "product_id", "supplier", "price")
    side = lambda k: o.select(F.col("product_id").alias(f"product_id_{k}"), F.col("supplier").alias(f"supplier_{k}"), F.col("price").alias(f"price_{k}"))
    return p.join(side("a"), "product_id_a").join(side("b"), "product_id_b").select("pair_no", "supplier_a", "supplier_b", F.round(F.col("price_a") - F.col("price_b"), 4).alias("gap"))


@query(f"""
WITH p AS (SELECT least(x, y) AS a, greatest(x, y) AS b, * FROM (SELECT {_IDS}, * FROM pair_decisions) WHERE x <> y AND x <> '' AND y <> ''),
want AS (SELECT a, b, max(similarity) AS s FROM p GROUP BY 1, 2),
had AS (SELECT a, b, decision FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY pair_no DESC) AS rn FROM p WHERE confidence >= 60) WHERE rn = 1)
SELECT a, b, coalesce(decision, CASE WHEN s >= 0.92 THEN 'exact_match' WHEN s >= 0.84 THEN 'close_comparable' ELSE 'no_match' END) AS decision, decision IS NOT NULL AS cached FROM want LEFT JOIN had USING (a, b)""")
def cached_judgements(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs with their last confident judgement, or one by similarity where there is none."""
    p = table(spark, folder, "pair_decisions", "pair_no", "product_id_a", "product_id_b", "similarity", "decision", "confidence")
    x, y = squeeze(p.product_id_a), squeeze(p.product_id_b)
    rows = p.where((x != y) & (x != "") & (y != "")).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "similarity", "decision", "confidence", "pair_no")
    want = rows.groupBy("a", "b").agg(F.max("similarity").alias("s"))
    had = winner(rows.where("confidence >= 60").select("a", "b", "decision", "pair_no"), ["a", "b"], [F.col("pair_no")]).drop("pair_no")
    s = F.col("s")
    return cached_or_new(want, had, ["a", "b"], "decision", F.when(s >= 0.92, "exact_match").when(s >= 0.84, "close_comparable").otherwise("no_match")).select("a", "b", "decision", "cached")


_FAILED = r"""SELECT DISTINCT p[1] AS supplier, p[2]::INT AS year, p[3]::INT AS week FROM (
  SELECT string_split(regexp_replace(x, '^ERROR extract (\w+)/(\d+)/(\d+) (\w+) failed after \d+ attempts$', '\1|\2|\3'), '|') AS p
  FROM (SELECT unnest(regexp_extract_all(text, 'ERROR extract \w+/\d{4}/\d{1,2} \w+ failed after \d+ attempts')) AS x FROM documents))"""


@query(f"""
WITH f AS ({_FAILED}), o AS (SELECT {_S} AS supplier, year, calendar_week AS week, count(*) AS offers FROM offers GROUP BY ALL)
SELECT supplier, year, week, coalesce(offers, 0) AS offers, offers IS NOT NULL AS resolved FROM f LEFT JOIN o USING (supplier, year, week)""")
def failed_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks with a failed page, and whether offers of that week are there nevertheless."""
    from ..operators.documents import failed_keys

    failed = failed_keys(table(spark, folder, "documents", "text"), "text").select("supplier", "year", "week").distinct()
    o = table(spark, folder, "offers", "supplier", "year", "calendar_week")
    there = o.groupBy(supplier_key(o.supplier).alias("supplier"), "year", F.col("calendar_week").alias("week")).agg(F.count(F.lit(1)).alias("offers"))
    return resolved(failed, there, ["supplier", "year", "week"], "offers")


@query(f"""
WITH o AS (SELECT {_S} AS supplier, coalesce(source_file, '') AS source_file, source_page, product_name, price, ord FROM offers),
again AS (SELECT supplier, source_file, source_page, product_name, round(price * 1.1, 4) AS price, ord FROM o WHERE source_file IN (SELECT pdf_local_path FROM brochures WHERE NOT selected)),
u AS (SELECT * FROM o WHERE source_file NOT IN (SELECT source_file FROM again) UNION ALL SELECT * FROM again)
SELECT ord, supplier, source_file, price FROM u ORDER BY supplier, source_file, coalesce(source_page, 0), product_name, price, ord""")
def repaired_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Files read again (those of brochures that were not selected, here with other prices) replace their old rows; sorted."""
    o = table(spark, folder, "offers", "supplier", "source_file", "source_page", "product_name", "price", "ord")
    o = o.withColumns({"supplier": supplier_key(o.supplier), "source_file": F.coalesce("source_file", F.lit(""))})
    files_again = table(spark, folder, "brochures", "pdf_local_path", "selected").where("not selected").select(F.col("pdf_local_path").alias("source_file"))
    again = o.join(files_again, "source_file", "left_semi").withColumn("price", F.round(F.col("price") * 1.1, 4))
    order = ["supplier", "source_file", F.coalesce("source_page", F.lit(0)), "product_name", "price", "ord"]
    return repaired(o, again, "source_file").orderBy(*order).select("ord", "supplier", "source_file", "price")


@query(f"""
SELECT supplier, year, week, count(*) AS n FROM (SELECT {_S} AS supplier, year, calendar_week AS week FROM offers WHERE year IS NOT NULL AND calendar_week IS NOT NULL) GROUP BY ALL
ORDER BY year DESC, week DESC, supplier""")
def week_list(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks with offers of each supplier, latest first; offers without a week are not listed."""
    o = table(spark, folder, "offers", "supplier", "year", "calendar_week").where("year is not null and calendar_week is not null")
    return o.groupBy(supplier_key(o.supplier).alias("supplier"), "year", F.col("calendar_week").alias("week")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("year").desc(), F.col("week").desc(), "supplier")


@query("""
WITH runs AS (SELECT DISTINCT year(valid_from)::INT AS year, week(valid_from)::INT AS week FROM brochures WHERE selected AND valid_from IS NOT NULL),
weeks AS (SELECT DISTINCT year, calendar_week AS week FROM offers WHERE year IS NOT NULL AND calendar_week IS NOT NULL)
SELECT year, week, true AS stored FROM runs UNION ALL SELECT year, week, false FROM weeks w WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.year = w.year AND r.week = w.week)""")
def runs_and_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Stored runs, and weeks that have data but no run."""
    b = table(spark, folder, "brochures", "valid_from", "selected").where("selected and valid_from is not null")
    runs = b.select(F.year("valid_from").alias("year"), F.weekofyear("valid_from").alias("week")).distinct()
    weeks = table(spark, folder, "offers", "year", "calendar_week").where("year is not null and calendar_week is not null").select("year", F.col("calendar_week").alias("week")).distinct()
    return runs.withColumn("stored", F.lit(True)).unionByName(weeks.join(runs, ["year", "week"], "left_anti").withColumn("stored", F.lit(False)))


# Folds and last values.


@query("""
SELECT source, month, doc_id, n_chars FROM (SELECT source, date_trunc('month', created_at)::DATE AS month, doc_id, n_chars, row_number() OVER (PARTITION BY source, date_trunc('month', created_at) ORDER BY created_at DESC, doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
def monthly_last(spark: SparkSession, folder: str) -> DataFrame:
    """The last document of each source and month."""
    d = table(spark, folder, "documents", "source", "created_at", "doc_id", "n_chars")
    return last_each(d.withColumn("month", F.trunc("created_at", "month")), ["source", "month"], [F.col("created_at"), F.col("doc_id")], ["doc_id", "n_chars"])


# How a change of price is reported.
_CHANGE = r"prices for ([a-z ]+) (eased|fell|rose|climbed|jumped|dropped) by (\d+\.\d+) percent"


@query(f"""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '{_CHANGE}', 0) AS l FROM documents), u AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM m),
k AS (SELECT doc_id, pos, regexp_extract(line, '{_CHANGE}', 1) AS product, regexp_extract(line, '{_CHANGE}', 2) AS way, regexp_extract(line, '{_CHANGE}', 3)::DOUBLE AS percent FROM u)
SELECT product, way, percent, n FROM (SELECT product, way, percent, count(*) OVER (PARTITION BY product) AS n, row_number() OVER (PARTITION BY product ORDER BY doc_id DESC, pos DESC) AS rn FROM k) WHERE rn = 1""")
def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of price told in texts; the last one of each product, by document and place, holds."""
    d = table(spark, folder, "documents", "doc_id", "text").where(F.col("text").contains("prices for"))
    lines = d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(_CHANGE), F.lit(0))).alias("at", "line"))
    part = lambda i: F.regexp_extract("line", _CHANGE, i)
    rows = lines.select("doc_id", "at", part(1).alias("product"), F.struct(part(2).alias("way"), part(3).cast("double").alias("percent")).alias("told"))
    last = rows.groupBy("product").agg(F.max_by("told", F.struct("doc_id", "at")).alias("told"), F.count(F.lit(1)).alias("n"))
    return last.select("product", "told.way", "told.percent", "n")


@query("""
WITH l AS (SELECT doc_id, s, generate_subscripts(s, 1) AS pos, trim(unnest(s)) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
h AS (SELECT doc_id, pos, line, (line LIKE '#%' OR line LIKE 'Gültig vom %' OR (line LIKE '%:' AND length(line) BETWEEN 2 AND 60)) AS heading FROM l),
g AS (SELECT *, sum(heading::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM h)
SELECT doc_id, block::BIGINT AS block, max(CASE WHEN heading THEN line END) AS heading, count_if(NOT heading AND line <> '')::BIGINT AS lines, sum(CASE WHEN heading THEN 0 ELSE length(line) END)::BIGINT AS chars FROM g WHERE block > 0 GROUP BY 1, 2""")
def heading_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of texts in the blocks that begin with a heading: a state machine over lines as gaps and islands."""
    return blocks_after_heading(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


# Groups, orders, winners.


@query(f"""
WITH p AS (SELECT category, {_SQUEEZE.format('product_name')} AS product, min(ord) AS first FROM offers GROUP BY 1, 2),
g AS (SELECT category, split_part(product, ' ', 1) AS market, product, row_number() OVER (PARTITION BY category, split_part(product, ' ', 1) ORDER BY first) AS rn FROM p WHERE product <> '')
SELECT category, market, count(*) AS products, string_agg(product, '; ' ORDER BY rn) FILTER (WHERE rn <= 3) AS terms FROM g GROUP BY 1, 2""")
def market_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Products by category and first word, with the three seen first as search terms; only three a group are shuffled."""
    from ..operators.ranking import top_k_each

    o = table(spark, folder, "offers", "category", "product_name", "ord")
    p = o.groupBy("category", squeeze(o.product_name).alias("product")).agg(F.min("ord").alias("first")).where("product <> ''").withColumn("market", F.split_part("product", F.lit(" "), F.lit(1)))
    sizes = p.groupBy("category", "market").agg(F.count(F.lit(1)).alias("products"))
    terms = top_k_each(p, ["category", "market"], 3, F.col("first")).groupBy("category", "market").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "product"))), lambda x: x["product"]), "; ").alias("terms"))
    kept = sizes.join(terms.select(F.col("category").alias("c"), F.col("market").alias("m"), "terms"), F.col("category").eqNullSafe(F.col("c")) & (F.col("market") == F.col("m")))
    return kept.select("category", "market", "products", "terms")


@query(f"""
WITH f AS (SELECT brochure_no, {_S} AS supplier, year(valid_from)::INT AS year, week(valid_from)::INT AS week, split_part(trim(regexp_replace(lower(title), '[^a-z0-9äöüß]+', ' ', 'g')), ' ', 1) AS family, pdf_local_path AS path FROM brochures WHERE valid_from IS NOT NULL AND pdf_local_path IS NOT NULL)
SELECT brochure_no, n, rn = 1 AS kept FROM (SELECT brochure_no, count(*) OVER w AS n, row_number() OVER (PARTITION BY supplier, year, week, family ORDER BY length(path) DESC, path, brochure_no) AS rn FROM f WINDOW w AS (PARTITION BY supplier, year, week, family)) WHERE n > 1""")
def family_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one supplier, week and title family; the one with the longest path is kept, the others are flagged."""
    b = table(spark, folder, "brochures", "brochure_no", "supplier", "title", "valid_from", "pdf_local_path").where("valid_from is not null and pdf_local_path is not null")
    family = F.split_part(F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9äöüß]+", " ")), F.lit(" "), F.lit(1))
    rows = b.select("brochure_no", supplier_key(b.supplier).alias("supplier"), F.year("valid_from").alias("year"), F.weekofyear("valid_from").alias("week"), family.alias("family"), F.col("pdf_local_path").alias("path"))
    keys = ["supplier", "year", "week", "family"]
    best = rows.groupBy(*[F.coalesce(k, F.lit("")).alias(k) if k == "family" else k for k in keys]).agg(F.count(F.lit(1)).alias("n"), F.min_by("brochure_no", F.struct(-F.length("path"), F.col("path"), F.col("brochure_no"))).alias("best")).where("n > 1")
    return rows.withColumn("family", F.coalesce("family", F.lit(""))).join(best, keys).select("brochure_no", "n", (F.col("brochure_no") == F.col("best")).alias("kept"))


_RANK = "CASE WHEN c = 'fisch' THEN 0 WHEN c = 'fleisch' THEN 1 WHEN c IN ('obst', 'gemüse', 'obst_gemuese') THEN 2 ELSE 10 END"


@query(f"""
SELECT c AS category, lower(product_name) AS product, lower(brand) AS brand, coalesce(price, '') AS price, '' AS note FROM (SELECT lower(trim(category)) AS c, * FROM enriched_offers)
ORDER BY {_RANK}, c, lower(product_name), lower(brand), source_row_index""")
def final_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The final sheet: ordered by category rank, category, product and brand; the note is left for a person."""
    e = table(spark, folder, "enriched_offers", "source_row_index", "category", "product_name", "brand", "price")
    c = F.lower(F.trim("category"))
    rank = F.when(c == "fisch", 0).when(c == "fleisch", 1).when(c.isin("obst", "gemüse", "obst_gemuese"), 2).otherwise(10)
    rows = e.select(c.alias("category"), F.lower("product_name").alias("product"), F.lower("brand").alias("brand"), F.coalesce("price", F.lit("")).alias("price"), F.lit("").alias("note"), rank.alias("rank"), "source_row_index")
    return rows.orderBy("rank", "category", "product", "brand", "source_row_index").drop("rank", "source_row_index")


@query(f"""
SELECT category, product, source_row_index FROM (SELECT lower(trim(category)) AS category, {_SQUEEZE.format('product_name')} AS product, source_row_index,
  row_number() OVER (PARTITION BY lower(trim(category)), {_SQUEEZE.format('product_name')} ORDER BY source_row_index) AS rn FROM enriched_offers WHERE trim(product_name) <> '') WHERE rn = 1""")
def forecast_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each category and product."""
    e = table(spark, folder, "enriched_offers", "source_row_index", "category", "product_name").where(F.trim("product_name") != "")
    return e.groupBy(F.lower(F.trim("category")).alias("category"), squeeze(e.product_name).alias("product")).agg(F.min("source_row_index").alias("source_row_index"))


# Near duplicates.

_VECTORS = """
WITH d AS (SELECT source_row_index AS doc, lower(trim(supplier)) AS s, regexp_extract_all(lower(product_name), '([\\p{L}\\p{N}_]{2,})', 1) AS w FROM enriched_offers),
t AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d UNION ALL
  SELECT doc, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1), n AS (SELECT count(*) AS n FROM d),
r AS (SELECT doc, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM t JOIN f USING (term), n),
v AS (SELECT r.doc, d.s, r.term, r.w / sqrt(sum(r.w * r.w) OVER (PARTITION BY r.doc)) AS w FROM r JOIN d ON d.doc = r.doc),
q AS (SELECT a.doc AS a, b.doc AS b, round(sum(a.w * b.w), 4) AS similarity, any_value(a.s) AS sa, any_value(b.s) AS sb FROM v a JOIN v b USING (term) WHERE a.doc < b.doc GROUP BY 1, 2)
"""


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "source_row_index", "product_name", "supplier")
    return tfidf(e, "source_row_index", F.col("product_name")).join(e.select("source_row_index", F.lower(F.trim("supplier")).alias("s")), "source_row_index")


@query(_VECTORS.replace("WITH d", "WITH RECURSIVE d", 1) + """, g AS (SELECT a, b FROM q WHERE sa = sb AND similarity >= 0.82), m AS (SELECT a, b FROM g UNION SELECT b, a FROM g),
x AS (SELECT a AS id, a AS root FROM m UNION SELECT m.b, x.root FROM x JOIN m ON m.a = x.id), c AS (SELECT id, min(root) AS class FROM x GROUP BY id)
SELECT id AS source_row_index, class, count(*) AS links FROM c JOIN m ON m.a = c.id GROUP BY 1, 2""")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Listings of one supplier whose names are alike (cosine from 0.82 on): class (its first listing) and number of links."""
    pairs = similar_pairs(_vectors(spark, folder), "source_row_index", 0.82, "s")
    both = pairs.select(F.col("a").alias("id")).unionByName(pairs.select("b").toDF("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    return clusters(pairs, "a", "b").join(both, "id").select(F.col("id").alias("source_row_index"), F.col("cluster").alias("class"), "links")


@query(_VECTORS + "SELECT id AS source_row_index, count(*) AS links, max(similarity) AS nearest FROM (SELECT a AS id, similarity FROM q WHERE sa <> sb AND similarity >= 0.8 UNION ALL SELECT b, similarity FROM q WHERE sa <> sb AND similarity >= 0.8) GROUP BY 1")
def rival_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listings with like ones of other suppliers (cosine from 0.8 on): how many, and how near the nearest is."""
    pairs = similar_pairs(_vectors(spark, folder), "source_row_index", 0.8, "s", same=False)
    sides = pairs.select(F.col("a").alias("id"), "similarity").unionByName(pairs.select(F.col("b").alias("id"), "similarity"))
    return sides.groupBy(F.col("id").alias("source_row_index")).agg(F.count(F.lit(1)).alias("links"), F.max("similarity").alias("nearest"))


# Boards.


@query("""
WITH m AS (SELECT doc_id, max_by(label, review_no) AS mark FROM doc_reviews GROUP BY 1)
SELECT d.doc_id, d.source, d.doc_type, coalesce(m.mark, 'open') AS mark FROM documents d LEFT JOIN m USING (doc_id) WHERE d.doc_type IS NOT NULL ORDER BY (m.mark IS NULL), d.doc_id LIMIT 200""")
def relevance_board(spark: SparkSession, folder: str) -> DataFrame:
    """The page of documents with their marks, marked ones first; 200 rows, as the page shows."""
    d = table(spark, folder, "documents", "doc_id", "source", "doc_type").where("doc_type is not null")
    r = table(spark, folder, "doc_reviews", "review_no", "doc_id", "label").groupBy("doc_id").agg(F.max_by("label", "review_no").alias("mark"))
    rows = d.join(r, "doc_id", "left")
    return top_k(rows, 200, F.col("mark").isNull(), F.col("doc_id")).select("doc_id", "source", "doc_type", F.coalesce("mark", F.lit("open")).alias("mark"))


@query("""
SELECT pair_no, name_a, name_b, similarity, decision FROM pair_decisions WHERE should_human_review ORDER BY similarity DESC NULLS LAST, pair_no LIMIT 100""")
def matching_board(spark: SparkSession, folder: str) -> DataFrame:
    """The page of pairs for review, most similar first; 100 rows, as the page shows."""
    p = table(spark, folder, "pair_decisions", "pair_no", "name_a", "name_b", "similarity", "decision", "should_human_review").where("should_human_review").drop("should_human_review")
    return top_k(p, 100, F.col("similarity").desc_nulls_last(), F.col("pair_no"))


@query(f"""
SELECT 'offers' AS item, count(*) AS n FROM offers UNION ALL SELECT 'brochures', count(*) FROM brochures UNION ALL SELECT 'suppliers', count(DISTINCT {_S}) FROM offers
UNION ALL SELECT 'reviews', count(*) FROM pair_decisions WHERE should_human_review UNION ALL SELECT 'weeks', count(*) FROM (SELECT DISTINCT year, calendar_week FROM offers WHERE year IS NOT NULL AND calendar_week IS NOT NULL)""")
def summary_board(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "supplier", "year", "calendar_week")
    n = F.count(F.lit(1)).alias("n")
    item = lambda name, df: df.select(F.lit(name).alias("item"), "n")
    parts = [
        item("offers", o.agg(n)), item("brochures", table(spark, folder, "brochures", "brochure_no").agg(n)), item("suppliers", o.agg(F.count_distinct(supplier_key(o.supplier)).alias("n"))),
        item("reviews", table(spark, folder, "pair_decisions", "should_human_review").where("should_human_review").agg(n)), item("weeks", o.where("year is not null and calendar_week is not null").select("year", "calendar_week").distinct().agg(n)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Files written and read again.


@query("""
SELECT ord, supplier, product_name, quantity, price, price_is_net, valid_from, calendar_week FROM (
  SELECT ord, nullif(nullif(trim(supplier), ''), 'None') AS supplier, nullif(nullif(trim(product_name), ''), 'None') AS product_name, quantity, coalesce(price, 0) AS price, coalesce(price_is_net, false) AS price_is_net, valid_from, calendar_week FROM offers)""")
def offer_files(spark: SparkSession, folder: str) -> DataFrame:
    """Offers written as CSV of strings and read again with their types; the row number travels as the location."""
    return files.round_trip(table(spark, folder, "offers"))


@query("""
WITH k AS (SELECT pair_no % 1000 AS key, max_by(decision, pair_no) AS decision, max(pair_no) AS pair_no FROM pair_decisions GROUP BY 1) SELECT key, decision, pair_no FROM k""")
def line_files(spark: SparkSession, folder: str) -> DataFrame:
    """Judgements appended as JSON lines in two batches; the last line of each key holds."""
    p = table(spark, folder, "pair_decisions", "pair_no", "decision").select((F.col("pair_no") % 1000).alias("key"), "decision", "pair_no")
    return files.appended_twice(p, "key", "pair_no")


@query(f"""
SELECT supplier, year, calendar_week AS week, count(*) AS offers FROM (SELECT {_S} AS supplier, year, calendar_week FROM offers WHERE year IS NOT NULL AND calendar_week IS NOT NULL) GROUP BY ALL""")
def partition_files(spark: SparkSession, folder: str) -> DataFrame:
    """Offers written by supplier, year and week, and counted from the folders alone."""
    o = table(spark, folder, "offers", "ord", "supplier", "year", "calendar_week")
    return files.partition_counts(o.withColumn("supplier", supplier_key(o.supplier)))
