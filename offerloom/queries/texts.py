"""Queries over documents, their reviews and the market tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.documents import failed_keys, first_by_content, greedy_distinct, log_events
from ..operators.joins import upserted, with_marks
from ..operators.ranking import top_k
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT sha256(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_hash_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return first_by_content(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


@query(r"""
SELECT p[1] AS supplier, p[2]::INT AS year, p[3]::INT AS week, p[4] AS page, count(*) AS lines FROM (
  SELECT string_split(regexp_replace(x, '^ERROR extract (\w+)/(\d+)/(\d+) (\w+) failed after \d+ attempts$', '\1|\2|\3|\4'), '|') AS p
  FROM (SELECT unnest(regexp_extract_all(text, 'ERROR extract \w+/\d{4}/\d{1,2} \w+ failed after \d+ attempts')) AS x FROM documents)) GROUP BY ALL""")
def failed_pages(spark: SparkSession, folder: str) -> DataFrame:
    return failed_keys(table(spark, folder, "documents", "text"), "text")


@query(r"""
SELECT level, logger, count(*) AS lines, sum(d) AS total_ms FROM (
  SELECT json_extract_string(l, '$.level') AS level, json_extract_string(l, '$.logger') AS logger, json_extract_string(l, '$.duration_ms')::BIGINT AS d
  FROM (SELECT trim(unnest(string_split(text, chr(10)))) AS l FROM documents) WHERE l LIKE '{%' AND json_valid(l) AND json_extract_string(l, '$.timestamp') IS NOT NULL) GROUP BY 1, 2""")
def log_levels(spark: SparkSession, folder: str) -> DataFrame:
    e = log_events(table(spark, folder, "documents", "text"), "text")
    return e.groupBy("level", "logger").agg(F.count(F.lit(1)).alias("lines"), F.sum("duration_ms").cast("decimal(38,0)").alias("total_ms"))


_LAST = "(SELECT doc_id, max_by(label, review_no) AS label, max_by(reviewer, review_no) AS reviewer FROM doc_reviews GROUP BY 1)"


def _last(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "doc_reviews", "review_no", "doc_id", "label", "reviewer")
    return r.groupBy("doc_id").agg(F.max_by("label", "review_no").alias("label"), F.max_by("reviewer", "review_no").alias("reviewer"))


@query(f"SELECT d.doc_id, d.source, coalesce(r.label, 'open') AS label, coalesce(r.reviewer, 0)::INT AS reviewer FROM documents d LEFT JOIN {_LAST} r USING (doc_id)")
def marks_join(spark: SparkSession, folder: str) -> DataFrame:
    docs, marks = table(spark, folder, "documents", "doc_id", "source"), _last(spark, folder)
    joined = with_marks(docs, marks, "doc_id", {"label": F.lit("open"), "reviewer": F.lit(0)})
    return joined.withColumn("reviewer", F.col("reviewer").cast("int"))


@query(f"""
WITH o AS {_LAST.replace('doc_reviews', '(SELECT * FROM doc_reviews WHERE review_no % 2 = 0)')}, n AS {_LAST.replace('doc_reviews', '(SELECT * FROM doc_reviews WHERE review_no % 2 = 1)')}
SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.label ELSE o.label END AS label FROM o FULL JOIN n USING (doc_id)
WHERE n.doc_id IS NULL OR n.label <> 'ok'""")
def marks_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the reviews as old marks, the other half as updates; an 'ok' deletes the mark."""
    r = table(spark, folder, "doc_reviews", "review_no", "doc_id", "label")
    last = lambda d: d.groupBy("doc_id").agg(F.max_by("label", "review_no").alias("label"))
    new = last(r.where("review_no % 2 = 1"))
    return upserted(last(r.where("review_no % 2 = 0")), new, "doc_id", ["label"], new.label == "ok")


@query("""
WITH m AS (SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)
SELECT a.y, a.m, a.v, round((a.v - b.v) / nullif(b.v, 0) * 100, 2) AS change FROM m a LEFT JOIN m b ON b.y = a.y - 1 AND b.m = a.m""")
def monthly_yoy(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders", "o_orderdate", "o_totalprice")
    m = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    b = m.select((F.col("y") + 1).alias("y"), "m", F.col("v").alias("before"))
    return m.join(b, ["y", "m"], "left").select("y", "m", "v", F.round((F.col("v") - F.col("before")) / F.nullif("before", F.lit(0.0)) * 100, 2).alias("change"))


@query("""
WITH t AS (SELECT year(o_orderdate)::INT AS y, c_nationkey AS nation, round(max(o_totalprice), 2) AS top FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT y, nation, top FROM t WHERE y = (SELECT max(y) FROM t) ORDER BY top DESC, nation LIMIT 5""")
def latest_year_ranking(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_totalprice").join(table(spark, folder, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    t = o.groupBy(F.year("o_orderdate").alias("y"), F.col("c_nationkey").alias("nation")).agg(F.round(F.max("o_totalprice"), 2).alias("top"))
    last = t.agg(F.max("y").alias("last"))
    return top_k(t.join(F.broadcast(last), F.col("y") == F.col("last")).drop("last"), 5, F.col("top").desc(), F.col("nation"))


@query("""
WITH t AS (SELECT event_type, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY 1)
SELECT max_by(event_type, nullif(total, 0)) AS strongest, min_by(event_type, nullif(total, 0)) AS weakest, max(nullif(total, 0)) AS most, min(nullif(total, 0)) AS least FROM t""")
def argmax_developments(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "events", "event_type", "value").groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"))
    v = F.nullif("total", F.lit(0.0))
    return t.agg(F.max_by("event_type", v).alias("strongest"), F.min_by("event_type", v).alias("weakest"), F.max(v).alias("most"), F.min(v).alias("least"))


@query("SELECT event_type, json_extract(props, '$.k')::BIGINT AS k, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def json_stats(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events", "event_type", "props", "value")
    return e.groupBy("event_type", F.from_json("props", "k bigint")["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("""
SELECT source, lang, count(*) AS n, count_if(text IS NULL)::BIGINT AS missing, count_if(text = '')::BIGINT AS blank, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1, 2""")
def source_overview(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents", "source", "lang", "text", "n_chars")
    return d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(d.text.isNull()).alias("missing"), F.count_if(d.text == "").alias("blank"), F.sum("n_chars").alias("chars"))


@query("""
WITH u AS (SELECT brochure_no, supplier, regexp_replace(regexp_replace(lower(trim(download_url)), '[?#].*$', ''), '/+$', '') AS url FROM brochures WHERE download_url IS NOT NULL)
SELECT url, count(*) AS n, min(brochure_no) AS first FROM u GROUP BY 1""")
def url_keys(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "download_url").where("download_url is not null")
    return b.groupBy(text.url_key(b.download_url).alias("url")).agg(F.count(F.lit(1)).alias("n"), F.min("brochure_no").alias("first"))


@query(r"""
WITH RECURSIVE b AS (SELECT brochure_no, supplier || '/' || location AS list, regexp_replace(regexp_replace(lower(trim(download_url)), '[?#].*$', ''), '/+$', '') AS url,
  trim(regexp_replace(replace(lower(coalesce(title, '')), 'ß', 'ss'), '[^a-z0-9äöü]+', ' ', 'g')) AS title FROM (SELECT brochure_no, supplier, coalesce(location, '') AS location, title, download_url FROM brochures)),
o AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY brochure_no) AS rn FROM b),
r AS (SELECT list, rn, brochure_no, true AS kept, [coalesce('u' || url, ''), 't' || title] AS seen FROM o WHERE rn = 1
  UNION ALL SELECT o.list, o.rn, o.brochure_no, NOT k, CASE WHEN k THEN r.seen ELSE list_concat(r.seen, [coalesce('u' || url, ''), 't' || title]) END
  FROM r JOIN o ON o.list = r.list AND o.rn = r.rn + 1, LATERAL (SELECT coalesce(list_contains(r.seen, 'u' || url), false) OR list_contains(r.seen, 't' || title) AS k))
SELECT brochure_no, list, url, title FROM r JOIN o USING (list, rn, brochure_no) WHERE kept""")
def greedy_url_or_title(spark: SparkSession, folder: str) -> DataFrame:
    """Brochures of each supplier and location in order, without those whose url or title a kept one has."""
    b = table(spark, folder, "brochures", "brochure_no", "supplier", "location", "title", "download_url")
    keyed = b.select("brochure_no", F.concat_ws("/", "supplier", "location").alias("list"), text.url_key(b.download_url).alias("url"), text.key_text(b.title).alias("title"))
    return greedy_distinct(keyed, "list", "brochure_no", ["url", "title"])


@query("""
SELECT doc_id, array_to_string(list_transform(string_split(t, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS title, trim(both '_' FROM regexp_replace(replace(replace(replace(replace(lower(coalesce(t, '')), 'ß', 'ss'), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), '[^a-z0-9]+', '_', 'g')) AS slug
FROM (SELECT doc_id, title AS t FROM documents WHERE title <> '' AND title IS NOT NULL)""")
def title_slugs(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents", "doc_id", "title").where("title <> ''")
    return d.select("doc_id", text.title_first(d.title).alias("title"), text.slug(d.title, "").alias("slug"))


@query("""
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events", "ts", "event_type", "user_id")
    return e.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS discount, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark: SparkSession, folder: str) -> DataFrame:
    l = table(spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")  # noqa: E741
    l = l.where(l.l_shipdate <= F.lit("1998-09-02").cast("timestamp"))  # noqa: E741
    return l.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("discount"), F.count(F.lit(1)).alias("n"),
    )
