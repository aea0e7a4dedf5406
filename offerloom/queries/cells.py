"""Queries of scalar functions: cells, labels, texts and dates, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, dates, numbers, text
from ..functions.names import squeeze
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_COMPACT = "CASE WHEN abs({0}) >= 1e6 THEN printf('%.1fM', {0} / 1e6) WHEN abs({0}) >= 1e3 THEN printf('%.1fk', {0} / 1e3) WHEN {0} IS NOT NULL THEN printf('%.0f', {0}) END"


@query(f"""
SELECT c_custkey, {_COMPACT.format('b')} AS balance, CASE WHEN b IS NOT NULL THEN printf('%+.1f%%', b / 100) END AS change FROM (SELECT c_custkey, c_acctbal * 1.000001 AS b FROM customer)""")
def compact_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Shifted by a millionth: exact ties are rounded differently by printf and Java."""
    c = table(spark, folder, "customer", "c_custkey", "c_acctbal")
    b = c.c_acctbal * 1.000001
    return c.select("c_custkey", numbers.compact(b).alias("balance"), numbers.signed_percent(b / 100).alias("change"))


_UNIT = "rtrim(lower(trim(unit)), '.')"


@query(f"""
SELECT ord, quantity * CASE WHEN {_UNIT} IN ('kg', 'kilo', 'kilogramm', 'l', 'lt', 'ltr', 'liter') THEN 1.0 WHEN {_UNIT} IN ('g', 'gr', 'gramm', 'ml', 'milliliter') THEN 0.001 END AS kilos,
  list_max(list_transform(regexp_extract_all(lower(description), '\\d+(?:[.,]\\d+)?\\s*(?:kg|g)\\b'),
    lambda s: replace(regexp_extract(s, '^[\\d.,]+'), ',', '.')::DOUBLE * CASE WHEN s LIKE '%kg' THEN 1000.0 ELSE 1.0 END)) AS grams FROM offers""")
def kilos_and_grams(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "quantity", "unit", "description")
    return o.select("ord", numbers.kilos(o.quantity, o.unit).alias("kilos"), numbers.package_grams(o.description, F.lit(None).cast("double")).alias("grams"))


def _wrapped_sql(c: str, width: int = 30) -> str:
    return f"""list_reduce(string_split(trim(regexp_replace({c}, '\\s+', ' ', 'g')), ' '), lambda a, w:
      CASE WHEN length(string_split(a, chr(10))[-1]) + 1 + length(w) <= {width} THEN a || ' ' || w ELSE a || chr(10) || w END)"""


@query(f"SELECT ord, CASE WHEN description IS NULL THEN NULL ELSE {_wrapped_sql('description')} END AS lines FROM offers")
def wrapped_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "description")
    return o.select("ord", text.wrapped(o.description).alias("lines"))


@query(f"""
SELECT source_row_index, concat_ws(chr(10), nullif({_wrapped_sql('description')}, ''), CASE WHEN trim(brand) <> '' THEN 'Brand: ' || trim(brand) || ',' END) AS cell FROM enriched_offers""")
def brand_cells(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "source_row_index", "description", "brand")
    return e.select("source_row_index", text.with_brand_line(e.description, e.brand).alias("cell"))


_KNOWN = "CASE WHEN lower(trim({0})) NOT IN ('', 'unknown', 'unbekannt') THEN trim({0}) END"


@query(f"""
SELECT ord, concat_ws(chr(10), CASE WHEN trim(p) <> '' THEN 'Price: ' || p END, 'Unit: ' || {_KNOWN.format('unit')}, 'Origin: ' || {_KNOWN.format('origin')},
  'Valid: ' || nullif(concat_ws(' - ', strftime(valid_from, '%d.%m.%Y'), strftime(valid_to, '%d.%m.%Y')), ''), 'Source: ' || nullif(string_split(source_file, '/')[-1], '')) AS cell
FROM (SELECT *, replace(regexp_replace(printf('%.2f', price), '\\.?0+$', ''), '.', ',') AS p FROM offers)""")
def offer_cells(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "price", "unit", "origin", "valid_from", "valid_to", "source_file")
    day = lambda c: F.date_format(c, "dd.MM.yyyy")
    return o.select("ord", text.offer_cell(numbers.german_number(o.price), o.unit, o.origin, day(o.valid_from), day(o.valid_to), o.source_file).alias("cell"))


@query("""
SELECT source_row_index, concat_ws(chr(10), CASE WHEN trim(product_name) <> '' THEN 'Produkt: ' || product_name END, CASE WHEN trim(brand) <> '' THEN 'Marke: ' || brand END,
  CASE WHEN trim(description) <> '' THEN 'Beschreibung: ' || description END, CASE WHEN trim(category) <> '' THEN 'Kategorie: ' || category END, CASE WHEN trim(supplier) <> '' THEN 'Anbieter: ' || supplier END) AS text FROM enriched_offers""")
def rich_texts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "source_row_index", "product_name", "brand", "description", "category", "supplier")
    return e.select("source_row_index", text.labelled_lines({"Produkt": e.product_name, "Marke": e.brand, "Beschreibung": e.description, "Kategorie": e.category, "Anbieter": e.supplier}).alias("text"))


_GERMAN = "replace(regexp_replace(printf('%.2f', {0}), '\\.?0+$', ''), '.', ',')"


@query(f"""
SELECT ord, coalesce(nullif(array_to_string(list_transform(price_tiers, lambda t: 'ab ' || {_GERMAN.format('t.min_qty')} || ': ' || {_GERMAN.format('t.price')} || ' EUR'), '; '), ''), 'unknown') AS label,
  CASE WHEN len(price_tiers) >= 3 THEN price_tiers[2].price ELSE price_tiers[1].price END AS chosen FROM offers""")
def tier_labels(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "ord", "price_tiers")
    return o.select("ord", arrays.tier_label(o.price_tiers).alias("label"), arrays.second_or_first(o.price_tiers)["price"].alias("chosen"))


@query(r"""
SELECT host, count(*) AS n FROM (SELECT nullif(regexp_extract(lower(trim(viewer_url)), '^[a-z][a-z0-9+.-]*://(?:www\.)?([^/:?#]+)', 1), '') AS host FROM brochures) GROUP BY 1""")
def url_hosts(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "viewer_url")
    return b.groupBy(text.url_host(b.viewer_url).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT trim(regexp_replace(translate(replace(lower(product_name), 'ß', 'ss'), '{text.MARKED}', '{text.PLAIN}'), '[^a-z0-9]+', ' ', 'g')) AS name, count(*) AS n FROM offers GROUP BY 1""")
def plain_names(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "product_name")
    return o.groupBy(text.plain_text(o.product_name).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT supplier, CASE WHEN contains(lower(supplier), 'metro') THEN 'Metro' WHEN contains(lower(supplier), 'selgros') THEN 'Selgros' WHEN contains(lower(supplier), 'handelshof') THEN 'Handelshof'
  WHEN contains(lower(supplier), 'edeka') THEN 'Edeka' ELSE 'Unknown' END AS label, count(*) AS n FROM offers GROUP BY 1, 2""")
def supplier_labels(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "offers", "supplier")
    return o.groupBy("supplier", text.supplier_label(o.supplier).alias("label")).agg(F.count(F.lit(1)).alias("n"))


_CODES = list(text.CATEGORIES)
_TITLED = "array_to_string(list_transform(regexp_extract_all({0}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), lambda w: upper(w[1]) || lower(w[2:])), '')"


@query(f"""
SELECT category, CASE lower(trim(category)) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in text.CATEGORIES.items())} ELSE {_TITLED.format('category')} END AS label,
  (CASE lower(trim(category)) {' '.join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_CODES))} ELSE {len(_CODES)} END)::INT AS rank, count(*) AS n FROM offers GROUP BY 1, 2, 3 ORDER BY 3, 1""")
def category_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Categories in their fixed order."""
    o = table(spark, folder, "offers", "category").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return o.select("category", text.category_label(o.category).alias("label"), text.category_rank(o.category).alias("rank"), "n").orderBy("rank", "category")


@query("""
SELECT source_row_index, nullif(upper(v[1]) || lower(v[2:]), '') AS verdict, CASE WHEN v <> '' THEN array_to_string(string_split(trim(regexp_replace(r, '\\s+', ' ', 'g')), ' ')[1:2], ' ') END AS reason
FROM (SELECT source_row_index, regexp_extract(a, '(?is)^.*?\\b(ja|nein)\\b[\\s:,.;-]*(.*)$', 1) AS v, regexp_extract(a, '(?is)^.*?\\b(ja|nein)\\b[\\s:,.;-]*(.*)$', 2) AS r
  FROM (SELECT source_row_index, concat_ws(': ', relevant, reason) AS a FROM enriched_offers))""")
def verdict_texts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "enriched_offers", "source_row_index", "relevant", "reason")
    return e.select("source_row_index", text.verdict(F.concat_ws(": ", "relevant", "reason")).alias("v")).select("source_row_index", "v.verdict", "v.reason")


@query("""
SELECT doc_id, regexp_replace(trim(regexp_replace(regexp_extract(trim(title), '^[\\s*•-]*([^\\n;]*)', 1), '\\s+', ' ', 'g')), '^=', '±') AS signal FROM documents""")
def signal_texts(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents", "doc_id", "title")
    return d.select("doc_id", text.signal(d.title).alias("signal"))


_EN = " + ".join(f"contains(t, '{w}')::INT" for w in text.ENGLISH)


@query(f"""
SELECT lang, count_if(coalesce({_EN} >= 2, false))::BIGINT AS english, count(*) AS n
FROM (SELECT lang, ' ' || lower(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) || ' ' AS t FROM documents) GROUP BY 1""")
def english_texts(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents", "lang", "text")
    return d.groupBy("lang").agg(F.count_if(text.looks_english(d.text)).alias("english"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT brochure_no, title, valid_from AS start, valid_to AS end FROM (
  SELECT brochure_no, nullif(trim(title), '') AS title, CASE WHEN year(valid_from) = year(valid_to) THEN valid_from END AS valid_from, CASE WHEN year(valid_from) = year(valid_to) THEN valid_to END AS valid_to FROM brochures)""")
def card_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Brochures written out as cards and read again: title and both dates, where they share the year."""
    b = table(spark, folder, "brochures", "brochure_no", "title", "valid_from", "valid_to")
    dates_line = F.when(F.year("valid_from") == F.year("valid_to"), F.concat(F.date_format("valid_from", "dd.MM."), F.lit(" - "), F.date_format("valid_to", "dd.MM.yyyy")))
    lines = F.concat_ws("\n", F.lit("Aktuell"), dates_line, F.regexp_replace("title", "\n", " "), F.lit("Jetzt ansehen"))
    return b.select("brochure_no", text.card(lines).alias("c")).select("brochure_no", "c.title", "c.start", "c.end")


@query("""
SELECT trim(regexp_replace(regexp_replace(lower(title), '[(\\[][^)\\]]*[)\\]]', ' ', 'g'), '[^a-z0-9äöüß]+', ' ', 'g')) AS title, count(*) AS n, min(brochure_no) AS first FROM brochures GROUP BY 1""")
def brochure_titles(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "brochures", "brochure_no", "title")
    return b.groupBy(text.brochure_title(b.title).alias("title")).agg(F.count(F.lit(1)).alias("n"), F.min("brochure_no").alias("first"))


@query("""
WITH t AS (SELECT max(created_at)::DATE AS today FROM documents)
SELECT source, CASE WHEN a < 0 THEN 'future' WHEN a <= 7 THEN 'week' WHEN a <= 31 THEN 'month' WHEN a <= 365 THEN 'year' WHEN a IS NOT NULL THEN 'older' END AS age, count(*) AS n
FROM (SELECT source, today - created_at::DATE AS a FROM documents, t) GROUP BY 1, 2""")
def document_ages(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents", "source", "created_at").select("source", F.col("created_at").cast("date").alias("day"))
    last = d.agg(F.max("day").alias("today"))
    aged = d.join(F.broadcast(last)).select("source", dates.freshness(F.col("day"), F.col("today")).alias("age"))
    return aged.groupBy("source", "age").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT brochure_no, valid_from AS day, valid_from AS again FROM brochures")
def config_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates written in four ways, by the row's number, and read again; and as the first ten characters of a time."""
    b = table(spark, folder, "brochures", "brochure_no", "valid_from")
    ways = [F.date_format("valid_from", f) for f in ("yyyy-MM-dd HH:mm", "yyyy-MM-dd", "dd.MM.yyyy", "yyyyMMdd")]
    written = F.get(F.array(*ways), F.pmod("brochure_no", F.lit(4)).cast("int"))
    return b.select("brochure_no", dates.parse_date_any(written).alias("day"), dates.parse_date(F.concat(F.date_format("valid_from", "yyyy-MM-dd"), F.lit("T00:00:00"))).alias("again"))


@query("""
SELECT canonical_name, array_to_string(list_transform(list_filter(list_zip(k, range(1, len(k) + 1)), lambda x: list_position(list_transform(k, lambda y: lower(trim(y))), lower(trim(x[1]))) = x[2]), lambda x: x[1]), ',') AS keywords
FROM (SELECT canonical_name, string_split(keywords || ', ' || keywords, ',') AS k FROM canonical_products)""")
def distinct_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Each entry's keywords, said twice, once each in their first spelling."""
    c = table(spark, folder, "canonical_products", "canonical_name", "keywords")
    twice = F.split(F.concat_ws(", ", "keywords", "keywords"), ",")
    return c.select("canonical_name", F.array_join(arrays.distinct_by(twice, lambda v: F.lower(F.trim(v))), ",").alias("keywords"))


@query("""
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events""")
def embedded_props(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON of events, put between code fences and other words, and found again."""
    e = table(spark, folder, "events", "event_id", "props")
    fenced = F.concat(F.lit("Answer:\n```json\n"), "props", F.lit("\n```\nDone."))
    return e.select("event_id", arrays.embedded_json(fenced, "k bigint")["k"].alias("k"))


@query("""
SELECT pair_no, CASE WHEN decision IN ('exact_match', 'close_comparable', 'same_family_not_comparable', 'no_match') THEN decision ELSE 'no_match' END AS decision, coalesce(confidence, 0)::INT AS confidence,
  coalesce(reason, '') AS reason, CASE WHEN candidate_source IN ('embedding', 'tfidf') THEN candidate_source ELSE 'other' END AS source FROM pair_decisions""")
def defaulted_decisions(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pair_decisions", "pair_no", "decision", "confidence", "reason", "candidate_source")
    item = F.struct("decision", "confidence", "reason", F.col("candidate_source").alias("source"))
    defaults = {"decision": F.lit("no_match"), "confidence": F.lit(0), "reason": F.lit(""), "source": F.lit("other")}
    allowed = {"decision": ["exact_match", "close_comparable", "same_family_not_comparable", "no_match"], "source": ["embedding", "tfidf"]}
    return p.select("pair_no", arrays.defaulted(item, defaults, allowed).alias("d")).select("pair_no", "d.*")


_DETECT = [("kg", "kg"), ("kilo", "kg"), ("gramm", "g"), ("liter", "l"), ("ltr", "l"), ("ml", "ml"), ("stück", "stueck"), ("stk", "stueck"), ("bund", "bund"), ("kiste", "kiste")]


@query(f"""
SELECT ord, CASE {' '.join(f"WHEN contains(t, '{k}') THEN '{v}'" for k, v in _DETECT)} ELSE 'kg' END AS unit FROM (SELECT ord, lower(concat_ws(' ', product_name, description)) AS t FROM offers)""")
def detected_units(spark: SparkSession, folder: str) -> DataFrame:
    """The unit that name and description speak of, by the first of an ordered list; kg if none."""
    o = table(spark, folder, "offers", "ord", "product_name", "description").select("ord", F.lower(F.concat_ws(" ", "product_name", "description")).alias("t"))
    unit = F.coalesce(*[F.when(F.col("t").contains(k), F.lit(v)) for k, v in _DETECT], F.lit("kg"))
    return o.select("ord", unit.alias("unit"))


@query("""
SELECT p_type AS label, (p_type LIKE '%BRASS' OR contains(lower(p_type), 'standard') OR p_type LIKE '%STEEL') AS broad, count(*) AS n FROM part GROUP BY 1, 2""")
def broad_labels(spark: SparkSession, folder: str) -> DataFrame:
    """A label is broad by its end or by a word in it."""
    p = table(spark, folder, "part", "p_type")
    broad = p.p_type.rlike("(?:BRASS|STEEL)$") | F.lower("p_type").contains("standard")
    return p.groupBy(p.p_type.alias("label"), broad.alias("broad")).agg(F.count(F.lit(1)).alias("n"))


_TOKENS = ("price", "offer", "product", "preis", "angebot", "artikel", "kg", "eur", "valid", "gültig", "brutto", "netto")


@query(f"SELECT doc_id, ({' + '.join(f'coalesce(contains(lower(text), {t!r})::INT, 0)' for t in _TOKENS)})::INT AS hits FROM documents")
def interesting_texts(spark: SparkSession, folder: str) -> DataFrame:
    """How many of the listed tokens a text holds."""
    d = table(spark, folder, "documents", "doc_id", "text")
    return d.select("doc_id", sum([F.coalesce(F.lower("text").contains(t).cast("int"), F.lit(0)) for t in _TOKENS]).cast("int").alias("hits"))


@query("""
SELECT ord, TRY_CAST(replace(split_part(shown, '/', 1), ',', '.') AS DOUBLE) AS net, round(TRY_CAST(replace(split_part(shown, '/', 1), ',', '.') AS DOUBLE) * 1.07, 2) AS gross
FROM (SELECT ord, replace(printf('%.2f', price), '.', ',') || '/kg' AS shown FROM offers)""")
def gross_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices printed with unit and decimal comma, read again, with tax."""
    o = table(spark, folder, "offers", "ord", "price").select("ord", F.concat(F.replace(F.format_string("%.2f", "price"), F.lit("."), F.lit(",")), F.lit("/kg")).alias("shown"))
    net = numbers.parse_decimal(F.split_part("shown", F.lit("/"), F.lit(1)))
    return o.select("ord", net.alias("net"), F.round(net * 1.07, 2).alias("gross"))


@query("""
SELECT trim(regexp_replace(lower(supplier), '\\s+', ' ', 'g')) AS supplier, count(*) AS n FROM (SELECT supplier FROM offers WHERE supplier IS NOT NULL UNION ALL SELECT supplier FROM brochures WHERE supplier IS NOT NULL) GROUP BY 1""")
def supplier_union(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of two tables together, by supplier."""
    o, b = table(spark, folder, "offers", "supplier"), table(spark, folder, "brochures", "supplier")
    return o.unionByName(b).where("supplier is not null").groupBy(squeeze(F.col("supplier")).alias("supplier")).agg(F.count(F.lit(1)).alias("n"))
