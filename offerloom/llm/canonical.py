"""Free-entered names mapped to a canonical list, in SQL expressions only.

Names are folded to words. A name whose words contain a listed form (its words run together, so that split or hyphened
compounds count) is settled if every other word is mere decoration: a number, or a word that stands beside at least
SPREAD different entries all over the corpus (brands, qualities, advertising; learnt from the names, no list). All other
names lose their decoration, and what is left is joined fuzzily: each listed form of length L is cut into k + 1
segments, of which k edits leave one unchanged, shifted by at most k; equal (length, segment number, text) joins, and
levenshtein decides. An anti-join reports the names that stay unmatched.

Names are mapped once each. A name that fills a large part of the rows is salted when the rows are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .leaks import folded_words

#: Different entries beside which a word counts as decoration.
SPREAD = 4
#: Most edits, and the least length of a form for each number of them.
EDITS = 2
LEAST_LENGTH = {1: 5, 2: 7}
#: Below the length for two edits, two still count from this length on where they only reorder letters.
LEAST_SWAPPED = 5
#: A name on more rows than this is hot; its rows are spread over one task for each so many.
HOT_ROWS = 200_000

#: A comma or slash between words may mark parts in turned order ('filet / Matjes-').
TURN = r"\p{L}-?\s*[,/]\s*\p{L}"

# Abbreviated words that tell products apart, folded.
ABBREVIATED = {
    "m": "mit", "o": "ohne", "pan": "paniert", "gesch": "geschalt", "gefr": "gefrostet", "geschn": "geschnitten", "sch": "scheiben",
    "ausgen": "ausgenommen", "festk": "festkochend", "mehligk": "mehligkochend", "ger": "gerieben", "medaill": "medaillons",
}


def edits_for(length: Column) -> Column:
    return F.when(length >= min(LEAST_LENGTH[2], LEAST_SWAPPED), 2).when(length >= LEAST_LENGTH[1], 1).otherwise(0)


def _enough_alike(edits: Column, core: Column, form: Column) -> Column:
    letters = lambda c: F.array_sort(F.split(c, ""))
    most = F.when(F.length(form) >= LEAST_LENGTH[2], 2).when(F.length(form) >= LEAST_LENGTH[1], 1).otherwise(0)
    return (edits <= most) | ((edits == 2) & (F.length(form) >= LEAST_SWAPPED) & (letters(core) == letters(form)))


def name_words(text: Column) -> Column:
    """Folded words of a name, a blank between them; abbreviations written out, digits misread for letters undone."""
    w = folded_words(text)
    w = F.regexp_replace(F.regexp_replace(w, r"(?<=\p{L}{2})1|(?<=\p{L})1(?=\p{L}{2})", "l"), r"(?<=\p{L}{2})0|(?<=\p{L})0(?=\p{L}{2})", "o")
    for short, long in ABBREVIATED.items():
        w = F.regexp_replace(w, rf"(?<![\p{{L}}\p{{N}}]){short}(?![\p{{L}}\p{{N}}])", long)
    return F.coalesce(w, F.lit(""))


def listed_forms(canon: DataFrame, name: str, keywords: str) -> DataFrame:
    """canonical, w, form: each entry's name and keywords as words and with the words run together."""
    every = F.explode(F.concat(F.array(F.col(f"`{name}`")), F.split(F.coalesce(F.col(f"`{keywords}`"), F.lit("")), ",")))
    forms = canon.select(F.col(f"`{name}`").alias("canonical"), every.alias("text")).select("canonical", name_words(F.col("text")).alias("w"))
    return forms.select("canonical", "w", F.replace("w", F.lit(" "), F.lit("")).alias("form")).where("form <> '' and canonical is not null")


def _first(forms: DataFrame) -> DataFrame:
    """Each form with its entry, the first one by name where several have it."""
    return forms.groupBy("form").agg(F.min("canonical").alias("canonical"), F.max(F.col("w").contains(" ")).alias("phrase"))


def _sole(forms: DataFrame) -> DataFrame:
    """Forms of one entry only: what several entries come to when their decoration is taken away tells none of them."""
    one = forms.groupBy("form").agg(F.count_distinct("canonical").alias("entries"), F.min("canonical").alias("canonical"), F.max(F.col("w").contains(" ")).alias("phrase"))
    return one.where("entries = 1").drop("entries")


def _segments(length: str, k: str, i: str) -> tuple[str, str]:
    """Start (from 1) and size of segment i of k + 1 of a string of that length."""
    base, longer = f"cast(floor({length} / ({k} + 1)) as int)", f"({length} % ({k} + 1))"
    return f"({i} * {base} + least({i}, {longer}) + 1)", f"({base} + if({i} < {longer}, 1, 0))"


def pigeonhole_join(cores: DataFrame, forms: DataFrame) -> DataFrame:
    """core, canonical, edits, length, phrase: each core's (strings, once each) closest form within its edits, if any."""
    keyed = forms.withColumn("len", F.length("form")).withColumn("k", edits_for(F.col("len")))
    start, size = _segments("len", "k", "i")
    pieces = keyed.select("form", "canonical", "phrase", "len", "k", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i")).withColumn("part", F.expr(f"substring(form, {start}, {size})"))
    n = F.length("core")
    probes = cores.where("core <> ''").select("core", n.alias("n"), F.explode(F.sequence(F.greatest(n - EDITS, F.lit(1)), n + EDITS)).alias("len"))
    probes = probes.withColumn("k", edits_for(F.col("len"))).where("abs(n - len) <= k").select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"))
    # The first segment left whole has at most i edits before it and k - i behind it, which bounds its shift both ways.
    shifts = F.explode(F.sequence(F.expr("greatest(-i, n - len - (k - i))"), F.expr("greatest(least(i, n - len + (k - i)), greatest(-i, n - len - (k - i)))")))
    probes = probes.select("*", shifts.alias("s")).select("core", "len", "i", F.expr(f"substring(core, greatest({start} + s, 1), {size})").alias("part")).distinct()
    near = probes.join(pieces, ["len", "i", "part"]).select("core", "form", "canonical", "phrase", "k").distinct()
    near = near.withColumn("edits", F.levenshtein("core", "form", EDITS)).where("edits >= 0 and edits <= k").where(_enough_alike(F.col("edits"), F.col("core"), F.col("form")))
    best = near.groupBy("core").agg(F.min(F.struct("edits", (-F.length("form")).alias("shorter"), "canonical", "phrase")).alias("b"))
    return best.select("core", "b.canonical", "b.edits", (-F.col("b.shorter")).alias("length"), "b.phrase")


def _words_of(df: DataFrame, column: str) -> DataFrame:
    """w, at, word: the words that are no number or amount; a number's unit must be short or decoration itself."""
    return df.select("w", F.posexplode(column).alias("at", "word")).withColumn("plain", F.regexp_replace("word", r"^\d+(?:x\d+)*", "")).where("plain = word or length(plain) > 2").drop("word").withColumnRenamed("plain", "word")


def map_to_list(df: DataFrame, row: str, text: str, canon: DataFrame, name: str, keywords: str, way: str | None = None) -> DataFrame:
    """row and canonical_name for each row of df: the entry its text means, '' where it means none.

    If way names a column, it says how: 'listed' (a listed form and decoration), 'near' (by the pigeonhole join), 'none'.

    Null, empty and wordless texts mean none. Ties fall to fewer edits, the longer form, then the first entry by name.
    Repeated rows give a row each. Names and entries are matched whole. An empty list maps every row to ''; an empty
    table gives no rows. Other columns are not read.
    """
    box = Scratch(df.sparkSession, "canonical")
    rows = df.select(F.col(f"`{row}`").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    names = box.keep(rows.groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumns({"w": name_words(F.col("text")), "turned": F.col("text").rlike(TURN)}))
    listed = box.keep(listed_forms(canon, name, keywords).distinct())
    # Any run of words may be a form, however many it is split into, as long as it is no longer than the longest form.
    longest = listed.agg(F.max(F.length("form"))).first()[0] or 1
    texts = names.where("w <> ''").groupBy("w").agg(F.max("turned").alias("turned")).withColumn("words", F.split("w", " "))
    windows = F.inline(F.expr(f"flatten(transform(sequence(0, size(words) - 1), i -> filter(transform(sequence(1, least({longest}, size(words) - i)), n -> struct(array_join(slice(words, i + 1, n), '') as form, i, n)), x -> length(x.form) <= {longest})))"))
    inside = texts.select("w", windows).join(_first(listed), "form").groupBy("w").agg(F.max(F.struct(F.length("form").alias("l"), "canonical", "i", "n")).alias("b"))
    hits = box.keep(inside.select("w", "b.canonical", F.expr("filter(split(w, ' '), (x, j) -> j < b.i or j >= b.i + b.n)").alias("beside")))
    beside = _words_of(hits, "beside")
    spread = beside.join(hits.select("w", "canonical"), "w").groupBy("word").agg(F.countDistinct("canonical").alias("entries")).where(F.col("entries") >= SPREAD)
    decoration = box.keep(spread.select("word"))
    unsettled = beside.join(decoration, "word", "left_anti").select("w").distinct()
    settled = hits.join(unsettled, "w", "left_anti").select("w", "canonical")
    rest = texts.join(settled, "w", "left_anti")
    stripped = lambda d: _words_of(d, "words").join(decoration, "word", "left_anti").groupBy("w").agg(F.expr("transform(array_sort(collect_list(struct(at, word))), x -> x.word)").alias("core"))
    # Parts in turned order are tried too; without a mark they must make a listed phrase, or a listed word unchanged
    # ('Kartoffel Salat' is not 'Salatkartoffeln' with a letter missing).
    turns = F.inline(F.expr(f"""transform(sequence(0, if(size(core) > 1 and length(array_join(core, '')) <= {longest + EDITS}, size(core) - 1, 0)),
        r -> struct(array_join(concat(slice(core, r + 1, size(core)), slice(core, 1, r)), '') as core, r > 0 and not turned as strict))"""))
    cores = box.keep(stripped(rest).join(rest.select("w", "turned"), "w").select("w", turns).distinct())
    bare = stripped(listed.select("w", F.split("w", " ").alias("words")).distinct()).join(listed.select("w", "canonical"), "w").select("w", F.array_join("core", "").alias("form"), "canonical").distinct()
    # Listed forms stand as they are; stripped ones count where no listed form is the same.
    whole = _first(listed)
    forms = whole.unionByName(_sole(bare).join(whole.select("form"), "form", "left_anti"))
    near = cores.join(pigeonhole_join(cores.select("core").distinct(), forms), "core").where("not strict or phrase or edits = 0").groupBy("w").agg(F.min(F.struct("edits", (-F.col("length")).alias("l"), "canonical")).alias("b"))
    matched = settled.withColumn("way", F.lit("listed")).unionByName(near.select("w", "b.canonical", F.lit("near").alias("way")))
    meant = box.keep(names.join(matched, "w").select("text", "n", "canonical", "way"))
    none = names.join(meant, "text", "left_anti").select("text", "n", F.lit("").alias("canonical"), F.lit("none").alias("way"))
    out = _join_back(rows, meant.unionByName(none))
    for table in (hits, decoration, cores):
        box.drop(table)
    return out.select(F.col("row").alias(row), F.col("canonical").alias("canonical_name"), *([F.col("way").alias(way)] if way else []))


def _join_back(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with their text's canonical; rows of hot texts are salted. At most rows / HOT_ROWS texts are hot."""
    hot = F.broadcast(mapping.where(F.col("n") > HOT_ROWS).select("text", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("salts")))
    salted = rows.join(hot, "text", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    every = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / HOT_ROWS).cast("int"), F.lit(1)) - 1))
    return salted.join(mapping.select("text", "canonical", "way", every.alias("salt")), ["text", "salt"])
