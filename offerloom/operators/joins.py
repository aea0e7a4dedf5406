"""Joins of offers with lists, brochures and marks."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest list that is broadcast.
LIST_LIMIT = 100_000


#: A key on more rows than this is hot; its rows are dealt to one task for each so many.
HOT_ROWS = 100_000


def hot_keys(rows: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """key, deals: the keys of more than limit rows (at most rows / limit of them) and the tasks each is dealt to."""
    limit = limit or HOT_ROWS
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    return n.select(key, F.ceil(F.col("__n") / limit).cast("int").alias("deals"))


def looked_up(rows: DataFrame, key: str, names: DataFrame, hot: DataFrame | None, *by: str) -> DataFrame:
    """rows joined with names (one row a key); the rows of hot keys are dealt by the hash of by, their names repeated.

    hot is as hot_keys gives it and is broadcast: it has at most rows / limit keys. None stands for no hot key.
    """
    if hot is None:
        return rows.join(names, key)
    some = F.broadcast(hot.select(key, "deals"))
    left = rows.join(some, key, "left").withColumn("__deal", F.coalesce(F.pmod(F.xxhash64(*by), F.col("deals")).cast("int"), F.lit(0))).drop("deals")
    right = names.join(some, key, "left").withColumn("__deal", F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1))).drop("deals")
    return left.join(right, [key, "__deal"]).drop("__deal")


def containment_join(texts: DataFrame, text: str, keywords: DataFrame, keyword: str, value: str) -> DataFrame:
    """text, value: for each text the value of the longest keyword that it holds or that holds it.

    Ties fall to the first keyword, then the first value. Texts are distinct by then; '' matches nothing. A list of at most
    LIST_LIMIT keywords is broadcast. A longer one is joined on equal strings: the parts of a text that have a keyword's
    length with the keywords, and the parts of a keyword with the texts.
    """
    texts, keys = texts.select(text).where(F.col(text) != "").distinct(), keywords.select(keyword, value).where(F.col(keyword) != "")
    if keys.limit(LIST_LIMIT + 1).count() <= LIST_LIMIT:
        pairs = texts.join(F.broadcast(keys), F.col(text).contains(F.col(keyword)) | F.col(keyword).contains(F.col(text)))
    else:
        # Distinct lengths: at most as many as the longest keyword has letters.
        sizes = F.lit(sorted(r[0] for r in keys.select(F.length(keyword)).distinct().collect()))
        parts = lambda c, n: F.array_distinct(F.flatten(F.transform(n, lambda k: F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(c, i, k)))))
        held = texts.select(text, F.explode(parts(F.col(text), F.filter(sizes, lambda k: k <= F.length(text)))).alias("part"))
        holds = keys.select(keyword, value, F.explode(parts(F.col(keyword), F.sequence(F.lit(1), F.length(keyword)))).alias("part"))
        inside = held.join(keys.withColumn("part", F.col(keyword)), "part").select(text, keyword, value)
        pairs = inside.unionByName(texts.join(holds, F.col(text) == F.col("part")).select(text, keyword, value))
    return pairs.groupBy(text).agg(F.min_by(value, F.struct(-F.length(keyword), F.col(keyword), F.col(value))).alias(value))


def token_sort_ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence of the texts with sorted words, by their length together."""
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if not x or not y:
        return 100.0 if x == y else 0.0
    masks: dict[str, int] = {}
    for i, ch in enumerate(x):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(x)) - 1
    s = full
    for ch in y:
        u = s & masks.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return 200.0 * (len(x) - s.bit_count()) / (len(x) + len(y))


class NameIndex:
    """Names by the length of their sorted words, with their letters; finds the closest one without trying all."""

    def __init__(self, names: list[str]):
        rows = sorted((len(" ".join(sorted(n.split()))), i, n) for i, n in enumerate(names))
        self.sizes, self.rows = [r[0] for r in rows], [(i, n, Counter(n.replace(" ", ""))) for _, i, n in rows]

    def best(self, text: str, threshold: float) -> tuple[float, int, str | None]:
        """Ratio, -place and name of the closest name from the threshold on (above 0); the first of equals.

        A common subsequence is no longer than the shorter text, nor than the letters in common (and the blanks), which
        bounds the ratio and spares most comparisons.
        """
        size, letters, top = len(" ".join(sorted(text.split()))), Counter(text.replace(" ", "")), (0.0, 0, None)
        least = threshold / (200 - threshold)
        for at in range(bisect_left(self.sizes, size * least - 1e-9), bisect_right(self.sizes, size / least + 1e-9)):
            i, name, own = self.rows[at]
            common = sum((letters & own).values()) + min(text.count(" "), self.sizes[at])
            if 200.0 * common >= max(threshold, top[0]) * (size + self.sizes[at]) - 1e-6:
                ratio = token_sort_ratio(text, name)
                if ratio >= threshold:
                    top = max(top, (ratio, -i, name), key=lambda x: (x[0], x[1]))
        return top


def fuzzy_best(texts: DataFrame, text: str, names: list[str], threshold: float = 80.0) -> DataFrame:
    """text, name, ratio: the name closest to each distinct text, if its ratio reaches the threshold; the first of equals.

    The names (at most LIST_LIMIT) are broadcast.
    """
    if len(names) > LIST_LIMIT:
        raise ValueError(f"more than {LIST_LIMIT} names: cut the list into parts and take the best of their results")
    shared = texts.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf("name string, ratio double")
    def best(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = NameIndex(shared.value)
        for column in columns:
            found = [index.best(t, threshold) for t in column]
            yield pd.DataFrame([(n, r) if n is not None else (None, None) for r, _, n in found], columns=["name", "ratio"])

    found = texts.select(text).where(F.col(text).isNotNull()).distinct().withColumn("b", best(text))
    return found.select(text, "b.name", "b.ratio").where("name is not null")


def dated_or_any(cards: DataFrame, brochures: DataFrame, keys: list[str], start: str, end: str, row: str) -> DataFrame:
    """Cards with their brochures by keys: those with both dates equal if there are any, else just the first by row."""
    joined = cards.alias("c").join(brochures.alias("b"), keys).select(*keys, F.col(f"c.{start}").alias("card_start"), F.col(f"c.{end}").alias("card_end"), F.col(f"b.{row}").alias(row), ((F.col(f"c.{start}") == F.col(f"b.{start}")) & (F.col(f"c.{end}") == F.col(f"b.{end}"))).alias("same"))
    card = [*keys, "card_start", "card_end"]
    exact = joined.where("same")
    other = joined.groupBy(*card).agg(F.max(F.coalesce("same", F.lit(False))).alias("any"), F.min(row).alias(row)).where("not any").drop("any")
    return exact.select(*card, row).unionByName(other.select(*card, row)).distinct()


def with_marks(rows: DataFrame, marks: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """rows with the columns of marks (one a key), defaults where there is none."""
    joined = rows.join(marks.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def upserted(old: DataFrame, new: DataFrame, key: str, columns: list[str], empty: Column) -> DataFrame:
    """Marks after an update: new ones replace old ones of the same key, and an empty new one deletes it."""
    n = new.select(F.col(key).alias("new_key"), *[F.col(c).alias(f"new_{i}") for i, c in enumerate(columns)], empty.alias("gone"))
    o = old.select(F.col(key).alias("old_key"), *[F.col(c).alias(f"old_{i}") for i, c in enumerate(columns)])
    both = o.join(n, F.col("old_key") == F.col("new_key"), "full_outer").where("gone is null or not gone")
    has = F.col("new_key").isNotNull()
    return both.select(F.coalesce("new_key", "old_key").alias(key), *[F.when(has, F.col(f"new_{i}")).otherwise(F.col(f"old_{i}")).alias(c) for i, c in enumerate(columns)])


def cached_or_new(wanted: DataFrame, cache: DataFrame, keys: list[str], value: str, new: Column) -> DataFrame:
    """wanted with value from the cache (one row a key) where it has one, else new; cached says which."""
    had = cache.select(*keys, F.col(value).alias("had"))
    joined = wanted.join(had, keys, "left")
    return joined.withColumns({value: F.coalesce("had", new), "cached": F.col("had").isNotNull()}).drop("had")


def repaired(old: DataFrame, again: DataFrame, source: str) -> DataFrame:
    """old without the rows of the sources that are in again, and the rows of again (the same columns)."""
    return old.join(again.select(source).distinct(), source, "left_anti").unionByName(again)


def resolved(wanted: DataFrame, there: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Each wanted key with its count from there (0 if it isn't there), and whether it is resolved."""
    joined = wanted.join(there.select(*keys, count), keys, "left")
    return joined.select(*keys, F.coalesce(count, F.lit(0)).alias(count), F.col(count).isNotNull().alias("resolved"))
