"""Listings of the same product, by multi-pass sorted neighbourhood and correlation clustering.

Nothing about brands, articles or wordings is written down here; all of it is learnt from the listings themselves:

- A word is a brand if it fills the brand field in a larger share of its listings than any other word of these listings.
- Phrases are what stands between commas, dashes and line ends, or alone in the product field; a listing without such
  marks is cut into known phrases, longest first, then into slips of them.
- Phrases of the product field are articles. Two are wordings of one article if the brands that have one have the other,
  and have both in the same content beside the same third phrase.
- Phrases spread over all articles as chance would spread them, and over the listings of a product too, are advertising.
- All other phrases tell variants. Two of them are wordings of one variant if they meet among the listings of a block
  (brand, article and content) as often as each meets itself; alternatives meet no more often than by chance.

These wordings are the token similarity of a soft alignment. Listings with the same phrases are one class (copies never
meet each other). Classes are sorted by several keys that order their parts differently, so that a slip at one place
leaves neighbours by another key, and each class is aligned with the WINDOW next ones. Agreement of the aligned classes is
clustered by pivots: a class that outweighs all classes it agrees with takes them in, and so on.

Sorting is a range partitioning whose rows number themselves; the windows run over blocks of BLOCK rows and the first of
the next block, so a brand or article with a third of all listings is sorted and compared in as many tasks as it fills.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from ..sources.tables import spread
from .abuse import folded

WINDOW, BLOCK = 20, 5000
#: A phrase is learnt from this many listings on, or from this share of all listings, which bounds what is broadcast.
SUPPORT, SHARE = 3, 1 / 50_000
#: A word or phrase is taken for a slip of another only if the other is on this many times as many listings.
RARE = 20
#: A word beside this many different ones in brand fields is no part of a brand.
BESIDE = 4
#: A phrase on this part of the articles that chance would spread it over is advertising, unless it stands together with
#: itself in blocks this many times as often as elsewhere in the article.
SPREAD, RECURS = 0.8, 1.5
#: Wordings of one article share this part of their brands, and this part (cosine) of their blocks of brand, content and
#: other phrase, and each in at least TOGETHER of them.
SAME_BRANDS, SAME_ARTICLE, TOGETHER = 0.5, 0.08, 2
#: Wordings of one variant meet each other among the listings of a block (article, brand, content) more often than chance
#: has it by this part of what each meets itself by, and by SURE standard deviations.
SAME_VARIANT, SURE = 0.4, 3.5
#: Part of a product field's phrases below which a phrase is no article.
ARTICLE_SHARE = 0.15
#: A group of more listings than this is paired in several tasks.
HOT_GROUP = 10_000
#: Alignments from this score on are agreement; a part that one side lacks scores MISSING.
AGREE, MISSING = 0.8, 0.5

# Grams of the weight units.
GRAMS = {"kg": 1000, "kilo": 1000, "kilogramm": 1000, "g": 1, "gr": 1, "gramm": 1}

_digraph = re.compile(r"([aou])e")
_marks = re.compile("[™®©]")
_content = re.compile(r"(?<![\w.,])(\d+(?:[.,]\d+)*)\s*-?\s*(kilogramm|kilo|kg|gramm|gr|g)(?!\w)")
_between = re.compile(r"\s[-/–]\s|[;,](?=\s|$)|[|\n]")
_word = re.compile(r"[a-z0-9%]+")

_shared: dict = {}


def edits(a: str, b: str, most: int) -> int:
    """Edits between two strings, swapped neighbours counting once; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last2, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, last2[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return row[-1]


def slip(length: int) -> int:
    """Edits that a word of this length may hold by mistake."""
    return 2 if length >= 9 else 1 if length >= 5 else 0


def parts(text: str) -> list[list[str]]:
    """The words of each part of a folded text between commas, dashes and line ends."""
    return [w for w in (_word.findall(_digraph.sub(r"\1", p)) for p in _between.split(text)) if w]


def net_content(unit: str, quantity: str, text: str) -> str:
    """Grams by unit and quantity, else by the first content that the folded text states, as text; '' for none."""
    factor = GRAMS.get((unit or "").strip().lower().rstrip("."))
    if factor:
        try:
            return f"{float((quantity or '1').strip().replace(',', '.') or 1) * factor:.0f}"
        except ValueError:
            pass
    for m in _content.finditer(text):
        number = m[1].replace(".", "") if re.fullmatch(r"\d{1,3}(?:\.\d{3})+", m[1]) and GRAMS[m[2]] == 1 else m[1].replace(",", ".")
        try:
            return f"{float(number) * GRAMS[m[2]]:.0f}"
        except ValueError:
            continue
    return ""


def read_listing(name: str, brand: str, product: str, description: str, unit: str, quantity: str) -> tuple:
    """Content, parts of name and description, those set off by marks (and the product field's), product field, brand field."""
    first, second, third, fourth = (folded(_marks.sub("", x or "")) for x in (name, description, product, brand))
    content = net_content(unit, quantity, f"{first} | {second}")
    marked = bool(_between.search(first))
    first, second = parts(_content.sub(" | ", first)), parts(_content.sub(" | ", second))
    field = parts(third)
    return content, first + second, (first if marked else []) + second + field, field, " ".join(w for p in parts(fourth) for w in p)


def read_listings(df: DataFrame, row: str, name: str, brand: str, product: str, description: str, unit: str, quantity: str) -> DataFrame:
    """row, content, parts, marked, field, brand_field of each listing, as read_listing gives them. Nulls are ''."""
    columns = [name, brand, product, description, unit, quantity]
    rows = spread(df).select(F.col(f"`{row}`").alias("row"), *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read = [read_listing(*[x if isinstance(x, str) else "" for x in r[1:]]) for r in frame.itertuples(index=False)]
            yield pd.concat([frame[["row"]], pd.DataFrame(read, columns=["content", "parts", "marked", "field", "brand_field"], index=frame.index)], axis=1)

    kind = "array<array<string>>"
    return rows.mapInPandas(run, f"row {dict(df.dtypes)[row]}, content string, parts {kind}, marked {kind}, field {kind}, brand_field string")


def with_brands(box: Scratch, read: DataFrame) -> DataFrame:
    """The listings with their brand, '' where no word of theirs is one.

    A candidate fills the brand field somewhere; it rates by the share of its listings whose brand field it fills. Each
    listing chooses the best rated candidate that it holds, and a candidate that most of its listings don't choose is none.
    A word that stands beside at least BESIDE different others in brand fields (a legal form) is no part of a brand.
    """
    fields = read.where("brand_field like '% %'").select(F.split("brand_field", " ").alias("words"))
    beside = fields.select(F.explode("words").alias("word"), "words").groupBy("word").agg(F.count_distinct(F.array_except("words", F.array("word"))).alias("n"))
    forms = [r["word"] for r in beside.where(F.col("n") >= BESIDE).select("word").collect()]
    if forms:
        read = read.withColumn("brand_field", F.array_join(F.array_except(F.split("brand_field", " "), F.lit(sorted(forms))), " "))
    named = read.where("brand_field <> ''").groupBy(F.col("brand_field").alias("gram")).agg(F.count(F.lit(1)).alias("filled"))
    longest = read.agg(F.max(F.size(F.split("brand_field", " ")))).first()[0] or 1
    grams = F.expr(f"""array_distinct(array_append(flatten(transform(parts, p -> flatten(transform(sequence(1, {longest}), n ->
        if(size(p) >= n, transform(sequence(1, size(p) - n + 1), i -> array_join(slice(p, i, n), ' ')), array()))))), brand_field))""")
    held = box.keep(read.select("row", F.explode(grams).alias("gram")).where("gram <> ''").join(named.select("gram"), "gram"))
    rates = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).join(named, "gram").select("gram", "n", (F.col("filled") / (F.col("n") + 1)).alias("rate"))
    best = lambda r: held.join(r, "gram").groupBy("row").agg(F.max(F.struct("rate", "gram"))["gram"].alias("brand"))
    chosen = best(rates).groupBy(F.col("brand").alias("gram")).agg(F.count(F.lit(1)).alias("chosen"))
    brands = box.keep(rates.join(chosen, "gram").where("2 * chosen >= n").select("gram", "rate"))
    return read.join(best(brands), "row", "left").withColumn("brand", F.coalesce("brand", F.lit("")))


class Phrases:
    """The learnt phrases (words run together) with their listings, and a pigeonhole index for slips of them."""

    def __init__(self, counts: dict[str, int]):
        self.counts, self.index, self.near = counts, defaultdict(list), {}
        self.longest = max(map(len, counts), default=0)
        for p in counts:
            for key in self._pieces(p, slip(len(p))):
                self.index[key].append(p)
        self.own = {p: self.meant(p, n) for p, n in counts.items()}

    @staticmethod
    def _cuts(length: int, k: int) -> list[tuple[int, int]]:
        """2k + 1 segments: k edits, swaps of neighbours among them, leave one unchanged."""
        n = 2 * k + 1
        return [(i * length // n, (i + 1) * length // n) for i in range(n)]

    def _pieces(self, p: str, k: int) -> list[tuple]:
        return [(len(p), i, p[a:b]) for i, (a, b) in enumerate(self._cuts(len(p), k))] if k else []

    def meant(self, run: str, count: int) -> str:
        """The phrase of which a run is a slip: fewest edits, then most listings; the run itself if there is none."""
        k, found = slip(len(run)), set()
        for length in range(len(run) - k, len(run) + k + 1) if k else ():
            for i, (a, b) in enumerate(self._cuts(length, slip(length))):
                for s in range(-k, k + 1):
                    if a + s >= 0:
                        found.update(self.index.get((length, i, run[a + s : b + s]), ()))
        digits = re.sub(r"\D", "", run)
        near = [(edits(run, p, k), -self.counts[p], p) for p in found if p != run and self.counts[p] >= RARE * count and re.sub(r"\D", "", p) == digits]
        best = min((x for x in near if x[0] <= min(k, slip(len(x[2])))), default=(0, 0, run))
        return best[2]

    def lookup(self, run: str, slips: bool) -> str | None:
        if run in self.own or not slips:
            return self.own.get(run)
        if run not in self.near:
            if len(self.near) > 200_000:  # only a memory of answers
                self.near.clear()
            found = self.meant(run, 0)
            self.near[run] = found if found != run else None
        return self.near[run]

    def cut(self, runs: list[list[str]]) -> tuple[list[str], list[str]]:
        """Phrases of runs of words, longest first and slips last, and the words left over."""
        found: list[str] = []
        for slips in (False, True):
            after = []
            for words in runs:
                i, rest = 0, []
                while i < len(words):
                    ends, size = [], 0
                    for j in range(i, len(words)):
                        size += len(words[j])
                        if size > self.longest + 2 * slips:
                            break
                        ends.append(j + 1)
                    for j in reversed(ends):
                        hit = self.lookup("".join(words[i:j]), slips)
                        if hit:
                            found.append(hit)
                            if rest:
                                after.append(rest)
                            i, rest = j, []
                            break
                    else:
                        rest.append(words[i])
                        i += 1
                if rest:
                    after.append(rest)
            runs = after
        return found, [w for words in runs for w in words]


def without(part: list[str], brand: list[str]) -> list[list[str]]:
    """A part cut at the brand's words."""
    out: list[list[str]] = [[]]
    i = 0
    while i < len(part):
        if brand and part[i : i + len(brand)] == brand:
            out.append([])
            i += len(brand)
        else:
            out[-1].append(part[i])
            i += 1
    return [x for x in out if x]


def _learnt(mark: str, make):
    if mark not in _shared:
        _shared.clear()
        _shared[mark] = make()
    return _shared[mark]


def in_phrases(read: DataFrame, counts: dict[str, int]) -> DataFrame:
    """row, content, brand, phrases, field: the distinct phrases of each listing, and those of its product field.

    A listing without a known brand takes its most frequent word that is left over, or in its brand field, for one.
    """
    shared, mark = read.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _learnt(mark, lambda: Phrases(shared.value))
        for frame in frames:
            out = []
            for brand, words, field, given in zip(frame["brand"], frame["parts"], frame["field"], frame["brand_field"], strict=True):
                own = brand.split()
                found, left = known.cut([r for p in words for r in without(list(p), own)])
                told, _ = known.cut([r for p in field for r in without(list(p), own)])
                left = [w for w in [*left, *known.cut([given.split()])[1]] if len(w) > 1 and not w[0].isdigit()]
                out.append((brand or max(sorted(set(left)), key=left.count, default=""), sorted({*found, *told}), sorted(set(told))))
            yield pd.concat([frame[["row", "content"]], pd.DataFrame(out, columns=["brand", "phrases", "field"], index=frame.index)], axis=1)

    kind = dict(read.dtypes)["row"]
    return read.select("row", "content", "brand", "parts", "field", "brand_field").mapInPandas(run, f"row {kind}, content string, brand string, phrases array<string>, field array<string>")


def wordings(pairs: Iterable[tuple[str, str, float]], least: float) -> dict[str, str]:
    """Phrases and their class (its first phrase), by average linkage over the known similarities down to least."""
    sim, near, seen = {}, defaultdict(set), set()
    for a, b, s in pairs:
        sim[a, b] = sim[b, a] = s
        if s >= least:
            near[a].add(b)
            near[b].add(a)
    out = {}
    for start in sorted(near):
        if start in seen:
            continue
        todo, members = [start], set()
        while todo:
            x = todo.pop()
            if x not in members:
                members.add(x)
                todo += near[x]
        seen |= members
        groups = [[x] for x in sorted(members)]
        while True:
            best = (least, -1, -1)
            for i, g in enumerate(groups):
                for j in range(i):
                    known = [s for a in groups[j] for b in g if (s := sim.get((a, b))) is not None]
                    if known and sum(known) / len(known) >= best[0]:
                        best = (sum(known) / len(known), j, i)
            if best[1] < 0:
                break
            groups[best[1]] += groups.pop(best[2])
        out |= {x: min(g) for g in groups for x in g}
    return out


def learnt_articles(phrased: DataFrame) -> dict[str, str]:
    """Each article phrase and the class of its wordings; phrased as in_phrases gives it.

    Wordings of one article share their brands, and within a brand the blocks of one content and one other phrase, which
    two articles of one brand don't.
    """
    told = phrased.select("field", F.explode("phrases").alias("phrase")).select("phrase", F.array_contains("field", F.col("phrase")).alias("told"))
    counts = told.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.count_if("told").alias("p"))
    articles = [r["phrase"] for r in counts.where((F.col("p") >= SUPPORT) & (F.col("p") >= ARTICLE_SHARE * F.col("n"))).select("phrase").collect()]
    held = with_articles(phrased.where("brand <> ''"), {p: p for p in articles}).where("named <> ''").select("brand", "content", F.explode(F.split("named", r"\+")).alias("phrase"), "others")
    brands = _together(held.select("brand", "phrase").distinct(), ["brand"]).select("a", "b", F.col("both").alias("brands"), (F.col("both") / F.least("na", "nb")).alias("share"))
    block = ["brand", "content", "other"]
    blocks = _together(held.where("content <> ''").select("brand", "content", "phrase", F.explode("others").alias("other")).distinct(), block)
    alike = brands.where((F.col("brands") >= TOGETHER) & (F.col("share") >= SAME_BRANDS)).join(blocks, ["a", "b"])
    alike = alike.where(F.col("both") >= TOGETHER).select("a", "b", (F.col("both") / F.sqrt(F.col("na") * F.col("nb"))).alias("s"))
    found = wordings(((r["a"], r["b"], r["s"]) for r in alike.collect()), SAME_ARTICLE)
    return {p: found.get(p, p) for p in articles}


def _together(at: DataFrame, block: list[str]) -> DataFrame:
    """a, b, both, na, nb: pairs of phrases (a < b) with the blocks that hold both and each; at has each phrase of a block once."""
    size = at.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    pairs = at.select(*block, F.col("phrase").alias("a")).join(at.select(*block, F.col("phrase").alias("b")), block).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    return pairs.join(size.select(F.col("phrase").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("phrase").alias("b"), F.col("n").alias("nb")), "b")


def with_articles(phrased: DataFrame, articles: dict[str, str]) -> DataFrame:
    """row, content, brand, article (its class), named (its phrases), others (all other phrases)."""
    shared, mark = phrased.sparkSession.sparkContext.broadcast(articles), uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _learnt(mark, lambda: shared.value)
        for frame in frames:
            named = [[p for p in ps if p in known] for ps in frame["phrases"]]
            votes = [[known[p] for p in ps] + [known[p] for p in told if p in known] for ps, told in zip(named, frame["field"], strict=True)]
            yield frame[["row", "content", "brand"]].assign(
                article=[max(sorted(set(v)), key=v.count, default="") for v in votes], named=["+".join(ps) for ps in named],
                others=[[p for p in ps if p not in known] for ps in frame["phrases"]],
            )

    kind = dict(phrased.dtypes)["row"]
    return phrased.mapInPandas(run, f"row {kind}, content string, brand string, article string, named string, others array<string>")


def learnt_variants(told: DataFrame) -> dict[str, str]:
    """Each variant phrase and the class of its wordings; phrases that are advertising are not in it.

    told has brand, article, content, others. Advertising is spread over the articles as by chance, and a listing that
    bears it makes it no likelier for the other listings of its block. Articles and phrases are bounded in number by
    SHARE, and so is what is collected.
    """
    block = ["article", "brand", "content"]
    told = told.where("article <> ''")
    held = told.select(*block, F.explode("others").alias("phrase")).groupBy(*block, "phrase").agg(F.count(F.lit(1)).alias("k"))
    sizes = told.groupBy(*block).agg(F.count(F.lit(1)).alias("size"))
    articles = sizes.groupBy("article").agg(F.sum("size").alias("of"))
    listings = [float(r["of"]) for r in articles.collect()]
    share = held.groupBy("phrase", "article").agg(F.sum("k").alias("n")).join(articles, "article").select("phrase", "article", "n", (F.col("n") / F.col("of")).alias("share"))
    chance = F.aggregate(F.lit([n / sum(listings) for n in listings] or [0.0]), F.lit(0.0), lambda acc, p: acc + 1 - F.pow(1 - p, F.col("n")))
    over = share.groupBy("phrase").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("articles")).withColumn("chance", chance)
    told_at = held.where("content <> ''").join(sizes, block)
    each = told_at.groupBy("article", "phrase").agg(F.sum(F.col("k") * (F.col("k") - 1)).alias("seen"), F.sum(F.col("k") * (F.col("size") - 1)).alias("others"))
    each = each.join(share.select("phrase", "article", "share"), ["article", "phrase"])
    again = each.groupBy("phrase").agg(F.sum("seen").alias("seen"), F.sum(F.col("others") * F.col("share")).alias("usual"))
    recurs = (F.col("seen") > RECURS * F.col("usual")) & (F.col("seen") > F.col("usual") + 3 * F.sqrt("usual"))
    lasting = over.join(again, "phrase", "left").where((F.col("articles") < SPREAD * F.col("chance")) | (F.col("chance") < 3) | recurs)
    more = F.greatest(F.coalesce(F.col("seen") / F.nullif("usual", F.lit(0.0)), F.lit(1.0)) - 1, F.lit(0.1))
    lasting = told.sparkSession.createDataFrame([tuple(r) for r in lasting.select("phrase", more.alias("more")).collect()], "phrase string, more double")
    side = lambda p: each.join(lasting, "phrase").select("article", F.col("phrase").alias(p), F.col("others").alias("o" + p), F.col("share").alias("s" + p), F.col("more").alias("m" + p))
    usual = side("a").join(side("b"), "article").where("a < b").groupBy("a", "b", "ma", "mb").agg(F.sum((F.col("oa") * F.col("sb") + F.col("ob") * F.col("sa")) / 2).alias("usual"))
    at = held.where("content <> ''").join(lasting, "phrase", "left_semi")
    both = at.select(*block, F.col("phrase").alias("a"), F.col("k").alias("ka")).join(at.select(*block, F.col("phrase").alias("b"), F.col("k").alias("kb")), block).where("a < b")
    pairs = usual.join(both.groupBy("a", "b").agg(F.sum(F.col("ka") * F.col("kb")).alias("seen")), ["a", "b"], "left").where("usual > 0")
    seen = F.coalesce("seen", F.lit(0))
    likeness, sure = (seen / F.col("usual") - 1) / F.sqrt(F.col("ma") * F.col("mb")), (seen - F.col("usual")) / F.sqrt("usual")
    # Likeness that may be chance is no evidence; a lack of it is.
    known = pairs.select("a", "b", likeness.alias("s"), sure.alias("z")).where((F.col("s") < SAME_VARIANT) | (F.col("z") >= SURE))
    found = wordings(((r["a"], r["b"], r["s"]) for r in known.collect()), SAME_VARIANT)
    return {r["phrase"]: found.get(r["phrase"], r["phrase"]) for r in lasting.collect()}


def with_variants(told: DataFrame, variants: dict[str, str]) -> DataFrame:
    """row, content, brand, article, named, variant (its classes), told (its phrases)."""
    shared, mark = told.sparkSession.sparkContext.broadcast(variants), uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _learnt(mark, lambda: shared.value)
        for frame in frames:
            kept = [[p for p in ps if p in known] for ps in frame["others"]]
            yield frame[["row", "content", "brand", "article", "named"]].assign(variant=["+".join(sorted({known[p] for p in ps})) for ps in kept], told=["+".join(ps) for ps in kept])

    kind = dict(told.dtypes)["row"]
    return told.mapInPandas(run, f"row {kind}, content string, brand string, article string, named string, variant string, told string")


def understood(read: DataFrame, box: Scratch) -> DataFrame:
    """The listings of read_listings by brand, article, variant and content, each with its own words and their classes."""
    read, seen = box.measured(read, n=F.count(F.lit(1)))
    branded = box.keep(with_brands(box, read))
    words = F.explode("marked").alias("part")
    pieces = branded.where("brand <> ''").select("brand", words).select(F.explode(F.split(F.concat(F.lit(" "), F.array_join("part", " "), F.lit(" ")), F.concat(F.lit(" "), F.col("brand"), F.lit(" ")))).alias("run"))
    phrases = pieces.select(F.replace("run", F.lit(" "), F.lit("")).alias("run")).where("run <> ''").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["run"]: r["n"] for r in phrases.where(F.col("n") >= max(SUPPORT, seen["n"] * SHARE)).collect()}
    phrased = box.keep(in_phrases(branded, counts))
    articles = learnt_articles(phrased)
    told = box.keep(with_articles(phrased, articles))
    variants = learnt_variants(told)
    return with_variants(told, variants)


def alignment(a: str, b: str) -> Column:
    """The score of a soft alignment of two classes (struct columns): the mean over brand, article, variant and content.

    Equal tokens and wordings of one article or variant score 1. A brand may be a slip of the other where it is rare
    beside it, and scores by its edits. A part that one side lacks scores MISSING; any other difference is a contradiction.
    """
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    short, distance = F.least(F.length(x("brand")), F.length(y("brand"))), F.levenshtein(x("brand"), y("brand"))
    rare = RARE * F.least(x("brand_n"), y("brand_n")) <= F.greatest(x("brand_n"), y("brand_n"))
    # A swap of two letters is one slip and two edits.
    swapped = (distance == 2) & (F.array_sort(F.split(x("brand"), "")) == F.array_sort(F.split(y("brand"), "")))
    likely = F.when(short >= 9, distance <= 2).when(short >= 5, (distance <= 1) | swapped).otherwise(F.lit(False))
    brand = F.when((x("brand") == "") | (y("brand") == ""), F.lit(-9.0)).when(x("brand") == y("brand"), 1.0).when(rare & likely, 1 - distance / F.greatest(F.length(x("brand")), F.length(y("brand")))).otherwise(-9.0)
    part = lambda c: F.when(x(c) == y(c), 1.0).when((x(c) == "") | (y(c) == ""), MISSING).otherwise(-9.0)
    return (brand + part("article") + part("variant") + F.when(x("content") == y("content"), 1.0).otherwise(-9.0)) / 4


def neighbours(box: Scratch, classes: DataFrame, keys: list[list[Column]]) -> DataFrame:
    """a, b, a_n, b_n: classes that agree with one of the WINDOW - 1 behind them in the order of any key.

    One range partitioning sorts the classes by all keys, key after key; rows number themselves within their task, and
    the tasks' counts (a row a task) are added up.
    """
    passes = F.posexplode(F.array(*[F.array(*k) for k in keys])).alias("pass", "key")
    rows = classes.select(F.struct("id", "brand", "article", "variant", "content", "brand_n", "n").alias("c"), passes)
    at = F.monotonically_increasing_id()
    rows = rows.repartitionByRange("pass", "key", "c.id").sortWithinPartitions("pass", "key", "c.id").select("pass", "c", F.shiftright(at, 33).alias("task"), at.bitwiseAND((1 << 33) - 1).alias("at"))
    rows = box.keep(rows)
    starts, total = [], 0
    for r in rows.groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():
        starts.append((r["task"], total))
        total += r["n"]
    starts = classes.sparkSession.createDataFrame(starts, "task bigint, start bigint")
    ranked = rows.join(F.broadcast(starts), "task").withColumn("at", F.col("at") + F.col("start")).withColumn("block", F.floor(F.col("at") / BLOCK))
    both = F.explode(F.when((F.col("at") % BLOCK < WINDOW - 1) & (F.col("block") > 0), F.array("block", F.col("block") - 1)).otherwise(F.array("block")))
    w = Window.partitionBy("own").orderBy("at")
    behind = F.filter(F.collect_list(F.struct("pass", "c")).over(w.rowsBetween(1, WINDOW - 1)), lambda x: x["pass"] == F.col("pass"))
    near = ranked.select("pass", "c", "at", "block", both.alias("own")).select(F.col("c").alias("a"), behind.alias("next"), "block", "own").where("block = own")
    pairs = near.select("a", F.explode("next.c").alias("b"))
    agree = pairs.where(alignment("a", "b") >= AGREE).select(F.least(F.struct("a.id", "a.n"), F.struct("b.id", "b.n")).alias("x"), F.greatest(F.struct("a.id", "a.n"), F.struct("b.id", "b.n")).alias("y"))
    return agree.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("a_n"), F.col("y.n").alias("b_n")).distinct()


def product_groups(read: DataFrame) -> DataFrame:
    """row, group: every listing's group; read as read_listings gives it. A listing alone is its own group.

    Equal listings are of one group, empty ones too. Where there are too few listings to learn from, wordings stay apart.
    An empty table gives no rows.
    """
    spark = read.sparkSession
    box = Scratch(spark, "listings")
    own = ["brand", "named", "article", "told", "content"]
    rows = box.keep(understood(read, box).withColumn("id", F.unhex(F.md5(F.concat_ws("|", *own)))), "rows")
    brands = rows.groupBy("brand").agg(F.count(F.lit(1)).alias("brand_n"))
    classes = box.keep(rows.groupBy("id", "brand", "article", "variant", "content").agg(F.count(F.lit(1)).alias("n")).join(brands, "brand"), "classes")
    brand, article, variant, content = (F.col(c) for c in ("brand", "article", "variant", "content"))
    keys = [[brand, content, variant, article], [article, variant, content, brand], [content, F.reverse(brand), article, variant], [brand, article, variant, content]]
    edges = box.keep(neighbours(box, classes, keys), "edges")
    both = box.keep(edges.select(F.col("a").alias("id"), F.col("b").alias("other"), F.col("a_n").alias("n"), F.col("b_n").alias("m")).union(edges.select(F.col("b"), F.col("a"), F.col("b_n"), F.col("a_n"))), "both")
    # Pivots: who outweighs all its open neighbours takes in those whose heaviest open neighbour it is.
    done, open_ = None, both
    while not open_.isEmpty():
        best = open_.groupBy("id", "n").agg(F.max(F.struct("m", "other")).alias("best"))
        ranked = best.select("id", (F.struct(F.col("n").alias("m"), F.col("id").alias("other")) > F.col("best")).alias("pivot"), F.col("best.other").alias("to"))
        ranked = box.keep(ranked)
        pivots = ranked.where("pivot").select(F.col("id").alias("to"))
        taken = ranked.where("not pivot").join(pivots, "to", "left_semi").select("id", "to").unionByName(pivots.select(F.col("to").alias("id"), "to"))
        taken = box.keep(taken)
        done = taken if done is None else done.unionByName(taken)
        gone = taken.select("id")
        after = box.keep(open_.join(gone, "id", "left_anti").join(gone.withColumnRenamed("id", "other"), "other", "left_anti"))
        box.drop(ranked)
        box.drop(open_)
        open_ = after
    if done is None:
        return rows.select("row", F.hex("id").alias("group"))
    return rows.join(done, "id", "left").select("row", F.hex(F.coalesce("to", "id")).alias("group"))


def same_product_pairs(groups: DataFrame) -> DataFrame:
    """row_a, row_b: every pair of one group, smaller first. The pairs are the result, so a large group gives many.

    The rows of a group of more than HOT_GROUP listings are dealt to several tasks, each of which meets the whole group.
    """
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    deal = F.ceil(F.col("n") / HOT_GROUP).cast("int")
    rows = groups.join(sizes, "group").select("group", "row", deal.alias("deals"))
    a = rows.select("group", F.col("row").alias("row_a"), F.pmod(F.xxhash64("row"), F.col("deals")).cast("int").alias("deal"))
    b = rows.select("group", F.col("row").alias("row_b"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"))
    return a.join(b, ["group", "deal"]).where("row_a < row_b").select("row_a", "row_b")
