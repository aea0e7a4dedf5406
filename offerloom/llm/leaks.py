"""Evaluation passages inside a corpus, by pigeonhole edit matching.

Each item is cut into pieces of PIECE words. A run of WORDS item words holds at least BUDGET + 1 whole pieces, so with
at most BUDGET edits one of them stands in the document unchanged. Exact piece hits come from one Aho-Corasick pass
over each document. A hit is followed up if the words around it agree as far as they must for some window within the
budget (REACH words, the same pigeonhole argument once more; it loses nothing). Around it the item's windows of WORDS
words are held against the document by Myers' bit-parallel distance, which decides: a pair is reported with its least
number of edits, and a leak is a pair with none.

The corpus is read once for each BLOCK_CHARS characters of item text and never shuffled: the items (a stated query set)
are broadcast in blocks of bounded size.
"""

from __future__ import annotations

import itertools
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread

#: Words of a passage, and the edits (of letters) that it may hold.
WORDS, BUDGET = 15, 1
#: Words of a piece, so that any WORDS words hold BUDGET + 1 whole pieces wherever they begin.
PIECE = (WORDS + 1) // (BUDGET + 2)
#: Characters of item text broadcast at a time.
BLOCK_CHARS = 8_000_000


def reach(words: int, piece: int, budget: int) -> int:
    """Words that stand unchanged around a whole piece in any window of that many words with at most budget edits.

    The least, over all places of the pieces and of the edited words, of the longest unchanged run that holds a piece.
    """
    least = words
    for first in range(piece):
        starts = range(first, words - piece + 1, piece)
        for edited in itertools.combinations(range(words), budget):
            cuts = [-1, *edited, words]
            runs = [b - a - 1 for a, b in zip(cuts, cuts[1:], strict=False) if any(a < s and s + piece <= b for s in starts)]
            least = min(least, max(runs))
    return least


REACH = reach(WORDS, PIECE, BUDGET)

# Letters with marks and the letters they fold to; letters whose UTF-8 is often read as Latin-1.
MARKED, PLAIN = "äöüáàâãåéèêëíìîïóòôõúùûñçýÿ", "aouaaaaaeeeeiiiioooouuuncyy"
MISREAD = "äöüÄÖÜßéèêàâçñ"

_automata: dict = {}


def folded_words(text: Column) -> Column:
    """The text's words in one spelling, a blank between them: lower case, umlauts in any spelling or encoding alike.

    Words divided by a hyphen at a line end are joined; marks, punctuation and other white space separate or vanish.
    """
    mended = text
    for c in MISREAD:
        mended = F.replace(mended, F.lit(c.encode().decode("latin-1")), F.lit(c))
        if (other := c.encode().decode("cp1252", "ignore")) != c.encode().decode("latin-1") and len(other) == 2:
            mended = F.replace(mended, F.lit(other), F.lit(c))
    s = F.lower(F.when(text.contains("Ã"), mended).otherwise(text))
    s = F.regexp_replace(s, r"[­̀-ͯ​-‏⁠﻿]|[-‐‑]\h*\R\s*", "")
    s = F.translate(F.replace(s, F.lit("ß"), F.lit("ss")), MARKED, PLAIN)
    s = F.regexp_replace(s, r"([aou])e", "$1")
    return F.trim(F.regexp_replace(s, r"[^\p{L}\p{N}]+", " "))


def myers(pattern: str, text: str, most: int | None = None) -> int:
    """The least number of edits between pattern and any part of text; any number over most if there are more than that."""
    m, left = len(pattern), len(text)
    if not m:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & mask), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        best, left = min(best, score), left - 1
        if most is not None and best > most and score - left > most:  # a character lowers the score by one at most
            break
    return best


class Item:
    """An item's words run together, and where each begins."""

    def __init__(self, key, words: list[str]):
        self.key, self.chars, self.starts = key, "".join(words), [0]
        for w in words:
            self.starts.append(self.starts[-1] + len(w))


class Finder:
    """Finds a block of items in folded texts."""

    def __init__(self, items: list[tuple]):
        import ahocorasick

        self.pieces, self.machine = {}, ahocorasick.Automaton()
        for key, folded in items:
            words = folded.split()
            item = Item(key, words)
            for w in range(0, len(words) - PIECE + 1, PIECE):
                if len(words) >= WORDS:
                    self.pieces.setdefault("".join(words[w : w + PIECE]), []).append((item, w))
        for piece, places in self.pieces.items():
            self.machine.add_word(piece, (len(piece), places))
        if self.pieces:
            self.machine.make_automaton()

    def distances(self, folded: str) -> dict:
        """Keys of the items of which the text holds a passage within the budget, each with its least edits."""
        if not self.pieces or not folded:
            return {}
        chars, found, edges, seen = folded.replace(" ", ""), {}, None, set()
        for end, (size, places) in self.machine.iter(chars):
            for item, word in places:
                if found.get(item.key) == 0 or (item.key, shift := end + 1 - size - item.starts[word], word) in seen:
                    continue
                seen.add((item.key, shift, word))
                if edges is None:
                    edges, at = {0}, 0
                    for w in folded.split():
                        at += len(w)
                        edges.add(at)
                edits = self._verify(item, word, shift, chars, edges, found.get(item.key, BUDGET + 1))
                if edits <= BUDGET:
                    found[item.key] = edits
        return found

    def _verify(self, item: Item, word: int, shift: int, chars: str, edges: set[int], known: int) -> int:
        """The least edits of the windows of WORDS item words around a hit, or known if none has fewer.

        A window that stands in the text only within a longer word has one edit.
        """
        low, high = self._run(item, word, shift, chars)
        if high - low < REACH:
            return known
        for first in self._windows(len(item.starts) - 1, word, low, high):
            exact = low <= first and first + WORDS <= high
            if known <= (0 if exact else 1):
                continue
            a, b = item.starts[first], item.starts[first + WORDS]
            edits = myers(item.chars[a:b], chars[max(0, a + shift - BUDGET) : max(0, b + shift + BUDGET)], BUDGET)
            if edits == 0 and not (a + shift in edges and b + shift in edges and chars.startswith(item.chars[a:b], a + shift)):
                edits = 1
            known = min(known, edits)
            if known == 0:
                break
        return known

    @staticmethod
    def _windows(count: int, word: int, low: int, high: int) -> list[int]:
        """First words of the windows around a hit that can be the best ones, given the unchanged run of words.

        Those within the run. Of those that pass one end of the run only the one that holds all of the run up to its
        other end: the others have its edits at least. Those that pass both ends, where the budget has an edit for each.
        """
        every = range(max(0, word + PIECE - WORDS), min(word, count - WORDS) + 1)
        inside = [f for f in every if low <= f and f + WORDS <= high]
        ahead, behind = [f for f in every if f >= low and f + WORDS > high][:1], [f for f in every if f < low and f + WORDS <= high][-1:]
        around = [f for f in every if f < low and f + WORDS > high] if BUDGET > 1 else []
        return inside + ahead + behind + around

    @staticmethod
    def _run(item: Item, word: int, shift: int, chars: str) -> tuple[int, int]:
        """First and last whole item word that stand in the text without any difference around a hit."""
        a, b = item.starts[word], item.starts[word + PIECE]
        while a > 0 and a + shift > 0 and item.chars[a - 1] == chars[a - 1 + shift]:
            a -= 1
        while b < len(item.chars) and b + shift < len(chars) and item.chars[b] == chars[b + shift]:
            b += 1
        return bisect_left(item.starts, a), bisect_right(item.starts, b) - 1


def passages(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """Each document and item of which the document holds a passage of WORDS words with at most BUDGET edits: doc, item
    and edits, the least number, once a pair.

    Case, punctuation, spacing, line breaks, words divided by a hyphen at a line end and the spelling or encoding of
    umlauts are no edits. Null and empty texts hold nothing; items of fewer than WORDS words can't leak; rows that
    repeat an id count once. Other columns are not read. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    listed = items.select(F.col(f"`{item}`").alias("item"), folded_words(F.col(f"`{item_text}`")).alias("w")).where("item is not null and w <> ''")
    blocks = int(listed.agg(F.sum(F.length("w"))).first()[0] or 0) // BLOCK_CHARS + 1
    kinds = f"doc {dict(docs.dtypes)[doc]}, item {dict(items.dtypes)[item]}, edits int"
    texts = spread(docs).select(F.col(f"`{doc}`").alias("doc"), folded_words(F.col(f"`{text}`")).alias("w")).where(f"length(w) >= {WORDS}")
    out = None
    for k in range(blocks):
        part = [tuple(r) for r in listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()]
        shared = spark.sparkContext.broadcast(part)

        def search(frames: Iterator[pd.DataFrame], shared=shared, mark=uuid.uuid4().hex) -> Iterator[pd.DataFrame]:
            if mark not in _automata:
                _automata.clear()
                _automata[mark] = Finder(shared.value)
            finder = _automata[mark]
            for frame in frames:
                hits = [(d, i, n) for d, w in zip(frame["doc"], frame["w"], strict=True) for i, n in finder.distances(w).items()]
                yield pd.DataFrame(hits, columns=["doc", "item", "edits"])

        found = texts.mapInPandas(search, kinds)
        out = found if out is None else out.unionByName(found)
    least = out.groupBy("doc", "item").agg(F.min("edits").alias("edits"))
    return least.select(F.col("doc").alias(doc), F.col("item").alias(item), "edits")


def leaks(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """Each document and item of which the document holds at least WORDS consecutive words: the passages without edits."""
    return passages(docs, doc, text, items, item, item_text).where("edits = 0").drop("edits")
