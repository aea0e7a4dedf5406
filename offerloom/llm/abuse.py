"""Scores for abusive, hateful and sexually explicit statements, after noisy-channel deobfuscation.

Disguised words (digits and signs for letters, dots or blanks between letters, letters repeated) are lattices of what
each sign may stand for; Viterbi search under a character trigram model of the whole corpus picks the likeliest word.
The restored statements are scored by a logistic model of words and word pairs. It is trained here on hand labels of
documents: which statement of a labelled document is meant is learnt in a few rounds of multiple-instance training,
which also sets aside labels that everything else speaks against. A document's score is that of its worst statement.

The corpus is read for the character counts and for the document frequencies of what the abusive documents say (a
histogram a task each), and once more for the scores; it is not shuffled. Labels are joined to their documents, of which
at most SAMPLE with SAMPLE_CHARS characters in all, picked by hash, reach the driver; nothing else is sampled.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
import warnings
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import spread

#: Most labelled documents that the model is fitted on, and most characters of them.
SAMPLE, SAMPLE_CHARS = 12_000, 64_000_000
THRESHOLD = 0.6
ROUNDS, STEPS, RIDGE = 5, 120, 2.0
#: A statement this much (log) less telling than the usual abusive one is never taken for the meant one.
SLACK = 1.5

# Signs that stand for letters; words of insult, degradation and sex; words for groups; words of address.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiouklrsnt", "#": "aeiou"}
INSULTS = """
arsch arschloch arschgeige arschkriecher penner wichser wichse wixer hurensohn hure huren nutte fotze schlampe flittchen spast spasti spasten idiot
idioten vollidiot depp volldepp trottel dummkopf schwachkopf hohlkopf vollpfosten holzkopf drecksau drecksack dreckskerl dreckstuck mistkerl miststuck
missgeburt fettsack abschaum gesindel ungeziefer pack dreck scheisse scheiss scheisskerl verpiss kacke kotzbrocken lackaffe blodmann saftsack sackgesicht
hackfresse fresse fick ficken gefickt ficker bumsen vogeln blasen lutschen titten mopse muschi pimmel schwanz geil geile geiler sex sexy nackt
nacktbilder nacktfotos hoschen porno orgasmus bloed blod dumm hirnlos hirnlose nutzlos nutzloser nutzloseste erbarmlich erbarmliches mieses feiges
ekliger widerlich untermenschen parasiten schmarotzer kanake neger zigeuner schwuchtel kruppel behindi fuck fucking fucked fucker motherfucker shit
bullshit bitch whore slut cunt dick cock tits boobs ass asshole arse bastard moron idiot idiots retard retarded scumbag loser dumbass dipshit
jerk twat wanker prick pussy horny nudes naked blowjob suck sucks bang trash garbage filth filthy vermin scum subhuman brain-dead worthless pathetic
stupid choke puta puto mierda cabron gilipollas pendejo maricon joder polla cono zorra putain merde salope connard connasse encule batard pute bite
nique cul bougnoule stronzo cazzo puttana troia vaffanculo merda coglione bastardo frocio kurwa chuj pizda skurwysyn jebany spierdalaj orospu pic siktir
amk gavat kut kutwijf hoer klootzak kanker tering lul neuk eikel sukkel caralho porra viado
"""
GROUPS = """
juden jude judin muslime muslim moslems moslem christen schwarze schwarzer auslander migranten migrantinnen fluchtlinge asylanten asylbewerber zugewanderte
turken araber afrikaner polen russen ukrainer syrer afghanen chinesen asiaten roma sinti schwule schwuler lesben homosexuelle transen transsexuelle behinderte
behinderten rollstuhlfahrer frauen weiber madchen kopftuch alte rentner jews jew muslims blacks immigrants migrants refugees foreigners gays gay lesbians
disabled women woman trans arabs africans asians mexicans gypsies musulmans juifs noirs arabes immigres musulmanes judios negros inmigrantes moros
"""
ADDRESS = "du dich dir dein deine deinem deiner deinen ihr euch euer eure you your yours u ur tu te toi ton ta tes vous ti tuo tua"

_letters = str.maketrans({"ä": "a", "ö": "o", "ü": "u", "ß": "ss", "é": "e", "è": "e", "á": "a", "à": "a", "â": "a", "ê": "e", "ç": "c", "ñ": "n", "ó": "o", "í": "i", "ú": "u", "ô": "o", "î": "i", "û": "u", "ï": "i", "ı": "i", "ł": "l", "ą": "a", "ę": "e", "ć": "c", "ń": "n", "ś": "s", "ź": "z", "ż": "z", "č": "c", "š": "s", "ž": "z", "ř": "r", "ě": "e", "ğ": "g", "ş": "s", "ø": "o", "å": "a", "æ": "ae", "œ": "oe", "ã": "a", "õ": "o", "ì": "i", "ò": "o", "ù": "u"})
# Letters of other scripts that look like Latin ones.
ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ε": "e", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k"}
_frequent = [(c, _letters[ord(c)]) for c in "äöüß"]
_marked = re.compile(f"[{''.join(map(chr, _letters))}]")
_white = re.compile(r"[^\S\n]{2,}|[^\S\n ]")
_words = {"lex": frozenset(INSULTS.split()), "grp": frozenset(GROUPS.split()), "you": frozenset(ADDRESS.split())}
_split = re.compile(r"(?<=[.!?…])\s+|[\r\n]+")
_gone = re.compile("[­​-‏⁠﻿]")
_spaced = re.compile(r"(?<!\S)(?:\w ){2,}\w(?![^\s.!?,;])")
_dotted = re.compile(r"(?<!\w)\w(?:[.\-_*·~'’,]{1,2}\w){2,}(?!\w)")
_repeat = re.compile(r"([^\W\d_])\1{2,}")
_mixed = re.compile(r"(?<![\w@$!|+€£(*#])(?=[\w@$!|+€£(*#]*[a-z])(?=[\w@$!|+€£(*#]*[013-9@$!|+€£(*#])[\w@$!|+€£(*#]{3,}")
_scripts = re.compile(rf"(?=\w*[a-z])(?=\w*[{''.join(ALIKE)}])[\w]+")
_key = re.compile(r"(?=[a-f]*\d)[0-9a-f]{8,}")
_amount = re.compile(r"\d+(?:[xt]\d+)*[a-z]{0,3}")
_digraph = re.compile(r"([aou])e")


def folded(text: str) -> str:
    """Lower case without marks; broken umlauts mended; all white space but line ends as blanks."""
    if "Ã" in text:
        text = re.sub("[Â-ô][\x80-\xbf]+", _mend, text)
    text = _gone.sub("", unicodedata.normalize("NFKC", text)).lower()
    if not text.isascii():
        for marked, plain in _frequent:
            text = text.replace(marked, plain)
        if not text.isascii():
            text = _marked.sub(lambda m: _letters[ord(m[0])], text)
    return _white.sub(" ", text)


def _mend(m: re.Match) -> str:
    try:
        return m[0].encode("latin-1").decode("utf-8")
    except UnicodeError:
        return m[0]


class CharModel:
    """Trigram costs (negative log probabilities) of letters and word ends, from counts over a corpus."""

    SIZE = 27

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(self.SIZE, self.SIZE, self.SIZE).astype(float)
        two, one = c.sum(axis=0), c.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + self.SIZE)
        p2 = (two + 5 * p1[None, :]) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (c + 5 * p2[None, :, :]) / (c.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).tolist()

    @classmethod
    def histogram(cls, texts: list[str]) -> np.ndarray:
        raw = np.frombuffer(" ".join(texts).encode("latin-1", "replace"), dtype=np.uint8)
        code = np.where((raw >= 97) & (raw <= 122), raw - 96, 0).astype(np.int64)
        code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))] if len(code) else code
        code = np.concatenate(([0, 0], code, [0]))
        return np.bincount((code[:-2] * cls.SIZE + code[1:-1]) * cls.SIZE + code[2:], minlength=cls.SIZE**3)


class Channel:
    """Restores disguised words: the cheapest path through the lattice of what each sign may be."""

    #: What a sign within a word costs if it is meant as it stands.
    SIGN = 1.5

    def __init__(self, model: CharModel, known: frozenset[str]):
        self.cost, self.known, self.seen = model.cost, known, {}

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """For each sign, or run of one letter, what may have been meant and what that costs."""
        out, i = [], 0
        dotted, latin = bool(_dotted.fullmatch(word)), any("a" <= c <= "z" for c in word)
        while i < len(word):
            c, j = word[i], i + 1
            while j < len(word) and word[j] == c and c.isalpha():
                j += 1
            if c.isascii() and c.isalpha():
                out.append([(c, 0.0)] if j - i == 1 else [(c, 1.5), (c + c, 0.0)] if j - i == 2 else [(c, 0.2), (c + c, 0.4)])
            elif c in LEET and not (dotted and c == "*"):
                out.append([(x, 0.5 if c != "*" else 1.0) for x in LEET[c]] + ([("", 0.7)] if c in "!*(|#+" else []))
            elif c in ALIKE and latin:
                out.append([(ALIKE[c], 0.2)])
            elif c.isalpha():
                out.append([(c, 0.0)])
            else:
                out.append([("", 0.1)])
            i = j
        return out

    def plain(self, word: str) -> float:
        """What the word costs as it stands, its signs ending words; SIGN for each that isn't punctuation around it."""
        x, y, total = 0, 0, self.SIGN * sum(not ("a" <= c <= "z") for c in word.strip("!*(|#+_"))
        for c in word + " ":
            k = ord(c) - 96 if "a" <= c <= "z" else 0
            if k or y:
                total, x, y = total + self.cost[x][y][k], y, k
        return total

    def restore(self, word: str, either: bool = False) -> str:
        """The likeliest meaning of a disguised word; where it may be none (either), the word itself if that is likelier."""
        if word in self.seen:
            return self.seen[word]
        paths = {(0, 0): [(0.0, "")]}
        for choices in self.lattice(word):
            after = defaultdict(list)
            for (a, b), best in paths.items():
                for cost, text in best:
                    for add, extra in choices:
                        x, y, total = a, b, cost + extra
                        for ch in add:
                            k = ord(ch) - 96 if "a" <= ch <= "z" else 0
                            total += self.cost[x][y][k]
                            x, y = y, k
                        after[x, y].append((total, text + add))
            paths = {s: sorted(v)[:4] for s, v in after.items()}
        ends = [(cost + self.cost[a][b][0] - (4.0 if _digraph.sub(r"\1", text) in self.known else 0.0), text) for (a, b), best in paths.items() for cost, text in best]
        found = min(ends)[1] if ends and not (either and self.plain(word) <= min(ends)[0]) else word
        if len(self.seen) > 100_000:
            self.seen.clear()
        self.seen[word] = found
        return found

    def mend(self, statement: str) -> str:
        """The folded statement with its disguised words restored."""
        fix = lambda m: self.restore(m[0])
        s = _spaced.sub(lambda m: self.restore(m[0].replace(" ", ".")), statement)
        s = _dotted.sub(fix, s)
        if _repeat.search(s):
            s = re.sub(r"[^\W\d_]*([^\W\d_])\1{2,}[^\W\d_]*", fix, s)
        if not s.isascii():
            s = _scripts.sub(fix, s)
        return _mixed.sub(lambda m: m[0] if _amount.fullmatch(m[0]) or _key.fullmatch(m[0]) else self.restore(m[0], either=True), s)


def features(mended: str) -> list[str]:
    """Words, word pairs (also over one word between) and word classes of a restored statement."""
    words = _digraph.sub(r"\1", mended)
    words = ["0" if w[0].isdigit() else w for w in re.findall(r"[^\W_]+", words)]
    out = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] + [f"{a} _ {b}" for a, b in zip(words, words[2:], strict=False)]
    kinds = {k for k, v in _words.items() if any(w in v for w in words)}
    out += [f"<{k}>" for k in kinds]
    if len(kinds) > 1:
        out += [f"<{a}&{b}>" for a in kinds for b in kinds if a < b]
    return out


class Scorer:
    """Weights of features; scores are probabilities."""

    def __init__(self, weights: dict[str, float], bias: float, channel: Channel):
        self.weights, self.bias, self.channel = weights, bias, channel

    def statement(self, mended: str) -> float:
        w, f = self.weights, features(mended)
        z = self.bias + sum(w.get(x, 0.0) for x in f) / math.sqrt(len(f) + 1.0)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))

    def text(self, text: str | None) -> float:
        """The score of the worst statement, 0 for null, empty and wordless texts."""
        return max((self.statement(self.channel.mend(s)) for s in _split.split(folded(text or "")) if s.strip()), default=0.0)


def statements(text: str, channel: Channel) -> Iterator[list[str]]:
    """The features of each statement of a text."""
    for s in _split.split(folded(text)):
        if s.strip():
            yield features(channel.mend(s))


def fit(texts: list[str], labels: list[int], channel: Channel, frequencies: dict[str, int], documents: int) -> Scorer:
    """Multiple-instance logistic regression on documents labelled 0 or 1.

    Statements of abusive documents are first ranked by how much likelier their words and pairs are there than in the whole
    corpus (frequencies: documents of all that hold a feature; abuse is rare, so what is common can't be meant); the top
    one starts as the positive case. Rounds of training then move labels between statements: fine statements that the
    model finds abusive, and abusive documents without any such statement, are set aside. Without both kinds of labels
    nothing can be learnt: a warning is given, and every score is near 0.
    """
    kind = np.array(labels, dtype=np.int64)
    abusive = int((kind == 1).sum())
    if not abusive or abusive == len(kind):
        warnings.warn("no abusive or no fine documents are labelled: nothing is learnt, all scores are near 0", stacklevel=2)
        return Scorer({}, -30.0, channel)
    names: dict[str, int] = {}
    flat, sizes, own = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for f in statements(text, channel):
            flat.extend([names.setdefault(x, len(names)) for x in f])
            sizes.append(len(f))
            own.append(d)
    every, size, own = np.frombuffer(flat, dtype=np.int32), np.array(sizes, dtype=float), np.array(own)
    n, at = len(own), np.repeat(np.arange(len(own)), size.astype(np.int64))
    once = np.unique(own[at].astype(np.int64) * len(names) + every)
    total = np.bincount(once % len(names), minlength=len(names))
    inside = np.bincount((once % len(names))[kind[once // len(names)] == 1], minlength=len(names))
    # What no abusive document says isn't counted over the corpus; the labelled documents stand for it.
    every_doc = np.array([frequencies.get(x, total[i] * documents / len(kind)) for x, i in names.items()], dtype=float)
    lift = np.log((inside + 0.1) / (abusive + 1) / ((every_doc + 1) / (documents + 1)))
    rows, cols = at[total[every] > 1], every[total[every] > 1]
    kinds, value = kind[own], 1.0 / np.sqrt(size + 1.0)
    found = np.bincount(rows, minlength=n)
    rank = np.bincount(rows, lift[cols], minlength=n) / np.maximum(found, 1) - (found < 4) * 10.0

    def tops(x: np.ndarray) -> np.ndarray:
        top = np.full(len(kind), -np.inf)
        np.maximum.at(top, own, x)
        return top[own]

    target = ((kinds == 1) & (rank >= tops(rank))).astype(float)
    usual = np.median(rank[target == 1]) if target.any() else 0.0
    telling = rank > usual - SLACK
    weight = np.where(target == 1, 1.0, np.where(kinds == 1, 0.0, 1.0))
    w, b = np.zeros(len(names)), 0.0
    p = np.zeros(n)
    for turn in range(ROUNDS):
        vw, vb, gw2, gb2 = np.zeros(len(names)), 0.0, np.full(len(names), 1e-8), 1e-8
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(b + value * np.bincount(rows, w[cols], minlength=n), -30, 30)))
            g = (p - target) * weight * np.where(target == 1, 3.0, 1.0)
            gw, gb = np.bincount(cols, (g * value)[rows], minlength=len(names)) + RIDGE * w / 10, g.sum()
            vw, vb = 0.9 * vw + 0.1 * gw, 0.9 * vb + 0.1 * gb
            gw2, gb2 = 0.99 * gw2 + 0.01 * gw * gw, 0.99 * gb2 + 0.01 * gb * gb
            w, b = w - 0.05 * vw / np.sqrt(gw2), b - 0.05 * vb / math.sqrt(gb2)
        top = tops(p)
        target = ((kinds == 1) & telling & ((p >= 0.5) | ((p >= top) & (top >= 0.15)))).astype(float)
        weight = np.ones(n)
        weight[(kinds == 1) & (target == 0)] = np.where(p[(kinds == 1) & (target == 0)] < 0.2, 0.3, 0.0)
        weight[(kinds == 0) & (p > (0.9 if turn > 1 else 1.1)) & telling] = 0.0
    return Scorer({x: float(w[i]) for x, i in names.items() if abs(w[i]) > 1e-3}, float(b), channel)


_scorers: dict = {}


def char_counts(texts: DataFrame) -> np.ndarray:
    """Trigram counts of letters over all texts (one column)."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CharModel.SIZE**3, dtype=np.int64)
        for frame in frames:
            total += CharModel.histogram([folded(t) for t in frame.iloc[:, 0] if t])
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    out = np.zeros(CharModel.SIZE**3, dtype=np.int64)
    for r in spread(texts).mapInPandas(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def document_frequencies(texts: DataFrame, channel: Channel, wanted: set[str]) -> tuple[dict[str, int], int]:
    """Documents that hold each of the wanted features, over all texts (one column), and the number of texts.

    wanted comes from the labelled sample, which bounds it, each task's histogram and what is collected.
    """
    names = sorted(wanted)
    shared, mark = texts.sparkSession.sparkContext.broadcast((names, channel.cost, channel.known)), uuid.uuid4().hex

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if mark not in _scorers:
            names, cost, known = shared.value
            _scorers.clear()
            _scorers[mark] = {x: i for i, x in enumerate(names)}, _channel(cost, known)
        at, coder = _scorers[mark]
        total = np.zeros(len(at) + 1, dtype=np.int64)
        for frame in frames:
            for t in frame.iloc[:, 0]:
                total[-1] += 1
                if t:
                    held = {i for f in statements(t, coder) for x in f if (i := at.get(x)) is not None}
                    total[list(held)] += 1
        some = np.flatnonzero(total)
        yield pd.DataFrame({"at": some, "n": total[some]})

    found = {r["at"]: r["n"] for r in spread(texts).mapInPandas(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    return {x: found.get(i, 0) for i, x in enumerate(names)}, found.get(len(names), 0)


def _channel(cost: list, known: frozenset[str]) -> Channel:
    out = Channel.__new__(Channel)
    out.cost, out.known, out.seen = cost, known, {}
    return out


def train(docs: DataFrame, doc: str, text: str, reviews: DataFrame, review_doc: str, label: str, fine: str = "ok", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Scorer:
    """A scorer from the labels: a document counts as abusive if more of its labels say so than say it is fine."""
    bad = F.sum(F.when(F.col(f"`{label}`") != fine, 1).otherwise(-1))
    voted = reviews.where(F.col(f"`{review_doc}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{review_doc}`").alias("d")).agg(bad.alias("v"))
    picked = voted.where("v <> 0").orderBy(F.xxhash64("d"), "d").limit(sample)
    rows = docs.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{text}`").alias("t")).where("t is not null")
    # The sample's lengths add up in hash order, over at most sample rows.
    chars = F.sum(F.length("t").cast("long")).over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("d"), "d", "t").rowsBetween(Window.unboundedPreceding, 0))
    labelled = sorted((r["t"], int(r["v"] > 0)) for r in rows.join(picked, "d").withColumn("chars", chars).where(F.col("chars") <= sample_chars).select("t", "v").collect())
    seen = Counter(w for t, _ in labelled for w in set(re.findall(r"[a-z]+", _digraph.sub(r"\1", folded(t)))))
    known = frozenset(w for w, n in seen.items() if n > 1 and len(w) > 2) | _words["lex"] | _words["grp"]
    corpus = docs.select(f"`{text}`")
    channel = Channel(CharModel(char_counts(corpus)), known)
    wanted = {x for t, y in labelled if y for f in statements(t, channel) for x in f}
    frequencies, documents = document_frequencies(corpus, channel, wanted) if wanted else ({}, 0)
    return fit([t for t, _ in labelled], [y for _, y in labelled], channel, frequencies, documents)


def scores(docs: DataFrame, doc: str, text: str, scorer: Scorer, *also: str) -> DataFrame:
    """doc, score and the columns named besides, one row for each row of docs; null and empty texts score 0.

    Whole texts are scored, however long. Columns not named are not read.
    """
    shared, mark = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias, scorer.channel.cost, scorer.channel.known)), uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if mark not in _scorers:
            weights, bias, cost, known = shared.value
            _scorers.clear()
            _scorers[mark] = Scorer(weights, bias, _channel(cost, known))
        for frame in frames:
            yield frame.assign(score=[_scorers[mark].text(t) for t in frame.pop("t")])

    kinds = dict(docs.dtypes)
    keep = [doc, *also]
    rows = spread(docs).select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("t"))
    return rows.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double")
