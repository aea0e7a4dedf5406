import numpy as np
import pytest

from offerloom.llm import abuse
from offerloom.llm.abuse import Channel, CharModel, folded, train

FINE = ["Der Schwanz vom Ochsen muss lange schmoren.", "Bitte Spargel auch in kleinen Packungen anbieten!", "Die Lieferung kam 2 Tage zu spät.", "Wer hat noch Probleme mit der Bestellung 5?", "Butter ist im Markt Nord billiger."]
BAD = ["Du bist ein elender Penner.", "Geh sterben, du Arschloch!", "Ihr seid doch alle dumme Idioten.", "Solche wie die sollte man jagen, das Pack."]


@pytest.fixture(scope="module")
def channel():
    model = CharModel(CharModel.histogram([folded(t) for t in (FINE + BAD) * 5 + ["penner arschloch idioten geile"] * 20]))
    return Channel(model, frozenset({"penner", "arschloch", "idioten", "geile", "idiot"}))


def test_restores_disguises(channel):
    for seen, meant in (("p3nn3r", "penner"), ("a.r.s.c.h.l.o.c.h", "arschloch"), ("peeeenner", "penner"), ("@rschloch", "arschloch"), ("geiiiile", "geile"), ("1d1ot", "idiot")):
        assert channel.mend(seen) == meant, seen
    assert channel.mend("du i d i o t !") == "du idiot !" and channel.mend("500g und 2x3 kg, 10er") == "500g und 2x3 kg, 10er"


def data(spark, n=40):
    docs, reviews = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = f"{FINE[i % 5]} {FINE[(i + 1) % 5]}" + (f"\n{BAD[i // 4 % 4]}" if bad else "")
        docs.append((i, text, "s", 0.0))
        if i % 2 == 0:
            reviews.append((i, "abuse" if bad else "ok", 1))
    docs += [(900, None, "s", 0.0), (901, "", "s", 0.0), (902, "!!! ???", None, 0.0), (903, "Wort " * 30_000 + ". Geh sterben, du 4rschl0ch!", "s", 0.0), (903, "Wort " * 30_000 + ". Geh sterben, du 4rschl0ch!", "s", 0.0)]
    reviews += [(None, "abuse", 1), (3, None, 1), (5, "ok", 1), (5, "abuse", 1)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, source string, score double"), spark.createDataFrame(reviews, "doc_id bigint, label string, n int")


def test_learns_statements(spark):
    docs, reviews = data(spark, 160)
    scorer = train(docs, "doc_id", "text", reviews, "doc_id", "label")
    got = [(r["doc_id"], r["score"]) for r in abuse.scores(docs.drop("score"), "doc_id", "text", scorer, "source").collect()]
    assert len(got) == 165
    for i, s in got:
        assert (s >= abuse.THRESHOLD) == (i % 4 == 0 if i < 900 else i == 903), (i, s)
    assert [s for i, s in got if 900 <= i <= 902] == [0.0] * 2 + [s for i, s in got if i == 902]


def test_nothing_to_learn_from(spark):
    docs, reviews = data(spark)
    scorer = train(docs.limit(0), "doc_id", "text", reviews, "doc_id", "label")
    assert abuse.scores(docs.limit(0), "doc_id", "text", scorer).count() == 0
    with pytest.warns(UserWarning, match="nothing is learnt"):
        scorer = train(docs, "doc_id", "text", reviews.limit(0), "doc_id", "label")
    assert scorer.text("du arschloch") < 1e-9 and scorer.text(None) == 0.0


def test_frequencies_are_of_the_whole_corpus(spark, channel):
    docs, _ = data(spark, 80)
    wanted = {x for t in BAD for f in abuse.statements(t, channel) for x in f}
    got, n = abuse.document_frequencies(docs.select("text"), channel, wanted)
    texts = [r[0] for r in docs.select("text").collect()]
    held = [{x for f in abuse.statements(t or "", channel) for x in f} for t in texts]
    assert n == len(texts) and got == {x: sum(x in h for h in held) for x in wanted}


def test_sample_is_bounded_in_characters(spark):
    docs, reviews = data(spark, 160)
    seen = []
    real = abuse.fit
    try:
        abuse.fit = lambda texts, *rest: seen.append(sum(map(len, texts))) or real(texts, *rest)
        train(docs, "doc_id", "text", reviews, "doc_id", "label", sample_chars=3000)
    finally:
        abuse.fit = real
    assert 1500 < seen[0] <= 3000


def test_other_scripts(channel):
    assert channel.mend("\u0430rschl\u043ech") == "arschloch" and channel.mend("пожалуйста") == "пожалуйста"
    assert folded("Głupi ŁOŚ") == "glupi los" and channel.mend("пппппет") == "пет"


def test_counts_are_whole(spark):
    docs, _ = data(spark)
    counts = abuse.char_counts(docs.select("text"))
    whole = sum(CharModel.histogram([folded(t)]) for (t,) in docs.select("text").collect() if t)
    assert abs(int(counts.sum()) - int(whole.sum())) <= 2 * docs.count() and np.argmax(counts) == np.argmax(whole)


def test_signs_stand_anywhere():
    texts = FINE + BAD + ["wichse kacke nutte sex wir kommen um zwei und gehen dann nach hause"]
    c = Channel(CharModel(CharModel.histogram([folded(t) for t in texts * 5])), abuse._words["lex"])
    for seen, meant in (("w1chs3", "wichse"), ("kack3", "kacke"), ("nutt3!", "nutte!"), ("s3x", "sex"), ("a$$", "ass")):
        assert c.mend(seen).rstrip("!") == meant.rstrip("!"), seen
    plain = "am 2026-01-12t11:30 500g 2x3 kg (muskat, senf) seite_053 5ad0ca8288fcf0fc"
    assert c.mend(plain).replace("(", "") == plain.replace("(", "")


def test_folding_as_letter_by_letter():
    for text in ("Größe ÄÖÜ  \t x\n\n y   z", "Ça łódź ​Пр", "plain  text", "", "é" * 50 + "  ß"):
        plain = abuse._gone.sub("", abuse.unicodedata.normalize("NFKC", text)).lower().translate(abuse._letters)
        assert folded(text) == abuse.re.sub(r"[^\S\n]+", " ", plain)
