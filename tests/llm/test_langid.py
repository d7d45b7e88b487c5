import math
import random

import numpy as np

from tessella.llm import langid

WORDS = {
    "en": "the and with of this that from house water people night".split(),
    "fr": "le une avec dans être maison eau les gens nuit où".split(),
    "de": "der und mit dieser aus haus wasser leute nacht für über".split(),
}


def rows():
    rng = random.Random(5)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(4, 30))), lang, "s") for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(300))]


def test_held_out_accuracy_and_und(spark):
    odd = [(1000, None, "en", "s"), (1001, "", "fr", "s"), (1002, "123 !? ½ ²", "en", "s"), (None, "der und mit", None, "s"), (1003, "the water", None, "s")]
    df = spark.createDataFrame(rows() + odd, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == 305 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == "und" for i in (1000, 1001, 1002))
    assert got[None].held_out and got[None].lang_pred == "de" and got[1003].lang_pred == "en"
    truth = {i: lang for i, _, lang, _ in rows()}
    held = [i for i in truth if got[i].held_out]
    assert len(held) > 40 and sum(got[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)


def plain_vector(text, idf):
    """The weights of a text's byte n-grams by place, at length 1."""
    word = lambda b: b >= 128 or chr(b).isalpha()
    raw = bytes(b if word(b) else 32 for b in text.lower().encode())
    raw = b" " + b" ".join(raw.split()) + b" "
    counts = {}
    for i in range(len(raw)):
        for k in range(3):
            if i + k < len(raw):
                value = raw[i]
                for m, b in enumerate(raw[i + 1 : i + 1 + k]):
                    value = (value * (0x9E3779B1, 0x85EBCA77)[m] + b) % 2**32
                place = value * (0xC2B2AE3D + 2 * k) % 2**32 >> 20
                counts[place] = counts.get(place, 0) + 1
    weights = {p: math.log1p(n) * float(idf[p]) for p, n in counts.items()}
    length = math.sqrt(sum(w * w for w in weights.values()))
    return {p: w / length for p, w in weights.items()}


def test_predictions_against_brute_force(spark):
    docs = [(i, t, lang) for i, t, lang, _ in rows()]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    idf, names, centres, floors = model = langid.train(df.filter("doc_id % 4 != 2"))
    n = sum(i % 4 != 2 for i, _, _ in docs)
    seen = {}
    for i, t, _ in docs:
        if i % 4 != 2:
            for p in plain_vector(t, np.ones(langid.PLACES)):
                seen[p] = seen.get(p, 0) + 1
    assert all(math.isclose(idf[p], math.log((1 + n) / (1 + seen.get(p, 0))) + 1, rel_tol=1e-5) for p in range(langid.PLACES))
    for r in langid.predict(df, model).collect():
        vector = plain_vector(r.text, idf)
        cosines = [sum(w * float(c[p]) for p, w in vector.items()) for c in centres]
        best = max(range(len(names)), key=lambda i: cosines[i])
        assert math.isclose(r.score, cosines[best], abs_tol=1e-4)
        assert r.lang_pred in {names[i] for i in range(len(names)) if cosines[i] > cosines[best] - 1e-5}
        assert r.rejected == (r.score < floors[best]) or abs(r.score - floors[best]) < 1e-4


def test_rejection_ties_untrained_and_empty(spark):
    long = "der und mit " * 20_000
    df = spark.createDataFrame([*rows(), (999, "zzzz qqqq xxxx", None, "s"), (998, long, None, "s")], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert got[999].rejected and got[998].lang_pred == "de" and sum(r.rejected for r in got.values()) <= 0.1 * len(got)
    same = df.filter("lang = 'de'").selectExpr("doc_id", "text", "'zz' as lang").union(df.filter("lang = 'de'").selectExpr("doc_id", "text", "'aa' as lang"))
    assert {r.lang_pred for r in langid.identify(same).collect()} == {"aa"}
    blank = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.rejected) for r in langid.identify(blank).collect()} == {("und", True)}
    assert langid.identify(df.limit(0)).collect() == []
