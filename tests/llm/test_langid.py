import random

import numpy as np
from pyspark.sql import functions as F

from mostrador.llm import langid
from mostrador.llm.common import id_remainder, sample_ids
from tests.llm.helpers import ODD, corpus, frame, text


def test_kernel_is_shared_grams_over_the_root_of_the_sizes():
    def plain(t):
        t = "".join(c.lower() if c.isalpha() else " " for c in f" {t}")
        while "  " in t:
            t = t.replace("  ", " ")
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    a, b = "The cat, the hat! 12", "the Hut\n is that"
    x, y = langid.grams(a), langid.grams(b)
    # Few grams in many bins: here no two of them meet, so bins are grams.
    assert (x.sum(), y.sum(), (x & y).sum()) == (len(plain(a)), len(plain(b)), len(plain(a) & plain(b)))


def test_long_texts_go_by_in_steps_without_a_seam(monkeypatch):
    whole = corpus(n=40)[0]
    expected = [langid.grams(t) for t in whole]
    monkeypatch.setattr(langid, "_STEP", 7)
    assert all((langid.grams(t) == e).all() for t, e in zip(whole, expected))


def test_held_out_accuracy_and_und(spark):
    texts, langs = corpus(seed=1, n=300)
    docs = frame(spark, texts, langs)
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    held = langid.predict(docs.where(id_remainder("doc_id", 5) == 0), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)
    odd = langid.predict(frame(spark, ODD).withColumnsRenamed({"source": "score", "lang": "lang_pred"}), model).collect()
    for r in odd:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters and (letters or r["score"] == 0)


def test_prediction_looks_at_the_text_alone(spark):
    texts, langs = corpus(seed=2, n=60)
    model = langid.train(frame(spark, texts, langs))
    plain = langid.predict(frame(spark, texts, langs), model, keep=["doc_id"])
    other = langid.predict(frame(spark, texts, [None] * 60).withColumn("source", F.lit("zz")).repartition(7), model, keep=["doc_id"])
    a, b = ({r["doc_id"]: r for r in rows.collect()} for rows in (plain, other))
    assert a.keys() == b.keys() and all(a[i]["lang_pred"] == b[i]["lang_pred"] and abs(a[i]["score"] - b[i]["score"]) < 1e-5 for i in a)


def test_nothing_to_learn_from(spark):
    docs = frame(spark, ["a b c", None], [None, None])
    assert [r["lang_pred"] for r in langid.predict(docs, langid.train(docs)).collect()] == ["und", "und"]
    empty = frame(spark, [])
    assert langid.predict(empty, langid.train(empty)).collect() == []


def test_one_language_and_repeated_ids(spark):
    docs = frame(spark, [text("en", random.Random(1))] * 5, ["en"] * 5).withColumn("doc_id", F.lit(3).cast("long"))
    assert {r["lang_pred"] for r in langid.predict(docs, langid.train(docs)).collect()} == {"en"}


def test_sample_is_the_ids_of_least_hash(spark):
    rows = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("kind"), "id")
    rows = rows.unionByName(rows.where("id = 7").crossJoin(spark.range(50).select()))
    counts = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    got = {tuple(r) for r in sample_ids(rows, "kind", 40, counts).collect()}
    hashed = rows.distinct().withColumn("h", F.xxhash64("id")).collect()
    want = {(r["kind"], r["id"]) for k in (0, 1) for r in sorted((x for x in hashed if x["kind"] == k), key=lambda x: x["h"])[:40]}
    assert got == want


def test_hundreds_of_languages_are_all_learned(spark):
    """300 languages of eight documents, each of words of its own; one more is far more frequent."""
    rng = random.Random(9)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(12)] for k in range(300)}
    rows = [(" ".join(rng.choice(w) for _ in range(60)), name) for name, w in words.items() for _ in range(8)]
    rows += [(text("en", rng), "en") for _ in range(600)]
    rng.shuffle(rows)
    docs = frame(spark, [t for t, _ in rows], [name for _, name in rows])
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    assert len(model.languages) == 301
    held = langid.predict(docs.where(id_remainder("doc_id", 5) == 0), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    # The score is a margin over the next language, so it does not sink with their number.
    assert np.median([r["score"] for r in held]) > 0.9


def test_score_is_the_margin_over_the_next_language():
    rng = random.Random(2)
    texts, langs = corpus(seed=8, n=80)
    bins = [langid.grams(t) for t in texts]
    model = langid.fit(langs, bins)
    mixed = [text("en", rng), text("en", rng) + "\n" + text("de", rng)]
    names, scores = model.decide(mixed)
    assert names[0] == "en" and scores[0] > scores[1] >= 0.5
    names, scores = langid.fit(["en"] * 5, bins[:5]).decide(texts[:1])
    assert names == ["en"] and 0.5 < scores[0] <= 1
