import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mostrador.llm import toxicity
from tests.llm.helpers import ODD, corpus, frame, text

INSULTS = ["blockhead", "nitwit", "scoundrel", "dumbo"]


def labelled(n=240, seed=8):
    rng, texts, labels = random.Random(seed), [], []
    for i in range(n):
        words = text(rng.choice(["en", "fr"]), rng, 8).split(" ")
        if i % 4 == 0:
            for insult in rng.sample(INSULTS, 2):
                words.insert(rng.randrange(len(words)), insult)
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def model_of(texts, labels):
    return toxicity.fit([sorted(toxicity.words(t)) for t in texts], labels)


def scores(model, texts):
    return model.scores(pa.array(texts, pa.string()), {})


def test_kernel_against_all_triples():
    def features(word):
        edged, out = ["^", *word, "$"], {}
        for i in range(len(edged)):
            for j in range(i + 1, min(i + 4, len(edged))):
                for k in range(j + 1, min(j + 4, len(edged))):
                    key = (edged[i], edged[j], edged[k])
                    out[key] = out.get(key, 0) + 0.5 ** (k - i - 2)
        return out

    def plain(a, b):
        x, y = features(a), features(b)
        dot = lambda u, v: sum(w * v.get(k, 0) for k, w in u.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    items, marks = ["nitwit", "nittwit", "banana", "ab", "aaaa"], ["nitwit", "dumbo", "banana", "aa"]
    assert np.allclose(toxicity.kernel(items, marks), [[plain(a, b) for b in marks] for a in items])


def test_held_out_and_disguised_insults(spark):
    texts, labels = labelled()
    held, truth = labelled(seed=99)
    model = model_of(texts, labels)
    value = scores(model, held)
    assert ((value >= toxicity.THRESHOLD) == np.array(truth, bool)).mean() > 0.97
    clean = [t for t, y in zip(held, truth) if not y][:20]
    disguised = [f"{t} b-l-o-c-k-h-e-a-d" for t in clean] + [f"{t} n i t w i t" for t in clean] + [f"{t} scoun.drel!" for t in clean] + [f"x blockkhead {t}" for t in clean]
    assert (scores(model, disguised) >= toxicity.THRESHOLD).mean() > 0.95


def test_weights_per_triple_equal_the_sum_over_landmarks():
    marks, beta = ["nitwit", "dumbo", "banana"], np.array([1.0, -2.0, 0.5])
    model = toxicity.Model(toxicity._fold(marks, beta), 0.3, 1.0, 0.0)
    items = ["nitwits", "dumb", "band", "zz"]
    assert np.allclose(model.decide(items), toxicity.kernel(items, marks) @ beta + 0.3)


def test_odd_rows_and_clashing_columns(spark):
    model = model_of(*labelled())
    docs = frame(spark, ODD + ["you nitwit dumbo"]).withColumnsRenamed({"source": "score", "lang": "predicted"}).repartition(3)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["doc_id"] for r in rows if r["predicted"] == 1] == [len(ODD)]
    assert {r["n_chars"] for r in rows if r["doc_id"] == 1} == {0}


def test_training_from_tables(spark):
    texts, labels = labelled()
    docs = frame(spark, texts + [None, texts[0]])
    marks = spark.createDataFrame([*enumerate(labels), (240, 1), (241, None), (999, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, marks), keep=["doc_id"]).collect()
    got = {r["doc_id"]: r["score"] for r in rows}
    assert np.mean([(got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in enumerate(labels)]) > 0.97
    again = toxicity.score(docs, toxicity.train(docs.repartition(9), marks.repartition(4)), keep=["doc_id"]).collect()
    assert {r["doc_id"]: r["score"] for r in again} == got


def test_nothing_to_learn_from(spark):
    docs = frame(spark, corpus(n=5)[0])
    marks = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert {r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, marks)).collect()} == {0}
    assert toxicity.score(docs.where("false"), toxicity.train(docs.where("false"), marks)).collect() == []


def test_insult_that_a_clean_document_quotes_is_learned():
    texts, labels = labelled()
    texts[labels.index(0)] += " nitwit"
    toxic, clean = ([sorted(toxicity.words(t)) for t, y in zip(texts, labels) if y == bad] for bad in (1, 0))
    assert "nitwit" in toxicity.marked_words(toxic, clean)
    assert scores(model_of(texts, labels), ["le nitwit de"])[0] >= toxicity.THRESHOLD


def test_rare_insult_counts_by_all_labelled_rows(spark, monkeypatch):
    """Of 320 toxic documents 16 have it, so a sample of 40 cannot show it."""
    monkeypatch.setattr(toxicity, "SAMPLE_PER_LABEL", 40)
    texts, labels = labelled(1280)
    bad = [i for i, y in enumerate(labels) if y]
    for i in bad[::20]:
        texts[i] += " zwackelmann"
    marks = spark.createDataFrame([*enumerate(labels)], "id long, label int")
    found = toxicity.all_marked_words(frame(spark, texts).selectExpr("doc_id id", "text"), marks)
    assert "zwackelmann" in found and set(INSULTS) <= found.keys()
    model = toxicity.train(frame(spark, texts), marks.toDF("doc_id", "toxic"))
    assert scores(model, ["the zwackelmann of"])[0] >= toxicity.THRESHOLD


def test_two_labels_without_a_difference_are_reported():
    import pytest

    texts, labels = labelled(40)
    with pytest.warns(UserWarning, match="no word tells them apart"):
        assert model_of([texts[1]] * 40, labels).table is None
