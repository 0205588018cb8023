import math
import random

from pyspark.sql import functions as F

from mostrador.llm import quality
from tests.llm.helpers import ODD, corpus, frame


def plain(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(k for i in at for k in range(i, i + 8))
    lines = [x for x in text.split("\n") if x.encode().split()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_counts_against_plain_python(spark):
    rng = random.Random(6)
    texts = corpus(n=30)[0] + ODD + ["a b c d e f g h " * 3, "x " * 9, "a\nb\na\n\n \na", "# * $%&|<> !", "\n".join(rng.choice(["one two", "three", " "]) for _ in range(50))]
    for _ in range(20):
        texts.append(" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))))
    docs = frame(spark, texts).repartition(3).withColumnsRenamed({"lang": "words", "source": "n_words"})
    rows = quality.measure(docs).collect()
    assert len(rows) == len(texts) and rows[0]["words"] == "en"
    for r in rows:
        assert {k: r[k] for k in plain(None)} == plain(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_tail_is_the_exact_binomial_sum(spark):
    cases = [(0, 10), (1, 10), (3, 400), (0, 500), (7, 2000), (19, 2000), (20, 2000), (21, 2000), (900, 100_000), (0, 0), (5, 3)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in rows:
        k, n = r["k"], r["n"]
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99) for i in range(min(k, n) + 1)]
        exact = 1.0 if k > n * 0.01 else math.fsum(map(math.exp, terms))
        assert abs(r["p"] - exact) <= 1e-8 * max(exact, 1e-12) + 1e-12


def corpus_with_labels(n=4000):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(900)}" for _ in range(40)]
        bad = i % 10 == 0
        if bad:
            words = [w + "!!" for w in words]
        elif i % 50 == 1:
            words[0] += "%"
        rows.append((i, " ".join(words), "en" if i % 3 else None))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_certified_rules_reject_bad_and_keep_good(spark):
    rows, labels = corpus_with_labels()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kept", F.lit("mine"))
    truth = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judge(docs, truth).collect()
    good = dict(labels)
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[i] for i in kept if not good[i])
    lost = sum(not kept[i] for i in kept if good[i])
    assert lost <= 0.01 * sum(good.values())


def test_too_few_labels_certify_nothing(spark):
    rows, labels = corpus_with_labels(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = spark.createDataFrame(labels, "doc_id long, quality int")
    assert all(r["kept"] for r in quality.judge(docs, truth).collect())
    assert all(r["kept"] for r in quality.judge(docs, truth.where("false")).collect())
    assert quality.judge(docs.where("false"), truth).collect() == []


def test_base_rules_decide_first(spark):
    docs = frame(spark, ["few words", "a b c d e f g h i j " * 5, " ".join(map(str, range(30))), None])
    truth = spark.createDataFrame([(0, 1), (0, 0)], "doc_id long, quality int")
    rows = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(docs, truth).collect()}
    assert rows == {0: (True, False), 1: (True, False), 2: (False, True), 3: (True, False)}


def test_repeated_rows_are_each_judged(spark):
    docs = frame(spark, ["one"] * 2).unionByName(frame(spark, ["one"] * 2))
    truth = spark.createDataFrame([(0, 1), (0, 1), (1, 1)], "doc_id long, quality int")
    assert quality.judge(docs, truth).count() == 4
