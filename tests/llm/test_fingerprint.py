import hashlib
import random

from pyspark.sql import functions as F

from mostrador.llm import fingerprint as fp
from tests.llm.helpers import ODD, corpus, frame


def vectors(spark, texts):
    rows = spark.createDataFrame([*enumerate(texts)], "i int, text string")
    hashed = rows.select("i", *[h.alias(f"h{k}") for k, h in enumerate(fp.hashes(F.col("text")))])
    return [r["v"] for r in hashed.select("i", fp.vector(["h0", "h1"]).alias("v")).orderBy("i").collect()]


def test_order_does_not_matter_and_repeats_count(spark):
    a, b, c, d = vectors(spark, ["one\ntwo\nthree", "three\none\ntwo", "one\ntwo\nthree\nthree", "one\ntwo\nthre"])
    assert a == b and a != c and a != d and len(a) == fp.WORDS


def test_counters_are_taken_modulo_a_power(spark):
    n = (1 << 16) + 5
    many, few = vectors(spark, ["x\n" * (n - 1) + "x", "x\nx\nx\nx\nx"])
    assert many[2:] == few[2:] and many[1] == n


def test_insert_and_delete(spark):
    a, b, both = vectors(spark, ["one\ntwo", "three\none. four", "one\ntwo\nthree\none. four"])
    row = spark.createDataFrame([(a, b, both)], "a array<long>, b array<long>, t array<long>").select(
        fp.insert(F.col("a"), F.col("b")).alias("i"), fp.delete(F.col("t"), F.col("b")).alias("d")
    ).first()
    assert row["i"] == both and row["d"] == a


def test_likeness_follows_what_is_shared(spark):
    rng = random.Random(1)
    base = [f"line {i} {rng.random()}" for i in range(60)]
    other = [f"other {i} {rng.random()}" for i in range(60)]
    texts = ["\n".join(base), "\n".join(base[:30] + other[:30]), "\n".join(other), "\n".join(base[::-1])]
    v = vectors(spark, texts)
    near = [r["n"] for r in spark.createDataFrame([(i, v[0], x) for i, x in enumerate(v)], "i int, a array<long>, b array<long>").select("i", fp.likeness(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()]
    assert near[0] == near[3] == 1.0 and 0.3 < near[1] < 0.7 and near[2] < 0.3


def check(spark, rows, parts=4):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(parts)
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["n_chars"], hashlib.sha256(r["edited"].encode()).hexdigest()) for r in fp.compare_edits(docs).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want.append((i is not None, i, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()))
    assert got == sorted(want)


def test_edits_against_plain_python(spark, monkeypatch):
    texts = corpus(n=80)[0] + ODD
    ids = random.Random(2).sample(range(-(10**12), 10**12), len(texts))
    check(spark, [*zip(ids, texts)])
    monkeypatch.setattr(fp, "BUCKET_ROWS", 5)
    check(spark, [*zip(ids, texts)])
    check(spark, [*zip(range(len(texts)), texts)] + [(7, "tie"), (7, "tie"), (None, "unnamed")])
    check(spark, [(3, t) for t in texts[:20]])


def test_one_document_and_none(spark):
    check(spark, [(1, "abcdef")])
    assert fp.compare_edits(frame(spark, [])).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    rows = fp.compare_edits(frame(spark, ["a b. c\nd", "x", "a b. c\nd", None, ""])).collect()
    of = {r["doc_id"]: r for r in rows}
    assert of[0]["fingerprint"] == of[2]["fingerprint"] != of[1]["fingerprint"]
    assert of[3]["fingerprint"] == of[4]["fingerprint"] and of[4]["near_next"] == 1.0 and of[3]["near_edited"] == 1.0
