import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mostrador.llm import resampling
from tests.llm.helpers import ODD, corpus, frame

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(rows, targets, percent=25, least=20):
    """(id, n_features, weight, score, rank) by the definition."""
    s, t = Counter(), Counter()
    found = [(i, *plain_features(text)) for i, text in rows]
    for _, _, own in found:
        s.update(own)
    for text in targets:
        t.update(plain_features(text)[1])
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    out = []
    for i, words, own in found:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own)) // len(own) if own else 0
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    candidates = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(candidates[: percent * len(candidates) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in out]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def targets(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_any_run_of_bytes_follows_from_two_prefixes():
    rng = random.Random(1)
    for _ in range(40):
        words = [bytes(rng.randrange(33, 256) for _ in range(rng.choice([1, 2, 5, 300]))) for _ in range(rng.randint(1, 30))]
        after, sizes = resampling.prefix_crcs(words), np.array([len(w) for w in words])
        for n, crcs in enumerate(resampling.gram_crcs(after, sizes, 4), 1):
            assert crcs.tolist() == [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
    crc = np.array([zlib.crc32(b"abc")] * 3, np.uint32)
    joined = resampling.shifted(crc, np.array([0, 1, 70_000])) ^ np.array([zlib.crc32(b"z" * n) for n in (0, 1, 70_000)], np.uint32)
    assert joined.tolist() == [zlib.crc32(b"abc" + b"z" * n) for n in (0, 1, 70_000)]


def test_equals_plain_resampling(spark):
    texts = corpus(seed=8, n=150)[0] + ODD + ["one two", "A-Z a_z 09 \x7f été", "same words here " * 9] + ["same words here " * 9] * 3
    aims = corpus(seed=9, n=12)[0] + [None, "", "some TARGET words, and words"]
    docs = frame(spark, texts).repartition(7)
    expected = sorted(plain(list(enumerate(texts)), aims), key=repr)
    assert rows_of(resampling.resample(docs, targets(spark, aims))) == expected
    assert any(r[4] for r in expected)


def test_repeated_rows_missing_ids_and_other_columns(spark):
    texts = [t for t in corpus(seed=10, n=40)[0]]
    docs = frame(spark, texts)
    unnamed = docs.where("doc_id < 8").withColumn("doc_id", F.lit(None).cast("long"))
    again = docs.where("doc_id < 20")
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, t) for t in texts[:8]] + [(i, t) for i, t in enumerate(texts[:20])]
    clashing = docs.unionByName(unnamed).unionByName(again).withColumnsRenamed({"lang": "score", "source": "rank"}).withColumn("id", F.lit("x")).withColumn("at", F.lit(1))
    found = rows_of(resampling.resample(clashing, targets(spark, ["the of and to in"]), percent=60))
    expected = sorted(plain(rows, ["the of and to in"], percent=60), key=repr)
    # Which of equal rows has which of their ranks is open.
    blur = lambda rows: [(*r[:4], r[4] is not None) for r in rows]
    assert sorted(blur(found), key=repr) == sorted(blur(expected), key=repr)
    assert sorted(r[4] for r in found if r[4]) == sorted(r[4] for r in expected if r[4])


def test_empty_tables(spark):
    none = targets(spark, [])
    assert resampling.resample(frame(spark, []), none).collect() == []
    texts = corpus(seed=11, n=20)[0]
    assert rows_of(resampling.resample(frame(spark, texts), none)) == sorted(plain(list(enumerate(texts)), []), key=repr)


def test_a_target_like_some_documents_draws_these(spark):
    texts, langs = corpus(seed=12, n=200)
    aims = [t for t, lang in zip(corpus(seed=13, n=60)[0], corpus(seed=13, n=60)[1]) if lang == "fr"]
    drawn = {r["doc_id"] for r in resampling.resample(frame(spark, texts), targets(spark, aims)).where("rank IS NOT NULL").collect()}
    share = sum(langs[i] == "fr" for i in drawn) / len(drawn)
    assert share > 1.5 * langs.count("fr") / len(langs)
