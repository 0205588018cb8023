import random

import xxhash
from pyspark.sql import functions as F

from mostrador.llm import simhash
from tests.llm.helpers import ODD, corpus, frame


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) > len(shingles):
            out |= 1 << bit
    return out


def groups(prints):
    """Smallest index reachable over at most two differing bits."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_and_components(spark):
    rng = random.Random(3)
    texts = corpus(n=30)[0] + [t for t in ODD if t is None or len(t) < 100] + ["", "A b C", "a B c"]
    for t in corpus(n=5)[0]:
        words = t.split(" ")
        for _ in range(6):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    docs = frame(spark, texts).repartition(4).withColumnsRenamed({"lang": "fp", "source": "component_id"})
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r["doc_id"])
    prints = [plain(t) for t in texts]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == groups(prints)


def _prints(spark, values):
    return spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")


def _labels(found, values):
    at = {v - (1 << 64) if v >> 63 else v: v for v in values}
    got = {at[r["node"]]: at[r["label"]] for r in found.collect()}
    return [got.get(v, v) for v in values]


def test_links_in_small_and_crowded_buckets_are_the_same(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(14):
            other = base
            for _ in range(rng.randint(1, 4)):
                other ^= 1 << rng.randrange(64)
            values.add(other)
    values = sorted(values)
    whole = groups(values)
    parts = {}
    for v, g in zip(values, whole):
        parts.setdefault(g, set()).add(v)
    for bucket in (1000, 1):
        labels = _labels(simhash.components(simhash.links(_prints(spark, values), bucket=bucket)), values)
        found = {}
        for v, g in zip(values, labels):
            found.setdefault(g, set()).add(v)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, parts.values()))


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000}


def test_one_of_each_group_stays(spark):
    docs = frame(spark, ["one two three four", "ONE two three four", "five six seven", None, ""]).withColumn("extra", F.lit(1))
    docs = docs.unionByName(docs.where("doc_id = 2"))
    unnamed = docs.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("quite other words here"))
    kept = simhash.keep_one(docs.unionByName(unnamed))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [(0, "one two three four"), (2, "five six seven"), (3, None)]
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []
