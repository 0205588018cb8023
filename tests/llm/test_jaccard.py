import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mostrador.llm import jaccard
from tests.llm.helpers import ODD, corpus, frame


def shingles(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(rows, share=(90, 100), size=3):
    """(id, n_shingles, component_id) of (id, text), by comparing all with all."""
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, p in enumerate(sets):
        for j in range(i):
            q = sets[j]
            if p and q and share[1] * len(p & q) >= share[0] * len(p | q):
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((x for x in own if x is not None), default=None) for r, own in groups.items()}
    return [(i, len(s), least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def rows_of(found):
    return sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(rng, texts, copies=6):
    out = []
    for t in texts:
        words = t.split(" ")
        for _ in range(copies):
            copy = list(words)
            for _ in range(rng.choice([1, 1, 1, 2, 3, 8])):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.5:
                    copy[at] = rng.choice(["changed", "other", "word"])
                elif kind < 0.75 and len(copy) > 2:
                    del copy[at : at + rng.randint(1, 2)]
                else:
                    copy.insert(at, "inserted")
            out.append(" ".join(copy))
    return out


def small_texts(rng, n=150):
    """Texts of 1 to 40 words, where one word more or less is at the edge of the threshold."""
    out = []
    while len(out) < n:
        words = [rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(rng.randint(1, 40))]
        out.append(" ".join(words))
        for _ in range(3):
            out.append(" ".join(words[: len(words) - rng.randint(0, 2)] + ["z"] * rng.randint(0, 2)))
    return out


def test_equals_plain_join(spark):
    rng = random.Random(21)
    base = corpus(seed=22, n=40)[0]
    texts = base + near_copies(rng, base[:30]) + small_texts(rng) + ODD + base[:5] + ["", "A b C", "a B c", "A b", "a b c d"]
    docs = frame(spark, texts).repartition(6)
    expected = sorted(plain(list(enumerate(texts))), key=repr)
    assert rows_of(jaccard.near_duplicates(docs)) == expected
    assert len({c for _, _, c in expected}) < len(texts) - 100


@pytest.mark.parametrize("share", [(80, 100), (1, 2)])
def test_other_thresholds_and_lengths(spark, share):
    rng = random.Random(23)
    base = corpus(seed=24, n=15)[0]
    texts = base + near_copies(rng, base, 4) + small_texts(rng, 60)
    found = jaccard.near_duplicates(frame(spark, texts), size=2, share=share)
    assert rows_of(found) == sorted(plain(list(enumerate(texts)), share, 2), key=repr)


def test_large_loose_group_in_many_blocks(spark, monkeypatch):
    """A family without its origin: most members link with some others only, and tiles fall into several blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard.proposals, "__defaults__", (jaccard.SHARE, 8))
    rng = random.Random(25)
    words = [f"w{rng.randrange(4000)}" for _ in range(400)]
    texts = []
    for _ in range(160):
        copy = list(words)
        for _ in range(rng.choice([3, 3, 4, 4, 5])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    expected = sorted(plain(list(enumerate(texts))), key=repr)
    assert rows_of(jaccard.near_duplicates(frame(spark, texts).repartition(3))) == expected
    assert 3 < len({c for _, _, c in expected}) < 150


def misses(copies=60, length=90):
    """Texts that share long passages, most pairs of which just miss the threshold."""
    rng = random.Random(31)
    words = [f"w{i}" for i in range(length)]
    texts = []
    for k in range(copies):
        copy = list(words)
        for at in rng.sample(range(length), 1 + k % 2):
            copy[at] = f"x{k}x{at}"
        texts.append(" ".join(copy))
    return texts


def test_a_group_meets_once_in_one_task(spark, monkeypatch):
    """Pairs that share many tiles do not come out of each of them."""
    texts = misses()
    monkeypatch.setattr(jaccard, "proposals", lambda *a, **k: pytest.fail("a small group was compared tile by tile"))
    came = []
    decide = jaccard.group_links
    monkeypatch.setattr(jaccard, "group_links", lambda members, share: came.append(members.count()) or decide(members, share))
    expected = plain(list(enumerate(texts)))
    assert rows_of(jaccard.near_duplicates(frame(spark, texts).repartition(4))) == sorted(expected, key=repr)
    assert came and all(n <= len(texts) for n in came)


def test_larger_groups_give_the_same_components(spark):
    texts = misses(40) + corpus(seed=32, n=10)[0]
    docs = frame(spark, texts).select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("t"))
    scanned = jaccard.scan(docs)
    found = []
    for group in (jaccard.GROUP, (2, 1 << 22), (4096, 1)):
        rows = jaccard.links(docs, scanned, group=group).select("h1", "h2", "label").collect()
        parts = {}
        for r in rows:
            parts.setdefault(r["label"], set()).add((r["h1"], r["h2"]))
        found.append(sorted(map(sorted, parts.values())))
    assert found[0] == found[1] == found[2]


def test_ties_join_what_links_connect():
    rng = np.random.default_rng(33)
    base = np.unique(rng.integers(0, 1 << 63, 120, np.uint64))
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, len(base), int(k))), rng.integers(0, 1 << 63, int(k), np.uint64)])) for k in rng.integers(2, 9, 50)]
    n, bits = np.array([len(s) for s in sets]), np.stack([jaccard.signature(s) for s in sets]).view(np.uint64)
    label = np.arange(50) // 2
    ties = jaccard._ties(label, n, bits, sets, (90, 100), step=7)

    def root(edges):
        of = label.copy()
        for x, y in edges:
            of[of == of[y]] = of[x]
        return [int(np.flatnonzero(of == o)[0]) for o in of]

    every = [(i, j) for i in range(50) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 90 * len(np.union1d(sets[i], sets[j]))]
    assert root(ties) == root(every) and set(ties) <= {(j, i) for i, j in every}
    assert len(ties) < len(set(label.tolist()))


def test_alike_sets_share_a_tile():
    rng = np.random.default_rng(26)
    bands = jaccard.Bands()
    for size in [*range(9, 60), 100, 333, 1000, 5000, 20_000]:
        for _ in range(6):
            # Two sets just at the threshold: o in common, and the rest dealt by chance.
            base = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
            spare = (len(base) * 10) // 100
            cut = int(rng.integers(0, spare + 1))
            more = spare - cut
            other = np.unique(np.concatenate([base[cut:] if cut else base, rng.integers(0, 1 << 64, more, np.uint64)]))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 90 * (len(base) + len(other) - both) and len(np.setxor1d(base, other)):
                assert len(np.intersect1d(bands.tiles(base), bands.tiles(other)))


def test_bit_counts_bound_the_overlap(spark):
    rng = np.random.default_rng(27)
    sets = [np.unique(rng.integers(0, 3000, int(rng.integers(1, 2500)), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(30)]
    n, bits = np.array([len(s) for s in sets]), np.stack([jaccard.signature(s) for s in sets]).view(np.uint64)
    bound = jaccard._overlaps(n, bits, slice(0, 30), slice(0, 30))
    for i, p in enumerate(sets):
        for j, q in enumerate(sets):
            assert bound[i, j] >= len(np.intersect1d(p, q))
    assert (np.diag(bound) == n).all()
    rows = spark.createDataFrame([(i, len(s), jaccard.signature(s).tolist()) for i, s in enumerate(sets)], "i int, n long, bits array<long>")
    pairs = rows.alias("a").join(rows.alias("b"), F.col("a.i") < F.col("b.i")).select("a.i", F.col("b.i").alias("j"), jaccard.may_link("a", "b").alias("may"))
    for r in pairs.collect():
        assert r["may"] == (190 * int(bound[r["i"], r["j"]]) >= 90 * int(n[r["i"]] + n[r["j"]]))


def test_repeated_rows_missing_ids_and_other_columns(spark):
    rng = random.Random(28)
    base = corpus(seed=29, n=12)[0]
    rows = list(enumerate(base + near_copies(rng, base, 2) + [None, ""]))
    rows += [(None, t) for _, t in rows[5:9]] + rows[:6] + [(3, "another text under a taken id"), (None, "only here"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], "doc_id long, text string, n long, h1 string, component_id long")
    assert rows_of(jaccard.near_duplicates(docs)) == sorted(plain(rows), key=repr)


def test_empty_table(spark):
    found = jaccard.near_duplicates(frame(spark, []))
    assert found.columns == ["doc_id", "n_shingles", "class_id", "component_id"] and found.collect() == []
