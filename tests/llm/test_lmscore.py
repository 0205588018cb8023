import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from mostrador.llm import lmscore
from tests.llm.helpers import ODD, frame


def grammar(n=400, seed=3):
    """Texts in which a word tells its neighbours."""
    rng = random.Random(seed)
    return [" ".join(f"{a}one {a}two {a}three" for a in rng.choices("abcdefgh", k=rng.randint(3, 12))) for _ in range(n)]


def tree(counts):
    """Of words with these counts, falling."""
    n, m = np.unique(counts, return_counts=True)
    return lmscore.Tree.build(n[::-1].astype(np.int64), m[::-1].astype(np.int64))


def plain_log_probability(network, leaves, i):
    """Of word ``i`` of one text, halving by halving."""
    h = network.shift.astype(float).copy()
    for place, step in enumerate((-2, -1, 1, 2)):
        j = i + step
        h += network.embed[place][network.inputs_of(leaves[j : j + 1])[0] if 0 <= j < len(leaves) else 0]
    h = np.tanh(h)
    logits = h @ network.layer + network.bias
    kind, depth, slot, side, odds = network.tree.paths(leaves[i : i + 1])
    out = logits[kind[0]] - math.log(np.exp(logits).sum())
    for k in range(depth[0]):
        out -= math.log1p(math.exp(-(odds[k] + side[k] * (h @ network.nodes[slot[k]]))))
    return out


def test_trained_network_prefers_texts_of_the_corpus(spark):
    docs = frame(spark, grammar()).repartition(3)
    model = lmscore.train(docs)
    held = grammar(40, seed=77)
    shuffled = []
    for t in held:
        w = t.split()
        random.Random(1).shuffle(w)
        shuffled.append(" ".join(w))
    rows = {r["doc_id"]: r["mean_log_prob"] for r in lmscore.score(frame(spark, held + shuffled), model).collect()}
    assert np.mean([rows[i] > rows[i + 40] for i in range(40)]) > 0.95
    # Better than the words' frequencies alone, which the untrained network gives.
    untrained = lmscore.Model(lmscore.Network.start(model.words.tree), model.words, model.table)
    plain = lmscore.score(frame(spark, held), untrained).collect()
    assert np.mean([rows[i] for i in range(40)]) > np.mean([r["mean_log_prob"] for r in plain]) + 0.3


def test_score_is_the_sum_over_all_words(spark):
    """Against a plain loop over words and halvings; columns of the new names are replaced, all others stay."""
    docs = frame(spark, grammar(30) + ODD + ODD)
    model = lmscore.train(docs, rounds=1)
    named = docs.withColumnsRenamed({"lang": "n_tokens", "source": "mean_log_prob"})
    rows = lmscore.score(named, model).collect()
    assert len(rows) == 30 + 2 * len(ODD) and set(rows[0].asDict()) == {"doc_id", "text", "n_chars", *lmscore._NEW}
    ranks = {r["key"]: r["leaf"] for r in model.table.collect()}
    for r in rows:
        words, _ = lmscore.tokens(pa.array([r["text"]], pa.string()))
        assert r["n_tokens"] == len((r["text"] or "").split())
        assert (r["mean_log_prob"] is None) == (len(words) == 0)
        if len(words) <= 400:
            leaves = np.array([ranks[k] for k in words.tolist()], np.int64)
            total = sum(plain_log_probability(model.network, leaves, i) for i in range(len(leaves)))
            assert abs(r["log_likelihood"] - total) < 1e-3 * max(1, len(words)), (repr(r["text"])[:60], r["n_tokens"])
    # Repeated rows agree.
    by_text = {}
    for r in rows:
        assert math.isclose(by_text.setdefault(r["text"], r["log_likelihood"]), r["log_likelihood"], rel_tol=1e-6)


def test_training_and_scoring_in_one_go(spark):
    docs = frame(spark, grammar(60) + ODD)
    model = lmscore.train(docs)
    apart = {r["doc_id"]: r["log_likelihood"] for r in lmscore.score(docs, model).collect()}
    for r in lmscore.train_and_score(docs, keep=["doc_id"]).collect():
        assert math.isclose(r["log_likelihood"], apart[r["doc_id"]], rel_tol=1e-4, abs_tol=1e-6)


def test_vocabulary_ranks_every_word_of_every_document(spark, monkeypatch):
    """Also with most words beyond those that travel with the tasks, and over several partitions."""
    monkeypatch.setattr(lmscore, "HEAD", 5)
    texts = grammar(50) + [f"rare{i} rare{i // 2}" for i in range(300)] + ODD
    cuts = lmscore.cut(frame(spark, texts).repartition(5), keep=["doc_id"])
    table = lmscore.vocabulary(cuts)
    rows = sorted((r["leaf"], r["key"], r["n"]) for r in table.collect())
    expected = Counter(w for t in texts for w in lmscore.tokens(pa.array([t], pa.string()))[0].tolist())
    assert [r[0] for r in rows] == list(range(len(expected))) and {k: n for _, k, n in rows} == expected
    assert [n for _, _, n in rows] == sorted(expected.values(), reverse=True)
    # Documents become the ranks of their words, in order.
    words = lmscore.Words.of(table)
    assert len(words.keys) == 5
    ranks = {k: leaf for leaf, k, _ in rows}
    for r in lmscore.ranked(cuts, table, words, ["doc_id"]).collect():
        own = lmscore.tokens(pa.array([texts[r[0]]], pa.string()))[0].tolist()
        assert lmscore._numbers(bytes(r["leaves"])).tolist() == [ranks[k] for k in own]


def test_untrained_tree_gives_the_counts_shares():
    rng = random.Random(5)
    for counts in ([], [3], [1] * 3000, [7] * 60, sorted((int(1e6 / (i + 1) ** 1.1) + 1 for i in range(5000)), reverse=True), [rng.randint(1, 9) for _ in range(900)]):
        counts = sorted(counts, reverse=True)
        found = tree(counts)
        assert found.size == len(counts) + lmscore.SHARED
        kind, depth, _, side, odds = found.paths(np.arange(found.size))
        weight = found.class_weights()
        share = np.log(weight[kind] / weight.sum())
        np.subtract.at(share, np.repeat(np.arange(found.size), depth), np.log1p(np.exp(-odds.astype(float))))
        expected = np.array(counts + [1] * lmscore.SHARED) / (sum(counts) + lmscore.SHARED)
        assert np.allclose(np.exp(share), expected, rtol=1e-4)
        # Frequent words lie high: about as many halvings as their share asks for.
        assert (depth * expected).sum() < -(expected * np.log2(expected)).sum() + 2


def test_halvings_with_trained_outputs_sum_to_one():
    network = lmscore.Network.start(tree([9] * 100 + [2] * 400))
    rng = np.random.default_rng(1)
    network.put(rng.standard_normal(network.rows().shape))
    total, leaves = 0.0, np.arange(12)
    for leaf in range(network.tree.size):
        leaves[5] = leaf
        found = network.log_probabilities(leaves, np.array([12]))[5]
        assert abs(found - plain_log_probability(network, leaves, 5)) < 1e-3
        total += math.exp(found)
    assert abs(total - 1) < 1e-4


def test_empty_table(spark):
    empty = frame(spark, [])
    assert lmscore.score(empty, lmscore.train(empty)).collect() == []
    assert lmscore.train_and_score(empty, keep=["doc_id"]).collect() == []


def test_words_that_the_corpus_lacks_have_a_probability(spark):
    model = lmscore.train(frame(spark, grammar(20)))
    (r,) = lmscore.score(frame(spark, ["never seen words here"]), model).collect()
    assert r["n_tokens"] == 4 and math.isfinite(r["log_likelihood"]) and r["log_likelihood"] < -8


def test_every_word_of_thousands_is_predicted_from_both_sides(spark):
    """Words come in runs of one group, so neighbours tell the group."""
    rng = random.Random(4)
    groups = [[f"{c}{i}" for i in range(600)] for c in "abcde"]
    texts = [" ".join(rng.choice(g) for g in rng.choices(groups, k=10) for _ in range(6)) for _ in range(3000)]
    docs = frame(spark, texts).repartition(3)
    model = lmscore.train(docs)
    assert model.table.count() == 3000 and model.words.tree.words == 3000
    # Training reaches the outputs below the classes, of halvings of their own and of shared ones.
    used = np.abs(model.network.nodes).sum(axis=1) > 0
    assert used[: lmscore.NODES].sum() > 100 and used[lmscore.NODES :].sum() > 500


def test_another_partitioning_gives_as_good_a_network(spark):
    """Not the same one: tasks train apart and are averaged."""
    texts, held = grammar(600), grammar(50, seed=9)
    means = []
    for n in (1, 6):
        model = lmscore.train(frame(spark, texts).repartition(n))
        means.append(np.mean([r["mean_log_prob"] for r in lmscore.score(frame(spark, held), model).collect()]))
    assert abs(means[0] - means[1]) < 0.7, means


def test_every_word_is_a_target_once():
    network = lmscore.Network.start(tree([3] * 100))
    sizes = np.array([1, 2, 3, 0, 4, 90])
    for rounds in (1, 2, 3):
        memory = [np.zeros_like(p) for p in network.parameters()]
        assert sum(network.learn(np.arange(100), sizes, memory, range(r, lmscore.MASKED, rounds)) for r in range(rounds)) == 100


def test_a_step_of_training_is_the_gradient():
    """The first Adagrad step moves each parameter against its gradient, found by differences."""
    network = lmscore.Network.start(tree([5] * 60 + [1] * 90))
    rng = np.random.default_rng(2)
    network.put(rng.standard_normal(network.rows().shape) * 0.3)
    leaves, sizes = rng.integers(0, 150, 40), np.array([25, 15])
    before = network.rows().copy()
    memory = [np.zeros_like(p) for p in network.parameters()]
    network.learn(leaves, sizes, memory, [3])
    moved = (network.rows() - before).ravel()
    place = np.concatenate([np.arange(25) + 25, np.arange(15) + 15])
    chosen = np.flatnonzero(place % lmscore.MASKED == 3)
    held = np.concatenate([m.ravel() for m in memory])
    size = np.sqrt(held)
    for at in rng.choice(np.flatnonzero(size > 3e-3), 40, replace=False):
        around = []
        for sign in (1, -1):
            flat = before.ravel().astype(np.float64).copy()
            flat[at] += sign * 1e-2
            network.put(flat.reshape(-1, lmscore.WIDTH))
            around.append(network.log_probabilities(leaves, sizes)[chosen].mean())
        slope = (around[0] - around[1]) / 2e-2
        assert math.isclose(abs(slope), size[at], rel_tol=0.1, abs_tol=1e-3) and np.sign(slope) == np.sign(moved[at])


def test_ways_kept_from_block_to_block_are_those_found_anew(monkeypatch):
    """Also for words beyond those that are kept."""
    counts = sorted((int(2000 / (i + 1)) + 1 for i in range(900)), reverse=True)
    leaves = np.random.default_rng(3).integers(0, 900 + lmscore.SHARED, 500)
    monkeypatch.setattr(lmscore, "_KEPT", 100)
    some = tree(counts)
    for _ in range(2):
        step = lmscore._Paths(some, leaves).step(np.arange(500))
        kind, depth, slot, side, odds = some.paths(leaves[step.own])
        assert (step.kind == kind).all() and (step.slot == slot).all() and (step.side == side).all() and (step.odds == odds).all()
        assert [k for _, _, (k, _) in step.groups] == np.bincount(depth)[1:][np.bincount(depth)[1:] > 0].tolist()
    assert len(some.kept[0]) == 100


def test_classes_far_apart_give_finite_probabilities():
    network = lmscore.Network.start(tree([9] * 100))
    network.bias[:50:2], network.bias[1:50:2] = 300, -300
    found = network.log_probabilities(np.arange(48), np.array([48]))
    assert np.isfinite(found).all()
    assert all(abs(found[i] - plain_log_probability(network, np.arange(48), i)) < 1e-2 for i in range(0, 48, 2))


def test_words_are_scored_once_with_those_of_equally_many_halvings(monkeypatch):
    """Some at a time, of bounded size; and the sums stay those of a plain loop, whatever comes together."""
    monkeypatch.setattr(lmscore, "_CHUNK", 50)
    monkeypatch.setattr(lmscore, "_HALVINGS", 200)
    network = lmscore.Network.start(tree(sorted((int(2000 / (i + 1)) + 1 for i in range(900)), reverse=True)))
    rng = np.random.default_rng(6)
    network.put(rng.standard_normal(network.rows().shape) * 0.3)
    leaves = np.concatenate([rng.integers(0, 900 + lmscore.SHARED, 300), rng.integers(0, 60, 300)])
    paths, seen = lmscore._Paths(network.tree, leaves), []
    kind, depth, slot, side, odds = network.tree.paths(leaves)
    ends = np.cumsum(depth)
    for own, d in paths.alike():
        assert 0 < len(own) <= 50 and len(own) * d <= 200 and (depth[own] == d).all()
        half, found = paths.levels(own, d)
        for k, i in enumerate(own):
            mine = slice(ends[i] - d, ends[i])
            assert (half[:, k] == 2 * slot[mine] + (side[mine] > 0)).all() and (found[:, k] == odds[mine]).all()
        seen += own.tolist()
    assert sorted(seen) == list(range(600)) and (depth == 0).any() and len(set(depth)) > 5
    scored = network.log_probabilities(leaves, np.array([600]))
    assert np.allclose(scored, [plain_log_probability(network, leaves, i) for i in range(600)], atol=1e-4)
