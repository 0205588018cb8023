import random

from mostrador.llm import substring
from tests.llm.helpers import ODD, corpus, frame


def expected(rows):
    """(kept words, removed) by the definition, for (id, text) rows."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - 49):
            key = tuple(w[a : a + 50])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - 49):
            if first[tuple(w[a : a + 50])] < i:
                gone.update(range(a, a + 50))
        out.append((i, [x for k, x in enumerate(w) if k not in gone], len(gone)))
    return out


def check(spark, texts, extra=()):
    rows = [*enumerate(texts), *extra]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sorted(((r["doc_id"], (r["text"] or "").encode().split(), r["n_removed"], r["n_words"]) for r in substring.deduplicate(docs).collect()))
    assert found == sorted((i, k, n, len((t or "").encode().split())) for (i, t), (_, k, n) in zip(rows, expected(rows)))
    return found


def planted(seed=9):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([49, 50, 51, 80, 200]))) for _ in range(8)]
    texts = []
    for i in range(60):
        own = lambda: " ".join(f"u{i}x{k}" for k in range(rng.randint(0, 90)))
        texts.append("\n".join([own(), rng.choice(pool), own(), rng.choice(pool), own()]))
    # Cut passages, so that factors of several documents meet and overlap.
    for t in list(texts[:10]):
        w = t.split()
        texts.append(" ".join(w[len(w) // 3 :] + texts[20].split()[:60]))
    return texts + texts[:4]


def test_against_the_definition(spark):
    found = check(spark, planted() + corpus(n=20)[0] + [t for t in ODD])
    assert sum(n for _, _, n, _ in found) > 2000


def test_repeated_rows_lose_the_same_words_and_not_each_other_s(spark):
    texts = planted()
    check(spark, texts, [(i, texts[i]) for i in range(0, 60, 7)])


def test_rows_with_one_id_and_other_texts(spark):
    texts = planted()
    check(spark, texts, [(i + 1, texts[i]) for i in range(0, 58, 5)] + [(3, texts[40] + " more")])


def test_repetitive_texts(spark):
    check(spark, ["a " * 400, "a " * 49, "a " * 50 + "b", "b " * 30 + "a " * 60, "x " * 30_000])


def test_white_space_of_what_stays_is_kept(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = frame(spark, [shared, f"Head\n\n{shared}\ttail  end\n", None]).withColumnsRenamed({"lang": "n_words", "source": "pieces"})
    rows = {r["doc_id"]: r for r in substring.deduplicate(docs).collect()}
    assert rows[1]["text"] == "Head\n\ntail  end\n" and rows[1]["n_removed"] == 60 and rows[1]["pieces"] == "s1"
    assert rows[2]["text"] is None and rows[2]["n_words"] == 0


def test_empty_table_and_missing_ids(spark):
    assert substring.deduplicate(frame(spark, [])).collect() == []
    text = " ".join(map(str, range(70)))
    rows = spark.createDataFrame([(None, text), (None, text), (4, text)], "doc_id long, text string")
    assert {r["n_removed"] for r in substring.deduplicate(rows).collect()} == {0}


def test_rows_of_one_anchor_over_many_batches(spark):
    """Whether an anchor is shared may show only batches later."""
    rng = random.Random(3)
    rows = [(i, a) for a in range(12) for i in sorted(rng.choices(range(4), k=rng.randint(1, 5)))]
    want = set(r for r in rows if len({i for i, a in rows if a == r[1]}) > 1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in (1, 2, 3, 100):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = substring._shared(spark.createDataFrame(rows, "id long, anchor long")).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        assert set(map(tuple, got)) == want
