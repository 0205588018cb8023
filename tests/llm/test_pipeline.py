"""The pipeline's stages against their operators' plain definitions, on a small fixture."""

import random

import pytest

import corpus_pipeline
from mostrador.llm.queries import QUERIES
from tests.llm.helpers import SCHEMA, text

INSULTS = ["blockhead", "nitwit", "scoundrel"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows, labels = random.Random(12), [], []
    passage = " ".join(f"shared{i}" for i in range(70))
    for i in range(200):
        lang = rng.choice(["en", "fr", "de"])
        body = text(lang, rng, 8)
        toxic = i % 5 == 0
        if toxic:
            body += " " + " ".join(rng.sample(INSULTS, 2))
        elif i % 7 == 0:
            body += " " + passage
        rows.append((i, body, lang, "s", len(body)))
        labels.append((i, 1, int(toxic)))
    rows += [(200 + k, rows[k][1], "en", "s", 1) for k in (1, 2, 3)] + [(300, None, "en", "s", 0), (301, "12 34", None, "s", 5), (302, "", "en", "s", 0)]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
    every = {*range(200), 201, 202, 203}
    assert left["language_id"].keys() == every
    assert left["toxicity"].keys() == {i for i in every if i % 5 or i > 199}
    assert left["simhash"].keys() == {i for i in range(200) if i % 5}
    shared = [i for i in range(200) if i % 5 and i % 7 == 0]
    cut = left["substring"]
    assert cut.keys() == left["simhash"].keys()
    assert [i for i in shared if "shared5" in cut[i]] == shared[:1]
    assert all(cut[i] == left["simhash"][i] for i in cut if i not in shared[1:])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in pieces} == cut.keys()


def test_run_gives_the_pieces_of_what_is_left(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    assert len(corpus_pipeline.STAGES) == 5


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
