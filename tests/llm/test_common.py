import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm import common, langid, substring, toxicity
from tests.llm.helpers import frame


def test_tasks_hand_over_texts_in_small_batches(spark):
    """Not by 10,000 rows, whatever these weigh: 1,000 texts of 50 kB in one task."""

    def sizes():
        return lambda texts: [pa.array([sum(map(len, texts))] * len(texts), pa.int64())]

    spark.conf.unset(common.BATCH_SETTING)
    docs = spark.range(0, 1000, 1, 1).select("id", F.repeat(F.lit("x"), 50_000).alias("text"))
    rows = common.add_columns(docs, "text", [("n", T.LongType())], sizes, keep=["id"]).collect()
    assert sorted(r["id"] for r in rows) == list(range(1000))
    assert max(r["n"] for r in rows) <= common.BATCH_BYTES + 50_000


def test_operators_of_the_pipeline_ask_for_small_batches(spark):
    docs = frame(spark, ["one two"])
    nothing = toxicity.Model(None, 0.0, 1.0, 0.0)
    for use in (lambda: langid.predict(docs, langid.fit([], [])), lambda: toxicity.score(docs, nothing), lambda: substring.deduplicate(docs)):
        spark.conf.unset(common.BATCH_SETTING)
        use()
        assert spark.conf.get(common.BATCH_SETTING) == str(common.BATCH_BYTES)


def test_a_size_of_batches_that_the_user_set_stays(spark):
    spark.conf.set(common.BATCH_SETTING, "9m")
    try:
        common.small_batches(spark.range(1))
        assert spark.conf.get(common.BATCH_SETTING) == "9m"
    finally:
        spark.conf.unset(common.BATCH_SETTING)
