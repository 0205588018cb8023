"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUSINESS_ZONE = "America/Mexico_City"

SETTINGS = {
    "spark.sql.session.timeZone": BUSINESS_ZONE,
    "spark.sql.ansi.enabled": "true",
    # AQE sizes shuffle partitions from real bytes, switches to broadcast only under
    # spark.sql.autoBroadcastJoinThreshold and splits hot join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "mostrador", **settings: str) -> SparkSession:
    """Session with the settings above; ``settings`` come on top (dots allowed via ``**{}``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting (tests); a cluster must name a folder
    that every executor can see, so there a missing setting is an error.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="mostrador-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: computed once, and its size is known."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


#: Setting (and default) of the most bytes that a table may take in memory to go through the driver for a join.
MOST_BROADCAST, MOST_BROADCAST_DEFAULT = "mostrador.broadcast.maxBytes", 64 << 20


def joinable(df: DataFrame) -> DataFrame:
    """``df``, which is cheap to read, as the inner side of a join: by sort and merge if its rows are too many for a broadcast.

    Spark takes a table for as large as its files. Ids compress well and lie in the hash table of a
    broadcast with about 48 bytes each, so by files alone the driver would be sent hundreds of megabytes. Rows are counted
    from the footers of stored files; texts are measured only where the rows alone would fit. Smaller tables are left to Spark
    and ``spark.sql.autoBroadcastJoinThreshold``.
    """
    most = int(df.sparkSession.conf.get(MOST_BROADCAST, str(MOST_BROADCAST_DEFAULT)))
    # An entry of the hash table; a value each; for a text its place and, as key and in the row, its bytes.
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, (T.StringType, T.BinaryType))]
    size = df.count() * (32 + 8 * len(df.columns) + 16 * len(texts))
    if texts and size <= most:
        lengths = df.agg(*[F.sum(F.octet_length(name)).alias(f"b{i}") for i, name in enumerate(texts)]).first()
        size += 2 * sum(length or 0 for length in lengths)
    return df.hint("merge") if size > most else df


#: Setting (and default) of the most partitions that :func:`size_shuffles` asks for.
MOST_PARTITIONS, MOST_PARTITIONS_DEFAULT = "mostrador.shuffle.maxPartitions", 200_000


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with enough partitions for ``input_bytes`` of new rows and as much of stored ones.

    About 128 MB each, so that a partition sorts in executor memory; AQE joins those that turn out smaller.
    Beyond the setting ``mostrador.shuffle.maxPartitions`` partitions grow (and spill) instead, as ever smaller shuffle
    blocks would cost more. Never lowers what the session asks for. Returns the number.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    asked = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(asked, min(-(-2 * input_bytes // (128 << 20)), int(spark.conf.get(MOST_PARTITIONS, str(MOST_PARTITIONS_DEFAULT)))))
    if wanted > asked:
        spark.conf.set(key, str(wanted))
    return wanted


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a file, folder or glob) matches anything on its file system."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when it does not exist."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]
