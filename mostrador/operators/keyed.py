"""Last-record-wins and keyed upsert.

Most keys come once. Counting rows per key hash is a hash aggregation of two fixed-width numbers, combined inside the map
tasks without a sort, so a key that holds a third of the rows costs one row per task. Only rows of repeated keys are
compared with each other; the others are neither sorted nor, while repeated keys are few, shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.session import joinable, stored


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes (``_h``) of the keys that come more than once; now and then one that two single keys share."""
    hashed = df.select(F.xxhash64(*keys).alias("_h"))
    return hashed.groupBy("_h").agg(F.count("*").alias("veces")).where("veces > 1").select("_h")


def known_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`repeated_hashes`, written once, so that their size is known when a join with them is planned: were it only
    found while the join runs, the rows on its other side would be on their way through a shuffle by then."""
    return stored(df.sparkSession, repeated_hashes(df, keys), "llaves-repetidas")


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str | None = None
) -> DataFrame:
    """One row per key: the one that comes last by ``order``, which is dropped.

    ``copies`` names an extra column with the number of rows the key had.

    Rows of single keys pass as they are. They are told apart by the hashes of repeated keys: against a few of these
    without a shuffle, else by a join in which Spark splits a hot key. ``df`` is read twice (the first time only its keys),
    so give a stored table or something as cheap to read.
    """
    values = [name for name in df.columns if name not in keys and name not in order]
    marked, repeated = df.withColumn("_h", F.xxhash64(*keys)), known_repeats(df, keys)
    single = marked.join(repeated, "_h", "left_anti").select(*keys, *values, *([F.lit(1).cast("bigint").alias(copies)] if copies else []))
    counted = [F.count("*").alias(copies)] if copies else []
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    compared = marked.join(repeated, "_h", "left_semi").groupBy(*keys).agg(last, *counted).select(
        *keys, *[F.col(f"_last.{name}").alias(name) for name in values], *([copies] if copies else [])
    )
    return single.unionByName(compared)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    stamp: str,
    loaded_at: datetime,
    order: Sequence[str] = (),
) -> DataFrame:
    """``target`` after inserting or updating ``incoming`` by ``keys``.

    Every incoming row is stamped with ``loaded_at``; keys that do not come in keep their old row and
    stamp; nothing is deleted. With ``order`` the incoming rows may repeat a key, the last one wins.

    The batch is deduplicated (see :func:`latest_by_key` for what ``incoming`` should be) and written once, so that its size
    is known: the rows of ``target`` that stay are then found against its keys alone, by broadcast while these are few (see
    :func:`mostrador.session.joinable`; the target is not shuffled), else by a join on the keys.
    """
    batch = latest_by_key(incoming, keys, order) if order else incoming
    return merge(target, stored(target.sparkSession, batch, "lote"), keys, stamp, loaded_at)


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], stamp: str, loaded_at: datetime) -> DataFrame:
    """The second half of :func:`upsert`, for a stored ``batch`` with one row per key."""
    columns = target.columns
    kept = target.join(joinable(batch.select(*keys)), list(keys), "left_anti").select(*columns)
    return kept.unionByName(batch.withColumn(stamp, F.lit(loaded_at)).select(*columns))


def refresh(target: DataFrame, rows: DataFrame, keys: Sequence[str], stamp: str, loaded_at: datetime) -> DataFrame:
    """As :func:`upsert`, for stored ``rows`` that hold nearly every key of ``target``.

    Only keys are compared: those that ``rows`` lack are few, and just their old rows are read in full.
    """
    columns = target.columns
    fresh = rows.withColumn(stamp, F.lit(loaded_at)).select(*columns)
    left = stored(target.sparkSession, target.select(*keys).join(joinable(rows.select(*keys)), list(keys), "left_anti"), "viejas")
    return fresh.unionByName(target.join(joinable(left), list(keys), "left_semi").select(*columns))
