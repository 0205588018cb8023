"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.session import scratch_path

#: What separates words, as bytes.split() and the patterns below have it: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: computed once, and safe when executors go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Setting and bytes of the batches that tasks hand to their Python workers. By default a batch has up to 10,000 rows and
#: some hundred MB; both sides hold a whole one, and the JVM keeps buffers it once grew to.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


_ASKED: set[str] = set()


def small_batches(df: DataFrame, size: int = BATCH_BYTES) -> DataFrame:
    """``df``, whose texts go to Python workers in batches of about ``size`` bytes from now on, and one longer text alone. It
    is a setting of the session; one made by the user stays. No row depends on it."""
    conf = df.sparkSession.conf
    _ASKED.add(str(size))
    if conf.getAll.get(BATCH_SETTING, str(size)) in _ASKED:
        conf.set(BATCH_SETTING, str(size))
    return df


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``. A missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def sample_ids(pairs: DataFrame, kind: str, each: int, counts: dict) -> DataFrame:
    """(kind, id): the ``each`` ids of least hash of every kind in ``counts``, which has the rows of each.

    First only ids under a hash bound go on, that lets about four times as many through as are wanted; so what meets in
    one task stays bounded, however many rows a kind has.
    """
    low, width = -(1 << 63), 1 << 64
    bounds = {k: min((1 << 63) - 1, low + width * 4 * each // max(1, n)) if n > 4 * each else (1 << 63) - 1 for k, n in counts.items()}
    if not bounds:
        return pairs.select(kind, "id").where("false")
    bound = F.create_map(*[F.lit(x) if i % 2 == 0 else F.lit(x).cast("long") for k in bounds for i, x in enumerate((k, bounds[k]))])
    hashed = F.xxhash64("id")
    few = pairs.where(hashed <= F.try_element_at(bound, F.col(kind))).select(kind, "id").distinct()
    rank = F.row_number().over(W.partitionBy(kind).orderBy(hashed, "id"))
    return few.withColumn("n", rank).where(F.col("n") <= each).select(kind, "id")


def add_columns(
    df: DataFrame,
    text_col: str,
    fields: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    keep: list[str] | None = None,
    rows: int = 1024,
) -> DataFrame:
    """The columns ``keep`` of ``df`` (default: all), and new ``fields`` worked out from the text, row by row.

    ``make`` is called once in a task and returns a function from at most ``rows`` texts to one Arrow array per field.
    No shuffle. A kept column with the name of a new one is replaced by it.
    """
    new = {name for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    inside = [f"k{i}" for i in range(len(kept))]
    picked = small_batches(df).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inside, strict=True)], F.col(f"`{text_col}`").alias("t"))
    schema = T.StructType(
        [T.StructField(n, picked.schema[n].dataType, True) for n in inside]
        + [T.StructField(f"n{i}", kind, True) for i, (_, kind) in enumerate(fields)]
    )
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                arrays = work(batch.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in inside] + arrays, names)
        del work
        release()

    out = picked.mapInArrow(run, schema)
    return out.toDF(*kept, *[name for name, _ in fields])


def blocks(batch: pa.RecordBatch, text: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes of the string column ``text``; one longer text is a slice of its own."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def release() -> None:
    """At a task's end: give back what it held. A Python worker lives on and serves the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def own_copy(texts: pa.Array) -> pa.Array:
    """Texts as large strings, null as empty, in buffers of their own: some string kernels misread a slice's offset."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    return whole.take(pa.array(np.arange(len(whole))))


def spread(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs flat[begin : begin + size] one after another."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return flat[at + np.repeat(begins - (ends - sizes), sizes)]


def hex64(column: Column) -> Column:
    """A long as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
