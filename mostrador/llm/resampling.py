"""Importance resampling towards a target distribution, over hashed word n-grams.

Each document is scanned once: its words, lower-cased and joined by one space, give a running CRC-32 after every word.
The CRC of any n-gram then follows from two prefixes: shifting the earlier one over as many zero bytes as the n-gram is
long (a linear map over GF(2), kept as byte tables for each power of two) and adding the later one cancels everything
before the n-gram. The CRCs modulo ``BUCKETS`` are written per document; corpus and target are counted from them by
bucket, with counts summed in the tasks first, and documents are weighed by the mean gain of their features.

The draw adds Gumbel noise that depends on the document's id alone, so the highest scores are a weighted sample without
replacement. Ranks are given by ranges of the score: rows are dealt and sorted by range, and each range's offset is the
sum of the sizes before it, so no task sees more than one range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import blocks, written

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of text that are worked on at once (a longer text is worked on alone).
BLOCK = 4 << 20

_POLYNOMIAL = 0xEDB88320
#: Words are digits, letters (A-Z as a-z) and all bytes beyond ASCII; every other byte separates.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@cache
def _byte_table() -> np.ndarray:
    """CRC of each byte, without the complements before and after."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(_POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


@cache
def _shift_tables(bit: int) -> np.ndarray:
    """Four tables of 256: what appending 2**bit zero bytes makes of each byte of a CRC."""
    if bit == 0:
        places = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
        return _byte_table()[places & 0xFF] ^ (places >> np.uint32(8))
    half = _shift_tables(bit - 1)
    return _mapped(half, _mapped(half, np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)))


def _mapped(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 0xFF] ^ tables[1][crc >> 8 & 0xFF] ^ tables[2][crc >> 16 & 0xFF] ^ tables[3][crc >> 24]


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` after ``length`` zero bytes more, element by element."""
    crc, left, bit = crc.copy(), length.copy(), 0
    while left.any():
        at = np.flatnonzero(left & 1)
        crc[at] = _mapped(_shift_tables(bit), crc[at])
        left >>= 1
        bit += 1
    return crc


def prefix_crcs(words: list[bytes]) -> np.ndarray:
    """CRC-32 of the space-joined text up to the end of each word."""
    if not words:
        return np.zeros(0, np.uint32)
    parts = [words[0], *[b" " + w for w in words[1:]]]
    return np.fromiter(accumulate(parts, lambda crc, part: zlib.crc32(part, crc), initial=0), np.uint32, len(words) + 1)[1:]


def gram_crcs(after: np.ndarray, sizes: np.ndarray, longest: int = LONGEST, lead: np.ndarray | None = None) -> list[np.ndarray]:
    """For n = 1 … longest: the CRC-32 of each run of n words, from the prefixes' CRCs and the words' lengths.

    ``lead``: places of the first words of documents that follow one another (default: one document). A run over the end
    of a document has no meaning then.
    """
    # Before a word lies the prefix up to the last word and one space; before the first, nothing.
    inside = np.concatenate([np.zeros(1, np.uint32), after[:-1]])[: len(after)] ^ np.uint32(0xFFFFFFFF)
    spaced = (_byte_table()[(inside ^ 32) & 0xFF] ^ (inside >> np.uint32(8))) ^ np.uint32(0xFFFFFFFF)
    spaced[[0] if lead is None else lead] = 0
    ends, out = np.cumsum(sizes + 1), []  # of each word with the space after it
    for n in range(1, longest + 1):
        count = max(0, len(after) - n + 1)
        starts = ends[:count] - sizes[:count] - 1
        out.append(shifted(spaced[:count], ends[n - 1 :][:count] - 1 - starts) ^ after[n - 1 :][:count])
    return out


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def features(texts: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of words of each text, and the bucket of each of its features (16 bits)."""
    counts, words, afters = [], [], []
    for text in texts:
        own = words_of(text)
        counts.append(len(own))
        words.extend(map(len, own))
        afters.append(prefix_crcs(own))
    sizes, begins = np.array(words, np.int64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    # Documents one after another, each with prefixes of its own: runs over two documents are left out.
    after = np.concatenate(afters) if afters else np.zeros(0, np.uint32)
    for n, crc in enumerate(gram_crcs(after, sizes, longest, begins[:-1][np.array(counts) > 0]), 1):
        bucket = (crc % np.uint32(buckets)).astype(np.uint16)
        for i, count in enumerate(counts):
            if count >= n:
                found[i].append(bucket[begins[i] : begins[i] + count - n + 1])
    return np.array(counts, np.int64), [np.concatenate(f) if f else np.zeros(0, np.uint16) for f in found]


def scan(docs: DataFrame, id_col: str, text_col: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words long, buckets binary): each row's features as little-endian 16-bit buckets. No shuffle."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "t", BLOCK):
                counts, found = features([t or b"" for t in batch.column("t").to_pylist()], longest, buckets)
                packed = pa.array([f.astype("<u2").tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts), packed], ["id", "n_words", "buckets"])

    return source.mapInArrow(run, T.StructType([source.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())]))


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket int, n long): features of all rows by bucket; a row per task and bucket is shuffled at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), "<u2"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return scanned.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket, from its counts s and t and
    the totals S and T of corpus and target. ``buckets`` rows reach the driver."""
    s, t = [0] * buckets, [0] * buckets
    for counts, df in ((s, corpus), (t, target)):
        for row in df.collect():
            counts[row["bucket"]] = row["n"]
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t, strict=True)], np.int64)


def weigh(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the floor of the mean gain of the row's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(packed.as_buffer(), "<u2") for packed in batch.column("buckets")]
            size = np.array([len(f) for f in found], np.int64)
            sums = np.array([int(gain[f].sum()) for f in found], np.int64)
            weight = np.where(size > 0, sums // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(size), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

    return scanned.mapInArrow(run, T.StructType([scanned.schema["id"], *(T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight"))]))


def noise(id_col: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), with u from the sha256 of ``seed:id``. A missing id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str = "ranked") -> DataFrame:
    """``rows`` with ``place``: 1, 2, … in the given order. Dealt by range; one row per range is counted and broadcast."""
    at = F.monotonically_increasing_id()
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    table = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", at), name)
    part = F.shiftright("at", 33)
    sizes = table.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("part", before.alias("before")))  # a row per range
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return table.join(offsets, part == F.col("part")).withColumn("place", F.col("before") + inside + 1).drop("at", "part", "before")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED, longest: int = LONGEST, buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_features, weight, score, rank; all long): every row of ``docs``, with its place among the
    floor(percent * N / 100) drawn of the N rows that have ``least_words`` words, or null.

    Null and empty texts (and those without a word) have no features and weight 0. Ties of score go to the smaller id;
    rows without id come after those. Repeated rows are rows of their own, each with its rank; which of equal rows comes
    first makes no difference. An empty ``target`` or ``docs`` counts as one without features; empty ``docs`` give no
    rows. Whole texts count, however long. Other columns are ignored.
    """
    if buckets > 1 << 16:
        raise ValueError("buckets are written in 16 bits")
    scanned = written(scan(docs, id_col, text_col, longest, buckets), "resampling-features")
    aimed = target.select(F.lit(0).alias("id"), F.col(f"`{target_text}`").alias("text"))
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(scan(aimed, "id", "text", longest, buckets), buckets), buckets)
    weighed = weigh(scanned, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    weighed = weighed.withColumn("open", F.col("n_words") >= least_words)
    placed = ranked(weighed, [F.col("open").desc(), F.col("score").desc(), F.col("id").asc_nulls_last()], "resampling-ranked")
    n = scanned.where(F.col("n_words") >= least_words).count()
    rank = F.when(F.col("place") <= percent * n // 100, F.col("place"))
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))
