"""SimHash near-duplicate groups by pivot distance tables.

Fingerprints are compared through their Hamming distances to reference fingerprints (pivots): the zero fingerprint, and
one pivot for each block of two bits, which has just these bits set. For two fingerprints that differ in at most ``r``
bits,

* no distance to any pivot differs by more than ``r`` (triangle inequality): a pair with a larger coordinate difference
  is discarded;
* a differing bit moves the distances to one block's pivot against those to the zero pivot, and to no other block's.
  So with the blocks dealt into ``r + 2`` groups, at least two groups have all their coordinates equal. A pair meets in
  the bucket of some two groups, and nowhere are all pairs compared.

Survivors are verified bit by bit. Buckets of more than ``BUCKET`` distinct fingerprints (near copies by the thousand)
are linked without pairs: two fingerprints differ in at most two bits exactly if they have a common neighbour at
distance one or less, so each sends itself and its 64 neighbours, and all that meet at a neighbour (65 at most) are tied
to the smallest of them. Links of both kinds go into connected components by alternating star contraction.
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import add_columns, hex64, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BUCKET = 64
BLOCK_BITS = 2


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    return np.add.reduce(bits, axis=0, dtype=np.uint32)


def simhash(text: str | None, size: int = SHINGLE, step: int = 1 << 16) -> int:
    """Fingerprint of one text as a signed 64-bit integer; without a word (or text) it is zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else iter([b" ".join(words)])
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while part := [digest(s, SEED) for s in islice(shingles, step)]:
        counts += _bit_counts(np.array(part, dtype="<u8"))
        total += len(part)
    value = int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp long) for each row. Words are split at white space; A-Z count as a-z; repeated shingles count again."""

    def make():
        return lambda texts: [pa.array([simhash(t, size) for t in texts], pa.int64())]

    return add_columns(docs, text_col, [("fp", T.LongType())], make, keep=[id_col])


def pivots() -> list[int]:
    """The zero fingerprint, then one for each block of BLOCK_BITS bits; as signed 64-bit integers."""
    blocks = [((1 << BLOCK_BITS) - 1) << i for i in range(0, 64, BLOCK_BITS)]
    return [0] + [b - (1 << 64) if b >> 63 else b for b in blocks]


def distance_table(prints: DataFrame) -> DataFrame:
    """``prints`` with ``distances``: array of the Hamming distances of fp to all pivots."""
    refs = F.array(*[F.lit(p).cast("long") for p in pivots()])
    return prints.withColumn("distances", F.transform(refs, lambda p: F.bit_count(F.col("fp").bitwiseXOR(p)).cast("byte")))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) fingerprints with a < b, such that the pairs at ``max_bits`` or less are connected through the rows.

    ``distinct`` has one row per fp. Every pair in a bucket of at most ``bucket`` fingerprints is a row of its own;
    larger buckets give star links (only for ``max_bits`` = 2, hence the check).
    """
    if max_bits != 2:
        raise ValueError("buckets beyond the size limit are linked through common neighbours, which means two bits")
    n_blocks = 64 // BLOCK_BITS
    groups = [list(range(g, n_blocks, max_bits + 2)) for g in range(max_bits + 2)]

    def bucket_key(first: int, second: int) -> F.Column:
        # Coordinates of the blocks' pivots against the zero pivot: 0, 1 or 2 bits set in a block.
        digits = [F.col("distances")[0] - F.col("distances")[1 + block] + BLOCK_BITS for block in groups[first] + groups[second]]
        return F.struct(
            F.lit(first * 16 + second).cast("byte").alias("pair"),
            F.xxhash64(F.concat(*[F.chr(48 + d) for d in digits])).alias("at"),
        )

    keyed = written(
        distance_table(distinct.select("fp"))
        .select("fp", "distances", F.explode(F.array(*[bucket_key(i, j) for i, j in combinations(range(max_bits + 2), 2)])).alias("k"))
        .select("k.pair", "k.at", "fp", "distances"),
        "simhash-buckets",
    )
    sizes = keyed.groupBy("pair", "at").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(keyed.join(sizes, ["pair", "at"]), "simhash-shared")

    small = shared.where(F.col("members") <= bucket)
    a, b = small.alias("a"), small.alias("b")
    close = F.forall(F.zip_with("a.distances", "b.distances", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), lambda d: d <= max_bits)
    pairs = a.join(
        b,
        (F.col("a.pair") == F.col("b.pair")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.fp") < F.col("b.fp"))
        & close & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    crowded = shared.where(F.col("members") > bucket).select("fp").distinct()
    near = written(
        crowded.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("near")), "simhash-near"
    )
    least = near.groupBy("near").agg(F.min("fp").alias("least"), F.count("*").alias("met")).where("met > 1")
    stars = near.join(least, "near").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of ``edges`` (a, b longs).

    Alternating star contraction: each round ties the larger neighbours of a node to its smallest neighbour, then the
    smaller ones. Few rounds even for long chains; each round's edges are written, so lineage stays short.
    """

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return row["n"], row["x"]

    def smallest(directed: DataFrame) -> DataFrame:
        """Of each ``u``: its edges with the smallest of its neighbours and itself as m."""
        least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return directed.join(least, "u")

    now = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = smallest(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        large = written(large, "large-star")
        up = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        met = smallest(up)
        small = met.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(met.select(F.col("m").alias("a"), F.col("u").alias("b")))
        now = written(small.where("a <> b").distinct(), "small-star")
        last, seen = seen, state(now)
        if last == seen:
            break
    return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp long, fingerprint 16 hex digits, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest id among all documents that chains of links reach, the document itself included.
    Null text counts as empty; texts without a word share the zero fingerprint, which links like any other. Repeated
    rows and equal texts have equal fingerprints and so one component. Rows without id take part; a component of only
    such rows has no component_id. An empty table gives no rows. Other columns are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col, size).withColumnRenamed(id_col, "id"), "simhash-prints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    labels = written(components(links(distinct, max_bits)), "simhash-labels")
    every = labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
    members = distinct.join(every, distinct["fp"] == every["node"]).select("fp", "first", "label")
    least = members.groupBy("label").agg(F.min("first").alias("least"))
    linked = members.join(least, "label").select("fp", "least")
    of = distinct.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(of, "fp").select(F.col("id").alias(id_col), "fp", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the smallest id, once if its row is repeated.

    Of groups whose rows all lack an id, each different text stays once.
    """
    kept = near_duplicates(docs, id_col, text_col).where(F.col("component_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias("kept_id"))
    found = docs.join(kept.distinct(), docs[id_col].eqNullSafe(F.col("kept_id")), "left_semi")
    unnamed = F.when(F.col(id_col).isNull(), F.col(text_col))
    return found.withColumn("unnamed_text", unnamed).dropDuplicates([id_col, "unnamed_text"]).select(*docs.columns)
