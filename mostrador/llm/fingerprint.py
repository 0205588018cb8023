"""Document fingerprints: a homomorphic multiset hash over paragraphs, in column expressions alone.

Every paragraph (what line ends and ends of sentences part) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo powers of two. So the order of paragraphs does not matter, equal texts have equal
fingerprints, and a paragraph can be put in or taken out without the rest of the text. The vector has one lane of 60 bits
(sum of 60-bit hashes), one that counts paragraphs, and 128 lanes of 16 bits, each of which counts the paragraphs that have a certain hash bit set. With
the number of paragraphs a counting lane is a sum of random signs, and the mean square of two documents' differences over
the lanes estimates how many paragraphs they don't share: that gives the likeness.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What parts paragraphs.
PARAGRAPH = r"\n|(?<=[.!?]) "
SEEDS = (11, 23)
_WIDE = (1 << 60) - 1
# A word of 64 bits holds the counters of the hash bits s, s + 22 and s + 44, each 16 bits wide with spare bits above.
_STEP = 22
_BITS = 1 | 1 << _STEP | 1 << 2 * _STEP
_COUNTERS = 0xFFFF * _BITS
_SPARE = (1 << 16) * _BITS
WORDS = 2 + _STEP * len(SEEDS)
#: Documents of a bucket that is sorted by id in one task (it can spill), and buckets at most: beyond, buckets grow.
BUCKET_ROWS, MAX_BUCKETS = 4096, 20_000


def _big(value: int) -> Column:
    return F.lit(value).cast("long")


def hashes(text: Column) -> list[Column]:
    """For each seed the array of the paragraphs' hashes."""

    def under(seed: int) -> Column:
        return F.transform(F.split(text, PARAGRAPH), lambda p: F.xxhash64(F.lit(seed), p))

    return [under(seed) for seed in SEEDS]


def vector(hashed: list[str]) -> Column:
    """The fingerprint as an array of WORDS longs, from columns with the hashes."""

    def total(column: str, part, mask: int) -> Column:
        return F.aggregate(column, _big(0), lambda a, h: (a + part(h)).bitwiseAND(_big(mask)))

    def counters(column: str, shift: int) -> Column:
        return total(column, lambda h: F.shiftrightunsigned(h, shift).bitwiseAND(_big(_BITS)), _COUNTERS)

    wide = total(hashed[0], lambda h: h.bitwiseAND(_big(_WIDE)), _WIDE)
    return F.array(wide, F.size(hashed[0]).cast("long"), *[counters(c, s) for c in hashed for s in range(_STEP)])


def insert(fingerprint: Column, other: Column) -> Column:
    """Fingerprint (as an array) of both texts' paragraphs together."""
    return F.zip_with(F.zip_with(fingerprint, other, lambda a, b: a + b), _masks(), lambda v, m: v.bitwiseAND(m))


def delete(fingerprint: Column, other: Column) -> Column:
    """Fingerprint (as an array) without the paragraphs of ``other``."""
    spare = F.array(_big(1 << 60), _big(1 << 60), *[_big(_SPARE)] * (WORDS - 2))
    lent = F.zip_with(F.zip_with(fingerprint, spare, lambda a, s: a + s), other, lambda a, b: a - b)
    return F.zip_with(lent, _masks(), lambda v, m: v.bitwiseAND(m))


def _masks() -> Column:
    return F.array(_big(_WIDE), _big(_WIDE), *[_big(_COUNTERS)] * (WORDS - 2))


def shown(fingerprint: Column) -> Column:
    """As text: 16 lower-case hexadecimal digits for each word."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def _signs(fingerprint: Column) -> Column:
    """The counting lanes as sums of signs: twice the count, less the number of paragraphs (modulo 2 ** 16)."""
    lanes = F.flatten(
        F.transform(
            F.slice(fingerprint, 3, WORDS - 2),
            lambda v: F.array(*[F.shiftrightunsigned(v, k * _STEP).bitwiseAND(_big(0xFFFF)) for k in range(3)]),
        )
    )
    # Shifts past 19 have no third bit (a hash has 64): those lanes are left out.
    used = F.filter(lanes, lambda v, i: ((i % 3) < 2) | (((i / 3).cast("int") % _STEP) < 64 - 2 * _STEP))
    return F.transform(used, lambda v: 2 * v - F.get(fingerprint, F.lit(1)))


def _square(signs: Column) -> Column:
    def wrapped(v: Column) -> Column:
        return (v + 0x8000).bitwiseAND(_big(0xFFFF)) - 0x8000

    return F.aggregate(signs, F.lit(0.0), lambda a, v: a + wrapped(v).cast("double") * wrapped(v).cast("double"))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1 from two fingerprints (arrays): estimates twice the shared paragraphs over all paragraphs of both; 1 if the
    fingerprints are equal."""
    a, b = _signs(one), _signs(other)
    apart = _square(F.zip_with(a, b, lambda x, y: x - y))
    both = _square(a) + _square(b)
    near = F.when(both > 0, 1.0 - apart / both).otherwise(F.lit(0.0))
    return F.when(one == other, F.lit(1.0)).otherwise(F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0)))


def _buckets(ids: DataFrame) -> tuple[Column, list[int]]:
    """The bucket of ``id`` by ranges of about BUCKET_ROWS documents, as a column, and the number of buckets."""
    rows = ids.count()
    count = min(MAX_BUCKETS, max(1, rows // BUCKET_ROWS))
    if count == 1:
        return F.lit(0), [0]
    at = [i / count for i in range(1, count)]
    bounds = sorted(set(ids.select(F.percentile_approx("id", F.array(*map(F.lit, at)), F.lit(10 * count + 1000)).alias("q")).first()["q"]))
    # Two levels, so that a row is compared with a few hundred bounds at most.
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[_big(g[0]) for g in groups])
    lists = F.array(*[F.array(*map(_big, g)) for g in groups])
    head = F.size(F.filter(heads, lambda b: b <= F.col("id")))
    inside = F.size(F.filter(F.get(lists, head - 1), lambda b: b <= F.col("id")))
    return F.when(head == 0, 0).otherwise((head - 1) * width + inside), list(range(len(bounds) + 1))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (id and ``columns``) with the columns ``next_...`` of the next document by descending id; the last one's
    next is the first.

    Ids are cut into ranges; a range's last document finds its next in a copy of the first document of the range below.
    So there is one shuffle, by range, and no task sees more than a range. Rows with one id follow one another by their
    columns' values; missing ids come last.
    """
    # The least long stands for a missing id, which so comes last.
    rows = docs.select(F.coalesce(F.col("id"), _big(-(1 << 63))).alias("id"), F.col("id").isNull().alias("no id"), *columns)
    bucket, _ = _buckets(rows.select("id"))
    tops = rows.select("id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("id").alias("top")).orderBy(F.desc("bucket")).collect()
    if not tops:
        return docs.select("id", *columns, *[F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns])
    above = [tops[-1]["bucket"], *[t["bucket"] for t in tops[:-1]]]
    # One row per range: MAX_BUCKETS at most.
    copies = docs.sparkSession.createDataFrame([(t["top"], b) for t, b in zip(tops, above, strict=True)], "top long, above int")
    home = F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("copy"))
    away = F.struct(F.col("above").alias("bucket"), F.lit(True).alias("copy"))
    dealt = rows.join(F.broadcast(copies), F.col("id") == F.col("top"), "left").select(
        "id", "no id", *columns, F.explode(F.when(F.col("above").isNull(), F.array(home)).otherwise(F.array(home, away))).alias("at")
    )
    order = W.partitionBy("at.bucket").orderBy("at.copy", F.desc("id"), *[F.desc(c) for c in columns])
    found = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("not at.copy")
    named = F.when(~F.col("no id"), F.col("id"))
    return found.select(named.alias("id"), *columns, *[f"next_{c}" for c in columns])


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    Edited: the last floor(n_chars / 2) code points of the text replaced by the first as many (or all) of the next
    document's. Fingerprints are arrays. Null text counts as empty (one empty paragraph). A single document is its own
    next one. Repeated rows follow one another. An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [f"h{i}" for i in range(len(SEEDS))]
    hashed = texts.select("id", "text", *[h.alias(n) for h, n in zip(hashes(F.col("text")), names, strict=True)])
    own = hashed.select("id", "text", vector(names).alias("fingerprint"))
    pairs = with_next(own, ["text", "fingerprint"])
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    pairs = pairs.select("id", size.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    again = pairs.select("*", *[h.alias(n) for h, n in zip(hashes(F.col("edited")), names, strict=True)])
    done = again.select("id", "n_chars", "edited", "fingerprint", "next_fingerprint", vector(names).alias("edited_fingerprint"))
    return done.select(
        F.col("id").alias(id_col), "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
