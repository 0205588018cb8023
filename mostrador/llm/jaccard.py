"""N-gram Jaccard join: documents whose shingle sets are alike, as classes and chains of links.

Sets are compared within tiles. A tile belongs to a band of set sizes, and holds sets of that band with those a little
larger that can still be alike; in each band sets at the threshold differ in at most ``k`` shingles. So of any ``k + 1``
parts of the hash space, two such sets have one in common: their shingles there are the same. A tile is one band, one
part and one content of that part; every pair that links meets in some tile, and a passage that many documents share
opens a tile only where nothing else of a document falls into the part. Parts with next to no shingle say little: there
are ``spare`` parts more, and only sets with more poor parts than that open tiles for these, too.

Each set has a signature, a bitmap of hashed shingles. Bits that one set has and the other lacks stand for at least as
many shingles that the other lacks, so bit counts bound the overlap from above. Pairs that the bound lets through get
the exact intersection of their sorted arrays.

Equal sets are one class from the start. In every tile all sets are first held against its smallest one, a row per set.
Sets that this links are one component; tiles whose sets are all in one component are done. Sets that the other tiles
chain together are a group. A group of bounded size meets in one task, each set once, however many tiles its pairs share;
there all pairs of different components are decided and only the links that tie components come out. The tiles of larger
groups are compared through signatures in blocks of bounded size, each set with its best partners of other components
first, which ties what remains of them, and at last with all that the bound lets through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import blocks, written
from mostrador.llm.simhash import components

SHINGLE = 3
#: Two sets link if their intersection is at least this share of their union.
SHARE = (90, 100)
BITS = 1024
#: Next band's first size against this one's.
BAND = (5, 4)
#: Parts with fewer shingles say little.
POOR = 2
#: Sets in a block of a tile.
BLOCK = 4096
#: Most sets, and shingles of all its sets (32 MB), of a group that one task decides.
GROUP = (4096, 1 << 22)
#: Partners that a set proposes in a block, round after round; None: all.
PROPOSALS = (2, 2, None)
#: Bits of the filter (4 MB) that tells which sets meet others. Others that pass, too, only cost their transport.
FILTER_BITS = 1 << 25
TEXT_BLOCK = 4 << 20

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mix(h: np.ndarray, by: int = 0) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_ODD[by])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_ODD[(by + 1) % 3])
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different runs of ``size`` words (fewer words: one hash of all; none: empty)."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = min(size, len(words))
    out = np.full(len(hashes) - run + 1, run, np.uint64)
    for i in range(run):
        out += hashes[i : len(hashes) - run + 1 + i] * np.uint64(pow(_ODD[0], 2 * i + 1, 1 << 64))
    return np.unique(_mix(out))


class Bands:
    """The tiles of each set size, for a threshold."""

    def __init__(self, share: tuple[int, int] = SHARE):
        self.least, self.most = share
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * BAND[0] // BAND[1]))
        self.bounds = cache(self._bounds)

    def largest(self, band: int) -> int:
        """Size of the largest set that can be alike to one of the band."""
        return (self.starts[band + 1] - 1) * self.most // self.least

    def differ(self, band: int) -> int:
        """Shingles that only one of two alike sets has, at most."""
        return (self.starts[band + 1] - 1 + self.largest(band)) * (self.most - self.least) // (self.most + self.least)

    def spare(self, band: int) -> int:
        k = self.differ(band)
        return 1 if k < 8 else 2 + k // 128

    def _bounds(self, band: int) -> np.ndarray:
        """Inner bounds of the parts of the hash space."""
        parts = self.differ(band) + 1 + self.spare(band)
        return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def of(self, size: int) -> list[int]:
        """Bands whose tiles a set of this size enters: its own, and the smaller ones that reach up to it."""
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        out = [own]
        while out[-1] > 0 and self.largest(out[-1] - 1) >= size:
            out.append(out[-1] - 1)
        return [b for b in out if self.differ(b)]

    def tiles(self, found: np.ndarray) -> np.ndarray:
        """Keys of the tiles of one set."""
        mixed = _mix(found, 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
        out = []
        for band in self.of(len(found)):
            if self.differ(band) == 1:
                # One set is the other without one shingle.
                content, part = np.append(sums[-1:], sums[-1] - mixed), np.zeros(len(found) + 1, np.uint64)
            else:
                edges = np.concatenate([[0], np.searchsorted(found, self.bounds(band)), [len(found)]])
                content, part = sums[edges[1:]] - sums[edges[:-1]], np.arange(len(edges) - 1, dtype=np.uint64)
                rich = np.diff(edges) >= POOR
                if len(rich) - rich.sum() <= self.spare(band):
                    content, part = content[rich], part[rich]
            out.append(_mix(content + _mix(part + np.uint64(band << 40), 2)))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a, b = _mix(np.array([_mix(found, 1).sum(), _mix(found, 2).sum()], np.uint64) + np.uint64(len(found))).view(np.int64).tolist()
    return a, b


def signature(found: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bitmap of the hashed shingles, as 64-bit integers."""
    flags = np.zeros(bits, np.uint8)
    flags[(_mix(found, 2) % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def scan(docs: DataFrame, size: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, n, h1, h2, keys) of documents (id, t binary): size and identity of the set, keys of its tiles. Of rows of a
    task with one set only the first has the keys. A row without words has no identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(share), set()
        for whole in batches:
            for batch in blocks(whole, "t", TEXT_BLOCK):
                n, h1, h2, keys = [], [], [], []
                for text in batch.column("t").to_pylist():
                    found = shingle_set(text or b"", size)
                    name = identity(found) if len(found) else (None, None)
                    n.append(len(found))
                    h1.append(name[0])
                    h2.append(name[1])
                    keys.append(bands.tiles(found) if len(found) and name not in seen else np.zeros(0, np.uint64))
                    seen.add(name)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), _lists(keys)], ["id", "n", "h1", "h2", "keys"])

    fields = [T.StructField(n, T.LongType()) for n in ("n", "h1", "h2")]
    return docs.mapInArrow(run, T.StructType([docs.schema["id"], *fields, T.StructField("keys", T.ArrayType(T.LongType()))]))


def _met(ids: DataFrame) -> np.ndarray:
    """Filter of FILTER_BITS bits that has the remainder of every ``h1`` of ``ids`` set. Its size does not depend on them."""
    at = F.col("h1").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    parts = ids.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
    out = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for row in parts.collect():
        out[row["b"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def pool(docs: DataFrame, ids: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(h1, h2, n, bits, hashes): each set of the documents (id, t binary) whose h1 is in ``ids``, once. A few others may
    come along."""
    met = docs.sparkSession.sparkContext.broadcast(_met(ids))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits, seen = met.value, set()
        for whole in batches:
            for batch in blocks(whole, "t", TEXT_BLOCK):
                rows = []
                for text in batch.column("t").to_pylist():
                    found = shingle_set(text or b"", size)
                    if not len(found):
                        continue
                    name = identity(found)
                    at = name[0] & (FILTER_BITS - 1)
                    if filter_bits[at >> 3] >> (at & 7) & 1 and name not in seen:
                        seen.add(name)
                        rows.append((*name, len(found), signature(found), found.tobytes()))
                if rows:
                    h1, h2, n, bits, hashes = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(n, pa.int64()), _lists(list(bits)), pa.array(hashes, pa.binary())], ["h1", "h2", "n", "bits", "hashes"])

    return docs.mapInArrow(run, "h1 long, h2 long, n long, bits array<long>, hashes binary").dropDuplicates(["h1", "h2"])


def may_link(a: str, b: str, share: tuple[int, int] = SHARE, bits: int = BITS) -> Column:
    """Whether the overlap of two rows (n, bits) can be large enough, by their bit counts."""
    col = lambda side, name: F.col(f"{side}.{name}")
    only = lambda x, y: sum((F.bit_count(col(x, "bits")[i].bitwiseAND(F.bitwise_not(col(y, "bits")[i]))) for i in range(bits >> 6)), F.lit(0))
    overlap = F.least(col(a, "n") - only(a, b), col(b, "n") - only(b, a))
    return overlap * (share[0] + share[1]) >= F.lit(share[0]) * (col(a, "n") + col(b, "n"))


def alike(p: np.ndarray, q: np.ndarray, share: tuple[int, int] = SHARE) -> bool:
    """Whether the intersection of two sorted sets is at least the share of their union."""
    small, large = (p, q) if len(p) <= len(q) else (q, p)
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return share[1] * both >= share[0] * (len(p) + len(q) - both)


def linked(pairs: DataFrame, sets: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """The pairs (a, b) of nodes of ``sets`` (node, hashes) whose intersection is at least the share of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), share)
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"])

    x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _overlaps(n: np.ndarray, bits: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
    """Upper bounds of the overlaps of sets ``rows`` with sets ``cols``."""
    common = np.zeros((rows.stop - rows.start, cols.stop - cols.start), np.int32)
    for word in range(bits.shape[1]):
        common += np.bitwise_count(bits[rows, word, None] & bits[None, cols, word])
    counts = np.bitwise_count(bits).sum(1, dtype=np.int64)
    return np.minimum((n - counts)[rows, None], (n - counts)[None, cols]) + common


def _propose(node: np.ndarray, label: np.ndarray, n: np.ndarray, bits: np.ndarray, best: int | None, share: tuple[int, int], step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of a block with different labels whose overlap may suffice; of each set only the ``best`` ones."""
    a, b = [], []
    for start in range(0, len(node), step):
        rows, every = slice(start, min(start + step, len(node))), slice(0, len(node))
        need = share[0] * (n[rows, None] + n[None, :])
        over = _overlaps(n, bits, rows, every) * (share[0] + share[1]) - need
        over = np.where(label[rows, None] == label[None, :], -1, over)
        if best is not None and over.shape[1] > best:
            top = np.argpartition(-over, best - 1, axis=1)[:, :best]
            i, j = np.repeat(np.arange(len(top)), best), top.ravel()
            good = over[i, j] >= 0
            i, j = i[good], j[good]
        else:
            i, j = np.nonzero(over >= 0)
        a.append(node[start + i])
        b.append(node[j])
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def proposals(members: DataFrame, best: int | None, share: tuple[int, int] = SHARE, block: int = BLOCK) -> DataFrame:
    """(a, b) of the rows (key, node, label, n, bits) of tiles: pairs in one tile, of different labels, that the signatures
    let through. Tiles of more than ``block`` sets are compared block by block."""
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / block).alias("parts"))
    # Blocks i <= j meet at (i, j); a set of block i goes there with every j.
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = members.join(counts, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, i, j); the last group of a batch waits for the next."""
        kept = None

        def done(table: pa.RecordBatch, edges: list[int]) -> Iterator[pa.RecordBatch]:
            node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
            bits = table.column("bits").flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            found = [_propose(node[s:e], label[s:e], n[s:e], bits[s:e], best, share) for s, e in zip(edges, edges[1:], strict=False) if e - s > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if kept is None else pa.concat_batches([kept, batch])
            at = np.stack([whole.column(c).to_numpy() for c in ("key", "i", "j")])
            edges = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist()]
            yield from done(whole, edges)
            kept = whole.slice(edges[-1])
        if kept is not None:
            yield from done(kept, [0, kept.num_rows])

    order = ["key", "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def _groups(rest: DataFrame) -> DataFrame:
    """(node, grp) of the rows (key, node) of tiles: nodes that tiles chain together are one group."""
    least = rest.groupBy("key").agg(F.min("node").alias("a"))
    return _labelled(rest.select("node").distinct(), rest.join(least, "key").select("a", F.col("node").alias("b"))).withColumnRenamed("label", "grp")


def _ties(label: np.ndarray, n: np.ndarray, bits: np.ndarray, hashes: list[np.ndarray], share: tuple[int, int], step: int = 256) -> list[tuple[int, int]]:
    """Links (places) that tie the components of a group: the labels, and after them what links join. At most one less
    than there are labels; every pair of different components that the bound lets through is decided."""
    _, owner = np.unique(label, return_inverse=True)
    out = []
    for start in range(0, len(n), step):
        rows, later = slice(start, min(start + step, len(n))), slice(start, len(n))
        over = _overlaps(n, bits, rows, later) * (share[0] + share[1]) - share[0] * (n[rows, None] + n[None, later])
        i, j = np.nonzero((over >= 0) & (owner[rows, None] != owner[None, later]))
        for x, y in zip((start + i[i < j]).tolist(), (start + j[i < j]).tolist(), strict=True):
            if owner[x] != owner[y] and alike(hashes[x], hashes[y], share):
                owner[owner == owner[y]] = owner[x]
                out.append((x, y))
    return out


def group_links(members: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """(a, b) of the rows (grp, node, label, n, bits, hashes) of groups of at most GROUP: links that tie all components of
    a group which links connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by grp; the last group of a batch waits for the next."""
        kept: list[pa.RecordBatch] = []

        def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.concat_batches(parts)
            node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
            bits = table.column("bits").flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            hashes = [np.frombuffer(h.as_buffer(), np.uint64) for h in table.column("hashes")]
            ties = np.array(_ties(label, n, bits, hashes, share), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(node[ties[:, 0]]), pa.array(node[ties[:, 1]])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            grp = batch.column("grp").to_numpy()
            edges = [0, *(np.flatnonzero(grp[1:] != grp[:-1]) + 1).tolist(), len(grp)]
            for s, e in zip(edges, edges[1:], strict=False):
                if kept and kept[0].column("grp")[0].as_py() != grp[s]:
                    yield done(kept)
                    kept = []
                kept.append(batch.slice(s, e - s))
        if kept:
            yield done(kept)

    return members.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def _labelled(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``sets``."""
    found = components(links)
    return sets.select("node").join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def links(docs: DataFrame, scanned: DataFrame, size: int = SHINGLE, share: tuple[int, int] = SHARE, group: tuple[int, int] = GROUP) -> DataFrame:
    """Sets (h1, h2, node, label) that meet others, with the component of each by its links.

    ``docs``: (id, t binary); ``scanned``: what :func:`scan` gives for them; ``group``: most sets and shingles of a group
    that one task decides.
    """
    tiled = scanned.select("h1", F.explode("keys").alias("key"))
    shared = tiled.groupBy("key").agg(F.min("h1").alias("least"), F.max("h1").alias("most")).where("least < most")
    members = written(tiled.join(shared, "key").select("key", "h1", "least"), "jaccard-tiles")
    sets = written(pool(docs, members.select("h1"), size).withColumn("node", F.monotonically_increasing_id()), "jaccard-sets")
    slim = sets.select("h1", "node", "n", "bits")

    pairs = members.where("h1 <> least").select("least", "h1").distinct()
    a, b = slim.alias("a"), slim.alias("b")
    close = pairs.join(a, pairs["least"] == F.col("a.h1")).join(b, pairs["h1"] == F.col("b.h1")).where(may_link("a", "b", share))
    found = written(linked(close.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")), sets, share), "jaccard-links")

    rest = members.where("h1 <> least").select("key", "h1").distinct().join(slim.select("h1", "node"), "h1").select("key", "node")
    for best in PROPOSALS:
        labels = written(_labelled(slim, found), "jaccard-labels")
        rest = rest.join(labels, "node")
        several = rest.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
        rest = written(rest.join(several, "key"), "jaccard-rest")
        if rest.isEmpty():
            break
        groups = written(_groups(rest).join(slim.select("node", "n"), "node"), "jaccard-groups")
        sizes = groups.groupBy("grp").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
        few = (F.col("sets") <= group[0]) & (F.col("shingles") <= group[1])
        whole = groups.join(sizes.where(few).select("grp"), "grp").select("grp", "node").join(labels, "node").join(sets.select("node", "n", "bits", "hashes"), "node")
        found = written(found.unionByName(group_links(whole, share)), "jaccard-links")
        rest = written(rest.join(groups.join(sizes.where(~few).select("grp"), "grp").select("node"), "node", "left_semi"), "jaccard-rest")
        if rest.isEmpty():
            labels = written(_labelled(slim, found), "jaccard-labels")
            break
        proposed = proposals(rest.join(slim.select("node", "n", "bits"), "node"), best, share)
        found = written(found.unionByName(linked(proposed, sets, share)), "jaccard-links")
        rest = rest.select("key", "node")
    else:
        labels = written(_labelled(slim, found), "jaccard-labels")
    return sets.select("h1", "h2", "node").join(labels, "node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, n_shingles long, class_id, component_id): one row per row of ``docs``.

    Two documents link if the intersection of their sets of ``size``-word shingles is at least ``share`` of the union.
    Words are runs without space and U+0009 to U+000D, A-Z count as a-z. A text of fewer words is one shingle; null, empty
    and wordless texts have none and link with nothing, not even with each other. ``class_id`` is the smallest id with the
    same set, ``component_id`` the smallest id that chains of links reach. Repeated rows and ids are rows of their own.
    Rows without id take part; where only such rows are, the ids are null. An empty table gives no rows. Other columns are
    ignored, and texts count whole, however long.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    scanned = written(scan(source, size, share), "jaccard-scan")
    met = links(source, scanned, size, share)
    classes = scanned.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("class_id"))
    named = written(classes.join(met, ["h1", "h2"], "left").select("h1", "h2", "class_id", "label"), "jaccard-classes")
    least = named.where("label IS NOT NULL").groupBy("label").agg(F.min("class_id").alias("least"))
    whole = named.join(least, "label", "left").select("h1", "h2", "class_id", F.coalesce("least", "class_id").alias("component_id"))
    rows = scanned.select("id", "n", "h1", "h2")
    full = rows.where("n > 0").join(whole, ["h1", "h2"]).select("id", "n", "class_id", "component_id")
    bare = rows.where("n = 0").select("id", "n", F.col("id").alias("class_id"), F.col("id").alias("component_id"))
    return full.unionByName(bare).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "class_id", "component_id")
