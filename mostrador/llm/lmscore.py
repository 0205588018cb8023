"""Masked pseudo-likelihood of documents under a bidirectional window network.

Each word is predicted from the words on both its sides. The vocabulary is every different word of the corpus (by a 64-bit
hash of it) with its count and its rank by count, written as a table that only joins read. Words lie by rank in a tree: the
most frequent are classes of their own, all others are in ``SHARED`` branches of about equal weight, each halved by weight
down to single words:

    P(word | both sides) = P(class | both sides) * product over the halvings of P(the word's half | both sides).

The tree needs no list of words. Ranks with the same count form a run, so the runs (count, words) give the weight of any
stretch of ranks; a corpus of N words has at most sqrt(2 N) runs, which is what bounds the driver and the tasks' closure.

The corpus is read once: blocks of texts become codes into the block's own dictionary, the dictionaries meet the vocabulary
in a join on the word's hash, and the documents are written as ranks. From these the network is trained in numpy. It sums one
embedding for each neighbour (by place) and applies tanh; a softmax layer gives the class, and each halving has a logistic
output beside the odds of its halves by the counts. Each word of each document is the masked one once, one word in
``MASKED`` at a time. Each task trains on its documents from the same start, and the parameters are averaged by the number
of words (``ROUNDS`` times), so another partitioning gives another, equally valid network. Every word of every document is
then scored. Words that the corpus lacks share spare ranks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import blocks, own_copy, release, small_batches, written

INPUTS = 2048
CLASSES, SHARED = 64, 16
#: Halvings with an output of their own; the deeper ones share as many. A power of two, at most 2**15.
NODES = 1 << 13
SIDE = 2
WIDTH = 16
MASKED = 8
ROUNDS = 2
RATE = 0.1
#: Words in a step of training. Gradients of repeated rows add up in dense sums, which pays for larger steps.
BATCH = 8192
#: Words that are scored at once, and their halvings.
_CHUNK, _HALVINGS = 8192, 1 << 17
#: The most frequent words, whose ranks travel with the tasks and so don't meet in the join.
HEAD = 1 << 15
_STEPS = np.array([[s] for s in range(-SIDE, SIDE + 1) if s])
_ONES = np.ones(CLASSES, np.float32)
#: The most frequent words, whose ways through the tree a task keeps from block to block (about 150 bytes each).
_KEPT = 1 << 17


def _different(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (64-bit hashes, 0 for an empty piece) of the different words of all texts, which of them each word is, and each
    text's number of words. Words are what white space parts, in lower case. Null counts as empty."""
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(own_copy(texts))))
    coded = pc.dictionary_encode(lists.flatten())
    names = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    keys = (np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names)) ^ np.uint64(1 << 63)).view(np.int64)
    keys[keys == 0] = 1
    keys[pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)] = 0
    del names
    at = coded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if keys.all():
        return keys, at, np.diff(offsets).astype(np.int64)
    real = keys[at] != 0  # an empty text gives an empty piece
    ends = np.concatenate([[0], np.cumsum(real)])[offsets]
    return keys, at[real], np.diff(ends)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of all texts one after another, and each text's number of words."""
    keys, at, sizes = _different(texts)
    return keys[at], sizes


def _planes(values: np.ndarray) -> bytes:
    """Non-negative numbers as bytes: how many each needs, then all lowest bytes, all next ones, and so on."""
    k = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([k]) + values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    k = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(k, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :k] = planes.T
    return out.view("<i8").ravel()


def cut(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One written row per block of about 16 MB of text: a block number, the documents' columns ``keep`` (default all),
    their numbers of words, their words as codes into the block's dictionary, and that dictionary's keys and counts."""
    kept = docs.columns if keep is None else keep
    inside = [f"k{i}" for i in range(len(kept))]
    rows = small_batches(docs, 16 << 20).select(F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inside, strict=True)], F.col(f"`{text_col}`").alias("text of doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text of doc"):
                keys, at, sizes = _different(batch.column("text of doc"))
                n = np.bincount(at, minlength=len(keys))
                order = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]
                code = np.zeros(len(keys), np.int64)
                code[order] = np.arange(len(order))
                some = pa.StructArray.from_arrays([batch.column(c) for c in inside] or [batch.column("row")], names=inside or ["row"])
                columns = [
                    batch.column("row").slice(0, 1), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some),
                    *(pa.array([x], pa.binary()) for x in (_planes(sizes), _planes(code[at]), keys[order].astype("<i8").tobytes(), _planes(n[order]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "docs", "sizes", "codes", "keys", "n"])
        release()

    inner = T.StructType([T.StructField(n, rows.schema[n].dataType) for n in inside] or [T.StructField("row", T.LongType())])
    binary = [T.StructField(n, T.BinaryType()) for n in ("sizes", "codes", "keys", "n")]
    return written(rows.mapInArrow(run, T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(inner)), *binary])), "lm-blocks")


def vocabulary(cuts: DataFrame) -> DataFrame:
    """(key, n, leaf): every different word of the corpus with its occurrences and its rank, the most frequent first. A
    written table; ranks come from the places within sorted partitions and these partitions' sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, "<i8")), pa.array(_numbers(n))], ["key", "n"])
        release()

    found = cuts.select("keys", "n").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    dealt = found.repartitionByRange(F.desc("n"), "key").sortWithinPartitions(F.desc("n"), "key")
    placed = written(dealt.withColumn("place", F.monotonically_increasing_id()), "lm-words")
    part = F.shiftright("place", 33).alias("part")
    # One small row per partition.
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect())
    starts = np.cumsum([0] + [n for _, n in sizes]).tolist()
    offsets = cuts.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts, strict=False)], "part long, start long")
    ranked = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return written(ranked.select("key", "n", (F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("leaf")), "lm-vocabulary")


@dataclass
class Tree:
    """Leaves are ranks. Items are runs of leaves with one count; halvings are between items, then within an item."""

    words: int  # leaves that are words; SHARED spare ones follow
    first: np.ndarray  # first leaf of each item, and the end
    n: np.ndarray  # count of each leaf of the item
    own: int  # items (of one leaf) that are classes of their own
    edges: np.ndarray  # first item of each branch, and the end
    root: np.ndarray = field(default=None)  # of each branch: a halving, or -1 if it is one item
    mid: np.ndarray = field(default=None)  # of each halving: first item of the upper half
    odds: np.ndarray = field(default=None)  # log odds of the upper half by the counts
    lower: np.ndarray = field(default=None)  # next halving on either side, or -1
    upper: np.ndarray = field(default=None)
    kept: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "kept": None}  # found anew in each task

    @staticmethod
    def build(counts: np.ndarray, sizes: np.ndarray) -> Tree:
        """From the different counts, falling, and the number of words of each."""
        words = int(sizes.sum())
        own = min(CLASSES - SHARED, words)
        starts = np.cumsum(sizes) - sizes
        total = max(1, int((counts * sizes).sum()))
        # Leaves of their own at the top; then runs, in pieces of at most 1 / 256 of all occurrences; then spare leaves.
        cuts = [np.arange(own), starts[starts >= own], [own, words]]
        for s, m, n in zip(starts.tolist(), sizes.tolist(), counts.tolist(), strict=True):
            if n * m * 256 > total and m > 1:
                pieces = np.linspace(s, s + m, min(m, n * m * 256 // total + 1) + 1).astype(np.int64)
                cuts.append(pieces[pieces >= own])
        first = np.unique(np.concatenate([np.asarray(c, np.int64) for c in cuts]))
        n = np.append(counts[np.searchsorted(starts, first[:-1], "right") - 1], 1) if words else np.ones(1, np.int64)
        first = np.append(first, words + SHARED)
        below = np.concatenate([[0], np.cumsum(n * np.diff(first))])
        items = len(n)
        edges = np.searchsorted(below, below[own] + (below[-1] - below[own]) * np.arange(SHARED + 1) // SHARED)
        edges[0], edges[-1] = own, items
        tree = Tree(words, first, n, own, np.maximum.accumulate(edges))
        tree._halve(below)
        return tree

    def _halve(self, below: np.ndarray) -> None:
        """Level by level: each stretch of items is parted where its weight is halved."""
        low, high = self.edges[:-1], self.edges[1:]
        lists: dict[str, list] = {"mid": [], "odds": [], "lower": [], "upper": []}
        numbered, parents = 0, None
        while True:
            more = np.flatnonzero(high - low > 1)
            number = np.full(len(low), -1)
            number[more] = numbered + np.arange(len(more))
            numbered += len(more)
            if parents is None:
                self.root = number
            else:
                lists["lower"].append(number[:parents])
                lists["upper"].append(number[parents:])
            if not len(more):
                break
            low, high, parents = low[more], high[more], len(more)
            mid = np.clip(np.searchsorted(below, (below[low] + below[high]) // 2), low + 1, high - 1)
            lists["mid"].append(mid)
            lists["odds"].append(np.log((below[high] - below[mid]) / (below[mid] - below[low])))
            low, high = np.concatenate([low, mid]), np.concatenate([mid, high])
        for name, found in lists.items():
            setattr(self, name, np.concatenate(found) if found else np.zeros(0, np.int64))

    @property
    def size(self) -> int:
        return int(self.first[-1])

    def items_of(self, leaf: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, leaf, "right") - 1

    def classes_of(self, item: np.ndarray) -> np.ndarray:
        return np.where(item < self.own, item, CLASSES - SHARED + np.searchsorted(self.edges[1:-1], item, "right"))

    def class_weights(self) -> np.ndarray:
        weight = self.n * np.diff(self.first)
        return np.bincount(self.classes_of(np.arange(len(weight))), weight, CLASSES)

    def paths(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class and number of halvings of each leaf; and of all halvings one after another the slot of the output, the
        side of the leaf (1 for the upper half, else -1), and the log odds of that side by the counts."""
        kind, depth, ways = self.ways(leaf)
        half, odds = _unpacked(ways)
        return kind, depth, half >> 1, ((half & 1) * 2 - 1).astype(np.float32), odds

    def ways(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class and number of halvings of each leaf, and all halvings one after another, in 8 bytes each: twice the slot of
        the output, one more if the leaf is in the upper half, and the log odds of its side by the counts."""
        item = self.items_of(leaf)
        kind, inside = self.classes_of(item), leaf - self.first[item]
        several, which = np.unique(item, return_inverse=True)
        between = self._between(several)
        sizes = np.diff(self.first)[several]
        depths, ways = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(leaf), 1 << 12):
            own = which[a : a + (1 << 12)]
            rows = np.concatenate((between[own], _within(inside[a : a + (1 << 12)], sizes[own], self.first[several[own]])), axis=1)
            real = rows != _NONE
            depths.append(np.count_nonzero(real, axis=1))
            ways.append(rows[real])
        return kind, np.concatenate(depths), np.concatenate(ways)

    def _between(self, items: np.ndarray) -> np.ndarray:
        """Halvings (as of :meth:`ways`) on the way to each item, a column a level; _NONE where there is no more."""
        node = np.full(len(items), -1)
        beyond = items >= self.own
        node[beyond] = self.root[self.classes_of(items[beyond]) - (CLASSES - SHARED)]
        columns = [np.full(len(items), _NONE)]
        while (node >= 0).any():
            real, safe = node >= 0, np.maximum(node, 0)
            up = items >= self.mid[safe]
            half = np.where(safe < NODES, safe, NODES + safe % NODES) * 2 + up
            columns.append(np.where(real, _packed(half, np.where(up, self.odds[safe], -self.odds[safe])), _NONE))
            node = np.where(real, np.where(up, self.upper[safe], self.lower[safe]), -1)
        return np.stack(columns, axis=1)


#: No halving.
_NONE = np.int64(-1)


def _packed(half: np.ndarray, odds: np.ndarray) -> np.ndarray:
    both = np.empty((*half.shape, 2), np.int32)
    both[..., 0] = half
    both.view(np.float32)[..., 1] = odds
    return both.view(np.int64)[..., 0]


def _unpacked(ways: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = ways.view(np.int32).reshape(*ways.shape, 2)
    return both[..., 0], both[..., 1].view(np.float32)


def _within(place: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As :meth:`Tree._between`, from an item of ``size`` leaves of one count to the leaf at ``place`` in it: the bits of the
    place, the highest first, where a leaf with the bit set exists. The item's leaves begin with ``first``."""
    most = int(size.max(initial=1))
    if most < 1 << 30:
        place, size = place.astype(np.int32), size.astype(np.int32)
    bits = np.arange((most - 1).bit_length(), dtype=place.dtype)[::-1]
    above = place[:, None] >> bits
    middle = above | 1
    middle <<= bits  # first place of the upper half
    more = size[:, None] - middle
    above &= 1
    middle += (first % NODES).astype(place.dtype)[:, None]
    middle &= place.dtype.type(NODES - 1)
    middle += place.dtype.type(NODES)
    middle <<= 1
    middle += above
    out = _packed(middle, np.float32(0)).ravel()
    real = more > 0
    uneven = np.flatnonzero(real & (more < 1 << bits))
    odds = np.log(more.ravel()[uneven] / (1 << bits[uneven % len(bits)])) if len(uneven) else np.zeros(0)
    out[uneven] = _packed(middle.ravel()[uneven], np.where(above.ravel()[uneven] > 0, odds, -odds))
    out[~real.ravel()] = _NONE
    return out.reshape(more.shape)


@dataclass
class Words:
    """What tasks know of the vocabulary: the tree, and the ranks of the most frequent words."""

    tree: Tree
    keys: np.ndarray  # of the HEAD most frequent words, sorted
    ranks: np.ndarray

    @staticmethod
    def of(table: DataFrame) -> Words:
        """Reaches the driver: a row for each different count, and HEAD words."""
        runs = table.groupBy("n").agg(F.count("*").alias("m")).toArrow()
        n, m = (runs.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
        order = np.argsort(-n)
        head = table.where(F.col("leaf") < HEAD).select("key", "leaf").toArrow()
        keys, ranks = (head.column(c).to_numpy().astype(np.int64) for c in ("key", "leaf"))
        by = np.argsort(keys)
        return Words(Tree.build(n[order], m[order]), keys[by], ranks[by])

    def head(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of words by their keys; -1 for those beyond the most frequent."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def spare(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of words that the corpus lacks."""
        return self.tree.words + keys % SHARED


def ranked(cuts: DataFrame, table: DataFrame, words: Words, names: list[str]) -> DataFrame:
    """The documents' columns, by ``names``, and "leaves", the ranks of their words; written. Blocks' dictionaries are joined
    with the vocabulary by key, and go back to their blocks; no text and no word is moved one by one."""

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                keys = np.frombuffer(data, "<i8")
                at = np.flatnonzero(words.head(keys) < 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)), pa.array(keys[at])], ["block", "at", "key"])
        release()

    met = cuts.select("block", "keys").mapInArrow(rare, "block long, at int, key long").join(table.select("key", "leaf"), "key", "left").select("block", "at", "leaf")
    small_batches(cuts)
    inner = cuts.schema["docs"].dataType.elementType
    fields = inner.fieldNames() if names else []

    def place(block: pa.Table, found: pa.Table) -> pa.Table:
        docs, leaves = [], []
        for row in range(block.num_rows):
            keys = np.frombuffer(block.column("keys")[row].as_py(), "<i8")
            leaf = words.head(keys)
            at, rank = found.column("at").to_numpy(), found.column("leaf").fill_null(-1).to_numpy()
            leaf[at] = rank
            leaf = np.where(leaf < 0, words.spare(keys), leaf)
            of, ends = leaf[_numbers(block.column("codes")[row].as_py())], np.cumsum(_numbers(block.column("sizes")[row].as_py()))
            docs.append(block.column("docs").slice(row, 1).combine_chunks().flatten())
            leaves += [_planes(x) for x in np.split(of, ends[:-1])]
        columns = [pa.chunked_array([d.flatten()[i] for d in docs]) for i in range(len(fields))]
        placed = pa.Table.from_arrays([*columns, pa.array(leaves, pa.binary())], names=[*fields, "leaves"])
        del docs, leaves
        release()
        return placed

    schema = T.StructType([*(inner[f] for f in fields), T.StructField("leaves", T.BinaryType())])
    sides = cuts.drop("n").groupBy("block").cogroup(met.groupBy("block"))
    return written(sides.applyInArrow(place, schema), "lm-ranks")


@dataclass
class Network:
    tree: Tree
    embed: np.ndarray = field(default=None)  # place x input x WIDTH
    layer: np.ndarray = field(default=None)  # WIDTH x class
    bias: np.ndarray = field(default=None)  # class
    shift: np.ndarray = field(default=None)  # WIDTH
    nodes: np.ndarray = field(default=None)  # halving x WIDTH

    @staticmethod
    def start(tree: Tree, seed: int = 7) -> Network:
        """Small random embeddings; classes by their counts."""
        weight = tree.class_weights()
        random = np.random.default_rng(seed)
        with np.errstate(divide="ignore"):
            bias = np.maximum(np.log(weight / weight.sum()), -1e9).astype(np.float32)  # a class without a word
        return Network(
            tree, (random.standard_normal((2 * SIDE, INPUTS, WIDTH)) * 0.1).astype(np.float32), np.zeros((WIDTH, CLASSES), np.float32), bias,
            np.zeros(WIDTH, np.float32), np.zeros((2 * NODES, WIDTH), np.float32),
        )

    def inputs_of(self, leaf: np.ndarray) -> np.ndarray:
        """0 stands for the edge of a text."""
        return 1 + np.where(leaf < INPUTS // 2, leaf, INPUTS // 2 + leaf % (INPUTS - INPUTS // 2 - 1))

    def laid_out(self, leaves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs with SIDE edges around each text, and where in them each word is."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(leaves)) + SIDE * (owner + 1)
        row = np.zeros(len(leaves) + SIDE * (len(sizes) + 1), np.int16)
        row[at] = self.inputs_of(leaves)
        return row, at

    def hidden(self, inputs: np.ndarray) -> np.ndarray:
        """Of words by their neighbours' inputs (neighbour x word)."""
        total = self.embed[0].take(inputs[0], axis=0)
        for place in range(1, len(_STEPS)):
            total += self.embed[place].take(inputs[place], axis=0)
        total += self.shift
        return np.tanh(total, out=total)

    def logits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the classes (word x class), less a number for each word so that exp() fits; and ``h`` with a column of ones."""
        ones = np.ones((len(h), WIDTH + 1), np.float32)
        ones[:, :WIDTH] = h
        out = ones @ np.concatenate([self.layer, self.bias[None]])
        # |h| <= 1, so this bounds all logits, and from below the largest of each word.
        reach = np.abs(self.layer).sum(axis=0)
        if (self.bias + reach).max() > 60 or (self.bias - reach).max() < -60:
            out -= out.max(axis=1)[:, None]
        return out, ones

    def log_probabilities(self, leaves: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each word (by its leaf), given both its sides."""
        row, at = self.laid_out(leaves, sizes)
        out, paths = np.empty(len(leaves)), _Paths(self.tree, leaves)
        sides = np.stack([-self.nodes, self.nodes], axis=1).reshape(-1, WIDTH)  # of the lower and of the upper half
        space = np.empty((0, WIDTH), np.float32)
        for own, depth in paths.alike():
            h = self.hidden(row[at[own] + _STEPS])
            logits = self.logits(h)[0]
            found = logits.ravel().take(np.arange(0, logits.size, CLASSES) + paths.kind[paths.which[own]]).astype(np.float64)
            found -= np.log(np.exp(logits, out=logits) @ _ONES)
            if depth:
                half, odds = paths.levels(own, depth)
                space = _room(space, half.size)
                value = np.einsum("dkw,kw->dk", sides.take(half, axis=0, out=space[: half.size].reshape(*half.shape, WIDTH), mode="clip"), h)
                value += odds
                # log(1 / (1 + exp(-value))): factors of 1 to 2 are multiplied first, as a word has fewer than 1,000 halvings.
                found += np.minimum(value, 0).sum(axis=0)
                found -= np.log((np.exp(-np.abs(value)).astype(np.float64) + 1).prod(axis=0))
            out[own] = found
        return out

    def learn(self, leaves: np.ndarray, sizes: np.ndarray, memory: list[np.ndarray], residues: Iterable[int]) -> int:
        """Adagrad steps on the words whose place, counted from the end of their text, has one of ``residues`` modulo
        MASKED, residue by residue; ``memory`` holds the squared gradients."""
        row, at = self.laid_out(leaves, sizes)
        place = np.arange(len(leaves)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        residue = ((place + np.repeat(sizes, sizes)) % MASKED).astype(np.int8)
        targets = np.flatnonzero(np.isin(residue, list(residues)))
        residue, at = residue[targets], at[targets]
        paths, learned, space = _Paths(self.tree, leaves[targets]), 0, np.empty((0, WIDTH), np.float32)
        for now in residues:
            chosen = np.flatnonzero(residue == now)
            learned += len(chosen)
            for a in range(0, len(chosen), BATCH):
                step = paths.step(chosen[a : a + BATCH])
                here, count = at[step.own], len(step.own)
                inputs = row[here + _STEPS].astype(np.int64)
                h = self.hidden(inputs)
                wrong, ones = self.logits(h)
                np.exp(wrong, out=wrong)
                wrong *= (np.float32(1 / count) / (wrong @ _ONES))[:, None]
                wrong.ravel()[np.arange(0, wrong.size, CLASSES) + step.kind] -= np.float32(1 / count)
                back = wrong @ self.layer.T
                outer = ones.T @ wrong
                space = _room(space, len(step.slot))
                nodes = self.nodes.take(step.slot, axis=0, out=space[: len(step.slot)], mode="clip")
                value = step.values(h, nodes)
                # -side / (1 + exp(value)) / count
                off = np.abs(value)
                np.negative(off, out=off)
                np.exp(off, out=off)
                below = off + 1
                np.copyto(off, np.float32(1), where=value < 0)
                off /= below
                off *= step.side
                off *= np.float32(-1 / count)
                for words, places, (k, d) in step.groups:
                    back[words] += np.matmul(off[places].reshape(k, 1, d), nodes[places].reshape(k, d, WIDTH))[:, 0]
                _move(self.layer, memory[1], outer[:WIDTH])
                _move(self.bias, memory[2], outer[WIDTH])
                if len(off):
                    _move(self.nodes, memory[4], step.gradient(h, off, len(self.nodes)))
                back *= 1 - h * h
                _move(self.shift, memory[3], back.sum(axis=0))
                sums, columns = np.zeros((WIDTH // 2, len(_STEPS), INPUTS), np.complex64), _pairs(back)
                for p, index in enumerate(inputs):
                    for column, found in zip(columns, sums, strict=True):
                        np.add.at(found[p], index, column)
                _move(self.embed, memory[0], _unpaired(sums).reshape(self.embed.shape))
        return learned

    def rows(self) -> np.ndarray:
        """All parameters as rows of WIDTH numbers."""
        flat = np.concatenate([p.ravel() for p in self.parameters()])
        return flat.reshape(-1, WIDTH)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.layer, self.bias, self.shift, self.nodes]

    def put(self, rows: np.ndarray) -> None:
        flat, at = rows.astype(np.float32).ravel(), 0
        for name in ("embed", "layer", "bias", "shift", "nodes"):
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).copy())
            at += old.size


def _room(space: np.ndarray, rows: int) -> np.ndarray:
    """Room for so many rows: ``space``, if it has it."""
    return space if len(space) >= rows else np.empty((rows * 5 // 4, WIDTH), np.float32)


@dataclass
class _Step:
    """Some words, those with equally many halvings together, and all their halvings one after another."""

    own: np.ndarray
    kind: np.ndarray
    slot: np.ndarray
    side: np.ndarray
    odds: np.ndarray
    groups: list[tuple[slice, slice, tuple[int, int]]]  # words, their halvings, (words, halvings each)

    def values(self, h: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Log odds of the side that the word is on, at each halving."""
        out = np.empty(len(self.slot), np.float32)
        for words, places, (k, d) in self.groups:
            np.matmul(nodes[places].reshape(k, d, WIDTH), h[words, :, None], out=out[places].reshape(k, d, 1))
        out *= self.side
        out += self.odds
        return out

    def gradient(self, h: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
        """Sum by slot (of ``size``) of each halving's ``off`` times its word's row of ``h``. The halvings of words with
        equally many are taken level by level, so that words' numbers need no gathering."""
        slots, twice, part = np.empty_like(self.slot), np.empty((len(off), 2), np.float32), np.empty((len(off), 2), np.float32)
        levels = []
        for words, places, (k, d) in self.groups:
            slots[places].reshape(d, k)[:] = self.slot[places].reshape(k, d).T
            level = off[places].reshape(k, d).T
            twice[places, 0].reshape(d, k)[:] = level
            twice[places, 1].reshape(d, k)[:] = level
            levels.append((slice(2 * words.start, 2 * words.stop), twice[places].reshape(d, 2 * k), part[places].reshape(d, 2 * k)))
        out, products = np.zeros((WIDTH // 2, size), np.complex64), part.view(np.complex64)[:, 0]
        for column, found in zip(_pairs(h), out, strict=True):
            numbers = column.view(np.float32)
            for words, own, product in levels:
                np.multiply(own, numbers[words], out=product)
            np.add.at(found, slots, products)
        return _unpaired(out)


def _pairs(rows: np.ndarray) -> np.ndarray:
    """Columns two by two as complex numbers, which are added up at once."""
    return np.ascontiguousarray(np.ascontiguousarray(rows).view(np.complex64).T)


def _unpaired(columns: np.ndarray) -> np.ndarray:
    """The rows that such columns are of."""
    return np.ascontiguousarray(columns.reshape(len(columns), -1).T).view(np.float32)


class _Paths:
    """Ways through the tree to the words of a block; each different word's is found once."""

    def __init__(self, tree: Tree, leaves: np.ndarray):
        if tree.kept is None:
            tree.kept = self._found(tree, np.arange(min(_KEPT, tree.size)))
        kept = len(tree.kept[0])
        rare = np.flatnonzero(leaves >= kept)
        others, which = np.unique(leaves[rare], return_inverse=True)
        self.which = leaves.copy()
        self.which[rare] = kept + which
        self.kind, self.depth, self.ways = (np.concatenate(x) for x in zip(tree.kept, self._found(tree, others), strict=True))
        ends = np.cumsum(self.depth, dtype=np.int64)
        self.begin = ends - self.depth

    @staticmethod
    def _found(tree: Tree, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kind, depth, ways = tree.ways(leaves)
        return kind.astype(np.uint8), depth.astype(np.uint16), ways

    def alike(self) -> Iterator[tuple[np.ndarray, int]]:
        """All words, some with equally many halvings at a time, and how many these are."""
        depth = self.depth[self.which]
        order, a = np.argsort(depth, kind="stable"), 0
        for d, k in enumerate(np.bincount(depth).tolist()):
            most = min(_CHUNK, max(1, _HALVINGS // max(1, d)))
            for b in range(a, a + k, most):
                yield order[b : min(b + most, a + k)], d
            a += k

    def levels(self, own: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Of words with ``depth`` halvings each, halving by halving (halving x word): twice the slot, one more for the upper
        half; and the log odds."""
        return _unpacked(self.ways.take(self.begin[self.which[own]] + np.arange(depth)[:, None]))

    def step(self, own: np.ndarray) -> _Step:
        which = self.which[own]
        order = np.argsort(self.depth[which], kind="stable")
        own, which = own[order], which[order]
        depth = self.depth[which].astype(np.int64)
        at = np.repeat(self.begin[which] - (np.cumsum(depth) - depth), depth)
        at += np.arange(len(at))
        half, odds = _unpacked(self.ways.take(at))
        groups, a, b = [], 0, 0
        for d, k in enumerate(np.bincount(depth).tolist()):
            if k and d:
                groups.append((slice(a, a + k), slice(b, b + k * d), (k, d)))
            a, b = a + k, b + k * d
        side = (half & 1).astype(np.float32)
        side *= 2
        side -= 1
        return _Step(own, self.kind[which], (half >> 1).astype(np.int64), side, odds, groups)


def _move(parameter: np.ndarray, held: np.ndarray, gradient: np.ndarray) -> None:
    """An Adagrad step; rows without a gradient stay."""
    square = gradient * gradient
    held += square
    np.add(held, np.float32(1e-8), out=square)
    np.sqrt(square, out=square)
    np.divide(gradient, square, out=square)
    square *= np.float32(RATE)
    parameter -= square


def _read(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the words of some documents one after another, and each document's number of words."""
    found = [_numbers(x) for x in data]
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), np.array([len(x) for x in found], np.int64)


def fit(documents: DataFrame, tree: Tree, rounds: int = ROUNDS) -> Network:
    """From documents as ranks. One set of parameters a round reaches the driver; tasks' parameters are added up by a
    shuffle. The rounds share out the residues, so each word is a target once."""
    network = Network.start(tree)
    size = len(network.rows())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, learned = Network(network.tree, *(p.copy() for p in network.parameters())), 0
        memory = [np.zeros_like(p) for p in own.parameters()]
        for whole in batches:
            for batch in blocks(whole, "leaves", 4 << 20):
                learned += own.learn(*_read(batch.column("leaves").to_pylist()), memory, residues)
        if learned:
            rows = own.rows().astype(np.float64) * learned
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, learned, np.int64))] + [pa.array(rows[:, k].astype(np.float32)) for k in range(WIDTH)],
                ["row", "learned", *[f"v{k}" for k in range(WIDTH)]],
            )
        del own, memory
        release()

    schema = "row int, learned long, " + ", ".join(f"v{k} float" for k in range(WIDTH))
    for r in range(min(rounds, MASKED)):
        residues = range(r, MASKED, min(rounds, MASKED))
        summed = small_batches(documents).select("leaves").mapInArrow(run, schema).groupBy("row").agg(*[(F.sum(f"v{k}") / F.sum("learned")).alias(f"v{k}") for k in range(WIDTH)]).toArrow()
        if not summed.num_rows:
            break
        rows = np.zeros((size, WIDTH))
        rows[summed.column("row").to_numpy()] = np.stack([summed.column(f"v{k}").to_numpy() for k in range(WIDTH)], axis=1)
        network.put(rows)
    return network


_NEW = ("n_tokens", "log_likelihood", "mean_log_prob")


def judge(documents: DataFrame, network: Network, names: list[str]) -> DataFrame:
    """Documents as ranks, their columns by ``names``, with the three new columns."""
    inside = documents.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "leaves", 4 << 20):
                leaves, sizes = _read(batch.column("leaves").to_pylist())
                # Sums per text, not differences of one long running sum, so that a text's score does not depend on its place.
                owner = np.repeat(np.arange(len(sizes)), sizes)
                total = np.bincount(owner, network.log_probabilities(leaves, sizes), len(sizes)) if len(leaves) else np.zeros(len(sizes))
                mean = pa.array(total / np.maximum(sizes, 1), mask=sizes == 0)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes), pa.array(total), mean], [*inside, *_NEW])
        release()

    fields = [T.StructField(n, k()) for n, k in zip(_NEW, (T.LongType, T.DoubleType, T.DoubleType), strict=True)]
    return small_batches(documents).mapInArrow(run, T.StructType([*(documents.schema[c] for c in inside), *fields])).toDF(*names, *_NEW)


@dataclass
class Model:
    """A network, what its tasks know of the vocabulary, and the vocabulary's table."""

    network: Network
    words: Words
    table: DataFrame


def _learned(cuts: DataFrame, names: list[str], rounds: int) -> tuple[Model, DataFrame]:
    table = vocabulary(cuts)
    words = Words.of(table)
    documents = ranked(cuts, table, words, names)
    return Model(fit(documents, words.tree, rounds), words, table), documents


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """From all documents."""
    return _learned(cut(docs, text_col, []), [], rounds)[0]


def _kept(docs: DataFrame, keep: list[str] | None) -> list[str]:
    return [c for c in (docs.columns if keep is None else keep) if c not in _NEW]


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with n_tokens (long), log_likelihood (the sum over all words, in nats)
    and mean_log_prob (null without a word).

    Null and empty texts have no words and a sum of 0. Long texts are scored whole. Each row stands by itself: repeated
    rows agree to rounding, an empty table stays empty. Columns of these names are replaced.
    """
    names = _kept(docs, keep)
    return judge(ranked(cut(docs, text_col, names), model.table, model.words, names), model.network, names)


def train_and_score(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """:func:`score` of the documents that the network is trained on; their text is read once."""
    names = _kept(docs, keep)
    model, documents = _learned(cut(docs, text_col, names), names, rounds)
    return judge(documents, model.network, names)
