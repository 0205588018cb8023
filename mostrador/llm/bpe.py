"""Byte-level BPE by corpus-level merge replay.

The different words of a block of texts (pieces that the pattern cuts) lie one after another as bytes. An inverted index
holds, for each rank, the positions of the pairs that merge to it. Ranks are taken in order; one rank's positions are
merged together in all words, and only the pairs beside a merge change: these are looked up anew and entered in the
index. Ids are the ranks. Each text's ids are then those of its words in turn.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import blocks, own_copy, spread

#: Chunks and words whose ids a Python worker remembers, and the length over which they are not kept; bounds its memory.
KEPT_CHUNKS, KEPT_WORDS, KEPT_LENGTH = 200_000, 300_000, 64
_NONE = np.iinfo(np.int64).max
_SPACES = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Ranks:
    """The ranks of a file, and the pairs of tokens that merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.of = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pairs = {}
        for token, rank in self.of.items():
            for cut in range(1, len(token)):
                left, right = self.of.get(token[:cut]), self.of.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.byte = np.array([self.of[bytes([b])] for b in range(256)], np.int64)
        tokens = sorted(self.of.items(), key=lambda x: x[1])
        self.flat = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self.sizes, self.begins = np.zeros(tokens[-1][1] + 1, np.int64), np.zeros(tokens[-1][1] + 1, np.int64)
        at = np.array([r for _, r in tokens])
        self.sizes[at] = [len(t) for t, _ in tokens]
        self.begins[at] = np.cumsum(self.sizes[at]) - self.sizes[at]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, or _NONE."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def alone(self, word: bytes) -> list[int]:
        """Ids of one word: again and again the leftmost pair of lowest rank is merged."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.of.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.of[p] for p in parts]


def replay(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """Ids of each (non-empty) word, as little-endian 32-bit integers."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    token = ranks.byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    starts = np.cumsum(sizes) - sizes
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[starts[1:] - 1] = n
    after[-1:] = n
    before[starts] = -1
    rank = np.full(n, _NONE)
    inner = np.flatnonzero(after < n)
    rank[inner] = ranks.pair(token[inner], token[after[inner]])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        order = np.argsort(rank[at], kind="stable")
        at = at[order]
        value = rank[at]
        cuts = np.flatnonzero(value[1:] != value[:-1]) + 1
        firsts = [0, *cuts.tolist()]
        for r, a, b in zip(value[firsts].tolist(), firsts, [*cuts.tolist(), len(at)]):
            if r in index:
                index[r].append(at[a:b])
            else:
                index[r] = [at[a:b]]
                heapq.heappush(heap, r)

    found = np.flatnonzero(rank < _NONE)
    if len(found):
        enter(found)
    odd = []
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[rank[at] == r]
        if not len(at):
            continue
        # Pairs that overlap (as in aaa): from the left, every other one.
        chained = after[at[:-1]] == at[1:]
        if chained.any():
            run = np.append(0, np.where(chained, 0, np.arange(1, len(at))))
            at = at[(np.arange(len(at)) - np.maximum.accumulate(run)) % 2 == 0]
        gone = after[at]
        nxt = after[gone]
        token[at] = r
        token[gone] = -1
        rank[gone] = _NONE
        after[at] = nxt
        inside = nxt < n
        before[nxt[inside]] = at[inside]
        left = before[at]
        touched = np.concatenate([at, left[left >= 0]])
        touched = touched[after[touched] < n]
        rank[at] = _NONE
        rank[touched] = ranks.pair(token[touched], token[after[touched]])
        fresh = touched[rank[touched] < _NONE]
        if len(fresh):
            lower = rank[fresh] < r
            if lower.any():
                odd.append(fresh[lower])
            enter(fresh)
    flat = token[token >= 0]
    ends = (np.cumsum(np.add.reduceat((token >= 0).astype(np.int64), starts)) * 4).tolist()
    data = flat.astype("<i4").tobytes()
    out = [data[a:b] for a, b in zip([0, *ends], ends)]
    # Where a merge made a pair of lower rank, its word's merges may have come in another order: it is done alone.
    if odd:
        for i in np.unique(np.searchsorted(starts, np.concatenate(odd), "right") - 1).tolist():
            out[i] = np.array(ranks.alone(words[i]), "<i4").tobytes()
    return out


class Encoder:
    """Ids of whole texts under a rank file and a pattern. Each different word of a block is merged once."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = ranks_of(path), regex.compile(pattern)
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        cut = [self.pattern.findall(c) for c in chunks]
        fresh = list({w for own in cut for w in own if w not in self.words})
        ids = replay(self.ranks, [w.encode("utf-8", "surrogatepass") for w in fresh]) if fresh else []
        words = self.words
        words.update(zip(fresh, ids, strict=True))
        return {c: b"".join([words[w] for w in own]) for c, own in zip(chunks, cut, strict=True)}

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Lists of ids. Null counts as empty."""
        texts = own_copy(texts)
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks = {}
        # A space before anything but white space always begins a word, so texts are cut there first. Texts with other
        # spaces stay in one chunk.
        whole = pc.match_substring_regex(texts, f" (?:{_SPACES}|$)")
        lists = pc.split_pattern(pc.if_else(whole, pa.scalar("", pa.large_string()), texts), " ")
        coded = pc.dictionary_encode(lists.flatten())
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        # The first chunk of a text has no space before it: it becomes an entry of its own.
        firsts, place = np.unique(index[offsets[:-1]], return_inverse=True)
        index[offsets[:-1]] = len(names) + place
        entries = [f" {c}" for c in names] + [names[i] for i in firsts.tolist()]
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        for k, i in enumerate(odd):
            index[offsets[i]] = len(entries) + k
        entries += [texts[i].as_py() for i in odd]
        used = np.zeros(len(entries), bool)
        used[index] = True
        known = self.chunks
        new = self._learn(list({e for e, u in zip(entries, used.tolist(), strict=True) if u and e not in known}))
        ids = [b"" if not u else known[e] if e in known else new[e] for e, u in zip(entries, used.tolist(), strict=True)]
        known.update((e, i) for e, i in new.items() if len(e) <= KEPT_LENGTH)
        for word in [w for w in self.words if len(w) > KEPT_LENGTH]:
            del self.words[word]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, begins = np.frombuffer(b"".join(ids), np.int32), np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(sizes[index])])[offsets]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(spread(flat, begins[index], sizes[index])))


@cache
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One for a Python worker, so that its tasks share what it remembers."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with ids (array of int): the whole text's, without special tokens.

    Null and empty texts have no ids. Texts of any length are one piece; strings of special tokens are ordinary text.
    Each row stands by itself: repeated rows agree, an empty table stays empty. A column named ids is replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "ids"]
    chosen = docs.select(*kept, F.col(f"`{text_col}`").alias("text of doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(path, pattern)
        for whole in batches:
            for batch in blocks(whole, "text of doc", 4 << 20):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], work.encode(batch.column("text of doc"))], [*kept, "ids"])

    return chosen.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` with decoded (binary): the bytes of its ids. Null ids count as none. A column named decoded is replaced."""
    kept = [c for c in coded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                lists = pc.fill_null(batch.column("ids"), [])
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                data = spread(ranks.flat, ranks.begins[ids], ranks.sizes[ids]).tobytes()
                at = np.concatenate([[0], np.cumsum(ranks.sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
                texts = [data[a:b] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(texts, pa.binary())], [*kept, "decoded"])

    return coded.select(*kept).mapInArrow(run, T.StructType([*(coded.schema[c] for c in kept), T.StructField("decoded", T.BinaryType())]))
