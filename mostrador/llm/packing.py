"""Concatenate-and-cut packing of tokenized documents into sequences of a fixed length.

The documents of all partitions form one long row of tokens. Pass one tokenizes and writes, with each document, its start
among the tokens of its partition. Prefix sums over the partitions' totals (one row per partition) turn these into global
starts; pass two cuts at the multiples of the sequence length and gives a boundary record for each piece. Only the last
sequence can need padding. Documents are not shuffled, and no task or driver sees more than its own partition.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mostrador.llm.common import blocks, own_copy, release, small_batches, spread, written

LENGTH = 4096
END_ID = 2
#: Words whose ids a Python worker remembers. Bounds its memory; forgotten words are encoded again.
REMEMBERED = 400_000


class WordEncoder:
    """Ids of whole texts, each different word of a block encoded once.

    The tokenizer cuts at white space and drops it, so a text's ids are those of its words in turn. Words of Latin-1
    letters alone are one piece in lower case, and the merges are applied to all new ones together; punctuation behind a
    letter or digit is a piece of its own. All other words go through the tokenizer one by one.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        model = json.loads(self.tokenizer.to_str())["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pairs, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.inner = np.array([vocabulary[_BYTE_SIGN[b]] for b in range(256)], np.int64)
        self.final = np.array([vocabulary[_BYTE_SIGN[b] + end] for b in range(256)], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NO_MERGE)

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece: again and again the leftmost of its pairs with the lowest rank becomes one token."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        tokens, last = self.inner[raw], np.cumsum(sizes) - 1
        tokens[last] = self.final[raw[last]]
        owner, done = np.repeat(np.arange(len(pieces)), sizes), []
        ranks = self._rank(tokens, np.append(tokens[1:], 0))
        ranks[last] = _NO_MERGE
        while len(tokens):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(ranks, first)
            live = least < _NO_MERGE
            counts = np.diff(np.append(first, len(tokens)))
            if not live.all():
                rest = np.repeat(live, counts)
                done.append((owner[~rest], tokens[~rest]))
                tokens, ranks, owner, least, counts = tokens[rest], ranks[rest], owner[rest], least[live], counts[live]
                if not len(tokens):
                    break
            hits = np.flatnonzero(ranks == np.repeat(least, counts))
            hits = hits[np.append(True, owner[hits][1:] != owner[hits][:-1])]  # the leftmost of each piece
            tokens[hits] = self.merged[ranks[hits]]
            stay = np.ones(len(tokens), bool)
            stay[hits + 1] = False
            at = hits - np.arange(len(hits))  # where the merged tokens are among those that stay
            tokens, owner, ranks = tokens[stay], owner[stay], ranks[stay]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(tokens) - 1)
                inside = (right > left) & (owner[left] == owner[right])
                ranks[left] = np.where(inside, self._rank(tokens[left], tokens[right]), _NO_MERGE)
        owners, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owners, kind="stable")
        flat, ends = ids[order].astype("<u4").tobytes(), np.cumsum(np.bincount(owners, minlength=len(pieces))) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _learn(self, words: list[str]) -> None:
        known, letters, rest, cut = self.known, {}, set(), []
        for word in words:
            # In pure ASCII the tokenizer's lower case is this one.
            plain = word.isascii()
            bare = word.lower() if plain else word
            head = bare.rstrip(_PUNCTUATION)
            if not head or not (head.isalpha() if plain else _LATIN.fullmatch(head)):
                head = head if head and _LETTER_OR_DIGIT.match(head[-1]) else bare
                if head not in known:
                    rest.add(head)
            elif head not in known and head not in letters:
                letters[head] = head.lower().encode()
            tail = bare[len(head) :]
            if tail and tail not in known:
                rest.add(tail)
            cut.append((head, tail))
        if letters:
            known.update(zip(letters, self._merge(list(letters.values())), strict=True))
        for part in rest:
            known[part] = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()
        for word, (head, tail) in zip(words, cut, strict=True):
            known[word] = known[head] + known[tail] if tail else known[head]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has. Null counts as empty."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        texts = own_copy(texts)
        if not pc.any(pc.match_substring_regex(texts, "[\\x{300}-\\x{36F}]")).as_py():
            texts = pc.ascii_lower(texts)  # no mark follows a letter, so this changes no id
        # Cut at ASCII white space only: other white space the tokenizer finds within a word.
        lists = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(lists.flatten())
        words, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        known[""] = b""
        self._learn([w for w in words if w not in known])
        ids = list(map(known.__getitem__, words))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy(zero_copy_only=False)
        out, counts = spread(flat, begins[index], sizes[index]), sizes[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        return out, ends[offsets[1:]] - ends[offsets[:-1]]


_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTER_OR_DIGIT = re.compile("[A-Za-z0-9À-ÖØ-öø-ÿ]")
_NO_MERGE = np.iinfo(np.int64).max
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Byte-level vocabularies write each byte as a printable sign: printable Latin-1 as itself, others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGN = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(_PRINTED))}


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Pass one, written: (id, part, local_start, n_tokens, ids). ``ids`` are little-endian unsigned 32-bit."""
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at, part = WordEncoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for whole in batches:
            for batch in blocks(whole, "t", 1 << 20):
                flat, own = encoder.encode(batch.column("t"))
                ends = np.cumsum(own)
                ids = [flat[e - n : e].tobytes() + end for e, n in zip(ends.tolist(), own.tolist(), strict=True)]
                sizes = own + len(end) // 4
                starts = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(np.full(len(ids), part), pa.int32()), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                    ["id", "part", "local_start", "n_tokens", "ids"],
                )
        # The tables and words go with the task: a worker keeps nothing of them.
        del encoder
        release()

    chosen = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return written(chosen.mapInArrow(run, f"id {kind}, part int, local_start long, n_tokens long, ids binary"), "pack-tokens")


def pack(
    docs: DataFrame, tokenizer_path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID
) -> DataFrame:
    """One row per piece: (id, start, length, doc_tokens, sequence_id, offset, ids).

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's. Offsets have no gaps, sequence ids
    neither, and each id of each document is in exactly one piece. Null and empty texts have the end id alone; without an
    end id they have no piece. Repeated rows are packed each for itself, long texts go over many sequences, an empty table
    gives no rows. Columns other than the two named are ignored.
    """
    tokens = tokenized(docs, tokenizer_path, id_col, text_col, end_id)
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per partition of pass one: bounded by the number of its tasks, so one task can sum and all can hold it.
    bases = totals.select("part", (F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))).alias("base"))
    begin = F.coalesce(F.col("base"), F.lit(0)) + F.col("local_start")
    placed = tokens.where("n_tokens > 0").join(F.broadcast(bases), "part").withColumn("begin", begin)
    first, last = F.floor(F.col("begin") / length), F.floor((F.col("begin") + F.col("n_tokens") - 1) / length)

    def piece(sequence: F.Column) -> F.Column:
        start = F.greatest(sequence * length - F.col("begin"), F.lit(0).cast("long"))
        end = F.least((sequence + 1) * length - F.col("begin"), F.col("n_tokens"))
        return F.struct(
            start.alias("start"), (end - start).alias("length"), F.col("n_tokens").alias("doc_tokens"), sequence.alias("sequence_id"),
            (F.col("begin") + start - sequence * length).alias("offset"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")).alias("ids"),
        )

    pieces = placed.select("id", F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    return pieces.select(F.col("id").alias(id_col), "p.*")


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, padded to ``length`` unless their size is a power of two.

    A group has at most ``length`` tokens, so its pieces fit any task.
    """
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("parts"))
    bytes_ = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    padding = F.unhex(F.repeat(F.lit(np.array([pad_id], "<u4").tobytes().hex()), (length - F.col("n_tokens")).cast("int")))
    power = F.bit_count("n_tokens") == 1
    return whole.select("sequence_id", "n_tokens", F.when(power, bytes_).otherwise(F.concat(bytes_, padding)).alias("ids"))
