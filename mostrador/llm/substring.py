"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the corpus itself, cut at content-defined anchors: of each window of ``LEAST`` words the word grams of
least hash (winnowing), so that documents which share a window share one of its anchors, wherever they have it. The
index holds the anchors of all documents; those that two documents share open a block to parsing. Documents are then
parsed against the blocks: a factor begins at a window of ``LEAST`` words that also starts in an earlier document, and
grows word by word as long as the next window does. Windows are identified by 81 bits of hash and met by a shuffle on
these, so a factor may go on from one reference document to the next, and at every factor's boundaries just those
windows count that one earlier document has as a whole. Factors become spans of duplicate words.

A text that an earlier document has as a whole is one factor and needs no parsing. Nothing is paired: a passage that thousands of documents have costs a row for each of its windows and documents at most,
and of the equal windows in one block of documents only the earliest is shuffled (the others are settled there).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import WORD, blocks, release, small_batches, written

LEAST = 50
GRAM = 16
#: End of a factor that is a whole text.
WHOLE = (1 << 31) - 1
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, and the number of words of each text."""
    digest, parts, sizes = xxhash.xxh3_64_intdigest, [], []
    for text in texts:
        words = text.split()
        sizes.append(len(words))
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _rolling(hashes: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by doubling: no prefix of the corpus enters, so equal runs have equal hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    m = 1 << 64
    out, done, power, length = np.zeros(len(hashes), np.uint64), 0, hashes, 1
    rest = size
    while rest:
        if rest & 1:
            out[: len(hashes) - done] = out[: len(hashes) - done] * np.uint64(pow(multiplier, length, m))
            out[: len(hashes) - done - length + 1] += power[done : done + len(hashes) - done - length + 1]
            done += length
        rest >>= 1
        if rest:
            power = power[: len(power) - length] * np.uint64(pow(multiplier, length, m)) + power[length:]
            length *= 2
    return _mix(out[:n])


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """Minimum or maximum of each run of ``size`` values."""
    length = 1
    while length * 2 <= size:
        values = best(values[: len(values) - length], values[length:])
        length *= 2
    return best(values[: len(values) - (size - length)], values[size - length :]) if size > length else values


def _inside(owner: np.ndarray, size: int) -> np.ndarray:
    """Whether the run of ``size`` words at each position is in one document."""
    return owner[: len(owner) - size + 1] == owner[size - 1 :]


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, gram hash) of the grams that are least in some window of LEAST words; each once a document."""
    hashes, sizes = _word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if len(hashes) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams, span = _rolling(hashes, GRAM, _MULTIPLIERS[0]), LEAST - GRAM + 1
    least = _sliding(grams, span, np.minimum)
    # A gram is an anchor if it is the least of some window that has it; windows over two documents don't count.
    least = np.where(_inside(owner, LEAST), least, np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, least, edge]), span, np.maximum)
    at = np.flatnonzero((highest == grams) & (grams > 0))
    keys = np.unique(np.stack([owner[at].astype(np.uint64), grams[at]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.uint64)
    return keys[:, 0].astype(np.int64), keys[:, 1]


def anchors(docs: DataFrame) -> DataFrame:
    """(id, anchor) of documents (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", 4 << 20):
                owner, gram = _anchors([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owner)), pa.array(gram.view(np.int64))], ["id", "anchor"])
        release()

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("anchor", T.LongType())]))


#: A window's row: h1 is 64 bits of its hash; the top 17 bits of ``rest`` are more of it, then 16 that tell rows with one
#: id apart (from the text's hash), then the place of its first word. A document that has the window again (repeated
#: lines and words) sends no further row, but the other places in ``more``. Settled spans have no h1, and their end in last.
_WINDOWS = "h1 long, rest long, id {0}, last int, more array<int>"
_TAG_AT, _HASH_AT = 31, 47


def _parse_block(ids: pa.Array, tags: np.ndarray, texts: list[bytes], opened: list) -> pa.RecordBatch | None:
    """Windows of the opened blocks. Of windows that are equal in this set of documents the one with the least id goes on
    with its hash; the others have an earlier document, and go on as settled spans of words."""
    hashes, sizes = _word_hashes(texts)
    if len(hashes) < LEAST:
        return None
    owner = np.repeat(np.arange(len(texts)), sizes)
    grams, span = _rolling(hashes, GRAM, _MULTIPLIERS[0]), LEAST - GRAM + 1
    hit = np.zeros(len(grams), bool)
    starts = np.cumsum(sizes) - sizes
    for start, size, own in zip(starts.tolist(), sizes.tolist(), opened, strict=True):
        n = size - GRAM + 1
        if n > 0 and len(own):
            hit[start : start + n] = np.isin(grams[start : start + n], own)
    hit &= _inside(owner, GRAM)
    at = np.flatnonzero(_sliding(hit, span, np.logical_or) & _inside(owner, LEAST))
    if not len(at):
        return None
    h1, h2 = (_rolling(hashes, LEAST, m)[at] for m in _MULTIPLIERS)
    h2 >>= np.uint64(_HASH_AT)
    doc = owner[at]
    names = np.array(ids.to_pylist())
    rank = np.unique(names, return_inverse=True)[1]
    order = np.lexsort((at, rank[doc], h2, h1))
    fresh = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))
    ranked = rank[doc[order]]
    later = ranked > ranked[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    going, settled = order[~later], np.sort(order[later])
    # One row for a window and document; the places after the first go along as a list.
    lead = np.append(True, (np.diff(h1[going]) != 0) | (np.diff(h2[going]) != 0) | (np.diff(doc[going]) != 0))[: len(going)]
    heads = np.flatnonzero(lead)
    extra = np.diff(np.append(heads, len(going))) - 1
    places = (at - starts[doc])[going][~lead].astype(np.int32)
    going = going[heads]
    # Settled windows one after another in one document become one span.
    new = np.append(True, (np.diff(at[settled]) != 1) | (np.diff(doc[settled]) != 0))[: len(settled)]
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], len(settled))[: len(runs)] - 1
    where = np.concatenate([going, settled[runs]])
    first = at[where] - starts[doc[where]]
    last = at[settled[ends]] - starts[doc[settled[ends]]] + LEAST
    rest = (h2[where] << np.uint64(_HASH_AT)) | (tags[doc[where]].astype(np.uint64) << np.uint64(_TAG_AT)) | first.astype(np.uint64)
    plain = np.arange(len(where)) >= len(going)
    ends_of = np.concatenate([np.zeros(len(going), np.int32), last.astype(np.int32)])
    lists = np.concatenate([[0], np.cumsum(np.concatenate([extra, np.zeros(len(runs), np.int64)]))]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(h1[where].view(np.int64), mask=plain), pa.array(rest.view(np.int64)), ids.take(pa.array(doc[where])),
            pa.array(ends_of, mask=~plain), pa.ListArray.from_arrays(pa.array(lists), pa.array(places)),
        ],
        ["h1", "rest", "id", "last", "more"],
    )


def _shared(found: DataFrame) -> DataFrame:
    """The rows (id, anchor) whose anchor two documents have at least. One shuffle; a task keeps one row in mind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last row, and whether its anchor was met with another id before
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if kept is None else pa.concat_batches([kept[0], batch])
            anchor, ids = whole.column("anchor").to_numpy(), np.array(whole.column("id").to_pylist())
            same = anchor[1:] == anchor[:-1]
            group = np.cumsum(np.append(0, ~same))
            several = np.zeros(group[-1] + 1, bool)
            several[group[1:][same & (ids[1:] != ids[:-1])]] = True
            if kept is not None and kept[1]:
                several[0] = True
            # The last row waits for what follows, unless it is known to be shared; rows before it with the same anchor
            # and id are the same row again.
            out = several[group]
            out[-1] = False
            if kept is not None and kept[1]:
                out[0] = False
            kept = (whole.slice(len(anchor) - 1, 1), bool(several[-1]))
            if kept[1]:
                out[-1] = True
            yield whole.take(pa.array(np.flatnonzero(out)))

    return found.repartition("anchor").sortWithinPartitions("anchor", "id").mapInArrow(run, found.schema)


def spans(docs: DataFrame) -> DataFrame:
    """(id, tag, first, last): words ``first`` to ``last`` - 1 of documents (id, tag, text) are in a factor. Spans may
    overlap. A text that a smaller id has as a whole is one factor, without end."""
    kind = docs.schema["id"].dataType.simpleString()
    whole = docs.select("id", "tag", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"))
    first = whole.groupBy("a", "b").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = written(whole.join(first, ["a", "b"]).where("id > least").select("id", "tag").distinct(), "rlz-copies")

    found = written(anchors(docs), "rlz-anchors")
    # An anchor list is as long as its document's text at most. Copies need no parsing, and are no one's earliest document.
    opened = _shared(found).groupBy("id").agg(F.collect_list("anchor").alias("opened"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", 4 << 20):
                own = [np.array(a, np.int64).view(np.uint64) for a in batch.column("opened").to_pylist()]
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                done = _parse_block(batch.column("id"), batch.column("tag").to_numpy(), texts, own)
                if done is not None:
                    yield done
        release()

    parsed = docs.join(opened, "id").join(copies, ["id", "tag"], "left_anti").select("id", "tag", "text", "opened")
    windows = parsed.mapInArrow(parse, _WINDOWS.format(kind))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash and id: the first of a hash is in its earliest document."""
        last_key, last_id = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            settled = batch.column("h1").is_null().to_numpy(zero_copy_only=False)
            h1, rest = batch.column("h1").fill_null(0).to_numpy(), batch.column("rest").to_numpy().view(np.uint64)
            h2 = rest >> np.uint64(_HASH_AT)
            ids = np.array(batch.column("id").to_pylist())
            fresh = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (settled[1:] != settled[:-1]))
            fresh[0] = last_key != (h1[0], h2[0], settled[0])
            least = ids[np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))]
            if not fresh[0]:
                least[: int(np.argmax(fresh)) if fresh.any() else len(ids)] = last_id
            last_key, last_id = (h1[-1], h2[-1], settled[-1]), least[-1]
            keep = np.flatnonzero(settled | (ids > least))
            begin = (rest[keep] & np.uint64((1 << _TAG_AT) - 1)).astype(np.int32)
            end = np.where(settled[keep], batch.column("last").fill_null(0).to_numpy()[keep], begin + LEAST).astype(np.int32)
            more = batch.column("more").take(pa.array(keep))
            again = more.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            keep = np.concatenate([keep, np.repeat(keep, pc.fill_null(pc.list_value_length(more), 0).to_numpy())])
            begin, end = np.concatenate([begin, again]), np.concatenate([end, again + LEAST]).astype(np.int32)
            tag = ((rest[keep] >> np.uint64(_TAG_AT)) & np.uint64(0xFFFF)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(tag), pa.array(begin), pa.array(end)], ["id", "tag", "first", "last"])
        release()

    # Settled spans have no hash; dealt by document they spread, and sort before the hashed windows.
    dealt = F.coalesce("h1", F.xxhash64("id", "rest"))
    ordered = windows.repartition(dealt).sortWithinPartitions("h1", F.shiftrightunsigned("rest", _HASH_AT), "id")
    judged = ordered.mapInArrow(judge, f"id {kind}, tag int, first int, last int")
    return judged.unionByName(copies.select("id", "tag", F.lit(0).alias("first"), F.lit(WHOLE).alias("last")))


def _cut(text: bytes, words: int, pieces: list[tuple[int, int]]) -> tuple[int, bytes]:
    """Number of words removed, and the text without them (and without the white space behind each)."""
    gone = np.zeros(words + 1, np.int64)
    for first, last in pieces:
        if words >= LEAST:  # a whole text may be shorter than a factor must be
            gone[first] += 1
            gone[min(last, words)] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    out, at = [], 0
    begins = [m.start() for m in WORD.finditer(text)] + [len(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out.append(text[at : begins[a]])
        at = begins[b]
    return int(gone.sum()), b"".join(out) + text[at:]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text cut, and n_words and n_removed (long): the input's words and those removed.

    A word goes if it is in a window of LEAST words that also starts in a document with a smaller id, both as they came
    in. Words are runs without space and U+0009 to U+000D; the white space between words that stay is left as it is. Null
    text stays null, with no words; texts under LEAST words stay. Of equal texts that with the smallest id stays whole; rows with one
    id are parts of one document to each other, so repeated rows lose the same words and none another's. Rows without
    id stay as they are and are no reference. An empty table stays empty. Columns named n_words or n_removed are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    tag = F.xxhash64(F.col(f"`{text_col}`")).bitwiseAND(F.lit(0xFFFF)).cast("int")
    source = small_batches(docs).select(F.col(id_col).alias("id"), tag.alias("tag"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    found = spans(source).groupBy("id", "tag").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("pieces"))
    inside = [f"k{i}" for i in range(len(kept))]
    at = inside[kept.index(text_col)]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inside, strict=True)], tag.alias("of row"))
    rows = rows.join(found, (rows[inside[kept.index(id_col)]] == found["id"]) & (F.col("of row") == found["tag"]), "left").select(*inside, "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, at, 4 << 20):
                texts, gone, counts = [], [], []
                for text, pieces in zip(batch.column(at).to_pylist(), batch.column("pieces").to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    counts.append(len(raw.split()))
                    removed, left = _cut(raw, counts[-1], [(p["first"], p["last"]) for p in pieces]) if pieces else (0, raw)
                    gone.append(removed)
                    texts.append(text if not removed else left.decode("utf-8", "surrogatepass"))
                columns = [pa.array(texts, pa.string()) if n == at else batch.column(n) for n in inside]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], [*inside, "n_words", "n_removed"])
        release()

    schema = T.StructType([*(T.StructField(n, rows.schema[n].dataType) for n in inside), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return rows.mapInArrow(run, schema).toDF(*kept, "n_words", "n_removed")
