"""Toxicity by a support vector machine on a subsequence string kernel, with Nystroem landmarks.

Two words are compared by the character triples they share in order, gaps allowed: a triple that spans ``s`` letters
weighs ``DECAY ** (s - 3)``, so letters inserted into an insult only make it weaker. The normalised kernel with
``LANDMARKS`` landmark words is whitened (Nystroem), and a linear SVM with squared hinge loss is fitted in that space.
Labels belong to documents, so a toxic document's sentences are bags: those of their words are taken as toxic that have
a part far more frequent in toxic documents than in others (and disguised forms of these, with letters put in or lost);
every other word of the other documents is clean, and the worst-looking of them are added round by round. A sentence scores as its worst word, a document as its worst
sentence, brought to 0..1 by a logistic curve fitted on rows that the SVM has not seen.

As the kernel is a sum over shared triples, the SVM's sum over landmarks folds into one weight per triple, exactly. That makes
scoring a table lookup per triple, for each different word of a block once.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import add_columns, blocks, own_copy, release, sample_ids, small_batches, written

SIGNS = 64
MAX_GAP = 2
DECAY = 0.5
LANDMARKS = 192
#: Bounds of the training sample: documents of each label; different words kept of a document (those of a hash order).
SAMPLE_PER_LABEL, WORDS_PER_DOCUMENT = 900, 2000
ROUNDS = 4
COST = 100.0
#: Longer words are judged in windows of this many letters, each half over the next.
WINDOW = 24
THRESHOLD = 0.7
#: Value of a token without letters, and of an empty text.
CLEAN = -3.0
#: Tokens whose values a task remembers; bounds its memory.
REMEMBERED = 200_000
#: Bits of the filter that tells which texts have a label.
FILTER_BITS = 1 << 25
#: Evidence (G squared) and ratio of rates at which a word, or a part of it (there are many more), counts as one of
#: toxic documents.
EVIDENCE, PART_EVIDENCE, RATIO = 16.0, 32.0, 12.0
_EDGE = 63
_STEPS = [(a, b) for a in range(1, MAX_GAP + 2) for b in range(1, MAX_GAP + 2)]
_SPELLED = re.compile(r"(?<!\S)(?:\w[^\w\s]*\s+){2,}\w(?!\S)")
_SPELLED_RE2 = r"(?:^|\s)\pL[^\pL\s]*\s+\pL[^\pL\s]*\s+\pL(?:\s|$)"
_NOT_LETTER = re.compile(r"[\W\d_]+")


def sign(letter: str) -> int:
    """a to z as 1 to 26, any other letter by its code as 27 to 62; 63 is the edge of a word."""
    code = ord(letter)
    return code - 96 if 97 <= code <= 122 else 27 + code % 36


def pieces(raw: str) -> list[str]:
    """What is judged of one lower-case token: its letters alone, or windows of them when they are many."""
    word = raw if raw.isalpha() else _NOT_LETTER.sub("", raw)
    if len(word) > WINDOW:
        return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    return [word] if len(word) > 1 else []


def words(text: str | None) -> set[str]:
    """Different words of a text, in lower case and letters only: characters between letters are dropped, letters
    spelled one by one are joined as well, words over WINDOW letters give their windows."""
    low = (text or "").lower()
    return {p for raw in {*low.split(), *_SPELLED.findall(low)} for p in pieces(raw)}


def triples(items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight), one row for each different triple of each word; weights sum over its occurrences."""
    joined = "".join(f"\x00{w}\x00" for w in items)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    signs = np.where(codes == 0, _EDGE, np.where((codes >= 97) & (codes <= 122), codes - 96, 27 + codes % 36))
    sizes = np.fromiter((len(w) + 2 for w in items), np.int64, len(items))
    owner = np.repeat(np.arange(len(items)), sizes)
    keys, weights = [], []
    for a, b in _STEPS:
        n = len(signs) - a - b
        if n <= 0:
            continue
        same = owner[:n] == owner[a + b :]
        triple = (signs[:n] * SIGNS + signs[a : a + n]) * SIGNS + signs[a + b :]
        keys.append(((owner[:n] << 18) | triple)[same])
        weights.append(np.full(len(keys[-1]), DECAY ** (a + b - 2)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    return key >> 18, key & (SIGNS**3 - 1), np.add.reduceat(weight, first) if len(first) else np.zeros(0)


def kernel(items: list[str], marks: list[str]) -> np.ndarray:
    """Normalised kernel of each item with each mark."""
    owner, triple, weight = triples(items)
    norm = np.sqrt(np.bincount(owner, weight**2, len(items)))
    m_owner, m_triple, m_weight = triples(marks)
    m_norm = np.sqrt(np.bincount(m_owner, m_weight**2, len(marks)))
    out = np.zeros((len(items), len(marks)))
    table = np.zeros(SIGNS**3)
    for j in range(len(marks)):
        own = m_owner == j
        table[m_triple[own]] = m_weight[own]
        out[:, j] = np.bincount(owner, weight * table[triple], len(items)) / np.maximum(norm * m_norm[j], 1e-12)
        table[m_triple[own]] = 0.0
    return out


@dataclass
class Model:
    table: np.ndarray | None  # weight of each triple; None if there were no two labels to learn from
    bias: float
    slope: float
    shift: float

    def decide(self, items: list[str], step: int = 2048) -> np.ndarray:
        """The SVM's value for each word, ``step`` words at a time, as a word has some hundred triples."""
        if len(items) > step:
            return np.concatenate([self.decide(items[i : i + step]) for i in range(0, len(items), step)])
        owner, triple, weight = triples(items)
        norm = np.sqrt(np.bincount(owner, weight**2, len(items)))
        return np.bincount(owner, weight * self.table[triple], len(items)) / np.maximum(norm, 1e-12) + self.bias

    def scores(self, texts: pa.Array, known: dict[str, float]) -> np.ndarray:
        """Of each text. ``known`` holds the values of tokens met before."""
        if self.table is None:
            return np.zeros(len(texts))
        low = pc.utf8_trim_whitespace(pc.utf8_lower(own_copy(texts)))
        lists = pc.utf8_split_whitespace(low)
        coded = pc.dictionary_encode(lists.flatten())
        tokens = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn([t for t in tokens if t not in known], known)
        values = np.fromiter(map(known.__getitem__, tokens), np.float64, len(tokens))[coded.indices.to_numpy(zero_copy_only=False)]
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        worst = np.full(len(texts), CLEAN)
        some = offsets[1:] > offsets[:-1]
        if some.any():
            worst[some] = np.maximum.reduceat(values, offsets[:-1][some])
        for i in np.flatnonzero(pc.match_substring_regex(low, _SPELLED_RE2).to_numpy(zero_copy_only=False)).tolist():
            spelled = _SPELLED.findall(low[i].as_py())
            self._learn([t for t in spelled if t not in known], known)
            worst[i] = max([worst[i], *(known[t] for t in spelled)])
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * worst + self.shift, -40, 40)))

    def _learn(self, tokens: list[str], known: dict[str, float]) -> None:
        of = [(t, pieces(t)) for t in tokens]
        every = list({p for _, own in of for p in own})
        value = dict(zip(every, self.decide(every).tolist(), strict=True))
        known.update((t, max(map(value.__getitem__, own), default=CLEAN)) for t, own in of)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights, the last one the bias: L2-regularised squared hinge loss by Newton steps on the violated rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        active = y * (x @ w) < 1
        xa = x[active] * np.sqrt(cost[active])[:, None]
        new = np.linalg.solve(ridge + xa.T @ xa, xa.T @ (y[active] * np.sqrt(cost[active])))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _parts(word: str) -> set[str]:
    edged = f"^{word}$"
    return {edged[i : i + n] for n in (4, 5) for i in range(len(edged) - n + 1)} | {edged}


def _evidence(toxic: list[set[str]], clean: list[set[str]], least: float) -> dict[str, float]:
    """G squared of each item that is at least RATIO times as frequent, by documents, in ``toxic`` as in ``clean``."""
    in_toxic, in_clean = (Counter(x for own in docs for x in own) for docs in (toxic, clean))
    bad, good = max(1, len(toxic)), max(1, len(clean))
    out = {}
    for item, k in in_toxic.items():
        j = in_clean[item]
        if k / bad < RATIO * j / good:
            continue
        rate = (k + j) / (bad + good)
        found = 2 * (k * np.log(k / bad / rate) + (j * np.log(j / good / rate) if j else 0.0))
        if found >= least:
            out[item] = found
    return out


def marked_words(toxic: list[list[str]], clean: list[list[str]]) -> dict[str, float]:
    """Words of toxic documents that are far more frequent, by documents, there than in clean ones; then of the other
    words those with such a part (4 or 5 signs, edges included), so endings may differ from word to word. With the
    evidence."""
    out = _evidence([set(own) for own in toxic], [set(own) for own in clean], EVIDENCE)
    seen = {w for own in clean for w in own}
    parts = _evidence(*([{p for w in own if w not in out for p in _parts(w)} for own in docs] for docs in (toxic, clean)), PART_EVIDENCE)
    for word in {w for own in toxic for w in own} - seen - out.keys():
        best = max((parts[p] for p in _parts(word) if p in parts), default=0.0)
        if best:
            out[word] = best
    return out


def _unlike(docs: list[list[str]]) -> list[list[str]]:
    """One of the documents that share their two long words of least hash: copies would count as evidence many times."""
    kept = {}
    for own in docs:
        long = sorted((w for w in own if len(w) >= 8), key=hash_of)[:2]
        kept.setdefault(tuple(long) if len(long) == 2 else tuple(sorted(own)), own)
    return list(kept.values())


def _disguises(word: str) -> list[str]:
    """The word with a letter put in, doubled or lost, at places that its hash picks."""
    at = hash_of(word)
    i, j, k = 1 + at % (len(word) - 1), (at >> 16) % len(word), 1 + (at >> 32) % (len(word) - 1)
    extra = chr(97 + (at >> 48) % 26)
    return [word[:i] + extra + word[i:], word[: j + 1] + word[j:]] + ([word[:k] + word[k + 1 :]] if len(word) > 4 else [])


def fit(texts: list[list[str]], labels: list[int], found: dict[str, float] | None = None) -> Model:
    """From documents given as their words, and their labels. Every fourth document only fits the logistic curve.
    ``found``: marked words of a larger table that these documents are a sample of."""
    train = [i for i in range(len(texts)) if i % 4 != 3]
    check = [i for i in range(len(texts)) if i % 4 == 3]
    toxic, clean = ([texts[i] for i in train if (labels[i] == 1) == bad] for bad in (True, False))
    marked = {**marked_words(*map(_unlike, (toxic, clean))), **(found or {})}
    seen = Counter(w for own in clean for w in own)
    if not marked or not seen:
        if any(toxic) and seen:
            warnings.warn("toxicity: both labels occur, but no word tells them apart; every text scores 0", stacklevel=2)
        return Model(None, 0.0, 1.0, 0.0)
    ranked = sorted(marked, key=lambda w: (-marked[w], w))
    common = sorted(seen, key=lambda w: (-seen[w], w))
    # Landmarks: marked words unlike each other, and as many of the commonest clean words.
    marks = _spread_out(ranked[: 8 * LANDMARKS], LANDMARKS // 2) + common[: LANDMARKS // 2]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    use = values > 1e-4 * values[-1]
    whiten = vectors[:, use] / np.sqrt(values[use])
    bad = marked.keys() | ({d for w in ranked for d in _disguises(w)} - seen.keys())
    common = [w for w in common if w not in bad]
    good = set(common[:4000])
    model = Model(None, 0.0, 1.0, 0.0)
    for _ in range(ROUNDS):
        items = sorted(bad) + sorted(good)
        y = np.array([1.0] * len(bad) + [-1.0] * len(good))
        cost = np.where(y > 0, COST / len(bad), COST / len(good)) * len(items) / 2
        weights = _svm(kernel(items, marks) @ whiten, y, cost)
        model = Model(_fold(marks, whiten @ weights[:-1]), float(weights[-1]), 1.0, 0.0)
        # Each round adds the clean documents' words that look worst.
        worst = model.decide(common)
        good.update(common[i] for i in np.argsort(-worst, kind="stable")[:2000])
    every = sorted({w for i in check for w in texts[i]})
    value = dict(zip(every, model.decide(every).tolist(), strict=True))
    of = np.array([max(map(value.__getitem__, texts[i]), default=CLEAN) for i in check])
    slope, shift = _logistic(of, np.array([labels[i] == 1 for i in check]))
    return Model(model.table, model.bias, slope, shift)


def _spread_out(items: list[str], count: int) -> list[str]:
    """Greedily the items least like those taken before, beginning with the first."""
    if len(items) <= count:
        return items
    alike = kernel(items, items)
    taken, nearest = [0], alike[:, 0].copy()
    while len(taken) < count:
        nxt = int(np.argmin(nearest))
        taken.append(nxt)
        nearest = np.maximum(nearest, alike[:, nxt])
    return [items[i] for i in taken]


def _fold(marks: list[str], beta: np.ndarray) -> np.ndarray:
    """One weight per triple, so that the sum over a word's triples is the sum over the landmarks."""
    owner, triple, weight = triples(marks)
    norm = np.sqrt(np.bincount(owner, weight**2, len(marks)))
    return np.bincount(triple, weight * (beta / np.maximum(norm, 1e-12))[owner], SIGNS**3)


def _logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, with smoothed targets and equal weight of both labels."""
    bad, good = int(label.sum()), int((~label).sum())
    if not bad or not good:
        return 6.0, 0.0
    target = np.where(label, (bad + 1) / (bad + 2), 1 / (good + 2))
    weight = np.where(label, 0.5 / bad, 0.5 / good)
    best, a, b = None, 1.0, 0.0
    x = np.stack([value, np.ones(len(value))], axis=1)
    w = np.array([a, b])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-4 * w * np.array([1, 0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-4, 1e-8])
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
        if best is not None and np.abs(step).max() < 1e-8:
            break
        best = w
    slope = float(w[0]) if w[0] > 0 else 6.0
    # The curve passes THRESHOLD where it parts the labels best: in the middle of the widest of the best gaps.
    at = np.unique(value)
    cuts = np.concatenate([(at[1:] + at[:-1]) / 2, [at[-1] + 0.5]])
    right = np.array([(value[label] >= c).mean() + (value[~label] < c).mean() for c in cuts])
    gaps = np.append(at[1:] - at[:-1], 0.0)
    best = cuts[np.lexsort((gaps, right))[-1]]
    return slope, float(np.log(THRESHOLD / (1 - THRESHOLD)) - slope * best)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """From ``docs`` (id, text) with ``labels`` (id, label 0 or 1). Ids alone are joined with the labels; texts are read for
    the sample only. The driver gets a bounded number of words of a bounded sample, chosen by
    a hash of the id evenly over both labels. With fewer than two labels nothing is learned and all scores are 0."""
    marks = labels.where(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("int").alias("label"), F.col(id_col).alias("id"))
    known = marks.join(docs.select(F.col(id_col).alias("id")), "id").select("label", "id")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = sample_ids(known, "label", SAMPLE_PER_LABEL, counts)
    # At most 2 * SAMPLE_PER_LABEL small rows: a proven bound for the broadcast.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").where("text is not null").groupBy("label", "id").agg(F.max("text").alias("text"))

    def make():
        def work(texts):
            found = [sorted(words(t), key=lambda w: (hash_of(w), w))[:WORDS_PER_DOCUMENT] for t in texts]
            return [pa.array(found, pa.list_(pa.string()))]

        return work

    got = add_columns(sample, "text", [("words", T.ArrayType(T.StringType()))], make, keep=["label", "id"]).collect()
    got.sort(key=lambda r: (hash_of(str(r["id"])), str(r["id"]), r["label"]))
    held = [r["id"] for r in got[3::4]]  # those that fit() keeps from training
    found = all_marked_words(texts.where("text is not null").where(~F.col("id").isin(held)), marks) if len(counts) == 2 else {}
    return fit([list(r["words"]) for r in got], [r["label"] for r in got], found)


def only_met(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, text) whose id may be in ``ids``, told by a filter of fixed size: texts without a label stay in their
    tasks. A few others may come along."""
    at = F.xxhash64("id").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    parts = ids.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
    table = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for row in parts.collect():
        table[row["b"] - 1] = np.frombuffer(row["bits"], np.uint8)
    met = texts.sparkSession.sparkContext.broadcast(table.ravel())  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = met.value
        for batch in batches:
            place = batch.column("place").to_numpy() - 1
            found = batch.filter(pa.array((bits[place >> 3] >> (place & 7) & 1).astype(bool)))
            yield found.select(["id", "text"])

    return texts.select("id", "text", at.alias("place")).mapInArrow(run, texts.select("id", "text").schema)


def all_marked_words(texts: DataFrame, marks: DataFrame) -> dict[str, float]:
    """Marked words with their evidence, by the document counts of all rows (id, text) that have a label (id, label).
    Of documents that share their two long words of least hash one counts. The evidence asked for grows with the
    logarithm of the rows, as more words may pass by chance; the rate that a word needs falls with size."""

    def keyed():
        return lambda batch: [pa.array([" ".join(sorted((w for w in words(t) if len(w) >= 8), key=hash_of)[:2]) or t for t in batch], pa.string())]

    # Two words of a text go to its label, not the text.
    likes = add_columns(texts, "text", [("like", T.StringType())], keyed, keep=["id"])
    kept = written(likes.join(marks, "id").groupBy("label", "like").agg(F.min("id").alias("id")), "toxicity-unlike")
    size = {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", 4 << 20):
                total = {label: Counter() for label in (0, 1)}
                for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                    total[label].update(words(text))
                every = list(total[0].keys() | total[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([total[x][w] for w in every], pa.int64()) for x in (1, 0))], ["word", "k", "j"])
                del total, every
        release()

    counted = only_met(small_batches(texts), kept).join(kept.select("id", "label"), "id").select("text", "label").mapInArrow(run, "word string, k long, j long").groupBy("word").agg(F.sum("k").alias("k"), F.sum("j").alias("j"))
    k, j, rate = F.col("k"), F.col("j"), (F.col("k") + F.col("j")) / F.lit(bad + good)
    found = 2 * (k * F.log(k / bad / rate) + F.when(j > 0, j * F.log(j / good / rate)).otherwise(0.0))
    least = EVIDENCE + 2 * np.log(max(1.0, (bad + good) / (2 * SAMPLE_PER_LABEL)))
    passing = counted.where((k > 0) & (k / bad >= RATIO * j / good)).select("word", found.alias("found")).where(F.col("found") >= float(least))
    return {r["word"]: r["found"] for r in passing.collect()}


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with score (0 to 1, higher: more likely toxic) and predicted (1 from
    THRESHOLD on, else 0).

    The whole text counts, and nothing else. Null and empty texts score like a text without any suspicious word. Each
    row is judged by itself: repeated rows agree, an empty table stays empty. Columns of these two names are replaced.
    """

    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    chosen = small_batches(docs).select(*kept, F.col(f"`{text_col}`").alias("judged text"))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for whole in batches:
            for batch in blocks(whole, "judged text", 4 << 20):
                if len(known) > REMEMBERED:
                    known.clear()
                value = model.scores(batch.column("judged text"), known)
                arrays = [pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*kept, "score", "predicted"])
        known.clear()
        release()

    return chosen.mapInArrow(run, schema)


def acceptable() -> Column:
    """Rows that the toxicity filter keeps."""
    return F.col("predicted") == 0
