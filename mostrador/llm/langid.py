"""Language identification with string kernels.

A text is the set of its character 1-, 2- and 3-grams (blended spectrum, presence only), hashed to ``BINS`` bins. The
kernel of two texts is the number of bins they share over the geometric mean of their set sizes. A bounded, balanced
sample of labelled texts gives ``LANDMARKS`` Nystroem landmarks and trains one kernel ridge regression per language
against all others; texts are scored in batches by matrix products with the landmarks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import add_columns, sample_ids

BINS = 1 << 16
GRAMS = (1, 2, 3)
LANDMARKS = 96
#: Bounds of the training sample: rows in all, and rows of a language at most and at least. Every language is learned, so
#: beyond SAMPLE_ROWS / SAMPLE_LEAST languages the sample grows by SAMPLE_LEAST rows (8 kB each) for each of them.
SAMPLE_ROWS, SAMPLE_PER_LANGUAGE, SAMPLE_LEAST = 1600, 400, 4
RIDGE = 1e-3
SHARPNESS = 6.0
UNKNOWN = "und"
_STEP = 1 << 20
#: Texts scored at a time: each has its bins as bytes (64 kB) and as a row of the matrix product (up to 256 kB).
_TOGETHER = 64


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for start, stop in ((0, 0xD800), (0xE000, 0x32400)):
        for code in range(start, stop):
            sign = chr(code)
            if sign.isalpha():
                low = sign.lower()
                table[code] = ord(low) if len(low) == 1 else code
    return table


def grams(text: str | None) -> np.ndarray | None:
    """Bins of the text's n-grams as a boolean array; None if the text has no letter. All else than letters counts as a
    space, and a run of it as one. Long texts go by in steps, so memory beyond the text is bounded."""
    bins, any_letter = np.zeros(BINS, bool), False
    carry = np.array([32], np.uint32)
    for start in range(0, len(text or ""), _STEP):
        codes = np.frombuffer(text[start : start + _STEP].encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.concatenate([carry, _letters()[codes]])
        space = codes == 32
        keep = np.append(True, ~(space[1:] & space[:-1]))
        codes = codes[keep]
        any_letter = any_letter or bool((codes != 32).any())
        mixed = codes.astype(np.uint32) * np.uint32(0x9E3779B1)
        for n in GRAMS:
            if len(codes) < n:
                continue
            h = mixed[: len(mixed) - n + 1].copy()
            for k in range(1, n):
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + mixed[k : len(mixed) - n + 1 + k]
            h = (h ^ (h >> np.uint32(13)) ^ np.uint32(n)) * np.uint32(0xC2B2AE35)
            bins[h >> np.uint32(16)] = True
        carry = codes[-(max(GRAMS) - 1) :]
    return bins if any_letter else None


@dataclass
class Model:
    languages: list[str]
    columns: np.ndarray  # bins that any landmark has
    landmarks: np.ndarray  # landmark x column, over the root of the landmark's size
    weights: np.ndarray  # landmark x language

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. The score tells the best language from the next one alone (0.5: no margin), so
        it does not shrink as more languages are learned."""
        found = [grams(t) if self.languages else None for t in texts]
        known = [i for i, g in enumerate(found) if g is not None]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known:
            rows = np.stack([found[i][self.columns] for i in known]).astype(np.float32)
            sizes = np.array([np.count_nonzero(found[i]) for i in known])
            kernel = (rows @ self.landmarks.T) / np.sqrt(sizes)[:, None]
            values = (kernel @ self.weights).astype(np.float64)
            best = values.argmax(axis=1)
            top = values[np.arange(len(known)), best]
            values[np.arange(len(known)), best] = -np.inf
            # A lone language competes with its own "rest", whose value is the opposite one.
            rival = values.max(axis=1) if len(self.languages) > 1 else -top
            shares = 1.0 / (1.0 + np.exp(-SHARPNESS * (top - rival)))
            for i, b, share in zip(known, best, shares, strict=True):
                names[i], scores[i] = self.languages[b], round(float(share), 6)
        return names, scores


def fit(labels: list[str], bins: list[np.ndarray], landmarks: int = LANDMARKS) -> Model:
    """From texts' bins and languages; the landmarks are dealt evenly over the languages, in the order given."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    y = np.array([languages.index(x) for x in labels])
    rows = np.stack(bins)
    turn = np.concatenate([np.arange((y == k).sum()) for k in range(len(languages))])
    order = np.concatenate([np.flatnonzero(y == k) for k in range(len(languages))])[np.argsort(turn, kind="stable")]
    chosen = order[: max(landmarks, len(languages))]
    columns = np.flatnonzero(rows[chosen].any(axis=0))
    roots = np.sqrt(rows.sum(axis=1))
    marks = (rows[chosen][:, columns] / roots[chosen, None]).astype(np.float32)
    kernel = np.stack([(marks @ row[columns].astype(np.float32)) / root for row, root in zip(rows, roots, strict=True)])
    values, vectors = np.linalg.eigh(kernel[chosen].astype(np.float64))
    use = values > 1e-6 * values[-1]
    whiten = vectors[:, use] / np.sqrt(values[use])
    phi = kernel @ whiten
    # Each language weighs the same, however many rows it has.
    weight = 1.0 / np.bincount(y)[y] / len(languages)
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    gram = (phi * weight[:, None]).T @ phi
    solved = np.linalg.solve(gram + RIDGE * np.eye(gram.shape[0]), (phi * weight[:, None]).T @ target)
    return Model(languages, columns, marks, (whiten @ solved).astype(np.float32))


def train(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """From rows with language and text. The driver gets the bins (8 kB) of a bounded sample; texts stay in the tasks.

    The sample is taken by a hash of the id, evenly over all languages: first ids alone, then the rows of these. One
    count per language reaches the driver as well.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    found = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").collect()}
    if not found:
        return fit([], [])
    each = max(SAMPLE_LEAST, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // len(found)))
    chosen = sample_ids(rows.select("lang", "id"), "lang", each, found)
    # At most ``each`` small rows a language: a proven bound for the broadcast. A repeated id gives its largest text once.
    sample = rows.join(F.broadcast(chosen), ["lang", "id"]).where("text is not null").groupBy("lang", "id").agg(F.max("text").alias("text"))

    def make():
        def work(texts):
            found = [grams(t) for t in texts]
            return [pa.array([None if g is None else np.packbits(g).tobytes() for g in found], pa.binary())]

        return work

    got = add_columns(sample, "text", [("bins", T.BinaryType())], make, keep=["lang", "id"], rows=_TOGETHER).where("bins is not null").collect()
    got.sort(key=lambda r: (r["lang"], str(r["id"])))
    return fit([r["lang"] for r in got], [np.unpackbits(np.frombuffer(r["bins"], np.uint8)).astype(bool) for r in got])


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with lang_pred and score (0 to 1), from the text alone.

    Texts that are null or have no letter are ``und`` with score 0; so is every text if nothing was learned. Each row is
    judged by itself, so repeated rows agree and an empty table stays empty. Columns of these two names are replaced.
    """

    def make():
        def work(texts):
            names, scores = model.decide(texts)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return work

    return add_columns(docs, text_col, [("lang_pred", T.StringType()), ("score", T.DoubleType())], make, keep, rows=_TOGETHER)


def confident(min_score: float) -> Column:
    """Rows that language identification keeps."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
