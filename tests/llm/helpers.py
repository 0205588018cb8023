"""Rows for the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = {
    "en": "the of and to in is that it was for on are with as his they be at one have this from".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au été œuvre".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine über größe".split(),
}


def sentence(lang, rng, words=12):
    return " ".join(rng.choice(VOCABULARY[lang]) + rng.choice(["", "", rng.choice(VOCABULARY[lang])]) for _ in range(words)).capitalize() + "."


def text(lang, rng, sentences=6):
    return "\n".join(sentence(lang, rng) for _ in range(sentences))


def frame(spark, texts, langs=None):
    """Documents 0, 1, … with these texts."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    langs = [rng.choice(list(VOCABULARY)) for _ in range(n)]
    return [text(lang, rng, rng.randint(1, 12)) for lang in langs], langs


ODD = [None, "", " \t\n ", "x", "...", "1 2 3", "a" * 30_000, "word " * 30_000, "é́ \U0001f600 日本語 \x85  J̌", "it's we'll <|endoftext|>", "A  B   C \n D  "]
