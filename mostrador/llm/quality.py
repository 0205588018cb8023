"""Quality rules with risk-controlled thresholds, in column expressions alone.

Base counts give a few ratios per document. Each ratio is a rule: a document above the rule's cutoff is rejected. The cutoffs
come from labelled documents: for every stratum, rule and candidate cutoff the share of good documents that would be
rejected is bounded from above exactly (binomial tail, Clopper-Pearson). The level is divided by the number of strata and
rules (Bonferroni); a rule's cutoffs are tested in a fixed order, from the highest down to the first that fails, which
needs no further division. The lowest cutoff certified within the rule's part of the risk is taken; where none is, the rule
stays off. So with probability ``1 - DELTA`` at most ``RISK`` of the good documents of any stratum
are rejected, whatever the labels' number is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import SPACE_CLASS, written

RISK = 0.02
DELTA = 0.05
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Candidate cutoffs of every rule (a ratio; rejected is what lies above).
CUTOFFS = [0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: The ratios: part and whole.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "shouting": ("n_shouts", "n_words"),
}


def ratio(rule: str) -> Column:
    part, whole = map(F.col, RULES[rule])
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) with the base counts, n_lines and n_shouts (words that end in ``!``), all long.

    Null text has no words: all counts are 0. Columns of these names are replaced.
    """
    new = {*_COUNTS, "n_lines", "n_shouts"}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*kept, text.alias("text of doc"))
    rows = rows.select(
        *kept,
        F.filter(F.split("text of doc", SPACE_CLASS + "+"), lambda w: w != "").alias("own words"),
        F.filter(F.split("text of doc", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("own lines"),
        F.regexp_count("text of doc", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text of doc", F.lit(r"!(?![^\x20\x09-\x0D])")).cast("long").alias("n_shouts"),
    )
    # Hash of the window of WINDOW words from each word on; the seeds chain, so words can't run into one another.
    windows = F.when(
        F.size("own words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("own words") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("own words"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    rows = rows.select(
        *kept, "n_symbols", "n_shouts", F.size("own words").cast("long").alias("n_words"), F.size("own lines").cast("long").alias("n_lines"),
        F.char_length(F.array_join("own words", "")).cast("long").alias("word_chars"),
        (F.size("own lines") - F.size(F.array_distinct("own lines"))).cast("long").alias("n_dup_lines"), windows.alias("own windows"),
    )
    # Only texts with an equal pair of windows are looked at further: equal hashes next to each other after sorting.
    found = F.when(
        F.size(F.array_distinct("own windows")) < F.size("own windows"),
        F.sort_array(F.transform("own windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    ).otherwise(F.array().cast("array<struct<h:long,at:int>>"))
    rows = rows.select(*[c for c in rows.columns if c != "own windows"], found.alias("own ordered"))
    twice = F.filter(
        "own ordered",
        lambda x, i: (x["h"] == F.get(F.col("own ordered"), i - 1)["h"]) | (x["h"] == F.get(F.col("own ordered"), i + 1)["h"]),
    )
    rows = rows.select(*[c for c in rows.columns if c != "own ordered"], F.sort_array(F.transform(twice, lambda x: x["at"])).alias("own starts"))
    covered = F.aggregate(
        F.transform("own starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("own starts"), i + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda a, n: a + n,
    )
    return rows.select(*kept, *[covered.cast("long").alias(c) if c == "n_repeat_words" else F.col(c) for c in (*_COUNTS, "n_lines", "n_shouts")])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def tail(rejected: Column, good: Column, risk: float) -> Column:
    """P(X <= rejected) for X binomial(good, risk): how likely so few rejections are, were the true share ``risk``.

    Exact sum of the terms, each from the one before, scaled by the largest so far; over at most good * risk terms, as
    more rejections than expected certify nothing (then 1).
    """
    log_odds = math.log(risk) - math.log1p(-risk)

    def add(state: Column, i: Column) -> Column:
        # log of term i, and the sum so far as total * exp(peak)
        term = state["term"] + F.log((good - i + 1) / i) + F.lit(log_odds)
        peak = F.greatest(state["peak"], term)
        total = state["total"] * F.exp(state["peak"] - peak) + F.exp(term - peak)
        return F.struct(term.alias("term"), peak.alias("peak"), total.alias("total"))

    start = good * F.lit(math.log1p(-risk))
    first = F.struct(start.alias("term"), start.alias("peak"), F.lit(1.0).alias("total"))
    steps = F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<long>"))
    summed = F.aggregate(steps, first, add, lambda s: F.log(s["total"]) + s["peak"])
    return F.when(rejected > good * risk, F.lit(1.0)).otherwise(F.exp(F.least(summed, F.lit(0.0))))


def thresholds(measured: DataFrame, labels: DataFrame, stratum: str, id_col: str = "doc_id", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, and for each rule its cutoff or null) from ``measured`` and ``labels`` (id, quality 0 or 1).

    Only good documents (1) that pass the base rules count. Of several labels of one id the lowest holds. At most one row
    per stratum: small. A null stratum is one of its own.
    """
    good = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.min("quality").alias("quality")).where("quality = 1")
    held = measured.where(~base_failed()).join(good, F.col(id_col) == F.col("label_id")).select(
        F.col(stratum).alias("at"), *[ratio(name).alias(name) for name in RULES]
    )
    over = [F.count_if(F.col(name) > c).alias(f"{name} {n}") for name in RULES for n, c in enumerate(CUTOFFS)]
    counted = held.groupBy("at").agg(F.count("*").alias("good"), *over)
    counted = written(counted, "quality-holdout")
    strata = max(1, counted.count())
    share = risk / len(RULES)
    level = F.lit(delta / (strata * len(RULES)))
    picked = [
        F.array_min(F.array(*[F.when(tail(F.col(f"{name} {n}"), F.col("good"), share) <= level, F.lit(c)) for n, c in enumerate(CUTOFFS)])).alias(f"cut {name}")
        for name in RULES
    ]
    return counted.select("at", "good", *picked)


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """(id, stratum, base counts, n_lines, n_shouts, base_failed, failed_rules, kept) for each row of ``docs``.

    ``kept`` is false if the base rules fail or any certified rule does; ``failed_rules`` names these. Without labels, or
    with too few in a stratum, no rule is certified there and the base rules decide alone. Repeated rows are judged
    alike, each for itself; an empty table gives no rows. Other columns are ignored.
    """
    measured = written(measure(docs.select(id_col, stratum, text_col), text_col, [id_col, stratum]), "quality-counts")
    cuts = written(thresholds(measured, labels, stratum, id_col, risk, delta), "quality-cutoffs")
    # One row per stratum: joined by broadcast while under the session's threshold, else by shuffle.
    joined = measured.join(cuts, measured[stratum].eqNullSafe(cuts["at"]), "left")
    failed = F.filter(
        F.array(*[F.when(ratio(name) > F.col(f"cut {name}"), F.lit(name)) for name in RULES]), lambda x: x.isNotNull()
    )
    out = joined.select(*measured.columns, base_failed().alias("base_failed"), failed.alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
