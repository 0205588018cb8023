"""URL filter: pattern rules found through their rarest literal token.

Each rule is a regular expression with the literal tokens that any matching URL must have. The rule is indexed under the
token that the fewest URLs have (counted over all URLs). A URL's tokens fetch its candidate rules from the index, and only
these run their expressions; rules without a token are candidates for every URL. All of it is column expressions: the
index is one constant, an array of slots by the checksum of the token with the few tokens of each slot, so a token is
looked up in the same time however many rules there are. The rules are a list of the caller's and travel with the tasks.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens are runs of ASCII letters and digits, in lower case.
_SPLIT = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in the host followed by the path; ``tokens`` are whole tokens that every match has.

    Of the rules that match, site rules (``site``) go before patterns, then the longest name wins, then the first by name.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False


def site_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""
    named = re.split(_SPLIT, host.lower())
    # What ends the path may go on in the URL, so the last token counts only if a sign closes it.
    closed = re.split(_SPLIT, path.lower())[:-1]
    return Rule(host + path, verdict, f"^(?:[^/]*\\.)?{_quoted(host)}{_quoted(path)}", tuple(t for t in named + closed if t), True)


def word_rule(verdict: str, *words: str) -> Rule:
    """Fits where the words stand one after another as whole tokens, one other sign between them, in any case."""
    joined = "[^A-Za-z0-9]".join(_quoted(w) for w in words)
    return Rule("-".join(words), verdict, f"(?i)(?<![A-Za-z0-9]){joined}(?![A-Za-z0-9])", tuple(w.lower() for w in words))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, number sign or the end, A-Z in lower case; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, number sign or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(target, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), _SPLIT), lambda t: t != ""))


def token_counts(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[str, int]:
    """In how many URLs each token of the rules is. One row per token of a rule comes back."""
    wanted = sorted({t for r in rules for t in r.tokens})
    slots = _Slots({t: [n] for n, t in enumerate(wanted)})
    target = F.concat(host_of(F.col(url_col)), path_of(F.col(url_col)))
    found = pages.select(F.explode(slots.fetched(_tokens(target))).alias("n")).groupBy("n").count().collect()
    return {t: 0 for t in wanted} | {wanted[r["n"]]: r["count"] for r in found}


def _constant(value: list, kind: str) -> Column:
    """``value`` as one constant of the plan: the text is read once, when the plan is made, not for each row."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {kind}")["v"]


class _Slots:
    """Numbers by token: about one slot for each token, found by the token's checksum."""

    def __init__(self, numbers: dict[str, list[int]]):
        self.size = max(1, len(numbers))
        slots: list[list[dict]] = [[] for _ in range(self.size)]
        for token, own in sorted(numbers.items()):
            slots[zlib.crc32(token.encode()) % self.size].append({"t": token, "n": own})
        self.table = _constant(slots, "array<array<struct<t: string, n: array<int>>>>")

    def fetched(self, tokens: Column) -> Column:
        """The numbers of all ``tokens``, one after another."""

        def of(token: Column) -> Column:
            slot = F.get(self.table, (F.crc32(token.cast("binary")) % self.size).cast("int"))
            return F.flatten(F.transform(F.filter(slot, lambda e: e["t"] == token), lambda e: e["n"]))

        return F.flatten(F.transform(tokens, of))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the site rule that decides, else null), pattern (the pattern rule that decides,
    else null), n_candidates (rules whose expression was run) and verdict.

    URLs that are null or have no ``://`` have empty host and path, no rule and the default verdict. Every row is judged
    by itself: repeated rows agree, an empty table stays empty. Columns of these names are replaced.
    """
    counts = token_counts(pages, rules, url_col)
    ordered = sorted(rules, key=lambda r: (not r.site, -len(r.name), r.name))
    index: dict[str, list[int]] = {}
    always = []
    for n, rule in enumerate(ordered):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts[t], t)), []).append(n)
        else:
            always.append(n)

    new = {"host", "path", "rule", "pattern", "n_candidates", "verdict"}
    kept = [c for c in pages.columns if c not in new]
    parts = pages.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    target = F.concat("host", "path")
    fetched = F.concat(_Slots(index).fetched(_tokens(target)), _constant(always, "array<int>"))
    found = parts.select("*", F.array_sort(F.array_distinct(fetched)).alias("own candidates"), target.alias("own target"))
    # Rules are numbered by rank, so the first candidate that matches decides.
    patterns = _constant([r.pattern for r in ordered], "array<string>")
    match = F.filter("own candidates", lambda n: F.rlike(F.col("own target"), F.get(patterns, n)))
    first = found.select("*", F.get(match, F.lit(0)).alias("own n"))
    named = _constant([{"rule": r.name if r.site else None, "pattern": None if r.site else r.name, "verdict": r.verdict} for r in ordered],
                      "array<struct<rule: string, pattern: string, verdict: string>>")
    own = F.get(named, F.col("own n"))
    return first.select(
        *kept, "host", "path", own["rule"].alias("rule"), own["pattern"].alias("pattern"),
        F.size("own candidates").cast("long").alias("n_candidates"), F.coalesce(own["verdict"], F.lit(default)).alias("verdict"),
    )


#: Rules by site, as the contract of op7 states them (fixed values).
SITES = [
    site_rule("allow", "com"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
]
#: Patterns for what no site rule decides: names that spam hosts and paths go by.
PATTERNS = [
    word_rule("block", *words)
    for words in (("spam", "farm"), ("cheap", "pills"), ("casino",), ("free", "money"), ("adult",), ("porn",), ("xxx",), ("payday", "loans"), ("free", "bets"), ("ads", "track"))
]
