"""URL filter: weighted vocabulary found by an Aho-Corasick automaton, and host rules.

score_urls counts, in one pass over each URL, the strict and the soft terms that stand
between boundaries (no letter or digit on either side). A URL is rejected on one strict
term or on min_soft different soft terms; a soft term found twice counts once.

host_path and apply_rules are native: allow and block rules of the form host/path, where
the longest rule that fits wins over the vocabulary.

Null URLs have empty host and path and no terms, so they are allowed; repeated rows are
judged alike; columns of the same names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepnl.session import ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Vocabulary:
    """strict: one is enough; soft: min_soft different ones are needed."""

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    min_soft: int = 2


#: The default vocabulary.
DEFAULT = Vocabulary(
    strict=(
        "adult", "camgirl", "casino", "casinos", "cialis", "escort", "escorts", "hentai", "malware",
        "nsfw", "nude", "nudes", "phishing", "porn", "porno", "sex", "sexcam", "spam", "viagra",
        "warez", "xxx",
    ),
    soft=(
        "ads", "advert", "banner", "bet", "bets", "betting", "bonus", "cash", "cheap", "click",
        "clicks", "coupon", "dating", "deals", "discount", "farm", "free", "gamble", "hot", "jackpot",
        "loan", "loans", "lottery", "payday", "pharmacy", "pill", "pills", "poker", "popup", "prize",
        "promo", "replica", "rx", "slots", "track", "tracker", "tracking", "win", "winner",
    ),
)


@dataclass(frozen=True)
class Rule:
    """pattern: a host, then a path that begins with a slash."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


def host_path(url: Column | str = "url") -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty without a scheme."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def apply_rules(df: DataFrame, rules: Sequence[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """Adds rule (the longest that fits, else null) and rule_verdict. Every rule is one comparison."""
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = (
            (F.col(host) == rule.host) | F.endswith(F.col(host), F.lit("." + rule.host))
        ) & F.startswith(F.col(path), F.lit(rule.path))
        chosen = F.when(fits, rule.pattern).otherwise(chosen)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return df.withColumn("rule", chosen).withColumn("rule_verdict", verdict)


def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in (("soft", vocabulary.soft), ("strict", vocabulary.strict)):
        for term in terms:
            found.add_word(term, (weight, term))
    found.make_automaton()
    return found


def count_terms(url: str, terms: ahocorasick.Automaton) -> tuple[int, int, int, int]:
    """Strict and soft terms found, then different strict and different soft terms."""
    url = url.translate(_TO_LOWER)
    strict, soft = [], []
    for last, (weight, term) in terms.iter(url):
        first = last - len(term) + 1
        if (first and url[first - 1].isalnum()) or url[last + 1 : last + 2].isalnum():
            continue
        (strict if weight == "strict" else soft).append(term)
    return len(strict), len(soft), len(set(strict)), len(set(soft))


def score_urls(df: DataFrame, vocabulary: Vocabulary = DEFAULT, url: str = "url") -> DataFrame:
    """Adds n_strict, n_soft, n_strict_terms, n_soft_terms (long) and url_verdict (allow or block)."""

    @F.pandas_udf("n_strict long, n_soft long, n_strict_terms long, n_soft_terms long")
    def count(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = automaton(vocabulary)
        for batch in urls:
            rows = [count_terms(x or "", terms) for x in batch]
            yield pd.DataFrame(rows, columns=["n_strict", "n_soft", "n_strict_terms", "n_soft_terms"])

    ship_package(df.sparkSession)
    made = ("n_strict", "n_soft", "n_strict_terms", "n_soft_terms")
    df = df.withColumn("_terms", count(F.col(url)))
    df = df.withColumns({name: F.col(f"_terms.{name}") for name in made}).drop("_terms")
    rejected = (F.col("n_strict") > 0) | (F.col("n_soft_terms") >= vocabulary.min_soft)
    return df.withColumn("url_verdict", F.when(rejected, "block").otherwise("allow"))
