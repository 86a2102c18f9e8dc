"""URL filter: host and path rules, and a weighted vocabulary found by Aho-Corasick.

A strict term rejects an url on its own, soft terms only when several different ones occur.  A term
counts where neither neighbour is an ASCII letter or digit.  The automaton and the rules are small
parameters; every url is judged in its own row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRICT = ("porn", "xxx", "escort", "hentai", "warez")
SOFT = ("casino", "poker", "betting", "viagra", "nude", "adult", "loan", "torrent", "crack", "dating")
SOFT_HITS = 2
#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an url; both empty for null or without ``://``."""
    pattern = r"://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def count_terms(strict: tuple[str, ...], soft: tuple[str, ...]):
    """A column function: struct of the numbers of strict hits and of distinct soft terms in an url.

    Terms and text are compared with A-Z lower-cased.
    """
    lower = str.maketrans(UPPER, LOWER)
    terms = {t.translate(lower): kind for kind, group in (("soft", soft), ("strict", strict)) for t in group}
    alphanumeric = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

    @F.pandas_udf("strict_hits long, soft_terms long")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, kind in terms.items():
            automaton.add_word(term, (term, kind))
        if terms:
            automaton.make_automaton()

        def judge(url: str | None) -> tuple[int, int]:
            if not url or not terms:
                return 0, 0
            text = url.translate(lower)
            strict_hits, soft_found = 0, set()
            for end, (term, kind) in automaton.iter(text):
                start = end - len(term) + 1
                if start and text[start - 1] in alphanumeric or text[end + 1:end + 2] in alphanumeric:
                    continue
                if kind == "strict":
                    strict_hits += 1
                else:
                    soft_found.add(term)
            return strict_hits, len(soft_found)

        for urls in batches:
            yield pd.DataFrame([judge(u) for u in urls], columns=["strict_hits", "soft_terms"], dtype="int64")

    return hits


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple = RULES,
                strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT,
                soft_hits: int = SOFT_HITS) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, strict_hits, soft_terms``.

    The longest fitting rule (as ``host`` + ``path``) decides; of equally long ones a block, then the greater.
    Without a rule, one strict hit or ``soft_hits`` different soft terms block.  A null url, or one
    without ``://``, has an empty host and path, no rule, and is still judged by its terms.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"),
                         path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # from the shortest to the longest, so that the longest is asked first
    for kind, rule_host, rule_path in sorted(
            rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1] + r[2])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col(
            "path").startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    judged = parts.withColumn("hits", count_terms(strict, soft)("url"))
    bad = (F.col("hits.strict_hits") > 0) | (F.col("hits.soft_terms") >= soft_hits)
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("hits.strict_hits").alias("strict_hits"), F.col("hits.soft_terms").alias("soft_terms"))
