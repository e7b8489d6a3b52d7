"""URL filters: rules by host and path, then a weighted vocabulary by Aho-Corasick.

The automaton finds all terms of the lower-cased url in one pass; a hit counts if no ASCII
letter or digit stands beside it.  One strict term rejects a url, and so do several different
soft ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STRICT = "adult casino escort malware phishing pills porn spam viagra warez xxx"
SOFT = "ads bet bets bonus cheap click deal farm free loan loans promo sale track win"
#: So many different soft terms reject a url; a strict term weighs as much.
SOFT_LIMIT = 2


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with the rule's; the text is both."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def lowered(url: str) -> Column:
    return F.translate(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), UPPER, LOWER)


def host_of(url: str = "url") -> Column:
    return F.regexp_extract(lowered(url), r"(?s)^.*?://([^/?#]*)", 1)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits as (verdict, rule), null if none does; of equally long ones
    the first in the order of their texts."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.text).alias("rule"))).otherwise(best)
    return best


def term_counts(strict: list[str], soft: list[str]):
    """A function of url columns: how many different strict and soft terms each url has."""

    @arrow_udf("struct<strict:int,soft:int>")
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        finder = ahocorasick.Automaton()
        for kind, terms in (("strict", strict), ("soft", soft)):
            for t in terms:
                finder.add_word(t, (kind, t))
        finder.make_automaton()
        beside = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for urls in columns:
            found = {"strict": [], "soft": []}
            for url in urls.to_pylist():
                hits = set()
                for end, (kind, term) in finder.iter(url):
                    start = end - len(term) + 1
                    if (start == 0 or url[start - 1] not in beside) and (end + 1 == len(url) or url[end + 1] not in beside):
                        hits.add((kind, term))
                for kind, counts in found.items():
                    counts.append(sum(k == kind for k, _ in hits))
            yield pa.StructArray.from_arrays([pa.array(found[k], pa.int32()) for k in ("strict", "soft")], names=["strict", "soft"])

    return count


def judge(
    pages: DataFrame,
    rules: list[Rule],
    strict: list[str] | None = None,
    soft: list[str] | None = None,
    soft_limit: int = SOFT_LIMIT,
    url: str = "url",
    key: str = "page_id",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_terms, soft_terms) for every row of `pages`.

    A rule that fits decides; else the terms do.  Null urls and those without :// have an empty
    host and path, fit no rule, and are judged by their terms: a null or empty url is allowed.
    Keys may be null or repeated.  Other columns are not read.
    """
    count = term_counts(STRICT.split() if strict is None else strict, SOFT.split() if soft is None else soft)
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), lowered(url).alias("lowered"))
    rows = rows.select("*", rule_of(rules, F.col("host"), F.col("path")).alias("best"), count("lowered").alias("terms"))
    by_terms = F.when((F.col("terms.strict") > 0) | (F.col("terms.soft") >= soft_limit), "block").otherwise("allow")
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), by_terms).alias("verdict"),
        F.col("terms.strict").alias("strict_terms"),
        F.col("terms.soft").alias("soft_terms"),
    )
