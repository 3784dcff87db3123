"""URL filter: pattern rules indexed by their rarest literal token.

Each rule is a regular expression with the literal tokens that every match must contain. A rule is
filed under the one of its tokens that is rarest among the URLs to be judged. A URL's tokens
fetch the rules filed under them, and only those run their expressions. URLs are never shuffled:
the index goes to the tasks in blocks of at most ``RULES_PER_BLOCK`` rules, one pass for each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import LOWER, UPPER, lower_ascii, unused

#: Largest index that is sent to the tasks at once.
RULES_PER_BLOCK = 50_000
TOKEN = "[0-9a-z]+"
ALLOW, BLOCK = "allow", "block"
BEST = "tier int, length int, strict int, rule string, verdict string, pattern string"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path + rest of a URL, the host in lower case.

    Of several rules that fit, the highest tier wins, then the longest, then block over allow.
    ``tokens`` are lower-case runs of ASCII letters and digits that stand alone in every match;
    without any, the rule runs on every URL.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    tier: int = 0


def host_path_rule(text: str, verdict: str) -> Rule:
    """A rule ``host/path``: fits the host and its subdomains if the URL's path starts with the rule's."""
    host, slash, path = text.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    pattern = rf"\A(?:[^/?#]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    # What follows the path may lengthen its last token, so that one does not stand alone.
    alone = re.findall(TOKEN, host) + re.findall(f"{TOKEN}(?=[^0-9a-z])", _lower(slash + path))
    return Rule(text, verdict, pattern, tuple(dict.fromkeys(alone)), tier=1)


def wildcard_rule(text: str, verdict: str) -> Rule:
    """A rule of literals: ``*`` fits anything, ``^`` a separator or the end, ``|`` at an end anchors there."""
    body = text.strip("|")
    start, end = text.startswith("|"), text.endswith("|")
    parts = {"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}
    pattern = "".join(parts.get(c) or re.escape(c) for c in body)
    pattern = (r"\A" if start else "") + pattern + (r"\Z" if end else "")
    shown = _lower(("^" if start else "*") + body + ("^" if end else "*"))
    return Rule(text, verdict, pattern, tuple(dict.fromkeys(re.findall(f"(?<=[^0-9a-z*])({TOKEN})(?=[^0-9a-z*])", shown))))


def _lower(text: str) -> str:
    return text.translate(str.maketrans(UPPER, LOWER))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*[^?#]*(.*)\z", 1), F.lit(""))


def token_counts(urls: DataFrame, url: Column, tokens: list[str]) -> dict[str, int]:
    """In how many URLs each of these tokens occurs: at most one row for each token reaches the driver."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    found = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(lower_ascii(url), F.lit(TOKEN), F.lit(0)))).alias("token"))
    counted = found.join(F.broadcast(wanted), "token", "left_semi").groupBy("token").count()
    return {row["token"]: row["count"] for row in counted.collect()}


def _matcher(rules: list[Rule], counts: dict[str, int]):
    """Pandas UDF: best fitting rule of this block for each URL."""
    index: dict[str, list[int]] = defaultdict(list)
    always: list[int] = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
        else:
            always.append(i)
    index = dict(index)
    order = [(r.tier, len(r.name), int(r.verdict == BLOCK), r.name, r.verdict, r.pattern) for r in rules]
    table = str.maketrans(UPPER, LOWER)
    columns = [c.split()[0] for c in BEST.split(", ")]

    @F.pandas_udf(BEST)
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = {}
        tokens = re.compile(TOKEN)
        for batch in batches:
            rows = []
            for url in batch:
                fetched = [i for t in set(tokens.findall(url.translate(table))) for i in index.get(t, ())]
                found = None
                for i in (*always, *fetched):
                    if found is not None and order[i][:3] <= found[:3]:
                        continue
                    if i not in compiled:
                        compiled[i] = re.compile(rules[i].pattern, re.DOTALL)
                    if compiled[i].search(url):
                        found = order[i]
                rows.append(found or (None,) * len(columns))
            frame = pd.DataFrame(rows, columns=columns)
            yield frame.astype({c: "Int32" for c in columns[:3]})

    return best


def judge(urls: DataFrame, rules: Iterable[Rule], url: str = "url", otherwise: str = ALLOW, block: int = RULES_PER_BLOCK) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` to the rows of ``urls``.

    ``rule`` is the winning rule's name, null if only a rule of tier 0 or none fits; ``verdict`` is the winner's,
    else ``otherwise``; ``pattern`` is the expression that decided. Columns of these names are replaced.
    Null URLs and those without ``://`` have empty host and path and fit no rule that needs a literal.
    Repeated rows are judged alike; an empty table gives an empty one.
    """
    rules = list(rules)
    kept = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict", "pattern")]
    source = F.col(f"`{url}`")
    counts = token_counts(urls, source, sorted({t for r in rules for t in r.tokens})) if rules else {}
    whole, best = unused(urls, "whole"), unused(urls, "best")
    judged = urls.withColumn(whole, F.concat(host_of(source), path_of(source), _rest_of(source)))
    found = [_matcher(rules[i : i + block], counts)(F.col(whole)) for i in range(0, len(rules), block)]
    empty = F.lit(None).cast(f"struct<{BEST.replace(' ', ':').replace(',:', ',')}>")
    # Of structs the greatest is that of the highest tier, then the longest, then the strictest rule.
    ranked = F.greatest(*[F.when(f["tier"].isNotNull(), f) for f in found], empty) if found else empty
    judged = judged.withColumn(best, ranked)
    return judged.select(
        *[F.col(f"`{c}`") for c in kept],
        host_of(source).alias("host"),
        path_of(source).alias("path"),
        F.when(F.col(best)["tier"] >= 1, F.col(best)["rule"]).alias("rule"),
        F.coalesce(F.col(best)["verdict"], F.lit(otherwise)).alias("verdict"),
        F.col(best)["pattern"].alias("pattern"),
    )
