"""URL filters: pattern rules behind an index on their rarest literal token.

A rule is a regular expression over `.host/path` (the host in ASCII lower case). Tokens are runs
of a-z and 0-9; a literal token of a rule is one that every address it matches holds as a whole
token. The frequencies of the rules' tokens are counted over all addresses, each rule is filed
under its rarest one, and the tokens of an address fetch the rules to run on it. Rules without a
literal token are filed under the empty token, which every address has.

Each distinct address is judged once. Null addresses and those without `://` have an empty host
and path and get the default verdict unless a rule matches `.`. Repeated rows get equal verdicts;
columns named as the results are replaced, all others pass through.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.llm.text import keeps_columns, lower_ascii, whole

MOST_BROADCAST = 100_000  # rules sent to all tasks; more are joined by a shuffle


@dataclass(frozen=True)
class Rule:
    """`name` is reported. Among rules that match, the highest `layer` wins, then the longest
    name, then the last by name."""

    name: str
    verdict: str
    pattern: str
    layer: int = 0


def prefix_rule(verdict: str, prefix: str, layer: int = 1) -> Rule:
    """Host and path prefix: fits the host and all its subdomains."""
    return Rule(prefix, verdict, r"^[^/]*\." + re.escape(prefix), layer)


BASE_RULES = (
    prefix_rule("allow", "com/"),
    prefix_rule("block", "example.com/en/"),
    prefix_rule("allow", "www.example.com/en/"),
    prefix_rule("block", "net/es/"),
    prefix_rule("block", "net/fr/"),
)
RULES = BASE_RULES + (
    Rule("spam-farm", "block", r"\.spam-farm\."),
    Rule("cheap-pills", "block", r"\.cheap-pills\."),
    Rule("casino", "block", r"\.(?:[a-z0-9]+-)?casino(?:-[a-z0-9]+)?\."),
    Rule("adult", "block", r"\.(?:xxx|porn|sex)(?:-[a-z0-9]+)?\."),
    Rule("archive", "block", r"\.(?:zip|exe|gz|tar|iso)$"),
    Rule("login", "block", r"/(?:login|signin|signup)(?:/|$)"),
)


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that stand, with a literal before and after them, in every match of the pattern."""
    runs, run = [], ""
    for kind, value in parser.parse(pattern):
        if kind is op.LITERAL:
            run += chr(value).lower()
        elif kind is op.AT and value is op.AT_BEGINNING:
            runs, run = [*runs, run], "^"
        elif kind is op.AT and value is op.AT_END:
            run += "$"
        else:
            runs, run = [*runs, run], ""
    return [
        token
        for text in [*runs, run]
        for token in re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])", text)
    ]


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(whole(url), F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_index(addresses: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rules with the token each is filed under. `addresses` has a column `tokens`."""
    spark = addresses.sparkSession
    schema = "name string, verdict string, pattern string, layer int, tokens array<string>"
    rows = [(r.name, r.verdict, r.pattern, r.layer, literal_tokens(r.pattern) or [""]) for r in rules]
    table = spark.createDataFrame(rows, schema).select(
        "name", "verdict", "pattern", "layer", F.explode("tokens").alias("token")
    )
    known = table.select("token").distinct()
    if len(rules) <= MOST_BROADCAST:
        known = F.broadcast(known)
    counts = (
        addresses.select(F.explode("tokens").alias("token"))
        .join(known, "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = Window.partitionBy("name", "pattern", "layer").orderBy(
        F.coalesce("n", F.lit(0)), "token"
    )
    return (
        table.join(counts, "token", "left")
        .withColumn("_k", F.row_number().over(rarest))
        .where(F.col("_k") == 1)
        .drop("_k", "n")
    )


@keeps_columns
def judge_urls(
    df: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Adds `host`, `path`, `rule` (name of the winning rule or null), `layer` and `verdict`."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    addresses = (
        df.select(F.concat(F.lit("."), host, path).alias("target"))
        .distinct()
        .withColumn(
            "tokens",
            F.array_union(
                F.array(F.lit("")), F.array_distinct(F.split(lower_ascii(F.col("target")), "[^a-z0-9]+"))
            ),
        )
    )
    index = rule_index(addresses, rules)
    if len(rules) <= MOST_BROADCAST:
        index = F.broadcast(index)
    order = F.struct(
        F.col("layer").alias("layer"), F.length("name").alias("size"), F.col("name").alias("name")
    )
    winners = (
        addresses.select("target", F.explode("tokens").alias("token"))
        .join(index, "token")
        .where(F.expr("target rlike pattern"))
        .groupBy("target")
        .agg(F.max_by(F.struct("name", "verdict", "layer"), order).alias("_won"))
    )
    source = df.drop("host", "path", "rule", "layer", "verdict").withColumns(
        {"host": host, "path": path}
    )
    return (
        source.withColumn("_target", F.concat(F.lit("."), "host", "path"))
        .join(winners.withColumnRenamed("target", "_target"), "_target", "left")
        .withColumns(
            {
                "rule": F.col("_won.name"),
                "layer": F.col("_won.layer"),
                "verdict": F.coalesce(F.col("_won.verdict"), F.lit(default)),
            }
        )
        .drop("_target", "_won")
    )
