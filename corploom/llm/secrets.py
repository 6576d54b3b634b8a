"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must
hold, as an OR of ANDs. The index has a posting (trigram, text key) for each trigram that some
query asks for; postings are intersected per conjunction, and only rules whose query a text
meets run on it. Rules without mandatory trigrams scan all texts.

Keys are digests of the text, so copies share their postings. Trigrams are compared in ASCII
lower case, which widens the candidates only; the expressions decide. Null texts count as empty,
repeated rows are scanned alike, and columns other than the result's pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.text import SPANS, keeps_columns, lower_ascii, spans_of, whole

Clauses = frozenset[frozenset[str]]  # OR of ANDs; an empty AND asks for nothing
_ANY: Clauses = frozenset({frozenset()})
_MOST_TEXTS = 64  # texts followed at once while a query is derived; beyond, it asks for less


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose part `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Both Java and Python read these patterns alike.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A run is taken whole or not at all, so its least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE_RULES + (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login_url", r"[a-z][a-z0-9+.-]{0,20}://[A-Za-z0-9._%-]+:[^\x20@/:]{3,}@[A-Za-z0-9.-]+"),
)


def trigram_query(pattern: str) -> Clauses:
    """OR of ANDs of lower-case trigrams that every match of the pattern must hold."""
    exact, clauses = _of_sequence(parser.parse(pattern))
    return _simplify(_both(clauses, _of_texts(exact)))


def _of_texts(texts: frozenset[str] | None) -> Clauses:
    """What a match that is one of the texts must hold."""
    if texts is None:
        return _ANY
    return frozenset(frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts)


def _both(a: Clauses, b: Clauses) -> Clauses:
    joined = frozenset(x | y for x, y in product(a, b))
    return joined if len(joined) <= _MOST_TEXTS else max(a, b, key=lambda c: min(map(len, c)))


def _simplify(clauses: Clauses) -> Clauses:
    """Without clauses that ask for more than another one does."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _of_sequence(nodes) -> tuple[frozenset[str] | None, Clauses]:
    """The texts a sequence can match (None: too many to name) and what any match must hold."""
    run: frozenset[str] | None = frozenset({""})
    whole_sequence, clauses = True, _ANY
    for node in nodes:
        texts, needed = _of_node(*node)
        clauses = _both(clauses, needed)
        if texts is not None and len(run) * len(texts) <= _MOST_TEXTS:
            run = frozenset(a + b for a, b in product(run, texts))
            continue
        clauses = _both(clauses, _of_texts(run))
        whole_sequence = False
        run = texts if texts is not None else frozenset({""})
    if whole_sequence:
        return run, clauses
    return None, _both(clauses, _of_texts(run))


def _of_node(kind, value) -> tuple[frozenset[str] | None, Clauses]:
    if kind is op.LITERAL:
        return frozenset({_lower(chr(value))}), _ANY
    if kind is op.IN:
        found = set()
        for k, v in value:
            if k is op.LITERAL:
                found.add(_lower(chr(v)))
            elif k is op.RANGE and v[1] - v[0] < _MOST_TEXTS:
                found |= {_lower(chr(c)) for c in range(v[0], v[1] + 1)}
            else:
                return None, _ANY
        # Wide classes multiply texts without making trigrams rarer.
        return (frozenset(found), _ANY) if len(found) <= 8 else (None, _ANY)
    if kind is op.SUBPATTERN:
        return _of_sequence(value[3])
    if kind is op.BRANCH:
        parts = [_of_sequence(branch) for branch in value[1]]
        clauses = frozenset().union(*[_both(c, _of_texts(t)) for t, c in parts])
        if all(t is not None for t, _ in parts):
            return frozenset().union(*[t for t, _ in parts]), clauses
        return None, clauses
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, body = value
        texts, needed = _of_sequence(body)
        if texts is not None and least == most == 1:
            return texts, needed
        if texts is not None and (least, most) == (0, 1):
            return texts | {""}, _ANY
        return None, _both(needed, _of_texts(texts)) if least else _ANY
    if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
        return frozenset({""}), _ANY
    return None, _ANY


def _lower(char: str) -> str:
    return char.lower() if char.isascii() else char


def postings(df: DataFrame, trigrams: Sequence[str], text: str, key: str) -> DataFrame:
    """(trigram, key) for each asked-for trigram of each text, each pair once."""
    low = lower_ascii(F.col(text))
    held = F.array_compact(
        F.array(*[F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams])
    )
    return (
        df.select(F.col(key), low.alias("_low"))
        .select(F.col(key), F.explode(held).alias("trigram"))
        .distinct()
    )


def candidates(df: DataFrame, rules: Sequence[Rule], text: str, key: str) -> DataFrame:
    """(key, kinds): the rules with a trigram query that a text's postings meet."""
    spark = df.sparkSession
    asked = [
        (rule.kind, n, trigram, len(clause))
        for rule in rules
        for n, clause in enumerate(sorted(map(sorted, trigram_query(rule.pattern))))
        for trigram in clause
    ]
    schema = "kind string, clause int, trigram string, size int"
    clauses = spark.createDataFrame(asked, schema)
    met = (
        postings(df, sorted({a[2] for a in asked}), text, key)
        .join(F.broadcast(clauses), "trigram")  # bounded by the rules
        .groupBy(key, "kind", "clause")
        .agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
        .where(F.col("n") == F.col("size"))
    )
    return met.groupBy(key).agg(F.collect_set("kind").alias("kinds"))


def scans_fully(rule: Rule) -> bool:
    return frozenset() in trigram_query(rule.pattern)


@keeps_columns
def scan_secrets(
    df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", result: str = "secrets"
) -> DataFrame:
    """Adds `result`: spans (start, end, kind, part) in code points, in the order of the rules."""
    keyed = df.drop(result).withColumn("_text", whole(F.col(text)))
    keyed = keyed.withColumn("_key", F.md5("_text"))
    indexed = [rule for rule in rules if not scans_fully(rule)]
    found = candidates(keyed.select("_text", "_key"), indexed, "_text", "_key")
    joined = keyed.join(found.withColumnRenamed("kinds", "_kinds"), "_key", "left")

    def spans(rule: Rule) -> Column:
        every = F.filter(
            spans_of(F.col("_text"), rule.pattern, rule.kind, rule.group),
            lambda s: F.length(s["part"]) >= rule.least,
        )
        if rule not in indexed:
            return every
        asked = F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False))
        return F.when(asked, every).otherwise(F.array().cast(SPANS))

    return joined.withColumn(result, F.concat(*[spans(rule) for rule in rules])).drop(
        "_text", "_key", "_kinds"
    )
