"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure of a text is taken once per row inside one struct, and the rules are folded into
the same struct, so filters on the verdict do not take the measures again.

Nulls and empty texts have no words: all counts are 0 and the row fails `n_words`. Ratios over
zero words or lines are 0. Repeated rows are judged each on its own; other columns pass through
unless they bear the name of the result column, which is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.text import SPACE, keeps_columns, let, range_of, whole, words_of

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he this are or from at which but "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des et un une du en est que qui dans pour par sur au pas plus avec son "
    "el los las y se del al por con para su una como más lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A row passes if `low <= measure <= high`; an open bound is None."""

    measure: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (Rule("n_words", low=50), Rule("repeat_word_ratio", high=0.5))

RULES = (
    Rule("mean_word_chars", low=2.0, high=20.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
    Rule("ellipsis_line_ratio", high=0.3),
)


_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1


def covered(places: Column) -> Column:
    """Words inside three-word windows that start at the given places (ascending)."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        places,
        start,
        lambda acc, i: F.struct(
            (acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")
        ),
        lambda acc: acc["n"],
    )


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more, first ones included.

    A window is one long: hash above, place below. Sorted, equal windows stand side by side;
    the words themselves are compared, and a row in which two windows share a hash by chance
    (or with more words than a place can number) is counted by sorting the words.
    """

    def window(i: Column) -> Column:
        hashed = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("bigint"))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_PLACE)).cast("int")

    def by_chance(x: Column, y: Column) -> Column:
        a, b = place(x), place(y)
        parts = [F.get(words, a + k) != F.get(words, b + k) for k in range(3)]
        return parts[0] | parts[1] | parts[2]

    def count(ordered: Column) -> Column:
        # Where a window and the next one share their hash.
        pairs = F.filter(
            range_of(F.size(ordered) - 1),
            lambda k: F.get(ordered, k).bitwiseXOR(F.get(ordered, k + 1)).between(0, _PLACE),
        )

        def joined(pairs: Column) -> Column:
            both = F.array_union(
                F.transform(pairs, lambda k: place(F.get(ordered, k))),
                F.transform(pairs, lambda k: place(F.get(ordered, k + 1))),
            )
            chance = F.exists(
                pairs, lambda k: by_chance(F.get(ordered, k), F.get(ordered, k + 1))
            )
            return F.when(~chance, covered(F.sort_array(both))).otherwise(
                repeat_words_by_text(words)
            )

        return let(pairs, joined)

    ordered = F.sort_array(F.transform(range_of(F.size(words) - 2), window))
    return F.when(F.size(words) <= _PLACE, let(ordered, count)).otherwise(
        repeat_words_by_text(words)
    )


def repeat_words_by_text(words: Column) -> Column:
    """The same count by sorting the windows as text; the join by spaces is one to one."""
    windows = F.transform(
        range_of(F.size(words) - 2),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"),
            i.alias("i"),
        ),
    )

    def repeated(ordered: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["g"] == x["g"], F.lit(False))

        return F.filter(ordered, lambda x, k: same(x, k + 1) | same(x, k - 1))

    places = F.transform(let(F.sort_array(windows), repeated), lambda x: x["i"])
    return covered(F.sort_array(places))


def measures(text: Column) -> Column:
    """Struct of all measures that rules can name."""
    text = whole(text)
    spoken = F.filter(F.split(text, "\n"), lambda line: line.rlike(rf"[^\x20\x09-\x0D]"))

    def count(array: Column, test) -> Column:
        return F.size(F.filter(array, test)).cast("bigint")

    def ratio(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(F.lit(0.0))

    def counts(x: Column) -> Column:
        words, lines = x["words"], x["lines"]
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            repeat_words(words).cast("bigint").alias("n_repeat_words"),
            count(words, lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
            count(lines, lambda s: s.rlike(rf"^{SPACE}*[-*•]")).alias("n_bullet_lines"),
            count(lines, lambda s: s.rlike(rf"(\.\.\.|…){SPACE}*$")).alias("n_ellipsis_lines"),
        )

    def with_ratios(c: Column) -> Column:
        names = (
            "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words "
            "n_bullet_lines n_ellipsis_lines"
        ).split()
        return F.struct(
            *[c[name].alias(name) for name in names],
            ratio(c["word_chars"], c["n_words"]).alias("mean_word_chars"),
            ratio(c["n_symbols"], c["n_words"]).alias("symbol_ratio"),
            ratio(c["n_repeat_words"], c["n_words"]).alias("repeat_word_ratio"),
            ratio(c["n_stop_words"], c["n_words"]).alias("stop_word_ratio"),
            ratio(c["n_dup_lines"], c["n_lines"]).alias("dup_line_ratio"),
            ratio(c["n_bullet_lines"], c["n_lines"]).alias("bullet_line_ratio"),
            ratio(c["n_ellipsis_lines"], c["n_lines"]).alias("ellipsis_line_ratio"),
        )

    parts = F.struct(words_of(text).alias("words"), spoken.alias("lines"))
    return let(let(parts, counts), with_ratios)


def compile_rules(found: Column, rules: Sequence[Rule]) -> Column:
    """Names of the measures that fall outside their bounds, in the order of the table."""

    def broken(rule: Rule) -> Column:
        value = found[rule.measure]
        test = F.lit(False)
        if rule.low is not None:
            test = test | (value < rule.low)
        if rule.high is not None:
            test = test | (value > rule.high)
        return F.when(test, F.lit(rule.measure))

    return F.array_compact(F.array(*[broken(rule) for rule in rules]))


@keeps_columns
def with_quality(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE_RULES,
    text: str = "text",
    result: str = "quality",
) -> DataFrame:
    """Adds `result`: the measures, `broken` (names of failed rules), `base_failed` and `kept`."""
    judged = let(
        measures(F.col(text)),
        lambda m: F.struct(
            m.alias("measures"),
            compile_rules(m, base).alias("base_broken"),
            compile_rules(m, rules).alias("broken"),
        ),
    )
    return df.withColumn(
        result,
        let(
            judged,
            lambda j: F.struct(
                j["measures"].alias("measures"),
                F.concat(j["base_broken"], j["broken"]).alias("broken"),
                (F.size(j["base_broken"]) > 0).alias("base_failed"),
                (F.size(j["base_broken"]) + F.size(j["broken"]) == 0).alias("kept"),
            ),
        ),
    )
