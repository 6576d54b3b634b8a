"""Column helpers shared by the operators of this subpackage. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"

SPANS = "array<struct<start:int,end:int,kind:string,part:string>>"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def keeps_columns(operate: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets the rows of the first argument have columns that begin with `_`, as the helper columns of
    the operators do: those go by other names meanwhile. Columns that an argument names keep theirs."""

    @wraps(operate)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        given = [v if isinstance(v, (list, tuple)) else [v] for v in (*args, *options.values())]
        named = {value for values in given for value in values if isinstance(value, str)}
        names: dict[str, str] = {}
        for column in df.columns:
            if column.startswith("_") and column not in named:
                free = f"own{column}"
                while free in df.columns or free in names.values():
                    free = f"own{free}"
                names[column] = free
        result = operate(df.withColumnsRenamed(names), *args, **options)
        return result.withColumnsRenamed({free: column for column, free in names.items()})

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: Column) -> Column:
    """The text itself, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    return F.filter(F.split(whole(text), f"{SPACE}+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def range_of(n: Column) -> Column:
    """Array 0..n-1, empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(
        F.array().cast("array<int>")
    )


def spans_of(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, kind, part) in code points.

    Gaps and matches alternate, so starts are running sums of their lengths. `part` is the text
    of `group`. Rows without a match stop at the first test.
    """

    def collect(gaps: Column, found: Column, parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(gaps, i))
            end = begin + F.length(F.get(found, i))
            span = F.struct(
                begin.alias("start"),
                end.alias("end"),
                F.lit(kind).alias("kind"),
                F.get(parts, i).alias("part"),
            )
            return F.struct(
                end.alias("at"), F.concat(acc["spans"], F.array(span)).cast(SPANS).alias("spans")
            )

        return F.aggregate(range_of(F.size(found)), start, step, lambda acc: acc["spans"])

    expr = F.lit(pattern)
    found = F.regexp_extract_all(text, expr, F.lit(0))
    parts = found if group == 0 else F.regexp_extract_all(text, expr, F.lit(group))
    spans = let(
        F.struct(F.split(text, pattern).alias("g"), found.alias("m"), parts.alias("p")),
        lambda x: collect(x["g"], x["m"], x["p"]),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def join_spans(spans: Column, kinds: Sequence[str]) -> Column:
    """`kind:start:end` by start, then kind in the order of `kinds`, comma-joined."""
    def ranked(s: Column) -> Column:
        rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"])
        return F.struct(s["start"], rank.alias("rank"), s["end"], s["kind"])

    ordered = F.sort_array(F.transform(spans, ranked))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
