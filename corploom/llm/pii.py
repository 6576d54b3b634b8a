"""Personal data by candidates and gradient boosting.

Generators propose overlapping spans with high recall: everything shaped like an address, a
number in groups, or an account. Boosted trees score each candidate on its format and on the text
around it. Spans of the strict rules always stand; candidates are added, best first, where their
score reaches the threshold of their kind and they overlap no span taken before.

The trees are fitted on all distinct candidates of the documents. Labels are the strict rules' verdicts; each positive also enters
in spellings that the rules do not know (no plus sign, spelled-out signs, other separators) and
each negative in the same ones, so that the model reads digits, groups and context rather than
the rules' pattern. Dates, decimals, sums and ids in the same contexts (`decoys`) are negatives
too. Thresholds are set on held-out candidates as the lowest score that keeps
`PRECISION`; a kind with no held-out positives adds nothing.

Features are whole numbers. Candidates with equal features are counted, and the counts are staged; each
level of a tree adds up gradients by node, feature and value over all of them, and thresholds go by counts
per kind and score. The driver sees those sums only, whose number does not grow with the
documents. Scoring is local to a row. Null and empty texts have no
spans, equal rows get equal spans, and columns named as the results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm.batches import slices
from corploom.llm.boosting import Boosted, boost, level_sums
from corploom.llm.text import keeps_columns
from corploom.staging import stage

PRECISION = 0.99
KINDS = ("email", "ip", "card", "phone")
_AROUND = 32  # characters of context on either side
_BATCH_BYTES = 4 << 20
_FEATURE = np.uint16  # whole numbers of some hundreds at most: patterns bound the length of candidates

# The strict rules, leftmost and non-overlapping within a kind.
_STRICT = {
    # From the sign on; see `_emails`.
    "email": re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    # A match starts with a run of digits: inside the run, what follows it is the same.
    "ip": re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# High-recall generators by the kind that they propose.
_WIDE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}[\x20]?(?:@|\(at\)|\[at\]|[\x20]at[\x20])[\x20]?[A-Za-z0-9-]{1,63}"
        r"(?:[\x20]?(?:\.|\(dot\)|\[dot\]|[\x20]dot[\x20])[\x20]?[A-Za-z0-9-]{2,63}){1,8}"
    ),
    "ip": re.compile(
        r"(?<![0-9A-Za-z])(?:[0-9]{1,3}(?:[\x20]?(?:\.|\[\.\]|-)[\x20]?[0-9]{1,3}){3}"
        r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){4,7})(?![0-9A-Za-z])"
    ),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(
        r"(?<![0-9A-Za-z])(?:\+|00|\()?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])"
    ),
}
_HINTS = {
    "email": re.compile(r"(?i)e-?mail|contact|write|reach|address|courriel|correo"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address|login|client"),
    "card": re.compile(r"(?i)card|visa|credit|debit|account|karte|tarjeta|carte"),
    "phone": re.compile(r"(?i)phone|\btel\b|call|mobile|fax|cell|whatsapp|telefon|téléphone"),
}
_MAY_HOLD = re.compile(r"[0-9@]|[(\[]at[)\]]|\x20at\x20")


@dataclass(frozen=True)
class Model:
    trees: Boosted
    bounds: tuple[float, ...]  # by kind


def luhn(digits: str) -> bool:
    """Every second digit from the right counts twice, less 9 beyond 9; sums end in 0."""
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    back = [int(d) for d in reversed(digits)]
    return (sum(back[::2]) + sum(twice[d] for d in back[1::2])) % 10 == 0


def strict_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the strict rules; matches that fail a test are passed over."""
    spans = _emails(text)
    for kind in ("ip", "card", "phone"):
        for match in _STRICT[kind].finditer(text):
            if _passes(kind, match[0]):
                spans.append((*match.span(), kind))
    return spans


_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[tuple[int, int, str]]:
    """Name, sign and host, found from the sign: a name is the run of its characters before the
    sign, after the match before. Looking for names first would read long words again and again."""
    spans, last = [], 0
    for host in _STRICT["email"].finditer(text):
        start = host.start()
        while start > last and text[start - 1] in _NAME:
            start -= 1
        if start < host.start():
            spans.append((start, host.end(), "email"))
            last = host.end()
    return spans


def _passes(kind: str, found: str) -> bool:
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """Overlapping proposals (start, end, kind)."""
    if _MAY_HOLD.search(text):
        for kind, pattern in _WIDE.items():
            for match in pattern.finditer(text):
                yield (*match.span(), kind)


def features(kind: str, found: str, before: str, after: str) -> list[float]:
    """Format of a candidate and what stands around it."""
    digits = re.sub(r"[^0-9]", "", found)
    groups = re.findall(r"[0-9]+", found)
    joints = re.findall(r"[^0-9A-Za-z]+", found)
    octets = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    labels = re.findall(r"[A-Za-z0-9-]+", found)
    return [
        *[float(kind == k) for k in KINDS],
        len(found),
        len(digits),
        sum(c.isalpha() for c in found),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(joints),
        len(set(joints)),
        float(luhn(digits) and 13 <= len(digits) <= 19),
        float(octets),
        float(10 <= len(digits) <= 15),
        float(found.startswith("+")),
        float("(" in found),
        float(found.startswith(("00", "("))),
        len(groups[0]) if groups else 0,
        len(groups[-1]) if groups else 0,
        float(bool(re.match(r"(?:19|20)[0-9]{2}(?![0-9])|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)", found))),
        found.count("."),
        found.count("-"),
        found.count("/"),
        float("@" in found or "at)" in found or "at]" in found),
        len(labels[-1]) if labels else 0,
        len(set(digits)),
        float(bool(re.match(r"[0-9A-Za-z_@.]", after[:1]))),
        float(bool(re.match(r"[0-9A-Za-z_@.$€#]", before[-1:]))),
        float(bool(_HINTS[kind].search(before))),
        sum(c.isdigit() for c in before + after),
    ]


def spellings(kind: str, found: str) -> list[str]:
    """Other ways to write the same thing."""
    if kind == "email":
        name, _, host = found.partition("@")
        return [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}"]
    if kind == "ip":
        return [found.replace(".", "[.]")]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", found)
        return [sign.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sign in "./"]
    if kind == "phone":
        bare = found.lstrip("+")
        local = re.sub(r"^[0-9]{1,3}[\x20.-]+", "", bare)
        return [local, f"00{bare}", re.sub(r"[^0-9]+", ".", found).strip("."), re.sub(r"[().-]", " ", bare)]
    return []


def decoys(digest: str) -> list[tuple[str, str]]:
    """(kind, text) of numbers that are nobody's: dates, times, decimals, sums, versions, ids."""
    d = f"{int(digest[:16], 16):020d}"[-18:]
    year, month, day = 1950 + int(d[:2]), 1 + int(d[2:4]) % 12, 1 + int(d[4:6]) % 28
    return [
        ("phone", f"{year}-{month:02d}-{day:02d}"),
        ("phone", f"{year}-{month:02d}-{day:02d} {int(d[6:8]) % 24:02d}"),
        ("phone", f"{day:02d}.{month:02d}.{year}"),
        ("phone", f"{day:02d}/{month:02d}/{year} {int(d[6:8]) % 24}"),
        ("phone", f"{d[0]}.{d[1:9]}"),
        ("phone", f"{d[:3]}.{d[3:7]}"),
        ("phone", f"{year}-{year + 1 + int(d[8])}"),
        ("phone", d[: 7 + int(d[9]) % 8]),
        ("phone", f"{d[:2]} {d[2:5]} {d[5:8]}"),
        ("phone", f"{int(d[:2])}-{int(d[2:4])} {int(d[4:7])}-{int(d[7:10])}"),
        ("card", d[: 13 + int(d[10]) % 4]),
        ("card", f"{year}-{month:02d}-{day:02d} {d[4:6]} {d[6:8]} {d[8:10]}"),
        ("ip", f"{int(d[:3])}-{int(d[3:6])}-{int(d[6:8])}-{int(d[8:10])}"),
        ("ip", f"{d[:2]}:{d[2:4]}:{d[4:6]}:{d[6:8]}:{d[8:10]}"),
        ("email", f"look at {d[:2]}.{d[2:4]}"),
        ("email", f"seen at home. {d[:3]}"),
    ]


def _examples(text: str) -> Iterator[dict]:
    """Candidates with their context and the strict rules' verdict."""
    if not _MAY_HOLD.search(text):
        return
    strict = strict_spans(text)
    for start, end, kind in candidates(text):
        known = any(s < end and start < e and k == kind for s, e, k in strict)
        if not known and any(s < end and start < e for s, e, _ in strict):
            continue  # part of something else that is personal
        row = {
            "kind": kind,
            "found": text[start:end],
            "before": text[max(0, start - _AROUND) : start],
            "after": text[end : end + _AROUND],
            "label": int(known),
        }
        digest = hashlib.md5(repr(sorted(row.items())).encode()).hexdigest()
        yield row | {"digest": digest}


_EXAMPLE = "kind string, found string, before string, after string, label int, digest string"


_COUNTED = "features binary, label int, held boolean, n bigint"
_SUMS = "node bigint, feature bigint, value double, gradient bigint, weight bigint"
_SCORES = "kind bigint, score double, n bigint, hits bigint"
_BLOCK_ROWS = 1 << 16


def fit_model(df: DataFrame, text: str = "text") -> Model:
    """Fits on all distinct candidates."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, _BATCH_BYTES):
                rows = [r for t in part.column(0).to_pylist() if t for r in _examples(t)]
                names = _names(_EXAMPLE)
                kinds = [pa.int32() if n == "label" else pa.string() for n in names]
                columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    found = df.select(F.col(text)).mapInArrow(run, _EXAMPLE).dropDuplicates(["digest"])
    counted = found.mapInArrow(_counted, _COUNTED).groupBy("features", "label", "held").agg(F.sum("n").alias("n"))
    return _fit(stage(counted, "candidates"))


def _counted(batches):
    """Candidates in all spellings, with decoys, as features and how often they occur."""
    for batch in batches:
        counts: Counter = Counter()
        for row in batch.to_pylist():
            held = int(row["digest"][:2], 16) < 77  # three in ten
            forms = [(row["kind"], form, row["label"]) for form in (row["found"], *spellings(row["kind"], row["found"]))]
            forms += [(kind, form, 0) for kind, form in decoys(row["digest"])]
            for kind, form, label in forms:
                own = np.array(features(kind, form, row["before"], row["after"]), _FEATURE).tobytes()
                counts[own, label, held] += 1
        columns = [list(column) for column in zip(*counts)] or [[], [], []]
        kinds = (pa.binary(), pa.int32(), pa.bool_(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip([*columns, list(counts.values())], kinds)]
        yield pa.RecordBatch.from_arrays(arrays, _names(_COUNTED))


def _blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, labels and counts of the rows of a task, `_BLOCK_ROWS` or so at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _BLOCK_ROWS:
            yield _block(held)
            held, rows = [], 0
    if rows:
        yield _block(held)


def _block(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = b"".join(value for batch in batches for value in batch.column("features").to_pylist())
    rows = sum(batch.num_rows for batch in batches)
    label, n = (np.concatenate([batch.column(name).to_numpy() for batch in batches]) for name in ("label", "n"))
    return np.frombuffer(raw, _FEATURE).reshape(rows, -1), label, n


def _fit(counted: DataFrame) -> Model:
    fitted, held = counted.where("not held"), counted.where("held")

    def ask(*tree):
        def run(batches):
            for x, y, n in _blocks(batches):
                yield pa.RecordBatch.from_arrays([*map(pa.array, level_sums(x, y, n, *tree))], _names(_SUMS))

        added = fitted.mapInArrow(run, _SUMS).groupBy("node", "feature", "value")
        sums = added.agg(F.sum("gradient").alias("gradient"), F.sum("weight").alias("weight")).toArrow()
        sums = sums.sort_by([(name, "ascending") for name in ("node", "feature", "value")])
        return tuple(sums.column(name).to_numpy() for name in _names(_SUMS))

    total = F.coalesce(F.sum("n"), F.lit(0))
    rows, positives = fitted.agg(total, F.coalesce(F.sum(F.col("n") * F.col("label")), F.lit(0))).first()
    trees = boost(rows, positives, ask)

    def judge(batches):
        for x, y, n in _blocks(batches):
            kind = np.argmax(x[:, : len(KINDS)], axis=1)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (kind, trees.scores(x), n, n * y))], _names(_SCORES))

    judged = held.mapInArrow(judge, _SCORES).groupBy("kind", "score")
    judged = judged.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).toArrow()
    kind, *table = (judged.column(name).to_numpy() for name in _names(_SCORES))
    return Model(trees, tuple(_bound(*(column[kind == k] for column in table)) for k in range(len(KINDS))))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _bound(scores: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float:
    """Lowest score from which on the precision is high enough; infinite if there is none. Each score
    is there once, with its candidates and how many of them are right."""
    order = np.argsort(-scores)
    hits, n = np.cumsum(hits[order]), np.cumsum(n[order])
    good = np.flatnonzero((hits >= PRECISION * n) & (hits >= 5))
    return float(scores[order][good[-1]]) if len(good) else np.inf


def find_spans(text: str, model: Model) -> list[tuple[int, int, str, bool]]:
    """Spans (start, end, kind, strict) by start, then kind."""
    if not _MAY_HOLD.search(text):
        return []
    taken = strict_spans(text)
    spans = [(*span, True) for span in taken]
    more = [c for c in candidates(text) if not any(s < c[1] and c[0] < e for s, e, _ in taken)]
    if more:
        x = np.array(
            [
                features(k, text[s:e], text[max(0, s - _AROUND) : s], text[e : e + _AROUND])
                for s, e, k in more
            ],
            float,
        )
        scores = model.trees.scores(x)
        bounds = np.array([model.bounds[KINDS.index(k)] for _, _, k in more])
        for n in np.argsort(-scores, kind="stable"):
            start, end, kind = more[n]
            if scores[n] >= bounds[n] and not any(s < end and start < e for s, e, _ in taken):
                taken.append(more[n])
                spans.append((start, end, kind, False))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


_SPAN = pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("strict", pa.bool_())]
)


@keeps_columns
def with_pii(
    df: DataFrame, model: Model, text: str = "text", result: str = "pii"
) -> DataFrame:
    """Adds `result`: an array of spans (start, end, kind, strict) in code points, by start."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, _BATCH_BYTES):
                spans = [
                    [dict(zip(("start", "end", "kind", "strict"), s)) for s in find_spans(t or "", model)]
                    for t in part.column(text).to_pylist()
                ]
                yield part.append_column(result, pa.array(spans, pa.list_(_SPAN)))

    source = df.drop(result)
    kind = T.ArrayType(
        T.StructType.fromDDL("start int, end int, kind string, strict boolean")
    )
    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(result, kind)]))


@keeps_columns
def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replaces each span by its kind in brackets; of spans that overlap, the earlier stands.
    Null texts stay null."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, span):
        gap = F.substring(F.col(text), acc["at"] + 1, span["start"] - acc["at"])
        said = F.concat(acc["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        late = span["start"] >= acc["at"]
        return F.struct(
            F.when(late, span["end"]).otherwise(F.greatest(acc["at"], span["end"])).alias("at"),
            F.when(late, said).otherwise(acc["out"]).alias("out"),
        )

    clean = F.aggregate(
        F.col(spans),
        start,
        step,
        lambda acc: F.concat(
            acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text)))
        ),
    )
    return df.withColumn(text, F.when(F.size(F.col(spans)) > 0, clean).otherwise(F.col(text)))
