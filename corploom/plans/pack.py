"""The whole packing chain: prepare sources, tokenize, mix, re-cut."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corploom.functions.batches import small_batches
from corploom.functions.keys import with_content_keys
from corploom.functions.packed_ids import id_count, line_bytes
from corploom.operators import mixing
from corploom.operators.counting import drop_fingerprint, save_fingerprint, stage_reusable
from corploom.operators.lengths import MIN_ROWS, MIN_SUBCHUNK
from corploom.operators.rechunking import CHUNK_SIZE, SPLITS, rechunk, with_ids
from corploom.operators.tokenizing import Tokenizer, VocabularyTokenizer, packed_tokens
from corploom.sinks.arrow_shards import write_arrow_shards
from corploom.sinks.files import refuse_filled
from corploom.sinks.json_lines import COLUMNS
from corploom.sinks.token_rows import ordered_rows, train_test
from corploom.sinks.token_store import write_token_store
from corploom.sources.datasets import keyed_rows
from corploom.staging import stage, write_stage

MODES = ("shuffle", "concat", "dist_by_length")
LINE_LENGTH = "len"


@dataclass(frozen=True)
class Source:
    """A named table of texts. `row_key` must be unique; without one, keys come from the content."""

    name: str
    rows: DataFrame
    key: str = "text"
    row_key: str | Column | None = None


def source_rows(source: Source, metrics: Observation | None = None) -> DataFrame:
    """`row_key` and the field to tokenize, of the rows with text. `metrics` gets the counts of
    `keyed_rows`: rows, rows without text, rows without the field."""
    rows = keyed_rows(source.rows, source.key, metrics=metrics)
    if source.row_key is None:
        return with_content_keys(rows, [source.key])
    given = F.col(source.row_key) if isinstance(source.row_key, str) else source.row_key
    return rows.select(given.cast("string").alias("row_key"), F.col(source.key))


def prepare_source(
    source: Source,
    tokenizer: Tokenizer,
    partitions: int | None = None,
    metrics: Observation | None = None,
) -> DataFrame:
    """`row_key, tokens` (packed ids) of the rows with text; the parts of a list field are joined in order.

    `partitions` spreads the texts by key before tokenizing, for files that do not split well
    (gzip, one large row group). Files that do split need no such shuffle.
    """
    rows = source_rows(source, metrics)
    if partitions:
        rows = rows.repartition(partitions, "row_key")
    return rows.select("row_key", packed_tokens(rows, tokenizer, source.key).alias("tokens"))


def reused_source(
    source: Source,
    tokenizer: Tokenizer,
    path: str,
    spec: str,
    partitions: int | None = None,
    metrics: Observation | None = None,
) -> DataFrame:
    """The tokens kept under `path` if they were made from the same rows with the same settings;
    else they are made and kept there for the next time."""
    spec = f"{source.key}:{spec}"
    rows, columns = source_rows(source, metrics), ["row_key", source.key]
    if not stage_reusable(path, rows, columns, spec):
        made = prepare_source(source, tokenizer, partitions)
        drop_fingerprint(rows.sparkSession, path)
        write_stage(made, path, "overwrite")
        save_fingerprint(path, rows, columns, spec)
    return source.rows.sparkSession.read.schema("row_key string, tokens binary").parquet(path)


def check_row_keys(tokens: DataFrame):
    """Every mode orders rows by key and some find them by it, so keys must be there and unique."""
    per_key = tokens.groupBy("source", "row_key").agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.where(F.col("row_key").isNull() | (F.col("n") > 1)).groupBy("source").agg(
        F.sum(F.when(F.col("row_key").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count_if(F.col("row_key").isNotNull()).alias("repeated"),
    )
    for name, missing, repeated in bad.collect():
        raise ValueError(
            f"source {name!r}: {missing} rows have no key and {repeated} keys repeat; "
            "leave row_key out to get keys from the content"
        )


def tokenized_stage(
    sources: Sequence[Source],
    tokenizer: Tokenizer,
    partitions: int | None = None,
    measure_lines: bool = False,
    stage_path: str | None = None,
    spec: str | None = None,
    metrics: dict[str, Observation] | None = None,
) -> DataFrame:
    """All sources, tokenized once and staged, with token counts and, on demand, JSON line sizes.

    With `stage_path`, the tokens of each source are kept in a folder of that path and used again
    by a later call for the same rows, field and tokenizer. `spec` names the settings of a
    tokenizer of one's own; a vocabulary names itself. `metrics` gets an observation per source
    with the counts of its rows and of those dropped.
    """
    if len({source.name for source in sources}) != len(sources):
        raise ValueError("source names must be unique")
    for source in sources[:1]:
        small_batches(source.rows.sparkSession)
    if stage_path is not None and spec is None:
        spec = tokenizer_spec(tokenizer)
    by_name = {}
    for source in sources:
        seen = None if metrics is None else metrics.setdefault(source.name, Observation())
        if stage_path is None:
            by_name[source.name] = prepare_source(source, tokenizer, partitions, seen)
        else:
            folder = f"{stage_path.rstrip('/')}/{source.name}"
            by_name[source.name] = reused_source(source, tokenizer, folder, spec, partitions, seen)
    tokens = mixing.concat_sources(by_name).withColumn("n_tokens", id_count("tokens"))
    staged = stage(tokens.withColumn(LINE_LENGTH, line_bytes()) if measure_lines else tokens, "tokenized")
    check_row_keys(staged)
    return staged


def tokenizer_spec(tokenizer: Tokenizer) -> str:
    """Digest of the vocabulary behind a tokenizer."""
    if not isinstance(tokenizer, VocabularyTokenizer):
        raise ValueError("give a spec that names the tokenizer, so that its stage can be told apart")
    digest = hashlib.sha256()
    for token, token_id in sorted(tokenizer.table.items()):
        digest.update(b"%d:%d:%s" % (token_id, len(token), token))
    return digest.hexdigest()


def mix(
    tokens: DataFrame,
    mode: str = "shuffle",
    inverse_shuffle: bool = False,
    force_rechunk: bool = True,
    chunk_size: int = CHUNK_SIZE,
    splits: int = SPLITS,
    min_rows: int = MIN_ROWS,
    min_subchunk: int = MIN_SUBCHUNK,
    length: str = LINE_LENGTH,
) -> DataFrame:
    """Order (`pos`) for staged tokens, then rows of `chunk_size` if `force_rechunk`; ids stay packed.

    `inverse_shuffle` with mode shuffle cuts first and shuffles the chunks. Length distribution
    never rechunks; `length` is the column to go by, JSON line size (`len`) or `n_tokens`.
    """
    if mode not in MODES:
        raise ValueError(f"mixing mode {mode!r} is not supported; choose from {MODES}")
    if mode == "dist_by_length":
        by = F.col(length)
        return mixing.mix_by_length(tokens, by, min_rows=min_rows, min_subchunk=min_subchunk)
    if mode == "shuffle" and inverse_shuffle and force_rechunk:
        return mixing.mix_inverse(tokens, size=chunk_size, splits=splits)
    ordered = mixing.mix_shuffle(tokens) if mode == "shuffle" else mixing.mix_concat(tokens)
    return rechunk(ordered, chunk_size, splits, tokens) if force_rechunk else ordered


def pack(
    sources: Sequence[Source],
    vocab: DataFrame | None = None,
    fn: Tokenizer | None = None,
    partitions: int | None = None,
    packed: bool = False,
    stage_path: str | None = None,
    spec: str | None = None,
    metrics: dict[str, Observation] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Training rows of all sources as `{"train": ..., "test": ...}`; see `mix` for the options and
    `tokenized_stage` for `stage_path`, `spec` and `metrics`.

    Ids come as `input_ids` arrays, or stay in packed `tokens`, which `export` writes faster.
    """
    if (vocab is None) == (fn is None):
        raise ValueError("give either vocab or fn")
    tokenizer = fn if fn is not None else VocabularyTokenizer(vocab)
    by_length = options.get("mode") == "dist_by_length"
    measure_lines = by_length and options.get("length", LINE_LENGTH) == LINE_LENGTH
    tokens = tokenized_stage(
        sources, tokenizer, partitions, measure_lines, stage_path, spec, metrics
    )
    rows = mix(tokens, **options)
    return train_test(rows if packed else with_ids(rows))


def export(df: DataFrame, fmt: str, path: str, **options) -> DataFrame | None:
    """Write ordered rows as `json`, `parquet`, `arrow` shards or a token `store`. `path` must be
    new or empty. Files of JSON lines are compressed if `compression` says how."""
    small_batches(df.sparkSession)
    if fmt == "json":
        refuse_filled(df.sparkSession, path)
        compression = options.pop("compression", None)
        rows = ordered_rows(df, **options).select(*COLUMNS)
        return rows.write.mode("overwrite").json(path, compression=compression)
    if fmt == "parquet":
        refuse_filled(df.sparkSession, path)
        return ordered_rows(df, **options).write.mode("overwrite").parquet(path)
    if fmt == "arrow":
        return write_arrow_shards(df, path, **options)
    if fmt == "store":
        if "n_real" in df.columns:
            raise ValueError("the token store takes whole documents: pack with force_rechunk=False")
        return write_token_store(df, path, **options)
    raise ValueError(f"unknown export format {fmt!r}")
