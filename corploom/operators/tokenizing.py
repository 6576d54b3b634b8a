"""Tokenize and detokenize corpora with a vocabulary table or any Arrow/pandas UDF."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions.batches import small_batches
from corploom.functions.longest_match import LongestMatch, TokenBytes
from corploom.functions.packed_ids import pack_ids, packed_array, packed_ids
from corploom.sources.vocabulary import MAX_VOCABULARY_BYTES, decoding_table, encoding_table

Tokenizer = Callable[[Column], Column]


class VocabularyTokenizer:
    """Column functions for one vocabulary: text -> array<int>, and text -> packed ids.

    A list field gives array<array<int>> by `parts`, or the packed ids of all parts in order.
    `max_bytes` bounds the vocabulary, which every worker holds.
    """

    def __init__(self, vocab: DataFrame, max_bytes: int = MAX_VOCABULARY_BYTES):
        small_batches(vocab.sparkSession)
        self.table = encoding_table(vocab, max_bytes)
        matcher = vocab.sparkSession.sparkContext.broadcast(LongestMatch(self.table))

        def inner(lists: pa.Array) -> tuple[pa.Array, pa.Array]:
            first, last = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            return lists.values.slice(first, last - first), pc.subtract(lists.offsets, first)

        def validity(values: pa.Array):
            return values.is_valid().buffers()[1] if values.null_count else None

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def tokenize(texts: pa.Array) -> pa.Array:
            return matcher.value(texts)

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def tokenize_parts(lists: pa.Array) -> pa.Array:
            texts, ends = inner(lists)
            mask = lists.is_null() if lists.null_count else None
            return pa.ListArray.from_arrays(ends, matcher.value(texts), mask=mask)

        @F.arrow_udf(T.BinaryType())
        def tokenize_packed(texts: pa.Array) -> pa.Array:
            return packed_array(*matcher.value.ids_and_ends(texts), validity(texts))

        @F.arrow_udf(T.BinaryType())
        def tokenize_parts_packed(lists: pa.Array) -> pa.Array:
            texts, ends = inner(lists)
            ids, text_ends = matcher.value.ids_and_ends(texts)
            return packed_array(ids, text_ends[ends.to_numpy()], validity(lists))

        self._tokenize, self.parts = tokenize, tokenize_parts
        self._packed, self._packed_parts = tokenize_packed, tokenize_parts_packed

    def __call__(self, text: Column) -> Column:
        return self._tokenize(text)

    def packed(self, text: Column, is_list: bool = False) -> Column:
        return self._packed_parts(text) if is_list else self._packed(text)


def is_list_field(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.ArrayType)


def packed_tokens(df: DataFrame, tokenizer: Tokenizer, key: str) -> Column:
    """Packed ids of field `key`, the parts of a list field joined in order."""
    field, is_list = F.col(key), is_list_field(df, key)
    if isinstance(tokenizer, VocabularyTokenizer):
        return tokenizer.packed(field, is_list)
    return pack_ids(F.flatten(tokenizer(field)) if is_list else tokenizer(field))


def tokenize_corpus(
    df: DataFrame,
    vocab: DataFrame | None = None,
    fn: Tokenizer | None = None,
    key: str = "text",
    out: str = "input_ids",
) -> DataFrame:
    """Add token ids of field `key`. A list field gives one id list per part, in order.

    Give either a vocabulary table (greedy longest match on UTF-8 bytes) or `fn`, a function
    from column to column such as a `pandas_udf("array<int>")`.
    """
    if (vocab is None) == (fn is None):
        raise ValueError("give either vocab or fn")
    if vocab is not None:
        fn = VocabularyTokenizer(vocab)
        fn = fn.parts if is_list_field(df, key) else fn
    return df.withColumn(out, fn(F.col(key)))


def with_masks(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """`token_type_ids` of zeros and `attention_mask` of ones, as long as the ids."""
    size = F.size(ids)
    return df.withColumns(
        {
            "token_type_ids": F.array_repeat(F.lit(0).cast("tinyint"), size),
            "attention_mask": F.array_repeat(F.lit(1).cast("tinyint"), size),
        }
    )


def token_totals(df: DataFrame) -> DataFrame:
    """One row: how many rows and tokens (`n_tokens` if there is one, else the ids are counted)."""
    count = F.col("n_tokens") if "n_tokens" in df.columns else F.size("input_ids")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(count.cast("bigint")), F.lit(0).cast("bigint")).alias("n_tokens"),
    )


def detokenize_corpus(
    df: DataFrame, vocab: DataFrame, ids: str = "input_ids", out: str = "text", as_text: bool = True
) -> DataFrame:
    """Joined token bytes of each row, as strict UTF-8 text or as binary. Unknown ids fail."""
    small_batches(df.sparkSession)
    tokens = df.sparkSession.sparkContext.broadcast(TokenBytes(decoding_table(vocab)))

    @F.arrow_udf("string" if as_text else "binary")
    def detokenize(id_lists: pa.Array) -> pa.Array:
        joined = tokens.value(id_lists)
        return joined.cast(pa.large_string()).cast(pa.string()) if as_text else joined.cast(pa.binary())

    return df.withColumn(out, detokenize(F.col(ids)))


def detokenize_chunks(rows: DataFrame, vocab: DataFrame, out: str = "text") -> DataFrame:
    """Text of packed rows (`split_id, chunk_id, n_real, tokens`), which may end inside a character.
    `rows` is a table, such as a stage, as it is read twice.

    A character belongs to the row that holds its first byte. The bytes of it that begin the next rows,
    three at most, are handed back to that row by position: only they move to be matched. The texts of a
    split, one after the other, are its documents. Padding has no text. Bytes without a first
    byte before them in their split, and unfinished characters at its end, fail as they do in
    `detokenize_corpus`.
    """
    small_batches(rows.sparkSession)
    tokens = rows.sparkSession.sparkContext.broadcast(TokenBytes(decoding_table(vocab)))

    @F.arrow_udf("own binary, lead binary")
    def parted(packed: pa.Array, n_real: pa.Array, first: pa.Array) -> pa.Array:
        ids, ends = packed_ids(packed)
        starts, sizes = ends[:-1], n_real.to_numpy()
        # Padding is at the end of a row: ids are taken up to it.
        kept = np.arange(len(ids)) - np.repeat(starts, np.diff(ends)) < np.repeat(sizes, np.diff(ends))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[kept], pa.int32()))
        own, lead = [], []
        for raw, begins in zip(tokens.value(lists).to_pylist(), first.to_pylist()):
            cut = 0
            while not begins and cut < min(len(raw), 3) and raw[cut] & 0xC0 == 0x80:
                cut += 1
            own.append(raw[cut:])
            lead.append(raw[:cut])
        return pa.StructArray.from_arrays([pa.array(own, pa.binary()), pa.array(lead, pa.binary())], ["own", "lead"])

    @F.arrow_udf("string")
    def decoded(raw: pa.Array) -> pa.Array:
        return raw.cast(pa.string())

    bytes_of = parted("tokens", "n_real", F.col("chunk_id") == 0)
    parts = rows.withColumn("_part", bytes_of)
    empty = F.octet_length("_part.own") == 0
    handed = rows.select("split_id", "chunk_id", bytes_of.alias("_part")).where(F.octet_length("_part.lead") > 0)
    handed = handed.select(
        "split_id", "chunk_id", F.col("_part.lead").alias("lead"), empty.alias("all"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("back")
    )
    # A row gets the bytes of the rows after it up to the first that has a character of its own.
    after = F.sort_array(F.collect_list(F.struct("back", "lead", "all")))
    given = handed.groupBy("split_id", (F.col("chunk_id") - F.col("back")).alias("chunk_id")).agg(after.alias("_after"))
    nothing = F.lit(b"")

    def take(state: Column, row: Column) -> Column:
        wanted = row["back"] == state["next"]
        return F.struct(
            F.when(wanted, F.concat(state["held"], row["lead"])).otherwise(state["held"]).alias("held"),
            F.when(wanted & row["all"], state["next"] + 1).when(wanted, F.lit(-1)).otherwise(state["next"]).alias("next"),
        )

    start = F.struct(nothing.alias("held"), F.lit(1).alias("next"))
    more = F.coalesce(F.aggregate("_after", start, take, lambda state: state["held"]), nothing)
    joined = parts.join(given, ["split_id", "chunk_id"], "left")
    whole = F.when(empty, nothing).otherwise(F.concat("_part.own", more))
    return joined.withColumn(out, decoded(whole)).drop("_part", "_after")
