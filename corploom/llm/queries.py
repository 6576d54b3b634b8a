"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm.batches import small_batches
from corploom.llm.bpe import decode, encode
from corploom.llm.decontamination import with_leaks
from corploom.llm.licenses import with_licenses
from corploom.llm.near_duplicates import near_duplicate_classes
from corploom.llm.packing import pack_documents
from corploom.llm.pii import KINDS as PII_KINDS
from corploom.llm.pii import fit_model, with_pii
from corploom.llm.prefix_trie import prefix_trie, rebuilt_paths
from corploom.llm.quality import with_quality
from corploom.llm.repeats import without_repeats
from corploom.llm.secrets import BASE_RULES as BASE_SECRETS
from corploom.llm.secrets import RULES as SECRETS
from corploom.llm.secrets import scan_secrets
from corploom.llm.sharding import interleave
from corploom.llm.spelling import spelling_variants
from corploom.llm.text import join_spans, whole
from corploom.llm.urls import judge_urls
from corploom.staging import stage

SHARDS = 16

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_quality(docs).select(
        "doc_id",
        *[
            F.col(f"quality.measures.{name}").alias(name)
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
    )


@query
def op2_stratified_shards(spark, sf_dir):
    """Digests stand in for the texts, which need not move to be placed."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "text",
        (F.octet_length(whole(F.col("text"))).cast("bigint") + 1).alias("size"),
        F.crc32(whole(F.col("text"))).alias("text_crc32"),
    )
    placed = interleave(docs, SHARDS, keep=["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_bpe_chunks(spark, sf_dir):
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs, path).drop("text"), path)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op10_trigram_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs).drop("text")
    base = [rule.kind for rule in BASE_SECRETS]

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(join_spans(of(*base), base), 256).alias("base_sha256"),
        join_spans(F.col("secrets"), [rule.kind for rule in SECRETS]).alias("spans"),
    )


@query
def op1_string_tiling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = with_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.explode("leaks").alias("leak")
    )
    return leaks.select(
        "doc_id",
        F.col("leak.item").alias("item_id"),
        F.col("leak.n_words").alias("n_words"),
        F.col("leak.n_matched").alias("n_matched"),
        F.size("leak.tiles").alias("n_tiles"),
        F.col("leak.coverage").alias("coverage"),
    )


@query
def op8_url_rules(spark, sf_dir):
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    base = F.col("layer") > 0
    return judged.select(
        "page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"), "verdict"
    )


@query
def op9_license_diagonals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("licenses")
    places = found["places"]
    return with_licenses(docs).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"),
        F.array_max(places).cast("bigint").alias("last_word"),
        F.array_join(found["base_labels"], ",").alias("base_labels"),
        F.array_join(found["labels"], ",").alias("labels"),
        found["score"].alias("score"),
    )


@query
def op7_boosted_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_pii(docs, fit_model(docs)).drop("text")

    def strict(*kinds):
        return F.filter("pii", lambda s: s["strict"] & s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(strict(kind)).cast("bigint").alias(f"n_{kind}") for kind in PII_KINDS],
        F.sha2(join_spans(strict(*PII_KINDS), PII_KINDS), 256).alias("base_sha256"),
        join_spans(F.col("pii"), PII_KINDS).alias("spans"),
    )


@query
def op6_dart_minhash(spark, sf_dir):
    """One row per document with its class: the smallest id in it, and the class's size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classed = near_duplicate_classes(docs).select("doc_id", "text_key", "class_key")
    classes = classed.groupBy("class_key").agg(
        F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("n_docs"),
        F.count_distinct("text_key").alias("n_texts"),
    )
    # As a table, so that the join below reads two plain exchanges and large classes are split.
    classes = stage(classes, "classes")
    return classed.join(classes, "class_key").select("doc_id", "class_id", "n_docs", "n_texts")


@query
def op3_fm_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt_paths(table(spark, sf_dir, "conversations")))


@query
def op12_ffd_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op13_spelling_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(docs)
