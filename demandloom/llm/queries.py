"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, hosts, jaccard, mixing, prefix_trie, quality, secrets, toxicity, winnowing
from . import pages as site_pages
from .common import fold
from .packing import pack
from .suffix_tree import Model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

URL_RULES = (
    hosts.Rule("org/", "allow"),
    hosts.Rule("example.org/es/", "block"),
    hosts.Rule("example.org/en/1", "block"),
    hosts.Rule("com/fr/", "allow"),
    hosts.Rule("com/de/", "block"),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def toxicity_labels(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their label, without the held-out fold."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return docs.select("doc_id", "text").join(labels.where(fold("doc_id", 5) != 0), "doc_id")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learned outside the held-out fold."""
    docs = documents(spark, sf_dir)
    grammar = toxicity.fit(toxicity_labels(docs, sf_dir))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.rate(docs, grammar).select("doc_id", held_out, "score", "predicted")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text."""
    docs = documents(spark, sf_dir)
    return secrets.find(docs, secrets.fit(docs))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    return mixing.mix(documents(spark, sf_dir))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text and whether the rules keep it."""
    return quality.judge(documents(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@query
def op5_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page by rule or by the reputation of its host."""
    judged = hosts.judge(pages(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of five-word shingles."""
    return jaccard.join(documents(spark, sf_dir))


@query
def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text, learned outside the held-out fold."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    model = Model(docs.where(~held_out)).without_levels()
    return model.score(docs).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    return winnowing.compare_with_next(documents(spark, sf_dir))


@query
def op9_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return site_pages.extract(pages(spark, sf_dir))


@query
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(documents(spark, sf_dir), TOKENIZER)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns))).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as hashes."""
    coded = bpe.code(documents(spark, sf_dir), WORD_TOKENIZER)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's cluster after three rounds from 16 vectors."""
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
