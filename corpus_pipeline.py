"""From documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes below the shared
folder and reads again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import jaccard, mixing, secrets, toxicity
from demandloom.llm.common import quoted, written
from demandloom.llm.packing import pack
from demandloom.llm.queries import TOKENIZER, documents, toxicity_labels


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below one half; rows without a text stay, repeated rows each by itself."""
    grammar = toxicity.fit(toxicity_labels(docs, sf_dir))
    return docs.where(toxicity.score(F.col("text"), grammar) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar shingle sets, see `jaccard.one_of_each`."""
    return jaccard.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced and the number of characters counted again."""
    clean = docs.withColumn("text", secrets.redacted(F.col("text"), secrets.fit(docs)))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each row as often as it is taken, 0 to 3 times; an empty table stays empty."""
    whole = F.struct(*map(quoted, docs.columns)).alias("_row")
    mixed = mixing.mix(docs.select("doc_id", "text", "source", whole), keep=["_row"]).where("copies > 0")
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.select("_row", F.explode(times)).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 2048 tokens; an empty table gives none."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL expresses neither the learned models nor the tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
