"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents; the last returns the pieces of packed sequences.

- language: documents without a recognised language (und) go; the automata are fitted on this corpus's labelled rows.
- simhash: one document of each near-duplicate group stays, that of the least doc_id (null if the group has no other).
- secrets: each stretch of secrets is replaced by a mask; n_chars follows.
- mixing: a document appears as often as the mix takes it whole, and once more cut after the words that a last block takes of it;
  a document of which nothing is taken goes.
- packing: every row is tokenized and packed.

Null texts have no language and go first; null languages and sources stay as they are; repeated rows become one in the
second stage, and unlike texts of one doc_id all stay; extra columns are dropped in the first; an empty table runs through to no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import language, mixing, packing, secrets, simhash
from corpusloom.llm.common import WORD, stash, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows of an Arrow batch at most: documents are long, and a batch stands in a task's JVM, as it grows there, and in its Python worker at the same time.
BATCH = 1000


def _bounded(spark: SparkSession) -> None:
    """From now on the session's Arrow batches have ``BATCH`` rows at most. It stays so, as stages run when they are written; a lower setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH:
        spark.conf.set(key, BATCH)


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    model = language.learn(docs, F.col("doc_id").isNotNull())
    return language.identify(docs.select(*COLUMNS), model).where(F.col("lang_pred") != language.UND).select(*COLUMNS)


def _simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return simhash.dedup(docs.select(*COLUMNS)).select(*COLUMNS)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    clean = docs.withColumn("text", secrets.redact(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs.select(*COLUMNS))
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("extra"), F.lit(1)).cast("int")), "")
    last = F.when(F.col("extra") <= 0, F.array().cast("array<string>")).when(F.col("extra") >= F.col("size"), F.array("text")).otherwise(F.array(cut))
    copies = mixed.where("taken > 0").withColumn("text", F.explode(F.concat(F.array_repeat("text", F.col("passes").cast("int")), last)))
    return copies.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("language", _language), ("simhash", _simhash), ("secrets", _secrets), ("mixing", _mixing), ("packing", _packing)]

#: XXH64, tokenization and differencing have no SQL: the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stash(docs)
    return docs
