"""The chunk store: a Parquet table of chunks with vectors, one row an id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.sources.corpus import has_path


def prepare(corpus: DataFrame, *, id_field: str = "id", text_field: str = "text", doc_field: str | None = "document_id", index_field: str = "chunk_index", name_field: str = "document_name", order: str | None = None) -> DataFrame:
    """Chunk rows: blank texts go; of rows with one id the last by ``order`` stays; without a document a chunk is its own."""
    doc = F.coalesce(F.col(doc_field).cast("string"), F.col(id_field).cast("string")) if doc_field and doc_field in corpus.columns else F.col(id_field).cast("string")
    seq = F.col(order) if order else F.monotonically_increasing_id()
    rows = corpus.where(X.strip(text_field) != "").select(
        F.col(id_field).cast("string").alias("hf_row_id"), doc.alias("document_id"), F.col(name_field).cast("string").alias("document_name"),
        F.col(index_field).cast("int").alias("chunk_index"), F.col(text_field).alias("text"), seq.cast("long").alias("seq"),
    )
    last = Window.partitionBy("hf_row_id").orderBy(F.col("seq").desc())
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def build(corpus: DataFrame, path: str, embed: Callable[[Column], Column], *, force: bool = False, **fields) -> DataFrame:
    """Writes the store unless one with rows is there already."""
    spark = corpus.sparkSession
    if force or not exists(spark, path):
        prepare(corpus, **fields).withColumn("embedding", embed(F.col("text"))).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def upsert(path: str, new: DataFrame, to: str) -> DataFrame:
    """The store with new rows in place of those of the same id, written to another path."""
    spark = new.sparkSession
    old = spark.read.parquet(path).join(new.select("hf_row_id"), "hf_row_id", "left_anti")
    old.unionByName(new).write.mode("overwrite").parquet(to)
    return spark.read.parquet(to)


def exists(spark: SparkSession, path: str) -> bool:
    return has_path(spark, path) and not spark.read.parquet(path).isEmpty()


def delete(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def doc_chunks(store: DataFrame, doc_id: str) -> DataFrame:
    """A document's chunks in order, without vectors; the filter reaches the files."""
    return store.where(F.col("document_id") == doc_id).select("hf_row_id", "document_id", "chunk_index", "document_name", "text").orderBy("chunk_index")


def local_window(store: DataFrame, doc_id: str, start: int, n: int) -> DataFrame:
    """Those with an index from ``start`` to before ``start + n``, which may be fewer."""
    return doc_chunks(store.where(F.col("chunk_index").between(start, start + n - 1)), doc_id)


def doc_chunk_map(store: DataFrame) -> DataFrame:
    """Of each document its chunk indexes in order."""
    return store.groupBy("document_id").agg(F.array_sort(F.collect_list("chunk_index")).alias("chunk_indexes"))
