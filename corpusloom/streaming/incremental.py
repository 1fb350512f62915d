"""Incremental runs as Structured Streaming: stateless phases as they are, greedy ones against what was kept before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators import filters
from corpusloom.sources.corpus import has_path


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def run_stateless(source: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> None:
    """All new files once, each row exactly once; for phases that look at one row at a time."""
    query = transform(source).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _run_greedy(source: DataFrame, output: str, checkpoint: str, first: Callable[[DataFrame], DataFrame], against: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """New rows are compared with those kept before in their sample, which come first. A batch writes its own folder, so a batch that is run again replaces what it wrote."""
    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        old = spark.read.parquet(output).where(F.col("batch") < number).drop("batch") if has_path(spark, output) else None
        kept = first(rows) if old is None else against(rows, old)
        kept.write.mode("overwrite").parquet(f"{output}/batch={number}")

    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_qa_filter(source: DataFrame, output: str, checkpoint: str, min_answer: int = 10, distance: int = 20) -> None:
    _run_greedy(source, output, checkpoint, lambda rows: filters.qa_filter(rows, min_answer, distance), lambda rows, old: filters.qa_filter_against(rows, old, min_answer, distance))


def run_embed_filter(source: DataFrame, output: str, checkpoint: str, threshold: float = 0.95, vector: str = "embedding") -> None:
    """Rows carry their vectors, which are kept with them."""
    _run_greedy(source, output, checkpoint, lambda rows: filters.embed_filter(rows, threshold, vector), lambda rows, old: filters.embed_filter_against(rows, old, threshold, vector))
