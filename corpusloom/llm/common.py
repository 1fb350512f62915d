"""What the operators of this subpackage share: tables cut from lineage, word rules and seeded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.tables import free_names, persisted, persisted_by

#: A word is a run of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: So many narrow rows may be broadcast.
FEW = 100_000


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so that lost executors cost no recomputation and several readers share one pass."""
    return persisted(df)


def stash_by(df: DataFrame, column: str) -> DataFrame:
    """As ``stash``, but dealt by the column into as many buckets as there are shuffle partitions, so that a join on it needn't shuffle this side again."""
    return persisted_by(df, column)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(mod))


def bounded_sample(df: DataFrame, by: list[str], per_group: int, order: str, columns: list[str]) -> DataFrame:
    """The ``per_group`` rows of lowest seeded hash of ``order`` in each group: a bounded sample that doesn't depend on partitions.

    Groups are counted first, and only rows whose hash lies in the lowest part, wide enough for three times the sample, are shuffled and
    ranked. The counts are broadcast while there are at most ``FEW`` groups; beyond that Spark joins as it sees fit.
    """
    from pyspark.sql import Window

    named = df.select(*[F.col(c).alias(f"b{k}") for k, c in enumerate(by)], F.col(order).alias("o"), F.struct(*columns).alias("row")).withColumn("h", F.xxhash64("o", F.lit(11)))
    keys = [f"b{k}" for k in range(len(by))]
    sizes = few(stash(named.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))))
    low = named.join(sizes, keys).where(F.col("h") / 2.0**64 + 0.5 <= 3.0 * per_group / F.col("size"))
    w = Window.partitionBy(*keys).orderBy("h", "o")
    return low.withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_group).select("row.*")


def row_of(df: DataFrame, *but: str) -> Column:
    """All columns (but some) as one struct, beside which no column of an operator's own can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in but])


def few(df: DataFrame, bound: int = FEW) -> DataFrame:
    """Marked for broadcast if it is counted to have at most ``bound`` (narrow) rows. The table must be cheap to read twice."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


__all__ = ["FEW", "WORD", "bounded_sample", "crc_mod", "few", "free_names", "row_of", "stash", "stash_by", "table"]
