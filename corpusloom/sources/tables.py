"""Tables cut from lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local master, whose driver and executors are one machine, may go without: it gets a temporary folder."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as it takes to be no column of ``df``, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while (name := f"_{name}").lower() in taken:
            pass
        out.append(name)
    return out


#: What this process wrote: (path, name of the catalog's table or none).
_MADE: list[tuple[str, str | None]] = []


def persisted(df: DataFrame) -> DataFrame:
    """Written once as Parquet and read back: survives lost executors, and its readers share one computation."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/corpusloom-{uuid.uuid4().hex}"
    _MADE.append((path, None))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persisted_by(df: DataFrame, column: str) -> DataFrame:
    """As ``persisted``, in as many buckets of the column as there are shuffle partitions; the table has to stand in the catalog."""
    spark, name = df.sparkSession, f"corpusloom_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    _MADE.append((path, name))
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).saveAsTable(name)
    return spark.table(name)


def clear(spark: SparkSession) -> int:
    """Removes the tables that this process wrote on the way; results that still read them must have been written. Returns how many."""
    count = 0
    while _MADE:
        path, name = _MADE.pop()
        if name:
            spark.sql(f"drop table if exists {name}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        count += bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
    return count
