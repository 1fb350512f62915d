"""Reading corpora and row files, writing results, merging runs. Plain Spark sources, so filters and columns reach the files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None, **options) -> DataFrame:
    """A lazy scan of any format Spark reads."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def check_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Fails on an absent column, an empty corpus, or a null in the first row."""
    absent = [f for f in fields if f not in df.columns]
    if absent:
        raise ValueError(f"the corpus has no column {', '.join(absent)}")
    first = df.select(*fields).first()
    if first is None:
        raise ValueError("the corpus is empty")
    if nulls := [f for f in fields if first[f] is None]:
        raise ValueError(f"the corpus's first row has no {', '.join(nulls)}")
    return df


#: The settings that name a corpus's columns, what they are called here, and their defaults.
FIELDS = {"DATASET_ID_FIELD": ("hf_row_id", "id"), "DATASET_TEXT_FIELD": ("text", "text"), "DATASET_DOC_ID_FIELD": ("document_id", "document_id"), "DATASET_DOC_NAME_FIELD": ("document_name", "document_name")}


def mapped(corpus: DataFrame, settings: dict) -> DataFrame:
    """The corpus with the columns that settings name under the engine's names; a column of that name already serves where none is set.

    Text, id and document name must be there and not null in the first row. Without a document a chunk is its own; without ``seq`` rows stand
    as they are read, without ``chunk_index`` in that order within their document, and without a type all are content.
    """
    from corpusloom.sources.tables import persisted

    found = {}
    for key, (name, default) in FIELDS.items():
        given = settings.get(key)
        found[name] = given or (name if name in corpus.columns else default)
    check_fields(corpus, [found[n] for n in ("hf_row_id", "text", "document_name")])
    column = lambda n: F.col(f"`{found[n]}`")
    doc = F.coalesce(column("document_id").cast("string"), column("hf_row_id").cast("string")) if found["document_id"] in corpus.columns else column("hf_row_id").cast("string")
    own = {"hf_row_id": column("hf_row_id").cast("string"), "document_id": doc, "document_name": column("document_name").cast("string"), "text": column("text").cast("string")}
    rows = corpus.select(*[F.col(f"`{c}`") for c in corpus.columns if c not in own], *[c.alias(n) for n, c in own.items()])
    if "seq" not in rows.columns:
        rows = persisted(rows.withColumn("seq", F.monotonically_increasing_id()))
    if "chunk_index" not in rows.columns:
        rows = rows.withColumn("chunk_index", F.row_number().over(Window.partitionBy("document_id").orderBy("seq")) - 1)
    return rows if "chunk_type" in rows.columns else rows.withColumn("chunk_type", F.lit(None).cast("string"))


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A table by the ending of its path: .jsonl or .json as JSON lines, .csv with a header, anything else as Parquet."""
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ending in ("jsonl", "json"):
        return spark.read.json(path)
    return spark.read.csv(path, header=True, inferSchema=True) if ending == "csv" else spark.read.parquet(path)


def required(name: str, kind: str | None = None) -> Column:
    """The column; a null raises when the row is read. ``kind`` casts strictly."""
    value = F.coalesce(F.col(name), F.raise_error(F.lit(f"a row has no {name}")).cast("string"))
    return value.cast(kind) if kind else value


def with_position(df: DataFrame, order: list[str]) -> DataFrame:
    """``position``: 0, 1, ... in the given order, without one task seeing all rows.

    Only the order's values are numbered: ranges of them on their own, plus the sizes of the ranges before. That narrow table is written, which
    runs ``df`` for its order columns; the rows get their numbers by a join and are moved once. Rows that tie in ``order`` are numbered as they fall.
    """
    from corpusloom.sources.tables import free_names, persisted

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, (base, *mine) = [f"k{i}" for i in range(len(order))], free_names(df, "base", *[f"k{i}" for i in range(len(order))])
    values = df.select(*[F.col(o).alias(k) for o, k in zip(order, keys, strict=True)]).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    ranged = persisted(values.repartitionByRange(n, *keys).withColumn("range", F.spark_partition_id()))
    before = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a range: as many as there are shuffle partitions.
    sizes = ranged.groupBy("range").agg(F.sum("rows").alias("rows")).select("range", before(Window.partitionBy(F.lit(0)).orderBy("range")).alias("earlier"))
    own = before(Window.partitionBy("range").orderBy(*keys))
    numbers = ranged.withColumn("own", own).join(F.broadcast(sizes), "range").select(*[F.col(k).alias(m) for k, m in zip(keys, mine, strict=True)], (F.col("own") + F.col("earlier")).alias(base))
    on = [F.col(o).eqNullSafe(F.col(m)) for o, m in zip(order, mine, strict=True)]
    placed = df.drop("position").join(numbers, on if len(on) > 1 else on[0])
    nth = F.lit(0)
    if (ranged.agg(F.max("rows")).first()[0] or 0) > 1:
        nth = F.row_number().over(Window.partitionBy(*mine).orderBy(F.lit(0))) - 1
    return placed.withColumn("position", (F.col(base) + nth).cast("long")).drop(base, *mine)


def renumbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``id`` dense from 0 in the order; the old id goes to ``input_id``."""
    moved = df.withColumn("input_id", F.col("id")) if "id" in df.columns else df
    order = ["input_id" if o == "id" else o for o in order]
    return with_position(moved, order).withColumn("id", F.col("position")).drop("position")


def read_rows(spark: SparkSession, path: str, schema: StructType | str, start: int | None = None, need: list[str] = ()) -> DataFrame:
    """JSON lines: malformed lines, rows without an integer id, below ``start``, or without a needed key are skipped. A key with null counts as there."""
    lines = spark.read.text(path)
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    keys = F.json_object_keys("value")
    ok = F.get_json_object("value", "$.id").rlike(r"^-?\d+$")
    for k in need:
        ok &= F.array_contains(keys, k)
    rows = lines.where(keys.isNotNull() & ok).select(F.from_json("value", kind).alias("r")).select("r.*").where("id is not null")
    return rows if start is None else rows.where(F.col("id") >= start)


def write_rows(df: DataFrame, path: str, mode: str = "append") -> None:
    """Appends JSON lines, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def has_path(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count() if has_path(spark, path) else 0


def high_water(df: DataFrame, field: str = "id") -> DataFrame:
    """One row: the field's maximum, -1 if there is none."""
    return df.agg(F.coalesce(F.max(field), F.lit(-1)).cast("long").alias("high_water"))


def merge_runs(frames: list[DataFrame]) -> DataFrame:
    """The frames in order, ids renumbered from 0; a frame keeps its own order by id, and columns that one lacks are null."""
    marked = [f.withColumn("_run", F.lit(k)) for k, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return with_position(merged, ["_run", "id"]).withColumn("id", F.col("position")).drop("position", "_run")


def merge_paths(spark: SparkSession, paths: list[str], schema) -> DataFrame | None:
    """As ``merge_runs`` over JSON-lines paths; paths that aren't there are skipped."""
    found = [read_rows(spark, p, schema) for p in paths if has_path(spark, p)]
    return merge_runs(found) if found else None
