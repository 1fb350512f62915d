"""From chunks to generation tasks: validity, summaries, styles, resume and retry, windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.sources.tables import persisted


@dataclass(frozen=True)
class CorpusConfig:
    min_chars: int = 800
    max_chars: int = 120_000
    chunk_type_field: str = "chunk_type"
    summary_value: str = "summary"
    summaries: bool = False


def is_summary(cfg: CorpusConfig) -> Column:
    """Null-safe: a chunk without a type is content."""
    return F.col(cfg.chunk_type_field).eqNullSafe(F.lit(cfg.summary_value))


def valid_chunks(chunks: DataFrame, cfg: CorpusConfig = CorpusConfig(), kind: str = "styled") -> DataFrame:
    """Chunks long enough after truncation, with ``prompt_text``. ``kind``: styled drops summary rows and rows without id or name; rewrite keeps summary rows; pairs keeps them and raises on a missing id or name."""
    rows = chunks
    if kind == "styled" and cfg.chunk_type_field in chunks.columns:
        rows = rows.where(~is_summary(cfg))
    if kind != "pairs":
        rows = rows.where(F.col("hf_row_id").isNotNull() & F.col("document_name").isNotNull())
    rows = rows.where(F.col("text").isNotNull()).withColumn("prompt_text", X.truncate("text", cfg.min_chars, cfg.max_chars)).where(F.length("prompt_text") >= cfg.min_chars)
    if kind == "pairs":
        present = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a chunk has no {c}")).cast("string"))
        rows = rows.withColumn("hf_row_id", present("hf_row_id")).withColumn("document_name", present("document_name"))
    return rows


def sample_text(text: str = "prompt_text") -> Column:
    return F.array(F.struct(F.col("hf_row_id"), F.col(text).alias("text"), F.col("document_name")))


def doc_summaries(chunks: DataFrame, cfg: CorpusConfig = CorpusConfig(), order: str = "seq") -> DataFrame:
    """(document_id, summary): the last non-blank summary row of each document."""
    found = chunks.where(is_summary(cfg) & (X.strip("text") != "") & F.col("document_id").isNotNull())
    return found.groupBy(F.col("document_id").cast("string").alias("document_id")).agg(X.strip(F.max_by("text", order)).alias("summary"))


def with_summary(rows: DataFrame, summaries: DataFrame | None) -> DataFrame:
    """Adds ``doc_summary``, a prompt block, empty where there is none. The summaries are written first, as only then Spark knows before it
    shuffles the rows by document whether the summaries' size allows a broadcast."""
    if summaries is None:
        return rows.withColumn("doc_summary", F.lit(""))
    found = persisted(summaries.select(F.col("document_id").alias("_doc"), "summary"))
    joined = rows.join(found, F.col("document_id").cast("string") == F.col("_doc"), "left").drop("_doc")
    return joined.withColumn("doc_summary", X.summary_block("summary")).drop("summary")


def with_styles(rows: DataFrame, styles: list[str], column: str = "question_style") -> DataFrame:
    """Each row once a style, ``style_index`` keeping their order."""
    return rows.select("*", F.posexplode(F.array(*[F.lit(s) for s in styles])).alias("style_index", column))


def pending(rows: DataFrame, done: DataFrame, key: str = "hf_row_id") -> DataFrame:
    """Rows whose key is in no finished row's sample_id. Rows marked failed are open again if ``done`` leaves them out."""
    return rows.join(done.select(F.explode("sample_id").alias(key)).distinct(), key, "left_anti")


def pending_pairs(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose (group_key, question_style) isn't done."""
    return rows.join(done.select("group_key", "question_style").distinct(), ["group_key", "question_style"], "left_anti")


def only_pairs(rows: DataFrame, retry: DataFrame | None) -> DataFrame:
    """Rows whose (group_key, question_style) is to be tried again; all if ``retry`` is None. Placed before any model call."""
    return rows if retry is None else rows.join(retry.select("group_key", "question_style").distinct(), ["group_key", "question_style"], "left_semi")


def style_tasks(chunks: DataFrame, styles: list[str], cfg: CorpusConfig = CorpusConfig(), *, kind: str = "styled", done: DataFrame | None = None, retry: DataFrame | None = None) -> DataFrame:
    """Valid open chunks, with their document's summary, once a style: what a generator asks about."""
    rows = valid_chunks(chunks, cfg, kind)
    if done is not None:
        rows = pending(rows, done)
    rows = with_summary(rows, doc_summaries(chunks, cfg) if cfg.summaries else None)
    rows = rows.withColumn("sample_id", F.array("hf_row_id")).withColumn("sample_text", sample_text()).withColumn("group_key", F.col("hf_row_id"))
    return only_pairs(with_styles(rows, styles), retry)


def local_windows(chunks: DataFrame, n: int = 3, stride: int = 1) -> DataFrame:
    """Runs of ``n`` chunks of a document by position, from every ``stride``-th one; only full ones.

    (document_id, start, sample_id, sample_text, group_key); gaps in chunk_index don't matter.
    """
    by = Window.partitionBy("document_id").orderBy("chunk_index", "hf_row_id")
    run = F.collect_list(F.struct("hf_row_id", "text", "document_name")).over(by.rowsBetween(0, n - 1))
    # Windows are counted on their own: who doesn't read the texts doesn't move them.
    size = F.count(F.lit(1)).over(by.rowsBetween(0, n - 1))
    rows = chunks.withColumn("start", F.row_number().over(by) - 1).withColumn("sample_text", run).withColumn("_size", size)
    rows = rows.where((F.col("_size") == n) & (F.col("start") % max(1, stride) == 0))
    return rows.select("document_id", "start", F.col("sample_text.hf_row_id").alias("sample_id"), "sample_text").withColumn("group_key", X.group_key("sample_id"))


def previous_questions(rows: DataFrame) -> DataFrame:
    """Adds ``previous_questions``: those of the group's rows of lower id, over the whole table."""
    by = Window.partitionBy("_group").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_group", X.group_key("sample_id")).withColumn("previous_questions", F.collect_list("question").over(by)).drop("_group")
