"""Which (group_key, question_style) pairs passed, failed or are to be tried again, and the loop that tries them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.sources.tables import persisted

PAIR = ["group_key", "question_style"]


def keyed(rows: DataFrame) -> DataFrame:
    """With group_key and a question_style that is never null."""
    style = F.coalesce(F.col("question_style"), F.lit("")) if "question_style" in rows.columns else F.lit("")
    return rows.withColumn("group_key", X.group_key("sample_id")).withColumn("question_style", style)


def generated_pairs(output: DataFrame) -> DataFrame:
    """Pairs of rows not marked failed, with their ids in order and the latest."""
    rows = keyed(output.where(~F.col("status").eqNullSafe("failed")) if "status" in output.columns else output)
    return rows.groupBy(*PAIR).agg(F.array_sort(F.collect_list("id")).alias("ids"), F.max("id").alias("latest"))


def passed_pairs(final: DataFrame) -> DataFrame:
    return keyed(final).select(*PAIR).distinct()


def failed_pairs(output: DataFrame, final: DataFrame) -> DataFrame:
    return generated_pairs(output).join(passed_pairs(final), PAIR, "left_anti")


def marked_failed(output: DataFrame) -> DataFrame:
    """Pairs of rows whose status is failed."""
    return keyed(output.where("status = 'failed'")).select(*PAIR).distinct()


def processed_ids(output: DataFrame, skip_status: str | None = None) -> DataFrame:
    rows = output if skip_status is None else output.where(~F.col("status").eqNullSafe(skip_status))
    return rows.select(F.explode("sample_id").alias("sample_id")).distinct()


def stamp(output: DataFrame, passed: DataFrame, failed: DataFrame) -> DataFrame:
    """status by id: passed wins over failed, other rows keep theirs."""
    marks = failed.select("id", F.lit(0).alias("m")).unionByName(passed.select("id", F.lit(1).alias("m"))).groupBy("id").agg(F.max("m").alias("_m"))
    old = F.col("status") if "status" in output.columns else F.lit(None).cast("string")
    joined = output.join(marks, "id", "left")
    return joined.withColumn("status", F.when(F.col("_m") == 1, "passed").when(F.col("_m") == 0, "failed").otherwise(old)).drop("_m")


def stamp_latest(output: DataFrame, final: DataFrame) -> DataFrame:
    """Marks each pair's latest row by whether the pair passed."""
    pairs = generated_pairs(output)
    good = pairs.join(passed_pairs(final), PAIR, "left_semi").select(F.col("latest").alias("id"))
    bad = pairs.join(passed_pairs(final), PAIR, "left_anti").select(F.col("latest").alias("id"))
    return stamp(output, good, bad)


def affected(final: DataFrame, retry: DataFrame) -> DataFrame:
    """The survivors of the groups that are tried again: what new rows are compared with."""
    return keyed(final).join(retry.select("group_key").distinct(), "group_key", "left_semi")


def retry_until(generate: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame], dedup: Callable[[DataFrame, DataFrame], DataFrame], output: DataFrame, final: DataFrame, attempts: int = 3) -> tuple[DataFrame, DataFrame, int]:
    """Tries failed pairs again: ``generate(pairs)`` makes rows for them, ``finish`` filters these, ``dedup(new, survivors)`` ends.

    Ends when none failed or after ``attempts`` (below 0: when a round brings no new row). Pairs for which a round makes nothing stay failed.
    Every round's rows are written out, so a lost executor doesn't repeat model calls. Returns output, final and the rounds run.
    """
    output, final, done = persisted(keyed(output)), persisted(keyed(final)), 0
    wanted = generated_pairs(output).select(*PAIR)
    while attempts < 0 or done < attempts:
        open_pairs = persisted(wanted.join(passed_pairs(final), PAIR, "left_anti"))
        if open_pairs.isEmpty():
            break
        last = output.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("m")).first()["m"]
        new = persisted(keyed(generate(open_pairs)).withColumn("id", F.col("id") + last + 1))
        kept = persisted(keyed(dedup(finish(new), affected(final, open_pairs))))
        marked = stamp_latest(output, final) if "status" in output.columns else output
        output = persisted(marked.unionByName(new, allowMissingColumns=True))
        final = persisted(final.unionByName(kept, allowMissingColumns=True))
        done += 1
        if attempts < 0 and new.isEmpty():
            break
    return stamp_latest(output, final), final, done
