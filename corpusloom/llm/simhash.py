"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is set if it is set in over half of the XXH64 values of a text's 4-word shingles. Two fingerprints link if at
most ``DISTANCE`` (4) bits differ. Then one of the two 32-bit halves differs in at most two bits, so the Hamming balls of
radius 1 around both values of that half share a member. Every distinct fingerprint is filed under the 33 members of each
half's ball; the fingerprints filed together are compared in full, and those that link are joined by a spanning forest: at
most one row a fingerprint filed, however many pairs a group of copies has. The forests' union has the components of all links.

Copies share one fingerprint and are filed once. A bucket holds distinct fingerprints whose half lies within one bit of one
of 2^32 values, 8 bytes each, sorted by Spark and streamed bucket by bucket; within one, each fingerprint still apart is
compared with those not yet reached, so a tight cluster costs about its size. At some 10^10 fingerprints a
bucket still holds only hundreds of random ones.

Nulls: a null text counts as empty, whose fingerprint is zero, linked like any other; a null doc_id never is a component's
id unless nothing else is in it. Repeated rows stay rows of their own; ``dedup`` keeps one row a group. An empty table gives an empty result. Extra columns
are dropped by the query and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import row_of, stash, table
from corpusloom.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
_LOT = 1 << 16
_BITS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """The SimHash of one text, unsigned. Counts are exact for texts of any length."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(SHINGLE)), strict=False)] or [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(grams), _LOT):
        h = np.array([digest(g, SEED) for g in grams[i : i + _LOT]], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(grams)).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([_signed(fingerprint(t.as_py())) for t in texts], pa.int64())


def simhash(text: Column) -> Column:
    """The fingerprint as a signed long."""
    return F.arrow_udf(_fingerprints, "long")(text)


def _filed(prints: DataFrame) -> DataFrame:
    """(key, fp) for the 2 x 33 balls' members; the key's bit 32 tells the halves apart."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    ball = lambda half, mark: F.transform(flips, lambda f: half.bitwiseXOR(f).bitwiseOR(F.lit(mark)))
    return prints.select(F.explode(F.concat(ball(low, 0), ball(high, 1 << 32))).alias("key"), "fp")


def forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct values: from each one reached, to those not yet reached within the distance."""
    links, rest = [], values
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                hit = rest[near]
                links += [(int(at), int(x)) for x in hit]
                front += list(hit)
                rest = rest[~near]
    return links


def _link_buckets(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            ends = np.concatenate((starts[1:], [len(keys)]))
            links: list[tuple[int, int]] = []
            # The last bucket may go on in the next batch.
            if held_key is not None:
                if keys[0] == held_key:
                    held = np.concatenate((held, prints[: ends[0]]))
                    if len(starts) == 1:
                        continue
                    starts, ends = starts[1:], ends[1:]
                links += forest(held, distance)
            held_key, held = keys[starts[-1]], prints[starts[-1] : ends[-1]].copy()
            sizes = (ends - starts)[:-1]
            two = starts[:-1][sizes == 2]
            if len(two):
                a, b = prints[two], prints[two + 1]
                near = np.bitwise_count(a ^ b) <= distance
                links += list(zip(a[near].tolist(), b[near].tolist(), strict=True))
            for s, e in zip(starts[:-1][sizes > 2].tolist(), ends[:-1][sizes > 2].tolist(), strict=True):
                links += forest(prints[s:e], distance)
            yield _rows(links)
        if len(held) > 1:
            yield _rows(forest(held, distance))

    return run


def _rows(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["u", "v"])


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """A forest of the links among distinct fingerprints (column ``fp``), as (u, v)."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"balls of radius 1 in two halves find distances up to {DISTANCE}")
    return _filed(prints).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_link_buckets(distance), "u long, v long")


def near_duplicates(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Of (doc_id, fp): adds component_id. The table must be cheap to read twice."""
    one = prints.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    groups = components(links(one.select("fp"), distance))
    least = groups.join(one, groups["node"] == one["fp"]).select("fp", "component", "_first")
    named = least.select("fp", "component").join(least.groupBy("component").agg(F.min("_first").alias("component_id")), "component").select(F.col("fp").alias("_fp"), "component_id")
    ids = one.join(named, F.col("fp") == F.col("_fp"), "left").select(F.col("fp").alias("_fp"), F.coalesce("component_id", "_first").alias("component_id"))
    return prints.join(ids, F.col("fp") == F.col("_fp")).drop("_fp")


def dedup(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One document of each group stays: the first by (doc_id, nulls last, hash of the text). All columns of ``docs`` are kept.

    A row counts for the group of its own text: of a repeated doc_id each group's row stays, and each group of null ids keeps one.
    """
    from pyspark.sql import Window

    # Both hashes together tell texts and ids apart; equal ones are copies of one row.
    marks = {"_text": F.xxhash64("text"), "_both": F.xxhash64(F.lit(1), "doc_id", "text")}
    prints = stash(docs.select("doc_id", simhash(F.col("text")).alias("fp"), *[c.alias(n) for n, c in marks.items()]))
    one = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "_both")).alias("_first"))
    groups = components(links(one.select("fp"), distance))
    named = one.join(groups, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp")).agg(F.min("_first").alias("_first"))
    kept = named.select(F.col("_first._text").alias("_kept_text"), F.col("_first._both").alias("_kept_both"))
    # Copies are reduced ahead of the shuffle, which serves the join too.
    first = Window.partitionBy("_text", "_both").orderBy("_text")
    single = docs.select(row_of(docs).alias("row"), *[c.alias(n) for n, c in marks.items()]).withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return single.join(kept, (F.col("_text") == F.col("_kept_text")) & (F.col("_both") == F.col("_kept_both"))).select("row.*")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    prints = stash(table(spark, sf_dir, "documents").select("doc_id", simhash(F.col("text")).alias("fp")))
    found = near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
