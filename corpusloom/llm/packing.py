"""Packing into sequences by Karmarkar-Karp multiway differencing.

A document's ids (and one closing id) are cut at multiples of the capacity: full pieces are sequences of their own. The rest
is cut again at multiples of ``rest_tokens``, which lets windows come out near-equal, and dealt with its shard's other rests. A shard holds about ``shard_tokens`` ids. Each rest begins as a partition
with one filled window; the two partitions of the largest imbalance are merged over and over, the fullest windows of one
with the emptiest of the other, until one near-equal partition is left. It starts with as few windows as the ids need; if
a window is above the capacity, the window count rises and the shard is dealt again.

Texts are tokenized once and never shuffled: only the pieces' spans are. Nulls: a null text counts as empty and packs as its
closing id; repeated rows are packed one by one; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stash, table

CAPACITY, CLOSING, REST_TOKENS, SHARD_TOKENS, VOCABULARY = 4096, 2, 512, 1 << 20, "word_bpe_49k.json"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_ENCODERS: dict = {}


def _encoder(path: str):
    """One a worker process, so that its dictionaries outlive a task."""
    from corpusloom.llm.wordbpe import WordBpe

    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]


def _spans(n: int, capacity: int, rest: int) -> list[tuple[int, int]]:
    full = n - n % capacity
    return [(s, capacity) for s in range(0, full, capacity)] + [(s, min(rest, n - s)) for s in range(full, n, rest)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, rest: int = REST_TOKENS) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), np.array([closing], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column(1)
            for doc_id, i in zip(batch.column(0).to_pylist(), range(len(texts)), strict=True):
                ids = encoder.encode(texts[i].as_py() or "") + end
                n = len(ids) // 4
                out += [(doc_id, s, m, zlib.crc32(ids[4 * s : 4 * (s + m)]), n) for s, m in _spans(n, capacity, rest)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, _PIECES)


def difference(sizes: list[int], windows: int) -> list[int]:
    """Karmarkar-Karp: the window of each size. Partitions are merged by largest spread; sums fall in one and rise in the other.

    A partition of one size has that size as its spread. While it is the largest, merging in the next sizes fills empty windows
    and leaves the spread, so up to ``windows`` sizes in falling order make a partition in one step.
    """
    order = np.argsort(-np.array(sizes, np.int64), kind="stable")
    falling = np.array(sizes, np.int64)[order]
    # A node is an item, or two nodes that share a window from then on.
    pairs: list[tuple[int, int]] = []
    n, heap, serial, head = len(sizes), [], 0, 0
    while head < n or len(heap) > 1:
        spread = -heap[0][0] if heap else 0
        if head < n and falling[head] >= spread:
            until = head + int(np.searchsorted(-falling[head : head + windows], -spread, side="right")) if heap else min(n, head + windows)
            sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
            sums[: until - head], nodes[: until - head] = falling[head:until], order[head:until]
            head = until
        else:
            _, _, a, x = heapq.heappop(heap)
            if head < n and (not heap or falling[head] >= -heap[0][0]):
                b, y = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
                b[0], y[0] = falling[head], order[head]
                head += 1
            else:
                _, _, b, y = heapq.heappop(heap)
            sums, y = a + b[::-1], y[::-1]
            both = np.flatnonzero((x >= 0) & (y >= 0))
            nodes = np.where(x >= 0, x, y)
            nodes[both] = n + len(pairs) + np.arange(len(both))
            pairs += zip(x[both].tolist(), y[both].tolist(), strict=True)
            by = np.argsort(-sums, kind="stable")
            sums, nodes = sums[by], nodes[by]
        sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), serial, sums, nodes))
        serial += 1
    where, stack = [0] * n, [(int(node), w) for w, node in enumerate(heap[0][3]) if node >= 0] if heap else []
    while stack:
        node, w = stack.pop()
        if node < n:
            where[node] = w
        else:
            stack += [(pairs[node - n][0], w), (pairs[node - n][1], w)]
    return where


def windows_for(sizes: list[int], capacity: int) -> list[int]:
    """As few windows as hold the sizes, one more as long as one is above the capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        where = difference(sizes, k)
        if np.bincount(where, weights=sizes, minlength=k).max(initial=0) <= capacity:
            return where
        k += 1


def pack(docs: DataFrame, path: str, *, capacity: int = CAPACITY, closing: int = CLOSING, rest_tokens: int = REST_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = stash(pieces(docs, path, capacity, closing, rest_tokens))
    total = cut.where(F.col("length") < capacity).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    shards = max(1, round(total / shard_tokens))
    # The highest bits say what a sequence holds: 0 rests of a shard, 1 a full piece.
    rests = cut.where(F.col("length") < capacity).withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)))

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        rows["sequence_id"] = rows["shard"] * (1 << 24) + windows_for(rows["length"].tolist(), capacity)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows.drop(columns="shard")

    dealt = rests.groupBy("shard").applyInPandas(deal, f"{_PIECES}, sequence_id long, offset long")
    full = cut.where(F.col("length") == capacity).withColumn("sequence_id", F.lit(1 << 62) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return dealt.unionByName(full)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
