import heapq
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing


def words(n):
    return " ".join(["w"] * n)


def filled(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight, the excess over a cap shared again until none is left."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, out, capped = sum(sizes), [0.0] * len(sizes), set()
    while len(capped) < len(sizes):
        left = total - sum(cap * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        for i in free:
            out[i] = left * w[i] / sum(w[j] for j in free)
        over = {i for i in free if out[i] > cap * sizes[i]}
        if not over:
            break
        capped |= over
        for i in over:
            out[i] = cap * sizes[i]
    return out


@pytest.mark.parametrize("sizes", [[100, 50, 10, 7, 900], [5, 5, 5], [1000, 1, 1, 1, 1, 1, 30], [0, 10, 0, 1], [40]])
def test_targets_and_bounds(docs, sizes):
    data = [(words(s // 2), "en", f"s{i}") for i, s in enumerate(sizes)] + [(words(s - s // 2), "en", f"s{i}") for i, s in enumerate(sizes)]
    found = mixing.mix(docs(*data), block_tokens=1, shard_tokens=20).collect()
    for i, goal in enumerate(filled(sizes)):
        own = [r for r in found if r["source"] == f"s{i}"]
        assert all(r["target"] == pytest.approx(goal) and r["source_size"] == sizes[i] and r["taken"] <= 3 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - goal) <= 1


def dealt(votes, seats):
    """Highest quotients, one seat at a time."""
    heap = [(-v / 1, k, 1) for k, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    won = [0] * len(votes)
    for _ in range(seats):
        _, k, j = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * j + 1), k, j + 1))
    return won


@pytest.mark.parametrize("votes, seats", [([53.0, 24.0, 23.0], 7), ([1.0, 1.0, 1.0, 1.0], 2), ([1e6, 3.0, 2.0, 1.0], 1000), ([10.0, 0.0, 5.0], 0), ([5.0, 5.0, 5.0, 85.0], 3), ([7.0] * 9, 40)])
def test_sainte_lague_equals_dealing(rows, votes, seats):
    df = rows("k long, votes double, seats long", *[(k, v, seats) for k, v in enumerate(votes)])
    found = mixing.sainte_lague(df, [], "k").orderBy("k").collect()
    assert [r["quota"] for r in found] == dealt(votes, seats)


def test_query_agrees_with_sql_and_itself(spark, docs, save):
    import duckdb

    data = [(words(i * 7 % 60), "en", [None, "b", "a", "é", "Z"][i % 5]) for i in range(80)] + [(None, "en", "a"), ("", "en", None), ("  \t", "en", "only")]
    folder = save(documents=docs(*data).withColumn("size", F.lit("x")).withColumn("shard", F.lit(1)))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    one = sorted(map(tuple, mixing.op5_mixing(spark, folder).collect()))
    assert one == sorted(con.execute(mixing.ORACLE).fetchall()) == sorted(map(tuple, mixing.op5_mixing(spark, folder).collect()))
    assert all(t[1] == len(re.findall(r"[^\x20\x09-\x0D]+", data[t[0]][0] or "")) for t in one)


def test_empty_and_wordless(spark, docs, save):
    assert mixing.op5_mixing(spark, save(documents=docs("a").limit(0))).count() == 0
    found = mixing.op5_mixing(spark, save(documents=docs(None, "", " "))).collect()
    assert [(r["size"], r["taken"]) for r in found] == [(0, 0)] * 3
