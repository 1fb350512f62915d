import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import backoff


def plain(texts, least=2, alpha=0.4):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = [Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(map(len, words))
    out = []
    for w in words:
        s = 0.0
        for i in range(len(w)):
            one, two, three = (w[i],), tuple(w[i - 1 : i + 1]), tuple(w[i - 2 : i + 1])
            if i >= 2 and counts[2][three] >= least:
                s += math.log(counts[2][three] / counts[1][three[:2]])
            elif i >= 1 and counts[1][two] >= least:
                s += math.log(counts[1][two] / counts[0][two[:1]]) + (math.log(alpha) if i >= 2 else 0)
            else:
                s += math.log(counts[0][one] / total) + min(i, 2) * math.log(alpha)
        out.append((len(w), s))
    return out


@pytest.mark.parametrize("block, part, width", [(None, None, 64), (40, 30, 64), (1, 1000, 64), (40, 30, 11), (1000, 200, 9)])
def test_equals_brute_force(docs, block, part, width):
    """Narrow integers are split among groups, wherever two numbers don't fit."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([*"abcdefgh", "xylophone", "ünï"], int(n))) for n in rng.integers(1, 60, 40)]
    texts += [None, "", "  ", "once\x0bonly words", texts[0], "a " * 3000]
    df = docs(*texts).withColumn("score", F.lit("x")).repartition(3)
    found = {r["doc_id"]: (r["n_tokens"], r["total_score"]) for r in backoff.score(df, block_tokens=block, partition_ngrams=part, width=width).collect()}
    for i, (n, s) in enumerate(plain(texts)):
        assert found[i][0] == n and found[i][1] == pytest.approx(s, abs=1e-6)


def test_other_counts_and_empty_tables(docs, spark, save):
    texts = ["a b c a b c a b d", "a b c"]
    found = [r["total_score"] for r in backoff.score(docs(*texts), min_count=3).orderBy("doc_id").collect()]
    assert found == pytest.approx([s for _, s in plain(texts, 3)])
    with pytest.raises(ValueError):
        backoff.score(docs("a"), min_count=1)
    assert backoff.op6_backoff(spark, save(documents=docs("a").limit(0))).count() == 0
    none = backoff.op6_backoff(spark, save(documents=docs(None, ""))).collect()
    assert [(r["n_tokens"], r["total_score"], r["score"]) for r in none] == [(0, 0.0, None)] * 2


def test_hashes_of_words_may_collide(docs, monkeypatch):
    """All words share a hash here, and pairs are integers, not hashes: counts stay exact."""
    import xxhash

    words = [b"b", b"a", b"c"]
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda w: 7)
    order, hashes = backoff._by_hash(words)
    assert [words[k] for k in order] == [b"a", b"b", b"c"] and set(hashes.tolist()) == {7}


@pytest.mark.parametrize("bits", [2, 3, 11, 16])
def test_scrambling_keeps_integers_apart(bits):
    every = backoff._scrambled(np.arange(1 << bits, dtype=np.uint64), bits)
    assert len(set(every.tolist())) == 1 << bits and every.max() < 1 << bits


def test_packed_values_come_back():
    rng = np.random.default_rng(1)
    for top in (1 << 20, 1 << 34, 1 << 44, 1 << 64):
        values = np.unique(rng.integers(0, top, 50, dtype=np.uint64))
        assert (backoff._unpacked(backoff._packed(values), len(values)) == values).all()
    counts = np.array([1, 254, 255, 256, 10**9])
    assert (backoff._counts(backoff._bytes(counts), 5) == counts).all()
