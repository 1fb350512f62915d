import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import simhash


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints):
    """Brute force: the least id reachable over links of at most 4 bits."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, prints, strict=True):
            for j, b in zip(ids, prints, strict=True):
                if (a ^ b).bit_count() <= 4 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdeé", k=4))
    out = [None, "", "  \t\n", "One", "one", "two words", "a\x0bb c d", "A B C D", "a b c d e"]
    for n in (30, 200, 3000):
        base = [word() for _ in range(n)]
        out += [" ".join(base), " ".join(base), "\n".join(base).upper()]
        for k in range(6):
            changed = list(base)
            for _ in range(k):
                changed[rng.randrange(n)] = word()
            out.append(" ".join(changed))
    return out


def test_query_equals_brute_force(spark, docs, save):
    data = texts()
    found = {r["doc_id"]: r for r in simhash.op1_simhash(spark, save(documents=docs(*data).withColumn("fp", F.lit("x")))).collect()}
    prints = [plain(t) for t in data]
    assert [int(found[i]["fingerprint"], 16) for i in range(len(data))] == prints and all(len(r["fingerprint"]) == 16 for r in found.values())
    assert {i: r["component_id"] for i, r in found.items()} == groups(range(len(data)), prints)
    assert found[0]["fingerprint"] == "0" * 16 and found[2]["component_id"] == 0


def test_links_of_chosen_fingerprints(spark, rows):
    rng = np.random.default_rng(2)
    prints = []
    for _ in range(12):
        base = int(rng.integers(0, 1 << 63))
        chain = base
        for _ in range(6):
            prints.append(chain)
            flips = rng.choice(64, int(rng.integers(1, 7)), replace=False)
            for b in flips:
                chain ^= 1 << int(b)
    prints += [0, 0b1111, 0b11111 << 20, (1 << 64) - 1, (1 << 64) - 1 - 15]
    df = rows("doc_id long, fp long", *[(i, simhash._signed(p)) for i, p in enumerate(prints)])
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert found == groups(range(len(prints)), prints)


def test_a_tight_cluster_gives_a_forest():
    values = np.unique(np.array([sum(1 << int(b) for b in c) for c in np.random.default_rng(0).integers(0, 64, (3000, 2))], np.uint64))
    assert len(simhash.forest(values, 4)) == len(values) - 1


def test_buckets_across_batches():
    import pyarrow as pa

    batch = lambda keys, prints: pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(prints, pa.int64())], ["key", "fp"])
    out = list(simhash._link_buckets(4)(iter([batch([1, 1, 2], [0, 1, 0]), batch([2], [3]), batch([], []), batch([2, 3], [7, 7])])))
    links = {tuple(sorted(p)) for b in out for p in zip(*[c.to_pylist() for c in b.columns], strict=True)}
    assert (0, 1) in links and (0, 3) in links and (0, 7) in links


def test_dedup_keeps_one_of_each_group(docs):
    long = " ".join(f"w{i}" for i in range(300))
    df = docs("other text entirely here now", long, long + " x", None, "", long).withColumn("_row", F.lit(1)).withColumn("fp", F.lit(2))
    kept = simhash.dedup(df.union(df.where("doc_id = 1")))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 3] and "fp" in kept.columns
    assert simhash.dedup(df.limit(0)).count() == 0


def test_ties_and_null_ids(rows):
    df = rows("doc_id long, fp long", (None, 5), (None, 5), (3, 5), (3, 5), (None, -1))
    found = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert sorted(found, key=str) == sorted([(None, 3), (None, 3), (3, 3), (3, 3), (None, None)], key=str)


def test_dedup_by_group_with_null_and_repeated_ids(rows):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(200)) for x in "abcd")
    df = rows("doc_id long, text string", (None, a), (None, a + " x"), (None, b), (None, b), (1, c), (1, d), (1, d), (2, c + " x"), (3, a[:-4] + "zzz"), (None, None))
    kept = [(r["doc_id"], r["text"]) for r in simhash.dedup(df).collect()]
    prints = [simhash.fingerprint(t) for t in (a, a + " x", a[:-4] + "zzz", c, c + " x")]
    assert all((p ^ prints[0]).bit_count() <= 4 for p in prints[1:3]) and (prints[3] ^ prints[4]).bit_count() <= 4
    assert sorted(kept, key=str) == sorted([(3, a[:-4] + "zzz"), (None, b), (1, c), (1, d), (None, None)], key=str)
