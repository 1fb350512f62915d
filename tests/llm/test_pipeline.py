import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import mixing, secrets, simhash
from corpusloom.llm.components import components

pytest.importorskip("public_tokenizers")


def corpus():
    rng = random.Random(1)
    sounds = {"en": "the tion ing and ou re".split(), "es": "ción que os la ado ñar".split()}
    out = []
    for i in range(40):
        lang = ("en", "es")[i % 2]
        text = " ".join("".join(rng.choices(sounds[lang], k=2)) for _ in range(rng.randint(30, 200)))
        out.append((text, lang, f"s{i % 3}"))
    out += [out[3], (out[4][0] + " end", "en", "s0"), (None, "en", "s1"), ("12 34", None, "s1"), ("", "en", None), (out[0][0] + " password=hunter22", "en", "s2"), (out[6][0][::-1], None, None)]
    return out


def test_components(rows):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    least = {}
    for a, b in links:
        for n in (a, b):
            least.setdefault(n, n)
    for _ in range(200):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = {r["node"]: r["component"] for r in components(rows("u long, v long", *links)).collect()}
    alone = {n for n, c in least.items() if c == n and list(least.values()).count(n) == 1}
    assert found == {n: c for n, c in least.items() if n not in alone}
    assert components(rows("u long, v long", *links).limit(0)).count() == 0


def test_stages_equal_brute_force(spark, docs, save):
    data = corpus()
    df = docs(*data).withColumn("score", F.lit(1))
    folder = save(documents=df)
    at, stages = {}, dict(corpus_pipeline.STAGES)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.mode("overwrite").parquet(f"{folder}/out-{name}")
        now = at[name] = spark.read.parquet(f"{folder}/out-{name}")
    rows = {n: [r.asDict() for r in d.collect()] for n, d in at.items()}
    for name in list(stages)[:-1]:
        assert tuple(at[name].columns) == corpus_pipeline.COLUMNS
    kept = {i for i, (t, _, _) in enumerate(data) if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in rows["language"]} == kept
    prints = {i: simhash.fingerprint(data[i][0]) for i in kept}
    least = {i: i for i in kept}
    for _ in kept:
        for a in kept:
            for b in kept:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    least[a] = least[b] = min(least[a], least[b])
    assert sorted(r["doc_id"] for r in rows["simhash"]) == sorted({i for i in kept if least[i] == i})
    assert {r["doc_id"]: r["text"] for r in rows["secrets"]} == {r["doc_id"]: secrets.redacted(r["text"]) for r in rows["simhash"]}
    taken = {r["doc_id"]: r for r in mixing.mix(at["secrets"]).collect()}
    for r in rows["secrets"]:
        own = sorted(x["text"] for x in rows["mixing"] if x["doc_id"] == r["doc_id"])
        m = taken[r["doc_id"]]
        cut = re.match(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){%d}" % m["extra"], r["text"])[0] if 0 < m["extra"] < m["size"] else r["text"]
        assert own == sorted([r["text"]] * m["passes"] + ([cut] if m["extra"] else []))
        assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in own) == m["taken"]
    assert {r["doc_id"] for r in rows["packing"]} == {r["doc_id"] for r in rows["mixing"]}
    whole = sum(r["length"] for r in rows["packing"])
    assert whole == sum(r["doc_tokens"] for r in rows["packing"] if r["start"] == 0)
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()) == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in rows["packing"])


def test_empty_table(spark, docs, save):
    assert corpus_pipeline.run(spark, save(documents=docs("a").limit(0))).count() == 0


@pytest.mark.parametrize("name", ["language", "simhash", "secrets", "packing"])
def test_long_documents_reach_python_in_bounded_batches(spark, docs, save, name):
    key, df = "spark.sql.execution.arrow.maxRecordsPerBatch", docs(*[f"the text {i}" for i in range(2500)]).coalesce(1)
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, df, save(documents=df))
        assert max(r["n"] for r in df.mapInArrow(sizes, "n long").collect()) <= corpus_pipeline.BATCH
        spark.conf.set(key, 7)
        corpus_pipeline._bounded(spark)
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.unset(key)
