import hashlib
import re

from pyspark.sql import functions as F

from corpusloom.llm import merkle


def leaves(text):
    out = set()
    for s in re.findall(r"(?s).+?(?:\n[ \t]*\n\s*|\Z)", text):
        for p in re.findall(r"[^\n]*\n+|[^\n]+", s):
            out |= set(re.findall(r"(?a:(?:\S+\s*){1,5}|\s+)", p))
    return out


def alike(a, b):
    x, y = leaves(a), leaves(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def expected(texts):
    out = {}
    for i, t in enumerate(texts):
        t, n = t or "", texts[(i + 1) % len(texts)] or ""
        k = len(t) // 4
        e = t[: len(t) - k] + n[:k]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), alike(t, e), alike(t, n))
    return out


TEXTS = ["one two three four five six seven eight\nnine ten", None, "", "é" * 41, "a\n\nb c\n \n\nd " * 20, "one two three four five six seven eight\nnine ten", "x", " \n", "word " * 5000]


def test_query_equals_brute_force(spark, docs, save):
    rows = merkle.op3_fingerprints(spark, save(documents=docs(*TEXTS).withColumn("need", F.lit(1)).repartition(5))).collect()
    found = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in rows}
    assert found == {i: (n, h, round(a, 12), round(b, 12)) for i, (n, h, a, b) in expected(TEXTS).items()}
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS):
            assert (prints[i] == prints[j]) == ((a or "") == (b or ""))


def test_one_repeated_null_and_no_rows(spark, docs, rows, save):
    one = merkle.op3_fingerprints(spark, save(documents=docs("some words here"))).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"some words hsom").hexdigest()
    data = docs("aaaa bbbb", "cccc dddd")
    both = data.union(data).union(rows("doc_id long, text string, lang string, source string, n_chars long", (None, "eeee ffff", None, None, 9)))
    found = merkle.op3_fingerprints(spark, save(documents=both)).collect()
    assert len(found) == 5 and [r["edited_sha256"] for r in found if r["doc_id"] is None] == [hashlib.sha256(b"eeee ff").hexdigest()]
    assert {r["edited_sha256"] for r in found if r["doc_id"] == 1} == {hashlib.sha256(b"cccc ddaa").hexdigest()}
    assert merkle.op3_fingerprints(spark, save(documents=data.limit(0))).count() == 0


def test_edits_are_located(rows):
    df = rows("a string, b string", ("p one\np two\n\nq one\nq two", "p one\np two\n\nq one\nq 2"), ("same", "same"), ("gone\n\nmore", "gone"))
    found = df.select(merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b")))).collect()
    assert [[tuple(e) for e in r[0]] for r in found] == [[(1, 1)], [], [(0, 0), (1, 0)]]
