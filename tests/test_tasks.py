import pytest
from pyspark.sql import functions as F

from corpusloom.operators import generate, retry
from corpusloom.operators import tasks as T
from corpusloom.models import ScriptedClient
from corpusloom.sources import corpus, fixtures

CHUNK = "hf_row_id string, document_id string, document_name string, chunk_index int, chunk_type string, text string, seq long"
CFG = T.CorpusConfig(min_chars=5, max_chars=50, summaries=True)


@pytest.fixture
def chunks(rows):
    return rows(
        CHUNK, ("1", "d", "D", 0, "summary", " the gist ", 1), ("2", "d", "D", 1, None, "first content text", 2), ("3", "d", "D", 2, "content", "second content text", 3),
        ("4", "e", "E", 0, "content", "other document text", 4), ("5", "e", None, 1, "content", "nameless content", 5), ("6", "e", "E", 3, "content", "tiny", 6), ("7", "d", "D", 9, "summary", "the newer gist", 7), ("8", "d", "D", 5, "content", None, 8),
    )


def ids(df, column="hf_row_id"):
    return sorted(r[column] for r in df.collect())


def test_valid_chunks(chunks):
    assert ids(T.valid_chunks(chunks, CFG)) == ["2", "3", "4"]
    assert ids(T.valid_chunks(chunks, CFG, "rewrite")) == ["1", "2", "3", "4", "7"]
    with pytest.raises(Exception, match="document_name"):
        T.valid_chunks(chunks, CFG, "pairs").collect()


def test_summaries(chunks):
    found = {r["document_id"]: r["summary"] for r in T.doc_summaries(chunks, CFG).collect()}
    assert found == {"d": "the newer gist"}
    tasks = T.style_tasks(chunks, ["easy", "hard"], CFG)
    assert tasks.count() == 6 and {r["hf_row_id"] for r in tasks.where("doc_summary = ''").collect()} == {"4"}


def test_resume_and_retry(rows, chunks):
    done = rows("sample_id array<string>", (["2"],))
    assert ids(T.style_tasks(chunks, ["easy"], CFG, done=done)) == ["3", "4"]
    again = rows("group_key string, question_style string", ("3", "hard"))
    found = T.style_tasks(chunks, ["easy", "hard"], CFG, retry=again).collect()
    assert [(r["hf_row_id"], r["question_style"]) for r in found] == [("3", "hard")]


def test_windows(rows):
    data = [(str(i), "d" if i < 5 else "e", "N", i * 10, "c", f"t{i}", i) for i in range(7)]
    found = T.local_windows(rows(CHUNK, *data), 3, 2).collect()
    assert sorted((r["start"], r["sample_id"]) for r in found) == [(0, ["0", "1", "2"]), (2, ["2", "3", "4"])]
    assert T.local_windows(rows(CHUNK, *data), 3, 0).count() == 3


def test_positions(rows):
    df = rows("a long", *[(i * 7 % 101,) for i in range(101)])
    found = corpus.with_position(df, ["a"]).collect()
    assert all(r["a"] == r["position"] for r in found)
    assert corpus.with_position(df.limit(0), ["a"]).count() == 0


def test_files(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": 1, "q": "é", "x": null}\nnot json\n{"id": "2", "q": "b"}\n{"q": "c"}\n{"id": 3}\n{"id": 4, "q": null}\n')
    found = corpus.read_rows(spark, str(tmp_path / "in"), "id long, q string", need=["q"])
    assert ids(found, "id") == [1, 4]
    assert ids(corpus.read_rows(spark, str(tmp_path / "in"), "id long, q string", start=4), "id") == [4]
    corpus.write_rows(found, path)
    corpus.write_rows(found, path)
    assert corpus.count_rows(spark, path) == 4 and corpus.count_rows(spark, path + "-none") == 0
    assert corpus.merge_paths(spark, [path, path + "-none"], "id long, q string").agg({"id": "max"}).first()[0] == 3


def test_pair_generator_numbers_styles(rows):
    df = rows(CHUNK, ("1", "d", "D", 0, "c", "one content", 1), ("2", "d", "D", 1, "c", "two content", 2))
    two = ScriptedClient((("conteúdo", "Pergunta: a? Resposta: b\nPergunta: c? Resposta: d"),))
    found = generate.qa_pairs(df, two, CFG).orderBy("id").collect()
    assert [(r["id"], r["question_style"], r["sample_id"]) for r in found] == [(0, "0", ["1"]), (1, "1", ["1"]), (2, "0", ["2"]), (3, "1", ["2"])]
    again = rows("group_key string, question_style string", ("2", "1"))
    assert [r["sample_id"] for r in generate.qa_pairs(df, two, CFG, retry=again).collect()] == [["2"]]
    assert generate.qa_pairs(df, two, CFG, num_rows=3).count() == 3


def test_personas_fall_back_to_the_chunk(rows):
    df = rows(CHUNK, ("1", "d", "D", 0, "c", "one content", 1))
    silent = ScriptedClient((("Escreva uma pergunta", "Pergunta: por quê?"), ("Reescreva", None)))
    found = generate.personas(df, silent, ("urgente",), CFG).collect()
    assert [m["content"] for m in found[0]["messages"]] == ["por quê?", "one content"]
    mute = ScriptedClient((("Escreva uma pergunta", "  "),))
    assert generate.personas(df, mute, ("urgente",), CFG).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        generate.personas(df, mute, ("nobody",), CFG)


OUT = "id long, sample_id array<string>, question_style string, status string"


def test_retry_bookkeeping(rows):
    out = rows(OUT, (1, ["a"], "x", None), (2, ["a"], "x", None), (3, ["b"], None, None), (4, ["c"], "x", "failed"))
    final = rows("id long, sample_id array<string>, question_style string", (9, ["a"], "x"))
    assert {(r["group_key"], r["question_style"], r["latest"]) for r in retry.generated_pairs(out).collect()} == {("a", "x", 2), ("b", "", 3)}
    assert [(r["group_key"], r["question_style"]) for r in retry.failed_pairs(out, final).collect()] == [("b", "")]
    assert {r["id"]: r["status"] for r in retry.stamp_latest(out, final).collect()} == {1: None, 2: "passed", 3: "failed", 4: "failed"}
    assert ids(retry.processed_ids(out, "failed"), "sample_id") == ["a", "b"]
    assert [(r["group_key"]) for r in retry.marked_failed(out).collect()] == ["c"]


def test_retry_loop(rows):
    out = rows(OUT, (0, ["a"], "x", None), (1, ["b"], "x", None))
    final = rows("id long, sample_id array<string>, question_style string", (0, ["a"], "x"))
    rounds = []

    def again(pairs):
        rounds.append([tuple(r) for r in pairs.select("group_key").collect()])
        return rows(OUT, (0, ["b"], "x", None)) if len(rounds) > 1 else rows(OUT)

    drop = lambda df: df.drop("status")
    output, last, n = retry.retry_until(again, drop, lambda new, old: new, out, final, 5)
    # The pair stays failed through a round that makes nothing for it, and passes in the next.
    assert n == 2 and rounds == [[("b",)], [("b",)]] and last.count() == 2
    assert {r["id"]: r["status"] for r in output.collect()} == {0: "passed", 1: "failed", 2: "passed"}


def test_chunks_are_numbered_without_texts(spark, tmp_path):
    """No window brings a source's texts together; numbers are dense within a source, a null one among them."""
    import pandas as pd

    from corpusloom import catalog
    from corpusloom.sources import fixtures

    docs = pd.DataFrame({"doc_id": [5, 1, 9, 4, 7, 8], "text": list("abcdef"), "source": ["x", "y", "x", None, "x", None]})
    docs.to_parquet(tmp_path / "documents.parquet")
    places = {r["seq"]: (r["chunk_index"], r["chunk_type"]) for r in fixtures.chunks(spark, str(tmp_path)).collect()}
    assert places == {5: (0, "summary"), 7: (1, "content"), 9: (2, "content"), 1: (0, "summary"), 4: (0, "summary"), 8: (1, "content")}
    assert {r["seq"]: r["chunk_type"] for r in fixtures.chunks(spark, str(tmp_path), indexed=False).collect()} == {k: v[1] for k, v in places.items()}
    plan = catalog.QUERIES["chunk_style_tasks"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_counting_windows_does_not_read_texts(spark, rows, tmp_path):
    rows("document_id string, chunk_index int, hf_row_id string, text string, document_name string", *[("d", i, str(i), "t", "n") for i in range(5)]).write.parquet(f"{tmp_path}/c")
    windows = T.local_windows(spark.read.parquet(f"{tmp_path}/c"), 3, 1).agg(F.count(F.lit(1)).alias("n"))
    assert windows.first()["n"] == 3
    assert "text:string" not in windows._jdf.queryExecution().executedPlan().toString()


def test_texts_without_a_vector_are_not_moved(spark, rows, tmp_path):
    rows("vec_id long, label int, embedding array<float>", (1, 0, [1.0]), (7, 0, [2.0])).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows("doc_id long, text string", *[(i, f"t{i}") for i in range(5)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = fixtures.vectors(spark, str(tmp_path))
    assert {(r["seq"], r["text"]) for r in found.collect()} == {(1, "t1"), (7, None)}
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
