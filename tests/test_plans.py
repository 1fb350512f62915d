import pytest

from corpusloom.models import HashEmbedder, ScriptedClient, respond
from corpusloom.operators import edit
from corpusloom.plans import cli, pipeline
from corpusloom.plans.phases import Context, Phase, Role, get_phase, list_phases, register

from pyspark.sql import functions as F

SINGLE = """
env: {DATASET_DOC_NAME_FIELD: document_name, DATASET_MIN_CHARS: 5}
pipeline:
  - {phase: qa_gen_var, output: gen, config: {QA_GEN_VAR_QUESTION_STYLES: "easy, hard"}}
  - {phase: qa_filter, output: filtered}
  - {phase: conv_expand_var, output: talks, config: {CONV_EXPAND_VAR_N_USER_TURNS_MIN: 1, CONV_EXPAND_VAR_N_USER_TURNS_MAX: 2}}
  - {phase: conv_filter, output: kept}
  - {phase: judge, output: judged}
  - {phase: embed_filter, output: final}
"""
RUNS = """
env: {DATASET_DOC_NAME_FIELD: document_name, DATASET_MIN_CHARS: 5}
preprocess: {phase: chroma_preprocess, config: {CHROMA_PERSIST_DIR: "%s", CHROMA_VECTORSTORE_NAME: s}}
tail:
  - {phase: qa_filter, output: filtered}
runs:
  - {generator: qa_local_multihop, output_dir: local, config: {NUM_ROWS: 2, QA_LOCAL_MULTIHOP_NUM_CHUNKS: 2}}
  - generator: qa_similarity_multihop
    output_dir: similar
    config:
      QA_SIMILARITY_MULTIHOP_NUM_CHUNKS: 2
      QA_SIMILARITY_MULTIHOP_JOBS: [{QA_SIMILARITY_MULTIHOP_MODE: above, QA_SIMILARITY_MULTIHOP_THRESHOLD: -1, QA_GEN_VAR_QUESTION_STYLES: "easy"}]
"""
CHUNK = "hf_row_id string, document_id string, document_name string, chunk_index int, chunk_type string, text string, seq long"
CLIENT = ScriptedClient((
    ("Avalie a conversa", "Fidelidade: 5\nCorreção: 5\nClareza: 5\nCoerência: 5\nDiversidade: 5"),
    ("Devolva somente", "Como se explica {key} diante do que foi dito?"),
    ("Você responde", "A explicação completa está em {key}, conforme o documento."),
))


@pytest.fixture
def ctx(spark, rows):
    chunks = rows(CHUNK, *[(str(i), "d" if i < 3 else "e", "N", i, "content", f"content number {i} about topic {i * 7}", i) for i in range(5)])
    return Context(spark, CLIENT, HashEmbedder(256), chunks)


def test_registry():
    assert {"qa_gen", "qa_gen_var", "qa_local_multihop", "qa_similarity_multihop", "rewrite_gen", "dog_instruct", "answer_rewrite", "conv_expand", "conv_expand_var", "qa_filter", "conv_filter", "judge", "embed_filter", "chroma_preprocess"} <= set(list_phases())
    with pytest.raises(ValueError, match="already"):
        register(get_phase("judge"))
    with pytest.raises(ValueError, match="no name"):
        register(Phase("", Role.FILTER, (), (), lambda r, c: r))
    with pytest.raises(KeyError):
        get_phase("nothing")


def test_transitions():
    of = get_phase
    assert of("qa_filter").check_after(of("qa_gen_var")) == []
    assert of("conv_filter").check_after(of("judge")) == []
    with pytest.raises(ValueError, match="can't follow"):
        of("judge").check_after(of("embed_filter"))
    assert len(of("judge").check_after(of("embed_filter"), force=True)) == 1
    with pytest.raises(TypeError, match="messages"):
        of("conv_filter").check_after(of("qa_gen_var"), force=True)
    with pytest.raises(ValueError):
        of("qa_gen").check_after(of("qa_filter"))


def test_yaml_errors():
    for bad in ("pipeline: []", "pipeline: [{phase: qa_gen}]", "runs: []\ntail: []", "runs: [{generator: qa_gen}]\ntail: [{phase: qa_filter, output: x}]"):
        with pytest.raises(ValueError):
            pipeline.parse(bad)
    with pytest.raises(ValueError, match="DATASET_DOC_NAME_FIELD"):
        pipeline.check_settings({})


def test_single_pipeline(ctx, tmp_path):
    plan = pipeline.parse(SINGLE)
    result, empty = pipeline.run(plan, ctx, str(tmp_path))[""]
    found = result.collect()
    assert empty == [] and len(found) == 10 and [r["id"] for r in sorted(found, key=lambda r: r["id"])] == list(range(10))
    assert all(len(r["messages"]) in (4, 6) and r["avg_score"] == 5.0 for r in found)
    again, _ = pipeline.run_steps(plan.steps, ctx, str(tmp_path), only="conv_filter", env=plan.env)
    assert again.count() == 10
    assert pipeline.dry_run(plan, ctx) == {"qa_gen_var": 10}
    assert "# judge" in pipeline.dump_prompts(plan)
    final, rounds = pipeline.run_retries(plan.steps, ctx, str(tmp_path), 2, plan.env)
    assert rounds == 0 and final.count() == 10


def test_resume_adds_only_what_is_new(ctx, rows, tmp_path):
    from dataclasses import replace

    plan, all_chunks = pipeline.parse(SINGLE), ctx.corpus
    part = replace(ctx, corpus=all_chunks.where("seq < 3"))
    first = {tuple(r["sample_id"]): r["id"] for r in pipeline.run(plan, part, str(tmp_path), resume=True)[""][0].where("question_style = 'easy'").collect()}
    assert len(first) == 3
    again = pipeline.run(plan, part, str(tmp_path), resume=True)[""][0]
    assert again.count() == 6
    more = pipeline.run(plan, ctx, str(tmp_path), resume=True)[""][0].collect()
    assert len(more) == 10 and len({r["id"] for r in more}) == 10
    assert {k: v for k, v in ((tuple(r["sample_id"]), r["id"]) for r in more if r["question_style"] == "easy") if k in first} == first


def test_empty_output_is_reported(ctx, tmp_path):
    plan = pipeline.parse(SINGLE.replace("DATASET_MIN_CHARS: 5", "DATASET_MIN_CHARS: 500"))
    results = pipeline.run(plan, ctx, str(tmp_path))
    assert "qa_gen_var" in pipeline.empty_summary(results)


def test_runs(ctx, tmp_path):
    plan = pipeline.parse(RUNS % (tmp_path / "store"))
    results = pipeline.run(plan, ctx, str(tmp_path))
    assert results["local"][0].count() == 2 and results["similar"][0].count() > 0
    merged = pipeline.merged(results)
    assert sorted(r["id"] for r in merged.collect()) == list(range(merged.count()))
    assert pipeline.dry_run(plan, ctx) == {"qa_local_multihop": 2, "qa_similarity_multihop": results["similar"][0].count()}


def test_expansion(rows):
    sample = "array<struct<hf_row_id:string,text:string,document_name:string>>"
    df = rows(f"id long, sample_id array<string>, sample_text {sample}, question string, answer string, question_style string", *[(i, ["s"], [("s", "text", "N")], f"q{i}", f"a{i}", "easy") for i in range(3)])
    sizes = lambda d: sorted(len(r["messages"]) for r in d.collect())
    assert sizes(edit.expand(df, CLIENT, turns=(3, 3))) == [8, 8, 8]
    silent = ScriptedClient((("Devolva somente", None),))
    assert edit.expand(df, silent).count() == 0
    half = ScriptedClient((("Devolva somente", "e depois?"), ("Você responde", None)))
    assert edit.expand(df, half).count() == 0  # three messages
    repeats = ScriptedClient((("Não repita", "seen {key}"), ("Devolva somente", "new {key}"), ("Você responde", "ok {key}")))
    first = {r["id"]: r["messages"][2]["content"][:3] for r in edit.expand(df, repeats, naive=False, turns=(1, 1)).collect()}
    assert first == {0: "new", 1: "see", 2: "see"}


def test_answers_are_kept(rows):
    sample = "array<struct<hf_row_id:string,text:string,document_name:string>>"
    df = rows(f"id long, sample_id array<string>, sample_text {sample}, question string, answer string", (0, ["s"], [("s", "t", "N")], "q", "old"))
    assert edit.rewrite_answers(df, ScriptedClient((("Melhore", None),))).first()["answer"] == "old"
    assert edit.rewrite_answers(df, ScriptedClient((("Melhore", " new "),))).first()["answer"] == "new"


def test_answers_are_stored_once(rows, tmp_path):
    df = rows("id long, p string", (1, "a"), (2, "a"), (3, "b"))
    store = str(tmp_path / "answers")
    first = respond(df, ScriptedClient((("a", "one"),)), "", F.col("p"), store=store).orderBy("id").collect()
    later = respond(df, ScriptedClient((("a", "two"), ("b", "two"))), "", F.col("p"), store=store).orderBy("id").collect()
    assert [r["response"] for r in first] == [r["response"] for r in later] and first[0]["response"] == "one"


def test_cli(capsys, tmp_path):
    assert cli.main(["--list-phases"]) == 0 and "judge" in capsys.readouterr().out
    (tmp_path / "p.yaml").write_text(SINGLE)
    assert cli.main(["--pipeline", str(tmp_path / "p.yaml"), "--dump-prompts", str(tmp_path / "out.txt")]) == 0
    assert "qa_gen_var" in (tmp_path / "out.txt").read_text()


def test_column_mapping(rows):
    from corpusloom.sources.corpus import mapped

    df = rows("key string, body string, title string, doc_key long, id string", *[(f"k{i}", f"text {i}", "T", i // 2, "other") for i in range(4)])
    settings = {"DATASET_ID_FIELD": "key", "DATASET_TEXT_FIELD": "body", "DATASET_DOC_ID_FIELD": "doc_key", "DATASET_DOC_NAME_FIELD": "title"}
    found = sorted((r["hf_row_id"], r["text"], r["document_name"], r["document_id"], r["chunk_index"], r["chunk_type"]) for r in mapped(df, settings).collect())
    assert found == [(f"k{i}", f"text {i}", "T", str(i // 2), i % 2, None) for i in range(4)]
    own = {r["hf_row_id"]: r["document_id"] for r in mapped(df.drop("doc_key"), {**settings, "DATASET_DOC_ID_FIELD": None}).collect()}
    assert own == {f"k{i}": f"k{i}" for i in range(4)}
    for broken in (df.drop("title"), df.limit(0), df.withColumn("body", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            mapped(broken, settings)


def test_command_line_edges(spark, rows, tmp_path):
    from corpusloom.models import HttpClient, TransformerEmbedder
    from corpusloom.sources import corpus

    with pytest.raises(SystemExit):
        cli.client_of({})
    assert isinstance(cli.client_of({}, True), ScriptedClient) and cli.client_of({"VLLM_BASE_URL": "http://h/v1", "VLLM_API_KEY": "k"}) == HttpClient("http://h/v1", "k")
    assert isinstance(cli.embedder_of({}), HashEmbedder) and cli.embedder_of({"EMBED_MODEL": "/models/m"}) == TransformerEmbedder("/models/m")
    for k in range(2):
        corpus.write_rows(rows("id long, question string", *[(i, f"q{k}{i}") for i in range(3)]), f"{tmp_path}/run{k}.jsonl")
    assert cli.merge([f"{tmp_path}/run0.jsonl", f"{tmp_path}/absent.jsonl", f"{tmp_path}/run1.jsonl"], f"{tmp_path}/all.jsonl") == 0
    assert sorted((r["id"], r["question"]) for r in corpus.read_any(spark, f"{tmp_path}/all.jsonl").collect()) == [(3 * k + i, f"q{k}{i}") for k in range(2) for i in range(3)]
    assert cli.merge([f"{tmp_path}/absent.jsonl"], f"{tmp_path}/none") == 1


def test_repeated_runs_ask_nothing(ctx, tmp_path):
    """Each phase's answers stay beside its output: the second run finds them, and a model that fails gives the same rows."""
    from dataclasses import replace

    from corpusloom.models import ScriptedClient as Scripted

    steps = pipeline.parse(SINGLE).steps[:2]
    first, _ = pipeline.run_steps(steps, ctx, str(tmp_path), env={"DATASET_MIN_CHARS": "5"})
    before = sorted((r["id"], r["question"]) for r in first.collect())
    again, _ = pipeline.run_steps(steps, replace(ctx, client=Scripted((("", None),))), str(tmp_path), env={"DATASET_MIN_CHARS": "5"})
    assert len(before) > 0 and sorted((r["id"], r["question"]) for r in again.collect()) == before
