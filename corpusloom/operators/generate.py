"""Generators: tasks from chunks, model calls, and rows parsed from the answers. Parsing is in Catalyst; only the calls are Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import prompts as P
from corpusloom.functions import text as X
from corpusloom.models import Client, Sampling, respond
from corpusloom.operators import similarity as S
from corpusloom.operators import tasks as T


def fill(template: str, **values: Column) -> Column:
    """The template with {name} replaced by columns."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(values[p], F.lit("")) for i, p in enumerate(parts) if p])


def _of(table: dict[str, str], name: str) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(name)), F.lit(""))


def _finish(rows: DataFrame, kind: str, order: list[str], limit: int) -> DataFrame:
    """Numbers rows in order of arrival, keeps exactly ``limit`` (all if negative)."""
    from corpusloom.sources.corpus import with_position

    numbered = with_position(rows, order).withColumn("id", F.col("position")).withColumn("origin_id", F.col("position")).drop("position")
    numbered = numbered.withColumn("GEN_TYPE", F.lit(kind)).withColumn("status", F.lit(None).cast("string")).withColumn("num_chunks", F.size("sample_id"))
    return numbered if limit < 0 else numbered.where(F.col("id") < limit)


def qa_pairs(chunks: DataFrame, client: Client, cfg: T.CorpusConfig = T.CorpusConfig(), *, done=None, retry=None, sampling=Sampling(), store=None, num_rows: int = -1) -> DataFrame:
    """Every pair of one answer a chunk; the style is the pair's place. Chunks without a pair to retry aren't asked about."""
    rows = T.valid_chunks(chunks, cfg, "pairs").withColumn("sample_id", F.array("hf_row_id")).withColumn("sample_text", T.sample_text()).withColumn("group_key", F.col("hf_row_id"))
    rows = T.pending(rows, done) if done is not None else rows
    if retry is not None:
        rows = rows.join(retry.select("group_key").distinct(), "group_key", "left_semi")
    asked = respond(rows, client, "", fill(P.PAIRS, documents=X.render_documents("sample_text")), sampling, store=store, keep=["seq", "sample_id", "sample_text", "group_key", "document_id"])
    pairs = asked.select("*", F.posexplode(X.parse_pairs("response")).alias("pair", "qa")).withColumn("question_style", F.col("pair").cast("string"))
    kept = T.only_pairs(pairs, retry).select("seq", "pair", "sample_id", "sample_text", "group_key", "question_style", "document_id", "qa.question", "qa.answer")
    return _finish(kept, "qa_gen", ["seq", "pair"], num_rows).drop("seq", "pair", "group_key")


def _first_pair(asked: DataFrame, keep: list[str]) -> DataFrame:
    qa = asked.withColumn("_qa", F.get(X.parse_pairs("response"), F.lit(0))).where("_qa is not null")
    return qa.select(*keep, "_qa.question", "_qa.answer")


_KEPT = ["sample_id", "sample_text", "question_style", "document_id"]


def qa_styled(chunks: DataFrame, client: Client, styles=("general", "specific", "compositional", "comparative"), cfg: T.CorpusConfig = T.CorpusConfig(), *, done=None, retry=None, sampling=Sampling(max_tokens=512), store=None, num_rows: int = -1) -> DataFrame:
    """One pair a valid chunk and style."""
    P.style_text(list(styles), P.STYLES)
    rows = T.style_tasks(chunks, list(styles), cfg, done=done, retry=retry)
    prompt = fill(P.STYLED, style=_of(P.STYLES, "question_style"), summary=F.col("doc_summary"), documents=X.render_documents("sample_text"))
    keep = ["seq", "style_index", *_KEPT]
    return _finish(_first_pair(respond(rows, client, "", prompt, sampling, store=store, keep=keep), keep), "qa_gen_var", ["seq", "style_index"], num_rows).drop("seq", "style_index")


def qa_local(store_rows: DataFrame, client: Client, styles=("general", "specific", "compositional", "comparative"), *, n: int = 3, stride: int = 1, summaries: DataFrame | None = None, done=None, retry=None, sampling=Sampling(max_tokens=512), store=None, num_rows: int = -1) -> DataFrame:
    """One pair a window of neighbouring chunks and style; unknown styles have no instruction."""
    rows = T.with_styles(T.with_summary(T.local_windows(store_rows, n, stride), summaries), list(styles))
    rows = T.only_pairs(T.pending_pairs(rows, done) if done is not None else rows, retry)
    prompt = fill(P.LOCAL, style=_of(P.STYLES, "question_style"), summary=F.col("doc_summary"), documents=X.render_documents("sample_text"))
    keep = ["start", "style_index", *_KEPT]
    found = _first_pair(respond(rows, client, "", prompt, sampling, store=store, keep=keep), keep)
    return _finish(found, "qa_local_multihop", ["document_id", "start", "style_index"], num_rows).drop("start", "style_index")


def similar_tasks(store_rows: DataFrame, jobs: list[S.Job], styles=("general", "specific", "compositional", "comparative"), *, constraint: str | None = None, min_docs: int = 1, num_chunks: int = 3, max_candidates: int = 200, used=None) -> DataFrame:
    """Similarity groups once a style of their job."""
    groups = S.similarity_groups(store_rows, jobs, used=used, num_chunks=num_chunks, constraint=constraint, min_docs=min_docs, max_candidates=max_candidates)
    named = F.element_at(F.array(*[F.array(*[F.lit(s) for s in (j.styles or styles)]) for j in jobs]), F.col("job_index") + 1)
    return groups.select("*", F.posexplode(named).alias("style_index", "question_style")).withColumn("document_id", F.element_at("document_ids", 1))


def qa_similar(store_rows: DataFrame, client: Client, jobs: list[S.Job], styles=("general", "specific", "compositional", "comparative"), *, constraint: str | None = None, min_docs: int = 1, num_chunks: int = 3, max_candidates: int = 200, summaries: DataFrame | None = None, used=None, retry=None, sampling=Sampling(max_tokens=512), store=None, num_rows: int = -1) -> DataFrame:
    """One pair a similarity group and style of its job, with the job's criteria."""
    of = lambda get, kind: F.element_at(F.array(*[F.lit(get(j)).cast(kind) for j in jobs]), F.col("job_index") + 1)
    rows = similar_tasks(store_rows, jobs, styles, constraint=constraint, min_docs=min_docs, num_chunks=num_chunks, max_candidates=max_candidates, used=used)
    if summaries is not None:
        blocks = rows.select("seed", "job_index", "style_index", F.posexplode(F.array_distinct("document_ids")).alias("pos", "document_id"))
        blocks = T.with_summary(blocks, summaries).groupBy("seed", "job_index", "style_index").agg(F.array_sort(F.collect_list(F.struct("pos", "doc_summary"))).alias("b"))
        rows = rows.join(blocks.select("seed", "job_index", "style_index", F.array_join("b.doc_summary", "").alias("doc_summary")), ["seed", "job_index", "style_index"])
    else:
        rows = rows.withColumn("doc_summary", F.lit(""))
    rows = T.only_pairs(rows, retry)
    facts = dict(style=_of(P.STYLES, "question_style"), summary=F.col("doc_summary"), documents=X.render_documents("sample_text"))
    prompt = F.when(of(lambda j: j.positive, "boolean"), fill(P.NEAR, **facts)).otherwise(fill(P.FAR, **facts))
    keep = ["seed", "job_index", "style_index", "chunk_group_similarity", *_KEPT]
    found = _first_pair(respond(rows, client, "", prompt, sampling, store=store, keep=keep), keep)
    found = found.withColumn("doc_constraint", F.lit(constraint).cast("string")).withColumn("similarity_job_index", F.col("job_index"))
    for name, get, kind in (("similarity_mode", lambda j: j.mode, "string"), ("similarity_threshold", lambda j: j.threshold, "double"), ("similarity_min", lambda j: j.least, "double"), ("similarity_max", lambda j: j.most, "double"), ("min_matching_words", lambda j: j.min_words, "int")):
        found = found.withColumn(name, of(get, kind))
    return _finish(found, "qa_similarity_multihop", ["seed", "job_index", "style_index"], num_rows).drop("seed", "job_index", "style_index")


def _talk(rows: DataFrame, request: str, answer: Column) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return rows.withColumn("messages", F.array(turn("user", F.col(request)), turn("assistant", answer)))


def rewrites(chunks: DataFrame, client: Client, styles=("summary", "simplify", "focus"), cfg: T.CorpusConfig = T.CorpusConfig(), *, done=None, retry=None, ask=Sampling(0.9, 0.95, 256), answer=Sampling(), store=None, num_rows: int = -1) -> DataFrame:
    """A request, then its fulfilment, a valid chunk and style; a blank on either side drops the row. Summary chunks are used."""
    P.style_text(list(styles), P.REWRITES)
    rows = T.style_tasks(chunks, list(styles), cfg, kind="rewrite", done=done, retry=retry)
    docs = X.render_documents("sample_text")
    asked = respond(rows, client, "", fill(P.REWRITE_ASK, style=_of(P.REWRITES, "question_style"), documents=docs), ask, store=store, keep=["seq", "style_index", *_KEPT])
    asked = asked.withColumn("request", X.strip("response")).where("request <> ''").drop("response")
    told = respond(asked, client, "", fill(P.REWRITE_DO, request=F.col("request"), documents=docs), answer, store=store)
    told = told.withColumn("_a", X.strip("response")).where("_a <> ''")
    return _finish(_talk(told, "request", F.col("_a")).select("seq", "style_index", *_KEPT, "messages"), "rewrite_gen", ["seq", "style_index"], num_rows).drop("seq", "style_index")


def personas(chunks: DataFrame, client: Client, names=tuple(P.PERSONAS), cfg: T.CorpusConfig = T.CorpusConfig(), *, done=None, retry=None, ask=Sampling(0.7, 0.9, 256), answer=Sampling(0.4, 0.9, 1024), store=None, num_rows: int = -1) -> DataFrame:
    """A question in a persona's voice, then the chunk rewritten as its answer; without an answer, the chunk itself. No question drops the row."""
    P.style_text(list(names), P.PERSONAS)
    rows = T.style_tasks(chunks, list(names), cfg, done=done, retry=retry)
    docs = X.render_documents("sample_text")
    facts = dict(summary=F.col("doc_summary"), documents=docs)
    asked = respond(rows, client, "", fill(P.PERSONA_ASK, style=_of(P.PERSONAS, "question_style"), **facts), ask, store=store, keep=["seq", "style_index", *_KEPT, "text", "doc_summary"])
    asked = asked.withColumn("request", X.without_label("response", "pergunta", True)).where("request <> ''").drop("response")
    told = respond(asked, client, "", fill(P.PERSONA_DO, request=F.col("request"), **facts), answer, store=store)
    given = X.without_label(F.coalesce("response", F.lit("")), "resposta")
    return _finish(_talk(told, "request", F.when(given == "", F.col("text")).otherwise(given)).select("seq", "style_index", *_KEPT, "messages"), "dog_instruct", ["seq", "style_index"], num_rows).drop("seq", "style_index")


def estimate(tasks: DataFrame, per_task: int = 1, num_rows: int = -1) -> DataFrame:
    """One row: how many rows a generator would ask for, without asking."""
    n = F.count(F.lit(1)) * per_task
    return tasks.agg((n if num_rows < 0 else F.least(n, F.lit(num_rows))).cast("long").alias("estimate"))


__all__ = ["estimate", "fill", "personas", "qa_local", "qa_pairs", "qa_similar", "qa_styled", "rewrites", "similar_tasks"]
