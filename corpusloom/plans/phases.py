"""Phases: what may follow what, what columns each needs and gives, and a registry by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from corpusloom import prompts as P
from corpusloom.functions import text as X
from corpusloom.models import Client, HashEmbedder, Sampling, ScriptedClient, embed
from corpusloom.operators import edit, filters, generate
from corpusloom.operators import tasks as T
from corpusloom.operators.retry import keyed
from corpusloom.operators.similarity import Job, used_pairs
from corpusloom.schemas import REQUIRED, missing
from corpusloom.sources import store as vectors


class Role(Enum):
    PREPROCESS = "preprocess"
    GENERATOR = "generator"
    EDITOR = "editor"
    FILTER = "filter"
    JUDGE = "judge"
    DEDUP = "dedup"


#: The roles that may follow a role. Preprocessing stands outside the chain; nothing leads to a generator.
FOLLOWS = {
    Role.GENERATOR: {Role.EDITOR, Role.FILTER, Role.JUDGE, Role.DEDUP},
    Role.EDITOR: {Role.EDITOR, Role.FILTER, Role.JUDGE, Role.DEDUP},
    Role.FILTER: {Role.EDITOR, Role.FILTER, Role.JUDGE, Role.DEDUP},
    Role.JUDGE: {Role.FILTER, Role.DEDUP},
    Role.DEDUP: {Role.EDITOR, Role.FILTER},
}


@dataclass
class Context:
    """What phases are given beside rows; nothing is read from or written to the environment."""

    spark: SparkSession
    client: Client = ScriptedClient()
    embedder: Any = field(default_factory=HashEmbedder)
    corpus: DataFrame | None = None
    config: dict[str, Any] = field(default_factory=dict)
    num_rows: int = -1
    retry: DataFrame | None = None
    #: Where a phase keeps model answers by prompt, so that a run that is repeated doesn't ask again; None keeps them for the run alone.
    store: str | None = None
    #: Of an earlier run of the phase: a generator's rows, and what a greedy filter kept.
    done: DataFrame | None = None
    survivors: DataFrame | None = None

    def get(self, key: str, default):
        """A setting as the default's type; lists come from text split at commas."""
        value = self.config.get(key, default)
        if isinstance(default, bool):
            return value if isinstance(value, bool) else str(value).lower() in ("1", "true", "yes")
        if isinstance(default, (tuple, list)):
            return tuple(s.strip() for s in value.split(",") if s.strip()) if isinstance(value, str) else tuple(value)
        return type(default)(value) if default is not None and value is not None else value

    def sampling(self, prefix: str, default: Sampling) -> Sampling:
        return Sampling(self.get(f"{prefix}_TEMPERATURE", default.temperature), self.get(f"{prefix}_TOP_P", default.top_p), self.get(f"{prefix}_MAX_TOKENS", default.max_tokens))

    def corpus_config(self) -> T.CorpusConfig:
        return T.CorpusConfig(self.get("DATASET_MIN_CHARS", 800), self.get("DATASET_MAX_CHARS", 120_000), self.get("DATASET_CHUNK_TYPE_FIELD", "chunk_type"), self.get("DATASET_SUMMARY_TYPE_VALUE", "summary"), self.get("DATASET_SUMMARY_ENABLED", False))


@dataclass(frozen=True)
class Phase:
    name: str
    role: Role
    needs: tuple[str, ...]
    gives: tuple[str, ...]
    transform: Callable[[DataFrame | None, Context], DataFrame]
    prompts: tuple[tuple[str, str], ...] = ()
    per_task: int = 1
    tasks: Callable[[Context], DataFrame] | None = None

    def check_after(self, before: Phase, force: bool = False) -> list[str]:
        """Raises if this phase can't follow; ``force`` turns a role clash, never a missing column, into a warning, which is returned."""
        warnings = []
        if self.role not in FOLLOWS.get(before.role, set()):
            said = f"{self.name} ({self.role.value}) can't follow {before.name} ({before.role.value})"
            if not force:
                raise ValueError(said)
            warnings.append(said)
        if lacking := [c for c in self.needs if c not in before.gives]:
            raise TypeError(f"{self.name} needs {', '.join(lacking)}, which {before.name} doesn't give")
        return warnings

    def estimate(self, ctx: Context) -> int | None:
        """How many rows the phase would ask a model for; None where that depends on its input rows."""
        return None if self.tasks is None else generate.estimate(self.tasks(ctx), self.per_task, ctx.num_rows).first()[0]

    def run(self, rows: DataFrame | None, ctx: Context) -> DataFrame:
        if rows is not None and (lacking := [c for c in self.needs if c not in rows.columns]):
            raise TypeError(f"{self.name} needs {', '.join(lacking)}")
        return self.transform(rows, ctx)


_PHASES: dict[str, Phase] = {}


def register(phase: Phase) -> Phase:
    if not phase.name:
        raise ValueError("a phase has no name")
    if phase.name in _PHASES:
        raise ValueError(f"there is a phase named {phase.name} already")
    _PHASES[phase.name] = phase
    return phase


def get_phase(name: str) -> Phase:
    if name not in _PHASES:
        raise KeyError(f"no phase is named {name}; there are {', '.join(list_phases())}")
    return _PHASES[name]


def list_phases() -> list[str]:
    return sorted(_PHASES)


_QA = REQUIRED["styled_qa"] + ("document_id", "GEN_TYPE", "status")
_TALK = REQUIRED["conversation"] + ("question_style", "document_id", "GEN_TYPE", "status")
_STYLES = ("general", "specific", "compositional", "comparative")


def _styles(ctx: Context) -> tuple[str, ...]:
    return ctx.get("QA_GEN_VAR_QUESTION_STYLES", _STYLES)


def _store(ctx: Context) -> DataFrame:
    path = f"{ctx.get('CHROMA_PERSIST_DIR', 'store')}/{ctx.get('CHROMA_VECTORSTORE_NAME', 'chunks')}"
    return ctx.spark.read.parquet(path)


def _preprocess(_, ctx: Context) -> DataFrame:
    path = f"{ctx.get('CHROMA_PERSIST_DIR', 'store')}/{ctx.get('CHROMA_VECTORSTORE_NAME', 'chunks')}"
    return vectors.build(ctx.corpus, path, lambda t: embed(ctx.embedder, t), force=ctx.get("CHROMA_FORCE_REBUILD", False), id_field="hf_row_id", order="seq")


def jobs_of(config: dict) -> list[Job]:
    raw = config.get("QA_SIMILARITY_MULTIHOP_JOBS") or [{"QA_SIMILARITY_MULTIHOP_MODE": "above", "QA_SIMILARITY_MULTIHOP_THRESHOLD": 0.8}]
    key = "QA_SIMILARITY_MULTIHOP_"
    split = lambda s: tuple(x.strip() for x in s.split(",") if x.strip()) if isinstance(s, str) else tuple(s or ())
    number = lambda v: None if v is None else float(v)
    return [Job(j.get(f"{key}MODE", "above"), number(j.get(f"{key}THRESHOLD")), number(j.get(f"{key}MIN")), number(j.get(f"{key}MAX")), j.get(f"{key}MIN_MATCHING_WORDS"), split(j.get("QA_GEN_VAR_QUESTION_STYLES"))) for j in raw]


def _summaries(ctx: Context) -> DataFrame | None:
    cfg = ctx.corpus_config()
    return T.doc_summaries(ctx.corpus, cfg) if cfg.summaries and ctx.corpus is not None else None


def _groups(ctx: Context) -> dict[str, Any]:
    key = "QA_SIMILARITY_MULTIHOP_"
    return {
        "constraint": ctx.config.get(f"{key}DOC_CONSTRAINT"), "min_docs": ctx.get(f"{key}MIN_DOCS", 1), "num_chunks": ctx.get(f"{key}NUM_CHUNKS", 3), "max_candidates": ctx.get(f"{key}MAX_CANDIDATES", 200),
        "used": None if ctx.done is None else used_pairs(ctx.done, "failed"),
    }


def _similar(_, ctx: Context) -> DataFrame:
    return generate.qa_similar(_store(ctx), ctx.client, jobs_of(ctx.config), _styles(ctx), summaries=_summaries(ctx), retry=ctx.retry, num_rows=ctx.num_rows, store=ctx.store, sampling=ctx.sampling("QA_SIMILARITY_MULTIHOP", Sampling(max_tokens=512)), **_groups(ctx))


def _local(_, ctx: Context) -> DataFrame:
    done = None if ctx.done is None else keyed(open_again(ctx.done))
    return generate.qa_local(_store(ctx), ctx.client, _styles(ctx), n=ctx.get("QA_LOCAL_MULTIHOP_NUM_CHUNKS", 3), stride=ctx.get("QA_LOCAL_MULTIHOP_WINDOW_STRIDE", 1), summaries=_summaries(ctx), done=done, retry=ctx.retry, num_rows=ctx.num_rows, store=ctx.store, sampling=ctx.sampling("QA_LOCAL_MULTIHOP", Sampling(max_tokens=512)))


def open_again(output: DataFrame) -> DataFrame:
    """Finished rows: those marked failed may be generated again."""
    return output.where("status is null or status <> 'failed'") if "status" in output.columns else output


def _by_chunk(generator, *names: tuple[str, tuple], sampling: tuple[str, Sampling] | None = None):
    """A generator over the corpus, with what its settings name."""

    def run(_, ctx: Context) -> DataFrame:
        more = {"sampling": ctx.sampling(*sampling)} if sampling else {}
        done = None if ctx.done is None else open_again(ctx.done)
        return generator(ctx.corpus, ctx.client, *[ctx.get(key, default) for key, default in names], cfg=ctx.corpus_config(), done=done, retry=ctx.retry, num_rows=ctx.num_rows, store=ctx.store, **more)

    return run


def _qa_filter(rows: DataFrame, ctx: Context) -> DataFrame:
    limits = (ctx.get("QA_FILTER_MIN_ANSWER_LEN", 10), ctx.get("QA_FILTER_LEVENSHTEIN_THRESHOLD", 20))
    if ctx.survivors is None:
        return filters.qa_filter(rows, *limits, number=True)
    kept = filters.qa_filter_against(rows, ctx.survivors, *limits)
    return filters._numbered(kept, X.group_key("sample_id"))


def _expand(prefix: str, styled: bool):
    def run(rows: DataFrame, ctx: Context) -> DataFrame:
        turns = (ctx.get(f"{prefix}_N_USER_TURNS_MIN", 3), ctx.get(f"{prefix}_N_USER_TURNS_MAX", 3))
        return edit.expand(rows, ctx.client, ctx.get(f"{prefix}_QUESTION_STYLES", _STYLES), naive=ctx.get(f"{prefix}_NAIVE_GEN", True), turns=turns, full_history=ctx.get(f"{prefix}_FULL_HISTORY_FOR_USER_TURN", False), styled=styled, summaries=_summaries(ctx), number=True)

    return run


def _embed_filter(rows: DataFrame, ctx: Context) -> DataFrame:
    mark = lambda df: df.withColumn("_v", embed(ctx.embedder, X.conversation_text("messages")))
    least = ctx.get("EMBED_FILTER_SIMILARITY_THRESHOLD", 0.95)
    if ctx.survivors is None:
        return filters.embed_filter(mark(rows), least, "_v", number=True).drop("_v")
    kept = filters.embed_filter_against(mark(rows), mark(ctx.survivors), least, "_v").drop("_v")
    return filters._numbered(kept, X.group_key("sample_id"))


_styled_tasks = lambda ctx: T.style_tasks(ctx.corpus, list(_styles(ctx)), ctx.corpus_config())
_ALL_PERSONAS = tuple(P.PERSONAS)

for _phase in (
    Phase("chroma_preprocess", Role.PREPROCESS, (), (), _preprocess),
    Phase("qa_gen", Role.GENERATOR, (), _QA, _by_chunk(generate.qa_pairs, sampling=("QA_GEN", Sampling())), (("pairs", P.PAIRS),), 3, lambda c: T.valid_chunks(c.corpus, c.corpus_config(), "pairs")),
    Phase("qa_gen_var", Role.GENERATOR, (), _QA, _by_chunk(generate.qa_styled, ("QA_GEN_VAR_QUESTION_STYLES", _STYLES), sampling=("QA_GEN_VAR", Sampling(max_tokens=512))), (("styled", P.STYLED),), 1, _styled_tasks),
    Phase("qa_local_multihop", Role.GENERATOR, (), _QA, _local, (("local", P.LOCAL),), 1, lambda c: T.with_styles(T.local_windows(_store(c), c.get("QA_LOCAL_MULTIHOP_NUM_CHUNKS", 3), c.get("QA_LOCAL_MULTIHOP_WINDOW_STRIDE", 1)), list(_styles(c)))),
    Phase("qa_similarity_multihop", Role.GENERATOR, (), _QA, _similar, (("near", P.NEAR), ("far", P.FAR)), 1, lambda c: generate.similar_tasks(_store(c), jobs_of(c.config), _styles(c), **_groups(c))),
    Phase("rewrite_gen", Role.GENERATOR, (), _TALK, _by_chunk(generate.rewrites, ("REWRITE_GEN_STYLES", tuple(P.REWRITES))), (("ask", P.REWRITE_ASK), ("do", P.REWRITE_DO)), 1, lambda c: T.style_tasks(c.corpus, list(c.get("REWRITE_GEN_STYLES", tuple(P.REWRITES))), c.corpus_config(), kind="rewrite")),
    Phase("dog_instruct", Role.GENERATOR, (), _TALK, _by_chunk(generate.personas, ("DOG_INSTRUCT_PERSONAS", _ALL_PERSONAS)), (("ask", P.PERSONA_ASK), ("do", P.PERSONA_DO)), 1, lambda c: T.style_tasks(c.corpus, list(c.get("DOG_INSTRUCT_PERSONAS", _ALL_PERSONAS)), c.corpus_config())),
    Phase("answer_rewrite", Role.EDITOR, REQUIRED["qa"], _QA, lambda r, c: edit.rewrite_answers(r, c.client, store=c.store, number=True), (("answer", P.ANSWER),)),
    Phase("conv_expand", Role.EDITOR, REQUIRED["qa"], _TALK, _expand("CONV_EXPAND", False), (("user", P.USER_TURN), ("assistant", P.ASSISTANT_TURN))),
    Phase("conv_expand_var", Role.EDITOR, REQUIRED["styled_qa"], _TALK, _expand("CONV_EXPAND_VAR", True), (("user", P.USER_TURN), ("across", P.USER_TURN_ACROSS), ("assistant", P.ASSISTANT_TURN))),
    Phase("qa_filter", Role.FILTER, REQUIRED["qa"], _QA, _qa_filter),
    Phase("conv_filter", Role.FILTER, REQUIRED["conversation"], _TALK, lambda r, c: filters.conv_filter(r, c.get("CONV_FILTER_MIN_MESSAGES", 4), c.get("CONV_FILTER_MIN_ASSISTANT_LEN", 10), c.get("CONV_FILTER_LEVENSHTEIN_USER", 20), c.get("CONV_FILTER_LEVENSHTEIN_ADJACENT", 20), number=True)),
    Phase("judge", Role.JUDGE, REQUIRED["conversation"], (*_TALK, "scores", "avg_score"), lambda r, c: edit.judge(r, c.client, store=c.store, sampling=c.sampling("JUDGE", Sampling(0.0, 0.9, 2048)), least=c.get("JUDGE_MIN_AVG_SCORE", 4.0), number=True), (("judge", P.JUDGE),)),
    Phase("embed_filter", Role.DEDUP, REQUIRED["conversation"], _TALK, _embed_filter),
):
    register(_phase)

__all__ = ["Context", "FOLLOWS", "Phase", "Role", "get_phase", "jobs_of", "list_phases", "missing", "register"]
