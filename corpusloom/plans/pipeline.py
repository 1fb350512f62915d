"""Pipelines from YAML: a chain of phases, or several generators sharing a tail, with dry runs and prompt dumps.

Phases are lazy DataFrame transforms. A phase's rows are written where its ``output`` says, and the next reads them there, so that
model calls are never repeated by later actions, and each phase's answers are kept beside its output for runs that are repeated. Retries ask anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import filters, retry
from corpusloom.plans.phases import Context, Phase, Role, get_phase
from corpusloom.sources.corpus import has_path, mapped, merge_runs
from corpusloom.sources.tables import persisted

#: Settings that a run must have.
REQUIRED_SETTINGS = ("DATASET_DOC_NAME_FIELD",)


@dataclass(frozen=True)
class Step:
    phase: str
    output: str
    config: dict = field(default_factory=dict)
    force: bool = False


@dataclass(frozen=True)
class Plan:
    """A single chain (``steps``), or ``runs`` of (generator step, folder) with a shared ``tail``."""

    steps: tuple[Step, ...] = ()
    env: dict = field(default_factory=dict)
    retries: int = 0
    preprocess: Step | None = None
    tail: tuple[Step, ...] = ()
    runs: tuple[tuple[Step, str], ...] = ()


def _step(raw: dict) -> Step:
    for key in ("phase", "output"):
        if not raw.get(key):
            raise ValueError(f"a pipeline entry has no {key}: {raw}")
    return Step(raw["phase"], raw["output"], dict(raw.get("config") or {}), bool(raw.get("force", False)))


def parse(text: str) -> Plan:
    import yaml

    raw = yaml.safe_load(text) or {}
    env, retries = {k: str(v) for k, v in (raw.get("env") or {}).items()}, int(raw.get("retry_max_attempts", 0))
    if "runs" in raw:
        if not raw["runs"] or not raw.get("tail"):
            raise ValueError("a plan of runs needs runs and a tail")
        runs = []
        for r in raw["runs"]:
            if not r.get("generator") or not r.get("output_dir"):
                raise ValueError(f"a run needs a generator and an output_dir: {r}")
            runs.append((Step(r["generator"], f"{r['generator']}.jsonl", dict(r.get("config") or {})), r["output_dir"]))
        pre = raw.get("preprocess")
        return Plan(env=env, retries=retries, preprocess=Step(pre["phase"], "", dict(pre.get("config") or {})) if pre else None, tail=tuple(map(_step, raw["tail"])), runs=tuple(runs))
    if not raw.get("pipeline"):
        raise ValueError("the pipeline is empty")
    return Plan(tuple(map(_step, raw["pipeline"])), env, retries)


def load(path: str) -> Plan:
    return parse(Path(path).read_text(encoding="utf-8"))


def check_settings(settings: dict) -> None:
    if absent := [k for k in REQUIRED_SETTINGS if not settings.get(k)]:
        raise ValueError(f"these settings are required: {', '.join(absent)}")


def validate(steps: tuple[Step, ...]) -> tuple[list[Phase], list[str]]:
    """The phases, and warnings of forced transitions."""
    phases, warnings = [get_phase(s.phase) for s in steps], []
    for before, after, step in zip(phases, phases[1:], steps[1:], strict=False):
        warnings += after.check_after(before, step.force)
    return phases, warnings


def run_steps(steps: tuple[Step, ...], ctx: Context, folder: str = "", *, start_from: str | None = None, only: str | None = None, source: DataFrame | None = None, output: str | None = None, env: dict | None = None, resume: bool = False) -> tuple[DataFrame, list[str]]:
    """Runs the chain, each step's rows written as Parquet under its output; returns the last rows and the names of steps that gave none.

    ``start_from`` and ``only`` name a step; it reads ``source``, or what the step before wrote. With ``resume``, a step whose output is
    there already adds to it what is new: a generator skips finished chunks, windows and pairs, and others the rows that they have seen, which
    are kept beside the output; greedy filters compare new rows with what they kept before.
    """
    phases, _ = validate(steps)
    names = [s.phase for s in steps]
    for name in (start_from, only):
        if name is not None and name not in names:
            raise ValueError(f"the pipeline has no step {name}")
    first = names.index(only or start_from) if (only or start_from) else 0
    last = first if only else len(steps) - 1
    at = lambda k: f"{folder.rstrip('/')}/{steps[k].output}" if folder else steps[k].output
    rows = source if source is not None else (ctx.spark.read.parquet(at(first - 1)) if first else None)
    empty = []
    for k in range(first, last + 1):
        own = replace(ctx, config={**(env or {}), **ctx.config, **steps[k].config})
        path = output if output and k == last else at(k)
        own = replace(own, store=f"{path}.answers")
        if resume:
            _add(phases[k], rows, own, path)
        else:
            phases[k].run(rows, own).write.mode("overwrite").parquet(path)
        rows = ctx.spark.read.parquet(path)
        if phases[k].role is not Role.PREPROCESS and rows.isEmpty():
            empty.append(steps[k].phase)
    return rows, empty


def _add(phase: Phase, rows: DataFrame | None, ctx: Context, path: str) -> None:
    """One step of a resumed run. Seen rows are written last, so a step that broke off does its rows again."""
    spark, seen = ctx.spark, f"{path}.seen"
    old = spark.read.parquet(path) if has_path(spark, path) else None
    if rows is not None and has_path(spark, seen):
        rows = rows.join(spark.read.parquet(seen), "id", "left_anti")
    rows = persisted(rows) if rows is not None else None
    new = phase.run(rows, replace(ctx, done=old, survivors=old))
    if old is not None:
        last = old.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("m")).first()["m"]
        new = new.withColumn("id", F.col("id") + last + 1)
        if phase.role is Role.GENERATOR:
            new = new.withColumn("origin_id", F.col("id"))
    persisted(new).write.mode("append").parquet(path)
    if rows is not None:
        rows.select("id").write.mode("append").parquet(seen)


def run_retries(steps: tuple[Step, ...], ctx: Context, folder: str, attempts: int, env: dict | None = None) -> tuple[DataFrame, int]:
    """Tries again what the chain lost; its last step must deduplicate. The results go beside the first ones."""
    phases, _ = validate(steps)
    if len(steps) < 2 or phases[-1].role is not Role.DEDUP:
        raise ValueError("retries need at least two steps, the last of them dedup")
    at = lambda k: f"{folder.rstrip('/')}/{steps[k].output}" if folder else steps[k].output
    configured = lambda k: replace(ctx, config={**(env or {}), **ctx.config, **steps[k].config})

    def generate(pairs: DataFrame) -> DataFrame:
        return phases[0].run(None, replace(configured(0), retry=pairs, num_rows=-1))

    def middle(rows: DataFrame) -> DataFrame:
        for k in range(1, len(steps) - 1):
            rows = phases[k].run(rows, configured(k))
        return rows

    def dedup(new: DataFrame, survivors: DataFrame) -> DataFrame:
        from corpusloom.functions import text as X
        from corpusloom.models import embed

        own = configured(len(steps) - 1)
        mark = lambda d: d.withColumn("_v", embed(own.embedder, X.conversation_text("messages")))
        return filters.embed_filter_against(mark(new), mark(survivors), own.get("EMBED_FILTER_SIMILARITY_THRESHOLD", 0.95), "_v").drop("_v")

    output, final, rounds = retry.retry_until(generate, middle, dedup, ctx.spark.read.parquet(at(0)), ctx.spark.read.parquet(at(len(steps) - 1)), attempts)
    output.write.mode("overwrite").parquet(f"{at(0)}.retried")
    final.write.mode("overwrite").parquet(f"{at(len(steps) - 1)}.retried")
    return ctx.spark.read.parquet(f"{at(len(steps) - 1)}.retried"), rounds


def ready(plan: Plan, ctx: Context) -> Context:
    """The context with its settings checked and its corpus's columns named as they say."""
    settings = {**plan.env, **ctx.config}
    check_settings(settings)
    return ctx if ctx.corpus is None else replace(ctx, corpus=mapped(ctx.corpus, settings))


def run(plan: Plan, ctx: Context, folder: str = "", **options) -> dict[str, tuple[DataFrame, list[str]]]:
    """All of a plan: by run (or "" for a single chain) its last rows and empty steps."""
    ctx = ready(plan, ctx)
    if not plan.runs:
        result = run_steps(plan.steps, ctx, folder, env=plan.env, **options)
        if plan.retries:
            result = (run_retries(plan.steps, ctx, folder, plan.retries, plan.env)[0], result[1])
        return {"": result}
    if plan.preprocess:
        get_phase(plan.preprocess.phase).run(None, replace(ctx, config={**plan.env, **ctx.config, **plan.preprocess.config}))
    out = {}
    for step, where in plan.runs:
        steps = (step, *plan.tail)
        path = f"{folder.rstrip('/')}/{where}" if folder else where
        own = replace(ctx, num_rows=int(step.config.get("NUM_ROWS", ctx.num_rows)))
        env = {**plan.env, **(plan.preprocess.config if plan.preprocess else {})}
        out[where] = run_steps(steps, own, path, env=env, **options)
        if plan.retries:
            out[where] = (run_retries(steps, own, path, plan.retries, env)[0], out[where][1])
    return out


def merged(results: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return merge_runs([rows for rows, _ in results.values()])


def dry_run(plan: Plan, ctx: Context) -> dict[str, int | None]:
    """What each generator would ask for; nothing is asked or written."""
    ctx = ready(plan, ctx)
    chains = [((step, *plan.tail), {**plan.env, **(plan.preprocess.config if plan.preprocess else {})}) for step, _ in plan.runs] or [(plan.steps, plan.env)]
    out = {}
    for steps, env in chains:
        validate(steps)
        own = replace(ctx, config={**env, **ctx.config, **steps[0].config}, num_rows=int(steps[0].config.get("NUM_ROWS", ctx.num_rows)))
        out[steps[0].phase] = get_phase(steps[0].phase).estimate(own)
    return out


def dump_prompts(plan: Plan) -> str:
    """All prompts that the plan's phases may send."""
    steps = [*([plan.preprocess] if plan.preprocess else []), *plan.steps, *[s for s, _ in plan.runs], *plan.tail]
    parts = [f"# {p.name}: {title}\n\n{text}\n" for p in (get_phase(s.phase) for s in steps) for title, text in p.prompts]
    return "\n".join(parts)


def empty_summary(results: dict[str, tuple[DataFrame, list[str]]]) -> str:
    return "\n".join(f"{where or 'pipeline'}: {', '.join(empty)} gave no rows" for where, (_, empty) in results.items() if empty)


__all__ = ["Plan", "Step", "check_settings", "dry_run", "dump_prompts", "empty_summary", "load", "merged", "parse", "run", "run_retries", "run_steps", "validate"]
