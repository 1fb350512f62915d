"""Command line: ``python -m corpusloom.plans.cli --pipeline plan.yaml --corpus chunks.parquet``."""

from __future__ import annotations

import argparse

from corpusloom.models import HashEmbedder, HttpClient, ScriptedClient, TransformerEmbedder
from corpusloom.plans import pipeline
from corpusloom.plans.phases import Context, list_phases
from corpusloom.sources import corpus


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    p.add_argument("--pipeline")
    p.add_argument("--corpus", help="a Parquet, JSON lines or CSV table of chunks; DATASET_* settings name its columns")
    p.add_argument("--scripted", action="store_true", help="answer with the scripted model, for trials; without it a plan that asks a model must name its server")
    p.add_argument("--export", help="also write the last rows as JSON lines there")
    p.add_argument("--merge", nargs="+", metavar="PATH", help="put outputs of runs together, ids renumbered, and write them to --output")
    p.add_argument("--folder", default="")
    p.add_argument("--start-from")
    p.add_argument("--only")
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--num-rows", type=int, default=-1)
    p.add_argument("--batch-size", type=int, help="rows of an Arrow batch, within which model calls run at the same time")
    p.add_argument("--resume", action="store_true", help="add to outputs that are there already")
    p.add_argument("--list-phases", action="store_true")
    p.add_argument("--dump-prompts")
    p.add_argument("--dry-run", action="store_true")
    return p


def client_of(env: dict, scripted: bool = False):
    """The model server that the settings name."""
    url = env.get("MODEL_BASE_URL") or env.get("VLLM_BASE_URL")
    if url:
        return HttpClient(url, env.get("MODEL_API_KEY") or env.get("VLLM_API_KEY") or "none")
    if not scripted:
        raise SystemExit("the plan names no model server: set MODEL_BASE_URL, or pass --scripted")
    return ScriptedClient()


def embedder_of(env: dict):
    """The embedding model whose path or name the settings hold; without one, hashed words."""
    return TransformerEmbedder(env["EMBED_MODEL"], env.get("EMBED_DEVICE", "cpu")) if env.get("EMBED_MODEL") else HashEmbedder()


def merge(paths: list[str], output: str) -> int:
    """Merges tables of any format that exist; the ending of ``output`` says whether it's JSON lines or Parquet."""
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    found = [corpus.read_any(spark, p) for p in paths if corpus.has_path(spark, p)]
    if not found:
        print("none of the paths exists")
        return 1
    rows = corpus.merge_runs(found)
    if output.rstrip("/").endswith((".jsonl", ".json")):
        corpus.write_rows(rows, output, "overwrite")
    else:
        rows.write.mode("overwrite").parquet(output)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.list_phases:
        print("\n".join(list_phases()))
        return 0
    if args.merge:
        if not args.output:
            parser().error("--merge needs --output")
        return merge(args.merge, args.output)
    if not args.pipeline:
        parser().error("--pipeline is required")
    plan = pipeline.load(args.pipeline)
    if args.dump_prompts:
        with open(args.dump_prompts, "w", encoding="utf-8") as f:
            f.write(pipeline.dump_prompts(plan))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    if args.batch_size:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", args.batch_size)
    ctx = Context(spark, client_of(plan.env, args.scripted or args.dry_run), embedder_of(plan.env), corpus.read_any(spark, args.corpus) if args.corpus else None, num_rows=args.num_rows)
    if args.dry_run:
        for name, n in pipeline.dry_run(plan, ctx).items():
            print(f"{name}: {'unknown' if n is None else n}")
        return 0
    options = {"resume": args.resume}
    options |= {} if plan.runs else {"start_from": args.start_from, "only": args.only, "output": args.output, "source": corpus.read_any(spark, args.input) if args.input else None}
    results = pipeline.run(plan, ctx, args.folder, **options)
    if args.export:
        corpus.write_rows(pipeline.merged(results) if plan.runs else results[""][0], args.export, "overwrite")
    if said := pipeline.empty_summary(results):
        print(said)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
