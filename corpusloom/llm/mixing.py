"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes are words. Targets share the corpus's size among sources by weight and stop at ``cap`` times a source's own size.
The mix is cut into blocks of ``block_tokens``; sources, then the shards of each source, get integer numbers of blocks by
the highest quotients ``votes / (2 k - 1)``. Within a shard, documents stand in seeded order, end to end; a quota of
``q`` blocks takes every one of the shard's ``n`` blocks ``q div n`` times and the first ``q mod n`` once more.

Everything is DataFrame code. A shard holds about ``shard_tokens`` words, so a hot source is spread over many tasks; the
tables of sources and shards have one row each. Nulls: a null text has size 0 and takes 0; a null source is a source of
its own that sorts last; repeated rows count as rows of their own; an empty table gives an empty result. Extra columns
pass through; columns of this operator's names (size, source_size, target, taken) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, row_of, stash

BLOCK_TOKENS, SHARD_TOKENS, WEIGHTS, CAP, SEED = 16, 500_000, (1, 2, 3), 3, "mix-1"


def sainte_lague(parties: DataFrame, group: list[str], key: str) -> DataFrame:
    """Adds ``quota``: ``seats`` (one value a group) dealt to the group's rows by the highest ``votes / (2 k - 1)``; ties go to the lower ``key``.

    With n parties and V votes, the divisor V / (seats - n / 2) deals at most ``seats`` and V / (seats + n / 2) at least that.
    So all but about 2 n seats are settled in closed form, and only the quotients between the two divisors are ranked.
    """
    w = Window.partitionBy(*group)
    share = lambda seats: f"floor(votes * greatest({seats}, 0D) / _v + 0.5D)"
    sure = (
        parties.withColumn("_v", F.sum("votes").over(w))
        .withColumn("_n", F.count(F.lit(1)).over(w))
        .withColumn("_base", F.expr(f"case when votes > 0 then greatest({share('seats - _n / 2D')} - 1, 0) else 0 end").cast("long"))
        .withColumn("_top", F.expr(f"case when votes > 0 then {share('seats + _n / 2D')} + 1 else 0 end").cast("long"))
        .withColumn("_rest", F.col("seats") - F.sum("_base").over(w))
    )
    quotient = F.col("votes") / (F.col("_k") * 2 - 1)
    open_seats = (
        sure.where("_top > _base")
        .withColumn("_k", F.explode(F.sequence(F.col("_base") + 1, F.col("_top"))))
        .withColumn("_rank", F.row_number().over(w.orderBy(quotient.desc(), F.col(key), F.col("_k"))))
        .where("_rank <= _rest")
        .groupBy(*group, key)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*group, key]]
    joined = sure.alias("s").join(open_seats.alias("o"), on=same, how="left")
    return joined.select(*[F.col(f"s.{c}") for c in parties.columns], (F.col("s._base") + F.coalesce(F.col("o._won"), F.lit(0))).alias("quota"))


def targets(sources: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """From one row a source (``source``, ``source_size``): ``src`` (its rank by code point, null last) and ``target``.

    A source is at its cap if, after those that reach theirs sooner, an even share by weight would still carry it there.
    """
    every, by_ratio = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("_ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (
        sources.withColumn("src", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * float(cap))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_full", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(from_here) >= F.col("_ratio"))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every), F.lit(0.0)))
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every))
    )
    return ranked.select("source", "source_size", "src", F.when(F.col("_full"), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_left") * F.col("_w") / F.col("_open"))).alias("target"))


def mix(docs: DataFrame, *, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, weights=WEIGHTS, cap: float = CAP, seed: str = SEED, carry: list[str] | None = None) -> DataFrame:
    """Adds size, source_size, target, taken and, for whoever cuts the texts, ``passes`` (whole copies) and ``extra`` (words of one more copy, from the text's start).

    ``carry`` names the columns to keep beside doc_id and source (all by default). The sizes are written once as a narrow table.
    """
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "passes", "extra") and (carry is None or c in (*carry, "doc_id", "source"))]
    # What is carried stands in one column, so that none of its names can clash with those used here.
    sized = docs.select(
        row_of(docs.select(*[F.col(f"`{c}`") for c in keep])).alias("row"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_order"), F.xxhash64("text").alias("_tie"),
    )
    narrow = stash(sized.select("source", "size", "_order"))
    goal = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    goal = goal.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_tokens), F.lit(1)))
    goal = stash(goal.withColumn("votes", F.col("target")).withColumn("seats", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_tokens).cast("long")).transform(lambda g: sainte_lague(g, [], "src")))
    place = lambda df: df.alias("d").join(goal.select(F.col("source").alias("_s"), "src", "source_size", "target", "shards", F.col("quota").alias("seats")).alias("g"), F.col("d.source").eqNullSafe(F.col("g._s"))).withColumn("shard", F.pmod(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long"), F.col("shards"))).drop("_s")
    shards = place(narrow).groupBy("src", "shard").agg(F.sum("size").alias("_words"), F.first("seats").alias("seats")).withColumn("votes", F.col("_words").cast("double"))
    quotas = sainte_lague(shards, ["src"], "shard").select(
        F.col("src").alias("_src"), F.col("shard").alias("_shard"), F.ceil(F.col("_words") / block_tokens).alias("_blocks"), "quota"
    ).withColumn("quota", F.least(F.col("quota"), F.col("_blocks") * int(cap)))
    end = F.sum("size").over(Window.partitionBy("src", "shard").orderBy("_order", "size", "_tie").rowsBetween(Window.unboundedPreceding, 0))
    dealt = place(sized).withColumn("_end", end).join(quotas, (F.col("src") == F.col("_src")) & (F.col("shard") == F.col("_shard")), "left")
    reach = F.pmod(F.col("quota"), F.col("_blocks")) * block_tokens
    return (
        dealt.withColumn("passes", F.when(F.col("_blocks") > 0, F.floor(F.col("quota") / F.col("_blocks"))).otherwise(0).cast("long"))
        .withColumn("extra", F.when(F.col("_blocks") > 0, F.greatest(F.least(F.col("_end"), reach) - (F.col("_end") - F.col("size")), F.lit(0))).otherwise(0).cast("long"))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("extra"))
        .select("row.*", "size", "source_size", "target", "taken", "passes", "extra")
    )


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    from corpusloom.llm.common import table

    return mix(table(spark, sf_dir, "documents"), carry=[]).select("doc_id", "size", "source_size", "target", "taken")


def _seats(parties: str, group: str, key: str, out: str) -> str:
    """The SQL of the rule in ``sainte_lague``."""
    over = f"over (partition by {group})"
    return f"""
{out}_v as (select *, sum(votes) {over} as v_, count(*) {over} as n_ from {parties}),
{out}_b as (select *, case when votes > 0 then greatest(floor(votes * greatest(seats - n_ / 2.0::double, 0::double) / v_ + 0.5::double) - 1, 0) else 0 end::bigint as base_,
  case when votes > 0 then floor(votes * greatest(seats + n_ / 2.0::double, 0::double) / v_ + 0.5::double) + 1 else 0 end::bigint as top_ from {out}_v),
{out}_r as (select *, seats - sum(base_) {over} as rest_ from {out}_b),
{out}_k as (select *, unnest(generate_series(base_ + 1, top_)) as k_ from {out}_r where top_ > base_),
{out}_w as (select *, row_number() over (partition by {group} order by votes / (k_ * 2 - 1)::double desc, {key}, k_) as rank_ from {out}_k),
{out}_c as (select {group} as g_, {key} as y_, count(*) as won_ from {out}_w where rank_ <= rest_ group by all),
{out} as (select r.*, base_ + coalesce(won_, 0) as quota from {out}_r r left join {out}_c c on c.g_ = r.{group} and c.y_ = r.{key})"""


ORACLE = f"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size, md5('{SEED}:' || coalesce(doc_id::varchar, '')) as ord_ from documents),
src0 as (select source, sum(size)::bigint as source_size, 0 as one_ from sized group by source),
src1 as (select *, row_number() over (order by source asc nulls last) as src from src0),
src2 as (select *, ((src - 1) % 3 + 1)::double as w_, source_size * 3::double as cap_, sum(source_size) over ()::double as total_ from src1),
src3 as (select *, cap_ / w_ as ratio_ from src2),
src4 as (select *, (total_ - coalesce(sum(cap_) over (order by ratio_, src rows between unbounded preceding and 1 preceding), 0)) / sum(w_) over (order by ratio_, src rows between current row and unbounded following) >= ratio_ as full_ from src3),
src5 as (select *, total_ - coalesce(sum(case when full_ then cap_ end) over (), 0) as left_, sum(case when not full_ then w_ end) over () as open_ from src4),
src6 as (select one_, source, source_size, src, case when full_ then cap_ else least(cap_, left_ * w_ / open_) end as target from src5),
src7 as (select *, greatest(ceil(source_size / {SHARD_TOKENS}::double), 1)::bigint as shards, target as votes, round(sum(target) over () / {BLOCK_TOKENS})::bigint as seats from src6),
{_seats("src7", "one_", "src", "goal")},
placed as (select d.*, g.src, g.source_size, g.target, g.quota as seats, ('0x' || substr(ord_, 1, 8))::bigint % g.shards as shard from sized d join goal g on d.source is not distinct from g.source),
shard0 as (select src, shard, sum(size)::double as votes, sum(size)::bigint as words_, any_value(seats) as seats from placed group by src, shard),
{_seats("shard0", "src", "shard", "shard1")},
shard2 as (select src, shard, ceil(words_ / {BLOCK_TOKENS}::double)::bigint as blocks_, least(quota, ceil(words_ / {BLOCK_TOKENS}::double)::bigint * 3) as quota from shard1),
ends as (select *, sum(size) over (partition by src, shard order by ord_, size rows between unbounded preceding and current row) as end_ from placed)
select e.doc_id, e.size, e.source_size, e.target,
  (case when blocks_ > 0 then quota // blocks_ * e.size + greatest(least(end_, quota % blocks_ * {BLOCK_TOKENS}) - (end_ - e.size), 0) else 0 end)::bigint as taken
from ends e left join shard2 s on e.src = s.src and e.shard = s.shard
"""
