"""Embedding near-duplicates by dual traversal of cover trees.

Links: equal, non-null labels and a cosine of at least ``COSINE`` in double precision, which for unit vectors is a distance of at
most sqrt(2 - 2 cosine). Vectors equal in every component are collapsed to one with a count first.

The upper levels of a label's tree are tables: a cell with more than ``block`` vectors is dealt to cells of its own by the nearest
of up to ``pivots`` of its members, and so on, so the number of pivots grows with the label. No cell is gathered for that: its rows go to as
many tasks as they need, each with the cell's pivots. A cell is a leaf once it fits a block, if all its vectors link anyway (its radius
is at most half the linking distance), if it didn't get smaller, or after ``ROUNDS`` levels. Pairs of cells go down these levels
together, one round a level, as far as their true covering radii allow. A leaf cell's blocks (one, but for the last three kinds) become
cover trees of nested levels with halving radii, each built once; of blocks that meet, the trees are traversed together in the
same way, and exact cosines decide at the leaves.

A meeting of two blocks gives no pairs but, for each vector, the weight of its links and a spanning forest of them, at most a few
rows a vector. Cells in which all vectors link have no meetings with themselves or with such cells near enough that all pairs
link: the cells' weights are the links. Exact search in spread-out vectors still has to compare many blocks of a label.

A null vec_id links like any other and names no component unless nothing else is in it. Null labels, null or zero vectors and those with null or non-finite components link with nothing and keep their row; vectors of
different lengths never link; repeated rows of one vec_id are vectors of their own (they link if their cosine says so); an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_sample, few, stash, table
from corpusloom.llm.components import components

COSINE, PIVOTS, BLOCK, SLACK = 0.98, 16, 2048, 1e-9
#: Levels of the tables of cells: evenly split by 16 pivots each they'd hold over 10^17 vectors, so only lopsided cells get so far.
ROUNDS = 12
_ROW = 1 << 30
_CELL = ["label", "dim", "path"]


class Tree:
    """A cover tree over unit vectors: ``levels`` from the root down, each (centres, radii, first child, end of children); leaves are vectors."""

    def __init__(self, unit: np.ndarray, least: float):
        self.levels = []
        parts, radius = [np.arange(len(unit))], 2.0
        sizes = [1]
        while True:
            centres = np.array([p[0] for p in parts])
            radii = np.array([np.sqrt(np.maximum(((unit[p] - unit[p[0]]) ** 2).sum(1), 0)).max() if len(p) > 1 else 0.0 for p in parts])
            self.levels.append([centres, radii, None, None])
            if len(self.levels) > 1:
                ends = np.cumsum(sizes)
                self.levels[-2][2:] = [ends - sizes, ends]
            if radius <= least or radii.max(initial=0) == 0:
                break
            radius /= 2
            below, sizes = [], []
            for p in parts:
                new = _split(unit, p, radius)
                below += new
                sizes.append(len(new))
            parts = below
        self.leaves = parts

    def packed(self) -> bytes:
        ends = np.cumsum([len(p) for p in self.leaves])
        return pickle.dumps((self.levels, np.concatenate(self.leaves), ends[:-1]))

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        tree.levels, members, cuts = pickle.loads(data)
        tree.leaves = np.split(members, cuts)
        return tree


def _split(unit: np.ndarray, part: np.ndarray, radius: float) -> list[np.ndarray]:
    """Centres farther apart than the radius, each with the vectors it covers first; the part's own centre stays one (nesting)."""
    if len(part) == 1:
        return [part]
    out = []
    while len(part):
        near = unit[part] @ unit[part[0]] >= 1 - radius * radius / 2
        near[0] = True
        out.append(part[near])
        part = part[~near]
    return out


def _pairs(x: np.ndarray, a: Tree, y: np.ndarray, b: Tree, reach: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The (leaf of a, leaf of b) pairs whose covering balls come within reach."""
    i, j = np.zeros(1, int), np.zeros(1, int)
    depth = 0
    while True:
        la, lb = a.levels[min(depth, len(a.levels) - 1)], b.levels[min(depth, len(b.levels) - 1)]
        keep = []
        for s in range(0, len(i), 1 << 18):
            p, q = i[s : s + (1 << 18)], j[s : s + (1 << 18)]
            dot = np.einsum("ij,ij->i", x[la[0][p]], y[lb[0][q]]) if len(la[0]) * len(lb[0]) > 4 * len(p) else (x[la[0]] @ y[lb[0]].T)[p, q]
            keep.append(np.sqrt(np.maximum(2 - 2 * dot, 0)) <= reach + la[1][p] + lb[1][q] + SLACK)
        keep = np.concatenate(keep)
        i, j = i[keep], j[keep]
        if depth >= max(len(a.levels), len(b.levels)) - 1 or not len(i):
            return i, j
        down = []
        for k, tree in ((i, a), (j, b)):
            if depth < len(tree.levels) - 1:
                down.append((tree.levels[depth][2][k], tree.levels[depth][3][k]))
            else:
                down.append((k, k + 1))
        (s1, e1), (s2, e2) = down
        n1, n2 = e1 - s1, e2 - s2
        n = n1 * n2
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(n2, n)
        i, j = np.repeat(s1, n) + at // width, np.repeat(s2, n) + at % width
        depth += 1


def reach_of(cosine: float) -> float:
    """The distance of unit vectors of that cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def meet(x: np.ndarray, wx: np.ndarray, a: Tree, y: np.ndarray, wy: np.ndarray, b: Tree, cosine: float, same: bool):
    """Of two blocks of unit vectors with weights and trees: link weights of each, and a forest of links as positions (y's after x's)."""
    nx, ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    parent: dict[int, int] = {}
    forest: list[tuple[int, int]] = []

    def root(k: int) -> int:
        while (up := parent.get(k, k)) != k:
            parent[k] = parent.get(up, up)
            k = up
        return k

    for i, j in zip(*(v.tolist() for v in _pairs(x, a, y, b, reach_of(cosine))), strict=True):
        if same and j < i:
            continue
        p, q = a.leaves[i], b.leaves[j]
        for s in range(0, len(p), 512):
            ps = p[s : s + 512]
            hit = x[ps] @ y[q].T >= cosine
            if same and i == j:
                hit[np.arange(len(ps)), np.arange(s, s + len(ps))] = False
            if not hit.any():
                continue
            nx[ps] += hit @ wy[q]
            if not (same and i == j):
                (nx if same else ny)[q] += wx[ps] @ hit
            # One link joins what is linked already: each row's first hit, then what it doesn't share with it.
            for r in np.flatnonzero(hit.any(axis=1)):
                left = int(ps[r])
                for c in q[hit[r]].tolist():
                    right = c if same else len(x) + c
                    u, v = root(left), root(right)
                    if u != v:
                        parent[v] = u
                        forest.append((left, right))
    return nx, ny, forest


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)
    return m / np.sqrt((m * m).sum(1))[:, None]


def usable(column: str = "embedding"):
    """Whether a vector can link: not null, no null or non-finite component, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by cell, part and slot, a cell's pivots first: each vector with the cell of its nearest pivot and its distance from that."""
    now, top, unit = None, [], None
    for rows in batches:
        keys = rows[[*_CELL, "part"]]
        runs = (keys != keys.shift()).any(axis=1).cumsum()
        for _, run in rows.groupby(runs, sort=False):
            key = tuple(run[[*_CELL, "part"]].iloc[0])
            if key != now:
                now, top, unit = key, [], None
            lead = run["slot"] < _ROW
            if lead.any():
                top.append(_unit(run.loc[lead, "embedding"]))
            own = run[~lead].copy()
            if not len(own):
                continue
            own["far"], slots = 2.0, np.zeros(len(own), int)
            if top:
                unit = np.concatenate(top) if unit is None else unit
                mine = _unit(own["embedding"])
                slots = (mine @ unit.T).argmax(1)
                own["far"] = np.sqrt(((mine - unit[slots]) ** 2).sum(1))
            own["parent"], own["path"] = own["path"], [f"{p}.{k}" for p, k in zip(own["path"], slots, strict=True)]
            own["slot"] = slots
            yield own[[*_CELL, "parent", "slot", "node", "weight", "embedding", "far"]]


def cells(vectors: DataFrame, cosine: float, pivots: int, block: int) -> tuple[DataFrame, DataFrame, int]:
    """Of (node, label, embedding, weight) rows: the same with the leaf cell they lie in; all cells of all levels; how many levels lie below the top."""
    kind = dict(vectors.dtypes)
    reach = reach_of(cosine)
    now = vectors.select("label", F.size("embedding").alias("dim"), F.lit("").alias("path"), "node", "weight", "embedding")
    size, weight, least = F.count(F.lit(1)).alias("size"), F.sum("weight").alias("total"), F.min("node").alias("least")
    tops = now.groupBy(*_CELL).agg(size, weight, least).withColumn("parent", F.lit(None).cast("string")).withColumn("centre", F.lit(None).cast("array<double>"))
    level = stash(tops.withColumn("radius", F.lit(2.0)).withColumn("leaf", F.col("size") <= block))
    settled, levels, depth = [], [level], 0
    while depth < ROUNDS and level.where("not leaf").limit(1).count():
        marks = few(level.select(*_CELL, "leaf", "size"))
        placed = now.join(marks, _CELL)
        settled.append(placed.where("leaf").select(now.columns))
        # A large cell's rows are dealt to parts, and its pivots are sent to each.
        parts = F.ceil(F.col("size") / (16 * block)).cast("int")
        members = placed.where("not leaf")
        # No more pivots than leave cells of about half a block: every cell more is a block more to meet.
        chosen = bounded_sample(members, _CELL, pivots, "node", [*_CELL, "node", "embedding", "size"])
        chosen = chosen.withColumn("slot", F.row_number().over(Window.partitionBy(*_CELL).orderBy("node")) - 1)
        chosen = stash(chosen.where(F.col("slot") < F.ceil(2 * F.col("size") / block)))
        leads = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("weight", F.lit(0).cast("long"))
        own = members.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("slot", F.lit(_ROW))
        columns = [*_CELL, "part", "slot", "node", "weight", "embedding"]
        dealt = leads.select(columns).union(own.select(columns)).repartition(*_CELL, "part").sortWithinPartitions(*columns[:6])
        schema = f"label {kind['label']}, dim int, path string, parent string, slot int, node {kind['node']}, weight long, embedding {kind['embedding']}, far double"
        below = stash(dealt.mapInPandas(_nearest, schema))
        norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        centres = chosen.select("label", "dim", F.concat_ws(".", "path", F.col("slot").cast("string")).alias("path"), F.transform("embedding", lambda x: x.cast("double") / norm).alias("centre"), F.col("size").alias("above"))
        found = below.groupBy(*_CELL).agg(size, weight, least, F.min("parent").alias("parent"), F.max("far").alias("radius")).join(centres, _CELL, "left")
        done = (F.col("size") <= block) | (2 * F.col("radius") <= reach - SLACK) | (F.col("size") >= F.coalesce("above", F.col("size")))
        depth += 1
        level = stash(found.withColumn("leaf", done if depth < ROUNDS else F.lit(True)).select(level.columns))
        levels.append(level)
        now = below.select(now.columns)
    return reduce(DataFrame.union, [*settled, now]), reduce(DataFrame.union, levels), depth


def _apart(a: str, b: str):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))


def cell_pairs(tree: DataFrame, depth: int, reach: float) -> DataFrame:
    """(label, dim, one, two, whole): the pairs of leaf cells, a cell with itself included, that may hold links; ``whole`` if all their vectors link."""
    # One step down: a leaf stays, any other cell goes to those below it.
    side = ["path", "centre", "radius", "leaf"]
    stays = tree.where("leaf").withColumn("at", F.col("path"))
    step = stash(stays.union(tree.where("parent is not null").withColumn("at", F.col("parent"))).select("label", "dim", "at", *side))
    top = tree.where("parent is null")
    pairs = top.select("label", "dim", *[F.col(c).alias(f"{c}_{k}") for k in ("one", "two") for c in side])
    for _ in range(depth):
        # A lone cell is met with itself; of two that go down from one, each pair once.
        down = pairs.where("not (leaf_one and leaf_two)").select("label", "dim", F.col("path_one").alias("a"), F.col("path_two").alias("b"))
        for name, at in (("one", "a"), ("two", "b")):
            down = down.join(step.select("label", "dim", F.col("at").alias(at), *[F.col(c).alias(f"{c}_{name}") for c in side]), ["label", "dim", at])
        near = F.coalesce(_apart("centre_one", "centre_two") <= reach + F.col("radius_one") + F.col("radius_two") + SLACK, F.lit(True))
        down = down.where(((F.col("a") != F.col("b")) | (F.col("path_one") <= F.col("path_two"))) & near)
        pairs = stash(pairs.where("leaf_one and leaf_two").union(down.select(pairs.columns)))
    tight = (2 * F.greatest("radius_one", "radius_two") <= reach - SLACK)
    whole = tight & ((F.col("path_one") == F.col("path_two")) | (_apart("centre_one", "centre_two") + F.col("radius_one") + F.col("radius_two") <= reach - SLACK))
    return pairs.select("label", "dim", F.col("path_one").alias("one"), F.col("path_two").alias("two"), F.coalesce(whole, F.lit(False)).alias("whole"))


def _block_links(placed: DataFrame, leaves: DataFrame, pairs: DataFrame, cosine: float, block: int) -> DataFrame:
    """(u, v, n): links found by meetings of blocks; n is the weight of u's links where v is null, else u and v link."""
    kind, reach = dict(placed.dtypes), reach_of(cosine)
    parts = few(leaves.select(*_CELL, F.ceil(F.col("size") / block).cast("int").alias("parts")))
    split = placed.join(parts, _CELL).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).drop("parts")

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """A block in one row: its centre, true radius, members and tree."""
        rows = rows.sort_values("node", kind="stable")
        unit = _unit(rows["embedding"])
        centre = unit.mean(0)
        far = float(np.sqrt(((unit - centre) ** 2).sum(1)).max())
        row = [*key, centre.tolist(), far, rows["node"].tolist(), rows["weight"].tolist(), unit.tobytes(), Tree(unit, reach / 2).packed()]
        return pd.DataFrame([row], columns=[*_CELL, "part", "centre", "radius", "nodes", "weights", "unit", "tree"])

    schema = f"label {kind['label']}, dim int, path string, part int, centre array<double>, radius double, nodes array<{kind['node']}>, weights array<long>, unit binary, tree binary"
    blocks = stash(split.groupBy(*_CELL, "part").applyInPandas(fold, schema))
    # Which blocks meet is decided on their centres alone; members are sent only where two do.
    heads = lambda name: blocks.select("label", "dim", F.col("path").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("part", "centre", "radius")])
    meets = pairs.where("not whole").join(heads("one"), ["label", "dim", "one"]).join(heads("two"), ["label", "dim", "two"])
    meets = meets.where(((F.col("one") != F.col("two")) | (F.col("part_one") <= F.col("part_two"))) & (_apart("centre_one", "centre_two") <= reach + F.col("radius_one") + F.col("radius_two") + SLACK))
    meets = meets.select("label", "dim", "one", "part_one", "two", "part_two")
    side = lambda name: blocks.select("label", "dim", F.col("path").alias(name), F.col("part").alias(f"part_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in ("nodes", "weights", "unit", "tree")])
    met = meets.join(side("one"), ["label", "dim", "one", "part_one"]).join(side("two"), ["label", "dim", "two", "part_two"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            out: tuple[list, list, list] = ([], [], [])
            for k in range(batch.num_rows):
                same, dim = at["one"][k] == at["two"][k] and at["part_one"][k] == at["part_two"][k], at["dim"][k].as_py()
                get = lambda name: (at[f"nodes_{name}"][k].values.to_numpy(), at[f"weights_{name}"][k].values.to_numpy(), np.frombuffer(at[f"unit_{name}"][k].as_buffer(), np.float64).reshape(-1, dim), Tree.unpacked(at[f"tree_{name}"][k].as_py()))  # noqa: B023, E731
                ids, wx, x, a = get("one")
                ids2, wy, y, b = (ids, wx, x, a) if same else get("two")
                nx, ny, forest = meet(x, wx, a, y, wy, b, cosine, same)
                both = ids if same else np.concatenate((ids, ids2))
                n = nx if same else np.concatenate((nx, ny))
                some = np.flatnonzero(n)
                out[0].extend(both[some].tolist() + [int(both[p]) for p, _ in forest])
                out[1].extend([None] * len(some) + [int(both[q]) for _, q in forest])
                out[2].extend(n[some].tolist() + [None] * len(forest))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["u", "v", "n"])

    return met.mapInArrow(link, "u long, v long, n long")


def _whole_links(placed: DataFrame, leaves: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, n) as ``_block_links``, of pairs of cells all of whose vectors link: from the cells' weights and least nodes alone."""
    own = lambda name: leaves.select("label", "dim", F.col("path").alias(name), F.col("total").alias(f"total_{name}"), F.col("least").alias(f"least_{name}"))
    known = stash(pairs.where("whole").join(own("one"), ["label", "dim", "one"]).join(own("two"), ["label", "dim", "two"]))
    across = known.where("one <> two")
    sides = known.select("label", "dim", F.col("one").alias("path"), F.col("least_one").alias("least"), F.col("total_two").alias("n"))
    sides = sides.union(across.select("label", "dim", "two", "least_two", "total_one"))
    met = placed.select(*_CELL, "node", "weight").join(sides.groupBy(*_CELL, "least").agg(F.sum("n").alias("n")), _CELL)
    none = F.lit(None).cast("long")
    found = met.select(F.col("node").alias("u"), none.alias("v"), (F.col("n") - F.col("weight")).alias("n"))
    found = found.union(met.where("node <> least").select("node", "least", none))
    return found.union(across.select("least_one", "least_two", none))


def near_pairs(vectors: DataFrame, *, cosine: float = COSINE, pivots: int = PIVOTS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Of (node, label, embedding, weight) rows: (node, weight of linked others) and a forest of links (u, v)."""
    placed, tree, depth = cells(vectors, cosine, pivots, block)
    leaves, pairs = tree.where("leaf"), cell_pairs(tree, depth, reach_of(cosine))
    found = _block_links(placed, leaves, pairs, cosine, block)
    if depth:
        found = found.union(_whole_links(placed, leaves, pairs))
    found = stash(found)
    return found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("linked")), found.where("v is not null").select("u", "v")


def embedding_duplicates(vectors: DataFrame, *, cosine: float = COSINE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Of (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", "embedding").withColumn("_usable", usable() & F.col("label").isNotNull())
    able = rows.where("_usable").drop("_usable")
    # Copies collapse to one node; a node is named by its least vec_id, or by its hash where that id also names another.
    kinds = able.groupBy("label", "embedding").agg(F.min("vec_id").alias("_first"), F.count(F.lit(1)).alias("weight"))
    kinds = stash(kinds.withColumn("node", F.xxhash64("label", "embedding")))
    linked, forest = near_pairs(kinds, cosine=cosine, pivots=pivots, block=block)
    groups = components(forest)
    member = kinds.join(groups, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    named = member.join(member.groupBy(F.col("_group").alias("_g")).agg(F.min("_first").alias("component_id")), F.col("_group") == F.col("_g"))
    named = named.join(linked, "node", "left").select(F.col("label").alias("_l"), F.col("embedding").alias("_e"), (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    joined = able.join(named, (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e")), "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").cast("long").alias("component_id"))
    alone = rows.where(~F.col("_usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_embeddings(spark, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as u, b.vec_id as v from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(node, least) as (select u, u from links union select v, least from reach join links on u = node),
least as (select node, min(least) as least from reach group by node),
counts as (select u, count(*) as n from links group by u)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(least, vec_id)::bigint as component_id, vec_id = coalesce(least, vec_id) as kept
from embeddings left join counts on u = vec_id left join least on node = vec_id
"""
