import numpy as np
import pytest

from corpusloom.llm import covertree

KIND = "vec_id long, embedding array<float>, label int"


def brute(data, cosine=0.98):
    ok = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(data)
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(n):
            (_, a, p), (_, b, q) = data[i], data[j]
            if i != j and p is not None and p == q and ok(a) and ok(b) and len(a) == len(b):
                x, y = (np.array(v, np.float32).astype(float) for v in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i].add(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [data[k][0] for k in seen]
        out.append((data[i][0], len(links[i]), min(ids)))
    return sorted(out)


def sample():
    rng = np.random.default_rng(4)
    data = []
    for c in range(12):
        centre = rng.normal(size=6)
        for _ in range(10):
            data.append((len(data), [float(x) for x in centre + rng.normal(size=6) * rng.choice([0.05, 0.2, 0.6])], int(c % 3)))
    v = data[0][1]
    data += [(200, v, 0), (201, [2 * x for x in v], 0), (202, v, None), (203, None, 0), (204, [0.0] * 6, 0), (205, [float("nan")] * 6, 0), (206, [None, *v[1:]], 0), (207, [float("inf")] * 6, 0), (208, v[:3], 0), (209, v, 1), (210, [-0.0 if x == 0 else x for x in v], 0)]
    return data


@pytest.mark.parametrize("block, pivots", [(2048, 16), (7, 3), (1, 1)])
def test_equals_brute_force(rows, block, pivots):
    data = sample()
    found = covertree.embedding_duplicates(rows(KIND, *data), block=block, pivots=pivots)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect()) == brute(data)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.collect())


def test_tight_groups_need_no_meetings(rows):
    """Groups larger than a block in which all vectors link, two of them near enough to link in whole, one in part, and loose vectors between."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=6)
    base /= np.linalg.norm(base)
    side = np.linalg.svd(base[None])[2][1]
    data = []
    for shift, n, noise in ((0.0, 40, 0.004), (0.1, 30, 0.004), (0.2, 30, 0.004), (0.35, 25, 0.05), (2.0, 20, 0.004)):
        for _ in range(n):
            data.append((len(data), [float(x) for x in base + shift * side + noise * rng.normal(size=6)], 0))
    found = covertree.embedding_duplicates(rows(KIND, *data), block=5, pivots=4)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect()) == brute(data)


def test_cells_keep_all_vectors(rows):
    data = [(i, v, c) for i, v, c in sample()[:120]]
    vectors = rows(KIND, *data).selectExpr("vec_id as node", "label", "embedding", "1L as weight")
    placed, tree, depth = covertree.cells(vectors, 0.98, 3, 7)
    assert depth > 1 and sorted(r["node"] for r in placed.collect()) == list(range(120))
    leaves = {(r["label"], r["path"]): r for r in tree.where("leaf").collect()}
    for r in placed.collect():
        leaf, v = leaves[r["label"], r["path"]], np.array(r["embedding"], float)
        assert np.linalg.norm(v / np.linalg.norm(v) - np.array(leaf["centre"])) <= leaf["radius"] + 1e-12
    assert sum(r["size"] for r in leaves.values()) == 120 and max(r["size"] for r in leaves.values() if r["radius"] > 0.1) <= 7


def test_query_and_repeated_rows(spark, rows, save):
    data = sample()[:40]
    df = rows(KIND, *data, *data[:3]).selectExpr("*", "1 as node", "2 as weight")
    found = covertree.op2_embeddings(spark, save(embeddings=df)).collect()
    assert len(found) == 43 and {r["vec_id"]: r["component_id"] for r in found} == {i: c for i, _, c in brute(data)}
    assert next(r["n_links"] for r in found if r["vec_id"] == 0) >= 1
    assert covertree.op2_embeddings(spark, save(embeddings=df.limit(0))).count() == 0


def test_tree_levels_halve_and_cover():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = covertree.Tree(x, 0.1)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(200))
    for depth, (centres, radii, _, _) in enumerate(tree.levels):
        assert radii.max() <= 2.0 / 2**depth + 1e-9 or depth == 0
        if len(centres) > 1 and depth + 1 < len(tree.levels):
            assert set(centres) <= set(tree.levels[depth + 1][0])  # nested


def test_oracle_agrees(spark, rows, save, tmp_path):
    import duckdb

    data = [(i, v, c) for i, v, c in sample() if v is not None and None not in v]
    folder = save(embeddings=rows(KIND, *data))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    assert sorted(r[:3] for r in con.execute(covertree.ORACLE).fetchall()) == [(i, n, c) for i, n, c in brute(data)]
