import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_minhash import classes
from tickspark.llm import embedding_join as J
from tickspark.llm import queries as Q


def brute(vectors, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = []
    for i in range(len(vectors)):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links.append((j, i))
    n = np.bincount(np.array(links, int).reshape(-1), minlength=len(vectors))
    return n.tolist(), classes(len(vectors), links)


def agree(rows, vectors):
    n, comp = brute(vectors)
    for r in rows:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id), r


def test_on_table(spark):
    d = "/root/testdata/sf0.01"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
    rows = Q.op5_embedding_dedup(spark, d).collect()
    assert len(rows) == len(vectors)
    agree(rows, [vectors[i] for i in range(len(vectors))])


def as_floats(vectors):
    return [[float(np.float32(x)) for x in v] for v in vectors]


@pytest.mark.parametrize("block, leaf", [(16, 4), (64, 16), (4096, 256)])
def test_many_blocks_and_far_clusters(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(J, "LEAF", leaf)
    pick = np.random.default_rng(4)
    centres = pick.normal(size=(9, 12))
    vectors = [(centres[i % 9] * 3 + pick.normal(size=12) * (0.2 + (i % 5) / 4)).tolist() for i in range(420)]
    for kind in ("float", "double"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>")
        agree(J.near_duplicate_vectors(df, 0.9, block=block, axes=4).collect(), as_floats(vectors) if kind == "float" else vectors)


def planted(pick, n=1500, dim=64):
    """Vectors of which some are copies with noise, some exact copies, and some a chain of close neighbours."""
    vectors = pick.normal(size=(n, dim))
    for i in range(0, n, 10):
        vectors[i + 1] = vectors[i] + pick.normal(size=dim) * 0.2
        vectors[i + 2] = vectors[i] * 3
    chain = pick.normal(size=dim)
    for i in range(5, n, 30):
        chain = chain + pick.normal(size=dim) * 0.3
        vectors[i] = chain
    return vectors.tolist()


def test_planted_links_through_the_query(spark, as_table, monkeypatch):
    vectors = planted(np.random.default_rng(11))
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(3)
    for block in (J.BLOCK, 200):
        monkeypatch.setattr(J.near_duplicate_vectors, "__kwdefaults__", J.near_duplicate_vectors.__kwdefaults__ | {"block": block})
        rows = Q.op5_embedding_dedup(spark, as_table(df, "embeddings")).collect()
        assert len(rows) == len(vectors) and sum(r.n_links for r in rows) > 400 and sum(not r.kept for r in rows) > 200
        agree(rows, as_floats(vectors))


def test_many_lengths_and_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_BYTES", 1 << 15)
    pick = np.random.default_rng(5)
    vectors = [pick.normal(size=2 + i % 40).tolist() for i in range(120)]
    vectors += [(np.array(v) * 1.01 + 0.01).tolist() for v in vectors]
    base = pick.normal(size=(6, 1000))
    vectors += [(base[i % 6] + pick.normal(size=1000) * 0.1).tolist() for i in range(30)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    agree(J.near_duplicate_vectors(df).collect(), vectors)


def test_axes_of_long_vectors_are_orthonormal(spark):
    pick = np.random.default_rng(6)
    df = spark.createDataFrame([(v,) for v in pick.normal(size=(30, 300)).tolist()], "vector array<double>")
    axes = J.principal_axes(df, 300, 8)
    assert axes.shape == (300, 8) and np.allclose(axes.T @ axes, np.eye(8))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0], [1.0], [3.0], [1e-200, 1e-201], [1e200, 1e199], [-1.0, 0.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").withColumn("rep", F.lit("clash")).withColumn("vector", F.lit(0))
    rows = J.near_duplicate_vectors(df.union(df)).collect()
    assert len(rows) == 2 * len(vectors)
    got = {r.vec_id: r for r in rows}
    assert [got[i].n_links for i in range(6)] == [0] * 6 and all(got[i].kept for i in range(6))
    assert [got[i].n_links for i in (6, 7, 8, 11, 12)] == [4] * 5 and {got[i].component_id for i in (6, 7, 8, 11, 12)} == {6}
    assert (got[9].n_links, got[10].component_id, got[13].n_links) == (1, 9, 0)
    assert J.near_duplicate_vectors(df.limit(0)).count() == 0
    none = J.near_duplicate_vectors(df.withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in none] == [(0, None, True)] * len(vectors)


def test_distant_blocks_are_skipped(spark):
    pick = np.random.default_rng(0)
    far = np.eye(4)[[0] * 200 + [1] * 200] + pick.normal(size=(400, 4)) / 50
    df = spark.createDataFrame([(i, v) for i, v in enumerate(far.tolist())], "node long, vector array<double>").withColumn("copies", F.lit(1).cast("long"))
    eps = float(np.sqrt(0.2))
    basis = J.principal_axes(df, 4, 3)
    ordered = df.select("node", "copies", "vector").mapInArrow(lambda b: J._project(b, basis, eps), "node long, copies long, vector array<double>, cells array<int>, y array<double>").orderBy("cells", "y").coalesce(1)
    blocks = ordered.mapInArrow(lambda b: J._blocks(b, 20, False), J.BLOCKS)
    n = blocks.count()
    assert J.close_blocks(blocks, eps, 4).count() < 0.6 * n * (n + 1) / 2


def test_distant_leaves_are_skipped(monkeypatch):
    monkeypatch.setattr(J, "LEAF", 10)
    pick = np.random.default_rng(1)
    unit = J._unit(np.repeat(np.eye(4), 100, 0) + pick.normal(size=(400, 4)) / 50)
    run = J.Run(np.arange(400), np.ones(400, np.int64), unit, unit)
    rows, (compared, of) = J.join_runs(run, None, 0.9)
    assert compared == 4 * 55 and of == 820
    assert rows.filter(rows.column("b").is_null()).column("n").to_pylist() == [99] * 400
    half = [J.Run(np.arange(k, k + 200), np.ones(200, np.int64), unit[k : k + 200], unit[k : k + 200]) for k in (0, 200)]
    assert J.join_runs(*half, 0.9)[1] == (0, 400) and J.join_runs(*half, 0.9)[0].num_rows == 0


def test_one_id_with_several_vectors_and_int_ids(spark):
    pick = np.random.default_rng(8)
    base = pick.normal(size=(12, 6))
    near = lambda k: (base[k] + pick.normal(size=6) * 0.05).tolist()
    rows = [(1, [1.0, 0, 0, 0, 0, 0]), (1, base[0].tolist()), (2, near(0)), (3, base[1].tolist()), (3, near(1)), (4, near(1)), (0, base[2].tolist()), (9, near(2)), (9, base[3].tolist()), (9, base[3].tolist())]
    pairs = sorted(set((i, tuple(v)) for i, v in rows))
    n, comp = brute([list(v) for _, v in pairs])
    least = {c: min(pairs[k][0] for k in range(len(pairs)) if comp[k] == c) for c in comp}
    want = sorted((i, n[k], least[comp[k]], least[comp[k]] == i) for i, v in rows for k in [pairs.index((i, tuple(v)))])
    for kind in ("int", "long", "short"):
        df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"vec_id {kind}, embedding array<double>")
        for block in (J.BLOCK, 3):
            out = J.near_duplicate_vectors(df, block=block)
            assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()) == want
        assert out.schema["vec_id"].dataType == df.schema["vec_id"].dataType


def test_what_lies_off_the_axes_tells_apart():
    unit = J._unit(np.array([[3.0, 0, 0.1], [3, 0, 4]]))
    y = J._with_rest(unit[:, :1])
    assert np.allclose(y[:, 1], np.sqrt(1 - unit[:, 0] ** 2))
    a, b = (J.Run(np.array([k]), np.array([1]), unit[k : k + 1], y[k : k + 1]) for k in (0, 1))
    assert not J.close_leaves(a, b, 0.4, False).any() and J.close_leaves(a, b, 1.0, False).all()
