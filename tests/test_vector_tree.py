"""The vector tree against brute force, before and after additions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import vector_tree


def brute(vectors, query, n):
    """(key, distance) of the n nearest, to nine decimals, ties by key."""
    q = np.asarray(query, np.float64)
    keys = sorted(k for k, v in vectors.items() if v is not None and np.any(v))
    rows = np.array([vectors[k] for k in keys], np.float64)
    distance = np.round(1 - rows @ q / np.linalg.norm(rows, axis=1) / np.linalg.norm(q), 9)
    order = np.lexsort((np.array(keys), distance))[:n]
    return [(keys[i], distance[i]) for i in order]


def frame(spark, vectors):
    rows = [(k, None if v is None else [float(x) for x in v]) for k, v in vectors.items()]
    return spark.createDataFrame(rows, "claim_id string, embedding array<float>").repartition(4)


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(30, 16))
    at = draw.integers(0, 30, 1500)
    rows = (centers[at] + 0.25 * draw.normal(size=(1500, 16))).astype(np.float32)
    vectors = {f"C{k:05d}": rows[k] for k in range(1500)}
    vectors |= {"D1": rows[0], "D2": rows[0] * 3, "D3": None, "D4": np.zeros(16, np.float32)}
    return vectors, draw


def found(df):
    return [(r.claim_id, r.distance) for r in df.orderBy("rk").collect()]


def test_tree_before_and_after_additions(spark, clustered, tmp_path):
    vectors, draw = clustered
    folder = str(tmp_path)
    first = {k: v for i, (k, v) in enumerate(vectors.items()) if i % 2 == 0}
    later = {k: v for k, v in vectors.items() if k not in first}
    vector_tree.build_tree(frame(spark, first), folder, rows_per_leaf=20, fit_rows=400, branch_rows=60)
    tree = vector_tree.read_tree(spark, folder)
    assert len(tree.branches) > 4 and len(tree.numbers()) > 20
    asked = [vectors[k] for k in list(vectors)[5:1500:400]]
    far = draw.normal(size=16).astype(np.float32)  # like no stored vector: how much must be read is measured on stored ones
    stored = first
    for step in ("built", "added twice"):
        if step != "built":
            for _ in range(2):
                vector_tree.add_notes(frame(spark, later), folder, "later")
            vector_tree.measure(spark, folder)  # half of all rows are new
            stored = vectors
        hits = 0
        for q in [far, *asked]:
            wanted = brute(stored, q, 30)
            assert found(vector_tree.tree_top(spark, folder, q, exact=True)) == [(k, pytest.approx(d, abs=2e-9)) for k, d in wanted]
            hits += 0 if q is far else len({k for k, _ in wanted} & {k for k, _ in found(vector_tree.tree_top(spark, folder, q))})
        assert hits >= 0.95 * 30 * len(asked)
    assert vector_tree.tree_top(spark, folder, asked[0], n=10_000).count() == 1502  # those with a direction, each once


def test_few_leaves_are_read(spark, clustered, tmp_path):
    vectors, _ = clustered
    vector_tree.build_tree(frame(spark, vectors), str(tmp_path), rows_per_leaf=20)
    q = vectors["C00007"]
    near = vector_tree.tree_top(spark, str(tmp_path), q, n=5, exact=True)
    assert found(near) == [(k, pytest.approx(d, abs=2e-9)) for k, d in brute(vectors, q, 5)]
    every, read = spark.read.parquet(f"{tmp_path}/cells").count(), vector_tree.leaves_for(spark, str(tmp_path), q, n=5, exact=True)
    assert 0 < len(read) < every / 2 and len(vector_tree.leaves_for(spark, str(tmp_path), q, n=5)) < every / 2


def test_recall_on_the_given_vectors(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("claim_id"), "embedding")
    vectors = {r.claim_id: np.array(r.embedding, np.float32) for r in rows.collect()}
    half = F.pmod(F.xxhash64("claim_id"), F.lit(2))
    vector_tree.build_tree(rows.where(half == 0), str(tmp_path), rows_per_leaf=40)
    vector_tree.add_notes(rows.where(half == 1), str(tmp_path), "second")
    vector_tree.measure(spark, str(tmp_path))
    hits = asked = 0
    for k in list(vectors)[::151]:
        near = {x for x, _ in found(vector_tree.tree_top(spark, str(tmp_path), vectors[k]))}
        hits += len(near & {x for x, _ in brute(vectors, vectors[k], 30)})
        asked += 30
    assert hits >= 0.95 * asked


def test_odd_tables(spark, tmp_path):
    with pytest.raises(ValueError):
        vector_tree.build_tree(frame(spark, {"a": [0.0, 0.0], "b": None}), str(tmp_path / "none"))
    one = {"a": [1.0, 0.0], "b": [1.0, 0.0]}
    vector_tree.build_tree(frame(spark, one), str(tmp_path / "one"))
    assert found(vector_tree.tree_top(spark, str(tmp_path / "one"), [0.0, 1.0], exact=True)) == [("a", 1.0), ("b", 1.0)]
    vector_tree.add_notes(frame(spark, {"c": [0.0, 2.0]}), str(tmp_path / "one"), "c")
    assert found(vector_tree.tree_top(spark, str(tmp_path / "one"), [0.0, 1.0], n=1, exact=True)) == [("c", 0.0)]
