"""Near search over many vectors: a tree of two k-means levels that takes additions, with answers that can be proved complete."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.retrieval import _probes_for, vector_top
from claimlens.sources.tables import write

#: Branches, and leaves a branch, at most: 65,536 leaves in all, whose centers are what the driver and each task hold.
FAN_OUT = 256


@dataclass(frozen=True)
class Tree:
    """The centers of a tree: the branches' and, in the same order, each branch's leaves'. A leaf's number is branch * width + place."""

    branches: np.ndarray
    leaves: list[np.ndarray]
    width: int

    def numbers(self) -> np.ndarray:
        return np.concatenate([b * self.width + np.arange(len(x)) for b, x in enumerate(self.leaves)])

    def centers(self) -> np.ndarray:
        return np.concatenate(self.leaves)

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf number, angle to its center) of unit vectors: the nearest branch, then its nearest leaf."""
        branch = (unit @ self.branches.T).argmax(axis=1)
        leaf, cosine = np.empty(len(unit), np.int64), np.empty(len(unit))
        for b in np.unique(branch).tolist():
            of = np.flatnonzero(branch == b)
            near = unit[of] @ self.leaves[b].T
            place = near.argmax(axis=1)
            leaf[of], cosine[of] = b * self.width + place, near[np.arange(len(of)), place]
        return leaf, np.arccos(np.clip(cosine, -1, 1))


def _unit(vectors) -> np.ndarray:
    rows = np.stack(list(vectors)).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _pointed(notes: DataFrame) -> DataFrame:
    """Rows without a direction are near nothing."""
    return notes.where(F.exists("embedding", lambda x: x != 0))


def _means(unit: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of a bounded number of rows: unit centers, k of them or one a distinct row."""
    unit = np.unique(unit, axis=0)
    draw = np.random.default_rng(seed)
    if len(unit) <= k:
        return unit
    centers = unit[draw.choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        near = (unit @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(length > 0, sums / np.where(length > 0, length, 1), centers)
    return centers


def _sampled(rows: DataFrame, share, key: str) -> DataFrame:
    """The rows whose key hashes below ``share``: the same ones however the table is read."""
    return rows.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 20)) < share * (1 << 20))


def _fit(pointed: DataFrame, rows: int, rows_per_leaf: int, fit_rows: int, branch_rows: int, seed: int, key: str) -> Tree:
    leaves = max(1, min(FAN_OUT * FAN_OUT, rows, math.ceil(rows / rows_per_leaf)))
    n_branches = max(2, math.ceil(math.sqrt(leaves)))
    width = math.ceil(leaves / n_branches)
    sample = _sampled(pointed, F.lit(fit_rows / rows), key) if rows > fit_rows else pointed
    model = KMeans(featuresCol="_v", predictionCol="_b", k=n_branches, seed=seed, distanceMeasure="cosine").fit(
        sample.select(array_to_vector("embedding").alias("_v"))
    )
    branches = _unit([c for c in model.clusterCenters() if np.linalg.norm(c) > 0])

    def branch(batches):
        for batch in batches:
            batch["_b"] = (_unit(batch["embedding"]) @ branches.T).argmax(axis=1).astype(np.int32)
            yield batch

    dealt = pointed.select(key, "embedding").mapInPandas(branch, T.StructType([*pointed.select(key, "embedding").schema.fields, T.StructField("_b", T.IntegerType())]))
    # A branch learns its leaves from about ``branch_rows`` of its own rows, however many it has.
    counts = {r["_b"]: r["n"] for r in dealt.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a branch
    shares = F.element_at(F.array(*[F.lit(min(1.0, branch_rows / max(1, counts.get(b, 0)))) for b in range(len(branches))]), F.col("_b") + 1)

    def leaf(group: pd.DataFrame) -> pd.DataFrame:
        centers = _means(_unit(group["embedding"]), width, seed)
        return pd.DataFrame({"_b": group["_b"].iloc[0], "center": list(centers)})

    found = _sampled(dealt, shares, key).groupBy("_b").applyInPandas(leaf, "_b int, center array<double>").collect()  # FAN_OUT ** 2 rows at most
    of = {b: [r["center"] for r in found if r["_b"] == b] for b in range(len(branches))}
    return Tree(branches, [np.array(of[b]) if of[b] else branches[b : b + 1] for b in range(len(branches))], width)


def _write_tree(spark: SparkSession, path: str, tree: Tree) -> None:
    rows = [(b, -1, x.tolist(), tree.width) for b, x in enumerate(tree.branches)]
    rows += [(b, k, x.tolist(), tree.width) for b, leaves in enumerate(tree.leaves) for k, x in enumerate(leaves)]
    write(spark.createDataFrame(rows, "branch int, leaf int, center array<double>, width int"), f"{path}/tree")


def read_tree(spark: SparkSession, path: str) -> Tree:
    rows = spark.read.parquet(f"{path}/tree").orderBy("branch", "leaf").collect()  # FAN_OUT ** 2 + FAN_OUT rows at most
    branches = [r["center"] for r in rows if r["leaf"] < 0]
    leaves: list[list] = [[] for _ in branches]
    for r in rows:
        if r["leaf"] >= 0:
            leaves[r["branch"]].append(r["center"])
    return Tree(np.array(branches), [np.array(x) for x in leaves], rows[0]["width"])


def _add(notes: DataFrame, path: str, tree: Tree, batch: str, key: str) -> None:
    def place(batches):
        for rows in batches:
            rows["cell"], rows["angle"] = tree.place(_unit(rows["embedding"])) if len(rows) else (0, 0.0)
            rows["branch"] = rows["cell"] // tree.width
            yield rows

    added = [T.StructField("cell", T.LongType()), T.StructField("angle", T.DoubleType()), T.StructField("branch", T.LongType())]
    pointed = _pointed(notes)
    placed = pointed.mapInPandas(place, T.StructType([*pointed.schema.fields, *added]))
    laid = placed.repartitionByRange("branch", "cell", key).sortWithinPartitions("branch", "cell", key)
    laid.write.mode("overwrite").partitionBy("branch").parquet(f"{path}/rows/batch={batch}")
    stored = notes.sparkSession.read.parquet(f"{path}/rows/batch={batch}")
    figures = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    figures.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells/batch={batch}")


def build_tree(
    notes: DataFrame, path: str, rows_per_leaf: int = 2000, recall: float = 0.98, fit_rows: int = 100_000, branch_rows: int = 20_000, seed: int = 42,
    key: str = "claim_id",
) -> None:
    """Lay ``notes`` (key, embedding and what else they hold) out below ``path`` by the leaf their vector falls in.

    Branches are fitted on about ``fit_rows`` rows, the leaves of a branch on about ``branch_rows`` of its own: bounds of samples;
    every row is placed, by one comparison with each branch and each leaf of its branch. How many leaves a question must
    read is measured (``measure``).
    """
    pointed = _pointed(notes)
    rows = pointed.count()
    if not rows:
        raise ValueError("no vector to index")
    tree = _fit(pointed, rows, rows_per_leaf, fit_rows, branch_rows, seed, key)
    _write_tree(notes.sparkSession, path, tree)
    _add(notes, path, tree, "start", key)
    measure(notes.sparkSession, path, recall, key=key)


def add_notes(notes: DataFrame, path: str, batch: str, key: str = "claim_id") -> None:
    """Place further notes into the leaves there are, as one named batch; a batch that is added again replaces itself.

    Nothing stored is read or moved: the cost is that of the batch. ``measure`` afterwards, when much has been added: the number of leaves to read was found on what was there.
    """
    _add(notes, path, read_tree(notes.sparkSession, path), batch, key)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("batch")


def measure(spark: SparkSession, path: str, recall: float = 0.98, asked: int = 64, n: int = 30, key: str = "claim_id") -> int:
    """Find and keep how many leaves hold the share ``recall`` of the true ``n`` nearest of ``asked`` stored vectors, over all rows."""
    tree, stored = read_tree(spark, path), _stored(spark, path)
    numbers, centers = tree.numbers(), tree.centers()
    questions = stored.orderBy(F.xxhash64(key), key).limit(asked).select("embedding").collect()
    wide = np.zeros((int(numbers.max()) + 1, centers.shape[1]))  # leaves that were never made have no direction: last in any order
    wide[numbers] = centers
    probes = _probes_for(stored.select("cell", "embedding", key), wide, np.array([q["embedding"] for q in questions], np.float64), n, recall, key)
    write(spark.createDataFrame([(probes,)], "probes int"), f"{path}/probes")
    return probes


def tree_top(spark: SparkSession, path: str, query: Sequence[float], n: int = 30, key: str = "claim_id", exact: bool = False) -> DataFrame:
    """The n nearest rows by cosine distance, ranked, from the leaves nearest to the question; n rows whenever there are as many.

    Reads as many leaves as were measured to be enough for questions like the stored vectors. With ``exact`` the answer is that of a search over everything (``leaves_for``).
    """
    return _nearest_in(spark, path, leaves_for(spark, path, query, n, key, exact), query, n, key)


def leaves_for(spark: SparkSession, path: str, query: Sequence[float], n: int = 30, key: str = "claim_id", exact: bool = False) -> list[int]:
    """The leaves that ``tree_top`` reads.

    No row of a leaf is nearer than the angle to its center less the leaf's radius. An exact answer reads what these bounds cannot
    rule out against the n-th row of the answer from the nearest leaves, and nothing else.
    """
    leaves, angle = _in_order(spark, path, query)
    probes = spark.read.parquet(f"{path}/probes").first()["probes"]
    cells = spark.read.parquet(f"{path}/cells").groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
    figures = {r["cell"]: (r["n"], r["radius"]) for r in cells.collect()}  # a row a leaf
    taken, held = [], 0
    for k, cell in enumerate(leaves):
        if k >= probes and held >= n:
            break
        if cell in figures:
            held += figures[cell][0]
            taken.append(cell)
    if not exact:
        return taken
    farthest = _nearest_in(spark, path, taken, query, n, key).agg(F.max("distance")).first()[0] if held >= n else None
    # Distances are rounded to nine decimals: what rounds to the n-th distance can still win by its key.
    reach = math.pi if farthest is None else math.acos(max(-1.0, min(1.0, 1 - farthest - 1e-9))) + 1e-9
    return [cell for cell in leaves if cell in figures and angle[cell] - figures[cell][1] <= reach]


def _in_order(spark: SparkSession, path: str, query: Sequence[float]) -> tuple[list[int], dict[int, float]]:
    tree = read_tree(spark, path)
    asked = np.asarray(query, np.float64)
    length = np.linalg.norm(asked)
    angle = np.arccos(np.clip(tree.centers() @ (asked / length if length else asked), -1, 1))
    numbers = tree.numbers()
    return numbers[np.argsort(angle, kind="stable")].tolist(), dict(zip(numbers.tolist(), angle.tolist()))


def _nearest_in(spark: SparkSession, path: str, cells: list[int], query: Sequence[float], n: int, key: str) -> DataFrame:
    width = spark.read.parquet(f"{path}/tree").first()["width"]
    rows = _stored(spark, path).where(F.col("branch").isin(sorted({c // width for c in cells})) & F.col("cell").isin(cells))
    return vector_top(rows.drop("branch", "angle"), query, n, key)
