"""The manual-review model: features, training on the cluster, and the score table."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.nested import has_cob_text
from claimlens.session import new_dir, shared_dir

CATEGORIES = ["status", "denial_reason", "claim_type", "pos_desc", "has_cob"]
# fixed values: what stands for a missing value
FILL = {
    "denial_reason": "none",
    "has_cob": "unknown",
    "claim_type": "unknown",
    "pos_desc": "unknown",
    "status": "unknown",
    "billed_amount": 0.0,
}
#: The widest one-hot column. Which of its values stand for a free-text column is settled by refusing it: the contract of
#: ``CATEGORIES`` is columns of few values, and the indexer keeps every one of them on the driver.
MAX_CATEGORIES = 10_000
#: The amounts that the trees tell apart, as many as Spark ML's trees do by default.
AMOUNT_BINS = 32
#: The fit's cells lie in so many partitions at most: each of its hundreds of passes sends the driver one result a partition.
FIT_PARTS = 32
#: Cells that are worth a partition of their own.
CELLS_PER_PART = 5_000


def review_features(claims: DataFrame) -> DataFrame:
    """Model inputs and label per claim, with missing values filled."""
    return claims.select(
        "claim_id",
        "status",
        "denial_reason",
        "claim_type",
        "pos_desc",
        "billed_amount",
        has_cob_text().alias("has_cob"),
        F.col("requires_manual_review").alias("label"),
    ).na.fill(FILL)


_BITS = 16


def stratified(rows: DataFrame, share: float = 0.25, label: str = "label", key: str = "claim_id", seed: int = 42) -> DataFrame:
    """``rows`` with the flag ``held``: of each class of ``label`` exactly the share, rounded, of its rows, those of smallest key hash.

    The same rows on every run and machine. A histogram of the hashes' leading bits, summed over all rows, tells in which of 65,536
    ranges the cut of a class falls; only the rows of that range are ranked. There is one cut a class, and classes are few: the cuts
    go to the rows, which are never shuffled by their class.
    """
    hashed = rows.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    # Signed numbers in their order: the top bits, shifted with their sign.
    ranged = hashed.withColumn("_range", F.shiftright("_h", 64 - _BITS)).select(F.col(label).alias("_class"), "_h", F.col(key).alias("_key"), "_range")
    counts = ranged.groupBy("_class", "_range").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_class").orderBy("_range")
    wanted = F.floor(F.sum("n").over(Window.partitionBy("_class")) * F.lit(share) + F.lit(0.5))
    summed = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("wanted", wanted)
    cuts = summed.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
    cuts = cuts.select("_class", F.col("_range").alias("_cut"), (F.col("wanted") - F.col("upto") + F.col("n")).alias("left"))
    cuts = F.broadcast(cuts)  # a row a class
    edge = ranged.join(cuts, F.col("_range").eqNullSafe(F.col("_cut")) & ranged["_class"].eqNullSafe(cuts["_class"])).drop(cuts["_class"])
    placed = edge.withColumn("place", F.row_number().over(Window.partitionBy("_class").orderBy("_h", "_key"))).where("place = left")
    last = placed.select(F.col("_class").alias("_of"), F.struct("_h", "_key").alias("_last"))
    met = hashed.join(F.broadcast(last), F.col(label).eqNullSafe(F.col("_of")), "left")
    held = F.coalesce(F.struct(F.col("_h"), F.col(key).alias("_key")) <= F.col("_last"), F.lit(False))
    return met.withColumn("held", held).select(*rows.columns, "held")


def roc_auc(scored: DataFrame, score: str = "manual_review_score", label: str = "label") -> DataFrame:
    """One row, ``auc``: the chance that a positive row scores above a negative one, ties counted half. Exact, over all rows.

    Rows are read once and counted by score before anything is ordered. What lies below a score is summed in two levels: within
    each of 4,096 ranges of scores, and over the ranges' own sums. Null where one of the classes is missing.
    """
    positive = F.col(label).cast("double") == 1
    counts = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    counts = counts.withColumn("range", F.floor(F.col("s") * 4096))
    inside = F.sum("neg").over(Window.partitionBy("range").orderBy("s")) - F.col("neg")
    twice = F.col("pos").cast("decimal(19,0)") * (2 * F.col("inside") + F.col("neg"))
    ranges = counts.withColumn("inside", inside).groupBy("range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(twice).alias("twice")
    )
    below = F.sum("neg").over(Window.orderBy("range")) - F.col("neg")  # 4,097 rows at most for scores in [0, 1]
    wins = F.sum(F.col("twice") + 2 * F.col("pos").cast("decimal(19,0)") * F.col("below"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranges.withColumn("below", below).agg(F.when(pairs > 0, wins.cast("double") / (2 * pairs)).alias("auc"))


def _check_categories(features: DataFrame) -> None:
    """The indexer keeps every category on the driver, so a free-text column must not get there."""
    sizes = features.agg(*[F.approx_count_distinct(c).alias(c) for c in CATEGORIES]).first().asDict()
    large = {c: n for c, n in sizes.items() if n > MAX_CATEGORIES}
    if large:
        raise ValueError(f"not category columns: {large}")


def model_stages(rounds: int, depth: int, rate: float, seed: int) -> list:
    """One-hot categories (an unseen one is all zeros), the standardized amount, and boosted trees."""
    index = StringIndexer(inputCols=CATEGORIES, outputCols=[f"{c}_ix" for c in CATEGORIES], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_hot" for c in CATEGORIES])
    amount = VectorAssembler(inputCols=["billed_amount"], outputCol="amount")
    scaled = StandardScaler(inputCol="amount", outputCol="amount_scaled", withMean=True)
    together = VectorAssembler(inputCols=[*hot.getOutputCols(), "amount_scaled"], outputCol="features")
    trees = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
        maxMemoryInMB=1024,
        checkpointInterval=10,
    )
    return [index, hot, amount, scaled, together, trees]


def _at_most(rows: DataFrame, limit: int, key: str = "claim_id") -> DataFrame:
    """About ``limit`` of the rows by hash of their id; all of them where there are fewer. The fit does not use it: it learns from all rows."""
    many = rows.count()
    step = 1_000_000
    part = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(step))
    return rows if many <= limit else rows.where(part < int(step * limit / many))


def amount_marks(rows: DataFrame, column: str = "amount_scaled", bins: int = AMOUNT_BINS) -> list[float]:
    """At most ``bins`` values of the column, in order: all of its values if there are no more, else the middles of as many equal shares.

    The shares are told by a sketch that every row goes into, to a thousandth of the rows.
    """
    if rows.agg(F.approx_count_distinct(column)).first()[0] <= 2 * bins:
        values = sorted(r[0] for r in rows.select(column).distinct().collect())
        if len(values) <= bins:
            return values
    return sorted(set(rows.stat.approxQuantile(column, [(k + 0.5) / bins for k in range(bins)], 0.001)))


def _marked(column: str, marks: list[float]) -> Column:
    """The mark next to the value; on the middle between two the lower one, as a tree's threshold sends it to the left."""
    nearest = F.when(F.lit(False), F.lit(0.0))
    for low, high in zip(marks, marks[1:]):
        nearest = nearest.when(F.col(column) <= F.lit((low + high) / 2.0), F.lit(low))
    return nearest.otherwise(F.lit(marks[-1]))


def train_review_model(
    features: DataFrame, rounds: int = 100, depth: int = 3, rate: float = 0.1, seed: int = 42
) -> tuple[PipelineModel, float]:
    """Fit on three quarters of the claims; returns the model and its ROC AUC on all the rest.

    The split is written once below the shared folder, and every row of the three quarters is learned from: categories and the amount's
    mean and deviation are taken over all of them, then they are counted by what the trees can tell apart, which is their categories,
    label, and the nearest of ``amount_marks``. The rounds pass over these counted cells, a weight each. Thresholds lie halfway
    between two marks, where ``_marked`` parts the rows, so the trees are those of a fit on the rows themselves with these thresholds.
    There are no more cells than rows, and with few categories they are few however many rows there are. They lie in ``FIT_PARTS``
    partitions at most. Only the trees, marks and category names come to the driver. Save the model with ``model.write().save(path)``.
    """
    spark = features.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    _check_categories(features)
    split = new_dir(spark, "split")
    stratified(features.withColumn("label", F.col("label").cast("double"))).write.parquet(split)
    rows = spark.read.parquet(split)
    learned = rows.where("not held").drop("held")
    index, hot, amount, scaled, together, trees = model_stages(rounds, depth, rate, seed)
    indexed = index.fit(learned)
    encoded = hot.fit(indexed.transform(learned))
    standard = scaled.fit(amount.transform(learned))
    known = standard.transform(amount.transform(learned))
    known = known.select(*CATEGORIES, "label", vector_to_array("amount_scaled")[0].alias("amount_scaled"))
    marked = known.withColumn("amount_scaled", _marked("amount_scaled", amount_marks(known)))
    counted = marked.groupBy(*CATEGORIES, "label", "amount_scaled").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    path = new_dir(spark, "cells")
    counted.write.parquet(path)
    cells = spark.read.parquet(path)
    many = cells.count()
    # The trees look for thresholds in a sample beyond maxBins * maxBins rows: none is taken with this number of bins.
    trees.setWeightCol("weight").setMaxBins(max(AMOUNT_BINS, math.isqrt(many) + 1))
    held = cells.repartition(min(FIT_PARTS, max(2, math.ceil(many / CELLS_PER_PART)))).persist()
    fitted = Pipeline(stages=[indexed, encoded, together, trees]).fit(held)
    held.unpersist()
    model = PipelineModel([indexed, encoded, amount, standard, together, fitted.stages[-1]])
    judged = model.transform(rows.where("held")).select("label", vector_to_array("probability")[1].alias("manual_review_score"))
    return model, roc_auc(judged).first()["auc"]


def score_claims(model: PipelineModel, features: DataFrame) -> DataFrame:
    """(claim_id, manual_review_score): the probability of needing a review, for every claim."""
    score = vector_to_array("probability")[1].alias("manual_review_score")
    return model.transform(features.drop("label")).select("claim_id", score)
