import numpy as np
import pytest
from conftest import claim, frame, rows
from pyspark.sql import functions as F

from checks import queries
from claimlens.functions.scores import tier
from claimlens.operators import scoring


def test_features_fill(spark):
    made = [
        claim(1, claim_detail="{broken", status=None, pos_desc=None, claim_type=None, billed_amount=None),
        claim(2, denial_reason="Non-covered charge", requires_manual_review=1),
    ]
    got = scoring.review_features(frame(spark, "claims", made))
    assert rows(got, "claim_id") == [
        ("C1", "unknown", "none", "unknown", "unknown", 0.0, "unknown", 0),
        ("C2", "Paid", "Non-covered charge", "837P Professional", "Office", 100.0, "true", 1),
    ]


def brute_auc(scores, labels):
    up, down = scores[labels], scores[~labels]
    return ((up[:, None] > down).sum() + 0.5 * (up[:, None] == down).sum()) / (len(up) * len(down))


def test_split_takes_the_exact_share_of_each_class(spark):
    ids = spark.range(20000).select(F.concat(F.lit("C"), "id").alias("claim_id"), F.when(F.col("id") % 7 == 0, 1.0).when(F.col("id") % 1001 != 1, 0.0).alias("label"))
    few = spark.createDataFrame([("a", 2.0), ("b", 3.0), ("c", 3.0), ("d", 3.0)], "claim_id string, label double")
    table = ids.union(few)
    got = scoring.stratified(table)
    by_class = {}
    for r in table.withColumn("h", F.xxhash64("claim_id", F.lit(42))).collect():
        by_class.setdefault(r.label, []).append((r.h, r.claim_id))
    wanted = {key for rows_ in by_class.values() for _, key in sorted(rows_)[: int(len(rows_) * 0.25 + 0.5)]}
    told = {r.claim_id for r in got.where("held").collect()}
    assert told == wanted and got.columns == ["claim_id", "label", "held"] and got.count() == 20004
    again = scoring.stratified(table.repartition(7))
    assert again.exceptAll(got).isEmpty()
    assert scoring.stratified(table.limit(0)).count() == 0


def test_auc_is_exact_with_ties(spark):
    draw = np.random.default_rng(1)
    for scores in (draw.random(3000), np.round(draw.random(3000), 2), np.full(50, 0.5), np.array([0.0, 1.0, 1.0, 0.0])):
        labels = draw.random(len(scores)) < 0.2 + 0.5 * scores
        labels[0], labels[-1] = True, False
        made = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)] + [(None, 1), (0.3, None)], "manual_review_score double, label int")
        assert abs(scoring.roc_auc(made.repartition(5)).first().auc - brute_auc(scores, labels)) < 1e-12
    one = spark.createDataFrame([(0.5, 1)], "manual_review_score double, label int")
    assert scoring.roc_auc(one).first().auc is None and scoring.roc_auc(one.limit(0)).first().auc is None


def test_tiers(spark):
    cuts = spark.createDataFrame([(0.0,), (0.33,), (0.65,), (0.66,), (1.0,)], "s double")
    assert [r[0] for r in cuts.select(tier(F.col("s"))).collect()] == ["low", "med", "med", "high", "high"]


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    features = queries.features(spark, sf_dir).persist()
    model, auc = scoring.train_review_model(features, rounds=10)
    return features, model, auc


def test_model_learns(trained):
    assert trained[2] > 0.8


def test_every_claim_gets_a_score(spark, sf_dir, trained):
    features, model, _ = trained
    scored = scoring.score_claims(model, features)
    assert scored.columns == ["claim_id", "manual_review_score"]
    assert scored.count() == features.count() == 1500
    assert scored.where("manual_review_score < 0 OR manual_review_score > 1 OR manual_review_score IS NULL").isEmpty()
    mean = dict(rows(scored.join(features, "claim_id").groupBy("status").agg(F.avg("manual_review_score"))))
    assert mean["Denied"] > mean["Paid"]
    assert scoring.score_claims(model, features.repartition(5)).exceptAll(scored).isEmpty()


def test_unseen_category_is_all_zeros(spark, trained):
    features, model, _ = trained
    odd = features.limit(1).withColumn("denial_reason", F.lit("never seen"))
    assert 0 <= scoring.score_claims(model, odd).first().manual_review_score <= 1
    hot = model.transform(odd).select("denial_reason_hot").first()[0]
    assert hot.numNonzeros() == 0


def test_free_text_is_not_a_category(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_CATEGORIES", 50)
    made = frame(spark, "claims", [claim(i, denial_reason=f"reason {i}") for i in range(200)])
    with pytest.raises(ValueError, match="denial_reason"):
        scoring.train_review_model(scoring.review_features(made))


def test_fit_rows_are_bounded(spark):
    ids = spark.range(20000).select(F.concat(F.lit("C"), "id").alias("claim_id"))
    assert abs(scoring._at_most(ids, 5000).count() - 5000) < 400
    assert scoring._at_most(ids, 20000).count() == 20000


def test_passes_of_the_fit_have_few_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(scoring, "FIT_PARTS", 2)
    seen = []

    class Seen(scoring.Pipeline):
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return super().fit(rows)

    monkeypatch.setattr(scoring, "Pipeline", Seen)
    features = queries.features(spark, sf_dir).repartition(24).persist()
    model, auc = scoring.train_review_model(features, rounds=4)
    assert auc > 0.8 and seen == [2]  # not a task a partition of the table in every pass
    assert scoring.score_claims(model, features).count() == features.count()


def test_classes_are_not_dealt_to_a_task_each(spark):
    ids = spark.range(2000).select(F.concat(F.lit("C"), "id").alias("claim_id"), (F.col("id") % 2).cast("double").alias("label"))
    split = scoring.stratified(ids.repartition(6))
    assert "SortMergeJoin" not in split._jdf.queryExecution().executedPlan().toString()  # the rows stay where they are
    per_task = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) == 6 and max(r["count"] for r in per_task) < 700


def test_auc_reads_the_scores_once(spark, tmp_path):
    spark.createDataFrame([(0.2, 0), (0.7, 1), (0.7, 0)], "manual_review_score double, label int").write.parquet(str(tmp_path / "s"))
    auc = scoring.roc_auc(spark.read.parquet(str(tmp_path / "s")))
    assert auc._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert auc.first().auc == 0.75


def many_claims(spark, n, amount):
    """Claims without a table behind them; ``amount`` is SQL over ``id``."""
    return spark.range(0, n, numPartitions=4).selectExpr(
        "concat('C', id) as claim_id", "array('Paid', 'Denied')[cast(id % 2 as int)] as status", "concat('r', id % 5) as denial_reason",
        "'837P' as claim_type", "array('Office', 'Home', 'Clinic')[cast(id % 3 as int)] as pos_desc", f"cast({amount} as double) as billed_amount",
        "'true' as has_cob", "case when hash(id) % 7 = 0 or (id % 2 = 1 and id % 11 < 5) then 1 else 0 end as label",
    )


def test_every_claim_of_a_large_table_is_learned_from(spark):
    made = many_claims(spark, 800_000, "id % 90001").withColumn("denial_reason", F.expr("case when cast(substr(claim_id, 2) as int) % 2000 = 7 then claim_id else 'none' end"))
    want = {r.denial_reason for r in scoring.stratified(made).where("not held and denial_reason <> 'none'").collect()}
    model, _ = scoring.train_review_model(made, rounds=1, depth=1)
    known = dict(zip(scoring.CATEGORIES, model.stages[0].labelsArray))
    assert len(want) > 250 and set(known["denial_reason"]) == want | {"none"}


def test_fit_on_counted_cells_is_the_fit_on_the_rows(spark, monkeypatch):
    made = many_claims(spark, 9000, "100 * (id * id % 29)").persist()  # 29 amounts at most: the trees may split between any two
    weights = []

    class Seen(scoring.Pipeline):
        def fit(self, rows):
            weights.append((rows.agg(F.sum("weight")).first()[0], rows.count()))
            return super().fit(rows)

    plain = scoring.Pipeline(stages=scoring.model_stages(8, 3, 0.1, 42))
    monkeypatch.setattr(scoring, "Pipeline", Seen)
    model, _ = scoring.train_review_model(made, rounds=8)
    learned = scoring.stratified(made.withColumn("label", F.col("label").cast("double"))).where("not held")
    assert weights[0][0] == learned.count() and weights[0][1] < 3000
    both = scoring.score_claims(model, made).join(scoring.score_claims(plain.fit(learned), made).toDF("claim_id", "plain"), "claim_id")
    assert both.where("abs(manual_review_score - plain) > 1e-9").isEmpty() and both.count() == 9000


def test_marks_part_the_amounts_where_the_trees_do(spark):
    values = spark.range(100_000).select((F.col("id") * F.col("id") / 1e6).alias("amount_scaled"))
    marks = scoring.amount_marks(values)
    assert len(marks) == scoring.AMOUNT_BINS and marks == sorted(marks)
    assert all(abs(m - ((k + 0.5) / 32 * 1e5) ** 2 / 1e6) < 200 for k, m in enumerate(marks))
    cuts = spark.createDataFrame([((a + b) / 2.0, a) for a, b in zip(marks, marks[1:])] + [(1e9, marks[-1]), (-1.0, marks[0])], "amount_scaled double, mark double")
    assert cuts.where(scoring._marked("amount_scaled", marks) != F.col("mark")).isEmpty()
    assert scoring.amount_marks(spark.createDataFrame([(3.0,), (1.0,), (3.0,)], "amount_scaled double")) == [1.0, 3.0]
