"""Reading, writing, the derived book, and the splitting of hot groups."""

import os

import pyarrow.parquet as pq
import pytest
from conftest import claim, frame, rows
from pyspark.sql import functions as F

from claimlens import schemas, session
from claimlens.functions.sizing import evaluated_once
from claimlens.operators import governance, silver
from claimlens.plans import catalog
from claimlens.sources import tables
from checks import book, queries


def test_write_replaces_schema_and_skips_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write(spark.range(3), path)
    assert tables.write(spark.range(2).selectExpr("id as other"), path)
    assert not tables.write(spark.range(0), path)
    assert spark.read.parquet(path).columns == ["other"]
    assert spark.read.parquet(path).count() == 2


def test_clustered_write_keeps_a_value_in_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "M0").otherwise(F.concat(F.lit("M"), F.col("id") % 400)).alias("member_id"),
        F.col("id").alias("claim_id"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write(rows_, path, cluster_by=["member_id", "claim_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    placed = spark.read.parquet(path).select("member_id", F.input_file_name().alias("file")).distinct()
    files = dict(rows(placed.groupBy("member_id").count()))
    assert files["M0"] >= 2  # the member with a third of the rows is cut
    assert sum(n > 1 for m, n in files.items() if m != "M0") <= 4
    assert spark.read.parquet(path).count() == 4000


def rows_scanned(df):
    """(rows found, rows the Parquet scan gave out): row groups that are skipped give none."""
    plan = df._jdf.queryExecution().executedPlan()
    found = plan.executeCollect().__len__()
    while plan.children().size() or "Adaptive" in plan.nodeName():
        plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan.children().head()
    return found, plan.metrics().get("numOutputRows").get().value()


def test_lookups_by_other_keys_skip_row_groups(spark, tmp_path):
    made = spark.range(40000).select(
        F.concat(F.lit("M"), F.col("id") % 400).alias("member_id"),
        F.md5(F.col("id").cast("string")).alias("claim_id"),
        F.when(F.col("id") % 97 == 0, None).otherwise(F.md5((F.col("id") % 9000).cast("string"))).alias("provider_id"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("amount"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for name, by in (("plain", ()), ("found", ("claim_id", "provider_id"))):
            tables.write(made, str(tmp_path / name), cluster_by=["member_id", "claim_id"], find_by=by)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    plain, found = (spark.read.parquet(str(tmp_path / name)) for name in ("plain", "found"))
    some = [r.claim_id for r in made.where("amount in (5, 17, 3001)").collect()]
    assert len(some) == 3
    all_read, few_read = rows_scanned(tables.find(plain, "claim_id", some)), rows_scanned(tables.find(found, "claim_id", some))
    assert all_read[0] == few_read[0] == 3 and few_read[1] <= 4 * 40000 // 40 * 2 and all_read[1] > 4 * few_read[1], (all_read, few_read)
    # more than ten values, absent ones, repeats and nulls
    many = [r.claim_id for r in made.where("amount < 60").collect()] + ["none", None, some[0]]
    want = made.where(F.col("claim_id").isin([m for m in many if m])).exceptAll(tables.find(found, "claim_id", many))
    assert want.isEmpty() and tables.find(found, "claim_id", many).count() == 40
    provider = made.where("amount = 5").first().provider_id
    assert tables.find(found, "provider_id", [provider]).exceptAll(made.where(F.col("provider_id") == provider)).isEmpty()
    assert tables.find(found, "provider_id", [provider]).count() == made.where(F.col("provider_id") == provider).count() > 3
    assert tables.find(found, "provider_id", [None]).isEmpty() and tables.find(found, "provider_id", []).isEmpty()


def test_typed_load_of_records(spark, tmp_path):
    source = tmp_path / "claims.json"
    source.write_text('{"claim_id":"C1","billed_amount":12.5,"requires_manual_review":1}\n{"claim_id":"C2"}\n')
    loaded = tables.load_records(spark, str(source), "claims")
    assert loaded.schema == schemas.CLAIMS
    assert rows(loaded.select("claim_id", "billed_amount", "requires_manual_review"), "claim_id") == [
        ("C1", 12.5, 1),
        ("C2", None, None),
    ]


def test_conform_casts_in_declared_order(spark):
    loose = spark.createDataFrame(
        [("x", "P1", "n", "d", "s")], "in_network string, provider_id string, npi string, provider_name string, specialty string"
    )
    fixed = tables.conform(loose, "providers")
    assert fixed.schema == schemas.PROVIDERS
    assert rows(fixed) == [("P1", "n", "d", "s", None)]


def test_stored_book_reads_declared_schema(spark, tmp_path):
    tables.write(frame(spark, "claims", [claim(1)]), tables.table_path(str(tmp_path), "claims"))
    stored = tables.stored_book(spark, str(tmp_path), ["claims"])
    assert stored["claims"].schema == schemas.CLAIMS
    assert rows(tables.count_inventory(stored)) == [("claims", 1)]


def test_book_tables_have_declared_columns(spark, sf_dir):
    made = book.derived_book(spark, sf_dir)
    for name in ["members", "providers", "disposition_events", "prior_authorizations", "eligibility"]:
        assert [(f.name, f.dataType) for f in made[name].schema] == [(f.name, f.dataType) for f in schemas.TABLES[name]]
    claims, _ = book.claims_with_detail(spark, sf_dir, session.new_dir(spark, "book"))
    assert [(f.name, f.dataType) for f in claims.schema] == [(f.name, f.dataType) for f in schemas.CLAIMS]


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_long_claims_continue_in_further_documents(spark, sf_dir):
    """With a tiny document limit every count and every line must still be there."""
    whole, none = book.claims_with_detail(spark, sf_dir, session.new_dir(spark, "whole"))
    short, more = book.claims_with_detail(spark, sf_dir, session.new_dir(spark, "short"), max_lines=4)
    assert none.isEmpty() and not more.isEmpty()
    longest = F.max(F.json_array_length(F.get_json_object("claim_detail", "$.line_items")))
    assert short.agg(longest).first()[0] < whole.agg(longest).first()[0]
    columns = ["claim_id", "line_count", "copay", "has_cob", "provider_id"]
    assert same(silver.claims_silver(whole, none).select(columns), silver.claims_silver(short, more).select(columns))
    assert same(silver.claim_lines(whole, none), silver.claim_lines(short, more))
    assert same(silver.hybrid_rows(whole, none), silver.hybrid_rows(short, more))


@pytest.fixture(scope="module")
def hot_order(spark, sf_dir, tmp_path_factory):
    """Tables in which one order has a third of all lines, many of them equal, in many files."""
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in ["orders", "customer", "supplier", "events"]:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = F.col("l_partkey") % 3 == 0
    lines = lines.withColumn("l_orderkey", F.when(hot, F.lit(5)).otherwise(F.col("l_orderkey")).cast("bigint"))
    lines.union(lines.where("l_orderkey = 5").limit(300)).repartition(12).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_stored_book_keeps_every_line_of_a_hot_order(spark, hot_order):
    """Two jobs under two partition counts write the tables; lines, counts and documents are whole and the same."""
    want = rows(spark.read.parquet(f"{hot_order}/lineitem.parquet").groupBy("l_orderkey").count(), "l_orderkey")
    for parts, bytes_ in (("3", "64k"), ("7", "128m")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        try:
            folder = session.new_dir(spark, "book")
            queries.write_book(spark, hot_order, folder, max_lines=50)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        stored = tables.stored_book(spark, folder)
        number = F.substring("claim_id", 2, 9).cast("bigint").alias("k")
        for name in ("claims_silver", "claim_lines"):
            catalog.materialize(spark, folder, name, stored)
        lines = tables.load(spark, folder, "claim_lines")
        assert rows(lines.groupBy(number).count(), "k") == want
        counted = tables.load(spark, folder, "claims_silver").where("line_count > 0").select(number, F.col("line_count").cast("bigint"))
        assert rows(counted, "k") == want
        assert stored["claim_documents"].select("claim_id").distinct().count() == 1
        raw = spark.read.parquet(f"{hot_order}/lineitem.parquet").select("l_linenumber", "l_extendedprice")
        assert same(lines.select("line", "charge"), raw.toDF("line", "charge"))


def test_evaluated_once_keeps_rows(spark):
    df = spark.range(4).withColumn("x", F.when(F.col("id") > 1, F.col("id")))
    assert rows(evaluated_once(df, "x"), "id") == rows(df, "id")


def test_shared_dir_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


def test_metric_over_claims_reads_orders_only(spark, sf_dir):
    """The provider join falls away when no provider column is asked for."""
    plan = book.derived_book(spark, sf_dir)["claims"].groupBy("status").count()._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Join" not in physical and "lineitem" not in physical


def test_materialize_and_register(spark, sf_dir, tmp_path):
    made = book.derived_book(spark, sf_dir)
    built = catalog.materialize(spark, str(tmp_path), "disposition_action_gap", made)
    assert built.count() == 3
    names = catalog.register(spark, made)
    assert "denial_reason_dollars" in names and "claims_silver" not in names
    assert spark.sql("SELECT count(*) FROM members WHERE member_ssn NOT LIKE 'XXX-XX-%'").first()[0] == 0
    catalog.register(spark, made, {schemas.PHI_READERS})
    assert spark.sql("SELECT count(*) FROM members WHERE member_ssn NOT LIKE 'XXX-XX-%'").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM members_phi WHERE member_ssn LIKE 'XXX-XX-%'").first()[0] == 0
    catalog.register(spark, made)
    assert not spark.catalog.tableExists("members_phi")
    meta = {f.name: f.metadata for f in spark.table("claims").schema}
    assert "comment" in meta["billed_amount"]


def test_built_tables_count_continued_documents(spark, sf_dir, tmp_path):
    short, more = book.claims_with_detail(spark, sf_dir, session.new_dir(spark, "book"), max_lines=4)
    built = catalog.materialize(spark, str(tmp_path), "claims_silver", {"claims": short, catalog.CONTINUATION: more})
    lines = catalog.materialize(spark, str(tmp_path), "claim_lines", {"claims": short, catalog.CONTINUATION: more})
    assert more.columns == schemas.CLAIM_DOCUMENTS.names
    assert built.agg(F.sum("line_count")).first()[0] == lines.count() == book.raw(spark, sf_dir, "lineitem").count()


def test_materialize_skips_empty(spark, tmp_path):
    empty = {"disposition_events": frame(spark, "disposition_events", [])}
    assert catalog.materialize(spark, str(tmp_path), "open_dispositions_without_action", empty) is None


def test_keyed_write_refuses_null_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_keyed(spark.range(3), path, "id")
    for bad in (spark.range(2).union(spark.range(1)), spark.range(1).selectExpr("cast(null as bigint) as id")):
        with pytest.raises(tables.KeyViolation):
            tables.write_keyed(bad, path, "id")
    assert spark.read.parquet(path).count() == 3


def test_comments_stay_with_a_written_table(spark, sf_dir, tmp_path):
    made = book.derived_book(spark, sf_dir)
    path = tables.table_path(str(tmp_path), "claims")
    tables.write(governance.describe(made["claims"], "claims"), path)
    meta = {f.name: f.metadata for f in spark.read.parquet(path).schema}
    assert "comment" in meta["status"]


def test_streams_read_tables_of_many_files(spark, hot_order):
    events = book.derived_book(spark, hot_order)["disposition_events"]
    assert same(queries.stream_bronze(spark, hot_order), events)


def test_kept_tables_follow_the_raw_ones(spark, hot_order):
    before = queries._version(spark, hot_order)
    spark.range(1).selectExpr("id as o_orderkey").write.mode("append").parquet(f"{hot_order}/extra.parquet")
    assert queries._version(spark, hot_order) != before


def test_claims_are_laid_out_before_their_texts_are_made(spark, sf_dir):
    numbers, _ = book.claims_in_numbers(spark, sf_dir, session.new_dir(spark, "book"))
    made = book.told(tables.laid_out(numbers, ["member_id", "claim_id"]))
    node = made._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "RepartitionByExpression":
        node = node.children().apply(0)
    columns = node.output().mkString(" ")
    assert "claim_id" in columns and "lines" in columns
    assert "claim_detail" not in columns and "cpt" not in columns and "denial_reason" not in columns  # no shuffle carries a text


def test_claims_are_moved_as_their_orders_and_short_lines(spark, sf_dir):
    folder = session.new_dir(spark, "book")
    numbers, _ = book.claims_in_numbers(spark, sf_dir, folder)
    assert set(numbers.columns) == {*book._ORDER_COLUMNS, "sk", "lines", "claim_id", "member_id"}  # nothing that follows from them
    line = {f.name: f.dataType.simpleString() for f in numbers.schema["lines"].dataType.elementType}
    assert line["l_partkey"] == line["l_suppkey"] == "tinyint"
    assert spark.read.parquet(f"{folder}/long_orders").isEmpty()  # written, so its size is known before the lines are read


def test_parts_of_any_sign_give_the_same_line_texts(spark):
    given = [(1, p, s, 2.5) for p in (0, 1, 55, 56, 57, 123456789012, None) for s in (0, 11, 12, 13, None)]
    lines = spark.createDataFrame(given, "l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double").select(F.struct("*").alias("line"))
    both = lines.select(book._line_item(F.col("line")).alias("long"), book._line_item(book._short_line(F.col("line"))).alias("short"))
    assert both.where("to_json(long) <> to_json(short)").isEmpty() and both.count() == len(given)


def test_tables_are_packed_by_zstd(spark, tmp_path):
    path = tables.table_path(str(tmp_path), "t")
    tables.write(spark.range(10), path)
    file = next(p for p in os.listdir(path) if p.endswith(".parquet"))
    assert pq.ParquetFile(f"{path}/{file}").metadata.row_group(0).column(0).compression == "ZSTD"
