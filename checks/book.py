"""The claims book derived from the order, customer, supplier and event tables.

The relational columns are SQL expressions that mean the same in Spark and in an ANSI SQL engine;
``BOOK`` holds them as text so that a check can state the same table elsewhere. The JSON claim
detail is built in Spark only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.sources.tables import Book


def _case(values: list[str]) -> str:
    """A CASE over {0} that gives the values in order, the last for everything else."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {{0}} {arms} else '{values[-1]}' end"


_CPT_BY = _case(list(schemas.CPT))
_DX_BY = _case(schemas.ICD10)
_CLAIM_ID = "concat('C', lpad(cast({0} as string), 9, '0'))"
_MEMBER_ID = "concat('M', lpad(cast({0} as string), 7, '0'))"
_PROVIDER_ID = "concat('P', lpad(cast({0} as string), 6, '0'))"

# table -> (the table or CTE it selects from, {column: expression})
BOOK: dict[str, tuple[str, dict[str, str]]] = {
    "claim_base": (
        "orders",
        {
            "k": "o_orderkey",
            "custkey": "o_custkey",
            "p": "cast(round(o_totalprice * 100) as bigint)",
            "received_date": "substr(cast(o_orderdate as string), 1, 10)",
            "service_date": "substr(cast(o_orderdate - interval 30 days as string), 1, 10)",
            "status": "case when (o_orderkey * 7919) % 100 < 63 then 'Paid' "
            "when (o_orderkey * 7919) % 100 < 76 then 'Denied' "
            "when (o_orderkey * 7919) % 100 < 92 then 'Pending' else 'Partially Paid' end",
            "place_of_service": "case o_orderpriority when '1-URGENT' then '23' when '2-HIGH' then '21' "
            "when '3-MEDIUM' then '22' when '4-NOT SPECIFIED' then '11' else '02' end",
        },
    ),
    "claim_amounts": (
        "claim_base",
        {
            "k": "k",
            "custkey": "custkey",
            "p": "p",
            "received_date": "received_date",
            "service_date": "service_date",
            "status": "status",
            "place_of_service": "place_of_service",
            "billed_amount": "cast(p % 500000 + 4000 as double) / 100",
            "allowed_amount": "case status "
            "when 'Paid' then floor(cast((p % 500000 + 4000) * (55 + p % 36) as double) / 100) / 100 "
            "when 'Partially Paid' then floor(cast((p % 500000 + 4000) * (30 + p % 31) as double) / 100) / 100 "
            "else cast(0 as double) end",
            "ci": "case when status in ('Denied', 'Partially Paid') then p % 8 end",
        },
    ),
    "claim_provider": (
        "lineitem group by l_orderkey",
        {"k": "l_orderkey", "sk": "min(l_suppkey)", "n_lines": "count(*)"},
    ),
    "members": (
        "customer",
        {
            "member_id": _MEMBER_ID.format("c_custkey"),
            "subscriber_id": "concat('S', lpad(cast(c_custkey - c_custkey % 2 as string), 7, '0'))",
            "member_name": "c_name",
            "member_ssn": "concat(cast(100 + c_custkey % 900 as string), '-', "
            "cast(10 + (c_custkey * 7) % 90 as string), '-', cast(1000 + (c_custkey * 7919) % 9000 as string))",
            "member_dob": "concat(cast(1944 + c_custkey % 63 as string), '-', "
            "lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'))",
            "plan_type": "case c_mktsegment when 'AUTOMOBILE' then 'HMO' when 'BUILDING' then 'PPO' "
            "when 'FURNITURE' then 'EPO' when 'HOUSEHOLD' then 'Medicare Advantage' else 'Medicaid' end",
            "state": "case c_nationkey % 5 when 0 then 'MI' when 1 then 'OH' when 2 then 'IN' "
            "when 3 then 'IL' else 'WI' end",
        },
    ),
    "providers": (
        "supplier",
        {
            "provider_id": _PROVIDER_ID.format("s_suppkey"),
            "npi": "cast(1000000000 + s_suppkey as string)",
            "provider_name": "s_name",
            "specialty": _case(schemas.SPECIALTIES).format("s_nationkey % 7"),
            "in_network": "s_suppkey % 20 >= 3",
        },
    ),
    "claims": (
        "claim_amounts left join claim_provider using (k)",
        {
            "claim_id": _CLAIM_ID.format("k"),
            "member_id": _MEMBER_ID.format("custkey"),
            "provider_id": _PROVIDER_ID.format("coalesce(sk, 0)"),
            "claim_type": "case when k % 2 = 0 then '837P Professional' else '837I Institutional' end",
            "status": "status",
            "billed_amount": "billed_amount",
            "allowed_amount": "allowed_amount",
            "paid_amount": "case status when 'Paid' then allowed_amount "
            "when 'Partially Paid' then floor(allowed_amount * 70) / 100 else cast(0 as double) end",
            "denial_carc": f"case when ci is not null then {_case(list(schemas.DENIAL_REASONS)).format('ci')} end",
            "denial_reason": f"case when ci is not null then {_case(list(schemas.DENIAL_REASONS.values())).format('ci')} end",
            "place_of_service": "place_of_service",
            "pos_desc": "case place_of_service "
            + " ".join(f"when '{code}' then '{words}'" for code, words in schemas.PLACES_OF_SERVICE.items())
            + " end",
            "primary_cpt": _CPT_BY.format("(p * 13) % 8"),
            "primary_dx": _DX_BY.format("p % 7"),
            "service_date": "service_date",
            "received_date": "received_date",
            "requires_manual_review": "case when (status in ('Denied', 'Partially Paid') and (p * 31) % 97 < 44) "
            "or (billed_amount > 3000 and (p * 17) % 89 < 27) then 1 else 0 end",
        },
    ),
    "disposition_events": (
        "claim_base where status <> 'Pending'",
        {
            "event_id": "concat('E', lpad(cast(k as string), 9, '0'))",
            "claim_id": _CLAIM_ID.format("k"),
            "disposition": "status",
            "disposition_ts": "concat(received_date, 'T', lpad(cast(k % 24 as string), 2, '0'), ':', "
            "lpad(cast((k * 7) % 60 as string), 2, '0'), ':00')",
            "downstream_action_fired": "(k * 131) % 1009 < 605",
            "action_type": "case when (k * 131) % 1009 < 605 then case k % 3 when 0 then 'member_notice' "
            "when 1 then 'appeal_route' else 'payment_integrity_review' end end",
        },
    ),
    "disposition_updates": (
        "events",
        {
            "event_id": "concat('U', lpad(cast(event_id as string), 9, '0'))",
            "claim_id": _CLAIM_ID.format("user_id"),
            "disposition": "case event_type when 'error' then 'Denied' when 'signup' then 'Partially Paid' "
            "else 'Paid' end",
            "disposition_ts": "ts",
            "downstream_action_fired": "event_id % 10 < 6",
        },
    ),
    "prior_authorizations": (
        "claim_base join claim_provider using (k) where k % 3 = 0",
        {
            "pa_id": "concat('PA', lpad(cast(k as string), 8, '0'))",
            "member_id": _MEMBER_ID.format("custkey"),
            "provider_id": _PROVIDER_ID.format("sk"),
            "cpt": _CPT_BY.format("p % 8"),
            "status": "case p % 3 when 0 then 'Approved' when 1 then 'Denied' else 'Pending' end",
            "requested_date": "service_date",
        },
    ),
    "eligibility": (
        "members",
        {
            "member_id": "member_id",
            "plan_type": "plan_type",
            "effective_date": "concat(cast(1994 + cast(right(member_id, 7) as int) % 2 as string), '-01-01')",
            "term_date": "case when cast(right(member_id, 7) as int) % 10 = 3 then '2001-06-30' end",
            "active": "cast(right(member_id, 7) as int) % 10 <> 7",
        },
    ),
    "claim_review_priority": (
        "claim_base",
        {"claim_id": _CLAIM_ID.format("k"), "manual_review_score": "cast((p * 37) % 1000 as double) / 1000"},
    ),
}


def columns(df: DataFrame, name: str) -> DataFrame:
    """Apply one table's expressions."""
    return df.selectExpr(*[f"{expr} as {column}" for column, expr in BOOK[name][1].items()])


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the JSON detail --------------------------------------------------------------------------


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _choice(options: list[list[str]], index: Column) -> Column:
    """One of several short string lists."""
    lists = [F.array(*[F.lit(v) for v in o]).cast("array<string>") for o in options]
    return F.element_at(F.array(*lists), (index + 1).cast("int"))


def _line_item(line: Column) -> Column:
    part, supplier = line["l_partkey"], line["l_suppkey"]
    return F.struct(
        line["l_linenumber"].cast("int").alias("line"),
        _pick(list(schemas.CPT), part % 8).alias("cpt"),
        _pick(list(schemas.CPT.values()), part % 8).alias("cpt_desc"),
        (supplier % 3 + 1).cast("int").alias("units"),
        line["l_extendedprice"].alias("charge"),
        _choice([[], ["25"], ["59", "LT"], ["GT"]], part % 4).alias("modifiers"),
        F.array(_pick(schemas.ICD10, part % 7)).alias("dx_pointers"),
        _pick(schemas.REVENUE_CODES, supplier % 4).alias("rev_code"),
    )


_NUMBERS = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
# what the claims table is derived from in an order
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _short_line(line: Column) -> Column:
    """A line with what its texts ask of part and supplier: the remainders by all that ``_line_item`` divides them by (8, 7, 4; 3, 4)."""
    return F.struct(
        line["l_linenumber"].alias("l_linenumber"),
        (line["l_partkey"] % 56).cast("tinyint").alias("l_partkey"),
        (line["l_suppkey"] % 12).cast("tinyint").alias("l_suppkey"),
        line["l_extendedprice"].alias("l_extendedprice"),
    )


def _grouped(dealt: DataFrame, *keys: str) -> DataFrame:
    """The lines of each document as an array of their four numbers, in order."""
    return dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*_NUMBERS))).alias("lines"))


def _line_documents(spark: SparkSession, sf_dir: str, folder: str, max_lines: int) -> tuple[DataFrame, DataFrame]:
    """(k, lines) of the orders of at most ``max_lines`` lines, and (k, part, lines) of the longer ones, in documents of about
    ``max_lines`` at most.

    Shuffles carry the four numbers of a line; its texts are written out after them. An order of more lines is dealt
    into parts by what a line says and, among equal lines, by its number, so the parts do not depend on how the table is
    read. The parts of an order are found with one count, aggregated before its shuffle; the long orders, few or none, are written
    below ``folder``, so that their size is known and all other lines are shuffled once, by the grouping.
    """
    lines = raw(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), *_NUMBERS)
    n_parts = F.ceil(F.col("n") / F.lit(max(max_lines // 2, 1))).cast("int").alias("parts")
    long = lines.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_lines).select("k", n_parts)
    path = f"{folder}/long_orders"
    long.write.mode("overwrite").parquet(path)
    long = spark.read.schema(long.schema).parquet(path)
    equal = lines.join(long, "k").groupBy("k", "parts", *_NUMBERS).agg(F.count(F.lit(1)).alias("copies"))
    each = equal.select("k", "parts", *_NUMBERS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    part = F.pmod(F.xxhash64(*_NUMBERS, "copy"), F.col("parts").cast("long")).cast("int").alias("part")
    return _grouped(lines.join(long, "k", "left_anti"), "k"), _grouped(each.select("k", part, *_NUMBERS), "k", "part")


def _adjudication() -> Column:
    return F.struct(
        F.expr("p % 100 >= 85").alias("coordination_of_benefits"),
        _pick([schemas.NO_PAYER, "Medicare", "Commercial"], F.col("p") % 3).alias("cob_payer"),
        F.expr("(p % 5001) / 100").alias("copay"),
        F.expr("(p % 31) / 100").alias("coinsurance"),
        F.expr("(p % 20001) / 100").alias("deductible_applied"),
        _choice([[], ["NCCI-PTP"], ["MUE", "frequency"], ["age-gender"]], F.col("p") % 4).alias("edits_triggered"),
    )


def _document_json(adjudication: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("837").alias("edi_source"),
            F.expr("concat('CH', cast(100 + p % 900 as string))").alias("clearinghouse_id"),
            F.coalesce(F.transform("lines", _line_item), F.array().cast(f"array<{schemas.LINE_ITEM}>")).alias("line_items"),
            adjudication.alias("adjudication"),
        )
    )


def claims_in_numbers(
    spark: SparkSession, sf_dir: str, folder: str, max_lines: int = schemas.MAX_DOCUMENT_LINES
) -> tuple[DataFrame, DataFrame]:
    """Claims before their texts are written out, and the further documents (claim_id, part, claim_detail) of long claims.

    ``told`` makes the claims table of the first. Until then a claim is what it is derived from and the numbers of its lines,
    which is a small part of its detail, so it is moved and sorted in this form. The documents of long claims are written
    below ``folder`` once, as both tables need them; all other lines meet their claims in the shuffle that groups them.
    """
    whole, dealt = _line_documents(spark, sf_dir, folder, max_lines)
    path = f"{folder}/line_documents"
    dealt.write.mode("overwrite").parquet(path)
    documents = spark.read.schema(dealt.schema).parquet(path)
    orders = raw(spark, sf_dir, "orders").select(*_ORDER_COLUMNS, F.col("o_orderkey").alias("k"))
    first = documents.where("part = 0").select("k", F.col("lines").alias("first_lines"))
    # Lines grow with the claims: they are never worth a broadcast.
    joined = orders.join(_claim_provider(spark, sf_dir), "k", "left").join(whole.hint("merge"), "k", "left").join(first, "k", "left")
    ids = [F.expr(_CLAIM_ID.format("k")).alias("claim_id"), F.expr(_MEMBER_ID.format("o_custkey")).alias("member_id")]
    lines = F.transform(F.coalesce("lines", "first_lines"), _short_line).alias("lines")
    numbers = joined.select(*_ORDER_COLUMNS, "sk", lines, *ids)
    more = (
        documents.where("part > 0")
        .join(_base(spark, sf_dir).select("k", "p"), "k")
        .select(
            F.expr(_CLAIM_ID.format("k")).alias("claim_id"),
            "part",
            _document_json(F.lit(None).cast(schemas.ADJUDICATION)).alias("claim_detail"),
        )
    )
    return numbers, more


def told(numbers: DataFrame) -> DataFrame:
    """The claims table, row by row, from what ``claims_in_numbers`` gives. Part 0 of a claim's lines is in its ``claim_detail``."""
    plain = {c: expr for c, expr in BOOK["claims"][1].items() if c not in ("claim_id", "member_id")}
    kept = ["claim_id", "member_id", "sk", "lines"]
    base = numbers.selectExpr(*kept, *[f"{expr} as {c}" for c, expr in BOOK["claim_base"][1].items()])
    amounts = base.selectExpr(*kept, *[f"{expr} as {c}" for c, expr in BOOK["claim_amounts"][1].items()])
    claims = amounts.selectExpr("claim_id", "member_id", *[f"{expr} as {c}" for c, expr in plain.items()], "p", "lines")
    return claims.withColumn("claim_detail", _document_json(_adjudication())).select([f.name for f in schemas.CLAIMS.fields])


def claims_with_detail(
    spark: SparkSession, sf_dir: str, folder: str, max_lines: int = schemas.MAX_DOCUMENT_LINES
) -> tuple[DataFrame, DataFrame]:
    """Claims with their JSON detail, and the further documents of long claims (see ``claims_in_numbers``)."""
    numbers, more = claims_in_numbers(spark, sf_dir, folder, max_lines)
    return told(numbers), more


# ---- the tables -------------------------------------------------------------------------------


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(raw(spark, sf_dir, "orders"), "claim_base")


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(_base(spark, sf_dir), "claim_amounts")


def _claim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_suppkey").alias("sk"))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _amounts(spark, sf_dir).join(_claim_provider(spark, sf_dir), "k", "left")
    return columns(joined, "claims")


def _prior_authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir).where("k % 3 = 0")
    return columns(base.join(_claim_provider(spark, sf_dir), "k"), "prior_authorizations")


def derived_book(spark: SparkSession, sf_dir: str) -> Book:
    """Every table of the book over ``sf_dir``. ``claims`` here has no JSON detail; ``claims_with_detail`` adds it."""
    members = lambda: columns(raw(spark, sf_dir, "customer"), "members")
    return Book(
        {
            "members": members,
            "providers": lambda: columns(raw(spark, sf_dir, "supplier"), "providers"),
            "claims": lambda: _claims(spark, sf_dir),
            "disposition_events": lambda: disposition_events(raw(spark, sf_dir, "orders")),
            "disposition_updates": lambda: columns(raw(spark, sf_dir, "events"), "disposition_updates"),
            "prior_authorizations": lambda: _prior_authorizations(spark, sf_dir),
            "eligibility": lambda: columns(members(), "eligibility"),
            "claim_review_priority": lambda: columns(_base(spark, sf_dir), "claim_review_priority"),
        }
    )


def disposition_events(orders: DataFrame) -> DataFrame:
    """Row-local over orders, so it serves a batch and a streaming read alike."""
    return columns(columns(orders, "claim_base").where("status <> 'Pending'"), "disposition_events")
