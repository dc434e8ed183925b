"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas
from checks import book
from claimlens.functions.nested import detail_has_source, detail_parses
from claimlens.functions.vectors import format_vector, norm, parse_vector
from claimlens.operators import governance, joins, keyed_state, kept_keys, quality, replies, retrieval, scoring, serving, silver, variants, vector_tree, word_blocks
from claimlens.plans import catalog, metrics, partials
from claimlens.session import configure, new_dir
from claimlens.sources.bucketed import read_bucketed, write_bucketed
from claimlens.sources.tables import Book, count_inventory, find, laid_out, load, load_with_refusals, stored_book, write, write_keyed
from claimlens.streaming import dispositions, transitions

SEARCH_TEXT = "denied medically necessary"
DOCUMENT_TEXT = "und"
CODE_TEXTS = ["CPT 99213", "E11.9", "99214 pending"]
ACCENTED_TEXT = "für"
AUC_FLOOR = 0.6
QUERIES: dict = {}


def query(make):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return make(spark, sf_dir)

    QUERIES[make.__name__] = run
    return run


_KEPT: dict[tuple, str] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """When the raw tables were last written and how long they are: kept tables go by it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
    return tuple(files.agg(F.max("modificationTime").cast("string"), F.sum("length"), F.count(F.lit(1))).first())


def _kept(spark, sf_dir, name, make) -> str:
    """The folder of something written by ``make(folder)``, once per session and state of the raw tables."""
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir), name)
    if key not in _KEPT:
        folder = new_dir(spark, name)
        make(folder)
        _KEPT[key] = folder
    return _KEPT[key]


def write_book(spark: SparkSession, sf_dir: str, folder: str, max_lines: int = schemas.MAX_DOCUMENT_LINES) -> None:
    """The whole book as stored tables; claims are laid out by member, and found by claim and provider as well."""
    numbers, more = book.claims_in_numbers(spark, sf_dir, folder, max_lines)
    made = book.derived_book(spark, sf_dir)
    for name in schemas.BOOK_TABLES:
        if name == "claims":
            claims = book.told(laid_out(numbers, ["member_id", "claim_id"]))
            write(claims, f"{folder}/claims.parquet", skip_empty=False, find_by=["claim_id", "provider_id"])
        elif name == "claim_documents":
            write(more, f"{folder}/claim_documents.parquet", skip_empty=False)
        else:
            write(made[name], f"{folder}/{name}.parquet", skip_empty=False)


def stored(spark: SparkSession, sf_dir: str) -> Book:
    """The stored book: what the queries on the claim detail read."""
    return stored_book(spark, _kept(spark, sf_dir, "book", lambda folder: write_book(spark, sf_dir, folder)))


def documents(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    tables = stored(spark, sf_dir)
    return tables["claims"], tables["claim_documents"]


def book_tables(tables) -> dict[str, DataFrame]:
    return {name: tables[name] for name in schemas.BOOK_TABLES if name in tables}


# ---- sources and sinks ------------------------------------------------------------------------


@query
def table_counts(spark, sf_dir):
    return count_inventory(book_tables(book.derived_book(spark, sf_dir)))


@query
def members_table(spark, sf_dir):
    """Written, and read back with the declared schema."""
    return stored(spark, sf_dir)["members"]


@query
def providers_table(spark, sf_dir):
    """Written, and read back with the declared schema."""
    return stored(spark, sf_dir)["providers"]


@query
def claims_table(spark, sf_dir):
    return stored(spark, sf_dir)["claims"].drop("claim_detail")


@query
def disposition_events_table(spark, sf_dir):
    """Written, and read back with the declared schema."""
    return stored(spark, sf_dir)["disposition_events"]


@query
def prior_authorizations_table(spark, sf_dir):
    """Written, and read back with the declared schema."""
    return stored(spark, sf_dir)["prior_authorizations"]


@query
def eligibility_table(spark, sf_dir):
    """Written, and read back with the declared schema."""
    return stored(spark, sf_dir)["eligibility"]


@query
def written_claims(spark, sf_dir):
    """The claims written as a table with its key held, and read back with the declared schema, lines of all documents counted."""
    claims, more = documents(spark, sf_dir)
    folder = new_dir(spark, "claims")
    write_keyed(claims, f"{folder}/claims.parquet", "claim_id", skip_empty=False)
    back = silver.claims_silver(load(spark, folder, "claims"), more)
    return back.select(
        *[c for c in claims.columns if c != "claim_detail"],
        detail_has_source().alias("has_source"),
        detail_parses().alias("parses"),
        "line_count",
    )


@query
def stored_line_counts(spark, sf_dir):
    """Lines per claim out of the stored documents, with every field of a line in a checksum."""
    lines = silver.claim_lines(*documents(spark, sf_dir))
    return lines.groupBy("claim_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("line").alias("line_numbers"),
        F.round(F.sum(F.col("charge").cast("decimal(18,2)")).cast("double"), 2).alias("charges"),
        F.sum("units").alias("units"),
    )


@query
def materialized_open_dispositions(spark, sf_dir):
    folder = new_dir(spark, "built")
    return catalog.materialize(
        spark, folder, "open_dispositions_without_action", book.derived_book(spark, sf_dir)
    )


def _raw_records(spark, sf_dir) -> str:
    """The disposition events as JSON lines, some of them cut off, without an id, or with a flag that is no flag."""
    def make(folder):
        events = book.derived_book(spark, sf_dir)["disposition_events"]
        kind = F.substring("event_id", 2, 9).cast("long") % 11
        whole = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
        lines = (
            F.when(kind == 3, F.substring(whole, 1, 40))
            .when(kind == 5, F.regexp_replace(whole, '"downstream_action_fired":(true|false)', '"downstream_action_fired":"maybe"'))
            .when(kind == 7, F.regexp_replace(whole, '"event_id":"[^"]*"', '"event_id":null'))
            .otherwise(whole)
        )
        events.select(lines.alias("value")).write.text(folder)

    return _kept(spark, sf_dir, "records", make)


@query
def loaded_records(spark, sf_dir):
    """The raw event records that fit the table."""
    return load_with_refusals(spark, _raw_records(spark, sf_dir), "disposition_events", "event_id")[0]


@query
def refused_records(spark, sf_dir):
    """Why the others were refused, and of how many characters they are."""
    refused = load_with_refusals(spark, _raw_records(spark, sf_dir), "disposition_events", "event_id")[1]
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.length("record") == 40).alias("cut_off"))


# ---- metrics ----------------------------------------------------------------------------------


@query
def kpi_summary(spark, sf_dir):
    tables = book.derived_book(spark, sf_dir)
    return metrics.kpi_summary(tables["claims"], tables["disposition_events"])


@query
def dollar_exposure(spark, sf_dir):
    return metrics.dollar_exposure(book.derived_book(spark, sf_dir)["claims"])


@query
def disposition_action_gap(spark, sf_dir):
    return metrics.action_gap(book.derived_book(spark, sf_dir)["disposition_events"])


@query
def exposure_by_claim_type(spark, sf_dir):
    return metrics.exposure_by_type(book.derived_book(spark, sf_dir)["claims"])


@query
def denial_reason_dollars(spark, sf_dir):
    return metrics.denial_dollars(book.derived_book(spark, sf_dir)["claims"])


@query
def biggest_gap(spark, sf_dir):
    return metrics.biggest_gap(book.derived_book(spark, sf_dir)["disposition_events"])


_MEASURE_NAMES = {
    "Claim Count": "claim_count",
    "Billed Dollars": "billed_dollars",
    "Denied Dollars": "denied_dollars",
    "Pended Dollars": "pended_dollars",
    "Denial Rate": "denial_rate",
    "Manual Review Rate": "manual_review_rate",
    "Disposition Count": "disposition_count",
    "Downstream Action Fired Rate": "fired_rate",
    "Status": "status",
    "Denial Reason": "denial_reason",
    "Claim Type": "claim_type",
    "Place Of Service": "place",
    "Disposition": "disposition",
    "Action Type": "action_type",
}


def _claims_metric(spark, sf_dir, dims, where=None) -> DataFrame:
    claims = book.derived_book(spark, sf_dir)["claims"]
    view = metrics.CLAIMS_METRICS
    asked = metrics.metric_query(view, claims, dims, list(view.measures), where)
    return asked.withColumnsRenamed(_MEASURE_NAMES)


@query
def metric_total(spark, sf_dir):
    return _claims_metric(spark, sf_dir, [])


@query
def metric_by_place_of_service(spark, sf_dir):
    return _claims_metric(spark, sf_dir, ["Place Of Service"])


@query
def metric_by_status_and_type(spark, sf_dir):
    return _claims_metric(spark, sf_dir, ["Status", "Claim Type"])


@query
def metric_by_synonym(spark, sf_dir):
    """The dimension asked for by a business word, over rework claims only."""
    return _claims_metric(spark, sf_dir, ["rejection reason"], F.col("Status").isin(schemas.REWORK_STATUSES))


@query
def metric_dispositions(spark, sf_dir):
    events = book.derived_book(spark, sf_dir)["disposition_events"]
    view = metrics.DISPOSITION_METRICS
    asked = metrics.metric_query(view, events, ["Disposition", "Action Type"], list(view.measures))
    return asked.withColumnsRenamed(_MEASURE_NAMES)


def _partials(spark, sf_dir) -> str:
    """Sums of three loads of claims and of events; the first load of claims comes twice."""
    def make(folder):
        tables = book.derived_book(spark, sf_dir)
        third = F.pmod(F.xxhash64("claim_id"), F.lit(3))
        for view in (metrics.CLAIMS_METRICS, metrics.DISPOSITION_METRICS):
            for k in (0, 1, 2, 0):
                partials.write_partials(view, tables[view.source].where(third == k), folder, f"third{k}")

    return _kept(spark, sf_dir, "partials", make)


def _partial_metric(spark, sf_dir, view, dims, where=None) -> DataFrame:
    rows = lambda: book.derived_book(spark, sf_dir)[view.source]
    asked = partials.partial_query(spark, _partials(spark, sf_dir), view, dims, list(view.measures), where, rows)
    return asked.withColumnsRenamed(_MEASURE_NAMES)


@query
def partial_metric_total(spark, sf_dir):
    return _partial_metric(spark, sf_dir, metrics.CLAIMS_METRICS, [])


@query
def partial_metric_by_status_and_type(spark, sf_dir):
    return _partial_metric(spark, sf_dir, metrics.CLAIMS_METRICS, ["Status", "Claim Type"])


@query
def partial_metric_by_synonym(spark, sf_dir):
    return _partial_metric(spark, sf_dir, metrics.CLAIMS_METRICS, ["rejection reason"], F.col("Status").isin(schemas.REWORK_STATUSES))


@query
def partial_metric_dispositions(spark, sf_dir):
    return _partial_metric(spark, sf_dir, metrics.DISPOSITION_METRICS, ["Disposition", "Action Type"])


@query
def mean_score_by_status(spark, sf_dir):
    tables = book.derived_book(spark, sf_dir)
    return metrics.mean_score_by_status(tables["claim_review_priority"], tables["claims"])


@query
def sql_exposure(spark, sf_dir):
    """The same standing questions through the registered views."""
    catalog.register(spark, book.derived_book(spark, sf_dir))
    return spark.sql(
        "SELECT e.status, e.claims, e.total_billed, g.action_fired_rate "
        "FROM claims_dollar_exposure e LEFT JOIN disposition_action_gap g ON e.status = g.disposition"
    )


# ---- silver and nested ------------------------------------------------------------------------


@query
def claims_silver(spark, sf_dir):
    parsed = silver.claims_silver(*documents(spark, sf_dir))
    return parsed.select(
        "claim_id", "status", "billed_amount", "line_count", "copay",
        F.array_join("edits_triggered", "|").alias("edits"), "has_cob",
    )


@query
def claim_lines(spark, sf_dir):
    lines = silver.claim_lines(*documents(spark, sf_dir))
    return lines.withColumns(
        {"modifiers": F.array_join("modifiers", "|"), "dx_pointers": F.array_join("dx_pointers", "|")}
    )


@query
def open_dispositions(spark, sf_dir):
    return silver.open_dispositions(book.derived_book(spark, sf_dir)["disposition_events"])


@query
def cob_claims(spark, sf_dir):
    return silver.cob_claims(stored(spark, sf_dir)["claims"]).select("claim_id", "member_id", "status")


LINE_PATTERN = {"line_items": [{"cpt": "99214", "modifiers": ["25"]}, {"units": 3}], "adjudication": {"edits_triggered": ["MUE"]}}


@query
def contains_lines(spark, sf_dir):
    """Claims with a line of this code and modifier, a line of three units, and this edit."""
    claims, more = documents(spark, sf_dir)
    return silver.detail_matches(claims, LINE_PATTERN, more).select("claim_id", "member_id", "status")


def _details(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The claims with their details parsed into VARIANT columns when they were written."""
    folder = _kept(spark, sf_dir, "details", lambda folder: variants.write_details(*documents(spark, sf_dir), folder, in_order=True))
    return variants.read_details(spark, folder)


@query
def variant_silver(spark, sf_dir):
    parsed = variants.variant_silver(*_details(spark, sf_dir))
    return parsed.select(
        "claim_id", "status", "billed_amount", "line_count", "copay",
        F.array_join("edits_triggered", "|").alias("edits"), "has_cob",
    )


@query
def variant_lines(spark, sf_dir):
    lines = variants.variant_lines(*_details(spark, sf_dir))
    return lines.withColumns(
        {"modifiers": F.array_join("modifiers", "|"), "dx_pointers": F.array_join("dx_pointers", "|")}
    )


@query
def variant_contains_lines(spark, sf_dir):
    claims, more = _details(spark, sf_dir)
    return silver.detail_matches(claims, LINE_PATTERN, more).select("claim_id", "member_id", "status")


@query
def hybrid_rows(spark, sf_dir):
    return silver.hybrid_rows(*documents(spark, sf_dir))


@query
def hybrid_denied_top(spark, sf_dir):
    return silver.denied_for_review(*documents(spark, sf_dir))


@query
def member_cob_claims(spark, sf_dir):
    claims, more = documents(spark, sf_dir)
    return silver.member_cob_claims(claims, "M0000007", more)


# ---- governance -------------------------------------------------------------------------------


@query
def masked_members(spark, sf_dir):
    return governance.members_for(book.derived_book(spark, sf_dir)["members"])


@query
def clear_members(spark, sf_dir):
    return governance.members_for(book.derived_book(spark, sf_dir)["members"], {schemas.PHI_READERS})


@query
def masked_members_sql(spark, sf_dir):
    """The masks as SQL functions."""
    catalog.register(spark, book.derived_book(spark, sf_dir), {schemas.PHI_READERS})
    return spark.sql(
        "SELECT member_id, mask_ssn(member_ssn) AS member_ssn, mask_name(member_name) AS member_name, "
        "mask_dob(member_dob) AS member_dob FROM members_phi"
    )


@query
def mask_report(spark, sf_dir):
    return governance.mask_report(governance.members_for(book.derived_book(spark, sf_dir)["members"]))


@query
def key_checks(spark, sf_dir):
    return governance.check_primary_keys(book.derived_book(spark, sf_dir))


@query
def orphan_checks(spark, sf_dir):
    return governance.check_foreign_keys(book.derived_book(spark, sf_dir))


def _kept_keys(spark, sf_dir) -> str:
    def make(folder):
        tables = book.derived_book(spark, sf_dir)
        named = {k.table for k in schemas.PRIMARY_KEYS + schemas.FOREIGN_KEYS}
        for k in range(2):
            part = {t: rows.where(F.pmod(F.xxhash64(*rows.columns[:1]), F.lit(2)) == k) for t, rows in tables.items() if t in named}
            kept_keys.check_batch(spark, folder, f"load-{k}", part)

    return _kept(spark, sf_dir, "kept-keys", make)


@query
def kept_key_checks(spark, sf_dir):
    """The key violations of the whole book, from two loads that were each checked against the keys kept before."""
    return kept_keys.violations_so_far(spark, _kept_keys(spark, sf_dir))


@query
def column_inventory(spark, sf_dir):
    """Of the registered views, with whatever comments and tags they still carry."""
    catalog.register(spark, book.derived_book(spark, sf_dir))
    views = {name: spark.table(name) for name in schemas.BOOK_TABLES if name != "claim_documents"}
    return governance.column_inventory(views | {"claims": views["claims"].drop("claim_detail")})


@query
def tagged_tables(spark, sf_dir):
    return governance.tagged_tables(book.derived_book(spark, sf_dir))


@query
def constraint_report(spark, sf_dir):
    return governance.constraint_report(book.derived_book(spark, sf_dir))


@query
def update_orphans(spark, sf_dir):
    """Claims that have no disposition update, and how many of their events there are."""
    tables = book.derived_book(spark, sf_dir)
    lost = joins.orphans(tables["disposition_events"], "claim_id", tables["disposition_updates"], "claim_id")
    return lost.withColumnRenamed("rows", "row_count")


@query
def claims_members_providers(spark, sf_dir):
    tables = book.derived_book(spark, sf_dir)
    both = joins.join_declared(tables, "claims", "members")
    whole = joins.join_declared(tables, ("claims", both), "providers")
    return whole.select("claim_id", "status", "plan_type", "state", "specialty", "in_network")


@query
def events_with_claims(spark, sf_dir):
    joined = joins.join_declared(book.derived_book(spark, sf_dir), "claims", "disposition_events", "left")
    return joined.select("claim_id", "event_id", "disposition", "billed_amount")


# ---- serving ----------------------------------------------------------------------------------


def _state(spark, sf_dir, limit=500) -> DataFrame:
    """Current state of the claims, with their documents."""
    tables = stored(spark, sf_dir)
    at = F.lit("1999-01-01").cast("timestamp")
    return serving.current_state(tables["claims"], tables["disposition_events"], limit, at)


def _detail_shown():
    """What of the JSON half of a state row is compared: the payer, null where there is no document."""
    return F.get_json_object("claim_detail", "$.adjudication.cob_payer").alias("cob_payer")


def _plain(state: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, which every engine prints alike."""
    kinds = dict(state.dtypes)
    shown = [
        F.col(c).cast("double").alias(c) if kinds[c].startswith("decimal")
        else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kinds[c] == "timestamp"
        else F.col(c)
        for c in state.columns
    ]
    return state.select(shown)


@query
def current_state(spark, sf_dir):
    tables = stored(spark, sf_dir)
    state = serving.current_state(tables["claims"], tables["disposition_events"])
    lines = silver.hybrid_rows(state, silver.documents_of(state, tables["claim_documents"])).select("claim_id", "line_count")
    shown = state.select([c for c in state.columns if c not in ("updated_at", "claim_detail")])
    return _plain(shown.join(lines, "claim_id"))


@query
def current_state_all(spark, sf_dir):
    state = _state(spark, sf_dir, None)
    shown = ["claim_id", "status", "billed_amount", "requires_manual_review", "last_disposition_ts", "last_event_id"]
    return _plain(state).select(*shown, _detail_shown())


@query
def insert_if_absent(spark, sf_dir):
    """500 claims already there, marked; all claims offered."""
    there = _state(spark, sf_dir).withColumn("triage_action", F.lit("kept"))
    state = serving.insert_if_absent(there, _state(spark, sf_dir, None))
    return _plain(state).select("claim_id", "status", "billed_amount", "triage_action", "last_disposition_ts", _detail_shown())


@query
def latest_state(spark, sf_dir):
    tables = book.derived_book(spark, sf_dir)
    state = serving.upsert_latest(_state(spark, sf_dir, None), tables["disposition_updates"])
    return _shown_state(state)


STATE_BUCKETS = 16


def _bucketed_state(spark, sf_dir, limit=None) -> str:
    """A folder of its own with the current state in buckets."""
    folder = new_dir(spark, "keyed-state")
    state = _state(spark, sf_dir, limit)
    keyed_state.create_state(state if limit is None else state.withColumn("triage_action", F.lit("kept")), folder, buckets=STATE_BUCKETS)
    return folder


@query
def bucketed_latest_state(spark, sf_dir):
    """The disposition updates applied in four batches, each to the buckets of its own claims."""
    folder = _bucketed_state(spark, sf_dir)
    updates = book.derived_book(spark, sf_dir)["disposition_updates"]
    for part in range(4):
        batch = updates.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part)
        keyed_state.change_state(spark, folder, batch, serving.upsert_latest)
    return _shown_state(keyed_state.read_state(spark, folder))


@query
def bucketed_insert_if_absent(spark, sf_dir):
    folder = _bucketed_state(spark, sf_dir, 500)
    keyed_state.change_state(spark, folder, _state(spark, sf_dir, None), serving.insert_if_absent)
    state = _plain(keyed_state.read_state(spark, folder))
    return state.select("claim_id", "status", "billed_amount", "triage_action", "last_disposition_ts", _detail_shown())


@query
def bucketed_score_writeback(spark, sf_dir):
    folder = _bucketed_state(spark, sf_dir)
    scores = book.derived_book(spark, sf_dir)["claim_review_priority"].select("claim_id", F.col("manual_review_score").alias("triage_score"))
    good, _ = replies.validate_replies(_replies(spark, sf_dir))
    for given in (scores, good.select("claim_id", "triage_action")):
        keyed_state.change_state(spark, folder, given, serving.write_back)
    return _plain(keyed_state.read_state(spark, folder)).select("claim_id", "status", "triage_score", "triage_action", _detail_shown())


def _bucketed(spark, sf_dir, *names) -> list[DataFrame]:
    """Tables of the book and the score table, bucketed by claim, once per session and state of the raw tables."""
    def build(folder):
        tables, priority = stored(spark, sf_dir), book.derived_book(spark, sf_dir)["claim_review_priority"]
        for name, table in {"claims": tables["claims"], "disposition_events": tables["disposition_events"], "claim_review_priority": priority}.items():
            write_bucketed(table, f"{folder}/{name}", "claim_id", STATE_BUCKETS)

    folder = _kept(spark, sf_dir, "bucketed", build)
    return [read_bucketed(spark, f"{folder}/{name}", "claim_id", STATE_BUCKETS) for name in names]


@query
def bucketed_current_state(spark, sf_dir):
    """Claims with their last dispositions, grouped and joined without a shuffle."""
    claims, events = _bucketed(spark, sf_dir, "claims", "disposition_events")
    state = serving.current_state(claims, events, None, F.lit("1999-01-01").cast("timestamp"))
    shown = ["claim_id", "status", "billed_amount", "requires_manual_review", "last_disposition_ts", "last_event_id"]
    return _plain(state).select(*shown, _detail_shown())


@query
def bucketed_mean_score(spark, sf_dir):
    priority, claims = _bucketed(spark, sf_dir, "claim_review_priority", "claims")
    return metrics.mean_score_by_status(priority, claims)


def _shown_state(state: DataFrame) -> DataFrame:
    return _plain(state).select("claim_id", "member_id", "status", "last_disposition_ts", "last_event_id", _detail_shown())


@query
def latest_updates(spark, sf_dir):
    return _plain(serving.latest_dispositions(book.derived_book(spark, sf_dir)["disposition_updates"]))


@query
def score_writeback(spark, sf_dir):
    """Scores from the priority table, actions from the good replies."""
    tables = book.derived_book(spark, sf_dir)
    scores = tables["claim_review_priority"].select("claim_id", F.col("manual_review_score").alias("triage_score"))
    good, _ = replies.validate_replies(_replies(spark, sf_dir))
    state = serving.write_back(_state(spark, sf_dir, None), scores)
    state = serving.write_back(state, good.select("claim_id", "triage_action"))
    return _plain(state).select("claim_id", "status", "triage_score", "triage_action", _detail_shown())


@query
def claim_dossier(spark, sf_dir):
    """Dossiers of every claim that has a disposition update."""
    tables = book.derived_book(spark, sf_dir)
    named = tables["disposition_updates"].select("claim_id").distinct()
    return serving.claim_dossier(named, tables["claims"], tables["claim_review_priority"])


_FOUND = ["claim_id", "member_id", "provider_id", "status", "billed_amount"]


@query
def claims_by_id(spark, sf_dir):
    """25 claims looked up by id in the table that is laid out by member."""
    claims = stored(spark, sf_dir)["claims"]
    asked = [r["claim_id"] for r in serving.top_claims(claims.select("claim_id", "billed_amount"), 25).collect()]
    return _plain(find(claims, "claim_id", asked).select(_FOUND))


@query
def claims_by_provider(spark, sf_dir):
    """All claims of the providers whose names come first, looked up in the table that is laid out by member."""
    tables = stored(spark, sf_dir)
    first = tables["providers"].orderBy("provider_name", "provider_id").limit(15)
    return _plain(find(tables["claims"], "provider_id", [r["provider_id"] for r in first.collect()]).select(_FOUND))


@query
def triage_queue(spark, sf_dir):
    tables = book.derived_book(spark, sf_dir)
    return serving.triage_queue(tables["claim_review_priority"], tables["claims"])


def _replies(spark, sf_dir) -> DataFrame:
    """One model reply per claim: good, fenced, unknown action, bad score, or not JSON, by claim number."""
    number = "cast(substr(claim_id, 2) as bigint)"
    priority = book.derived_book(spark, sf_dir)["claim_review_priority"]
    allowed = f"element_at(array('member_notice', 'appeal_route', 'none'), cast({number} % 3 + 1 as int))"
    action = f"case when {number} % 5 = 2 then 'escalate' else {allowed} end"
    score = f"case when {number} % 5 = 3 then 1.7D else manual_review_score end"
    parts = priority.selectExpr(
        "claim_id",
        f"{number} % 5 as kind",
        f"to_json(named_struct('triage_score', {score}, 'risk_tier', 'med', 'next_action', {action}, "
        "'rationale', concat('status of ', claim_id))) as body",
    )
    return parts.selectExpr(
        "claim_id",
        "case kind when 1 then concat('```json\\n', body, '\\n```') when 4 then concat('I think ', claim_id) "
        "else body end as reply",
    )


@query
def reply_validation(spark, sf_dir):
    judged = replies.judge_replies(_replies(spark, sf_dir))
    good = F.col("reason").isNull()
    return judged.select(
        "claim_id",
        F.when(good, F.col("triage_score")).alias("triage_score"),
        F.when(good, F.col("triage_action")).alias("triage_action"),
        F.coalesce("reason", F.lit("good")).alias("verdict"),
    )


# ---- retrieval --------------------------------------------------------------------------------


def _narratives(spark, sf_dir, limit=None) -> DataFrame:
    tables = stored(spark, sf_dir)
    return retrieval.narratives(tables["claims"], tables["providers"], limit)


def _notes_folder(spark, sf_dir) -> str:
    """The search tables of all claims: claim_notes, its words, and the weights its vectors are made with."""

    def make(folder):
        told = f"{folder}/told"
        write(retrieval.with_places(retrieval.with_tokens(_narratives(spark, sf_dir))), told, skip_empty=False)
        rows = spark.read.parquet(told)
        weights = retrieval.vector_weights(rows)
        write(spark.createDataFrame([(weights,)], "weights array<double>"), f"{folder}/weights")
        write_keyed(retrieval.claim_notes(rows, weights), f"{folder}/claim_notes.parquet", "claim_id", skip_empty=False)
        retrieval.write_words(rows, folder)

    return _kept(spark, sf_dir, "notes", make)


def _all_notes(spark, sf_dir) -> DataFrame:
    return load(spark, _notes_folder(spark, sf_dir), "claim_notes")


def _weights(spark, sf_dir) -> list[float]:
    return list(spark.read.parquet(f"{_notes_folder(spark, sf_dir)}/weights").first()["weights"])


def _notes(spark, sf_dir) -> DataFrame:
    """The claims that have a vector in the given table, with it.

    Notes and vectors meet once. The ids of the vectors are written by themselves, so that Spark knows how short they are and
    notes without a vector are left out before any text is shuffled.
    """

    def make(folder):
        vectors = book.raw(spark, sf_dir, "embeddings").select(
            F.expr("concat('C', lpad(cast(vec_id as string), 9, '0'))").alias("claim_id"), "embedding"
        )
        write(vectors.select("claim_id"), f"{folder}/ids", skip_empty=False)
        known = _all_notes(spark, sf_dir).drop("embedding").join(spark.read.parquet(f"{folder}/ids"), "claim_id", "left_semi")
        write(known.join(vectors, "claim_id"), f"{folder}/rows", skip_empty=False)

    return spark.read.parquet(f"{_kept(spark, sf_dir, 'vector_notes', make)}/rows")


def _document_words(spark, sf_dir) -> str:
    texts = book.raw(spark, sf_dir, "documents").select("doc_id", "text")
    return _kept(spark, sf_dir, "document_words", lambda folder: retrieval.write_words(texts, folder, "doc_id", "text"))


def _asked(spark, sf_dir):
    """The query vector: one row."""
    return book.raw(spark, sf_dir, "embeddings").where("vec_id = 0").first().embedding


@query
def narratives(spark, sf_dir):
    return _narratives(spark, sf_dir)


@query
def narratives_top(spark, sf_dir):
    return _narratives(spark, sf_dir, 500)


@query
def vector_texts(spark, sf_dir):
    """Vectors through their text form and back."""
    vectors = book.raw(spark, sf_dir, "embeddings").withColumn("text", format_vector("embedding"))
    back = vectors.withColumn("v", parse_vector("text"))
    return back.select("vec_id", F.size("v").alias("dim"), F.round(norm(F.col("v")), 4).alias("length"))


@query
def vector_top30(spark, sf_dir):
    near = retrieval.vector_top(_notes(spark, sf_dir), _asked(spark, sf_dir))
    return near.select("claim_id", "distance", "rk")


@query
def keyword_top30(spark, sf_dir):
    return retrieval.words_top(spark, _notes_folder(spark, sf_dir), SEARCH_TEXT)


@query
def keyword_scan_top30(spark, sf_dir):
    """The same question to notes that have no table of words."""
    found = retrieval.keyword_top(_all_notes(spark, sf_dir), SEARCH_TEXT)
    return found.select("claim_id", "score", "rk")


@query
def keyword_codes(spark, sf_dir):
    """Questions with procedure and diagnosis codes."""
    folder = _notes_folder(spark, sf_dir)
    found = [retrieval.words_top(spark, folder, q, 10).select(F.lit(q).alias("question"), "claim_id", "score", "rk") for q in CODE_TEXTS]
    return reduce(DataFrame.union, found)


@query
def keyword_documents(spark, sf_dir):
    """Keyword search over whole documents."""
    return retrieval.words_top(spark, _document_words(spark, sf_dir), DOCUMENT_TEXT, key="doc_id")


def _word_blocks(spark, sf_dir) -> str:
    """The words of all notes in blocks, written in two batches."""
    def make(folder):
        notes = _all_notes(spark, sf_dir)
        half = F.pmod(F.xxhash64("claim_id"), F.lit(2))
        for k in (0, 1):
            word_blocks.write_blocks(notes.where(half == k), folder, batch=f"half{k}", block_rows=512)

    return _kept(spark, sf_dir, "word_blocks", make)


@query
def keyword_blocks_top30(spark, sf_dir):
    return word_blocks.blocks_top(spark, _word_blocks(spark, sf_dir), SEARCH_TEXT)


@query
def keyword_blocks_documents(spark, sf_dir):
    """The search over whole documents, blocks that cannot matter left unread."""
    texts = book.raw(spark, sf_dir, "documents").select("doc_id", "text")
    folder = _kept(spark, sf_dir, "document_blocks", lambda f: word_blocks.write_blocks(texts, f, "doc_id", "text", block_rows=64))
    return word_blocks.blocks_top(spark, folder, DOCUMENT_TEXT, key="doc_id")


@query
def keyword_accents(spark, sf_dir):
    return retrieval.words_top(spark, _document_words(spark, sf_dir), ACCENTED_TEXT, key="doc_id")


@query
def hybrid_search(spark, sf_dir):
    """A question in words over all notes: its vector in the notes' space, and its words."""
    vector = retrieval.embed_query(SEARCH_TEXT, _weights(spark, sf_dir))
    return retrieval.hybrid_search(_all_notes(spark, sf_dir), _notes_folder(spark, sf_dir), vector, SEARCH_TEXT)


@query
def narrative_vectors(spark, sf_dir):
    notes = _all_notes(spark, sf_dir)
    largest = F.round(F.array_max("embedding").cast("double"), 5).alias("largest")
    return notes.select("claim_id", F.size("embedding").alias("dim"), F.round(norm(F.col("embedding")), 4).alias("length"), largest)


def _index(spark, sf_dir) -> str:
    return _kept(spark, sf_dir, "index", lambda folder: retrieval.near_index(_notes(spark, sf_dir), folder))


@query
def ann_top30(spark, sf_dir):
    near = retrieval.ann_top(spark, _index(spark, sf_dir), _asked(spark, sf_dir))
    return near.select("claim_id", "distance", "rk")


@query
def ann_checks(spark, sf_dir):
    """The near search against the exact one: rows found, rows with their exact distance, and the share of the true nearest found."""
    near = retrieval.ann_top(spark, _index(spark, sf_dir), _asked(spark, sf_dir)).select("claim_id", "distance")
    exact = retrieval.vector_top(_notes(spark, sf_dir), _asked(spark, sf_dir)).select("claim_id", "distance")
    told = _notes(spark, sf_dir).join(near.select("claim_id"), "claim_id", "left_semi")
    true = retrieval.vector_top(told, _asked(spark, sf_dir)).select("claim_id", F.col("distance").alias("true"))
    found = near.agg(F.count(F.lit(1)).alias("rows_found"))
    right = near.join(true, "claim_id").agg(F.count_if(F.col("distance") == F.col("true")).alias("exact_distances"))
    hits = near.join(exact, "claim_id", "left_semi").agg((F.count(F.lit(1)) / F.lit(30) >= 0.9).alias("good_recall"))
    return found.crossJoin(right).crossJoin(hits)  # three single rows


def _tree(spark, sf_dir) -> str:
    """A tree over a third of the vectors, the others added in two batches."""
    def make(folder):
        rows = _notes(spark, sf_dir).select("claim_id", "embedding")
        third = F.pmod(F.xxhash64("claim_id"), F.lit(3))
        vector_tree.build_tree(rows.where(third == 0), folder, rows_per_leaf=25)
        for k in (1, 2):
            vector_tree.add_notes(rows.where(third == k), folder, f"third{k}")

    return _kept(spark, sf_dir, "tree", make)


@query
def tree_top30(spark, sf_dir):
    """The nearest of all notes through the tree, proved complete by its leaves' radii."""
    near = vector_tree.tree_top(spark, _tree(spark, sf_dir), _asked(spark, sf_dir), exact=True)
    return near.select("claim_id", "distance", "rk")


# ---- scoring ----------------------------------------------------------------------------------


@query
def features(spark, sf_dir):
    return scoring.review_features(stored(spark, sf_dir)["claims"])


@query
def model_inputs(spark, sf_dir):
    """What the trees learn from: how many of a claim's categories are marked, and its amount in standard deviations."""
    rows = features(spark, sf_dir)
    made = Pipeline(stages=scoring.model_stages(1, 1, 0.1, 42)[:-1]).fit(rows).transform(rows)
    marked = reduce(lambda a, b: a + b, [F.aggregate(vector_to_array(f"{c}_hot"), F.lit(0.0), lambda t, x: t + x) for c in scoring.CATEGORIES])
    return made.select("claim_id", marked.alias("marked"), F.round(vector_to_array("amount_scaled")[0], 6).alias("amount"))


def _score_folder(spark, sf_dir) -> str:
    """The trained model, its AUC on claims held out, and the score table."""

    def make(folder):
        write(features(spark, sf_dir), f"{folder}/features", skip_empty=False)
        rows = spark.read.parquet(f"{folder}/features")
        model, auc = scoring.train_review_model(rows)
        model.write().overwrite().save(f"{folder}/model")
        write(spark.createDataFrame([(auc,)], "auc double"), f"{folder}/auc")
        scores = scoring.score_claims(PipelineModel.load(f"{folder}/model"), rows)
        write(scores, f"{folder}/claim_review_priority.parquet", skip_empty=False)

    return _kept(spark, sf_dir, "scores", make)


def _scored(spark, sf_dir) -> DataFrame:
    return load(spark, _score_folder(spark, sf_dir), "claim_review_priority")


@query
def review_priority(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def review_score_checks(spark, sf_dir):
    """The score rules on the trained model's table, and whether its AUC on claims held out is at least 0.6."""
    rules = quality.priority_rules(_scored(spark, sf_dir), stored(spark, sf_dir)["claims"])
    auc = spark.read.parquet(f"{_score_folder(spark, sf_dir)}/auc")
    return rules.union(auc.select(F.lit("AUC").alias("check_id"), (F.col("auc") < AUC_FLOOR).cast("bigint").alias("violations")))


@query
def trained_triage_checks(spark, sf_dir):
    """The queue and the write-back on the trained scores: rows, order, and scores that fit their column."""
    tables = stored(spark, sf_dir)
    queue = serving.triage_queue(_scored(spark, sf_dir), tables["claims"])
    scores = _scored(spark, sf_dir).select("claim_id", F.col("manual_review_score").alias("triage_score"))
    state = serving.write_back(_state(spark, sf_dir, None), scores)
    return queue.agg(F.count(F.lit(1)).alias("queued"), F.count_if(F.col("status") == "Paid").alias("paid_queued")).crossJoin(
        state.agg(F.count(F.lit(1)).alias("rows"), F.count("triage_score").alias("scored"))
    )


@query
def review_split(spark, sf_dir):
    """Rows of each class of the label, and how many of them are held out."""
    split = scoring.stratified(book.derived_book(spark, sf_dir)["claims"].select("claim_id", F.col("requires_manual_review").alias("label")))
    return split.groupBy("label").agg(F.count(F.lit(1)).alias("claims"), F.count_if("held").alias("held"))


@query
def review_auc(spark, sf_dir):
    """How well the book's own scores tell the claims that need a review, over all claims."""
    tables = book.derived_book(spark, sf_dir)
    judged = tables["claim_review_priority"].join(tables["claims"].select("claim_id", F.col("requires_manual_review").alias("label")), "claim_id")
    return scoring.roc_auc(judged).select(F.round("auc", 12).alias("auc"))


# ---- streaming --------------------------------------------------------------------------------


def _raw_stream(spark, sf_dir, name) -> DataFrame:
    """A raw table as a stream of its files, whether it is one file or a folder of many."""
    table = book.raw(spark, sf_dir, name)
    parts = table.inputFiles()
    if any(p.rstrip("/").endswith(f"/{name}.parquet") for p in parts):
        return dispositions.file_stream(spark, sf_dir, table.schema, f"{name}.parquet")
    return dispositions.file_stream(spark, f"{sf_dir}/{name}.parquet", table.schema)


def _order_stream(spark, sf_dir) -> DataFrame:
    return book.disposition_events(_raw_stream(spark, sf_dir, "orders"))


def _update_stream(spark, sf_dir) -> DataFrame:
    return book.columns(_raw_stream(spark, sf_dir, "events"), "disposition_updates")


@query
def stream_bronze(spark, sf_dir):
    folder = new_dir(spark, "bronze")
    dispositions.keep_table(_order_stream(spark, sf_dir), f"{folder}/table", f"{folder}/log").awaitTermination()
    return spark.read.parquet(f"{folder}/table")


@query
def stream_open(spark, sf_dir):
    folder = new_dir(spark, "open")
    feed = dispositions.open_feed(_order_stream(spark, sf_dir))
    dispositions.keep_table(feed, f"{folder}/table", f"{folder}/log").awaitTermination()
    return spark.read.parquet(f"{folder}/table")


@query
def stream_state(spark, sf_dir):
    folder = new_dir(spark, "state")
    dispositions.keep_state(_update_stream(spark, sf_dir), f"{folder}/table", f"{folder}/log").awaitTermination()
    return _shown_state(dispositions.read_state(spark, f"{folder}/table", _state(spark, sf_dir, None)))


@query
def stream_keyed_state(spark, sf_dir):
    """The stream of updates into a state in buckets."""
    folder = _bucketed_state(spark, sf_dir)
    dispositions.keep_keyed_state(_update_stream(spark, sf_dir), folder, f"{folder}-checkpoint").awaitTermination()
    return _shown_state(keyed_state.read_state(spark, folder))


@query
def stream_changes(spark, sf_dir):
    """The same stream folded while it is under way: the newest disposition of each claim."""
    folder = new_dir(spark, "changes")
    stream = _update_stream(spark, sf_dir)
    dispositions.keep_state(stream, f"{folder}/table", f"{folder}/log").awaitTermination()
    dispositions.compact_state(spark, f"{folder}/table")
    return _plain(dispositions.read_changes(spark, f"{folder}/table"))


@query
def stream_transitions(spark, sf_dir):
    """The moves of claims that the stream of updates makes, from the state before it."""
    folder = new_dir(spark, "transitions")
    stream, before = _update_stream(spark, sf_dir), _state(spark, sf_dir, None)
    transitions.keep_transitions(stream, f"{folder}/table", f"{folder}/log", before).awaitTermination()
    return _plain(spark.read.parquet(f"{folder}/table"))


@query
def stream_gap(spark, sf_dir):
    folder = new_dir(spark, "gap")
    dispositions.keep_gap(_order_stream(spark, sf_dir), f"{folder}/table", f"{folder}/log").awaitTermination()
    return dispositions.read_gap(spark, f"{folder}/table")


# ---- quality ----------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    """Every check over the stored claims, as they would be run after a load."""
    tables = stored(spark, sf_dir)
    folder = new_dir(spark, "report")
    state = serving.current_state(tables["claims"], tables["disposition_events"])
    write(state, f"{folder}/claim_status.parquet", skip_empty=False)
    rows = lambda name: book.raw(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()
    return quality.quality_report(
        tables,
        expected_claims=rows("orders"),
        expected_members=rows("customer"),
        masked_members=governance.members_for(tables["members"]),
        priority=_scored(spark, sf_dir),
        state=load(spark, folder, "claim_status"),
        stored_gap=catalog.materialize(spark, folder, "disposition_action_gap", tables),
    )
