"""Current claim state, its upkeep, claim dossiers and the triage queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.scores import tier
from claimlens.functions.sizing import BROADCAST_ROWS


def top_claims(claims: DataFrame, limit: int | None = 500) -> DataFrame:
    """The dearest claims; ties go by claim id. No limit keeps every claim."""
    return claims if limit is None else claims.orderBy(F.desc("billed_amount"), "claim_id").limit(limit)


def _small(df: DataFrame, limit: int | None) -> DataFrame:
    return F.broadcast(df) if limit is not None and limit <= BROADCAST_ROWS else df


def last_dispositions(events: DataFrame) -> DataFrame:
    """The time and event of each claim's last disposition."""
    return latest_dispositions(events).drop("status")


def current_state(claims: DataFrame, events: DataFrame, limit: int | None = 500, updated_at: Column | None = None) -> DataFrame:
    """The dearest claims in the serving table's shape, with the time of their last disposition.

    Events are reduced to one row per claim before the join. With a limit, the claims are chosen
    first and only their events are looked at.
    """
    top = top_claims(claims, limit)
    if limit is not None:
        events = events.join(_small(top.select("claim_id"), limit), "claim_id", "left_semi")
    state = top.join(_small(last_dispositions(events), limit), "claim_id", "left")
    made = {
        "requires_manual_review": F.coalesce(F.col("requires_manual_review") == 1, F.lit(False)),
        "triage_score": F.lit(None),
        "triage_action": F.lit(None),
        "updated_at": updated_at if updated_at is not None else F.current_timestamp(),
    }
    return state.select(
        [made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.CLAIM_STATUS.fields]
    )


def insert_if_absent(state: DataFrame, new: DataFrame, key: str = "claim_id") -> DataFrame:
    """``state`` plus the rows of ``new`` whose key it lacks; rows already there stay as they are.

    Of repeats in ``new`` the row that is smallest, column by column in the order of ``state``, is inserted.
    """
    missing = new.join(state.select(key), key, "left_anti")
    one = missing.groupBy(key).agg(F.min(F.struct(*[c for c in state.columns if c != key])).alias("_row"))
    return state.unionByName(one.select(key, "_row.*"))


def latest_dispositions(events: DataFrame) -> DataFrame:
    """Each claim's newest disposition: the larger (disposition_ts, event_id) wins, so the answer does not
    depend on arrival order or on repeats. An unreadable time counts as the earliest. Partially
    aggregated before the shuffle."""
    at = F.col("disposition_ts").try_cast("timestamp")
    row = F.struct(
        F.col("disposition").alias("status"), at.alias("last_disposition_ts"), F.col("event_id").alias("last_event_id")
    )
    newest = events.groupBy("claim_id").agg(F.max_by(row, F.struct(at, F.col("event_id"))).alias("_new"))
    return newest.select("claim_id", "_new.*")


def upsert_latest(state: DataFrame, events: DataFrame) -> DataFrame:
    """``state`` with newer dispositions applied; a claim it lacks is added with what the event tells.

    Newer is the larger (last_disposition_ts, last_event_id), in one call or over many.
    """
    newest = latest_dispositions(events).withColumnsRenamed(
        {"status": "_status", "last_disposition_ts": "_ts", "last_event_id": "_event"}
    )
    both = state.join(newest, "claim_id", "full_outer")
    old = F.struct("last_disposition_ts", "last_event_id")
    # A missing time or event sorts first, so a claim without a disposition takes any.
    newer = F.col("_event").isNotNull() & (F.struct(F.col("_ts"), F.col("_event")) > old)
    replaced = {"status": "_status", "last_disposition_ts": "_ts", "last_event_id": "_event"}
    return both.select(
        [
            F.when(newer, F.col(replaced[c])).otherwise(F.col(c)).alias(c) if c in replaced else F.col(c)
            for c in state.columns
        ]
    )


def write_back(state: DataFrame, scores: DataFrame) -> DataFrame:
    """``state`` with triage_score and triage_action from ``scores`` (claim_id and either or both columns);
    rows without a new value keep theirs. Of several scores for a claim the highest counts, with its action; values
    that do not fit their column count as missing."""
    given = [c for c in ("triage_score", "triage_action") if c in scores.columns]
    types = {f.name: f.dataType for f in schemas.CLAIM_STATUS.fields}
    fitting = scores.select("claim_id", F.struct(*[F.col(c).try_cast(types[c]).alias(f"_{c}") for c in given]).alias("_given"))
    new = fitting.groupBy("claim_id").agg(F.max("_given").alias("_given")).select("claim_id", "_given.*")
    joined = state.join(new, "claim_id", "left")
    return joined.select([F.coalesce(f"_{c}", c).alias(c) if c in given else F.col(c) for c in state.columns])


def claim_dossier(claim_ids: DataFrame, claims: DataFrame, priority: DataFrame) -> DataFrame:
    """The facts of the named claims and their review score where there is one; unknown ids give no row."""
    facts = claims.select(
        "claim_id",
        "status",
        "denial_reason",
        "billed_amount",
        "paid_amount",
        "primary_cpt",
        "primary_dx",
    ).join(claim_ids.select("claim_id").distinct(), "claim_id", "left_semi")
    score = F.round("manual_review_score", 3).alias("review_score")
    asked = priority.join(claim_ids.select("claim_id").distinct(), "claim_id", "left_semi")
    return facts.join(asked, "claim_id", "left").select(*facts.columns, score)


def triage_queue(priority: DataFrame, claims: DataFrame, limit: int = 25) -> DataFrame:
    """Claims not paid in full, highest review score first."""
    wanted = claims.where(F.col("status").isin(schemas.QUEUE_STATUSES)).select(
        "claim_id", "status", "denial_reason", "billed_amount", "primary_cpt"
    )
    return (
        priority.join(wanted, "claim_id")
        .orderBy(F.desc("manual_review_score"), "claim_id")
        .limit(limit)
        .select(
            "claim_id",
            F.round("manual_review_score", 3).alias("score"),
            tier(F.col("manual_review_score")).alias("tier"),
            "status",
            "denial_reason",
            "billed_amount",
            "primary_cpt",
        )
    )
