"""Named built tables, and the book as views for spark.sql."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimlens import schemas
from claimlens.functions.masks import register_masks
from claimlens.operators import governance, silver
from claimlens.plans import metrics
from claimlens.sources.tables import load, table_path, write

CONTINUATION = "claim_documents"  # further documents of claims too long for one
CLEAR_MEMBERS = "members_phi"


@dataclass(frozen=True)
class BuiltTable:
    comment: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs_detail: bool = False


BUILT: dict[str, BuiltTable] = {
    "claims_silver": BuiltTable(
        "What analysts ask of a claim's document, as plain columns.",
        lambda t: silver.claims_silver(t["claims"], t[CONTINUATION]),
        needs_detail=True,
    ),
    "claim_lines": BuiltTable(
        "One row per claim line.",
        lambda t: silver.claim_lines(t["claims"], t[CONTINUATION]),
        needs_detail=True,
    ),
    "open_dispositions_without_action": BuiltTable(
        "Decisions nobody acted on.", lambda t: silver.open_dispositions(t["disposition_events"])
    ),
    "claims_dollar_exposure": BuiltTable(
        "Claims and dollars by status.", lambda t: metrics.dollar_exposure(t["claims"])
    ),
    "disposition_action_gap": BuiltTable(
        "Dispositions and action rate by disposition.", lambda t: metrics.action_gap(t["disposition_events"])
    ),
    "denial_reason_dollars": BuiltTable(
        "Claims and billed dollars by denial reason.", lambda t: metrics.denial_dollars(t["claims"])
    ),
}


def materialize(spark: SparkSession, directory: str, name: str, tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Build a named table, replace it under ``directory`` and read it back; None when it came out empty."""
    built = BUILT[name].build(tables)
    # The comments go into the file's schema, where every later reader finds them.
    if not write(governance.describe(built, name), table_path(directory, name)):
        return None
    return load(spark, directory, name)


def register(spark: SparkSession, tables: Mapping[str, DataFrame], groups: Collection[str] = ()) -> list[str]:
    """Temporary views of the book and of every built table, and the mask functions.

    Views are shared by all readers of a session, so ``members`` is always the masked one. Readers in the PHI group get
    the clear table as ``members_phi``; for any other ``groups`` that view is removed. Without a detail column on
    claims the tables built from it are left out.
    """
    for name in tables:
        df = tables[name]
        view = governance.members_for(df) if name == "members" else df
        governance.describe(view, name).createOrReplaceTempView(name)
    made = list(tables)
    spark.catalog.dropTempView(CLEAR_MEMBERS)
    if "members" in tables and schemas.PHI_READERS in set(groups):
        governance.describe(tables["members"], "members").createOrReplaceTempView(CLEAR_MEMBERS)
        made.append(CLEAR_MEMBERS)
    detailed = "claim_detail" in tables["claims"].columns and CONTINUATION in tables
    for name, table in BUILT.items():
        if table.needs_detail and not detailed:
            continue
        table.build(tables).createOrReplaceTempView(name)
        made.append(name)
    register_masks(spark)
    return made
