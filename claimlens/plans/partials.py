"""Metrics from additive partials: sums by all dimensions, kept per load, merged at the grain a query asks for."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.plans.metrics import CLAIMS_METRICS, DISPOSITION_METRICS, MetricView, _dimension, _guard, metric_query


@dataclass(frozen=True)
class Additive:
    """A measure as sums over rows, and what it is of those sums."""

    parts: dict[str, Callable[[], Column]]
    whole: Callable[[Callable[[str], Column]], Column]


def _cents(amount: Column) -> Column:
    return F.sum(F.floor(amount * 100 + 0.5))


def _rate(hits: str, rows: str) -> Callable[[Callable[[str], Column]], Column]:
    return lambda total: F.try_divide(total(hits).cast("double"), total(rows).cast("double"))


def _rows() -> Column:
    return F.count(F.lit(1))


def _hits(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.sum(F.when(condition(), F.lit(1)).otherwise(F.lit(0)))


def _billed_where(status: str) -> Additive:
    name = f"{status.lower()}_cents"
    cents = lambda: _cents(F.when(F.col("status") == status, F.col("billed_amount")).otherwise(F.lit(0.0)))
    return Additive({name: cents}, lambda total: total(name) / F.lit(100.0))


_COUNT = Additive({"rows": _rows}, lambda total: F.coalesce(total("rows"), F.lit(0)).cast("long"))
ADDITIVE: dict[str, dict[str, Additive]] = {
    CLAIMS_METRICS.source: {
        "Claim Count": _COUNT,
        "Billed Dollars": Additive({"billed_cents": lambda: _cents(F.col("billed_amount"))}, lambda total: total("billed_cents") / F.lit(100.0)),
        "Denied Dollars": _billed_where("Denied"),
        "Pended Dollars": _billed_where("Pending"),
        "Denial Rate": Additive({"rows": _rows, "denied": _hits(lambda: F.col("status") == "Denied")}, _rate("denied", "rows")),
        "Manual Review Rate": Additive(
            {"flags": lambda: F.count("requires_manual_review"), "reviews": lambda: F.sum(F.col("requires_manual_review").cast("double"))},
            _rate("reviews", "flags"),
        ),
    },
    DISPOSITION_METRICS.source: {
        "Disposition Count": _COUNT,
        "Downstream Action Fired Rate": Additive({"rows": _rows, "fired": _hits(lambda: F.col("downstream_action_fired"))}, _rate("fired", "rows")),
    },
}


def write_partials(view: MetricView, frame: DataFrame, path: str, load: str) -> None:
    """Sum the rows of one load by all dimensions, next to the loads before it. A load that comes again replaces its own sums only.

    The sums have one row for each combination of dimension values in the load, whatever its number of rows.
    """
    parts = {name: make() for a in ADDITIVE[view.source].values() for name, make in a.parts.items()}
    summed = frame.groupBy(*view.dimensions.values()).agg(*[c.alias(f"_{name}") for name, c in parts.items()])
    summed.coalesce(1).write.mode("overwrite").parquet(f"{path}/{view.source}/load={load}")


def partial_query(
    spark: SparkSession,
    path: str,
    view: MetricView,
    dims: Sequence[str],
    measures: Sequence[str],
    where: Column | None = None,
    rows: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """What ``metric_query`` gives over all loads, from their sums. Rates are made of sums at the asked grain, so none is averaged again.

    A filter that names anything but dimensions cannot be answered from the sums: it goes to ``rows()``, the claims
    or events themselves, if they are given, and is refused if not.
    """
    known = ADDITIVE[view.source]
    chosen = dict(_dimension(view, d) for d in dims)
    unknown = [m for m in measures if m not in known]
    if unknown:
        raise KeyError(f"not a measure of {view.source}: {unknown}")
    _guard([*chosen.values(), *(c for m in measures for c in view.measures[m].reads)])
    sums = spark.read.parquet(f"{path}/{view.source}").drop("load")
    if where is not None:
        try:
            sums = sums.withColumns({label: F.col(column) for label, column in view.dimensions.items()}).where(where)
        except AnalysisException as error:
            if rows is None or not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            return metric_query(view, rows(), dims, measures, where)
    keys = [F.col(column).alias(label) for label, column in chosen.items()]
    return sums.groupBy(*keys).agg(*[known[m].whole(lambda name: F.sum(f"_{name}")).alias(m) for m in measures])
