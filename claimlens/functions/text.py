"""Words, keyword scores and the claim narrative sentence."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens import schemas

# fixed values: the English stop words full-text search drops
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now"
).split()

K1 = 1.2  # fixed values: the usual BM25 settings
B = 0.75


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script, dots inside them kept (E11.9), stop words left out. No stemming."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def words(query: str) -> list[str]:
    """The words of a query by the same rule, in order."""
    found = re.findall(r"[^\W_]+(?:\.[^\W_]+)*", query.lower())
    return [w for w in found if w not in set(STOP_WORDS)]


def query_terms(query: str) -> list[str]:
    """The distinct words of a query."""
    return list(dict.fromkeys(words(query)))


def bm25_term(tf: Column, df: Column, n_docs: Column, length: Column, mean_length: Column) -> Column:
    """One term's share of a document's BM25 score."""
    idf = F.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


# fixed values: the wording of a narrative
FACTS = "%s claim for %s, CPT %s, diagnosis %s, billed $%s, provider %s (%s)."
DENIED = " Claim was DENIED: %s. Member is likely to appeal."
PARTIALLY_PAID = " Claim PARTIALLY PAID with adjustment: %s."
PENDING = " Claim is PENDING adjudication."
PAID = " Claim was paid."
BENEFITS = " Coordination of benefits with %s."


def _or(column: str, default: str) -> Column:
    """The text, or ``default`` where it is null or empty."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def _said(value: Column) -> Column:
    """The text, or "None" where there is none."""
    return F.coalesce(value, F.lit("None"))


def narrative() -> Column:
    """The claim told in a few sentences. Needs the claim columns, the provider's name and specialty, and cob_payer."""
    billed = F.when(F.col("billed_amount").isNotNull(), F.format_string("%.2f", F.col("billed_amount")))
    facts = F.format_string(
        FACTS,
        _said(F.col("claim_type")),
        _or("pos_desc", "unspecified setting"),
        _said(F.col("primary_cpt")),
        _said(F.col("primary_dx")),
        _said(billed),
        _or("provider_name", "unknown"),
        _or("specialty", "unspecified"),
    )
    status, reason = F.col("status"), _said(F.col("denial_reason"))
    outcome = (
        F.when(status == "Denied", F.format_string(DENIED, reason))
        .when(status == "Partially Paid", F.format_string(PARTIALLY_PAID, reason))
        .when(status == "Pending", F.lit(PENDING))
        .otherwise(F.lit(PAID))
    )
    payer = F.nullif(F.nullif(F.col("cob_payer"), F.lit("")), F.lit(schemas.NO_PAYER))
    benefits = F.when(payer.isNotNull(), F.format_string(BENEFITS, payer)).otherwise(F.lit(""))
    return F.concat(facts, outcome, benefits)
