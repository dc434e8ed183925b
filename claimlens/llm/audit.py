"""What each of several document filters does alone and beside the others, in every order: a game of removals and its potential."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import WORD, written

FILTERS = "ABCDE"
MIN_WORDS = 200
COPY = "E"


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails: A few words, B repeated words, C capitals, D signs of markup."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    return {
        "A": n < MIN_WORDS,
        "B": 100 * distinct < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _bit(letter: str, letters: str = FILTERS) -> int:
    return 1 << letters.index(letter)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask) of every row, written once: a bit of ``mask`` for each filter that the text itself fails."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mask = F.lit(0)
    for letter, fails in text_failures(text).items():
        mask = mask + fails.cast("int") * _bit(letter)
    part = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    return written(docs.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), digest.alias("digest"), mask.alias("mask")), "failures")


def tallies(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents fail exactly the filters of ``mask``, copies of smaller ids among them.

    Rows of one id and text are counted before they meet anything, and the first of a text is found by an aggregate and
    met by (text, id): a text that a third of all rows share makes no large group.
    """
    counted = failed.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    firsts = failed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("bad"))
    said = said.where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = counted.join(firsts, ["digest", "doc_id"], "left")
    # A row without an id meets no label; the second key deals such rows out.
    deal = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(0)
    marked = marked.withColumn("deal", deal).join(said.withColumn("deal", F.lit(0).cast("long")), ["doc_id", "deal"], "left")
    mask = F.col("mask") + copy.cast("int") * _bit(COPY)
    return marked.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("toxic")
    )


def coalitions(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row a part: for every coalition of filters (place = its bits) what it removes, of all, good and toxic documents;
    ``alone`` counts what fails one filter only."""
    every = range(1 << len(letters))
    removed = lambda value: F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(value)).otherwise(0)) for s in every])
    alone = F.array(*[F.sum(F.when(F.col("mask") == (1 << k), F.col("n")).otherwise(0)) for k in range(len(letters))])
    return counts.groupBy("part").agg(
        F.sum("n").alias("total"), removed("n").alias("removes"), removed("good").alias("good"), removed("toxic").alias("toxic"), alone.alias("alone")
    )


def potentials(game: Column, players: int) -> Column:
    """The potential of every coalition, times the factorial of its size so that all numbers are whole.

    The potential of none is 0, and P(S) = (game(S) + sum of P(S without i) over i in S) / |S|. A coalition without one
    of its members is a smaller number, so one walk over the coalitions in order finds all of what each needs.
    """
    before = F.array(*[F.lit(factorial(max(0, k - 1))).cast("long") for k in range(players + 1)])

    def step(found: Column, s: Column) -> Column:
        less = F.lit(0).cast("long")
        for k in range(players):
            less = less + F.when(s.bitwiseAND(1 << k) != 0, found[s.bitwiseXOR(F.lit(1 << k))]).otherwise(0)
        return F.concat(found, F.array(before[F.bit_count(s)] * game[s] + less))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), F.array(F.lit(0).cast("long")), step)


def interactions(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """What ``audit`` returns, from the counts of ``tallies`` over any few filters named by letters."""
    players, grand = len(letters), (1 << len(letters)) - 1
    games = coalitions(counts, letters).withColumn("potential", potentials(F.col("removes"), players))
    orders = ",".join("".join(p) for p in permutations(letters))
    rows = games.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(players))))
    place = F.position(F.substr("filter_order", F.col("step"), F.lit(1)), F.lit(letters)) - 1
    before = F.lit(0)
    for k, letter in enumerate(letters):
        before = before + (F.position(F.lit(letter), F.col("filter_order")) < F.col("step")).cast("int") * (1 << k)
    rows = rows.withColumn("place", place).withColumn("before", before).withColumn("own", F.element_at(F.array(*[F.lit(1 << k) for k in range(players)]), F.col("place") + 1))
    after = F.col("before") + F.col("own")
    gain = lambda value: F.col(value)[after] - F.col(value)[F.col("before")]
    # n! (P(all) - P(all without i)), of potentials that carry the factorials of their sizes
    shapley = F.col("potential")[grand] - players * F.col("potential")[F.lit(grand) - F.col("own")]
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.col("removes")[after]).alias("kept"),
        gain("removes").alias("removed"),
        (F.col("removes")[F.col("own")] - gain("removes")).alias("redundant"),
        F.col("alone")[F.col("place")].alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per part (value of ``source_col``), order of the five filters and step: what the step keeps, removes, finds gone,
    and costs in good and toxic documents, and its filter's removals summed over all orders (``shapley``).

    Null texts are empty; an empty text has no words and fails A alone, unless a smaller id is empty too (E). Null sources
    are the part ''. A row without an id is no copy and makes none; rows that repeat an id and its text are no copies of
    each other, and each counts. Of repeated labels any 1 counts; rows without labels are neither good nor toxic. Texts are
    read whole, one at a time, whatever their length. Further columns are not looked at. An empty table gives no rows.
    """
    return interactions(tallies(failures(docs, id_col, text_col, source_col), labels))
