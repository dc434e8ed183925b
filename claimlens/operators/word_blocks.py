"""Keyword search over postings in blocks: a block is read only if one of its rows can be among the best."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions import text
from claimlens.functions.sizing import evaluated_once
from claimlens.operators.retrieval import _ranked, counted_words, one_a_key, one_note_a_key
from claimlens.sources.tables import write

#: Rows of a block; a power of two, so that no block crosses a partition's row numbers.
BLOCK_ROWS = 4096
#: Blocks of highest bound that are read first, to learn what the others must reach.
FIRST_BLOCKS = 16


def write_blocks(notes: DataFrame, path: str, key: str = "claim_id", column: str = "narrative", batch: str = "start", block_rows: int = BLOCK_ROWS) -> None:
    """Lay the words of ``notes`` out below ``path`` as one named batch: further batches only add, and a batch that comes again replaces itself.

    Rows of like length, in the order of their keys, share a block. ``postings`` holds a row a word and note, by word and
    block; ``blocks`` says of each word and block how many notes hold it, how often at most, how short the shortest is and
    which key is the first. These bound the score of any note of the block whatever the corpus figures become later.
    """
    if block_rows & (block_rows - 1):
        raise ValueError("block_rows must be a power of two")
    words = F.col("tokens") if "tokens" in notes.columns else text.tokens(F.col(column))
    lists = evaluated_once(notes.select(key, words.alias("_w")), "_w").select(key, F.size("_w").alias("length"), "_w")
    ordered = lists.repartitionByRange("length", key).sortWithinPartitions("length", key)
    numbered = ordered.withColumn("block", F.floor(F.monotonically_increasing_id() / block_rows))
    write(numbered, f"{path}/lists/batch={batch}", skip_empty=False)  # the numbers last once they are written
    stored = notes.sparkSession.read.schema(numbered.schema).parquet(f"{path}/lists/batch={batch}")
    # A block's postings of a word lie together; the blocks deal a word of many notes into many files. Lists of words are
    # dealt by block and counted after that, unless rows of other blocks may share their key: then the counted words are dealt.
    if one_note_a_key(stored, key):
        lists = stored.select(key, "block", "_w").repartition("block")
        counted = counted_words(lists, key, "block").select("term", "block", key, "times", "length").sortWithinPartitions("term", "block", key)
    else:
        counted = one_a_key(counted_words(stored, key, "block"), key, "block")
    write(counted, f"{path}/postings/batch={batch}", skip_empty=False)
    postings = notes.sparkSession.read.schema(counted.schema).parquet(f"{path}/postings/batch={batch}")
    bounds = postings.groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("times").alias("most"), F.min("length").alias("shortest"), F.min(key).alias("first_key")
    )
    write(bounds, f"{path}/blocks/batch={batch}", skip_empty=False, cluster_by=["term", "block"])
    figures = stored.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("words"))
    write(figures, f"{path}/figures/batch={batch}", skip_empty=False)


def _asked(spark: SparkSession, path: str, terms: list[str]) -> tuple:
    """(docs, mean length, notes that hold each term): one row, and one a term."""
    figures = spark.read.parquet(f"{path}/figures").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    found = spark.read.parquet(f"{path}/blocks").where(F.col("term").isin(terms)).groupBy("term").agg(F.sum("n").alias("n")).collect()
    return figures["docs"], (figures["words"] / figures["docs"] if figures["docs"] else 0.0), {r["term"]: r["n"] for r in found}


def _part(asked: tuple, terms: list[str], times: str, length: str):
    docs, mean, held = asked
    known = F.create_map(*[F.lit(x) for t in terms for x in (t, held.get(t, 0))])
    return text.bm25_term(F.col(times), known[F.col("term")], F.lit(docs), F.col(length), F.lit(mean))


def _scored(spark: SparkSession, path: str, terms: list[str], asked: tuple, chosen: DataFrame, n: int, key: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/postings").where(F.col("term").isin(terms))
    rows = rows.join(chosen.select("batch", "block"), ["batch", "block"], "left_semi")
    scored = rows.groupBy(key).agg(F.count(F.lit(1)).alias("held"), F.round(F.sum(_part(asked, terms, "times", "length")), 6).alias("score"))
    return scored.where(F.col("held") == len(terms)).orderBy(F.desc("score"), key).limit(n).select(key, "score")


def blocks_for(spark: SparkSession, path: str, query: str, n: int = 30, key: str = "claim_id") -> DataFrame:
    """(batch, block, bound, first_key): the blocks that ``blocks_top`` must read.

    A block can matter only if it holds every word. The ``FIRST_BLOCKS`` of highest bound give n rows; what cannot beat the last of these,
    by score or, on a tie, by key, is left out. With fewer than n rows every block that holds the words is read.
    """
    terms = text.query_terms(query)
    asked = _asked(spark, path, terms)
    blocks = spark.read.parquet(f"{path}/blocks").where(F.col("term").isin(terms))
    # A hair above, as sums of doubles depend on their order, and to the places of a score.
    bound = F.round(F.sum(_part(asked, terms, "most", "shortest")) + 1e-9, 6).alias("bound")
    whole = blocks.groupBy("batch", "block").agg(F.count(F.lit(1)).alias("held"), bound, F.max("first_key").alias("first_key"))
    able = whole.where(F.col("held") == len(terms)).drop("held")
    first = able.orderBy(F.desc("bound"), "first_key").limit(FIRST_BLOCKS)
    last = _scored(spark, path, terms, asked, first, n, key).orderBy(F.desc("score"), key).collect()  # n rows
    if len(last) < n:
        return able
    score, last_key = last[-1]["score"], last[-1][key]
    return able.where((F.col("bound") > score) | ((F.col("bound") == score) & (F.col("first_key") <= F.lit(last_key))))


def blocks_top(spark: SparkSession, path: str, query: str, n: int = 30, key: str = "claim_id") -> DataFrame:
    """(key, score, rk): the n best notes that hold every word of the query, by BM25; the answer of a search over everything."""
    terms = text.query_terms(query)
    if not terms:
        return spark.read.parquet(f"{path}/postings").select(key, F.lit(0.0).alias("score"), F.lit(0).alias("rk")).limit(0)
    chosen = blocks_for(spark, path, query, n, key)
    best = _scored(spark, path, terms, _asked(spark, path, terms), chosen, n, key)
    return _ranked(best, F.desc("score"), key)
