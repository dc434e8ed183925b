"""Mixing sources to target weights: fixed-length blocks drawn through index permutations, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.common import word_count, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 32
SHARD_BLOCKS = 4096
LANE_ROWS = 1000
#: Prefix sums go by tiers of this many lanes or shards, so that no window holds all of a large source's.
TIER = 1024
CELLS = 4096
CELL_SLOTS = 1 << 20
ROUNDS = 24
COPIES = 1024
SEED = 11


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, doc_id, size, copies): rows alike in all three are one entry, however many there are."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    return rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, place, blocks, quota, low) of each source.

    Targets are min(max_repeats * source_size, level * weight) with the one level at which they sum to all sizes: the limit
    of resharing by weight what exceeds the stop. With sources ordered by the level at which they stop, the
    level follows from running sums; there is one row a source here, not one a document. ``quota`` is how many blocks of
    the source, at their mean length, make up its target, as a whole number: the fractions of all sources are rounded on one
    grid, so that all quotas together stray by less than one. ``low`` sums the quotas of the sources before it.
    """
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    named = by_source.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    )
    stop = F.col("source_size") * F.lit(float(max_repeats))
    everything = W.partitionBy()
    order = W.orderBy("stops_at", "place")
    ranked = (
        named.withColumn("stops_at", stop / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(stop).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open"))
    )
    # The level holds from the first source that it does not stop.
    level = F.min(F.when(F.col("level") <= F.col("stops_at"), F.struct("stops_at", "place", "level"))).over(everything)["level"]
    targets = ranked.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(stop, level * F.col("weight"))))
    before = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    blocks = F.ceil(F.col("source_size") / F.lit(BLOCK))
    # The last block is partial, so a block holds source_size / blocks words.
    slots = (
        F.when(F.col("source_size") == 0, 0.0)
        .when(F.col("target") >= stop, (blocks * max_repeats).cast("double"))
        .otherwise(F.col("target") * blocks / F.col("source_size"))
    )
    start = F.pmod(F.xxhash64(F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ahead = F.coalesce(F.sum("part").over(before), F.lit(0.0))
    extra = F.ceil(F.col("ahead") + F.col("part") - start) - F.ceil(F.col("ahead") - start)
    counted = (
        targets.withColumn("blocks", blocks)
        .withColumn("slots", slots)
        .withColumn("part", F.col("slots") - F.floor("slots"))
        .withColumn("ahead", ahead)
        .withColumn("quota", F.least(F.floor("slots") + extra, blocks * max_repeats))
    )
    low = F.coalesce(F.sum("quota").over(before), F.lit(0)).cast("long")
    return counted.select("source", "source_size", "target", "place", "blocks", "quota", low.alias("low"))


def running(parts: DataFrame, keys: list[str], step: str, amount: str, tier: str = "tier") -> DataFrame:
    """``parts`` (keys, step, amount, ...) with ``start``: the amounts of smaller steps under the same keys.

    In two levels: sums by tiers of ``TIER`` steps, then within a tier, so a window holds one tier or one row a tier.
    """
    parts = parts.withColumn(tier, F.floor(F.col(step) / F.lit(TIER)))
    ahead = W.partitionBy(*keys).orderBy(tier).rowsBetween(W.unboundedPreceding, -1)
    tiers = (
        parts.groupBy(*keys, tier)
        .agg(F.sum(amount).alias("_sum"))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(tier).alias("_tier"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    )
    same = F.col(tier) == F.col("_tier")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = W.partitionBy(*keys, tier).orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    own = parts.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return own.join(tiers, same).select(*parts.columns, (F.col("_ahead") + F.col("_inside")).alias("start")).drop(tier)


def placed(entries: DataFrame) -> DataFrame:
    """(doc_id, source, size, copies, start): where each entry's words begin in its source's stream; its copies follow it.

    The entries of a source are dealt by a hash of id and size into lanes of about ``LANE_ROWS``, so that a source with a
    third of all rows is summed up in many tasks; no two entries of a source share id and size, so lanes are even.
    """
    lanes = max(1, -(-entries.count() // LANE_ROWS))
    dealt = entries.withColumn("lane", F.pmod(F.xxhash64("doc_id", "size"), F.lit(lanes))).withColumn("words", F.col("size") * F.col("copies"))
    lane_start = running(dealt.groupBy("source", "lane").agg(F.sum("words").alias("words")), ["source"], "lane", "words").select(
        F.col("source").alias("s"), F.col("lane").alias("l"), F.col("start").alias("lane_start")
    )
    inside = W.partitionBy("source", "lane").orderBy("doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .join(lane_start, F.col("source").eqNullSafe(F.col("s")) & (F.col("lane") == F.col("l")))
        .select("doc_id", "source", "size", "copies", (F.col("inside") + F.col("lane_start")).alias("start"))
    )


def single(entries: DataFrame) -> DataFrame:
    """One row a copy of ``entries``, each with its own start. Many copies are dealt out in pieces before they are opened."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = entries.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    dealt = pieces.repartition(parts, "place", "start", "size", "piece")
    copy = F.explode(F.sequence(F.col("piece"), F.least(F.col("piece") + COPIES, F.col("copies")) - 1))
    opened = dealt.withColumn("copy", copy)
    return opened.withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("copies", "piece", "copy")


def _permuted(index: Column, n: Column, key: Column) -> Column:
    """The place of ``index`` in a pseudorandom permutation of 0..n-1 that ``key`` picks.

    A swap-or-not shuffle: each round pairs every place with another (a keyed number less the place, modulo n) and a keyed bit
    of the pair says whether its two change places. That is a permutation for any n, without a walk.
    """

    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swap = F.xxhash64(F.greatest(x, other), r, key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.pmod(index, n), turn)


def drawn_counts(targets: DataFrame) -> DataFrame:
    """(shard, place, n): each output shard's multinomial counts by source.

    A shard has ``SHARD_BLOCKS`` slots. Each slot draws a seeded number below the sum of the quotas and gets the source
    whose share holds it; slots meet shares by cell of the number line, and drawn numbers fill all cells alike.
    """
    spark = targets.sparkSession
    total = int(targets.agg(F.sum("quota")).first()[0] or 0)
    width = max(1, min(-(-total // CELLS), CELL_SLOTS))
    cell = lambda x: F.floor(x / F.lit(width))
    ends = F.col("low") + F.col("quota")
    shares = targets.where("quota > 0").select("place", "low", ends.alias("high"), F.explode(F.sequence(cell(F.col("low")), cell(ends - 1))).alias("cell"))
    slots = spark.range(total).select(
        F.floor(F.col("id") / F.lit(SHARD_BLOCKS)).alias("shard"), F.pmod(F.xxhash64(F.lit(SEED), F.col("id")), F.lit(max(1, total))).alias("u")
    )
    met = slots.withColumn("cell", cell(F.col("u"))).join(shares, "cell").where("u >= low and u < high")
    return met.groupBy("shard", "place").agg(F.count(F.lit(1)).alias("n"))


def drawn_slots(targets: DataFrame) -> DataFrame:
    """(shard, place, block): the block of its source that each slot of the mix takes.

    The draws of a source take its numbers 0, 1, ... shard after shard. Draws beyond its quota are dropped, and what the draws of all
    shards left of a quota is taken in closing shards, so that every source ends at its quota. Number k is block
    permutation(k mod blocks) of pass k div blocks; each pass has a permutation of its own.
    """
    spark = targets.sparkSession
    counts = written(drawn_counts(targets), "draws")
    shares = targets.where("quota > 0").select("place", "blocks", "quota")
    last = F.least(F.col("start") + F.col("n"), F.col("quota")) - 1
    drawn = running(counts, ["place"], "shard", "n").join(shares, "place").select("shard", "place", "blocks", F.col("start").alias("first"), last.alias("last"))
    got = counts.groupBy("place").agg(F.sum("n").alias("got"))
    closing = int(counts.agg(F.max("shard")).first()[0] or 0) + 1
    short = shares.join(got, "place", "left").select("place", "blocks", F.coalesce("got", F.lit(0)).alias("got"), (F.col("quota") - 1).alias("end"))
    pieces = short.where("got <= end").withColumn("first", F.explode(F.sequence(F.col("got"), F.col("end"), F.lit(SHARD_BLOCKS).cast("long"))))
    left = pieces.select(
        (F.floor((F.col("first") - F.col("got")) / F.lit(SHARD_BLOCKS)) + closing).alias("shard"),
        "place",
        "blocks",
        "first",
        F.least(F.col("first") + SHARD_BLOCKS - 1, F.col("end")).alias("last"),
    )
    # The ranges are dealt out before they are opened: a source with a third of all slots is opened in many tasks.
    ranges = written(drawn.where("last >= first").unionByName(left), "ranges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slot = ranges.repartition(parts, "place", "first").select("shard", "place", "blocks", F.explode(F.sequence("first", "last")).alias("k"))
    key = F.xxhash64(F.lit(SEED), F.col("place"), F.floor(F.col("k") / F.col("blocks")))
    return slot.withColumn("key", key).select("shard", "place", _permuted(F.col("k"), F.col("blocks"), F.col("key")).alias("block"))


def drawn_blocks(targets: DataFrame) -> DataFrame:
    """(place, block, times): how often the mix takes each block of each source, never more than ``MAX_REPEATS`` times."""
    return drawn_slots(targets).groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``: how many words the mix takes of it.

    The words of a source, document after document, are one stream cut into blocks of ``BLOCK`` words. Null and empty texts
    have size 0 and nothing taken; a null source is a source of its own, after all others. Repeated rows, also of one id,
    are documents of their own; those without words count none. Rows without an id are placed like any other. Very long texts
    are counted like any other; other columns play no part, whatever they are called. Reruns agree. An empty table
    gives no rows.
    """
    entries = written(sized(docs, id_col, text_col, source_col), "sizes")
    targets = written(source_targets(entries), "targets")
    names = targets.select(F.col("source").alias("s"), "place", "source_size", "target")
    named = placed(entries).join(names, F.col("source").eqNullSafe(F.col("s")))
    stream = written(single(named.select("doc_id", "place", "size", "copies", "start", "source_size", "target")), "stream")
    whole = stream.where("size > 0")
    first, last = F.floor(F.col("start") / F.lit(BLOCK)), F.floor((F.col("start") + F.col("size") - 1) / F.lit(BLOCK))
    parts = whole.select("place", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK) - F.greatest(F.col("start"), F.col("block") * BLOCK)
    taken = (
        # Counts grow with the corpus, though the ranges they come from look small: never a broadcast.
        parts.join(drawn_blocks(targets).hint("merge"), ["place", "block"])
        .groupBy("place", "start")
        .agg(F.sum(overlap * F.col("times")).alias("taken"))
    )
    # Documents without a word stand at the start of the next one: only the one with words is met.
    here = F.when(F.col("size") > 0, F.col("start")).otherwise(F.lit(-1))
    got = taken.select("place", F.col("start").alias("at"), "taken")
    return (
        stream.withColumn("at", here)
        .join(got, ["place", "at"], "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
