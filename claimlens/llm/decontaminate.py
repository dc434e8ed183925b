"""Benchmark decontamination: rare word n-grams find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import id_and_text, row_numbers, written

SEED_WORDS = 3
#: Items of fewer words are reported only where all their words stand in a row, and only if they are rare as a whole.
SHORT_ITEM_WORDS = 5
#: A stretch of a longer item counts as leaked from the score that ``THRESHOLD`` of so many of its words would have.
EXCERPT_WORDS = 50
WORD_CELLS = 1 << 20
SEED_BITS = 1 << 24
#: A seed is rare if chance alone would put it into fewer than one in a thousand documents.
RARE = 1e-3
THRESHOLD = 0.5
PENALTY = 0.5
#: ASCII capitals to small letters, ASCII signs to spaces; all other bytes stay.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Words without case and ASCII punctuation."""
    return text.translate(_PLAIN).split() if text else []


def word_keys(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), "<u8")


def seed_keys(keys: np.ndarray, width: int = SEED_WORDS) -> np.ndarray:
    """A key for each ``width`` consecutive words."""
    out = np.full(max(0, len(keys) - width + 1), SEED_WORDS - width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width if len(out) else 0):
            out = out * np.uint64(0x9E3779B97F4A7C15) + keys[k : k + len(out)]
    return out ^ (out >> np.uint64(32))


def seed_cells(seeds: np.ndarray, turn: int) -> np.ndarray:
    """The two cells of each seed in the bitmap; a seed is looked for only where both are set."""
    return ((seeds >> np.uint64(24 * turn)) & np.uint64(SEED_BITS - 1)).astype(np.int64)


def _marks(df: DataFrame, cell: str, size: int, mark: str) -> np.ndarray:
    """The largest ``mark`` (1 to 63) of each of ``size`` cells, 0 where none: at most size / 32 numbers a mark come to the driver."""
    word = F.floor(F.col(cell) / F.lit(32)).cast("int").alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(cell), F.lit(32)).cast("int")).alias("bit")
    rows = df.select(F.col(mark).cast("int").alias("mark"), word, bit).groupBy("mark", "word").agg(F.bit_or("bit")).toPandas().to_numpy(np.int64)
    marks = np.zeros((size // 32, 32), np.uint8)
    for value in np.unique(rows[:, 0]) if len(rows) else ():
        own = rows[rows[:, 0] == value]
        marks[own[:, 1]] = np.maximum(marks[own[:, 1]], (own[:, 2][:, None] >> np.arange(32) & 1) * value)
    return marks.ravel()


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, cells) of items with a word; of items with equal words, the smallest id."""

    def run(batches):
        for batch in batches:
            out = {"item_id": [], "words": [], "cells": []}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                if words and item is not None:
                    out["item_id"].append(item)
                    out["words"].append(b" ".join(words))
                    out["cells"].append((word_keys(words) & np.uint64(WORD_CELLS - 1)).astype(np.int64))
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    kind = pa.schema([("item_id", pa.int64()), ("words", pa.binary()), ("cells", pa.list_(pa.int64()))])
    rows = id_and_text(benchmark, id_col, text_col).mapInArrow(run, "item_id long, words binary, cells array<long>")
    return rows.groupBy("words").agg(F.min("item_id").alias("item_id"), F.first("cells").alias("cells"))


def corpus_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(cell, n): how often words of each wanted cell occur in all documents; cell -1 counts words, -2 documents."""
    packed = np.packbits(wanted)

    def run(batches):
        flags = np.unpackbits(packed).astype(bool)
        total, words_seen, docs_seen = np.zeros(WORD_CELLS, np.int64), 0, 0
        for batch in batches:
            met = [np.zeros(0, np.int64)]
            for text in batch.column(1):
                cell = (word_keys(plain_words(text.as_py())) & np.uint64(WORD_CELLS - 1)).astype(np.int64)
                words_seen += len(cell)
                docs_seen += 1
                met.append(cell[flags[cell]])
            total += np.bincount(np.concatenate(met), minlength=WORD_CELLS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([some, [-1, -2]])),
                pa.array(np.concatenate([total[some], [words_seen, docs_seen]])),
            ],
            names=["cell", "n"],
        )

    return docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def weighted_items(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item_id, words, surprise array<double>, words_a_doc): the surprise of a word is minus the log of its share."""
    totals = counts.where("cell < 0").agg(
        F.max(F.when(F.col("cell") == -1, F.col("n"))).alias("words"), F.max(F.when(F.col("cell") == -2, F.col("n"))).alias("docs")
    ).first()
    n_words, n_docs = max(1, totals["words"] or 0), max(1, totals["docs"] or 0)
    spread = items.select("item_id", F.posexplode("cells").alias("at", "cell"))
    known = spread.join(counts, "cell", "left").select(
        "item_id", "at", F.log(F.lit(float(n_words)) / F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))).alias("surprise")
    )
    lists = known.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("at", "surprise"))).alias("found"))
    return items.join(lists, "item_id").select(
        "item_id", "words", F.col("found.surprise").alias("surprise"), F.lit(n_words / n_docs).alias("words_a_doc")
    )


def rare_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_id, width, reach): an item's rare n-grams, and always the rarer half of its n-grams.

    Rare: the chance matches to expect in a document of mean length, words taken as independent, are below ``RARE``. The
    half keeps an item of common words findable. An item of fewer words than a seed is its own seed; short items that are
    not rare as a whole have none. An item's words stand within two to the power of ``reach`` words of a seed.
    """

    def run(batches):
        for batch in batches:
            out = {name: [] for name in kind.names}
            for item, words, surprise, per_doc in zip(*(batch.column(k).to_pylist() for k in range(4))):
                words = words.split()
                width = min(SEED_WORDS, len(words))
                if len(words) < SHORT_ITEM_WORDS and sum(surprise) < np.log(per_doc / RARE):
                    continue
                log = np.convolve(np.array(surprise), np.ones(width), "valid")
                keys = seed_keys(word_keys(words), width)
                rare = (log >= np.log(per_doc / RARE)) | (log >= np.median(log))
                some = np.unique(keys[rare]).view(np.int64)
                out["seed"].extend(some.tolist())
                out["item_id"].extend([item] * len(some))
                out["width"].extend([width] * len(some))
                out["reach"].extend([max(1, (len(words) - 1).bit_length())] * len(some))
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    kind = pa.schema([("seed", pa.int64()), ("item_id", pa.int64()), ("width", pa.int32()), ("reach", pa.int32())])
    return items.mapInArrow(run, "seed long, item_id long, width int, reach int")


def passages(docs: DataFrame, marks: np.ndarray, widths: list[int]) -> DataFrame:
    """(passage, doc_id, start, words, seeds): stretches of documents around seeds, as far to both sides as the seeds' own items reach.

    ``marks`` holds the reach of each cell, as a power of two; ``widths`` are the seeds' numbers of words.
    """
    packed = zstandard.compress(marks.tobytes())
    kind = pa.schema(
        [("passage", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("words", pa.binary()), ("seeds", pa.list_(pa.int64()))]
    )

    def run(batches):
        numbers = row_numbers()
        known = np.frombuffer(zstandard.decompress(packed), np.uint8)
        for batch in batches:
            out = {name: [] for name in kind.names}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = plain_words(text.as_py())
                keys = word_keys(words)
                places, seeds, marked = [], [], []
                for width in widths:
                    found = seed_keys(keys, width)
                    mark = known[seed_cells(found, 0)]
                    hits = np.flatnonzero(mark)
                    hits = hits[known[seed_cells(found[hits], 1)] > 0]
                    places.append(hits)
                    seeds.append(found[hits])
                    marked.append(np.minimum(mark[hits], known[seed_cells(found[hits], 1)]))
                hits = np.concatenate(places)
                if not len(hits):
                    continue
                order = np.argsort(hits, kind="stable")
                hits, seeds, reach = hits[order], np.concatenate(seeds)[order], 1 << np.concatenate(marked)[order].astype(np.int64)
                cuts = np.flatnonzero(np.diff(hits) > np.maximum(reach[1:], reach[:-1])) + 1
                for at, own, far in zip(np.split(hits, cuts), np.split(seeds, cuts), np.split(reach, cuts)):
                    a, b = max(0, int((at - far).min())), int((at + far).max()) + SEED_WORDS
                    out["passage"].append(next(numbers))
                    out["doc_id"].append(doc)
                    out["start"].append(a)
                    out["words"].append(b" ".join(words[a:b]))
                    out["seeds"].append(np.unique(own).view(np.int64).tolist())
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    return docs.mapInArrow(run, "passage long, doc_id long, start long, words binary, seeds array<long>")


def needed(surprise: np.ndarray, threshold: float) -> float:
    """The share of an item's own score from which an alignment counts.

    ``threshold`` up to ``EXCERPT_WORDS`` words; beyond, as much of its mean words' score as of a whole item of so many words. A
    short item must be there whole.
    """
    if len(surprise) < SHORT_ITEM_WORDS:
        return 1.0
    return threshold * min(1.0, EXCERPT_WORDS / len(surprise))


def align(item: np.ndarray, surprise: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman: the best local alignment as a share of the item's own score, and where in the passage it lies.

    A match scores the word's surprise; a mismatch or a gap costs ``PENALTY`` times the item's mean surprise.
    """
    own = float(surprise.sum())
    if not own or not len(passage):
        return 0.0, 0, 0
    cost = PENALTY * own / len(item)
    at = np.arange(len(passage) + 1)
    slope = cost * at
    score, origin = np.zeros(len(at)), at
    best = (0.0, 0, 0)
    for word, gain in zip(item, surprise):  # one row of the table at a time, with the origin of each alignment
        row, start = score - cost, origin.copy()
        over = score[:-1] + np.where(passage == word, gain, -cost)
        better = over >= row[1:]
        row[1:] = np.where(better, over, row[1:])
        start[1:] = np.where(better, origin[:-1], start[1:])
        fresh = row <= 0
        row[fresh], start[fresh] = 0, at[fresh]
        # Gaps in the passage: each place takes over the best to its left, less the gap.
        level = np.maximum.accumulate(row + slope)
        source = np.maximum.accumulate(np.where(row + slope >= level, at, 0))
        score, origin = level - slope, start[source]
        fresh = score <= 0
        score[fresh], origin[fresh] = 0, at[fresh]
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (float(score[top]), int(origin[top]), top)
    return best[0] / own, best[1], best[2]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, score, start, stop) of every document and benchmark item that align at ``threshold`` or more.

    An item of more than ``EXCERPT_WORDS`` words need not be there by half: ``threshold`` of so many of its mean words is enough. An
    item of fewer than ``SHORT_ITEM_WORDS`` words must be there whole, its words in a row, and chance alone must put it into fewer
    than ``RARE`` of the documents; one that is commoner proves nothing. score is a share of the item's own score, 1 for a whole copy; start and stop are word positions of the document, of its best-aligned passage (the first
    on ties). Words are compared without case and ASCII punctuation; items with equal words stand under their
    smallest id. Null and empty texts on either side give no rows, nor do items without an id; very long texts are read whole and
    other columns play no part; repeated documents give one row with the best score, rows without an id one for all of them. An empty table on either side gives no rows.
    """
    texts = id_and_text(docs, id_col, text_col)
    items = written(benchmark_items(benchmark, item_col, item_text_col), "items")
    wanted = _marks(items.select(F.explode("cells").alias("cell"), F.lit(1).alias("one")), "cell", WORD_CELLS, "one") > 0
    weighted = written(weighted_items(items, written(corpus_counts(texts, wanted), "word-counts")), "weighted-items")
    seeds = written(rare_seeds(weighted), "seeds")
    cells = [F.call_function("shiftrightunsigned", F.col("seed"), F.lit(24 * turn)).bitwiseAND(F.lit(SEED_BITS - 1)) for turn in (0, 1)]
    marks = _marks(seeds.select(F.explode(F.array(*cells)).alias("cell"), "reach"), "cell", SEED_BITS, "reach")
    widths = sorted(r["width"] for r in seeds.select("width").distinct().collect())  # three rows at most
    found = written(passages(texts, marks, widths or [SEED_WORDS]), "passages")
    pairs = found.select("passage", F.explode("seeds").alias("seed")).join(seeds.select("seed", "item_id"), "seed").select("passage", "item_id").distinct()
    both = (
        pairs.join(weighted.select("item_id", F.col("words").alias("item_words"), "surprise"), "item_id")
        .join(found.drop("seeds"), "passage")
        .select("doc_id", "item_id", "start", "words", "item_words", "surprise")
    )
    kind = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        for batch in batches:
            out = {name: [] for name in kind.names}
            for doc, item, start, words, item_words, surprise in zip(*(batch.column(k).to_pylist() for k in range(6))):
                item_keys, keys, surprise = word_keys(item_words.split()), word_keys(words.split()), np.array(surprise)
                # No alignment scores more than the words that both sides have.
                need = needed(surprise, threshold)
                if surprise[np.isin(item_keys, keys)].sum() < need * surprise.sum() * (1 - 1e-9):
                    continue
                score, a, b = align(item_keys, surprise, keys)
                if score >= need - 1e-9:
                    for name, x in zip(kind.names, (doc, item, score, start + a, start + b)):
                        out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    scored = both.mapInArrow(run, "doc_id long, item_id long, score double, start long, stop long")
    best = F.max(F.struct(F.round("score", 6).alias("score"), (-F.col("start")).alias("s"), "stop"))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", F.col("best.score").alias("score"), (-F.col("best.s")).alias("start"), F.col("best.stop").alias("stop")
    )
