"""Similar-case search over claim narratives: vectors, keywords, and the two fused."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from claimlens import schemas
from claimlens.functions import text
from claimlens.functions.nested import cob_payer
from claimlens.functions.scores import reciprocal
from claimlens.functions.sizing import evaluated_once
from claimlens.functions.vectors import distances_to
from claimlens.operators.serving import top_claims
from claimlens.sources.tables import write

#: Parts that the notes of one word are dealt into; a file holds parts of many words, in order.
WORD_PARTS = 256
#: Words that are counted at once.
WORDS_AT_ONCE = 500_000
#: The cells of a near index.
MAX_CELLS = 1024


def narratives(claims: DataFrame, providers: DataFrame, limit: int | None = 500) -> DataFrame:
    """(claim_id, narrative) of the dearest claims; no limit tells every claim.

    The provider table joins without a hint: it is broadcast when its size allows, and a provider
    with a great part of the claims is split by the skew handling when it does not.
    """
    facts = top_claims(claims, limit).withColumn("cob_payer", cob_payer())
    named = providers.select("provider_id", "provider_name", "specialty")
    return facts.join(named, "provider_id", "left").select("claim_id", text.narrative().alias("narrative"))


def _places(words: Column, dim: int) -> Column:
    """The place of each word in a vector of ``dim`` hashed words."""
    return F.transform(words, lambda w: F.pmod(F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(dim)))


def _words(notes: DataFrame) -> Column:
    return F.col("tokens") if "tokens" in notes.columns else text.tokens(F.col("narrative"))


def with_places(notes: DataFrame, dim: int = 64) -> DataFrame:
    """``notes`` with the places of its words as a stored column, so that weights and vectors do not hash them again."""
    return notes.withColumn("places", _places(_words(notes), dim).cast("array<int>"))


def _placed(notes: DataFrame, dim: int) -> Column:
    return F.col("places") if "places" in notes.columns else _places(_words(notes), dim)


def vector_weights(notes: DataFrame, dim: int = 64) -> list[float]:
    """What ``narrative_vectors`` and ``embed_query`` need: the rarity of each of ``dim`` hashed words over all notes.

    One number a place, so it can be kept next to the stored notes and asked again at any time.
    """
    places = notes.select(F.explode(F.array_distinct(_placed(notes, dim))).alias("place"))
    counts = {r["place"]: r["n"] for r in places.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}  # dim rows
    total = notes.count()
    return [math.log((total + 1) / (counts.get(i, 0) + 1)) for i in range(dim)]


def narrative_vectors(notes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``notes`` with an embedding column: hashed word counts times ``weights``, scaled to length 1; zeros without a word of weight.

    Counting, weighing and scaling are Spark ML's own transformers; no row passes through Python.
    """
    dim = len(weights)
    counted = CountVectorizerModel.from_vocabulary([str(k) for k in range(dim)], inputCol="_places", outputCol="_counts")
    weighed = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighed")
    scaled = Normalizer(p=2.0, inputCol="_weighed", outputCol="_scaled")
    places = F.coalesce(_placed(notes, dim).cast("array<string>"), F.array().cast("array<string>"))
    made = PipelineModel([counted, weighed, scaled]).transform(notes.withColumn("_places", places))
    return made.withColumn("embedding", vector_to_array("_scaled", "float32")).drop("_places", "_counts", "_weighed", "_scaled")


def embed_query(query: str, weights: Sequence[float]) -> list[float]:
    """A question as a vector in the notes' own space."""
    vector = np.zeros(len(weights))
    for word in text.words(query):
        vector[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % len(weights)] += 1
    vector *= np.asarray(weights)
    length = np.linalg.norm(vector)
    return [float(x) for x in (vector / length if length else vector).astype(np.float32)]


def claim_notes(notes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """The search table: claim_id, narrative, embedding and tokens; ``insert_if_absent`` adds later claims to it."""
    told = notes if "tokens" in notes.columns else with_tokens(notes)
    return narrative_vectors(told, weights).select([f.name for f in schemas.CLAIM_NOTES.fields])


def with_tokens(notes: DataFrame, column: str = "narrative") -> DataFrame:
    """``notes`` with its words as a stored column, so that a search does not split the text again."""
    return notes.withColumn("tokens", text.tokens(F.col(column)))


def _ranked(best: DataFrame, *order) -> DataFrame:
    """Rank a short list; it has been limited already, so one task holds only the list."""
    return best.withColumn("rk", F.row_number().over(Window.orderBy(*order)))


def vector_top(notes: DataFrame, query: Sequence[float], n: int = 30, key: str = "claim_id") -> DataFrame:
    """The n nearest rows by cosine distance, ranked.

    Every task keeps its own n best rows, and only those are merged. Rows without a distance sort
    last and are dropped after the limit: a filter before it would compute every distance twice.
    """
    near = notes.withColumn("distance", distances_to(F.col("embedding"), query))
    best = near.orderBy(F.asc_nulls_last("distance"), key).limit(n).where("distance is not null")
    return _ranked(best, "distance", key)


def keyword_top(notes: DataFrame, query: str, n: int = 30, key: str = "claim_id", column: str = "narrative") -> DataFrame:
    """The n best rows that hold every word of the query, by BM25, ranked.

    Counting the query's words is row-local, so no word list is ever shuffled: one aggregate gives
    the corpus figures as a single row, and the scored rows meet in a top-n. Only rows that can hold
    every word are split a second time for their score.
    """
    terms = text.query_terms(query)
    kept = [c for c in notes.columns if c != "tokens"]
    if not terms:
        return notes.select(*kept, F.lit(0.0).alias("score"), F.lit(0).alias("rk")).limit(0)
    stored = "tokens" in notes.columns
    words = F.col("tokens") if stored else text.tokens(F.col(column))

    def counted(rows: DataFrame) -> DataFrame:
        counts = F.transform(F.array(*[F.lit(t) for t in terms]), lambda t: F.size(F.filter("_w", lambda w: w == t)))
        split = evaluated_once(rows.select(*kept, words.alias("_w")), "_w")
        return split.select(*kept, F.size("_w").alias("_len"), counts.alias("_tf"))

    figures = (
        counted(notes)
        .agg(
            F.struct(
                F.count(F.lit(1)).alias("docs"),
                F.avg("_len").alias("mean"),
                F.array(*[F.count_if(F.col("_tf")[i] > 0) for i in range(len(terms))]).alias("df"),
            ).alias("f")
        )
        .scalar()
    )
    possible = [F.array_contains("tokens", t) if stored else F.lower(F.col(column)).contains(t) for t in terms]
    found = counted(notes.where(reduce(Column.__and__, possible))).withColumn("_f", figures)
    parts = [
        text.bm25_term(F.col("_tf")[i], F.col("_f.df")[i], F.col("_f.docs"), F.col("_len"), F.col("_f.mean"))
        for i in range(len(terms))
    ]
    every_term = F.array_min("_tf") > 0
    score = F.when(every_term, F.round(reduce(Column.__add__, parts), 6)).alias("score")
    # A row that lacks a word has no score, sorts last, and is dropped after the limit.
    best = found.select(*kept, score).orderBy(F.desc_nulls_last("score"), key).limit(n).where("score is not null")
    return _ranked(best, F.desc("score"), key)


def _counted_in_batch(batch: pa.RecordBatch, keys: Sequence[str]) -> pa.RecordBatch:
    """The words of a batch of rows counted by row, sorted by word and then by the keys, last one first."""
    lists = batch.column("_w")
    words, parents = lists.flatten(), pc.list_parent_indices(lists)
    if words.null_count:
        words, parents = words.drop_null(), parents.filter(words.is_valid())
    coded = words.dictionary_encode()
    by_term = pc.sort_indices(coded.dictionary).to_numpy()
    by_key = pc.sort_indices(batch, sort_keys=[(k, "ascending") for k in reversed(keys)]).to_numpy()
    term_place, key_place = np.argsort(by_term), np.argsort(by_key)
    pairs = term_place[coded.indices.to_numpy()] * batch.num_rows + key_place[parents.to_numpy()]
    found, times = np.unique(pairs, return_counts=True)
    rows = pa.array(by_key[found % batch.num_rows])
    columns = [batch.column(k).take(rows) for k in keys]
    columns += [pc.list_value_length(lists).cast("int32").take(rows), coded.dictionary.take(pa.array(by_term[found // batch.num_rows])), pa.array(times, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, [*keys, "length", "term", "times"])


def counted_words(lists: DataFrame, *keys: str) -> DataFrame:
    """(*keys, length, term, times) of rows with their words in ``_w``: the words of a row counted where the row is, without a shuffle.

    Counted by Arrow batch, ``WORDS_AT_ONCE`` words at most. The rows of a batch leave in order of word and keys, so that a sort by these only merges.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("_w")), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(words // WORDS_AT_ONCE)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if stop > start:
                    yield _counted_in_batch(batch.slice(start, stop - start), keys)

    schema = StructType([lists.schema[k] for k in keys]).add("length", IntegerType()).add("term", StringType()).add("times", IntegerType())
    return lists.select(*keys, "_w").mapInArrow(counted, schema)


def one_a_key(counted: DataFrame, key: str, *parts: str) -> DataFrame:
    """The counted words, a row a word and key, sorted in parts by word and ``parts``: rows that share a key are added up.

    One shuffle deals, groups and lays out. ``parts`` cut a word of many notes into many files.
    """
    dealt = counted.repartition("term", *parts)
    summed = dealt.groupBy("term", *parts, key).agg(F.sum("times").cast("int").alias("times"), F.first("length").alias("length"))
    return summed.sortWithinPartitions("term", *parts, key)


def one_note_a_key(notes: DataFrame, key: str) -> bool:
    return notes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def write_words(notes: DataFrame, path: str, key: str = "claim_id", column: str = "narrative") -> None:
    """The words of the notes as a table below ``path``: a row a word and note, laid out by word, and the corpus figures.

    A question reads the pages of its own words only. Where every key has one note, which a count tells, the notes' lists of words are
    dealt by key and counted after that: a key is moved once, not with each of its words. Where keys repeat, the counted words are
    moved, and a word's notes are dealt into ``WORD_PARTS`` parts by their key. A word of many notes goes to many files both ways.
    """
    if "tokens" not in notes.columns:  # split once, and kept for the figures
        write(notes.select(key, text.tokens(F.col(column)).alias("tokens")), f"{path}/lists", skip_empty=False)
        notes = notes.sparkSession.read.parquet(f"{path}/lists")
    lists = notes.select(key, F.col("tokens").alias("_w"))
    if one_note_a_key(lists, key):
        counted = counted_words(lists.repartition(key), key).select("term", key, "times", "length").sortWithinPartitions("term", key)
    else:
        part = F.pmod(F.xxhash64(key), F.lit(WORD_PARTS)).cast("int").alias("_part")
        counted = one_a_key(counted_words(lists, key).select("*", part), key, "_part").drop("_part")
    write(counted, f"{path}/words", skip_empty=False)
    figures = lists.agg(F.count(F.lit(1)).alias("docs"), F.avg(F.size("_w")).alias("mean"))
    write(figures, f"{path}/figures", skip_empty=False)


def words_top(spark: SparkSession, path: str, query: str, n: int = 30, key: str = "claim_id") -> DataFrame:
    """(key, score, rk): the n best notes that hold every word of the query, by BM25, from the table of words."""
    terms = text.query_terms(query)
    words = spark.read.parquet(f"{path}/words")
    if not terms:
        return words.select(key, F.lit(0.0).alias("score"), F.lit(0).alias("rk")).limit(0)
    rows = words.where(F.col("term").isin(terms))
    figures = spark.read.parquet(f"{path}/figures").first()
    df = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a term
    known = F.create_map(*[F.lit(x) for t in terms for x in (t, df.get(t, 0))])
    part = text.bm25_term(F.col("times"), known[F.col("term")], F.lit(figures["docs"]), F.col("length"), F.lit(figures["mean"]))
    scored = rows.groupBy(key).agg(F.count(F.lit(1)).alias("held"), F.round(F.sum(part), 6).alias("score"))
    best = scored.where(F.col("held") == len(terms)).orderBy(F.desc("score"), key).limit(n).select(key, "score")
    return _ranked(best, F.desc("score"), key)


def hybrid_search(
    notes: DataFrame, words_path: str, vector: Sequence[float], query: str, n: int = 10, candidates: int = 30, key: str = "claim_id"
) -> DataFrame:
    """The n best rows of the vector list and the keyword list, fused by reciprocal rank, each list over all notes.

    Texts are looked up for the n answers only.
    """
    near = vector_top(notes, vector, candidates, key).select(key, F.col("rk").alias("_rv"))
    worded = words_top(notes.sparkSession, words_path, query, candidates, key).select(key, F.col("rk").alias("_rk"))
    score = F.round(reciprocal(F.col("_rv")) + reciprocal(F.col("_rk")), 5)
    best = near.join(worded, key, "full_outer").select(key, score.alias("rrf_score")).orderBy(F.desc("rrf_score"), key).limit(n)
    told = notes.select(key, "narrative").join(F.broadcast(best), key)
    return told.select(key, "narrative", "rrf_score").orderBy(F.desc("rrf_score"), key)


def near_index(
    notes: DataFrame,
    path: str,
    rows_per_cell: int = 2000,
    recall: float = 0.97,
    asked: int = 64,
    n: int = 30,
    fit_rows: int = 100_000,
    seed: int = 42,
    key: str = "claim_id",
) -> None:
    """Lay the notes out below ``path`` by the cell their vector falls in, with the cells' centers.

    The number of cells follows the number of rows up to ``MAX_CELLS``, so placing a row costs as many comparisons at most and the
    whole grows with the rows alone; beyond that the cells grow. Centers are fitted on about ``fit_rows`` rows at most (the stated
    bound of a sample); every row is placed. How many cells a question must read is measured, not assumed: for ``asked``
    stored vectors the true ``n`` nearest of all rows are found, and the cells are counted, nearest first, that hold
    the share ``recall`` of them. Rows without a direction are near nothing and are left out.
    """
    pointed = notes.where(F.exists("embedding", lambda x: x != 0)).withColumn("_v", array_to_vector("embedding"))
    rows = pointed.count()
    if not rows:
        raise ValueError("no vector to index")
    cells = max(1, min(rows, MAX_CELLS, max(8, -(-rows // rows_per_cell))))
    vectors = pointed.select("_v")
    sample = vectors if rows <= fit_rows else vectors.sample(fit_rows / rows, seed)
    means = KMeans(featuresCol="_v", predictionCol="cell", k=cells, seed=seed, distanceMeasure="cosine")
    model = means.fit(sample.cache())
    sample.unpersist()
    placed = model.transform(pointed).drop("_v")
    placed.repartitionByRange("cell", key).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    centers = [[float(x) for x in center] for center in model.clusterCenters()]
    indexed = notes.sparkSession.read.parquet(f"{path}/rows")
    counts = {r["cell"]: r["n"] for r in indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    questions = indexed.orderBy(F.xxhash64(key), key).limit(asked).select("embedding").collect()
    probes = _probes_for(indexed, np.array(centers), np.array([q["embedding"] for q in questions], np.float64), n, recall, key)
    table = [(i, c, counts.get(i, 0), probes) for i, c in enumerate(centers)]
    write(notes.sparkSession.createDataFrame(table, "cell int, center array<double>, n long, probes int"), f"{path}/centers")


def _cell_order(centers: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The cells by the angle of their center to each question, nearest first."""
    lengths = np.linalg.norm(centers, axis=1)
    cosine = np.divide(asked @ centers.T, lengths, out=np.full((len(asked), len(centers)), -np.inf), where=lengths > 0)
    return np.argsort(-cosine, axis=1, kind="stable")


def _probes_for(indexed: DataFrame, centers: np.ndarray, asked: np.ndarray, n: int, recall: float, key: str) -> int:
    """How many cells hold the share ``recall`` of the true nearest of the questions, on average."""
    unit = asked / np.linalg.norm(asked, axis=1, keepdims=True)

    def best(batches):
        held = None
        for batch in batches:
            rows = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
            cosine = (rows / np.linalg.norm(rows, axis=1, keepdims=True)) @ unit.T
            new = pd.concat(
                [pd.DataFrame({"q": q, "cell": batch["cell"], "cosine": cosine[:, q]}).nlargest(n, "cosine") for q in range(len(unit))]
            )
            held = new if held is None else pd.concat([held, new]).sort_values("cosine", ascending=False).groupby("q").head(n)
        if held is not None:
            yield held

    found = indexed.select("cell", "embedding").mapInPandas(best, "q long, cell long, cosine double").toPandas()  # n rows a question and task
    found = found.sort_values("cosine", ascending=False).groupby("q").head(n)
    place = np.argsort(_cell_order(centers, asked), axis=1)  # place[q, cell]: how manieth the cell is read
    needed = np.sort(place[found["q"].to_numpy(int), found["cell"].to_numpy(int)])
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def ann_top(spark: SparkSession, path: str, query: Sequence[float], n: int = 30, key: str = "claim_id") -> DataFrame:
    """About the n nearest rows: exact distances over the cells nearest to the query; n rows whenever there are as many.

    Reads the cells the index was measured to need, and more while they hold fewer than n rows.
    """
    cells = spark.read.parquet(f"{path}/centers").orderBy("cell").collect()  # one row a cell
    order = _cell_order(np.array([c["center"] for c in cells]), np.asarray([query], dtype=np.float64))[0]
    taken, held = [], 0
    for cell in order.tolist():
        if len(taken) >= cells[0]["probes"] and held >= n:
            break
        taken.append(cell)
        held += cells[cell]["n"]
    indexed = spark.read.parquet(f"{path}/rows").where(F.col("cell").isin(taken)).drop("cell")
    return vector_top(indexed, query, n, key)
