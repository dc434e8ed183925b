"""Document quality: random-indexing word vectors over the whole corpus, pooled, and a small network."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from claimlens.llm.common import id_and_text
from claimlens.llm.linear import labelled_sample, log_loss

THRESHOLD = 0.3
#: At most so many labelled rows of either label are learned from.
PER_CLASS = 2000
CELLS = 1 << 14
WIDTH = 32
BLOCK_CELLS = 512
MARKS = 2
REACH = 1
HIDDEN = 32
EPOCHS = 40
CACHE = 1 << 20
FLUSH = 1 << 20
#: The sums of tasks are added up in so many parts first.
FAN = 1024
#: Words, numbers and runs of signs; case is kept.
_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+")


class Cells(dict):
    """The cell of a token: words share ``CELLS`` hashed rows, so the vectors have one size however many words there are."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        cell = self[token] = xxhash.xxh32_intdigest(token) % CELLS
        return cell

    def of(self, text: bytes | None) -> np.ndarray:
        tokens = _TOKEN.findall(text) if text else []
        return np.fromiter((self[t] for t in tokens), np.int64, len(tokens))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The sparse random vector of each cell: ``MARKS`` places and their signs."""
    draw = np.random.default_rng(3)
    places = np.argsort(draw.random((CELLS, WIDTH)), axis=1)[:, :MARKS]
    return places, draw.choice(np.array([-1, 1]), (CELLS, MARKS))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """One row a cell: the sum of the index vectors of all neighbours its words have in ``docs``, at length 1.

    Each task adds up its own documents and gives the sums in blocks of cells, which are added up by block in a tree of two levels:
    what is shuffled is the size of the table once a task, and the driver gets the table.
    """

    def run(batches):
        cells, (places, signs) = Cells(), index_vectors()
        sums, held, size = np.zeros(CELLS * WIDTH), [], 0

        def flush():
            x = np.concatenate(held)
            for off in range(1, REACH + 1):
                here, there = x[off:], x[:-off]
                both = (here >= 0) & (there >= 0)
                here, there = here[both], there[both]
                for a, b in ((here, there), (there, here)):
                    for k in range(MARKS):
                        sums[:] += np.bincount(a * WIDTH + places[b, k], signs[b, k], CELLS * WIDTH)

        gap = np.full(REACH, -1)  # documents are no neighbours
        for batch in batches:
            for text in batch.column(1):
                for part in _slices(cells.of(text.as_py())):
                    held += [part, gap]
                    size += len(part)
                    if size >= FLUSH:
                        flush()
                        held, size = [], 0
        if held:
            flush()
        table = sums.astype(np.int64).reshape(-1, BLOCK_CELLS * WIDTH)
        block, part = pa.array(np.arange(len(table))), pa.array([TaskContext.get().partitionId() % FAN] * len(table))
        yield pa.RecordBatch.from_arrays([block, part, pa.array([row.tobytes() for row in table], pa.binary())], names=["block", "part", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, block, part = 0, None, None
        for batch in batches:
            for row in batch.column("sums"):
                total = total + np.frombuffer(row.as_py(), np.int64)
            block, part = batch.column("block")[0].as_py(), batch.column("part")[0].as_py()
        names = ["block", "part", "sums"]
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=names)

    # A tree of sums, row by row: first the tasks of each of FAN parts, then the parts; no group is held whole.
    kind = "block long, part long, sums binary"
    parts = docs.mapInArrow(run, kind).groupBy("block", "part").applyInArrow(added, kind).groupBy("block").applyInArrow(added, kind)
    table = np.zeros((CELLS // BLOCK_CELLS, BLOCK_CELLS * WIDTH))
    for row in parts.collect():  # CELLS * WIDTH numbers, whatever the corpus
        table[row["block"]] = np.frombuffer(row["sums"], np.int64)
    table = table.reshape(CELLS, WIDTH)
    return (table / np.maximum(np.sqrt((table * table).sum(axis=1, keepdims=True)), 1e-9)).astype(np.float32)


def _slices(x: np.ndarray):
    for k in range(0, max(1, len(x)), FLUSH):
        yield x[k : k + FLUSH]


def pooled(cells: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean over words, mean over distinct words, spread, and how many and how varied the words are."""
    if not len(cells):
        return np.zeros(3 * WIDTH + 2, np.float32)
    own, counts = np.unique(cells, return_counts=True)
    v, share = vectors[own], (counts / len(cells)).astype(np.float32)
    mean = share @ v
    spread = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
    return np.concatenate([mean, v.mean(axis=0), spread, [np.log1p(len(cells)), len(own) / len(cells)]])


class Network:
    """Two layers fitted by Adam on weighed rows; a temperature, fitted on rows held out, calibrates the probabilities."""

    def __init__(self, x: np.ndarray, y: np.ndarray, prior: float, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-4
        x = self._scaled(x)
        rest = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
        share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
        self.p = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self._fit(x[~rest], y[~rest], weight[~rest], draw)
        self.temperature = 1.0
        if rest.any():
            raw = self._raw(x[rest])
            self.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: log_loss(1 / (1 + np.exp(-np.clip(raw / t, -30, 30))), y[rest]))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10)

    def _fit(self, x, y, weight, draw):
        one, two = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        step = 0
        for _ in range(EPOCHS):
            order = draw.permutation(len(x))
            for k in range(0, len(order), 128):
                i = order[k : k + 128]
                hidden = np.tanh(x[i] @ self.p[0] + self.p[1])
                p = 1 / (1 + np.exp(-np.clip(hidden @ self.p[2] + self.p[3], -30, 30)))
                error = weight[i] * (p - y[i]) / len(i)
                back = np.outer(error, self.p[2]) * (1 - hidden * hidden)
                slopes = [x[i].T @ back + 1e-4 * self.p[0], back.sum(axis=0), hidden.T @ error + 1e-4 * self.p[2], np.array([error.sum()])]
                step += 1
                for j, g in enumerate(slopes):
                    one[j] = 0.9 * one[j] + 0.1 * g
                    two[j] = 0.999 * two[j] + 0.001 * g * g
                    self.p[j] = self.p[j] - 2e-3 * (one[j] / (1 - 0.9**step)) / (np.sqrt(two[j] / (1 - 0.999**step)) + 1e-8)

    def _raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._raw(self._scaled(x)) / self.temperature, -30, 30)))


def quality_scores(
    docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS
) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the probability of quality 1.

    The word vectors come from all documents; the network learns from at most ``per_class`` labelled rows a label where
    ``learnable`` (over labels' doc_id) holds. Null and empty texts pool to zeros and are scored as such. Rows without
    an id and repeated rows are each scored. Without labels of both kinds every score is the labels' share of
    quality 1. An empty table gives no rows.
    """
    texts = id_and_text(docs, id_col, text_col)
    sample, prior = labelled_sample(docs, labels, "quality", learnable, per_class, id_col, text_col)
    vectors, model = word_vectors(texts), None
    truth = np.array([label for _, label in sample], np.float64)
    if 0 < truth.sum() < len(truth):
        cells = Cells()
        model = Network(np.array([pooled(cells.of(t), vectors) for t, _ in sample]), truth, prior)

    def run(batches):
        own = Cells()
        for batch in batches:
            x = [pooled(own.of(t.as_py()), vectors) for t in batch.column(1)]
            score = model(np.array(x)) if model and x else np.full(len(x), prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double")
