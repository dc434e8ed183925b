"""Toxicity by compression distance: a dictionary of toxic text against one of ordinary text, window by window."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import id_and_text
from claimlens.llm.linear import Logistic, labelled_sample, log_loss

THRESHOLD = 0.7
#: At most so many labelled rows of either label are learned from.
PER_CLASS = 1500
MIN_SIGNIFICANCE = (3.0, 4.0, 5.0, 6.0, 7.0)
MIN_DOCS = 3
ORDINARY_WORDS = 2000
LEVEL = 13
#: Put after each window and at the end of both dictionaries: the compressor looks for no match in the last bytes of its input.
TAIL = bytes(range(1, 17))
LENGTHS = (20, 32, 32)
CACHE = 1 << 19
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


def distinctive_words(toxic: list, ordinary: list) -> list[tuple[float, bytes]]:
    """(significance, word) of the words that more toxic than ordinary texts hold, largest first."""
    a, b = (Counter(w for words in docs for w in set(words)) for docs in (toxic, ordinary))
    n, m = max(1, len(toxic)), max(1, len(ordinary))
    out = []
    for word, hits in a.items():
        if hits >= min(MIN_DOCS, n):
            share = (hits + b[word]) / (n + m)
            if 0 < share < 1:
                out.append(((hits / n - b[word] / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m)), word))
    return sorted(out, key=lambda x: (-x[0], x[1]))


class Lengths(dict):
    """The class of a window, by its length and its compressed lengths under both dictionaries; each word once."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self.pair = [self._compressor(d) for d in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=4
        )
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(compression_params=how, dict_data=words)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        window = b" " + word + b" " + TAIL
        a, b = (min(max(len(c.compress(window)) - 8, 0), 31) for c in self.pair)
        code = self[word] = (min(len(word), LENGTHS[0] - 1) * LENGTHS[1] + a) * LENGTHS[2] + b
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self[w] for w in words), np.int64, len(words)) if words else np.zeros(1, np.int64)


def _content(words) -> bytes:
    return b" " + b" ".join(words) + b" " + TAIL


class Classifier:
    """Two dictionaries, the log odds of each class of window, and a logistic regression of what they add up to."""

    def __init__(self, toxic: list, ordinary: list, prior: float, significance: float):
        ranked = distinctive_words(toxic, ordinary)
        marked = [w for s, w in ranked if s >= significance] or [w for _, w in ranked[:10]]
        common = Counter(w for words in ordinary for w in set(words)).most_common(ORDINARY_WORDS)
        self.dictionaries = _content(marked), _content([w for w, _ in common][: max(16, len(marked))])
        lengths = Lengths(*self.dictionaries)
        codes = [lengths.of(words) for words in [*toxic, *ordinary]]
        size = LENGTHS[0] * LENGTHS[1] * LENGTHS[2]
        a = np.bincount(np.concatenate(codes[: len(toxic)]), minlength=size)
        b = np.bincount(np.concatenate(codes[len(toxic) :]), minlength=size)
        odds = np.log((a + 0.5) / a.sum()) - np.log((b + 0.5) / b.sum())
        self.odds = np.where(a + b > 0, odds, 0.0)
        x = np.array([self.features(c) for c in codes])
        self.logistic = Logistic(x, np.array([1] * len(toxic) + [0] * len(ordinary)), prior)

    def features(self, codes: np.ndarray) -> list[float]:
        v = self.odds[codes]
        top = -np.sort(-v)[:3] if len(v) < 64 else -np.sort(-v[np.argpartition(-v, 3)[:3]])
        over, far = (v > 1).sum(), (v > 2).sum()
        return [v.mean(), top.mean(), top[0], over / len(v), np.log1p(over), far / len(v), np.log1p(far), np.log(len(v))]

    def scores(self, texts: list, lengths: Lengths) -> np.ndarray:
        return self.logistic(np.array([self.features(lengths.of(plain_words(t))) for t in texts])) if texts else np.zeros(0)


def train(sample: list[tuple[bytes, int]], prior: float) -> Classifier | None:
    """The classifier with the significance that does best on a third of the sample held out within; None without both labels.

    The significance of a real difference grows with the root of the number of texts, so the one found on two thirds is
    raised by that much for the whole.
    """
    words = [(plain_words(text), label) for text, label in sample]
    groups = {k: [w for w, label in words if label == k] for k in (0, 1)}
    if not all(groups.values()):
        return None
    if min(len(g) for g in groups.values()) < 12:
        return Classifier(groups[1], groups[0], prior, MIN_SIGNIFICANCE[0])
    fit = {k: [w for i, w in enumerate(g) if i % 3] for k, g in groups.items()}
    rest = {k: [w for i, w in enumerate(g) if not i % 3] for k, g in groups.items()}
    truth = np.array([1] * len(rest[1]) + [0] * len(rest[0]))
    losses = []
    for significance in MIN_SIGNIFICANCE:
        model = Classifier(fit[1], fit[0], 0.5, significance)
        lengths = Lengths(*model.dictionaries)
        p = model.logistic(np.array([model.features(lengths.of(w)) for w in rest[1] + rest[0]]))
        losses.append(log_loss(p[truth == 1], truth[truth == 1]) + log_loss(p[truth == 0], truth[truth == 0]))
    return Classifier(groups[1], groups[0], prior, 1.5**0.5 * MIN_SIGNIFICANCE[int(np.argmin(losses))])


def toxic_scores(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    per_class: int = PER_CLASS,
) -> DataFrame:
    """(doc_id, kept, score) of every row of ``docs``: the probability that a reader would label it toxic.

    Windows are words with the spaces around them. The toxic dictionary holds the words that set toxic texts apart, the
    ordinary one the commonest words. How a window's length falls under either tells its log odds, and a logistic
    regression of their mean, largest and count gives the probability, at the labels' own share of toxic texts. Learned
    from at most ``per_class`` rows a label where ``learnable`` (over labels' doc_id) holds. Null and empty texts score like
    one ordinary word. Rows without an id and repeated rows are each scored. Without labels of both kinds all
    scores are the labels' share of toxic texts. An empty table gives no rows.
    """
    sample, prior = labelled_sample(docs, labels, "toxic", learnable, per_class, id_col, text_col)
    model = train(sample, prior)
    rows = id_and_text(docs, id_col, text_col)
    if keep:
        kept = F.struct(*[F.col(c) for c in keep]).alias("kept")
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), kept)

    def run(batches):
        lengths = Lengths(*model.dictionaries) if model else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            score = model.scores(texts, lengths) if model else np.full(len(texts), prior)
            rest = [batch.column(2)] if batch.num_columns > 2 else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *rest, pa.array(score)], names=["doc_id", *["kept"] * len(rest), "score"])

    kind = f"kept {rows.schema['kept'].dataType.simpleString()}, " if keep else ""
    return rows.mapInArrow(run, f"doc_id long, {kind}score double")
