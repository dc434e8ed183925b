"""Language of a text: a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.common import id_and_text
from claimlens.llm.linear import MAX_SAMPLE_BYTES

UNKNOWN = "und"
#: At most so many documents of each language, and segments of each document, are learned from.
PER_LANGUAGE = 400
PER_DOCUMENT = 8
SEGMENT = 64
HIDDEN = 8
EPOCHS = 8
BATCH = 256
SIDE_BY_SIDE = 2048
_LETTER = regex.compile(r"\p{L}")


def segments(text: bytes) -> np.ndarray:
    """The whole text in rows of ``SEGMENT`` bytes; the last is filled with zero bytes."""
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(-(-len(raw) // SEGMENT) * SEGMENT, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(-1, SEGMENT)


def _squash(v: np.ndarray) -> np.ndarray:
    """The logistic function of ``v``, in place."""
    v *= 0.5
    np.tanh(v, v)
    v += 1
    v *= 0.5
    return v


def _shares(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


class Network:
    """Two gated recurrent layers, one read forwards and one backwards; each byte is labelled from both states.

    With state h and byte row e: z and r are squashed sums, g = tanh(e_g + r * u_g), h' = h + z * (g - h).
    """

    def __init__(self, languages: list[str], seed: int = 0):
        draw = np.random.default_rng(seed)
        self.languages = languages
        shapes = {"bytes": (2, 256, 3 * HIDDEN), "states": (2, HIDDEN, 3 * HIDDEN), "out": (2 * HIDDEN, len(languages))}
        self.p = {k: (draw.normal(0, HIDDEN**-0.5 if k == "states" else 0.3, s)).astype(np.float32) for k, s in shapes.items()}
        self.p["bias"] = np.zeros(len(languages), np.float32)

    def _states(self, rows: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States after each byte, (SEGMENT, rows, HIDDEN), in the order of the bytes."""
        table, weights = self.p["bytes"][way], self.p["states"][way]
        columns = np.ascontiguousarray(rows.T)
        h = np.zeros((len(rows), HIDDEN), np.float32)
        out = np.empty((SEGMENT, len(rows), HIDDEN), np.float32)
        for t in range(SEGMENT) if way == 0 else range(SEGMENT - 1, -1, -1):
            e, u = table[columns[t]], h @ weights
            gates = _squash(e[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            g = u[:, 2 * HIDDEN :] * r
            g += e[:, 2 * HIDDEN :]
            np.tanh(g, g)
            if keep is not None:
                keep.append((t, columns[t], h, z, r, g.copy(), u[:, 2 * HIDDEN :]))
            g -= h
            g *= z
            h = h + g
            out[t] = h
        return out

    def label(self, rows: np.ndarray) -> np.ndarray:
        """The share of each language at each byte, (SEGMENT, rows, languages)."""
        front, back = self._states(rows, 0), self._states(rows, 1)
        return _shares(front @ self.p["out"][:HIDDEN] + back @ self.p["out"][HIDDEN:] + self.p["bias"])

    def slopes(self, rows: np.ndarray, truth: np.ndarray) -> dict:
        """Gradients of the mean loss over all real bytes, by backpropagation through time."""
        kept: tuple[list, list] = ([], [])
        states = np.concatenate([self._states(rows, 0, kept[0]), self._states(rows, 1, kept[1])], axis=2)
        error = _shares(states @ self.p["out"] + self.p["bias"])
        error[:, np.arange(len(rows)), truth] -= 1
        real = (rows.T != 0).astype(np.float32)
        error *= (real / max(1.0, float(real.sum())))[:, :, None]
        slope = {k: np.zeros_like(v) for k, v in self.p.items()}
        slope["out"] = np.einsum("tnc,tnk->ck", states, error)
        slope["bias"] = error.sum(axis=(0, 1))
        to_states = error @ self.p["out"].T
        for way in (0, 1):
            weights, down = self.p["states"][way], np.zeros((len(rows), HIDDEN), np.float32)
            for t, byte, h, z, r, g, u in reversed(kept[way]):
                down = down + to_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                dz = down * (g - h) * z * (1 - z)
                dg = down * z * (1 - g * g)
                dr = dg * u * r * (1 - r)
                du = np.concatenate([dz, dr, dg * r], axis=1)
                np.add.at(slope["bytes"][way], byte, np.concatenate([dz, dr, dg], axis=1))
                slope["states"][way] += h.T @ du
                down = down * (1 - z) + du @ weights.T
        return slope

    def fit(self, rows: np.ndarray, truth: np.ndarray, epochs: int = EPOCHS, rate: float = 5e-3) -> None:
        draw = np.random.default_rng(1)
        one, two = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        steps = max(epochs * -(-len(rows) // BATCH), 240)  # few rows are seen more often
        while step < steps:
            order = draw.permutation(len(rows))
            for k in range(0, len(order), BATCH):
                i = order[k : k + BATCH]
                step += 1
                for name, g in self.slopes(rows[i], truth[i]).items():
                    one[name] = 0.9 * one[name] + 0.1 * g
                    two[name] = 0.999 * two[name] + 0.001 * g * g
                    move = (one[name] / (1 - 0.9**step)) / (np.sqrt(two[name] / (1 - 0.999**step)) + 1e-8)
                    self.p[name] = (self.p[name] - rate * (1 - 0.8 * step / steps) * move).astype(np.float32)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """The mean share of each language over all bytes of each text; texts are not empty."""
        rows = [segments(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
        stacked = np.concatenate(rows)
        total = np.zeros((len(texts), len(self.languages)))
        for k in range(0, len(stacked), SIDE_BY_SIDE):
            some = stacked[k : k + SIDE_BY_SIDE]
            share = self.label(some)
            share *= (some.T != 0)[:, :, None]
            np.add.at(total, owner[k : k + SIDE_BY_SIDE], share.sum(axis=0))
        return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9)


def training_rows(docs: DataFrame, learnable: Column, id_col: str, text_col: str, lang_col: str, per_language: int):
    """(text, lang) of at most ``per_language`` documents of each language, those of the smallest hash of the id."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"))
    texts = texts.where(learnable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts = texts.where((F.octet_length("text") > 0) & (F.octet_length("text") <= MAX_SAMPLE_BYTES))
    # Of a common language only ids of small hash are ranked: about four times as many as are wanted.
    drawn = texts.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("draw"))
    counts = {r["lang"]: r["n"] for r in drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    for lang, n in counts.items():
        if n > 4 * per_language:
            drawn = drawn.where((F.col("lang") != lang) | (F.col("draw") < int((1 << 40) * 4 * per_language / n)))
    place = F.row_number().over(W.partitionBy("lang").orderBy("draw", "doc_id"))
    ids = drawn.withColumn("place", place).where(F.col("place") <= per_language)
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"]) for r in ids.collect()], "doc_id long, lang string")
    # As many ids as languages times per_language: a broadcast of known size.
    rows = texts.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    return [(bytes(r["text"]), r["lang"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["lang"]))]


def train(rows: list[tuple[bytes, str]]) -> Network | None:
    if not rows:
        return None
    languages = sorted({lang for _, lang in rows})
    draw = np.random.default_rng(2)
    cut, truth = [], []
    for text, lang in rows:
        some = segments(text)
        some = some[draw.permutation(len(some))[:PER_DOCUMENT]]
        cut.append(some)
        truth += [languages.index(lang)] * len(some)
    model = Network(languages)
    model.fit(np.concatenate(cut), np.array(truth))
    return model


def languages(
    docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE
) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``; score is the mean share of the language over the text's bytes.

    Learned from at most ``per_language`` documents of each language where ``learnable`` (over doc_id) holds; only their text and
    language count. Texts that are null, empty or without a letter are ``und`` with score 0, and so is every text when there
    is nothing to learn from. Rows without an id are judged but not learned from; repeated rows are each judged. An
    empty table gives no rows.
    """
    model = train(training_rows(docs, learnable, id_col, text_col, lang_col, per_language))

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            told, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t.decode("utf-8", "replace"))]
            for k in range(0, len(known), 64):
                some = known[k : k + 64]
                shares = model.pooled([texts[i] for i in some])
                for i, best, row in zip(some, shares.argmax(axis=1), shares):
                    told[i], score[i] = model.languages[best], min(1.0, float(row[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
