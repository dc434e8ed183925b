"""Removal of repeated passages: a merged count-min sketch picks windows, a second pass groups them exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import id_and_text, mixed, row_numbers, written

SPAN = 20
CHUNK_BYTES = 4 << 20
SHARD_WINDOWS = 1 << 20
CELLS_PER_WINDOW = 4
ROWS = 2
LAST_ID = np.iinfo(np.int64).max
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def packed(array: np.ndarray) -> bytes:
    """Compressed with the bytes of equal rank side by side."""
    flat = np.ascontiguousarray(array)
    planes = flat.view(np.uint8).reshape(-1, flat.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of about 4 MB of documents: (chunk, n_windows, payload). A longer document is a chunk of its own."""

    def run(batches):
        numbers = row_numbers()

        def chunk(ids, texts):
            order = sorted(range(len(ids)), key=lambda i: LAST_ID if ids[i] is None else ids[i])
            texts = [texts[i] for i in order]
            known = np.array([ids[i] is not None for i in order], np.uint8)
            head = np.array([[0 if ids[i] is None else ids[i], len(t)] for i, t in zip(order, texts)], np.int64)
            windows = sum(max(0, len(t.split()) - SPAN + 1) for t in texts)
            raw = np.int64(len(texts)).tobytes() + head.tobytes() + known.tobytes() + b"".join(texts)
            data = zstandard.ZstdCompressor(level=3).compress(raw)
            return pa.RecordBatch.from_pydict(
                {"chunk": pa.array([next(numbers)], pa.int64()), "n_windows": pa.array([windows], pa.int64()), "payload": [data]}
            )

        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = t or b""
                if ids and held + len(t) > CHUNK_BYTES:
                    yield chunk(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t) + 16
        if ids:
            yield chunk(ids, texts)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "chunk long, n_windows long, payload binary")


class Chunk:
    """The words of a chunk's documents and the keys of their windows."""

    def __init__(self, payload: bytes):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        head = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
        self.known = np.frombuffer(raw, np.uint8, n, 8 + 16 * n).astype(bool)
        self.ids = head[:, 0]
        at, self.words = 8 + 17 * n, []
        for length in head[:, 1].tolist():
            self.words.append(raw[at : at + length].split())
            at += length
        self.counts = np.fromiter(map(len, self.words), np.int64, n)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the first word, two independent 64-bit keys) of each window; windows lie inside one document."""
        digest = xxhash.xxh3_128_digest
        lanes = np.frombuffer(b"".join([digest(w) for ws in self.words for w in ws]), "<u8").reshape(-1, 2)
        room = np.maximum(self.counts - SPAN + 1, 0)
        at = np.repeat(self.starts[:-1] - np.cumsum(room) + room, room) + np.arange(room.sum())
        keys = []
        for lane, base in enumerate(_ODD):
            sums, step = np.ascontiguousarray(lanes[:, lane]), 1
            with np.errstate(over="ignore"):
                powers = {1: sums}
                while 2 * step <= SPAN:
                    half = powers[step]
                    powers[2 * step] = half[: len(half) - step] + _power(base, step) * half[step:] if len(half) > step else half[:0]
                    step *= 2
                key, done = np.zeros(len(at), np.uint64), 0
                for size in sorted(powers, reverse=True):
                    while len(at) and done + size <= SPAN:
                        key += _power(base, done) * powers[size][at + done]
                        done += size
            keys.append(mixed(key))
        return at, keys[0], keys[1]


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def shards_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def cells_of(key: np.ndarray, row: int, shards: int, width: int) -> np.ndarray:
    """The cell of each key in a row of the sketch, numbered through all shards."""
    x = mixed(key, row + 1)
    inside = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(width)) >> np.uint64(32)
    return shards_of(x, shards) * width + inside.astype(np.int64)


def sketch_messages(chunks: DataFrame, shards: int, width: int) -> DataFrame:
    """Each chunk's sketch, sparse: per row and shard the cells its windows touch, sorted; twice, where two or more do."""

    def run(batches):
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(2)):
                _, *keys = Chunk(payload.as_py()).windows()
                out = {"target": [], "chunk": [], "cells": []}
                for row in range(ROWS):
                    cell = np.sort(cells_of(keys[row], row, shards, width))
                    third = np.zeros(len(cell), bool)
                    third[2:] = cell[2:] == cell[:-2]
                    cell = cell[~third]
                    for shard, some in _by_shard(cell, width):
                        out["target"].append(row * shards + shard)
                        out["chunk"].append(number)
                        out["cells"].append(packed(np.diff(some - shard * width, prepend=0).astype(np.uint32)))
                yield pa.RecordBatch.from_pydict(out, schema=message)

    message = pa.schema([("target", pa.int64()), ("chunk", pa.int64()), ("cells", pa.binary())])
    return chunks.mapInArrow(run, "target long, chunk long, cells binary")


def _by_shard(cell: np.ndarray, width: int):
    shard = cell // width
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for some in np.split(cell, cuts):
        if len(some):
            yield int(some[0] // width), some


def merged_sketch(messages: DataFrame, width: int) -> DataFrame:
    """The sketch, merged shard by shard, asked at once: for each chunk a bit a cell, set if its count is two or more."""

    def run(key, group):
        sent = [np.cumsum(unpacked(x.as_py(), "<u4"), dtype=np.int64) for x in group.column("cells")]
        counts = np.bincount(np.concatenate(sent), minlength=1)
        flags = []
        for cell in sent:
            cell = cell[np.concatenate([[True], cell[1:] != cell[:-1]])]
            flags.append(np.packbits(counts[cell] >= 2).tobytes())
        names = ["chunk", "target", "flags"]
        n = group.num_rows
        return pa.table([group.column("chunk"), pa.array([key[0].as_py()] * n, pa.int64()), pa.array(flags, pa.binary())], names=names)

    return messages.groupBy("target").applyInArrow(run, "chunk long, target long, flags binary")


def estimated_repeats(keys: list, flags: dict, shards: int, width: int) -> np.ndarray:
    """Which windows the sketch takes for repeated: all that are, and a few more."""
    guess = np.ones(len(keys[0]), bool)
    for row in range(ROWS):
        cell, at = np.unique(cells_of(keys[row], row, shards, width), return_inverse=True)
        bits = np.zeros(len(cell), bool)
        shard = cell // width
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, [s, s + 1])
            bits[a:b] = np.unpackbits(np.frombuffer(flags[row * shards + s], np.uint8), count=b - a)
        guess &= bits[at]
    return guess


def representatives(key: np.ndarray, key2: np.ndarray, guess: np.ndarray, shards: int):
    """Of the guessed windows: the first of each key within the chunk, ordered by shard and key; and all later ones."""
    some = np.flatnonzero(guess)
    a, b = key[some], (key2[some] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    order = np.lexsort((b, a, shards_of(a, shards)))  # stable: equal keys keep the order of documents and positions
    some, a, b = some[order], a[order], b[order]
    first = np.ones(len(some), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return some[first], a[first], b[first], some[~first]


def exact_messages(chunks: DataFrame, replies: DataFrame, shards: int, width: int) -> DataFrame:
    """Per chunk and shard the keys of the guessed windows, one a key, with the id of the document that has it first."""
    kind = pa.schema([("target", pa.int64()), ("chunk", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("ids", pa.binary())])

    def run(left, right):
        out = {name: [] for name in kind.names}
        flags = dict(zip(right.column("target").to_pylist(), right.column("flags").to_pylist()))
        for number, payload in zip(left.column("chunk").to_pylist(), left.column("payload")):
            chunk = Chunk(payload.as_py())
            at, *keys = chunk.windows()
            if not len(at):
                continue
            some, a, b, _ = representatives(keys[0], keys[1], estimated_repeats(keys, flags, shards, width), shards)
            ids = np.where(chunk.known, chunk.ids, LAST_ID)
            doc = ids[np.searchsorted(chunk.starts, at[some], side="right") - 1]
            shard = shards_of(a, shards)
            for s in np.unique(shard).tolist():
                x, y = np.searchsorted(shard, [s, s + 1])
                out["target"].append(s)
                out["chunk"].append(number)
                out["high"].append(packed(np.diff(a[x:y], prepend=np.uint64(0))))
                out["low"].append(packed(b[x:y]))
                out["ids"].append(packed(doc[x:y]))
        return pa.Table.from_pydict(out, schema=kind)

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        run, "target long, chunk long, high binary, low binary, ids binary"
    )


def exact_groups(messages: DataFrame) -> DataFrame:
    """Groups equal windows of all chunks; for each chunk a bit a key, set if another place has it first."""

    def run(key, group):
        high = [np.cumsum(unpacked(x.as_py(), "<u8"), dtype=np.uint64) for x in group.column("high")]
        sizes = [len(x) for x in high]
        chunk = np.repeat(np.array(group.column("chunk").to_pylist(), np.int64), sizes)
        low = np.concatenate([unpacked(x.as_py(), "<u4") for x in group.column("low")])
        ids = np.concatenate([unpacked(x.as_py(), "<i8") for x in group.column("ids")])
        high = np.concatenate(high)
        order = np.lexsort((chunk, ids, low, high))
        later = np.zeros(len(order), bool)
        later[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
        flags = [np.packbits(x).tobytes() for x in np.split(later, np.cumsum(sizes)[:-1])]
        names = ["chunk", "target", "flags"]
        n = group.num_rows
        return pa.table([group.column("chunk"), pa.array([key[0].as_py()] * n, pa.int64()), pa.array(flags, pa.binary())], names=names)

    return messages.groupBy("target").applyInArrow(run, "chunk long, target long, flags binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs``.

    ``kept`` is the text without each word that lies in a window of 20 words that also starts earlier: in a document of
    smaller id, or earlier in the same document. Windows are compared by 96 bits of two independent hashes of their words.
    Null and empty texts have no words and an empty ``kept``. Rows without an id come after all others; of rows with
    one id, the one stored first counts as earlier. An empty table gives no rows.

    The sketch has two rows of ``CELLS_PER_WINDOW`` cells a window, cut into shards of about a million windows, so that no task
    holds more than a shard or a chunk however large the corpus is. Merged counts are never too small: no
    repeated window is lost.
    """
    chunks = written(pack_chunks(docs, id_col, text_col), "chunks")
    total = chunks.agg(F.sum("n_windows")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WINDOWS))
    width = CELLS_PER_WINDOW * min(SHARD_WINDOWS, max(1, total))
    asked = written(merged_sketch(sketch_messages(chunks, shards, width), width), "sketch-replies")
    told = written(exact_groups(exact_messages(chunks, asked, shards, width)), "window-replies")
    replies = asked.withColumn("step", F.lit(0)).unionByName(told.withColumn("step", F.lit(1)))
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(left, right):
        out = {name: [] for name in kind.names}
        flags = ({}, {})
        for step, target, bits in zip(*(right.column(c).to_pylist() for c in ("step", "target", "flags"))):
            flags[step][target] = bits
        for payload in left.column("payload"):
            chunk = Chunk(payload.as_py())
            at, *keys = chunk.windows()
            cover = np.zeros(int(chunk.starts[-1]) + 1, np.int64)
            if len(at):
                some, a, _, later = representatives(keys[0], keys[1], estimated_repeats(keys, flags[0], shards, width), shards)
                shard = shards_of(a, shards)
                for s in np.unique(shard).tolist():
                    x, y = np.searchsorted(shard, [s, s + 1])
                    bits = np.unpackbits(np.frombuffer(flags[1][s], np.uint8), count=y - x).astype(bool)
                    later = np.concatenate([later, some[x:y][bits]])
                np.add.at(cover, at[later], 1)
                np.add.at(cover, at[later] + SPAN, -1)
            gone = np.cumsum(cover) > 0
            for k, words in enumerate(chunk.words):
                mark = gone[chunk.starts[k] : chunk.starts[k + 1]]
                n = int(mark.sum())
                kept = words if not n else [w for w, g in zip(words, mark.tolist()) if not g]
                out["doc_id"].append(int(chunk.ids[k]) if chunk.known[k] else None)
                out["n_words"].append(len(words))
                out["n_removed"].append(n)
                out["kept"].append(b" ".join(kept))
        out["kept"] = pa.array(out["kept"], pa.binary()).cast(pa.string())
        return pa.Table.from_pydict(out, schema=kind)

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string"
    )
