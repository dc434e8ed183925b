"""Near duplicates by SimHash fingerprints and distances to reference fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import row_numbers, written
from claimlens.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
WIDE_REFERENCES = 8
HOT_BUCKET = 4096
SLICE = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a whole text, signed. Without a word: 0; with fewer than three, of all of them."""
    words = text.lower().split() if text else []  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    span = min(SHINGLE, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - span + 1]
    ends = ends[span - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, len(starts), SLICE):
        some = zip(starts[k : k + SLICE].tolist(), ends[k : k + SLICE].tolist())
        got = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in some]), np.uint8)
        ones += np.unpackbits(got.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, doc_id, bits, kept) of every row, written once; null and empty texts have the fingerprint 0.

    ``row`` tells rows apart; ``kept`` holds the columns ``keep``.
    """
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), kept.alias("kept"))

    def run(batches):
        numbers = row_numbers()
        for batch in batches:
            bits = [fingerprint(t.as_py()) for t in batch.column(1)]
            row = pa.array([next(numbers) for _ in bits], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [row, batch.column(0), pa.array(bits, pa.int64()), batch.column(2)], names=["row", "doc_id", "bits", "kept"]
            )

    kind = rows.schema["kept"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"row long, doc_id long, bits long, kept {kind}"), "fingerprints")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """The 64 bits cut into blocks of nearly equal length."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def references(n: int = WIDE_REFERENCES) -> list[int]:
    """Wide reference fingerprints: half of the bits set, drawn once and for all."""
    draw = np.random.default_rng(7)
    out = []
    for _ in range(n):
        bits = draw.permutation(64)[:32]
        out.append(sum(1 << int(b) for b in bits))
    return out


def pivot_table(marks: DataFrame) -> DataFrame:
    """Distances of distinct fingerprints to the references, and the buckets that follow from them.

    The block references are the fingerprint 0 and, for each bit, the fingerprint with this bit alone. Against 0 they
    put a fingerprint one nearer or one farther, so the signs of these coordinate differences inside a block tell its
    bits. Two fingerprints within three bits of each other have equal coordinates in at least three of the six blocks:
    one row for each choice of three blocks, whose key holds the coordinates of those blocks, brings every such pair
    together. ``pivots`` packs the distances to the wide references, seven bits each.
    """
    bits = F.col("bits")
    pivots = F.lit(0).cast("long")
    for k, r in enumerate(references()):
        pivots = pivots + F.shiftleft(F.bit_count(bits.bitwiseXOR(F.lit(_signed(r)))).cast("long"), 7 * k)
    keys = []
    for n, chosen in enumerate(combinations(block_masks(), BLOCKS - MAX_BITS)):
        mask = sum(chosen)
        keys.append(F.xxhash64(bits.bitwiseAND(F.lit(_signed(mask))), F.lit(n)))
    return marks.select("bits", pivots.alias("pivots"), F.explode(F.array(*keys)).alias("bucket"))


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of ``a[i]`` and ``b[i]``; labels stay flat: each is the smallest index of its group."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def links_in_runs(bucket: np.ndarray, part: np.ndarray, bits: np.ndarray, pivots: np.ndarray, max_bits: int = MAX_BITS):
    """Star edges that connect the same fingerprints as all links within the runs of equal (bucket, part)."""
    order = np.lexsort((bits, part, bucket))
    bucket, part, bits, pivots = bucket[order], part[order], bits[order], pivots[order]
    if len(bits) < 2:
        return bits[:0], bits[:0]
    first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])]))
    length = np.diff(np.concatenate([first, [len(bits)]]))
    stop = np.repeat(first + length, length)
    nodes, node = np.unique(bits, return_inverse=True)
    label = np.arange(len(nodes))
    shifts = np.arange(WIDE_REFERENCES, dtype=np.int64) * 7
    at = np.arange(len(bits))
    step = 1
    while True:
        at = at[at + step < stop[at]]
        if not len(at):
            break
        i = at[label[node[at]] != label[node[at + step]]]
        if len(i):
            near = np.ones(len(i), bool)
            for s in shifts:  # the largest coordinate difference bounds the distance from below
                near &= np.abs(((pivots[i] >> s) & 127) - ((pivots[i + step] >> s) & 127)) <= max_bits
            i = i[near]
            i = i[np.bitwise_count((bits[i] ^ bits[i + step]).view(np.uint64)) <= max_bits]
            if len(i):
                unite(label, node[i], node[i + step])
        step += 1
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def fingerprint_links(marks: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect whatever links at three or fewer bits connect.

    Buckets of more than ``HOT_BUCKET`` fingerprints are cut into slices, and each pair of slices is compared in a
    place of its own.
    """
    rows = pivot_table(marks)
    hot = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET)
    slices = F.ceil(F.col("n") / F.lit(HOT_BUCKET // 2)).cast("int")
    own = F.pmod(F.xxhash64("bits", F.lit(1)), F.coalesce(slices, F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(slices, F.lit(1)) - 1))
    dealt = rows.join(hot, "bucket", "left").select("bucket", "bits", "pivots", own.alias("own"), other.alias("other"))
    dealt = dealt.select(
        "bucket", (F.least("own", "other").cast("long") * (1 << 31) + F.greatest("own", "other")).alias("part"), "bits", "pivots"
    )

    def run(batches):
        held, carried = [], None
        for batch in batches:  # sorted by bucket and part: what may go on in the next batch is carried over
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if carried is not None:
                cols = [np.concatenate(x) for x in zip(carried, cols)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            carried = [c[last] for c in cols]
            held.append(links_in_runs(*(c[~last] for c in cols)))
            if len(held) >= 64:
                held = [_forest(held)]
        if carried is not None:
            held.append(links_in_runs(*carried))
        if held:
            a, b = _forest(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    placed = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return placed.mapInArrow(run, "a long, b long")


def _forest(found: list) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    unite(label, at[: len(a)], at[len(a) :])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def classes(marked: DataFrame) -> DataFrame:
    """(bits, component_id, row) of each distinct fingerprint: the smallest id of its component, and the row to keep of it."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    nodes = written(marked.groupBy("bits").agg(first.alias("first")), "fingerprint-nodes")
    found = components(fingerprint_links(nodes)).select(F.col("node").alias("bits"), "root")
    rooted = nodes.join(found, "bits", "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    joined = rooted.join(least, "root").select("bits", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("row"))
    return written(joined, "fingerprint-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bits, component_id) of every row of ``docs``.

    Documents whose fingerprints differ in three or fewer bits are linked; component_id is the smallest doc_id that links
    lead to. Null and empty texts share the fingerprint 0 and are linked like any other; equal fingerprints are one
    node, so thousands of copies cost one row. Rows without an id keep their row; their component counts the ids of
    the others, and is null if there is none. Repeated rows are all returned. An empty table gives no rows.
    """
    marked = fingerprints(docs, id_col, text_col)
    return marked.select("doc_id", "bits").join(classes(marked).drop("row"), "bits", "left").select("doc_id", "bits", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: the one of the smallest id, ids before none."""
    marked = fingerprints(docs, id_col, text_col, docs.columns)
    return marked.join(classes(marked).select("row").distinct(), "row", "left_semi").select("kept.*")
