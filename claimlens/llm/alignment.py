"""Which tokens of one tokenizer stand where another one has which: links between two vocabularies, counted by document."""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import id_and_text, row_numbers, written
from claimlens.llm.tokens import LAST_SYMBOL, PIECE, WIDE, byte_signs, default_vocabulary, merged_count, read_merges

#: A container numbers at most so many documents, so that a place in it takes two bytes, ...
PLACES = 1 << 13
#: ... and is closed early when its documents hold so many postings.
POSTINGS = 1 << 20
BATCH_BYTES = 1 << 20
LONG_TEXT = 100_000
BITS = PLACES // 8
#: Groups of more links are worked out from the counts of their distinct tokens.
WIDE_GROUP = 1 << 12

_TABLE = (
    "container long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, documents long, links long, planes array<binary>"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_NAMES = [c.split()[0] for c in _TABLE.split(", ")]
_RESULT_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary file; special strings in a text are plain text.

    Texts are encoded by the engine that takes (bytes, rank) pairs, about five times as fast here as the one the file is made
    for; ``told`` checks what makes both give the same ids. Very long texts, whose runs of blanks the fast one does
    not survive, go through the other.
    """

    def __init__(self, file: bytes, ranks: dict[bytes, int], specials: dict[str, int]):
        self.file, self.slow = file, None
        self.fast = tiktoken.Encoding("byte-level", pat_str=PIECE, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max([*ranks.values(), *specials.values()]) + 1)
        for token, number in (*ranks.items(), *((s.encode(), k) for s, k in specials.items())):
            self.bytes_of[number] = token

    @staticmethod
    def told(path: str) -> tuple:
        """The arguments of a ``ByteLevel``, read from its file.

        Ids in the order of the merges, and no two merges of one result, make ids and ranks the same; and where every token, cut
        into its bytes, merges back to itself, no pair of symbols that spells a token can come about but by its own merge.
        """
        with open(path, "rb") as opened:
            file = opened.read()
        merges, specials = read_merges(path)
        signs, content = byte_signs(), json.loads(file)
        vocabulary = {bytes(signs[c] for c in token): k for token, k in content["model"]["vocab"].items() if token not in specials}
        made = sorted(merges.values())
        symbols = {k: bytes([k]) for k in range(256)}
        for pair, value in sorted(merges.items(), key=lambda m: m[1]):
            symbols.setdefault(value & LAST_SYMBOL, symbols[pair >> WIDE] + symbols[pair & LAST_SYMBOL])
        ids = [vocabulary.get(symbols[value & LAST_SYMBOL], -1) for value in made]
        if ids != sorted(set(ids)) or len(vocabulary) != 256 + len(ids) or any(merged_count(t, merges) != 1 for t in vocabulary):
            raise ValueError(f"{path}: tokens are not told by their merges alone")
        return file, vocabulary, {t["content"]: t["id"] for t in content["added_tokens"]}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._long(" " + t) if len(t) > LONG_TEXT else self.fast.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]

    def _long(self, text: str) -> np.ndarray:
        if self.slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.slow = tokenizers.Tokenizer.from_buffer(self.file)
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Tokenizer B: a sentence-piece model file, which puts a space before a text by itself."""

    def __init__(self, file: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.bytes_of = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            self.bytes_of.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("\u2581", " ").encode())

    @staticmethod
    def told(path: str) -> tuple:
        with open(path, "rb") as opened:
            return (opened.read(),)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.model.encode(texts, num_threads=1, return_type="numpy")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _flat(ids: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(ids).astype(np.int64)


class Aligner:
    """Aligns batches of texts; looks up what a token's bytes are and how an id is written."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.bytes_a, self.bytes_b = np.array(a.bytes_of, object), np.array(b.bytes_of, object)
        self.length_a = np.array([len(x) for x in a.bytes_of], np.int64)
        self.length_b = np.array([len(x) for x in b.bytes_of], np.int64)
        written_a = [str(k).encode() for k in range(len(a.bytes_of))]
        written_b = [str(k).encode() for k in range(len(b.bytes_of))]
        self.signs_a = np.array([x + end for x in written_a for end in (b",", b"|")], object)
        self.signs_b = np.array([x + end for x in written_b for end in (b",", b";")], object)

    def align(self, texts: list[str | None]):
        """Of every text (n_a, n_b, n_groups, n_links, groups_sha256), and the links of all as (pair, text, times), sorted by pair and text."""
        told = [t or "" for t in texts]
        ids_a, ids_b = self.a.encode(told), self.b.encode(told)
        good = []
        for text, a, b in zip(told, ids_a, ids_b):
            wanted = b" " + text.encode()
            good.append(bool(text) and b"".join(self.bytes_a[a].tolist()) == wanted and b"".join(self.bytes_b[b].tolist()) == wanted)
        none = (0, 0, 0, 0, "")
        kept = [k for k, ok in enumerate(good) if ok]
        if not kept:
            return [none] * len(texts), (np.zeros(0, np.int64),) * 3
        a, b = _flat([ids_a[k] for k in kept]), _flat([ids_b[k] for k in kept])
        n_a, n_b = (np.array([len(ids[k]) for k in kept], np.int64) for ids in (ids_a, ids_b))
        # Both cover the same bytes, so the texts can be laid end to end. Tokens without bytes (of no given vocabulary) stay
        # with the group before them: the last token to end at an offset ends the group.
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.zeros(end_a[-1] + 1, bool)
        ends[end_b] = True
        shared = end_a[ends[end_a] & np.append(end_a[1:] != end_a[:-1], True)]
        stop_a, stop_b = np.searchsorted(end_a, shared, "right"), np.searchsorted(end_b, shared, "right")
        start_a, start_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
        size_a, size_b = stop_a - start_a, stop_b - start_b
        text_stop = np.searchsorted(stop_a, np.cumsum(n_a), "right")  # groups up to the end of each text
        n_groups = np.diff(text_stop, prepend=0)
        text_of = np.repeat(np.arange(len(kept)), n_groups)
        n_links = np.bincount(text_of, weights=(size_a * size_b).astype(np.float64), minlength=len(kept))
        exact = n_links.astype(np.int64) if n_links.max() < 2**53 else np.array([int(np.dot(size_a[text_of == k], size_b[text_of == k])) for k in range(len(kept))])
        digests = self._digests(a, b, start_a, size_a, size_b, stop_a, stop_b, n_a + n_b)
        links = self._links(a, b, start_a, start_b, size_a, size_b, text_of)
        out = [none] * len(texts)
        for at, k in enumerate(kept):
            out[k] = (int(n_a[at]), int(n_b[at]), int(n_groups[at]), int(exact[at]), digests[at])
        return out, (links[0], np.array(kept)[links[1]], links[2])

    def _digests(self, a, b, start_a, size_a, size_b, stop_a, stop_b, n_tokens) -> list[str]:
        """Group by group A's ids, then B's: an id with its comma, or with the sign that ends its side of the group."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[stop_a - 1] = 1
        last_b[stop_b - 1] = 1
        signs = np.empty(len(a) + len(b), object)
        signs[np.arange(len(a)) + np.repeat(stop_b - size_b, size_a)] = self.signs_a[2 * a + last_a]
        signs[np.arange(len(b)) + np.repeat(stop_a, size_b)] = self.signs_b[2 * b + last_b]
        cuts = np.append(0, np.cumsum(n_tokens)).tolist()
        listed = signs.tolist()
        return [hashlib.sha256(b"".join(listed[x:y])[:-1]).hexdigest() for x, y in zip(cuts, cuts[1:])]

    def _links(self, a, b, start_a, start_b, size_a, size_b, text_of):
        product = size_a * size_b
        small = np.flatnonzero(product <= WIDE_GROUP)
        n = product[small]
        group = np.repeat(small, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs = [a[start_a[group] + at // size_b[group]] << 32 | b[start_b[group] + at % size_b[group]]]
        texts, times = [text_of[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(product > WIDE_GROUP).tolist():
            own_a, of_a = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
            own_b, of_b = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
            pairs.append((own_a[:, None] << 32 | own_b[None, :]).ravel())
            times.append((of_a[:, None] * of_b[None, :]).ravel())
            texts.append(np.full(len(pairs[-1]), text_of[g]))
        return summed(np.concatenate(pairs), np.concatenate(texts), np.concatenate(times))


def summed(pair: np.ndarray, place: np.ndarray, times: np.ndarray):
    """Sorted by pair and place, equal ones added up."""
    order = np.lexsort((place, pair))
    pair, place, times = pair[order], place[order], times[order]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (place[1:] != place[:-1]))) if len(pair) else np.zeros(0, np.int64)
    return pair[first], place[first], np.add.reduceat(times, first) if len(first) else times


def union(parts: list[bytes]) -> bytes:
    """The bitmaps of one container, given as lists of two-byte places, OR-merged: a list again, or a bit a place if that is
    not longer. The length tells which."""
    joined = b"".join(parts)
    if len(joined) < BITS:
        return joined
    flags = np.zeros(BITS, np.uint8)
    for part in parts:
        at = np.frombuffer(part, "<u2")
        np.bitwise_or.at(flags, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
    return flags.tobytes()


def places_of(bitmap: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8))) if len(bitmap) == BITS else np.frombuffer(bitmap, "<u2")


def popcount(bitmap: bytes) -> int:
    return int(np.bitwise_count(np.frombuffer(bitmap, np.uint8)).sum()) if len(bitmap) == BITS else len(bitmap) // 2


def held(planes: list[bytes]) -> int:
    """How many documents are in any of the planes: their union, counted."""
    if len(planes) == 1:
        return popcount(planes[0])
    flags = np.zeros(PLACES, bool)
    for plane in planes:
        flags[places_of(plane)] = True
    return int(np.count_nonzero(flags))


class Container:
    """The documents and postings of one range of document numbers, gathered by one task batch by batch."""

    def __init__(self):
        self.documents, self.postings, self.size = [], {}, 0

    def add(self, rows: list[tuple], pair: np.ndarray, place: np.ndarray, times: np.ndarray) -> None:
        """Plane k of a pair holds the documents in which bit k of the pair's number of links is set."""
        place = place + len(self.documents)
        self.documents += rows
        self.size += len(pair)
        for k in range(int(times.max()).bit_length() if len(times) else 0):
            of = np.flatnonzero(times >> k & 1)
            keys, body = pair[of], place[of].astype("<u2").tobytes()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else of
            stops = np.append(first[1:], len(keys))
            for key, x, y in zip(keys[first].tolist(), (2 * first).tolist(), (2 * stops).tolist()):
                planes = self.postings.setdefault(key, [])
                while len(planes) <= k:
                    planes.append([])
                planes[k].append(body[x:y])

    def batches(self, number: int):
        n = len(self.documents)
        empty = lambda count, kind: pa.nulls(count, kind)
        columns = list(zip(*self.documents)) if n else [[]] * 6
        kinds = [pa.int64()] * 5 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), pa.array(np.arange(n, dtype=np.int32)), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            + [empty(n, pa.int64())] * 3 + [empty(n, pa.list_(pa.binary()))],
            names=_NAMES,
        )
        keys = sorted(self.postings)
        for at in range(0, len(keys), 1 << 14):
            some = keys[at : at + (1 << 14)]
            planes = [[union(parts) for parts in self.postings[key]] for key in some]
            m = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number)), empty(m, pa.int32()), *(empty(m, t) for t in kinds), pa.array(some, pa.int64())]
                + [pa.array([held(p) for p in planes], pa.int64()), pa.array([sum(popcount(x) << k for k, x in enumerate(p)) for p in planes], pa.int64())]
                + [pa.array(planes, pa.list_(pa.binary()))],
                names=_NAMES,
            )


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their counts, and for each container of document numbers the postings of its pairs, written once.

    One table of two kinds of rows. Documents: (container, place) numbers them, with n_a, n_b, n_groups, n_links and
    groups_sha256. Postings (``pair`` is not null): a << 32 | b, the ``documents`` and ``links`` of the pair in this
    container, and ``planes``, the bitmaps they were counted from. A container is made by one task, so the bitmaps of a pair
    in different containers hold different documents, and no pair is larger anywhere than a container.
    """
    path_a, path_b = path_a or default_vocabulary(), path_b or default_model()
    shared = docs.sparkSession.sparkContext.broadcast((ByteLevel.told(path_a), Pieces.told(path_b)))  # vocabularies: of fixed size

    def run(batches):
        aligner = Aligner(ByteLevel(*shared.value[0]), Pieces(*shared.value[1]))
        numbers, now = row_numbers(), Container()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            start = 0
            while start < len(ids):
                room, some, size = PLACES - len(now.documents), [], 0
                while len(some) < room and start + len(some) < len(ids) and (not some or size < BATCH_BYTES):
                    text = texts[start + len(some)].as_py()
                    some.append(text.decode("utf-8", "replace") if text else "")
                    size += len(some[-1])
                facts, links = aligner.align(some)
                now.add([(key, *f) for key, f in zip(ids[start:], facts)], *links)
                start += len(some)
                if len(now.documents) >= PLACES or now.size >= POSTINGS:
                    yield from now.batches(next(numbers))
                    now = Container()
        if now.documents:
            yield from now.batches(next(numbers))

    return written(id_and_text(docs, id_col, text_col).mapInArrow(run, _TABLE), "alignment")


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, a, b, documents, links, best) of each id pair: in how many documents it is linked, how often, and whether no pair
    of the same ``a`` is linked in more documents."""
    counts = table.where("pair is not null").groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    counts = counts.withColumn("a", F.shiftright("pair", 32)).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select("pair", "a", "b", "documents", "links", (F.col("documents") == F.col("highest")).alias("best"))


def document_scores(table: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of ``aligned`` with n_best and count_sum: the counts of their links, handed out along the postings.

    A pair's count goes to the containers that hold it (at most one row a container, whatever the pair), and a container
    adds counts up by the places in its bitmaps.
    """
    asked = table.where("pair is not null").select(F.col("container").alias("of"), F.col("pair").alias("key"))
    given = counts.select(F.col("pair").alias("key"), F.col("documents").alias("count"), "best")
    told = asked.join(given, "key")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        is_pair = left["pair"].is_valid()
        documents, postings = left.filter(pa.compute.invert(is_pair)), left.filter(is_pair)
        best, total = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
        if len(postings):
            keys = right["key"].to_numpy()
            order = np.argsort(keys)
            at = order[np.searchsorted(keys, postings["pair"].to_numpy(), sorter=order)]
            lists = postings["planes"].combine_chunks()
            depth = np.diff(lists.offsets.to_numpy())
            plane = np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth)
            count = np.repeat(right["count"].to_numpy()[at], depth) << plane
            top = np.repeat(right["best"].to_numpy(zero_copy_only=False)[at].astype(np.int64), depth) << plane
            bitmaps = lists.flatten().to_pylist()
            short = np.array([len(b) != BITS for b in bitmaps])
            places = np.frombuffer(b"".join([b for b in bitmaps if len(b) != BITS]), "<u2")
            n = np.array([len(b) // 2 for b in bitmaps if len(b) != BITS], np.int64)
            np.add.at(total, places, np.repeat(count[short], n))
            np.add.at(best, places, np.repeat(top[short], n))
            for k in np.flatnonzero(~short).tolist():
                of = places_of(bitmaps[k])
                total[of] += count[k]
                best[of] += top[k]
        place = documents["place"].to_numpy()
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*(documents[c] for c in names), pa.array(best[place]), pa.array(total[place]), documents["groups_sha256"]], names=_RESULT_NAMES)

    return table.groupBy("container").cogroup(told.groupBy("of")).applyInArrow(score, _RESULT)


def alignment_scores(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Tokenizer A (``path_a``, a byte-level vocabulary file) reads a space and the text, tokenizer B (``path_b``, a
    sentence-piece model, which adds the space) the text; special strings in it are plain text. Byte offsets at which
    tokens of both end cut them into groups, and within a group every A token is linked with every B token. A pair of
    ids counts the documents that hold it linked, over the whole table; ``count_sum`` adds these counts over a row's links, and
    ``n_best`` says how many of the links no other B id of their A id beats, ties included.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and ''. Each
    row is a document: repeated rows and rows without an id all count. Texts of any length are taken whole; a task holds
    one of them, or a batch of short ones, at a time. Further columns are not looked at. An empty table gives no rows.
    """
    table = aligned(docs, path_a, path_b, id_col, text_col)
    return document_scores(table, pair_counts(table))
