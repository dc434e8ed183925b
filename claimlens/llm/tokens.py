"""How many tokens a text has in a byte-level byte-pair vocabulary, by merging alone: no identifiers are made."""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from claimlens.llm.common import id_and_text

LIMIT = 512
#: Counts of pieces that a task remembers; the store is emptied when it is full, which costs time and changes nothing.
REMEMBERED = 200_000
LONG_TEXT = 1 << 20
WIDE, PLACES = 20, 40
LAST_SYMBOL, LAST_PLACE = (1 << WIDE) - 1, (1 << PLACES) - 1
#: How byte-level vocabularies cut a text into pieces before merging (fixed value).
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte: printable Latin-1 signs for themselves, the others by the next free sign from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def read_merges(path: str) -> tuple[dict[int, int], list[str]]:
    """(merges, special strings) of a vocabulary file; refuses what merging would not count right.

    Symbols are numbers: the bytes, then what merges make. A pair (a, b) is the key a << WIDE | b, and its value is
    rank << WIDE | the merged symbol, so that values compare by rank.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cut = told["model"], told["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(k)]
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or told["normalizer"] or odd:
        raise ValueError(f"{path} is not a plain byte-level byte-pair vocabulary: {odd or cut or told['normalizer']}")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in told["added_tokens"]):
        raise ValueError(f"{path} has special strings with conditions")
    signs = byte_signs()
    plain = lambda symbol: bytes(signs[c] for c in symbol)
    merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    number = {bytes([k]): k for k in range(256)}
    ranks: dict[int, int] = {}
    for rank, pair in enumerate(merges):
        a, b = map(plain, pair)
        made = number.setdefault(a + b, len(number))
        ranks[number[a] << WIDE | number[b]] = rank << WIDE | made
    return ranks, [t["content"] for t in told["added_tokens"]]


def merged_count(piece: bytes, ranks: dict[int, int]) -> int:
    """Symbols left of a piece when no pair of neighbours merges any more.

    A heap gives the pair of lowest rank, leftmost first; a linked list of the symbols says who its neighbours are. A
    pair on the heap that has changed since is passed over. n log n, whatever the piece looks like.
    """
    n, get = len(piece), ranks.get
    symbol = list(piece)
    heap = [found << PLACES | k for k in range(n - 1) if (found := get(symbol[k] << WIDE | symbol[k + 1])) is not None]
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        first = heappop(heap)
        left, merge = first & LAST_PLACE, first >> PLACES
        right = after[left]
        if symbol[left] < 0 or right >= n or get(symbol[left] << WIDE | symbol[right]) != merge:
            continue
        symbol[left] = made = merge & LAST_SYMBOL
        symbol[right] = -1
        merges += 1
        after[left] = beyond = after[right]
        if beyond < n:
            before[beyond] = left
            if (found := get(made << WIDE | symbol[beyond])) is not None:
                heappush(heap, found << PLACES | left)
        ahead = before[left]
        if ahead >= 0 and (found := get(symbol[ahead] << WIDE | made)) is not None:
            heappush(heap, found << PLACES | ahead)
    return n - merges


class _Pieces(dict):
    """Counts of pieces by their text, worked out when first asked for."""

    def __init__(self, ranks: dict):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        found = merged_count(piece.encode(), self.ranks)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = found
        return found


class Counter:
    """Token counts of texts; pieces seen before are remembered."""

    def __init__(self, ranks: dict, specials: list[str]):
        self.known, self.pieces = _Pieces(ranks), regex.compile(PIECE)
        longest = sorted(filter(None, specials), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if longest else None

    def _plain(self, text: str) -> int:
        if len(text) > LONG_TEXT:  # its pieces one after the other, never all at once
            return sum(self.known[m.group()] for m in self.pieces.finditer(text))
        return sum(map(self.known.__getitem__, self.pieces.findall(text)))

    def count(self, text: str) -> int:
        if not self.specials:
            return self._plain(text)
        total, start = 0, 0
        for special in self.specials.finditer(text):
            total += self._plain(text[start : special.start()]) + 1
            start = special.end()
        return total + self._plain(text[start:] if start else text)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: bytes of the text in UTF-8, its tokens, and whether they exceed ``limit``.

    ``path`` names a byte-level byte-pair vocabulary (default: the public one of 50,257 tokens); it is read by the driver
    and its merges, a table of fixed size, go to the executors. Special strings of the vocabulary inside a text are one
    token each; none are added. Null and empty texts have no tokens. Texts of any length are counted whole; a piece
    without a break takes memory for its own symbols only. Rows without an id and repeated rows are each returned; further columns
    are not looked at; an empty table gives no rows. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_merges(path or default_vocabulary()))

    def run(batches):
        counter = Counter(*shared.value)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            counts = [counter.count(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
