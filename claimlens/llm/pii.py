"""Personal data by fixed rules, and unseen identifiers by lexical patterns that the rules' finds induce."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import row_numbers, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.8
MIN_SUPPORT = 5

_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMERIC = re.compile(r"[0-9+][\x20().0-9+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may be an identifier: a run of such signs with four digits or an @.
_TOKEN = re.compile(r"[A-Za-z0-9@._%+/#-]+")
#: Or, before that, groups of digits one to three such signs apart, if no run goes on at either end.
_GROUPS = r"(?<![A-Za-z0-9@._%+/#-])[+(]?[0-9]++(?:[\x20()./-]{1,3}+[0-9]++)+(?![A-Za-z0-9@_%+#]|[./-][A-Za-z0-9])"
_CANDIDATE = re.compile(rf"({_GROUPS})|{_TOKEN.pattern}")
#: A phone or card number has so many digits; longer rows of groups are no single number, and each run counts alone.
GROUP_DIGITS = range(7, 20)
_LEXEME = re.compile(r"\w+|[^\w\s]")
#: Longer instances and lexemes are known by their digest.
NAME_CHARS = 64


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if "0" <= c <= "9"]


def passes_luhn(digits: list[int]) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(2 * d - 9 * (d > 4) for d in even)) % 10 == 0


def _emails(text: str):
    if "@" not in text:
        return
    for run in _RUN.finditer(text):
        start, part = run.start(), run.group()
        at, pos = part.find("@"), 0
        while at >= 0:
            # Of the places before an @ the leftmost matches if any does.
            found = _EMAIL.match(part, pos) if at > pos else None
            if found:
                yield start + found.start(), start + found.end()
            pos = found.end() if found else at + 1
            at = part.find("@", pos)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed rules find, in order; kinds are numbers in ``KINDS``."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for region in _NUMERIC.finditer(text):
        part, at = region.group(), region.start()
        if len(part) < 7:
            continue
        if part.count(".") >= 3:
            for m in _IP.finditer(part):
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
                    out.append((at + m.start(), 1, at + m.end()))
        if len(part) >= 12:
            for m in _CARD.finditer(part):
                if m.end() - m.start() >= 12:
                    digits = _digits(m.group())
                    if 12 <= len(digits) <= 19 and passes_luhn(digits):
                        out.append((at + m.start(), 2, at + m.end()))
        if "+" in part:
            for m in _PHONE.finditer(part):
                if 9 <= len(_digits(m.group())) <= 15:
                    out.append((at + m.start(), 3, at + m.end()))
    return sorted(out)


def named(text: str) -> str:
    """``text``, or its digest if it is long: graph rows stay small and no instance is left out."""
    return text if len(text) <= NAME_CHARS else "sha256 " + hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _before(text: str, start: int) -> list[str]:
    """The two lexemes before a place, whole, however far back they begin."""
    reach = 48
    while True:
        left = max(0, start - reach)
        found = list(_LEXEME.finditer(text, left, start))[-2:]
        if not left or (len(found) == 2 and found[0].start() > left):
            return [m.group() for m in found]
        reach *= 2


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: the two lexemes before it, and the lexemes on both sides. Digits count alike."""
    plain = [named(re.sub(r"\d", "0", x.lower())) for x in _before(text, start)]
    after = _LEXEME.search(text, end)
    out = []
    if len(plain) == 2:
        out.append("before " + " ".join(plain))
    if plain and after:
        out.append(f"around {plain[-1]} {named(re.sub(r'\d', '0', after.group().lower()))}")
    return out


def _gaps(base: list, size: int):
    """The stretches of a text that no base span covers."""
    at = 0
    for a, b in sorted((a, b) for a, _, b in base):
        if a > at:
            yield at, a
        at = max(at, b)
    if at < size:
        yield at, size


def _runs(text: str, start: int, stop: int):
    """(start, end) of what may be an identifier: groups of digits that make up one number, else runs of signs."""
    for m in _CANDIDATE.finditer(text, start, stop):
        if not m.group(1):
            yield m.span()
        elif sum("0" <= c <= "9" for c in m.group()) in GROUP_DIGITS:
            open_only = m.group().startswith("(") and ")" not in m.group()
            yield m.start() + open_only, m.end()
        else:
            yield from (t.span() for t in _TOKEN.finditer(text, *m.span()))


def occurrences(text: str, base: list) -> list[tuple]:
    """(start, end, kind or None, instance, patterns) of the base spans and of the candidates that touch none of them."""
    out = [(a, b, kind, named(text[a:b]), contexts(text, a, b)) for a, kind, b in base]
    for left, right in _gaps(base, len(text)) if any(c in text for c in "0123456789@") else ():
        for a, b in _runs(text, left, right):
            if (a == left and a > 0) or (b == right and b < len(text)):
                continue  # the rest of a run that a base span is part of
            found = text[a:b].rstrip(".-/%")
            if sum("0" <= c <= "9" for c in found) >= 4 or "@" in found[1:-1]:
                out.append((a, a + len(found), None, named(found), contexts(text, a, a + len(found))))
    return out


_PLACE = pa.struct(
    [("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]
)
_PLACES = "array<struct<start:long,stop:long,kind:int,instance:string,patterns:array<string>>>"


def marked(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """(row, doc_id, kept, places) of every document, written once; ``kept`` holds the columns ``keep`` as they are."""
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(0).alias("_"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), kept.alias("kept"))

    def run(batches):
        numbers = row_numbers()
        for batch in batches:
            places = []
            for text in batch.column(1).to_pylist():
                found = occurrences(text, base_spans(text)) if text else []
                places.append([dict(zip(("start", "stop", "kind", "instance", "patterns"), x)) for x in found])
            number = pa.array([next(numbers) for _ in places], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [number, batch.column(0), batch.column(2), pa.array(places, pa.list_(_PLACE))], names=["row", "doc_id", "kept", "places"]
            )

    kind = rows.schema["kept"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"row long, doc_id long, kept {kind}, places {_PLACES}"), "marked")


def trusted_patterns(places: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that single out one kind, from the pattern-instance graph.

    Each round scores a pattern by the mean score of its distinct instances for a kind, and an instance by the noisy
    or of its patterns; instances of the fixed rules score 1 for their kind. A pattern is trusted from ``MIN_SUPPORT``
    instances and ``MIN_CONFIDENCE``. All occurrences count; joins are on patterns and on instances, after both
    are made distinct.
    """
    edges = places.select("instance", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    edges = written(edges, "pattern-graph")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    graph = edges.select("pattern", "instance")
    known, trusted = seeds, None
    for _ in range(rounds):
        scores = graph.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        trusted = written(
            scores.where(F.col("mass") >= MIN_SUPPORT)
            .join(sizes, "pattern")
            .select("pattern", "kind", (F.col("mass") / F.col("n")).alias("confidence"))
            .where(F.col("confidence") >= MIN_CONFIDENCE),
            "trusted-patterns",
        )
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        found = edges.where("kind is null").select("pattern", "instance").join(trusted, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("score"))
        known = seeds.unionByName(found)
    return trusted


def annotated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, kept, base, spans) of every row of ``docs``; both arrays of (start, kind, stop, by_rule), in order.

    ``base`` is what the fixed rules find: emails, addresses, card and phone numbers, leftmost and not overlapping within a
    kind. ``spans`` adds identifiers that no rule covers but that stand where trusted patterns expect their kind: runs of signs with four
    digits or an @, of any length, and numbers of 7 to 19 digits in groups, such as (603) 555-8791, as a whole.
    Offsets are code points, stops exclusive. Null and empty texts have no spans. Rows without an id, repeated rows
    and rows that share an id are each returned. An empty table gives no rows.
    """
    rows = marked(docs, id_col, text_col, keep or [])
    places = rows.select("row", F.explode("places").alias("p")).select("row", "p.*")
    trusted = trusted_patterns(places)
    new = places.where("kind is null").select("row", "start", "stop", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    best = new.groupBy("row", "start", "stop").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("best"))
    span = F.struct(F.col("start"), (-F.col("best.k")).cast("int").alias("kind"), F.col("stop"), F.lit(False).alias("by_rule"))
    added = best.groupBy("row").agg(F.collect_list(span).alias("added"))
    base = F.transform(
        F.filter("places", lambda p: p["kind"].isNotNull()),
        lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["stop"].alias("stop"), F.lit(True).alias("by_rule")),
    )
    based = rows.select("row", "doc_id", "kept", F.array_sort(base).alias("base"))
    return based.join(added, "row", "left").select(
        "doc_id", "kept", "base", F.array_sort(F.concat("base", F.coalesce("added", F.slice("base", 1, 0)))).alias("spans")
    )


def count_of(spans: str, kind: int) -> Column:
    """How many of the spans are of the kind. The test takes one argument: a second one would be given the span's place."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: str):
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")))
    )


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, overlapping ones together, replaced by the name of its first kind."""
    out, at = [], 0
    for start, kind, stop in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with personal data in the text replaced by [EMAIL], [IP], [CARD] and [PHONE]."""
    found = annotated(docs, id_col, text_col, docs.columns)
    at = docs.columns.index(text_col)
    columns = [F.col("kept")[c].alias(c) for c in docs.columns]

    def run(batches):
        for batch in batches:
            *cols, spans = batch.columns
            texts = [
                mask(t, [(s["start"], s["kind"], s["stop"]) for s in p]) if p and t else t
                for t, p in zip(cols[at].to_pylist(), spans.to_pylist())
            ]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return found.select(*columns, F.col("spans").alias("_spans_")).mapInArrow(run, docs.schema)
