"""Each operator against a brute-force version on a small fixture with odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm import decontaminate, language, mixing, neighbours, pii, quality, queries, simhash, substring, toxicity, warc
from claimlens.llm.common import fold

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("kept", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("bits", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n, seed):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(["ka", "lo", "mi", "re", "tu", "sha", "ven"], 3)) for _ in range(n))


def documents(spark, texts):
    rows = []
    for i, text in enumerate(texts):
        key, text, source = text if isinstance(text, tuple) else (i, text, f"s{i % 4}")
        rows.append((key, text, "xx", source, len(text or ""), "x", 1, "y", "z", "w"))
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    passage, base = words(30, 1), words(60, 2)
    return [
        words(40, 3) + " " + passage,
        passage + " " + words(25, 4),
        base,
        base,
        base + " more",
        base.replace(" ", "\n\t", 3),
        (7, words(25, 5) + " " + passage, None),
        (7, words(25, 5) + " " + passage, None),
        (None, passage + " " + passage, "s1"),
        (None, None, None),
        (20, None, "s1"),
        (21, "", "s2"),
        (22, "\x0b\x0c \r\n", "s2"),
        (23, "one", "s0"),
        (24, "a\x1cb c   d", "s0"),
        (25, "ka " * 70, "s3"),
        (26, words(9000, 6), "s3"),
        (-5, base.upper(), "s3"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_texts())


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def split(text):
    return WORD.findall(text or "")


# substring dedup


def brute_removal(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        ws = split(rows[i][1])
        gone = [False] * len(ws)
        for k in range(len(ws) - 19):
            window = tuple(ws[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        out[i] = (len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g))
    return sorted(((rows[i][0], *out[i]) for i in order), key=repr)


def test_substring_removal(odd, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.coalesce(1).collect()]
    found = substring.remove_repeats(odd.coalesce(1))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_removal(rows)


def test_substring_removal_over_many_chunks_and_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(substring, "SHARD_WINDOWS", 9_000)
    monkeypatch.setattr(substring, "CELLS_PER_WINDOW", 1)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = substring.remove_repeats(docs.repartition(3))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_removal(rows)


def test_sketch_never_underestimates():
    draw = np.random.default_rng(1)
    key = draw.integers(0, 1 << 63, 500).astype(np.uint64)
    key = np.concatenate([key, key[:50]])
    for row in range(substring.ROWS):
        cells = substring.cells_of(key, row, 3, 1 << 12)
        counts = np.bincount(cells)
        assert (counts[cells[:50]] >= 2).all()


# SimHash


def brute_fingerprint(text):
    ws = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(ws[k : k + 3]) for k in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[top(i)] = top(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [least.get(top(i)) for i in range(len(ids))]


def test_simhash_odd_rows(odd):
    rows = odd.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    component = brute_components([r.doc_id for r in rows], prints)
    found = simhash.near_duplicates(odd).collect()
    expected = sorted(((r.doc_id, p - (1 << 64) * (p >> 63), c) for r, p, c in zip(rows, prints, component)), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == expected


def test_simhash_query_on_given_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    component = brute_components([r.doc_id for r in rows], prints)
    expected = {(r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, component)}
    assert {tuple(r) for r in queries.op2_simhash(spark, sf_dir).collect()} == expected


def test_every_pair_within_three_bits_is_linked(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_BUCKET", 40)
    draw = np.random.default_rng(4)
    prints = [int(x) for x in draw.integers(-(1 << 62), 1 << 62, 40)]
    for p in list(prints):
        for n in (1, 2, 3, 4):
            flip = sum(1 << int(b) for b in draw.choice(62, n, replace=False))
            prints.append(p ^ flip)
    prints += [prints[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]  # a crowd in few buckets
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(p,) for p in prints], "bits long")
    found = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(nodes)).collect()}
    expected = brute_components(list(range(len(prints))), [p & ((1 << 64) - 1) for p in prints])
    groups = {}
    for p, c in zip(prints, expected):
        groups.setdefault(c, set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_keep_one_keeps_the_smallest_of_each_group(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    component = {r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert ids == sorted(component, key=lambda x: (x is None, x))


def test_component_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(chain).collect()}
    assert all(found[k] == 0 for k in range(61)) and found[101] == found[100] == 100


# mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**stopped, **share}
        stopped.update({s: 3.0 * sizes[s] for s in over})


def check_mix(rows, texts):
    sizes = {}
    for key, text, source in texts:
        sizes[source] = sizes.get(source, 0) + len(split(text))
    targets = brute_targets(sizes)
    wanted = sorted((repr(k), len(split(t)), sizes[s], round(targets[s], 6)) for k, t, s in texts)
    assert sorted((repr(r.doc_id), r["size"], r.source_size, round(r.target, 6)) for r in rows) == wanted
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    taken = {}
    for r in rows:
        taken[round(r.target, 6), r.source_size] = taken.get((round(r.target, 6), r.source_size), 0) + r.taken
    by_key = {}
    for s in sizes:
        by_key.setdefault((round(targets[s], 6), sizes[s]), []).append(s)
    for key, got in taken.items():
        # a shard strays by less than a slot, so a source by a few blocks
        assert abs(got - key[0] * len(by_key[key])) <= 10 * mixing.BLOCK * len(by_key[key])


def test_mix_odd_rows(odd):
    texts = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    first = mixing.mix(odd).collect()
    check_mix(first, texts)
    assert sorted(map(repr, first)) == sorted(map(repr, mixing.mix(odd.repartition(5)).collect()))


def test_mix_given_documents_over_lanes_and_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "LANE_ROWS", 30)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 64)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_mix_shares_of_many_small_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 256)
    texts = [(k, "lo " * 250, f"a{k % 2}") for k in range(600)]  # two large sources
    texts += [(1000 + k, words(20, 1000 + k), f"t{k:04d}") for k in range(400)]
    texts += [(2000 + k, words(n, 2000 + k), f"u{k:04d}") for k, n in enumerate([10, 33, 70] * 20)]
    docs = documents(spark, texts)
    taken, sizes, targets, source_of = {}, {}, {}, {k: s for k, _, s in texts}
    for r in mixing.mix(docs).collect():
        source = source_of[r.doc_id]
        taken[source], sizes[source] = taken.get(source, 0) + r.taken, r.source_size
        targets[source] = r.target
    stopped = [s for s in targets if targets[s] == 3 * sizes[s]]
    assert len(stopped) > 400 and all(taken[s] == targets[s] for s in stopped)
    assert all(abs(taken[s] - targets[s]) <= 0.01 * targets[s] for s in ("a0", "a1"))
    assert abs(sum(taken.values()) - sum(targets.values())) <= 0.005 * sum(targets.values())


def test_draws_are_multinomial_and_end_at_the_quotas(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 100)
    quotas = [9000, 8000, 2500, 400, 99, 1]
    rows = [(p, 4000 if p < 2 else max(1, -(-q // 3)), q, sum(quotas[:p])) for p, q in enumerate(quotas)]
    targets = spark.createDataFrame(rows, "place int, blocks long, quota long, low long")
    counts = {(r.shard, r.place): r.n for r in mixing.drawn_counts(targets).collect()}
    for shard in range(200):
        assert sum(counts.get((shard, p), 0) for p in range(6)) == 100
    for p, share in ((0, 0.45), (1, 0.4), (2, 0.125)):
        seen = [counts.get((shard, p), 0) for shard in range(200)]
        assert abs(sum(seen) / 200 - 100 * share) < 2.5
        # the spread of a multinomial, which even dealing would not have
        assert 0.6 < np.var(seen) / (100 * share * (1 - share)) < 1.5
    slots = mixing.drawn_slots(targets).collect()
    assert sorted(Counter(r.place for r in slots).items()) == list(enumerate(quotas))
    blocks = {p: b for p, b, _, _ in rows}
    times = Counter((r.place, r.block) for r in slots)
    assert all(0 <= b < blocks[p] and n <= 3 for (p, b), n in times.items())
    # each pass takes every block once, in an order of its own
    assert all(times[0, b] in (2, 3) for b in range(4000)) and all(times[1, b] == 2 for b in range(4000))
    assert max(Counter(r.shard for r in slots).values()) <= 100 * 6


def test_many_copies_of_rows_without_id(spark):
    rows = [(None, "a b c", "s")] * 2500 + [(k, "d " * (k % 7), "s") for k in range(200)]
    got = mixing.mix(documents(spark, rows)).collect()
    check_mix(got, rows)
    entries = mixing.sized(documents(spark, rows), "doc_id", "text", "source")
    assert entries.where("doc_id is null").count() == 1
    singles = mixing.single(mixing.placed(entries).withColumn("place", F.lit(0)))
    spans = sorted((r.start, r.start + r["size"]) for r in singles.where("size > 0").collect())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000, 999983, 3 * 1000003):
        at = mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long"))
        low, high, count = spark.range(n).select(at.alias("p")).agg(F.min("p"), F.max("p"), F.countDistinct("p")).first()
        assert (low, high, count) == (0, n - 1, n)


# WARC


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def base32_sha1(payload):
    import base64

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 1000)
    big = "línea\r\n\r\nWARC/1.1\r\n" * 5000
    rows = [(1, "http://a/", "<p>é</p>"), (2, "http://b/ c", "<p>é</p>"), (3, None, None), (4, "u\r\nX: y", ""), (5, "big", big), (9, "big2", big)]
    rows += [(-1, "neg", "x"), (-1, "neg", "x"), (None, "no id", "x"), (None, "alone", "only here")]
    pages = spark.createDataFrame(rows, PAGES)
    manifest, folder = warc.archive_pages(pages)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)
    got = sorted((tuple(r) for r in warc.archived(spark, manifest, folder).collect()), key=repr)
    expected = []
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    for key, payload in payloads:
        ids = [k for k, p in payloads if p == payload and k is not None]
        first = min(ids) if ids else None
        kind = "response" if key == first else "revisit"
        expected.append((key, len(payload), base32_sha1(payload), kind, first if kind == "revisit" else None))
    assert got == sorted(expected, key=repr)
    chunks = warc.read_archives(spark, manifest, folder, chunk_bytes=1000).where("record_type = 'response'").collect()
    whole = {}
    for c in sorted(chunks, key=lambda c: (c.archive, c.record, c.chunk)):
        assert len(c.data) <= 1000
        whole[c.archive, c.record] = whole.get((c.archive, c.record), b"") + bytes(c.data)
        assert c.sha1 == hashlib.sha1(whole[c.archive, c.record]).hexdigest() and c.so_far == len(whole[c.archive, c.record])
    assert sorted(whole.values()) == sorted([b"<p>\xc3\xa9</p>", b"", big.encode(), b"x", b"x", b"only here"])


def test_broken_archives_are_refused():
    import io

    good = warc._header("response", 1, "u", "D", 3, None, 1) + b"abc\r\n\r\n"
    assert [x[2] for x in warc.records_in(io.BytesIO(zlib.compress(good, wbits=31)))] == [b"abc"]
    for bad in (good[:-5], good[:-1] + b"x", b"HTTP/1.1\r\nA: b\r\n\r\n"):
        with pytest.raises((ValueError, StopIteration, RuntimeError)):
            list(warc.records_in(io.BytesIO(zlib.compress(bad, wbits=31))))


def test_warc_of_no_pages(spark):
    manifest, folder = warc.archive_pages(spark.createDataFrame([], PAGES))
    assert warc.archived(spark, manifest, folder).count() == 0


# neighbours


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("shard", T.IntegerType())]
)


def brute_nearest(rows, top=20, every=20):
    kept = [(k, np.array(v, np.float64)) for k, v in rows if k is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for q, v in kept:
        if q % every == 0:
            found = sorted((-float(v @ x), k) for k, x in kept if k != q and len(x) == len(v))
            out[q] = [(k, -s) for s, k in found[:top]]
    return out


def test_neighbours_recall_on_given_vectors(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 200)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    expected = brute_nearest([tuple(r) for r in rows])
    got = {}
    for r in queries.op8_neighbours(spark, sf_dir).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(expected) and all(len(g) == 20 for g in got.values())
    hits = sum(len({k for k, _ in got[q]} & {k for k, _ in expected[q]}) for q in got)
    assert hits / (20 * len(got)) >= 0.95
    for q, found in got.items():
        exact = dict(brute_nearest([tuple(r) for r in rows], 10**6)[q]) if q == 0 else None
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert exact is None or all(abs(exact[k] - s) < 1e-12 for k, s in found)


def test_neighbours_odd_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(size=4).tolist(), 1) for k in range(40)]
    rows += [(k, [0.5, 0.5, 0.0, 1.0], 1) for k in range(100, 140)]
    rows += [(200, None, 1), (220, [0.0] * 4, 1), (240, [1.0, None, 0.0, 0.0], 1), (260, [float("nan")] * 4, 1), (280, [float("inf")] * 4, 1)]
    rows += [(None, [1.0] * 4, 1), (300, [1.0, 2.0], 1), (320, [], 1)]
    vectors = spark.createDataFrame(rows, VECTORS)
    got = {}
    for r in neighbours.nearest(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    expected = brute_nearest([(k, [None if c is None else float(np.float32(c)) for c in v] if v is not None else None) for k, v, _ in rows])
    assert got == {q: [k for k, _ in found] for q, found in expected.items() if found}
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_repeated_rows_are_one_neighbour(spark):
    draw = np.random.default_rng(5)
    rows = [(k, draw.normal(size=4).tolist(), 1) for k in range(60)]
    rows += [(5, rows[5][1], 1)] * 25 + [(6, rows[5][1], 1)] + [(20, rows[20][1], 2)] * 30
    rows[6] = (1006, *rows[6][1:])
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS).repartition(5)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    once = {(k, tuple(float(np.float32(c)) for c in v)) for k, v, _ in rows}
    expected = brute_nearest(sorted((k, list(v)) for k, v in once))
    assert got == {q: [k for k, _ in found] for q, found in expected.items()}


def test_robust_prune_spreads_edges():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 1], [-1, 0], [0, 5]], np.float32)
    assert neighbours.robust_prune(x, 0, np.array([0, 1, 2, 3, 4, 5])).tolist() == [1, 3, 4]


# decontamination


def test_leaks_are_found_and_others_left(spark):
    items = [words(30, 100 + k) for k in range(12)]
    benchmark = spark.createDataFrame(
        [(k, t) for k, t in enumerate(items)] + [(50, items[3].upper() + "."), (60, None), (61, ""), (62, "ka lo"), (None, words(30, 300))],
        "item_id long, text string",
    )
    edited = items[5].split()
    for k in (4, 11, 17, 25):
        edited[k] = "other"
    edited.insert(9, "added")
    del edited[21]
    texts = [words(200, k) for k in range(30)]
    texts += [words(50, 90) + " " + items[3] + " " + words(80, 91), words(10, 92) + " " + " ".join(edited), items[7], items[0] + " " + words(300, 93) + " " + items[1]]
    texts += [None, "", (None, items[2], "s"), (7, items[8], "s"), words(20, 400) + " " + " ".join(items[9].split()[:8])]
    docs = documents(spark, texts)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert set(got) == {(30, 3), (31, 5), (32, 7), (33, 0), (33, 1), (None, 2), (7, 8)}
    assert got[30, 3].score == 1 and (got[30, 3].start, got[30, 3].stop) == (50, 80)
    assert 0.6 < got[31, 5].score < 0.95
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, empty).count() == 0
    assert decontaminate.contaminated(documents(spark, []), benchmark).count() == 0


def test_excerpts_of_long_items_and_short_items(spark):
    long_item, mid = words(150, 700), words(40, 701)
    items = [(1, long_item), (2, mid), (3, "zeta quince marrow ibex"), (4, "kalomi"), (5, "Quixotic!"), (6, "the the"), (7, words(3000, 702))]
    benchmark = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    cut = lambda text, a, b: " ".join(text.split()[a:b])
    texts = [words(120, 800 + k) + " the the" for k in range(40)] + [words(60, 40) + " kalomi " + words(60, 41)] * 30
    texts += [words(30, 50) + " " + cut(long_item, 60, 110) + " " + words(30, 51), words(30, 52) + " " + cut(long_item, 60, 75) + " " + words(30, 53)]
    texts += [words(30, 54) + " " + cut(mid, 5, 18) + " " + words(30, 55), words(9, 56) + " zeta, QUINCE marrow ibex. " + words(9, 57)]
    texts += ["zeta quince extra marrow ibex", "a quixotic man", words(30, 58) + " " + cut(items[6][1], 1000, 1060) + " " + words(30, 59)]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, texts), benchmark).collect()}
    assert set(got) == {(70, 1), (73, 3), (76, 7)}  # one rare word, or two common ones, could stand anywhere
    assert got[70, 1].start == 30 and got[70, 1].stop in range(80, 84) and 0.3 < got[70, 1].score < 0.4
    assert (got[73, 3].score, got[73, 3].start, got[73, 3].stop) == (1, 9, 13)
    assert decontaminate.needed(np.ones(50), 0.5) == 0.5 and decontaminate.needed(np.ones(200), 0.5) == 0.125 and decontaminate.needed(np.ones(4), 0.5) == 1


def test_leaks_equal_alignment_of_everything(spark):
    items = [(k, words(8 + 9 * k, 900 + k)) for k in range(7)]
    texts = [words(60, 950 + k) for k in range(25)]
    for k, (_, text) in enumerate(items * 3):
        ws, draw = text.split(), np.random.default_rng(k)
        for at in draw.choice(len(ws), len(ws) // (k % 5 + 3), replace=False):
            ws[at] = "changed"
        texts.append(words(20, 970 + k) + " " + " ".join(ws[: len(ws) - k % 4]) + " " + words(20, 990 + k))
    docs = documents(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, benchmark).collect()}
    counts = Counter(w for t in texts for w in t.split())
    total = sum(counts.values())
    want = {}
    for item, text in items:
        surprise = np.array([np.log(total / max(1, counts[w])) for w in text.split()])
        codes = {w: k for k, w in enumerate(sorted(set(counts) | set(text.split())))}
        of = lambda t: np.array([codes[w] for w in t.split()], np.uint64)
        for doc, whole in enumerate(texts):
            score, _, _ = decontaminate.align(of(text), surprise, of(whole))
            if score >= decontaminate.needed(surprise, 0.5):
                want[doc, item] = round(score, 6)
    assert len(want) > 12 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 2e-6 for k in want)


def brute_align(item, surprise, passage):
    own = surprise.sum()
    cost = decontaminate.PENALTY * own / len(item)
    table = np.zeros((len(item) + 1, len(passage) + 1))
    for i in range(len(item)):
        for j in range(len(passage)):
            step = surprise[i] if item[i] == passage[j] else -cost
            table[i + 1, j + 1] = max(0, table[i, j] + step, table[i, j + 1] - cost, table[i + 1, j] - cost)
    return table.max() / own


def test_alignment_equals_the_full_table():
    draw = np.random.default_rng(8)
    for _ in range(60):
        item = draw.integers(0, 6, draw.integers(1, 15)).astype(np.uint64)
        passage = draw.integers(0, 6, draw.integers(1, 40)).astype(np.uint64)
        surprise = draw.random(len(item)) + 0.1
        score, a, b = decontaminate.align(item, surprise, passage)
        assert abs(score - brute_align(item, surprise, passage)) < 1e-9
        if score:  # the stretch it names holds the whole alignment
            assert abs(brute_align(item, surprise, passage[a:b]) - score) < 1e-9


# personal data


def brute_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


HARD = [
    "a@b.c x.y+z@mail.example.com, @@a@b @x.y a@b@c.d q@-.-",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 é1.2.3.4é 1..2.3.4.5",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 0000000000000 12345678901234567890123",
    "+1 (603) 555-8791 +49 30 1234567. ++1234567890 +1+12345678901 + 123456789 5 +44(20)7946.0018",
    "x4111111111111111y 10.0.0.1@host.tld +1.2.3.4.5.6.7.8.9",
]


def test_base_rules_equal_the_plain_patterns(spark, sf_dir):
    draw = np.random.default_rng(3)
    texts = HARD + ["".join(draw.choice(list("0123456789+.-() @ab\n"), 80)) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts:
        assert pii.base_spans(text) == brute_base(text), text


def test_patterns_find_unseen_identifiers(spark):
    texts = [f"{words(12, k)} write to me at user{k}@mail.example.com please {words(5, 900 + k)}" for k in range(12)]
    texts += [f"{words(12, 50)} write to me at user77(at)4417-0815 please", f"{words(9, 51)} at 4417-0815", "the 9999-2222 of"]
    texts += [None, "", (None, HARD[0], "s"), "x" * 5000 + " 10.0.0.1"]
    docs = documents(spark, texts)
    rows = pii.annotated(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for r in rows:
        text = HARD[0] if r.doc_id is None else texts[r.doc_id]
        assert [(s.start, s.kind, s.stop) for s in r.base] == brute_base(text or "")
        assert [s for s in r.spans if s.by_rule] == list(r.base)
    new = [s for s in by_id[12].spans if not s.by_rule]
    assert new == []  # user77 has no four digits, and what has follows no trusted word
    assert not [s for k in (13, 14) for s in by_id[k].spans]


def test_base_counts_are_by_kind(spark, tmp_path):
    texts = ["10.0.0.1 10.0.0.2 10.0.0.3 and a.b@c.de", "a@b.c, d@e.f, 1.2.3.4 and +1 (603) 555-8791", "no data", None, "4111 1111 1111 1111"]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op9_pii(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        base = brute_base(text or "")
        assert [rows[k][f"n_{name}"] for name in pii.KINDS] == [sum(kind == at for _, kind, _ in base) for at in range(len(pii.KINDS))]
        told = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in base)
        assert rows[k].base_sha256 == hashlib.sha256(told.encode()).hexdigest()


def test_trusted_patterns_reach_new_instances(spark):
    texts = [f"{words(12, k)} reach me: mail {'u' + str(k) + '@mail.example.com'} now" for k in range(10)]
    texts += [f"{words(12, 60)} reach me: mail jo4711-0815-x now", f"{words(12, 61)} order number 4711-0815-y came"]
    rows = {r.doc_id: r for r in pii.annotated(documents(spark, texts)).collect()}
    assert [(s.kind, texts[10][s.start : s.stop]) for s in rows[10].spans] == [(0, "jo4711-0815-x")]
    assert not rows[11].spans


def test_numbers_in_groups_are_found_whole(spark):
    texts = [f"{words(12, k)} please phone me at +1 603 555 87{k:02} any day" for k in range(60)]
    unseen = ["(603) 555-8791", "603 555 8791", "603.555.8791", "(06221)4417 0815", "0" + "4711-x" * 20 + "9"]
    texts += [f"{words(12, 170 + k)} please phone me at {number} any day" for k, number in enumerate(unseen)]
    texts += [f"please phone me at {' '.join(['1234'] * 30)} any day", "10.0.0.1 please phone me at 603 555 8791 any 10.0.0.2", "phone me at +1 603 555 8791x now"]
    texts += ["please phone me at " + "1 " * 20000, "x" * 30000 + " " + "y" * 30000 + " 4711 " + "z" * 30000, "603 555 8791 came alone"]
    rows = {r.doc_id: r for r in pii.annotated(documents(spark, texts)).collect()}
    for k, number in enumerate(unseen, 60):
        assert [(s.kind, texts[k][s.start : s.stop]) for s in rows[k].spans] == [(3, number)]
    assert [texts[65][s.start : s.stop] for s in rows[65].spans] == ["1234"]  # 120 digits are no number: the first run stands there
    assert [(s.kind, texts[66][s.start : s.stop]) for s in rows[66].spans] == [(1, "10.0.0.1"), (3, "603 555 8791"), (1, "10.0.0.2")]
    assert not any(s.by_rule is False for k in (67, 68, 69, 70) for s in rows[k].spans)
    redacted = {r.doc_id: r.text for r in pii.redacted(documents(spark, texts)).collect()}
    assert all(redacted[k].endswith("please phone me at [PHONE] any day") for k in range(60, 65))


def test_patterns_look_as_far_as_their_words_reach():
    far = "call " + "w" * 500 + " " * 300 + "4711-0815" + " " * 300 + "now"
    (place,) = pii.occurrences(far, [])
    start, stop, kind, instance, patterns = place
    assert (far[start:stop], kind, instance) == ("4711-0815", None, "4711-0815")
    assert patterns == [f"before call {pii.named('w' * 500)}", f"around {pii.named('w' * 500)} now"] and len(patterns[0]) < 100
    assert pii.named("9" * 65) != pii.named("9" * 66) and pii.named("9" * 64) == "9" * 64
    assert pii.contexts("4711", 0, 4) == [] and pii.contexts("a 4711", 2, 6) == []


def test_redaction_keeps_columns(spark):
    docs = documents(spark, ["mail a.b@c.de or +1 (603) 555-8791.", None, "nothing", (None, "1.2.3.4", None)])
    out = pii.redacted(docs)
    assert out.schema == docs.schema
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {0: "mail [EMAIL] or [PHONE].", 1: None, 2: "nothing", None: "[IP]"}


# classifiers


LABELS = "doc_id long, quality int, toxic int, text string"


def labelled(spark, n=240):
    texts, labels = [], []
    for k in range(n):
        toxic, poor = k % 5 == 0, k % 4 == 0
        ws = words(80, k).split()
        if toxic:
            ws[7::9] = ["vilgrunt"] * len(ws[7::9])
        text = " ".join(ws)
        texts.append("!! ".join(text.upper().split()) if poor else text)
        labels.append((k, int(not poor), int(toxic), "x"))
    texts += [(None, "vilgrunt " * 40, "s"), (n, None, "s"), (n + 1, "", "s"), (n + 2, "word", "s"), (3, texts[3], "s")]
    labels += [(None, 1, 1, "x"), (n, 1, None, "x"), (n + 50, 1, 1, "x"), (3, 1, 0, "x")]
    return documents(spark, texts), spark.createDataFrame(labels, LABELS), n


def test_toxicity_held_out(spark):
    docs, labels, n = labelled(spark)
    held = fold(F.col("doc_id"), 3) == 1
    rows = toxicity.toxic_scores(docs, labels, ~held).withColumn("held", held).collect()
    assert len(rows) == n + 5 and all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.doc_id is not None and r.doc_id < n and r.held]
    assert all((r.score >= 0.7) == (r.doc_id % 5 == 0) for r in out) and len(out) > 50
    assert [r.score >= 0.7 for r in rows if r.doc_id is None] == [True]
    assert all(r.score < 0.7 for r in rows if r.doc_id is not None and r.doc_id >= n)


def test_quality_held_out(spark):
    docs, labels, n = labelled(spark)
    held = fold(F.col("doc_id"), 5) == 0
    rows = quality.quality_scores(docs, labels, ~held).withColumn("held", held).collect()
    assert len(rows) == n + 5 and all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.doc_id is not None and r.doc_id < n and r.held]
    assert sum((r.score >= 0.3) == (r.doc_id % 4 != 0) for r in out) / len(out) > 0.95 and len(out) > 30


def test_classifiers_without_rows_or_labels(spark, none):
    docs, labels, n = labelled(spark, 20)
    no_labels = labels.limit(0)
    anything = F.lit(True)
    assert toxicity.toxic_scores(none, labels, anything).count() == 0
    assert quality.quality_scores(none, labels, anything).count() == 0
    assert {r.score for r in toxicity.toxic_scores(docs, no_labels, anything).collect()} == {0.0}
    assert {r.score for r in quality.quality_scores(docs, no_labels, anything).collect()} == {0.0}
    assert language.languages(none, anything).count() == 0


def test_word_vectors_do_not_depend_on_the_partitioning(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("binary").alias("text"))
    assert np.array_equal(quality.word_vectors(docs.repartition(5)), quality.word_vectors(docs.coalesce(1)))


def test_language_held_out(spark, sf_dir):
    rows = queries.op5_language(spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95


def test_signs_that_are_no_letters_have_no_language(spark):
    texts = [*(f"{words(20, k)} ja" for k in range(8)), "\u00bd\u00b2", "\u2177 \u2160", "\u2460\u2461", "12 _ 3", "\u00aa", "\u01c5", "\u6f22"]
    told = {r.doc_id: r.lang_pred for r in language.languages(documents(spark, texts), F.col("doc_id") < 8).collect()}
    assert [told[k] for k in range(8, 15)] == ["und"] * 4 + ["xx"] * 3


def test_language_odd_texts(spark, odd):
    texts = {r.doc_id: r for r in language.languages(odd, F.lit(True)).collect() if r.doc_id is not None}
    assert [(texts[k].lang_pred, texts[k].score) for k in (20, 21, 22)] == [("und", 0.0)] * 3
    assert texts[0].lang_pred == "xx" and abs(texts[0].score - 1) < 1e-6


def test_backpropagation_equals_numeric_slopes(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 6)
    model = language.Network(["a", "b", "c"])
    draw = np.random.default_rng(0)
    rows = draw.integers(1, 5, (4, 6)).astype(np.uint8)
    rows[0, 4:] = 0
    truth = np.array([0, 1, 2, 1])

    def loss():
        share = model.label(rows)
        real = rows.T != 0
        return float(-np.log(share[:, np.arange(4), truth])[real].mean())

    slope = model.slopes(rows, truth)
    for name, at in (("bytes", (0, 2, 3)), ("bytes", (1, 3, 20)), ("states", (0, 1, 5)), ("states", (1, 4, 18)), ("out", (3, 1)), ("bias", (2,))):
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-2
        up = loss()
        model.p[name][at] = kept - 1e-2
        down = loss()
        model.p[name][at] = kept
        assert abs((up - down) / 2e-2 - slope[name][at]) < 2e-3


def test_empty_tables(spark, none):
    assert substring.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert pii.annotated(none).count() == 0
    assert pii.redacted(none).count() == 0


def test_a_third_of_the_rows_are_copies_from_one_source(spark):
    base = words(70, 7000)
    texts = [(k, base if k % 3 == 0 else words(30 + k % 40, 7100 + k), "hot" if k % 3 == 0 else f"s{k % 5}") for k in range(150)]
    docs = documents(spark, texts).repartition(6)
    rows = [(k, t) for k, t, _ in texts]
    assert sorted((tuple(r) for r in substring.remove_repeats(docs).collect()), key=repr) == brute_removal(rows)
    prints = [brute_fingerprint(t) for _, t in rows]
    component = brute_components([k for k, _ in rows], prints)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {k: c for (k, _), c in zip(rows, component)}
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(component))
    check_mix(mixing.mix(docs).collect(), texts)
