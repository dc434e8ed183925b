"""The queries against their SQL, and the pipeline stage by stage against what was planted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import difference
from claimlens.llm import simhash
from claimlens.llm.oracles import ORACLES
from claimlens.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLES) <= set(entry.oracle_sql())


def words(n, seed):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(["ka", "lo", "mi", "re", "tu", "sha", "ven"], 3)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [words(30, 1000 + k) for k in range(5)]
    rows, labels = [], []
    for k in range(200):
        ws = words(90, k).split()
        if k % 5 == 0:
            ws[4::8] = ["vilgrunt"] * len(ws[4::8])
        rows.append((k, " ".join(ws)))
        labels.append((k, 1, int(k % 5 == 0)))
    rows += [(300 + k, rows[1][1]) for k in range(4)]  # copies of a clean document
    rows += [(310, rows[2][1] + " extra"), (320, words(20, 2000) + " " + items[2] + " " + words(20, 2001))]
    rows += [(330, words(60, 2002) + " write to a.b@example.com or +1 (603) 555-8791"), (340, None), (341, ""), (None, words(40, 2003))]
    rows += [(350, words(70, 2004)), (350, words(70, 2004)), (360, "vilgrunt " + words(3, 5) + " vilgrunt vilgrunt stop vilgrunt")]
    docs = [(k, t, "en", f"s{(k or 0) % 3}", len(t or "")) for k, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def smallest_of_groups(rows):
    marks = [simhash.fingerprint((r.text or "").encode()) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ((marks[i] ^ marks[j]) & (2**64 - 1)).bit_count() <= 3:
                root[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append((r.doc_id is None, r.doc_id or 0))
    return [None if none else k for none, k in sorted(min(g) for g in groups.values())]


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "mixing"]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if n < 4:
            assert docs.columns == columns
            if name in ("toxicity", "simhash", "decontamination"):
                assert docs.exceptAll(before).isEmpty()
    ids = lambda name: sorted((r.doc_id for r in seen[name].collect()), key=lambda x: (x is None, x))
    toxic = {k for k in range(0, 200, 5)} | {360}
    start = [r.doc_id for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()]
    assert ids("toxicity") == sorted((k for k in start if k not in toxic), key=lambda x: (x is None, x))
    # one document of each group, the one of the smallest id, groups by brute force over all pairs of fingerprints
    assert ids("simhash") == smallest_of_groups(seen["toxicity"].collect())
    assert not {300, 301, 302, 303, 341} & set(ids("simhash")) and {1, 340, 350, None} <= set(ids("simhash"))
    assert ids("decontamination") == [k for k in ids("simhash") if k != 320]
    masked = {r.doc_id: r for r in seen["pii"].collect()}
    plain = {r.doc_id: r for r in seen["decontamination"].collect()}
    assert ids("pii") == ids("decontamination")
    assert masked[330].text == words(60, 2002) + " write to [EMAIL] or [PHONE]" and masked[330].n_chars == len(masked[330].text)
    assert all(masked[k].text == plain[k].text for k in plain if k != 330)
    mixed = seen["mixing"]
    assert ids("mixing") == ids("pii") and mixed.where("taken > 3 * size").isEmpty()
    total, taken = mixed.agg(F.sum("size"), F.sum("taken")).first()
    assert abs(total - taken) < 0.05 * total


def test_run_equals_the_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    drawn = {"taken"}  # slots follow the order of the rows within their files
    fixed = [c for c in docs.columns if c not in drawn]
    got = corpus_pipeline.run(spark, corpus)
    assert got.columns == docs.columns
    assert sorted(map(repr, got.select(fixed).collect())) == sorted(map(repr, docs.select(fixed).collect()))
    assert {330, None} <= {r.doc_id for r in got.collect()}


def test_leaks_go_by_row_not_by_id(spark, corpus):
    item = words(30, 1002)
    rows = [(None, words(20, 1) + " " + item, "leak"), (None, words(40, 2), "clean"), (5, item, "leak"), (5, words(40, 3), "clean")]
    rows += [(6, words(10, 4) + " " + item + " " + words(10, 5), "leak")] * 2 + [(7, None, "clean"), (7, "", "clean")]
    docs = spark.createDataFrame([(k, t, "en", s, 1) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_leaks(spark, docs.repartition(3), corpus)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.where("source = 'clean'").collect()))
