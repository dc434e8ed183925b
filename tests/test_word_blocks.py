"""Search over blocks of postings: the rows of the scan, and few blocks read."""

import numpy as np
import pytest

from claimlens.operators import retrieval, word_blocks


@pytest.fixture(scope="module")
def notes(spark):
    draw = np.random.default_rng(2)
    known = [f"w{k}" for k in range(40)]
    weights = 1 / np.arange(1, 41)
    rows = [(f"C{k:05d}", " ".join(draw.choice(known, draw.integers(1, 60), p=weights / weights.sum()))) for k in range(2000)]
    rows += [("D1", ""), ("D2", None), ("D3", "rare w0 w0 w0"), ("D4", "rare w0"), ("D5", "für E11.9 the of")]
    return spark.createDataFrame(rows, "claim_id string, narrative string").repartition(5)


def told(df):
    return [(r.claim_id, r.score) for r in df.orderBy("rk").collect()]


def scan(notes, query, n=30):
    return told(retrieval.keyword_top(notes.where("narrative is not null"), query, n))


QUESTIONS = ["w0", "w0 w1", "W3 w7 w2", "rare", "rare w0", "nothing", "w0 nothing", "für", "e11.9", "the", "", "w39 w38"]


def test_blocks_give_the_rows_of_the_scan(spark, notes, tmp_path):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    some = notes.where("narrative is not null")
    word_blocks.write_blocks(some, whole, block_rows=32)
    for k in (0, 1, 2, 1):  # further batches, one of them twice
        word_blocks.write_blocks(some.where(f"pmod(hash(claim_id), 3) = {k}"), parts, batch=f"b{k}", block_rows=32)
    for folder, questions in ((whole, QUESTIONS), (parts, QUESTIONS[:6])):
        for question in questions:
            assert told(word_blocks.blocks_top(spark, folder, question)) == scan(notes, question), question
    assert told(word_blocks.blocks_top(spark, whole, "w0 w1", 3)) == scan(notes, "w0 w1", 3)


def test_common_words_read_few_blocks(spark, notes, tmp_path):
    word_blocks.write_blocks(notes.where("narrative is not null"), str(tmp_path), block_rows=16)
    blocks = spark.read.parquet(f"{tmp_path}/blocks")
    for question in ("w0", "w0 w1"):
        every = blocks.where("term = 'w0'").count()
        read = word_blocks.blocks_for(spark, str(tmp_path), question, 10).count()
        assert 0 < read < every / 2


def test_odd_tables(spark, notes, tmp_path):
    word_blocks.write_blocks(notes.limit(0), str(tmp_path / "none"))
    assert word_blocks.blocks_top(spark, str(tmp_path / "none"), "w0").count() == 0
    word_blocks.write_blocks(notes.where("claim_id = 'D2'"), str(tmp_path / "null"))
    assert word_blocks.blocks_top(spark, str(tmp_path / "null"), "w0").count() == 0
    with pytest.raises(ValueError):
        word_blocks.write_blocks(notes, str(tmp_path / "odd"), block_rows=100)


def test_lists_of_unique_keys_are_dealt_by_block(spark, notes, tmp_path, monkeypatch):
    """Counted words are not shuffled where no key repeats; where one does, its rows are added up in the same columns."""
    some = notes.where("narrative is not null").limit(300).persist()
    word_blocks.write_blocks(some.union(some.limit(1)), str(tmp_path / "repeated"), block_rows=32)
    monkeypatch.setattr(word_blocks, "one_a_key", None)
    word_blocks.write_blocks(some, str(tmp_path / "unique"), block_rows=32)
    read = lambda name: spark.read.parquet(str(tmp_path / name / "postings"))
    assert read("unique").dtypes == read("repeated").dtypes
    counted = lambda name: {(r.term, r.claim_id): r.times for r in read(name).collect()}
    twice = some.first().claim_id
    assert counted("repeated") == {k: n * (1 + (k[1] == twice)) for k, n in counted("unique").items()}
