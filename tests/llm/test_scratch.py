"""What steps leave on the disk: tables of a finished step go, what the result reads stays."""

from pathlib import Path

import pytest

import corpus_pipeline
from rowgraft.llm import repeats
from rowgraft.llm.common import FREE_SHUFFLES, documents, durable, numbered, passing, written
from rowgraft.operators.skew import ensure_checkpoint_dir


@pytest.fixture
def tables(spark):
    """The tables that were made in the checkpoint folder since the test began."""
    ensure_checkpoint_dir(spark)
    top = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    listed = lambda: {p.name for p in top.glob("table-*")}
    before = listed()
    return lambda: listed() - before


def test_tables_of_a_block_go_and_kept_ones_stay(spark, tables):
    with passing(spark) as keep:
        with passing(spark) as hand_on:
            rows = durable(spark.range(9))
            more = hand_on(written(rows.where("id > 2")).where("id > 3"))
            assert len(tables()) == 3
        assert len(tables()) == 1 and more.count() == 5
        kept = keep(more.where("id > 4"))
    assert len(tables()) == 1 and {r.id for r in kept.collect()} == {5, 6, 7, 8}


def test_a_block_that_fails_leaves_nothing(spark, tables):
    before = spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(ValueError), passing(spark):
        durable(spark.range(9))
        raise ValueError
    assert not tables() and spark.conf.get(FREE_SHUFFLES) == before


def test_stages_leave_what_their_result_reads(spark, sf, tables):
    docs = documents(spark, sf)
    stages = [corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats, corpus_pipeline.decontaminate]
    for n, stage in enumerate(stages, 1):
        assert stage(spark, docs, sf).count() > 0
        assert len(tables()) == n
    before = tables()
    repeats.shared_words(numbered(docs)).count()
    assert len(tables() - before) == 1


def test_shuffle_files_go_when_a_pass_ends(spark, sf):
    """The shuffles of a query inside a block are not there any more when the next one begins."""
    shuffles = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before = shuffles()
    with passing(spark):
        durable(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count().repartition(3, "count"))
        assert shuffles() <= before
