"""What the near-duplicate join and its step of the pipeline move and leave on disk."""

import os
import random
import re
import time

import pytest
from helpers_llm import documents, roots, shingles
from pyspark.sql import functions as F

import corpus_pipeline
from seriesprep.llm import common, jaccard_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """As on tables of millions of rows: nothing is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("rows_broadcast", [0, 400_000])
def test_marked_numbers(spark, monkeypatch, rows_broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows_broadcast)
    rng = random.Random(4)
    ids = [0, 63, 64, -1, -64, -65, 2**62, -(2**63), 2**63 - 1, None] + [rng.randrange(-300, 300) for _ in range(80)]
    rows = [None, -(2**63), 2**62, 2**62 + 1, 2**63 - 1, *range(-310, 310), 5, 5]
    found = common.marked(spark.createDataFrame([(x, "t") for x in rows], "n bigint, text string"), "n", spark.createDataFrame([(x,) for x in ids], "k bigint"))
    assert found.columns == ["n", "text", "found"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["n"], r["found"]) for r in found.collect()), key=key) == sorted(((x, x is not None and x in ids) for x in rows), key=key)


def test_only_wanted_texts_are_moved(spark, no_broadcast):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(300)], "doc_id bigint, text string")
    wanted = spark.createDataFrame([(7, 70, 0, 0), (8, 80, 0, 0)], "key bigint, doc_id bigint, s1 bigint, s2 bigint")
    moved = re.split(r"(?=Exchange hashpartitioning\()", plan(jaccard_join._sets(docs, wanted)))
    assert any("_bits" in part for part in moved)


def test_groups_where_nothing_is_small(spark, no_broadcast):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]
    root = roots(len(rows), pairs)
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    want = sorted((str(rows[i][0]), str(least[root[i]])) for i in range(len(rows)))
    got = jaccard_join.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == want


def test_step_of_the_pipeline_keeps_texts_once(spark, monkeypatch):
    staged, real = {}, corpus_pipeline.stage
    monkeypatch.setattr(corpus_pipeline, "stage", lambda df, name, *a: staged.setdefault(name, real(df, name, *a)))
    docs = documents(spark)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    schema = staged["pipeline-rows"].schema.simpleString()
    assert len(re.findall(r"\btext:", schema)) == 1
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_staged_table_leaves_no_shuffle_files(spark):
    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {os.path.basename(f) for f in files if "/shuffle_" in f}

    def left(before):
        for _ in range(50):  # the files are removed beside the program
            if not kept() - before:
                break
            time.sleep(0.1)
        return kept() - before

    before, setting = kept(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = common.stage(spark.range(1000).repartition(3, "id"), "some")
    assert not left(before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert rows.count() == 1000
    folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    common.drop_staged(rows)
    assert not os.path.exists(folder)
