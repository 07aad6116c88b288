"""Stored minimizer index, hot minimizers, whole reads, and ids in the table's order."""

import os
import random

import pytest
from loamframe.operators import minimizers as M
from loamframe.operators import reads as R
from loamframe.operators import samples as S
from loamframe.operators import taxonomy as T
from loamframe.sources import sinks as K
from loamframe.sources import tables as tables
from pyspark.sql import functions as F

from tests.test_reads import brute_minimizers, sequences, tree


def test_runs_cover_every_window(spark, monkeypatch):
    rng = random.Random(9)
    seqs = [None, "", "A" * 300, "ACGT" * 50, "é" * 40, *("".join(rng.choice("ACGTN") for _ in range(rng.randrange(0, 80))) for _ in range(50))]
    table = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    monkeypatch.setattr(M, "SLICE", 200)
    for length in (None, 100):
        for k, l in ((9, 4), (12, 12), (6, 1)):
            found = {}
            for r in M.minimizer_runs(table, "id", k, l, 5, 0, length).collect():
                found.setdefault(r.id, []).append((r.pos, r.times, r.minimizer))
            for i, s in enumerate(seqs):
                cut = (s or "")[:length]
                runs = sorted(found.get(i, []))
                assert [m for _, n, m in runs for _ in range(n)] == brute_minimizers(cut, k, l, 5) if len(cut) <= 256 else len(cut) - k + 1 == sum(n for _, n, _ in runs)
                assert all(a[0] + a[1] == b[0] and a[2] != b[2] for a, b in zip(runs, runs[1:], strict=False))


def test_stored_index_stays_where_it_is(spark):
    """Only reads are shuffled; a minimizer of very many rows takes the small table; results are the same."""
    shared, own, refs = sequences()
    paths = tree(spark)
    index = R.build_index(spark.createDataFrame([*refs, (5, "A" * 40)], "tax_id int, seq string"), paths, 15, 11)
    reads = spark.createDataFrame([("r3", own[3][10:90]), ("both", shared), ("mixed", own[5][:60] + own[3][:60]), ("short", "ACGT"), *((f"a{i}", "ACGGT" * 3 + "A" * (20 + i % 9)) for i in range(300))], "read_id string, seq string")
    want = sorted(map(str, R.classify(reads, index, paths, 15, 11).collect()))
    M.write_index(index, "index_of_a_test", 4)
    stored = M.read_index(spark, "index_of_a_test")
    found = M.minimizer_runs(reads, "read_id", 15, 11)
    hot = M.hot_minimizers(found, stored, 20)
    assert 0 < hot.count() < 20 and 0 in {r.minimizer for r in hot.collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for h in (None, hot):
            assert sorted(map(str, R.classify(reads, stored, paths, 15, 11, hot=h).collect())) == want
            met = M.look_up(found, stored, "read_id", h)
            plan = met._jdf.queryExecution().executedPlan().toString()
            joined = plan[plan.index("SortMergeJoin") :]
            right = joined[joined.index("FileScan parquet spark_catalog.default.index_of_a_test") :]
            above = joined[: joined.index("FileScan parquet spark_catalog.default.index_of_a_test")]
            assert "Bucketed: true" in right and above.count("Exchange hashpartitioning") == 1, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE index_of_a_test")


def test_long_runs_fold_like_single_hits(spark):
    """A run changes a read's path at most twice, which is what the fold relies on."""
    paths = tree(spark)
    rng = random.Random(1)
    runs = [(i, pos, rng.randint(1, 4), rng.choice([1, 2, 3, 4, 5])) for i in range(200) for pos in range(0, 24, 4)]
    table = spark.createDataFrame(runs, "read_id int, pos int, times int, tax_id int")
    got = {r.read_id: (r.hit_count, r.tax_id) for r in R.fold_hits(table, paths).collect()}
    single = table.select("read_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("times") - 1)).alias("pos"), "tax_id").join(paths.select("tax_id", "path"), "tax_id")
    assert got == {r.read_id: (r.hit_count, r.tax_id) for r in T.classify_reads(single).collect()}


def test_whole_reads_are_screened(spark):
    rng = random.Random(7)
    fresh = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    known = fresh(3000)
    reads = spark.createDataFrame([("tail", fresh(300) + known), ("head", known[:300] + fresh(3000))], "read_id string, seq string")
    got = {r.read_id: r.matches for r in R.screened(reads, spark.createDataFrame([(1, known)], "tax_id int, seq string"), 15, 0.5).collect()}
    assert got == {"tail": True, "head": False}


def test_ids_are_judged_in_order(spark):
    rows = [("ENSG01", 0), *((f"AAA{i:03}", i) for i in range(1, 201))]
    table = spark.createDataFrame(rows, "gene string, at int").repartition(5)
    assert S.id_type(table, "at").first()[0] == "ENSEMBL" and S.id_type(table, -F.col("at")).first()[0] == "SYMBOL"
    twice = spark.createDataFrame([*(("7", i) for i in range(150)), ("x", 200)], "gene string, at int")
    assert S.id_type(twice, "at").first()[0] == "SYMBOL"  # repeated ids count once


def test_decimal_commas_where_they_are_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sample;bmi;dose;lane\nS1;23,4;1,5;L1,2\nS2;;7;L2\n")
    got = tables.read_annotation(spark, f"file://{tmp_path}/a.csv", ("bmi", "dose", "absent")).orderBy("sample").collect()
    assert [tuple(r) for r in got] == [("S1", 23.4, 1.5, "L1,2"), ("S2", None, 7.0, "L2")]


@pytest.mark.parametrize("ordered", [False, True])
def test_a_sample_is_written_by_several_tasks(spark, tmp_path, ordered):
    rows = spark.range(20_000).select(F.lit("s").alias("sample"), F.concat(F.lit("read "), F.col("id"), F.repeat(F.lit("x"), 20)).alias("value"), "id").union(spark.createDataFrame([("t", "one", 1)], "sample string, value string, id long"))
    small = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for c in small:
        spark.conf.set(c, "64k")
    try:
        K.write_lines(rows.repartition(6), f"file://{tmp_path}/out", "id" if ordered else None)
    finally:
        for c in small:
            spark.conf.unset(c)
    files = sorted(f for f in os.listdir(tmp_path / "out" / "sample=s") if f.startswith("part"))
    lines = [x for f in files for x in (tmp_path / "out" / "sample=s" / f).read_text().splitlines()]
    assert len(files) > 1 and len(lines) == 20_000 and sorted(lines) == sorted(r.value for r in rows.where("sample = 's'").collect())
    assert not ordered or [int(x.split()[1].rstrip("x")) for x in lines] == list(range(20_000))
