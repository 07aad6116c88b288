"""FASTQ ranges, pairs, and streams that lose nothing."""

import gzip
import os
import random
import struct
import zlib

import pytest
from loamframe.operators import reads as R
from loamframe.operators import taxonomy as T
from loamframe.sources.fastq import FastqSource, list_files, split_file
from loamframe.streaming import classify as C
from pyspark.sql import functions as F

from tests.test_reads import sequences, tree, write_fastq


def in_blocks(data, size):
    """Block compression: gzip members that say how long they are, and an empty one at the end."""
    out = []
    for part in [*(data[i : i + size] for i in range(0, len(data), size)), b""]:
        pack = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = pack.compress(part) + pack.flush()
        out.append(b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


def fastq(n, seed=3):
    """Reads whose qualities begin with every sign, some of them empty, one pair of lines out of place."""
    draw = random.Random(seed)
    text = []
    for i in range(n):
        k = draw.randrange(0, 60)
        qual = "".join(draw.choice("@+!IIII5") for _ in range(k))
        text.append(f"@r{i} x\n{''.join(draw.choice('ACGTN') for _ in range(k))}\n+\n{qual}\n")
        if i == n // 2:
            text.append("no record\n@neither\n")
    return "".join(text).encode()


@pytest.mark.parametrize("kind", ["plain", "blocks", "gzip"])
@pytest.mark.parametrize("split", [37, 500, 4001])
def test_ranges_of_a_file_equal_the_whole(spark, tmp_path, kind, split):
    spark.dataSource.register(FastqSource)
    data = fastq(400)
    assert gzip.decompress(in_blocks(data, 300)) == data
    name, raw = {"plain": ("a.fastq", data), "blocks": ("a.fastq.gz", in_blocks(data, 300)), "gzip": ("a.fq.gz", gzip.compress(data))}[kind]
    (tmp_path / name).write_bytes(raw)
    whole = [(r.read_id, r.seq, r.qual) for r in spark.read.format("fastq").option("split", 1 << 30).load(f"file://{tmp_path}").orderBy("pos").collect()]
    assert [x[0] for x in whole] == [f"r{i}" for i in range(400)]
    if kind != "gzip" and split == 37:
        split = 200 if kind == "plain" else 37
    cut = spark.read.format("fastq").option("split", split).load(f"file://{tmp_path}")
    (path, size), = list_files(f"file://{tmp_path}")
    assert (len(split_file(path, size, split)) > 3) == (kind != "gzip")
    assert [(r.read_id, r.seq, r.qual) for r in cut.orderBy("pos").collect()] == whole


def test_an_older_file_that_comes_later_is_read(spark, tmp_path):
    spark.dataSource.register(FastqSource)
    folder = tmp_path / "in"
    folder.mkdir()
    write_fastq(folder / "new.fastq", [("a", "ACGT")])
    out = f"file://{tmp_path}/out"
    run = lambda: spark.readStream.format("fastq").load(f"file://{folder}").writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start(out).awaitTermination(120)
    seen = lambda: sorted(r.read_id for r in spark.read.parquet(out).collect())
    assert run() and seen() == ["a"]
    write_fastq(folder / "old.fastq", [("b", "ACGT")])
    os.utime(folder / "old.fastq", (1, 1))
    assert run() and seen() == ["a", "b"]
    assert run() and seen() == ["a", "b"]


def test_pairs_come_from_the_source(spark, tmp_path):
    spark.dataSource.register(FastqSource)
    shared, own, refs = sequences()
    paths = tree(spark)
    index = R.build_index(spark.createDataFrame(refs, "tax_id int, seq string"), paths, 15, 11)
    folder = tmp_path / "in"
    folder.mkdir()
    first = [("p/1", own[3][:50]), ("q/1", "A" * 30), ("s/1", own[3][5:60])]
    second = [("p/2", own[4][:60]), ("q/2", own[5][:40]), ("s/2", "C" * 20)]
    write_fastq(folder / "s_R1.fastq", first)
    stream = lambda: spark.readStream.format("fastq").option("pairs", "true").load(f"file://{folder}")
    out = f"file://{tmp_path}/out"
    run = lambda: C.classify_stream(stream(), index, paths, out, f"file://{tmp_path}/c", paired=True, k=15, l=11).awaitTermination(120)
    assert run()  # the second mates are not there yet
    with pytest.raises(Exception, match="no mate"):
        spark.read.format("fastq").option("pairs", "true").load(f"file://{folder}").collect()
    write_fastq(folder / "s_R2.fastq", second)
    assert run()
    got = sorted((r["sample"], r.read_id, r.length, r.tax_id) for r in spark.read.schema(C.CLASSIFIED).parquet(out).collect())
    reads = spark.createDataFrame([((i, m), s) for m, rows in ((1, first), (2, second)) for i, (_, s) in enumerate(rows)], "read_id struct<i:int,m:int>, seq string")
    called = R.classify(reads, index, paths, 15, 11).select(F.lit("s").alias("sample"), F.col("read_id.i").alias("read_id"), F.col("read_id.m").alias("mate"), "path", "length")
    want = {r.read_id: (r.length, r.tax_id) for r in T.merge_pairs(called).collect()}
    assert got == sorted(("s", first[i][0], *want[i]) for i in range(3))
    for name, rows in (("unequal", second[:2]), ("names", [("x/2", "A"), *second[1:]])):
        bad = tmp_path / name
        bad.mkdir()
        write_fastq(bad / "s_R1.fastq", first)
        write_fastq(bad / "s_R2.fastq", rows)
        with pytest.raises(Exception, match="different numbers|differ:"):
            spark.read.format("fastq").option("pairs", "true").load(f"file://{bad}").collect()


def test_each_sample_is_reported_once_when_it_ends(spark, tmp_path):
    """Two samples of two files each, interleaved over three batches, and one without reads."""
    spark.dataSource.register(FastqSource)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    shared, own, refs = sequences()
    paths = tree(spark)
    index = R.build_index(spark.createDataFrame(refs, "tax_id int, seq string"), paths, 15, 11)
    folder, out, reports = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/reports"
    for s in ("x", "y", "empty"):
        (folder / s).mkdir(parents=True)
    expected = spark.createDataFrame([("a", 2), ("b", 2)], "sample string, files int")

    def run():
        stream = spark.readStream.format("fastq").option("ends", "true").option("split", 400).load(f"file://{folder}")
        assert C.classify_stream(stream, index, paths, out, f"file://{tmp_path}/c1", k=15, l=11).awaitTermination(180)
        done = spark.readStream.schema(C.CLASSIFIED).option("recursiveFileLookup", "true").parquet(out)
        assert C.sample_report_stream(done, paths, reports, f"file://{tmp_path}/c2", expected).awaitTermination(180)

    def told():
        return sorted((r["sample"], r.tax_id, r.clade_reads, r.batch) for r in spark.read.parquet(reports).collect())

    reads = {"x/a": [(f"r{i}", own[3][i : i + 60]) for i in range(9)], "y/a": [("r0", shared), ("r1", "A" * 50)], "x/b": [("r0", own[5][:70])], "y/b": [(f"r{i}", own[4][i : i + 50]) for i in range(7)], "empty/c": []}
    batches = (("x/a", "x/b"), ("y/a",), ("y/b", "empty/c"))
    ends = []
    for batch in batches:
        for name in batch:
            write_fastq(folder / f"{name}.fastq", reads[name])
        run()
        ends.append({x[0] for x in told()} if os.path.isdir(f"{tmp_path}/reports") else set())
    assert ends == [set(), {"a"}, {"a", "b", "c"}]
    rows = spark.read.schema(C.CLASSIFIED).parquet(out)
    whole = {(r["sample"], r.tax_id): r.clade_reads for r in T.clade_report(C.running_counts(rows), paths).collect()}
    got = told()
    assert len({x[:2] for x in got}) == len(got)  # once each
    assert {x[:2]: x[2] for x in got if x[0] != "c"} == whole and [x[2] for x in got if x[0] == "c"] == [0]
