"""Adapter search with edits against plain dynamic programs, spliced alignments, shares of ancestors."""

import random
import re

import pytest
from loamframe.operators import intervals as I
from loamframe.operators import reads as R
from pyspark.sql import functions as F

from tests.test_reads import sequences, tree


def distances_from(read, p, adapter):
    """Edits between ``adapter`` and ``read[p:q]`` for every q."""
    rest = read[p:]
    line = list(range(len(rest) + 1))
    for i, c in enumerate(adapter, 1):
        new = [i]
        for j, x in enumerate(rest, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != c)))
        line = new
    return line


def plain_cut(read, adapter, overlap, error):
    cost = []
    for p in range(len(read)):
        found = []
        if len(adapter) >= overlap:
            found.append((min(distances_from(read, p, adapter)), int(error * len(adapter))))
        found += [(distances_from(read, p, adapter[:j])[-1], int(error * j)) for j in range(max(1, overlap), len(adapter))]
        cost.append(min([d for d, most in found if d <= most], default=None))
    first = next((p for p, c in enumerate(cost) if c is not None), len(read))
    near = [(c, p) for p, c in enumerate(cost[: first + int(error * len(adapter)) + 1]) if c is not None]
    return min(near)[1] if near else len(read)


@pytest.mark.parametrize(("adapter", "overlap", "error"), [("AGATCGGAAGAGC", 3, 0.1), ("ACGTACGTACGTACGTACGTACG", 1, 0.2), ("GATTACA", 4, 0.3), ("CTGTCTCTTATACACATCT" * 3, 5, 0.1)])
def test_adapter_by_dynamic_program(spark, monkeypatch, adapter, overlap, error):
    """Adapters with letters replaced, inserted, deleted, cut off by the read's end, and none."""
    rng = random.Random(len(adapter))
    reads = ["", "A", adapter, adapter[1:], adapter[:5]]
    for _ in range(120):
        own = list(adapter)
        for _ in range(rng.randrange(0, 4)):
            i = rng.randrange(len(own))
            kind = rng.randrange(3)
            own[i : i + 1] = [] if kind == 0 else [rng.choice("ACGT")] if kind == 1 else [rng.choice("ACGT"), own[i]]
        text = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30))) + "".join(own) + "".join(rng.choice("ACGTN") for _ in range(rng.randrange(0, 8)))
        reads.append(text[: rng.randrange(1, len(text) + 1)])
    monkeypatch.setattr(R, "AREA", 500)
    got = {r.seq: r.cut for r in spark.createDataFrame([(x,) for x in reads], "seq string").select("seq", R.adapter_cut(F.col("seq"), adapter, overlap, error).alias("cut")).collect()}
    assert got == {x: plain_cut(x, adapter, overlap, error) for x in reads}


def test_an_adapter_that_lacks_a_letter(spark):
    rows = spark.createDataFrame([("TTTTT" + "AGATCGGAGAGC" + "CC",), ("x" * 200_000 + "AGATCGGAAGAGC",)], "seq string")
    assert sorted(r.cut for r in rows.select(R.adapter_cut(F.col("seq"), "AGATCGGAAGAGC", 3).alias("cut")).collect()) == [5, 200_000]


def test_blocks(spark):
    cases = {"10M": [(5, 14)], "3S4M2I3M5N2M": [(5, 11), (17, 18)], "2=1X3D4M": [(5, 7), (11, 14)], "5N5M": [(10, 14)], "4M0N4M": [(5, 12)], "*": [], "5S": [], "6M3H": [(5, 10)]}
    rows = spark.createDataFrame([(k,) for k in cases], "cigar string")
    got = {r.cigar: [tuple(b) for b in r.b] for r in rows.select("cigar", I.blocks(F.lit(5), F.col("cigar")).alias("b")).collect()}
    assert got == cases and spark.range(1).select(I.blocks(F.lit(5), F.lit(None).cast("string"))).first()[0] is None


def test_introns_count_for_nothing(spark):
    exons = spark.createDataFrame([("a", "c", 1, 100, "+"), ("a", "c", 50, 120, "+"), ("a", "c", 900, 1000, "+"), ("b", "c", 300, 400, "+"), ("d", "c", 950, 960, "-")], "gene string, contig string, start long, end long, strand string")
    reads = [("spans b", "c", 110, "11M779N20M", "+"), ("in b", "c", 350, "20M", "+"), ("touches a", "c", 118, "10M", "+"), ("both", "c", 110, "10M190N10M", "+"), ("anti", "c", 955, "5M", "-"), ("none", "c", 500, "50M", "+"), ("null", "c", 1, None, "+")]
    table = spark.createDataFrame(reads, "read string, contig string, start long, cigar string, strand string")
    for width in (7, 64, None):
        count = lambda **o: {r.gene: r.n for r in I.count_spliced(table, exons, width=width, **o).collect()}  # noqa: E731, B023
        assert count() == {"a": 2, "b": 1}  # "anti" lies on a and d, "both" on a and b
        assert count(least=4) == {"a": 1, "b": 1}
        assert count(stranded=True) == {"a": 2, "b": 1, "d": 1}
    assert [(r.start, r.end) for r in I.merged_exons(exons).where("gene = 'a'").orderBy("start").collect()] == [(1, 120), (900, 1000)]


def test_what_blocks_share_moves_once(spark):
    """Letters of mates add up, and rows go to their read in a single exchange."""
    exons = spark.createDataFrame([("a", "c", 1, 100), ("b", "c", 300, 400), ("a", "d", 1, 50)], "gene string, contig string, start long, end long")
    reads = [("mates", "c", 98, "3M"), ("mates", "d", 49, "9M"), ("two", "c", 90, "10M"), ("two", "c", 395, "6M"), ("short", "c", 300, "4M"), (None, "c", 1, "5M")]
    table = spark.createDataFrame(reads, "read string, contig string, start long, cigar string")
    counted = I.count_spliced(table, exons, 5, 64)
    assert {r.gene: r.n for r in counted.collect()} == {"a": 2}
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", I.count_spliced(table, exons, 5, 64)._jdf.queryExecution().executedPlan().toString())
    assert sum("read#" in x for x in dealt) == 1, dealt


def test_shares_follow_what_taxa_have_in_common(spark):
    shared, own, refs = sequences()
    paths = tree(spark)
    references = spark.createDataFrame([*refs, (5, "ACGT"), (4, None)], "tax_id int, seq string")
    index = R.build_index(references, paths, 15, 11)
    got = {(r.tax_id, r.ancestor): (r.windows, r.share) for r in R.ancestor_shares(references, index, paths, 30, 15, 11).collect()}
    windows = 200 - 30 + 1
    assert got[5, 5] == (91, 1.0) and got[3, 3][0] + got[3, 2][0] == windows and got[3, 2][0] >= 80 - 30 - 15
    assert {k for k in got} == {(3, 3), (3, 2), (4, 4), (4, 2), (5, 5)}
    for at in range(0, windows, 40):  # a window is called like a read
        called = R.classify(spark.createDataFrame([("x", refs[0][1][at : at + 30])], "read_id string, seq string"), index, paths, 15, 11).first()
        assert called.tax_id in (2, 3)
