"""Sequences, FASTQ files and streams."""

import gzip
import random

import pytest
from loamframe.operators import reads as R
from loamframe.operators import taxonomy as T
from loamframe.sources.fastq import FastqSource
from loamframe.streaming import classify as C
from loamframe.streaming.status import progress_stream, stage_files
from pyspark.sql import functions as F


def brute_minimizers(seq, k, l, toggle, spaced=0):
    s = "".join(c if c in "ACGT" else "A" for c in seq.upper())[:256]
    number = lambda t: int("".join(str("ACGT".index(c)) for c in t), 4)
    back = str.maketrans("ACGT", "TGCA")
    lmers = [min(number(s[i : i + l]), number(s[i : i + l][::-1].translate(back))) for i in range(len(s) - l + 1)]
    lmers = [x & spaced if spaced else x for x in lmers]
    return [min(x ^ toggle for x in lmers[i : i + k - l + 1]) ^ toggle for i in range(len(s) - k + 1)]


@pytest.mark.parametrize(("k", "l", "toggle", "spaced"), [(7, 5, 0x155, 0), (35, 31, 0x37E28C4271B5A2D, 0), (9, 9, 0, 0x3FF3F)])
def test_minimizers(spark, k, l, toggle, spaced):
    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGTacgtN") for _ in range(n)) for n in (0, 1, k - 1, k, k + 1, 90, 256, 300)]
    got = R.minimizers(spark.createDataFrame(list(enumerate(seqs)), "id int, seq string"), "id", k, l, toggle, spaced).collect()
    assert sorted((r.id, r.pos, r.minimizer) for r in got) == sorted((i, p, m) for i, s in enumerate(seqs) for p, m in enumerate(brute_minimizers(s, k, l, toggle, spaced)))


def tree(spark):
    nodes = [(1, None, "root", "root"), (2, 1, "genus", "A"), (3, 2, "species", "x"), (4, 2, "species", "y"), (5, 1, "genus", "B")]
    return T.taxonomy_paths(spark.createDataFrame(nodes, "tax_id int, parent_id int, rank string, name string"), 3)


def sequences():
    rng = random.Random(2)
    fresh = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared, own = fresh(80), {3: fresh(120), 4: fresh(120), 5: fresh(120)}
    return shared, own, [(3, own[3] + shared), (4, own[4] + shared), (5, own[5])]


def test_index_classification_and_confidence(spark):
    shared, own, refs = sequences()
    paths, references = tree(spark), spark.createDataFrame(refs, "tax_id int, seq string")
    index = R.build_index(references, paths, 15, 11)
    assert {r.tax_id for r in index.collect()} == {2, 3, 4, 5}
    reads = spark.createDataFrame([("r3", own[3][10:90]), ("both", shared), ("mixed", own[5][:60] + own[3][:60]), ("none", "A" * 60), ("short", "ACGT"), ("empty", "")], "read_id string, seq string")
    got = {r.read_id: r for r in R.classify(reads, index, paths, 15, 11).collect()}
    assert {k: r.tax_id for k, r in got.items()} == {"r3": 3, "both": 2, "mixed": 3, "none": None, "short": None, "empty": None}
    assert got["r3"].hit_count == 66 and got["r3"].length == 80
    votes = R.kmer_votes(reads, index, 15, 11).join(spark.createDataFrame([(k, r.tax_id) for k, r in got.items()], "read_id string, called int"), "read_id")
    sure = {r.read_id: r.tax_id for r in T.with_confidence(votes, paths, 0.6).collect()}
    assert sure["r3"] == 3 and sure["both"] == 2 and sure["mixed"] == 1 and sure["none"] is None
    lines = {r.value for r in R.classification_lines(R.classify(reads, index, paths, 15, 11)).collect()}
    assert "C\tr3\t3\t80\t1" in lines and "U\tnone\t0\t60\t0" in lines
    mates = spark.createDataFrame([("p", own[3][:60]), ("p", "A" * 60), ("q", "A" * 60)], "read_id string, seq string")
    assert sorted((r.read_id, r.matches) for r in R.screened(mates, references, 15).collect()) == [("p", True), ("p", True), ("q", False)]


def test_votes_of_whole_reads(spark):
    """Letters far behind the first 256 vote as well."""
    rng = random.Random(7)
    shared, own, refs = sequences()
    index = R.build_index(spark.createDataFrame(refs, "tax_id int, seq string"), tree(spark), 15, 11)
    fresh = "".join(rng.choice("ACGT") for _ in range(5000))
    texts = {1: fresh + own[4], 2: fresh[:250] + own[5], 3: own[3]}
    got = {}
    for r in R.kmer_votes(spark.createDataFrame(list(texts.items()), "read_id int, seq string"), index, 15, 11).collect():
        got.setdefault(r.read_id, {})[r.tax_id] = r.kmers
    known = {r.minimizer: r.tax_id for r in index.collect()}
    for i, text in texts.items():
        votes = [known.get(min(brute_minimizers(text[p : p + 15], 15, 11, 0))) for p in range(len(text) - 14)]
        assert got[i] == {t: votes.count(t) for t in set(votes)}
    assert got[1][4] >= 106 and got[2][5] >= 106


def brute_quality_cut(quals, least):
    total = best = cut = 0
    for i, q in enumerate(reversed(quals), 1):
        total += least - q
        if total < 0:
            break
        if total > best:
            best, cut = total, i
    return len(quals) - cut


def test_trimming(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        n = rng.randrange(0, 50)
        rows.append((i, 1, "".join(rng.choice("ACGT") for _ in range(n)), "".join(chr(33 + rng.randrange(0, 41)) for _ in range(n))))
    df = spark.createDataFrame(rows, "read_id int, mate int, seq string, qual string")
    got = {r[0]: r[1] for r in df.select("read_id", R.quality_cut(F.col("qual"), 20)).collect()}
    assert got == {i: brute_quality_cut([ord(c) - 33 for c in q], 20) for i, _, _, q in rows}
    adapter = "AGATCGGAAGAGC"
    cases = {"TTTTT" + adapter + "CC": 5, "TTTTTAGATCGG": 5, "TTTTTAGATCGC": 12, "TTTTTAG": 5, "TTTTTTA": 6, "TTTTT" + "AGATCGGAAGTGC": 5, "": 0, adapter: 0}
    cut = {r.seq: r.cut for r in spark.createDataFrame([(k,) for k in cases], "seq string").select("seq", R.adapter_cut(F.col("seq"), adapter).alias("cut")).collect()}
    assert cut == cases
    assert spark.createDataFrame([("ACGGGGGGGGGGG", "ACAAAA", None)], "a string, b string, c string").select(R.poly_tail(F.col("a")), R.poly_tail(F.col("b"), 3, "GA"), R.poly_tail(F.col("c"))).first()[:] == (2, 2, None)
    pair = spark.createDataFrame([(1, 1, "A" * 40, "I" * 40), (1, 2, "C" * 40, "I" * 10 + "!" * 30), (2, 1, "C" * 40, "I" * 40), (2, 2, "C" * 40, "I" * 40)], df.schema)
    assert sorted((r.read_id, r.mate, len(r.seq)) for r in R.trim_reads(pair, five=2, three=1).collect()) == [(2, 1, 37), (2, 2, 37)]


def write_fastq(path, reads, gz=False, end="\n"):
    text = "".join(f"@{i} x{end}{s}{end}+{end}{'I' * len(s)}{end}" for i, s in reads)
    part = path.with_suffix(path.suffix + ".part")
    part.write_bytes(gzip.compress(text.encode()) if gz else text.encode())
    part.rename(path)


def test_fastq_batches_and_streams(spark, tmp_path):
    spark.dataSource.register(FastqSource)
    shared, own, refs = sequences()
    paths = tree(spark)
    index = R.build_index(spark.createDataFrame(refs, "tax_id int, seq string"), paths, 15, 11)
    folder = tmp_path / "in"
    folder.mkdir()
    write_fastq(folder / "a.fastq", [(f"r{i}", own[3][i : i + 60]) for i in range(5)], end="\r\n")
    write_fastq(folder / "b.fq.gz", [("r0", shared), ("r1", "A" * 50)], gz=True)
    (folder / "c.fastq").write_text("@r0\nACGT\n+\nIIII\nbroken\nACGT\n+\nIIII\n@r1\nAC\n")
    rows = spark.read.format("fastq").load(f"file://{folder}")
    assert sorted((r.file[-8:], r.read_id, r.seq[:4]) for r in rows.collect()) == sorted([("/a.fastq", f"r{i}", own[3][i : i + 4]) for i in range(5)] + [("/b.fq.gz"[-8:], "r0", shared[:4]), ("/b.fq.gz"[-8:], "r1", "AAAA"), ("/c.fastq", "r0", "ACGT")])
    batch = sorted(map(str, C.classify_batch(rows, index, paths, k=15, l=11).collect()))
    out = f"file://{tmp_path}/out"
    stream = lambda: spark.readStream.format("fastq").load(f"file://{folder}")
    run = lambda: C.classify_stream(stream(), index, paths, out, f"file://{tmp_path}/check", trigger={"availableNow": True}, k=15, l=11).awaitTermination(120)
    assert run()
    read = lambda: spark.read.schema(C.CLASSIFIED).parquet(out)
    assert sorted(map(str, read().drop("batch").collect())) == batch and len(batch) == 8
    write_fastq(folder / "d.fastq", [("late", own[5][:70])])
    assert run()
    assert {(r["sample"], r.tax_id) for r in read().collect()} == {("a", 3), ("b", 2), ("b", None), ("c", None), ("d", 5)}
    held = {}
    totals = spark.readStream.schema(C.CLASSIFIED).option("recursiveFileLookup", "true").parquet(out)
    query = C.report_stream(totals, paths, lambda t, i: held.update({i: sorted(map(str, t.collect()))}), f"file://{tmp_path}/check2")
    assert query.awaitTermination(120)
    assert held[max(held)] == sorted(map(str, T.clade_report(C.running_counts(read()), paths).collect()))


def test_pairs_in_one_row(spark):
    shared, own, refs = sequences()
    paths = tree(spark)
    index = R.build_index(spark.createDataFrame(refs, "tax_id int, seq string"), paths, 15, 11)
    rows = spark.createDataFrame([("file:///x/s_R1.fastq", 0, "p", own[3][:50], own[4][:60]), ("file:///x/s_R1.fastq", 1, "p", "A" * 30, own[5][:40])], "file string, pos long, read_id string, seq string, seq2 string")
    got = C.classify_batch(rows, index, paths, paired=True, k=15, l=11).collect()
    assert sorted((r["sample"], r.read_id, r.length, r.tax_id) for r in got) == [("s", "p", 70, 5), ("s", "p", 110, 2)]


def test_progress_of_folders(spark, tmp_path):
    folder = tmp_path / "trim"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}_trimming_report.txt").write_text("x")
    seen = {}
    files = stage_files(spark, f"file://{folder}", "trimming", "*_trimming_report.txt")
    samples = spark.range(4).toDF("sample")
    assert progress_stream(files, samples, lambda t, i: seen.update({i: [tuple(r) for r in t.collect()]}), f"file://{tmp_path}/c", ("trimming",)).awaitTermination(120)
    assert seen[max(seen)] == [("trimming", 3, 1, 3)]
