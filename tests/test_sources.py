"""File scans on small files."""

from loamframe.operators import taxonomy as T
from loamframe.sources import tables as S


def test_gene_counts(spark, tmp_path):
    (tmp_path / "a.featureCounts.txt").write_text("# made by a tool\nGeneid\tChr\tStart\tEnd\tStrand\tLength\ta.bam\nG1.5\t1\t1\t9\t+\t8\t12\nG2\t1\t1\t9\t+\t8\tNA\n")
    (tmp_path / "b.ReadsPerGene.out.tab").write_text("N_unmapped\t1\t1\t1\nN_multimapping\t1\t1\t1\nN_noFeature\t1\t1\t1\nN_ambiguous\t1\t1\t1\nG1.2\t7\t3\t4\n")
    (tmp_path / "c_salmon").mkdir()
    (tmp_path / "c_salmon" / "quant.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\nG1\t800\t650\t3.1\t12.4\r\n")
    got = []
    for tool, file in (("featurecounts", "a.featureCounts.txt"), ("star", "b.ReadsPerGene.out.tab"), ("salmon", "c_salmon/quant.sf")):
        got += sorted(map(tuple, S.read_gene_counts(spark, f"file://{tmp_path}/{file}", tool).collect()))
    assert got == [("featurecounts", "a", "G1", 12.0), ("featurecounts", "a", "G2", None), ("star", "b", "G1", 7.0), ("salmon", "c", "G1", 12.4)]


def test_metadata_separators(spark, tmp_path):
    for i, text in enumerate(("sample\tgroup\ns;1\tx,y\n", "sample;group\ns;x\n", "sample,group;more\ns,x\n")):
        (tmp_path / f"{i}.csv").write_text(text)
    assert [tuple(S.read_metadata(spark, f"file://{tmp_path}/{i}.csv").first()) for i in range(3)] == [("s;1", "x,y"), ("s", "x"), ("s", "x")]


def test_reports_and_contaminants(spark, tmp_path):
    (tmp_path / "s1.kraken2.report.txt").write_text("  40.00\t4\t4\tU\t0\tunclassified\r\n  60.00\t6\t0\tR\t1\troot\nbroken\tline\n  60.00\t6\t1\tD\t2\t  Bacteria\n")
    rows = S.read_reports(spark, f"file://{tmp_path}/s1.kraken2.report.txt").orderBy("line_no").collect()
    assert [(r["sample"], r.line_no, r.clade_reads, r.direct_reads, r.tax_id, r.name, r.depth) for r in rows] == [("s1", 0, 4, 4, "0", "unclassified", 0), ("s1", 1, 6, 0, "1", "root", 0), ("s1", 3, 6, 1, "2", "Bacteria", 1)]
    (tmp_path / "bad.txt").write_text("562\n\n 9606 \n562\n")
    assert sorted(r.tax_id for r in S.read_contaminants(spark, f"file://{tmp_path}/bad.txt").collect()) == ["562", "9606"]


def test_merge_pairs(spark):
    mates = [("s", "r1", 1, [1, 2, 5], 100), ("s", "r1", 2, [1, 2, 7], 90), ("s", "r2", 1, [1, 2, 5], 100), ("s", "r2", 2, None, 80), ("s", "r3", 1, None, 10)]
    rows = spark.createDataFrame(mates, "sample string, read_id string, mate int, path array<int>, length int")
    got = {r.read_id: (r.tax_id, r.length) for r in T.merge_pairs(rows).collect()}
    assert got == {"r1": (2, 190), "r2": (5, 180), "r3": (None, 10)}


def lines(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(rows) + "\n")


def test_sheets_and_annotation(spark, tmp_path):
    lines(tmp_path / "sheet.csv", "sample,fastq_1,fastq_2,strandedness", "S1,/d/S1_R1_001.fastq.gz,/d/S1_R2_001.fastq.gz,unstranded")
    assert S.read_samplesheet(spark, f"file://{tmp_path}/sheet.csv").first()[:] == ("S1", "/d/S1_R1_001.fastq.gz", "/d/S1_R2_001.fastq.gz", "unstranded")
    lines(tmp_path / "pairs.csv", "comparison_name,control_group,treatment_group", "case_vs_ctl,ctl,case")
    assert S.read_comparisons(spark, f"file://{tmp_path}/pairs.csv").first()[:] == ("case_vs_ctl", "ctl", "case")
    lines(tmp_path / "notes.csv", "sample;lane;sampleType;bmi", "P1;L001;POS;23,4")
    r = S.read_annotation(spark, f"file://{tmp_path}/notes.csv", ("bmi",)).first()
    assert (r["sample"], r.bmi) == ("P1", 23.4)
    lines(tmp_path / "nodes.tsv", "tax_id\tparent_id\trank\tname", "1\t\troot\troot", "2\t1\tdomain\tBacteria")
    assert [(r.tax_id, r.parent_id, r.name) for r in S.read_nodes(spark, f"file://{tmp_path}/nodes.tsv").collect()] == [(1, None, "root"), (2, 1, "Bacteria")]
    lines(tmp_path / "genes.gtf", "#!x", 'c1\tsrc\texon\t10\t20\t.\t+\t.\tgene_id "G1"; x "y";', 'c1\tsrc\tgene\t1\t99\t.\t+\t.\tgene_id "G1";')
    assert [tuple(r) for r in S.read_genes(spark, f"file://{tmp_path}/genes.gtf").collect()] == [("G1", "c1", 10, 20, "+")]
    lines(tmp_path / "symbols.tsv", "gene\tsymbol", "G1\tABC")
    assert S.read_symbols(spark, f"file://{tmp_path}/symbols.tsv").first()[:2] == ("G1", "ABC")
    lines(tmp_path / "sets.csv", "term_id,ontology,gene_id", "GO:1,BP,G1")
    assert S.read_gene_sets(spark, f"file://{tmp_path}/sets.csv").first()[:] == ("GO:1", "BP", "G1")


def test_abundance_and_matrix(spark, tmp_path):
    head = "name\ttaxonomy_id\ttaxonomy_lvl\tkraken_assigned_reads\tadded_reads\tnew_est_reads\tfraction_total_reads"
    lines(tmp_path / "a" / "s1.tsv", head, "E. coli\t562\tS\t10\t2\t12\t0.12", "E. coli\t562\tS\t1\t0\t1\t0.01", "Bacteria\t2\tD\t1\t1\t2\t0.5")
    assert [(r["sample"], r.name, r.tax_id, r.reads, r.fraction) for r in S.read_abundance(spark, f"file://{tmp_path}/a").collect()] == [("s1", "E. coli", "562", 13.0, 0.13)]
    lines(tmp_path / "a" / "s2.bracken.tsv", head, "x\t1\tS\t1\t1\t2\t0.5")
    assert [r["sample"] for r in S.read_abundance(spark, f"file://{tmp_path}/a").collect()] == ["s2.bracken"]
    lines(tmp_path / "b" / "bad.tsv", "name\ttaxonomy_id", "x\t1")
    import pytest

    with pytest.raises(ValueError):
        S.read_abundance(spark, f"file://{tmp_path}/b")
    lines(tmp_path / "m.csv", "id,S1,S2", "g1,1,2", "g2,,x")
    want = [("S1", "g1", 1.0), ("S1", "g2", None), ("S2", "g1", 2.0), ("S2", "g2", None)]
    assert sorted(tuple(r) for r in S.read_matrix(spark, f"file://{tmp_path}/m.csv").collect()) == want
    known = spark.createDataFrame([("g1",), ("g2",), ("S1",)], "sample string")
    assert {r["sample"] for r in S.read_matrix(spark, f"file://{tmp_path}/m.csv", known).collect()} == {"g1", "g2"}


def test_logs(spark, tmp_path):
    lines(tmp_path / "S1_R1_001_trimming_report.txt", "Total reads processed:   1,234", "Reads with adapters:   500 (40.5%)", "Reads written (passing filters):  1,200 (97.2%)", "Quality-trimmed:  3,000 bp (1.2%)", "Total written (filtered):  9,000 bp (88.8%)")
    r = S.read_trimming_reports(spark, f"file://{tmp_path}/S1_R1_001_trimming_report.txt").first()
    assert r[:] == ("S1", "R1", 1234, 40.5, 97.2, 3000, 88.8)
    lines(tmp_path / "x_ribodetector.log", "Processed 10", "\x1b[32mProcessed\x1b[0m 1,000 reads", "Detected 1 non-rRNA", "Detected 900 non-rRNA")
    lines(tmp_path / "y.log", "Total reads processed: 50", "rRNA reads: 20")
    lines(tmp_path / "z.log", "nothing")
    got = S.read_rrna_logs(spark, [f"file://{tmp_path}/{n}" for n in ("x_ribodetector.log", "y.log", "z.log")]).collect()
    assert sorted(tuple(r) for r in got) == [("x", 1000, 100, 900), ("y", 50, 20, 30)]
    files = S.list_artifacts(spark, f"file://{tmp_path}", "*.log").collect()
    assert sorted(r.file for r in files) == ["x_ribodetector.log", "y.log", "z.log"] and all(r.size_mb == 0 for r in files)


def test_read_pairs(spark):
    paths = ["/d/run/P1_S1_L003_1_val_1.fq.gz", "/d/run/P1_S1_L003_2_val_2.fq.gz", "/d/lane/A_S3_R1_001.fastq.gz", "/d/lane/A_S3_R2_001.fastq.gz", "/d/A/A_S3_R1_001.fastq.gz", "/d/A/A_S3_R2_001.fastq.gz", "/d/x/B_R1_001.fastq.gz"]
    got = S.read_pairs(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert sorted((r["sample"], r.fastq_2) for r in got) == [("A_S3", "/d/A/A_S3_R2_001.fastq.gz"), ("A_lane", "/d/lane/A_S3_R2_001.fastq.gz"), ("P1_S1_L003", "/d/run/P1_S1_L003_2_val_2.fq.gz")]


def test_sinks(spark, tmp_path):
    from loamframe.operators import diffexp as D
    from loamframe.operators import reports as P
    from loamframe.sources import sinks as K

    at = lambda name: f"file://{tmp_path}/{name}"
    counts = spark.createDataFrame([("star", "a", "g", 1.0), ("star", "b", "g", 2.0), ("salmon", "a", "h", 3.0)], "tool string, sample string, gene string, n double")
    assert K.combined_matrix(counts, ["star", "salmon"], ["a", "b"]).columns == ["gene", "a_star", "b_star", "a_salmon", "b_salmon"]
    assert K.combined_matrix(counts, ["star"], ["a", "b"]).columns == ["gene", "a", "b"]
    K.write_table(K.tool_matrix(counts, "star", ["a", "b"]), at("matrix"))
    assert spark.read.text(at("matrix")).collect()[1].value == "g\t1.0\t2.0"
    tests = spark.createDataFrame([("k", "a", 2.0, 0.001), ("k", "b", 0.0, None)], "comparison string, gene string, log2_fold_change double, p double")
    K.write_results(D.shape_results(tests), at("dge"))
    K.write_summary(D.shape_results(tests), at("sum"), {"p": 0.05})
    assert spark.read.csv(at("dge/top50"), header=True).count() == 2 and '"significant":1' in spark.read.text(at("sum/summary")).first().value
    long = counts.where("tool = 'star'").select("gene", "sample", "n")
    K.write_normalised(long, spark.createDataFrame([("a", 1.0), ("b", 2.0)], "sample string, size_factor double"), at("norm"), ["a", "b"])
    assert spark.read.csv(at("norm/normalised"), header=True).first()[:] == ("g", "1.0", "1.0")
    report = spark.createDataFrame([("s", 0, 40.0, 4, 4, "U", "0", "unclassified", 0), ("s", 1, 60.0, 6, 0, "R", "1", "root", 0), ("s", 2, 60.0, 6, 6, "D", "2", "Bacteria", 1)], "sample string, line_no int, pct double, clade_reads long, direct_reads long, rank_code string, tax_id string, name string, depth int")
    K.write_report(report, at("report"))
    assert [r.value for r in spark.read.text(at("report/sample=s")).collect()] == [" 40.00\t4\t4\tU\t0\tunclassified", " 60.00\t6\t0\tR\t1\troot", " 60.00\t6\t6\tD\t2\t  Bacteria"]
    assert [r.value for r in P.lineage_text(report, 4).collect()] == ["6\troot\tBacteria"]
    K.write_classification(spark.createDataFrame([("s", "r", 5, 60)], "sample string, read_id string, tax_id int, length int"), at("reads"))
    assert spark.read.text(at("reads/sample=s")).first().value == "C\tr\t5\t60\t1"
    K.write_contaminants(spark.createDataFrame([(562, True), (9, False)], "tax_id int, contaminant boolean"), at("bad"))
    assert [r.value for r in spark.read.text(at("bad")).collect()] == ["562"]
    K.write_enrichment(spark.createDataFrame([("BP", "up", "t", 0.1)], "ontology string, direction string, term string, p double"), at("terms"))
    assert spark.read.csv(at("terms/ontology=BP/direction=up"), header=True).first().term == "t"
    K.write_forest(spark.createDataFrame([(0, 0.9, 0.8, 10, 5)], "fold int, accuracy double, roc_auc double, n_train long, n_test long"), spark.createDataFrame([(0, "g", 1.0)], "fold int, gene string, importance double"), spark.createDataFrame([(1.0, 1), (0.0, 1)], "label double, prediction int"), at("rf"))
    assert spark.read.json(at("rf/summary")).first().mean_accuracy == 0.9 and "0.900" in spark.read.text(at("rf/report")).first().value


def test_skipped_levels_and_zeroed_reports(spark):
    """A level that is missing, and one left behind by a shallower line, are no ancestors."""
    from loamframe.operators import reports as P

    rows = [("s", 0, 4, "U", "0", "unclassified", 0), ("s", 1, 0, "R", "1", "root", 0), ("s", 2, 1, "D", "2", "A", 1), ("s", 3, 2, "S", "3", "B", 3), ("s", 4, 3, "S", "4", "C", 2), ("s", 5, 5, "D", "5", "E", 1), ("s", 6, 1, "S", "6", "F", 3)]
    report = spark.createDataFrame([(s, i, 0.0, 0, n, c, t, name, d) for s, i, n, c, t, name, d in rows], "sample string, line_no int, pct double, clade_reads long, direct_reads long, rank_code string, tax_id string, name string, depth int")
    got = {r.line_no: r.path for r in P.report_lineage(report, 8).collect()}
    assert got == {0: [0], 1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 4], 5: [1, 5], 6: [1, 5, 6]}
    clean = {r.name: (r.clade_reads, r.direct_reads, r.pct) for r in P.decontaminate(report, spark.createDataFrame([("3",)], "tax_id string"), 8).collect()}
    assert clean["A"] == (4, 1, 28.57143) and clean["root"] == (10, 0, 71.42857) and clean["B"] == (0, 0, 0.0)
