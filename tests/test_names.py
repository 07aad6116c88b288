"""Golden cases of name cleaning and lineage text."""

from loamframe.functions import names as N
from loamframe.operators import taxonomy as T
from loamframe.sources.sinks import lineage_lines
from pyspark.sql import functions as F


def test_names(spark):
    df = spark.createDataFrame([("ENSG1.5_PAR_Y", "a b/c", " x, ,y,x ", "23,4", "AACGN"), (None, "", "", "?", None)], "g string, n string, l string, d string, s string")
    got = df.select(N.strip_version(F.col("g")), N.strip_version(F.col("g"), True), N.safe_name(F.col("n")), N.comma_list(F.col("l")), N.decimal_comma(F.col("d")), N.reverse_complement(F.col("s"))).collect()
    assert tuple(got[0]) == ("ENSG1", "ENSG1.5_PAR_Y", "a_b_c", ["x", "y"], 23.4, "NCGTT")
    assert tuple(got[1]) == (None, None, "", [], None, None)


def test_lineage_lines(spark):
    nodes = spark.createDataFrame([(1, None, "R", "root"), (2, 1, "D", "A"), (3, 2, "S", "B")], "tax_id int, parent_id int, rank string, name string")
    direct = spark.createDataFrame([("s", 1, 0), ("s", 3, 2), ("s", None, 4)], "sample string, tax_id int, direct_reads long")
    assert [tuple(r) for r in lineage_lines(direct, T.taxonomy_paths(nodes, 3)).collect()] == [("s", "2\troot\tA\tB")]
