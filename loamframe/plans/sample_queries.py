"""Queries on samples and metadata.  Customers and suppliers are samples, segments and nations their groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.functions import names as N
from loamframe.operators import expression as X
from loamframe.operators import samples as S
from loamframe.plans import registry as R


def control_flags(spark: SparkSession, d: str) -> DataFrame:
    """One column that reads as logical words throughout and one that does not."""
    rows = R._table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "TRUE").otherwise("F").alias("a"), F.col("c_mktsegment").alias("b"), (F.col("c_nationkey") % 2).alias("c"))
    rows = rows.withColumn("b", F.when(F.col("c_custkey") % 5 == 0, "Negative control").otherwise(F.col("b")))
    return S.control_flags(S.control_flags(S.control_flags(rows, "a", "by_word"), "b", "by_text"), "c", "by_number").select("c_custkey", "by_word", "by_text", "by_number")


def kept_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_mktsegment")).alias("segment"))
    return S.keep_groups(rows, "segment", "BUILDING", "MACHINERY")


def derived_status(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "customer").select("c_custkey", F.concat(F.lit("L00"), (F.col("c_custkey") % 4 + 1).cast("string")).alias("lane"), F.when(F.col("c_custkey") % 9 == 0, "NEG").otherwise("POS").alias("sampleType"), F.when(F.col("c_custkey") % 11 > 0, F.col("c_acctbal")).alias("outcome"))
    rows = S.annotated(rows, ["L001", "L002"], "NEG", "outcome")
    return rows.select("c_custkey", S.status_by_rules([(F.col("outcome") < 0, "low"), (F.col("outcome") < 5000, "middle")], "high").alias("status"))


def mapped_levels(spark: SparkSession, d: str) -> DataFrame:
    return R._table(spark, d, "customer").groupBy(S.map_levels(F.col("c_mktsegment"), {"BUILDING": "Case", "MACHINERY": "Control"}).alias("level")).agg(F.count(F.lit(1)).alias("samples"))


def id_types(spark: SparkSession, d: str) -> DataFrame:
    """Ids whose first hundred, by one order or another, are of another kind than the rest."""
    part = R._table(spark, d, "part")
    key = F.col("p_partkey").cast("string")
    gene = F.when(F.col("p_size") > 25, F.concat(F.lit("ENSMUSG"), key)).when(F.col("p_retailprice") > 1100, F.concat(F.lit("g"), key)).otherwise(key)
    orders = {"size": "p_size", "shrinking": -F.col("p_size"), "price": "p_retailprice", "key": "p_partkey"}
    # ties are broken by the key, so the order is one
    rank = lambda c: F.struct(F.col(c) if isinstance(c, str) else c, F.col("p_partkey"))
    return S.mixed(*[S.id_type(part.select(gene.alias("gene"), rank(c).alias("at")), "at").withColumn("order", F.lit(k)) for k, c in orders.items()])


def named_genes(spark: SparkSession, d: str) -> DataFrame:
    """Parts with their type as symbol; some have none, others a blank first one."""
    part = R._table(spark, d, "part")
    mapping = part.where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("gene"), F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.col("p_type")).alias("symbol"), F.lit(0).alias("position"))
    second = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("symbol"), F.lit(1).alias("position"))
    return S.named_genes(part.select(F.col("p_partkey").alias("gene")), mapping.union(second)).select("gene", "gene_name")


def unique_names(spark: SparkSession, d: str) -> DataFrame:
    return S.unique_names(R._table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("name")), "name", ["s_suppkey"])


def sample_order(spark: SparkSession, d: str) -> DataFrame:
    groups = R._groups(spark, d).withColumn("group", F.when(F.col("group") == "ASIA", "CTL").when(F.col("group") == "EUROPE", "CASES").otherwise(F.col("group")))
    return S.in_sample_order(groups)


def counts_with_metadata(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    return S.with_metadata(counts, R._groups(spark, d).where("sample % 2 = 0")).groupBy("group").agg(F.sum("n").alias("n"), F.count_distinct("sample").alias("samples"))


def aligned_tables(spark: SparkSession, d: str) -> DataFrame:
    events = R._table(spark, d, "events").select(F.col("user_id").alias("sample"), "value")
    orders = R._table(spark, d, "orders").select(F.col("o_custkey").alias("sample"), F.col("o_totalprice").alias("value"))
    a, b = S.aligned(events, orders)
    labels = R._table(spark, d, "customer").select(F.col("c_custkey").alias("sample"), F.col("c_mktsegment").alias("label"))
    both = S.mixed(a.withColumn("origin", F.lit("events")), b.withColumn("origin", F.lit("orders")))
    return S.with_labels(both, labels).groupBy("origin", "label").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("sample").alias("samples"))


def metadata_for_samples(spark: SparkSession, d: str) -> DataFrame:
    samples = R._table(spark, d, "events").select(F.col("user_id").alias("sample"))
    metadata = R._table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("sample"), F.col("c_mktsegment").alias("segment"))
    return S.metadata_for(samples, metadata)


def level_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 5 > 0, (F.col("c_nationkey") % 3).cast("string")).otherwise(" ").alias("lane"), F.lit("one").alias("same"))
    return X.pairs_by_appearance(rows, ["segment", "lane", "same"], "c_custkey")


def column_statistics(spark: SparkSession, d: str) -> DataFrame:
    out = S.column_statistics(R._table(spark, d, "supplier").select("s_nationkey", F.round("s_acctbal", 2).alias("s_acctbal"), F.substring("s_name", -1, 1).alias("digit")))
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "q1", "median", "q3", "max")}).drop("top")


def stage_progress(spark: SparkSession, d: str) -> DataFrame:
    events = R._table(spark, d, "events").where("value > 0").select(F.col("event_type").alias("stage")).where("stage <> 'signup'")
    return S.progress(events, R._table(spark, d, "customer"), ("click",))


def substring_matches(spark: SparkSession, d: str) -> DataFrame:
    """Segment names cut short are reports; nations and segments the sheet."""
    reports = R._table(spark, d, "customer").select(F.expr("substring(c_mktsegment, 1, 4 + c_custkey % 6)").alias("name")).distinct()
    sheet = R._table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("sample")).agg(F.min("c_custkey").alias("position"))
    sheet = sheet.unionByName(R._table(spark, d, "region").select(F.substring("r_name", 1, 2).alias("sample"), (F.col("r_regionkey") + 1000000).cast("long").alias("position")))
    return S.match_either_way(reports, sheet).select("name", "matched")


def trimming_table(spark: SparkSession, d: str) -> DataFrame:
    """Line status stands for the mate, the ship month for the sample."""
    rows = R._table(spark, d, "lineitem").select(F.concat(F.lit("S"), F.month("l_shipdate").cast("string"), F.lit("x")).alias("name"), F.when(F.col("l_linestatus") == "O", "R1").otherwise("R2").alias("mate"), "l_quantity", "l_tax")
    reports = rows.groupBy("name", "mate").agg(F.count(F.lit(1)).alias("total_reads"))
    sheet = rows.groupBy("name", "mate").agg((F.sum("l_quantity") / 997).alias("input_mb")).select(F.expr("substring(name, 1, length(name) - 1)").alias("sample"), F.expr("cast(substring(name, 2, length(name) - 2) as int)").alias("position"), "mate", "input_mb")
    outputs = rows.where("l_tax > 0.02").groupBy("name", "mate").agg((F.sum("l_quantity") / 907).alias("kept_mb"))
    return S.trimming_summary(reports, sheet, outputs).select("name", "mate", "total_reads", "matched", "input_mb", "kept_mb", "reduced_mb")


def rrna_shares(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("sample")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l_linestatus") == "O").alias("rrna"))
    return S.rrna_share(rows)


def sample_names(spark: SparkSession, d: str) -> DataFrame:
    """File names made from keys, cleaned again."""
    k = F.col("s_suppkey")
    stem = F.concat(F.lit("s"), k.cast("string"), F.when(k % 3 == 0, "_R1_001").when(k % 3 == 1, "_1").otherwise(""))
    file = F.concat(F.lit("/x/y/"), stem, F.when(k % 2 == 0, ".fastq.gz").otherwise(".fq"))
    report = F.concat(F.lit("/r/s"), k.cast("string"), F.when(k % 2 == 0, ".kraken2.report.txt").otherwise(".report"))
    name = F.concat(k.cast("string"), F.lit("-a b"))
    return R._table(spark, d, "supplier").select("s_suppkey", N.fastq_sample(file, True).alias("pair"), N.fastq_sample(file, False).alias("single"), N.report_sample(report).alias("report"), N.syntactic_name(name).alias("valid"), N.grouped_number(F.format_number(k * 12345, 0)).alias("grouped"), N.percent_number(F.concat(F.lit(" "), k.cast("string"), F.lit(".5 %"))).alias("share"))


def dataflow(spark: SparkSession, d: str) -> DataFrame:
    """Set operations on ids, a default for an empty table, an optional stage and lists of ids."""
    a = R._table(spark, d, "customer").select(F.col("c_nationkey").alias("sample")).distinct()
    b = R._table(spark, d, "supplier").select(F.col("s_nationkey").alias("sample")).distinct()
    parts = [("both", S.in_both(a, b)), ("first", S.only_in_first(a, b)), ("none", S.if_empty(a.where("sample < 0"), b.where("sample < 3"))), ("some", S.if_empty(a.where("sample < 5"), b))]
    made = S.mixed(*[t.select(F.lit(k).alias("kind"), F.col("sample")) for k, t in parts])
    made = S.optional(made, (True, lambda t: S.with_suffix(t, "sample", ".x")), (False, lambda t: t.limit(0)))
    return S.gathered(made, "kind", "sample").select("kind", F.array_join("values", ",").alias("samples"))


def numeric_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_nationkey") > 5, F.col("s_acctbal")).alias("x"), F.when(F.col("s_nationkey") > 9, F.col("s_nationkey")).alias("y"))
    return X.numeric_or_zero(rows, "s_suppkey").withColumn("x", F.round("x", 2))


def finite_rows(spark: SparkSession, d: str) -> DataFrame:
    """Genes whose values are finite everywhere and vary."""
    v = F.when(F.col("p_size") % 17 == 0, F.lit(float("nan"))).when(F.col("p_size") % 19 == 0, F.lit(float("inf"))).otherwise(F.col("p_size").cast("double"))
    rows = R._table(spark, d, "part").select((F.col("p_partkey") % 300).alias("gene"), "p_partkey", v.alias("v"))
    return X.varying(rows).groupBy("gene").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("v"))


def summed_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_returnflag").alias("name"), F.col("l_quantity").alias("n"))
    return S.at_least(X.sum_by(rows, "sample", "name"), "n", 1000)


QUERIES = (
    control_flags, kept_groups, derived_status, mapped_levels, id_types, named_genes, unique_names, sample_order, counts_with_metadata, aligned_tables, metadata_for_samples, level_pairs,
    column_statistics, stage_progress, substring_matches, trimming_table, rrna_shares, sample_names, dataflow, numeric_columns, finite_rows, summed_rows,
)

SQL = {
    "control_flags": "SELECT c_custkey, c_custkey % 3 = 0 AS by_word, CASE WHEN c_custkey % 5 = 0 THEN true ELSE regexp_matches(c_mktsegment, '(?i)neg|control|true|yes|1') END AS by_text, c_nationkey % 2 <> 0 AS by_number FROM customer",
    "kept_groups": "SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "derived_status": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'high' END AS status FROM customer WHERE c_custkey % 4 < 2 AND c_custkey % 9 <> 0 AND c_custkey % 11 > 0 AND c_acctbal IS NOT NULL",
    "mapped_levels": "SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'Case' WHEN 'MACHINERY' THEN 'Control' ELSE c_mktsegment END AS level, count(*) AS samples FROM customer GROUP BY 1",
    "id_types": " UNION ALL ".join(
        f"""SELECT CASE WHEN bool_or(regexp_matches(gene, '^ENS[A-Z]*G')) THEN 'ENSEMBL' WHEN bool_and(regexp_matches(gene, '^[0-9]+$')) THEN 'ENTREZID' ELSE 'SYMBOL' END AS id_type, '{name}' AS "order" FROM (
SELECT CASE WHEN p_size > 25 THEN 'ENSMUSG' || p_partkey WHEN p_retailprice > 1100 THEN 'g' || p_partkey ELSE p_partkey::VARCHAR END AS gene FROM part ORDER BY {by}, p_partkey LIMIT 100)"""
        for name, by in (("size", "p_size"), ("shrinking", "p_size DESC"), ("price", "p_retailprice"), ("key", "p_partkey"))
    ),
    "named_genes": """
WITH m AS (SELECT p_partkey AS gene, CASE WHEN p_partkey % 4 > 0 AND p_partkey % 3 <> 0 THEN p_type WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_partkey::VARCHAR END AS s FROM part),
k AS (SELECT gene, s, row_number() OVER (PARTITION BY s ORDER BY gene) - 1 AS k FROM m) SELECT gene, CASE WHEN k > 0 THEN s || '.' || k ELSE s END AS gene_name FROM k""",
    "unique_names": "WITH k AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS k FROM supplier) SELECT s_suppkey, CASE WHEN k > 0 THEN s_nationkey || '.' || k ELSE s_nationkey::VARCHAR END AS name FROM k",
    "sample_order": f"WITH {R._GROUPS}, g AS (SELECT sample, CASE grp WHEN 'ASIA' THEN 'CTL' WHEN 'EUROPE' THEN 'CASES' ELSE grp END AS g FROM groups) SELECT sample, g AS \"group\", (row_number() OVER (ORDER BY CASE g WHEN 'CTL' THEN 0 WHEN 'CASES' THEN 1 ELSE 2 END, sample))::INT AS position FROM g",
    "counts_with_metadata": f"{R._COUNTS}, {R._GROUPS} SELECT grp AS \"group\", sum(n) AS n, count(DISTINCT sample) AS samples FROM counts JOIN groups USING (sample) WHERE sample % 2 = 0 GROUP BY 1",
    "aligned_tables": """
WITH x AS (SELECT 'events' AS origin, user_id AS sample FROM events WHERE user_id IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'orders', o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events))
SELECT origin, c_mktsegment AS label, count(*) AS rows, count(DISTINCT sample) AS samples FROM x JOIN customer ON sample = c_custkey GROUP BY 1, 2""",
    "metadata_for_samples": "SELECT sample, c_mktsegment AS segment FROM (SELECT DISTINCT user_id AS sample FROM events) LEFT JOIN customer ON sample = c_custkey AND c_custkey % 3 > 0",
    "level_pairs": """
WITH l AS (SELECT 'segment' AS g, c_mktsegment AS v, min(c_custkey) AS k FROM customer GROUP BY 2 UNION ALL SELECT 'lane', (c_nationkey % 3)::VARCHAR, min(c_custkey) FROM customer WHERE c_custkey % 5 > 0 GROUP BY 2)
SELECT a.g AS group_column, a.v AS control, b.v AS treatment FROM l a JOIN l b ON a.g = b.g AND (a.k, a.v) < (b.k, b.v)""",
    "column_statistics": """
WITH t AS (SELECT s_nationkey, round(s_acctbal, 2) AS s_acctbal, right(s_name, 1) AS digit FROM supplier)
SELECT 's_nationkey' AS "column", count(*) AS count, count(DISTINCT s_nationkey) AS "unique", (SELECT max(c) FROM (SELECT count(*) AS c FROM t GROUP BY s_nationkey)) AS freq, round(avg(s_nationkey), 4) AS mean, round(stddev_samp(s_nationkey), 4) AS std,
  min(s_nationkey)::DOUBLE AS min, quantile_cont(s_nationkey::DOUBLE, 0.25) AS q1, quantile_cont(s_nationkey::DOUBLE, 0.5) AS median, quantile_cont(s_nationkey::DOUBLE, 0.75) AS q3, max(s_nationkey)::DOUBLE AS max FROM t
UNION ALL SELECT 's_acctbal', count(*), count(DISTINCT s_acctbal), (SELECT max(c) FROM (SELECT count(*) AS c FROM t GROUP BY s_acctbal)), round(avg(s_acctbal), 4), round(stddev_samp(s_acctbal), 4), min(s_acctbal), round(quantile_cont(s_acctbal, 0.25), 4), round(quantile_cont(s_acctbal, 0.5), 4), round(quantile_cont(s_acctbal, 0.75), 4), max(s_acctbal) FROM t
UNION ALL SELECT 'digit', count(*), count(DISTINCT digit), (SELECT max(c) FROM (SELECT count(*) AS c FROM t GROUP BY digit)), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM t""",
    "stage_progress": """
WITH s AS (SELECT event_type AS stage, count(*) AS artifacts FROM events WHERE value > 0 AND event_type <> 'signup' GROUP BY 1), c AS (SELECT *, CASE WHEN stage = 'click' THEN artifacts // 2 ELSE artifacts END AS completed FROM s)
SELECT stage, artifacts, completed, greatest(0, (SELECT count(*) FROM customer) - completed) AS processing FROM c""",
    "substring_matches": """
WITH r AS (SELECT DISTINCT substring(c_mktsegment, 1, (4 + c_custkey % 6)::INT) AS name FROM customer),
s AS (SELECT c_mktsegment AS sample, min(c_custkey) AS position FROM customer GROUP BY 1 UNION ALL SELECT substring(r_name, 1, 2), r_regionkey + 1000000 FROM region)
SELECT name, arg_min(sample, position) AS matched FROM r LEFT JOIN s ON contains(name, sample) OR contains(sample, name) GROUP BY 1""",
    "trimming_table": """
WITH r AS (SELECT month(l_shipdate) AS m, CASE WHEN l_linestatus = 'O' THEN 'R1' ELSE 'R2' END AS mate, count(*) AS total_reads, sum(l_quantity) / 997 AS i, sum(l_quantity) FILTER (l_tax > 0.02) / 907 AS k FROM lineitem GROUP BY 1, 2),
x AS (SELECT a.m, a.mate, a.total_reads, a.k, b.m AS bm, b.i FROM r a JOIN r b ON a.mate = b.mate AND (contains('S' || a.m || 'x', 'S' || b.m)) QUALIFY row_number() OVER (PARTITION BY a.m, a.mate ORDER BY b.m) = 1)
SELECT 'S' || m || 'x' AS name, mate, total_reads, 'S' || bm AS matched, round(i, 2) AS input_mb, round(coalesce(k, 0), 2) AS kept_mb, round(greatest(0.0, i - coalesce(k, 0)), 2) AS reduced_mb FROM x""",
    "rrna_shares": "SELECT l_suppkey AS sample, count(*) AS total, count(*) FILTER (l_linestatus = 'O') AS rrna, round(count(*) FILTER (l_linestatus = 'O') * 100.0 / count(*), 2)::DOUBLE AS rrna_pct FROM lineitem GROUP BY 1",
    "sample_names": """SELECT s_suppkey, 's' || s_suppkey AS pair, 's' || s_suppkey || CASE s_suppkey % 3 WHEN 0 THEN '_R1_001' WHEN 1 THEN '_1' ELSE '' END AS single, 's' || s_suppkey AS report,
'X' || s_suppkey || '.a.b' AS valid, s_suppkey * 12345 AS "grouped", s_suppkey + 0.5::DOUBLE AS share FROM supplier""",
    "dataflow": """
WITH a AS (SELECT DISTINCT c_nationkey AS s FROM customer), b AS (SELECT DISTINCT s_nationkey AS s FROM supplier),
x AS (SELECT 'both' AS kind, s FROM a WHERE s IN (SELECT s FROM b) UNION ALL SELECT 'first', s FROM a WHERE s NOT IN (SELECT s FROM b) UNION ALL SELECT 'none', s FROM b WHERE s < 3 UNION ALL SELECT 'some', s FROM a WHERE s < 5)
SELECT kind, string_agg(s || '.x', ',' ORDER BY s || '.x') AS samples FROM x GROUP BY 1""",
    "numeric_columns": "SELECT s_suppkey, CASE WHEN s_nationkey > 5 THEN round(s_acctbal, 2) ELSE 0 END AS x, CASE WHEN s_nationkey > 9 THEN s_nationkey ELSE 0 END AS y FROM supplier",
    "finite_rows": "SELECT p_partkey % 300 AS gene, count(*) AS rows, sum(p_size)::DOUBLE AS v FROM part GROUP BY 1 HAVING count(*) FILTER (p_size % 17 = 0 OR p_size % 19 = 0) = 0 AND var_samp(p_size) > 0",
    "summed_rows": "SELECT l_suppkey AS sample, l_returnflag AS name, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2 HAVING sum(l_quantity) >= 1000",
}
