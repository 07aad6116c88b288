"""Named queries of the library and, where SQL can say the same, their DuckDB text.

The driver's star-schema tables stand for biology: region, nation and supplier
are the taxonomy, line items are reads, brands are genes, regions are groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.operators import enrichment as E
from loamframe.operators import expression as X
from loamframe.operators import intervals as I
from loamframe.operators import taxonomy as T
from loamframe.streaming.status import stage_status as status


_COUNTS = "WITH counts AS (SELECT p_brand AS gene, l_suppkey AS sample, sum(l_quantity) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
_GROUPS = "groups AS (SELECT s_suppkey AS sample, r_name AS grp FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_TOTALS = "WITH g AS (SELECT l_returnflag AS comparison, l_partkey AS gene, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2), sets AS (SELECT p_type || ' ' || p_size AS term, p_partkey AS gene FROM part)"
_SPARSE = "WITH counts AS (SELECT l_partkey AS gene, l_suppkey AS sample, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2)"




def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _paths(spark: SparkSession, d: str) -> DataFrame:
    node = lambda t, i, p, r, n: _table(spark, d, t).select(F.expr(i).cast("int").alias("tax_id"), F.expr(p).cast("int").alias("parent_id"), F.lit(r).alias("rank"), F.col(n).alias("name"))
    root = spark.range(1).select(F.lit(1).alias("tax_id"), F.lit(None).cast("int").alias("parent_id"), F.lit("root").alias("rank"), F.lit("root").alias("name"))
    nodes = root.unionByName(node("region", "100 + r_regionkey", "1", "domain", "r_name")).unionByName(node("nation", "1000 + n_nationkey", "100 + n_regionkey", "genus", "n_name"))
    return T.taxonomy_paths(nodes.unionByName(node("supplier", "1000000 + s_suppkey", "1000 + s_nationkey", "species", "s_name")), 4)


def _direct(spark: SparkSession, d: str) -> DataFrame:
    return T.direct_counts(_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), F.expr("CASE WHEN l_tax <> 0 THEN CAST(1000000 + l_suppkey AS INT) END").alias("tax_id")))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").join(_table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_brand").alias("gene"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("n"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "supplier").join(_table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("sample"), F.col("r_name").alias("group"))


def clade_report(spark: SparkSession, d: str) -> DataFrame:
    return T.clade_report(_direct(spark, d), _paths(spark, d))


def decontaminated_report(spark: SparkSession, d: str) -> DataFrame:
    bad = _table(spark, d, "supplier").where("s_suppkey % 10 = 3").select((F.col("s_suppkey") + 1000000).cast("int").alias("tax_id"))
    return T.clade_report(T.drop_contaminants(_direct(spark, d), bad), _paths(spark, d))


def domain_composition(spark: SparkSession, d: str) -> DataFrame:
    return T.composition(clade_report(spark, d), {"first": 100, "second": 101}, 1)


def classify_lca(spark: SparkSession, d: str) -> DataFrame:
    hits = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("pos"), (F.col("l_suppkey") + 1000000).cast("int").alias("tax_id"))
    return T.classify_reads(hits.join(_paths(spark, d).select("tax_id", "path"), "tax_id").select("read_id", "pos", "path")).select("read_id", "hit_count", "tax_id")


def prevalence_counts(spark: SparkSession, d: str) -> DataFrame:
    samples = _groups(spark, d).select("sample", (F.col("group") == "ASIA").alias("is_control"))
    counts = _table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("tax_id"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("n"))
    return T.prevalence_counts(counts, samples)


def merge_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.concat_ws("_", "l_returnflag", "l_linestatus").alias("sample"), F.col("l_quantity").alias("n"))
    return X.merge_counts(rows, ["A_F", "N_F", "N_O", "R_F"])


def cpm(spark: SparkSession, d: str) -> DataFrame:
    return X.cpm(_counts(spark, d)).withColumn("cpm", F.round("cpm", 4))


def low_count_filter(spark: SparkSession, d: str) -> DataFrame:
    return X.low_count_filter(_counts(spark, d), 40000.0, 3)


def size_factors(spark: SparkSession, d: str) -> DataFrame:
    counts = _counts(spark, d)
    return X.size_factors(counts).withColumn("size_factor", F.round("size_factor", 4))


def gene_zscore(spark: SparkSession, d: str) -> DataFrame:
    return X.z_scores(_counts(spark, d).withColumn("v", F.log2(F.col("n") + 1)), "v").select("gene", "sample", F.round("z", 4).alias("z"))


def welch_stats(spark: SparkSession, d: str) -> DataFrame:
    out = X.welch(_counts(spark, d), X.all_pairs(_groups(spark, d)), _groups(spark, d))
    return out.select("comparison", "gene", *[F.round(c, 4).alias(c) for c in ("mean_control", "mean_treatment", "log2_fold_change", "t_stat", "df")])


def bh_adjust(spark: SparkSession, d: str) -> DataFrame:
    tests = _table(spark, d, "part").select("p_partkey", F.col("p_type").alias("comparison"), (F.col("p_retailprice") / 2500).alias("p"))
    return X.benjamini_hochberg(tests, "comparison").select("p_partkey", "comparison", F.round("padj", 4).alias("padj"))


def bonferroni(spark: SparkSession, d: str) -> DataFrame:
    tests = _table(spark, d, "part").select("p_partkey", F.col("p_type").alias("comparison"), (F.col("p_retailprice") / 1e6).alias("p"))
    return X.bonferroni(tests, "comparison").select("p_partkey", F.round("padj", 4).alias("padj"))


def prevalence_filter(spark: SparkSession, d: str) -> DataFrame:
    counts = _table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("n"))
    return X.prevalence_filter(counts, _table(spark, d, "supplier").count(), 0.02).withColumn("prevalence", F.round("prevalence", 4))


def variance_filter(spark: SparkSession, d: str) -> DataFrame:
    return X.variance_filter(_counts(spark, d), 100.0, X.sample_count(_counts(spark, d))).withColumn("variance", F.round("variance", 4))


def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    counts = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("n"))
    lengths = _table(spark, d, "part").select(F.col("p_partkey").alias("gene"), (F.col("p_size") * 100).alias("length"))
    return X.coverage_summary(counts, lengths, 150).select("sample", F.round("mean_coverage", 4).alias("mean_coverage"), F.round("median_coverage", 4).alias("median_coverage"), "genes")


def relative_abundance_top10(spark: SparkSession, d: str) -> DataFrame:
    counts = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("gene"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("n"))
    return X.relative_abundance(counts, 10).withColumn("share", F.round("share", 6))


def stage_status(spark: SparkSession, d: str) -> DataFrame:
    return status(_table(spark, d, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("size")))


def log_cpm(spark: SparkSession, d: str) -> DataFrame:
    return X.log_cpm(_counts(spark, d)).withColumn("log_cpm", F.round("log_cpm", 4))


def _gene_totals(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("comparison"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("n"))


def _sets(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.concat_ws(" ", "p_type", "p_size").alias("term"), F.col("p_partkey").alias("gene"))


def overlap_counts(spark: SparkSession, d: str) -> DataFrame:
    return E.overlap_counts(_gene_totals(spark, d).withColumn("hit", F.col("n") > 250), _sets(spark, d))


def enrichment_scores(spark: SparkSession, d: str) -> DataFrame:
    return E.enrichment_scores(_gene_totals(spark, d).withColumn("stat", F.col("n") - 200), _sets(spark, d), 2, 500).withColumn("score", F.round("score", 4))


def feature_counts(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read"), F.col("l_linestatus").alias("contig"), F.floor("l_extendedprice").alias("start"), F.floor(F.col("l_extendedprice") + F.col("l_quantity")).alias("end"))
    exons = _table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.when(F.col("p_partkey") % 2 == 0, "F").otherwise("O").alias("contig"), (F.col("p_partkey") * 37).alias("start"), (F.col("p_partkey") * 37 + F.col("p_size") * 10).alias("end"))
    return I.count_features(reads, exons)


_ALL = (log_cpm, overlap_counts, enrichment_scores, feature_counts, clade_report, decontaminated_report, domain_composition, classify_lca, prevalence_counts, merge_counts, cpm, low_count_filter, size_factors, gene_zscore, welch_stats, bh_adjust, bonferroni, prevalence_filter, variance_filter, coverage_summary, relative_abundance_top10, stage_status)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from loamframe.plans import profile_queries, read_queries, result_queries, sample_queries, taxonomy_queries

    more = [f for m in (result_queries, taxonomy_queries, sample_queries, read_queries, profile_queries) for f in m.QUERIES]
    return {f.__name__: f for f in (*_ALL, *more)}


def _welch(counts: str) -> str:
    """Means, fold change, t and degrees of freedom of all pairs of groups; missing cells are zeros."""
    return f"""
{counts}, {_GROUPS}, size AS (SELECT grp, count(*) AS k FROM groups GROUP BY 1),
pairs AS (SELECT a.grp AS c, b.grp AS t FROM size a JOIN size b ON a.grp < b.grp),
g AS (SELECT gene, grp, sum(n) / max(k) AS m, count(n) * var_pop(n) + count(n) * (avg(n) - sum(n) / max(k)) ** 2 + (max(k) - count(n)) * (sum(n) / max(k)) ** 2 AS ss FROM counts JOIN groups USING (sample) JOIN size USING (grp) GROUP BY 1, 2),
j AS (SELECT t || '_vs_' || c AS comparison, genes.gene, coalesce(x.m, 0) AS mc, coalesce(y.m, 0) AS mt, sc.k AS kc, st.k AS kt, coalesce(x.ss, 0) / nullif(sc.k - 1, 0) AS vc, coalesce(y.ss, 0) / nullif(st.k - 1, 0) AS vt
  FROM (SELECT DISTINCT gene FROM g) genes CROSS JOIN pairs JOIN size sc ON sc.grp = c JOIN size st ON st.grp = t LEFT JOIN g x ON x.grp = c AND x.gene = genes.gene LEFT JOIN g y ON y.grp = t AND y.gene = genes.gene)
SELECT comparison, gene, round(mc, 4) AS mean_control, round(mt, 4) AS mean_treatment, round(log2((mt + 1) / (mc + 1)), 4) AS log2_fold_change,
  CASE WHEN kc > 1 AND kt > 1 THEN round(CASE WHEN vc = 0 AND vt = 0 THEN 0 ELSE (mc - mt) / nullif(sqrt(vc / kc + vt / kt), 0) END, 4) END AS t_stat,
  CASE WHEN kc > 1 AND kt > 1 THEN round((vc / kc + vt / kt) ** 2 / nullif((vc / kc) ** 2 / nullif(kc - 1, 0) + (vt / kt) ** 2 / nullif(kt - 1, 0), 0), 4) END AS df FROM j"""


def _report(zero: str) -> str:
    return f"""
WITH leaf AS (SELECT l_returnflag AS sample, CASE WHEN l_tax <> 0 THEN l_suppkey END AS s FROM lineitem),
direct AS (SELECT sample, s, {zero} AS direct_reads FROM leaf GROUP BY sample, s),
lin AS (SELECT sample, direct_reads, s_suppkey, s_name, n_nationkey, n_name, r_regionkey, r_name FROM direct JOIN supplier ON s = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
nodes AS (
  SELECT sample, (1000000 + s_suppkey)::INT AS tax_id, 'species' AS rank, s_name AS name, 4 AS depth, sum(direct_reads) AS clade_reads, sum(direct_reads) AS direct_reads FROM lin GROUP BY ALL
  UNION ALL SELECT sample, 1000 + n_nationkey, 'genus', n_name, 3, sum(direct_reads), 0 FROM lin GROUP BY ALL
  UNION ALL SELECT sample, 100 + r_regionkey, 'domain', r_name, 2, sum(direct_reads), 0 FROM lin GROUP BY ALL
  UNION ALL SELECT sample, 1, 'root', 'root', 1, sum(direct_reads), 0 FROM lin GROUP BY sample
  UNION ALL SELECT sample, 0, 'unclassified', 'unclassified', 0, direct_reads, direct_reads FROM direct WHERE s IS NULL
), total AS (SELECT sample, sum(direct_reads) AS total FROM direct GROUP BY sample)
SELECT sample, tax_id, rank, name, depth, clade_reads::BIGINT AS clade_reads, direct_reads::BIGINT AS direct_reads, round(clade_reads * 100.0 / total, 4)::DOUBLE AS pct FROM nodes JOIN total USING (sample)
"""


def oracle_sql() -> dict[str, str]:
    from loamframe.plans import profile_queries, read_queries, result_queries, sample_queries, taxonomy_queries

    plain = _report("count(*)")
    own = {
        "log_cpm": f"""
{_COUNTS}, t AS (SELECT sample, sum(n) AS size FROM counts GROUP BY 1), p AS (SELECT sample, size, 2 * size / (SELECT avg(size) FROM t) AS p FROM t)
SELECT gene, sample, round(log2((n + p) * 1e6 / (size + 2 * p)), 4) AS log_cpm FROM counts JOIN p USING (sample)""",
        "overlap_counts": f"""
{_TOTALS} SELECT comparison, term, count(*) FILTER (n > 250) AS set_hits, count(*) AS set_size, any_value(hits) AS hits, any_value(universe) AS universe
FROM g JOIN sets USING (gene) JOIN (SELECT comparison, count(*) FILTER (n > 250) AS hits, count(*) AS universe FROM g GROUP BY 1) USING (comparison) GROUP BY 1, 2""",
        "enrichment_scores": f"""
{_TOTALS}, r AS (SELECT comparison, gene, n - 200 AS stat, row_number() OVER (PARTITION BY comparison ORDER BY n DESC, gene) AS rank, count(*) OVER (PARTITION BY comparison) AS genes FROM g),
z AS (SELECT comparison, term, count(*) AS k, sum(abs(stat)) AS s FROM r JOIN sets USING (gene) GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 500 AND sum(abs(stat)) > 0),
f AS (SELECT r.comparison, z.term, rank, k, CASE WHEN x.gene IS NOT NULL THEN abs(stat) / s ELSE -1.0 / (genes - k) END AS step FROM r JOIN z USING (comparison) LEFT JOIN sets x ON x.term = z.term AND x.gene = r.gene WHERE k < genes),
c AS (SELECT *, sum(step) OVER (PARTITION BY comparison, term ORDER BY rank ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT comparison, term, any_value(k) AS set_size, round(CASE WHEN max(run) >= -min(run) THEN max(run) ELSE min(run) END, 4) AS score FROM c GROUP BY 1, 2""",
        "feature_counts": """
WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS read, l_linestatus AS contig, floor(l_extendedprice) AS s, floor(l_extendedprice + l_quantity) AS e FROM lineitem),
x AS (SELECT p_partkey AS gene, CASE WHEN p_partkey % 2 = 0 THEN 'F' ELSE 'O' END AS contig, p_partkey * 37 AS s, p_partkey * 37 + p_size * 10 AS e FROM part),
m AS (SELECT read, min(gene) AS gene FROM a JOIN x ON a.contig = x.contig AND a.s <= x.e AND x.s <= a.e GROUP BY read HAVING count(DISTINCT gene) = 1)
SELECT gene, count(*) AS n FROM m GROUP BY 1""",
        "clade_report": plain,
        "decontaminated_report": _report("CASE WHEN s % 10 = 3 THEN 0 ELSE count(*) END"),
        "domain_composition": f"""
SELECT sample, first, second, unclassified, greatest(0, root_reads - first - second) AS other, root_reads + unclassified AS total FROM (
  SELECT sample, max(CASE WHEN tax_id = 100 THEN clade_reads ELSE 0 END) AS first, max(CASE WHEN tax_id = 101 THEN clade_reads ELSE 0 END) AS second,
         max(CASE WHEN tax_id = 1 THEN clade_reads ELSE 0 END) AS root_reads, max(CASE WHEN tax_id = 0 THEN clade_reads ELSE 0 END) AS unclassified FROM ({plain}) GROUP BY sample)""",
        "classify_lca": """
WITH hits AS (SELECT l_orderkey AS read_id, s_suppkey, n_nationkey, r_regionkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ordered AS (SELECT l_orderkey AS read_id, count(*) AS hit_count, list([1, 100 + r_regionkey, 1000 + n_nationkey, 1000000 + s_suppkey] ORDER BY l_linenumber, r_regionkey, n_nationkey, s_suppkey) AS paths
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT read_id, hit_count, (list_reduce(paths, lambda held, hit: CASE WHEN len(hit) > len(held) THEN hit WHEN len(hit) = len(held) AND hit <> held THEN list_filter(held, lambda x: list_contains(hit, x)) ELSE held END)[-1])::INT AS tax_id FROM ordered""",
        "prevalence_counts": f"""
{_SPARSE.replace('gene', 'tax_id')}, {_GROUPS},
t AS (SELECT count(*) FILTER (grp = 'ASIA') AS controls, count(*) FILTER (grp <> 'ASIA') AS others FROM groups),
p AS (SELECT tax_id, count(*) FILTER (grp = 'ASIA') AS c, count(*) FILTER (grp <> 'ASIA') AS o FROM counts JOIN groups USING (sample) WHERE n > 0 GROUP BY 1)
SELECT tax_id, c AS control_present, controls - c AS control_absent, o AS other_present, others - o AS other_absent FROM p, t""",
        "merge_counts": """
SELECT l_partkey AS gene, sum(l_quantity) FILTER (k = 'A_F') AS "A_F", sum(l_quantity) FILTER (k = 'N_F') AS "N_F", sum(l_quantity) FILTER (k = 'N_O') AS "N_O", sum(l_quantity) FILTER (k = 'R_F') AS "R_F"
FROM (SELECT *, l_returnflag || '_' || l_linestatus AS k FROM lineitem) GROUP BY 1""",
        "cpm": f"{_COUNTS} SELECT gene, sample, n, round(n * 1e6 / sum(n) OVER (PARTITION BY sample), 4) AS cpm FROM counts",
        "low_count_filter": f"{_COUNTS}, c AS (SELECT gene, n * 1e6 / sum(n) OVER (PARTITION BY sample) AS cpm FROM counts) SELECT gene, count(*) FILTER (cpm > 40000) AS samples_above FROM c GROUP BY 1 HAVING count(*) FILTER (cpm > 40000) >= 3",
        "size_factors": f"""
{_COUNTS}, p AS (SELECT gene, avg(ln(n)) AS m FROM counts WHERE n > 0 GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT sample) FROM counts))
SELECT sample, round(exp(median(ln(n) - m)), 4) AS size_factor FROM counts JOIN p USING (gene) GROUP BY sample""",
        "gene_zscore": f"{_COUNTS}, v AS (SELECT *, log2(n + 1) AS v FROM counts) SELECT gene, sample, round(coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0), 4) AS z FROM v WINDOW w AS (PARTITION BY gene)",
        "welch_stats": _welch(_COUNTS),
        "bh_adjust": """
WITH r AS (SELECT p_partkey, p_type AS comparison, p_retailprice / 2500 AS p, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) AS k, count(*) OVER (PARTITION BY p_type) AS m FROM part)
SELECT p_partkey, comparison, round(least(1, min(p * m / k) OVER (PARTITION BY comparison ORDER BY k DESC ROWS UNBOUNDED PRECEDING)), 4)::DOUBLE AS padj FROM r""",
        "bonferroni": "SELECT p_partkey, round(least(1, p_retailprice / 1e6 * count(*) OVER (PARTITION BY p_type)), 4)::DOUBLE AS padj FROM part",
        "prevalence_filter": f"{_SPARSE} SELECT gene, round(count(*) FILTER (n <> 0) / (SELECT count(*) FROM supplier), 4) AS prevalence FROM counts GROUP BY 1 HAVING count(*) FILTER (n <> 0) / (SELECT count(*) FROM supplier) >= 0.02",
        "variance_filter": f"{_COUNTS} SELECT gene, round(var_pop(n), 4) AS variance FROM counts GROUP BY 1 HAVING var_pop(n) > 100",
        "coverage_summary": "SELECT l_returnflag AS sample, round(avg(c), 4) AS mean_coverage, round(median(c), 4) AS median_coverage, count(*) AS genes FROM (SELECT l_returnflag, l_quantity * 150 / (p_size * 100) AS c FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1",
        "relative_abundance_top10": """
WITH best AS (SELECT l_suppkey AS gene FROM lineitem GROUP BY 1 ORDER BY sum(l_quantity) DESC, 1 LIMIT 10), t AS (SELECT l_returnflag AS sample, sum(l_quantity) AS total FROM lineitem GROUP BY 1)
SELECT gene, sample, round(n / total, 6) AS share FROM (SELECT l_suppkey AS gene, l_returnflag AS sample, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2) JOIN best USING (gene) JOIN t USING (sample)""",
        "stage_status": "SELECT event_type AS stage, count(*) AS completed, round(avg(value), 4) AS mean_size FROM events GROUP BY 1",
    }
    every = own | result_queries.SQL | taxonomy_queries.SQL | sample_queries.SQL | read_queries.SQL | profile_queries.SQL
    return {k: v.replace("__CALLED__", own["classify_lca"]) for k, v in every.items()}
