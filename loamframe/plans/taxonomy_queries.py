"""Queries on taxonomy reports.  Region, nation and supplier are the tree, line items reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.operators import reports as P
from loamframe.operators import taxonomy as T
from loamframe.plans import registry as R
from loamframe.streaming.classify import running_counts


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """The clade report as lines of text order."""
    paths = R._paths(spark, d)
    return P.in_report_order(T.clade_report(R._direct(spark, d), paths), paths)


def report_text(spark: SparkSession, d: str) -> DataFrame:
    return P.report_lines(_lines(spark, d))


def lineage_export(spark: SparkSession, d: str) -> DataFrame:
    return P.lineage_text(_lines(spark, d), 6).select("sample", "value")


def decontaminate_report(spark: SparkSession, d: str) -> DataFrame:
    bad = R._table(spark, d, "supplier").where("s_suppkey % 10 = 3").select((F.col("s_suppkey") + 1000000).cast("string").alias("tax_id"))
    return P.decontaminate(_lines(spark, d), bad, 6).select("sample", "line_no", "tax_id", "clade_reads", "direct_reads", "pct")


def composition_table(spark: SparkSession, d: str) -> DataFrame:
    """Regions 0 and 1 stand for bacteria and viruses, region 2 for the host."""
    own = {"100": "2", "101": "10239", "102": "9606"}
    tax = F.col("tax_id")
    for a, b in own.items():
        tax = F.when(F.col("tax_id") == a, b).otherwise(tax)
    table = P.domain_table(_lines(spark, d).withColumn("tax_id", tax))
    return table.withColumns({c: F.round(c, 4) for c in table.columns if c.endswith("_pct")})


def selected_taxa_pivot(spark: SparkSession, d: str) -> DataFrame:
    return P.taxon_pivot(_lines(spark, d), {"first": "100", "second": "1003", "absent": "77"})


def taxon_matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_suppkey").alias("tax_id")).agg(F.count(F.lit(1)).alias("direct_reads"))
    return P.taxon_matrix(rows)


def contaminant_tests(spark: SparkSession, d: str) -> DataFrame:
    return T.contaminants(R.prevalence_counts(spark, d))


def top_species(spark: SparkSession, d: str) -> DataFrame:
    """Sample R has abundances of its own, the others fall back to their reports."""
    lines = _lines(spark, d)
    own = lines.where("sample = 'R' and rank_code = 'S'").select("sample", "name", (F.col("direct_reads") / 1000.0).alias("fraction"))
    return P.top_species(own, lines).select("sample", "name", F.round("fraction", 6).alias("fraction"), "origin", "rank")


def prefer_clean(spark: SparkSession, d: str) -> DataFrame:
    orders = R._table(spark, d, "orders")
    raw = orders.groupBy(F.col("o_orderpriority").alias("sample")).agg(F.count(F.lit(1)).alias("report"))
    clean = orders.where("o_orderstatus = 'O'").groupBy(F.col("o_orderpriority").alias("sample")).agg((-F.count(F.lit(1))).alias("report")).where("report % 2 = 0")
    return P.prefer_clean(raw, clean, ["sample"])


def reestimated(spark: SparkSession, d: str) -> DataFrame:
    """Reads on nations and regions handed down to suppliers, by a share that follows the supplier's key."""
    paths = R._paths(spark, d)
    leaf = F.expr("CASE WHEN l_tax > 0.06 THEN 1000 + s_nationkey WHEN l_tax > 0.04 THEN 100 + n_regionkey ELSE 1000000 + l_suppkey END")
    rows = R._table(spark, d, "lineitem").join(R._table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(R._table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    direct = T.direct_counts(rows.select(F.col("l_returnflag").alias("sample"), leaf.cast("int").alias("tax_id")))
    species = paths.where("rank = 'species'")
    shares = species.select("tax_id", F.explode("path").alias("ancestor"), ((F.col("tax_id") % 7 + 1) / 8).alias("share"))
    out = T.reestimate(T.clade_report(direct, paths), paths, shares, 5)
    return out.select("sample", "tax_id", "assigned", F.round("added", 4).alias("added"), F.round("estimate", 4).alias("estimate"), F.round("fraction", 6).alias("fraction"))


def confident_reads(spark: SparkSession, d: str) -> DataFrame:
    """Orders are reads, their line items k-mers; the call comes from :func:`classify_lca`."""
    called = R.classify_lca(spark, d).select("read_id", F.col("tax_id").alias("called"))
    votes = R._table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read_id"), (F.col("l_suppkey") + 1000000).cast("int").alias("tax_id")).agg(F.count(F.lit(1)).alias("kmers"))
    return T.with_confidence(votes.join(called, "read_id"), R._paths(spark, d), 0.4)


def merged_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The first two line items of an order are mates."""
    rows = R._table(spark, d, "lineitem").where("l_linenumber <= 2").select(F.lit("s").alias("sample"), F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("mate"), (F.col("l_suppkey") + 1000000).cast("int").alias("own"), F.col("l_quantity").cast("long").alias("length"))
    mates = rows.join(R._paths(spark, d).select(F.col("tax_id").alias("own"), "path"), "own").select("sample", "read_id", "mate", "path", "length")
    return T.merge_pairs(mates).select("read_id", "tax_id", "length")


def direct_counts(spark: SparkSession, d: str) -> DataFrame:
    reads = R._table(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), F.expr("CASE WHEN l_tax <> 0 THEN l_suppkey END").alias("tax_id"))
    return running_counts(reads)


def both_sources(spark: SparkSession, d: str) -> DataFrame:
    """Reports of two sources of reads side by side, the species level of each."""
    paths = R._paths(spark, d)
    rows = R._table(spark, d, "lineitem")
    tax = (F.col("l_suppkey") + 1000000).cast("int").alias("tax_id")
    one = lambda status: T.clade_report(T.direct_counts(rows.where(F.col("l_linestatus") == status).select(F.col("l_returnflag").alias("sample"), tax)), paths)
    return P.at_rank(P.all_sources(rrna=one("F"), unmapped=one("O")), "species", "rank").select("source", "sample", "tax_id", "clade_reads")


QUERIES = (
    report_text, lineage_export, decontaminate_report, composition_table, selected_taxa_pivot, taxon_matrix, contaminant_tests, top_species, prefer_clean, reestimated, confident_reads, merged_pairs, direct_counts, both_sources,
)


def _ordered(zero: str) -> str:
    """Report lines with ``line_no`` and the names on the way."""
    return f"""
WITH rep AS ({R._report(zero)}), up AS (
  SELECT 1000000 + s_suppkey AS tax_id, [1, 100 + r_regionkey, 1000 + n_nationkey, 1000000 + s_suppkey] AS path, ['root', r_name, n_name, s_name] AS names FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 1000 + n_nationkey, [1, 100 + r_regionkey, 1000 + n_nationkey], ['root', r_name, n_name] FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 100 + r_regionkey, [1, 100 + r_regionkey], ['root', r_name] FROM region UNION ALL SELECT 1, [1], ['root'] UNION ALL SELECT 0, [-1], ['unclassified']),
lines AS (SELECT rep.*, path, names, (row_number() OVER (PARTITION BY sample ORDER BY path) - 1)::INT AS line_no,
  CASE rank WHEN 'root' THEN 'R' WHEN 'unclassified' THEN 'U' WHEN 'domain' THEN 'D' WHEN 'genus' THEN 'G' ELSE 'S' END AS rank_code FROM rep JOIN up USING (tax_id))"""


_PLAIN = _ordered("count(*)")

SQL = {
    "report_text": f"""{_PLAIN} SELECT sample, line_no, lpad(printf('%.2f', pct), greatest(6, length(printf('%.2f', pct)))::INT, ' ') || chr(9) || clade_reads || chr(9) || direct_reads || chr(9) || rank_code || chr(9) || tax_id || chr(9) || repeat('  ', len(path) - 1) || name AS value FROM lines""",
    "lineage_export": f"{_PLAIN} SELECT sample, direct_reads || chr(9) || array_to_string(names, chr(9)) AS value FROM lines WHERE direct_reads > 0 AND tax_id <> 0",
    "decontaminate_report": f"""{_ordered("CASE WHEN s % 10 = 3 THEN 0 ELSE count(*) END")} SELECT sample, line_no, tax_id::VARCHAR AS tax_id, clade_reads, direct_reads, round(clade_reads * 100.0 / sum(direct_reads) OVER (PARTITION BY sample), 5)::DOUBLE AS pct FROM lines""",
    "composition_table": f"""{_PLAIN}, w AS (SELECT sample, coalesce(max(clade_reads) FILTER (tax_id = 102), 0) AS host, coalesce(max(clade_reads) FILTER (tax_id = 100), 0) AS bacterial, coalesce(max(clade_reads) FILTER (tax_id = 101), 0) AS viral,
coalesce(max(clade_reads) FILTER (tax_id = 1), 0) AS root, coalesce(max(clade_reads) FILTER (tax_id = 0), 0) AS unclassified FROM lines GROUP BY 1),
t AS (SELECT *, greatest(0, root - host - bacterial - viral) AS other, root + unclassified AS total FROM w)
SELECT sample, host, bacterial, viral, other, unclassified, total, round(host / total * 100, 4) AS host_pct, round(bacterial / total * 100, 4) AS bacterial_pct, round(viral / total * 100, 4) AS viral_pct, round(other / total * 100, 4) AS other_pct, round(unclassified / total * 100, 4) AS unclassified_pct FROM t WHERE total > 0""",
    "selected_taxa_pivot": f"""{_PLAIN} SELECT sample, coalesce(max(clade_reads) FILTER (tax_id = 100), 0) AS first_reads, coalesce(max(pct) FILTER (tax_id = 100), 0) AS first_pct,
coalesce(max(clade_reads) FILTER (tax_id = 1003), 0) AS second_reads, coalesce(max(pct) FILTER (tax_id = 1003), 0) AS second_pct, 0::BIGINT AS absent_reads, 0.0::DOUBLE AS absent_pct FROM lines GROUP BY 1""",
    "taxon_matrix": """
WITH c AS (SELECT l_returnflag AS sample, l_suppkey AS tax_id, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT t.tax_id, s.sample, coalesce(n, 0) AS n FROM (SELECT DISTINCT tax_id FROM c) t CROSS JOIN (SELECT DISTINCT sample FROM c) s LEFT JOIN c USING (tax_id, sample)""",
    "top_species": f"""{_PLAIN}, x AS (SELECT sample, name, CASE WHEN sample = 'R' THEN direct_reads / 1000.0 ELSE pct / 100 END AS fraction, CASE WHEN sample = 'R' THEN 'abundance' ELSE 'report' END AS origin FROM lines WHERE rank_code = 'S')
SELECT sample, name, round(fraction, 6)::DOUBLE AS fraction, origin, (row_number() OVER (PARTITION BY sample ORDER BY fraction DESC, name))::INT AS rank FROM x QUALIFY rank <= 10""",
    "prefer_clean": """
WITH r AS (SELECT o_orderpriority AS sample, count(*) AS report, -count(*) FILTER (o_orderstatus = 'O') AS clean FROM orders GROUP BY 1)
SELECT sample, CASE WHEN clean <> 0 AND clean % 2 = 0 THEN clean ELSE report END AS report FROM r""",
    "reestimated": """
WITH leaf AS (SELECT l_returnflag AS sample, CASE WHEN l_tax > 0.06 THEN 1000 + s_nationkey WHEN l_tax > 0.04 THEN 100 + n_regionkey ELSE 1000000 + l_suppkey END AS tax_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
direct AS (SELECT sample, tax_id, count(*) AS held FROM leaf GROUP BY 1, 2),
assigned AS (SELECT sample, tax_id, held AS assigned FROM direct WHERE tax_id >= 1000000 AND held >= 5),
up AS (SELECT 1000000 + s_suppkey AS tax_id, unnest([1, 100 + n_regionkey, 1000 + s_nationkey]) AS ancestor, ((1000000 + s_suppkey) % 7 + 1) / 8 AS share FROM supplier JOIN nation ON s_nationkey = n_nationkey),
w AS (SELECT a.sample, a.tax_id, d.held * (assigned * share) / sum(assigned * share) OVER (PARTITION BY a.sample, ancestor) AS part FROM assigned a JOIN up USING (tax_id) JOIN direct d ON d.sample = a.sample AND d.tax_id = ancestor),
t AS (SELECT sample, tax_id, assigned, coalesce(added, 0) AS added FROM assigned LEFT JOIN (SELECT sample, tax_id, sum(part) AS added FROM w GROUP BY 1, 2) USING (sample, tax_id))
SELECT sample, tax_id::INT AS tax_id, assigned, round(added, 4) AS added, round(assigned + added, 4) AS estimate, round((assigned + added) / sum(assigned + added) OVER (PARTITION BY sample), 6) AS fraction FROM t""",
    "direct_counts": "SELECT l_returnflag AS sample, CASE WHEN l_tax <> 0 THEN l_suppkey END AS tax_id, count(*) AS direct_reads FROM lineitem GROUP BY 1, 2",
    "both_sources": "SELECT CASE l_linestatus WHEN 'F' THEN 'rrna' ELSE 'unmapped' END AS source, l_returnflag AS sample, (1000000 + l_suppkey)::INT AS tax_id, count(*) AS clade_reads FROM lineitem GROUP BY 1, 2, 3",
    "merged_pairs": """
WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity, [1, 100 + n_regionkey, 1000 + s_nationkey, 1000000 + l_suppkey] AS path FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_linenumber <= 2),
m AS (SELECT l_orderkey AS read_id, max(path) FILTER (l_linenumber = 1) AS a, max(path) FILTER (l_linenumber = 2) AS b, sum(l_quantity::BIGINT)::BIGINT AS length FROM p GROUP BY 1)
SELECT read_id, (CASE WHEN a IS NULL THEN b[-1] WHEN b IS NULL THEN a[-1] ELSE list_filter(a, lambda x: list_contains(b, x))[-1] END)::INT AS tax_id, length FROM m""",
}
_SUPPLIER = "SELECT l_orderkey AS read_id, s_suppkey, n_nationkey, n_regionkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
SQL["confident_reads"] = f"""
WITH hits AS ({_SUPPLIER}), called AS (__CALLED__), total AS (SELECT read_id, count(*) AS k FROM hits GROUP BY 1),
up AS (SELECT 1000000 + s_suppkey AS tax_id, [1, 100 + n_regionkey, 1000 + s_nationkey, 1000000 + s_suppkey] AS path FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 1000 + n_nationkey, [1, 100 + n_regionkey, 1000 + n_nationkey] FROM nation UNION ALL SELECT 100 + r_regionkey, [1, 100 + r_regionkey] FROM region UNION ALL SELECT 1, [1]),
nodes AS (SELECT called.read_id, unnest(path) AS node, unnest(range(len(path))) AS depth FROM called JOIN up USING (tax_id)),
votes AS (SELECT read_id, unnest([1, 100 + n_regionkey, 1000 + n_nationkey, 1000000 + s_suppkey]) AS node FROM hits),
s AS (SELECT read_id, node, count(*) AS c FROM votes GROUP BY 1, 2)
SELECT total.read_id, max_by(node, depth)::INT AS tax_id FROM total LEFT JOIN (SELECT n.read_id, n.node, depth FROM nodes n JOIN s USING (read_id, node) JOIN total USING (read_id) WHERE c >= 0.4 * k) USING (read_id) GROUP BY 1"""
