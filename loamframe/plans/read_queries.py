"""Queries on sequences.  Letters A, C, G and T of documents are reads, those of benchmark items references.

Every benchmark item is a taxon below a root, in groups of four.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.operators import intervals as I
from loamframe.operators import minimizers as M
from loamframe.operators import reads as S
from loamframe.operators import taxonomy as T
from loamframe.plans import registry as R

K, LMER, TOGGLE = 15, 11, 0x1E37A


def _letters(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[^ACGTacgt]", "")


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return R._table(spark, d, "documents").select(F.col("doc_id").alias("read_id"), _letters("text").alias("seq"))


def _references(spark: SparkSession, d: str) -> DataFrame:
    return R._table(spark, d, "benchmark").select((F.col("item_id") + 1000).cast("int").alias("tax_id"), _letters("text").alias("seq"))


def _paths(spark: SparkSession, d: str) -> DataFrame:
    item = R._table(spark, d, "benchmark").select("item_id")
    leaf = item.select((F.col("item_id") + 1000).cast("int").alias("tax_id"), (F.floor(F.col("item_id") / 4) + 10).cast("int").alias("parent_id"), F.lit("species").alias("rank"), F.col("item_id").cast("string").alias("name"))
    group = item.select((F.floor(F.col("item_id") / 4) + 10).cast("int").alias("tax_id"), F.lit(1).alias("parent_id"), F.lit("genus").alias("rank"), F.lit("group").alias("name")).distinct()
    root = spark.range(1).select(F.lit(1).alias("tax_id"), F.lit(None).cast("int").alias("parent_id"), F.lit("root").alias("rank"), F.lit("root").alias("name"))
    return T.taxonomy_paths(root.unionByName(group).unionByName(leaf), 3)


def kmer_minimizers(spark: SparkSession, d: str) -> DataFrame:
    return S.minimizers(_reads(spark, d), "read_id", K, LMER, TOGGLE)


def minimizer_index(spark: SparkSession, d: str) -> DataFrame:
    return S.build_index(_references(spark, d), _paths(spark, d), K, LMER, TOGGLE)


def classify_sequences(spark: SparkSession, d: str) -> DataFrame:
    called = S.classify(_reads(spark, d), minimizer_index(spark, d), _paths(spark, d), K, LMER, TOGGLE)
    return called.select("read_id", "length", "hit_count", "tax_id")


def indexed_classification(spark: SparkSession, d: str) -> DataFrame:
    """As :func:`classify_sequences`, with the index stored in buckets and hot minimizers kept apart."""
    table = f"minimizer_index_{zlib.crc32(d.encode()):08x}"
    M.write_index(minimizer_index(spark, d), table)
    reads, index = _reads(spark, d), M.read_index(spark, table)
    hot = M.hot_minimizers(M.minimizer_runs(reads.sample(0.1, seed=1), "read_id", K, LMER, TOGGLE), index)
    return S.classify(reads, index, _paths(spark, d), K, LMER, TOGGLE, hot=hot).select("read_id", "length", "hit_count", "tax_id")


def classification_text(spark: SparkSession, d: str) -> DataFrame:
    return S.classification_lines(classify_sequences(spark, d))


def kmer_support(spark: SparkSession, d: str) -> DataFrame:
    return S.kmer_votes(_reads(spark, d), minimizer_index(spark, d), K, LMER, TOGGLE)


def screened_reads(spark: SparkSession, d: str) -> DataFrame:
    return S.screened(_reads(spark, d), _references(spark, d), 9, 0.05).select("read_id", "matches")


def trimmed_reads(spark: SparkSession, d: str) -> DataFrame:
    """Quality letters are the reads' own letters, shifted; an adapter and tails are searched for."""
    rows = _reads(spark, d).select("read_id", F.lit(1).alias("mate"), "seq", F.translate("seq", "ACGTacgt", "5?IA+I5B").alias("qual"))
    return S.trim_reads(rows, "ACGTTA", 20, 1, 1, 20, 3, "GT").select("read_id", F.length("seq").alias("kept"), F.md5("seq").alias("seq_md5"))


def quality_cuts(spark: SparkSession, d: str) -> DataFrame:
    return _reads(spark, d).select("read_id", S.quality_cut(F.translate("seq", "ACGTacgt", "5?IA+I5B"), 25).alias("kept"), S.poly_tail(F.col("seq"), 2, "ACGTacgt").alias("before_tail"))


def position_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = _reads(spark, d).select(F.lit("raw").alias("stage"), "seq").withColumn("qual", F.translate("seq", "ACGTacgt", "5?IA+I5B"))
    return S.position_profile(rows, "stage").withColumn("mean_quality", F.round("mean_quality", 4))


def read_histograms(spark: SparkSession, d: str) -> DataFrame:
    rows = _reads(spark, d)
    gc = S.gc_histogram(rows).select(F.lit("gc").alias("kind"), F.col("gc_pct").alias("bin"), "reads")
    return gc.unionByName(S.length_histogram(rows).select(F.lit("length").alias("kind"), F.col("length").alias("bin"), "reads"))


def read_duplication(spark: SparkSession, d: str) -> DataFrame:
    rows = R._table(spark, d, "documents").select("source", _letters("text").alias("seq"))
    return S.duplication(rows, "source").withColumn("duplicated", F.round("duplicated", 4))


def stranded_counts(spark: SparkSession, d: str) -> DataFrame:
    """Like feature_counts, with strands by parity and the bins' width from the exons."""
    reads = R._table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read"), F.lit("c").alias("contig"), F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-").alias("strand"), F.floor("l_extendedprice").alias("start"), F.floor(F.col("l_extendedprice") + F.col("l_quantity")).alias("end"))
    exons = R._table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.lit("c").alias("contig"), F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("p_partkey") * 37).alias("start"), (F.col("p_partkey") * 37 + F.col("p_size") * 10).alias("end"))
    return I.count_features(reads, exons, stranded=True)


def spliced_counts(spark: SparkSession, d: str) -> DataFrame:
    """Line items are reads in two blocks with an intron; parts are genes of three exons, two of which overlap."""
    text = "concat(cast(l_quantity as int), 'M', 20 + l_linenumber * 150, 'N', 2 * l_linenumber, 'M1I', 3, 'D', 10, 'M5S')"
    reads = R._table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read"), F.lit("c").alias("contig"), F.floor("l_extendedprice").alias("start"), F.expr(text).alias("cigar"))
    at = lambda a, b: F.struct((F.col("p_partkey") * 37 + F.expr(a)).alias("start"), (F.col("p_partkey") * 37 + F.expr(b)).alias("end"))
    exons = R._table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.lit("c").alias("contig"), F.inline(F.array(at("0", "p_size"), at("p_size div 2", "p_size + 9"), at("1000", "1000 + p_size"))))
    return I.count_spliced(reads, exons, 5)


#: Letters of a window that stands for a read.
WINDOW = 18


def _shares(spark: SparkSession, d: str) -> DataFrame:
    return S.ancestor_shares(_references(spark, d), minimizer_index(spark, d), _paths(spark, d), WINDOW, K, LMER, TOGGLE)


def kmer_shares(spark: SparkSession, d: str) -> DataFrame:
    return _shares(spark, d).withColumn("share", F.round("share", 6))


def kmer_reestimated(spark: SparkSession, d: str) -> DataFrame:
    """Documents' letters are reads, languages samples; what stays on a group of items is handed down by the shares."""
    paths = _paths(spark, d)
    called = classify_sequences(spark, d).join(R._table(spark, d, "documents").select(F.col("doc_id").alias("read_id"), F.col("lang").alias("sample")), "read_id")
    out = T.reestimate(T.clade_report(T.direct_counts(called), paths), paths, _shares(spark, d), 1)
    return out.select("sample", "tax_id", "assigned", F.round("added", 4).alias("added"), F.round("estimate", 4).alias("estimate"), F.round("fraction", 6).alias("fraction"))


QUERIES = (
    spliced_counts, kmer_shares, kmer_reestimated, kmer_minimizers, minimizer_index, classify_sequences, indexed_classification, classification_text, kmer_support, screened_reads, trimmed_reads, quality_cuts, position_profile, read_histograms, read_duplication, stranded_counts,
)

_SEQ = "regexp_replace(coalesce(text, ''), '[^ACGTacgt]', '', 'g')"


def _minimizers(rows: str, k: int, l: int, toggle: int) -> str:
    """CTEs that end in ``mins`` (id, pos, minimizer) for ``rows`` (id, seq)."""
    number = lambda x: f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({x}, ''), lambda c: c::BIGINT)), lambda a, b: a * 4 + b)"
    return f"""digits AS (SELECT id, translate(upper(seq), 'ACGT', '0123') AS d FROM ({rows}) WHERE length(seq) >= {k}),
lm AS (SELECT id, i, substring(d, i::INT, {l}) AS f, reverse(translate(substring(d, i::INT, {l}), '0123', '3210')) AS r FROM (SELECT id, d, unnest(range(1, length(d) - {l} + 2)) AS i FROM digits)),
uniq AS (SELECT DISTINCT f, r FROM lm), nums AS (SELECT f, xor(least({number('f')}, {number('r')}), {toggle}::BIGINT) AS x FROM uniq),
xs AS (SELECT id, i, x, count(*) OVER (PARTITION BY id) AS c, min(x) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - l} FOLLOWING) AS m FROM lm JOIN nums USING (f)),
mins AS (SELECT id, (i - 1)::INT AS pos, xor(m, {toggle}::BIGINT) AS minimizer FROM xs WHERE i <= c - {k - l})"""


_READS = f"SELECT doc_id AS id, substring({_SEQ}, 1, 256) AS seq FROM documents"
_WHOLE = f"SELECT doc_id AS id, {_SEQ} AS seq FROM documents"
_REFS = f"SELECT item_id + 1000 AS id, {_SEQ} AS seq FROM benchmark"
_INDEX = f"""idx AS (WITH {_minimizers(_REFS, K, LMER, TOGGLE)}, u AS (SELECT DISTINCT minimizer, id FROM mins)
SELECT minimizer, CASE WHEN count(*) = 1 THEN any_value(id) WHEN count(DISTINCT (id - 1000) // 4) = 1 THEN any_value((id - 1000) // 4) + 10 ELSE 1 END::INT AS tax_id FROM u GROUP BY 1)"""
_FOLD = """h AS (SELECT id, pos, tax_id, CASE WHEN tax_id = 1 THEN [1] WHEN tax_id < 1000 THEN [1, tax_id] ELSE [1, ((tax_id - 1000) // 4 + 10)::INT, tax_id] END AS path FROM mins JOIN idx USING (minimizer)),
o AS (SELECT id, count(*) AS hits, list(path ORDER BY pos) AS paths FROM h GROUP BY 1),
c AS (SELECT id, hits, list_reduce(paths, lambda held, hit: CASE WHEN len(hit) > len(held) THEN hit WHEN len(hit) = len(held) AND hit <> held THEN list_filter(held, lambda x: list_contains(hit, x)) ELSE held END)[-1] AS tax_id FROM o)"""
_CALLED = f"""
WITH {_INDEX}, {_minimizers(_READS, K, LMER, TOGGLE)},
{_FOLD},
called AS (SELECT doc_id AS read_id, least(256, length({_SEQ}))::INT AS length, coalesce(hits, 0) AS hit_count, tax_id::INT AS tax_id FROM documents LEFT JOIN c ON id = doc_id)"""
_WINDOWS = f"SELECT id * 1000000 + i AS id, substring(seq, i::INT + 1, {WINDOW}) AS seq FROM (SELECT id, seq, unnest(range(0, length(seq) - {WINDOW - 1})) AS i FROM ({_REFS}))"
_SHARES = f"""shares AS (WITH {_INDEX}, {_minimizers(_WINDOWS, K, LMER, TOGGLE)},
{_FOLD},
a AS (SELECT id AS tax_id, length(seq) - {WINDOW - 1} AS n FROM ({_REFS}) WHERE length(seq) >= {WINDOW})
SELECT a.tax_id::INT AS tax_id, c.tax_id::INT AS ancestor, count(*) AS windows, count(*) / any_value(n) AS share FROM c JOIN a ON c.id // 1000000 = a.tax_id
WHERE c.tax_id IN (1, (a.tax_id - 1000) // 4 + 10, a.tax_id) GROUP BY 1, 2)"""

_QUAL = "translate(seq, 'ACGTacgt', '5?IA+I5B')"

SQL = {
    "spliced_counts": """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS read, floor(l_extendedprice)::BIGINT AS s, l_quantity::INT AS q, l_linenumber AS l FROM lineitem),
b AS (SELECT read, s, s + q - 1 AS e FROM r UNION ALL SELECT read, s + q + 20 + l * 150, s + q + 20 + l * 150 + 2 * l - 1 FROM r
  UNION ALL SELECT read, s + q + 20 + l * 150 + 2 * l + 3, s + q + 20 + l * 150 + 2 * l + 12 FROM r),
x AS (SELECT p_partkey AS gene, p_partkey * 37 AS s, p_partkey * 37 + p_size + 9 AS e FROM part UNION ALL SELECT p_partkey, p_partkey * 37 + 1000, p_partkey * 37 + 1000 + p_size FROM part),
m AS (SELECT read, gene, sum(least(b.e, x.e) - greatest(b.s, x.s) + 1) AS n FROM b JOIN x ON b.s <= x.e AND x.s <= b.e GROUP BY 1, 2 HAVING sum(least(b.e, x.e) - greatest(b.s, x.s) + 1) >= 5),
o AS (SELECT read, min(gene) AS gene FROM m GROUP BY 1 HAVING count(*) = 1)
SELECT gene, count(*) AS n FROM o GROUP BY 1""",
    "kmer_shares": f"WITH {_SHARES} SELECT tax_id, ancestor, windows, round(share, 6) AS share FROM shares",
    "kmer_reestimated": f"""
{_CALLED}, {_SHARES},
direct AS (SELECT lang AS sample, tax_id, count(*) AS n FROM called JOIN documents ON doc_id = read_id WHERE tax_id IS NOT NULL GROUP BY 1, 2),
assigned AS (SELECT sample, tax_id, n AS assigned FROM direct WHERE tax_id IN (SELECT tax_id FROM shares)),
w AS (SELECT a.sample, a.tax_id, s.ancestor, assigned * share AS w FROM assigned a JOIN shares s USING (tax_id) WHERE ancestor <> tax_id),
p AS (SELECT w.sample, w.tax_id, n * w / sum(w) OVER (PARTITION BY w.sample, w.ancestor) AS add FROM w JOIN direct ON direct.sample = w.sample AND direct.tax_id = w.ancestor),
added AS (SELECT sample, tax_id, sum(add) AS added FROM p GROUP BY 1, 2),
e AS (SELECT sample, tax_id, assigned, coalesce(added, 0.0) AS added FROM assigned LEFT JOIN added USING (sample, tax_id))
SELECT sample, tax_id, assigned, round(added, 4) AS added, round(assigned + added, 4) AS estimate, round((assigned + added) / sum(assigned + added) OVER (PARTITION BY sample), 6) AS fraction FROM e""",
    "kmer_minimizers": f"WITH {_minimizers(_READS, K, LMER, TOGGLE)} SELECT id AS read_id, pos, minimizer FROM mins",
    "minimizer_index": f"WITH {_INDEX} SELECT minimizer, tax_id FROM idx",
    "classify_sequences": f"{_CALLED} SELECT read_id, length, hit_count, tax_id FROM called",
    "indexed_classification": f"{_CALLED} SELECT read_id, length, hit_count, tax_id FROM called",
    "classification_text": f"{_CALLED} SELECT CASE WHEN tax_id IS NULL THEN 'U' ELSE 'C' END || chr(9) || read_id || chr(9) || coalesce(tax_id, 0) || chr(9) || length || chr(9) || CASE WHEN tax_id IS NULL THEN '0' ELSE '1' END AS value FROM called",
    "kmer_support": f"WITH {_INDEX}, {_minimizers(_WHOLE, K, LMER, TOGGLE)} SELECT id AS read_id, tax_id, count(*) AS kmers FROM mins LEFT JOIN idx USING (minimizer) GROUP BY 1, 2",
    "screened_reads": f"""
WITH kn AS (WITH {_minimizers(_REFS, 9, 9, 0)} SELECT DISTINCT minimizer FROM mins), {_minimizers(_WHOLE, 9, 9, 0)},
c AS (SELECT id, count(kn.minimizer) / count(*) AS share FROM mins LEFT JOIN kn USING (minimizer) GROUP BY 1)
SELECT doc_id AS read_id, coalesce(share >= 0.05, false) AS matches FROM documents LEFT JOIN c ON id = doc_id""",
    "quality_cuts": f"""
WITH s AS (SELECT doc_id, {_SEQ} AS seq FROM documents), q AS (SELECT doc_id, seq, unnest(range(1, length(seq) + 1)) AS i, {_QUAL} AS qual FROM s),
t AS (SELECT doc_id, i, sum(25 - (ascii(substring(qual, i::INT, 1)) - 33)) OVER (PARTITION BY doc_id ORDER BY i DESC) AS run FROM q),
b AS (SELECT doc_id, i, run, bool_or(run < 0) OVER (PARTITION BY doc_id ORDER BY i DESC) AS over FROM t),
best AS (SELECT doc_id, min(i) AS cut FROM (SELECT *, max(run) OVER (PARTITION BY doc_id) AS top FROM b WHERE NOT over AND run > 0) WHERE run = top GROUP BY 1),
first AS (SELECT doc_id, max(i) AS cut FROM (SELECT *, max(run) OVER (PARTITION BY doc_id) AS top FROM b WHERE NOT over AND run > 0) WHERE run = top GROUP BY 1)
SELECT s.doc_id AS read_id, coalesce(first.cut - 1, length(seq))::INT AS kept, length(regexp_replace(seq, '(A{{2,}}|C{{2,}}|G{{2,}}|T{{2,}}|a{{2,}}|c{{2,}}|g{{2,}}|t{{2,}})$', ''))::INT AS before_tail FROM s LEFT JOIN first ON first.doc_id = s.doc_id""",
    "position_profile": f"""
WITH s AS (SELECT {_SEQ} AS seq FROM documents), p AS (SELECT unnest(range(0, length(seq))) AS pos, seq, {_QUAL} AS qual FROM s), b AS (SELECT pos, upper(substring(seq, pos::INT + 1, 1)) AS b, ascii(substring(qual, pos::INT + 1, 1)) - 33 AS q FROM p)
SELECT 'raw' AS stage, pos::INT AS pos, count(*) FILTER (b = 'A') AS a, count(*) FILTER (b = 'C') AS c, count(*) FILTER (b = 'G') AS g, count(*) FILTER (b = 'T') AS t, 0::BIGINT AS n, round(avg(q), 4) AS mean_quality FROM b GROUP BY 2""",
    "read_histograms": f"""
WITH s AS (SELECT {_SEQ} AS seq FROM documents)
SELECT 'gc' AS kind, floor(length(regexp_replace(upper(seq), '[^GC]', '', 'g')) * 100 / length(seq))::INT AS bin, count(*) AS reads FROM s WHERE length(seq) > 0 GROUP BY 2 UNION ALL SELECT 'length', length(seq)::INT, count(*) FROM s GROUP BY 2""",
    "read_duplication": f"SELECT source, count(*) AS reads, count(DISTINCT {_SEQ}) AS distinct_reads, round(1 - count(DISTINCT {_SEQ}) / count(*), 4) AS duplicated FROM documents GROUP BY 1",
    "stranded_counts": """
WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS read, l_linenumber % 2 AS strand, floor(l_extendedprice) AS s, floor(l_extendedprice + l_quantity) AS e FROM lineitem),
x AS (SELECT p_partkey AS gene, p_partkey % 2 AS strand, p_partkey * 37 AS s, p_partkey * 37 + p_size * 10 AS e FROM part),
m AS (SELECT read, min(gene) AS gene FROM a JOIN x ON a.strand = x.strand AND a.s <= x.e AND x.s <= a.e GROUP BY read HAVING count(DISTINCT gene) = 1)
SELECT gene, count(*) AS n FROM m GROUP BY 1""",
}
