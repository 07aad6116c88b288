"""Tests, adjustments, models and enrichment against hand-made values and plain numpy."""

import itertools
import math

import numpy as np
import pytest
from loamframe.functions import special as P
from loamframe.operators import diffexp as D
from loamframe.operators import enrichment as E
from loamframe.operators import expression as X
from loamframe.operators import learning as L
from loamframe.operators import models as M
from pyspark.sql import functions as F

COUNTS = "gene string, sample string, n double"


def test_special_functions():
    assert P.student_two_sided(np.array([2.0, 0.0, 2.228138852]), np.array([10.0, 3.0, 10.0])) == pytest.approx([0.07338803, 1.0, 0.05], abs=1e-7)
    assert P.gamma_upper(np.array([0.5, 2.0]), np.array([3.841458820694124 / 2, 10.0])) == pytest.approx([0.05, 11 * math.exp(-10)], rel=1e-9)
    assert P.beta_inc(2.0, 3.0, 0.4) == pytest.approx(0.5248)
    whole = math.comb(20, 5)
    want = sum(math.comb(5, k) * math.comb(15, 5 - k) for k in range(3, 6)) / whole
    assert P.hypergeometric_upper(np.array([3, 0, 6]), np.array([5, 5, 5]), np.array([5, 5, 5]), np.array([20, 20, 20])) == pytest.approx([want, 1.0, 0.0])


def cells(**genes):
    return [(g, f"s{i}", float(v)) for g, vs in genes.items() for i, v in enumerate(vs) if v]


def test_welch(spark):
    """Missing cells are zeros; t follows the control; constant groups and single replicates have their own rules."""
    counts = spark.createDataFrame(cells(a=[1, 2, 3, 5, 6, 10], b=[4, 4, 4, 4, 4, 4], c=[0, 0, 9, 0, 0, 0]), COUNTS)
    groups = spark.createDataFrame([(f"s{i}", "x" if i < 3 else "y") for i in range(6)] + [("s9", "z")], "sample string, group string")
    pairs = spark.createDataFrame([("y_vs_x", "x", "y"), ("z_vs_x", "x", "z")], "comparison string, control string, treatment string")
    got = {(r.comparison, r.gene): r for r in X.welch(counts, pairs, groups).collect()}
    assert len(got) == 6
    a = got["y_vs_x", "a"]
    t = (2 - 7) / math.sqrt(1 / 3 + 7 / 3)
    assert (a.mean_control, a.mean_treatment) == (2, 7) and a.t_stat == pytest.approx(t) and t < 0
    assert a.df == pytest.approx((1 / 3 + 7 / 3) ** 2 / ((1 / 3) ** 2 / 2 + (7 / 3) ** 2 / 2)) and a.p == pytest.approx(float(P.student_two_sided(np.array([a.t_stat]), np.array([a.df]))[0]))
    b, c = got["y_vs_x", "b"], got["y_vs_x", "c"]
    assert (b.t_stat, b.p) == (0.0, 1.0) and (c.mean_control, c.mean_treatment) == (3, 0) and c.t_stat == pytest.approx(3 / math.sqrt(27 / 3))
    assert all(got["z_vs_x", g].p is None and got["z_vs_x", g].t_stat is None for g in "abc")
    shaped = D.shape_results(X.welch(counts, pairs, groups)).collect()
    assert {r.significance for r in shaped if r.comparison == "z_vs_x"} == {"Not Significant"}


def test_adjustments_keep_rows_without_p(spark):
    rows = [("k", i, p) for i, p in enumerate([0.01, 0.04, float("nan"), None, 0.03, 0.04])]
    tests = spark.createDataFrame(rows, "comparison string, gene int, p double")
    bh = {r.gene: r.padj for r in X.benjamini_hochberg(tests, "comparison").collect()}
    assert bh[0] == pytest.approx(0.04) and bh[4] == pytest.approx(0.04) and bh[1] == bh[5] == pytest.approx(0.04) and bh[2] is None and bh[3] is None
    bonferroni = {r.gene: r.padj for r in X.bonferroni(tests, "comparison").collect()}
    assert bonferroni[0] == pytest.approx(0.06) and bonferroni[1] == pytest.approx(0.24) and bonferroni[2] is None and bonferroni[3] is None
    assert sorted(r.gene for r in X.storey(tests, "comparison").collect()) == list(range(6))


def test_variance_of_sparse_genes(spark):
    counts = spark.createDataFrame(cells(a=[0, 0, 9, 0], b=[5, 5, 5, 5]), COUNTS)
    got = {r.gene: r.variance for r in X.variance_filter(counts, 0.0, 4).collect()}
    assert got == {"a": pytest.approx(np.var([0, 0, 9, 0]))}


def test_summary(spark):
    rows = [("k", g, l, p) for g, l, p in (("a", 2.0, 0.001), ("b", -2.0, 0.002), ("c", 3.0, 0.9), ("d", 1.5, None))]
    shaped = D.shape_results(spark.createDataFrame(rows, "comparison string, gene string, log2_fold_change double, p double"))
    r = D.summary(shaped).first()
    assert (r.total_genes, r.significant, r.upregulated, r.downregulated, r.significant_pct) == (4, 2, 1, 1, 50.0)
    text = D.summary_json(shaped, {"p": 0.05}).first().value
    assert '"top_upregulated":[{"gene":"a"' in text and '"parameters":{"p":0.05}' in text


def dense(spark, genes=40, samples=12, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.negative_binomial(5, 0.05, size=(genes, samples)).astype(float)
    m[0, 6:] *= 6
    rows = [(f"g{i:02d}", f"s{j:02d}", float(m[i, j])) for i in range(genes) for j in range(samples)]
    meta = [(f"s{j:02d}", "case" if j >= 6 else "ctl", "u" if j % 2 else "v", float(j % 3)) for j in range(samples)]
    return m, spark.createDataFrame(rows, COUNTS), spark.createDataFrame(meta, "sample string, group string, batch string, age double")


def test_linear_models(spark):
    m, counts, meta = dense(spark)
    made = M.design(meta, "group", "ctl", ("batch", "age"))
    assert made.names == ["(Intercept)", "batchv", "age", "groupcase"] and made.full_rank
    values = counts.select("gene", "sample", F.col("n").alias("v"))
    got = {(r.gene, r.coef): r for r in M.linear_coefficients(values, made).collect()}
    beta = np.linalg.lstsq(made.x, m.T, rcond=None)[0]
    s2 = ((m.T - made.x @ beta) ** 2).sum(axis=0) / 8
    for i, (j, c) in itertools.product(range(0, 40, 7), enumerate(made.names)):
        assert got[f"g{i:02d}", c].beta == pytest.approx(beta[j, i]) and got[f"g{i:02d}", c].s2 == pytest.approx(s2[i])
    weighted = {(r.gene, r.coef): r.beta for r in M.weighted_coefficients(values.withColumn("weight", F.lit(2.0)), made).collect()}
    assert weighted["g03", "groupcase"] == pytest.approx(beta[3, 3])
    tested = {r.gene: r for r in M.moderated(M.linear_coefficients(values, made), made).collect()}
    assert tested["g00"].p == min(r.p for r in tested.values()) and all(r.df >= 8 for r in tested.values())
    assert M._digamma(1.0) == pytest.approx(-0.5772156649) and M._digamma(1.0, 1) == pytest.approx(math.pi**2 / 6) and M._trigamma_inverse(M._digamma(3.7, 1)) == pytest.approx(3.7)
    worse = M.design(meta.withColumn("copy", F.col("group")), "group", "ctl", ("copy",))
    assert not worse.full_rank and M.first_full_rank([worse, made]) is made
    assert M.effect_contrasts(made, "groupcase", ["age", "time:groupcase"]) == {"age": {"groupcase": 1.0, "age": 1.0}, "time:groupcase": {"groupcase": 1.0}}
    voom = M.voom_weights(counts, made)
    assert voom.count() == 480 and voom.where("weight > 0").count() == 480


def test_negative_binomial(spark):
    _, counts, meta = dense(spark)
    made = M.design(meta, "group", "ctl")
    for quasi in (False, True):
        got = {r.gene: r for r in M.negative_binomial(counts, made, X.size_factors(counts), quasi=quasi).collect()}
        assert got["g00"].p == min(r.p for r in got.values()) < 0.001 and 1.5 < got["g00"].estimate < 3.5
        assert np.mean([r.p < 0.05 for g, r in got.items() if g != "g00"]) < 0.25


def test_components_and_batches(spark):
    m, counts, meta = dense(spark)
    v = np.log2(m + 1)
    values = counts.withColumn("v", F.log2(F.col("n") + 1))
    scores, shares = M.principal_components(M.sample_gram(values, 12), 3)
    centred = v - v.mean(axis=1, keepdims=True)
    u, s, _ = np.linalg.svd(centred.T, full_matrices=False)
    assert [r.explained_pct for r in shares.orderBy("component").collect()] == pytest.approx((100 * s**2 / (s**2).sum())[:3], abs=0.01)
    first = [r.score for r in scores.where("component = 1").orderBy("sample").collect()]
    assert np.abs(first) == pytest.approx(np.abs(u[:, 0] * s[0]), abs=1e-6)
    shifted = values.join(meta, "sample").select("gene", "sample", (F.col("v") + F.when(F.col("batch") == "u", 3.0).otherwise(0.0)).alias("v"))
    done = M.adjust_batches(shifted, meta.select("sample", "batch")).join(meta, "sample")
    gap = done.groupBy("gene").agg((F.avg(F.when(F.col("batch") == "u", F.col("v"))) - F.avg(F.when(F.col("batch") == "v", F.col("v")))).alias("d")).agg(F.avg(F.abs("d"))).first()[0]
    assert gap < 0.6


def test_enrichment(spark):
    rows = [("k", i, i < 10) for i in range(100)]
    sets = spark.createDataFrame([("in", i) for i in range(8)] + [("out", i) for i in range(50, 70)] + [("mixed", i) for i in range(5, 25)], "term string, gene int")
    got = {r.term: r for r in E.over_representation(spark.createDataFrame(rows, "comparison string, gene int, hit boolean"), sets, padj=None, qvalue=None).collect()}
    assert set(got) == {"in", "mixed"} and got["in"].p == pytest.approx(math.comb(10, 8) / math.comb(100, 8)) and got["in"].padj < 0.001
    stats = spark.createDataFrame([("k", i, float(50 - i)) for i in range(100)], "comparison string, gene int, stat double")
    scored = {r.term: r for r in E.permuted_enrichment(stats, sets, 50, 5, 50).collect()}
    assert scored["in"].p < 0.05 and scored["in"].nes > 1 and 0 < scored["out"].p <= 1


def test_learning(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{j}", f"s{i:02d}", float(rng.poisson(20) + (15 if j == 0 and i % 2 else 0))) for i in range(30) for j in range(5)]
    meta = spark.createDataFrame([(f"s{i:02d}", "b" if i % 2 else "a") for i in range(30)], "sample string, group string")
    labels = L.folds(L.binary_labels(meta, "group"), 3)
    assert sorted(tuple(r) for r in labels.groupBy("label", "fold").count().collect()) == [(y, f, 5) for y in (0, 1) for f in range(3)]
    with pytest.raises(ValueError):
        L.binary_labels(meta, "sample")
    table, names = L.feature_vectors(L.features(spark.createDataFrame(rows, COUNTS), 30, scale=True), labels)
    predicted, metrics, importances = L.forest_cross_validation(table, names, 3, 20, 3)
    assert predicted.count() == 30 and sum(r.samples for r in L.confusion(predicted).collect()) == 30
    assert L.metrics_summary(metrics).first().mean_accuracy > 0.8
    assert L.top_importances(L.mean_importance(importances), 1).first().gene == "g0"
