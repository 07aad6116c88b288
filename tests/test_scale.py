"""Results that change, or stop being whole, only on larger tables than the samples."""

import itertools

import numpy as np
import pytest
from loamframe.operators import models as M
from loamframe.operators import reports as P
from pyspark.sql import functions as F


def test_report_lines_round_as_printf_does(spark):
    """Decimals that a double lies just below, or exactly on, a tie of."""
    values = [0.015, 0.125, 0.375, 1.005, 2.675, 99.995, 0.0, 100.0, 12.345]
    report = spark.createDataFrame([("s", i, x, 1, 1, "S", str(i), "n", 0) for i, x in enumerate(values)], "sample string, line_no int, pct double, clade_reads long, direct_reads long, rank_code string, tax_id string, name string, depth int")
    got = [r.value.split("\t")[0] for r in P.report_lines(report).orderBy("line_no").collect()]
    assert got == [f"{x:6.2f}" for x in values]


def sparse(spark, genes=30, samples=24, seed=5):
    """Counts with three of four cells missing, and samples of three groups."""
    rng = np.random.default_rng(seed)
    m = rng.poisson(9, size=(genes, samples)) * (rng.random((genes, samples)) < 0.25)
    m[:, 0] += 1  # no sample or gene without counts
    m[0] += 1
    rows = [(i, j, float(m[i, j])) for i in range(genes) for j in range(samples) if m[i, j]]
    meta = [(j, "abc"[j % 3], float(j % 7)) for j in range(samples)]
    return m.astype(float), spark.createDataFrame(rows, "gene long, sample long, n double"), spark.createDataFrame(meta, "sample long, group string, age double")


@pytest.mark.parametrize("covariates", [(), ("age",)])
def test_models_read_only_cells_that_exist(spark, covariates):
    m, counts, meta = sparse(spark)
    made = M.design(meta, "group", "a", covariates)
    values = counts.select("gene", "sample", F.col("n").alias("v"))
    fit = M.linear_coefficients(values, made)
    got = {(r.gene, r.coef): r for r in fit.collect()}
    beta = np.linalg.lstsq(made.x, m.T, rcond=None)[0]
    s2 = ((m.T - made.x @ beta) ** 2).sum(axis=0) / (24 - len(made.names))
    assert len(got) == 30 * len(made.names)
    for i, (j, c) in itertools.product(range(30), enumerate(made.names)):
        r = got[i, c]
        assert (r.beta, r.s2, r.mean) == pytest.approx((beta[j, i], s2[i], m[i].mean()))
    # the same from cells filled up, and from the sums over kinds of samples
    cells = M.weighted_coefficients(M.voom_weights(counts, made), made)
    want = {(r.gene, r.coef): r for r in cells.collect()}
    sums = {(r.gene, r.coef): r for r in M.voom_coefficients(counts, made).collect()}
    assert set(sums) == set(want)
    for k, r in want.items():
        assert (sums[k].beta, sums[k].s2, sums[k].mean, sums[k].df) == pytest.approx((r.beta, r.s2, r.mean, r.df), rel=1e-7)
    assert "Generate" not in _plan(M.voom_coefficients(counts, made))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_negative_binomial_of_missing_cells(spark):
    """Missing cells are zeros, and no expression is made for each sample."""
    m, counts, meta = sparse(spark)
    made = M.design(meta, "group", "a")
    factors = spark.createDataFrame([(j, 1.0 + j / 50) for j in range(24)], "sample long, size_factor double")
    full = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(30) for j in range(24)], "gene long, sample long, n double")
    a, b = ({r.gene: r for r in M.negative_binomial(c, made, factors).collect()} for c in (counts, full))
    assert len(a) == 30 and all((a[g].mean, a[g].estimate, a[g].stat) == pytest.approx((b[g].mean, b[g].estimate, b[g].stat)) for g in a)
    assert _plan(M.negative_binomial(counts, made, factors)).lower().count("element_at") == 0


def test_gram_has_every_pair(spark, monkeypatch):
    """Samples without a gene in common have rows, and blocks and slices of any size give the same."""
    m = np.zeros((12, 9))
    m[:6, :4], m[6:, 4:8] = np.arange(24).reshape(6, 4) % 5, np.arange(24).reshape(6, 4) % 7
    m[11] = 3.0  # constant: adds nothing, but is all that the last sample has
    values = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(12) for j in range(9) if m[i, j]], "gene long, sample long, v double")
    for scale, tiny in itertools.product((False, True), (False, True)):
        if tiny:
            monkeypatch.setattr(M, "GRAM", 40)
        some = m[m.var(axis=1) > 0]
        z = (some - some.mean(axis=1, keepdims=True)) / (some.std(axis=1, keepdims=True) if scale else 1)
        got = {(r.a, r.b): r.g for r in M.sample_gram(values, 9, scale).collect()}
        assert len(got) == 81 and [got[a, b] for a in range(9) for b in range(9)] == pytest.approx((z.T @ z).ravel(), abs=1e-9)


def test_components_from_the_smaller_side(spark):
    rng = np.random.default_rng(2)
    for shape in ((5, 40), (40, 5)):
        m = rng.poisson(2, size=shape).astype(float)
        m[:, 0] += 1
        m[0] += 1
        values = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(shape[0]) for j in range(shape[1]) if m[i, j]], "gene long, sample long, v double")
        some = m[m.var(axis=1) > 0]
        z = (some - some.mean(axis=1, keepdims=True)) / some.std(axis=1, keepdims=True)
        u, d, _ = np.linalg.svd(z.T, full_matrices=False)
        got = M.component_scores(values, shape[1], scale=True)
        rows = {(r.sample, r.component): r.score for r in got.collect()}
        assert len(rows) == shape[1] * min(10, shape[1]) and got.schema["component"].dataType.simpleString() == "int"
        for c in range(3):
            assert np.abs([rows[j, c + 1] for j in range(shape[1])]) == pytest.approx(np.abs(u[:, c] * d[c]), abs=1e-6)


def test_packing_takes_few_documents_at_a_time(spark, monkeypatch):
    import public_tokenizers
    from loamframe.llm import packing

    seen = []

    def spy(df, name):
        seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return df

    monkeypatch.setattr(packing, "materialise", spy)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2).count() == 2
    assert [int(x) <= 500 for x in seen] == [True] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_groups_are_summed_where_cells_lie(spark):
    """Rows move once, to their genes; samples' groups come to them."""
    from loamframe.plans import result_queries as Q

    plan = Q.group_means(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gene") == 1 and "SortMergeJoin" not in plan


def test_letters_that_do_not_count_stay_out_of_python(spark):
    from loamframe.operators import minimizers as K

    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ACGT"), n)) for n in (5, 300, 256, 40_000)] + [None, "é" * 30]
    reads = spark.createDataFrame(list(enumerate(texts)), "read_id long, seq string")
    runs = K.minimizer_runs(reads, "read_id", 15, 11)
    assert "substring(seq" in _plan(runs)
    got = {r.read_id: r.n for r in runs.groupBy("read_id").agg(F.sum("times").alias("n")).collect()}
    assert got == {1: 242, 2: 242, 3: 242, 5: 16}
    whole = K.minimizer_runs(reads, "read_id", 15, 11, length=None).where("read_id = 3").agg(F.sum("times")).first()[0]
    assert whole == 40_000 - 14


def test_gram_rows_lie_by_their_numbers(spark):
    """Of samples that share no gene, pairs with equal numbers lie together, so that files stay small; each pair is there once."""
    rng = np.random.default_rng(6)
    n = 400
    values = spark.createDataFrame([(3 * j + i, j, float(rng.integers(1, 40))) for j in range(n) for i in range(3)], "gene long, sample long, v double")
    t = M.sample_gram(values, n).withColumn("r", F.round("g", 1)).toPandas()
    assert len(t) == n * n and len(t[["a", "b"]].drop_duplicates()) == n * n
    assert (t["r"].diff() != 0).sum() < len(t) / 3


def test_gram_moves_rows_once_to_their_genes(spark):
    from loamframe.plans import result_queries as Q

    plan = Q.pca_gram(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gene") == 1 and "SortMergeJoin" not in plan and "round(" not in plan


def test_gram_rounds_as_spark_does(spark):
    rng = np.random.default_rng(8)
    x = [*(rng.integers(-(10**7), 10**7, 3000) / 1e4), *rng.normal(0, 1e5, 3000), 0.0, -0.0004, -0.0005, 2.6745, 1.0005, 1e13 / 3, 1e22, float("inf")]
    want = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double").orderBy("i").select(F.round("x", 3)).toPandas().iloc[:, 0].to_numpy()
    assert M._half_up(np.array(x), 3).tolist() == want.tolist()


def test_gram_of_missing_numbers_and_keys(spark):
    """A number that is missing counts as a missing cell, a gene without a name for nothing; no rows give none."""
    rows = [(1, 1, 2.0), (1, 2, None), (2, 2, 3.0), (2, 3, 5.0), (None, 1, 7.0)]
    got = {(r.a, r.b): r.g for r in M.sample_gram(spark.createDataFrame(rows, "gene long, sample long, v double"), 3).collect()}
    m = np.array([[2.0, 0, 0], [0, 3, 5]])
    z = m - m.mean(axis=1, keepdims=True)
    assert [got[a, b] for a in (1, 2, 3) for b in (1, 2, 3)] == pytest.approx((z.T @ z).ravel(), abs=1e-9)
    assert M.sample_gram(spark.createDataFrame([], "gene long, sample long, v double"), 3).count() == 0
