"""Mergeable summaries within their bounds; the local trend and batches with a model kept, against plain numpy."""

import random

import numpy as np
import pandas as pd
import pytest
from loamframe.operators import models as M
from loamframe.operators import profiles as P
from pyspark.sql import functions as F


def test_summaries_merge_within_their_bounds(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("ACGTN") for _ in range(n))
    rows = [(lane, s := letters(rng.randrange(1, 60)), "".join(chr(33 + rng.randrange(2, 41)) for _ in s)) for lane in range(3) for _ in range(3000)]
    rows += [(3, rows[i][1], rows[i][2]) for i in range(0, 6000, 2)] + [(4, None, None), (4, "", "")]
    reads = spark.createDataFrame(rows, "lane int, seq string, qual string")
    lanes = P.read_summary(reads, "lane").withColumn("sample", F.lit("s"))
    got = P.summary_table(P.merged_summary(lanes, "sample"), "sample").first()
    seqs = [s or "" for _, s, _ in rows]
    quals = [[ord(c) - 33 for c in q or ""] for _, _, q in rows]
    assert (got.reads, got.letters, got.shortest, got.longest) == (len(rows), sum(map(len, seqs)), 0, max(map(len, seqs)))
    assert got.gc_pct == pytest.approx(100 * sum(s.count("G") + s.count("C") for s in seqs) / got.letters) and got.unknown_pct == pytest.approx(100 * sum(s.count("N") for s in seqs) / got.letters)
    assert got.mean_quality == pytest.approx(sum(map(sum, quals)) / got.letters)
    assert abs(got.distinct_reads / len(set(seqs)) - 1) < 0.05
    sizes, means = np.sort([len(s) for s in seqs]), np.sort([np.mean(q) for q in quals if q])
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        for values, x in ((sizes, got[f"length_{name}"]), (means, got[f"quality_{name}"])):
            assert np.searchsorted(values, x, "left") / len(values) - 0.03 < share < np.searchsorted(values, x, "right") / len(values) + 0.03
    one = P.summary_table(P.read_summary(reads.where("lane = 4"), "lane"), "lane").first()
    assert (one.reads, one.letters, one.mean_quality, one.quality_median, one.gc_pct) == (2, 0, None, None, 0.0)


def test_boxes_merge(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=4000), 6)
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(values)] + [("c", None), ("c", float("nan")), ("c", float("inf")), ("d", 2.0)]
    table = spark.createDataFrame(rows, "part string, v double").withColumn("all", F.lit(1))
    got = P.box_statistics(P.merged_boxes(P.box_summary(table.where("part < 'c'"), "all", "part"), "all"), "all").first()
    assert (got.n, got.min, got.max) == (4000, values.min(), values.max()) and got["mean"] == pytest.approx(values.mean()) and got["std"] == pytest.approx(values.std(ddof=1))
    order = np.sort(values)
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert abs(np.searchsorted(order, got[name]) / 4000 - share) < 0.03
    assert got.low_fence == pytest.approx(max(order[0], got.q1 - 1.5 * (got.q3 - got.q1)))
    odd = {r.part: r for r in P.box_statistics(P.box_summary(table, "part"), "part").collect()}
    assert (odd["c"].n, odd["c"].without, odd["c"].median, odd["c"].low_fence) == (0, 3, None, None) and (odd["d"].n, odd["d"].q1, odd["d"]["std"]) == (1, 2.0, None)
    assert sum(r["values"] for r in P.histogram(table.where("part < 'c'"), 0.5).collect()) == 4000


def points(x, y):
    return pd.DataFrame({"w": 1.0, "x": x, "y": y, "xx": 0.0, "xy": 0.0})


def test_local_trend_over_summaries(spark):
    """Within one per cent of the local regression over all genes; a straight line comes back as it is."""
    rng = np.random.default_rng(2)
    x = np.sort(np.concatenate([rng.normal(6, 2, 4000), rng.uniform(-3, 16, 300)]))
    y = 1.2 - 0.5 * np.tanh((x - 5) / 3) + rng.normal(0, 0.1, len(x))
    genes = spark.createDataFrame(pd.DataFrame({"level": x, "root": y}))
    held = M.level_summary(genes, 300)
    assert held["w"].sum() == len(x) and len(held) <= 300
    want = M.local_line(points(x, y))
    got = np.interp(x, held["x"], M.local_line(held))
    inside = slice(20, -20)
    assert np.max(np.abs(got / want - 1)[inside]) < 0.01
    assert np.allclose(M.local_line(points(x[::9], 3 - 0.25 * x[::9])), 3 - 0.25 * x[::9])
    # the line itself, by least squares with the same weights, at one place
    at, near = x[1000], np.argsort(np.abs(x - x[1000]), kind="stable")
    reach = np.abs(x - at)[near[int(np.searchsorted(np.arange(1, len(x) + 1), len(x) / 2))]]
    w = np.sqrt(np.clip(1 - (np.abs(x - at) / reach) ** 3, 0, None) ** 3)
    beta = np.linalg.lstsq(np.stack([w, w * x], 1), w * y, rcond=None)[0]
    assert want[1000] == pytest.approx(beta[0] + beta[1] * at, rel=1e-5)


def plain_adjusted(v, batch, group, rounds=30):
    """The same steps with numpy; ``v``: genes by samples."""
    levels = sorted(set(batch))
    b = np.stack([(np.array(batch) == x).astype(float) for x in levels], 1)
    x = np.column_stack([b, group])
    beta = np.linalg.lstsq(x, v.T, rcond=None)[0]
    grand, part = (b.mean(0) @ beta[: len(levels)])[:, None], np.outer(beta[-1], group)
    sd = np.sqrt(((v.T - x @ beta) ** 2).mean(0))[:, None]
    z = (v - grand - part) / sd
    out = np.empty_like(z)
    for k in range(len(levels)):
        own = z[:, b[:, k] > 0]
        n, g, d = own.shape[1], own.mean(1), own.var(1, ddof=1)
        g0, t0, dm, dv = g.mean(), g.var(ddof=1), d.mean(), d.var(ddof=1)
        a, c = (2 * dv + dm**2) / dv, (dm * dv + dm**3) / dv
        mean, var = g.copy(), d.copy()
        for _ in range(rounds):
            mean = (n * t0 * g + var * g0) / (n * t0 + var)
            var = (c + ((own - mean[:, None]) ** 2).sum(1) / 2) / (n / 2 + a - 1)
        out[:, b[:, k] > 0] = (own - mean[:, None]) / np.sqrt(var)[:, None]
    return out * sd + grand + part


def test_a_group_that_goes_with_the_batch_survives(spark):
    rng = np.random.default_rng(4)
    batch = ["x"] * 8 + ["y"] * 8
    group = np.array([0] * 6 + [1] * 2 + [0] * 2 + [1] * 6, float)
    effect = rng.normal(0, 1, 60)
    shift, scale = rng.normal(3, 1, 60), rng.uniform(1, 3, 60)
    v = rng.normal(5, 0.3, (60, 16)) + np.outer(effect, group)
    v[:, 8:] = (v[:, 8:] - 5) * scale[:, None] * 0.4 + 5 + shift[:, None] + np.outer(effect * (1 - 0.4 * scale), group[8:])
    samples = [f"s{i:02}" for i in range(16)]
    values = spark.createDataFrame([(f"g{g:02}", s, float(v[g, i])) for g in range(60) for i, s in enumerate(samples)] + [("flat", s, 7.0) for s in samples], "gene string, sample string, v double")
    batches = spark.createDataFrame(list(zip(samples, batch, strict=True)), "sample string, batch string")
    made = M.design(spark.createDataFrame([(s, "case" if g else "ctl") for s, g in zip(samples, group, strict=True)], "sample string, grp string"), "grp", "ctl")
    rows = {(r.gene, r["sample"]): r.v for r in M.adjust_batches(values, batches, kept=made).collect()}
    got = np.array([[rows[f"g{g:02}", s] for s in samples] for g in range(60)])
    assert np.allclose(got, plain_adjusted(v, batch, group), atol=1e-6) and all(abs(rows["flat", s] - 7) < 1e-9 for s in samples)
    told = got[:, group > 0].mean(1) - got[:, group == 0].mean(1)
    assert np.corrcoef(told, effect)[0, 1] > 0.95 and abs(np.polyfit(effect, told, 1)[0] - 1) < 0.15
    blind = {(r.gene, r["sample"]): r.v for r in M.adjust_batches(values, batches).collect()}
    lost = np.array([[blind[f"g{g:02}", s] for s in samples] for g in range(60)])
    assert np.abs(np.polyfit(effect, lost[:, group > 0].mean(1) - lost[:, group == 0].mean(1), 1)[0]) < 0.8
    same = M.design(spark.createDataFrame([(s, b) for s, b in zip(samples, batch, strict=True)], "sample string, grp string"), "grp", "x")
    with pytest.raises(ValueError, match="told apart"):
        M.adjust_batches(values, batches, kept=same)
