"""URL rules, vector links and the pipeline against brute force."""

import math
import random

import numpy as np
import pytest
from loamframe.llm import queries as Q
from loamframe.llm.url_rules import apply_url_rules
from loamframe.llm.vector_links import vector_links

RULES = "host string, path string, verdict string"


def brute_rule(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


@pytest.mark.parametrize("ranges", [1, 7])
def test_url_rules(spark, ranges):
    rng = random.Random(2)
    hosts = ["net", "example.net", "a.example.net", "xexample.net", "EXAMPLE.net", "org", "b.org", "example.com", "", ".net", "net.", "a..net", "example.net:80"]
    tails = ["", "/", "/en", "/en/", "/en/x?y=/de/", "?q", "#/fr/", "/fr/é", "/de/\nz"]
    urls = [rng.choice(["http://", "https://", "x://", ""]) + h + t for h in hosts for t in tails] * 2
    urls += [None, "", "no scheme", "a://b://c.net/", "http://hot.example.net/en/1"] + ["http://hot.example.net/en/"] * 200
    rules = [*Q.URL_RULES, ("example.net", "/", "allow"), ("a.example.net", "/en/x", "block"), ("net", "/en/", "block"), (None, "/", "block"), ("net", None, "block"), ("net", "/", "block")]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, rule string")
    got = apply_url_rules(pages, spark.createDataFrame(rules, RULES), ranges=ranges).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(r.url, rules), r.url
    assert apply_url_rules(pages.limit(0), spark.createDataFrame(rules, RULES)).count() == 0
    assert {r.verdict for r in apply_url_rules(pages, spark.createDataFrame([], RULES)).collect()} == {"allow"}


def brute_links(rows, threshold=0.93):
    ok = [v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None for (_, v, _), good in zip(rows, ok, strict=True)]
    link = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(len(rows))]
    out = []
    for i, (key, *_) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        out.append((key, len(link[i]), min(rows[j][0] for j in reach)))
    return sorted(out)


def test_vector_links(spark, monkeypatch):
    monkeypatch.setattr("loamframe.llm.vector_links.SHARD", 40)
    monkeypatch.setattr("loamframe.llm.vector_links.QUERIES", 30)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    rows = []
    for i in range(220):
        v = base[i % 12] + (0.25 if i % 3 else 0.9) * rng.normal(size=8) * (i % 5 > 0)
        rows.append((i, [float(np.float32(x)) for x in v], [0, 1, None][i % 7 % 3]))
    rows += [(300, None, 1), (301, [0.0] * 8, 1), (302, [float("nan")] * 8, 1), (303, [None] * 8, 1), (304, [], 1), (305, [1.0, 2.0], 1), (306, [1.0, 2.0], 1), (307, [float("inf")] * 8, 0)]
    got = vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vector_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vector_links_query(spark):
    where = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{where}/embeddings.parquet").collect()]
    want, got = brute_links(rows), sorted((r.vec_id, r.n_links, r.component_id) for r in Q.op6_embedding_links(spark, where).collect())
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_pipeline(spark):
    import corpus_pipeline as P
    from tests.llm.test_duplicates import brute_components, brute_repeats

    where = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{where}/documents.parquet")
    names = docs.columns
    good = P.quality(spark, docs, where)
    rows = {r.doc_id: r.text for r in good.collect()}
    scores = {r.doc_id: r.predicted for r in Q.op5_quality(spark, where).collect()}
    assert sorted(rows) == sorted(d for d, p in scores.items() if p) and good.columns == names
    one = P.exact(spark, good, where)
    last = {}
    for d, t in rows.items():
        last[t] = max(d, last.get(t, d))
    assert sorted(r.doc_id for r in one.collect()) == sorted(last.values()) and one.columns == names
    near = P.near(spark, one, where)
    rows = [(d, t) for t, d in last.items()]
    kept = sorted(int(c) for c in {c for _, _, c in brute_components(rows)})
    assert sorted(r.doc_id for r in near.collect()) == kept and near.columns == names
    rows = [(d, t) for d, t in rows if d in set(kept)]
    cut = P.repeats(spark, near, where)
    want = {int(d): (n, text) for d, _, n, _, text in brute_repeats(rows)}
    for r in cut.collect():
        n, text = want[r.doc_id]
        assert r.text == (text if n else dict(rows)[r.doc_id]) and (not n or r.n_chars == len(text))
    assert cut.columns == names
    assert sorted({r.doc_id for r in P.run(spark, where).select("doc_id").collect()}) == kept


def test_wide_vectors_with_groups(spark):
    """64 dimensions, groups from two to hundreds around the threshold, several shards; links come back nearly all."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 64))
    picks = np.concatenate([rng.integers(0, 400, 2200), np.zeros(500, int)])
    v = base[picks] + rng.choice([0.12, 0.26, 0.3], len(picks))[:, None] * rng.normal(size=(len(picks), 64))
    rows = [(i, [float(np.float32(x)) for x in v[i]], int(i % 2)) for i in range(len(v))] + [(9000 + i, [float(np.float32(x)) for x in v[0]], 0) for i in range(30)]
    truth = {k: (n, c) for k, n, c in brute_links(rows)}
    got = vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)).collect()
    assert all(r.n_links <= truth[r.vec_id][0] for r in got)
    assert sum(r.n_links for r in got) >= 0.99 * sum(n for n, _ in truth.values()) > 10_000
    assert np.mean([r.component_id == truth[r.vec_id][1] for r in got]) > 0.99
    assert got[0].audited_recall >= 0.99


def test_vectors_with_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1, 7, "x"), (None, [1.0, 0.0], 1, 8, None), (2, [1.0, 1e-3], 1, 9, "y"), (2, [1.0, 1e-3], 1, 9, "y"), (3, [1e300, 1e300], 1, 0, "z")]
    got = vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int, rid string")).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got) == [("1", 3, 1), ("2", 3, 1), ("2", 3, 1), ("3", 0, 3), ("None", 3, 1)]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rid string, place string"


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    """Null ids and texts, empty, blank and long texts, repeated rows, clashing columns; every stage alone, then all."""
    import corpus_pipeline as P

    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good = "Plain words make a sentence. " * 3
    texts = [(1, good), (2, good), (2, good), (None, None), (None, ""), (3, ""), (4, " \n"), (5, "word " * 30_000), (6, None), (-(2**63), "unlike all others"), (7, " ".join(f"w{i}" for i in range(40))), (8, " ".join(f"w{i}" for i in range(30)) + " tail")]
    rows = [(d, t, None, "s", None, "r", None) for d, t in texts]
    docs = spark.createDataFrame(rows, COLUMNS)
    for stage, least in (("quality", 0), ("exact", 7), ("near", 9), ("repeats", 12)):
        made = dict(P.STAGES)[stage](spark, docs, str(tmp_path))
        assert made.columns == docs.columns and least <= made.count() <= len(rows), stage
        assert dict(P.STAGES)[stage](spark, docs.limit(0), str(tmp_path)).count() == 0, stage
    kept = {r.doc_id: r.text for r in dict(P.STAGES)["repeats"](spark, docs, str(tmp_path)).collect() if r.doc_id in (7, 8)}
    assert kept == {7: texts[10][1], 8: "tail"}
    packed = P.packing(spark, docs, str(tmp_path)).collect()
    assert {str(r.doc_id) for r in packed} == {str(d) for d, _ in texts} and P.packing(spark, docs.limit(0), str(tmp_path)).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} <= {d for d, _ in texts}
