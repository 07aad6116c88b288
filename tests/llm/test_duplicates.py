"""Duplicate operators and the classifier against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from loamframe.llm import golomb
from loamframe.llm import queries as Q
from loamframe.llm.components import components
from loamframe.llm.exact import drop_exact_duplicates, exact_duplicates
from loamframe.llm.jaccard import near_duplicates
from loamframe.llm.quality import grow, score_quality, statistics
from loamframe.llm.substrings import remove_repeats, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_words string, rid string"


@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.sampled_from([1, 2**20, 2**64]))
@settings(deadline=None)
def test_golomb_round_trip(values, below):
    a = np.sort(np.array([v % below for v in values], np.uint64))
    assert golomb.decode(golomb.encode(a)).tolist() == a.tolist()


def made_docs(seed=3, n=120):
    """Short texts over few words: copies, near copies, shared passages, odd cases."""
    rng = random.Random(seed)
    vocabulary = [f"{c}{i}" for c in "AaBb" for i in range(60)]
    fresh = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    texts = []
    passage = fresh(20)
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0 and texts:
            texts.append(rng.choice(texts))
        elif kind == 1 and texts:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
        elif kind == 2:
            texts.append(" ".join(fresh(15) + passage + fresh(15)))
        else:
            texts.append(rng.choice([" ", "\n", "\t "]).join(fresh(rng.choice([1, 3, 4, 5, 6, 12, 13, 14, 40, 90]))))
    rows = [(i, t, "x", None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    odd = [(1000, None, None, None), (1001, "", "y", None), (1002, " \n\t", None, None), (None, texts[0], None, None), (None, texts[0], None, None), (5, texts[5], None, None), (1003, "x " * 3000, None, None), (1004, "é ß ñ " * 9, None, None), (1005, "é ß ñ " * 9 + "q", None, None)]
    return rows + odd


def brute_components(rows):
    def shingles(t):
        w = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t, *_ in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                top[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((str(d), len(s), str(least.get(root(i)))) for i, ((d, *_), s) in enumerate(zip(rows, sets, strict=True))))


@pytest.mark.parametrize(("stars", "small", "block"), [(0, 2, 5), (2, 12, 256)])
def test_near_duplicates(spark, monkeypatch, stars, small, block):
    for name, value in (("STARS", stars), ("SMALL", small), ("BLOCK", block)):
        monkeypatch.setattr(f"loamframe.llm.jaccard.{name}", value)
    monkeypatch.setattr("loamframe.llm.shared.FEW", 0 if stars else 10_000)
    rows = made_docs()
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.component_id if r.n_shingles else ("alone", r.rid), []).append(r.kept)
    assert all(sum(kept) == 1 for kept in groups.values())


def test_near_duplicates_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = Q.op9_jaccard(spark, "/root/testdata/sf0.001").collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)


def brute_repeats(rows):
    last = 2**63 - 1
    words = [(last if d is None else d, WORD.findall(t or "")) for d, t, *_ in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, w), (own, *_) in zip(words, rows, strict=True):
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(own), len(w), len(gone), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out)


@pytest.mark.parametrize("block", [50, 2_000_000])
def test_repeats(spark, monkeypatch, block):
    monkeypatch.setattr("loamframe.llm.exchange.BLOCK_WORDS", block)
    rows = made_docs(seed=8)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = remove_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_repeats(rows)
    assert all(sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_removed for r in got)
    stage = without_repeats(docs)
    assert stage.columns == docs.columns and stage.count() == len(rows)


def test_exact(spark):
    rows = made_docs(seed=4)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = exact_duplicates(docs).collect()
    by = {}
    for d, t, *_ in rows:
        by.setdefault(t or "", []).append(d)
    want = sorted((str(d), str(max((x for x in by[t or ""] if x is not None), default=None)), len(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(by)
    assert sorted(r.text or "" for r in drop_exact_duplicates(docs).collect()) == sorted(by)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for f in (exact_duplicates, near_duplicates, remove_repeats, lambda d: score_quality(d, labels)):
        assert f(none).count() == 0


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
@settings(max_examples=4, deadline=None)
def test_components(spark, edges):
    top = list(range(13))
    for _ in range(13):
        for u, v in edges:
            top[u] = top[v] = min(top[u], top[v])
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {x: top[x] for u, v in edges if u != v for x in (u, v)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_quality_held_out(spark):
    where = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.op5_quality(spark, where).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{where}/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [(r.score, labels[d]) for d, r in got.items() if r.held_out and d in labels]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.9


def test_quality_odd_rows(spark):
    rows = [(None, None, None, None), (1, "", None, None), (2, "GO!! NOW!!", None, None), (2, "GO!! NOW!!", None, None), (3, "a\x00b " * 50_000, None, None)]
    got = score_quality(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(2, None), (None, 1)], "doc_id long, quality int")).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got)
    x = np.stack([statistics(t) for t in ("one two three. four", "GO!! NOW!!")] * 40)
    forest = grow(x.astype(float), np.array([1.0, 0.0] * 40))
    assert (forest.score(x[:2]) > 0.5).tolist() == [True, False]


def morse(k):
    """The Thue-Morse word of 2**k letters and its complement, which polynomial hashes with 64 bits cannot tell apart."""
    w = "a"
    for _ in range(k):
        w += w.translate(str.maketrans("ab", "ba"))
    return w, w.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomials_confuse(spark):
    a, b = morse(11)
    tail = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([a, *tail[:12]])), (2, " ".join([b, *tail[:12]])), (3, " ".join([a] * 13)), (4, " ".join([b] * 13)), (5, " ".join([b, a] * 20)), (6, " ".join([a, b] * 20)), (7, " ".join(["q" * 17] * 14)), (8, " ".join(["q" * 18] * 14))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_repeats(rows)
    got = near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)


def test_settings_are_left_alone_and_random_plans_are_written(spark):
    from loamframe.llm.shared import PINNED, stable

    before = {k: spark.conf.get(k, None) for k in PINNED}
    where = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(where)
    half = docs.where("rand() < 0.5")
    assert stable(docs.where("doc_id > 3").select("doc_id", "text")) is not docs and not hasattr(stable(docs.where("doc_id > 3")), "scratch_path")
    assert hasattr(stable(half), "scratch_path")
    for f in (remove_repeats, near_duplicates, exact_duplicates):
        assert 0 < f(half).count() < docs.count()
    kept = drop_exact_duplicates(half)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in kept.collect())
    assert {k: spark.conf.get(k, None) for k in PINNED} == before


def test_ids_that_look_like_none(spark):
    rows = [(-(2**63), "one text here", "x", None), (None, "one text here", "y", None), (2**63 - 1, "", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    for f in (exact_duplicates, near_duplicates, remove_repeats, lambda d: score_quality(d, spark.createDataFrame([], "doc_id long, quality int"))):
        assert sorted(str(r.doc_id) for r in f(docs).collect()) == sorted(str(r[0]) for r in rows)


def test_joins_of_hot_keys(spark, monkeypatch):
    from loamframe.llm.shared import salted_join

    monkeypatch.setattr("loamframe.llm.shared.FEW", 0)

    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 0 else id end as k")
    keyed = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    for how in ("inner", "left"):
        got = salted_join(rows, keyed, ["k"], ["id"], 5000, how)
        want = rows.join(keyed, "k", how)
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))


def walk(forest, row, root):
    """One tree, one row, one node at a time."""
    at = root
    while forest.left[at] != at:
        at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
    return forest.value[at]


def test_trees_against_plain_search(monkeypatch):
    """Flat traversal equals a walk; the first split equals the best of a search over all cuts."""
    monkeypatch.setattr("loamframe.llm.quality.TREES", 3)
    from loamframe.llm import quality

    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(400, 4)), 1)
    y = ((x[:, 1] > 0.3) ^ (rng.random(400) < 0.1)).astype(float)
    forest = grow(x, y)
    want = [1 / (1 + np.exp(-(forest.base + sum(walk(forest, r, root) for root in forest.roots)))) for r in x]
    assert forest.score(x) == pytest.approx(want)
    rate = (y.sum() + 1) / 402
    g, h = rate - y, np.full(400, rate * (1 - rate))
    best = (-1, None)
    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < quality.LEAST:
                continue
            gain = sum(g[m].sum() ** 2 / (h[m].sum() + quality.LAMBDA) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + quality.LAMBDA)
            if gain > best[0] + 1e-9:
                best = (gain, (f, cut))
    root = forest.roots[0]
    assert (forest.feature[root], forest.threshold[root]) == (best[1][0], pytest.approx(best[1][1]))


def test_training_rows_are_bounded(spark):
    """Of more labelled rows than the bound those of least hash are taken, wherever they lie."""
    rows = [(i, ("good plain words here. " if i % 2 else "BAD!! $$$ ") * 3, None, None) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    got = {r.doc_id: r for r in score_quality(docs, labels, max_train=100).collect()}
    assert len(got) == 600 and all((r.score > 0.5) == bool(d % 2) for d, r in got.items())


def test_sql_of_duplicates(spark):
    import duckdb

    where = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{where}/{t}.parquet'")
    for name in ("op6_embedding_links", "op8_exact_dedup", "op9_jaccard", "op10_substrings"):
        got = Q.queries()[name](spark, where)
        c = db.execute(Q.oracle_sql()[name])
        names = [x[0] for x in c.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted(map(str, c.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in got.collect())


def test_pairs_stay_inside_tasks(spark, monkeypatch):
    """Many sets around the threshold: components as by brute force, and blocks give fewer links than members."""
    from loamframe.llm import jaccard

    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(300):
        w = list(base)
        for i in rng.choice(60, rng.integers(0, 3), replace=False):
            w[i] = f"x{rng.integers(3)}"
        rows.append((d, " ".join(w), None, None))
    given, kept = [], jaccard._blocks

    def blocks(members, *rest):
        out = kept(members, *rest)
        cells = members.where(f"size > {jaccard.SMALL}").groupBy("token").agg({"*": "count"}).collect()
        given.append((out.count(), sum(n * -(-n // jaccard.BLOCK) for _, n in cells), len(cells)))
        return out

    monkeypatch.setattr(jaccard, "_blocks", blocks)
    for name, value in (("STARS", 0), ("BLOCK", 40)):
        monkeypatch.setattr(jaccard, name, value)
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)
    (links, members, cells), *_ = given
    assert cells and 0 < links < members
