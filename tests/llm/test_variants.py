"""Spelling variants, source divergence and fingerprints against SQL and plain code, with odd rows."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
import xxhash
from loamframe.llm import queries as Q
from loamframe.llm import quality, spelling, syncmers
from pyspark.sql import functions as F

ODD = [
    (9, "the quick brown fox jumps over the lazy dog and runs", "en", "a"), (8, None, None, None), (7, "", "en", "b"), (6, " \t\n ", "en", "a"),
    (5, "the quick brown fox jumps over the lazy dog and runs", "en", "b"), (4, "Élan élan ÉLAN quick, quick. QUICK quick", "fr", "a"),
    (3, "nospace" * 3000, "en", "c"), (2, "word wort words word wort world " * 40, "en", "a"), (2, "word wort words word wort world " * 40, "en", "a"),
    (None, "quickly quickle quickle quickle quick1quick2", "en", ""), (1, "x", "", "a"), (0, "天地玄黄宇宙洪荒 日月盈昃 \U0001f600 the the the", "zh", "d"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Odd rows among others, with more columns whose names clash with the operators' own."""
    d = str(tmp_path_factory.mktemp("odd"))
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    rows.withColumns({c: F.lit("x") for c in ("key", "range", "word", "n", "chunk", "rid", "fingerprint")}).repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.mark.parametrize("name", ["op11_spelling", "op12_divergence"])
@pytest.mark.parametrize("where", ["odd", "/root/testdata/sf0.001"])
def test_against_sql(spark, folder, name, where):
    d = folder if where == "odd" else where
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet{'/*.parquet' if where == 'odd' else ''}'")
    cursor = db.execute(Q.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall())))
    got = Q.queries()[name](spark, d)
    assert sorted(got.columns) == sorted(names) and rows_of(got) == want


@pytest.mark.parametrize("name", ["op11_spelling", "op12_divergence", "op13_fingerprints"])
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert Q.queries()[name](spark, str(tmp_path)).count() == 0


# ---- spelling ----------------------------------------------------------------------------


def plainly_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize(("cell", "sample"), [(2_000, 100_000), (7, 40), (2, 10_000)])
def test_near_words_by_brute_force(spark, cell, sample):
    """Small cells, crowded cells that are cut in parts, anagrams and letters that share a dimension."""
    draw = random.Random(5)
    words = {"".join(draw.choice("abcé×") for _ in range(draw.randint(5, 7))) for _ in range(300)} | {"abcab", "bacab", "cabab", "x" * 3000, "x" * 2999 + "y", "x" * 3001}
    table = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(sorted(words))], "word string, n long")
    got = sorted((r.word, r.near) for r in spelling.near_words(table, cell, sample).collect())
    assert got == sorted((a, b) for a in words for b in words if plainly_near(a, b))


def test_damage_follows_the_checksum():
    import zlib

    hit = next(i for i in range(10_000) if zlib.crc32(f"{i}:été".encode()) % 97 == 0)
    at = zlib.crc32(f"{hit}:été".encode()) % 3
    assert spelling.damaged(b"%d:" % hit, "été".encode("latin-1")).decode("latin-1") == "été"[:at] + "été"[at + 1 :]


def test_long_chains_of_forms(spark):
    n = 70
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(n)] + [(f"v{i}", "w0") for i in range(300)], "word string, form string")
    got = {r.word: r.root for r in spelling.roots(forms).collect()}
    assert set(got.values()) == {f"w{n}"} and len(got) == n + 300


# ---- fingerprints ------------------------------------------------------------------------


def plain_hash(*values, seed=42):
    """Spark's xxhash64: each value with the hash before it as seed."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(4 if isinstance(v, np.int32) else 8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def plain_marks(text, k=5, s=2):
    import re

    words = re.findall(syncmers.WORD, text)
    if len(words) < k:
        found = [plain_hash(" ".join(words))] if words else []
    else:
        inner = [plain_hash(*words[i : i + s]) for i in range(len(words) - s + 1)]
        width = k - s + 1
        found, last = [], None
        for j in range(len(words) - k + 1):
            window = inner[j : j + width]
            if min(window) in (window[0], window[-1]):
                covers = sorted({*range(0, width, s), width - 1})
                found.append(plain_hash(plain_hash(*[window[i] for i in covers]), np.int32(0 if last is None else j - last)))
                last = j
    return list(dict.fromkeys(h & 0xFFFFFFFF for h in found))


def plain_sketch(marks, most=256):
    level = next(v for v in range(64) if len(marks) <= most << v)
    return level, [h for h in marks if h % (1 << level) == 0]


def plain_likeness(a, b):
    level = max(a[0], b[0])
    x, y = ([h for h in z[1] if h % (1 << level) == 0] for z in (a, b))
    return 1.0 if not a[1] and not b[1] else len(set(x) & set(y)) / max(len(x), len(y), 1)


def check_fingerprints(got, rows):
    """``rows``: (id, text) in the order in which they follow each other."""
    sketches = [plain_sketch(plain_marks(t)) for _, t in rows]
    for i, (d, t) in enumerate(rows):
        after = (i + 1) % len(rows)
        edited = t[: len(t) - len(t) // 3] + rows[after][1][: len(t) // 3]
        other = plain_sketch(plain_marks(edited))
        text = lambda x: f"{x[0]:02x}" + "".join(f"{h:08x}" for h in x[1])
        want = (len(t), hashlib.sha256(edited.encode()).hexdigest(), text(sketches[i]), text(other))
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == want
        assert r.near_edited == pytest.approx(plain_likeness(sketches[i], other)) and r.near_next == pytest.approx(plain_likeness(sketches[i], sketches[after]))


def test_fingerprints_by_plain_code(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in Q.op13_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    check_fingerprints(got, rows)
    assert np.median([r.near_edited for r in got.values()]) > 0.5 and np.median([r.near_next for r in got.values()]) == 0


def test_fingerprints_of_odd_rows(spark, folder):
    got = Q.op13_fingerprints(spark, folder).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[9][0].fingerprint == by[5][0].fingerprint  # equal texts
    assert by[2][0].fingerprint == by[2][1].fingerprint and sorted(r.near_next for r in by[2])[1] == 1.0  # repeated rows follow each other
    assert by[8][0].fingerprint == "00" and by[8][0].near_next == 1.0  # null is empty, and so is the next
    order = sorted((r for r in ODD if r[0] is not None), key=lambda r: -r[0]) + [r for r in ODD if r[0] is None]
    edges = {9: (ODD[0][1], ""), None: (ODD[9][1], ODD[0][1])}
    for d, (own, after) in edges.items():
        assert order[0][0] == 9 and by[d][0].edited_sha256 == hashlib.sha256((own[: len(own) - len(own) // 3] + after[: len(own) // 3]).encode()).hexdigest()


def test_fingerprints_stay_in_the_jvm(spark, folder):
    plan = Q.op13_fingerprints(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))
    assert plan.count("shufflepartitionidpassthrough") == 1 and "SortMergeJoin" not in plan  # texts move once


# ---- quality -----------------------------------------------------------------------------


@pytest.mark.parametrize("most", [328, 309, 300, 250, 100])
def test_quality_with_labels_around_the_bound(spark, most):
    """329 rows have labels and may be learned from; none of these bounds may fail."""
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(docs, labels, max_train=most)
    assert scored.where("score between 0 and 1").count() == docs.count()


def test_a_third_document_behind_rare_chunks(spark, tmp_path):
    """Three chunks of a term in three documents, of which first and last hide the one between; and in two documents."""
    rows = [(1, "a1x a2y", "en", "s"), (2, "hid1 hid2 two1 two2 two3", "en", "s"), (3, "hid3 (hid)", "en", "s"), (4, "hid1 hid2 hid4 two1 two2 two3", "en", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    from loamframe.llm.divergence import term_counts

    kept, _ = term_counts(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert {(r.term, r.n) for r in kept.collect()} == {("hid", 7)}


def test_a_block_sends_each_term_once(monkeypatch):
    """Chunks of one term are one row, with the documents that have it; documents add up over blocks."""
    import pyarrow as pa
    from loamframe.llm import divergence

    texts = [("en", "a", "Foo, foo. (foo) bar\nfoo\u00a0x"), ("en", "b", "FOO! 12 foo"), ("en", "a", "foo-foo \x00"), ("", "", ""), ("fr", "a", "foo")]
    batches = [pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "text"), ([v] for v in row), strict=True))) for row in texts]
    want = {("en", "a", "foo"): (5, 2), ("en", "a", "foo\u00a0x"): (1, 1), ("en", "a", "bar"): (1, 1), ("en", "b", "foo"): (2, 1), ("fr", "a", "foo"): (1, 1)}
    empty = {(lang, source, ""): (0, 0) for lang, source, _ in texts}
    for held in (10_000_000, 0):
        monkeypatch.setattr(divergence, "HELD", held)
        rows = [tuple(r.values()) for b in divergence._count_blocks(iter(batches)) for r in b.to_pylist()]
        if held:
            assert len(rows) == len(want) + len(empty)
        got = {}
        for *key, n, docs in rows:
            a, b = got.get(tuple(key), (0, 0))
            got[tuple(key)] = (a + n, b + docs)
        assert got == want | empty
