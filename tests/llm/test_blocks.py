"""Blocks of documents do not depend on how Arrow batches a scan."""

import random

import numpy as np
import pyarrow as pa
import pytest
from loamframe.llm import exchange
from loamframe.llm.exchange import read_blocks
from loamframe.llm.jaccard import near_duplicates
from loamframe.llm.substrings import without_repeats


def cut(texts, batch, slice_bytes, monkeypatch):
    monkeypatch.setattr("loamframe.llm.words.SLICE", slice_bytes)
    table = pa.table({"rid": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    out = []
    for b in read_blocks(iter(table.to_batches(batch)), False, keep_bytes=True):
        assert sum(len(x) for x in b.rid) == sum(n for *_, n in b.rows) == sum(len(p[4]) - 1 for p in b.parts)
        seen = [[bytes(d[s:e]) for s, e in zip(starts, ends, strict=True)] for d, starts, ends, _, _ in b.parts]
        counts = np.concatenate([np.diff(p[4]) for p in b.parts]).tolist()
        out.append((b.sub, np.concatenate(b.rid).tolist(), sum(seen, []), np.concatenate([p[3] for p in b.parts]).tolist(), counts))
    return out


@pytest.mark.parametrize(("words", "size"), [(50, 1 << 26), (1_000_000, 300)])
def test_blocks_do_not_follow_batches(monkeypatch, words, size):
    monkeypatch.setattr(exchange, "BLOCK_WORDS", words)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", size, raising=False)
    rng = random.Random(1)
    texts = [None if rng.random() < 0.1 else " ".join(rng.choice("abé") * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 9, 30, 70]))) for _ in range(200)]
    want = cut(texts, 200, 1 << 21, monkeypatch)
    assert len(want) > 5 and [w.decode() for _, _, s, *_ in want for w in s] == [w for t in texts for w in (t or "").split()]
    for batch, slice_bytes in ((1, 1 << 21), (7, 1 << 21), (64, 90), (200, 300)):
        assert cut(texts, batch, slice_bytes, monkeypatch) == want


def test_passes_agree_under_small_batches(spark):
    """Passes over (rid, text) and over all columns get other batches, yet the same blocks."""
    rng = random.Random(2)
    shared = " ".join(f"s{i}" for i in range(40))
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=28_000)) + (f" {shared}" if i in (3, 57) else "") for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    key, before = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.set(key, 1 << 20)
        got = {r.doc_id: r.text for r in without_repeats(docs).collect()}
        near = near_duplicates(docs).collect()
    finally:
        spark.conf.set(key, before)
    assert len(got) == 60 and got[3] == texts[3] and shared not in got[57] and got[57] == texts[57].removesuffix(f" {shared}")
    assert all(r.kept for r in near)
