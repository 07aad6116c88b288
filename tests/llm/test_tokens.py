"""Tokenising operators against the libraries themselves."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from loamframe.llm import queries as Q
from loamframe.llm.chunks import ChunkEncoder
from loamframe.llm.duck_bpe import DuckBpe, bpe_encode_decode
from loamframe.llm.packing import pack_documents, solve_patterns
from loamframe.llm.token_counts import count_tokens, document_token_counts, write_flat_files
from loamframe.llm.token_store import decode_ranks, encode_ranks, read_token_files, store_tokens, write_token_files
from loamframe.llm.shared import scratch
from tokenizers import Tokenizer

BYTE, WORD, RANKS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\n b", "x \ny", "\r\n a", "É é ΑΣ ΑΣΑ", "it's we'll 'S", "\t tab\tx", "a\x85b\xa0c", "<|endoftext|> b", "🙂🙂 x", "1234 5 67,89", "ñ" * 700, "ab" * 400, "a" * 999, "\x00\x01 z", "Σας\nΣ", "a\x1cb \x1c", "long " * 3000]
DOCS = "doc_id long, text string, n_tokens string"


def whole(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_equal_whole_texts(path, monkeypatch):
    monkeypatch.setattr("loamframe.llm.chunks.SEGMENT", 64)
    enc, ref = ChunkEncoder(path), whole(path)
    for _ in range(2):
        for t, got in zip(ODD, enc.encode_all(ODD), strict=True):
            assert np.frombuffer(got, enc.dtype).tolist() == ref(t), repr(t[:30])


def test_other_makes_encode_whole(tmp_path):
    """A tokenizer whose file differs from the two makes is not cut."""
    import json

    config = json.load(open(BYTE, encoding="utf-8"))
    config["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    enc, ref = ChunkEncoder(str(path)), whole(str(path))
    assert not enc.cuts and ChunkEncoder(BYTE).cuts and ChunkEncoder(WORD).cuts
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode_all(ODD)] == [ref(t) for t in ODD]


def test_random_texts():
    """Texts of a few awkward characters, all encoders, in one call each."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abT's .,\n\t\r\x85\xa0éΣ1²-_"))
    texts = ["".join(rng.choice(letters, rng.integers(0, 14))) for _ in range(3000)]
    for path in (BYTE, WORD):
        enc, ref = ChunkEncoder(path), whole(path)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode_all(texts)] == [ref(t) for t in texts]
    bpe, t = DuckBpe(RANKS, P.PATTERN), tik()
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_all(texts)] == [t.encode_ordinary(x) for x in texts]


def test_duck_bpe_equals_tiktoken(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (3, "a", None), (3, "a", None)]
    got = bpe_encode_decode(spark.createDataFrame(rows, DOCS), RANKS, P.PATTERN, keep_ids=True).collect()
    assert len(got) == len(rows)
    enc = tik()
    for (doc_id, text, _), r in zip(rows, got, strict=True):
        ids = enc.encode_ordinary(text or "")
        assert (r.doc_id, r.ids, r.n_tokens) == (doc_id, ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert bytes(r.decoded) == (text or "").encode() and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_long_words_contract_in_sql():
    """Words of thousands of bytes: letters, one letter over and over, other scripts; also short words in the long form."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 1500)), "a" * 5001, "ab" * 900, "的一是不了人我在" * 90, "".join(rng.choice(list("aab"), 400)), "x" * 65, "é" * 64]
    bpe, t = DuckBpe(RANKS, P.PATTERN), tik()
    texts = [*words, " ".join(words), "\n\n".join(words) + "  "]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_all(texts)] == [t.encode_ordinary(x) for x in texts]


def test_tokens_contract_to_themselves():
    """What the long form rests on, for the whole vocabulary."""
    from loamframe.llm import duck_bpe

    bpe = DuckBpe(RANKS, P.PATTERN)
    tokens = [t for t in bpe.ranks if len(t) > 1]
    want = [np.array([bpe.ranks[t]], "<u4").tobytes() for t in tokens]
    assert bpe._contract(tokens, duck_bpe._CONTRACT) == want and bpe._contract(tokens, duck_bpe._CONTRACT_LONG) == want


def test_long_form_equals_short_form(monkeypatch):
    monkeypatch.setattr("loamframe.llm.duck_bpe.LONG_WORD", 0)
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abthe ins'éΣ12 "), rng.integers(0, 60))) for _ in range(400)]
    bpe, t = DuckBpe(RANKS, P.PATTERN), tik()
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_all(texts)] == [t.encode_ordinary(x) for x in texts]


def test_empty_and_odd_tables(spark):
    """Empty tables, ids that look like null, columns that are called like results."""
    none = spark.createDataFrame([], DOCS)
    rows = [(-(2**63), "one", "x"), (None, "two", "y"), (None, None, None), (7, "", None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = sorted(str(r[0]) for r in rows)
    for f in (lambda d: bpe_encode_decode(d, RANKS, P.PATTERN), lambda d: store_tokens(d, BYTE, 0), lambda d: document_token_counts(d, BYTE, 50256), lambda d: pack_documents(d, WORD, 2)):
        assert f(none).count() == 0
        assert sorted(str(r.doc_id) for r in f(docs).collect()) == want


def test_hot_ids_in_token_files(spark):
    """Equal and null ids may fill several files and keep the scan's order."""
    rows = [(7 if i % 3 else None, f"t{i}", None) for i in range(60)]
    manifest = write_token_files(spark.createDataFrame(rows, DOCS).coalesce(1), BYTE, 0, scratch(spark, "hot"), files=5)
    assert manifest.count() > 2
    got = sorted(read_token_files(spark, manifest, with_ids=True).collect(), key=lambda r: r.start)
    ref = whole(BYTE)
    assert [r.ids for r in got] == [[*ref(t), 0] for d, t, _ in sorted(rows, key=lambda r: r[0] or 0)]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_rank_coding_round_trip(ranks):
    a = np.array(ranks, np.uint32)
    assert decode_ranks(*encode_ranks(a), len(a)).tolist() == ranks


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr("loamframe.llm.token_store.BLOCK_IDS", 50)
    rows = [(100 - i, t, None) for i, t in enumerate(ODD)] + [(None, None, "y"), (7, "same", None), (7, "same", None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    manifest = write_token_files(docs, BYTE, 0, scratch(spark, "t"))
    got = sorted(read_token_files(spark, manifest, with_ids=True).collect(), key=lambda r: r.start)
    ref, at = whole(BYTE), 0
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    assert [r.doc_id for r in got] == [r[0] for r in order]
    for r, (_, text, _) in zip(got, order, strict=True):
        ids = [*ref(text), 0]
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert store_tokens(docs.limit(0), BYTE, 0).count() == 0


def test_token_counts(spark, monkeypatch):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(None, None, None), (5, "x y", None), (5, "x y", None)]
    docs = spark.createDataFrame(rows, DOCS)
    ref = whole(BYTE)
    want = sorted((str(d), len(ref(t))) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in document_token_counts(docs, BYTE, 50256).collect()) == want
    where = scratch(spark, "flat")
    files = write_flat_files(docs.coalesce(1), BYTE, 50256, where)
    for block in (1, 2, 3, 1000):  # documents over many blocks
        got = count_tokens(files, where, 50256, block_ids=block).join(files, ["file", "ordinal"]).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    assert document_token_counts(docs.limit(0), BYTE, 50256).count() == 0


def check_packing(pieces, want, capacity):
    """Every id in one piece, no gaps; returns the padding's share."""
    for key, ids in want.items():
        own = sorted((p for p in pieces if p.doc_id == key), key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    total = padded = 0
    for own in by.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        total, padded = total + at, padded + (at if at & (at - 1) == 0 else capacity)
    assert sorted(by) == list(range(len(by)))
    return 1 - total / padded if padded else 0


def test_packing(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(None, None, None)]
    got = pack_documents(spark.createDataFrame(rows, DOCS), WORD, 2, capacity=64, keep_ids=True).collect()
    ref = whole(WORD)
    check_packing(got, {d: [*ref(t), 2] for d, t, _ in rows}, 64)
    assert all(len(p.ids) == p.length for p in got)
    assert pack_documents(spark.createDataFrame([], DOCS), WORD, 2).count() == 0
    twice = pack_documents(spark.createDataFrame([(1, "a b", None)] * 2, DOCS), WORD, 2).collect()
    assert sorted(p.offset for p in twice) == [0, 3]


def test_packing_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    ref = whole(WORD)
    share = check_packing(Q.op3_packing(spark, "/root/testdata/sf0.001").collect(), {r.doc_id: [*ref(r.text), 2] for r in docs}, 4096)
    assert share < 0.03


@given(st.lists(st.integers(0, 30), min_size=32, max_size=32))
@settings(max_examples=50, deadline=None)
def test_patterns_meet_demand(demand):
    d = np.array(demand)
    plan = solve_patterns(d)
    assert (sum((p * n for p, n in plan), np.zeros(32, int)) == d).all()
    sizes = np.arange(1, 33)
    assert all((p @ sizes) <= 32 for p, _ in plan)
    used, least = sum(n for _, n in plan), -(-int(d @ sizes) // 32)
    assert used <= least * 1.3 + 33
