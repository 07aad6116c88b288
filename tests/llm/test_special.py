"""Strings of special tokens inside texts: op2, op3 and the pipeline give their ids, op7 does not."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
from loamframe.llm import queries as Q
from loamframe.llm.chunks import ChunkEncoder, encoder
from tokenizers import Tokenizer

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
TEXTS = ["see <|endoftext|> b", "see <|ENDOFTEXT|> b", "<|endoftext|>", "A<|startoftext|>  B\r\n", "<|endoftext|><|endoftext|>x", "ab <|endof text|>", "É <|startoftext|>É", "plain", "", "long " * 60 + "<|endoftext|> end", "Long " * 60]


def plain(path):
    t = Tokenizer.from_file(path)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_strings(path, monkeypatch):
    monkeypatch.setattr("loamframe.llm.chunks.SEGMENT", 64)
    enc, ref = ChunkEncoder(path, special=True), plain(path)
    for _ in range(2):
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode_all(TEXTS)] == [ref(t) for t in TEXTS]
    assert encoder(path, True) is not encoder(path) and encoder(path).tokenizer.encode_special_tokens


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_queries(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    ref = plain(BYTE)
    at = 0
    for r, (d, t) in zip(sorted(Q.op2_token_store(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id), rows, strict=True):
        ids = [*ref(t), 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), crc(ids))
        at += len(ids)
    ref = plain(WORD)
    want = [(d, len(ref(t)) + 1, crc([*ref(t), 2])) for d, t in rows]
    for got in (Q.op3_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.doc_tokens, r.ids_crc32) for r in got.collect()) == want
    ordinary = Tokenizer.from_file(BYTE)
    ordinary.encode_special_tokens = True
    assert sorted((r.doc_id, r.n_tokens) for r in Q.op7_token_counts(spark, str(tmp_path)).collect()) == [(d, len(ordinary.encode(t, add_special_tokens=False).ids)) for d, t in rows]
