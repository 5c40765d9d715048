"""Tokenization, token files, packing and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm.packing import difference, pack, pack_documents, packed_sequences
from plumbline.llm.token_files import Codes, encode_codes, token_digests
from plumbline.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "  a", "a  b ", "a\n\n b", "it's don't", "a<|endoftext|>b", "x\u00a0 y", "x\u3000 \ny", "12 ,;é×“", "w " * 30000]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, start int, shard string")


def test_cut_texts_give_the_ids_of_whole_texts(plain):
    random.seed(1)
    letters = list("ab'.,  \n\n\t1é×“ sS<|\u00a0\u3000-")
    texts = ODD + ["".join(random.choices(letters, k=random.randint(0, 14))) for _ in range(5000)]
    for part in (texts, texts[::7], texts[:20]):
        ids, sizes = encoder(PATH)(pa.array(part, pa.string()))
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == [plain(t) for t in part]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_codes_give_every_id(n):
    rng = np.random.default_rng(n)
    ids = (2 ** rng.uniform(0, 32, n)).astype(np.uint32)
    codes = Codes(encode_codes(ids))
    assert len(codes) == n and (codes.ids() == ids).all() and [codes[i] for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        codes[n]


def test_token_files_of_odd_rows(spark, plain):
    rows = [(7 * i % 12, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, "first")]
    got = sorted(tuple(r) for r in token_digests(docs(spark, rows), PATH, 2).na.fill({"doc_id": -1}).collect())
    want = {(-1 if i is None else i, len(plain(t)) + 1, crc(plain(t) + [2])) for i, t in rows}
    assert {(r[0], r[2], r[3]) for r in got} == want and len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(r[0] for r in got)
    assert token_digests(docs(spark, []), PATH, 2).count() == 0


def test_differencing():
    where, sums = difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sums.tolist()) == [14, 16] and np.bincount(where, [8, 7, 6, 5, 4]).tolist() == sums.tolist()
    lengths = np.random.default_rng(0).integers(1, 512, 500)
    sums = np.bincount(pack(lengths), lengths)
    assert sums.max() <= 2048 and sums.sum() / 2048 / len(sums) > 0.97


def test_packing_of_odd_rows(spark, plain):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "none")]
    got = pack_documents(docs(spark, rows), PATH, 1).collect()
    ids = {i: plain(t) + [1] for i, t in rows if i != 3}
    windows = {}
    for r in got:
        if r["doc_id"] != 3:
            own = ids[r["doc_id"]]
            assert crc(own[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] and r["doc_tokens"] == len(own)
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in got) == sum(len(plain(t)) + 1 for _, t in rows)
    assert pack_documents(docs(spark, []), PATH, 1).count() == 0
    whole = packed_sequences(docs(spark, rows), PATH, 1).collect()
    assert len(whole) == len(windows) and all(len(r["ids"]) == 2048 or len(r["ids"]).bit_count() == 1 for r in whole)


def test_pipeline_stage_by_stage(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == before.columns
        kept.append(docs.count())
    assert before.count() >= kept[0] >= kept[1] >= kept[2] > 0
    texts = {(r["doc_id"], r["text"]) for r in before.collect()}
    rows = docs.collect()
    assert {(r["doc_id"], r["text"]) for r in rows} <= texts
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sum(r["length"] for r in packed) == sum(len(plain(r["text"])) + 1 for r in rows)
