"""Long self-similar words, on which sums of powers modulo 2**64 collide for every base."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plumbline.llm.arrays import Words
from plumbline.llm.ngram_join import near_copies
from plumbline.llm.packing import pack_documents
from plumbline.llm.queries import VOCABULARY
from plumbline.llm.substring_dedup import remove_repeats
from plumbline.llm.token_files import token_digests

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
OTHER = ONE.translate(str.maketrans("ab", "ba"))
SHARED = [f"w{i}" for i in range(40)]


def documents(spark):
    rows = [(1, " ".join([*SHARED[:20], ONE, *SHARED[20:]])), (2, " ".join([*SHARED[:20], OTHER, *SHARED[20:]]))]
    rows += [(3, f"p {ONE} q"), (4, f"p {OTHER} q"), (5, ONE), (6, OTHER)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), dict(rows)


@pytest.mark.parametrize("lower", [False, True])
def test_hashes_differ(lower):
    words = Words(pa.array([ONE, OTHER, ONE.upper(), "x" * 65, "X" * 65]), lower=lower)
    hashes = words.word_hashes().tolist()
    assert len(set(hashes)) == (3 if lower else 5)


def test_no_word_is_removed_and_no_link_made(spark):
    table, _ = documents(spark)
    assert {r["n_removed"] for r in remove_repeats(table).collect()} == {0}
    assert all(r["component_id"] == r["doc_id"] for r in near_copies(table.where("doc_id > 2")).collect())


def test_every_text_gets_its_own_ids(spark):
    table, texts = documents(spark)
    encode = Tokenizer.from_file(str(VOCABULARY)).encode
    want = {i: [*encode(t, add_special_tokens=False).ids] for i, t in texts.items()}
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for r in token_digests(table, VOCABULARY, end_id=2).collect():
        assert (r["n_tokens"], r["ids_crc32"]) == (len(want[r["doc_id"]]) + 1, crc([*want[r["doc_id"]], 2]))
    for r in pack_documents(table, VOCABULARY, end_id=1).collect():
        piece = [*want[r["doc_id"]], 1][r["start"] : r["start"] + r["length"]]
        assert crc(piece) == r["ids_crc32"]
