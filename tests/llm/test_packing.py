import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from mostrador.llm import packing
from tests.llm.helpers import ODD, corpus, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_pieces_hold_every_id_once(spark, tokenizer):
    texts = corpus()[0] + ODD + ["J̌ T̈x l'été!! A.B, c.. 12,5", corpus()[0][0]]
    docs = frame(spark, texts).repartition(5).withColumnsRenamed({"source": "ids", "lang": "part"})
    length = 256
    rows = packing.pack(docs, PATH, length).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(texts):
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[i], key=lambda r: r["start"])
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == expected
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert {r["doc_tokens"] for r in own} == {len(expected)}
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == length for s, n in filled.items() if s < len(filled) - 1)


def test_sequences_are_padded_unless_a_power_of_two(spark):
    docs = frame(spark, ["a b c", "d e f g h", None])
    whole = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, PATH, 8), 8).collect()}
    sizes = [len(whole[k]["ids"]) // 4 for k in sorted(whole)]
    assert sizes[0] == 8 and sum(r["n_tokens"] for r in whole.values()) == 4 + 6 + 1
    left = whole[1]["n_tokens"]
    assert sizes[1] == (left if left & (left - 1) == 0 else 8)


def test_empty_table_and_no_end_id(spark):
    assert packing.pack(frame(spark, []), PATH).collect() == []
    assert [r["length"] for r in packing.pack(frame(spark, ["", None, "a"]), PATH, end_id=None).collect()] == [1]


def test_crc_is_of_the_ids(spark):
    from pyspark.sql import functions as F

    row = packing.pack(frame(spark, ["one two"]), PATH).withColumn("c", F.crc32("ids")).first()
    assert row["c"] == zlib.crc32(bytes(row["ids"]))


def test_slices_of_a_batch_are_encoded_like_the_whole():
    texts = pa.array(corpus()[0], pa.string())
    coder = packing.WordEncoder(PATH)
    ids, sizes = coder.encode(texts)
    assert coder.encode(texts.slice(20, 9))[0].tolist() == ids[sizes[:20].sum() : sizes[:29].sum()].tolist()
