import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import bpe
from loadkeeper.llm.queries import QUERIES, tokenizer
from tests.llm.conftest import FOLDER, ODD

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def theirs():
    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_every_kind_of_character(theirs):
    own = bpe.Encoder(*tokenizer())
    for first in range(0, 0x30000, 7):
        if not 0xD800 <= first < 0xE000:
            c = chr(first)
            assert own.ids(f"a{c}1 {c} {c}{c}.\n") == theirs.encode_ordinary(f"a{c}1 {c} {c}{c}.\n")


def test_every_token_is_reached():
    own = bpe.Encoder(*tokenizer())
    for rank, token in enumerate(bpe.read_ranks(tokenizer()[0])):
        assert own.pieces.encode("".join(map(own.letters.__getitem__, token)), out_type=int) == [rank]


def test_odd_rows(odd, theirs):
    path, pattern = tokenizer()
    ids = odd.select("doc_id", "text", bpe.encode(F.col("text"), path, pattern).alias("ids"))
    got = ids.select("text", "ids", bpe.decode(F.col("ids"), path).alias("raw")).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["ids"] == theirs.encode_ordinary(r["text"] or "")
        assert bytes(r["raw"]).decode() == (r["text"] or "")


def test_nothing(nothing):
    path, pattern = tokenizer()
    assert nothing.select(bpe.encode(F.col("text"), path, pattern)).collect() == []


def test_what_is_remembered_is_bounded(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    own = bpe.Encoder(*tokenizer())
    for i in range(40):
        text = f"some words {i} " + "long" * (20 + i) + f" and number {i * 977}"
        assert own.ids(text) == theirs.encode_ordinary(text)
        assert len(own) < 70 and max(map(len, own)) <= bpe.LONGEST


def test_a_broken_rank_file(tmp_path):
    (tmp_path / "ranks").write_bytes(b"YQ== 0\nYQ== 1\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "ranks"))


def test_query(spark, sample, theirs):
    got = {r["doc_id"]: r for r in QUERIES["op1_byte_bpe"](spark, FOLDER).collect()}
    for doc_id, text in sample[1]:
        ids = theirs.encode_ordinary(text or "")
        r = got[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
