"""BPE against the tokenizers library, and the tree join on adversarial pieces."""

import hashlib
import random

import pytest

from cdc_lake.llm import common as C
from cdc_lake.llm.bpe import Codec, encode, encode_digest, halves

from .conftest import ODD, SF_SMALL

PATH = C.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return Codec(f.read())


def test_every_code_point_like_the_library(codec):
    chars = [chr(c) for c in range(0x11_0000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 4096):
        text = "".join(f"x{c}1{c} {c}." for c in chars[at:at + 4096])
        assert codec.encode(text) == codec.tok.encode(text, add_special_tokens=False).ids


def test_tree_join_equals_whole_encoding(codec):
    rnd = random.Random(5)
    for _ in range(1500):
        letters = rnd.choice(["ab", "a", "thein", "abcdefghij", "aéñ漢", "=-", "0123", " \n"])
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300)))
        limit = rnd.choice([2, 3, 7, 20])
        ids = []
        for p in codec.pretokens(text):
            ids += codec.tree([codec.merge(x) for x in halves(p, limit)])
        assert ids == codec.tok.encode(text, add_special_tokens=False).ids


def _want(codec, text):
    ids = codec.tok.encode(text or "", add_special_tokens=False).ids
    back = codec.tok.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


LONG = [(1, None), (2, ""), (3, "x" * 50_000), (4, "<|endoftext|>" * 3000 + "a" * 9000 + " <|endoftext|>"),
        (None, "hello 漢字" * 9000), (5, " " * 40_000 + "y"), (5, "don't " * 9000), (6, "ab12--" * 7000 + " z" + "  \n" * 9000)]


def test_digest_equals_library(spark, codec, odd, empty):
    rows = LONG + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_digest(df, PATH).collect())
    assert got == sorted((str(i), *_want(codec, t)) for i, t in rows)
    assert encode_digest(empty, PATH).count() == 0 and encode_digest(odd, PATH).count() == len(ODD)


def test_small_pieces_equal_whole_texts(spark, codec):
    docs = C.table(spark, SF_SMALL, "documents")
    got = {r.doc_id: r for r in encode(docs, PATH, piece_chars=200, run_chars=4).collect()}
    for r in docs.collect():
        assert got[r.doc_id].ids == codec.tok.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].decoded == (r.text or "")
