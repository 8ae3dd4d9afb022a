import hashlib

import pytest

from shelfprice.llm import bpe

CASES = ["", "Hello, it's  a test\n\n\n x", "é" * 300, " " * 70000 + "x", "a" * 70000,
         "\n" * 200000, ("word  " * 30000) + "\t\t end ", "don't 123abc!!  \n" * 9000]


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers as P
    return bpe.Codec.of(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def by_match(codec, text):
    return [i for m in codec.pattern.finditer(text) for i in codec.enc._encode_single_piece(m[0])]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_every_match_encoded_by_itself(codec, k):
    ids = codec.encode(CASES[k])
    assert ids == by_match(codec, CASES[k])
    assert codec.decode(ids) == CASES[k].encode()


def test_safe_boundaries_change_no_id(codec):
    text = "It's  90% of\n\n the  words, isn't\t it?  " * 50
    parts = list(bpe.segments(text, 37))
    assert len(parts) > 20 and "".join(parts) == text
    assert [i for p in parts for i in codec.enc.encode_ordinary(p)] == codec.enc.encode_ordinary(text)


def test_rows(spark):
    df = spark.createDataFrame([(1, "ab c", "x"), (None, None, None), (1, "ab c", "x"), (3, "", "y")],
                               "doc_id long, text string, n_tokens string")
    got = bpe.tokenize(df, outputs=("ids", "n_tokens", "decoded", "ids_sha256", "decoded_sha256"))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == 4 and rows[None].n_tokens == 0 and bytes(rows[1].decoded) == b"ab c"
    assert rows[3].ids_sha256 == hashlib.sha256(b"").hexdigest() == rows[None].decoded_sha256
    assert rows[1].ids_sha256 == hashlib.sha256(",".join(map(str, rows[1].ids)).encode()).hexdigest()
    back = bpe.decode(got.select("doc_id", "ids"))
    assert {bytes(r.decoded) for r in back.collect()} == {b"ab c", b""}
    assert bpe.tokenize(df.limit(0)).count() == 0
