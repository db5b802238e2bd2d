import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from infield.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def reference(text):
    return REFERENCE.encode_ordinary(text)


def test_pieces_equal_the_library_on_random_text():
    encoder, rng = bpe.TreeEncoder(RANKS), random.Random(5)
    import regex

    pieces = regex.compile(public_tokenizers.PATTERN)
    for size in [1, 2, 9, 40, 200] * 60:
        text = "".join(rng.choice("abcdefth   éüñ漢字ъ🙂\n\t!*129aaa") for _ in range(size))
        assert [i for p in pieces.findall(text) for i in encoder.piece(p)] == reference(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "é" * 777, "thththerth" * 300, "0" * 999, "́" * 500])
def test_long_pieces_equal_the_library(text):
    encoder = bpe.TreeEncoder(RANKS)
    assert [i for i in encoder.piece(text)] == reference(text)


def test_joining_halves_at_any_place_gives_the_same():
    encoder, rng = bpe.TreeEncoder(RANKS), random.Random(6)
    for _ in range(300):
        data = "".join(rng.choice("tioneshrd") for _ in range(rng.randint(2, 40))).encode()
        cut = rng.randint(0, len(data))
        assert encoder.join(encoder.merge(data[:cut]), encoder.merge(data[cut:])) == encoder.merge(data)


def test_round_trip_in_spark(spark):
    long = "wort " * 250_000
    texts = [None, "", "a", "  \n", "<|endoftext|> x", "héllo wörld 漢字", long, "a", "[INST]"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    for r in rows:
        assert r.ids == reference(texts[r.doc_id] or "")
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
    digest = {r.doc_id: r for r in bpe.digests(bpe.encode(df, PATH, public_tokenizers.PATTERN).select("doc_id", "ids"), PATH).collect()}
    for i, t in enumerate(texts):
        ids = reference(t or "")
        assert digest[i].n_tokens == len(ids)
        assert digest[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digest[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).count() == 0
