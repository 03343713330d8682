"""Recursive BPE against the public library."""
import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from riskframe.llm import bpe


@pytest.fixture(scope="module")
def plain():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    kinds = ["abcdefgh éßñ ", "the and ing tion  ", "01²½ x\n\t\r ", "'s'll'd 'tX’", "中文 говорит ابج😀 a",
             "\x1c\x1f\x85\xa0 　 ab\n", "<|endoftext|> #*$\x00\x07"]
    out = ["", " ", "   a", "a   ", "<|endoftext|>", "aaaa" * 100, "\n\n \n x", "ǰ̌é Ⅷ ʰ ٣"]
    for _ in range(400):
        kind = rng.choice(kinds)
        out.append("".join(rng.choice(kind) for _ in range(rng.randrange(60))))
    return out


def test_equals_the_library(spark, plain):
    rows = list(enumerate(texts())) + [(-1, None), (None, "a b"), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = bpe.encode_and_decode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    want = sorted(((i, len(ids := plain.encode_ordinary(t or "")), " ".join(map(str, ids)), t or "")
                   for i, t in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_forgets_words_when_full(spark, plain, monkeypatch):
    encoder = bpe.Encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    monkeypatch.setattr(bpe, "WORDS_KEPT", 20)
    for text in texts()[:60]:
        ids = encoder.run([text, text]).column("ids").to_pylist()
        assert ids == [" ".join(map(str, plain.encode_ordinary(text)))] * 2


def test_empty_table_and_arrays(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = bpe.encode_and_decode(df, P.path("byte_bpe_50k.tiktoken"))
    assert out.select(bpe.id_array(out["ids"])).count() == 0
    one = spark.createDataFrame([("5 6",), ("",)], "ids string")
    assert [r[0] for r in one.select(bpe.id_array(one["ids"])).collect()] == [[5, 6], []]
