"""Packing: exact ids, a gapless layout, reductions that keep an optimum."""
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from riskframe.llm import packing as K

PATH = P.path("word_bpe_49k.json")


def fewest(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[at]}:
            rooms[(i := rooms.index(room))] -= items[at]
            go(at + 1, rooms)
            rooms[i] += items[at]
        go(at + 1, [*rooms, capacity - items[at]])
    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(4))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    for _ in range(120):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randrange(capacity // 4 if seed % 2 else 1, capacity) or 1
                 for _ in range(rng.randrange(1, 10))]
        counts = {x: items.count(x) for x in items}
        fixed, rest = K.reduce_instance(counts, capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (fewest(left, capacity) if left else 0) == fewest(items, capacity)
        plan = K.plan_bins(counts, capacity)
        held = {}
        for contents, copies in plan:
            assert sum(s * n for s, n in contents) <= capacity
            for s, n in contents:
                held[s] = held.get(s, 0) + n * copies
        assert held == counts
        assert sum(n for _, n in plan) <= fewest(items, capacity) + 1


def test_plan_is_near_the_bound_and_small():
    rng = random.Random(1)
    counts = {min(4096, int(rng.lognormvariate(6, 1.2)) + 1): rng.randrange(1, 10**6) for _ in range(5000)}
    plan = K.plan_bins(counts)
    tokens = sum(s * n for s, n in counts.items())
    assert sum(n for _, n in plan) <= 1.001 * tokens / 4096 + 1
    assert len(K.plan_rows(plan)) < 20 * 4096


def texts():
    rng = random.Random(2)
    kinds = ["abcDE éß. ,", "the And ing, tion. ", "0. 1, ½\n\t\x85\xa0\x1c", "'s'LL'd. 't’X ", "中文 ابج😀İIı̇Σ. ",
             "<|endoftext|> #.,. "]
    return ["", " ", "a.", "..", "a.,", "3.", "ab, c", "<|endoftext|>", "é.", "».", "Hello <|endoftext|> world.",
            "a<|startoftext|>b", "<|ENDOFTEXT|>", "x <|EndOfText|>. y", "<|endoftext|", "|endoftext|>", "<|endoftext|>."] + [
        "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(80))) for _ in range(500)]


def test_ids_equal_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts(), add_special_tokens=False)]
    assert K.WordIds(PATH).encode(texts()) == want


def test_words_of_letters_skip_the_other_steps():
    class Counting:
        encoded = 0

        def __init__(self, tokenizer):
            self.__dict__["tokenizer"] = tokenizer

        def encode(self, words, **how):
            Counting.encoded += len(words)
            return self.tokenizer.encode(words, **how)

        def __setattr__(self, name, value):
            setattr(self.tokenizer, name, value)

    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCéÉßÿÞñ"
    marks = ["", "", ".", ",", "***", "$$$", "').", "?!", "'", "|>"]
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 15))) for _ in range(3000)]
    odd = ["İx.", "ſ,", "e\u0301.", "º.", "×.", "a×!", "÷", "\u212b.", "\u212a", "ϒΣ.", "don't.", "'s.", "a'd'.", "x\xa0y.", "7%%"]
    texts = [" ".join(stem + rng.choice(marks) for stem in rng.sample(stems, 50)) for _ in range(200)] + odd
    plain = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    words = K.WordIds(PATH)
    words.tokenizer = Counting(words.tokenizer)
    assert words.encode(texts) == want
    assert words.encode([text.encode() for text in texts]) == want
    assert Counting.encoded < 50


def test_old_half_is_not_walked():
    words = K.WordIds(PATH)
    words.old = {b"%d" % n: b"" for n in range(1_000_000)}
    began = time.process_time()
    for n in range(1000):
        words.encode([f"w{n}"])
    assert time.process_time() - began < 5


def test_small_memory(monkeypatch):
    want = K.WordIds(PATH).encode(texts())
    monkeypatch.setattr(K, "CACHE_BYTES", 3000)
    monkeypatch.setattr(K, "NEW_WORDS", 7)
    words = K.WordIds(PATH)
    assert [words.encode([text])[0] for text in texts()] == want
    assert words.held < 3000 + 30 * 400


def test_layout(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a b"), (-3, "a b"), (None, "c"),
                                  (-4, "word " * 9000)], docs.schema)
    docs = docs.unionByName(more).withColumn("length", docs["doc_id"] * 0)
    packed = K.pack_documents(docs, PATH, with_ids=True)
    rows = packed.collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096].tobytes()
            want.append((r["doc_id"], piece, at, len(part) // 4, zlib.crc32(part), part))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in bins.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= sum(r["length"] for r in rows) / 4096 + 2
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in K.sequences(packed).collect()}
    assert whole == {k: b"".join(x for _, _, x in sorted(v)) for k, v in bins.items()}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert K.pack_documents(empty, PATH).count() == 0
