"""Tokenizer alignment against whole texts encoded at once and all pairs of tokens compared."""
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskframe.llm import align

PATH_A, PATH_B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain_libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def raw_a(token):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in shown))
    return bytes(letters[c] for c in token)


def raw_b(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes.fromhex(piece[3:5])
    return piece.replace("▁", " ").encode()


def ends(parts):
    out, at = [], 0
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def plain(texts):
    a, b = plain_libraries()
    rows, counts = [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a, parts_b = [raw_a(a.id_to_token(i)) for i in ids_a], [raw_b(b.id_to_piece(i)) for i in ids_b]
        if not text or b"".join(parts_a) != want or b"".join(parts_b) != want:
            rows.append(None)
            continue
        spans_a, spans_b = ends(parts_a), ends(parts_b)
        links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans_a) for j, (x, y) in enumerate(spans_b)
                 if s < y and x < e]
        both = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups = []
        for low, high in zip([0, *both], both):
            groups.append(",".join(str(i) for i, (s, _) in zip(ids_a, spans_a) if low <= s < high) + "|"
                          + ",".join(str(i) for i, (s, _) in zip(ids_b, spans_b) if low <= s < high))
        rows.append((len(ids_a), len(ids_b), groups, links))
        counts.update(set(links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


KINDS = ["abc DE éß. ,", "the ing tion and ", "0. 1½\n\t\x85\xa0\x1c  ", "'s'LL'd. ’", "中文 ابج😀👩‍🚀İıΣ ｆ ", "<|endoftext|> <s> <0x41> ",
         "  ​᠎　 x", "a▁ b"]
EDGES = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "<|endoftext|>", "<s>", "</s> <unk>", "😀", "a😀 😀b",
         "\x00 \x01", "é é", "▁", "x ▁y", "​ a", "a ​b", "﻿a b", "᠎ b", "中" * 50,
         "a. b, c; d: e! f?", "é. ñ, ². 3. x.. y?! z.\n", "end.", "a. ", "a.b. c", "(so)."]


def texts(seed, number):
    rng = random.Random(seed)
    return EDGES + ["".join(rng.choice(rng.choice(KINDS[:6] if rng.random() < 0.8 else KINDS)) for _ in range(rng.randrange(60)))
                    for _ in range(number)]


@pytest.mark.parametrize("hot", [0, 60, 10**6])
def test_equals_whole_texts(spark, hot):
    given = texts(1, 400) + ["the end of it"] * 30
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(given)],
                               "doc_id long, text string, n_a long, pairs string").repartition(3)
    got = align.align_tokenizers(df, PATH_A, PATH_B, hot_pairs=hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain(given)


def test_small_memory_and_small_slices(spark, monkeypatch):
    given = texts(2, 300)
    aligner = align.Aligner(PATH_A, PATH_B)
    want = aligner.align([t or "" for t in given])
    monkeypatch.setattr(align, "NEW_STRETCHES", 3)
    monkeypatch.setattr(align, "CACHE_BYTES", 1000)
    again = align.Aligner(PATH_A, PATH_B)
    got = [again.align([t or ""])[0] for t in given]
    whole = align.Aligner(PATH_A, PATH_B)
    whole.cuts = False
    for a, b, c in zip(want, got, whole.align([t or "" for t in given]), strict=True):
        assert (a is None) == (b is None) == (c is None)
        if a:
            assert a[0] == b[0] == c[0] and (a[1] == b[1]).all() and (a[1] == c[1]).all() and a[2:] == b[2:] == c[2:]


def test_runs_of_letters_and_marks_are_parts():
    aligner = align.Aligner(PATH_A, PATH_B)
    assert aligner.parts("abc.\nÉté,%%%") == ["abc", b".", "\nÉté".encode(), b",%%%"]
    for whole in ["abc", "a.b", "it's", "x².", "½", "2.", "a\n\nb", "a.\n", "\na", "$$$", "e\u0301.", "a_b", "a\r\nb", "don't.\na"]:
        assert aligner.parts(whole) == [whole]
    # What Python takes for letters, A does too.
    letters = "".join(c for c in map(chr, range(0x110000)) if c.isalpha())
    assert len(aligner.a.pre_tokenizer.pre_tokenize_str(letters)) == 1


def test_parts_are_encoded_once(monkeypatch):
    heads, tails = ["underdog", "Éclair", "жизнь", "中文"], ["", ".", "$$$", ",%%%", "!!", ".\nOver", "\nOver&&&", ")."]
    aligner, given = align.Aligner(PATH_A, PATH_B), " ".join(h + t for h in heads for t in tails)
    encoded, encode = [], aligner.b.encode
    monkeypatch.setattr(aligner.b, "encode", lambda text, **more: encoded.append(text) or encode(text, **more))
    got = aligner.align([given])[0]
    assert sum("underdog" in text for text in encoded) == sum(text.count("underdog") for text in encoded) == 1
    assert sum(text.count("\nOver") for text in encoded) == 1
    want = plain([given])[0]
    assert (got[2], got[3], got[4], len(got[1])) == want[:4]
    assert hashlib.sha256(got[0].encode()).hexdigest() == want[6]


@pytest.mark.parametrize("most", [10**9, 2_000])
def test_mixed_parts_equal_whole_texts(monkeypatch, most):
    monkeypatch.setattr(align, "CACHE_BYTES", most)
    rng = random.Random(4)
    pieces = ["word", "Été", "жизнь", "中文", "ª", "µ", "ǅ", "²", "½", "7", "e\u0301", "𐐀", "\U00032380", ".", ",", "$$$", "%%%", "'s", "'", "’", "_",
              "<|endoftext|>", "<s>", "<0x41>", "\n", "\n", "\n", "\r\n", "\t", " ", " ", " ", "\x00", "😀", "\\", "]", "-", "^"]
    given = ["".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(1_500)]
    aligner, rows = align.Aligner(PATH_A, PATH_B), plain(given)
    found = [x for at in range(0, len(given), 50) for x in aligner.align(given[at:at + 50])]
    for text, got, want in zip(given, found, rows, strict=True):
        if got is None:
            assert want[:4] == (0, 0, 0, 0), text
        else:
            digest = hashlib.sha256(got[0].encode()).hexdigest()
            assert (got[2], got[3], got[4], len(got[1]), digest) == (*want[:4], want[6]), text


def test_spans_and_bytes_refine_each_other():
    import numpy as np
    ends_ = np.array([3, 5, 5, 5, 9])
    clean = np.array([True, False, False, True, True])
    assert align.refined(ends_, clean, np.array([3, 1, 0, 1, 4])).tolist() == [3, 4, 4, 5, 9]


def test_documents(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(None, "again"), (7, "again"), (7, "again"), (-1, "lorem " * 40_000),
                                  (-2, "x" * 40_000)], docs.schema)
    docs = docs.unionByName(more)
    rows = docs.collect()
    got = align.align_tokenizers(docs, PATH_A, PATH_B).collect()
    a, b = plain_libraries()
    for r in rows:
        mine = [g for g in got if g["doc_id"] == r["doc_id"]]
        want = (len(a.encode(" " + r["text"], add_special_tokens=False).ids), len(b.encode(r["text"]))) if r["text"] else (0, 0)
        assert want in [(g["n_a"], g["n_b"]) for g in mine]
    assert len(got) == len(rows)
    assert all(g["n_links"] >= g["n_groups"] and g["count_sum"] >= g["n_links"] >= g["n_best"] for g in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.align_tokenizers(empty, PATH_A, PATH_B).count() == 0
