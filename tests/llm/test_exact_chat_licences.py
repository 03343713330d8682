"""Exact duplicates, chat examples, licence scans, URL filters: small cases with known results."""
import hashlib
import os
import random
import re
import textwrap

import pytest

from riskframe.llm import chat, exact, licences, urls


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("capacity", [2, 10**6])
def test_exact_duplicates(spark, capacity):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAÉéİ") for _ in range(rng.randrange(4))) for _ in range(400)]
    texts += ["x" * 100_000, "X" * 100_000, "Ⅷ", "ⅷ", "ΑΣ", "ας"]
    rows = [(i, t, "key", i) for i, t in enumerate(texts)] + [(900, None, "", 1), (901, "", "", 1), (3, texts[3], "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, norm long")
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(lower(t or ""), []).append(i)
    want = sorted((i, max(g), len(g), i == max(g), digest(t)) for t, g in groups.items() for i in g)
    got = exact.exact_duplicates(df, capacity=capacity)
    assert sorted(map(tuple, got.collect())) == want


def test_directory_splits_overfull_buckets():
    buckets = exact.build_directory({0: 5, 1: 1, 6: 4, 7: 4}, 3, 4)
    assert buckets == [(0, 0, 3), (1, 1, 3), (2, 3, 2), (4, 5, 2), (6, 6, 3), (7, 7, 3)]


def test_exact_edges(spark):
    df = spark.createDataFrame([(None, "a"), (2, "A"), (None, "b")], "doc_id long, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(df).collect()}
    assert got == {(None, 2, 2, False), (2, 2, 2, True), (None, None, 1, True)}
    assert exact.exact_duplicates(df.limit(0)).count() == 0


TRICKY = ["", "\\", "</turn>", "<\\/turn>", "###", "#####", "a\\", "\\n", "### user: x</turn>\n", ":", "é😀\n"]


def test_chat_round_trip(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "sy:s\\tem", "##"])
            rows.append((conv, turn, role, "".join(rng.choice(TRICKY) for _ in range(3))))
    rows += [(90, 0, "user", None), (90, 1, None, "x"), (91, 1, "assistant", "b"), (91, 1, "assistant", "a"),
             (91, None, "user", "first"), (None, 0, "assistant", "y"), (92, 0, "assistant", "z" * 50_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    examples = chat.format_examples(df)
    want = {}
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), digest(loss))
    got = {r[0]: tuple(r)[1:5] for r in chat.read_back(examples).collect()}
    assert got == want
    masks = {}
    for r in examples.orderBy("example").collect():
        masks.setdefault(r["conv_id"], []).append(r["loss_chars"])
        assert r["formatted"].count("</turn>\n") == r["n_turns"]
        assert r["formatted"][r["loss_start"] + r["loss_chars"]:].startswith("</turn>") or not r["loss_chars"]
    assert all(len(m) == max(1, sum(r == "assistant" for _, r, _ in talks[c]) + (talks[c][-1][1] != "assistant"))
               for c, m in masks.items())
    assert chat.read_back(chat.format_examples(df.limit(0))).count() == 0


def test_licences(spark):
    mit = licences.LICENCES["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2001 Someone\n\n" + mit.upper().replace("\n", "\n\n  * ")),
            (3, mit + " more"), (4, "text\n// Released under the M.I.T licence"), (5, None), (6, ""),
            (7, "é\n -- released under the MIT Licence!\nReleased under the MIT License.\n" + "w " * 50_000),
            (7, "again"), (None, licences.LICENCES["Zlib"].replace("acknowledgment", "acknowledgement"))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, lines long")
    got = [(r["doc_id"], r["licence"], r["n_licence_lines"], r["line_licences"])
           for r in licences.licence_scan(df).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 0, ""), (4, None, 0, ""), (5, None, 0, ""),
        (6, None, 0, ""), (7, None, 2, "MIT-notice"), (7, None, 0, ""), (None, "Zlib", 0, "")], key=str)
    assert licences.licence_scan(df.limit(0)).count() == 0
    assert licences.licence_scan(df, known={}).filter("licence IS NOT NULL").count() == 0


def wrapped(text, width):
    return "\n".join(textwrap.fill(line, width) for line in text.split("\n"))


def test_wrapped_licences(spark):
    rows = [(name, wrapped(text, width)) for name, text in licences.LICENCES.items()
            for width in range(60, 81)]
    assert any(re.search("(?m)^copyright notice", text) for _, text in rows)
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert licences.licence_scan(df).filter("licence IS NULL OR licence <> doc_id").count() == 0


def test_common_texts_titles_and_notices(spark):
    folder, rows = "/usr/share/common-licenses", [
        ("CC-BY-NC-4.0-notice", "# Licensed under CC BY-NC 4.0."), ("CC-BY-SA-3.0-notice", "Licensed under CC-BY-SA-3.0"),
        ("MIT-notice", "// SPDX-License-Identifier: MIT"), ("BSD-3-Clause-notice", "Licensed under the BSD 3-Clause License."),
        ("MIT", "MIT License\n\nCopyright (c) 2020 A\n\n" + licences.LICENCES["MIT"]),
        ("ISC", "ISC License\n\n" + wrapped(licences.LICENCES["ISC"], 72))]
    for name, file in [("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"), ("GPL-2.0", "GPL-2"), ("LGPL-2.1", "LGPL-2.1"),
                       ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")]:
        if os.path.exists(f"{folder}/{file}"):
            with open(f"{folder}/{file}", encoding="utf-8") as f:
                parts = re.split(r"\n\s*\n", f.read())
            # Lines of their own stay so where a statement is among them.
            rows += [(name, "\n\n".join(
                part if re.search(r"(?im)^\W*copyright \W", part) else textwrap.fill(" ".join(part.split()), width)
                for part in parts)) for width in range(60, 81)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    bad = licences.licence_scan(df).filter("licence IS NULL OR licence <> doc_id")
    assert [r["doc_id"] for r in bad.collect()] == []


def test_copyright_statements():
    for line in ["copyright (c) 2001 someone", "(c) 2001 someone", "© someone", "# copyright 2001, 2002 x", "(c) someone",
                 "copyright: someone", "copyright acme corp", "copyright noticeable ltd", "copyright [yyyy] [name]",
                 " * copyright the kubernetes authors.", "(c) copyright ibm 2000", "copyright <year> <copyright holder>"]:
        assert re.search(licences.COPYRIGHT_LINE, line), line
    for line in ["copyright notice and this permission notice", "copyright holders be liable", "copyright owner", "copyright",
                 "copyright holder", "copyrighted by the", "(c) you must retain", "copyright license to reproduce", "a (c) 2001",
                 "copyright the software, and (2)", "copyright (or"]:
        assert not re.search(licences.COPYRIGHT_LINE, line), line


def test_urls(spark):
    rng = random.Random(4)
    parts = ["pills", "news", "casino", "blog", "shop"]
    seen = [tuple(rng.sample(parts, 3)) for _ in range(300)]
    labelled = spark.createDataFrame(
        [(f"http://{a}.example.org/{b}/{c}", {"pills", "casino"} <= {a, b, c}) for a, b, c in seen]
        + [("http://x.org", None), (None, True)], "url string, bad boolean")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
    pages = [(1, "HTTP://WWW.Example.COM/en/a?x#y"), (2, "https://a.example.com/en/"), (3, "http://notexample.com/en/"),
             (4, "http://com"), (5, "no scheme"), (6, None), (7, "http://e.net/pills/casino"), (8, "http://e.net/pills"),
             (9, "x://h?a=://b/c"), (10, "://H#/"), (9, "x://h?a=://b/c"), (None, "http://b.com/")]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, tokens string")
    got = sorted(map(tuple, urls.filter_urls(df, labelled, rules).drop("mined").collect()), key=str)
    assert got == sorted([
        (1, "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        (2, "a.example.com", "/en/", "example.com/en/", "block"), (3, "notexample.com", "/en/", "com/", "allow"),
        (4, "com", "", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
        (7, "e.net", "/pills/casino", None, "block"), (8, "e.net", "/pills", None, "allow"),
        (9, "h", "", None, "allow"), (10, "h", "", None, "allow"), (9, "h", "", None, "allow"),
        (None, "b.com", "/", "com/", "allow")], key=str)
    assert urls.filter_urls(df.limit(0), labelled, rules).count() == 0
    none = urls.filter_urls(df, labelled.limit(0), rules)
    assert none.filter("mined IS NOT NULL").count() == 0 and none.count() == len(pages)


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(5)
    baskets = [(rng.sample("abcdef", rng.randrange(1, 5)), rng.random() < 0.5) for _ in range(200)]
    df = spark.createDataFrame(baskets, "tokens array<string>, bad boolean")
    got = {tuple(r["rule"]): round(r["confidence"], 9) for r in urls.mine_rules(df, 0.02, 0.6).collect()}
    from itertools import combinations
    want = {}
    for n in range(1, 5):
        for rule in combinations("abcdef", n):
            hit = [bad for items, bad in baskets if set(rule) <= set(items)]
            if sum(hit) >= 0.02 * len(baskets) and sum(hit) >= 0.6 * len(hit):
                want[rule] = round(sum(hit) / len(hit), 9)
    assert got == want
