"""Line dedup against plain edit distances."""
import random

import pytest

from riskframe.llm import lines as L


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, rng.choice("abc"))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice("abc")
    return "".join(out)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_banded_distance(threshold):
    rng = random.Random(threshold)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        b = edited(rng, a, rng.randrange(6))
        assert L.within(a, b, threshold) == (edits(a, b) <= threshold), (a, b)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_close_lines_share_a_key(threshold):
    rng, places = random.Random(7), L.Places(threshold)

    def keys(line):
        data = line.encode("utf-32-le")
        return {(seed, data[a:b]) for seed, a, b in places[len(line)]}
    for _ in range(4000):
        a = "".join(rng.choice("abcdé") for _ in range(rng.randrange(8, 40)))
        b = edited(rng, a, rng.randrange(threshold + 1))
        if edits(a, b) <= threshold:
            assert keys(a) & keys(b), (a, b)


def brute(docs, threshold, min_near):
    """Texts left of (id, text) rows, every pair of distinct lines compared."""
    found = {}
    for i, text in sorted(docs):
        for place, line in enumerate((text or "").split("\n")):
            line = line.strip(L.BLANK)
            if len(line) >= L.MIN_CHARS:
                found.setdefault(line, []).append((i, place))
    names = {x: x for x in found}

    def top(x):
        while names[x] != x:
            x = names[x]
        return x
    texts = sorted(found)
    for n, a in enumerate(texts):
        for b in texts[:n]:
            if min(len(a), len(b)) >= min_near and abs(len(a) - len(b)) <= threshold \
                    and edits(a, b) <= threshold:
                names[top(a)] = top(b)
    first = {}
    for x in texts:
        first[top(x)] = min(first.get(top(x), (9e9,)), min(found[x]))
    keep = {}
    for i, text in docs:
        if text is None:
            keep[i] = None
            continue
        keep[i] = "\n".join(
            line for place, line in enumerate(text.split("\n"))
            if len(line.strip(L.BLANK)) < L.MIN_CHARS
            or first[top(line.strip(L.BLANK))] == (i, place))
    return keep


def test_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(18, 70))).strip()
            for _ in range(25)]
    docs = []
    for i in range(60):
        some = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 4])) for _ in range(rng.randrange(6))]
        docs.append((i, "\n".join(some)))
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, " " + docs[5][1] + " ")]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in docs], "doc_id long, text string, id string, version long")
    got = L.dedup_lines(df, min_near=30)
    assert got.columns[:3] == ["doc_id", "id", "version"]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute(docs, L.THRESHOLD, 30)


def test_hot_line_in_many_variants(spark):
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh") for _ in range(90))
    docs = [(i, edited(rng, line, i % 4)) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(df).collect()}
    assert got == brute(docs, L.THRESHOLD, L.MIN_NEAR_CHARS)


def test_repeated_rows_nulls_and_empty_tables(spark):
    line = "a line that is long enough to be looked at"
    rows = [(1, line), (1, line), (None, line + "\n" + line), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"], r["__n_dropped"]) for r in L.dedup_lines(df).collect()), key=str)
    assert got == sorted([(1, "", 1), (1, "", 1), (None, line, 1), (2, None, 0)], key=str)
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_short_repeats_go_and_variants_are_found_from_20_characters(spark):
    rows = [(1, "Was erlytion that. Anea.\nshort\n\nx"), (2, "Was erlytion that. Ansh.\nshort\n\nz"), (3, "shart\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(df).collect()}
    assert got == {1: rows[0][1], 2: "\nz", 3: "shart"}
    kept = {r["doc_id"]: r["text"] for r in L.dedup_lines(df, min_near=60, min_chars=20).collect()}
    assert kept == dict(rows)
