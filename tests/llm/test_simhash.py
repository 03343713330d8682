"""SimHash groups against fingerprints bit by bit and all pairs of them."""
import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from riskframe import config
from riskframe.llm import graph, simhash
from riskframe.session import cut_lineage


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(id, fingerprint, smallest id reachable) of (id, fingerprint), over all pairs."""
    names = list(range(len(rows)))

    def top(x):
        while names[x] != x:
            x = names[x]
        return x
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3:
                names[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted([(doc, f"{value:016x}", least.get(top(i), doc)) for i, (doc, value) in enumerate(rows)], key=str)


TEXTS = [None, "", " \t\n", "One", "one", "a b", "A  B", "a b c", "a\x85b c d", "x y " * 5000, "é É ß 中文 😀 ok",
         "the same three words the same three words the same three words", "w" * 100_000]


def test_fingerprints_bit_by_bit(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 7)
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("ab Cd éf\n".split(" ")) for _ in range(rng.randrange(40))) for _ in range(200)]
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    # The hash is that of the engine's own function.
    got = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2**64 == xxhash.xxh64(b"one two three", seed=42).intdigest()


def test_blocks_leave_out_any_three_positions():
    blocks = simhash.steiner_blocks()
    assert len(blocks) == 14
    assert all(any(not set(lost) & set(b) for b in blocks) for lost in combinations(range(8), 3))


def spread(seed, centres, copies, flips):
    """Numbers around centres, and chains of steps of three bits."""
    rng = random.Random(seed)
    out = []
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(copies):
            value = centre
            for _ in range(rng.randrange(flips + 1)):
                value ^= 1 << rng.randrange(64)
            out.append(value)
    value = rng.getrandbits(64)
    for _ in range(30):
        for bit in rng.sample(range(64), 3):
            value ^= 1 << bit
        out.append(value)
    return out


@pytest.mark.parametrize("block", [20_000, 15])
def test_groups_equal_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_CLASSES", block)
    prints = spread(2, 30, 12, 6) + spread(3, 1, 150, 12) + [0, 0, 7, 1 << 63, (1 << 64) - 1]
    rows = [(i if i % 50 else None, p) for i, p in enumerate(prints)] + [(3, prints[5]), (3, prints[3])]
    given = spark.createDataFrame([(d, p - (1 << 64) if p >> 63 else p) for d, p in rows], "id long, node long")
    monkeypatch.setattr(simhash, "fingerprinted", lambda *_: given)
    got = simhash.simhash_groups(given, "id", "id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(rows)


def test_documents(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(120)) for _ in range(25)]
    texts = TEXTS + base + [t.upper() for t in base[:9]] + [t + f" more{i}" for i, t in enumerate(base)] + [base[0]] * 200
    rows = list(enumerate(texts)) + [(None, None), (None, base[3]), (5, base[4])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node long, component_id string")
    got = simhash.simhash_groups(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups([(i, plain_fingerprint(t)) for i, t in rows])


def test_empty_table(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_few_edges_are_contracted_without_shuffles(spark, monkeypatch):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(400) if i % 57] + [(1000, 1000 + i) for i in range(50)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    least = {x: x for edge in edges if edge[0] != edge[1] for x in edge}
    for _ in range(len(least)):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(rng.sample(edges, len(edges)), "a long, b long")
    plans = []

    def noted(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(frame)
    monkeypatch.setattr(graph, "cut_lineage", noted)
    for most, shuffled in ((200_000, False), (100, True)):
        plans.clear()
        monkeypatch.setattr(config, "MAX_BROADCAST_ROWS", most)
        assert {r["node"]: r["component"] for r in graph.components(df).collect()} == least
        assert any("hashpartitioning" in plan for plan in plans[1:]) == shuffled
    assert graph.components(df.limit(0)).count() == 0
