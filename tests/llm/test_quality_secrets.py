"""Quality rules and secret scans against plain Python."""
import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from riskframe import config
from riskframe.llm import quality, secrets
from riskframe.llm.queries import QUERIES


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated.update(j for p in places for j in range(p, p + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated), failed)


def texts():
    rng = random.Random(1)
    out = [None, "", " \n\t ", "a\x0bb\x0cc\rd\x1ce\x85f\xa0g", "😀 é#|", "x\nx\n x\n\n\n"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "cc", "é"]) + rng.choice([" ", " ", "\n", "  "])
                           for _ in range(rng.randrange(80))))
    out += ["a " * 30_000, "one two three four five six seven eight " * 3 + "nine ten " * 40]
    return out


def test_counts(spark):
    rows = list(enumerate(texts())) + [(None, "a b"), (3, "again")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, words string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(df, labels)
    names = ["doc_id", *quality.COUNTS, "kept"]
    want = sorted(((i, *counts(t), not counts(t)[-1]) for i, t in rows), key=str)
    assert sorted(map(tuple, got.select(names).collect()), key=str) == want
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t in rows if not counts(t)[-1])
    assert quality.quality_rules(df.limit(0), labels).count() == 0


def test_ratio_tells_junk_from_prose(spark):
    rng = random.Random(2)
    good = ["alpha", "beta", "gamma", "delta", "the", "of"]
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        docs.append((i, " ".join(rng.choice(good) + (rng.choice(["***", "%%%"]) if bad else "")
                                 + rng.choice(["", "s", "ed"]) for _ in range(60))))
        if i % 3:
            labels.append((i, int(not bad), 0))
    labels += [(None, 1, 0), (2, 1, 0), (2, 1, 0), (1, 0, 0), (5, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r["doc_id"] for r in quality.quality_rules(
        df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).filter("kept").collect()}
    assert kept == {i for i, _ in docs if i % 4}


def test_score_is_the_plain_sum(spark):
    weights = [(7 * i) % 1001 - 500 for i in range(quality.BUCKETS)]
    df = spark.createDataFrame([("a b c a",), ("a",), ("",)], "t string")
    from riskframe.llm.text import words_of
    hashed = df.select(F.transform(words_of(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    got = [r[0] for r in hashed.select(quality.mean_ratio("h", weights)).collect()]
    code = {w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in "abc"}

    def pair(x, y):
        return spark.range(1).select(quality.pair_bucket(F.lit(code[x]), F.lit(code[y]))).first()[0]
    words = ["a", "b", "c", "a"]
    total = sum(weights[code[w] & (quality.BUCKETS - 1)] for w in words)
    total += sum(weights[pair(x, y)] for x, y in zip(words, words[1:]))
    assert got == [total // 7, weights[code["a"] & (quality.BUCKETS - 1)], None]


ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secret_texts():
    rng = random.Random(3)
    parts = ["password", "PassWD", "token", "api_key", "apikey", "secret", "=", ":", " = ", '"', "'", "AKIA", "😀", "é\n",
             "ABCDEF0123456789", "deadbeef", "0123456789abcdef01234567", "x", "hunter22", " ", "a.b-c_d+/=", "ſecret", "K"]
    out = ["", "secret: token = hunter22", "AKIAAKIA" + "Z" * 20, "f" * 23, "f" * 24, "password=abc", "z" * 60_000]
    return out + ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(500)]


def test_base_spans(spark):
    rows = list(enumerate(secret_texts())) + [(None, None), (1, "token=abcdefg"), (1, "token=abcdefg")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, base string")
    got = secrets.secret_spans(df).collect()
    want = sorted(((i, base_spans(t or "")) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], [tuple(s) for s in r["base"]]) for r in got), key=str) == want
    for r in got:
        spans, base = [tuple(s) for s in r["spans"]], [tuple(s) for s in r["base"]]
        assert spans == sorted(spans) and [s for s in spans if s[1] < 3] == base
        for start, kind, end in spans:
            assert kind < 3 or all(b[2] <= start or end <= b[0] for b in base)
    assert secrets.secret_spans(df.limit(0)).count() == 0


def test_models_find_random_tokens_only(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    words = ["connection", "handler", "response", "parameter", "configuration", "identifier"]
    docs = [(i, f"token = {h} " + " ".join(rng.choice(words) for _ in range(30))) for i, h in enumerate(hexes)]
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(32))
    docs += [(900, f"see {key} here"), (901, "connection_handler_response_parameter2"), (902, "4012888888881881401288")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.secret_spans(df).filter("doc_id >= 900").collect()}
    assert got == {900: [(4, 3, 36)], 901: [], 902: []}


def test_masks(spark):
    rows = [(1, "a token=abcdef0 b"), (2, "password: " + "0" * 30 + "."), (3, None), (4, "clean")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, spans long")
    got = secrets.mask_secrets(df)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {
        1: "a [SECRET] b", 2: "[SECRET]", 3: None, 4: "clean"}


def test_query_digests(spark, data_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_secret_scan"](spark, data_dir).collect():
        base = base_spans(docs[r["doc_id"]] or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))


def test_long_runs_and_many_matches(spark):
    """Some seconds each where the time follows the length; minutes where it is squared."""
    rng = random.Random(5)
    blob = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789+/") for _ in range(400_000))
    many = "".join(f"token={i:06d} {i:07d}abcdefghijklmno " for i in range(20_000))
    texts = ["f" * 400_000, "see " + blob, "AKIA" * 50_000, "password=" * 30_000, many, "é " + many + "secret: abcdef"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = time.monotonic()
    got = {r["doc_id"]: r for r in secrets.secret_spans(df).collect()}
    assert time.monotonic() - start < 60
    for i, text in enumerate(texts):
        assert [tuple(s) for s in got[i]["base"]] == base_spans(text)


def test_tokens_that_meet_a_span_are_told_apart(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        edges = sorted(rng.sample(range(60), 2 * rng.randrange(9)))
        spans = [(a, b) for a, b in zip(edges[::2], edges[1::2])]
        start = rng.randrange(60)
        end = start + 1 + rng.randrange(10)
        rows.append((spans, (start, end), any(a < end and start < b for a, b in spans)))
    df = spark.createDataFrame(rows, "s array<struct<start:int,end:int>>, t struct<start:int,end:int>, want boolean")
    assert df.filter(secrets.meets(F.col("s"), F.col("t")) != F.col("want")).count() == 0


def test_models_count_all_documents(spark):
    rows = [(i, f"token = {'ab' * 12}{i:04d} wordwords") for i in range(2_500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    values = [f"{'ab' * 12}{i:04d}" for i, _ in rows]
    found = spark.createDataFrame([([v],) for v in values], "values array<string>")

    def steps(strings):
        return Counter((ord(a) if a else 0, ord(b)) for s in strings for a, b in zip(["", *s], s))
    # The word pattern also takes the letters that a value begins with.
    plain = steps(["wordwords"] * 2_500 + ["ab" * 12] * 2_500)
    assert secrets.train(df, found, "text") == secrets.ratio_table(steps(values), plain)


def test_all_trusted_documents_count(spark, monkeypatch):
    """More labelled rows than any bound; the joins by broadcast and by shuffle agree."""
    n = 10_500
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    trusted = quality.trusted_ids(labels)
    held = {r["doc_id"]: r["held_out"] for r in trusted.collect()}
    assert set(held) == set(range(n)) - {3}
    docs = spark.createDataFrame([(i, "x") for i in range(n + 500)] + [(None, "x"), (0, "x")], "doc_id long, text string")
    good = sum(not held[i] for i in held) + (not held[0])
    raw, bucket = n + 502, spark.range(1).select(quality.single_bucket(F.xxhash64(F.lit("x")))).first()[0]
    ratio = math.log(1 + good) - math.log(1 + raw)
    shift = math.log(quality.BUCKETS + raw) - math.log(quality.BUCKETS + good)
    for most in (200_000, 100):
        monkeypatch.setattr(config, "MAX_BROADCAST_ROWS", most)
        weights = quality.fit_weights(quality.with_trust(docs, trusted, "doc_id", "text"))
        assert weights[bucket] == round(1_000_000 * (ratio + shift))
        assert set(weights[:bucket] + weights[bucket + 1:]) == {round(1_000_000 * shift)}


def test_all_trusted_documents_set_the_threshold(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("the of and risk site flood wall river".split()) for _ in range(rng.choice([5, 20, 30]))))
            for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, "x " * 30), (7, rows[7][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    seen, quantiles = [], quality.quantile_values

    def noted(scores, *rest):
        seen.append(sorted(r["score"] for r in scores.collect()))
        return quantiles(scores, *rest)
    monkeypatch.setattr(quality, "quantile_values", noted)
    quality.quality_rules(docs, labels)
    trusted = [(i, t) for i, t in [*rows, rows[7]] if i < 40 and len(t.split()) >= 20]
    assert len(seen[0]) == len(trusted)
    texts = quality.with_trust(docs, quality.trusted_ids(labels), "doc_id", "text")
    tables = quality.fold_weights(texts, quality.fit_weights(texts))
    scores = []
    for fold in range(quality.FOLDS):
        plain = quality.fit_weights(texts.withColumn("held_out", F.col("fold") == fold))
        assert max(abs(a - b) for a, b in zip(plain, tables[fold], strict=True)) <= 2
        own = texts.filter(F.col("fold") == fold).select(F.transform(
            F.split("__text", " "), lambda w: F.xxhash64(w)).alias("h")).filter(F.size("h") >= 20)
        scores += [r[0] for r in own.select(quality.mean_ratio("h", tables[fold])).collect()]
    assert seen[0] == sorted(scores)


def test_too_many_trusted_ids_shuffle_no_texts(spark, monkeypatch):
    """Ids of a broadcast, of bitmaps and of a shuffle give the same rows; only far or other ids shuffle texts."""
    rng = random.Random(6)
    ids = [*range(-40, 400), -2**63, 2**63 - 1, 32767, 32768, 32769, 65536, 65537, -32767, -32768, -32769, -32770]
    ids += [rng.randrange(-10**5, 10**5) for _ in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in sorted(set(ids)) if i % 3], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate([*ids, None, *(i + 1 for i in ids[:300])])],
                                 "doc_id long, text string")
    monkeypatch.setattr(quality, "MAX_BITMAPS", 20)
    small = "doc_id > -2000000000 AND doc_id < 2000000000"
    for kinds, bitmaps in [(("long", "long"), 20), (("int", "long"), 20), (("long", "int"), 20), (("long", "long"), 3), (("string", "string"), 20)]:
        given, marks = (df.filter(f"doc_id IS NULL OR {small}" if "int" in kinds else "true").withColumn("doc_id", F.col("doc_id").cast(kind))
                        for df, kind in zip((docs, labels), kinds, strict=True))
        trusted, found = quality.trusted_ids(marks), []
        for most in (10**6, 100):
            monkeypatch.setattr(config, "MAX_BROADCAST_ROWS", most)
            monkeypatch.setattr(quality, "MAX_BITMAPS", bitmaps)
            found.append(quality.with_trust(given, trusted, "doc_id", "text"))
        assert sorted(map(repr, found[0].collect())) == sorted(map(repr, found[1].collect()))
        assert found[1].filter("fold IS NOT NULL").count() > 300
        plan = found[1]._jdf.queryExecution().optimizedPlan().toString()
        assert ("bits" in plan) == (bitmaps > 3 and "string" not in kinds)


def test_one_trusted_document_sets_no_threshold(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(25))) for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in quality.quality_rules(docs, labels).collect())


def test_weights_stand_in_no_plan(spark, monkeypatch, capsys):
    """The driver writes and keeps the text of each plan, so the tables of weights are not part of it."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3_000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=40))) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    plans, cut = [], quality.cut_lineage
    monkeypatch.setattr(quality, "cut_lineage", lambda df: plans.append(df) or cut(df))
    plans += [quality.quality_rules(docs, labels), quality.keep_good(docs, labels)]
    assert sum("score" in df.columns for df in plans) == 3
    for df in plans:
        df.explain(True)
        assert len(capsys.readouterr().out) < 100_000
