"""The nearest centre by the pyramid search against all distances."""
import random

import pytest

from riskframe.operators import nearest


def brute(points, centres):
    out = []
    for i, x, y in points:
        near = [((x - a) * (x - a) + (y - b) * (y - b), label) for label, a, b in centres if None not in (label, a, b)] if None not in (x, y) else []
        out.append((i, min(near)[1] if near else None))
    return sorted(out)


def places(rng, kind, n):
    if kind == "even":
        return [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(n)]
    if kind == "crowd":       # most in one small place, a few far away
        return [(10 + rng.gauss(0, 1e-4), 20 + rng.gauss(0, 1e-4)) if rng.random() < 0.97 else (rng.uniform(-60, 60), rng.uniform(
            -180, 180)) for _ in range(n)]
    if kind == "grid":        # many ties
        return [(float(rng.randrange(12)), float(rng.randrange(12))) for _ in range(n)]
    return [(5.0, rng.uniform(0, 1)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "crowd", "grid", "line"])
@pytest.mark.parametrize("number,few", [(1, 0), (9, 0), (9, 256), (700, 256)])
def test_equals_all_distances(spark, kind, number, few, monkeypatch):
    monkeypatch.setattr(nearest, "FEW_CENTRES", few)
    rng = random.Random(f"{kind}{number}")
    centres = [(f"c{i:04d}", *p) for i, p in enumerate(places(rng, kind, number))]
    points = [(i, *p) for i, p in enumerate(places(rng, rng.choice(["even", "grid", kind]), 150) + places(rng, kind, 80) + [(5.5, 5.5)])]
    df = spark.createDataFrame(points, "id long, lat double, lon double")
    table = spark.createDataFrame(centres, "name string, lat double, lon double").repartition(3)
    got = nearest.nearest_of_table(df, ["lat", "lon"], table, "name", "near")
    assert got.columns == ["id", "lat", "lon", "near"]
    assert sorted((r["id"], r["near"]) for r in got.collect()) == brute(points, centres)


@pytest.mark.parametrize("few", [0, 256])
def test_nulls_repeats_and_no_centres(spark, few, monkeypatch):
    monkeypatch.setattr(nearest, "FEW_CENTRES", few)
    centres = [(3, 1.0, 1.0), (2, 1.0, 1.0), (None, 0.0, 0.0), (1, None, 5.0), (9, 4.0, 4.0)]
    points = [(0, 0.0, 0.0), (1, None, 1.0), (2, 5.0, 5.0), (2, 5.0, 5.0), (3, 2.5, 2.5)]
    df = spark.createDataFrame(points, "x long, lat double, lon double")
    table = spark.createDataFrame(centres, "label int, lat double, lon double")
    got = nearest.nearest_of_table(df, ["lat", "lon"], table, "label")
    assert sorted((r["x"], r["centroid"]) for r in got.collect()) == brute(points, centres)
    none = nearest.nearest_of_table(df, ["lat", "lon"], table.limit(0), "label")
    assert [r["centroid"] for r in none.collect()] == [None] * 5
    assert nearest.nearest_of_table(df.limit(0), ["lat", "lon"], table, "label").count() == 0


def test_centres_apart_by_less_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FEW_CENTRES", 0)
    centres = [(i, 7.0 + i * 1e-13, 7.0) for i in range(40)] + [(99, 170.0, -80.0)]
    df = spark.createDataFrame([(0, 7.0, 7.0), (1, 7.0 + 39e-13, 7.1), (2, 100.0, 0.0)], "id long, lat double, lon double")
    got = nearest.nearest_of_table(df, ["lat", "lon"], spark.createDataFrame(centres, "label int, lat double, lon double"), "label")
    assert sorted((r["id"], r["centroid"]) for r in got.collect()) == brute([tuple(r) for r in df.collect()], centres)
