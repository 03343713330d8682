"""SQL twins of the named queries, written from the definitions for another engine."""

from __future__ import annotations

from riskframe import config
from riskframe.sources.tables import SITES_SQL

T = config.TARGET
SITES = SITES_SQL.format(orders="orders", customer="customer", nation="nation")
NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
EVAC = (f"CASE WHEN regexp_matches(trim(nearest_evac_km), {NUMBER}) "
        "THEN try_cast(trim(nearest_evac_km) AS DOUBLE) END")
COLUMNS = [line.rsplit(" AS ", 1)[1].strip().rstrip(",") for line in SITES.split("\n")
           if " AS " in line and line.strip().endswith(",")] + [T]

ORACLES: dict[str, str] = {}


def r(expression: str, digits: int = 6) -> str:
    """Rounded, with negative zero made plain."""
    return f"(round(({expression})::DOUBLE, {digits}) + 0.0)"


def add(name: str, body: str, ctes: str = "", recursive: bool = False) -> None:
    more = f",\n{ctes}" if ctes else ""
    ORACLES[name] = (
        f"WITH {'RECURSIVE ' if recursive else ''}sites AS ({SITES}),\n"
        f"clean AS (SELECT * REPLACE ({EVAC} AS nearest_evac_km) FROM sites),\n"
        "train AS (SELECT * FROM clean WHERE split = 'train'),\n"
        f"test AS (SELECT * FROM clean WHERE split = 'test'){more}\n{body}")


def bucket(key: str, k: int, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT % {k})::INTEGER"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- sources and sinks -----------------------------------------------------

add("csv_scan", "SELECT record_id, district, soil_type, latitude, rainfall_7d_mm, "
    "nearest_evac_km, water_presence_flag FROM clean")
add("csv_scan_inferred", "SELECT record_id, soil_type, latitude, "
    "water_presence_flag::BIGINT AS water_presence_flag FROM clean")
add("csv_scan_reordered", "SELECT record_id, district, latitude FROM clean")
add("csv_scan_quoted", """SELECT record_id, 'He said "no, ' || landcover || '"' || chr(10) || 'here, '
  || coalesce(district, '-') AS reason FROM clean""")
add("csv_scan_folder", "SELECT record_id, latitude, longitude, district FROM clean")
add("csv_scan_split", """SELECT record_id, '"' || landcover || '", ' || coalesce(district, '-') AS reason,
  elevation_m FROM clean""")
add("csv_pair_dirty_test", "SELECT record_id, nearest_evac_km, split FROM clean")
add("template_scan_swapped", f"SELECT record_id, 11.0::DOUBLE AS {T} FROM test")
add("template_scan", f"SELECT record_id, 0.0::DOUBLE AS {T} FROM test")

RAIN = "least(1.0, greatest(0.0, 0.3 + 0.001 * coalesce(rainfall_7d_mm, 100.0)))"
ELEV = "least(1.0, greatest(0.0, 0.6 - 0.0004 * coalesce(elevation_m, 200.0)))"
DRAIN = "least(1.0, greatest(0.0, 0.4 + 0.2 * coalesce(drainage_index, 0.5)))"
PREDS = (f"preds AS (SELECT record_id, split, {bucket('record_id', 5)} AS fold, {T}, {T} AS y, "
         f"({RAIN})::DOUBLE AS rain, ({ELEV})::DOUBLE AS elev, ({DRAIN})::DOUBLE AS drain, district FROM clean),\n"
         "scored AS (SELECT * FROM preds WHERE split = 'train')")
MODELS = ["rain", "elev", "drain"]

add("template_fill", f"SELECT record_id, {r('rain')} AS {T} FROM preds WHERE split = 'test'", PREDS)
add("prediction_sink", f"SELECT record_id, {r('least(1.0, greatest(0.0, coalesce(rainfall_7d_mm, 100.0) / 150 - 0.1))')} AS {T} FROM test")
add("two_variant_sink", union([
    f"SELECT record_id, 'raw' AS variant, {r('rain')} AS {T} FROM preds WHERE split = 'test'",
    f"SELECT record_id, 'calibrated' AS variant, {r('least(1.0, greatest(0.0, 0.5 + (rain - 0.5) * 3.0))')} AS {T} FROM preds WHERE split = 'test'"]), PREDS)

# --- projections, filters, schema ------------------------------------------

add("coerce_numeric", "SELECT record_id, nearest_evac_km FROM clean")
RAW = "SELECT {} FROM sites"
for profile, gone in config.DROP_PROFILES.items():
    kept = [c for c in COLUMNS if c not in gone]
    add(f"drop_profile_{profile}", RAW.format(", ".join(
        f"{r(c, 9)} AS {c}" if c.endswith("_log1p") else c for c in kept)))
add("feature_selection", RAW.format(", ".join(["record_id"] + [
    c for c in COLUMNS if c not in [*config.DROP_PROFILES["clean"], "split", "ndvi"]])))
TEXTS = {"split", "district", "place_name", "generation_date", "soil_type", "landcover",
         "urban_rural", "electricity", "road_quality"}
add("column_kinds", union([
    f"SELECT '{c}' AS \"column\", '{'categorical' if c in TEXTS else 'numeric'}' AS kind, "
    f"count({c})::BIGINT AS \"values\" FROM clean" for c in COLUMNS]))
add("missing_flags", "SELECT record_id, " + ", ".join(
    f"({c} IS NULL)::INTEGER AS {c}_missing" for c in config.MISSING_FLAG_COLUMNS) + " FROM clean")
FILLS = [("rainfall_7d_mm", 0), ("monthly_rainfall_mm", 1), ("nearest_evac_km", 10),
         ("infrastructure_score", 50), ("elevation_m", 100), ("distance_to_river_m", 9999),
         ("ndvi", -999)]
add("fill_constants", "SELECT record_id, " + ", ".join(
    f"coalesce({c}, {v}.0)::DOUBLE AS {c}" for c, v in FILLS) + " FROM clean")


def median_filled(source: str, names: list[str]) -> str:
    return ", ".join(r(f"coalesce({c}, (SELECT median({c}) FROM {source}))", 9) + f" AS {c}"
                     for c in names)


add("fill_median_train", "SELECT record_id, " + median_filled(
    "train", ["drainage_index", "latitude", "longitude", "elevation_m"]) + " FROM clean")
add("fill_median_combined", "SELECT record_id, " + median_filled(
    "clean", ["latitude", "longitude"]) + " FROM clean")
add("fill_median_fold", union([
    f"SELECT f.f::INTEGER AS model_fold, '{c}' AS \"column\", {r(f'median({c})', 9)} AS median "
    f"FROM range(5) f(f) JOIN train ON {bucket('record_id', 5)} <> f.f GROUP BY f.f"
    for c in ["drainage_index", "elevation_m", "ndvi", "rainfall_7d_mm"]]))
add("drop_missing_rows", "SELECT record_id, latitude, longitude, rainfall_7d_mm FROM clean "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND rainfall_7d_mm IS NOT NULL")
add("threshold_flags", f"""SELECT record_id, ({T} > 0.5)::INTEGER AS high_risk,
  (coalesce(elevation_m, 100) < 10)::INTEGER AS low_elevation_flag,
  (coalesce(distance_to_river_m, 9999) < 500)::INTEGER AS close_river_flag FROM clean""")
add("type_casts", f"""SELECT CAST(record_id AS VARCHAR) AS record_id, district,
  water_presence_flag::DOUBLE AS water_presence_flag, {T} FROM clean""")

# --- joins -----------------------------------------------------------------

DISTRICT = f"m AS (SELECT district, avg({T}) AS v FROM train WHERE district IS NOT NULL GROUP BY 1)"
add("lookup_default", f"""SELECT record_id, {r(f'coalesce(m.v, (SELECT avg({T}) FROM train))')} AS district_mean
FROM clean LEFT JOIN m USING (district)""", DISTRICT)
add("lookup_spread", f"""SELECT record_id, district, {r('m.v')} AS district_mean
FROM clean LEFT JOIN m USING (district)""", DISTRICT)
add("scalar_broadcast", f"""SELECT record_id, {r('(coalesce(drainage_index, med) - lo) / (hi - lo + 1e-9)')} AS drainage_scaled
FROM clean, (SELECT min(drainage_index) lo, max(drainage_index) hi, median(drainage_index) med FROM train)""")
add("align_models", "SELECT record_id, " + ", ".join(f"{r(m)} AS {m}" for m in MODELS) + " FROM preds", PREDS)
add("nearest_neighbour", """SELECT a.record_id, arg_min(b.record_id, ((a.latitude - b.latitude) * (a.latitude - b.latitude)
  + (a.longitude - b.longitude) * (a.longitude - b.longitude), b.record_id)) AS neighbour
FROM train a LEFT JOIN test b ON a.latitude + a.longitude + b.latitude + b.longitude IS NOT NULL GROUP BY 1""")
add("nearest_centroid", """SELECT record_id, arg_min(c.district, ((latitude - lat) * (latitude - lat)
  + (longitude - lon) * (longitude - lon), c.district)) AS centroid
FROM clean, c WHERE latitude IS NOT NULL GROUP BY record_id
UNION ALL SELECT record_id, NULL FROM clean WHERE latitude IS NULL""",
    """c AS (SELECT district, round(avg(latitude), 4) AS lat, round(avg(longitude), 4) AS lon FROM clean
  WHERE district IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1)""")

# --- aggregations ----------------------------------------------------------

add("group_mean", f"SELECT district, {r('v')} AS mean FROM m", DISTRICT)
STATS = config.GROUP_STAT_COLUMNS
GROUP_STATS = ("gs AS (SELECT district, " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in STATS)
    + " FROM train WHERE district IS NOT NULL GROUP BY 1),\nal AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_am, stddev_samp({c}) AS {c}_as" for c in STATS) + " FROM train),\n"
    "st AS (SELECT clean.*, " + ", ".join(
    f"coalesce({c}_m, {c}_am) AS district_{c}_mean, coalesce({c}_s, {c}_as) AS district_{c}_std"
    for c in STATS) + " FROM clean LEFT JOIN gs USING (district) CROSS JOIN al)")
add("group_stats_lookup", "SELECT record_id, " + ", ".join(
    f"{r(f'district_{c}_{k}')} AS district_{c}_{k}" for c in STATS for k in ("mean", "std"))
    + " FROM st", GROUP_STATS)
add("group_risk_rank", f"""SELECT district, {r(f'avg({T})')} AS mean, {r(f'stddev_samp({T})')} AS std,
  count({T})::BIGINT AS count FROM train WHERE district IS NOT NULL GROUP BY 1""")
add("group_median_order", f"SELECT district, {r(f'median({T})')} AS median FROM train "
    "WHERE district IS NOT NULL GROUP BY 1")
D = "drainage_index"
add("scalar_stats", f"""SELECT {r(f'avg({D})')} AS mean, {r(f'stddev_samp({D})')} AS std,
  {r(f'min({D})')} AS min, {r(f'max({D})')} AS max, {r(f'median({D})')} AS median FROM train""")
COUNTS = "SELECT district, count(*)::BIGINT AS count FROM train WHERE district IS NOT NULL GROUP BY 1"
add("value_counts", COUNTS)
add("group_size_range", f"""SELECT min(count)::BIGINT AS min_count, max(count)::BIGINT AS max_count,
  {r('avg(count)')} AS mean_count FROM ({COUNTS})""")
add("missing_report", "SELECT * FROM (" + union([
    f"SELECT '{c}' AS \"column\", {r(f'avg(({c} IS NULL)::INTEGER) * 100')} AS percent FROM train"
    for c in COLUMNS]) + ") WHERE percent > 0")
add("table_shape", f"SELECT count(*)::BIGINT AS rows, {len(COLUMNS)}::INTEGER AS columns FROM train")


def summary(c: str, source: str, digits: int) -> str:
    parts = {"count": f"count({c})::BIGINT", "mean": r(f"avg({c})", digits),
             "std": r(f"stddev_samp({c})", digits), "min": r(f"min({c})", digits),
             "p25": r(f"quantile_cont({c}, 0.25)", digits), "p50": r(f"median({c})", digits),
             "p75": r(f"quantile_cont({c}, 0.75)", digits), "max": r(f"max({c})", digits)}
    return f"SELECT '{c}' AS \"column\", " + ", ".join(
        f"{v} AS {k}" for k, v in parts.items()) + f" FROM {source}"


add("describe_target", union([summary(c, "train", 6) for c in (T, "elevation_m", "ndwi")]))
ORACLES["describe_lineitem"] = union([
    summary(c, "lineitem", 4) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")])
NUMERIC = [c for c in COLUMNS if c not in TEXTS and c not in (T, "record_id")]
CORR = union([f"SELECT '{c}' AS \"column\", corr({c}, {T}) AS corr FROM train" for c in NUMERIC])
add("corr_with_target", f"SELECT \"column\", {r('corr')} AS corr FROM ({CORR})")
add("top_k_corr", f"""SELECT * FROM (SELECT "column", {r('corr')} AS corr, 'top' AS side FROM c ORDER BY c.corr DESC, "column" LIMIT 10)
UNION ALL SELECT * FROM (SELECT "column", {r('corr')} AS corr, 'bottom' AS side FROM c ORDER BY c.corr, "column" LIMIT 10)""",
    f"c AS ({CORR})")


def binned(column: str, source: str, digits: int) -> str:
    return f"""SELECT bin, count(*)::BIGINT AS count, {r('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 50)', digits)} AS bin_low
FROM (SELECT least(49, floor(({column} - lo) / (hi - lo) * 50))::INTEGER AS bin, lo, hi
  FROM {source}, (SELECT min({column}) lo, max({column}) hi FROM {source}) WHERE {column} IS NOT NULL) GROUP BY bin"""


add("histogram", binned(T, "train", 6))
ORACLES["histogram_lineitem"] = binned("l_extendedprice", "lineitem", 4)
add("kde_curve", f"""SELECT g.i::INTEGER AS point, {r('any_value(a + g.i * step)')} AS x,
  {r(f'sum(exp(-0.5 * pow((a + g.i * step - {T}) / w, 2))) / (any_value(n * w) * sqrt(2 * pi()))')} AS density
FROM range(1000) g(i), k, train WHERE {T} IS NOT NULL GROUP BY g.i""",
    f"""k AS (SELECT lo - 0.5 * (hi - lo) AS a, 2 * (hi - lo) / 999 AS step, n, sd * pow(n, -0.2) AS w
  FROM (SELECT min({T}) lo, max({T}) hi, count({T}) n, stddev_samp({T}) sd FROM train))""")


def boxes(by: str) -> tuple[str, str]:
    inside = f"{T} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return (f"""SELECT {by}, {r('q1')} AS q1, {r('med')} AS median, {r('q3')} AS q3,
  {r(f'min({T}) FILTER ({inside})')} AS whisker_low, {r(f'max({T}) FILTER ({inside})')} AS whisker_high,
  count(*) FILTER (NOT ({inside}))::BIGINT AS outliers
FROM train JOIN q USING ({by}) WHERE {T} IS NOT NULL GROUP BY {by}, q1, med, q3""",
            f"""q AS (SELECT {by}, quantile_cont({T}, 0.25) q1, median({T}) med, quantile_cont({T}, 0.75) q3
  FROM train WHERE {by} IS NOT NULL GROUP BY 1)""")


add("box_stats", *boxes("district"))
add("box_stats_road_quality", *boxes("road_quality"))
add("distinct_values", "SELECT DISTINCT soil_type FROM train")
ORACLES["group_stats_lineitem"] = f"""SELECT l_partkey, {r('avg(l_discount)', 9)} AS mean,
  {r('stddev_samp(l_discount)', 9)} AS std, count(l_discount)::BIGINT AS count
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1"""

# --- model scores ----------------------------------------------------------


def scores(m: str) -> str:
    mse = f"avg(pow(y - {m}, 2))"
    r2 = f"(1 - {mse} / var_pop(y))"
    return (f"avg(abs(y - {m})) AS mae, sqrt({mse}) AS rmse, {r2} AS r2, "
            f"(avg(abs(y - {m})) + sqrt({mse})) / 2 * (1 + greatest(0, 1 - {r2})) AS custom")


FOUR = ("mae", "rmse", "r2", "custom")
ROUNDED_FOUR = ", ".join(f"{r(c)} AS {c}" for c in FOUR)
BY_FOLD = PREDS + ",\nbf AS (" + union([
    f"SELECT fold, '{m}' AS model, {scores(m)} FROM scored GROUP BY GROUPING SETS ((fold), ())"
    for m in MODELS]) + ")"
add("regression_metrics", f"SELECT model, {ROUNDED_FOUR} FROM bf WHERE fold IS NULL", BY_FOLD)
add("metrics_by_fold", f"SELECT fold, model, {ROUNDED_FOUR} FROM bf", BY_FOLD)
add("mean_fold_score", "SELECT model, " + ", ".join(f"{r(f'avg({c})')} AS {c}" for c in FOUR)
    + " FROM bf WHERE fold IS NOT NULL GROUP BY model", BY_FOLD)
add("custom_metric_by_district", f"SELECT district, {r('custom')} AS custom FROM "
    f"(SELECT district, {scores('rain')} FROM scored GROUP BY district)", PREDS)
CELLS = PREDS + """,
cm AS (SELECT count(*) FILTER (NOT y > 0.5 AND NOT rain > 0.5)::BIGINT AS tn, count(*) FILTER (NOT y > 0.5 AND rain > 0.5)::BIGINT AS fp,
  count(*) FILTER (y > 0.5 AND NOT rain > 0.5)::BIGINT AS fn, count(*) FILTER (y > 0.5 AND rain > 0.5)::BIGINT AS tp FROM scored)"""
add("confusion", "SELECT * FROM cm", CELLS)
add("class_report", f"""SELECT class, {r('p')} AS precision, {r('q')} AS recall,
  {r('coalesce(2 * p * q / nullif(p + q, 0), 0)')} AS f1, support, {r('acc')} AS accuracy FROM (
  SELECT 0 AS class, coalesce(tn / nullif(tn + fn, 0), 0) p, coalesce(tn / nullif(tn + fp, 0), 0) q, tn + fp AS support, (tp + tn) / (tn + fp + fn + tp) acc FROM cm
  UNION ALL SELECT 1, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), tp + fn, (tp + tn) / (tn + fp + fn + tp) FROM cm)""", CELLS)
add("spread_report", f"""SELECT {r('stddev_pop(rain)')} AS pred_std, {r('stddev_samp(y)')} AS target_std,
  {r('stddev_samp(y) / stddev_pop(rain)')} AS ratio FROM scored""", PREDS)
add("run_log", f"""SELECT 'param' AS kind, 'n_folds' AS key, 5.0::DOUBLE AS value
UNION ALL SELECT 'param', 'models', NULL
UNION ALL SELECT 'metric', coalesce('fold' || fold, 'oof') || '_' || s, {r('v')} FROM (
  {union([f"SELECT fold, '{s}' AS s, round({s}, 6) AS v FROM bf WHERE model = 'rain'" for s in FOUR])})""", BY_FOLD)

# --- group transforms and features -----------------------------------------

USED = ["historical_flood_count", "rainfall_7d_mm", "infrastructure_score"]
add("group_transform", "SELECT record_id, " + ", ".join(
    f"CASE WHEN district IS NOT NULL THEN {r(f'{f}({c}) OVER (PARTITION BY district)')} END AS district_{c}_{k}"
    for c in USED for k, f in (("mean", "avg"), ("std", "stddev_samp"))) + " FROM clean")
REL = [f"{c} - district_{c}_mean AS rel_{c}" for c in config.RELATIVE_COLUMNS] + [
    "(rainfall_7d_mm - district_rainfall_7d_mm_mean) / (district_rainfall_7d_mm_std + 0.01) AS rainfall_district_zscore"]
REL_NAMES = [x.rsplit(" AS ", 1)[1] for x in REL]
add("relative_zscore", "SELECT record_id, " + ", ".join(f"{r(c)} AS {c}" for c in REL_NAMES)
    + f" FROM (SELECT record_id, {', '.join(REL)} FROM st)", GROUP_STATS)


def ranked(names: list[str], source: str = "clean") -> str:
    return union([f"SELECT '{c}' AS \"column\", category, (row_number() OVER (ORDER BY category) - 1)::INTEGER AS code "
                  f"FROM (SELECT DISTINCT coalesce({c}, 'nan') AS category FROM {source})" for c in names])


add("label_rank", ranked(["district", "soil_type"]))
add("label_rank_by_range", ranked(["place_name", "district"]))
z = {c: f"coalesce({c}, 0)" for c in COLUMNS}
INTER = {
    "rain_x_flood_count": f"{z['rainfall_7d_mm']} * {z['historical_flood_count']}",
    "elevation_x_river": f"{z['elevation_m']} * (1 / nullif(coalesce(distance_to_river_m, 1000) + 1, 0))",
    "rain_ratio": f"{z['rainfall_7d_mm']} / nullif(coalesce(monthly_rainfall_mm, 1) + 1, 0)",
    "risk_density": f"{z['historical_flood_count']} * {z['population_density_per_km2']}",
    "infra_x_evac": "coalesce(infrastructure_score, 50) / nullif(coalesce(nearest_evac_km, 10) + 1, 0)",
    "ndwi_x_rain": f"{z['ndwi']} * {z['rainfall_7d_mm']}",
    "low_elevation_flag": "(coalesce(elevation_m, 100) < 10)::INTEGER",
    "close_river_flag": "(coalesce(distance_to_river_m, 9999) < 500)::INTEGER"}
add("interactions", "SELECT record_id, " + ", ".join(f"{v} AS {k}" for k, v in INTER.items())
    + " FROM clean")
SAT = f"{z['monthly_rainfall_mm']} * (1 - (coalesce(drainage_index, med) - lo) / (hi - lo + 1e-9))"
DRAINAGE = "dr AS (SELECT min(drainage_index) lo, max(drainage_index) hi, median(drainage_index) med FROM train)"
COMPOUND = {
    "catchment_saturation_proxy": SAT,
    "compound_flood_risk": f"{z['rainfall_7d_mm']} * ({SAT}) / (greatest({z['elevation_m']}, 0) + 1)",
    "historical_risk_amplifier": f"({z['historical_flood_count']} + 1) * ({SAT})",
    "evacuation_risk": "coalesce(nearest_evac_km, 10) / nullif(coalesce(infrastructure_score, 50) + 0.1, 0)",
    "triple_risk": f"{z['rainfall_7d_mm']} * {z['historical_flood_count']} * (coalesce(elevation_m, 100) < 10)::INTEGER"}
add("compound_risk", "SELECT record_id, " + ", ".join(f"{r(v)} AS {k}" for k, v in COMPOUND.items())
    + " FROM clean, dr", DRAINAGE)
add("clip_unit", f"""SELECT record_id, CASE WHEN rainfall_7d_mm IS NOT NULL THEN
  {r('least(1.0, greatest(0.0, rainfall_7d_mm / 100 - 0.5))', 9)} END AS clipped FROM clean""")
add("haversine_distance", f"""SELECT record_id, {r('''6371.0 * 2 * asin(least(1.0, sqrt(pow(sin(radians(6.9271 - latitude) / 2), 2)
  + cos(radians(latitude)) * cos(radians(6.9271)) * pow(sin(radians(79.8612 - longitude) / 2), 2))))''')} AS km FROM clean""")
FLAGS = {"low_elevation_flag", "close_river_flag"}
add("location_features", "SELECT record_id, split, " + r("nearest_evac_km") + " AS nearest_evac_km, " + ", ".join(
    [f"({c} IS NULL)::INTEGER AS {c}_missing" for c in config.MISSING_FLAG_COLUMNS]
    + [f"{v if k in FLAGS else r(v)} AS {k}" for k, v in INTER.items()]
    + [f"{r(f'district_{c}_{k}')} AS district_{c}_{k}" for c in STATS for k in ("mean", "std")]
    + [f"{r(x.rsplit(' AS ', 1)[0])} AS {x.rsplit(' AS ', 1)[1]}" for x in REL]
    + [f"{r(v)} AS {k}" for k, v in COMPOUND.items()]) + " FROM st, dr", GROUP_STATS + ",\n" + DRAINAGE)

# --- sample, sets ----------------------------------------------------------

DIGEST = "md5(CAST(record_id AS VARCHAR) || ':42')"
add("sample_n", f"""SELECT record_id, {r('longitude', 9)} AS longitude, {r('latitude', 9)} AS latitude, {r(T, 9)} AS {T}
FROM train WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY {DIGEST}, record_id LIMIT 5000""")
add("scatter_pairs", union([
    f"SELECT * FROM (SELECT '{c}' AS pair, record_id, {r(c, 9)} AS x, {r(T, 9)} AS y FROM train "
    f"WHERE {c} IS NOT NULL AND {T} IS NOT NULL ORDER BY {DIGEST}, record_id LIMIT 3000)"
    for c in config.SCATTER_COLUMNS]))
add("union_splits", f"""SELECT record_id, 'train' AS split, district, {r('latitude', 9)} AS latitude, {r(T, 9)} AS {T} FROM train
UNION ALL SELECT record_id, 'test', district, {r('latitude', 9)}, NULL FROM test""")
add("split_back", union([f"SELECT '{s}' AS side, count(*)::BIGINT AS rows, "
                         f"count({T})::BIGINT AS targets FROM {s}" for s in ("train", "test")]))
add("vocabulary_union", union([
    f"SELECT DISTINCT '{c}' AS \"column\", coalesce({c}, 'nan') AS category FROM clean"
    for c in ("district", "road_quality")]))
add("vocabulary_sentinel", "SELECT DISTINCT 'soil_type' AS \"column\", coalesce(soil_type, 'nan') AS category FROM train "
    "UNION ALL SELECT 'soil_type', '__UNSEEN__'")

# --- encoders --------------------------------------------------------------

CATS = ["district", "soil_type", "landcover", "urban_rural", "electricity", "road_quality"]


def union_code(c: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM clean) "
            f"WHERE v < coalesce(clean.{c}, 'nan'))")


def coded(names: list[str]) -> tuple[str, str]:
    """(CTEs, joins) giving `{c}_code` over all categories."""
    ctes = ",\n".join(f"v_{c} AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS {c}_code FROM "
                      f"(SELECT DISTINCT coalesce({c}, 'nan') AS v FROM clean))" for c in names)
    joined = " ".join(f"JOIN v_{c} ON v_{c}.v = coalesce(t.{c}, 'nan')" for c in names)
    return ctes, joined


CODE_CTES, CODE_JOINS = coded(CATS)
add("label_encode_union", "SELECT record_id, " + ", ".join(f"{c}_code" for c in CATS)
    + f" FROM clean t {CODE_JOINS}", CODE_CTES)
add("category_codes", "SELECT record_id, " + ", ".join(
    f"coalesce((SELECT n FROM v_{c} WHERE v_{c}.v = t.{c}), -1)::INTEGER AS {c}_code" for c in CATS)
    + " FROM clean t", ",\n".join(
    f"v_{c} AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS n FROM "
    f"(SELECT DISTINCT {c} AS v FROM clean WHERE {c} IS NOT NULL))" for c in CATS))

# Greedy group folds: groups by size, each to the fold with least rows, one step per group.
LOADS = [f"l{i}" for i in range(5)]
def greedy(source: str, key: str) -> str:
    """Group folds as the plain rule, one group after the other."""
    return f"""sizes AS (SELECT g, n, row_number() OVER (ORDER BY n DESC, g) AS k FROM
  (SELECT coalesce({key}, 'nan') AS g, count(*) AS n FROM {source} GROUP BY 1)),
steps AS (SELECT 0::BIGINT AS k, '' AS g, -1 AS fold, {', '.join(f'0::BIGINT AS {c}' for c in LOADS)}
  UNION ALL SELECT z.k, z.g, z.f, {', '.join(f'z.{c} + CASE WHEN z.f = {i} THEN z.n ELSE 0 END' for i, c in enumerate(LOADS))}
  FROM (SELECT sizes.k, sizes.g, sizes.n, {', '.join(LOADS)}, CASE {' '.join(
      f"WHEN {c} = least({', '.join(LOADS)}) THEN {i}" for i, c in enumerate(LOADS))} END AS f
    FROM steps JOIN sizes ON sizes.k = steps.k + 1) z),
gf AS (SELECT g, fold::INTEGER AS fold FROM steps WHERE k > 0)"""


GREEDY = greedy("train", "district") + """,
fr AS (SELECT t.*, gf.fold FROM clean t LEFT JOIN gf ON t.split = 'train' AND gf.g = coalesce(t.district, 'nan')),
mf AS (SELECT i::INTEGER AS model_fold FROM range(5) x(i))"""
add("group_kfold_parts", """SELECT l_orderkey, l_linenumber, l_partkey, fold FROM lineitem
JOIN gf ON g = CAST(l_partkey AS VARCHAR)""", greedy("lineitem", "CAST(l_partkey AS VARCHAR)"), True)
# Rows of fold 0 and of the test split against the districts of the other folds.
KNOWN = GREEDY + """,
k AS (SELECT DISTINCT district FROM fr WHERE fold <> 0 AND district IS NOT NULL),
o AS (SELECT * FROM fr WHERE fold IS NULL OR fold = 0)"""
add("vocabulary_semi_join", "SELECT record_id, district FROM o WHERE district IN (SELECT district FROM k)",
    KNOWN, True)
add("vocabulary_anti_join", "SELECT record_id, district FROM o WHERE district IS NULL OR "
    "district NOT IN (SELECT district FROM k)", KNOWN, True)
add("conditional_replace", """SELECT record_id, CASE WHEN district IN (SELECT district FROM k)
  THEN district ELSE '__UNSEEN__' END AS district FROM o""", KNOWN, True)
add("group_kfold", "SELECT record_id, district, fold FROM fr WHERE split = 'train'", GREEDY, True)


def seen(c: str, text: str, extra: str = "") -> str:
    """Codes per fold model over the categories outside the fold."""
    return (f"o_{c} AS (SELECT model_fold, v, (row_number() OVER (PARTITION BY model_fold ORDER BY v) - 1)::INTEGER AS n FROM ("
            f"SELECT DISTINCT model_fold, {text} AS v FROM fr JOIN mf ON fr.fold <> mf.model_fold WHERE {text} IS NOT NULL {extra}))")


SENTINEL = " UNION SELECT model_fold, '__UNSEEN__' FROM mf"
TWO = ["district", "soil_type"]
add("label_encode_unseen", "SELECT record_id, split, fold, mf.model_fold, " + ", ".join(
    f"coalesce(a_{c}.n, u_{c}.n) AS {c}_code" for c in TWO) + " FROM fr CROSS JOIN mf " + " ".join(
    f"LEFT JOIN o_{c} a_{c} ON a_{c}.model_fold = mf.model_fold AND a_{c}.v = coalesce(fr.{c}, 'nan') "
    f"JOIN o_{c} u_{c} ON u_{c}.model_fold = mf.model_fold AND u_{c}.v = '__UNSEEN__'" for c in TWO),
    GREEDY + ",\n" + ",\n".join(seen(c, f"coalesce({c}, 'nan')", SENTINEL) for c in TWO), True)
add("label_encode_first", """SELECT record_id, split, fold, mf.model_fold, coalesce(a.n, 0)::INTEGER AS district_code
FROM fr CROSS JOIN mf LEFT JOIN o_district a ON a.model_fold = mf.model_fold AND a.v = coalesce(fr.district, 'nan')""",
    GREEDY + ",\n" + seen("district", "coalesce(district, 'nan')"), True)
add("native_categories", "SELECT record_id, split, fold, mf.model_fold, " + ", ".join(
    f"a_{c}.n AS {c}_code" for c in TWO) + " FROM fr CROSS JOIN mf " + " ".join(
    f"LEFT JOIN o_{c} a_{c} ON a_{c}.model_fold = mf.model_fold AND a_{c}.v = fr.{c}" for c in TWO),
    GREEDY + ",\n" + ",\n".join(seen(c, c) for c in TWO), True)
ENCODED = config.TARGET_ENCODED
add("target_encode_global", "SELECT record_id, " + ", ".join(
    r(f"coalesce((SELECT v FROM t_{c} WHERE t_{c}.k = t.{c}), (SELECT avg({T}) FROM train))") + f" AS {c}_te"
    for c in ENCODED) + " FROM clean t", ",\n".join(
    f"t_{c} AS (SELECT {c} AS k, avg({T}) AS v FROM train WHERE {c} IS NOT NULL GROUP BY 1)" for c in ENCODED))
add("target_encode_per_fold", "SELECT record_id, split, fold, mf.model_fold, " + ", ".join(
    r(f"coalesce(e_{c}.v, d.v)") + f" AS {c}_te" for c in ENCODED)
    + " FROM fr CROSS JOIN mf JOIN d ON d.model_fold = mf.model_fold " + " ".join(
    f"LEFT JOIN e_{c} ON e_{c}.model_fold = mf.model_fold AND e_{c}.k = fr.{c}" for c in ENCODED),
    GREEDY + f",\nd AS (SELECT model_fold, avg({T}) AS v FROM fr JOIN mf ON fr.fold <> mf.model_fold GROUP BY 1),\n"
    + ",\n".join(f"e_{c} AS (SELECT model_fold, {c} AS k, avg({T}) AS v FROM fr JOIN mf ON fr.fold <> mf.model_fold "
                 f"WHERE {c} IS NOT NULL GROUP BY 1, 2)" for c in ENCODED), True)
SCALED = ["elevation_m", "rainfall_7d_mm", "ndwi"]
add("standardise", "SELECT record_id, " + ", ".join(
    r(f"({c} - (SELECT avg({c}) FROM f WHERE split = 'train')) / (SELECT stddev_pop({c}) FROM f WHERE split = 'train')")
    + f" AS {c}_std" for c in SCALED) + " FROM f",
    "f AS (SELECT record_id, split, " + ", ".join(
        f"coalesce({c}, (SELECT median({c}) FROM train)) AS {c}" for c in SCALED) + " FROM clean)")
CORE = [c for c in COLUMNS if c not in [*config.DROP_PROFILES["core"], "split"]]
CORE_OUT = ", ".join(f"{c}_code" if c in CATS else (
    c if c == "water_presence_flag" else f"{r('t.' + c)} AS {c}") for c in CORE)
add("prepare_minimal", f"SELECT record_id, split, coalesce(t.district, 'nan') AS fold_group, {CORE_OUT} FROM clean t {CODE_JOINS}", CODE_CTES)
add("build_features", f"SELECT record_id, split, {CORE_OUT}, " + ", ".join(
    f"{v if k in FLAGS else r(v)} AS {k}" for k, v in INTER.items()) + ", " + ", ".join(
    r(f"coalesce(t_{c}.tv, (SELECT avg({T}) FROM train))") + f" AS {c}_te" for c in ENCODED)
    + f" FROM clean t {CODE_JOINS} " + " ".join(f"LEFT JOIN t_{c} ON t_{c}.k = t.{c}" for c in ENCODED),
    CODE_CTES + ",\n" + ",\n".join(
    f"t_{c} AS (SELECT {c} AS k, avg({T}) AS tv FROM train WHERE {c} IS NOT NULL GROUP BY 1)" for c in ENCODED))

# --- geography -------------------------------------------------------------


def density(km: float, m: int) -> str:
    """Pairs within the radius through a plain grid, then core and noise."""
    deg = f"degrees({km} / 6371.0)"
    near = f"""2 * asin(least(1.0, sqrt(pow(sin((radians(b.la) - radians(a.la)) / 2), 2)
      + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin((radians(b.lo) - radians(a.lo)) / 2), 2)))) <= {km} / 6371.0"""
    return f"""xy AS (SELECT record_id, split, coalesce(latitude, (SELECT median(latitude) FROM clean)) AS la,
  coalesce(longitude, (SELECT median(longitude) FROM clean)) AS lo FROM clean),
p AS (SELECT la, lo, count(*) AS w FROM xy GROUP BY 1, 2),
g AS (SELECT *, floor(la / ({deg}))::BIGINT AS cy, floor(lo / (1.1 * {deg}))::BIGINT AS cx FROM p),
pr AS (SELECT a.la, a.lo, b.la AS la2, b.lo AS lo2, b.w AS w2 FROM
  (SELECT g.*, cy + dy AS ny, cx + dx AS nx FROM g, range(-1, 2) y(dy), range(-1, 2) x(dx)) a
  JOIN g b ON b.cy = a.ny AND b.cx = a.nx WHERE {near}),
core AS (SELECT la, lo FROM pr GROUP BY 1, 2 HAVING sum(w2) >= {m}),
reach AS (SELECT DISTINCT pr.la, pr.lo FROM pr JOIN core ON core.la = pr.la2 AND core.lo = pr.lo2),
flags AS (SELECT xy.*, (core.la IS NOT NULL)::INTEGER AS is_core, (reach.la IS NULL)::INTEGER AS noise FROM xy
  LEFT JOIN core ON core.la = xy.la AND core.lo = xy.lo LEFT JOIN reach ON reach.la = xy.la AND reach.lo = xy.lo)"""


add("radius_core_points", "SELECT record_id, is_core FROM flags", density(3.0, 20))
add("isolation_flag", "SELECT record_id, split, noise AS is_isolated_location FROM flags", density(3.0, 20))
add("isolation_flag_far", "SELECT record_id, split, noise AS is_isolated_location FROM flags", density(10.0, 10))
add("isolation_counts", "SELECT split, sum(noise)::BIGINT AS isolated FROM flags GROUP BY 1", density(3.0, 20))

# --- folds -----------------------------------------------------------------

add("kfold_hash", f"SELECT record_id, {bucket('record_id', 5)} AS fold FROM train")
add("kfold_tuning", f"SELECT record_id, {bucket('record_id', 3)} AS fold FROM train")
add("fold_views", union([
    f"SELECT f.f::INTEGER AS fold, '{side}' AS side, count(*)::BIGINT AS rows, {r(f'sum({T})')} AS target_sum "
    f"FROM range(5) f(f) JOIN train ON {bucket('record_id', 5)} {op} f.f GROUP BY f.f"
    for side, op in (("train", "<>"), ("valid", "="))]))

# --- blending and calibration ----------------------------------------------

add("simple_blend", f"SELECT record_id, split, {r('(rain + elev + drain) / 3')} AS blend FROM preds", PREDS)
PAIRS = [(a, b) for i, a in enumerate(MODELS) for b in MODELS[i:]]
add("gram_matrix", union([
    f"SELECT '{a}' AS row_model, '{b}' AS col_model, {r(f'avg(({a} - y) * ({b} - y))', 8)} AS value FROM scored"
    for a, b in PAIRS]), PREDS)
# E is symmetric 3×3; weights are proportional to the row sums of its cofactors.
GRAM = PREDS + ",\ne AS (SELECT " + ", ".join(
    f"avg(({a} - y) * ({b} - y)) AS e{i}" for i, (a, b) in enumerate(PAIRS)) + """ FROM scored),
co AS (SELECT *, e3*e5 - e4*e4 AS c11, e2*e4 - e1*e5 AS c12, e1*e4 - e2*e3 AS c13,
  e0*e5 - e2*e2 AS c22, e1*e2 - e0*e4 AS c23, e0*e3 - e1*e1 AS c33 FROM e),
w AS (SELECT *, c11 + c12 + c13 AS s1, c12 + c22 + c23 AS s2, c13 + c23 + c33 AS s3,
  e0*c11 + e1*c12 + e2*c13 AS det FROM co),
wt AS (SELECT *, s1 / (s1 + s2 + s3) AS w1, s2 / (s1 + s2 + s3) AS w2, s3 / (s1 + s2 + s3) AS w3,
  sqrt(det / (s1 + s2 + s3)) AS best FROM w),
pairs AS (SELECT *, sqrt((e3*e5 - e4*e4) / (e3 + e5 - 2*e4)) AS no1, sqrt((e0*e5 - e2*e2) / (e0 + e5 - 2*e2)) AS no2,
  sqrt((e0*e3 - e1*e1) / (e0 + e3 - 2*e1)) AS no3 FROM wt)"""
DIAGONAL = {"rain": "e0", "elev": "e3", "drain": "e5"}
add("optimal_blend", union([
    f"SELECT '{m}' AS model, {r(f'w{i + 1}', 5)} AS weight, {r(f'sqrt({d})', 5)} AS model_rmse, {r('best', 5)} AS blend_rmse FROM wt"
    for i, (m, d) in enumerate(DIAGONAL.items())]), GRAM)
add("optimal_blend_pair", f"""SELECT 'rain' AS model, {r('(e3 - e1) / (e0 + e3 - 2*e1)', 5)} AS weight, {r('sqrt(e0)', 5)} AS model_rmse, {r('no3', 5)} AS blend_rmse FROM pairs
UNION ALL SELECT 'elev', {r('(e0 - e1) / (e0 + e3 - 2*e1)', 5)}, {r('sqrt(e3)', 5)}, {r('no3', 5)} FROM pairs""", GRAM)
add("apply_blend", f"SELECT record_id, split, {r('least(1.0, greatest(0.0, w1 * rain + w2 * elev + w3 * drain))', 5)} AS blend FROM preds, wt", GRAM)
for kind, value in (("mae", "avg(abs(y - p))"), ("custom", """(avg(abs(y - p)) + sqrt(avg(pow(y - p, 2)))) / 2
  * (1 + greatest(0, avg(pow(y - p, 2)) / var_pop(y)))""")):
    add(f"blend_{kind}", f"""SELECT model, {r("CASE WHEN model = 'rain' THEN w ELSE 1 - w END", 5)} AS weight, {r('s', 5)} AS score
FROM (SELECT w, {value} AS s FROM (SELECT i.i, 0.5 + i.i * 0.001 AS w, y, (0.5 + i.i * 0.001) * rain
  + (1 - (0.5 + i.i * 0.001)) * elev AS p FROM scored, range(-2000, 2001) i(i)) GROUP BY i, w ORDER BY s, i LIMIT 1),
  (VALUES ('rain'), ('elev')) m(model)""", PREDS)
add("blend_ablation", union([
    f"SELECT '{m}' AS left_out, {r('best')} AS full_rmse, {r(f'no{i + 1}')} AS rmse_without, {r(f'no{i + 1} - best')} AS contribution FROM pairs"
    for i, m in enumerate(MODELS)]), GRAM)
add("leaderboard", f"SELECT model, {r('v')} AS rmse, {r('0.2 - v')} AS improvement FROM (" + union(
    [f"SELECT '{m}' AS model, sqrt({d}) AS v FROM wt" for m, d in DIAGONAL.items()]
    + ["SELECT 'simple_blend', sqrt(e0 + e3 + e5 + 2*e1 + 2*e2 + 2*e4) / 3 FROM wt",
       "SELECT 'optimal_blend', best FROM wt"]) + ")", GRAM)
CENTRE = PREDS + ",\nce AS (SELECT avg(rain) AS m FROM scored)"
STRETCH = "least(1.0, greatest(0.0, m + (rain - m) * {}))"
add("calibrate", f"SELECT record_id, split, {r(STRETCH.format('2.5'))} AS calibrated FROM preds, ce", CENTRE)


def grid(name: str, source: str) -> str:
    """Custom score for every factor of `source`."""
    return f"{name} AS (SELECT factor, {scores('p')} FROM (SELECT factor, y, {STRETCH.format('factor')} AS p FROM scored, ce, {source}) GROUP BY factor)"


FACTORS = ", ".join(f"({f}::DOUBLE)" for f in config.CALIBRATION_FACTORS)
add("calibration_grid", f"""SELECT factor, {r('sqrt(avg(pow(y - p, 2)))')} AS rmse, {r('avg(abs(y - p))')} AS mae,
  {r('1 - avg(pow(y - p, 2)) / var_pop(y)')} AS r2,
  {r('(avg(abs(y - p)) + sqrt(avg(pow(y - p, 2)))) / 2 * (1 + greatest(0, avg(pow(y - p, 2)) / var_pop(y)))')} AS custom,
  {r('stddev_pop(p)')} AS pred_std
FROM (SELECT factor, y, {STRETCH.format('factor')} AS p FROM scored, ce, (VALUES {FACTORS}) v(factor)) GROUP BY factor""", CENTRE)
add("stretch_mae", f"""SELECT {r('factor', 5)} AS factor, {r('s', 5)} AS mae FROM (SELECT factor, avg(abs(y - {STRETCH.format('factor')})) AS s
  FROM scored, ce, (SELECT 0.5 + i.i * 0.001::DOUBLE AS factor FROM range(7501) i(i)) GROUP BY factor ORDER BY s, factor LIMIT 1)""", CENTRE)
add("best_calibration", f"SELECT {r('factor', 5)} AS factor, {r('custom', 5)} AS custom FROM g ORDER BY g.custom, g.factor LIMIT 1",
    CENTRE + ",\nf AS (SELECT 0.5 + i.i * 0.001::DOUBLE AS factor FROM range(7501) i(i)),\n" + grid("g", "f"))
