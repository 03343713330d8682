"""One named query per operator, each over the whole `sites` view or a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config
from riskframe.functions import cleaning, features, geo
from riskframe.functions.scores import custom_metric, mae
from riskframe.learners.base import FeatureSet
from riskframe.learners.boosting import BoostedTrees, HuberBoost, StagedTrees
from riskframe.learners.forest import feature_importance
from riskframe.learners.histogram import HistogramBoost
from riskframe.learners.network import Network
from riskframe.operators import (
    columns, encode, ensemble, evaluation, folds, groups, joins, minimise, nearest, profile, rows, spatial)
from riskframe.operators.quantiles import exact_quantiles
from riskframe.plans import features as feature_plans
from riskframe.plans import training
from riskframe.session import scratch_path
from riskframe.sources import delimited, runs
from riskframe.sources.tables import sites, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
MODELS = ["rain", "elev", "drain"]
ID, SPLIT, TARGET = config.ID, config.SPLIT, config.TARGET
TRAIN, TEST = config.TRAIN, config.TEST


def query(build):
    """Register under the function's name; `build` takes (spark, folder)."""
    QUERIES[build.__name__] = build
    return build


def on_sites(build):
    """Register a query whose only input is the `sites` view."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(sites(spark, folder))
    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to fixed digits, halves away from zero: sums depend on the order of rows.

    Plain double arithmetic; `F.round` goes through decimals and would cost more than the
    queries themselves.
    """
    scale = 10.0 ** digits

    def near(c):
        size = F.floor(F.abs(F.col(c)) * scale + 0.5) / scale
        return (F.signum(c) * size + 0.0).alias(c)

    return df.select(*[near(c) if isinstance(df.schema[c].dataType, T.DoubleType)
                       else F.col(c) for c in df.columns])


def coerced(df: DataFrame) -> DataFrame:
    return cleaning.coerce_numeric(df)


def plain_logs(df: DataFrame) -> DataFrame:
    """Logarithms differ in the last digit between maths libraries."""
    return df.withColumn("rainfall_7d_mm_log1p", F.round("rainfall_7d_mm_log1p", 9))


def stand_in_predictions(df: DataFrame) -> DataFrame:
    """Three clipped linear forms that stand in for model outputs, with shuffled folds."""
    forms = {"rain": 0.3 + 0.001 * features.filled("rainfall_7d_mm", 100),
             "elev": 0.6 - 0.0004 * features.filled("elevation_m", 200),
             "drain": 0.4 + 0.2 * features.filled("drainage_index", 0.5)}
    return folds.kfold(df, 5).select(ID, SPLIT, "fold", TARGET, *[
        features.clip_unit(v).alias(m) for m, v in forms.items()])


def scored_train(df: DataFrame) -> DataFrame:
    return rows.train_rows(stand_in_predictions(df))


# --- sources and sinks -----------------------------------------------------

CSV_COLUMNS = [ID, "district", "soil_type", "latitude", "rainfall_7d_mm", "nearest_evac_km",
               "water_presence_flag"]


@query
def csv_scan(spark, folder):
    data = sites(spark, folder).select(*CSV_COLUMNS)
    path = scratch_path(spark, "sites-csv")
    data.withColumn("district", F.coalesce("district", F.lit("NA"))).write.csv(path, header=True)
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in data.schema])
    return coerced(delimited.read_csv(spark, path, kinds))


@query
def csv_scan_inferred(spark, folder):
    """Types found from the text instead of declared."""
    path = scratch_path(spark, "sites-csv")
    sites(spark, folder).select(ID, "soil_type", "latitude", "water_presence_flag").write.csv(
        path, header=True)
    return delimited.read_csv(spark, path, delimited.infer_schema(spark, path))


@query
def csv_scan_reordered(spark, folder):
    """Columns in another order than declared, and one that is not."""
    path = scratch_path(spark, "sites-csv")
    data = sites(spark, folder)
    data.select("latitude", "landcover", "district", ID).write.csv(path, header=True)
    kinds = T.StructType([T.StructField(c, data.schema[c].dataType) for c in (ID, "district", "latitude")])
    return delimited.read_csv(spark, path, kinds)


@query
def csv_scan_quoted(spark, folder):
    """Fields with quotes, commas and line breaks."""
    path = scratch_path(spark, "sites-csv")
    said = F.concat(F.lit('He said "no, '), "landcover", F.lit('"\nhere, '), F.coalesce("district", F.lit("-")))
    sites(spark, folder).select(ID, said.alias("reason")).write.csv(path, header=True, escape='"')
    return delimited.read_csv(spark, path, T.StructType([
        T.StructField(ID, T.LongType()), T.StructField("reason", T.StringType())]))


@query
def csv_scan_folder(spark, folder):
    """A folder whose files have their columns in two orders, one of them with a column more."""
    path = scratch_path(spark, "sites-csv")
    data = sites(spark, folder)
    kinds = T.StructType([T.StructField(c, data.schema[c].dataType) for c in (ID, "latitude", "longitude", "district")])
    parts = (["latitude", "longitude", "district", ID], [ID, "longitude", "soil_type", "district", "latitude"])
    for side, names in enumerate(parts):
        data.filter(F.col(ID) % 2 == side).select(*names).write.mode("append").csv(path, header=True)
    return delimited.read_csv(spark, path, kinds)


@query
def csv_scan_split(spark, folder):
    """Quoted fields without line breaks, in files that are read in splits; types are found too."""
    path = scratch_path(spark, "sites-csv")
    said = F.concat(F.lit('"'), "landcover", F.lit('", '), F.coalesce("district", F.lit("-")))
    sites(spark, folder).select(said.alias("reason"), ID, "elevation_m").write.csv(path, header=True, escape='"')
    return delimited.read_csv(spark, path, delimited.infer_schema(spark, path)).select(ID, "reason", "elevation_m")


@query
def csv_pair_dirty_test(spark, folder):
    """A column of numbers in the train file that has stray texts in the test file."""
    paths = {}
    for side, part in ((TRAIN, rows.train_rows), (TEST, rows.test_rows)):
        paths[side] = scratch_path(spark, "sites-csv")
        data = part(sites(spark, folder)).select(ID, "nearest_evac_km")
        if side == TRAIN:
            data = data.select(ID, cleaning.to_number(F.col("nearest_evac_km")).alias("nearest_evac_km"))
        data.write.csv(paths[side], header=True)
    return cleaning.coerce_numeric(delimited.load_pair(spark, paths[TRAIN], paths[TEST]))


@query
def template_scan_swapped(spark, folder):
    path = scratch_path(spark, "template")
    rows.test_rows(sites(spark, folder)).select(F.lit(11.0).alias(TARGET), ID).write.csv(path, header=True)
    return delimited.read_template(spark, path)


def _template(spark, folder):
    path = scratch_path(spark, "template")
    rows.test_rows(sites(spark, folder)).select(ID, F.lit(0.0).alias(TARGET)).write.csv(
        path, header=True)
    return delimited.read_template(spark, path)


@query
def template_scan(spark, folder):
    return _template(spark, folder)


@query
def template_fill(spark, folder):
    scored = rows.test_rows(stand_in_predictions(sites(spark, folder))).select(
        ID, F.col("rain").alias(TARGET))
    return rounded(delimited.fill_template(_template(spark, folder), scored))


@query
def prediction_sink(spark, folder):
    path = scratch_path(spark, "predictions")
    raw = rows.test_rows(sites(spark, folder)).select(
        ID, (features.filled("rainfall_7d_mm", 100) / 150 - 0.1).alias(TARGET))
    delimited.write_predictions(raw, path)
    return rounded(delimited.read_template(spark, path))


@query
def two_variant_sink(spark, folder):
    path = scratch_path(spark, "variants")
    scored = rows.test_rows(stand_in_predictions(sites(spark, folder))).withColumn(
        "calibrated", F.lit(0.5) + (F.col("rain") - 0.5) * 3.0)
    delimited.write_variants(scored, {"raw": "rain", "calibrated": "calibrated"}, path)
    back = spark.read.schema(f"{ID} long, {TARGET} double, variant string").csv(path, header=True)
    return rounded(back.select(ID, "variant", TARGET))


@query
def run_log(spark, folder):
    found = evaluation.metrics_by_fold(scored_train(sites(spark, folder)), ["rain"])
    log = runs.RunLog(spark, scratch_path(spark, "runs"), "stand_in")
    log.params({"n_folds": 5, "models": "rain"})
    for r in found.collect():
        where = "oof" if r["fold"] is None else f"fold{r['fold']}"
        log.metrics({f"{where}_{s}": round(r[s], 6) for s in ("custom", "rmse", "mae", "r2")})
    log.flush()
    return runs.read_runs(spark, log.path).select("kind", "key", F.round(
        F.col("value").try_cast("double"), 6).alias("value"))


# --- projections, filters, schema ------------------------------------------

@on_sites
def coerce_numeric(df):
    return coerced(df).select(ID, "nearest_evac_km")


@on_sites
def drop_profile_baseline(df):
    return columns.drop_profile(plain_logs(df), "baseline")


@on_sites
def drop_profile_core(df):
    return columns.drop_profile(plain_logs(df), "core")


@on_sites
def drop_profile_clean(df):
    return columns.drop_profile(df, "clean")


@on_sites
def feature_selection(df):
    chosen = columns.feature_columns(
        rows.train_rows(df), rows.test_rows(df).drop(TARGET, "ndvi"), "clean")
    return df.select(ID, *chosen)


@on_sites
def column_kinds(df):
    """Kind of each column and how many values it has."""
    numeric, _ = columns.split_kinds(coerced(df))
    counts = coerced(df).agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit("numeric" if c in numeric else "categorical").alias("kind"),
        F.col(c).alias("values")) for c in df.columns])))


@on_sites
def missing_flags(df):
    flagged = cleaning.add_missing_flags(coerced(df))
    return flagged.select(ID, *[c for c in flagged.columns if c.endswith("_missing")])


FILLS = {"rainfall_7d_mm": 0.0, "monthly_rainfall_mm": 1.0, "nearest_evac_km": 10.0,
         "infrastructure_score": 50.0, "elevation_m": 100.0, "distance_to_river_m": 9999.0,
         "ndvi": -999.0}


@on_sites
def fill_constants(df):
    return cleaning.fill_constants(coerced(df), FILLS).select(ID, *FILLS)


@on_sites
def fill_median_train(df):
    """Missing values to the train median."""
    used = ["drainage_index", "latitude", "longitude", "elevation_m"]
    return rounded(encode.fill_medians(df, used, rows.train_rows(df)).select(ID, *used), 9)


@on_sites
def fill_median_combined(df):
    used = ["latitude", "longitude"]
    return rounded(encode.fill_medians(df, used).select(ID, *used), 9)


@on_sites
def fill_median_fold(df):
    """Medians of every fold's training rows."""
    used = ["drainage_index", "elevation_m", "ndvi", "rainfall_7d_mm"]
    train = folds.kfold(rows.train_rows(df))
    others = F.filter(F.array(*[F.lit(f) for f in range(5)]), lambda f: f != F.col("fold"))
    seen = train.select(*used, F.explode(others).alias("model_fold"))
    found = exact_quantiles(seen, used, [0.5], ["model_fold"])
    return rounded(found.select("model_fold", "column", F.get("quantiles", F.lit(0)).alias(
        "median")), 9)


@on_sites
def drop_missing_rows(df):
    return rows.drop_missing(df, ["latitude", "longitude", "rainfall_7d_mm"]).select(
        ID, "latitude", "longitude", "rainfall_7d_mm")


@on_sites
def threshold_flags(df):
    return df.select(
        ID, cleaning.above(F.col(TARGET), 0.5).alias("high_risk"),
        cleaning.below(F.col("elevation_m"), 10.0, 100.0).alias("low_elevation_flag"),
        cleaning.below(F.col("distance_to_river_m"), 500.0, 9999.0).alias("close_river_flag"))


@on_sites
def conditional_replace(df):
    """Districts of fold 0 and of the test split the other folds never had become the sentinel."""
    train, other = _fold_vocabulary(df)
    known = train.select(F.col("district").alias("k"), F.col("district").alias("known")).distinct()
    joined = joins.lookup_join(
        other.withColumn("k", F.col("district")), known.filter(F.col("k").isNotNull()), "k")
    return joined.select(ID, cleaning.replace_unseen(
        F.col("district"), F.col("known")).alias("district"))


@on_sites
def type_casts(df):
    return cleaning.add_casts(df, doubles=[TARGET, "water_presence_flag"],
                              texts=["district", ID]).select(
        ID, "district", "water_presence_flag", TARGET)


# --- joins -----------------------------------------------------------------

@on_sites
def lookup_default(df):
    means = groups.group_mean(rows.train_rows(df), "district", TARGET)
    overall = rows.train_rows(df).agg(F.avg(TARGET)).first()[0]
    return rounded(joins.lookup_with_default(
        df, means, "district", "mean", overall, "district_mean").select(ID, "district_mean"))


@on_sites
def lookup_spread(df):
    """The same lookup by shuffle with hot keys taken out, as for a large lookup table."""
    means = groups.group_mean(rows.train_rows(df), "district", TARGET, "district_mean")
    return rounded(joins.spread_join(df.select(ID, "district"), means, ["district"], 1 / 32))


@on_sites
def scalar_broadcast(df):
    train = groups.range_and_median(rows.train_rows(df), "drainage_index")
    drainage = F.coalesce(F.col("drainage_index"), F.lit(train["median"]))
    return rounded(df.select(ID, ((drainage - F.lit(train["min"])) / (
        F.lit(train["max"] - train["min"]) + F.lit(1e-9))).alias("drainage_scaled")))


@on_sites
def align_models(df):
    """Long predictions of three models side by side per id."""
    wide = stand_in_predictions(df)
    long = wide.select(ID, F.inline(F.array(*[F.struct(
        F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in MODELS])))
    return rounded(joins.align_models(long, MODELS))


def _fold_vocabulary(df):
    """(train rows outside fold 0, all other rows); folds hold whole districts."""
    df = grouped(df)
    inside = F.coalesce(F.col("fold") != 0, F.lit(False))
    return df.filter(inside), df.filter(~inside)


@on_sites
def vocabulary_semi_join(df):
    """Rows of fold 0 and of the test split whose district the other folds have."""
    known, other = _fold_vocabulary(df)
    return joins.keep_known(other.select(ID, "district"), known.select("district"), "district")


@on_sites
def vocabulary_anti_join(df):
    known, other = _fold_vocabulary(df)
    return joins.keep_unknown(other.select(ID, "district"), known.select("district"), "district")


@on_sites
def radius_core_points(df):
    """Whether at least 20 locations, the row's own included, lie within 3 km."""
    return spatial.add_density_flags(df, 3.0, 20, core="is_core").select(ID, "is_core")


@on_sites
def nearest_centroid(df):
    centres = df.na.drop(subset=["district", *config.COORDINATES]).groupBy("district").agg(
        F.round(F.avg("latitude"), 4).alias("lat"), F.round(F.avg("longitude"), 4).alias("lon"))
    named = centres.select("district", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    return nearest.nearest_of_table(df, list(config.COORDINATES), named, "district").select(ID, "centroid")


@on_sites
def nearest_neighbour(df):
    """Of each train location the closest test location: as many centres as test rows."""
    centres = rows.test_rows(df).select(F.col(ID).alias("neighbour"), *config.COORDINATES)
    return nearest.nearest_of_table(rows.train_rows(df), list(config.COORDINATES), centres, "neighbour",
                                    "neighbour").select(ID, "neighbour")


# --- aggregations ----------------------------------------------------------

@on_sites
def group_mean(df):
    return rounded(groups.group_mean(rows.train_rows(df), "district", TARGET))


@on_sites
def group_stats_lookup(df):
    made = groups.add_group_stats(df)
    return rounded(made.select(ID, *[c for c in made.columns if c.startswith("district_")]))


@on_sites
def group_risk_rank(df):
    return rounded(groups.group_risk_rank(rows.train_rows(df), "district", TARGET))


@on_sites
def group_median_order(df):
    return rounded(profile.median_order(rows.train_rows(df), "district", TARGET))


@on_sites
def scalar_stats(df):
    return rounded(groups.scalar_stats(rows.train_rows(df), "drainage_index"))


@on_sites
def value_counts(df):
    return groups.value_counts(rows.train_rows(df), "district")


@on_sites
def group_size_range(df):
    return rounded(groups.count_range(groups.value_counts(rows.train_rows(df), "district")))


@on_sites
def missing_report(df):
    return rounded(profile.missing_report(rows.train_rows(coerced(df))))


@on_sites
def table_shape(df):
    return profile.table_shape(rows.train_rows(df))


@on_sites
def describe_target(df):
    return rounded(profile.describe(rows.train_rows(df), [TARGET, "elevation_m", "ndwi"]))


@query
def describe_lineitem(spark, folder):
    used = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    return rounded(profile.describe(table(spark, folder, "lineitem").select(*used), used), 4)


@on_sites
def corr_with_target(df):
    train = rows.train_rows(coerced(df))
    return rounded(profile.correlations(train, profile.numeric_features(train)))


@on_sites
def histogram(df):
    return rounded(profile.histogram(rows.train_rows(df), TARGET))


@query
def histogram_lineitem(spark, folder):
    return rounded(profile.histogram(table(spark, folder, "lineitem"), "l_extendedprice"), 4)


@on_sites
def kde_curve(df):
    return rounded(profile.density_curve(rows.train_rows(df), TARGET))


@on_sites
def box_stats(df):
    return rounded(profile.box_stats(rows.train_rows(df), "district", TARGET))


@on_sites
def box_stats_road_quality(df):
    return rounded(profile.box_stats(rows.train_rows(df), "road_quality", TARGET))


@on_sites
def distinct_values(df):
    return encode.distinct_values(rows.train_rows(df), "soil_type")


@query
def group_stats_lineitem(spark, folder):
    """Per part: statistics of a large group key at line volume."""
    return rounded(groups.group_risk_rank(
        table(spark, folder, "lineitem"), "l_partkey", "l_discount"), 9)


# --- model scores ----------------------------------------------------------

@on_sites
def regression_metrics(df):
    return rounded(evaluation.regression_metrics(scored_train(df), MODELS))


@on_sites
def custom_metric_by_district(df):
    """The score as an aggregate expression inside an ordinary groupBy."""
    scored = scored_train(df).join(df.select(ID, "district"), ID)
    return rounded(scored.groupBy("district").agg(
        custom_metric(F.col(TARGET), F.col("rain")).alias("custom")))


@on_sites
def metrics_by_fold(df):
    return rounded(evaluation.metrics_by_fold(scored_train(df), MODELS))


@on_sites
def mean_fold_score(df):
    return rounded(evaluation.mean_fold_score(
        evaluation.metrics_by_fold(scored_train(df), MODELS)))


@on_sites
def confusion(df):
    return evaluation.confusion(scored_train(df), "rain")


@on_sites
def class_report(df):
    return rounded(evaluation.class_report(scored_train(df), "rain"))


@on_sites
def spread_report(df):
    return rounded(evaluation.spread_report(scored_train(df), "rain"))


# --- group transforms and features -----------------------------------------

@on_sites
def group_transform(df):
    used = ["historical_flood_count", "rainfall_7d_mm", "infrastructure_score"]
    made = groups.group_transform(df, "district", used)
    return rounded(made.select(ID, *[c for c in made.columns if c.startswith("district_")]))


@on_sites
def relative_zscore(df):
    made = groups.add_relative_features(groups.add_group_stats(df))
    return rounded(made.select(
        ID, *[c for c in made.columns if c.startswith("rel_")], "rainfall_district_zscore"))


@on_sites
def label_rank(df):
    return encode.rank_categories(encode.vocabulary(df, ["district", "soil_type"]))


@on_sites
def label_rank_by_range(df):
    """Ranks of a vocabulary too large for one task."""
    return encode.rank_by_range(encode.vocabulary(df, ["place_name", "district"]), ["column"])


@on_sites
def interactions(df):
    return features.add_interactions(coerced(df)).select(ID, *features.INTERACTIONS)


COMPOUND = ["catchment_saturation_proxy", "compound_flood_risk", "historical_risk_amplifier",
            "evacuation_risk", "triple_risk"]


@on_sites
def compound_risk(df):
    train = groups.range_and_median(rows.train_rows(df), "drainage_index")
    return rounded(features.add_compound_features(coerced(df), train).select(ID, *COMPOUND))


@on_sites
def clip_unit(df):
    return rounded(df.select(ID, features.clip_unit(
        F.col("rainfall_7d_mm") / 100 - 0.5).alias("clipped")), 9)


@on_sites
def haversine_distance(df):
    return rounded(df.select(ID, geo.haversine_km(
        F.col("latitude"), F.col("longitude"), F.lit(6.9271), F.lit(79.8612)).alias("km")))


@on_sites
def location_features(df):
    made = feature_plans.location_features(df)
    kinds = [c for c in made.columns if c not in df.columns]
    return rounded(made.select(ID, SPLIT, "nearest_evac_km", *kinds))


# --- sort, sample, sets ----------------------------------------------------

@on_sites
def top_k_corr(df):
    train = rows.train_rows(coerced(df))
    return rounded(profile.correlation_extremes(train, profile.numeric_features(train), 10))


@on_sites
def sample_n(df):
    return rounded(profile.map_sample(rows.train_rows(df), 5000), 9)


@on_sites
def scatter_pairs(df):
    return rounded(profile.scatter_sample(rows.train_rows(df)), 9)


@on_sites
def union_splits(df):
    train = rows.train_rows(df).drop(SPLIT)
    test = rows.test_rows(df).drop(SPLIT, TARGET)
    both = rows.union_splits(train, test)
    return rounded(both.select(ID, SPLIT, "district", "latitude", TARGET), 9)


@on_sites
def split_back(df):
    """Rows per side after a union and a split."""
    both = rows.union_splits(rows.train_rows(df).drop(SPLIT),
                             rows.test_rows(df).drop(SPLIT, TARGET))
    return rows.train_rows(both).agg(F.count("*").alias("rows"), F.count(TARGET).alias(
        "targets")).withColumn("side", F.lit("train")).unionByName(
        rows.test_rows(both).agg(F.count("*").alias("rows"), F.count(TARGET).alias(
            "targets")).withColumn("side", F.lit("test")))


@on_sites
def vocabulary_union(df):
    used = ["district", "road_quality"]
    return encode.vocabulary_of_splits(rows.train_rows(df), rows.test_rows(df), used)


@on_sites
def vocabulary_sentinel(df):
    return encode.with_sentinel(encode.vocabulary(rows.train_rows(df), ["soil_type"]))


# --- encoders --------------------------------------------------------------

CATEGORIES = ["district", "soil_type", "landcover", "urban_rural", "electricity", "road_quality"]


@on_sites
def label_encode_union(df):
    return encode.label_encode(df, CATEGORIES).select(ID, *[f"{c}_code" for c in CATEGORIES])


@on_sites
def category_codes(df):
    return encode.category_codes(df, CATEGORIES).select(ID, *[f"{c}_code" for c in CATEGORIES])


def grouped(df):
    """Train rows in district folds, so whole districts are unseen by a fold model."""
    return folds.fold_train_rows(df, "district")


def _by_model(df, made):
    return encode.explode_folds(df.select(ID, SPLIT, "fold", *made), made)


@on_sites
def label_encode_unseen(df):
    used = ["district", "soil_type"]
    return _by_model(encode.add_fold_label_codes(grouped(df), used), [f"{c}_code" for c in used])


@on_sites
def label_encode_first(df):
    """Unseen categories take the first code instead of the sentinel's."""
    return _by_model(encode.add_fold_label_codes(grouped(df), ["district"], unseen="first"),
                     ["district_code"])


@on_sites
def native_categories(df):
    used = ["district", "soil_type"]
    return _by_model(encode.add_fold_native_codes(grouped(df), used), [f"{c}_code" for c in used])


@on_sites
def target_encode_global(df):
    made = encode.add_target_encoding(df, config.TARGET_ENCODED)
    return rounded(made.select(ID, *[f"{c}_te" for c in config.TARGET_ENCODED]))


@on_sites
def target_encode_per_fold(df):
    made = encode.add_fold_target_encoding(grouped(df), config.TARGET_ENCODED)
    return rounded(_by_model(made, [f"{c}_te" for c in config.TARGET_ENCODED]))


@on_sites
def standardise(df):
    used = ["elevation_m", "rainfall_7d_mm", "ndwi"]
    filled = encode.fill_medians(df, used, rows.train_rows(df))
    made = encode.standardise(filled, used, rows.train_rows(filled))
    return rounded(made.select(ID, *[f"{c}_std" for c in used]))


@on_sites
def build_features(df):
    """Whole-train encodings without the geographic clusters, which no SQL can repeat."""
    made, names, _ = feature_plans.ensemble_features(df, geo=False)
    return rounded(made.select(ID, SPLIT, *names))


@on_sites
def prepare_minimal(df):
    made, names, _ = feature_plans.minimal_features(df)
    return rounded(made.select(ID, SPLIT, "fold_group", *names))


# --- geography -------------------------------------------------------------

@on_sites
def isolation_flag(df):
    return spatial.add_density_flags(df, 3.0, 20).select(ID, SPLIT, "is_isolated_location")


@on_sites
def isolation_flag_far(df):
    return spatial.add_density_flags(df, 10.0, 10).select(ID, SPLIT, "is_isolated_location")


@on_sites
def isolation_counts(df):
    """Isolated locations per side."""
    return spatial.add_density_flags(df, 3.0, 20).groupBy(SPLIT).agg(
        F.sum("is_isolated_location").alias("isolated"))


@on_sites
def geo_cluster(df):
    return spatial.add_geo_clusters(df).select(ID, SPLIT, "geo_cluster")


@on_sites
def spatial_groups(df):
    return rows.train_rows(spatial.add_spatial_groups(df)).select(ID, "spatial_group")


# --- folds -----------------------------------------------------------------

@on_sites
def kfold_hash(df):
    return folds.kfold(rows.train_rows(df)).select(ID, "fold")


@on_sites
def kfold_tuning(df):
    return folds.kfold(rows.train_rows(df), 3).select(ID, "fold")


@on_sites
def group_kfold(df):
    return folds.group_kfold(rows.train_rows(df), "district").select(ID, "district", "fold")


@on_sites
def fold_views(df):
    """Train and validation rows and target sums of each fold."""
    return rounded(folds.fold_sizes(folds.kfold(rows.train_rows(df))).withColumnRenamed(
        "value_sum", "target_sum"))


@query
def group_kfold_parts(spark, folder):
    """Group folds over many groups of few sizes: the order lines of a part stay together."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return folds.group_kfold(lines, "l_partkey")


# --- blending and calibration ----------------------------------------------

@on_sites
def simple_blend(df):
    return rounded(stand_in_predictions(df).select(
        ID, SPLIT, ensemble.simple_blend(MODELS).alias("blend")))


@on_sites
def gram_matrix(df):
    return rounded(ensemble.gram_matrix(scored_train(df), MODELS), 8)


@on_sites
def optimal_blend(df):
    return rounded(ensemble.optimal_blend(scored_train(df), MODELS), 5)


@on_sites
def optimal_blend_pair(df):
    return rounded(ensemble.optimal_blend(scored_train(df), ["rain", "elev"]), 5)


@on_sites
def apply_blend(df):
    scored = stand_in_predictions(df)
    weights = ensemble.optimal_weights(rows.train_rows(scored), MODELS)
    return rounded(scored.select(ID, SPLIT, features.clip_unit(
        ensemble.weighted_blend(weights)).alias("blend")), 5)


def _blend_by(df, score):
    weights, found = minimise.best_blend(scored_train(df).persist(), MODELS[:2], score)
    return rounded(df.sparkSession.createDataFrame(
        [(m, w, found.score) for m, w in weights.items()], "model string, weight double, score double"), 5)


@on_sites
def blend_custom(df):
    """Weights of two models for the least custom score, which has no closed form."""
    return _blend_by(df, custom_metric)


@on_sites
def blend_mae(df):
    """The same for the mean absolute error."""
    return _blend_by(df, mae)


@on_sites
def stretch_mae(df):
    """The calibration factor for the least mean absolute error."""
    scored = scored_train(df)
    found = minimise.best_stretch(scored, "rain", ensemble.blend_centre(scored, "rain"), mae)
    return rounded(df.sparkSession.createDataFrame([(found.values[0], found.score)], "factor double, mae double"), 5)


@on_sites
def blend_ablation(df):
    return rounded(ensemble.blend_ablation(scored_train(df), MODELS))


@on_sites
def leaderboard(df):
    return rounded(ensemble.leaderboard(scored_train(df), MODELS, 0.2))


@on_sites
def calibrate(df):
    scored = stand_in_predictions(df)
    centre = ensemble.blend_centre(rows.train_rows(scored), "rain")
    return rounded(scored.select(ID, SPLIT, ensemble.calibrated(
        F.col("rain"), centre, 2.5).alias("calibrated")))


@on_sites
def calibration_grid(df):
    return rounded(ensemble.calibration_grid(scored_train(df), "rain"))


@on_sites
def best_calibration(df):
    factor, score = ensemble.best_calibration(scored_train(df), "rain")
    return rounded(df.sparkSession.createDataFrame(
        [(factor, score)], "factor double, custom double"), 5)


# --- learners --------------------------------------------------------------
# All rows, default folds and all learners, but few rounds, trials and restarts (README, Checks):
# the full budgets are the defaults of the learners and runs.

SMALL = {"maxDepth": 4, "maxBins": 32}


def quick_trees(rounds: int = 4):
    return training.tree_learners(rounds, 2, SMALL)


@on_sites
def rf_importance(df):
    return rounded(feature_importance(df, trees=20, depth=6))


@on_sites
def boosted_baseline(df):
    learner = BoostedTrees("baseline", "baseline", True, rounds=5, patience=3, overrides=SMALL)
    return rounded(training.baseline_run(df, learner).oof)


@on_sites
def huber_boost(df):
    learner = HuberBoost(rounds=3, patience=2, step=0.3, depth=4)
    return rounded(training.grouped_run(df, learner).oof)


@on_sites
def leafwise_baseline(df):
    """Out-of-fold predictions of trees of up to 63 leaves, all settings of the role but the rounds."""
    learner = HistogramBoost.of("baseline", uses_nominal=True, rounds=3)
    return rounded(training.baseline_run(df, learner).oof)


@on_sites
def leafwise_huber(df):
    """The same with Huber loss, penalties on leaf values and folds by district."""
    return rounded(training.grouped_run(df, HistogramBoost.of("huber", rounds=3)).oof)


@on_sites
def cv_ensemble(df):
    """Blended test predictions of three boosters with shuffled folds."""
    return rounded(training.ensemble_run(df, quick_trees(), restarts=2).submission())


@on_sites
def cv_spatial(df):
    """Fold scores of three boosters with spatial folds and per-fold encodings."""
    return rounded(training.spatial_run(df, quick_trees(), restarts=2).scores)


@on_sites
def calibrated_submission(df):
    run = training.spatial_run(df, quick_trees(), restarts=1)
    return rounded(training.calibrate_run(run)[0])


@on_sites
def mlp_regressor(df):
    """Out-of-fold predictions of the network for every train row."""
    run = training.network_run(df, Network(epochs=3), config.GROUP_STAT_COLUMNS)
    return rounded(run.oof.select(ID, TARGET, F.col("network").alias("prediction")))


@on_sites
def param_search(df):
    """The trials, and for the best one the out-of-fold error of its refit on all folds."""
    run, trials = training.tuned_run(df, trials=3, tuning_rounds=3, rounds=3, patience=2,
                                     limits={"maxDepth": ("int", 2, 4)}, restarts=2)
    refit = run.scores.filter("fold IS NULL AND model = 'tuned'").select(
        F.col("rmse").alias("refit_rmse"))
    best = trials.orderBy("mean_rmse", "trial").limit(1).select("trial").crossJoin(refit)
    return rounded(trials.join(F.broadcast(best), "trial", "left").orderBy("mean_rmse", "trial"))


@query
def model_artifact(spark, folder):
    """Models of every fold saved, loaded and applied to the test rows."""
    df = feature_plans.staged_features(sites(spark, folder), 2)
    data = FeatureSet(config.GROUP_STAT_COLUMNS).assemble(folds.kfold(df), None).persist()
    learner = BoostedTrees(rounds=3, overrides=SMALL)
    fitted = {f: learner.fit(folds.training_view(rows.train_rows(data), f), None)
              for f in range(config.N_FOLDS)}
    saved = runs.save_models(spark, fitted, scratch_path(spark, "models"))
    scored = None
    for f, path in saved.items():
        part = StagedTrees.load(spark, path).predict(rows.test_rows(data), "prediction").select(
            ID, F.lit(f).alias("fold"), "prediction")
        scored = part if scored is None else scored.union(part)
    return rounded(scored)
