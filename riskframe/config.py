"""Fixed values shared by the operators.

The names, fills and parameters below define the feature contract; results are only
comparable when they are kept as they are.
"""

TARGET = "flood_risk_score"
ID = "record_id"
SPLIT = "split"
TRAIN, TEST = "train", "test"
SEED = 42
N_FOLDS = 5
GEO_CLUSTERS = 25
SPATIAL_GROUPS = 20
KMEANS_RESTARTS = 10
EARTH_RADIUS_KM = 6371.0

# --- fixed values: columns -------------------------------------------------
DIRTY_NUMERIC = ["nearest_evac_km"]
COORDINATES = ["latitude", "longitude"]

MISSING_FLAG_COLUMNS = [
    "electricity", "road_quality", "distance_to_river_m", "drainage_index",
    "ndvi", "ndwi", "infrastructure_score", "nearest_evac_km",
    "nearest_hospital_km", "soil_type", "population_density_per_km2",
    "built_up_percent",
]

GROUP_STAT_COLUMNS = [
    "historical_flood_count", "rainfall_7d_mm", "monthly_rainfall_mm",
    "infrastructure_score", "elevation_m", "distance_to_river_m",
    "drainage_index", "ndwi", "population_density_per_km2",
]

RELATIVE_COLUMNS = [
    "elevation_m", "distance_to_river_m", "rainfall_7d_mm",
    "infrastructure_score", "drainage_index",
]

TARGET_ENCODED = ["district", "soil_type", "landcover", "urban_rural"]
TARGET_ENCODED_GLOBAL = TARGET_ENCODED + ["geo_cluster"]

PROFILE_CATEGORIES = [
    "district", "soil_type", "landcover", "urban_rural",
    "water_presence_flag", "electricity", "road_quality",
]

SCATTER_COLUMNS = [
    "elevation_m", "distance_to_river_m", "rainfall_7d_mm",
    "historical_flood_count", "drainage_index", "ndvi",
]

# Columns each profile removes before learning.
_DESCRIPTIVE = [ID, TARGET, "place_name", "generation_date", "reason_not_good_to_live"]
_OUTCOME = [
    "is_good_to_live", "is_synthetic", "flood_occurrence_current_event",
    "inundation_area_sqm",
]
_DUPLICATES = [
    "distance_to_river_m_log1p", "population_density_per_km2_log1p",
    "rainfall_7d_mm_log1p", "monthly_rainfall_mm_log1p",
    "nearest_hospital_km_log1p", "nearest_evac_km_log1p",
    "elevation_m_yeojohnson", "drainage_index_yeojohnson",
    "ndvi_qmap", "ndwi_qmap", "built_up_percent_qmap", "water_presence_flag",
]
DROP_PROFILES = {
    "baseline": _DESCRIPTIVE,
    "core": _DESCRIPTIVE + _OUTCOME,
    "clean": _DESCRIPTIVE + _OUTCOME + _DUPLICATES,
}

# --- fixed values: text ----------------------------------------------------
MISSING_LABEL = "nan"          # a missing category becomes this text
UNSEEN_LABEL = "__UNSEEN__"

# Cell texts a delimited file reader takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: calibration ---------------------------------------------
CALIBRATION_FACTORS = [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0]
CALIBRATION_BOUNDS = (0.5, 8.0)
BINARY_THRESHOLD = 0.5
TREE_FILL = -999.0

# --- fixed values: density settings (radius km, minimum samples) -----------
DENSITY_SETTINGS = {"near": (3.0, 20), "far": (10.0, 10)}

# --- bounds that decide the physical strategy ------------------------------
MAX_BROADCAST_ROWS = 200_000      # a lookup up to this many rows is broadcast
MAX_BUFFERED_VALUES = 1_000_000   # values one quantile buffer may hold
HOT_KEY_SHARE = 1 / 256           # a key above this share of the rows is "hot"
TASK_ROWS = 5_000_000             # so is one above the rows a task should hold
