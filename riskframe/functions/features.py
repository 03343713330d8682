"""Feature expressions. Missing inputs take the stated fill, so outputs are never null
unless a denominator is exactly zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.cleaning import below


def filled(name: str, value: float = 0.0) -> Column:
    return F.coalesce(F.col(name), F.lit(float(value)))


# Feature name -> (columns it needs, expression).
INTERACTIONS = {
    "rain_x_flood_count": (
        ["rainfall_7d_mm", "historical_flood_count"],
        lambda: filled("rainfall_7d_mm") * filled("historical_flood_count")),
    "elevation_x_river": (
        ["elevation_m", "distance_to_river_m"],
        lambda: filled("elevation_m") * F.try_divide(
            F.lit(1.0), filled("distance_to_river_m", 1000) + 1)),
    "rain_ratio": (
        ["rainfall_7d_mm", "monthly_rainfall_mm"],
        lambda: F.try_divide(filled("rainfall_7d_mm"), filled("monthly_rainfall_mm", 1) + 1)),
    "risk_density": (
        ["historical_flood_count", "population_density_per_km2"],
        lambda: filled("historical_flood_count") * filled("population_density_per_km2")),
    "infra_x_evac": (
        ["infrastructure_score", "nearest_evac_km"],
        lambda: F.try_divide(
            filled("infrastructure_score", 50), filled("nearest_evac_km", 10) + 1)),
    "ndwi_x_rain": (
        ["ndwi", "rainfall_7d_mm"], lambda: filled("ndwi") * filled("rainfall_7d_mm")),
    "low_elevation_flag": (["elevation_m"], lambda: below(F.col("elevation_m"), 10.0, 100.0)),
    "close_river_flag": (
        ["distance_to_river_m"], lambda: below(F.col("distance_to_river_m"), 500.0, 9999.0)),
}


def add_interactions(df: DataFrame) -> DataFrame:
    """Two-column products, ratios and threshold flags the input has columns for."""
    return df.withColumns({
        name: build() for name, (needs, build) in INTERACTIONS.items()
        if set(needs) <= set(df.columns)})


def saturation(drainage_median: float, drainage_min: float, drainage_max: float) -> Column:
    """Monthly rain weighted by how poorly the ground drains, on the train range."""
    drainage = F.coalesce(F.col("drainage_index"), F.lit(drainage_median))
    span = F.lit(drainage_max) - F.lit(drainage_min) + F.lit(1e-9)
    return filled("monthly_rainfall_mm") * (
        F.lit(1.0) - (drainage - F.lit(drainage_min)) / span)


def add_compound_features(df: DataFrame, drainage: dict[str, float]) -> DataFrame:
    """Three-column features; `drainage` holds train median, min and max."""
    df = df.withColumn("catchment_saturation_proxy", saturation(
        drainage["median"], drainage["min"], drainage["max"]))
    load = F.col("catchment_saturation_proxy")
    return df.withColumns({
        "compound_flood_risk": F.try_divide(
            filled("rainfall_7d_mm") * load,
            F.greatest(filled("elevation_m"), F.lit(0.0)) + 1),
        "historical_risk_amplifier": (filled("historical_flood_count") + 1) * load,
        "evacuation_risk": F.try_divide(
            filled("nearest_evac_km", 10), filled("infrastructure_score", 50) + 0.1),
        "triple_risk": filled("rainfall_7d_mm") * filled("historical_flood_count")
        * below(F.col("elevation_m"), 10.0, 100.0),
    })


def clip_unit(column: Column) -> Column:
    """Limit to [0, 1]; null stays null although `greatest` and `least` skip nulls."""
    return F.when(column.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), column)))
