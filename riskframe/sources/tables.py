"""Parquet tables and the `sites` view derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.cleaning import clean_nan

# One row per order, shaped like a location survey: nulls, dirty text, outliers and
# null coordinates included. Valid in Spark SQL and in the checking engine.
SITES_SQL = """
SELECT o.o_orderkey AS record_id,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE n.n_name END AS district,
  c.c_name AS place_name,
  o.o_orderdate AS generation_date,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE c.c_mktsegment END AS soil_type,
  o.o_orderpriority AS landcover,
  o.o_orderstatus AS urban_rural,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL WHEN o.o_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS electricity,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_custkey % 4 = 0 THEN 'paved' WHEN o.o_custkey % 4 = 1 THEN 'gravel' ELSE 'dirt' END AS road_quality,
  CASE WHEN o.o_orderkey % 37 = 0 THEN NULL
       WHEN o.o_orderkey % 200 = 7 THEN 5.9e0 + ((o.o_orderkey * 7919) % 39000) / 1e4
       ELSE 6.0e0 + (n.n_nationkey % 5) * 0.75e0 + ((o.o_orderkey * 7919) % 1000) / 2e4 END AS latitude,
  CASE WHEN o.o_orderkey % 37 = 0 THEN NULL
       WHEN o.o_orderkey % 200 = 7 THEN 79.6e0 + ((o.o_orderkey * 104729) % 22000) / 1e4
       ELSE 79.7e0 + (n.n_regionkey % 5) * 0.45e0 + ((o.o_orderkey * 104729) % 1000) / 2e4 END AS longitude,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE ((o.o_orderkey * 53 + o.o_custkey * 11) % 2003) / 1e1 END AS rainfall_7d_mm,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE abs(c.c_acctbal) / 25e0 END AS monthly_rainfall_mm,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE CAST(o.o_orderkey % 12 AS DOUBLE) END AS historical_flood_count,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CAST((o.o_orderkey * 31) % 401 - 5 AS DOUBLE) END AS elevation_m,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST((o.o_orderkey * 17) % 5003 AS DOUBLE) END AS distance_to_river_m,
  CASE WHEN o.o_orderkey % 21 = 0 THEN NULL ELSE (o.o_custkey % 1000) / 1e3 END AS drainage_index,
  CASE WHEN o.o_orderkey % 26 = 0 THEN NULL ELSE ((o.o_orderkey * 29) % 2003 - 1000) / 1e3 END AS ndvi,
  CASE WHEN o.o_orderkey % 27 = 0 THEN NULL ELSE ((o.o_orderkey * 13) % 2003 - 1000) / 1e3 END AS ndwi,
  CASE WHEN o.o_orderkey % 28 = 0 THEN NULL ELSE CAST((o.o_custkey * 3) % 101 AS DOUBLE) END AS built_up_percent,
  CASE WHEN o.o_orderkey % 33 = 0 THEN NULL ELSE CAST((o.o_custkey * 7) % 101 AS DOUBLE) END AS infrastructure_score,
  CASE WHEN o.o_orderkey % 35 = 0 THEN NULL ELSE CAST((o.o_custkey * 37) % 5003 AS DOUBLE) END AS population_density_per_km2,
  CASE WHEN o.o_orderkey % 34 = 0 THEN NULL ELSE ((o.o_custkey * 19) % 503) / 1e1 END AS nearest_hospital_km,
  CASE WHEN o.o_orderkey % 43 = 0 THEN 'unknown' WHEN o.o_orderkey % 47 = 0 THEN '7d'
       WHEN o.o_orderkey % 25 = 0 THEN NULL
       ELSE concat(' ', CAST(o.o_orderkey % 30 AS VARCHAR(10)), '.5') END AS nearest_evac_km,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE ln(1e0 + ((o.o_orderkey * 53 + o.o_custkey * 11) % 2003) / 1e1) END AS rainfall_7d_mm_log1p,
  CASE WHEN o.o_custkey % 2 = 0 THEN 1 ELSE 0 END AS water_presence_flag,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE
    0.3e0 * o.o_totalprice / 5e5 + 0.4e0 * (((o.o_orderkey * 53 + o.o_custkey * 11) % 2003) / 1e1) / 200.3e0
    + 0.2e0 * (1e0 - ((o.o_orderkey * 31) % 401) / 401e0) + 0.1e0 * ((n.n_nationkey * 7) % 10) / 1e1 END AS flood_risk_score
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""


# Column types of the tables read most; a declared schema spares a look at the files.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """Train and test locations in one table, told apart by `split`."""
    used = {name: table(spark, folder, name) for name in ("orders", "customer", "nation")}
    return clean_nan(spark.sql(SITES_SQL, **used))
