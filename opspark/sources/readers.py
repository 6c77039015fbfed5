"""File and JDBC readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE_CSV = "LocationID int, Borough string, Zone string, service_zone string"
FARES = "zone_id int, hour int, avg_fare double"
DOCUMENTS = "id string, title string, category string, content string, sensitivity string, access_roles array<string>"
GEOJSON = (
    "features array<struct<properties:struct<LocationID:string>,"
    "geometry:struct<type:string,coordinates:array<array<array<string>>>>>>"
)


def demand_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The demand fact; only the wanted columns are read and text times become zone-less timestamps."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if "time_bucket" in df.columns and dict(df.dtypes)["time_bucket"] != "timestamp_ntz":
        df = df.withColumn("time_bucket", F.col("time_bucket").cast("timestamp_ntz"))
    return nan_to_null(df.withColumnsRenamed({"PULocationID": "zone_id"}))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks a missing number in the source; Spark's aggregates skip NULL only."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension from CSV."""
    names = {"LocationID": "zone_id", "Zone": "name", "Borough": "borough"}
    return spark.read.csv(path, header=True, schema=ZONE_CSV).withColumnsRenamed(names)


def fare_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FARES).parquet(path)


def documents_json(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """Document corpus from files that are a JSON array each, or with one document per line."""
    return spark.read.json(path, schema=DOCUMENTS, multiLine=one_document)


def geojson(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """Zone polygons, one row per feature, from whole documents or from one feature collection per line."""
    doc = spark.read.json(path, schema=GEOJSON, multiLine=one_document)
    return doc.select(F.inline("features"))


def zone_centroids(features: DataFrame) -> DataFrame:
    """Centre of the bounding box of each polygon's first ring; other geometries are skipped."""
    ring = F.col("geometry.coordinates")[0]
    lons = F.transform(ring, lambda p: p[0].try_cast("double"))
    lats = F.transform(ring, lambda p: p[1].try_cast("double"))

    def middle(x):
        return (F.array_min(x) + F.array_max(x)) / 2

    return (
        features.where((F.col("geometry.type") == "Polygon") & F.col("properties.LocationID").isNotNull())
        .select(F.col("properties.LocationID").cast("bigint").alias("zone_id"), middle(lats).alias("lat"), middle(lons).alias("lon"))
    )


def entities_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Directory table over JDBC; filters and limits of ``find_entity`` are pushed to the database.

    Pass partitionColumn, lowerBound, upperBound and numPartitions to read a large table in parallel.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
