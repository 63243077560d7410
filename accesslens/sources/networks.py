"""Geo and ASN network tables from CSV; a missing file disables its half."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CITY_CIDR = "network STRING, country STRING, registered_country STRING, city STRING"
ASN_CIDR = "network STRING, asn BIGINT, as_org STRING"
CITY_BLOCKS = "network STRING, geoname_id BIGINT, registered_country_geoname_id BIGINT"
LOCATIONS = "geoname_id BIGINT, country_iso_code STRING, city_name STRING"
CITY_RANGES = "start_ip BIGINT, end_ip BIGINT, country STRING, registered_country STRING, city STRING"
ASN_RANGES = "start_ip BIGINT, end_ip BIGINT, asn BIGINT, as_org STRING"


def read_networks(spark: SparkSession, path: str | None, schema: str) -> DataFrame | None:
    """Networks with the given schema, or None when there is no such file."""
    if not path:
        return None
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def city_networks(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """City blocks joined with their locations, the usual published layout.

    ``blocks``: network, geoname_id, registered_country_geoname_id;
    ``locations``: geoname_id, country_iso_code, city_name.
    """
    place = locations.select(
        F.col("geoname_id"), F.col("country_iso_code").alias("country"), F.col("city_name").alias("city")
    )
    registered = locations.select(
        F.col("geoname_id").alias("registered_country_geoname_id"),
        F.col("country_iso_code").alias("registered_country"),
    )
    return (
        blocks.join(place, "geoname_id", "left")
        .join(registered, "registered_country_geoname_id", "left")
        .select("network", "country", "registered_country", "city")
    )
