"""Questions asked of device readings. Each takes the readings it should cover as its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.aggregates import sorted_rows

# The thresholds of the questions.
WARM, HOT, HUMID = 25, 30, 70
BATTERY_OK, CO2_HIGH = 6, 1400
TOP_COUNTRIES, TOP_EMPTY = 20, 100


def hot_and_humid(devices: DataFrame) -> DataFrame:
    return devices.filter((F.col("temp") > HOT) & (F.col("humidity") > HUMID))


def warm_readings(devices: DataFrame) -> DataFrame:
    return devices.where(F.col("temp") > WARM).select("temp", "device_name", "device_id", "cca3")


def charged_by_co2(devices: DataFrame) -> DataFrame:
    rows = devices.where(F.col("battery_level") > BATTERY_OK).select("battery_level", "c02_level", "device_name")
    return sorted_rows(rows, "c02_level")


def country_averages(devices: DataFrame, warm_only: bool = False) -> DataFrame:
    """Mean temperature and humidity per country, of all readings or of warm ones."""
    rows = devices.where(F.col("temp") > WARM) if warm_only else devices
    return rows.groupBy("cca3").agg(F.avg("temp").alias("avg_temp"), F.avg("humidity").alias("avg_humidity"))


def busiest_countries(devices: DataFrame, k: int = TOP_COUNTRIES) -> DataFrame:
    return devices.groupBy("cca3").agg(
        F.count("device_id").alias("number"), F.avg("humidity").alias("avg_humidity"),
        F.avg("temp").alias("avg_temp"),
    ).orderBy(F.desc("number"), "cca3").limit(k)


def high_co2(devices: DataFrame) -> DataFrame:
    rows = devices.filter(F.col("c02_level") > CO2_HIGH).select("cca3", "c02_level")
    return sorted_rows(rows, F.desc("c02_level"))


def empty_batteries(devices: DataFrame, k: int = TOP_EMPTY) -> DataFrame:
    return devices.filter(F.col("battery_level") == 0).groupBy("cca3").agg(
        F.countDistinct("device_id").alias("devices")
    ).orderBy(F.desc("devices"), "cca3").limit(k)
