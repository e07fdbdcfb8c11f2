"""From raw rent rows to plausible transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions import dates
from rentscope.functions.numbers import half_even, to_number
from rentscope.operators.once import once

REQUIRED = ["district", "building_type", "area_ping", "rent_ntd", "transaction_date"]
ALIASES = {"rent_total_ntd": "rent_ntd", "rent_per_ping_ntd": "rent_per_ping"}


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def rental_rows(df: DataFrame, require_rows: bool = False) -> DataFrame:
    """Rows that any of the case or lease columns marks as a rental.

    ``require_rows`` raises if there is none; it costs a job that stops at the first.
    """
    present = [c for c in vocab.RENTAL_COLUMNS if c in df.columns]
    if not present:
        raise ValueError(f"no rental column among {df.columns}")
    tests = [F.coalesce(_text(df, c).contains(vocab.RENTAL_WORD), F.lit(False)) for c in present]
    kept = df.filter(reduce(lambda a, b: a | b, tests))
    if require_rows and kept.isEmpty():
        raise ValueError("no rental row; look at the values of " + ", ".join(present))
    return kept


def total_rent(df: DataFrame) -> Column:
    """Monthly rent: unit price by area, else the total price in units of ten thousand."""
    by_unit = to_number(_text(df, "UPRICE")) * to_number(_text(df, "FAREA"))
    return half_even(F.coalesce(by_unit, to_number(_text(df, "TPRICE")) * 10000))


def normalise(df: DataFrame) -> DataFrame:
    """The ten clean columns; every raw column is optional."""
    building = _text(df, "BUITYPE") if "BUITYPE" in df.columns else F.lit("unknown")
    return df.select(
        _text(df, "DISTRICT").alias("district"),
        building.alias("building_type"),
        to_number(_text(df, "FAREA")).alias("area_ping"),
        total_rent(df).alias("rent_total_ntd"),
        to_number(_text(df, "UPRICE")).alias("rent_per_ping_ntd"),
        dates.roc_date(_text(df, "SDATE")).alias("transaction_date"),
        _text(df, "ELEVATOR").alias("has_elevator"),
        _text(df, "RENT_TYPE").alias("rent_type"),
        _text(df, "RENT_PERIOD").alias("rent_period"),
        F.lit(vocab.RENT_SOURCE).alias("source"),
    )


def fill_unit_rent(df: DataFrame) -> DataFrame:
    """Unit rent from total and area where it is missing."""
    derived = F.when(F.col("area_ping") > 0, F.col("rent_total_ntd") / F.col("area_ping"))
    return df.withColumn("rent_per_ping_ntd", F.coalesce("rent_per_ping_ntd", derived))


def required_present(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["district", "area_ping", "rent_total_ntd", "transaction_date"])


def plausible(
    df: DataFrame,
    area: str = "area_ping",
    total: str = "rent_total_ntd",
    unit: str = "rent_per_ping_ntd",
) -> DataFrame:
    a, t, u = F.col(area), F.col(total), F.col(unit)
    return df.filter(
        (a > 0) & (a < 300) & (t > 3000) & (t < 1000000) & (u > 100) & (u < 10000)
    )


def clean_rent(raw: DataFrame) -> DataFrame:
    """Normalised, completed and plausible rent rows."""
    return plausible(required_present(once(fill_unit_rent(normalise(raw)))))


def to_ingest(rent: DataFrame) -> DataFrame:
    """Clean rent rows in the ingest schema; a missing building type is ``unknown``."""
    return rent.select(
        "district",
        F.coalesce("building_type", F.lit("unknown")).alias("building_type"),
        F.col("area_ping").cast("double"),
        F.col("rent_total_ntd").cast("bigint").alias("rent_ntd"),
        F.col("rent_per_ping_ntd").cast("double").alias("rent_per_ping"),
        F.col("transaction_date").cast("date"),
        "source",
    )


def normalise_transactions(df: DataFrame) -> DataFrame:
    """Any ingest table in the transaction schema, without the ingest stamp."""
    for old, new in ALIASES.items():
        if new not in df.columns and old in df.columns:
            df = df.withColumnRenamed(old, new)
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")

    def optional(name: str, kind: str, default=None) -> Column:
        found = F.col(name).cast(kind) if name in df.columns else F.lit(default).cast(kind)
        return found.alias(name)

    area, rent = F.col("area_ping").cast("double"), F.col("rent_ntd").cast("bigint")
    unit = F.when(area != 0, rent / area)
    if "rent_per_ping" in df.columns:
        unit = F.coalesce(F.col("rent_per_ping").cast("double"), unit)
    return df.select(
        "district",
        "building_type",
        area.alias("area_ping"),
        rent.alias("rent_ntd"),
        unit.alias("rent_per_ping"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        optional("floor", "int"),
        optional("building_age_years", "int"),
        optional("source", "string", vocab.RENT_SOURCE),
    )
