"""Rent quotes for a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions.numbers import annual, confidence, half_even
from rentscope.operators.metrics import BANDS, SEGMENT

SIDES = ["low", "mid", "high"]


def quote(requests: DataFrame, metrics: DataFrame) -> DataFrame:
    """Answer every request (district, building_type, area_ping, any other columns).

    ``status`` is ``ok``, ``not_found`` or ``invalid_area``; only ``ok`` rows carry
    figures. No join hint: metrics are broadcast when the planner sees a small
    table, and a hot segment of a large one is split by the adaptive skew join.
    """
    known = metrics.select(
        *SEGMENT, "sample_size", *BANDS.values(), "median_rent_ntd", "updated_at"
    )
    joined = requests.join(known, SEGMENT, "left")
    status = (
        F.when(F.coalesce(F.col("area_ping") <= 0, F.lit(True)), "invalid_area")
        .when(F.col("sample_size").isNull(), "not_found")
        .otherwise("ok")
    )
    joined = joined.withColumn("status", status)
    ok = F.col("status") == "ok"
    asked = [F.col(c) for c in requests.columns]
    quoted = joined.select(
        *asked,
        "status",
        *[F.when(ok, half_even(F.col(u) * F.col("area_ping"))).alias(n) for n, u in BANDS.items()],
        *[
            F.when(ok, F.bround(unit, 2)).alias(f"rent_per_ping_{side}")
            for side, unit in zip(SIDES, BANDS.values())
        ],
        F.when(ok, F.bround("median_rent_ntd", 0)).alias("district_median_rent_ntd"),
        F.when(ok, confidence(F.col("sample_size"))).alias("confidence_score"),
        F.when(ok, F.col("sample_size")).alias("sample_size"),
        F.when(ok, F.lit(vocab.CURRENCY)).alias("currency"),
        F.when(ok, F.lit(vocab.RENT_SOURCE)).alias("data_source"),
        F.when(ok, F.col("updated_at")).alias("updated_at"),
    )
    tiers = [
        F.struct(
            F.lit(label).alias("label"),
            F.col(f"recommended_rent_{side}").alias("monthly_rent_ntd"),
            F.col(f"rent_per_ping_{side}").alias("rent_per_ping_ntd"),
            F.lit(note).alias("note"),
        ).alias(tier)
        for side, (tier, label, note) in zip(SIDES, vocab.QUOTE_TIERS)
    ]
    yearly = [annual(F.col(f"recommended_rent_{side}")).alias(f"{side}_ntd") for side in SIDES]
    ok = F.col("status") == "ok"
    return quoted.withColumns(
        {
            "pricing_guidance": F.when(ok, F.struct(*tiers)),
            "annual_rent_estimate": F.when(ok, F.struct(*yearly)),
        }
    )


def breakdown(quotes: DataFrame) -> DataFrame:
    """Three rows per answered quote: strategy, monthly, per-ping and annual rent."""
    rows = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(label).alias("strategy"),
            F.col(f"recommended_rent_{side}").alias("monthly_rent"),
            F.col(f"rent_per_ping_{side}").alias("rent_per_ping"),
            F.col(f"annual_rent_estimate.{side}_ntd").alias("annual_rent"),
        )
        for place, (side, (_, label, _)) in enumerate(zip(SIDES, vocab.QUOTE_TIERS))
    ]
    keys = [c for c in quotes.columns if c in ("request_id", *SEGMENT, "area_ping")]
    listed = quotes.filter("status = 'ok'").select(*keys, F.explode(F.array(*rows)).alias("_r"))
    return listed.select(*keys, "_r.*")
