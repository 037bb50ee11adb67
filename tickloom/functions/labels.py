"""Threshold labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rsi_zone(rsi: Column) -> Column:
    """Overbought / Strong / Neutral / Weak / Oversold at 70, 60, 40 and 30."""
    return (
        F.when(rsi >= 70, "Overbought")
        .when(rsi >= 60, "Strong")
        .when(rsi >= 40, "Neutral")
        .when(rsi >= 30, "Weak")
        .otherwise("Oversold")
    )


def obi_tag(obi: Column) -> Column:
    """Pressure label of an order-book imbalance in -1..1; strong sides are closed, mild ones open."""
    return (
        F.when(obi >= 0.30, "strong bid pressure")
        .when(obi <= -0.30, "strong ask pressure")
        .when(obi > 0.10, "mild bid pressure")
        .when(obi < -0.10, "mild ask pressure")
        .otherwise("balanced")
    )


def in_zone(zone: Column, wanted: str) -> Column:
    """Zone filter: 'All' keeps everything, otherwise equality ignoring case."""
    return F.lit(wanted == "All") | (F.lower(zone) == wanted.lower())


def is_trading(status: Column) -> Column:
    """Unknown status counts as trading."""
    return F.coalesce(status, F.lit("TRADING")) == "TRADING"
