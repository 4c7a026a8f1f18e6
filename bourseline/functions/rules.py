"""Market rules: signals, actions, labels and scores as Column expressions.

Null compares as unknown in SQL; the flags below turn unknown into false or the
default label, so a missing input can never raise a signal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    # Value and volume floors, spike ratios.
    whale_value: float = 500_000_000
    anomaly_value: float = 2_000_000_000
    min_volume: float = 100_000
    spike_ratio: float = 1.5
    anomaly_ratio: float = 2.0


DEFAULTS = Thresholds()

# Split and reverse-split ratios of the share count.
SPLIT_RATIO = 1.9
REVERSE_RATIO = 0.55

# Investor types of each screener group, short and long forms.
CORPORATE = ("CP", "Corporate")
INDIVIDUAL = ("ID", "Individual")
FUND = ("MF", "Mutual Funds", "Fund Manager")
FINANCIAL = ("IB", "Bank", "Financial Institutional")
FOREIGN = ("F", "A")


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def change_pct(change: Column, previous: Column) -> Column:
    return F.when(previous.isNull(), None).when(previous != 0, change / previous * 100).otherwise(F.lit(0.0))


def typical_price(high: Column, low: Column, close: Column) -> Column:
    return (high + low + close) / 3


def vwap(value: Column, volume: Column, close: Column) -> Column:
    return F.when(volume > 0, value / volume).otherwise(close)


def trade_signal(close: Column, vwma: Column, volume: Column, ma_volume: Column) -> Column:
    # The three signal names.
    busy = volume > ma_volume
    return (
        F.when((close > vwma) & busy, "Akumulasi")
        .when((close < vwma) & busy, "Distribusi")
        .otherwise("Netral")
    )


def whale_signal(ratio: Column, value: Column, volume: Column, base: Column, t: Thresholds = DEFAULTS) -> Column:
    return flag((ratio >= t.spike_ratio) & (value >= t.whale_value) & (volume >= t.min_volume) & (base > 0))


def big_player(order_volume: Column, base: Column, value: Column, volume: Column, t: Thresholds = DEFAULTS) -> Column:
    return flag(
        (order_volume > t.anomaly_ratio * base) & (base > 0)
        & (value >= t.anomaly_value) & (volume >= t.min_volume)
    )


def holder_action(prev: Column, curr: Column) -> Column:
    # The action names; the order of the cases matters.
    return (
        F.when((prev == 0) & (curr > 0), "Buying")
        .when((curr > prev) & (prev > 0), "Accumulation")
        .when(curr < prev, "Reduction")
        .when((curr == prev) & (curr > 0), "Holding")
        .otherwise("Skip")
    )


def trade_action(change: Column) -> Column:
    return F.when(change > 0, "BUYING").when(change < 0, "SELLING").otherwise("HOLDING")


def alert_level(points: Column) -> Column:
    size = F.abs(points)
    return F.when(size >= 2.0, "HIGH").when(size >= 1.0, "MEDIUM").otherwise("LOW")


def is_split(now: Column, prev: Column) -> Column:
    return flag((prev > 0) & (F.try_divide(now.cast("double"), prev) >= SPLIT_RATIO))


def is_reverse(now: Column, prev: Column) -> Column:
    return flag((prev > 0) & (F.try_divide(now.cast("double"), prev) <= REVERSE_RATIO))


def position_delta(now: Column, prev: Column, adjusted: Column) -> Column:
    """Change of a position; 0 without a previous month or across a (reverse) split."""
    zero = F.lit(0).cast("bigint")
    return F.when(prev.isNull() | adjusted, zero).otherwise(F.coalesce(now, zero) - prev)


@dataclass(frozen=True)
class ScreenerFlags:
    """The six conditions of the ownership screener, over group changes."""

    corp: Column
    foreign: Column
    ind: Column
    institutions: Column

    def cases(self) -> list[tuple[Column, int, str]]:
        # Limits, points and labels, in score order.
        return [
            ((self.corp > 1) & (self.ind < -0.5), 3, "🟢 Corp Acc"),
            (self.foreign > 1, 2, "🟢 Foreign In"),
            (self.institutions > 50, 1, "💎 Inst Dom"),
            ((self.corp < -1) & (self.ind > 0.5), -2, "🔴 Corp Dist"),
            (self.foreign < -1, -2, "🔴 Foreign Out"),
            (self.ind > 1, 1, "🟡 Insider Buy"),
        ]

    def score(self) -> Column:
        total = F.lit(0)
        for condition, points, _ in self.cases():
            total = total + F.when(condition, points).otherwise(0)
        return total

    def labels(self) -> Column:
        return F.concat_ws(", ", *[F.when(condition, label) for condition, _, label in self.cases()])
