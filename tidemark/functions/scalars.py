"""Row-level rules as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config


def at_least(value: Column, cut: Column | float) -> Column:
    """``value >= cut`` that is false for NaN, which Spark otherwise sorts above every number."""
    cut = cut if isinstance(cut, Column) else F.lit(float(cut))
    return (value >= cut) & ~F.isnan(value)


def predict_at(value: Column, cut: Column | float = 0.5) -> Column:
    return F.coalesce(at_least(value, cut), F.lit(False)).cast("int")


def count_passed(value: Column, edges: Sequence[Column], strict: bool = False) -> Column:
    """How many of the ascending ``edges`` are <= value (< if strict).

    A balanced tree of comparisons: log2(len) of them per row, all inside generated code.
    """

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        passed = value > edges[mid] if strict else value >= edges[mid]
        return F.when(passed, tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(edges))


def bin_index(value: Column, edges: Sequence[float]) -> Column:
    """As :func:`count_passed`, for edges known beforehand."""
    return count_passed(value, [F.lit(float(e)) for e in edges])


def edges_passed(value: Column, edges: Column, n: int, strict: bool = False) -> Column:
    """As :func:`count_passed`, for the ``n`` values of an array column."""
    return count_passed(value, [F.get(edges, F.lit(i)) for i in range(n)], strict)


def request_violations(key: str = "entity_id") -> Column:
    """Array of broken rules; an empty array means the request is valid."""
    lo, hi = config.ENTITY_ID_LENGTH
    rules = [(key, ~F.coalesce(F.length(key).between(lo, hi), F.lit(False)))]
    for name, (least, most) in config.FEATURE_BOUNDS.items():
        inside = F.col(name).between(least, most) & ~F.isnan(name)
        rules.append((name, ~F.coalesce(inside, F.lit(False))))
    return F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules]))


def heuristic_flag() -> Column:
    """The business rule used as the weakest baseline."""
    hit = (F.col("satisfaction_score") < 2.5) | (F.col("support_tickets_30d") > 3)
    return F.coalesce(hit, F.lit(False)).cast("int")


def tier(score: Column, t_low: Column | float, t_high: Column | float) -> Column:
    low, mid, high = config.TIERS
    return (
        F.when(score < t_low, F.lit(low)).when(score < t_high, F.lit(mid)).when(score.isNotNull(), F.lit(high))
    )


def low_confidence(
    score: Column, t_low: Column | float, t_high: Column | float, band: float = config.LOW_CONFIDENCE_BAND
) -> Column:
    near_low = F.abs(score - t_low) <= band
    near_high = F.abs(score - t_high) <= band
    return near_low | near_high


def label_available_at(event_time: Column, days: int = config.LABEL_DELAY_DAYS) -> Column:
    return event_time + F.expr(f"interval {int(days)} days")


def psi_band(psi: Column) -> Column:
    band = F.lit(config.PSI_STABLE)
    for least, name in reversed(config.PSI_BANDS):
        band = F.when(psi > least, F.lit(name)).otherwise(band)
    return band


def sticky_bucket(key: Column) -> Column:
    """SHA-256 of the key, read as one big integer, modulo 100.

    The digest is folded in eight 32-bit words: 2**32 leaves 96 modulo 100.
    """
    digest = F.sha2(key.cast("string"), 256)
    acc = F.lit(0).cast("bigint")
    for word in range(8):
        part = F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10).cast("bigint")
        acc = (acc * 96 + part) % 100
    return acc.cast("int")


def pick_variant(bucket: Column, canary_pct: Column | int, staged: Column | bool = True) -> Column:
    pct = canary_pct if isinstance(canary_pct, Column) else F.lit(int(canary_pct))
    has = staged if isinstance(staged, Column) else F.lit(bool(staged))
    return F.when(has & (pct > 0) & (bucket < pct), F.lit("challenger")).otherwise(F.lit("champion"))


def version_id(ts: Column) -> Column:
    """Version ids that sort as text in time order."""
    return F.date_format(ts, "'v'yyyyMMdd'T'HHmmssSSSSSS")


def hash_mod(key: Column, seed: int, modulus: int = 10_000) -> Column:
    """A repeatable draw in [0, modulus) per key and seed; the same in any engine with SHA-256."""
    return F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint") % modulus


def seeded_hash(key: Column, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256)


def check_status(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def alert_line(severity: Column, message: Column) -> Column:
    prefix = F.lit(config.ALERT_PREFIX["warning"])
    for name, text in config.ALERT_PREFIX.items():
        prefix = F.when(severity == name, F.lit(text)).otherwise(prefix)
    return F.concat_ws(" ", prefix, message)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """Ratio as double; zero when the denominator is zero."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(
        top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    )
