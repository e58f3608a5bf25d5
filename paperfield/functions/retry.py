"""Back-off, leases and other time arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
BACKOFF_BASE = 1.0
BACKOFF_CAP = 120.0
SEARCH_BACKOFF_BASE = 8.0
SEARCH_BACKOFF_CAP = 1800.0
CRAWL_LEASE_SECONDS = 300
DOWNLOAD_LEASE_SECONDS = 600
DOWNLOAD_RETRIES = 5
THROTTLE_STATUSES = (429, 503, 403)
# ----------------------------------------------------------------------------------------------


def jitter(key: Column, attempt: Column) -> Column:
    """A number in [0, 1) fixed by (key, attempt), so that a recomputed task gives the same value."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), attempt.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def backoff_seconds(
    key: Column, attempt: Column, base: float = BACKOFF_BASE, cap: float = BACKOFF_CAP
) -> Column:
    """``min(cap, base * 2^attempt)`` scaled by a factor in [0.5, 1.5)."""
    growth = F.lit(base) * F.pow(F.lit(2.0), F.greatest(attempt, F.lit(0)).cast("double"))
    return F.least(F.lit(cap), growth) * (F.lit(0.5) + jitter(key, attempt))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.to_timestamp(ts) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def crawl_retry_at(url: Column, attempts: Column, retry_after: Column, at: Column) -> Column:
    """When a throttled crawl job is due again: after Retry-After, or the back-off of its attempts."""
    return plus_seconds(at, F.coalesce(retry_after.cast("double"), backoff_seconds(url, attempts)))


def is_due(next_attempt: Column, now: Column) -> Column:
    return next_attempt.isNull() | (next_attempt <= now)


def lease_expired(status: Column, locked_until: Column, now: Column) -> Column:
    return F.coalesce((status == "processing") & (locked_until < now), F.lit(False))


def is_throttled(http_status: Column) -> Column:
    return F.coalesce(http_status.isin(*THROTTLE_STATUSES), F.lit(False))
