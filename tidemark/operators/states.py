"""State that runs hand to each other: observations, due times, schedules, run records and incidents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import hash_bucket
from .signals import repeat_signals

HOUR, DAY = 3_600, 86_400


def refresh_interval(published: Column, now: Column) -> Column:
    """Seconds between readings of a record: an hour below 8 days of age, a day below 31, a week beyond or if unknown."""
    age = F.greatest(F.lit(0), F.unix_timestamp(now) - F.unix_timestamp(published))
    return F.when(published.isNull(), 7 * DAY).when(age < 8 * DAY, HOUR).when(age < 31 * DAY, DAY).otherwise(7 * DAY)


def refresh_due(key: Column, published: Column, changed: Column, last_detail: Column, first_seen: Column, now: Column) -> Column:
    """Whether a record must be read again. One of the archive that was never read in detail waits 0 to 6 days by a hash
    of its id, so that an archive is not read all at once."""
    interval = refresh_interval(published, now)
    since = F.unix_timestamp(now) - F.unix_timestamp(last_detail)
    offset = hash_bucket(key) * DAY
    return (
        F.when(F.coalesce(changed, F.lit(False)), True)
        .when(last_detail.isNotNull(), since >= interval)
        .when(interval < 7 * DAY, True)
        .when(first_seen.isNotNull(), F.unix_timestamp(now) >= F.unix_timestamp(first_seen) + offset)
        .otherwise(offset == 0)
    )


def fold_observations(state: DataFrame, seen: DataFrame, key: list[str], full: bool = False) -> DataFrame:
    """state and seen (key, fingerprint, published_at, first_seen_at, last_detail_at): the state after a run. The first
    sighting stays, a detail time is taken over only where there is a new one; what is no longer seen goes only on a
    full snapshot."""
    s, n = state.alias("s"), seen.alias("n")
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    out = s.join(n, reduce(and_, on), "right" if full else "full")
    pick = lambda c, first: F.coalesce(F.col(f"{first}.{c}"), F.col(f"{'n' if first == 's' else 's'}.{c}")).alias(c)
    return out.select(*(pick(k, "n") for k in key), pick("fingerprint", "n"), pick("published_at", "n"), pick("first_seen_at", "s"), pick("last_detail_at", "n"))


def watermark_if_all(rows: DataFrame, expected: DataFrame, key: str, mark: str) -> DataFrame:
    """The least watermark, only if every expected source has one."""
    own = rows.groupBy(key).agg(F.max(mark).alias(mark))
    x = expected.join(own, key, "left")
    return x.agg(F.when(F.bool_and(F.col(mark).isNotNull()), F.min(mark)).alias(mark), F.count(F.lit(1)).alias("sources"))


def reconcile_due(last_date: Column, pending_empty: Column, now: Column, hour: int, zone: str = "Asia/Seoul") -> tuple[Column, Column]:
    """Whether a daily full reading is due at a local hour, and the local time at which it next is."""
    local = F.from_utc_timestamp(now, zone)
    day = F.greatest(F.date_add(last_date, 1), F.to_date(local))
    at = F.timestamp_seconds(F.unix_timestamp(day.cast("timestamp")) + min(23, max(0, hour)) * HOUR)
    due = F.when(pending_empty | last_date.isNull(), True).otherwise(local >= at)
    return due, F.when(~due, at)


def last_runs(runs: DataFrame, key: str, order: str, keep: int = 100) -> DataFrame:
    """The latest record of each run, and of those the last `keep`; a top-k, which needs no single sorted partition."""
    rest = [c for c in runs.columns if c != key]
    latest = runs.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
    return latest.orderBy(F.desc(order), F.desc(key)).limit(keep)


# What differs between messages of one incident, and what stands in its place.
CHANGING = ((r"https?://\S+", "<url>"), (r"\b(?:[0-9a-f]{8,}|\d+)\b", "<value>"))


def incident_key(text: Column) -> Column:
    """A hash of what stays of a message when addresses, hex strings and numbers are taken out."""
    text = F.lower(text)
    for pattern, to in CHANGING:
        text = F.regexp_replace(text, pattern, to)
    return F.sha2(text, 256)


def incidents(rows: DataFrame, text: Column, at: str, window: int = 21_600, delivered: str | None = None) -> DataFrame:
    """Messages by incident: how many there were, how many of them signal (see `repeat_signals`), how many signals got
    through, and when the last message and the last such signal came."""
    x = rows.select(incident_key(text).alias("fingerprint"), F.unix_timestamp(at).alias("t"), F.col(delivered).alias("delivered") if delivered else F.lit(True).alias("delivered"))
    x = repeat_signals(x, ["fingerprint"], "t", window, "delivered")
    through = F.col("signals") & F.col("delivered")
    return x.groupBy("fingerprint").agg(F.sum("n").alias("n"), F.count_if("signals").alias("signals"), F.count_if(through).alias("delivered"), F.max("t").alias("last_at"), F.max(F.when(through, F.col("t"))).alias("last_signal_at"))


# Words in a message that tell a category, where nothing else does.
BLOCKED, NETWORK = ("security", "blocked", "차단"), ("timeout", "urlopen", "network")
CONTRACT_CODES = ("validation_error", "object_not_found")


def failure_category(origin: Column, kind: Column, status: Column, code: Column, message: Column) -> Column:
    """STA-06. origin: `source`, `destination`, or `config` for a wrong setting, whose kind is then the category itself;
    anything else is told by its message."""
    says = lambda words: F.coalesce(F.lower(message).rlike("|".join(words)), F.lit(False))
    refused = F.coalesce(status.between(400, 499), F.lit(False)) | F.coalesce(code.isin(*CONTRACT_CODES), F.lit(False))
    is_ = lambda c, *v: F.coalesce(c.isin(*v), F.lit(False))
    at_dest = F.when(is_(kind, "contract"), "destination_contract").when(is_(status, 429), "destination_rate_limit").when(is_(status, 401, 403), "destination_auth").when(refused, "destination_contract").otherwise("destination")
    config = F.when(is_(kind, "destination_auth", "destination_contract", "source_contract"), kind).otherwise("internal")
    by_text = F.when(says(BLOCKED), "security_policy").when(says(NETWORK), "network").otherwise("internal")
    return F.when(is_(origin, "config"), config).when(is_(origin, "source"), F.when(is_(kind, "access_block"), "security_policy").otherwise("source_upstream")).when(is_(origin, "destination"), at_dest).otherwise(by_text)
