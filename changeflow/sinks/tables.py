"""Event log, dead letters, audit table, retention, replay and versioned tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.functions.text import subject_matches
from changeflow.functions.values import moment
from changeflow.scratch import children, exists, remove
from changeflow.spec import CHANGE_KINDS

# The largest message in bytes and the address prefix of dead letters.
MAX_BYTES = 4 * 1024 * 1024
DEAD_LETTER_PREFIX = "cdc.dlq"


def write_events(df: DataFrame, path: str, ts: str = "detected_at", run: int | str | None = None) -> None:
    """Append events to the log, laid out by driver and day of detection so that readers prune folders.

    The day is the one on which the change was seen: many sources give no time of their own. Rows are
    rebalanced by folder: Spark splits a busy driver's day over several tasks and packs small ones
    together, so tasks and files have an even size. With ``run`` the events lie below a folder of that
    run or batch, which a repeated run replaces, so nothing is stored twice.
    """
    dated = df.withColumn("event_date", F.to_date(ts)).hint("rebalance", "driver_id", "event_date")
    if run is None:
        dated.write.mode("append").partitionBy("driver_id", "event_date").parquet(path)
    else:
        dated.write.mode("overwrite").partitionBy("driver_id", "event_date").parquet(f"{path}/run={run}")


def dead_letter_reason(max_bytes: int = MAX_BYTES, errors: str | None = None, kind: str | None = None) -> Column:
    """Why an event cannot be published, NULL when it can; ``kind`` names a change-kind column to check."""
    subject = F.coalesce(F.col("subject"), F.lit(""))
    reason = (
        F.when(subject == "", "no address")
        .when(subject.rlike(r"\{[^}]+\}"), "unresolved token")
        .when(F.col("envelope").isNull(), "not encodable")
        .when(F.octet_length("envelope") > max_bytes, "too large")
    )
    if kind:
        reason = F.when(F.col(kind).isNull() | ~F.col(kind).isin(*CHANGE_KINDS), "unknown change kind").otherwise(reason)
    return F.when(F.size(errors) > 0, "invalid").otherwise(reason) if errors else reason


def split_dead_letters(
    df: DataFrame, max_bytes: int = MAX_BYTES, prefix: str = DEAD_LETTER_PREFIX, errors: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Publishable events, and dead letters with ``reason`` and their dead-letter address."""
    kind = "change_type" if "change_type" in df.columns else None
    marked = df.withColumn("reason", dead_letter_reason(max_bytes, errors, kind))
    dead = marked.filter("reason is not null").withColumn(
        "subject", F.lower(F.concat_ws(".", F.lit(prefix), F.coalesce("subject", F.lit(""))))
    )
    return marked.filter("reason is null").drop("reason"), dead


def write_outcomes(
    df: DataFrame, path: str, max_bytes: int = MAX_BYTES, prefix: str = DEAD_LETTER_PREFIX, errors: str | None = None, run: int | str = 0
) -> dict[str, int]:
    """Publishable events and dead letters in one pass, in folders by ``outcome`` below that of a run, which a repeated run replaces.

    Returns how many rows were published and dead-lettered, and ``retried``: those of a run whose folder was there before. The numbers are taken
    while the rows are written, so the plan runs once.
    """
    spark, kind = df.sparkSession, "change_type" if "change_type" in df.columns else None
    again = exists(spark, f"{path}/run={run}")
    marked = df.withColumn("reason", dead_letter_reason(max_bytes, errors, kind))
    dead = F.col("reason").isNotNull()
    marked = marked.withColumns({
        "outcome": F.when(dead, "dead_lettered").otherwise("published"),
        "subject": F.when(dead, F.lower(F.concat_ws(".", F.lit(prefix), F.coalesce("subject", F.lit(""))))).otherwise(F.col("subject")),
    })
    counted = Observation()
    rows = marked.observe(counted, F.count_if(~dead).alias("published"), F.count_if(dead).alias("dead_lettered"))
    rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/run={run}")
    out = {n: int(v) for n, v in counted.get.items()}
    return out | {"retried": out["published"] if again else 0}


def retain(df: DataFrame, now: datetime, max_age: timedelta = timedelta(days=1), ts: str = "detected_at") -> DataFrame:
    """Events detected within ``max_age``; an event without that time is kept."""
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= moment(now - max_age, df.schema[ts].dataType)))


def expired_days(spark: SparkSession, path: str, now: datetime, max_age: timedelta = timedelta(days=1)) -> list[str]:
    """Day folders of the event log that lie wholly before the retention limit."""
    limit = (now - max_age).date().isoformat()
    top = [d for d in children(spark, path) if "=" in d]
    runs = [f"{r}/{d}" for r in top if r.startswith("run=") for d in children(spark, f"{path}/{r}") if "=" in d]
    drivers = [d for d in top if not d.startswith("run=")] + runs
    days = [(d, day) for d in drivers for day in children(spark, f"{path}/{d}")]
    return sorted(f"{d}/{day}" for d, day in days if day.startswith("event_date=") and day[11:] < limit)


def drop_expired(spark: SparkSession, path: str, now: datetime, max_age: timedelta = timedelta(days=1)) -> list[str]:
    """Delete the day folders that ``expired_days`` names, and return them."""
    gone = expired_days(spark, path, now, max_age)
    for folder in gone:
        remove(spark, f"{path}/{folder}")
    return gone


def replay(
    spark: SparkSession, path: str, subject: str | None = None, since: int | Mapping[str, int] | None = None,
    driver: str | None = None, start: datetime | None = None, end: datetime | None = None, ts: str = "detected_at",
) -> DataFrame:
    """The retained log: of one driver, one subscription, a time range [start, end), after a sequence number.

    Driver and time range also prune folders. Numbers count per driver, so ``since`` is the number of
    ``driver``, or maps drivers to numbers; a driver that it does not name is replayed from its start.
    """
    log = spark.read.parquet(path)
    if driver is not None:
        log = log.filter(F.col("driver_id") == driver)
    for limit, after in ((start, True), (end, False)):
        if limit is not None:
            at, day = moment(limit, log.schema[ts].dataType), F.lit(limit.date())
            log = log.filter((F.col(ts) >= at) & (F.col("event_date") >= day) if after else (F.col(ts) < at) & (F.col("event_date") <= day))
    if isinstance(since, Mapping):
        for name, number in since.items():
            log = log.filter((F.col("driver_id") != name) | (F.col("seq") > number))
    elif since is not None:
        log = log.filter(F.col("seq") > since)
    return log if subject is None else log.filter(subject_matches("subject", subject))


def kind_code(change_type: str = "change_type") -> Column:
    """The change kind as a small integer in enumeration order."""
    code = F.lit(None).cast("smallint")
    for i, kind in enumerate(CHANGE_KINDS):
        code = F.when(F.col(change_type) == kind, F.lit(i).cast("smallint")).otherwise(code)
    return code


def new_rows(events: DataFrame, table: DataFrame, key: str = "event_id", order: Sequence[str] = ()) -> DataFrame:
    """Events whose id the table does not hold yet, one per id (the first in ``order``).

    Each task keeps its first row per id before anything is shuffled (a window group limit).
    """
    first = Window.partitionBy(key).orderBy(*(order or [c for c in events.columns if c != key]))
    one = events.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    return one.join(table.select(key), key, "left_anti").select(*events.columns)


def id_slots(key: str = "event_id", buckets: int = 16) -> dict[str, Column]:
    """Where an id is stored: the day of its time prefix (12 hex digits of milliseconds; none for other ids) and a bucket of its hash."""
    prefix = F.when(F.col(key).rlike("^[0-9a-f]{12}"), F.conv(F.substring(key, 1, 12), 16, 10).cast("bigint"))
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.expr("0") + F.floor(prefix / 86_400_000).cast("int")), "yyyy-MM-dd")
    return {"id_day": F.coalesce(day, F.lit("none")), "id_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")}


def stored_slots(table: DataFrame, slots: Sequence[tuple[str, int]], most: int = 1000) -> DataFrame:
    """The part of a table in the given (day, bucket) folders; by day alone when they are many."""
    by_day: dict[str, list[int]] = {}
    for day, bucket in slots:
        by_day.setdefault(day, []).append(bucket)
    wanted = F.col("id_day").isin(sorted(by_day))
    if len(by_day) <= most:
        exact = F.lit(False)
        for day, own in sorted(by_day.items()):
            exact = exact | ((F.col("id_day") == day) & F.col("id_bucket").isin(sorted(own)))
        wanted = exact
    return table.filter(wanted)


def append_if_absent(events: DataFrame, path: str, key: str = "event_id", order: Sequence[str] = (), buckets: int = 16) -> None:
    """Append the events a stored table lacks. Running it again with the same events adds nothing.

    The table is laid out by the day of an id's time prefix and by a bucket of its hash (``id_slots``), so an append opens only the folders that its own
    ids fall into; their names, days times buckets at most, are all that comes to the driver. The layout columns are the table's last two.
    """
    spark = events.sparkSession
    placed = events.withColumns(id_slots(key, buckets))
    rows = events.limit(0)
    if exists(spark, path):
        slots = [(r.id_day, r.id_bucket) for r in placed.select("id_day", "id_bucket").distinct().collect()]
        rows = stored_slots(spark.read.schema(placed.schema).parquet(path), slots)
    fresh = new_rows(placed, rows, key, [*order] or [c for c in events.columns if c != key])
    fresh.write.mode("append").partitionBy("id_day", "id_bucket").parquet(path)


def versions(spark: SparkSession, path: str, before: int | None = None, after: int | None = None) -> list[int]:
    """Completely written versions of a versioned table in (after, before), oldest first."""
    named = sorted(int(name[2:]) for name in children(spark, path) if name.startswith("v="))
    wanted = [v for v in named if (before is None or v < before) and (after is None or v > after)]
    return [v for v in wanted if exists(spark, f"{path}/v={v}/_SUCCESS")]


def newest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The newest complete version (older than ``before``), or None."""
    named = sorted((int(name[2:]) for name in children(spark, path) if name.startswith("v=")), reverse=True)
    for v in named:
        if (before is None or v < before) and exists(spark, f"{path}/v={v}/_SUCCESS"):
            return v
    return None


def read_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The rows of the newest complete version (older than ``before``), or None."""
    v = newest_version(spark, path, before)
    return None if v is None else spark.read.parquet(f"{path}/v={v}")


def write_version(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write a full new version. Readers see it only once it is complete; a failed write leaves the old."""
    if version is None:
        newest = newest_version(df.sparkSession, path)
        version = 0 if newest is None else newest + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version


def drop_versions(spark: SparkSession, path: str, before: int) -> None:
    """Delete the versions older than ``before``."""
    for name in children(spark, path):
        if name.startswith("v=") and int(name[2:]) < before:
            remove(spark, f"{path}/{name}")
