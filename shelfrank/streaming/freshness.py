"""Keeping stored recommendations fresh: expiry, invalidation, volume triggers, running scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from shelfrank.config import CacheConfig, DecayConfig
from shelfrank.functions.scalars import age_in_months
from shelfrank.operators.interactions import completed
from shelfrank.session import fresh_path
from shelfrank.streaming.store import SumStore

DEFAULTS = CacheConfig()
# Keeps streaming state on the executors' disks, so it may outgrow their memory.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DISK_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


# ---- stored recommendations ------------------------------------------------------------------


def build_snapshot(
    recommended: DataFrame, generated_at: Column, model_version: int, cfg: CacheConfig = DEFAULTS
) -> DataFrame:
    """Recommendations with their birth, expiry and the model that made them."""
    lifetime = F.make_dt_interval(secs=F.lit(cfg.ttl_seconds).cast("decimal(18,6)"))
    return (
        recommended.withColumn("generated_at", generated_at)
        .withColumn("expires_at", F.col("generated_at") + lifetime)
        .withColumn("model_version", F.lit(model_version).cast("long"))
    )


def valid_rows(snapshot: DataFrame, as_of: dt.datetime, model_version: int) -> DataFrame:
    """Rows that have not expired and come from the current model."""
    now = F.lit(as_of.isoformat(sep=" ")).cast(snapshot.schema["expires_at"].dataType)
    return snapshot.where((F.col("expires_at") > now) & (F.col("model_version") == model_version))


def invalidating_events(sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """(user_id, event_ts) of purchases and reviews; carts do not invalidate."""
    return (
        completed(sales)
        .select(F.col("buyer_id").alias("user_id"), F.col("order_date").alias("event_ts"))
        .unionByName(
            reviews.select(F.col("buyer_id").alias("user_id"), F.col("snapshot_date").alias("event_ts"))
        )
    )


def stale_users(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """Users with an event after their stored list was made: (user_id, last_event)."""
    made = snapshot.groupBy("user_id").agg(F.min("generated_at").alias("generated_at"))
    last = events.groupBy("user_id").agg(F.max("event_ts").alias("last_event"))
    return (
        made.join(last, "user_id")
        .where(F.col("last_event") > F.col("generated_at"))
        .select("user_id", "last_event")
    )


# ---- streams ---------------------------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Event files as a stream; watermarks need TIMESTAMP, so the zone-less ``ts`` is cast."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def run_into(stream: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there, batch by batch, with state on the executors' disks."""
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, DISK_STATE_STORE)
    try:
        running = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", fresh_path(spark, f"{name}-progress"))
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
    running.awaitTermination()


def run_available(
    stream: DataFrame, name: str, per_batch: Callable[[DataFrame], DataFrame], mode: str = "append"
) -> DataFrame:
    """Process what is there and return the sink as (batch_id, ...).

    Each micro-batch overwrites its own folder, so a batch that is repeated after a failure replaces
    its rows and never doubles them.
    """
    spark = stream.sparkSession
    sink = fresh_path(spark, name)
    schema = per_batch(stream).schema
    spark.createDataFrame([], schema).write.parquet(f"{sink}/batch_id=-1")
    run_into(
        stream, name, lambda batch, n: per_batch(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={n}"), mode
    )
    return spark.read.schema(f"{schema_ddl(schema)}, batch_id BIGINT").parquet(sink)


def schema_ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def dedup(stream: DataFrame, key: str = "event_id", delay: str = "1 day") -> DataFrame:
    """Drop repeats of an event that arrive within ``delay``; state older than that is forgotten."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def deduplicated(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    return run_available(dedup(stream, delay=delay), "dedup", lambda b: b).drop("batch_id")


def daily_volume(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events per day, kept up to date batch by batch; the latest value of each day counts."""
    days = (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day"))
        .agg(F.count("*").alias("n_events"))
        .select(F.col("window.start").alias("day_start"), "n_events")
    )
    updates = run_available(days, "daily-volume", lambda b: b, "update")
    return updates.groupBy("day_start").agg(F.max_by("n_events", "batch_id").alias("n_events"))


def refresh_days(volume: DataFrame, threshold: int) -> DataFrame:
    """Days with enough new events to retrain."""
    return volume.where(F.col("n_events") >= threshold)


def changed_users(stream: DataFrame, event_types: tuple[str, ...] = ("purchase", "view")) -> DataFrame:
    """(user_id, last_event) of users whose stored list must be rebuilt, one row per user."""
    fresh = stream.where(F.col("event_type").isin(*event_types))

    def latest(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(F.max("ts").alias("last_event"))

    marks = run_available(fresh, "changed-users", latest)
    return marks.groupBy("user_id").agg(F.max("last_event").alias("last_event"))


def stale_marks(
    stream: DataFrame, lists: DataFrame, delay: str = "1 day", event_types: tuple[str, ...] = ("purchase", "view")
) -> DataFrame:
    """A stream of (user_id, generated_at): each stored list that an event makes stale, once.

    ``stream`` has event_id, ts, user_id, event_type; ``lists`` is a stored snapshot with generated_at and expires_at, of
    which each batch joins the users' newest list. An event counts if it happened after the list was made and before it
    expires, however late within ``delay`` and however often it comes. The state of a list is one mark, forgotten when the
    watermark has passed its expiry, so it is bounded by the lists that are alive.
    """
    made = lists.groupBy("user_id").agg(F.max(F.struct("generated_at", "expires_at")).alias("list"))
    made = made.select("user_id", *[F.col(f"list.{c}").cast("timestamp").alias(c) for c in ("generated_at", "expires_at")])
    hit = (
        stream.withWatermark("ts", delay)
        .where(F.col("event_type").isin(*event_types))
        .join(made, "user_id")
        .where((F.col("ts") > F.col("generated_at")) & (F.col("ts") < F.col("expires_at")))
        .select("user_id", "generated_at", "expires_at", "ts")
    )
    return hit.groupBy("user_id", "generated_at").applyInPandasWithState(
        _mark_once, "user_id bigint, generated_at timestamp", "marked boolean", "append", "EventTimeTimeout"
    )


def _mark_once(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The key the first time that it has rows; its mark goes when no row of it can come any more."""
    if state.hasTimedOut:
        state.remove()
        return
    until = max(batch["expires_at"].max() for batch in rows)
    if not state.exists:
        state.update((True,))
        yield pd.DataFrame({"user_id": [key[0]], "generated_at": [key[1]]})
    # rows before the watermark are dropped, and none behind the expiry counts
    state.setTimeoutTimestamp(max(int(until.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))


def stale_lists(stream: DataFrame, lists: DataFrame, delay: str = "1 day") -> DataFrame:
    """(user_id, generated_at, n_marks) of what is there: every stale list with the number of times it was marked."""
    marks = run_available(stale_marks(stream, lists, delay), "stale-lists", lambda b: b)
    return marks.groupBy("user_id", "generated_at").agg(F.count("*").alias("n_marks"))


def forward_sums(
    scored: DataFrame, cfg: DecayConfig = DecayConfig(), origin: dt.date = DEFAULTS.decay_origin
) -> DataFrame:
    """Per (user, book, event day) sum of base x exp(rate x months since ``origin``): only ever added to."""
    since = F.datediff(F.col("event_ts"), F.lit(origin)).cast("double") / cfg.days_per_month
    grown = F.col("base_score") * F.exp(F.lit(cfg.lambda_rate) * since)
    day = F.to_date("event_ts").alias("event_day")
    return scored.groupBy("user_id", "book_id", day).agg(F.sum(grown).alias("forward_sum"))


def read_forward(
    sums: DataFrame,
    as_of: dt.date,
    cfg: DecayConfig = DecayConfig(),
    origin: dt.date = DEFAULTS.decay_origin,
) -> DataFrame:
    """Interaction scores at ``as_of`` from partial forward sums of any number of batches.

    Events after that day are left out, as in a batch run.
    """
    shrink = F.exp(F.lit(-cfg.lambda_rate) * age_in_months(F.lit(origin), F.lit(as_of), cfg.days_per_month))
    return sums.where(F.col("event_day") <= F.lit(as_of)).groupBy("user_id", "book_id").agg(
        (F.sum("forward_sum") * shrink).alias("interaction_score")
    )


def running_scores(
    streams: Sequence[DataFrame], as_of: dt.date, cfg: DecayConfig = DecayConfig()
) -> DataFrame:
    """Decayed scores from streams of (user_id, book_id, event_ts, base_score) rows.

    A batch adds its partial sums to a store that merges them level by level and keeps no state; reading adds few runs up,
    because decay to a later day is one common factor.
    """
    parts = []
    for stream in streams:
        store = forward_store(stream.sparkSession, fresh_path(stream.sparkSession, "forward-sums"))
        run_into(stream, "forward-decay", lambda batch, n, store=store: store.add(forward_sums(batch, cfg), n))
        found = store.read()
        parts += [found] if found is not None else []
    if not parts:
        return read_forward(forward_sums(streams[0].sparkSession.createDataFrame([], streams[0].schema), cfg), as_of, cfg)
    return read_forward(reduce(DataFrame.unionByName, parts), as_of, cfg)


def forward_store(spark: SparkSession, root: str) -> SumStore:
    """Partial forward sums per user, book and event day."""
    return SumStore(spark, root, ["user_id", "book_id", "event_day"], "forward_sum")


def scored_events(stream: DataFrame, cfg: DecayConfig = DecayConfig()) -> DataFrame:
    """Click and view events as scored cart and review events."""
    stars = F.lit(5) - F.least(F.floor(F.col("value") / 30), F.lit(4).cast("long"))
    base = F.when(F.col("event_type") == "click", F.lit(cfg.cart_score)).when(
        (F.col("event_type") == "view") & (stars >= cfg.review_threshold), F.lit(cfg.review_score)
    )
    return stream.select(
        "user_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("book_id"),
        F.col("ts").alias("event_ts"),
        base.alias("base_score"),
    ).where(F.col("base_score") > 0)
