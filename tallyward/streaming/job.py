"""The streaming job: change events to scored transactions in the lake.

start() takes the sliding figures from keyed state (``keyed.py``): no micro-batch reads or lists what
was stored before it. Repeats of a message within their time to live are dropped there, late rows are
flagged and kept. The state knows a transaction by account and id: an update that names another account
leaves the earlier one in that account's ring. A checkpoint made without this state can't be continued;
start a new one, under a new ``run``.

process_batch() also takes messages without figures, such as a backfill or the repair of one
micro-batch. It then measures them, with the batch operator, together with the last 24 hours of stored
rows of their accounts. Either way a late row is right for itself and flagged; rows written before it
keep their figures.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.parsing import is_blank, number, parse_datetime
from tallyward.ml.training import score
from tallyward.operators.dedup import latest_per_key
from tallyward.operators.enrich import enrich_account, enrich_customer, live_transactions
from tallyward.operators.features import DEFAULTS, Thresholds, features
from tallyward.operators.scoring import DEFAULT_THRESHOLD, ModelId, split_streams
from tallyward.operators.velocity import FIGURES, HOT_ROWS, velocity_of_batch
from tallyward.schemas import RAW_LOCATIONS, RAW_SCHEMAS
from tallyward.sources.cdc import filter_ops, parse_cdc
from tallyward.sources.raw import load_raw
from tallyward.sources.sinks import _exists, stringify, write_lake
from tallyward.streaming.keyed import keyed_figures, with_state_store

LATE_AFTER = timedelta(minutes=10)
CLOCK_SKEW = timedelta(days=2)
MEASURED = (*FIGURES, "is_late")  # what keyed state adds to a message
CONSOLE = ("TransactionID", "fraud_score", "risk_indication", "action_taken", "fraud_type")  # printed columns
Loader = Callable[[], DataFrame]


@dataclass
class StreamConfig:
    """Where the job writes and how it scores. ``accounts`` and ``customers`` are called for
    every micro-batch, so lookups follow the newest snapshot."""

    lake: str
    accounts: Loader
    customers: Loader
    model: object = None
    model_id: ModelId = field(default_factory=ModelId)
    threshold: float = DEFAULT_THRESHOLD
    thresholds: Thresholds = DEFAULTS
    hot_rows: int = HOT_ROWS
    ring: dict = field(default_factory=dict)  # limits of the keyed state other than its own
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)
    console: int = 0  # detections of a micro-batch that are also printed
    run: str = "0"  # one name for each checkpoint: micro-batches are numbered within it

    @property
    def transactions(self) -> str:
        return f"{self.lake}/{RAW_LOCATIONS['realtime_transaction']}"

    @property
    def detections(self) -> str:
        return f"{self.lake}/{RAW_LOCATIONS['realtime_fraud_detection']}"

    @property
    def quarantine(self) -> str:
        return f"{self.lake}/realtime/quarantine"


def drop_replays(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop exact repeats of a message that arrive within the watermark delay.

    Only for sources whose rows are never later than that: a watermark drops what comes after it,
    so start() does without."""
    at = F.coalesce(parse_datetime(F.get_json_object("value", "$.TransactionDate")),
                    F.lit("1970-01-01").cast("timestamp"))
    keyed = stream.withColumn("event_time", at)
    return (keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["value"])
            .drop("event_time"))


def stored_history(spark: SparkSession, path: str, batch_id: int, run: str = "0") -> DataFrame | None:
    """Stored rows of other micro-batches; a replayed batch never sees its own output."""
    if not _exists(spark, path):
        return None
    stored = T.StructType([*RAW_SCHEMAS["realtime_transaction"].fields,
                           T.StructField("dt", T.DateType()), T.StructField("run", T.StringType()),
                           T.StructField("mb", T.LongType())])
    own = (F.col("run") == run) & (F.col("mb") == batch_id)
    return spark.read.schema(stored).parquet(path).filter(~own)


def _typed_history(rows: DataFrame, first_day) -> DataFrame:
    """What the sliding figures need, and when a row was scored: its version.

    Folders are named by write date. A row may be written up to CLOCK_SKEW before its own event
    time (a source's clock that is ahead), so as many more days are read.
    """
    if first_day is not None:
        rows = rows.filter(F.col("dt") >= F.lit(first_day - CLOCK_SKEW))
    return rows.select(
        F.struct(parse_datetime("processing_timestamp"), "mb").alias("version"),
        F.col("TransactionID").alias("transaction_id"),
        F.col("AccountNumber").alias("account_number"),
        parse_datetime("TransactionDate").alias("transaction_date"),
        number("Amount").alias("amount"),
    )


def score_events(events: DataFrame, history: DataFrame | None, config: StreamConfig,
                 processing_ts: str) -> DataFrame:
    """Typed, enriched, measured and scored rows of parsed change events.

    Several events of one transaction collapse to the latest. Events that have the columns MEASURED
    keep them; others are measured together with ``history``.
    """
    measured = set(MEASURED) <= set(events.columns)
    txn = live_transactions(filter_ops(events), MEASURED if measured else ())
    txn = latest_per_key(txn, "transaction_id", [F.col("transaction_date").desc_nulls_last()])
    if measured:
        moving = txn
    else:
        if history is None:
            history = txn.limit(0).select("transaction_id", "account_number", "transaction_date", "amount")
        moving = velocity_of_batch(txn, history, hot_rows=config.hot_rows)
    rich = enrich_customer(enrich_account(moving, config.accounts()), config.customers())
    full = features(rich, processing_ts[:10], config.thresholds)
    full = full.withColumn("processing_timestamp", F.lit(processing_ts).cast("timestamp"))
    return score(full, config.model, config.threshold)


def batch_stamp(spark: SparkSession, config: StreamConfig, batch_id: int) -> str:
    """When the micro-batch was first tried. A replay gets the same time, so the same folders."""
    path = f"{config.lake}/realtime/stamps/run={config.run}/mb={batch_id}"
    if _exists(spark, f"{path}/_SUCCESS"):
        return spark.read.text(path).first()[0]
    stamp = config.clock().strftime("%Y-%m-%d %H:%M:%S")
    spark.createDataFrame([(stamp,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return stamp


def _with_late(scored: DataFrame, history: DataFrame | None, newest) -> DataFrame:
    """Flag the rows more than LATE_AFTER behind the newest of ``newest`` and the history."""
    seen = newest
    if history is not None:
        stored = history.agg(F.max("transaction_date")).first()[0]
        seen = max([t for t in (seen, stored) if t is not None], default=None)
    if seen is None:
        return scored.withColumn("is_late", F.lit(False))
    return scored.withColumn("is_late", F.coalesce(F.col("transaction_date") < F.lit(seen - LATE_AFTER), F.lit(False)))


def _measured_here(good: DataFrame, batch_id: int, config: StreamConfig, stamp: str) -> DataFrame:
    """Scored rows of messages without figures, which take them from stored rows."""
    spark = good.sparkSession
    at = parse_datetime("TransactionDate")
    span = good.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    history = stored_history(spark, config.transactions, batch_id, config.run)
    if history is not None:
        first_day = (span["first"] - timedelta(days=1)).date() if span["first"] else None
        history = _typed_history(history, first_day)
    return _with_late(score_events(good, history, config, stamp), history, span["last"])


def process_batch(batch: DataFrame, batch_id: int, config: StreamConfig) -> None:
    """One micro-batch: both outputs go to folders named after it, so a replay overwrites. With
    ``config.console`` some detections are printed besides."""
    started = monotonic()
    measured = set(MEASURED) <= set(batch.columns)
    batch = batch.persist()
    try:
        if measured and batch.isEmpty():  # only timers or repeats
            return
        stamp = batch_stamp(batch.sparkSession, config, batch_id)
        good, bad = parse_cdc(batch, carry=MEASURED if measured else ())
        nameless = is_blank("TransactionID")  # no id: nothing to merge or score it by
        fields = [c for c in good.columns if c not in MEASURED]
        bad = bad.unionByName(good.filter(nameless).select(F.to_json(F.struct(*fields)).alias("value")))
        good = good.filter(~nameless)
        write_lake(bad, config.quarantine, stamp, batch_id, config.run)
        scored = score_events(good, None, config, stamp) if measured else _measured_here(good, batch_id, config, stamp)
        scored = scored.persist()
        n = scored.count()
        latency = (monotonic() - started) * 1000.0 / max(n, 1)
        scored_ms = scored.withColumn("inference_latency_ms", F.lit(round(latency, 3)))
        transactions, detections = split_streams(scored_ms, config.model_id)
        write_lake(stringify(transactions), config.transactions, stamp, batch_id, config.run)
        write_lake(stringify(detections), config.detections, stamp, batch_id, config.run)
        if config.console:
            print(f"micro-batch {batch_id} of run {config.run}: {n} rows")
            detections.select(*CONSOLE).show(config.console, truncate=False)
        scored.unpersist()
    finally:
        batch.unpersist()


def start(stream: DataFrame, config: StreamConfig, checkpoint: str, trigger: dict | None = None):
    """Start the job. ``trigger`` holds writer trigger arguments, such as
    ``{"processingTime": "60 seconds"}`` (default) or ``{"availableNow": True}``."""
    until_done = bool((trigger or {}).get("availableNow") or (trigger or {}).get("once"))
    return (
        with_state_store(stream.sparkSession, keyed_figures(stream, **config.ring).writeStream, until_done)
        .foreachBatch(lambda df, batch_id: process_batch(df, batch_id, config))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def read_realtime(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """Stored stream output as its RAW table."""
    return load_raw(spark, f"{lake}/{RAW_LOCATIONS[name]}", RAW_SCHEMAS[name])
