"""One bank over the analytics tables: every layer from RAW to facts, built on demand."""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.parsing import parse_datetime, text
from tallyward.operators.enrich import (
    enrich_account, enrich_customer, live_accounts, live_customers, live_transactions,
)
from tallyward.operators.features import features
from tallyward.operators.scd2 import scd2_history
from tallyward.operators.scoring import ModelId, label_scores, rule_score, split_streams
from tallyward.operators.velocity import hot_accounts, velocity
from tallyward.plans import dims as D
from tallyward.plans import facts as FT
from tallyward.plans import staging as ST
from tallyward.plans.warehouse import dimensions
from tallyward.sources import adapter as A
from tallyward.sources.cdc import filter_ops, parse_cdc
from tallyward.sources.sinks import stringify

V2_FROM = "2024-01-16"


class Bank:
    """Lazy frames; nothing runs until a caller acts on one of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.as_of, self.now = A.AS_OF, A.NOW
        self.raw = lru_cache(None)(lambda name: A.RAW[name](spark, sf_dir))
        self.stg = lru_cache(None)(self._stage)

    def table(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    def _stage(self, name: str, batch: str = A.BATCH) -> DataFrame:
        return ST.stage_batch(name, self.raw(name), batch, self.as_of)

    # ---- stream side -------------------------------------------------------------------
    @cached_property
    def cdc(self) -> DataFrame:
        return A.cdc_events(self.spark, self.sf_dir)

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_cdc(self.cdc)[0]

    @cached_property
    def accounts(self) -> DataFrame:
        return live_accounts(self.raw("account"))

    @cached_property
    def customers(self) -> DataFrame:
        return live_customers(self.raw("customer"))

    @cached_property
    def transactions(self) -> DataFrame:
        return live_transactions(filter_ops(self.parsed))

    @cached_property
    def moving(self) -> DataFrame:
        sent = self.raw("transaction").select(
            text("AccountNumber").alias("account_number"),
            parse_datetime("TransactionDate").alias("transaction_date"))
        return velocity(self.transactions, hot=hot_accounts(sent))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_customer(enrich_account(self.moving, self.accounts), self.customers)

    @cached_property
    def still(self) -> DataFrame:
        """Enriched rows without sliding figures, for the groups that need none."""
        return enrich_customer(enrich_account(self.transactions, self.accounts), self.customers)

    @cached_property
    def featured(self) -> DataFrame:
        return features(self.enriched, self.as_of)

    def _timed(self, featured: DataFrame) -> DataFrame:
        at = F.coalesce("transaction_date", F.lit(self.as_of).cast("timestamp"))
        return featured.withColumn("processing_timestamp", at + F.expr("INTERVAL 5 SECONDS"))

    @cached_property
    def timed(self) -> DataFrame:
        return self._timed(self.featured)

    @cached_property
    def scored_runs(self) -> DataFrame:
        """Scores; some transactions are scored a second time a minute later."""
        runs = F.expr("if(cast(substr(transaction_id, 2) as bigint) % 6 = 0, array(0, 1), array(0))")
        again = F.col("run").cast("double") * 0.05
        df = rule_score(self.timed).withColumn("run", F.explode(runs))
        df = df.withColumns({
            "raw_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("raw_score") + again)),
            "processing_timestamp": F.col("processing_timestamp")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.col("run")),
            "model_name": F.lit(ModelId().name),
            "model_version": F.when(
                F.coalesce("transaction_date", F.lit(self.as_of).cast("timestamp"))
                < F.lit(V2_FROM).cast("timestamp"), "v1").otherwise("v2"),
        })
        return label_scores(df)

    def _stored(self, df: DataFrame) -> DataFrame:
        return stringify(df).withColumns({"_LOAD_TS": F.lit(self.now), "_SOURCE_FILE": F.lit("stream")})

    def _raw_realtime(self, timed: DataFrame) -> DataFrame:
        return self._stored(split_streams(label_scores(rule_score(timed)), ModelId())[0])

    @cached_property
    def raw_realtime(self) -> DataFrame:
        return self._raw_realtime(self.timed)

    @cached_property
    def raw_detection(self) -> DataFrame:
        return self._stored(split_streams(self.scored_runs, ModelId())[1])

    @cached_property
    def stg_realtime(self) -> DataFrame:
        return ST.stage_realtime_transaction(self.raw_realtime)

    @cached_property
    def stg_detection(self) -> DataFrame:
        return ST.stage_realtime_detection(self.raw_detection)

    # ---- warehouse ---------------------------------------------------------------------
    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return dimensions(self.stg, self.as_of, self.now)

    @cached_property
    def model(self) -> DataFrame:
        return D.dim_fraud_model(self.stg_detection, None, self.now)

    @cached_property
    def dates(self) -> DataFrame:
        """From the first event to the end of the month of ``as_of`` or, if later, the day after the
        last event, when it may still be scored."""
        first, last = F.to_date(F.min("ts")), F.date_add(F.to_date(F.max("ts")), 1)
        month_end = F.last_day(F.lit(self.as_of).cast("date"))
        return D.dim_date(self.table("events").agg(
            first.alias("first_day"), F.greatest(last, F.min(month_end)).alias("last_day")))

    @cached_property
    def realtime_source(self) -> DataFrame:
        """The stream's rows for facts, which have none of the sliding figures."""
        timed = self._timed(features(self.still, self.as_of))
        return FT.realtime_source(ST.stage_realtime_transaction(self._raw_realtime(timed)))

    @cached_property
    def batch_source(self) -> DataFrame:
        return FT.batch_source(self.stg("transaction"), self.stg("account"))

    @cached_property
    def sources(self) -> DataFrame:
        return FT.union_sources(self.realtime_source, self.batch_source)

    @cached_property
    def fact_transaction(self) -> DataFrame:
        return FT.fact_transaction(self.sources, self.dims, self.now)

    def fact_with(self, *keys: str) -> DataFrame:
        """The transaction fact with these dimension keys only, for readers of few dimensions."""
        return FT.fact_transaction(self.sources, self.dims, self.now, keys=keys)

    @cached_property
    def fact_detection(self) -> DataFrame:
        links = self.fact_with("customer_key", "account_key")
        return FT.fact_fraud_detection(self.stg_detection, links, self.model, self.now)

    def fact_loan(self, as_of: str) -> DataFrame:
        return FT.fact_loan_snapshot(self.stg("loan"), self.dims["customer"], self.dims["branch"],
                                     as_of, self.now)

    @cached_property
    def fact_balance(self) -> DataFrame:
        return FT.fact_account_balance_snapshot(
            self.stg("account"), self.stg("transaction"), self.dims["customer"],
            self.dims["account"], self.as_of, self.now)

    @cached_property
    def decisions(self) -> DataFrame:
        return A.decisions(self.spark, self.sf_dir)

    @cached_property
    def alerts(self) -> DataFrame:
        return FT.fact_fraud_alert(self.fact_detection, self.decisions, self.dims["employee"], self.now)

    def labelled_with(self, *keys: str) -> DataFrame:
        return FT.label_writeback(self.fact_with(*keys), self.decisions, self.as_of, "ANALYST")

    @cached_property
    def fact_labelled(self) -> DataFrame:
        return self.labelled_with(*FT.FACT_KEYS)

    # ---- history -----------------------------------------------------------------------
    def snapshot(self, batch: str) -> DataFrame:
        day = {"B1": "2023-12-31", "B2": "2024-01-15"}[batch]
        return self.stg("customer", batch).withColumns({
            "snapshot_date": F.lit(day).cast("date"), "load_ts": F.lit(day)})

    @cached_property
    def customer_history(self) -> DataFrame:
        return scd2_history(self.snapshot("B1").unionByName(self.snapshot("B2")), "customer_id")

    @cached_property
    def daily_balance(self) -> DataFrame:
        """Closing balance per account and active day, in the shape of balance snapshots."""
        from pyspark.sql import Window

        t = self.stg("transaction").filter(
            F.col("transaction_date").isNotNull() & F.col("amount").isNotNull())
        net = t.groupBy("account_number", F.to_date("transaction_date").alias("d")).agg(
            F.sum("amount").alias("net"))
        w = Window.partitionBy("account_number").orderBy("d")
        moved = net.withColumn("moved", F.sum("net").over(w))
        a = self.stg("account").select("account_number", F.col("balance").alias("opening"))
        k = self.dims["account"].select("account_number", "account_key")
        return moved.join(a, "account_number").join(k, "account_number").select(
            "account_number", "account_key",
            F.date_format("d", "yyyyMMdd").cast("int").alias("snapshot_date_key"),
            (F.col("opening") + F.col("moved")).cast("decimal(18,2)").alias("balance"))
