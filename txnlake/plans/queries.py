"""Every registered query, over a lake built from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.distinct import distinct_keys, key_bits
from txnlake.functions.keys import dense_keys
from txnlake.functions.lookup import lookup
from txnlake.functions.money import cents, cents_average, money_sum, percent, rate
from txnlake.functions.parse import hours_before, iso_text, parse_amount, parse_date, with_timestamp
from txnlake.functions.quantiles import quantiles, unpivoted
from txnlake.functions.text import fixed_text, stripped
from txnlake.operators import bronze, controls, gold, history, quality, silver
from txnlake.plans import marts, reconciliation, reports
from txnlake.plans.run import run_batch
from txnlake.plans.workspace import lake_for
from txnlake.risk import calibrate, drift, explain, features, gates, iforest, scoring, stored
from txnlake.session import apply_settings
from txnlake.sources import feeds
from txnlake.sources.defects import inject_defects
from txnlake.sources.files import read_csv, validate_schema
from txnlake.sources.lake import Lake, first_by_key

RUN_AT = feeds.AS_OF.isoformat()
ROUGH_CONFIG = Config(max_amount=300)


@dataclass(frozen=True)
class Context:
    """Frames the queries start from."""

    spark: SparkSession
    folder: str

    @cached_property
    def lake(self) -> Lake:
        return lake_for(self.spark, self.folder)

    @cached_property
    def cfg(self) -> Config:
        return Config()

    @property
    def raw(self) -> DataFrame:
        return self.lake.read("bronze.raw_transactions")

    @property
    def silver(self) -> DataFrame:
        return self.lake.transactions()

    @property
    def fact(self) -> DataFrame:
        return self.lake.fact()

    @property
    def customers(self) -> DataFrame:
        return self.lake.read("gold.dim_customer")

    @property
    def merchants(self) -> DataFrame:
        return self.lake.read("gold.dim_merchant")

    @property
    def methods(self) -> DataFrame:
        return self.lake.read("gold.dim_payment_method")

    @property
    def dates(self) -> DataFrame:
        return self.lake.read("gold.dim_date")

    def staged(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame written once per lake."""
        key = (self.lake.root, name)
        if key not in _staged:
            _staged[key] = self.lake.stage(make(), name)
        return _staged[key]

    @property
    def features(self) -> DataFrame:
        return self.staged("query_features", lambda: features.extract_features(self.lake))

    @property
    def first_features(self) -> DataFrame:
        return self.staged("query_first_features", lambda: features.extract_features(
            self.lake, self.lake.transactions(feeds.BATCHES[0]), "first"))

    @property
    def calibrated(self) -> DataFrame:
        """Features with a score from plain arithmetic, calibrated like a forest's."""
        score = -(F.col("amount_ratio") / (F.col("amount_ratio") + 10.0))
        return self.staged("query_calibrated", lambda: calibrate.calibrate(
            self.features.withColumn("anomaly_score", score)))

    @property
    def profile(self) -> DataFrame:
        """Drift profile of the first batch."""
        key = (self.lake.root, "profile")
        if key not in _staged:
            _staged[key] = drift.build_reference(self.lake, self.first_features, "query")
        return _staged[key]

    @property
    def customer_bits(self) -> DataFrame:
        """Customers of each date and country as bitmaps over their surrogate keys, stored."""
        return self.staged("query_customer_bits", lambda: key_bits(self.fact, "customer_sk", ["date_sk", "country"]))

    @property
    def rough(self) -> DataFrame:
        """The feed as one batch with blank ids, unknown methods and untidy codes, annotated."""
        return self.staged("query_rough", lambda: annotate_rough(self))

    @property
    def typed_raw(self) -> DataFrame:
        """Raw rows with typed amount and time, before any row is rejected."""
        return with_timestamp(self.raw.withColumn("amount", parse_amount(F.col("amount"))),
                              "timestamp", "ts", "_east").drop("_east", "timestamp")


_staged: dict[tuple[str, str], DataFrame] = {}
QUERIES: dict[str, Callable[[Context], DataFrame]] = {}


def query(make: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    QUERIES[make.__name__] = make
    return make


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    apply_settings(spark)
    return QUERIES[name](Context(spark, folder))


def rough_transactions(spark: SparkSession, folder: str) -> DataFrame:
    seq = F.col("_row_seq")
    feed = feeds.transactions(spark, folder)
    wrap = lambda before, c, after: F.concat(F.lit(before), c, F.lit(after))
    return feed.withColumns({
        "transaction_id": F.when(seq % 97 == 5, "\t ").otherwise(F.col("transaction_id")),
        "payment_method": F.when(seq % 89 == 7, "cheque")
        .when(seq % 83 == 11, wrap("\t", F.upper("payment_method"), "\n"))
        .otherwise(F.col("payment_method")),
        "country": F.when(seq % 7 == 1, wrap("\t", F.lower("country"), " "))
        .otherwise(F.col("country")),
        "channel": F.when(seq % 5 == 2, wrap(" ", F.upper("channel"), ""))
        .otherwise(F.col("channel")),
        "batch_id": F.lit("B0"),
    })


def annotate_rough(c: Context) -> DataFrame:
    raw = c.staged("query_rough_raw", lambda: bronze.stamp(
        rough_transactions(c.spark, c.folder), "transactions", "B0", feeds.AS_OF))
    repeated = c.staged("query_rough_repeated", lambda: silver.repeated_ids(raw))
    annotated = silver.annotate(
        raw, repeated, c.lake.entity_ids("customers"), c.lake.entity_ids("merchants"),
        ROUGH_CONFIG, feeds.AS_OF)
    return annotated.withColumns({
        f"reason_{name}": F.expr(reason)
        for name, reason in silver.rule_reasons(ROUGH_CONFIG, feeds.AS_OF).items()})


# ---------------------------------------------------------------------------
# Silver, quarantine and the star schema
# ---------------------------------------------------------------------------

@query
def silver_transactions(c: Context) -> DataFrame:
    return c.silver.drop("_loaded_at")


@query
def quarantine(c: Context) -> DataFrame:
    return c.lake.quarantine().drop("_quarantined_at")


@query
def silver_customers(c: Context) -> DataFrame:
    return c.lake.customers().drop("_loaded_at")


@query
def silver_merchants(c: Context) -> DataFrame:
    return c.lake.merchants().drop("_loaded_at")


@query
def dim_date(c: Context) -> DataFrame:
    return c.dates


@query
def dim_customer(c: Context) -> DataFrame:
    return c.customers


@query
def dim_merchant(c: Context) -> DataFrame:
    return c.merchants


@query
def dim_payment_method(c: Context) -> DataFrame:
    return c.methods


@query
def fact_transactions(c: Context) -> DataFrame:
    return c.fact


@query
def layer_counts(c: Context) -> DataFrame:
    """Rows of each table of the three layers."""
    tables = {
        "bronze.raw_transactions": c.raw,
        "silver.transactions": c.silver,
        "silver.quarantine": c.lake.quarantine(),
        "gold.dim_customer": c.customers,
        "gold.dim_merchant": c.merchants,
        "gold.dim_payment_method": c.methods,
        "gold.dim_date": c.dates,
        "gold.fact_transactions": c.fact,
    }
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"),
                                                             "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# Named reports
# ---------------------------------------------------------------------------

@query
def a01_daily_volume(c: Context) -> DataFrame:
    return reports.daily_volume(c.fact, c.dates)


@query
def a02_status_mix(c: Context) -> DataFrame:
    return reports.status_mix(c.fact)


@query
def a03_method_failures(c: Context) -> DataFrame:
    return reports.method_failures(c.fact, c.methods)


@query
def a04_top_merchants_value(c: Context) -> DataFrame:
    return reports.top_merchants_by_value(c.fact, c.merchants)


@query
def a05_top_merchants_failure(c: Context) -> DataFrame:
    return reports.top_merchants_by_failure(c.fact, c.merchants)


@query
def a06_country_volume(c: Context) -> DataFrame:
    return reports.country_volume(c.fact)


@query
def a07_country_failures(c: Context) -> DataFrame:
    return reports.country_failures(c.fact)


@query
def a08_method_mix(c: Context) -> DataFrame:
    return reports.method_mix_by_country(c.fact, c.methods)


@query
def a09_segment_spend(c: Context) -> DataFrame:
    return reports.segment_spend(c.fact, c.customers)


@query
def a10_hourly(c: Context) -> DataFrame:
    return reports.hourly_volume(c.fact)


@query
def r_layer_counts(c: Context) -> DataFrame:
    return reconciliation.layer_record_counts(c.lake, feeds.BATCHES[0])


@query
def r4_reconciliation(c: Context) -> DataFrame:
    return reconciliation.reconciliation(c.lake, feeds.BATCHES[0])


@query
def r5_rejection_reasons(c: Context) -> DataFrame:
    return reconciliation.top_rejections(c.lake.quarantine(feeds.BATCHES[0]))


@query
def v1_daily_kpis(c: Context) -> DataFrame:
    return reports.daily_kpis(c.fact, c.dates)


@query
def v2_merchant_performance(c: Context) -> DataFrame:
    return reports.merchant_performance(c.fact, c.merchants)


# ---------------------------------------------------------------------------
# Models, marts and their tests
# ---------------------------------------------------------------------------

@query
def stg_customers(c: Context) -> DataFrame:
    return marts.stg_customers(c.lake.customers())


@query
def stg_merchants(c: Context) -> DataFrame:
    return marts.stg_merchants(c.lake.merchants())


@query
def stg_transactions(c: Context) -> DataFrame:
    return marts.stg_transactions(c.silver).drop("_loaded_at")


@query
def int_customer_metrics(c: Context) -> DataFrame:
    return marts.models(c.lake)["int_customer_metrics"]


@query
def int_merchant_metrics(c: Context) -> DataFrame:
    return marts.models(c.lake)["int_merchant_metrics"]


@query
def int_transaction_metrics(c: Context) -> DataFrame:
    return marts.models(c.lake)["int_transaction_metrics"]


@query
def mart_fct_transactions(c: Context) -> DataFrame:
    return marts.materialise(c.lake, ("fct_transactions",))["fct_transactions"]


@query
def mart_payment_daily(c: Context) -> DataFrame:
    return marts.materialise(c.lake, ("payment_daily_metrics",))["payment_daily_metrics"]


@query
def test_not_null(c: Context) -> DataFrame:
    """Violations of all eleven not-null tests."""
    models = marts.models(c.lake)
    parts = [marts.not_null_violations(models[name], name, columns)
             for name, columns in marts.NOT_NULL.items()]
    return parts[0].unionByName(parts[1])


@query
def test_unique(c: Context) -> DataFrame:
    models = marts.models(c.lake)
    parts = [marts.unique_violations(models[name], name, columns[0])
             for name, columns in marts.UNIQUE.items()]
    return parts[0].unionByName(parts[1])


@query
def test_status_reconcile(c: Context) -> DataFrame:
    """Days tested and days whose status counts do not add up."""
    daily = marts.models(c.lake)["int_transaction_metrics"]
    return daily.agg(F.count("*").alias("days")).withColumn(
        "violations", marts.unreconciled_days(daily).agg(F.count("*")).scalar())


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def _checked(c: Context, checks: list[quality.Check], raw: bool = False) -> DataFrame:
    df, name = (c.typed_raw, "bronze.raw_transactions") if raw else (c.silver, "silver.transactions")
    return quality.run_checks(df, name, checks, RUN_AT)


def _raw_checks(c: Context) -> list[quality.Check]:
    """The standard checks; the volume baseline is the raw row count."""
    rows = c.raw.agg(F.count("*")).scalar()
    return quality.standard_checks(c.lake, c.cfg, rows, feeds.AS_OF)


@query
def dq_not_null(c: Context) -> DataFrame:
    return _checked(c, [quality.not_null(col, 0.01, 0.05) for col in (
        "transaction_id", "customer_id", "merchant_id", "amount", "ts")], raw=True)


@query
def dq_unique(c: Context) -> DataFrame:
    return _checked(c, [quality.uniqueness("transaction_id")], raw=True)


@query
def dq_domain(c: Context) -> DataFrame:
    return _checked(c, [
        quality.valid_values("status", c.cfg.statuses, 0.01, 0.05),
        quality.valid_values("currency", c.cfg.currencies, 0.01, 0.05),
        quality.valid_values("payment_method", c.cfg.payment_methods, 0.01, 0.05)], raw=True)


@query
def dq_amount(c: Context) -> DataFrame:
    return _checked(c, [quality.amount_positive(0.01, 0.05)], raw=True)


@query
def dq_referential(c: Context) -> DataFrame:
    return _checked(c, [
        quality.referential_integrity(
            "bronze.raw_transactions", f"{one}_id", c.lake.entity_ids(f"{one}s"),
            f"silver.{one}s", f"{one}_id", 0.01, 0.05) for one in ("customer", "merchant")], raw=True)


@query
def dq_freshness(c: Context) -> DataFrame:
    """Within the agreed hours at the fixed clock, and stale with an agreement of no hours."""
    return _checked(c, [quality.freshness("ts", 24, feeds.AS_OF)]).unionByName(
        _checked(c, [quality.freshness("ts", 0, feeds.AS_OF)]))


@query
def dq_volume(c: Context) -> DataFrame:
    """Against the raw row count, and against twice as many rows."""
    rows = c.raw.agg(F.count("*")).scalar()
    return _checked(c, [quality.volume(quality.expected_volume(n, c.cfg), 0.30)
                        for n in (rows, rows * 2)])


@query
def dq_report(c: Context) -> DataFrame:
    return _checked(c, _raw_checks(c))


@query
def dq_report_raw(c: Context) -> DataFrame:
    """The same fourteen checks before any row was rejected."""
    return _checked(c, _raw_checks(c), raw=True)


@query
def dq_score(c: Context) -> DataFrame:
    """Scores of Silver and of the raw rows."""
    parts = [quality.quality_score(_checked(c, _raw_checks(c), raw)).withColumn(
        "layer", F.lit("bronze" if raw else "silver")) for raw in (False, True)]
    return parts[0].unionByName(parts[1])


@query
def dup_lineitem(c: Context) -> DataFrame:
    """Uniqueness over a table with real duplicates of (order, line)."""
    items = c.spark.read.parquet(f"{c.folder}/lineitem.parquet").withColumn(
        "line_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return quality.run_checks(items, "lineitem", [quality.uniqueness("line_id")], RUN_AT)


# ---------------------------------------------------------------------------
# Controls
# ---------------------------------------------------------------------------

def _fact_control(c: Context, control: str) -> DataFrame:
    return controls.fact_controls(c.fact, c.cfg, RUN_AT).filter(F.col("control_id") == control)


@query
def ctl_01(c: Context) -> DataFrame:
    return _fact_control(c, "CTL-01")


@query
def ctl_02(c: Context) -> DataFrame:
    return _fact_control(c, "CTL-02")


@query
def ctl_03(c: Context) -> DataFrame:
    """With the usual ceiling, and with one that some amounts exceed."""
    strict = controls.fact_controls(c.fact, Config(max_amount=200), RUN_AT)
    return _fact_control(c, "CTL-03").unionByName(strict.filter("control_id = 'CTL-03'"))


@query
def ctl_04(c: Context) -> DataFrame:
    """With the usual statuses, and with a set that lacks one."""
    strict = controls.fact_controls(c.fact, Config(statuses=c.cfg.statuses[:-1]), RUN_AT)
    return _fact_control(c, "CTL-04").unionByName(strict.filter("control_id = 'CTL-04'"))


@query
def ctl_05(c: Context) -> DataFrame:
    """Fresh at the fixed clock, and stale with an agreement of no hours."""
    return controls.freshness_control(c.silver, 24, feeds.AS_OF, RUN_AT).unionByName(
        controls.freshness_control(c.silver, 0, feeds.AS_OF, RUN_AT))


@query
def ctl_06(c: Context) -> DataFrame:
    """The columns that the stored files have."""
    tables = {table: c.lake.as_stored(table) for table in schemas.CONTROLLED_GOLD}
    return controls.schema_control(tables, RUN_AT)


@query
def ctl_07(c: Context) -> DataFrame:
    """One row per batch."""
    return controls.reconciliation_control(
        reconciliation.reconcile(reconciliation.batch_counts(c.lake)), RUN_AT)


@query
def ctl_report(c: Context) -> DataFrame:
    return controls.control_report(c.lake, feeds.BATCHES[1], c.cfg, feeds.AS_OF)


@query
def ctl_overall(c: Context) -> DataFrame:
    return controls.overall(controls.control_report(c.lake, feeds.BATCHES[1], c.cfg, feeds.AS_OF))


# ---------------------------------------------------------------------------
# Risk, drift and gates
# ---------------------------------------------------------------------------

@query
def risk_features(c: Context) -> DataFrame:
    return c.features


@query
def risk_model_inputs(c: Context) -> DataFrame:
    return features.model_inputs(c.features).select("transaction_id", *features.MODEL_INPUTS)


@query
def risk_calibrated(c: Context) -> DataFrame:
    return c.calibrated.select("transaction_id", "anomaly_score", "risk_score", "risk_tier")


@query
def risk_explained(c: Context) -> DataFrame:
    return explain.add_explanations(c.calibrated).select(
        "transaction_id", "risk_tier", "risk_reasons")


@query
def psi_drift(c: Context) -> DataFrame:
    """The first batch as reference against all batches."""
    return drift.monitor(c.features, c.profile)


def _features_of(c: Context, batch: str) -> DataFrame:
    """Features of one batch, by the profiles of all batches."""
    return c.staged(f"query_features_{batch}", lambda: features.extract_features(
        c.lake, scope=batch, rows=c.lake.transactions(batch)))


def _first_model(c: Context) -> Lake:
    """The lake with a version of the model fitted on the first batch; both batches are counted against it."""
    def make() -> DataFrame:
        model = feeds.BATCHES[0]
        stored.fit_model(c.lake, model, c.first_features, fitted_at=feeds.AS_OF)
        for batch in feeds.BATCHES:
            stored.keep_counts(c.lake, model, batch, _features_of(c, batch))
        return c.lake.read(stored.VERSIONS, model)

    c.staged("query_first_model", make)
    return c.lake


@query
def risk_batch_scored(c: Context) -> DataFrame:
    """The second batch by the stored forest and bounds of the first one."""
    lake = _first_model(c)
    rows = _features_of(c, feeds.BATCHES[1])
    return explain.add_explanations(stored.scored_with(lake, feeds.BATCHES[0], rows)).select(
        "transaction_id", "anomaly_score", "risk_score", "risk_tier", "risk_reasons")


@query
def drift_of_batches(c: Context) -> DataFrame:
    """Each batch and both together against the stored profile of the first one, from stored counts."""
    lake = _first_model(c)
    parts = [stored.drift_of(lake, feeds.BATCHES[0], batches).withColumn("batches", F.lit("+".join(batches)))
             for batches in ([feeds.BATCHES[0]], [feeds.BATCHES[1]], list(feeds.BATCHES))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def model_metadata(c: Context) -> DataFrame:
    return scoring.model_metadata(c.calibrated).drop("feature_columns")


@query
def model_gate(c: Context) -> DataFrame:
    """A model record per payment method, hour and weekend flag, through the gate."""
    by = F.concat_ws("/", "payment_method", "hour_of_day")
    records = scoring.model_metadata(c.calibrated.withColumn("slice", by), by="slice")
    record = lambda cond, value, other: F.when(cond, value).otherwise(other)
    rows = F.col("training_rows")
    varied = records.withColumns({
        "model_type": record(rows % 5 == 0, "Other", F.col("model_type")),
        "feature_columns": record(rows % 7 == 0, F.slice("feature_columns", 1, 7),
                                  F.col("feature_columns")),
        "training_rows": rows * 40,
        "high_risk_rate": record(rows % 11 == 0, F.lit(None), F.col("high_risk_rate")),
    })
    return gates.model_gate(varied).select("model_name", "passed", "message")


@query
def batch_gate(c: Context) -> DataFrame:
    """Fourteen checks on the raw and the Silver rows of each batch, its seven controls and its delta."""
    counts = c.staged("query_batch_counts", lambda: reconciliation.reconcile(
        reconciliation.batch_counts(c.lake)))
    checks = quality.standard_checks(c.lake, c.cfg, F.col("raw_count"), feeds.AS_OF)
    scores = [
        quality.quality_score(quality.run_checks_by(
            rows, "batch_id", counts.select("batch_id", "raw_count"), layer, checks, RUN_AT),
            ["batch_id"]).withColumn("layer", F.lit(layer))
        for layer, rows in (("raw", c.typed_raw), ("silver", c.silver))]
    verdicts = controls.batch_verdicts(c.lake, counts, c.cfg, feeds.AS_OF, RUN_AT)
    joined = scores[0].unionByName(scores[1]).join(counts, "batch_id").join(verdicts, "batch_id")
    return gates.batch_gate(joined.select(
        F.concat_ws("/", "batch_id", "layer").alias("batch_id"), F.col("quality_score").alias("dq_score"),
        "control_status", F.col("delta").alias("reconciliation_delta")))


@query
def iforest_scores(c: Context) -> DataFrame:
    """Forest scores of every transaction with tier and reasons."""
    scored = c.staged("query_forest", lambda: iforest.score(
        c.features, c.lake.stage(iforest.fit(c.features, c.features.count()), "query_nodes")))
    return explain.add_explanations(calibrate.calibrate(scored)).select(
        "transaction_id", "anomaly_score", "risk_score", "risk_tier", "risk_reasons")


@query
def risk_table(c: Context) -> DataFrame:
    """The stored risk table, at home and abroad: its rows, and how many break a promise about scores."""
    scored = c.staged("query_forest", lambda: iforest.score(
        c.features, c.lake.stage(iforest.fit(c.features, c.features.count()), "query_nodes")))
    table = "gold.fact_transactions_risk"
    c.lake.replace(explain.add_explanations(calibrate.calibrate(scored)).withColumn(
        "_scored_at", F.lit(feeds.AS_OF).cast("timestamp_ntz")), table)
    breaks = lambda promise: F.count_if(~F.coalesce(F.expr(promise), F.lit(False)))
    return c.lake.read(table).groupBy("country_mismatch").agg(
        F.count("*").alias("scored"), F.countDistinct("transaction_id").alias("transactions"),
        money_sum("amount").cast("decimal(28,2)").cast("double").alias("amount"),
        breaks("risk_score BETWEEN 0 AND 100").alias("risk_out_of_range"),
        breaks("risk_tier = CASE WHEN risk_score <= 45 THEN 'LOW' WHEN risk_score <= 75 THEN 'MEDIUM' "
               "ELSE 'HIGH' END").alias("tier_off"),
        breaks("(risk_tier = 'LOW') = (risk_reasons = 'Within standard baseline behavior')").alias("reason_off"),
        breaks("(contains(risk_reasons, 'Cross-border') AND country_mismatch = 1) OR "
               "NOT contains(risk_reasons, 'Cross-border')").alias("border_off"))


@query
def model_record(c: Context) -> DataFrame:
    """The stored model record, read back."""
    path = scoring.write_metadata(c.lake, scoring.model_metadata(c.calibrated))
    stored = c.spark.read.schema(schemas.MODEL_METADATA).json(path)
    return stored.withColumn("feature_columns", F.array_join("feature_columns", ","))


@query
def iforest_metadata(c: Context) -> DataFrame:
    scored = c.staged("query_forest", lambda: iforest.score(
        c.features, c.lake.stage(iforest.fit(c.features, c.features.count()), "query_nodes")))
    return scoring.model_metadata(calibrate.calibrate(scored)).withColumn(
        "feature_columns", F.array_join("feature_columns", ","))


# ---------------------------------------------------------------------------
# Validation rules, one by one, on the rough feed
# ---------------------------------------------------------------------------

def _rule(c: Context, name: str, words: str = "") -> DataFrame:
    reason = F.col(f"reason_{name}")
    return c.rough.filter(reason.startswith(words) if words else reason.isNotNull()).select(
        F.col("_row_seq").alias("row_seq"), reason.alias("reason"))


@query
def v01_id_present(c: Context) -> DataFrame:
    return _rule(c, "id_present")


@query
def v02_first_occurrence(c: Context) -> DataFrame:
    return _rule(c, "id_first")


@query
def v02_known_ids(c: Context) -> DataFrame:
    """Ids of the second batch that Silver holds from the first one, found through its filter."""
    first, second = feeds.BATCHES
    ids = c.lake.read("bronze.raw_transactions", second).select(stripped(F.col("transaction_id")).alias("transaction_id")).distinct()
    return history.known_ids(ids, c.lake.transactions(first), c.lake.read(history.FILTERS, first))


@query
def v03_amount_parse(c: Context) -> DataFrame:
    return _rule(c, "amount", "unparseable")


@query
def v04_amount_positive(c: Context) -> DataFrame:
    return _rule(c, "amount", "non-positive")


@query
def v05_amount_ceiling(c: Context) -> DataFrame:
    return _rule(c, "amount", "amount exceeds")


@query
def v06_timestamp_parse(c: Context) -> DataFrame:
    return _rule(c, "timestamp", "unparseable")


@query
def v07_not_future(c: Context) -> DataFrame:
    return _rule(c, "timestamp", "future")


@query
def v08_currency(c: Context) -> DataFrame:
    return _rule(c, "currency")


@query
def v09_status(c: Context) -> DataFrame:
    return _rule(c, "status")


@query
def v10_payment_method(c: Context) -> DataFrame:
    return _rule(c, "payment_method")


@query
def v11_customer(c: Context) -> DataFrame:
    return _rule(c, "customer")


@query
def v12_merchant(c: Context) -> DataFrame:
    return _rule(c, "merchant")


@query
def v13_normalised(c: Context) -> DataFrame:
    """Codes after trimming and case folding."""
    routed = c.rough.select(
        F.col("_row_seq").alias("row_seq"), F.col("_id").alias("transaction_id"),
        F.col("_currency").alias("currency"), F.col("_status").alias("status"),
        F.col("_method").alias("payment_method"),
        F.upper(stripped(F.col("country"))).alias("country"),
        F.lower(stripped(F.col("channel"))).alias("channel"),
        F.lower(stripped(F.col("device_type"))).alias("device_type"))
    return routed


@query
def v14_reason_text(c: Context) -> DataFrame:
    return c.rough.filter(F.col("_reasons") != "").select(
        F.col("_row_seq").alias("row_seq"), F.col("_reasons").alias("reasons"))


@query
def v15_raw_payload(c: Context) -> DataFrame:
    return silver.route(c.rough, feeds.AS_OF).filter("route = 'quarantine'").select(
        "transaction_id", "raw_record")


@query
def v16_route(c: Context) -> DataFrame:
    return silver.route(c.rough, feeds.AS_OF).groupBy("route").agg(
        F.count("*").alias("rows"), F.count("amount").alias("amounts"),
        F.count("raw_record").alias("records"))


@query
def v17_customer_cast(c: Context) -> DataFrame:
    """Dates parsed in several spellings; other text gives no date."""
    text = F.col("customer_since")
    spelled = F.when(F.col("_row_seq") % 4 == 1, F.replace(text, F.lit("-"), F.lit("/"))).when(
        F.col("_row_seq") % 4 == 2, F.concat(text, F.lit(" 10:00:00"))).when(
        F.col("_row_seq") % 4 == 3, F.substring(text, 1, 7)).otherwise(text)
    raw = c.lake.read("bronze.raw_customers").withColumn("customer_since", spelled)
    return silver.clean_customers(raw).select("customer_id", "customer_since")


@query
def v18_merchant_filter(c: Context) -> DataFrame:
    """Rows without an id are left out."""
    blank = F.when(F.col("_row_seq") % 9 == 4, "").when(F.col("_row_seq") % 9 == 5, None).otherwise(
        F.col("merchant_id"))
    raw = c.lake.read("bronze.raw_merchants").withColumn("merchant_id", blank)
    return silver.clean_merchants(raw).select("merchant_id", "category")


@query
def v19_status_flags(c: Context) -> DataFrame:
    return c.silver.select("transaction_id", *[
        flag.alias(name) for name, flag in gold.status_flags(F.col("status")).items()])


@query
def v20_method_group(c: Context) -> DataFrame:
    return c.silver.join(F.broadcast(c.methods), "payment_method").groupBy("method_group").agg(
        F.count("*").alias("rows"))


@query
def v21_date_key(c: Context) -> DataFrame:
    return c.silver.select("transaction_id", gold.date_key(F.col("ts")).alias("date_sk"))


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

@query
def d01_fact_left_join(c: Context) -> DataFrame:
    """Raw rows against the dimensions; a row without a match keeps a null key."""
    raw = c.raw.select(F.col("_row_seq").alias("row_seq"), "customer_id", "merchant_id")
    df = lookup(raw, c.customers.select("customer_id", "customer_sk"), "customer_id",
                salt_by="row_seq")
    df = lookup(df, c.merchants.select("merchant_id", "merchant_sk"), "merchant_id",
                salt_by="row_seq")
    return df.select("row_seq", "customer_sk", "merchant_sk")


@query
def d02_inner_join(c: Context) -> DataFrame:
    return reports.summed(c.fact, "date_sk").join(c.dates, "date_sk").groupBy(
        "day_name", "is_weekend").agg(F.sum("rows").alias("rows"), F.sum("failed").alias("failed"))


@query
def d03_semi_join_top_k(c: Context) -> DataFrame:
    counts = c.fact.groupBy("country").agg(F.count("*").alias("transaction_count"))
    top = reports.top_countries(counts)
    return c.fact.join(F.broadcast(top), "country", "left_semi").select("transaction_id", "country")


@query
def d04_anti_join(c: Context) -> DataFrame:
    return quality.unmatched_rows(
        c.raw, "customer_id", c.lake.entity_ids("customers"), "customer_id").withColumnRenamed(
        "unmatched", "customers").withColumn("merchants", quality.unmatched_rows(
            c.raw, "merchant_id", c.lake.entity_ids("merchants"), "merchant_id").scalar())


@query
def d05_membership(c: Context) -> DataFrame:
    raw = c.raw.select(F.col("_row_seq").alias("row_seq"), "customer_id", "merchant_id")
    for one in ("customer", "merchant"):
        known = c.lake.entity_ids(f"{one}s").withColumn(f"{one}_known", F.lit(True))
        raw = lookup(raw, known, f"{one}_id", salt_by="row_seq")
    return raw.select("row_seq", F.coalesce("customer_known", F.lit(False)).alias("customer_known"),
                      F.coalesce("merchant_known", F.lit(False)).alias("merchant_known"))


@query
def d06_dimension_left_join(c: Context) -> DataFrame:
    """Customers per number of transactions, idle customers included."""
    per_customer = marts.models(c.lake)["int_customer_metrics"]
    return per_customer.groupBy("total_transactions").agg(F.count("*").alias("customers"))


@query
def d07_reference_left_join(c: Context) -> DataFrame:
    return features.merchant_profile(c.silver, c.lake.entity_ids("merchants"))


@query
def d08_three_way_left_join(c: Context) -> DataFrame:
    return c.features.select("transaction_id", "cust_country", "customer_txn_count",
                             "merchant_failure_rate")


@query
def d09_cross_join(c: Context) -> DataFrame:
    """One row of scalars from three tables."""
    count = lambda df: df.agg(F.count("*")).scalar()
    return c.spark.range(1).select(
        count(c.raw).alias("raw_count"), count(c.silver).alias("silver_count"),
        count(c.lake.quarantine()).alias("quarantine_count"))


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------

def _failed() -> Column:
    return F.col("status") == "FAILED"


@query
def e01_counts(c: Context) -> DataFrame:
    return c.silver.groupBy("batch_id").agg(F.count("*").alias("rows"))


@query
def e02_grouped(c: Context) -> DataFrame:
    return c.silver.groupBy("currency").agg(
        F.count("*").alias("rows"), money_sum("amount").alias("t"),
        F.count("amount").alias("n")).select(
        "currency", "rows", cents(F.col("t")).alias("total"),
        cents_average(F.col("t"), F.col("n")).alias("average"))


@query
def e03_conditional(c: Context) -> DataFrame:
    """The two spellings, also where nothing is counted: zero against null."""
    none = c.silver.filter("status = 'NONE'").agg(
        F.count_if(_failed()).alias("counted"), F.sum(F.when(_failed(), 1).otherwise(0)).alias("summed"))
    per = c.silver.groupBy("channel").agg(
        F.count_if(_failed()).alias("counted"), F.sum(F.when(_failed(), 1).otherwise(0)).alias("summed"))
    return per.unionByName(none.withColumn("channel", F.lit("none")))


@query
def e04_guarded_percent(c: Context) -> DataFrame:
    """Failure rate per merchant and weekend; null where there were no weekend rows."""
    weekend = gold.weekday(F.col("ts")).isin(0, 6)
    return c.silver.groupBy("merchant_id").agg(
        F.count_if(weekend & _failed()).alias("f"), F.count_if(weekend).alias("n")).select(
        "merchant_id", percent(F.col("f"), F.col("n")).alias("weekend_failure_pct"))


@query
def e05_count_distinct(c: Context) -> DataFrame:
    return c.silver.groupBy("country").agg(F.countDistinct("customer_id").alias("customers"))


@query
def e05_distinct_by_week(c: Context) -> DataFrame:
    """Different customers of each week, from the stored bitmaps of its days."""
    dates = c.dates.select("date_sk", "year", "week_of_year")
    return distinct_keys(c.customer_bits.join(dates, "date_sk"), ["year", "week_of_year"], "customers")


@query
def e05_distinct_by_country(c: Context) -> DataFrame:
    """Different customers of each country in all dates, from the same bitmaps."""
    return distinct_keys(c.customer_bits, ["country"], "customers")


@query
def e06_median(c: Context) -> DataFrame:
    return quantiles(c.silver, "amount", ["payment_method"], [0.5], True).select(
        "payment_method", F.col("quantile").alias("median_amount"))


@query
def e07_min_max(c: Context) -> DataFrame:
    return c.silver.groupBy("status").agg(
        F.min("amount").alias("low"), F.max("amount").alias("high"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query
def e08_having(c: Context) -> DataFrame:
    return c.silver.groupBy("merchant_id").agg(F.count("*").alias("rows")).filter("rows >= 100")


@query
def e09_group_by_expression(c: Context) -> DataFrame:
    return c.silver.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour_of_day")).agg(
        F.count("*").alias("rows"))


@query
def e10_surplus(c: Context) -> DataFrame:
    """Rows beyond the first of each id and of each customer; null is one value."""
    blank = c.raw.withColumn("customer_id", F.nullif("customer_id", F.lit("")))
    return quality.surplus_rows(c.raw, "transaction_id").withColumn(
        "customer_surplus", quality.surplus_rows(blank, "customer_id").scalar())


@query
def e11_customer_baseline(c: Context) -> DataFrame:
    return features.customer_profile(c.silver, c.lake.customers())


@query
def e12_percentiles(c: Context) -> DataFrame:
    return calibrate.score_bounds(c.silver, "amount")


@query
def e13_decile_edges(c: Context) -> DataFrame:
    return c.profile.select("feature", F.posexplode("edges").alias("place", "edge"))


@query
def e14_histogram(c: Context) -> DataFrame:
    """Rows per bin of the first batch's deciles; values outside are counted apart."""
    return drift.histogram(unpivoted(c.features, drift.WATCHED), c.profile.select("feature", "edges")).select(
        "feature", F.coalesce("bin", F.lit(-1)).alias("bin"), "rows")


@query
def e15_tier_share(c: Context) -> DataFrame:
    high = F.count_if(F.col("risk_tier") == "HIGH")
    tenths = F.sum(F.round(F.col("risk_score") * 10).cast("long"))
    return c.calibrated.groupBy("payment_method").agg(
        rate(high, F.count("*"), 6).alias("high_share"),
        rate(tenths, F.count("*") * 10, 4).alias("mean_score"))


@query
def e16_weighted_score(c: Context) -> DataFrame:
    return quality.quality_score(_checked(c, _raw_checks(c), raw=True)).select("quality_score")


@query
def e17_verdict_counts(c: Context) -> DataFrame:
    return _checked(c, _raw_checks(c), raw=True).groupBy("status").agg(F.count("*").alias("checks"))


# ---------------------------------------------------------------------------
# Windows
# ---------------------------------------------------------------------------

@query
def f01_dense_key(c: Context) -> DataFrame:
    """Transactions numbered in id order, without a window over the whole table."""
    return dense_keys(c.lake, c.silver.select("transaction_id"), "transaction_id", "transaction_sk")


@query
def f02_share_of_total(c: Context) -> DataFrame:
    counts = c.silver.groupBy("currency").agg(F.count("*").alias("rows"))
    # One row per admitted currency.
    return counts.withColumn("pct", percent(F.col("rows"), F.sum("rows").over(Window.partitionBy())))


@query
def f03_share_in_group(c: Context) -> DataFrame:
    counts = c.silver.groupBy("country", "payment_method").agg(F.count("*").alias("rows"))
    whole = F.sum("rows").over(Window.partitionBy("country"))
    return counts.withColumn("pct", percent(F.col("rows"), whole))


@query
def f04_first_by_key(c: Context) -> DataFrame:
    """The first raw row of each customer."""
    rows = c.raw.select("customer_id", F.col("_row_seq").alias("row_seq"), "transaction_id")
    return first_by_key(rows, "customer_id", F.col("row_seq"))


@query
def f05_first_occurrence(c: Context) -> DataFrame:
    """Which raw row of an id is the first of its batch."""
    parts = []
    for batch in feeds.BATCHES:
        raw = c.lake.read("bronze.raw_transactions", batch)
        table = silver.repeated_ids(raw).select("transaction_id", "first_seq")
        found = lookup(raw.select("transaction_id", "_row_seq"), table, "transaction_id",
                       salt_by="_row_seq")
        parts.append(found.select(
            F.col("_row_seq").alias("row_seq"),
            (F.col("first_seq").isNull() | (F.col("first_seq") == F.col("_row_seq")))
            .alias("is_first")))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# Sort, limit and set operations
# ---------------------------------------------------------------------------

@query
def g01_order_by(c: Context) -> DataFrame:
    return c.fact.groupBy("country", "currency").agg(F.count("*").alias("rows")).orderBy(
        F.asc_nulls_last("country"), F.desc("rows"), "currency")


@query
def g02_top_k(c: Context) -> DataFrame:
    return c.fact.select("transaction_id", "amount", "country").orderBy(
        F.desc_nulls_last("amount"), "transaction_id").limit(20)


@query
def g03_top_k_join(c: Context) -> DataFrame:
    """Days of the ten busiest merchants."""
    top = c.fact.groupBy("merchant_sk").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.asc_nulls_last("merchant_sk")).limit(10)
    return c.fact.join(F.broadcast(top.select("merchant_sk")), "merchant_sk").groupBy(
        "merchant_sk", "date_sk").agg(F.count("*").alias("rows"))


@query
def g04_first_three(c: Context) -> DataFrame:
    """Reasons as if every row were HIGH: at most three, in order."""
    return c.features.withColumn("risk_tier", F.lit("HIGH")).select(
        "transaction_id", explain.risk_reasons().alias("risk_reasons"))


@query
def g05_distinct(c: Context) -> DataFrame:
    return c.silver.select(F.to_date("ts").alias("day")).distinct()


@query
def g06_concatenate(c: Context) -> DataFrame:
    """Check names and control ids as one list of verdicts."""
    checks = _checked(c, _raw_checks(c)).select(F.col("check_name").alias("name"), "status")
    report = controls.control_report(c.lake, feeds.BATCHES[0], c.cfg, feeds.AS_OF)
    return checks.unionByName(report.select(F.col("control_id").alias("name"), "status"))


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------

@query
def h01_string(c: Context) -> DataFrame:
    return c.silver.select(
        "transaction_id", F.upper("channel").alias("up"), F.lower("currency").alias("low"),
        F.trim(F.concat(F.lit("  "), F.col("status"), F.lit(" "))).alias("trimmed"),
        F.concat_ws("|", "country", "channel").alias("joined"),
        (F.trim("device_type") == "").alias("blank"))


@query
def h02_number_text(c: Context) -> DataFrame:
    return c.features.select(
        "transaction_id", fixed_text(F.col("amount"), 2).alias("two"),
        fixed_text(F.col("amount_ratio"), 1).alias("one"),
        F.lpad(F.col("hour_of_day").cast("string"), 2, "0").alias("padded"))


@query
def h03_date(c: Context) -> DataFrame:
    ts = F.col("ts")
    return c.silver.select(
        "transaction_id", F.date_format(ts, "yyyyMMdd").alias("ymd"),
        F.date_format(ts, "MMMM").alias("month_name"), F.date_format(ts, "EEEE").alias("day_name"),
        F.to_date(ts).alias("day"), F.year(ts).alias("y"), F.quarter(ts).alias("q"),
        F.month(ts).alias("m"), F.weekofyear(ts).alias("w"), F.day(ts).alias("d"),
        gold.weekday(ts).alias("dow"), F.hour(ts).alias("h"))


@query
def h04_time_arithmetic(c: Context) -> DataFrame:
    cutoff = hours_before(F.lit(feeds.AS_OF).cast("timestamp_ntz"), 24 * 7)
    return c.silver.groupBy((F.col("ts") >= cutoff).alias("in_last_week")).agg(
        F.count("*").alias("rows"), iso_text(F.max("ts"), " ").alias("latest"))


@query
def h05_math(c: Context) -> DataFrame:
    amount = F.col("amount")
    return c.silver.select(
        "transaction_id", F.round(amount.cast("decimal(18,2)"), 1).cast("double").alias("rounded"),
        F.least(F.greatest(amount, F.lit(10.0)), F.lit(100.0)).alias("clipped"),
        F.round(F.log(amount + 0.01), 6).alias("logged"), F.abs(-amount).alias("size"))


@query
def h06_conditional(c: Context) -> DataFrame:
    currency = F.col("currency")
    unknown = F.nullif(F.col("device_type"), F.lit("unknown"))
    return c.silver.select(
        "transaction_id", F.when(currency.isin("GBP", "EUR"), "near").otherwise("far").alias("zone"),
        F.coalesce(unknown, F.lit("?")).alias("device"), unknown.isNull().alias("no_device"),
        (~unknown.isin("mobile", "tablet")).alias("not_handheld"))


@query
def h07_cast(c: Context) -> DataFrame:
    return c.raw.select(
        F.col("_row_seq").alias("row_seq"), parse_amount(F.col("amount")).alias("amount"),
        parse_date(F.substring("timestamp", 1, 10)).alias("day"),
        F.col("_row_seq").cast("string").alias("seq_text"))


@query
def h08_json(c: Context) -> DataFrame:
    columns = ["transaction_id", "amount", "status"]
    return c.raw.select(F.col("_row_seq").alias("row_seq"), silver.raw_json(columns).alias("record"))


@query
def h09_binning(c: Context) -> DataFrame:
    return c.calibrated.groupBy("risk_tier").agg(
        F.count("*").alias("rows"), F.min("risk_score").alias("low"),
        F.max("risk_score").alias("high"))


@query
def h10_metadata(c: Context) -> DataFrame:
    """Columns of the controlled tables beside their row counts."""
    parts = []
    for name, df in (("gold.fact_transactions", c.fact), ("gold.dim_customer", c.customers),
                     ("gold.dim_merchant", c.merchants)):
        missing = set(schemas.CONTROLLED_GOLD[name]) - set(df.columns)
        parts.append(df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).cast("long").alias("columns"),
            F.lit(len(missing)).cast("long").alias("missing"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

def _side_lake(c: Context, name: str) -> Lake:
    return Lake(c.spark, f"{c.lake.root}/side/{name}")


def _files(c: Context) -> dict[str, str]:
    """The feeds written as CSV files, once."""
    root = f"{c.lake.root}/files"
    if (c.lake.root, "files") not in _staged:
        for name, feed in (("transactions", feeds.transactions), ("customers", feeds.customers),
                           ("merchants", feeds.merchants)):
            feed(c.spark, c.folder).drop("_row_seq").write.mode("overwrite").option(
                "header", True).csv(f"{root}/{name}")
        _staged[(c.lake.root, "files")] = c.spark.range(0)
    return {name: f"{root}/{name}" for name in ("transactions", "customers", "merchants")}


@query
def src_csv_scan(c: Context) -> DataFrame:
    """The transaction feed after a round trip through CSV files."""
    return read_csv(c.spark, _files(c)["transactions"]).drop("_row_seq")


@query
def src_csv_quoted(c: Context) -> DataFrame:
    """The transaction feed with line ends, commas and quotes in a field, after a round trip through CSV files."""
    path = f"{c.lake.root}/files/quoted"
    untidy = F.concat("channel", F.lit('\n"'), "customer_id", F.lit('",\n\n'), "status")
    if (c.lake.root, "quoted") not in _staged:
        feeds.transactions(c.spark, c.folder).drop("_row_seq").withColumn("channel", untidy).write.mode(
            "overwrite").options(header=True, escape='"').csv(path)
        _staged[(c.lake.root, "quoted")] = c.spark.range(0)
    return read_csv(c.spark, path).drop("_row_seq")


@query
def src_schema_contract(c: Context) -> DataFrame:
    """Contract results of three files, one of them against the wrong contract."""
    files = _files(c)
    parts = []
    for file, table in (("transactions", "transactions"), ("customers", "customers"),
                        ("customers", "merchants"), ("merchants", "other")):
        df = read_csv(c.spark, files[file])
        valid, missing = validate_schema(df, table)
        parts.append(df.agg(F.count("*").alias("rows")).select(
            F.lit(file).alias("file"), F.lit(table).alias("contract"), F.lit(valid).alias("valid"),
            F.lit(",".join(missing)).alias("missing"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def src_batch_stamp(c: Context) -> DataFrame:
    """Batch named by the caller beside the batch named in the file."""
    stamped = bronze.stamp(feeds.transactions(c.spark, c.folder), "transactions", "X9", feeds.AS_OF)
    return stamped.groupBy("batch_id", "_source_batch_id", "_ingested_at").agg(
        F.count("*").alias("rows"))


@query
def src_batch_scan(c: Context) -> DataFrame:
    return c.lake.read("bronze.raw_transactions", feeds.BATCHES[1]).select(
        F.col("_row_seq").alias("row_seq"), "transaction_id", "amount", "batch_id")


@query
def src_declared_views(c: Context) -> DataFrame:
    """The three upstream tables as temporary views, read through SQL."""
    for name, df in (("transactions", c.silver), ("customers", c.lake.customers()),
                     ("merchants", c.lake.merchants())):
        df.createOrReplaceTempView(f"silver_{name}_view")
    return c.spark.sql("""
        SELECT 'transactions' AS name, COUNT(*) AS rows FROM silver_transactions_view
        UNION ALL SELECT 'customers', COUNT(*) FROM silver_customers_view
        UNION ALL SELECT 'merchants', COUNT(*) FROM silver_merchants_view""")


@query
def sink_batch_replace(c: Context) -> DataFrame:
    """A batch landed twice, the second time with other rows; the other batch stays."""
    lake, rows = _side_lake(c, "replace"), feeds.transactions(c.spark, c.folder)
    for batch in feeds.BATCHES:
        bronze.land(lake, rows, "transactions", batch, feeds.AS_OF)
    bronze.land(lake, rows.filter("status <> 'SUCCESS'"), "transactions", "B2", feeds.AS_OF)
    return lake.read("bronze.raw_transactions").groupBy("batch_id", "status").agg(
        F.count("*").alias("rows"))


@query
def sink_upsert(c: Context) -> DataFrame:
    """Customers of two batches: the later version of a key wins."""
    lake, raw = _side_lake(c, "upsert"), c.lake.read("bronze.raw_customers")
    changed = raw.filter("segment IN ('student', 'premium')").withColumn(
        "country", F.concat(F.col("country"), F.lit("_NEW")))
    for batch, rows in (("B1", raw), ("B2", changed)):
        clean = silver.clean_customers(rows).withColumn(
            "_loaded_at", F.lit(feeds.AS_OF).cast("timestamp_ntz"))
        lake.replace_batch(clean, "silver.customers_by_batch", batch)
    return lake.customers().select("customer_id", "country", "batch_id")


@query
def sink_full_refresh(c: Context) -> DataFrame:
    """A table rebuilt twice holds the second build only."""
    lake = _side_lake(c, "refresh")
    lake.replace(c.customers, "gold.dim_customer")
    lake.replace(c.customers.filter("segment = 'retail'"), "gold.dim_customer")
    return lake.read("gold.dim_customer").select("customer_sk", "customer_id", "segment")


@query
def sink_insert_or_ignore(c: Context) -> DataFrame:
    """Dates inserted twice; keys that are there are skipped."""
    lake = _side_lake(c, "ignore")
    lake.replace(c.dates.filter("is_weekend"), "gold.dim_date")
    lake.append_missing(c.dates.withColumn("day_name", F.upper("day_name")), "gold.dim_date",
                        "date_sk")
    return lake.read("gold.dim_date").select("date_sk", "day_name")


@query
def sink_date_layout(c: Context) -> DataFrame:
    """A date range of the fact table, read through its date partitions."""
    return c.fact.filter(F.col("date_sk").between(20240110, 20240112)).groupBy("date_sk").agg(
        F.count("*").alias("rows"))


@query
def sink_pruned_dates(c: Context) -> DataFrame:
    """Weekend days of the fact table; which partitions are read comes from the date dimension."""
    return reports.weekend_volume(c.fact, c.dates)


@query
def sink_materialisation(c: Context) -> DataFrame:
    """View models answer through SQL, table models from their files."""
    made = marts.materialise(c.lake)
    daily = c.spark.table("int_transaction_metrics").agg(F.sum("total_transactions").alias("rows"))
    table = made["payment_daily_metrics"].agg(F.sum("total_transactions").alias("rows"))
    return daily.select(F.lit("view").alias("kind"), "rows").unionByName(
        table.select(F.lit("table").alias("kind"), "rows"))


@query
def ingest_audit(c: Context) -> DataFrame:
    """Audit rows of one good file, one with the wrong columns and one that is missing."""
    files, lake = _files(c), _side_lake(c, "audit")
    bronze.ingest(c.spark, lake.root, files["transactions"], files["merchants"],
                  f"{files['customers']}/none.csv", "B1", ingested_at=feeds.AS_OF)
    return lake.read("bronze.ingestion_audit").select(
        "table_name", "schema_version", "record_count", "success_count", "failure_count", "status",
        "batch_id")


@query
def injected_defects(c: Context) -> DataFrame:
    """Rows changed per field when defects are planted at the usual rates, and what they became."""
    clean = feeds.transactions(c.spark, c.folder)
    dirty = inject_defects(clean, seed=7, as_of=feeds.AS_OF)
    fields = ["transaction_id", "customer_id", "merchant_id", "timestamp", "amount", "currency",
              "status"]
    pairs = clean.alias("a").join(dirty.alias("b"), "_row_seq")
    values = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"a.{f}").alias("old"), F.col(f"b.{f}").alias("new"))
        for f in fields])).alias("v")
    changed = F.col("old") != F.col("new")
    new = F.when(changed, F.col("new"))
    return pairs.select(values).select("v.*").groupBy("field").agg(
        F.count("*").alias("all_rows"), F.count_if(changed).alias("changed"),
        F.countDistinct(new).alias("values"), F.min(new).alias("least"), F.max(new).alias("greatest"))


@query
def run_summary(c: Context) -> DataFrame:
    """All stages of one batch from CSV files."""
    files = _files(c)
    return run_batch(
        c.spark, _side_lake(c, "run").root, files["transactions"], files["customers"],
        files["merchants"], "B1", as_of=feeds.AS_OF)
