"""The registered queries: each reads the driver tables at ``sf_dir`` and
returns a lazy DataFrame. Keys match ``tidemark.oracle.oracle_sql``; the IDs
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import LOOKBACK_DAYS
from tidemark.functions.ranking import global_rank
from tidemark.operators import analysis, correlation, quality, relative
from tidemark.operators.dims import dim_assets as _dim_assets
from tidemark.operators.dims import dim_dates as _dim_dates
from tidemark.operators.facts import bars_source, combine_sources, with_returns
from tidemark.operators.rolling import rolling_performance as _rolling
from tidemark.operators.staging import latest_per_key, stage_bars, stage_market_chart
from tidemark.plans.star import brands_fact, orders_star
from tidemark.session import configure, scratch_root
from tidemark.sources import fixtures as fx
from tidemark.sources.landing import missing_assets
from tidemark.sources.landing import refetch_plan as _refetch_plan

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the analysis queries on the driver data.
LUMP_START, LUMP_END = "2000-08-01", "2001-08-01"
DUP_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def _naive_audit(df: DataFrame) -> DataFrame:
    """Ingestion time as UTC wall-clock (timestamp_ntz), the oracle's naive type."""
    return df.withColumn("__de_processed_at", F.col("__de_processed_at").cast("timestamp_ntz"))


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            scratch_root(spark)  # some queries cut what they read twice by a checkpoint
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTERED[name] = run
        return run

    return deco


# ---------------------------------------------------------------- sources / staging


@register("daily_bars")  # SRC9
def daily_bars(spark, sf_dir):
    return fx.bars_orders(spark, sf_dir)


@register("stage_nested_bars")  # M1, ARR1, J8, F1-F2, PF1, PF4, WIN1
def stage_nested_bars(spark, sf_dir):
    return _naive_audit(stage_bars(fx.raw_nested(spark, sf_dir)))


@register("stage_json_chart")  # M2, ARR2-3, JS1-3, F3-F4, J9, PF5, PF10
def stage_json_chart(spark, sf_dir):
    return _naive_audit(stage_market_chart(fx.raw_chart(spark, sf_dir)))


@register("stage_nested_zeros")  # M1, PF4: all-zero and all-null bars are dropped, a zero price with a volume stays
def stage_nested_zeros(spark, sf_dir):
    return _naive_audit(stage_bars(fx.raw_nested_with_zeros(spark, sf_dir)))


@register("stage_chart_zeros")  # M2, PF5: points without a positive close are dropped
def stage_chart_zeros(spark, sf_dir):
    return _naive_audit(stage_market_chart(fx.raw_chart_with_zeros(spark, sf_dir)))


@register("dedupe_latest")  # WIN1, PF9, S3
def dedupe_latest(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], DUP_ORDER)


@register("missing_symbols")  # SRC10, J11
def missing_symbols(spark, sf_dir):
    loaded = fx.bars_orders(spark, sf_dir).select("symbol").unionByName(fx.bars_events(spark, sf_dir).select("symbol"))
    return missing_assets(fx.registry(spark), loaded)


REFETCH_START, REFETCH_END = "1995-01-01", "1998-06-30"


@register("refetch_plan")  # SRC8, SRC10: the days that each registered asset lacks in a run's window
def refetch_plan(spark, sf_dir):
    days = ["symbol", "price_date"]
    loaded = fx.bars_orders(spark, sf_dir).select(*days).unionByName(fx.bars_events(spark, sf_dir).select(*days))
    return _refetch_plan(fx.registry(spark), loaded, REFETCH_START, REFETCH_END)


# ---------------------------------------------------------------- star schema


@register("dim_assets")  # M3, SRC7, J3, A1-A2, U2, F7
def dim_assets(spark, sf_dir):
    return _dim_assets(fx.registry(spark), fx.bars_orders(spark, sf_dir), fx.chart_events(spark, sf_dir))


@register("dim_dates")  # M4, A4, F5, F8-F14, F23, PF13
def dim_dates(spark, sf_dir):
    assets = _dim_assets(fx.registry(spark), fx.bars_orders(spark, sf_dir), fx.chart_events(spark, sf_dir))
    return _dim_dates(assets, as_of=fx.AS_OF)


@register("daily_returns")  # M6-M8, WIN2, PF11-12, F13, F20-21
def daily_returns(spark, sf_dir):
    r = with_returns(combine_sources(bars_source(fx.bars_orders(spark, sf_dir))))
    return r.select(
        "symbol",
        "price_date",
        "close_price",
        "prev_close_price",
        "daily_return",
        "intraday_range_pct",
        "days_since_prev",
        "has_data_gap",
    )


@register("fact_daily_prices")  # M5, M9, U1, J1-J2, F6, F22
def fact_daily_prices(spark, sf_dir):
    fact = orders_star(spark, sf_dir, with_events=True).fact
    return fact.drop("__run_id", "__de_processed_at")


@register("fact_holed_calendar")  # J2: a calendar of weekdays, joined on the date
def fact_holed_calendar(spark, sf_dir):
    fact = orders_star(spark, sf_dir, with_events=True, weekdays_only=True).fact
    return fact.select("symbol", "asset_key", "date_key", "price_date", "close_price")


# ---------------------------------------------------------------- marts


def _orders_rolling(spark, sf_dir):
    return _rolling(orders_star(spark, sf_dir).fact)


@register("rolling_performance")  # M10, WIN3-5, PF8, J10, A3, F17-18
def rolling_performance(spark, sf_dir):
    return _orders_rolling(spark, sf_dir)


SLICE_ROWS = 400  # of a series in one window; the orders bars have some 2,400 days


@register("rolling_sliced")  # WIN2-WIN5 with each series cut over several tasks
def rolling_sliced(spark, sf_dir):
    return _rolling(orders_star(spark, sf_dir, slice_rows=SLICE_ROWS).fact, slice_rows=SLICE_ROWS)


# The rolling output covers a look-back of LOOKBACK_DAYS: at most one benchmark row per day.
BENCH_ROWS = LOOKBACK_DAYS + 1


def _orders_relative(spark, sf_dir):
    return relative.relative_performance(
        _orders_rolling(spark, sf_dir), benchmark=fx.ORDERS_BENCHMARK, benchmark_rows_bound=BENCH_ROWS
    )


@register("relative_performance")  # M11-M12, J4, PF7
def relative_performance(spark, sf_dir):
    return _orders_relative(spark, sf_dir)


@register("latest_summary")  # M13, J7, PF3
def latest_summary(spark, sf_dir):
    return relative.latest_summary(_orders_relative(spark, sf_dir).checkpoint())


@register("ranked_summary")  # M14, WIN6
def ranked_summary(spark, sf_dir):
    return relative.ranked_summary(_orders_rolling(spark, sf_dir), benchmark=fx.ORDERS_BENCHMARK)


@register("volatility_stats")  # M16, A6-A8, A13
def volatility_stats(spark, sf_dir):
    return correlation.volatility_stats(correlation.recent_returns(brands_fact(spark, sf_dir)))


@register("pairwise_correlation")  # M15, J5, A5, A14
def pairwise_correlation(spark, sf_dir):
    return correlation.pairwise_correlation(correlation.recent_returns(brands_fact(spark, sf_dir)))


@register("volatility_correlation_summary")  # M17, J6, S1, F19
def volatility_correlation_summary(spark, sf_dir):
    return correlation.volatility_correlation_summary(brands_fact(spark, sf_dir))


# ---------------------------------------------------------------- analyses


@register("lump_sum")  # M18
def lump_sum(spark, sf_dir):
    return analysis.lump_sum(orders_star(spark, sf_dir).fact, LUMP_START, LUMP_END, 1000.0)


@register("dollar_cost_average")  # M19, A11, PF14
def dollar_cost_average(spark, sf_dir):
    return analysis.dollar_cost_average(orders_star(spark, sf_dir).fact, LUMP_START, LUMP_END, 100.0, 13)


@register("best_by_period")  # M20
def best_by_period(spark, sf_dir):
    fact = orders_star(spark, sf_dir).fact.checkpoint()
    summary = relative.latest_summary(
        relative.relative_performance(_rolling(fact), benchmark=fx.ORDERS_BENCHMARK, benchmark_rows_bound=BENCH_ROWS).checkpoint()
    )
    ytd = analysis.year_to_date(fact, benchmark=fx.ORDERS_BENCHMARK)
    return analysis.best_by_period(summary, ytd)


@register("rank_by_excess")  # M21, S2
def rank_by_excess(spark, sf_dir):
    return analysis.rank_by_excess(relative.latest_summary(_orders_relative(spark, sf_dir).checkpoint()))


@register("relative_volatility")  # M22
def relative_volatility(spark, sf_dir):
    return analysis.relative_volatility(relative.latest_summary(_orders_relative(spark, sf_dir).checkpoint()))


def _brands_latest(spark, sf_dir):
    """The latest summary of the monthly brand bars: some two dozen rows with tied values."""
    fact = with_returns(combine_sources(bars_source(fx.bars_brands_monthly(spark, sf_dir)))).withColumn("asset_type", F.lit("brand"))
    rel = relative.relative_performance(_rolling(fact), benchmark=fx.BRANDS_BENCHMARK, benchmark_rows_bound=BENCH_ROWS)
    return relative.latest_summary(rel.checkpoint())


@register("latest_summary_brands")  # M13 over many symbols
def latest_summary_brands(spark, sf_dir):
    return _brands_latest(spark, sf_dir)


@register("excess_listing_brands")  # M21, S2: ties share a rank, the listing has a place for each row
def excess_listing_brands(spark, sf_dir):
    return analysis.with_position(analysis.rank_by_excess(_brands_latest(spark, sf_dir), n=90), "excess_rank", "symbol")


@register("relative_volatility_brands")  # M22 over many symbols
def relative_volatility_brands(spark, sf_dir):
    return analysis.relative_volatility(_brands_latest(spark, sf_dir))


@register("pair_listing")  # M17, S1: every pair with its place by |correlation|
def pair_listing(spark, sf_dir):
    pairs = correlation.volatility_correlation_summary(brands_fact(spark, sf_dir), ordered=False)
    strength = pairs.select("symbol_a", "symbol_b", "correlation", F.abs("correlation").alias("strength"))
    ranked = global_rank(strength, "strength", "strength_rank", ascending=False)
    return analysis.with_position(ranked, "strength_rank", "symbol_a", "symbol_b").drop("strength")


# ---------------------------------------------------------------- quality checks


@register("qc_not_null")  # QC1
def qc_not_null(spark, sf_dir):
    fact = orders_star(spark, sf_dir).fact
    return quality.not_null(fact, "daily_return").select("symbol", "price_date", "close_price")


@register("qc_unique")  # QC2
def qc_unique(spark, sf_dir):
    return quality.unique(fx.table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("qc_unique_combination")  # QC3
def qc_unique_combination(spark, sf_dir):
    return quality.unique_combination(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("qc_accepted_values")  # QC4
def qc_accepted_values(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return quality.accepted_values(orders, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@register("qc_row_count_between")  # QC5
def qc_row_count_between(spark, sf_dir):
    return quality.row_count_between(fx.table(spark, sf_dir, "lineitem"), 1, 1000)


@register("qc_value_bounds")  # QC8, QC11: price, return and range bounds in one scan
def qc_value_bounds(spark, sf_dir):
    fact = orders_star(spark, sf_dir).fact
    bounds = {"close_price": ("high_price", 0.0, 400000.0), "daily_return": ("wide_return", -0.5, 0.5), "intraday_range_pct": ("wide_range", 0.0, 2.0)}
    return quality.out_of_bounds(fact, bounds, ["symbol", "price_date"])


@register("qc_row_count")  # QC6, A10
def qc_row_count(spark, sf_dir):
    assets = _dim_assets(fx.registry(spark), fx.bars_orders(spark, sf_dir), fx.chart_events(spark, sf_dir))
    return quality.row_count_equal(assets, 7)


@register("qc_distinct_count")  # QC7, A12
def qc_distinct_count(spark, sf_dir):
    return quality.distinct_count_equal(orders_star(spark, sf_dir, with_events=True).fact, "symbol", 7)


@register("qc_between")  # QC8
def qc_between(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    return quality.values_between(lines, "l_discount", 0.0, 0.08).select("l_orderkey", "l_linenumber", "l_discount")


@register("qc_not_in_set")  # QC9
def qc_not_in_set(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return quality.not_in_set(events, "event_type", ["error"]).select("event_id", "event_type")


@register("qc_gap_share")  # QC10, A9
def qc_gap_share(spark, sf_dir):
    fact = with_returns(combine_sources(bars_source(fx.bars_parts(spark, sf_dir))))
    return quality.gap_share(fact)


@register("qc_all_in_one_scan")  # QC12
def qc_all_in_one_scan(spark, sf_dir):
    fact = orders_star(spark, sf_dir).fact
    c = F.col
    return quality.single_scan(
        fact,
        {
            "null_daily_return": c("daily_return").isNull(),
            "null_close": c("close_price").isNull(),
            "nonpositive_close": c("close_price") <= 0,
            "gap": c("has_data_gap"),
            "return_out_of_bounds": F.abs(c("daily_return")) > 1,
            "unregistered": c("asset_key").isNull(),
        },
    )


@register("qc_merged_state")  # QC1-QC3, QC6-QC8, QC10: checks from stored partition states, new months scanned only
def qc_merged_state(spark, sf_dir):
    """State of the lines shipped up to a date, then of the months that later loads and corrections wrote."""
    from tidemark.operators.check_state import Checks, all_checks, update_state
    from tidemark.plans.upsert import full_refresh, month_partition, upsert
    from tidemark.session import scratch_path

    bars = with_returns(combine_sources(bars_source(fx.bars_orders(spark, sf_dir)))).drop("__run_id", "__de_processed_at", "source")
    c = F.col
    checks = Checks(
        rows={"null_return": c("daily_return").isNull(), "gap": c("has_data_gap"), "wide_return": F.abs(c("daily_return")) > 0.5, "high_price": c("close_price") > 400000},
        unique={"symbol_date": ["symbol", "price_date"], "date": ["price_date"]},
        distinct={"symbols": "symbol", "closes": "close_price"},
    )
    target, state = scratch_path(spark, "checked"), scratch_path(spark, "check-state")
    split = F.lit(FACT_SPLIT).cast("date")
    # The first load has a wrong price in one month, which the second one corrects.
    wrong = F.when(F.trunc("price_date", "month") == F.lit("1995-03-01").cast("date"), c("close_price") * 10).otherwise(c("close_price"))
    full_refresh(bars.where(c("price_date") < split).withColumn("close_price", wrong), target, month_partition())
    update_state(spark, state, spark.read.parquet(target), checks)
    later = bars.where((c("price_date") >= split) | (F.trunc("price_date", "month") == F.lit("1995-03-01").cast("date")))
    upsert(spark, target, later, ["symbol", "price_date"], ["close_price"], month_partition())
    written = [r[0] for r in later.select(month_partition().alias("m")).distinct().collect()]
    update_state(spark, state, spark.read.parquet(target), checks, written)
    return all_checks(spark, state, checks)


# ---------------------------------------------------------------- writes: upsert, incremental, stream

UPSERT_SPLIT = "1998-06-01"   # batch 1: lines shipped before, batch 2: on/after (ingestion order)
REREAD_SPLIT = "1997-06-01"   # raw documents ingested before, and on or after
FACT_SPLIT = "1998-04-15"     # fact built up to this date, then appended incrementally


@register("upsert_latest")  # SNK4-SNK7, ST1
def upsert_latest(spark, sf_dir):
    """Two-batch incremental load of the duplicated lines; equals a full de-duplication."""
    from tidemark.plans.upsert import upsert
    from tidemark.session import scratch_path

    lines = fx.table(spark, sf_dir, "lineitem")
    target = scratch_path(spark, "upsert-lines")
    part = F.floor(F.col("l_orderkey") / 4096)
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    for batch in (lines.where(F.col("l_shipdate") < split), lines.where(F.col("l_shipdate") >= split)):
        upsert(spark, target, batch, ["l_orderkey", "l_linenumber"], DUP_ORDER, part, sort_cols=["l_orderkey"])
    return spark.read.parquet(target).drop("part")


@register("fact_incremental")  # M23
def fact_incremental(spark, sf_dir):
    """Fact returns built up to a date, then extended with the later rows; equals a full build."""
    from tidemark.operators.facts import COMBINED_COLUMNS, returns_to_rewrite
    from tidemark.plans.upsert import full_refresh, month_partition, upsert
    from tidemark.session import scratch_path

    rows = bars_source(fx.bars_orders(spark, sf_dir))
    split = F.lit(FACT_SPLIT).cast("date")
    target = scratch_path(spark, "fact-incremental")
    first = with_returns(combine_sources(rows.where(F.col("price_date") < split)))
    full_refresh(first, target, month_partition(), sort_cols=["symbol", "price_date"])
    existing = spark.read.parquet(target).drop("part")
    rewrite = returns_to_rewrite(existing, rows.where(F.col("price_date") >= split).select(*COMBINED_COLUMNS, "source"))
    upsert(spark, target, rewrite, ["symbol", "source", "price_date"], ["price_date"], month_partition(),
           sort_cols=["symbol", "price_date"])
    out = spark.read.parquet(target)
    return out.select(
        "symbol", "price_date", "close_price", "prev_close_price", "daily_return", "intraday_range_pct",
        "days_since_prev", "has_data_gap",
    )


@register("stream_landing")  # ST2, SNK1, SRC1
def stream_landing(spark, sf_dir):
    """Landed documents picked up by a stream in several micro-batches, the newest rows logged and read back."""
    from tidemark.session import scratch_path
    from tidemark.sources.landing import write_landing
    from tidemark.streaming.landing_stream import log_bars_stream, read_log

    root = scratch_path(spark, "landing")
    write_landing(fx.raw_nested(spark, sf_dir).repartition(4, "symbol"), root, "bars")
    log = scratch_path(spark, "stream-log")
    log_bars_stream(spark, f"{root}/bars", log, scratch_path(spark, "stream-checkpoint"), max_files_per_trigger=1)
    return _naive_audit(read_log(spark, log).drop("price_ms"))


@register("landing_roundtrip")  # SNK1, SRC2, SRC4: one file a document, its path decoded when it is read
def landing_roundtrip(spark, sf_dir):
    from tidemark.session import scratch_path
    from tidemark.schemas import RAW_BARS
    from tidemark.sources.landing import with_landing_path
    from tidemark.sources.landing_sink import land_documents

    root = scratch_path(spark, "landed")
    land_documents(fx.raw_nested(spark, sf_dir), root, "bars")
    docs = spark.read.schema(RAW_BARS).option("recursiveFileLookup", "true").json(f"{root}/bars")
    return with_landing_path(docs).select(
        "landing_source", "landing_id", "landing_start", "landing_end", F.date_format("landed_at", "yyyyMMddHHmmss").alias("landed_at"),
        F.col("symbol").eqNullSafe(F.col("landing_id")).alias("own_path"), F.size("results").cast("long").alias("points"),
    )


@register("incremental_reread")  # SNK2, SNK5, F15, ST1: raw rows of the last days read again, merged into staging
def incremental_reread(spark, sf_dir):
    """Two raw loads; the second run reads what came after its watermark less the overlap. Equals staging everything."""
    from tidemark.plans.upsert import full_refresh, incremental_watermark, month_partition, upsert
    from tidemark.session import scratch_path
    from tidemark.sources.landing import append_raw, read_raw_since

    docs = fx.raw_nested(spark, sf_dir)
    raw, staging = scratch_path(spark, "reread-raw"), scratch_path(spark, "reread-staging")
    split = F.lit(REREAD_SPLIT).cast("timestamp")
    append_raw(docs.where(F.col("__de_processed_at") < split), raw)
    full_refresh(stage_bars(spark.read.parquet(raw)), staging, month_partition(), sort_cols=["symbol", "price_date"])
    append_raw(docs.where(F.col("__de_processed_at") >= split), raw)
    fresh = read_raw_since(spark, raw, incremental_watermark(spark, staging))
    # Overlapping days of both loads: the row of the later ingestion stays.
    upsert(spark, staging, stage_bars(fresh.drop("ingest_date")), ["symbol", "price_date"], ["__de_processed_at"],
           month_partition(), prefer="latest", sort_cols=["symbol", "price_date"])
    return _naive_audit(spark.read.parquet(staging).drop("part"))
