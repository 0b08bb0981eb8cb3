"""End-to-end batch run: landed files -> raw -> staging -> star -> marts -> checks.

    spark-submit --py-files tidemark.zip tidemark/plans/job.py --landing <landing dir> \
        --warehouse <warehouse dir> --as-of 2026-03-13 [--full-refresh] [--benchmark bitcoin]
        [--lookback-days 365] [--rolling-method blocks|frames|prefix] [--threads 4]
        [--window-start 2026-03-01 --window-end 2026-03-13]

Each layer is written before the next reads it: the written table cuts the
lineage (an executor lost later never re-runs earlier layers) and every
consumer of the fact reads it from storage instead of recomputing it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import BENCHMARK, LOOKBACK_DAYS, REFERENCE_ASSETS
from tidemark.operators import correlation, relative
from tidemark.operators.dims import dim_assets, dim_dates
from tidemark.operators.facts import bars_source, chart_source, combine_sources, dirty_returns, fact_daily_prices, with_dimensions
from tidemark.operators.rolling import lookback, rolling_performance
from tidemark.operators.staging import BAR_VALUE_COLUMNS, stage_bars, stage_market_chart
from tidemark.plans.checks import run_job_checks
from tidemark.plans.sizing import bounded_broadcast
from tidemark.plans.upsert import full_refresh, incremental_watermark, month_partition, table_exists, upsert
from tidemark.schemas import RAW_BARS, RAW_CHART, REGISTRY
from tidemark.session import build_session, scratch_path
from tidemark.sources.commits import read_committed, remove
from tidemark.sources.statistics import stored_bounds
from tidemark.sources.landing import LOAD, load_once, read_raw, read_raw_since, read_with_rejects, refetch_plan, with_audit


def cut_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _overwrite(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_raw(
    spark: SparkSession,
    landing: str,
    wh: str,
    run_id: str,
    bars_files: list[str] | None = None,
    chart_files: list[str] | None = None,
) -> None:
    """Landed JSON -> append-only raw tables, each landed file once.

    SRC3: pass the exact files a fetch produced (``bars_files``,
    ``chart_files``) to load only those; otherwise the source folders under
    ``landing`` are read. Files that an earlier run loaded are left out either
    way (``load_once``); a run that fails between the two sources loads the
    other one when it is run again. Lines that are no documents go to
    ``rejected/<source>`` and fail the run before anything is appended."""

    def judged(source: str, paths, schema, key: str) -> tuple[int, DataFrame, str, str]:
        docs, bad = read_with_rejects(spark, paths, schema)
        raw = f"{wh}/raw/{source}"
        loaded = read_committed(spark, raw, LOAD)
        if loaded is not None:
            bad = bad.join(loaded.select(F.col("__file").alias("file_path")).distinct(), "file_path", "left_anti")
        n = _overwrite(bad, f"{wh}/rejected/{source}").count()
        return n, with_audit(docs, run_id), raw, key

    landed = (
        ("bars", bars_files or f"{landing}/bars", RAW_BARS, "symbol"),
        ("chart", chart_files or f"{landing}/chart", RAW_CHART, "coin_id"),
    )
    # The two sources know nothing of each other: their Spark jobs run side by side.
    with ThreadPoolExecutor(max_workers=len(landed)) as pool:
        loads = list(pool.map(lambda source: judged(*source), landed))
        rejected = sum(n for n, *_ in loads)
        if rejected:
            raise ValueError(f"{rejected} landed lines are malformed; see {wh}/rejected")
        list(pool.map(lambda load: load_once(*load[1:]), loads))


# Source: the staging operator, which of several rows of a key stays, the combined layout.
SOURCES = {
    "bars": (stage_bars, ["__de_processed_at", *BAR_VALUE_COLUMNS], bars_source),
    "chart": (stage_market_chart, ["__de_processed_at", "close_price", "volume", "market_cap"], chart_source),
}
KEYS = ["symbol", "price_date"]
CHANGE = "change"


def read_staging(spark: SparkSession, wh: str) -> tuple[DataFrame, DataFrame]:
    bars, chart = (spark.read.parquet(f"{wh}/staging/{name}").drop("part") for name in SOURCES)
    return bars, chart


def build_staging(spark: SparkSession, wh: str, full: bool) -> tuple[DataFrame, DataFrame]:
    """Staging with the 3-day re-read overlap (SNK5) and the merge (SNK4).

    Of the rows read again only those that differ from the staged ones are merged. They are
    committed to ``pending/<source>`` first and stay there until the marts have
    taken them over, so a run that fails in between leaves nothing behind that
    the next run does not know of.
    """

    def merge(name: str) -> None:
        stage, order, _ = SOURCES[name]
        target = f"{wh}/staging/{name}"
        mark = None if full else incremental_watermark(spark, target)
        staged = stage(read_raw_since(spark, f"{wh}/raw/{name}", mark).drop("ingest_date", "__file"))
        if mark is None:
            full_refresh(staged, target, month_partition(), sort_cols=KEYS)
            return
        change = f"{wh}/pending/{name}/{CHANGE}={uuid.uuid4().hex}"
        changed_rows(staged, spark.read.parquet(target)).write.parquet(change)
        rows = spark.read.schema(staged.schema).parquet(change)
        if rows.isEmpty():
            remove(spark, change)
        else:
            upsert(spark, target, rows, KEYS, order, month_partition(), sort_cols=KEYS, stored=True)

    with ThreadPoolExecutor(max_workers=len(SOURCES)) as pool:
        list(pool.map(merge, SOURCES))
    return read_staging(spark, wh)


def changed_rows(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose key ``stored`` (a table by month) lacks or has with other values."""
    columns = fresh.columns
    old = stored.select(F.col("part").alias("__part"), *[F.col(k).alias(f"__old_{k}") for k in KEYS], F.struct(*columns).alias("__old"))
    same = [F.col(k).eqNullSafe(F.col(f"__old_{k}")) for k in KEYS]
    joined = fresh.withColumn("__month", month_partition()).join(old, same[0] & same[1] & F.col("__month").eqNullSafe(F.col("__part")), "left")
    return joined.where(~F.struct(*columns).eqNullSafe(F.col("__old"))).select(*columns)


def settings_of(registry: DataFrame, benchmark: str, lookback_days: int) -> str:
    """What the marts depend on besides the staged rows; another value rebuilds them."""
    rows = registry.agg(F.count("*"), F.sum(F.xxhash64(*registry.columns).cast("decimal(38,0)"))).first()
    return json.dumps([benchmark, lookback_days, rows[0], str(rows[1])])


def read_state(spark: SparkSession, wh: str) -> dict | None:
    """The settings, day and failing rows of the last run that went to its end."""
    if not table_exists(spark, f"{wh}/state"):
        return None
    row = spark.read.parquet(f"{wh}/state").first()
    return None if row is None else {"settings": row["settings"], "as_of": row["as_of"], "failing": json.loads(row["failing"])}


def write_state(spark: SparkSession, wh: str, settings: str, as_of: str, failing: dict[str, int]) -> None:
    row = spark.createDataFrame([(settings, as_of, json.dumps(failing))], "settings string, as_of string, failing string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{wh}/state")


def pending_keys(spark: SparkSession, wh: str) -> DataFrame | None:
    """symbol, source, price_date of the changes that the marts have not taken over."""
    out = None
    for name in SOURCES:
        rows = read_committed(spark, f"{wh}/pending/{name}", CHANGE)
        if rows is not None:
            keys = rows.select("symbol", F.lit(name).alias("source"), "price_date")
            out = keys if out is None else out.unionByName(keys)
    return out


def build_fact(spark: SparkSession, wh: str, sources: DataFrame, assets: DataFrame, dates: DataFrame, updated, dirty: DataFrame | None) -> DataFrame:
    """The fact, by month: rebuilt, or only the rows that the ``dirty`` keys touch (M23). Returns the touched rows' keys.

    A calendar that has grown also dirties the rows whose date it lacked before.
    """
    path = f"{wh}/marts/fact_daily_prices"
    side = bounded_broadcast(assets)
    if dirty is None:
        fact = fact_daily_prices(sources, side, dates, updated_at=updated, keep_source=True)
        full_refresh(fact, path, month_partition(), sort_cols=KEYS)
        return None
    lacked = spark.read.parquet(path).where("date_key is null").select("symbol", "source", "price_date")
    days = bounded_broadcast(dates.select(F.col("date_key").alias("price_date")))
    dirty = dirty.unionByName(lacked.join(days, "price_date", "left_semi"))
    rows = cut_to(with_dimensions(dirty_returns(sources, dirty), side, dates, updated, keep_source=True), scratch_path(spark, "fact-rows"))
    upsert(spark, path, rows, ["symbol", "source", "price_date"], ["price_date"], month_partition(), sort_cols=KEYS, stored=True)
    return rows.select(*KEYS).distinct()


def read_fact(spark: SparkSession, wh: str) -> DataFrame:
    return spark.read.parquet(f"{wh}/marts/fact_daily_prices").drop("source")


def build_rolling(
    spark: SparkSession, wh: str, fact: DataFrame, latest: dt.date, lookback_days: int, method: str, updated, dirty: DataFrame | None
) -> DataFrame:
    """The rolling mart: rebuilt, or only the dates whose windows hold a ``dirty`` row; the others are kept.

    The mart covers the look-back, so what is written is bounded by it.
    """
    path = f"{wh}/marts/rolling_performance"
    if dirty is None:
        return _overwrite(rolling_performance(fact, lookback_days=lookback_days, method=method, updated_at=updated, anchor=latest), path)
    marks = dirty.select(*[F.col(k).alias(f"__d_{k}") for k in KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"__d_{k}")) for k in KEYS]
    names = marks.select("__d_symbol").distinct()
    near = fact.join(names, same[0], "left_semi").join(marks, same[0] & same[1], "left")
    near = near.withColumn("__changed", F.col("__d_price_date").isNotNull()).drop("__d_symbol", "__d_price_date")
    rows = rolling_performance(near, lookback_days=lookback_days, method=method, updated_at=updated, touched="__changed", anchor=latest)
    rows = cut_to(rows, scratch_path(spark, "rolling-rows"))
    old = lookback(spark.read.parquet(path), latest, lookback_days)
    taken = rows.select(*[F.col(k).alias(f"__d_{k}") for k in KEYS]).distinct()
    kept = old.join(taken, same[0] & same[1], "left_anti")
    whole = cut_to(kept.unionByName(rows), scratch_path(spark, "rolling-whole"))
    return _overwrite(whole, path)


def build_marts(
    spark: SparkSession, wh: str, fact: DataFrame, latest: dt.date, rolling: DataFrame, benchmark: str, lookback_days: int, threads: int, updated
) -> None:
    """The marts over the look-back. They run as concurrent Spark jobs (the reference builds its model graph
    with 4 threads); each one reads the written fact or rolling table."""

    def relative_marts() -> None:
        # After the look-back, the benchmark has at most one row per day and source.
        rel = _overwrite(
            relative.relative_performance(rolling, benchmark, benchmark_rows_bound=2 * (lookback_days + 1), updated_at=updated),
            f"{wh}/marts/relative_performance",
        )
        _overwrite(relative.latest_summary(rel, updated_at=updated), f"{wh}/marts/asset_performance_summary_latest")

    with ThreadPoolExecutor(max_workers=threads) as pool:
        made = [
            pool.submit(relative_marts),
            pool.submit(lambda: _overwrite(relative.ranked_summary(rolling, benchmark), f"{wh}/marts/asset_performance_summary")),
            pool.submit(
                lambda: _overwrite(
                    correlation.volatility_correlation_summary(fact, lookback_days, updated_at=updated, anchor=latest),
                    f"{wh}/marts/volatility_correlation_summary",
                )
            ),
        ]
        for future in made:
            future.result()


def run(
    spark: SparkSession,
    landing: str,
    wh: str,
    as_of: str,
    full: bool = False,
    benchmark: str = BENCHMARK,
    lookback_days: int = LOOKBACK_DAYS,
    run_id: str = "manual",
    registry: DataFrame | None = None,
    rolling_method: str = "blocks",
    threads: int = 4,
    bars_files: list[str] | None = None,
    chart_files: list[str] | None = None,
    window: tuple[str, str] | None = None,
) -> dict[str, int]:
    """One run; failing rows of every check by name.

    ``full`` rebuilds every table. Otherwise a changed staging row dirties its
    fact row and the next one of its series, and these dirty the rolling rows
    whose windows reach back to them; only dirty rows are computed again (M23). A run
    without a changed row, on the day and with the settings of the last one, has nothing to do and
    gives the last run's checks. ``window`` (first and last day) writes what that window still lacks
    to ``refetch_plan`` (SRC8, SRC10).
    """
    load_raw(spark, landing, wh, run_id, bars_files, chart_files)
    reg = registry if registry is not None else spark.createDataFrame(REFERENCE_ASSETS, REGISTRY)
    settings, last = settings_of(reg, benchmark, lookback_days), read_state(spark, wh)
    kept = [f"{wh}/marts/{name}" for name in ("fact_daily_prices", "rolling_performance")]
    full = full or last is None or last["settings"] != settings or not all(table_exists(spark, path) for path in kept)
    stg_bars, stg_chart = build_staging(spark, wh, full)
    dirty = None if full else pending_keys(spark, wh)
    if window is not None:
        days = stg_bars.select(*KEYS).unionByName(stg_chart.select(*KEYS))
        _overwrite(refetch_plan(reg, days, *window), f"{wh}/marts/refetch_plan")
    if not full and dirty is None and last["as_of"] == as_of:
        return last["failing"]
    # Until this run ends, a later one has something to do: all of it after a full run, else what is pending.
    if not full:
        write_state(spark, wh, settings, "", last["failing"])
    elif last is not None:
        remove(spark, f"{wh}/state")
    updated = F.current_timestamp()
    assets = _overwrite(dim_assets(reg, stg_bars, stg_chart, updated_at=updated), f"{wh}/marts/dim_assets")
    dates = _overwrite(dim_dates(assets, as_of=as_of), f"{wh}/marts/dim_dates")
    if full or dirty is not None:
        sources = combine_sources(bars_source(stg_bars), chart_source(stg_chart))
        touched = build_fact(spark, wh, sources, assets, dates, updated, dirty)
        fact = read_fact(spark, wh)
        latest = stored_bounds(spark, f"{wh}/marts/fact_daily_prices", "price_date")[1]
        rolling = build_rolling(spark, wh, fact, latest, lookback_days, rolling_method, updated, touched)
        build_marts(spark, wh, fact, latest, rolling, benchmark, lookback_days, threads, updated)
    mart = lambda name: spark.read.parquet(f"{wh}/marts/{name}")
    tables = {
        "raw_bars": read_raw(spark, f"{wh}/raw/bars"),
        "raw_chart": read_raw(spark, f"{wh}/raw/chart"),
        "stg_bars": stg_bars,
        "stg_chart": stg_chart,
        "dim_assets": assets,
        "dim_dates": dates,
        "fact": read_fact(spark, wh).drop("part"),
        "rolling": mart("rolling_performance"),
        "relative": mart("relative_performance"),
        "latest": mart("asset_performance_summary_latest"),
        "correlation": mart("volatility_correlation_summary"),
    }
    failing = run_job_checks(tables, reg, benchmark, wh, threads)
    write_state(spark, wh, settings, as_of, failing)
    if table_exists(spark, f"{wh}/pending"):
        remove(spark, f"{wh}/pending")
    return failing


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--benchmark", default=BENCHMARK)
    p.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    p.add_argument("--run-id", default="manual")
    p.add_argument("--rolling-method", choices=("blocks", "frames", "prefix"), default="blocks")
    p.add_argument("--threads", type=int, default=4, help="marts and checks built concurrently")
    p.add_argument("--bars-files", default="", help="comma-separated landed bar files of this run")
    p.add_argument("--chart-files", default="", help="comma-separated landed chart files of this run")
    p.add_argument("--window-start", default="", help="first day of the fetch window: writes what it lacks to refetch_plan")
    p.add_argument("--window-end", default="", help="last day of the fetch window")
    a = p.parse_args(argv)
    spark = build_session()
    failing = run(spark, a.landing, a.warehouse, a.as_of, a.full_refresh, a.benchmark, a.lookback_days, a.run_id,
                  rolling_method=a.rolling_method, threads=a.threads,
                  bars_files=[f for f in a.bars_files.split(",") if f] or None,
                  chart_files=[f for f in a.chart_files.split(",") if f] or None,
                  window=(a.window_start, a.window_end) if a.window_start and a.window_end else None)
    bad = {k: v for k, v in failing.items() if v}
    if bad:
        raise SystemExit(f"data checks failed: {bad}")


if __name__ == "__main__":
    main()
