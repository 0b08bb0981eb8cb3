"""Ad-hoc SQL over the written tables (query lifecycle entry 3).

``register_views(spark, warehouse)`` exposes every table the batch job wrote
as a temporary view named like the table, so analyses are plain Spark SQL:

    register_views(spark, "/data/wh")
    spark.sql("SELECT asset_type, count(*) AS n FROM dim_assets GROUP BY asset_type")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.plans.upsert import table_exists

TABLES = {
    "stg_bars": "staging/bars",
    "stg_chart": "staging/chart",
    "dim_assets": "marts/dim_assets",
    "dim_dates": "marts/dim_dates",
    "fact_daily_prices": "marts/fact_daily_prices",
    "rolling_performance": "marts/rolling_performance",
    "relative_performance": "marts/relative_performance",
    "asset_performance_summary_latest": "marts/asset_performance_summary_latest",
    "asset_performance_summary": "marts/asset_performance_summary",
    "volatility_correlation_summary": "marts/volatility_correlation_summary",
}


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Create a temporary view per existing table; returns the view names."""
    made = []
    for view, rel in TABLES.items():
        path = f"{warehouse.rstrip('/')}/{rel}"
        if table_exists(spark, path):
            df = spark.read.parquet(path)
            if "part" in df.columns:
                df = df.drop("part")
            df.createOrReplaceTempView(view)
            made.append(view)
    return made
