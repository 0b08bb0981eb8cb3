"""Declared schemas: landing files are read with these, never inferred."""

from pyspark.sql import types as T

BAR_POINT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds, UTC
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

# One landed document per symbol and fetch window, bars nested.
RAW_BARS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("fetch_start", T.StringType()),
        T.StructField("fetch_end", T.StringType()),
        T.StructField("results", T.ArrayType(BAR_POINT)),
        T.StructField("__de_processed_at", T.TimestampType()),
        T.StructField("__run_id", T.StringType()),
    ]
)

# One landed document per coin and fetch window, payload kept as JSON text.
RAW_CHART = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("vs_currency", T.StringType()),
        T.StructField("fetch_start", T.StringType()),
        T.StructField("fetch_end", T.StringType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("__de_processed_at", T.TimestampType()),
        T.StructField("__run_id", T.StringType()),
    ]
)

# Parsed chart payload: each series is a list of [epoch ms, value] pairs.
# Elements are kept as JSON text (a number token keeps its literal text) and
# cast per value, like extracting a JSON scalar and casting it: a quoted
# number still parses, and one bad value nulls only itself.
CHART_PAYLOAD = T.StructType(
    [
        T.StructField("prices", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("total_volumes", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("market_caps", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

STG_BARS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price_date", T.DateType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("__de_processed_at", T.TimestampType()),
        T.StructField("__run_id", T.StringType()),
    ]
)

STG_CHART = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("vs_currency", T.StringType()),
        T.StructField("price_date", T.DateType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("__de_processed_at", T.TimestampType()),
        T.StructField("__run_id", T.StringType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("asset_type", T.StringType()),
        T.StructField("asset_name", T.StringType()),
        T.StructField("asset_class", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("is_benchmark", T.BooleanType()),
    ]
)
