"""tidemark: daily price analytics as Spark DataFrame operators.

Subpackages:
  sources    landed-file scans, landing writes, adapters over the driver tables
  operators  DataFrame -> DataFrame operators (bars, staging, dims, facts, marts, checks)
  functions  column expressions shared by the operators
  plans      composition of operators: star schema, upserts, the batch job, sizing
  streaming  incremental landing -> staging with Structured Streaming
"""

__version__ = "0.1.0"

from tidemark.functions.ranking import global_rank, global_ranks  # noqa: E402
from tidemark.operators.analysis import (  # noqa: E402
    best_by_period,
    dollar_cost_average,
    lump_sum,
    rank_by_excess,
    relative_volatility,
    year_to_date,
)
from tidemark.operators.bars import daily_bars  # noqa: E402
from tidemark.operators.correlation import (  # noqa: E402
    pairwise_correlation,
    recent_returns,
    volatility_correlation_summary,
    volatility_stats,
)
from tidemark.operators.dims import dim_assets, dim_dates  # noqa: E402
from tidemark.operators.facts import (  # noqa: E402
    bars_source,
    chart_source,
    combine_sources,
    fact_daily_prices,
    returns_to_rewrite,
    with_returns,
)
from tidemark.operators.relative import latest_summary, ranked_summary, relative_performance  # noqa: E402
from tidemark.operators.rolling import lookback, rolling_performance  # noqa: E402
from tidemark.operators.staging import latest_per_key, stage_bars, stage_market_chart  # noqa: E402
from tidemark.session import build_session, configure  # noqa: E402
