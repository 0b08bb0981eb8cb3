"""Defaults of the price analytics.

Fixed values: they must equal the reference behaviour for equal results.
- rolling windows, in observations: 7, 30, 90, 180, 365
- trading days per year for annualisation: 252
- a gap is a distance between consecutive observations of more than 5 days
- look-back of the marts, in calendar days, anchored on the latest date: 365
- overlap when re-reading raw data incrementally: 3 days of ingestion time
- gap share above which the gap check fails: 0.05
- output rounding: close 4 places, benchmark price 2, returns and
  volatilities 6, ratios and correlations 4
- surrogate key: md5 over the key columns cast to text, joined by "-",
  with a null replaced by the marker "_dbt_utils_surrogate_key_null_"
- the audit column stamped on rebuilt tables: "__dbt_updated_at"
- the benchmark symbol of the reference data: "bitcoin"
- the asset registry of the reference data (symbol, asset_type, asset_name,
  asset_class, currency, exchange, region, is_benchmark), in this order:
    AAPL, stock, Apple Inc., equity, USD, NASDAQ, US, false
    GOOGL, stock, Alphabet Inc., equity, USD, NASDAQ, US, false
    MSFT, stock, Microsoft Corporation, equity, USD, NASDAQ, US, false
    SPY, index, S&P 500 ETF (SPDR), index, USD, NYSE, US, true
    C:EURUSD, forex, Euro / US Dollar, fx, USD, FOREX, Global, false
    C:GBPUSD, forex, British Pound / US Dollar, fx, USD, FOREX, Global, false
    bitcoin, crypto, Bitcoin, crypto, USD, Crypto, Global, true
- accepted asset types: stock, index, forex, crypto
- accepted asset classes: equity, index, fx, crypto
"""

WINDOWS = (7, 30, 90, 180, 365)
TRADING_DAYS = 252
GAP_DAYS = 5
LOOKBACK_DAYS = 365
REINGEST_OVERLAP_DAYS = 3
GAP_SHARE_LIMIT = 0.05

ROUND_PRICE = 4
ROUND_BENCHMARK_PRICE = 2
ROUND_RETURN = 6
ROUND_RATIO = 4

SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
UPDATED_AT = "__dbt_updated_at"

BENCHMARK = "bitcoin"

REFERENCE_ASSETS = [
    ("AAPL", "stock", "Apple Inc.", "equity", "USD", "NASDAQ", "US", False),
    ("GOOGL", "stock", "Alphabet Inc.", "equity", "USD", "NASDAQ", "US", False),
    ("MSFT", "stock", "Microsoft Corporation", "equity", "USD", "NASDAQ", "US", False),
    ("SPY", "index", "S&P 500 ETF (SPDR)", "index", "USD", "NYSE", "US", True),
    ("C:EURUSD", "forex", "Euro / US Dollar", "fx", "USD", "FOREX", "Global", False),
    ("C:GBPUSD", "forex", "British Pound / US Dollar", "fx", "USD", "FOREX", "Global", False),
    ("bitcoin", "crypto", "Bitcoin", "crypto", "USD", "Crypto", "Global", True),
]

ASSET_TYPES = ("stock", "index", "forex", "crypto")
ASSET_CLASSES = ("equity", "index", "fx", "crypto")
