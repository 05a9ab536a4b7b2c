"""Dataset columns, enumerations, thresholds and rule lists.

Everything here is a fixed value: results are only right when these equal the
published data model, so they are stated as plain text in natural order.
"""

from __future__ import annotations

# --- fixed values: columns of the ten input datasets, in file order -------------
FUND_MASTER = (
    "amfi_code", "fund_house", "scheme_name", "category", "sub_category", "plan",
    "launch_date", "benchmark", "expense_ratio_pct", "exit_load_pct",
    "min_sip_amount", "min_lumpsum_amount", "fund_manager", "risk_category",
    "sebi_category_code",
)
NAV_HISTORY = ("amfi_code", "date", "nav")
AUM_BY_FUND_HOUSE = ("date", "fund_house", "aum_lakh_crore", "aum_crore", "num_schemes")
MONTHLY_SIP_INFLOWS = (
    "month", "sip_inflow_crore", "active_sip_accounts_crore", "new_sip_accounts_lakh",
    "sip_aum_lakh_crore", "yoy_growth_pct",
)
CATEGORY_INFLOWS = ("month", "category", "net_inflow_crore")
INDUSTRY_FOLIO_COUNT = (
    "month", "total_folios_crore", "equity_folios_crore", "debt_folios_crore",
    "hybrid_folios_crore", "others_folios_crore",
)
SCHEME_PERFORMANCE = (
    "amfi_code", "scheme_name", "fund_house", "category", "plan", "return_1yr_pct",
    "return_3yr_pct", "return_5yr_pct", "benchmark_3yr_pct", "alpha", "beta",
    "sharpe_ratio", "sortino_ratio", "std_dev_ann_pct", "max_drawdown_pct",
    "aum_crore", "expense_ratio_pct", "morningstar_rating", "risk_grade",
)
INVESTOR_TRANSACTIONS = (
    "investor_id", "transaction_date", "amfi_code", "transaction_type", "amount_inr",
    "state", "city", "city_tier", "age_group", "gender", "annual_income_lakh",
    "payment_mode", "kyc_status",
)
PORTFOLIO_HOLDINGS = (
    "amfi_code", "stock_symbol", "stock_name", "sector", "weight_pct",
    "market_value_cr", "current_price_inr", "portfolio_date",
)
BENCHMARK_INDICES = ("date", "index_name", "close_value")

# --- fixed values: the performance columns that must be numeric ------------------
PERFORMANCE_METRICS = (
    "return_1yr_pct", "return_3yr_pct", "return_5yr_pct", "benchmark_3yr_pct", "alpha",
    "beta", "sharpe_ratio", "sortino_ratio", "std_dev_ann_pct", "max_drawdown_pct",
    "aum_crore", "expense_ratio_pct", "morningstar_rating",
)
FUND_METADATA = (
    "scheme_name", "fund_house", "category", "sub_category", "benchmark",
    "expense_ratio_pct",
)

# --- fixed values: tokens a CSV reader of this data treats as missing ------------
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: enumerations and the spellings that map onto them -------------
PLANS = ("Regular", "Direct")
TRANSACTION_TYPES = ("SIP", "Lumpsum", "Redemption")
KYC_STATUSES = ("Verified", "Pending")
TRANSACTION_SPELLINGS = {
    "sip": "SIP",
    "SIP": "SIP",
    "lumpsum": "Lumpsum",
    "Lumpsum": "Lumpsum",
    "lump sum": "Lumpsum",
    "Lump Sum": "Lumpsum",
    "lump-sum": "Lumpsum",
    "redemption": "Redemption",
    "Redemption": "Redemption",
}
KYC_SPELLINGS = {
    "verified": "Verified",
    "Verified": "Verified",
    "pending": "Pending",
    "Pending": "Pending",
}
AGE_GROUPS = ("18-25", "26-35", "36-45", "46-55", "56+")

# --- fixed values: thresholds ----------------------------------------------------
EXPENSE_RATIO_RANGE = (0.1, 2.5)
PERIODS_PER_YEAR = 252
RISK_FREE_RATE = 0.065
DAYS_PER_YEAR = 365.25
MIN_REGRESSION_ROWS = 30
MARKET_INDEX = "NIFTY100"
COMPARISON_INDICES = ("NIFTY50", "NIFTY100")
INR_PER_CRORE = 10_000_000

# --- fixed values: words in a benchmark name -> index key, first hit wins ---------
# "NIFTY 500 ..." contains "NIFTY 50" and therefore maps to NIFTY50; the published
# scorecard depends on it. ``strict`` order tries the longer name first.
BENCHMARK_RULES = (
    ("NIFTY 50", "NIFTY50"),
    ("NIFTY 100", "NIFTY100"),
    ("NIFTY 500", "NIFTY500"),
    ("MIDCAP", "NIFTY_MIDCAP150"),
    ("SMALL", "BSE_SMALLCAP"),
    ("LIQUID", "CRISIL_LIQUID"),
    ("GILT", "CRISIL_GILT"),
    ("BOND", "CRISIL_GILT"),
    ("DEBT", "CRISIL_GILT"),
)
DEFAULT_BENCHMARK = "NIFTY100"

# --- fixed values: scorecard parts (metric, ascending, weight) -------------------
SCORECARD_PARTS = {
    "3y_return": ("cagr_3y_pct", "rank_3y_return", False, 0.30),
    "sharpe": ("sharpe_ratio", "rank_sharpe", False, 0.25),
    "alpha": ("alpha_annualized_pct", "rank_alpha", False, 0.20),
    "expense": ("expense_ratio_pct", "rank_expense_inverse", True, 0.15),
    "drawdown": ("max_drawdown_pct", "rank_max_drawdown_inverse", False, 0.10),
}

# --- fixed values: anomaly codes, in reporting order ------------------------------
ANOMALY_CODES = (
    "expense_ratio_out_of_range", "high_sharpe_ratio", "sharpe_matches_return_3yr",
    "high_sortino_ratio", "positive_max_drawdown", "extreme_return_1yr",
    "beta_out_of_range", "invalid_morningstar_rating",
)

# --- fixed values: the six schemes pulled from the live price service ------------
LIVE_SCHEMES = {
    "HDFC_Top_100_Direct": 125497,
    "SBI_Bluechip": 119551,
    "ICICI_Bluechip": 120503,
    "Nippon_Large_Cap": 118632,
    "Axis_Bluechip": 119092,
    "Kotak_Bluechip": 120841,
}

# --- fixed values: phrases shortened in chart labels ------------------------------
LABEL_REPLACEMENTS = (
    (" Fund - Regular - Growth", ""),
    (" - Regular - Growth", ""),
    (" Fund - Regular Plan - Growth", ""),
    ("HDFC Mid-Cap Opportunities", "HDFC Mid-Cap Opps"),
)
