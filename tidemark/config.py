"""Parameters of all jobs; no input or output happens here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

ORDER_COLUMNS = ("sarima_p", "sarima_d", "sarima_q", "seas_p", "seas_d", "seas_q", "sarima_s")
CATALOG_COLUMNS = ("group_key", "sku_list", "business_unit_code", "business_unit_name", "salesforce_feature_mode", *ORDER_COLUMNS)
FEATURES = ("Revenue", "Quantity", "Open_Opportunities", "New_Quotes", "Revenue_new_orders", "Quantity_new_orders")
BACKLOG_FEATURES = ("Backlog", "Backlog_Lag1", "Backlog_Lag3", "Backlog_MA3")
#: Optional catalog column -> the feature that its lag specification shifts.
LAG_COLUMNS = {
    "sf_quantity_lag": "Quantity",
    "sf_new_quotes_lag": "New_Quotes",
    "sf_open_opportunities_lag": "Open_Opportunities",
    "sf_revenue_lag": "Revenue",
    "sf_revenue_new_orders_lag": "Revenue_new_orders",
    "sf_quantity_new_orders_lag": "Quantity_new_orders",
}
#: Weights of the six months before, from the oldest on, for features beyond their last month.
TAIL_WEIGHTS = (0.10, 0.10, 0.15, 0.15, 0.25, 0.25)
KEY = ("Product_Group", "BU")


@dataclass(frozen=True)
class Settings:
    current_month: date = date(2025, 10, 1)
    horizon: int = 12
    holdout: int = 6
    confidence: float = 0.80
    by_bu: bool = True
    use_pipeline: bool = False
    use_backlog: bool = False
    difference_features: bool = False
    non_negative: bool = True
    trim_trailing_zeros: bool = True
    # strategy
    min_series: int = 12
    sarima_min: int | None = 36
    arima_min: int = 12
    min_obs: int = 24
    arima_enabled: bool = True
    ets_enabled: bool = False
    short_order: tuple[int, int, int] = (1, 1, 1)
    short_orders: dict[str, tuple[int, int, int]] = field(default_factory=dict)
    ets_forced: tuple[str, ...] = ()
    ets_weights: tuple[float, float] = (0.5, 0.5)
    ets_period: int = 12
    ets_trend: str | None = "add"
    ets_damped: bool = False
    seasonality_threshold: float = 0.3
    # feature sets by mode
    feature_sets: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "quantity": ("Quantity", "New_Quotes", "Quantity_new_orders"),
            "dollars": ("Revenue", "New_Quotes", "Revenue_new_orders"),
            "default": ("Quantity", "New_Quotes", "Quantity_new_orders"),
        }
    )
    # order selection
    season: int = 12
    burn_in: int = 24
    min_folds: int = 5
    max_folds: int = 6
    volatility: float = 0.5
    shortlist: int = 3
    shortlist_extended: int = 5
    extended_below: int = 48
    max_iterations: int = 200
    max_lag: int = 6
    #: Lags of the residual test, of which the least probability counts; without any, the season.
    ljung_box_lags: tuple[int, ...] = ()
    #: A month grid longer than this is taken for a bad date.
    max_months: int = 1200
