"""All tunable numbers in one typed object."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Event names and what the item-day table calls them.
    allowed_events: tuple[str, ...] = ("view", "addtocart", "removefromcart", "transaction")
    event_columns: dict[str, str] = field(
        default_factory=lambda: {"view": "views", "addtocart": "adds", "transaction": "sales"}
    )
    # Optional filters of cleaned events: off unless set.
    max_events_per_day: int | None = None
    min_interactions: int | None = None
    drop_missing_category: bool = False
    # Item-day windows, lags and smoothing strengths.
    windows: tuple[int, ...] = (3, 7, 14, 30, 60)
    lags: tuple[int, ...] = (1, 7, 14)
    ratio_alpha: float = 10.0
    sales_alpha: float = 5.0
    horizon_days: int = 7
    price_scope: str = "global"
    # Sequences and sessions.
    max_sequence: int = 50
    category_fanout: bool = False
    session_gap_minutes: int = 30
    # Forecast model.
    validation_days: int = 7
    folds: int = 5
    weight_floor_baseline: float = 0.1
    weight_floor_tuned: float = 0.5
    # Gates: forecast wMAPE at most, hit rate and NDCG at least.
    max_wmape: float = 0.10
    min_hit_rate: float = 0.35
    min_ndcg: float = 0.14
    top_k: int = 20
