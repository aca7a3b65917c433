"""Parameters of the analysis, ranking and preference operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RankingParams:
    """Weights of the hybrid recommendation score. Fixed default values."""

    min_reviews: int = 5
    recency_weight: float = 0.3
    sentiment_weight: float = 0.5
    popularity_weight: float = 0.2
    top_n: int = 20
    prior_count: int = 10
    prior_mean: float = 3.0
    popularity_saturation: int = 50
    decay_rate: float = 0.693
    half_life_days: int = 90
    default_age_days: int = 30


@dataclass(frozen=True)
class Preferences:
    """Filters of one user. ``None`` means the preference was not given.

    An empty ``cuisine_types`` is a given preference that no place can meet.
    """

    min_rating: float | None = None
    cuisine_types: tuple[str, ...] | None = None
    price_range: tuple[int, int] | None = None
    near: tuple[float, float] | None = None
    max_km: float | None = None
