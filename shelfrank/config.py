"""Arguments of every stage, grouped, with their default values.

The defaults of scores, thresholds, weights, targets and training are fixed values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class DecayConfig:
    lambda_rate: float = 0.05
    purchase_score: float = 10.0
    cart_score: float = 3.0
    review_score: float = 5.0
    review_threshold: float = 4.0
    days_per_month: float = 30.0


@dataclass(frozen=True)
class BprConfig:
    factors: int = 64
    epochs: int = 30
    learning_rate: float = 0.05
    reg: float = 0.0025
    num_negatives: int = 1
    num_candidates: int = 50
    seed: int = 42
    # How users and books are cut into blocks (book blocks are one or an even number); None follows the data.
    user_blocks: int | None = None
    item_blocks: int | None = None
    batch_size: int = 256
    weighted: bool = False


@dataclass(frozen=True)
class AlsConfig:
    rank: int = 64
    max_iter: int = 20
    reg_param: float = 0.01
    alpha: float = 40.0
    seed: int = 42


@dataclass(frozen=True)
class RerankConfig:
    top_k: int = 5
    batch_size: int = 32
    max_length: int = 512


@dataclass(frozen=True)
class ColdStartConfig:
    min_interactions_for_full: int = 5
    min_book_interactions: int = 3
    pool_size: int = 10
    min_rating: float = 3.5
    purchase_weight: float = 0.6
    rating_weight: float = 0.4
    hybrid_mf_weight: float = 0.3
    hybrid_popularity_weight: float = 0.7


@dataclass(frozen=True)
class EvalConfig:
    recall_k: int = 50
    ndcg_k: int = 5
    map_k: int = 5
    # Quality targets, keyed by metric name without its cut-off (fixed values).
    targets: dict[str, float] = field(
        default_factory=lambda: {
            "recall": 0.75,
            "hit_rate": 0.85,
            "ndcg": 0.35,
            "map": 0.25,
            "mrr": 0.40,
        }
    )


@dataclass(frozen=True)
class CacheConfig:
    ttl_seconds: int = 86400
    # Origin of the forward-decay clock; must stay fixed for the life of a store.
    decay_origin: dt.date = dt.date(2020, 1, 1)
