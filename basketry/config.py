"""Tunable parameters and fixed values of the recommendation stages."""

from __future__ import annotations

from dataclasses import dataclass

# Event types, feature columns and histogram bounds that results depend on.
EVENT_TYPES = ("view", "addtocart", "transaction")
POSITIVE_EVENTS = ("addtocart", "transaction")
PURCHASE_EVENT = "transaction"
CATEGORY_PROPERTY = "categoryid"
RANKER_FEATURES = (
    "als_score",
    "als_rank",
    "similarity_score",
    "similarity_rank",
    "popular_score",
    "popular_rank",
)
SCORE_BUCKETS = (-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0)
MIN_CONVERSION = 1e-3
PURCHASE_WEIGHT_FACTOR = 1.3


@dataclass(frozen=True)
class SplitConfig:
    """Length in days of the evaluation window and of the ranker window before it."""

    evaluation_days: int = 7
    ranker_days: int = 7


@dataclass(frozen=True)
class AlsConfig:
    """Implicit-feedback factorisation.

    ``blocks`` divides users and items; unset, there are as many as the cluster has cores.
    """

    factors: int = 32
    regularization: float = 0.05
    alpha: float = 10.0
    iterations: int = 15
    seed: int = 42
    blocks: int | None = None


@dataclass(frozen=True)
class GeneratorConfig:
    """How many rows each candidate generator keeps."""

    top_n: int = 100
    similar_n: int = 50


@dataclass(frozen=True)
class CandidateConfig:
    """How candidates are assembled per user.

    Together with ``GeneratorConfig.top_n`` these bound the candidates of one user by
    ``top_n + history_items * similar_top_n + popular_top_n`` rows.
    """

    history_items: int = 10
    similar_top_n: int = 50
    popular_top_n: int = 10


@dataclass(frozen=True)
class RankerConfig:
    """Boosted trees of the second stage.

    ``bins`` quantile bins per feature: rows that differ only within bins are alike to the
    trees, so finer differences than one bin in 254 are lost.  ``loss`` "pointwise" fits
    labels, "grouped" the order of positives and negatives within a user, in random orders
    around the scores.
    """

    iterations: int = 50
    depth: int = 6
    learning_rate: float = 0.05
    seed: int = 42
    bins: int = 254
    loss: str = "pointwise"
    features: tuple[str, ...] = RANKER_FEATURES


@dataclass(frozen=True)
class ServingConfig:
    top_k: int = 10
