"""Event weights and the weighted user-item interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import MIN_CONVERSION, PURCHASE_WEIGHT_FACTOR
from basketry.functions.columns import single_value
from basketry.operators.cleaning import normalize_interactions


def conversion_probability(
    train: DataFrame,
    target: str = "addtocart",
    source: str = "view",
    floor: float = MIN_CONVERSION,
) -> DataFrame:
    """One row: share of users with a ``source`` event who also have a ``target`` event.

    A user counts once however many events there are.  The probability is at least
    ``floor``, also when nobody has a ``source`` event.
    """
    users = (
        normalize_interactions(train)
        .where(F.col("event").isin(target, source))
        .groupBy("user_id")
        .agg(
            F.max(F.col("event") == source).alias("_source"),
            F.max(F.col("event") == target).alias("_target"),
        )
    )
    both, sources = F.count_if(F.col("_source") & F.col("_target")), F.count_if("_source")
    return users.agg(
        both.alias("users_with_both"),
        sources.alias("users_with_source"),
        F.greatest(
            both.cast("double") / F.greatest(sources, F.lit(1)).cast("double"), F.lit(floor)
        ).alias("probability"),
    )


def event_weights(probability: DataFrame) -> DataFrame:
    """Three rows: weight of a view, of a cart and of a purchase.

    The rarer carts are among viewers, the more a cart says.
    """
    cart = F.sqrt(1.0 / F.col("probability"))
    pairs = (
        ("view", F.lit(1.0)),
        ("addtocart", cart),
        ("transaction", cart * PURCHASE_WEIGHT_FACTOR),
    )
    rows = F.array(*[F.struct(F.lit(e).alias("event"), w.alias("weight")) for e, w in pairs])
    return probability.select(rows.alias("_rows")).select(F.inline("_rows"))


def weighted_interactions(train: DataFrame, weights: DataFrame) -> DataFrame:
    """Summed weight of every (user, item) pair; events without a weight take no part.

    The weights enter as one map value, so the events are shuffled once, after map-side
    sums per pair.
    """
    table = weights.agg(
        F.map_from_entries(F.collect_list(F.struct("event", "weight"))).alias("weights")
    )
    weight = F.try_element_at(single_value(table, "weights"), F.col("event"))
    return (
        normalize_interactions(train)
        .select("user_id", "item_id", weight.alias("_weight"))
        .where(F.col("_weight").isNotNull())
        .groupBy("user_id", "item_id")
        .agg(F.sum("_weight").alias("weight"))
    )


def interaction_stats(interactions: DataFrame, probability: DataFrame) -> DataFrame:
    """One row: users, items and distinct pairs, with the conversion behind the weights."""
    return interactions.agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("item_id").alias("items"),
        F.count(F.lit(1)).alias("pairs"),
    ).withColumn("p_cart_given_view", single_value(probability, "probability"))
