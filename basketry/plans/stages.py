"""The batch run: clean, generate, assemble, rank, serve, evaluate.

Each stage reads the tables published by earlier stages and publishes its own, so a stage
can be re-run alone and a lost cluster costs at most the stage that was running.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.config import (
    AlsConfig,
    CandidateConfig,
    GeneratorConfig,
    RankerConfig,
    ServingConfig,
    SplitConfig,
)
from basketry.operators import candidates as C
from basketry.operators import cleaning as I
from basketry.operators import evaluation as M
from basketry.operators import generators as R
from basketry.operators import quality as Q
from basketry.operators import ranker as K
from basketry.operators import serving as V
from basketry.operators import splits as S
from basketry.operators import weights as W
from basketry.sources import tables as T


@dataclass(frozen=True)
class Settings:
    split: SplitConfig = field(default_factory=SplitConfig)
    als: AlsConfig = field(default_factory=AlsConfig)
    generators: GeneratorConfig = field(default_factory=GeneratorConfig)
    candidates: CandidateConfig = field(default_factory=CandidateConfig)
    ranker: RankerConfig = field(default_factory=RankerConfig)
    serving: ServingConfig = field(default_factory=ServingConfig)


    @classmethod
    def of(cls, values: Mapping[str, Mapping[str, object]]) -> Settings:
        """Settings from nested values such as {"als": {"factors": 64}}; others keep their
        defaults, unknown names are an error."""
        groups = {f.name: f.default_factory for f in fields(cls)}
        unknown = set(values) - set(groups)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        made = {}
        for name, chosen in values.items():
            known = {f.name for f in fields(groups[name])}
            if set(chosen) - known:
                raise ValueError(f"unknown settings of {name}: {sorted(set(chosen) - known)}")
            made[name] = groups[name](
                **{k: tuple(v) if isinstance(v, list) else v for k, v in chosen.items()}
            )
        return cls(**made)


class Stages:
    """All stages over one base folder of published tables."""

    def __init__(self, spark: SparkSession, base: str, settings: Settings = Settings()):
        self.spark, self.base, self.settings = spark, base.rstrip("/"), settings

    def uri(self, name: str) -> str:
        return f"{self.base}/{name}"

    def publish(self, name: str, df: DataFrame, *layout: str) -> DataFrame:
        return T.publish_dataset(df, self.uri(name), drop_previous=True, layout=layout)

    def read(self, name: str, *columns: str) -> DataFrame:
        return T.read_published(self.spark, self.uri(name), columns=columns or None)

    def report(self, name: str, df: DataFrame) -> DataFrame:
        """Keep a small metrics table next to the data and return it."""
        return T.publish_dataset(df.coalesce(1), self.uri(f"metrics/{name}"))

    # Stages -----------------------------------------------------------------------------

    def clean(self, events: str, properties: list[str], categories: str) -> DataFrame:
        """Raw CSV extracts to cleaned tables; returns the quality of the raw tables."""
        raw_events = T.read_csv(self.spark, events, schemas.RAW_EVENTS)
        parts = [T.read_csv(self.spark, p, schemas.RAW_ITEM_PROPERTIES) for p in properties]
        tree = T.read_csv(self.spark, categories, schemas.RAW_CATEGORY_TREE)
        # Converted once: what follows reads typed columns and not text.
        raw = {
            "events": self.publish("raw/events", raw_events),
            "item_properties": self.publish("raw/item_properties", T.union_parts(parts)),
            "category_tree": self.publish("raw/category_tree", tree),
        }
        constants = I.detect_constant_properties(raw["item_properties"])
        # By time, so that a window reads its files only; by property for the reports.
        self.publish("events", I.clean_events(raw["events"]), "timestamp")
        self.publish(
            "item_properties",
            I.clean_item_properties([raw["item_properties"]], constants),
            "property",
            "itemid",
        )
        self.publish("category_tree", I.clean_category_tree(raw["category_tree"]))
        return self.report("quality", Q.quality_summary(raw))

    def _bounds(self) -> DataFrame:
        """Windows as ``generate`` fixed them; events published later do not move them."""
        return self.read("bounds")

    def generate(self) -> DataFrame:
        """Popular items, factorisation lists and similar items from the history."""
        events = self.read("events")
        self.publish("bounds", S.time_boundaries(events, self.settings.split))
        history = S.temporal_split(events, self._bounds()).history
        sizes = self.settings.generators
        self.publish("top_popular", R.top_popular(history, sizes.top_n))
        probability = W.conversion_probability(history)
        # Factorisation reads its input once per iteration.
        weighted = self.publish(
            "interactions", W.weighted_interactions(history, W.event_weights(probability))
        )
        model = R.train_als(weighted, self.settings.als)
        self.publish("personal_als", R.personal_als(model, sizes.top_n))
        self.publish("similar", R.similar_items(model.itemFactors, sizes.similar_n))
        stats = W.interaction_stats(weighted, probability)
        loss = R.als_training_loss(model, weighted, self.settings.als).select("squared_error")
        return self.report("generators", stats.withColumn("squared_error", loss.scalar()))

    def assemble(self) -> DataFrame:
        """Candidates of every user with their features."""
        events = self.read("events")
        candidates = self.publish(
            "candidates",
            C.build_candidates(
                events,
                self._bounds(),
                self.read("top_popular"),
                self.read("personal_als"),
                self.read("similar"),
                self.settings.candidates,
            ),
            "user_id",
            "item_id",
        )
        return self.report("candidates", C.candidate_stats(candidates))

    def rank(self) -> DataFrame:
        """Train on the ranker window, score every candidate, publish ranked lists."""
        events, candidates = self.read("events"), self.read("candidates")
        positives = S.positive_pairs(S.temporal_split(events, self._bounds()).ranker)
        train = self.publish(
            "ranker_train", K.valid_groups(K.label_candidates(candidates, positives))
        )
        model = K.train_ranker(train, self.settings.ranker)
        path = K.save_ranker(model, T.new_version(self.spark, self.uri("ranker")))
        T.point_to(self.spark, self.uri("ranker"), path, 1)
        scored = K.score_candidates(model, candidates, self.settings.ranker.features)
        ranked = K.rank_recommendations(scored).withColumn("rank", F.col("rank").cast("short"))
        self.publish("recommendations", ranked)
        coverage = K.candidate_coverage(positives, candidates).select(F.struct("*").alias("found"))
        stats = K.ranker_train_stats(train).withColumn("found", coverage.scalar())
        return self.report(
            "ranker",
            stats.select(
                "rows",
                "users",
                F.col("positives").alias("positive_rows"),
                "positive_share",
                F.col("found.positives").alias("positive_pairs"),
                F.col("found.found").alias("found_pairs"),
                "found.coverage",
            ),
        )

    def serve(self) -> DataFrame:
        """Top-k lists without bought items; returns the distribution of their scores."""
        served = self.publish(
            "served",
            V.serve_batch(
                self.read("candidates"),
                self.read("events"),
                K.load_ranker(T.published_path(self.spark, self.uri("ranker"))),
                top_k=self.settings.serving.top_k,
            ),
        )
        return self.report("served_scores", V.score_histogram(served))

    def evaluate(self, k: int = 10) -> DataFrame:
        """Popularity, factorisation and final lists on the evaluation window."""
        events = self.read("events")
        bounds = self._bounds()
        truth = M.ground_truth(events, bounds)
        als = self.read("personal_als")
        users = M.eval_users(truth, als, k)
        models = {
            "Top Popular": M.popular_as_recs(self.read("top_popular"), users, k),
            "ALS": M.recs_for_eval(als, users, k),
            "Final Ranker": M.recs_for_eval(self.read("recommendations"), users, k),
        }
        metrics = M.compare_models(
            models,
            M.truth_of(truth, users),
            M.catalog_size(self.read("item_properties", "itemid")),
            M.novelty_map(events, bounds),
            k,
        )
        return self.report("evaluation", metrics)
