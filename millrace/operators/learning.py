"""Logistic classifiers over sparse features: training, scoring, and ensembles.

Instances are ``(doc_id, model_id, label, features)`` with one row per ``doc_id``, a label of 0.0 or
1.0, and an array of features in which a feature may occur several times; ``model_id`` says which
model the instance trains. Models are ``(model_id, feature, weight)``. A feature that a model does not
know weighs 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scores import label_of, sigmoid
from millrace.operators import skew
from millrace.session import fresh_path, in_buckets, write_and_read, write_bucketed

# Fixed value: the step of one update.
DELTA = 0.002

ENSEMBLE_METHODS = ("average", "vote")
# Features up to this number have their weights broadcast (some 150 MB at most, and 8 bytes for each feature and model).
BROADCAST_FEATURES = 1_000_000


def feature_counts(instances: DataFrame) -> DataFrame:
    """``(doc_id, model_id, label, feature, n)``."""
    # The outer form, because the plain one would add a filter below that computes the features once more.
    occurrences = instances.select("doc_id", "model_id", "label", F.explode_outer("features").alias("feature"))
    known = occurrences.where(F.col("feature").isNotNull())
    return known.groupBy("doc_id", "model_id", "label", "feature").agg(F.count("*").alias("n"))


def train_batch(
    instances: DataFrame,
    epochs: int = 1,
    delta: float = DELTA,
    average: bool = True,
    rows_per_split: int = skew.ROWS_PER_SPLIT,
) -> DataFrame:
    """Train all models at once by gradient steps over all instances of a model.

    A step adds delta times the sum over the instances of (label - probability) * occurrences to each
    weight; with ``average`` the sum is divided by the number of the model's instances, so that the
    step does not grow with the data. The counts are written once, bucketed by document: scores and
    gradients then need no further move of them unless the weights are too many to be broadcast, which
    Spark decides by their size; frequent features are then spread. Each epoch's weights are written,
    which cuts the lineage.
    """
    if epochs < 1:
        raise ValueError("at least one epoch is needed")
    spark = instances.sparkSession
    # Features are counted where their document's bucket is, so they move once, as arrays.
    placed = feature_counts(in_buckets(instances, "doc_id"))
    counts = write_bucketed(placed, "feature_counts", "doc_id", placed=True)
    try:
        base = fresh_path(spark, "weights")
        # Written, so that a literal model name stays a column to join on.
        sizes = write_and_read(instances.groupBy("model_id").agg(F.count("*").alias("instances")), f"{base}/sizes")
        scale = delta / F.col("instances") if average else F.lit(delta)
        scales = sizes.select("model_id", scale.alias("scale"))
        key = ("model_id", "feature")
        documents = write_and_read(counts.table.groupBy(*key).agg(F.count("*").alias("documents")), f"{base}/documents")
        hot = skew.hot_keys(documents, key, "documents", rows_per_split)
        weights = _stepped(counts.table.withColumn("residual", F.col("label") - 0.5), scales)
        # All weights are zero at first, so every probability is one half.
        weights = write_and_read(weights, f"{base}/epoch0001")
        for epoch in range(1, epochs):
            known = skew.join_spread(counts.table, weights, key, "doc_id", hot, rows_per_split)
            score = F.sum(F.col("n") * F.col("weight"))
            residual = F.col("label") - sigmoid(F.col("score"))
            scored = known.groupBy("doc_id", "label").agg(score.alias("score")).select("doc_id", residual.alias("residual"))
            step = _stepped(counts.table.drop("label").join(scored, "doc_id"), scales)
            update = weights.unionByName(step).groupBy(*key).agg(F.sum("weight").alias("weight"))
            weights = write_and_read(update, f"{base}/epoch{epoch + 1:04d}")
        return weights
    finally:
        counts.release()


def _stepped(residuals: DataFrame, scales: DataFrame) -> DataFrame:
    """``(model_id, feature, weight)``: what one step adds to each weight."""
    steps = residuals.groupBy("model_id", "feature").agg(F.sum(F.col("residual") * F.col("n")).alias("gradient"))
    return steps.join(scales, "model_id").select("model_id", "feature", (F.col("scale") * F.col("gradient")).alias("weight"))


def model_scores(
    instances: DataFrame, models: DataFrame, model_ids: list, rows_per_split: int = skew.ROWS_PER_SPLIT
) -> DataFrame:
    """``(doc_id, scores)``: the scores by the models of ``model_ids``, in that order, of instances with a feature that any model knows.

    The weights of the features with the largest ones, which are mostly the frequent features, are broadcast, and what they add
    to a document's scores is summed where its features are; only counts of other features are moved, if there are any.
    """
    spark = models.sparkSession
    if not model_ids:
        return instances.select("doc_id", F.array().cast("array<double>").alias("scores")).limit(0)
    # A feature's weights travel together, one for each model.
    each = [F.coalesce(F.sum(F.when(F.col("model_id") == m, F.col("weight"))), F.lit(0.0)) for m in model_ids]
    size = F.sum(F.abs("weight"))
    weights = models.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.array(*each).alias("weights"), size.alias("size"))
    weights = write_and_read(weights, fresh_path(spark, "weights-by-feature"))
    few = weights.count() <= BROADCAST_FEATURES
    first = weights if few else weights.orderBy(F.desc("size"), "feature").limit(BROADCAST_FEATURES)
    if not few:
        first = write_and_read(first, fresh_path(spark, "first-weights"))
    occurrences = instances.select("doc_id", F.explode("features").alias("feature"))
    joined = occurrences.join(F.broadcast(first.drop("size")), "feature", "inner" if few else "left")
    places = range(len(model_ids))
    sums = [F.sum(F.col("weights")[k]).alias(f"s{k}") for k in places]
    scores = F.array(*[F.coalesce(F.sum(f"s{k}"), F.lit(0.0)) for k in places]).alias("scores")
    if few:
        placed = joined.groupBy("doc_id").agg(*sums)
        return placed.select("doc_id", F.array(*[f"s{k}" for k in places]).alias("scores"))
    other = F.when(F.col("weights").isNull(), F.col("feature"))
    # Used for the frequent features and for the join: written, so that texts are cut into words once.
    counted = joined.groupBy("doc_id", other.alias("feature")).agg(F.count("*").alias("n"), *sums)
    counted = write_and_read(counted, fresh_path(spark, "features"))
    features = counted.where(F.col("feature").isNotNull()).select("doc_id", "feature", "n")
    hot = skew.hot_keys(features.groupBy("feature").agg(F.count("*").alias("documents")), "feature", "documents", rows_per_split)
    rest = weights.join(first.select("feature"), "feature", "left_anti").drop("size")
    known = skew.join_spread(features, rest, "feature", "doc_id", hot, rows_per_split)
    moved = known.select("doc_id", *[(F.col("weights")[k] * F.col("n")).alias(f"s{k}") for k in places])
    placed = counted.where(F.col("feature").isNull()).select("doc_id", *[f"s{k}" for k in places])
    return placed.unionByName(moved).groupBy("doc_id").agg(scores)


def _predicted(instances: DataFrame, scores: DataFrame, missing: float) -> DataFrame:
    """Every instance with its score; one without a row in ``scores`` has the score ``missing``."""
    found = instances.select("doc_id", "label").join(scores, "doc_id", "left")
    return found.withColumn("score", F.coalesce("score", F.lit(missing))).withColumn("predicted", label_of(F.col("score")))


def apply_model(
    instances: DataFrame, model: DataFrame, rows_per_split: int = skew.ROWS_PER_SPLIT, texts: DataFrame | None = None
) -> DataFrame:
    """``(doc_id, label, score, predicted)`` of every instance by a single model ``(feature, weight)``.

    The label may be null: it is passed on, not used. ``texts`` are the same instances ``(doc_id, features)`` before their labels were
    looked up, so that features need not be moved for that.
    """
    single = model.select(F.lit(0).alias("model_id"), "feature", "weight")
    scores = model_scores(instances if texts is None else texts, single, [0], rows_per_split)
    return _predicted(instances, scores.select("doc_id", F.col("scores")[0].alias("score")), 0.0)


def apply_ensemble(
    instances: DataFrame,
    models: DataFrame,
    method: str = "average",
    rows_per_split: int = skew.ROWS_PER_SPLIT,
    texts: DataFrame | None = None,
) -> DataFrame:
    """``(doc_id, label, score, predicted)`` of every instance by all models together; ``texts`` as in ``apply_model``.

    ``vote`` adds 1 for each model with a score above 0 and subtracts 1 for each other one;
    ``average`` is the mean of the scores. A model that knows none of an instance's features scores 0.
    """
    if method not in ENSEMBLE_METHODS:
        raise ValueError(f"method must be one of {ENSEMBLE_METHODS}")
    ids = [r.model_id for r in models.select("model_id").distinct().orderBy("model_id").collect() if r.model_id is not None]
    scores = model_scores(instances if texts is None else texts, models, ids, rows_per_split)
    if method == "vote":
        in_favour = F.size(F.filter("scores", lambda s: s > 0))
        votes = scores.select("doc_id", (2 * in_favour - len(ids)).cast("double").alias("score"))
        return _predicted(instances, votes, float(-len(ids)))
    total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + s)
    return _predicted(instances, scores.select("doc_id", (total / len(ids)).alias("score")), 0.0)
