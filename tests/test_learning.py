from math import exp

import pytest
from pyspark.sql import functions as F

import brute
from millrace.operators import learning, skew
from millrace.session import in_buckets, write_bucketed
from millrace.sinks.files import write_model, write_text_model, write_text_models
from millrace.sources.features import is_positive, parse_instances, parse_model, read_model, read_text_models

LINES = ["d1 spam 1 2 2 3", "d2 ham 2 4", "d3 spam 1 1 5", "d4 ham 4 4 6 1", "d5 other 7"]


@pytest.fixture
def labelled(spark):
    return parse_instances(spark.createDataFrame([(line,) for line in LINES], "line string"))


@pytest.fixture
def training(labelled):
    return labelled.withColumn("label", is_positive(F.col("label"))).withColumn("model_id", F.lit("m"))


def plain():
    out = []
    for line in LINES:
        _, label, *features = line.split(" ")
        out.append((1.0 if label == "spam" else 0.0, [int(f) for f in features]))
    return out


def weights_of(df):
    return {int(r.feature): r.weight for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_parsed_instances(labelled):
    got = {r.doc_id: (r.label, r.features) for r in labelled.collect()}
    assert got["d1"] == ("spam", [1, 2, 2, 3]) and got["d5"] == ("other", [7])


def test_models_are_trained_apart(training):
    groups = training.withColumn("model_id", F.when(F.col("doc_id").isin("d1", "d2"), "x").otherwise("y"))
    together = learning.train_batch(groups, 3, 0.5, rows_per_split=1)
    for name in "xy":
        alone = learning.train_batch(groups.where(F.col("model_id") == name), 3, 0.5)
        same(weights_of(together.where(F.col("model_id") == name)), weights_of(alone))


@pytest.mark.parametrize("rows_per_split", [skew.ROWS_PER_SPLIT, 1])
def test_nothing_is_joined_without_a_key(spark, training, models, rows_per_split):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jobs = [learning.apply_model(training, models.where("model_id = 'x'"), rows_per_split)]
        jobs += [learning.apply_ensemble(training, models, method, rows_per_split) for method in learning.ENSEMBLE_METHODS]
        for job in jobs:
            plan = job._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unlabelled_instances_are_scored(labelled, models):
    unlabelled = labelled.withColumn("label", F.when(F.col("doc_id") != "d3", F.col("label")))
    got = {r.doc_id: (r.label, r.score) for r in learning.apply_model(unlabelled, models.where("model_id = 'x'")).collect()}
    assert got["d3"] == (None, 2.0) and len(got) == 5


@pytest.mark.parametrize("average", [True, False])
def test_batch_steps(training, average):
    instances, want = plain(), {}
    for _ in range(3):
        gradient = {}
        for label, features in instances:
            residual = label - 1 / (1 + exp(-sum(want.get(f, 0.0) for f in features)))
            for f in features:
                gradient[f] = gradient.get(f, 0.0) + residual
        scale = 0.5 / (len(instances) if average else 1)
        want = {f: want.get(f, 0.0) + scale * g for f, g in gradient.items()}
    same(weights_of(learning.train_batch(training, 3, 0.5, average)), want)


def test_features_are_counted_in_their_bucket(spark, training):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = learning.feature_counts(in_buckets(training, "doc_id"))
        assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        written = write_bucketed(counted, "counts_test", "doc_id", placed=True)
        per_document = written.table.groupBy("doc_id").agg(F.sum("n").alias("n"))
        assert "Exchange" not in per_document._jdf.queryExecution().executedPlan().toString()
        assert {r.doc_id: r.n for r in per_document.collect()} == {"d1": 4, "d2": 2, "d3": 3, "d4": 4, "d5": 1}
        written.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_epoch_is_needed(training):
    with pytest.raises(ValueError):
        learning.train_batch(training, 0)


@pytest.fixture
def models(spark):
    data = [("x", 1, 1.0), ("x", 2, -0.5), ("y", 1, 0.25), ("y", 4, -1.0), ("z", 9, 3.0)]
    return spark.createDataFrame(data, "model_id string, feature int, weight double")


def test_single_model(labelled, models):
    got = {r.doc_id: (r.label, r.score, r.predicted) for r in learning.apply_model(labelled, models.where("model_id = 'x'")).collect()}
    assert got == {
        "d1": ("spam", 0.0, "ham"),
        "d2": ("ham", -0.5, "ham"),
        "d3": ("spam", 2.0, "spam"),
        "d4": ("ham", 1.0, "spam"),
        "d5": ("other", 0.0, "ham"),
    }


def test_ensemble(labelled, models):
    scores = {"d1": (0.0, 0.25, 0), "d2": (-0.5, -1.0, 0), "d3": (2.0, 0.5, 0), "d4": (1.0, -1.75, 0), "d5": (0, 0, 0)}
    average = {r.doc_id: r.score for r in learning.apply_ensemble(labelled, models).collect()}
    vote = {r.doc_id: (r.score, r.predicted) for r in learning.apply_ensemble(labelled, models, "vote").collect()}
    for doc_id, per_model in scores.items():
        assert abs(average[doc_id] - sum(per_model) / 3) < 1e-12
        votes = float(sum(1 if s > 0 else -1 for s in per_model))
        assert vote[doc_id] == (votes, "spam" if votes > 0 else "ham")
    with pytest.raises(ValueError):
        learning.apply_ensemble(labelled, models, "median")


def test_model_files(spark, models, tmp_path, rows):
    write_model(models, str(tmp_path / "table"))
    assert rows(read_model(spark, str(tmp_path / "table"))) == rows(models)
    one = models.where("model_id = 'x'")
    write_text_model(one, str(tmp_path / "text"))
    lines = spark.read.text(str(tmp_path / "text"))
    assert sorted(r.value for r in lines.collect()) == ["(1,1.0)", "(2,-0.5)"]
    assert rows(parse_model(lines, "value")) == [("1", 1.0), ("2", -0.5)]


def test_each_part_file_is_a_model(spark, tmp_path, rows):
    for k, text in enumerate(["(1,0.5)\n(2,1.5E-4)\n", "(1,-2.0)\n", "(7,3.0)\n"]):
        (tmp_path / f"part-0000{k}").write_text(text)
    assert rows(read_text_models(spark, str(tmp_path))) == [
        ("part-00000", "1", 0.5),
        ("part-00000", "2", 1.5e-4),
        ("part-00001", "1", -2.0),
        ("part-00002", "7", 3.0),
    ]


def test_models_written_as_a_file_each(spark, tmp_path, rows):
    weights = [(m, f"w{i}({m}", i / 8 - 1) for m, n in (("b", 40), ("a", 3), ("c", 1)) for i in range(n)]
    models = spark.createDataFrame(weights, "model_id string, feature string, weight double").repartition(5)
    path = str(tmp_path / "models")
    write_text_models(models, path)
    assert sorted(p.name[:10] for p in (tmp_path / "models").glob("part-*")) == ["part-00000", "part-00001", "part-00002"]
    named = {"a": "part-00000", "b": "part-00001", "c": "part-00002"}
    assert rows(read_text_models(spark, path)) == sorted((named[m], f, w) for m, f, w in weights)


@pytest.mark.parametrize("few", [0, 1, 2, 100])
def test_scores_do_not_depend_on_what_is_broadcast(labelled, models, monkeypatch, few):
    monkeypatch.setattr(learning, "BROADCAST_FEATURES", few)
    test_ensemble(labelled, models)
    test_single_model(labelled, models)


def test_known_features_are_not_moved(labelled, models):
    """Each exchange of the scoring has a row per document and task, and no label is looked up for features."""
    scores = learning.model_scores(labelled.select("doc_id", "features"), models, ["x", "y", "z"])
    plan = scores._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert scores._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_ensemble_of_no_model(labelled, models):
    none = models.where("false")
    for method in learning.ENSEMBLE_METHODS:
        assert [(r.score, r.predicted) for r in learning.apply_ensemble(labelled, none, method).collect()] == [(0.0, "ham")] * 5
