"""Early stopping by average precision: the curve, the rule and the model it picks."""

import random

import pytest
from pyspark.sql import functions as F

from gaugework.operators.ranking import ranking_metrics
from gaugework.plans import model, staged
from gaugework.session import cut


def precision_steps(rows):
    """Average precision of (score, label) by its definition."""
    positives, out = sum(y for _, y in rows), 0.0
    for s in {s for s, _ in rows}:
        above = [y for t, y in rows if t >= s]
        out += sum(y for t, y in rows if t == s) * sum(above) / len(above)
    return out / positives if positives else 0.0


def test_average_precision_of_every_group(spark):
    draw = random.Random(5)
    # one group holds a third of the rows, scores are tied, one group has no positive, one a single row
    rows = [(draw.choice([1, 1, 1, 2, 3, 4, 5, 6]), draw.randrange(40) / 8, int(draw.random() < 0.2)) for _ in range(3000)]
    rows += [(7, 0.5, 0), (7, 0.25, 0), (8, 1.0, 1)]
    extra = [(None, 1.0, 1), (1, None, 1), (1, 1.0, None)]
    df = spark.createDataFrame(rows + extra, "g int, s double, y int")
    got = {r.g: r.average_precision for r in staged.average_precision_by(df, "g", "s", "y").collect()}
    want = {g: precision_steps([(s, y) for h, s, y in rows if h == g]) for g in range(1, 9)}
    assert got == {g: pytest.approx(v, abs=1e-12) for g, v in want.items()}
    one = ranking_metrics(df.where("g = 1"), "s", "y").first().average_precision
    assert one == pytest.approx(got[1], abs=1e-12)


def stop_by_hand(values, patience):
    best, at = -1.0, 0
    for i, v in enumerate(values, 1):
        if v > best:
            best, at = v, i
        if i - at >= patience:
            return at, i
    return at, len(values)


@pytest.mark.parametrize("seed", range(6))
def test_stops_after_patience(spark, seed):
    draw = random.Random(seed)
    values = [draw.randrange(6) / 10 for _ in range(draw.randrange(1, 40))]
    patience = draw.randrange(1, 9)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "round int, average_precision double")
    rows = staged.stopping_curve(df, patience).orderBy("round").collect()
    at, last = stop_by_hand(values, patience)
    assert [r.round for r in rows if r.chosen] == [at]
    assert max(r.round for r in rows if r.evaluated) == last
    assert [r.best_round for r in rows] == [max(range(1, i + 1), key=lambda k: (values[k - 1], -k)) for i in range(1, len(values) + 1)]


def test_empty_curve(spark):
    assert staged.stopping_curve(spark.createDataFrame([], "round int, average_precision double")).count() == 0


@pytest.fixture(scope="module")
def data(spark):
    """A label that follows one feature, with noise; splits by row number."""
    x, noise = F.rand(3), F.rand(4)
    rows = spark.range(1200).select("id", x.alias("a"), noise.alias("b"), F.rand(9).alias("n"))
    part = F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "validation").otherwise("test")
    return rows.select("a", "b", ((F.col("a") + F.col("n") * 0.5) > 1.0).cast("int").alias("y"), part.alias("dataset_split")).transform(cut)


def test_scores_of_a_round_are_those_of_a_shorter_fit(spark, data):
    rows = model.training_rows(data, ["a", "b"], "y")
    train, held = rows.where("NOT held_out"), rows.where("held_out")
    longer, shorter = (model.boosted(["a", "b"], k, 3).fit(train) for k in (6, 4))
    from pyspark.ml.functions import vector_to_array

    for fitted, k in ((longer, 6), (shorter, 4)):
        want = sorted(r.m for r in fitted.transform(held).select(vector_to_array("rawPrediction")[1].alias("m")).collect())
        got = sorted(r.margin for r in staged.staged_scores(held, longer, "label").where(F.col("round") == k).collect())
        assert got == pytest.approx(want, abs=1e-9)


def test_model_has_the_trees_of_the_best_round(spark, data):
    fitted, curve = staged.fit_stopped(data, ["a", "b"], "y", trees=14, depth=3, patience=3)
    rows = curve.orderBy("round").collect()
    assert [r.round for r in rows] == list(range(1, len(rows) + 1))
    at, last = stop_by_hand([r.average_precision for r in rows], 3)
    assert [r.round for r in rows if r.chosen] == [at] and last == len(rows)
    assert len(fitted.stages[1].trees) == at
    # the curve's best value is what the returned model reaches on the validation split
    scored = model.score(data.where("dataset_split = 'validation'"), fitted, ["a", "b"])
    reached = ranking_metrics(scored, "failure_probability", "y").first().average_precision
    assert reached == pytest.approx(max(r.average_precision for r in rows), abs=1e-6)


def test_the_chosen_rounds_are_not_fitted_again(spark, data, monkeypatch):
    """The first trees of the last fit are the model; they equal those of a fit of so many rounds."""
    grown = []
    monkeypatch.setattr(staged, "boosted", lambda features, trees, depth: grown.append(trees) or model.boosted(features, trees, depth))
    rows = model.training_rows(data, ["a", "b"], "y")
    fitted, curve = staged.grow_stopped(rows, ["a", "b"], trees=14, depth=3, patience=3)
    best = curve.where("chosen").first()["round"]
    assert grown == sorted(set(grown)) and best < grown[-1]
    again = model.boosted(["a", "b"], best, 3).fit(rows.where("NOT held_out"))
    one, other = fitted.stages[1], again.stages[1]
    assert one.toDebugString.split("\n", 1)[1] == other.toDebugString.split("\n", 1)[1] and one.treeWeights == other.treeWeights
    assert (one.numFeatures, one.getMaxIter(), one.featureImportances) == (other.numFeatures, best, other.featureImportances)
    scores = [[r.failure_probability for r in model.score(data, m, ["a", "b"]).orderBy("a").collect()] for m in (fitted, again)]
    assert scores[0] == scores[1]


def test_snapshots_are_built_once(spark, data, monkeypatch):
    """The check, the fit and the evaluation of the query read the rows that were written."""
    from gaugework.queries import monitoring

    built, read = spark.sparkContext.accumulator(0), []

    def counted(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    rows = data.withColumnRenamed("y", monitoring.snap.LABEL)
    monkeypatch.setattr(monitoring, "snapshot_rows", lambda t: rows.mapInArrow(counted, rows.schema))
    monkeypatch.setattr(monitoring, "FEATURES", ["a", "b"])
    fit, judge = staged.grow_stopped, model.evaluate
    monkeypatch.setattr(staged, "grow_stopped", lambda found, features: fit(found, features, 4, 3, 2))
    monkeypatch.setattr(model, "evaluate", lambda found, *more: read.append(found) or judge(found, *more))
    out = monitoring.j05(None).first()
    assert built.value == rows.count() and all("training-" in f for f in read[0].inputFiles())
    assert out.tp + out.fp + out.fn + out.tn == rows.where("dataset_split = 'test'").count()


def test_scores_of_many_rounds_and_single_leaves(spark):
    """The scores are those of the trees one by one, also of trees without a split and where a batch is cut."""
    rows = spark.range(900).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 3 == 0).cast("double").alias("label"), F.lit(1.0).alias("weight")).transform(cut)
    constant = rows.withColumns({"a": F.lit(1.0), "b": F.lit(2.0)})
    for train, depth in ((rows, 4), (constant, 2)):
        fitted = model.boosted(["a", "b"], 7, depth).fit(train)
        got = staged.staged_scores(rows, fitted, "label")
        assert got.dtypes == [("round", "int"), ("margin", "double"), ("label", "double")]
        assembler, ensemble = fitted.stages
        vectors = [r.vector for r in assembler.transform(rows).collect()]
        labels = [r.label for r in rows.collect()]
        want = []
        for v, y in zip(vectors[:40], labels):
            total = 0.0
            for k, (tree, w) in enumerate(zip(ensemble.trees, ensemble.treeWeights), 1):
                total += tree.predict(v) * w
                want.append((k, total, y))
        found = [tuple(r) for r in got.collect()]
        assert len(found) == 900 * 7 and found[: len(want)] == want
