"""Model contract, scoring checks and prediction monitoring."""

from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from ..functions.classes import recommended_action, risk_level
from ..functions.num import finite_or_zero, r6
from ..functions.when import hours, micros
from ..operators.isotonic import calibrated, isotonic_curve
from ..operators.quality import rule_report
from ..operators.ranking import alert_metrics, ranking_metrics, threshold_by_f1
from ..operators.temporal import with_neighbours
from ..session import scratch_path
from ..streaming import ingest, outcomes as live
from ..plans import model, monitoring as mon, snapshots as snap, staged
from .fleet import LABELLED, POINTS, SPANS, TIMED, WINDOWS, fleet_inputs
from .registry import query
from .roles import THRESHOLD, failures, ntz, predictions, sql
from .streams import event_stream

NOW = datetime(2024, 1, 29)
EVALUATED = "evaluated AS (SELECT event_id AS prediction_id FROM events WHERE event_type = 'view' AND value > 120)"
DUE = """due AS (SELECT p.*, prediction_time + INTERVAL 72 HOURS AS horizon_end FROM predictions p WHERE prediction_time + INTERVAL 72 HOURS <= TIMESTAMP '2024-01-29'
    AND NOT EXISTS (SELECT 1 FROM evaluated e WHERE e.prediction_id = p.prediction_id))"""
OUT = """o AS (SELECT *, CASE WHEN failure_probability >= threshold_used AND a IS NOT NULL THEN 'true_positive' WHEN failure_probability >= threshold_used THEN 'false_positive' WHEN a IS NOT NULL THEN 'false_negative' ELSE 'true_negative' END AS outcome_class,
    (epoch_us(a) - epoch_us(prediction_time)) / 3600000000.0::DOUBLE AS lead FROM (SELECT due.*, (SELECT min(failure_time) FROM failures f WHERE f.machine_id = due.asset_id AND f.failure_time > due.prediction_time AND f.failure_time <= due.horizon_end) AS a FROM due))"""


def evaluated(t):
    return t.events.where("event_type = 'view' AND value > 120").select(F.col("event_id").alias("prediction_id"))


def due(t):
    return mon.mature(predictions(t), evaluated(t), ntz(NOW))


def outcomes(t):
    return mon.outcomes(due(t), failures(t))


@query("m01_mature_predictions", sql("predictions", "SELECT prediction_id, asset_id, horizon_end FROM due", EVALUATED, DUE))
def m01(t):
    return due(t).select("prediction_id", "asset_id", "horizon_end")


@query("m02_outcome_rows", sql("predictions failures", "SELECT prediction_id, horizon_end, a IS NOT NULL AS failure_observed, CASE WHEN a IS NOT NULL THEN asset_id END AS actual_machine_id, a AS actual_failure_time, round(lead, 6) AS lead_time_hours, outcome_class FROM o", EVALUATED, DUE, OUT))
def m02(t):
    return outcomes(t).withColumn("lead_time_hours", r6("lead_time_hours"))


@query("m02_outcomes_as_they_fall_due", sql("predictions failures", "SELECT prediction_id, horizon_end, a IS NOT NULL AS failure_observed, CASE WHEN a IS NOT NULL THEN asset_id END AS actual_machine_id, a AS actual_failure_time, round(lead, 6) AS lead_time_hours, outcome_class FROM o", EVALUATED, DUE, OUT))
def m02b(t):
    """The same rows from two drained streams: predictions are joined with failures that come before or after them."""
    base = scratch_path(t.spark, "m02b")
    predicted = predictions(SimpleNamespace(events=event_stream(t))).withColumns({c: F.col(c).cast("timestamp") for c in ("prediction_time", "feature_time")})
    failed = failures(SimpleNamespace(events=event_stream(t)))
    ingest.append_table(live.matches(predicted, failed, "72 hours"), f"{base}/out", f"{base}/checkpoint")
    found = live.closed(t.spark.read.parquet(f"{base}/out"), F.lit(NOW).cast("timestamp")).join(evaluated(t), "prediction_id", "left_anti")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("horizon_end", "actual_failure_time")}
    return found.withColumns({**times, "lead_time_hours": r6("lead_time_hours")})


@query("m03_outcome_summary", sql("predictions failures", """SELECT count(*) AS evaluated, count(*) FILTER (WHERE outcome_class = 'true_positive') AS tp, count(*) FILTER (WHERE outcome_class = 'false_positive') AS fp,
    count(*) FILTER (WHERE outcome_class = 'false_negative') AS fn, count(*) FILTER (WHERE outcome_class = 'true_negative') AS tn, round(avg(lead) FILTER (WHERE outcome_class = 'true_positive'), 6) AS mean_lead_hours,
    round(count(*) FILTER (WHERE outcome_class = 'true_positive') / nullif(count(*) FILTER (WHERE failure_probability >= threshold_used), 0), 6) AS precision,
    round(count(*) FILTER (WHERE outcome_class = 'true_positive') / nullif(count(*) FILTER (WHERE a IS NOT NULL), 0), 6) AS recall FROM o""", EVALUATED, DUE, OUT))
def m03(t):
    out = mon.outcome_summary(outcomes(t))
    return out.withColumns({c: r6(c) for c in ("mean_lead_hours", "precision", "recall")})


@query("m04_risk_calibration", sql("predictions failures", """SELECT risk_level, count(*) AS evaluated_predictions, count(a) AS observed_failures, round(avg(failure_probability), 6) AS mean_predicted_probability,
    round(avg(CASE WHEN a IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS observed_failure_rate FROM o GROUP BY 1""", EVALUATED, DUE, OUT))
def m04(t):
    out = mon.calibration(predictions(t), outcomes(t))
    return out.withColumns({c: r6(c) for c in ("mean_predicted_probability", "observed_failure_rate")})


RATES = "r AS (SELECT failure_probability AS score, count(a) AS pos, count(*) AS n FROM o GROUP BY 1)"
UPTO = "u AS (SELECT score, row_number() OVER (ORDER BY score) AS i, sum(pos) OVER (ORDER BY score) AS p, sum(n) OVER (ORDER BY score) AS c, pos, n FROM r)"
LOWEST = """l AS (SELECT j.i AS j, k.i AS k, min((k.p - j.p + j.pos) / (k.c - j.c + j.n)::DOUBLE) OVER (PARTITION BY j.i ORDER BY k.i DESC) AS lowest FROM u j JOIN u k ON k.i >= j.i)"""
HIGHEST = """f AS (SELECT k AS i, max(lowest) AS fitted FROM l GROUP BY 1), g AS (SELECT score, pos, n, fitted FROM u JOIN f USING (i))"""
ISOTONIC = EVALUATED, DUE, OUT, RATES, UPTO, LOWEST, HIGHEST


@query("m04_isotonic_curve", sql("predictions failures", "SELECT score, n AS evaluated, pos AS failures, round(fitted, 6) AS calibrated_probability FROM g", *ISOTONIC))
def m04b(t):
    """Observed rate by predicted probability, pooled until it no longer falls anywhere."""
    curve = isotonic_curve(judged(t), "failure_probability", "observed")
    return curve.select("score", F.col("n").alias("evaluated"), F.col("pos").alias("failures"), r6("fitted").alias("calibrated_probability"))


@query("m04_calibrated_risk", sql("predictions failures", """SELECT risk_level, count(*) AS evaluated_predictions, round(avg(failure_probability), 6) AS mean_predicted_probability, round(avg(fitted), 6) AS mean_calibrated_probability,
    round(avg((failure_probability - (a IS NOT NULL)::INTEGER) ** 2), 6) AS brier_score, round(avg((fitted - (a IS NOT NULL)::INTEGER) ** 2), 6) AS calibrated_brier_score FROM o JOIN g ON failure_probability = score GROUP BY 1""", *ISOTONIC))
def m04c(t):
    """Predicted and calibrated probabilities of each risk level, with the squared error of both."""
    rows = judged(t)
    both = calibrated(rows, "failure_probability", isotonic_curve(rows, "failure_probability", "observed"))
    p, c, y = F.col("failure_probability"), F.col("calibrated"), F.col("observed")
    means = {"mean_predicted_probability": p, "mean_calibrated_probability": c, "brier_score": (p - y) * (p - y), "calibrated_brier_score": (c - y) * (c - y)}
    return both.groupBy("risk_level").agg(F.count(F.lit(1)).alias("evaluated_predictions"), *[r6(F.avg(x)).alias(k) for k, x in means.items()])


def judged(t):
    seen = outcomes(t).select("prediction_id", F.col("failure_observed").cast("int").alias("observed"))
    return predictions(t).select("prediction_id", "risk_level", "failure_probability").join(seen, "prediction_id")


@query("m05_eligible_latest", sql("predictions", """SELECT prediction_id, asset_id, feature_time, prediction_time, failure_probability, risk_level, TIMESTAMP '2024-01-29' < feature_time + INTERVAL 72 HOURS AS fresh FROM predictions
    WHERE model_version = 'v1' AND model_name = 'failure_model' AND forecast_horizon_hours = 72 AND feature_time <= TIMESTAMP '2024-01-29' AND prediction_time <= TIMESTAMP '2024-01-29' AND coalesce(scored_at, prediction_time) <= TIMESTAMP '2024-01-29'
    QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY feature_time DESC, coalesce(scored_at, prediction_time) DESC, prediction_time DESC, prediction_id DESC) = 1"""))
def m05(t):
    context = {"model_name": "failure_model", "model_version": "v1", "forecast_horizon_hours": 72}
    out = mon.eligible_latest(predictions(t), ntz(NOW), context)
    return out.select("prediction_id", "asset_id", "feature_time", "prediction_time", "failure_probability", "risk_level", "fresh")


@query("m05_pending_outcomes", sql("predictions failures", """SELECT CASE WHEN o.prediction_id IS NOT NULL THEN 'evaluated' WHEN e.prediction_id IS NOT NULL THEN 'evaluated_earlier' ELSE 'pending' END AS outcome_status, count(*) AS predictions
    FROM predictions p LEFT JOIN o USING (prediction_id) LEFT JOIN evaluated e USING (prediction_id) GROUP BY 1""", EVALUATED, DUE, OUT))
def m05b(t):
    """A prediction without an outcome is pending; it is never counted as a negative."""
    done = outcomes(t).select("prediction_id", F.lit("evaluated").alias("s")).unionByName(evaluated(t).select("prediction_id", F.lit("evaluated_earlier").alias("s")))
    both = predictions(t).select("prediction_id").join(done, "prediction_id", "left")
    return both.groupBy(F.coalesce("s", F.lit("pending")).alias("outcome_status")).agg(F.count(F.lit(1)).alias("predictions"))


@query("m06_anchor_difference", sql("predictions", """SELECT risk_level, count(*) AS predictions, round(avg((epoch_us(prediction_time) - epoch_us(feature_time)) / 3600000000.0::DOUBLE), 6) AS mean_gap_hours,
    round(max((epoch_us(prediction_time) - epoch_us(feature_time)) / 3600000000.0::DOUBLE), 6) AS max_gap_hours FROM predictions GROUP BY 1"""))
def m06(t):
    gap = hours(micros("prediction_time") - micros("feature_time"))
    return predictions(t).groupBy("risk_level").agg(F.count(F.lit(1)).alias("predictions"), r6(F.avg(gap)).alias("mean_gap_hours"), r6(F.max(gap)).alias("max_gap_hours"))


@query("m07_probability_trend", sql("predictions", """SELECT prediction_id, asset_id, prediction_time, failure_probability, round(failure_probability - lag(failure_probability) OVER (PARTITION BY asset_id ORDER BY prediction_time, prediction_id), 6) + 0 AS change FROM predictions"""))
def m07(t):
    p = predictions(t).select("prediction_id", "asset_id", "prediction_time", "failure_probability")
    out = with_neighbours(p, ["asset_id"], "prediction_time", ["prediction_id"], {"previous": "failure_probability"})
    return out.select("prediction_id", "asset_id", "prediction_time", "failure_probability", r6(F.col("failure_probability") - F.col("previous")).alias("change"))


@query("j02_serving_contract", sql("predictions", """SELECT prediction_id, failure_probability, CAST(failure_probability >= threshold_used AS INTEGER) AS predicted_failure, risk_level,
    CASE WHEN failure_probability >= 0.85 THEN 'stop_and_inspect' WHEN failure_probability >= 0.5 THEN 'schedule_maintenance' ELSE 'continue_monitoring' END AS recommended_action, threshold_used FROM predictions"""))
def j02(t):
    return model.serve(predictions(t).select("prediction_id", "failure_probability"), F.lit(THRESHOLD))


WEIGHTS = {"value": 0.004, "hour": 0.01}


@query("j03_linear_batch_score", """SELECT event_id, round(1 / (1 + exp(-(0.004::DOUBLE * value + 0.01::DOUBLE * hour(ts) - 1.0::DOUBLE))), 6) AS failure_probability FROM events""")
def j03(t):
    rows = t.events.select("event_id", "value", F.hour("ts").alias("hour"))
    scored = model.linear_score(rows, WEIGHTS, -1.0)
    return scored.select("event_id", r6("failure_probability").alias("failure_probability"))


@query("j03_model_batch_score")
def j03b(t):
    """Fit on the snapshots, then score the newest snapshot of every asset."""
    data = snapshot_rows(t)
    fitted = model.fit_classifier(data, FEATURES, snap.LABEL)
    return model.score_latest(data, fitted, FEATURES).select("asset_id", "feature_time", r6("failure_probability").alias("failure_probability"))


@query("j04_response_validator", sql("predictions", """SELECT rule, violations FROM (SELECT count(*) FILTER (WHERE NOT (failure_probability BETWEEN 0 AND 1)) AS a, 0::BIGINT AS z, count(*) FILTER (WHERE (failure_probability >= 0.5) <> (failure_probability >= threshold_used)) AS b,
    count(*) FILTER (WHERE risk_level NOT IN ('critical', 'high', 'medium', 'low')) AS c FROM predictions), LATERAL (VALUES ('probability_in_range', a), ('threshold_in_range', z), ('prediction_consistent', b), ('known_risk_level', c), ('action_present', z)) v(rule, violations)"""))
def j04(t):
    served = model.serve(predictions(t).select("prediction_id", "failure_probability"), F.lit(THRESHOLD))
    return rule_report(served, model.response_rules())


FEATURES = [f for f in snap.FEATURES]


def snapshot_rows(t):
    return snap.feature_snapshots(fleet_inputs(t), SPANS)


@query("j05_train_and_evaluate")
def j05(t):
    """Boosted trees with a class weight, stopped by average precision on the validation split; metrics on the test split."""
    rows = model.labelled_rows(snapshot_rows(t), FEATURES, snap.LABEL)
    fitted, _ = staged.grow_stopped(model.weighted_rows(rows, FEATURES), FEATURES)
    return model.evaluate(rows, fitted, FEATURES, "label")


@query("j05_stopping_curve")
def j05d(t):
    """Average precision of every round that was judged, and the round whose model is kept."""
    _, curve = staged.fit_stopped(snapshot_rows(t), FEATURES, snap.LABEL)
    return curve.select("round", r6("average_precision").alias("average_precision"), "best_round", "chosen")


@query("j05_stopping_rule", """WITH z AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS round, CAST(floor(value) AS INTEGER) % 100 / 100.0::DOUBLE AS score, CAST(event_type = 'error' AS INTEGER) AS y FROM events
    WHERE ts IS NOT NULL AND value IS NOT NULL AND event_type IS NOT NULL), k AS (SELECT round, score, sum(y) AS pos, count(*) AS n FROM z GROUP BY 1, 2),
    u AS (SELECT round, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS alerts FROM k WINDOW w AS (PARTITION BY round ORDER BY score DESC)),
    a AS (SELECT round, coalesce(sum(pos * tp / alerts) / nullif(sum(pos), 0), 0) AS ap FROM u GROUP BY 1),
    b AS (SELECT a.round, a.ap, e.round AS best_round FROM a JOIN a e ON e.round <= a.round QUALIFY row_number() OVER (PARTITION BY a.round ORDER BY e.ap DESC, e.round) = 1),
    s AS (SELECT coalesce(min(round) FILTER (WHERE round - best_round >= 5), max(round)) AS stop FROM b)
    SELECT b.round, round(b.ap, 6) AS average_precision, b.best_round, b.round = (SELECT best_round FROM b, s WHERE round = stop) AS chosen FROM b, s WHERE b.round <= stop""")
def j05e(t):
    """The rule on a curve by day: scores of a day are a round's, and five days without a better one end it."""
    day = F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1
    rows = t.events.select(day.alias("round"), (F.pmod(F.floor("value"), F.lit(100)) / F.lit(100.0)).alias("score"), (F.col("event_type") == "error").cast("int").alias("y"))
    curve = staged.stopping_curve(staged.average_precision_by(rows, "round", "score", "y"), 5)
    return curve.where("evaluated").select("round", r6("average_precision").alias("average_precision"), "best_round", "chosen")


SPLIT = WINDOWS, POINTS, TIMED, *LABELLED


@query("j03_scored_assets", sql("telemetry failures meters maintenance", "SELECT asset_id, max(feature_time) AS feature_time, true AS in_range FROM x GROUP BY 1", *SPLIT))
def j03c(t):
    """Every asset gets one score, at its newest snapshot."""
    data = snapshot_rows(t)
    scored = model.score_latest(data, model.fit_classifier(data, FEATURES, snap.LABEL), FEATURES)
    return scored.select("asset_id", "feature_time", F.col("failure_probability").between(0, 1).alias("in_range"))


@query("j05_evaluated_rows", sql("telemetry failures meters maintenance", """SELECT count(*) FILTER (WHERE dataset_split = 'test') AS test_rows,
    count(*) FILTER (WHERE dataset_split = 'test' AND label_failure_within_horizon = 1) AS positives FROM x""", *SPLIT))
def j05c(t):
    """The confusion counts cover the test split, no more and no less."""
    data = snapshot_rows(t)
    out = model.evaluate(data, model.fit_classifier(data, FEATURES, snap.LABEL), FEATURES, snap.LABEL)
    return out.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_rows"), (F.col("tp") + F.col("fn")).alias("positives"))


@query("j05_class_weight", "SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS positives, round((count(*) - count(*) FILTER (WHERE event_type = 'error')) / greatest(1, count(*) FILTER (WHERE event_type = 'error')), 6) AS positive_weight FROM events")
def j05b(t):
    y = (F.col("event_type") == "error").cast("int")
    out = model.class_weight(t.events.withColumn("y", y), "y")
    return out.withColumn("positive_weight", r6("positive_weight"))


SCORED = "z AS (SELECT CAST(floor(value) AS INTEGER) % 100 / 100.0::DOUBLE AS score, CAST(event_type = 'error' AS INTEGER) AS y FROM events)"


def scored(t):
    s = F.pmod(F.floor("value"), F.lit(100)) / F.lit(100.0)
    return t.events.select(s.alias("score"), (F.col("event_type") == "error").cast("int").alias("y"))


CURVE = """k AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM z GROUP BY 1)""", """u AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM k)"""


@query("j06_threshold_by_f1", f"""WITH {SCORED}, {CURVE[0]}, {CURVE[1]}, f AS (SELECT score, 2 * (tp / (tp + fp)) * (tp / p) / greatest(tp / (tp + fp) + tp / p, 1e-12) AS f1 FROM u)
    SELECT score AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, score LIMIT 1""")
def j06(t):
    return threshold_by_f1(scored(t), "score", "y").withColumn("f1", r6("f1"))


@query("j07_ranking_metrics", f"""WITH {SCORED}, {CURVE[0]}, {CURVE[1]} SELECT CAST(any_value(p) AS BIGINT) AS positives, CAST(any_value(n) AS BIGINT) AS negatives,
    round(sum(pos * (n - fp + neg / 2)) / (any_value(p) * any_value(n)), 6) AS roc_auc, round(sum(pos * (tp / (tp + fp))) / any_value(p), 6) AS average_precision FROM u""")
def j07(t):
    out = ranking_metrics(scored(t), "score", "y")
    return out.withColumns({c: r6(c) for c in ("roc_auc", "average_precision")})


@query("j07_alert_metrics", f"""WITH {SCORED} SELECT count(*) FILTER (WHERE score >= 0.4 AND y = 1) AS tp, count(*) FILTER (WHERE score >= 0.4 AND y = 0) AS fp, count(*) FILTER (WHERE score < 0.4 AND y = 1) AS fn, count(*) FILTER (WHERE score < 0.4 AND y = 0) AS tn,
    round(coalesce(count(*) FILTER (WHERE score >= 0.4 AND y = 1) / nullif(count(*) FILTER (WHERE score >= 0.4), 0), 0), 6) AS precision, round(coalesce(count(*) FILTER (WHERE score >= 0.4 AND y = 1) / nullif(sum(y), 0), 0), 6) AS recall,
    round(avg((score - y) * (score - y)), 6) AS brier_score FROM z""")
def j07b(t):
    out = alert_metrics(scored(t), "score", "y", F.lit(0.4))
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "brier_score")})


@query("j08_snapshot_ids", "SELECT event_id, sha256(CAST(user_id AS VARCHAR) || '|' || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')) AS snapshot_id FROM events")
def j08(t):
    text = F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", F.sha2(text, 256).alias("snapshot_id"))


@query("j08_prediction_ids", "SELECT count(*) AS predictions, count(*) AS distinct_ids FROM events WHERE event_type = 'view'")
def j08b(t):
    ids = model.with_prediction_id(predictions(t).drop("prediction_id"), "run-1", ["asset_id", "prediction_time"])
    return ids.agg(F.count(F.lit(1)).alias("predictions"), F.count_distinct("prediction_id").alias("distinct_ids"))


@query("j09_score_smoke_check", sql("predictions", "SELECT count(*) AS row_count, count(failure_probability) = count(*) AND min(failure_probability) >= 0 AND max(failure_probability) <= 1 AS valid FROM predictions"))
def j09(t):
    return model.smoke_check(predictions(t), "failure_probability")


@query("c09_finite_features", """SELECT event_id, CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 0.0::DOUBLE ELSE x END AS cleaned FROM
    (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'NaN'::DOUBLE WHEN event_type = 'view' THEN 'Infinity'::DOUBLE WHEN event_type = 'signup' THEN '-Infinity'::DOUBLE ELSE value END AS x FROM events)""")
def c09(t):
    kind = F.col("event_type")
    x = (
        F.when(kind == "error", F.lit(None).cast("double"))
        .when(kind == "click", F.lit(float("nan")))
        .when(kind == "view", F.lit(float("inf")))
        .when(kind == "signup", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return t.events.select("event_id", finite_or_zero(x).alias("cleaned"))


@query("c08_risk_bands", """SELECT event_id, CASE WHEN p >= greatest(0.85, th) THEN 'critical' WHEN p >= th THEN 'high' WHEN p >= th * 0.5 THEN 'medium' ELSE 'low' END AS risk_level,
    CASE WHEN p >= greatest(0.85, th) THEN 'stop_and_inspect' WHEN p >= th THEN 'schedule_maintenance' ELSE 'continue_monitoring' END AS recommended_action
    FROM (SELECT event_id, CAST(floor(value) AS INTEGER) % 101 / 100.0::DOUBLE AS p, CASE WHEN event_type = 'view' THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS th FROM events)""")
def c08(t):
    p = F.pmod(F.floor("value"), F.lit(101)) / F.lit(100.0)
    limit = F.when(F.col("event_type") == "view", 0.9).otherwise(0.6)
    return t.events.select("event_id", risk_level(p, limit).alias("risk_level"), recommended_action(p, limit).alias("recommended_action"))
