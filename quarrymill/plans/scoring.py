"""Queries of classification metrics, served predictions and training histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import evaluation, faces, histories
from ..settings import CHANNEL_MEAN, CHANNEL_STD
from ..sources.tables import table, written


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    return evaluation.nearest_prototype(rows, faces.mean_vectors(rows, "label", "embedding"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return _predicted(spark, d).select(F.col("label").alias("y_true"), "y_pred")


def predicted_labels(spark: SparkSession, d: str) -> DataFrame:
    return _predicted(spark, d).select("vec_id", "y_pred")


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.confusion_matrix(_labelled(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("cls", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "support")


def class_report(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluation.class_report(confusion_matrix(spark, d)))


def report_averages(spark: SparkSession, d: str) -> DataFrame:
    matrix = written(confusion_matrix(spark, d), "confusion")
    return _rounded(evaluation.report_averages(evaluation.class_report(matrix), matrix))


def softmax_top3(spark: SparkSession, d: str) -> DataFrame:
    rows = _predicted(spark, d).select("vec_id", F.posexplode(V.top_k(F.col("probabilities"), F.col("class_names"), 3, 6)).alias("place", "t"))
    return rows.select("vec_id", "place", F.col("t.label").alias("label"), F.col("t.confidence").alias("confidence"))


def prediction_json(spark: SparkSession, d: str) -> DataFrame:
    rows = evaluation.prediction_response(_predicted(spark, d))
    return rows.select("vec_id", F.get_json_object("response", "$.prediction").cast("int").alias("prediction"), F.size("confidences").alias("results"))


def cross_entropy(spark: SparkSession, d: str) -> DataFrame:
    loss = V.smoothed_cross_entropy(F.col("logits"), F.array_position("class_names", F.col("label")).cast("int") - 1)
    return _predicted(spark, d).select("vec_id", F.round(loss, 6).alias("loss"))


def epoch_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Line items as batches: a run for each ship mode flag."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("run"), F.col("l_discount").alias("loss"), F.col("l_quantity").cast("int").alias("batch_size"), F.floor(F.col("l_quantity") / 2).cast("int").alias("correct")
    )
    return evaluation.epoch_metrics(rows).select("run", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


def parameter_counts(spark: SparkSession, d: str) -> DataFrame:
    """Parts as layers: a model for each brand, some sizes frozen."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("model"), F.col("p_partkey").alias("parameters"), (F.col("p_size") > 25).alias("trainable"))
    return evaluation.parameter_counts(rows)


def _history(spark: SparkSession, d: str) -> DataFrame:
    """A run for each customer: their orders in time are the epochs, the price share is the accuracy."""
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("run"), "o_orderdate", "o_orderkey", F.round(F.col("o_totalprice") / 600000, 3).alias("val_acc"))
    from ..operators.selection import ranked

    return ranked(rows, "run", "o_orderdate", "o_orderkey", name="epoch").select("run", "epoch", "val_acc")


def early_stopping(spark: SparkSession, d: str) -> DataFrame:
    return histories.early_stopping(_history(spark, d), patience=3).select("run", "epoch", "improved", "streak")


def best_epoch(spark: SparkSession, d: str) -> DataFrame:
    return histories.best_epoch(_history(spark, d)).select("run", "epoch", "val_acc")


def plateau_rates(spark: SparkSession, d: str) -> DataFrame:
    return histories.plateau_rates(_history(spark, d), "run", "epoch", "val_acc", 1e-3)


def _rounds(spark: SparkSession, d: str) -> DataFrame:
    """A label's accepted records after each batch: its distinct urls so far."""
    rows = table(spark, d, "work_item").where("label is not null and url is not null").groupBy("label", "url").agg(F.min("batch_no").alias("round"))
    new = rows.groupBy("label", "round").agg(F.count(F.lit(1)).alias("new"))
    from pyspark.sql import Window

    return new.select("label", "round", F.sum("new").over(Window.partitionBy("label").orderBy("round")).alias("accepted"))


def progress(spark: SparkSession, d: str) -> DataFrame:
    return histories.progress(_rounds(spark, d)).select("label", "round", "accepted", "gained")


def idle_streaks(spark: SparkSession, d: str) -> DataFrame:
    """Rounds of a user's events: progress is a purchase."""
    rows = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("gained"))
    return histories.idle_streaks(rows, "user_id", "event_id").select("user_id", "event_id", "idle")


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    queries = table(spark, d, "nation").select(F.col("n_regionkey").alias("label"), F.col("n_nationkey").alias("position"), F.col("n_name").alias("query"))
    rounds = table(spark, d, "region").select(F.col("r_regionkey").alias("label"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("round"))
    return histories.round_robin(rounds, queries).select("label", "round", "query")


def metric_log(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cleaning_report").select("report_id", "blur", "brightness").distinct()
    return histories.metric_log(rows, ["report_id"], ["blur", "brightness"]).where("value is not null and not isnan(value)")


def model_metadata(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.pictures import model_metadata

    rows = model_metadata(spark, "small", 224, ["a", "b"], CHANNEL_MEAN, CHANNEL_STD)
    return rows.select(F.get_json_object("json", "$.model_name").alias("model"), F.get_json_object("json", "$.class_names[1]").alias("second"), F.get_json_object("json", "$.normalization.mean[0]").cast("double").alias("mean"))


QUERIES = {
    f.__name__: f
    for f in (
        predicted_labels, confusion_matrix, class_report, report_averages, softmax_top3, prediction_json, cross_entropy, epoch_metrics, parameter_counts,
        early_stopping, best_epoch, plateau_rates, progress, idle_streaks, round_robin, metric_log, model_metadata,
    )
}

_LOGITS = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  u AS (SELECT label, pos, avg(e[pos] / sqrt(list_dot_product(e, e))) AS m FROM (SELECT *, unnest(range(1, 65)) AS pos FROM v) GROUP BY 1, 2),
  p AS (SELECT label, list(m ORDER BY pos) AS ref FROM u GROUP BY label),
  c AS (SELECT v.vec_id, v.label, p.label AS cls, list_cosine_similarity(v.e, p.ref) AS logit FROM v CROSS JOIN p),
  y AS (SELECT vec_id, label AS y_true, cls AS y_pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, cls) AS n FROM c) WHERE n = 1)"""
_MATRIX = f"""{_LOGITS}, k AS (SELECT DISTINCT label AS cls FROM v), m AS (SELECT a.cls AS y_true, b.cls AS y_pred, count(y.vec_id) AS n
  FROM k a CROSS JOIN k b LEFT JOIN y ON y.y_true = a.cls AND y.y_pred = b.cls GROUP BY 1, 2)"""
_REPORT = f"""{_MATRIX}, t AS (SELECT k.cls, (SELECT n FROM m WHERE y_true = k.cls AND y_pred = k.cls) AS tp, (SELECT sum(n) FROM m WHERE y_true = k.cls) AS s, (SELECT sum(n) FROM m WHERE y_pred = k.cls) AS q FROM k),
  rep AS (SELECT cls, CASE WHEN q > 0 THEN tp / q ELSE 0.0 END AS precision, CASE WHEN s > 0 THEN tp / s ELSE 0.0 END AS recall, CASE WHEN s + q > 0 THEN 2.0 * tp / (s + q) ELSE 0.0 END AS f1, CAST(s AS BIGINT) AS support FROM t)"""
_HISTORY = """h AS (SELECT o_custkey AS run, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS epoch, round(o_totalprice / 600000, 3) AS val_acc FROM orders)"""
_ROUNDS = """n AS (SELECT label, url, min(batch_no) AS round FROM work_item WHERE label IS NOT NULL AND url IS NOT NULL GROUP BY 1, 2), g AS (SELECT label, round, count(*) AS gained FROM n GROUP BY 1, 2)"""

ORACLES = {
    "predicted_labels": f"WITH {_LOGITS} SELECT vec_id, y_pred FROM y",
    "confusion_matrix": f"WITH {_MATRIX} SELECT y_true, y_pred, n FROM m",
    "class_report": f"WITH {_REPORT} SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep",
    "report_averages": f"""WITH {_REPORT}, acc AS (SELECT round(sum(n) FILTER (WHERE y_true = y_pred) / sum(n), 6) AS a, CAST(sum(n) AS BIGINT) AS support FROM m)
        SELECT 'accuracy' AS cls, a AS precision, a AS recall, a AS f1, support FROM acc
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM rep
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rep""",
    "softmax_top3": f"""WITH {_LOGITS}, s AS (SELECT vec_id, cls, exp(logit) / sum(exp(logit)) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, cls) AS n FROM c)
        SELECT vec_id, CAST(n - 1 AS INTEGER) AS place, cls AS label, round(p, 6) AS confidence FROM s WHERE n <= 3""",
    "prediction_json": f"WITH {_LOGITS} SELECT vec_id, y_pred AS prediction, CAST(3 AS INTEGER) AS results FROM y",
    "cross_entropy": f"""WITH {_LOGITS}, l AS (SELECT vec_id, label, cls, logit, ln(sum(exp(logit)) OVER (PARTITION BY vec_id)) AS z FROM c)
        SELECT vec_id, round(-0.9 * sum(logit - z) FILTER (WHERE cls = label) - 0.1 * avg(logit - z), 6) AS loss FROM l GROUP BY vec_id""",
    "epoch_metrics": """SELECT l_returnflag AS run, round(sum(l_discount * CAST(floor(l_quantity) AS INTEGER)) / greatest(1, sum(CAST(floor(l_quantity) AS INTEGER))), 6) AS loss,
        round(sum(CAST(floor(l_quantity / 2) AS INTEGER)) / greatest(1, sum(CAST(floor(l_quantity) AS INTEGER))), 6) AS accuracy FROM lineitem GROUP BY 1""",
    "parameter_counts": "SELECT p_brand AS model, CAST(coalesce(sum(p_partkey) FILTER (WHERE p_size > 25), 0) AS BIGINT) AS trainable, CAST(sum(p_partkey) AS BIGINT) AS total FROM part GROUP BY 1",
    "early_stopping": f"""WITH {_HISTORY}, b AS (SELECT *, coalesce(greatest(max(val_acc) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS best FROM h),
        i AS (SELECT *, val_acc > best AS improved FROM b), s AS (SELECT *, epoch - coalesce(max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch), 0) AS streak FROM i),
        f AS (SELECT run, min(epoch) AS stop FROM s WHERE streak >= 3 GROUP BY run)
        SELECT s.run, s.epoch, s.improved, CAST(s.streak AS INTEGER) AS streak FROM s LEFT JOIN f ON s.run = f.run WHERE f.stop IS NULL OR s.epoch <= f.stop""",
    "best_epoch": f"WITH {_HISTORY} SELECT run, epoch, val_acc FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY val_acc DESC NULLS LAST, epoch) AS n FROM h) WHERE n = 1",
    "plateau_rates": f"""WITH RECURSIVE {_HISTORY}, w(run, epoch, best, bad, lr) AS (SELECT run, epoch, val_acc, 0, CAST(0.001 AS DOUBLE) FROM h WHERE epoch = 1
          UNION ALL SELECT h.run, h.epoch, CASE WHEN h.val_acc > w.best + abs(w.best) * 1e-4 THEN h.val_acc ELSE w.best END,
            CASE WHEN h.val_acc > w.best + abs(w.best) * 1e-4 OR w.bad >= 2 THEN 0 ELSE w.bad + 1 END,
            CASE WHEN NOT (h.val_acc > w.best + abs(w.best) * 1e-4) AND w.bad >= 2 THEN w.lr * 0.5 ELSE w.lr END FROM w JOIN h ON h.run = w.run AND h.epoch = w.epoch + 1)
        SELECT run, epoch, lr FROM w""",
    "progress": f"WITH {_ROUNDS} SELECT label, round, CAST(sum(gained) OVER (PARTITION BY label ORDER BY round) AS BIGINT) AS accepted, gained FROM g",
    "idle_streaks": """WITH r AS (SELECT user_id, event_id, event_type = 'purchase' AS won, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
        SELECT user_id, event_id, CAST(sum(CASE WHEN won THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, island ORDER BY event_id) AS INTEGER) AS idle FROM r""",
    "round_robin": """WITH q AS (SELECT n_regionkey AS label, list(n_name ORDER BY n_nationkey) AS names FROM nation GROUP BY 1)
        SELECT label, CAST(i AS INTEGER) AS round, names[1 + i % len(names)] AS query FROM q CROSS JOIN range(0, 12) t(i)""",
    "metric_log": """WITH r AS (SELECT DISTINCT report_id, blur, brightness FROM cleaning_report), l AS (SELECT report_id, 'blur' AS metric, blur AS value FROM r UNION ALL SELECT report_id, 'brightness', brightness FROM r)
        SELECT report_id, metric, value FROM l WHERE value IS NOT NULL AND NOT isnan(value)""",
    "model_metadata": "SELECT 'small' AS model, 'b' AS second, CAST(0.485 AS DOUBLE) AS mean",
}
