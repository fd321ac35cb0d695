"""Queries of scoring, selection, numbering, splitting and counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality, urls
from ..operators import selection, summaries
from ..settings import DEFAULTS
from ..sources.tables import manifest, table


def measured(spark: SparkSession, d: str) -> DataFrame:
    """Measured pictures, delivered once, with the penalty from their measures."""
    rows = table(spark, d, "cleaning_report").select("report_id", urls.letters_digits(F.col("politician")).alias("label"), "original_name", "blur", "brightness", "width", "height").where("label is not null")
    rows = rows.where("blur is not null and brightness is not null and width is not null and height is not null and not isnan(blur) and not isnan(brightness)").dropDuplicates(["report_id"])
    return rows.withColumn("penalty", quality.penalty(F.col("blur"), F.col("brightness"), F.col("width"), F.col("height")))


_ORDER = ("penalty", "original_name", "report_id")


def quality_penalty(spark: SparkSession, d: str) -> DataFrame:
    return measured(spark, d).select("report_id", F.round("penalty", 6).alias("penalty"))


def quality_topk(spark: SparkSession, d: str) -> DataFrame:
    report = selection.cleaning_report(measured(spark, d), "label", "original_name", *_ORDER)
    two = lambda c: F.round(c, 4).alias(c)
    return report.select("report_id", "label", "original_name", "new_name", "status", two("blur"), two("brightness"), two("penalty"))


def best_per_class(spark: SparkSession, d: str) -> DataFrame:
    return selection.best_per_class(measured(spark, d), "label", *_ORDER).select("label", "report_id", "rank")


def removed_items(spark: SparkSession, d: str) -> DataFrame:
    rows = measured(spark, d)
    saved = selection.best_per_class(rows, "label", *_ORDER)
    return rows.join(saved, "report_id", "left_anti").select("report_id")


def class_totals(spark: SparkSession, d: str) -> DataFrame:
    return summaries.with_total(selection.status_counts(measured(spark, d), "label"), "label")


def next_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cleaning_report").select(urls.letters_digits(F.col("politician")).alias("label"), "original_name").where("label is not null")
    return selection.next_numbers(rows, "label", "original_name").select("label", F.col("next_number").cast("long").alias("next_number"))


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    rows = selection.best_per_class(measured(spark, d), "label", *_ORDER).select("report_id", "label")
    return selection.stratified_split(rows, "label", "report_id").select("report_id", "label", "split")


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return stratified_split(spark, d).groupBy("label").pivot("split", ["train", "val", "test"]).count().fillna(0, ["train", "val", "test"])


def split_disjoint(spark: SparkSession, d: str) -> DataFrame:
    return selection.split_leaks(selection.require_splits(stratified_split(spark, d)), "report_id")


def label_index(spark: SparkSession, d: str) -> DataFrame:
    return selection.label_index(table(spark, d, "face"), "label").select("label", F.col("class_index").cast("long").alias("class_index"))


def mini_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "split_item").where(F.lower(F.trim("split")).isin("train", "training")).select("item_id").distinct()
    return selection.mini_batches(rows, "item_id").select("item_id", "batch")


def preview(spark: SparkSession, d: str) -> DataFrame:
    return selection.preview(table(spark, d, "face").select("label", "face_id").distinct(), "label", "face_id").select("label", "face_id")


def arrival_cap(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "work_item").where("label is not null and seq is not null").select("label", "seq").distinct()
    return selection.capped(rows, "label", "seq", cap=DEFAULTS.accepted_cap)


def arrival_cap_resumed(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "ts", "event_id")
    before = events.where("event_id % 5 = 0").groupBy("user_id").agg(F.count(F.lit(1)).alias("accepted"))
    return selection.capped(events, "user_id", "ts", "event_id", cap=50, existing=before).select("user_id", "event_id")


def class_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cleaning_report").select("report_id", urls.letters_digits(F.col("politician")).alias("label"), "penalty").where("label is not null").distinct()
    return summaries.class_summary(rows, "label", F.coalesce((F.col("penalty") == 0) & ~F.isnan("penalty"), F.lit(False)))


def incomplete_classes(spark: SparkSession, d: str) -> DataFrame:
    return summaries.incomplete(class_summary(spark, d), "label")


def round_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "work_item").where("label is not null").select("seq", "label", "batch_no", "url").distinct()
    return summaries.round_counters(rows, "label", "batch_no", escaped=F.coalesce(F.col("url").contains("\\u00"), F.lit(False)), missing=F.col("url").isNull())


def queue_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "work_item").select("seq", "label", "batch_no", urls.unescape(F.col("url")).alias("url")).distinct()
    return summaries.queue_counters(rows, "label", "batch_no", "url", "seq", room=20)


def stage_manifest(spark: SparkSession, d: str) -> DataFrame:
    split = table(spark, d, "split_item").select("item_id", "md5").distinct()
    faces = table(spark, d, "face").select("face_id", "image_path").distinct()
    return manifest(split, "split", "item_id", "md5").unionByName(manifest(faces, "faces", "face_id", "image_path"))


def crop_boxes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "face").select("face_id", "bbox").distinct().where("bbox is not null")
    box = quality.padded_box(F.col("bbox"), F.lit(640), F.lit(480))
    return rows.select("face_id", box.alias("b")).select("face_id", "b.*").where("x2 > x1 and y2 > y1")


def path_labels(spark: SparkSession, d: str) -> DataFrame:
    path = F.col("image_path")
    rows = table(spark, d, "split_item").where(path.isNotNull()).select("item_id", "image_path").distinct()
    return rows.where(urls.has_picture_extension(path)).select("item_id", urls.label_of(path).alias("label"), urls.file_name(path).alias("name"))


QUERIES = {
    f.__name__: f
    for f in (
        quality_topk, quality_penalty, best_per_class, removed_items, class_totals, next_numbers, stratified_split, split_counts, split_disjoint, label_index,
        mini_batches, preview, arrival_cap, arrival_cap_resumed, class_summary, incomplete_classes, round_counters, queue_counters, stage_manifest, crop_boxes, path_labels,
    )
}

_KEY = r"regexp_replace(lower(politician), '[^\p{L}\p{N}]', '', 'g')"
_MEASURED = rf"""m AS (SELECT DISTINCT report_id, {_KEY} AS label, original_name, blur, brightness,
           greatest(0.0, 35 - blur) + greatest(0.0, 25 - brightness) + greatest(0.0, brightness - 235) + CASE WHEN width < 160 OR height < 160 THEN 15.0 ELSE 0.0 END AS penalty
    FROM cleaning_report WHERE politician IS NOT NULL AND blur IS NOT NULL AND brightness IS NOT NULL AND width IS NOT NULL AND height IS NOT NULL AND NOT isnan(blur) AND NOT isnan(brightness)),
  r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY penalty, original_name NULLS FIRST, report_id) AS rank FROM m)"""
_SPLIT = f"""{_MEASURED}, k AS (SELECT report_id, label FROM r WHERE rank <= 80),
  o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(report_id || '/42'), report_id) AS n, count(*) OVER (PARTITION BY label) AS c FROM k),
  s AS (SELECT report_id, label, CASE WHEN n <= c * 75 // 100 THEN 'train' WHEN n <= c * 75 // 100 + c * 15 // 100 THEN 'val' ELSE 'test' END AS split FROM o)"""
_SUMMARY = f"""c AS (SELECT label, count(*) FILTER (WHERE good) AS accepted, count(*) FILTER (WHERE NOT good) AS rejected FROM
  (SELECT DISTINCT report_id, {_KEY} AS label, penalty, coalesce(penalty = 0 AND NOT isnan(penalty), false) AS good FROM cleaning_report WHERE politician IS NOT NULL) GROUP BY label)"""
_FILE = r"regexp_extract(image_path, '[^/\\]*$')"

_PLAIN_URL = "url"
for _escape, _sign in urls.URL_ESCAPES:
    _PLAIN_URL = f"replace({_PLAIN_URL}, '{_escape}', '{_sign}')"

ORACLES = {
    "quality_penalty": f"WITH {_MEASURED} SELECT report_id, round(penalty, 6) AS penalty FROM m",
    "quality_topk": f"""WITH {_MEASURED} SELECT report_id, label, original_name, CASE WHEN rank <= 80 THEN printf('%s_%04d.jpg', label, rank) ELSE '' END AS new_name,
        CASE WHEN rank <= 80 THEN 'saved' ELSE 'removed' END AS status, round(blur, 4) AS blur, round(brightness, 4) AS brightness, round(penalty, 4) AS penalty FROM r""",
    "best_per_class": f"WITH {_MEASURED} SELECT label, report_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 80",
    "removed_items": f"WITH {_MEASURED} SELECT report_id FROM r WHERE rank > 80",
    "class_totals": f"""WITH {_MEASURED}, c AS (SELECT label, count(*) AS rows, count(*) FILTER (WHERE rank <= 80) AS saved, count(*) FILTER (WHERE rank > 80) AS removed FROM r GROUP BY label)
        SELECT 'label' AS level, label, rows, saved, removed FROM c UNION ALL SELECT 'total', NULL, CAST(sum(rows) AS BIGINT), CAST(sum(saved) AS BIGINT), CAST(sum(removed) AS BIGINT) FROM c""",
    "next_numbers": rf"""SELECT {_KEY} AS label, CAST(coalesce(max(try_cast(nullif(regexp_extract(original_name, '_([0-9]{{1,9}})[.]jpg$', 1), '') AS INTEGER)), 0) + 1 AS BIGINT) AS next_number
        FROM cleaning_report WHERE politician IS NOT NULL GROUP BY 1""",
    "stratified_split": f"WITH {_SPLIT} SELECT report_id, label, split FROM s",
    "split_counts": f"""WITH {_SPLIT} SELECT label, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test
        FROM s GROUP BY label""",
    "split_disjoint": f"WITH {_SPLIT} SELECT report_id, count(DISTINCT split) AS splits FROM s GROUP BY report_id HAVING count(DISTINCT split) > 1",
    "label_index": "SELECT label, row_number() OVER (ORDER BY label) - 1 AS class_index FROM (SELECT DISTINCT label FROM face WHERE label IS NOT NULL)",
    "mini_batches": """SELECT item_id, (row_number() OVER (ORDER BY md5(item_id || '/42'), item_id) - 1) // 32 AS batch FROM (SELECT DISTINCT item_id FROM split_item WHERE lower(trim(split)) IN ('train', 'training'))""",
    "preview": """WITH l AS (SELECT DISTINCT label FROM face WHERE label IS NOT NULL ORDER BY md5(label || '/42'), label LIMIT 1)
        SELECT label, face_id FROM face WHERE label IN (SELECT label FROM l) GROUP BY label, face_id ORDER BY md5(face_id || '/42'), face_id LIMIT 1""",
    "arrival_cap": """SELECT label, seq FROM (SELECT label, seq, row_number() OVER (PARTITION BY label ORDER BY seq) AS n FROM (SELECT DISTINCT label, seq FROM work_item
        WHERE label IS NOT NULL AND seq IS NOT NULL)) WHERE n <= 100""",
    "arrival_cap_resumed": """WITH b AS (SELECT user_id, count(*) AS accepted FROM events WHERE event_id % 5 = 0 GROUP BY 1),
        n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
        SELECT n.user_id, n.event_id FROM n LEFT JOIN b ON n.user_id = b.user_id WHERE n.n <= 50 - coalesce(accepted, 0)""",
    "class_summary": f"WITH {_SUMMARY} SELECT label, accepted, rejected, accepted >= 100 AS complete FROM c",
    "incomplete_classes": f"WITH {_SUMMARY} SELECT label FROM c WHERE accepted < 100",
    "round_counters": r"""SELECT label, batch_no, count(*) AS found, count(*) FILTER (WHERE contains(coalesce(url, ''), '\u00')) AS escaped, count(*) FILTER (WHERE url IS NULL) AS missing
        FROM (SELECT DISTINCT seq, label, batch_no, url FROM work_item WHERE label IS NOT NULL) GROUP BY 1, 2""",
    "queue_counters": f"""WITH w AS (SELECT DISTINCT seq, label, batch_no, {_PLAIN_URL} AS url FROM work_item WHERE label IS NOT NULL AND url IS NOT NULL),
        n AS (SELECT *, seq = min(seq) OVER (PARTITION BY label, url) AS fresh FROM w), c AS (SELECT label, batch_no, count(*) AS found, count(*) FILTER (WHERE fresh) AS fresh FROM n GROUP BY 1, 2)
        SELECT label, batch_no, found, least(fresh, 20) AS pushed, found - fresh AS seen, fresh - least(fresh, 20) AS queue_full FROM c""",
    "stage_manifest": """SELECT 'split' AS stage, count(*) AS rows, CAST(sum(CAST('0x' || left(md5(concat_ws('|', CAST(item_id AS VARCHAR), md5)), 12) AS BIGINT)) AS VARCHAR) AS digest
          FROM (SELECT DISTINCT item_id, md5 FROM split_item)
        UNION ALL SELECT 'faces', count(*), CAST(sum(CAST('0x' || left(md5(concat_ws('|', CAST(face_id AS VARCHAR), image_path)), 12) AS BIGINT)) AS VARCHAR)
          FROM (SELECT DISTINCT face_id, image_path FROM face)""",
    "crop_boxes": """WITH b AS (SELECT DISTINCT face_id, CAST(trunc(bbox.x1) AS INTEGER) AS x1, CAST(trunc(bbox.y1) AS INTEGER) AS y1, CAST(trunc(bbox.x2) AS INTEGER) AS x2, CAST(trunc(bbox.y2) AS INTEGER) AS y2
                FROM face WHERE bbox IS NOT NULL),
           p AS (SELECT *, CAST(trunc((x2 - x1) * CAST(0.3 AS DOUBLE)) AS INTEGER) AS px, CAST(trunc((y2 - y1) * CAST(0.3 AS DOUBLE)) AS INTEGER) AS py FROM b),
           c AS (SELECT face_id, greatest(0, x1 - px) AS x1, greatest(0, y1 - py) AS y1, least(640, x2 + px) AS x2, least(480, y2 + py) AS y2 FROM p)
        SELECT face_id, x1, y1, x2, y2 FROM c WHERE x2 > x1 AND y2 > y1""",
    "path_labels": rf"""SELECT DISTINCT item_id, regexp_extract(image_path, '([^/\\]*)[/\\][^/\\]*$', 1) AS label, {_FILE} AS name FROM split_item
        WHERE regexp_matches(lower(image_path), '(\.jpg|\.jpeg|\.png|\.webp)$')""",
}
