"""Queries pN_* of the training-data problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import letters_digits, unescape
from ..settings import URL_ESCAPES
from . import balls, bpe, history, neighbours, overlap, packing, prose, ranking, seen
from .keys import fingerprint
from .scratch import written


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _seen(spark: SparkSession, d: str) -> seen.SeenResult:
    items = _table(spark, d, "work_item").select("seq", "label", unescape(F.col("url")).alias("url"))
    return seen.seen_before(items, ["label", "url"], "seq")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _seen(spark, d).found.select(F.col("order").alias("seq"))


def p1_error_rate(spark: SparkSession, d: str) -> DataFrame:
    return _seen(spark, d).report()


def _pictures(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "dedup_item").select("seq", "label", F.lower("md5").alias("md5"), fingerprint(F.col("phash")).alias("fp"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = balls.near_duplicates(_pictures(spark, d), "seq", "label", "md5", "fp")
    return pairs.select(F.col("a").alias("seq_a"), F.col("b").alias("seq_b"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    items = _pictures(spark, d)
    groups = balls.alike_groups(items, "seq", "label", "md5", "fp")
    return groups.select(F.col("id").alias("seq"), "group")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return history.replay(_table(spark, d, "dedup_item"), _table(spark, d, "reference_vector"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    scored = _table(spark, d, "cleaning_report").select(letters_digits(F.col("politician")).alias("who"), "penalty", "original_name", "report_id")
    scored = scored.where(F.col("who").isNotNull() & F.col("penalty").isNotNull() & ~F.isnan("penalty"))
    return ranking.top_n(scored, "who", ["penalty", "original_name", "report_id"], 80).select("report_id")


def _split_items(spark: SparkSession, d: str) -> DataFrame:
    """Split names in one spelling; the file name without its last extension, ignoring letter case."""
    file = F.element_at(F.split("image_path", r"[/\\\\]"), -1)
    split = F.lower(F.trim("split"))
    side = F.when(split.isin("train", "training"), "train").when(split.isin("val", "valid", "validation"), "val").when(split.isin("test", "testing"), "test")
    return _table(spark, d, "split_item").select(
        F.col("item_id").alias("id"), side.alias("side"), letters_digits(F.col("politician")).alias("who"), F.lower(F.regexp_replace(file, r"\.[^.]*\z", "")).alias("name"),
        F.lower("md5").alias("exact"), fingerprint(F.col("phash")).alias("fp"), "source",
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap.overlaps(_split_items(spark, d))
    return pairs.select(F.least("trained", "tested").alias("item_a"), F.greatest("trained", "tested").alias("item_b"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    items = _split_items(spark, d)
    return overlap.overlap_report(overlap.overlaps(items), items)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neighbours.nearest(_table(spark, d, "face"), "face_id", "embedding")
    return pairs.select(F.least("a", "b").alias("face_a"), F.greatest("a", "b").alias("face_b")).distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(_table(spark, d, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "ids")


def p8_bins(spark: SparkSession, d: str) -> DataFrame:
    sizes = written(bpe.token_counts(_table(spark, d, "documents"), "doc_id", "text"), "token-counts")
    return packing.pack(sizes, _table(spark, d, "pack_capacity"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_bins(spark, d), _table(spark, d, "pack_capacity"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return prose.prose_scores(_table(spark, d, "documents"), "doc_id", "text").where("prose").select("doc_id")


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return prose.prose_scores(_table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    "p1_found": p1_found,
    "p1_error_rate": p1_error_rate,
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_bins": p8_bins,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_statistics": p9_statistics,
}

_UNESCAPED = "url"
for _escape, _plain in URL_ESCAPES:
    _UNESCAPED = f"replace({_UNESCAPED}, '{_escape}', '{_plain}')"

_BITS = "CASE WHEN regexp_full_match(phash, '[01]{64}') THEN CAST(phash AS BIT) END"
_NEAR = "bit_count(xor(a.fp, b.fp)) <= 5"
_PICTURES = f"WITH i AS (SELECT DISTINCT seq, label, lower(md5) AS md5, {_BITS} AS fp FROM dedup_item WHERE label IS NOT NULL)"
_ITEMS = f"""WITH i AS (SELECT DISTINCT item_id, CASE WHEN lower(trim(split)) IN ('train', 'training') THEN 'train'
                       WHEN lower(trim(split)) IN ('val', 'valid', 'validation') THEN 'val' WHEN lower(trim(split)) IN ('test', 'testing') THEN 'test' END AS side,
                       regexp_replace(lower(politician), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS who,
                       lower(regexp_replace(regexp_extract(image_path, '[^/\\\\]*$'), '\\.[^.]*$', '')) AS name, lower(md5) AS md5, {_BITS} AS fp, source FROM split_item),
             p AS (SELECT a.item_id AS trained, b.item_id AS tested, b.side AS split, b.source FROM i a JOIN i b
                   ON a.side = 'train' AND b.side <> 'train' AND (a.md5 = b.md5 OR {_NEAR} OR a.who = b.who AND a.name = b.name))"""

_VECTOR = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"

ORACLES = {
    # the least record that chains of alike pairs lead to
    "p2_groups": f"""
        WITH RECURSIVE i AS (SELECT DISTINCT seq, label, lower(md5) AS md5, {_BITS} AS fp FROM dedup_item WHERE label IS NOT NULL AND seq IS NOT NULL),
             e AS (SELECT a.seq AS u, b.seq AS v FROM i a JOIN i b ON a.label = b.label AND a.seq <> b.seq AND (a.md5 = b.md5 OR {_NEAR})),
             r(seq, low) AS (SELECT seq, seq FROM i UNION SELECT e.v, r.low FROM r JOIN e ON r.seq = e.u AND r.low < e.v)
        SELECT seq, min(low) AS "group" FROM r GROUP BY seq""",
    # the sequential loop: one record of each label in each step, against the list of accepted ones
    "p3_found": f"""
        WITH RECURSIVE i AS (SELECT DISTINCT seq, label, lower(md5) AS md5, CASE WHEN {_VECTOR} THEN CAST(embedding AS DOUBLE[]) END AS e, (CAST(batch_no AS BIGINT) << 40) + seq AS ord
                             FROM dedup_item WHERE label IS NOT NULL AND batch_no IS NOT NULL AND seq IS NOT NULL),
             x AS (SELECT b.ord, list(a.ord) AS near FROM i a JOIN i b ON a.label = b.label AND a.ord < b.ord AND (a.md5 = b.md5 OR list_cosine_similarity(a.e, b.e) >= 0.92) GROUP BY b.ord),
             o AS (SELECT i.label, i.ord, row_number() OVER (PARTITION BY i.label ORDER BY i.ord) AS n, coalesce(x.near, CAST([] AS BIGINT[])) AS near FROM i LEFT JOIN x ON i.ord = x.ord),
             k(label, n, kept) AS (SELECT DISTINCT label, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM o
                  UNION ALL SELECT k.label, o.n, CASE WHEN list_has_any(k.kept, o.near) THEN k.kept ELSE list_append(k.kept, o.ord) END FROM k JOIN o ON k.label = o.label AND o.n = k.n + 1),
             alive AS (SELECT unnest(kept) AS ord FROM (SELECT label, arg_max(kept, n) AS kept FROM k GROUP BY label))
        SELECT seq FROM i WHERE ord NOT IN (SELECT ord FROM alive)""",
    "p1_found": f"""
        WITH w AS (SELECT DISTINCT seq, label, {_UNESCAPED} AS url FROM work_item WHERE label IS NOT NULL AND url IS NOT NULL AND seq IS NOT NULL)
        SELECT seq FROM (SELECT seq, min(seq) OVER (PARTITION BY label, url) AS first FROM w) WHERE seq > first""",
    "p4_found": """
        WITH s AS (SELECT DISTINCT report_id, regexp_replace(lower(politician), '[^\\p{L}\\p{N}]', '', 'g') AS who, penalty, original_name
                   FROM cleaning_report WHERE politician IS NOT NULL AND penalty IS NOT NULL AND NOT isnan(penalty))
        SELECT report_id FROM (SELECT report_id, row_number() OVER (PARTITION BY who ORDER BY penalty, original_name NULLS FIRST, report_id) AS n FROM s)
        WHERE n <= 80""",
    "p2_found": f"""{_PICTURES} SELECT a.seq AS seq_a, b.seq AS seq_b FROM i a JOIN i b ON a.label = b.label AND a.seq < b.seq AND (a.md5 = b.md5 OR {_NEAR})""",
    "p5_found": f"{_ITEMS} SELECT least(trained, tested) AS item_a, greatest(trained, tested) AS item_b FROM p",
    "p5_report": f"{_ITEMS} SELECT split, source, count(*) AS pairs, count(DISTINCT tested) AS items FROM p GROUP BY ALL",
    "p6_found": """
        WITH v AS (SELECT DISTINCT face_id, CAST(embedding AS DOUBLE[]) AS e FROM face
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             c AS (SELECT a.face_id AS a, b.face_id AS b, list_cosine_similarity(a.e, b.e) AS cosine FROM v a JOIN v b ON a.face_id <> b.face_id),
             r AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS n FROM c WHERE cosine >= 0.85)
        SELECT DISTINCT least(a, b) AS face_a, greatest(a, b) AS face_b FROM r WHERE n <= 5""",
}
