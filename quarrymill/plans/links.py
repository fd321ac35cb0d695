"""Queries of URLs, pages and query texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import selection
from ..operators.faces import fetch_accepted
from ..sources.tables import table


def _queued(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "work_item").where("url is not null").select("seq", "label", "url", "batch_no").distinct()


def url_unescaped(spark: SparkSession, d: str) -> DataFrame:
    return _queued(spark, d).select("seq", urls.unescape(F.col("url")).alias("url"))


def url_wanted(spark: SparkSession, d: str) -> DataFrame:
    return _queued(spark, d).select("seq", urls.unescape(F.col("url")).alias("url")).where(urls.wanted(F.col("url"))).select("seq")


def url_first_seen(spark: SparkSession, d: str) -> DataFrame:
    rows = _queued(spark, d).select("seq", "label", urls.unescape(F.col("url")).alias("url"))
    return selection.first_seen(rows, ["label", "url"], "seq").select("seq")


def url_unseen(spark: SparkSession, d: str) -> DataFrame:
    rows = _queued(spark, d).where("label is not null")
    half = rows.agg(F.floor(F.max("batch_no") / 2).alias("half"))  # one row
    marked = rows.join(F.broadcast(half), F.lit(True)).where("batch_no is not null")
    return selection.unseen(marked.where("batch_no > half"), marked.where("batch_no <= half"), ["label", "url"]).select("seq")


def page_urls(spark: SparkSession, d: str) -> DataFrame:
    """Pages made of a label's queued URLs, of up to 20 neighbouring places, between quotes, as a search result holds them."""
    rows = _queued(spark, d).where("label is not null").withColumn("page", F.floor(F.col("seq") / 20))
    pages = rows.groupBy("label", "page").agg(
        F.concat(F.lit('<html>["'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "url"))), lambda s: s["url"]), '"],["'), F.lit('"]</html>')).alias("html")
    )
    return pages.select("label", "page", F.posexplode(urls.picture_urls(F.col("html"))).alias("position", "url"))


def query_texts(spark: SparkSession, d: str) -> DataFrame:
    """Templates of three tiers for each key, in order, as query strings."""
    templates = [(1, "{name} port"), (1, "{name} map"), (2, "{name} river"), (3, "{name}")]
    tiers = F.array(*(F.struct(F.lit(t).alias("tier"), F.lit(x).alias("text")) for t, x in templates))
    rows = table(spark, d, "nation").select("n_name", F.posexplode(tiers).alias("position", "t"))
    name = urls.spoken_name(F.col("n_name"))
    return rows.select("n_name", "position", "t.tier", urls.query_text(F.replace(F.col("t.text"), F.lit("{name}"), name)).alias("query"))


def fetched(spark: SparkSession, d: str) -> DataFrame:
    """Document texts as response bodies; status and type follow from other columns."""
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("source").isNull(), 404).otherwise(200).alias("status"), F.when(F.col("lang") == "html", "text/html").otherwise("image/jpeg").alias("content_type"), F.col("text").cast("binary").alias("content")
    )
    return fetch_accepted(rows).select("doc_id", F.md5("content").alias("md5"))


QUERIES = {f.__name__: f for f in (url_unescaped, url_wanted, url_first_seen, url_unseen, page_urls, query_texts, fetched)}

_PLAIN = "url"
for _escape, _sign in urls.URL_ESCAPES:
    _PLAIN = f"replace({_PLAIN}, '{_escape}', '{_sign}')"
_Q = "q AS (SELECT DISTINCT seq, label, url, batch_no FROM work_item WHERE url IS NOT NULL)"
_BAD = "regexp_matches(lower(url), '" + "|".join(urls.BLOCKED_URL_PARTS) + "') OR regexp_matches(url, '=s[0-9]{1,2}(-c)?$')"

ORACLES = {
    "url_unescaped": f"WITH {_Q} SELECT seq, {_PLAIN} AS url FROM q",
    "url_wanted": f"WITH {_Q}, u AS (SELECT seq, {_PLAIN} AS url FROM q) SELECT seq FROM u WHERE NOT ({_BAD})",
    "url_first_seen": f"WITH {_Q} SELECT min(seq) AS seq FROM q WHERE label IS NOT NULL GROUP BY label, {_PLAIN}",
    "url_unseen": f"""WITH {_Q}, h AS (SELECT max(batch_no) // 2 AS half FROM q WHERE label IS NOT NULL)
        SELECT seq FROM q WHERE label IS NOT NULL AND batch_no > (SELECT half FROM h)
        AND NOT EXISTS (SELECT 1 FROM q p WHERE p.label = q.label AND p.url = q.url AND p.batch_no <= (SELECT half FROM h))""",
    "page_urls": rf"""WITH {_Q}, u AS (SELECT label, seq // 20 AS page, seq, {_PLAIN} AS url FROM q WHERE label IS NOT NULL AND regexp_matches(url, '(?i)^https?://.{{10,}}\.(jpg|jpeg|png|webp).{{0,200}}$')),
        f AS (SELECT label, page, url, min(seq) AS seq FROM u WHERE NOT ({_BAD}) GROUP BY 1, 2, 3)
        SELECT label, page, CAST(row_number() OVER (PARTITION BY label, page ORDER BY seq) - 1 AS INTEGER) AS position, url FROM f""",
    "query_texts": """SELECT n_name, position, tier, replace(replace(text, '{name}', name), ' ', '+') AS query FROM
        (SELECT n_name, array_to_string(list_transform(string_split(replace(n_name, '_', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS name FROM nation)
        CROSS JOIN (VALUES (0, 1, '{name} port'), (1, 1, '{name} map'), (2, 2, '{name} river'), (3, 3, '{name}')) t(position, tier, text)""",
    "fetched": """SELECT doc_id, md5(text) AS md5 FROM documents WHERE source IS NOT NULL AND (lang IS NULL OR lang <> 'html') AND octet_length(encode(text)) >= 5000""",
}
