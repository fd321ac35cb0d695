"""Queries of vectors, faces, gates and layered duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import dedup, faces, selection
from ..sources.tables import table, written


def _faces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "face").where(V.has_length(F.col("embedding"), 64)).dropDuplicates(["face_id"])


def unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.posexplode(V.normalise(F.col("embedding"))).alias("pos", "x"))
    return rows.select("vec_id", "pos", F.round("x", 6).alias("x"))


def mean_vectors(spark: SparkSession, d: str) -> DataFrame:
    refs = faces.mean_vectors(_faces(spark, d), "label", "embedding")
    return refs.select("label", "n_vectors", F.posexplode("ref").alias("pos", "x")).select("label", "n_vectors", "pos", F.round("x", 6).alias("x"))


def _similar(spark: SparkSession, d: str) -> DataFrame:
    return faces.with_similarity(_faces(spark, d), table(spark, d, "reference_vector"))


def similarity_gate(spark: SparkSession, d: str) -> DataFrame:
    return _similar(spark, d).where("similarity >= 0.5").select("face_id", F.round("similarity", 6).alias("similarity"))


def best_match_face(spark: SparkSession, d: str) -> DataFrame:
    return faces.pick_face(_similar(spark, d).where("image_path is not null"), "image_path", "face_id", "best_match").select("image_path", "face_id")


def largest_face(spark: SparkSession, d: str) -> DataFrame:
    return faces.pick_face(_faces(spark, d).where("image_path is not null"), "image_path", "face_id", "largest").select("image_path", "face_id")


def first_face(spark: SparkSession, d: str) -> DataFrame:
    return faces.pick_face(_faces(spark, d).where("image_path is not null"), "image_path", "face_id", "first").select("image_path", "face_id")


def face_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "face").where("image_path is not null").dropDuplicates(["face_id"])
    return faces.face_gate(rows, "image_path")


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each reason over all pictures: the first face decides."""
    rows = _similar(spark, d).where("image_path is not null")
    first = faces.pick_face(rows, "image_path", "face_id", "first").join(face_gate(spark, d), "image_path")
    reason = faces.verdict_reason(F.col("bbox").isNull(), F.col("faces"), F.col("ref").isNotNull(), F.col("similarity"))
    return first.select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("pictures"))


def verification(spark: SparkSession, d: str) -> DataFrame:
    """All outcomes of the rule cascade over the downloaded pictures, counted; the number of faces is planted by seq.

    A record without md5 stands for bytes that can't be decoded.
    """
    faces_of = F.pmod("seq", F.lit(6))
    rows = table(spark, d, "dedup_item").where("label is not null").select("seq", "label", "md5", "embedding").dropDuplicates(["seq"])
    vector = F.when(V.has_length(F.col("embedding"), 64), F.col("embedding"))
    met = faces.with_similarity(rows.withColumn("embedding", vector), table(spark, d, "reference_vector"))
    met = met.join(dedup_reasons(spark, d).withColumnRenamed("reason", "dup"), "seq", "left")
    reason = faces.verdict_reason(F.col("md5").isNull(), faces_of, F.col("ref").isNotNull(), F.col("similarity"), F.regexp_replace("dup", "^dup:", ""))
    return met.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("pictures"))


def lone_faces(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "face").where("image_path is not null").dropDuplicates(["face_id"])
    return faces.exactly_one(rows, "image_path").select("image_path", "face_id")


def faceless(spark: SparkSession, d: str) -> DataFrame:
    """Gates of all listed pictures, of which some have no face with a box."""
    rows = table(spark, d, "face").where("image_path is not null").dropDuplicates(["face_id"])
    return faces.face_gate(rows.where("bbox is not null"), "image_path", pictures=rows).groupBy("gate").agg(F.count(F.lit(1)).alias("pictures"))


def median_bits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", V.above_median_bits(F.col("embedding")).alias("bits"))


def _items(spark: SparkSession, d: str) -> DataFrame:
    fine = F.when(V.has_length(F.col("embedding"), 64), F.col("embedding"))
    rows = table(spark, d, "dedup_item").select("seq", "label", F.lower("md5").alias("md5"), V.bits_to_long(F.col("phash")).alias("fp"), fine.alias("embedding"))
    return rows.where("label is not null").dropDuplicates(["seq"])


def md5_first_copies(spark: SparkSession, d: str) -> DataFrame:
    return selection.first_seen(_items(spark, d), ["label", "md5"], "seq").select("seq")


def md5_repeats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_edges(_items(spark, d), "label", "seq", "md5")


def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.hamming_edges(_items(spark, d), "label", "seq", "fp").select("a", "b")


def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.cosine_edges(_items(spark, d), "label", "seq", "embedding").select("a", "b")


def _graph(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of the three layers, and which of them match."""
    members = written(dedup.class_members(items, "label", "seq", md5="md5", phash="fp", emb="embedding"), "dedup-members")
    prints = dedup.near_classes(items, "label", "phash", "fp", lambda one: dedup.hamming_edges(one, "label", "cls", "fp"))
    vectors = dedup.near_classes(items, "label", "emb", "embedding", lambda one: dedup.cosine_edges(one, "label", "cls", "embedding"))
    return members, prints.unionByName(vectors)


def greedy_dedup(spark: SparkSession, d: str) -> DataFrame:
    """All layers in one graph, resolved greedily in order of seq."""
    items = written(_items(spark, d), "dedup-items")
    return dedup.greedy_by_class(items.select("seq"), *_graph(items), "seq").select("seq", "kept")


def dedup_reasons(spark: SparkSession, d: str) -> DataFrame:
    items = written(_items(spark, d), "dedup-items")
    members, near = _graph(items)
    return dedup.drop_reasons(dedup.greedy_by_class(items.select("seq"), members, near, "seq"), members, near, "seq")


def greedy_cosine_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The small vectors at a threshold their similarities reach."""
    rows = table(spark, d, "embeddings")
    return dedup.greedy_keep(rows.select("vec_id"), dedup.cosine_edges(rows, "label", "vec_id", "embedding", 0.3), "vec_id").select("vec_id", "kept")


def store_sizes(spark: SparkSession, d: str) -> DataFrame:
    return dedup.store_sizes(_items(spark, d), "label", "md5", "fp", "embedding")


QUERIES = {
    f.__name__: f
    for f in (
        unit_vectors, mean_vectors, similarity_gate, best_match_face, largest_face, first_face, face_gate, verdicts, verification, lone_faces, faceless, median_bits, md5_first_copies, md5_repeats,
        hamming_pairs, cosine_pairs, greedy_dedup, dedup_reasons, greedy_cosine_dedup, store_sizes,
    )
}

_VALID = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_FACES = f"f AS (SELECT DISTINCT face_id, label, image_path, bbox, CAST(embedding AS DOUBLE[]) AS e FROM face WHERE {_VALID})"
_SIMILAR = f"{_FACES}, s AS (SELECT f.*, list_cosine_similarity(e, CAST(r.ref AS DOUBLE[])) AS similarity, r.ref IS NOT NULL AS has_ref FROM f LEFT JOIN reference_vector r ON f.label = r.label)"
_PICK = "SELECT image_path, face_id FROM (SELECT image_path, face_id, row_number() OVER (PARTITION BY image_path ORDER BY {order}) AS n FROM {rows} WHERE image_path IS NOT NULL) WHERE n = 1"
_COUNTED = "c AS (SELECT image_path, count(DISTINCT face_id) AS faces FROM face WHERE image_path IS NOT NULL GROUP BY 1)"
_DEDUP = f"""i AS (SELECT DISTINCT seq, label, lower(md5) AS md5, CASE WHEN regexp_full_match(phash, '[01]{{64}}') THEN CAST(phash AS BIT) END AS fp,
       CASE WHEN {_VALID} THEN CAST(embedding AS DOUBLE[]) END AS e FROM dedup_item WHERE label IS NOT NULL)"""
_EDGES = f"""{_DEDUP}, g AS (SELECT a.label, a.seq AS a, b.seq AS b, coalesce(a.md5 = b.md5, false) AS m, coalesce(bit_count(xor(a.fp, b.fp)) <= 5, false) AS p,
       coalesce(list_cosine_similarity(a.e, b.e) >= 0.92, false) AS e FROM i a JOIN i b ON a.label = b.label AND a.seq < b.seq)"""


def _greedy(edges: str, items: str) -> str:
    """The sequential loop as a recursive query: one item of each label in each step, against the list of kept ones."""
    return f"""{edges}, o AS (SELECT label, id, row_number() OVER (PARTITION BY label ORDER BY id) AS n FROM ({items})),
        nb AS (SELECT o.label, o.id, o.n, coalesce(x.near, CAST([] AS BIGINT[])) AS near FROM o LEFT JOIN (SELECT b, list(a) AS near FROM edge GROUP BY b) x ON o.id = x.b),
        k(label, n, kept) AS (SELECT DISTINCT label, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM o
              UNION ALL SELECT k.label, nb.n, CASE WHEN list_has_any(k.kept, nb.near) THEN k.kept ELSE list_append(k.kept, nb.id) END FROM k JOIN nb ON k.label = nb.label AND nb.n = k.n + 1),
        last AS (SELECT label, arg_max(kept, n) AS kept FROM k GROUP BY label), alive AS (SELECT unnest(kept) AS id FROM last)"""


_GREEDY = _greedy(f"WITH RECURSIVE {_EDGES}, edge AS (SELECT a, b FROM g WHERE m OR p OR e)", "SELECT label, seq AS id FROM i")
REASONS = f"""{_GREEDY}, x AS (SELECT b, bool_or(m) AS m, bool_or(p) AS p FROM g WHERE (m OR p OR e) AND a IN (SELECT id FROM alive) AND b NOT IN (SELECT id FROM alive) GROUP BY b),
        y AS (SELECT b AS seq, CASE WHEN m THEN 'dup:md5' WHEN p THEN 'dup:phash' ELSE 'dup:emb' END AS reason FROM x)"""
_GREEDY_SMALL = _greedy(
    """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
       edge AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.3)""",
    "SELECT label, vec_id AS id FROM v",
)

ORACLES = {
    "unit_vectors": """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(embedding[pos] AS DOUBLE) / (n + 1e-9), 6) AS x FROM
        (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n, unnest(range(1, 65)) AS pos FROM embeddings)""",
    "mean_vectors": f"""WITH {_FACES}, u AS (SELECT label, e, sqrt(list_dot_product(e, e)) AS n FROM f WHERE label IS NOT NULL),
        p AS (SELECT label, pos, avg(e[pos] / n) AS m, count(*) AS c FROM (SELECT *, unnest(range(1, 65)) AS pos FROM u) GROUP BY 1, 2)
        SELECT label, c AS n_vectors, CAST(pos - 1 AS INTEGER) AS pos, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS x FROM p""",
    "similarity_gate": f"WITH {_SIMILAR} SELECT face_id, round(similarity, 6) AS similarity FROM s WHERE similarity >= 0.5",
    "best_match_face": f"WITH {_SIMILAR} " + _PICK.format(order="similarity DESC NULLS LAST, face_id", rows="s"),
    "largest_face": f"WITH {_FACES} "
    + _PICK.format(order="(CAST(bbox.x2 AS DOUBLE) - bbox.x1) * (CAST(bbox.y2 AS DOUBLE) - bbox.y1) DESC NULLS LAST, face_id", rows="f"),
    "first_face": f"WITH {_FACES} " + _PICK.format(order="face_id", rows="f"),
    "face_gate": f"WITH {_COUNTED} SELECT image_path, faces, CASE WHEN faces > 3 THEN 'too_many_faces' ELSE 'ok' END AS gate FROM c",
    "verdicts": f"""WITH {_SIMILAR}, {_COUNTED}, n AS (SELECT *, row_number() OVER (PARTITION BY image_path ORDER BY face_id) AS n FROM s WHERE image_path IS NOT NULL)
        SELECT CASE WHEN bbox IS NULL THEN 'corrupt' WHEN faces > 3 THEN 'too_many_faces=' || faces WHEN NOT has_ref THEN 'no_ref' WHEN similarity < 0.5 THEN 'low_sim' ELSE 'ok' END AS reason,
               count(*) AS pictures FROM n JOIN c USING (image_path) WHERE n = 1 GROUP BY 1""",
    "verification": f"""{REASONS}, v AS (SELECT i.seq, CASE WHEN md5 IS NULL THEN 'corrupt' WHEN i.seq % 6 = 0 THEN 'no_face' WHEN i.seq % 6 > 3 THEN 'too_many_faces=' || i.seq % 6 WHEN r.ref IS NULL THEN 'no_ref'
        WHEN list_cosine_similarity(i.e, CAST(r.ref AS DOUBLE[])) < 0.5 THEN 'low_sim' ELSE coalesce(y.reason, 'ok') END AS reason FROM i LEFT JOIN reference_vector r ON i.label = r.label LEFT JOIN y ON i.seq = y.seq)
        SELECT reason, count(*) AS pictures FROM v GROUP BY reason""",
    "lone_faces": "SELECT image_path, min(face_id) AS face_id FROM face WHERE image_path IS NOT NULL GROUP BY image_path HAVING count(DISTINCT face_id) = 1",
    "faceless": """WITH c AS (SELECT image_path, count(DISTINCT face_id) FILTER (WHERE bbox IS NOT NULL) AS n FROM face WHERE image_path IS NOT NULL GROUP BY 1)
        SELECT CASE WHEN n = 0 THEN 'no_face' WHEN n > 3 THEN 'too_many_faces' ELSE 'ok' END AS gate, count(*) AS pictures FROM c GROUP BY 1""",
    "median_bits": """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN CAST(x AS DOUBLE) > m THEN '1' ELSE '0' END), '') AS bits FROM
        (SELECT vec_id, embedding, (list_sort(CAST(embedding AS DOUBLE[]))[32] + list_sort(CAST(embedding AS DOUBLE[]))[33]) / 2 AS m FROM embeddings)""",
    "md5_first_copies": f"WITH {_DEDUP} SELECT min(seq) AS seq FROM i WHERE md5 IS NOT NULL GROUP BY label, md5",
    "md5_repeats": f"WITH {_DEDUP}, w AS (SELECT label, seq, min(seq) OVER (PARTITION BY label, md5) AS a FROM i WHERE md5 IS NOT NULL) SELECT label, a, seq AS b FROM w WHERE seq > a",
    "hamming_pairs": f"WITH {_DEDUP} SELECT a.seq AS a, b.seq AS b FROM i a JOIN i b ON a.label = b.label AND a.seq < b.seq AND bit_count(xor(a.fp, b.fp)) <= 5",
    "cosine_pairs": f"WITH {_DEDUP} SELECT a.seq AS a, b.seq AS b FROM i a JOIN i b ON a.label = b.label AND a.seq < b.seq AND list_cosine_similarity(a.e, b.e) >= 0.92",
    "greedy_dedup": f"{_GREEDY} SELECT o.id AS seq, o.id IN (SELECT id FROM alive) AS kept FROM o",
    "dedup_reasons": f"{REASONS} SELECT seq, reason FROM y",
    "greedy_cosine_dedup": f"{_GREEDY_SMALL} SELECT o.id AS vec_id, o.id IN (SELECT id FROM alive) AS kept FROM o",
    "store_sizes": f"WITH {_DEDUP} SELECT label, count(DISTINCT md5) AS md5s, count(fp) AS phashes, count(e) AS embeddings FROM i GROUP BY label",
}
