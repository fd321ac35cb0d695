"""Planted cases: thresholds, ties, order, small groups, state machines, pictures."""

import io
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrymill.functions import pictures as P
from quarrymill.functions import png as codec
from quarrymill.functions import quality, urls
from quarrymill.functions import vectors as V
from quarrymill.operators import dedup, evaluation, faces, histories, selection
from quarrymill.operators.positions import positions
from quarrymill.sources import pictures as sources
from quarrymill.streaming import flows


def unit(*xs):
    v = np.zeros(64)
    v[: len(xs)] = xs
    return (v / np.linalg.norm(v)).tolist()


def at_angle(c, axis):
    v = np.zeros(64)
    v[0], v[axis] = c, np.sqrt(1 - c * c)
    return v.tolist()


def test_cosine_threshold_and_greedy_order(spark):
    rows = [(1, "a", unit(1)), (2, "a", at_angle(0.93, 1)), (3, "a", at_angle(0.91, 2)), (4, "b", unit(1)), (5, None, unit(1))]
    df = spark.createDataFrame(rows, "seq long, label string, e array<float>")
    assert {(r.a, r.b) for r in dedup.cosine_edges(df, "label", "seq", "e").collect()} == {(1, 2)}


def test_cosine_blocks_cover_every_pair_once(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 64))
    x[45:] = x[:45] + 0.1 * rng.normal(size=(45, 64))
    df = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(x)], "seq long, label string, e array<float>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if (u @ u.T)[i, j] >= 0.92}
    got = [(r.a, r.b) for r in dedup.cosine_edges(df, "label", "seq", "e", block=16).collect()]
    assert set(got) == want


@pytest.mark.parametrize("most", [0, 3, 5])
def test_hamming_bands_equal_brute_force(spark, most):
    rng = np.random.default_rng(most)
    base = rng.integers(-(2**63), 2**63 - 1, 20)
    prints = [int(b) for b in base]
    for b in base:
        for k in (1, 4, 5, 6):
            flips = rng.choice(64, k, replace=False)
            prints.append(int(np.int64(b) ^ np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64)).view(np.int64)))
    df = spark.createDataFrame([(i, "a", p) for i, p in enumerate(prints)], "seq long, label string, fp long")
    pop = lambda x, y: bin((x ^ y) & (2**64 - 1)).count("1")
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if pop(prints[i], prints[j]) <= most}
    assert {(r.a, r.b) for r in dedup.hamming_edges(df, "label", "seq", "fp", most).collect()} == want


def test_greedy_chain_and_crossing_layers(spark):
    # 2 and 1 match by print; 3 and 2 by vector; 4 copies 1; 9 is alone
    members = spark.createDataFrame([(1, "phash", 11), (2, "phash", 12), (2, "emb", 22), (3, "emb", 23), (1, "md5", 5), (4, "md5", 5), (9, "md5", 6)], "id long, layer string, cls long")
    near = spark.createDataFrame([(11, 12), (12, 11), (22, 23), (23, 22)], "cls long, other long")
    items = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9)], "seq long")
    rounds = dedup.greedy_by_class(items, members, near, "seq", replay_rows=0)
    assert {r.seq for r in rounds.where("kept").collect()} == {1, 3, 9}
    kept = dedup.greedy_by_class(items, members, near, "seq")
    assert {r.seq for r in kept.where("kept").collect()} == {1, 3, 9}
    assert {tuple(r) for r in dedup.drop_reasons(kept, members, near, "seq").collect()} == {(2, "dup:phash"), (4, "dup:md5")}


@settings(max_examples=4, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)).filter(lambda e: e[0] < e[1]), max_size=20))
def test_greedy_is_the_sequential_loop(spark, edges):
    kept = []
    for i in range(10):
        if not any((k, i) in edges for k in kept):
            kept.append(i)
    items = spark.range(10).withColumnRenamed("id", "seq")
    got = dedup.greedy_keep(items, spark.createDataFrame(list(edges), "a long, b long"), "seq")
    assert sorted(r.seq for r in got.where("kept").collect()) == kept


def test_split_counts_of_small_groups(spark):
    rows = [(f"n{n}", f"{n}-{i}") for n in (1, 3, 7, 80) for i in range(n)]
    df = selection.stratified_split(spark.createDataFrame(rows, "label string, id string"), "label", "id")
    got = {(r.label, r.split): r["count"] for r in df.groupBy("label", "split").count().collect()}
    want = {"n1": (0, 0, 1), "n3": (2, 0, 1), "n7": (5, 1, 1), "n80": (60, 12, 8)}
    assert all(got.get((k, s), 0) == n for k, v in want.items() for s, n in zip(("train", "val", "test"), v, strict=True))
    with pytest.raises(FileNotFoundError, match="val"):
        selection.require_splits(df.where("split <> 'val'"))


def test_early_stop(spark):
    acc = [0.5, 0.6, 0.6, 0.55, 0.7, 0.7, 0.6, 0.65]
    df = spark.createDataFrame([("r", i, a) for i, a in enumerate(acc, 1)], "run string, epoch int, val_acc double")
    out = histories.early_stopping(df).orderBy("epoch").collect()
    assert [r.epoch for r in out if r.improved] == [1, 2, 5] and out[-1].streak == 3
    assert histories.early_stopping(df, patience=2).count() == 4
    assert histories.best_epoch(df).first().epoch == 5


def test_plateau(spark):
    df = spark.createDataFrame([("r", i, a) for i, a in enumerate([0.5, 0.5, 0.5, 0.5, 0.6, 0.6, 0.6, 0.6], 1)], "run string, epoch int, val_acc double")
    got = [r.lr for r in histories.plateau_rates(df, "run", "epoch", "val_acc", 1.0).orderBy("epoch").collect()]
    assert got == [1, 1, 1, 0.5, 0.5, 0.5, 0.5, 0.25]


def test_page_urls(spark):
    html = r'["https://a.example/pic/one.jpg"],["https://a.example/pic/two.PNG?x=1"],["https://a.example/logo/three.jpg"],["https://a.example/pic/four.jpg=s64-c"],["https://a.example/pic/one.jpg"],["http://a/x.jpg"]'
    got = spark.createDataFrame([(html,)], "html string").select(urls.picture_urls(F.col("html")).alias("u")).first().u
    assert got == ["https://a.example/pic/one.jpg", "https://a.example/pic/two.PNG?x=1"]


def test_reasons(spark):
    rows = [(True, 1, True, 0.9, None), (False, 0, True, 0.9, None), (False, 4, True, 0.9, None), (False, 3, False, None, None), (False, 1, True, 0.49, None), (False, 1, True, 0.5, "md5"), (False, 1, True, 0.5, "phash"), (False, 1, True, 0.5, "emb"), (False, 3, True, 0.5, None)]
    df = spark.createDataFrame(rows, "c boolean, n int, r boolean, s double, d string").coalesce(1)
    got = [r[0] for r in df.select(faces.verdict_reason(*(F.col(x) for x in "cnrsd"))).collect()]
    assert got == ["corrupt", "no_face", "too_many_faces=4", "no_ref", "low_sim", "dup:md5", "dup:phash", "dup:emb", "ok"]


def test_fetch_filter(spark):
    big, small = bytes(5000), bytes(4999)
    rows = [(1, 200, "Image/PNG", big), (2, 200, "application/octet-stream", big), (3, 404, "image/png", big), (4, 200, "text/html", big), (5, 200, "image/png", small), (6, 200, None, big)]
    df = spark.createDataFrame(rows, "id int, status int, content_type string, content binary")
    assert {r.id for r in faces.fetch_accepted(df).collect()} == {1, 2}


def test_penalty_and_boxes(spark):
    row = spark.createDataFrame([(30.0, 20.0, 100, 300)], "b double, l double, w int, h int").select(quality.penalty(*(F.col(c) for c in "blwh"))).first()
    assert row[0] == 25.0
    df = spark.createDataFrame([((10.9, 10.0, 30.0, 50.0),)], "b struct<x1:float,y1:float,x2:float,y2:float>")
    assert tuple(df.select(quality.padded_box(F.col("b"), F.lit(32), F.lit(480)).alias("b")).first().b) == (4, 0, 32, 62)


def test_metrics_with_undefined_ratios(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 1), (None, 1)], "y_true int, y_pred int")
    m = evaluation.confusion_matrix(df)
    assert m.count() == 9 and m.agg(F.sum("n")).first()[0] == 3
    got = {r.cls: tuple(r)[1:] for r in evaluation.class_report(m).collect()}
    assert got[1] == (0.0, 0.0, 0.0, 0) and got[2] == (0.0, 0.0, 0.0, 1) and got[0] == (1.0, 0.5, 2 / 3, 2)


def test_caps_and_numbers(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, i int")
    have = spark.createDataFrame([("a", 1)], "k string, accepted int")
    assert {(r.k, r.i) for r in selection.capped(df, "k", "i", cap=3, existing=have).collect()} == {("a", 0), ("a", 1), ("b", 9)}
    names = spark.createDataFrame([("a", "a_0007.jpg"), ("a", "a_x.jpg"), ("b", "b.png")], "label string, name string")
    assert {tuple(r) for r in selection.next_numbers(names, "label", "name").collect()} == {("a", 8), ("b", 1)}


def test_streams_equal_batch_over_micro_batches(spark, tmp_path):
    rng = np.random.default_rng(1)
    base = [unit(*rng.normal(size=8)) for _ in range(6)]
    rows = [(i, "ab"[i % 2], f"m{i % 7}" if i % 5 else None, None, base[i % 6] if i % 3 else None) for i in range(40)]
    schema = "seq long, label string, md5 string, phash string, embedding array<float>"
    for part in range(4):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"b={part}"))
    df = spark.createDataFrame(rows, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    flows.drain(flows.deduplicated_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.seq for r in spark.read.parquet(str(tmp_path / "out")).where("reason = 'new'").collect()}
    members = dedup.class_members(df, "label", "seq", md5="md5", emb="embedding")
    near = dedup.near_classes(df, "label", "emb", "embedding", lambda one: dedup.cosine_edges(one, "label", "cls", "embedding"))
    assert got == {r.seq for r in dedup.greedy_by_class(df.select("seq"), members, near, "seq").where("kept").collect()}


def test_stream_state_meets_vectors_of_other_widths(spark, tmp_path):
    """A later micro-batch that begins with a shorter vector; equal vectors of another width are no copies."""
    rng = np.random.default_rng(2)
    wide, other, narrow = unit(*rng.normal(size=64)), unit(*rng.normal(size=64)), unit(*rng.normal(size=32))[:32]
    batches = [[(0, "a", None, None, wide), (1, "a", None, None, other)], [(2, "a", None, None, narrow), (3, "a", None, None, wide)], [(4, "a", None, None, narrow), (5, "a", None, None, other)], [(6, "a", None, None, [0.0] * 64)]]
    schema = "seq long, label string, md5 string, phash string, embedding array<float>"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    flows.drain(flows.deduplicated_stream(flows.stream_table(spark, str(tmp_path / "in"), schema)), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.seq: r.reason for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: "new", 1: "new", 2: "new", 3: "dup:emb", 4: "dup:emb", 5: "dup:emb", 6: "new"}


def png(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    raw = b"".join(b"\0" + rgb[y].astype(np.uint8).tobytes() for y in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_picture_folder(spark, tmp_path):
    folder = tmp_path / "raw" / "anna"
    folder.mkdir(parents=True)
    flat = np.full((4, 5, 3), (200, 100, 10))
    (folder / "a.png").write_bytes(png(flat))
    (folder / "b.JPG").write_bytes(b"nothing")
    (folder / "c.txt").write_bytes(b"x")
    rows = {r.name: r for r in sources.scan_pictures(spark, str(tmp_path / "raw")).collect()}
    assert set(rows) == {"a.png", "b.JPG"} and rows["a.png"].readable and not rows["b.JPG"].readable
    assert rows["a.png"].label == "anna" and bytes(rows["a.png"].image.data)[:3].hex() == "0a64c8"
    assert sources.scan_files(spark, str(tmp_path / "raw"), content=False).count() == 2
    df = sources.scan_pictures(spark, str(tmp_path / "raw")).where("readable")
    pic = F.struct("image.height", "image.width", "image.nChannels", "image.data")
    m = df.select(P.measures_udf()(pic).alias("m")).first().m
    assert m.blur == 0 and m.brightness == round(0.299 * 200 + 0.587 * 100 + 0.114 * 10)
    small = df.select(P.resize_udf(3)(pic).alias("p")).first().p
    assert (small.height, small.width) == (3, 3) and set(bytes(small.data)) == {10, 100, 200}
    box = F.struct(F.lit(1).alias("x1"), F.lit(0).alias("y1"), F.lit(3).alias("x2"), F.lit(2).alias("y2"))
    crop = df.select(P.crop_udf()(pic, box).alias("p")).first().p
    assert (crop.height, crop.width) == (2, 2)
    assert len(df.select(P.tensor_udf(8)(pic).alias("t")).first().t) == 3 * 8 * 8


def test_pixel_maths():
    g = np.arange(12.0).reshape(3, 4) ** 2
    p = np.pad(g, 1, mode="reflect")
    want = [p[y, x + 1] + p[y + 2, x + 1] + p[y + 1, x] + p[y + 1, x + 2] - 4 * p[y + 1, x + 1] for y in range(3) for x in range(4)]
    assert np.isclose(P.laplacian_variance(g), np.var(want))
    assert np.allclose(P.cosine_matrix(8) @ P.cosine_matrix(8).T, np.eye(8))
    bits = P.perceptual_bits(np.random.default_rng(0).uniform(0, 255, (40, 50)))
    assert len(bits) == 64 and bits.count("1") == 32
    a = np.arange(6).reshape(2, 3)
    assert P.turned(a, 6).tolist() == [[3, 0], [4, 1], [5, 2]] and P.turned(a, 1) is a
    assert P.augmented(np.full((20, 30, 3), 128, np.uint8), 7, 16).shape == (3, 16, 16)
    assert (P.augmented(np.full((20, 30, 3), 128, np.uint8), 7, 16) == P.augmented(np.full((20, 30, 3), 128, np.uint8), 7, 16)).all()


def test_vector_files_and_sinks(spark, tmp_path):
    buf = io.BytesIO()
    np.save(buf, np.array([3.0, 4.0]))
    (tmp_path / "npy").mkdir()
    (tmp_path / "npy" / "anna.npy").write_bytes(buf.getvalue())
    (tmp_path / "npy" / "bad.npy").write_bytes(b"x")
    row = sources.read_vectors(spark, str(tmp_path / "npy")).collect()
    assert len(row) == 1 and row[0].label == "anna" and np.allclose(row[0].ref, [0.6, 0.8])
    df = spark.createDataFrame([("train", "a", 1), ("val", "b", 2)], "split string, label string, x int")
    sources.write_labelled(df, str(tmp_path / "out"), "split", "label")
    assert {(r.split, r.label, r.x) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("train", "a", 1), ("val", "b", 2)}
    sources.write_report(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], "1010", "1001")], "v array<double>, a string, b string")
    row = df.select(V.argmax(F.col("v")), V.softmax(F.col("v")), V.hamming_text(F.col("a"), F.col("b")), V.median_of(F.col("v")), V.smoothed_cross_entropy(F.col("v"), F.lit(1))).first()
    p = np.exp([1, 3, 3]) / np.exp([1, 3, 3]).sum()
    assert row[0] == 1 and np.allclose(row[1], p) and row[2] == 2 and row[3] == 3
    assert np.isclose(row[4], -0.9 * np.log(p[1]) - 0.1 * np.log(p).mean())


def test_linear_inference(spark, tmp_path):
    from quarrymill.operators import inference

    path = str(tmp_path / "model.npz")
    inference.save_linear(path, np.array([[1.0, 0.0], [0.0, 2.0]]), np.array([0.5, 0.0]), ["a", "b"])
    df = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (3, [3.0, 0.0]), (4, [1.0])], "id int, v array<double>")
    rows = {r.id: r for r in inference.linear_logits(df, "v", path).withColumn("probabilities", V.softmax(F.col("logits"))).collect()}
    assert rows[1].logits == [1.5, 2.0] and rows[3].logits == [3.5, 0.0] and rows[2].logits is None and rows[4].logits is None
    served = evaluation.prediction_response(inference.linear_logits(df.where("id = 1"), "v", path).withColumn("probabilities", V.softmax(F.col("logits")))).first()
    assert served.all_results[0].label == "b" and '"prediction":"b"' in served.response


def test_exif_orientation():
    tiff = b"MM\0*\0\0\0\x08" + b"\0\x01" + b"\x01\x12\0\x03\0\0\0\x01\0\x06\0\0" + b"\0\0\0\0"
    body = b"Exif\0\0" + tiff
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab" + b"\xff\xe1" + (len(body) + 2).to_bytes(2, "big") + body + b"\xff\xd9"
    assert P.exif_orientation(jpeg) == 6 and P.exif_orientation(jpeg[:30]) in range(1, 9) and P.exif_orientation(b"nothing") == 1


def test_png_files_of_every_filter_and_kind():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (7, 5, 3)).astype(np.uint8)
    assert (codec.decode(codec.encode(a)) == a).all()

    def filtered(raw, step, kind):
        rows, above = [], np.zeros(raw.shape[1], int)
        for row in raw.astype(int):
            left = np.r_[np.zeros(step, int), row[:-step]]
            corner = np.r_[np.zeros(step, int), above[:-step]]
            p = left + above - corner
            nearest = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
            guess = [0, left, above, (left + above) // 2, nearest][kind]
            rows.append(bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes())
            above = row
        return zlib.compress(b"".join(rows))

    def file(width, height, depth, colour, data, extra=b""):
        chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"\0" * 4
        return codec.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)) + extra + chunk(b"IDAT", data) + chunk(b"IEND", b"")

    for kind in range(5):
        assert (codec.decode(file(5, 7, 8, 2, filtered(a[:, :, ::-1].reshape(7, 15), 3, kind))) == a).all()
        g = a[:, :, 0]
        assert (codec.decode(file(5, 7, 8, 0, filtered(g, 1, kind))) == g[:, :, None]).all()
        wide = np.stack([g, g], 2).reshape(7, 10)  # 16 bits: the high byte counts
        assert (codec.decode(file(5, 7, 16, 0, filtered(wide, 2, kind))) == g[:, :, None]).all()
        assert (codec.decode(file(5, 7, 8, 4, filtered(wide, 2, kind))) == g[:, :, None]).all()
    body = bytes([1, 2, 3, 4, 5, 6])
    palette = struct.pack(">I", 6) + b"PLTE" + body + b"\0" * 4
    assert codec.decode(file(2, 1, 8, 3, zlib.compress(b"\0\0\1"), palette)).tolist() == [[[3, 2, 1], [6, 5, 4]]]
    for bad in (b"", b"x" * 60, codec.encode(a)[:50], file(5, 7, 8, 3, filtered(a[:, :, 0], 1, 0)), file(5, 7, 4, 0, b"")):
        with pytest.raises((ValueError, struct.error)):
            codec.decode(bad)


def test_positions_over_many_partitions(spark):
    rows = [(i % 3 if i % 7 else None, i % 10, i) for i in range(300)]
    df = spark.createDataFrame(rows + rows[:20], "g int, x int, id int")
    got = {(r.g, r.id): r.position for r in positions(df, "g", ["x", "id"], ["id"]).collect()}
    for g in (0, 1, 2, None):
        own = sorted((x, i) for h, x, i in rows if h == g)
        assert [got[g, i] for _, i in own] == list(range(1, len(own) + 1))
    assert positions(df.limit(0), "g", ["x", "id"], ["id"]).count() == 0


def test_first_seen_and_status_of_hot_and_null_keys(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), (None, 0, "x"), ("b", 2, None)], "k string, n int, rank string")
    assert sorted(map(tuple, selection.first_seen(df, ["k"], "n").collect())) == [("a", 1, "y"), ("b", 2, None)]
    rows = {r.n: (r["rank"], r.status) for r in selection.with_status(df.drop("rank"), "k", "n", keep=1).collect()}
    assert rows == {3: (None, "removed"), 1: (1, "saved"), 0: (1, "saved"), 2: (1, "saved")}
    assert {tuple(r) for r in selection.status_counts(df, "k", keep=1).collect()} == {("a", 2, 1, 1), ("b", 1, 1, 0), (None, 1, 1, 0)}


def test_prototypes_in_blocks_and_null_vectors(spark):
    items = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 2.0]), (3, None)], "id long, embedding array<double>")
    protos = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [3.0, 0.0])], "label string, ref array<double>")
    for at_once in (1, 10):
        rows = {r.id: r for r in evaluation.nearest_prototype(items, protos, at_once=at_once).collect()}
        assert rows[1].y_pred == "a" and rows[2].y_pred == "b" and rows[3].y_pred is None
        assert np.allclose(rows[2].logits, [0, 1]) and rows[1].class_names == ["a", "b"]
