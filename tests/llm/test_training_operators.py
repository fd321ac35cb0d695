"""Planted cases: nulls, empty tables, ties, repeated rows, hot groups, odd texts, extra columns."""

import base64

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import balls, bpe, components, history, neighbours, overlap, packing, prose, ranking, seen, vectors


# -- problem 1


def test_seen_edges(spark):
    rows = [(1, "a", "u"), (2, "a", "u"), (2, "a", "u"), (3, "b", "u"), (4, None, "u"), (5, "a", None), (6, "a", ""), (7, "a", ""), (None, "a", "u"), (9, "a", "u" * 10000), (8, "a", "u" * 10000)]
    df = spark.createDataFrame(rows, "seq long, label string, url string").withColumns({"hash": F.lit(1), "order": F.lit("x")})
    r = seen.seen_before(df, ["label", "url"], "seq")
    assert sorted(x.order for x in r.found.collect()) == [2, 7, 9]
    assert seen.seen_before(df.limit(0), ["label", "url"], "seq").found.count() == 0


def test_seen_survives_a_saturated_filter_and_a_hot_key(spark):
    n = 6000
    df = spark.range(n).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")).repartition(7)
    r = seen.seen_before(df, ["k"], "seq", seen.SeenConfig(keys_per_filter=1 << 10, false_positive_rate=0.3))
    assert sorted(x.order for x in r.found.collect()) == list(range(3, n, 3))
    report = r.report().first()
    assert report.disproved > 0 and 0 < report.filter_error_rate < 0.6 and report.final_error_rate == 0


def test_equal_hashes_of_different_keys_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(seen.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "seq long, k string")
    assert [x.order for x in seen.seen_before(df, ["k"], "seq").found.collect()] == [3]


# -- problem 4


def test_top_n_with_ties_repeats_and_a_group_over_many_partitions(spark):
    rows = [("a", float(i % 5), f"n{i % 3}", i) for i in range(400)] + [("b", 1.0, None, 900), ("b", 1.0, None, 900), ("b", 1.0, "", 901)] + [("c", 2.0, "x", 7)]
    df = spark.createDataFrame(rows, "g string, p double, n string, id long")
    df = df.unionByName(df.where("id % 4 = 0"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = sorted(r.id for r in ranking.top_n(df, "g", ["p", "n", "id"], 30).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    want = sorted({r for r in rows if r[0] == "a"}, key=lambda r: (r[1], r[2], r[3]))[:30]
    assert got == sorted([r[3] for r in want] + [900, 901, 7])
    assert ranking.top_n(df.limit(0), "g", ["p", "n", "id"], 30).count() == 0


def test_weighted_positions(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 2), ("b", 1.0, 4)], "g string, v double, w long")
    got = {(r.g, r.v): r.position for r in ranking.positions(df, "g", ["v"], ["v", "w"], weight="w").collect()}
    assert got == {("a", 1.0): 3, ("a", 2.0): 5, ("b", 1.0): 4}


# -- problems 2 and 5


def prints_near(rng, n, copies):
    base = rng.integers(-(2**63), 2**63 - 1, n)
    out = list(base)
    for b in base:
        for k in copies:
            flips = rng.choice(64, k, replace=False).astype(np.uint64)
            out.append(np.int64(b) ^ np.bitwise_xor.reduce(np.uint64(1) << flips).view(np.int64))
    return np.array(out, np.int64)


def brute(prints, most=5):
    x = prints.view(np.uint64)
    return {(min(a, b), max(a, b)) for i, a in enumerate(prints.tolist()) for b in prints[i + 1 :][np.bitwise_count(x[i + 1 :] ^ x[i]) <= most].tolist() if a != b}


@pytest.mark.parametrize("hot", [4096, 3])
def test_balls_equal_brute_force(spark, hot):
    rng = np.random.default_rng(hot)
    prints = prints_near(rng, 40, (1, 2, 3, 4, 5, 6, 7))
    # half a fingerprint shared by many
    prints = np.concatenate([prints, (prints[:120] & np.int64(0xFFFFFFFF)) | np.int64(0x12345678 << 32)])
    prints = np.unique(prints)
    df = spark.createDataFrame([(1, int(p)) for p in prints], "grp long, fp long")
    got = [(r.a, r.b) for r in balls.near_prints(df, hot).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(prints)


def test_near_duplicates_edges(spark):
    rows = [(1, "a", "m", 5), (2, "a", "m", None), (2, "a", "m", None), (3, "a", None, 4), (4, "b", "m", 5), (5, None, "m", 5), (None, "a", "m", 5), (6, "a", "x", 5)]
    df = spark.createDataFrame(rows, "seq long, label string, md5 string, fp long").withColumn("grp", F.lit(0))
    got = sorted((r.a, r.b) for r in balls.near_duplicates(df, "seq", "label", "md5", "fp").collect())
    assert got == [(1, 2), (1, 3), (1, 6), (3, 6)]
    groups = {r.id: r.group for r in balls.alike_groups(df, "seq", "label", "md5", "fp").collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 6: 1, 4: 4}
    assert balls.near_duplicates(df.limit(0), "seq", "label", "md5", "fp").count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.id: r.group for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_overlap_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    prints = prints_near(rng, 60, (0, 2, 5, 6))
    prints[:100] &= np.int64(-65536)  # two bytes that many share, so that long keys are used too
    side = rng.integers(0, 2, len(prints))
    df = spark.createDataFrame([(int(p), int(s)) for p, s in zip(prints, side, strict=True)], "fp long, side byte").distinct()
    x = prints.view(np.uint64)
    want = {(int(prints[i]), int(prints[j])) for i in range(len(x)) for j in range(len(x)) if side[i] == 0 and side[j] == 1 and bin(int(x[i] ^ x[j])).count("1") <= 5}
    for hot_key in (16384, 1):  # keys of two shingles; of three, divided
        assert {(r.trained, r.tested) for r in overlap.near_across(df, hot_key).collect()} == want


def test_overlap_edges(spark):
    rows = [(1, "train", "p", "n", None, None), (2, "val", "p", "n", None, None), (3, "test", None, "n", "m", None), (4, "train", None, "n", "m", None), (5, None, "p", "n", "m", 1), (2, "val", "p", "n", None, None), (6, "train", "q", "n", None, 3), (7, "test", "r", "o", None, 3)]
    df = spark.createDataFrame(rows, "id long, side string, who string, name string, exact string, fp long").withColumns({"source": F.lit(None).cast("string"), "tested": F.lit(1)})
    pairs = overlap.overlaps(df)
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (4, 3), (6, 7)]
    assert {(r.split, r.source, r.pairs, r["items"]) for r in overlap.overlap_report(pairs, df).collect()} == {("val", None, 1, 1), ("test", None, 2, 2)}
    assert overlap.overlaps(df.limit(0)).count() == 0


def test_a_store_of_keys_over_batches(spark):
    rng = np.random.default_rng(8)
    store = seen.KeyStore(spark, slices=3, config=seen.SeenConfig(false_positive_rate=0.3))
    rows, wrong, before = [], 0, set()
    for b in range(3):
        some = [(None if n % 17 == 0 else "a" * (n % 5), f"u{n}", 1000 * b + i) for i, n in enumerate(rng.integers(0, 400, 150).tolist())]
        batch = spark.createDataFrame(some + some[:5], "label string, url string, seq long").withColumn("hash", F.lit(0))
        got = {r.order: r for r in store.ingest(batch, ["label", "url"], "seq").collect()}
        now = set(before)
        want = {}
        for label, url, at in some:
            if label is not None:
                want[at] = (label, url) in now
                now.add((label, url))
        assert {k: r.seen for k, r in got.items()} == want
        wrong += sum(r.disproved for r in got.values())
        assert not any(r.disproved for r in got.values() if any((label, url) in before for label, url, at in some if at == r.order))
        before = now
    assert wrong > 0 and store.ingest(batch.limit(0), ["label", "url"], "seq").count() == 0


# -- problems 3 and 6


def test_codes_are_within_their_bounds():
    rng = np.random.default_rng(0)
    rows = vectors.unit(rng.normal(size=(300, 64)))
    code, scale, err = vectors.encode(rows, np.int8)
    true = rows @ rows.T
    some = np.arange(300)
    for least in (0.0, 0.3):
        got = {}
        for i, j, est, bound in vectors.tile_survivors(code, scale, err, some, None, least, tile=64):
            assert (np.abs(true[i, j] - est) <= bound).all()
            got |= dict.fromkeys(zip(i.tolist(), j.tolist(), strict=True))
        assert {(i, j) for i, j in zip(*np.nonzero(true >= least), strict=True) if i < j} <= set(got)


def test_blocks_meet_every_pair_once(spark):
    df = spark.range(50).select(F.lit(1).cast("long").alias("cell"), "id")
    rows = vectors.blocked_cells(df, 8).collect()
    tasks = {}
    for r in rows:
        tasks.setdefault(r.task, ([], []))[r.part].append(r.id)
    pairs = []
    for left, right in tasks.values():
        pairs += [(min(a, b), max(a, b)) for a in left for b in right] if right else [(min(a, b), max(a, b)) for i, a in enumerate(left) for b in left[:i]]
    assert len(pairs) == len(set(pairs)) == 50 * 49 // 2


def cloud(rng, n, spread):
    centre = rng.normal(size=(n // 6, 64))
    return np.concatenate([centre + spread * rng.normal(size=centre.shape) for _ in range(6)])


@pytest.mark.parametrize("config", [neighbours.NeighbourConfig(), neighbours.NeighbourConfig(rows_per_cell=100, sample=400)])
def test_neighbours_against_brute_force(spark, config):
    rng = np.random.default_rng(2)
    x = cloud(rng, 600, 0.25)
    x = np.concatenate([x, np.repeat(x[:1], 12, axis=0), x[5:8] * 3]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 64), (9002, [1.0] * 32), (9003, [float("nan")] * 64), (None, [1.0] * 64), (3, x[3].tolist())]
    df = spark.createDataFrame(rows, "face_id long, e array<float>").withColumns({"id": F.lit(1), "rep": F.lit(2)})
    got = {(r.a, r.b) for r in neighbours.nearest(df, "face_id", "e", config).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    want = set()
    for i in range(len(x)):
        near = [j for j in np.lexsort((np.arange(len(x)), -s[i])) if j != i and s[i, j] >= 0.85][:5]
        want |= {(i, int(j)) for j in near}
    if config.rows_per_cell > 1000:
        # vectors equal but for their length tie within rounding: compare similarities there
        for a, b in got ^ want:
            assert any(np.isclose(s[a, b], s[a, c], atol=1e-7) for c in range(len(x)) if c != b and c != a)
        assert len(got ^ want) <= 12 * 3 * 2
    else:
        assert len(got & want) >= 0.9 * len(want)
    assert neighbours.nearest(df.limit(0), "face_id", "e", config).count() == 0


@pytest.mark.parametrize("config", [neighbours.NeighbourConfig(), neighbours.NeighbourConfig(rows_per_cell=100, sample=400)])
def test_neighbours_among_near_copies(spark, config, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(2, 64))
    near = np.concatenate([centre[:1] + 2e-3 * rng.normal(size=(60, 64)), centre[1:] + 3e-4 * rng.normal(size=(200, 64))])
    x = np.concatenate([near, cloud(rng, 300, 0.25)]).astype(np.float32)
    x = np.concatenate([x, x[:3]])  # equal vectors among the near ones
    monkeypatch.setattr(vectors, "BLOCK", 100)
    monkeypatch.setattr(vectors.blocked_cells, "__defaults__", (100,))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows + rows[::2], "face_id long, e array<float>")
    got = {(r.a, r.b) for r in neighbours.nearest(df, "face_id", "e", config).collect() if r.a < 260}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 14)
    want = {(i, int(j)) for i in range(260) for j in [j for j in np.lexsort((np.arange(len(x)), -s[i])) if j != i and s[i, j] >= 0.85][:5]}
    assert got == want


@pytest.mark.parametrize("config", [history.HistoryConfig(), history.HistoryConfig(hot=3, broadcast_rows=0, broadcast_vectors=0, settle_rows=2, buckets=3)])
def test_history_is_greedy(spark, config):
    rng = np.random.default_rng(4)
    x = cloud(rng, 90, 0.2)
    x = np.concatenate([x, x[:5]])
    rows = [(i, "ab"[i % 2] if i % 11 else None, i % 4, f"M{i % 30}" if i % 3 else None, v.tolist() if i % 7 else None) for i, v in enumerate(x)]
    schema = "seq long, label string, batch_no int, md5 string, embedding array<float>"
    df = spark.createDataFrame(rows + rows[:3], schema).withColumn("vec", F.lit("x"))
    refs = spark.createDataFrame([("a", x[0].tolist())], "label string, ref array<float>")
    want, kept = set(), []
    for s, label, _, md5, e in sorted((r for r in rows if r[1]), key=lambda r: (r[2], r[0])):
        v = None if e is None else np.array(e, np.float32).astype(float) / np.linalg.norm(np.array(e, np.float32).astype(float))
        if any(k[0] == label and (md5 and md5 == k[1] or v is not None and k[2] is not None and v @ k[2] >= 0.92) for k in kept):
            want.add(s)
        else:
            kept.append((label, md5, v))
    got = [r.seq for r in history.replay(df, refs, config).collect()]
    assert sorted(got) == sorted(want)
    assert history.replay(df.limit(0), refs).count() == 0


@pytest.mark.parametrize("config", [history.HistoryConfig(), history.HistoryConfig(settle_rows=10, hot=25)])
def test_a_long_chain_is_settled(spark, config):
    frames = [[float(i <= d < i + 13) for d in range(64)] for i in range(50)]  # each is at 0.923 to the next one only
    rows = [(i, "a", 1, None, v) for i, v in enumerate(frames)] + [(100 + i, "b", 1, f"m{i // 2}", v) for i, v in enumerate(frames[:30])] + [(200, "b", 1, "m3", None)]
    rows += [(300 + i, "b", 1, None, frames[40]) for i in range(9)] + [(400 + i, "c", 1, "m", [1.0] * 63 + [float(i)]) for i in range(-40, 40)]  # copies of one vector; of one md5
    df = spark.createDataFrame(rows, "seq long, label string, batch_no int, md5 string, embedding array<float>")
    refs = spark.createDataFrame([], "label string, ref array<float>")
    got = sorted(r.seq for r in history.replay(df, refs, config).collect())
    store = history.History(spark, refs, config=config)
    again = [r.ord & ((1 << history.SEQ_BITS) - 1) for r in store.ingest(history.arrivals(df).drop("batch")).collect()]
    assert sorted(again) == got and store.ingest(history.arrivals(df.limit(0)).drop("batch")).count() == 0
    assert got == list(range(1, 50, 2)) + list(range(101, 130, 2)) + [200] + list(range(301, 309)) + list(range(361, 440))


def test_each_batch_is_ingested_on_its_own(spark, monkeypatch):
    met = []

    def prepare(self, batch):
        met.append(sorted(r.ord & ((1 << history.SEQ_BITS) - 1) for r in batch.collect()))

    monkeypatch.setattr(history.History, "prepare", prepare)
    monkeypatch.setattr(history.History, "settle", lambda self, batch: None)
    df = spark.createDataFrame([(i, "a", i % 5, f"m{i}", None) for i in range(10)], "seq long, label string, batch_no int, md5 string, embedding array<float>")
    history.replay(df, spark.createDataFrame([], "label string, ref array<float>"))
    assert met == [[i, i + 5] for i in range(5)]


def test_history_stays_where_it_is(spark, monkeypatch):
    """A batch of too many keys to broadcast: neither stored keys nor stored records are shuffled to meet it."""
    plans, write = [], history.written

    def written(df, tag):
        plans.append((tag, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, tag)

    monkeypatch.setattr(history, "written", written)
    rng = np.random.default_rng(8)
    rows = [(i, "a", i % 2, f"m{i % 30}", v.tolist()) for i, v in enumerate(cloud(rng, 60, 0.2))]
    df = spark.createDataFrame(rows, "seq long, label string, batch_no int, md5 string, embedding array<float>")
    refs = spark.createDataFrame([], "label string, ref array<float>")
    assert history.replay(df, refs, history.HistoryConfig(broadcast_rows=0)).count() >= 30
    pairs, links = ([plan for tag, plan in plans if tag == f"history-{x}"][-1] for x in ("pairs", "links"))
    assert "Exchange hashpartitioning(key" not in pairs and pairs.count("ShuffledHashJoin") == 2
    scan = links[links.index("ShuffledHashJoin") :].split("Filter")[0]
    assert "Exchange" not in scan and links.count("ShuffledHashJoin") >= 1


def test_a_batch_leaves_little_with_the_driver(spark, monkeypatch):
    """A batch takes few jobs, whose plans, metrics and threads the driver keeps for a while, and its garbage is collected."""
    cleared = []
    monkeypatch.setattr(history, "released", cleared.append, raising=False)
    rows = [(i, "a", i % 6, f"m{i % 30}", v.tolist()) for i, v in enumerate(cloud(np.random.default_rng(8), 60, 0.2))]
    df = spark.createDataFrame(rows, "seq long, label string, batch_no int, md5 string, embedding array<float>")
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    got = history.replay(df, spark.createDataFrame([], "label string, ref array<float>"))
    assert jobs() - before <= 27 * 6
    assert len(cleared) == 6 and got.count() >= 30


def test_band_keys_select(spark):
    """Pairs at a cosine of 0.92 share a key; less than one in a hundred of unrelated pairs do."""
    config = history.HistoryConfig()
    rng = np.random.default_rng(9)
    x = vectors.unit(rng.normal(size=(4000, 64)))
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.92 * x + np.sqrt(1 - 0.92**2) * vectors.unit(z)
    batch = lambda rows: pa.RecordBatch.from_pylist([{"ord": i, "label": "a", "md5": None, "vector": v, "ref": None} for i, v in enumerate(rows.tolist())], pa.schema([("ord", pa.int64()), ("label", pa.string()), ("md5", pa.string()), ("vector", pa.list_(pa.float32())), ("ref", pa.list_(pa.float32()))]))
    (a,), (b,) = (list(history._sign(config)([batch(rows)])) for rows in (x, y))
    keys = [np.array(r.column("bands").to_pylist()) for r in (a, b)]
    signs = [np.stack([r.column(s).to_numpy() for s in ("s1", "s2")], 1).view(np.uint64) for r in (a, b)]
    differ = np.bitwise_count(signs[0] ^ signs[1]).sum(axis=1)
    assert ((keys[0] == keys[1]).any(axis=1) & (differ <= config.sketch_bits)).mean() > 0.997
    assert (keys[0] == np.roll(keys[1], 1, axis=0)).any(axis=1).mean() < 0.01


# -- problems 7 and 8

ODD = ["", " ", "a", "'s 's's 'll 'LL  x\n\n y  \n", "it's  they'll", "''s", "<|endoftext|>", "'re've", " -'s", "\t's", "x" * 3000, " " * 2000, "abcdef" * 700, "\r\n\r\n  a\x00b\x1c c", "é " + chr(0x4E00) * 3 + chr(0x1F600) + chr(0xFEFF) + chr(0x200B) + " 1" + chr(0x2160) + chr(0xB2)]


def test_bpe_on_odd_texts_equals_two_public_libraries(spark):
    import tiktoken
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.TOKENIZER)
    t.encode_special_tokens = True
    with open(bpe.TOKENIZER.replace(".json", ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)] + [(99, None), (0, ODD[0])], "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = bpe.encode_corpus(df, "doc_id", "text").collect()
    assert len(rows) == len(ODD) + 2
    got = {r.id: r.ids for r in rows}
    assert got[99] == []
    for i, x in enumerate(ODD):
        assert got[i] == t.encode(x, add_special_tokens=False).ids == own.encode_ordinary(x), repr(x[:40])
    assert {r.id: r.tokens for r in bpe.token_counts(df, "doc_id", "text").collect()} == {k: len(v) for k, v in got.items()}


def test_pieces_of_a_long_text_give_the_ids_of_the_whole():
    whole = "".join(ODD) + " x\u00b2 y 12 a1 b  c _ d it's they 'll " * 40 + "z" * 500
    enc = bpe.encoder(bpe.TOKENIZER)
    for most in (1, 7, 60, 10**6):
        pieces = list(bpe._pieces(whole, most))
        assert "".join(pieces) == whole and (most > len(whole)) == (len(pieces) == 1)
        assert np.concatenate([enc.encode([p])[0] for p in pieces]).tolist() == enc.encode([whole])[0].tolist()
    assert [t for some in bpe._chunks(["ab", None, "c" * 9, "d", ""], 4) for t in some] == ["ab", "", "c" * 9, "d", ""]


def test_long_and_short_merges_agree():
    m = bpe.Merges(bpe.TOKENIZER)
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 16, 31):
        word = bytes(rng.choice(list(b"theinga "), n).tolist())
        table = np.zeros((1, 32), np.uint8)
        table[0, :n] = list(word)
        ids = m.merge_many(table, np.array([n]))[0]
        assert ids[ids >= 0].tolist() == m.merge_long(word).tolist()


def test_packing_edges(spark):
    sizes = spark.createDataFrame([(1, 10), (2, 0), (3, 25), (4, 4), (5, 6), (None, 3), (6, None), (4, 4), (7, 10)], "id long, tokens long")
    caps = spark.createDataFrame([(1, 10), (2, 100), (3, 0), (None, 5), (2, 100)], "capacity_id int, capacity int")
    rows = packing.pack(sizes, caps).collect()
    one = [r for r in rows if r.capacity_id == 1]
    assert sorted((r.doc_id, r.piece, r["size"]) for r in one) == [(1, 0, 10), (2, 0, 0), (3, 0, 10), (3, 1, 10), (3, 2, 5), (4, 0, 4), (5, 0, 6), (7, 0, 10)]
    assert len({r.bin for r in one}) == 6 and {r.bin for r in rows if r.capacity_id == 2} == {0}
    assert {r.capacity_id for r in rows} == {1, 2}
    assert packing.pack(sizes.limit(0), caps).count() == 0


def test_a_sweep_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(20):
        capacity = int(rng.integers(5, 60))
        sizes = sorted(rng.integers(1, capacity + 1, 200).tolist(), reverse=True)
        found, rest = packing.sweep(sizes, [], capacity, 0, True)
        gaps = []
        for s in sizes:
            fit = [g for g in gaps if g >= s]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - s)
            else:
                gaps.append(capacity - s)
        assert max(b for b, _ in found) + 1 == len(gaps) and sorted(g for g, _ in rest) == sorted(g for g in gaps if g)


def test_packing_in_rounds_over_many_tasks_and_capacities(spark):
    rng = np.random.default_rng(3)
    tokens = np.r_[rng.integers(1, 400, 800), rng.integers(1, 3000, 100), [20_000_000] * 2, np.repeat(70, 300)]
    sizes = spark.createDataFrame([(int(i), int(n)) for i, n in enumerate(tokens)], "id long, tokens long")
    for capacities in ([1000], [10_000_000], list(range(3_000, 3_040))):
        caps = spark.createDataFrame(list(enumerate(capacities)), "capacity_id int, capacity long")
        some = sizes if capacities[0] > 5_000 else sizes.where("tokens < 10000")
        rows = packing.pack(some, caps, items_a_task=64).toPandas()
        assert not rows.duplicated(["capacity_id", "doc_id", "piece"]).any()
        for i, capacity in enumerate(capacities):
            own = rows[rows.capacity_id == i].sort_values(["bin", "offset"])
            total = sum(t for t in tokens.tolist() if capacities[0] > 5_000 or t < 10_000)
            assert own["size"].sum() == total and set(own.bin) == set(range(own.bin.max() + 1))
            ends = own.groupby("bin")["size"].cumsum()
            assert (ends - own["size"] == own.offset).all() and ends.max() <= capacity
            assert own.bin.max() + 1 <= total / capacity * 1.01 + 2


# -- problem 9

PROSE = "She told us that the old bridge was still in the river, although nobody had asked for it. Why does the new reader need a table?"


@pytest.mark.parametrize(
    ("text", "prose_"),
    [
        (PROSE, True),
        ("# Title here\n\n" + "\n".join("# " + PROSE[i : i + 60].strip() for i in (0,)) + "\n\n" + PROSE, True),
        ("<p>" + PROSE + "</p>", True),
        ("Wir haben die Anlage so gebaut, dass jede einfache Straße auch ohne die andere Liste läuft.", True),
        ("¿Por qué la máquina guarda la simple puerta? La respuesta cambia una antigua sección cuando no hay otra para los demás.", True),
        ("la\nque\nde\nes\nen\nella\n" * 30, False),
        ("Il libro della nostra casa è sempre aperto. Nessuno sa quando la porta venga chiusa.", True),
        ("1) Node crop.\n2) Entry node.\n3) Batch meta.\n" * 9, False),
        ("def f(x):\n    # " + PROSE.split(".")[0] + ".\n" + "    y = g(x) + h[x, 1]\n    return y * 3\n" * 9, False),
        ("a,b,c\n1,2,3\n" * 50, False),
        ("", False),
        (" \n ", False),
        (None, False),
        ("x" * 100_000, False),
    ],
)
def test_sentences(text, prose_):
    assert (prose.statistics(text)[6] > 0.5) is prose_


def test_scores_with_nulls_ties_and_repeats(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, PROSE), (4, PROSE), (4, PROSE), (None, PROSE)], "doc_id long, text string").withColumn("language", F.lit("x")).withColumn("junk", F.lit("y"))
    rows = prose.prose_scores(df, "doc_id", "text").collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4]
    by = {r.doc_id: r for r in rows}
    assert by[3].outlier == by[4].outlier == 0 and by[3].prose and by[4].prose and not by[1].prose and not by[2].prose
    assert prose.prose_scores(df.limit(0), "doc_id", "text").count() == 0


def test_the_scores_tell_made_up_words_from_a_language(spark):
    made_up = "Couo tuiuqez rzrz peqaizqt giztirzzo greitaxq. Prezq tzrtz jiiuqqx vrerzz hxtoei veexuexoz cezrxtto ttoqrzz."
    ours = ["She", "He", "It", "They", "You", "We"], ["told", "asked", "gave", "left"], ["us", "them", "him", "her"], ["the old bridge", "a new table", "all of the files", "some time"]
    texts = [f"{a} {b} {c} {d} when it was late, and so did {e.lower()} before." for a in ours[0] for b in ours[1] for c in ours[2] for d in ours[3] for e in ours[0][:2]]
    rows = [(0, made_up), *((i, t) for i, t in enumerate(texts, 1))]
    got = {r.doc_id: r for r in prose.prose_scores(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert got[0].language == "none" and got[0].sentence_words > 0.5 and not got[0].prose
    assert sum(got[i].prose for i in range(1, len(rows))) >= 0.99 * len(texts)
