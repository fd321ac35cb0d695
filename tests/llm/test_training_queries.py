"""The pN_ queries with SQL against it, and brute force where SQL has no counterpart."""

import numpy as np
import pytest

from quarrymill.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(name, same_rows):
    same_rows(Q.QUERIES[name], Q.ORACLES[name])


def test_p3_is_the_sequential_loop(spark, sf, duck):
    rows = duck.execute("SELECT DISTINCT seq, label, batch_no, lower(md5), embedding FROM dedup_item WHERE label IS NOT NULL ORDER BY batch_no, seq").fetchall()
    want, store = set(), {}
    for seq, label, _, md5, e in rows:
        md5s, vectors = store.setdefault(label, (set(), []))
        v = None
        if e is not None and len(e) == 64 and not np.isnan(e).any() and np.any(e):
            v = np.array(e, float) / np.linalg.norm(e)
        if md5 is not None and md5 in md5s or v is not None and vectors and (np.array(vectors) @ v).max() >= 0.92:
            want.add(seq)
            continue
        if md5 is not None:
            md5s.add(md5)
        if v is not None:
            vectors.append(v)
    got = [r.seq for r in Q.p3_found(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_p2_groups_are_the_components_of_p2_found(spark, sf):
    parent = {r.seq: r.seq for r in Q.p2_groups(spark, sf).collect()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in Q.p2_found(spark, sf).collect():
        a, b = sorted((root(r.seq_a), root(r.seq_b)))
        parent[b] = a
    assert all(root(r.seq) == r.group for r in Q.p2_groups(spark, sf).collect())


def test_p7_equals_the_public_library(spark, sf):
    from tokenizers import Tokenizer

    from quarrymill.llm.bpe import TOKENIZER

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in Q.p7_ids(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, e in zip(texts, t.encode_batch(list(texts.values()), add_special_tokens=False), strict=True):
        assert got[i] == e.ids


def test_p8_containers(spark, sf):
    rows = Q.p8_bins(spark, sf).collect()
    capacity = {r.capacity_id: r.capacity for r in spark.read.parquet(f"{sf}/pack_capacity.parquet").collect()}
    sizes = {r.doc_id: len(r.ids) for r in Q.p7_ids(spark, sf).collect()}
    whole, fill = {}, {}
    for r in rows:
        whole[r.capacity_id, r.doc_id] = whole.get((r.capacity_id, r.doc_id), 0) + r.size
        fill.setdefault((r.capacity_id, r.bin), []).append((r.offset, r.size))
        assert r.size == min(capacity[r.capacity_id], sizes[r.doc_id] - r.piece * capacity[r.capacity_id])  # divided only beyond the capacity
    assert whole == {(c, d): n for c in capacity for d, n in sizes.items()}
    for (c, _), items in fill.items():
        at = 0
        for offset, size in sorted(items):
            if size:
                assert offset == at
                at += size
        assert at <= capacity[c]
    for r in Q.p8_fill(spark, sf).collect():
        assert r.containers <= -(-r.tokens // r.capacity) * 1.02 + 1


def test_p9_scores(spark, sf):
    rows = Q.p9_statistics(spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    assert {r.doc_id for r in rows if r.prose} == {r.doc_id for r in Q.p9_found(spark, sf).collect()}
    tails = {"word_count": None, "mean_word_length": "right", "symbol_ratio": "right", "punctuated_lines": None, "common_words": "left", "sentence_words": None}
    reference = [r for r in rows if r.sentence_words > 0.5 and r.language != "none"]
    junk = {}
    for r in rows:
        own = [x for x in reference if r.language in ("none", x.language)]
        left = {n: -np.log((sum(x[n] <= r[n] for x in own) + 1) / (len(own) + 1)) for n in tails}
        right = {n: -np.log((sum(x[n] >= r[n] for x in own) + 1) / (len(own) + 1)) for n in tails}
        junk[r.doc_id] = sum({"left": left, "right": right}[t][n] for n, t in tails.items() if t)
        assert np.isclose(sum(left.values()), r.left_score) and np.isclose(sum(right.values()), r.right_score) and np.isclose(junk[r.doc_id], r.junk)
    scores = sorted(r.junk for r in reference)
    limit = scores[int(np.ceil(0.998 * len(scores))) - 1]
    assert {r.doc_id for r in rows if r.prose} == {r.doc_id for r in rows if r.junk <= limit and r.sentence_words > 0.5}


def test_p1_report_counts_what_the_filter_got_wrong(spark, sf):
    r = Q.p1_error_rate(spark, sf).first()
    assert r.seen_before == Q.p1_found(spark, sf).count() and r.disproved == r.filter_positives - r.seen_before >= 0
