import zlib

import duckdb
import numpy as np
import pytest

from ledgerline.llm import quality as Q
from tests.llm.data import awkward, frame, with_clash

LABELS = "doc_id long, quality int, toxic int"


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_context_sums_brute():
    texts = ["a b c a", "", "x ## y", "Z z"]
    index = Q.index_vectors()
    want = np.zeros((Q.WORDS, Q.DIMS), dtype=np.int64)
    for t in texts:
        w, _ = Q.word_buckets([t])
        for i in range(len(w)):
            for j in range(max(0, i - Q.SPAN), min(len(w), i + Q.SPAN + 1)):
                if i != j:
                    want[w[i]] += index[w[j]]
    assert (Q.context_sums(texts, index) == want).all()
    assert (np.abs(index).sum(axis=1) == Q.NONZERO).all()


def test_words():
    w, text = Q.word_buckets(["Word word, WORD", "a"])
    assert len(w) == 5 and w[0] == w[1] and w[0] != w[3] and text.tolist() == [0, 0, 0, 0, 1]


def test_word_vectors_from_all_rows(spark):
    rows = awkward(20)
    one = Q.word_vectors(frame(spark, rows).coalesce(1))
    many = Q.word_vectors(frame(spark, rows).repartition(7))
    assert np.allclose(one, many)


def test_pooled_alone_and_together():
    vectors = np.random.default_rng(0).normal(size=(Q.WORDS, Q.DIMS)).astype(np.float32)
    texts = ["a b c", "", "x y x y " * 50, "?"]
    assert np.allclose(Q.pooled(texts, vectors), np.concatenate([Q.pooled([t], vectors) for t in texts]), atol=1e-5)
    assert not Q.pooled([""], vectors).any()


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, Q.POOLED))
    p = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    net = Q.Network(x, (rng.random(3000) < p).astype(float))
    fresh = rng.normal(size=(4000, Q.POOLED))
    got, want = net.scores(fresh), 1 / (1 + np.exp(-1.5 * fresh[:, 0]))
    assert net.temperature != 1.0 and abs(got.mean() - want.mean()) < 0.05 and np.corrcoef(got, want)[0, 1] > 0.85


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    docs = con.execute("SELECT doc_id, text, lang, source, n_chars FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    return docs, con.execute("SELECT doc_id, quality, toxic FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()


def test_held_out(spark, tables):
    docs, labels = tables
    df = with_clash(frame(spark, docs), "id", "label", "h", "score")
    got = {r.doc_id: r for r in Q.query(df, spark.createDataFrame(labels, LABELS)).collect()}
    held = [(got[i].score, q) for i, q, _ in labels if crc(i, 3) == 1]
    assert len(got) == len(docs) and all(r.held_out == (crc(i, 3) == 1) for i, r in got.items())
    good, bad = ([s for s, q in held if q == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_awkward_rows_and_labels(spark):
    rows = awkward(40)
    labels = [(r[0], i % 2, None) for i, r in enumerate(rows[:30])] + [(None, 1, 0), (3, None, 0), (4, 1, 0), (77777, 1, 0)]
    assert Q.query(frame(spark, rows), spark.createDataFrame(labels, LABELS)).count() == len(rows)
    none = Q.query(frame(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert Q.query(frame(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0
