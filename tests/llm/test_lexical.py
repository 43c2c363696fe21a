import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import lexical as L
from tests.llm.data import SF, awkward, frame, with_clash

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def brute(rows, items, k=10):
    """All scores of all documents; rows are (doc_id, text, ...)."""
    def low(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    docs = [(r[0], Counter(TERM.findall(low(r[1])))) for r in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total = sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(low(t)))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in docs:
            m = 100 - 90 + (90 * n * len(docs)) // total
            s = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms():
    assert L.terms("Äb-C3d É\x85x\x7fy_Z\U0001f600") == ["Äb", "c3d", "É\x85x", "y", "z\U0001f600"]
    assert L.terms(None) == L.terms(" .,-") == []


def test_awkward_rows(spark):
    rows = awkward(200)
    items = [(1, rows[3][1][:300]), (2, "the THE the"), (3, None), (4, ""), (None, rows[7][1][:200]), (5, "zzzunknown"), (1, rows[9][1][:100]),
             (6, " ".join(r[1] for r in rows[:30]))]
    df = with_clash(frame(spark, rows), "rank", "score", "item_id", "terms")
    benchmark = with_clash(frame(spark, items, ITEMS), "doc_id", "terms", "item")
    assert got(L.query(df, benchmark)) == brute(rows, items)


def test_shards_and_item_blocks(spark, monkeypatch):
    """Small shards, small blocks and several item blocks change no result."""
    rows = awkward(200)
    items = [(i, rows[i][1][:250]) for i in range(0, 60, 3)]
    for name, value in (("SHARD_DOCS", 40), ("ITEMS", 7)):
        monkeypatch.setattr(L, name, value)
    monkeypatch.setattr(L, "BLOCK", 8)
    assert got(L.search(frame(spark, rows), frame(spark, items, ITEMS), 4)) == brute(rows, items, 4)


def test_empty_tables(spark):
    docs, items = frame(spark, awkward(10)), frame(spark, [(1, "the a")], ITEMS)
    assert L.query(docs.limit(0), items).collect() == [] and L.query(docs, items.limit(0)).collect() == []
    assert L.query(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_scores_rank_by_id(spark):
    rows = [(i, "same words here", "en", "s", 1) for i in (9, 3, 3, None, 12)] + [(100 + i, f"other{i}", "en", "s", 1) for i in range(9)]
    found = L.query(frame(spark, rows), frame(spark, [(1, "words")], ITEMS)).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [3, 3, 9, 12, None] and len({r.score for r in found}) == 1


@pytest.mark.parametrize("seed", range(4))
def test_blocks_are_skipped_and_nothing_is_lost(seed):
    """Documents of a few topics: most block visits are skipped, the best are those of all pairs."""
    rng = np.random.default_rng(seed)
    n, v, k = 3000, 120, 5
    topic = rng.integers(0, 12, n)
    doc, term = [], []
    for i in range(n):
        own = np.unique(np.concatenate([rng.integers(0, 10, 4), 10 + topic[i] * 9 + rng.integers(0, 9, 5)]))
        doc += [i] * len(own)
        term += own.tolist()
    doc, term = np.array(doc), np.array(term)
    impact = rng.integers(1, 1000, len(doc)) * 1000
    weight = np.where(np.arange(v) < 10, 50, rng.integers(500, 4000, v))
    asked = [np.sort(rng.choice(np.r_[0:10, 10 + t * 9:19 + t * 9], 8, replace=False)) for t in range(12)]
    best, seen = L.Best(12, k), Counter()
    ids = rng.permutation(n)
    L.search_shard(L.Queries(asked, weight), ids, np.zeros(n, dtype=bool), doc, term, impact, best, seen)
    full = np.zeros((n, v), dtype=np.int64)
    full[doc, term] = impact
    for i, t in enumerate(asked):
        score = full[:, t] @ weight[t]
        order = np.lexsort((ids, -score))[:k]
        assert best.rows[i][0].tolist() == score[order].tolist() and best.rows[i][1].tolist() == ids[order].tolist()
    assert seen["skipped"] > 0 and seen["scored"] < 0.6 * 12 * n


def test_large_weights_stay_exact():
    """Sums beyond 2^53 are taken in integers."""
    q = L.Queries([np.arange(3)], np.array([1 << 40, (1 << 40) + 1, 5]))
    assert q.matrix.dtype == np.int64
    best = L.Best(1, 1)
    L.search_shard(q, np.array([7, 8]), np.zeros(2, dtype=bool), np.array([0, 1]), np.array([0, 1]), np.array([10 ** 6, 10 ** 6]), best)
    assert best.rows[0][1].tolist() == [8] and best.rows[0][0].tolist() == [((1 << 40) + 1) * 10 ** 6]


def test_blocks_cover_the_list():
    points = np.random.default_rng(1).normal(size=(1000, L.PROJECTED))
    order, starts = L.blocks_of(points)
    assert sorted(order.tolist()) == list(range(1000)) and starts[0] == 0 and np.diff(np.append(starts, 1000)).max() <= 2 * L.BLOCK
    order, starts = L.blocks_of(np.zeros((500, L.PROJECTED)))             # all alike
    assert sorted(order.tolist()) == list(range(500)) and np.diff(np.append(starts, 500)).max() <= 2 * L.BLOCK


def test_whole_table_against_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(L.query(docs, items)) == brute(rows, [(r.item_id, r.text) for r in items.collect()])
