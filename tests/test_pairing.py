import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.pairing import pair_fold, pair_window
from ledgerline.schemas import INSTRUCTION_STRUCT, T

EV, INS = "PumpFunTradeEvent", "PumpFunBuy"


def simulate(seq):
    stack, out = [], []
    for i, is_ev in enumerate(seq):
        if is_ev:
            if stack:
                out.append((i, stack.pop()))
        else:
            stack.append(i)
    return out


def tx_df(spark, seqs):
    rows = []
    for t, seq in enumerate(seqs):
        ins = [(EV if e else INS, "PumpfunTradeEvent" if e else "PumpfunBuy", None, None, None) for e in seq]
        rows.append((t, ins))
    schema = T.StructType([T.StructField("tx", T.LongType()),
                           T.StructField("instructions", T.ArrayType(INSTRUCTION_STRUCT))])
    return spark.createDataFrame(rows, schema)


def flat_df(spark, seqs):
    rows = [(t, i, EV if e else INS) for t, seq in enumerate(seqs) for i, e in enumerate(seq)]
    return spark.createDataFrame(rows, "tx long, pos long, type string")


CASES = {
    "IE": [(1, 0)], "EIE": [(2, 1)], "IIEE": [(2, 1), (3, 0)], "IEE": [(1, 0)],
    "IEEIE": [(1, 0), (4, 3)], "III": [], "": [],
}


def to_seq(s):
    return [c == "E" for c in s]


def test_fixture_cases_fold(spark):
    seqs = [to_seq(s) for s in CASES]
    got = pair_fold(tx_df(spark, seqs)).select("tx", "position", "partner_position").collect()
    by = {}
    for r in got:
        by.setdefault(r.tx, []).append((r.position, r.partner_position))
    for t, s in enumerate(CASES):
        assert sorted(by.get(t, [])) == CASES[s], s


@pytest.mark.parametrize("skew_safe", [True, False])
def test_fixture_cases_window(spark, skew_safe):
    seqs = [to_seq(s) for s in CASES]
    got = pair_window(flat_df(spark, seqs), ["tx"], ["pos"], "type", skew_safe=skew_safe) \
        .where("partner_position IS NOT NULL").select("tx", "position", "partner_position").collect()
    by = {}
    for r in got:
        by.setdefault(r.tx, []).append((r.position, r.partner_position))
    for t, s in enumerate(CASES):
        assert sorted(by.get(t, [])) == CASES[s], s


def test_lag_over_raw_order_is_wrong():
    # A B ev ev: the second event pairs with A, not with B
    assert simulate([False, False, True, True]) == [(2, 1), (3, 0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.booleans(), min_size=0, max_size=40), min_size=1, max_size=12))
def test_forms_match_simulation(spark, seqs):
    expect = sorted((t, e, p) for t, seq in enumerate(seqs) for e, p in simulate(seq))
    fold = sorted(tuple(r) for r in pair_fold(tx_df(spark, seqs)).select("tx", "position", "partner_position")
                  .collect())
    assert fold == expect
    win = sorted(tuple(r) for r in pair_window(flat_df(spark, seqs), ["tx"], ["pos"], "type", skew_safe=True,
                                               position_col="pos")
                 .where("partner_position IS NOT NULL").select("tx", "pos", "partner_position").collect())
    assert win == expect


def test_one_huge_transaction_is_split(spark):
    """A single transaction spread over many range partitions still pairs exactly."""
    rng = random.Random(7)
    seq = [rng.random() < 0.45 for _ in range(5000)]
    seqs = [seq, [False, True]]
    expect = sorted((t, e, p) for t, s in enumerate(seqs) for e, p in simulate(s))
    df = flat_df(spark, seqs)
    got = pair_window(df, ["tx"], ["pos"], "type", skew_safe=True, position_col="pos") \
        .where("partner_position IS NOT NULL").select("tx", "pos", "partner_position")
    assert sorted(tuple(r) for r in got.collect()) == expect
    derived = pair_window(df.withColumn("o", F.col("pos") * 3), ["tx"], ["o"], "type", skew_safe=True) \
        .where("partner_position IS NOT NULL").select("tx", "position", "partner_position")
    assert sorted(tuple(r) for r in derived.collect()) == expect
