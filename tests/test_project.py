from pyspark.sql import functions as F

from ledgerline.operators.pairing import pair_fold
from ledgerline.operators.project import project
from ledgerline.schemas import ACCOUNTS_STRUCT, EVENT_STRUCT, TRANSACTION_SCHEMA

ACC = {f.name: bytes([i + 1]) * 32 for i, f in enumerate(ACCOUNTS_STRUCT.fields)}


def ev(etype, kind, **fields):
    e = {f.name: None for f in EVENT_STRUCT.fields}
    e.update(fields)
    return (etype, kind, e, None, None)


def ins(itype, kind, accounts=True, main=True):
    return (itype, kind, None, dict(ACC) if accounts else None, main)


def tx(instructions, sig=b"\x01" * 64, slot=5, index=-1):
    return (sig, slot, index, instructions)


def run(spark, txs, kind):
    from decimal import Decimal
    rows = [(s, Decimal(sl), i, ins_) for s, sl, i, ins_ in txs]
    df = spark.createDataFrame(rows, TRANSACTION_SCHEMA)
    return project(pair_fold(df), kind).collect()


BUY = dict(timestamp=-1, base_amount_out=None)


def test_amm_wrong_partner_consumes_it(spark):
    # I(sell)  I(buy)  E(buy)  E(buy): the first event pops the buy instruction,
    # the second pops the sell instruction (wrong kind) and is rejected.
    t = tx([ins("PumpFunAmmSell", "PumpfunAmmSell"), ins("PumpFunAmmBuy", "PumpfunAmmBuy"),
            ev("PumpFunAmmBuyEvent", "PumpfunAmmBuyEvent", timestamp=7),
            ev("PumpFunAmmBuyEvent", "PumpfunAmmBuyEvent", timestamp=8)])
    got = run(spark, [t], "amm_buy")
    assert [(r.instruction_index, r.timestamp) for r in got] == [(2, 7)]
    assert got[0].transaction_index == 4294967295          # -1 wraps modulo 2^32
    assert got[0].base_mint == "4vJ9JU1bJJE96FWSJKvHsmmFADCg4gpZQff4P3bkLKi"   # 32 x 0x01


def test_amm_partner_without_accounts_rejected(spark):
    t = tx([ins("PumpFunAmmSell", "PumpfunAmmSell", accounts=False),
            ev("PumpFunAmmSellEvent", "PumpfunAmmSellEvent", timestamp=1)])
    assert run(spark, [t], "amm_sell") == []


def test_trade_accepts_any_parsed_partner_not_absent(spark):
    ok = tx([ins("Whatever", "PumpfunAmmWithdraw", accounts=False),
             ev("PumpFunTradeEvent", "PumpfunTradeEvent", timestamp=3, is_buy=True)])
    absent = tx([ins("Whatever", None), ev("PumpFunTradeEvent", "PumpfunTradeEvent", timestamp=4)],
                sig=b"\x02" * 64)
    got = run(spark, [ok, absent], "trade")
    assert [(r.timestamp, r.is_buy) for r in got] == [(3, 1)]


def test_buy_exact_quote_in_partner(spark):
    t = tx([ins("PumpFunAmmBuyExactQuoteIn", "PumpfunAmmBuyExactQuoteIn", main=False),
            ev("PumpFunAmmBuyEvent", "PumpfunAmmBuyEvent", timestamp=4294967296 + 9)])
    got = run(spark, [t], "amm_buy")
    assert [(r.is_main_pool, r.timestamp) for r in got] == [(0, 9)]


def test_event_with_other_variant_is_dropped(spark):
    t = tx([ins("PumpFunBuy", "PumpfunBuy"), ev("PumpFunTradeEvent", "PumpfunCreateEvent", timestamp=1)])
    assert run(spark, [t], "trade") == []


def test_signature_is_base58(spark):
    t = tx([ins("PumpFunBuy", "PumpfunBuy"), ev("PumpFunTradeEvent", "PumpfunTradeEvent", timestamp=1)],
           sig=bytes(64))
    got = run(spark, [t], "trade")
    assert got[0].signature == "1" * 64 and got[0].instruction_index == 1
    assert F is not None


def test_inrow_bundle_equals_regrouped(spark):
    from ledgerline.operators.project import event_bundle, event_bundle_inrow
    from ledgerline.plans import standins as S
    from ledgerline.schemas import TABLES
    tx = S.transactions(spark, "/root/testdata/sf0.001")

    def norm(df):
        return sorted((r["user_id"], tuple(tuple(tuple(x) for x in r[t.name]) for t in TABLES)) for r in df.collect())
    assert norm(event_bundle(pair_fold(tx), ["user_id"])) == norm(event_bundle_inrow(tx, ["user_id"]))
    plan = event_bundle_inrow(tx, ["user_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1          # only the stand-in's own grouping


def test_keys_are_encoded_for_the_rows_of_a_kind_only(spark):
    from ledgerline.operators.project import rows_of, table_rows
    from ledgerline.plans import standins as S
    from ledgerline.schemas import TABLES, table_spec
    rows = table_rows(pair_fold(S.transactions(spark, "/root/testdata/sf0.001")))
    assert "_b58_udf" not in rows._jdf.queryExecution().executedPlan().toString()
    for t in TABLES:
        plan = rows_of(rows, t.name)._jdf.queryExecution().optimizedPlan().toString()
        udf = next(line for line in plan.split("\n") if "ArrowEvalPython" in line)
        assert udf.count("_b58_udf(") == sum(conv == "key" for *_, conv in table_spec(t.name).columns) <= 15
        assert plan.index("ArrowEvalPython") < plan.index("Filter")          # below the UDF: rows are filtered first
