"""Schema registry: the 8 typed event tables, the nested transaction input,
envelopes and the processed ledger.

Unsigned rules (what Spark itself reads from unsigned Parquet columns):
u64 -> DECIMAL(20,0), u32 -> BIGINT, u8 -> SMALLINT, i64 -> BIGINT.
32/64-byte keys arrive as BINARY and leave as base58 STRING.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

U64 = T.DecimalType(20, 0)

# Column conversion kinds of a spec entry.
#   key  binary -> base58 string        u64  carried as DECIMAL(20,0)
#   u32  wrapping narrow to [0, 2^32)   u8   boolean -> 0/1 SMALLINT
#   i64  BIGINT carried through         str  string carried through
OUT_TYPES = {
    "key": T.StringType(),
    "u64": U64,
    "u32": T.LongType(),
    "u8": T.ShortType(),
    "i64": T.LongType(),
    "str": T.StringType(),
}
IN_TYPES = {
    "key": T.BinaryType(),
    "u64": U64,
    "u32": T.LongType(),
    "u8": T.BooleanType(),
    "i64": T.LongType(),
    "str": T.StringType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str                 # short kind name, e.g. "amm_buy"
    event_type: str           # instruction ``type`` string of the event
    event_kind: str           # oneof variant name carried by the event instruction
    table: str                # default sink table name
    partner_kinds: tuple      # accepted partner variants; () = any parsed value
    needs_accounts: bool      # AMM kinds require the partner's accounts
    columns: tuple            # ((out_name, source, field, conv), ...)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, OUT_TYPES[conv], False) for c, _, _, conv in self.columns])


def _common():
    return (
        ("signature", "tx", "signature", "key"),
        ("slot", "tx", "slot", "u64"),
        ("transaction_index", "tx", "index", "u32"),
        ("instruction_index", "tx", "position", "u32"),
    )


def _ev(*names_and_convs):
    return tuple((n, "event", n, c) for n, c in names_and_convs)


def _acc(*names):
    return tuple((n, "accounts", n, "key") for n in names)


_MAIN_POOL = (("is_main_pool", "partner", "is_main_pool", "u8"),)

# Event type strings, table names and column lists of the 8
# event tables (these must equal the reference's data model).
TABLES = (
    TableSpec(
        "trade", "PumpFunTradeEvent", "PumpfunTradeEvent", "pumpfun_trade_event_v2", (), False,
        _common() + _ev(
            ("mint", "key"), ("sol_amount", "u64"), ("token_amount", "u64"), ("is_buy", "u8"),
            ("user", "key"), ("timestamp", "u32"), ("virtual_sol_reserves", "u64"),
            ("virtual_token_reserves", "u64"), ("real_sol_reserves", "u64"), ("real_token_reserves", "u64"),
            ("fee_recipient", "key"), ("fee_basis_points", "u64"), ("fee", "u64"), ("creator", "key"),
            ("creator_fee_basis_points", "u64"), ("creator_fee", "u64"), ("track_volume", "u8"),
            ("total_unclaimed_tokens", "u64"), ("total_claimed_tokens", "u64"),
            ("current_sol_volume", "u64"), ("last_update_timestamp", "i64"),
        ),
    ),
    TableSpec(
        "create", "PumpFunCreateEvent", "PumpfunCreateEvent", "pumpfun_create_event_v2", (), False,
        _common() + _ev(
            ("name", "str"), ("symbol", "str"), ("uri", "str"), ("mint", "key"), ("bonding_curve", "key"),
            ("user", "key"), ("creator", "key"), ("timestamp", "u32"), ("virtual_token_reserves", "u64"),
            ("virtual_sol_reserves", "u64"), ("real_token_reserves", "u64"), ("token_total_supply", "u64"),
        ),
    ),
    TableSpec(
        "migrate", "PumpFunMigrateEvent", "PumpfunMigrationEvent", "pumpfun_migrate_event_v2", (), False,
        _common() + _ev(
            ("user", "key"), ("mint", "key"), ("mint_amount", "u64"), ("sol_amount", "u64"),
            ("pool_migration_fee", "u64"), ("bonding_curve", "key"), ("timestamp", "u32"), ("pool", "key"),
        ),
    ),
    TableSpec(
        "amm_buy", "PumpFunAmmBuyEvent", "PumpfunAmmBuyEvent", "pumpfun_amm_buy_event_v2",
        ("PumpfunAmmBuy", "PumpfunAmmBuyExactQuoteIn"), True,
        _common() + _acc("base_mint", "quote_mint") + _ev(
            ("timestamp", "u32"), ("base_amount_out", "u64"), ("max_quote_amount_in", "u64"),
            ("user_base_token_reserves", "u64"), ("user_quote_token_reserves", "u64"),
            ("pool_base_token_reserves", "u64"), ("pool_quote_token_reserves", "u64"),
            ("quote_amount_in", "u64"), ("lp_fee_basis_points", "u64"), ("lp_fee", "u64"),
            ("protocol_fee_basis_points", "u64"), ("protocol_fee", "u64"),
            ("quote_amount_in_with_lp_fee", "u64"), ("user_quote_amount_in", "u64"),
        ) + _acc(
            "pool", "user", "user_base_token_account", "user_quote_token_account", "protocol_fee_recipient",
            "protocol_fee_recipient_token_account",
        ) + _ev(
            ("coin_creator", "key"), ("coin_creator_fee_basis_points", "u64"), ("coin_creator_fee", "u64"),
            ("track_volume", "u8"), ("total_unclaimed_tokens", "u64"), ("total_claimed_tokens", "u64"),
            ("current_sol_volume", "u64"), ("last_update_timestamp", "i64"),
        ) + _MAIN_POOL,
    ),
    TableSpec(
        "amm_sell", "PumpFunAmmSellEvent", "PumpfunAmmSellEvent", "pumpfun_amm_sell_event_v2",
        ("PumpfunAmmSell",), True,
        _common() + _acc("base_mint", "quote_mint") + _ev(
            ("timestamp", "u32"), ("base_amount_in", "u64"), ("min_quote_amount_out", "u64"),
            ("user_base_token_reserves", "u64"), ("user_quote_token_reserves", "u64"),
            ("pool_base_token_reserves", "u64"), ("pool_quote_token_reserves", "u64"),
            ("quote_amount_out", "u64"), ("lp_fee_basis_points", "u64"), ("lp_fee", "u64"),
            ("protocol_fee_basis_points", "u64"), ("protocol_fee", "u64"),
            ("quote_amount_out_without_lp_fee", "u64"), ("user_quote_amount_out", "u64"),
        ) + _acc(
            "pool", "user", "user_base_token_account", "user_quote_token_account", "protocol_fee_recipient",
            "protocol_fee_recipient_token_account",
        ) + _ev(
            ("coin_creator", "key"), ("coin_creator_fee_basis_points", "u64"), ("coin_creator_fee", "u64"),
        ) + _MAIN_POOL,
    ),
    TableSpec(
        "amm_create_pool", "PumpFunAmmCreatePoolEvent", "PumpfunAmmCreatePoolEvent",
        "pumpfun_amm_create_pool_event_v2", ("PumpfunAmmCreatePool",), True,
        _common() + _ev(("timestamp", "u32"), ("index", "i64")) + _acc("creator", "base_mint", "quote_mint") + _ev(
            ("base_mint_decimals", "i64"), ("quote_mint_decimals", "i64"), ("base_amount_in", "u64"),
            ("quote_amount_in", "u64"), ("pool_base_amount", "u64"), ("pool_quote_amount", "u64"),
            ("minimum_liquidity", "u64"), ("initial_liquidity", "u64"), ("lp_token_amount_out", "u64"),
            ("pool_bump", "i64"),
        ) + _acc("pool", "lp_mint", "user_base_token_account", "user_quote_token_account")
        + _ev(("coin_creator", "key")) + _MAIN_POOL,
    ),
    TableSpec(
        "amm_deposit", "PumpFunAmmDepositEvent", "PumpfunAmmDepositEvent", "pumpfun_amm_deposit_event_v2",
        ("PumpfunAmmDeposit",), True,
        _common() + _acc("base_mint", "quote_mint") + _ev(
            ("timestamp", "u32"), ("lp_token_amount_out", "u64"), ("max_base_amount_in", "u64"),
            ("max_quote_amount_in", "u64"), ("user_base_token_reserves", "u64"),
            ("user_quote_token_reserves", "u64"), ("pool_base_token_reserves", "u64"),
            ("pool_quote_token_reserves", "u64"), ("base_amount_in", "u64"), ("quote_amount_in", "u64"),
            ("lp_mint_supply", "u64"),
        ) + _acc("pool", "user", "user_base_token_account", "user_quote_token_account", "user_pool_token_account")
        + _MAIN_POOL,
    ),
    TableSpec(
        "amm_withdraw", "PumpFunAmmWithdrawEvent", "PumpfunAmmWithdrawEvent", "pumpfun_amm_withdraw_event_v2",
        ("PumpfunAmmWithdraw",), True,
        _common() + _acc("base_mint", "quote_mint") + _ev(
            ("timestamp", "u32"), ("lp_token_amount_in", "u64"), ("min_base_amount_out", "u64"),
            ("min_quote_amount_out", "u64"), ("user_base_token_reserves", "u64"),
            ("user_quote_token_reserves", "u64"), ("pool_base_token_reserves", "u64"),
            ("pool_quote_token_reserves", "u64"), ("base_amount_out", "u64"), ("quote_amount_out", "u64"),
            ("lp_mint_supply", "u64"),
        ) + _acc("pool", "user", "user_base_token_account", "user_quote_token_account", "user_pool_token_account")
        + _MAIN_POOL,
    ),
)

TABLE_BY_NAME = {t.name: t for t in TABLES}
TABLE_BY_EVENT_TYPE = {t.event_type: t for t in TABLES}
TABLE_BY_TABLE_NAME = {t.table: t for t in TABLES}
EVENT_TYPES = tuple(t.event_type for t in TABLES)

# Instruction variants that can pair with events (oneof names of the input).
INSTRUCTION_KINDS = (
    "PumpfunBuy", "PumpfunCreate", "PumpfunMigrate", "PumpfunAmmBuy", "PumpfunAmmBuyExactQuoteIn",
    "PumpfunAmmSell", "PumpfunAmmDeposit", "PumpfunAmmWithdraw", "PumpfunAmmCreatePool",
)


def _superset(source: str) -> T.StructType:
    seen: dict[str, T.DataType] = {}
    for t in TABLES:
        for _, src, field, conv in t.columns:
            if src == source and field not in seen:
                seen[field] = IN_TYPES[conv]
    return T.StructType([T.StructField(n, dt, True) for n, dt in seen.items()])


EVENT_STRUCT = _superset("event")
ACCOUNTS_STRUCT = _superset("accounts")

INSTRUCTION_STRUCT = T.StructType([
    T.StructField("type", T.StringType(), True),
    T.StructField("kind", T.StringType(), True),          # oneof variant; NULL = parsed absent
    T.StructField("event", EVENT_STRUCT, True),
    T.StructField("accounts", ACCOUNTS_STRUCT, True),     # NULL = accounts absent
    T.StructField("is_main_pool", T.BooleanType(), True),
])

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("signature", T.BinaryType(), False),
    T.StructField("slot", U64, False),
    T.StructField("index", T.LongType(), False),
    T.StructField("instructions", T.ArrayType(INSTRUCTION_STRUCT, False), False),
])


def table_spec(name: str) -> TableSpec:
    """Look a table up by kind, event type or table name; unknown names fail."""
    for registry in (TABLE_BY_NAME, TABLE_BY_EVENT_TYPE, TABLE_BY_TABLE_NAME):
        if name in registry:
            return registry[name]
    raise KeyError(f"Unknown event type: {name}")


def table_schema(name: str) -> T.StructType:
    return table_spec(name).schema
