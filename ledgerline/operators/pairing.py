"""Event / instruction pairing inside a transaction (nested stack match).

Walking a transaction's instructions in order, a non-event is pushed on a
stack and an event pops the most recent unmatched non-event.  An event on an
empty stack has no partner.  A pop happens even if the pair is rejected later,
so pairing always runs before any validity filter.

Two Catalyst-only forms, no UDF:

* ``pair_fold``   nested input (one row per transaction): an ``aggregate``
  higher-order fold over the instruction array.  No shuffle at all.
* ``pair_window`` flat input (one row per instruction): running balance
  ``s`` of +1 (push) / -1 (event); an event sits on edge ``s``, a push on edge
  ``s - 1``; crossings of one edge alternate up/down, so an event's partner is
  the previous row on its edge.  ``skew_safe=True`` computes both running
  steps with ``segmented_scan`` (range-partitioned, no single task per
  transaction); ``False`` uses two built-in windows over one hash shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.scan import segmented_scan
from ledgerline.schemas import EVENT_TYPES, TABLES


def is_event(type_col) -> Column:
    """Membership of the instruction type in the 8 event type strings."""
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    return c.isin(*EVENT_TYPES)


def explode_instructions(tx: DataFrame, instructions: str = "instructions") -> DataFrame:
    """One row per instruction with its 0-based ``position`` (before any filter)."""
    others = [c for c in tx.columns if c != instructions]
    return tx.select(*others, F.posexplode(instructions).alias("position", "instruction")) \
        .withColumn("is_event", is_event(F.col("instruction.type")))


_FOLD = """
aggregate(
  transform(coalesce({types}, CAST(array() AS array<string>)), (t, i) -> named_struct('t', t, 'i', i)),
  named_struct('stack', CAST(array() AS array<int>),
               'out', CAST(array() AS array<struct<position:int,partner_position:int>>)),
  (acc, x) -> CASE
    WHEN NOT (x.t IN ({events})) OR x.t IS NULL THEN
      named_struct('stack', array_append(acc.stack, x.i), 'out', acc.out)
    WHEN size(acc.stack) = 0 THEN acc
    ELSE named_struct(
      'stack', slice(acc.stack, 1, size(acc.stack) - 1),
      'out', array_append(acc.out, named_struct('position', x.i,
                                                'partner_position', element_at(acc.stack, -1))))
  END,
  acc -> acc.out)
"""


def pair_positions_expr(instructions: str = "instructions") -> Column:
    """The fold reads only ``instructions.type`` (a string array, extracted once
    and zipped with its index, so each step is O(1)); a scan of a nested
    transactions table prunes every other instruction field unless a later
    projection asks for it."""
    events = ", ".join(f"'{e}'" for e in EVENT_TYPES)
    return F.expr(_FOLD.format(types=f"`{instructions}`.type", events=events))


def pair_fold(tx: DataFrame, instructions: str = "instructions",
              fields: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """J2 (fold form): one row per paired event with ``event`` and ``partner``
    instruction structs, the event's ``position`` and the partner's position.

    ``fields=(event_fields, account_fields)`` carries only those nested fields
    (as per-field arrays, which a Parquet scan prunes to) instead of the whole
    instruction array; ``event``/``partner`` are then slim structs with the
    same shape for those fields."""
    others = [c for c in tx.columns if c != instructions]
    if fields is not None:
        return _pair_fold_slim(tx, instructions, others, *fields)
    paired = tx.select(*others, F.col(instructions).alias("_ins"),
                       F.explode(pair_positions_expr(instructions)).alias("_p"))
    return paired.select(
        *others,
        F.col("_p.position").cast("bigint").alias("position"),
        F.col("_p.partner_position").cast("bigint").alias("partner_position"),
        F.get(F.col("_ins"), F.col("_p.position")).alias("event"),
        F.get(F.col("_ins"), F.col("_p.partner_position")).alias("partner"),
    )


def _pair_fold_slim(tx: DataFrame, instructions: str, others: list[str], event_fields, account_fields) -> DataFrame:
    """Builds the slim event/partner structs inside a ``transform`` over the pair
    array, so only the finished rows pass through the generator and the scan
    keeps just the nested fields referenced here."""
    ins = f"`{instructions}`"

    def at(path: str, i):
        return F.get(F.col(f"{ins}.{path}"), i)

    def ins_struct(i):
        parts = [at("type", i).alias("type"), at("kind", i).alias("kind"),
                 F.struct(*[at(f"event.{f}", i).alias(f) for f in event_fields]).alias("event")]
        if account_fields:
            acc = F.struct(*[at(f"accounts.{f}", i).alias(f) for f in account_fields])
            present = F.get(F.col(f"{ins}.accounts"), i).isNotNull()
            parts.append(F.when(present, acc).alias("accounts"))
        else:
            parts.append(F.lit(None).cast("struct<_:binary>").alias("accounts"))
        parts.append(at("is_main_pool", i).alias("is_main_pool"))
        return F.struct(*parts)

    rows = F.transform(pair_positions_expr(instructions), lambda p: F.struct(
        p["position"].cast("bigint").alias("position"),
        p["partner_position"].cast("bigint").alias("partner_position"),
        ins_struct(p["position"]).alias("event"),
        ins_struct(p["partner_position"]).alias("partner")))
    return tx.select(*others, F.explode(rows).alias("_r")).select(*others, "_r.*")


def pair_window(flat: DataFrame, tx_cols: list[str], order_cols: list[str], type_col: str = "type", *,
                skew_safe: bool = True, position_col: str | None = None) -> DataFrame:
    """J2 (window form) on flat instructions.

    ``order_cols`` order instructions inside a transaction (total order).  If
    ``position_col`` is None, a 0-based ``position`` is derived from that order.
    Adds ``position`` (if derived), ``is_event`` and ``partner_position``
    (NULL for non-events and for events on an empty stack).
    """
    df = flat.withColumn("is_event", is_event(type_col)) \
        .withColumn("_step", F.when(F.col("is_event"), F.lit(-1)).otherwise(F.lit(1)).cast("bigint"))
    pos = position_col or "position"
    if skew_safe:
        df = segmented_scan(df, tx_cols, order_cols, cumsums={"_s": "_step"},
                            rownum=None if position_col else "_rn")
        if not position_col:
            df = df.withColumn(pos, F.col("_rn") - 1).drop("_rn")
        df = df.withColumn("_edge", F.when(F.col("is_event"), F.col("_s")).otherwise(F.col("_s") - 1))
        df = segmented_scan(df, tx_cols + ["_edge"], [pos], lags={"_lag": pos})
    else:
        w_tx = Window.partitionBy(*tx_cols).orderBy(*order_cols)
        if not position_col:
            df = df.withColumn(pos, F.row_number().over(w_tx) - 1)
        df = df.withColumn("_s", F.sum("_step").over(w_tx.rowsBetween(Window.unboundedPreceding, 0)))
        df = df.withColumn("_edge", F.when(F.col("is_event"), F.col("_s")).otherwise(F.col("_s") - 1))
        df = df.withColumn("_lag", F.lag(pos).over(Window.partitionBy(*tx_cols, "_edge").orderBy(pos)))
    return df.withColumn("partner_position", F.when(F.col("is_event"), F.col("_lag")).cast("bigint")) \
        .drop("_step", "_s", "_edge", "_lag")


def target_table(event_type) -> Column:
    """Short table name for an event type string (NULL for non-events)."""
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = F.lit(None).cast("string")
    for t in reversed(TABLES):
        expr = F.when(c == F.lit(t.event_type), F.lit(t.name)).otherwise(expr)
    return expr


def pair_is_valid(event: str = "event", partner: str = "partner", tables=TABLES) -> Column:
    """P10: the event carries its own variant; trade/create/migrate accept any
    parsed partner; AMM kinds need an allowed partner variant with accounts.
    Restricting ``tables`` keeps the predicate (and the nested read) to the
    fields those kinds need."""
    ev_type = F.col(f"{event}.type")
    ev_kind = F.col(f"{event}.kind")
    p_kind = F.col(f"{partner}.kind")
    p_acc = F.col(f"{partner}.accounts")
    expr = F.lit(False)
    for t in reversed(tuple(tables)):
        ok = (ev_kind == F.lit(t.event_kind)) & p_kind.isNotNull()
        if t.partner_kinds:
            ok = ok & p_kind.isin(*t.partner_kinds)
        if t.needs_accounts:
            ok = ok & p_acc.isNotNull()
        expr = F.when(ev_type == F.lit(t.event_type), ok).otherwise(expr)
    return F.coalesce(expr, F.lit(False))
