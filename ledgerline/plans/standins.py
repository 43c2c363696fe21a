"""Stand-in inputs derived from the driver's tables, each with its DuckDB twin.

The driver's tables carry no ledger data, so every operator runs on a stated
stand-in built from them (Spark side) and the oracle SQL rebuilds the same
stand-in independently (DuckDB side).  All stand-ins keep every source row.

* TX       ``events``: transaction = user_id, instruction order = (ts, event_id);
           an instruction is an event when event_type is purchase or error.
           One transaction is one row with its instruction array: a user's
           events fit in a row (the largest user has about 100; real
           transactions are bounded by their block).  The flat form
           (``flat_instructions``) has no such assumption.
* KINDED   TX with kind = event_id % 8 and typed fields derived from columns.
* LOCAL / REMOTE  ``events`` as an event table; remote drops event_id % 97 = 0
           and holds a second copy of event_id % 89 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.base58 import ALPHABET
from ledgerline.functions.scalars import epoch_seconds, key_from_long
from ledgerline.operators.envelope import build_envelopes
from ledgerline.schemas import ACCOUNTS_STRUCT, EVENT_STRUCT, TABLES, U64

EVENT_NAMES = ("purchase", "error")
KEY_MULT = 1000003          # stand-in key value = id * KEY_MULT + field ordinal
ACCOUNT_BASE = 100
EPOCH_2024 = 1704067200
TS_SHIFT = 4294967296       # some raw timestamps are shifted by 2^32 to exercise wrapping

# Instruction type strings / variants that precede each event kind (stand-in).
INSTRUCTION_TYPES = ("PumpFunBuy", "PumpFunCreate", "PumpFunMigrate", "PumpFunAmmBuy", "PumpFunAmmSell",
                     "PumpFunAmmCreatePool", "PumpFunAmmDeposit", "PumpFunAmmWithdraw")
INSTRUCTION_VARIANTS = ("PumpfunBuy", "PumpfunCreate", "PumpfunMigrate", "PumpfunAmmBuy", "PumpfunAmmSell",
                        "PumpfunAmmCreatePool", "PumpfunAmmDeposit", "PumpfunAmmWithdraw")


def _conv_of(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for t in TABLES:
        for _, src, field, conv in t.columns:
            if src == source:
                out.setdefault(field, conv)
    return out


EVENT_CONV = _conv_of("event")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------- Spark side
def _event_field(field: str, j: int, eid: Column, ts: Column) -> Column:
    conv = EVENT_CONV[field]
    if conv == "u64":
        return (eid * 1009 + j).cast(U64)
    if conv == "key":
        return key_from_long(eid * KEY_MULT + j)
    if conv == "u32":
        return epoch_seconds(ts) - F.when(eid % 5 == 0, F.lit(TS_SHIFT)).otherwise(F.lit(0))
    if conv == "u8":
        return ((eid + j) % 2) == 0
    if conv == "i64":
        return eid * 10 - j
    return F.concat(F.lit(field + "_"), eid.cast("string"))


def _is_event(event_type="event_type") -> Column:
    return F.col(event_type).isin(*EVENT_NAMES)


def _instruction_type(eid: Column, ev: Column) -> Column:
    r = (eid % 8).cast("int")
    ev_type = F.element_at(F.array(*[F.lit(t.event_type) for t in TABLES]), r + 1)
    return F.when(ev, ev_type).otherwise(F.element_at(F.array(*[F.lit(x) for x in INSTRUCTION_TYPES]), r + 1))


def instruction_struct(event_fields=None, account_fields=None, *, eid: Column | None = None, ts: Column | None = None,
                       ev: Column | None = None) -> Column:
    """KINDED instruction built from one ``events`` row; only the named event
    and account fields are built (None: all).  ``eid``, ``ts``, ``ev``: the row's
    id, time and whether it is an event, if they are not columns of ``events``."""
    eid, ts, ev = (F.col("event_id") if eid is None else eid, F.col("ts") if ts is None else ts, _is_event() if ev is None else ev)
    r = (eid % 8).cast("int")
    ev_kind = F.element_at(F.array(*[F.lit(t.event_kind) for t in TABLES]), r + 1)
    ins_kind = F.when(eid % 13 == 0, F.lit(None).cast("string")) \
        .when(eid % 11 == 0, F.lit("PumpfunAmmBuyExactQuoteIn")) \
        .otherwise(F.element_at(F.array(*[F.lit(x) for x in INSTRUCTION_VARIANTS]), r + 1))
    parts = [_instruction_type(eid, ev).alias("type"), F.when(ev, ev_kind).otherwise(ins_kind).alias("kind")]
    event = [_event_field(f.name, j, eid, ts).cast(f.dataType).alias(f.name) for j, f in enumerate(EVENT_STRUCT.fields)
             if event_fields is None or f.name in event_fields]
    accounts = [key_from_long(eid * KEY_MULT + ACCOUNT_BASE + j).alias(f.name)
                for j, f in enumerate(ACCOUNTS_STRUCT.fields) if account_fields is None or f.name in account_fields]
    if event:
        parts.append(F.when(ev, F.struct(*event)).alias("event"))
    if accounts:
        parts.append(F.when(~ev & (eid % 7 != 0), F.struct(*accounts)).alias("accounts"))
    return F.struct(*parts, F.when(~ev, eid % 2 == 0).alias("is_main_pool"))


def tx_columns(user_id: Column) -> list[Column]:
    return [
        key_from_long(user_id * KEY_MULT, 64).alias("signature"),
        (user_id * 7 + 1).cast(U64).alias("slot"),
        (user_id - F.when(user_id % 3 == 0, F.lit(TS_SHIFT)).otherwise(F.lit(0))).alias("index"),
    ]


def flat_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX as flat rows (one per instruction), ordered by (ts, event_id)."""
    return flat_instructions_from(table(spark, sf_dir, "events"))


def flat_instructions_from(ev: DataFrame, fields=None) -> DataFrame:
    return ev.select("user_id", "ts", "event_id", "event_type", instruction_struct(*(fields or ())).alias("instruction"))


def transactions(spark: SparkSession, sf_dir: str, fields=None) -> DataFrame:
    """TX nested: one row per transaction with its ordered instruction array.
    ``fields``: (event fields, account fields) to build, as ``pair_fold`` takes
    them; the other ~90 fields are then never built."""
    return transactions_from(table(spark, sf_dir, "events"), fields)


TASK_EVENTS = 25_000        # about 40 MB of instructions


def by_user(ev: DataFrame) -> DataFrame:
    """``ev`` dealt out by user_id, TASK_EVENTS rows or so to a partition.  The number is set by
    the rows, as the few bytes that are shuffled do not tell what is built from them."""
    return ev.repartition(max(1, -(-ev.count() // TASK_EVENTS)), "user_id")


def transactions_from(ev: DataFrame, fields=None) -> DataFrame:
    """TX nested, from any DataFrame of ``events`` rows.  Rows are grouped by what an instruction
    is made of; it is made afterwards, so no instruction passes through the shuffle and the sort.
    Of rows with one time and id the instruction's type decides.  The array leaves a generator, as
    an optimizer that moves filters down would else have it made anew in each condition on it."""
    rows = by_user(ev.select("user_id", "ts", "event_id", _is_event().alias("is_ev")))
    row = F.struct("ts", "event_id", _instruction_type(F.col("event_id"), F.col("is_ev")).alias("type"), "is_ev")
    grouped = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(row)).alias("_ins"))
    made = F.transform("_ins", lambda x: instruction_struct(*(fields or ()), eid=x["event_id"], ts=x["ts"], ev=x["is_ev"]))
    return grouped.select("user_id", *tx_columns(F.col("user_id")), F.explode(F.array(made)).alias("instructions"))


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOCAL: ``events`` as an event table keyed by (signature, instruction_index)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("sig"), F.col("user_id").cast("string")).alias("signature"),
                     F.col("event_id").alias("instruction_index"),
                     epoch_seconds("ts").alias("timestamp"), "event_type", "value")


def remote_copy(local: DataFrame) -> DataFrame:
    """REMOTE: drops event_id % 97 = 0, duplicates event_id % 89 = 0."""
    kept = local.where(F.col("instruction_index") % 97 != 0)
    dup = local.where(F.col("instruction_index") % 89 == 0)
    return kept.unionByName(dup)


# --------------------------------------------------------------------------- DuckDB side
def sql_b58(v: str, width: int) -> str:
    """DuckDB base58 text of a ``width``-byte big-endian key holding BIGINT ``v`` >= 0."""
    alpha = ALPHABET.decode()
    digits = " || ".join(f"substr('{alpha}', CAST((({v}) // {58 ** i}) % 58 AS INTEGER) + 1, 1)"
                         for i in reversed(range(11)))
    nbytes = " + ".join(f"CAST(({v}) >= {256 ** i} AS INTEGER)" for i in range(8))
    return f"(repeat('1', {width} - ({nbytes})) || ltrim({digits}, '1'))"


def sql_u32(v: str) -> str:
    return f"(((({v}) % 4294967296) + 4294967296) % 4294967296)"


def sql_event_field(field: str, j: int, eid: str = "event_id", ts: str = "ts") -> str:
    """DuckDB value of a stand-in event field, already converted for output."""
    conv = EVENT_CONV[field]
    if conv == "u64":
        return f"CAST({eid} * 1009 + {j} AS DECIMAL(20,0))"
    if conv == "key":
        return sql_b58(f"{eid} * {KEY_MULT} + {j}", 32)
    if conv == "u32":
        raw = f"(epoch_us({ts}) // 1000000 - CASE WHEN {eid} % 5 = 0 THEN {TS_SHIFT} ELSE 0 END)"
        return f"CAST({sql_u32(raw)} AS BIGINT)"
    if conv == "u8":
        return f"CAST(CASE WHEN ({eid} + {j}) % 2 = 0 THEN 1 ELSE 0 END AS SMALLINT)"
    if conv == "i64":
        return f"CAST({eid} * 10 - {j} AS BIGINT)"
    return f"('{field}_' || CAST({eid} AS VARCHAR))"


def sql_account_field(field: str, eid: str) -> str:
    j = [f.name for f in ACCOUNTS_STRUCT.fields].index(field)
    return sql_b58(f"{eid} * {KEY_MULT} + {ACCOUNT_BASE + j}", 32)


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL_INSTRUCTIONS = f"""
ins AS (
  SELECT user_id, ts, event_id, event_type,
         event_type IN ('purchase', 'error') AS is_ev,
         CASE WHEN event_type IN ('purchase', 'error')
              THEN {_sql_list(t.event_type for t in TABLES)}[event_id % 8 + 1]
              ELSE {_sql_list(INSTRUCTION_TYPES)}[event_id % 8 + 1] END AS type,
         CASE WHEN event_type IN ('purchase', 'error')
              THEN {_sql_list(t.event_kind for t in TABLES)}[event_id % 8 + 1]
              WHEN event_id % 13 = 0 THEN NULL
              WHEN event_id % 11 = 0 THEN 'PumpfunAmmBuyExactQuoteIn'
              ELSE {_sql_list(INSTRUCTION_VARIANTS)}[event_id % 8 + 1] END AS kind,
         (NOT event_type IN ('purchase', 'error')) AND event_id % 7 <> 0 AS has_accounts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
  FROM events
),
bal AS (
  SELECT *, sum(CASE WHEN is_ev THEN -1 ELSE 1 END)
              OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS s
  FROM ins
),
pairs AS (
  SELECT e.user_id, e.pos AS position, max(p.pos) AS partner_position
  FROM bal e JOIN bal p
    ON p.user_id = e.user_id AND NOT p.is_ev AND p.pos < e.pos AND p.s - 1 = e.s
  WHERE e.is_ev
  GROUP BY e.user_id, e.pos
),
paired AS (
  SELECT pr.user_id, pr.position, pr.partner_position,
         e.event_id AS e_id, e.ts AS e_ts, e.type AS e_type, e.kind AS e_kind,
         p.event_id AS p_id, p.type AS p_type, p.kind AS p_kind, p.has_accounts AS p_has_accounts
  FROM pairs pr
  JOIN ins e ON e.user_id = pr.user_id AND e.pos = pr.position
  JOIN ins p ON p.user_id = pr.user_id AND p.pos = pr.partner_position
)"""


def sql_valid() -> str:
    """P10 over the ``paired`` CTE."""
    arms = []
    for t in TABLES:
        cond = f"e_kind = '{t.event_kind}' AND p_kind IS NOT NULL"
        if t.partner_kinds:
            cond += " AND p_kind IN (" + ", ".join(f"'{k}'" for k in t.partner_kinds) + ")"
        if t.needs_accounts:
            cond += " AND p_has_accounts"
        arms.append(f"WHEN e_type = '{t.event_type}' THEN ({cond})")
    return "COALESCE(CASE " + " ".join(arms) + " ELSE FALSE END, FALSE)"


def sql_table_name() -> str:
    return "CASE " + " ".join(f"WHEN e_type = '{t.event_type}' THEN '{t.name}'" for t in TABLES) + " END"


def sql_tx_column(name: str) -> str:
    if name == "signature":
        return sql_b58(f"user_id * {KEY_MULT}", 64)
    if name == "slot":
        return "CAST(user_id * 7 + 1 AS DECIMAL(20,0))"
    if name == "transaction_index":
        return f"CAST({sql_u32(f'user_id - CASE WHEN user_id % 3 = 0 THEN {TS_SHIFT} ELSE 0 END')} AS BIGINT)"
    return f"CAST({sql_u32('position')} AS BIGINT)"


def sql_projection(kind: str) -> str:
    """Select list of one event table over the ``paired`` CTE (aliased ``pd``),
    where ``e_id``/``p_id``/``e_ts`` identify event and partner rows."""
    spec = next(t for t in TABLES if t.name == kind)
    j_of = {f.name: j for j, f in enumerate(EVENT_STRUCT.fields)}
    cols = []
    for name, src, field, _conv in spec.columns:
        if src == "tx":
            expr = sql_tx_column(name)
        elif src == "event":
            expr = sql_event_field(field, j_of[field], eid="e_id", ts="e_ts")
        elif src == "accounts":
            expr = sql_account_field(field, "p_id")
        else:
            expr = "CAST(CASE WHEN p_id % 2 = 0 THEN 1 ELSE 0 END AS SMALLINT)"
        cols.append(f"{expr} AS \"{name}\"")
    return ",\n       ".join(cols)


def daily_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` shaped as an event table with the total order columns."""
    ev = table(spark, sf_dir, "events")
    ets = epoch_seconds("ts")
    return ev.select(F.concat(F.lit("sig"), F.col("user_id").cast("string")).alias("signature"),
                     ets.cast(U64).alias("slot"), F.col("user_id").alias("transaction_index"),
                     F.col("event_id").alias("instruction_index"), ets.alias("timestamp"), "event_type")


SQL_DAILY_SOURCE = """
src AS (SELECT 'sig' || CAST(user_id AS VARCHAR) AS signature,
               CAST(epoch_us(ts) // 1000000 AS DECIMAL(20,0)) AS slot, user_id AS transaction_index,
               event_id AS instruction_index, epoch_us(ts) // 1000000 AS "timestamp", event_type
        FROM events)"""


# --------------------------------------------------------------------------- FILES / LEDGER (from orders)
def slot_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file with its slot index: the entries of ``slot_entries`` nested."""
    return slot_entries(spark, sf_dir).groupBy("prefix").agg(F.collect_list(F.struct("slot", "offset", "size")).alias("entries"))


RANGE_FILE = 4_000          # events a stand-in archive file


def write_slot_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Archive files under ``root`` with a line an event (slot = event_id), one file for every
    RANGE_FILE of them, and their slot index: prefix, slot, offset, size.  Some entries
    have no offset, some point behind their file and some into a file that is not there."""
    ev = table(spark, sf_dir, "events")
    lines = ev.select(F.floor(F.col("event_id") / RANGE_FILE).cast("string").alias("prefix"), F.col("event_id").alias("slot"),
                      F.concat_ws("|", "event_id", "user_id", "event_type", "props").alias("value"))
    lines.repartition("prefix").sortWithinPartitions("prefix", "slot").select("prefix", "value") \
        .write.partitionBy("prefix").text(root)
    size, slot = F.octet_length("value").cast("long"), F.col("slot")
    upto = Window.partitionBy("prefix").orderBy("slot")            # RANGE_FILE rows at most
    offset = F.sum(size + 1).over(upto) - size - 1
    return lines.select(F.when(slot % 89 == 0, "gone").otherwise(F.col("prefix")).alias("prefix"), "slot",
                        F.when(slot % 10 != 0, F.when(slot % 97 == 0, offset + 2 ** 40).otherwise(offset)).cast(U64).alias("offset"),
                        size.cast(U64).alias("size"))


def slot_files(spark: SparkSession, root: str) -> DataFrame:
    """Prefix, path and length of the files of ``write_slot_files``."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(root)
    return listing.select(F.regexp_extract("path", "prefix=([^/]*)/", 1).alias("prefix"), "path", F.col("length").alias("bin_length"))


def _prefix(k: Column) -> Column:
    base = F.concat(k.cast("string"), F.lit("_"), (k + 99).cast("string"))
    return F.when(k % 7 == 0, F.concat(F.lit("slot"), base)).otherwise(base)


def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FILES: one directory listing (path, name, length) derived from ``orders``:
    ``.meta`` (some as ``.meta.meta``) and ``.bin`` files, incomplete pairs,
    non-numeric start slots and junk names."""
    o = table(spark, sf_dir, "orders")
    k, prio, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    pfx = _prefix(k)
    files = F.array(
        F.struct(F.when(prio != "5-LOW", F.concat(pfx, F.when(k % 5 == 0, F.lit(".meta.meta")).otherwise(F.lit(".meta"))))
                 .alias("name"), (k % 1000 + 1).alias("length")),
        F.struct(F.when(~((status == "P") & (k % 2 == 0)), F.concat(pfx, F.lit(".bin"))).alias("name"),
                 F.floor("o_totalprice").cast("bigint").alias("length")),
        F.struct(F.when(prio == "1-URGENT", F.concat(k.cast("string"), F.lit(".txt"))).alias("name"),
                 F.lit(10).cast("bigint").alias("length")),
        F.struct(F.when((prio == "2-HIGH") & (k % 3 == 0), F.concat(F.lit("x"), k.cast("string"))).alias("name"),
                 F.lit(5).cast("bigint").alias("length")),
        F.struct(F.when(k % 1000 == 1, F.lit(".meta")).alias("name"), F.lit(1).cast("bigint").alias("length")),
    )
    return o.select(F.inline(files)).where(F.col("name").isNotNull()) \
        .select(F.concat(F.lit("/archive/"), F.col("name")).alias("path"), "name", "length")


def slot_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot index entries (prefix, slot, offset, size) derived from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        _prefix(k).alias("prefix"),
        (k * 100 + F.col("l_linenumber")).cast(U64).alias("slot"),
        F.when(F.col("l_partkey") % 10 != 0, (F.floor("l_extendedprice") * 3).cast(U64)).alias("offset"),
        (F.floor("l_quantity") * 100).cast(U64).alias("size"))


def ledger_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEDGER: (line, ord) text lines from ``orders``: completed / failed
    entries of prefixes shared by up to 4 orders, short lines, comments,
    blank lines and padded lines; ``ord`` is the line number, and each entry's
    time grows with it."""
    o = table(spark, sf_dir, "orders")
    k, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    p = F.expr("o_orderkey div 4") * 4
    ts = F.date_format(F.timestamp_seconds(F.lit(EPOCH_2024) + k), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    pfx = _prefix(p)
    status = F.when(F.col("o_orderstatus") == "F", F.lit("failed")).otherwise(F.lit("completed"))
    line = F.when((prio == "4-NOT SPECIFIED") & (k % 2 == 0), F.concat(F.lit("# note "), k.cast("string"))) \
        .when((prio == "3-MEDIUM") & (k % 10 == 0), F.lit("  ")) \
        .when(prio == "5-LOW", F.concat_ws(",", ts, pfx)) \
        .otherwise(F.concat_ws(",", ts, pfx, status))
    line = F.when(k % 13 == 0, F.concat(F.lit("  "), line)).otherwise(line)
    return o.select(line.alias("line"), k.alias("ord"))


_SQL_PFX = ("CASE WHEN {k} % 7 = 0 THEN 'slot' ELSE '' END || CAST({k} AS VARCHAR) || '_' || "
            "CAST({k} + 99 AS VARCHAR)")

SQL_FILES = f"""
o AS (SELECT *, {_SQL_PFX.format(k='o_orderkey')} AS pfx FROM orders),
files AS (
  SELECT '/archive/' || name AS path, name, length FROM (
    SELECT CASE WHEN o_orderpriority <> '5-LOW'
                THEN pfx || CASE WHEN o_orderkey % 5 = 0 THEN '.meta.meta' ELSE '.meta' END END AS name,
           CAST(o_orderkey % 1000 + 1 AS BIGINT) AS length FROM o
    UNION ALL
    SELECT CASE WHEN NOT (o_orderstatus = 'P' AND o_orderkey % 2 = 0) THEN pfx || '.bin' END,
           CAST(floor(o_totalprice) AS BIGINT) FROM o
    UNION ALL
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) || '.txt' END, 10 FROM o
    UNION ALL
    SELECT CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 3 = 0 THEN 'x' || CAST(o_orderkey AS VARCHAR) END,
           5 FROM o
    UNION ALL
    SELECT CASE WHEN o_orderkey % 1000 = 1 THEN '.meta' END, 1 FROM o
  ) WHERE name IS NOT NULL),
metas AS (SELECT prefix, min(path) AS meta_path, arg_min(length, path) AS meta_length FROM (
            SELECT regexp_replace(name, '(\\.meta)+$', '') AS prefix, path, length FROM files
            WHERE name LIKE '%.meta') WHERE prefix <> '' GROUP BY prefix),
bins AS (SELECT prefix, min(path) AS bin_path, arg_min(length, path) AS bin_length FROM (
            SELECT regexp_replace(name, '(\\.bin)+$', '') AS prefix, path, length FROM files
            WHERE name LIKE '%.bin') WHERE prefix <> '' GROUP BY prefix),
manifest AS (
  SELECT m.prefix, meta_path, meta_length, bin_path, bin_length,
         COALESCE(CASE WHEN regexp_matches(split_part(m.prefix, '_', 1), '^[0-9]+$')
                       THEN TRY_CAST(split_part(m.prefix, '_', 1) AS DECIMAL(20,0)) END,
                  CAST(0 AS DECIMAL(20,0))) AS start_slot
  FROM metas m JOIN bins b ON m.prefix = b.prefix)"""

SQL_LEDGER = f"""
lo AS (SELECT o_orderkey AS ord, (o_orderkey // 4) * 4 AS p, o_orderpriority, o_orderstatus,
              strftime(make_timestamp(CAST({EPOCH_2024} + o_orderkey AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS lts FROM orders),
lines AS (
  SELECT ord, CASE WHEN ord % 13 = 0 THEN '  ' ELSE '' END || CASE
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND ord % 2 = 0 THEN '# note ' || CAST(ord AS VARCHAR)
    WHEN o_orderpriority = '3-MEDIUM' AND ord % 10 = 0 THEN '  '
    WHEN o_orderpriority = '5-LOW' THEN lts || ',' || {_SQL_PFX.format(k='p')}
    ELSE lts || ',' || {_SQL_PFX.format(k='p')} || ',' ||
         CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END END AS line
  FROM lo),
parsed AS (
  SELECT ord, trim(line) AS text,
         CASE WHEN trim(line) = '' THEN 'blank' WHEN starts_with(trim(line), '#') THEN 'comment'
              ELSE 'entry' END AS line_kind,
         len(string_split(trim(line), ',')) AS n_fields,
         string_split(trim(line), ',')[2] AS prefix, string_split(trim(line), ',')[3] AS status
  FROM lines),
processed AS (SELECT DISTINCT prefix FROM parsed
              WHERE line_kind = 'entry' AND n_fields >= 3 AND status = 'completed')"""


# --------------------------------------------------------------------------- ENV and logs

def conversation_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV: one envelope per ``conversations`` turn; channel = conv_id, role ->
    authority text, text = payload, event time derived from (conv_id, turn)."""
    c = table(spark, sf_dir, "conversations")
    ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("conv_id") * 3600 + F.col("turn") * 60).cast("timestamp_ntz")
    auth = F.when(F.col("role") == "system", F.lit("LV5")) \
        .when(F.col("role") == "assistant", F.concat(F.lit("lv"), (F.col("turn") % 6).cast("string"))) \
        .otherwise(F.lit("user"))
    env = build_envelopes(c, channel="conv_id", ts=ts, payload=F.col("text"), id_cols=[F.lit("conv"), "conv_id", "turn"],
                          authority_text=auth, sender_agent="ledgerline")
    return env.withColumn("payload_bytes", F.length("payload").cast("bigint"))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV over ``events``: channel = event_type (a few hot channels)."""
    ev = table(spark, sf_dir, "events")
    env = build_envelopes(ev, channel="event_type", ts="ts", payload=F.col("props"), id_cols=[F.lit("ev"), "event_id"],
                          authority_text=F.concat(F.lit("lv"), (F.col("user_id") % 7).cast("string")),
                          sender_agent="ledgerline")
    return env.withColumn("payload_bytes", F.length("payload").cast("bigint"))


def _sql_uuid(expr: str) -> str:
    h = f"sha256({expr})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


def _sql_authority(text: str) -> str:
    arms = " ".join(f"WHEN 'LV{i}' THEN {i}" for i in range(6))
    return f"CAST(CASE upper({text}) {arms} ELSE 0 END AS INTEGER)"


SQL_CONV_ENV = f"""
env AS (
  SELECT conv_id AS channel,
         make_timestamp(CAST({EPOCH_2024} + conv_id * 3600 + turn * 60 AS BIGINT) * 1000000) AS ts,
         {_sql_uuid("'conv|' || CAST(conv_id AS VARCHAR) || '|' || CAST(turn AS VARCHAR)")} AS uuid,
         '' AS parent_uuid, 'ledgerline' AS sender_agent,
         {_sql_authority("CASE WHEN role = 'system' THEN 'LV5' WHEN role = 'assistant' "
                         "THEN 'lv' || CAST(turn % 6 AS VARCHAR) ELSE 'user' END")} AS authority,
         'parsed_transaction' AS content_type, CAST(strlen(text) AS BIGINT) AS payload_bytes,
         sha256(text) AS payload_sha
  FROM conversations)"""

SQL_EVENT_ENV = f"""
env AS (
  SELECT event_type AS channel, ts,
         {_sql_uuid("'ev|' || CAST(event_id AS VARCHAR)")} AS uuid,
         {_sql_authority("'lv' || CAST(user_id % 7 AS VARCHAR)")} AS authority,
         CAST(strlen(props) AS BIGINT) AS payload_bytes, sha256(props) AS payload_sha
  FROM events)"""


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingest-log row per ``events`` row: value -> processing time, props -> bytes."""
    return ingest_log_from(table(spark, sf_dir, "events"))


def ingest_log_from(ev: DataFrame, keep=()) -> DataFrame:
    is_ev = F.col("event_type").isin(*EVENT_NAMES).cast("int")
    return ev.select(*keep, epoch_seconds("ts").alias("epoch"), F.length("props").cast("bigint").alias("bytes"),
                     F.round(F.col("value") * 100).cast("bigint").alias("processing_us"),
                     is_ev.alias("bundles"), is_ev.alias("rows_written"))


def signal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(epoch_seconds("ts").alias("epoch"),
                     F.col("event_type").isin(*EVENT_NAMES).cast("int").alias("signal"),
                     F.round(F.col("value") * 100).cast("bigint").alias("conversion_us"),
                     (F.length("props") * 3).cast("bigint").alias("serialization_us"),
                     (F.col("event_id") % 1000).alias("send_us"),
                     F.length("props").cast("bigint").alias("bytes"))


SQL_LOGS = """
lg AS (SELECT epoch_us(ts) // 1000000 AS epoch, CAST(strlen(props) AS BIGINT) AS bytes,
              CAST(round(value * 100) AS BIGINT) AS processing_us,
              CAST(event_type IN ('purchase', 'error') AS INTEGER) AS sig, event_id % 1000 AS send_us
       FROM events)"""
