"""Host-level quality rules, with DataFrame functions only.

Every document is held against document rules (below).  Failures are added up by host, each
host's failure rate is shrunk with a beta prior fitted to all hosts by the moments of the
beta-binomial distribution (so the scatter of small hosts is not taken for difference
between hosts), and the shrunk rate is held against the fitted mean.  The verdict goes back to
the host's documents and says how strictly a failing one is judged: a document that fails any
rule is dropped, unless its host's shrunk rate is below TRUSTED times the mean; on such a trusted
host the two base rules alone count.  A document that passes every rule is kept wherever it stands.

Rules: too short (under 50 words), repetitive (more than half of the words lie in repeated
3-word windows) - these two are the base rules -, symbols (over a tenth of the word
characters), repeated lines (over three tenths of the lines with a word), odd words (average
length under 2 or over 20 characters).

Repeated windows are found inside the row: windows are hashed, sorted and compared with their
neighbours, so no words are shuffled and the work is n log n in the text's words.  Window
hashes have 64 bits; two different windows of one text share one with probability below
1e-8 for a text of 500,000 words.

Cases: null text counts as empty (no words, base_failed); a null host is no host: only the
base rules count; repeated rows count repeatedly; ties in sorting only concern equal hashes;
an empty table gives an empty result; the prior is worth 1 to PRIOR_LIMIT documents, the
latter with one host or equal rates; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50            # per cent of the words
MAX_SYMBOLS = 10             # per cent of the word characters
MAX_DUP_LINES = 30           # per cent of the lines with a word
WORD_LENGTH = (2, 20)
TRUSTED = 0.5                # times the mean failure rate
PRIOR_LIMIT = 10_000.0


def _bare(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def features(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of every document.  Each select ends where later
    expressions look elements up, so that an array is made once and not per element."""
    text = F.coalesce(col(docs, "text"), F.lit(""))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: _bare(x) != "")
    out = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, host).alias("host"), text.alias("t")).select(
        "doc_id", "host",
        F.length(_bare(F.col("t"))).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""), lambda w: F.xxhash64(w)).alias("h"),
        lines.alias("lines"))
    out = out.select(
        "doc_id", "host", "word_chars", "n_symbols", F.size("h").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.when(F.size("h") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("h") - 3),
            lambda i: F.struct(F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)).alias("x"), i.alias("i"))))).alias("s"))
    again = F.filter("s", lambda e, k: (e["x"] == F.get("s", k + 1)["x"]) | (e["x"] == F.get("s", k - 1)["x"]))
    out = out.withColumn("s", F.sort_array(F.transform(again, lambda e: e["i"])))
    fresh = F.transform("s", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("s", k + 1) - p, F.lit(3))))
    return out.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                      F.coalesce(F.aggregate(fresh, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")).alias("n_repeat_words"))


def judged(rows: DataFrame) -> DataFrame:
    """``features`` with base_failed and rule_failed (any rule)."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    other = ((100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"))
             | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
             | (F.col("word_chars") < WORD_LENGTH[0] * F.col("n_words"))
             | (F.col("word_chars") > WORD_LENGTH[1] * F.col("n_words")))
    return rows.withColumn("base_failed", base).withColumn("rule_failed", base | other)


def trusted_hosts(rows: DataFrame) -> DataFrame:
    """host, shrunk_rate of the hosts whose shrunk failure rate is below TRUSTED times the mean."""
    hosts = rows.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("failed"))
    k, n, failed, square = hosts.agg(F.count("*"), F.sum("n"), F.sum("failed"),
                                     F.sum(F.col("failed") * F.col("failed") / F.col("n"))).first()   # one row
    m = failed / n if n else 0.0
    rho = ((square - n * m * m) / (m * (1 - m)) - k) / (n - k) if 0 < m < 1 and n > k else 0.0
    strength = min(PRIOR_LIMIT, max(1.0, 1 / rho - 1)) if rho > 0 else PRIOR_LIMIT
    shrunk = (F.col("failed") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", shrunk.alias("shrunk_rate")).where(F.col("shrunk_rate") < F.lit(TRUSTED * m))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    rows = materialize(docs.sparkSession, judged(features(docs)), "rules")
    verdict = trusted_hosts(rows).select("host", F.lit(True).alias("trusted"))
    lenient = F.col("host").isNull() | F.coalesce("trusted", F.lit(False))
    kept = ~F.col("base_failed") & (~F.col("rule_failed") | lenient)
    return rows.join(verdict, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


ORACLE_SQL = f"""
WITH t AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents
), a AS (
  SELECT doc_id, host,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM t
), word AS (
  SELECT doc_id, unnest(w) AS w1, unnest(range(len(w))) AS i FROM a
), win AS (
  SELECT doc_id, i, w1, lead(w1) OVER d AS w2, lead(w1, 2) OVER d AS w3
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS n FROM win WHERE w3 IS NOT NULL
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id
), f AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM a LEFT JOIN repeated USING (doc_id)
), j AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
         100 * n_symbols > {MAX_SYMBOLS} * word_chars OR 100 * n_dup_lines > {MAX_DUP_LINES} * n_lines
         OR word_chars < {WORD_LENGTH[0]} * n_words OR word_chars > {WORD_LENGTH[1]} * n_words AS other_failed
  FROM f
), hosts AS (
  SELECT host, count(*) AS n, sum(CASE WHEN base_failed OR other_failed THEN 1 ELSE 0 END) AS failed
  FROM j WHERE host IS NOT NULL GROUP BY host
), moments AS (
  SELECT count(*) AS k, sum(n) AS n, sum(failed) / sum(n) AS m, sum(failed * failed / n) AS square FROM hosts
), prior AS (
  SELECT m, CASE WHEN m > 0 AND m < 1 AND n > k THEN ((square - n * m * m) / (m * (1 - m)) - k) / (n - k) ELSE 0.0 END AS rho
  FROM moments
), strength AS (
  SELECT m, CASE WHEN rho > 0 THEN least({PRIOR_LIMIT}, greatest(1.0, 1 / rho - 1)) ELSE {PRIOR_LIMIT} END AS s FROM prior
), trusted AS (
  SELECT host FROM hosts, strength WHERE (failed + m * s) / (n + s) < {TRUSTED} * m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (NOT other_failed OR host IS NULL OR host IN (SELECT host FROM trusted)) AS kept
FROM j
"""
