"""URL verdicts by host rules and a weighted vocabulary.

A rule names a host and the start of a path; it fits its host and all subdomains, and the
longest fitting rule decides.  Other URLs are judged by vocabulary: one Aho-Corasick automaton
finds all terms in one pass over the URL (lower-case, percent-encoded ASCII decoded), and an
occurrence counts only if no letter stands on either side of it, so ``essex`` holds no ``sex``.
Terms are strict or soft: one strict term, or SOFT_LIMIT distinct soft ones, block the URL.

A scan without a shuffle.  Rules and vocabulary are parameters; both are broadcast, and more
than MAX_ENTRIES of them are refused.

Cases: a null URL or one without ``://`` has an empty host and path (its text is still
searched; null holds nothing, so it is allowed); a host keeps its user and port; a rule whose
path is ``/`` does not fit a URL with an empty path; of rules of one length the longer host,
then the first in order wins; repeated rows are judged alike; an empty table gives an empty
result; URLs of any length are read whole; other columns are ignored by the query.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, text_udf

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (Rule(ALLOW, "org", "/"), Rule(BLOCK, "example.org", "/es/"), Rule(BLOCK, "example.org", "/en/1"),
         Rule(ALLOW, "com", "/fr/"), Rule(BLOCK, "com", "/de/"))
# The vocabulary of the query.
STRICT = ("adult", "casino", "escort", "hentai", "milf", "nude", "nudes", "phishing", "porn", "porno", "sex", "spam", "viagra",
          "warez", "xxx")
SOFT = ("ads", "banner", "bet", "bets", "betting", "bonus", "cheap", "click", "coupon", "crack", "dating", "deal", "deals", "download",
        "farm", "free", "gambling", "hot", "jackpot", "keygen", "loan", "loans", "lottery", "pills", "poker", "popup", "prize", "promo",
        "replica", "sale", "slots", "torrent", "track", "tracker", "tracking", "win", "winner")
SOFT_LIMIT = 2
MAX_ENTRIES = 1 << 20

_ESCAPE = re.compile(r"%([0-7][0-9A-Fa-f])")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RESULT = "host string, path string, rule string, verdict string, strict_terms int, soft_terms int"


def host_and_path(url: str | None) -> tuple[str, str]:
    start = (url or "").find("://")
    if start < 0:
        return "", ""
    rest = re.split(r"[?#]", url[start + 3:], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class Rules:
    """Rules by host, the longest first; a host's own and its parents' entries are looked up."""

    def __init__(self, rules):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)

    def find(self, host: str, path: str) -> Rule | None:
        best, labels = None, host
        while labels:
            for rule in self.by_host.get(labels, ()):
                if path.startswith(rule.path) and (best is None or (len(rule.text), len(rule.host)) > (len(best.text), len(best.host))):
                    best = rule
            labels = labels.partition(".")[2]
        return best


def _letter_at(text: str, i: int) -> bool:
    return 0 <= i < len(text) and text[i].isalpha()


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict, soft):
        self.automaton = ahocorasick.Automaton()
        for hard, terms in ((False, soft), (True, strict)):
            for term in terms:
                self.automaton.add_word(term, (term, hard))
        if len(self.automaton):
            self.automaton.make_automaton()

    def count(self, url: str | None) -> tuple[int, int]:
        """Distinct strict and distinct soft terms that stand between non-letters."""
        if not url or not len(self.automaton):
            return 0, 0
        text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), url).translate(_LOWER)
        found = {(term, hard) for end, (term, hard) in self.automaton.iter(text)
                 if not (_letter_at(text, end - len(term)) or _letter_at(text, end + 1))}
        strict = sum(hard for _, hard in found)
        return strict, len(found) - strict


def judge(url: str | None, rules: Rules, vocabulary: Vocabulary, soft_limit: int = SOFT_LIMIT) -> tuple:
    host, path = host_and_path(url)
    rule = rules.find(host, path)
    strict, soft = vocabulary.count(url)
    verdict = rule.verdict if rule else BLOCK if strict or soft >= soft_limit else ALLOW
    return host, path, rule.text if rule else None, verdict, strict, soft


def verdict_column(url: Column, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> Column:
    """struct(host, path, rule, verdict, strict_terms, soft_terms)."""
    rules, strict, soft = [Rule(*r) for r in rules], list(strict), list(soft)
    if len(rules) + len(strict) + len(soft) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} rules and terms")
    made: list = []

    def run(urls: pd.Series) -> pd.DataFrame:
        if not made:                     # once a worker; the automaton does not travel
            made.append((Rules(rules), Vocabulary(strict, soft)))
        rows = [judge(u if isinstance(u, str) else None, *made[0], soft_limit) for u in urls]
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "strict_terms", "soft_terms"])

    return text_udf(run, RESULT)(url)


def keep_allowed(pages: DataFrame, **vocabulary) -> DataFrame:
    """``pages`` whose URL is allowed."""
    return pages.where(verdict_column(col(pages, "url"), **vocabulary)["verdict"] == ALLOW)


def query(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and the terms found, for every page."""
    out = pages.select(col(pages, "page_id").alias("page_id"), verdict_column(col(pages, "url")).alias("_u"))
    return out.select("page_id", *[F.col(f"_u.{c}") for c in ("host", "path", "rule", "verdict", "strict_terms", "soft_terms")])


def _sql_count(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(u, '(^|[^\\p{{L}}]){t}($|[^\\p{{L}}])') AS INTEGER)" for t in terms)


def _sql_rule(r: Rule, value: str) -> str:
    return f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value}'"


_BY_LENGTH = sorted(RULES, key=lambda r: (-len(r.text), -len(r.host)))
ORACLE_SQL = f"""
WITH h AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS rest,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM pages
), p AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '/.*$', 0, 's') AS path FROM h
), c AS (
  SELECT page_id, host, path, CASE {' '.join(_sql_rule(r, r.text) for r in _BY_LENGTH)} END AS rule,
         CASE {' '.join(_sql_rule(r, r.verdict) for r in _BY_LENGTH)} END AS ruled,
         {_sql_count(STRICT)} AS strict_terms, {_sql_count(SOFT)} AS soft_terms FROM p
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN strict_terms > 0 OR soft_terms >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END)
       AS verdict, strict_terms, soft_terms FROM c"""
