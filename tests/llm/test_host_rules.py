import re
from collections import Counter

import duckdb
import pytest

from ledgerline.llm import host_rules as H
from tests.llm.data import awkward, frame, with_clash


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(win)
    repeated = {i + k for i, w in enumerate(win) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))


TEXTS = ["a b c a b c", "a a a a a", "x\nx\n\n \nx y\nx", "a\x85b c #*|", "a b c d\ta\vb\fc", "a b", ""]


def test_counts(spark):
    rows = [(20_000 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [r for r in awkward() if r[0] is not None]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in H.query(with_clash(frame(spark, rows), "host", "s", "trusted")).collect()}
    assert got == {r[0]: brute(r[1]) for r in rows}


def good(i):
    return " ".join(f"word{i}x{k}" for k in range(60))


def symbols(i):
    return " ".join(f"w{i}x{k}##" for k in range(60))


def test_verdicts(spark):
    rows = [(i, symbols(i), "en", "bad.example", 0) for i in range(90)] + [(100 + i, good(i), "en", "bad.example", 0) for i in range(10)]
    rows += [(1000 + 100 * h + i, good(i), "en", f"good{h}.example", 0) for h in range(5) for i in range(40)]
    rows += [(3000, symbols(1), "en", "good0.example", 0), (3001, symbols(2), "en", None, 0), (3002, "too short", "en", None, 0)]
    got = {r.doc_id: r for r in H.query(frame(spark, rows)).collect()}
    assert not any(got[i].kept for i in range(90))                       # fail a rule on a bad host
    assert all(got[100 + i].kept for i in range(10))                     # clean on a bad host
    assert got[3000].kept and got[3001].kept and not got[3002].kept and got[3002].base_failed


def test_shrinking(spark):
    """Hosts alike are judged alike, and a host of few documents is not trusted for having had no failure yet."""
    rows = [(h * 100 + i, good(i) if i > 1 else symbols(i), "en", f"h{h}", 0) for h in range(10) for i in range(20)]
    rows += [(5000 + i, good(i) if i else symbols(i), "en", "small", 0) for i in range(12)]
    got = {r.doc_id: r.kept for r in H.query(frame(spark, rows)).collect()}
    assert not got[5000] and not got[0] and all(k for i, k in got.items() if i % 100 > 1)


@pytest.mark.parametrize("extra", [[], [(9100 + i, symbols(i), "en", "src0", 0) for i in range(400)]])
def test_oracle(spark, extra):
    seen, rows = set(), []
    for r in awkward(200) + extra:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    cur = con.execute(H.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    assert sorted(cur.fetchall()) == sorted(tuple(r[n] for n in names) for r in H.query(frame(spark, rows)).collect())


def test_no_python_and_no_rows(spark):
    assert H.query(frame(spark, [])).count() == 0
    plan = H.features(frame(spark, awkward(5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
