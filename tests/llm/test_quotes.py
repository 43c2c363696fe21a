import duckdb

from ledgerline.llm import quotes as Q
from tests.llm.data import with_clash

SCHEMA = "conv_id long, turn long, role string, text string"
CHAT = [
    (1, 0, "user", "How do I sort a list?\nIt has numbers."),
    (1, 1, "assistant", "> how do I  SORT a list?\nUse sorted."),
    (1, 2, "user", "On Monday the assistant wrote:\n> Use sorted.\n>> How do I sort a list?\nAnd reversed?"),
    (1, 3, "assistant", "> > How do I sort a list?\nPass a flag."),
    (1, 4, "user", "> never said\nThanks\n> Thanks"),
    (1, 5, "user", "I wrote: nothing"),
    (1, 6, "assistant", ">And reversed?\n> Thanks\nok"),
    (2, 0, "user", "> Use sorted.\nother conversation"),
]


def run(spark, rows):
    return {(r.conv_id, r.turn): r for r in Q.query(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_links_and_threads(spark):
    got = run(spark, CHAT)
    assert {k: r.reply_to for k, r in got.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 4): None, (1, 5): None, (1, 6): 4, (2, 0): None}
    assert {k[1]: (r.thread_turn, r.depth) for k, r in got.items() if k[0] == 1} == {
        0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 1), 4: (4, 0), 5: (5, 0), 6: (4, 1)}
    assert got[1, 2].text == "And reversed?" and got[1, 5].text == "I wrote: nothing" and got[1, 4].text == "> never said\nThanks\n> Thanks"
    assert got[1, 6].n_quotes == 2 and got[1, 6].n_linked == 2 and got[1, 1].chat == "<|assistant|>\nUse sorted.\n"


LONG = "The first clause of this long line is here, and the second clause of it follows right after."
MAIL = [
    (1, 0, "user", f"Hello all,\n{LONG}\nBye"),
    (1, 1, "user", "> The first clause of this long line\n> is here, and the second clause of it follows right after.\nWrapped."),
    (1, 2, "user", "> and the second clause of it follows right after.\nPartial."),
    (1, 3, "user", ">>> print(1)\n> Note: keep a copy.\nCode"),
    (1, 4, "user", "Ann wrote:\n> nothing known of this kind was ever said\n>> nor of this other kind\nCited."),
    (1, 5, "user", "> > The first clause of this long line is here,\n> > and the second\n> Partial.\nNested."),
    (1, 6, "user", "> bye\nShort."),
    (1, 7, "user", "> The first clause of another text that nobody ever wrote to this list\nUnlinked."),
    (1, 8, "user", "> Wrapped.\nx\n> Code\ny"),
]


def test_passages(spark):
    """Wrapped, partial, nested, cited and unlinked quotes."""
    got = {k[1]: r for k, r in run(spark, MAIL).items()}
    assert {t: r.reply_to for t, r in got.items()} == {0: None, 1: 0, 2: 0, 3: None, 4: None, 5: 2, 6: 0, 7: None, 8: 3}
    assert got[1].text == "Wrapped." and got[2].text == "Partial." and got[3].text == MAIL[3][3] and got[4].text == "Cited."
    assert got[5].text == "Nested." and got[6].text == "Short." and got[7].text == MAIL[7][3] and got[8].text == "x\ny"
    assert (got[1].n_quotes, got[1].n_linked) == (2, 2) and (got[5].n_quotes, got[5].n_linked) == (3, 3) and got[3].n_linked == 0


def test_long_quotes(spark):
    """A text of many words quoted whole with other line breaks, and many passages in one message."""
    words = [f"w{i * 7919 % 5003}" for i in range(6_000)]
    rows = [(1, 0, "user", " ".join(words)), (1, 1, "user", "\n".join("> " + " ".join(words[i:i + 9]) for i in range(0, 6_000, 9)) + "\nend"),
            (1, 2, "user", "".join(f"> {' '.join(words[i:i + 6])}\nanswer {i}\n" for i in range(600)))]
    got = run(spark, rows)
    assert got[1, 1].text == "end" and got[1, 1].reply_to == 0
    assert got[1, 2].reply_to == 0 and got[1, 2].text == "\n".join(f"answer {i}" for i in range(600))


def test_reading_order(spark):
    rows = Q.conversations(spark.createDataFrame(CHAT, SCHEMA)).collect()
    assert [(r.conv_id, r.turn) for r in rows] == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 6), (1, 5), (2, 0)]


def test_long_reply_chain(spark):
    rows = [(1, 0, "user", "line 0")] + [(1, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 70)]
    got = run(spark, rows)
    assert all(got[1, i].thread_turn == 0 and got[1, i].depth == i for i in range(70))


def test_oracle(spark):
    rows = CHAT + [(9, *r[1:]) for r in MAIL] + [(3, i, "user", f"> same line\nsame line\n> line {i - 7}\nline {i}") for i in range(40)]
    rows += [(4, 0, None, None), (4, 1, "user", ""), (4, 2, "user", ">\n>  \n"), (4, 3, "user", "x\r\n> x\r\ny  ")]
    rows += [MAIL[2], (1, 2, "user", "> Hello all,\nother text of a turn"), (None, 3, "user", "a wrote:\n> b"), (9, None, "user", "> bye")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(Q.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    got = [tuple(r[n] for n in names) for r in Q.query(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, cur.fetchall())) == sorted(map(str, got))


def test_awkward_rows(spark):
    rows = [*CHAT, CHAT[1], (None, 1, "user", "> Use sorted."), (1, None, "user", "> Use sorted."), (7, 1, None, None),
            (8, 0, "user", "long line " * 20_000 + "\n" + "> q\n" * 2000)]
    df = with_clash(spark.createDataFrame(rows, SCHEMA), "own", "l", "reply_to", "thread_turn")
    got = Q.query(df).collect()
    assert len(got) == len(rows)
    assert sum(r.reply_to == 0 for r in got if r.conv_id == 1 and r.turn == 1) == 2
    assert all(r.reply_to is None for r in got if r.conv_id is None or r.turn is None)
    assert Q.query(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = Q.parsed(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
