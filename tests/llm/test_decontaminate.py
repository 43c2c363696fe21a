import random
import re

import duckdb
import pytest

from ledgerline.llm import decontaminate as d
from tests.llm.data import SF, awkward, frame, sample, with_clash

BENCH = "item_id long, text string"
QUESTION = "a train travels 120 km from Bristol to Leeds in 3 hours what is the average speed of the train on that day"


def pairs(spark, docs, bench, **kw):
    got = d.contaminated(frame(spark, docs), spark.createDataFrame(bench, BENCH), **kw).collect()
    return {(r.doc_id, r.item_id): (r.n_covered, r.kind) for r in got}


def doc(i, text):
    return (i, text, "en", "s", len(text))


def test_verbatim_and_reparameterised(spark):
    other = QUESTION.replace("120", "90.5").replace("Bristol", "Derby").replace("Leeds", "York").replace("3", "4")
    uneven = "we know A: 5 apples and then 5 pears and also 5 plums so how many fruits are there in the basket"
    docs = [doc(1, "before it all " + QUESTION + " and after."), doc(2, "x " + other), doc(3, "nothing of the kind is here at all in this text"),
            doc(4, uneven.replace("5", "7")), doc(5, uneven.replace("5 pears", "6 pears"))]
    got = pairs(spark, docs, [(10, QUESTION), (20, uneven), (30, None), (None, QUESTION), (40, "")])
    assert {k: v[1] for k, v in got.items()} == {(1, 10): "verbatim", (2, 10): "reparameterised", (4, 20): "reparameterised"}


def test_units_are_placeholders(spark):
    item = "how far in total does the runner go if each lap is 400 m and there are twelve laps"
    assert list(pairs(spark, [doc(1, item.replace("400 m", "2 km"))], [(1, item)]).values())[0][1] == "reparameterised"


def test_short_items(spark):
    bench = [(1, "what is the capital of Peru"), (2, "yes"), (3, "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    docs = [doc(1, "tell me what is the capital of Chad please"), doc(2, "yes"), doc(3, "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    assert set(pairs(spark, docs, bench)) == {(1, 1)}


def test_too_little_overlap(spark):
    words = QUESTION.split()
    assert pairs(spark, [doc(1, " ".join(words[:10]))], [(1, QUESTION)]) == {}
    assert set(pairs(spark, [doc(1, " ".join(words[:16]))], [(1, QUESTION)])) == {(1, 1)}


def brute(docs, bench):
    """Items of which 13 words (or all) lie in common 8-word windows; for texts without slots."""
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    def windows(w):
        return {tuple(w[i:i + 8]) for i in range(len(w) - 7)}
    out = set()
    for i, text in docs:
        has = windows(words(text))
        for j, item in bench:
            w = words(item)
            hit = {i + k for i in range(len(w) - 7) if tuple(w[i:i + 8]) in has for k in range(8)}
            if len(hit) >= min(13, len(w)):
                out.add((i, j))
    return out


@pytest.mark.parametrize("max_broadcast", [d.MAX_BROADCAST, 0])
def test_against_brute_force(spark, max_broadcast):
    bench = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = sample(200)
    got = pairs(spark, docs, bench, max_broadcast=max_broadcast)
    assert set(got) == brute([r[:2] for r in docs], bench)


def test_rows_and_columns(spark):
    rows = [*awkward(20), (None, "x " + QUESTION, "en", "s", 1), (5000, QUESTION, "en", "s", 1), (5000, "other text", "en", "s", 1)]
    df = with_clash(frame(spark, rows), "_text_key", "item_id", "_bad_id")
    bench = with_clash(spark.createDataFrame([(1, QUESTION)], BENCH), "doc_id", "place")
    kept = d.remove_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(str, (tuple(r)[:5] for r in kept.collect()))) == sorted(map(str, [r for r in rows if QUESTION not in (r[1] or "")]))
    assert d.query(df, bench).count() == 2
    assert d.remove_contaminated(df, spark.createDataFrame([], BENCH)).count() == len(rows)
    assert d.remove_contaminated(frame(spark, []), bench).count() == 0


TOM = "Tom has 3 apples. Tom buys 5 more. How many apples does Tom have?"


def test_names_that_begin_sentences(spark):
    """A new name at sentence starts, in lower case, and behind a line break."""
    item = "We see that a runner called Tom went from the old town up to Leeds with his dog and two friends"
    docs = [doc(1, "So: " + TOM.replace("Tom", "Anna")), doc(2, "so: " + TOM.lower()),
            doc(3, item.replace("Tom", "\nTom").replace("Leeds", "\nLeeds")), doc(4, item.replace("Tom", "\nAnna").replace("Leeds", "\nYork"))]
    got = pairs(spark, docs, [(1, TOM), (2, item)])
    assert {k: v[1] for k, v in got.items()} == {
        (1, 1): "reparameterised", (2, 1): "verbatim", (3, 2): "verbatim", (4, 2): "reparameterised"}


def test_verbatim_copies_of_items_with_few_literals(spark):
    bench = [(1, "Compute 12 + 7 * 3 - 4 / 2"), (2, "Give Anna Bert Carl Dora Emil Fritz Gerda Hans Ida Jan Karl Lena"),
             (3, "capital of Peru"), (4, "Total 5 km 7 km 8 km 9 km 4 km 3 km 2 km")]
    docs = [doc(i, f"we read here: {text} and so on") for i, text in bench]
    docs += [doc(5, "compute 12 + 7 * 3 - 4 / 5"), doc(6, "capital in Peru"), doc(7, "total 5 km 7 km 8 km 1 km 4 km 3 km 2 km")]
    assert {k: v[1] for k, v in pairs(spark, docs, bench).items()} == {(i, i): "verbatim" for i in range(1, 5)}


def test_slots_of_several_tokens(spark):
    """Names and numbers of other lengths, and numbers in words."""
    item = "a train travels for 4 hours from Leeds to Bath at 120 km an hour what distance does it cover then"
    docs = [doc(1, TOM.replace("Tom", "Mary Ann")), doc(2, TOM.replace("3", "three").replace("5", "seven")),
            doc(3, TOM.replace("Tom", "Jean-Luc").replace("3", "3 1/2").replace("5", "twenty-five")),
            doc(4, item.replace("Leeds", "New York").replace("120", "1/2").replace("Bath", "San Diego Bay")),
            doc(5, TOM.replace("Tom has", "Mary Ann has").replace("Tom buys", "Mary Sue buys").replace("Tom have", "Eve have"))]
    got = pairs(spark, docs, [(1, TOM), (2, item)])
    assert {k: v[1] for k, v in got.items()} == {(i, 2 if i == 4 else 1): "reparameterised" for i in (1, 2, 3, 4)}


def test_runs_end_at_sentences_and_lists(spark):
    t = d.Template(["we saw Ann Lee. Bob Ray left 3 1/2 or 5, 6 and forty two of New-York"])
    text = "we saw Ann Lee. Bob Ray left 3 1/2 or 5, 6 and forty two of New-York"
    assert t.slots([text], 0, len(t.first[d.AS_NAME]), d.AS_NAME) == [
        f"{d.NAME}:ann lee", f"{d.NAME}:bob ray", f"{d.NUMBER}:3 1/2", f"{d.NUMBER}:5", f"{d.NUMBER}:6", f"{d.NUMBER}:forty two", f"{d.NAME}:new-york"]


def template_brute(docs, bench):
    """Texts as lists of (kind, words): items contained by the method's rules, in plain loops."""
    def windows(parts):
        """template window -> [(place, first word, behind last word, slot values)]"""
        out, starts = {}, [0]
        for _, words in parts:
            starts.append(starts[-1] + len(words))
        for i in range(len(parts) - 7):
            w = parts[i:i + 8]
            if sum(kind == "" for kind, _ in w) >= 4:
                key = tuple(kind or words[0] for kind, words in w)
                out.setdefault(key, []).append((i, starts[i], starts[i + 8], [(kind, " ".join(words)) for kind, words in w if kind]))
        return out

    def plain(parts):
        """8 words -> [(place of the first one's part, first word)]"""
        words = [(w, k) for k, (_, ws) in enumerate(parts) for w in ws]
        out = {}
        for i in range(len(words) - 7):
            out.setdefault(tuple(w.lower() for w, _ in words[i:i + 8]), []).append((words[i][1], i))
        return out
    found = {}
    for d_id, text in docs:
        for b_id, item in bench:
            lines, plains = {}, {}
            has, own = windows(text), windows(item)
            for key in own.keys() & has.keys():
                for i, first, behind, values in own[key]:
                    for at, _, _, filled in has[key]:
                        spans, fills = lines.setdefault(at - i, (set(), set()))
                        spans.update(range(first, behind))
                        fills.update(zip(values, filled, strict=True))
            has, own = plain(text), plain(item)
            for key in own.keys() & has.keys():
                for i, first in own[key]:
                    for at, _ in has[key]:
                        plains.setdefault(at - i, set()).update(range(first, first + 8))
            good = {k for k, (_, fills) in lines.items() if len(fills) == len({a for a, _ in fills})}
            covered = set().union(*(lines[k][0] for k in good), *(s for k, s in plains.items() if k in good or k not in lines))
            if len(covered) >= min(13, sum(len(ws) for _, ws in item)):
                found[d_id, b_id] = len(covered)
    return found


@pytest.mark.parametrize("max_broadcast", [d.MAX_BROADCAST, 0])
def test_templates_against_brute_force(spark, max_broadcast):
    rng = random.Random(5)
    names = [["Ann"], ["Mary", "Ann"], ["Bob"], ["Leeds"], ["New", "York"]]
    numbers = [["3"], ["4.5"], ["3", "1/2"], ["seven"], ["twenty", "five"], ["1,000"]]
    literals = [chr(97 + k) * 4 for k in range(26)]

    def item():
        out = []
        for _ in range(rng.randint(10, 24)):
            slot = out and not out[-1][0] and rng.random() < 0.3
            out.append(rng.choice([("name", rng.choice(names)), ("number", rng.choice(numbers))]) if slot else ("", [rng.choice(literals)]))
        return out

    def varied(parts):
        """Slots filled anew (mostly one value by another throughout), some literals changed, a part cut out."""
        to = {}
        out = []
        for kind, words in parts:
            pool = {"name": names, "number": numbers}.get(kind)
            if pool and rng.random() < 0.1:
                words = rng.choice(pool)
            elif pool:
                words = to.setdefault(" ".join(words), rng.choice(pool))
            elif rng.random() < 0.03:
                words = [rng.choice(literals)]
            out.append((kind, words))
        first = rng.choice([0, 0, 0, rng.randrange(len(out))])
        return [("", ["zzzz"])] * rng.randint(1, 9) + out[first:]
    bench = [(k, item()) for k in range(12)]
    docs = [(100 + k, varied(rng.choice(bench)[1]) + rng.choice([[], varied(rng.choice(bench)[1])])) for k in range(150)]

    def text(parts):
        return " ".join(w for _, words in parts for w in words)
    want = template_brute([(k, [(kind, [x for w in ws for x in w.split("/")]) for kind, ws in p]) for k, p in docs],
                          [(k, [(kind, [x for w in ws for x in w.split("/")]) for kind, ws in p]) for k, p in bench])
    got = pairs(spark, [doc(k, text(p)) for k, p in docs], [(k, text(p)) for k, p in bench], max_broadcast=max_broadcast)
    assert len(want) > 60 and {k: v[0] for k, v in got.items()} == want
