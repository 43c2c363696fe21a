import duckdb
import numpy as np
import pytest

from ledgerline.llm import html_text as H
from tests.llm.data import SF, with_clash

SCHEMA = "page_id long, url string, html string"
PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="home"><header><h1>Site name</h1></header>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav><div id="cookie-notice">We use cookies.</div>
<article><h1>The headline</h1><p>First &amp; second<br>line with <a href=x>a link</a>.<!-- no --><p>Third   line
<script>var t="</p>";</script><aside class="related">Read also this</aside></article>
<section class="comments"><p>Nice post!</p></section><form><label>Mail</label><button>Send</button></form><footer>&copy; 2024</footer>"""


@pytest.fixture(scope="module")
def pages():
    return duckdb.connect().execute(f"SELECT page_id, url, html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()


@pytest.fixture(scope="module")
def labeller(spark, pages):
    return H.train(spark.createDataFrame(pages, SCHEMA))


def test_blocks():
    got = [(b.text, b.path[-1]) for b in H.blocks(PAGE)]
    assert got == [("Site name", "h1"), ("Home", "li"), ("About us", "li"), ("We use cookies.", "notice"), ("The headline", "h1"),
                   ("First & second line with a link.", "p"), ("Third line", "p"), ("Read also this", "related"),
                   ("Nice post!", "p"), ("Mail", "form"), ("Send", "button"), ("© 2024", "footer")]
    assert H.blocks(None) == H.blocks("") == H.blocks("<p></p><!-- x") == []
    assert [b.text for b in H.blocks("a<b>c</b>d<div>e</span>f<p")] == ["acd", "ef"]


def test_hard_markup_is_linear():
    for text in ('<a "' * 50_000, "<div>" * 50_000 + "x", "<" * 100_000, "<!--" * 50_000, "&" * 100_000):
        H.blocks(text)


def test_main_text(labeller):
    assert list(H.extract(labeller, [PAGE, None, ""])) == [
        "The headline First & second line with a link. Third line", "", ""]


STORY = ("The council of the town voted on Monday for the new bridge over the river, after two years of talks.",
         "Work on the foundations should begin in spring, and the first cars may cross before the end of next year.",
         "Neighbours had asked for a lower speed limit, which the council will discuss in a later meeting.")
OUTER = """<html><body{body}><header><a href=/>The Daily</a></header><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div{div}><article{article}><h1>A bridge at last</h1>{story}</article></div><aside class="sidebar"><p>Most read</p></aside>
<section class="comments"><p>I like it.</p></section><footer><p>All rights reserved</p></footer></body></html>"""


@pytest.mark.parametrize("where, value", [
    ("body", "header-fixed"), ("body", "ad-free"), ("body", "home admin-bar logged-in widget-area"), ("body", "has-sidebar"), ("body", "nav-open"),
    ("div", "content with-sidebar"), ("div", "no-sidebar"), ("div", "page has-footer"), ("div", "sidebar-right-layout"),
    ("article", "post comment-open"), ("article", "post tags-news"), ("article", "entry share"), ("article", "")])
def test_state_words_of_wrappers(labeller, where, value):
    """A word in the class of an outer element, or of the article, takes nothing away and lets nothing in."""
    named = {k: f' class="{value}"' if k == where else "" for k in ("body", "div", "article")}
    page = OUTER.format(story="".join(f"<p>{p}</p>" for p in STORY), **named)
    assert [b.text for b in H.blocks(page) if H.path_label(b.path)] == ["A bridge at last", *STORY]
    assert list(H.extract(labeller, [page])) == [" ".join(["A bridge at last", *STORY])]


def test_forward_brute(labeller, pages):
    """The labels against a plain loop over blocks, gate by gate."""
    h, p = H.HIDDEN, labeller.p
    for _, _, page in pages[:3]:
        found = H.blocks(page)
        paths, dense = H.inputs(found)
        sums = []
        for way, part, order in (("f", 0, range(len(found))), ("b", 1, range(len(found) - 1, -1, -1))):
            state, cell, out = np.zeros(h), np.zeros(h), {}
            for i in order:
                g = dense[i] @ p["dense"] + sum(p["path"][k] for k in paths[i] if k)
                g = g[part * 4 * h:(part + 1) * 4 * h] + state @ p[way]
                enter, forget, leave = (1 / (1 + np.exp(-g[k * h:(k + 1) * h])) for k in range(3))
                cell = forget * cell + enter * np.tanh(g[3 * h:])
                state = leave * np.tanh(cell)
                out[i] = state
            sums.append(out)
        want = [np.concatenate([sums[0][i], sums[1][i]]) @ p["out"] + p["bias"][0] for i in range(len(found))]
        assert np.allclose(labeller.logits(found, [len(found)]), want)


def test_held_out_pages(labeller, pages):
    """Pages that were varied anew, with boilerplate between their blocks."""
    rng = np.random.default_rng(99)
    right = total = 0
    for _, _, page in pages:
        found, want = H.varied(H.blocks(page), rng)
        right += int(((labeller.logits(found, [len(found)]) > 0) == (want > 0)).sum())
        total += len(found)
    assert right / total > 0.98


def test_batches_do_not_mix(labeller, pages):
    some = [p for _, _, p in pages[:20]] + [PAGE, None]
    assert list(H.extract(labeller, some)) == [next(iter(H.extract(labeller, [p]))) for p in some]


def test_gradients():
    """The network's gradients against differences."""
    net = H.Labeller()
    rng = np.random.default_rng(0)
    found, y = [H.Block("one two", ("a", "p"), 0), H.Block("three", ("nav",), 3), H.Block("four", ("p",), 0)], np.array([1.0, 0, 1])
    paths, dense = H.inputs(found)
    ahead, behind = net.rows([2, 1])

    def loss():
        x = net.project(paths, dense)
        both = np.concatenate([net.run(x[:, :64], ahead, net.p["f"]), net.run(x[:, 64:], behind, net.p["b"])], axis=1)
        z = both @ net.p["out"] + net.p["bias"]
        return np.mean(np.logaddexp(0, z) - y * z), both, z
    _, both, z = loss()
    kept = []
    x = net.project(paths, dense)
    net.run(x[:, :64], ahead, net.p["f"], kept)
    e = (1 / (1 + np.exp(-z)) - y) / 3
    dx, dw = net._back(kept, np.outer(e, net.p["out"])[:, :16], net.p["f"], len(ahead))
    for _ in range(10):
        i, j = rng.integers(16), rng.integers(64)
        net.p["f"][i, j] += 1e-5
        up = loss()[0]
        net.p["f"][i, j] -= 2e-5
        down = loss()[0]
        net.p["f"][i, j] += 1e-5
        assert abs((up - down) / 2e-5 - dw[i, j]) < 1e-6


def test_query(spark, pages):
    rows = [*pages[:30], pages[0], (None, None, pages[1][2]), (900, "u", None), (901, "u", ""), (902, "u", "<p>" + "long words here. " * 20_000)]
    df = with_clash(spark.createDataFrame(rows, SCHEMA), "text", "n_chars")
    got = H.query(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (900, 901)} == {""}
    assert H.query(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("raw", [
    '<svg class="i"/>', "<math />", "<svg><path d=x></path>", "<svg><g>", "<noscript>", "<template>", "<iframe src=x>", "<object>",
    "<script>a<b", "<style>p{}", "<textarea>", "<title>T", "<head><title>T</title><meta a=b>", "<head><script>x='<p>'</script>"])
@pytest.mark.parametrize("after", ["", "<svg></svg><template></template>"])
def test_raw_elements_end(raw, after):
    if after and not raw.startswith(("<svg", "<math", "<head")):
        after = ""
    got = H.blocks(f"<body>{raw}<div class=x>One</div>{after}<p>Two")
    assert [b.text for b in got] == ["One", "Two"] and "head" not in got[0].path
    assert H.blocks("<svg><foreignObject><div>x</div></foreignObject></svg>") == []


def test_unclosed_raw_elements_are_linear():
    for name in H.RAW:
        H.blocks(f"<{name}>" * 30_000)
        H.blocks(f"<{name}>" * 30_000 + f"</{name}>")
        H.blocks(f"<{name}><p>" * 30_000 + f"</{name}>")
