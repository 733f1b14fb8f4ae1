import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import html_extract as X
from postlens.llm import labelled_pages as L


@pytest.fixture(scope="module")
def model():
    return X.default_model()


def test_messages_are_exact_marginals():
    """Sum-product on small trees equals the sum over all labellings."""
    r = np.random.default_rng(0)
    tree = X.parse("<body><div><p>a</p><p>b <b>c</b></p></div><nav>d</nav></body>")
    f = X.forest([tree])
    n = len(f.parent)
    unary, edges = r.normal(size=n), r.normal(size=(X._N_EDGES, 2, 2))
    node, pair = X.messages(f, unary, edges)
    total, want, both = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
    for code in range(2 ** n):
        y = [code >> i & 1 for i in range(n)]
        w = np.exp(sum(unary[i] * y[i] for i in range(n))
                   + sum(edges[f.edge[i], y[f.parent[i]], y[i]] for i in range(1, n)))
        total += w
        for i in range(n):
            want[i, y[i]] += w
            if i:
                both[i, y[f.parent[i]], y[i]] += w
    assert np.allclose(node, want / total) and np.allclose(pair[1:], both[1:] / total)


def test_held_out_pages(model):
    trees = [X.parse(p) for p in L.pages(150, seed=77)]
    p = model.marginals(trees)
    y = np.concatenate([t.mark for t in trees])
    shown = np.concatenate([[bool(s) for s in t.text] for t in trees])
    assert ((p > 0.5) == y)[shown].mean() > 0.97


def test_whole_table(spark):
    """The test pages hold their main text in one article: exact text, block by block."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split())
                 for x in re.split(r"</?(?:p|h1)>", article)]
        want[r["page_id"]] = "\n".join(x for x in parts if x)
    got = X.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Site</a><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies on this site. Please accept them.</p></div>
<article><h1>The &lt;title&gt; &amp; more</h1><p>First   paragraph of
text, with a <a href="/x">link</a> and <b>bold</b> words.</p><div class="ad">Buy this now, it is good.</div>
<p>Second paragraph. It has two sentences.</p><p>Short.</p><form><label>Mail</label><input><button>Go</button></form>
<p>Last one&hellip; caf&#233; &#x4e2d;.</p></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>Other</a></li></ul><p>More of these things here.</p></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><b>Al</b><p>I liked this article very much. Thanks!</p></div></section>
<footer>&copy; 2024 Site. All rights reserved.</footer><script>if (a < b) { c("</p>") }</script></body></html>"""


def test_parts_of_a_page(model):
    assert X.main_texts([PAGE], model) == [
        "The <title> & more\nFirst paragraph of text, with a link and bold words.\n"
        "Second paragraph. It has two sentences.\nShort.\nLast one… café 中."]


def test_edge_rows(spark, model):
    deep = "<div>" * 3_000 + "text" + "</div>" * 3_000
    long = "<article><h1>A</h1><p>" + "word " * 200_000 + "</p></article>"
    odd = [None, "", "   ", "<", "<p", "<!--", "<script>x", "plain text only", deep, long, "<a href='x>y", "</p></div>", "<p>&#0;&#xffffff;&bogus;</p>",
           "<article><p>unclosed <b>bold<p>next <i>one", "<table><tr><td>a<td>b<tr><td>c</table>"]
    df = spark.createDataFrame([(i, None if i == 3 else f"u{i}", h) for i, h in enumerate(odd)], "page_id long, url string, html string")
    for c in ("text", "n_chars", "parent"):
        df = df.withColumn(c, F.lit(1))
    out = {r["page_id"]: r for r in X.extract(df, model).collect()}
    assert len(out) == len(odd) and out[0]["text"] == out[1]["text"] == out[2]["text"] == ""
    assert out[9]["text"] == "A\n" + " ".join(["word"] * 200_000) and out[9]["n_chars"] == len(out[9]["text"])
    assert X.extract(df.limit(0), model).count() == 0
    twice = X.extract(df.unionAll(df), model)
    assert twice.count() == 2 * len(odd) and twice.distinct().count() == len(odd)


def test_foreign_and_custom_elements():
    def texts(page):
        return [t for t in X.parse(page).text if t]

    assert texts('<svg class="i"/><p>b</p><p>c</p>') == ["b", "c"]
    assert texts("<p>a <math/> b <svg viewBox='0 0 1 1'><path d='m'/></svg> c</p><p>d</p>") == ["a b c", "d"]
    assert texts("<title-card>one</title-card><object-list><p>two</p></object-list><template-x>three</template-x>") == ["one", "two", "three"]
    assert texts("<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds</p><p>x</p>") == ["so E=m holds", "x"]
    assert texts("<p>see <object data=f>fallback</object> <canvas>chart</canvas> <noscript>still</noscript></p>") == ["see fallback chart still"]
    assert texts("<xmp>code</xmp><svg><path><p>out</p><p>again</p>") == ["code", "out", "again"]
    assert texts("<title>t</title><script>1</script ><style/>p{}</style><textarea>x</textarea><p>y</p>") == ["y"]
