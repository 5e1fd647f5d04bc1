import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm.page_text import BORROWED, DAMPING, LEAST, Page, noise, page_text
from llm.queries import table
from tests.conftest import SMALL
from tests.llm.conftest import prose


def texts(html):
    return [t for _, t in Page(html).main()]


@pytest.mark.parametrize("html, want", [
    ("<p>a &amp; b&nbsp;c&#33;<p>d <b>e</b>\n f<br>g</div>h", ["a & b c!", "d e f g", "h"]),
    ("<ul><li>one<li>two <ul><li>in</ul>after</ul>", ["one", "two", "in", "after"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<script>var t='</p>';</script>x<style>p{}</style><!-- c > --> y <!doctype html>", ["x y"]),
    ("x <a title='a > b' href=q>link</a> 1 < 2 &am; &amp", ["x link 1 < 2 &am; &"]),
    ("<p>end <a href='", ["end"]), ("<p>x<script>never closed", ["x"]), ("", []), (None, []), ("   \n", []),
    ("<nav>m</nav><header>h</header><p>t</p><footer>f</footer><aside>s</aside><form>q<p>w</form>", ["t"]),
    ("<div class='ad'>x</div><div class='has-sidebar'>t</div><div id=cookieNotice>c</div><div role=search>s</div><section class='post-comments'>r</section>", ["t"]),
    ("<p>menu of outside</p><article><header><h1>Title</h1></header><p>the long article text of the page</p></article>", ["Title", "the long article text of the page"]),
    ("<article>teaser</article><div>the long text of the page stands outside of the teaser</div>", ["teaser", "the long text of the page stands outside of the teaser"]),
    ("<main><p>body text body text</p><div class=related>r</div></main><div>else</div>", ["body text body text"]),
    ("<body class='with-ads sidebar'><P>Upper</P></body></html>", ["Upper"]),
    ("<div hidden>no</div><div>yes</div>", ["yes"]),
])
def test_blocks(html, want):
    assert texts(html) == want


def site(rng, n, host, extra=""):
    """Pages of a site without speaking names: a menu, an article of plain paragraphs, a box and a line at the end."""
    out, arts = [], []
    for k in range(n):
        paras = [prose(rng, rng.randint(5, 30)).replace("\n", " ").strip() for _ in range(rng.randint(2, 6))]
        box = rng.choice(["Read our terms", "Members save", "Call now"])
        out.append((f"http://{host}/{k}", f"<html><body><div class=a1><span>Home</span> <span>News</span></div><div class=b2>{extra}" + "".join(f"<p>{p}</p>" for p in paras)
                    + f"</div><div class=c3>{box}</div><div><i>{host} {k}</i></div></body></html>"))
        arts.append("\n".join([re.sub(r"\s+", " ", p) for p in paras]))
    return out, arts


def frame(spark, rows):
    return spark.createDataFrame([(k, u, h, "x", "y", 1, "z") for k, (u, h) in enumerate(rows)],
                                 "page_id long, url string, html string, site string, host string, part int, nodes string").repartition(3)


def test_sites_without_names(spark):
    """The tree finds the furniture of a large host and of hosts with a page or two."""
    rng = random.Random(8)
    rows, want = site(rng, 60, "big.example.org")
    for k in range(12):
        r, w = site(rng, 1 + k % 2, f"small{k}.example.org")
        rows, want = rows + r, want + w
    got = {r.page_id: r for r in page_text(frame(spark, rows), bundle_bytes=4000).collect()}
    assert [got[k].text for k in range(len(rows))] == want
    assert all(got[k].n_chars == len(w) and got[k].n_dropped == 3 for k, w in enumerate(want))


def test_copies_stay(spark):
    """An article that most pages of a host carry is no menu."""
    rng = random.Random(9)
    rows, want = site(rng, 20, "copies.example.org")
    art = "".join(f"<p>{p}</p>" for p in want[0].split("\n"))
    rows += [(f"http://copies.example.org/c{k}", f"<html><body><div class=a1><span>Home</span> <span>News</span></div><div class=b2>{art}</div><div class=c3>Members save</div><div><i>copies.example.org {k}</i></div></body></html>") for k in range(80)]
    want += [want[0]] * 80
    got = {r.page_id: r.text for r in page_text(frame(spark, rows)).collect()}
    assert [got[k] for k in range(len(rows))] == want


def brute_noise(rows):
    """Low nodes by host, counted in plain Python."""
    trees, all_pages = defaultdict(dict), defaultdict(dict)
    for url, html in rows:
        host = (re.match(r"(?s)^.*?://([^/?#]*)", url or "") or [None, ""])[1].lower()
        page = Page(html)
        longest = max((t for _, t in page.main()), key=lambda t: (len(t), t), default="")
        facts = {(n, "text", re.sub(r"\d+", "0", t.replace(host, "@") if host else t)) for n, t in page.main()}
        facts |= {(n, "row", r) for n, r in page.rows if n in {f[0] for f in facts}}
        trees[host].setdefault(longest, []).append(facts)
    low = {}
    counts = {h: Counter(f for pages in t.values() for f in {*pages[0], *((n, "node", 0) for n, _, _ in pages[0])}) for h, t in trees.items()}
    every = sum(counts.values(), Counter())

    def scores(c):
        out = {}
        for node in {n for n, _, _ in c}:
            m = c[node, "node", 0]
            t, r = ([v for (n, kind, _), v in c.items() if n == node and kind == k] for k in ("text", "row"))
            if m < 2:
                out[node] = m, 1.0
                continue
            content = 1 - sum(map(math.log, t)) / len(t) / math.log(m)
            shown = -sum(v / sum(r) * math.log(v / sum(r)) for v in r) / math.log(m)
            w = DAMPING ** len(r)
            out[node] = m, (1 - w) * shown + w * content
        return out
    whole = scores(every)
    for host, c in counts.items():
        low[host] = {n for n, (m, s) in scores(c).items() if (m * s + BORROWED * whole[n][1]) / (m + BORROWED) < LEAST}
    return {h: v for h, v in low.items() if v}


def test_tree_equals_brute_force(spark):
    rng = random.Random(10)
    rows = site(rng, 25, "one.example.org")[0] + site(rng, 7, "two.example.org", "Own text. <h2>Part</h2>")[0] + site(rng, 3, "three.example.org", "<h3>New</h3>")[0]
    for k in range(30):  # a node that owns text and has differing rows of children
        rows.append((f"http://four.example.org/{k}", f"<body><div class=m>Always {rng.choice('xy')}{'<p>more</p>' * (k % 2)}{'<ul><li>q</ul>' * (k % 3 > 1)}</div><div class=n>{prose(rng, 30)}</div></body>"))
    rows += [(None, "<p>no url</p>"), ("nothing", "<p>no host</p>"), ("http://five.example.org", None)]
    pages = spark.createDataFrame([((re.match(r"(?s)^.*?://([^/?#]*)", u or "") or [None, ""])[1], h) for u, h in rows], "host string, html string").withColumn("site", F.xxhash64("host"))
    names = {r.site: r.host for r in pages.select("site", "host").distinct().collect()}
    got = {names[r.site]: {n & (1 << 64) - 1 for n in r.nodes} for r in noise(pages).collect()}
    assert got == brute_noise(rows)


def test_odd_pages(spark):
    rows = [(None, None), ("", ""), ("http://h.example.org/a", None), ("no scheme", "<p>one</p>"), (None, "<p>two</p>"), ("HTTP://H.Example.org", "<p>three</p>"),
            ("http://h.example.org/a", "<p>four"), ("http://h.example.org/a", "<p>four"), ("http://h.example.org/l", "<p>" + "long " * 300_000 + "</p>" * 3), ("://x", "<div>" * 3000 + "deep")]
    got = {r.page_id: r for r in page_text(frame(spark, rows)).collect()}
    assert [got[k].text for k in range(8)] == ["", "", "", "one", "two", "three", "four", "four"]
    assert got[8].text == ("long " * 300_000).strip() and got[8].n_chars == len(got[8].text) and got[9].text == "deep"
    assert [got[k].url for k in range(len(rows))] == [u for u, _ in rows]
    twice = spark.createDataFrame([(1, "http://a.b/c", "<p>x")] * 3 + [(None, "http://a.b/c", "<p>y")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text) for r in page_text(twice).collect()) == [(0, "y")] + [(1, "x")] * 3
    assert page_text(twice.limit(0)).count() == 0


def test_given_pages(spark):
    """The articles of the given pages are texts of the given documents, with the title above."""
    docs = {re.sub(r"\s+", " ", r.text).strip() for r in table(spark, SMALL, "documents").select("text").collect()}
    got = page_text(table(spark, SMALL, "pages")).collect()
    assert got and all(re.sub(r"\s+", " ", r.text.split("\n", 1)[1]) in docs for r in got)
