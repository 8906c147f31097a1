"""Main text of pages: what declares itself furniture, what a site's tree finds, and odd markup."""

from __future__ import annotations

import math

import pytest

from tabloom.llm import pages, site_style

SCHEMA = "page_id long, url string, html string, text string, node long"


def text_of(html, unimportant=frozenset()):
    return site_style.main_text(html, site_style.root_key("http://a.example/x"), unimportant)


def extract(spark, rows, settings=site_style.Settings()):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    found = site_style.extracted(table, settings)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return sorted(((r["page_id"], r["text"]) for r in rows), key=repr)


FULL = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a < b) "</p>";</script></head>
<body class="has-sidebar with-comments"><header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>
<main><article class="post comments-open"><header><h1>Title &amp; more</h1></header>
<p>One <b>bold</b> <a href="/x">link</a>,<br>next&nbsp;line   here.<p>Two &lt;tags&gt; &#8364; &copy
<ul><li>first<li>second</ul><span class="ad">ad <span>in</span> it</span><table><tr><td>a<td>b</table>
<blockquote>quoted</blockquote><pre>  pre
 text</pre><aside>side</aside><form>name <input> <button>send</button></form><footer>by us</footer>
<section id="comments"><h2>Comments</h2><article><p>nice</p></article></section></article>
<div class="related">Read on</div></main><div id="sidebar"><p>More</p></div><footer>&copy; us</footer></body></html>"""


def test_furniture_and_blocks():
    wanted = ["Title & more", "One bold link, next line here.", "Two <tags> € ©", "first", "second", "a", "b", "quoted", "pre text"]
    assert text_of(FULL).split("\n") == wanted


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("plain text &amp; no tags", "plain text & no tags"),
        ("<p>a<p>b</p>c", "a\nb\nc"),
        ("<p><b>open<br><p>next</p>", "open\nnext"),
        ("a < b and <3 but x<y", "a < b and <3 but x"),  # a tag that the page ends in is no text
        ("<div>a<!-- b --> c<!-->d</div><!-- to the end", "a cd"),
        ("<p title='>'>x</p><p title=\"a>b\">y</p>", "x\ny"),
        ("<script>never closed <p>x", ""),
        ("<nav>menu</nav>", ""),
        ("<form><main><p>kept</p></main></form>", "kept"),
        ("<form><p>gone</p></form>", ""),
        ("<p>a <button>b</button> c <label>d</label>e</p>", "a c e"),
        ("<h1>Own</h1><article><p>x</p></article><div>beside</div>", "Own\nx"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
        ("</div></p><p>x</p></section>y", "x\ny"),
        ("<p>&am &amp &quot;&#x41;&nosuch;</p>", '&am & "A&nosuch;'),
    ],
)
def test_odd_markup(html, wanted):
    assert text_of(html) == wanted


def test_very_deep_and_very_long_pages():
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>") == "deep\nafter"
    assert max(e.depth for e in pages.parsed("<div>" * 3000, 1)[0]) == pages.DEEPEST
    long = "<article>" + "<p>word <i>and</i> word</p>" * 100_000 + "</article>"
    assert text_of(long) == "\n".join(["word and word"] * 100_000)


def brute_importance(site, settings):
    """Importances of all nodes of one host's pages from first principles, page by page."""
    trees = [pages.parsed(html, 7) for html in site]
    paths, chains = {}, {}
    for k, (elements, blocks) in enumerate(trees):
        for e in elements:
            node = paths.setdefault(e.key, {"pages": set(), "styles": {}, "features": {}})
            node["pages"].add(k)
            chain, up = set(), e
            while up:
                chain.add(up.key)
                up = up.parent
            chains[e.key] = chain
            if e.children:
                node["styles"].setdefault(tuple(e.children), set()).add(k)
            for f in e.features:
                node["features"].setdefault(f, []).append(k)
        for e, text in blocks:
            paths[e.key]["features"].setdefault(pages.DIGITS.sub("0", text.lower()), []).append(k)

    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total, m) for c in counts)

    def held(value, m):
        return (m * (value if m > 1 else 1.0) + settings.prior) / (m + settings.prior)

    content, layout = {}, {}
    for key, node in paths.items():
        m = len(node["pages"])
        if node["features"]:
            spread = [entropy([uses.count(k) for k in set(uses)], m) if m > 1 else 0 for uses in node["features"].values()]
            content[key] = held(1 - sum(spread) / len(spread), m)
        if node["styles"]:
            layout[key] = held(entropy([len(s) for s in node["styles"].values()], m) if m > 1 else 1.0, m)
    own = {}
    for key, node in paths.items():
        inside = [c for k, c in content.items() if key in chains[k]]
        rest = settings.attenuation ** len(node["styles"])
        if node["styles"]:
            own[key] = (1 - rest) * layout[key] + rest * sum(inside) / len(inside) if inside else layout[key]
        else:
            own[key] = content.get(key, 0.0)
    return {key: (len(paths[key]["pages"]), own[key], max(v for k, v in own.items() if key in chains[k])) for key in paths}


def site(n, promo="<div class=box><p>Join us today</p><a href=/join>here</a></div>"):
    body = "<html><body><div class=top>Welcome</div>{promo}<div class=text><h2>Head {k}</h2>{ps}</div>{end}</body></html>"
    end = ["<div class=end>the end</div>", "<div class=end><ul><li>the</ul> end</div>"]
    return [body.format(promo=promo, k="ab"[k % 2] * k, ps="".join(f"<p>text {'xyz'[j] * (k + 1)}</p>" for j in range(k % 3 + 1)), end=end[k % 5 == 0]) for k in range(n)]


def test_importances_equal_plain_computation(spark):
    settings = site_style.Settings(prior=5.0, gathered=20)
    rows = [(k, "HTTP://One.example/p", h) for k, h in enumerate(site(40))]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    found = {r["node"]: (r["pages"], r["importance"], r["branch"]) for r in site_style.style_trees(table, settings).collect()}
    names = {}
    for own, other in ((7, "plain"), (site_style.root_key("http://one.example/"), "spark")):
        for h in site(40):
            for e in pages.parsed(h, own)[0]:
                path, up = [], e
                while up:
                    path.append((up.tag, tuple(up.parent.children) if up.parent else ()))
                    up = up.parent
                names.setdefault(other, {}).setdefault(e.key, len(names.get(other, {})))
    wanted = {names["plain"][k]: v for k, v in brute_importance(site(40), settings).items()}
    got = {names["spark"][k]: v for k, v in found.items()}
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(wanted[k], abs=1e-9) for k in wanted)


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_branches_that_a_site_repeats_are_removed(spark, limit):
    """On a large site unnamed furniture goes; on a small one nothing is known; copies of a page keep their text."""
    rows = [(k, "http://large.example/", h) for k, h in enumerate(site(600))]
    rows += [(1000 + k, "http://small.example/", h) for k, h in enumerate(site(3))]
    rows += [(2000 + k, "http://copies.example/", site(2)[1]) for k in range(300)]
    rows += [(3000, None, "<p>no host</p>"), (3000, "", None), (None, "x", "<p>x</p>")]
    found = dict(extract(spark, rows, site_style.Settings(broadcast=limit)))
    assert found[7] == "Head bbbbbbb\ntext xxxxxxxx\ntext yyyyyyyy"
    assert found[1001].startswith("Welcome\nJoin us today\nhere\nHead b") and found[2001] == found[1001]
    assert found[None] == "x" and found[3000] in ("", "no host")


def test_empty_table(spark):
    assert extract(spark, []) == []
