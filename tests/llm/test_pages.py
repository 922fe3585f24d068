"""Main text of pages: parsing, what is cut by role and what by statistics."""

import math
import os
from collections import Counter, defaultdict

import pandas as pd
import pytest

from txnwatch.llm import sitetree
from txnwatch.llm.sitetree import Branches, host_of, main_text, read_page

SCHEMA = "page_id long, url string, html string, text string, host string, styles string"


def text_of(html):
    return main_text(read_page(html))


def extract(spark, rows):
    table = spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], SCHEMA)
    return {r["page_id"]: r for r in sitetree.extract(table).collect()}


def test_blocks_references_and_white_space():
    assert text_of("<article><h1>A &amp; B</h1><p>one\n two<br>three&nbsp;four<p><b>Bold.<br><p>x &lt; y &am</article>") == "A & B\n\none two three four\n\nBold.\n\nx < y &am"
    assert text_of("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>") == "one\n\ntwo\n\na\n\nb"
    assert text_of("plain 1 < 2 and <3 text") == "plain 1 < 2 and <3 text"


def test_what_a_page_is_not():
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var x='</p>';</script></head><body><header>top</header><nav><a>menu</a></nav>"
        "<!-- <p>gone</p> --><div class='cookie-notice'>c</div><div class='ad'>buy</div><aside>side</aside><main><article><header><h1>Title</h1></header>"
        "<p>Text</p><form><input>f</form><div id='user_comments'><p>first!</p></div><div hidden>h</div></article></main><footer>end</footer></body></html>")
    assert text_of(page) == "Title\n\nText"


def test_broken_pages():
    for page in ("", "<", "<p", "<p class='x", "<!-- open", "</p></div>", "<script>never ends", "<article><p>cut off <a href='x", "<div>" * 2000 + "deep"):
        text_of(page)
    assert text_of("<article><p>no ends") == "no ends" and text_of("<div>" * 2000 + "deep") == "deep"
    assert text_of("<body><p>a</p></body><p>after</p>") == "a\n\nafter"


def test_branches_that_repeat_on_a_host_are_cut(spark):
    page = "<body><div class='box'>Same on every page</div><div class='story'><p>Story number {0} about {0}</p><p>Shared passage.</p></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(12)]
    rows += [(100, "http://b.example/", page.format(5)), (101, None, page.format(6))]
    got = extract(spark, rows)
    assert got[3]["text"] == "Story number 3 about 3\n\nShared passage."
    assert got[100]["text"].startswith("Same on every page") and got[101]["text"].startswith("Same on every page")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_copies_of_an_article_keep_it(spark):
    rows = [(i, "http://a.example/x", "<body><nav>m</nav><div class='story'><p>All alike.</p></div></body>") for i in range(20)]
    rows += [(50 + i, "http://c.example/x", f"<article><h1>H</h1><div class='lead'>Same</div><p>Copy</p></article>") for i in range(20)]
    got = extract(spark, rows)
    assert {r["text"] for i, r in got.items() if i < 50} == {"All alike."}
    assert {r["text"] for i, r in got.items() if i >= 50} == {"H\n\nSame\n\nCopy"}


def test_a_style_that_only_copies_hold_is_kept(spark):
    varied = "<body><div class='box'>Same on every page</div><div class='story'><p>Story number {0}</p></div></body>"
    copied = "<body><div class='box'>Same on every page</div><div class='post-1234'><table><tr><td>All of the article.</table><p>And its end.</p></div></body>"
    rows = [(i, f"http://a.example/{i}", varied.format(i)) for i in range(12)]
    rows += [(50 + i, f"http://a.example/x?utm_source={i}", copied) for i in range(6)]
    got = extract(spark, rows)
    assert {r["text"] for i, r in got.items() if i >= 50} == {"All of the article.\n\nAnd its end."}
    assert got[3]["text"] == "Story number 3"


def test_both_joins_agree(spark, monkeypatch):
    page = "<body><div class='box'>Same</div><div class='story'>Story {0}</div></body>"
    rows = [(i, f"http://{'hot' if i % 3 else i}.example/{i}", page.format(i)) for i in range(60)]
    want = {i: r["text"] for i, r in extract(spark, rows).items()}
    monkeypatch.setattr(sitetree, "BROADCAST_BRANCHES", -1)
    assert {i: r["text"] for i, r in extract(spark, rows).items()} == want and want[1] == "Story 1"


def test_odd_rows(spark):
    got = extract(spark, [(1, "http://a", None), (2, "u", ""), (None, "http://a", "<p>x"), (3, "http://a", "<p>" + "long " * 100_000)])
    assert got[1]["text"] == got[2]["text"] == "" and got[None]["text"] == "x" and got[3]["n_chars"] == 499_999
    assert extract(spark, []) == {}


def test_hosts():
    assert host_of("http://User@WWW.a.example:80/x?y") == "www.a.example:80" and host_of("//b/x") == "b" and host_of("x") == "x" and host_of(None) is None


def plain_branches(pages):
    """The style trees of (url, html) pages one after another: per host, and per (host, style) what it measures."""
    seen = defaultdict(dict)
    for url, text in pages:
        page = read_page(text or "")
        whole = tuple(own for *_, own in page.blocks)
        nodes = defaultdict(list)
        for element in page.elements:
            nodes[element.style].append(element)
        for style, found in nodes.items():
            seen[host_of(url), style][whole] = (
                tuple(mark for e in found for mark in e.contents), tuple(tuple(e.children) for e in found), sum(e.words for e in found), page.words, found[0], any(e.titled for e in found))
    measured = {}
    for key, by_page in seen.items():
        n = len(by_page)
        entropy = [1.0, 1.0]
        if n > 1:
            entropy = [-sum(c / n * math.log(c / n, n) for c in Counter(row[i] for row in by_page.values()).values()) for i in (0, 1)]
        words, of = (sum(row[i] for row in by_page.values()) for i in (2, 3))
        measured[key] = (n, 0.9 * entropy[0] + 0.1 * entropy[1], entropy[1], words / of if of else 0.0, next(iter(by_page.values()))[4], any(row[5] for row in by_page.values()))
    hosts = defaultdict(lambda: (set(), set(), set()))
    bodies = defaultdict(float)
    for (host, _), (_, importance, _, _, element, _) in measured.items():
        if element.tag == "body":
            bodies[host] = max(bodies[host], importance)
    known = {key: row for key, row in measured.items() if row[0] >= 4 and row[4].tag != "body" and key[0] is not None}
    heavy = {key for key, row in known.items() if row[4].box and row[3] >= 0.5 and row[1] >= 0.2}
    above = {(host, known[host, style][4].parent) for host, style in heavy}
    for key, (_, importance, layout, share, element, titled) in known.items():
        cut, light, main = hosts[key[0]]
        if importance < 0.2 and bodies[key[0]] >= 0.5:
            cut.add(key[1])
        if element.box and not titled and share < 0.1 and layout < 0.4:
            light.add(key[1])
        if key in heavy - above:
            main.add(key[1])
    return measured, {host: Branches(*map(frozenset, sets)) for host, sets in hosts.items()}


@pytest.fixture(scope="module")
def given():
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    return pd.read_parquet(f"{folder}/pages.parquet").where(lambda t: t.notna(), None)


def test_importances_against_plain_style_trees(spark, given):
    page = "<body class='x'><div class='wrap'><div class='box'><p>Same</p></div><div class='news'>{0} new</div><div class='story'><p>{1}</p><p>End</p></div></div></body>"
    rows = [(u, h) for u, h in zip(given.url, given.html)]
    rows += [(f"http://{'hot' if i % 3 else 'b'}.example/{i}", page.format(i, f"word{i} " * 20 + "<p>" * (i % 7))) for i in range(40)] + [("http://hot.example/", None), (None, page)] * 2
    want, branches = plain_branches(rows)
    table = spark.createDataFrame(rows, "url string, html string")
    nodes = sitetree.importances(sitetree.once_each(sitetree.style_nodes(table))).collect()
    got = {(r["host"], r["style"] % (1 << 64)): r for r in nodes}
    assert got.keys() == want.keys()
    for key, (pages, importance, layout, share, _, titled) in want.items():
        row = got[key]
        assert (row["pages"], row["titled"]) == (pages, titled)
        assert abs(row["importance"] - importance) < 1e-9 and abs(row["layout_entropy"] - layout) < 1e-9 and abs(row["share"] - share) < 1e-9
    judged = {r["host"]: [{style % (1 << 64) for style in r[kind]} for kind in ("cut", "light", "main")] for r in sitetree.judged_branches(table).collect()}
    assert judged == {host: [set(b.cut), set(b.light), set(b.main)] for host, b in branches.items() if b != Branches()}


def test_given_pages_against_plain_style_trees(spark, given):
    _, branches = plain_branches(zip(given.url, given.html))
    want = {i: main_text(read_page(h or "", branches.get(host_of(u), Branches()))) for i, u, h in zip(given.page_id, given.url, given.html)}
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(given)).collect()}
    assert got == want


def test_the_style_tree_alone_finds_the_article_of_given_pages(given, monkeypatch):
    """Without names, and without the rule that a page with an article is that article, hosts with enough pages come out the same."""
    counts = Counter(given.url.map(host_of))
    with_rules = [main_text(read_page(h or "")) for h in given.html]
    monkeypatch.setattr(sitetree, "_NOISE_WORDS", frozenset())
    _, branches = plain_branches(zip(given.url, given.html))
    alone = changed = same = 0
    for url, html, want in zip(given.url, given.html, with_rules):
        if counts[host_of(url)] < 8:
            continue
        page = read_page(html or "", branches.get(host_of(url), Branches()))
        bare = [own for cut, _, _, _, own in read_page(html or "").blocks if not cut]
        kept = [own for cut, light, _, _, own in page.blocks if not cut and not light]
        alone, changed, same = alone + 1, changed + (bare != kept), same + ("\n\n".join(kept) == want)
    assert alone == changed == same


def test_depth_has_no_end():
    deep = "<div>" * 300
    assert text_of(f"<div><article>a{deep}x<p>tail</p>") == "a\n\nx\n\ntail"
    assert text_of(f"<article>{deep}<form>f</form><div class='ad'>buy</div><p>tail</p></article>") == "tail"
    assert text_of("<div><li>x</b>" * 50_000 + "deep").endswith("x\n\nxdeep")


def test_names_within_an_article():
    page = (
        "<article><div class='post-header'><h1>Title</h1></div><section id='promoted-to-colonel'><p>P2</p></section><p class='notice-of-meeting'>P3</p>"
        "<div class='ad-slot'>buy</div><div class='related posts-list'>more</div><div id='cookie-notice'>c</div><div class='user-comments'>first</div><p>P4</p></article>")
    assert text_of(page) == "Title\n\nP2\n\nP3\n\nP4"


def test_a_main_branch_outweighs_its_name_and_place(spark):
    long = " ".join(f"w{{0}}x{k}" for k in range(60))
    page = "<body><div class='promotion'><h2>On {0}</h2><p>" + long + "</p></div><article>Teaser {0}</article><div class='hint'>Tip {0} of today</div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(12)] + [(50, "http://b.example/", page.format(7))]
    got = extract(spark, rows)
    assert got[3]["text"] == "On 3\n\n" + long.format(3) + "\n\nTeaser 3"
    assert got[50]["text"] == "Teaser 7"


def test_light_boxes_beside_a_main_branch_go_and_titles_stay(spark):
    long = " ".join(f"w{{0}}x{k}" for k in range(80))
    page = "<body><div class='top'><h1>Title {0}</h1></div><div class='tip'>Buy {0} now</div><div class='story'><p>" + long + "</p><div class='lead'>{0} inside</div></div></body>"
    got = extract(spark, [(i, f"http://a.example/{i}", page.format(i)) for i in range(8)] + [(50, "http://b.example/", page.format(7))])
    assert got[3]["text"] == "Title 3\n\n" + long.format(3) + "\n\n3 inside"
    assert got[50]["text"].startswith("Title 7\n\nBuy 7 now")
