import pytest

from shelfledger.llm import site_style
from shelfledger.llm.common import ship_code
from shelfledger.llm.site_style import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><p>Site</p></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy</div><div id="cookie-notice">We use</div>
%s<aside>More</aside><form><label>Mail</label><input></form><section class="comments"><p>First!</p></section><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &amp; B</h1><p>One\n  <b>two</b>three.<p>Four<br>five</article>", "A & B\nOne twothree.\nFour five"),
    ("<article><p>x</p><!-- <p>gone</p> --><div class='share-buttons'>Share</div><ul><li>i<li>j</ul></article>", "x\ni\nj"),
    ("<main><p>&#233;&eacute;&nbsp;z &lt;tag&gt;</p><pre>a\n b</pre></main>", "éé z <tag>\na b"),
    ("<article><header><h1>Title</h1></header><p>p</p><div hidden>h</div><p title='a>b'>q</p></article>", "Title\np\nq"),
    ("<article><p>one</p><section class=\"reader comments\"><article><p>said</p></article></section><p>two</p></article>", "one\ntwo"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<div class='story'><p>No article tag</p></div>", "No article tag"),
])
def test_marks_decide(body, text):
    assert main_text(PAGE % body, frozenset()) == text


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &am", "plain &am"), ("<article><p>cut o", "cut o"), ("<article><p>cut</p><p cla", "cut"), ("<p>a</p", "a"),
    ("<article>a</b></i>b</article>", "ab"), ("<script>never closed", ""), ("<article><p>x<!-- never closed", "x"), ("<article>1 < 2 & 3</article>", "1 < 2 & 3"),
])
def test_broken_pages(page, text):
    assert main_text(page, frozenset()) == text


def pages(spark, rows):
    ship_code(spark)
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_branches_alike_on_all_pages_of_a_site_go(spark):
    rows = [
        (i, f"https://H.example.com/{i}", f"<body><div class='top'><p>Welcome back</p><p>to us</p></div><div class='story'><p>Story {i}</p></div><p>End {i}</p></body>")
        for i in range(12)
    ]
    rows += [(50, "https://other.example.com/", rows[0][2]), (51, None, rows[0][2]), (52, "https://h.example.com/x", None), (53, "no url", "")]
    got = {r.page_id: (r.text, r.n_chars) for r in site_style.extracted(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == (f"Story {i}\nEnd {i}", len(f"Story {i}\nEnd {i}"))
    assert got[50][0] == got[51][0] == "Welcome back\nto us\nStory 0\nEnd 0" and got[52] == got[53] == ("", 0)


def test_copies_of_a_marked_page_stay_whole(spark):
    rows = [(i, "https://a.example.com/same", PAGE % "<article><p>Same words</p></article>") for i in range(30)]
    assert {r.text for r in site_style.extracted(pages(spark, rows)).collect()} == {"Same words"}


def test_clashing_columns_empty_table_and_long_page(spark):
    df = pages(spark, [(1, "https://a.example/", "<article>" + "<p>word</p>" * 100_000 + "</article>")]).selectExpr("*", "'t' AS text", "'h' AS host", "0 AS low")
    r = site_style.extracted(df).first()
    assert r.n_chars == 499_999
    assert site_style.extracted(df.limit(0)).collect() == []


def test_branches_alike_in_all_articles_of_a_site_go(spark):
    box = "<div class='box'><p>Tell your friends about us</p></div>"
    story = "<body><article><p>Story %d runs on and on, and then some more</p>%s</article></body>"
    rows = [(i, f"https://a.example/{i}", story % (i, box)) for i in range(12)]
    rows += [(20 + i, f"https://a.example/own{i}", story % (20 + i, f"<div class='box'><p>Own words {i}</p></div>")) for i in range(1)]
    rows += [(30 + i, f"https://a.example/copy{i}", "<body><article><div class='lead'><p>A lead</p></div><p>And a copied story</p></article></body>") for i in range(9)]
    got = {r.page_id: r.text for r in site_style.extracted(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i} runs on and on, and then some more" for i in range(12))
    assert got[20].endswith("\nOwn words 0")
    assert all(got[30 + i] == "A lead\nAnd a copied story" for i in range(9))


def test_the_greater_part_of_an_article_stays(spark):
    body = "<body><article><div class='text'><p>The same long text on every page</p></div><p>Seen %d times</p></article></body>"
    got = [r.text for r in site_style.extracted(pages(spark, [(i, f"https://a.example/{i}", body % i) for i in range(12)])).collect()]
    assert all(t.startswith("The same long text on every page\nSeen") for t in got)


@pytest.mark.parametrize("body, text", [
    ("<div class='content with-sidebar'><article><p>a</p></article></div>", "a"),
    ("<article class='post no-sidebar'><p>a</p></article>", "a"),
    ("<article><section id='related-work'><h2 id='sharing-results'>b</h2><p class='notice'>c</p></section><div class='side-by-side'>d</div></article>", "b\nc\nd"),
    ("<article><section id='cookies'><h2 id='menu'>e</h2></section><pre>x <span class='comment'># y</span></pre></article>", "e\nx # y"),
    ("<div class='modal'><div class='overlay'><article><p>f</p></article></div></div>", "f"),
    ("<div class='sidebar'><main><p>g</p></main></div><div class='ad'><article>teaser</article></div>", "g"),
    ("<main><div class='widget'><article><p>h</p></article></div></main>", "h"),
    ("<article class='promo'><p>i</p></article>", "i"),
    ("<article><p>j</p></article><div class='related-posts'><article>teaser</article></div><div class='ad-box'>ad</div>", "j"),
    ("<div class='story'>k</div><div id='comments'><article><p>said</p></article></div><div class='share_buttons'>s</div>", "k"),
    ("<article><p>l</p><article class='comment'>said</article><div id='comments'>said</div><div class='social-links'>s</div></article>", "l"),
    ("<div class='story'>m</div><div class='sidebar'><article>teaser</article></div>", "m\nteaser"),
])
def test_one_word_of_a_name_drops_nothing(body, text):
    assert main_text(f"<body><nav>n</nav>{body}</body>", frozenset()) == text


def rough(spark, n, host="https://s.example/", head="", foot=""):
    """Pages whose classes say nothing: a list of links that are others on each page, a notice that is the same, a story."""
    def page(i):
        links = "".join(f"<li><a href='/{i}{k}'>Go {i * 7 + k}</a></li>" for k in range(8))
        story = "".join(f"<p>Story {i} goes on, part {k}</p>" for k in range(3 + i % 4))
        return f"<body><div class='x1'><ul>{links}</ul></div><div class='x2'>All rights are ours, you know</div><div class='x3'><h1>Title {i}</h1>{story}</div></body>"

    return pages(spark, [(i, f"{host}{i}", page(i)) for i in range(n)])


def test_the_tree_decides_without_telling_names(spark):
    """Menus and notices of meaningless class names go where a host has enough pages, and stay where it has not."""
    got = {r.page_id: r.text for r in site_style.extracted(rough(spark, 14)).collect()}
    for i in range(14):
        assert got[i] == "\n".join([f"Title {i}", *[f"Story {i} goes on, part {k}" for k in range(3 + i % 4)]])
    few = site_style.extracted(rough(spark, 3)).first().text
    assert "Go" in few and "rights" in few
    sums = site_style.removals(rough(spark, 14)).agg({"by_tree": "min", "by_marks": "max"}).first()
    assert sums[0] == 0 and sums[1] > 50 or sums[1] == 0 and sums[0] > 50


def test_links_in_text_and_lists_of_other_shapes_stay(spark):
    def page(i):
        see = "".join(f"<li><a href='/{k}'>Paper {i} {k}</a></li>" for k in range(i % 6))
        return f"<body><div class='x'><p>Read <a href='/a'>this {i}</a> first</p><p><a href='/b'>Source {i}</a></p><ul class='y'>{see}</ul></div></body>"

    got = {r.page_id: r.text for r in site_style.extracted(pages(spark, [(i, f"https://q.example/{i}", page(i)) for i in range(18)])).collect()}
    for i in range(18):
        assert got[i] == "\n".join([f"Read this {i} first", f"Source {i}", *[f"Paper {i} {k}" for k in range(i % 6)]])


def test_entropies_against_a_plain_version(spark):
    from collections import Counter, defaultdict
    from math import log

    rows = rough(spark, 9).union(rough(spark, 5, "https://t.example/")).collect()
    nodes, seen = defaultdict(list), set()
    for r in rows:
        host, found = r.url.split("/")[2], site_style.branches(r.html)
        if (host, tuple(found)) not in seen:
            seen.add((host, tuple(found)))
            for path, node in site_style._by_node(found).items():
                nodes[host, site_style._hash(path)].append(node)

    def entropy(values):
        n = len(values)
        return 1.0 if n < 2 else -sum(k / n * log(k / n, n) for k in Counter(values).values())

    df = spark.createDataFrame([(r.url.split("/")[2], r.html) for r in rows], "host string, html string")
    table = df.mapInArrow(site_style._nodes, site_style.NODES).distinct()
    got = {(r.host, r.path): r for r in site_style.importances(table).collect()}
    assert set(got) == set(nodes)
    for key, own in nodes.items():
        assert got[key].pages == len(own) and got[key].linked == all(n.linked for n in own)
        assert got[key].content == pytest.approx(entropy([n.content for n in own]), abs=1e-9)
        assert got[key].layout == pytest.approx(entropy([n.layout for n in own]), abs=1e-9)
        assert got[key].blocks == pytest.approx(sum(n.blocks for n in own) / len(own))


def test_broadcast_and_joined_branches_give_the_same(spark, monkeypatch):
    df = rough(spark, 14).union(pages(spark, [(90, None, "<p>a</p>"), (91, "https://lone.example/", "<p>b</p>")]))
    want = sorted(map(tuple, site_style.extracted(df).collect()))
    monkeypatch.setattr(site_style, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, site_style.extracted(df).collect())) == want
