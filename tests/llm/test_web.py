"""Operators 6 and 8: pages and URLs."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagelens.llm import html_extract as hx
from usagelens.llm import url_filter as uf

PAGE = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGE).repartition(3)


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("  \n ", ""), ("plain &amp; simple &lt;b&gt; &#233;&eacute;", "plain & simple <b> éé"),
    ("<p>a<p>b<br>c<b>d</b>e", "a\n\nb cde"),
    ("<html><head><title>t</title></head><body><nav>menu</nav><article><h1>Head</h1><p>One\n  two</p></article><footer>f</footer>", "Head\n\nOne two"),
    ("<article><p><b>bold<br><p>next</p></article>", "bold\n\nnext"),
    ("<article>x<script>var a='</p><p>no';</script>y</article>", "xy"),
    ("<article><p>keep</p><div class='share-buttons social'>share</div><section id=comments>bad</section></article>", "keep"),
    ("<body><div class=\"ad\">buy</div><div>text</div><form><p>search</p></form><aside>side</aside></body>", "text"),
    ("<body><header>site</header><main><header><h1>T</h1></header><p>body</p></main></body>", "T\n\nbody"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\n\ntwo\n\na\n\nb"),
    ("<article><!-- no --><p>a &lt;p&gt; b</p><p hidden>x</p>", "a <p> b"),
    ("<article><p>half &amp", "half &"), ("<p>a < b and c > d</p>", "a < b and c > d"),
    ("<div class='address-adder'>kept</div>", "kept"), ("<article><div class='post-header'><h1>T</h1></div><p>x</article>", "T\n\nx"),
    ("<body><div class='site-header'>S</div><p>x</p></body>", "x"), ("<style>p{}</style><p>x", "x"), ("<article><p>a\u00a0 b</p>", "a\u00a0 b"),
])
def test_extract(html, text):
    assert hx.extract(html) == text


STORY = "".join(f"<p>The story goes on, part {k}, with words enough to be the most of its page.</p>" for k in range(4))
STORY_TEXT = "\n\n".join(f"The story goes on, part {k}, with words enough to be the most of its page." for k in range(4))


@pytest.mark.parametrize("html", [
    # comments marked up as articles: beside the story, in it, without a mark
    f"<body><article>{STORY}</article><article class='comment'><p>first!</p></article></body>",
    f"<article>{STORY}<article class='comment-12 even'><p>first!</p></article></article>",
    f"<article>{STORY}<article><p>first!</p></article><div><article><p>me too</p></article></div></article>",
    f"<article class='post has-sidebar comments-open category-social'>{STORY}</article>",
    # the articles found are not the story
    f"<body><main>{STORY}</main><div><article><p>teaser one</p></article><article><p>teaser two</p></article></div></body>",
    f"<body><main><article>{STORY}</article></main><div><article><p>teaser</p></article></div></body>",
    # parts of the story are articles, the outer one only wraps them; the story's article is most of the body
    "<article>" + re.sub("(<p>.*?</p>)", r"<article>\1</article>", STORY) + "</article>",
    f"<body><p>Short line</p><article>{STORY}</article></body>", f"<body><main hidden><p>old</p></main><article>{STORY}</article></body>",
])
def test_articles_that_are_no_story(html):
    assert hx.extract(html) == STORY_TEXT


@pytest.mark.parametrize("whole", ["<main>{}</main>", "<body><div>{}</div></body>"])
def test_story_beside_teaser_articles_stays(whole):
    text = hx.extract(whole.format(STORY + "<div><article><p>teaser</p></article><article class='comment'>no</article></div>"))
    assert text == STORY_TEXT + "\n\nteaser"


def test_site_templates_go_and_articles_stay(spark):
    rng = random.Random(61)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    box = "<div><p>Call us on weekdays</p></div>"
    rows, want = [], {}
    for k in range(40):
        own = f"{word()} {word()}"
        rows.append((k, f"https://a.test/{k}", f"<body><div>{own}</div>{box}<p>also {k}</p></body>"))
        want[k] = f"{own}\n\nalso {k}"
    for k in range(40, 46):         # too few pages of this host to tell
        rows.append((k, f"https://b.test/{k}", f"<body><div>{word()}</div>{box}</body>"))
    for k in range(50, 90):         # one article copied many times; headings and paragraphs recur
        rows.append((k, "https://c.test/x", "<body><article><h1>Same</h1><p>The.</p><p>copied text</p></article></body>"))
        want[k] = "Same\n\nThe.\n\ncopied text"
    for k in range(90, 130):        # different articles that share short paragraphs and a boxed call
        own = word()
        rows.append((k, f"https://d.test/{k}", f"<body><article><p>{own}</p><p>The.</p>{box}</article></body>"))
        want[k] = f"{own}\n\nThe."
    got = {r.page_id: r for r in hx.main_text(pages(spark, rows)).collect()}
    assert {k: got[k].text for k in want} == want
    assert all("Call us" in got[k].text for k in range(40, 46))
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_templates_of_large_hosts_and_copied_stories(spark):
    rng = random.Random(62)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    notes = [f"<div><p>Notice {k} of six</p><script>track({k})</script></div>" for k in range(6)]
    rows, want = [], {}
    for k in range(120):            # each notice stands on a sixth of the host, the section's box on a twelfth; both carry counters
        own = f"{word()} {word()}"
        note = notes[k % 6].replace("track(", f"track({k}")
        side = "<ul><li>Section one</li></ul>" if k < 10 else ""
        rows.append((k, f"https://big.test/{k}", f"<body><div>{own}</div>{note}{side}</body>"))
        want[k] = own
    story = "<h1>Same</h1><p>The copied</p><p>story text</p>"
    for k in range(200, 240):       # one story: only script, comment and advert differ
        rows.append((k, f"https://copy.test/{k}", f"<body><script>track({k})</script><!-- ad {k} --><div class='ad'>buy {k}</div>{story}</body>"))
        want[k] = "Same\n\nThe copied\n\nstory text"
    for k in range(300, 360):       # one story under rotating notices, which stand on other pages too
        own = word()
        rows.append((k, f"https://mix.test/{k}", f"<body>{story if k < 330 else f'<p>{own}</p>'}{notes[k % 2]}</body>"))
        want[k] = "Same\n\nThe copied\n\nstory text" if k < 330 else own
    got = {r.page_id: r.text for r in hx.main_text(pages(spark, rows)).collect()}
    assert got == want


def test_odd_page_rows(spark):
    rows = [(None, None, None), (1, None, "<p>a"), (1, "nohost", "<p>a"), (2, "http://h.test", ""), (3, "http://h.test", "<div>" * 3000 + "deep" + "x" * 200_000)]
    df = pages(spark, rows).withColumn("host", F.lit("clash")).withColumn("templates", F.lit(1)).withColumn("text", F.lit("x"))
    out = sorted(((r.page_id, r.url, r.text) for r in hx.main_text(df).collect()), key=str)
    assert out == sorted([(None, None, ""), (1, None, "a"), (1, "nohost", "a"), (2, "http://h.test", ""), (3, "http://h.test", "deep" + "x" * 200_000)], key=str)
    assert hx.main_text(pages(spark, [])).collect() == []


def brute_url(u):
    if not u or "://" not in u:
        return "", "", None, None
    host, path = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit, key=lambda x: len(x[0]), default=(None, None))
    return host, path, *rule


URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.ORG/es/1", "https://example.org", "https://example.org/", "https://xexample.org/es/",
        "https://a.b.example.org/en/12?x=/fr/", "https://s.com/fr/1#://q", "https://s.com/fr", "x://y://z/de/", "https://com/de/", "https://acom/de/",
        "https://É.COM/de/1", "https://s.com/a\nb?c", "https://" + "h" * 5000 + ".com/" + "p" * 50_000, "https://a.net/en/1", "https://org"]


def test_rules_and_parts(spark):
    rows = [(k if k % 4 else None, u) for k, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("features", F.lit(1)) \
        .withColumn("verdict", F.lit("x"))
    out = uf.judge(df).collect()
    want = sorted(((i, *brute_url(u)[:3]) for i, u in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in out), key=str) == want
    for r in out:
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict == brute_url(f"x://{r.host}{r.path}")[3]
        elif not r.host:
            assert r.verdict == "allow"


HELD_OUT_BLOCK = """mega-casino-slots.net lucky-poker-room.com www.bonus-bets-live.org betting-tips-winner.net jackpot-spins.com online-pharmacy-pills.net
    buy-viagra-now.com m.no-prescription-meds.net adult-cams-live.com hot-xxx-videos.net adult-dating-free.org spam-mail-sender.net
    bulk-backlinks-seo.com link-network-farm.org popup-ads-server.net click-banner-track.com ad-tracker-pixel.net free-prize-winner.com
    claim-your-gift.net cheap-replica-bags.com fast-payday-cash.net double-your-crypto.com keygen-crack-download.net
    verify-login-account.com rich-quick-money.net""".split()
HELD_OUT_ALLOW = """botanical-gardens.org www.riverside-school.net m.observatory.org village-bakery.com blog.woodworking.net chess-club.org
    maritime-museum.net poetry-magazine.com www.geology-society.org hiking-trails.net city-council.org blog.watercolours.com
    m.train-timetable.net public-radio.org astronomers.net medieval-history.org local-dairy.com www.violin-lessons.net birdwatching.org
    language-institute.com volcano-research.net blog.the-reading-room.org kitchen-garden.net thermal-springs.com opera-house.org""".split()


def test_classifier_on_held_out_hosts(spark):
    """Names of which none is in the labelled table: lists of our own, and all hosts of the given pages."""
    given = [r.host for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(uf.host_and_path(F.col("url"))[0].alias("host")).distinct().collect()]
    bad = [h for h in given if re.search("casino|bets|ads-track|spam|pills|adult", h)]
    block, allow = HELD_OUT_BLOCK + bad, HELD_OUT_ALLOW + [h for h in given if h and h not in bad]
    name = lambda h: re.sub(r"^(www|m|blog)\.|(\.example)?\.[^.]*$", "", h)
    assert not {name(h) for h in uf.BLOCK_HOSTS + uf.ALLOW_HOSTS} & {name(h) for h in block + allow}
    rows = [(k, f"https://{h}{uf.PATHS[k % len(uf.PATHS)]}") for k, h in enumerate(block + allow)]
    out = {r.page_id: r.blocked_by_model for r in uf.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=()).collect()}
    caught, spared = sum(out[k] for k in range(len(block))), sum(not out[k] for k in range(len(block), len(rows)))
    assert caught >= 0.95 * len(block) and spared >= 0.95 * len(allow)


def test_no_pages_and_no_python(spark):
    assert uf.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
    plan = uf.judge(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def _article(x):
    return hx.extract(f"<html><body><article><h1>T</h1>{x}<p>end of it</p></article></body></html>")


@pytest.mark.parametrize("x", ['<div style="overflow: hidden">kept</div>', '<p title="the hidden gem">kept</p>', '<div data-id="share">kept</div>',
                               '<p id="notice-of-death">kept</p>', '<section id="search-results-for-mh370">kept</section>', "<p title=it's>kept</p>",
                               '<p data-x="a>b" class="lead">kept</p>', "<p id=intro id=comments>kept</p>", '<p aria-hidden="false">kept</p>',
                               '<p title="class=ad">kept</p>', "<p title='id=\"comments\"'>kept</p>", "<p data-hidden>kept</p>"])
def test_attributes_are_judged_by_name_and_value(x):
    assert _article(x) == "T\n\nkept\n\nend of it"


@pytest.mark.parametrize("x", ["<div hidden>gone</div>", "<div HIDDEN=''>gone</div>", '<div id="comments">gone</div>', '<div id="social-share-2">gone</div>',
                               "<div id='comment-list'>gone</div>", '<p class="notice">gone</p>', "<p class=ad>gone</p>", '<div role="complementary">gone</div>',
                               '<p aria-hidden="true">gone</p>'])
def test_what_says_it_is_not_the_article_goes(x):
    assert _article(x) == "T\n\nend of it"


def test_quotes_count_only_after_the_equals_sign():
    assert _article("<p title=it's>one</p><p>two</p><p alt=don't>three</p>") == "T\n\none\n\ntwo\n\nthree\n\nend of it"
    assert hx.extract('a < b and <p title="x>y">c</p> 5 > 4 <') == "a < b and\n\nc\n\n5 > 4 <"


@pytest.mark.parametrize("page", ['<a "' * 100_000, '<a b="' * 100_000 + ">", "<b>" * 100_000 + "</i>" * 100_000, '<a b=">" ' * 100_000,
                                  "<" * 100_000 + ">", "<div>" * 100_000 + "</p>" * 100_000, "<b><h1>" * 50_000, "<!--" * 100_000])
def test_broken_markup_parses_in_linear_time(page):
    import time
    start = time.perf_counter()
    hx.parse(page[:len(page) // 4])
    quarter = time.perf_counter() - start
    start = time.perf_counter()
    hx.parse(page)
    assert time.perf_counter() - start < 12 * quarter + 1.0


def test_template_counting_equals_brute_force(spark):
    """Which subtrees a site repeats, counted in Spark and by the definition in plain Python."""
    import random
    rng = random.Random(4)
    boxes = [f"<div><span>box {k}</span><a href='/x'>more of it {k}</a></div>" for k in range(6)]
    rows = []
    for i in range(160):
        host = ("a.org", "b.org", "c.org")[min(2, rng.randrange(5) // 2)]
        story = f"<p>story {rng.randrange(60)} of {host}</p>"
        parts = rng.sample(boxes, rng.randrange(4)) + [story] + [f"<div><p>once {i}</p></div>"] * (rng.random() < .3)
        rng.shuffle(parts)
        rows.append((i, rng.choice([f"http://{host}/{i}", f"https://{host.upper()}/{i}?q"]), f"<html><body>{''.join(parts)}<script>t({i})</script></body></html>"))
    rows += [(500, None, boxes[0]), (501, "http://a.org/", None), (502, "http://a.org/again", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    least = 6

    hosts: dict = {}
    for _, url, page in rows:
        host = "" if url is None else url.split("://")[1].split("/")[0].lower()
        hosts.setdefault(host, {})[page or ""] = hx.subtrees(page or "")
    want = {}
    for host, pages in hosts.items():
        once = {x[0]: x for x in pages.values()}            # pages of equal text count once
        on: dict = {}
        for x in once.values():
            for h in set(x[1][1:]):
                on[h] = on.get(h, 0) + 1
        recurring = {h for h, n in on.items() if n >= least}
        rests: dict = {}
        for _, hashes, around, own in once.values():
            gone = recurring & set(hashes[1:])
            rest = hx.rest_of(hashes, around, own, gone)
            for h in gone if rest else ():
                rests.setdefault(h, set()).add(rest)
        known = {h for h, r in rests.items() if len(r) >= least}
        for page, x in pages.items():
            if known & set(x[1][1:]):
                want[host, page] = known & set(x[1][1:])
    tags = {r.tag: r.html for r in df.select(F.xxhash64(F.coalesce("html", F.lit(""))).alias("tag"), F.coalesce("html", F.lit("")).alias("html")).collect()}
    got = {(r.host, tags[r.tag]): set(r.templates) for r in hx.site_templates(df, least).collect()}
    assert got == want and len({h for x in want.values() for h in x}) > 6
