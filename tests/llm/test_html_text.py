import numpy as np
import pytest
from llm_samples import prose

from mercato.llm import html_text

PAGE = "page_id bigint, url string, html string"


def text(page):
    return " ".join(html_text.candidates(page)[1])


@pytest.mark.parametrize("page, want", [
    ("<article><h1>T</h1><p>One <b>two</b>three<br>four</p></article>", "T One twothree four"),
    ("<body><header>Site</header><nav><a href='/'>x</a></nav><main><p>Main</p></main><footer>&copy; us</footer></body>", "Main"),
    ("<body><header><h1>Site</h1></header><div class='sidebar'>S</div><p>One <b>two<p>Three &amp; four</body>", "One two Three & four"),
    ("<article><header><h1>Head</h1></header><p>Body</p><section id=comments><article class=comment><p>me too</p></article></section><footer>f</footer></article>", "Head Body"),
    ("<div class='layout with-sidebar'><article>Main <i>text</i><form><p>mail</p><input></form></article></div>", "Main text"),
    ("<main><p>a</p><script>var x='</p><p>no';</script><style>p{}</style><p>b &lt;c&gt; 5 < 6&nbsp;&#233;&#x1F600;</p></main>", "a b <c> 5 < 6 é\U0001F600"),
    ("<div class=\"cookie-notice\">c</div><div id='content'><p>real</p></div><p>loose</p>", "real"),
    ("<article><p>a</p><div class='ad banner'>buy</div><aside>also</aside><p hidden>h</p><p style='display: none'>n</p><p>z</p></article>", "a z"),
    ("<article><p title='a > b'>quoted</p><!-- <p>gone</p> --><p>kept</p>", "quoted kept"),
    ("<article>a<!-- unclosed", "a"), ("<article><script>unclosed", ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one two x y"), ("<ARTICLE>Up</ARTICLE>", "Up"), ("<p>a<p", "a<p"),
])
def test_structure(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page, want", [
    ('<div><h1 class="entry-title">T</h1><div class="body"><p>article</p></div></div>', "T article"),
    ('<div><span class="post-meta">by me</span><p>the article itself</p></div>', "by me the article itself"),
    ('<div id="post-17"><p>the post itself</p></div><p>loose</p>', "the post itself"),
    ('<div class="story">teaser</div><p>a longer text without a name</p>', "teaser a longer text without a name"),
    ("<main><p>text</p><article>card</article><p>end</p></main>", "text card end"),
    ("<html><head><title>t</title><meta charset=utf-8><body><p>kept</p>", "kept"),
    ("<head><title>t</title><style>p{}</style><p>kept</p>", "kept"),
    ("<head><title>t</title></head><body class='x'><p>kept</p></body>", "kept"),
])
def test_no_body_text_is_dropped_for_a_part_of_it(page, want):
    assert text(page) == want


LONG = "a paragraph of some length that tells the reader what the page was written for"


@pytest.mark.parametrize("page, want", [
    (f'<nav>m</nav><div id="share-price"><p>{LONG}</p></div>', LONG), (f'<div class="social-policy-report"><p>{LONG}</p></div>', LONG),
    (f'<div class="ad-free content"><p>{LONG}</p></div><footer>f</footer>', LONG), (f'<div class="alert"><p>{LONG}</p></div><footer>f</footer>', LONG),
    (f'<div class="alert"><p>{LONG}</p></div><p>by me</p>', f"{LONG} by me"),
    (f'<article><p>a</p><div class="notice-board"><p>{LONG}</p></div></article>', f"a {LONG}"),
    ('<article><div class="hero-banner"><h1>T</h1></div><p>a</p></article>', "T a"),
    (f'<div class="alert">short</div><p>{LONG}</p>', LONG), (f'<div class="site-footer"><p>links</p></div><p>{LONG}</p>', LONG),
    (f'<div class="cookie-notice top-bar">we use {LONG}</div><p>{LONG}</p><p>{LONG}</p>', f"{LONG} {LONG}"),
    (f'<article><p>{LONG}</p><div class="newsletter-box ad-300x250">{LONG} {LONG}</div><div class="related-posts">{LONG}</div></article>', LONG),
    (f'<p>short</p><div class="post-comments"><p>{LONG}</p></div>', "short"),
    ('<div class="alert">only this</div><nav>m</nav>', "only this"),
])
def test_names_count_as_a_whole_and_never_take_most_of_the_prose(page, want):
    assert text(page) == want


def test_covered_equals_brute_force():
    rng = np.random.default_rng(4)
    streams = [rng.integers(0, 3, rng.integers(0, 60)) for _ in range(12)]
    streams = [s for s in streams if len(s)]
    for depth in (2, 3, 5, 8):
        for least in (2, 4):
            on = {}
            for i, s in enumerate(streams):
                for k in range(len(s) - depth + 1):
                    on.setdefault(tuple(s[k:k + depth]), set()).add(i)
            for i, got in enumerate(html_text._covered(streams, depth, least)):
                want = np.zeros(len(streams[i]), dtype=bool)
                for k in range(len(streams[i]) - depth + 1):
                    if len(on[tuple(streams[i][k:k + depth])]) >= least:
                        want[k:k + depth] = True
                assert (got == want).all()


def test_long_adversarial_markup_is_quick():
    assert text("<a '" * 20_000) is not None and text("<" * 50_000) is not None and text("<div>" * 20_000 + "x") == "x"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, PAGE).selectExpr("*", "'own' AS host", "'own' AS text", "'own' AS shard", "'own' AS marked")


def test_host_boilerplate_in_loose_text_goes_and_unique_runs_stay(spark):
    boiler = "please read our terms before you go on reading here today"
    own = [" ".join(f"page{i} word{k % 17}" for k in range(40)) for i in range(30)]
    rows = [(i, f"https://h.example/{i}", f"<div><p>{boiler}</p><p>{t}</p></div>") for i, t in enumerate(own)]
    rows += [(100 + i, "https://small.example/x", f"<div><p>{boiler}</p><p>own {i}</p></div>") for i in range(3)]
    got = {r.page_id: r.text for r in html_text.main_texts(pages_of(spark, rows)).collect()}
    assert got == {**dict(enumerate(own)), **{100 + i: f"{boiler} own {i}" for i in range(3)}}


def test_copied_articles_stay(spark):
    texts = [r[1] for r in prose(40)] + ["the very same article told again on many pages of one host"] * 30
    rows = [(i, "http://h.example/", f"<nav>menu</nav><article><p>{t}</p></article>") for i, t in enumerate(texts)]
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.main_texts(pages_of(spark, rows), shard_pages=16).collect()}
    assert got == {i: (" ".join(t.split()), len(" ".join(t.split()))) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    big = (1 << 60) + 1
    rows = [(None, None, None), (big, None, "<article>x</article>"), (big, None, "<article>x</article>"), (2, "::", ""), (3, "http://u@h:1/", "<p></p>"), (4, "http://h/", "<article>" + "w " * 200_000 + "</article>")]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.main_texts(pages_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, None, "", 0), (big, None, "x", 1), (big, None, "x", 1), (2, "::", "", 0), (3, "http://u@h:1/", "", 0),
                          (4, "http://h/", ("w " * 200_000).strip(), 399_999)], key=repr)
    assert html_text.main_texts(spark.createDataFrame([], PAGE)).count() == 0


def test_shares_are_those_of_the_whole_host(spark):
    often, seldom = "this box stands on every fourth page of the large host", "this line stands on every eighth page of the large host"
    own = [" ".join(f"page{i} word{k % 17}" for k in range(12)) for i in range(96)]
    boxes = [f"<p>{often}</p>" * (i % 4 == 0) + f"<p>{seldom}</p>" * (i % 8 == 1) for i in range(96)]
    rows = [(i, f"http://h.example/{i}", f"<div>{boxes[i]}<p>{own[i]}</p></div>") for i in range(96)]
    rows += [(96 + i, f"http://h.example/copy{i}", f"<div><p>{own[95]}</p></div>") for i in range(200)]  # copies of a page count once
    got = {r.page_id: r.text for r in html_text.main_texts(pages_of(spark, rows), shard_pages=8).collect()}
    want = {i: f"{seldom} {t}" if i % 8 == 1 else t for i, t in enumerate(own)}
    assert got == {**want, **{96 + i: own[95] for i in range(200)}}


def test_hosts_without_common_runs_are_not_dealt_again(spark, monkeypatch):
    """op1_html: the pages of a large host move a second time only if it has common runs."""
    def unwanted(_):
        def of_shard(pages, runs):
            raise AssertionError("a host without common runs was dealt again")
        return of_shard

    monkeypatch.setattr(html_text, "_shard_texts", unwanted)
    words = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(40)]
    rows = [(i, f"http://h.org/{i}", f"<body><p>{words[i]}</p><p>b{i}</p></body>") for i in range(40)] + [(40, "http://h.org/e", None)]
    got = {r.page_id: r.text for r in html_text.main_texts(pages_of(spark, rows), shard_pages=8).collect()}
    assert got == {**{i: f"{words[i]} b{i}" for i in range(40)}, 40: ""}
