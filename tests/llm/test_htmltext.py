import pytest
from pyspark.sql import functions as F

from corpusloom.llm import htmltext

KIND = "page_id long, url string, html string"
ARTICLE = "<h1>Title &amp; more</h1><p>First para of&nbsp;text\n with <a href=x>a link</a> inside.<p>Second<br>para &lt;b&gt; &#233; &euro;<ul><li>one<li>two</ul><p>.</p>"
EXPECTED = "Title & more\nFirst para of text with a link inside.\nSecond para <b> é €\none\ntwo\n."
HEAD = '<!DOCTYPE html><html><head><title>Tab</title><style>p{color:red}</style><script>var t="</p>";</script></head><body class="no-js has-sidebar">'
MENU = '<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News and more</a></li></ul></nav><div class="cookie-notice">We use cookies here</div>'
TAIL = '<aside>Related things to read</aside><section id="comments"><p>Great article thanks so much for posting this one.</p></section><form><label>Mail</label><input name=q></form><footer>&copy; 2020 Site &middot; All rights</footer></body></html>'
def fitted(pages):
    """Weights from pages, without Spark."""
    sums = {}
    for page in pages:
        for sign, (a, b) in htmltext.counts(page).items():
            x, y = sums.get(sign, (0, 0))
            sums[sign] = (x + a, y + b)
    return htmltext.fit((s, a, b) for s, (a, b) in sums.items())


LABELLED = [f"{HEAD}{MENU}<article>{ARTICLE}</article>{TAIL}" for _ in range(5)]
PAGES = [
    (f"{HEAD}{MENU}<!-- ad --><div class='ad'>Buy now</div><article>{ARTICLE}</article>{TAIL}", EXPECTED),
    (f"{HEAD}{MENU}<main><div class='post'>{ARTICLE}</div></main>{TAIL}", EXPECTED),
    (f"{HEAD}{MENU}<div id='content'>{ARTICLE}</div>{TAIL}", EXPECTED),
    (f"{HEAD}{MENU}<article>{ARTICLE.replace('<p>Second', '<div class=advert>Cheap stuff today</div><p>Second')}</article>{TAIL}", EXPECTED),
    (f"{HEAD}{MENU}<article><header>{ARTICLE[:25]}</header>{ARTICLE[25:]}<footer>Filed under x</footer></article>{TAIL}", EXPECTED),
    (f"{HEAD}{MENU}<article>{ARTICLE}", EXPECTED),
    (f"{HEAD}{MENU}<article>{ARTICLE}<div class='comments'><article>Nice one indeed</article></div></article>{TAIL}", EXPECTED),
    ("plain words only", "plain words only"), (None, ""), ("", ""), ("<p>unclosed <b", "unclosed"), ("<nav>a b c</nav>", ""), ("<script>never ends <p>text</p>", ""), ("<!-- never ends <p>text", ""), ('<p title="a > b">kept</p>', "kept"),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_pages(k):
    assert htmltext.extract(PAGES[k][0], fitted(LABELLED)) == PAGES[k][1]


def test_unlabelled_pages_use_the_defaults():
    assert fitted(["<p>no region</p>"]) == htmltext.Weights()
    assert htmltext.extract(PAGES[2][0], htmltext.Weights()) == EXPECTED


def test_weights_have_their_signs():
    w = fitted(LABELLED)
    assert w.signs["in p"] > 0 > w.signs["el nav"] and w.linked >= 0 and all(v < 0 for v in w.tags.values()) and w.other < 0 and w.tags["nav"] < w.tags["p"]
    assert w.word(("in p",)) > 0 > w.word(("in p", "is sidebar")) and w.word(("in p", "el article", "is comments")) < 0


def plain_region(gain, cost):
    """The run of the highest sum by trying all; the tags before its first block cost nothing, as the region begins after them."""
    n = len(gain)
    return max([0.0] + [sum(gain[i:j]) + sum(cost[i + 1 : j]) for i in range(n) for j in range(i + 1, n + 1)])


def test_region_is_the_maximum_run():
    import random

    rng = random.Random(1)
    w = htmltext.Weights({"in p": 1.0, "in li": -2.5, "el nav": -4.0}, 0.0, {"p": -2.0, "x": -9.0}, -4.0)
    for _ in range(300):
        found = [htmltext.Block("t", (rng.choice(["in p", "in li"]), *rng.choices([(), ("el nav",)], [5, 1])[0]), False, n := rng.randint(1, 8), rng.randint(0, n), rng.choices(["p", "x", "q"], k=rng.randint(0, 2))) for _ in range(12)]
        lo, hi, each = htmltext.region(found, w)
        gain = [v * (b.words - b.linked) + min(v, w.linked) * b.linked for b, v in zip(found, each, strict=True)]
        cost = [sum(w.tags.get(t, w.other) for t in b.tags) for b in found]
        assert each == [w.word(b.signs) for b in found]
        assert sum(gain[lo:hi]) + sum(cost[lo + 1 : hi]) == pytest.approx(plain_region(gain, cost))


def test_the_scan_finds_the_text_where_markup_says_nothing(spark):
    """Pages of which half teach: the text of the others is that of their article, also if articles are renamed and classes are gone."""
    import re

    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    w, held = fitted(pages[::2]), pages[1::2]
    inner = lambda h: "\n".join(b.text for b in htmltext.blocks(h) if b.region and all(htmltext.prior(s) > htmltext.OUT for s in b.signs))
    bare = lambda h: re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(article|main)\b", r"<\1div", h))
    assert sum(htmltext.extract(h, w) == inner(h) for h in held) == len(held)
    assert sum(htmltext.extract(bare(h), w) == inner(h) for h in held) >= 0.98 * len(held)


def test_query(spark, rows, save):
    data = [(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES)] + [(0, "again", PAGES[0][0]), (99, None, f"<article><p>{'long words ' * 50_000}</p></article>")]
    found = htmltext.op9_html(spark, save(pages=rows(KIND, *data).withColumn("text", F.lit(1)))).collect()
    assert len(found) == len(data) and {r["page_id"]: r["text"] for r in found if r["page_id"] < 90} == {i: e for i, (_, e) in enumerate(PAGES)}
    assert all(r["n_chars"] == len(r["text"]) for r in found) and max(r["n_chars"] for r in found) == 549_999
    assert htmltext.op9_html(spark, save(pages=rows(KIND, *data).limit(0))).count() == 0


def test_short_blocks_and_several_articles_stay():
    w = htmltext.Weights({"in p": 1.0, "in h1": 1.0}, 0.1, {"p": -0.5, "article": -1.0, "main": -1.0, "h1": -0.5}, -1.0)
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    a, b = words("a", 60), words("b", 40)
    two = f"<body><nav>Home</nav><main><article><p>{a}</p></article><article><p>{b}</p></article></main></body>"
    assert htmltext.extract(two, w) == f"{a}\n{b}"
    lead = f"<body><main><h1>The title</h1><p>{words('l', 12)}</p><article><p>{a}</p></article></main><footer>end</footer></body>"
    assert htmltext.extract(lead, w) == f"The title\n{words('l', 12)}\n{a}"
    one = f"<body><div class=menu>x</div><article><p>short</p><p>{a}</p><p>end</p></article><div class=ad>x</div></body>"
    assert htmltext.extract(one, w) == f"short\n{a}\nend"
