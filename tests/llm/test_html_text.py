from riskgrid.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site name</a><p>A slogan of this site</p></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies to make this better, please accept them all.</div>
<div id="main-content">%s</div><aside><h2>More</h2><p>Another story that you may like to read some day.</p></aside>
<div class="sidebar"><p>Popular stories of this week are listed here.</p></div>
<section id="comments"><p>First! This is a reader who writes a long comment about the article.</p></section>
<form><label>Mail</label><input><button>Subscribe</button></form><footer><p>&copy; 2024 Site. All rights reserved.</p></footer></body></html>"""
ARTICLE = "<article><h1>Head&amp;line  of\nit</h1><p>First <b>bold</b>, <a href=x>linked</a> text.<p>Second&nbsp;one&#33;<br>after a break<div class=ad>Buy now</div><ul><li>item a<li>item b</ul><table><tr><td>c1<td>c2</table><blockquote>Quoted.</blockquote><!-- no --><p>Z.</article>"
WANT = "Head&line of it First bold, linked text. Second one! after a break item a item b c1 c2 Quoted. Z."


def test_article_of_a_full_page():
    assert h.main_text(PAGE % ARTICLE) == WANT


def test_same_without_landmark():
    body = "".join(f"<p>Paragraph {k} with a number of words that make it a text, as articles have.</p>" for k in range(6))
    got = h.main_text(PAGE % ("<h1>Head line</h1>" + body))
    assert got == "Head line " + " ".join(f"Paragraph {k} with a number of words that make it a text, as articles have." for k in range(6))


def test_broken_markup():
    assert h.main_text("<body><article><h1>H</h1><p><b>one<br><p>two</b></p></i><p>three</article><footer>f</footer>") == "H one two three"
    assert h.main_text("plain text only") == "plain text only"
    assert h.main_text("<p>unclosed <b>tags") == "unclosed tags"
    assert h.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_densities_against_recursion():
    builder = h.TreeBuilder()
    builder.feed(PAGE % ARTICLE)
    builder.close()
    nodes = h.measured(builder.root)

    def count(n):
        kids = [x for x in n.items if isinstance(x, h.Node) and not x.dropped]
        chars = sum(len(x) - x.count(" ") for x in n.items if isinstance(x, str)) + sum(count(x)[0] for x in kids)
        return chars, sum(1 + count(x)[1] for x in kids)

    for n in nodes:
        assert (n.chars, n.tags) == count(n)
        assert abs(n.total - sum(x.density for x in n.items if isinstance(x, h.Node) and not x.dropped)) < 1e-9


def test_rows(spark):
    rows = [(1, "u1", PAGE % ARTICLE), (1, "u1", PAGE % ARTICLE), (2, None, None), (None, "u3", ""), (4, "u4", "<script>x</script>"), (5, "u5", "<article>" + "<p>word and word.</p>" * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as text", "'clash' as n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in h.extract(df).collect()), key=repr)
    long = " ".join(["word and word."] * 20000)
    want = [(1, "u1", WANT, len(WANT))] * 2 + [(2, None, "", 0), (None, "u3", "", 0), (4, "u4", "", 0), (5, "u5", long, len(long))]
    assert got == sorted(want, key=repr)
    assert h.extract(df.where("false")).count() == 0


def paragraphs(name, count=6):
    return [f"{name} {k} tells at some length, with a number of words, what happened there on that day." for k in range(count)]


def marked(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_teaser_cards_beside_a_div_article():
    body = paragraphs("Paragraph")
    card = '<article class=card><h3><a href=/x>A teaser</a></h3><p>Short words.</p></article>'
    want = " ".join(["Head line", *body])
    for page in ("<body><div id=content><h1>Head line</h1>%s</div>%s</body>", "<body><div><div id=content><h1>Head line</h1>%s</div></div><div>%s</div></body>"):
        assert h.main_text(page % (marked(body), card)) == want
        assert h.main_text(page % (marked(body), card * 3)) == want


def test_text_split_over_sibling_articles():
    parts = [paragraphs(name) for name in ("First", "Second", "Third")]
    want = " ".join(t for part in parts for t in part)
    for top in ("<body>%s</body>", "<body><div>%s</div><footer>f</footer></body>", "<body><p>Short.</p>%s</body>"):
        assert h.main_text(top % "".join(f"<article>{marked(p)}</article>" for p in parts)) == want
        assert h.main_text(top % "".join(f"<div><article>{marked(p)}</article></div>" for p in parts)) == want
    one = [p[0] for p in parts]
    assert h.main_text("<body>" + "".join(f"<article>{marked([t])}</article>" for t in one) + "<div>More</div></body>") == " ".join(one)
    assert h.main_text("<body><main>" + "".join(f"<article>{marked([t])}</article>" for t in one) + "</main><div>More</div></body>") == " ".join(one)


def test_names_with_a_boilerplate_word_do_not_drop_the_article():
    body = paragraphs("Paragraph")
    want = " ".join(body)
    beside = "<div class=sidebar><p>Popular stories of this week.</p></div><div class='share-bar'>Share this</div>"
    for start, end in (
        ("<article class='post comments-open'>", "</article>"),
        ("<main class='has-sidebar'>", "</main>"),
        ("<article class='ad'>", "</article>"),
        ("<div id='page' class='no-sidebar'>", "</div>"),
        ("<div class='story social-ready'>", "</div>"),
        ("<div class='layout--with-sidebar'><div class='hasMenu'>", "</div></div>"),
        ("<div class='widget'><section class='overlay'>", "</section></div>"),
        ("<main class='search'><div class='promo'>", "</div></main>"),
    ):
        for page in ("<body>%s</body>", "<body><nav>Home</nav>%s" + beside + "</body>", "<body><div class='alert'>Read on</div><div><h2 class=title></h2>%s</div></body>"):
            assert h.main_text(page % (start + marked(body) + end)) == want
    # What is dropped within stays dropped.
    assert h.main_text("<body><div class='widget'>" + marked(body) + beside + "</div></body>") == want


def test_long_comments_beside_an_article_go():
    body, comments = paragraphs("Paragraph"), paragraphs("Comment", 30)
    for start, end in (("<article>", "</article>"), ("<div id=content>", "</div>")):
        page = f"<body><div class='no-sidebar'>{start}{marked(body)}{end}<section id=comments>{marked(comments)}</section></div></body>"
        assert h.main_text(page) == " ".join(body)


def test_page_of_dropped_parts_alone():
    assert h.main_text("<body><div class=alert><p>One</p></div><div class=notice><p>Two</p></div><nav>Home</nav></body>") == "One Two"
    assert h.main_text("<body><div class=alert> </div><nav>Home</nav><div hidden>x</div></body>") == ""
    assert h.main_text("<div class=ad>" * 3000 + "deep" + "</div>" * 3000) == "deep"
