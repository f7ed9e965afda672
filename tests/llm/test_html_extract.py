import pytest

from ledgerlake.llm.html_extract import Line, extract, extracted, ratios, smoothed, threshold

LONG = "A long paragraph of running text, which has many words and hardly any tags. " * 3


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<nav>menu</nav><p>a<p>b<br>c &lt;d&gt;&nbsp;e", "a\n\nb c <d> e"),
        ("<article><h1>T</h1><p>one<b> two</b>three</p><ul><li>x<li>y</ul></article>",
         "T\n\none twothree\n\nx\n\ny"),
        ("<header>Site</header><main><article><header><h1>T</h1></header><p>x<footer>tags"
         "</footer></article><aside>side</aside></main><div class='cookie-notice'>We use</div>",
         "T\n\nx"),
        ("<article><p>kept</p><div class='comments'><article><p>nice</p></article></div>"
         "<section id=comments><p>me too</section></article>", "kept"),
        ("<article><p>x <span class='search'>inline</span> <script>var t='</p>'</script>"
         "<style>p{}</style>y</p><form>Name <input><button>Go</button></form></article>",
         "x inline y"),
        ("<body class='has-sidebar home'><div class='wrap has-sidebar'><p>" + LONG
         + "</div><div class='sidebar'><p>s</div>", LONG.strip()),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <scr", "cut"),
        ("<div hidden><p>a</div><p style='display: none'>b<p>c", "c"),
    ],
)
def test_pages(html, text):
    assert extract(html or "") == text


def test_link_lists_and_short_paragraphs_without_semantic_tags():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(8)) + "</ul>"
    page = f"{menu}<div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div>{menu}</div>"
    assert extract(page) == f"{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"


L = LONG.strip()
M = "Another paragraph with text of its own, long enough to be read as a part of the article. " * 2
M = M.strip()
LINKS = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(9))
COMMENTS = "<p>I liked this very much and write about it at length, as readers do.</p>" * 30


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<body><h1>Title</h1><div><p>{L}</p></div></body>", f"Title\n\n{L}"),
        (f"<div><p>{L}</p></div><p>tail</p>", f"{L}\n\ntail"),
        (f"<div class='post-header'><h1>Title</h1></div><div class='post-body'><p>{L}</p></div>",
         f"Title\n\n{L}"),
        (f"<div class='site-header'><h1>My site</h1></div><div><h1>Title</h1><p>{L}</p></div>",
         f"Title\n\n{L}"),
        (f"<div class='site-header'><h1>My site</h1></div><div><p>{L}</p></div>", L),
        (f"<main><section><p>{L}</p></section><section><h2>References</h2>"
         "<p><a href=/x>A book with a long title</a></p></section></main>",
         f"{L}\n\nReferences\n\nA book with a long title"),
        (f"<article><p>{L}</p><div class='search-trees'><p>{M}</p></div></article>", f"{L}\n\n{M}"),
        (f"<article><p>{L}</p><div class='search-trees'><p>Short.</p></div></article>",
         f"{L}\n\nShort."),
        (f"<article><p>{L}</p><p class='related'>A remark.</p></article>", f"{L}\n\nA remark."),
        (f"<article><p>{L}</p><section id='social'><p>{M}</p></section></article>", f"{L}\n\n{M}"),
        (f"<article><p>{L}</p><div class='share-buttons'>Tweet this</div></article>", L),
        (f"<article><p>{L}</p><div class='related'><ul>{LINKS}</ul></div></article>", L),
        (f"<article><p>{L}</p><div class='newsletter-box'><p>{M}</p></div></article>", L),
        (f"<article><p>{L}</p><div class='article-comments'>{COMMENTS}</div></article>", L),
        (f"<article><p>{L}</p><ol><li class='comment'>{M}</ol></article>", L),
        (f"<div><p>{L}</p></div><div id='comments'>{COMMENTS}</div>", L),
        (f"<div class='content widget'><p>{L}</p></div>", L),
        (f"<div class='sidebar-layout'><div class='content'><p>{L}</p></div>"
         f"<div class='sidebar'><p>{M[:60]}</p></div></div>", L),
        (f"<div class='content widget'><p>{L}</p><div class='comments'>{COMMENTS}</div></div>", L),
        (f"<main><article><p>{L}</p></article><article><p>Second, short.</p></article></main>",
         f"{L}\n\nSecond, short."),
        (f"<div><p>{L}</p></div><div>Copyright 2024 A. Nybody</div>", L),
        (f"<div><p>{L}</p><p>&copy; 2024 A. Nybody. All rights reserved.</p></div>", L),
        (f"<article><p>{L}</p><p>Copyright law protects authors.</p></article>",
         f"{L}\n\nCopyright law protects authors."),
        (f"<table><tr><td><ul>{LINKS}</ul><td><p>{L}</p><p>{M}</p></table>", f"{L}\n\n{M}"),
        (f"<div role=navigation>{M}</div><div><p>{L}</p></div><div role=contentinfo>{M}</div>", L),
        (f"<ul>{LINKS}</ul><p>{L}</p><p>{M}</p>", f"{L}\n\n{M}"),
    ],
)
def test_layouts(html, text):
    assert extract(html) == text


def test_many_open_tags_take_linear_time():
    assert extract("<b>x " * 50_000).startswith("x x x")
    assert extract("<div>" * 20_000 + "deep") == "deep"
    assert extract("<p><b>x</i>" * 20_000).count("x") == 20_000


def test_smoothing_and_threshold():
    assert smoothed([5.0]) == [5.0]
    near = smoothed([0.0, 0.0, 10.0, 0.0, 0.0])
    assert near[2] > near[1] > near[0] > 0 and near[1] == pytest.approx(near[3])
    assert threshold([1.0, 2.0, 9.0, 10.0]) == pytest.approx(5.5)
    assert threshold([3.0, 3.0]) == 3.0
    assert ratios([("abcd", Line(0, tags=2)), ("ab", Line(0, linked=2))]) == [2.0, 0.0]


def test_table(spark):
    rows = [(1, "u", None, "x"), (2, None, "<p>é", "x"), (2, None, "<p>é", "x"),
            (None, "v", "<p>" + "word " * 50_000, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), str(r.url), len(r.text), r.n_chars) for r in extracted(frame).collect())
    assert got == [("1", "u", 0, 0), ("2", "None", 1, 1), ("2", "None", 1, 1),
                   ("None", "v", 249_999, 249_999)]
    assert extracted(frame.limit(0)).count() == 0


def paragraph(n, word):
    return (word + " ") * (n // (len(word) + 1)) + "end."


def test_every_part_of_an_article_stays():
    parts = [paragraph(n, f"part{i}") for i, n in enumerate([400, 350, 60, 420, 300, 25, 380])]
    whole = "\n\n".join(parts)
    for tag in ("section", "div"):
        apart = "".join(f"<{tag}><p>{p}</p></{tag}>" for p in parts)
        assert extract(apart) == whole
        assert extract(f"<main><p>{parts[0]}</p>{apart}</main>") == f"{parts[0]}\n\n{whole}"
    body = "".join(f"<p>{p}</p>" for p in parts)
    page = f"<div>{body}</div><article><p>{paragraph(300, 'teaser')}</p></article>"
    assert extract(page).startswith(whole)
