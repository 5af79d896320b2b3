import random

from chorale.llm import html_text
from chorale.llm.page_labels import PAGES
from tests.llm import odd


def test_labelled_pages_come_out_as_labelled():
    for page in PAGES:
        marked = page.split("<!--[-->")[1].split("<!--]-->")[0]
        alone = html_text.main_text(f"<html><body><article>{marked}</article></body></html>")
        assert html_text.main_text(page) == alone != ""


def test_furniture_goes_and_content_stays():
    text = "A sentence with quite enough words to be content, number {}."
    body = "".join(f"<p>{text.format(k)}</p>" for k in range(4))
    furniture = [
        '<div class="cookie-notice"><p>We use cookies to make this site better for all.</p></div>',
        '<form action="/s"><label>Search here for what you want</label><input name="q"></form>',
        '<div id="comments"><h3>Comments</h3><p>What a great article this is, thank you so much.</p></div>',
        '<aside><p>More stories that you may like to read today.</p></aside>',
        '<script>if (a < b) { document.write("<p>not content at all</p>") }</script>',
        '<style>p > a { color: red }</style>',
        '<div class="ad-slot">Buy this thing now, it is cheap and good.</div>',
        '<div style="display:none">Text that no reader can see on the page.</div>',
        "<!-- a remark <p>in a comment</p> -->",
        '<nav><a href="/a">One</a><a href="/b">Two</a></nav>',
    ]
    expected = "\n\n".join(["Title here", *(text.format(k) for k in range(4))])
    for shell in ("<article>{}</article>", "<main>{}</main>", "<div>{}</div>"):
        for n, piece in enumerate(furniture):
            for inner in (f"<h1>Title here</h1>{body}{piece}", f"<h1>Title here</h1>{piece}{body}"):
                page = f"<html><body>{shell.format(inner)}<footer>All rights reserved.</footer></body></html>"
                assert html_text.main_text(page) == expected, (shell, n)


def test_no_content_goes_for_a_word_in_its_attributes():
    text = "A sentence with quite enough words to be content, number {}."
    body = "".join(f"<p>{text.format(k)}</p>" for k in range(4))
    expected = "\n\n".join(text.format(k) for k in range(4))
    for tag in (
        'h2 id="search-trees"', 'section id="related-work"', 'h2 id="login-flow"', 'section id="comments"',
        'div class="section" id="search-trees"', 'p title="a hidden gem"', 'div data-id="menu"',
        'section data-role="banner"', 'p id="notice-period"', 'h3 id="search"', 'div class="has-sidebar"',
    ):
        name = tag.split()[0]
        inner = f"{body}<{tag}>Words in here stay in the text.</{name}>{body}"
        whole = f"{expected}\n\nWords in here stay in the text.\n\n{expected}"
        assert html_text.main_text(f"<body><article>{inner}</article></body>") == whole, tag
    for tag in (
        'div class="content-sidebar-wrap"', 'div class="page has-sidebar"', 'div class="sidebar"', "form",
        'div id="search"', "aside", "div hidden", 'div class="widget"',
    ):
        name = tag.split()[0]
        for shell in ("article", "main"):
            page = f"<body><{tag}><{shell}>{body}</{shell}></{name}><footer>All rights reserved.</footer></body>"
            assert html_text.main_text(page) == expected, (tag, shell)
    for wrap in ("content-sidebar-wrap", "page has-sidebar"):
        assert html_text.main_text(f'<body><div class="{wrap}">{body}</div></body>') == expected
    comment = "<p>What a great article this is, thank you so much.</p>"
    for piece in (
        f'<div id="comments"><ol><li><article class="comment-body">{comment}</article></li></ol></div>',
        f"<aside><article>{comment}</article></aside>",
        f"<nav>{comment}",
    ):
        assert html_text.main_text(f"<body><article>{body}</article>{piece}</body>") == expected, piece


def test_nothing_is_lost_for_drawings_labels_and_names_that_begin_like_a_kind():
    text = "A sentence with quite enough words to be content, number {}."
    body = "".join(f"<p>{text.format(k)}</p>" for k in range(4))
    expected = "\n\n".join(text.format(k) for k in range(4))
    for piece, said in {
        '<p>Icon <svg class="i"/> after the icon.</p>': "Icon after the icon.",
        "<p>Sum <math/> of all.</p>": "Sum of all.",
        "<p>Icon <svg class='i'><title>no</title></svg> after it.</p>": "Icon after it.",
        "<p>Icon <svg class='i'> never closed.</p>": "Icon never closed.",
        '<script src="a.js"/><p>After the script.</p>': "After the script.",
        "<script src='a.js'/>no()</script><p>After the script.</p>": "After the script.",
        '<p class="notice-period">Three months are usual.</p>': "Three months are usual.",
        '<div class="share-price">Shares rose by a tenth.</div>': "Shares rose by a tenth.",
        "<p>It reads <label>this here</label> as said.</p>": "It reads this here as said.",
    }.items():
        page = f"<body><article>{body}{piece}{body}</article></body>"
        assert html_text.main_text(page) == f"{expected}\n\n{said}\n\n{expected}", piece
    page = f'<body><div class="search-results-analysis">{body}</div><footer>All rights reserved.</footer></body>'
    assert html_text.main_text(page) == expected
    for name in ("ad-slot", "cookie-notice", "nav-left", "share-buttons", "newsletter-signup-form", "comment-list"):
        page = f'<body><article>{body}<div class="{name}">Words that are not content here.</div></article></body>'
        assert html_text.main_text(page) == expected, name


def test_references_white_space_and_broken_markup():
    page = "<article><p>Fish &amp; chips &lt;b&gt;\n\t caf&eacute;&nbsp;x</p><p>un<b>brok</b>en<br>line <i>open<p>next &copy"
    assert html_text.main_text(page) == "Fish & chips <b> café x\n\nunbroken line open\n\nnext ©"
    assert html_text.main_text("<article><p>The end is cut off here</p><a href=") == "The end is cut off here"
    assert html_text.main_text("just text, no markup") == "just text, no markup"
    assert html_text.main_text("1 < 2") == "1 < 2"
    for empty in (None, "", "<html></html>", "<nav><a>x</a></nav>", "<a", "<!--"):
        assert html_text.main_text(empty) == ""


def test_best_region_equals_all_regions():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.uniform(-1, 1) for _ in range(rng.randrange(1, 12))]
        a, b = html_text.best_region(scores)
        best = max(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
        assert abs(sum(scores[a:b]) - max(best, 0)) < 1e-9


def test_weights_have_their_signs():
    weights = html_text.weights()
    assert weights["in/text"] > 0 and weights["none/text"] > 0
    assert all(w < 0 for k, w in weights.items() if "/" not in k[1:])


def test_table_of_pages(spark):
    long = "<article>" + "".join(f"<p>Paragraph {k} of a long page.</p>" for k in range(20_000)) + "</article>"
    deep = "<div>" * 20_000 + "words deep inside" + "<b>" * 20_000
    rows = [(1, "u", None), (2, None, ""), (3, "u", long), (3, "u", long), (None, None, deep)]
    pages = odd.clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = html_text.extracted(pages).collect()
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    by_id = {r.page_id: r for r in found}
    assert by_id[3].text.count("\n\n") == 19_999 and by_id[1].text == ""
    assert by_id[None].text == "words deep inside"
    assert html_text.extracted(pages.limit(0)).collect() == []
