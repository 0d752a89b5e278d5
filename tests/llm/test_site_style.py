import math
import time
from collections import Counter, defaultdict

from rainledger.llm.site_style import Page, importance, main_text, removals, said_apart, unimportant, APART_WORDS

PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body class="menu-open"><nav><ul><li><a href="/">Home</a></ul></nav>
<header><h2>Site</h2></header><div class="ad">Buy</div><div class=cookie-notice>Cookies</div><script>var a="<p>x</p>";</script>
<div class="teaser">Same old teaser</div>
<article><header><h1>A &amp; B  {n}</h1></header><p>One<br>two <b>bold</b>{n}<p>Three &lt;4 a < b <!-- gone > --></p><ul><li>x{n}<li>y</ul><form>Name</form></article>
<section id="comments"><p>First!</p></section><aside>More</aside><footer>&copy; us {n}</footer></body></html>"""


def kept(page):
    return Page(page).kept(set())


def test_blocks():
    assert kept(PAGE.replace("{n}", "")) == ["Same old teaser", "A & B", "One two bold", "Three <4 a < b", "x", "y"]
    assert kept("") == [] and kept("plain &nbsp; text\n more") == ["plain text more"]
    assert kept("<p>a<div>b</div>c<script>never ends") == ["a", "b", "c"]
    assert kept("<article><p>a<p>b</article><!-- open") == ["a", "b"]
    assert kept('<div title="a > b">x</div>') == ["x"]
    assert kept("<" * 3000 + "p>x") and len(kept("<div>" * 5000 + "deep")) == 1


def test_style_tree_drops_what_each_page_has(spark):
    rows = [(i, f"https://H.example/{i}", PAGE.replace("{n}", str(i)), "clash") for i in range(20)]
    rows += [(100 + i, "https://h.example/copy", PAGE.replace("{n}", "same"), "") for i in range(200)]
    rows += [(500, "http://few.example/", PAGE.replace("{n}", "5"), ""), (None, None, None, None), (None, None, None, None), (7, "odd url", "<p>kept</p>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r for r in main_text(df).collect()}
    assert len(main_text(df).collect()) == len(rows)
    assert got[(3, "https://H.example/3")].text == "A & B 3\n\nOne two bold3\n\nThree <4 a < b\n\nx3\n\ny"
    assert got[(150, "https://h.example/copy")].text.startswith("A & B same")
    assert got[(500, "http://few.example/")].text.startswith("Same old teaser")  # of one page alone, nothing is known but names
    assert got[(None, None)].text == "" and got[(7, "odd url")].text == "kept"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert main_text(df.limit(0)).collect() == []


def test_importance_is_entropy(spark):
    pages = [("h", f"<div class=x>{i % 4}</div><div class=y>same</div><div class=z>{i}</div>") for i in range(16)]
    nodes = importance(spark.createDataFrame(pages, "host string, html string"))
    key = {x.name[i]: x.key[i] - (1 << 64) * (x.key[i] >> 63) for x in [Page(pages[0][1])] for i in range(len(x.name))}
    by = {r.path: r for r in nodes.collect()}
    assert abs(by[key["div.x"]].importance - 0.9 * 0.5) < 1e-9 and by[key["div.y"]].importance < 1e-9 and by[key["div.z"]].m == 16
    assert [(r.host, set(r.low)) for r in unimportant(nodes).collect()] == [("h", {key["div.x"], key["div.y"]})]
    assert [set(r.low) for r in unimportant(nodes, repeats=5).collect()] == [{key["div.y"]}]


def brute(pages, repeats=2.0):
    """Texts after a style tree kept as nested lists of whole paths, contents and layouts as strings, and names."""
    trees = defaultdict(set)
    for host, html in pages:
        x = Page(html)
        path = lambda i: () if i < 1 else (*path(x.parent[i]), x.name[i])  # noqa: B023, E731
        held = defaultdict(list)
        for node, text, _ in x.blocks:
            for k in range(1, len(path(node)) + 1):
                held[path(node)[:k]].append(text)
        row = {path(i): x.layout.get(i, []) for i in range(len(x.parent))}
        for p, texts in held.items():
            if not {n.split(".")[0] for n in p} & {"article", "main"}:
                trees[host, p].add((html, tuple(sorted(texts)), tuple(a for a, b in zip(row[p], ["", *row[p]]) if a != b)))
    low = set()
    for at, seen in trees.items():
        m = len(seen)
        if m > 1:
            entropy = lambda k: -sum(n / m * math.log(n / m, m) for n in Counter(s[k] for s in seen).values())  # noqa: B023, E731
            if 0.9 * entropy(1) + 0.1 * entropy(2) <= 0.9 * (1 - math.log(repeats, m)) + 1e-9:
                low.add(at)
    out = []
    for host, html in pages:
        x = Page(html)
        path = lambda i: () if i < 1 else (*path(x.parent[i]), x.name[i])  # noqa: B023, E731
        out.append("\n\n".join(t for n, t, apart in x.blocks if not apart and not any((host, path(n)[:k]) in low for k in range(1, len(path(n)) + 1))))
    return out


def test_against_a_brute_force_tree(spark):
    pages = []
    for i in range(60):
        side = "".join(f"<p>link {(i * 7 + k) % 9}</p>" for k in range(i % 3 + 1))
        body = f"<div class=head><span>Site {i % 2}</span></div><div class=post><h1>T{i}</h1><p>Body {i}</p>{'<div class=quote>Said</div>' if i % 5 else ''}</div><div class=side-links>{side}</div>"
        pages.append((f"h{i % 4}.example", body if i % 6 else f"<main><div class=head>Kept {i % 2}</div>{body}</main>"))
    pages += [("two.example", f"<div class=a>{k}</div><div class=b>both</div>") for k in "xy"] + [("one.example", "<div class=b>alone</div>")]
    df = spark.createDataFrame([(i, f"http://{h}/", x) for i, (h, x) in enumerate(pages)], "page_id int, url string, html string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert [got[i] for i in range(len(pages))] == brute(pages)
    assert got[len(pages) - 1] == "alone" and got[len(pages) - 3] == "x"
    shares = removals(df).first()
    assert shares.by_tree > 80 and shares.kept == sum(len(x.split("\n\n")) for x in brute(pages) if x)


def test_time_is_in_proportion_to_length():
    for page in ("<a " + "b=c " * 30_000, "<div " + "x='" * 40_001, "<div>" * 10_000 + "deep" + "</div>" * 10_000, "<p " * 40_000, "<div>" * 10_000 + "</x>" * 10_000, "<" * 100_000 + "p>x", "<script>" + "</script " * 20_000, "<center>" * 10_000 + "<p>a" * 10_000, '<p a="' * 20_001, "<!--" * 50_000, "<p " + "=" * 100_000 + ">x", "<div class='" + "a " * 50_000 + "'>x", "<ul>" + "<li>x" * 20_000, "&" * 100_000):
        began = time.time()
        x = Page(page)
        x.styles(), x.kept({1})
        assert time.time() - began < 2, page[:20]


def test_cut_off_and_odd_markup(spark):
    assert kept("<p>a</p><p>b</p><div class=") == ["a", "b"] and kept('<p>a<div title="never ends>b</div>') == ["a"]
    assert kept("<p>a<!-->b</p><p>c<!-- x --!>d</p>") == ["ab", "cd"] and kept("<!doctype html><?xml?><p>a</p></nothing>b") == ["a", "b"]
    assert kept("<div class=form-of-government>Kings</div><div class='related-posts'>More</div><p class=notice>Stays</p><div id=search-results-discussion>Talk</div><div class='x cookie-banner'>No</div>") == ["Kings", "Stays", "Talk"]
    assert said_apart("social-share", APART_WORDS) and not said_apart("antisocial widgetry", APART_WORDS)
    hosts = [(i, "http://deep.example/", "<div>" * 3000 + f"page {i}") for i in range(3)]
    assert {r.text for r in main_text(spark.createDataFrame(hosts, "page_id int, url string, html string")).collect()} == {"page 0", "page 1", "page 2"}


def test_copies_count_once_and_articles_stay_whole(spark):
    rows = [(i, f"http://blog.example/{i}", f"<div class=post>Post {i}</div><div class=line>On every page</div>") for i in range(100)]
    rows += [(200 + i, f"http://blog.example/{i}", "<div class=press>Release</div>") for i in range(10)]
    meal = "<article><h2>Ingredients</h2><p>Meal {}</p>{}</article>"
    rows += [(300 + i, f"http://meals.example/{i}", meal.format(i, "<blockquote>One quote</blockquote>" if i < 9 else "")) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert got[3] == "Post 3" and all(got[200 + i] == "Release" for i in range(10))
    assert got[304] == "Ingredients\n\nMeal 4\n\nOne quote" and got[320] == "Ingredients\n\nMeal 20"


def test_forms_around_pages_are_no_forms():
    nav, form = "<nav>Menu</nav>", "<form><label>Name</label><p>We never share it</p></form>"
    assert kept(f"<body><form id=aspnetForm>{nav}<div>Loose</div><article><h1>T</h1><p>Text</p>{form}</article></form></body>") == ["T", "Text"]
    assert kept(f"<form method=post>{nav}<div class=sidebar>x</div><div><h1>Title</h1><p>A long text of the page itself</p></div><input></form><p>Foot</p>") == ["Title", "A long text of the page itself", "Foot"]
    assert kept(f"<main><p>Text</p></main><form><p>{'Sign up for more of this. ' * 9}</p></form>") == ["Text"]
    assert kept(f"<p>The text of a page, longer than its form</p>{form}") == ["The text of a page, longer than its form"]
    assert kept("<p>Hi</p><form><label>A label that is much longer than the text</label></form>") == ["Hi"]
    assert kept("<aside><article><p>Teaser</p></article></aside><nav><main>no</main></nav><p>x</p>") == ["x"]


def test_articles_keep_formulas_examples_and_their_subjects():
    assert kept("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>") == ["Let x=2 be"]
    assert kept("<article><p>a</p><xmp><b>&amp; so</xmp><p>b</p></article>") == ["a", "<b>&amp; so", "b"]
    assert kept("<article><math><semantics><mi>y</mi><annotation>y^2</annotation></semantics></math></article>") == ["y"]
    assert kept('<article><p>a</p><div class="social">Social policy</div><div class="related">Related work</div></article>') == ["a", "Social policy", "Related work"]
    assert kept('<article><p>a</p><div class="social"><a href=x>Share</a></div><div class=related-posts><ul><li><a href=y>More</a></ul></div><div class="ad">Buy</div></article>') == ["a"]
    assert kept('<p>a</p><div class="social">Follow us</div>') == ["a"]


def test_names_of_comments_and_adverts():
    for name in ("user-comments", "wp-block-comments", "l-sidebar", "adsbygoogle", "cookie-law-info", "comments-area", "fb-comments"):
        assert kept(f"<p>a</p><div class='{name}'><p>b</p></div>") == ["a"], name
    for name in ("comment-is-free", "advice", "user-guide", "wp-block-group", "sidebar-story"):
        assert kept(f"<p>a</p><div class='{name}'><p>b</p></div>") == ["a", "b"], name
