import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import pages

LONG = "Rivers carry sand and silt to the plains, where they settle in wide bends over many years. " * 3

LAYOUT = f"""<!DOCTYPE html><HTML><head><title>Nav | Site</title><script>if (a < b) document.write("<p>no</p>")</script></head>
<body class="has-sidebar"><header><h1>Site name</h1><p>{LONG}</p></header>
<div id="top-menu"><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></div>
<div class="cookie-notice">We use cookies. {LONG}</div>
<div class=content>
<h2>Sand &amp; silt&nbsp;&mdash; an &quot;essay&quot;</h2>
<p>{LONG}<p>Second   paragraph,
 with a <a href="/x">link</a> and <em>stress</em>.{LONG}
<blockquote>Quoted {LONG}</blockquote>
<ul><li>first {LONG}</li><li>second {LONG}</ul>
<form><input name=q><button>Go</button></form>
<aside>{LONG}</aside>
<p>Last &#233; &#x41; line<br>continues. {LONG}</p>
</div>
<section id="comments"><p>Reader: {LONG}</p></section>
<footer>&copy; {LONG}</footer></body></html>"""


def flat(text):
    return " ".join(text.split())


def test_layout_without_article_element():
    assert pages.main_text(LAYOUT).split("\n") == [
        'Sand & silt — an "essay"',
        flat(LONG),
        flat("Second paragraph, with a link and stress." + LONG),
        flat("Quoted " + LONG),
        flat("first " + LONG),
        flat("second " + LONG),
        flat("Last é A line continues. " + LONG),
    ]


def test_short_article_beside_long_surroundings():
    page = f"<body><nav><a href=1>{LONG}</a></nav><main><h1>Title</h1><p>Short.</p></main><div class=ad>{LONG}</div></body>"
    assert pages.main_text(page) == "Title\nShort."


def test_unclosed_surroundings_do_not_swallow_the_article():
    page = f"<body><nav><ul><li><a href=1>x</a><article><p><b>Bold <p>{LONG}</article><footer>end"
    assert pages.main_text(page) == "Bold\n" + flat(LONG)
    commented = f"<main><p>{LONG}</p><section class='reader-comments'><article><p>Well, {LONG}</article></section></main>"
    assert pages.main_text(commented) == flat(LONG)
    assert pages.main_text(f"<article><div class='ad'><p>buy<p>now</div><p>{LONG}</article>") == flat(LONG)


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_labels_that_name_parts_of_an_article(holder):
    parts = [
        f'<section id="related-work"><p>One {LONG}</p></section>', f'<h2 id="market-share"><a href="#market-share">Market share</a></h2><p>{LONG}</p>',
        f'<p class="notice">Two {LONG}</p>', f'<section id="ad-hoc-networks"><p>Three {LONG}</p></section>',
        f'<div id="social-history"><p>Four {LONG}</p></div>', f'<div data-id="ad" title="id=ad"><p>Five {LONG}</p></div>',
    ]
    around = f'<div class="share"><a href=1>Mail</a></div><div class="share-box"><a href=1>Post</a></div><div class="ad">{LONG}</div>'
    text = pages.main_text(f"<body><{holder}>{''.join(parts)}{around}</{holder}></body>")
    starts = ["One", "Market share", "Rivers", "Two", "Three", "Four", "Five"]
    assert [line[: len(s)] for line, s in zip(text.split("\n"), starts, strict=True)] == starts


def test_sibling_articles_that_reach_the_threshold():
    teaser = "<article><a href=1>" + "Read on. " * 5 + "</a></article>"
    page = f"<body><article><p>First {LONG}<p>{LONG}</article><article><p>Second {LONG}</article>{teaser}<nav><a href=1>x</a></nav></body>"
    assert pages.main_text(page).split("\n") == [flat("First " + LONG), flat(LONG), flat("Second " + LONG)]


@pytest.mark.parametrize(
    "page", ["", "plain words", "<", "<p", "<!-- open", "<p>a", "</p></div>", "<a href='x>y", "<script>", "a<br>b", "<p>" * 3000]
)
def test_broken_pages_do_not_fail(page):
    pages.main_text(page)


def test_plain_text_and_empty_pages():
    assert pages.main_text("plain  words") == "plain words"
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<body></body>") == ""


def test_random_markup_never_fails():
    rng = random.Random(1)
    bits = ["<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<nav>", "</nav>", "<a href=x>", "</a>", "<li>", "text ",
            "&amp;", "<br/>", "<script>", "</script>", "<table><tr><td>", "</table>", "<!--", "-->", "<div class='ad'>", '"', ">"]
    for _ in range(500):
        pages.main_text("".join(rng.choices(bits, k=rng.randint(1, 60))))


def test_very_deep_and_long_pages():
    assert pages.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(pages.main_text("<article><p>" + "word " * 400_000)) == 1_999_999


def test_table_with_nulls_copies_and_clashing_names(spark):
    rows = [(1, "u", LAYOUT), (1, "u", LAYOUT), (2, None, None), (None, "v", ""), (3, "w", "<p>é</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("x", F.lit(1))
    out = pages.extract(frame)
    assert out.columns == ["page_id", "url", "html", "text", "x", "n_chars"]
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in out.collect()]
    want = [(p, u, pages.main_text(h), len(pages.main_text(h))) for p, u, h in rows]
    assert got == want
    assert pages.extract(frame.limit(0)).collect() == []


def test_a_form_around_the_page_is_no_form():
    long = "A paragraph of an article with quite a few words in it. " * 8
    for inner in (f"<p>{long}</p><p>{long}</p>", f"<article><p>{long}</p><p>{long}</p></article>"):
        page = f'<body><form id="aspnetForm"><input><label>Name</label><select><option>x</select>{inner}<button>Go</button></form></body>'
        assert pages.main_text(page) == f"{long.strip()}\n{long.strip()}"
    page = f"<body><article><p>{long}</p><form><p>Sign up for letters</p><input></form><p>{long}</p></article></body>"
    assert pages.main_text(page) == f"{long.strip()}\n{long.strip()}"


def test_what_stands_in_a_line_does_not_cut_it():
    long = "Words of the article and more of them. " * 8
    line = (
        "Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> as <svg><text>icon</text></svg>known "
        "<button>Buy</button>to <select><option>x</option></select>all <span class='ad'>buy</span>of us."
    )
    page = f"<body><article><p>{long}</p><p>{line}</p><nav>menu</nav>After it.</article></body>"
    assert pages.main_text(page) == f"{long.strip()}\nEnergy is E=m as known to all of us.\nAfter it."


def plain_densities(tree):
    """Each element's numbers from its own subtree, element by element."""
    import math

    n = len(tree.tag)
    below = [[j for j in range(n) if i in ancestors(tree, j)] for i in range(n)]

    def numbers(i):
        alive = [j for j in below[i] if not tree.gone[j]]
        return sum(tree.chars[j] for j in alive), sum(tree.linked[j] for j in alive), len(alive), sum(tree.tag[j] == "a" for j in alive)

    page, page_links = numbers(0)[:2]
    out = []
    for i in range(n):
        c, lc, t, lt = numbers(i)
        value = c / max(t, 1)
        if c and page_links:
            ratio = max(c / max(lc, 1) * t / max(lt, 1), 1)
            base = math.log(c / max(c - lc, 1) * lc + page_links / page * c + math.e)
            value *= math.log(ratio) / max(math.log(base), 1e-9)
        out.append(value)
    return out, [sum(out[j] for j in range(1, n) if tree.parent[j] == i) for i in range(n)]


def ancestors(tree, i):
    out = [i]
    while tree.parent[out[-1]] >= 0:
        out.append(tree.parent[out[-1]])
    return out


def plain_roots(tree):
    density, sums = plain_densities(tree)
    n = len(tree.tag)
    core = min(range(n), key=lambda i: (-sums[i], i))
    threshold = min(density[i] for i in ancestors(tree, core))
    roots = {core}
    for i in range(1, n):
        if density[i] >= threshold and density[i] > 0:
            inside = [j for j in range(n) if i in ancestors(tree, j)]
            roots.add(min(inside, key=lambda j: (-sums[j], j)))
    return roots


def test_densities_and_roots_on_random_trees():
    import random

    rng = random.Random(4)

    def grow(depth):
        out = ""
        for _ in range(rng.randint(1, 3)):
            tag = rng.choice(["div", "section", "p", "a", "ul", "span"])
            inner = "word " * rng.randint(0, 9) + (grow(depth - 1) if depth and tag not in ("p", "a", "span") else "")
            out += f"<{tag}>{inner}</{tag}>"
        return out

    for _ in range(150):
        tree = pages.Tree(f"<body>{grow(3)}</body>")
        mine, plain = pages.densities(tree), plain_densities(tree)
        assert all(abs(a - b) < 1e-9 for x, y in zip(mine, plain) for a, b in zip(x, y))

        def covered(roots):
            return {i for i in range(len(tree.tag)) if roots & set(ancestors(tree, i)) and tree.chars[i]}

        assert covered(pages.content_roots(tree)) == covered(plain_roots(tree))
