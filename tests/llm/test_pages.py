"""Main text and archives."""

import hashlib
import itertools
import random
import re

import pytest

from mdcatalog.llm import html_text, warc
from tests.llm.helpers import SF, values

PROSE = "One sentence of the story, and another one that follows it. " * 3


def test_declared_article_keeps_short_blocks_and_drops_the_rest():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav>
    <div class="cookie-notice">We use cookies.</div><div class="ad">Buy!</div><article><h1>Head&amp;line</h1><p>{PROSE}<br>next   line<p>Ti.</p>
    <aside>Aside</aside><form><label>Mail</label><input></form><section class="comments"><p>First!</p></section><p>Last &lt;b&gt; &eacute;</p></article>
    <div id="sidebar"><p>{PROSE}</p></div><footer>&copy;</footer>"""
    assert html_text.main_text(page).split("\n") == ["Head&line", f"{PROSE.strip()} next line", "Ti.", "Last <b> é"]


def test_without_article_the_surge_is_found():
    page = f"<body><ul><li><a href=a>A</a><li><a href=b>B</a></ul><div>{PROSE}</div><div>{PROSE}</div><p>So.</p><div><a>x</a></div><div><a>y</a></div><div><a>z</a></div><div>tiny</div>"
    assert html_text.main_text(page).split("\n")[:3] == [PROSE.strip(), PROSE.strip(), "So."]


def test_without_article_short_texts_are_kept():
    assert html_text.main_text("<body><ul><li><a href=a>Home</a> | <a href=b>About us</a></ul><p>Closed today.</p></body>") == "Closed today."
    links = "".join(f"<div><a href={i}>An offer</a></div>" for i in range(3))
    page = f"<body>{f'<p>{PROSE}</p>' * 30}{links}<div class=ad>Buy!</div><p>{PROSE}</p><p>The end.</p>{links}</body>"
    assert html_text.main_text(page).split("\n") == [PROSE.strip()] * 31 + ["The end."]


def by_definition(weight):
    """Lines of texts, from the definition of surge and dive alone."""
    n, window = len(weight), html_text.WINDOW
    total = lambda i: sum(weight[i + j] for j in range(window) if i + j < n)
    kept, inside = [], False
    for i in range(n):
        if inside and total(i) < html_text.SURGE:
            inside = False
        if not inside and total(i) >= html_text.SURGE and weight[i]:
            inside = weight[i] >= html_text.HEADING or i + 1 < n and weight[i + 1] >= html_text.HEADING
        if inside and weight[i]:
            kept.append(i)
    if not kept:
        runs = [list(g) for k, g in itertools.groupby(range(n), lambda i: bool(weight[i])) if k]
        kept = max(runs, key=lambda r: (sum(weight[i] for i in r), -r[0]), default=[])
    return kept


def made_up(seed):
    """(page without a declared article, its text): furniture with and without marks around sentences, headings, lists and tables."""
    rng = random.Random(seed)
    sentence = lambda: " ".join(rng.choice(["river", "stone", "the", "a", "quiet", "house", "went", "over"]) for _ in range(rng.randint(4, 30))).capitalize() + "."
    before = ['<div>Home | About | Contact | Help</div>', '<ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul>', '<nav>Menu of the site.</nav>',
              '<div class="cookie-notice">We use cookies.</div>', '<p>This site uses cookies. Please accept our policy.</p>', '<div id="top-menu"><p>Long menu text that is no menu.</p></div>',
              '<header><p>The site of all sites.</p></header>', '<div class="ad">Buy this now. It is cheap.</div>', '<form><label>Search for it.</label></form>']
    after = ['<div>Copyright 2020 Somebody Ltd. All rights reserved.</div>', '<p>© 2021 Somebody.</p>', '<footer><p>The end of the site.</p></footer>', '<div>Imprint | Privacy | Jobs</div>',
             '<div class="related-posts"><p>Another story that you might like.</p></div>', '<p><a href="x">Next story</a> | <a href="y">Last story</a></p>', '<div>Sign up for our newsletter.</div>']
    comments = ['<h3>3 comments</h3><p>Great story, I like it very much.</p><div><p>So do I, in all its parts.</p></div>', '<div class="comments"><p>First! And a sentence.</p></div>', '']
    blocks = [f"<h1>{sentence()[:-1]}</h1>"] if rng.random() < .6 else [f"<p>{sentence()}</p>"]
    for _ in range(rng.randint(1, 12)):
        blocks.append(rng.choice([f"<p>{sentence()} {sentence()}</p>", f"<div>{sentence()}</div>", f"<h2 id='related-work'>{sentence()[:20]}</h2><p>{sentence()}</p>",
                                  f"<ul><li>{sentence()[:12]}</li><li>{sentence()}</li></ul>", f"<blockquote>{sentence()}</blockquote>", "<p>Short one</p>"]))
    text = [re.sub("<[^>]*>", "", x).strip() for b in blocks for x in re.findall(r"<(?:p|div|h1|h2|li|blockquote)[^>]*>[^<]*<", b)]
    text = [x.rstrip("<").strip() for x in text]
    inner = list(blocks)
    for _ in range(rng.randint(0, 3)):  # adverts between blocks
        inner.insert(rng.randint(1, len(inner)), '<div class="ad">Buy it. Now.</div>')
    page = "".join(rng.sample(before, rng.randint(0, 4))) + "".join(inner) + "".join(rng.sample(after, rng.randint(0, 2))) + rng.choice(comments) + "".join(rng.sample(after, 1))
    return f"<html><head><title>T</title></head><body>{page}</body></html>", "\n".join(text)


@pytest.mark.parametrize("block", range(4))
def test_made_up_pages_without_a_declared_article(block):
    for seed in range(50 * block, 50 * block + 50):
        page, text = made_up(seed)
        assert html_text.main_text(page) == text, seed
        weight = html_text.weights([x for x in html_text.lines(page) if not x.out])
        assert [k for a, b in html_text.texts(weight) for k in range(a, b) if weight[k]] == by_definition(weight)


def test_pages_of_the_test_table_by_definition(spark):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        for page in (row["html"], re.sub("</?article>", "", row["html"])):
            rows = [x for x in html_text.lines(page) if not x.out]
            kept = by_definition(html_text.weights(rows))
            assert html_text.main_text(page) == "\n".join(rows[i].text for i in kept)
        assert html_text.main_text(row["html"]) == "\n".join(x.text for x in html_text.lines(row["html"]) if x.article and not x.out)


def test_blocks_of_an_article_stay():
    page = """<article><h2 id="related-work">Related work</h2><section id="search-trees"><p>a</p></section><section id="share-prices">b</section>
    <section id="notice-periods" class="notice"><p>c</p></section><div class="alert alert-info">d</div><div class="toc">e</div><p class="search">f</p>
    <div class="ad">x</div><div class="share-buttons">x</div><div class="comment-list">x</div></article><p>Outside of it.</p>"""
    assert html_text.main_text(page).split("\n") == ["Related work", "a", "b", "c", "d", "e", "f"]


def test_without_surge_the_heaviest_stretch_stays():
    assert html_text.main_text("<body><div>Just this</div></body>") == "Just this"
    assert html_text.main_text("<body><nav>Menu.</nav><div>a</div><div><a href=x>x</a></div><div>b</div><div>c</div></body>") == "b\nc"


def test_odd_markup():
    for page in ("", "<", "<<>", "<p", "</p>", "<script>", "<!--", "&", "&#xZZ;", "<a b='>", "<article>" * 50_000, "<p>" * 50_000):
        html_text.main_text(page)
    assert html_text.main_text("<article>a <a title='x>y'>b</a> \n c</article>") == "a b c"
    assert html_text.main_text("<article class='post no-sidebar'><p>kept</p></article><article class='comment'>no</article>") == "kept"


PAGES = "page_id bigint, url string, html string, payload_digest string, first int, text string"


def test_extract_rows(spark):
    rows = [(1, "u", None, "x", 1, "y"), (None, None, "", "x", 1, "y"), (2, "v", "<article>é</article>", "x", 1, "y")]
    assert values(html_text.extract_main_text(spark.createDataFrame(rows, PAGES))) == sorted([(1, "u", "", 0), (None, None, "", 0), (2, "v", "é", 1)], key=repr)
    assert html_text.extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    long, other = "ü" * 60, "y" * 200_000
    rows = [(5, "http://a/ b\r\nx", long), (3, None, long), (3, "z", long), (None, "n", long), (7, "u", "short"), (8, "u", "short"), (9, "u", None), (1, "u", other)]
    pages = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES)
    manifest = warc.write_archives(pages, str(tmp_path / "w"))
    back = values(warc.read_archives(manifest).drop("url"))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(5, 120, digest(long), "revisit", 3, None), (3, 120, digest(long), "response", None, long), (3, 120, digest(long), "response", None, long),
                (None, 120, digest(long), "revisit", 3, None), (7, 5, digest("short"), "response", None, "short"), (8, 5, digest("short"), "response", None, "short"),
                (9, 0, digest(""), "response", None, ""), (1, 200_000, digest(other), "response", None, other)]
    assert back == sorted(expected, key=repr)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_archive_begins_with_its_dictionary(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").coalesce(1)
    pages = pages.unionByName(pages.withColumn("page_id", pages.page_id + 1000)).coalesce(1)
    manifest = warc.write_archives(pages, str(tmp_path / "w")).collect()
    with open(manifest[0]["archive"].removeprefix("file://"), "rb") as file:
        assert int.from_bytes(file.read(4), "little") == warc.DICTIONARY_MAGIC
    assert sum(r["records"] for r in manifest) == pages.count() and manifest[0]["stored_bytes"] < manifest[0]["raw_bytes"] / 2
