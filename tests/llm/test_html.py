"""Main text of pages: parsing, roles and templates."""

import pytest

from accesslake.llm import html


@pytest.mark.parametrize("source, text", [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<html><body><nav>menu</nav><article><h1>T &lt;x&gt;</h1><p>a\n  b<p><b>c</b>d<br>e</article><footer>f</footer>", "T <x>\n\na b\n\ncd e"),
    ("<article><p>a</p><!-- <p>x</p> --><script>var t='</p>';</script><style>p{}</style><div class='ad'>buy</div><p>b</p></article>", "a\n\nb"),
    ("<body><div class=\"cookie-notice\">ok?</div><div id=content><p>text</p></div><div class='comments'><article>me too</article></div></body>", "text"),
    ("<main><header><h1>Head</h1></header><p>x&nbsp;y&#8211;z</p><aside>s</aside><form>f<input></form></main>after", "Head\n\nx y–z"),
    ("<header>site</header><p>one<p>two</p></div></p>three", "one\n\ntwo\n\nthree"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\n\nb\n\n1\n\n2"),
    ("<p title='a>b'>x</p><p hidden>no</p>1 < 2 & 3 &am", "x\n\n1 < 2 & 3 &am"),
    ("<article><p>kept", "kept"),
    ("<div class='sidebar-page'><article>in<div class=related>out</div></article></div>", "in"),
])
def test_main_text(source, text):
    assert html.main_text(source) == text


def page(k, host="h.example.com", wrap="<div class='body'><div class='col'>{}</div></div>"):
    text = f"<p>Story {k} tells of thing {k * 7} at length, and goes on.</p><p>It ends in {k}.</p><p>Read us daily.</p>"
    return k, f"https://{host}/{k}", f"<html><body><ul><li><a href=x>home page of the site and more {k}</a></li></ul><div>short {k}</div>{wrap.format(text)}<span>end</span></body></html>"


def test_template_finds_container_and_fixed_text(spark):
    rows = [page(k) for k in range(40)] + [page(900, "other.example.org")]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert out[3] == "Story 3 tells of thing 21 at length, and goes on.\n\nIt ends in 3."
    assert out[900].endswith("It ends in 900.\n\nRead us daily.\n\nend")  # a host of one page has no template


def test_fixed_text_stays_when_nothing_else_is_there():
    source = "<article><p>same</p></article>"
    assert html.main_text(source, frozenset({html.token("/article/p", "same")})) == "same"


def test_odd_rows(spark):
    rows = [(1, None, None, "t"), (None, "no host", "<p>x</p>", "t"), (2, "http://a/b", "<p>" + "w " * 50000 + "</p>", None), (2, "http://a/b", "<p>y</p>", None), (2, "http://a/b", "<p>y</p>", None)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in out) == [(0, "no host", 1), (1, "", 0), (2, "http://a/b", 1), (2, "http://a/b", 1), (2, "http://a/b", 99999)]
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_given_pages(spark):
    out = html.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert all(r.text and r.n_chars == len(r.text) and "<p>" not in r.text for r in out)


def extracted(spark, sources, host="h.example.com"):
    rows = [(k, f"https://{host}/{k}", x) for k, x in enumerate(sources)]
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}


def story(k):
    return f"Story {k} tells of thing {k * 7} at length, and goes on for some time."


def test_template_decides_over_class_words(spark):
    shell = "<html><body><div class='top'><p>Our site</p></div><div class='content has-sidebar'><p>{}</p><p>It ends in {}.</p><div class='related'><p>See also {} there</p></div></div><div class='end'><p>bye</p></div></body></html>"
    out = extracted(spark, [shell.format(story(k), k, k) for k in range(6)])
    assert out == {k: f"{story(k)}\n\nIt ends in {k}." for k in range(6)}


def test_template_decides_over_article_cards(spark):
    shell = "<html><body><div class='text'><p>{}</p><p>{}</p></div><div class='cards'><article><p>card {}</p></article></div></body></html>"
    out = extracted(spark, [shell.format(story(k), story(k + 50), k) for k in range(6)])
    assert out == {k: f"{story(k)}\n\n{story(k + 50)}" for k in range(6)}


@pytest.mark.parametrize("n", [2, 5, 25])
def test_small_and_large_hosts_alike(spark, n):
    out = extracted(spark, [page(k)[2] for k in range(n)])
    assert out == {k: f"Story {k} tells of thing {k * 7} at length, and goes on.\n\nIt ends in {k}." for k in range(n)}


def test_two_designs_and_copies(spark):
    listing = "<html><body><div class='list'><h2>Latest</h2><p>Found {} things: {}</p></div></body></html>"
    copied = "<html><body><div class='body'><div class='col'><p>" + "</p><p>".join(f"Paragraph {j} of the copied story, {'long ' * 12}text." for j in range(6)) + "</p><p>Seen {} times</p></div></div></body></html>"
    sources = [page(k)[2] for k in range(12)] + [listing.format(k, story(k)) for k in range(8)]
    out = extracted(spark, sources)
    assert all(out[k] == f"Story {k} tells of thing {k * 7} at length, and goes on.\n\nIt ends in {k}." for k in range(12))
    assert all(out[12 + k] == f"Found {k} things: {story(k)}" for k in range(8))
    out = extracted(spark, [copied.format(k) for k in range(40)] + [page(k)[2] for k in range(10)])
    assert all(out[k].startswith("Paragraph 0 of") and "Paragraph 5 of" in out[k] for k in range(40))


def test_repeated_sections_count_to_what_holds_them(spark):
    shell = "<html><body><div class='text'>{}</div><div class='more'><p>teaser {}</p></div></body></html>"
    out = extracted(spark, [shell.format("".join(f"<div><p>{story(k * 10 + j)}</p></div>" for j in range(3)), k) for k in range(5)])
    assert out == {k: "\n\n".join(story(k * 10 + j) for j in range(3)) for k in range(5)}


def deduced(sources):
    """Brute force: fixed texts and elements by whole occurrence vectors, no sketches."""
    from collections import Counter, defaultdict

    vectors, is_text = defaultdict(dict), {}
    for k, source in enumerate(sources):
        blocks, paths = html.parse(source)
        found = Counter([(html.token(p), False) for p in paths] + [(html.token(b.path, b.text), True) for b in blocks])
        for (t, text), n in found.items():
            vectors[t][k] = n
            is_text[t] = text
    classes = defaultdict(list)
    for t, v in vectors.items():
        if len(v) >= 2:
            classes[tuple(sorted(v.items()))].append(t)
    return {t for c in classes.values() if len(c) >= html.MIN_CLASS_TOKENS and not all(is_text[t] for t in c) for t in c if is_text[t]}


def test_classes_are_those_of_whole_vectors(spark):
    shell = "<html><body><div class='top'><p>Our site</p></div><div class='content'><p>{}</p>{}<div class='tail'><p>See {}</p><p>Follow us</p></div></div><p>bye</p></body></html>"
    sources = [shell.format(story(k), "<p>Only on some pages</p>" * (k % 3), k) for k in range(9)] + [page(k)[2] for k in range(7)]
    rows = [("h", k, x) for k, x in enumerate(sources)]
    found = html.templates(spark.createDataFrame(rows, "host string, page long, html string").repartition(3)).first()
    expected = deduced(sources)
    assert set(found.fixed) == expected and len(expected) >= 4
    # The template changes what is extracted: without it names alone decide.
    changed = [x for x in sources if html.main_text(x, frozenset(found.fixed), found.containers) != html.main_text(x)]
    assert len(changed) == len(sources)
