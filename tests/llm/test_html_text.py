"""Main text extraction on pages whose main text is known."""

import html as h
import re

from pyspark.sql import functions as F

from tillsight.llm import html_text as t

SF = "/root/testdata/sf0.001"
LONG = "Here is a sentence that belongs to the story and goes on for a while, as sentences do. " * 3


def planted(page):
    """Blocks of the one article of a generated page, by plain string work."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<[^>]*>", " ", b))).strip()
              for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_generated_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = t.op4_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert r["text"] == planted(page["html"])
        assert r["n_chars"] == len(r["text"])
        assert r["url"] == page["url"]


def test_furniture_goes_and_short_blocks_stay():
    page = f"""<html><head><title>x</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies. {LONG}</div>
    <article class="post comments-open"><header><h2>Title &amp; more</h2></header><p>{LONG}</p><p>Yes.</p>
    <div class="ad">{LONG}</div><form><p>{LONG}</p><input></form><ul><li>one<li>two</ul>
    <p>A <b>bold</b>\n word<br>here&nbsp;too<script>var a = "</p>";</script></p>
    <section id="comments"><article><p>{LONG}</p></article></section></article>
    <aside><p>{LONG}</p></aside><footer>&copy; {LONG}</footer></body></html>"""
    assert t.main_text(page).split("\n\n") == ["Title & more", LONG.strip(), "Yes.", "one", "two", "A bold word here too"]


def test_without_article_the_content_region_is_found():
    page = f"""<body><div id="top"><a href="/a">A</a> <a href="/b">B</a></div>
    <div id="page"><div id="text"><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
    <div class="sidebar"><p>{LONG}</p></div></div><div><a href="/x">Imprint</a></div></body>"""
    assert t.main_text(page).split("\n\n") == ["Head", LONG.strip(), "Short.", LONG.strip()]


def test_broken_markup():
    assert t.main_text(f"<article><p><b>One {LONG}<br><p>Two") == f"One {LONG.strip()}\n\nTwo"
    assert t.main_text("no markup at all") == "no markup at all"
    assert t.main_text("<p>a</div></p></b>b") == "a\n\nb"
    assert t.main_text("<div>" * 3000 + LONG) == LONG.strip()
    for empty in (None, "", "<html></html>", "<script>x</script>", "<!-- x -->"):
        assert t.main_text(empty) == ""
    assert t.main_text("<p>" + "word " * 200_000 + "</p>") == ("word " * 200_000).strip()


def test_edges(spark):
    rows = spark.createDataFrame([(1, "u", None, "old"), (1, "u", None, "old"), (None, None, "<p>x y</p>", "old")],
                                 "page_id long, url string, html string, text string")
    got = t.extract(rows)
    assert sorted(got.columns) == ["html", "n_chars", "page_id", "text", "url"]
    assert sorted(r["text"] for r in got.collect()) == ["", "", "x y"]
    assert t.extract(rows.filter(F.lit(False))).count() == 0


def test_all_content_is_kept_without_article():
    short = LONG[:len(LONG) // 2].strip()
    page = f"<body><div><section><p>{LONG}</p></section><section><p>{short}</p></section></div></body>"
    assert t.main_text(page).split("\n\n") == [LONG.strip(), short]
    page = f"<body><main><p>{LONG}</p></main><div><p>{short}</p></div></body>"
    assert t.main_text(page).split("\n\n") == [LONG.strip(), short]
    page = f"<main><article><p>{LONG}</p></article><p>{short}</p></main>"
    assert t.main_text(page).split("\n\n") == [LONG.strip(), short]


def test_head_without_end_tag():
    for body in (f"<body><p>{LONG}</p>", f"<p>{LONG}</p>", LONG):
        assert t.main_text(f"<html><head><title>x</title><meta charset=utf-8><script>y</script>{body}") == LONG.strip()


def test_layout_names_and_reference_lists_stay():
    assert t.main_text(f'<div class="elementor-widget-container"><p>{LONG}</p></div><div class="widget"><p>{LONG}</p></div>') == LONG.strip()
    refs = [f"{k}. {LONG.strip()}" for k in range(6)]
    page = f"<div><p>{LONG}</p><ol>" + "".join(f'<li><a href="/{k}">{r}</a></li>' for k, r in enumerate(refs)) + "</ol></div>"
    assert t.main_text(page).split("\n\n") == [LONG.strip(), *refs]
