import pytest

from lectern.llm.html_text import extract, main_text

LONG = "The story of the town is told by the people who live in it and it was a long one. " * 4
OTHER = "Der Mann und die Frau sind mit dem Kind in der Stadt. " * 2

PAGES = [
    (None, ""),
    ("", ""),
    ("just words", ""),
    (f"<p>{LONG}</p>", LONG.strip()),
    (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>Short.</article><footer>{LONG}</footer>",
     f"Title {LONG}Short."),
    ("<article><p>Auxpa.</p></article>", "Auxpa."),
    (f"<article><p>{LONG}</p><div class='ad'>{LONG}</div><section id=\"comments\">{LONG}</section></article>", LONG.strip()),
    (f"<div class=sidebar><p>{LONG}</div><div id=content><p>A &amp;amp; b &eacute;&#x41;&nbsp;c</p><p>{LONG}</p></div>",
     f"A &amp; b éA c {LONG}".strip()),
    (f"<p>{LONG}</p><script>if (a<b) '</p>'</script><style>p{{}}</style><!-- x > y --><p>{LONG}</p>", f"{LONG}{LONG}".strip()),
    (f"<ul><li><a href='/a'>One link</a></li><li><a href='/b'>Another</a></li></ul><p>{LONG}</p><p>So.</p><p>{LONG}</p>",
     f"{LONG}So. {LONG}".strip()),
    (f"<p>{LONG}</p><p>{LONG}</p><p>{OTHER * 2}</p>", f"{LONG}{LONG}".strip()),
    (f"<body><article>{LONG}<b>bold</b>er<br>next <a href='/x'>a link</a> in text {LONG}", f"{LONG}bolder next a link in text {LONG}".strip()),
    (f"<article><p>{LONG}</p><form><p>{LONG}</form><p>x<!-- open", f"{LONG}x"),
    (f"<article><p title='unclosed>{LONG}</p>", LONG.strip()),
    (f"<header><h1>Site</h1></header><main><p>{LONG}</p></main><div class='cookie-notice'><p>{LONG}</p></div>", LONG.strip()),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_text(page, want):
    assert main_text(page) == want


def test_long_and_hostile_pages():
    big = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert len(main_text(big)) > 1_000_000
    for bad in ("<" * 50_000, "<a " * 20_000, "<!--" * 20_000, "<div>" * 20_000, "<script>" * 2000, "&" * 50_000,
                "<div>" * 100_000 + "</section>" * 100_000):
        assert isinstance(main_text(bad), str)


def test_columns(spark):
    rows = [(1, "u", p, 3) for p, _ in PAGES] + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = extract(pages)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    got = sorted((r["text"], r["n_chars"]) for r in out.collect())
    assert got == sorted([(w, len(w)) for _, w in PAGES] + [("", 0)])
    assert extract(pages.limit(0)).count() == 0
