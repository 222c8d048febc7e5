"""Main text of pages."""

import pytest

from regfuse.llm import main_text as H

P1 = "The first paragraph, with some length to it, and commas, says what the article is about in plain words."
P2 = "A second paragraph, a little shorter, goes on."
NOISE = """<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy, now, cheap.</div>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("   \n ", ""), ("<p></p><br>", ""),
        (f"<html><body>{NOISE}<article><h1>Title</h1><p>{P1}</p><p>{P2}</p></article><footer>&copy; x</footer></body></html>", f"Title\n{P1}\n{P2}"),
        (f"<body>{NOISE}<article><p><b>{P1}<br><p>{P2}</article><footer><p>{P1}</p></footer>", f"{P1}\n{P2}"),  # missing end tags
        (f"<body><div id=main-content><p>{P1}</p><ul><li>one</li><li>two</ul><p>{P2}</p></div><div class='user-comments'><p>{P1} {P1}</p></div>", f"{P1}\none\ntwo\n{P2}"),
        (f"<body><main><section><p>{P1}</p></section><section><p>{P2}</p></section></main><aside><p>{P1}</p></aside>", f"{P1}\n{P2}"),
        (f"<p>{P1}</p><p>a &lt;b&gt; &amp;amp; &#233;&nbsp;c\n\t d</p>", f"{P1}\na <b> &amp; é c d"),
        (f"<article><p>{P1}</p><script>var t = '</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{P2}</p><form><p>no</p></form></article>", f"{P1}\n{P2}"),
        (f"<article><p>{P1}<div class='cookie-notice'>no, no, no</div><p>x<i>y</i>z <a href='#'>link</a></p></article>", f"{P1}\nxyz link"),
        (f"<body><div>{P1}</div><div>{P2}</div><div><a href=1>one</a> <a href=2>two</a></div></body>", f"{P1}\n{P2}"),
        ("just < text, no tags", "just < text, no tags"),
        (f"<article><p>{P1}</p><img alt='a > b'><p>{P2}</p>", f"{P1}\n{P2}"),
        (f"<article><p>{P1}</p><div id='comments'><p>{P2}</p></div><blockquote><p>{P2}</p></blockquote></article>", f"{P1}\n{P2}"),
    ],
)
def test_pages(page, text):
    assert H.main_text(page) == text


LINKS = "<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body>{NOISE}<article><h1>Title</h1><div class=body><div class=part><p>{P1}</p><p>{P1}</p><p>{P1}</p><p>{P1}</p></div></div><section><p>{P2}</p></section></article>{LINKS}", f"Title\n{P1}\n{P1}\n{P1}\n{P1}\n{P2}"),
        (f"<article><h1>Title</h1><div><div><div><p>{P1}</p></div><div><p>{P2}</p></div></div></div><div><div><p>{P2}</p></div></div></article>", f"Title\n{P1}\n{P2}\n{P2}"),
        (f"<main><h1>Title</h1><div><div><div><p>{P1}</p><p>{P1}</p></div></div></div><p>{P2}</p></main><div><p>x</p></div>", f"Title\n{P1}\n{P1}\n{P2}"),
        (f"<main><h1>Title</h1><div><article><div><div><p>{P1}</p></div></div><p>{P2}</p></article></div>{LINKS}</main><div><p>x</p></div>", f"Title\n{P1}\n{P2}"),
        (f"<main><article><div><div><p>{P1}{P1}{P1}</p></div></div></article><article><p>x</p></article></main>", f"{P1}{P1}{P1}"),
        (f"<body><div id=page><h1>Title</h1><div class=body><div class=part><p>{P1}</p><p>{P1}</p></div></div><section><p>{P2}</p></section>{LINKS}</div></body>", f"Title\n{P1}\n{P1}\n{P2}"),
    ],
)
def test_nested_wrappers_and_split_bodies(page, text):
    assert H.main_text(page) == text


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 50_000 + P1 + "</div>" * 50_000) == P1
    page = "<article>" + f"<p>{P1}</p>" * 20_000 + "</article>"
    assert H.main_text(page) == "\n".join([P1] * 20_000)


def test_frame(spark):
    rows = [(1, "u", f"<p>{P1}</p>", "t"), (1, "u", f"<p>{P1}</p>", "t"), (2, None, None, "t"), (None, "v", "<p>é\U0001f600</p>", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted((tuple(r) for r in H.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", P1, len(P1))] * 2 + [(2, None, "", 0), (None, "v", "é\U0001f600", 2)], key=repr)
    assert H.extract(df.limit(0)).count() == 0
