"""Block rules on hand-made pages."""

import pytest

from perigee.llm import html_text as H

LONG = "The cat sat on the mat and it was in the house of the man who had been to the sea with us. "
ODD = "Zyx%%% wvu### tsr$$$ qpo&&& nml%%% kji### hgf$$$ edc&&& baz%%% yxw### vut$$$ srq&&&"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain words only", ""),
        (f"<p>{LONG}</p>", LONG.strip()),
        (f"<body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>T</h1><p><b>{LONG}<br><p>Short.</article><footer>{LONG}</footer>", f"T\n{LONG.strip()}\nShort."),
        (f"<article><p>{ODD}</p><p>a &lt;b&gt; &amp;amp; &eacute;&#233;\n\t  c&nbsp;d</p></article>", ODD.replace("&&&", "&&&") + "\na <b> &amp; éé c d"),
        (f"<article>{LONG}<div class='reader comments'>{LONG}<p>{LONG}</div><p>End.</p></article>{LONG}", f"{LONG.strip()}\nEnd."),
        (f"<script>var a='</p>';if(a<b){{}}</script><style>p{{}}</style><p>{LONG}<!-- <p>{LONG} --></p>", LONG.strip()),
        (f"<p>{LONG}</p><script>never closed <p>{LONG}", LONG.strip()),
        (f"<form><p>{LONG}</p></form><div hidden>{LONG}</div><aside>{LONG}</aside><p>{LONG}", LONG.strip()),
        (f"<p>{LONG}</p><p>Near text.</p>" + "<p><a href=x>link link link</a></p>" * 3, f"{LONG.strip()}\nNear text."),
        (f"<p><a href=x>{LONG}</a></p>", ""),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><p title=\"a>b\">x</p><p>cut <b", "x\ncut"),
    ],
)
def test_pages(page, text):
    assert H.main_text(page) == text


def test_undecided_blocks_take_the_nearest_label():
    block = lambda text, linked=0: (text, linked, 0, False)
    links = block("x" * 30, 30)
    assert H.labels([block(LONG), block("near text"), block("b"), links]) == [True, True, False, False]
    assert H.labels([links, block("tie"), block(LONG)]) == [False, True, True]
    assert H.labels([block("alone")]) == [False] and H.labels([("alone", 0, 1, False)]) == [True]


def test_rows_and_long_pages(make):
    rows = [(1, "u", f"<article><p>{LONG}"), (None, None, None), (1, "u", f"<article><p>{LONG}"), (2, "v", "<p>" + "<b>" * 50_000 + LONG * 3000)]
    got = H.extracted(make(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r["page_id"], r["url"], r["n_chars"]) for r in got), key=str) == sorted(
        [(1, "u", len(LONG) - 1), (1, "u", len(LONG) - 1), (None, None, 0), (2, "v", 3000 * len(LONG) - 1)], key=str
    )
    assert H.extracted(make([], "page_id long, url string, html string")).collect() == []


def test_closing_tags_find_their_element_at_any_depth():
    assert H.main_text(f"<nav>{'<div><span>' * 500}Menu</nav><article><p>{LONG}</article>") == LONG.strip()


def test_other_languages_and_short_paragraphs():
    italian = "Quando arrivammo al villaggio trovammo gli abitanti raccolti davanti alla chiesa, mentre le campane suonavano ancora."
    russian = "Когда мы приехали в деревню, жители уже собрались перед церковью, и колокола всё ещё звонили над рекой."
    for text in (italian, russian):
        assert H.main_text(f"<div><p>{text}</p></div><p><a href=x>link link link</a></p>") == text
    short = "".join(f"<p>Short paragraph {i}.</p>" for i in range(6))
    assert H.main_text(short).count("\n") == 5
    assert H.main_text(f"<p>{LONG * 2}</p><p><a href=x>link link</a></p><p>{ODD}</p>") == (LONG * 2).strip()


def test_names_do_not_remove_the_article():
    comments = f"<div class=comments><article class=comment><p>{LONG * 2}</p></article></div>"
    for page in (
        f"<div class='layout has-sidebar'><article><p>{LONG}</p></article></div>", f"<article class='post no-comments'><p>{LONG}</p></article>",
        f"<div class=share><main><p>{LONG}</p></main></div>", f"<article class='post search'><p>{LONG}</p></article>",
        f"<main><div class=sidebar><article><p>{LONG}</p></article></div></main>",
        f"<article><p>{LONG}</p>{comments}</article>", f"<article><p>{LONG}</p></article>{comments}", f"<p>{LONG}</p>{comments}",
        f"<div class=social><article><p>{LONG}</p>{comments}</article></div>",
    ):
        assert H.main_text(page) == LONG.strip(), page


def test_a_teaser_article_does_not_hide_the_main_text():
    teaser = "<article><h3>Another story</h3><p>The other story of the town that was told to all of the people.</p></article>"
    got = H.main_text(f"<nav>menu</nav><div id=content><p>{LONG * 2}</p><p>{LONG}</p></div>{teaser}<footer>end</footer>")
    assert got.startswith(f"{(LONG * 2).strip()}\n{LONG.strip()}") and "menu" not in got and "end" not in got.split("\n")
    got = H.main_text(f"<article><p>{LONG * 3}</p></article><div><p>{LONG}</p></div>")
    assert got == (LONG * 3).strip()
