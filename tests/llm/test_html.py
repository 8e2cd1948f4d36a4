from tidemark.llm.html import extract_main_text, main_text

PROSE = "The house on the hill was old and it had been empty for a long time, but the people in the village said that "
LONG = (PROSE + "someone was seen at the window of it on most of the nights. ") * 2


def test_article_page():
    page = f"""<!DOCTYPE html><html><head><title>no title</title><style>p{{}}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad -->
    <div class="ad">Der die das und ist nicht im Preis.</div><div class="page with-sidebar"><article><h1>A&amp;B&nbsp; title</h1>
    <p><b>First &lt;p&gt;.<br><p>{LONG}<p>Short.</p><div class="related"><a href="/x">More on this</a></div>
    <table><tr><td>cell<td>next</table><aside>aside</aside><p>See <a href="/y">this link</a> for in<b>line</b> text.
    <section id="comments"><p>{LONG}</p></section></article></div>
    <form><p>{LONG}</p></form><div role="alert">notice</div><footer>&copy; us</footer></body></html>"""
    assert main_text(page) == f"A&B title First <p>. {' '.join(LONG.split())} Short. cell next See this link for inline text."


def test_pages_without_article_go_by_density():
    menu = "".join(f'<li><a href="/{i}">Item number {i} of the menu</a></li>' for i in range(5))
    page = f"<div><ul>{menu}</ul></div><div><h2>Short head</h2><p>{LONG}</p><p>And so.</p><p>{LONG}</p></div><div>{menu}<span>x</span></div>"
    text = " ".join(LONG.split())
    assert main_text(page) == f"Short head {text} And so. {text}"


RUSSIAN = "Старый дом на холме много лет стоял пустым, но жители деревни говорили, что по ночам в окне горит свет. " * 3
CHINESE = "山上的老房子空了很多年，村里的人说夜里窗户里总有灯光，可是谁也不敢走近去看一看里面究竟住着什么人。"
MENU = "".join(f'<li><a href="/{i}">Item number {i} of the menu</a></li>' for i in range(5))


def test_unlisted_languages_and_code():
    for p in (RUSSIAN, CHINESE, CHINESE * 6, "x1 = f(y1); " * 30):
        p = " ".join(p.split())
        assert main_text(f"<ul>{MENU}</ul><div><p>{p}</p><p>{p}</p></div><ul>{MENU}</ul>") == f"{p} {p}"
    text = " ".join(LONG.split())   # next to text of a listed language
    assert main_text(f"<p>{LONG}</p><p>{RUSSIAN}</p><p>{LONG}</p>") == f"{text} {' '.join(RUSSIAN.split())} {text}"


def test_short_paragraphs_and_single_links():
    medium = "Prices rose sharply again yesterday; traders expected further gains across several markets worldwide soon."
    text = " ".join(LONG.split())
    assert main_text(f"<ul>{MENU}</ul><p>{medium}</p><p>Next.</p><p>{medium}</p><ul>{MENU}</ul>") == f"{medium} Next. {medium}"
    assert main_text(f"<p>{LONG}</p><p>{medium}</p><p>Next.</p><p>{LONG}</p>") == f"{text} {medium} Next. {text}"
    assert main_text(f"<p>{LONG}</p><p>{medium * 3} <a href='/x'>here</a></p><p>{LONG}</p>") == f"{text} {medium * 3} here {text}"


def test_class_words_alone_drop_no_page():
    text = " ".join(LONG.split())
    for name in ("content no-sidebar", "layout sidebar-left", "cookie-page", "post comments-open"):
        page = f'<div class="{name}"><p>{LONG}</p><div class="sidebar">Tags and the like</div><p>{LONG}</p></div><ul>{MENU}</ul>'
        assert main_text(page) == f"{text} {text}", name
    assert main_text(f'<p>{LONG}</p><div class="sidebar"><p>{PROSE * 2}</p></div>') == text
    assert main_text(f'<p>{LONG}</p><div class="comments"><p>{LONG}</p><p>{LONG}</p></div>') == text


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<nav>a</nav>") == ""
    assert main_text("<article><p>a &am &quo; &#x41;&#66; b") == "a &am &quo; AB b"
    assert main_text("<article></div></p>text</article></article>") == "text"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<article><p hidden>no</p><p style='display: none'>no</p>yes</article>") == "yes"


def test_rows(spark):
    rows = [(1, "u", "<article>one</article>", 5), (1, "u", "<article>one</article>", 5), (None, None, None, 6), (2, "v", "", 7),
            (3, "w", "<article><p>" + "lang " * 200_000 + "</article>", 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.url, len(r.text)) for r in extract_main_text(df).collect())
    assert got == [(0, None, 0), (1, "u", 3), (1, "u", 3), (2, "v", 0), (3, "w", 999_999)]
    assert extract_main_text(df.limit(0)).collect() == []


TALE = ("It was on the night of the fair that the old man went to the river and saw that the boats were not there, for they had been "
         "taken by the men of the other town, and he was not to see them again until the year was at its end. ") * 2


def test_a_form_around_the_page_is_not_boilerplate():
    for inner in (f"<article><p>{TALE}</p></article>", f"<div><p>{TALE}</p></div>"):
        page = f"<body><form action='/page'><div class='menu'><a href='/'>Home</a></div>{inner}</form></body>"
        assert main_text(page) == TALE.strip()
    small = f"<body><article><p>{TALE}</p><form><p>Leave your address and we will write to you when there is news</p></form></article></body>"
    assert main_text(small) == TALE.strip()


def test_end_tags_left_out_and_scripts_inside_words():
    page = f"<article><p style='display:none'>hidden words<p>{TALE}<ul><li hidden>gone<li>{TALE}</ul></article>"
    assert main_text(page) == TALE.strip() + " " + TALE.strip()
    assert main_text(f"<article><p>{TALE}unbeliev<script>x()</script>able<style>p{{}}</style> end</p></article>") == TALE + "unbelievable end"
