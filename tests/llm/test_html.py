"""Main texts of pages whose markup misleads, is odd or is in a language without stop words."""

import time

import pytest

from tallyworks.llm import html_blocks
from tallyworks.llm.html_blocks import main_text

GOOD = "This is the paragraph that we want to keep because it is the text of the page and it has many of the words in it."
RUSSIAN = "Сегодня утром в городе прошёл первый снег, и жители вышли на улицы, чтобы посмотреть на белые крыши домов и деревья."


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content with-sidebar'><p>{}</p></div>",
        "<div class='main-content has-sidebar'><p>{}</p></div>",
        "<div id='page' class='site no-sidebar'><article><p>{}</p></article></div>",
        "<div class='post comments-open'><p>{}</p></div>",
        "<div class='widget-area'><article><p>{}</p></article></div>",
        "<body class='nav-open'><p>{}</p></body>",
        "<p>{}</p><div class='cookie-notice'>We use the cookies and all of the others are in it to be with you in the page.</div>",
        "<article><p>{0}</p></article><div id='comments'><article class='comment'><p>no {0}</p></article></div>",
        "<article><p>{0}</p></article><article class='comment'><p>no {0}</p></article>",
        "<div class='sidebar'><article>{0} no</article></div><main><p>{0}</p></main>",
        "<nav>a menu</nav><p>{}",
        "<div><p>{}<p></div><footer>of the page and all of it is in the end for you and for the others that are here</footer>",
        '<p title="a > b">{}</p>',
    ],
)
def test_one_paragraph(page):
    assert main_text(page.format(GOOD)) == GOOD


def test_pages_without_a_text():
    for page in ("<div class='comments'><article><p>{}</p></article></div>", "<div class='ad'>{}</div>", "<aside><p>{}</p></aside>", "<div class='sidebar'>{}</div>", "", None):
        assert main_text(page and page.format(GOOD)) == ""


def test_a_language_without_stop_words():
    menu = "<ul><li><a href=x>меню</a></li></ul>"
    assert main_text(f"<div><p>{RUSSIAN}</p></div>{menu}") == RUSSIAN
    assert main_text(f"{menu}<p>{RUSSIAN}</p><p>{RUSSIAN}</p>") == f"{RUSSIAN}\n{RUSSIAN}"
    assert main_text(f"<main><p>{RUSSIAN}</p></main><p>{RUSSIAN}</p>").startswith(RUSSIAN)


def test_quotes_that_never_end():
    assert main_text(f'<p>{GOOD}</p><a "').startswith(GOOD)
    assert GOOD in main_text(f'<i " x=1><p>{GOOD}</p>')
    assert main_text(f"<p>{GOOD}</p><p>1 < 2 and 3 > 2</p>") == f"{GOOD}\n1 < 2 and 3 > 2"


@pytest.mark.parametrize("part", ["<i>x</u>", '<a "', "<x y", "<p><i>", "<script", "<", '<a ">"', "<li>", "<b>short</b><p>a", "<!--", "<article><p>a", "&amp"])
def test_time_is_linear(part):
    page = part * (1_000_000 // len(part))
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 8  # an hour, where it is quadratic


def test_table(spark):
    rows = [(1, f"<p>{GOOD}</p>", "x"), (2, None, "x"), (3, "", None), (None, f"<p>{GOOD}</p>", "x"), (1, f"<p>{GOOD}</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id int, html string, article string").repartition(2)
    found = html_blocks.with_main_text(pages)
    assert found.columns == ["page_id", "html", "article", "text"]
    assert sorted(map(str, found.collect())) == sorted(str(r) for r in spark.createDataFrame([(*r, GOOD if r[1] else "") for r in rows], found.schema).collect())
    assert html_blocks.with_main_text(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        html_blocks.with_main_text(pages.withColumnRenamed("article", "TEXT"))
