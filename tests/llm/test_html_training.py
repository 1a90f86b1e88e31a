"""Training pages of html_extract: copies, long pages and pages without a main block."""

import random

from paddock.llm import html_extract

TEXTS = [" ".join(f"word{random.Random(i * 31 + k).randint(0, 400)}" for k in range(30)) for i in range(60)]
ARTICLE = "<html><body><nav><a>Home</a></nav><article><h1>Title {0}</h1><p>{1}</p></article><footer>Foot</footer></body></html>"
DIVS = '<html><body><div class="nav"><a>Home</a></div><div class="content"><p>{1}</p><p>{0} {1}</p></div><div class="footer">Foot</div></body></html>'


def _table(spark, pages):
    return spark.createDataFrame([(i, None, p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)


def test_copies_do_not_fill_the_training_pages(spark):
    articles = [ARTICLE.format(i, t) for i, t in enumerate(TEXTS)]
    for copied in (DIVS.format(0, "hot"), articles[0]):
        table = _table(spark, [copied] * 300 + articles)
        got = html_extract._training_pages(table.select("html"), 10, 120)
        assert len(set(got)) == len(got) == 10 and all("<article>" in p for p in got)


def test_rare_main_blocks_are_found(spark):
    plain = [DIVS.format(i, t) for i, t in enumerate(TEXTS)]
    marked = [ARTICLE.format(i, TEXTS[i]) for i in range(2)]
    got = html_extract._training_pages(_table(spark, plain + marked).select("html"), 4, 120)
    assert sorted(got) == sorted(marked)


def test_tables_without_a_short_page_or_a_main_block_have_texts(spark):
    long_page = [ARTICLE.format(i, t * 600) for i, t in enumerate(TEXTS[:8])]
    assert min(map(len, long_page)) > 100_000
    for pages in (long_page, [DIVS.format(i, t) for i, t in enumerate(TEXTS)]):
        table = _table(spark, pages)
        model = html_extract.fit(table)
        assert model.weights and all(r["n_chars"] > 0 for r in html_extract.extract(table, model).collect())


def test_references_are_decoded_piece_by_piece():
    blocks = html_extract.blocks_of("<p>a &amp;lt; b &<b>lt;</b> c &lt; d &#233;</p>")
    assert [b.text for b in blocks] == ["a &lt; b &lt; c < d é"]
