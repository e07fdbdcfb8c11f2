"""Stored HTML pages."""

from pyspark.sql import functions as F

from rentscope.sources import html_pages

BASE = "https://forum.example"


def test_page_text(spark):
    cases = [
        ("<html><head><title> A &amp; B </title><style>x{}</style></head><body><script>var a='</p>';"
         "</script><p>one<b>two</b>  three\n four</p><!-- no --><noscript>hidden <i>deep</i></noscript>"
         "<br>five&nbsp;&#20803;&copy;</body></html>",
         "A & B", "A & B one two three four five 元©"),
        ("<p>open <div>text", None, "open text"),
        ("<noscript><p>x</noscript>y</p>z", None, "y z"),
        ("<template>t</template><ruby>r<rt>s</rt></ruby>", None, "r"),
        ("plain &unknown; text", None, "plain &unknown text"),
        ("<title></title>", "", ""),
        ("", None, ""),
        (None, None, ""),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, html string")
    got = html_pages.page_text(df).orderBy("i").collect()
    assert [(r.page_title, r.page_text) for r in got] == [c[1:] for c in cases]


def test_index_rows(spark):
    page = """
    <div class="btn-group btn-group-paging"><a class="btn wide" href="/first">最舊</a>
      <a class="btn wide" href="/bbs/b/index1.html">&lsaquo; 上頁</a></div>
    <div class="r-ent"><div class="nrec">9</div><div class="title"> <a href="/bbs/b/M.1.A.html">First <b>x</b></a></div>
      <div class="meta"><div class="author">ann</div><div class="date"> 7/01</div></div></div>
    <div class="r-ent"><div class="title">(deleted)</div><div class="meta"><div class="author">-</div></div></div>
    <div class="r-ent"><div class="title"><a href="https://other.example/p">Second</a></div></div>
    """
    df = spark.createDataFrame([("b", page), ("empty", "<p></p>")], "board string, html string")
    got = html_pages.index_rows(df, BASE).orderBy("position").collect()
    assert [(r.board, r.position, r.title, r.url, r.author, r.date) for r in got] == [
        ("b", 0, "Firstx", BASE + "/bbs/b/M.1.A.html", "ann", "7/01"),
        ("b", 1, "Second", "https://other.example/p", None, None),
    ]
    assert got[0].previous_url == BASE + "/bbs/b/index1.html"


def test_posts(spark):
    def line(label, words):
        return (f'<div class="article-metaline"><span class="article-meta-tag">{label}</span>'
                f'<span class="article-meta-value">{words}</span></div>')

    page = (
        '<div id="main-content">' + line("a", "ann (Ann)")
        + line("b", "Rent").replace("metaline", "metaline-right", 1) + line("t", "Title")
        + line("d", "Wed Jul 26 21:06:35 2017")
        + 'Call 0912-345-678\n\n\n\nor a@b.co<br>LINE: my_id_1 -- sig<div class="push">push</div>'
        '<span>※ 發信站: x</span></div>'
    )
    short = '<div id="main-content">' + line("a", "bob") + "text</div>"
    df = spark.createDataFrame(
        [(1, "fb", "ft", "fa", "fd", page), (2, "fb", "ft", "fa", "fd", short), (3, "fb", "ft", "fa", "fd", "<p>x</p>")],
        "i int, board string, title string, author string, date string, html string",
    )
    one, two, three = html_pages.posts(df).orderBy("i").collect()
    assert (one.author, one.board, one.title, one.date) == (
        "ann (Ann)", "Rent", "Title", "Wed Jul 26 21:06:35 2017"
    )
    assert one.content == "Call [PHONE_REDACTED]\n\nor [EMAIL_REDACTED]\nLINE: [LINE_ID_REDACTED]"
    assert (two.author, two.board, two.title, two.date, two.content) == ("bob", "fb", "ft", "fd", "text")
    assert (three.author, three.content) == ("fa", "")


def test_large_pages_go_through_in_small_batches(spark):
    """120 pages of 2 MB, 240 MB in all, through workers that may not grow by more than a part of that."""
    import resource

    from rentscope.sources.html_pages import _parsed, _string

    def parse(page):
        # What the parser itself needs is tried above; here it is what the batches need.
        return page[:5], str(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)

    page = F.concat(F.lit("<p>é"), F.repeat(F.concat(F.lit("x"), F.col("id").cast("string")), 500_000), F.lit("</p>"))
    pages = spark.range(0, 120, 1, 1).select("id", page.alias("html"), F.lit("z").alias("other"))
    found = _parsed(pages, "html", [_string("begin"), _string("most")], parse)
    assert found.columns == ["id", "other", "begin", "most"]
    rows = found.collect()
    assert len(rows) == 120 and {r.begin for r in rows} == {"<p>éx"} and {r.other for r in rows} == {"z"}
    sizes = [int(r.most) for r in sorted(rows, key=lambda r: r.id)]
    assert sizes[-1] - sizes[0] < 160_000  # kilobytes
