"""Stored web pages: visible text, forum index pages, forum posts.

HTML needs a parser, so each page is parsed in Python on the executors, out of Arrow batches and into
Arrow batches; everything after the parse is done with built-in functions. Batches are bounded by bytes, so
pages may be of any size: a worker holds one page as text, besides a batch that comes and one that goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import rentscope
from rentscope.functions import text
from rentscope.vocab import PREVIOUS_PAGE_LABEL

# The readers below travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(rentscope)

VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
REMOVED = frozenset(["script", "style", "noscript"])
HIDDEN = frozenset(["script", "style", "template", "rt", "rp"])
ROW = "r-ent"
BATCH_BYTES = 8 << 20


class PageReader(HTMLParser):
    """Walks a page and hands every text run, with the open elements, to ``on_text``.

    An end tag closes the nearest open element of its name and all inside it; one
    that closes nothing is ignored.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack: list[tuple[str, dict]] = []
        self.run: list[str] = []

    def read(self, html: str) -> PageReader:
        self.feed(html or "")
        self.close()
        self._end_run()
        while self.stack:
            self._close()
        return self

    def _end_run(self):
        words = "".join(self.run).strip()
        self.run = []
        if words:
            self.on_text(words)

    def _close(self):
        name, attrs = self.stack.pop()
        self.on_close(name, attrs)

    def handle_starttag(self, tag, attrs):
        self._end_run()
        found: dict[str, str] = {name: value or "" for name, value in attrs}
        self.on_open(tag, found)
        self.stack.append((tag, found))
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_run()
        if self.stack and self.stack[-1][0] == tag:
            self._close()
        elif any(name == tag for name, _ in self.stack):
            while self.stack[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            if code < 256:
                self.run.append(bytes([code]).decode("windows-1252"))
            else:
                self.run.append(chr(code))
        except (ValueError, OverflowError):
            self.run.append("\ufffd")

    def handle_comment(self, data):
        self._end_run()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def updatepos(self, i, j):
        """Lines are not counted: nothing asks where a tag stood."""
        return j

    def inside(self, *names: str) -> bool:
        return any(name in names for name, _ in self.stack)

    def on_open(self, tag: str, attrs: dict):
        pass

    def on_close(self, tag: str, attrs: dict):
        pass

    def on_text(self, words: str):
        pass


class VisibleText(PageReader):
    """Title, and the visible text runs joined by spaces."""

    def __init__(self):
        super().__init__()
        self.title: list[str] | None = None
        self.title_open = False
        self.runs: list[str] = []

    def on_open(self, tag, attrs):
        if tag == "title" and self.title is None:
            self.title, self.title_open = [], True

    def on_close(self, tag, attrs):
        if tag == "title":
            self.title_open = False

    def on_text(self, words):
        if self.title_open:
            self.title.append(words)
        if not self.inside(*REMOVED, *HIDDEN):
            self.runs.append(words)


def _classes(attrs: dict) -> list[str]:
    return attrs.get("class", "").split()


class IndexPage(PageReader):
    """Rows of a forum's index page and the address of the page before."""

    def __init__(self):
        super().__init__()
        self.rows: list[dict] = []
        self.entry: dict | None = None
        self.previous: str | None = None
        self.link: list | None = None

    def _below(self, tag: str, cls: str) -> bool:
        return any(name == tag and cls in _classes(attrs) for name, attrs in self.stack)

    def on_open(self, tag, attrs):
        classes = _classes(attrs)
        if tag == "div" and ROW in classes:
            self.entry = {"depth": len(self.stack)}
        elif self.entry is not None:
            if tag == "a" and self._below("div", "title") and "url" not in self.entry:
                self.entry.update(url=attrs.get("href", ""), title="")
                self.entry["title_depth"] = len(self.stack)
            for part in ("author", "date"):
                if tag == "div" and part in classes:
                    self.entry.setdefault(part, "")
        if tag == "a" and {"btn", "wide"} <= set(classes) and self._below("div", "btn-group-paging"):
            self.link = [attrs.get("href", ""), ""]

    def on_text(self, words):
        if self.link is not None:
            self.link[1] += words
        if self.entry is None:
            return
        if self.entry.get("title_depth", 1 << 30) < len(self.stack):
            self.entry["title"] += words
        for part in ("author", "date"):
            if part in self.entry and self._below("div", part):
                self.entry[part] += words

    def on_close(self, tag, attrs):
        if self.link is not None and tag == "a":
            href, label = self.link
            if self.previous is None and PREVIOUS_PAGE_LABEL in label and href:
                self.previous = href
            self.link = None
        if self.entry is not None:
            if len(self.stack) == self.entry.get("title_depth"):
                del self.entry["title_depth"]
            if len(self.stack) == self.entry["depth"]:
                if self.entry.get("url"):
                    self.rows.append(self.entry)
                self.entry = None


class PostPage(PageReader):
    """Header values and body lines of a forum post."""

    DROPPED = frozenset(["article-metaline", "article-metaline-right", "push"])

    def __init__(self):
        super().__init__()
        self.found = False
        self.main_depth: int | None = None
        self.meta: list[str] = []
        self.meta_depth: int | None = None
        self.lines: list[str] = []

    def on_open(self, tag, attrs):
        if attrs.get("id") == "main-content" and not self.found:
            self.found, self.main_depth = True, len(self.stack)
        elif self.main_depth is not None and self.meta_depth is None:
            if tag == "span" and "article-meta-value" in _classes(attrs):
                self.meta.append("")
                self.meta_depth = len(self.stack)

    def on_close(self, tag, attrs):
        if len(self.stack) == self.meta_depth:
            self.meta_depth = None
        if len(self.stack) == self.main_depth:
            self.main_depth = None

    def on_text(self, words):
        if self.main_depth is None or self.inside(*HIDDEN):
            return
        if self.meta_depth is not None:
            self.meta[-1] += words
        dropped = any(
            name == "div" and self.DROPPED & set(_classes(attrs)) for name, attrs in self.stack
        )
        if not dropped:
            self.lines.append(words)


def _parsed(df: DataFrame, html: str, fields: list[T.StructField], parse) -> DataFrame:
    """Replace the HTML column by what ``parse`` makes of each page.

    Spark bounds the batches that come by ``spark.sql.execution.arrow.maxBytesPerBatch``; those that go are cut
    after ``BATCH_BYTES`` of HTML, which what is made of it does not exceed by much.
    """
    kept = [f for f in df.schema.fields if f.name != html]
    place = [f.name for f in df.schema.fields].index(html)
    made = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrived:
            pages, begin, size, found = batch.column(place), 0, 0, []
            for at in range(batch.num_rows):
                page = pages[at].as_py()
                size += len(page or "")
                found.append(parse(page))
                if size >= BATCH_BYTES or at + 1 == batch.num_rows:
                    part = batch.slice(begin, at + 1 - begin)
                    columns = [part.column(i) for i in range(part.num_columns) if i != place]
                    columns += [pa.array([row[k] for row in found], kind) for k, (_, kind) in enumerate(made)]
                    names = [n for i, n in enumerate(part.schema.names) if i != place]
                    yield pa.RecordBatch.from_arrays(columns, names=names + [name for name, _ in made])
                    begin, size, found = at + 1, 0, []

    return df.mapInArrow(batches, T.StructType(kept + fields))


def _string(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title and visible text of each page in place of its HTML."""

    def parse(page):
        reader = VisibleText().read(page)
        title = None if reader.title is None else " ".join(reader.title)
        return title, " ".join(reader.runs)

    parsed = _parsed(pages, html, [_string("page_title"), _string("page_text")], parse)
    return parsed.withColumn("page_text", text.collapse(F.col("page_text")))


def index_rows(pages: DataFrame, base_url: str, html: str = "html") -> DataFrame:
    """Article rows of stored forum index pages; a row whose link is gone is left out.

    ``position`` is the row's place on its page and ``previous_url`` the page before.
    """
    row = T.ArrayType(
        T.StructType([_string("title"), _string("url"), _string("author"), _string("date")])
    )

    def parse(page):
        reader = IndexPage().read(page)
        rows = [
            (r["title"], urljoin(base_url, r["url"]), r.get("author"), r.get("date"))
            for r in reader.rows
        ]
        return rows, urljoin(base_url, reader.previous) if reader.previous else None

    parsed = _parsed(pages, html, [T.StructField("rows", row), _string("previous_url")], parse)
    others = [c for c in parsed.columns if c != "rows"]
    return parsed.select(*others, F.posexplode("rows").alias("position", "row")).select(
        *others, "position", "row.*"
    )


def posts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Articles of stored post pages.

    Header values on the page win over the columns board, title, author and date of
    the table; the body loses header, replies, origin line and signature, and has its
    personal data hidden.
    """
    fields = [T.StructField("meta", T.ArrayType(T.StringType())), _string("body")]

    def parse(page):
        reader = PostPage().read(page)
        return reader.meta, "\n".join(reader.lines)

    parsed = _parsed(pages, html, fields, parse)
    places = {"author": 0, "board": 1, "title": 2, "date": 3}
    listed = {
        name: F.coalesce(
            F.get("meta", F.lit(place)),
            F.col(name) if name in pages.columns else F.lit(None).cast("string"),
        )
        for name, place in places.items()
    }
    listed["content"] = text.mask_post(text.post_body(F.col("body")))
    return parsed.withColumns(listed).drop("meta", "body")
