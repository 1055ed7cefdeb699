"""Link extraction from stored web pages, and the set still to fetch.

The reference fetches each league page and takes the ``src`` of the first
``img`` inside the first ``div`` of the profile-header class. Here pages are
a table that has been fetched already; extraction is a ``mapInPandas`` job
over Arrow batches, so it runs on every executor in parallel and each page
is handled inside one task (nothing goes through the driver). HTML needs a
real tokenizer (nesting, attribute quoting, entities), which no built-in
Spark function offers, so the per-page step is a small stdlib
``html.parser`` handler. Arrow batches handed to the handler are capped
by ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default), so
large pages do not blow up a Python worker.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickledger.functions.text import fill_template

# Where the logo sits on a league page, and the status words.
LOGO_CONTAINER_TAG = "div"
LOGO_CONTAINER_CLASS = "data-header__profile-container"
LOGO_CHILD_TAG = "img"
LOGO_ATTRIBUTE = "src"
LOGO_PATH_TEMPLATE = "data/logos/leagues/{}.png"
OK, NO_CONTAINER, NO_CHILD, NO_ATTR = "ok", "no_container", "no_child", "no_attr"

LINK_SCHEMA = "page_id long, url string, link string, status string"


# HTML void elements (they never hold content and need no end tag).
VOID_ELEMENTS = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                           "param", "source", "track", "wbr"})


class _FirstLink(HTMLParser):
    """Finds the first ``child`` tag inside the first matching container.

    Open elements are kept on a stack; an end tag closes the most recent
    open element of that name and everything opened after it (an end tag
    with no open match is ignored), so an unclosed container ends where its
    parent ends.
    """

    def __init__(self, container: str, css_class: str | None, child: str, attr: str):
        super().__init__(convert_charrefs=True)
        self.container, self.css_class, self.child, self.attr = container, css_class, child, attr
        self.stack: list[str] = []
        self.container_at: int | None = None   # stack position of the container once found
        self.found = False
        self.done = False
        self.link: str | None = None
        self.status = NO_CONTAINER

    def _matches(self, attrs) -> bool:
        if self.css_class is None:
            return True
        for key, value in attrs:
            if key == "class" and value is not None:
                if value == self.css_class or self.css_class in value.split():
                    return True
        return False

    def _take_child(self, attrs) -> None:
        value = dict(attrs).get(self.attr)
        self.link, self.status = (value, OK) if value else (None, NO_ATTR)
        self.done = True

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if self.found and tag == self.child:
            self._take_child(attrs)
            return
        if not self.found and tag == self.container and self._matches(attrs):
            self.found, self.status = True, NO_CHILD
            if tag in VOID_ELEMENTS:
                self.done = True
                return
            self.container_at = len(self.stack)
        if tag not in VOID_ELEMENTS:
            self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        # A self-closed element opens nothing; a self-closed container holds nothing.
        if self.done:
            return
        if self.found and tag == self.child:
            self._take_child(attrs)
        elif not self.found and tag == self.container and self._matches(attrs):
            self.found, self.done, self.status = True, True, NO_CHILD

    def handle_endtag(self, tag):
        if self.done:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at] == tag:
                del self.stack[at:]
                if self.container_at is not None and at <= self.container_at:
                    self.done = True
                return


FEED_CHUNK = 16384


def first_link(html: str | None, container: str = LOGO_CONTAINER_TAG,
               css_class: str | None = LOGO_CONTAINER_CLASS, child: str = LOGO_CHILD_TAG,
               attr: str = LOGO_ATTRIBUTE) -> tuple[str | None, str]:
    """``(link, status)`` for one page.

    The page is fed in chunks and parsing stops as soon as the answer is
    fixed (link found, or the container closed without one); a page without
    a match is read to its end.
    """
    if html is None:
        return None, NO_CONTAINER
    parser = _FirstLink(container, css_class, child, attr)
    for at in range(0, len(html), FEED_CHUNK):
        parser.feed(html[at:at + FEED_CHUNK])
        if parser.done:
            return parser.link, parser.status
    parser.close()
    return parser.link, parser.status


def extract_links(pages: DataFrame, container: str = LOGO_CONTAINER_TAG,
                  css_class: str | None = LOGO_CONTAINER_CLASS, child: str = LOGO_CHILD_TAG,
                  attr: str = LOGO_ATTRIBUTE, on_error: str = "status") -> DataFrame:
    """``(page_id, url, link, status)`` for every page.

    ``on_error="raise"`` fails the job on the first page without a link,
    as the reference does; the default reports the reason per page.
    """
    if on_error not in ("status", "raise"):
        raise ValueError("on_error must be 'status' or 'raise'")
    # Ship this module's code with the task, so Python workers need no
    # import path to the package (they may start in another directory).
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [first_link(h, container, css_class, child, attr) for h in batch["html"]]
            links = [f[0] for f in found]
            statuses = [f[1] for f in found]
            if on_error == "raise":
                bad = [s for s in statuses if s != OK]
                if bad:
                    raise ValueError(f"page without a link: {bad[0]}")
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"],
                                "link": pd.Series(links, dtype=object),
                                "status": pd.Series(statuses, dtype=object)})

    return pages.select("page_id", "url", "html").mapInPandas(run, LINK_SCHEMA)


def distinct_urls(competitions: DataFrame) -> DataFrame:
    """``select distinct competition_id, url``."""
    return competitions.select("competition_id", "url").distinct()


def pending(targets: DataFrame, done: DataFrame, key: str = "competition_id") -> DataFrame:
    """Targets whose ``key`` is not among ``done`` (logos not stored yet).

    An anti join: NULL keys in ``done`` do not hide every target, unlike
    ``NOT IN``. ``done`` is joined by size (broadcast only if Spark measures
    it small).
    """
    return targets.join(done.select(key), key, "left_anti")


def logo_paths(df: DataFrame, key: str = "competition_id", template: str = LOGO_PATH_TEMPLATE) -> DataFrame:
    return df.withColumn("logo_path", fill_template(template, F.col(key)))


def pending_links(targets: DataFrame, done: DataFrame, pages: DataFrame, **where) -> DataFrame:
    """Logo links still to fetch: the stored pages of pending targets' urls,
    each parsed once, joined to the targets by ``url``. ``where`` passes the container,
    class, child tag and attribute to ``extract_links``."""
    todo = pending(targets, done).select("competition_id", "url")
    pages_todo = pages.select("page_id", "url", "html").join(todo.select("url").distinct(), "url", "left_semi")
    links = extract_links(pages_todo.select("page_id", "url", "html"), **where)
    return links.join(todo, "url").select("competition_id", "url", "link", "status")
