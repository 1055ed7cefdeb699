import pytest
from pyspark.errors import PySparkException

from kickledger.operators import pages

CLASS = "data-header__profile-container"
PAGES = [
    (1, "u1", f'<html><div class="x {CLASS}"><p>t</p><img alt="a" src="/logo1.png"></div></html>'),
    (2, "u2", "<html><div class='other'><img src='/no.png'></div></html>"),
    (3, "u3", f'<div class="{CLASS}"><div><span>no image</span></div></div><img src="/outside.png">'),
    (4, "u4", f'<div class="{CLASS}"><img alt="no src"></div>'),
    (5, "u5", None),
    (6, "u6", f'<div class="{CLASS}"><div><img src="/nested.png?a=1&amp;b=2"/></div></div>'),
    (7, "u7", f'<section><div class="{CLASS}"><p>x</section><img src="/after.png">'),
    (8, "u8", f'<div class="{CLASS}"><br><hr/></span><img src="/ok8.png"></div>'),
]


def test_first_link_statuses(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    out = {r.page_id: (r.link, r.status) for r in pages.extract_links(df).collect()}
    assert out == {1: ("/logo1.png", "ok"), 2: (None, "no_container"), 3: (None, "no_child"),
                   4: (None, "no_attr"), 5: (None, "no_container"), 6: ("/nested.png?a=1&b=2", "ok"),
                   7: (None, "no_child"), 8: ("/ok8.png", "ok")}


def test_raise_mode(spark):
    df = spark.createDataFrame(PAGES[1:2], "page_id long, url string, html string")
    with pytest.raises(PySparkException):
        pages.extract_links(df, on_error="raise").collect()


def test_pending_and_paths(spark):
    targets = spark.createDataFrame([("GB1", "u1"), ("GB1", "u1"), ("ES1", "u2"), ("IT1", "u3")],
                                    "competition_id string, url string")
    done = spark.createDataFrame([("ES1",), (None,)], "competition_id string")
    out = pages.logo_paths(pages.pending(pages.distinct_urls(targets), done)).orderBy("competition_id").collect()
    assert [(r.competition_id, r.logo_path) for r in out] == [
        ("GB1", "data/logos/leagues/GB1.png"), ("IT1", "data/logos/leagues/IT1.png")]
