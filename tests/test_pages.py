import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tierflow import schemas
from tierflow.plans import lakehouse
from tierflow.sources import pages as pg
from tierflow.sources.markup import Page, finished
from tierflow.workloads import feeds
from tierflow.workloads.queries import QUERIES

FETCHED = datetime(2026, 3, 10, 22, 5, 9)

ALERT = '<p class="a truncate"> Smog </p>'
BADGE = '<div class="card aqi-bg-yellow"><p class="text-lg font-medium">75*</p><p class="font-body-l-medium">Moderate</p></div>'
DETAILS = '<div class="font-body-m-medium"><p>Main pollutant</p><p>PM2.5</p><p>16.9&nbsp;µg/m³</p></div>'
CARD = (
    '<div class="w-4 bg-white"><div><img alt="weather condition icon" src="/i/weather-10d.svg"></div>'
    '<p>30°</p><p> 15 km/h </p><p>70%</p><img alt="wind direction icon" style="transform: rotate(90deg)"></div>'
)
HEADING = "<h2>Now • 14:00, Mar 10 Local time</h2>"
PARTS = [ALERT, BADGE, DETAILS, CARD, HEADING]


def stored(spark, *htmls):
    data = [("u", "west-java", "depok", html, FETCHED) for html in htmls]
    return spark.createDataFrame(data, schemas.STORED_PAGES)


def current(spark, html):
    return pg.current_rows(stored(spark, html)).first().asDict()


FULL = {
    "province": "West Java", "city": "Depok", "aqi": "75*", "aqi_status": "Moderate",
    "main_pollutant": "PM2.5", "concentration": "16.9 µg/m³", "weather": "Rain",
    "temperature": "30°", "humidity": "70%", "wind_speed": "15 km/h", "wind_direction": "West",
    "alert": "Smog", "observation_ts": "14:00, Mar 10", "scraped_ts": "2026-03-10 22:05:09",
}


def test_current_page(spark):
    assert current(spark, "".join(PARTS)) == FULL
    assert pg.current_rows(stored(spark, "")).columns == schemas.RAW_ACTUAL.names


@pytest.mark.parametrize("missing, changed", [
    (ALERT, {"alert": "No Alert"}),
    (BADGE, {"aqi": "N/A", "aqi_status": "N/A"}),
    (DETAILS, {"main_pollutant": "N/A", "concentration": "N/A"}),
    (CARD, {"weather": "N/A", "temperature": "N/A", "humidity": "N/A", "wind_speed": "N/A", "wind_direction": "N/A"}),
    (HEADING, {"observation_ts": "N/A"}),
])
def test_missing_parts_get_defaults(spark, missing, changed):
    assert current(spark, "".join(p for p in PARTS if p != missing)) == FULL | changed


def test_awkward_current_pages(spark):
    got = [r.asDict() for r in pg.current_rows(stored(
        spark, '<p class="truncate">NOW</p>', None, "plain text", "<div><p class='truncate'>open",
        '<div class="font-body-m-medium"><p>only one</p></div><h2>seen a while ago somewhere</h2>',
        '<img alt="weather condition icon" src="/i/weather-77.svg">',
    )).collect()]
    assert [r["alert"] for r in got] == ["No Alert", "No Alert", "No Alert", "open", "No Alert", "No Alert"]
    assert got[4]["main_pollutant"] == "N/A" and got[4]["observation_ts"] == "hile ago somewhere"[-15:].strip()
    assert got[5]["weather"] == "Unknown (77)" and got[5]["temperature"] == "N/A"


def cell(clock, icon="ic-w-01d.svg", aqi="55", temp="29°", metrics=("8 km/h", "60%")):
    body = f'<p class="max-w-12">{clock}</p>' if clock is not None else ""
    body += f'<img src="/i/{icon}">' if icon else ""
    body += f'<div class="aqi-bg-green">{aqi}</div>' if aqi else ""
    body += f'<p class="font-medium">{temp}</p>' if temp else ""
    for metric in metrics:
        inner = "" if metric is None else f'<p class="font-medium">{metric}</p>'
        body += f'<div class="flex flex-col items-center">{inner}</div>'
    return f"<td>{body}</td>"


def forecast(spark, *cells):
    return pg.forecast_cells(stored(spark, f"{HEADING}<table><tr>{''.join(cells)}</tr></table>"))


def test_forecast_rolls_over_midnight(spark):
    cells = forecast(spark, cell("Now"), cell("23:00"), cell("00:00"), cell("01:00"))
    got = pg.forecast_rows(cells)
    assert got.columns == schemas.RAW_FORECAST.names
    assert [r.forecast_ts for r in got.collect()] == [
        "2026-03-10 22:00:00", "2026-03-10 23:00:00", "2026-03-11 00:00:00", "2026-03-11 01:00:00"
    ]
    assert got.first().asDict() == {
        "province": "West Java", "city": "Depok", "forecast_ts": "2026-03-10 22:00:00", "aqi": "55",
        "weather": "Clear Sky", "temperature": "29°", "wind_speed": "8 km/h", "humidity": "60%",
        "observation_ts": "14:00, Mar 10", "scraped_ts": "2026-03-10 22:05:09",
    }


def test_a_rejected_cell_still_moves_the_date(spark):
    cells = forecast(spark, cell("23:00"), cell(None), cell("x"), cell("00:00", metrics=(None, "5%")), cell("01:00"))
    assert [r.forecast_ts for r in pg.forecast_rows(cells).collect()] == ["2026-03-10 23:00:00", "2026-03-11 01:00:00"]
    bad = pg.quarantine(cells).select("pos", "clock", "error").collect()
    assert [tuple(r) for r in bad] == [(2, "x", "unreadable hour"), (3, "00:00", "metric without a value")]


def test_forecast_defaults(spark):
    cells = forecast(
        spark, cell("1:00", icon=None, aqi=None, temp=None, metrics=()), cell("2:00", icon="one-two.svg"),
        cell("3:00", icon="a-b-77.svg", metrics=("1 km/h",)),
    )
    got = [tuple(r) for r in pg.forecast_rows(cells).select("weather", "aqi", "temperature", "wind_speed", "humidity").collect()]
    assert got == [
        ("Unknown", "N/A", "N/A", "-", "-"), ("Error Parsing Code", "55", "29°", "8 km/h", "60%"),
        ("Code 77", "55", "29°", "1 km/h", "-"),
    ]


def test_pages_without_table_give_no_cells(spark):
    assert pg.forecast_cells(stored(spark, HEADING, None)).count() == 0


def test_falls():
    assert pg.falls([22, 23, 0, 1, 2, 23, 0]) == [0, 0, 1, 1, 1, 1, 2]
    assert pg.falls([]) == []


def test_page_info(spark):
    html = '<html lang="id"><title> T &amp; x </title><a href="/indonesia"> Land </a><h1> Air quality in Depok </h1></html>'
    got = pg.page_info(stored(spark, html, "<h1>Bogor</h1>")).select("lang", "title", "country", "city_named").collect()
    assert [tuple(r) for r in got] == [("id", "T & x", "Land", "Depok"), (None, None, "Indonesia", "Bogor")]


def test_references_cut_short(spark, tmp_path):
    html = "<html lang=\"en\"><title>A &amp; B&amp</title><body><h1>A &amp; B &am&lt;&#39;&amp</h1></body></html>"
    got = pg.page_info(stored(spark, html)).first()
    assert (got["title"], got["city_named"]) == ("A & B&", "A & B &am<'&")
    spark.createDataFrame([(n, "u", html) for n in range(4)], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet")
    for row in QUERIES["pages_extract"](spark, str(tmp_path)).collect():
        assert (row["title"], row["city_named"]) == ("A & B&amp", "A & B &am<'&amp")


def test_items(spark):
    html = '<ul><li><a href="/a">A</a></li><li>none</li><li><a>B</a></li></ul>'
    items = pg.page_items(stored(spark, html)).select("pos", "href", "label", "error").collect()
    assert [tuple(r) for r in items] == [(0, "/a", "A", None), (2, None, "B", "link without target or label")]


def test_markup_spans():
    page = Page('<div id=a><p>x<br>y<p>z</div><script>var t="<p>no</p>";</script><p class="k  j">w')
    assert [page.text(p) for p in page.below(None, "p")] == ["xyz", "z", "w"]
    assert page.first(None, "p", exact="k j") is not None
    assert page.first(page.first(None, "div"), "p", token="k") is None
    assert page.text(None) is None


def test_unreadable_pages_are_put_aside(spark):
    """A marked section of an unknown kind stops the parser; the other pages go on."""
    pages = stored(spark, "".join(PARTS), "<![foo bar]]>" + "".join(PARTS), None)
    assert pg.current_rows(pages).count() == 2
    assert pg.forecast_cells(pages).count() == 0
    for feed in ("current", "forecast"):
        failed = pg.page_quarantine(pages, feed).collect()
        assert [r.feed for r in failed] == [feed] and failed[0].html.startswith("<![foo") and failed[0].error


def test_now_without_a_fetch_time(spark):
    pages = spark.createDataFrame(
        [("u", "p", "c", f"<table><tr>{cell('Now')}{cell('15:00')}</tr></table>", None)], schemas.STORED_PAGES)
    assert [(r.clock, r.error) for r in pg.forecast_cells(pages).collect()] == [("Now", "unreadable hour"), ("15:00", None)]


def test_unfinished_and_unmatched_tags_take_linear_time():
    import time

    start = time.perf_counter()
    for html in ("<a " * 100_000, "<div>" * 50_000 + "</x>" * 50_000, "<i>" * 50_000 + "</b>" * 50_000 + "text",
                 '<a href="x' * 50_000, "<a title='" * 50_000 + '"' * 50_000):
        Page(html)
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("html, same", [
    ("<p class='a'>x</p>", True), ('<p title="a<b>c">x</p>', True), ("<p title='a > \" < b' id=x>x</p>", True),
    ("a < b <c d>", True), ("<!-- <p --> <p>x</p>", True), ("<i <b>x</b>", False), ("<a <p class='k'>x</p>", False), ("<p x='", True), ("", True),
])
def test_finished_tags(html, same):
    assert (finished(html) == html) == same
    if "class='k'" in html:
        page = Page(html)
        assert page.text(page.first(None, "p", token="k")) == "x"


def test_pages_are_parsed_once(spark, tmp_path, rows):
    broken = "<![foo bar]]><p>no page</p>"
    cell = '<td><p class="max-w-12">--</p></td><td><p class="max-w-12">05:00</p><div class="flex flex-col items-center">x</div></td>'
    pages = stored(spark, "".join(PARTS), broken, f"<table><tr>{cell}</tr></table>", None)
    parsed = pg.parsed_pages(pages).cache()
    assert rows(pg.parsed_current(parsed)) == rows(pg.current_rows(pages))
    assert rows(pg.parsed_cells(parsed)) == rows(pg.forecast_cells(pages))
    want = rows(pg.page_quarantine(pages, "current").unionByName(pg.page_quarantine(pages, "forecast")))
    assert rows(pg.parsed_quarantine(parsed)) == want and len(want) == 2
    got = lakehouse.load_pages(pages, str(tmp_path))
    assert got == {
        "pages": 4, "current_read": 3, "current_rejected": 1, "forecast_rejected": 1, "cells_read": 0, "cells_unreadable_hour": 1,
        "cells_metric_without_value": 1, "cells_other": 0, "raw_aqi_index": 3, "raw_weather_forecast": 0, "page_quarantine": 2,
    }
    assert lakehouse.load_pages(pages.limit(0), str(tmp_path))["pages"] == 0


def test_long_reasons_are_kept_whole(spark):
    def fail(row):
        raise ValueError("x" * 2000)

    got = pg.read_pages(stored(spark, "a"), fail, pg.PAGE_RECORD).first()
    assert got.page_error == "ValueError: " + "x" * 2000


#: What the tokenizer refuses, in an article of its own.
REFUSED = ["<![foo bar]]>", "<![>", "<![ endif]>", "&#" + "9" * 5000 + ";", '<i title="&#' + "9" * 5000 + ';">']


def test_no_page_is_missing_from_a_result(spark, tmp_path):
    """Pages that a strict tokenizer refuses have their rows in results without a quarantine."""
    page = '<html lang="en"><title>T%d</title><body>%s<h1>H%d</h1><ul><li><a href="/a">A%d</a></li></ul>'
    htmls = [page % (n, odd, n, n) for n, odd in enumerate(["", *REFUSED])]
    spark.createDataFrame([(n, "u", html) for n, html in enumerate(htmls)], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet")
    got = QUERIES["pages_extract"](spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.page_id, r.lang, r.title, r.city_named) for r in got] == [(n, "en", f"T{n}", f"H{n}") for n in range(6)]
    items = QUERIES["pages_extract_items"](spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.page_id, r.pos, r.href, r.label) for r in items] == [(n, 0, "/a", f"A{n}") for n in range(6)]
    for html in REFUSED:
        with pytest.raises(pg.UNREADABLE):
            Page(html)


@pytest.mark.parametrize("number, sign", [
    ("9" * 5000, "\ufffd"), ("0" * 5000 + "65", "A"), ("0" * 5000, "\ufffd"), ("0" * 5000 + "128512", "\U0001f600"), ("65", "A"),
])
def test_references_of_any_length(number, sign):
    assert Page(f"<p>x&#{number};y", lenient=True).texts == [f"x{sign}y"]


@pytest.mark.parametrize("problem", [MemoryError, KeyError, TypeError, RuntimeError, OSError])
def test_failures_of_the_job_are_no_results(spark, monkeypatch, problem):
    """Only what a page does to the tokenizer is put aside; other errors stop the job."""
    def fail(*_, **__):
        raise problem("lost")

    pages = stored(spark, "<p>x")
    with pytest.raises(Exception, match="lost"):
        pg.read_pages(pages, fail, pg.PAGE_RECORD).collect()
    for name in ("read_current", "read_forecast", "read_page_info", "read_items", "current_part"):
        monkeypatch.setattr(pg, name, fail)
    with pytest.raises(problem):
        pg.read_both({"html": "<p>x", "fetch_hour": 1})
    for made in (pg.current_rows(pages), pg.forecast_cells(pages), pg.page_quarantine(pages, "current"),
                 pg.page_quarantine(pages, "forecast"), pg.page_info(pages), pg.page_items(pages)):
        with pytest.raises(Exception, match="lost"):
            made.collect()


@pytest.mark.parametrize("problem", [AssertionError, ValueError])
def test_results_without_a_quarantine_leave_out_nothing(spark, monkeypatch, problem):
    def fail(row):
        raise problem("lost")

    for name in ("read_page_info", "read_items"):
        monkeypatch.setattr(pg, name, fail)
    for made in (pg.page_info(stored(spark, "<p>x")), pg.page_items(stored(spark, "<p>x"))):
        with pytest.raises(Exception, match="lost"):
            made.collect()


def test_page_jobs_use_all_cores(spark):
    for make in (feeds.current_pages, feeds.forecast_pages):
        pages = make(spark, "/root/testdata/sf0.01")
        assert pages.select(F.spark_partition_id().alias("p")).distinct().count() >= spark.sparkContext.defaultParallelism


def test_records_are_handed_on_in_parts(spark):
    """However many rows an Arrow batch has, few records exist at a time."""
    class Record(dict):
        alive = 0

        def __init__(self):
            Record.alive += 1
            super().__init__(alive=Record.alive)

        def __del__(self):
            Record.alive -= 1

    pages = stored(spark, *["<p>"] * (4 * pg.PAGES_AT_ONCE + 3)).coalesce(1)
    read = pg.read_pages(pages, lambda row: Record(), T.StructType().add("alive", "integer"))
    got = read.agg(F.count("record.alive").alias("n"), F.max("record.alive").alias("most")).first()
    assert (got["n"], got["most"]) == (4 * pg.PAGES_AT_ONCE + 3, pg.PAGES_AT_ONCE)


def test_quarantine_returns_only_the_texts_that_failed(spark):
    seen = pg.page_quarantine(stored(spark, "<p>x", "<![foo bar]]><p>", None), "forecast").collect()
    assert [(r["html"], r["error"].split(":")[0]) for r in seen] == [("<![foo bar]]><p>", "AssertionError")]


def test_plain_markup_is_read_without_the_tokenizer(monkeypatch):
    """Plain tags and texts give the same elements and texts, whoever reads them."""
    class Tokenized(Page):
        def _plain(self, html):
            return 0

    def view(kind, html):
        try:
            page = kind(html)
        except AssertionError:
            return None
        return page.texts, [
            (e.name, e.attrs, e.tokens, e.parent and e.parent.at, e.last, e.first_text, e.last_text) for e in page.elements]

    pieces = [
        "<p>", "</p>", '<div class="a b">', "</div>", "t", "a &amp; b", "&amp", "&", "<br>", "<br/>", '<img src="x" alt="">',
        "<script>", "</script>", "<title>", "</title>", "<xmp>", "<!-- c -->", "<!DOCTYPE html>", "<![foo bar]]>", "<", ">",
        '"', "='", "<a href=x", '<A HREF="q">', "</A >", '<td x="1" x="2">', "\n", "</", "&#39;", "if(a<b=\"",
    ]
    choice = random.Random(3)
    for _ in range(3000):
        html = "".join(choice.choices(pieces, k=choice.randint(1, 12)))
        assert view(Page, html) == view(Tokenized, html), html

    plain = '<!DOCTYPE html><title>a &amp; b</title><td><p class="k">1 &lt; 2</p><br></td><script>1 > 0</script>'
    want = view(Tokenized, plain)
    monkeypatch.setattr(Page, "feed", lambda self, html: pytest.fail("the tokenizer was used"))
    assert view(Page, plain) == want
