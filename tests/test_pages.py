import pytest
from pyspark.sql import functions as F

from ratelake.operators import pages as H

# A ferry timetable and a club notice: own pages with every awkward piece of mark-up.
FERRIES = """<!doctype html><html><head><title>Island  ferries</title><script>if (1 < 2) { x = "<h2>"; }</script></head><body>
<header><h1>Timetable</h1></header><h4>North &amp; East pier</h4><ul><li>Valid from May<li>until the last sailing</ul>
<table><thead><tr><td>Leaves<td>Arrives<td></thead><tbody><tr><td>07:10<td>08:25</tr><tr><td></td></tr><tr><td>19:40<td> 20:55 </tr></tbody></table>
<table><tr><th>Fare</th></tr><tr><td>Adult<td>12</table><blockquote>Bicycles travel free</blockquote>
<div aria-hidden="true">unseen</div><div style="visibility: hidden">veiled</div><style>b{}</style><i hidden>lost</i>
</body></html>"""
CLUB = """<html><head><title>Club news</title></head><body><ol><li>Minutes: <a href="/minutes.PDF#page=2">read them</a>
<a href="  ">empty effective</a><li><a href="/board">Board</a> sets the <a href="/fees"> Rate of the year </a> in spring</ol>
<a>effective, without target</a></body></html>"""


def parsed(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")
    return H.parse_pages(df).orderBy("page_id")


def test_outline_and_text(spark):
    df = spark.createDataFrame([(0, FERRIES), (1, CLUB)], "page_id int, html string")
    ferries, club = H.page_outline(df).orderBy("page_id").collect()
    assert ferries.outline == """PAGE_TITLE: Island ferries
HEADINGS:
- H1: Timetable
- H4: North & East pier
TABLES:
- TABLE 1
  NEAR_HEADING: North & East pier
  HEADERS: Leaves | Arrives
  ROWS_SAMPLE:
    - 07:10 | 08:25
    - 19:40 | 20:55
  TEXT_NEAR_TABLE_SAMPLE: Valid from Mayuntil the last sailing
- TABLE 2
  NEAR_HEADING: North & East pier
  HEADERS: Fare
  ROWS_SAMPLE:
    - Adult | 12
  TEXT_NEAR_TABLE_SAMPLE: LeavesArrives07:1008:2519:40 20:55
LINKS:"""
    assert club.outline.split("LINKS:\n")[1] == """- TEXT: read them
  HREF: /minutes.PDF#page=2
  NEAR_TEXT: Minutes: empty effective
- TEXT: Rate of the year
  HREF: /fees
  NEAR_TEXT: Board sets the in spring"""
    for hidden in ("unseen", "veiled", "lost", "x =", "Island"):
        assert hidden not in ferries.visible_text


@pytest.mark.parametrize("n", [1000, 2000])
def test_output_is_linear_in_links(n):
    page = "<p>" + "".join(f"<a href='/{k}'>fuel {k}</a> text {k} " for k in range(n)) + "</p>"
    raw = H.parse_page(page)
    assert len(raw["links"]) == n and len(raw["parents"]) == 1
    assert sum(len(str(part)) for part in raw.values()) < 6 * len(page)


def test_only_wanted_parts():
    assert set(H.parse_page(FERRIES, ("title",))) == {"title"}


def test_limits(spark):
    many = "".join(f"<h1>{'' if i == 3 else i}</h1><a href='/{i}'>rate {i}</a><a href='/skip'>x</a>" for i in range(70))
    rows = "<table>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(9)) + "</table>"
    got = parsed(spark, many + rows * 20).select(
        H.headings(F.col("headings"), 50).alias("h"), H.links(F.col("links"), F.col("parents"), limit=50).alias("a"),
        H.tables(F.col("tables"), 15, 5).alias("t"), H.headings(F.col("headings")).alias("all_h"),
        H.links(F.col("links"), F.col("parents")).alias("all_a"), H.tables(F.col("tables")).alias("all_t"),
    ).first()
    assert len(got.h) == 49 and got.h[-1].text == "49"  # the empty heading counts, then drops out
    assert len(got.a) == 50 and got.a[-1].href == "/49"
    assert len(got.t) == 15 and len(got.t[0].rows) == 5 and got.t[0].rows[0] == "0"
    assert (len(got.all_h), len(got.all_a), len(got.all_t), len(got.all_t[0].rows)) == (69, 70, 20, 9)


def test_broken_pages(spark):
    html = ["", None, "<p>a<p>b", "plain", "<div><svg><path/><g></svg>after", "<ul><li>1<li>2</ul>", "</p><b>x</i>y"]
    got = [r.text for r in parsed(spark, *html).select(H.visible_text(F.col("text")).alias("text")).collect()]
    assert got == ["", "", "ab", "plain", "after", "12", "xy"]
