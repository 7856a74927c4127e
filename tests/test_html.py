"""Extraction rules on small and on broken pages."""

from marquee.operators import Field, extract_items, extract_record, extraction_counts
from marquee.plans import build_catalogue, clean_catalogue, extract_details, extract_listing, write_built
from marquee.sources import read_csv_files

ENTRY = "ipc-metadata-list-item__list-content-item"


def pages(spark, *htmls):
    return spark.createDataFrame(
        [(i, f"https://h/title/tt{i}/", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string"
    )


def links(*names):
    return "".join(f'<a class="{ENTRY}">{n}</a>' for n in names)


def detail(spark, html):
    return extract_details(pages(spark, html)).first()


def test_scan_against_a_walk():
    """What an end tag or a new element closes, against a walk through all open elements."""
    import random

    from marquee.operators.html import ENDS_PARAGRAPH, SCOPE, SIBLINGS, VOID, _Page

    draw = random.Random(1)
    tags = ["p", "li", "ul", "div", "td", "tr", "th", "table", "b", "i", "br", "option", "dd", "dt", "span"]
    for _ in range(400):
        marks = [(draw.random() < 0.4, draw.choice(tags)) for _ in range(draw.randrange(40))]
        page = _Page("x".join(f"<{'/' * end}{tag}>" for end, tag in marks) + "y")
        opened, end_of, n = [], [0], 0
        for ends, tag in marks:
            steps = [((tag,), ())] if ends and tag not in VOID else []
            if not ends:
                steps = [(("p",), SCOPE)] * (tag in ENDS_PARAGRAPH) + [(SIBLINGS.get(tag), SCOPE)] * (tag in SIBLINGS)
            for wanted, scope in steps:
                for at in range(len(opened) - 1, -1, -1):
                    if opened[at][1] in wanted:
                        for i, _ in opened[at:]:
                            end_of[i] = n
                        del opened[at:]
                        break
                    if opened[at][1] in scope:
                        break
            if not ends:
                n += 1
                end_of.append(n)
                if tag not in VOID:
                    opened.append((n, tag))
        for i in [0, *(i for i, _ in opened)]:
            end_of[i] = n
        assert page.end == end_of, marks


def test_broken_pages_take_linear_time():
    import time

    from marquee.operators.html import _Page

    n = 250_000
    start = time.process_time()
    page = _Page("<b>" * n + "</i>" * n + "<ul>" * n + "<li>x" * n + "</td>" * n)
    assert len(page.raw) == 3 * n + 1
    assert _Page("<a " * n).text(0) == "<a " * n
    assert len(_Page("</a " * n + "<p>x" + "<!-- " * n).raw) == 1
    assert time.process_time() - start < 60


def test_credits(spark):
    first = f'<li class="ipc-metadata-list__item">{links("D1", "D2")}</li>'
    second = f'<li class="x ipc-metadata-list__item">{links("W &amp; W")}</li>'
    row = detail(spark, first + second)
    assert (row["directors"], row["writers"], row["_errors"]) == (["D1", "D2"], ["W & W"], [])
    row = detail(spark, first)
    assert (row["directors"], row["writers"]) == (["D1", "D2"], None)
    assert len(row["_errors"]) == 1
    assert len(detail(spark, "<p>nothing")["_errors"]) == 2


def test_sections(spark):
    assert detail(spark, "<p>")["genres"] == []
    assert detail(spark, "<p>")["Languages"] == []
    assert detail(spark, "<p>")["countries_origin"] is None
    html = f"""
      <li data-testid="title-details-origin">{links("US", "FR")}</li>
      <div data-testid="interests"><span class="ipc-chip__text a">War</span><span class="ipc-chip__text">Epic</span></div>
      <li data-testid="title-boxoffice-budget"><span class="{ENTRY}">$1\u202f000\xa0(est)</span></li>
      <li data-testid="title-boxoffice-grossdomestic"></li>
      <li data-testid="title-details-releasedate">{links("July 18, 2008 (United States)")}</li>"""
    row = detail(spark, html)
    assert row["countries_origin"] == ["US", "FR"]
    assert row["genres"] == ["War", "Epic"]
    assert row["budget"] == "$1,000(est)"
    assert row["gross_US_Canada"] is None
    assert row["release_date"] == "July 18, 2008"
    assert sum(e.startswith("gross_US_Canada") for e in row["_errors"]) == 1


def test_awards(spark):
    def awards(label):
        return (f'<div data-testid="awards"><a class="ipc-metadata-list-item__label">{label}</a>'
                f'<span class="{ENTRY}">2 wins</span></div>')

    assert detail(spark, awards("Won 1 Oscar"))["awards_content"] == "Won 1 Oscar, 2 wins"
    assert detail(spark, awards(""))["awards_content"] == "2 wins"


def test_filming_locations(spark):
    def places(*items):
        inner = "".join(f'<li class="ipc-inline-list__item">{i}</li>' for i in items)
        return f'<li data-testid="title-details-filminglocations"><ul>{inner}</ul></li>'

    row = detail(spark, places("<a>Rome</a><span>(studio)</span>", "<a>Paris</a>"))
    assert row["filming_locations"] == ["Rome (studio)", "Paris"]
    assert detail(spark, places("<a>Rome</a>", "<span>no link</span>"))["filming_locations"] is None


def test_stars_limit_comes_before_filter(spark):
    cast = "".join(
        f'<div data-testid="title-cast-item">{"" if i == 3 else f"<a data-testid=title-cast-item__actor>S{i}</a>"}</div>'
        for i in range(12)
    )
    grid = ("ipc-sub-grid ipc-sub-grid--page-span-2 ipc-sub-grid--wraps-at-above-l ipc-shoveler__grid")
    row = detail(spark, f'<div class="{grid}">{cast}</div>')
    assert row["stars"] == [f"S{i}" for i in range(10) if i != 3]
    assert detail(spark, f'<div class="{grid} more">{cast}</div>')["stars"] is None


def item(n, spans=("1999", "1h 30m", "PG"), href=True):
    link = f'href="/title/tt{n}/?ref=1"' if href else ""
    return (
        f'<li class="ipc-metadata-list-summary-item"><h3 class="ipc-title__text">{n}. T{n}</h3>'
        f'<a class="ipc-lockup-overlay ipc-focusable" {link}>x</a>'
        f'<div class="dli-title-metadata">{"".join(f"<span>{s}</span>" for s in spans)}</div>'
        f'<span class="ipc-rating-star--voteCount">&nbsp;(1.2K)</span>'
        f'<div class="ipc-html-content-inner-div"> text\n</div>'
    )


def test_listing(spark):
    html = f'<ul class="ipc-metadata-list">{item(1)}{item(2, ("1999", "PG"))}{item(3, href=False)}</ul><ul>{item(4)}'
    listing = extract_listing(pages(spark, html, "<p>no list"), "https://h")
    found = [(r["Title"], r["Year"], r["Duration"], r["MPA"], r["Votes"], r["description"], r["Movie Link"])
             for r in listing.orderBy("_item").collect()]
    assert found == [
        ("1. T1", "1999", "1h 30m", "PG", "1.2K", "text", "https://h/title/tt1/?ref=1"),
        ("2. T2", "1999", "PG", None, "1.2K", "text", "https://h/title/tt2/?ref=1"),
    ]


def test_failed_rows_are_counted(spark):
    html = f'<ul class="ipc-metadata-list">{item(1)}{item(2, href=False)}</ul>'
    source = pages(spark, html, None).selectExpr("*", "1999 AS src_year")
    kept = extract_listing(source, "https://h", on_error="keep")
    r = extraction_counts(kept).first()
    assert (r["src_year"], r["rows"], r["errors"]) == (1999, 1, 2)


def test_broken_markup(spark):
    fields = [Field("t", "title"), Field("p", "p", many=True), Field("li", "li", many=True),
              Field("lang", "html", attr="lang"), Field("absent", "h1")]
    html = """<!DOCTYPE html><HTML lang=en><title>A &amp; &copy;</title><script>var t="</p><p>no</p>";</script>
      <p>one <b>two<br>three<p>four</b></p><ul><li>a<li>b<ul><li>c</ul></ul></div></nope><p>last"""
    row = extract_record(pages(spark, html), fields).first()
    assert row["t"] == "A & ©"
    assert row["p"] == ["one twothree", "four", "last"]
    assert row["li"] == ["a", "bc", "c"]
    assert (row["lang"], row["absent"], row["_errors"]) == ("en", None, [])


def test_hidden_text_and_nested_depth(spark):
    deep = "<div>" * 3000 + "x<style>no</style><script>no</script>y"
    row = extract_record(pages(spark, deep), [Field("d", "div")]).first()
    assert row["d"] == "xy"


def test_item_positions(spark):
    html = "<nav><a href=/1>a</a><a>b</a></nav><a href=/3>c</a>"
    df = extract_items(pages(spark, html), "a", [Field("self", "b"), ], "nav")
    assert [r["_item"] for r in df.orderBy("_item").collect()] == [0, 1]


def test_build(spark):
    listing = f'<ul class="ipc-metadata-list">{item(1)}{item(2)}{item(1)}</ul>'
    lists = spark.createDataFrame([(0, 1999, listing)], "page_id int, src_year int, html string")
    titles = spark.createDataFrame(
        [(f"https://h/title/tt{i}/?ref=1", f'<li data-testid="title-details-origin">{links("US")}</li>') for i in (1, 3)],
        "url string, html string",
    )
    built = build_catalogue(lists, titles, "https://h")
    assert built.details.count() == 1
    merged = built.merged.collect()
    assert [(r["Title"], r["countries_origin"]) for r in merged] == [("1. T1", ["US"])] * 2
    assert len(built.merged.columns) == 24  # 9 listing + 14 details + src_year


def test_built_tables_are_written_by_year(spark, tmp_path):
    def listing(year, *numbers):
        return (year, year, f'<ul class="ipc-metadata-list">{"".join(item(n) for n in numbers)}</ul>')

    lists = spark.createDataFrame([listing(1999, 1, 2), listing(2000, 1)], "page_id int, src_year int, html string")
    titles = spark.createDataFrame(
        [(year, f"https://h/title/tt{n}/?ref=1", f'<li data-testid="title-details-origin">{links("O\'B", "US")}</li>')
         for year, n in ((1999, 1), (1999, 2), (2000, 1), (2000, 7))],
        "src_year int, url string, html string",
    )
    rows = write_built(build_catalogue(lists, titles, "https://h"), str(tmp_path))
    assert rows == {"basic": 3, "advanced": 3, "merged": 3}
    found = read_csv_files(spark, [str(p) for p in sorted(tmp_path.glob("merged/*/part-*.csv"))])
    assert {(r["src_year"], r["Title"], r["countries_origin"]) for r in found.collect()} == {
        (y, t, '["O\'B", \'US\']') for y, t in ((1999, "1. T1"), (1999, "2. T2"), (2000, "1. T1"))
    }
    cleaned = clean_catalogue(found)
    assert {r["id"] for r in cleaned.select("id").collect()} == {"tt1", "tt2"}


def test_left_out_films_and_pages_are_told(spark):
    odd = f'<ul class="&#{"1" * 5000};"><li>x'
    lists = spark.createDataFrame(
        [(0, f'<ul class="ipc-metadata-list">{item(1)}{item(2, href=False)}</ul>'), (1, odd)], "page_id int, html string"
    )
    titles = spark.createDataFrame([("https://h/title/tt1/?ref=1", "<p>")], "url string, html string")
    built = build_catalogue(lists, titles, "https://h")
    assert built.listing.count() == 1
    assert sorted(r["page_id"] for r in built.failed_films.collect()) == [0, 1]
    assert built.failed_pages.count() == 0
    assert "_failed" not in built.merged.columns


def test_equal_tags_are_read_once_per_task(monkeypatch):
    from marquee.operators import html

    read = []
    plain = html._plain_tag
    monkeypatch.setattr(html, "_plain_tag", lambda source: read.append(source) or plain(source))
    reader = html._Reader([Field("p", "p.x", many=True)])
    for _ in range(3):
        values, errors, failed = reader.row(reader.page('<p class="x">a</p>' * 1000), 0)
        assert (values, errors, failed) == ([["a"] * 1000], [], False)
    assert read == ['p class="x"', "/p"]


def test_what_a_task_remembers_is_bounded():
    from marquee.operators import html

    reader = html._Reader([Field("a", "a[id=x]", attr="href"), Field("b", "b.x")])
    for k in range(3):
        many = "".join(f'<a id=x href="{k}-{n}"><b class="{n}">' for n in range(5000))
        assert reader.row(reader.page(f"<b class='x {'y' * 5000}'>{many}"), 0)[0] == [f"{k}-0", ""]
    kept = (reader._tags, reader._known, *(rule[-1] for rule in reader._rules.values()))
    assert all(len(m) <= html.REMEMBERED and max(map(len, m), default=0) <= html.LONGEST for m in kept)


def test_remembered_tags_depend_on_nothing_that_follows():
    """The same start of a tag, with a quote that ends or does not, on pages of one task."""
    from marquee.operators import html

    reader = html._Reader([Field("a", "a", attr="t", many=True), Field("text", "p"), Field("b", "b", many=True)])

    def read(text):
        values, errors, _ = reader.row(reader.page(text), 0)
        return values, errors

    assert read('<p><a t="x>1</a>') == ([[""], "1", []], [])
    assert read('<p><a t="x>1">2</a>') == ([["x>1"], "2", []], [])
    assert read('<p><a t="x<b>1">2</a><b>3') == ([["x<b>1"], "23", ["3"]], [])
    assert read("<p>1 < 2 <b<i>3</b> <b>4</b>") == ([[], "1 < 2 3 4", ["4"]], [])
    assert read("<p>1<!-- <b>no</b> -->2<script>'<b>no</b>'</script>3<b>4") == ([[], "1234", ["4"]], [])


def test_attributes_that_cannot_be_read_count_where_they_are_reached(spark):
    odd = f'<b class="&#{"1" * 5000};">odd</b>'
    fields = [Field("first", "b.x"), Field("second", "b.x", nth=1), Field("third", "b.y")]
    row = extract_record(pages(spark, f'<b class="x">1</b>{odd}<b class="x">2</b>'), fields).first()
    assert (row["first"], row["second"], row["third"]) == ("1", None, None)
    assert [e.split(":")[0] for e in row["_errors"]] == ["second"]


def test_attributes_of_an_element_are_read_once(monkeypatch):
    from marquee.operators import html

    read = []
    plain = html._read_attributes
    monkeypatch.setattr(html, "_read_attributes", lambda raw, into: read.append(raw) or plain(raw, into))
    reader = html._Reader([Field("href", "a.x", attr="href", many=True), Field("first", "a.x", attr="href")])
    page = reader.page("".join(f'<a class="x" href="/{k}">' for k in range(100)))
    assert reader.row(page, 0)[0] == [[f"/{k}" for k in range(100)], "/0"]
    assert len(read) == 100


def test_pages_read_together_give_what_each_gives_alone():
    import random

    from marquee.operators import html

    draw = random.Random(2)
    unreadable = f"&#{'1' * 5000};"
    fields = [
        Field("p", "p"), Field("b", "b.x", nth=1, required=True), Field("in_li", "b", within="li", within_nth=1, default="d"),
        Field("all", "b", within="ul", many=True, limit=2, default=()), Field("each", "b", each="li", skip=True, extra="i"),
        Field("href", "a", attr="href", fatal=True), Field("both", "p", extra="b.x", sep="; "),
    ]
    marks = ["<p>", "</p>", "<ul>", "</ul>", "<li>", "<b class=x>", '<b class="x y">', "</b>", "<i>1</i>", '<a href="?a=1&amp;b">',
             "<a>", "</a>", "t", "&lt;", "&copy", "<!-- <b> -->", "<br/>"]
    pages = ["".join(draw.choices(marks, k=draw.randrange(30))) for _ in range(300)]
    odd_pages = {7: f'<b class="x{unreadable}">', 40: f"<p>{unreadable}", 41: f'<a href="{unreadable}">'}
    for k, mark in odd_pages.items():
        pages[k] = mark + pages[k]
    reader = html._Reader(fields)
    together = reader.page(pages[0])
    tops = [0, *(together.add(text) for text in pages[1:])]
    odd = set()
    columns, errors, failed = reader.columns(together, tops, odd)
    assert sorted({max(k for k, top in enumerate(tops) if top <= i) for i in odd}) == sorted(odd_pages)
    for k, text in enumerate(pages):
        if k not in odd_pages:
            assert ([c[k] for c in columns], errors[k], failed[k]) == html._Reader(fields).row(html._Page(text), 0), text


def test_unreadable_pages_among_others(spark):
    """Pages that are read alone stay in their place, with their items and errors."""
    broken = f'<ul class="&#{"1" * 5000};"><li><a href="n">'
    texts = [None if k % 10 == 4 else broken if k % 10 == 3 else f'<ul class="x"><li><a href="{k}">{k}</a><li>b</ul>' for k in range(600)]
    fields = [Field("href", "a", attr="href", fatal=True), Field("label", "a")]
    rows = extract_items(pages(spark, *texts).coalesce(1), "li", fields, "ul.x", ("page_id",), on_error="keep").collect()
    expected = [
        (k, n, v, v, failed) for k in range(600)
        for n, v, failed in ([(-1, None, True)] if k % 10 in (3, 4) else [(0, str(k), False), (1, None, False)])
    ]
    assert [(r["page_id"], r["_item"], r["href"], r["label"], r["_failed"]) for r in rows] == expected
    assert extract_items(pages(spark, *texts), "li", fields, "ul.x", ("page_id",)).count() == 960
