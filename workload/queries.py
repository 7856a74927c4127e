"""One Spark query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import functions as mf
from marquee import operators as op
from marquee import plans
from marquee.operators.quality import validate
from marquee.sinks import shared_folder, stage, write_arrow, write_duplicates, write_outputs, write_yearly
from marquee.sources import list_year_files, read_csv, read_csv_files, read_pages, scan_csv_files, scan_years, spread
from marquee.streaming import current_catalogue, merge_batch, refresh_catalogue
from workload.frames import DATES, details, movies, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _folder(df: DataFrame, name: str) -> str:
    import uuid

    return f"{shared_folder(df).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- text -------------------------------------------------------------------

@query
def trim_and_null_tokens(spark, sf):
    padded = F.concat(F.chr(F.lit(160)), F.col("MPA"), F.lit("\t "))
    return movies(spark, sf).select(
        "pos",
        mf.trim_ws(padded).alias("trimmed"),
        mf.null_tokens(padded).alias("cleaned"),
        mf.is_null_token(F.col("MPA")).alias("is_null_token"),
        mf.norm_text(padded).alias("normal"),
    )


@query
def na_tokens_on_read(spark, sf):
    return movies(spark, sf).select("pos", mf.null_if_in(F.col("MPA")).alias("mpa"))


@query
def clean_title(spark, sf):
    return movies(spark, sf).select("pos", mf.clean_title(F.col("Title")).alias("title"))


@query
def id_from_url(spark, sf):
    link = mf.clean_link(F.col("link"))
    return movies(spark, sf).select("pos", link.alias("movie_link"), mf.extract_id(link).alias("id"))


@query
def strip_query(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")
    return pages.select("page_id", mf.clean_link(F.col("url")).alias("url"))


@query
def money_text(spark, sf):
    gross = F.col("gross_US_Canada")
    return movies(spark, sf).select(
        "pos", mf.clean_money(gross).alias("gross"), mf.money_amount(gross).cast("double").alias("amount")
    )


@query
def crawl_text(spark, sf):
    return movies(spark, sf).select(
        "pos",
        mf.strip_parens(F.concat(F.lit(" ("), F.col("Votes"), F.lit(") "))).alias("votes"),
        mf.before(F.concat(F.col("release_date"), F.lit(" (USA)")), " (").alias("release_date"),
        mf.absolute_url(F.col("Duration"), "https://ex.example/").alias("url"),
    )


# --- lists ------------------------------------------------------------------

@query
def list_text_guard(spark, sf):
    return movies(spark, sf).select(
        "pos",
        mf.list_text_or_null(F.col("genres")).alias("genres"),
        mf.malformed_list(F.col("genres")).alias("malformed"),
    )


@query
def list_round_trip(spark, sf):
    items = mf.text_to_list(mf.list_text_or_null(F.col("genres")))
    return movies(spark, sf).select(
        "pos", F.array_join(items, "|").alias("items"), mf.list_to_text(items).alias("printed")
    )


@query
def list_explode_distinct(spark, sf):
    items = movies(spark, sf).select(mf.text_to_list(mf.list_text_or_null(F.col("genres"))).alias("genre"))
    return op.distinct_values(items, "genre", flatten=True)


# --- numbers and dates ------------------------------------------------------

@query
def parse_rating_score(spark, sf):
    return movies(spark, sf).select(
        "pos",
        mf.parse_rating(F.col("Rating")).alias("rating"),
        mf.parse_score(F.col("meta_score")).alias("score"),
    )


@query
def release_date(spark, sf):
    day = mf.parse_release_date(F.col("release_date"))
    return movies(spark, sf).select(
        "pos", day.alias("parsed"),
        mf.date_or_year(day, F.col("Year")).alias("filled"),
        mf.date_or_year(day, F.col("Year"), lenient=True).alias("lenient"),
    ).select("pos", _day("parsed"), _day("filled"), _day("lenient"))


def _dates(spark, sf):
    return spark.sql(DATES, orders=table(spark, sf, "orders"))


@query
def date_shapes(spark, sf):
    return _dates(spark, sf).select("pos", mf.parse_release_date(F.col("text")).alias("day")).select("pos", _day("day"))


@query
def unread_date_shapes(spark, sf):
    return op.unread_dates(_dates(spark, sf), "text")


@query
def duration_minutes(spark, sf):
    minutes = mf.duration_minutes(F.col("Duration"))
    return movies(spark, sf).select(
        "pos", mf.is_duration(F.col("Duration")).alias("known"), minutes.alias("minutes"),
        mf.duration_ok(minutes).alias("ok"),
    )


@query
def swap_misplaced_rating(spark, sf):
    df = movies(spark, sf)
    bad = mf.misplaced_rating(F.col("Duration"), F.col("MPA"))
    return op.swap_where(df, "Duration", "MPA", bad).select("pos", "Duration", "MPA")


@query
def rating_group_min_age(spark, sf):
    group = mf.rating_group(F.col("MPA"))
    return movies(spark, sf).select(
        "pos", group.alias("grp"), mf.rating_min_age(group).alias("min_age"),
        mf.rating_min_age_int(group).alias("min_age_int"),
    )


@query
def number_cells(spark, sf):
    """Durations and votes that a source delivers as numbers."""
    rows = movies(spark, sf).select(
        "pos", (F.col("pos") % 300 + 0.75).cast("double").alias("d"), F.when(F.col("pos") % 7 > 0, F.col("pos") * 2.5e3).alias("v")
    )
    return rows.select("pos", mf.duration_minutes(F.col("d")).alias("minutes"), mf.parse_votes(F.col("v")).alias("votes"))


@query
def normalise_wide_values(spark, sf):
    """Values that no narrow type holds; none may stop the job."""
    pos = F.col("pos")
    wide = _analysis_input(spark, sf).withColumns({
        "meta_score": (pos * 1_000).cast("double"), "year": (pos + 40_000).cast("string"),
        "duration": (pos * 100_000_000).cast("string"), "votes": pos * 1.0e9,
    })
    df = plans.normalise_catalogue(wide, strict=False)
    return df.select("pos", *(F.col(c).cast("bigint").alias(c) for c in ("year", "duration", "votes", "meta_score")))


@query
def votes_parse(spark, sf):
    return movies(spark, sf).select("pos", mf.parse_votes(F.col("Votes")).alias("votes"))


@query
def rating_grid(spark, sf):
    r = F.coalesce(mf.parse_rating(F.col("Rating")), F.lit(-1.0))
    halves = F.when(F.col("pos") % 7 == 0, r + 0.05).otherwise(r)  # some values off the grid
    return movies(spark, sf).select("pos", mf.rating_code(halves).alias("code"))


@query
def missing_flags(spark, sf):
    r = F.coalesce(mf.parse_rating(F.col("Rating")), F.lit(-1.0))
    return movies(spark, sf).select("pos", mf.missing_flag(r, mf.parse_votes(F.col("Votes"))).alias("missing"))


@query
def year_to_number(spark, sf):
    return movies(spark, sf).select("pos", mf.to_number(F.col("Year"), strict=False).alias("year"))


@query
def fit_integer_types(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    narrow = op.narrow_ints(df, ["l_linenumber", "l_suppkey"], mode="fit")
    return narrow.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_suppkey").alias("suppkeys"), F.max("l_partkey").alias("top_part")
    ).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


# --- columns and unions -----------------------------------------------------

@query
def rename_and_lead(spark, sf):
    renamed = op.rename_columns(
        table(spark, sf, "orders"), {"o_orderkey": "id", "o_orderpriority": "title", "absent": "x"}
    )
    return op.lead_columns(renamed, ["id", "title"]).drop("o_orderdate")


@query
def union_drifted_years(spark, sf):
    df = movies(spark, sf)
    old = df.filter("src_year < 1998").select("pos", F.col("pos").alias("Votes"), "Title")
    new = df.filter("src_year >= 1998").select("Votes", "pos", "Title", "MPA")
    return op.union_relaxed([old, new])


@query
def analysis_names(spark, sf):
    v2 = plans.to_catalogue_v2(plans.clean_catalogue(movies(spark, sf)))
    return v2.select("pos", "id", "MPA", "meta_score", "year")


# --- joins ------------------------------------------------------------------

def _linked(spark, sf):
    df = movies(spark, sf)
    return df.select("pos", "src_year", "Title", mf.clean_link(F.col("link")).alias("Movie Link"))


@query
def merge_listing_details(spark, sf):
    merged = op.merge_details(_linked(spark, sf), details(spark, sf), per_year=False)
    return merged.withColumnRenamed("Movie Link", "movie_link")


@query
def merge_details_null_safe(spark, sf):
    merged = op.merge_details(_linked(spark, sf), details(spark, sf), per_year=False, null_safe=True)
    return merged.withColumnRenamed("Movie Link", "movie_link")


@query
def merge_within_year(spark, sf):
    years = movies(spark, sf).select("src_year", mf.clean_link(F.col("link")).alias("link")).distinct()
    merged = op.merge_details(_linked(spark, sf), years.withColumn("seen", F.lit(True)))
    return merged.withColumnRenamed("Movie Link", "movie_link")


@query
def lookup_nation(spark, sf):
    customer = table(spark, sf, "customer").withColumn("key", F.col("c_nationkey") + 3)
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    return op.lookup(customer.select("c_custkey", "key"), nation, "key", {"n_name": "unknown"})


@query
def pages_semi_listing(spark, sf):
    pages = table(spark, sf, "documents").withColumnRenamed("doc_id", "url")
    listing = table(spark, sf, "labels").select(F.col("doc_id").alias("Movie Link"))
    return op.restrict_pages(pages, listing).select(F.col("url").alias("doc_id"), "lang", "n_chars")


@query
def pages_semi_listing_hot(spark, sf):
    """The same with every repeated key treated as hot."""
    pages = table(spark, sf, "orders").withColumnRenamed("o_custkey", "url")
    listing = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Movie Link"))
    kept = op.restrict_pages(pages, listing, max_broadcast=0, hot_rows=2)
    return kept.select("o_orderkey", F.col("url").alias("o_custkey"))


# --- duplicates and ranks ---------------------------------------------------

def _identified(spark, sf):
    df = movies(spark, sf)
    return df.select("pos", "src_year", mf.extract_id(mf.clean_link(F.col("link"))).alias("id"),
                     mf.clean_title(F.col("Title")).alias("title"))


@query
def keep_last_by_id(spark, sf):
    return op.keep_last(_identified(spark, sf), "id", ["pos"])


@query
def keep_last_keep_null(spark, sf):
    return op.keep_last(_identified(spark, sf), "id", ["pos"], keep_null=True)


@query
def duplicate_report(spark, sf):
    return op.duplicate_report(_identified(spark, sf))


@query
def duplicate_titles(spark, sf):
    return op.duplicate_titles(_identified(spark, sf))


@query
def duplicate_pieces(spark, sf):
    """Titles of the duplicate ids in pieces of some 60 bytes."""
    return op.duplicate_pieces(_identified(spark, sf), piece_bytes=60, hot_rows=5)


@query
def duplicate_rows(spark, sf):
    return op.all_duplicates(_identified(spark, sf), "title", hot_rows=3)


@query
def top600_per_year(spark, sf):
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    best = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return op.top_per_group(orders, "y", best, 600).select("o_orderkey", "y", "o_totalprice")


@query
def top_grossing(spark, sf):
    cleaned = plans.clean_catalogue(movies(spark, sf))
    return plans.top_grossing(cleaned, n=100).select("pos", "src_year", "gross_us_canada")


# --- counts and summaries ---------------------------------------------------

@query
def value_counts_top20(spark, sf):
    return op.value_counts(movies(spark, sf), "Votes", top=20)


@query
def value_counts_all(spark, sf):
    return op.value_counts(table(spark, sf, "events"), "event_type")


@query
def value_dups(spark, sf):
    return op.value_counts(table(spark, sf, "part"), "p_name", min_count=2)


@query
def group_size_nulls(spark, sf):
    return op.group_sizes(movies(spark, sf), ["Duration", "MPA"])


@query
def distinct_durations(spark, sf):
    return op.distinct_values(movies(spark, sf), "Duration")


@query
def null_counts(spark, sf):
    return op.null_counts(movies(spark, sf))


@query
def null_rows(spark, sf):
    return op.null_rows(movies(spark, sf), "Rating").select("pos", "Title")


@query
def missing_stats(spark, sf):
    stats = op.missing_stats(plans.clean_catalogue(movies(spark, sf)))
    return stats.select(*(F.round(f"`{c}`", 6).alias(c.replace("é", "e")) for c in stats.columns))


@query
def missing_critical(spark, sf):
    stats = op.missing_stats(plans.clean_catalogue(movies(spark, sf)))
    return op.missing_critical(stats).select("column", F.round("percent", 6).alias("percent"))


@query
def validate_raw(spark, sf):
    raw = movies(spark, sf).select(F.col("Rating").alias("rating"), F.col("meta_score").alias("méta_score"), "genres")
    return validate(raw).select(
        "check", F.regexp_replace("column", "é", "e").alias("column"), "n_bad",
        F.array_join("sample", "|").alias("sample"),
    )


@query
def final_summary(spark, sf):
    df = plans.normalise_catalogue(_analysis_input(spark, sf), strict=False)
    summary = op.final_summary(df)
    return summary.withColumn("success_rate", F.round("success_rate", 6))


@query
def distinct_counts(spark, sf):
    df = movies(spark, sf)
    return df.agg(op.count_distinct(df, "Title").alias("titles"), op.count_distinct(df, "link").alias("links"))


# --- profiles ---------------------------------------------------------------

def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


@query
def profile_numeric(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_partkey")
    return _rounded(op.describe_all(lines)).drop("unique", "top", "freq", "dtype")


@query
def profile_merged(spark, sf):
    """States kept per year of shipping, merged over all years, refined on the rows."""
    lines = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    states = stage(op.profile_states(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"], by=["year"]))
    return _rounded(op.describe_states(op.merge_states(states), lines)).drop("distinct")


@query
def profile_per_year(spark, sf):
    """The states of each year and line status, merged to years: moments and extremes without a second reading."""
    lines = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    states = stage(op.profile_states(lines, ["l_quantity", "l_extendedprice"], by=["year", "l_linestatus"]))
    merged = op.merge_states(states, ["year"])
    return merged.select(
        "year", "column", "count", "nulls", F.round("mean", 4).alias("mean"),
        F.round(F.sqrt(F.col("m2") / (F.col("count") - 1)), 4).alias("std"), "min", "max",
    )


@query
def profile_text(spark, sf):
    df = movies(spark, sf).select("Title", "Duration", "MPA", "Votes")
    return op.describe_all(df).select("column", "count", "unique", "top", "freq")


@query
def profile_with_nulls(spark, sf):
    df = plans.clean_catalogue(movies(spark, sf)).select("rating", "title", F.col("méta_score").alias("score"))
    return _rounded(op.profile(df)).drop("dtype")


@query
def describe_list_items(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return _rounded(op.describe_numeric(vectors, "embedding", flatten=True)).select(
        "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


@query
def analyze_votes(spark, sf):
    report = op.analyze_column(movies(spark, sf).select("pos", "Votes"), "Votes")
    none = F.lit(None).cast("bigint")
    rows = [
        part.select(F.lit(kind).alias("kind"), "pos", "Votes", none.alias("count"))
        for kind, part in (("null", report.nulls), ("duplicate", report.duplicates))
    ]
    counts = report.duplicate_counts.select(F.lit("count").alias("kind"), none.alias("pos"), "Votes", "count")
    return rows[0].unionByName(rows[1]).unionByName(counts)


@query
def unique_values(spark, sf):
    df = movies(spark, sf).select("Duration", "MPA", "pos")
    found = op.unique_values(df)
    texts = [
        values.frame.select(F.lit(c).alias("column"), F.col(c).alias("value"))
        for c, values in found.items() if values.kind == "text"
    ]
    (numbers,) = (values.frame for values in found.values() if values.kind == "numeric")
    whole = [F.col(c).cast("bigint").cast("string") for c in ("count", "min", "max")]
    return op.union_relaxed([*texts, numbers.select("column", F.concat_ws("|", *whole).alias("value"))])


# --- whole tables -----------------------------------------------------------

@query
def clean_catalogue(spark, sf):
    cleaned = plans.clean_catalogue(movies(spark, sf))
    return cleaned.select(
        "pos", "src_year", "id", "title", "duration", "mpa", "rating", "votes",
        F.col("méta_score").alias("score"), "movie_link", _day("release_date"), "genres",
        "gross_us_canada", "budget",
    )


@query
def curated_catalogue(spark, sf):
    result = plans.curate(plans.clean_catalogue(movies(spark, sf)), ["pos"])
    return result.catalogue.select("id", "title", "pos", "rating", _day("release_date"))


def _analysis_input(spark, sf):
    df = movies(spark, sf)
    return df.select(
        "pos", mf.extract_id(F.upper("link")).alias("id"), F.col("Title").alias("title"),
        F.col("src_year").cast("string").alias("year"), F.col("Duration").alias("duration"), "MPA",
        mf.parse_rating(F.col("Rating")).alias("rating"), F.col("Votes").alias("votes"),
        mf.parse_score(F.col("meta_score")).alias("meta_score"),
    )


@query
def normalise_catalogue(spark, sf):
    df = plans.normalise_catalogue(_analysis_input(spark, sf))
    return df.select(
        "pos", "title", F.col("year").cast("int").alias("year"), F.col("duration").cast("int").alias("duration"),
        "duration_converted",
        "MPA", "MPA_original", "MPA_min_age", "MPA_min_age_int",
        F.round(F.col("rating").cast("double"), 3).alias("rating"), "rating_as_category", "votes",
        F.col("meta_score").cast("int").alias("meta_score"), "rating_was_missing", "meta_score_was_missing",
    )


# --- pages ------------------------------------------------------------------

PAGE_FIELDS = (
    op.Field("title", "title"),
    op.Field("h1", "h1", within="article"),
    op.Field("lang", "html", attr="lang"),
    op.Field("links", "a", within="nav", many=True),
    op.Field("hrefs", "a", within="nav", many=True, attr="href", limit=3),
    op.Field("third", "a", within="nav", nth=2),
)


@query
def html_fields(spark, sf):
    rows = op.extract_record(read_pages(spark, f"{sf}/pages.parquet"), PAGE_FIELDS)
    return rows.select(
        "page_id", "title", "h1", "lang", "third",
        F.array_join("links", "|").alias("links"), F.array_join("hrefs", "|").alias("hrefs"),
    )


@query
def html_items(spark, sf):
    fields = (op.Field("label", "a"), op.Field("href", "a", attr="href", fatal=True))
    pages = read_pages(spark, f"{sf}/pages.parquet")
    return op.extract_items(pages, "li", fields, "nav").select("page_id", "_item", "label", "href")


@query
def html_error_counts(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet").withColumn("src_year", F.length("url") % 5)
    fields = (op.Field("seventh", "a", within="nav", nth=6, required=True), op.Field("h2", "h2", required=True))
    rows = op.extract_record(pages, fields, ("page_id", "src_year"))
    return op.extraction_counts(rows).withColumn("src_year", F.col("src_year").cast("int"))


def _list_pages(spark, sf, rated: bool = False):
    """List pages of 50 films each, put together from orders. ``rated``: with ratings and scores, some pages broken."""
    def tag(name: str, attrs: str, body: Column) -> Column:
        return F.concat(F.lit(f"<{name} {attrs}>"), F.coalesce(body, F.lit("")), F.lit(f"</{name}>"))

    page = F.floor(F.col("o_orderkey") / 50)
    df = spread(table(spark, sf, "orders").withColumn("page_id", page), "page_id")  # before the items are put together
    spans = F.concat(
        F.lit('<div class="x dli-title-metadata">'), tag("span", "", F.year("o_orderdate").cast("string")),
        F.when(F.col("o_orderkey") % 4 > 0, tag("span", "", F.lit("1h 30m"))).otherwise(""),
        tag("span", "", F.col("o_orderstatus")), F.lit("</div>"),
    )
    item = F.concat(
        F.lit('<li class="ipc-metadata-list-summary-item">'),
        tag("h3", 'class="ipc-title__text"', F.concat(F.col("o_orderkey").cast("string"), F.lit(". A &amp; B"))),
        F.lit('<a class="ipc-lockup-overlay ipc-focusable" href="/title/tt'), F.col("o_custkey").cast("string"),
        F.lit('/?ref=1">x</a>'), spans,
        F.when(F.lit(rated) & (F.col("o_orderkey") % 3 > 0), F.concat(
            tag("span", 'class="ipc-rating-star--rating"', F.concat((F.col("o_orderkey") % 10).cast("string"), F.lit(".5"))),
            tag("span", 'class="x metacritic-score-box"', (F.col("o_orderkey") % 100).cast("string")),
        )).otherwise(""),
        tag("span", 'class="ipc-rating-star--voteCount"', F.concat(F.lit("&nbsp;("), F.col("o_custkey").cast("string"), F.lit("K)"))),
        tag("div", 'class="ipc-html-content-inner-div"', F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))),
    )  # items are left open, as the next one ends them
    return df.groupBy("page_id").agg(
        F.concat(
            F.lit('<html><body><ul class="ipc-metadata-list other">'),
            F.array_join(F.sort_array(F.collect_list(item)), ""), F.lit("</ul><footer>"),
        ).alias("html")
    ).withColumn(
        # A number too long for the page's reader, where the container is looked for.
        "html", F.when(F.lit(rated) & (F.col("page_id") % 10 == 3), f'<ul class="&#{"1" * 5000};"><li>').otherwise(F.col("html"))
    )


@query
def html_unmatched_tags(spark, sf):
    """Pages of hundreds of tags that are never closed and of end tags that were never opened."""
    n = F.col("c_custkey") % 200 * 5
    html = F.concat(
        F.repeat(F.lit("<b><div>"), n), F.lit('<ul><li>one<p class="x">'), F.col("c_name"), F.repeat(F.lit("</i>"), n),
        F.lit("<table><li>two</table><li>three</ul></b>end"), F.repeat(F.lit("<a "), n),
    )
    pages = spread(table(spark, sf, "customer")).select(F.col("c_custkey").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    fields = [op.Field("name", "p.x"), op.Field("items", "li", many=True), op.Field("bold", "b", limit=1, many=True)]
    return op.extract_record(pages, fields).select("page_id", "name", F.array_join("items", "|").alias("items"), F.array_join("bold", "|").alias("bold"))


@query
def listing_sections(spark, sf):
    rows = plans.extract_listing(_list_pages(spark, sf, rated=True), "https://ex.example", on_error="keep")
    return rows.select("page_id", F.col("Title").alias("title"), F.col("Rating").alias("rating"), F.col("méta_score").alias("score"), "_failed")


def _title_pages(spark, sf):
    """One title page per customer."""
    def links(name: str) -> Column:
        return F.concat(F.lit('<a class="ipc-metadata-list-item__list-content-item">'), F.col(name), F.lit("</a>"))

    span = '<span class="ipc-metadata-list-item__list-content-item">'
    html = F.concat(
        F.lit('<html><body><li class="ipc-metadata-list__item">'), links("c_name"), links("c_mktsegment"),
        F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit('</li><li class="ipc-metadata-list__item">'), links("c_name")))
        .otherwise(""),
        F.lit(f'</li><li data-testid="title-boxoffice-budget">{span}$'), F.col("c_custkey").cast("string"),
        F.lit('&nbsp;</span></li><div data-testid="awards"><a class="ipc-metadata-list-item__label">Awards</a>'),
        F.when(F.col("c_custkey") % 5 > 0, F.lit(f"{span}1 win</span>")).otherwise(""), F.lit("</div>"),
    )
    return spread(table(spark, sf, "customer")).select(
        F.concat(F.lit("https://ex.example/title/tt"), F.col("c_custkey").cast("string"), F.lit("/?ref=1")).alias("url"),
        html.alias("html"),
    )


def _full_title_pages(spark, sf):
    """One title page per customer with every section; some sections lack their entry."""
    key = F.col("c_custkey").cast("string")
    entry = "ipc-metadata-list-item__list-content-item"

    def section(test_id: str, *body: Column | str, tag: str = "li") -> list[Column]:
        whole = [F.lit(b) if isinstance(b, str) else b for b in body]
        return [F.lit(f'<{tag} data-testid="{test_id}">'), *whole, F.lit(f"</{tag}>")]

    def link(body: Column, attrs: str = f'class="{entry}"') -> Column:
        return F.concat(F.lit(f"<a {attrs}>"), body, F.lit("</a>"))

    def money(test_id: str, factor: int) -> list[Column]:
        amount = F.concat(F.lit(f'<span class="{entry}">$'), (F.col("c_custkey") * factor).cast("string"), F.lit("</span>"))
        return section(test_id, F.when(F.col("c_custkey") % (factor + 1) > 0, amount).otherwise(""))

    actor = 'data-testid="title-cast-item__actor"'
    html = F.concat(
        *section("title-boxoffice-openingweekenddomestic", F.lit("")),
        *money("title-boxoffice-cumulativeworldwidegross", 3), *money("title-boxoffice-grossdomestic", 2),
        *section("title-details-releasedate", link(F.concat(F.lit("July "), (F.col("c_custkey") % 28 + 1).cast("string"), F.lit(", 2008 (USA)")))),
        *section("title-details-origin", link(F.lit("US")), link(F.col("c_mktsegment"))),
        *section("title-details-filminglocations", '<ul><li class="ipc-inline-list__item">', link(F.col("c_name"), 'href="/l"'),
                 '<span>(studio)</span></li><li class="ipc-inline-list__item"><a>Rome</a></li></ul>'),
        *section("title-details-companies", link(F.concat(F.lit("Studio "), key)), link(F.lit("Other"))),
        *section("title-details-languages", link(F.lit("English")), link(F.lit("French"))),
        *section("interests", '<span class="x ipc-chip__text">War</span><span class="ipc-chip__text">', F.col("c_mktsegment"), "</span>", tag="div"),
        F.lit('<div class="ipc-sub-grid ipc-sub-grid--page-span-2 ipc-sub-grid--wraps-at-above-l ipc-shoveler__grid">'),
        *section("title-cast-item", link(F.col("c_name"), actor), tag="div"), *section("title-cast-item", "<a>no actor</a>", tag="div"),
        *section("title-cast-item", link(F.lit("A. Star"), actor), tag="div"), F.lit("</div>"),
    )
    return spread(table(spark, sf, "customer")).select("c_custkey", F.concat(F.lit("https://ex.example/"), key).alias("url"), html.alias("html"))


@query
def detail_sections(spark, sf):
    rows = plans.extract_details(_full_title_pages(spark, sf))
    lists = ("stars", "countries_origin", "filming_locations", "production_company", "genres", "Languages")
    return rows.select(
        "link", "opening_weekend_Gross", F.col("grossWorldWWide").alias("worldwide"), F.col("gross_US_Canada").alias("domestic"),
        "release_date", *(F.array_join(c, "|").alias(c.lower()) for c in lists), F.size("_errors").alias("n_errors"),
    )


@query
def built_per_year(spark, sf):
    """A page counts for the years whose listing links to it, and for no other."""
    years = F.col("page_id") % 2
    lists = _list_pages(spark, sf).withColumn("src_year", years.cast("int"))
    titles = _title_pages(spark, sf).withColumn("src_year", F.explode(F.array(F.lit(0), F.lit(1))))
    built = plans.build_catalogue(lists, titles, "https://ex.example")
    return built.details.groupBy("src_year", "link").count().withColumnRenamed("count", "n")


@query
def build_catalogue(spark, sf):
    built = plans.build_catalogue(_list_pages(spark, sf), _title_pages(spark, sf), "https://ex.example")
    return built.merged.select(
        F.col("Title").alias("title"), F.col("Movie Link").alias("movie_link"), F.col("Year").alias("year"),
        F.col("Duration").alias("duration"), F.col("MPA").alias("mpa"), F.col("Votes").alias("votes"),
        "description", F.array_join("writers", "|").alias("writers"), F.array_join("directors", "|").alias("directors"),
        "budget", "awards_content", F.size("genres").alias("n_genres"), "countries_origin",
    ).withColumn("countries_origin", F.array_join("countries_origin", "|"))


@query
def detail_error_counts(spark, sf):
    rows = plans.extract_details(_title_pages(spark, sf).withColumn("src_year", F.length("url")))
    return op.extraction_counts(rows)


# --- files ------------------------------------------------------------------

@query
def yearly_csv_round_trip(spark, sf):
    raw = movies(spark, sf)
    folder = _folder(raw, "yearly")
    write_yearly(raw, folder)
    paths = [r.path for r in spark.read.format("binaryFile").load(f"{folder}/*/part-*.csv").select("path").collect()]
    return read_csv_files(spark, paths).select("pos", "src_year", "Title", "genres", "MPA").withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query
def csv_na_tokens(spark, sf):
    raw = movies(spark, sf).select(F.col("pos").cast("string").alias("pos"), "MPA", "Title")
    folder = _folder(raw, "plain")
    raw.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    return read_csv(spark, folder, multi_line=False).select(F.col("pos").cast("bigint").alias("pos"), "MPA", "Title")


@query
def read_years_skips(spark, sf):
    """Two header orders, and one file that has no header: it is reported, and the others are read."""
    raw = movies(spark, sf)
    folder = _folder(raw, "years")
    write_yearly(raw.where("src_year < 1996").select("pos", "Title", "src_year"), folder)
    write_yearly(raw.where("src_year >= 1996").select("Title", "pos", "src_year"), f"{folder}-later")
    raw.limit(1).select(F.lit("").alias("line")).write.text(f"{folder}/src_year=1900")
    early = scan_years(spark, folder, "part-*")
    later = scan_years(spark, f"{folder}-later", "part-*")
    paths = [*list_year_files(spark, folder, "part-*.csv"), *list_year_files(spark, f"{folder}-later", "part-*.csv")]
    both = scan_csv_files(spark, paths)
    return both.rows.select(F.col("pos").cast("bigint").alias("pos"), "src_year", "Title").withColumn(
        "skipped", F.lit(len(early.skipped) + len(later.skipped) + len(both.skipped))
    )


@query
def duplicates_file(spark, sf):
    report = op.duplicate_report(_identified(spark, sf))
    path = f"{_folder(report, 'duplicates')}.csv"
    write_duplicates(report, path)
    return read_csv(spark, path, na_tokens=None).select("id", F.col("count").cast("bigint").alias("count"))


@query
def unexpected_column_counts(spark, sf):
    """Columns that the catalogue does not know are kept; their filled rows."""
    raw = movies(spark, sf).withColumn("studio", F.when(F.col("pos") % 3 > 0, "x"))
    odd = [c for c in plans.check_columns(raw).unexpected if c != "pos"]
    kept = plans.clean_catalogue(raw)
    return kept.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in sorted(odd)))


@query
def head_of_result(spark, sf):
    return movies(spark, sf).orderBy("src_year", "pos").limit(5).select("src_year", "pos", "Title")


@query
def outputs_round_trip(spark, sf):
    result = plans.curate(plans.clean_catalogue(movies(spark, sf)), ["pos"]).catalogue
    folder = _folder(result, "outputs")
    written = write_outputs(result, folder)
    back = spark.read.parquet(next(p for p in written if p.endswith(".parquet")))
    text = spark.read.option("header", True).option("escape", '"').csv(next(p for p in written if p.endswith(".csv")))
    return (
        back.select("pos", "id", "title", "rating", _day("release_date"))
        .join(text.select(F.col("pos").cast("bigint").alias("pos"), F.col("title").alias("csv_title")), "pos")
    )


@query
def arrow_files(spark, sf):
    df = _identified(spark, sf)
    folder = _folder(df, "arrow")
    write_arrow(df, folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(folder)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0):
                with pa.ipc.open_file(pa.py_buffer(content.as_py())) as reader:
                    for i in range(reader.num_record_batches):
                        yield reader.get_batch(i)

    return files.select("content").mapInArrow(rows, df.schema)


@query
def refresh_stream(spark, sf):
    raw = movies(spark, sf)
    folder = _folder(raw, "stream")
    write_yearly(raw, f"{folder}/in")
    refresh_catalogue(
        spark, f"{folder}/in", f"{folder}/store", f"{folder}/state", "part-*.csv", files_per_batch=3
    ).awaitTermination()
    # The files hold pos, so the last row is settled by year and then pos.
    rows = current_catalogue(spark, f"{folder}/store")
    return rows.select(F.col("pos").cast("bigint").alias("pos"), "id", "title", "rating", _day("release_date"))


@query
def merged_batches(spark, sf):
    """Three batches, each rewriting the buckets that it touches; the second one is merged twice."""
    cleaned = plans.clean_catalogue(movies(spark, sf)).withColumn("_src_file", F.lit("")).withColumn("_src_pos", F.col("pos"))
    store = f"{_folder(cleaned, 'merged')}/store"
    for batch, year in enumerate(("src_year > 1996", "src_year % 2 = 0 AND src_year <= 1996", "src_year % 2 = 1 AND src_year <= 1996")):
        for _ in range(1 + batch % 2):
            merge_batch(spark, cleaned.filter(year), store, batch, "query", buckets=16)
    rows = current_catalogue(spark, store)
    return rows.select(F.col("pos").cast("bigint").alias("pos"), "id", "title", "rating", _day("release_date"))


@query
def staged_rows(spark, sf):
    return stage(_identified(spark, sf)).groupBy("src_year").agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("with_id")
    )
