"""Column names, types and page layouts of the catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

from marquee.operators.html import Field

# Column names of the yearly files and of the catalogue. The
# last three are other spellings that occur in documentation and files.
RENAMES = {
    "Title": "title",
    "Year": "year",
    "Duration": "duration",
    "MPA": "mpa",
    "Rating": "rating",
    "Votes": "votes",
    "méta_score": "méta_score",
    "description": "description",
    "Movie Link": "movie_link",
    "link": "movie_link",
    "writers": "writers",
    "directors": "directors",
    "stars": "stars",
    "budget": "budget",
    "opening_weekend_Gross": "opening_weekend_gross",
    "grossWorldWWide": "gross_worldwide",
    "gross_US_Canada": "gross_us_canada",
    "Release_date": "release_date",
    "countries_origin": "countries_origin",
    "filming_locations": "filming_locations",
    "production_company": "production_companies",
    "awards_content": "awards_content",
    "genres": "genres",
    "Languages": "languages",
    "meta_score": "méta_score",
    "grossWorldWide": "gross_worldwide",
    "release_date": "release_date",
}

# Catalogue columns in output order.
CATALOGUE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("mpa", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("votes", T.StringType()),
    T.StructField("méta_score", T.IntegerType()),
    T.StructField("description", T.StringType()),
    T.StructField("movie_link", T.StringType()),
    T.StructField("writers", T.StringType()),
    T.StructField("directors", T.StringType()),
    T.StructField("stars", T.StringType()),
    T.StructField("budget", T.StringType()),
    T.StructField("opening_weekend_gross", T.StringType()),
    T.StructField("gross_worldwide", T.StringType()),
    T.StructField("gross_us_canada", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("countries_origin", T.StringType()),
    T.StructField("filming_locations", T.StringType()),
    T.StructField("production_companies", T.StringType()),
    T.StructField("awards_content", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("languages", T.StringType()),
])

# Columns that the readers add; they are no surprise in a file.
BOOKKEEPING = ("src_year", "_src_file", "_src_pos")

# Where the fields stand on list pages and on title pages.
LIST_CONTAINER = "ul.ipc-metadata-list"
LIST_ITEM = "li.ipc-metadata-list-summary-item"
_LINE = "div.dli-title-metadata"

LISTING_FIELDS = (
    Field("Title", "h3.ipc-title__text"),
    Field("Year", "span", within=_LINE, nth=0),
    Field("Duration", "span", within=_LINE, nth=1),
    Field("MPA", "span", within=_LINE, nth=2),
    Field("Rating", "span.ipc-rating-star--rating"),
    Field("Votes", "span.ipc-rating-star--voteCount"),
    Field("méta_score", "span.metacritic-score-box"),
    Field("description", "div.ipc-html-content-inner-div"),
    Field("Movie Link", "a[class=ipc-lockup-overlay ipc-focusable]", attr="href", fatal=True),
)

_ENTRY = "ipc-metadata-list-item__list-content-item"


def _section(test_id: str, tag: str = "li") -> str:
    return f"{tag}[data-testid={test_id}]"


def _money(name: str, test_id: str) -> Field:
    return Field(name, f"span.{_ENTRY}", within=_section(test_id), required=True)


DETAIL_FIELDS = (
    Field("writers", f"a.{_ENTRY}", within="li.ipc-metadata-list__item", within_nth=1, many=True),
    Field("directors", f"a.{_ENTRY}", within="li.ipc-metadata-list__item", within_nth=0, many=True),
    Field(
        "stars", _section("title-cast-item__actor", "a"),
        within="div[class=ipc-sub-grid ipc-sub-grid--page-span-2 "
               "ipc-sub-grid--wraps-at-above-l ipc-shoveler__grid]",
        each=_section("title-cast-item", "div"), limit=10, skip=True,
    ),
    _money("budget", "title-boxoffice-budget"),
    _money("opening_weekend_Gross", "title-boxoffice-openingweekenddomestic"),
    _money("grossWorldWWide", "title-boxoffice-cumulativeworldwidegross"),
    _money("gross_US_Canada", "title-boxoffice-grossdomestic"),
    Field("release_date", f"a.{_ENTRY}", within=_section("title-details-releasedate"), required=True),
    Field("countries_origin", f"a.{_ENTRY}", within=_section("title-details-origin"), many=True),
    Field(
        "filming_locations", "a", within=_section("title-details-filminglocations"),
        each="li.ipc-inline-list__item", extra="span", extra_optional=True, required=True,
    ),
    Field("production_company", f"a.{_ENTRY}", within=_section("title-details-companies"), many=True),
    Field(
        "awards_content", "a.ipc-metadata-list-item__label", within=_section("awards", "div"),
        extra=f"span.{_ENTRY}", sep=", ", required=True,
    ),
    Field("genres", "span.ipc-chip__text", within=_section("interests", "div"), many=True, default=()),
    Field("Languages", f"a.{_ENTRY}", within=_section("title-details-languages"), many=True, default=()),
)
MONEY = ("budget", "opening_weekend_Gross", "grossWorldWWide", "gross_US_Canada")
