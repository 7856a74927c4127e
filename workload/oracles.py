"""DuckDB SQL with the expected result of each query."""

from __future__ import annotations

from workload.frames import DATES, DETAILS, MOVIES

_MOVIES = f"movies AS ({MOVIES.format(orders='orders')})"
_DATES = DATES.format(orders='orders')
_DETAILS = f"details AS ({DETAILS.format(customer='customer')})"


# Building blocks. RE2 knows neither Unicode spaces in \s nor \z.

def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


def _token(x: str) -> str:
    t = _trim(x)
    return f"CASE WHEN {t} IN ('', '[]') OR lower({t}) = 'n/a' THEN NULL ELSE {t} END"


def _number(x: str) -> str:
    t = _trim(x)
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match({t}, '{pattern}') THEN TRY_CAST({t} AS DOUBLE) END"


TITLE = _token(r"regexp_replace(Title, '^[0-9]+\.\s*', '')")
LINK = _token(r"split_part(link, '?', 1)")
ID = f"NULLIF(regexp_extract({LINK}, 'tt[0-9]+'), '')"
RATING = f"(SELECT CASE WHEN r < 1 THEN 1.0 WHEN r > 10 THEN 10.0 ELSE r END FROM (SELECT {_number('Rating')} AS r))"
_INT_TEXT = rf"regexp_replace({_trim('meta_score')}, '\.[0-9]*$', '')"
SCORE = (
    f"(SELECT CASE WHEN s < 0 THEN 0 WHEN s > 100 THEN 100 ELSE s END FROM (SELECT CASE WHEN "
    f"regexp_full_match({_INT_TEXT}, '[+-]?[0-9]+') THEN TRY_CAST({_INT_TEXT} AS INT) END AS s))"
)
DATE = (
    "CAST(try_strptime(release_date, ['%m/%d/%Y', '%Y-%m-%d', '%d-%m-%Y', '%B %d, %Y', '%B %Y']) AS DATE)"
)
_WHOLE_YEAR = f"CASE WHEN regexp_full_match({_trim('Year')}, '[0-9]+') THEN CAST({_trim('Year')} AS INT) END"
FILLED = f"COALESCE({DATE}, make_date({_WHOLE_YEAR}, 1, 1))"
LENIENT = rf"COALESCE({DATE}, make_date(CAST(split_part({_trim('Year')}, '.', 1) AS INT), 1, 1))"
GENRES = (
    f"CASE WHEN {_trim('genres')} LIKE '[%]' AND {_trim('genres')} <> '[]' THEN {_trim('genres')} END"
)
_D = f"lower({_trim('Duration')})"
KNOWN = (
    rf"COALESCE(regexp_full_match({_D}, '([0-9]+\s*h)?\s*[0-9]+\s*m') OR regexp_full_match({_D}, '[0-9]+\s*min')"
    rf" OR regexp_full_match({_D}, '[0-9]+\s*minutes?') OR regexp_full_match({_D}, '[0-9]+\s*hours?')"
    rf" OR regexp_full_match({_D}, '[0-9]+:[0-9]+') OR regexp_full_match({_D}, '[0-9]+')"
    rf" OR regexp_full_match({_D}, '[0-9]+\s*h'), true)"
)


def _minutes(d: str) -> str:
    t = f"lower({_trim(d)})"

    def g(pattern: str, n: int) -> str:
        return f"TRY_CAST(regexp_extract({t}, '{pattern}', {n}) AS BIGINT)"

    hm, clock = r"^(?:([0-9]+)\s*h)?\s*([0-9]+)\s*m$", "^([0-9]+):([0-9]+)$"
    return (
        f"CASE WHEN {t} IS NULL THEN CAST(-1 AS BIGINT)"
        rf" WHEN regexp_matches({t}, '{hm}') THEN COALESCE({g(hm, 1)}, 0) * 60 + {g(hm, 2)}"
        rf" WHEN regexp_matches({t}, '^[0-9]+\s*(min|minutes?)?$') THEN {g('^[0-9]+', 0)}"
        rf" WHEN regexp_matches({t}, '^[0-9]+\s*(h|hours?)$') THEN {g('^[0-9]+', 0)} * 60"
        rf" WHEN regexp_matches({t}, '{clock}') THEN {g(clock, 1)} * 60 + {g(clock, 2)} ELSE -1 END"
    )


# Age-rating codes of each group.
_CODES = {
    "general": ("g", "tv-g", "tv-y"),
    "parental_guidance": ("pg", "tv-pg", "approved", "passed", "m", "m/pg", "gp", "tv-y7", "tv-y7-fv"),
    "teen": ("pg-13", "tv-14", "tv-13", "13+"),
    "mature": ("r", "tv-ma", "ma-17", "16+"),
    "adults_only": ("nc-17", "x", "18+"),
}
_ALL_CODES = [c for codes in _CODES.values() for c in codes] + ["not rated", "unrated", "none", "e"]


def _in(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


def _group(x: str) -> str:
    whens = " ".join(f"WHEN lower({_trim(x)}) IN {_in(c)} THEN '{g}'" for g, c in _CODES.items())
    return f"CASE {whens} ELSE 'unrated' END"


def _age(g: str) -> str:
    return (f"CASE {g} WHEN 'general' THEN 0 WHEN 'parental_guidance' THEN 7 WHEN 'teen' THEN 13 "
            f"WHEN 'mature' THEN 17 WHEN 'adults_only' THEN 18 END")


MISPLACED = f"(lower({_trim('Duration')}) IN {_in(_ALL_CODES)} AND MPA IS NULL)"
_V = f"lower({_trim('Votes')})"
_V_NUM = f"TRY_CAST(left({_V}, length({_V}) - 1) AS DOUBLE)"
VOTES = (
    f"COALESCE(CASE WHEN {_V} LIKE '%k' THEN CAST(trunc({_V_NUM} * 1000) AS BIGINT) "
    f"WHEN {_V} LIKE '%m' THEN CAST(trunc({_V_NUM} * 1000000) AS BIGINT) "
    f"WHEN regexp_full_match({_V}, '[+-]?[0-9]+') THEN TRY_CAST({_V} AS BIGINT) END, -1)"
)
_IDENTIFIED = f"rows AS (SELECT pos, src_year, {ID} AS id, {TITLE} AS title FROM movies)"
_LAST = "QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _movies(select: str) -> str:
    return _with(_MOVIES) + select


def _rows(select: str) -> str:
    return _with(_MOVIES, _IDENTIFIED) + select


def _describe(column: str, value: str, source: str) -> str:
    v = f"({value})"
    return (
        f"SELECT '{column}' AS \"column\", count({v}) AS \"count\", round(avg({v}), 4) AS mean, "
        f"round(stddev_samp({v}), 4) AS std, round(min({v})::DOUBLE, 4) AS min, "
        f"round(quantile_cont({v}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({v}::DOUBLE, 0.5), 4) AS p50, "
        f"round(quantile_cont({v}::DOUBLE, 0.75), 4) AS p75, round(max({v})::DOUBLE, 4) AS max FROM {source}"
    )


def _text_profile(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", CAST(sum(n) AS BIGINT) AS \"count\", count(*) AS \"unique\", "
        f"first(v ORDER BY n DESC, v) AS top, first(n ORDER BY n DESC, v) AS freq "
        f"FROM (SELECT {column} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    )


_CLEAN = f"""cleaned AS (
  SELECT pos, src_year, {ID} AS id, {TITLE} AS title, {_token('Duration')} AS duration, {_token('MPA')} AS mpa,
    {RATING} AS rating, {_token('Votes')} AS votes, {SCORE} AS score, {LINK} AS movie_link,
    {FILLED} AS release_date, {GENRES} AS genres, {_token('gross_US_Canada')} AS gross_us_canada
  FROM movies)"""

_NORMAL = f"""swapped AS (
  SELECT pos, src_year, Title, CASE WHEN {MISPLACED} THEN MPA ELSE Duration END AS Duration,
    CASE WHEN {MISPLACED} THEN Duration ELSE MPA END AS MPA, Votes,
    COALESCE({RATING}, -1.0) AS r, COALESCE({SCORE}, -1) AS s FROM movies),
normal AS (
  SELECT pos, lower({_trim('Title')}) AS title, src_year AS year, {_minutes('Duration')} AS minutes,
    {_group('MPA')} AS grp, MPA AS original, r, {VOTES} AS votes, s FROM swapped)"""

_NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
_ANCHOR = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def _decode(x: str) -> str:
    # The semicolon may be missing.
    for entity, char in (("quot", '"'), ("#x27", "''"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return x


ORACLES: dict[str, str] = {
    "trim_and_null_tokens": _movies(f"""
        SELECT pos, {_trim("chr(160) || MPA || chr(9) || ' '")} AS trimmed,
          {_token("chr(160) || MPA || chr(9) || ' '")} AS cleaned,
          COALESCE(lower(MPA) IN ('', '[]', 'n/a'), true) AS is_null_token,
          lower({_trim('MPA')}) AS normal FROM movies"""),
    "na_tokens_on_read": _movies("SELECT pos, CASE WHEN MPA <> 'n/a' THEN MPA END AS mpa FROM movies"),
    "clean_title": _movies(f"SELECT pos, {TITLE} AS title FROM movies"),
    "id_from_url": _movies(f"SELECT pos, {LINK} AS movie_link, {ID} AS id FROM movies"),
    "strip_query": "SELECT page_id, split_part(url, '?', 1) AS url FROM pages",
    "money_text": _with(_MOVIES) + """
        SELECT o_orderkey AS pos, '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS gross,
          CAST(CAST(floor(o_totalprice) AS BIGINT) AS DOUBLE) AS amount FROM orders""",
    "crawl_text": _movies("""
        SELECT pos, Votes AS votes, release_date, 'https://ex.example/' || Duration AS url FROM movies"""),
    "list_text_guard": _movies(f"""
        SELECT pos, {GENRES} AS genres,
          genres IS NOT NULL AND NOT (left(genres, 1) = '[' AND right(genres, 1) = ']') AS malformed FROM movies"""),
    "list_round_trip": _movies("""
        SELECT pos,
          CASE pos % 5 WHEN 3 THEN 'Drama|War' WHEN 4 THEN 'D''Arcy|' || regexp_extract(genres, 'G[0-9]') END AS items,
          CASE pos % 5 WHEN 3 THEN '[''Drama'', ''War'']'
            WHEN 4 THEN '["D''Arcy", ''' || regexp_extract(genres, 'G[0-9]') || ''']' END AS printed
        FROM movies"""),
    "list_explode_distinct": """
        SELECT 'Drama' AS genre UNION SELECT 'War' UNION SELECT 'D''Arcy'
        UNION SELECT 'G' || CAST(o_custkey % 7 AS STRING) FROM orders WHERE o_orderkey % 5 = 4""",
    "parse_rating_score": _movies(f"SELECT pos, {RATING} AS rating, {SCORE} AS score FROM movies"),
    "release_date": _movies(f"""
        SELECT pos, strftime({DATE}, '%Y-%m-%d') AS parsed, strftime({FILLED}, '%Y-%m-%d') AS filled,
          strftime({LENIENT}, '%Y-%m-%d') AS lenient FROM movies"""),
    "date_shapes": f"""
        WITH t AS ({_DATES}), parts AS (
            SELECT *, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(day(o_orderdate) AS BIGINT) AS d FROM t)
        SELECT pos, strftime(CASE WHEN shape > 22 THEN NULL WHEN shape IN (5, 6, 19) THEN make_date(y, m, 1)
            WHEN shape = 7 THEN make_date(y, 1, 1) WHEN shape IN (10, 11) AND d <= 12 THEN make_date(y, d, m)
            ELSE make_date(y, m, d) END, '%Y-%m-%d') AS day
        FROM parts""",
    "unread_date_shapes": f"""
        WITH t AS ({_DATES} WHERE o_orderkey % 26 > 22)
        SELECT regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z]', 'a', 'g'), '[0-9]', '9', 'g'), ' +', ' ', 'g') AS shape,
          count(*) AS rows, count(DISTINCT text) AS texts, min(text) AS sample
        FROM t GROUP BY 1""",
    "duration_minutes": _movies(f"""
        SELECT pos, {KNOWN} AS known, {_minutes('Duration')} AS minutes, {_minutes('Duration')} <> -1 AS ok FROM movies"""),
    "swap_misplaced_rating": _movies(f"""
        SELECT pos, CASE WHEN {MISPLACED} THEN MPA ELSE Duration END AS Duration,
          CASE WHEN {MISPLACED} THEN Duration ELSE MPA END AS MPA FROM movies"""),
    "rating_group_min_age": _movies(f"""
        SELECT pos, grp, COALESCE(CAST({_age('grp')} AS STRING), 'unrated') AS min_age,
          CAST({_age('grp')} AS INT) AS min_age_int FROM (SELECT pos, {_group('MPA')} AS grp FROM movies)"""),
    "votes_parse": _movies(f"SELECT pos, {VOTES} AS votes FROM movies"),
    "rating_grid": _movies(f"""
        SELECT pos, CAST(CASE WHEN r = -1 THEN 0
            WHEN r >= 0 AND r <= 10 AND abs(r * 10 - round(r * 10)) < 1e-3 THEN round(r * 10) + 1 END AS INT) AS code
        FROM (SELECT pos, COALESCE({RATING}, -1.0) + CASE WHEN pos % 7 = 0 THEN 0.05 ELSE 0 END AS r FROM movies)"""),
    "missing_flags": _movies(f"SELECT pos, {RATING} IS NULL OR {VOTES} = -1 AS missing FROM movies"),
    "year_to_number": _movies(f"""
        SELECT pos, CASE WHEN y = floor(y) THEN CAST(y AS INT) END AS year FROM (
          SELECT pos, TRY_CAST({_trim('Year')} AS DOUBLE) AS y FROM movies)"""),
    "number_cells": _movies("""
        SELECT pos, CAST(pos % 300 AS BIGINT) AS minutes,
          CASE WHEN pos % 7 > 0 THEN CAST(floor(pos * 2500) AS BIGINT) ELSE -1 END AS votes FROM movies"""),
    "normalise_wide_values": _movies("""
        SELECT pos, CAST(pos + 40000 AS BIGINT) AS year, CAST(pos * 100000000 AS BIGINT) AS duration,
          CAST(pos * 1000000000 AS BIGINT) AS votes, CAST(pos * 1000 AS BIGINT) AS meta_score FROM movies"""),
    "fit_integer_types": """
        SELECT l_linenumber, count(*) AS n, CAST(sum(l_suppkey) AS BIGINT) AS suppkeys, max(l_partkey) AS top_part
        FROM lineitem GROUP BY 1""",
    "rename_and_lead": """
        SELECT o_orderkey AS id, o_orderpriority AS title, o_custkey, o_orderstatus, o_totalprice FROM orders""",
    "union_drifted_years": _movies("""
        SELECT pos, CAST(pos AS STRING) AS Votes, Title, CAST(NULL AS STRING) AS MPA FROM movies WHERE src_year < 1998
        UNION ALL SELECT pos, Votes, Title, MPA FROM movies WHERE src_year >= 1998"""),
    "analysis_names": _with(_MOVIES, _CLEAN) + """
        SELECT pos, id, mpa AS MPA, score AS meta_score, CAST(year(release_date) AS INT) AS year FROM cleaned""",
    "merge_listing_details": _with(_MOVIES, _DETAILS) + f"""
        SELECT details.link AS movie_link, pos, src_year, Title, writers, production_company
        FROM movies JOIN details ON {LINK.replace('link', 'movies.link')} = details.link""",
    "merge_details_null_safe": _with(_MOVIES, _DETAILS) + f"""
        SELECT {LINK.replace('link', 'movies.link')} AS movie_link, pos, src_year, Title, writers, production_company
        FROM movies JOIN details ON {LINK.replace('link', 'movies.link')} IS NOT DISTINCT FROM details.link""",
    "merge_within_year": _movies(f"""
        SELECT src_year, {LINK} AS movie_link, pos, Title, true AS seen FROM movies WHERE link IS NOT NULL"""),
    "lookup_nation": """
        SELECT c_custkey, c_nationkey + 3 AS key, COALESCE(n_name, 'unknown') AS n_name
        FROM customer LEFT JOIN nation ON c_nationkey + 3 = n_nationkey""",
    "pages_semi_listing": """
        SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "pages_semi_listing_hot": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)""",
    "keep_last_by_id": _rows(f"SELECT * FROM rows {_LAST}"),
    "keep_last_keep_null": _rows(
        f"SELECT * FROM (SELECT * FROM rows WHERE id IS NOT NULL {_LAST}) UNION ALL SELECT * FROM rows WHERE id IS NULL"
    ),
    "duplicate_report": _rows("""
        SELECT id, count(*) AS count, COALESCE(string_agg(DISTINCT title, ', ' ORDER BY title), '') AS titles
        FROM rows WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"""),
    "duplicate_pieces": _rows("""
        , keys AS (SELECT id, count(*) AS count FROM rows WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1),
        sized AS (
            SELECT id, title, sum(strlen(title) + 2) OVER (PARTITION BY id ORDER BY title) - strlen(title) - 2 AS before
            FROM (SELECT DISTINCT id, title FROM rows WHERE title IS NOT NULL)),
        pieces AS (
            SELECT id, CAST(before // 60 AS BIGINT) AS piece, string_agg(title, ', ' ORDER BY title) AS titles FROM sized GROUP BY 1, 2)
        SELECT id, COALESCE(piece, 0) AS piece, count, COALESCE(titles, '') AS titles FROM keys LEFT JOIN pieces USING (id)"""),
    "duplicate_titles": _rows("""
        SELECT DISTINCT id, title FROM rows WHERE title IS NOT NULL
        AND id IN (SELECT id FROM rows WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"""),
    "duplicate_rows": _rows("SELECT * FROM rows QUALIFY count(*) OVER (PARTITION BY title) > 1"),
    "top600_per_year": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) <= 600""",
    "top_grossing": _with(_MOVIES, _CLEAN) + """
        SELECT pos, src_year, gross_us_canada FROM cleaned QUALIFY row_number() OVER (PARTITION BY src_year
          ORDER BY CAST(substr(gross_us_canada, 2) AS BIGINT) DESC, id NULLS FIRST) <= 100""",
    "value_counts_top20": _movies("""
        SELECT Votes, count(*) AS count FROM movies WHERE Votes IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
    "value_counts_all": "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1",
    "value_dups": "SELECT p_name, count(*) AS count FROM part GROUP BY 1 HAVING count(*) > 1",
    "group_size_nulls": _movies("SELECT Duration, MPA, count(*) AS count FROM movies GROUP BY 1, 2"),
    "distinct_durations": _movies("SELECT DISTINCT Duration FROM movies"),
    "null_counts": _movies(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM movies"
        for c in ("pos", "src_year", "Title", "Year", "Duration", "MPA", "Rating", "Votes", "meta_score", "link",
                  "release_date", "genres", "gross_US_Canada")
    )),
    "null_rows": _movies("SELECT pos, Title FROM movies WHERE Rating IS NULL"),
    "missing_stats": _with(_MOVIES, _CLEAN) + "SELECT " + ", ".join(
        f"round(100.0 * (count(*) - count({c})) / count(*), 6)::DOUBLE AS missing_{n}"
        for c, n in (("id", "id"), ("title", "title"), ("rating", "rating"), ("score", "meta_score"),
                     ("release_date", "release_date"))
    ) + " FROM cleaned",
    "missing_critical": _with(_MOVIES, _CLEAN) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(100.0 * (count(*) - count({c})) / count(*), 6)::DOUBLE AS percent FROM cleaned"
        for c in ("id", "title")
    ),
    "validate_raw": _movies(r"""
        SELECT check_ AS "check", col AS "column", n_bad, sample FROM (
          SELECT 'list_format' AS check_, 'genres' AS col, count(*) AS n_bad,
            array_to_string(list_sort(list(DISTINCT genres))[1:5], '|') AS sample
          FROM movies WHERE NOT (left(genres, 1) = '[' AND right(genres, 1) = ']')
          UNION ALL
          SELECT 'range', 'rating', count(*), array_to_string(list_sort(list(DISTINCT Rating))[1:5], '|')
          FROM movies WHERE TRY_CAST(replace(Rating, 'd', '') AS DOUBLE) NOT BETWEEN 1 AND 10
          UNION ALL
          SELECT 'range', 'meta_score', count(*), array_to_string(list_sort(list(DISTINCT meta_score))[1:5], '|')
          FROM movies WHERE TRY_CAST(meta_score AS DOUBLE) NOT BETWEEN 0 AND 100)"""),
    "final_summary": _with(_MOVIES, _NORMAL) + """
        SELECT count(*) AS total_rows, count(*) - count(grp) AS mpa_nulls, min(minutes) AS duration_min,
          max(minutes) AS duration_max, count(*) FILTER (minutes <> -1) AS converted,
          count(*) FILTER (minutes = -1) AS not_converted,
          round(100.0 * count(*) FILTER (minutes <> -1) / count(*), 6)::DOUBLE AS success_rate,
          count(DISTINCT grp) AS mpa_groups, count(DISTINCT grp) AS min_ages FROM normal"""
    .replace("min(minutes)", "CAST(min(minutes) AS INT)").replace("max(minutes)", "CAST(max(minutes) AS INT)"),
    "distinct_counts": _movies("SELECT count(DISTINCT Title) AS titles, count(DISTINCT link) AS links FROM movies"),
    "profile_numeric": " UNION ALL ".join(
        _describe(c, c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_partkey")
    ),
    "profile_merged": " UNION ALL ".join(
        f"SELECT *, (SELECT count(*) - count({c}) FROM lineitem) AS nulls FROM ({_describe(c, c, 'lineitem')})"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_partkey")
    ),
    "profile_per_year": " UNION ALL ".join(
        f"""SELECT CAST(year(l_shipdate) AS INT) AS year, '{c}' AS "column", count({c}) AS "count", count(*) - count({c}) AS nulls,
          round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
        FROM lineitem GROUP BY 1"""
        for c in ("l_quantity", "l_extendedprice")
    ),
    "profile_text": _movies(" UNION ALL ".join(
        _text_profile(c, "movies") for c in ("Title", "Duration", "MPA", "Votes")
    )),
    "profile_with_nulls": _with(_MOVIES, _CLEAN) + f"""
        SELECT d.*, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS STRING) AS top, CAST(NULL AS BIGINT) AS freq, nulls FROM (
          {_describe('rating', 'rating', 'cleaned')} UNION ALL {_describe('score', 'score', 'cleaned')}) d
        JOIN (SELECT 'rating' AS c, count(*) - count(rating) AS nulls FROM cleaned
          UNION ALL SELECT 'score', count(*) - count(score) FROM cleaned) ON d."column" = c
        UNION ALL
        SELECT p."column", p."count", NULL, NULL, NULL, NULL, NULL, NULL, NULL, p."unique", p.top, p.freq, nulls
        FROM ({_text_profile('title', 'cleaned')}) p, (SELECT count(*) - count(title) AS nulls FROM cleaned)""",
    "describe_list_items": f"""
        SELECT * EXCLUDE ("column") FROM (
          {_describe('embedding', 'v::DOUBLE', '(SELECT unnest(embedding) AS v FROM embeddings)')})""",
    "analyze_votes": _movies("""
        SELECT 'null' AS kind, pos, Votes, CAST(NULL AS BIGINT) AS count FROM movies WHERE Votes IS NULL
        UNION ALL SELECT 'duplicate', pos, Votes, NULL FROM (
          SELECT pos, Votes FROM movies QUALIFY count(*) OVER (PARTITION BY Votes) > 1)
        UNION ALL SELECT 'count', NULL, Votes, count(*) FROM movies WHERE Votes IS NOT NULL GROUP BY Votes HAVING count(*) > 1"""),
    "unique_values": _movies("""
        SELECT DISTINCT 'Duration' AS "column", Duration AS value FROM movies
        UNION ALL SELECT DISTINCT 'MPA', MPA FROM movies
        UNION ALL SELECT 'pos', count(*) || '|' || min(pos) || '|' || max(pos) FROM movies"""),
    "clean_catalogue": _with(_MOVIES, _CLEAN) + """
        SELECT * REPLACE (strftime(release_date, '%Y-%m-%d') AS release_date), CAST(NULL AS STRING) AS budget FROM cleaned""",
    "curated_catalogue": _with(_MOVIES, _CLEAN) + f"""
        SELECT id, title, pos, rating, strftime(release_date, '%Y-%m-%d') AS release_date FROM cleaned {_LAST}""",
    "normalise_catalogue": _with(_MOVIES, _NORMAL) + f"""
        SELECT pos, title, year, CAST(minutes AS INT) AS duration, minutes <> -1 AS duration_converted, grp AS MPA,
          original AS MPA_original, COALESCE(CAST({_age('grp')} AS STRING), 'unrated') AS MPA_min_age,
          CAST({_age('grp')} AS INT) AS MPA_min_age_int, round(r, 3) AS rating,
          CAST(CASE WHEN r = -1 THEN 0 ELSE round(r * 10) + 1 END AS INT) AS rating_as_category, votes,
          CAST(s AS INT) AS meta_score, r = -1 OR votes = -1 AS rating_was_missing, s = -1 AS meta_score_was_missing
        FROM normal""",
    "html_fields": f"""
        SELECT page_id, {_decode("regexp_extract(html, '<title>([^<]*)', 1)")} AS title,
          {_decode("regexp_extract(html, '<h1>([^<]*)', 1)")} AS h1,
          regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
          {_decode(f"regexp_extract_all({_NAV}, '{_ANCHOR}', 2)[3]")} AS third,
          {_decode(f"array_to_string(regexp_extract_all({_NAV}, '{_ANCHOR}', 2), '|')")} AS links,
          {_decode(f"array_to_string(regexp_extract_all({_NAV}, '{_ANCHOR}', 1)[1:3], '|')")} AS hrefs
        FROM pages""",
    "html_items": f"""
        SELECT page_id, CAST(i - 1 AS INT) AS _item, {_decode('labels[i]')} AS label, {_decode('hrefs[i]')} AS href
        FROM (SELECT page_id, labels, hrefs, unnest(range(1, len(labels) + 1)) AS i FROM (
          SELECT page_id, regexp_extract_all({_NAV}, '{_ANCHOR}', 2) AS labels,
            regexp_extract_all({_NAV}, '{_ANCHOR}', 1) AS hrefs FROM pages))""",
    "html_error_counts": f"""
        SELECT CAST(length(url) % 5 AS INT) AS src_year, count(*) AS rows,
          CAST(sum(1 + CASE WHEN len(regexp_extract_all({_NAV}, '{_ANCHOR}')) < 7 THEN 1 ELSE 0 END) AS BIGINT) AS errors
        FROM pages GROUP BY 1""",
    "build_catalogue": """
        SELECT o_orderkey || '. A & B' AS title, 'https://ex.example/title/tt' || c_custkey || '/?ref=1' AS movie_link,
          CAST(year(o_orderdate) AS STRING) AS year,
          CASE WHEN o_orderkey % 4 > 0 THEN '1h 30m' ELSE o_orderstatus END AS duration,
          CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS mpa, o_custkey || 'K' AS votes,
          o_orderpriority AS description, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS writers,
          c_name || '|' || c_mktsegment AS directors, '$' || c_custkey AS budget,
          CASE WHEN c_custkey % 5 > 0 THEN 'Awards, 1 win' END AS awards_content, CAST(0 AS INT) AS n_genres,
          CAST(NULL AS STRING) AS countries_origin
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "detail_error_counts": """
        SELECT CAST(length('https://ex.example/title/tt' || c_custkey || '/?ref=1') AS INT) AS src_year,
          count(*) AS rows, CAST(sum((c_custkey % 3 = 0)::INT + (c_custkey % 5 = 0)::INT) AS BIGINT) AS errors
        FROM customer GROUP BY 1""",
    "yearly_csv_round_trip": _movies("SELECT pos, src_year, Title, genres, MPA FROM movies"),
    "outputs_round_trip": _with(_MOVIES, _CLEAN) + f"""
        SELECT pos, id, title, rating, strftime(release_date, '%Y-%m-%d') AS release_date, title AS csv_title
        FROM cleaned {_LAST}""",
    "arrow_files": _rows("SELECT * FROM rows"),
    "csv_na_tokens": _movies("""
        SELECT pos, CASE WHEN MPA IN ('n/a', '') THEN NULL ELSE MPA END AS MPA, Title FROM movies"""),
    "read_years_skips": _movies("SELECT pos, src_year, Title, CAST(1 AS INT) AS skipped FROM movies"),
    "duplicates_file": _rows("SELECT id, count(*) AS count FROM rows WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"),
    "unexpected_column_counts": _movies("SELECT CAST(count(*) FILTER (pos % 3 > 0) AS BIGINT) AS studio FROM movies"),
    "head_of_result": _movies("SELECT src_year, pos, Title FROM movies ORDER BY src_year, pos LIMIT 5"),
    "html_unmatched_tags": """
        SELECT c_custkey AS page_id, c_name AS name, 'one' || c_name || 'two|two|three' AS items,
          CASE WHEN c_custkey % 200 > 0 THEN 'one' || c_name || 'twothreeend' || repeat('<a ', CAST(c_custkey % 200 * 5 AS BIGINT)) ELSE '' END AS bold
        FROM customer""",
    "listing_sections": """
        SELECT CAST(floor(o_orderkey / 50) AS BIGINT) AS page_id, o_orderkey || '. A & B' AS title,
          CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 10 || '.5' END AS rating,
          CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 100 AS STRING) END AS score, false AS _failed
        FROM orders WHERE CAST(floor(o_orderkey / 50) AS BIGINT) % 10 <> 3
        UNION ALL
        SELECT DISTINCT CAST(floor(o_orderkey / 50) AS BIGINT), NULL, NULL, NULL, true
        FROM orders WHERE CAST(floor(o_orderkey / 50) AS BIGINT) % 10 = 3""",
    "detail_sections": """
        SELECT 'https://ex.example/' || c_custkey AS link, CAST(NULL AS STRING) AS "opening_weekend_Gross",
          CASE WHEN c_custkey % 4 > 0 THEN '$' || c_custkey * 3 END AS worldwide,
          CASE WHEN c_custkey % 3 > 0 THEN '$' || c_custkey * 2 END AS domestic,
          'July ' || (c_custkey % 28 + 1) || ', 2008' AS release_date, c_name || '|A. Star' AS stars,
          'US|' || c_mktsegment AS countries_origin, c_name || ' (studio)|Rome' AS filming_locations,
          'Studio ' || c_custkey || '|Other' AS production_company, 'War|' || c_mktsegment AS genres,
          'English|French' AS languages,
          CAST(3 + (c_custkey % 4 = 0)::INT + (c_custkey % 3 = 0)::INT AS INT) AS n_errors
        FROM customer""",
    "built_per_year": """
        SELECT DISTINCT CAST(CAST(floor(o_orderkey / 50) AS BIGINT) % 2 AS INT) AS src_year,
          'https://ex.example/title/tt' || c_custkey || '/?ref=1' AS link, CAST(1 AS BIGINT) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "refresh_stream": _with(_MOVIES, _CLEAN) + f"""
        SELECT pos, id, title, rating, strftime(release_date, '%Y-%m-%d') AS release_date
        FROM cleaned QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_year DESC, pos DESC) = 1""",
    "merged_batches": _with(_MOVIES, _CLEAN) + f"""
        SELECT pos, id, title, rating, strftime(release_date, '%Y-%m-%d') AS release_date
        FROM cleaned QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_year DESC, pos DESC) = 1""",
    "staged_rows": _rows("SELECT src_year, count(*) AS n, count(id) AS with_id FROM rows GROUP BY 1"),
}
