"""Operators against hand-made rows and brute force."""

import bisect
import math
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import operators as op
from marquee.operators.profile import describe_all, describe_states, merge_states, numeric_stats, profile_states
from marquee.operators.quality import validate


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- columns ----------------------------------------------------------------

def test_rename_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert op.rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    with pytest.raises(ValueError):
        op.rename_columns(df, {"a": "b"})


def test_rename_composes_accents(spark):
    df = spark.createDataFrame([(1,)], ["méta_score"])
    assert op.rename_columns(df, {}).columns == ["méta_score"]


def test_lead_and_unexpected(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, id int, title int")
    assert op.lead_columns(df).columns == ["id", "title", "a"]
    assert op.unexpected_columns(df, ["id", "title"]) == ["a"]
    assert op.absent_columns(df, ["id", "z"]) == ["z"]


def test_swap_reads_old_values(spark):
    df = spark.createDataFrame([("PG-13", None), ("PG-13", "R"), ("2h", None)], "d string, m string")
    from marquee.functions import misplaced_rating

    swapped = op.swap_where(df, "d", "m", misplaced_rating(df.d, df.m))
    assert [tuple(r) for r in swapped.collect()] == [(None, "PG-13"), ("PG-13", "R"), ("2h", None)]


def test_union_widens_to_text(spark):
    a = spark.createDataFrame([(1,)], "k bigint")
    b = spark.createDataFrame([("z", 2)], "k string, w int")
    united = op.union_relaxed([a, b])
    assert dict(united.dtypes) == {"k": "string", "w": "int"}
    assert rows(united) == [("1", None), ("z", 2)]


def test_union_of_numbers(spark):
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    b = spark.createDataFrame([(2, 2.5)], "k bigint, v double")
    assert dict(op.union_relaxed([a, b]).dtypes) == {"k": "bigint", "v": "double"}


def test_narrow_fit(spark):
    df = spark.createDataFrame([(1, 40_000, -129, 2**40), (127, -1, 5, None)], "a bigint, b bigint, c bigint, d bigint")
    narrow = op.narrow_ints(df, ["a", "b", "c", "d"], mode="fit")
    assert [t for _, t in narrow.dtypes] == ["tinyint", "int", "smallint", "bigint"]
    assert rows(narrow) == rows(df)


# --- joins ------------------------------------------------------------------

def test_merge_pairs_and_nulls(spark):
    listing = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "`Movie Link` string, n int")
    details = spark.createDataFrame([("a", "x"), ("c", "y"), (None, "z")], "link string, w string")
    assert rows(op.merge_details(listing, details, per_year=False)) == [("a", 1, "x"), ("a", 2, "x")]
    both = op.merge_details(listing, details, per_year=False, null_safe=True)
    assert rows(both) == [("a", 1, "x"), ("a", 2, "x"), (None, 4, "z")]


def test_merge_stays_within_year(spark):
    listing = spark.createDataFrame([(1999, "a"), (2000, "a")], "src_year int, `Movie Link` string")
    details = spark.createDataFrame([(1999, "a", "x")], "src_year int, link string, w string")
    assert rows(op.merge_details(listing, details)) == [(1999, "a", "x")]


@pytest.mark.parametrize("hot_rows", [1, 5, 10**9])
def test_restrict_pages_with_hot_urls(spark, hot_rows):
    pages = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("url"),
        F.col("id").alias("n"),
    ).repartition(7)
    listing = spark.createDataFrame([("hot",), ("u1",), ("u1",), (None,), ("none",)], "`Movie Link` string")
    expected = sorted(((u, n) for u, n in pages.collect() if u in ("hot", "u1")), key=repr)
    for limit in (0, 10**6):
        kept = op.restrict_pages(pages, listing, max_broadcast=limit, hot_rows=hot_rows)
        assert rows(kept) == expected


def test_few_links_move_no_page(spark):
    pages = spark.range(10).select(F.col("id").cast("string").alias("url"))
    listing = spark.createDataFrame([("1",)], "`Movie Link` string")
    text = plan(op.restrict_pages(pages, listing))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_hot_rows_are_spread(spark):
    pages = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("url"), "id")
    listing = spark.createDataFrame([("hot",)], "`Movie Link` string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = op.restrict_pages(pages, listing, max_broadcast=0, hot_rows=100)
        sizes = kept.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) > 1


@pytest.mark.parametrize("limit", [0, 10**6])
def test_pages_of_another_year_do_not_count(spark, limit):
    listing = spark.createDataFrame([(1999, "a"), (2000, "b"), (2001, None)], "src_year int, `Movie Link` string")
    pages = spark.createDataFrame([(1999, "a"), (2000, "a"), (2000, "b"), (2001, None)], "src_year int, url string")
    assert rows(op.restrict_pages(pages, listing, max_broadcast=limit, hot_rows=1)) == [(1999, "a"), (2000, "b")]


def test_lookup_default_and_size_check(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    for limit in (1_000, 0):
        found = op.lookup(df, dim, "k", {"name": "none"}, max_broadcast=limit)
        assert rows(found) == [(1, "one"), (2, "none"), (None, "none")]


# --- duplicates -------------------------------------------------------------

def test_report_and_keep_last(spark):
    data = [("x", "A"), ("x", None), ("x", "A"), ("y", "B"), (None, "C"), (None, "D")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "pos int, id string, title string")
    assert rows(op.duplicate_report(df)) == [("x", 3, "A")]
    last = op.keep_last(df, "id", ["pos"])
    assert rows(last.select("id", "title")) == [("x", "A"), ("y", "B"), (None, "D")]
    every = op.keep_last(df, "id", ["pos"], keep_null=True)
    assert rows(every.select("id", "title")) == [("x", "A"), ("y", "B"), (None, "C"), (None, "D")]
    assert rows(op.duplicate_titles(df)) == [("x", "A")]


def test_keep_last_ignores_partitioning(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b", "c", None, f"k{i}"])) for i in range(500)]
    expected = {}
    for pos, key in data:
        expected[key] = pos
    for parts in (1, 5, 16):
        shuffled = rng.sample(data, len(data))
        df = spark.createDataFrame(shuffled, "pos int, id string").repartition(parts)
        assert {r.id: r.pos for r in op.keep_last(df, "id", ["pos"]).collect()} == expected


def test_keep_last_sends_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "a")], "pos int, id string")
    for last in (op.keep_last(df, "id", ["pos"]), op.keep_last(df, "id", ["pos"], keep_null=True)):
        text = plan(last)
        assert "Partial" in text and "WindowGroupLimit" in text
        assert text.count("Exchange") == 1


@pytest.mark.parametrize("hot_rows", [2, 10**9])
def test_all_duplicates(spark, hot_rows):
    values = ["a"] * 50 + ["b", "c", "c", None, None, "d"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(6)
    counts = Counter(values)
    expected = sorted(((i, v) for i, v in enumerate(values) if counts[v] > 1), key=repr)
    assert rows(op.all_duplicates(df, "v", hot_rows=hot_rows)) == expected


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_top_per_group(spark, parts):
    rng = random.Random(2)
    data = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.randint(0, 40)) for i in range(600)]
    df = spark.createDataFrame(data, "i int, g int, v int").repartition(9)
    top = op.top_per_group(df, "g", [F.desc("v"), F.col("i")], 20, parts=parts)
    expected = []
    for g in (1, 2, 3, None):
        expected += sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[0]))[:20]
    assert rows(top) == sorted(expected, key=repr)


# --- counts and profiles ----------------------------------------------------

def test_missing_and_null_counts(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("c", 4)], "id string, n int")
    stats = op.missing_stats(df, ["id", "n"])
    assert rows(stats) == [(25.0, 0.0)]
    assert rows(op.missing_critical(stats)) == [("id", 25.0)]
    assert rows(op.null_counts(df)) == [("id", 1), ("n", 0)]


def test_value_counts_and_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), (None, None)], "x string, y int")
    assert [tuple(r) for r in op.value_counts(df, "x").collect()] == [("a", 2), ("b", 1)]
    assert rows(op.value_counts(df, "x", min_count=2)) == [("a", 2)]
    assert [tuple(r) for r in op.group_sizes(df, ["x", "y"]).collect()] == [
        ("a", 1, 1), ("a", None, 1), ("b", 1, 1), (None, None, 1)
    ]


def interpolated(values, p):
    values = sorted(values)
    rank = (len(values) - 1) * p
    low = math.floor(rank)
    high = math.ceil(rank)
    return values[low] + (values[high] - values[low]) * (rank - low)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 199, 201, 5000])
def test_exact_quantiles_with_coarse_brackets(spark, n):
    """Small accuracies exercise the bracketing on little data."""
    rng = random.Random(n)
    columns = {
        "normal": [rng.gauss(0, 1) for _ in range(n)],
        "ties": [float(rng.choice([1, 2, 2, 2, 9])) for _ in range(n)],
        "heavy": [0.0 if rng.random() < 0.4 else rng.paretovariate(1) for _ in range(n)],
    }
    cells = [(c, v) for c, values in columns.items() for v in values] + [("ties", None)]
    long = spark.createDataFrame(cells, "column string, value double").repartition(5)
    for accuracy in (100, 10_000):
        for r in numeric_stats(long, accuracy=accuracy).collect():
            values = columns[r["column"]]
            for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
                assert r[name] == pytest.approx(interpolated(values, p)), (r["column"], n, accuracy, name)


def test_describe_all_types(spark):
    df = spark.createDataFrame(
        [(1, "b", True, None), (2, "a", None, None), (None, "a", True, None)], "n int, t string, f boolean, e string"
    )
    found = {r["column"]: r for r in describe_all(df).collect()}
    assert (found["n"]["count"], found["n"]["mean"], found["n"]["unique"]) == (2, 1.5, None)
    assert (found["t"]["unique"], found["t"]["top"], found["t"]["freq"]) == (2, "a", 2)
    assert (found["f"]["count"], found["f"]["top"]) == (2, "true")
    assert (found["e"]["count"], found["e"]["unique"], found["e"]["top"]) == (0, 0, None)
    profile = {r["column"]: r["nulls"] for r in op.profile(df).collect()}
    assert profile == {"n": 1, "t": 0, "f": 1, "e": 3}


def plain_stats(values):
    """Count, mean, deviation, extremes and quartiles by pandas."""
    d = pd.Series([v for v in values if v is not None and v == v], dtype="float64").describe()
    return [float(d[k]) for k in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")]


SHAPES = {
    "spread": lambda r, i: r.gauss(1e9, 1.0),
    "few": lambda r, i: float(r.choice([1, 1, 1, 2, 5])),
    "holes": lambda r, i: None if i % 3 else float("nan") if i % 7 == 0 else r.random(),
    "long tail": lambda r, i: r.random() ** -3,
    "none": lambda r, i: None,
    "one": lambda r, i: 4.0 if i == 5 else None,
    "signed": lambda r, i: -0.0 if i % 2 else float(i - 9_000),
}


@pytest.mark.parametrize("n", [7, 3_000, 20_000])
def test_states_merge_to_exact_profiles(spark, n):
    r = random.Random(n)
    rows = [(i % 5, *(make(r, i) for make in SHAPES.values())) for i in range(n)]
    frame = spark.createDataFrame(rows, T.StructType([
        T.StructField("part", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in SHAPES),
    ])).repartition(3)
    names = frame.columns[1:]
    states = profile_states(frame, names, by=["part"])
    assert states.count() == len(names) * min(n, 5)
    found = {x["column"]: x for x in describe_states(merge_states(states), frame).collect()}
    rough = {x["column"]: x for x in describe_states(merge_states(states)).collect()}
    assert set(found) == set(names)
    for k, c in enumerate(names, 1):
        values = [row[k] for row in rows]
        got = [found[c][x] for x in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        got = [math.nan if x is None else x for x in got]
        assert got == pytest.approx(plain_stats(values), rel=1e-6, nan_ok=True), c
        real = sorted(v for v in values if v is not None and v == v)
        assert found[c]["nulls"] == n - len(real)
        assert found[c]["distinct"] == pytest.approx(len(set(real)), rel=0.1, abs=1)
        for p in (25, 50, 75) if len(real) > 100 else ():
            at = rough[c][f"p{p}"]
            assert bisect.bisect_left(real, at) - 0.01 * n <= p / 100 * len(real) <= bisect.bisect_right(real, at) + 0.01 * n


def test_states_of_nothing(spark):
    none = spark.createDataFrame([], "part int, v double")
    assert describe_states(merge_states(profile_states(none, ["v"], by=["part"])), none).collect() == []
    row = describe_states(profile_states(none, ["v"]), none).first()
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None


def test_states_of_missing_groups(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "part int, v double")
    merged = merge_states(profile_states(frame, ["v"], by=["part"]), ["part"])
    assert {(x["part"], x["count"], x["mean"], x["m2"]) for x in merged.collect()} == {(None, 2, 2.0, 2.0), (1, 1, 5.0, 0.0)}


def test_approximate_describe(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    r = describe_all(df, exact=False).first()
    assert (r["p25"], r["p50"], r["p75"]) == (250.0, 500.0, 750.0)


def test_unique_values_dispatch(spark):
    df = spark.createDataFrame(
        [([1, 2], ["a", None], 3, "x", True)], "na array<int>, ta array<string>, n int, t string, b boolean"
    )
    found = op.unique_values(df)
    assert {c: v.kind for c, v in found.items()} == {
        "na": "numeric array", "ta": "text array", "n": "numeric", "t": "text", "b": "not handled"
    }
    assert rows(found["ta"].frame) == [("a",)]
    assert found["na"].frame.first()["mean"] == 1.5


def test_analyze_column(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    report = op.analyze_column(df, "x")
    assert report.nulls.count() == 1
    assert rows(report.duplicates) == [("a",), ("a",)]
    assert rows(report.duplicate_counts) == [("a", 2)]


def test_validate(spark):
    df = spark.createDataFrame(
        [(0.5, "[a]"), (11.0, "x"), (5.0, "y"), (None, None), (0.1, "x")], "rating double, genres string"
    )
    found = {(r["check"], r["column"]): (r["n_bad"], r["sample"]) for r in validate(df).collect()}
    assert found == {("list_format", "genres"): (3, ["x", "y"]), ("range", "rating"): (3, ["0.1", "0.5", "11.0"])}


def test_final_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "MPA string, MPA_min_age string, duration int, duration_converted boolean")
    r = op.final_summary(empty).first()
    assert (r["total_rows"], r["converted"], r["success_rate"]) == (0, 0, None)


def test_hot_keys_are_repeated_in_proportion(spark):
    """Many hot keys take no more key rows than their rows allow, and every row is kept."""
    from marquee.operators.joins import hot_parts, semi_join_spread

    rows = [(k if k < 40 else None, i) for k in range(41) for i in range(1 + 7 * k)] + [(3, 0)] * 50
    df = spark.createDataFrame(rows, "k int, v int")
    counts = df.groupBy("k").count()
    parts = {r["_hot_key"]: r["_parts"] for r in hot_parts(counts, "k", 10).collect()}
    assert len(parts) > 35 and all(n >= 1 for n in parts.values())
    assert sum(parts.values()) <= len(rows) / 10 + len(parts)
    wanted = {3, 20, 39, None}
    keys = spark.createDataFrame([(k,) for k in wanted], "k int")
    kept = semi_join_spread(df, counts, keys, "k", hot_rows=10).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted((r for r in rows if r[0] in wanted), key=repr)


def test_unread_dates(spark):
    from marquee.operators import unread_dates

    texts = ["July 4, 2001", "in  July 2001", "in\xa0May 1999", "in May 1999", "Q1 2001", " ", None, "\u0665 x", "1/2/69", "1/2/68"]
    df = spark.createDataFrame([(t,) for t in texts], "release_date string")
    got = {r["shape"]: (r["rows"], r["texts"], r["sample"]) for r in unread_dates(df).collect()}
    assert got == {
        "aa aaaa 9999": (1, 1, "in  July 2001"), "aa aaa 9999": (2, 2, "in May 1999"), "a9 9999": (1, 1, "Q1 2001"), "9 a": (1, 1, "\u0665 x"),
    }


def test_an_id_with_very_many_titles(spark):
    """Its titles are spread over tasks and pieces, in order, and none is lost."""
    from marquee.operators import duplicate_pieces, duplicate_report

    many = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('tt', id div 2)) as id", "concat('title ', id % 20000) as title")
    rows = duplicate_pieces(many, piece_bytes=1_000, hot_rows=1_000).collect()
    titles = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["piece"])):
        titles.setdefault(r["id"], []).append(r["titles"])
    want = {r["id"]: r["titles"] for r in duplicate_report(many).collect()}
    assert {i: ", ".join(t) for i, t in titles.items()} == want
    assert len(titles["hot"]) > 50 and max(len(r["titles"]) for r in rows) < 1_100
