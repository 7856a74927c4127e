"""Readers, writers, whole runs and the refresh stream."""

import csv
import logging
import os

import pyarrow as pa
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from marquee.plans import check_columns, clean_catalogue, normalise_catalogue, run_catalogue, to_catalogue_v2
from marquee.plans.schemas import CATALOGUE
from marquee.operators import lead_columns
from marquee.sinks import drop_staged, stage, write_arrow, write_csv, write_duplicates, write_outputs, write_yearly
from marquee.sources import (
    UnreadableFiles, list_year_files, read_csv, read_csv_files, read_pages, read_years, scan_csv_files,
)
from marquee.sources.csv import group_by_header
from marquee.streaming import current_catalogue, merge_batch, prune_store, read_manifest, refresh_catalogue


def put(root, year, header, *rows, name=None):
    folder = root / str(year)
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / (name or f"merged_movies_data_{year}.csv"), "w", newline="") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture
def years(tmp_path):
    root = tmp_path / "Data"
    put(root, 1999, ["Title", "Year", "Movie Link", "Rating", "genres"],
        ["1. A", "1999", "https://h/title/tt1/?x", "7.5", "['Drama', \"O'B\"]"],
        ["2. B", "1999", "https://h/title/tt2/", "12", "[]"],
        ["3. C\n\"c\"", "1999", "", "3", ""])
    put(root, 2000, ["Movie Link", "Title", "extra", "Year"],
        ["https://h/title/tt1/", "1. A2", "e", "2000"], ["https://h/title/tt3/", "N/A", "e", "2000.0"])
    put(root, 2000, ["a"], ["1"], name="other.csv")
    (root / "stray.csv").write_text("x\n")
    return root


def test_files_are_found(spark, years):
    names = [p.rsplit("/", 1)[1] for p in list_year_files(spark, str(years))]
    assert names == ["merged_movies_data_1999.csv", "merged_movies_data_2000.csv"]


def test_no_files(spark, tmp_path):
    with pytest.raises(ValueError):
        read_years(spark, str(tmp_path))


def test_columns_align_by_name(spark, years):
    rows = read_years(spark, str(years)).orderBy("src_year", "_src_file", "_src_pos").collect()
    assert [(r["src_year"], r["Title"], r["Movie Link"]) for r in rows] == [
        (1999, "1. A", "https://h/title/tt1/?x"), (1999, "2. B", "https://h/title/tt2/"), (1999, '3. C\n"c"', None),
        (2000, "1. A2", "https://h/title/tt1/"), (2000, "N/A", "https://h/title/tt3/"),
    ]
    assert rows[0]["genres"] == "['Drama', \"O'B\"]"


def test_reordered_header(spark, tmp_path):
    put(tmp_path, 1, ["a", "b"], ["a1", "b1"], name="x.csv")
    put(tmp_path, 2, ["b", "a", "x"], ["b2", "a2", "x2"], name="x.csv")
    df = read_csv_files(spark, [str(tmp_path / "1/x.csv"), str(tmp_path / "2/x.csv")])
    assert {(r["a"], r["b"], r["x"]) for r in df.collect()} == {("a1", "b1", None), ("a2", "b2", "x2")}


def test_unreadable_file_is_skipped(spark, years, caplog):
    paths = [*list_year_files(spark, str(years)), str(years / "1990/absent.csv")]
    with caplog.at_level(logging.WARNING):
        found = scan_csv_files(spark, paths)
    assert found.rows.count() == 5
    assert [p.rsplit("/", 1)[1] for p in found.skipped] == ["absent.csv"]
    assert "absent.csv" in caplog.text
    with pytest.raises(UnreadableFiles) as e:
        read_csv_files(spark, paths)
    assert e.value.skipped == found.skipped


def test_na_tokens(spark, tmp_path):
    put(tmp_path, 1, ["a", "b"], ["None", "x"], ["NA", ""], name="x.csv")
    path = str(tmp_path / "1/x.csv")
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [(None, "x"), (None, None)]
    assert [r["a"] for r in read_csv(spark, path, na_tokens=None).collect()] == ["None", "NA"]


def test_pages_from_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>\n1")
    row = read_pages(spark, str(tmp_path), "files").first()
    assert row["html"] == "<p>\n1" and row["url"].endswith("a.html")


def test_clean_has_all_columns(spark, years):
    raw = read_years(spark, str(years))
    check = check_columns(raw)
    assert check.unexpected == ["extra"] and "budget" in check.absent
    cleaned = clean_catalogue(raw)
    types = dict(cleaned.dtypes)
    for field in CATALOGUE.fields:
        assert types[field.name] == field.dataType.simpleString(), field.name
    assert "year" not in types and "extra" in types


def test_column_order(spark):
    header = ["Title", "Year", "Duration", "MPA", "Rating", "Votes", "méta_score", "description", "Movie Link",
              "writers", "directors", "stars", "budget", "opening_weekend_Gross", "grossWorldWWide", "gross_US_Canada",
              "release_date", "countries_origin", "filming_locations", "production_company", "awards_content",
              "genres", "Languages"]
    raw = spark.createDataFrame([tuple([None] * 23)], ", ".join(f"`{c}` string" for c in header))
    assert check_columns(raw) == ([], [])
    assert lead_columns(clean_catalogue(raw)).columns == CATALOGUE.names
    documented = raw.withColumnsRenamed({"méta_score": "meta_score", "grossWorldWWide": "grossWorldWide"})
    assert lead_columns(clean_catalogue(documented)).columns == CATALOGUE.names


def test_awards_and_lists(spark):
    raw = spark.createDataFrame([("2 wins", ["a", "b"])], "awards_content string, writers array<string>")
    row = clean_catalogue(raw).first()
    assert (row["awards_content"], row["writers"]) == (None, "['a', 'b']")
    assert clean_catalogue(raw, awards_as_text=True).first()["awards_content"] == "2 wins"


def test_whole_run(spark, years, tmp_path):
    out = str(tmp_path / "out")
    run = run_catalogue(spark, str(years), out)
    assert (run.rows_read, run.rows_kept) == (5, 4)
    assert run.has_duplicates and [p.rsplit(".", 1)[1] for p in run.written] == ["parquet", "csv", "arrow"]
    frames = [
        spark.read.parquet(f"{out}/final_dataset.parquet"),
        spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{out}/final_dataset.csv"),
    ]
    expected = [("tt1", "A2"), ("tt2", "B"), ("tt3", None), (None, 'C\n"c"')]
    for df in frames:
        assert sorted(((r["id"], r["title"]) for r in df.collect()), key=repr) == sorted(expected, key=repr)
    arrow = ds.dataset(f"{out}/final_dataset.arrow", format="arrow").to_table()
    assert arrow.num_rows == 4 and arrow.column_names == frames[0].columns
    report = spark.read.option("header", True).csv(f"{out}/duplicates.csv").collect()
    assert [tuple(r) for r in report] == [("tt1", "2", "A, A2")]


def test_normalise_after_bridge(spark, years):
    v2 = to_catalogue_v2(clean_catalogue(read_years(spark, str(years))))
    df = normalise_catalogue(v2.filter("id IS NOT NULL"))
    types = dict(df.dtypes)
    assert (types["year"], types["rating"], types["meta_score"]) == ("int", "float", "bigint")
    row = df.filter("title = 'b'").first()
    assert (row["year"], row["rating"], row["duration"], row["MPA"], row["votes"], row["rating_was_missing"]) == (
        1999, 10.0, -1, "unrated", -1, True)


def test_long_film_keeps_its_length(spark):
    df = spark.createDataFrame(
        [("x", "t", "2000", "857h", None, 7.0, "3000m", None)],
        "id string, title string, year string, duration string, MPA string, rating double, votes string, meta_score int",
    )
    row = normalise_catalogue(df).first()
    assert (row["duration"], row["votes"], row["meta_score"], row["meta_score_was_missing"]) == (51420, 3_000_000_000, -1, True)


def test_csv_keeps_cells(spark, tmp_path):
    cells = [" lead", "trail ", "a,b", 'q"q', "line\nbreak", "\xa0nb", None, "\\", '\\"', "é"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    write_csv(df, str(tmp_path / "x"))
    back = read_csv(spark, str(tmp_path / "x"), na_tokens=None)
    assert [r["c"] for r in back.orderBy(F.col("i").cast("int")).collect()] == cells


def test_yearly_folders_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1999, ["a'b", "c"]), (2000, [])], "src_year int, l array<string>")
    write_yearly(df, str(tmp_path / "y"))
    back = read_csv_files(spark, [f"file:{p}" for p in sorted(tmp_path.glob("y/*/part-*.csv"))])
    assert sorted((r["src_year"], r["l"]) for r in back.collect()) == [(1999, "[\"a'b\", 'c']"), (2000, "[]")]


def test_no_duplicates_no_report(spark, tmp_path):
    empty = spark.createDataFrame([], "id string, count bigint, titles string")
    assert not write_duplicates(empty, str(tmp_path / "d"))
    assert not (tmp_path / "d").exists()


def test_one_bad_format_does_not_stop_others(spark, tmp_path):
    df = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")  # CSV has no maps
    written = write_outputs(df, str(tmp_path), ("csv", "parquet"))
    assert [p.rsplit(".", 1)[1] for p in written] == ["parquet"]
    with pytest.raises(ValueError):
        write_outputs(df, str(tmp_path), ("xlsx",))


def test_arrow_overwrite_and_empty(spark, tmp_path):
    path = str(tmp_path / "a")
    write_arrow(spark.range(100).repartition(3), path)
    write_arrow(spark.range(10).repartition(2), path)
    assert ds.dataset(path, format="arrow").to_table().num_rows == 10
    write_arrow(spark.range(0), path)
    table = ds.dataset(path, format="arrow").to_table()
    assert table.num_rows == 0 and table.schema.field("id").type == pa.int64()
    assert not list(tmp_path.glob("a/_staging*"))


def test_arrow_failure_leaves_old_files(spark, tmp_path):
    path = str(tmp_path / "a")
    write_arrow(spark.range(5), path)
    with pytest.raises(Exception):
        write_arrow(spark.range(100).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert ds.dataset(path, format="arrow").to_table().num_rows == 5
    assert not list(tmp_path.glob("a/_staging*"))


def test_staged_frame(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    staged = stage(df)
    assert staged.schema == df.schema and sorted(staged.collect()) == sorted(df.collect())


def test_refresh_equals_batch(spark, years, tmp_path):
    store, state = str(tmp_path / "store"), str(tmp_path / "state")
    refresh_catalogue(spark, str(years), store, state, files_per_batch=1).awaitTermination()
    before = sorted(map(repr, current_catalogue(spark, store).collect()))
    for deleted in (True, False):
        assert bool(prune_store(spark, store)) == deleted
        assert len(list((tmp_path / "store" / "manifests").glob("version=*"))) == 1
        assert sorted(map(repr, current_catalogue(spark, store).collect())) == before
    put(years, 2001, ["Title", "Year", "Movie Link"], ["1. B2", "2001", "https://h/title/tt2/"], ["2. D", "x", ""])
    refresh_catalogue(spark, str(years), store, state).awaitTermination()
    refresh_catalogue(spark, str(years), store, state).awaitTermination()  # nothing new
    current = current_catalogue(spark, store)
    batch = run_catalogue(spark, str(years), str(tmp_path / "out"), ("parquet",))
    expected = spark.read.parquet(*batch.written)
    columns = expected.columns
    assert sorted(map(repr, current.select(*columns).collect())) == sorted(map(repr, expected.collect()))


def test_batches_touch_their_own_buckets(spark, tmp_path):
    store = str(tmp_path / "store")
    order = "src_year int, _src_file string, _src_pos long"

    def merge(rows, batch, source="s", **more):
        frame = spark.createDataFrame(rows, f"id string, title string, {order}")
        return merge_batch(spark, frame.select("*", *(F.lit(v).alias(k) for k, v in more.items())), store, batch, source)

    def titles():
        return {r["id"]: r["title"] for r in current_catalogue(spark, store).collect()}

    with pytest.raises(ValueError, match="no batch"):
        current_catalogue(spark, store)
    want = {f"tt{i}": "a" for i in range(2_000)} | {None: "none"}
    merge([(i, t, 2000, "f", k) for k, (i, t) in enumerate(want.items())], 0)
    assert titles() == want and len(read_manifest(spark, store).versions) > 200
    late = {f"tt{i}": "b" for i in range(5)} | {f"new{i}": "b" for i in range(5)}
    rows = [(i, t, 2001, "f", k) for k, (i, t) in enumerate(late.items())] + [("tt9", "older", 1999, "f", 1)]
    touched = merge(rows, 1, extra=3)
    assert 1 < len(touched) <= 11
    written = list((tmp_path / "store" / "data" / "version=1").glob("_bucket=*"))
    assert len(written) == len(touched)
    assert titles() == want | late
    assert merge(rows, 1, extra=3) == []  # the same batch once more
    # A batch that was cut short before its manifest leaves the store as it was, and is merged by the next try.
    merge([("tt1", "c", 2002, "f", 1)], 2)
    (tmp_path / "store" / "manifests" / "version=2" / "_SUCCESS").unlink()
    assert titles() == want | late
    assert len(merge([("tt1", "c", 2002, "f", 1)], 2)) == 1
    assert titles() == want | late | {"tt1": "c"}
    assert merge([], 3) == []
    assert len(merge([("tt2", "d", 2002, "f", 1)], 1, "other checkpoint")) == 1
    assert prune_store(spark, store) > 0
    assert titles() == want | late | {"tt1": "c", "tt2": "d"}
    assert current_catalogue(spark, store).filter("extra = 3").count() == 10 - 2


def test_refresh_stops_at_an_unreadable_file(spark, years, tmp_path):
    """The batch is not committed, so the file is read once it is whole."""
    store, state = str(tmp_path / "store"), str(tmp_path / "state")
    (years / "2002").mkdir()
    broken = years / "2002" / "merged_movies_data_2002.csv"
    broken.write_text("\n")
    query = refresh_catalogue(spark, str(years), store, state)
    with pytest.raises(Exception, match="no header"):
        query.awaitTermination()
    broken.write_text("Title,Year,Movie Link\n1. New,2002,https://h/title/tt99/\n")
    refresh_catalogue(spark, str(years), store, state).awaitTermination()
    assert "tt99" in {r["id"] for r in current_catalogue(spark, store).collect()}


def test_arrow_files_roll_and_fail_early(spark, tmp_path, monkeypatch):
    from marquee.sinks import arrow

    with pytest.raises(Exception):
        write_arrow(spark.range(3), "nowhere://host/out")
    assert arrow.qualified(spark, "/a/b") == "file:/a/b"
    filesystem, path = arrow._locate("file:/a/b")
    assert (filesystem.type_name, path) == ("local", "/a/b")
    monkeypatch.setattr(arrow, "FILE_BYTES", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        write_arrow(spark.range(0, 45, 1, 1), str(tmp_path / "rolled"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = sorted((tmp_path / "rolled").glob("part-*.arrow"))
    assert len(files) == 5
    assert ds.dataset(files, format="arrow").to_table().column("id").to_pylist() == list(range(45))


def test_staged_tables_can_be_dropped(spark):
    drop_staged(spark)
    kept = stage(spark.range(3))
    (path,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
    assert drop_staged(spark) == 1
    assert not os.path.exists(path.removeprefix("file://"))
    assert drop_staged(spark) == 0


def test_headers_take_no_job_per_file(spark, tmp_path):
    for year in range(1990, 2002):
        put(tmp_path, year, ["a", "b c", 'd"e'] if year % 2 else ["b c", "a"], *[["1", "2", "3"]] * 2)
    put(tmp_path, 2002, ["a", "", "a"], ["1", "2", "3"])
    paths = list_year_files(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = group_by_header(spark, paths)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(found.by_header, key=len) == [("b c", "a"), ("a", "b c", 'd"e'), ("a0", "_c1", "a2")]
    assert len(tracker.getJobIdsForGroup("headers")) <= 1


def test_first_lines_are_bounded(spark, tmp_path, monkeypatch):
    from marquee.sources import csv as source

    monkeypatch.setattr(source, "MOST_HEADER_BYTES", 1 << 17)
    wide = [f"column{i}" for i in range(9_000)]
    put(tmp_path, 2000, wide, ["1"])
    put(tmp_path, 2001, ["a", "b"])
    (tmp_path / "2002").mkdir()
    (tmp_path / "2002" / "merged_movies_data_2002.csv").write_text("x" * 400_000)
    (tmp_path / "2003").mkdir()
    (tmp_path / "2003" / "merged_movies_data_2003.csv").write_bytes(b"a,b\r\n1,2\r\n")
    found = group_by_header(spark, list_year_files(spark, str(tmp_path)))
    assert set(found.by_header) == {tuple(wide), ("a", "b")}
    assert len(found.by_header["a", "b"]) == 2
    assert ["no line break" in why for why in found.skipped.values()] == [True]
