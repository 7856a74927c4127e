"""Row numbers that do not depend on how files are split."""

from cases import ROWS, write


def _split(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_same_numbers_under_other_splits(spark, tmp_path):
    from marquee.llm.common import ROW, placed

    spark.range(40_000).selectExpr("id as doc_id", "uuid() as text").repartition(2).write.option(
        "parquet.block.size", 65_536
    ).parquet(str(tmp_path / "docs"))
    docs = placed(spark.read.parquet(str(tmp_path / "docs")).where("doc_id >= 0"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        _split(spark, "1g")
        one = {r["doc_id"]: r[ROW] for r in docs.select("doc_id", ROW).collect()}
        _split(spark, "100000")
        assert docs.rdd.getNumPartitions() > 2
        assert {r["doc_id"]: r[ROW] for r in docs.select("doc_id", ROW).collect()} == one
    finally:
        _split(spark, old)
    assert len(set(one.values())) == 40_000


def test_splits_change_between_the_readings(spark, tmp_path, monkeypatch):
    from marquee.llm import mixing

    spark.range(40_000).selectExpr("id as doc_id", "uuid() as text", "'s' || id % 3 as source").repartition(2).write.option(
        "parquet.block.size", 65_536
    ).parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    old, stage = spark.conf.get("spark.sql.files.maxPartitionBytes"), mixing.stage

    def then_split(df):
        out = stage(df)
        _split(spark, "100000")
        return out

    monkeypatch.setattr(mixing, "stage", then_split)
    try:
        _split(spark, "1g")
        assert sorted(r["doc_id"] for r in mixing.mixed_order(docs).select("doc_id").collect()) == list(range(40_000))
    finally:
        _split(spark, old)


def test_what_is_not_read_from_files(spark, tmp_path):
    from marquee.llm.common import ROW, placed

    docs = write(spark, ROWS, tmp_path / "docs")
    double = docs.unionByName(docs).selectExpr("doc_id", "explode(array(1, 2)) as n")
    assert placed(double).select(ROW).distinct().count() == 4 * len(ROWS)
    assert placed(docs).drop(ROW).columns == docs.columns
    assert placed(docs.limit(0)).count() == 0
