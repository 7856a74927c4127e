"""The mixture's order reaches the packed sequences."""

from collections import Counter, defaultdict

from marquee.llm.common import ROW
from test_tokens import check_packing


def _corpus(spark, path):
    """Two sources of unlike size and length; the small one runs out half way if it weighs as much as the large one."""
    rows = [(i, f"word{i % 7} " * (40 + i % 50), "en", "rare" if i < 300 else "common") for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.repartition(3).write.parquet(str(path))
    return rows, spark.read.parquet(str(path))


def test_shares_of_sources_over_sequences(spark, tmp_path):
    from marquee.llm.mixing import mixed_order
    from marquee.llm.packing import Settings, pack_in_order
    from marquee.llm.queries import vocabulary

    rows, docs = _corpus(spark, tmp_path / "documents.parquet")
    mixed_order(docs, {"rare": 1, "common": 1}).write.parquet(str(tmp_path / "mixed"))
    got = pack_in_order(
        spark.read.parquet(str(tmp_path / "mixed")), vocabulary("word_bpe_49k.json"), Settings(problem=100, children=5)
    ).collect()
    check_packing(got, [(i, t) for i, t, _, _ in rows])
    source, shares = {r[0]: r[3] for r in rows}, defaultdict(Counter)
    for r in got:
        shares[r["sequence_id"] >> 32][source[r["doc_id"]]] += 1
    assert sorted(shares) == list(range(12))
    # Equal weights: equal shares until the rare source runs out after 600 documents; then none of it.
    for k in range(6):
        assert abs(shares[k]["rare"] - 50) <= 2, shares
    for k in range(7, 12):
        assert shares[k]["rare"] == 0, shares


def test_run_follows_the_mixture(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from marquee.llm.packing import Settings, pack_in_order

    _, docs = _corpus(spark, tmp_path / "documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "pack_in_order", lambda d, v: pack_in_order(d, v, Settings(problem=100, children=5)))
    mixed = corpus_pipeline.mixing(spark, docs, str(tmp_path))
    order = [r["doc_id"] for r in mixed.select("doc_id").collect()]
    mixed.write.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.packing(spark, spark.read.parquet(str(tmp_path / "mixed")), str(tmp_path)).collect()
    problem = {r["doc_id"]: r["sequence_id"] >> 32 for r in got}
    assert [problem[i] for i in order] == [k // 100 for k in range(1200)]


def test_stretches_over_gaps(spark):
    from marquee.llm.packing import in_order

    numbers = [f << 40 | i * 37 for f in (0, 1, 5) for i in range(500)]
    pieces = spark.createDataFrame([(n, k) for n in numbers for k in range(1 + n % 3)], f"{ROW} long, piece int")
    got = sorted((r[ROW], r["piece"], r["problem"]) for r in in_order(pieces, 7, most=20).collect())
    size = -(-len(got) // 7)
    assert [r[2] for r in got] == [k // size for k in range(len(got))]
