"""The pipeline against its stages' brute-force versions."""

import hashlib
import re

import corpus_pipeline
from cases import ROWS, write
from test_duplicates import plain_components, plain_fingerprint
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def survivors(docs, toxic):
    """Ids that the filtering stages keep."""
    docs = sorted((i, t) for i, t in docs if i not in toxic)
    seen, unique = set(), []
    for i, t in docs:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).digest()
        if digest not in seen:
            seen.add(digest)
            unique.append((i, t))
    roots = plain_components([plain_fingerprint(t) for _, t in unique])
    return [doc for k, doc in enumerate(unique) if roots[k] == k]


def test_run(spark):
    from marquee.llm.toxicity import toxicity

    frame = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity(frame, labels).where("predicted = 1").collect()}
    docs = [(r["doc_id"], r["text"]) for r in frame.collect()]
    used, bound = check_packing(corpus_pipeline.run(spark, SF).collect(), survivors(docs, toxic))
    assert used <= bound + 1


def test_stages_keep_columns(spark, tmp_path):
    docs = write(spark, ROWS, tmp_path / "documents.parquet")
    spark.createDataFrame([(1, 0), (5, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            assert docs.count() > 0
    empty = docs.limit(0)
    empty.write.parquet(str(tmp_path / "none"))
    empty = spark.read.parquet(str(tmp_path / "none"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
