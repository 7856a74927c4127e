"""Pfair mixing: the bound on deviation, and nothing lost."""

import random
from collections import Counter
from fractions import Fraction

import pytest

import __spark_entry__ as entry
from cases import ROWS, write
from marquee.llm.common import table
from marquee.llm.mixing import Settings, mix, mixed_order, schedule, weights_of

SF = "/root/testdata/sf0.001"


def deviation(order, blocks, weights):
    """Largest distance in blocks of a source from its share, until one runs out."""
    total, given, worst = sum(weights.values()), Counter(), Fraction(0)
    for slot, (source, _) in enumerate(order, 1):
        given[source] += 1
        worst = max(worst, *(abs(given[s] - weights[s] / total * slot) for s in blocks))
        if any(given[s] == blocks[s] for s in blocks):
            break
    return worst


@pytest.mark.parametrize("seed", range(12))
def test_deviation_below_one_block(seed):
    draw = random.Random(seed)
    weights = {f"s{i}": Fraction(draw.randrange(1, 1000)) for i in range(draw.randrange(2, 30))}
    blocks = {s: draw.randrange(1, 300) for s in weights}
    order = schedule(blocks, weights)
    assert sorted(order) == sorted((s, k) for s, n in blocks.items() for k in range(n))
    assert deviation(order, blocks, weights) < 1
    for s in blocks:
        assert [k for x, k in order if x == s] == list(range(blocks[s]))


def test_hot_source():
    weights = {**{f"s{i}": Fraction(1) for i in range(20)}, "hot": Fraction(10)}
    blocks = dict.fromkeys(weights, 100)
    assert deviation(schedule(blocks, weights), blocks, weights) < 1


def test_weights_of():
    assert weights_of({"a": 4, None: 9}, {"a": 0.5}) == {"a": Fraction(1, 2), None: Fraction(3)}
    with pytest.raises(ValueError):
        weights_of({"a": 1}, {"a": -1})


@pytest.mark.parametrize("settings", [Settings(), Settings(blocks=7, least_range=2)])
def test_every_row_once(spark, tmp_path, settings):
    docs = write(spark, ROWS, tmp_path / "docs")
    rows = mix(docs, {"s0": 3.0, "s1": 1.0, "s2": 0.0}, settings).collect()
    assert sorted(r["position"] for r in rows) == list(range(len(ROWS)))
    assert Counter((r["id"], r["source"]) for r in rows) == Counter((r[0], r[3]) for r in ROWS)
    order = [r["source"] for r in sorted(rows, key=lambda r: r["position"])]
    assert set(order[-2:]) == {"s2"}  # weight 0 comes last
    size = max(1, -(-len(ROWS) // settings.blocks))
    for source in {r["source"] for r in rows}:
        own = Counter(r["block"] for r in rows if r["source"] == source)
        assert all(own[k] == size for k in sorted(own)[:-1])


def test_order_is_kept_in_files(spark, tmp_path):
    docs = write(spark, ROWS, tmp_path / "docs")
    want = [r["id"] for r in mix(docs).orderBy("position").collect()]
    mixed = mixed_order(docs)
    assert mixed.columns == docs.columns
    mixed.write.parquet(str(tmp_path / "mixed"))
    assert [r["doc_id"] for r in spark.read.parquet(str(tmp_path / "mixed")).collect()] == want
    assert mix(docs.limit(0)).count() == 0


def test_order_does_not_depend_on_splits(spark, tmp_path):
    docs = write(spark, ROWS * 20, tmp_path / "docs")
    orders = []
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            orders.append([tuple(r) for r in mix(docs, settings=Settings(blocks=50)).orderBy("position").collect()])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert orders[0] == orders[1]


def test_query(spark):
    rows = entry.queries()["op5_mixing"](spark, SF).collect()
    assert sorted(r["position"] for r in rows) == list(range(table(spark, SF, "documents").count()))
    weights = {s: Fraction(n) ** 1 for s, n in Counter(r["source"] for r in rows).items()}
    blocks = {s: 1 + max(r["block"] for r in rows if r["source"] == s) for s in weights}
    order = [(r["source"], r["block"]) for r in sorted(rows, key=lambda r: r["position"])]
    if len(order) == sum(blocks.values()):
        assert deviation(order, blocks, weights_of({s: int(n) for s, n in weights.items()}, None)) < 1
