"""Exact and near duplicates against brute force."""

import hashlib
import itertools
import re

import pytest
import xxhash

import __spark_entry__ as entry
from check_oracles import compare, connect
from marquee.llm.exact_dedup import drop_exact_copies, exact_groups
from marquee.llm.simhash import drop_near_copies, near_groups

SF = "/root/testdata/sf0.001"

BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (7, "a  b\tc"), (3, "a b c"), (3, "a b c"), (None, "a\nb c"), (1, ""), (2, None), (4, " "), (5, " "),
    (6, BASE), (8, BASE.upper()), (9, BASE + " tail"), (10, "x" * 50_000), (11, "x" * 50_000), (12, "one two"),
    (13, "Önly ÄÖ"), (14, "önly ÄÖ"), *((100 + i, BASE) for i in range(40)),
]


def frame(spark, rows, tmp_path, name="docs"):
    path = str(tmp_path / name)
    spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, id string, kept string, n long"
    ).write.parquet(path)
    return spark.read.parquet(path)


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Least position reachable from each, over links of at most two bits."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(fps))]


def test_exact_cases(spark, tmp_path):
    got = exact_groups(frame(spark, TEXTS, tmp_path)).collect()
    assert len(got) == len(TEXTS)
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(sha(t), []).append(i)
    for r in got:
        ids = groups[r["sha"]]
        assert r["n"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
    for digest in groups:
        assert sum(r["kept"] for r in got if r["sha"] == digest) == 1
    left = drop_exact_copies(frame(spark, TEXTS, tmp_path, "again"))
    assert left.columns == ["doc_id", "text", "id", "kept", "n"]
    assert left.count() == len(groups)


def test_exact_empty(spark, tmp_path):
    assert exact_groups(frame(spark, [], tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op11_divergence"])
def test_queries_by_sql(spark, name):
    assert compare(spark, connect(SF), name, SF) is None


def test_near_cases(spark, tmp_path):
    got = near_groups(frame(spark, TEXTS, tmp_path)).collect()
    fps = [plain_fingerprint(t) for _, t in TEXTS]
    assert sorted(r["fp"] % 2**64 for r in got) == sorted(fps)
    roots = plain_components(fps)
    least = {}
    for (i, _), c, fp in zip(TEXTS, roots, fps, strict=True):
        least.setdefault(c, []).append(i)
    want = sorted(
        (fp, min(i for i in least[c] if i is not None)) for c, fp in zip(roots, fps, strict=True)
    )
    assert sorted((r["fp"] % 2**64, r["component_id"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(least)
    left = drop_near_copies(frame(spark, TEXTS, tmp_path, "again"))
    assert left.columns == ["doc_id", "text", "id", "kept", "n"]
    assert left.count() == len(least)
    assert near_groups(frame(spark, [], tmp_path, "none")).count() == 0


def test_links_of_chained_fingerprints(spark):
    from marquee.llm.components import components
    from marquee.llm.simhash import links

    chain = [0]
    for i in range(0, 60, 2):
        chain.append(chain[-1] | 3 << i)
    far = [(1 << 63) | 0x0F0F0F << 30, 0x7777777777]
    fps = [x - 2**64 if x >= 2**63 else x for x in chain + far]
    pairs = links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = {r["node"]: r["component"] for r in components(pairs).collect()}
    roots = plain_components([x % 2**64 for x in sorted(fps)])
    order = sorted(fps)
    assert got == {order[i]: order[r] for i, r in enumerate(roots) if i != r}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    import random

    from marquee.llm.components import components

    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = list(range(600))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    assert got == {i: root(i) for i in range(600) if root(i) != i}


def test_near_query(spark):
    rows = entry.queries()["op8_simhash"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [plain_fingerprint(docs[i]) for i in ids]
    want = {i: (f"{fp:016x}", ids[c]) for i, fp, c in zip(ids, fps, plain_components(fps), strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want
