"""Near duplicates by MinHash against brute force."""

import random

import numpy as np
import pytest

import __spark_entry__ as entry
from cases import ROWS, write
from test_duplicates import frame

from marquee.llm.minhash import Settings, Shingles, drop_similar, functions, signatures_of, similar_groups


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_links(sets, least=85):
    """Linked pairs of distinct sets, by brute force over those that share a shingle."""
    where = {}
    for k, s in enumerate(sets):
        for shingle in s:
            where.setdefault(shingle, []).append(k)
    pairs = {(a, b) for at in where.values() for i, b in enumerate(at) for a in at[:i]}
    return {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def plain_roots(texts):
    """The least position that each text can reach."""
    sets = [plain_set(t) for t in texts]
    distinct = sorted(set(sets), key=sets.index)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    for k, s in enumerate(sets):
        if s:
            join(sets.index(s), k)
    for a, b in plain_links(distinct):
        join(sets.index(distinct[a]), sets.index(distinct[b]))
    return [find(x) for x in range(len(texts))]


def changed(words, n, draw):
    out = list(words)
    for at in draw.sample(range(len(out)), n):
        out[at] = f"other{draw.random()}"
    return " ".join(out)


def families(seed):
    """Near copies of several bases, a chain, and a template that many fill in their own way."""
    draw = random.Random(seed)
    texts = []
    for _ in range(40):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([60, 150, 400]))]
        texts += [" ".join(base), changed(base, 1, draw), changed(base, 2, draw), changed(base, len(base) // 40, draw)]
    # Neighbours in this chain are similar, its ends are not.
    long = [f"c{i}" for i in range(400)]
    texts += [" ".join(long[at:at + 200]) for at in range(0, 200, 8)]
    texts += [" ".join(long[:200] + [f"{k}x{i}" for i in range(draw.choice([15, 30, 200]))]) for k in range(60)]
    texts += ["", None, " \t", "One two", "one TWO", "a b c d e", "A b c d e"]
    return texts


@pytest.mark.parametrize("seed", [5, 6])
def test_components_by_brute_force(spark, tmp_path, seed):
    texts = families(seed)
    roots = plain_roots(texts)
    assert len(set(roots)) < 0.8 * len(texts)
    rows = similar_groups(frame(spark, list(enumerate(texts)), tmp_path)).collect()
    assert {r["id"]: r["component_id"] for r in rows} == dict(enumerate(roots))
    assert {r["id"]: r["n"] for r in rows} == {k: len(plain_set(t)) for k, t in enumerate(texts)}
    assert sorted(r["id"] for r in rows if r["kept"]) == sorted(set(roots))


@pytest.mark.parametrize("copies", [100, 200, 400])
def test_pairs_grow_with_the_rows(spark, tmp_path, copies, monkeypatch):
    """One group of texts that share most shingles, and are linked only in part, is not compared pair by pair."""
    from marquee.llm import minhash

    draw = random.Random(copies)
    base = [f"t{i}" for i in range(150)]
    texts = [changed(base, draw.randrange(0, 9), draw) for _ in range(copies)]
    asked = []

    def counted(pairs, *rest, real=minhash.confirmed):
        asked.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(minhash, "confirmed", counted)
    rows = similar_groups(frame(spark, list(enumerate(texts)), tmp_path)).collect()
    assert {r["id"]: r["component_id"] for r in rows} == dict(enumerate(plain_roots(texts)))
    assert sum(asked) < 40 * copies


def test_minima_agree_as_often_as_sets_overlap():
    shingles, settings = Shingles(5), Settings(bands=64)
    words = [f"w{i}" for i in range(1_000)]
    a, b = shingles(" ".join(words).encode()), shingles(" ".join(words[100:]).encode())
    minima = signatures_of([a, b], functions(settings))
    share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minima[0] == minima[1]).mean() - share) < 4 * (share * (1 - share) / settings.minima) ** 0.5


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    roots = plain_roots([t for _, t in docs])
    want = {i: (len(plain_set(t)), docs[k][0], docs[k][0] == i) for (i, t), k in zip(docs, roots, strict=True)}
    rows = entry.queries()["op12_minhash"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == want
    assert len(set(roots)) < len(docs)


def test_cases(spark, tmp_path):
    docs = write(spark, ROWS, tmp_path / "documents.parquet")
    left = drop_similar(docs)
    assert left.columns == docs.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert kept.count(7) == 1 and 8 not in kept and {2, 3, 4} <= set(kept)
    none = docs.limit(0)
    none.write.parquet(str(tmp_path / "none"))
    assert drop_similar(spark.read.parquet(str(tmp_path / "none"))).count() == 0
