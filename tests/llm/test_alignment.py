"""Alignment of two tokenizers against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from cases import ROWS, write
from marquee.llm.alignment import Settings, Tokenizers, align, diagonals, groups_of, pair_counts, rate
from marquee.llm.word_ids import byte_letters

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a b", "a  b", "a\nb", "a\n\nb", "a \n b", "\n", "\na", " \n a", "a\tb \tc\t d", "\r\n x;\r\n y",
    "<|endoftext|>", "a <s> </s> <unk> <0x41> b", "x▁y", "▁", "café 日本語 \U0001f600  nb", "\x00 \x1c \x85 z", "don't I'll 's",
    "x" * 5_000, "ab" * 3_000, " ".join(f"{i}" for i in range(3_000)), "　　wide　space", "tail \n", "ź ́ q", "क्ष हि",
]


def plain(rows):
    """Every column by walking through the offsets of each document, for (id, text) rows."""
    letters = {letter: byte for byte, letter in byte_letters().items()}
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    out, corpus = [], Counter()
    for i, text in rows:
        groups = []
        if text:
            raw = (" " + text).encode()
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            ab = [bytes(letters[c] for c in a_lib.id_to_token(x)) for x in a]
            bb = [bytes([int(b_lib.id_to_piece(x)[3:5], 16)]) if b_lib.is_byte(x) else b_lib.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(ab) == raw == b"".join(bb):
                cuts = set(np.cumsum([len(x) for x in ab]).tolist()) & set(np.cumsum([len(x) for x in bb]).tolist())
                at_a = at_b = n_a = n_b = 0
                for cut in sorted(cuts):
                    x, y = [], []
                    while at_a < cut:
                        x.append(a[n_a])
                        at_a += len(ab[n_a])
                        n_a += 1
                    while at_b < cut:
                        y.append(b[n_b])
                        at_b += len(bb[n_b])
                        n_b += 1
                    groups.append((x, y))
        links = Counter()
        for x, y in groups:
            for p, n in Counter(x).items():
                for q, m in Counter(y).items():
                    links[p, q] += n * m
        corpus.update(links.keys())
        out.append((i, groups, links))
    best = defaultdict(int)
    for (p, _), n in corpus.items():
        best[p] = max(best[p], n)
    return [
        (i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
         sum(n for pair, n in links.items() if corpus[pair] == best[pair[0]]), sum(n * corpus[pair] for pair, n in links.items()),
         hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if groups else "")
        for i, groups, links in out
    ]


NAMES = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rated(docs, settings):
    aligned = align(docs, A, B, settings)
    return sorted((tuple(r[c] for c in NAMES) for r in rate(aligned, pair_counts(aligned), settings).collect()), key=repr)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1_000])
def test_merge_path(work):
    draw = random.Random(work)
    for _ in range(60):
        a, b = (np.array(sorted(draw.sample(range(1, 60), draw.randrange(0, 30))) + [60]) for _ in "ab")
        i, j = diagonals(a, b, work)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all() and (np.diff(i + j) <= work + 1).all()
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            assert (not x or y == len(b) or a[x - 1] < b[y]) and (not y or x == len(a) or b[y - 1] < a[x])
        of_a, of_b = groups_of(a, b, work)
        ends = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[np.cumsum(of_a) - 1].tolist() == ends == b[np.cumsum(of_b) - 1].tolist()


def test_chunks_give_the_ids_of_whole_texts():
    with open(A, encoding="utf-8") as x, open(B, "rb") as y:
        both = Tokenizers(x.read(), y.read())
    assert both.cut
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r", " ", "\x1c", "a", "The", "don't", "é", "1", ".", "<s>", "▁", "日", ",", ").", "für", "łódź", "s>", "k>", "ʒa"]
    texts = [t for t in TEXTS if t] + ["".join(draw.choices(parts, k=draw.randrange(1, 12))) for _ in range(3_000)]
    for text in texts:
        if "▁" in text:
            assert both(text) is None
            continue
        assert both.chunked(" " + text) == both.whole(" " + text), repr(text)


@pytest.mark.parametrize("settings", [Settings(), Settings(work=5, known=40, wide=3), Settings(known=0)])
def test_cases(spark, tmp_path, settings):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + ROWS
    docs = write(spark, rows, tmp_path / "docs")
    assert rated(docs, settings) == sorted(plain([r[:2] for r in rows]), key=repr)
    assert rated(docs.limit(0), settings) == []


def test_query(spark):
    rows = entry.queries()["op13_alignment"](spark, SF).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in rows) == sorted(plain(docs))
