"""Token counts, packed pieces and token files against the tokenizers library."""

import glob
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

import __spark_entry__ as entry
from cases import ROWS, write
from marquee.llm.common import table
from marquee.llm.packing import Settings, best_fit, crossover, evolve, mutated, pack_documents
from marquee.llm.queries import vocabulary
from marquee.llm.token_counts import Counter, Merger, class_table, compose, count_tokens, read_vocabulary, splitter
from marquee.llm.token_files import checksums, new_folder, read_tokens, write_tokens
from marquee.llm.word_ids import WordIds

SF = "/root/testdata/sf0.001"
BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = [
    "", "a", " a", "  a", "a  b", "a\n\nb", "a \n b", "\n a", "  ", "it's", "it'stuff", "'re", "'r", "'rx", "'ll", "'lx", "''s",
    " 's", "!'s", "'s's", "don't we're'll", "'ree", "'r're", "x'r", "1'2", "\t\t1", "\u00a0a\u2003 b", "<|endoftext|>",
    "a<|endoftext|>b <|endoftext|>", "\u65e5\u672c\u8a9e", "\U0001f600 x", "\x00\x01", "'S", "\x1c\x1d a", "\x85 b", "a'", "'",
    "caf\u00e9 cafe\u0301", "\u0130\u03a3\u03c2", "end.\"", "a-b_c", "WORD!! ###", "\u212aelvin",
]


def random_texts(seed, n):
    draw = random.Random(seed)
    letters = "abstmdrvelAZ''' \n\t .,!1\u00e9\u65e5\u00df\u0301\x1c<|>"
    for _ in range(n):
        yield "".join(
            chr(draw.choice([draw.randrange(0xD7FF), draw.randrange(0xE000, 0x110000)])) if draw.random() < 0.1 else draw.choice(letters)
            for _ in range(draw.randrange(60))
        )


@pytest.fixture(scope="module")
def counter():
    return Counter(*read_vocabulary(BYTES), class_table(BYTES))


def test_counts_against_library(counter):
    library = Tokenizer.from_file(BYTES)
    texts = ODD + list(random_texts(1, 3_000)) + ["hello " * 100_000, "\u00e9" * 5_000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts) == want
    assert [counter.counts([t])[0] for t in ODD] == want[: len(ODD)]


def test_pieces_across_chunks(counter):
    library = Tokenizer.from_file(BYTES)
    for text in ("it's  we'll \n\n 12" * 400, " " * 2_000 + "a", "'" * 999 + "re"):
        pieces, first = counter.pieces(["zz", text, ""])
        inner = pieces[first[1]:first[2]]
        assert "".join(inner) == text
        assert len(inner) == len(library.pre_tokenizer.pre_tokenize_str(text))


def test_compose_is_a_prefix_scan():
    draw = np.random.default_rng(3)
    maps = draw.integers(0, 5, (13, 5))
    now, want = np.arange(5), []
    for m in maps:
        now = m[now]
        want.append(now)
    assert (compose(maps) == np.array(want)).all()


def test_merger_forgets_and_stays_right(monkeypatch):
    import marquee.llm.token_counts as module

    monkeypatch.setattr(module, "STATES_KEPT", 50)
    vocab, ranks, _ = read_vocabulary(BYTES)
    merger, library = Merger(vocab, ranks), Tokenizer.from_file(BYTES)
    for word in ("internationalization", "\u65e5\u672c", "zzzzzzzz", "thththth", "aaaaaaaaaaaaaaaaaaaaaaa") * 3:
        assert merger.count(word.encode()) == len(library.encode(word).ids)


def test_splitter_is_complete():
    step, mark = splitter()
    assert step.min() >= 0 and step.max() < len(step) and mark.shape == step.shape


def test_count_cases(spark, tmp_path):
    docs = write(spark, ROWS, tmp_path / "docs")
    library = Tokenizer.from_file(BYTES)
    got = sorted((r["id"] or 0, r["n_bytes"], r["n_tokens"]) for r in count_tokens(docs, BYTES).collect())
    assert got == sorted((i or 0, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t, *_ in ROWS)
    assert count_tokens(docs.limit(0), BYTES).count() == 0


def test_count_query(spark):
    library = Tokenizer.from_file(BYTES)
    want = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = entry.queries()["op6_token_counts"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        n = len(library.encode(want[r["doc_id"]]).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(want[r["doc_id"]].encode()), n, n > 1024)


def test_word_ids_against_library():
    library = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as f:
        encode = WordIds(f.read())
    assert encode.short
    for text in [*ODD, "<|startoftext|> x", *random_texts(2, 3_000)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def check_packing(rows, docs, capacity=2048):
    """Every piece once, with the right ids, and no gap or overflow in a sequence."""
    library = Tokenizer.from_file(WORDS)
    want, sequences = [], defaultdict(list)
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((doc_id or 0, k, at, len(part), zlib.crc32(packed(part))))
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_cases(spark, tmp_path):
    docs = write(spark, ROWS, tmp_path / "docs")
    for settings in (Settings(), Settings(problem=8, islands=3, epochs=3)):
        used, bound = check_packing(pack_documents(docs, WORDS, settings).collect(), [r[:2] for r in ROWS])
        assert used <= bound + (1 if settings.problem > 8 else 8)
    assert pack_documents(docs.limit(0), WORDS).count() == 0


def test_packing_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    used, bound = check_packing(entry.queries()["op7_packing"](spark, SF).collect(), docs)
    assert used <= bound * 1.02 + 1


def sound(bins, lengths):
    assert sorted(i for items in bins.items for i in items) == list(range(len(lengths)))
    assert all(items for items in bins.items)
    assert [bins.capacity - sum(lengths[i] for i in items) for items in bins.items] == bins.room
    assert min(bins.room) >= 0


@pytest.mark.parametrize("low,high", [(1, 2048), (500, 1100), (1, 30), (1025, 2048)])
def test_genetic_steps(low, high):
    draw = np.random.default_rng(low)
    lengths = draw.integers(low, high, 300).tolist()
    first = best_fit(lengths, 2048)
    other = best_fit(lengths, 2048, draw.permutation(300).tolist()[:150])
    other.put(sorted(set(range(300)) - {i for items in other.items for i in items}))
    for bins in (first, other, crossover(first, other, 0.2, draw), mutated(first, 0.2, draw)):
        sound(bins, lengths)
    elites = evolve(lengths, [first.bin_of()], Settings(), 0, 0)
    sound(elites[0], lengths)
    assert len(elites[0].items) <= len(first.items)


def test_injected_bins_stay_whole():
    lengths = [1024, 1024, 1000, 1000, 48, 900]
    one, other = best_fit(lengths, 2048), best_fit(lengths, 2048, [0, 1])
    other.put([2, 3, 4, 5])
    child = crossover(one, other, 0.01, np.random.default_rng(0))
    assert any(sorted(items) in [sorted(x) for x in other.items] for items in child.items)
    sound(child, lengths)


def check_files(rows, docs):
    library, start, want = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_files_cases(spark, tmp_path):
    rows = [r for r in ROWS if r[0] != 7 and (r[0] is not None or r[1])]
    docs = write(spark, rows, tmp_path / "docs")
    path = new_folder(docs)
    write_tokens(docs, WORDS, path)
    tokens = read_tokens(spark, path)
    check_files(checksums(tokens).collect(), sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0])))
    assert "EqualTo(doc_id,9)" in plan(tokens.where("doc_id = 9")).split("PushedFilters", 1)[1].split("\n", 1)[0]
    (first, *_) = glob.glob(path.removeprefix("file://") + "/part-*.orc")
    assert orc.ORCFile(first).row_index_stride == 1_000
    empty = new_folder(docs)
    write_tokens(docs.limit(0), WORDS, empty)
    assert checksums(read_tokens(spark, empty)).count() == 0


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_files_of_repeated_ids(spark, tmp_path):
    docs = write(spark, [(5, f"copy {i}", "en", "s") for i in range(40)], tmp_path / "docs")
    path = new_folder(docs)
    write_tokens(docs, WORDS, path)
    rows = sorted(read_tokens(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 2
        at += r["n_tokens"]


def test_files_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())
    check_files(entry.queries()["op9_token_files"](spark, SF).collect(), docs)
