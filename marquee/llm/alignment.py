"""Alignment of two tokenizers' tokens, by merging their ends along a merge path.

Both tokenizers read a space and the text, so each gives an ascending list of
byte offsets at which its tokens end. Where a token of either ends at once, a
group ends; tokens A and B of one group are linked. The two lists of all texts
of a batch are merged as one: diagonals of the merge path are found by binary
search, all at the same time, and cut the merge into independent pieces of
equal work, however texts differ in length. Each piece finds the ends that both
lists have and emits its groups; what is open at a piece's edges is stitched to
its neighbours.

A pair of ids counts once for each document that has it linked. Tasks add up
pairs and Spark adds up the rest. Counts are looked up in the tasks for the
most frequent pairs, as many as fit ``Settings.known`` rows, whose number is
counted first; links of rarer pairs, if there are any, are joined to theirs by
a shuffle.

Texts are cut for the tokenizers where both always cut (before a single space
or line break between other characters), and the ids of such chunks are
remembered; ids are those of the whole text. Memory is bounded by a batch of
texts, one whole text, and its distinct pairs.

Defined cases: a null or empty text has no tokens, nor has one whose tokens'
bytes, by either tokenizer, are not those of a space and the text. Strings of
special tokens are plain text. Repeated rows count as often as they occur. Null
ids are kept. An empty table gives no rows. Other columns do not matter, but
for those that begin with ``_llm_``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, numbered, sized, slices, stage
from marquee.llm.word_ids import byte_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that a worker process remembers, twice: those seen lately and those before.
MEMO = 250_000
#: Marks that are cut from the end of a word, where no piece joins the two.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Chunks: a single space or line break begins one if other characters stand on both sides.
CHUNKS = re.compile(r"\s+\S+(?:(?:\s\s+|[^\S \n])\S+)*(?:\s+\Z)?|\s+\Z").findall
#: Blanks that the short way of cutting does not know.
ODD = re.compile(r"\s\s|[^\S \n]|\s\Z").search


@dataclass(frozen=True)
class Settings:
    """work: ends merged by one piece; known: pairs looked up in the tasks; wide: links of one group that are listed one by one."""

    work: int = 1 << 16
    known: int = 2_000_000
    wide: int = 4_096


class Tokenizers:
    """Ids of A and B for texts, and the bytes of each id."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        added = {t["id"]: t["content"] for t in json.loads(spec)["added_tokens"]}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = added[i].encode() if i in added else bytes(letters[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id("▁")
        self.memo: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        self.tails: dict[str, tuple[bytes, bytes]] = {}
        self.odd = False
        self.letters = byte_letters()
        # Neighbours in some piece: between any others, B always cuts.
        self.met = {pair for i, p in enumerate(pieces) if not self.b.is_byte(i) for pair in zip(p, p[1:])}
        # What chunks rely on: no piece of B reaches over a chunk's beginning, and probes come out the same.
        self.cut = array("I").itemsize == 4 and sys.byteorder == "little" and self.blank == self.b.encode("\nx")[0]
        self.cut = self.cut and not any("▁" in p[1:].lstrip("▁") or "\n" in p for p in pieces) and all(
            self.chunked(s) == self.whole(s)
            for s in (" a b", " A.b 1's\nx  y \n\n z\t", " \né 日本 ", "  <s>x</s> y's", " Çaß, an?! ab.\" tasks> ł: ab\nab.")
        )

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """Packed ids of A and B for a text that begins with a space."""
        a = self.a.encode(text, add_special_tokens=False).ids
        return np.array(a, "<u4").tobytes(), np.array(self.b.encode(text[1:]), "<u4").tobytes()

    def packed(self, text: str, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        """The ids of a part of a text, packed; notes if their bytes are not the text's."""
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            self.odd = True
        return array("I", a).tobytes(), array("I", b).tobytes()

    def of_word(self, key: str) -> tuple[bytes, bytes]:
        """Packed ids of Latin letters after a space."""
        found = self.memo.get(key) or self.old.get(key)
        if found is None:
            shown = key if key.isascii() else key.encode().decode("latin-1").translate(self.letters)
            a = [t.id for t in self.a.model.tokenize(self.letters[32] + shown)]
            found = self.packed(" " + key, a, self.b.encode(key))
        if len(key) < 64 and not self.odd:
            self.memo[key] = found
        return found

    def of_marks(self, marks: str) -> tuple[bytes, bytes]:
        """Packed ids of marks after a letter."""
        found = self.tails.get(marks)
        if found is None:
            # A line break is a token of its own, after the mark that B puts first.
            found = self.packed(marks, self.a.encode(marks, add_special_tokens=False).ids, self.b.encode("\n" + marks)[2:])
            if len(self.tails) < 10_000 and not self.odd:
                self.tails[marks] = found
        return found

    def of_chunk(self, key: str) -> tuple[bytes, bytes]:
        """Packed ids of a chunk: the key after a space, or a key that begins with its line break."""
        word = key.rstrip(MARKS)
        if word.isalpha() and max(word) < "\u0250":
            if len(word) == len(key):
                return self.of_word(key)
            if len(key) - len(word) <= 8 and (word[-1], key[len(word)]) not in self.met:
                a, b = self.of_word(word)
                more = self.of_marks(key[len(word):])
                return a + more[0], b + more[1]
        found = self.old.get(key)
        if found is None:
            text = key if key[0] == "\n" else " " + key
            b = self.b.encode(key)
            found = self.packed(text, self.a.encode(text, add_special_tokens=False).ids, b[1:] if text is key else b)
        if len(key) < 64 and not self.odd:  # else each text with it is noticed
            self.memo[key] = found
        return found

    def chunked(self, text: str) -> tuple[bytes, bytes]:
        """As ``whole``, chunk by chunk."""
        if not ODD(text):
            keys = text.replace("\n", " \n").split(" ")[1:]
        else:
            first, *rest = CHUNKS(text)
            if first[0] == " " and first[1:2].strip():
                keys = [c[1:] if c[0] == " " else c for c in (first, *rest)]
            else:  # a text that begins with blanks
                a, b = self.whole(first)
                self.odd = True
                if not rest:
                    return a, b
                more = self._joined([c[1:] if c[0] == " " else c for c in rest])
                return a + more[0], b + more[1]
        return self._joined(keys)

    def _joined(self, keys: list[str]) -> tuple[bytes, bytes]:
        memo, of_chunk = self.memo.get, self.of_chunk
        a, b = zip(*[memo(k) or of_chunk(k) for k in keys], strict=True)
        return b"".join(a), b"".join(b)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B; None if the text has no tokens."""
        if not text:
            return None
        if len(self.memo) > MEMO:
            self.old, self.memo = self.memo, {}  # words that are still in use come back from there
        # The mark that stands for a space in pieces can join chunks.
        cut = self.cut and "▁" not in text
        text, self.odd = " " + text, not cut
        a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in (self.chunked if cut else self.whole)(text))
        if self.odd:
            raw = text.encode()
            if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
                return None
        return a, b


class Shared:
    """The tokenizers' files for the workers. Each worker process builds them once, over all its tasks."""

    def __init__(self, spark: SparkSession, a: str, b: str):
        with open(a, encoding="utf-8") as x, open(b, "rb") as y:
            self.sent = spark.sparkContext.broadcast((x.read(), y.read(), {}))  # two vocabularies, so of bounded size

    def tokenizers(self) -> Tokenizers:
        spec, model, built = self.sent.value
        if not built:
            built[0] = Tokenizers(spec, model)
        return built[0]


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two ascending arrays meets every ``work``-th diagonal, from its beginning to its end.

    Equal numbers stay together: a cut between them moves behind both.
    """
    at = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        earlier = np.zeros(len(at), bool)
        earlier[open_] = a[mid[open_]] <= b[(at - 1 - mid)[open_]]
        low, high = np.where(open_ & earlier, mid + 1, low), np.where(open_ & ~earlier, mid, high)
    i, j = low, at - low
    inner = np.flatnonzero((i > 0) & (j < len(b)))
    j[inner] += a[i[inner] - 1] == b[j[inner]]
    return i, j


def groups_of(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B each group has, from the ascending ends of both, whose last are equal."""
    i, j = diagonals(a, b, work)
    of_a, of_b, open_a, open_b = [], [], 0, 0
    for k in range(len(i) - 1):
        x, y = a[i[k]:i[k + 1]], b[j[k]:j[k + 1]]
        at = np.searchsorted(y, x)
        inside = np.flatnonzero(at < len(y))
        both = inside[y[at[inside]] == x[inside]]
        if len(both):
            sizes_a, sizes_b = np.diff(both, prepend=-1), np.diff(at[both], prepend=-1)
            sizes_a[0] += open_a
            sizes_b[0] += open_b
            of_a.append(sizes_a)
            of_b.append(sizes_b)
            open_a, open_b = len(x) - 1 - both[-1], len(y) - 1 - at[both[-1]]
        else:
            open_a, open_b = open_a + len(x), open_b + len(y)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *of_a]), np.concatenate([none, *of_b])


def linked_pairs(
    a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, text: np.ndarray, sizes: tuple[int, int], wide: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, A id, B id) that are linked, in order, and how often. ``text`` numbers each group's text."""
    from_a, from_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    area = of_a * of_b
    one = area == 1
    few = np.flatnonzero(~one & (area <= wide))
    group = np.repeat(few, area[few])
    nth = np.arange(len(group)) - np.repeat(np.cumsum(area[few]) - area[few], area[few])
    left = np.concatenate([a[from_a[one]], a[from_a[group] + nth // of_b[group]]])
    right = np.concatenate([b[from_b[one]], b[from_b[group] + nth % of_b[group]]])
    of_text = np.concatenate([text[one], text[group]])
    times = None
    for g in np.flatnonzero(area > wide).tolist():
        # A group of many tokens: its distinct ids, and how often each pair of them meets.
        x, many_x = np.unique(a[from_a[g]:from_a[g] + of_a[g]], return_counts=True)
        y, many_y = np.unique(b[from_b[g]:from_b[g] + of_b[g]], return_counts=True)
        times = np.ones(len(left), np.int64) if times is None else times
        left, right = np.concatenate([left, np.repeat(x, len(y))]), np.concatenate([right, np.tile(y, len(x))])
        of_text = np.concatenate([of_text, np.full(len(x) * len(y), text[g])])
        times = np.concatenate([times, np.outer(many_x, many_y).ravel()])
    key = (of_text * sizes[0] + left) * sizes[1] + right
    if times is None:
        key, times = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key, kind="stable")
        key, starts = np.unique(key[order], return_index=True)
        times = np.add.reduceat(times[order], starts)
    return key // (sizes[0] * sizes[1]), key // sizes[1] % sizes[0], key % sizes[1], times


def align(docs: DataFrame, a: str, b: str, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, written as a table: number, id, counts, digest of the groups, and the distinct linked ids.

    ``a`` is the file of a byte-level tokenizer, ``b`` of a piece model. ``left``
    and ``right`` hold the ids of linked pairs, ``times`` how often each is.
    """
    rows = numbered(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = Shared(docs.sparkSession, a, b)
    names = [ROW, "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "left", "right", "times"]

    def task(batches):
        both = shared.tokenizers()
        sizes = len(both.a_bytes), len(both.b_bytes)
        long_a, long_b = (np.array(list(map(len, x)), np.int64) for x in (both.a_bytes, both.b_bytes))
        # Every id with each mark that may follow it, for the text of the groups.
        shown = [f"{i}{mark}".encode() for n in sizes for i in range(n) for mark in (",|" if n is sizes[0] else ",;")]
        show = shown.__getitem__

        for batch in slices(batches, 4 << 20):
            found = [both(text) for text in batch.column(2).to_pylist()]
            n = len(found)
            n_a, n_b = (np.array([0 if x is None else len(x[k]) for x in found], np.int64) for k in (0, 1))
            none = [np.zeros(0, np.int64)]
            ids_a, ids_b = (np.concatenate(none + [x[k] for x in found if x is not None]) for k in (0, 1))
            of_a, of_b = groups_of(np.cumsum(long_a[ids_a]), np.cumsum(long_b[ids_b]), settings.work)
            until = np.cumsum(of_a)
            groups_to = np.searchsorted(until, np.cumsum(n_a), side="right")
            n_groups = np.diff(groups_to, prepend=0)
            text = np.repeat(np.arange(n), n_groups)
            n_links = np.zeros(n, np.int64)
            np.add.at(n_links, text, of_a * of_b)
            of_text, left, right, times = linked_pairs(ids_a, ids_b, of_a, of_b, text, sizes, settings.wide)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of_text, minlength=n))]), pa.int32())

            # A's ids of a group, then B's; the last of each has another mark.
            order = np.empty(len(ids_a) + len(ids_b), np.int64)
            ends_a, ends_b = until - 1, np.cumsum(of_b) - 1
            mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
            mark_a[ends_a], mark_b[ends_b] = 1, 1
            order[np.arange(len(ids_a)) + np.repeat(ends_b + 1 - of_b, of_a)] = 2 * ids_a + mark_a
            order[np.arange(len(ids_b)) + np.repeat(until, of_b)] = 2 * (sizes[0] + ids_b) + mark_b
            digests, at = [], 0
            for k in (n_a + n_b).tolist():
                digests.append(hashlib.sha256(b"".join(map(show, order[at:at + k].tolist()))[:-1]).hexdigest() if k else "")
                at += k
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links), pa.array(digests),
                *(pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((left, pa.int32()), (right, pa.int32()), (times, pa.int64()))),
            ], names)

    ids, longs = T.ArrayType(T.IntegerType()), T.LongType()
    kinds = [longs, rows.schema["id"].dataType, longs, longs, longs, longs, T.StringType(), ids, ids, T.ArrayType(longs)]
    return stage(rows.select(ROW, "id", "text").mapInArrow(task, T.StructType([T.StructField(*x) for x in zip(names, kinds, strict=True)])))


def _lists(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's entries begin, and the flat numbers of list columns of equal lengths."""
    columns = [batch.column(name) for name in names]
    return columns[0].offsets.to_numpy() - columns[0].offsets[0].as_py(), [c.flatten().to_numpy().astype(np.int64) for c in columns]


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``left``, ``right``, ``n`` documents, and whether no other B id is linked with that A id in more (``best``). Written as a table."""

    def task(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counts)], ["left", "right", "n"]
            )

        for batch in batches:
            _, (left, right) = _lists(batch, "left", "right")
            more, many = np.unique(left << 32 | right, return_counts=True)
            keys, where = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, many]), len(keys)).astype(np.int64)
            if len(keys) > 1 << 20:
                yield packed()
                keys, counts = keys[:0], counts[:0]
        yield packed()

    counted = stage(
        aligned.select("left", "right").mapInArrow(task, "left int, right int, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))
    )
    most = counted.groupBy("left").agg(F.max("n").alias("most"))  # at most a row for each A id
    return stage(counted.join(sized(stage(most), 24), "left").select("left", "right", "n", (F.col("n") == F.col("most")).alias("best")))


def rate(aligned: DataFrame, counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of ``align`` without their pairs, with ``n_best`` and ``count_sum`` by ``counts`` of ``pair_counts``."""
    least = 0
    if counts.count() > settings.known:
        # Pairs by the power of two of their count: the largest powers that fit are looked up in the tasks.
        powers = counts.groupBy(F.length(F.bin("n")).alias("p")).count().orderBy(F.desc("p")).collect()
        room, least = settings.known, 1 << 62
        for r in powers:
            room -= r["count"]
            if room < 0:
                break
            least = 1 << (r["p"] - 1)
    table = counts.where(F.col("n") >= least).toArrow()
    keys = table.column("left").to_numpy().astype(np.int64) << 32 | table.column("right").to_numpy()
    order = np.argsort(keys)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (keys[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order])
    )  # of at most settings.known rows
    facts = [c for c in aligned.columns if c not in ("left", "right", "times")]
    schema = T.StructType([
        *(aligned.schema[c] for c in facts), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
        T.StructField("rest", T.ArrayType(T.StructType([
            T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()), T.StructField("times", T.LongType()),
        ]))),
    ])

    def task(batches):
        keys, n, best = shared.value
        for batch in slices(batches, 16 << 20, 4_096):
            starts, (left, right, times) = _lists(batch, "left", "right", "times")
            key = left << 32 | right
            at = np.searchsorted(keys, key)
            hit = at < len(keys)
            hit[hit] = keys[at[hit]] == key[hit]
            counted, is_best = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            counted[hit], is_best[hit] = n[at[hit]] * times[hit], best[at[hit]] * times[hit]
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[starts]) for x in (is_best, counted)]
            missed = np.flatnonzero(~hit)
            offsets = np.searchsorted(missed, starts)
            rest = pa.StructArray.from_arrays(
                [pa.array(left[missed], pa.int32()), pa.array(right[missed], pa.int32()), pa.array(times[missed])], ["left", "right", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in facts), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest)], schema.names
            )

    rated = aligned.mapInArrow(task, schema)
    if not least:
        return rated.drop("rest")
    rated = stage(rated)
    rare = rated.select(ROW, F.explode("rest").alias("x")).select(ROW, "x.*").join(counts.where(F.col("n") < least), ["left", "right"])
    more = stage(rare.groupBy(ROW).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum")
    ))
    none = F.lit(0).cast("long")
    return rated.drop("rest").join(sized(more, 40), ROW, "left").select(
        *facts, (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
    )
