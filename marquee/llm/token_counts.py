"""Token counts by a tokenizer compiled to deterministic finite-state transducers.

A byte-level BPE tokenizer with the usual splitting pattern is two machines:

* The *splitter* reads character classes and says before which characters a
  piece begins. It has nine states. A chunk of text is a map from the state
  before it to the state after it; the maps of all chunks are composed by a
  parallel prefix scan, after which every chunk's true first state is known
  and all chunks are read side by side, as numpy vectors.
* The *merger* reads the bytes of one piece and annotates each transition
  with the tokens emitted, so that the sum over a piece is its token count.
  Merging is turned into a machine by the rule that a token sequence is the
  one BPE makes if each two neighbours are what BPE makes of their bytes. A
  state holds the possible beginnings of the token being read: for each, the
  token before it, the count so far and the place in the vocabulary trie.
  States and transitions are compiled when first met and then remembered.

The reading is exact, for any text; no prefix is taken. Texts are read in
partitions; memory is bounded by one text and the remembered transitions.

Defined cases: null is empty and has no bytes and no tokens. A text that
contains an added token of the tokenizer (as ``<|endoftext|>``) is split
there, and each occurrence counts one, as the library does by default.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import as_bytes, slices
from marquee.llm.word_ids import byte_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Character classes: space, other blank, number, other, apostrophe, letters that
# end or continue a contraction ('s 't 'm 'd, 're 've, 'll), other letters.
SPACE, BLANK, NUMBER, OTHER, QUOTE, STMD, R, V, E, L, LETTER, STOP = range(12)
CLASSES = 12

# States: nothing yet, run of letters, numbers, others, one space, blanks that
# end in a space, blanks that end otherwise, apostrophe that begins a piece,
# ended contraction, and two letters into 're/'ve and 'll.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, SPACES, BLANKS, AFTER_QUOTE, ENDED, QUOTE_RV, QUOTE_L) = range(11)
STATES = 11

#: What the transition says about pieces. NEW: one begins at this character.
#: BACK: one begins at the character before (a last blank that the run before leaves out). BOTH: both.
SAME, NEW, BACK, BOTH = range(4)

CHUNK = 256
BLOCK = 1 << 20
#: Pieces and states that a worker process remembers.
MEMO = 400_000
STATES_KEPT = 200_000
#: Rank of a merge that does not exist.
NEVER = 1 << 60


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and piece mark by (state, class).

    The apostrophe states hold back a decision: an ``'`` that begins a piece
    may begin a contraction. ``'re`` needs two more letters; if they do not
    come, a piece begins at the letter before (BACK).
    """
    step = np.zeros((STATES, CLASSES), np.int8)
    mark = np.zeros((STATES, CLASSES), np.int8)
    letters = (STMD, R, V, E, L, LETTER)
    for state in range(STATES):
        for c in range(CLASSES):
            if c == STOP:  # between texts
                to, m = START, NEW
            elif c in letters:
                to, m = IN_LETTERS, SAME if state in (IN_LETTERS, ONE_SPACE) else NEW
            elif c == NUMBER:
                to, m = IN_NUMBERS, SAME if state in (IN_NUMBERS, ONE_SPACE) else NEW
            elif c in (OTHER, QUOTE):
                inside = state in (IN_OTHERS, ONE_SPACE, AFTER_QUOTE)
                to, m = IN_OTHERS, SAME if inside else NEW
                if c == QUOTE and not inside and state != SPACES:
                    to = AFTER_QUOTE
            elif c == SPACE:
                blank = state in (ONE_SPACE, SPACES, BLANKS)
                to, m = (SPACES, SAME) if blank else (ONE_SPACE, NEW)
            else:
                to, m = BLANKS, SAME if state in (ONE_SPACE, SPACES, BLANKS) else NEW
            # The last of several blanks leaves its run; a space joins what follows.
            if state == SPACES and c not in (SPACE, BLANK, STOP):
                m = BACK
                to = {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}.get(c, IN_LETTERS)
            if state == BLANKS and c not in (SPACE, BLANK, STOP):
                m = BOTH
            if state == AFTER_QUOTE and c in letters:
                to, m = {STMD: (ENDED, SAME), R: (QUOTE_RV, SAME), V: (QUOTE_RV, SAME), L: (QUOTE_L, SAME)}.get(
                    c, (IN_LETTERS, NEW)
                )
            if (state == QUOTE_RV and c == E) or (state == QUOTE_L and c == L):
                to, m = ENDED, SAME
            elif state in (QUOTE_RV, QUOTE_L) and c in letters:
                to, m = IN_LETTERS, BACK
            elif state in (QUOTE_RV, QUOTE_L):
                m = BOTH
            step[state, c], mark[state, c] = to, m
    return step, mark


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of maps (rows) under composition, in log2(rows) rounds."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    return maps


def marks_of(classes: np.ndarray, step: np.ndarray, mark: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Marks of a run of classes read from ``state``, and the state after it."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, STOP, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    flat_step = step.ravel()
    now = np.tile(np.arange(STATES, dtype=np.int16), (chunks, 1))
    for column in columns:
        now = flat_step[now * CLASSES + column[:, None]].astype(np.int16)
    first = np.empty(chunks, np.int16)
    first[0] = state
    first[1:] = compose(now)[:-1, state]
    out, flat_mark, now = np.empty((CHUNK, chunks), np.int8), mark.ravel(), first
    states = np.empty((CHUNK, chunks), np.int8)
    for i, column in enumerate(columns):
        at = now * CLASSES + column
        out[i] = flat_mark[at]
        now = flat_step[at].astype(np.int16)
        states[i] = now
    return out.T.ravel()[:n], int(states.T.ravel()[n - 1])


class Merger:
    """Token count of one piece's bytes, by transitions compiled on demand."""

    def __init__(self, vocab: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        self.ranks = ranks
        self.tokens = list(vocab)
        self.made_of = {}
        for left, right in ranks:
            self.made_of.setdefault(left + right, (left, right))
        rank_of = {token: ranks[pair] for token, pair in self.made_of.items()}
        if any(rank_of.get(part, -1) >= rank_of[t] for t, pair in self.made_of.items() for part in pair):
            raise ValueError("a merge comes before its parts; the transducer needs them in order")
        self.grown: dict[bytes, tuple[list, list]] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for number, token in enumerate(self.tokens):
            if len(token) > 1 and self._merge(token) != [token]:
                continue  # a token that merging never makes
            node = 0
            for byte in token:
                nxt = self.trie[node].get(byte)
                if nxt is None:
                    nxt = self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = number
        self._forget()

    def _forget(self) -> None:
        """Back to the first state: nothing read, no token before (0), count 0, root of the trie."""
        self.members: list[tuple[int, ...]] = [(self._pack(-1, 0, 0),)]
        self.states: dict[tuple[int, ...], int] = {self.members[0]: 0}
        self.moves: dict[int, int] = {}
        self.fits: dict[int, bool] = {}

    @staticmethod
    def _pack(before: int, ahead: int, node: int) -> int:
        """A member of a state as one number: token before, count relative to the state's, trie node."""
        return (before + 1) << 40 | (ahead + (1 << 15)) << 24 | node

    def _merge(self, text: bytes) -> list[bytes]:
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[best], parts[best + 1])
            if pair not in self.ranks:
                break
            done, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    done.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    done.append(parts[i])
                    i += 1
            parts = done
        return parts

    def _spines(self, token: bytes) -> tuple[list, list]:
        """How the token grows while it is merged: its last and its first part, each with the rank of the merge that ends it."""
        if (known := self.grown.get(token)) is None:
            if len(token) == 1:
                known = ([(token, NEVER)], [(token, NEVER)])
            else:
                left, right = self.made_of[token]
                rank = self.ranks[left, right]
                last, first = self._spines(right)[0], self._spines(left)[1]
                known = ([*last[:-1], (right, rank), (token, NEVER)], [*first[:-1], (left, rank), (token, NEVER)])
            self.grown[token] = known
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens side by side.

        While both are merged, their facing parts grow; they are torn if at
        some time the facing parts merge before either grows further. Of equal
        merges the left one comes first.
        """
        if a < 0:
            return True
        key = a << 24 | b
        if (fits := self.fits.get(key)) is None:
            left, right = self._spines(self.tokens[a])[0], self._spines(self.tokens[b])[1]
            i = j = 0
            fits = True
            while True:
                (x, grow_x), (y, grow_y) = left[i], right[j]
                meet = self.ranks.get((x, y), NEVER)
                if meet < grow_x and meet <= grow_y and meet < NEVER:
                    fits = False
                    break
                if grow_x == grow_y == NEVER:
                    break
                if grow_x <= grow_y:
                    i += 1
                else:
                    j += 1
            self.fits[key] = fits
        return fits

    def _compile(self, state: int, byte: int) -> int:
        """The transition: next state, and emitted tokens in the low byte (plus 128)."""
        alive, last, emitted = [], -1, 0
        for member in self.members[state]:
            before, ahead, node = (member >> 40) - 1, (member >> 24 & 0xFFFF) - (1 << 15), member & 0xFFFFFF
            to = self.trie[node].get(byte)
            if to is None:
                continue
            alive.append((before, ahead, to))
            token = self.token_at[to]
            if last < 0 and token >= 0 and self._neighbours(before, token):
                last, emitted = token, ahead + 1  # members are ordered from the longest token on
        members = (*(self._pack(b, ahead - emitted, node) for b, ahead, node in alive), self._pack(last, 0, 0))
        number = self.states.setdefault(members, len(self.members))
        if number == len(self.members):
            self.members.append(members)
        return number << 8 | emitted + 128

    def count(self, piece: bytes) -> int:
        if len(self.members) > STATES_KEPT:
            self._forget()
        moves, state, total = self.moves, 0, 0
        for byte in piece:
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                move = moves[key] = self._compile(state, byte)
            state = move >> 8
            total += (move & 255) - 128
        return total


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int], list[str]]:
    """Tokens, merge ranks and added tokens of a byte-level BPE file. Refuses files of another kind."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                           "byte_fallback", "ignore_merges"))
    if not plain or spec["normalizer"] or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"]:
        raise ValueError("only plain byte-level BPE with the usual pattern can be compiled")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("only added tokens that match as they are can be compiled")
    letters = {c: b for b, c in byte_letters().items()}
    added = [t["content"] for t in spec["added_tokens"]]
    as_bytes = lambda s: bytes(letters[c] for c in s)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
    vocab = {as_bytes(t): i for t, i in model["vocab"].items() if t not in added}
    return vocab, ranks, added


def class_table(path: str) -> np.ndarray:
    """Class of each code point, as the tokenizer's own splitting has it.

    A regular-expression engine proposes runs of like points; runs that the
    tokenizer cuts elsewhere are asked point by point, as Unicode versions
    differ.
    """
    import regex
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    probes = ((LETTER, "a"), (NUMBER, "1"), (OTHER, "."))
    joins = lambda probe, run: len(cut(probe + run)) == 1
    text = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "\ue000" for i in range(0x110000))
    table = np.full(0x110000, OTHER, np.uint8)
    for m in regex.finditer(r"(\p{L}+)|(\p{N}+)|([^\p{L}\p{N}\p{White_Space}]+)|\p{White_Space}", text):
        kind = m.lastindex
        for at in range(m.start(), m.end(), 4096):
            end = min(at + 4096, m.end())
            if kind and joins(probes[kind - 1][1], text[at:end]):
                table[at:end] = probes[kind - 1][0]
                continue
            for i in range(at, end):
                table[i] = next((c for c, probe in probes if joins(probe, text[i])), BLANK)
    for chars, c in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("e", E), ("l", L)):
        for x in chars:
            table[ord(x)] = c
    return table


class Memo(dict):
    """Token counts of short pieces, forgotten when there are too many."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece.encode("utf-8", "replace"))
        if len(piece) < 64:
            if len(self) > MEMO:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Counts the tokens of texts; one per worker process."""

    def __init__(self, vocab, ranks, added, table):
        self.merger, self.table = Merger(vocab, ranks), table
        self.step, self.mark = splitter()
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.memo = Memo(self.merger.count)

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The pieces that the tokenizer's pattern cuts the texts into, and at which piece each text begins."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        joined = "\0".join(texts) + "\0"
        marks, state = np.empty(len(joined), np.int8), START
        for at in range(0, len(joined), BLOCK):  # blocks are chunks of chunks
            points = np.frombuffer(joined[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
            classes = self.table[points]
            classes[ends[np.searchsorted(ends, at):np.searchsorted(ends, at + BLOCK)] - at] = STOP
            marks[at:at + BLOCK], state = marks_of(classes, self.step, self.mark, state)
        begin = marks & 1 != 0
        begin[:-1] |= marks[1:] & 2 != 0
        begin[ends] = False  # what stands between texts is no piece
        stops = begin.copy()
        stops[ends] = True
        places = np.flatnonzero(stops)
        real = begin[places]
        starts, after = places[real].tolist(), np.append(places[1:], len(joined))[real].tolist()
        first = np.searchsorted(places[real], np.concatenate([[0], ends[:-1] + 1]))
        return [joined[a:b] for a, b in zip(starts, after, strict=True)], first

    def counts(self, texts: list[str]) -> list[int]:
        if self.added is None or not any(map(self.added.search, texts)):
            return self._plain(texts)
        parts = [self.added.split(t) for t in texts]
        plain = iter(self._plain([x for p in parts for x in p]))
        return [len(p) - 1 + sum(next(plain) for _ in p) for p in parts]

    def _plain(self, texts: list[str]) -> list[int]:
        pieces, first = self.pieces(texts)
        each = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        sums = np.concatenate([[0], np.cumsum(each)])
        return (sums[np.append(first[1:], len(pieces))] - sums[first]).tolist()


COUNTED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
])


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, UTF-8 bytes and tokens of each row. ``tokenizer`` is a file that the driver can read."""
    spark = docs.sparkSession
    # A vocabulary, so of bounded size. The last part keeps what a worker process has compiled, over its tasks.
    machine = spark.sparkContext.broadcast(((*read_vocabulary(tokenizer), class_table(tokenizer)), {}))

    def task(batches):
        parts, compiled = machine.value
        if not compiled:
            compiled[0] = Counter(*parts)
        counts = compiled[0].counts
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t) for t in as_bytes(batch.column(1))], pa.int64()),
                pa.array(counts(texts), pa.int64()),
            ], COUNTED.names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(task, COUNTED)
