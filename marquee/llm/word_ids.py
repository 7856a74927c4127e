"""Token ids of whole texts by a tokenizer that never joins words.

Where a tokenizer drops white space and cuts at it, a text's ids are those of
its words one after the other. Words repeat, so each worker encodes a word once
and remembers its ids as bytes (little-endian unsigned 32-bit), up to a bound.
Words of plain Latin letters, perhaps with marks at their end, go straight to
the library's model; all others take the library's whole way. Texts that
contain one of the tokenizer's added tokens are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that a worker process remembers, twice: those seen lately and those before.
MEMO = 300_000
#: White space by Unicode, as the body of a character class.
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What may follow a word and is cut from it as one piece: ASCII marks but the apostrophe.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, str]:
    """The printable stand-ins that vocabulary files use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Packed ids by word, filled when first asked for; called with texts it gives theirs."""

    def __init__(self, spec: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        added = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = re.compile(f"[^{BLANKS}]+").findall
        self.letters = byte_letters()
        # What the short cuts rely on is asked of the library.
        for probe in ("a b", " a b\n", "A.b", "É?!"):
            want = self.packed(probe)
            if b"".join(map(self.packed, self.split(probe))) != want:
                raise ValueError("the tokenizer must drop white space and cut at it")
        letters = "".join(map(chr, range(256)))
        self.short = (
            sys.byteorder == "little" and array("I").itemsize == 4
            and all(self._latin(w) == self.packed(w) for w in ("ab", "Ça", "ßÜ,", "an?!", "µºx:", "a-_|"))
            and all(self.packed(c) == self.packed(c.lower()) for c in letters)
        )

    def packed(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _latin(self, word: str) -> bytes | None:
        """Ids of Latin-1 letters followed by marks, else None."""
        plain = word.isascii()
        if not plain and max(word) > "\xff":
            return None
        low = word.lower()
        core = low.rstrip(MARKS)
        if not core.isalpha():
            return None
        ids = self.get(core) or self.old.get(core)
        if ids is None:
            shown = core if plain else core.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(core) < 64:
                self[core] = ids
        if len(core) == len(low):
            return ids
        tail = low[len(core):]
        if len(tail) > 8 or len(self.tails) > 10_000:
            return ids + self.packed(tail)
        return ids + (self.tails.get(tail) or self.tails.setdefault(tail, self.packed(tail)))

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None and self.short:
            ids = self._latin(word)
        if ids is None:
            ids = self.packed(word)
        if len(word) < 64:
            self[word] = ids
        return ids

    def split(self, text: str) -> list[str]:
        # str.split() also cuts at four control characters that are no white space in Unicode.
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self.words(text)
        return text.split()

    def __call__(self, text: str | None) -> bytes:
        """Ids of a text, packed; null is empty."""
        if not text:
            return b""
        if self.added is not None and self.added.search(text):
            return self.packed(text)
        if len(self) > MEMO:
            self.old = dict(self)  # words that are still in use come back from here
            self.clear()
        if self.short:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                text = text.lower()  # as the tokenizer does; of these letters Python and the library think alike
        return b"".join(map(self.__getitem__, self.split(text)))


class Shared:
    """A tokenizer's file for the workers. Each worker process builds its encoder once, over all its tasks."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            self.sent = spark.sparkContext.broadcast((f.read(), {}))  # a vocabulary, so of bounded size

    def encoder(self) -> WordIds:
        spec, built = self.sent.value
        if not built:
            built[0] = WordIds(spec)
        return built[0]
