"""How far the sources of a language differ in the terms they use.

A text's terms are found by one table: ``bytes.translate`` lowers A-Z and turns
every other ASCII character into a space, ``bytes.split`` cuts there. The
Counter of a document gives each term's occurrences and, by its keys, the
documents that have it. Tasks add these up per language, source and term, and
hand on what they have when it grows large, so memory is bounded; Spark adds up
the rest. All that follows works on such sparse counts.

A language keeps the terms that enough of its documents have. A group's share
of a term is ``1 + floor(scale * (count + smooth) / (N + smooth * V))``, a whole
number, for its ``N`` occurrences of the ``V`` kept terms; all arithmetic is
exact. A pair of sources differs by the sum of the shares' distances over all
kept terms. It is worked out for blocks of sources and bounded slices of terms,
on dense tables within a task; terms that neither source has need no cell, as
each has a distance that only depends on the two groups.

Defined cases: null text, language and source are read as the empty text. A
language without kept terms has distance 0 everywhere and no terms to list.
Equal values are ordered by the UTF-8 bytes of the item. Repeated rows count as
often as they occur. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import empty_text, sized, slices, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lowers A-Z, keeps other letters and all bytes beyond ASCII, and blanks the rest.
LETTERS = bytes(
    b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
#: Counts that a task holds before it hands them on.
HELD = 250_000
#: Sources in one block of the table of pairs, and cells in one slice of its terms.
BLOCK, CELLS = 256, 200_000


@dataclass(frozen=True)
class Settings:
    """least: documents of a language that a kept term has; smooth: added to each count; scale: of shares; top: terms listed for a source."""

    least: int = 30
    smooth: int = 5
    scale: int = 1_000_000_000
    top: int = 50


def terms_of(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    return Counter(text.translate(LETTERS).split())


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``times`` and ``docs`` by lang, source and term, written as a table. The empty term stands in each group that occurs."""
    rows = docs.select(empty_text(F.col(lang_col)).alias("lang"), empty_text(F.col(source_col)).alias("source"), F.col(text_col).alias("text"))

    def batches_of(held: dict):
        for (lang, source), (times, documents) in held.items():
            terms = list(times)
            for at in range(0, len(terms), 1 << 16):
                part = terms[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).view(pa.string()),
                    pa.array([times[t] for t in part], pa.int64()), pa.array([documents[t] for t in part], pa.int64()),
                ], ["lang", "source", "term", "times", "docs"])

    def task(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in slices(batches):
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for key, text in zip(keys, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                if key not in held:
                    held[key] = Counter({b"": 0}), Counter({b"": 0})
                    size += 1
                times, documents = held[key]
                size -= len(times)
                seen = terms_of(text or b"")
                documents.update(seen.keys())
                for term, n in seen.items():
                    times[term] += n
                size += len(times)
                if size > HELD:
                    yield from batches_of(held)
                    held, size = {}, 0
        yield from batches_of(held)

    counted = rows.mapInArrow(task, "lang string, source string, term string, times long, docs long")
    return stage(counted.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs")))


def share(times: str, total: str, kept: str, settings: Settings) -> Column:
    """The whole-number share of ``times`` occurrences among ``total`` of ``kept`` terms."""
    above = f"cast({settings.scale} as decimal(12,0)) * (cast({times} as decimal(19,0)) + {settings.smooth})"
    return F.expr(f"1 + ({above}) div (cast({total} as decimal(19,0)) + {settings.smooth} * cast({kept} as decimal(19,0)))")


class Shares(NamedTuple):
    """groups: lang, source, nth, kept, zero (its share of an absent term); cells: lang, source, term, p and the language's q, where a group has the term."""

    groups: DataFrame
    cells: DataFrame


def shares(docs: DataFrame, settings: Settings = Settings(), **columns: str) -> Shares:
    """The shares of all sources of all languages, written as tables."""
    counts = term_counts(docs, **columns)
    found = counts.where("term <> ''")
    kept = stage(
        found.groupBy("lang", "term").agg(F.sum("times").alias("of_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= settings.least).drop("docs")
    )
    langs = stage(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("of_lang").alias("of_all")))
    cells = stage(found.join(sized(kept, 100), ["lang", "term"]).select("lang", "source", "term", "times", "of_lang"))
    totals = cells.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    none = F.lit(0).cast("long")
    groups = (
        counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .withColumn("total", F.coalesce("total", none)).withColumn("of_all", F.coalesce("of_all", none))
        .withColumn("kept", F.coalesce("kept", none))
        .withColumn("zero", F.when(F.col("kept") > 0, share("0", "total", "kept", settings)))
        # A row for each source of a language.
        .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )
    groups = stage(groups)
    cells = cells.join(sized(groups, 100), ["lang", "source"]).select(
        "lang", "source", "nth", "term",
        share("times", "total", "kept", settings).alias("p"), share("of_lang", "of_all", "kept", settings).alias("q"),
    )
    return Shares(groups, stage(cells))


def distances(found: Shares) -> DataFrame:
    """``apart``, by lang and the places ``i`` < ``j`` of two sources: what their terms add to ``kept * abs(zero - zero)``."""
    groups, cells = found
    # One row per language.
    per_lang = stage(
        groups.groupBy("lang").agg(((F.max("nth") + F.lit(BLOCK)) / BLOCK).cast("int").alias("blocks"))
        .join(cells.groupBy("lang").agg((F.count("*") / CELLS + 1).cast("int").alias("parts")), "lang")
    )
    # A block of sources meets every block of its language once.
    own = F.expr(f"nth div {BLOCK}").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def tiled(rows: DataFrame) -> DataFrame:
        rows = rows.join(sized(per_lang, 60), "lang").select("*", own.alias("own"), other.alias("other"))
        return rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))

    # Each slice of the terms gets the cells, and the zero shares of all of its sources.
    terms = tiled(cells).select("lang", "a", "b", F.expr("cast(pmod(xxhash64(term), parts) as int)").alias("part"), "nth", "term", "p")
    zeros = tiled(groups.where("kept > 0")).select(
        "lang", "a", "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "nth", F.lit("").alias("term"), F.col("zero").alias("p")
    )

    def slice_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        absent = rows["term"] == ""
        places = np.sort(rows.loc[absent, "nth"].to_numpy())
        zero = rows.loc[absent].set_index("nth")["p"].loc[places].to_numpy()
        rest = rows.loc[~absent]
        at, names = pd.factorize(rest["term"])
        dense = np.repeat(zero[:, None], len(names), axis=1)
        dense[np.searchsorted(places, rest["nth"].to_numpy()), at] = rest["p"].to_numpy()
        out = []
        first, second = places // BLOCK == key[1], places // BLOCK == key[2]
        for k in np.flatnonzero(first):
            later = np.flatnonzero(second & (places > places[k]))
            sums = np.abs(dense[later] - dense[k]).sum(1) - len(names) * np.abs(zero[later] - zero[k])
            out.append(pd.DataFrame({"lang": key[0], "i": places[k], "j": places[later], "apart": sums}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "i": [], "j": [], "apart": []})

    sliced = terms.unionByName(zeros).groupBy("lang", "a", "b", "part")
    return sliced.applyInPandas(slice_of, "lang string, i int, j int, apart long").groupBy("lang", "i", "j").agg(F.sum("apart").alias("apart"))


def audit(docs: DataFrame, settings: Settings = Settings(), **columns: str) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): all other sources by distance, and the terms that a source has more than its language."""
    found = shares(docs, settings, **columns)
    groups = found.groups.select("lang", "source", "nth", "kept", "zero")
    others = groups.select("lang", F.col("source").alias("item"), F.col("nth").alias("nth_of"), F.col("zero").alias("zero_of"))
    apart = stage(distances(found))
    # Every pair of sources is a row of the result.
    pairs = (
        groups.join(others, "lang").where("nth <> nth_of")
        .withColumn("i", F.least("nth", "nth_of")).withColumn("j", F.greatest("nth", "nth_of"))
        .join(sized(apart, 60), ["lang", "i", "j"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.expr(
            "coalesce(apart, 0L) + coalesce(kept * abs(zero - zero_of), 0L)"
        ).alias("value"))
    )
    terms = found.cells.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
