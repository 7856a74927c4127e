"""Language identification by Bayesian evidence fusion.

Four kinds of evidence give a language's posterior probability:

* the text, by a naive Bayes model of character trigrams, counted over all
  labelled documents; as trigrams overlap and one text repeats itself, ``n``
  characters weigh as ``n * k / (n + k)`` independent ones;
* the language that the markup declares, by how often pages of each language
  (as their text has it) declare which;
* the address suffix (last label of the host), likewise;
* the host, as the prior: languages of its other pages, smoothed towards those
  of its domain, and these towards all (each level counts for as many pages as
  ``Settings.prior``). A page does not count for its own prior.

All counts are grouped aggregations over all rows. Counts per host, domain and
suffix are joined back by broadcast if their counted size fits, else by a
shuffle in which Spark can split a hot host.

Every labelled language is told apart, however many there are and however rare
they are: a language's model is smoothed towards that of all texts, and texts
are scored by ``Settings.group`` languages at a time, so a task holds no more
models than that. The driver holds the names of the languages and one group.

Defined cases: missing evidence (no text, no declaration, no host) leaves the
rest to decide; with none at all the overall prior does. Declared languages
that no document is labelled with count as one, "other". Ties go to the
language that comes first in the alphabet. Without labelled documents every
language is null. Repeated rows are judged alike. An empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, numbered, sized, slices, stage
from marquee.llm.trigrams import CODES, codes_of, symbol_table, trigram_counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements whose content is no text, and the end of each.
HIDDEN = re.compile(r"<(script|style)\b", re.I | re.A)
HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I | re.A) for name in ("script", "style")}
#: Languages whose counts come to the driver together.
COLLECTED = 8


@dataclass(frozen=True)
class Settings:
    """smooth: added to each count of all texts; shared: trigrams that the model of all texts weighs in a language's;
    group: languages that are scored in one reading of the texts."""

    smooth: float = 0.5
    shared: float = 2000.0
    group: int = 64
    effective: float = 200.0
    prior: float = 10.0
    sure: float = 0.5


def page_text(html: str) -> str:
    """What comments, scripts, styles and tags leave of a page, in time that grows with its length.

    What is not closed ends at its first ``>``; without one it is text.
    """
    parts, at, unclosed = [], 0, set()
    while (tag := html.find("<", at)) >= 0:
        parts.append(html[at:tag])
        hidden, end = HIDDEN.match(html, tag), -1
        # An end that is missing once is missing for all that follows.
        if hidden and (name := hidden[1].lower()) not in unclosed:
            close = HIDDEN_END[name].search(html, hidden.end())
            end = close.end() if close else -1
            if not close:
                unclosed.add(name)
        elif "--" not in unclosed and html.startswith("<!--", tag):
            end = html.find("-->", tag + 4) + 3
            if end < 3:
                end = -1
                unclosed.add("--")
        if end < 0:
            end = html.find(">", tag) + 1
        if not end:
            parts.pop()
            break
        at = end
    parts.append(html[at:])
    return unescape(" ".join(parts))


def declared_language(html: Column) -> Column:
    tag = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.lower(F.when(tag != "", tag))


def records(documents: DataFrame | None, pages: DataFrame | None) -> DataFrame:
    """Both tables as one: ids, text, html, host, suffix, declared. A document's source stands for its host."""
    parts = []
    if documents is not None:
        parts.append(documents.select(
            F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"),
            "text", F.lit(None).cast("string").alias("html"), F.col("source").alias("host"),
            F.lit(None).cast("string").alias("suffix"), F.lit(None).cast("string").alias("declared"),
        ))
    if pages is not None:
        host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
        host = F.when(host != "", host)
        parts.append(pages.select(
            F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
            F.lit(None).cast("string").alias("text"), "html", host.alias("host"),
            F.regexp_extract(host, r"\.([^.:]+)(:\d*)?$", 1).alias("suffix"), declared_language("html").alias("declared"),
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("suffix", F.when(F.col("suffix") != "", F.col("suffix"))).withColumn(
        "domain", F.when(F.contains("host", F.lit(".")), F.substring_index("host", ".", -2)).otherwise("")
    )


def train(documents: DataFrame) -> tuple[list[str], DataFrame]:
    """All labelled languages, and how often each trigram occurs in each, by its place among them. Written as a table."""
    known = documents.where("lang is not null and lang <> ''")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    numbers = sized(stage(documents.sparkSession.createDataFrame(list(enumerate(langs)), "number int, lang string")), 100)
    return langs, stage(trigram_counts(known).join(numbers, "lang").select("number", "code", "n"))


def models(counts: DataFrame, first: int, size: int, settings: Settings) -> np.ndarray:
    """Log probability of every trigram in ``size`` languages from ``first`` on: 262,144 numbers for each."""
    every = counts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    whole = np.full(CODES, settings.smooth)
    whole[every.column("code").to_numpy()] += every.column("n").to_numpy()
    whole *= settings.shared / whole.sum()
    table = np.tile(whole.astype(np.float32), (size, 1))
    for at in range(0, size, COLLECTED):
        part = counts.where(F.col("number").between(first + at, first + min(at + COLLECTED, size) - 1)).toArrow()
        table[part.column("number").to_numpy() - first, part.column("code").to_numpy()] += part.column("n").to_numpy()
    for row in table:
        row[:] = np.log(row / row.sum(dtype=np.float64))
    return table


KEYS = ("kind", "doc_id", "page_id", "host", "domain", "suffix", "declared")


def _text_logs(rows: DataFrame, keys: Sequence[str], table: np.ndarray, settings: Settings) -> DataFrame:
    """``keys`` of each row with ``text_log``, the weighed log likelihood of its text in each language of ``table``."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField("text_log", T.ArrayType(T.DoubleType()))])

    def task(batches):
        symbols, table = symbol_table(), shared.value
        for batch in slices(batches, 4 << 20, 1024):
            texts = [
                t if t is not None else page_text(h or "")
                for t, h in zip(batch.column("text").to_pylist(), batch.column("html").to_pylist(), strict=True)
            ]
            texts = [t if t.strip() else "" for t in texts]  # blanks are no evidence
            codes, starts = codes_of(texts, symbols)
            n = np.diff(starts)
            logs = np.zeros((len(texts), len(table)))
            full = np.flatnonzero(n)
            for i, row in enumerate(table):
                if len(full):
                    logs[full, i] = np.add.reduceat(row[codes].astype(np.float64), starts[:-1][full])
            logs *= (settings.effective / (n + settings.effective))[:, None]
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1) * len(table), pa.int32()), pa.array(logs.ravel())
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), flat], schema.names)

    return rows.select(*keys, "text", "html").mapInArrow(task, schema)


def text_evidence(rows: DataFrame, langs: list[str], counts: DataFrame, settings: Settings) -> DataFrame:
    """Keys of each row with ``text_log`` for all languages. Written as a table.

    With more languages than one group, the rows are numbered and written, read
    once for each group, and the groups' numbers are put together by row.
    """
    groups = [(at, min(settings.group, len(langs) - at)) for at in range(0, len(langs), settings.group)]
    if len(groups) == 1:
        return stage(_text_logs(rows, KEYS, models(counts, *groups[0], settings), settings))
    rows = stage(numbered(rows, *KEYS, "text", "html"))
    logs = None
    for first, size in groups:
        found = stage(_text_logs(rows, [ROW], models(counts, first, size, settings), settings)).withColumn("first", F.lit(first))
        logs = found if logs is None else logs.unionByName(found)
    # One piece per group and row.
    pieces = F.array_sort(F.collect_list(F.struct("first", "text_log")))
    whole = logs.groupBy(ROW).agg(F.flatten(F.transform(pieces, lambda x: x["text_log"])).alias("text_log"))
    return stage(rows.select(*KEYS, ROW).join(whole, ROW).drop(ROW))


def _joined(rows: DataFrame, key: str, name: str, size: int) -> DataFrame:
    """``rows`` with how many of its key's rows have which language by their text, and with the sum of these."""
    found = rows.where(F.col(key).isNotNull()).groupBy(key, "by_text").agg(F.count(F.lit(1)).alias("n"))
    # At most a pair for each language.
    pairs = F.map_from_entries(F.collect_list(F.when(F.col("by_text").isNotNull(), F.struct("by_text", "n"))))
    zero = F.lit(0).cast("long")
    packed = found.groupBy(key).agg(pairs.alias("pairs")).select(
        key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("pairs", i), zero)).alias(name),
        F.aggregate(F.map_values("pairs"), zero, lambda a, x: a + x).alias(f"{name}_n"),
    )
    return sized(stage(packed), 100 + 8 * size)


def identify(rows: DataFrame, langs: list[str], counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Posterior language of each row of ``records``; ``langs`` and ``counts`` as ``train`` gives them."""
    size = len(langs)
    if not size:
        return rows.select(
            *KEYS, F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("language"),
            F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"),
        )
    read = text_evidence(rows, langs, counts, settings)
    best = F.array_position("text_log", F.array_max("text_log")).cast("int") - 1
    # Rows without text have no language of their own and count nowhere.
    read = read.withColumn("by_text", F.when(F.exists("text_log", lambda x: x != 0), best))
    declared = F.when(F.col("declared").isin(langs), F.col("declared")).when(F.col("declared").isNotNull(), "other")
    read = read.withColumn("declared_as", declared)

    by_text = dict(read.where("by_text is not null").groupBy("by_text").count().collect())
    total = [by_text.get(i, 0) for i in range(size)]
    all_rows, overall = F.lit([float(n) for n in total]), F.lit([(n + 1) / (sum(total) + size) for n in total])
    out = read
    for key, name in (("host", "of_host"), ("domain", "of_domain"), ("suffix", "of_suffix"), ("declared_as", "of_declared")):
        out = out.join(_joined(read, key, name, size), key, "left")

    none, weight = F.lit(0.0), settings.prior

    def others(name: str, i: Column) -> Column:
        """A group's other rows of language i; null without a group."""
        return F.get(name, i) - F.when(F.col("by_text") == i, 1.0).otherwise(none)

    def level(name: str, i: Column, above: Column) -> Column:
        """Share of language i among a group's other rows, smoothed towards the level above."""
        n = F.coalesce(F.col(f"{name}_n") - F.col("by_text").isNotNull().cast("int"), none)
        return (F.coalesce(others(name, i), none) + weight * above) / (n + weight)

    def likelihood(name: str, i: Column) -> Column:
        """Log probability that a row of language i has this declaration or suffix; 0 if it has none."""
        return F.coalesce(F.log((others(name, i) + 0.5) / (F.get(all_rows, i) + 1.0)), none)

    scores = F.transform("text_log", lambda text, i: (
        text + F.log(level("of_host", i, level("of_domain", i, F.get(overall, i))))
        + likelihood("of_suffix", i) + likelihood("of_declared", i)
    ))
    out = out.withColumn("scores", scores).withColumn("top", F.array_max("scores"))
    sums = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.lit(langs)
    return out.select(
        *KEYS, F.get(names, F.col("by_text")).alias("text_lang"),
        F.get(names, F.array_position("scores", F.col("top")).cast("int") - 1).alias("language"), (1 / sums).alias("confidence"),
    ).withColumn("kept", F.col("confidence") >= settings.sure)
