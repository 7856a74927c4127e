"""URL filters: rules by host and path, and a logistic regression for all other urls.

Rules decide first; of the rules that fit, the longest does. The model is trained
from a small labelled table of urls: one that is passed, else the urls that a
rule fits, labelled by it. At most ``Settings.learned`` distinct (host, path) of
each verdict are taken, chosen by hash. The model is a logistic
regression on hashed character n-grams of host and path. The n-grams are SQL
expressions; hashing and regression are Spark's own. No Python runs on rows.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and is judged by the model's intercept. If the labelled urls have
one verdict only, it is given to all others; if there are none, others are
allowed. A rule without a slash fits any path. Repeated pages are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stage

A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """learned: most labelled urls of each verdict; grams: sizes of the n-grams; features: hash buckets."""

    learned: int = 2_000
    grams: tuple[int, ...] = (3, 4)
    features: int = 1 << 14
    penalty: float = 0.01
    steps: int = 30
    block_from: float = 0.5


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(rest, A_Z, a_z)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (``host/path`` text) that fits, else null."""
    choice: Column | None = None
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, tail = rule.partition("/")
        fits = (host == name) | host.endswith("." + name)
        if "/" in rule:
            fits &= path.startswith("/" + tail)
        choice = F.when(fits, F.lit(rule)) if choice is None else choice.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if choice is None else choice


def grams(host: Column, path: Column, sizes: Sequence[int]) -> Column:
    """Distinct character n-grams of ``^host$`` and ``^path$``; those of hosts and paths differ."""
    def cut(text: Column, mark: str, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))))

    marked = [(F.concat(F.lit("^"), part, F.lit("$")), mark) for part, mark in ((host, "h"), (path, "p"))]
    parts = [cut(text, mark, n) for text, mark in marked for n in sizes]
    return F.array_distinct(F.concat(*parts))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
    settings: Settings = Settings(), labelled: DataFrame | None = None,
) -> DataFrame:
    """Id, host, path, rule, verdict and the model's probability of ``block`` of each row.

    ``rules`` are (verdict, ``host/path``) pairs; they become one expression,
    so a list of some thousands is as many as is sensible. ``labelled`` has
    columns url and verdict.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    verdict_of: Column | None = None
    for verdict, rule in rules:
        at = F.col("rule") == rule
        verdict_of = F.when(at, verdict) if verdict_of is None else verdict_of.when(at, verdict)
    rows = rows.withColumn("by_rule", F.lit(None).cast("string") if verdict_of is None else verdict_of)

    known = rows.select("host", "path", "by_rule") if labelled is None else labelled.select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("verdict").alias("by_rule")
    )
    chosen = None
    for verdict in ("allow", "block"):
        part = (
            known.where(F.col("by_rule") == verdict).distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path").limit(settings.learned)
        )
        chosen = part if chosen is None else chosen.unionByName(part)
    hashing = HashingTF(numFeatures=settings.features, binary=True, inputCol="grams", outputCol="features")
    learned = stage(
        chosen.select(grams(F.col("host"), F.col("path"), settings.grams).alias("grams"),
                      (F.col("by_rule") == "block").cast("double").alias("label"))
    )
    kinds = sorted(r["label"] for r in learned.select("label").distinct().collect())
    if len(kinds) < 2:
        blocked = F.lit(kinds[0] if kinds else 0.0)
    else:
        model = LogisticRegression(
            featuresCol="features", labelCol="label", probabilityCol="chance", regParam=settings.penalty,
            maxIter=settings.steps, standardization=False,
        ).fit(hashing.transform(learned))
        rows = rows.withColumn("grams", grams(F.col("host"), F.col("path"), settings.grams))
        rows = model.transform(hashing.transform(rows))
        blocked = vector_to_array("chance")[1]
    rows = rows.select("id", "host", "path", "rule", "by_rule", blocked.alias("block_score"))
    by_model = F.when(F.col("block_score") >= settings.block_from, "block").otherwise("allow")
    return rows.select("id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "block_score")
