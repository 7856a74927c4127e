"""Documents with every odd case, as written files."""

LONG = "the of and that " * 4_000
ROWS = [
    (1, "The dog ran home.\nIt was late.", "en", "s0"), (2, None, "en", "s0"), (3, "", None, "s1"), (4, " \t\n ", "fr", None),
    (5, LONG, "en", "s0"), (6, "x" * 30_000, "en", "s0"), (7, "same text here", "en", "s0"), (7, "same text here", "en", "s0"),
    (8, "same text here", "de", "s2"), (None, "no id at all", "en", "s0"), (None, None, None, None),
    (9, "Überall ÄÖÜ ß 日本語 😀 \x1c\x85", "de", "s2"), (10, "a<|endoftext|>b 's don't", "en", "s1"),
    *((20 + i, f"filler number {i} for the hot source", "en", "s0") for i in range(30)),
]
#: Columns whose names the operators use inside.
EXTRA = "id long, sha string, fp long, score double, kept boolean, position long, slot int, model string, word long"


def write(spark, rows, path):
    """``documents`` with extra columns, in two files."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
    full = [(i, t, g, s, None if t is None else len(t), 1, "x", 2, 0.5, True, 3, 4, "m", 5) for i, t, g, s in rows]
    spark.createDataFrame(full, schema).repartition(2).write.parquet(str(path))
    return spark.read.parquet(str(path))
