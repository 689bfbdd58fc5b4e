"""Documents with every odd case, and a reader for the test tables."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STORY = " ".join(f"word{i} goes{i % 7} on" for i in range(40))


def odd_rows() -> list[tuple]:
    texts = [
        STORY, STORY, None, "", " \n\t ", "one", "one two", STORY + " end", STORY.upper(),
        "x" * 200_000, "long text here " * 20_000, "ünï çødé 中文 " * 60, "a\nb\na\nb\n", None, "",
    ]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[2], (None, STORY, None, None, None), (None, None, None, None, None)]


def odd_docs(spark, extra: tuple[str, ...] = ()):
    """The odd rows in several partitions, with extra columns of the given names."""
    rows = [(*r, *(["taken"] * len(extra))) for r in odd_rows()]
    return spark.createDataFrame(rows, ", ".join([SCHEMA, *(f"`{c}` string" for c in extra)])).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(folder: str = FOLDER) -> list[tuple[int, str]]:
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY 1").fetchall()
