"""Quality rules by repetition coverage.

Rolling hashes of 2- to 10-word windows find repeated passages inside one text; the rules look at
the share of its characters that lies in them, in repeated lines, and at symbols per word.

Defined results: a null text counts as empty; an empty text has no words and fails the base rule.
Repeated rows are judged each by itself. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import blocks, fields, keeps_columns, mapped, table, utf8, without
from tallyproof.llm.words import SPACE, code_points, mixed, windows, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
# Lengths of the windows whose most frequent one is measured, and of those measured together.
TOP, ALL = (2, 3, 4), (5, 6, 7, 8, 9, 10)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_share", *(f"top_{n}_share" for n in TOP), *(f"dup_{n}_share" for n in ALL)]
MEASURES = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} double" for c in SHARES)])


@dataclass(frozen=True)
class Limits:
    """Largest accepted shares of a text's word characters, and symbols per word.

    The shares count every copy of a repeated window, the first included, so they are about twice
    the usual limits, which count the later copies only.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    dup_lines: float = 0.30
    top_2: float = 0.30
    top_3: float = 0.30
    top_4: float = 0.30
    dup_5: float = 0.45
    dup_6: float = 0.44
    dup_7: float = 0.43
    dup_8: float = 0.42
    dup_9: float = 0.41
    dup_10: float = 0.40
    symbols_per_word: float = 0.30


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words that lie in one of the windows of ``n`` words that begin ``at``."""
    edge = np.zeros(size + 1, np.int64)
    edge[at] += 1
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def repeated_windows(
    hashes: np.ndarray, row: np.ndarray, salt: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of ``n`` words found twice or more in their row, the group of equal
    windows each belongs to, and the groups' sizes. Only repeated keys are ever looked up."""
    size = max(0, len(hashes) - n + 1)
    at = np.flatnonzero(row[:size] == row[n - 1 :]) if size else np.empty(0, np.int64)
    key = windows(hashes, n)[at] ^ salt[at]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return at[:0], at[:0], at[:0]
    maybe = np.zeros(1 << 16, bool)
    maybe[(twice & np.uint64(0xFFFF)).astype(np.int64)] = True
    near = np.flatnonzero(maybe[(key & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(twice, key[near]), len(twice) - 1)
    hit = twice[place] == key[near]
    return at[near[hit]], place[hit], np.bincount(place[hit], minlength=len(twice))


def line_measures(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and their code points without white space."""
    seen: set[bytes] = set()
    lines = chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            lines += 1
            raw = np.frombuffer(line, np.uint8)
            chars += int(((raw & 0xC0) != 0x80).sum() - SPACE[raw].sum())
        elif line.strip(b" \t\x0b\x0c\r"):
            seen.add(line)
    return lines, chars


def measure_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All counts and shares of the rows of one buffer."""
    rows = len(offsets) - 1
    w = words(data, offsets)
    points = code_points(data)
    chars = (points[w.end] - points[w.start]).astype(np.float64)
    per_row = lambda v: np.bincount(w.row, v, rows)
    total = per_row(chars)
    share = lambda x: np.divide(x, total, out=np.zeros(rows), where=total > 0)
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    raw = data.tobytes()
    lines = [line_measures(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    out = {
        "n_words": np.bincount(w.row, minlength=rows),
        "word_chars": total.astype(np.int64),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.array([x[0] for x in lines], np.int64),
        "n_repeat_words": np.zeros(rows, np.int64),
        "dup_line_share": share(np.array([x[1] for x in lines], np.float64)),
    }
    salted = mixed(w.row.astype(np.uint64) + np.uint64(1))
    for n in (*TOP, *ALL):
        at, group, count = repeated_windows(w.hash, w.row, salted, n)
        inside = per_row(np.where(covered(at, n, len(w.hash)), chars, 0)) if len(at) else np.zeros(rows)
        if n == 3:
            out["n_repeat_words"] = per_row(covered(at, n, len(w.hash))).astype(np.int64)
        if n in ALL:
            out[f"dup_{n}_share"] = share(inside)
        else:
            # characters of the most covering repeated window; every copy has the same length
            best, before = np.zeros(rows), np.concatenate([[0], np.cumsum(chars)])
            np.maximum.at(best, w.row[at], count[group] * (before[at + n] - before[at]))
            out[f"top_{n}_share"] = share(best)
    return out


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts and shares of its whole texts."""
    keep = without(docs, *COUNTS, *SHARES)
    chosen = docs.select(*keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for i, j in blocks(offsets):
                part = measure_block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                columns = [*batch.slice(i, j - i).columns, *(pa.array(part[c]) for c in [*COUNTS, *SHARES])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *COUNTS, *SHARES])

    return mapped(chosen, work, f"{fields(chosen)}, {MEASURES}")


def judged(docs: DataFrame, limits: Limits | None = None, text: str = "text") -> DataFrame:
    """``docs`` with measures, ``base_failed`` and ``kept``."""
    lim = asdict(limits or Limits())
    base = (F.col("n_words") < lim["min_words"]) | (
        100 * F.col("n_repeat_words") > lim["max_repeat_percent"] * F.col("n_words")
    )
    bad = (F.col("dup_line_share") > lim["dup_lines"]) | (
        F.col("n_symbols") > lim["symbols_per_word"] * F.col("n_words")
    )
    for n in TOP:
        bad |= F.col(f"top_{n}_share") > lim[f"top_{n}"]
    for n in ALL:
        bad |= F.col(f"dup_{n}_share") > lim[f"dup_{n}"]
    out = measures(docs.select(*without(docs, "base_failed", "kept")), text)
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~bad)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", *COUNTS, "base_failed", "kept", *SHARES)


@keeps_columns
def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep."""
    return judged(docs).where("kept").select(*(f"`{c}`" for c in docs.columns))


def oracle(limits: Limits | None = None) -> str:
    """The same counts and shares in DuckDB, from the words' texts instead of hashes."""
    lim = asdict(limits or Limits())
    sizes = (*TOP, *ALL)
    follow = {n: " || ' ' || ".join(["w", *(f"lead(w, {j}) OVER o" for j in range(1, n))]) for n in sizes}
    grams = ", ".join(f"{follow[n]} AS g{n}" for n in sizes)
    counts = ", ".join(f"CASE WHEN g{n} IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY rid, g{n}) END AS c{n}" for n in sizes)
    # a word is covered when one of the n windows that end with or after it, here by position, repeats
    inside = ", ".join(
        f"max(CASE WHEN c{n} > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m{n}"
        for n in sizes
    )
    tops = ", ".join(
        f"max(CASE WHEN c{n} > 1 THEN c{n} * (length(g{n}) - {n - 1}) ELSE 0 END) AS t{n}" for n in TOP
    )
    covers = ", ".join(f"sum(m{n} * length(w)) AS d{n}" for n in ALL)
    share = lambda x: f"CASE WHEN coalesce(chars, 0) > 0 THEN {x}::DOUBLE / chars ELSE 0::DOUBLE END"
    shown = ", ".join([*(f"{share(f't{n}')} AS top_{n}_share" for n in TOP), *(f"{share(f'd{n}')} AS dup_{n}_share" for n in ALL)])
    bad = " OR ".join(
        [f"dup_line_share > {lim['dup_lines']}::DOUBLE", f"n_symbols > {lim['symbols_per_word']}::DOUBLE * n_words"]
        + [f"top_{n}_share > {lim[f'top_{n}']}::DOUBLE" for n in TOP]
        + [f"dup_{n}_share > {lim[f'dup_{n}']}::DOUBLE" for n in ALL]
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs)),
grams AS (SELECT *, {grams} FROM parts WINDOW o AS (PARTITION BY rid ORDER BY i)),
counted AS (SELECT *, {counts} FROM grams),
marked AS (SELECT *, {inside} FROM counted),
words AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS chars, sum(m3) AS n_repeat, {tops}, {covers} FROM marked GROUP BY rid),
lines AS (SELECT rid, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM docs)),
later AS (SELECT rid, l, row_number() OVER (PARTITION BY rid, l ORDER BY i) AS k FROM lines
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
dups AS (SELECT rid, count(*) AS n, sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS line_chars
  FROM later WHERE k > 1 GROUP BY rid),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n, 0) AS n_dup_lines,
    coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, {share("coalesce(line_chars, 0)")} AS dup_line_share, {shown}
  FROM docs LEFT JOIN words USING (rid) LEFT JOIN dups USING (rid)),
based AS (
  SELECT *, n_words < {lim["min_words"]} OR 100 * n_repeat_words > {lim["max_repeat_percent"]} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND NOT ({bad}) AS kept FROM based
"""
