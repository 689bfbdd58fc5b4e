"""Frozen manifests: an accepted key list packed into text chunks and checked on the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.operators.ordered import row_numbers
from tallyproof.operators.reconcile import beside

DELIMITER = "~"
FLAG_MARK = ":"


def manifest_pack(
    rows: DataFrame, key: str, flag: str, chunk_size: int, segment: Column
) -> DataFrame:
    """Ordered chunks of ``key:flag`` entries joined with ``~``, with count, length and digest.

    ``segment`` is monotone in the key, so numbering needs no single sorted task.
    """
    numbered = row_numbers(
        rows.select(key, F.col(flag).cast("int").alias("_flag")), segment, [key], "_n"
    )
    entry = F.concat(F.col(key).cast("string"), F.lit(FLAG_MARK), F.col("_flag").cast("string"))
    text = F.expr(f"listagg(_entry, '{DELIMITER}') WITHIN GROUP (ORDER BY _n)")
    return (
        numbered.withColumn("_entry", entry)
        .groupBy((F.floor((F.col("_n") - 1) / chunk_size) + 1).alias("chunk"))
        .agg(
            F.count("*").alias("entries"),
            F.sum("_flag").alias("flagged"),
            text.alias("chunk_text"),
        )
        .withColumn("characters", F.length("chunk_text"))
        .withColumn("chunk_sha256", F.sha2("chunk_text", 256))
    )


# Digests that are joined and hashed together on each level.
FAN_IN = 1024


# Characters up to which the whole text of a manifest may be put together in one row.
WHOLE_TEXT = 64 << 20


def whole_text_digest(chunks: DataFrame, limit: int = WHOLE_TEXT) -> DataFrame:
    """``text_sha256``: the digest over the joined text, as a publisher states it; NULL for more
    than ``limit`` bytes.

    The bytes are counted first, and the text of a manifest beyond the bound is never gathered; its
    tree digest stands either way.
    """
    size = chunks.agg(F.sum(F.octet_length("chunk_text") + 1)).first()[0] or 0
    if size > limit:
        return chunks.sparkSession.range(1).select(F.lit(None).cast("string").alias("text_sha256"))
    joined = F.expr(f"listagg(chunk_text, '{DELIMITER}') WITHIN GROUP (ORDER BY chunk)")
    return chunks.agg(F.sha2(joined, 256).alias("text_sha256"))


def manifest_digest(chunks: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Totals of a packed manifest and the digest over its chunk digests in order.

    A tree of digests: each level hashes at most ``fan_in`` digests of the one below, so no row
    holds more than that many. Up to ``fan_in`` chunks this is one hash of the joined digests.
    """
    level = chunks.select(F.col("chunk").alias("_i"), F.col("chunk_sha256").alias("_d"))
    joined = F.expr(f"listagg(_d, '{DELIMITER}') WITHIN GROUP (ORDER BY _i)")
    left = chunks.count()
    while True:
        group = (F.floor((F.col("_i") - 1) / fan_in) + 1).alias("_i")
        level = level.groupBy(group).agg(F.sha2(joined, 256).alias("_d"))
        left = -(-left // fan_in)
        if left <= 1:
            break
    totals = chunks.agg(
        F.count("*").alias("chunks"),
        F.sum("entries").alias("entries"),
        F.sum("flagged").alias("flagged"),
        (F.sum("characters") + F.count("*") - 1).alias("characters"),
    )
    tops = level.agg(F.max("_d").alias("manifest_sha256"))
    return beside(totals, tops, whole_text_digest(chunks))


def manifest_rows(chunks: DataFrame) -> DataFrame:
    """Chunks back to key and flag rows."""
    entries = chunks.select(
        "chunk", F.explode(F.split("chunk_text", DELIMITER)).alias("_entry")
    )
    parts = F.split("_entry", FLAG_MARK)
    return entries.select(
        "chunk",
        F.element_at(parts, 1).alias("key"),
        F.element_at(parts, 2).cast("int").alias("flag"),
    )


def manifest_unpack_check(chunks: DataFrame, declared: DataFrame) -> DataFrame:
    """Parse the chunks and compare rows, keys, flags, length and digest with the declaration."""
    rows = manifest_rows(chunks)
    parsed = rows.agg(
        F.count("*").alias("parsed_rows"),
        F.sum("flag").alias("parsed_flagged"),
        F.sum(F.length("key") + 2).alias("_chars"),
    )
    keys = rows.select("key").distinct().agg(F.count("*").alias("distinct_keys"))
    again = chunks.withColumn("chunk_sha256", F.sha2("chunk_text", 256)).withColumn(
        "characters", F.length("chunk_text")
    )
    digest = manifest_digest(again).select(
        F.col("manifest_sha256").alias("again_sha256"), F.col("text_sha256").alias("again_text")
    )
    characters = F.col("_chars") + F.col("parsed_rows") - 1
    return beside(parsed, keys, digest, declared).select(
        "parsed_rows",
        "distinct_keys",
        "parsed_flagged",
        characters.alias("rebuilt_characters"),
        F.col("again_sha256").alias("rebuilt_sha256"),
        F.col("again_text").alias("text_sha256"),
        (
            (F.col("parsed_rows") == F.col("entries"))
            & (F.col("distinct_keys") == F.col("entries"))
            & (F.col("parsed_flagged") == F.col("flagged"))
            & (characters == F.col("characters"))
            & (F.col("again_sha256") == F.col("manifest_sha256"))
            & F.col("again_text").eqNullSafe(F.col("text_sha256"))
        ).alias("manifest_matches"),
    )
