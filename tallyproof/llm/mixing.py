"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Every source has a mean repetition rate that brings its bytes to its target share of the output.
A document's number of copies is the inverse of the Poisson distribution at a uniform number drawn
from a seeded hash of its row; the copies are then shuffled globally.

Rows that agree in every column are told apart by their number among each other only, so they are
carried as one row with a count and spread again in runs of ``RUN`` numbers. No order of rows is
needed for that, and a row that makes up a third of the table is neither one draw nor one task.

Defined results: a null source is a source of its own; a null text counts one byte, as an empty one
does. Every row draws by itself, also where ids are missing or repeated. A source without a stated
weight has the default weight. An empty table gives an empty table. Input columns named like an
output column (``copy``, ``shuffle_key``) are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tallyproof.llm.common import DOCUMENT, keeps_columns, stored, table, without

SEED = 20240501
# Target weights of the production mix; shares are weights over their sum.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
# Means above this are drawn as sums of independent parts, so that exp(-mean) never underflows.
PART_MEAN, TERMS = 16.0, 100
# Most sources whose rates are broadcast: about a kilobyte each.
BROADCAST_SOURCES = 2000
# Most repeated rows whose digests are broadcast, about 60 bytes each; numbers of equal rows in a run.
BROADCAST_REPEATS, RUN = 100_000, 4096


def hash_text(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts]))


def uniform(text: Column) -> Column:
    """52 bits of a hexadecimal digest as a double in [0, 1)."""
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null"))


def row_digest(docs: DataFrame, names: list[str]) -> Column:
    """Digest of a whole row: every value after its length, in the order of the column names."""
    simple = {f"`{f.name}`" for f in docs.schema if isinstance(f.dataType, AtomicType)}
    parts = []
    for name in sorted(names):
        value = F.col(name).cast("string") if name in simple else F.to_json(F.struct(name))
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.md5(F.concat(*parts))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``, from 0, the number of a row among those of its digest."""
    repeats = stored(
        rows.groupBy("ident").agg(F.count(F.lit(1)).alias("times")).where("times > 1"),
        "mix-repeats",
    )
    found = repeats.limit(BROADCAST_REPEATS + 1).count()
    if not found:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    side = F.broadcast(repeats) if found <= BROADCAST_REPEATS else repeats
    single = rows.join(side, "ident", "left_anti").withColumn("nth", F.lit(0).cast("long"))
    one = F.first(F.struct("key", "doc")).alias("one")
    runs = (
        rows.join(side, "ident").groupBy("ident", "times").agg(one)
        .select("one.key", "one.doc", "ident", "times", F.explode(F.expr(f"sequence(0, (times - 1) div {RUN})")).alias("run"))
        .repartition("ident", "run")
    )
    many = runs.select(
        "key", "doc", "ident", F.explode(F.expr(f"sequence(run * {RUN}, least(times, (run + 1) * {RUN}) - 1)")).alias("nth")
    )
    return single.select("key", "doc", "ident", "nth").unionByName(many)


def poisson_cdf(mean: Column) -> Column:
    """Distribution function at 0, 1, ... TERMS."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        total = acc["c"] + p
        return F.struct(p.alias("p"), total.alias("c"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["cdf"]


def rates(
    docs: DataFrame, weights: Mapping[str, float], default: float, budget: float, source: str, text: str
) -> DataFrame:
    """Per source: mean rate, number of parts, and the distribution function of one part."""
    if default < 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1
    weight = F.lit(float(default))
    for name, value in weights.items():
        weight = F.when(F.col("key") == f"={name}", float(value)).otherwise(weight)
    sizes = stored(
        docs.groupBy(source_key(source).alias("key")).agg(F.sum(size).alias("size")).withColumn("weight", weight),
        "mix-sizes",
    )
    total = sizes.agg(F.sum("size"), F.sum("weight")).first()
    scale = F.lit(budget * float(total[0] or 0))
    mean = scale * F.col("weight") / (F.lit(float(total[1] or 1) or 1.0) * F.col("size"))
    return (
        sizes.select("key", mean.alias("rate"))
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int"))
        .withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))
    )


def replicated(
    docs: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    default: float = 1.0,
    budget: float = 1.0,
    seed: int = SEED,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` repeated to the target weights, with ``copy`` (from 1) and ``shuffle_key``, in the
    order of a global shuffle. ``budget``: expected bytes of the output over those of the input."""
    by_source = rates(docs, weights, default, budget, source, text)
    few = by_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    names = without(docs, "copy", "shuffle_key")
    row = [F.col("ident"), F.col("nth").cast("string")]
    draws = F.aggregate(
        F.sequence(F.lit(0), F.col("parts") - 1),
        F.lit(0),
        lambda n, j: n
        + F.size(F.filter("cdf", lambda c: c <= uniform(hash_text(str(seed), j.cast("string"), *row)))),
    )
    rows = docs.select(source_key(source).alias("key"), F.struct(*names).alias("doc"), row_digest(docs, names).alias("ident"))
    return (
        numbered(rows).join(F.broadcast(by_source) if few else by_source, "key")
        .select("doc", "ident", "nth", draws.alias("n"))
        .where("n > 0")
        .select("doc", "ident", "nth", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
        .withColumn("shuffle_key", hash_text(str(seed), "order", *row, F.col("copy").cast("string")))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
        .select("doc.*", "copy", "shuffle_key")
    )


def op1_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents replicated to the production weights."""
    return replicated(table(spark, folder, "documents"))


@keeps_columns
def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: documents repeated to the production weights, shuffled."""
    return replicated(docs).select(*(f"`{c}`" for c in docs.columns))


ROW = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in sorted(DOCUMENT))
ORACLE = f"""
WITH sizes AS (
  SELECT coalesce('=' || source, 'null') AS key, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS size
  FROM documents GROUP BY 1),
weighted AS (
  SELECT key, size, CASE {" ".join(f"WHEN key = '={k}' THEN {v}::DOUBLE" for k, v in WEIGHTS.items())}
    ELSE 1::DOUBLE END AS weight FROM sizes),
rates AS (
  SELECT key, (sum(size) OVER ()) * weight / ((sum(weight) OVER ()) * size) AS rate FROM weighted),
parted AS (SELECT key, rate, greatest(1, ceil(rate / {PART_MEAN}))::INT AS parts FROM rates),
cdf AS (
  SELECT key, k, sum(exp(-(rate / parts) + CASE WHEN k = 0 THEN 0 ELSE k * ln(rate / parts) - lgamma(k + 1) END))
    OVER (PARTITION BY key ORDER BY k) AS c
  FROM parted, range({TERMS + 1}) r(k)),
rowed AS (SELECT *, md5({ROW}) AS ident FROM documents),
numbered AS (SELECT *, ident || '|' || (row_number() OVER (PARTITION BY ident) - 1) AS row FROM rowed),
draws AS (
  SELECT d.row, j, p.key,
    ('0x' || md5('{SEED}|' || j || '|' || d.row)[1:13])::BIGINT / {2**52}::DOUBLE AS u
  FROM numbered d JOIN parted p ON p.key = coalesce('=' || d.source, 'null'), range(p.parts) r(j)),
counts AS (
  SELECT row, count(c.k) AS n FROM draws d LEFT JOIN cdf c ON c.key = d.key AND c.c <= d.u GROUP BY row)
SELECT d.* EXCLUDE (ident, row), copy::INT AS copy, md5('{SEED}|order|' || d.row || '|' || copy) AS shuffle_key
FROM numbered d JOIN counts n USING (row), range(1, n.n + 1) r(copy)
"""
