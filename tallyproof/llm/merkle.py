"""Merkle manifest of a dataset: one tree per source, one tree over the sources, a proof per row.

Nodes of a tree are numbered along its order, so parent and slot of a node are its number divided
by the fanout. A slot pivot, conditional aggregates over the children of a parent, spreads them into
one column per slot: all columns in a row hash to the parent, and leaving out a child's own column
leaves its siblings. ``LEVELS`` levels share one shuffle and one sort: nodes are dealt by the run
of ``FANOUT ** LEVELS`` leaves they lie in, and every window is a prefix of the same order. Only
the top of such a run goes on to the next shuffle, so tables shrink by that factor.

Order does not pass through one task either: rows are dealt by range, numbered inside a range, and
the ranges' counts (one row per range and source) give the offsets. Equal rows are told apart by
their place in the stored input, so a row that is repeated any number of times spreads as well.

Defined results: a null column is hashed as ``-``, and as null it differs from an empty text. Rows
without an id come before all others of their source and are never tampered with. Equal rows are
leaves of their own. A source is any value, null included. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyproof.llm.common import stored, table

FANOUT, LEVELS = 3, 5
RUN = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    return digest(*[field(columns[name]) for name in FIELDS])


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``idx`` (from 0 along ``order`` inside ``tree``) and ``n`` (rows of the tree).

    ``order`` ends in a column that no two rows of a tree share.
    """
    dealt = rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id())
    # the range of a row is read twice and must not be drawn anew
    dealt = stored(dealt, "merkle-ranges")
    ahead = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("own"))
        .withColumn("before", F.coalesce(F.sum("own").over(ahead), F.lit(0)))
        .withColumn("n", F.sum("own").over(Window.partitionBy("tree")))
        .select("tree", "range", "before", "n")
    )
    inside = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order))
    out = dealt.withColumn("inside", inside).join(offsets, ["tree", "range"])
    return out.withColumn("idx", F.col("before") + F.col("inside") - 1).drop("inside", "before", "range")


def parents_of(count: Column, levels: int = 1) -> Column:
    size = FANOUT**levels
    return F.floor((count + F.lit(size - 1)) / F.lit(size)).cast("long")


def run_levels(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, idx, n, digest) with ``run``, the digest ``top`` of their run after LEVELS
    levels, and ``steps``: per level that their tree has, the siblings before and after the way up."""
    place = [F.col("idx")] + [F.floor(F.col("idx") / F.lit(FANOUT**k)).cast("long") for k in range(1, LEVELS + 1)]
    names = [f"place{k}" for k in range(LEVELS + 1)]
    rows = nodes.withColumns({name: p for name, p in zip(names, place, strict=True)}).withColumn("run", F.col(names[-1]))
    rows = rows.repartition("tree", "run").withColumn("top", F.col("digest"))
    steps = []
    for k in range(LEVELS):
        # from the run down to the parent: the finest window sorts, the coarser ones find its order
        parent = Window.partitionBy("tree", "run", *reversed(names[k + 1 : LEVELS]))
        slot = F.pmod(F.col(names[k]), F.lit(FANOUT))
        columns = [f"slot{j}" for j in range(FANOUT)]
        rows = rows.withColumns({c: F.max(F.when(slot == j, F.col("top"))).over(parent) for j, c in enumerate(columns)})
        left = F.concat_ws("", *[F.when(slot > j, F.col(c)) for j, c in enumerate(columns)])
        right = F.concat_ws("", *[F.when(slot < j, F.col(c)) for j, c in enumerate(columns)])
        more = parents_of(F.col("n"), k) > 1
        rows = rows.withColumns(
            {
                f"step{k}": F.when(more, F.struct(left.alias("left"), right.alias("right"))),
                "top": F.when(more, digest(*map(F.col, columns))).otherwise(F.col("top")),
            }
        )
        steps.append(f"step{k}")
    kept = [c for c in nodes.columns if c != "n"]
    return rows.select(*kept, "n", "run", "top", F.array_compact(F.array(*steps)).cast(PATH).alias("steps"))


def grown(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and, from run to run, the tables above them; the last has one node per tree."""
    levels = [stored(nodes, "merkle-nodes")]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tops = run_levels(levels[-1]).where(F.pmod("idx", F.lit(RUN)) == 0)
        tops = tops.select("tree", F.col("run").alias("idx"), parents_of(F.col("n"), LEVELS).alias("n"), F.col("top").alias("digest"))
        levels.append(stored(tops, "merkle-nodes"))
    return levels


def proved(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest nodes with their whole way up. ``tops`` has one row per tree: tree, ``path`` (the
    steps above the tree) and columns to hand down."""
    above = tops.withColumn("run", F.lit(0).cast("long"))
    for nodes in reversed(levels[:-1]):
        rows = run_levels(nodes).withColumnRenamed("idx", "own_idx").join(above, ["tree", "run"])
        rows = rows.withColumn("path", F.concat("steps", "path")).drop("run", "n", "top", "steps", "digest" if nodes is not levels[0] else "")
        above = rows.withColumnRenamed("own_idx", "run")
    if len(levels) == 1:
        return levels[0].drop("n", "idx").join(above.drop("run"), "tree")
    return above.drop("run")


def manifest(docs: DataFrame, checked: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root and ``path`` (array of left and right siblings' digests,
    from the leaf up) of every row.

    ``checked``: columns of ``docs`` that replace those of ``FIELDS`` in a second leaf, ``other``.
    """
    own = {name: F.col(f"`{name}`") for name in FIELDS}
    leaves = docs.select(
        own["doc_id"].alias("doc_id"),
        own["source"].alias("source"),
        F.coalesce(F.concat(F.lit("="), own["source"].cast("string")), F.lit("")).alias("tree"),
        leaf_of(own).alias("digest"),
        leaf_of(own | (checked or {})).alias("other"),
    )
    # told apart by their place, which the stored copy fixes
    leaves = stored(leaves.withColumn("place", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = numbered(leaves, "doc_id", "digest", "place")
    by_source = grown(leaves.drop("place"))
    subroots = by_source[-1].where("idx = 0").select("tree", F.col("digest").alias("subroot")).distinct()
    tops = subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("member"), F.col("subroot").alias("digest"))
    over = grown(numbered(tops, "member"))
    root = over[-1].select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    members = stored(proved(over, root).select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "merkle-roots")
    return proved(by_source, members).select("doc_id", "source", F.col("digest").alias("leaf"), "other", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def tampered(text: Column, doc_id: Column) -> Column:
    """Without its newlines where 2 divides the CRC-32 of the decimal id."""
    picked = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 2 == 0
    return F.when(picked, F.translate(text, "\n", "")).otherwise(text)


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, each proof checked on a tampered copy."""
    docs = table(spark, folder, "documents")
    rows = manifest(docs, {"text": tampered(F.col("text"), F.col("doc_id"))})
    rows = rows.withColumn("folded_root", folded(F.col("other"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def crc_table() -> list[int]:
    """The byte table of CRC-32, from its reflected polynomial."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(text if f == 'text' else f) for f in FIELDS)})"


ORACLE = f"""
WITH RECURSIVE crc(b) AS (SELECT {crc_table()}::BIGINT[]),
docs AS (
  SELECT d.*, doc_id IS NOT NULL AND xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: xor(b[(xor(a, c) & 255) + 1], a >> 8)), 4294967295) % 2 = 0 AS picked
  FROM documents d, crc),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS digest,
    CASE WHEN picked THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other FROM docs),
nodes AS (
  SELECT *, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest)),
up(tree, step, idx, n, digest) AS (
  SELECT tree, 0, idx, n, digest FROM nodes
  UNION ALL
  SELECT tree, step + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY tree, step, idx // 3, n),
tops AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
over_all(step, idx, n, digest) AS (
  SELECT 0, idx, n, digest FROM tops
  UNION ALL
  SELECT step + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM over_all WHERE n > 1 GROUP BY step, idx // 3, n),
root AS (SELECT digest FROM over_all WHERE n = 1),
ways AS (
  SELECT l.tree, l.idx, u.step, u.idx AS spot, u.digest, u.idx = l.idx // (3 ** u.step)::BIGINT AS own
  FROM nodes l JOIN up u ON u.tree = l.tree AND u.n > 1
    AND u.idx // 3 = l.idx // (3 ** (u.step + 1))::BIGINT),
above AS (
  SELECT t.tree, o.step, o.idx AS spot, o.digest, o.idx = t.idx // (3 ** o.step)::BIGINT AS own
  FROM tops t JOIN over_all o ON o.n > 1 AND o.idx // 3 = t.idx // (3 ** (o.step + 1))::BIGINT),
path AS (
  SELECT tree, idx, step, spot, digest, own FROM ways
  UNION ALL
  SELECT n.tree, n.idx, 1000 + a.step, a.spot, a.digest, a.own FROM nodes n JOIN above a USING (tree)),
steps AS (
  SELECT tree, idx, dense_rank() OVER (PARTITION BY tree, idx ORDER BY step) - 1 AS step, spot, digest, own FROM path),
proofs AS (
  SELECT tree, idx, string_agg(digest, '' ORDER BY step, spot) FILTER (WHERE NOT own) AS siblings FROM steps GROUP BY tree, idx),
fold(tree, idx, step, digest) AS (
  SELECT tree, idx, 0, other FROM nodes
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(string_agg(CASE WHEN s.own THEN f.digest ELSE s.digest END, '' ORDER BY s.spot))
  FROM fold f JOIN steps s ON s.tree = f.tree AND s.idx = f.idx AND s.step = f.step
  GROUP BY f.tree, f.idx, f.step),
ends AS (SELECT tree, idx, arg_max(digest, step) AS folded_root FROM fold GROUP BY tree, idx)
SELECT n.doc_id, n.digest AS leaf, t.digest AS subroot, root.digest AS root,
  sha256(coalesce(p.siblings, '')) AS proof_sha256, e.folded_root, e.folded_root = root.digest AS verified
FROM nodes n JOIN tops t USING (tree) JOIN ends e ON e.tree = n.tree AND e.idx = n.idx
  LEFT JOIN proofs p ON p.tree = n.tree AND p.idx = n.idx, root
"""
