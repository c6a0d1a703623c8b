"""A Merkle tree over a table of documents, with a proof for every row.

Rows are leaves, ordered by id within their source. Every three consecutive nodes
become one until a source has a single node, its subroot; the subroots, ordered by
source, become the root in the same way.

The tree is a rollup. The rank of a node, written with digits of base three, tells
its place: the lowest digit is that within its run, the next one that of the run
within the run above, and so on. Nodes are put into blocks by the digits above the
``DIGITS``-th, and within a block the digits are grouped away from the lowest to
the highest; each step nests the structs it gathers in the struct of their parent.
A block holds at most 3^``DIGITS`` nodes, whatever the size of a source, and its
root is a node of the next tier, where the same is done again. At the end each
block is given the path above it, and a transform of the nested struct and an
explode give the proof of every row, without joining rows with their siblings.

Defined cases: a null in any column counts as null in the leaf (``-``); rows without
a source are a source of their own, before all others; rows without an id come first
within their source and are never tampered with; rows that share an id are ordered by
their leaf, and equal ones have equal leaves, so their places may be exchanged; an
empty text is a value of 0 bytes; other columns do not count; an empty table has no
rows. A source with a single row has its leaf as subroot, and a single source has its
subroot as root. Long texts are hashed where they are read and not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import documents, shared_table

#: Nodes in a run, and digits that are grouped away within a block of 3^6 nodes.
ARITY = 3
DIGITS = 6
BLOCK = ARITY**DIGITS

_NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """sha256 of the parts one after another, as lower-case hex text."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*[field(value) for value in (doc_id, source, lang, n_chars, text)])


def source_key(source: Column) -> Column:
    """A text that is never null and orders as sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


# --- ranks --------------------------------------------------------------------


def ranked(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0, within the group) and ``total`` (size of the group).

    Rows are dealt by ranges of (group, order), so that a group with a third of all
    rows lies in many parts; a rank is the place within the part plus the rows of the
    group in the parts before. ``order`` must tell all rows of a group apart.
    """
    dealt = nodes.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id())
    dealt = shared_table(dealt, "ranges")
    counts = dealt.groupBy(group, "part").agg(F.count("*").alias("n"))
    parts = Window.partitionBy(group).orderBy("part")
    starts = counts.select(
        group,
        "part",
        (F.sum("n").over(parts) - F.col("n")).alias("start"),
        F.sum("n").over(Window.partitionBy(group)).alias("total"),
    )
    within = Window.partitionBy(group, "part").orderBy(*order)
    placed = dealt.withColumn("place", F.row_number().over(within) - 1).join(starts, [group, "part"])
    return placed.withColumn("rank", F.col("start") + F.col("place")).drop("part", "place", "start")


# --- up: the rollup -------------------------------------------------------------


def _levels_left(level: int) -> Column:
    """Whether a group still has several nodes after ``level`` levels."""
    return F.col("total") > ARITY**level


def _block_trees(nodes: DataFrame, group: str) -> DataFrame:
    """``(group, block, total, hash, kids)`` of ``nodes(group, rank, total, hash[, kept])``.

    ``kids`` nests the nodes of a block, ``DIGITS`` structs deep. All steps group by
    what the rows were dealt by and one digit less each time, so they share one shuffle.
    """
    local = F.col("rank") % BLOCK
    digits = [f"d{j}" for j in range(DIGITS)]
    kept = [F.col("kept")] if "kept" in nodes.columns else []
    step = nodes.select(
        group,
        F.floor(F.col("rank") / BLOCK).cast("bigint").alias("block"),
        "total",
        *[(F.floor(local / ARITY**j) % ARITY).cast("int").alias(f"d{j}") for j in range(DIGITS)],
        F.struct("hash", *kept).alias("node"),
    ).repartition(group, "block")
    for j, digit in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(digit).alias("d"), "node")))
        step = step.groupBy(group, "block", "total", *digits[j + 1 :]).agg(kids.alias("kids"))
        hashes = F.transform("kids", lambda kid: kid["node"]["hash"])
        up = F.when(_levels_left(j), F.sha2(F.concat_ws("", hashes), 256)).otherwise(hashes[0])
        step = step.withColumn("node", F.struct(up.alias("hash"), "kids")).drop("kids")
    return step.select(group, "block", "total", "node.hash", "node.kids")


def roll_up(nodes: DataFrame, group: str) -> list[DataFrame]:
    """The tiers of block trees, from the nodes to one block a group.

    Each tier has at most a 3^``DIGITS``-th of the rows of the one below for a large
    group. One number comes to the driver for each tier: the most blocks of a group.
    """
    tiers = []
    while True:
        tier = shared_table(_block_trees(nodes, group), "tier")
        tiers.append(tier)
        if (tier.agg(F.max("block")).first()[0] or 0) == 0:
            return tiers
        nodes = tier.select(
            group,
            F.col("block").alias("rank"),
            F.ceil(F.col("total") / BLOCK).cast("bigint").alias("total"),
            "hash",
        )


# --- down: the paths --------------------------------------------------------------


def _paths_below(blocks: DataFrame, group: str, carried: list[str]) -> DataFrame:
    """``(group, rank, path, ...)`` for every node of ``blocks(group, block, total, kids, path, ...)``.

    A path lists the left and right siblings of a node level by level, upwards; a
    level on which a node is alone in its run has empty siblings.
    """

    def beside(kids: Column, is_beside) -> Column:
        return F.concat_ws("", F.transform(F.filter(kids, is_beside), lambda other: other["node"]["hash"]))

    def descend(kids: Column, level: int, above: Column, place: Column) -> Column:
        def one(kid: Column) -> Column:
            left = beside(kids, lambda other: other["d"] < kid["d"])
            right = beside(kids, lambda other: other["d"] > kid["d"])
            run = F.array(F.struct(left.alias("left"), right.alias("right")))
            here = F.when(_levels_left(level), run).otherwise(F.array().cast(_NO_PATH))
            path = F.concat(here, above)
            at = place * ARITY + kid["d"]
            if level:
                return descend(kid["node"]["kids"], level - 1, path, at)
            return F.array(F.struct(kid["node"].alias("node"), at.alias("at"), path.alias("path")))

        return F.flatten(F.transform(kids, one))

    found = descend(F.col("kids"), DIGITS - 1, F.col("path"), F.lit(0).cast("bigint"))
    rows = blocks.select(group, "block", *carried, F.explode(found).alias("leaf"))
    return rows.select(
        group, (F.col("block") * BLOCK + F.col("leaf.at")).alias("rank"), *carried, "leaf.node", "leaf.path"
    )


def unroll(tiers: list[DataFrame], group: str, tops: DataFrame, carried: list[str]) -> DataFrame:
    """``(group, rank, node, path, ...)`` for every node of the lowest tier.

    ``tops(group, path, ...)`` has the path above each group. On the way down, blocks
    meet their paths one to one, so a large group is spread like its blocks.
    """
    paths = tops.withColumn("block", F.lit(0).cast("bigint"))
    for tier in reversed(tiers):
        below = _paths_below(tier.join(paths, [group, "block"]), group, carried)
        paths = below.withColumnRenamed("rank", "block")
    return paths.withColumnRenamed("block", "rank")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, run: digest(run["left"], at, run["right"]))


# --- the manifest -----------------------------------------------------------------


def manifest(leaves: DataFrame) -> DataFrame:
    """``(kept struct, leaf, source_rank, subroot, root, path)`` for every row of
    ``leaves(source_key, doc_id, leaf, kept)``.

    ``path`` leads from the leaf through the subroot to the root, see :func:`fold`.
    """
    leaves = shared_table(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    nodes = ranked(leaves, "source_key", ["doc_id", "leaf", "tie"])
    nodes = nodes.select("source_key", "rank", "total", F.col("leaf").alias("hash"), "kept")
    tiers = roll_up(nodes, "source_key")

    subroots = tiers[-1].select(F.lit(0).alias("all"), "source_key", F.col("hash").alias("subroot"))
    sources = ranked(subroots, "all", ["source_key"])
    sources = sources.select(
        "all", "rank", "total", F.col("subroot").alias("hash"), F.struct("source_key", "subroot").alias("kept")
    )
    source_tiers = roll_up(sources, "all")
    top = source_tiers[-1].select("all", F.col("hash").alias("root"), F.array().cast(_NO_PATH).alias("path"))
    tops = unroll(source_tiers, "all", top, ["root"]).select("node.kept.source_key", "node.kept.subroot", "root", "path")

    found = unroll(tiers, "source_key", tops, ["subroot", "root"])
    return found.select(
        "node.kept", F.col("node.hash").alias("leaf"), F.col("rank").alias("source_rank"), "subroot", "root", "path"
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "n_chars", "text")
    text = F.col("text").cast("string")
    is_tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = F.when(is_tampered, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    others = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        source_key(F.col("source")).alias("source_key"),
        "doc_id",
        leaf_digest(*others, text).alias("leaf"),
        F.struct("doc_id", leaf_digest(*others, changed).alias("tampered")).alias("kept"),
    )
    found = manifest(leaves)
    siblings = F.transform("path", lambda run: F.concat(run["left"], run["right"]))
    folded = fold(F.col("kept.tampered"), F.col("path"))
    return found.select(
        F.col("kept.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _level_sql(name: str, table: str) -> str:
    """All levels of a tree over ``table(g, rank, hash)``, the leaves being level 0."""
    return f"""{name} AS (
  SELECT 0 AS level, g, rank, hash, count(*) OVER (PARTITION BY g) AS n FROM {table}
  UNION ALL
  SELECT level + 1, g, rank // {ARITY}, sha256(string_agg(hash, '' ORDER BY rank)), (any_value(n) + {ARITY - 1}) // {ARITY}
  FROM {name} WHERE n > 1 GROUP BY level, g, rank // {ARITY})"""


def _path_sql(name: str, levels: str) -> str:
    """``(g, rank, path)`` of all leaves, where ``path`` lists (left, right) upwards."""
    return f"""{name} AS (
  SELECT a.g, a.rank, list({{'l': l, 'r': r}} ORDER BY a.level) AS path FROM (
    SELECT x.g, x.rank, y.level, y.rank AS at,
           coalesce(string_agg(s.hash, '' ORDER BY s.rank) FILTER (s.rank < y.rank), '') AS l,
           coalesce(string_agg(s.hash, '' ORDER BY s.rank) FILTER (s.rank > y.rank), '') AS r
    FROM {levels} x
    JOIN {levels} y ON y.g = x.g AND y.n > 1 AND y.rank = CAST(floor(x.rank / power({ARITY}, y.level)) AS BIGINT)
    JOIN {levels} s ON s.g = y.g AND s.level = y.level AND s.rank // {ARITY} = y.rank // {ARITY}
    WHERE x.level = 0 GROUP BY x.g, x.rank, y.level, y.rank) a
  GROUP BY a.g, a.rank)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# crc32 bit by bit: DuckDB has no such function.
_EVEN = """(SELECT xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda k: CAST(0 AS BIGINT))),
        lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 2 = 0)"""

OP13_SQL = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf_sql('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_EVEN}
              THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS tampered
  FROM documents),
leaves AS (
  SELECT *, leaf AS hash, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM docs),
{_level_sql('tree', 'leaves')},
{_path_sql('paths', 'tree')},
subroots AS (SELECT g, hash AS subroot FROM tree WHERE n = 1),
source_leaves AS (SELECT 0 AS g, g AS source_key, subroot AS hash, row_number() OVER (ORDER BY g) - 1 AS rank FROM subroots),
{_level_sql('source_tree', 'source_leaves')},
{_path_sql('source_paths', 'source_tree')},
found AS (
  SELECT l.doc_id, l.leaf, l.tampered, s.subroot, t.hash AS root,
         coalesce(p.path, []) || coalesce(sp.path, []) AS path
  FROM leaves l
  JOIN subroots s ON s.g = l.g
  JOIN source_leaves sl ON sl.source_key = l.g
  JOIN source_tree t ON t.n = 1
  LEFT JOIN paths p ON p.g = l.g AND p.rank = l.rank
  LEFT JOIN source_paths sp ON sp.rank = sl.rank),
folded AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(coalesce(list_aggregate(list_transform(path, lambda p: p.l || p.r), 'string_agg', ''), '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': tampered, 'r': ''}}, path),
                     lambda done, p: {{'l': sha256(p.l || done.l || p.r), 'r': ''}}).l AS folded_root
  FROM found)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""
