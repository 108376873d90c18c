"""Merkle trees over documents by nested intervals: a tree per language, one tree over their roots."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarline.llm.shared import stored

ARITY = 2
DEPTH = 4  # levels that one pass builds, in buckets of ARITY ** DEPTH nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Leaves of a tree stand in this order of its key; a null key comes before all others.
NONE, SOME = "-", "="


def digest(*parts: Column) -> Column:
    """Hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as text with its number of bytes before it; ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with ``rank`` and ``n``: the place in its tree, from 0, and the leaves of the tree.

    Rows are parted by ranges of (tree, order, place in the stored table), so a tree of any
    size is dealt over many tasks. Each notes its place in its part; the counts of the parts
    before it, one row per part and tree, are added.
    """
    spread = stored(rows, "merkle-rows").withColumn("place", F.monotonically_increasing_id())
    keys = [F.col(tree), *[F.col(name).asc_nulls_first() for name in order], F.col("place")]
    sorted_rows = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("place")
    numbered = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "merkle-ranked")
    part = F.shiftright("at", 33)
    parts = numbered.groupBy(F.col(tree).alias("tree_"), part.alias("part_")).agg(
        F.min("at").alias("first_"), F.count(F.lit(1)).alias("rows_")
    )
    whole = Window.partitionBy("tree_")
    before = whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "*",
        F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("before_"),
        F.sum("rows_").over(whole).alias("n"),
    )
    joined = numbered.withColumn("part_", part).join(parts.withColumnRenamed("tree_", tree), [tree, "part_"])
    rank = F.col("at") - F.col("first_") + F.col("before_")
    return joined.select(*[f"`{c}`" for c in rows.columns], rank.alias("rank"), "n")


@dataclass
class Grown:
    """Trees by bands of levels.

    ``bands[b]`` has a row per bucket: its members' tree, ``n``, ``bucket``, and ``nodes``, all
    nodes of the band's levels that have a parent. A node is labelled with the interval
    ``[lo, hi)`` of leaf ranks it covers and carries the siblings of its run. ``roots`` has a
    row per tree.
    """

    bands: list[DataFrame]
    roots: DataFrame
    arity: int
    depth: int


# Expressions over the nodes of a bucket are SQL text: each is one expression for the planner.


def _count(arity: int, level: int) -> str:
    """Nodes of a tree at a level."""
    return f"cast(ceil(n / {arity**level}) as bigint)"


def _parents(digests: str, arity: int) -> str:
    """Digests of runs of ``arity`` nodes; the last may be shorter."""
    run = f"array_join(slice({digests}, i, {arity}), '')"
    return f"transform(sequence(1, size({digests}), {arity}), i -> sha2({run}, 256))"


def _labelled(level: int, arity: int, depth: int, base: int) -> str:
    """Nodes of one level of a bucket, each with its interval and the interval of its parent."""
    width, above = arity ** (base + level), arity ** (base + level + 1)
    lo = f"(bucket * {arity ** (depth - level)} + i) * {width}"
    parent = f"({lo} - ({lo}) % {above})"
    return f"""transform(l{level}, (d, i) -> named_struct('level', {base + level}, 'lo', {lo},
        'hi', least({lo} + {width}, n), 'parent_lo', {parent}, 'parent_hi', least({parent} + {above}, n), 'digest', d))"""


def _with_siblings(nodes: str) -> str:
    """Each node with its siblings: the nodes in the interval of its parent less its own interval."""
    inside = "o.lo >= e.parent_lo and o.hi <= e.parent_hi and not (o.lo >= e.lo and o.hi <= e.hi)"
    siblings = f"filter(level_nodes, o -> {inside})"
    sides = f"transform({siblings}, o -> named_struct('before', o.hi <= e.lo, 'digest', o.digest))"
    complete = f"transform(level_nodes, e -> named_struct('level', e.level, 'lo', e.lo, 'hi', e.hi, 'siblings', {sides}))"
    return f"element_at(transform(array({nodes}), level_nodes -> {complete}), 1)"


NODES = "array<struct<level:int,lo:bigint,hi:bigint,siblings:array<struct<before:boolean,digest:string>>>>"


def grow(leaves: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> Grown:
    """The trees over ``leaves`` (``tree, rank, n, digest``).

    While a tree has several nodes, each run of ``arity`` of them becomes their digest; the
    last run may be shorter. A pass builds ``depth`` levels from buckets of ``arity ** depth``
    neighbours, so no task and no group grows with a tree, and the tops of the buckets are the
    members of the next pass.
    """
    members = leaves.select("tree", "n", F.col("rank").alias("index"), "digest")
    bands, roots, base = [], [], 0
    size = arity**depth
    while True:
        grouped = members.groupBy("tree", "n", F.floor(F.col("index") / size).cast("bigint").alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("index", "digest"))).alias("members")
        )
        levels = grouped.selectExpr("tree", "n", "bucket", "members.digest as l0")
        for level in range(1, depth + 1):
            above = _parents(f"l{level - 1}", arity)
            grows = f"{_count(arity, base + level - 1)} > 1"
            levels = levels.selectExpr("*", f"case when {grows} then {above} else cast(array() as array<string>) end as l{level}")
        of_level = [
            f"case when {_count(arity, base + k)} > 1 then {_with_siblings(_labelled(k, arity, depth, base))}"
            f" else cast(array() as {NODES}) end"
            for k in range(depth)
        ]
        roots_at = ", ".join(f"case when {_count(arity, base + k)} <= 1 then get(l{k}, 0) end" for k in range(depth + 1))
        levels = levels.selectExpr(
            "tree",
            "n",
            "bucket",
            f"concat({', '.join(of_level)}) as nodes",
            f"coalesce({roots_at}) as root",
            f"case when {_count(arity, base + depth)} > 1 then get(l{depth}, 0) end as top",
        )
        band = stored(levels, "merkle-band")
        bands.append(band.select("tree", "n", "bucket", "nodes"))
        roots.append(band.where("root is not null").select("tree", "n", "root"))
        members = band.where("top is not null").select("tree", "n", F.col("bucket").alias("index"), F.col("top").alias("digest"))
        base += depth
        if members.isEmpty():
            return Grown(bands, reduce(DataFrame.unionByName, roots), arity, depth)


STEPS = "array<array<struct<before:boolean,digest:string>>>"


def proofs(grown: Grown, above: DataFrame) -> list[DataFrame]:
    """For each band the steps from its members to the end: ``tree, index, steps`` and what ``above`` has.

    ``above`` has ``tree, steps`` and more, one row per tree: what follows behind its root. A
    member meets the nodes of its bucket and keeps those whose interval holds its first leaf,
    its ancestors; their siblings are its steps. The steps behind the bucket's top are those
    of the member that it is in the band above.
    """
    rest = [c for c in above.columns if c not in ("tree", "steps")]
    found: list[DataFrame] = []
    for band in reversed(range(len(grown.bands))):
        base = grown.arity ** (grown.depth * band)
        size = grown.arity**grown.depth
        buckets = grown.bands[band]
        ends = F.expr(f"{_count(grown.arity, grown.depth * (band + 1))} <= 1")
        # A tree that ends in this band has one bucket here, so the join with the tree is small.
        last = buckets.where(ends).join(above, "tree")
        parts = [last.select("tree", "bucket", "n", "nodes", "steps", *rest)]
        if found:
            tops = found[-1].withColumnRenamed("index", "bucket")
            parts.append(buckets.where(~ends).join(tops, ["tree", "bucket"]).select("tree", "bucket", "n", "nodes", "steps", *rest))
        whole = reduce(DataFrame.unionByName, parts)
        if band:
            # Members above the leaves are the bucket's own: its lowest level.
            first = F.col("bucket") * size
            upto = F.least(first + size, F.expr(_count(grown.arity, grown.depth * band))) - 1
            members = whole.select("*", F.explode(F.sequence(first, upto)).alias("index"))
            steps = F.expr(f"concat({_steps(f'index * {base}')}, steps)")
            found.append(stored(members.select("tree", "index", steps.alias("steps"), *rest), "merkle-steps"))
        else:
            found.append(whole)
    return found


def _steps(rank: str) -> str:
    """The siblings of the nodes whose interval holds the rank, from the lowest level on."""
    return f"transform(filter(nodes, e -> e.lo <= {rank} and {rank} < e.hi), e -> e.siblings)"


def attached(leaves: DataFrame, grown: Grown, above: DataFrame) -> DataFrame:
    """``leaves`` with their ``steps`` to the end and the other columns of ``above``."""
    size = grown.arity**grown.depth
    buckets = proofs(grown, above)[-1].drop("n").withColumnRenamed("steps", "after_")
    keyed = leaves.withColumn("bucket", F.floor(F.col("rank") / size).cast("bigint"))
    joined = keyed.join(buckets, ["tree", "bucket"])
    return joined.withColumn("steps", F.expr(f"concat({_steps('rank')}, after_)")).drop("nodes", "after_", "bucket")


def folded(leaf: str, steps: str) -> Column:
    """The root that a leaf and its siblings give."""
    left = "array_join(transform(filter(run, s -> s.before), s -> s.digest), '')"
    right = "array_join(transform(filter(run, s -> not s.before), s -> s.digest), '')"
    return F.expr(f"aggregate({steps}, {leaf}, (node, run) -> sha2(concat({left}, node, {right}), 256))")


def proof_text(steps: str) -> Column:
    """All siblings, level by level and from left to right, as one text."""
    return F.expr(f"array_join(transform(flatten({steps}), s -> s.digest), '')")


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """A row per document: ``doc_id, lang, rank, leaf, steps, subroot, root, proof_sha256, folded_root, verified``.

    Leaves of a language stand in the order of ``doc_id``, null first, and of the leaf where
    ids are equal; rows equal in all five columns are leaves of their own. Trees stand in the
    bytewise order of their language, null first. ``steps`` holds, level by level, the
    siblings in the run, and whether each stands before. ``tampered`` tells for which rows
    the fold starts from a leaf with one more in ``n_chars`` (null stays null); null is false.
    Null and empty texts, sources and languages differ. An empty table gives an empty
    manifest. Other columns of ``docs`` are ignored.

    Nothing grows with a language, a bucket or a tree in one task: ranks come from range
    partitions, nodes from buckets of ``arity ** depth`` neighbours, and proofs are passed
    down from band to band by joins on (tree, bucket).
    """
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.concat(F.lit(SOME), F.col("lang")), F.lit(NONE)).alias("tree"),
        leaf_of().alias("digest"),
        F.when(changed, leaf_of(n_chars=F.col("n_chars") + 1)).alias("other"),
    )
    leaves = ranked(rows, "tree", "doc_id", "digest")
    trees = grow(leaves, arity, depth)
    tops = ranked(trees.roots.select(F.lit("").alias("all"), "tree", F.col("root").alias("subroot")), "all", "tree")
    top_leaves = stored(tops.select(F.col("all").alias("tree"), "rank", "n", F.col("subroot").alias("digest"), F.col("tree").alias("of")), "merkle-tops")
    whole = grow(top_leaves, arity, depth)
    end = whole.roots.select("tree", F.array().cast(STEPS).alias("steps"), F.col("root"))
    above = attached(top_leaves, whole, end).select(
        F.col("of").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"
    )
    proven = attached(leaves, trees, stored(above, "merkle-above"))
    proven = proven.withColumn("folded_root", folded("coalesce(other, digest)", "steps"))
    return proven.select(
        "doc_id",
        F.when(F.col("tree") != NONE, F.substr("tree", F.lit(2))).alias("lang"),
        "rank",
        F.col("digest").alias("leaf"),
        "steps",
        "subroot",
        "root",
        F.sha2(proof_text("steps"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
