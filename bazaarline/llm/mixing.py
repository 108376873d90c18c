"""Mixing sources to target weights by drawing fixed-length blocks of words."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarline.llm.shared import WORD, slices, stored, text_or_empty

WEIGHTS = (5, 2, 1)
MASK = (1 << 64) - 1
TEXT_BYTES = 1_000_000  # of the texts cut at a time
WORDS = re.compile("[^ \t\n\x0b\x0c\r]+")


@dataclass(frozen=True)
class Mix:
    """What a mix takes: ``share`` of all words, dealt by ``weights`` to the sources in order of
    their code points, null last, and no more than ``most`` times a source's words."""

    weights: Sequence[int] = WEIGHTS
    share: Fraction = Fraction(3, 2)
    most: int = 2
    block_words: int = 128
    shard_slots: int = 1 << 15
    seed: int = 20240117


def _told(spark: SparkSession, schema: str, **columns: Sequence) -> DataFrame:
    """A small table by columns. Rows from Python would start Python workers of their own, which
    take memory beside the others for a minute."""
    return spark.createDataFrame(pa.table({name: list(values) for name, values in columns.items()}), schema)


def targets_of(sizes: Sequence[int], mix: Mix) -> list[Fraction]:
    """Target words per source: shares by weight; what a source can't give goes to the others."""
    limits = [Fraction(mix.most * size) for size in sizes]
    weights = [Fraction(mix.weights[k % len(mix.weights)]) for k in range(len(sizes))]
    targets = [Fraction(0)] * len(sizes)
    left, open_ = mix.share * sum(sizes), [k for k, size in enumerate(sizes) if size]
    while open_ and left:
        unit = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if unit * weights[k] >= limits[k]]
        if not full:
            for k in open_:
                targets[k] = unit * weights[k]
            break
        for k in full:
            targets[k] = limits[k]
            left -= limits[k]
        open_ = [k for k in open_ if k not in full]
    return targets


# --- pseudorandom permutations ---------------------------------------------------------------


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """Where a permutation of ``range(size)``, chosen by ``key``, puts each index, or with
    ``back`` the index that it puts at each place.

    Four rounds of a Feistel network over the next even number of bits; what falls outside the
    range goes through it again. Nothing is stored, so any task can permute any index. The way
    back takes the rounds in reverse.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(x: np.ndarray, turn: int) -> np.ndarray:
        return _scramble(x + np.uint64((key * 4 + turn + 1) * 0x9E3779B97F4A7C15 & MASK)) & low

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for turn in reversed(range(4)) if back else range(4):
            if back:
                left, right = right ^ mixed(left, turn), left
            else:
                left, right = right, left ^ mixed(right, turn)
        return left << shift | right

    out = once(index.astype("uint64"))
    outside = np.flatnonzero(out >= size)
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= size]
    return out.astype("int64")


def _key(mix: Mix, source: int, turn: int) -> int:
    return (mix.seed * 1_000_003 + source) * 31 + turn & MASK


@dataclass(frozen=True)
class Quota:
    """What the mix takes of one source: ``slots`` blocks, the last of them cut to ``last`` words."""

    source: int
    words: int
    blocks: int
    slots: int
    last: int


def quota_of(source: int, size: int, target: Fraction, mix: Mix) -> Quota:
    """Whole turns through all blocks, then the first blocks of one more, to the word.

    Only the last block of a source can be short, so the words of the first blocks of a turn
    follow from its place in the turn.
    """
    blocks = -(-size // mix.block_words)
    wanted = int(target)
    turns, rest = divmod(wanted, size) if size else (0, 0)
    if not rest:
        return Quota(source, size, blocks, turns * blocks, mix.block_words)
    short = mix.block_words * blocks - size
    short_at = int(permuted(np.array([blocks - 1]), blocks, _key(mix, source, turns), back=True)[0])
    slots = -(-rest // mix.block_words)
    if slots > short_at:
        slots = -(-(rest + short) // mix.block_words)
    before = (slots - 1) * mix.block_words - (short if slots - 1 > short_at else 0)
    return Quota(source, size, blocks, turns * blocks + slots, rest - before)


# --- blocks ----------------------------------------------------------------------------------


def row_hash() -> Column:
    """A hash of the row's id, source and text; rows with the same one may take each other's place."""
    return F.xxhash64("doc_id", "source", text_or_empty("text"))


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, mix_size, mix_hash``: words of the text, and the hash of the row."""
    size = F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", size.alias("mix_size"), row_hash().alias("mix_hash"))


def packed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the place of their words in the stream of their source, ``mix_start``.

    Two levels of running sums: within one of about sqrt(rows) hash buckets of a source, and
    over the buckets of a source; neither level has a group that grows with the whole table.
    """
    buckets = max(1, int(np.sqrt(rows.count())))
    numbered = rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["mix_source_name"]), "left")
    numbered = numbered.drop("mix_source_name").withColumn("mix_bucket", F.pmod("mix_hash", F.lit(buckets)))
    totals = numbered.groupBy("mix_source", "mix_bucket").agg(F.sum("mix_size").alias("mix_words"))
    before = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "mix_source", "mix_bucket", F.coalesce(F.sum("mix_words").over(before), F.lit(0)).alias("mix_offset")
    )
    within = (
        Window.partitionBy("mix_source", "mix_bucket")
        .orderBy("mix_hash", "doc_id", "mix_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        numbered.withColumn("mix_within", F.coalesce(F.sum("mix_size").over(within), F.lit(0)))
        .join(starts, ["mix_source", "mix_bucket"])
        .withColumn("mix_start", F.col("mix_offset") + F.col("mix_within"))
        .drop("mix_offset", "mix_within", "mix_bucket")
    )


def block_pieces(rows: DataFrame, mix: Mix) -> DataFrame:
    """The pieces of rows that make up each block: ``mix_source, mix_start, block, piece_from,
    piece_words``, words counted from the row's first and from the block's first."""
    start, size, length = F.col("mix_start"), F.col("mix_size"), F.lit(mix.block_words)
    first, last = F.floor(start / length), F.floor((start + size - 1) / length)
    return (
        rows.where(size > 0)
        .select("mix_source", "mix_start", "mix_size", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("begins", F.greatest(F.col("block") * length, start))
        .withColumn("ends", F.least((F.col("block") + 1) * length, start + size))
        .select(
            "mix_source",
            "mix_start",
            "block",
            (F.col("begins") - start).alias("piece_from"),
            (F.col("ends") - F.col("begins")).alias("piece_words"),
            (F.col("begins") - F.col("block") * length).alias("piece_at"),
        )
    )


# --- slots -----------------------------------------------------------------------------------


def shard_counts(rows: DataFrame, quotas: list[Quota], mix: Mix) -> DataFrame:
    """``shard, source, slots, first``: how many blocks a shard takes of each source, and from
    which place in the source's draws on. ``rows`` only gives the session.

    Each shard draws a multinomial count by itself, from its own seed. Over all shards some
    sources come out a little over their quota and others under it: draws beyond a quota are
    handed, in order of the shards, to the sources that lack some, so every quota is met.
    """
    spark = rows.sparkSession
    total = sum(q.slots for q in quotas)
    shards = -(-total // mix.shard_slots)
    shares = np.array([q.slots for q in quotas], dtype="float64") / max(total, 1)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                size = min(mix.shard_slots, total - shard * mix.shard_slots)
                counts = np.random.Generator(np.random.Philox(key=[mix.seed, shard])).multinomial(size, shares)
                k = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(k), pa.int64()), pa.array(k, pa.int32()), pa.array(counts[k], pa.int64())],
                    names=["shard", "source", "drawn"],
                )

    drawn = spark.range(shards).mapInArrow(draw, "shard bigint, source int, drawn bigint")
    drawn = stored(drawn, "mix-draws")
    quota = _told(spark, "source int, quota bigint", source=range(len(quotas)), quota=[q.slots for q in quotas])
    own = _with_sum_before(drawn, ["source"], "drawn", "first", shards).join(F.broadcast(quota), "source")
    kept = F.greatest(F.least(F.col("drawn"), F.col("quota") - F.col("first")), F.lit(0))
    own = own.withColumn("slots", kept).withColumn("over", F.col("drawn") - kept)
    # Shards and sources with draws to hand on, as intervals of one line, and the sources that
    # lack draws as intervals of the same line.
    spare = own.groupBy("shard").agg(F.sum("over").alias("over")).where("over > 0")
    lacking = drawn.groupBy("source").agg(F.sum("drawn").alias("drawn")).join(
        F.broadcast(quota), "source", "right"
    ).select("source", (F.col("quota") - F.coalesce("drawn", F.lit(0))).alias("lack"), F.coalesce("drawn", F.lit(0)).alias("next"))
    gaps, at = [], 0
    for row in sorted(lacking.where("lack > 0").collect()):
        gaps.append((row["source"], at, at + row["lack"], row["next"]))
        at += row["lack"]
    given = own.where("slots > 0").select("shard", "source", "slots", "first")
    if not gaps:
        return given
    sources, starts, ends, nexts = (np.array(x, dtype="int64") for x in zip(*gaps, strict=True))

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, last = row["begins"], row["begins"] + row["over"]
                k = np.arange(np.searchsorted(ends, first, "right"), np.searchsorted(starts, last, "left"))
                begins = np.maximum(starts[k], first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(k), pa.int64()),
                        pa.array(sources[k].astype("int32")),
                        pa.array(np.minimum(ends[k], last) - begins),
                        pa.array(nexts[k] + begins - starts[k]),
                    ],
                    names=["shard", "source", "slots", "first"],
                )

    line = _with_sum_before(spare, [], "over", "begins", shards).select("shard", "begins", "over")
    handed = line.mapInArrow(hand, "shard bigint, source int, slots bigint, first bigint")
    return given.unionByName(handed)


def _with_sum_before(rows: DataFrame, keys: list[str], value: str, name: str, shards: int) -> DataFrame:
    """``name``: ``value`` summed over the earlier shards with the same keys.

    Summed within runs of about sqrt(shards) shards, then over the runs before, so no task
    holds a row of every shard.
    """
    run = F.floor(F.col("shard") / F.lit(max(1, math.isqrt(shards)))).alias("mix_run")
    dealt = rows.select("*", run)
    sums = dealt.groupBy(*keys, "mix_run").agg(F.sum(value).alias("mix_sum"))
    runs = Window.partitionBy(*keys).orderBy("mix_run").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "mix_run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "mix_run", F.coalesce(F.sum("mix_sum").over(runs), F.lit(0)).alias("mix_before"))
    inside = dealt.withColumn("mix_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inside.join(offsets, [*keys, "mix_run"]).select(
        *rows.columns, (F.col("mix_before") + F.col("mix_inside")).alias(name)
    )


def slots(counts: DataFrame, quotas: list[Quota], mix: Mix) -> DataFrame:
    """One row per slot: ``shard, mix_source, turn, block, most``, at most ``most`` words.

    The n-th draw of a source is the block that the permutation of its turn puts there.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                quota = quotas[row["source"]]
                for start in range(0, row["slots"], 1 << 16):
                    draw = row["first"] + np.arange(start, min(start + (1 << 16), row["slots"]))
                    turn, index = np.divmod(draw, quota.blocks)
                    block = np.empty(len(draw), dtype="int64")
                    for t in np.unique(turn):
                        mine = turn == t
                        block[mine] = permuted(index[mine], quota.blocks, _key(mix, quota.source, int(t)))
                    most = np.where(draw == quota.slots - 1, quota.last, mix.block_words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(draw), row["shard"]), pa.int64()),
                            pa.array(np.full(len(draw), quota.source), pa.int32()),
                            pa.array(turn, pa.int32()),
                            pa.array(block, pa.int64()),
                            pa.array(most, pa.int64()),
                        ],
                        names=["shard", "mix_source", "turn", "block", "most"],
                    )

    return counts.mapInArrow(deal, "shard bigint, mix_source int, turn int, block bigint, most bigint")


@dataclass
class Mixed:
    """The parts of a mix: rows with their place, targets by source, and the pieces taken."""

    rows: DataFrame
    targets: DataFrame
    pieces: DataFrame


def mixed(docs: DataFrame, mix: Mix = Mix()) -> Mixed:
    """Draw a mix of the sources of ``docs`` (``doc_id, text, source``; other columns are ignored).

    The words of a source, its rows in the order of a hash, are one stream that is cut into
    blocks of fixed length; a block may hold pieces of several rows. The quota of a source is
    its target in blocks, the last block cut to the word, so taken words are the whole part of
    the target. Shards draw multinomial counts of sources; the n-th draw of a source is given a
    block by a pseudorandom permutation of its blocks, a new one for every turn, so no word is
    taken more often than ``most`` times; slots and blocks are joined by (source, block).

    Null texts have no words. A null source is a source, the last. Rows equal in these columns
    follow each other in the stream and may swap their places. Rows without words are in
    ``rows`` and in no piece. An empty table has no targets and no pieces. One row per source comes to the driver: the sources are what
    the weights are stated for.
    """
    spark = docs.sparkSession
    rows = stored(sized(docs), "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("mix_size").alias("size")).collect()
    ordered = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in ordered]
    targets = targets_of(sizes, mix)
    quotas = [quota_of(k, n, t, mix) for k, (n, t) in enumerate(zip(sizes, targets, strict=True))]
    kind = docs.schema["source"].dataType.simpleString()
    each = range(len(ordered))
    names = [r["source"] for r in ordered]
    sources = _told(spark, f"mix_source int, mix_source_name {kind}", mix_source=each, mix_source_name=names)
    told = _told(
        spark,
        "mix_source int, mix_source_size bigint, mix_target double",
        mix_source=each,
        mix_source_size=sizes,
        mix_target=[float(t) for t in targets],
    )
    placed = stored(packed(rows, sources), "mix-rows")
    drawn = slots(shard_counts(rows, quotas, mix), quotas, mix)
    pieces = block_pieces(placed, mix).join(drawn.hint("shuffle_merge"), ["mix_source", "block"])
    words = F.least(F.col("piece_words"), F.col("most") - F.col("piece_at"))
    pieces = pieces.withColumn("words", words).where("words > 0")
    return Mixed(placed, told, pieces.select("mix_source", "mix_start", "turn", "shard", "piece_from", "words"))


def taken_words(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``, see :func:`mixed`."""
    drawn = mixed(docs.select("doc_id", "source", "text"), mix)
    # A row with words is known by its source and its place there.
    sums = drawn.pieces.groupBy("mix_source", "mix_start").agg(F.sum("words").alias("taken"))
    taken = F.when(F.col("mix_size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0))
    return (
        drawn.rows.join(F.broadcast(drawn.targets), "mix_source")
        .join(sums, ["mix_source", "mix_start"], "left")
        .select(
            "doc_id",
            F.col("mix_size").alias("size"),
            F.col("mix_source_size").alias("source_size"),
            F.col("mix_target").alias("target"),
            taken.cast("long").alias("taken"),
        )
    )


def mixed_texts(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as rows with the columns of ``docs``: per row and turn, the words taken of it.

    A row taken whole keeps its text; of others the runs of words taken, as they stand in the
    text, are joined by line ends, and ``n_chars``, if there, counts the new text. Rows of
    which nothing is taken, and those without words, go.
    """
    drawn = mixed(docs, mix)
    runs = (
        drawn.pieces.groupBy("mix_source", "mix_start", "turn")
        .agg(F.sort_array(F.collect_list(F.struct("piece_from", "words"))).alias("runs"))
        .groupBy("mix_source", "mix_start")
        .agg(F.collect_list("runs").alias("turns"))
    )
    copies = Window.partitionBy("mix_hash").orderBy("mix_start")
    placed = drawn.rows.where("mix_size > 0").withColumn("copy", F.row_number().over(copies))
    placed = placed.join(runs.hint("shuffle_merge"), ["mix_source", "mix_start"]).select("mix_hash", "copy", "turns")
    whole = docs.select(F.struct("*").alias("row"), row_hash().alias("mix_hash")).withColumn(
        "copy", F.row_number().over(Window.partitionBy("mix_hash").orderBy(F.xxhash64("row")))
    )
    # The text replaces that of the row, so a worker gets it once.
    rest = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    taken = whole.join(placed.hint("shuffle_merge"), ["mix_hash", "copy"]).select(
        F.struct(*rest).alias("row"), F.explode("turns").alias("runs"), text_or_empty("row.text").alias("text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, TEXT_BYTES):
                texts = [
                    _cut(text, [(r["piece_from"], r["words"]) for r in runs])
                    for text, runs in zip(part.column(2).to_pylist(), part.column(1).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])
            pa.default_memory_pool().release_unused()

    schema = StructType([taken.schema["row"], StructField("text", StringType())])
    done = taken.mapInArrow(cut, schema)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _cut(text: str, runs: list[tuple[int, int]]) -> str:
    spans = [m.span() for m in WORDS.finditer(text)]
    joined: list[list[int]] = []
    for start, words in runs:
        if joined and joined[-1][1] == start:
            joined[-1][1] = start + words
        else:
            joined.append([start, start + words])
    if joined == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in joined)
