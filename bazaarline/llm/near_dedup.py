"""Near-duplicate texts by consistent weighted samples of their shingles, verified and linked."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarline.llm.shared import batches_of, slices, stored, text_or_empty

# Of texts that a worker sketches at a time, and of a batch that it is handed: what it allocates
# for the largest of them it keeps, beside the executor's heap.
TEXT_BYTES = 1_000_000
BATCH_BYTES = 4_000_000
CHUNK = 1 << 15  # shingles sampled at a time
# Document frequencies are kept in this many hashed counters, at every size of the corpus, so a
# shingle rarer than about one text in a thousand counts as just that rare.
COUNTERS = 1 << 20
SLICES = 16
BROADCAST_ROWS = 500_000
# Comparisons of a bucket that are made as rows; larger ones are made by blocks of members.
SMALL = 256
WAITING_BLOCK, MEMBER_BLOCK = 256, 1024
SIGMAS = 3.5
ROUNDING = 1e-9


@dataclass(frozen=True)
class Near:
    """``bands`` of ``rows`` samples each: two texts whose weighted similarity is s share a band
    with a probability of 1 - (1 - s ** rows) ** bands. Texts are linked by a weighted or an
    unweighted similarity of at least ``similarity``."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 18
    rows: int = 3

    @property
    def least_weighted(self) -> float:
        """The least weighted similarity of texts whose unweighted one is ``similarity``: weights lie
        between 1, of all common shingles then, and 2, of all others."""
        return self.similarity / (2 - self.similarity)


# --- shingles ---------------------------------------------------------------------------------


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Shingles:
    """Different shingles of some texts, sorted by text and hash, and what the texts are."""

    starts: np.ndarray  # of each text with words, in the arrays below
    hashes: np.ndarray
    counts: np.ndarray
    texts: np.ndarray  # numbers of the texts with words
    nodes: list[bytes]  # of all texts: a digest of the words in order


def shingles_of(texts: pa.Array, size: int) -> Shingles:
    """Words are parted by white space and lower-cased; a shorter text is one shingle."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.utf8_lower(texts)))
    numbered = words.flatten().dictionary_encode()
    unique = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in numbered.dictionary.to_pylist()]
    flat = np.array(unique, dtype="uint64")[numbered.indices.to_numpy()]
    offsets = np.asarray(words.offsets) - words.offsets[0].as_py()
    blank = xxhash.xxh64_intdigest(b"")
    lengths = np.diff(offsets)
    lengths[(lengths == 1) & (flat[offsets[:-1].clip(max=max(len(flat) - 1, 0))] == np.uint64(blank))] = 0
    raw = flat.tobytes()
    nodes = [
        blake2b(raw[8 * a : 8 * (a + n)], digest_size=16).digest()
        for a, n in zip(offsets[:-1].tolist(), lengths.tolist(), strict=True)
    ]
    n = max(len(flat) - size + 1, 0)
    rolled = np.zeros(n, dtype="uint64")
    for k in range(size):
        rolled = _scramble(rolled ^ flat[k : k + n])
    owner = np.repeat(np.arange(len(lengths)), np.diff(offsets))[:n]
    whole = np.arange(n) + size <= offsets[owner + 1] if n else np.zeros(0, dtype=bool)
    keys = owner[whole].astype("uint64") << np.uint64(32) | rolled[whole] >> np.uint64(32)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        extra = [xxhash.xxh64_intdigest(nodes[k]) >> 32 | int(k) << 32 for k in short]
        keys = np.concatenate([keys, np.array(extra, dtype="uint64")])
    keys, counts = np.unique(keys, return_counts=True)
    owners = (keys >> np.uint64(32)).astype("int64")
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    return Shingles(starts, (keys & np.uint64(0xFFFFFFFF)).astype("uint32"), counts, owners[starts], nodes)


# --- document frequencies ---------------------------------------------------------------------


def inverse_frequencies(texts: DataFrame, near: Near) -> np.ndarray:
    """Weight of each counter over all texts: 1 plus ``ln((1 + texts) / (1 + texts with it))`` as a
    share of its largest value, so between 1 and 2.

    A rare shingle weighs twice as much as one that all texts have and no more: were it more,
    a group of near-copies would lose its likeness by its own size.

    A task counts into one table of fixed size and hands on its slices; each slice is summed as
    a stream. The driver gets the sums, a table of the same fixed size.
    """
    width = COUNTERS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts_seen = np.zeros(COUNTERS, dtype="int64"), 0
        for batch in batches:
            for part in slices(batch, 0, TEXT_BYTES):
                found = shingles_of(part.column(0), near.shingle)
                total += np.bincount(found.hashes & np.uint32(COUNTERS - 1), minlength=COUNTERS)
                texts_seen += len(found.texts)
        if texts_seen:
            packed = [zlib.compress(total[k * width : (k + 1) * width].tobytes(), 1) for k in range(SLICES)]
            seen = [texts_seen] + [0] * (SLICES - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary()), pa.array(seen, pa.int64())],
                names=["slice", "counts", "texts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        seen = 0
        for batch in batches:
            for k, packed, texts_seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(packed), "int64")
                seen += texts_seen
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()), pa.array([seen], pa.int64())],
                names=["slice", "counts", "texts"],
            )
            seen = 0

    schema = "slice int, counts binary, texts bigint"
    sums = texts.select("text").mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect()
    frequency = np.zeros(COUNTERS)
    for row in sums:
        frequency[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), "int64")
    n = sum(row["texts"] for row in sums)
    inverse = np.log((1 + n) / (1 + np.minimum(frequency, n)))
    return 1 + inverse / max(float(inverse.max()), 1e-9)


# --- samples ----------------------------------------------------------------------------------


@cache
def _gamma() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the Gamma(2, 1) distribution by 16 bits, their inverses and logarithms."""
    wanted = (np.arange(1 << 16) + 0.5) / (1 << 16)
    value = np.empty(1 << 16)
    # Piece by piece: a worker keeps the memory of a table of all places.
    first, done, piece = 0, 0, 1 << 16
    while done < len(wanted):
        x = np.arange(first, first + piece + 1) * 1e-5
        u = 1 - (1 + x) * np.exp(-x)
        last = int(np.searchsorted(wanted, u[-1]))
        value[done:last] = np.interp(wanted[done:last], u, x)
        first, done = first + piece, last
    return value.astype("float32"), (1 / value).astype("float32"), np.log(value).astype("float32")


def samples(found: Shingles, weights: np.ndarray, number: int) -> np.ndarray:
    """One row per text with words: ``number`` consistent weighted samples as 64-bit hashes.

    For a shingle of weight w and a sample's own r, c ~ Gamma(2, 1) and b ~ U(0, 1), all from
    the shingle's hash: t = floor(ln w / r + b), ln a = ln c - r (t - b) - r; the sample is the
    shingle with the least a, and its t. Two texts have equal samples with the probability of
    their weighted similarity.
    """
    value, inverse, log = _gamma()
    out = np.empty((len(found.texts), number), dtype="uint64")
    ends = np.append(found.starts[1:], len(found.hashes))
    first = 0
    while first < len(found.texts):
        last = int(np.searchsorted(ends, found.starts[first] + CHUNK, "right"))
        last = max(last, first + 1)
        a, b = int(found.starts[first]), int(ends[last - 1])
        hashes = found.hashes[a:b].astype("uint64")
        ln = np.log(weights[a:b]).astype("float32")
        starts = found.starts[first:last] - a
        lengths = np.diff(np.append(starts, b - a))
        for k in range(number):
            bits = _scramble(hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            own = (bits & np.uint64(0xFFFF)).astype("uint16")
            r = value[own]
            shift = ((bits >> np.uint64(32)) & np.uint64(0xFFFF)).astype("float32") / np.float32(65536)
            t = np.floor(ln * inverse[own] + shift)
            lna = log[((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype("uint16")] - r * (t - shift + np.float32(1))
            least = np.minimum.reduceat(lna, starts)
            hits = np.flatnonzero(lna == np.repeat(least, lengths))
            at = hits[np.searchsorted(hits, starts)]
            out[first:last, k] = _scramble(hashes[at] ^ (t[at].astype("int64").astype("uint64") << np.uint64(32)))
        first = last
    return out


def pack_vector(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Different shingles and, unless all are 1, how often each occurs."""
    return hashes.tobytes() if counts.max(initial=1) == 1 else hashes.tobytes() + counts.astype("uint32").tobytes() + b"\0"


def unpack_vector(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(packed) % 4:
        both = np.frombuffer(packed[:-1], "uint32")
        return both[: len(both) // 2], both[len(both) // 2 :]
    hashes = np.frombuffer(packed, "uint32")
    return hashes, np.ones(len(hashes), dtype="uint32")


def similarity(left: bytes, right: bytes, idf: np.ndarray) -> float:
    """The larger of the weighted and the unweighted Jaccard similarity of two vectors."""
    (a, n), (b, m) = unpack_vector(left), unpack_vector(right)
    common, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    least = float((np.minimum(n[at], m[to]) * idf[common & np.uint32(COUNTERS - 1)]).sum())
    most = float((n * idf[a & np.uint32(COUNTERS - 1)]).sum() + (m * idf[b & np.uint32(COUNTERS - 1)]).sum()) - least
    shared = float(np.minimum(n[at], m[to]).sum())
    union = float(n.sum() + m.sum()) - shared
    return max(least / most, shared / union) if most else 1.0


def sketched(docs: DataFrame, near: Near) -> tuple[DataFrame, object]:
    """``doc_id, tag, node, vector, sketch, b0, b1, ...`` of every row, stored, and the weights."""
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    idf = inverse_frequencies(texts, near)
    weights = docs.sparkSession.sparkContext.broadcast(idf)
    names = ["doc_id", "tag", "node", "vector", "sketch", *(f"b{k}" for k in range(near.bands))]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, TEXT_BYTES):
                found = shingles_of(part.column(2), near.shingle)
                own = found.counts * weights.value[found.hashes & np.uint32(COUNTERS - 1)]
                drawn = samples(found, own, near.bands * near.rows)
                # Texts without words have one band value that no other text has by chance.
                bands = np.full((len(part), near.bands), 1, dtype="uint64")
                mixed = np.zeros((len(found.texts), near.bands), dtype="uint64")
                for k in range(near.rows):
                    mixed = _scramble(mixed ^ drawn[:, k :: near.rows])
                bands[found.texts] = mixed
                vectors, sketches = [b""] * len(part), [b"\0" * (2 * near.bands * near.rows)] * len(part)
                short = drawn.astype("uint16")
                ends = np.append(found.starts[1:], len(found.hashes))
                for k, (text, a, b) in enumerate(zip(found.texts.tolist(), found.starts.tolist(), ends.tolist(), strict=True)):
                    vectors[text] = pack_vector(found.hashes[a:b], found.counts[a:b])
                    sketches[text] = short[k].tobytes()
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array(found.nodes, pa.binary()),
                    pa.array(vectors, pa.binary()),
                    pa.array(sketches, pa.binary()),
                    *(pa.array(bands[:, k].astype("int64")) for k in range(near.bands)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, tag bigint, node binary, vector binary, sketch binary, " + ", ".join(f"b{k} bigint" for k in range(near.bands))
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    return stored(rows.mapInArrow(sketch, schema), "sketches"), weights


# --- links ------------------------------------------------------------------------------------


def small_or_merged(df: DataFrame) -> DataFrame:
    """Broadcast a stored table of a checked number of rows, else have it joined by a merge."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("shuffle_merge")


def verified(pairs: DataFrame, vectors: DataFrame, weights) -> DataFrame:
    """``a, b, similarity`` of pairs of nodes, stored."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            told = [similarity(x.as_py(), y.as_py(), weights.value) for x, y in both]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(told, pa.float64())], names=["a", "b", "similarity"]
            )

    own = vectors.hint("shuffle_merge")
    both = (
        pairs.join(own.withColumnsRenamed({"node": "a", "vector": "va"}), "a")
        .join(own.withColumnsRenamed({"node": "b", "vector": "vb"}), "b")
        .select("a", "b", "va", "vb")
    )
    return stored(both.mapInArrow(compare, "a binary, b binary, similarity double"), "similarities")


def linked(nodes: DataFrame, details_of, weights, near: Near) -> DataFrame:
    """``node, root`` of the nodes that are linked to others: their components.

    Nodes that share a band value meet in its bucket. First every bucket's members are compared
    with one of them, that which meets most others, and the links make components. Then all
    pairs of a bucket that are still in different components are compared, but for those inside
    its largest one, which are connected: in small buckets as rows, in large ones block by
    block inside tasks, where only links come out. So copies of each other cost one comparison
    each, and any two members of a bucket end up compared or connected.
    """
    bands = F.array(*[F.xxhash64(F.lit(k), f"b{k}") for k in range(near.bands)])
    exploded = nodes.select("node", F.posexplode(bands).alias("band", "bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(exploded.join(shared.hint("shuffle_merge"), "bucket").select("bucket", "band", "node", "n"), "buckets")
    details = details_of(members)
    vectors = details.select("node", "vector")

    meets = members.groupBy("node").agg(F.sum("n").alias("meets"))
    ranked = members.join(meets.hint("shuffle_merge"), "node").select("bucket", "node", "meets")
    center = ranked.groupBy("bucket").agg(F.max(F.struct("meets", "node"))["node"].alias("center"))
    pairs = (
        ranked.join(center.hint("shuffle_merge"), "bucket")
        .where("node != center")
        .select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))
        .distinct()
    )
    first = verified(pairs, vectors, weights)
    # No rows from Python: workers that make them would stay beside those of the other steps.
    none = members.select("node", F.col("node").alias("root")).where(F.lit(False))
    roots = _joined(none, _links(first, near))

    now = members.join(roots.hint("shuffle_merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = now.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("all"), F.count("*").alias("roots")
    )
    largest = largest.where("roots > 1").select(
        "bucket", F.col("largest.root").alias("main"), F.col("all") - F.col("largest.n") > F.lit(SMALL) / F.col("all")
    ).toDF("bucket", "main", "large")
    now = now.drop("n").join(largest.hint("shuffle_merge"), "bucket").withColumn("waits", F.col("root") != F.col("main"))
    now = stored(now.select("bucket", "band", "node", "root", "waits", "large"), "rooted")

    small = now.where("not large")
    waiting = small.where("waits").select("bucket", F.col("node").alias("other"), F.col("root").alias("other_root"))
    pairs = (
        small.join(waiting.hint("shuffle_merge"), "bucket")
        .where("root != other_root")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
        .join(first.select("a", "b").hint("shuffle_merge"), ["a", "b"], "left_anti")
    )
    rest = _links(verified(pairs, vectors, weights), near)
    found = stored(_links_by_blocks(now.where("large"), details, weights, near), "block-links")
    return _joined(roots, rest.unionByName(found))


def _links(told: DataFrame, near: Near) -> DataFrame:
    return told.where(F.col("similarity") >= near.similarity - ROUNDING).select("a", "b")


def _links_by_blocks(now: DataFrame, details: DataFrame, weights, near: Near) -> DataFrame:
    """``a, b``: links between different components in large buckets.

    The waiting members of a bucket are cut into blocks, all its members into others, and each
    two blocks meet in one task. There a pair is compared in the first band it shares, if its
    samples agree often enough for it to be likely at all: the number that agree has a
    binomial distribution, and the limit is ``SIGMAS`` deviations below its mean at the
    least weighted similarity that a pair with the similarity asked for can have.
    """
    number = near.bands * near.rows
    share = near.least_weighted
    mean, deviation = share * number, (share * (1 - share) * number) ** 0.5
    agreeing = int(mean - SIGMAS * deviation)
    full = now.join(details.hint("shuffle_merge"), "node")
    # An int on both sides: keys of a cogroup are dealt by their type, too.
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    counts = now.groupBy("bucket").agg(F.count_if("waits").alias("w"), F.count("*").alias("m")).select(
        "bucket",
        F.ceil(F.col("w") / WAITING_BLOCK).cast("int").alias("w"),
        F.ceil(F.col("m") / MEMBER_BLOCK).cast("int").alias("m"),
    )
    full = full.join(counts.hint("shuffle_merge"), "bucket")
    columns = ["bucket", "wb", "mb", "band", "node", "root", "bands", "sketch", "vector"]
    left = full.where("waits").withColumn("wb", place % F.col("w")).withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    right = full.withColumn("mb", place % F.col("m")).withColumn("wb", F.explode(F.sequence(F.lit(0), F.col("w") - 1)))
    keys = ["bucket", "wb", "mb"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        links: list[tuple[bytes, bytes]] = []
        if len(left) and len(right):
            band = left["band"][0].as_py()
            lefts, rights = ({c: t[c].to_pylist() for c in ("node", "root")} for t in (left, right))
            lb, rb = (np.array(t["bands"].to_pylist(), dtype="int64") for t in (left, right))
            ls, rs = (np.frombuffer(b"".join(t["sketch"].to_pylist()), "uint16").reshape(len(t), -1) for t in (left, right))
            agree = np.zeros((len(left), len(right)), dtype="uint16")
            for k in range(ls.shape[1]):
                agree += ls[:, k, None] == rs[None, :, k]
            wanted = agree >= agreeing
            for k in range(band):
                wanted &= lb[:, k, None] != rb[None, :, k]
            joined: dict[bytes, bytes] = {}

            def top(root: bytes) -> bytes:
                while (up := joined.get(root, root)) != root:
                    root = up
                return root

            for i, j in zip(*(x.tolist() for x in np.nonzero(wanted)), strict=True):
                a, b = top(lefts["root"][i]), top(rights["root"][j])
                if a == b:
                    continue
                told = similarity(left["vector"][i].as_py(), right["vector"][j].as_py(), weights.value)
                if told >= near.similarity - ROUNDING:
                    joined[max(a, b)] = min(a, b)
                    links.append((lefts["node"][i], rights["node"][j]))
        return pa.table([pa.array([x[k] for x in links], pa.binary()) for k in range(2)], names=["a", "b"])

    # New names for the columns of one side, as both come from one table.
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in columns]).toDF(*columns)
    return left.select(*columns).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a binary, b binary")


def _joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The components after some more links."""
    old = roots.hint("shuffle_merge")
    between = (
        edges.join(old.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        .join(old.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        .where("a != b")
    )
    tops = components(between)
    # Old members move with their root, roots of old components and single nodes by themselves.
    higher = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(higher.hint("shuffle_merge"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(moved.unionByName(tops).distinct(), "roots")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` with the least node of each component, for nodes with edges.

    Large and small stars in turn: every node hands its larger neighbours, then its smaller
    ones, to the least it knows. The least is a grouped minimum joined back, so no task gathers
    the neighbours of a node.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("shuffle_merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("shuffle_merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none itself."""
    if not edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return False
    upper = edges.select(F.col("u").alias("v")).distinct()
    return edges.join(upper.hint("shuffle_merge"), "v", "left_semi").isEmpty()


@dataclass
class Classes:
    """``doc_id, tag, class_id, class_rows, class_tag`` for each row: the least id of the class,
    its rows, and the text hash of the row that stands for the class."""

    rows: DataFrame


def _least(column: str) -> Column:
    """The smallest (id, text hash), rows without an id last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tag")).alias(column)


def classes(docs: DataFrame, near: Near = Near()) -> Classes:
    """Classes of texts that are linked by a weighted or an unweighted similarity of at least ``near.similarity``.

    Texts are sets of word shingles with weights tf times idf, see :func:`shingles_of` and
    :func:`inverse_frequencies`. Texts with the same words in order are one node, whatever
    their case and white space. Nodes that share a band of samples are candidates, see
    :func:`linked`; classes are the connected components of the links. ``class_id`` is the least
    ``doc_id`` of the class; rows without an id do not give one unless all have none.

    A row for each row of ``docs``. Null texts are empty; all texts without words are one
    class. Columns other than ``doc_id`` and ``text`` are ignored. An empty table gives an
    empty table.
    """
    with batches_of(docs.sparkSession, BATCH_BYTES):
        rows, weights = sketched(docs, near)
    bands = [f"b{k}" for k in range(near.bands)]
    nodes = stored(
        rows.groupBy("node").agg(*[F.min(b).alias(b) for b in bands], _least("least"), F.count("*").alias("n")), "nodes"
    )

    def details_of(members: DataFrame) -> DataFrame:
        """What equal nodes have in common: the band values, the samples and the vector."""
        wanted = stored(members.select("node").distinct(), "wanted")
        found = rows.select("node", F.struct(F.array(*bands).alias("bands"), "sketch", "vector").alias("d"))
        found = found.join(small_or_merged(wanted), "node", "left_semi")
        return stored(found.groupBy("node").agg(F.first("d").alias("d")).select("node", "d.*"), "details")

    with batches_of(docs.sparkSession, BATCH_BYTES):
        roots = linked(nodes.select("node", *bands), details_of, weights, near)
    rooted = nodes.select("node", "least", "n").join(roots.hint("shuffle_merge"), "node", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    whole = rooted.groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("class_rows"))
    named = stored(
        rooted.select("node", "root").join(whole.hint("shuffle_merge"), "root").select(
            "node", F.col("least.doc_id").alias("class_id"), F.col("least.tag").alias("class_tag"), "class_rows"
        ),
        "classes",
    )
    return Classes(
        rows.select("doc_id", "tag", "node")
        .join(named.hint("shuffle_merge"), "node")
        .select("doc_id", "tag", "class_id", "class_tag", "class_rows")
    )


def one_of_each(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row of each class with all its columns: that with the least id, of equal ids the one
    with the least text hash; of rows equal in id and text any one."""
    told = stored(classes(docs, near).rows, "classed")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tag") == F.col("class_tag"))
    gone = stored(told.where(~stays).select("doc_id", "tag").distinct(), "gone")
    again = stored(told.where(stays).groupBy("doc_id", "tag").count().where("count > 1").drop("count"), "again")
    names = docs.columns
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(text_or_empty("text")).alias("tag"))

    def of(keys: DataFrame, how: str) -> DataFrame:
        other = small_or_merged(keys.select(F.col("doc_id").alias("key_id"), F.col("tag").alias("key_tag")))
        return keyed.join(other, F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("tag") == F.col("key_tag")), how)

    if again.isEmpty():
        kept = of(gone, "left_anti")
    else:
        kept = of(stored(gone.unionByName(again), "gone"), "left_anti").unionByName(
            of(again, "left_semi").dropDuplicates(["doc_id", "tag"])
        )
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
