"""Benchmark items in documents, also with other numbers, names and units; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import stored, text_or_empty

NAME = "\u0001"  # stands before a name
JOIN = "\u0002"  # stands for a mark inside a number
CHUNK = 4096  # tokens of a text that are one row
EDGE = ""  # no token: parts the tokens as they are from the typed ones
# Rows that may be broadcast; larger tables are joined by a shuffle.
BROADCAST_WINDOWS = 500_000
BROADCAST_DOCS = 500_000

# Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml cl l gal s sec min h hr hrs ms day days week weeks month months year "
    "years hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles foot "
    "feet inch inches gram grams kilogram kilograms liter liters litre litres degree degrees percent dollar dollars "
    "euro euros cent cents pound pounds usd eur gbp hz khz mhz ghz kb mb gb tb w kw kwh v a mph kmh"
).split()


@dataclass(frozen=True)
class Leaks:
    """``window`` tokens are compared at a time, ``literals`` of them no placeholders. A document
    has an item if windows cover ``coverage`` of the item's tokens or ``tokens`` of them.

    A window that more than ``shared`` items have is common. The tokens of an item in no common
    window are its own: of these, too, windows must cover ``coverage`` or ``tokens``. Of an item
    without own tokens they must cover ``whole``."""

    window: int = 6
    literals: int = 3
    coverage: float = 0.5
    tokens: int = 30
    shared: int = 8
    whole: float = 0.9


def marked(text: Column) -> Column:
    """The text with ``NAME`` before names and ``JOIN`` for marks between digits, letters after
    digits apart. A name is a word with a capital that follows another word on its line
    without a full stop between them. The capital is looked for first: few places have one."""
    text = F.when(
        text.rlike("[0-9]"),
        F.regexp_replace(
            F.regexp_replace(text, "(?<=[0-9])[.,:/](?=[0-9])", JOIN), "(?<=[0-9])(?=\\p{L})", " "
        ),
    ).otherwise(text)
    return F.regexp_replace(text, "(?=\\p{Lu})(?<=[\\p{L}\\p{N},;][ \\t])", NAME)


def tokens_of(told: Column) -> Column:
    """Words of a marked text in lower case and without punctuation."""
    return F.array_remove(F.split(F.lower(told), f"[^a-z\\p{{L}}\\p{{M}}\\p{{N}}{NAME}{JOIN}]+"), "")


def has_slots(told: Column) -> Column:
    return told.rlike(f"[0-9{NAME}]")


def _is_number(token: Column) -> Column:
    return token.substr(1, 1).between("0", "9")


def _kind(tokens: Column, token: Column, k: Column) -> Column:
    """The type of a token, null for a literal. A token right after a number may be a unit."""
    unit = token.isin(UNITS) & (k > 0) & _is_number(F.get(tokens, k - 1))
    return (
        F.when(_is_number(token), F.lit("#number"))
        .when(F.startswith(token, F.lit(NAME)), F.lit("#name"))
        .when(unit, F.lit("#unit"))
    )


def forms_of(tokens: Column, slotted: Column) -> Column:
    """Each token, or its type. A text without numbers and names has literals only."""
    return F.when(slotted, F.transform(tokens, lambda t, k: F.coalesce(_kind(tokens, t, k), t))).otherwise(tokens)


def slots_of(tokens: Column, slotted: Column) -> Column:
    """A hash of the value behind each type, null for literals; null for a text without any."""
    return F.when(slotted, F.transform(tokens, lambda t, k: F.when(_kind(tokens, t, k).isNotNull(), F.xxhash64(t))))


def words_of(tokens: Column, slotted: Column) -> Column:
    """Each token as it is, names like other words. A text without numbers and names has no marks."""
    return F.when(slotted, F.transform(tokens, lambda t: F.translate(t, NAME, ""))).otherwise(tokens)


def window_hash(tokens: Column, k: Column, size: int) -> Column:
    """A hash of ``size`` tokens from the place ``k`` on, null where fewer are left.

    Of single elements and without a lambda: Spark compiles it with the rows of the places.
    """
    parts = [F.get(tokens, k + i) for i in range(size)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def _chunks(texts: DataFrame, keys: list[str], size: int, least: int | None = None) -> DataFrame:
    """Rows ``keys, slotted, start, lead, tokens``: a text is cut into overlapping chunks, so a row
    has a bounded number of windows of ``least`` to ``size`` tokens. A later chunk has the token
    before it, by which a first unit is known."""
    last = F.size("tokens") - (least or size)
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(CHUNK)),
        lambda start: F.struct(start.alias("start"), F.slice("tokens", F.greatest(start, F.lit(1)), CHUNK + size).alias("tokens")),
    )
    chunks = F.when(last < CHUNK, F.array(F.struct(F.lit(0).alias("start"), F.col("tokens").alias("tokens")))).otherwise(cut)
    return (
        texts.select(*keys, marked(text_or_empty("text")).alias("told"))
        .select(*keys, tokens_of(F.col("told")).alias("tokens"), has_slots(F.col("told")).alias("slotted"))
        .select(*keys, "slotted", F.explode(chunks).alias("chunk"))
        .select(
            *keys, "slotted", "chunk.start", "chunk.tokens",
            F.when(F.col("chunk.start") > 0, F.lit(1)).otherwise(F.lit(0)).alias("lead"),
        )
    )


def some_windows(texts: DataFrame, keys: list[str], sizes: list[int], typed: int) -> DataFrame:
    """Rows ``keys, hash`` for the windows of all sizes as they are and, of texts with numbers or
    names, those of the size ``typed`` with types, too. Texts are cut into tokens once.

    Both kinds of tokens are one array with ``EDGE`` between them; windows over it are equal to none
    of an item. Windows of other sizes than ``typed`` over types are looked for in vain.
    """
    tokens, slotted = F.col("tokens"), F.col("slotted")
    words = words_of(tokens, slotted)
    if typed in sizes:
        # The first token of a later chunk may be a unit whose number is not seen.
        forms = F.slice(forms_of(tokens, slotted), F.col("lead") + 1, CHUNK + max(sizes))
        words = F.when(slotted, F.concat(words, F.array(F.lit(EDGE)), forms)).otherwise(tokens)
    places = (
        _chunks(texts, keys, max(sizes), min(sizes))
        .select(*keys, words.alias("words"))
        # Outer: else Spark makes the words a second time to leave out texts without any.
        .select(*keys, "words", F.posexplode_outer("words").alias("k", "word"))
    )
    hashes = [window_hash(F.col("words"), F.col("k"), size) for size in sizes]
    return places.select(*keys, (F.explode(F.array(*hashes)) if len(hashes) > 1 else hashes[0]).alias("hash"))


def windows(texts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows ``keys, at, hash, plain, slots`` for every window of ``size`` tokens of the column ``text``.

    ``hash`` is of the typed tokens, ``plain`` of the tokens as they are; both are equal in
    windows without slots. ``slots`` is null for texts without numbers and names.
    """
    tokens, slotted = F.col("tokens"), F.col("slotted")
    own = F.col("k") - F.col("lead")
    slots = F.array(*[F.get(F.col("slots"), F.col("k") + i) for i in range(size)])
    return (
        _chunks(texts, keys, size)
        .select(
            *keys, "start", "lead", forms_of(tokens, slotted).alias("forms"), words_of(tokens, slotted).alias("as_is"),
            slots_of(tokens, slotted).alias("slots"),
        )
        .select("*", F.posexplode_outer("as_is").alias("k", "token"))
        .where((own >= 0) & (own < CHUNK) & (F.col("k") <= F.size("as_is") - size))
        .select(
            *keys, (F.col("start") + own).alias("at"), window_hash(F.col("forms"), F.col("k"), size).alias("hash"),
            window_hash(F.col("as_is"), F.col("k"), size).alias("plain"), F.when(F.col("slots").isNotNull(), slots).alias("slots"),
        )
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, text, item_tokens, shape, words`` of the items with tokens.

    The shape tells the forms and which slots have equal values, so texts that fill one item's
    slots one to one do so for all items of its shape. ``words`` tells the tokens as they are.
    """
    texts = benchmark.where("text is not null").select("item_id", "text", marked(F.col("text")).alias("told"))
    cut = texts.select("item_id", "text", tokens_of(F.col("told")).alias("tokens"), has_slots(F.col("told")).alias("slotted"))
    formed = cut.select(
        "item_id", "text",
        forms_of(F.col("tokens"), F.col("slotted")).alias("forms"),
        slots_of(F.col("tokens"), F.col("slotted")).alias("slots"),
        F.xxhash64(words_of(F.col("tokens"), F.col("slotted"))).alias("words"),
    )
    firsts = F.transform("slots", lambda s: F.array_position("slots", s))
    return formed.select(
        "item_id", "text", F.size("forms").alias("item_tokens"), F.xxhash64("forms", firsts).alias("shape"), "words"
    ).where("item_tokens > 0")


def _least_id(*more: str) -> Column:
    """The row of a group with the least id, a null one last."""
    return F.min(F.struct(F.col("item_id").isNull().alias("unknown"), "item_id", *more))


def item_groups(benchmark: DataFrame) -> DataFrame:
    """``item_id, same_item, group_item``: every item, the least id of those with its words and
    the least id of those of its shape."""
    items = _items(benchmark).select("item_id", "shape", "words")
    same = items.groupBy("shape", "words").agg(_least_id()["item_id"].alias("same_item"))
    groups = items.groupBy("shape").agg(_least_id()["item_id"].alias("group_item"))
    return (
        items.join(same.hint("shuffle_merge"), ["shape", "words"])
        .join(groups.hint("shuffle_merge"), "shape")
        .select("item_id", "same_item", "group_item")
    )


def item_windows(benchmark: DataFrame, leaks: Leaks) -> tuple[DataFrame, DataFrame, list[int]]:
    """What is looked for, both stored, and the lengths of windows in it, of at most ``window`` tokens.

    ``shape, item, item_tokens, size, item_at, hash, item_slots, common, shared_at``: the windows of
    all items as they are, without slots, and the typed ones with enough literals. Items shorter
    than a window are one shorter window. Items of one shape are looked for once, under
    ``item``, the least of their ids. ``common`` tells that more than ``shared`` shapes have
    the window, ``shared_at`` the item's places in any such window.

    ``shape, whole, same``: the hash of all windows of an item as they are, in order, and the
    least id of the items with just these words.
    """
    own = stored(_items(benchmark).withColumn("size", F.least("item_tokens", F.lit(leaks.window))), "items")
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())
    same = own.groupBy("shape", "words", "size").agg(_least_id("text", "item_tokens").alias("least"))
    first = own.groupBy("shape").agg(_least_id("words").alias("least"))
    first = first.select("shape", F.col("least.item_id").alias("item"), F.col("least.words").alias("first"))
    items = same.join(first.hint("shuffle_merge"), "shape").select(
        "shape", "words", "size", "item", (F.col("words") == F.col("first")).alias("typed"),
        F.col("least.item_id").alias("same"), F.col("least.text").alias("text"), F.col("least.item_tokens").alias("item_tokens"),
    )
    keys = ["shape", "words", "size", "item", "typed", "same", "item_tokens"]
    every = None
    for size in sizes:
        some = windows(items.where(F.col("size") == size), keys, size)
        every = some if every is None else every.unionByName(some)
    if every is None:
        every = windows(items, keys, leaks.window)
    every = stored(every, "all-item-windows")
    columns = ["shape", "item", "item_tokens", "size", F.col("at").alias("item_at")]
    none = F.lit(None).cast("array<bigint>")
    plain = every.select(*columns, F.col("plain").alias("hash"), none.alias("item_slots")).distinct()
    enough = F.size(F.filter("slots", lambda s: s.isNull())) >= leaks.literals
    typed = every.where((F.col("size") == leaks.window) & F.col("typed") & (F.col("hash") != F.col("plain")) & enough)
    index = plain.unionByName(typed.select(*columns, "hash", F.col("slots").alias("item_slots")))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "plain"))), lambda w: w["plain"])
    whole = every.groupBy("shape", "words", "same").agg(F.xxhash64(in_order).alias("whole")).select("shape", "whole", "same")
    index = stored(index, "item-windows")
    many = index.groupBy("hash").agg(F.countDistinct("shape").alias("shapes")).where(F.col("shapes") > leaks.shared)
    flagged = index.join(many.select("hash", F.lit(True).alias("common")), "hash", "left")
    flagged = stored(flagged.withColumn("common", F.coalesce("common", F.lit(False))), "item-windows")
    places = F.explode(F.sequence("item_at", F.col("item_at") + F.col("size") - 1))
    shared = flagged.where("common").select("shape", places.alias("at")).groupBy("shape").agg(F.collect_set("at").alias("shared_at"))
    none = F.expr("cast(array() as array<int>)")
    index = flagged.join(shared, "shape", "left").withColumn("shared_at", F.coalesce("shared_at", none))
    return stored(index, "item-windows"), stored(whole, "whole-items"), sizes


def leaked(docs: DataFrame, benchmark: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:
    """``doc_id, tag, item_id, matched_tokens, item_tokens, changed, group_item, similar_items``, a row for
    each item in a text.

    Windows of texts and items are joined by the hash of their lower-cased tokens as they are.
    Numbers, names and units after numbers are also replaced by their types, and windows joined
    by the hash of these forms, so windows of an item also match with other values. Windows with
    the item's own values count in any case. The others of a text and an item on one diagonal
    must fill the slots one to one: the same value of the item by the same value of the text,
    different ones by different ones; on diagonals that do not they are left out. ``changed`` tells that some value differs.

    Items that differ in values only, equal ones in the same places, are looked for as one,
    ``group_item``, the least of their ids. ``item_id`` is that of an item whose whole words are
    in the text, a row for each, or else ``group_item``; ``item_groups`` names all items behind
    an id.

    ``tag`` is the ``xxhash64`` of the text; rows equal in id and text are one. Null and empty
    texts have no windows, null items and items without words are not looked for; an item
    shorter than a window is found as a whole, as it is. Null ids of documents and items stay
    null. Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read. Empty tables on
    either side give an empty table.

    Windows that more than ``leaks.shared`` items have are no evidence by themselves: they are
    looked for only where a window of the item's own stands on their diagonal, so a text with a
    common phrase meets no item. Items all of whose tokens stand in such windows must be in the
    text nearly whole, and of these a text gets one row: one whose whole words it has, then that with
    the most tokens, then the least id. ``similar_items`` is how many it stands for, 1 for others.

    First the texts that have any window are found, then places and values in those only.
    Windows of the items are broadcast up to a counted bound, so the texts are not shuffled;
    beyond it, rows are joined by a shuffle on the hash.
    """
    index, whole, sizes = item_windows(benchmark, leaks)
    few = index.count() <= BROADCAST_WINDOWS

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    has_own = F.size("shared_at") < F.col("item_tokens")
    direct, common = index.where(~F.col("common") | ~has_own), index.where(F.col("common") & has_own)
    texts = docs.select("doc_id", text_or_empty("text").alias("text")).withColumn("tag", F.xxhash64("text"))
    keys, sizes = ["doc_id", "tag"], sizes or [leaks.window]
    some = some_windows(texts, keys, sizes, leaks.window)
    some = some.join(small(direct.select("hash").distinct()), "hash", "left_semi").select(*keys)
    some = stored(some.distinct(), "some-window").withColumnsRenamed({"doc_id": "_some_id", "tag": "_some_tag"})
    some = F.broadcast(some) if some.count() <= BROADCAST_DOCS else some.hint("shuffle_merge")
    texts = texts.join(some, F.col("doc_id").eqNullSafe(F.col("_some_id")) & (F.col("tag") == F.col("_some_tag")), "left_semi")

    # Equal forms have their slots in the same places.
    pairs = F.filter(
        F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc")),
        lambda pair: pair["item"].isNotNull(),
    )
    places = None
    for size in sizes:
        own = windows(texts, keys, size)
        as_is = F.struct(F.col("plain").alias("hash"), F.lit(None).cast("array<bigint>").alias("slots"))
        typed = F.struct("hash", "slots")
        forms = F.when(F.col("hash") != F.col("plain"), F.array(as_is, typed)).otherwise(F.array(as_is)) if size == leaks.window else F.array(as_is)
        own = own.select(*keys, "at", F.explode(forms).alias("form")).select(*keys, "at", "form.hash", "form.slots")
        own = own.join(small(index.select("hash").distinct()), "hash", "left_semi")
        places = own if places is None else places.unionByName(own)
    places = stored(places, "window-places")
    of_item = ["shape", "item", "item_tokens", "size", "shared_at"]
    found = [F.col("item_at"), "hash", F.when(F.col("item_slots").isNotNull(), pairs).alias("pairs")]
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    hits = places.join(small(direct), "hash").select(*keys, *of_item, shift, *found)
    # Where a common window must stand for a diagonal with other windows, and whether it does.
    diagonals = hits.select(*keys, "shape", "size", "shift").distinct()
    due = diagonals.join(small(common), ["shape", "size"]).withColumn("at", F.col("shift") + F.col("item_at"))
    due = due.withColumnsRenamed({"doc_id": "_due_id", "tag": "_due_tag", "at": "_due_at", "hash": "_due_hash"})
    same = (
        F.col("doc_id").eqNullSafe(F.col("_due_id")) & (F.col("tag") == F.col("_due_tag"))
        & (F.col("at") == F.col("_due_at")) & (F.col("hash") == F.col("_due_hash"))
    )
    hits = hits.unionByName(places.join(due, same).select(*keys, *of_item, shift, *found))
    is_typed = F.col("pairs").isNotNull()
    lines = hits.groupBy(*keys, *of_item, "shift").agg(
        F.array_sort(F.collect_set(F.when(~is_typed, F.struct("item_at", "hash")))).alias("equal"),
        F.collect_set(F.when(is_typed, F.struct("item_at", "pairs"))).alias("typed"),
    )
    # Places whose values equal an item's count in any case.
    lines = lines.withColumn("typed", F.filter("typed", lambda t: ~F.array_contains(F.col("equal.item_at"), t["item_at"])))
    lines = lines.withColumn("pairs", F.array_distinct(F.flatten("typed.pairs")))
    one_to_one = (F.size(F.array_distinct("pairs.item")) == F.size("pairs")) & (
        F.size(F.array_distinct("pairs.doc")) == F.size("pairs")
    )
    complete = F.size("equal") == F.col("item_tokens") - F.col("size") + 1
    lines = (
        lines.withColumn("fits", one_to_one)
        .withColumn("differing", F.when(F.col("fits"), F.col("typed.item_at")).otherwise(F.expr("cast(array() as array<int>)")))
        .withColumn("whole", F.when(complete, F.xxhash64("equal.hash")))
        .join(whole.withColumn("known", F.lit(True)), ["shape", "whole"], "left")
        .withColumn("ats", F.array_union("equal.item_at", "differing"))
    )
    spread = F.array_distinct(
        F.flatten(F.transform(F.flatten(F.collect_list("ats")), lambda at: F.sequence(at, at + F.col("size") - 1)))
    )
    covered = lines.groupBy(*keys, *of_item).agg(
        spread.alias("covered"),
        F.max(F.size("differing") > 0).alias("changed"),
        F.collect_set(F.when(F.col("known"), F.struct(F.col("same").alias("item_id")))).alias("verbatim"),
    )
    covered = covered.select(
        "*",
        F.size("covered").cast("long").alias("matched_tokens"),
        F.size(F.array_except("covered", "shared_at")).alias("matched_own"),
        (F.col("item_tokens") - F.size("shared_at")).alias("own_tokens"),
    )

    def enough(matched: str, of: str) -> Column:
        return (F.col(matched) >= leaks.coverage * F.col(of)) | (F.col(matched) >= leaks.tokens)

    own = covered.where((F.col("own_tokens") > 0) & enough("matched_tokens", "item_tokens") & enough("matched_own", "own_tokens"))
    ids = F.when(F.size("verbatim") > 0, F.col("verbatim")).otherwise(F.array(F.struct(F.col("item").alias("item_id"))))
    told = [F.col("matched_tokens"), F.col("item_tokens").cast("long").alias("item_tokens"), "changed", F.col("item").alias("group_item")]
    rows = own.select("*", F.explode(ids).alias("own")).select("doc_id", "tag", "own.item_id", *told, F.lit(1).cast("long").alias("similar_items"))
    alike = covered.where((F.col("own_tokens") <= 0) & (F.col("matched_tokens") >= leaks.whole * F.col("item_tokens")))
    alike = alike.select("doc_id", "tag", F.array_min(ids).getField("item_id").alias("item_id"), *told, (F.size("verbatim") == 0).alias("part"))
    best = F.min_by(
        F.struct("item_id", "matched_tokens", "item_tokens", "changed", "group_item"),
        F.struct("part", -F.col("matched_tokens"), F.col("item_id").isNull(), "item_id", "group_item"),
    )
    one = alike.groupBy(*keys).agg(best.alias("best"), F.count(F.lit(1)).alias("similar_items"))
    return rows.unionByName(one.select(*keys, "best.*", "similar_items"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:
    """The rows of ``docs`` in whose text no item was found, all columns as they are.

    Rows with a null or empty text stay, repeated rows all stay or all go, a row with a null id
    goes by its text. Columns may have any names. An empty benchmark keeps all rows.
    """
    found = stored(leaked(docs, benchmark, leaks).select("doc_id", "tag").distinct(), "leaks")
    # Names that no column of the documents has.
    free = max(map(len, docs.columns)) * "_"
    id_, tag = f"{free}id", f"{free}tag"
    found = found.select(F.col("doc_id").alias(id_), F.col("tag").alias(tag))
    few = found.count() <= BROADCAST_DOCS
    found = F.broadcast(found) if few else found.hint("shuffle_merge")
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(tag))
    return docs.join(found, same, "left_anti")
