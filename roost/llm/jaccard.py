"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of word shingles; equal sets are one class. Two sets that
reach the threshold must agree on the first few tokens of any common order,
so only prefixes are indexed, in two steps:

1. By hash order, a prefix a little longer than needed: a class stays in the
   race only if enough tokens of its prefix occur in another class's prefix.
   Counts are over all classes. Nearly all unrelated documents end here.
2. For those left, tokens are ordered by how many classes hold them, rare
   ones first. A rare token is indexed alone, frequent ones in combinations of
   two: with the prefix extended by g + 1 tokens, two sets that share only
   frequent tokens there share two of one of g hash groups, so combinations
   inside a group suffice and their number stays in proportion to the set.

Classes that share index entries, directly or through others, form a field.
Links lie inside fields, and nearly every field is small enough for one task,
which compares the whole sets of those classes that share an entry and are not
yet known to hang together: a group of near copies costs a few comparisons a
member, and no link between different components is missed. A larger field is
settled entry by entry over many tasks: all members of an entry are compared
with its smallest one, what is linked is joined, and what is still apart goes
on. Entries that stay open, such as a template that many unlike documents
share, are cut into blocks; each pair of blocks is one group, whose overlaps
are counted as a matrix product.

Tokens of very many classes are told by every 64th class. They need no shuffle
of their own: their classes are counted map-side and joined by broadcast.

Tokens and classes are 64-bit hashes: two different shingles or sets are taken
for the same with probability 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices
from roost.operators.components import connected
from roost.sources.stage import discard, stage


@dataclass(frozen=True)
class JoinParams:
    """Link when ``percent`` * union <= 100 * intersection; ``words`` per shingle.

    ``field_classes`` and ``field_tokens``: what a field may hold to be settled by one task.
    For larger fields, ``small``: entries of at most so many classes are compared
    in full; ``rounds``: after so many rounds by smallest member, all others are,
    in blocks of ``block_classes`` classes and ``block_tokens`` tokens.
    ``rare``: tokens in at most so many classes are indexed alone.
    """

    words: int = 5
    percent: int = 80
    rare: int = 8
    small: int = 12
    rounds: int = 10
    field_classes: int = 4000
    field_tokens: int = 2_000_000
    block_classes: int = 2000
    block_tokens: int = 200_000


BROADCAST_IDS = 1_000_000
# Crowded tokens: of every so many classes one is looked at; tokens of more than so many of these
# are crowded; there are at most so many.
CROWDED_SAMPLE = 64
CROWDED_FROM = 16
MAX_CROWDED = 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(raw: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text given as UTF-8.

    A-Z are lower-cased and words end at ASCII white space, which is what the
    bytes methods do. Fewer words than a shingle has: the whole as one; none: empty.
    """
    split = (raw or b"").lower().split()
    if not split:
        return np.zeros(0, dtype=np.int64)
    if len(split) < words:
        whole = xxhash.xxh3_64_intdigest(b" ".join(split), seed=len(split))
        return np.array([whole], dtype=np.uint64).view(np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, split), dtype=np.uint64, count=len(split))
    n = len(split) - words + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        h = mixed(h + MIX) ^ hashed[k : k + n]
    return np.unique(mixed(h).view(np.int64))


def needed(n, percent: int):
    """The least overlap of a set of n tokens with any set it links with (numbers or columns)."""
    if isinstance(n, Column):
        return F.ceil(n * percent / 100.0).cast("int")
    return -(-n * percent // 100)


def extra(n: int) -> int:
    """How many agreeing tokens the first step asks of a pair whose smaller set has n tokens."""
    return max(1, n // 20)


def document_sets(docs: DataFrame, params: JoinParams, prefix: bool) -> DataFrame:
    """(doc_id, cls, n, tokens): the set, or only its prefix in hash order. ``cls`` is null for an empty set."""
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in slices(whole, "raw")):
            cls, sizes, tokens = [], [], []
            for raw in batch.column("raw"):
                found = shingles(raw.as_py(), params.words)
                n = len(found)
                sizes.append(n)
                cls.append(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64) if n else None)
                tokens.append(found[: n - needed(n, params.percent) + extra(n)] if prefix and n else found)
            ends = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            flat = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([None if c is None else int(c) for c in cls], pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                ],
                ["doc_id", "cls", "n", "tokens"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw")
    )
    return narrow.mapInArrow(run, "doc_id bigint, cls bigint, n int, tokens array<bigint>")


def crowded_tokens(tokens: DataFrame) -> DataFrame:
    """(token): tokens that very many classes hold, judged by every 64th class; the choice is one of route only.

    ``tokens`` has each class's tokens once. More than MAX_CROWDED cannot reach the share asked for.
    """
    some = tokens.where(F.pmod("cls", F.lit(CROWDED_SAMPLE)) == 0).groupBy("token").agg(F.count("*").alias("n"))
    some = stage(some.where(F.col("n") > CROWDED_FROM), "crowded-tokens")
    total = some.agg(F.sum("n")).first()[0] or 0
    return some.where(F.col("n") > total // MAX_CROWDED).select("token")


def candidates(prefixes: DataFrame, params: JoinParams) -> DataFrame:
    """Classes with enough prefix tokens that another class has in its prefix as well: (cls, doc_id)."""
    classes = prefixes.where("cls IS NOT NULL").groupBy("cls")
    one = classes.agg(F.min(F.struct("doc_id", "n")).alias("one")).select("cls", "one.doc_id", "one.n")
    entries = classes.agg(F.first("tokens").alias("tokens")).select("cls", F.explode("tokens").alias("token"))
    crowded = crowded_tokens(entries)
    some = not crowded.isEmpty()
    # One shuffle serves the count and the join.
    ordinary = (entries.join(F.broadcast(crowded), "token", "left_anti") if some else entries).repartition("token")
    shared = ordinary.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1").select("token")
    found = ordinary.join(shared, "token").select("cls")
    if some:
        # Crowded tokens are shared by what they are.
        found = found.unionByName(entries.join(F.broadcast(crowded), "token").select("cls"))
    found = found.groupBy("cls").agg(F.count("*").alias("hits"))
    least = F.greatest(F.lit(1), F.floor(needed(F.col("n"), params.percent) / 20))
    return found.join(one, "cls").where(F.col("hits") >= least).select("cls", "doc_id")


def class_sets(docs: DataFrame, chosen: DataFrame, params: JoinParams) -> DataFrame:
    """(cls, n, tokens): the whole sets of the chosen classes, each read from one of its documents."""
    ids = chosen.select("doc_id").distinct()
    if chosen.count() <= BROADCAST_IDS:
        # Broadcast bound: counted just now, 8 bytes each. Beyond it the texts are shuffled.
        ids = F.broadcast(ids)
    # Documents without an id are read together and told apart by their class.
    ids = ids.withColumnRenamed("doc_id", "chosen_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["chosen_id"])).select("doc_id", "text")
    sets = document_sets(texts, params, prefix=False).join(chosen.select("cls").distinct(), "cls", "left_semi")
    return sets.groupBy("cls").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def index_entries(sets: DataFrame, params: JoinParams) -> DataFrame:
    """(key, cls, n): rare prefix tokens, and combinations of two frequent ones of a hash group."""
    ready_workers(sets.sparkSession)
    tokens = sets.select("cls", "n", F.explode("tokens").alias("token"))
    crowded = crowded_tokens(tokens)
    some = not crowded.isEmpty()
    ordinary = (tokens.join(F.broadcast(crowded), "token", "left_anti") if some else tokens).repartition("token")
    holders = ordinary.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    held = ordinary.join(holders, "token")
    if some:
        many = tokens.join(F.broadcast(crowded), "token")
        # Counted map-side; as few rows as there are crowded tokens.
        counts = many.groupBy("token").agg(F.count("*").alias("holders"))
        held = held.unionByName(many.join(F.broadcast(counts), "token"))
    # Tokens of one class alone come first in the order; only their number matters.
    ordered = (
        held.groupBy("cls", "n")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("shared"))
        .where(F.size("shared") >= needed(F.col("n"), params.percent))
    )
    listed = ordered.select("cls", "n", F.col("shared.holders").alias("holders"), F.col("shared.token").alias("tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.array(keys_of(row["n"], row["holders"], row["tokens"], params), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([row["cls"]] * len(keys), pa.int64()), pa.array([row["n"]] * len(keys), pa.int32())],
                    ["key", "cls", "n"],
                )

    return listed.mapInArrow(run, "key bigint, cls bigint, n int")


def keys_of(n: int, holders: list[int], tokens: list[int], params: JoinParams) -> list[int]:
    """Index keys of one set of n tokens, of which ``tokens`` occur elsewhere too, rare ones first.

    Partners of n tokens have between 80 and 125 percent as many. Both sides
    take the number of hash groups from the smaller one's power of two, so a
    set that may have a partner in the power below is indexed for that too.
    """
    least = needed(n, params.percent)
    top = n.bit_length() - 1
    levels = [top] if least >= 1 << top else [top - 1, top]
    h = mixed(np.array(tokens, dtype=np.int64).view(np.uint64))
    frequent = np.array(holders) > params.rare
    keys: set[int] = set()
    for level in levels:
        groups = (1 << level) // 8
        end = len(tokens) - least + 1 + groups
        inside = np.arange(len(tokens)) < end
        alone = inside if groups == 0 else inside & ~frequent
        keys.update(h[alone].view(np.int64).tolist())
        if groups:
            many = h[inside & frequent]
            group = many % np.uint64(groups)
            for g in np.unique(group):
                same = np.sort(many[group == g])
                for a, b in combinations(range(len(same)), 2):
                    keys.add((int(same[a]) * 31 + int(same[b]) * 0x9E3779B97F4A7C15 + level) & (2**64 - 1))
    return [k - (1 << 64) if k >= 1 << 63 else k for k in keys]


def components_of(entries: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame | None:
    """(node, root) over all links between classes; None if there are none."""
    repeated = entries.groupBy("key").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least <> most")
    stars = entries.join(repeated.select("key", "least"), "key").select(F.col("least").alias("u"), F.col("cls").alias("v"))
    fields = connected(stars.distinct())
    held = fields.withColumnRenamed("node", "cls").join(sets, "cls")
    sizes = stage(held.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("tokens")), "join-fields")
    fitting = (F.col("members") <= params.field_classes) & (F.col("tokens") <= params.field_tokens)
    keys = entries.join(repeated.select("key"), "key").groupBy("cls").agg(F.collect_list("key").alias("keys"))
    one_task = held.join(sizes.where(fitting).select("root"), "root").join(keys, "cls")
    found = within_fields(one_task.select("root", "cls", "n", "tokens", "keys"), params)
    if sizes.where(~fitting).isEmpty():
        return found
    large = fields.join(sizes.where(~fitting).select("root"), "root").select(F.col("node").alias("cls"))
    rest = settle(entries.join(large, "cls"), sets, params)
    return found if rest is None else found.unionByName(rest.select("node", "root"))


def within_fields(members: DataFrame, params: JoinParams) -> DataFrame:
    """(node, root) of the classes that link with others of their field; staged."""
    ready_workers(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            field, cls = batch.column("root").to_pylist(), batch.column("cls").to_pylist()
            lists = [
                (batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("tokens", "keys")
            ]
            for i, (root, c) in enumerate(zip(field, cls, strict=True)):
                if root != at and held:
                    yield labelled(held, params.percent)
                    held = []
                at = root
                held.append((c, *(values[ends[i] : ends[i + 1]].copy() for ends, values in lists)))
        if held:
            yield labelled(held, params.percent)

    grouped = members.repartition("root").sortWithinPartitions("root", "cls")
    return stage(grouped.mapInArrow(run, "node bigint, root bigint"), "field-links")


def labelled(field: list[tuple[int, np.ndarray, np.ndarray]], percent: int) -> pa.RecordBatch:
    """Components of one field: (class, tokens, keys) in, the linked classes with their smallest one out."""
    n = len(field)
    sets = [np.sort(tokens) for _, tokens, _ in field]
    above = list(range(n))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    apart = np.zeros((n, n), dtype=bool)

    def links(a: int, b: int) -> bool:
        if len(sets[a]) > len(sets[b]):
            a, b = b, a
        few, many = sets[a], sets[b]
        x, y = len(few), len(many)
        if x * 100 < y * percent or apart[a, b]:
            return False
        at = np.searchsorted(many, few)
        at[at == y] = 0
        both = int(np.count_nonzero(many[at] == few))
        if both * 100 >= (x + y - both) * percent:
            return True
        apart[a, b] = apart[b, a] = True
        return False

    keys = np.concatenate([k for _, _, k in field])
    owner = np.repeat(np.arange(n), [len(k) for _, _, k in field])
    order = np.lexsort((owner, keys))
    starts = np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] - 1 if len(keys) else 0))
    for entry in np.split(owner[order], starts[1:]) if len(keys) else []:
        pools: dict[int, list[int]] = {}
        for i in entry.tolist():
            pools.setdefault(top(i), []).append(i)
        done: list[list[int]] = []
        for pool in pools.values() if len(pools) > 1 else ():
            still = []
            for other in done:
                if any(links(a, b) for a in pool for b in other):
                    low, high = sorted((top(pool[0]), top(other[0])))
                    above[high] = low
                    pool = pool + other
                else:
                    still.append(other)
            done = [*still, pool]
    root = [top(i) for i in range(n)]
    size = np.bincount(root, minlength=n)
    at = [i for i in range(n) if size[root[i]] > 1]
    return pa.RecordBatch.from_arrays(
        [pa.array([field[i][0] for i in at], pa.int64()), pa.array([field[root[i]][0] for i in at], pa.int64())],
        ["node", "root"],
    )


def fits(n1: Column, n2: Column, percent: int) -> Column:
    """Sizes alone do not rule a link out."""
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def linked(pairs: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the threshold."""
    left = sets.select(F.col("cls").alias("u"), F.col("n").alias("nu"), F.col("tokens").alias("tu"))
    right = sets.select(F.col("cls").alias("v"), F.col("n").alias("nv"), F.col("tokens").alias("tv"))
    both = F.size(F.array_intersect("tu", "tv"))
    joined = pairs.join(left, "u").join(right, "v")
    return joined.where(both * 100 >= (F.col("nu") + F.col("nv") - both) * params.percent).select("u", "v")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set on the left shares with each on the right, as a product of 0/1 matrices."""
    row = [np.repeat(np.arange(len(side)), list(map(len, side))) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    common, first, second = np.intersect1d(np.unique(flat[0]), np.unique(flat[1])), [], []
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(common):
        return out
    for tokens, owner in zip(flat, row, strict=True):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        known = common[at] == tokens
        order = np.argsort(at[known], kind="stable")
        first.append(at[known][order])
        second.append(owner[known][order])
    width = 1024
    for start in range(0, len(common), width):
        part = []
        for size, at, owner in zip((len(left), len(right)), first, second, strict=True):
            low, high = np.searchsorted(at, (start, start + width))
            m = np.zeros((size, width), dtype=np.float32)
            m[owner[low:high], at[low:high] - start] = 1.0
            part.append(m)
        out += part[0] @ part[1].T
    return out


def joined_pairs(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the smallest one that it reaches over the pairs (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def links_by_block(entries: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """(u, v): links inside the entries, as many as join what hangs together in a group; no pair is written out.

    An entry is cut into blocks, and each pair of blocks is a group of its own.
    """
    ready_workers(sets.sparkSession)
    sizes = entries.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("tokens"))
    pieces = F.greatest(F.ceil(F.col("members") / params.block_classes), F.ceil(F.col("tokens") / params.block_tokens))
    placed = (
        entries.select("key", "cls")
        .join(sizes.select("key", pieces.cast("int").alias("pieces")), "key")
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cls")
    )
    group = ["key", "low", "high"]
    grouped = placed.join(sets.select("cls", "tokens"), "cls").repartition(*group).sortWithinPartitions(*group)

    def judged(held: list[tuple[int, int, np.ndarray]], low: int, high: int) -> pa.RecordBatch:
        sides = [[i for i, h in enumerate(held) if h[0] == part] for part in (low, high)]
        left, right = ([held[i][2] for i in side] for side in sides)
        found = np.zeros((0, 2), dtype=np.int64)
        if left and right:
            both = overlaps(left, right)
            total = np.add.outer(list(map(len, left)), list(map(len, right)))
            found = np.argwhere(both * 100 >= (total - both) * params.percent)
        a, b = np.array(sides[0], dtype=np.int64)[found[:, 0]], np.array(sides[1], dtype=np.int64)[found[:, 1]]
        root = joined_pairs(a, b, len(held))
        at = np.flatnonzero(root != np.arange(len(held)))
        cls = np.array([h[1] for h in held], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(cls[root[at]]), pa.array(cls[at])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*group, "own", "cls")]
            ends, values = batch.column("tokens").offsets.to_numpy(), batch.column("tokens").values.to_numpy()
            for i, (key, low, high, own, cls) in enumerate(zip(*columns, strict=True)):
                if (key, low, high) != at and held:
                    yield judged(held, *at[1:])
                    held = []
                at = (key, low, high)
                held.append((own, cls, values[ends[i] : ends[i + 1]].copy()))
        if held:
            yield judged(held, *at[1:])

    return grouped.mapInArrow(run, "u bigint, v bigint")


def settle(entries: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame | None:
    """(node, root) over all links between classes; None if there are none."""
    counted = entries.join(entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "key")
    open_entries = stage(counted.select("key", "cls", "n", F.col("cls").alias("comp")), "join-entries")
    links: DataFrame | None = None
    roots: DataFrame | None = None
    for _ in range(params.rounds):
        sizes = open_entries.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct("cls", "n", "comp")).alias("least"))
        sized = open_entries.join(sizes, "key")
        full = F.col("members") <= params.small
        apart = (F.col("u_comp") != F.col("v_comp")) & fits(F.col("u_n"), F.col("v_n"), params.percent)
        with_least = sized.where(~full & (F.col("cls") != F.col("least.cls"))).select(
            F.col("least.cls").alias("u"), F.col("least.n").alias("u_n"), F.col("least.comp").alias("u_comp"),
            F.col("cls").alias("v"), F.col("n").alias("v_n"), F.col("comp").alias("v_comp"),
        )
        small = sized.where(full)
        one = small.select("key", F.col("cls").alias("u"), F.col("n").alias("u_n"), F.col("comp").alias("u_comp"))
        two = small.select("key", F.col("cls").alias("v"), F.col("n").alias("v_n"), F.col("comp").alias("v_comp"))
        in_full = one.join(two, "key").where("u < v").drop("key")
        pairs = stage(with_least.unionByName(in_full).where(apart).select("u", "v").distinct(), "join-pairs")
        found = stage(linked(pairs, sets, params), "join-links")
        discard(pairs)
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            roots = connected(links)
        rest = sized.where(~full & (F.col("cls") != F.col("least.cls"))).select("key", "cls", "n")
        if roots is not None:
            rest = rest.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        else:
            rest = rest.withColumn("root", F.lit(None).cast("bigint"))
        rest = rest.select("key", "cls", "n", F.coalesce("root", "cls").alias("comp"))
        split = rest.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
        following = stage(rest.join(split, "key", "left_semi"), "join-entries")
        discard(open_entries)
        open_entries = following
        if open_entries.isEmpty():
            return roots
    found = stage(links_by_block(open_entries, sets, params), "join-links")
    links = found if links is None else links.unionByName(found)
    return roots if found.isEmpty() else connected(links)


def near_documents(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Null texts and texts without words have empty sets and link with nothing.
    Repeated rows and texts of equal sets link with each other. A null doc_id
    never names a component unless all its members are null. Other columns
    are ignored.
    """
    prefixes = stage(document_sets(docs, params, prefix=True), "shingle-prefixes")
    chosen = stage(candidates(prefixes, params), "join-candidates")
    rows = stage(prefixes.select("doc_id", "cls", "n"), "document-classes")
    discard(prefixes)
    sets = stage(class_sets(docs, chosen, params), "join-sets")
    roots = components_of(stage(index_entries(sets, params), "join-index"), sets, params)
    if roots is None:
        component = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("component"))
    else:
        named = roots.select(F.col("node").alias("cls"), "root")
        # Per class, not per document: a class may have most of the documents.
        classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least")).join(named, "cls", "left")
        rooted = classes.select("cls", "least", F.coalesce("root", "cls").alias("root"))
        least = rooted.groupBy("root").agg(F.min("least").alias("component"))
        component = rooted.join(least, "root").select("cls", "component")
    return rows.join(component, "cls", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """One row of each component, with all columns as they are: that of smallest doc_id, a null id last.

    Rows are told apart by id and text, so texts that share an id are judged
    apart; rows that repeat both are copies, of which one stays. Texts without
    words link with nothing: all of them stay. An empty table gives an empty one.
    """
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    keyed = docs.select(key.alias("doc_id"), "text")
    found = near_documents(keyed, params).where("n_shingles > 0")
    # Components name themselves by the smallest key here.
    found = stage(found.select(F.col("doc_id").alias("_key"), "component_id"), "document-components")
    several = found.groupBy("component_id").agg(F.count("*").alias("rows")).where("rows > 1").select("component_id")
    members = stage(found.join(several, "component_id").groupBy("component_id", "_key").agg(F.count("*").alias("rows")), "members")
    named = docs.select(key.alias("_key"), F.col("doc_id").cast("bigint").alias("id")).join(members, "_key")
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "_key")).alias("best"))
    judged = stage(
        members.join(best, "component_id").select("_key", "rows", (F.col("_key") == F.col("best._key")).alias("best")), "judged"
    )
    mark = "_key" + "_" * max(map(len, docs.columns))
    gone = judged.where("NOT best").select(F.col("_key").alias(mark))
    repeated = judged.where("best AND rows > 1").select(F.col("_key").alias(mark))
    left = docs.withColumn(mark, key).join(gone, mark, "left_anti")
    once = left.join(repeated, mark, "left_semi").dropDuplicates([mark])
    return left.join(repeated, mark, "left_anti").unionByName(once).select(*docs.columns)
