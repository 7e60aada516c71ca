"""MinHash near-duplicates: SuperMinHash, banding, verification and grouping.

1. Every text becomes a SuperMinHash signature and the 128-bit key of its shingle set.
   Texts of one key form one class, which goes on as one node, numbered without repeats.
2. Signatures are cut into bands; classes that agree in a band share a bucket.
3. Each bucket proposes its members to one leader. Proposals that the signatures do not
   rule out are confirmed on the full shingle sets, and links are united.
4. Buckets whose members are still in different groups are compared member by member, in
   tiles of bounded size, on signatures alone. What a tile reports is not the similar
   pairs but which groups they would join: at most as many rows as it has members.
5. Groups that could be joined form a family. The members of a family are compared again
   in tiles, now on their full sets, and a tile reports the joins that it confirmed.

Members of one group need no further links: a large group has tiles of its own members
only against those of others, and a bucket of copies is done after step 3.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import gathered, map_batches
from lexipost.llm.components import connected_components, narrow
from lexipost.llm.superminhash import WordHashes, mix, shingle_set, signatures
from lexipost.session import stage

SLOTS = 128
BAND_SLOTS = 4
#: Of 128 slots, two sets of similarity 0.8 agree in 80 or more but for 5 in 10^7 times.
#: Bands find such a pair but for (1 - 0.8^4)^32 = 5 in 10^8.
LEAST_EQUAL = 80
TILE = 512  # members on each side of a tile
TILES_OF_TASK = 16  # full tiles, or as many comparisons in smaller ones
_AT_ONCE = 16  # sets that a member of a tile is compared with before labels are looked at
_CHUNK = 150_000  # shingles whose signatures are computed at once
_READ_BYTES = 4 << 20


def _slot_codes(values: np.ndarray) -> np.ndarray:
    """16-bit codes of the slots' values; different values share one 1 in 65,536 times."""
    return (mix(values.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        low, high = mix(shingles).sum(), mix(~shingles).sum()
    low, high = mix(np.array([low, high], np.uint64)).view(np.int64).tolist()
    return low, high


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(_key, _hash, n, low, high, sig): ``sig`` holds the slots' codes, null if n = 0."""
    kept = docs.select(
        F.col(key).alias("_key"),
        F.col(text).cast("string").alias("_text"),
        F.xxhash64(F.col(text).cast("string")).alias("_hash"),
    )
    kind = dict(kept.dtypes)["_key"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in gathered(batches, "_text", _READ_BYTES):
            sets = [shingle_set(t, words, hashes) for t in batch.column("_text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            codes: list[bytes | None] = [None] * len(sets)
            by_size = np.argsort(sizes, kind="stable")  # like sizes stop early together
            by_size = by_size[sizes[by_size] > 0]
            total = np.cumsum(sizes[by_size])
            at = 0
            while at < len(by_size):
                done = total[at - 1] if at else 0
                upto = max(at + 1, int(np.searchsorted(total, done + _CHUNK, "right")))
                part = by_size[at:upto]
                found = signatures(np.concatenate([sets[i] for i in part]), sizes[part], SLOTS)
                for i, row in zip(part.tolist(), _slot_codes(found), strict=True):
                    codes[i] = row.tobytes()
                at = upto
            keys = [_set_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    batch.column("_hash"),
                    pa.array(sizes),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(codes, pa.binary()),
                ],
                ["_key", "_hash", "n", "low", "high", "sig"],
            )

    return map_batches(
        kept, work, f"_key {kind}, _hash bigint, n bigint, low bigint, high bigint, sig binary"
    )


def _shingle_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (node, rep: a row's key and hash)."""
    kept = docs.select(
        F.col(key).alias("_key"),
        F.col(text).cast("string").alias("_text"),
        F.xxhash64(F.col(text).cast("string")).alias("_hash"),
    )
    asked = wanted.select("node", F.col("rep._key").alias("_k"), F.col("rep._hash").alias("_h"))
    # The list grows with the corpus: it is joined by a shuffle at every size.
    listed = asked.hint("merge")
    rows = kept.join(
        listed, (kept["_hash"] == asked["_h"]) & kept["_key"].eqNullSafe(asked["_k"])
    ).select("node", "_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [
                shingle_set(t, words, hashes).view(np.int64)
                for t in batch.column("_text").to_pylist()
            ]
            arrays = [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles"])

    found = map_batches(rows, work, "node bigint, shingles array<bigint>")
    # A row that stands in the table twice gives its set twice.
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _sides(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with the columns of both nodes, suffixed _a and _b."""
    for side in ("a", "b"):
        named = [F.col(c).alias(f"{c}_{side}") for c in columns]
        pairs = pairs.join(table.select(F.col("node").alias(side), *named), side)
    return pairs


def _equal_slots() -> Column:
    return F.expr(
        "aggregate(sequence(0, {last}), 0, (c, i) -> c + if("
        "substring(sig_a, 2 * i + 1, 2) = substring(sig_b, 2 * i + 1, 2), 1, 0))".format(
            last=SLOTS - 1
        )
    )


def _star_links(
    pairs: DataFrame, classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, rows: int
) -> DataFrame:
    """The pairs (a, b) that are similar enough, by exact counts.

    Pairs whose sizes or signatures rule a link out are dropped before sets are read.
    """
    likely = _sides(pairs, classes, ["n", "sig"]).filter(
        F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        & (_equal_slots() >= LEAST_EQUAL)
    )
    likely = stage(narrow(likely.select("a", "b"), rows), "pairs")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = stage(sets_of(classes.join(nodes, "node", "left_semi")), "shingle-sets")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    counted = _sides(likely, sets, ["shingles"]).select(
        "a", "b", both.alias("both"), (F.size("shingles_a") + F.size("shingles_b")).alias("total")
    )
    similar = counted.filter(f"100 * both >= {percent} * (total - both)")
    return stage(narrow(similar.select("a", "b"), rows), "links")


def _tiles(members: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``members`` (part, node, label, and ``columns``) dealt to tiles.

    Every two members of a part whose labels differ meet in one tile, of at most TILE
    members on each of two sides. Labels with more members than that have chunks of their
    own, which do not meet each other; the rest of the part shares chunks. Parts of one
    label have no tiles. Sorted by tile within partitions.
    """
    sizes = stage(members.groupBy("part", "label").agg(F.count("*").alias("size")), "tile-sizes")
    own = F.when(F.col("size") > TILE, F.col("label")).otherwise(F.lit(0))
    keyed = sizes.select("part", "label", "size", own.cast("bigint").alias("pool"))
    chunks = F.expr(f"(sum(size) + {TILE - 1}) div {TILE}")
    layout = stage(
        keyed.groupBy("part", "pool")
        .agg(
            chunks.alias("chunks"),
            F.count("*").alias("labels"),
            F.sum("size").cast("double").alias("rows"),
        )
        .groupBy("part")
        .agg(
            F.collect_list(F.struct("pool", "chunks")).alias("layout"),
            F.sum("labels").alias("labels"),
            F.expr("sum(rows) * sum(rows) - sum(if(pool = 0, 0, rows * rows))").alias("met"),
        )
        .filter("labels > 1")
        .select("part", "layout", "met"),
        "tile-layout",
    )
    # The work is the number of comparisons, which neither bytes nor the number of tiles say:
    # most parts are a few rows in one tile.
    full = (layout.agg(F.sum("met")).first()[0] or 0) / 2 / TILE**2
    spark = members.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(full // TILES_OF_TASK))
    at = F.expr("filter(layout, x -> x.pool = pool)[0].chunks")
    placed = (
        members.join(sizes, ["part", "label"])
        .withColumn("pool", own.cast("bigint"))
        .join(layout.drop("met"), "part")
        .withColumn("chunk", F.xxhash64("pool", F.pmod(F.xxhash64("node"), at)))
    )
    others = F.expr(
        "flatten(transform(filter(layout, x -> pool = 0 or x.pool <> pool), "
        "x -> transform(sequence(0L, x.chunks - 1), k -> xxhash64(x.pool, k))))"
    )
    return (
        placed.withColumn("other", F.explode(others))
        .select(
            F.xxhash64("part", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
            "chunk", "node", "label", *columns,
        )
        .repartition(tasks, "tile")
        .sortWithinPartitions("tile", "chunk", "node")
    )


class _Groups:
    """Which labels of a tile are joined already, and the joins made."""

    def __init__(self, label: np.ndarray) -> None:
        self.names, self.number = np.unique(label, return_inverse=True)
        self.parent = np.arange(len(self.names))
        self.joins: list[tuple[int, int]] = []

    def of(self, rows: np.ndarray | slice | int) -> np.ndarray:
        return self.parent[self.number[rows]]

    def join(self, row: int, others: np.ndarray) -> None:
        for group in np.unique(self.of(others)).tolist():
            mine = int(self.of(row))
            if group != mine:
                self.joins.append((int(self.names[mine]), int(self.names[group])))
                self.parent[self.parent == group] = mine


def _similar(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the ascending sets ``others`` are similar enough to ``own``, exactly."""
    sizes = np.array([len(o) for o in others])
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
    both = np.add.reduceat(own[at] == joined, np.concatenate(([0], np.cumsum(sizes)[:-1])))
    return 100 * both >= percent * (len(own) + sizes - both)


def _tile_joins(rows: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """The labels of a tile that similar members join.

    With a column ``shingles`` similarity is exact, without it what the signatures allow.
    """
    label, n, chunk = (rows.column(c).to_numpy() for c in ("label", "n", "chunk"))
    groups = _Groups(label)
    if len(groups.names) == 1:
        return []
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, SLOTS)
    sets = None
    if "shingles" in rows.schema.names:
        lists = rows.column("shingles")
        ends = lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py()
        sets = np.split(lists.flatten().to_numpy().view(np.uint64), ends)  # ascending as such
    two = chunk[0] != chunk[-1]
    split = int(np.searchsorted(chunk != chunk[0], True)) if two else len(chunk)
    for a in range(split):
        others = slice(split, None) if two else slice(a + 1, None)
        fits = (groups.of(others) != groups.of(a)) & (
            100 * np.minimum(n[others], n[a]) >= percent * np.maximum(n[others], n[a])
        )
        at = np.flatnonzero(fits) + others.start
        if not len(at):
            continue
        equal = (sig[at] == sig[a]).sum(axis=1)
        at, equal = at[equal >= LEAST_EQUAL], equal[equal >= LEAST_EQUAL]
        if sets is None:
            groups.join(a, at)
            continue
        at = at[np.argsort(-equal, kind="stable")]
        while len(at):  # the likeliest first: what they join need not be compared
            part, at = at[:_AT_ONCE], at[_AT_ONCE:]
            groups.join(a, part[_similar(sets[a], [sets[b] for b in part], percent)])
            at = at[groups.of(at) != groups.of(a)]
    return groups.joins


def _joins(tiled: DataFrame, percent: int) -> DataFrame:
    """(a, b): labels that tiles join."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = _tile_joins(pa.concat_batches(rows), percent)
            sides = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(sides, ["a", "b"])

        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            ids = batch.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and ids[a] != now:
                    yield record(held)
                    held = []
                now = ids[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield record(held)

    return map_batches(tiled, work, "a bigint, b bigint")


def _decided(
    docs: DataFrame, key: str, text: str, words: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (_key, _hash, n, low, high), classes (low, high, component) and groups.

    Groups are (component, least, keeper); ``keeper`` is the least (none, _key, _hash) of a
    group, a null key being the largest.
    """
    rows = stage(sketches(docs, key, text, words), "sketches")
    # Written as they are numbered, so that a number stays with its class whatever is lost.
    classes = stage(
        rows.filter("n > 0")
        .groupBy("low", "high")
        .agg(
            F.min("_key").alias("first"),
            F.min(F.struct("_key", "_hash")).alias("rep"),
            F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_hash")).alias("keeper"),
            F.first("n").alias("n"),
            F.first("sig").alias("sig"),
        )
        .withColumn("node", F.monotonically_increasing_id() + 1),
        "classes",
    )
    width = 2 * BAND_SLOTS
    banded = classes.select(
        "node",
        "first",
        F.explode(
            F.expr(
                f"transform(sequence(0, {SLOTS // BAND_SLOTS - 1}), "
                f"i -> xxhash64(i, substring(sig, {width} * i + 1, {width})))"
            )
        ).alias("band_key"),
    )
    buckets = stage(
        banded.groupBy("band_key")
        .agg(
            F.count("*").alias("size"),
            F.min(F.struct("first", "node")).alias("leader"),
        )
        .filter("size > 1")
        .select("band_key", F.col("leader.node").alias("leader")),
        "buckets",
    )
    members = stage(
        banded.select("band_key", "node").join(buckets, "band_key"), "bucket-members"
    )
    count = classes.count()

    def sets_of(wanted: DataFrame) -> DataFrame:
        return _shingle_sets(docs, wanted.select("node", "rep"), key, text, words)

    proposed = stage(
        narrow(
            members.filter("node <> leader")
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            .distinct(),
            count,
        ),
        "proposed",
    )
    links = _star_links(proposed, classes, sets_of, percent, count)
    stars = stage(connected_components(links), "labels")
    label = F.coalesce("component", "node").alias("label")
    # Buckets of several labels, on signatures: which labels could be joined.
    in_buckets = stage(
        members.join(stars, "node", "left").select(F.col("band_key").alias("part"), "node", label),
        "labelled",
    )
    several = stage(
        narrow(
            in_buckets.groupBy("part")
            .agg(F.min("label").alias("least"), F.max("label").alias("most"))
            .filter("least <> most")
            .select("part"),
            count,
        ),
        "mixed-buckets",
    )
    described = classes.select("node", "n", "sig")
    in_doubt = in_buckets.join(several, "part").join(described, "node")
    # Staged before they are narrowed: the comparison keeps all its tasks.
    could_join = stage(_joins(_tiles(in_doubt, ["n", "sig"]), percent), "could-join")
    could_join = narrow(could_join, count)
    families = stage(connected_components(could_join), "families")
    # Families of several labels, on full sets: which labels are joined.
    labelled = classes.join(stars, "node", "left").select("node", "rep", "n", "sig", label)
    in_family = stage(
        labelled.join(
            families.select(F.col("node").alias("label"), F.col("component").alias("part")), "label"
        ),
        "family-members",
    )
    full = in_family.join(stage(sets_of(in_family), "family-sets"), "node")
    joins = stage(_joins(_tiles(full.drop("rep"), ["n", "sig", "shingles"]), percent), "joins")
    joined = stage(connected_components(narrow(joins, count)), "joined")
    labels = stage(
        classes.select("node", "low", "high", "first", "keeper")
        .join(stars, "node", "left")
        .select("low", "high", "first", "keeper", label)
        .join(joined.select(F.col("node").alias("label"), "component"), "label", "left")
        .select("low", "high", "first", "keeper", F.coalesce("component", "label").alias("component")),
        "labels",
    )
    # The least key of each group, over classes: one row per different text.
    least = stage(
        labels.groupBy("component")
        .agg(F.min("first").alias("least"), F.min("keeper").alias("keeper")),
        "least-keys",
    )
    return rows, labels, least


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row (key, n_shingles, component_id, kept) per row of ``docs``.

    Two texts are linked if their sets of different ``words``-word shingles have a Jaccard
    similarity of ``percent`` / 100 or more; links are confirmed on the full sets.
    ``component_id`` is the least key that links reach, and the row that has it is kept.
    A text of fewer words is one shingle. Null and blank texts have no shingle, are linked
    with nothing and kept. Rows of one key with equal texts share their answer; a null key
    gives way to any other. Other columns are left out, whatever their names; an empty
    table gives no rows.

    All proposals are found but for the chances stated at LEAST_EQUAL, for pairs of
    exactly the least similarity, and less above it.
    """
    rows, labels, groups = _decided(docs, key, text, words, percent)
    answers = stage(labels.join(groups, "component").select("low", "high", "least"), "answers")
    return (
        rows.select("_key", "n", "low", "high")
        .join(answers, ["low", "high"], "left")
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("_key")))
        .select(
            F.col("_key").alias(key),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, all columns, that are left when each group keeps one of them.

    Groups are those of ``near_duplicates``. The row of the least key stays, null being the
    largest, then that of the least text hash; of rows alike in both any one. Null and blank
    texts are linked with nothing and all stay.
    """
    _, _, groups = _decided(docs, key, text, words, percent)
    keepers = groups.select(F.col("keeper._key").alias("_k"), F.col("keeper._hash").alias("_h"))
    blank = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"\A[ \t\n\x0b\x0c\r]*\z")
    # Repeats are combined before the shuffle, so that no key is heavy in it or in the join.
    once = (
        docs.filter(~blank)
        .select(
            F.col(key).alias("_key"),
            F.xxhash64(F.col(text).cast("string")).alias("_hash"),
            F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        )
        .groupBy("_key", "_hash")
        .agg(F.first("_row").alias("_row"))
    )
    left = once.join(
        keepers, once["_key"].eqNullSafe(keepers["_k"]) & (once["_hash"] == keepers["_h"]), "left_semi"
    )
    return left.select("_row.*").unionByName(docs.filter(blank))
