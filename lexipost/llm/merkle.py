"""Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf. Leaves of one group ascend by key and form a tree in which three
consecutive nodes have one parent; the groups' roots form the tree above in the same way.
A node is labelled by the interval of leaf ranks that it covers, so the label of a parent
contains those of its children. Levels are built upwards, each by one aggregation and a
third as long as the one below. On the way down a level meets its parents by a join on
the bucket that both labels fall into, confirmed by containment; what remains of the
parent's interval on either side of a node is where its siblings are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div
from lexipost.operators.ranking import dense_ids
from lexipost.operators.skew import join_weighted
from lexipost.session import stage

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STAGED_LEVELS = 4  # so many levels of joins go into one plan on the way down
_MOST_LEVELS = 39  # ARITY to this power is the largest that a bigint holds
_TIES = 1 << 10
_KIDS = "array<struct<lo: bigint, hi: bigint, digest: binary>>"
_STEPS = "array<struct<before: binary, after: binary>>"


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed_digests(digests: Column) -> Column:
    """The digest of joined digests, which are hashed as hexadecimal text."""
    return F.unhex(F.sha2(as_hex(digests), 256))


def hashed_fields(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as byte count, colon and value, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    spelled = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*spelled), 256))


def _joined(digests: Column) -> Column:
    empty = F.lit(b"").cast("binary")
    return F.aggregate(digests, empty, lambda done, kid: F.concat(done, kid["digest"]))


def _height(leaves: Column) -> Column:
    """Levels above the leaves: how many powers of the arity are less than their number."""
    powers = ", ".join(f"{ARITY**k}L" for k in range(_MOST_LEVELS))
    return F.size(F.filter(F.expr(f"array({powers})"), lambda p: p < leaves))


def _climb(leaves: DataFrame, height: int, label: str) -> list[DataFrame]:
    """The levels of trees, from their leaves up; a tree ends at its own ``height``.

    Rows are (tree, height, pos, lo, hi, digest) and, above the leaves, the labels and
    digests of the children. A group of the aggregation has ``ARITY`` rows at most.
    """
    levels = [leaves]
    for level in range(height):
        below = levels[-1].filter(F.col("height") > level)
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        above = (
            below.groupBy("tree", "height", whole_div("pos", ARITY).alias("pos"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), kids.alias("kids"))
            .withColumn("digest", hashed_digests(_joined(F.col("kids"))))
        )
        levels.append(stage(above, f"{label}-{level + 1}"))
    return levels


def _descend(levels: list[DataFrame], tops: DataFrame, label: str) -> DataFrame:
    """Leaves with ``steps``, from the leaf up: the siblings on both sides at each level.

    ``tops`` (tree, steps, subroot) says how each tree's own root goes on. Some levels
    above the leaves are staged, so that the plan does not grow with the trees.
    """
    located: DataFrame | None = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        found = nodes.filter(F.col("height") == level).join(tops, "tree")
        if located is not None:
            above = located.select(
                F.col("tree").alias("_tree"),
                F.col("pos").alias("_bucket"),
                F.col("lo").alias("_lo"),
                F.col("hi").alias("_hi"),
                F.col("kids").alias("_kids"),
                F.col("steps").alias("_steps"),
                "subroot",
            )
            below = nodes.filter(F.col("height") > level)
            own = [*below.columns]
            inside = below.join(
                above,
                (F.col("tree") == F.col("_tree"))
                & (whole_div("pos", ARITY) == F.col("_bucket"))
                & (F.col("_lo") <= F.col("lo"))
                & (F.col("hi") <= F.col("_hi")),
            )
            # The parent's interval without the node's own leaves one piece on each side.
            before = F.filter("_kids", lambda kid: kid["hi"] <= F.col("lo"))
            after = F.filter("_kids", lambda kid: kid["lo"] >= F.col("hi"))
            step = F.struct(_joined(before).alias("before"), _joined(after).alias("after"))
            steps = F.concat(F.array(step), F.col("_steps")).alias("steps")
            found = found.select(*own, "steps", "subroot").unionByName(
                inside.select(*own, steps, "subroot")
            )
        located = found
        if level and level % _STAGED_LEVELS == 0:
            located = stage(located, f"{label}-paths-{level}")
    assert located is not None
    return located


def folded(leaf: Column, steps: Column) -> Column:
    """The digest that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(
        steps,
        leaf,
        lambda done, step: hashed_digests(F.concat(step["before"], done, step["after"])),
    )


def siblings(steps: Column) -> Column:
    """All siblings of a proof, joined from the leaf up and from left to right."""
    empty = F.lit(b"").cast("binary")
    return F.aggregate(
        steps, empty, lambda done, step: F.concat(done, step["before"], step["after"])
    )


@dataclass(frozen=True)
class Manifest:
    """``leaves``: (key, group, lo, leaf, carried columns, subroot, steps); ``nodes``: every
    inner node (tree, level, lo, hi, digest), the tree above the groups under tree -1."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: bytes | None


def build_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """The Merkle trees of ``docs`` and the proof of every row.

    A leaf is the digest of ``fields``. Groups are ordered bytewise, null first; leaves of
    a group by ``key``, null first, and rows of equal keys by digest. Repeated rows are
    leaves each. A single leaf is its group's root, a single group's root the root. An
    empty table has no rows and no root. ``carry`` adds columns computed from the row;
    other columns are left out, whatever their names.

    Only digests are sorted and shuffled, never texts. Rows of a hot group are spread by
    rank, as each level is keyed by (tree, position).
    """
    carry = carry or {}
    rows = docs.select(
        F.col(key).alias("_key"),
        # Null sorts first and stays apart from every name.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("_group"),
        hashed_fields([F.col(f) for f in fields]).alias("_leaf"),
        *[made.alias(f"_carry_{name}") for name, made in carry.items()],
        F.pmod(F.monotonically_increasing_id(), F.lit(_TIES)).alias("_tie"),
    )
    carried = [f"_carry_{name}" for name in carry]
    hashes = stage(rows, "merkle-hashes")
    # The last column only cuts runs of equal rows over partitions.
    ranked = dense_ids(hashes, ["_group", "_key", "_leaf", *carried, "_tie"], "_rank")
    ranked = stage(ranked.drop("_tie"), "merkle-ranked")
    sizes = ranked.groupBy("_group").agg(
        F.count("*").alias("_leaves"), F.min("_rank").alias("_first")
    )
    groups = stage(
        dense_ids(sizes, ["_group"], "tree").withColumn("height", _height(F.col("_leaves"))),
        "merkle-groups",
    )
    n_groups, height = groups.agg(F.count("*"), F.max("height")).first()
    leaves = join_weighted(ranked, groups, "_group", "_leaves").select(
        "tree",
        "height",
        (F.col("_rank") - F.col("_first")).alias("pos"),
        F.col("_rank").alias("lo"),
        (F.col("_rank") + 1).alias("hi"),
        F.col("_leaf").alias("digest"),
        "_key",
        "_group",
        *carried,
    )
    levels = _climb(stage(leaves, "merkle-0"), height or 0, "merkle")

    upper_height = 0
    while ARITY**upper_height < n_groups:
        upper_height += 1
    roots = [
        nodes.filter(F.col("height") == level).select("tree", "lo", "hi", "digest")
        for level, nodes in enumerate(levels)
    ]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = stage(subroots, "merkle-subroots")
    crown = subroots.select(
        F.lit(-1).cast("bigint").alias("tree"),
        F.lit(upper_height).alias("height"),
        F.col("tree").alias("pos"),
        "lo",
        "hi",
        "digest",
    )
    upper = _climb(crown, upper_height, "merkle-upper")
    top = upper[-1].select("tree", "digest")
    root = top.first()
    start = top.select(
        "tree", F.array().cast(_STEPS).alias("steps"), F.col("digest").alias("subroot")
    )
    tops = _descend(upper, start, "merkle-upper").select(
        F.col("pos").alias("tree"), "steps", F.col("digest").alias("subroot")
    )
    found = _descend(levels, stage(tops, "merkle-tops"), "merkle").select(
        F.col("_key").alias(key),
        F.expr("if(_group = '-', null, substring(_group, 2))").alias(group),
        "lo",
        F.col("digest").alias("leaf"),
        *[F.col(f"_carry_{name}").alias(name) for name in carry],
        "subroot",
        "steps",
    )
    nodes = None
    for table in (levels, upper):
        for level, rows in enumerate(table[1:], 1):
            part = rows.select("tree", F.lit(level).alias("level"), "lo", "hi", "digest")
            nodes = part if nodes is None else nodes.unionByName(part)
    if nodes is None:
        nodes = crown.select("tree", F.lit(0).alias("level"), "lo", "hi", "digest").filter("false")
    return Manifest(found, nodes, groups, bytes(root["digest"]) if root else None)


def verify_rows(
    docs: DataFrame,
    claimed: dict[str, Column],
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Check a changed copy of every row against the manifest of ``docs``.

    ``claimed`` replaces fields. One row (key, leaf, subroot, root, proof_sha256,
    folded_root, verified) per row: all but ``folded_root`` are of the untouched rows, and
    ``folded_root`` is what the changed row and the untouched siblings lead to.
    """
    changed = hashed_fields([claimed.get(f, F.col(f)) for f in fields])
    manifest = build_manifest(docs, key, group, fields, {"_claimed": changed})
    return (
        manifest.leaves.withColumn("root", F.lit(manifest.root).cast("binary"))
        .withColumn("folded_root", folded(F.col("_claimed"), F.col("steps")))
        .select(
            key,
            as_hex(F.col("leaf")).alias("leaf"),
            as_hex(F.col("subroot")).alias("subroot"),
            as_hex(F.col("root")).alias("root"),
            F.sha2(as_hex(siblings(F.col("steps"))), 256).alias("proof_sha256"),
            as_hex(F.col("folded_root")).alias("folded_root"),
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def without_line_ends(text: str = "text", key: str = "doc_id") -> Column:
    """``text`` without line ends where the CRC-32 of the decimal key is even."""
    even = F.crc32(F.col(key).cast("string")) % 2 == 0
    return F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))
