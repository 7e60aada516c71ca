"""Vector compression by product codes, nearest entries found by slices and bitmasks.

A vector is cut into parts; each part is coded by the nearest entry of the part's
codebook. To find it, every coordinate of the codebook is kept sorted, with the set of
the first j entries in that order as a 64-bit mask. A radius picks a range of each sorted
coordinate; the range's entries are the difference of two prefix masks, and the masks of
all coordinates ANDed are the entries in the box around the part. An entry in the box no
farther than the radius proves that the nearest is in the box. Otherwise the radius grows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import map_batches
from lexipost.operators.skew import join_weighted
from lexipost.session import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Scaled components must be less than this, so that squared distances are exact.
COMPONENT_BOUND = 1 << 24
_MASK_BITS = 64


class SlicedCodebook:
    """The entries of one part, sorted by each coordinate, with prefix masks."""

    def __init__(self, entries: np.ndarray) -> None:
        count, width = entries.shape
        if not 0 < count <= _MASK_BITS:
            raise ValueError("a codebook has 1 to 64 entries")
        order = np.argsort(entries, axis=0, kind="stable")
        self.entries = entries.astype(np.int64)
        self.sorted = np.take_along_axis(self.entries, order, 0).T.copy()
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((width, count + 1), np.uint64)
        self.prefix[:, 1:] = np.bitwise_or.accumulate(bits, axis=0).T
        self.all = self.prefix[0, -1] if width else np.uint64((1 << count) - 1)
        apart = self.entries[:, None, :] - self.entries[None, :, :]
        between = np.sqrt((apart.astype(np.float64) ** 2).sum(axis=2))
        between[between == 0] = np.inf
        near = between.min(axis=1)
        near = near[np.isfinite(near)]
        #: The first radius: half the way between an entry and the one nearest to it.
        self.radius = max(1, int(np.median(near) / 2)) if near.size else 1

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The masks of the entries in the box of half width ``radius`` around each part."""
        masks = np.full(len(parts), self.all, np.uint64)
        for d, (line, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            low = np.searchsorted(line, parts[:, d] - radius, "left")
            high = np.searchsorted(line, parts[:, d] + radius, "right")
            masks &= prefix[high] ^ prefix[low]
        return masks

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each part's nearest entry, the least of equal ones, and the square
        of their distance."""
        index = np.zeros(len(parts), np.int64)
        least = np.zeros(len(parts), np.int64)
        open_rows = np.arange(len(parts))
        radius = np.full(len(parts), self.radius, np.int64)
        while open_rows.size:
            asked, reach = parts[open_rows], radius[open_rows]
            masks = self.candidates(asked, reach)
            best = np.full(len(asked), np.iinfo(np.int64).max)
            at = np.zeros(len(asked), np.int64)
            for e, entry in enumerate(self.entries):
                rows = np.flatnonzero(masks & np.uint64(1 << e))
                apart = asked[rows] - entry
                square = np.einsum("ij,ij->i", apart, apart)
                closer = square < best[rows]
                best[rows[closer]], at[rows[closer]] = square[closer], e
            done = best <= reach * reach
            index[open_rows[done]], least[open_rows[done]] = at[done], best[done]
            # A candidate beyond the radius bounds the next one; without any, it doubles.
            met = (masks != 0) & ~done
            root = np.sqrt(np.where(met, best, 0).astype(np.float64)).astype(np.int64) + 1
            radius[open_rows] = np.where(met, root, 2 * reach)
            open_rows = open_rows[~done]
        return index, least


def sliced(codebooks: np.ndarray) -> list[SlicedCodebook]:
    """``codebooks`` is (parts, entries, width)."""
    return [SlicedCodebook(entries) for entries in codebooks]


def assigned(
    vectors: np.ndarray, books: list[SlicedCodebook]
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts) entry numbers, and the squared distances of each part."""
    width = vectors.shape[1] // len(books)
    found = [
        book.nearest(vectors[:, p * width : (p + 1) * width]) for p, book in enumerate(books)
    ]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _scaled(lists: pa.Array, width: int) -> np.ndarray:
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(values * SCALE)
    if whole.size and np.abs(whole).max() >= COMPONENT_BOUND:
        raise ValueError(f"components must be below {COMPONENT_BOUND // SCALE} in size")
    return whole.astype("<i4").reshape(-1, width)


def _packed(rows: DataFrame, width: int) -> DataFrame:
    """Vectors as whole numbers, a block of them per row: (keys, labels, data)."""
    kinds = dict(rows.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = _scaled(batch.column("_vector"), width).tobytes()
            ends = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(ends, batch.column("_key")),
                    pa.ListArray.from_arrays(ends, batch.column("_label")),
                    pa.array([data], pa.binary()),
                ],
                ["keys", "labels", "data"],
            )

    return map_batches(
        rows.select("_key", "_label", "_vector"),
        work,
        f"keys array<{kinds['_key']}>, labels array<{kinds['_label']}>, data binary",
    )


def _matrix(data: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), "<i4").reshape(-1, width).astype(np.int64)


def _moved(packed: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of what is assigned to them.

    A task gives one row of sums for each of its used entries; Spark adds them up, and
    the driver takes as many numbers as the codebooks have.
    """
    parts, _, width = codebooks.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sliced(codebooks)
        sums = np.zeros(codebooks.shape, np.int64)
        counts = np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            for data in batch.column("data"):
                vectors = _matrix(data, parts * width)
                codes, _ = assigned(vectors, books)
                for p in range(parts):
                    part = vectors[:, p * width : (p + 1) * width]
                    np.add.at(sums[p], codes[:, p], part)
                    counts[p] += np.bincount(codes[:, p], minlength=counts.shape[1])
        used = np.argwhere(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used[:, 0], pa.int32()),
                pa.array(used[:, 1], pa.int32()),
                pa.array([counts[p, e] for p, e in used], pa.int64()),
                pa.array([sums[p, e].tolist() for p, e in used], pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    partial = map_batches(
        packed.select("data"), work, "part int, entry int, n bigint, sums array<bigint>"
    )
    totals = (
        partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    )
    out = codebooks.copy()
    for row in totals.collect():  # a row per number of the codebooks
        out[row["part"], row["entry"], row["at"]] = int(row["sum"]) // row["n"]
    return out


def train_codebooks(packed: DataFrame, seeds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """(parts, entries, width) codebooks after ``rounds`` of assigning and averaging."""
    codebooks = seeds
    for _ in range(rounds):
        codebooks = _moved(packed, codebooks)
    return codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    numbers = ",".join(str(n) for n in codebooks.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def _coded(packed: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(_key, _label, code, error) of every packed vector."""
    parts, _, width = codebooks.shape
    kinds = {name: kind[len("array<") : -1] for name, kind in packed.dtypes}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sliced(codebooks)
        for batch in batches:
            for keys, labels, data in zip(*batch.columns, strict=True):
                codes, squares = assigned(_matrix(data, parts * width), books)
                raw = codes.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.values,
                        labels.values,
                        pa.array([raw[i : i + step] for i in range(0, len(raw), step)]),
                        pa.array(squares.sum(axis=1), pa.int64()),
                    ],
                    ["_key", "_label", "code", "error"],
                )

    return map_batches(
        packed.select("keys", "labels", "data"),
        work,
        f"_key {kinds['keys']}, _label {kinds['labels']}, code string, error bigint",
    )


def compress_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256), one row per sound vector.

    Components become floor(4096 * x). The codebooks start with the ``entries`` vectors of
    the least keys, null keys last, equal keys by their components; with fewer vectors
    there are fewer entries. ``label_error`` sums the errors of a label's vectors, those
    without a label together. Vectors that are null or hold null or non-finite components
    are left out; repeated rows are coded each. Vectors of one length, the commonest that
    has equal whole parts and the shortest of several such, are coded; one of another
    length keeps its row with a null code and error. Components of 4096 or more in size
    fail the job. An empty table gives no rows. Other columns are left out.

    Every round reads the packed whole numbers of all vectors once and shuffles a row of
    sums per task and entry; the driver holds the codebooks alone.
    """
    spark = vectors.sparkSession
    sound = vectors.select(
        F.col(key).alias("_key"), F.col(label).alias("_label"), F.col(vector).alias("_vector")
    ).filter(
        F.col("_vector").isNotNull()
        & ~F.exists(
            "_vector",
            lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
        )
    )
    lengths = (
        sound.groupBy(F.size("_vector").alias("width"))
        .agg(F.count("*").alias("n"))
        .filter((F.col("width") > 0) & (F.col("width") % parts == 0))
        .orderBy(F.desc("n"), "width")
        .first()
    )
    kinds = dict(sound.dtypes)
    if lengths is None:
        coded = sound.select(
            "_key", "_label", F.lit(None).cast("string").alias("code"),
            F.lit(None).cast("bigint").alias("error"),
        )
        digest = codebooks_digest(np.zeros((0, 0, 0), np.int64))
    else:
        width = lengths["width"]
        fitting = sound.filter(F.size("_vector") == width)
        first = fitting.orderBy(F.asc_nulls_last("_key"), "_vector").limit(entries).collect()
        seeds = _scaled(pa.array([[float(x) for x in r["_vector"]] for r in first]), width)
        seeds = seeds.astype(np.int64).reshape(len(first), parts, width // parts)
        packed = stage(_packed(fitting, width), "vectors-packed")
        codebooks = train_codebooks(packed, seeds.transpose(1, 0, 2).copy(), rounds)
        digest = codebooks_digest(codebooks)
        coded = _coded(packed, codebooks).unionByName(
            sound.filter(F.size("_vector") != width).select(
                "_key", "_label", F.lit(None).cast("string").alias("code"),
                F.lit(None).cast("bigint").alias("error"),
            )
        )
    coded = stage(
        # Null labels are one label; the mark keeps them apart from every real one.
        coded.select(
            "_key",
            F.coalesce(F.concat(F.lit("="), F.col("_label").cast("string")), F.lit("-")).alias("_label"),
            "code",
            "error",
        ),
        "vectors-coded",
    )
    totals = stage(
        coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")),
        "vectors-labels",
    )
    return join_weighted(coded, totals, "_label", "_n").select(
        F.col("_key").cast(kinds["_key"]).alias(key),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
