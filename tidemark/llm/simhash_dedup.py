"""Near-duplicate documents by SimHash fingerprints.

A fingerprint's bits are cut into segments and the set bits of each segment counted. Two
fingerprints differ in at least as many bits as the Manhattan distance of their counts, so the
counts are points of a small grid on which near fingerprints lie near each other. Two points at a
Manhattan distance of up to 2r share a grid point within r of both; each distinct fingerprint is
therefore sent to all grid points within r = ceil(max_distance / 2) of its own, and whatever meets
at a grid point is verified on the fingerprints themselves.

Copies share a fingerprint and take part once. At a grid point where many distinct fingerprints
meet, the same argument is repeated with segments of one bit, where the distance is exact: work
stays linear and no pair is left out. What leaves a grid point is a tree over the fingerprints
linked there, never all pairs. Links become components by ``components.roots``.

Defined cases: a null or empty text has no words and the fingerprint zero, and is linked like any
other; fewer words than a shingle make one shingle of them all; rows with a null id get a row and a
component, but never name one unless all members lack an id; repeated rows each give a row; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, picked, values
from tidemark.llm.components import roots
from tidemark.session import materialize

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
SEGMENT_BITS = 4
#: Distinct fingerprints at one grid point that are compared directly; more are refined to one bit.
DIRECT = 128
HASHES = 1 << 16
#: One-bit grid points handled at a time when a grid point is refined.
REFINED = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    n, bits, digest = len(words) - shingle + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, HASHES):
        upto = min(n, at + HASHES)
        spans = zip(starts[at:upto], ends[at + shingle - 1 : upto + shingle - 1])
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in spans], np.uint64)
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t, shingle) for t in values(batch.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(found.view(np.int64))], ["row", "doc_id", "fp"]
        )


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(row, doc_id, fp): 64-bit fingerprints as signed longs; ``row`` names a column of numbers to carry along."""
    docs = picked(docs, "doc_id", "text", *([row] if row else []))
    number = F.col(row) if row else F.lit(None)
    return docs.select(number.cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda b: _fingerprints(b, shingle), "row long, doc_id long, fp long"
    )


def popcounts(fps: np.ndarray, width: int) -> np.ndarray:
    """Set bits of each ``width``-bit segment, packed in place (a count fits its segment)."""
    x = fps.astype(np.uint64)
    if width == 1:
        return x
    x = x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))
    if width >= 4:
        x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
    if width == 8:
        x = (x + (x >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)
    return x


def ball(points: np.ndarray, width: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All grid points within ``radius`` steps of each point, with the index of the point they belong to."""
    cells, owners = [points], [np.arange(len(points))]
    mask = np.uint64((1 << width) - 1)
    for _ in range(radius):
        near, whose = [cells[-1]], [owners[-1]]
        for shift in range(0, 64, width):
            count = (near[0] >> np.uint64(shift)) & mask
            step = np.uint64(1 << shift)
            up, down = count < width, count > 0
            near += [near[0][up] + step, near[0][down] - step]
            whose += [whose[0][up], whose[0][down]]
        pairs = np.unique(np.stack([np.concatenate(whose).astype(np.uint64), np.concatenate(near)]), axis=1) if radius > 1 else None
        cells.append(np.concatenate(near) if pairs is None else pairs[1])
        owners.append(np.concatenate(whose) if pairs is None else pairs[0].astype(np.int64))
    return cells[-1], owners[-1]


def _to_grid(batches: Iterator[pa.RecordBatch], width: int, radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        cells, owners = ball(popcounts(fps, width), width, radius)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.view(np.int64)), pa.array(fps[owners].view(np.int64))], ["cell", "fp"]
        )


def tree(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b as a forest of the same components: each value with the smallest it is linked to."""
    if not len(a):
        return a, b
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        after = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(after, at, least)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _direct(cells: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among sorted grid points: compares rows k apart until no two share a point."""
    a, b, lag = [], [], 1
    at = np.arange(len(cells))
    while True:
        at = at[at + lag < len(cells)]
        at = at[cells[at] == cells[at + lag]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= most]
        a.append(fps[near])
        b.append(fps[near + lag])
        lag += 1
    empty = np.empty(0, np.uint64)
    return np.concatenate(a or [empty]), np.concatenate(b or [empty])


def _refined(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among many fingerprints at one grid point: with one-bit segments the distance is exact.

    The one-bit grid is gone through in parts of bounded size.
    """
    radius = most // 2  # within it two fingerprints that share a point are linked
    a, b = [], []
    if most % 2:  # an odd distance: those one step further apart are verified
        radius += 1
    size = len(fps) * (65 if radius == 1 else 65 * 64)
    parts = np.uint64(max(1, size // REFINED))
    block = max(1, REFINED // (size // len(fps)))
    for part in range(int(parts)):
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(0, len(fps), block):
            cells, owners = ball(fps[i : i + block], 1, radius)
            mine = (cells * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % parts == part
            kept.append((cells[mine], fps[i : i + block][owners[mine]]))
        cells, members = (np.concatenate(x) for x in zip(*kept))
        order = np.argsort(cells, kind="stable")
        cells, members = cells[order], members[order]
        if most % 2:
            x, y = _direct(cells, members, most)
        else:
            same = np.flatnonzero(cells[1:] == cells[:-1])
            x, y = members[same], members[same + 1]
        x, y = tree(x, y)
        a.append(x)
        b.append(y)
    return tree(np.concatenate(a), np.concatenate(b))


def _links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by grid point -> a forest of verified links; the last point waits for the next batch."""
    held_cells, held_fps = [], []

    def ready(cells, fps):
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(cells)])
        many = np.repeat(sizes > DIRECT, sizes)
        found = [_direct(cells[~many], fps[~many], most)]
        found += [_refined(fps[s : s + n], most) for s, n in zip(starts[sizes > DIRECT], sizes[sizes > DIRECT])]
        a, b = tree(*(np.concatenate(x) for x in zip(*found)))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        cells = batch.column("cell").to_numpy(zero_copy_only=False).view(np.uint64)
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(cells):
            continue
        before = np.flatnonzero(cells != cells[-1])
        cut = int(before[-1]) + 1 if len(before) else 0
        if cut or (held_cells and held_cells[-1][-1] != cells[0]):
            yield ready(np.concatenate([*held_cells, cells[:cut]]), np.concatenate([*held_fps, fps[:cut]]))
            held_cells, held_fps = [], []
        held_cells.append(cells[cut:])
        held_fps.append(fps[cut:])
    if held_cells:
        yield ready(np.concatenate(held_cells), np.concatenate(held_fps))


def links(distinct_fps: DataFrame, max_distance: int = MAX_DISTANCE, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """(a, b): a forest of links among distinct fingerprints that differ in at most ``max_distance`` bits."""
    radius = -(-max_distance // 2)
    return (
        distinct_fps.select("fp").mapInArrow(lambda b: _to_grid(b, segment_bits, radius), "cell long, fp long")
        .repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(lambda b: _links(b, max_distance), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, segment_bits: int = SEGMENT_BITS,
    row: str | None = None,
) -> DataFrame:
    """(row, doc_id, fp, root, component_id) for every row: its fingerprint, and the smallest
    fingerprint and id linked to it."""
    marked = materialize(fingerprints(docs, shingle, row), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    root = roots(materialize(links(distinct, max_distance, segment_bits).distinct(), "links"))
    rooted = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = materialize(rooted.select("fp", "root").join(smallest, "root"), "labels")
    return marked.join(labels, "fp").select("row", "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but one row of each component: that of the smallest id stays (ties: the first row).

    Rows are numbered as they are written, and the dropped ones, the fewer, meet them by number. A column that
    repeats another's name, but for case, comes out under a name of its own (``common.apart``).
    """
    docs = apart(docs, "doc_id", "text")
    held = materialize(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.monotonically_increasing_id().alias("row")),
        "documents",
    )
    found = materialize(near_duplicates(held.select("row", "record.doc_id", "record.text"), row="row", **options), "near-duplicates")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    dropped = materialize(found.select("row").join(first.select("row"), "row", "left_anti"), "dropped")
    return held.join(dropped, "row", "left_anti").select("record.*")
