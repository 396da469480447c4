"""Documents rewritten for fill-in-middle training: prefix, suffix and middle change places.

A text's cut positions are counted in units (code points, or lines) while its bytes are what is cut.
``Boundaries`` holds the byte offsets at which a unit may begin or end, in containers of 2^16 offsets as
a Roaring bitmap does: each is an array, a bitmap or a list of runs, whichever is smallest, and the
containers' cumulative cardinalities lead to the one that holds the k-th boundary. Text of one byte
a character is one run a container, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked, values

#: Offsets of a container.
CONTAINER = 1 << 16
#: Bytes of a bitmap container.
BITMAP_BYTES = CONTAINER // 8
#: Marks before the prefix, the suffix and the middle. A text that holds one stays as it is.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, so many are rewritten; of a hundred of those, so many with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
UNITS = ("char", "line")
#: Bytes of output held before they are handed on.
HELD = 1 << 23


class Array:
    """Few offsets: as they are."""

    def __init__(self, marks: np.ndarray):
        self.offsets = np.flatnonzero(marks).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class Bitmap:
    """Many scattered offsets: one bit each, with the number of bits before each word of 64."""

    def __init__(self, marks: np.ndarray):
        padded = np.zeros(CONTAINER, bool)
        padded[: len(marks)] = marks
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


class Runs:
    """Stretches of consecutive offsets: their starts, with the number of offsets before each."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        self.starts = starts
        self.before = np.concatenate([[0], np.cumsum(ends - starts)])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(marks: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest container of the marked offsets: two bytes an offset, 8 KB, or four bytes a run."""
    edges = np.flatnonzero(np.diff(marks, prepend=False, append=False))
    size = int(np.count_nonzero(marks))
    array_bytes, run_bytes = 2 * size, 2 * len(edges)
    if run_bytes <= min(array_bytes, BITMAP_BYTES):
        return Runs(edges[::2], edges[1::2])
    return Array(marks) if array_bytes <= BITMAP_BYTES else Bitmap(marks)


class Boundaries:
    """The offsets of ``data`` at which a unit begins, and its end."""

    def __init__(self, data: bytes, unit: str = "char"):
        self.end = len(data)
        self.containers: list[Array | Bitmap | Runs] = []
        before = [0]
        octets = np.frombuffer(data, np.uint8)
        for start in range(0, len(octets), CONTAINER):
            if unit == "char":  # all octets but those that continue a code point
                marks = (octets[start : start + CONTAINER] & 0xC0) != 0x80
            else:  # what follows a line feed
                marks = np.empty(min(CONTAINER, len(octets) - start), bool)
                marks[0] = start == 0 or octets[start - 1] == 10
                marks[1:] = octets[start : start + len(marks) - 1] == 10
            self.containers.append(container(marks))
            before.append(before[-1] + int(np.count_nonzero(marks)))
        self.before = np.array(before)

    @property
    def units(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """Where the first ``k`` units end."""
        if k == self.units:
            return self.end
        place = int(np.searchsorted(self.before, k, "right")) - 1
        return place * CONTAINER + self.containers[place].select(k - int(self.before[place]))


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four draws below 2^32, from the seed and the id alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def rewritten(
    data: bytes, doc_id: int | None, seed: int = 1, unit: str = "char", rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> tuple[bytes, int, str, int | None, int | None]:
    """(output, units, form, units of the prefix, units of the middle) of one text."""
    first, second, form, order = draws(doc_id, seed)
    cuts = Boundaries(data, unit)
    n = cuts.units
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not data or form % 100 >= rate or any(m in data for m in marks):
        return data, n, "plain", None, None
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = cuts.select(low), cuts.select(high)
    prefix, suffix, middle = marks[0] + data[:a], marks[1] + data[b:], marks[2] + data[a:b]
    if order % 100 < suffix_first:
        return suffix + prefix + middle, n, "spm", low, high - low
    return prefix + suffix + middle, n, "psm", low, high - low


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("output", pa.binary()), ("n", pa.int64()), ("form", pa.string()),
    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
])


def _rewrite(batches: Iterator[pa.RecordBatch], **how) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for doc_id, data in zip(values(batch.column("doc_id"), 64), values(batch.column("data"), 64)):
            rows.append((doc_id, *rewritten(data, doc_id, **how)))
            held += len(rows[-1][1])
            if held >= HELD or len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)


def transform(
    docs: DataFrame, seed: int = 1, unit: str = "char", rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """(doc_id, output, n, form, prefix_chars, middle_chars) for every row of ``docs`` (doc_id long, text string).

    A null text is empty, and an empty one stays plain. Rows of one id and text come out alike; other columns
    are not read, whatever their names. ``n`` and the lengths are in units; lengths of a plain row are null.
    Nothing is shuffled; a document takes memory for a few copies of itself.
    """
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    how = {"seed": seed, "unit": unit, "rate": rate, "suffix_first": suffix_first}
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    out = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text).mapInArrow(
        lambda b: _rewrite(b, **how),
        "doc_id long, output binary, n long, form string, prefix_chars long, middle_chars long",
    )
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: each mark occurs once in it, or it is plain."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
