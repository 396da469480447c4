"""Packing documents into training sequences of equal cost.

A document's cost is linear in its tokens plus quadratic for the attention within each of its
pieces. Documents are packed in groups of bounded size, in the tasks that read them: what fills
whole sequences is cut off first; the rest, in descending order of tokens, goes to the sequence of
lowest cost with room for it. A group opens only as many sequences as its tokens fill, so when no
sequence has room for a whole rest it is cut into the cheapest ones. A group thus pads fewer tokens
than one sequence holds, and costs stay even.

Nothing is shuffled and no group depends on a key, so no row can make a group hot; a document longer
than a group makes a group of its own.

Defined cases: a null or empty text is the end token alone; null ids and repeated rows are documents
like any other; other columns are not read; an empty table gives no rows. Sequence ids depend on how
the input is split into partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_tokens import encoder
from tidemark.llm.common import picked, values

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 2048
END = 1
#: Cost of a piece of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 2048
#: Tokens packed together; bounds what a task holds.
GROUP = 1 << 21
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def cost(n):
    return n + n * n / QUADRATIC


def pack(lengths: list[int], size: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a group.

    Sequences are numbered from 0 and hold up to ``size`` tokens each.
    """
    rests, sequence = [], 0
    for i, n in enumerate(lengths):
        whole = n // size
        for k in range(whole):
            yield i, k * size, size, sequence, 0
            sequence += 1
        if n % size:
            rests.append((n % size, i, whole * size))
    open_to = -(-sum(r[0] for r in rests) // size)
    room = np.full(open_to, size)
    costs = np.zeros(open_to)
    for n, i, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                at, taken = fits[np.argmin(costs[fits])], n
            else:
                fits = np.flatnonzero(room)
                at = fits[np.argmin(costs[fits])]
                taken = int(room[at])
            yield i, start, taken, sequence + int(at), int(size - room[at])
            room[at] -= taken
            costs[at] += cost(taken)
            n, start = n - taken, start + taken


def _packed(batches: Iterator[pa.RecordBatch], vocabulary: str, size: int, end: int, group: int):
    encode = encoder(vocabulary).ids
    sequence = TaskContext.get().partitionId() << 40
    doc_ids, ids, held = [], [], 0

    def hand_on():
        nonlocal sequence, held
        columns, most = [[] for _ in range(7)], sequence - 1
        for i, start, n, at, offset in pack([len(x) for x in ids], size):
            piece = ids[i][start : start + n]
            crc = zlib.crc32(piece.astype("<u4").tobytes())
            row = (doc_ids[i], start, n, crc, len(ids[i]), sequence + at, offset)
            for column, value in zip(columns, row):
                column.append(value)
            most = max(most, sequence + at)
        sequence, held = most + 1, 0
        doc_ids.clear()
        ids.clear()
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in batches:
        for doc_id, text in zip(values(batch.column("doc_id")), values(batch.column("text"))):
            ids.append(np.append(encode(text), np.uint32(end)))
            doc_ids.append(doc_id)
            held += len(ids[-1])
            if held >= group:
                yield hand_on()
    if ids:
        yield hand_on()


def pack_documents(
    docs: DataFrame, vocabulary: str = VOCABULARY, size: int = LENGTH, end: int = END, group: int = GROUP
) -> DataFrame:
    """One row for each piece: its document, where it starts there, and its place in a sequence."""
    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _packed(b, vocabulary, size, end, group), SCHEMA
    )
