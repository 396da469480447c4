"""Token sequences written in training order, in shards of fixed stride.

Every document's ids, with an end token, are cut into sequences of up to ``LENGTH`` ids, padded to
that length. The sequences are numbered, and a keyed Feistel network permutes the numbers: on a
domain of 2 to an even number of bits, walking along the cycle until it lands below the count, it is
a permutation of exactly the sequences' numbers, computed for each row alone. The result is the
sequence's global slot. Slots are cut into ranges; each range is one partition and one shard. A shard holds
records of the same stride in order of their slots, each a short header that tells whose sequence it is, and the
ids: record k of shard s is the sequence at slot s * records + k. ``FRAME`` records make a frame, which is compressed on
its own, and the file, the one in folder ``shard=s``, ends with the places of its frames. So a reader starts, or
resumes, at any step by arithmetic and one look at that list, unpacks a frame and reads on from there.

The files are written through Spark's committed output (its text format writes a row's bytes as they are, then a
closing byte), so that a task that runs again leaves no half-written shard, on any store Spark writes to.
Sequences travel to their shard in compressed packs, one for each shard and input batch; a shard is put together in one
buffer of fixed size. Neither depends on the data: slots are uniform.

Defined cases: a null or empty text is the end token alone; null ids and repeated rows are
documents like any other; other columns are not read; an empty table gives no shards. A vocabulary
of over 65,536 ids needs four bytes an id. Numbers, and so slots, depend on how the input is split
into partitions; once written, they stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_tokens import encoder
from tidemark.llm.common import numbered, picked, values
from tidemark.session import fresh_path

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 512
END = 1
PAD = 0
KEY = 42
ROUNDS = 6
#: Sequences in a shard.
RECORDS = 1 << 13
#: Records that are compressed, and read, together.
FRAME = 1 << 8
PLACE = np.dtype("<u4")
ID = np.dtype("<u2")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread function of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feistel(numbers: np.ndarray, count: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of ``numbers``: a permutation of 0 .. count - 1 that depends on ``key`` alone."""
    half = max(1, -(-max(1, (count - 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mixed(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (_mixed(right + k) & mask)
        x = (left << shift) | right
        out[walking] = x
        walking = walking[x >= count]
    return out.astype(np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], vocabulary: str, length: int, end: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary).ids
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for doc_id, text in zip(values(batch.column("doc_id")), values(batch.column("text"))):
            ids = np.append(encode(text), np.uint32(end))
            if len(ids) and ids.max() > np.iinfo(ID).max:
                raise ValueError("ids of this vocabulary do not fit the record")
            ids = ids.astype(ID)
            for start in range(0, len(ids), length):
                piece = ids[start : start + length]
                for column, value in zip(out, (doc_id, start, len(piece), piece.tobytes())):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            ["doc_id", "start", "n_tokens", "ids"],
        )


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the pieces of every document, unpadded."""
    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _sequences(b, vocabulary, length, end), "doc_id long, start long, n_tokens int, ids binary"
    )


#: What a record begins with.
HEADER = np.dtype([("record", "<u4"), ("n_tokens", "<u4"), ("start", "<i8"), ("doc_id", "<i8"), ("known", "<u1")])


def _to_packs(batches: Iterator[pa.RecordBatch], count: int, key: int, records: int) -> Iterator[pa.RecordBatch]:
    """One compressed pack for each shard that a batch has sequences for: headers, then ids."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        if not batch.num_rows:
            continue
        slots = feistel(batch.column("number").to_numpy(), count, key)
        order = np.argsort(slots)
        slots = slots[order]
        batch = batch.take(pa.array(order))
        doc_id = batch.column("doc_id")
        headers = np.zeros(len(slots), HEADER)
        headers["record"] = slots % records
        headers["n_tokens"] = batch.column("n_tokens").to_numpy()
        headers["start"] = batch.column("start").to_numpy()
        headers["doc_id"] = doc_id.fill_null(0).to_numpy()
        headers["known"] = doc_id.is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("ids").to_pylist()
        shards = slots // records
        first = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])
        packs = [
            squeeze(np.uint32(b - a).tobytes() + headers[a:b].tobytes() + b"".join(ids[a:b]))
            for a, b in zip(first, np.r_[first[1:], len(slots)])
        ]
        yield pa.RecordBatch.from_arrays([pa.array(shards[first]), pa.array(packs, pa.binary())], ["shard", "pack"])


def _assemble(shard: int, packs: Iterator[bytes], count: int, records: int, length: int, pad: int):
    """The shard's records in order of their slots, and who they are."""
    import zstandard

    loosen = zstandard.ZstdDecompressor().decompress
    n = min(records, count - shard * records)
    body, index = np.full((n, length), pad, ID), np.zeros(n, HEADER)
    for pack in packs:
        data = loosen(pack)
        k = int(np.frombuffer(data, np.uint32, 1)[0])
        headers = np.frombuffer(data, HEADER, k, 4)
        ids = np.frombuffer(data, ID, offset=4 + k * HEADER.itemsize)
        at = headers["record"]
        index[at] = headers
        body[np.repeat(at, headers["n_tokens"]), _counting(headers["n_tokens"])] = ids
    return body, index


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: header and ids."""
    return HEADER.itemsize + length * ID.itemsize


def _frames(index: np.ndarray, body: np.ndarray) -> Iterator[bytes]:
    """A shard's frames, each a row of its file, and the row that ends it: the frames' places, their end, their number."""
    import zstandard

    squeeze, places = zstandard.ZstdCompressor(level=3).compress, [0]
    for at in range(0, len(index), FRAME):
        frame = squeeze(b"".join(h.tobytes() + r.tobytes() for h, r in zip(index[at : at + FRAME], body[at : at + FRAME])))
        places.append(places[-1] + len(frame) + 1)  # the closing byte
        yield frame
    yield np.array([*places, len(places) - 1], PLACE).tobytes()


def _to_shards(batches: Iterator[pa.RecordBatch], count: int, records: int, length: int, pad: int) -> Iterator[pa.RecordBatch]:
    """The packs of one shard -> the rows of its file in order."""
    shard, packs = None, []
    for batch in batches:
        for shard, pack in zip(batch.column("shard").to_pylist(), batch.column("pack").to_pylist()):
            packs.append(pack)
    if shard is None:
        return
    body, index = _assemble(shard, packs, count, records, length, pad)
    rows = list(_frames(index, body))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), shard)), pa.array(np.arange(len(rows))), pa.array(rows, pa.binary())], ["shard", "row", "value"])


def write_shards(
    docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END,
    pad: int = PAD, key: int = KEY, records: int = RECORDS,
) -> str:
    """Writes the shards; the folder they are in, by default one in the shared folder."""
    path = path or fresh_path(docs.sparkSession, "token-shards")
    rows, count = numbered(sequences(docs, vocabulary, length, end), "sequences")
    shards = max(1, -(-count // records))
    packs = rows.select("number", "doc_id", "start", "n_tokens", "ids").mapInArrow(
        lambda b: _to_packs(b, count, key, records), "shard long, pack binary"
    )
    (
        packs.repartitionById(shards, F.col("shard").cast("int"))  # a range of slots each
        .mapInArrow(lambda b: _to_shards(b, count, records, length, pad), "shard long, row long, value binary")
        .sortWithinPartitions("shard", "row")  # as they come: no other order is put upon them
        .select("shard", F.col("value").cast("string").alias("value"))
        .write.partitionBy("shard").text(path)
    )
    return path


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content binary) of the shards at ``path``, a row each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", "shard=([0-9]+)", 1).cast("long").alias("shard"), "content")


def _unpacked(frame: bytes, length: int) -> np.ndarray:
    """The records of a frame, a row of bytes each."""
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8).reshape(-1, stride(length))


def read_from(
    spark: SparkSession, path: str, slot: int, n: int, length: int = LENGTH, records: int = RECORDS
) -> Iterator[tuple[int, bytes]]:
    """(slot, ids) of the ``n`` records from ``slot`` on, or up to the end, read one after another at their places.

    Of a shard the list of places and the frames wanted are read, of others nothing.
    """
    hadoop, end = spark._jvm.org.apache.hadoop.fs, slot + n
    while slot < end:
        shard, record = divmod(slot, records)
        pattern = hadoop.Path(f"{path}/shard={shard}/part-*")
        system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = system.globStatus(pattern)
        if not len(found):
            return
        stream = system.open(found[0].getPath())

        def take(at: int, size: int, stream=stream) -> bytes:
            stream.seek(at)
            return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size))

        try:
            # the last row: the places of the frames, their end, their number, and its closing byte
            tail = found[0].getLen() - PLACE.itemsize - 1
            frames = int(np.frombuffer(take(tail, PLACE.itemsize), PLACE)[0])
            width = (frames + 1) * PLACE.itemsize
            places = np.frombuffer(take(tail - width, width), PLACE).tolist()
            for frame in range(record // FRAME, frames):
                rows = _unpacked(take(places[frame], places[frame + 1] - places[frame] - 1), length)
                for row in rows[record - frame * FRAME :]:
                    if slot >= end:
                        return
                    yield slot, row[HEADER.itemsize :].tobytes()
                    slot, record = slot + 1, record + 1
        finally:
            stream.close()
        if slot % records:
            return  # the last shard ends before its range does


def _digest(batches: Iterator[pa.RecordBatch], length: int, records: int) -> Iterator[pa.RecordBatch]:
    names = ["slot", "shard", "record", "doc_id", "start", "n_tokens", "record_crc32"]
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), values(batch.column("content"), 1)):
            frames = int(np.frombuffer(content[-PLACE.itemsize - 1 : -1], PLACE)[0])
            at = len(content) - 1 - (frames + 2) * PLACE.itemsize
            places = np.frombuffer(content[at : at + (frames + 1) * PLACE.itemsize], PLACE).tolist()
            for frame, (a, b) in enumerate(zip(places, places[1:])):
                rows = _unpacked(content[a : b - 1], length)
                who = np.frombuffer(rows[:, : HEADER.itemsize].tobytes(), HEADER)
                place = frame * FRAME + np.arange(len(rows))
                crc = [zlib.crc32(row[HEADER.itemsize :]) for row in rows]
                columns = [
                    pa.array(shard * records + place), pa.array(np.full(len(rows), shard)), pa.array(who["record"].astype(np.int64)),
                    pa.array(who["doc_id"].copy(), mask=who["known"] == 0), pa.array(who["start"].copy()),
                    pa.array(who["n_tokens"].astype(np.int64)), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)


def digest(spark: SparkSession, path: str, length: int = LENGTH, records: int = RECORDS) -> DataFrame:
    """One row for each sequence written to ``path``: its slot, where that lies, and the checksum of its ids as written."""
    return shard_files(spark, path).mapInArrow(
        lambda b: _digest(b, length, records),
        "slot long, shard long, record long, doc_id long, start long, n_tokens long, record_crc32 long",
    )
