"""Token counts of whole texts, without materialising token ids.

Each distinct pre-token is cut into pieces once, in a distributed table. A document's count is the
sum over its pre-tokens of frequency times pieces:

1. one pass counts the pre-tokens of the corpus, pre-aggregated in each task;
2. ``piece_table`` counts the pieces of each distinct pre-token;
3. a second pass takes each document's pre-token frequencies and joins them to that table.

Pre-tokens that make up at least one part in ``HEAVY_PARTS`` of the corpus are by that definition
at most ``HEAVY_PARTS``; these, the only ones whose join key could be hot, are broadcast, so that a
document's heavy pre-tokens are summed where they are read. All others go through a shuffled join.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows each give a row; a
null id stays null; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UNUSUAL, picked, tokenizer, values, vocabulary_path
from tidemark.session import materialize

VOCABULARY = "word_bpe_49k.json"
HEAVY_PARTS = 1 << 20
#: Distinct words or pre-tokens a task holds before it hands them on.
HELD = 300_000
ROWS = 20_000


class Cutter:
    """Cuts texts into the pre-tokens of a word vocabulary (split pattern in its file, no prefix space)."""

    def __init__(self, vocabulary: str):
        import regex

        self.library = tokenizer(vocabulary)
        with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
            spec = json.load(file)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None

    def parts(self, text: str) -> tuple[list[str], list[str]]:
        """Words still to be cut by ``pieces_of``, and pre-tokens that are cut already.

        No pre-token spans white space, so a word's pre-tokens do not depend on its neighbours.
        """
        cut, words = [], []
        segments = [text]
        if "<|" in text and self.special:
            cut = self.special.findall(text)
            segments = self.special.split(text)
        for segment in segments:
            if UNUSUAL.search(segment):
                normal = self.library.normalizer.normalize_str(segment)
                cut += [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]
            else:
                words += segment.split()
        return words, cut

    def pre_tokens(self, word: str) -> list[str]:
        return self.pattern.findall(word.lower())


def piece_counter(vocabulary: str):
    """Counts the pieces of pre-tokens, which are taken as they are: not normalised or split again."""
    from tokenizers import Tokenizer

    with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = None
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    bare = Tokenizer.from_str(json.dumps(spec))
    return lambda pre_tokens: [len(e.ids) for e in bare.encode_batch(pre_tokens, add_special_tokens=False)]


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    cutter, words, cut = Cutter(vocabulary), Counter(), Counter()

    def hand_on():
        for word, n in words.items():
            for pre_token in cutter.pre_tokens(word):
                cut[pre_token] += n
        keys, counts = list(cut), list(cut.values())
        words.clear()
        cut.clear()
        for i in range(0, len(keys), ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[i : i + ROWS], pa.string()), pa.array(counts[i : i + ROWS], pa.int64())],
                ["pre_token", "n"],
            )

    for batch in batches:
        for text in values(batch.column("text")):
            if text:
                some_words, some_cut = cutter.parts(text)
                words.update(some_words)
                cut.update(some_cut)
                if len(words) + len(cut) > HELD:
                    yield from hand_on()
    yield from hand_on()


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    count = piece_counter(vocabulary)
    for batch in batches:
        pieces = count(batch.column("pre_token").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("pre_token"), batch.column("n"), pa.array(pieces, pa.int64())], ["pre_token", "n", "pieces"]
        )


def piece_table(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(pre_token, n, pieces) for every distinct pre-token of the corpus: how often, how many pieces."""
    counted = (
        picked(texts, "text").mapInArrow(lambda b: _frequencies(b, vocabulary), "pre_token string, n long")
        .groupBy("pre_token").agg(F.sum("n").alias("n"))
    )
    return counted.mapInArrow(lambda b: _pieces(b, vocabulary), "pre_token string, n long, pieces long")


def _documents(batches: Iterator[pa.RecordBatch], vocabulary: str, heavy: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """A row for each document with the sum over its heavy pre-tokens, and one for each other pre-token.

    The first kind gets a key no pre-token can have (it holds a space), so it joins nothing and is spread.
    """
    cutter = Cutter(vocabulary)
    known: dict[str, int] = {}  # words all of whose pre-tokens are heavy
    first = TaskContext.get().partitionId() << 33
    out: list[list] = [[], [], [], [], []]

    def hand_on():
        arrays = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()))]
        for column in out:
            column.clear()
        return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "n_bytes", "pre_token", "n"])

    def add(*values):
        for column, value in zip(out, values):
            column.append(value)

    for batch in batches:
        for doc_id, text in zip(values(batch.column("doc_id")), values(batch.column("text"))):
            total, light = 0, Counter()
            words, cut = cutter.parts(text or "")
            for word, n in Counter(words).items():
                pieces = known.get(word)
                if pieces is not None:
                    total += n * pieces
                    continue
                pre_tokens = cutter.pre_tokens(word)
                pieces = 0
                for pre_token in pre_tokens:
                    if pre_token in heavy:
                        pieces += heavy[pre_token]
                    else:
                        light[pre_token] += n
                total += n * pieces
                if all(p in heavy for p in pre_tokens):
                    if len(known) >= HELD:
                        known.clear()
                    known[word] = pieces
            for pre_token, n in Counter(cut).items():
                if pre_token in heavy:
                    total += n * heavy[pre_token]
                else:
                    light[pre_token] += n
            add(first, doc_id, len((text or "").encode()), f" {first}", total)
            for pre_token, n in light.items():
                add(first, doc_id, 0, pre_token, n)
            first += 1
            if len(out[0]) >= ROWS:
                yield hand_on()
    yield hand_on()


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, heavy_parts: int = HEAVY_PARTS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs`` (doc_id long, text string)."""
    spark = docs.sparkSession
    pieces = materialize(piece_table(docs, vocabulary), "pieces")
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    is_heavy = F.col("n") * heavy_parts >= total
    heavy = {r["pre_token"]: r["pieces"] for r in pieces.where(is_heavy).select("pre_token", "pieces").toLocalIterator()}
    heavy = spark.sparkContext.broadcast(heavy)
    rows = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _documents(b, vocabulary, heavy.value),
        "row long, doc_id long, n_bytes long, pre_token string, n long",
    )
    light = pieces.where(~is_heavy).select("pre_token", "pieces")
    return (
        rows.join(light, "pre_token", "left")
        .groupBy("row", "doc_id")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
