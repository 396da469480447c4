"""Words one edit apart, and the form each rare spelling is taken for.

Pivotal grams: a word's bigrams are ordered from rare to common; its prefix is the first three, from which
dynamic programming picks the two disjoint ones (the pivots) that the fewest words hold. One edit spoils
at most one of two disjoint bigrams. So of two near words, the one whose prefix ends earlier in the order has a
pivot that the other's prefix holds too, at the same place, or one further in a word that is one longer, or one
before in a shorter one. The alphabet has few bigrams and a large vocabulary many words to each, so the index is
finer than bigram and place: the edit is on one side of the pivot, in one half of that side, and all the
rest is the same in both words (``rests``). Only words that agree in pivot, place and rest are compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked, values
from tidemark.session import materialize

#: Maximal runs of these are words: 90 letters once A-Z are lower-cased, so at most 8,100 bigrams.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: One of so many runs loses a letter.
SLIP = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form is so many times as frequent as the spelling it stands for.
TIMES = 5
GRAM, EDITS = 2, 1
#: Distinct words a task holds before it hands its counts on; characters of a text that are cut at once.
HELD, CHUNK = 1 << 17, 1 << 20
ROWS = 10_000


def runs(text: str) -> Iterator[list[str]]:
    """All runs of ``text``, in lists; a long text is cut between runs."""
    start = 0
    while len(text) - start > CHUNK:
        end = start + CHUNK
        rest = RUN.match(text, end)
        end = rest.end() if rest else end
        yield RUN.findall(text, start, end)
        start = end
    yield RUN.findall(text, start)


def slipped(run: str, start: int, slip: int = SLIP) -> str:
    """The run with A-Z lower-cased; one letter is lost where the checksum, begun at ``start``, says so."""
    run = run.lower() if run.isascii() else run.translate(LOWER)
    h = zlib.crc32(run.encode(), start)
    if h % slip == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def _counts(batches: Iterator[pa.RecordBatch], slip: int, least_length: int) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def hand_on():
        words, ns = list(counts), list(counts.values())
        counts.clear()
        for i in range(0, len(words), ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[i : i + ROWS], pa.string()), pa.array(ns[i : i + ROWS], pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(values(batch.column("doc_id")), values(batch.column("text"))):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for found in runs(text or ""):
                for run, n in Counter(found).items():
                    if len(run) >= least_length:
                        word = slipped(run, start, slip)
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= HELD:
                    yield from hand_on()
    yield from hand_on()


def word_counts(
    docs: DataFrame, slip: int = SLIP, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text) that are long and frequent enough.

    Counted in each task first, so a word in every document costs one row a task.
    """
    return (
        picked(docs, "doc_id", "text").mapInArrow(lambda b: _counts(b, slip, least_length), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    )


# --- grams ------------------------------------------------------------------------------------


def grams(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for word in values(batch.column("word")):
            counts.update(set(grams(word)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])


def gram_weights(words: DataFrame) -> dict[str, int]:
    """How many words hold each bigram; at most 90 x 90 of them, whatever the words."""
    counted = words.select("word").mapInArrow(_gram_counts, "gram string, n long")
    return {r["gram"]: r["n"] for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def lightest_disjoint(places: list[tuple[int, int]], k: int = EDITS + 1) -> list[int]:
    """The places of ``k`` bigrams that do not overlap and weigh least; ``places`` are (place, weight), by place.

    best[c] over the places so far: the lightest choice of c of them, built from the best of c - 1 among
    those that end before.
    """
    best = [[(0, ())] + [None] * k]
    for i, (at, weight) in enumerate(places):
        before = i
        while before and places[before - 1][0] > at - GRAM:
            before -= 1
        row = list(best[-1])
        for c in range(1, k + 1):
            if best[before][c - 1] is not None:
                sum_, chosen = best[before][c - 1]
                taken = (sum_ + weight, (*chosen, at))
                row[c] = taken if row[c] is None else min(row[c], taken)
        best.append(row)
    return list(best[-1][k][1])


def signature(word: str, weights: dict[str, int]):
    """(last, prefix, pivots) of a word: bigrams with their places.

    Bigrams go by weight, letters, place. The prefix is the first ``GRAM * EDITS + 1`` of them, and the
    same bigram as the last of them one place further, where an inserted letter may have moved it.
    """
    order = sorted((weights[g], g, i) for i, g in enumerate(grams(word)))
    head = order[: GRAM * EDITS + 1]
    last = head[-1]
    pivots = lightest_disjoint(sorted((i, w) for w, _, i in head))
    prefix = [(g, i) for _, g, i in head]
    moved = (last[1], last[2] + 1)
    if word[moved[1] : moved[1] + GRAM] == last[1]:
        prefix.append(moved)
    return last, prefix, [(word[i : i + GRAM], i) for i in pivots]


def rests(word: str, at: int, longer: int) -> Iterator[tuple[str, int, bool, str]]:
    """(region, place, empty, rest): what a near word that is ``longer`` has in common with ``word``.

    Both hold the bigram at ``at``, the near word at ``place``. The edit is before it or behind it, there in the
    first or the second half as the near word's letters count: the letters outside that region are the
    same in both. A region without letters can only be where the near word misses one.
    """
    size, length = len(word), len(word) + longer
    place = at + longer
    half = place // 2
    if place >= 0:
        yield "a", place, half == 0, word[size - (length - half) :] if longer <= half else ""
        yield "b", place, place == half, f"{word[:half]} {word[at:]}"
    behind = length - at - GRAM
    half = behind // 2
    if behind >= 0:
        yield "c", at, half == 0, f"{word[: at + GRAM]} {word[size - (behind - half) :]}"
        yield "d", at, behind == half, word[: at + GRAM + half]


def _key(region: str, place: int, rest: str, length: int) -> int:
    """Place, length and rest in one number; words whose rests differ seldom share one, and are compared then."""
    return length << 32 | zlib.crc32(f"{region}{place} {rest}".encode())


def index_keys(word: str, prefix: list[tuple[str, int]]) -> set[int]:
    return {_key(region, place, rest, len(word)) for _, i in prefix for region, place, _, rest in rests(word, i, 0)}


def probe_keys(word: str, pivots: list[tuple[str, int]]) -> set[int]:
    return {
        _key(region, place, rest, len(word) + longer)
        for _, i in pivots for longer in (0, 1, -1)
        for region, place, empty, rest in rests(word, i, longer) if longer < 0 or not empty
    }


_KEYED = pa.schema([
    ("key", pa.int64()), ("last", pa.int64()), ("word", pa.string()), ("n", pa.int64()),
])


def _signatures(batches: Iterator[pa.RecordBatch], weights: dict[str, int], probe: bool) -> Iterator[pa.RecordBatch]:
    """A row for each key a word is found by, or with ``probe``, looks for. ``last``: where its prefix ends."""
    rank = {g: i for i, (_, g) in enumerate(sorted((w, g) for g, w in weights.items()))}
    rows: list[tuple] = []
    for batch in batches:
        for word, n in zip(values(batch.column("word"), 1024), values(batch.column("n"), 1024)):
            (_, gram, place), prefix, pivots = signature(word, weights)
            last = rank[gram] << 32 | place
            rows += [(key, last, word, n) for key in (probe_keys(word, pivots) if probe else index_keys(word, prefix))]
            if len(rows) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KEYED.types)], schema=_KEYED)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KEYED.types)], schema=_KEYED)


def candidates(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): the pairs to compare, of ``words`` (word, n; no word twice)."""
    weights = words.sparkSession.sparkContext.broadcast(gram_weights(words))
    made = "key long, last long, word string, n long"
    index = words.mapInArrow(lambda b: _signatures(b, weights.value, False), made)
    probes = words.mapInArrow(lambda b: _signatures(b, weights.value, True), made)
    index = index.select("key", *[F.col(c).alias(f"other_{c}") for c in ("last", "word", "n")])
    earlier = "last < other_last OR (last = other_last AND word < other_word)"
    return probes.join(index, "key").where(earlier).select("word", "n", F.col("other_word").alias("other"), "other_n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two of ``words`` (word, n; no word twice) one edit apart, both ways round."""
    # one edit at most: the comparison stays within a band of the two words
    pairs = candidates(words).where(F.levenshtein("word", "other", EDITS) == EDITS).distinct()
    return pairs.select("word", "n", F.col("other").alias("near"), F.col("other_n").alias("near_n")).unionAll(
        pairs.select("other", "other_n", "word", "n")
    )


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of a word end. ``forms`` (word, form) hold the words that have one.

    A form is several times as frequent as its word, so forms make no circle and their chains are
    as long as the logarithm of the largest count; each round doubles the step.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialize(step, "roots")
        reached = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return reached


def group_variants(docs: DataFrame, times: int = TIMES, **words) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text); see ``word_counts``.

    The form is the most frequent near word (ties: the first in code-point order) if it is ``times`` as frequent
    as the word, else null; the root is where forms lead, the word itself without one. Null and empty texts have
    no words; a null id counts as an empty one; repeated rows count each; other columns are not read, whatever
    their names. Without words the result is empty.
    """
    words = materialize(word_counts(docs, **words), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    known = words.join(best, "word", "left").withColumn(
        "form", F.when(-F.col("best.n") >= times * F.col("n"), F.col("best.near")))
    known = materialize(known.select(
        "word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), -F.col("best.n")).alias("form_n"),
    ), "forms")
    roots = _rooted(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
