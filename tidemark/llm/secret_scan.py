"""Secrets in texts: by their shape, and by how badly a vocabulary compresses them.

Three patterns find assigned passwords and tokens, access keys and long hexadecimal strings. What they
do not know is found by token efficiency: a vocabulary learnt from text and code has long pieces for what
people write, so a string that needs a token for every one or two characters was not written but drawn.
Known digests and identifiers (numbered names, dates, UUIDs, paths) look alike and are left out first.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked, values, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"

# The patterns of the base, and the fewest characters that count.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGNED = 6
#: Runs too short for their kind need not be matched: a run's first match is its longest.
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
#: Kinds in the order of spans that start together.
BASE, DRAWN = ("assign", "access", "hex"), "random"

#: Strings that token efficiency looks at: whole runs of the letters of Base64, its URL form and hexadecimals.
#: Runs that go on in other letters are words of other languages.
STRING = re.compile(r"(?<![\w+/-])[A-Za-z0-9+/_-]{20,}+={0,2}(?!\w)")
#: At most so many characters a token; of 20 to 40 drawn characters of Base64 or 36 letters, 99.9 % are within it.
RATIO = 2.0
#: Characters that are cut into tokens together.
PIECE = 512

#: Hexadecimal digits of common digests, by length: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile("[0-9a-fA-F]+")
#: Integrity values of web pages and locks: the digest's name, then Base64.
_NAMED_DIGEST = re.compile("(?i:sha|md)[0-9]{1,3}-.*", re.DOTALL)
_UUID = re.compile("[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: A part of a name, date or number: letters alone, digits alone, or a short mixture such as v2 or x86.
_NAME_PART = re.compile("[A-Za-z]*|[0-9]*|[A-Za-z0-9]{1,4}")
_URL = re.compile(r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s?#\"'<>]+")


def identifier(string: str) -> bool:
    """A digest of a known length or name, a UUID, or parts that are words and numbers."""
    bare = string.rstrip("=")
    if _HEX_ONLY.fullmatch(bare) and len(bare) in DIGEST_LENGTHS:
        return True
    if _NAMED_DIGEST.fullmatch(bare) or _UUID.fullmatch(bare):
        return True
    return all(_NAME_PART.fullmatch(part) for part in re.split("[+/_-]", bare))


@lru_cache(maxsize=2)
def vocabulary(name: str):
    """The ranks of a tiktoken vocabulary, loaded once in each worker."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def efficiency(string: str, name: str = VOCABULARY) -> float:
    """Characters a token, in pieces of ``PIECE`` characters."""
    encode = vocabulary(name).encode_ordinary
    return len(string) / sum(len(encode(string[i : i + PIECE])) for i in range(0, len(string), PIECE))


def spans(text: str, name: str = VOCABULARY, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind. A drawn string that touches a base span is that one."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    order = (*BASE, DRAWN)
    found.sort(key=lambda s: (s[1], order.index(s[0])))
    drawn, base, urls, address = [], 0, _URL.finditer(text), None
    reach = _reaches(found)
    for match in STRING.finditer(text):
        string, (start, end) = match.group(), match.span()
        if not (any(c.isdigit() for c in string) and any(c.isalpha() for c in string)) or identifier(string):
            continue
        while base < len(found) and found[base][1] < end:
            base += 1
        if base and reach[base - 1] > start:
            continue
        while address is not False and (address is None or address.end() <= start):
            address = next(urls, False)
        if address and address.start() <= start:
            continue  # part of an address
        if efficiency(string, name) <= ratio:
            drawn.append((DRAWN, start, end))
    return sorted(found + drawn, key=lambda s: (s[1], order.index(s[0])))


def _reaches(found: list[tuple[str, int, int]]) -> list[int]:
    """The furthest end among each span and those before it."""
    out, far = [], 0
    for _, _, end in found:
        far = max(far, end)
        out.append(far)
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], name: str, ratio: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t or "", name, ratio)]
               for t in values(batch.column("text"), 64)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(_SPAN))], ["doc_id", "spans"])


def scan(docs: DataFrame, name: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) for every row of ``docs`` (doc_id, text).

    A null or empty text has none. Repeated rows are scanned alike; other columns are not read, whatever
    their names. Nothing is shuffled.
    """
    docs = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(
        lambda b: _scan(b, name, ratio), "doc_id long, spans array<struct<kind string, start bigint, end bigint>>"
    )


def listed(found: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """What ``scan`` found as counts, a checksum of the base spans, and the list of all."""
    def kept(wanted: list[str]) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(wanted))

    base = kept(list(BASE))
    counts = [F.size(kept([kind])).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
