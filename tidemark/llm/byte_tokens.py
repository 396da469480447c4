"""Token ids of whole texts by a byte-level vocabulary, as the ``tokenizers`` library gives them."""

from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

import numpy as np

from tidemark.llm.common import UNUSUAL, tokenizer, vocabulary_path

#: Runs of white space this long are slow or fail in the rank encoder's pattern.
LONG_SPACE = re.compile(r"\s{2000}")


class Encoder:
    """Uses the same vocabulary's rank file where there is one, several times faster, for usual text.

    Texts with characters beyond the Latin letters, or with very long white space, go through the
    ``tokenizers`` library itself.
    """

    def __init__(self, vocabulary: str):
        path = vocabulary_path(vocabulary)
        self.library, self.ranked = tokenizer(vocabulary), None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            with open(path, encoding="utf-8") as file:
                special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
            self.ranked = tiktoken.Encoding(
                "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special
            )

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.ranked is None or UNUSUAL.search(text) or LONG_SPACE.search(text):
            found = self.library.encode(text, add_special_tokens=False).ids
        elif "<|" in text:
            found = self.ranked.encode(text, allowed_special="all")
        else:
            found = self.ranked.encode_ordinary(text)
        return np.array(found, np.uint32)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One in each worker."""
    return Encoder(vocabulary)
