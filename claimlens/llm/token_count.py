"""Token counts by heap-and-linked-list byte-pair merging (operator 10).

A text is cut at added tokens, then into words by the tokenizer's pattern.
A word starts as one symbol a byte in a linked list; a heap holds the rank of
every adjacent pair that has a merge rule. The lowest rank (leftmost first) is
popped and merged until no pair is left. The word's count is its bytes minus
its merges; no token ids are made. Each distinct word is merged once.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import freed

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: Longer texts are walked match by match instead of listing all words.
_LONG = 4_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself if printable, else the next free code from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    code = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(code[b]) for b in range(256)]


class MergeCounter(dict):
    """Word -> its number of tokens; cleared when it holds ``limit`` words."""

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        number = {s: i for i, s in enumerate(symbols)}      # symbol -> number, bytes first
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[number[a], number[b]] = (rank, number.setdefault(a + b, len(number)))
        self.limit = limit
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.added_texts = added

    def merged(self, word: str) -> int:
        """Tokens of one word: bytes minus merges."""
        at = list(word.encode("utf-8", "surrogatepass"))
        n = len(at)
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            m = merges.get((at[i], at[i + 1]))
            if m:
                heap.append((m[0], i, at[i], at[i + 1], m[1]))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i]
            if at[i] != a or j < 0 or at[j] != b:           # one of them is gone
                continue
            at[i], at[j] = c, -1
            count -= 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                m = merges.get((c, at[k]))
                if m:
                    heapq.heappush(heap, (m[0], i, c, at[k], m[1]))
            h = before[i]
            if h >= 0:
                m = merges.get((at[h], c))
                if m:
                    heapq.heappush(heap, (m[0], h, at[h], c, m[1]))
        return count

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = self.merged(word)
        if len(word) <= 64:
            self[word] = n
        return n

    def _plain(self, text: str) -> int:
        if len(text) > _LONG:
            return sum(self[m.group()] for m in self.pattern.finditer(text))
        return sum(map(self.__getitem__, self.pattern.findall(text)))

    def tokens(self, text: str) -> int:
        """Tokens of a text; each added token in it counts 1."""
        if not any(t in text for t in self.added_texts):
            return self._plain(text)
        total, at = 0, 0
        for m in self.added.finditer(text):
            total += self._plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self._plain(text[at:])


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    """One per Python worker, kept between its tasks."""
    return MergeCounter(path)


def n_tokens(text: Column, tokenizer: str | None = None) -> Column:
    """The number of tokens of a text; 0 for a null or empty one."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("bigint")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path)
        for s in it:
            yield pd.Series([counter.tokens(t) if t else 0 for t in s], dtype="int64")
        counter.clear()
        freed()
    return run(text)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit for every row, in no order.

    A null text is empty (0 bytes, 0 tokens). Ids may repeat or be null. An
    empty table gives no rows. Further columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       n_tokens(text, tokenizer).alias("n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
