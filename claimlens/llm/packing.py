"""Sequence packing: shortest-pack-first over the length histogram (operator 5).

1. Each document becomes its token ids plus an end id, cut every ``MAX_TOKENS``
   ids into pieces. Only lengths and checksums are kept.
2. The histogram of piece lengths (at most ``MAX_TOKENS`` rows, whatever the
   number of documents) is packed on the driver: lengths are placed longest
   first, each into the shortest pack with room, by splitting the counts of
   packing patterns; a new pack opens only when nothing fits.
3. Pieces are ranked by (length, document, start) and joined with the patterns
   by length and rank, which gives each piece its sequence and offset.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimlens.llm.common import arrow_map, stored
from claimlens.llm.token_count import byte_symbols
from claimlens.operators.common import global_rank

MAX_TOKENS = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: White space for str.split() but not for the tokenizer.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Marks that the tokenizer always parts from a word (no apostrophe: "'s").
_MARKS = ".,;:!?%*&$#|"


class WordTokens(dict):
    """Word -> its ids as little-endian uint32 bytes.

    The tokenizer drops white space and never looks across it, so a text's
    ids are those of its words in order; and it folds case and parts letters
    from closing marks. So each distinct word is looked up once, and each
    distinct run of small letters is merged once. Cleared at ``limit`` words.
    """

    def __init__(self, path: str, limit: int = 100_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark's tasks are the parallelism
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.cores: dict[str, bytes] = {}
        self.symbols = dict(enumerate(byte_symbols()))

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
            self.cores.clear()
        core = word.rstrip(_MARKS)
        low = core.lower()
        plain = core.isalpha()
        if not core.isascii():
            # a capital sigma's small form depends on its place; a dotted capital I
            # leaves a mark that joins those behind it
            low = unicodedata.normalize("NFC", low)
            plain = plain and "Σ" not in core and low.isalpha()
        ids = self[word] = self.encoded([word])[0] if not plain else self._core(low) if core == word \
            else self._core(low) + self._tail(word[len(core):])
        return ids

    def _core(self, low: str) -> bytes:
        """The ids of a run of small letters: merged by the model itself."""
        ids = self.cores.get(low)
        if ids is None:
            shown = low if low.isascii() else low.encode().decode("latin-1").translate(self.symbols)
            ids = self.cores[low] = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return ids

    def _tail(self, marks: str) -> bytes:
        if marks not in self.cores:
            self.cores[marks] = self.encoded([marks])[0]
        return self.cores[marks]

    def of(self, text: str) -> bytes:
        if any(c in text for c in _ODD_SPACE):
            return self.encoded([text])[0]
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def _words(path: str) -> WordTokens:
    """One per Python worker, kept between its tasks."""
    return WordTokens(path)


def _pieces_fn(id_col: str, text_col: str, tokenizer: str, max_tokens: int, end_id: int):
    def run(cols: dict) -> dict:
        words = _words(tokenizer)
        out = {"doc": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        for doc, text in zip(cols[id_col].to_pylist(), cols[text_col].to_pylist(), strict=True):
            ids = words.of(text or "") + end_id.to_bytes(4, "little")
            n = len(ids) // 4
            for start in range(0, n, max_tokens):
                piece = ids[4 * start: 4 * (start + max_tokens)]
                for k, v in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), n), strict=True):
                    out[k].append(v)
        return out
    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           tokenizer: str | None = None, max_tokens: int = MAX_TOKENS,
           end_id: int = END_ID) -> DataFrame:
    """(doc, start, length, ids_crc32, doc_tokens): pieces of every document."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    return arrow_map(docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")),
                     _pieces_fn("doc", "text", path, max_tokens, end_id),
                     "doc bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_histogram(histogram: dict[int, int], max_tokens: int = MAX_TOKENS
                   ) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(packs, [(length, copies), ...])]: shortest-pack-first over counts.

    Every length occurs ``histogram[length]`` times in all, and no pattern
    exceeds ``max_tokens``.
    """
    room: dict[int, list] = defaultdict(list)       # free tokens -> [(packs, pattern)]
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        for free in range(max_tokens - 1, length - 1, -1):      # shortest pack first
            while n > 0 and room[free]:
                packs, pattern = room[free].pop()
                used = min(packs, n)
                if packs > used:
                    room[free].append((packs - used, pattern))
                last, copies = pattern[-1]
                longer = [*pattern[:-1], (last, copies + 1)] if last == length \
                    else [*pattern, (length, 1)]
                room[free - length].append((used, longer))
                n -= used
        per_pack = max_tokens // length
        for packs, copies in ((n // per_pack, per_pack), (1, n % per_pack)):
            if packs and copies:
                room[max_tokens - copies * length].append((packs, [(length, copies)]))
    return [g for f in sorted(room) for g in room[f]]


def placements(groups: list, histogram: dict[int, int]) -> list[tuple]:
    """(length, lo, hi, packs, first_sequence, offset, used): pieces whose
    global rank (by length, from 0) is in [lo, hi) fill one slot of a pattern
    that holds ``used`` tokens."""
    rank, total = {}, 0
    for length in sorted(histogram):
        rank[length] = total
        total += histogram[length]
    rows, sequence = [], 0
    for packs, pattern in groups:
        offset, used = 0, sum(a * b for a, b in pattern)
        for length, copies in pattern:
            lo = rank[length]
            rank[length] += packs * copies
            rows.append((length, lo, rank[length], packs, sequence, offset, used))
            offset += length * copies
        sequence += packs
    return rows


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           tokenizer: str | None = None, max_tokens: int = MAX_TOKENS,
           end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, padded_length.

    A sequence is filled from offset 0 without gaps; ``padded_length`` is
    ``max_tokens``, or the used length where that is a power of two. A null
    text is empty (its one piece is the end id). Rows may repeat ids or have
    none: every row is packed. An empty table gives no rows.
    """
    spark = docs.sparkSession
    p = stored(pieces(docs, id_col, text_col, tokenizer, max_tokens, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = pack_histogram(histogram, max_tokens)
    slots = spark.createDataFrame(
        placements(groups, histogram),
        "slot_length bigint, lo bigint, hi bigint, packs bigint, first_sequence bigint, "
        "first_offset bigint, used bigint")
    ranked = global_rank(p, [F.col(c).asc_nulls_first() for c in ("length", "doc", "start", "ids_crc32")],
                         "rank").withColumn("rank", F.col("rank") - 1)
    # at most one slot a (length, pattern): bounded by the histogram, not the data
    j = F.col("rank") - F.col("lo")
    out = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length"))
                      & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    exact = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return out.select(
        F.col("doc").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + j % F.col("packs")).alias("sequence_id"),
        (F.col("first_offset") + F.floor(j / F.col("packs")) * F.col("length")).cast("bigint").alias("offset"),
        F.when(exact, F.col("used")).otherwise(F.lit(max_tokens)).cast("bigint").alias("padded_length"))
