"""Near-duplicate classes by ProbMinHash (operator 8).

Texts are multisets of five-word shingles (lower-cased words separated by
white space), weighted by how often each occurs. Their similarity is the
probability Jaccard coefficient J_P, which equals the plain Jaccard
coefficient when no shingle repeats.

1. *Signatures.* Every shingle sends a Poisson process of arrivals with its
   weight as rate into ``bands x rows`` registers; a register keeps the
   shingle that arrives first. A shingle's process stops as soon as its next
   arrival lies behind the latest register (early termination). Two texts
   agree in a register with probability J_P.
2. *Classes.* Texts with equal word sequences form one class, represented by
   its smallest id; only representatives go on.
3. *Banding.* Equal register groups put representatives into buckets. With
   30 bands of 6 rows a pair of similarity 0.8 shares a bucket with
   probability 0.9999. Texts connected through buckets form a family; a family
   is dealt by id hash into blocks of about ``BLOCK`` texts.
4. *Verification.* Blocks that share a bucket are compared text by text with
   the exact J_P, one pair of blocks at a time. A pair of blocks returns at
   most one row a text (a spanning forest of its links), so the rows grow with
   the texts and not with the square of a group, and no link is lost.
5. *Components* of the links give the class of each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import WordIds, arrow_map, freed, lists, mix64, shingle_hashes, small, stored
from claimlens.llm.components import connected_components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 6
BLOCK = 128


def probminhash(docs: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Signatures (len(docs), m) of weighted sets [(ids uint64, weights)].

    Round i draws arrival i of every shingle still active. A shingle stays
    active while its last arrival is before the latest register of its text.
    An empty set gets a row of zeros.
    """
    out = np.zeros((len(docs), m), np.uint64)
    if not docs:
        return out
    size = np.array([len(d) for d, _ in docs], np.int64)
    row = np.flatnonzero(size)              # texts still at work, by position in ``out``
    if len(row) == 0:
        return out
    g = np.repeat(np.arange(len(row)), size[row])
    d = np.concatenate([x for x, _ in docs]).astype(np.uint64, copy=False)
    w = np.concatenate([x for _, x in docs]).astype(np.float64)
    t = np.zeros(len(d))
    sig, first = np.zeros(len(row) * m, np.uint64), np.full(len(row) * m, np.inf)
    i = 0
    while len(d):
        i += 1
        r = mix64(d + np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = ((mix64(r ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        t = t - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / w
        slot = g * m + k.astype(np.int64)
        hit = np.flatnonzero(t < first[slot])
        at = slot[hit]
        np.minimum.at(first, at, t[hit])
        won = t[hit] == first[at]
        sig[at[won]] = d[hit[won]]
        last = first.reshape(-1, m).max(axis=1)
        on = t < last[g]
        if not on.all():
            g, d, w, t = g[on], d[on], w[on], t[on]
            busy = np.zeros(len(row), bool)
            busy[g] = True
            if 2 * busy.sum() <= len(row):  # texts that are ready leave the arrays
                out[row[~busy]] = sig.reshape(-1, m)[~busy]
                g = (np.cumsum(busy) - 1)[g]
                row, sig = row[busy], sig.reshape(-1, m)[busy].reshape(-1)
                first = first.reshape(-1, m)[busy].reshape(-1)
    out[row] = sig.reshape(-1, m)
    return out


def probability_jaccard(xa: np.ndarray, wa: np.ndarray | None,
                        xb: np.ndarray, wb: np.ndarray | None) -> float:
    """Exact J_P of two sets of sorted ids; weights of None are all 1."""
    if len(xa) == 0 or len(xb) == 0:
        return 0.0
    at = np.searchsorted(xb, xa)
    at[at == len(xb)] = 0
    common = np.flatnonzero(xb[at] == xa)
    if len(common) == 0:
        return 0.0
    if wa is None and wb is None:
        return len(common) / (len(xa) + len(xb) - len(common))
    wa = np.ones(len(xa)) if wa is None else wa.astype(float)
    wb = np.ones(len(xb)) if wb is None else wb.astype(float)
    x, y = wa[common], wb[at[common]]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    # shingles only in one text always count on their own side; of the common
    # ones, those with a larger ratio x/y count on side a, the others on b
    order = np.argsort(x / y, kind="stable")
    ratio, x, y = (x / y)[order], x[order], y[order]
    at_least = np.searchsorted(ratio, ratio, side="left")
    xs = np.append(np.cumsum(x[::-1])[::-1], 0.0)
    ys = np.append(0.0, np.cumsum(y))
    return float((1.0 / ((xs[at_least] + only_a) / x + (ys[at_least] + only_b) / y)).sum())


def _weighted_shingles(words: list[str], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_hashes(ids.ids(words), SHINGLE_WORDS), return_counts=True)


def _signature_fn(id_col: str, text_col: str, bands: int, rows: int):
    ids = WordIds()
    salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))[None, :]

    def run(cols: dict) -> dict:
        keys, sets, buckets = [], [], []

        def flush():
            if sets:
                sig = probminhash(sets, bands * rows).reshape(len(sets), bands, rows)
                h = np.broadcast_to(salt, sig.shape[:2])
                for j in range(rows):
                    h = mix64(h ^ sig[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
                buckets.append(h.reshape(-1))
                sets.clear()

        lengths, pending = [], 0
        for text in cols[text_col].to_pylist():
            words = (text or "").lower().split()
            if not words:
                keys.append(None)
                lengths.append(0)
                continue
            keys.append(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"),
                                        digest_size=16).digest())
            sets.append(_weighted_shingles(words, ids))
            lengths.append(bands)
            pending += len(words)
            if pending > 50_000:
                flush()
                pending = 0
        flush()
        flat = np.concatenate(buckets) if buckets else np.zeros(0, np.uint64)
        return {"id": cols[id_col], "key": keys,
                "buckets": lists(flat.view(np.int64), lengths, pa.int64())}
    return run


def _shingle_fn(id_col: str, text_col: str, block_col: str):
    ids = WordIds()

    def run(cols: dict) -> dict:
        x, w, nx, nw = [], [], [], []
        for text in cols[text_col].to_pylist():
            a, n = _weighted_shingles((text or "").lower().split(), ids)
            x.append(a)
            nx.append(len(a))
            w.append(n if (n > 1).any() else n[:0])
            nw.append(len(w[-1]))
        return {"id": cols[id_col], "block": cols[block_col],
                "x": lists(np.concatenate(x).view(np.int64), nx, pa.int64()),
                "w": lists(np.concatenate(w).astype(np.int32), nw, pa.int32())}
    return run


def _linked(sets: list, n_left: int, threshold: float) -> np.ndarray:
    """Boolean (n, n) matrix of the pairs with J_P >= ``threshold`` among
    ``sets`` [(sorted ids, weights or None)]. With ``n_left`` > 0 only pairs
    between the first ``n_left`` sets and the others count.

    Common shingles are counted by products of 0/1 matrices, a slice of the
    shingles at a time. Where a shingle repeats, J_P is at most either text's
    share of common shingles; pairs within that bound are computed singly.
    """
    n = len(sets)
    size = np.array([len(x) for x, _ in sets])
    heavy = np.array([w is not None for _, w in sets])
    share = [np.ones(len(x)) / len(x) if w is None else w / w.sum() for x, w in sets]
    row = np.repeat(np.arange(n), size)
    _, col, count = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True,
                              return_counts=True)
    use = count[col] > 1
    row, col, mass = row[use], col[use], np.concatenate(share)[use]
    order = np.argsort(col, kind="stable")
    row, mass = row[order], mass[order]
    col = np.cumsum(np.append(False, np.diff(col[order]) != 0)) if len(order) else col[order]
    common, part = np.zeros((n, n)), np.zeros((n, n))
    width, total = 4096, int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, total, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, min(width, total - lo)), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        common += m @ m.T
        if heavy.any():
            p = np.zeros(m.shape, np.float32)
            p[row[a:b], col[a:b] - lo] = mass[a:b]
            part += p @ m.T
    with np.errstate(divide="ignore", invalid="ignore"):
        link = common / (size[:, None] + size[None, :] - common) >= threshold
    if heavy.any():
        either = heavy[:, None] | heavy[None, :]
        bound = (part >= threshold - 1e-3) & (part.T >= threshold - 1e-3) & either
        link &= ~either
        if n_left:
            bound[n_left:] = False
            bound[:, :n_left] = False
        for i, j in zip(*np.nonzero(np.triu(bound | bound.T, 1)), strict=True):
            if probability_jaccard(*sets[i], *sets[j]) >= threshold:
                link[i, j] = link[j, i] = True
    if n_left:
        link[:n_left, :n_left] = False
        link[n_left:, n_left:] = False
    np.fill_diagonal(link, False)
    return link


def _forest(link: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (smallest id, member) of each connected group of ``link``."""
    label = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        near = np.where(link, label[None, :], top).min(axis=1, initial=top)
        new = np.minimum(label, near)
        if (new == label).all():
            break
        label = new
    out = label != ids
    return label[out], ids[out]


def _block_fn(threshold: float):
    """Rows sorted by pair of blocks -> edges; one pair is held at a time."""
    def column(values: pa.ListArray, dtype):
        flat = values.flatten().to_numpy(zero_copy_only=False)
        cut = np.concatenate(([0], np.cumsum(np.diff(values.offsets.to_numpy()))))
        return [flat[a:b].view(dtype) for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def edges(group: list) -> tuple[np.ndarray, np.ndarray]:
        group.sort(key=lambda r: r[0])
        ids = np.array([r[1] for r in group], np.int64)
        sets = [(r[2], r[3] if len(r[3]) else None) for r in group]
        cross = group[-1][0] != group[0][0]
        return _forest(_linked(sets, sum(r[0] == group[0][0] for r in group) if cross else 0,
                               threshold), ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in batches:
            lo, hi, own, ids = (batch.column(n).to_pylist() for n in ("lo", "hi", "own", "id"))
            xs, ws = column(batch.column("x"), np.uint64), column(batch.column("w"), np.int32)
            for k in range(batch.num_rows):
                if (lo[k], hi[k]) != key:
                    if len(group) > 1:
                        yield out(*edges(group))
                    key, group = (lo[k], hi[k]), []
                group.append((own[k] == hi[k] and lo[k] != hi[k], ids[k], xs[k].copy(), ws[k].copy()))
        if len(group) > 1:
            yield out(*edges(group))
        del group
        freed()

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, key, buckets): the class key (null without words) and one 64-bit
    bucket key a band, for every row with an id."""
    return arrow_map(docs.select(id_col, text_col).where(F.col(id_col).isNotNull()),
                     _signature_fn(id_col, text_col, bands, rows),
                     "id bigint, key binary, buckets array<bigint>")


def _families(live: DataFrame) -> DataFrame:
    """(bucket, id, block): families of texts connected through buckets, dealt
    into blocks of about ``BLOCK`` by id hash."""
    hubs = live.groupBy("bucket").agg(F.min("id").alias("hub"))
    family = connected_components(live.join(hubs, "bucket").select(
        F.col("hub").alias("a"), F.col("id").alias("b")))
    blocks = family.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("bigint").alias("n"))
    of_id = family.join(blocks, "component").select(
        F.col("node").alias("id"),
        F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("n"))).alias("block"))
    return stored(live.join(of_id, "id").select("bucket", "id", "block"), "blocks")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           threshold: float = THRESHOLD, bands: int = BANDS,
                           rows: int = ROWS) -> DataFrame:
    """(``id_col``, class_id): one row per id; class_id is the smallest id of
    the texts connected by links of similarity >= ``threshold``.

    A null or wordless text links with nothing. Rows without an id have no
    class and no row. Rows that repeat an id belong to one class. Further
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    sig = stored(signatures(docs, id_col, text_col, bands, rows), "signatures")
    reps = sig.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"))
    member = stored(sig.select("id", "key").join(reps, "key", "left")
                    .select("id", F.coalesce("rep", "id").alias("rep")).distinct(), "members")
    first = sig.join(reps.select("key", F.col("rep").alias("id")), ["key", "id"]) \
        .dropDuplicates(["key"])
    bucketed = first.select("id", F.explode("buckets").alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")) \
        .where("lo <> hi").select("bucket")
    live = _families(stored(bucketed.join(shared, "bucket").select("bucket", "id").distinct(), "live"))

    block_of = stored(live.select("id", "block").distinct(), "block-of")
    wanted = small(block_of, 24)
    shingles = arrow_map(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id"),
        _shingle_fn("id", "text", "block"), "id bigint, block bigint, x array<bigint>, w array<int>")
    seen = live.select("bucket", "block").distinct()
    several = seen.groupBy("bucket").agg(F.min("block").alias("l"), F.max("block").alias("h")) \
        .where("l <> h").select("bucket")
    seen = seen.join(several, "bucket")
    pairs = seen.select("bucket", F.col("block").alias("lo")) \
        .join(seen.select("bucket", F.col("block").alias("hi")), "bucket").where("lo < hi") \
        .select("lo", "hi").union(block_of.select(F.col("block").alias("lo"), F.col("block").alias("hi"))) \
        .distinct()
    pairs = stored(pairs, "block-pairs")
    sides = pairs.select("lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    dealt = stored(shingles, "shingles").join(sides, "block") \
        .select("lo", "hi", F.col("block").alias("own"), "id", "x", "w") \
        .repartition("lo", "hi").sortWithinPartitions("lo", "hi")
    links = stored(dealt.mapInArrow(_block_fn(threshold), "a bigint, b bigint"), "links")

    same_id = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")) \
        .where("a <> z").select("id", "a")
    links = links.union(member.join(same_id, "id").select("a", F.col("rep").alias("b")))
    comp = connected_components(links)
    out = member.join(comp, member["rep"] == comp["node"], "left") \
        .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("class_id"))
    return out.withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: one row for each class, that with the
    smallest id (of rows repeating that id, the smallest row), and every row
    without an id. Columns are unchanged."""
    dropped = classes.where(F.col(id_col) != F.col("class_id")).select(id_col)
    kept = docs.join(small(stored(dropped, "dropped"), 16), id_col, "left_anti").select(docs.columns)
    again = stored(docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count()
                   .where("count > 1").select(id_col), "again")
    if again.isEmpty():
        return kept
    again = small(again, 16)
    rest = [c for c in docs.columns if c != id_col]
    one = kept.join(again, id_col, "left_semi").groupBy(id_col).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row")) \
        .select(id_col, "_row.*").select(docs.columns)
    return kept.join(again, id_col, "left_anti").select(docs.columns).unionByName(one)
