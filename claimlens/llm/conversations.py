"""Conversation structure repair: cost DP, then prefix-doubling path ranking.

A conversation's rows, in turn order, become one whose role initials have the form
``(s?(ua)+)?`` by the cheapest edits: Keep 0, Rerole to user/assistant 3, Delete 4
(the only edit of blank and repeated rows), Insert an empty user/assistant turn 3;
a truncated row that stays adds 3. Of equally cheap repairs the one whose audit
(the edits' initials) is least in ASCII order is taken.

Nodes are (rows consumed, state); the states are 0 empty, 1 after ``s``, 2 after
``u``, 3 after ``a`` (0 and 3 accept).

* cost DP: cost to go of every node; an arc is optimal if it loses nothing;
* ranking: nodes are ranked by the least audits of 1, 2, 4, ... letters from them
  (rank of the first half, rank of the node the half leads to), while pointers
  double; of a node's optimal arcs the one of least (letter, rank of its target)
  is taken, and the doubled pointers list the nodes of the least path.

A conversation may hold most of the rows, so it is cut into blocks of ``BLOCK``
rows: a block gives its min-plus cost matrix (4 x 4), the suffix products of a
conversation's matrices come from doubling joins over its blocks, and so do the
states in which the least path enters them (doubled pointers over the blocks).
A task holds one slice of blocks. Positions come from one range sort plus the row
counts of earlier ranges; repeated rows from a grouping by digest that combines
before the shuffle, so no row group is gathered. Only the hash of a repaired
conversation is sequential: a long one's text passes, as rows of at most 1 MB,
through one task that keeps nothing but the hash state.

Defined results: null role or text is one space; null ids are one conversation;
rows of one turn are ordered by role and digest of role and text; any other role
initial can only be reroled or deleted; a conversation that lost all rows, and
only that, has zeros, an empty audit and the hash of the empty string; an empty
table gives an empty result. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import SLICE_ROWS, arrow_map, stored

#: Rows of a block.
BLOCK = 1024
#: Rows whose nodes a task holds at once.
SLICE = 1 << 16
#: Bytes of repaired text in one row of a long conversation.
PIECE = 1 << 20
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: State after an inserted or reroled turn; the turn's role is that of the state.
NEXT = np.array([2, 2, 3, 2])
ROLE = {2: "user", 3: "assistant"}
#: State after a kept turn with initial s, u, a or another, by state; 4: none.
KEPT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
#: Cost to go and audit after the last row, by state.
AT_END = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)   # in ASCII order
_FAR = 1 << 40
_TRUNCATED, _BLANK, _FIRST = 4, 8, 16


# ---- damage --------------------------------------------------------------------

def damaged(convs: DataFrame) -> DataFrame:
    """The rows after damage by crc32(``conv_id:turn``) % 20: 0 drops, 1 empties
    the text, 2 removes its ``.!?``, 3 repeats the row, 4 sets role user. Nulls of
    role and text are one space, in the checksum also those of id and turn."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return convs.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                        fate.alias("_fate")).where("_fate <> 0").select(
        "conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")) \
        .drop("_copy")


# ---- positions -----------------------------------------------------------------

def _key(c: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit(":"), F.col(c)), F.lit("")).alias("_c")


def placed(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(_c, block, pos, turn, role, text, digest): every row's place 0, 1, ... in its
    conversation, as a written table joined with the offsets of its ranges."""
    keyed = rows.select(_key(), "turn", "role", "text",
                        F.md5(F.concat("role", F.lit("\0"), "text")).alias("digest"))
    order = [F.col("_c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .withColumn("_part", F.spark_partition_id())
    kind = rows.schema["turn"].dataType.simpleString()
    counted = stored(ranged.mapInArrow(
        _count_in_runs, f"_c string, turn {kind}, role string, text string, digest string, _part int, _at bigint"),
        "conv-rows")
    # a conversation goes on in the next range: at most one offset a range
    runs = counted.groupBy("_part", "_c").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_offset", F.sum("_n").over(earlier)).where("_offset > 0").drop("_n")
    pos = F.col("_at") + F.coalesce(F.col("_offset"), F.lit(0))
    return counted.join(F.broadcast(offsets), ["_part", "_c"], "left") \
        .select("_c", pos.alias("pos"), "turn", "role", "text", "digest") \
        .withColumn("block", F.floor(F.col("pos") / block).cast("bigint"))


def _count_in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's number in its run of one ``_c`` (the first column)."""
    last, seen = None, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        if batch.column(0)[0].as_py() == last:
            at[:starts[1] if len(starts) > 1 else n] += seen
        last, seen = batch.column(0)[n - 1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "_at"])


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(_c, block, codes, blank, duplicate, truncated, illegal) of ``placed`` rows:
    one byte a row (initial, truncated, deletion needed) and the counts of faults."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    blank = F.length(F.rtrim(F.col("text"), F.lit(SPACES))) == 0
    code = initial + F.when(blank, _BLANK).when(~end.isin(".", "!", "?"), _TRUNCATED).otherwise(0)
    narrow = rows.select("_c", "pos", "block", code.alias("code"))
    # the last row of a block is also shown to the next one, for the pair across the cut
    shown = narrow.withColumn("block", F.explode(F.when(
        F.col("pos") % block == block - 1, F.array(F.col("block"), F.col("block") + 1)).otherwise(F.array("block"))))
    firsts = rows.groupBy("_c", "digest").agg(F.min("pos").alias("pos")).select(
        "_c", "pos", F.floor(F.col("pos") / block).cast("bigint").alias("block"), F.lit(_FIRST).alias("code"))
    lists = shown.unionByName(firsts).groupBy("_c", "block") \
        .agg(F.collect_list(F.struct("pos", "code")).alias("entries"))

    def coded(cols: dict) -> dict:
        out = {n: [] for n in ("codes", "blank", "duplicate", "truncated", "illegal")}
        for start, entries in zip(cols["block"].to_pylist(), cols["entries"]):
            values = entries.values
            pos, code = (np.asarray(values.field(i)) for i in (0, 1))
            order = np.lexsort((code, pos))
            pos, code = pos[order], code[order]
            is_row = code != _FIRST
            is_first = np.isin(pos[is_row], pos[~is_row])
            own = pos[is_row] >= start * block
            code = code[is_row]
            empty, cut = code & _BLANK > 0, code & _TRUNCATED > 0
            # pairs of initials that may follow each other: su, ua, au
            pair = (code[:-1] & 3) * 4 + (code[1:] & 3)
            again = ~is_first & ~empty
            out["illegal"].append(int((~np.isin(pair, (1, 6, 9))).sum()))
            out["blank"].append(int((empty & own).sum()))
            out["duplicate"].append(int((again & own).sum()))
            out["truncated"].append(int((cut & is_first & own).sum()))
            out["codes"].append(((code & 7) + _BLANK * (empty | again))[own].astype(np.uint8).tobytes())
        return {"_c": cols["_c"], "block": cols["block"]} | out

    return arrow_map(lists, coded, "_c string, block bigint, codes binary, blank bigint, duplicate bigint, "
                                   "truncated bigint, illegal bigint").where(F.length("codes") > 0)


# ---- cost DP and ranking over a slice of blocks ---------------------------------

class Slice:
    """Blocks of row codes side by side; node ``(row, state)`` of a block is
    ``4 * (first[b] + row) + state``, its last row of nodes is its end."""

    def __init__(self, codes: list[bytes]):
        self.lens = np.array([len(c) for c in codes], np.int64)
        self.codes = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
        self.rows = np.concatenate(([0], np.cumsum(self.lens)))[:-1]
        self.first = self.rows + np.arange(len(codes))
        self.size = int(self.lens.sum()) + len(codes)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Cost to go (nodes / 4, 4, E) for the costs ``ends`` (blocks, 4, E) at the
        blocks' ends; all blocks step back together, longest first."""
        cost = np.full((self.size, 4, ends.shape[2]), _FAR, np.int64)
        cost[self.first + self.lens] = ends
        order = np.argsort(-self.lens, kind="stable")
        falling = -self.lens[order]
        for back in range(1, int(self.lens.max(initial=0)) + 1):
            on = order[:np.searchsorted(falling, -back, side="right")]
            i = self.lens[on] - back
            after = cost[self.first[on] + i + 1]
            kept, reroled = self._edits(self.codes[self.rows[on] + i], after)
            d = np.minimum(after + DELETE, np.minimum(kept, reroled))
            two, three = np.minimum(d[:, 2], d[:, 3] + INSERT), np.minimum(d[:, 3], d[:, 2] + INSERT)
            zero, one = np.minimum(d[:, 0], two + INSERT), np.minimum(d[:, 1], two + INSERT)
            cost[self.first[on] + i] = np.stack((zero, one, two, three), 1)
        return cost

    @staticmethod
    def _edits(codes: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs to go by Keep and by Rerole (rows, 4, E)."""
        stays = np.where(codes & _BLANK, _FAR, TRUNCATED * (codes & _TRUNCATED > 0))[:, None, None]
        wide = np.concatenate((after, np.full_like(after[:, :1], _FAR)), 1)
        kept = np.take_along_axis(wide, KEPT[codes & 3][:, :, None], 1)
        return kept + stays + KEEP, after[:, NEXT] + stays + REROLE

    def arcs(self, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Optimal arcs by letter D, I, K, R: whether there is one, and its target
        (nodes, 4). ``cost`` is (nodes / 4, 4)."""
        state = np.arange(4)
        node = np.ones(self.size, bool)
        node[self.first + self.lens] = False
        at = np.flatnonzero(node)
        after, own = cost[at + 1], cost[at]
        kept, reroled = (c[:, :, 0] for c in self._edits(self.codes, after[:, :, None]))
        by_letter = (after + DELETE, own[:, NEXT] + INSERT, kept, reroled)
        aims = (np.broadcast_to(state, own.shape), np.broadcast_to(NEXT, own.shape),
                np.minimum(KEPT[self.codes & 3], 3), np.broadcast_to(NEXT, own.shape))
        best = np.zeros((self.size, 4, 4), bool)
        target = np.zeros((self.size, 4, 4), np.int64)
        for k, (c, aim) in enumerate(zip(by_letter, aims)):
            best[at, :, k] = (c == own) & (own < _FAR)
            target[at, :, k] = 4 * (at[:, None] + (k != 1)) + aim   # an insert consumes no row
        return best.reshape(-1, 4), target.reshape(-1, 4)


def ranked_paths(best: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Least audits of all nodes by prefix doubling: (letter 0..4 of every node,
    0 at an end; doubled pointers; letters to the end).

    A node has one optimal arc a letter at most, so after the first round its
    least arc is known and rounds need no more candidates: each ranks twice as
    long audits by (rank of the first half, rank of where it leads)."""
    nodes = np.arange(len(best))
    moves = best.any(1)
    letter = np.where(moves, best.argmax(1) + 1, 0)
    pointer = np.where(moves, target[nodes, letter - 1], nodes)
    rank, steps, pointers = letter, moves.astype(np.int64), [pointer]
    while True:
        rank = np.unique(rank * np.int64(len(best) + 5) + rank[pointer], return_inverse=True)[1]
        steps = steps + steps[pointer]
        if not moves[pointer].any():
            break
        pointer = pointer[pointer]
        pointers.append(pointer)
    # the arc of least (letter, rank of its target) leads along the least path
    order = np.where(best, np.arange(1, 5) * np.int64(len(best) + 1) + rank[target], np.int64(1) << 62)
    taken = order.argmin(1)
    letter = np.where(moves, taken + 1, 0)
    pointers[0] = np.where(moves, target[nodes, taken], nodes)
    return letter, pointers, steps


def _walk(start: np.ndarray, pointers: list[np.ndarray], steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the paths from ``start`` (one after another, ends left out)
    and their numbers."""
    lens = steps[start]
    j = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    at = np.repeat(start, lens)
    for k, pointer in enumerate(pointers):
        at = np.where(j >> k & 1, pointer[at], at)
    return at, lens


def _slices(codes: pa.Array) -> Iterator[slice]:
    """Runs of blocks of about ``SLICE`` rows."""
    sizes = np.cumsum([len(c.as_py()) for c in codes])
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + SLICE)) + 1
        yield slice(start, min(stop, len(sizes)))
        start = stop


def _matrices(cols: dict) -> dict:
    """16 costs a block: from each state at its start to each at its end."""
    out = []
    for s in _slices(cols["codes"]):
        part = Slice(cols["codes"][s.start:s.stop].to_pylist())
        ends = np.full((4, 4), _FAR, np.int64)
        np.fill_diagonal(ends, 0)
        cost = part.costs(np.broadcast_to(ends, (len(part.lens), 4, 4)))
        out.extend(np.minimum(cost[part.first], _FAR).reshape(-1, 16).tolist())
    return {"_c": cols["_c"], "block": cols["block"], "matrix": out}


def _exits(cols: dict) -> dict:
    """The state in which the least path from each entry state leaves a block."""
    out = []
    for s in _slices(cols["codes"]):
        part, cost = _solved(cols, s)
        letter, pointers, _ = ranked_paths(*part.arcs(cost))
        starts = 4 * part.first[:, None] + np.arange(4)
        out.extend((pointers[-1][starts] & 3).tolist())
    return {"_c": cols["_c"], "block": cols["block"], "jump": out}


def _audits(cols: dict) -> dict:
    """A block's part of the audit from its entry state, and the cost to go."""
    letters, costs = [], []
    for s in _slices(cols["codes"]):
        part, cost = _solved(cols, s)
        letter, pointers, steps = ranked_paths(*part.arcs(cost))
        entry = np.asarray(cols["entry"][s.start:s.stop], np.int64)
        start = 4 * part.first + entry
        path, lens = _walk(start, pointers, steps)
        text = _LETTERS[letter[path]].tobytes().decode("ascii")
        stops = np.cumsum(lens)
        leaves = pointers[-1][start] & 3
        final = cols["final"][s.start:s.stop].to_pylist()
        letters.extend(text[b - n:b] + (TAIL[q] if f else "")
                       for b, n, q, f in zip(stops.tolist(), lens.tolist(), leaves.tolist(), final))
        costs.extend(cost[part.first, entry].tolist())
    return {n: cols[n] for n in ("_c", "block", "entry", "final")} | {"letters": letters, "cost": costs}


def _solved(cols: dict, s: slice) -> tuple[Slice, np.ndarray]:
    part = Slice(cols["codes"][s.start:s.stop].to_pylist())
    ends = np.array(cols["ends"][s.start:s.stop].to_pylist(), np.int64)
    return part, part.costs(ends[:, :, None])[:, :, 0]


# ---- doubling over the blocks of a conversation ---------------------------------

def _then(a: Column, b: Column) -> Column:
    """Min-plus product of two 4 x 4 matrices."""
    return F.array(*[F.least(F.lit(_FAR), *[a[4 * i + k] + b[4 * k + j] for k in range(4)])
                     for i in range(4) for j in range(4)])


def _doubled(df: DataFrame, value: str, blocks: int, combine, ahead: int, name: str) -> DataFrame:
    """``value`` of a block combined with those of all blocks ahead (``ahead`` 1) or
    behind it (-1): each round joins a block with the one twice as far."""
    reach = 1
    while reach < blocks:
        other = df.select("_c", (F.col("block") - ahead * reach).alias("block"), F.col(value).alias("_o"))
        both = combine(F.col(value), F.col("_o"))
        df = stored(df.join(other, ["_c", "block"], "left").select(
            "_c", "block", F.when(F.col("_o").isNull(), F.col(value)).otherwise(both).alias(value)), name)
        reach *= 2
    return df


def _entered(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """``blocks`` with the costs at their ends, the state in which the least path
    enters them and whether they are the last of their conversation."""
    at_end = F.array(*[F.lit(c).cast("bigint") for c in AT_END])
    if n_blocks <= 1:
        return blocks.withColumns({"ends": at_end, "entry": F.lit(0).cast("bigint"), "final": F.lit(True)})
    matrix = stored(arrow_map(blocks.select("_c", "block", "codes"), _matrices,
                              "_c string, block bigint, matrix array<bigint>"), "conv-matrix")
    ahead = _doubled(matrix, "matrix", n_blocks, _then, 1, "conv-ahead")
    ends = ahead.select("_c", (F.col("block") - 1).alias("block"), F.array(*[
        F.least(*[F.col("matrix")[4 * i + k] + F.lit(AT_END[k]) for k in range(4)]) for i in range(4)]).alias("ends"))
    blocks = stored(blocks.join(ends, ["_c", "block"], "left").withColumns(
        {"final": F.col("ends").isNull(), "ends": F.coalesce("ends", at_end)}), "conv-ends")
    jump = stored(arrow_map(blocks.select("_c", "block", "codes", "ends"), _exits,
                            "_c string, block bigint, jump array<bigint>"), "conv-jump")

    def follow(late: Column, early: Column) -> Column:
        return F.transform(early, lambda q: F.get(late, q.cast("int")))

    behind = _doubled(jump, "jump", n_blocks, follow, -1, "conv-behind")
    entry = behind.select("_c", (F.col("block") + 1).alias("block"), F.col("jump")[0].alias("entry"))
    return blocks.join(entry, ["_c", "block"], "left") \
        .withColumn("entry", F.coalesce("entry", F.lit(0).cast("bigint")))


# ---- repaired text -------------------------------------------------------------

_OUT = "_c string, block bigint, piece int, text string, sha string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (_c, block, pos, role, text, letters, entry, alone), a block's
    audit first -> the hash of a conversation of one block, or pieces of the
    block's repaired text, every line after a line break."""
    out: list[tuple] = []
    sink = None
    for key, block, _, role, text, letters, entry, alone in _rows(batches):
        if letters is not None:
            if sink is not None:
                out.extend(sink.end())
            sink = _Repair(key, block, letters, entry, alone)
        else:
            out.extend(sink.row(role, text))
        if len(out) >= SLICE_ROWS or sum(len(o[3] or "") for o in out[-8:]) > 4 * PIECE:
            yield _out_batch(out)
            out = []
    if sink is not None:
        out.extend(sink.end())
    if out:
        yield _out_batch(out)


class _Repair:
    """Applies a block's audit to its rows as they come."""

    def __init__(self, key: str, block: int, letters: str, state: int, alone: bool):
        self.key, self.block, self.state, self.alone = key, block, state, alone
        self.letters, self.at = letters, 0
        self.hash, self.lines = hashlib.sha256(), 0
        self.held, self.size, self.piece = [], 0, 0

    def _line(self, line: str) -> Iterator[tuple]:
        if self.alone:
            self.hash.update(("\n" * (self.lines > 0) + line).encode())
        else:
            self.held.append("\n" + line)
            self.size += len(line)
            if self.size >= PIECE:
                yield self._flushed()
        self.lines += 1

    def _flushed(self) -> tuple:
        text, self.held, self.size = "".join(self.held), [], 0
        self.piece += 1
        return self.key, self.block, self.piece, text, None

    def _inserts(self) -> Iterator[tuple]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = int(NEXT[self.state])
            yield from self._line(ROLE[self.state] + ":")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self._inserts()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "K":
            self.state = int(KEPT["sua".index(role[0])][self.state])
            yield from self._line(f"{role}:{text}")
        elif edit == "R":
            self.state = int(NEXT[self.state])
            yield from self._line(f"{ROLE[self.state]}:{text}")

    def end(self) -> Iterator[tuple]:
        yield from self._inserts()
        if self.alone:
            yield self.key, self.block, 0, None, self.hash.hexdigest()
        elif self.held:
            yield self._flushed()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            yield from zip(*[c.to_pylist() for c in batch.slice(i, SLICE_ROWS).columns])


def _out_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["_c", "block", "piece", "text", "sha"])


def _long_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation, block and number -> its hash."""
    key, state, any_line, out = None, None, False, []
    for c, text in _rows(batches):
        if c != key:
            if key is not None:
                out.append((key, state.hexdigest()))
            key, state, any_line = c, hashlib.sha256(), False
        state.update((text if any_line else text[1:]).encode())
        any_line = True
        if len(out) >= SLICE_ROWS:
            yield pa.RecordBatch.from_pydict(dict(zip(("_c", "sha"), map(list, zip(*out)))))
            out = []
    if key is not None:
        out.append((key, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(("_c", "sha"), map(list, zip(*out)))))


def _hashes(rows: DataFrame, audits: DataFrame, n_blocks: int) -> DataFrame:
    """(_c, sha) of the repaired conversations (none where no line is left)."""
    none = F.lit(None)
    alone = audits.withColumn("alone", F.col("final") & (F.col("block") == 0))
    both = alone.select("_c", "block", F.lit(-1).cast("bigint").alias("pos"), none.cast("string").alias("role"),
                        none.cast("string").alias("text"), "letters", "entry", "alone") \
        .unionByName(rows.select("_c", "block", "pos", "role", "text"), allowMissingColumns=True)
    out = both.repartition("_c", "block").sortWithinPartitions("_c", "block", "pos").mapInArrow(_repaired, _OUT)
    if n_blocks <= 1:
        return out.select("_c", "sha")
    out = stored(out, "conv-repaired")
    pieces = out.where("sha is null").select("_c", "block", "piece", "text").repartition("_c") \
        .sortWithinPartitions("_c", "block", "piece").select("_c", "text")
    return out.where("sha is not null").select("_c", "sha") \
        .unionByName(pieces.mapInArrow(_long_hashes, "_c string, sha string"))


# ---- repair ----------------------------------------------------------------------

def repair(convs: DataFrame, rows: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One row per ``conv_id`` of ``convs``: gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 of its ``rows`` (conv_id, turn, role,
    text; default: those of ``convs``, nulls of role and text as one space)."""
    if rows is None:
        rows = convs.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = placed(rows, block)
    turns = rows.groupBy("_c").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    blocks = stored(blocks_of(rows, block), "conv-blocks")
    n_blocks = (blocks.agg(F.max("block").alias("n")).first()["n"] or 0) + 1
    counts = ("blank", "duplicate", "truncated", "illegal")
    entered = _entered(blocks.drop(*counts), n_blocks)
    audits = stored(arrow_map(entered, _audits, "_c string, block bigint, entry bigint, final boolean, "
                                                "letters string, cost bigint"), "conv-audits")
    faults = blocks.groupBy("_c").agg(*[F.sum(c).alias(c) for c in counts])
    pieces = F.array_sort(F.collect_list(F.struct("block", "letters")))
    edits = audits.groupBy("_c").agg(
        F.sum(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit"))
    ids = convs.select("conv_id", _key()).distinct()
    zero = F.lit(0).cast("bigint")
    return ids.join(turns, "_c", "left").join(faults, "_c", "left").join(edits, "_c", "left") \
        .join(_hashes(rows, audits, n_blocks), "_c", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", *counts, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def report(convs: DataFrame) -> DataFrame:
    """The repair of every conversation after the damage of ``damaged``."""
    return repair(convs, damaged(convs))
