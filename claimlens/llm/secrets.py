"""Secret scan: fixed patterns plus a character network (operator 4).

*Base findings* are the three fixed patterns below. *Candidates* are the parts of
all runs of 16 or more characters of the value alphabet that no base finding
covers: a part itself, in overlapping windows of ``HEAD + TAIL`` characters where it
is longer, and each alphanumeric stretch of 16 or more characters inside it (a value
in the middle of a path). A small convolutional network over characters, in numpy,
scores every candidate with the characters around it; those that score at least
the threshold are findings of kind ``network`` (windows that touch are one).

The network is trained on the labelled findings of all documents, every distinct one:
the values of base findings are secrets, the other candidates are not. Each is
learned as it stands, with the text before, after and on both sides blanked, and
with the surroundings of a finding of the other label, so that the form of a value
counts and not only the keyword or the quotes that come with it. ``FILL`` generated
findings of each label (fixed seed) are always among them. The findings are dealt by
hash into parts of about ``PART_FINDINGS``; in each of ``EPOCHS`` rounds every part
trains on from the same weights, and the mean of the parts' weights is what the next
round starts from. The logits are calibrated on a quarter of the findings, held back,
in all those forms. The threshold is 0.5, or lower if the share of held-back secrets
found would not reach ``RECALL`` there.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import SLICE_ROWS, arrow_map, freed, stored

#: Findings of a part (the bound of what a task holds); generated ones of each label.
PART_FINDINGS, FILL = 4_000, 400
EPOCHS = 6
#: Weights are averaged in whole multiples of this, so that their order does not matter.
STEP = 2.0 ** -32
#: Held-back logits are counted in bins of this width, cut at ``MOST``: both bound the
#: number of bins, not of findings.
BIN, MOST = 1e-3, 60
RECALL = 0.98
BEFORE, HEAD, TAIL, AFTER = 24, 40, 16, 16
WINDOW = BEFORE + HEAD + TAIL + AFTER
#: Candidates scored at once.
VIEWS = 2_048

# The base patterns.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
_KEYWORDS = ("passw", "secret", "token", "api")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
WORD = re.compile(r"[A-Za-z0-9]{16,}")
#: Shortest candidate.
SHORTEST = 16
# A maximal run, which is what a leftmost greedy match is; both lie in a candidate.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "network")


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """([(start, kind, end)] sorted, runs [(start, end)])."""
    spans, runs, _ = _base(text)
    return spans, runs


def _base(text: str):
    """Base findings, runs, and the values (start, end) of the findings."""
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    spans, values = [], []
    for a, b in runs:
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            spans.extend((m.start(), kind, m.end()) for m in pattern.finditer(text, a, b))
    values.extend((a, b) for a, _, b in spans)
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                spans.append((m.start(), 0, m.end()))
                values.append(m.span(2))
    return sorted(spans), runs, values


def candidates(text: str, spans: list[tuple[int, int, int]], runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches to score: what base findings leave of the runs."""
    out = []
    for a, b in runs:
        at = a
        for s, _, e in [x for x in spans if x[0] < b and a < x[2]] + [(b, 0, b)]:
            if s - at >= SHORTEST:
                out.extend(_stretches(text, at, s))
            at = max(at, e)
    return out


def _stretches(text: str, a: int, b: int) -> list[tuple[int, int]]:
    wide = HEAD + TAIL
    if b - a <= wide:
        out = [(a, b)]
    else:
        out = [(i, i + wide) for i in range(a, b - wide, wide // 2)] + [(b - wide, b)]
    for m in WORD.finditer(text, a, b):
        if m.span() != (a, b):
            c, d = m.span()
            out += [(c, d)] if d - c <= wide else [(i, i + wide) for i in range(c, d - wide, wide // 2)] + [(d - wide, d)]
    return list(dict.fromkeys(out))


def window(text: str, a: int, b: int) -> str:
    """The network's view: text before, head and tail of the run, text after."""
    value = text[a:b]
    head = value[:HEAD]
    tail = value[HEAD:][-TAIL:]
    return (text[max(0, a - BEFORE):a].rjust(BEFORE, "\0") + head.ljust(HEAD, "\0")
            + tail.ljust(TAIL, "\0") + text[b:b + AFTER].ljust(AFTER, "\0"))


def encode(windows: list[str]) -> np.ndarray:
    """Character classes (n, WINDOW): ASCII codes, 127 for all others."""
    flat = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(flat, 127).astype(np.int64).reshape(len(windows), WINDOW)


class CharNetwork:
    """Embedding, one convolution, max and mean pooling, logistic output."""

    SHAPES = {"embed": (128, 8), "place": (4, 8), "filter": (5 * 8, 24), "fbias": (24,),
              "dense": (48, 1), "dbias": (1,)}
    PLACE = np.repeat(np.arange(4), (BEFORE, HEAD, TAIL, AFTER))

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {k: rng.normal(0, 1 / np.sqrt(max(1, s[0] if len(s) > 1 else 99)), s)
                  if not k.endswith("bias") else np.zeros(s) for k, s in self.SHAPES.items()}
        self.p["embed"] = rng.normal(0, 0.5, self.SHAPES["embed"])
        self.scale, self.shift, self.threshold = 1.0, 0.0, 2.0

    def _forward(self, x: np.ndarray):
        p = self.p
        e = p["embed"][x] + p["place"][self.PLACE]
        cols = np.concatenate([e[:, j:e.shape[1] - 4 + j] for j in range(5)], axis=2)
        z = cols @ p["filter"] + p["fbias"]
        h = np.maximum(z, 0)
        top = h.argmax(axis=1)
        pooled = np.concatenate([h.max(axis=1), h.mean(axis=1)], axis=1)
        return cols, z, top, pooled, (pooled @ p["dense"] + p["dbias"])[:, 0]

    def logits(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + batch])[-1] for i in range(0, len(x), batch)]
                              or [np.zeros(0)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability that a candidate is a secret."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -60, 60)))

    def _gradients(self, x, y, w):
        p = self.p
        cols, z, top, pooled, logit = self._forward(x)
        d = (w * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) / len(y))[:, None]
        g = {"dense": pooled.T @ d, "dbias": d.sum(0)}
        dp = d @ p["dense"].T
        dh = np.repeat(dp[:, None, 24:] / z.shape[1], z.shape[1], axis=1)
        np.put_along_axis(dh, top[:, None, :], np.take_along_axis(dh, top[:, None, :], 1)
                          + dp[:, None, :24], 1)
        dz = dh * (z > 0)
        flat = dz.reshape(-1, 24)
        g["filter"], g["fbias"] = cols.reshape(-1, 40).T @ flat, flat.sum(0)
        dc = (flat @ p["filter"].T).reshape(cols.shape)
        de = np.zeros((*x.shape, 8))
        for j in range(5):
            de[:, j:x.shape[1] - 4 + j] += dc[:, :, 8 * j: 8 * j + 8]
        g["embed"] = np.stack([np.bincount(x.ravel(), de[..., k].ravel(), 128) for k in range(8)], 1)
        g["place"] = np.stack([de[:, self.PLACE == k].sum((0, 1)) for k in range(4)])
        return g

    def fit(self, x, y, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7):
        rng = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        m = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        v = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                b = order[i:i + batch]
                t += 1
                for k, g in self._gradients(x[b], y[b], weight[b]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (
                        np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def calibrate(self, x, y, recall: float):
        """Platt scaling on held-back findings, then the threshold."""
        return self.calibrate_counts(self.logits(x), y, 1 - y, recall)

    def calibrate_counts(self, z: np.ndarray, secrets: np.ndarray, others: np.ndarray, recall: float):
        """``calibrate`` from the number of secrets and of others at each logit."""
        a, b = 1.0, 0.0
        n, n1, n0 = max(1, (secrets + others).sum()), secrets.sum(), others.sum()
        high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
        for _ in range(500):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
            d = (secrets * (p - high) + others * (p - low)) / n
            a, b = a - 0.5 * (d * z).sum(), b - 0.5 * d.sum()
        self.scale, self.shift = max(a, 1e-3), b
        order = np.argsort(z, kind="stable")
        upto = np.cumsum(secrets[order])
        if n1:
            at = z[order][np.searchsorted(upto, int(np.floor((1 - recall) * n1)), side="right")]
            self.threshold = min(0.5, 1 / (1 + np.exp(-np.clip(self.scale * at + self.shift, -60, 60))))
        else:
            self.threshold = 2.0
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.SHAPES])

    def set_flat(self, values: np.ndarray):
        at = 0
        for k, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.p[k] = values[at:at + size].reshape(shape)
            at += size
        return self


def _findings_fn(text_col: str):
    def run(cols: dict) -> dict:
        out = {"window": [], "label": []}
        for text in cols[text_col].to_pylist():
            if not text:
                continue
            spans, runs, values = _base(text)
            for label, found in ((1, [v for v in values if v[1] - v[0] >= SHORTEST]),
                                 (0, candidates(text, spans, runs))):
                out["window"] += [window(text, a, b) for a, b in found]
                out["label"] += [label] * len(found)
        return out
    return run


class Scanner:
    """Base patterns plus a fitted network (None: base patterns only)."""

    def __init__(self, network: CharNetwork | None):
        self.network = network

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """[(start, kind, end)] sorted, for each text."""
        found, views, places = [], [], []
        for i, text in enumerate(texts):
            spans, runs = base_spans(text) if text else ([], [])
            found.append(spans)
            if self.network is not None:
                for a, b in candidates(text, spans, runs) if runs else ():
                    views.append(window(text, a, b))
                    places.append((i, a, b))
        hits: dict[int, list[tuple[int, int]]] = {}
        for at in range(0, len(views), VIEWS):
            p = self.network.probability(encode(views[at:at + VIEWS]))
            for (i, a, b), x in zip(places[at:at + VIEWS], p, strict=True):
                if x >= self.network.threshold:
                    hits.setdefault(i, []).append((a, b))
        for i, mine in hits.items():
            merged = []
            for a, b in sorted(mine):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            found[i] = sorted([*found[i], *((a, 3, b) for a, b in merged)])
        return found

    def scan(self, text: Column) -> Column:
        """Struct n_assign, n_access, n_hex, base_sha256, spans."""
        kinds = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")

        @F.arrow_udf("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
        def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in it:
                rows = []
                for spans in self._by_slice(column, lambda texts: self.spans(texts)):
                    named = [(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in spans]
                    base = ",".join(x for k, x in named if k < 3)
                    rows.append((*(sum(k == j for k, _ in named) for j in range(3)),
                                 hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in named)))
                parts = zip(*rows) if rows else [[]] * 5
                yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(
                    parts, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=kinds)
            column = rows = parts = None
            freed()
        return run(text)

    @staticmethod
    def _by_slice(column: pa.Array, work) -> Iterator:
        """``work`` on the texts of a batch, a slice of it as Python strings at a time."""
        for i in range(0, len(column), SLICE_ROWS):
            yield from work(column.slice(i, SLICE_ROWS).to_pylist())

    def redact(self, text: Column, mask: str = "[SECRET]") -> Column:
        """The text with every finding (overlapping ones merged) replaced."""
        def masked(texts: list[str | None]) -> list[str | None]:
            out = []
            for t, spans in zip(texts, self.spans(texts), strict=True):
                at, parts = 0, []
                for a, _, b in spans:
                    if a >= at:
                        parts += [t[at:a], mask]
                    at = max(at, b)
                out.append(t if not spans else "".join(parts) + t[at:])
            return out

        @F.arrow_udf("string")
        def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in it:
                # handed on a slice at a time: a batch's texts are not held twice more
                for i in range(0, max(1, len(column)), SLICE_ROWS):
                    yield pa.array(masked(column.slice(i, SLICE_ROWS).to_pylist()), pa.string())
            column = None
            freed()
        return run(text)


def _generated(label: int, n: int) -> list[str]:
    """``n`` windows of made-up findings of a label."""
    rng = random.Random(7 + label)

    def word() -> str:
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))

    out = []
    for i in range(n):
        if label:
            value = ("".join(rng.choices("0123456789abcdef", k=rng.randint(32, 48))),
                     "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
                     "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=rng.randint(16, 40))))[min(i % 5, 2)]
            before = f'{word()} {rng.choice(("token", "secret", "password", "api_key"))} = "'
        else:
            value = ("/".join(word() for _ in range(5)), ".".join(word() for _ in range(5)),
                     "".join(rng.choices("0123456789", k=16)), "-" * rng.randint(16, 60))[i % 4].ljust(16, "a")
            before = f"{word()} {word()} "
        text = f"{before}{value} {word()} {word()}"
        out.append(window(text, len(before), len(before) + len(value)))
    return out


def fit_scanner(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample_docs: int | None = None, sample_findings: int | None = None) -> Scanner:
    """Train the network on the findings of all documents, each distinct one once.

    ``id_col``, ``sample_docs`` and ``sample_findings`` are not used any more. Null
    texts and repeated rows are allowed; only an empty table gives no network. The
    driver holds the weights and the counts of the logits' bins, no finding.
    """
    if docs.isEmpty():
        return Scanner(None)
    spark = docs.sparkSession
    # as an Arrow table: rows would start Python workers of their own on every executor
    made = spark.createDataFrame(pa.table({
        "window": pa.array([w for label in (0, 1) for w in _generated(label, FILL)], pa.string()),
        "label": pa.array(np.repeat([0, 1], FILL), pa.int32())}))
    found = stored(arrow_map(docs.select(text_col), _findings_fn(text_col), "window string, label int")
                   .unionByName(made).distinct(), "findings")
    parts = -(-found.count() // PART_FINDINGS)
    # the deal and the order inside a part go with the windows alone: reruns agree
    dealt = found.repartitionById(parts, F.pmod(F.xxhash64("window", F.lit(1)), F.lit(parts)).cast("int")) \
        .sortWithinPartitions("window", "label")
    net = CharNetwork()
    for epoch in range(EPOCHS):
        mean = dealt.mapInArrow(_trained(net, epoch), "i int, v bigint") \
            .groupBy("i").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n")).toArrow()
        at = mean["i"].to_numpy()
        values = np.zeros(len(net.flat()))
        values[at] = mean["v"].to_numpy() / mean["n"].to_numpy() * STEP
        net.set_flat(values)
    bins = dealt.mapInArrow(_held_logits(net), "bin int, label int, n bigint") \
        .groupBy("bin").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("secrets"),
                            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("others")) \
        .orderBy("bin").toArrow()
    return Scanner(net.calibrate_counts(*[bins[c].to_numpy().astype(float) * k for c, k in
                                          (("bin", BIN), ("secrets", 1), ("others", 1))], RECALL))


def _part(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(views, labels, held back) of a part; a quarter is held back, by the hash of the window."""
    windows, labels = [], []
    for b in batches:
        windows += b.column("window").to_pylist()
        labels += b.column("label").to_pylist()
    held = [hashlib.md5(w.encode("utf-8", "surrogatepass")).digest()[0] % 4 == 0 for w in windows]
    return encode(windows), np.array(labels, np.int64), np.array(held, bool)


def _trained(net: CharNetwork, epoch: int):
    """Trains ``net`` on from its weights over a part: its new weights, in steps."""
    weights = net.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, held = _part(batches)
        if (~held).any():
            mine = CharNetwork().set_flat(weights.copy())
            mine.fit(*_in_all_forms(x[~held], y[~held]), epochs=1, seed=7 + epoch)
            steps = np.round(np.clip(mine.flat(), -1e3, 1e3) / STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(steps)), pa.int32()), pa.array(steps)],
                                             names=["i", "v"])
        x = y = held = mine = None
        freed()
    return run


def _held_logits(net: CharNetwork):
    """Counts the held-back findings of a part, in all forms, by label and bin of the logit (its
    lower end, so that a threshold read off the bins never finds less)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, held = _part(batches)
        if held.any():
            x, y = _in_all_forms(x[held], y[held])
            at = np.floor(np.clip(net.logits(x), -MOST, MOST) / BIN).astype(np.int64)
            keys, n = np.unique(at * 2 + y, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys // 2, pa.int32()), pa.array(keys % 2, pa.int32()), pa.array(n, pa.int64())],
                names=["bin", "label", "n"])
        x = y = held = None
        freed()
    return run


def _in_all_forms(x: np.ndarray, y: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The findings as they stand, with either or both sides blanked, and between the
    surroundings of a finding of the other label."""
    before, after = slice(0, BEFORE), slice(WINDOW - AFTER, WINDOW)
    forms = [x]
    for sides in ((before,), (after,), (before, after)):
        blank = x.copy()
        for side in sides:
            blank[:, side] = 0
        forms.append(blank)
    swapped, rng = x.copy(), np.random.default_rng(seed)
    for label in (0, 1):
        mine, other = np.flatnonzero(y == label), np.flatnonzero(y != label)
        if len(mine) and len(other):
            of = rng.choice(other, len(mine))
            for side in (before, after):
                swapped[mine, side] = x[of, side]
    forms.append(swapped)
    return np.concatenate(forms), np.concatenate([y] * len(forms))
