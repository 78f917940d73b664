"""Secret scans by a character convolutional network over every candidate and its surroundings.

The base patterns mark well-known forms.  Further candidates are long runs of key-like characters
and values assigned to other names, whatever characters they hold; the network, written in numpy, reads a candidate with the
characters around it (one convolution, maximum over all positions, linear classes) and says whether
it is a secret and of which kind.  It is trained on the labelled findings of all documents: every base
match as a positive, and as negatives every other word that holds a digit and two further words of
each text.  Findings are dealt into shards by hash; each shard goes through all of its own, and the
networks of the shards are averaged, round after round (``fit``).  The threshold of each kind is
calibrated on all findings set aside: the highest that still recalls the demanded share.  What it
costs is kept beside it, the share of the negatives set aside that reach the threshold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.llm.common import discard, store
from mairie.llm.textbytes import buffer_of, slices, tidy

KINDS = ("assign", "access", "hex")
SHARD = 20_000  # findings that one task goes through; all shards together hold every finding
ROUNDS = 2
STEPS = 400  # of each shard in all rounds, at least: few findings are gone through more often
RECALL = 0.98
AROUND = 24  # characters of context on either side
WIDTH, FILTERS, DIM = 5, 24, 12
LEARNT = ("embed", "filters", "shift", "out", "bias")
SCALE = 1 << 20

_ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs: a run is matched from its first character
_VALUE = re.compile(r"[A-Za-z_]{2,24}[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{8,})")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_WORD = re.compile(r"[^\x20\n]{6,}")
_DIGIT = re.compile(r"\d")
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[48:58] = _HEX_BYTE[97:103] = True
_KEY_BYTE = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-":
    _KEY_BYTE[_c] = True


def base_spans(text: str, long_hex: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then kind; code points, end exclusive.

    An assignment's span is its whole match.
    """
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if long_hex:
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: str, base: list[tuple[int, int, str]], long_run: bool = True) -> list[tuple[int, int]]:
    """Further places to look at: every key-like value and long run apart from base spans."""
    found = set()
    if "=" in text or ":" in text:
        found |= {m.span(1) for m in _VALUE.finditer(text)}
    if long_run:
        found |= {m.span() for m in _RUN.finditer(text)}
    out = []
    for a, b in sorted(found):
        if not any(s < b and e > a for s, e, _ in base) and not (out and out[-1][1] > a):
            out.append((a, b))
    return out


def _long_runs(data: np.ndarray, rows: np.ndarray, which: np.ndarray, length: int) -> np.ndarray:
    """Rows that hold a run of at least ``length`` bytes of the class ``which``; a row's end also ends a run."""
    inside = which[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = rows[(rows > 0) & (rows < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    found = begin[end - begin >= length]
    out = np.zeros(len(rows) - 1, bool)
    out[np.searchsorted(rows, found, "right") - 1] = True
    return out


def _codes(text: str) -> np.ndarray:
    """Character classes: printable ASCII by itself, other letters, other characters; 0 is padding."""
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where((x >= 32) & (x < 127), x - 30, 1).astype(np.int64)


def _views(text: str, a: int, b: int) -> list[str]:
    """The candidate with its surroundings; a very long one as overlapping windows that cover it."""
    low, high = max(0, a - AROUND), min(len(text), b + AROUND)
    return [text[k : min(high, k + 160)] for k in range(low, max(low + 1, high - 80), 80)]


def _windows(text: str, a: int, b: int) -> list[np.ndarray]:
    return [_codes(view) for view in _views(text, a, b)]


@dataclass
class Network:
    embed: np.ndarray  # (classes of characters, DIM)
    filters: np.ndarray  # (WIDTH, DIM, FILTERS)
    shift: np.ndarray
    out: np.ndarray  # (FILTERS, 1 + kinds)
    bias: np.ndarray
    limits: np.ndarray | None = None  # by kind
    false_rates: np.ndarray | None = None  # by kind, of the negatives set aside

    def numbers(self) -> np.ndarray:
        """All that is learnt, as one row."""
        return np.concatenate([getattr(self, n).ravel() for n in LEARNT])

    def moved(self, numbers: np.ndarray) -> Network:
        """A network of the same shape with these numbers."""
        cuts = np.cumsum([getattr(self, n).size for n in LEARNT])[:-1]
        return Network(*[part.reshape(getattr(self, n).shape) for n, part in zip(LEARNT, np.split(numbers, cuts), strict=True)])

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Class probabilities of padded rows of codes, and what the gradient needs."""
        n = codes.shape[1] - WIDTH + 1
        y = np.zeros((len(codes), n, FILTERS)) + self.shift
        for k in range(WIDTH):  # what each character adds at this place of a filter
            y += (self.embed @ self.filters[k])[codes[:, k : k + n]]
        at = y.argmax(axis=1)
        top = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0]
        z = np.maximum(top, 0) @ self.out + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), at, top

    def judge(self, windows: list[list[np.ndarray]]) -> np.ndarray:
        """(candidates, 1 + kinds): the highest probability of each kind over a candidate's windows."""
        flat = [w for ws in windows for w in ws]
        owner = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
        best = np.zeros((len(windows), 1 + len(KINDS)))
        for k in range(0, len(flat), 256):
            p = self.forward(_padded(flat[k : k + 256]))[0]
            np.maximum.at(best, owner[k : k + 256], p)
        return best


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), max(WIDTH, max(map(len, rows)))), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _start(seed: int) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(scale=0.3, size=(97, DIM)), rng.normal(scale=0.15, size=(WIDTH, DIM, FILTERS)), np.zeros(FILTERS),
        rng.normal(scale=0.3, size=(FILTERS, 1 + len(KINDS))), np.zeros(1 + len(KINDS)),
    )


def _descend(net: Network, findings: list[tuple[np.ndarray, int]], passes: int, rate: float, seed: int, weights: np.ndarray | None = None) -> None:
    """Moves ``net`` by going through all (codes, class) findings ``passes`` times; ``weights`` are those of the classes."""
    rng = np.random.default_rng(seed)
    weights = np.ones(1 + len(KINDS)) if weights is None else weights
    first = {n: np.zeros_like(getattr(net, n)) for n in LEARNT}
    second = {n: np.zeros_like(getattr(net, n)) for n in LEARNT}
    steps = 0
    for _ in range(passes):
        order = rng.permutation(len(findings))
        for at in range(0, len(order), 32):
            chosen = order[at : at + 32]
            codes = _padded([findings[k][0] for k in chosen])
            p, place, top = net.forward(codes)
            classes = np.array([findings[k][1] for k in chosen])
            back = p.copy()
            back[np.arange(len(chosen)), classes] -= 1
            back *= (weights[classes] / weights[classes].sum())[:, None]
            grads = {"out": np.maximum(top, 0).T @ back, "bias": back.sum(axis=0)}
            pooled = (back @ net.out.T) * (top > 0)  # (rows, FILTERS), each at its place
            grads["shift"] = pooled.sum(axis=0)
            grads["filters"], grads["embed"] = np.zeros_like(net.filters), np.zeros_like(net.embed)
            row = np.arange(len(chosen))[:, None]
            for k in range(WIDTH):
                there = codes[row, place + k]  # (rows, FILTERS)
                grads["filters"][k] = np.einsum("rf,rfd->df", pooled, net.embed[there])
                np.add.at(grads["embed"], there, pooled[:, :, None] * net.filters[k].T[None])
            steps += 1
            for n in LEARNT:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                step = first[n] / (1 - 0.9**steps) / (np.sqrt(second[n] / (1 - 0.999**steps)) + 1e-8)
                setattr(net, n, getattr(net, n) - rate * step)


def train(findings: list[tuple[np.ndarray, int]], epochs: int = 12, rate: float = 0.01, seed: int = 4, least_steps: int = STEPS) -> Network | None:
    """Network from (codes, class) findings at hand, class 0 for no secret; None without findings of two classes."""
    if len({c for _, c in findings}) < 2:
        return None
    net = _start(seed)
    held = np.arange(len(findings)) % 5 == 4
    fit = np.flatnonzero(~held)
    _descend(net, [findings[k] for k in fit], max(epochs, -(-least_steps // max(1, -(-len(fit) // 32)))), rate, seed)
    check = np.flatnonzero(held) if held.any() else fit
    scores = net.judge([[findings[k][0]] for k in check])
    truth = np.array([findings[k][1] for k in check])
    limits = []
    for kind in range(1, 1 + len(KINDS)):
        mine = scores[truth == kind, kind]
        # The lower of two neighbouring scores, so that no less than the demanded share is recalled.
        limits.append(float(np.quantile(mine, 1 - RECALL, method="lower")) if len(mine) else np.inf)
    net.limits = np.array(limits)
    plain = scores[truth == 0, 1:]
    net.false_rates = (plain >= net.limits).mean(axis=0) if len(plain) else np.zeros(len(KINDS))
    return net


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, class) of base matches, of every other word with a digit, and of two further words of each text."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans = [(a, b, 1 + KINDS.index(kind)) for a, b, kind in base]
            rest = [m.span() for m in _WORD.finditer(text)]
            if base:
                rest = [(a, b) for a, b in rest if not any(s < b and e > a for s, e, _ in base)]
            numbers = [(a, b) for a, b in rest if _DIGIT.search(text, a, b)] if _DIGIT.search(text) else []
            spans += [(a, b, 0) for a, b in {*numbers, *rest[:: max(1, len(rest) // 2)][:2]}]
            rows += [(view, c) for a, b, c in spans for view in _views(text, a, b)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["context", "class"]
        )


def _shard_rows(net: Network, rate: float, weights: np.ndarray):
    """applyInArrow function: a shard's findings to its number and what ``net`` has learnt from all of them, times their number.

    Learnt numbers are whole multiples of 1 / SCALE, so their sums do not depend on an order.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("context").to_pylist(), table.column("class").to_pylist(), strict=True), key=lambda r: (_order(r[0]), *r))
        mine = net.moved(net.numbers())
        _descend(mine, [(_codes(text), c) for text, c in rows], -(-STEPS // (ROUNDS * -(-len(rows) // 32))), rate, len(rows), weights)
        total = np.rint(mine.numbers() * SCALE).astype(np.int64) * len(rows)
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "learnt": pa.array([total], pa.list_(pa.int64()))})

    return run


def _score_rows(net: Network):
    """mapInArrow function: findings to their class and their probability of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = net.judge([[_codes(text)] for text in batch.column("context").to_pylist()])[:, 1:]
                columns = [batch.column("class"), *map(pa.array, scores.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["class", *KINDS])

    return tidy(run)


def _calibrate(net: Network, held: DataFrame) -> None:
    """Sets limits and false rates of ``net`` from all findings set aside; limits are rounded down to four decimals."""
    scored = store(held.mapInArrow(_score_rows(net), "class int, " + ", ".join(f"{kind} double" for kind in KINDS)), "scores")
    own = F.element_at(F.array(*KINDS), F.col("class"))
    bins = scored.where("class > 0").groupBy("class", F.floor(own * 10_000).alias("bin")).count().collect()
    limits = []
    for kind in range(1, 1 + len(KINDS)):
        mine = sorted((r["bin"], r["count"]) for r in bins if r["class"] == kind)
        counts = np.cumsum([n for _, n in mine])
        # The finding whose rank leaves the demanded share above it, or at it.
        limits.append(mine[int(np.searchsorted(counts, int((counts[-1] - 1) * (1 - RECALL)), "right"))][0] / 10_000 if mine else np.inf)
    net.limits = np.array(limits)
    above = [F.avg((F.col(kind) >= F.lit(float(low))).cast("double")) for kind, low in zip(KINDS, limits, strict=True)]
    net.false_rates = np.array([share or 0.0 for share in scored.where("class = 0").agg(*above).first()])
    discard(scored)


def fit(docs: DataFrame) -> Network | None:
    """Network from the findings of all documents; None without findings of two classes.

    One finding in five, by hash, is set aside for the limits; a kind that has none there is calibrated on all it has.
    Classes weigh alike, however many findings they have.  Equal findings count once, so copies and repeated rows
    change nothing, nor does the order or the partitions of the rows.
    """
    found = docs.select("text").mapInArrow(tidy(_findings), "context string, class int").where("context <> ''").distinct()
    name = F.xxhash64("context")
    found = store(found.withColumn("held", F.pmod(name, F.lit(5)) == 4), "findings")
    known = {r["class"]: r for r in found.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("held").cast("int")).alias("held")).collect()}
    if len(known) < 2:
        return None
    fitted = {c: r["n"] - r["held"] for c, r in known.items()}
    weights = np.array([1 / max(1, fitted.get(c, 0)) for c in range(1 + len(KINDS))])
    shards = max(1, -(-sum(fitted.values()) // SHARD))
    learners = found.where("not held").select("context", "class", F.pmod(F.shiftright(name, 8), F.lit(shards)).alias("shard"))
    net = _start(4)
    for k in range(ROUNDS):
        learnt = learners.groupBy("shard").applyInArrow(_shard_rows(net, 0.01 / (1 + 2 * k), weights), "n bigint, learnt array<bigint>")
        sums = learnt.select("n", F.posexplode("learnt").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("i").collect()
        if sums:
            net = net.moved(np.array([r["v"] / r["n"] / SCALE for r in sums]))
    _calibrate(net, found.where(F.col("held") | F.col("class").isin([c for c, r in known.items() if not r["held"]])))
    discard(found)
    return net


def _order(text: str) -> int:
    """A fixed order that mixes the classes."""
    return zlib.crc32(text.encode())


def find_secrets(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, base, spans) of each row: ``kind:start:end`` lists of base spans, and with those the network adds.

    Null and empty texts have none.  Every row is judged on its own, so repeated rows and missing
    ids are as any other.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            data, rows = buffer_of(batch.column("_text"))
            long_hex = _long_runs(data, rows, _HEX_BYTE, 24)
            long_run = _long_runs(data, rows, _KEY_BYTE, 20)
            out, pending = [], []
            for k, text in enumerate(batch.column("_text").to_pylist()):
                base = base_spans(text or "", bool(long_hex[k]))
                out.append([base, list(base)])
                if net is not None and text:
                    pending += [(k, a, b, _windows(text, a, b)) for a, b in candidates(text, base, bool(long_run[k]))]
            if pending:
                scores = net.judge([p[3] for p in pending])[:, 1:]
                for (k, a, b, _), s in zip(pending, scores, strict=True):
                    kind = int(s.argmax())
                    if s[kind] >= net.limits[kind]:
                        out[k][1].append((a, b, KINDS[kind]))
            lists = [
                pa.array([",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(o[n], key=lambda s: (s[0], KINDS.index(s[2])))) for o in out], pa.string())
                for n in range(2)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "base", "spans"])

    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, base string, spans string")
