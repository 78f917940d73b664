"""Packing token pieces into windows by non-negative least squares over shallow length combinations.

A document's ids are cut into whole windows and one tail.  Tail lengths are counted in bins of
``GRAIN`` tokens; every combination of at most ``DEPTH`` bins that fills a window exactly is a
column, and non-negative least squares finds how often to use each so that the columns add up to
the histogram.  The counts are rounded down and what is left is packed greedily, largest first.

Only the histogram (at most ``window`` numbers) reaches the driver, and only the resulting list of
combinations, whose size depends on ``window`` and ``GRAIN`` alone, goes back; ranks that match
pieces to combinations come from counts by slice, so a length that a third of all tails share is
spread over many tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mairie.llm.common import store
from mairie.llm.textbytes import slices, tidy
from mairie.llm.tokens import encoder

WINDOW = 1024
GRAIN = 8
DEPTH = 3
SLICE_ROWS = 2_000


def cut_pieces(docs: DataFrame, window: int = WINDOW, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids) of each piece; ids are little-endian unsigned 32-bit numbers.

    A document's ids are those of its whole text as the tokenizer file gives them, its added token
    included, and ``end_id``; null and empty texts give the end alone.  Rows that repeat, or have no doc_id, are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special=True).encode
        for batch in slices(batches, "_text", 2 << 20):
            flat, begins = encode(batch.column("_text"))
            sizes = np.diff(begins)
            tokens = sizes + 1
            count = -(-tokens // window)
            row = np.repeat(np.arange(len(sizes)), count)
            order = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = order * window
            length = np.minimum(tokens[row] - start, window)
            # One end id after each row's ids.
            ids = np.full(len(flat) + len(sizes), end_id, "<u4")
            ids[np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)] = flat
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            blob = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(ends * 4), pa.py_buffer(ids.tobytes())]
            )
            names = ["doc_id", "start", "length", "doc_tokens", "ids"]
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(tokens[row])]
            yield pa.RecordBatch.from_arrays([*columns, blob.cast(pa.binary())], names=names)

    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(tidy(run), schema)


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` bin sizes that add up to ``bins``."""
    found = [(bins,)]

    def grow(parts: tuple[int, ...], left: int, least: int) -> None:
        if len(parts) == depth - 1:
            if left >= least:
                found.append((*parts, left))
            return
        for size in range(least, left + 1):
            if left == size:
                found.append((*parts, size))
            elif left - size >= size:
                grow((*parts, size), left - size, size)

    if depth > 1:
        grow((), bins, 1)
    return sorted({tuple(sorted(x)) for x in found})


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    gram, target = a.T @ a, a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(6 * a.shape[0]):
        slope = target - gram @ x
        slope[passive] = -np.inf
        if slope.max(initial=-np.inf) <= tolerance:
            break
        passive[int(np.argmax(slope))] = True
        while True:
            use = np.flatnonzero(passive)
            part = np.zeros_like(x)
            part[use] = np.linalg.lstsq(gram[np.ix_(use, use)], target[use], rcond=None)[0]
            bad = use[part[use] <= tolerance * 1e-6]
            if not len(bad):
                x = part
                break
            step = np.min(x[bad] / np.maximum(x[bad] - part[bad], 1e-300))
            x = x + min(max(step, 0.0), 1.0) * (part - x)
            drop = passive & (x <= tolerance * 1e-6)
            drop[bad[np.argmin(x[bad])]] = True
            passive &= ~drop
            x[~passive] = 0
            if not passive.any():
                break
    return x


def plan_sequences(histogram: dict[int, int], bins: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, how often) so that every piece of the histogram is used exactly once."""
    left = np.zeros(bins + 1, np.int64)
    for size, n in histogram.items():
        left[size] += n
    out = [((bins,), int(left[bins]))] if left[bins] else []
    left[bins] = 0
    shapes = [c for c in combinations(bins) if len(c) > 1 and all(left[k] for k in c)]
    if shapes:
        used = np.zeros((bins + 1, len(shapes)))
        for k, shape in enumerate(shapes):
            for size, n in Counter(shape).items():
                used[size, k] = n
        times = nonnegative_least_squares(used, left.astype(float))
        for k in np.argsort(-times, kind="stable"):
            need = Counter(shapes[k])
            n = min(int(times[k] + 1e-6), *(int(left[size]) // c for size, c in need.items()))
            if n > 0:
                out.append((shapes[k], n))
                for size, c in need.items():
                    left[size] -= n * c
    while left.any():
        shape, room, here = [], bins, left.copy()
        for size in range(bins, 0, -1):
            take = min(room // size, int(here[size]))
            shape += [size] * take
            room -= take * size
        n = min(int(left[size]) // c for size, c in Counter(shape).items())
        out.append((tuple(shape), n))
        for size, c in Counter(shape).items():
            left[size] -= n * c
    return out


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(bin, first rank, last rank, sequence of the first, slot): which ranks of a bin go where."""
    taken: Counter = Counter()
    sequence, rows = 0, []
    for shape, n in plan:
        for slot, size in enumerate(shape):
            rows.append((size, taken[size], taken[size] + n - 1, sequence, slot))
            taken[size] += n
        sequence += n
    return rows


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` with sequence_id and offset; any columns beside ``length`` come along.

    ``pieces`` should be stored: it is read for the histogram, for ranks and for the result.
    Lengths run from 1 to ``window``.  Which of several equally long pieces takes which place follows
    from a hash of their columns, so reruns over the same rows agree; pieces that are equal in all columns
    may change places.  Null columns are as any other value; an empty table gives an empty one.  Long
    columns, such as ids, should be left out and joined afterwards.
    """
    spark = pieces.sparkSession
    bin_of = F.ceil(F.col("length") / GRAIN).cast("int")
    counted = pieces.groupBy(bin_of.alias("bin")).count().collect()  # at most window / GRAIN rows
    total = sum(r["count"] for r in counted)
    plan = plan_sequences({r["bin"]: r["count"] for r in counted}, -(-window // GRAIN))
    if not total:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    slots = spark.createDataFrame(_slots(plan), "_bin int, _first bigint, _last bigint, _sequence bigint, _slot int")

    keys = pieces.columns  # all of them, so pieces without doc_id or of a repeated one are spread as well
    ranked = pieces.withColumn("_b", bin_of).withColumn("_h", F.xxhash64(*keys))
    ranked = ranked.withColumn("_k", F.pmod("_h", F.lit(max(1, -(-total // SLICE_ROWS)))))
    counts = ranked.groupBy("_b", "_k").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col("_b").alias("_bb"), F.col("_k").alias("_kk"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    local = Window.partitionBy("_b", "_k").orderBy("_h", *keys)
    ranked = ranked.withColumn("_r", F.row_number().over(local) - 1)
    ranked = ranked.join(base, (F.col("_b") == F.col("_bb")) & (F.col("_k") == F.col("_kk")))
    rank = F.col("_base") + F.col("_r")
    # The list of combinations is bounded by window and GRAIN, whatever the number of pieces.
    placed = ranked.withColumn("_rank", rank).join(
        F.broadcast(slots), (F.col("_b") == F.col("_bin")) & F.col("_rank").between(F.col("_first"), F.col("_last"))
    )
    placed = placed.withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_first"))
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(*pieces.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of whole sequences, pieces in place; a group holds one window at most.

    Null ids add nothing; repeated rows are added as often as they stand there; an empty table gives an empty one.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, F.coalesce(x["ids"], F.lit(b""))))
    return joined.select("sequence_id", whole.alias("ids"))


def pack_documents(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Pieces of ``docs`` with their ids, sequence_id and offset.

    Ranks and places are found on lengths alone; the ids are joined to them once.
    """
    pieces = cut_pieces(docs, window, tokenizer=tokenizer).withColumn("piece", F.monotonically_increasing_id())
    pieces = store(pieces, "pieces")  # written once, which also fixes the numbers
    placed = pack(pieces.select("piece", "doc_id", "start", "length"), window).select("piece", "sequence_id", "offset")
    return pieces.join(placed, "piece").drop("piece")
