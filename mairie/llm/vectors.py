"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into two halves with a codebook each; a pair of codewords is a cell.  Every
vector lies in its home cell.  As a query it visits cells in order of their distance, by walking
the two sorted lists of codewords together (multi-sequence), and stops where the calibrated target
recall is met; each candidate is verified by its cosine in double precision.

The distance of a cell is that of the query to the planes which separate its own codewords from the
cell's.  The limit is calibrated on the sample: vectors turned in a random direction to exactly the
threshold, the hardest links there are, must fall within it with the target probability.  A pair
counts when either of its vectors visits the other, so what is missed is about the square of that.

Equal vectors are collapsed first by an aggregate with map-side combine.  A vector is sent once to
each strip it visits, that is, to all cells of one codeword of the first half.  A strip's homes and
visitors are cut into blocks, and every block pair is some task's work, so a hot strip is spread
over many tasks and none holds it whole.  A task multiplies at most PART by PART vectors of a cell
at once and keeps their links as one boolean matrix: what it holds does not grow with the links,
however near all vectors of a cell are.  A block yields per-vector counts and a forest that
connects its links, never its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from mairie.llm.common import components, discard, store

SAMPLE = 20_000  # vectors that the codebooks and the limit are fitted on; all are indexed
PROBES = 2_000  # turned vectors, at least, that set the limit
PART = 1_024  # homes and visitors of one matrix product
BLOCK_VALUES = 1 << 19  # components of the homes, or visitors, of a block; a part is the least block
RECALL = 0.9995


class MultiIndex:
    """Two codebooks and the visiting limit, fitted on a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, size: int, threshold: float, recall: float = RECALL, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        self.books = [self._codebook(part, size, np.sqrt(max(0.0, 2 - 2 * threshold)), rng) for part in self._halves(sample)]
        gaps = [np.stack([((row - b) ** 2).sum(axis=1) for row in b]) ** 0.5 for b in self.books]
        self.gaps = [np.maximum(g, 1e-12) for g in gaps]
        # A small sample is turned more than once, so that a few vectors do not decide by chance.
        probes = np.resize(sample, (max(len(sample), PROBES if len(sample) else 0), sample.shape[1]))
        turned = rng.normal(size=probes.shape)
        turned -= (turned * probes).sum(axis=1, keepdims=True) * probes
        turned /= np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-12)
        other = threshold * probes + np.sqrt(max(0.0, 1 - threshold**2)) * turned
        parts = [slice(at, at + PART) for at in range(0, len(probes), PART)]
        need = np.concatenate([np.empty(0), *(self.squares(probes[p], self.home(other[p])) for p in parts)])
        # The limit is some vector's distance.  A little more, as products of other shapes differ in the last digits.
        self.limit = float(np.quantile(need, recall, method="higher")) * (1 + 1e-9) if len(need) else 0.0

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half], x[:, self.half :]]

    @staticmethod
    def _codebook(x: np.ndarray, size: int, apart: float, rng) -> np.ndarray:
        """``size`` codewords at most.  They begin ``apart``, for between closer ones linked vectors visit them all."""
        distinct = np.unique(np.round(x, 6), axis=0)
        book = np.empty((min(size, len(distinct)), x.shape[1]))
        n = 0
        for row in distinct[rng.permutation(len(distinct))]:
            if n == len(book):
                break
            if (((book[:n] - row) ** 2).sum(axis=1) >= max(apart**2, 1e-12)).all():
                book[n] = row
                n += 1
        book = book[:n]
        parts = [slice(at, at + PART) for at in range(0, len(x), PART)]
        for _ in range(12):
            near = np.concatenate([np.argmin((book**2).sum(axis=1) - 2 * x[p] @ book.T, axis=1) for p in parts])
            count = np.bincount(near, minlength=len(book))
            total = np.zeros_like(book)
            np.add.at(total, near, x)
            book[count > 0] = total[count > 0] / count[count > 0, None]
        return book

    def margins(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half the distance of each row to the plane between its codeword and every other one."""
        out = []
        for part, book, gap in zip(self._halves(x), self.books, self.gaps, strict=True):
            d = (book**2).sum(axis=1) - 2 * part @ book.T
            best = np.argmin(d, axis=1)
            out.append((d - d[np.arange(len(d)), best][:, None]) / (2 * gap[best]))
        return out

    def home(self, x: np.ndarray) -> np.ndarray:
        near = [np.argmin(m, axis=1) for m in self.margins(x)]
        return near[0] * len(self.books[1]) + near[1]

    def squares(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Squared distance of each row to the given cell."""
        a, b = self.margins(x)
        row = np.arange(len(x))
        return a[row, cells // len(self.books[1])] ** 2 + b[row, cells % len(self.books[1])] ** 2

    def _walk(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[float, int]]:
        """Squared distance and number of each cell, nearest first, from the squared distances to both books' codewords."""
        first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        return self._merged(a[first].tolist(), b[second].tolist(), (first * len(b)).tolist(), second.tolist())

    @staticmethod
    def _merged(near: list[float], far: list[float], first: list[int], second: list[int]) -> Iterator[tuple[float, int]]:
        """Sums of an item of ``near`` and one of ``far``, both sorted, least first, with the sums of their numbers.

        A heap holds the cells on the border of those seen: a cell brings the next codeword of the
        second list, and one in the first column also that of the first list.
        """
        border = [(near[0] + far[0], 0, 0)]
        while border:
            distance, i, j = heapq.heappop(border)
            yield distance, first[i] + second[j]
            if j + 1 < len(far):
                heapq.heappush(border, (near[i] + far[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(near):
                heapq.heappush(border, (near[i + 1] + far[0], i + 1, 0))

    def visits(self, x: np.ndarray) -> Iterator[list[int]]:
        """The cells each row visits, nearest first: it stops at the first one beyond the limit."""
        squares = [m**2 for m in self.margins(x)]
        orders = [np.argsort(s, axis=1, kind="stable") for s in squares]
        a, b = (np.take_along_axis(s, o, axis=1) for s, o in zip(squares, orders, strict=True))
        # A codeword beyond the limit with the nearest one of the other half is in no cell to visit.
        ends = zip((a + b[:, :1] <= self.limit).sum(axis=1).tolist(), (a[:, :1] + b <= self.limit).sum(axis=1).tolist(), strict=True)
        orders[0] *= len(self.books[1])
        for near, far, first, second, (m, n) in zip(a, b, *orders, ends, strict=True):
            cells = []
            for distance, cell in self._merged(near[:m].tolist(), far[:n].tolist(), first[:m].tolist(), second[:n].tolist()):
                if distance > self.limit:
                    break
                cells.append(cell)
            yield cells


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    # Powers of two change no digit and keep the squares of very small or large components finite.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _places(index: MultiIndex):
    """mapInArrow function: adds where each vector is home and what it visits, (visitor, strip, cells) for each strip.

    A strip is all cells of one codeword of the first half; a vector goes once to each.
    """
    across = len(index.books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                x = _matrix(batch.column("embedding"))
                cells = list(index.visits(x))
                row = np.arange(len(x))
                of = np.concatenate([row, np.repeat(row, [len(c) for c in cells])])
                cell = np.concatenate([index.home(x), *map(np.array, cells)]).astype(np.int32)
                visitor = np.arange(len(of)) >= len(x)
                order = np.lexsort((cell // across, visitor, of))
                of, cell, visitor = of[order], cell[order], visitor[order]
                names = np.stack([of, visitor, cell // across])
                starts = np.concatenate([[0], np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1])
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(cell)), pa.int32()), pa.array(cell))
                place = pa.StructArray.from_arrays([pa.array(visitor[starts]), pa.array(cell[starts] // across), lists], ["visitor", "strip", "cells"])
                ends = np.searchsorted(of[starts], np.arange(len(x) + 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), place)], names=[*batch.schema.names, "places"]
                )

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, smallest node) that connect what the links a-b connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = np.arange(len(nodes))
    u, v = at[: len(a)], at[len(a) :]
    while True:
        before = low.copy()
        least = np.minimum(low[u], low[v])
        np.minimum.at(low, u, least)
        np.minimum.at(low, v, least)
        low = low[low]
        if (low == before).all():
            break
    return [(int(nodes[k]), int(nodes[r])) for k, r in enumerate(low) if k != r]


def _tree(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the true cells, one fewer than nodes, that connect what all true cells connect.

    From a row to its columns, from them to their rows and so on: each row and column is read once.
    """
    rows_left, columns_left = link.any(axis=1), link.any(axis=0)
    a, b = [], []
    for root in np.flatnonzero(rows_left):
        rows = np.array([root])[rows_left[root : root + 1]]
        rows_left[rows] = False
        while len(rows):
            reached = link[rows] & columns_left
            columns = np.flatnonzero(reached.any(axis=0))
            if not len(columns):
                break
            a.append(rows[reached[:, columns].argmax(axis=0)])
            b.append(columns)
            columns_left[columns] = False
            reached = link[:, columns] & rows_left[:, None]
            rows = np.flatnonzero(reached.any(axis=1))
            a.append(rows)
            b.append(columns[reached[rows].argmax(axis=1)])
            rows_left[rows] = False
    none = np.empty(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(index: MultiIndex, threshold: float, rows: pa.Table, part: int = PART) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links to count for each row of a block, and the edges of its forest; a cell is taken ``part`` homes by ``part`` visitors."""
    visitor = rows["visitor"].to_numpy()
    x = _matrix(rows["embedding"].combine_chunks())
    keys, ids, n = (rows[name].to_numpy() for name in ("key", "id", "n"))
    links, edges = np.zeros(len(ids), np.int64), [(np.empty(0, np.int64),) * 2]
    lists = rows["cells"].combine_chunks()
    cell, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    order = np.argsort(cell, kind="stable")
    for members in np.split(row[order], np.flatnonzero(np.diff(cell[order])) + 1):
        guest = visitor[members]
        visits, homes = ([w[at : at + part] for at in range(0, len(w), part)] for w in (members[guest], members[~guest]))
        for h in homes:
            for p in visits:
                link = x[p] @ x[h].T >= threshold
                link &= keys[p][:, None] != keys[h]
                some, other = link.any(axis=1), link.any(axis=0)
                if not some.any():
                    continue
                link, u, v = link[some][:, other], p[some], h[other]
                links[u] += link @ n[v]
                # The home vector counts the pair itself if it visits the visitor's home; else here.
                theirs = index.home(x[u])
                one, two = (m**2 for m in index.margins(x[v]))
                far = one[:, theirs // len(index.books[1])] + two[:, theirs % len(index.books[1])] > index.limit
                links[v] += (link.T & far) @ n[u]
                a, b = _tree(link)
                edges.append((ids[u[a]], ids[v[b]]))
    return links, _forest(*map(np.concatenate, zip(*edges, strict=True)))


def _verify(index: MultiIndex, threshold: float):
    """mapInArrow over rows sorted by block: link counts (key, links) and forest edges (a, b), the others null."""

    def block(rows: pa.Table) -> list[tuple]:
        visitor = rows["visitor"].to_numpy()
        if visitor.all() or not visitor.any():
            return []
        links, edges = _links(index, threshold, rows)
        found = np.flatnonzero(links)
        keys = rows["key"].to_numpy()[found]
        out = [(k, n, None, None) for k, n in zip(keys.tolist(), links[found].tolist(), strict=True)]
        return out + [(None, None, u, v) for u, v in edges]

    key = ["strip", "home_block", "visit_block"]
    schema = pa.schema([(name, pa.int64()) for name in ("key", "links", "a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            label = batch.column("label").dictionary_encode()
            names = np.stack([label.indices.to_numpy(), *(batch.column(k).to_numpy().astype(np.int64) for k in key)])
            cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            out = []
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if high == low:
                    continue
                name = (label[int(low)].as_py(), *names[1:, low])
                if held and name != now:
                    out += block(pa.Table.from_batches(held))
                    held = []
                now = name
                held.append(batch.slice(low, high - low))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
        if held and (out := block(pa.Table.from_batches(held))):
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)

    return run


def _sample(classes: DataFrame, total: int) -> pa.Table:
    """The vectors whose ids have the least hashes; those far above the least are not sorted or handed on."""
    hashed = F.xxhash64("id")
    bound = int(2**64 * min(1, 2 * SAMPLE / max(1, total))) - 2**63
    for few in classes.where(hashed < bound) if bound < 2**63 else classes, classes:
        sample = few.orderBy(hashed, "id").limit(SAMPLE).select("embedding").toArrow()
        if sample.num_rows == min(SAMPLE, total):
            break
    return sample


def _placed(classes: DataFrame, threshold: float) -> tuple[MultiIndex, int, DataFrame]:
    """Of the distinct vectors of one dimension (key, id, label, n, embedding): index, number, and they with their places."""
    # A cell is shared out by label: what counts is how many vectors a vector has in its own label, on average.
    labels = classes.groupBy("label").count().agg(F.sum("count"), F.sum(F.col("count").cast("double") ** 2)).first()
    total, alike = labels[0], labels[1] / labels[0]
    sample = _sample(classes, total)
    size = int(np.clip(np.ceil(np.sqrt(alike / 64)), 4, 1024))
    index = MultiIndex(_matrix(sample["embedding"].combine_chunks()), size, threshold)
    place = StructField("places", ArrayType(StructType.fromDDL("visitor boolean, strip int, cells array<int>")))
    return index, total, store(classes.mapInArrow(_places(index), StructType([*classes.schema, place])), "placed")


def _linked(index: MultiIndex, total: int, placed: DataFrame, threshold: float, block: int) -> list[DataFrame]:
    """(key, links, a, b) over the distinct vectors of one dimension."""
    at = placed.select("key", "label", "id", "n", "embedding", F.explode("places").alias("place"))
    at = at.select("key", "label", "id", "n", "embedding", "place.*")
    v = F.col("visitor").cast("int")
    sizes = at.groupBy("label", "strip").agg(F.sum(1 - v).alias("homes"), F.sum(v).alias("visitors"))
    # A strip with one vector is visited by that vector only.
    sizes = sizes.where("homes > 0 and homes + visitors > 2").select(
        "label", "strip", "homes", "visitors",
        F.ceil(F.col("homes") / block).cast("int").alias("hb"),
        F.ceil(F.col("visitors") / block).cast("int").alias("vb"),
    )
    sizes = store(sizes, "sizes")
    sent = sizes.agg(F.sum(F.col("homes") * F.col("vb") + F.col("visitors") * F.col("hb"))).first()[0] or 0
    # Strips are taken in rounds that send about two copies of each vector, so disk holds no more at a time.
    rounds = max(1, ceil(sent / (2 * total)))
    key = ["label", "strip", "home_block", "visit_block"]
    own = F.pmod(F.xxhash64("key"), F.when(F.col("visitor"), F.col("vb")).otherwise(F.col("hb"))).cast("int")
    across = F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("hb")).otherwise(F.col("vb")) - 1)
    found = []
    for now in range(rounds):
        mine = F.pmod(F.xxhash64("label", "strip"), F.lit(rounds)) == now
        rows = at.where(mine).join(sizes.where(mine), ["label", "strip"])
        rows = rows.withColumn("own", own).withColumn("across", F.explode(across))
        rows = rows.select(
            "key", "label", "visitor", "strip", "cells", "id", "n", "embedding",
            F.when(F.col("visitor"), F.col("across")).otherwise(F.col("own")).alias("home_block"),
            F.when(F.col("visitor"), F.col("own")).otherwise(F.col("across")).alias("visit_block"),
        )
        rows = rows.repartition(*key).sortWithinPartitions(*key)
        found.append(store(rows.mapInArrow(_verify(index, threshold), "key bigint, links bigint, a bigint, b bigint"), "links"))
    discard(sizes)
    return found


def near_vectors(vectors: DataFrame, threshold: float = 0.98, block: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Only vectors with equal, non-null labels and equal length are compared.  Null, empty and zero
    vectors and those with a null, NaN or infinite component link with nothing, nor do rows without
    vec_id (component_id null, kept true).  Equal vectors always link; rows that repeat a vec_id
    count as vectors of their own within one node.  Labels of any type are compared by their text, and
    components in the precision they come in.  Other columns are not read.
    """
    single = vectors.select("embedding").schema[0].dataType.simpleString() == "array<float>"
    embedding = F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding")
    rows = vectors.select("vec_id", embedding, F.col("label").cast("string").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("_good", F.coalesce(good, F.lit(False)))
    usable = rows.where("_good")
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    # Numbered where they are written: the stored number names a distinct vector from here on.
    classes = store(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
    dims = [dim for (dim,) in classes.select(F.size("embedding")).distinct().collect()]  # few: one per embedding model
    parts = [_placed(classes.where(F.size("embedding") == dim), threshold) for dim in dims]
    if not parts:
        found = classes.select("key", F.col("n").alias("links"), F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    else:
        discard(classes)
        classes = reduce(DataFrame.union, [placed.drop("places") for *_, placed in parts])
        found = reduce(DataFrame.union, chain.from_iterable(
            _linked(*part, threshold, block or max(PART, BLOCK_VALUES // dim)) for dim, part in zip(dims, parts, strict=True)
        ))
    hashed = F.xxhash64("label", "embedding")
    counts = found.where("a is null").groupBy(F.col("key").alias("_c")).agg(F.sum("links").alias("links"))
    nodes = components(found.where("a is not null").select("a", "b"))
    # Vectors move once to what is known of them, and are stored with it before they meet the rows.
    known = classes.select(F.col("key").alias("_k"), "id", "n")
    known = known.join(counts, F.col("_k") == F.col("_c"), "left").join(nodes, F.col("id") == F.col("node"), "left")
    known = known.select(
        "_k", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"), F.coalesce("component", "id").alias("_component")
    )
    named = classes.select("key", F.col("label").alias("_label"), F.col("embedding").alias("_vector"), hashed.alias("_hash"))
    classes = store(named.join(known, F.col("key") == F.col("_k")).drop("key", "_k"), "named")
    discard(*(placed for *_, placed in parts))
    # Sorted by one number first; vectors are compared where it is equal.
    same = F.col("_good") & (hashed == F.col("_hash")) & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_vector"))
    joined = rows.join(classes, same, "left")
    component = F.coalesce("_component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
