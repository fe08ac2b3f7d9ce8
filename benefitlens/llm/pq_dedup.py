"""Embedding near-dedup by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank.

Vectors of unit length with a cosine of c or more are at most r = sqrt(2 - 2c) apart; every bound below uses this
reach r, so the search loses no link:

* **Coarse lists.** Centroids (about a quarter of the root of the number of distinct vectors, none within r of another at the
  start) are fitted on a bounded sample; every vector is indexed in the list of its nearest centroid.
* **Sufficient probes.** Say x lies in list a and y in list b. The plane half way between both centroids parts them,
  so x's and y's distances from it add up to |x - y| at most: if they are linked, one of them is within r / 2 of the
  plane. So a vector probes just the lists with such a plane near it, and each pair is found from one side or both;
  when both probe, the pair counts in the list with the greater number only.
* **Asymmetric distances.** The residual to the centroid is coded by subspace (``SUB`` values to a byte). A probing
  vector's squared distances to all codewords are tabulated, and a list's entries are compared by table look-ups.
  An entry keeps the length e of what its code misses; |x - code(y)| > r + e proves that x and y aren't linked.
* **Exact rerank** of all others: the cosine in double precision decides.

Equal vectors are indexed once with their number. Entries within r / 2 of their centroid are its core: any two of them
are linked, so a tight group, however large, is counted and joined up without comparing its members with one another.
Lists are split into blocks of ``BLOCK`` entries, and the vectors that probe a list are dealt over copies of it, so no
task's work follows the size of a list or group. Links aren't emitted: a task returns for each vector how many links
it has there and one vector it hangs together with; only those few go into the components.

Defined results: null vectors, zero vectors and vectors with null or non-finite components link with nothing, equal
ones among them too; vectors of different lengths are never linked. Every row gives one row, repeated vec_ids too; a
null vec_id counts last in finding the smallest (component_id is null where no member has an id), and such a row is
kept only if it is alone. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benefitlens.llm.common import join_groups, on_workers, written
from benefitlens.llm.components import components

#: Distinct vectors that centroids and codewords are fitted on, at most (about: a share of them by hash).
SAMPLE = 32_768
MOST_LISTS = 4_096
#: Rows of the sample that the codewords are fitted on.
CODED = 8_192
#: Values of a vector to a code byte; codewords of a subspace.
SUB, WORDS = 8, 256
#: Entries of a list in one block, vectors that probe one copy of a list, and vectors compared at once.
BLOCK, PROBING, AT_ONCE = 8_192, 65_536, 256
#: Room for rounding in every bound.
SLACK = 1e-6

_INDEX = "class_id bigint, size bigint, list int, core boolean, vector binary, code binary, missed double, probes array<int>"
_INDEX_ARROW = pa.schema([("class_id", pa.int64()), ("size", pa.int64()), ("list", pa.int32()), ("core", pa.bool_()), ("vector", pa.binary()), ("code", pa.binary()), ("missed", pa.float64()), ("probes", pa.list_(pa.int32()))])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0)


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spaced(x: np.ndarray, most: int, apart: float) -> np.ndarray:
    """The first rows that aren't within ``apart`` of one taken before, ``most`` at most."""
    out, free = [], np.ones(len(x), bool)
    while len(out) < most and free.any():
        c = x[int(free.argmax())]
        out.append(c)
        free &= ((x - c) ** 2).sum(1) > apart * apart
    return np.array(out)


def k_means(x: np.ndarray, start: np.ndarray, rounds: int) -> np.ndarray:
    centres = start
    for _ in range(rounds):
        near = np.concatenate([squared(part, centres).argmin(1) for part in np.array_split(x, 1 + len(x) // 2048)])
        order = np.argsort(near, kind="stable")
        some, first, n = np.unique(near[order], return_index=True, return_counts=True)
        centres = centres.copy()
        centres[some] = np.add.reduceat(x[order], first) / n[:, None]
    return centres


class Quantizer:
    """Centroids of the lists and codewords of the residuals' subspaces; its size is bounded by its parameters."""

    def __init__(self, sample: np.ndarray, n_lists: int, cosine: float):
        x = units(sample)
        self.reach = math.sqrt(2 - 2 * cosine)
        centres = k_means(x, spaced(x, n_lists, self.reach), 5)
        # centroids that have moved together become one, so that a tight group has one list
        self.centres = k_means(x, spaced(centres, n_lists, self.reach), 3)
        self.pad = -x.shape[1] % SUB
        near = np.concatenate([squared(part, self.centres).argmin(1) for part in np.array_split(x, 1 + len(x) // 2048)])
        residual = self.parts(x - self.centres[near])[:CODED]
        self.words = []
        for m in range(residual.shape[1]):
            start = spaced(residual[:, m], WORDS, 1e-9)
            self.words.append(k_means(residual[:, m], start, 4))

    def parts(self, residual: np.ndarray) -> np.ndarray:
        """Rows cut into subspaces: (row, subspace, value)."""
        return np.pad(residual, ((0, 0), (0, self.pad))).reshape(len(residual), -1, SUB)

    def entries(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """(list, whether in its core, codes, what the codes miss, lists to probe) of unit vectors."""
        c = self.centres
        gap = squared(x, c)
        near = gap.argmin(1)
        own = gap[np.arange(len(x)), near]
        apart = np.sqrt(squared(c, c))
        plane = (gap - own[:, None]) / np.maximum(2 * apart[near], 1e-12)  # distance from the plane between both centroids
        probe = plane <= self.reach / 2 + SLACK
        probe[np.arange(len(x)), near] = False
        residual = self.parts(x - c[near])
        codes, said = np.zeros(residual.shape[:2], np.uint8), np.zeros_like(residual)
        for m, words in enumerate(self.words):
            codes[:, m] = squared(residual[:, m], words).argmin(1)
            said[:, m] = words[codes[:, m]]
        missed = np.sqrt(((residual - said) ** 2).sum((1, 2)))
        return near, np.sqrt(own) <= self.reach / 2 - SLACK, codes, missed, [np.flatnonzero(p).astype(np.int32) for p in probe]

    def tables(self, x: np.ndarray, which: int) -> list[np.ndarray]:
        """For each subspace, squared distances of a list's codewords to the vectors' residuals: (word, vector)."""
        residual = self.parts(x - self.centres[which])
        return [squared(w, residual[:, m]).astype(np.float32) for m, w in enumerate(self.words)]


class Cell:
    """One block of a list's entries: links with vectors that probe it, counted and joined up."""

    def __init__(self, quantizer: Quantizer, cosine: float, which: int):
        self.q, self.cosine, self.which = quantizer, cosine, which
        self.held: list[tuple] = []
        self.ids = np.zeros(0, np.int64)

    def add(self, ids, sizes, core, unit, code, missed, probes) -> None:
        self.held.append((ids, sizes, core, unit, code, missed, probes))

    def filled(self) -> bool:
        """Takes in the entries, which all come before the first vector to compare; whether there are any."""
        if self.held:
            self.ids, self.sizes, self.core, self.unit, self.code, self.missed = [np.concatenate(c) for c in list(zip(*self.held))[:6]]
            self.probes = [p for h in self.held for p in h[6]]
            self.held = []
            self.n = np.zeros(len(self.ids), np.int64)
            self.label = np.arange(len(self.ids))
            self.probing: dict[int, np.ndarray] = {}
        return len(self.ids) > 0

    def _probe(self, other: int) -> np.ndarray:
        """Which entries probe the other list."""
        if other not in self.probing:
            self.probing[other] = np.fromiter((other in p for p in self.probes), bool, len(self.probes))
        return self.probing[other]

    def _links(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (vector, entry) that are linked: look-ups first, then the cosine."""
        gap = 0
        for m, table in enumerate(self.q.tables(x, self.which)):
            gap = gap + table[self.code[:, m]]
        j, i = np.nonzero(gap <= ((self.q.reach + self.missed + 1e-3) ** 2).astype(np.float32)[:, None])
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            s = slice(at, at + (1 << 15))
            keep[s] = np.einsum("ij,ij->i", x[i[s]], self.unit[j[s]]) >= self.cosine
        return i[keep], j[keep]

    def _join(self, i: np.ndarray, j: np.ndarray, vectors: int) -> np.ndarray:
        """Joins up entries through the vectors they are linked with; returns an entry of each linked vector, else -1."""
        first = np.full(vectors, len(self.label))
        while True:
            np.minimum.at(first, i, self.label[j])
            low = first[i]
            changed = low < self.label[j]
            if not changed.any():
                break
            root = self.label.copy()
            np.minimum.at(root, self.label[j[changed]], low[changed])
            while (root[root] != root).any():
                root = root[root]
            self.label = root[self.label]
        return np.where(first < len(self.label), first, -1)

    def within(self) -> None:
        """Links among the block's own entries, but for two of the core."""
        for at in range(0, len(self.ids), AT_ONCE):
            i, j = self._links(self.unit[at : at + AT_ONCE])
            i += at
            keep = (i < j) & ~(self.core[i] & self.core[j])
            i, j = i[keep], j[keep]
            np.add.at(self.n, i, self.sizes[j])
            np.add.at(self.n, j, self.sizes[i])
            self._join(np.concatenate([i - at, i - at]), np.concatenate([j, i]), AT_ONCE)

    def compare(self, ids, sizes, unit, lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, entry it hangs together with, links) of the vectors of other blocks that have links here."""
        i, j = self._links(unit)
        if len(i):
            keep = np.ones(len(i), bool)
            for other in np.unique(lists[i]):
                if other > self.which:  # there, the entries that probe the other list count it
                    at = np.flatnonzero(lists[i] == other)
                    keep[at] = ~self._probe(int(other))[j[at]]
            i, j = i[keep], j[keep]
        np.add.at(self.n, j, sizes[i])
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, i, self.sizes[j])
        first = self._join(i, j, len(ids))
        some = np.flatnonzero(first >= 0)
        return ids[some], self.ids[first[some]], n[some]

    def totals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the block's entries."""
        some = np.flatnonzero((self.n > 0) | (self.label != np.arange(len(self.label))))
        return self.ids[some], self.ids[self.label[some]], self.n[some]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    on_workers(spark)
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"  # as they travel
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("embedding"))
    rows = rows.withColumn("sound", F.coalesce(v.isNotNull() & sound, F.lit(False)))
    good, bad = rows.filter("sound").drop("sound"), rows.filter("NOT sound")
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("class_id"), "*", F.size("embedding").alias("length")), "pq-classes")
    # lengths of vectors that occur more than once; a production table has one
    lengths = [r["length"] for r in classes.groupBy("length").count().filter("count > 1").orderBy("length").collect()]
    alone = bad.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = None
    for length in lengths:
        part = _links(spark, classes.filter(F.col("length") == length), cosine, kind)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "class_id bigint, other bigint, n bigint")
    found = written(found, "pq-links")
    links = found.groupBy("class_id").agg(F.sum("n").alias("n"))
    labels = components(found.filter("class_id != other").select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    known = classes.join(links, "class_id", "left").join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = written(known.select("embedding", "size", "first_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("label", "class_id").alias("label")), "pq-known")
    smallest = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = written(known.join(smallest, "label").select("embedding", "size", (F.col("n") + F.col("size") - 1).alias("n_links"), "component_id", "label"), "pq-decided")
    out = join_groups(good, known, "embedding", "size")
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0).alias("kept")).unionByName(alone)


def _links(spark: SparkSession, classes: DataFrame, cosine: float, kind: str) -> DataFrame:
    """class_id, other (a class it hangs together with), n (rows linked there), of distinct vectors of one length."""
    n = classes.count()
    share = min(1.0, SAMPLE / n)
    picked = classes.filter(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else classes
    sample = picked.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").toArrow()
    points = np.array(sample.column(0).to_pylist(), np.float64)
    quantizer = Quantizer(points, min(MOST_LISTS, max(1, round(math.sqrt(n) / 4))), cosine)
    held = spark.sparkContext.broadcast(quantizer)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.array(part.column(2).to_pylist(), np.float64)
                near, core, codes, missed, probes = held.value.entries(units(x))
                data = [part.column(0), part.column(1), near.astype(np.int32), core, [r.tobytes() for r in x.astype(kind)], [r.tobytes() for r in codes], missed, probes]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(data, _INDEX_ARROW)], schema=_INDEX_ARROW)

    entries = written(classes.select("class_id", "size", "embedding").mapInArrow(index, _INDEX), "pq-index")
    sent = _cells(entries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = key = None
        for batch in batches:
            where, role = list(zip(*[batch.column(i).to_pylist() for i in range(3)])), batch.column(3).to_pylist()
            at = 0
            while at < len(where):
                end = at + 1
                while end < len(where) and end - at < AT_ONCE and where[end] == where[at] and role[end] == role[at]:
                    end += 1
                part = batch.slice(at, end - at)
                ids, sizes, lists = [part.column(i).to_numpy() for i in (4, 5, 6)]
                unit = units(np.frombuffer(b"".join(part.column(8).to_pylist()), kind).reshape(end - at, -1).astype(np.float64))
                if where[at] != key:
                    if cell is not None:
                        yield from _answer(cell, key[2] == 0)
                    cell, key = Cell(held.value, cosine, where[at][0]), where[at]
                if role[at] == 0:
                    code = np.frombuffer(b"".join(part.column(9).to_pylist()), np.uint8).reshape(end - at, -1)
                    cell.add(ids, sizes, part.column(7).to_numpy(zero_copy_only=False), unit, code, part.column(10).to_numpy(), part.column(11).to_pylist())
                elif cell.filled():
                    yield _linked(cell.compare(ids, sizes, unit, lists))
                at = end
        if cell is not None:
            yield from _answer(cell, key[2] == 0)

    found = sent.mapInArrow(search, "class_id bigint, other bigint, n bigint")
    # any two entries of a core are linked
    cores = entries.filter("core").groupBy("list").agg(F.min("class_id").alias("other"), F.sum("size").alias("total"))
    return found.unionByName(entries.filter("core").join(F.broadcast(cores), "list").select("class_id", "other", (F.col("total") - F.col("size")).alias("n")))


def _cells(entries: DataFrame) -> DataFrame:
    """Entries and the vectors that probe them, dealt to cells (list, block, copy); entries come first in a cell.

    Core entries fill blocks of their own, so the others of their list are all that is compared with them there.
    """
    sizes = entries.groupBy("list").agg(F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_rest"))
    probing = entries.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n_probing"))
    per = lambda c, most: F.ceil(F.col(c) / F.lit(most)).cast("int")
    lists = sizes.join(probing, "list", "left").select(F.col("list").alias("in_list"), per("n_core", BLOCK).alias("cores"), (per("n_core", BLOCK) + per("n_rest", BLOCK)).alias("blocks"), F.greatest(F.lit(1), F.ceil((F.coalesce("n_probing", F.lit(0)) + F.col("n_rest")) / F.lit(PROBING)).cast("int")).alias("copies"))
    lists = F.broadcast(written(lists, "pq-lists"))  # a row for each list, MOST_LISTS at most
    deal = lambda salt, n: F.pmod(F.xxhash64("class_id", F.lit(salt)), n).cast("int")
    block = F.when(F.col("core"), deal(1, F.greatest("cores", F.lit(1)))).otherwise(F.col("cores") + deal(1, F.greatest(F.col("blocks") - F.col("cores"), F.lit(1))))
    own = entries.join(lists, entries["list"] == lists["in_list"]).withColumn("block", block)
    columns = ["class_id", "size", "list", "core", "vector", "code", "missed", "probes"]
    as_entry = own.select(F.col("in_list"), "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("role"), *columns)
    plain = ["class_id", "size", "list", "core", "vector", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("missed"), F.lit(None).cast("array<int>").alias("probes")]
    # the rest of a list meets its core blocks and the later blocks of the rest
    meets = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: (b < F.col("cores")) | (b > F.col("block")))
    rest = own.filter("NOT core").select("in_list", F.explode(meets).alias("block"), deal(2, F.col("copies")).alias("copy"), F.lit(1).alias("role"), *plain)
    far = entries.select(*columns, F.explode("probes").alias("to")).join(lists, F.col("to") == F.col("in_list"))
    far = far.select("in_list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), deal(2, F.col("copies")).alias("copy"), F.lit(1).alias("role"), *plain)
    cells = as_entry.unionByName(rest).unionByName(far)
    return cells.repartition("in_list", "block", "copy").sortWithinPartitions("in_list", "block", "copy", "role")


def _linked(columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["class_id", "other", "n"])


def _answer(cell: Cell, first_copy: bool) -> Iterator[pa.RecordBatch]:
    """What a finished cell has found; its entries are compared with one another in one copy only."""
    if cell.filled():
        if first_copy:
            cell.within()
        yield _linked(cell.totals())
