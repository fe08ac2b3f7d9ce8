"""N-gram Jaccard join: a blocked sparse matrix product of document by n-gram incidence.

Rows of the incidence matrix are documents, columns are the 64-bit hashes of their
5-word shingles. Documents with the same row are one class. The product of the
matrix with its transpose counts the shingles that two classes share. It's taken
in blocks of columns, and pairs whose sizes already rule them out never arise:

* a pair over the threshold shares one of the first n - ceil(0.8 n) + 1 columns of
  both rows, in any one order of all columns, so only those columns are multiplied.
  The order puts columns that many documents of a block share last; that choice
  (from partial counts, at most ``COMMON`` columns) steers the work, not the result;
* at the first shared column, what is left of both rows bounds the overlap; the
  sizes themselves have to lie within 0.8 of each other.

In a group of near copies every pair would pass these bounds, so the product goes
in two steps. First each column links its rows to one of them, a pivot (the row
in which the fewest rarer columns come before, as in the text that the others were
copied from); the overlaps of these pairs are completed from the full rows, and what links becomes
components. Then, for each column, only pairs of rows from different components
are left to multiply. No pair of different components that could link is left
out, and within a component no further link changes the result.

Full rows travel only for classes that occur in a pair. Which these are reaches
the tasks as a bitmap of fixed size; a class let through by mistake meets no pair.

Defined results: a null text is empty; documents with fewer words than a shingle
have their whole sequence as one; without words the set is empty and links with
nothing; repeated rows are copies; a null doc_id takes part without naming a
component; an empty table gives no rows; other columns are ignored. Equality of
64-bit hashes stands for equality of shingles and of whole sets.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.llm.common import id_text, join_groups, on_workers, text_digest, without_rows, written
from benefitlens.llm.components import components
from benefitlens.llm.words import seeded_hashes

WORDS = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Columns that the order puts last, at most, and how often a column must occur among the rows of a task's run.
COMMON, COMMON_IN_RUN = 1 << 19, 3
RUN_SHINGLES = 4_000_000
GROUP_BYTES = 1_000_000
#: Bits of the bitmap that says which classes occur in a pair.
BITMAP_BITS = 23

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Fixed odd factors of the words' places in a shingle.
_PLACES = [np.uint64(pow(0xBF58476D1CE4E5B9, i + 1, 1 << 64) | 1) for i in range(WORDS)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M1
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], seed: int = 0) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; one seed makes hashes that can be compared."""
    # after the translation a line feed can only be a border between texts
    data = np.frombuffer(b"\n" + b"\n".join(t.encode("utf-8").translate(_LOWER) for t in texts) + b"\n", np.uint8)
    blank = (data == 0x20) | (data == 0x0A)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    first, last = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        word = _mix(seeded_hashes(data, first, last, seed) + (last - first).astype(np.uint64) * _M1)
        border = np.searchsorted(first, np.flatnonzero(data == 0x0A))
        n = np.diff(border)
        if len(word) >= WORDS:
            every = sum((word[i : len(word) - WORDS + 1 + i] * _PLACES[i] for i in range(1, WORDS)), word[: len(word) - WORDS + 1] * _PLACES[0])
            every = _mix(every)
        out = []
        for start, k in zip(border[:-1].tolist(), n.tolist()):
            if k >= WORDS:
                out.append(np.unique(every[start : start + k - WORDS + 1]))
            elif k:
                few = np.uint64(k) * _M1
                for i in range(k):
                    few = few + word[start + i] * _PLACES[i]
                out.append(_mix(np.array([few], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _class_of(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], column: int, seed: int, carried: bool = False) -> Iterator[tuple]:
    """(ids, sets) of one group of texts after another, and what the third column holds if it's carried along."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(column).to_pylist()
        first, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= GROUP_BYTES or i + 1 == len(texts):
                yield ids[first : i + 1], shingle_sets(texts[first : i + 1], seed), *([batch.column(2).slice(first, i + 1 - first)] if carried else [])
                first, size = i + 1, 0


def _incidence(docs: DataFrame, seed: int) -> DataFrame:
    """Rows of two kinds: (doc_id, n, class) of each document, and (shingle, times) of a task's common shingles. A third
    column of ``docs`` (bytes) goes with the documents as ``exact``."""
    carried = len(docs.columns) > 2
    names = ["doc_id", "n", "class", "shingle", "times", *(["exact"] if carried else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def common():
            shingle, times = np.unique(np.concatenate(held), return_counts=True)
            shingle, times = shingle[times >= COMMON_IN_RUN], times[times >= COMMON_IN_RUN]
            none = pa.nulls(len(shingle), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(shingle.view(np.int64)), pa.array(times), *([pa.nulls(len(shingle), pa.binary())] if carried else [])], names=names)

        for ids, sets, *exact in _sets(batches, 1, seed, carried):
            classes = [_class_of(s) for s in sets]
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()), none, none, *exact], names=names)
            for c, s in zip(classes, sets):
                if c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            if size >= RUN_SHINGLES:
                yield common()
                held, size = [], 0
        if held:
            yield common()

    return docs.mapInArrow(run, "doc_id bigint, n bigint, class bigint, shingle bigint, times bigint" + (", exact binary" if carried else ""))


def _common_columns(incidence: DataFrame) -> np.ndarray:
    """The commonest shingles, rarest first: at most ``COMMON``."""
    counted = incidence.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    top = counted.orderBy(F.desc("times"), "shingle").limit(COMMON).select("shingle").toArrow()
    return top.column(0).to_numpy().view(np.uint64)[::-1]


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _prefixes(docs: DataFrame, common: np.ndarray, seed: int) -> DataFrame:
    """column, class, n, place of the columns of each class that take part in the product; a class once a task."""
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, rank = shared.value
        seen: set[int] = set()
        for _, sets in _sets(batches, 1, seed):
            picked, classes, sizes = [], [], []
            for s in sets:
                c = _class_of(s)
                if len(s) and c not in seen:
                    seen.add(c)
                    k = prefix_length(len(s))
                    if len(columns):
                        at = np.minimum(np.searchsorted(columns, s), len(columns) - 1)
                        late = columns[at] == s
                        if late.any():
                            s = np.concatenate([s[~late], s[late][np.argsort(rank[at[late]])]])
                    picked.append(s[:k])
                    classes.append(c)
                    sizes.append(len(s))
            if picked:
                lengths = np.array([len(p) for p in picked])
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(picked).view(np.int64)), pa.array(np.repeat(np.array(classes, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int32), lengths)), pa.array((np.arange(int(ends[-1])) - np.repeat(ends - lengths, lengths)).astype(np.int32))], names=["column", "class", "n", "place"])

    return docs.mapInArrow(run, "column bigint, class bigint, n int, place int")


def _whole_block(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    return [c.to_numpy() for c in table.columns] if table else []


def _shared_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a block of columns, the entries of columns that more than one class has, by column and size, each once."""
    block = _whole_block(batches)
    if block:
        column, class_, n, place = block
        order = np.lexsort((class_, n, column))
        column, class_, n, place = (x[order] for x in (column, class_, n, place))
        new = np.ones(len(column), bool)
        new[1:] = (column[1:] != column[:-1]) | (class_[1:] != class_[:-1])
        column, class_, n, place = (x[new] for x in (column, class_, n, place))
        begins = np.ones(len(column), bool)
        begins[1:] = column[1:] != column[:-1]
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(column)))
        many = np.repeat(size > 1, size)
        yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (column, class_, n, place)], names=["column", "class", "n", "place"])


def possible(n: np.ndarray, place: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of sizes n and m that first share a column at these places can link."""
    low, high = np.minimum(n, m).astype(np.int64), np.maximum(n, m).astype(np.int64)
    most = np.minimum(n - place, m - other)
    return (100 * low >= PERCENT * high) & ((100 + PERCENT) * most.astype(np.int64) >= PERCENT * (low + high))


_PAIRS = "a bigint, b bigint, shared bigint"


def _pairs(block: list[np.ndarray], choose: Callable) -> pa.RecordBatch:
    """Pairs of classes of a block of columns, each once, with the columns of it at which they are possible."""
    column = block[0]
    begins = np.ones(len(column), bool)
    begins[1:] = column[1:] != column[:-1]
    first = np.flatnonzero(begins)
    class_ = block[1]
    pairs = [(f + p[0], f + p[1]) for f, e in zip(first, np.append(first[1:], len(column))) if e - f > 1 for p in choose(*(x[f:e] for x in block[1:]))]
    x = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    y = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    x, y = np.where(class_[x] < class_[y], x, y), np.where(class_[x] < class_[y], y, x)
    order = np.lexsort((class_[y], class_[x]))
    x, y = x[order], y[order]
    a, b = class_[x], class_[y]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(np.diff(np.append(at, len(a))))], names=["a", "b", "shared"])


def _summed(blocks: DataFrame) -> DataFrame:
    """The blocks' pairs as one matrix: each pair once."""
    return blocks.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def _pivot(class_, n, place):
    """A column's rows with the row that has the fewest columns before this one."""
    p = int(place.argmin())
    fits = possible(n, place, n[p], place[p])
    fits[p] = False
    others = np.flatnonzero(fits)
    yield others, np.full(len(others), p)


def _across(class_, n, place, label):
    """A column's rows of different components, row by row against the rows of no smaller size (they are sorted by it)."""
    if (label == label[0]).all():
        return
    reach = np.searchsorted(n, 100 * n // PERCENT, side="right")
    for i in range(len(class_) - 1):
        s = slice(i + 1, reach[i])
        others = i + 1 + np.flatnonzero((label[s] != label[i]) & possible(n[i], place[i], n[s], place[s]))
        if len(others):
            yield others, np.full(len(others), i)


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _whole_block(batches)
    if block:
        yield _pairs(block, _pivot)


def _other_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _whole_block(batches)
    if block:
        order = np.lexsort((block[2], block[0]))
        yield _pairs([x[order] for x in block], _across)


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """Which low bits of the classes occur in a pair: at most 2**BITMAP_BITS bits."""
    low = F.explode(F.array("a", "b")).alias("c")
    bits = pairs.select(low).select(F.col("c").bitwiseAND((1 << BITMAP_BITS) - 1).alias("c"))
    words = bits.groupBy(F.shiftright("c", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(c & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _full_rows(docs: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """class, set (sorted hashes as bytes) of the classes that occur in a pair, once a task."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want, seen, low = wanted.value, set(), (1 << BITMAP_BITS) - 1
        for _, sets in _sets(batches, 1, seed):
            rows = []
            for s in sets:
                c = _class_of(s)
                if len(s) and c not in seen and want[c & low]:
                    seen.add(c)
                    rows.append((c, s.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["class", "set"])

    rows = docs.mapInArrow(run, "class bigint, set binary")
    return rows.groupBy("class").agg(F.first("set").alias("set"))


def _linked(docs: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """The pairs (a, b) whose full rows share enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, keep = batch.column(2), batch.column(3), []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    rows = _full_rows(docs, pairs, seed)
    with_a = pairs.select("a", "b").join(rows.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a")
    with_b = with_a.join(rows.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b")
    return with_b.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, class of each document, with the text's digest as exact if wanted; a, b of the verified links between
    classes).

    The links connect whatever links; within a component they need not be all.
    """
    on_workers(docs.sparkSession)
    d, seed = id_text(docs, id_col, text_col), secrets.randbits(63)  # no text can be made up to collide
    incidence = written(_incidence(d.withColumn("exact", text_digest(d["text"])) if digests else d, seed), "incidence")
    members = incidence.filter("class IS NOT NULL").select("doc_id", "n", "class", *(["exact"] if digests else []))
    entries = _prefixes(d, _common_columns(incidence), seed).repartition("column").mapInArrow(_shared_columns, "column bigint, class bigint, n int, place int")
    entries = written(entries, "shared-columns")
    firsts = entries.repartition("column").sortWithinPartitions("column", "n", "class").mapInArrow(_first_pairs, _PAIRS)
    firsts = written(_summed(firsts), "first-pairs")
    links = written(_linked(d, firsts, seed), "first-links")
    labels = components(links)
    labelled = entries.join(labels.withColumnRenamed("node", "class"), "class", "left").select("column", "class", "n", "place", F.coalesce("label", "class").alias("label"))
    others = _summed(labelled.repartition("column").mapInArrow(_other_pairs, _PAIRS))
    others = written(others.join(firsts.select("a", "b"), ["a", "b"], "left_anti"), "other-pairs")
    return members, written(links.unionByName(_linked(d, others, seed)), "links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) of each document."""
    members, links = link(docs, id_col, text_col)
    classes = members.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("size"))
    labelled = written(classes.join(components(links).withColumnRenamed("node", "class"), "class", "left").select("class", "least", "size", F.coalesce("label", "class").alias("label")), "classes")
    lowest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(lowest, "label").select("class", "size", "component_id")
    linked = join_groups(members.filter("n > 0"), named, "class", "size").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(members.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which no other row of their component comes first: by doc_id (null
    last), then by the text's digest. Rows without words stay."""
    members, links = link(docs, id_col, text_col, digests=True)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "exact")
    classes = members.filter("n > 0").groupBy("class").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    labelled = written(classes.join(components(links).withColumnRenamed("node", "class"), "class", "left").select("class", "first", "size", F.coalesce("label", "class").alias("label")), "classes")
    firsts = labelled.groupBy("label").agg(F.min("first").alias("stays"))
    # a class of one row that is its component's first has nothing that goes
    going = labelled.join(firsts, "label").filter((F.col("size") > 1) | ~F.col("first").eqNullSafe(F.col("stays")))
    named = going.select("class", "size", F.col("stays.doc_id").alias("stay_id"), F.col("stays.exact").alias("stay_exact"))
    rows = join_groups(members.filter("n > 0"), named, "class", "size")
    stays = F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("exact") == F.col("stay_exact"))
    keys = rows.groupBy("doc_id", "exact").agg(F.max(stays).alias("kept"), F.count("*").alias("n"))
    keys = written(keys.filter("NOT kept OR n > 1"), "near-copies")
    return without_rows(docs, keys.filter("NOT kept"), keys.filter("kept"), id_col, text_col)
