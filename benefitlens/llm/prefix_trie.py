"""Prefix trie of conversations, its subtree totals by time-forward processing.

Each distinct sequence of first d turns is a node. Conversations are rebuilt first: some take over the first turns of
their base conversation, so that prefixes are shared (``rebuilt``).

* **Nodes.** A node's key is the exclusive-or of digests of its turns, each salted with its place and a secret of the
  run (120 bits). Keys of all prefixes are running values, made of one within a slice of the ordered turns and one over
  the slices before, so a conversation that holds a third of all turns is spread like any others; texts themselves are
  never moved, only their digests and word counts.
* **Time-forward processing.** Totals (leaves, saved tokens, children) flow from children to parents. Nodes of at most
  ``light`` members hang in shards below nodes of more; there are few of the latter (all turns / ``light``, 65,536 and
  the root at most). Within a shard's task, nodes come in reverse level order, sorted externally by Spark; each sends its
  totals to its parent through a priority queue ordered the same way, which spills sorted runs beyond ``HELD`` messages.
  A node takes its messages from the head of the queue when it's reached. Totals of the shards' roots are then added
  up by parent, and the nodes above the shards are processed the same way in one bounded task.
* **Members that end at a node** are joined as text in slices of the ordered ids; only blocks of text meet in the task
  that digests a node's list, which SHA-256 makes one stream.

Spilled runs are unnamed files in the executor's own Spark scratch folder, as Spark's sorts use it; they end with the
task, and a task that is run again elsewhere needs none of them. A whole shard is a task's work: a conversation of very
many turns that few others share is one shard, streamed within bounded memory.

Defined results: rows without conv_id belong to no conversation and are left out; a null role or text is empty; turns
are ordered by turn (null first), those with equal numbers by the digest of role and text; repeated rows are turns of
their own; an empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from benefitlens.llm.common import BLANKS, on_workers, written

#: Conversations of one base, and how many turns at most are taken over from it.
FAMILY, HEADS = 20, 4
#: Members of a node below which it may hang in a shard, and the nodes above shards that this allows.
LIGHT, MOST_ABOVE = 32, 1 << 16
#: Messages a queue holds in memory, and how many are read of a spilled run at once.
HELD, READ = 200_000, 2_000
#: Ids of one block of a node's list.
LIST_BLOCK = 4_096

KEY = ["depth", "k1", "k2"]


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, base, h, taken of all conversations; conv, slice, depth, digest, words of their rebuilt turns)."""
    text = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(""))
    turns = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv"), conversations["turn"].cast("bigint").alias("turn"),
        F.md5(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))).alias("digest"),
        F.regexp_count(text("text"), F.lit(f"[^{BLANKS}]+")).cast("bigint").alias("words"),
    ).filter("conv IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = written(turns.repartitionByRange("conv", *order).withColumn("slice", F.spark_partition_id()), "trie-turns")
    runs = ranged.groupBy("slice", "conv").agg(F.count(F.lit(1)).alias("n"))
    by_slice = W.partitionBy("conv").orderBy("slice")
    runs = runs.select("slice", "conv", "n", F.coalesce(F.sum("n").over(by_slice.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    runs = written(runs, "trie-runs")
    convs = runs.groupBy("conv").agg(F.sum("n").alias("length"))
    convs = convs.select("*", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h"))
    bases = convs.select(F.col("conv").alias("b"), F.col("length").alias("base_length"))
    convs = convs.join(bases, F.col("base") == F.col("b"), "left").select("conv", "base", "h", F.least("h", F.coalesce("base_length", F.lit(0))).alias("taken"))
    convs = written(convs, "trie-conversations")
    inside = W.partitionBy("slice", "conv").orderBy(*order)
    placed = ranged.join(runs.join(convs, "conv").select("slice", "conv", "before", "h", "taken"), ["slice", "conv"])
    placed = placed.select("slice", "conv", "h", "taken", "digest", "words", (F.col("before") + F.row_number().over(inside)).alias("place"))
    placed = written(placed, "trie-placed")
    own = placed.filter("place > h").select("conv", "slice", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "words")
    heads = placed.filter((F.col("conv") % FAMILY == 0) & (F.col("place") < HEADS)).select(F.col("conv").alias("base"), F.col("place").alias("depth"), "digest", "words")
    heads = convs.select("conv", "base", "taken").join(heads, "base").filter("depth <= taken").select("conv", F.lit(-1).alias("slice"), "depth", "digest", "words")
    return convs, heads.unionByName(own)


def paths(turns: DataFrame) -> DataFrame:
    """conv, depth, k1, k2, p1, p2, words: every conversation's way down, each node with its parent's key."""
    salted = F.md5(F.concat(F.lit(uuid.uuid4().hex), F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    number = lambda first: F.conv(F.substring(salted, first, 15), 16, 10).cast("bigint")
    turns = written(turns.select("conv", "slice", "depth", "words", number(1).alias("t1"), number(16).alias("t2")), "trie-salted")
    before = W.partitionBy("conv").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("slice", "conv").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = turns.groupBy("slice", "conv").agg(F.bit_xor("t1").alias("r1"), F.bit_xor("t2").alias("r2"))
    runs = runs.select("slice", "conv", *[F.coalesce(F.bit_xor(f"r{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    keys = turns.join(runs, ["slice", "conv"]).select("*", *[F.col(f"o{i}").bitwiseXOR(F.bit_xor(f"t{i}").over(inside)).alias(f"k{i}") for i in (1, 2)])
    return keys.select("conv", "depth", "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)], "words")


class SpillingQueue:
    """A priority queue of tuples; beyond ``HELD`` in memory they go to a sorted run on disk, of which the head stays."""

    def __init__(self, held: int = 0):
        self.held = held or HELD
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.loose = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, (*item, -1))
        self.loose += 1
        if self.loose > self.held:
            self._spill()

    def _spill(self) -> None:
        from pyspark import SparkFiles

        loose = sorted(x for x in self.heap if x[-1] < 0)
        file = tempfile.TemporaryFile(dir=SparkFiles.getRootDirectory())
        for i in range(0, len(loose), READ):
            pickle.dump(loose[i : i + READ], file)
        file.seek(0)
        self.heap = [x for x in self.heap if x[-1] >= 0]
        heapq.heapify(self.heap)
        self.runs.append(self._read(file))
        self.loose = 0
        self._next(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _next(self, run: int) -> None:
        if item := next(self.runs[run], None):
            heapq.heappush(self.heap, (*item[:-1], run))

    def pop(self) -> tuple:
        item = heapq.heappop(self.heap)
        if item[-1] >= 0:
            self._next(item[-1])
        else:
            self.loose -= 1
        return item[:-1]

    def first(self) -> tuple | None:
        return self.heap[0] if self.heap else None


_IN = "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, is_root boolean, conv_id bigint, parent_conv_id bigint, n_convs bigint, saved bigint, children_below bigint, leaves_below bigint, saved_below bigint"
_OUT = "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, is_root boolean, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
_OUT_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of nodes in reverse level order (depth descending, then key); a root's totals leave with its own row only."""
    queue = SpillingQueue()
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(13)]
        children, leaves, saved = [], [], []
        for depth, k1, k2, p1, p2, is_root, own, c, l, s in zip(*columns[:6], *columns[9:]):
            key = (-depth, k1, k2)
            while (head := queue.first()) and head[:3] == key:
                _, _, _, more_leaves, more_saved = queue.pop()
                c, l, s = c + 1, l + more_leaves, s + more_saved
            l, s = l if c else 1, s + own
            if not is_root:
                queue.push((1 - depth, p1, p2, l, s))
            children.append(c)
            leaves.append(l)
            saved.append(s)
        out = [batch.column(i) for i in range(9)] + [pa.array(x, pa.int64()) for x in (children, leaves, saved)]
        yield pa.RecordBatch.from_arrays(out, _OUT_NAMES)


def ends_digests(ends: DataFrame) -> DataFrame:
    """Of (depth, k1, k2, conv): each node's ids in ascending order, comma-joined, as a lowercase SHA-256."""
    shape = pa.schema([(c, pa.int64()) for c in (*KEY, "first")] + [("text", pa.string())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            rows = []
            for d, k1, k2, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (d, k1, k2) or len(ids) >= LIST_BLOCK:
                    if ids:
                        rows.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (d, k1, k2), []
                ids.append(conv)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*key, ids[0], ",".join(map(str, ids))), shape)], schema=shape)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        names = [*KEY, "ends_sha256"]
        for batch in batches:
            rows = []
            for d, k1, k2, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                if key == (d, k1, k2):
                    sha.update(b"," + text.encode())
                    continue
                if key:
                    rows.append((*key, sha.hexdigest()))
                key, sha = (d, k1, k2), hashlib.sha256(text.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], names)

    key_type = "depth bigint, k1 bigint, k2 bigint"
    texts = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(blocks, f"{key_type}, first bigint, text string")
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{key_type}, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    on_workers(conversations.sparkSession)
    convs, turns = rebuilt(conversations)
    way = written(paths(turns), "trie-paths")
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in KEY], F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"), "conv_id", "n_convs", zero.alias("words"))
    nodes = way.groupBy(*KEY).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    nodes = written(nodes.unionByName(root), "trie-nodes")

    light = max(LIGHT, -(-way.count() // MOST_ABOVE))
    above = written(nodes.filter(F.col("n_convs") > light), "trie-above")  # MOST_ABOVE and the root at most
    hot = F.broadcast(above.select(F.col("depth").alias("hd"), F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("conv_id").alias("hot_conv_id")))
    child_of = (F.col("depth") - 1 == F.col("hd")) & (F.col("p1") == F.col("h1")) & (F.col("p2") == F.col("h2"))
    named = written(nodes.join(hot, child_of, "left").drop("h1", "h2"), "trie-named")
    below = nodes.filter(F.col("n_convs") <= light).select(F.col("depth").alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    rest = named.filter("hd IS NULL AND depth > 0").withColumn("d", F.col("depth") - 1).join(below, ["d", "p1", "p2"]).drop("d")
    named = rest.unionByName(named.filter("hd IS NOT NULL OR depth = 0").withColumn("parent_conv_id", F.col("hot_conv_id")))
    named = named.select(*KEY, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    named = written(named, "trie-named")

    # the shallowest light node on a conversation's way is the root of its shard
    same = [F.col(a) == F.col(b) for a, b in zip(KEY, ("hd", "h1", "h2"))]
    everywhere = way.select("conv", *KEY).unionByName(convs.select("conv", *[zero.alias(c) for c in KEY]))
    shards = everywhere.join(hot, same, "left_anti").groupBy("conv").agg(F.min(F.struct(*KEY)).alias("shard"))
    shards = written(shards, "trie-shards")
    sharded = named.filter(F.col("n_convs") <= light).join(shards.withColumnRenamed("conv", "conv_id"), "conv_id")
    sharded = sharded.withColumn("is_root", F.struct(*KEY) == F.col("shard")).withColumns({f"{c}_below": zero for c in ("children", "leaves", "saved")})
    columns = [x.split()[0] for x in _IN.split(", ")]
    reverse = [F.col("depth").desc(), "k1", "k2"]
    done = written(sharded.repartition("shard").sortWithinPartitions(*reverse).select(*columns).mapInArrow(time_forward, _OUT), "trie-shard-totals")

    sent = done.filter("is_root AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    sent = sent.agg(F.count(F.lit(1)).alias("children_below"), F.sum("n_leaves").alias("leaves_below"), F.sum("saved_tokens").alias("saved_below"))
    top = named.filter(F.col("n_convs") > light).join(sent, KEY, "left").na.fill(0, ["children_below", "leaves_below", "saved_below"]).withColumn("is_root", F.col("depth") == 0)
    top = top.select(*columns).repartition(1).sortWithinPartitions(*reverse).mapInArrow(time_forward, _OUT)

    last = way.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("last"))
    ends = convs.select("conv").join(last, "conv", "left").select("conv", *[F.coalesce(F.col(f"last.{c}"), F.lit(0)).alias(c) for c in KEY])
    out = done.unionByName(top).join(ends_digests(ends), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


#: The same by joins of paths: a node's subtree are the nodes whose smallest member passes it.
ORACLE = r"""
WITH step AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS table_),
raw AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, md5(length(r) || ':' || r || x) AS g, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w,
        row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS place FROM raw),
sized AS (SELECT c, max(place) AS len_, c - c % 20 AS base,
        xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
            lambda a, b: xor(a >> 8, table_[((xor(a, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 4 AS h
        FROM t, step GROUP BY c, table_),
convs AS (SELECT a.c, a.base, a.h::BIGINT AS h, least(a.h::BIGINT, coalesce(b.len_, 0)) AS taken FROM sized a LEFT JOIN sized b ON a.base = b.c),
turns AS (SELECT v.c, t.place AS d, t.g, t.w FROM convs v JOIN t ON t.c = v.base AND t.place <= v.taken
    UNION ALL SELECT v.c, v.taken + t.place - v.h, t.g, t.w FROM convs v JOIN t ON t.c = v.c AND t.place > v.h),
path AS (SELECT c, d, md5(string_agg(g, '') OVER (PARTITION BY c ORDER BY d)) AS k, w FROM turns UNION ALL SELECT c, 0, '', 0 FROM convs),
node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n, max(w) AS w FROM path GROUP BY d, k),
up AS (SELECT p.c, p.d, p.k, n.conv_id AS node_conv FROM path p JOIN node n USING (d, k)),
last_ AS (SELECT c, max(d) AS d FROM path GROUP BY c),
ends AS (SELECT p.d, p.k, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids FROM path p JOIN last_ l ON p.c = l.c AND p.d = l.d GROUP BY p.d, p.k),
child AS (SELECT n.d, n.k, n.conv_id, n.n, n.w, u.k AS pk, u.node_conv AS parent FROM node n LEFT JOIN up u ON u.c = n.conv_id AND u.d = n.d - 1),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM child WHERE d > 0 GROUP BY 1, 2),
below AS (SELECT u.d, u.k, sum((c.n - 1) * c.w) AS saved, count(*) FILTER (WHERE y.n_children IS NULL) AS leaves
    FROM child c JOIN up u ON u.c = c.conv_id AND u.d <= c.d LEFT JOIN kids y ON y.d = c.d AND y.k = c.k GROUP BY u.d, u.k)
SELECT c.conv_id, c.d::BIGINT AS depth, c.parent AS parent_conv_id, c.n::BIGINT AS n_convs, coalesce(y.n_children, 0)::BIGINT AS n_children,
    b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM child c JOIN below b ON b.d = c.d AND b.k = c.k LEFT JOIN kids y ON y.d = c.d AND y.k = c.k LEFT JOIN ends e ON e.d = c.d AND e.k = c.k
"""
