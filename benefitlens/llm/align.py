"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, counted over the corpus.

Tokeniser A is a byte-level BPE file of the tokenizers library, B a sentencepiece
model. Byte offsets at which tokens of both end cut a text into groups; an A token
and a B token are linked where their byte ranges overlap. An id pair's count is the
number of documents that hold it linked.

* **Units.** A unit begins at a space that follows something other than white
  space. No word of A's split pattern crosses that border and no piece of B does
  (checked on the vocabulary; otherwise the whole text is one unit), so both
  libraries see each distinct unit once while it stays in a worker's bounded table,
  and a document is the sequence of its units. Whole texts are worked on.
* **External spill counting.** A worker holds the distinct (pair, document) records
  of a run of documents up to ``RUN_LINKS`` links, sorts them and spills them as one
  zstd run for each radix partition of the A id. Counts of the run's pairs spill
  beside them, already added up within the run, so an A id that every document
  holds costs one number a run.
* **Heap merge.** A task merges the count runs of its radix partitions k ways by a
  heap over the runs' next blocks, in (A, B) order. Since all B ids of an A id
  follow one another, its maximum is known when the A id ends, and the counted pairs
  leave with a mark for those that reach it.
* **Contributions back.** Record runs meet the counts of their partition in cells of
  a bounded number of runs (so a frequent A id is dealt over many cells), and each
  run's sums per document go back to that run's documents.

All runs travel as rows of Spark tables in the shared folder; nothing is kept in a
worker's local files, so a lost executor costs its tasks only.

Defined results: a null or empty text, or one whose tokens' bytes differ from
space+text (B writes U+2581 as space), has no tokens: zeros and ''. Every row gives
one row, repeated and null doc_ids too, and counts as a document of its own. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.llm.common import id_text, on_workers, written
from benefitlens.llm.tokenizer_ids import byte_letters, vocabulary_path
from benefitlens.llm.words import _WHITE, groups, spread

#: Bits of a B id in a pair; radix partitions of the A id.
B_BITS = 20
RADIX = 64
#: A run of documents ends at this many links or documents.
RUN_LINKS, RUN_DOCS, GROUP_DOCS = 1_500_000, 1 << 16, 1 << 13
#: Pairs in one block of a merged stream, and bytes of record runs in one cell.
BLOCK, CELL_BYTES = 1 << 16, 8 << 20
#: A worker's unit table starts anew beyond so many units or links; longer units aren't kept in it.
MOST_UNITS, MOST_LINKS, LONG_UNIT = 250_000, 3_000_000, 200

_MADE = pa.schema([("kind", pa.string()), ("task", pa.int64()), ("run", pa.int32()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("radix", pa.int32()), ("data", pa.binary())])
_MADE_SPARK = "kind string, task bigint, run int, at int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, radix int, data binary"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one zstd block: delta of the first, bytes of equal weight side by side."""
    import zstandard

    parts = [np.array([len(columns[0])], "<i8").tobytes()]
    for i, c in enumerate(columns):
        c = np.diff(c, prepend=c.dtype.type(0)) if i == 0 else c
        parts += [c.dtype.str[1:].encode(), np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.dtype.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    while at < len(raw):
        kind = np.dtype(raw[at : at + 2].decode())
        size = n * kind.itemsize
        c = np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at + 2).reshape(kind.itemsize, n).T).reshape(-1).view(kind)
        out.append(c if out else np.cumsum(c, dtype=kind))
        at += 2 + size
    return out


class Aligner:
    """Both tokenisers and the table from unit to its groups and links."""

    def __init__(self, a_name: str, b_name: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(vocabulary_path(a_name))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b_name))
        letter_byte = {x: b for b, x in byte_letters().items()}
        entries = self.a.get_vocab(False)
        self.a_bytes = [b""] * (1 + max(entries.values()))
        for p, i in entries.items():
            self.a_bytes[i] = bytes(letter_byte.get(c, 0) for c in p)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if max(len(pieces), len(self.a_bytes)) > 1 << B_BITS:
            raise ValueError(f"vocabularies of more than {1 << B_BITS} pieces need a larger B_BITS")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = [np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes)]
        self.space = self.b.piece_to_id("▁")
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.named = {mark: [f"{i}{mark}" for i in range(most)] for mark in ",|;"}
        self.digits = np.fromiter((len(x) for x in self.named[","]), np.int64, most)
        white = "".join(map(chr, _WHITE))
        local = not any(re.search("[^▁]▁", p) for p in pieces)
        self.split = re.compile(f"(?<=[^{white}])(?=\x20)").split if local else lambda text: [text]
        self.ends_white = re.compile(f"[{white}]\\Z").search
        self.rows: dict[str, int] = {}
        self.text: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links; n_a -1: bytes differ
        self.first, self.pairs, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Drops the units met once only, or all where that leaves too many."""
        keep = np.flatnonzero(self.met > 1)
        few = 2 * len(keep) <= MOST_UNITS and 2 * self.counts[keep, 3].sum() <= MOST_LINKS
        self._keep(keep if few else keep[:0])
        self.met[:] = 0

    def _keep(self, rows: np.ndarray) -> None:
        units = list(self.rows)  # in the order of their rows
        self.rows = {units[k]: i for i, k in enumerate(rows.tolist())}
        self.text = [self.text[k] for k in rows.tolist()]
        self.pairs = self.pairs[spread(self.first[rows], self.counts[rows, 3])]
        self.counts, self.met = self.counts[rows], self.met[rows]
        self.first = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]

    def _work_out(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(groups as text, counts, pairs one unit after another) of units, tokenised as one text.

        Where the bytes differ, halves of the units are tried, down to the single units that fail.
        """
        joined = "".join(units)
        raw = joined.encode()
        ids_a = np.array(self.a.encode(joined, add_special_tokens=False).ids, np.int64)
        ids_b = np.array(self.b.encode(joined[1:], num_threads=1) if len(joined) > 1 else [self.space], np.int64)
        if b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != raw:
            if len(units) == 1:
                return [""], np.array([[-1, 0, 0, 0]]), np.zeros(0, np.int64)
            half = len(units) // 2
            (t, c, p), (u, d, q) = self._work_out(units[:half]), self._work_out(units[half:])
            return t + u, np.concatenate([c, d]), np.concatenate([p, q])
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        unit_ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        # between two neighbouring ends of either side lies the overlap of one A and one B token
        both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        twice = both[1:] == both[:-1]
        ends, cuts = both[np.append(~twice, True)], both[1:][twice]
        pairs = ids_a[np.searchsorted(ends_a, ends)] << B_BITS | ids_b[np.searchsorted(ends_b, ends)]
        counts = np.stack([np.diff(np.searchsorted(x, unit_ends, "right"), prepend=0) for x in (ends_a, ends_b, cuts, ends)], 1)
        # groups as text: A ids, bar, B ids, semicolon; the last of a group's side carries the mark
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        ids, last = np.concatenate([ids_a, ids_b])[order], np.concatenate([cuts[of_a] == ends_a, cuts[of_b] == ends_b])[order]
        mark = np.where(last, np.where(order < len(ids_a), 1, 2), 0)
        names = self.named[","], self.named["|"], self.named[";"]
        text = "".join([names[m][i] for m, i in zip(mark.tolist(), ids.tolist())])
        at = np.cumsum(self.digits[ids])[np.cumsum(counts[:, 0] + counts[:, 1]) - 1].tolist()
        return [text[i:j] for i, j in zip([0, *at], at)], counts, pairs

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links of each text; digests of the groups; text number and pair of every link)."""
        units = [self.split(" " + t) if t else [] for t in texts]
        if len(self.rows) > MOST_UNITS or len(self.pairs) > MOST_LINKS:
            self._shrink()
        known = self.rows
        new = [u for u in dict.fromkeys(itertools.chain.from_iterable(units)) if u not in known]
        if new:
            # a unit that ends in white space, as a text's last may, would run into the next
            alone = [u for u in new if self.ends_white(u)]
            some = set(alone)
            parts = [self._work_out(x) for x in ([u for u in new if u not in some], *[[u] for u in alone]) if x]
            order = [u for u in new if u not in some] + alone
            known.update(zip(order, range(len(self.text), len(self.text) + len(order))))
            counts = np.concatenate([c for _, c, _ in parts])
            self.text += itertools.chain.from_iterable(t for t, _, _ in parts)
            self.first = np.concatenate([self.first, len(self.pairs) + np.cumsum(counts[:, 3]) - counts[:, 3]])
            self.pairs, self.counts = np.concatenate([self.pairs, *[p for _, _, p in parts]]), np.concatenate([self.counts, counts])
            self.met = np.concatenate([self.met, np.zeros(len(order), np.int64)])
        size = np.fromiter(map(len, units), np.int64, len(units))
        rows = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(units)), np.int64, int(size.sum()))
        np.add.at(self.met, rows, 1)
        counts = self.counts[rows]
        of = np.repeat(np.arange(len(texts)), size)
        fails = np.zeros(len(texts), bool)
        fails[of[counts[:, 0] < 0]] = True
        counts[fails[of]] = 0
        numbers = np.stack([np.bincount(of, counts[:, i], len(texts)).astype(np.int64) for i in range(4)], 1)
        ends = np.cumsum(size)
        digests = [hashlib.sha256("".join(map(self.text.__getitem__, rows[e - n : e].tolist())).encode()[:-1]).hexdigest() if n and not f else "" for e, n, f in zip(ends.tolist(), size.tolist(), fails.tolist())]
        found = self.pairs[spread(self.first[rows], counts[:, 3])], np.repeat(of, counts[:, 3])
        long = [known[u] for u in new if len(u) > LONG_UNIT]
        if long:  # not kept; a few of them could fill the table
            self._keep(np.delete(np.arange(len(self.text)), long))
        return numbers, digests, found[1], found[0]


@functools.lru_cache(maxsize=1)
def aligner(a_name: str, b_name: str) -> Aligner:
    return Aligner(a_name, b_name)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def radix_of(pairs: np.ndarray) -> np.ndarray:
    """Radix partition of a pair's A id; neighbouring ids are dealt apart."""
    return (pairs >> B_BITS) % RADIX


class Spill:
    """One task's records: a run of documents at a time, sorted and spilled by radix partition."""

    def __init__(self, task: int):
        self.task, self.run = task, 0
        self._empty()

    def _empty(self) -> None:
        self.docs: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.links = 0

    def add(self, doc_ids: list, numbers: np.ndarray, digests: list[str], of: np.ndarray, pairs: np.ndarray) -> None:
        at = len(self.docs)
        self.docs += [("docs", self.task, self.run, at + i, d, *n, g, None, None) for i, (d, n, g) in enumerate(zip(doc_ids, numbers.tolist(), digests))]
        unique, times = np.unique((of + at) << 2 * B_BITS | pairs, return_counts=True)
        self.keys.append((unique & (1 << 2 * B_BITS) - 1) << 16 | unique >> 2 * B_BITS)
        self.counts.append(times)
        self.links += len(unique)

    def full(self) -> bool:
        return self.links >= RUN_LINKS or len(self.docs) > RUN_DOCS - GROUP_DOCS

    def spilled(self) -> list[tuple]:
        """The run's rows: its documents, and for each radix partition its records and its count run."""
        rows = self.docs
        if self.keys:
            keys, times = np.concatenate(self.keys), np.concatenate(self.counts)
            self.keys, self.counts = [], []
            radix = radix_of(keys >> 16)
            for r in range(RADIX):
                mine = np.flatnonzero(radix == r)
                if not len(mine):
                    continue
                order = mine[np.argsort(keys[mine])]
                key = keys[order]
                pair, doc = key >> 16, (key & 0xFFFF).astype(np.uint16)
                unique, n = np.unique(pair, return_counts=True)
                blank = self.task, self.run, None, None, None, None, None, None, None, r
                rows.append(("records", *blank, packed(pair, doc, times[order].astype(np.uint32))))
                rows.append(("counts", *blank, packed(unique, n.astype(np.int64))))
        self.run += 1
        self._empty()
        return rows


def heap_merge(runs: Iterable[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge of runs of sorted (pair, n) blocks: (pairs ascending, added n), no pair twice.

    The heap holds each run's current block by its last pair. What lies up to the smallest last pair is complete in
    the blocks at hand, so it leaves, and the runs whose block is used up bring their next.
    """
    heap: list[tuple[int, int, np.ndarray, np.ndarray, Iterator]] = []
    for i, run in enumerate(runs):
        for pairs, n in run:
            if len(pairs):
                heap.append((int(pairs[-1]), i, pairs, n, run))
                break
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        take, rest = [], []
        for last, i, pairs, n, run in heap:
            k = int(np.searchsorted(pairs, bound, "right"))
            take.append((pairs[:k], n[:k]))
            pairs, n = pairs[k:], n[k:]
            while not len(pairs):
                following = next(run, None)
                if following is None:
                    break
                pairs, n = following
            if len(pairs):
                rest.append((int(pairs[-1]), i, pairs, n, run))
        # a run that went on to its next block may hold pairs up to the bound only if its blocks overlap: runs are sorted, so not
        heap = rest
        heapq.heapify(heap)
        pairs, n = np.concatenate([p for p, _ in take]), np.concatenate([x for _, x in take])
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        yield pairs[first], np.add.reduceat(n, first)


def with_maxima(merged: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, counts, whether the count is its A id's highest), as soon as an A id's pairs are complete."""

    def marked(pairs, n):
        side = pairs >> B_BITS
        first = np.flatnonzero(np.diff(side, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(side))))
        return pairs, n, (n == highest).astype(np.uint8)

    held: list[tuple[np.ndarray, np.ndarray]] = []  # pairs of A ids that may go on
    size = 0
    for pairs, n in merged:
        held.append((pairs, n))
        size += len(pairs)
        if size < BLOCK:
            continue
        pairs, n = np.concatenate([p for p, _ in held]), np.concatenate([x for _, x in held])
        k = int(np.searchsorted(pairs, pairs[-1] >> B_BITS << B_BITS))
        if k:
            yield marked(pairs[:k], n[:k])
        held, size = [(pairs[k:], n[k:])], len(pairs) - k
    if size:
        yield marked(np.concatenate([p for p, _ in held]), np.concatenate([x for _, x in held]))


def _blocks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A count run, decoded when the merge comes to it, block by block."""
    pairs, n = unpacked(data)
    for i in range(0, len(pairs), 4096):
        yield pairs[i : i + 4096], n[i : i + 4096]


def _by_key(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches grouped by the named columns, read as they come."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, group in itertools.groupby(rows, lambda r: tuple(r[n] for n in names)):
        yield key, group


#: Count runs merged at once; where a radix partition has more, they are merged in passes.
FAN_IN = 256


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    on_workers(docs.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both, spill = aligner(a, b), Spill(TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_DOCS):
                part = batch.slice(at, GROUP_DOCS)
                ids = part.column(0).to_pylist()
                for first, texts in groups(part.column(1).to_pylist()):
                    spill.add(ids[first : first + len(texts)], *both.documents(texts))
                    if spill.full():
                        yield _batch(spill.spilled(), _MADE)
        yield _batch(spill.spilled(), _MADE)

    made = written(id_text(docs, id_col, text_col).mapInArrow(runs, _MADE_SPARK), "align-runs", "kind")
    counted = written(pair_counts(made), "align-counts")
    return _back(made, counted)


def pair_counts(made: DataFrame) -> DataFrame:
    """Blocks (radix, block, data) of all pairs with their document counts, side-major.

    A merge opens FAN_IN runs or so. More runs are first merged in groups, each a task's work, pass after pass.
    """

    def merge(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("radix", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
        for (radix, part), group in _by_key(batches, "radix", "part"):
            stream = heap_merge(_blocks(r["data"]) for r in group)
            if last:
                for i, columns in enumerate(with_maxima(stream)):
                    yield _batch([(radix, i, packed(*columns))], schema)
            elif blocks := list(stream):
                yield _batch([(radix, part, packed(*map(np.concatenate, zip(*blocks))))], schema)

    shape = "radix int, block bigint, data binary"
    runs = made.filter("kind = 'counts'").select("radix", F.xxhash64("task", "run").alias("block"), "data")
    most = runs.groupBy("radix").count().agg(F.max("count").alias("n")).first()["n"] or 0
    while most > FAN_IN:
        most = -(-most // FAN_IN)
        parts = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(most)).alias("part"), "data").repartition(RADIX * most, "radix", "part").sortWithinPartitions("radix", "part")
        runs = written(parts.mapInArrow(lambda x: merge(x, False), shape), "align-merged")
    parts = runs.select("radix", F.lit(0).cast("bigint").alias("part"), "data").repartition(RADIX, "radix").sortWithinPartitions("radix")
    return parts.mapInArrow(lambda x: merge(x, True), shape)


def counted_pairs(counted: DataFrame) -> DataFrame:
    """The blocks as rows: a_id, b_id, n_docs, best."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                pair, n, best = unpacked(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(pair >> B_BITS), pa.array(pair & ((1 << B_BITS) - 1)), pa.array(n), pa.array(best.astype(bool))], ["a_id", "b_id", "n_docs", "best"])

    return counted.select("data").mapInArrow(rows, "a_id bigint, b_id bigint, n_docs bigint, best boolean")


def _back(made: DataFrame, counted: DataFrame) -> DataFrame:
    """Each document's sums over its links, from the counts of its pairs."""
    records = made.filter("kind = 'records'")
    size = records.agg(F.sum(F.octet_length("data")).alias("s")).first()["s"] or 0
    cells = 1 + int(size) // (RADIX * CELL_BYTES)
    cell = F.pmod(F.xxhash64("task", "run"), F.lit(cells)).cast("int")
    sent = records.select("radix", cell.alias("cell"), F.lit(1).alias("order"), "task", "run", "data")
    # a partition's pairs are bounded by the vocabularies; one copy of them for each cell of runs
    table = counted.select("radix", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(0).alias("order"), F.col("block").alias("task"), F.lit(0).alias("run"), "data")

    def contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("task", pa.int64()), ("run", pa.int32()), ("data", pa.binary())])
        for _, group in _by_key(batches, "radix", "cell"):
            blocks: list[list[np.ndarray]] = []
            columns: list[np.ndarray] = []
            for r in group:
                if r["order"] == 0:
                    blocks.append(unpacked(r["data"]))
                    continue
                if blocks:
                    columns, blocks = [np.concatenate(c) for c in zip(*blocks)], []
                pair, doc, times = unpacked(r["data"])
                at = np.searchsorted(columns[0], pair)
                most = int(doc.max()) + 1
                total, best = np.zeros(most, np.int64), np.zeros(most, np.int64)
                np.add.at(total, doc, times * columns[1][at])
                np.add.at(best, doc, times * columns[2][at].astype(np.int64))
                some = np.flatnonzero(total)
                yield _batch([(r["task"], r["run"], packed(some, total[some], best[some]))], schema)

    sums = sent.unionByName(table).repartition(RADIX * cells, "radix", "cell").sortWithinPartitions("radix", "cell", "order", "task", "run").mapInArrow(contribute, "task bigint, run int, data binary")
    names = ["at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = made.filter("kind = 'docs'").select("task", "run", F.lit(1).alias("order"), *names, F.lit(None).cast("binary").alias("data"))
    types = {f.name: f.dataType for f in made.schema}
    parts = sums.select("task", "run", F.lit(0).alias("order"), *[F.lit(None).cast(types[n]).alias(n) for n in names], "data")
    out = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = best = np.zeros(0, np.int64)
        key = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if key != (r["task"], r["run"]):
                    key, total, best = (r["task"], r["run"]), np.zeros(RUN_DOCS, np.int64), np.zeros(RUN_DOCS, np.int64)
                if r["order"] == 0:
                    some, t, b = unpacked(r["data"])
                    total[some] += t
                    best[some] += b
                else:
                    k = r["at"]
                    rows.append((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], int(best[k]), int(total[k]), r["groups_sha256"]))
            yield _batch(rows, out)

    return rows.unionByName(parts).repartition("task", "run").sortWithinPartitions("task", "run", "order", "at").mapInArrow(finish, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
