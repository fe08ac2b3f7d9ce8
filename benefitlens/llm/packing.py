"""Best-fit packing of documents into sequences: configuration linear program over the length histogram.

Every document is its ids and the end id. Documents longer than a sequence are cut
into full pieces with one shorter first piece. Only the histogram of piece lengths
(at most ``capacity`` numbers, whatever the corpus) reaches the driver, where the
covering program "each length as often as it occurs, from patterns that fit a
sequence, with the fewest patterns" is solved:

* multiplicative weights: a price for each length, raised while the length is
  under-covered and lowered while it's over-covered;
* pricing by an unbounded-knapsack dynamic program over the capacity, which gives,
  for every length at once, the most valuable pattern that holds it;
* rounding: patterns are used a whole number of times, never beyond what is left.
  What the fractions leave is priced anew round by round, with patterns of pieces
  that are left, until no pattern fills a sequence as far as the lengths left can;
* the tail, the last pieces that no such pattern takes, is packed best-fit.

The resulting plan is a list of (pattern, times). A piece finds its place by
arithmetic on its rank among the pieces of its length; the rank is made of a count
within its task and the tasks' totals, so a length that a third of all pieces
share is no single task's work.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from benefitlens.llm.common import id_text, on_workers, written

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights, and how far a round moves a price.
ROUNDS, RATE = 48, 0.6
#: A round on what the fractions leave uses a pattern this part of the times that the pieces left allow, at least once.
PART = 8
#: Rows of a batch whose texts a task holds as Python strings at a time.
ROWS_AT_A_TIME = 250

Plan = list[tuple[int, tuple[tuple[int, int], ...]]]


def fill_table(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best total price within each capacity, and the length taken last (0: none)."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        with_last = best[c - 1 :: -1][: c] + price[1 : c + 1]  # length l leaves c - l
        k = int(with_last.argmax())
        if with_last[k] > best[c - 1] + 1e-15:
            best[c], took[c] = with_last[k], k + 1
        else:
            best[c], took[c] = best[c - 1], 0
    return best, took


def _pattern(length: int, took: np.ndarray, capacity: int) -> tuple[tuple[int, int], ...]:
    """The best pattern that holds ``length``."""
    items: dict[int, int] = defaultdict(int)
    items[length] += 1
    c = capacity - length
    while c > 0:
        if took[c]:
            items[int(took[c])] += 1
            c -= int(took[c])
        else:
            c -= 1
    return tuple(sorted(items.items(), reverse=True))


def fractional(need: np.ndarray, capacity: int) -> tuple[dict[tuple[tuple[int, int], ...], float], np.ndarray]:
    """Patterns and how often to use them, by multiplicative weights over the lengths that occur, and the last prices."""
    lengths = np.flatnonzero(need)
    price = np.zeros(capacity + 1)
    price[lengths] = lengths / capacity
    used: dict[tuple[tuple[int, int], ...], float] = defaultdict(float)
    for _ in range(ROUNDS):
        best, took = fill_table(price, capacity)
        worth = price[lengths] + best[capacity - lengths]
        near = worth >= (1 - 1e-3) * worth.max()
        covered = np.zeros(capacity + 1)
        for length in lengths[near]:
            pattern = _pattern(int(length), took, capacity)
            times = need[length] / ROUNDS / dict(pattern)[int(length)]
            used[pattern] += times
            for l, a in pattern:
                covered[l] += times * a
        rate = covered[lengths] * ROUNDS / need[lengths]  # 1: just what is needed
        price[lengths] *= np.exp(RATE * np.clip(1 - rate, -2, 1))
        best, _ = fill_table(price, capacity)
        price /= best[capacity]
    return used, price


def rounded(need: np.ndarray, used: dict, plan: Plan, capacity: int) -> np.ndarray:
    """Use full patterns the whole part of their times, the most used first; returns what is left."""
    left, full = need.copy(), reach(need, capacity)
    for pattern, times in sorted(used.items(), key=lambda x: (-x[1], x[0])):
        n = min(int(times), *(int(left[l]) // a for l, a in pattern))
        if n > 0 and sum(l * a for l, a in pattern) >= full:
            _use(pattern, n, left, plan)
    return left


def reach(need: np.ndarray, capacity: int) -> int:
    """How far the lengths that occur can fill a sequence."""
    return int(round(fill_table(np.where(need > 0, np.arange(capacity + 1.0), 0.0), capacity)[0][capacity]))


def _use(pattern: tuple[tuple[int, int], ...], times: int, left: np.ndarray, plan: Plan) -> None:
    plan.append((times, pattern))
    for l, a in pattern:
        left[l] -= times * a


def _pattern_of(length: int, price: np.ndarray, best: np.ndarray, left: np.ndarray, capacity: int) -> tuple[tuple[int, int], ...]:
    """The most valuable pattern that holds ``length``, by the prices, of pieces that are left."""
    items, c = {length: 1}, capacity - length
    left = left.copy()
    left[length] -= 1
    while c > 0:
        worth = np.where(left[1 : c + 1] > 0, price[1 : c + 1] + best[c - 1 :: -1], -1.0)
        l = c - int(worth[::-1].argmax())  # the longest of equals
        if worth[l - 1] < 0:
            break
        items[l] = items.get(l, 0) + 1
        left[l] -= 1
        c -= l
    return tuple(sorted(items.items(), reverse=True))


def residual(need: np.ndarray, price: np.ndarray, plan: Plan, capacity: int) -> np.ndarray:
    """Use full patterns of what is left, priced anew each round, until none fits; returns what is left."""
    left, price = need.copy(), price.copy()
    full, plain = reach(need, capacity), False
    while left.any():
        lengths = np.flatnonzero(left)
        now = np.zeros(capacity + 1)
        now[lengths] = price[lengths]
        best, _ = fill_table(now, capacity)
        before = left.copy()
        for length in lengths[::-1].tolist():
            if left[length]:
                pattern = _pattern_of(length, now, best, left, capacity)
                if sum(l * a for l, a in pattern) >= full:
                    most = min(int(left[l]) // a for l, a in pattern)
                    _use(pattern, max(1, most // PART), left, plan)
        gone = before - left
        if gone.any():
            # dearer where fewer than the average share went
            price[lengths] *= np.exp(RATE * np.clip(gone.sum() / before.sum() - gone[lengths] / before[lengths], -0.5, 0.5))
            price[lengths] = np.maximum(price[lengths] / best[capacity], 1e-9)
        elif not plain:  # by length alone, the most valuable pattern is the fullest
            price, plain = np.arange(capacity + 1) / capacity, True
        elif (lower := reach(left, capacity)) < full:
            full = lower
        else:
            break
    return left


def best_fit(need: np.ndarray, plan: Plan, capacity: int) -> None:
    """Best-fit decreasing on the histogram: equal sequences are opened and filled together."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [how many, items]
    for length in np.flatnonzero(need)[::-1]:
        length, n = int(length), int(need[length])
        while n:
            room = next((r for r in sorted(open_) if r >= length and open_[r]), None)
            if room is None:
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    open_[capacity - each * length].append([full, {length: each}])
                if rest:
                    open_[capacity - rest * length].append([1, {length: rest}])
                break
            many, items = open_[room].pop()
            each = min(room // length, n)
            take = min(many, n // each)
            if take < many:
                open_[room].append([many - take, items])
            open_[room - each * length].append([take, items | {length: items.get(length, 0) + each}])
            n -= take * each
            if not open_[room]:
                del open_[room]
    for states in open_.values():
        plan.extend((many, tuple(sorted(items.items(), reverse=True))) for many, items in states)


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """(times, pattern) rows that hold every piece of the histogram exactly once."""
    need = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        need[length] = n
    plan: Plan = []
    if need[capacity]:
        plan.append((int(need[capacity]), ((capacity, 1),)))
        need[capacity] = 0
    if need.any():
        used, price = fractional(need, capacity)
        need = residual(rounded(need, used, plan, capacity), price, plan, capacity)
    best_fit(need, plan, capacity)
    return plan


def slots(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, in order of the ranks they serve: first rank, pieces a sequence, first sequence, offset."""
    of: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for times, pattern in plan:
        offset = 0
        for length, each in pattern:
            of[length].append((ranks[length], each, sequence, offset))
            ranks[length] += times * each
            offset += each * length
        sequence += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in of.items()}


def cut_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece, with its rank among the pieces of its length in its task."""
    on_workers(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from benefitlens.llm.tokenizer_ids import ids_of

        task, met = TaskContext.get().partitionId(), defaultdict(int)
        for batch in (b.slice(i, ROWS_AT_A_TIME) for b in batches for i in range(0, b.num_rows, ROWS_AT_A_TIME)):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, values, sizes in ids_of(vocabulary, texts):
                values = np.insert(values, np.cumsum(sizes), end_id).astype("<u4")
                rows, at = [], 0
                for name, n in zip(ids[first : first + len(sizes)], (sizes + 1).tolist()):
                    start, piece, length = 0, 0, n % capacity or capacity
                    while start < n:
                        rows.append((name, piece, start, length, zlib.crc32(values[at + start : at + start + length]), task, met[length]))
                        met[length] += 1
                        start, piece, length = start + length, piece + 1, capacity
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return id_text(docs, id_col, text_col).mapInArrow(pieces, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint")


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Defined results: a null text is empty (a piece of one id); a null doc_id is kept as it is; each of several equal
    rows is packed; an empty table gives no rows; other columns are ignored.
    """
    pieces = written(cut_pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = counts.select("length", "task", (F.sum("n").over(W.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = slots(plan_sequences(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, firsts = np.unique(length[order], return_index=True)
            for value, mine in zip(values, np.split(order, firsts[1:])):
                first, each, base, at = where[int(value)]
                k = np.searchsorted(first, rank[mine], side="right") - 1
                nth = rank[mine] - first[k]
                sequence[mine] = base[k] + nth // each[k]
                offset[mine] = at[k] + nth % each[k] * value
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(before, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
