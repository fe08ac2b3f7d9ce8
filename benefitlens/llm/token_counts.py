"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

Byte-level BPE has a prefix property: cutting the last token off a word's tokens
leaves the tokens of the shorter prefix. So the tokens of all prefixes of a word
follow from one number each, the last token: at each end position exactly one
token t of the vocabulary fits after the last token of the prefix before it
without a merge across the border, and count[end] = count[end - len(t)] + 1.

Whether a merge would cross a border follows from the two tokens alone
(``_stable``), so the program never encodes a prefix again. Across words the
counts add up, except where a prefix ends inside a unit of white space and the
word after it, or inside a contraction, which the split pattern would cut
otherwise; those units are worked out as one (``_Counter.unit``).

A text's result is the count after every code point, from which truncation and
budget questions are lookups.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.llm.common import id_text, on_workers
from benefitlens.llm.tokenizer_ids import byte_letters, special_token, vocabulary_path
from benefitlens.llm.words import WHITE, WordTable, char_classes, groups

#: Bound of the cache of token pairs.
_BORDERS = 1_000_000


class _Counter:
    def __init__(self, vocabulary: str):
        model = json.load(open(vocabulary_path(vocabulary), encoding="utf-8"))["model"]
        back = {c: b for b, c in byte_letters().items()}
        raw = {t: bytes(back[c] for c in t) for t in model["vocab"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        number = {t: i for i, t in enumerate([*(t for t in raw if len(raw[t]) == 1), *(a + b for a, b in merges)])}  # in order of merging
        self.token = {raw[t]: i for t, i in number.items()}
        self.merge = {(number[a], number[b]): number[a + b] for a, b in merges}
        self.parts = {v: k for k, v in self.merge.items()}
        self.suffixes: dict = {}  # tokens by their bytes from the last to the first; -1: a token that begins here
        for t, i in self.token.items():
            node = self.suffixes
            for b in reversed(t):
                node = node.setdefault(b, {})
            node[-1] = i
        self.known: dict[tuple[int, int], bool] = {}

    def _spine(self, token: int, side: int) -> list[int]:
        """The token and the parts that face the border (side 1: right ends, 0: left ends), largest first."""
        out = [token]
        while token in self.parts:
            token = self.parts[token][side]
            out.append(token)
        return out

    def _stable(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border while the two tokens are built, lowest rank and leftmost first."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        i, j = len(a) - 1, len(b) - 1
        never = len(self.token)
        while True:
            across = self.merge.get((a[i], b[j]), never)
            next_left, next_right = a[i - 1] if i else never, b[j - 1] if j else never
            if across < next_left and across <= next_right and across < never:
                return False
            if not i and not j:
                return True
            # the side that merges first; on a tie the left one, which comes first in the word
            if next_left <= next_right:
                i -= 1
            else:
                j -= 1

    def counts(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """For each word, the token count at each of its byte prefixes (from the empty one)."""
        done: dict[bytes, list[int]] = {}
        before, last, count = b"", [-1], [0]
        known, suffixes = self.known, self.suffixes
        if len(known) > _BORDERS:
            known.clear()
        for word in sorted(set(words)):
            same = 0
            for x, y in zip(before, word):  # the prefixes shared with the word before
                if x != y:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                node, fits = suffixes, []
                for start in range(end - 1, -1, -1):  # the tokens that end here, shortest first
                    node = node.get(word[start])
                    if node is None:
                        break
                    if -1 in node:
                        fits.append((start, node[-1]))
                for start, t in reversed(fits):
                    if not start:
                        break
                    pair = last[start] << 17 | t
                    ok = known.get(pair)
                    if ok is None:
                        ok = known[pair] = self._stable(last[start], t)
                    if ok:
                        break
                last.append(t)
                count.append(count[start] + 1)
            done[word] = count.copy()
            before = word
        return done

    @staticmethod
    def _at_chars(word: str, data: bytes, counts: list[int]) -> list[int]:
        """Counts at code point ends, without the empty prefix."""
        return counts[1:] if len(data) == len(word) else [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each unit, how the count changes at each of its code points.

        A unit is white space with the word after it. A prefix that ends within its white space has that white space
        as its last word; beyond, the last space belongs to the word and the rest is a word of its own.
        """
        parts: list[tuple[str, str]] = []
        need: set[str] = set()
        for u in units:
            word = u.lstrip(_STRIP)
            space = u[: len(u) - len(word)]
            if space == " " or not word:
                word, space = u, ""
            parts.append((space, word))
            need.add(word)
            if space:
                need.update((space, space[:-1], space[-1], " " + word))
        need.discard("")
        data = {w: w.encode("utf-8") for w in need}
        counted = self.counts(list(data.values()))

        def chars(word: str) -> list[int]:
            c = self._at_chars(word, data[word], counted[data[word]])
            # a contraction that is cut short is an apostrophe and a letter
            return [1, 2, c[2]] if word in ("'re", "'ve", "'ll") else c

        at: list[int] = []
        for space, word in parts:
            if not space:
                at += chars(word)
            else:
                base = chars(space[:-1])[-1] if len(space) > 1 else 0
                if space[-1] == " ":
                    after = chars(" " + word)[1:]
                else:
                    base += chars(space[-1])[-1]
                    after = chars(word)
                at += chars(space)
                at += [base + x for x in after]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        counts = np.array(at, np.int32)
        steps = np.diff(counts, prepend=0)
        firsts = np.cumsum(sizes) - sizes
        steps[firsts] = counts[firsts]
        return steps, sizes


_STRIP = "".join(map(chr, np.flatnonzero(char_classes() <= WHITE).tolist()))


class Prefixes:
    """Counts after every code point of whole texts, the special token's string included."""

    def __init__(self, vocabulary: str):
        self.mark, _ = special_token(vocabulary)
        self.steps = WordTable(_Counter(vocabulary).units, joined_space=True, dtype=np.int32)

    def _marked(self, text: str) -> np.ndarray:
        """A text that holds the mark, which is one token between texts of their own. A prefix that ends within the
        mark is ordinary text after what stands before."""
        pieces, base = [], 0
        parts = text.split(self.mark)
        for i, part in enumerate(parts):
            cut = part if i + 1 == len(parts) else part + self.mark[:-1]
            counts = np.cumsum(self.steps.values_of([cut])[0], dtype=np.int32)
            pieces.append(base + counts)
            if i + 1 < len(parts):
                base += int(self.steps.values_of([part])[0].sum()) + 1
                pieces.append(np.array([base], np.int32))
        return np.concatenate(pieces)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(counts of all texts, code points of each text)."""
        has = [i for i, t in enumerate(texts) if self.mark in t]
        steps, sizes = self.steps.values_of(texts)
        ends = np.cumsum(sizes)
        counts = np.cumsum(steps, dtype=np.int64)
        counts -= np.repeat(np.concatenate([[0], counts])[ends - sizes], sizes)
        counts = counts.astype(np.int32)
        for i in has:
            counts[ends[i] - sizes[i] : ends[i]] = self._marked(texts[i])
        return counts, sizes


@functools.cache
def prefixes_of(vocabulary: str) -> Prefixes:
    return Prefixes(vocabulary)


def prefix_token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, counts: the exact token count after each code point of the whole text (empty for an empty one).

    Defined results: a null text is empty; a null doc_id is kept; repeated rows give a row each; an empty table gives
    no rows; other columns are ignored.
    """
    on_workers(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = prefixes_of(vocabulary)
        for batch in batches:
            ids, sizes = batch.column(0), batch.column(1)
            for first, texts in groups(batch.column(2).to_pylist()):
                counts, chars = prefixes.of(texts)
                ends = np.concatenate([[0], np.cumsum(chars)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), sizes.slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), pa.array(counts))], names=["doc_id", "n_bytes", "counts"])

    d = id_text(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    return d.mapInArrow(count, "doc_id bigint, n_bytes bigint, counts array<int>")


def token_budget(counted: DataFrame, limit: int) -> DataFrame:
    """From ``prefix_token_counts``: n_tokens of the whole text, whether it's over the limit, and the code points of
    the longest prefix within the limit (counts may fall again where a merge completes, so the last such position)."""
    from_end = F.array_position(F.transform(F.reverse("counts"), lambda c: c <= limit), True)
    fits = F.when(from_end > 0, F.size("counts") - from_end + 1).otherwise(0)
    n = F.when(F.size("counts") > 0, F.element_at("counts", -1)).otherwise(0).cast("bigint")
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"), F.when(n <= limit, F.size("counts")).otherwise(fits).cast("bigint").alias("chars_within_limit"))


def tokens_at(counted: DataFrame, n_chars: int) -> DataFrame:
    """Tokens of each text's first ``n_chars`` code points."""
    at = F.least(F.lit(n_chars), F.size("counts"))
    return counted.select("doc_id", F.when(at > 0, F.get("counts", at - 1)).otherwise(0).cast("bigint").alias("n_tokens"))
