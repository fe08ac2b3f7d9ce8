"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each partition.

Encoding: the words of a partition that its worker hasn't met are laid out as rows
(word, position, token, next token), one row a byte. A recursive query joins the
rows with the merge table (every pair of tokens whose bytes together are a token),
takes each word's lowest rank, leftmost first, contracts that pair, and goes on
with the words that changed until none does. A word that is a token itself is that
token. Texts are the concatenation of their words (``words.WordTable``).

A recursive query keeps the rows of all its rounds, which for a word of thousands
of bytes would be millions. Such words are contracted round by round in a table,
all occurrences of the lowest pair at once wherever the new token can't take part
in a pair of lower rank (then it's the same as one after the other).

Decoding: token-position rows join the vocabulary, and an ordered aggregation
strings each document's bytes together.

Each Python worker holds one in-memory DuckDB database with the merge table and
the vocabulary (about 100,000 and 50,000 rows); it runs on one thread and spills
nowhere, since its input is one group of texts.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from benefitlens.llm.common import id_text, on_workers
from benefitlens.llm.tokenizer_ids import vocabulary_path
from benefitlens.llm.words import WordTable, groups

#: Words contracted by one recursive query, and the bytes from which a word is contracted in a table.
WORDS_A_QUERY = 50_000
LONG_WORD = 512

# The rank of a merge is the id it gives, so the lowest id is the lowest rank. A step keeps the words that it changed;
# what a word looked like at its last step is its encoding.
_CONTRACT = """
WITH RECURSIVE step(round, word, pos, token, next) AS (
  SELECT 0, word, pos, token, next FROM bytes
  UNION ALL
  (WITH lowest AS (
     SELECT s.word, min((m.id::BIGINT << 32) | s.pos) AS pick
     FROM step s JOIN merges m ON m.a = s.token AND m.b = s.next GROUP BY s.word),
   pair AS (
     SELECT l.word, (l.pick & 4294967295)::INT AS pos, (l.pick >> 32)::INT AS id, s.next AS after
     FROM lowest l JOIN step s ON s.word = l.word AND s.pos = (l.pick & 4294967295)::INT + 1)
   SELECT s.round + 1, s.word, s.pos - (s.pos > p.pos)::INT,
          CASE WHEN s.pos = p.pos THEN p.id ELSE s.token END,
          CASE WHEN s.pos = p.pos THEN p.after WHEN s.pos = p.pos - 1 THEN p.id ELSE s.next END
   FROM step s JOIN pair p ON p.word = s.word WHERE s.pos <> p.pos + 1)
)
SELECT s.word, s.pos, s.token FROM step s
JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) z ON z.word = s.word AND z.round = s.round
ORDER BY s.word, s.pos
"""

# Neighbouring hits overlap (only where both tokens are the same): of each run the first, third and so on are taken.
_LONG_ROUND = """
CREATE OR REPLACE TABLE long_words AS
WITH found AS (
  SELECT p.word, p.pos, m.id, m.alone
  FROM (SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS next FROM long_words) p
  JOIN merges m ON m.a = p.token AND m.b = p.next),
lowest AS (SELECT word, min(id) AS id FROM found GROUP BY word),
hits AS (
  SELECT f.*, f.pos - row_number() OVER (PARTITION BY f.word ORDER BY f.pos) AS run
  FROM found f JOIN lowest l ON l.word = f.word AND l.id = f.id),
taken AS (
  SELECT word, pos, id FROM (
    SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS nth,
           row_number() OVER (PARTITION BY word ORDER BY pos) AS first FROM hits)
  WHERE nth % 2 = 1 AND (first = 1 OR NOT alone))
SELECT s.word, (row_number() OVER (PARTITION BY s.word ORDER BY s.pos) - 1)::INT AS pos, coalesce(t.id, s.token)::INT AS token
FROM long_words s LEFT JOIN taken t ON t.word = s.word AND t.pos = s.pos
WHERE NOT EXISTS (SELECT 1 FROM taken b WHERE b.word = s.word AND b.pos + 1 = s.pos)
"""

_DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY first_pos) AS piece FROM (
  SELECT doc, block, min(pos) AS first_pos, string_agg(piece, '') AS piece
  FROM (SELECT t.doc, t.pos, t.pos // 65536 AS block, v.piece FROM tokens t JOIN vocabulary v ON v.id = t.id ORDER BY t.doc, t.pos)
  GROUP BY doc, block)
GROUP BY doc
"""


@functools.cache
def ranks(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary_path(vocabulary), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    def __init__(self, vocabulary: str):
        import duckdb

        self.ranks = ranks(vocabulary)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(a, b, r) for token, r in self.ranks.items() for i in range(1, len(token)) if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        self.db = duckdb.connect(":memory:", config={"threads": 1, "preserve_insertion_order": True})
        # a byte is written as the code point of its number, which keeps ordered text aggregation to bytes
        lower = {x for a, b, r in pairs for x in (a, b) if x > r}  # tokens that take part in a pair of lower rank
        merges = dict(zip(("a", "b", "id", "alone"), map(list, zip(*((a, b, r, int(r in lower)) for a, b, r in pairs)))))
        for name, columns in (("merges", merges), ("vocabulary", {"id": list(self.ranks.values()), "piece": [t.decode("latin-1") for t in self.ranks]})):
            given = pa.table({k: pa.array(v, pa.string() if k == "piece" else pa.int32()) for k, v in columns.items()})
            self.db.register("given", given)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * REPLACE (alone = 1 AS alone) FROM given" if name == "merges" else f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.words = WordTable(self.encode_words)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word)."""
        parts = [self._contract([w.encode("utf-8") for w in words[i : i + WORDS_A_QUERY]]) for i in range(0, len(words), WORDS_A_QUERY)]
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        sizes = np.ones(len(words), np.int64)
        length = np.array([len(w) for w in words], np.int64)
        got = []
        for part, run in (((whole < 0) & (length < LONG_WORD), self._recursive), ((whole < 0) & (length >= LONG_WORD), self._in_rounds)):
            open_ = np.flatnonzero(part)
            if len(open_):
                token = self.of_byte[np.frombuffer(b"".join(words[i] for i in open_), np.uint8)]
                end = np.cumsum(length[open_])
                pos = np.arange(len(token)) - np.repeat(end - length[open_], length[open_])
                after = np.append(token[1:], -1)
                after[end - 1] = -1
                self.db.register("bytes", pa.table({"word": np.repeat(open_, length[open_]).astype(np.int32), "pos": pos.astype(np.int32), "token": token, "next": after.astype(np.int32)}))
                rows = run()
                self.db.unregister("bytes")
                sizes[open_] = np.bincount(rows["word"], minlength=len(words))[open_]
                got.append(rows)
        ids = np.empty(int(sizes.sum()), np.int64)
        first = np.cumsum(sizes) - sizes
        closed = whole >= 0
        ids[first[closed]] = whole[closed]
        for rows in got:
            ids[first[rows["word"]] + rows["pos"]] = rows["token"]
        return ids, sizes

    def _recursive(self) -> dict[str, np.ndarray]:
        return self.db.execute(_CONTRACT).fetchnumpy()

    def _in_rounds(self) -> dict[str, np.ndarray]:
        self.db.execute("CREATE OR REPLACE TABLE long_words AS SELECT word, pos, token FROM bytes")
        rows, before = self.db.execute("SELECT count(*) FROM long_words").fetchall()[0][0], -1
        while rows != before:
            self.db.execute(_LONG_ROUND)
            rows, before = self.db.execute("SELECT count(*) FROM long_words").fetchall()[0][0], rows
        got = self.db.execute("SELECT word, pos, token FROM long_words").fetchnumpy()
        self.db.execute("DROP TABLE long_words")
        return got

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each document's ids."""
        ends = np.cumsum(sizes)
        out = [b""] * len(sizes)
        if len(ids):
            self.db.register("tokens", pa.table({"doc": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "pos": np.arange(len(ids)) - np.repeat(ends - sizes, sizes), "id": ids.astype(np.int32)}))
            for doc, piece in self.db.execute(_DECODE).fetchall():
                out[doc] = piece.encode("latin-1")
            self.db.unregister("tokens")
        return out


@functools.cache
def bpe(vocabulary: str) -> Bpe:
    return Bpe(vocabulary)


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of each whole text.

    Defined results: a null text is empty (no ids); a null doc_id is kept; repeated rows give a row each; an empty table
    gives no rows; other columns are ignored. Special tokens' strings are ordinary text.
    """
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe(vocabulary).words
        for batch in batches:
            for first, texts in groups(batch.column(1).to_pylist()):
                ids, sizes = table.values_of(texts)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """All columns of (doc_id, ids) and ``bytes``, the text that the ids stand for; null ids are empty."""
    on_workers(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = bpe(vocabulary)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                ids = part.column(1)
                sizes = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                texts = decoder.decode(ids.flatten().to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, bytes binary")


def decimal_digest(ids: np.ndarray) -> str:
    """sha256 of the decimal ids, joined by commas."""
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes each whole text and decodes its ids again, both in one pass
    over the data so that ids don't travel between processes."""
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = bpe(vocabulary)
        for batch in batches:
            for first, texts in groups(batch.column(1).to_pylist()):
                ids, sizes = both.words.values_of(texts)
                ends = np.cumsum(sizes)
                digests = [decimal_digest(ids[e - n : e]) for e, n in zip(ends, sizes)]
                decoded = [hashlib.sha256(x).hexdigest() for x in both.decode(ids, sizes)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(sizes), pa.array(digests), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
