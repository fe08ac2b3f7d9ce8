"""Encoding, decoding, counting, packing and token files against the tokenizer libraries."""
import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from benefitlens.llm import bpe, packing, simple8b, token_counts, token_files, tokenizer_ids
from benefitlens.llm.common import fresh_folder
from benefitlens.llm.queries import QUERIES
from tests.conftest import SF0001

ALPHABET = [*"ab1 .'\n\tſs  é²½中\x1c\x85\xa0_-lrevdmt''  ", "<|endoftext|>", "'ll", "'re", "the", "  ", "aaaaaaa", "\x00"]


def strings(n, most=12, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ranked():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, other columns with clashing names."""
    rows = [(1, "the cat's<|endoftext|> hat"), (2, None), (3, ""), (None, "no id"), (4, "ab " * 9000), (5, "same"), (5, "same"), (6, "x" * 3000), (7, "A\n\n  b\t c  ")]
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, ids string, length int, task int")


def test_ids_are_the_librarys(library):
    texts = strings(4000)
    for first, values, sizes in tokenizer_ids.ids_of("byte_bpe_50k.json", texts):
        ends = np.cumsum(sizes)
        for k, (n, e) in enumerate(zip(sizes, ends)):
            assert values[e - n : e].tolist() == library.encode(texts[first + k], add_special_tokens=False).ids


def test_duckdb_encoding_and_decoding(ranked):
    rng = random.Random(9)
    long = ["".join(rng.choice("abcdeinorst") for _ in range(n)) for n in (511, 512, 700, 3000)]
    texts = [*strings(3000), "a" * 500, " " * 500, "a" * 20001, " " * 3001, "ab" * 900, "xyz!" * 1500, *long]
    both = bpe.bpe("byte_bpe_multi_50k.tiktoken")
    ids, sizes = both.words.values_of(texts)
    for t, n, e in zip(texts, sizes, np.cumsum(sizes)):
        assert ids[e - n : e].tolist() == ranked.encode_ordinary(t)
    assert both.decode(ids, sizes) == [t.encode() for t in texts]


def test_encode_and_decode_frames(spark, odd, ranked):
    rows = bpe.decode(bpe.encode(odd)).collect()
    want = Counter((r["doc_id"], r["text"] or "") for r in odd.collect())
    assert Counter((r["doc_id"], bytes(r["bytes"]).decode()) for r in rows) == want
    assert all(list(r["ids"]) == ranked.encode_ordinary(bytes(r["bytes"]).decode()) for r in rows)
    assert bpe.encode(odd.limit(0)).count() == 0


def test_op1_query(spark, ranked):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in QUERIES["op1_byte_bpe"](spark, SF0001).collect():
        ids = ranked.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_counts_at_every_prefix(library):
    texts = strings(1500, 10)
    counts, sizes = token_counts.prefixes_of("byte_bpe_50k.json").of(texts)
    for t, n, e in zip(texts, sizes, np.cumsum(sizes)):
        assert counts[e - n : e].tolist() == [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)], t


def test_budgets(spark, odd, library):
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    counted = token_counts.prefix_token_counts(odd)
    got = {r["doc_id"]: r for r in token_counts.token_budget(counted, 8).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for k, t in texts.items():
        r = got[k]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), size(t), size(t) > 8)
        assert r["chars_within_limit"] == (len(t) if size(t) <= 8 else max(i for i in range(min(len(t), 200) + 1) if size(t[:i]) <= 8))
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.tokens_at(counted, 5).collect()} == {k: size(t[:5]) for k, t in texts.items()}
    assert counted.count() == 9


def test_op9_query(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = QUERIES["op9_token_counts"](spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 1024)


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for trial in range(200):
        n = int(rng.integers(0, 1500))
        values = rng.integers(0, 2**64, n, dtype=np.uint64) >> (rng.integers(0, 64, n).astype(np.uint64) if trial % 2 else np.uint64(trial % 64))
        if trial % 5 == 0:
            values[:] = 0
        words, index = simple8b.encode(values)
        assert (simple8b.decode(words, index, n) == values).all()
        for b in range(0, len(index), 3):  # a block decodes alone
            own = values[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]
            assert (simple8b.decode(words[index[b] :], np.zeros(1, np.uint32), len(own)) == own).all()


def _expected_files(docs, library):
    start = 0
    for doc_id, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_op5_query(spark, library):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op5_token_files"](spark, SF0001).collect())
    assert got == list(_expected_files(docs, library))


def test_token_files_odd_rows(spark, odd, library):
    path = fresh_folder(spark, "t")
    token_files.write_token_ids(odd, path)
    rows = sorted(token_files.read_token_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in rows}
    assert ids[2] == ids[3] == [2]
    assert ids[4] == library.encode("ab " * 9000, add_special_tokens=False).ids + [2]
    empty = fresh_folder(spark, "t")
    token_files.write_token_ids(odd.limit(0), empty)
    assert token_files.read_token_ids(spark, empty).count() == 0


def _check_packing(rows, texts, library, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for k, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc.pop(k), key=lambda r: r["piece"])
        at = 0
        for i, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (i, at)
            assert r["length"] == capacity or i == 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), -(-sum(r["length"] for r in rows) // capacity)


def test_op4_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    used, bound = _check_packing(QUERIES["op4_best_fit_packing"](spark, SF0001).collect(), texts, library)
    assert used <= bound * 1.02 + 1


def test_packing_odd_rows(spark, odd, library):
    unique = odd.dropDuplicates(["doc_id"])
    _check_packing(packing.pack(unique).collect(), {r["doc_id"]: r["text"] or "" for r in unique.collect()}, library)
    assert packing.pack(odd).filter("doc_id = 5").count() == 2
    assert packing.pack(odd.limit(0)).count() == 0


@pytest.mark.parametrize("lengths", [[1], [2048] * 5, [1000] * 10 + [1024] * 10 + [683] * 5, list(range(1, 2048)) * 3, [700] * 999])
def test_plans_hold_every_piece_once(lengths):
    plan = packing.plan_sequences(Counter(lengths))
    held = Counter()
    for times, pattern in plan:
        assert times > 0 and sum(n * each for n, each in pattern) <= 2048
        held.update({n: times * each for n, each in pattern})
    assert held == Counter(lengths)


@pytest.mark.parametrize("n, least", [(500, 0.7), (5_000, 0.9), (50_000, 0.97)])
def test_the_program_places_nearly_all(monkeypatch, n, least):
    tail, best_fit = [], packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda need, plan, capacity: (tail.append(int(need.sum())), best_fit(need, plan, capacity)))
    lengths = np.random.default_rng(4).gamma(1.2, 500, n).astype(int) % 2047 + 1
    plan = packing.plan_sequences(Counter(lengths.tolist()))
    assert 1 - sum(tail) / n >= least
    assert sum(times for times, _ in plan) <= 1.01 * -(-lengths.sum() // 2048) + 1


def test_the_program_places_lengths_that_leave_room(monkeypatch):
    tail, best_fit = [], packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda need, plan, capacity: (tail.append(int(need.sum())), best_fit(need, plan, capacity)))
    assert sum(times for times, _ in packing.plan_sequences({700: 2000, 600: 1000})) == 1000
    assert sum(tail) <= 30
