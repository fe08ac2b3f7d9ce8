"""Words made up to share a polynomial hash, and words of bounded tables."""
import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from benefitlens.llm import bpe, ngram_join, packing, token_counts, token_files, tokenizer_ids, words
from benefitlens.llm.common import fresh_folder


def thue_morse(n):
    """Two words of n letters whose polynomials agree modulo 2**64 for every odd base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


TWINS = [w for n in (1024, 2048, 4096) for w in thue_morse(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def twins(spark):
    """Twins in one text, in neighbouring texts and repeated."""
    texts = [*TWINS, " ".join(TWINS), " ".join(reversed(TWINS)), *TWINS, "plain words"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), texts


def test_twins_share_the_quick_hash_only():
    for a, b in zip(TWINS[::2], TWINS[1::2]):
        both = np.frombuffer((a + b).encode("utf-32-le"), "<u4")
        first, last = np.array([0, len(a)]), np.array([len(a), 2 * len(a)])
        quick, seeded = words.quick_hashes(both, first, last), words.seeded_hashes(both, first, last, 5)
        assert quick[0] == quick[1] and seeded[0] != seeded[1]


def test_hashes_depend_on_the_words_alone():
    """Equal words anywhere, in spans and beyond them."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 9, 500]))) for _ in range(3000)] + ["z" * (words.SPAN + 5), "z" * (words.SPAN + 6)]
    texts += texts[::7] + texts[-2:]
    code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    last = np.cumsum([len(t) for t in texts])
    first = last - [len(t) for t in texts]
    for hashes in (words.quick_hashes(code, first, last), words.seeded_hashes(code, first, last, 9)):
        by_word = dict(zip(texts, hashes.tolist()))
        assert [by_word[t] for t in texts] == hashes.tolist() and len(set(by_word.values())) == len(by_word)


def test_op1_on_twins(twins):
    df, texts = twins
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df).collect()}
    for i, t in enumerate(texts):
        ids = own.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_op4_and_op5_on_twins(spark, twins, library):
    df, texts = twins
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    pieces = {}
    for r in packing.pack(df).collect():
        pieces.setdefault(r.doc_id, {})[r.piece] = r
    for i, want in enumerate(ids):
        want, at = [*want, packing.END_ID], 0
        for _, r in sorted(pieces[i].items()):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    path = fresh_folder(spark, "twins")
    token_files.write_token_ids(df, path)
    got = {r.doc_id: r.ids_crc32 for r in token_files.ids_digest(token_files.read_token_ids(spark, path)).collect()}
    assert got == {i: zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for i, x in enumerate(ids)}


def test_op9_on_twins(twins, library):
    df, texts = twins
    got = {r.doc_id: r.n_tokens for r in token_counts.token_budget(token_counts.prefix_token_counts(df), 1024).collect()}
    assert got == {i: len(library.encode(t).ids) for i, t in enumerate(texts)}


def test_op6_on_twins(spark):
    """Texts of twins are far apart: nothing links them, copies do link."""
    texts = [" ".join(TWINS[::2]), " ".join(TWINS[1::2]), " ".join(TWINS[::2]), *TWINS[:2]]
    assert len({s.tobytes() for s in ngram_join.shingle_sets(texts, 3)}) == 4
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df).collect()} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}


def test_a_full_table_starts_anew_and_keeps_clashing_words_apart(library, monkeypatch):
    monkeypatch.setattr(words, "MAX_WORDS", 40)
    rng = random.Random(3)
    texts = [" ".join(rng.choice([*TWINS[:2], f"w{rng.randrange(60)}"]) for _ in range(8)) for _ in range(120)]
    table = tokenizer_ids.id_table.__wrapped__("byte_bpe_50k.json")
    for i in range(0, 120, 6):
        ids, sizes = table.values_of(texts[i : i + 6])
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for n, e in zip(sizes, ends)] == [library.encode(t).ids for t in texts[i : i + 6]]


def test_a_full_table_keeps_the_words_that_were_met_again(monkeypatch):
    monkeypatch.setattr(words, "MAX_WORDS", 40)
    encoded = Counter()
    table = words.WordTable(lambda new: (encoded.update(new), words.ragged(list(map(ord, w)) for w in new))[1])
    for i in range(60):
        texts = ["one two three", f"a{i} b{i} c{i} d{i}", "é" + chr(0x4E00 + i)]
        values, sizes = table.values_of(texts)
        assert "".join(map(chr, values)) == "".join(texts) and sizes.tolist() == list(map(len, texts))
    assert encoded["one"] == encoded[" two"] == encoded[" three"] == 1
    assert len(table.hashes) < 60


def test_a_table_holds_a_bounded_part_of_a_worker():
    """Of 600,000 different words."""
    table = words.WordTable(lambda new: words.ragged([1, 2, 3, 4] for _ in new))
    most = 0
    for i in range(0, 600_000, 50_000):
        table.values_of([" ".join(f"{chr(0x4E00 + j % 5000)}{chr(0x4E00 + j // 5000)}" for j in range(i, i + 50_000))])
        most = max(most, sum(x.nbytes for x in vars(table).values() if isinstance(x, np.ndarray)))
    assert most < 35_000_000


def test_tables_of_powers_stay_small():
    """A long text needs no longer tables than any other."""
    words.quick_hashes(np.full(3_000_000, 97, np.uint32), np.arange(0, 3_000_000, 1000), np.arange(1000, 3_000_001, 1000))
    assert sum(x.nbytes for x in words.powers()) == 16 * words.SPAN
