"""Embedding near-dedup, prefix trie and token alignment against brute force, SQL and the libraries."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benefitlens.llm import align, pq_dedup, prefix_trie, tokenizer_ids
from benefitlens.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001


# ------------------------------------------------------------------ embeddings
def near_by_brute_force(rows, cosine=0.95):
    sound = [i for i, (_, e) in enumerate(rows) if e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links, label = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for size in {len(rows[i][1]) for i in sound}:
        mine = [i for i in sound if len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in mine], float)
        x /= np.abs(x).max(1, keepdims=True)
        u = x / np.sqrt((x * x).sum(1))[:, None]
        linked = u @ u.T >= cosine
        np.fill_diagonal(linked, False)
        for a, i in enumerate(mine):
            links[i] = int(linked[a].sum())
            for b in np.flatnonzero(linked[a]):
                label[top(i)] = top(mine[b])
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[top(i)] = min(least.get(top(i), v), v)
    out = Counter()
    for i, (v, _) in enumerate(rows):
        c = least.get(top(i))
        out[v, links[i], c, links[i] == 0 if v is None or c is None else v == c] += 1
    return out


def odd_vectors():
    """Close and far pairs in few and many dimensions, a tight group, equal, scaled, unsound and repeated rows."""
    rng = np.random.default_rng(3)
    rows = []
    for size, n in ((64, 200), (5, 300), (3, 150)):
        x = rng.normal(size=(n, size))
        y = x[rng.integers(0, n, 200)]
        y = y + rng.normal(size=y.shape) * rng.uniform(0, 0.5, (200, 1)) * np.linalg.norm(y, axis=1, keepdims=True) / np.sqrt(size)
        z = x[0] + rng.normal(size=(250, size)) * 0.1
        rows += [r.tolist() for r in np.concatenate([x, y, z, x[:30] * 3, z[:5], z[:5]])]
    rows += [None, [], [0.0] * 64, [math.nan] + [1.0] * 63, [None] + [1.0] * 63, [math.inf, 1.0], [1.0, 2.0], [1e-300, 2e-300]]
    ids = rng.permutation(len(rows)).tolist()
    ids[5], ids[8] = None, ids[9]
    return list(zip(ids, rows))


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, "x") for i, e in rows], "vec_id long, embedding array<double>, list int, size int, code string").repartition(7)


@pytest.mark.parametrize("block, probing", [(8192, 65536), (40, 50)])
def test_near_vectors_against_brute_force(spark, monkeypatch, block, probing):
    """Also with lists split into many blocks and copies."""
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    monkeypatch.setattr(pq_dedup, "PROBING", probing)
    rows = odd_vectors()
    assert Counter(map(tuple, pq_dedup.near_duplicates(vectors_of(spark, rows)).collect())) == near_by_brute_force(rows)


def test_near_vectors_of_nothing(spark):
    assert pq_dedup.near_duplicates(vectors_of(spark, [(1, None)]).limit(0)).collect() == []
    assert sorted(map(tuple, pq_dedup.near_duplicates(vectors_of(spark, [(1, None), (2, [])])).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_op11_on_the_table(spark):
    """Float vectors; recall is 1: nothing is lost on the given table, which is joined with slightly moved copies."""
    given = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert Counter(map(tuple, QUERIES["op11_pq_near_dedup"](spark, SF0001).collect())) == near_by_brute_force(given)
    rng = random.Random(1)
    moved = [(10_000 + i, [x + rng.gauss(0, s / 8) for x in e]) for i, e in given[:200] for s in (0.05, 0.2, 0.3, 0.35)]
    rows = [(i, [float(np.float32(x)) for x in e]) for i, e in given + moved]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter(map(tuple, pq_dedup.near_duplicates(df).collect()))
    assert got == near_by_brute_force(rows) and sum(n for (_, n, _, _), _ in got.items()) > 200


def test_cores_are_not_compared(spark):
    """A tight group costs no comparison among its members: its list has a core of nearly all of them."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 16))
    group = x[0] + rng.normal(size=(600, 16)) * 0.02
    q = pq_dedup.Quantizer(np.concatenate([x, group]), 20, 0.95)
    lists, core, *_ = q.entries(pq_dedup.units(group))
    assert len(set(lists.tolist())) == 1 and core.all()


# ------------------------------------------------------------------ conversations
def trie_by_brute_force(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    members, whole = defaultdict(list), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out, total = Counter(), {}
    for k in sorted(members, key=len, reverse=True):
        n = len(members[k])
        saved = (n - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        total[k] = sum(total[x][0] for x in children[k]) or 1, saved + sum(total[x][1] for x in children[k])
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(whole[c]) == len(k)))
        out[min(members[k]), len(k), min(members[k[:-1]]) if k else None, n, len(children[k]), *total[k], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def odd_turns(n, seed):
    rng = random.Random(seed)
    texts = ["x", "x y", "", "\tz  q\n", None, "é w", "long " * 4000]
    rows = [(rng.choice([None, -3, -25, *range(90)]), rng.choice([None, 0, 1, 1, 2, 3]), rng.choice(["user", None, "a"]), rng.choice(texts)) for _ in range(n)]
    return rows + [(c, t, "system", "the same") for c in range(200, 500) for t in range(c % 3)]


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, slice string").repartition(5)


@pytest.mark.parametrize("light", [3, 32, 10**6])
def test_trie_against_brute_force(spark, monkeypatch, light):
    """Hot first turns; with nearly all nodes above the shards, and with all in one shard."""
    monkeypatch.setattr(prefix_trie, "LIGHT", light)
    rows = odd_turns(300, light)
    assert Counter(map(tuple, prefix_trie.prefix_trie(turns_of(spark, rows)).collect())) == trie_by_brute_force(rows)


def test_trie_of_nothing_and_of_one_long_conversation(spark):
    assert prefix_trie.prefix_trie(turns_of(spark, [(1, 1, "a", "b")]).limit(0)).collect() == []
    rows = [(7, t, "a", "w " * (t % 3)) for t in range(3000)] + [(8, 0, "a", "")]
    assert Counter(map(tuple, prefix_trie.prefix_trie(turns_of(spark, rows)).collect())) == trie_by_brute_force(rows)


def test_op12_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF0001}/conversations.parquet')")
    r = con.execute(ORACLE_SQL["op12_prefix_trie"])
    got = QUERIES["op12_prefix_trie"](spark, SF0001)
    assert [d[0] for d in r.description] == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(r.fetchall())


def test_sql_of_op12_on_odd_turns():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = odd_turns(300, 5)
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert Counter(con.execute(ORACLE_SQL["op12_prefix_trie"]).fetchall()) == trie_by_brute_force(rows)


def test_spilling_queue_pops_in_order(spark, monkeypatch):
    """Many spilled runs, pushes between pops."""
    monkeypatch.setattr(prefix_trie, "READ", 3)
    rng, queue, model = random.Random(2), prefix_trie.SpillingQueue(held=10), []
    for i in range(2000):
        if rng.random() < 0.6 or not model:
            item = (rng.randint(0, 50), rng.randint(0, 9), i)
            queue.push(item)
            model.append(item)
        else:
            model.sort()
            assert queue.pop() == model.pop(0)
    assert len(queue.runs) > 10 and queue.loose <= 10
    assert [queue.pop() for _ in sorted(model)] == sorted(model) and queue.first() is None


# ------------------------------------------------------------------ alignment
def alignment_by_brute_force(texts):
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = {x: n for n, x in tokenizer_ids.byte_letters().items()}
    entry = {i: bytes(letters.get(c, 0) for c in p) for p, i in a.get_vocab(False).items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    rows, links = [], []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(map(entry.get, ids_a)) != raw or b"".join(map(piece, ids_b)) != raw:
            rows.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        spans = []
        for ids, size in ((ids_a, lambda i: len(entry[i])), (ids_b, lambda i: len(piece(i)))):
            ends = np.cumsum([size(i) for i in ids]).tolist()
            spans.append(list(zip(ids, [0, *ends], ends)))
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = ["|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in spans) for start, end in zip([0, *cuts], cuts)]
        links.append([(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if max(s, t) < min(e, f)])
        rows.append((len(ids_a), len(ids_b), len(groups), len(links[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    held = Counter(p for one in links for p in set(one))
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    return [(*r[:4], sum(held[p] == highest[p[0]] for p in one), sum(held[p] for p in one), r[4]) for r, one in zip(rows, links)]


ODD_TEXTS = [None, "", " ", "a ", "  a", "\n foo\r\n;\r x", "a▁b", "<|endoftext|> x<s>", "x" * 700, "a\x00b", "a\xa0b \xa0 c", "中文 中文😀 é", "  \n\n  x\n  y  ", "it's 's", "same", "same", "\x1c q  r　s", " ab" * 300]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_brute_force(spark, monkeypatch, small):
    """Repeated and null ids too; with many small runs, merged in passes, met by many cells."""
    if small:
        for name, value in (("FAN_IN", 2), ("CELL_BYTES", 200)):
            monkeypatch.setattr(align, name, value)
    texts = [r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("text").limit(30).collect() if len(r.text) < 3000] + ODD_TEXTS
    want = Counter(zip([None if i == 3 else i // 2 for i in range(len(texts))], *zip(*alignment_by_brute_force(texts))))
    df = spark.createDataFrame([(None if i == 3 else i // 2, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, radix int").repartition(6)
    assert Counter(map(tuple, align.align(df).collect())) == want
    assert align.align(df.limit(0)).collect() == []


def test_alignment_in_one_worker(monkeypatch):
    """The unit table shrinks often, runs end often, long units aren't kept."""
    for name, value in (("MOST_UNITS", 30), ("LONG_UNIT", 12)):
        monkeypatch.setattr(align, name, value)
    rng = random.Random(4)
    texts = ["".join(rng.choice([" ", " the", "and", "é", "\n", "▁", "lonnnnnnnnnnnnnng", ".", "'s", "  "]) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    both = align.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    want = alignment_by_brute_force(texts)
    for i in range(0, 400, 20):
        numbers, digests, *_ = both.documents(texts[i : i + 20])
        assert [(*n, d) for n, d in zip(numbers.tolist(), digests)] == [(*w[:4], w[6]) for w in want[i : i + 20]]
        assert len(both.rows) == len(both.text) == len(both.counts) == len(both.met)


def test_heap_merge_and_maxima(monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 16)
    rng = random.Random(6)
    total, runs = Counter(), []
    for _ in range(9):
        run = Counter({rng.randrange(6) << align.B_BITS | rng.randrange(30): rng.randint(1, 5) for _ in range(60)})
        total.update(run)
        keys = np.array(sorted(run))
        counts = np.array([run[k] for k in keys.tolist()])
        runs.append(iter([(keys[i : i + 7], counts[i : i + 7]) for i in range(0, len(keys), 7)]))
    blocks = list(align.with_maxima(align.heap_merge(runs)))
    pairs, n, best = (np.concatenate(c) for c in zip(*blocks))
    assert len(blocks) > 1 and dict(zip(pairs.tolist(), n.tolist())) == total and (np.diff(pairs) > 0).all()
    highest = defaultdict(int)
    for k, v in total.items():
        highest[k >> align.B_BITS] = max(highest[k >> align.B_BITS], v)
    assert [bool(b) for b in best] == [total[k] == highest[k >> align.B_BITS] for k in pairs.tolist()]


def test_counted_pairs_are_document_counts(spark):
    """The corpus-wide table that alignment leaves behind, as rows."""
    made = spark.createDataFrame([("counts", 1, r, 0, 0, 0, 0, 0, 0, "", r, align.packed(np.array([(r << align.B_BITS) | 5, (r << align.B_BITS) | 9]), np.array([2, 3]))) for r in range(4) for _ in range(2)], align._MADE_SPARK)
    got = align.counted_pairs(align.pair_counts(made))
    assert sorted(map(tuple, got.collect())) == sorted((r, b, n, best) for r in range(4) for b, n, best in ((5, 4, False), (9, 6, True)))
    assert got.agg(F.count("*")).first()[0] == 8
