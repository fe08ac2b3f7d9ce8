"""Exact copies, near copies and fingerprints against brute force."""
import hashlib
import random
import re
import struct
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from benefitlens.llm import components, exact_dedup, imatch, ngram_join
from benefitlens.llm.common import fresh_folder
from benefitlens.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001


def docs_of(spark, rows):
    """doc_id and text with other columns of clashing names."""
    return spark.createDataFrame([(i, t, 0, "x", 1.5) for i, t in rows], "doc_id long, text string, n long, class string, digest double")


ODD = [(1, "a b\tc"), (2, "abc"), (3, None), (4, ""), (5, " \n"), (None, "a b  c"), (6, "q"), (6, "q"), (7, "long " * 30000), (8, "LONG " * 30000), (9, "\x1c abc")]


def duck(sql, sf_dir, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    r = con.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def test_op2_against_sql(spark):
    got = QUERIES["op2_exact_dedup"](spark, SF0001)
    columns, rows = duck(ORACLE_SQL["op2_exact_dedup"], SF0001, "documents")
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(rows)


def brute_copies(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, doc))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def test_exact_dedup_odd_rows(spark):
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "index"), 4)
    rows = exact_dedup.dedup(docs_of(spark, ODD), index, "one").collect()
    want = brute_copies(ODD)
    assert len(rows) == len(ODD)
    by_digest = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert all(by_digest[r["text_sha256"]] == (r["keep_id"], r["group_size"]) for r in rows)
    assert sum(r["kept"] for r in rows) == len(want)  # also of the repeated row, one stays
    kept = exact_dedup.without_copies(docs_of(spark, ODD), exact_dedup.DigestIndex(spark, fresh_folder(spark, "index"), 4), "one").collect()
    assert len(kept) == len(want)
    empty = exact_dedup.dedup(docs_of(spark, ODD).limit(0), exact_dedup.DigestIndex(spark, fresh_folder(spark, "index"), 4), "one")
    assert empty.count() == 0


def test_the_index_lasts_and_grows(spark):
    path = fresh_folder(spark, "index")
    exact_dedup.dedup(docs_of(spark, [(1, "a"), (2, "b"), (3, "b")]), exact_dedup.DigestIndex(spark, path, 4), "one").collect()
    again = exact_dedup.DigestIndex(spark, path, 4)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.dedup(docs_of(spark, [(4, " a "), (5, "c"), (6, "c")]), again, "two").collect()}
    assert got == {4: (1, False), 5: (5, True), 6: (5, False)}
    assert sorted(r["keep_id"] for r in again.rows().collect()) == [1, 2, 5]


def test_anti_join_reads_the_index_in_buckets(spark):
    path = fresh_folder(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    exact_dedup.dedup(docs_of(spark, [(i, str(i)) for i in range(50)]), index, "one").collect()
    best = index.stage(exact_dedup.best_rows(exact_dedup.digests(docs_of(spark, [(1, "a")]))))
    plan = index.missing(best)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "Exchange" not in plan


def test_the_index_gets_more_buckets(spark):
    path = fresh_folder(spark, "index")
    texts = [(i, f"text {i % 700}") for i in range(1000)]
    index = exact_dedup.DigestIndex(spark, path, 2, rows_per_bucket=100)
    assert exact_dedup.dedup(docs_of(spark, texts[:150]), index, "one").filter("kept").count() == 150
    assert index.buckets == 2
    kept = [r["doc_id"] for r in exact_dedup.dedup(docs_of(spark, texts[150:]), index, "two").filter("kept").collect()]
    assert sorted(kept) == list(range(150, 700)) and index.buckets == 32
    again = exact_dedup.DigestIndex(spark, path, 2, rows_per_bucket=100)
    assert again.buckets == 32 and again.rows().count() == 700
    assert exact_dedup.dedup(docs_of(spark, texts), again, "three").filter("kept").count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]


def test_columns_that_differ_in_case(spark):
    docs = docs_of(spark, [(1, "a b"), (2, "ab")]).withColumn("x", F.lit(1)).toDF("doc_id", "text", "TEXT", "Doc_Id", "n", "m")
    got = exact_dedup.dedup(docs, exact_dedup.DigestIndex(spark, fresh_folder(spark, "index"), 4), "one").collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in got} == {(1, 1, True), (2, 1, False)}


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def near_rows(seed):
    """Chains and groups of near copies, short texts, a passage that many texts share, exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 12, 40, 90, 200]))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(base))
            base[at:at] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append((" " if rng.random() < 0.5 else "\n").join(w.upper() if rng.random() < 0.2 else w for w in copy))
            if rng.random() < 0.3:
                base = copy
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = [*near_rows(seed), (9001, None), (9002, " \n"), (9003, "one"), (9003, "one"), (None, "one two three four five six")]
    got = ngram_join.jaccard_components(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_components(rows), key=str)


def test_a_hot_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    rows = [(i, " ".join([*base[:60], *(f"x{rng.randrange(9)}" for _ in range(rng.randrange(3))), *base[60:]])) for i in range(150)]
    rows += [(1000 + i, " ".join([*base[:50], *(f"y{rng.randrange(10**6)}" for _ in range(40))])) for i in range(100)]
    got = ngram_join.jaccard_components(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_op6_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op6_ngram_jaccard"](spark, SF0001).collect())) == sorted(brute_components(rows))
    assert ngram_join.jaccard_components(docs_of(spark, [(1, "a")]).limit(0)).count() == 0


def test_shingle_sets_match_words():
    texts = [t for _, t in near_rows(5)] + ["", " ", "É É é a b c", "a\x0bb\x0cc\rd\te f"]
    for text, got in zip(texts, ngram_join.shingle_sets(texts)):
        assert len(got) == len(shingles(text)) and (np.diff(got.astype(object)) > 0).all()


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (95, 90), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 90, 95: 90, 90: 90, 200: 200, 201: 200}


def test_op7_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = QUERIES["op7_imatch"](spark, SF0001).collect()
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    same = defaultdict(set)
    for r in rows:
        text, third = texts[r["doc_id"]], len(texts[r["doc_id"]]) // 3
        edited = text[: len(text) - third] + texts[following[r["doc_id"]]][:third]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_next"] == 1) >= (r["fingerprint"] == prints[following[r["doc_id"]]])
        same[text].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    assert np.mean([r["near_edited"] for r in rows]) > np.mean([r["near_next"] for r in rows]) + 0.1


def test_fingerprints_are_hashes_of_the_band(spark):
    rows = [(i, f"common only{i} pair{i // 2} few{i % 5}") for i in range(40)]
    got = imatch.edited_likeness(docs_of(spark, rows), min_share=0.05, max_share=0.3).collect()
    # in the band are pair (2 of 40) and few (8 of 40); common (all) and only (1) are not
    by = defaultdict(set)
    for r in got:
        by[(r["doc_id"] // 2, r["doc_id"] % 5)].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values())
    assert len({next(iter(v)) for v in by.values()}) == len(by)


def spark_hash(x, seed=42):
    """xxhash64 of a text, a long, or a list of longs (each seeds the next), as Spark has it."""
    if isinstance(x, list):
        for one in x:
            seed = spark_hash(one, seed)
        return seed
    data = x.encode() if isinstance(x, str) else struct.pack("<q", x)
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(data, seed=seed & (2**64 - 1))))[0]


def brute_prints(rows, low, high):
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row, sorted."""
    rows = [(i, t or "") for i, t in rows]
    terms = lambda t: {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}
    df = Counter(w for _, t in rows for w in terms(t))
    band = {w for w, n in df.items() if low * len(rows) <= n <= max(high * len(rows), 1)}

    def fingerprint(text):
        hashes = sorted(spark_hash(w) for w in (terms(text) & band or terms(text)))
        cuts = [[h for h in hashes if not subset_bits(h, k)] for k in range(len(imatch.SUBSET_BITS))]
        return spark_hash(hashes) if hashes else spark_hash(text), [spark_hash(c) if c else None for c in cuts]

    def subset_bits(h, k):
        seeded = xxhash.xxh64_intdigest(struct.pack("<i", k), seed=spark_hash(h) & (2**64 - 1))
        return seeded & ((1 << imatch.SUBSET_BITS[k]) - 1)

    def show(p):
        return f"{p[0] & (2**64 - 1):016x}-" + "".join("." if h is None else f"{h & 0xFFFFFFFF:08x}" for h in p[1])

    def like(p, q):
        either = [(a, b) for a, b in zip(p[1], q[1]) if a is not None or b is not None]
        return 1.0 if p[0] == q[0] else sum(a == b for a, b in either) / len(either) if either else 0.0

    key = lambda r: hashlib.sha256(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).digest()[:16]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), key(r)))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        p, e, f = fingerprint(t), fingerprint(edited), fingerprint(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), show(p), show(e), round(like(p, e), 9), round(like(p, f), 9)))
    return sorted(out, key=str)


def prints_of(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, df.collect())), key=str)


def test_op7_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert prints_of(QUERIES["op7_imatch"](spark, SF0001)) == brute_prints(rows, imatch.MIN_SHARE, imatch.MAX_SHARE)


@pytest.mark.parametrize("rows", [
    ODD,
    [(None, "one two three four"), (None, "five six seven"), (None, None), (3, "one two"), (3, "eight nine ten"), (3, "eight nine ten"), (-(2**63), "x y z")],
    [(4, "the same text again")] * 25 + [(5, "another text"), (None, "the same text again")],
    [(1, "alone with a copy")] * 2,
])
def test_imatch_keeps_every_row(spark, rows):
    assert prints_of(imatch.edited_likeness(docs_of(spark, rows), min_share=0.1, max_share=0.3)) == brute_prints(rows, 0.1, 0.3)


def test_imatch_repeats_are_dealt(spark):
    got = imatch.edited_likeness(spark.range(25_001).select(F.lit(7).alias("doc_id"), F.lit("again and again").alias("text")))
    assert got.count() == 25_001 and got.filter("near_next = 1").count() == 25_001


def test_imatch_texts_outside_the_band_differ(spark):
    rows = [(i, f"word{i} other{i} more{i}") for i in range(50)] + [(50 + i, "?" * i) for i in range(5)]
    got = imatch.edited_likeness(docs_of(spark, rows), min_share=0.5).collect()
    assert len({r["fingerprint"] for r in got}) == 55
    assert sum(r["near_next"] for r in got) < 3


def test_imatch_odd_rows(spark):
    got = {r["doc_id"]: r for r in imatch.edited_likeness(docs_of(spark, ODD)).collect()}
    assert set(got) == {d for d, _ in ODD}
    assert got[3]["fingerprint"] == got[4]["fingerprint"] and got[3]["n_chars"] == 0
    assert got[None]["edited_sha256"] == hashlib.sha256(("a b " + "\x1c a").encode()[: len("a b ") + 2]).hexdigest()
    assert imatch.edited_likeness(docs_of(spark, ODD).limit(0)).count() == 0
    alone = imatch.edited_likeness(docs_of(spark, [(5, "abcdef")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


