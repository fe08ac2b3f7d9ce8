"""I-Match document fingerprints over randomised lexicons, with DataFrame functions only.

A document's terms are its lower-cased runs of letters and digits. The lexicon
holds the terms whose document frequency lies in a band of shares of all
documents (a band of inverse document frequency). Its size has a bound that
doesn't depend on the corpus: a document has D distinct terms on average, so at
most D / MIN_SHARE terms reach the lower share. It's broadcast when its counted
size keeps that promise, else joined by shuffle.

The distinct in-band terms of a document, sorted, are hashed as a whole and once
for each of 32 random subsets of the lexicon, made by bits of the term's hash. The
subsets keep an eighth down to a 512th of the lexicon, so that short and long
documents both have subsets with a few terms. A text that holds no term of the
band is fingerprinted by all its terms, so unrelated ones differ. Likeness of two fingerprints is the
share of equal hashes among the subsets that hold a term of either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from benefitlens.llm.common import written

#: The band: shares of all documents that a lexicon term occurs in.
MIN_SHARE, MAX_SHARE = 0.001, 0.2
#: Bits of a term's hash (with the subset's number) that must be zero: eight subsets for each size.
SUBSET_BITS = [3] * 8 + [5] * 8 + [7] * 8 + [9] * 8
#: The lexicon's rows that are broadcast at most (16 bytes each).
BROADCAST_ROWS = 2_000_000
_NOTHING = ""


def term_hashes(text: Column) -> Column:
    """The distinct terms' 64-bit hashes; the empty term is always among them."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.array_append(words, F.lit(_NOTHING)), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """term (hash) of each lexicon term, and of the empty term, over all documents."""
    terms = docs.select(F.explode(term_hashes(F.coalesce(docs[text_col], F.lit("")))).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    nothing = F.xxhash64(F.lit(_NOTHING))
    band = F.col("df").between(min_share * n, max(max_share * n, 1))
    return written(counts.filter(band | (F.col("term") == nothing)).select("term"), "lexicon")


def _subset(terms: Column, k: int) -> Column:
    """The terms that the k-th subset of the lexicon holds."""
    zeros = (1 << SUBSET_BITS[k]) - 1
    return F.filter(terms, lambda t: F.xxhash64(t, F.lit(k)).bitwiseAND(zeros) == 0)


def with_fingerprint(df: DataFrame, terms: str, plain: str, whole: str, subsets: str) -> DataFrame:
    """Replaces an array of distinct terms by the hash of all of them, sorted (of a text without terms by ``plain``, the
    text's own hash), and the hashes of the subsets (null for an empty one). Each step is a projection of its own, so
    that a list is sorted and cut only once."""
    df = df.withColumn(terms, F.sort_array(terms))
    df = df.withColumn("_cuts", F.array(*(_subset(F.col(terms), k) for k in range(len(SUBSET_BITS)))))
    hashes = F.transform("_cuts", lambda cut: F.when(F.size(cut) > 0, F.xxhash64(cut)))
    return df.withColumns({whole: F.when(F.size(terms) > 0, F.xxhash64(terms)).otherwise(F.col(plain)), subsets: hashes}).drop(terms, plain, "_cuts")


def as_text(whole: Column, subsets: Column) -> Column:
    """The fingerprint written in hexadecimal: 16 digits of the whole, 8 of each subset, a dot for an empty one."""
    short = F.transform(subsets, lambda h: F.when(h.isNull(), ".").otherwise(F.lower(F.lpad(F.hex(h.bitwiseAND(0xFFFFFFFF)), 8, "0"))))
    return F.concat_ws("-", F.lower(F.lpad(F.hex(whole), 16, "0")), F.array_join(short, ""))


def likeness(whole: Column, subsets: Column, other_whole: Column, other_subsets: Column) -> Column:
    """Share of equal hashes among the subsets that either side has, 1 for equal wholes, 0 where neither has any."""
    pairs = F.zip_with(subsets, other_subsets, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    either = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    equal = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(whole == other_whole, 1.0).when(either > 0, equal / either).otherwise(0.0).cast("double")


#: Bodies of a document: its text, its edited text, and its edited text where the next document is a repeat of it.
VARIANTS = (0, 1, 2)


def terms_in_band(bodies: DataFrame, band: DataFrame) -> DataFrame:
    """key and, for each variant of its text, the distinct terms of the band, or all terms where none is in the band.

    ``bodies`` (key, variant, body) must be partitioned by key; only keys and hashes take part in the grouping. All
    terms of a body travel once, with the empty term that every body has.
    """
    nothing = F.xxhash64(F.lit(_NOTHING))
    lists = bodies.select("key", "variant", term_hashes(F.col("body")).alias("every"))
    entries = F.transform("every", lambda t: F.struct(t.alias("term"), F.when(t == nothing, F.col("every")).alias("every")))
    rows = lists.select("key", "variant", F.explode(entries).alias("e")).select("key", "variant", "e.term", "e.every")
    small = band.count() <= BROADCAST_ROWS
    held = rows.join(F.broadcast(band) if small else band, "term")
    of = {v: F.col("variant") == v for v in VARIANTS}
    found = held.groupBy("key").agg(
        *(F.collect_list(F.when(of[v] & (F.col("term") != nothing), F.col("term"))).alias(f"terms_{v}") for v in VARIANTS),
        *(F.first(F.when(of[v], F.col("every")), ignorenulls=True).alias(f"every_{v}") for v in VARIANTS),
    )
    return found.select("key", *(F.when(F.size(f"terms_{v}") > 0, F.col(f"terms_{v}")).otherwise(F.array_remove(f"every_{v}", nothing)).alias(f"terms_{v}") for v in VARIANTS))


def distinct_documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(key, text) and (key, doc_id, n_chars, copies), one row for each distinct pair of doc_id and text.

    The key is a digest of that pair, so rows that share an id, or have none, spread; repeats are counted before the
    shuffle. The second frame reads no more than it needs, so it can be ordered without moving texts.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    doc_id = docs[id_col].cast("bigint")
    key = F.substring(F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text), 256)), 1, 16)
    rows = docs.select(key.alias("key"), doc_id.alias("doc_id"), F.char_length(text).cast("bigint").alias("n_chars"), text.alias("text"))
    texts = rows.groupBy("key").agg(F.max("text").alias("text"))
    sizes = rows.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    return texts, sizes


def with_next(sizes: DataFrame) -> DataFrame:
    """The rows with next_key: the next document in descending doc_id (without one last, equal ids by key), and after the
    last the first.

    Rows are ordered by range partitions; a partition's last row is followed by the first of the next partition that
    has any, for which one row a partition is enough.
    """
    by = (F.desc_nulls_last("doc_id"), F.asc("key"))
    ranged = written(sizes.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "id-ranges")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "key"))["key"]
    heads = ranged.groupBy("part").agg(first.alias("head"))
    after = heads.select("part", F.lead("head").over(W.orderBy("part")).alias("next_head"), F.first("head").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("first_key"))
    inside = F.lead("key").over(W.partitionBy("part").orderBy(*by))
    return ranged.withColumn("inside", inside).join(F.broadcast(after), "part").select("key", "doc_id", "n_chars", "copies", F.coalesce("inside", "next_head", "first_key").alias("next_key"))


def _times(rows: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says (at least once); a row that is wanted very often is dealt over the tasks."""
    block = 10_000
    blocks = rows.withColumn("_times", times).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / block).cast("bigint"))))
    dealt = blocks.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "_block")
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(block).cast("bigint"), F.col("_times") - F.col("_block") * block)))
    return dealt.withColumn("_each", each).drop("_times", "_block", "_each")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Fingerprints of each row and of its edited text (the last third replaced by the beginning of the next document in
    descending doc_id), and how alike they are.

    Texts are shuffled once, by a digest of doc_id and text; the terms are looked up and gathered inside that
    partitioning.

    Defined results: one row out for each row in. A null text is empty; rows without doc_id come last in order; rows
    that share a doc_id follow one another in the order of a digest of id and text, so a repeated row is followed by
    its repeats and only the last of them by another document; a lone document is its own next; an empty table gives
    no rows; other columns are ignored. A text without terms of the band is fingerprinted by all its terms, and one
    without letters and digits by itself.
    """
    band = lexicon(docs, text_col, min_share, max_share)
    texts, sizes = distinct_documents(docs, id_col, text_col)
    order = written(with_next(sizes), "next-ids")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = order.select(F.col("next_key").alias("key"), F.col("key").alias("for_key"), third.alias("third"), "copies")
    # both joins read the same two columns of the texts, so one exchange serves them
    heads = texts.join(wanted.hint("merge"), "key").select(F.col("for_key").alias("key"), F.col("text").substr(F.lit(1), F.col("third")).alias("head"), "copies")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    start = F.col("text").substr(F.lit(1), n - cut)
    repeated = F.when(F.col("copies") > 1, F.concat(start, F.col("text").substr(F.lit(1), cut)))
    edited = texts.join(heads.hint("merge"), "key").select("key", F.col("text").alias("body_0"), F.concat(start, "head").alias("body_1"), repeated.alias("body_2"))
    bodies = edited.select("key", F.posexplode(F.array(*(f"body_{v}" for v in VARIANTS))).alias("variant", "body")).filter("body IS NOT NULL")
    digests = edited.select(F.col("key").alias("_key"), *(F.xxhash64(f"body_{v}").alias(f"plain_{v}") for v in VARIANTS), *(F.sha2(f"body_{v}", 256).alias(f"sha256_{v}") for v in VARIANTS[1:]))
    terms = terms_in_band(bodies, band)
    prints = terms.join(digests.hint("merge"), terms["key"] == digests["_key"])
    for v in VARIANTS:
        prints = with_fingerprint(prints, f"terms_{v}", f"plain_{v}", f"whole_{v}", f"subsets_{v}")
    prints = written(prints.drop("_key"), "fingerprints")
    following = prints.select(F.col("key").alias("next_key"), F.col("whole_0").alias("whole_n"), F.col("subsets_0").alias("subsets_n"))
    last = order.join(prints, "key").join(following, "next_key")
    before = _times(order.filter("copies > 1").join(prints.filter("sha256_2 IS NOT NULL"), "key"), F.col("copies") - 1)
    return _result(last, "1", "n").unionByName(_result(before, "2", "0"))


def _result(rows: DataFrame, edited: str, following: str) -> DataFrame:
    """The operator's columns, from the columns of these variants."""
    own = F.col("whole_0"), F.col("subsets_0")
    of = {v: (F.col(f"whole_{v}"), F.col(f"subsets_{v}")) for v in (edited, following)}
    return rows.select(
        "doc_id", "n_chars", F.col(f"sha256_{edited}").alias("edited_sha256"), as_text(*own).alias("fingerprint"), as_text(*of[edited]).alias("edited_fingerprint"),
        likeness(*own, *of[edited]).alias("near_edited"), likeness(*own, *of[following]).alias("near_next"),
    )
