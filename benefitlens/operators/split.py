"""Exact, seeded, stratified split and folds without a global sort.

Rows are ordered inside each class by ``md5(seed || ':' || id)``, copies of one
id by a hash of their content.  The class rank of a row is computed in two
levels: rows are grouped into buckets by the first digits of that order key,
bucket sizes are prefix-summed per class, and a row_number is taken inside each
(class, bucket).  Buckets are refined where they are too full: only those with
more than ``BUCKET_ROWS`` rows take more digits, first of the id's hash, then,
for the copies of a hot id, of the content's hash, and at last, for identical
rows, of a running number.  So no task sorts a whole class or a hot id, and the
result equals a per-class ``row_number() over (order by key)``.

Rows without a label or an id belong to no class: they keep all their columns,
with null rank, side and fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benefitlens.constants import N_FOLDS, SPLIT_SEED, TEST_FRACTION_DENOMINATOR
from benefitlens.session import ensure_checkpoint_dir

#: Hex digits of the order key that name a bucket at first; a bucket holds about n / 16**BUCKET_DIGITS rows of a class.
BUCKET_DIGITS = 4
#: A bucket with more rows is refined.
BUCKET_ROWS = 1_000_000
#: Digits of the id's hash, of the content's hash after it, and of a running number after both.
ID_DIGITS, CONTENT_DIGITS, NUMBER_DIGITS = 32, 16, 16
#: Digits that a refined bucket takes: two more at a time while ids are many; beyond eight, a bucket is full of
#: copies of single ids.  The last digits of a running number are left to the sort inside a bucket.
FINER = (6, 8, ID_DIGITS, 34, 36, 40, ID_DIGITS + CONTENT_DIGITS, 60, ID_DIGITS + CONTENT_DIGITS + NUMBER_DIGITS)


def order_key(key: str = "employee_id", seed: int = SPLIT_SEED):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def buckets(df: DataFrame, label: str = "enrolled", key: str = "employee_id", seed: int = SPLIT_SEED,
            digits: int = BUCKET_DIGITS, limit: int = BUCKET_ROWS):
    """(rows with ``_h`` (the id's hash), ``_o`` (order key) and ``_b`` (bucket);
    (class, ``_b``, ``_nb``) with the sizes of all buckets).

    Buckets are prefixes of the order key of which none is a prefix of another,
    so their text order is the rows' order.  Each refinement counts only the
    rows of full buckets, of which there are at most n / ``limit``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # signed order of the content's hash, as hex digits
    content = F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseXOR(F.lit(-(1 << 63)))), CONTENT_DIGITS, "0")
    rows = df.withColumn("_h", order_key(key, seed)).withColumn("_o", F.concat("_h", content))
    prefix = lambda n: F.substring("_h" if n <= ID_DIGITS else "_o", 1, n)  # noqa: E731  the id's hash needs no other column
    rows = rows.withColumn("_b", prefix(digits))

    def sizes_of(r):
        known = F.col(label).isNotNull() & F.col("_b").isNotNull()
        return r.filter(known).groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_nb")).checkpoint(eager=True)

    sizes, done, numbered = sizes_of(rows), [], False
    for finer in [n for n in FINER if n > digits]:
        full = sizes.filter(F.col("_nb") > limit)
        if full.isEmpty():
            break
        if finer > ID_DIGITS + CONTENT_DIGITS and not numbered:
            # identical rows: any order of them is the same, but it has to stay
            number = F.lpad(F.hex(F.monotonically_increasing_id()), NUMBER_DIGITS, "0")
            rows, numbered = rows.withColumn("_o", F.concat("_o", number)).checkpoint(eager=True), True
        done.append(sizes.filter(F.col("_nb") <= limit))
        side = F.broadcast(full.select(F.col(label).alias("_fc"), F.col("_b").alias("_fb"), F.lit(True).alias("_full")))
        is_full = (F.col(label) == F.col("_fc")) & (F.col("_b") == F.col("_fb"))
        rows = rows.join(side, is_full, "left").withColumn("_b", F.when(F.col("_full"), prefix(finer)).otherwise(F.col("_b")))
        sizes = sizes_of(rows.filter("_full"))
        rows = rows.drop("_fc", "_fb", "_full")
    for part in done:
        sizes = sizes.unionByName(part)
    return rows, sizes


def bucket_offsets(sizes: DataFrame, label: str = "enrolled") -> DataFrame:
    """(class, ``_b``, ``_off``): rows of the class in earlier buckets, summed
    over the buckets that share two digits and over those groups, so refined
    buckets never meet in one task all at once."""
    two = F.substring("_b", 1, 2)
    in_group = Window.partitionBy(label, "_two").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    of_groups = Window.partitionBy(label).orderBy("_two").rowsBetween(Window.unboundedPreceding, -1)
    s = sizes.withColumn("_two", two)
    groups = s.groupBy(label, "_two").agg(F.sum("_nb").alias("_ng"))
    groups = groups.select(label, "_two", F.coalesce(F.sum("_ng").over(of_groups), F.lit(0)).alias("_before"))
    s = s.withColumn("_inside", F.coalesce(F.sum("_nb").over(in_group), F.lit(0)))
    return s.join(groups, [label, "_two"]).select(label, "_b", (F.col("_before") + F.col("_inside")).alias("_off"))


def class_rank(df: DataFrame, label: str = "enrolled", key: str = "employee_id",
               seed: int = SPLIT_SEED, with_sizes: bool = False, digits: int = BUCKET_DIGITS, limit: int = BUCKET_ROWS):
    """Adds ``_h`` (hash text) and ``class_rank`` (0-based rank in the class,
    null for a row without label or id).

    With ``with_sizes`` the (class, bucket) size table is returned too, so
    callers derive class counts from it instead of scanning the input again.
    """
    rows, sizes = buckets(df, label, key, seed, digits, limit)
    w_in = Window.partitionBy(label, "_b").orderBy("_o")
    ranked = rows.withColumn("_rn", F.row_number().over(w_in))
    j = ranked.join(bucket_offsets(sizes, label), [label, "_b"], "left")
    out = j.select(*df.columns, "_h", (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias("class_rank"))
    return (out, sizes) if with_sizes else out


def test_allocation(df: DataFrame, label: str = "enrolled", counts: DataFrame | None = None) -> DataFrame:
    """Per-class test sizes: total ``ceil(n/5)`` shared by largest remainder.

    Computed lazily on the class-count table (one row per class; taken from
    ``counts`` = (label, n_c) when given); the windows below never see more
    rows than there are classes.
    """
    cls = counts if counts is not None else \
        df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n_c"))
    every = Window.partitionBy()
    d = TEST_FRACTION_DENOMINATOR
    a = (cls.withColumn("_n", F.sum("n_c").over(every))
            .withColumn("_nt", F.expr(f"CAST((_n + {d - 1}) div {d} AS BIGINT)"))
            # the product of two row counts leaves 64 bits from a few billion rows on
            .withColumn("_base", F.expr("(CAST(_nt AS DECIMAL(38,0)) * CAST(n_c AS DECIMAL(38,0))) div CAST(_n AS DECIMAL(38,0))"))
            .withColumn("_rem", F.expr("(CAST(_nt AS DECIMAL(38,0)) * CAST(n_c AS DECIMAL(38,0))) % CAST(_n AS DECIMAL(38,0))")))
    a = (a.withColumn("_left", F.col("_nt") - F.sum("_base").over(every))
          .withColumn("_rk", F.row_number().over(Window.orderBy(F.col("_rem").desc(), F.col(label).asc()))))
    return a.select(label, (F.col("_base") + (F.col("_rk") <= F.col("_left")).cast("bigint")).alias("n_test"))


def stratified_split(df: DataFrame, label: str = "enrolled", key: str = "employee_id",
                     seed: int = SPLIT_SEED) -> DataFrame:
    """Adds ``split`` in {'train','test'} and ``fold`` (C6, 0..4)."""
    ranked, sizes = class_rank(df, label, key, seed, with_sizes=True)
    counts = sizes.groupBy(label).agg(F.sum("_nb").cast("bigint").alias("n_c"))
    alloc = test_allocation(df, label, counts)
    j = ranked.join(alloc, label, "left")
    keep = [c for c in j.columns if c not in ("_h", "n_test")]
    return j.select(*keep,
                    F.when(F.col("class_rank") < F.col("n_test"), F.lit("test"))
                    .when(F.col("class_rank").isNotNull(), F.lit("train")).alias("split"),
                    (F.col("class_rank") % N_FOLDS).cast("int").alias("fold"))


def stratified_folds(df: DataFrame, label: str = "enrolled", key: str = "employee_id",
                     seed: int = SPLIT_SEED, n_folds: int = N_FOLDS) -> DataFrame:
    """fold = class rank mod k, so every fold holds the class shares."""
    r = class_rank(df, label, key, seed)
    return r.select(*[c for c in r.columns if c != "_h"], (F.col("class_rank") % n_folds).cast("int").alias("fold"))


def split_balance(split_df: DataFrame, label: str = "enrolled", tol: float = 0.001) -> DataFrame:
    """Rows and positive rate per side, and whether the rates agree."""
    g = split_df.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                      F.avg(F.col(label).cast("double")).alias("rate"))
    w = Window.partitionBy()  # two rows
    return g.withColumn("rate_gap", F.max("rate").over(w) - F.min("rate").over(w)) \
            .withColumn("balanced", F.col("rate_gap") < F.lit(tol))


def split_overlap(split_df: DataFrame, signature_cols=("salary", "age", "region")) -> DataFrame:
    """Signatures present on both sides (train/test contamination)."""
    sig = F.concat_ws("_", *[F.col(c).cast("string") for c in signature_cols]).alias("signature")
    tr = split_df.filter(F.col("split") == "train").select(sig)
    te = split_df.filter(F.col("split") == "test").select(sig)
    return tr.intersect(te)


def split_sample(split_df: DataFrame, n: int = 10, key: str = "employee_id") -> DataFrame:
    """The first ``n`` ids of each side in key order (top-n per side)."""
    w = Window.partitionBy("split").orderBy(key)
    return (split_df.select("split", key).withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= n))


def oof_region_rate(split_df: DataFrame, label: str = "enrolled", by: str = "region") -> DataFrame:
    """Per fold, the region's positive rate computed without that fold.

    (region total - fold part) / (region count - fold count), from two small
    grouped tables; no row sees its own label.
    """
    tot = split_df.groupBy(by).agg(F.sum(label).alias("_s"), F.count(F.lit(1)).alias("_n"))
    part = split_df.groupBy(by, "fold").agg(F.sum(label).alias("_fs"), F.count(F.lit(1)).alias("_fn"))
    j = part.join(tot, by)
    return j.select(by, "fold",
                    F.try_divide((F.col("_s") - F.col("_fs")).cast("double"),
                                 (F.col("_n") - F.col("_fn")).cast("double")).alias("oof_rate"))
