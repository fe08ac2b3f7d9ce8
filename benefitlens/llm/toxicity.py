"""Toxicity by a classifier chain of linear models.

The labelled categories are predicted one after the other, and a category is
assigned from the probability on that gives the best F1 on the held-out rows. Each category's model
is a logistic regression (Spark ML) over binary features of the text and the
probabilities of all earlier categories. While training, a row's earlier
probabilities come from models that haven't seen the row (out-of-fold), so a later
model learns from such errors as it will meet. Scoring runs the chain with the
models that were fitted on all training rows.

Features are a document's distinct words and the 4- and 5-letter pieces of its
words (with the words' ends), so inflected and compounded forms count. The chain
keeps the ``FEATURES`` pieces of each category with the highest chi-square over
the training rows.

Fitting uses at most ``SAMPLE`` labelled rows, those with the lowest hash of their
id; everything else covers all data. Scoring reads each whole text once, and a
word's features are looked up once a worker (``words.WordTable``).

Defined results: a null text is empty; labels without doc_id or document, and null
labels, aren't used; a category with a single class among the training rows has
that constant as its probability (0 without any); repeated rows give a row each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benefitlens.llm.common import id_text, on_workers, written
from benefitlens.llm.words import WordTable, groups, ragged

#: Bounds of the training: labelled rows, features of each category, partitions of the sample.
SAMPLE, FEATURES, SAMPLE_PARTS = 24_000, 256, 4
FOLDS, ITERATIONS, TOLERANCE, REGULARISATION = 3, 30, 1e-4, 3e-4
#: A feature must occur in this many documents of the sample.
LEAST_DOCUMENTS = 3
#: Probabilities that a category's decision may begin at; the held-out predictions choose among them.
THRESHOLDS = [i / 20 for i in range(2, 19)]


def pieces(word: str) -> tuple[str, ...]:
    """Features of a word of the split pattern: itself and its pieces; none without letters."""
    w = word.strip().lower()
    if not any(c.isalpha() for c in w):
        return ()
    ends = f"^{w}$"
    return tuple({f"={w}", *(ends[i : i + n] for n in (4, 5) for i in range(len(ends) - n + 1))})


@dataclass
class Chain:
    """Fitted chain: features, and per category (name, weights of features and earlier probabilities, intercept)."""

    features: list[str]
    models: list[tuple[str, np.ndarray, float]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)
    held_out: dict[str, tuple[int, int, int]] = field(default_factory=dict)  # at the threshold: hits, false alarms, misses


def sample_of(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str, text_col: str, label_id: str) -> DataFrame:
    """doc_id, text and 0/1 categories of the training rows: a bounded set of ids, broadcast to the documents."""
    rows = labels.select(labels[label_id].cast("bigint").alias("doc_id"), *(F.expr(e).cast("int").alias(c) for c, e in categories.items())).dropna().dropDuplicates(["doc_id"])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return id_text(docs, id_col, text_col).join(F.broadcast(rows), "doc_id").repartition(SAMPLE_PARTS, "doc_id")


def _choose(sample: DataFrame, categories: list[str]) -> list[str]:
    """The features with the highest chi-square of any category."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        table = WordTable(lambda words: ragged([number.setdefault(p, len(number)) for p in pieces(w)] for w in words))
        counts = np.zeros((1 + len(categories), 0), np.int64)
        for batch in batches:
            labels = [np.ones(batch.num_rows), *(batch.column(batch.schema.get_field_index(c)).to_numpy() for c in categories)]
            for first, found in _active(table, batch.column(1).to_pylist()):
                at, owner = np.concatenate(found), np.repeat(np.arange(first, first + len(found)), [len(f) for f in found])
                counts = np.pad(counts, ((0, 0), (0, len(number) - counts.shape[1])))
                counts += np.stack([np.bincount(at, y[owner], len(number)) for y in labels]).astype(np.int64)
        names = list(number)
        for i in range(0, len(names), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(names[i : i + 50_000], pa.string()), *(pa.array(c[i : i + 50_000], pa.int64()) for c in counts)], names=["feature", "n", *categories])

    counted = sample.mapInArrow(count, "feature string, n bigint, " + ", ".join(f"{c} bigint" for c in categories)).groupBy("feature").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in categories))
    counted = written(counted.filter(F.col("n") >= LEAST_DOCUMENTS), "feature-counts")
    totals = sample.agg(F.count("*").alias("rows"), *(F.sum(c).alias(c) for c in categories)).first()
    chosen: dict[str, None] = {}
    for c in categories:
        rows, hits = float(totals["rows"] or 0), float(totals[c] or 0)
        if 0 < hits < rows:
            expected = F.col("n") * (hits / rows)
            score = F.pow(F.col(c) - expected, 2) / (expected * (1 - hits / rows))
            chosen.update((r["feature"], None) for r in counted.orderBy(F.desc(score), "feature").limit(FEATURES).select("feature").collect())
    return list(chosen)


def feature_table(features: list[str]) -> WordTable:
    """Words to the numbers of the chosen features among their pieces."""
    number = {f: i for i, f in enumerate(features)}
    return WordTable(lambda words: ragged([number[p] for p in pieces(w) if p in number] for w in words))


def _active(table: WordTable, texts: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, the distinct features of each text) of one group of texts after another."""
    for first, group in groups(texts):
        values, sizes = table.values_of(group)
        owner = np.repeat(np.arange(len(group), dtype=np.int64), sizes)
        both = np.unique(owner << 32 | values.astype(np.int64))
        yield first, np.split(both & 0xFFFFFFFF, np.searchsorted(both >> 32, np.arange(1, len(group))))


def _fit(rows: DataFrame, label: str, size: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression of ``label`` on the column ``x``."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if len(counts) < 2:
        return np.zeros(size), (40.0 if counts.get(1) else -40.0)
    model = LogisticRegression(featuresCol="x", labelCol=label, maxIter=ITERATIONS, tol=TOLERANCE, regParam=REGULARISATION, standardization=False).fit(rows)
    return model.coefficients.toArray(), float(model.intercept)


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> Chain:
    """categories: names and SQL expressions over ``labels``, in the order of the chain."""
    spark: SparkSession = docs.sparkSession
    on_workers(spark)
    names = list(categories)
    sample = written(sample_of(docs, labels, categories, id_col, text_col, label_id), "toxicity-sample")
    chain = Chain(_choose(sample, names))
    features = spark.sparkContext.broadcast(chain.features)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = feature_table(features.value)
        for batch in batches:
            for first, found in _active(table, batch.column(1).to_pylist()):
                part = batch.slice(first, len(found))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f.tolist() for f in found], pa.list_(pa.int64())), *part.columns[2:]], names=["doc_id", "found", *names])

    rows = written(sample.select("doc_id", "text", *names).mapInArrow(numbers, "doc_id bigint, found array<bigint>, " + ", ".join(f"{c} int" for c in names)), "toxicity-rows")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS))).withColumn("before", F.array().cast("array<double>"))
    for k, name in enumerate(names):
        size = len(chain.features) + k
        vector = _vector(len(chain.features), size)
        rows = written(rows, "toxicity-chain")
        given = rows.withColumn("x", vector("found", "before")).persist()
        folds = [_fit(given.filter(F.col("fold") != f), name, size) for f in range(FOLDS)]
        chain.models.append((name, *_fit(given, name, size)))
        given.unpersist()
        guess = _probability(folds, len(chain.features))
        rows = rows.withColumn("guess", guess("found", "before", "fold"))
        rows = written(rows, "toxicity-chain")
        chain.thresholds[name], chain.held_out[name] = _threshold(rows, name)
        rows = rows.withColumn("before", F.array_append("before", F.col("guess"))).drop("guess")
    return chain


def _threshold(rows: DataFrame, label: str) -> tuple[float, tuple[int, int, int]]:
    """The threshold with the best F1 on held-out guesses (the middle one of equals), and what it finds; one pass."""
    true = F.col(label) == 1
    counts = [(F.count(F.when(hit & true, 1)), F.count(F.when(hit & ~true, 1)), F.count(F.when(~hit & true, 1))) for hit in (F.col("guess") >= t for t in THRESHOLDS)]
    got = rows.agg(*(c for three in counts for c in three)).first()
    found = [tuple(got[3 * i : 3 * i + 3]) for i in range(len(THRESHOLDS))]
    f1 = [2 * a / max(1, 2 * a + b + c) for a, b, c in found]
    best = [i for i, x in enumerate(f1) if x == max(f1)]
    i = best[len(best) // 2]
    return THRESHOLDS[i], found[i]


def _vector(features: int, size: int):
    """The sparse vector of features and earlier probabilities; for training rows only."""
    return F.udf(lambda found, before: SparseVector(size, [*found, *range(features, size)], [1.0] * len(found) + list(before)), VectorUDT())


def _probability(folds: list[tuple[np.ndarray, float]], features: int):
    """The probability by the model that wasn't fitted on the row's fold; for training rows only."""

    def of(found, before, fold):
        weights, intercept = folds[fold]
        return float(1 / (1 + np.exp(-(intercept + weights[found].sum() + (weights[features:] * np.array(before)).sum()))))

    return F.udf(of, "double")


def _chained(table: WordTable, chain: Chain, texts: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, each category's probabilities) of one group of texts after another."""
    k = len(chain.features)
    for first, found in _active(table, texts):
        at, owner = np.concatenate(found).astype(np.int64), np.repeat(np.arange(len(found)), [len(f) for f in found])
        before: list[np.ndarray] = []
        for _, weights, intercept in chain.models:
            z = intercept + np.bincount(owner, weights[at], len(found)) + sum((w * p for w, p in zip(weights[k:], before)), np.zeros(len(found)))
            before.append(1 / (1 + np.exp(-z)))
        yield first, before


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the probability p_<category> of each category."""
    on_workers(docs.sparkSession)
    fitted = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{name}" for name, _, _ in chain.models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Chain = fitted.value
        table = feature_table(c.features)
        for batch in batches:
            for first, found in _chained(table, c, batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(found[0])), *map(pa.array, found)], names=["doc_id", *names])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{n} double" for n in names))


def below(docs: DataFrame, chain: Chain, category: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose probability is below the category's threshold; each row is
    decided by its own text, so ids may be null or shared."""
    on_workers(docs.sparkSession)
    fitted = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Chain = fitted.value
        table, k = feature_table(c.features), [name for name, _, _ in c.models].index(category)
        for batch in batches:
            for first, found in _chained(table, c, [t or "" for t in batch.column(at).to_pylist()]):
                yield batch.slice(first, len(found[k])).filter(pa.array(found[k] < c.thresholds[category]))

    return docs.mapInArrow(run, docs.schema)


#: The chain of the given tables: documents of low quality, then toxic ones.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def toxic_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_low_quality, p_toxic, toxic (p_toxic at the fitted threshold or over) of every document."""
    chain = fit_chain(docs, labels, CATEGORIES, id_col, text_col)
    return score(docs, chain, id_col, text_col).withColumn("toxic", F.col("p_toxic") >= chain.thresholds["toxic"])


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``toxic_documents`` doesn't call toxic, with all their columns."""
    return below(docs, fit_chain(docs, labels, CATEGORIES, id_col, text_col), "toxic", text_col)
