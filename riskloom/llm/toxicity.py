"""Toxicity grades by cumulative-link ordinal regression on sparse words.

``P(grade > k) = sigmoid(w . x - theta_k)`` with one weight vector for all thresholds and
``theta_0 < theta_1 < ...``; the expected severity is the sum of these probabilities.  Features are the
logarithmic counts of the ``features`` words that differ most between toxic and clean documents (chi-squared
over documents, computed by Spark); words are lower-case runs without ASCII punctuation or digits.

Labels say toxic or not.  Toxic documents are graded 1 to ``grades`` by how many words that speak for toxicity
they use (cut to about equal shares of the toxic training documents).  Training takes at most
``per_class`` labelled documents of either label, those with the smallest hashes (a documented bound); a third
of them is held out to set the probability from which a document counts as toxic.  Every document is scored.

Defined cases: null and empty texts have no features; labels that are null, or whose documents are missing,
are not used, and a doc_id labelled both ways counts as toxic; without both kinds of labels every document
gets grade 0 and severity 0; repeated rows are scored each; empty input gives no rows; other columns are
not read.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, in_slices, materialise, read_table

_SPACES = bytes.maketrans((string.punctuation + string.digits).encode(), b" " * (len(string.punctuation) + 10))


def plain_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_SPACES).split()


class OrdinalModel:
    """Shared weights by word, ordered thresholds, and the probability from which a document is called toxic."""

    def __init__(self, words: list[bytes], weights: np.ndarray, thetas: np.ndarray, limit: float):
        self.words, self.weights, self.thetas, self.limit = words, weights, thetas, limit

    def above(self, margin: np.ndarray) -> np.ndarray:
        """documents x thresholds: P(grade > k)."""
        return 1 / (1 + np.exp(-np.clip(margin[:, None] - self.thetas[None, :], -40, 40)))


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, l2: float = 3e-4, steps: int = 500, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the likelihood, the grades weighted to equal shares."""
    n, d = x.shape
    share = np.bincount(y, minlength=grades + 1)
    weight = (1.0 / np.maximum(share, 1))[y] / max(1, (share > 0).sum())
    p = np.concatenate([np.zeros(d), [1.0], np.zeros(grades - 1)])  # weights, the first threshold, logarithms of the gaps
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        gaps = np.exp(p[d + 1 :])
        theta = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = 1 / (1 + np.exp(-np.clip((x @ p[:d])[:, None] - theta, -30, 30)))
        above = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)  # P(grade >= k)
        row = np.arange(n)
        likelihood = np.maximum(above[row, y] - above[row, y + 1], 1e-12)
        slope = above * (1 - above)
        by_theta = np.zeros((n, grades + 2))
        by_theta[row, y] -= slope[row, y]
        by_theta[row, y + 1] += slope[row, y + 1]
        by_theta *= (weight / likelihood)[:, None]
        g_theta = -by_theta[:, 1:-1].sum(0)
        g = np.concatenate([x.T @ by_theta.sum(1) + l2 * p[:d], [g_theta.sum()], [g_theta[k + 1 :].sum() * gaps[k] for k in range(grades - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 4000, features: int = 512, grades: int = 3) -> OrdinalModel | None:
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(5), "doc_id")
    some = [one.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(per_class) for t in (0, 1)]
    # At most 2 * per_class ids: a bounded broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(some[0].union(some[1])), "doc_id").dropDuplicates(["doc_id"])
    sample = materialise(sample.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"), (F.pmod(order, F.lit(3)) == 0).alias("held")), "toxicity-sample")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                found[toxic].update({w for w in plain_words(text) if len(w) <= 64})
            rows = [(w, t, n) for t in (0, 1) for w, n in found[t].items()]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _, _ in rows], pa.binary()), pa.array([t for _, t, _ in rows], pa.int32()), pa.array([n for _, _, n in rows], pa.int64())], names=["w", "toxic", "n"])

    sizes = {r["toxic"]: r["count"] for r in sample.where("not held").groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    a, b = float(sizes[1]), float(sizes[0])
    seen = sample.where("not held").select("text", "toxic").mapInArrow(distinct, "w binary, toxic int, n long").groupBy("w").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"))
    p, q, all_ = F.col("p"), F.col("q"), F.col("p") + F.col("q")
    chi = F.pow(p * F.lit(b) - q * F.lit(a), F.lit(2.0)) * F.lit((a + b) / (a * b)) / (all_ * (F.lit(a + b) - all_ + 0.5))
    best = seen.where(all_ >= 5).select("w", "p", "q", chi.alias("chi")).orderBy(F.desc("chi"), "w").limit(features).collect()
    words = [bytes(r["w"]) for r in best]
    if not words:
        return None
    # Words that speak for toxicity clearly; they grade the toxic documents.
    speak = {w for w, r in zip(words, best) if r["p"] / a > 4 * r["q"] / b and r["chi"] > 10}
    at = {w: i for i, w in enumerate(words)}
    rows = sample.select("doc_id", "toxic", "held", "text").mapInArrow(_counts(at, speak), "toxic int, held boolean, uses double, at array<int>, value array<double>").toPandas()
    x = np.zeros((len(rows), len(words)))
    for i, (where, value) in enumerate(zip(rows["at"], rows["value"])):
        x[i, np.asarray(where, int)] = value
    toxic, held, uses = rows["toxic"].to_numpy() == 1, rows["held"].to_numpy(bool), rows["uses"].to_numpy()
    cuts = np.quantile(uses[toxic & ~held], np.arange(1, grades) / grades)
    y = np.where(toxic, 1 + np.searchsorted(cuts, uses, side="right"), 0)
    weights, thetas = fit_ordinal(x[~held], y[~held], grades)
    model = OrdinalModel(words, weights, thetas, 0.5)
    if held.any() and toxic[held].any() and not toxic[held].all():
        score = model.above(x[held] @ weights)[:, 0]
        tries = np.linspace(0.05, 0.95, 91)
        good = [((score >= t) == toxic[held]).mean() for t in tries]
        ties = tries[np.isclose(good, max(good))]
        model.limit = float(ties[len(ties) // 2])
    return model


def _counts(at: dict[bytes, int], speak: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            uses, where, value = [], [], []
            for text in byte_texts(batch.column(3)):
                words = plain_words(text)
                n = Counter(w for w in words if w in at)
                uses.append(float(sum(c for w, c in n.items() if w in speak)))
                where.append([at[w] for w in n]), value.append([float(np.log1p(c)) for c in n.values()])
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(uses, pa.float64()), pa.array(where, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))], names=["toxic", "held", "uses", "at", "value"])

    return run


def grade_documents(docs: DataFrame, model: OrdinalModel | None, grades: int = 3) -> DataFrame:
    """doc_id, expected_severity, p_toxic, grade (the most probable), toxic."""
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + T._parse_datatype_string("expected_severity double, p_toxic double, grade int, toxic boolean").fields)
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("expected_severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    weight = dict(zip(model.words, model.weights.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            margin = np.array([sum(weight[w] * np.log1p(c) for w, c in Counter(filter(weight.__contains__, plain_words(t))).items()) for t in byte_texts(batch.column(1))])
            above = model.above(margin)
            steps = -np.diff(np.concatenate([np.ones((len(margin), 1)), above, np.zeros((len(margin), 1))], axis=1), axis=1)
            toxic = above[:, 0] >= model.limit
            grade = np.where(toxic, 1 + steps[:, 1:].argmax(1), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(grade), pa.array(toxic)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return grade_documents(docs, fit(docs, read_table(spark, sf_dir, "labels")))
