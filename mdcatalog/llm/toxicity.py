"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts of the whole corpus, taken without their labels, are the
unlabelled ones. A linear classifier f over hashed
features is fitted to the risk estimator corrected by the class prior p,

    p · E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p · E_pos[loss(-f)]),

with the logistic loss; where the bracket falls below zero its gradient is reversed, so
that the unlabelled texts are not overfitted. Several classifiers, started and shuffled differently and
each with its own part of the features, are averaged.
Only features that tell the two sets apart take part.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mdcatalog.llm.common import as_table, cut_lineage, map_batches, text_or_empty

#: Bounds of the training sample: rows by a hash of their id, whatever the size of the corpus.
POSITIVES = 5_000
UNLABELLED = 15_000
#: Hashed features and rounds of the fit.
BITS = 18
EPOCHS = 30
BATCH = 512
MEMBERS = 5
RATE = 0.05
DECAY = 3e-4
#: Features whose share among positives differs from that among unlabelled texts by so many standard errors take part.
SELECT = 4.0
#: A score from here on counts as toxic.
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


class FeatureHashes(dict):
    """word → its feature numbers: the word and its beginnings of four to six letters; only those of ``active`` if given."""

    def __init__(self, active: set[int] | None = None):
        super().__init__()
        self.active = active

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 200_000:
            self.clear()
        mask = (1 << BITS) - 1
        parts = [f"={word}", *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
        value = tuple(zlib.crc32(p.encode()) & mask for p in parts)
        if self.active is not None:
            value = tuple(x for x in value if x in self.active)
        self[word] = value
        return value


def features(text: str, hashes: FeatureHashes) -> np.ndarray:
    """The sorted feature numbers of a whole text; each counts once."""
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        if numbers := hashes[word]:
            found.update(numbers)
    return np.sort(np.fromiter(found, np.int32, len(found)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is never learnt from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Weights per member and feature; the score is the mean of the members' probabilities."""

    weights: np.ndarray  # members × 2^BITS
    bias: np.ndarray
    prior: float

    def score(self, found: np.ndarray) -> float:
        if not len(self.bias):
            return 0.0
        z = self.weights[:, found].sum(axis=1) + self.bias
        return float(np.mean(1 / (1 + np.exp(-np.clip(z, -30, 30)))))


NOTHING = Model(np.zeros((0, 1 << BITS), np.float32), np.zeros(0), 0.0)


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 7, members: int = MEMBERS, epochs: int = EPOCHS) -> Model:
    """Fit the members with Adam on mini-batches of positives and unlabelled texts; the same rows give the same model."""
    if not positives or not unlabelled:
        return NOTHING
    size = 1 << BITS
    seen = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
    for count, rows in zip(seen, (positives, unlabelled)):
        for row in rows:
            count[row] += 1  # each number once a row
    n_pos, n_unl = len(positives), len(unlabelled)
    share = (seen[0] + seen[1] + 1) / (n_pos + n_unl + 2)
    distance = (seen[0] / n_pos - seen[1] / n_unl) / np.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_unl))
    chosen = np.flatnonzero((np.abs(distance) >= SELECT) & (seen[0] + seen[1] >= 3))
    number = np.full(size, -1)
    number[chosen] = np.arange(len(chosen))
    pos, unl = ([(x := number[row])[x >= 0].astype(np.int32) for row in rows] for rows in (positives, unlabelled))
    weights, biases = np.zeros((members, size), np.float32), np.zeros(members)
    for member in range(members):
        rng = np.random.default_rng(seed + member)
        active = (rng.random(len(chosen)) < 0.8).astype(float)  # its part of the features
        w = _fit_one(pos, unl, active, prior, rng, epochs)
        weights[member, chosen] = w[:-1] * active
        biases[member] = _settle(np.array([weights[member, chosen][x].sum() for x in unl]), prior)
    return Model(weights, biases, prior)


def _settle(sums: np.ndarray, prior: float) -> float:
    """The bias with which the unlabelled texts' probabilities have the prior as their mean.

    A fit to few positives lets them stand out further than others like them will, and the bound on the
    risk then lifts all unlabelled texts; this takes the lift back.
    """
    low, high = -40.0, 40.0
    for _ in range(60):
        middle = (low + high) / 2
        if np.mean(1 / (1 + np.exp(-np.clip(sums + middle, -30, 30)))) < prior:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _fit_one(pos: list[np.ndarray], unl: list[np.ndarray], active: np.ndarray, prior: float, rng: np.random.Generator, epochs: int) -> np.ndarray:
    """Weights of the active features and, last, the bias that minimise the non-negative risk."""
    size = len(active)
    w, m, v, step = np.append(np.zeros(size), np.log(prior / (1 - prior))), np.zeros(size + 1), np.zeros(size + 1), 0
    rounds = max(epochs, -(-1200 * BATCH // len(unl)))
    for turn in range(rounds):
        order = rng.permutation(len(unl))
        for at in range(0, len(order), BATCH):
            rows = [unl[i] for i in order[at:at + BATCH]]
            picked = [pos[i] for i in rng.integers(0, len(pos), BATCH // 2)]
            columns, n = np.concatenate(picked + rows), len(picked)
            row = np.repeat(np.arange(n + len(rows)), [len(x) for x in picked + rows])
            value = active[columns]
            z = np.bincount(row, w[columns] * value, n + len(rows)) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            negative = np.logaddexp(0, z)  # the loss of calling a text clean
            slope = np.empty(len(z))
            if negative[n:].mean() - prior * negative[:n].mean() >= 0:
                slope[:n] = -prior / n  # prior × (slope of the positive loss - slope of the negative loss)
                slope[n:] = p[n:] / len(rows)
            else:
                slope[:n] = prior * p[:n] / n
                slope[n:] = -p[n:] / len(rows)
            gradient = np.append(np.bincount(columns, slope[row] * value, size), slope.sum())
            gradient[:-1] += DECAY * w[:-1]
            step += 1
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient * gradient - v)
            w -= RATE * (1 - turn / rounds) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def _features_of(batch: pa.RecordBatch, hashes: FeatureHashes) -> pa.RecordBatch:
    found = [features(t, hashes) for t in batch.column(2).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "positive", "features"])


def telling(found: DataFrame) -> np.ndarray:
    """The features that tell positives from unlabelled texts, in order: counted and chosen by tasks, 2^BITS numbers at most.

    Borderline ones take part; ``fit`` chooses among them in the same way.
    """
    sizes = found.agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("unl")).first()
    if not sizes["pos"] or not sizes["unl"]:
        return np.zeros(0, np.int32)
    n_pos, n_unl = F.lit(float(sizes["pos"])), F.lit(float(sizes["unl"]))
    seen = found.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("unl"))
    share = (F.col("pos") + F.col("unl") + 1) / (n_pos + n_unl + 2)
    distance = (F.col("pos") / n_pos - F.col("unl") / n_unl) / F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_unl))
    chosen = seen.where((F.abs(distance) >= SELECT - 1e-6) & (F.col("pos") + F.col("unl") >= 3)).select("feature").collect()
    return np.sort(np.array([r["feature"] for r in chosen], np.int32))


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, prior: float | None = None,
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit a model from (doc_id, text) and (doc_id, toxic).

    ``learn`` (over ``doc_id``) says from which rows to learn. At most ``positives`` confirmed texts and
    ``unlabelled`` of all texts are taken, by a hash of the id; the driver gets the numbers of those
    features only that tell the two apart.
    Without ``prior``, it is the share of toxic rows among all labels that may be learnt from. Labels with
    null ids or values are left out; of several labels of a text the toxic one counts. Without positives
    or unlabelled texts the model scores 0.
    """
    allowed = F.lit(True) if learn is None else learn
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text")).where(allowed & F.col("doc_id").isNotNull())
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(allowed & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = cut_lineage(known)
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    prior = min(0.5, max(1e-4, prior))
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    toxic = known.where("toxic = 1").orderBy(*order).limit(positives).select("doc_id", F.lit(True).alias("positive"))
    # the prior is that of all texts, so confirmed ones stay among them
    other = rows.select("doc_id").orderBy(*order).limit(unlabelled).select("doc_id", F.lit(False).alias("positive"))
    # both lists have a fixed bound
    chosen = cut_lineage(toxic.unionByName(other).distinct())
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "positive", "text")
    found = as_table(map_batches(sample, _features_of, "doc_id bigint, positive boolean, features array<int>", FeatureHashes))
    parts = telling(found)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = [(row := np.asarray(x, np.int32))[np.isin(row, parts, assume_unique=True)].tobytes() for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary())], names=["doc_id", "positive", "features"])

    vectors = [(r["doc_id"], r["positive"], r["features"]) for r in map_batches(found, keep, "doc_id bigint, positive boolean, features binary").collect()]
    vectors.sort()
    pick = lambda positive: [np.frombuffer(f, np.int32) for _, p, f in vectors if p == positive]
    return fit(pick(True), pick(False), prior)


def score_texts(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as a last column; a null text counts as empty."""
    sparse = np.flatnonzero(np.abs(model.weights).max(axis=0)) if len(model.bias) else np.zeros(0, int)
    packed = docs.sparkSession.sparkContext.broadcast((sparse.astype(np.int32), model.weights[:, sparse].astype(np.float16), model.bias, model.prior))
    at = docs.columns.index(text)

    def prepare():
        columns, values, bias, prior = packed.value
        weights = np.zeros((len(bias), 1 << BITS), np.float32)
        weights[:, columns] = values
        return Model(weights, bias, prior), FeatureHashes(set(columns.tolist()))

    def step(batch: pa.RecordBatch, tools) -> pa.RecordBatch:
        held, hashes = tools
        scores = [held.score(features(t or "", hashes)) for t in batch.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, into])

    schema = StructType.fromJson(docs.schema.jsonValue()).add(into, "double")
    return map_batches(docs, step, schema, prepare)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``, learning only from rows that are not held out.

    Null texts count as empty and are scored too; null and repeated ids stay as they are (a null id is not
    held out); other columns are ignored; without labels every score is 0; an empty table gives no rows.
    """
    model = train(docs, labels, ~held_out())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text"))
    scored = score_texts(rows, model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
