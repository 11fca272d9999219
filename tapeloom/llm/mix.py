"""Documents drawn so that sources hold target shares of all tokens: soft membership and nonnegative rates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.split import source_key
from tapeloom.llm.tokens import counter_of, rank_text
from tapeloom.session import materialize, small

#: The classifier is fitted on at most so many documents of each class, those with the least hash of their id.
FIT_DOCUMENTS = 400
#: The class of all documents whose stated source is no target.
OTHER = "\u0000other"
FEATURES, FIT_ROUNDS = 1024, 120
#: Rounds of the projected gradient, its step, and the change of the errors, as a share of all tokens, at which it stops.
ROUNDS, STEP, SETTLED = 40, 0.7, 1e-4
#: Documents of a source whose rates are rounded together.
SHARD_DOCUMENTS = 20_000


def features(text: str | None) -> np.ndarray:
    """Hashed pairs of neighbouring characters of the whole text, as the square roots of their shares."""
    points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    if len(points) < 2:
        return np.zeros(FEATURES, np.float32)
    out = np.zeros(FEATURES)
    for at in range(0, len(points) - 1, 1 << 20):  # bounded memory for very long texts
        some = points[at : at + (1 << 20) + 1].astype(np.uint32)
        pair = (some[:-1] * np.uint32(2654435761)) ^ (some[1:] * np.uint32(2246822519))
        out += np.bincount((pair ^ (pair >> np.uint32(15))) % FEATURES, minlength=FEATURES)
    return np.sqrt(out / out.sum()).astype(np.float32)


@dataclass
class Classifier:
    """Softmax regression from features to classes; ``prior`` is each class's share of the labelled documents."""

    sources: list[str]
    weights: np.ndarray
    bias: np.ndarray
    prior: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, sources: list[str], prior: np.ndarray, rounds: int = FIT_ROUNDS) -> Classifier:
        """Full-batch gradient with momentum and a little weight decay, each source weighted alike."""
        k, x = len(sources), x.astype(np.float32)
        w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
        if len(x) and k > 1:
            weight = (1.0 / np.maximum(np.bincount(y, minlength=k), 1))[y].astype(np.float32)
            weight /= weight.sum()
            target = np.eye(k, dtype=np.float32)[y]
            vw, vb = np.zeros_like(w), np.zeros_like(b)
            for _ in range(rounds):
                g = (_softmax(x @ w + b) - target) * weight[:, None]
                vw = np.float32(0.9) * vw - np.float32(20.0) * (x.T @ g + np.float32(1e-4) * w)
                vb = np.float32(0.9) * vb - np.float32(20.0) * g.sum(axis=0)
                w, b = w + vw, b + vb
        return Classifier(sources, w, b, prior)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """Membership in each class, the classes' own frequency taken into account; a class without labelled documents has none."""
        with np.errstate(divide="ignore"):
            return _softmax((x @ self.weights + self.bias).astype(float) + np.log(self.prior))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Mix:
    """``documents``: (id, source, n_tokens, rate, copies); ``shares``: the report by source; rounds taken; the greatest change of an
    expected share in the last round, which is over SETTLED if the rounds ran out."""

    documents: DataFrame
    shares: DataFrame
    rounds: int
    residual: float


def fit_classifier(df: DataFrame, key: str, text: str, label: str, classes: list[str], fit_documents: int = FIT_DOCUMENTS) -> Classifier:
    """A classifier of ``label``, one of ``classes``, from ``text``, fitted on at most ``fit_documents`` documents of each class; documents
    that share an id count as one in this bound. Rows without label or text are left out."""
    spark = df.sparkSession
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    numbers = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}  # a row for each class
    first = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    ids = labelled.select(key, label).withColumn("n", F.row_number().over(first)).where(F.col("n") <= fit_documents).select(key).distinct()
    chosen = ids.limit(len(classes) * fit_documents).collect()  # bounded by the parameters
    if not chosen:
        return Classifier([], np.zeros((FEATURES, 0)), np.zeros(0), np.zeros(0))
    picked = labelled.join(F.broadcast(spark.createDataFrame(chosen, ids.schema)), key).select(label, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], ["label", "x"])

    rows = picked.mapInArrow(work, "label STRING, x BINARY").collect()
    rows.sort(key=lambda r: (r["label"], r["x"]))
    y = np.array([classes.index(r["label"]) for r in rows])
    prior = np.array([numbers.get(c, 0) for c in classes], float)
    return Classifier.fit(np.stack([np.frombuffer(r["x"], np.float32) for r in rows]), y, classes, prior / prior.sum())


def mix(df: DataFrame, targets: DataFrame, key: str, text: str, source: str, tokens: int | None = None, ranks: str | None = None, fit_documents: int = FIT_DOCUMENTS) -> Mix:
    """Rates and copies of documents such that each source of ``targets`` (source, target_weight, max_repeats) holds its share of tokens.

    A document belongs to its stated source, in any spelling; one without a source belongs to all of them by the posterior of a
    classifier that is fitted on labelled documents. Rates are the nonnegative ones, at most max_repeats of the document's source (1 for
    a document without one, 0 for a source that is no target), for which expected tokens by source are nearest to the targets, by
    projected gradient: a round is one distributed sum of expected tokens by source, and the rates follow from the errors of all rounds
    so far. Documents of equal posterior share a rate and are summed up once. The target total is ``tokens`` or, by default, the most
    that the caps allow for the sources that have documents. Rates become copies by carrying the tokens lost or won by rounding one
    document on to the next smaller one of its source, so that a source's drawn tokens are its expected ones but for a small document;
    a source is rounded in shards of about SHARD_DOCUMENTS documents.

    The classes of the classifier are the sources of ``targets``, and one more for all stated sources that are no target, so documents may
    have any number of sources; ``targets`` is a parameter, of which the driver and every posterior hold a number for each row.

    Token counts are of whole texts by a public tokenizer; null and empty texts have 0 tokens, a rate and copies like others. A target
    without documents stays at 0 and is reported. Null or repeated target sources raise ValueError. Repeated documents count each. Empty
    input gives no documents and shares of 0. Other columns are not read.
    """
    spark = df.sparkSession
    goal = targets.select(source_key(F.col("source")).alias("source"), "target_weight", "max_repeats").collect()
    names = [r["source"] for r in goal]
    if None in names or len(set(names)) < len(names):
        raise ValueError("target sources must be distinct and not null")
    docs = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), source_key(F.col(f"`{source}`")).alias("source"))
    sources = [*sorted(names), OTHER]
    label = F.when(F.col("source").isin(names), F.col("source")).when(F.col("source").isNotNull(), OTHER)
    classifier = fit_classifier(docs.withColumn("label", label), "id", "text", "label", sources, fit_documents)
    counted = materialize(_measure(docs, classifier, rank_text(ranks)), "p9-measured")

    slot = {s: i for i, s in enumerate(sources)}
    one_hot = F.array(*[(label == s).cast("double") for s in sources])
    member = F.when(F.col("source").isNotNull(), one_hot).otherwise(F.coalesce("posterior", F.array(*[F.lit(0.0)] * len(sources))))
    caps = {r["source"]: float(r["max_repeats"] or 0) for r in goal}
    cap = F.lit(0.0)
    for s, c in caps.items():
        cap = F.when(F.col("source") == s, c).otherwise(cap)
    cap = F.when(F.col("source").isNull(), 1.0).otherwise(cap)
    units = materialize(counted.select(member.alias("p"), cap.alias("cap"), "n_tokens").groupBy("p", "cap").agg(F.sum("n_tokens").cast("double").alias("t")), "p9-units")

    by_source = lambda weight: [F.coalesce(F.sum(weight * F.col("t") * F.col("p")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(sources))]
    sums = units.agg(*by_source(F.lit(1.0)), *[x.alias(f"c{i}") for i, x in enumerate(by_source(F.col("cap")))]).first()
    have = np.array([sums[f"s{i}"] for i in range(len(sources))])
    most = np.array([sums[f"c{i}"] for i in range(len(sources))])
    weight = np.zeros(len(sources))
    for r in goal:
        weight[slot[r["source"]]] = r["target_weight"] or 0.0
    reachable = (weight > 0) & (most > 0)
    budget = float(tokens) if tokens is not None else float((most[reachable] / weight[reachable]).min()) if reachable.any() else 0.0

    errors: list[np.ndarray] = []
    residual = 0.0
    scale = np.where(have > 0, have, 1.0)
    last = None
    while budget > 0 and len(errors) < ROUNDS:
        got = _expected(units, errors, len(sources))
        error = np.where(reachable | (weight == 0), got - weight * budget, 0.0)
        residual = float(np.abs(error - last).max() / budget) if last is not None else np.inf
        if residual <= SETTLED:
            break
        last = error
        errors.append(STEP * error / scale)

    documents = materialize(_copies(counted.select("id", "source", "n_tokens", member.alias("p"), cap.alias("cap")), errors if budget > 0 else None), "p9-documents")
    drawn = documents.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn"), F.max("copies").alias("most_copies"), F.max("n_tokens").alias("largest"))
    listed = spark.createDataFrame([(r["source"], float(r["target_weight"] or 0), int(r["max_repeats"] or 0)) for r in goal], "source STRING, target_weight DOUBLE, max_repeats INT")
    joined = drawn.join(listed, "source", "full")
    total = documents.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0] or 0
    share: Column = F.round(F.coalesce("drawn", F.lit(0)) / F.lit(float(total or 1)), 6)
    shares = joined.select("source", "target_weight", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "tokens", "drawn", "most_copies", "largest")],
        share.alias("share"), F.round(F.coalesce("drawn", F.lit(0)) / F.lit(budget or 1.0), 6).alias("share_of_target_total"))
    return Mix(documents, shares, len(errors), residual)


def _rates(p: np.ndarray, cap: np.ndarray, errors: list[np.ndarray]) -> np.ndarray:
    """Rates after the rounds whose scaled errors are given: from 1 or the cap, each round steps against the errors of a document's sources
    and is put back between 0 and its cap."""
    rate = np.minimum(cap, 1.0)
    for error in errors:
        rate = np.clip(rate - p @ error, 0.0, cap)
    return rate


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _expected(units: DataFrame, errors: list[np.ndarray], width: int) -> np.ndarray:
    """Expected tokens by source: each task sends one row of sums."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            p = _matrix(batch.column(0), width)
            total += (_rates(p, batch.column(1).to_numpy(), errors) * batch.column(2).to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    each = units.select("p", "cap", "t").mapInArrow(work, "s array<double>")
    return np.array([*each.agg(*[F.coalesce(F.sum(F.col("s")[i]), F.lit(0.0)) for i in range(width)]).first()], float)


def _copies(placed: DataFrame, errors: list[np.ndarray] | None) -> DataFrame:
    """(id, source, n_tokens, rate, copies) of documents (id, source, n_tokens, p, cap)."""
    numbers = placed.groupBy("source").count().select(F.col("source").alias("s"), F.ceil(F.col("count") / SHARD_DOCUMENTS).cast("int").alias("shards"))
    sharded = placed.join(small(materialize(numbers, "p9-shards")), F.col("source").eqNullSafe(F.col("s")))
    ready = (
        sharded.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")))
        .repartition("source", "shard")
        .sortWithinPartitions("source", "shard", F.desc("n_tokens"), F.xxhash64("id"), "id")
    )
    schema = placed.select("id", "source", "n_tokens").schema.add("rate", "double").add("copies", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, carried = None, 0.0
        for batch in batches:
            cap, n = batch.column(4).to_numpy(), batch.column(2).to_numpy()
            rate = np.zeros(len(cap))
            if errors is not None and len(cap):
                rate = _rates(_matrix(batch.column(3), len(batch.column(3)[0])), cap, errors)
            copies = np.zeros(len(cap), np.int64)
            for i, (source, shard) in enumerate(zip(batch.column(1).to_pylist(), batch.column(5).to_pylist())):
                if at != (source, shard):
                    at, carried = (source, shard), 0.0
                want = rate[i] * n[i] + carried
                copies[i] = min(cap[i], max(0, round(want / n[i]))) if n[i] else round(rate[i])
                carried = want - copies[i] * n[i]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.round(rate, 9)), pa.array(copies)], ["id", "source", "n_tokens", "rate", "copies"])

    return ready.select("id", "source", "n_tokens", "p", "cap", "shard").mapInArrow(work, schema)


def _measure(docs: DataFrame, classifier: Classifier, ranks: bytes) -> DataFrame:
    """(id, source, n_tokens, posterior): tokens of every document, and of those without a source the classifier's posterior."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, classifier))  # fixed size: a vocabulary and FEATURES x sources weights
    schema = docs.select("id", "source").schema.add("n_tokens", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of_ranks, model = shared.value
        counter = counter_of(text_of_ranks)
        for batch in batches:
            n, posterior = [], []
            for text, source in zip(batch.column(2), batch.column(1)):
                text = text.as_py()
                n.append(counter.text(text))
                known = source.is_valid or not model.sources
                posterior.append(None if known else model.posterior(features(text)[None, :])[0].tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(posterior, pa.list_(pa.float64()))], ["id", "source", "n_tokens", "posterior"])

    return docs.select("id", "source", "text").mapInArrow(work, schema.add("posterior", T.ArrayType(T.DoubleType())))
