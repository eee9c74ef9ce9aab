"""Quality classifier by co-training two views of a document.

The text view counts what the text holds (character classes, repetition, line
shapes, hashed words); the metadata view knows only the language, the source
and the stated length. Each is a logistic regression. Both are first fitted
on the labelled documents; then, in each round, every unlabelled document that
one calibrated view is sure of becomes a training example of the other, and
both are fitted anew. A view that knows little is never sure, and so teaches
nothing. At last the calibrated views are combined by a logistic regression
on the held-out labelled fold, and all documents are scored.

All fits are Newton steps over whole tables: a task sums gradients and
Hessians of its rows (a few thousand numbers), tasks' sums are added in groups, and
the driver adds up at most ``SLOTS`` of them. No sample is drawn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import stored
from riskloom.llm.wordsets import window_hashes, word_hashes
from riskloom.session import ship_package

ROUNDS = 2          # exchanges of pseudo-labels
SURE = 0.97         # calibrated probability from which a view's opinion is passed on
TRUST = 0.3         # weight of a pseudo-label
HELD_OUT = 5        # one in so many labelled documents calibrates and combines the views
RIDGE = 1.0
KEEP = 0.2          # documents of this score or more are kept
SLOTS = 128
WORD_BUCKETS = 40
SOURCE_BUCKETS = 32
LANG_BUCKETS = 8

MARKS = b"!?|#*$%&<>.,;:-()[]{}\"'/\\"  # whose shares are features, one by one for the first eight


def text_features(text: str | None) -> np.ndarray:
    """The text view. A null or empty text has the intercept alone."""
    out = np.zeros(24 + WORD_BUCKETS, np.float32)
    out[0] = 1.0
    words = word_hashes(text)
    if not len(words):
        return out
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    visible = max(1, len(raw) - counts[[9, 10, 11, 12, 13, 32]].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = window_hashes(words, 3)
    n = len(words)
    out[1:9] = np.sqrt(counts[list(MARKS[:8])] / visible) * 4
    out[9] = np.sqrt(counts[list(MARKS[8:])].sum() / visible) * 2
    out[10] = counts[65:91].sum() / visible * 4
    out[11] = counts[48:58].sum() / visible * 4
    out[12] = counts[128:].sum() / visible
    out[13] = np.log(visible / n) - 1.5
    out[14] = np.log1p(n) / 4 - 1.5
    out[15] = (words[1:] == words[:-1]).mean() * 3 if n > 1 else 0.0
    out[16] = 1 - len(np.unique(windows)) / len(windows)
    out[17] = 1 - len(set(lines)) / max(1, len(lines))
    out[18] = np.log1p(n / max(1, len(lines))) / 2 - 1.5
    out[19] = counts[46] / max(1, len(lines)) > 0
    out[20] = 1 - len(np.unique(words)) / n
    out[21] = n < 20
    out[22] = raw[:1].isupper()
    out[23] = raw[-1:] in b".!?"
    share = np.bincount((words >> np.uint64(32)) % np.uint64(WORD_BUCKETS), minlength=WORD_BUCKETS) / n
    out[24:] = np.sqrt(share)
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """The metadata view; nulls are values of their own."""
    out = np.zeros(4 + LANG_BUCKETS + SOURCE_BUCKETS, np.float32)
    out[0] = 1.0
    if n_chars is None or n_chars < 0:
        out[1] = 1.0
    else:
        size = np.log1p(n_chars) / 4 - 2
        out[2], out[3] = size, size * size
    out[4 + xxhash.xxh32_intdigest((lang or "").encode()) % LANG_BUCKETS] = 1.0
    out[4 + LANG_BUCKETS + xxhash.xxh32_intdigest((source or "").encode()) % SOURCE_BUCKETS] = 1.0
    return out


def _views(batch: pa.RecordBatch, mark: str = "_") -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, chars = (batch.column(f"{mark}{c}").to_pylist() for c in ("text", "lang", "source", "n_chars"))
    return np.stack([text_features(t) for t in text]), np.stack([meta_features(*m) for m in zip(lang, source, chars)])


def _inputs(docs: DataFrame, mark: str = "_") -> list:
    """The columns that the views read, under names of their own; absent ones are null."""
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(f"{mark}{c}") for c, kind in kinds.items()]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            views = [pa.array(list(v), pa.list_(pa.float32())) for v in _views(part)]
            yield pa.RecordBatch.from_arrays([part.column("_id"), *views], ["doc_id", "a", "b"])


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, a, b, y, held`` of every document; stored once. ``y`` is the
    label's quality (the least, if a doc_id has several), null if it has none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), *_inputs(docs))
    seen = rows.mapInArrow(_feature_batches, "doc_id long, a array<float>, b array<float>")
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min(F.col("quality").cast("int")).alias("y"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0
    return stored(seen.join(known, "doc_id", "left").withColumn("held", held), "features")


def _probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


#: (features, label or NaN, held out) of a batch -> [(X, y, weight), ...] for each model fitted at once
Examples = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _sums(examples: Examples, weights: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(w), len(w) + 1)) for w in weights]
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.asarray(batch.column(c).flatten(), dtype=np.float64).reshape(batch.num_rows, -1) for c in ("a", "b"))
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for out, w, (x, target, weight) in zip(total, weights, examples(a, b, y, held)):
                used = weight > 0
                x, target, weight = x[used], target[used], weight[used]
                p = _probability(x @ w)
                out[:, 0] += x.T @ (weight * (p - target))
                out[:, 1:] += (x * (weight * p * (1 - p))[:, None]).T @ x
        flat = np.concatenate([t.ravel() for t in total])
        slot = TaskContext.get().partitionId() % SLOTS
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([flat.tobytes()], pa.binary())], ["slot", "sums"])
    return run


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s) for s in group.column("sums").to_pylist())
    return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})


def _fit(rows: DataFrame, examples: Examples, weights: list[np.ndarray], steps: int, ridge: float = RIDGE) -> list[np.ndarray]:
    """Newton steps of several logistic regressions, all in one pass over the rows a step."""
    for _ in range(steps):
        parts = rows.select("a", "b", "y", "held").mapInArrow(_sums(examples, weights), "slot int, sums binary")
        added = parts.groupBy("slot").applyInArrow(_add, "sums binary").collect()  # at most SLOTS small rows
        flat = sum((np.frombuffer(r.sums) for r in added), np.zeros(sum(len(w) * (len(w) + 1) for w in weights)))
        new, at = [], 0
        for w in weights:
            block = flat[at:at + len(w) * (len(w) + 1)].reshape(len(w), len(w) + 1)
            at += block.size
            penalty = np.full(len(w), ridge)
            penalty[0] = 1e-3
            step = np.linalg.solve(block[:, 1:] + np.diag(penalty), block[:, 0] + penalty * w)
            new.append(w - step * min(1.0, 8.0 / max(1e-9, np.abs(step).max())))
        weights = new
    return weights


def _line(score: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(score), score], axis=1)


class Model:
    """Weights of the two views, of their calibrations, and of the combination."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        self.cal_a = self.cal_b = np.array([0.0, 1.0])
        self.mix = np.array([0.0, 0.5, 0.5])

    def logits(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of either view."""
        return (np.clip(_line(np.clip(x @ w, -15, 15)) @ c, -15, 15) for x, w, c in ((a, self.a, self.cal_a), (b, self.b, self.cal_b)))

    def score(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one, two = self.logits(a, b)
        both = self.mix[0] + self.mix[1] * one + self.mix[2] * two
        return _probability(one), _probability(two), _probability(both)


def _labelled(a, b, y, held):
    weight = (~np.isnan(y) & ~held).astype(float)
    return [(a, y, weight), (b, y, weight)]


def _taught(model: Model) -> Examples:
    def examples(a, b, y, held):
        known = (~np.isnan(y) & ~held).astype(float)
        free = np.isnan(y)
        out = []
        for x, opinion in zip((a, b), reversed([_probability(z) for z in model.logits(a, b)])):
            sure = free & ((opinion >= SURE) | (opinion <= 1 - SURE))
            out.append((x, np.where(sure, opinion >= 0.5, np.nan_to_num(y)), known + TRUST * sure))
        return out
    return examples


def _calibration(model: Model) -> Examples:
    def examples(a, b, y, held):
        weight = (~np.isnan(y) & held).astype(float)
        return [(_line(np.clip(x @ w, -15, 15)), y, weight) for x, w in ((a, model.a), (b, model.b))]
    return examples


def _combination(model: Model) -> Examples:
    def examples(a, b, y, held):
        one, two = model.logits(a, b)
        return [(np.stack([np.ones_like(one), one, two], axis=1), y, (~np.isnan(y) & held).astype(float))]
    return examples


def train(rows: DataFrame, rounds: int = ROUNDS) -> Model | None:
    """Co-trains on :func:`features`; None if the labels lack one of the classes (in either fold)."""
    known = rows.filter("y is not null")
    seen = {(r.held, r.y) for r in known.select("held", "y").distinct().collect()}  # at most a few rows
    if len({y for held, y in seen if held}) < 2 or len({y for held, y in seen if not held}) < 2:
        return None
    model = Model(np.zeros(24 + WORD_BUCKETS), np.zeros(4 + LANG_BUCKETS + SOURCE_BUCKETS))
    for turn in range(rounds + 1):
        start = [model.a, model.b]
        model.a, model.b = _fit(rows, _taught(model), start, 3) if turn else _fit(known, _labelled, start, 6)
        model.cal_a, model.cal_b = _fit(known, _calibration(model), [np.array([0.0, 1.0])] * 2, 5, ridge=0.1)
    (model.mix,) = _fit(known, _combination(model), [model.mix], 5, ridge=0.1)
    return model


def _score_batches(model: Model, columns: list[str], mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = [pa.array(s, pa.float64()) for s in model.score(*(v.astype(np.float64) for v in _views(part, mark)))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *scores], [*columns, *SCORES])
    return run


def _stored_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            views = (np.asarray(batch.column(c).flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 1)) for c in ("a", "b"))
            scores = [pa.array(s, pa.float64()) for s in model.score(*views)] if n else [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *scores], ["doc_id", *SCORES])
    return run


SCORES = ["_p_text", "_p_meta", "_score"]


def score(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """``docs`` with ``_p_text, _p_meta, _score`` (probabilities of good quality) and ``_keep``.

    Every row is scored by itself, so repeated rows agree and a null doc_id is
    only never labelled. A null or empty text and null metadata have features
    of their own. Without labels of both classes nothing is learned: scores
    are null and all documents kept. An empty table gives no rows. Columns other
    than those read pass through whatever their names; only earlier columns of
    the four result names are replaced. Absent metadata columns count as null.
    """
    ship_package(docs.sparkSession)
    model = train(features(docs, labels), rounds)
    columns = [c for c in docs.columns if c not in (*SCORES, "_keep")]
    if model is None:
        return docs.select(*columns, *[F.lit(None).cast("double").alias(c) for c in SCORES], F.lit(True).alias("_keep"))
    mark = "_"
    while any(c.startswith(mark) for c in columns):
        mark += "_"
    schema = T.StructType([*(docs.schema[c] for c in columns), *[T.StructField(c, T.DoubleType()) for c in SCORES]])
    scored = docs.select(*columns, *_inputs(docs, mark)).mapInArrow(_score_batches(model, columns, mark), schema)
    return scored.withColumn("_keep", F.col("_score") >= keep)


def quality(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """``doc_id`` and the four columns of :func:`score` for every row of ``docs``,
    from the stored features: texts are read once."""
    ship_package(docs.sparkSession)
    rows = features(docs, labels)
    model = train(rows, rounds)
    if model is None:
        return rows.select("doc_id", *[F.lit(None).cast("double").alias(c) for c in SCORES], F.lit(True).alias("_keep"))
    scored = rows.select("doc_id", "a", "b").mapInArrow(_stored_batches(model), "doc_id long, " + ", ".join(f"{c} double" for c in SCORES))
    return scored.withColumn("_keep", F.col("_score") >= keep)


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``."""
    return score(docs, labels, **how).filter("_keep").select(*docs.columns)
