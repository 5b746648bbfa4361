"""Quality classifier from weak labels.

Labellers are overlapping heuristics that call a document good, bad or abstain.
All documents' votes are counted by vote pattern (at most 3^labellers rows);
expectation-maximisation over the patterns estimates how often each labeller
objects to good and to bad documents, without any true label, and gives every
pattern the probability that its documents are good.

Whether a labeller abstains says nothing of a document, so only the votes given
count.  Bad documents come in kinds: a labeller may see one kind of junk that all
others pass.  Its objections are then all mistakes or all right, and the votes
alone can't tell; a labeller is held to be better than chance, so the model gives
every labeller that it would put below chance a kind of its own.

A linear scorer over hashed features (words, word shapes, repetition) is trained
on the probabilities for a bounded sample of documents and scores every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import prepare, stage, text_bytes, window_hashes, word_hashes

#: Bounds of the training sample: documents expected, and features (8 bytes each) of all of them; everything
#: else covers all rows.
SAMPLE, SAMPLE_FEATURES = 4000, 20_000_000
DIMENSIONS = 1 << 16
SCALE = 32.0
ROUNDS, RATE, DECAY = 120, 0.5, 1e-4
EM_ROUNDS = 200
#: Priors of the label model: good votes added on good documents, as a share of all documents; the least rate at
#: which a labeller objects to its own kind; the certainty of the first guess.
CARE, OWN_RATE, FIRST = 0.02, 0.9, 0.95

GOOD, ABSTAIN, BAD = 2, 1, 0

#: Labellers: name, measurement, and what they say of it (SQL-like thresholds as
#: functions of an array): bad where the first holds, good where the second does.
LABELLERS = (
    ("symbols", lambda m: m["symbols"] > 0.2, lambda m: m["symbols"] < 0.02),
    ("pipes", lambda m: m["pipes"] > 0.2, None),
    ("exclamations", lambda m: m["exclaims"] > 0.3, None),
    ("shouting", lambda m: m["upper"] > 0.5, lambda m: m["upper"] < 0.3),
    ("repeated_windows", lambda m: m["repeated"] > 0.5, lambda m: m["repeated"] < 0.2),
    ("stutter", lambda m: m["stutter"] > 0.2, lambda m: m["stutter"] < 0.05),
    ("sentences", lambda m: (m["stops"] == 0) & (m["words"] >= 30), lambda m: (m["stops"] > 0.02) & (m["stops"] < 0.5)),
    ("word_length", lambda m: m["length"] > 15, lambda m: (m["length"] > 3) & (m["length"] < 10)),
)

_CLASS = {name: np.isin(np.arange(256), list(chars)) for name, chars in (
    ("symbols", b"#*$%&|<>"), ("pipes", b"|"), ("exclaims", b"!"), ("stops", b".?"),
    ("upper", bytes(range(65, 91))), ("letters", bytes([*range(65, 91), *range(97, 123), *range(128, 256)])),
    ("spaces", b" \t\n\x0b\x0c\r"))}
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = ord("A"), ord("a"), ord("a"), ord("0")


def _totals(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of `values`, empty ones included."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths]


class Texts:
    """Words, repetition marks and measurements of a batch of texts."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.words, self.counts = word_hashes(texts)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        inside = np.ones(len(self.words), bool)          # not the first word of its text
        inside[(np.cumsum(self.counts) - self.counts)[self.counts > 0]] = False
        self.stutter = inside & (self.words == np.concatenate([self.words[:1], self.words[:-1]]))
        windows = window_hashes(self.words, 3)
        valid = np.flatnonzero(self.doc[:len(windows)] == self.doc[2:]) if len(windows) else np.zeros(0, np.int64)
        keys = windows[valid] ^ (self.doc[valid].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, group, size = np.unique(keys, return_inverse=True, return_counts=True)
        self.window_doc, self.window_repeats = self.doc[valid], size[group] > 1

    def measurements(self) -> dict[str, np.ndarray]:
        n = np.maximum(self.counts, 1)
        lengths = np.array([len(t) for t in self.texts], np.int64)
        raw = np.frombuffer(b"".join(self.texts), np.uint8)
        c = {name: _totals(table[raw], lengths) for name, table in _CLASS.items()}
        windows = np.bincount(self.window_doc, minlength=len(n))
        return {"words": self.counts, "symbols": c["symbols"] / n, "pipes": c["pipes"] / n, "exclaims": c["exclaims"] / n,
                "stops": c["stops"] / n, "upper": c["upper"] / np.maximum(c["letters"], 1),
                "length": (lengths - c["spaces"]) / n,
                "stutter": np.bincount(self.doc, weights=self.stutter, minlength=len(n)) / n,
                "repeated": np.bincount(self.window_doc, weights=self.window_repeats, minlength=len(n)) / np.maximum(windows, 1)}

    def votes(self) -> np.ndarray:
        """The vote pattern of each text as a base-3 number; texts without words get abstentions."""
        m, pattern = self.measurements(), np.zeros(len(self.texts), np.int64)
        for k, (_, bad, good) in enumerate(LABELLERS):
            vote = np.full(len(self.texts), ABSTAIN)
            if good is not None:
                vote[good(m)] = GOOD
            vote[bad(m)] = BAD
            vote[self.counts == 0] = ABSTAIN
            pattern += vote * 3 ** k
        return pattern

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs: every word, its shape, and marks of repetition."""
        shapes, _ = word_hashes([_shape(t) for t in self.texts], lower=False)
        mask = np.uint64(DIMENSIONS - 1)
        parts = [(self.doc, (self.words >> np.uint64(7)) & mask), (self.doc, (shapes >> np.uint64(9)) & mask),
                 (self.doc[self.stutter], np.full(int(self.stutter.sum()), 1, np.uint64)),
                 (self.window_doc[self.window_repeats], np.full(int(self.window_repeats.sum()), 2, np.uint64))]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64)


def _shape(text: bytes) -> bytes:
    """Letters and digits reduced to A, a and 0, runs of one character to one."""
    x = _SHAPE[np.frombuffer(text, np.uint8)]
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep].tobytes()


# ---------------------------------------------------------------------------
# label model
# ---------------------------------------------------------------------------

def fit_label_model(patterns: dict[int, int]) -> dict[int, float]:
    """P(good) of each vote pattern, by expectation-maximisation over pattern counts.

    Classes are good documents and one or more kinds of bad ones; labellers vote
    independently given the class, and a class has one rate of objection for
    each labeller.  The first guess calls a pattern bad if any labeller objects.
    Good documents are voted on with care (pseudo-counts of CARE), no kind
    objects less than good documents do, and while a labeller objects more often
    to good documents than to bad ones, it gets a kind of its own.
    """
    if not patterns:
        return {}
    codes, n = np.array(list(patterns)), np.array(list(patterns.values()), float)
    votes = np.stack([codes // 3 ** k % 3 for k in range(len(LABELLERS))], axis=1)
    bad, good = (votes == BAD).astype(float), (votes == GOOD).astype(float)      # pattern, labeller
    guess = np.where(bad.any(axis=1), 1 - FIRST, FIRST)
    share, own = np.stack([guess, 1 - guess], axis=1), []                        # pattern, class; kinds' labellers
    while True:
        share, rates = _maximise(share, n, bad, good, own)
        of_bad = n * share[:, 1:].sum(axis=1)
        objects = (bad.T @ of_bad + 0.1) / ((bad + good).T @ of_bad + 0.2)
        mistaken = bad.T @ (n * share[:, 0])
        below = [k for k in range(len(LABELLERS)) if k not in own and mistaken[k] > 0 and objects[k] < rates[k]]
        if not below:
            return {int(c): float(g) for c, g in zip(codes, share[:, 0])}
        k = max(below, key=lambda k: mistaken[k])
        own.append(k)
        kind = FIRST * bad[:, k:k + 1]
        share = np.concatenate([share * (1 - kind), kind], axis=1)


def _maximise(share, n, bad, good, own: list[int]):
    """Class shares of each pattern after EM, and the rates of objection on good documents."""
    total = n.sum()
    for _ in range(EM_ROUNDS):
        weight = share * n[:, None]
        against, given = bad.T @ weight, (bad + good).T @ weight                 # labeller, class
        rate = (against + 0.1) / (given + 0.2)
        rate[:, 0] = (against[:, 0] + 0.01) / (given[:, 0] + CARE * total + 0.02)
        good_rates = rate[:, 0].copy()
        rate[:, 1:] = np.maximum(rate[:, 1:], rate[:, :1])
        for c, k in enumerate(own, 2):
            rate[k, c] = max(rate[k, c], OWN_RATE)
        logs = np.log((weight.sum(axis=0) + 1) / (total + share.shape[1])) + bad @ np.log(rate) + good @ np.log(1 - rate)
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved, share = np.abs(new - share).max(), new
        if moved < 1e-9:
            break
    return share, good_rates


# ---------------------------------------------------------------------------
# scorer
# ---------------------------------------------------------------------------

class Scorer:
    """Logistic regression over hashed feature frequencies."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray, float]]) -> Scorer:
        """From (features, frequencies, P(good)) of each sampled document; full-batch AdaGrad."""
        if not rows:
            return cls(np.zeros(DIMENSIONS, np.float32), 1.0)
        doc = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        at, x = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]) * SCALE
        goal = np.array([r[2] for r in rows])
        share = np.clip(goal.mean(), 1e-3, 1 - 1e-3)
        weight = np.where(goal > 0.5, 0.5 / share, 0.5 / (1 - share))      # both classes count alike
        w, b, seen, seen_b = np.zeros(DIMENSIONS), 0.0, np.full(DIMENSIONS, 1e-8), 1e-8
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, weights=x * w[at], minlength=len(rows)) + b, -60, 60)))
            error = (p - goal) * weight / len(rows)
            g, gb = np.bincount(at, weights=x * error[doc], minlength=DIMENSIONS) + DECAY * w, error.sum()
            seen, seen_b = seen + g * g, seen_b + gb * gb
            w, b = w - RATE * g / np.sqrt(seen), b - RATE * gb / np.sqrt(seen_b)
        return cls(w.astype(np.float32), float(b))

    def scores(self, texts: Texts) -> np.ndarray:
        doc, at = texts.features()
        total = np.bincount(doc, weights=self.weights[at], minlength=len(texts.texts))
        return 1 / (1 + np.exp(-np.clip(total * SCALE / np.maximum(texts.counts, 1) + self.bias, -60, 60)))


def _votes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(Texts(text_bytes(batch.column(0))).votes())], names=["votes"])


def _training_rows(batches):
    """key, features, their frequencies, how many, and the vote pattern of each text."""
    for batch in batches:
        texts = Texts(text_bytes(batch.column(1)))
        doc, at = texts.features()
        keys, n = np.unique(doc.astype(np.int64) * DIMENSIONS + at, return_counts=True)
        owner = keys // DIMENSIONS
        cuts = np.searchsorted(owner, np.arange(len(texts.texts) + 1))
        at, x = (keys % DIMENSIONS).astype(np.int32), (n / np.maximum(texts.counts, 1)[owner]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([at[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
             pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()), pa.array(np.diff(cuts)),
             pa.array(texts.votes())], names=["key", "at", "x", "n", "votes"])


class Model:
    """The fitted label model (P(good) of each pattern) and scorer."""

    def __init__(self, posterior: dict[int, float], scorer: Scorer):
        self.posterior, self.scorer = posterior, scorer


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sample(texts: DataFrame, rows: int, sample: int, seed: int) -> DataFrame:
    """Training rows: about `sample` distinct documents, those whose hash falls below a share of its range."""
    spark = texts.sparkSession
    keyed = texts.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text"))
    if rows > sample:
        keyed = keyed.where(F.shiftrightunsigned("key", 1) < F.lit(int(2 ** 63 * sample / rows)))
    # equal documents are one example
    drawn = keyed.groupBy("key").agg(F.first("text").alias("text"))
    examples = stage(drawn.mapInArrow(_training_rows, "key long, at binary, x binary, n long, votes long"), "quality-sample")
    sizes, total, last = examples.select("key", "n").orderBy("key").collect(), 0, None
    for key, n in sizes:
        total += n
        if total > SAMPLE_FEATURES:
            break
        last = key
    return examples.where(F.col("key") <= last) if last is not None else spark.createDataFrame([], examples.schema)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 0) -> Model:
    """Label model over all documents, scorer over about `sample` of them, drawn by a hash of id and text.

    The driver gets the counts of vote patterns, the sample's sizes and at most
    SAMPLE_FEATURES of its features, never more.
    """
    prepare(docs.sparkSession)
    texts = _texts(docs)
    counted = texts.select("text").mapInArrow(_votes, "votes long").groupBy("votes").count().collect()
    patterns = {r[0]: r[1] for r in counted}
    posterior = fit_label_model(patterns)
    rows = _sample(texts, sum(patterns.values()), sample, seed).select("at", "x", "votes").collect()
    rows.sort(key=lambda r: (bytes(r[0]), bytes(r[1])))
    return Model(posterior, Scorer.fit([(np.frombuffer(r[0], np.int32), np.frombuffer(r[1], np.float32), posterior[r[2]])
                                        for r in rows]))


def _score(model: Model):
    def run(batches):
        for batch in batches:
            texts = Texts(text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.posterior.get(v) for v in texts.votes().tolist()], pa.float64()),
                 pa.array(model.scorer.scores(texts), pa.float64())], names=["doc_id", "posterior", "score"])
    return run


def classify(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, posterior (label model), score (scorer) and kept (score >= threshold) of every row.

    Defined cases: in a null, empty or word-free text all labellers abstain and
    the scorer answers with its bias; null doc_ids are rows like others; repeated
    rows get equal scores and are one example in training; texts are read whole; an empty table
    gives an empty result; columns other than doc_id and text are ignored.
    """
    prepare(docs.sparkSession)
    model = model or fit(docs)
    return _texts(docs).mapInArrow(_score(model), "doc_id long, posterior double, score double").withColumn(
        "kept", F.col("score") >= threshold)


def _accepted(model: Model, at: int, threshold: float):
    def run(batches):
        for batch in batches:
            keep = model.scorer.scores(Texts(text_bytes(batch.column(at)))) >= threshold
            yield batch.filter(pa.array(keep))
    return run


def accepted_documents(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score reaches the threshold; all columns unchanged.

    Defined cases: as in classify(); each row is judged by its own text, so equal
    ids don't matter; a document without words stays if the model's bias reaches
    the threshold; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return docs.mapInArrow(_accepted(model or fit(docs), docs.columns.index("text"), threshold), docs.schema)
