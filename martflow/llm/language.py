"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over
hashed letter trigrams separates the languages whose codeword has the bit set
from the others. Decoding weighs each bit's logistic loss by how reliable the
bit was on the fitting rows and takes the codeword of least loss; a small lead
over the second is flagged as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows, ``per_label``
expected rows for each label. Trigram counts are summed per task and label,
so what reaches the driver has the size of labels times ``FEATURES``.

Defined results: null text, and text without a letter, is ``und`` with score
0. Rows with a null label are predicted but not learnt from. Without any label
everything is ``und``; with one label that label has score 1. Repeated rows
count as often as they occur. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import held_out, map_batches

FEATURES = 1 << 15
PER_LABEL = 2000
MOST_LABELS = 200  # labels learnt, the most frequent; others are never predicted
SMOOTHING = 0.5
AMBIGUOUS = 0.2  # lead of the best posterior over the second
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def trigrams(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """Hashed trigrams of the letters, words set apart by one space; None without letters."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters[np.minimum(codes, 0xFFFF)]
    wide = np.flatnonzero(codes > 0xFFFF)
    if len(wide):
        is_letter = is_letter.copy()
        is_letter[wide] = [chr(c).isalpha() for c in codes[wide]]
    if not is_letter.any():
        return None
    padded = np.full(len(codes) + 2, 32, dtype=np.uint32)
    padded[1:-1] = np.where(is_letter, codes, 32)
    space = padded == 32
    padded = padded[~(space & np.concatenate(([False], space[:-1])))]
    mixed = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77) + padded[2:] * np.uint32(0xC2B2AE3D)
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - 15)


def codewords(labels: int, seed: int = 1) -> np.ndarray:
    """labels x bits of +1 and -1; no bit is constant, codewords lie far apart.

    Up to 5 labels every split of the labels is a bit; beyond, the best of 50
    random codes of about 10 log2(labels) bits.
    """
    if labels < 2:
        return np.zeros((labels, 0))
    if labels <= 5:
        splits = [s for s in itertools.product((-1, 1), repeat=labels) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=float).T
    rng = np.random.default_rng(seed)
    bits = math.ceil(10 * math.log2(labels))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice((-1.0, 1.0), size=(labels, bits))
        code[0] = np.where(abs(code.sum(axis=0)) == labels, -code[0], code[0])
        distance = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
        if distance > apart:
            best, apart = code, distance
    return best


def _count_by_label():
    table = letter_table()
    counts: dict[str, np.ndarray] = {}

    def work(batch):
        for text, label in zip(batch["text"], batch["label"], strict=True):
            grams = trigrams(text, table)
            if grams is not None:
                if label not in counts:
                    counts[label] = np.zeros(FEATURES, dtype=np.int64)
                counts[label] += np.bincount(grams, minlength=FEATURES)
        return iter(())

    def sent():
        used = [(label, i, int(c[i])) for label, c in counts.items() for i in np.flatnonzero(c)]
        return {"label": [u[0] for u in used], "feature": [u[1] for u in used], "n": [u[2] for u in used]}

    work.last = sent
    return work


class Model:
    """Labels, codewords, trigram weights per bit, and each bit's scale and reliability."""

    def __init__(self, labels: list[str], counts: np.ndarray):
        self.labels = labels
        self.code = codewords(len(labels))
        share = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * FEATURES)
        bits = self.code.shape[1]
        self.weights = np.zeros((FEATURES, bits), dtype=np.float32)
        for b in range(bits):
            yes = self.code[:, b] > 0
            self.weights[:, b] = np.log(share[yes].mean(axis=0)) - np.log(share[~yes].mean(axis=0))
        self.middle = np.zeros(bits)
        self.scale = np.ones(bits)
        self.trust = np.ones(bits)

    def margins(self, grams: np.ndarray) -> np.ndarray:
        if len(grams) > FEATURES:
            # Counted, so that a long text takes no more memory than a table of all trigrams.
            counts = np.bincount(grams, minlength=FEATURES)
            return counts @ self.weights / len(grams)
        return self.weights[grams].mean(axis=0)

    def calibrate(self, label_means: np.ndarray, right: np.ndarray) -> None:
        """From mean margins per label, and each bit's share of rows on its right side."""
        for b in range(self.code.shape[1]):
            yes = self.code[:, b] > 0
            high, low = label_means[yes, b].min(), label_means[~yes, b].max()
            self.middle[b] = (high + low) / 2
            self.scale[b] = max(abs(high - low) / 2, 1e-3)
        self.trust = np.clip(2 * right - 1, 0.01, 1.0)

    def posteriors(self, grams: np.ndarray) -> np.ndarray:
        if len(self.labels) == 1:
            return np.ones(1)
        z = np.clip((self.margins(grams) - self.middle) / self.scale, -4, 4)
        loss = (self.trust * np.logaddexp(0, -2 * self.code * z)).sum(axis=1)
        likely = np.exp(loss.min() - loss)
        return likely / likely.sum()


def _margin_rows(model: Model):
    def make():
        table = letter_table()

        def work(batch):
            kept = [(la, trigrams(t, table)) for t, la in zip(batch["text"], batch["label"], strict=True)]
            kept = [(la, g) for la, g in kept if g is not None]
            return {"label": [la for la, _ in kept], "margins": [model.margins(g).astype(float).tolist() for _, g in kept]}

        return work

    return make


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = PER_LABEL) -> Model | None:
    """Fit on about ``per_label`` rows of each label, never on held-out rows.

    Labels are the ``MOST_LABELS`` most frequent. Rows are chosen by a hash of
    id and text; where rows repeat, so that more than twice as many of a label
    are chosen, by chance among these.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & ~held_out(F.col("id")))
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(MOST_LABELS).collect()
    if not sizes:
        return None
    spark = docs.sparkSession
    rates = spark.createDataFrame([(r.label, min(1.0, per_label / r.n)) for r in sizes], "label string, rate double")
    place = F.pmod(F.xxhash64("id", "text", F.lit(11)), F.lit(1_000_000)) / 1e6
    sample = rows.join(F.broadcast(rates), "label").filter(place < F.col("rate"))
    many = {r.label: per_label / r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r.n > 2 * per_label}
    if many:
        share = spark.createDataFrame(list(many.items()), "label string, share double")
        sample = sample.join(F.broadcast(share), "label", "left").filter(F.rand(11) < F.coalesce("share", F.lit(1.0)))
    sample = sample.select("text", "label")
    sums = map_batches(sample, _count_by_label, "label string, feature int, n long")
    sums = sums.groupBy("label", "feature").agg(F.sum("n").alias("n")).toArrow()
    if not len(sums):
        return None
    of_label = sums["label"].combine_chunks().dictionary_encode()
    known = of_label.dictionary.to_pylist()
    labels = sorted(known)
    place_of = {name: i for i, name in enumerate(labels)}
    place = np.array([place_of[name] for name in known])[of_label.indices.to_numpy()]
    counts = np.zeros((len(labels), FEATURES))
    counts[place, sums["feature"].to_numpy()] = sums["n"].to_numpy()
    model = Model(labels, counts)
    bits = model.code.shape[1]
    if bits:
        scored = map_batches(sample, _margin_rows(model), "label string, margins array<double>")
        means = scored.groupBy("label").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(F.col("margins")[b]).alias(f"m{b}") for b in range(bits)]
        )
        found = {r.label: r for r in means.collect()}
        by_label = np.array([[found[name][f"m{b}"] for b in range(bits)] for name in labels])
        model.calibrate(by_label, np.ones(bits))
        code = {name: model.code[i] for name, i in place_of.items()}
        right = [
            F.avg((F.signum(F.col("margins")[b] - float(model.middle[b])) == side).cast("double")).alias(f"r{b}")
            for b in range(bits)
            for side in [F.create_map(*[F.lit(x) for name in labels for x in (name, float(code[name][b]))])[F.col("label")]]
        ]
        model.calibrate(by_label, np.array(scored.agg(*right).first(), dtype=float))
    return model


def _predictor(model: Model | None):
    def make():
        table = letter_table()

        def work(batch):
            out = {"id": batch["id"], "lang_pred": [], "score": [], "ambiguous": []}
            for text in batch["text"]:
                grams = trigrams(text, table) if model else None
                if grams is None:
                    found = (UNKNOWN, 0.0, True)
                else:
                    p = model.posteriors(grams)
                    order = np.argsort(-p, kind="stable")
                    lead = p[order[0]] - (p[order[1]] if len(p) > 1 else 0.0)
                    found = (model.labels[order[0]], float(p[order[0]]), bool(lead < AMBIGUOUS))
                for name, value in zip(("lang_pred", "score", "ambiguous"), found, strict=True):
                    out[name].append(value)
            return out

        return work

    return make


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``lang_pred``, ``score`` and ``ambiguous``."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    made = map_batches(rows, _predictor(model), "id long, lang_pred string, score double, ambiguous boolean")
    return made.withColumnRenamed("id", key)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = PER_LABEL) -> DataFrame:
    """Fit on the labelled rows that are not held out, predict all rows."""
    found = predict(docs, fit(docs, key, text, label, per_label), key, text)
    return found.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score", "ambiguous")
