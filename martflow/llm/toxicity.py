"""Toxicity by weak supervision.

1. Words and word beginnings that mark toxic text are mined, in one aggregate,
   from a bounded sample of labelled rows that are not held out; a short list
   of English insults is always among them. Dealt over lexicon voters, beside
   a few pattern voters, each gives a weak vote: fires or not.
2. A generative label model estimates how often each voter fires on toxic and
   on clean text and how voters correlate beyond that; voters that say the
   same thing twice are discounted. The given label is one voter among them,
   of stated accuracy. It yields a posterior label for every sampled row.
3. A linear classifier over the mined features and the voters is trained on
   these posteriors and scores every whole text.

What is fitted rests on at most about ``SAMPLE`` rows and ``TERMS`` features,
both parameters; scoring needs one pass and no shuffle.

Defined results: null and empty texts score like a text without any feature.
Rows with a null id are never learnt from. Several labels of one id: toxic if
any is. Without labels only the insults and patterns vote. Repeated rows are
scored alike. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import WORD, held_out, map_batches

SAMPLE = 16_000  # expected labelled rows fitted on, half of each class at most
TERMS = 4096  # mined features kept, strongest first
MIN_DOCS = 3  # toxic rows a feature must occur in
MIN_LOG_ODDS = 4.0
THRESHOLD = 0.3
PREFIXES = (4, 5)
VOTERS_PER_KIND = 6
FLUSH = 200_000

# Insults in English.
INSULTS = (
    "idiot", "moron", "stupid", "pathetic", "worthless", "scum", "trash", "loser", "disgusting", "dumb",
    "imbecile", "vermin", "filth",
)
SHOUT = re.compile(r"\b[A-ZÀ-Þ]{3,}\b")
JUNK = re.compile(r"%%%|###|\*\*\*|\$\$\$")


def features_of(word: str) -> tuple[str, ...]:
    """A word, and its beginnings where it is longer than they are."""
    return (f"w {word}", *(f"p{n} {word[:n]}" for n in PREFIXES if len(word) > n))


def pattern_votes(text: str) -> tuple[bool, ...]:
    """Shouting, exclamation marks, junk marks, line noise."""
    return (
        len(SHOUT.findall(text)) * 20 > len(text) / 6,
        text.count("!!") >= 3,
        len(JUNK.findall(text)) >= 3,
        text.count("|") >= 5,
    )


PATTERNS = 4
GIVEN_RIGHT = 0.99  # how often a given label is right
# Voters on how many distinct words of a text carry a feature.
COUNTS = (2, 3, 5)


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> tuple[DataFrame, dict]:
    """Labelled rows to learn from, about ``size / 2`` of each class, and the
    weight a row of each class stands for. Where ids repeat and so more than
    ``2 * size`` rows have the chosen ids, about ``size`` of these rows."""
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("toxic"))
    )
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {c: min(1.0, size / 2 / max(1, sizes.get(c, 0))) for c in (0, 1)}
    place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) / 1e6
    some = known.filter(place < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = rows.join(F.broadcast(some), "id")
    found = sample.count()
    if found > 2 * size:
        sample = sample.filter(F.rand(5) < size / found)
    return sample, {c: 1 / r for c, r in rate.items()}


def _feature_counter():
    counts: Counter = Counter()

    def sent():
        made = {"feature": list({f for f, _ in counts})}
        made["toxic"] = [counts[f, 1] for f in made["feature"]]
        made["clean"] = [counts[f, 0] for f in made["feature"]]
        counts.clear()
        return made

    def work(batch):
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            found = set()
            for word in set(WORD.findall(text.lower())):
                found.update(features_of(word))
            counts.update((f, toxic) for f in found)
            if len(counts) > FLUSH:
                yield sent()

    work.last = sent
    return work


def mine(sample: DataFrame, terms: int = TERMS) -> list[str]:
    """The features that mark toxic rows most strongly, and the insults."""
    rows = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = rows.get(1, 0), rows.get(0, 0)
    counted = map_batches(sample.select("text", "toxic"), _feature_counter, "feature string, toxic long, clean long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = (
        counted.groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= MIN_DOCS) & (odds >= MIN_LOG_ODDS))
        .orderBy((F.col("toxic") * odds).desc(), "feature")
        .limit(terms)
        .collect()
    )
    found = [r.feature for r in best]
    return found + [f"w {w}" for w in INSULTS if f"w {w}" not in set(found)]


def voter_of(features: list[str]) -> np.ndarray:
    """The lexicon voter of each feature: kinds apart, and within a kind by strength.

    Features come strongest first, so the voters of a kind differ in accuracy,
    which is what the label model estimates.
    """
    kinds = {"w": 0} | {f"p{n}": 1 + i for i, n in enumerate(PREFIXES)}
    kind_of = [kinds[f.split(" ", 1)[0]] for f in features]
    size, seen = Counter(kind_of), Counter()
    voters = []
    for kind in kind_of:
        voters.append(kind * VOTERS_PER_KIND + seen[kind] * VOTERS_PER_KIND // size[kind])
        seen[kind] += 1
    return np.array(voters, dtype=int)


class Reader:
    """Finds the known features of a text, and what its pattern and count voters
    say; remembers words it has met."""

    def __init__(self, features: list[str]):
        self.index = {f: i for i, f in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> tuple[list[int], list[bool]]:
        found: set[int] = set()
        words = 0
        if len(self.known) > FLUSH:
            self.known.clear()
        for word in set(WORD.findall(text.lower())):
            hits = self.known.get(word)
            if hits is None:
                hits = tuple(self.index[f] for f in features_of(word) if f in self.index)
                self.known[word] = hits
            if hits:
                words += 1
                found.update(hits)
        return sorted(found), [*pattern_votes(text), *(words >= n for n in COUNTS)]


def _reader_rows(features: list[str]):
    def make():
        read = Reader(features)

        def work(batch):
            seen = [read(t) for t in batch["text"]]
            return {"toxic": batch["toxic"], "found": [f for f, _ in seen], "others": [o for _, o in seen]}

        return work

    return make


class LabelModel:
    """Rates at which voters fire on toxic and clean rows, fitted by EM."""

    def __init__(self, voters: int):
        self.fires = np.vstack([np.full(voters, 0.02), np.full(voters, 0.5)])
        self.prior = 0.1
        self.discount = np.ones(voters)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """A voter that does not fire abstains: it is no evidence by itself."""
        on = np.log(self.fires[1]) - np.log(self.fires[0])
        logit = math.log(self.prior / (1 - self.prior)) + votes @ (on * self.discount)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, votes: np.ndarray, weight: np.ndarray, given: np.ndarray, rounds: int = 40) -> np.ndarray:
        """Posteriors after fitting. ``given`` labels are one more voter, of known accuracy."""
        said = np.where(given == 1, 1, -1) * math.log(GIVEN_RIGHT / (1 - GIVEN_RIGHT))
        q = np.where(given == 1, GIVEN_RIGHT, 1 - GIVEN_RIGHT)
        for step in range(rounds):
            for c, p in ((0, 1 - q), (1, q)):
                w = weight * p
                # Smoothed towards rarely firing, and never 0 or 1.
                self.fires[c] = (w @ votes + 0.02) / (w.sum() + 1.0)
            self.fires = np.clip(self.fires, 1e-4, 1 - 1e-4)
            self.prior = float(np.clip((weight * q).sum() / weight.sum(), 1e-3, 0.5))
            if step % 5 == 0:
                self.discount = self._discounts(votes, weight, q)
            logit = np.log(self.posterior(votes)) - np.log1p(-self.posterior(votes))
            q = 1 / (1 + np.exp(-(logit + said)))
        return q

    def _discounts(self, votes: np.ndarray, weight: np.ndarray, q: np.ndarray) -> np.ndarray:
        """One over one plus a voter's correlations with others inside the classes."""
        total = np.zeros((votes.shape[1],) * 2)
        for c, p in ((0, 1 - q), (1, q)):
            w = weight * p
            off = votes - self.fires[c]
            covariance = (off * w[:, None]).T @ off / max(w.sum(), 1e-9)
            deviation = np.sqrt(self.fires[c] * (1 - self.fires[c]))
            total += w.sum() / weight.sum() * covariance / np.outer(deviation, deviation)
        np.fill_diagonal(total, 0)
        return 1 / (1 + np.clip(total, 0, 1).sum(axis=1))


def _train(rows: list[np.ndarray], targets: np.ndarray, weight: np.ndarray, size: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; sparse rows of feature places."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.concatenate(rows).astype(int) if rows and len(at) else np.zeros(0, dtype=int)
    weights, bias = np.zeros(size), -2.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    share = weight / weight.sum()
    for step in range(1, rounds + 1):
        logit = bias + np.bincount(at, weights=weights[place], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - targets) * share
        slope = np.append(np.bincount(place, weights=error[at], minlength=size) + 1e-5 * weights, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


class Model:
    """Features and the classifier's weights: one per feature, then per voter."""

    def __init__(self, features: list[str], weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias
        self.voters = voter_of(features)
        self.lexicons = (1 + len(PREFIXES)) * VOTERS_PER_KIND

    def places(self, found: list[int], others: list[bool]) -> np.ndarray:
        base = len(self.features)
        voters = np.unique(self.voters[found]) if len(found) else np.zeros(0, dtype=int)
        fired = [self.lexicons + i for i, fires in enumerate(others) if fires]
        return np.concatenate([np.asarray(found, dtype=int), base + voters, base + np.asarray(fired, dtype=int)]).astype(int)

    def score(self, found: list[int], others: list[bool]) -> float:
        logit = self.bias + float(self.weights[self.places(found, others)].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", size: int = SAMPLE) -> Model:
    sample, weight_of = _sample(docs, labels, key, text, label, size)
    features = mine(sample)
    lexicons = (1 + len(PREFIXES)) * VOTERS_PER_KIND
    voters = lexicons + PATTERNS + len(COUNTS)
    model = Model(features, np.zeros(len(features) + voters), -5.0)
    read = map_batches(
        sample.select("text", "toxic"), _reader_rows(features), "toxic int, found array<int>, others array<boolean>"
    ).toArrow()
    if not len(read):
        # Nothing to fit on: two insults, or one and a pattern, are toxic.
        model.weights[: len(features)] = 3.0
        return model
    rows = [model.places(f, o) for f, o in zip(read["found"].to_pylist(), read["others"].to_pylist(), strict=True)]
    # The last voter fires where no lexicon does.
    votes = np.zeros((len(rows), voters + 1))
    for i, places in enumerate(rows):
        votes[i, places[places >= len(features)] - len(features)] = 1
    votes[:, -1] = votes[:, :lexicons].sum(axis=1) == 0
    given = read["toxic"].to_numpy()
    weight = np.where(given == 1, weight_of[1], weight_of[0])
    label_model = LabelModel(voters + 1)
    posterior = label_model.fit(votes, weight, given)
    model.weights, model.bias = _train(rows, posterior, weight, len(model.weights))
    return model


def _scorer(model: Model):
    def make():
        read = Reader(model.features)

        def work(batch):
            texts = [t or "" for t in batch["text"]]
            return {"id": batch["id"], "score": [model.score(*read(t)) for t in texts]}

        return work

    return make


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and ``score``."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return map_batches(rows, _scorer(model), "id long, score double").withColumnRenamed("id", key)


def _clean_rows(model: Model, text: str, threshold: float, columns: list[str]):
    def make():
        read = Reader(model.features)

        def work(batch):
            kept = [i for i, t in enumerate(batch[text]) if model.score(*read(t or "")) < threshold]
            return {c: [batch[c][i] for i in kept] for c in columns}

        return work

    return make


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; nothing is shuffled."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, _clean_rows(model, text, threshold, docs.columns), schema)
