"""Quality classifier from weak labels.

Heuristic labellers each vote good, bad or nothing on a text. Their accuracies are not known;
expectation-maximisation over the vote patterns of the corpus estimates them and gives every
pattern a probability of being good. These probabilities are the training labels of a linear
scorer over hashed features, which also judges texts on which the labellers are silent or split.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, ship, stored

#: The scorer is fitted on at most so many documents, those with the smallest hash of their key;
#: the labellers' accuracies come from all documents, and all are scored.
FIT_DOCS = 10_000
BUCKETS = 1 << 16
EPOCHS = 15
RATE = 0.5
DECAY = 1e-4
#: Features are shares of a text's tokens, times this.
SCALE = 20.0
THRESHOLD = 0.5
#: Prior knowledge of the label model: a detector finds its fault in at most this share of good
#: texts (its limits are set where good texts do not come).
DETECTOR_ERROR = 0.0005

_TAIL = re.compile(r"[^\w\s]+$")
_RUN = re.compile(r"([^\w\s.])\1")
_END = re.compile(r"[.!?…。！？][\"'”»)]*(?:\s|$)")


def _share(n: int, of: int) -> float:
    return n / of if of else 0.0


def _low_high(x: float, low: float, high: float, low_vote: int, high_vote: int) -> int:
    """A vote at either end of a scale, none (-1) between."""
    return low_vote if x <= low else high_vote if x >= high else -1


class Reading:
    """A text with its tokens, their counts and its lines, read once for all labellers and features."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.split()
        self.n = len(self.words)
        self.counts = Counter(self.words)
        self.again = sum(map(str.__eq__, self.words, self.words[1:]))  # words that follow themselves


def _signs(r: Reading):
    """Signs among the letters of a text."""
    signs = sum(map(r.text.count, "#$%&*|<>{}[]=+~^_\\@"))
    return 0 if _share(signs, len(r.text)) >= 0.05 else -1


def _runs(r: Reading):
    """Signs (but full stops) that follow themselves."""
    return 0 if _share(sum(1 for _ in _RUN.finditer(r.text)), r.n) >= 0.1 else -1


def _bars(r: Reading):
    """Tokens without any letter or digit."""
    alone = sum(r.counts[x] for x in ("|", "-", "*", "#", "/", "=", ">", "•"))
    return 0 if _share(alone, r.n) > 0.1 else -1


def _sentences(r: Reading):
    """Words per sentence end."""
    ends = sum(1 for _ in _END.finditer(r.text))
    return -1 if r.n < 8 else 0 if ends * 200 < r.n else 1 if ends * 40 >= r.n else -1


def _short_words(r: Reading):
    """Prose has many words of up to three letters; lists of terms have few."""
    short = sum(n for w, n in r.counts.items() if len(w) <= 3 and w.isalpha())
    return -1 if r.n < 8 else _low_high(_share(short, r.n), 0.08, 0.2, 0, 1)


def _word_length(r: Reading):
    mean = _share(sum(len(w) * n for w, n in r.counts.items()), r.n)
    return 0 if mean < 2 or mean > 14 else 1 if 3 <= mean <= 9 else -1


def _repeats(r: Reading):
    """Lines that stand in the text more than once."""
    lines = [x for x in r.text.split("\n") if x.strip()]
    return 0 if len(lines) >= 4 and len(set(lines)) < 0.6 * len(lines) else -1


def _shouting(r: Reading):
    """Words in capitals."""
    return 0 if _share(sum(n for w, n in r.counts.items() if w.isupper() and len(w) > 2), r.n) >= 0.3 else -1


def _stutter(r: Reading):
    """Words that follow themselves."""
    return 0 if r.n >= 8 and _share(r.again, r.n) >= 0.08 else -1


def _dominant(r: Reading):
    """The share of the most common word."""
    return 0 if r.n >= 20 and max(r.counts.values()) >= 0.2 * r.n else -1


def _wordless(r: Reading):
    return -1 if any(map(str.isalpha, r.text)) else 0


#: Judges vote good or bad or not at all; detectors look for one fault and vote bad or not at all.
JUDGES = [_sentences, _short_words, _word_length]
DETECTORS = [_signs, _runs, _bars, _repeats, _shouting, _stutter, _dominant, _wordless]
LABELLERS = JUDGES + DETECTORS


def votes(r: Reading) -> str:
    """One sign per labeller: ``+`` good, ``-`` bad, ``.`` no vote."""
    return "".join("-+."[f(r)] for f in LABELLERS)


def label_model(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], list[dict]]:
    """Posterior probability of good for each vote pattern, and each labeller's estimates.

    Labellers vote independently given the true label, each with its own probabilities on good and
    on bad texts: a judge of voting good if it votes (silence says nothing, so short texts are not
    bad for being short), a detector of finding its fault, rarely in good texts. Started from the rule that a text with
    a fault is bad. There are at most 3 ** labellers patterns, whatever the corpus.
    """
    if not patterns:
        return {}, []
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    vote = np.array([["-+.".index(c) for c in k] for k in keys])
    detects = np.arange(len(LABELLERS)) >= len(JUDGES)
    bad = (vote == 0).astype(float)
    fine = ((vote == 1) | (detects & (vote == 2))).astype(float)
    good = np.where(bad[:, detects].any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        theta, prior = [], []
        for w in (n * (1 - good), n * good):
            theta.append((w @ fine + 0.1) / (w @ (fine + bad) + 0.2))
            prior.append((w.sum() + 1) / (n.sum() + 2))
        theta[1] = np.where(detects, np.maximum(theta[1], 1 - DETECTOR_ERROR), theta[1])
        log = [np.log(p) + fine @ np.log(t) + bad @ np.log(1 - t) for p, t in zip(prior, theta)]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    report = [{"labeller": f.__name__.strip("_"), "fine_if_good": float(theta[1][i]), "bad_if_bad": float(1 - theta[0][i])}
              for i, f in enumerate(LABELLERS)]
    return dict(zip(keys, good.tolist())), report


_AGAIN, _FRESH = (xxhash.xxh3_64_intdigest(x) % BUCKETS for x in ("r:again", "r:fresh"))


def _token_features(token: str) -> list[int]:
    tail = _TAIL.search(token)
    core = token[:tail.start()] if tail else token
    case = "upper" if core.isupper() and len(core) > 2 else "other"
    names = ["w:" + core.lower(), f"n:{min(len(core), 16)}", f"c:{case}", "t:" + (tail[0] if tail else "")]
    return [xxhash.xxh3_64_intdigest(x) % BUCKETS for x in names]


class Lexicon:
    """The feature buckets of tokens, looked up by row; forgotten when it has ``most`` tokens."""

    def __init__(self, most: int = 300_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.buckets = np.empty((1024, 4), np.int32)

    def find(self, tokens) -> np.ndarray:
        """(token, 4) buckets."""
        if len(self.rows) > self.most:
            self.clear()
        rows = self.rows
        try:
            at = [rows[t] for t in tokens]
        except KeyError:
            for t in tokens:
                if t not in rows:
                    n = len(rows)
                    if n == len(self.buckets):
                        self.buckets = np.concatenate([self.buckets, np.empty_like(self.buckets)])
                    self.buckets[n] = _token_features(t)
                    rows[t] = n
            at = [rows[t] for t in tokens]
        return self.buckets[at]


_LEXICON = Lexicon()


def features(r: Reading) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts), a bucket possibly more than once: of every token the word, its length, its
    case, the signs at its end, and whether it follows itself."""
    if not r.n:
        return np.empty(0, np.int32), np.empty(0)
    n = np.fromiter(r.counts.values(), float, len(r.counts))
    bucket = np.append(_LEXICON.find(r.counts), [_AGAIN, _FRESH])
    return bucket, np.append(np.repeat(n, 4), [r.again, r.n - r.again])


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"doc": b["doc"], "votes": [votes(Reading(t)) for t in b["text"]]})


def _featurise(posterior):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f, share, q = [], [], []
            for t in b["text"]:
                r = Reading(t)
                every, counts = features(r)
                bucket, at = np.unique(every, return_inverse=True)
                n = np.bincount(at, counts, len(bucket))
                f.append(bucket[n > 0])
                share.append((n[n > 0] * (SCALE / max(n.sum(), 1))).astype(np.float32))
                q.append(posterior.value[votes(r)])
            yield pd.DataFrame({"features": f, "shares": share, "goal": q})
    return run


def _logit(w: np.ndarray, bias: float, bucket: np.ndarray, n: np.ndarray) -> float:
    return bias + (SCALE * (w[bucket] @ n) / n.sum() if len(n) else 0.0)


def _gradient(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, bias = shared.value
        total = np.zeros(BUCKETS + 1)
        for b in batches:
            for f, share, goal in zip(b["features"], b["shares"], b["goal"]):
                miss = 1 / (1 + np.exp(-(bias + w[f] @ share))) - goal
                total[BUCKETS] += miss
                total[f] += miss * share  # a text's buckets are distinct
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "g": total[at]})
    return run


def fit_scorer(docs: DataFrame, posterior: dict[str, float], most: int = FIT_DOCS, epochs: int = EPOCHS):
    """(weights, bias) of a logistic scorer of ``docs`` (doc, text). Its gradient is summed on
    Spark; the driver holds one weight per bucket."""
    spark = docs.sparkSession
    chosen = stored(docs.where("doc IS NOT NULL").select("doc").orderBy(F.xxhash64("doc"), "doc").limit(most), "chosen")
    rows = docs.join(chosen.distinct(), "doc", "left_semi")
    rows = stored(rows.mapInPandas(_featurise(spark.sparkContext.broadcast(posterior)), "features array<int>, shares array<float>, goal double"), "features")
    n = max(rows.count(), 1)
    w, bias, m, v = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for epoch in range(1, epochs + 1):
        got = (rows.mapInPandas(_gradient(spark.sparkContext.broadcast((w, bias))), "bucket int, g double")
               .groupBy("bucket").agg(F.sum("g").alias("g")).toPandas())
        g = np.append(DECAY * w, 0.0)
        g[got["bucket"]] += got["g"] / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-6)
        w, bias = w - step[:BUCKETS], bias - step[BUCKETS]
    return w, bias


def _judge(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        posterior, w, bias = shared.value
        for b in batches:
            v, z = [], []
            for t in b["text"]:
                r = Reading(t)
                v.append(votes(r))
                z.append(_logit(w, bias, *features(r)))
            z = np.array(z, float)
            yield pd.DataFrame({"doc": b["doc"], "votes": v, "posterior": [posterior[x] for x in v], "score": 1 / (1 + np.exp(-z))})
    return run


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = FIT_DOCS) -> DataFrame:
    """(key, votes, posterior, score, kept), one row per row of ``docs``: the labellers' votes, the
    label model's probability of good, the scorer's, and whether the latter reaches ``THRESHOLD``.

    Null or empty text is voted on as a text without words and scored by the bias alone; text
    without a letter is never kept. Null keys are scored but not fitted on. Equal texts have equal results. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    patterns = map_frames(named, _vote, "doc long, votes string").groupBy("votes").count().collect()
    posterior, _ = label_model({r["votes"]: r["count"] for r in patterns})
    w, bias = fit_scorer(named, posterior, most)
    shared = spark.sparkContext.broadcast((posterior, w, bias))
    out = map_frames(named, _judge(shared), "doc long, votes string, posterior double, score double")
    wordless = F.substring("votes", -1, 1) == "-"
    return out.select(F.col("doc").alias(key), "votes", "posterior", "score",
                      ((F.col("score") >= THRESHOLD) & ~wordless).alias("kept"))
