"""The quality classifier against a plain version: votes token by token, EM document by document,
the scorer with dense gradients."""

import math
import random
import re

import numpy as np
import pytest
import xxhash

from ratewise.llm import quality

GOOD = ["The river runs to the sea, and the town on its bank is old. We saw it in the spring.", "It is a day like any other. The sun is up, and I am at home with my cat.",
        "He said that the work is done. No one asked him to do it, but he did so well."]
BAD = ["$$$ ||| ### $$$ buy buy buy now now now", "CLICK HERE TO WIN BIG CASH NOW TODAY FREE", "a\na\na\na\na\na", "||| - * # | - * # | - * #", "!!!! ???? !!!! ;;;; ::::",
       "keyword keyword keyword keyword keyword keyword keyword keyword list list", "1234 5678", "", None]


def plain_votes(text):
    t = text or ""
    w = t.split()
    lines = [x for x in t.split("\n") if x.strip()]
    rate = lambda k, n: k / n if n else 0.0
    out = []
    ends = len(re.findall(r"[.!?…。！？][\"'”»)]*(?:\s|$)", t))
    out.append("." if len(w) < 8 else "-" if ends * 200 < len(w) else "+" if ends * 40 >= len(w) else ".")
    short = rate(sum(1 for x in w if len(x) <= 3 and x.isalpha()), len(w))
    out.append("." if len(w) < 8 else "-" if short <= 0.08 else "+" if short >= 0.2 else ".")
    mean = rate(sum(len(x) for x in w), len(w))
    out.append("-" if mean < 2 or mean > 14 else "+" if 3 <= mean <= 9 else ".")
    faults = [rate(sum(c in "#$%&*|<>{}[]=+~^_\\@" for c in t), len(t)) >= 0.05,
              rate(len(re.findall(r"([^\w\s.])\1", t)), len(w)) >= 0.1,
              rate(sum(x in ("|", "-", "*", "#", "/", "=", ">", "•") for x in w), len(w)) > 0.1,
              len(lines) >= 4 and len(set(lines)) < 0.6 * len(lines),
              rate(sum(1 for x in w if len(x) > 2 and x.isupper()), len(w)) >= 0.3,
              len(w) >= 8 and rate(sum(a == b for a, b in zip(w, w[1:])), len(w)) >= 0.08,
              len(w) >= 20 and max(w.count(x) for x in w) >= 0.2 * len(w),
              not any(c.isalpha() for c in t)]
    return "".join(out) + "".join("-" if x else "." for x in faults)


def corpus(n=60, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        pool = GOOD if rnd.random() < 0.6 else BAD
        out.append(" ".join(x or "" for x in rnd.choices(pool, k=rnd.randint(1, 3))) + ("\n" if i % 3 else f" and {i}."))
    return out + BAD


def test_votes_equal_a_plain_reading():
    for t in corpus(200):
        assert quality.votes(quality.Reading(t)) == plain_votes(t), t


def test_label_model_is_expectation_maximisation():
    """EM over single documents, as the model states it, gives the posteriors found over patterns."""
    votes = [plain_votes(t) for t in corpus(300)]
    judges = len(quality.JUDGES)
    good = [0.1 if "-" in v[judges:] else 0.9 for v in votes]

    def fine(v, i):
        return v[i] == "+" or (i >= judges and v[i] == ".")
    for _ in range(100):
        theta = {}
        for cls, weight in ((0, [1 - g for g in good]), (1, good)):
            for i in range(len(quality.LABELLERS)):
                hit = sum(w for w, v in zip(weight, votes) if fine(v, i))
                miss = sum(w for w, v in zip(weight, votes) if v[i] == "-")
                theta[cls, i] = (hit + 0.1) / (hit + miss + 0.2)
                if cls and i >= judges:
                    theta[cls, i] = max(theta[cls, i], 1 - quality.DETECTOR_ERROR)
        prior = {1: (sum(good) + 1) / (len(votes) + 2)}
        prior[0] = (len(votes) - sum(good) + 1) / (len(votes) + 2)
        new = []
        for v in votes:
            log = {c: math.log(prior[c]) + sum(math.log(theta[c, i]) if fine(v, i) else math.log(1 - theta[c, i]) if v[i] == "-" else 0
                                               for i in range(len(v))) for c in (0, 1)}
            new.append(1 / (1 + math.exp(max(-50, min(50, log[0] - log[1])))))
        done = max(abs(a - b) for a, b in zip(new, good)) < 1e-9
        good = new
        if done:
            break
    patterns = {}
    for v in votes:
        patterns[v] = patterns.get(v, 0) + 1
    posterior, report = quality.label_model(patterns)
    assert all(abs(posterior[v] - g) < 1e-6 for v, g in zip(votes, good))
    assert len(report) == len(quality.LABELLERS) and posterior[plain_votes(GOOD[0])] > 0.9 > 0.1 > posterior[plain_votes(BAD[0])]
    assert quality.label_model({}) == ({}, [])


def plain_features(text):
    out, before = [], None
    for t in (text or "").split():
        tail = re.search(r"[^\w\s]+$", t)
        core = t[:tail.start()] if tail else t
        names = ["w:" + core.lower(), f"n:{min(len(core), 16)}", "c:" + ("upper" if core.isupper() and len(core) > 2 else "other"),
                 "t:" + (tail[0] if tail else ""), "r:again" if t == before else "r:fresh"]
        out += [xxhash.xxh3_64_intdigest(x) % quality.BUCKETS for x in names]
        before = t
    return out


def test_scorer_equals_dense_gradient_descent(spark):
    texts = corpus(50)
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3)
    posterior = {plain_votes(t): (0.95 if "-" not in plain_votes(t) else 0.05) for t in texts}
    w, bias = quality.fit_scorer(df, posterior, most=1000, epochs=6)
    x = np.zeros((len(texts), quality.BUCKETS))
    for i, t in enumerate(texts):
        f = plain_features(t)
        for b in f:
            x[i, b] += quality.SCALE / len(f)
    goal = np.array([posterior[plain_votes(t)] for t in texts])
    pw, pb, m, v = np.zeros(quality.BUCKETS), 0.0, np.zeros(quality.BUCKETS + 1), np.zeros(quality.BUCKETS + 1)
    for e in range(1, 7):
        miss = 1 / (1 + np.exp(-(pb + x @ pw))) - goal
        g = np.append(quality.DECAY * pw + x.T @ miss / len(texts), miss.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = quality.RATE * (m / (1 - 0.9 ** e)) / (np.sqrt(v / (1 - 0.99 ** e)) + 1e-6)
        pw, pb = pw - step[:-1], pb - step[-1]
    assert np.allclose(w, pw, atol=2e-3) and abs(bias - pb) < 2e-3
    for t in texts:
        f = plain_features(t)
        want = bias + (quality.SCALE * w[f].mean() if f else 0.0)
        assert quality._logit(w, bias, *quality.features(quality.Reading(t))) == pytest.approx(want, abs=1e-9)


def test_the_lexicon_forgets_and_finds_again():
    small = quality.Lexicon(most=3)
    for words in (["a", "b"], ["c", "d", "e"], ["a", "f"], ["g"]):
        want = [quality._token_features(x) for x in words]
        assert small.find(words).tolist() == want


def test_planted_good_and_bad_texts_are_told_apart(spark):
    rows = [(i, t) for i, t in enumerate(corpus(300, 4))]
    got = {r.doc_id: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pure_good = [i for i, t in rows if t and all(plain_votes(t)[k] != "-" for k in range(11)) and t.strip()[:5] in {x[:5] for x in GOOD}]
    assert len(pure_good) > 50 and all(got[i].kept for i in pure_good)
    assert not any(got[i].kept for i, t in rows if t in BAD[:6])
    assert all(got[i].votes == plain_votes(t) for i, t in rows)
