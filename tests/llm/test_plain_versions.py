"""Fingerprints, the language model's expectation step, shallow regions of the forest and unlearned
scripts, each against a plain version or planted cases."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from ratewise.llm import langid, mixing, neardup, orderminhash
from ratewise.llm.queries import PIECES
from tests.llm.test_documents import docs

M64 = (1 << 64) - 1


def plain_mix(x):
    x = ((x ^ (x >> 31)) * 0xC2B2AE3D27D4EB4F) & M64
    return x ^ (x >> 29)


def plain_fingerprint(text):
    k = min(6, len(text))
    if not k:
        return [0] * 32
    hashes, seen, keys = [], {}, []
    for i in range(len(text) - k + 1):
        h = k
        for c in text[i:i + k]:
            h = ((h + ord(c)) * 0x9E3779B97F4A7C15) & M64
            h ^= h >> 32
        h = plain_mix(h)
        hashes.append(h)
        keys.append(plain_mix((h + seen.get(h, 0) * 0x9E3779B97F4A7C15) & M64) >> 32)
        seen[h] = seen.get(h, 0) + 1
    rng = np.random.Generator(np.random.PCG64(77))
    xor = rng.integers(0, 2**32, 32, dtype=np.uint32)
    mul = rng.integers(0, 2**32, 32, dtype=np.uint32) | np.uint32(1)
    out = []
    for m in range(32):
        order = sorted(range(len(keys)), key=lambda i: (((keys[i] ^ int(xor[m])) * int(mul[m])) & 0xFFFFFFFF, i))[:2]
        first, *second = sorted(order)
        h = hashes[first]
        if second:
            h = plain_mix((h * 0x9E3779B97F4A7C15 + hashes[second[0]]) & M64)
        out.append(plain_mix((h + m) & M64) >> 32)
    return out


def test_fingerprints_equal_a_plain_version():
    rnd = random.Random(1)
    texts = ["", "a", "abcdef", "abcdefg", "aaaaaaaaaaaaaaaa", "é日本語 mixed 😀 text", "ab" * 3000]
    texts += ["".join(rnd.choice("abc de") for _ in range(rnd.choice([5, 40, 900, 9000]))) for _ in range(25)]
    for t in texts:
        assert orderminhash.fingerprint(t).tolist() == plain_fingerprint(t), t[:30]


def test_fingerprints_follow_order_and_edits():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(400)]
    text = " ".join(words)
    near = lambda other: orderminhash.likeness(orderminhash.fingerprint(text), orderminhash.fingerprint(other))
    few = " ".join(w if i % 40 else "edited" for i, w in enumerate(words))
    shuffled = " ".join(rnd.sample(words, len(words)))  # the same words, few windows less
    assert near(text) == 1 and near(few) > 0.5 > near(shuffled) and near(" ".join(reversed(words))) < 0.3


def segmentations(word, pieces):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or n == 1:
            for rest in segmentations(word[n:], pieces):
                yield (word[:n], *rest)


def test_expected_counts_sum_over_all_segmentations():
    pieces = {x: i for i, x in enumerate(["a", "b", "ab", "ba", "aba", "bb", "c"])}
    rnd = np.random.default_rng(3)
    p = np.concatenate([rnd.random((len(pieces), 2)) / 5, np.zeros((1, 2)), np.full((1, 2), langid.UNKNOWN)])
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abz", repeat=n)]
    counts = rnd.integers(0, 5, (len(words), 2)).astype(float)
    into = np.zeros_like(p)
    for at, lattice in langid.lattices(words, langid.Pieces(pieces)):
        lattice.expected(p, counts[at], into)
    want = np.zeros_like(p)
    row = lambda x: pieces.get(x, len(pieces) + 1)
    for w, c in zip(words, counts):
        cuts = [(s, np.prod([p[row(x)] for x in s], axis=0)) for s in segmentations(w, pieces)]
        total = sum(q for _, q in cuts)
        for s, q in cuts:
            for x in s:
                want[row(x)] += c * q / total
    assert np.allclose(into, want)


def test_fitting_is_expectation_maximisation(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the end", "en"), (None, "en"), ("x", None)])]
    model = langid.fit(docs(spark, rows), PIECES, rounds=2)
    assert model.langs == ["de", "en"] and model.letters == ["".join(sorted(set("derhundunddiekatze"))), "".join(sorted(set("thecatandthedogend")))]
    pieces = model.pieces
    words = {}
    for _, t, lang in rows:
        if t and lang:
            for w in langid.words_of(t):
                for s in langid.stretches(w):
                    words[s, lang] = words.get((s, lang), 0) + 1
    p = langid._probabilities(np.ones((len(pieces), 2)))
    for _ in range(2):
        counts = np.zeros((len(pieces), 2))
        for (s, lang), n in words.items():
            j = model.langs.index(lang)
            cuts = [(c, np.prod([p[pieces[x] if x in pieces else len(pieces) + 1, j] for x in c])) for c in segmentations(s, pieces)]
            total = sum(q for _, q in cuts)
            for c, q in cuts:
                for x in c:
                    if x in pieces:
                        counts[pieces[x], j] += n * q / total
        p = langid._probabilities(counts)
    assert np.allclose(model.p, p, rtol=1e-9)
    # equal scores go to the first language by name
    even = langid.Model(pieces, ["b", "a"][::-1], np.full((len(pieces) + 2, 2), 0.01))
    assert next(iter(even.predict(["word"])))[0] == "a"


def test_scripts_that_were_not_learned_go(spark):
    en = "the river runs to the sea and the town on its bank is old and we saw it in the spring"
    de = "der fluss läuft zum meer und die stadt an seinem ufer ist alt und wir sahen sie im frühling"
    rows = [(i, f"{en} {i}", "en") for i in range(30)] + [(100 + i, f"{de} {i}", "de") for i in range(30)]
    foreign = ["Это предложение написано по-русски и не похоже на другие", "これは日本語の文章です", "هذه جملة عربية قصيرة", "Αυτή είναι μια πρόταση"]
    rows += [(200 + i, t, None) for i, t in enumerate(foreign)] + [(300, "the town is old, Это", None), (301, None, "en"), (302, "123 !", "en"), (303, "Naïve coöperation in the spring", "en")]
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs(spark, rows).select(*corpus_pipeline.COLUMNS), "").collect()}
    assert set(got) == set(range(30)) | set(range(100, 130)) | {300, 303} and got[300] == "en"


def test_a_class_alone_at_depth_four_meets_its_shallow_neighbours(spark, monkeypatch):
    """With two trees a quarter of the pairs of similarity 0.85 share no region of depth 4 (0.48**2); of
    these the shallow regions leave a third (0.28**2 of all)."""
    monkeypatch.setattr(neardup, "TREES", 2)
    rnd = random.Random(7)
    rows = []
    for i in range(200):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
        other = words.copy()
        for at in rnd.sample(range(150), 3):
            other[at] = "changed"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    links = sum(10 * len(a & b) >= 8 * len(a | b) for a, b in (({*neardup.shingle_set(rows[i][1], 4).tolist()}, {*neardup.shingle_set(rows[i + 1][1], 4).tolist()})
                                                                for i in range(0, 400, 2)))
    assert links > 150
    def found():
        out = neardup.near_duplicates(docs(spark, rows), words=4).collect()
        return sum(r.component_id != r.doc_id for r in out)
    deep = found()
    monkeypatch.setattr(neardup, "lonely_pairs", lambda classes, _: classes.limit(0).selectExpr("id AS a", "id AS b"))
    without = found()
    assert without < 0.84 * links < 0.86 * links < deep <= links


@pytest.mark.parametrize("size", [12, 60, 400])
def test_likely_pairs_are_not_lost_by_their_signatures(size):
    """The signature filter in front of the full sets keeps every planted link."""
    rnd = np.random.default_rng(size)
    lost = 0
    for _ in range(1500):
        union = rnd.integers(0, 2**63, size, dtype=np.uint64)
        both = -(-8 * size // 10)
        rest = size - both
        a, b = np.unique(union[:both + rest // 2]), np.unique(np.concatenate([union[:both], union[both + rest // 2:]]))
        sa, sb = (np.frombuffer(neardup.signature(x), "<u4") for x in (a, b))
        lost += (sa == sb).mean() < neardup.LIKELY
    assert lost == 0


def test_target_weights_are_met(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(1, 40), rnd.choice(["en", "en", "de"]), rnd.choice(["a", "a", "b", None])) for i in range(1500)]
    frame = docs(spark, rows).withColumn("subject", mixing.F.when(mixing.F.col("doc_id") % 3 == 0, "x").otherwise("y"))
    goals = {"source": {"a": 1, "b": 2, None: 1}, "lang": spark.createDataFrame([("en", 0.5), ("de", 0.5)], "k string, share double")}
    for topic in ("subject", mixing.topic):
        out = mixing.mix(frame, sweeps=None, goals=goals, topic_of=topic).collect()
        total = sum(r.tokens for r in out)
        for dim, want in (("source", {"a": 0.25, "b": 0.5, None: 0.25}), ("lang", {"en": 0.5, "de": 0.5})):
            for value, share in want.items():
                assert sum(r.tokens * r.factor for r in out if r[dim] == value) / total == pytest.approx(share, rel=0.01)
    gone = mixing.mix(frame, sweeps=None, keep=0.5, goals={"source": {"a": 1}}).collect()
    assert {r.source for r in gone if r.sampled} == {"a"} and {r.p for r in gone if r.source != "a"} == {0.0}


def test_columns_with_the_names_of_steps_do_not_clash_in_mixing_and_lines(spark):
    from ratewise.llm import linededup
    F = mixing.F
    df = docs(spark, [(i, f"menu\ntext {i}") for i in range(10)])
    names = ("__source", "__p", "cell", "cell_", "__host", "__dropped", "boilerplate", "left", "host", "dropped", "base", "weight", "k")
    df = df.withColumns({c: F.lit(7) for c in names})
    mixed = mixing.mix(df).first()
    assert all(mixed[c] == 7 for c in names) and mixed.tokens == 3
    lines = linededup.drop_boilerplate(df).collect()
    assert {r.text for r in lines} == {f"text {i}" for i in range(10)} and all(r[c] == 7 for r in lines for c in names)


def test_very_long_texts_pass_through_mixing_lines_licences_and_archives(spark):
    from ratewise.llm import licenses, linededup, warc
    F = mixing.F
    long = "x" * 2_000_000 + "\n" + "word " * 200_000 + "\nAll rights reserved.\nmenu"
    rows = [(1, long)] + [(10 + i, f"menu\ntext {i}") for i in range(9)]
    frame = docs(spark, rows)
    assert {r.doc_id: r.tokens for r in mixing.mix(frame, sweeps=2).select("doc_id", "tokens").collect()}[1] == 200_005
    out = {r.doc_id: r.n for r in linededup.drop_boilerplate(frame).select("doc_id", F.length("text").alias("n")).collect()}
    assert out[1] == len(long) - len("\nmenu")
    assert [(r.doc_id, r.rule) for r in licenses.scan(frame).collect()] == [(1, "all-rights-reserved")]
    pages = frame.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert {r.page_id: r.payload_bytes for r in warc.round_trip(pages).collect()}[1] == len(long)
