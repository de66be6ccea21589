"""The document operators on small tables: nulls, empty and long texts, ties, repeated rows, empty
tables and clashing columns, and against brute-force versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ratewise.llm import langid, licenses, linededup, mixing, neardup, orderminhash, packing, quality
from ratewise.llm.queries import PIECES, WORD_TOKENIZER

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """rows of (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [(1, None), (2, ""), (3, " \n\t"), (2**60 + 1, "one two three four five six"), (None, "one two three four five six"),
       (5, "one two three four five six"), (5, "one two three four five six"), (6, "1234 5678 !!!"), (7, "x" * 70000 + " y " * 30000)]


# ---- line dedup

def brute_lines(rows):
    pages, total = {}, {}
    for _, text, source in rows:
        total[source] = total.get(source, 0) + 1
        for line in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            pages[source, line] = pages.get((source, line), 0) + 1
    gone = {k for k, n in pages.items() if n >= linededup.MIN_PAGES and n > total[k[0]] * linededup.RATIO}
    return sorted((i is None, i, s, None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in gone))
                  for i, t, s in rows)


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, "\n".join(rnd.choice(["menu", " menu\r", "home", f"text {i}", f"text {i % 7}", "", "  "]) for _ in range(6)), rnd.choice(["a", "a", "b", None]))
            for i in range(80)] + [(90, None, "a"), (91, "", "a"), (92, "menu", "rare"), (92, "menu", "rare"), (None, "menu\nx", "a")]
    df = spark.createDataFrame([(i, t, s, 7, 7) for i, t, s in rows], "doc_id long, text string, source string, n_lines int, n_dropped int")
    out = linededup.drop_boilerplate(df)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    got = sorted((r.doc_id is None, r.doc_id, r.source, r.text) for r in out.collect() if r.doc_id is not None)
    assert got == sorted(x for x in brute_lines(rows) if x[1] is not None)
    assert linededup.drop_boilerplate(df.limit(0)).count() == 0


# ---- licences

def test_licences_by_rule(spark):
    mit = licenses.SENTENCES["mit.grant"].capitalize() + ".\n\n" + licenses.SENTENCES["mit.keep"].title() + "."
    header = "\n".join(["Licensed under the Apache License, Version 2.0 (the \"License\");", "you may not use this file except in",
                        "compliance with the License.", "You may obtain a copy of the License at:", "",
                        licenses.SENTENCES["apache2.asis"] + ".", "See the License for the specific language governing permissions and limitations under the License."])
    turned = licenses.SENTENCES["mit.keep"] + ". " + licenses.SENTENCES["mit.grant"] + "."
    rows = [(1, mit), (2, "Released under the MIT License."), (3, "no stop here\nAll rights reserved.\nmore"), (4, header), (5, turned),
            (6, "Unlicensed under nothing."), (7, None), (8, ""), (9, "ALL RIGHTS RESERVED! Licensed under CC BY-NC 4.0.")]
    got = {(r.doc_id, r.rule) for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == {(1, "mit-text"), (2, "mit-notice"), (3, "all-rights-reserved"), (4, "apache2-header"), (9, "all-rights-reserved"), (9, "cc-by-nc-4-notice")}
    assert licenses.scan(docs(spark, rows).limit(0)).count() == 0
    twice = licenses.scan(docs(spark, rows[1:2] * 3).withColumnRenamed("lang", "licence"))
    assert twice.count() == 3 and twice.columns.count("licence") == 1
    assert {tuple(r.licences) for r in licenses.licences_of(licenses.scan(docs(spark, rows)), "doc_id").collect()} >= {("MIT",)}


# ---- mixing

def test_mixing_meets_the_targets(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(1, 40), rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["a", "a", "a", "b", "c"])) for i in range(1500)]
    out = [r for r in mixing.mix(docs(spark, rows + [(9000, None), (9001, " ")]).withColumn("topic", mixing.F.lit("clash")), sweeps=4).collect()]
    share = {}
    for r in out:
        for dim in ("source", "lang"):
            share.setdefault((dim, r[dim]), [0.0, 0.0])
            share[dim, r[dim]][0] += r.tokens
            share[dim, r[dim]][1] += r.tokens * r.factor
    for dim in ("source", "lang"):
        own = {k[1]: v for k, v in share.items() if k[0] == dim}
        flat = sum(v[0] ** mixing.TEMPERATURE[dim] for v in own.values())
        total = sum(v[0] for v in own.values())
        for v in own.values():
            assert v[1] == pytest.approx(v[0] ** mixing.TEMPERATURE[dim] / flat * total, rel=2e-2)
    assert max(r.p for r in out) == pytest.approx(1.0) and all(r.sampled is False for r in out if r.tokens == 0)
    assert mixing.mix(docs(spark, rows).limit(0), sweeps=1).count() == 0
    same = mixing.mix(docs(spark, [(4, "a b")] * 20 + [(5, "c d", "de", "b")]), sweeps=1).collect()
    assert len({r.sampled for r in same if r.doc_id == 4}) == 1 and len(same) == 21


# ---- near duplicates

def brute_components(rows, words):
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
        sets[i] = {tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup_matches_brute_force_on_a_hot_family(spark):
    """A family of near copies far larger than a large region, with members at all distances."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rnd.choice(vocabulary) for _ in range(160)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randint(0, 14)):
            w[rnd.randrange(160)] = rnd.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:100] + [rnd.choice(vocabulary) for _ in range(60)])) for i in range(60)]  # a shared passage
    rows += [(2000 + i, " ".join(base)) for i in range(50)] + [(3000 + i, "") for i in range(5)] + [(4000, "a b"), (4001, "A  b"), (4002, "b a")]
    rnd.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_components(rows, 4)


def test_near_dedup_odd_rows(spark):
    got = neardup.near_duplicates(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(3, 5, True)] * 2 and by[2**60 + 1] == [(3, 5, False)] and by[None] == [(3, None, True)]
    assert by[7][0][0] == 2  # (x, y, y, y) and (y, y, y, y)
    # a key with two texts links what is like either
    two = neardup.near_duplicates(docs(spark, [(1, "a b c d"), (1, "e f g h"), (2, "a b c d"), (3, "e f g h"), (4, "z")])).collect()
    assert {(r.doc_id, r.component_id) for r in two} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert neardup.near_duplicates(docs(spark, ODD).limit(0)).count() == 0


def test_block_overlaps_are_intersections():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 300, n)) for n in (0, 1, 50, 120, 200, 90)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[3:]] for a in sets[:3]]
    assert neardup.overlaps(sets[:3], sets[3:], width=32).tolist() == want


# ---- packing

def check_pieces(rows, out):
    tok = Tokenizer.from_file(WORD_TOKENIZER)
    want = {}
    for i, text in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(i, []).append(ids)
    by, windows = {}, {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    assert set(by) == set(want)
    for i, pieces in by.items():
        got = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
        assert got == sorted((s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)) for ids in want[i] for s in range(0, len(ids), 2048))
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return sum(p.length for p in out) / (2048 * len(windows))


def test_packing_round_trip(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["Über", "don't", "cat,", "x%%%", "日本語", "a1b2", "ΑΣ", "İstanbul", "<|endoftext|>", "été", " x", "y\x1cz"])
                         for _ in range(rnd.randint(0, 900)))) for i in range(400)]
    rows += [(i, t) for i, t in ODD]
    out = packing.pack(docs(spark, rows), WORD_TOKENIZER).collect()
    assert check_pieces(rows, out) > 0.98
    assert packing.pack(docs(spark, rows).limit(0), WORD_TOKENIZER).count() == 0


def test_fill_reaches_the_best_sum():
    rnd = random.Random(6)
    for _ in range(200):
        counts = {rnd.randint(1, 40): rnd.randint(1, 3) for _ in range(6)}
        target = rnd.randint(1, 100)
        used = packing.fill(counts, target)
        assert all(0 < k <= counts[x] for x, k in used.items())
        reach = {0}
        for x, n in counts.items():
            reach = {r + k * x for r in reach for k in range(n + 1) if r + k * x <= target}
        assert sum(x * k for x, k in used.items()) == max(reach)


# ---- language

def test_language_accuracy_on_held_out_documents(spark):
    out = {r.doc_id: r for r in entry.queries()["op6_language_id"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [i for i in out if out[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert sum(out[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)


def test_language_odd_rows(spark):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 3)]
    model = langid.fit(docs(spark, train + [(70, "no language", None), (71, None, "fr"), (None, "x", "xx")]), PIECES)
    assert model.langs == ["de", "en"]
    odd = ODD + [(8, "und der und die"), (9, "²½ 12")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs(spark, odd), model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 6, 9)) and got[8][0] == "de" and got[5][0] == "en"
    assert 2**60 + 1 in got and None in got and all(0 <= s <= 1 for _, s in got.values())
    none = langid.fit(docs(spark, train).limit(0), PIECES)
    assert {r.lang_pred for r in langid.identify(docs(spark, odd), none).collect()} == {"und"}
    clash = langid.identify(docs(spark, odd).withColumnRenamed("source", "score"), model, keep=["doc_id", "score", "text"])
    assert clash.columns == ["doc_id", "text", "lang_pred", "score"] and clash.count() == len(odd)
    assert langid.identify(docs(spark, odd).limit(0), model).count() == 0


def test_forward_sums_all_segmentations():
    pieces = {"a": 0, "b": 1, "ab": 2, "ba": 3, "▁": 4, "▁a": 5}
    p = np.concatenate([np.random.default_rng(7).random((6, 2)), [[0, 0], [1e-7, 1e-7]]])

    def brute(word, lang):
        if not word:
            return 1.0
        total = sum(p[pieces[word[:k]], lang] * brute(word[k:], lang) for k in range(1, len(word) + 1) if word[:k] in pieces)
        return total + (1e-7 * brute(word[1:], lang) if word[0] not in pieces else 0)
    words = ["▁abab", "▁bacb", "▁aaaa"]
    got = langid.Lattice(words, langid.Pieces(pieces)).forward(p)[:, -1]
    assert np.allclose(got, [[brute(w, 0), brute(w, 1)] for w in words])


# ---- fingerprints

def test_fingerprints_follow_the_order(spark):
    rows = [(3, "c" * 5), (1, "The quick brown fox jumps over the lazy dog. " * 20), (2, "Pack my box with five dozen jugs. " * 9),
            (4, None), (5, "\U0001F600é" * 40), (6, "Pack my box with five dozen jugs. " * 9), (2**60, "last one")]
    got = {r.doc_id: r for r in orderminhash.fingerprints(docs(spark, rows)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == orderminhash._hex(orderminhash.fingerprint(text))
        assert got[i].edited_fingerprint == orderminhash._hex(orderminhash.fingerprint(edited))
    assert got[2].fingerprint == got[6].fingerprint
    single = orderminhash.fingerprints(docs(spark, [(1, "abcdef")])).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert orderminhash.fingerprints(docs(spark, rows).limit(0)).count() == 0
    assert orderminhash.fingerprints(docs(spark, ODD)).count() == len(ODD)


def test_fingerprints_are_sensitive_to_edits_and_order():
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(300)]
    text = " ".join(words)
    f = orderminhash.fingerprint(text)
    few = list(words)
    few[150] = "zzzzzz"
    turned = words[150:] + words[:150]
    near, moved = (orderminhash.likeness(f, orderminhash.fingerprint(" ".join(w))) for w in (few, turned))
    assert near > 0.85 and 0.2 < moved < near
    assert orderminhash.likeness(f, orderminhash.fingerprint(" ".join(sorted(words)))) < moved


# ---- quality

def test_quality_agrees_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in entry.queries()["op2_quality"](spark, sf).collect()}
    truth = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    good = [out[i].kept for i, q in truth if q == 1]
    bad = [out[i].kept for i, q in truth if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_quality_odd_rows(spark):
    out = quality.classify(docs(spark, ODD + [(10 + i, "A sentence of the usual kind, not too long. And one more.") for i in range(20)])).collect()
    assert len(out) == len(ODD) + 20
    by = {r.doc_id: r for r in out}
    assert not any(by[i].kept for i in (1, 2, 3, 6)) and all(0 <= r.score <= 1 for r in out)
    assert quality.classify(docs(spark, ODD).limit(0)).count() == 0
    assert quality.label_model({}) == ({}, [])
