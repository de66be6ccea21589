"""Embedding dedup, WARC archives and the pipeline."""

import hashlib
import io
import json
import math
import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ratewise.llm import components, metricjoin, neardup, packing, warc
from ratewise.session import scratch_path
from tests.llm.test_documents import SCHEMA, check_pieces

SF = "/root/testdata/sf0.001"


def brute_vectors(rows):
    root = {k: k for k, *_ in rows}
    links = dict.fromkeys(root, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    for i, (a, va, la) in enumerate(rows):
        for b, vb, lb in rows[i + 1:]:
            if la is not None and la == lb and good(va) and good(vb) and len(va) == len(vb):
                x, y = np.float32(va).astype(float), np.float32(vb).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {k: (links[k], find(k)) for k in root}


def test_metric_join_matches_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(metricjoin, "PER_PIVOT", 12)
    monkeypatch.setattr(metricjoin, "DEAL", 60)
    monkeypatch.setattr(metricjoin, "BLOCK", 16)
    rnd = np.random.default_rng(1)
    rows, k = [], 0
    for label in (0, 1, 1, 1):
        centres = rnd.normal(size=(12, 8))
        for _ in range(70):
            c = centres[rnd.integers(12)]
            rows.append((k := k + 1, [float(x) for x in c + rnd.normal(size=8) * rnd.choice([0.0, 0.1, 0.3])], label))
    rows += [(1000 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.5], 1) for i in range(60)]  # copies
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [float("nan")] * 8, 1), (2004, [None] + [1.0] * 7, 1),
             (2005, [1.0] * 8, None), (2006, [1.0] * 8, None), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (2009, [float("inf")] * 8, 1),
             (2010, [1e30] * 8, 7), (2011, [1e-30] * 8, 7)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, label int, kept string, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in metricjoin.near_duplicates(df).collect()}
    assert got == brute_vectors(rows)
    null_key = metricjoin.near_duplicates(spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1)], "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in null_key), key=str) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert metricjoin.near_duplicates(df.limit(0)).count() == 0


def test_vectors_are_compared_in_double_precision(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1e300, 0.0], 1), (3, [1e-60, 0.0], 1), (4, [2e-60, 1e-70], 1), (5, [0.0, 1.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in metricjoin.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


def test_cells_take_what_their_radius_and_border_allow(spark, monkeypatch):
    """In many dimensions borders alone keep almost nothing out of a cell."""
    monkeypatch.setattr(metricjoin, "PER_PIVOT", 16)
    rnd = np.random.default_rng(5)
    centres = metricjoin.unit(rnd.normal(size=(24, 64)))
    x = metricjoin.unit(centres[rnd.integers(24, size=600)] + rnd.normal(size=(600, 64)) * 0.02)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in metricjoin.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == brute_vectors(rows)
    p = x[:24]
    far = np.maximum(2 - 2 * x @ p.T, 0)
    radius = np.array([np.sqrt(far.min(axis=1)[far.argmin(axis=1) == j].max(initial=0)) for j in range(24)])
    both = metricjoin.border(far, p, 0.2) & (far <= (radius + 0.2) ** 2 + metricjoin.SLACK)
    assert both.sum() < 0.7 * metricjoin.border(far, p, 0.2).sum()


def test_border_copies_every_near_vector():
    rnd = np.random.default_rng(2)
    p = metricjoin.unit(rnd.normal(size=(9, 5)))
    x = metricjoin.unit(rnd.normal(size=(300, 5)))
    y = metricjoin.unit(x + rnd.normal(size=x.shape) * 0.06)
    r = math.sqrt(2 - 2 * 0.98)
    near = np.linalg.norm(x - y, axis=1) <= r
    home = (2 - 2 * x @ p.T).argmin(axis=1)
    inside = metricjoin.border(2 - 2 * y @ p.T, p, r)
    assert near.sum() > 100 and inside[np.arange(300), home][near].all()


def test_components_of_paths_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain + star + [(5000, 5000)], "a long, b long")
    got = {r.node: r.root for r in components.components(df, "a", "b").collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1300)}
    assert components.components(df.limit(0), "a", "b").count() == 0


PAGES = [(5, "http://a", "x" * 100), (2, "http://b", "x" * 100), (9, None, "x" * 100), (1, "u", "y" * 99), (3, "u", "y" * 99), (4, "u", None), (6, "u", ""),
         (7, "line\r\nbreak: yes", "é" * 50), (8, "u", "é" * 50 + "\r\n\r\nWARC/1.1\r\n"), (2, "http://b", "x" * 100), (None, "n", "x" * 100)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    first = {}
    for page, _, html in PAGES:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        again = len(body) >= 100 and page != first[body]
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_reader_pushes_filters_and_splits(spark):
    path = scratch_path(spark, "warc-test")
    df = spark.range(300).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(concat(id % 250, ' '), 60) AS html")
    warc.write(warc.page_records(df), path)
    everything = warc.read(spark, path)
    assert everything.count() == 300 and everything.where("record_type = 'revisit'").count() == 50
    columns = "record_id string, record_type string, payload_bytes long"
    narrow = warc.read(spark, path, columns).where("record_type = 'revisit' AND payload_bytes > 150")
    assert narrow.count() == everything.where("record_type = 'revisit' AND payload_bytes > 150").count() > 0
    reader = warc.WarcReader(everything.schema, {"path": path, "splitBytes": "1"})
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringContains
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 150), StringContains(("target_uri",), "h"), EqualTo(("payload",), "x")]))
    assert [type(f).__name__ for f in left] == ["StringContains", "EqualTo"] and len(reader.tests) == 2
    rows = [r for part in reader.partitions() for r in reader.read(part)]
    assert len(rows) == narrow.count()


def test_unwanted_payloads_are_not_inflated():
    class Counting(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            self.got += len(data)
            return data
    body = os.urandom(400_000).hex()
    row = {c: None for c in warc._HEADERS} | {"record_id": "<urn:page:1>", "record_type": "response", "payload": body}
    data = warc.record(row) * 5
    assert zlib.decompress(data, 47)  # each member is ordinary gzip
    f = Counting(data)
    assert not list(warc.records(f, 0, len(data), lambda r: r["record_type"] == "revisit", True)) and f.got < 20_000
    whole = list(warc.records(io.BytesIO(data), 0, len(data), lambda r: True, True))
    assert len(whole) == 5 and all(p == body for _, p in whole)
    headers = list(warc.records(f, 0, len(data), lambda r: True, False))
    assert [r["content_length"] for r, _ in headers] == [800_000] * 5 and f.got < 40_000


def test_uncommitted_archives_are_not_read(spark):
    path = scratch_path(spark, "warc-lost")
    df = spark.range(20).selectExpr("id AS page_id", "'u' AS url", "'text' AS html")
    warc.write(warc.page_records(df), path)
    folder = warc._local(path)
    with open(os.path.join(folder, "part-lost.warc.gz"), "wb") as f:
        f.write(b"half a record")
    assert warc.read(spark, path).count() == 20
    with open(os.path.join(folder, warc.MANIFEST)) as f:
        assert all(x["name"] != "part-lost.warc.gz" for x in json.load(f)["files"])


# ---- pipeline

def test_pipeline_stages_against_plain_versions(spark):
    rows = []
    for i in range(40):
        own = " ".join(f"{w}{i}" for w in "the quick brown fox jumps over a lazy dog near my house".split())
        rows.append((i, f"menu home about\n{own} and the and of the\n", "en", "site", 0))
    rows += [(100, rows[3][1], "en", "site", 0), (101, rows[3][1], "en", "site", 0), (102, None, "en", "site", 0), (103, "123 456", "en", "site", 0),
             (104, "menu home about", "en", "site", 0), (105, "some words that the have no language of", None, "other", 0), (None, "the unnamed and the words", "en", "other", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "source_mixing", "packing"]
    step = stages["language_id"](spark, df, "")
    assert step.columns == corpus_pipeline.COLUMNS
    kept = {r.doc_id: r for r in step.collect()}
    assert set(kept) == {r[0] for r in rows} - {102, 103} and kept[105].lang == "en"
    step = stages["line_dedup"](spark, step, "")
    lines = {r.doc_id: r for r in step.collect()}
    assert set(lines) == set(kept) - {104} and all("menu" not in r.text and r.n_chars == len(r.text) for r in lines.values())
    step = stages["near_dedup"](spark, step.union(step.where("doc_id = 7")), "")
    near = [r.doc_id for r in step.collect()]
    assert sorted(near, key=str) == sorted(set(lines) - {100, 101}, key=str) and near.count(7) == 1
    mixed = stages["source_mixing"](spark, step, "")
    assert mixed.columns == corpus_pipeline.COLUMNS and 0 < mixed.count() <= step.count()
    out = stages["packing"](spark, mixed, "")
    check_pieces([(r.doc_id, r.text) for r in mixed.collect()], out.collect())


def test_pipeline_on_empty_and_unlabelled_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
    plain = spark.createDataFrame([(1, "some words", None, None, 0)], SCHEMA)
    assert corpus_pipeline.language_id(spark, plain, "").count() == 1


def test_pipeline_runs_on_the_given_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = out.collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert any(x.startswith(f"op{n}_") for x in names), n
    assert "pipeline" in names
    assert neardup.PERCENT == 80 and packing.CAPACITY == 2048


# ---- any archive

def warc_text(kind, body, headers=()):
    head = [b"WARC/1.0", f"WARC-Type: {kind}".encode(), b"WARC-Record-ID: <urn:uuid:" + kind.encode() + b">",
            b"WARC-Target-URI: http://example.org/", *headers, b"Content-Length: " + str(len(body)).encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_archives_of_others_are_read(spark, tmp):
    import gzip
    body = "HTTP/1.1 200 OK\r\n\r\n<html>é</html>".encode() + b"x" * 200_000
    parts = [warc_text("warcinfo", b"software: x"), warc_text("response", body), warc_text("request", b"GET /"), warc_text("response", b""),
             warc_text("metadata", b"\xff\xfe", [b"WARC-Date: 2020-01-01T00:00:00Z", b"X-Long: " + b"y" * 5000])]
    os.makedirs(f"{tmp}/any/below")
    with open(f"{tmp}/any/plain.warc", "wb") as f:
        f.write(b"".join(parts))
    with open(f"{tmp}/any/below/members.warc.gz", "wb") as f:  # a member for each record, as public crawls have
        f.write(b"".join(gzip.compress(p) for p in parts))
    with open(f"{tmp}/any/one.warc.gz", "wb") as f:  # all in one member
        f.write(gzip.compress(b"".join(parts)))
    with open(f"{tmp}/any/empty.warc", "wb") as f:
        pass
    df = warc.read(spark, f"{tmp}/any")
    assert df.rdd.getNumPartitions() == 4 and df.count() == 15
    got = df.where("record_type = 'response'").collect()
    assert len(got) == 6 and {len(r.payload) for r in got} == {0, len(body.decode())} and {r.target_uri for r in got} == {"http://example.org/"}
    assert {r.payload for r in df.where("record_type = 'metadata'").collect()} == {"\ufffd\ufffd"}
    narrow = warc.read(spark, f"{tmp}/any", "record_type string, content_length long").where("content_length > 100000").collect()
    assert [r.content_length for r in narrow] == [len(body)] * 3
    assert warc.read(spark, f"{tmp}/any/plain.warc").count() == 5


@pytest.mark.parametrize("fault", ["cut", "member", "crc", "junk", "no blank", "no length"])
def test_damaged_archives_raise(spark, tmp, fault):
    import gzip
    good = gzip.compress(warc_text("response", b"payload " * 500))
    data = {"cut": warc_text("response", b"payload")[:-9], "member": good + good[:-30], "crc": good[:-8] + b"\0\0\0\0" + good[-4:],
            "junk": b"hello world, no record at all", "no blank": b"WARC/1.0\r\nWARC-Type: response\r\n",
            "no length": b"WARC/1.0\r\nWARC-Type: response\r\n\r\n"}[fault]
    os.makedirs(f"{tmp}/bad")
    with open(f"{tmp}/bad/x.warc" + (".gz" if fault in ("member", "crc") else ""), "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="archive ends|damaged gzip|not a WARC|no Content-Length"):
        warc.read(spark, f"{tmp}/bad").collect()


def test_own_archives_are_checked():
    row = {c: None for c in warc._HEADERS} | {"record_id": "<urn:page:1>", "record_type": "response", "payload": "hello " * 100}
    data = bytearray(warc.record(row))
    every = lambda d: list(warc.records(io.BytesIO(bytes(d)), 0, len(d), lambda r: True, True))
    assert every(data)[0][1] == "hello " * 100
    wrong = data.copy()
    wrong[-6] ^= 1  # the checksum
    cut = data[:-40]
    block = b"WARC/1.1\r\nno blank line"
    pack = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = pack.compress(block) + pack.flush()
    endless = (warc._HEAD.pack(b"\x1f\x8b\x08\x04", 0, 0, 255) + warc._EXTRA.pack(12, b"sl", 8, 10 + warc._EXTRA.size + len(body) + 8, len(block))
               + body + b"\0" * 8)
    for bad, said in ((wrong, "checksum"), (cut, "ends within"), (endless, "blank line"), (data[:5], "ends within")):
        with pytest.raises(ValueError, match=said):
            every(bad)
