"""Transaction logs, fingerprints and Merkle manifests against plain versions, and on edge cases."""

from __future__ import annotations

import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from talkgrain.llm import merkle, queries, scan, simhash, txlog

LOG = "seq bigint, stream string, op string, key bigint, value bigint"


def _log(rnd, n, streams, weights):
    ops = rnd.choices(txlog.OPS, weights, k=n)
    return [(seq * 3 - 40, rnd.choice(streams), op, rnd.randint(0, 9) if op == "change" else None, rnd.choice([None, 1, 2, 3]) if op == "change" else None) for seq, op in enumerate(ops)]


@pytest.mark.parametrize(("streams", "weights"), [(["a", "b", None], (2, 1, 2, 2, 10)), ([None], (1, 1, 30, 30, 60)), (["a"], (0, 0, 5, 1, 9)), (["a", ""], (1, 0, 3, 8, 8))])
def test_log_is_resolved(spark, streams, weights):
    rows = _log(random.Random(len(streams)), 240, streams, weights)
    fates, states, store = brute.transaction_log(rows, 5)
    changes, commits = txlog.resolve(spark.createDataFrame(rows, LOG).repartition(3), chunk_bits=4, scan_bits=3)
    assert {r.seq: (r.fate, r.by) for r in changes.collect()} == fates
    found = txlog.epoch_states(changes, commits, per_epoch=5, scan_bits=3).orderBy("epoch").collect()
    assert [(r.n, r.total) for r in found] == states and [r.epoch for r in found] == list(range(1, len(states) + 1))
    assert {r.key: r.value for r in txlog.final_store(changes).collect()} == store


def test_log_edges(spark):
    rows = [(None, "a", "commit", None, None), (1, "a", "change", None, 7), (1, "a", "change", None, 7), (2, "a", "nonsense", 1, 1), (2, None, "change", 5, 1), (3, "a", "rollback", None, None), (4, "a", "change", None, 9), (5, "a", "commit", None, None), (2**62, None, "commit", None, None)]
    df = spark.createDataFrame(rows, LOG).withColumn("place", F.lit(1)).withColumn("chunk", F.lit(2)).withColumn("txn", F.lit(3)).withColumn("number", F.lit(4)).withColumn("_s", F.lit("x"))
    changes, commits = txlog.resolve(df)
    assert sorted((r.seq, r.fate, r.by) for r in changes.collect()) == [(1, "rollback", 3), (1, "rollback", 3), (2, "commit", 2**62), (4, "commit", 5)]
    assert [tuple(r) for r in txlog.epoch_states(changes, commits, per_epoch=1).orderBy("epoch").collect()] == [(1, 1, 9), (2, 2, 10)]
    assert {(r.key, r.value, r.seq) for r in txlog.final_store(changes).collect()} == {(None, 9, 4), (5, 1, 2)}
    changes, commits = txlog.resolve(df.limit(0))
    assert changes.isEmpty() and txlog.epoch_states(changes, commits).isEmpty() and txlog.final_store(changes).isEmpty()


def test_log_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    records = brute.document_records(docs, labels)
    fates, states, _ = brute.transaction_log(records)
    keys = {r[0]: r[3] for r in records}
    wanted = [("state", k, *s) for k, s in enumerate(states, 1)] + [(f, seq, by, keys[seq]) for seq, (f, by) in fates.items() if f != "commit"]
    found = queries.op11_transaction_log(spark, sf)
    assert found.columns == ["kind", "id", "n", "value"]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, wanted))


def test_ranked_and_scanned(spark, monkeypatch):
    monkeypatch.setattr(scan, "SORTED_ROWS", 7)
    rows = spark.createDataFrame([("ab"[k % 3 == 0], k * 37 % 100 if k % 5 else None) for k in range(100)], "g string, v long")
    places = scan.ranked(rows, ["g"], ["v"], 100, bits=2)
    for g in "ab":
        own = [(r.pos, r.v) for r in places.where(F.col("g") == g).orderBy("pos").collect()]
        assert [p for p, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted((v for _, v in own), key=lambda v: (v is not None, v))


def _near(rnd, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"n{rnd.randint(0, 99)}"
    return " ".join(words)


def test_fingerprints(spark):
    rnd = random.Random(5)
    texts = [None, "", " \n", "One", "one TWO", "Ünï çode Words here", " ".join(f"w{k % 7}" for k in range(40_000)), *(" ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 60))) for _ in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(df).collect()} == {k: brute.fingerprint(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("tile", [2, 2048])
def test_close_fingerprints(spark, tile):
    rnd = random.Random(7)
    base = [[f"w{rnd.randint(0, 500)}" for _ in range(80)] for _ in range(6)]
    texts = [_near(rnd, rnd.choice(base), rnd.choice([0, 1, 1, 2, 9])) for _ in range(150)] + [None, "", "a", "A", " ".join(base[0])]
    rows = list(enumerate(texts)) + [(None, texts[0]), (3, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("fp", "class", "part", "component", "_id")))
    prints = [(i, brute.fingerprint(t)) for i, t in rows if i is not None]
    wanted = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute.close_fingerprints(prints), strict=True)] + [(None, f"{brute.fingerprint(texts[0]):016x}", None)]
    found = simhash.simhash(df, tile=tile)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted)) and len({c for *_, c in wanted}) < 140
    assert simhash.simhash(df.limit(0)).isEmpty()


def test_links_of_random_fingerprints(spark):
    """Chains of links, over classes that differ."""
    rnd = random.Random(9)
    prints = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        p = rnd.choice(prints)
        for b in rnd.sample(range(64), rnd.choice([1, 2, 3])):
            p ^= 1 << b
        prints.append(p)
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    for tile in (1, 64):
        reached = {r.node % 2**64: r.component for r in simhash.components(simhash.linked(nodes, 2, tile)).collect()}
        classes = {}
        for p, c in zip(prints, brute.close_fingerprints([(k, p) for k, p in enumerate(prints)]), strict=True):
            classes.setdefault(c, set()).add(reached.get(p, p))
        assert all(len(v) == 1 for v in classes.values()) and len({x for v in classes.values() for x in v}) == len(classes)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def _rows(n, langs, rnd):
    return [(k * 5 % 997, rnd.choice(["s", None, "ü"]), rnd.choice(langs), rnd.choice([None, k]), rnd.choice([None, "", f"text {k} ä"])) for k in range(n)]


@pytest.mark.parametrize(("n", "langs"), [(1, ["en"]), (2, ["en", None]), (90, ["en", "de", "é", None, ""]), (40, [f"l{k}" for k in range(25)]), (300, ["x"])])
def test_manifest(spark, monkeypatch, n, langs):
    monkeypatch.setattr(scan, "SORTED_ROWS", 25)
    rows = _rows(n, langs, random.Random(n))
    rows += [(None, "s", langs[0], 3, "no id")] * 2 + rows[:1]
    df = spark.createDataFrame(rows, FIELDS).repartition(3).select("*", *(F.lit(1).alias(c) for c in ("pos", "tree", "block", "path", "leaf", "id")))
    found = merkle.digest(merkle.manifest(merkle.document_leaves(df)))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute.merkle(rows)))


def test_manifest_of_nothing_and_of_odd_numbers(spark):
    df = spark.createDataFrame([(1, None, None, 2**63 - 1, "x")], FIELDS)
    assert merkle.digest(merkle.manifest(merkle.document_leaves(df.limit(0)))).isEmpty()
    assert [tuple(r) for r in merkle.digest(merkle.manifest(merkle.document_leaves(df))).collect()] == brute.merkle([tuple(df.first())])


def test_manifest_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = [tuple(r) for r in queries.op13_merkle_manifest(spark, sf).collect()]
    assert sorted(found) == sorted(brute.merkle(rows)) and 0 < sum(not r[-1] for r in found) < len(found) / 3


def test_fingerprint_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    wanted = [(i, f"{p:016x}", c) for (i, p), c in zip(rows, brute.close_fingerprints(rows), strict=True)]
    assert sorted(tuple(r) for r in queries.op12_simhash(spark, sf).collect()) == sorted(wanted)


@pytest.mark.parametrize("name", ["op11_transaction_log", "op13_merkle_manifest"])
def test_sql(name):
    """The SQL against the plain versions."""
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    found = db.sql(queries.oracle_sql()[name]).fetchall()
    if name.startswith("op13"):
        wanted = brute.merkle(db.sql("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall())
    else:
        records = brute.document_records(db.sql("SELECT doc_id, text, source FROM documents").fetchall(), dict(db.sql("SELECT doc_id, toxic FROM labels").fetchall()))
        fates, states, _ = brute.transaction_log(records)
        wanted = [("state", k, *s) for k, s in enumerate(states, 1)] + [(f, r[0], fates[r[0]][1], r[3]) for r in records if r[0] in fates and (f := fates[r[0]][0]) != "commit"]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
