"""The pipeline's stages on a small corpus, against plain versions."""

from __future__ import annotations

import random
from collections import defaultdict

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from talkgrain.llm import mixing

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(9)
    place = str(tmp_path_factory.mktemp("sf"))
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared, item = line(20), line(14)
    rows = [(k, "\n".join([line(25), *([shared] if k % 6 == 0 else []), line(25), *([f"{line(5)} {item} {line(5)}"] if k % 7 == 0 else [])]), "en", f"s{k % 4}") for k in range(60)]
    rows += [(100, rows[1][1], "en", "s1"), (101, rows[2][1].replace("e", "E"), "en", "s1"), (102, "too short", "en", "s0"), (103, "again " * 60, "en", "s0"), (104, None, "en", "s0"), (105, "", None, None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place, rows, item, shared


def test_stages(spark, folder):
    place, rows, item, shared = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    before = {d: t for d, t, *_ in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, place)
        assert docs_after.columns == docs.columns, name
        after = {r.doc_id: r.text for r in docs_after.collect()}
        assert all(r.n_chars == len(r.text) for r in docs_after.collect() if r.text is not None)
        if name == "quality_rules":
            assert set(before) - set(after) == {102, 103, 104, 105}
        elif name == "line_dedup":
            gone = brute.deleted_lines(list(before.items()), 10)
            wanted = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone.get(d, []))) for d, t in before.items()}
            assert after == {d: t for d, t in wanted.items() if brute.words(t)} and 100 not in after
        elif name == "near_duplicates":
            assert set(before) - set(after) == {101}
        elif name == "decontamination":
            assert set(after) == set(before) and not any(item in t for t in after.values())
        before, docs = after, spark.createDataFrame(docs_after.collect(), docs.schema)
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, place).collect()
    total = sum(len(brute.words(t)) for t in before.values())
    assert abs(sum(r.taken_words for r in mix) - 1.5 * total) <= 4
    assert [r.position for r in mix] == sorted(r.position for r in mix)


def _plain(rows, item):
    """What is left after each of the first four stages, one after the other, by plain versions."""
    docs = {d: t for d, t, *_ in rows if brute.good_text(t)}
    gone = brute.deleted_lines(list(docs.items()), 10)
    docs = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone.get(d, []))) for d, t in docs.items()}
    docs = {d: t for d, t in docs.items() if brute.words(t)}
    groups = brute.near_duplicates(list(docs.items()), 5, (4, 5))
    docs = {d: t for d, t in docs.items() if groups[d][1] == d}
    docs = {d: brute.without_hits(t, [(1, item)]) for d, t in docs.items()}
    return {d: t for d, t in docs.items() if t is not None}


def test_run(spark, folder):
    """The whole run against the chain of plain versions, and the mix against its SQL."""
    place, rows, item, _ = folder
    wanted, sources = _plain(rows, item), {r[0]: r[3] for r in rows}
    found = corpus_pipeline.run(spark, place).collect()
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d, t, sources[d]) for d, t in wanted.items()])
        taken = {d: n for d, n in db.sql(f"SELECT doc_id, taken FROM ({mixing.ORACLE_SQL})").fetchall() if n}
    total = defaultdict(int)
    for r in found:
        total[r.doc_id] += r.taken_words
    assert dict(total) == taken and len(wanted) > 50
    for r in found:
        assert wanted[r.doc_id].startswith(r.text) or r.text == wanted[r.doc_id]


def test_run_of_odd_tables(spark, folder, tmp_path):
    """Null and repeated ids, repeated rows, columns with names that the stages use themselves, and nothing at all."""
    place, rows, _, _ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    odd = docs.where("doc_id < 3").withColumn("doc_id", F.lit(None).cast("long")).union(docs.where("doc_id = 4").withColumn("doc_id", F.lit(5).cast("long"))).union(docs.where("doc_id = 9"))
    extra = ("_hash", "_gone", "copy", "_spans", "_items", "_key", "taken", "rank")
    docs = docs.union(odd).select("*", *(F.lit(k).alias(c) for k, c in enumerate(extra)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{place}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        read = stage(spark, read, str(tmp_path))
        assert read.columns == docs.columns, name
        read = spark.createDataFrame(read.collect(), docs.schema)
    ids = [r.doc_id for r in read.collect()]
    assert len(set(ids) - {None}) == len([i for i in ids if i is not None]) and all(r[c] == k for r in read.collect() for k, c in enumerate(extra))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
