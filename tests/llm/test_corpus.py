"""Operators over whole corpora, against plain versions and on edge cases."""

from __future__ import annotations

import random
import time
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from talkgrain.llm import jaccard_join, line_dedup, mixing
from talkgrain.llm.common import cut
from talkgrain.llm.components import components
from talkgrain.llm.sampling import least_hashes, within


def _lines(rnd, n, pool, longest):
    return [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, longest)))) for k in range(n)]


def _deleted(spark, docs, min_words):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.d: list(r.lines) for r in line_dedup.deletions(df, min_words=min_words).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_line_runs(spark, seed):
    rnd = random.Random(seed)
    pool = ["a x y z", "b x y z", "", "c"] if seed == 1 else [" ".join(f"w{rnd.randint(0, 20)}" for _ in range(4)) for _ in range(9)]
    docs = _lines(rnd, 22, pool, 9) + [(100, None), (101, ""), (102, " \n ")]
    assert _deleted(spark, docs, 9) == brute.deleted_lines(docs, 9)


def test_line_runs_that_grow(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(line_dedup, "cut", lambda df, **k: cuts.append(k["name"]) or cut(df, **k))
    for docs in ([(k, "\n".join(["a b c"] * k)) for k in range(1, 14)], [(14 - k, "\n".join([*["a b c"] * k, f"x {k}"])) for k in range(1, 14)]):
        cuts.clear()
        assert _deleted(spark, docs, 6) == brute.deleted_lines(docs, 6)
        assert cuts.count("ranks") <= 6 and cuts.count("intervals") <= 4


def test_line_dedup_of_a_long_text(spark):
    lines = [f"line {k} of a long text with some words in it" if k % 5 else "- - - - - - - - - - -" for k in range(50_000)]
    names = ["_hash", "_d", "_gone", "_v", "line", "pos"]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "x y z"), (None, "x y z")], "doc_id long, text string").select("*", *(F.lit(7).alias(c) for c in names))
    began = time.time()
    out = line_dedup.dedup_lines(df)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == df.columns and all(r[c] == 7 for r in rows.values() for c in names)
    assert rows[1].text.split("\n") == [line for k, line in enumerate(lines) if k % 5 or not k]
    assert time.time() - began < 90


def test_line_dedup_edges(spark):
    run = "one two three four five six\nseven eight nine ten eleven"
    rows = [(1, f"first\n{run}\nlast", "a"), (2, f"{run}\n\nother end", "b"), (2, f"{run}\n\nother end", "b"), (3, None, "c"), (None, run, None), (4, "short\nshort", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, v string").withColumn("d", F.lit(5)).withColumn("rank", F.lit(1))
    out = line_dedup.dedup_lines(df, min_words=10)
    assert out.columns == df.columns and out.count() == len(rows)
    texts = defaultdict(set)
    for r in out.collect():
        texts[r.doc_id].add(r.text)
    assert texts == {1: {rows[0][1]}, 2: {"\nother end"}, 3: {None}, None: {run}, 4: {"short\nshort"}}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def _near(spark, docs, sim=None):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), sim).collect()}


def test_near_duplicates(spark):
    rnd = random.Random(7)
    bases = [[f"w{rnd.randint(0, 400)}" for _ in range(90)] for _ in range(5)]
    shared = " ".join(f"s{k}" for k in range(30))
    docs = []
    for k in range(110):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = f"z{rnd.randint(0, 60)}"
        docs.append((k, " ".join(words)))
    docs += [(200 + k, shared + " " + " ".join(f"u{rnd.randint(0, 9999)}" for _ in range(60))) for k in range(20)]
    docs += [(300, "a b"), (301, "A b"), (302, None), (303, " "), (304, "one"), (305, "")]
    assert _near(spark, docs) == brute.near_duplicates(docs)


def test_near_duplicates_inside_a_sole_group(spark):
    core, common = [f"core{k}" for k in range(40)], [f"c{k}" for k in range(160)]
    passages = [[*common[:20], *(f"{k}x{at}" for at in range(n)), *common[20 + n :]] for k, n in (("a", 60), ("b", 3), ("c", 3))]
    docs = [(k + 1, " ".join([*core, *p])) for k, p in enumerate(passages)]
    docs += [(100 + 10 * k + j, " ".join([*(f"own{k}-{j}-{at}" for at in range(200)), *p])) for k, p in enumerate(passages) for j in range(6)]
    wanted = brute.near_duplicates(docs)
    assert [wanted[k][1] for k in (1, 2, 3)] == [1, 2, 2]
    assert _near(spark, docs) == wanted


def test_near_duplicates_edges(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, "x " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("n"), F.lit(2).alias("key"), F.lit(3).alias("rep"), F.lit(4).alias("component"))
    found = [(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(df).collect()]
    assert sorted(found, key=str) == sorted([(1, 1), (1, 1), (2, 1), (None, None), (3, 3), (4, 4)], key=str)
    assert sorted(r.doc_id or 0 for r in jaccard_join.keep_one(df).collect()) == [0, 1, 3, 4]
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7), (5, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def _filled(sizes, share, cap):
    """Targets by filling sources up again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {s: 0.0 for s in order}, share * sum(sizes.values()), set(order)
    while free and left > 1e-9:
        total = sum(weights[s] for s in free)
        over = {s for s in free if target[s] + left * weights[s] / total >= cap * sizes[s] - 1e-9}
        given = {s: cap * sizes[s] - target[s] for s in over} if over else {s: left * weights[s] / total for s in free}
        for s, x in given.items():
            target[s] += x
        left -= sum(given.values())
        free -= over or free
    return target


def test_mixing_targets(spark):
    rnd = random.Random(8)
    docs = [(k, "w " * rnd.randint(0, 60), rnd.choice(["a", "b", "c", "d", "é", None, "tiny"] if k else ["tiny"])) for k in range(300)] + [(900, None, "a"), (901, "", "empty"), (902, "x y", "b"), (902, "x y z", "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("position", F.lit(0))
    rows = mixing.plan(df).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    of = {d: s for d, _, s in docs}
    for d, t, s in docs:
        sizes[s] += len(brute.words(t))
    for r in rows:
        taken[of[r.doc_id]] += r.taken
        target[of[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[of[r.doc_id]]
        assert r.taken == sum(p.words for p in r.passes) and [p.position for p in r.passes] == [p for p in (r.position, r.again_position) if p is not None]
        assert all(0 <= p.position <= 1 and 0 < p.words <= r.size for p in r.passes)
    wanted = _filled(sizes, 1.5, 2)
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s]) and abs(taken[s] - target[s]) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan(df.repartition(3)).collect()))
    assert mixing.plan(df.limit(0)).count() == 0


def test_mixing_sql(spark):
    docs = [(k, "w " * (k % 37), f"s{k % 5}") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    with duckdb.connect() as db:
        db.register("documents", df.toPandas())
        wanted = sorted(db.sql(mixing.ORACLE_SQL).fetchall())
    assert sorted(tuple(r) for r in mixing.plan(df).select("doc_id", "size", "source_size", "target", "taken", "position", "again_position").collect()) == wanted


def test_positions_invert_the_schedule(spark):
    docs = [(k, "w " * (5 + k % 7), f"s{k % 3}") for k in range(60)]
    sizes = {d: len(brute.words(t)) for d, t, _ in docs}
    of = {d: s for d, _, s in docs}
    slopes = {"s0": -0.5, "s1": 0.0, "s2": 0.5}
    rows = mixing.plan(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    steps = 20_000
    for s in slopes:
        own = [(p.copy, p.position, p.words, r.doc_id, r.target) for r in rows if of[r.doc_id] == s for p in r.passes]
        target, demand, before, at = own[0][4], 0.0, 0.0, 0
        ahead = sorted(own, key=lambda x: x[1])
        for k in range(steps):
            demand += target * (1 + slopes[s] * (2 * (k + 0.5) / steps - 1)) / steps
            while at < len(ahead) and demand >= before + ahead[at][2] / 2 - 1e-6:
                assert abs(ahead[at][1] - (k + 1) / steps) < 2e-3
                before += ahead[at][2]
                at += 1
        assert at == len(ahead) and [c for c, *_ in ahead] == sorted(c for c, *_ in ahead)
    assert all(p.words <= sizes[r.doc_id] for r in rows for p in r.passes)


def test_a_mix_of_rows_without_or_with_the_same_ids(spark):
    docs = [(None, "w " * 10, "a")] * 400 + [(None, f"v{k} w x", "a") for k in range(600)] + [(3, "w x y", "a"), (3, "w x y", "a"), (4, None, None), (5, "z " * 900, "b")]
    names = ["position", "_id", "copy", "_row", "taken_words", "Passes", "_size"]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").select("*", *(F.lit("own").alias(c) for c in names))
    out = mixing.materialised(df)
    assert out.columns == [*df.columns, "copy_", "taken_words_", "position_"]
    rows = out.collect()
    planned = mixing.plan(df).collect()
    assert sum(r.taken for r in planned) == sum(r.taken_words_ for r in rows) and sum(len(r.passes) for r in planned) == len(rows) <= 2 * len(docs)
    assert all(r[c] == "own" for r in rows for c in names)
    assert mixing.materialised(df.limit(0)).count() == 0
    with_other = mixing.plan(df.withColumnRenamed("doc_id", "key"), mixing.Mix(cap=3, share=2.8), id_col="key")
    assert mixing.ordered(with_other, "key").count() == len(docs) and with_other.agg(F.max(F.size("passes"))).first()[0] == 3


def test_mix_is_in_order(spark):
    docs = spark.createDataFrame([(k, "w " * 20, f"s{k % 3}", k) for k in range(90)], "doc_id long, text string, source string, copy_of long")
    rows = mixing.materialised(docs).collect()
    positions = [r.position for r in rows]
    assert positions == sorted(positions)
    mean = {s: sum(r.position for r in rows if r.source == s) / sum(r.source == s for r in rows) for s in ("s0", "s2")}
    assert mean["s0"] < mean["s2"]


def test_keep_one_loses_no_text(spark):
    """Texts that share an id are documents of their own; which rows stay does not depend on their order."""
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "wx")
    rows = [(1, a, "p"), (1, b, "q"), (2, b + " y", "r"), (3, a, "s"), (1, a, "t"), (1, a, "p"), (None, a, "u"), (5, None, "v"), (5, "", "w"), (6, "z", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string").withColumn("_key", F.lit(1))
    kept = [sorted(map(str, map(tuple, jaccard_join.keep_one(d, jaccard_join.Similarity(5, 4, 5, sketch_bits=bits)).collect()))) for d, bits in ((df, 9), (df.repartition(7), 20))]
    assert kept[0] == kept[1] and len(kept[0]) == 6
    assert [(r[0], r[1][:2]) for r in sorted(map(lambda x: (x.doc_id, x.text or "-"), jaccard_join.keep_one(df).collect()), key=str)] == [(1, "w0"), (1, "x0"), (5, "-"), (5, "-"), (6, "z"), (None, "w0")]
    assert jaccard_join.keep_one(df.limit(0)).isEmpty()


def test_order_without_a_cap(spark, monkeypatch):
    """However many shingles there are, what many documents share comes last in the order."""
    rnd = random.Random(2)
    shared = " ".join(f"s{k}" for k in range(60))
    docs = [(k, " ".join(f"u{rnd.randint(0, 10**9)}" for _ in range(40)) + " " + shared) for k in range(300)]
    real = jaccard_join.frequency_sketch
    low = real(spark.createDataFrame(docs, "doc_id long, text string"), "text", jaccard_join.Similarity())
    counts = [1, 2, 3, 500, 2**20, 2**21, 2**32, 2**45]
    assert (lambda x: x == sorted(set(x)))([int(v) for v in np.array(counts, np.uint64).astype(np.float32).view(np.uint32) >> np.uint32(11)])
    assert low.max() < 1 << 21 and len(set(low.tolist())) > 3
    assert _near(spark, docs) == {k: (98, k) for k, _ in docs}


def _in_a_flat_order(monkeypatch):
    """Let all shingles seem equally frequent: shared passages come early then, and lists are long."""
    monkeypatch.setattr(jaccard_join, "frequency_sketch", lambda docs, text_col, sim: np.zeros(1 << sim.sketch_bits, np.uint32))


@pytest.mark.parametrize("numerator, denominator", [(4, 5), (2, 5)])
def test_long_lists(spark, monkeypatch, numerator, denominator):
    """Lists in many chunks, members that meet by two shingles, and groups of several components lose no link."""
    _in_a_flat_order(monkeypatch)
    rnd = random.Random(numerator)
    passages = [" ".join(f"p{k}w{j}" for j in range(rnd.randint(4, 40))) for k in range(9)]
    docs = []
    for k in range(140):
        words = " ".join(rnd.sample(passages, rnd.randint(1, 5))).split()
        for _ in range(rnd.choice((0, 0, 1, 2))):
            words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 3)}"
        docs.append((k, " ".join(words[: rnd.choice((2, 3, 4, len(words), len(words)))])))
    sim = jaccard_join.Similarity(3, numerator, denominator, list_rows=4)
    assert _near(spark, docs, sim) == brute.near_duplicates(docs, 3, (numerator, denominator))


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """The order by frequency keeps a passage that all documents have out of their prefixes."""
    shared = " ".join(f"s{k}" for k in range(60))
    docs = [(k, " ".join(f"u{k}x{j}" for j in range(40)) + " " + shared) for k in range(1500)]
    made = {}

    def counted(df, **more):
        out = cut(df, **more)
        made[more["name"]] = max(made.get(more["name"], 0), out.count())
        return out

    monkeypatch.setattr(jaccard_join, "cut", counted)
    assert _near(spark, docs) == {k: (98, k) for k, _ in docs}
    assert made["near"] == made["rest_pairs"] == 0, made


def _most_joined(spark, since):
    """The most rows that a join made in any query that began after the first ``since``."""
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    runs = store.executionsList()
    for k in range(since, runs.size()):
        key = runs.apply(k).executionId()
        values, nodes = store.executionMetrics(key), store.planGraph(key).allNodes()
        for node in map(nodes.apply, range(nodes.size())):
            for m in map(node.metrics().apply, range(node.metrics().size())):
                if "Join" in node.name() and m.name() == "number of output rows" and (told := values.get(m.accumulatorId())).isDefined():
                    most = max(most, int(told.get().replace(",", "")))
    return most


def test_texts_that_just_miss_a_link_meet_once(spark):
    """Forty edits of one text share most of their prefixes: each pair is made in one list, not in every list of both."""
    rnd, base = random.Random(4), [f"b{k}" for k in range(300)]
    docs = []
    for k in range(40):
        words = list(base)
        for at in rnd.sample(range(60), 4):
            words[5 * at + 2] = f"own{k}x{at}"
        docs.append((k, " ".join(words)))
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    assert _near(spark, docs) == brute.near_duplicates(docs)
    assert _most_joined(spark, before) <= 2_000


def _edits(rnd, words, n, at_once):
    """``n`` copies of a text, each with ``at_once`` words of its own."""
    for k in range(n):
        own = list(words)
        for at in rnd.sample(range(len(words) // 5), at_once):
            own[5 * at + 2] = f"own{k}x{at}"
        yield " ".join(own)


def test_long_lists_make_no_pair_twice(spark):
    """Texts that just miss a link share lists of many chunks, and are told apart where they meet, not once for each shingle they share."""
    rnd, base = random.Random(5), [f"b{k}" for k in range(300)]
    docs = [*enumerate(_edits(rnd, base, 60, 4))]
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    sim = jaccard_join.Similarity(list_rows=8)
    assert _near(spark, docs, sim) == brute.near_duplicates(docs)
    assert _most_joined(spark, before) <= 1_500


def test_short_lists_take_no_others_with_them(spark, monkeypatch):
    """What an entry brings to a pair does not grow with the prefix where lists are of two."""
    rnd, docs = random.Random(6), []
    for k in range(12):
        half = [f"h{k}x{j}" for j in range(150)]
        docs += [(2 * k + side, " ".join([*half, *(f"t{k}x{j}y{side}" for j in range(150))])) for side in (0, 1)]
    most = []

    def seen(df, **more):
        out = cut(df, **more)
        if "_earlier" in out.columns:
            most.append(out.agg(F.sum(F.size("_earlier"))).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard_join, "cut", seen)
    _in_a_flat_order(monkeypatch)
    assert _near(spark, docs, jaccard_join.Similarity(3, 4, 5)) == brute.near_duplicates(docs, 3, (4, 5))
    assert most and max(most) == 0, most


@pytest.mark.parametrize("numerator, denominator", [(9, 10), (4, 5), (1, 2)])
def test_bits_lose_no_link(spark, monkeypatch, numerator, denominator):
    """Bits are compared in every list of two or more here, beside groups whose members have bits of their own."""
    rnd = random.Random(denominator)
    for _ in range(200):
        x, y = (np.unique(np.array([rnd.randrange(2**64) for _ in range(rnd.randint(0, 90))] + [3, 260, 2**63], np.uint64)) for _ in range(2))
        y = np.union1d(x[: rnd.randint(0, len(x))], y[: rnd.randint(0, 9)])
        differ = sum(int(a ^ b).bit_count() for a, b in zip(*(jaccard_join.parities(z).view(np.uint64) for z in (x, y)), strict=True))
        assert differ <= len(np.setxor1d(x, y)) and (len(np.setxor1d(x, y)) - differ) % 2 == 0
    _in_a_flat_order(monkeypatch)
    bases = [[f"w{rnd.randint(0, 60)}" for _ in range(n)] for n in (40, 90, 120)]
    docs = [(100 * b + k, t) for b, words in enumerate(bases) for at_once in (1, 2, 3) for k, t in enumerate(_edits(rnd, words, 12, at_once), 12 * at_once)]
    sim = jaccard_join.Similarity(3, numerator, denominator, list_rows=4, few_rows=1)
    wanted = brute.near_duplicates(docs, 3, (numerator, denominator))
    assert len({c for _, c in wanted.values()}) > 2 and _near(spark, docs, sim) == wanted


def test_samples(spark):
    rows = spark.range(200).select((F.col("id") * 7).alias("_id")).union(spark.range(20_000).select(F.lit(7).cast("long").alias("_id")))
    assert least_hashes(rows, ["_id"], limit=2_000).count() == 200 and least_hashes(rows, ["_id"], limit=15).count() == 15
    many = spark.range(100_000).withColumnRenamed("id", "_id")
    least = [r[0] for r in many.orderBy(F.pmod(F.xxhash64("_id"), F.lit(1 << 40)), "_id").limit(50).collect()]
    assert sorted(r[0] for r in least_hashes(many, ["_id"], limit=50).collect()) == sorted(least)
    texts = spark.createDataFrame([(k, "x" * (10 if k else 1000)) for k in range(50)] + [(60, "")], "_id long, _text string")
    kept = within(texts, ["_id"], 120).collect()
    assert 12 <= len(kept) <= 13 and all(r._id for r in kept)
