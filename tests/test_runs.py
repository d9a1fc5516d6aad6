"""Progress and counts of runs, records put together from utterances, references between tables, and the report's one pass."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from talkgrain import queries, run_queries, turn_queries
from talkgrain.operators import quality
from talkgrain.plans import assembly
from talkgrain.sources import jsonl, progress, references

SF = "/root/testdata/sf0.001"


def test_durations_and_lines():
    assert [progress.duration(s) for s in (-1, 0.4, 59.4, 60, 3599, 3600, 7384)] == ["0s", "0s", "59s", "1m 0s", "59m 59s", "1h 0m", "2h 3m"]
    now = iter([0.0, 0.0, 20.0])
    run = progress.Progress(10, clock=lambda: next(now))
    assert run.line() == "Generated 0/10 records | errors 0 | elapsed 0s | avg 0.0s/record | ETA calculating"
    run.done, run.errors = 4, 1
    assert run.line() == "Generated 4/10 records | errors 1 | elapsed 20s | avg 5.0s/record | ETA 30s"


def test_counts_of_a_pass(spark, tmp_path):
    path, told = tmp_path / "in.txt", []
    path.write_text('{"a": 1}\n\nnot json\n[1, 2]\n \t\n{"a": 2} x\n')
    with progress.watched(spark, "counts", lambda *now: told.append(now), every=0.05):
        seen = progress.split_lines(spark, str(path), str(tmp_path / "out"))
    assert {k: seen[k] for k in ("lines", "records", "errors", "blanks")} == {"lines": 6, "records": 2, "errors": 2, "blanks": 2} and seen["seconds"] > 0
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out" / "status=error")).collect()) == ["not json", '{"a": 2} x']
    assert told[-1][0] == told[-1][1] > 0
    counts = progress.write_counted(spark.range(10), str(tmp_path / "rows"), odd=F.count_if(F.col("id") % 2 == 1))
    assert counts == {"rows": 10, "odd": 5} and spark.read.json(str(tmp_path / "rows")).count() == 10


def _plain(plans, said, good, attempts):
    """Turn by turn and attempt by attempt: the next utterance of the pool that nobody has taken."""
    pools = {}
    for pool, _, text in sorted(said):
        pools.setdefault(pool, []).append(text)
    out, left = {}, sorted(plans)
    for attempt in range(1, attempts + 1):
        failed = []
        for record, turn, pool in left:
            text = pools[pool].pop(0) if pools.get(pool) else None
            if text is not None and good(text):
                out[record, turn] = (text, attempt, None)
            else:
                out[record, turn] = (None, attempts, "no_utterance_left" if text is None else "bad")
                failed.append((record, turn, pool))
        left = failed
    return out


@pytest.mark.parametrize(("n", "attempts"), [(60, 3), (60, 1), (0, 3)])
def test_assembly(spark, n, attempts):
    rnd = random.Random(n + attempts)
    plans = [(r, t, rnd.choice("abc")) for r in range(n) for t in (1, 2, 3)]
    said = [(rnd.choice("aab"), k, f"{rnd.choice(['ok', 'no'])} {k}") for k in range(3 * n)]
    turns = assembly.assemble(
        spark.createDataFrame(plans, "record_id long, turn_id int, pool string"), spark.createDataFrame(said, "pool string, ord long, text string"), lambda t: F.when(~t.startswith("ok"), "bad"), attempts=attempts,
    )
    wanted = _plain(plans, said, lambda t: t.startswith("ok"), attempts)
    assert {(r.record_id, r.turn_id): (r.utterance, r.attempt, r.error) for r in turns.collect()} == wanted
    whole, bad = assembly.records_and_errors(turns, "pool")
    complete = {r for r in range(n) if all(wanted[r, t][2] is None for t in (1, 2, 3))}
    assert {r.record_id for r in whole.collect()} == complete and {r.record_id: r.turn_id for r in bad.collect()} == {r: min(t for t in (1, 2, 3) if wanted[r, t][2]) for r in set(range(n)) - complete}


def test_references(spark):
    tables = {"pairs": spark.createDataFrame([(1, "v1", "x"), (2, "v9", ""), (3, None, None)], "id int, victim string, name string"), "victims": spark.createDataFrame([("v1",), ("v2",), ("v2",)], "id string")}
    rules = [references.Rule("refers", "pairs", "victim", to="victims"), references.Rule("filled", "pairs", "name"), references.Rule("unique", "victims", "id")]
    assert sorted((r.path, r.error) for r in references.violations(tables, rules).collect()) == [("pairs[2].name", "is empty"), ("pairs[2].victim", "is not in victims"), ("pairs[3].name", "is empty"), ("victims[v2].id", "is repeated"), ("victims[v2].id", "is repeated")]
    with pytest.raises(ValueError, match=r"pairs\[2\].victim is not in victims: v9"):
        references.check(tables, rules)
    references.check(tables, [references.Rule("unique", "pairs", "id")])


def test_counts_that_look_like_dates(spark, tmp_path):
    """Keys of six digits, some of which could be dates, against the query's SQL."""
    keys = (0, 4, 99_996, 100_104, 110_112, 110_113, 110_114, 121_231, 121_232, 991_231, 1_101_128, 123_456_789_012)
    spark.createDataFrame([(k,) for k in keys], "c_custkey bigint").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
        wanted = con.sql(queries.ORACLES["filename_hints"]).fetchall()
    assert sorted(tuple(r) for r in run_queries.filename_hints(spark, str(tmp_path)).collect()) == sorted(wanted)
    # The operator still takes six such digits for a date.
    hint = spark.range(1).select(jsonl.count_hint_of(F.lit("run_260609_110112_vllm.jsonl")).alias("h")).first().h
    assert hint.count_hint is None and hint.ignored_date_like_tokens == ["260609", "110112"]


def test_report_takes_few_queries(spark):
    """The report's figures equal those of the functions that make them one by one."""
    rows, told, defaults = turn_queries._corpus(spark, SF)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    report = quality.report(rows, told, defaults)
    assert store.executionsCount() - before <= 5  # figures, the few kinds of placeholders, examples of turns and of records
    one = lambda df: df.first().asDict()
    assert {k: report["scenario_risk_coverage"][k] for k in ("records", "mismatches", "without_risk")} == one(quality.risk_coverage(rows, defaults))
    assert {k: report["pressure_style_alignment"][k] for k in ("assigned", "matches", "urgency_leaks")} == one(quality.style_alignment(rows))
    assert {k: v for k, v in report["target_outcome_alignment"].items() if "rate" not in k} == one(quality.target_alignment(rows))
    assert {k: v for k, v in report["quality_signals"].items() if k.endswith("count")} == one(quality.signal_counts(told))
    assert report["environmental_context"] == {r.field: {"present": r.present, "missing": r.missing, "distinct": r.distinct} for r in quality.contexts(rows).collect()}
    assert report["mask_counts"] == {r.label: r.n for r in quality.mask_counts(rows).collect()} and report["outcome_distribution"] == {r.value: r.n for r in quality.value_counts(rows, "outcome").collect()}
    sums, cues = quality.cue_diversity(told)
    assert {k: report["pressure_cues"][k] for k in ("attacker_turns", "with_cue", "urgent")} == one(sums) and report["pressure_cues"]["category_counts"] == {r.cue: r.n for r in cues.collect()}
    best = max(cues.collect(), key=lambda r: (r.n, [-x for x in (r.first[0][0], r.first[0][1], r.first[1])]))
    assert report["pressure_cues"]["dominant"] == best.cue
    repeats = one(quality.duplicate_utterances(told))
    assert report["duplicate_utterances"] == repeats["duplicates"] and len(report["quality_signals"]["partial_compliance_examples"]) == min(10, report["quality_signals"]["partial_compliance_signal_count"])
    twice = quality.report(rows.unionByName(rows.limit(1)), told, defaults)
    assert list(twice["duplicate_record_ids"].values()) == [2] and twice["record_count"] == report["record_count"] + 1
    assert quality.report(rows.limit(0), told.limit(0), defaults)["record_count"] == 0
    told = jsonl.qa_markdown(report).split("\n")
    heads = [line for line in told if line.startswith("## ")]
    assert told[0] == "# QA Report" and len(heads) == 13 and heads[-1] == "## Distributions" and f"- record_count: {report['record_count']}" in told
    at = told.index("## Target Outcome Mode Alignment")
    assert told[at + 3] == f"- assigned_record_count: {report['target_outcome_alignment']['assigned']}" and "- mismatch_examples:" in told[at:] and sum(line.startswith("  - id=") for line in told[at : told.index("## Final Dialogue Corpus Review")]) == 5
