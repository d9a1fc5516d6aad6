"""Command line: ``python -m talkgrain COMMAND ...``; a gate that fails gives exit code 1.

``qa`` profiles records, ``build`` unrolls them into a benchmark, ``score``
scores predictions, ``schedule`` writes the pairs that a generator is to run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import schemas
from talkgrain.operators import quality, records, score, shortcuts, stream, validate
from talkgrain.plans import schedule
from talkgrain.sources import jsonl

PUBLIC = f"benchmark_id string, stream_id string, stream_position int, input struct<dialogue_window: array<{schemas.WINDOW_TURN}>>"
GOLD = "benchmark_id string, event string, action string, policy_rule_ids array<string>, evidence_turn_ids array<int>"


def _defaults(spark: SparkSession, path: str | None) -> DataFrame:
    """Usual risks by scenario, from a JSON-lines file, or none."""
    shape = "scenario_type string, risks array<string>"
    return spark.read.schema(shape).json(path) if path else spark.createDataFrame([], shape)


def qa(spark: SparkSession, args: argparse.Namespace) -> int:
    found = jsonl.read_records(spark, args.records)
    told = quality.ordered(records.turns(found.select(F.col("id").alias("record_id"), "dialogue")), "record_id", "place")
    report = quality.report(found, told, _defaults(spark, args.risks))
    _, bad = validate.contract(jsonl.read_raw(spark, args.records), max_turns=args.max_turns)
    report["schema_contract"] = {r.error: r["count"] for r in bad.groupBy("error").count().orderBy("error").collect()}
    jsonl.write_report(report, f"{args.out}/qa.json")
    with open(f"{args.out}/qa.md", "w", encoding="utf-8") as file:
        file.write(jsonl.qa_markdown(report, jsonl.source_metadata(spark, args.records, report["record_count"])))
    failed = quality.failed_gates(report, sum(report["schema_contract"].values()), final=args.final)
    for gate in failed:
        print(f"QA gate failed: {gate}; see {args.out}/qa.md")
    return int(bool(failed))


def build(spark: SparkSession, args: argparse.Namespace) -> int:
    found = jsonl.read_records(spark, args.records)
    told = found.select(F.explode("dialogue").alias("t")).select("t.*")
    buckets = quality.disposition(quality.placeholder_policy(quality.unknown_placeholder_counts(told)))
    make = stream.build_observed_items if args.observed else stream.build_planned_items
    items = make(found, buckets, surface=args.surface, size=args.window)
    counted: dict[str, dict[str, int]] = {}
    for r in stream.yield_counts(items).orderBy("metric", "key").collect():
        counted.setdefault(r.metric, {})[r.key] = r.n
    baselines = {r["run"]: score.rounded(r.asDict()) for r in score.score_baselines(items["public"], items["gold"]).collect()}
    reports = {"yield_report": counted, "baseline_report": baselines}
    leaks = stream.forbidden_keys(items["public"])
    if not args.observed:
        report = shortcuts.shortcut_report(items["public"], items["manifest"], items["gold"], items["rejected"])
        report["gate_checks"]["public_key_violation_count_is_zero"] = not leaks
        report["shortcut_gate_passed"] = all(report["gate_checks"].values())
        reports["shortcut_report"] = report
    jsonl.write_artifacts(items, reports, args.out)
    return int(bool(leaks) or args.gate and not reports.get("shortcut_report", {"shortcut_gate_passed": True})["shortcut_gate_passed"])


def score_predictions(spark: SparkSession, args: argparse.Namespace) -> int:
    public = score.scorable(spark.read.schema(PUBLIC).option("mode", "FAILFAST").json(args.public))
    gold = spark.read.schema(GOLD).option("mode", "FAILFAST").json(args.gold)
    lines = jsonl.read_raw(spark, args.predictions).withColumn("ord", F.monotonically_increasing_id())
    typed = lines.select("ord", F.lit("predictions").alias("run"), F.col("line").alias("raw"), F.from_json("line", schemas.PREDICTION).alias("p")).select("ord", "run", "raw", "p.*")
    row = score.score(public, gold, typed, raw=True).first()
    jsonl.write_report({**{k: v for k, v in row.asDict().items()}, **score.rounded(row.asDict())} if row else {}, args.out)
    return 0


def write_schedule(spark: SparkSession, args: argparse.Namespace) -> int:
    people = lambda path: jsonl.read_array(spark, path, "id string")
    scenarios = spark.createDataFrame(list(enumerate(args.scenarios.split(","))), "pos int, scenario string")
    rows = schedule.schedule(spark, people(args.victims), people(args.attackers), scenarios, count=args.count, start=args.start, mode=args.mode, dataset=args.dataset)
    if args.existing:
        rows = schedule.not_yet_written(rows, jsonl.existing_ids(spark, args.existing), args.count)
    jsonl.write_records(rows, args.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="talkgrain", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name: str, fn, *needed: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name)
        own.set_defaults(fn=fn)
        for option in (*needed, "out"):
            own.add_argument(f"--{option}", required=True)
        return own

    own = command("qa", qa, "records")
    own.add_argument("--risks")
    own.add_argument("--max-turns", type=int, default=10)
    own.add_argument("--final", action="store_true", help="fail if the final review asks for a look")
    own = command("build", build, "records")
    own.add_argument("--observed", action="store_true", help="gold from what turns do, not from plans")
    own.add_argument("--surface", default="typed_raw")
    own.add_argument("--window", type=int, default=6)
    own.add_argument("--gate", action="store_true", help="fail if a shortcut gate does")
    command("score", score_predictions, "public", "gold", "predictions")
    own = command("schedule", write_schedule, "victims", "attackers", "scenarios")
    for option, default in (("count", 100), ("start", 0)):
        own.add_argument(f"--{option}", type=int, default=default)
    own.add_argument("--mode", default="rotating")
    own.add_argument("--dataset", default="dataset")
    own.add_argument("--existing")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.fn(SparkSession.builder.appName("talkgrain").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
