"""Records as JSON lines, and report files.

Reading is fail-fast: a malformed line stops the job, blank lines don't count.
``raw`` keeps each line as VARIANT beside its text, where missing, null and
wrongly typed values must be told apart.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.functions.text import stripped
from talkgrain.schemas import RECORD


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share; on one machine, where none is named, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="talkgrain-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_records(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parsed_line(line: Column) -> Column:
    """The line's one JSON value as VARIANT, or null: the parser alone would pass over what follows a value."""
    alone = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.when(F.size(F.try_variant_get(alone, "$", "array<variant>")) == 1, F.try_parse_json(line))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """``line, raw``: a VARIANT per line; a line that is not JSON raises."""
    return spark.read.text(path).where(stripped(F.col("value")) != "").select(F.col("value").alias("line"), F.coalesce(parsed_line(F.col("value")), F.raise_error(F.concat(F.lit("not JSON: "), F.col("value"))).cast("variant")).alias("raw"))


def read_with_errors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The lines that parse, and ``file, line`` of those that don't: a side channel instead of a stop."""
    rows = spark.read.text(path).where(stripped(F.col("value")) != "").select(F.col("value").alias("line"), parsed_line(F.col("value")).alias("raw"), F.col("_metadata.file_path").alias("file"))
    return rows.where("raw IS NOT NULL").drop("file"), rows.where("raw IS NULL").select("file", "line")


def line_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, line``: the lines of text files with their numbers from 1, blank ones too.

    A number is the lines of a file's earlier blocks and the place in the block,
    so no task holds more than a block.
    """
    place = F.monotonically_increasing_id()  # grows along a block, and only there it is compared
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), place.alias("_at"), F.col("value").alias("line"))
    inside = rows.withColumn("_k", F.row_number().over(W.partitionBy("file", "_block").orderBy("_at")))
    blocks = rows.groupBy("file", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("file", "_block", F.coalesce(before, F.lit(0)).alias("_before"))
    return inside.join(blocks, ["file", "_block"]).select("file", (F.col("_before") + F.col("_k")).alias("number"), "line")


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, line`` of the lines that are no JSON."""
    return line_numbers(spark, path).where((stripped(F.col("line")) != "") & parsed_line(F.col("line")).isNull())


def source_metadata(spark: SparkSession, path: str | None, record_count: int) -> dict[str, Any]:
    """What a file's name and lines say about how many records it should have."""
    if path is None:
        return {"source_path": None, "record_count": record_count, "jsonl_line_count": None, "filename_count_hint": None, "ignored_date_like_tokens": [], "count_mismatch_warning": False}
    hint = count_hint(Path(path).name)
    lines = spark.read.text(path).where(stripped(F.col("value")) != "").count() if Path(path).exists() else None
    return {
        "source_path": path, "record_count": record_count, "jsonl_line_count": lines, "filename_count_hint": hint["count_hint"], "ignored_date_like_tokens": hint["ignored_date_like_tokens"], "numeric_tokens": hint["numeric_tokens"],
        "count_mismatch_warning": hint["count_hint"] is not None and hint["count_hint"] != record_count, "line_count_mismatch_warning": lines is not None and lines != record_count,
    }


def array_entries(spark: SparkSession, path: str) -> DataFrame:
    """``file, pos, text``: the entries of files that hold one JSON array each, with their places from 0.

    A file is read in blocks, cut at every comma. Which commas stand between
    entries depends on all that comes before them: whether a string is open, and how deep brackets
    are. A piece says how it changes both, whatever it finds; sums of this along a block, and
    then along the blocks of a file, give each piece what it finds. So a large array
    is read by many tasks, and no task holds more than a block; a string's escapes end in their piece.
    """
    place = F.monotonically_increasing_id()  # grows along a block, and only there it is compared
    pieces = spark.read.option("lineSep", ",").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), place.alias("_at"), F.col("value").alias("text"))
    outside = F.split(F.regexp_replace("text", r"\\.", ""), '"', -1)
    count = lambda part, brackets: F.length(part) - F.length(F.translate(part, brackets, ""))
    change = lambda side: F.aggregate(F.transform("_parts", lambda p, k: F.when(k % 2 == side, count(p, "[{") - count(p, "]}")).otherwise(0)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    pieces = pieces.withColumn("_parts", outside).select("file", "_block", "_at", "text", (F.size("_parts") - 1).cast("bigint").alias("_quotes"), change(0).alias("_plain"), change(1).alias("_quoted"))

    along = W.partitionBy("file", "_block").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    blocks_before = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    earlier = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    flipped = lambda odd, a, b: F.when(F.col(odd) % 2 == 0, F.col(a)).otherwise(F.col(b))
    # Within a block, for a block that begins outside a string and for one that begins in one.
    rows = pieces.withColumn("_q", earlier("_quotes", along)).withColumn("_d0", flipped("_q", "_plain", "_quoted")).withColumn("_d1", flipped("_q", "_quoted", "_plain"))
    rows = rows.withColumn("_depth0", earlier("_d0", along)).withColumn("_depth1", earlier("_d1", along))
    blocks = rows.groupBy("file", "_block").agg(F.sum("_quotes").alias("_q"), F.sum("_d0").alias("_d0"), F.sum("_d1").alias("_d1"))
    blocks = blocks.withColumn("_odd", earlier("_q", blocks_before)).withColumn("_base", earlier(flipped("_odd", "_d0", "_d1"), blocks_before)).select("file", "_block", "_odd", "_base")
    rows = rows.join(blocks, ["file", "_block"])
    depth, inside = F.col("_base") + flipped("_odd", "_depth0", "_depth1"), (F.col("_odd") + F.col("_q")) % 2 == 1
    rows = rows.select("file", "_block", "_at", "text", depth.alias("_depth"), (depth + flipped("_odd", "_d0", "_d1")).alias("_left"), (~inside & (depth <= 1)).cast("bigint").alias("_starts"))
    opened = F.when(F.col("_depth") == 0, F.regexp_replace("text", r"^[\s\uFEFF]*\[", "")).otherwise(F.col("text"))
    closed = F.when(F.col("_left") == 0, F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    rows = rows.select("file", "_block", "_at", closed.alias("text"), "_starts", (earlier("_starts", along) + F.col("_starts")).alias("_here"))
    starts = rows.groupBy("file", "_block").agg(F.sum("_starts").alias("_n")).select("file", "_block", earlier("_n", blocks_before).alias("_before"))
    rows = rows.join(starts, ["file", "_block"]).withColumn("pos", F.col("_before") + F.col("_here") - 1)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_at", "text"))), lambda p: p["text"]), ",")
    return rows.groupBy("file", "pos").agg(whole.alias("text")).where((F.col("pos") > 0) | (stripped(F.col("text")) != ""))


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of a file that holds one JSON array, with their place as ``pos``; an entry that does not parse, or is none, stops the job."""
    text = F.when(stripped(F.col("text")) == "", F.raise_error(F.lit("an entry of the array is missing"))).otherwise(F.col("text"))
    return array_entries(spark, path).select("pos", F.from_json(text, f"struct<{schema}>", {"mode": "FAILFAST"}).alias("e")).select("pos", "e.*")


def existing_ids(spark: SparkSession, path: str) -> DataFrame:
    """The ids of a file of records; none if there is no file. Only the ids are parsed."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "id string")
    return spark.read.schema("id string").option("mode", "FAILFAST").json(path).where("id <> ''").distinct()


def _sorted(column: Column, kind: T.DataType) -> Column:
    """The same value with the fields of all its structs in order."""
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_sorted(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(column.isNotNull(), fields)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType | T.ArrayType):
        return F.transform(column, lambda x: _sorted(x, kind.elementType))
    return column


def with_sorted_keys(df: DataFrame) -> DataFrame:
    return df.select(*[_sorted(F.col(f.name), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def write_records(df: DataFrame, path: str, *, append: bool = False) -> None:
    """One object a line, keys sorted, nulls kept."""
    with_sorted_keys(df).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def _files(spark: SparkSession, path: str) -> set[str]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {str(f.getPath()) for f in files.listStatus(where) if f.isFile() and f.getLen()} if files.exists(where) else set()


def append_new(df: DataFrame, path: str, key: str = "id") -> DataFrame:
    """Append the rows whose id the folder of records does not have; gives those rows, as they were written."""
    spark = df.sparkSession
    before = _files(spark, path)
    known = existing_ids(spark, path)
    write_records(df.join(known.withColumnRenamed("id", key), key, "left_anti").select(df.columns), path, append=True)
    added = sorted(f for f in _files(spark, path) - before if not f.endswith("_SUCCESS"))
    return spark.read.schema(df.schema).json(added) if added else df.limit(0)


def errors_path(path: str) -> str:
    """Where the errors of a run go that writes to ``path``."""
    place = Path(path)
    return str(place.with_name(f"{place.stem}.errors.jsonl"))


def write_report(report: dict[str, Any], path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def read_object(path: str) -> dict[str, Any]:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def write_artifacts(items: dict[str, DataFrame], reports: dict[str, dict[str, Any]], folder: str) -> None:
    """The tables of a benchmark and its reports, from one pass over the items."""
    names = {"public": "public_items", "manifest": "private_manifest", "gold": "gold", "rejected": "rejected"}
    kept = {name: df.persist() for name, df in items.items()}
    try:
        for name, df in kept.items():
            write_records(df, f"{folder}/{names.get(name, name)}.jsonl")
    finally:
        for df in kept.values():
            df.unpersist()
    for name, report in reports.items():
        write_report(report, f"{folder}/{name}.json")
        told = yield_markdown(report) if name == "yield_report" else markdown(name, report)
        Path(folder, f"{name}.md").write_text(told, encoding="utf-8")
    samples = [{"benchmark_id": r.benchmark_id} | {k: json.loads(r[k]) for k in ("public", "manifest", "gold")} for r in sample_fixtures(items).collect()]
    Path(folder, "sample_fixtures.md").write_text(fixtures_markdown(samples), encoding="utf-8")


def sample_fixtures(items: dict[str, DataFrame], limit: int = 3) -> DataFrame:
    """A top-k report: the first items by stream and place, with their manifest and gold, as JSON."""
    first = items["public"].orderBy("stream_id", "stream_position", "benchmark_id").limit(limit)
    told = lambda df, name: df.select("benchmark_id", F.to_json(F.struct("*")).alias(name))
    found = first.select("benchmark_id", "stream_id", "stream_position").join(told(first, "public"), "benchmark_id")
    for name in ("manifest", "gold"):
        found = found.join(told(items[name].join(first.select("benchmark_id"), "benchmark_id", "left_semi"), name), "benchmark_id")
    return found.orderBy("stream_id", "stream_position", "benchmark_id")


def markdown(title: str, report: dict[str, Any], level: int = 1) -> str:
    """A report as headings and tables: nested dictionaries of figures."""
    lines = [f"{'#' * level} {title}", ""]
    plain = {k: v for k, v in report.items() if not isinstance(v, dict)}
    if plain:
        lines += ["| figure | value |", "| --- | --- |", *(f"| {k} | {v} |" for k, v in sorted(plain.items())), ""]
    for k, v in sorted(report.items()):
        if isinstance(v, dict):
            lines.append(markdown(k, v, min(level + 1, 6)))
    return "\n".join(lines)


def _facts(**facts: Any) -> list[str]:
    told = lambda v: str(v).lower() if isinstance(v, bool) else v
    return [*(f"- {k}: {told(v)}" for k, v in facts.items()), ""]


def _below(name: str, values: dict[str, Any] | list[str]) -> list[str]:
    """A list under a name, if it has entries."""
    if not values:
        return []
    return [f"- {name}:", *(f"  - {k}: {v}" for k, v in sorted(values.items())), ""] if isinstance(values, dict) else [f"- {name}:", *(f"  - {v}" for v in values), ""]


def _counted(name: str, values: dict[str, int]) -> list[str]:
    return [f"### {name}", "", *(f"- {k}: {v}" for k, v in values.items()), ""] if values else [f"### {name}", "", "- none: 0", ""]


def qa_markdown(report: dict[str, Any], source: dict[str, Any] | None = None) -> str:
    """The quality report in its published layout, as far as its figures go; ``source`` is what ``source_metadata`` says of the file."""
    source, signals, cues, style, target = source or {}, report["quality_signals"], report["pressure_cues"], report["pressure_style_alignment"], report["target_outcome_alignment"]
    risk, modes, styles, shown, contract = report["scenario_risk_coverage"], report["target_distributions"], report["style_distributions"], report["record_examples"], report.get("schema_contract", {})
    policy, repeated = report["placeholder_policy"], report["duplicate_record_ids"]
    turn = lambda e: f"id={e['record_id']} turn={e['turn_id']}: {e['utterance']}"
    record = lambda names: lambda e: " ".join([f"id={e['record_id']}", *(f"{name}={e[k]}" for k, name in names.items())])
    some = lambda name, examples, say: _below(name, [say(e) for e in examples[:5]])
    tally = lambda key: {v: sum(p["count"] for p in policy.values() if p[key] == v) for v in {p[key] for p in policy.values()}}
    checks = report["quality_checks"]
    table = ["| check | pass | fail | missing | pass_rate |", "| --- | ---: | ---: | ---: | ---: |", *(f"| {k} | {v['pass']} | {v['fail']} | {v['missing']} | {report['quality_pass_rate'][k]} |" for k, v in checks.items()), ""] if checks else ["- none: 0", ""]
    contexts = ["| field | present | missing |", "| --- | ---: | ---: |", *(f"| {k} | {v['present']} | {v['missing']} |" for k, v in report["environmental_context"].items()), ""]
    sections: dict[str, list[str]] = {
        "Source Metadata": _facts(**{k: source.get(k, [] if k == "ignored_date_like_tokens" else False if k.endswith("warning") else None) for k in ("source_path", "jsonl_line_count", "filename_count_hint", "ignored_date_like_tokens", "count_mismatch_warning", "line_count_mismatch_warning")}),
        "Duplicate Record Ids": [*_facts(scope="dataset_record_id", blocking=False, duplicate_count=sum(n - 1 for n in repeated.values()))[:-1], *(["- duplicate_ids:", *(f"  - {k}: {n}" for k, n in sorted(repeated.items()))] if repeated else []), ""],
        "Quality Checks": table,
        "Schema Contract Validation": [*_facts(enabled="schema_contract" in report, **{"pass": report["record_count"] - sum(contract.values()), "fail": sum(contract.values())}), *_below("failures", contract)],
        "Quality Signals": [
            *_facts(**{k: v for k, v in signals.items() if k.endswith("_count")}, gate_stage_direction_free=signals["stage_direction_count"] == 0, gate_mask_usage_anomaly_free=signals["mask_usage_anomaly_count"] == 0),
            *_below("unknown_masked_placeholders", {k: p["count"] for k, p in policy.items()}), *_below("decision_counts", tally("decision")), *_below("bucket_counts", tally("bucket")),
            *_below("placeholders", [f"{k}: count={p['count']} decision={p['decision']} bucket={p['bucket']}" for k, p in sorted(policy.items())]),
            *(line for name in ("unknown_masked_placeholder_examples", "partial_compliance_examples", "korean_entity_warnings") for line in some(name, signals[name], turn)),
        ],
        "Attack-Only Policy": _facts(expected_label="attack", status="pass" if report["attack_only_policy"]["pass"] else "fail", non_attack_count=report["attack_only_policy"]["non_attack_count"]),
        "Scenario Default Attacker Risk Signal Coverage": _facts(blocking=False, record_count=risk["records"], match_count=risk["records"] - risk["mismatches"], mismatch_count=risk["mismatches"], mismatch_rate=risk["mismatch_rate"], missing_attacker_risk_count=risk["without_risk"]),
        "Attacker Pressure Cue Diversity": [
            *_facts(blocking=False, attacker_turn_count=cues["attacker_turns"], categorized_attacker_turn_count=cues["with_cue"], uncategorized_attacker_turn_count=cues["attacker_turns"] - cues["with_cue"], unique_pressure_cue_count=len(cues["category_counts"]), dominant_pressure_cue=cues["dominant"],
                    dominant_pressure_cue_rate=cues["dominant_rate"], urgency_turn_count=cues["urgent"], urgency_turn_rate=cues["urgency_rate"], urgency_dominant_warning_only=cues["urgency_warning"]),
            *_below("category_counts", cues["category_counts"]),
        ],
        "Assigned Pressure Style Alignment": [
            *_facts(blocking=False, assigned_record_count=style["assigned"], observed_match_count=style["matches"], observed_match_rate=style["match_rate"], urgency_leakage_count=style["urgency_leaks"], urgency_leakage_rate=style["urgency_leakage_rate"]),
            *_below("assigned_distribution", styles["style assigned"]), *_below("observed_distribution", styles["style observed"]), *some("mismatch_examples", shown["style_mismatch_examples"], record({"expected": "assigned", "observed": "observed"})),
        ],
        "Target Outcome Mode Alignment": [
            *_facts(blocking=False, assigned_record_count=target["assigned"], match_count=target["matches"], match_rate=target["match_rate"], alignment_review_required=0 < target["assigned"] > target["matches"], repair_applied_count=target["repaired"], repair_applied_rate=target["repair_rate"],
                    llm_rewrite_applied_count=target["rewritten"], retry_success_count=target["retried"]),
            *(line for name, key in (("target_distribution", "target mode"), ("observed_distribution", "target observed"), ("repair_applied_by_target", "repaired by target"), ("llm_rewrite_applied_by_target", "rewritten by target"), ("generation_attempt_distribution", "generation attempts"), ("llm_rewrite_attempt_distribution", "rewrite attempts")) for line in _below(name, modes[key])),
            *some("mismatch_examples", shown["target_mismatch_examples"], record({"expected": "expected", "observed": "observed"})),
        ],
        "Final Dialogue Corpus Review": [*_facts(blocking=False, review_required=report["final_review"]["review_required"]), *_below("reasons", report["final_review"]["reasons"])],
        "Environmental Context Coverage": [
            *_facts(record_count=report["record_count"], with_environmental_context=report["with_context"], missing_environmental_context=report["record_count"] - report["with_context"]), *contexts, *some("missing_records", shown["missing_context_examples"], lambda e: f"id={e['record_id']}: {e['observed']}"),
        ],
        "Distributions": [line for name in ("label", "outcome", "scenario", "split", "victim", "attacker") for line in _counted(name, report[f"{name}_distribution"])] + _counted("masks", report["mask_counts"]),
    }
    head = _facts(record_count=report["record_count"], average_turn_count=report["average_turns"], duplicate_utterance_count=report["duplicate_utterances"], duplicate_utterance_rate=report["duplicate_utterance_rate"], duplicate_record_id_count=sum(n - 1 for n in repeated.values()))
    return "\n".join(["# QA Report", "", *head, *(line for title, lines in sections.items() for line in (f"## {title}", "", *lines))]).rstrip() + "\n"


def _listed(mapping: dict[str, Any]) -> list[str]:
    return [f"- {k}: {v}" for k, v in sorted(mapping.items())] or ["- none"]


def yield_markdown(report: dict[str, Any]) -> str:
    """The yield report in its published layout."""
    heads = ("status", "family", "source_path", "surface", "window_size", "public_item_count", "stream_count", "rejected_count", "public_whitelist_violation_count")
    parts = (
        ("## Event Distribution", "event_distribution"), ("## Action Distribution", "action_distribution"), ("## Release Floors", None), ("### Events", "release_floor_30_by_event"), ("### Actions", "release_floor_30_by_action"),
        ("## Rejections", "rejected_by_reason"),
    )
    lines = ["# Stream Benchmark Yield Report", "", *(f"- {h}: {report.get(h)}" for h in heads), ""]
    for title, key in parts:
        lines += [title, "", *([*_listed(report.get(key, {})), ""] if key else [])]
    return "\n".join(lines)


def fixtures_markdown(fixtures: list[dict[str, Any]]) -> str:
    """Sample items in their published layout; each has ``benchmark_id``, ``public``, ``manifest`` and ``gold``."""
    lines = ["# Stream Benchmark Sample Fixtures", ""]
    for item in fixtures:
        lines += [f"## {item['benchmark_id']}", ""]
        for name in ("public", "manifest", "gold"):
            lines += [f"{name.capitalize()}:", "", "```json", json.dumps(item[name], ensure_ascii=False, indent=2, sort_keys=True), "```", ""]
    return "\n".join(lines)


def count_hint_of(name: Column) -> Column:
    """``count_hint`` of a column of file names: the last number that is no compact date, and the dates."""
    numbers = F.regexp_extract_all(name, F.lit(r"\d+"), F.lit(0))
    part = lambda n, at: F.substring(n, at, 2).cast("int")
    dated = lambda n: (F.length(n) == 6) & part(n, 3).between(1, 12) & part(n, 5).between(1, 31)
    rest = F.filter(numbers, lambda n: ~F.coalesce(dated(n), F.lit(False)))
    return F.struct(F.try_element_at(rest, F.lit(-1)).cast("bigint").alias("count_hint"), F.filter(numbers, lambda n: F.coalesce(dated(n), F.lit(False))).alias("ignored_date_like_tokens"))


def count_hint(filename: str) -> dict[str, Any]:
    """Numbers in a file's name; the last one that is no compact date may be a record count."""
    import re

    numbers = re.findall(r"(?<!\d)\d+(?!\d)", filename)
    dates = [n for n in numbers if len(n) == 6 and 1 <= int(n[2:4]) <= 12 and 1 <= int(n[4:]) <= 31]
    rest = [n for n in numbers if n not in dates]
    return {"numeric_tokens": numbers, "ignored_date_like_tokens": dates, "count_hint": int(rest[-1]) if rest else None}
