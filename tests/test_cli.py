"""The command line, end to end on a few records."""

from __future__ import annotations

import json

from talkgrain.__main__ import main
from talkgrain.operators import quality


def _record(k):
    said = [("attacker", "오늘 안내드릴 내용이 있어 연락드렸습니다"), ("victim", "어떤 내용인지 천천히 설명 부탁드립니다")]
    dialogue = [
        {"turn_id": t, "speaker": s, "phase": "opening", "utterance": f"{u} {k}", "intent_label": "x", "risk_signal": "urgency", "masked_items": [], "stream_event": "needs_more_context", "stream_action": "monitor_only", "stream_policy_rule_ids": ["P_MONITOR"], "stream_evidence_turn_ids": [t]}
        for t, (s, u) in enumerate(said, 1)
    ]
    return {"id": f"r{k}", "label": "attack", "scenario_type": "one", "outcome": "inconclusive", "dialogue": dialogue, "safety_masks": [], "gen_metadata": {}, "quality_checks": {}}


def test_commands(spark, tmp_path, capsys):
    path = tmp_path / "records.jsonl"
    path.write_text("\n".join(json.dumps(_record(k), ensure_ascii=False) for k in range(3)), encoding="utf-8")
    assert main(["qa", "--records", str(path), "--out", str(tmp_path / "qa")]) == 1
    assert "QA gate failed: schema_contract" in capsys.readouterr().out
    report = json.loads((tmp_path / "qa" / "qa.json").read_text())
    review = report | {"final_review": {"review_required": True}}
    assert [quality.failed_gates(r, n, final=f) for r, n, f in ((report, 0, True), (report, 2, False), (review, 0, False), (review, 0, True), (review, 1, True))] == [[], ["schema_contract"], [], ["final_review"], ["schema_contract", "final_review"]]
    assert report["record_count"] == 3 and sum(report["schema_contract"].values()) == 3
    out = tmp_path / "built"
    assert main(["build", "--records", str(path), "--out", str(out), "--gate"]) == 1
    assert json.loads((out / "yield_report.json").read_text())["public_item_count"] == {"": 6}
    assert main(["score", "--public", f"{out}/public_items.jsonl", "--gold", f"{out}/gold.jsonl", "--predictions", f"{out}/gold.jsonl", "--out", str(tmp_path / "score.json")]) == 0
    assert json.loads((tmp_path / "score.json").read_text())["SSU"] == 100.0
    people = tmp_path / "people.json"
    people.write_text(json.dumps([{"id": "a"}, {"id": "b"}]))
    assert main(["schedule", "--victims", str(people), "--attackers", str(people), "--scenarios", "one,two", "--count", "4", "--out", str(tmp_path / "plan")]) == 0
    assert spark.read.json(str(tmp_path / "plan")).count() == 4
