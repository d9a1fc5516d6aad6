"""String and label columns on small cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from talkgrain import queries
from talkgrain.functions import labels, masking, text


def values(spark, rows, fn):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string")
    return [r.v for r in df.select("k", fn(F.col("t")).alias("v")).orderBy("k").collect()]


def test_cleaning(spark):
    rows = ["<think>x\ny</think> 공격자: [숨을 고르며] \"안녕하세요\"\n둘째 줄", "```victim - 네```", "  ", "plain", "'quoted'", "a\n\nb"]
    assert values(spark, rows, text.clean_model_utterance)[1:] == ["네", text.DEFAULT_UTTERANCE, "plain", "quoted", "a"]
    assert values(spark, ['" 안내 안내  확인 "'], text.clean_utterance) == ["안내 확인"]


def test_normal_forms(spark):
    assert values(spark, ["A b　C d", ""], text.duplicate_key) == ["abcd", ""]
    assert values(spark, ["x" * 170, "a  b"], text.truncated) == ["x" * 157 + "...", "a b"]
    assert values(spark, ["a. b! c", "", "no end"], text.sentences) == [["a.", "b!", "c"], [""], ["no end"]]
    assert values(spark, ["[MASKED_OTP] [MASKED_X] y"], text.nonstandard_placeholders) == [["[MASKED_X]"]]
    assert values(spark, ["[MASKED_OTP] y"], lambda c: text.surface_text(c, "neutral_mask")) == ["[MASKED_VALUE] y"]
    assert values(spark, ["[MASKED_A]", "보류하세요 지금 당장 합시다 여러분", "네", "오늘은 공식 창구에서 확인하고 진행합시다"], text.utterance_artifact) == ["placeholder_only_utterance", "instruction_residue_in_utterance", "very_short_utterance", None]


def test_masks(spark):
    said = "otp 123456 https://a.example/b 010-1234-5678 900101-1234567 me@mail.example password: abc123! 123-456-789012"
    found = values(spark, [said, None, "2026-06-02", "번호010-1234-5678"], masking.mask_text)
    assert [i.label for i in found[0].masked_items] == ["url", "rrn", "otp", "phone", "email", "account", "credential"]
    assert not any(c.isdigit() for c in found[0].text)
    assert (found[2].text, found[3].text) == ("2026-06-02", "번호010-1234-5678")
    assert values(spark, ["me@x.example", "2026-06-02", "123-456-789012"], masking.residual_labels) == [["email"], [], ["account"]]
    assert values(spark, ["[MASKED_CASE_NUMBER] [Caller_Name] [otp] [MASKED_HOME_PHONE] [MASKED_ODD]"], masking.normalise_aliases) == ["[MASKED_CASE_REFERENCE] [MASKED_NAME] [MASKED_CASE_REFERENCE] [MASKED_PHONE] [MASKED_ODD]"]


@pytest.mark.parametrize(
    ("speaker", "said", "intent", "risk"),
    [
        ("victim", "[MASKED_OTP] 제공하겠습니다", "disclose_or_comply", "asset_disclosure"),
        ("victim", "[MASKED_OTP]는 제공할 수 없습니다. 확인 후 연락드릴게요", "resist_or_verify_request", "victim_resistance"),
        ("victim", "공식 채널 확인 후에만 [MASKED_ACCOUNT] 전달하겠습니다", "uncertain_response", "victim_uncertainty"),
        ("victim", "잘 모르겠어요", "uncertain_response", "victim_uncertainty"),
        ("attacker", "송금과 인증이 필요합니다", "request_masked_transfer_or_payment", "money_transfer_request"),
        ("attacker", "OTP 알려주세요", "request_masked_credential_or_otp", "credential_request"),
        ("attacker", "hello", "social_engineering_probe", "other"),
    ],
)
def test_turn_labels(spark, speaker, said, intent, risk):
    assert tuple(values(spark, [said], lambda c: labels.annotate_turn(F.lit(speaker), c, F.lit("other")))[0]) == (intent, risk)


def test_states(spark):
    said = ["[MASKED_OTP] 입력하겠습니다", "공식 확인 후 [MASKED_OTP] 입력하겠습니다", "[MASKED_OTP] 맞나요", "[MASKED_URL] 공유하겠습니다", "직접 하겠습니다", ""]
    assert values(spark, said, labels.disclosure_state) == ["direct_masked_disclosure_or_entry", "conditional_masked_action", "asset_mentioned_without_commitment", "none", "none", "none"]
    assert values(spark, said, labels.stream_disclosure_state)[3] == "direct_masked_disclosure_or_entry"
    assert values(spark, said, labels.defense_action) == ["risky_or_unsafe", "uncertain_or_conditional", "needs_audit", "needs_audit", "safe_verify_or_refuse", "needs_audit"]
    assert values(spark, ["[MASKED_URL] 송금", "x"], labels.request_state) == ["transfer_or_payment_request", "none_or_context_only"]
    assert values(spark, ['{"a": "http://x 010-1234-5678 우회"}'], labels.output_violations) == [["invented_url", "invented_phone", "unsafe_procedure_or_attacker_continuation"]]


def test_sentence_count(spark):
    """As many as there are sentences, for any mix of marks, line ends and white space, and at once for long runs of it."""
    rnd = random.Random(9)
    texts = ["", " ", ".", " .", " \n.", "a", ".." , "\u3000", " \u3000a", "a \n b。 ！", *("".join(rnd.choice("ab .!\n。\t\u2003\x1c") for _ in range(rnd.randint(0, 14))) for _ in range(2000))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows.where(text.sentence_count(F.col("t")) != F.size(text.sentences(F.col("t")))).collect() == []
    long = spark.range(1).select(text.sentence_count(F.concat(F.repeat(F.lit(" "), 1_000_000), F.lit("\n"), F.repeat(F.lit("\t"), 1_000_000), F.lit("x"))).alias("n"))
    assert long.first().n == 1
    plan = queries.sentence_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "lambda" not in plan
