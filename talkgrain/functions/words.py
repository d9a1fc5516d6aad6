"""Words for people instead of field values, on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain.functions.text import contains_any

# Fixed values.
CONTEXTS = {
    "phone_call": "전화 통화", "messenger_call": "메신저 통화", "support_callback": "지원 콜백", "voice_message": "음성 메시지", "late_evening": "늦은 저녁", "during_commute": "이동 중", "before_deadline": "마감 전",
    "after_business_hours": "업무시간 이후", "lunch_break": "점심시간", "unspecified": "현재",
}
CONSTRAINTS = (
    (("cannot", "difficult"), "바로 확인하기 어려운"), (("deadline", "pending", "time_sensitive"), "일정 압박이 있는"), (("cashflow", "continuity"), "생활상 부담이 있는"), (("child", "care"), "돌봄 부담이 있는"), (("language",), "언어 지원이 필요한"),
)
NO_CONTEXT, NO_CONSTRAINT = "현재", "개인 사정이 있는"


def _spaced(value: Column) -> Column:
    return F.replace(value, F.lit("_"), F.lit(" "))


def readable_path(path: Column) -> Column:
    """Spaces for underscores, and the word for "or" wherever its letters stand."""
    return F.replace(_spaced(path), F.lit("or"), F.lit("또는"))


def context_label(value: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONTEXTS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, value), F.nullif(_spaced(value), F.lit("")), F.lit(NO_CONTEXT))


def constraint_label(value: Column) -> Column:
    """By the first group of parts of which the value has one."""
    out = F
    for parts, label in CONSTRAINTS:
        out = out.when(contains_any(value, parts), label)
    return out.when(value != "", _spaced(value)).otherwise(NO_CONSTRAINT)
