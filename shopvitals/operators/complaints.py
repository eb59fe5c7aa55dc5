"""Complaint labels: keyword rules, and cleaning of labels a model proposed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.json import once, parse_whole_json

LABEL_FIELDS = (
    "ai_category", "ai_severity", "customer_emotion", "business_impact", "recommended_action",
)

# Keywords in the order they are tried, and the labels each group gives.
KEYWORD_LABELS = (
    (
        ("payment", "upi", "card"),
        ("payment_issue", "high", "frustrated", "revenue_risk",
         "Check payment gateway logs and failed payment events."),
    ),
    (
        ("late", "delay", "delivery"),
        ("late_delivery", "medium", "angry", "customer_churn_risk",
         "Check delivery partner SLA and delayed delivery events."),
    ),
    (
        ("refund",),
        ("refund_delay", "high", "frustrated", "trust_risk",
         "Check refund processing queue and payment reversal status."),
    ),
    (
        ("wrong", "different"),
        ("wrong_product", "medium", "disappointed", "return_risk",
         "Check warehouse picking and product mapping process."),
    ),
)
# Labels of a text without any keyword.
OTHER_LABELS = (
    "app_issue", "low", "confused", "minor_support_load",
    "Check app logs and customer support ticket details.",
)
# JSON key of each label in a model's answer, and what an absent key means.
MODEL_LABEL_KEYS = {
    "ai_category": ("category", "other"),
    "ai_severity": ("severity", "medium"),
    "customer_emotion": ("customer_emotion", "unknown"),
    "business_impact": ("business_impact", "operational_risk"),
    "recommended_action": ("recommended_action", "Review complaint manually."),
}


# The labels a model may choose from; other keys take free text.
MODEL_CHOICES = {
    "category": ("payment_issue", "late_delivery", "wrong_product", "refund_delay", "app_issue", "other"),
    "severity": ("low", "medium", "high", "critical"),
    "business_impact": (
        "revenue_risk", "customer_churn_risk", "trust_risk", "return_risk", "minor_support_load", "operational_risk",
    ),
}


def _labels(values: tuple[str, ...]) -> Column:
    return F.struct(*[F.lit(v).alias(name) for name, v in zip(LABEL_FIELDS, values)])


def keyword_labels(text: Column) -> Column:
    """Struct of the five labels by substring rules; NULL for NULL text."""
    lowered = F.lower(text)
    rules = [
        (reduce(lambda a, b: a | b, [lowered.contains(word) for word in words]), labels)
        for words, labels in KEYWORD_LABELS
    ]
    choice = F.when(rules[0][0], _labels(rules[0][1]))
    for matched, labels in rules[1:]:
        choice = choice.when(matched, _labels(labels))
    return F.when(text.isNotNull(), choice.otherwise(_labels(OTHER_LABELS)))


def classify_complaint_rules(events: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Complaint events with the five rule labels added."""
    labelled = events.select("*", once(_labels=keyword_labels(F.col("complaint_text"))))
    return labelled.select(
        *events.columns, *[F.col(f"_labels.{name}").alias(name) for name in LABEL_FIELDS]
    )


def normalize_complaint_labels(answers: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Labels from model answers (``complaint_text``, ``response``).

    An answer that is no JSON object, or is missing, falls back to the keyword rules. A key
    absent from the answer takes its default; an explicit null stays NULL.
    """
    def label(name: str) -> Column:
        key, default = MODEL_LABEL_KEYS[name]
        given = F.try_variant_get(F.col("_answer"), f"$.{key}", "string")
        return (
            F.when(
                F.col("_answer").isNull() | F.col("_keys").isNull(), F.col(f"_rules.{name}")
            )
            .when(F.array_contains("_keys", key), given)
            .otherwise(F.lit(default))
            .alias(name)
        )

    parsed = answers.select(
        "*",
        once(
            _answer=parse_whole_json(F.col("response")),
            _keys=F.json_object_keys("response"),
            _rules=keyword_labels(F.col("complaint_text")),
        ),
    )
    return parsed.select(*answers.columns, *[label(name) for name in LABEL_FIELDS])


def complaint_system_prompt() -> str:
    """What is asked of a model that labels complaints: one line per label, from the constants."""
    lines = []
    for key, default in MODEL_LABEL_KEYS.values():
        kind = "one of " + ", ".join(MODEL_CHOICES[key]) if key in MODEL_CHOICES else "a few words"
        lines.append(f"{key}: {kind}; if the text does not tell, {default}")
    return (
        "A customer of an online shop wrote the complaint you are given as JSON. Label it for the support "
        "team by a single JSON object with these keys and nothing around it:\n" + "\n".join(lines) + "\n"
    )


def complaint_prompt(events: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """One prompt per complaint with a text, for any batch inference job; the user's part is JSON."""
    return events.where(F.col("complaint_text").isNotNull()).select(
        "complaint_id",
        F.lit(cfg.model_provider).alias("provider"),
        F.lit(cfg.model_name).alias("model"),
        F.lit(complaint_system_prompt()).alias("system_prompt"),
        F.to_json(F.struct("complaint_text")).alias("user_prompt"),
    )


def label_complaints(events: DataFrame, answers: DataFrame) -> DataFrame:
    """Complaint events with the five labels, from a model's answers where there are usable ones.

    ``answers`` holds (complaint_id, attempt, response); the first attempt that is a JSON object
    counts. A complaint without one gets the labels of the keyword rules.
    """
    usable = answers.where(
        parse_whole_json(F.col("response")).isNotNull() & F.json_object_keys("response").isNotNull()
    )
    first = usable.groupBy("complaint_id").agg(F.min(F.struct("attempt", "response")).alias("_first"))
    joined = events.join(first.select("complaint_id", F.col("_first.response").alias("response")), "complaint_id", "left")
    return normalize_complaint_labels(joined).select(*events.columns, *LABEL_FIELDS)
