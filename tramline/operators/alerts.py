"""Cause, impact and summary of service alerts, once for each text."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .history import latest

#: The labels of both classifications. Fixed values.
CAUSES = (
    "roadworks or construction",
    "crash or incident",
    "weather",
    "event",
    "staff or vehicle shortage",
    "infrastructure or vehicle fault",
    "planned timetable change",
    "other",
)
IMPACTS = ("detour", "stop closed or moved", "delays", "cancellations", "reduced service", "information only")

#: Words that point to a label, in the order in which labels are tried; the last label is for texts with none of them.
CAUSE_WORDS = {
    "roadworks or construction": "road ?works?|resurfac|construction|works",
    "crash or incident": "crash|accident|collision|incident|police|emergency",
    "weather": "weather|snow|wind|flood|slip|storm|rain",
    "event": "event|parade|concert|marathon|match|festival",
    "staff or vehicle shortage": "staff|driver|crew|shortage",
    "infrastructure or vehicle fault": "fault|signal|breakdown|mechanical|track|power|overhead",
    "planned timetable change": "timetable|schedule change|public holiday|new route",
}
IMPACT_WORDS = {
    "detour": "detour|divert",
    "stop closed or moved": "stop .*(closed|moved|relocat)|(closed|moved|temporary) stop",
    "cancellations": "cancel",
    "reduced service": "reduced|fewer|limited",
    "delays": "delay|late",
}
Classifier = Callable[[Column], Column]


def by_keywords(labels: Mapping[str, str], otherwise: str) -> Classifier:
    """The first label one of whose words the text has. A stand-in for a language model, with the same result every time."""

    def classify(text: Column) -> Column:
        out = F.lit(otherwise)
        for label, words in reversed(labels.items()):
            out = F.when(F.lower(text).rlike(words), label).otherwise(out)
        return out

    return classify


def first_words(most: int = 20) -> Classifier:
    return lambda text: F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, most), " ")


def classify_new(alerts: DataFrame, known: DataFrame, now: Column, cause: Classifier | None = None, impact: Classifier | None = None, summary: Classifier | None = None) -> DataFrame:
    """Rows to append: alerts whose id and text are not known yet, one for each. Classifiers map a text column to one."""
    keys = ["alert_id", "text_hash"]
    rows = alerts.withColumn("text_hash", F.sha2(F.concat_ws("|", "header_text", "description_text"), 256))
    rows = rows.join(known.select(*keys), keys, "left_anti").select(*keys, "header_text", "description_text", "cause", "effect", "severity_level")
    rows = latest(rows, keys, ["header_text", "description_text", "cause", "effect", "severity_level"])
    text = F.concat("header_text", F.lit(". "), F.coalesce("description_text", F.lit("")))
    return rows.select(
        *keys, "header_text", F.col("cause").alias("gtfs_cause"), F.col("effect").alias("gtfs_effect"), F.col("severity_level").alias("gtfs_severity"),
        (cause or by_keywords(CAUSE_WORDS, CAUSES[-1]))(text).alias("cause_category"), (impact or by_keywords(IMPACT_WORDS, IMPACTS[-1]))(text).alias("impact_category"),
        (summary or first_words())(text).alias("summary"), now.alias("classified_at"),
    )
