"""Columns that read a model's raw replies and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import found, lines_of, trim_u

# The markers of replies, the phrases that tell of a usage limit, and the forms of reset times.
TRANSLATION = r"(?s)<<<TRANSLATION\n(.*?)\n?>>>"
NOTE = r"(?s)<<<NOTE\n(.*?)\n?>>>"
SECTION = r"(?s)<<<SECTION\s+(\d+)>>>\s*(.*?)\s*<<<END_SECTION\s+\1>>>"
TSV = r"(?s)<TSV>\n(.*?)\n?</TSV>"
NEW_TERMS = r"(?dm)^NEW_TERMS:\s*(\[.*\])\s*$"
LIMIT = (
    r"(?i)usage limit|session limit|limit reached|5-hour limit|hit your (?:usage|session|weekly) limit"
    r"|rate.?limit|too many requests|quota|exhausted|\b429\b|overloaded"
)
RESET_UNIX = r"\|(\d{10})\b"
RESET_CLOCK = (
    r"(?i)(?:reset(?:s)?|try again|available|retry)[^\n.]{0,24}?"
    r"\b(\d{1,2})(?::(\d{2}))?\s*(a\.?m\.?|p\.?m\.?)"
)
RESET_CLOCK_24 = r"(?i)(?:reset(?:s)?|try again|available|retry)[^\n.]{0,24}?\b([01]?\d|2[0-3]):([0-5]\d)\b"
RESET_IN = (
    r"(?i)(?:try again|resets?|retry)\s+in\s+(?:(\d+)\s*h(?:ours?|rs?)?)?\s*"
    r"(?:(\d+)\s*m(?:in(?:utes?)?)?)?"
)
RESET_ISO = r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:Z|[+-]\d{2}:?\d{2})?)"
RESET_NAIVE = r"(?i)reset(?:s)?\s+at\s+(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2})"
# The pauses by the number of waits so far, and the end of the last year that a timestamp is written in.
BACKOFF_MINUTES = (15, 30, 45, 60)
LAST_SECOND = 253_402_300_800


def parse_model_blocks(raw: Column) -> Column:
    """struct(translation, note, error). note is null if the reply has no note block, and "" if the block is empty."""
    translation = found(raw, TRANSLATION)
    error = F.when(translation.isNull() | (trim_u(translation) == ""), F.lit("no translation block")).when(translation.contains("<<<"), F.lit("nested markers"))
    ok = error.isNull()
    return F.struct(F.when(ok, trim_u(translation)).alias("translation"), F.when(ok, trim_u(found(raw, NOTE))).alias("note"), error.alias("error"))


def parse_segment_reply(raw: Column) -> Column:
    """The rows of the reply's table as array<string>; null if there is no table."""
    body = found(raw, TSV)
    return F.when(body.isNotNull(), F.filter(lines_of(body), lambda x: trim_u(x) != ""))


def parse_review_reply(raw: Column) -> Column:
    """struct(verdict keep or revise, translation, note, error, new_terms). new_terms is the raw JSON list, whatever the verdict."""
    blocks = parse_model_blocks(raw)
    revise = (trim_u(raw) != "OK") & raw.rlike(TRANSLATION)
    return F.struct(
        F.when(revise, F.lit("revise")).otherwise("keep").alias("verdict"),
        F.when(revise, blocks["translation"]).alias("translation"),
        F.when(revise, blocks["note"]).alias("note"),
        F.when(revise, blocks["error"]).alias("error"),
        found(raw, NEW_TERMS).alias("new_terms"),
    )


def parse_reset_time(text: Column, now: Column) -> Column:
    """When a limit ends, by the first form of time that the text has; clock times that are past mean the next day.

    The session time zone (UTC, say) is that of times without one. Waits that end after the year 9999 have no timestamp.
    """
    iso = F.regexp_extract(text, RESET_ISO, 1)
    iso_time = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(iso, r"Z\z", "+00:00"), r"([+-]\d{2})(\d{2})\z", "$1:$2"))
    naive_time = F.try_to_timestamp(F.concat_ws(" ", F.regexp_extract(text, RESET_NAIVE, 1), F.regexp_extract(text, RESET_NAIVE, 2)))
    day = F.date_trunc("day", now)

    def clock(hour: Column, minute: Column) -> Column:
        at = day + F.make_dt_interval(F.lit(0), hour, minute)
        return F.when(at <= now, at + F.make_dt_interval(F.lit(1))).otherwise(at)

    number = lambda pattern, i: F.coalesce(F.when(F.length(F.regexp_extract(text, pattern, i)) < 6, F.regexp_extract(text, pattern, i).try_cast("int")), F.lit(0))
    twelve = F.pmod(number(RESET_CLOCK, 1), F.lit(12)) + F.when(F.lower(F.regexp_extract(text, RESET_CLOCK, 3)).startswith("p"), 12).otherwise(0)
    # a number of over 15 digits ends no sooner than one of 15
    digits = lambda i: F.regexp_replace(F.regexp_extract(text, RESET_IN, i), r"^0*(\d{1,15})\d*\z", "$1")
    wait = lambda i: F.coalesce(digits(i).try_cast("long"), F.lit(0))
    within = wait(1) * 60 + wait(2)
    ends = F.unix_seconds(now.cast("timestamp")) + within * 60
    return F.coalesce(
        F.when(text.rlike(RESET_UNIX), F.timestamp_seconds(F.regexp_extract(text, RESET_UNIX, 1).try_cast("long"))),
        F.when(text.rlike(RESET_ISO), iso_time),
        F.when(text.rlike(RESET_NAIVE), naive_time),
        F.when(text.rlike(RESET_CLOCK), clock(twelve, number(RESET_CLOCK, 2))),
        F.when(text.rlike(RESET_CLOCK_24), clock(number(RESET_CLOCK_24, 1), number(RESET_CLOCK_24, 2))),
        F.when((within > 0) & (ends < LAST_SECOND), now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.when(ends < LAST_SECOND, within) * 60).cast("decimal(18,6)"))),
    )


def clamp_resume_time(resume_at: Column, now: Column, waits: Column) -> Column:
    """A resume time within six hours from now, else now and a pause that grows with the waits so far."""
    minutes = F.get(F.array(*map(F.lit, BACKOFF_MINUTES)), F.least(waits, F.lit(len(BACKOFF_MINUTES) - 1)))
    fits = (resume_at > now) & (resume_at <= now + F.make_dt_interval(F.lit(0), F.lit(6)))
    return F.when(fits, resume_at).otherwise(now + F.make_dt_interval(F.lit(0), F.lit(0), minutes))


def classify_model_output(exit_code: Column, stdout: Column, stderr: Column, now: Column) -> Column:
    """struct(outcome limit, error or ok, text, error, resume_at). A limit counts at any exit code; errors end in the last 500 characters."""
    both = F.concat(stdout, F.lit("\n"), stderr)
    tail = F.right(trim_u(both), F.lit(500))
    limit = both.rlike(LIMIT)
    outcome = F.when(limit, "limit").when((exit_code != 0) | (trim_u(stdout) == ""), "error").otherwise("ok")
    error = F.when(limit, tail).when(exit_code != 0, F.coalesce(F.nullif(tail, F.lit("")), F.concat(F.lit("exit "), exit_code.cast("string")))).when(trim_u(stdout) == "", "empty output")
    return F.struct(outcome.alias("outcome"), F.when(outcome == "ok", trim_u(stdout)).alias("text"), error.alias("error"), F.when(limit, parse_reset_time(both, now)).alias("resume_at"))
