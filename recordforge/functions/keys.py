"""Record keys, content signatures, free-text references and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import text


def q_no(record_id: Column) -> Column:
    """Number after the last dash, null where it is none."""
    return F.substring_index(record_id, "-", -1).try_cast("int")


def chapter_of(record_id: Column) -> Column:
    """The first two of at least three dash-separated parts."""
    parts = F.split(record_id, "-")
    return F.when(F.size(parts) >= 3, F.concat_ws("-", F.slice(parts, 1, 2)))


def record_id(subject: Column, chapter_no: Column, number: Column) -> Column:
    return F.format_string("%s-%03d-%03d", subject, chapter_no.cast("int"), number.cast("int"))


def flag_key(kind: Column, rid: Column, chapter: Column, source: Column, detail: Column) -> Column:
    """Stable key of a flag: any rewording of its detail makes another."""
    short = F.substring(F.sha1(F.substring(text(detail), 1, P.DETAIL_LEN)), 1, 8)
    return F.substring(F.sha1(F.concat_ws("|", text(kind), text(rid), text(chapter), text(source), short)), 1, P.KEY_LEN)


def signature(*parts: Column) -> Column:
    """What a decision was made about: a change of any part makes the decision stale."""
    return F.substring(F.sha1(F.concat_ws("|", *[text(p.cast("string")) for p in parts])), 1, P.KEY_LEN)


def sampled(key: Column, every: int = P.SAMPLE_EVERY) -> Column:
    """One key of ``every``, by the remainder of its hexadecimal value; 16 digits need a decimal."""
    return F.pmod(F.conv(key, 16, 10).cast("decimal(20,0)"), F.lit(every).cast("decimal(20,0)")) == 0


def pages_in(detail: Column) -> Column:
    """Page numbers of ``pages [1, 2]`` in free text."""
    inside = F.regexp_extract(text(detail), r"(?:pages|pdf_pages|new_pages|on)\s*\[([0-9,\s]*)\]", 1)
    return F.filter(F.transform(F.split(inside, ","), lambda p: F.trim(p).try_cast("int")), lambda p: p.isNotNull())


def day_stamp(ts: Column, zone: str = "America/Los_Angeles") -> Column:
    """Calendar day of a UTC time in a zone."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd")


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
