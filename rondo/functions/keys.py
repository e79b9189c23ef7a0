"""Surrogate keys computed from the row itself, so a retried task gives the same key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_text(*parts: Column) -> Column:
    """SQL ``||``: parts as text, null if any part is null."""
    return F.concat(*[p.cast("string") for p in parts])


def session_second_key(session: Column, start_time: Column) -> Column:
    """md5 of session number and start time as text; repeats when both repeat.

    A zone-free timestamp cut to the second casts to ``yyyy-MM-dd HH:mm:ss`` in every session zone.
    """
    return F.md5(concat_text(session, start_time))


def key_text(*parts: Column) -> Column:
    r"""The parts joined by ``|``, with ``\N`` for null so that nulls keep their place.

    A backslash or bar inside a part gets a backslash in front, so different parts never join to one text. Texts of
    several runs of parts, joined by ``|``, are the text of all of them.
    """

    def escaped(part: Column) -> Column:
        text = F.replace(part.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.replace(text, F.lit("|"), F.lit("\\|"))

    return F.concat_ws("|", *[F.coalesce(escaped(p), F.lit("\\N")) for p in parts])


def natural_key(*parts: Column) -> Column:
    """md5 of the parts' ``key_text``."""
    return F.md5(key_text(*parts))
