"""Landed pages written by hand."""

from __future__ import annotations

import json
from datetime import date, datetime

from rollbook.schemas.endpoints import PAGE_SCHEMA

NIGHT = datetime(2024, 6, 1, 2)


def page(
    endpoint, body, academy="A", dataset="2021", year=None, day=None, page_no=1, cursor=None, fetched=NIGHT
):
    request = "|".join(
        [endpoint, academy, dataset, "" if year is None else f"{year:02d}", "" if day is None else day.isoformat()]
    )
    text = body if isinstance(body, str) else json.dumps(body)
    return (request, academy, dataset, year, day, fetched, page_no, cursor, text, endpoint)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGE_SCHEMA)


def config(spark, *academies, **changes):
    given = dict(
        CurrentAcademicYear="2021", Active=True, LowestYear=0, HighestYear=1, GetLessonAttendance=True,
        GetSessionAttendance=True, AttendanceFrom=date(2024, 1, 8), AttendanceTo=date(2024, 1, 9), GetBehaviour=True,
        BehaviourFrom=date(2024, 1, 8), BehaviourTo=date(2024, 1, 9),
    )
    given.update(changes)
    from rollbook.schemas.tables import TABLES

    rows = [tuple({**given, "AcademyCode": a, "Name": a}[f.name] for f in TABLES["AcademySecurity"].columns)
            for a in academies]
    return spark.createDataFrame(rows, TABLES["AcademySecurity"].schema)
