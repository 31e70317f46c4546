"""The named views, for users who ask in SQL."""

from __future__ import annotations

import datetime as dt

from rollcall.plans import absence, headcount
from rollcall.sources.schemas import SALARY_BANDS

# The names the views are known by.
ACTIVE_VIEW, ABSENCE_VIEW = "v_active_workforce", "v_absence_rate_by_dept"


def register_views(tables, as_of: dt.date, bands: dict[str, str] = SALARY_BANDS) -> None:
    """V1 and V2 as temporary views of the session. They are lazy: a view that isn't asked reads nothing. Employees that
    were not cleaned get their salary band here."""
    people = tables.employees
    if "benchmark_salary_band" not in people.columns:
        people = headcount.with_salary_band(people, bands)
    headcount.active_workforce(people, as_of).createOrReplaceTempView(ACTIVE_VIEW)
    absence.absence_rate_by_department(tables.employees, tables.absences).createOrReplaceTempView(ABSENCE_VIEW)
