"""The bundle of tables every report works on, and the slicers that narrow it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Workforce:
    employees: DataFrame
    absences: DataFrame
    recruitment: DataFrame
    leavers: DataFrame
    training: DataFrame
    staff_profile: DataFrame | None = None
    earnings: DataFrame | None = None
    pay_gap: DataFrame | None = None
    data_sources: DataFrame | None = None
    workforce_summary: DataFrame | None = None
    # Of a bundle narrowed to some employees: the bundle before that, with its conditions on the child tables.
    whole: Workforce | None = None

    def sliced(self, employees: Column | None = None, **facts: Column) -> Workforce:
        """Narrow the bundle.

        ``employees`` is a condition on employees and also keeps only the child rows of the employees it keeps
        (one direction only). Other keywords are conditions on one child table, e.g. ``absences=``. Reports that add facts
        up per employee start from ``whole`` and drop the others' totals, so a very active employee is one row by then;
        a child table asked for by itself is narrowed row by row.
        """
        narrowed = replace(self, **{name: getattr(self, name).filter(cond) for name, cond in facts.items()})
        whole = self.whole.sliced(**facts) if self.whole else narrowed
        if employees is None:
            return replace(narrowed, whole=whole) if self.whole else narrowed
        kept = self.employees.filter(employees)
        ids = kept.select("employee_id")
        hires = ids.withColumnRenamed("employee_id", "hired_employee_id")
        return replace(
            narrowed,
            whole=whole,
            employees=kept,
            absences=narrowed.absences.join(ids, "employee_id", "left_semi"),
            leavers=narrowed.leavers.join(ids, "employee_id", "left_semi"),
            training=narrowed.training.join(ids, "employee_id", "left_semi"),
            recruitment=narrowed.recruitment.join(hires, "hired_employee_id", "left_semi"),
        )
