import datetime as dt
import json

from rollcall.plans import publish
from rollcall.plans.cleaning import Cleaning
from rollcall.sources import benchmarks
from rollcall.sources.files import read_table
from tests.conftest import keyed, rows
from tests.test_reports import small


def test_from_raw_tables_to_reports(spark, bundle, tmp_path):
    raw, out = small(bundle), str(tmp_path)
    publish.write_cleaned(Cleaning(raw), f"{out}/cleaned")
    assert spark.read.parquet(f"{out}/cleaned/dq_report").count() == 12
    summary = read_table(spark, "workforce_summary", f"{out}/cleaned/workforce_summary")
    assert sum(r[0] for r in rows(summary, "synthetic_headcount")) == 4
    cleaned = publish.read_cleaned(spark, f"{out}/cleaned", raw.staff_profile, benchmarks.earnings(spark))
    assert keyed(cleaned.absences, "absence_id")["A4"]["dq_flag"] == "invalid_employee_id;"
    months = dt.date(2020, 1, 1), dt.date(2024, 12, 1)
    publish.write_reports(cleaned, f"{out}/reports", dt.date(2024, 12, 31), *months, fmt="csv")
    assert len(list((tmp_path / "reports").iterdir())) == 45
    record = json.loads(next((tmp_path / "reports" / "kpis").glob("part-*.json")).read_text())
    assert record["total_headcount"] == 4 and record["avg_ttf_academic_days"] == 10
