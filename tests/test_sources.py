import json
import os

import pytest
from pyspark.sql import functions as F

from rollcall import session
from rollcall.plans import executive
from rollcall.sources import benchmarks, files, schemas
from rollcall.sources.roles import RoleTables
from tests.conftest import FILES, keyed, rows


def expected_profile():
    """The published table worked out with plain floating-point numbers."""
    out = {}
    for category, grade, heads, share in benchmarks.STAFF_PROFILE_GRADES:
        women = round(heads * float(share))
        for gender, people in (("Female", women), ("Male", heads - women)):
            for contract, part in (("Permanent", 0.58), ("Fixed-Term", 0.42)):
                n = round(people * part)
                out[grade, gender, contract] = (n, round(n * float(benchmarks.FTE_RATES[category]), 1))
    return out


def test_staff_profile_rows(spark):
    df = benchmarks.staff_profile(spark, "Some University")
    got = {k: (v["headcount"], float(v["fte"])) for k, v in keyed(df, "grade", "gender", "contract_type").items()}
    assert len(got) == 40 and got == expected_profile()
    assert {r[0] for r in rows(df, "year")} == {2023} and dict(df.dtypes)["fte"] == "decimal(8,1)"


def test_fixed_benchmark_tables(spark):
    assert benchmarks.earnings(spark).count() == 5 and benchmarks.pay_gap(spark).count() == 6
    sources = benchmarks.data_sources(spark)
    assert sources.count() == 4 and sources.filter("created_at is null").count() == 0
    assert rows(benchmarks.sources_of(sources, "leavers"), "source_type") == [("Synthetic",)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_tables_survive_a_round_trip(spark, bundle, tmp_path, fmt):
    tables = bundle(
        employees=[dict(first_name='O"Neil, Jr', manager_id=None), dict(dq_flag="salary_out_of_range;")],
        absences=[dict(return_to_work_interview=None)],
        recruitment=[dict(time_to_fill_days=None, date_closed=None)],
        leavers=[{}],
        training=[{}],
        staff_profile=[{}],
    )
    for name in ("employees", "absences", "recruitment", "leavers", "training", "staff_profile"):
        files.write_table(getattr(tables, name), f"{tmp_path}/{name}", fmt)
    files.write_table(benchmarks.earnings(spark), f"{tmp_path}/earnings", fmt)
    files.write_table(tables.data_sources, f"{tmp_path}/data_sources")
    files.write_table(tables.pay_gap, f"{tmp_path}/pay_gap", fmt)
    back = files.read_workforce(spark, str(tmp_path), fmt)
    assert back.pay_gap.count() == 6 and back.data_sources.count() == 4 and back.workforce_summary is None
    for name in ("employees", "absences", "recruitment", "leavers", "training", "staff_profile"):
        df = getattr(back, name)
        assert sorted(rows(df), key=str) == sorted(rows(getattr(tables, name)), key=str), name
        assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.SCHEMAS[name]]
    counts = dict(rows(files.row_counts({"employees": back.employees, "leavers": back.leavers})))
    assert counts == {"employees": 2, "leavers": 1}


def test_raw_csv_with_other_columns(spark, tmp_path):
    path = tmp_path / "recruitment.csv"
    path.write_text("outcome,job_req_id,time_to_fill_days,is_academic,date_opened\nFilled,JR1,12.0,True,2022-03-01\nOngoing,JR2,,False,2022-03-02\n")
    got = keyed(files.read_table(spark, "recruitment", str(path), "csv"), "job_req_id")
    assert got["JR1"]["time_to_fill_days"] == 12 and got["JR1"]["is_academic"] is True and got["JR2"]["time_to_fill_days"] is None
    assert got["JR1"]["dq_flag"] == "" and got["JR1"]["source"] is None and str(got["JR2"]["date_opened"]) == "2022-03-02"


def test_csv_files_of_one_folder_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "leavers"
    folder.mkdir()
    (folder / "a.csv").write_text("employee_id,reason_for_leaving,destination\n1,Resignation,HEI\n")
    (folder / "b.csv").write_text("destination,employee_id,reason_for_leaving\nRetired,2,Retirement\n")
    (folder / "c.csv").write_text("employee_id,destination\n3,Private Sector\n")
    (folder / "d e.csv").write_text("")
    got = keyed(files.read_table(spark, "leavers", str(folder), "csv"), "employee_id")
    assert {k: (v["reason_for_leaving"], v["destination"]) for k, v in got.items()} == {
        "1": ("Resignation", "HEI"), "2": ("Retirement", "Retired"), "3": (None, "Private Sector"),
    }


def test_many_csv_files_are_few_jobs(spark, tmp_path):
    """Files of two header lines: the number of jobs is that of a folder of two files."""

    def jobs(n):
        folder = tmp_path / f"leavers{n}"
        folder.mkdir()
        for i in range(n):
            head, row = (("employee_id,destination", f"{i},HEI"), ("destination,employee_id", f"Retired,{i}"))[i % 2]
            (folder / f"f {i}.csv").write_text(f"{head}\n{row}\n")
        group = f"csv{n}"
        spark.sparkContext.setJobGroup(group, group)
        got = keyed(files.read_table(spark, "leavers", str(folder), "csv").select("employee_id", "destination"), "employee_id")
        spark.sparkContext.setJobGroup("", "")
        assert {k: v["destination"] for k, v in got.items()} == {str(i): ("HEI", "Retired")[i % 2] for i in range(n)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    # listing more than 32 files is a job of its own for each header line
    few = jobs(2)
    assert jobs(30) == few and jobs(1000) == jobs(100) <= few + 2


def test_spaces_survive_csv(spark, table, tmp_path):
    df = table("employees", dict(campus=" Main, campus "), dict(first_name=' "x" ', campus=None))
    files.write_table(df, f"{tmp_path}/e", "csv")
    assert sorted(rows(files.read_table(spark, "employees", f"{tmp_path}/e", "csv")), key=str) == sorted(rows(df), key=str)


def test_shared_folder(spark, table, tmp_path):
    df = table("leavers", {}, {})
    with session.dropping_tables(spark):
        back = files.round_trip(df, "leavers")
        assert sorted(rows(back)) == sorted(rows(df))
        path = session._made[-1].removeprefix("file://")
        assert os.path.isdir(path)
    assert not os.path.exists(path) and not session._made[-1:] == [f"file://{path}"]

    class Cluster:
        conf = type("", (), {"get": staticmethod(lambda name, default: default)})
        sparkContext = type("", (), {"master": "local-cluster[2,1,1024]", "applicationId": "x"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)


def test_partitioned_facts_prune(spark, bundle, tmp_path):
    off = bundle(absences=[{}, {}]).absences.withColumn("year", F.year("start_date"))
    files.write_table(off, f"{tmp_path}/a", partition_by=["year"])
    plan = spark.read.parquet(f"{tmp_path}/a").filter("year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_kpi_record(spark, tmp_path):
    tables = RoleTables(spark, FILES)
    record = executive.headline_kpis(tables).select(*executive.KPI_EXPORT)
    files.write_json_record(record, f"{tmp_path}/kpis")
    parts = list((tmp_path / "kpis").glob("part-*.json"))
    assert len(parts) == 1
    assert list(json.loads(parts[0].read_text())) == executive.KPI_EXPORT
