"""Every report against its SQL, and what no plan may contain."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, sql_connection
from rollcall.catalog import REPORTS
from rollcall.sources.roles import RoleTables
from tests.conftest import FILES


@pytest.fixture(scope="module")
def con():
    return sql_connection(FILES)


def test_every_report_has_sql():
    assert set(REPORTS) <= set(entry.queries()) and set(REPORTS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_agrees_with_its_sql(spark, con, name):
    assert differences(spark, con, FILES, entry.queries()[name], entry.oracle_sql()[name]) == []


#: Rows that the smallest tables lack: records without an employee, rare ids.
LARGER = ["M_measures_total", "M_measures_by_department", "P12_measures_sliced", "K16_full_compliance", "T_compliance_variants",
          "G11_department_status", "D16_report", "D19_orphan_summary", "K11_top_spell_scores", "S1_absences_by_csv"]


@pytest.mark.parametrize("name", LARGER)
def test_report_agrees_with_its_sql_on_more_rows(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(spark, sql_connection(folder), folder, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_the_comparison_notices_a_wrong_value(spark, con):
    sql = entry.oracle_sql()["C1_department_headcount"].replace("COUNT(*) AS headcount", "COUNT(*) + 1 AS headcount")
    assert differences(spark, con, FILES, entry.queries()["C1_department_headcount"], sql)


def test_entry_is_the_executive_list(spark):
    assert entry.entry(spark).columns == ["kpi", "value", "benchmark"]


@pytest.mark.parametrize("name", list(REPORTS))
def test_no_pairing_of_all_rows(spark, name):
    plan = entry.queries()[name](spark, FILES)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def plan_of(spark, name):
    return REPORTS[name](RoleTables(spark, FILES))._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(spark, "K14_source_effectiveness")
    assert "o_orderpriority" in plan and "o_totalprice" not in plan and "o_orderdate" not in plan
    # The hire date comes from a join that is dropped when nobody asks for it.
    assert "orders.parquet" not in plan_of(spark, "K1_headcount_by_contract")


def test_facts_are_added_up_before_they_are_shuffled(spark):
    plan = plan_of(spark, "K9_sick_rate_by_department")
    assert "partial_sum(days_absent" in plan.split("orders.parquet")[0]


def test_top_k_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "K11_top_spell_scores")


def test_missing_training_is_an_anti_join(spark):
    assert "LeftAnti" in plan_of(spark, "K18_without_mandatory_training")


def test_numbering_rows_does_not_shuffle_them(spark):
    plan = plan_of(spark, "W1_quartile_of_employees")
    rows_part = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Exchange SinglePartition" not in rows_part and "Window" not in rows_part


def final_plan(df):
    """The lines of the plan as it ran, without what it was at first; subqueries included."""
    df.collect()
    lines, skipped = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth - len("+- ") if "== Initial Plan ==" in line else None
        if skipped is None:
            lines.append(line)
    return lines


def scans(lines, column):
    return [line for line in lines if "FileScan" in line and column in line]


@pytest.mark.parametrize("name", ["K16_full_compliance", "T_compliance_variants"])
def test_compliance_reads_training_once(spark, name):
    assert len(scans(final_plan(REPORTS[name](RoleTables(spark, FILES))), "l_shipdate")) == 1


@pytest.mark.parametrize("name", ["D_clean_training", "D_clean_absences", "D_clean_recruitment", "D24_set_null"])
def test_flagging_rows_starts_no_job_and_reads_the_fact_once(spark, name):
    spark.sparkContext.setJobGroup(name, name)
    df = REPORTS[name](RoleTables(spark, FILES))
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
    spark.sparkContext.setJobGroup("", "")
    assert list(started) == []
    column = "l_shipdate" if name == "D_clean_training" else "o_orderpriority" if name == "D_clean_absences" else "o_orderstatus"
    assert len(scans(final_plan(df), column)) == 1


def test_slicing_adds_facts_up_before_it_drops_employees(spark):
    plan = plan_of(spark, "P12_measures_sliced")
    assert "LeftSemi" not in plan
    for column in ("days_absent", "cost_eur"):
        lines = plan.splitlines()
        first = next(i for i, line in enumerate(lines) if f"partial_sum({column}" in line)
        depth = lines[first].index("HashAggregate")
        # nothing between the scan of the fact and its sums per employee narrows it to some employees
        below = []
        for line in lines[first + 1 :]:
            if len(line) - len(line.lstrip(" :+-|")) <= depth:
                break
            below.append(line)
        assert not any("Join" in line and "employee_id" in line for line in below), column


def test_medians_scan_their_table_once(spark):
    df = REPORTS["K13_time_to_fill"](RoleTables(spark, FILES))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange [g" in final and final.count("o_orderstatus") > 0
    assert len([line for line in final.splitlines() if "FileScan" in line and "o_orderkey" in line]) == 1


def test_lines_are_narrowed_before_they_are_shuffled(spark):
    """Of training records, no timestamp and no double that has a shorter form goes through an exchange, nor a hash of a
    key that the row holds anyway."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = REPORTS["D_clean_training"](RoleTables(spark, FILES))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_shipdate" in line)
    exchange = max(i for i in range(scan) if "Exchange" in lines[i])
    assert any("as date) AS completion_date" in line and "AS passed" in line for line in lines[exchange:scan])
    assert not any("l_shipdate" in line or "l_discount" in line for line in lines[:exchange])
    assert "(xxhash64(employee_id" in plan and "% 1)" in plan
