"""The workforce tables derived from an order-processing star schema, so reports can run over any size of it.

Customers play the employees, orders the absences and the job openings, order lines the training records and
suppliers the published staff profile. Everything is lazy: a table a report does not use is never read.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources import benchmarks
from rollcall.sources.tables import Workforce

AS_OF = dt.date(2001, 11, 4)
FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 12, 1)
CAMPUSES = ("Main Campus", "Remote")
GRADE_BANDS = {"NATION_0": "€28,000–€38,000", "NATION_1": "€35,000–€50,000", "NATION_2": "€45,000–€62,000"}


# The columns the roles are made from.
STAR = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
}


class RoleTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read_tables: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._read_tables:
            self._read_tables[name] = self.spark.read.schema(STAR[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._read_tables[name]

    @cached_property
    def employees(self) -> DataFrame:
        first_order = self._read("orders").groupBy("o_custkey").agg(F.expr("CAST(min(o_orderdate) AS DATE) AS first_order"))
        return (
            self._read("customer")
            .join(self._read("nation"), F.expr("c_nationkey = n_nationkey"))
            .join(first_order, F.expr("o_custkey = c_custkey"), "left")
            .selectExpr(
                "CAST(c_custkey AS STRING) AS employee_id",
                "split_part(c_name, '#', 1) AS first_name",
                "split_part(c_name, '#', 2) AS last_name",
                "CASE WHEN c_custkey % 20 = 0 THEN 'Non-Binary' WHEN c_custkey % 20 < 11 THEN 'Female' "
                "ELSE 'Male' END AS gender",
                "date_add(DATE '1958-01-01', CAST(c_custkey * 37 % 9000 AS INT)) AS date_of_birth",
                "if(c_custkey % 4 = 0, 'A', 'B') AS nationality",
                "coalesce(first_order, DATE '1995-01-01') AS hire_date",
                "c_mktsegment AS department",
                "'Officer' AS job_title",
                "CASE c_custkey % 5 WHEN 0 THEN 'Fixed-Term' WHEN 1 THEN 'Part-Time' ELSE 'Permanent' END "
                "AS employment_type",
                "n_name AS grade",
                "CAST(c_acctbal * 10 + 30000 AS DECIMAL(10,2)) AS salary",
                "CASE WHEN c_custkey % 100 = 7 THEN 'missing' "
                "WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey - c_custkey % 10 AS STRING) END AS manager_id",
                "CASE c_custkey % 9 WHEN 0 THEN ' main campus ' WHEN 1 THEN 'Remote' ELSE 'Main Campus' END AS campus",
                "CASE WHEN c_custkey % 8 = 3 THEN 'Resigned' WHEN c_custkey % 40 = 5 THEN 'Retired' "
                "ELSE 'Active' END AS status",
                "n_regionkey < 2 AS is_academic",
            )
        )

    @cached_property
    def absences(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "CAST(if(o_orderkey % 7 = 0, o_custkey, o_orderkey) AS STRING) AS absence_id",
            "CASE WHEN o_orderkey % 997 = 0 THEN 'missing' WHEN o_orderkey % 1009 <> 0 THEN CAST(o_custkey AS STRING) END "
            "AS employee_id",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Certified Sick Leave' "
            "WHEN '2-HIGH' THEN 'Uncertified Sick Leave' WHEN '3-MEDIUM' THEN 'Annual Leave' "
            "WHEN '4-NOT SPECIFIED' THEN 'Study Leave' ELSE 'Other' END AS absence_type",
            "CAST(o_orderdate AS DATE) AS start_date",
            "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 14 AS INT)) AS end_date",
            "CAST(o_orderkey % 14 + if(o_orderkey % 101 = 0, 1, 0) AS INT) AS days_absent",
            "o_orderkey % 33 <> 0 AS approved",
            "if(o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 14 >= 3, o_orderstatus <> 'P', NULL) "
            "AS return_to_work_interview",
        )

    @cached_property
    def recruitment(self) -> DataFrame:
        return (
            self._read("orders")
            .join(self._read("customer"), F.expr("o_custkey = c_custkey"))
            .join(self._read("nation"), F.expr("c_nationkey = n_nationkey"))
            .selectExpr(
                "CAST(o_orderkey AS STRING) AS job_req_id",
                "'Officer' AS job_title",
                "c_mktsegment AS department",
                "n_regionkey < 2 AS is_academic",
                "CAST(o_orderdate AS DATE) AS date_opened",
                "if(o_orderstatus = 'O', NULL, date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 120 AS INT))) "
                "AS date_closed",
                "if(o_orderstatus = 'F', CAST(o_orderkey % 120 AS INT), NULL) AS time_to_fill_days",
                "o_orderpriority AS source",
                "CASE WHEN o_orderstatus = 'F' THEN 'Filled' WHEN o_orderstatus = 'O' THEN 'Ongoing' "
                "WHEN o_orderkey % 2 = 0 THEN 'Cancelled' ELSE 'Withdrawn' END AS outcome",
                "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 211 = 0 THEN 'missing' "
                "WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS STRING) END AS hired_employee_id",
                "CAST(28000 + o_orderkey % 50 * 1000 AS DECIMAL(10,2)) AS salary_band_min",
                "CAST(40000 + o_orderkey % 50 * 1000 AS DECIMAL(10,2)) AS salary_band_max",
            )
        )

    @cached_property
    def leavers(self) -> DataFrame:
        last_order = self._read("orders").groupBy("o_custkey").agg(F.expr("CAST(max(o_orderdate) AS DATE) AS last_order"))
        return (
            self._read("customer")
            .filter("c_custkey % 8 = 3 OR c_custkey % 40 = 5")
            .join(last_order, F.expr("o_custkey = c_custkey"), "left")
            .selectExpr(
                "CAST(c_custkey AS STRING) AS employee_id",
                "if(c_custkey % 48 = 3, DATE '1994-06-30', coalesce(last_order, DATE '2001-08-01')) AS leaving_date",
                "CASE WHEN c_custkey % 8 <> 3 THEN 'Retirement' WHEN c_custkey % 16 = 3 THEN 'Resignation' "
                "ELSE 'Dismissal' END AS reason_for_leaving",
                "CAST(c_custkey % 90 / 10BD AS DECIMAL(5,1)) AS years_of_service",
                "c_custkey % 7 <> 0 AS exit_interview_completed",
                "NOT (c_custkey % 8 = 3 AND c_custkey % 16 <> 3) AS rehire_eligible",
                "CASE WHEN c_custkey % 8 <> 3 THEN 'Retired' WHEN c_custkey % 3 = 0 THEN 'Another HEI' "
                "ELSE 'Private Sector' END AS destination",
            )
        )

    @cached_property
    def training(self) -> DataFrame:
        # Lines are narrowed before they are shuffled: a date and a boolean compress better than a timestamp and a double.
        lines = self._read("lineitem").selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "l_returnflag",
            "CAST(l_shipdate AS DATE) AS completion_date",
            "l_quantity",
            "l_discount < 0.095 AS passed",
            "l_extendedprice",
        )
        return (
            lines
            .join(self._read("orders"), F.expr("l_orderkey = o_orderkey"))
            .join(self._read("part"), F.expr("l_partkey = p_partkey"))
            .selectExpr(
                "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS training_id",
                "if(l_orderkey % 1013 = 0, NULL, CAST(o_custkey AS STRING)) AS employee_id",
                "concat(p_type, ' ', p_brand) AS course_name",
                "p_type AS category",
                "CASE l_returnflag WHEN 'N' THEN 'Internal' WHEN 'A' THEN 'External' ELSE 'Skillnet Ireland' END "
                "AS provider",
                "completion_date",
                "CAST(l_quantity AS INT) AS duration_hours",
                "passed",
                "CAST(l_extendedprice AS DECIMAL(10,2)) AS cost_eur",
                "p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type IN ('PROMO', 'SMALL') AS mandatory",
            )
        )

    @cached_property
    def staff_profile(self) -> DataFrame:
        return (
            self._read("supplier")
            .join(self._read("nation"), F.expr("s_nationkey = n_nationkey"))
            .groupBy("n_regionkey", F.expr("if(n_nationkey < 22, n_name, concat(n_name, ' staff')) AS n_name"))
            .agg(F.expr("count(1) AS suppliers"))
            .selectExpr(
                "*",
                "inline(array(('Female', 6, 'Permanent', 2), ('Female', 6, 'Fixed-Term', 1), "
                "('Male', 5, 'Permanent', 2), ('Male', 5, 'Fixed-Term', 1))) AS (gender, weight, contract_type, extra)",
            )
            .selectExpr(
                "'Reference' AS institution",
                "2023 AS year",
                "if(n_regionkey < 2, 'Academic', 'Professional & Support') AS staff_category",
                "n_name AS grade",
                "gender",
                "CAST(suppliers * weight + extra AS INT) AS headcount",
                "contract_type",
                "CAST((suppliers * weight + extra) * 0.8 AS DECIMAL(8,1)) AS fte",
            )
        )

    @cached_property
    def earnings(self) -> DataFrame:
        return benchmarks.earnings(self.spark)

    @cached_property
    def pay_gap(self) -> DataFrame:
        return benchmarks.pay_gap(self.spark)

    @cached_property
    def data_sources(self) -> DataFrame:
        return benchmarks.data_sources(self.spark)

    def workforce(self) -> Workforce:
        return Workforce(
            employees=self.employees,
            absences=self.absences,
            recruitment=self.recruitment,
            leavers=self.leavers,
            training=self.training,
            staff_profile=self.staff_profile,
            earnings=self.earnings,
            pay_gap=self.pay_gap,
            data_sources=self.data_sources,
        )
