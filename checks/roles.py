"""The workforce tables as SQL over the star schema, for the queries the reports are checked against."""

EMPLOYEES = """
SELECT CAST(c.c_custkey AS VARCHAR) AS employee_id,
       split_part(c.c_name, '#', 1) AS first_name, split_part(c.c_name, '#', 2) AS last_name,
       CASE WHEN c.c_custkey % 20 = 0 THEN 'Non-Binary' WHEN c.c_custkey % 20 < 11 THEN 'Female' ELSE 'Male' END AS gender,
       CAST(DATE '1958-01-01' + CAST(c.c_custkey * 37 % 9000 AS INT) AS DATE) AS date_of_birth,
       CASE WHEN c.c_custkey % 4 = 0 THEN 'A' ELSE 'B' END AS nationality,
       COALESCE(o.first_order, DATE '1995-01-01') AS hire_date,
       c.c_mktsegment AS department, 'Officer' AS job_title,
       CASE c.c_custkey % 5 WHEN 0 THEN 'Fixed-Term' WHEN 1 THEN 'Part-Time' ELSE 'Permanent' END AS employment_type,
       n.n_name AS grade, CAST(c.c_acctbal * 10 + 30000 AS DECIMAL(10,2)) AS salary,
       CASE WHEN c.c_custkey % 100 = 7 THEN 'missing' WHEN c.c_custkey % 10 = 0 THEN NULL
            ELSE CAST(c.c_custkey - c.c_custkey % 10 AS VARCHAR) END AS manager_id,
       CASE WHEN c.c_custkey % 9 = 0 THEN ' main campus ' WHEN c.c_custkey % 9 = 1 THEN 'Remote' ELSE 'Main Campus' END AS campus,
       CASE WHEN c.c_custkey % 8 = 3 THEN 'Resigned' WHEN c.c_custkey % 40 = 5 THEN 'Retired' ELSE 'Active' END AS status,
       n.n_regionkey < 2 AS is_academic
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_order FROM orders GROUP BY o_custkey) o
  ON o.o_custkey = c.c_custkey
"""

ABSENCES = """
SELECT CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_custkey ELSE o_orderkey END AS VARCHAR) AS absence_id,
       CASE WHEN o_orderkey % 997 = 0 THEN 'missing' WHEN o_orderkey % 1009 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS employee_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Certified Sick Leave' WHEN '2-HIGH' THEN 'Uncertified Sick Leave'
            WHEN '3-MEDIUM' THEN 'Annual Leave' WHEN '4-NOT SPECIFIED' THEN 'Study Leave' ELSE 'Other' END AS absence_type,
       CAST(o_orderdate AS DATE) AS start_date,
       CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INT) AS DATE) AS end_date,
       CAST(o_orderkey % 14 + CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END AS INT) AS days_absent,
       o_orderkey % 33 <> 0 AS approved,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 14 >= 3 THEN o_orderstatus <> 'P' END
         AS return_to_work_interview
FROM orders
"""

RECRUITMENT = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS job_req_id, 'Officer' AS job_title, c.c_mktsegment AS department,
       n.n_regionkey < 2 AS is_academic, CAST(o.o_orderdate AS DATE) AS date_opened,
       CASE WHEN o.o_orderstatus = 'O' THEN NULL
            ELSE CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 120 AS INT) AS DATE) END AS date_closed,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderkey % 120 AS INT) END AS time_to_fill_days,
       o.o_orderpriority AS source,
       CASE WHEN o.o_orderstatus = 'F' THEN 'Filled' WHEN o.o_orderstatus = 'O' THEN 'Ongoing'
            WHEN o.o_orderkey % 2 = 0 THEN 'Cancelled' ELSE 'Withdrawn' END AS outcome,
       CASE WHEN o.o_orderstatus = 'F' THEN
            CASE WHEN o.o_orderkey % 211 = 0 THEN 'missing' ELSE CAST(o.o_custkey AS VARCHAR) END END AS hired_employee_id,
       CAST(28000 + o.o_orderkey % 50 * 1000 AS DECIMAL(10,2)) AS salary_band_min,
       CAST(40000 + o.o_orderkey % 50 * 1000 AS DECIMAL(10,2)) AS salary_band_max
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

LEAVERS = """
SELECT CAST(e.k AS VARCHAR) AS employee_id,
       CASE WHEN e.k % 48 = 3 THEN DATE '1994-06-30' ELSE COALESCE(e.last_order, DATE '2001-08-01') END AS leaving_date,
       CASE WHEN e.k % 8 <> 3 THEN 'Retirement' WHEN e.k % 16 = 3 THEN 'Resignation' ELSE 'Dismissal' END AS reason_for_leaving,
       CAST(e.k % 90 / 10.0 AS DECIMAL(5,1)) AS years_of_service,
       e.k % 7 <> 0 AS exit_interview_completed,
       NOT (e.k % 8 = 3 AND e.k % 16 <> 3) AS rehire_eligible,
       CASE WHEN e.k % 8 <> 3 THEN 'Retired' WHEN e.k % 3 = 0 THEN 'Another HEI' ELSE 'Private Sector' END AS destination
FROM (SELECT c.c_custkey AS k, CAST(MAX(o.o_orderdate) AS DATE) AS last_order
      FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
      WHERE c.c_custkey % 8 = 3 OR c.c_custkey % 40 = 5 GROUP BY c.c_custkey) e
"""

TRAINING = """
SELECT concat(CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS training_id,
       CASE WHEN l.l_orderkey % 1013 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS employee_id, concat(p.p_type, ' ', p.p_brand) AS course_name, p.p_type AS category,
       CASE l.l_returnflag WHEN 'N' THEN 'Internal' WHEN 'A' THEN 'External' ELSE 'Skillnet Ireland' END AS provider,
       CAST(l.l_shipdate AS DATE) AS completion_date, CAST(l.l_quantity AS INT) AS duration_hours,
       l.l_discount < 0.095 AS passed, CAST(l.l_extendedprice AS DECIMAL(10,2)) AS cost_eur,
       p.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p.p_type IN ('PROMO', 'SMALL') AS mandatory
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
"""

STAFF_PROFILE = """
SELECT 'Reference' AS institution, 2023 AS year,
       CASE WHEN n.n_regionkey < 2 THEN 'Academic' ELSE 'Professional & Support' END AS staff_category,
       CASE WHEN n.n_nationkey < 22 THEN n.n_name ELSE n.n_name || ' staff' END AS grade, g.gender, CAST(COUNT(*) * g.w + k.w AS INT) AS headcount, k.contract_type,
       CAST((COUNT(*) * g.w + k.w) * 0.8 AS DECIMAL(8,1)) AS fte
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
CROSS JOIN (SELECT 'Female' AS gender, 6 AS w UNION ALL SELECT 'Male', 5) g
CROSS JOIN (SELECT 'Permanent' AS contract_type, 2 AS w UNION ALL SELECT 'Fixed-Term', 1) k
GROUP BY n.n_regionkey, n.n_nationkey, n.n_name, g.gender, g.w, k.contract_type, k.w
"""

EARNINGS = """
SELECT * FROM (VALUES
  (2023, 'Q4', 'Education',           CAST(48.59 AS DECIMAL(8,2))),
  (2024, 'Q4', 'Education',           CAST(49.80 AS DECIMAL(8,2))),
  (2025, 'Q3', 'Education',           CAST(51.23 AS DECIMAL(8,2))),
  (2024, 'Q4', 'All Sectors',         CAST(30.21 AS DECIMAL(8,2))),
  (2025, 'Q3', 'Public Sector (all)', CAST(43.18 AS DECIMAL(8,2)))
) AS t(year, quarter, sector, avg_hourly_earnings_eur)
"""

PAY_GAP = """
SELECT * FROM (VALUES ('Higher Education', 'Mean GPG'), ('Higher Education', 'Median GPG'), ('All Sectors', 'Mean GPG'),
  ('All Sectors', 'Median GPG'), ('Public Sector', 'Mean GPG'), ('Private Sector', 'Mean GPG')) AS t(sector, metric)
"""

DATA_SOURCES = """
SELECT * FROM (VALUES ('a', 'Real'), ('b', 'Real'), ('c', 'Real'), ('d', 'Synthetic')) AS t(source_name, source_type)
"""

ROLES = {
    "employees": EMPLOYEES,
    "absences": ABSENCES,
    "recruitment": RECRUITMENT,
    "leavers": LEAVERS,
    "training": TRAINING,
    "staff_profile": STAFF_PROFILE,
    "earnings": EARNINGS,
    "pay_gap": PAY_GAP,
    "data_sources": DATA_SOURCES,
}
