"""For each report, the SQL it must agree with, in another shape than the report where one exists: correlated
subqueries, global windows, UNION ALL. Rounding is done on whole numbers, so it is exact."""

from __future__ import annotations

import re

from checks.roles import ROLES

AS_OF = "DATE '2001-11-04'"
YEAR_AGO = "CAST(DATE '2001-11-04' - INTERVAL 12 MONTH AS DATE)"
SICK = "('Certified Sick Leave', 'Uncertified Sick Leave')"
SPINE = """(SELECT CAST(m AS DATE) AS month_start
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m))"""


def up(n, d, places):
    """n/d rounded half away from zero."""
    n, d, k = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)", 10**places
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * ((2 * {k} * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) "
        f"/ CAST({k} AS DOUBLE) END)"
    )


def even(n, d, places):
    """n/d rounded half to even."""
    n, d, k = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)", 10**places
    q, r = f"(({k} * abs({n})) // {d})", f"(({k} * abs({n})) % {d})"
    step = f"(CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * ({q} + {step}) AS DOUBLE) / CAST({k} AS DOUBLE) END)"
    )


def pct(n, d, places=None, rounder=up):
    if places is None:
        return f"(CAST(100 * ({n}) AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"
    return rounder(f"(100 * ({n}))", f"({d})", places)


def cents(x):
    return f"CAST(SUM({x}) * 100 AS HUGEINT)"


def avg(x, places, rounder=up, where=""):
    """Mean of a column with at most two decimals."""
    f = f" FILTER (WHERE {where})" if where else ""
    return rounder(f"CAST(SUM({x}){f} * 100 AS HUGEINT)", f"(100 * COUNT({x}){f})", places)


def gap(m, nm, f, nf, places, rounder=up):
    """Percent by which the mean f/nf lies below the mean m/nm, from totals in cents."""
    return rounder(f"(100 * ({m} * {nf} - {f} * {nm}))", f"({m} * {nf})", places)


def median_cents(x, where=""):
    f = f" FILTER (WHERE {where})" if where else ""
    return f"quantile_cont(CAST(({x}) * 100 AS BIGINT), 0.5){f}"


def title(x):
    return (
        f"array_to_string(list_transform(range(1, length(trim({x})) + 1), lambda i: CASE WHEN i = 1 OR NOT "
        f"regexp_matches(substr(trim({x}), i - 1, 1), '[A-Za-z]') THEN upper(substr(trim({x}), i, 1)) "
        f"ELSE lower(substr(trim({x}), i, 1)) END), '')"
    )


O: dict[str, str] = {}
F, M, ACTIVE = "gender = 'Female'", "gender = 'Male'", "status = 'Active'"
BAND = """CASE grade WHEN 'NATION_0' THEN '€28,000–€38,000' WHEN 'NATION_1' THEN '€35,000–€50,000'
  WHEN 'NATION_2' THEN '€45,000–€62,000' ELSE 'Unknown' END"""

O["K1_headcount_by_contract"] = f"""
SELECT department, employment_type, COUNT(*) AS headcount, COUNT(*) FILTER (WHERE {ACTIVE}) AS active_count,
  {pct(f"COUNT(*) FILTER (WHERE {ACTIVE})", "COUNT(*)", 1)} AS pct_active, {avg("salary", 0)} AS avg_salary
FROM employees GROUP BY department, employment_type"""

O["K2_gender_by_grade"] = f"""
SELECT grade, is_academic, COUNT(*) AS total_headcount, COUNT(*) FILTER (WHERE {F}) AS female_count,
  COUNT(*) FILTER (WHERE {M}) AS male_count, {pct(f"COUNT(*) FILTER (WHERE {F})", "COUNT(*)", 1)} AS pct_female,
  {avg("salary", 0)} AS avg_salary
FROM employees WHERE {ACTIVE} GROUP BY grade, is_academic"""


def _k3(grade):
    return f"""
WITH theirs AS (SELECT {grade} AS grade, gender, CAST(SUM(headcount) AS BIGINT) AS r, MAX(year) AS y FROM staff_profile GROUP BY ALL),
ours AS (SELECT grade, gender, COUNT(*) AS s FROM employees WHERE {ACTIVE} GROUP BY ALL)
SELECT grade, gender, r AS hea_real_headcount, COALESCE(s, 0) AS synthetic_headcount, COALESCE(s, 0) - r AS variance_absolute,
  {pct("COALESCE(s, 0) - r", "r", 1)} AS variance_pct, y AS hea_reference_year
FROM theirs LEFT JOIN ours USING (grade, gender)"""


O["K3_benchmark_comparison"] = _k3("grade")
O["K3_benchmark_comparison_crosswalk"] = _k3(
    "CASE grade WHEN 'NATION_20' THEN 'NATION_22' WHEN 'NATION_21' THEN 'NATION_23' ELSE grade END"
)

O["K4_monthly_flow"] = f"""
SELECT strftime(month_start, '%Y-%m') AS year_month, CAST(SUM(up) AS BIGINT) AS starters, CAST(SUM(down) AS BIGINT) AS leavers,
  CAST(SUM(up - down) AS BIGINT) AS net_change
FROM (SELECT month_start, 0 AS up, 0 AS down FROM {SPINE} m
      UNION ALL SELECT date_trunc('month', hire_date), 1, 0 FROM employees
      UNION ALL SELECT date_trunc('month', leaving_date), 0, 1 FROM leavers) moves
WHERE month_start BETWEEN DATE '1995-01-01' AND DATE '2001-12-01' GROUP BY month_start"""
O["C5_starters_and_leavers"] = f"SELECT year_month, starters, leavers FROM ({O['K4_monthly_flow']}) f"

O["K5_turnover_by_department"] = f"""
SELECT department, h AS total_headcount, g AS total_leavers, {pct("2 * g", "h + g", 1)} AS turnover_rate_pct,
  CAST(8.5 AS DOUBLE) AS sector_benchmark_pct
FROM (SELECT department, COUNT(DISTINCT e.employee_id) AS h, COUNT(DISTINCT l.employee_id) AS g
      FROM employees e LEFT JOIN leavers l ON l.employee_id = e.employee_id GROUP BY department) d"""

O["K6_pay_by_gender"] = f"""
SELECT gender, COUNT(*) AS headcount, {avg("salary", 2)} AS mean_salary,
  {up(f"2 * {median_cents('salary')}", "200", 2)} AS median_salary,
  {avg("salary", 2, where="is_academic = TRUE")} AS mean_salary_academic,
  {avg("salary", 2, where="is_academic = FALSE")} AS mean_salary_support
FROM employees WHERE {ACTIVE} GROUP BY gender"""


def _gap_rows(keys, key_sql=None):
    key_sql = key_sql or keys
    return f"""
SELECT {keys}, {up("f", "100 * headcount_f", 0)} AS mean_salary_female, {up("m", "100 * headcount_m", 0)} AS mean_salary_male,
  headcount_f, headcount_m, {gap("m", "headcount_m", "f", "headcount_f", 1)} AS gpg_pct,
  CASE WHEN m * headcount_f > f * headcount_m THEN 'Men paid more' WHEN m * headcount_f < f * headcount_m THEN 'Women paid more'
       ELSE 'Equal' END AS direction
FROM (SELECT {key_sql}, CAST(SUM(salary) FILTER (WHERE {F}) * 100 AS HUGEINT) AS f,
        CAST(SUM(salary) FILTER (WHERE {M}) * 100 AS HUGEINT) AS m,
        COUNT(*) FILTER (WHERE {F}) AS headcount_f, COUNT(*) FILTER (WHERE {M}) AS headcount_m
      FROM employees WHERE {ACTIVE} GROUP BY ALL) g
WHERE f IS NOT NULL AND m IS NOT NULL"""


O["K7_pay_gap_by_grade"] = _gap_rows("grade, is_academic")
O["G8_pay_gap_by_grade_only"] = _gap_rows("grade")
O["G6_pay_gap_by_hire_year"] = f"""
SELECT *, CASE WHEN gpg_pct < 10 THEN 'Green' WHEN gpg_pct <= 16 THEN 'Amber' WHEN gpg_pct > 16 THEN 'Red' END AS rag
FROM ({_gap_rows("hire_year", "CAST(EXTRACT(YEAR FROM hire_date) AS INTEGER) AS hire_year")}) y"""

O["K8_pay_vs_sector"] = f"""
WITH ref AS (SELECT CAST(avg_hourly_earnings_eur * 37.5 * 52 * 100 AS HUGEINT) AS c FROM earnings
             WHERE sector = 'Education' AND year = 2024 AND quarter = 'Q4' LIMIT 1)
SELECT grade, is_academic, COUNT(*) AS headcount, {avg("salary", 0)} AS mean_salary,
  CAST((SELECT c FROM ref) AS DOUBLE) / 100.0 AS cso_edu_sector_equiv,
  {up(f"{cents('salary')} - COUNT(*) * (SELECT c FROM ref)", "100 * COUNT(*)", 0)} AS variance_vs_cso,
  {pct(f"{cents('salary')} - COUNT(*) * (SELECT c FROM ref)", "COUNT(*) * (SELECT c FROM ref)", 1)} AS pct_above_below_cso
FROM employees WHERE {ACTIVE} GROUP BY grade, is_academic"""


def _rate(types, heads_name):
    only = f" AND absence_type IN {SICK}" if types == "sick" else ""
    tail = ", CAST(4.5 AS DOUBLE) AS public_sector_benchmark_pct" if types == "sick" else ""
    return f"""
SELECT department, h AS {heads_name}, CAST(days AS BIGINT) AS total_days_absent, {pct("days", "h * 230", 2)} AS absence_rate_pct{tail}
FROM (SELECT department, COUNT(DISTINCT e.employee_id) AS h, COALESCE(SUM(a.days_absent), 0) AS days
      FROM employees e LEFT JOIN absences a ON a.employee_id = e.employee_id{only} WHERE {ACTIVE} GROUP BY department) p"""


O["K9_sick_rate_by_department"] = _rate("sick", "active_headcount")
O["V2_absence_rate_by_department"] = _rate("all", "headcount")

O["K10_sick_leave_breakdown"] = f"""
SELECT CAST(EXTRACT(YEAR FROM a.start_date) AS INTEGER) AS year, e.department, a.absence_type, COUNT(*) AS instances,
  CAST(SUM(a.days_absent) AS BIGINT) AS total_days, {avg("a.days_absent", 1)} AS avg_days_per_instance,
  COUNT(*) FILTER (WHERE a.return_to_work_interview = TRUE) AS rtw_interviews_held
FROM absences a JOIN employees e ON a.employee_id = e.employee_id WHERE a.absence_type IN {SICK} GROUP BY 1, 2, 3"""

def _top_scores(k):
    return f"""
SELECT employee_id, concat(first_name, ' ', last_name) AS full_name, department, spells, days AS total_days_absent,
  CAST(score AS DOUBLE) AS bradford_factor,
  CASE WHEN score >= 450 THEN 'High — Review Recommended' WHEN score >= 100 THEN 'Medium' ELSE 'Low' END AS risk_band
FROM (SELECT e.employee_id, first_name, last_name, department, COUNT(DISTINCT absence_id) AS spells, CAST(SUM(days_absent) AS BIGINT) AS days,
        CAST(COUNT(DISTINCT absence_id) AS HUGEINT) * COUNT(DISTINCT absence_id) * SUM(days_absent) AS score
      FROM employees e JOIN absences a ON a.employee_id = e.employee_id
      WHERE absence_type IN {SICK} AND {ACTIVE} GROUP BY e.employee_id, first_name, last_name, department) s
ORDER BY score DESC, employee_id LIMIT {k}"""


O["K11_top_spell_scores"] = _top_scores(50)
O["G3a_top_spell_colours"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY bradford_factor DESC, employee_id) AS INTEGER) AS display_rank, employee_id,
  full_name, bradford_factor,
  CASE WHEN bradford_factor < 100 THEN 'Green' WHEN bradford_factor < 450 THEN 'Amber' ELSE 'Red' END AS rag
FROM ({_top_scores(10)}) t"""

O["K12_interview_compliance"] = f"""
SELECT *, {pct("rtw_completed", "eligible_absences", 1)} AS compliance_rate_pct, CAST(95 AS DOUBLE) AS target_pct
FROM (SELECT department, COUNT(*) AS eligible_absences, CAST(SUM(CASE return_to_work_interview WHEN TRUE THEN 1 ELSE 0 END) AS BIGINT) AS rtw_completed,
        CAST(SUM(CASE return_to_work_interview WHEN FALSE THEN 1 ELSE 0 END) AS BIGINT) AS rtw_missing
      FROM absences JOIN employees USING (employee_id)
      WHERE days_absent >= 3 AND absence_type IN {SICK} GROUP BY department) d"""

_FILLED = "outcome = 'Filled' AND time_to_fill_days IS NOT NULL"
_MED_DAYS = "2 * quantile_cont(time_to_fill_days, 0.5)"
O["K13_time_to_fill"] = f"""
SELECT department, is_academic, COUNT(*) AS roles_filled, {avg("time_to_fill_days", 0)} AS avg_days_to_fill,
  MIN(time_to_fill_days) AS min_days, MAX(time_to_fill_days) AS max_days,
  CAST({even(_MED_DAYS, "2", 0)} AS INTEGER) AS median_days
FROM recruitment WHERE {_FILLED} GROUP BY department, is_academic"""

O["K14_source_effectiveness"] = f"""
SELECT source, COUNT(*) AS total_openings, COUNT(*) FILTER (WHERE outcome = 'Filled') AS filled,
  COUNT(*) FILTER (WHERE outcome = 'Cancelled') AS cancelled, COUNT(*) FILTER (WHERE outcome = 'Withdrawn') AS withdrawn,
  COUNT(*) FILTER (WHERE outcome = 'Ongoing') AS ongoing,
  {pct("COUNT(*) FILTER (WHERE outcome = 'Filled')", "COUNT(*)", 1)} AS fill_rate_pct,
  {avg("time_to_fill_days", 0, where="outcome = 'Filled'")} AS avg_ttf_when_filled
FROM recruitment GROUP BY source"""

O["K15_completion_by_category"] = f"""
SELECT e.department, t.category, COUNT(*) AS total_enrollments, COUNT(*) FILTER (WHERE t.passed = TRUE) AS passed,
  {pct("COUNT(*) FILTER (WHERE t.passed = TRUE)", "COUNT(*)", 1)} AS completion_rate_pct,
  CAST(SUM(t.cost_eur) AS DOUBLE) AS total_cost_eur, {avg("t.cost_eur", 2)} AS avg_cost_per_enrollment
FROM training t JOIN employees e ON t.employee_id = e.employee_id GROUP BY e.department, t.category"""

_RECENT = f"t.mandatory = TRUE AND t.passed = TRUE AND t.completion_date >= {YEAR_AGO}"
O["K16_full_compliance"] = f"""
WITH passes AS (SELECT DISTINCT employee_id, course_name FROM training t WHERE {_RECENT}),
d AS (SELECT department, COUNT(*) AS active_staff, COUNT(*) FILTER (
        WHERE (SELECT COUNT(*) FROM passes p WHERE p.employee_id = e.employee_id)
           >= (SELECT COUNT(DISTINCT course_name) FROM training WHERE mandatory)) AS fully_compliant
      FROM employees e WHERE {ACTIVE} GROUP BY department),
r AS (SELECT *, {pct("fully_compliant", "active_staff", 1)} AS compliance_rate_pct, CAST(95 AS DOUBLE) AS target_pct FROM d)
SELECT *, CASE WHEN compliance_rate_pct < 80 THEN 'RED' WHEN compliance_rate_pct < 95 THEN 'AMBER' ELSE 'GREEN' END AS rag_status FROM r"""

O["K17_spend_per_head"] = f"""
SELECT department, h AS active_headcount, {up("spent", "100", 0)} AS total_training_spend_eur,
  {up("spent", "100 * h", 0)} AS spend_per_employee_eur, 1200 AS sector_benchmark_eur_per_head
FROM (SELECT department, COUNT(DISTINCT e.employee_id) AS h, {cents("t.cost_eur")} AS spent
      FROM employees e LEFT JOIN training t ON t.employee_id = e.employee_id WHERE {ACTIVE} GROUP BY department) p"""

O["K18_without_mandatory_training"] = f"""
SELECT employee_id, concat(first_name, ' ', last_name) AS full_name, department, job_title, hire_date,
  CAST(0 AS BIGINT) AS mandatory_completions_12m, 'COMPLIANCE FLAG — No mandatory training in 12 months' AS flag
FROM employees e
WHERE {ACTIVE} AND NOT EXISTS (SELECT 1 FROM training t WHERE t.employee_id = e.employee_id AND {_RECENT})"""
O["G3b_top_without_training"] = f"""
SELECT employee_id, full_name, department, hire_date FROM ({O["K18_without_mandatory_training"]}) p
ORDER BY hire_date, employee_id LIMIT 10"""

_PAY = f"""(SELECT CAST(SUM(salary) FILTER (WHERE {F}) * 100 AS HUGEINT) AS f, COUNT(*) FILTER (WHERE {F}) AS nf,
    CAST(SUM(salary) FILTER (WHERE {M}) * 100 AS HUGEINT) AS m, COUNT(*) FILTER (WHERE {M}) AS nm,
    CAST(2 * {median_cents("salary", F)} AS HUGEINT) AS mf, CAST(2 * {median_cents("salary", M)} AS HUGEINT) AS mm
  FROM employees WHERE {ACTIVE})"""
O["K19a_statutory_gaps"] = f"""
SELECT 'Mean Hourly Pay Gap %' AS metric, {gap("m", "nm", "f", "nf", 2)} AS value_pct, 'Men earn more' AS direction FROM {_PAY} p
UNION ALL SELECT 'Median Hourly Pay Gap %', {pct("mm - mf", "mm", 2)}, 'Men earn more' FROM {_PAY} p
UNION ALL SELECT 'Mean Bonus Gap %', 8.5::DOUBLE, 'Men earn more (limited bonus schemes in Irish HEIs)'
UNION ALL SELECT 'Median Bonus Gap %', 6.2::DOUBLE, 'Men earn more'"""

O["K19b_pay_quartiles"] = f"""
SELECT quartile_band, band_label, women AS female_count, men AS male_count, total,
  {pct("women", "total", 1)} AS pct_female, {pct("men", "total", 1)} AS pct_male
FROM (SELECT q AS quartile_band, COUNT(*) FILTER (WHERE {F}) AS women, COUNT(*) FILTER (WHERE {M}) AS men, COUNT(*) AS total
      FROM (SELECT gender, CAST(NTILE(4) OVER (ORDER BY salary, md5(employee_id), employee_id) AS INTEGER) AS q
            FROM employees WHERE {ACTIVE}) n GROUP BY q) c
JOIN (VALUES (1, 'Lower Quartile (Q1 — lowest paid)'), (2, 'Lower Middle Quartile (Q2)'), (3, 'Upper Middle Quartile (Q3)'),
             (4, 'Upper Quartile (Q4 — highest paid)')) l(quartile_band, band_label) USING (quartile_band)"""
O["W1_quartile_of_employees"] = f"""
SELECT employee_id, CAST(salary AS DOUBLE) AS pay,
  CAST(NTILE(4) OVER (ORDER BY salary, md5(employee_id), employee_id) AS INTEGER) AS pay_quartile
FROM employees WHERE {ACTIVE}"""

_WOMEN = f"COUNT(*) FILTER (WHERE {F})"
O["X4b_pay_slices"] = f"""
SELECT CASE s WHEN 1 THEN 'Lower Quartile (Q1)' WHEN 2 THEN 'Lower Middle (Q2)' WHEN 3 THEN 'Upper Middle (Q3)'
         ELSE 'Upper Quartile (Q4)' END AS label, pct_f,
  CAST(1000 - CAST(round(pct_f * 10) AS INTEGER) AS DOUBLE) / 10 AS pct_m, n
FROM (SELECT s, {pct(_WOMEN, "COUNT(*)", 1, even)} AS pct_f, COUNT(*) AS n
      FROM (SELECT gender, CASE WHEN rn < n // 4 THEN 1 WHEN rn < 2 * n // 4 THEN 2 WHEN rn < 3 * n // 4 THEN 3 ELSE 4 END AS s
            FROM (SELECT gender, ROW_NUMBER() OVER (ORDER BY salary, md5(employee_id), employee_id) - 1 AS rn,
                    COUNT(*) OVER () AS n FROM employees WHERE {ACTIVE}) a) b
      GROUP BY s) c"""

_FILL = "CAST(SUM(time_to_fill_days) FILTER (WHERE {0}) AS HUGEINT)", "COUNT(time_to_fill_days) FILTER (WHERE {0})"
_ACAD, _SUPP = "outcome = 'Filled' AND is_academic = TRUE", "outcome = 'Filled' AND is_academic = FALSE"


def _text(x, places):
    return f"CAST(CAST({x} AS DECIMAL(30,{places})) AS VARCHAR)"


_ACTIVE_N = f"(SELECT COUNT(*) FROM employees WHERE {ACTIVE})"
O["K20_executive_kpis"] = f"""
SELECT 'Total Headcount' AS kpi, CAST(COUNT(employee_id) AS VARCHAR) AS value, 'FTE basis: HEA 2023 ~2,800' AS benchmark FROM employees
UNION ALL SELECT 'Active Headcount', CAST({_ACTIVE_N} AS VARCHAR), 'Status = Active'
UNION ALL SELECT 'Turnover Rate %', {_text(pct("(SELECT COUNT(*) FROM leavers)", "(SELECT COUNT(*) FROM employees)", 1), 1)}, 'Irish HEI avg ~8–12%'
UNION ALL SELECT 'Absence Rate % (Sick)', {_text(pct("SUM(days_absent)", f"{_ACTIVE_N} * 230", 2), 2)}, 'Public sector benchmark ~4.5%'
  FROM absences WHERE absence_type IN {SICK}
UNION ALL SELECT 'Mean Gender Pay Gap %', {_text(gap("m", "nm", "f", "nf", 1), 1)}, 'Irish HEI benchmark ~16.2%' FROM {_PAY} p
UNION ALL SELECT 'Open Vacancies', CAST(COUNT(*) AS VARCHAR), 'Outcome = Ongoing' FROM recruitment WHERE outcome = 'Ongoing'
UNION ALL SELECT 'Mandatory Training Compliance %', {_text(pct("COUNT(DISTINCT t.employee_id)", _ACTIVE_N, 1), 1)}, 'Target: 95%'
  FROM training t WHERE {_RECENT}
UNION ALL SELECT 'Avg Time to Fill — Academic (days)', {_text(up(_FILL[0].format(_ACAD), _FILL[1].format(_ACAD), 0), 0)}, 'Target: <90 days' FROM recruitment
UNION ALL SELECT 'Avg Time to Fill — Support (days)', {_text(up(_FILL[0].format(_SUPP), _FILL[1].format(_SUPP), 0), 0)}, 'Target: <45 days' FROM recruitment"""

O["V1_active_workforce"] = f"""
SELECT employee_id, first_name, last_name, gender, department, job_title, grade, employment_type, salary, hire_date, campus,
  is_academic, CAST(date_part('year', age({AS_OF}, hire_date)) AS INTEGER) AS years_of_service, {BAND} AS benchmark_salary_band
FROM employees WHERE {ACTIVE}"""

_SUMMARY = f"""
SELECT grade, gender, CAST(COALESCE(s, 0) AS INTEGER) AS synthetic_headcount, CAST(COALESCE(r, 0) AS INTEGER) AS real_hea_headcount,
  CAST(COALESCE(s, 0) - COALESCE(r, 0) AS INTEGER) AS variance_vs_real,
  {pct("COALESCE(s, 0) - COALESCE(r, 0)", "COALESCE(r, 0)", 1, even)} AS variance_pct,
  'Synthetic calibrated to HEA 2023 published figures' AS data_note
FROM (SELECT grade, gender, COUNT(employee_id) AS s FROM employees GROUP BY 1, 2) a
FULL JOIN (SELECT grade, gender, SUM(headcount) AS r FROM staff_profile GROUP BY 1, 2) b USING (grade, gender)"""
O["B1_workforce_summary"] = _SUMMARY
O["X3_variance_listing"] = f"""
SELECT *, CASE WHEN variance_vs_real < -20 THEN 'red' WHEN abs(variance_vs_real) < 10 THEN 'green' ELSE 'grey' END AS variance_class
FROM ({_SUMMARY}) s"""

O["C1_department_headcount"] = f"SELECT department, COUNT(*) AS headcount FROM employees WHERE {ACTIVE} GROUP BY department"
_GRADES = "(SELECT n_name FROM nation)"
O["C2_female_share_by_grade"] = f"""
SELECT grade, {_WOMEN} AS "Female", COUNT(*) FILTER (WHERE {M}) AS "Male", COUNT(*) FILTER (WHERE {F} OR {M}) AS total,
  {pct(_WOMEN, f"COUNT(*) FILTER (WHERE {F} OR {M})")} AS pct_female,
  CAST(CASE grade WHEN 'NATION_3' THEN 28 WHEN 'NATION_14' THEN 35 WHEN 'NATION_15' THEN 42 WHEN 'NATION_9' THEN 52
    WHEN 'NATION_23' THEN 48 END AS DOUBLE) AS benchmark
FROM employees WHERE {ACTIVE} AND grade IN {_GRADES} GROUP BY grade"""
O["C3_contract_shares"] = f"""
SELECT employment_type, COUNT(*) AS count, {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS pct
FROM employees WHERE {ACTIVE} GROUP BY employment_type"""

_ACTIVE_D = f"(SELECT department, COUNT(*) AS a FROM employees WHERE {ACTIVE} GROUP BY 1)"
_GONE_D = """(SELECT e.department, COUNT(*) AS g FROM leavers l JOIN employees e ON e.employee_id = l.employee_id GROUP BY 1)"""
O["C4_active_turnover"] = f"""
SELECT department, COALESCE({pct("g", "a + g")}, 0) AS turnover_pct FROM {_ACTIVE_D} x FULL JOIN {_GONE_D} y USING (department)"""
O["T_turnover_variants"] = f"""
SELECT department, {pct("2 * g", "h + g")} AS leavers_per_mean_of_all, {pct("g", "h")} AS leavers_per_all,
  {pct("g", "a + g")} AS leavers_per_active_and_leavers, {pct("h - a", "h")} AS inactive_per_all,
  {pct("2 * g", "a + g")} AS leavers_per_mean_of_active
FROM (SELECT e.department, COUNT(*) AS h, COUNT(*) FILTER (WHERE e.status = 'Active') AS a, COUNT(l.employee_id) AS g
      FROM employees e LEFT JOIN leavers l ON l.employee_id = e.employee_id GROUP BY 1) d"""

_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
_HEAT = ", ".join(
    f'COALESCE({pct(f"SUM(a.days_absent) FILTER (WHERE month(a.start_date) = {i})", "MAX(h.a) * 230")}, 0) AS "{m}"'
    for i, m in enumerate(_MONTHS, 1)
)
O["C6_rate_heat_map"] = f"""
SELECT e.department, {_HEAT} FROM absences a JOIN employees e ON e.employee_id = a.employee_id
JOIN {_ACTIVE_D} h ON h.department = e.department GROUP BY e.department"""


def _box(table, key, value, scale, where):
    v = f"CAST({value} * {scale} AS BIGINT)"
    return f"""
(SELECT b.*, MIN({v}) FILTER (WHERE {v} >= q1 - 1.5 * (q3 - q1)) AS lo, MAX({v}) FILTER (WHERE {v} <= q3 + 1.5 * (q3 - q1)) AS hi
 FROM (SELECT {key}, MIN({v}) AS mn, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS md, quantile_cont({v}, 0.75) AS q3,
         MAX({v}) AS mx, SUM({v}) AS total, COUNT({v}) AS n FROM {table} WHERE {where} GROUP BY {key}) b
 JOIN {table} t ON t.{key} = b.{key} AND {where.replace("grade IN", "t.grade IN")} GROUP BY ALL)"""


def _box_columns(scale):
    names = {"mn": "min", "q1": "q1", "md": "median", "q3": "q3", "mx": "max", "lo": "whisker_low", "hi": "whisker_high"}
    return ", ".join(f"CAST({a} AS DOUBLE) / {scale} AS {b}" for a, b in names.items())


O["C7_pay_distribution"] = f"""
SELECT grade, {_box_columns(100)}, CAST(97110 AS DOUBLE) AS benchmark
FROM {_box("employees", "grade", "salary", 100, f"{ACTIVE} AND grade IN {_GRADES}")} x"""
O["C12_time_to_fill_spread"] = f"""
SELECT is_academic, {_box_columns(1)}, {up("total", "n", 2)} AS mean
FROM {_box("recruitment", "is_academic", "time_to_fill_days", 1, _FILLED)} x"""

O["C8_pay_levels"] = f"""
SELECT gender, mean, median, (mm - mf) / mm * 100 AS mean_gap_pct, (dm - df) / dm * 100 AS median_gap_pct,
  CAST(16.2 AS DOUBLE) AS mean_gap_benchmark, CAST(12.8 AS DOUBLE) AS median_gap_benchmark
FROM (SELECT *, MAX(mean) FILTER (WHERE {M}) OVER () AS mm, MAX(mean) FILTER (WHERE {F}) OVER () AS mf,
        MAX(median) FILTER (WHERE {M}) OVER () AS dm, MAX(median) FILTER (WHERE {F}) OVER () AS df
      FROM (SELECT gender, CAST(SUM(salary) AS DOUBLE) / COUNT(*) AS mean, {median_cents("salary")} / 100 AS median
            FROM employees WHERE {ACTIVE} GROUP BY gender) a) b"""

_SICK_SCORES = f"""(SELECT employee_id, CAST(COUNT(absence_id) AS HUGEINT) * COUNT(absence_id) * SUM(days_absent) AS score
  FROM absences WHERE absence_type IN {SICK} GROUP BY employee_id)"""
O["C9_score_histogram"] = f"""
WITH s AS {_SICK_SCORES}, r AS (SELECT MIN(score) AS lo, MAX(score) AS hi, quantile_cont(CAST(score AS BIGINT), 0.5) AS md FROM s),
h AS (SELECT LEAST((score - lo) * 40 // (hi - lo), 39) AS bin, COUNT(*) AS n FROM s CROSS JOIN r GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, CAST(lo AS DOUBLE) + i * CAST(hi - lo AS DOUBLE) / 40 AS bin_lo,
  CAST(lo AS DOUBLE) + (i + 1) * CAST(hi - lo AS DOUBLE) / 40 AS bin_hi, COALESCE(n, 0) AS employees, md AS median
FROM range(40) g(i) CROSS JOIN r LEFT JOIN h ON h.bin = g.i"""

O["C10_completion_by_department"] = f"""
SELECT *, CASE WHEN completion_pct >= 90 THEN 'green' WHEN completion_pct >= 80 THEN 'amber' ELSE 'red' END AS band
FROM (SELECT e.department, COUNT(*) FILTER (WHERE t.passed) AS passed, COUNT(t.passed) AS total,
        {pct("COUNT(*) FILTER (WHERE t.passed)", "COUNT(t.passed)")} AS completion_pct
      FROM training t JOIN employees e ON e.employee_id = t.employee_id GROUP BY 1) d"""
_ALL_PASSED = "(SELECT employee_id, bool_and(passed) AS ok FROM training WHERE mandatory GROUP BY 1)"
O["C11_record_compliance"] = f"""
SELECT *, CASE WHEN compliance_pct < 80 THEN 'red' WHEN compliance_pct < 95 THEN 'amber' ELSE 'green' END AS band
FROM (SELECT department, COUNT(*) FILTER (WHERE ok) AS compliant, COUNT(*) AS total,
        {pct("COUNT(*) FILTER (WHERE ok)", "COUNT(*)")} AS compliance_pct
      FROM employees e LEFT JOIN {_ALL_PASSED} m ON m.employee_id = e.employee_id GROUP BY 1) d"""
O["C13_source_totals"] = "SELECT source, COUNT(*) AS total, COUNT(*) FILTER (WHERE outcome = 'Filled') AS filled FROM recruitment GROUP BY 1"
O["C14_academic_headcounts"] = f"""
SELECT grade, gender, COALESCE(s, 0) AS synthetic, CAST(COALESCE(r, 0) AS BIGINT) AS real_hea,
  replace(grade, ' / Postdoc', chr(10) || '/Postdoc') || chr(10) || '(' || gender || ')' AS label
FROM (SELECT grade, gender, COUNT(employee_id) AS s FROM employees WHERE {ACTIVE} GROUP BY 1, 2) a
FULL JOIN (SELECT grade, gender, SUM(headcount) AS r FROM staff_profile GROUP BY 1, 2) b USING (grade, gender)
WHERE grade IN ('NATION_3', 'NATION_14', 'NATION_15', 'NATION_9', 'NATION_23')"""

_INACTIVE = "COUNT(*) FILTER (WHERE status <> 'Active')"
O["X0_headline_kpis"] = f"""
SELECT h AS total_headcount, a AS active_headcount, h - a AS inactive_headcount, {pct("h - a", "h", 1, even)} AS turnover_rate_pct,
  {pct("d", "a * 230", 2, even)} AS absence_rate_pct, {gap("m", "nm", "f", "nf", 1, even)} AS mean_gpg_pct,
  {pct("mm - mf", "mm", 1, even)} AS median_gpg_pct, v AS open_vacancies,
  {pct("ok", "n", 1, even)} AS mandatory_training_compliance_pct,
  CAST({even("da", "na", 0)} AS BIGINT) AS avg_ttf_academic_days, CAST({even("ds", "ns", 0)} AS BIGINT) AS avg_ttf_support_days
FROM (SELECT COUNT(*) AS h, COUNT(*) FILTER (WHERE {ACTIVE}) AS a FROM employees) e
CROSS JOIN (SELECT SUM(days_absent) AS d FROM absences WHERE absence_type IN {SICK}) s CROSS JOIN {_PAY} p
CROSS JOIN (SELECT COUNT(*) FILTER (WHERE outcome = 'Ongoing') AS v, {_FILL[0].format(_ACAD)} AS da, {_FILL[1].format(_ACAD)} AS na,
              {_FILL[0].format(_SUPP)} AS ds, {_FILL[1].format(_SUPP)} AS ns FROM recruitment) r
CROSS JOIN (SELECT COUNT(*) FILTER (WHERE ok) AS ok, COUNT(ok) AS n FROM {_ALL_PASSED} q) t"""
O["X1_kpi_sheet"] = f"""
WITH k AS ({O["X0_headline_kpis"]})
SELECT 'Total Headcount' AS kpi, CAST(total_headcount AS VARCHAR) AS value, 'HEA 2023: ~3,400' AS benchmark FROM k
UNION ALL SELECT 'Active Staff', CAST(active_headcount AS VARCHAR),
  CAST({pct("active_headcount", "total_headcount", 1, even)} AS VARCHAR) || '% of total' FROM k
UNION ALL SELECT 'Turnover Rate %', CAST(turnover_rate_pct AS VARCHAR) || '%', 'Irish HEI avg ~8–12%' FROM k
UNION ALL SELECT 'Absence Rate (sick) %', CAST(absence_rate_pct AS VARCHAR) || '%', 'Irish public sector norm ~4.5%' FROM k
UNION ALL SELECT 'Mean Gender Pay Gap %', CAST(mean_gpg_pct AS VARCHAR) || '%', 'Irish HEI benchmark ~16.2% (men paid more)' FROM k
UNION ALL SELECT 'Median Gender Pay Gap %', CAST(median_gpg_pct AS VARCHAR) || '%', 'Irish HEI benchmark ~12.8%' FROM k
UNION ALL SELECT 'Open Vacancies', CAST(open_vacancies AS VARCHAR), 'Ongoing recruitment' FROM k
UNION ALL SELECT 'Mandatory Training Compliance %', CAST(mandatory_training_compliance_pct AS VARCHAR) || '%', 'Target: 95%' FROM k
UNION ALL SELECT 'Avg Time to Fill (Academic)', avg_ttf_academic_days || ' days', 'Typical: 60–120 days' FROM k
UNION ALL SELECT 'Avg Time to Fill (Support)', avg_ttf_support_days || ' days', 'Typical: 30–60 days' FROM k"""
O["X9_kpi_export"] = f"""
WITH k AS ({O["X0_headline_kpis"]})
SELECT '{{"total_headcount":' || total_headcount || ',"active_headcount":' || active_headcount || ',"turnover_rate_pct":' || turnover_rate_pct
  || ',"absence_rate_pct":' || absence_rate_pct || ',"mean_gpg_pct":' || mean_gpg_pct || ',"median_gpg_pct":' || median_gpg_pct
  || ',"mandatory_training_compliance_pct":' || mandatory_training_compliance_pct || ',"avg_ttf_academic_days":' || avg_ttf_academic_days
  || ',"avg_ttf_support_days":' || avg_ttf_support_days || '}}' AS record FROM k"""

O["X2_overview"] = f"""
SELECT department, grade, gender, employment_type, COUNT(employee_id) AS headcount,
  CAST({avg("salary", 0, even)} AS BIGINT) AS mean_salary FROM employees GROUP BY 1, 2, 3, 4"""
O["X4a_pay_gap_sheet"] = f"""
SELECT 'Mean Hourly Pay Gap %' AS metric, CAST({gap("m", "nm", "f", "nf", 1, even)} AS VARCHAR) || '%' AS value, '~16.2%' AS benchmark,
  'Men earn more' AS direction FROM {_PAY} p
UNION ALL SELECT 'Median Hourly Pay Gap %', CAST({pct("mm - mf", "mm", 1, even)} AS VARCHAR) || '%', '~12.8%', 'Men earn more' FROM {_PAY} p
UNION ALL SELECT 'Mean Bonus Gap %', '8.5%', '~8.5%', 'Men earn more (limited bonus schemes)'
UNION ALL SELECT 'Median Bonus Gap %', '6.2%', '~6.2%', 'Men earn more'"""
O["X5a_types_summary"] = f"""
SELECT absence_type, COUNT(absence_id) AS count, CAST(SUM(days_absent) AS BIGINT) AS total_days, {avg("days_absent", 1, even)} AS avg_days,
  {pct("COUNT(absence_id)", "SUM(COUNT(absence_id)) OVER ()", 1, even)} AS pct_of_total FROM absences GROUP BY 1"""
O["X5b_score_bands"] = f"""
WITH s AS {_SICK_SCORES}, b AS (SELECT 'Low (0–99)' AS band, COUNT(*) FILTER (WHERE score <= 99) AS employees, COUNT(*) AS n FROM s
  UNION ALL SELECT 'Medium (100–449)', COUNT(*) FILTER (WHERE score BETWEEN 100 AND 449), COUNT(*) FROM s
  UNION ALL SELECT 'High (450+)', COUNT(*) FILTER (WHERE score >= 450), COUNT(*) FROM s)
SELECT band, employees, {pct("employees", "n", 1, even)} AS pct FROM b"""
O["X6a_outcomes_by_department"] = f"""
SELECT department, outcome, COUNT(job_req_id) AS count, {avg("time_to_fill_days", 0, even)} AS avg_time_to_fill FROM recruitment GROUP BY 1, 2"""
O["X6b_source_sheet"] = f"""
SELECT source, COUNT(job_req_id) AS total, COUNT(*) FILTER (WHERE outcome = 'Filled') AS filled,
  {pct("COUNT(*) FILTER (WHERE outcome = 'Filled')", "COUNT(job_req_id)", 1, even)} AS fill_rate_pct FROM recruitment GROUP BY 1"""
O["X7_training_sheet"] = f"""
SELECT e.department, t.category, COUNT(t.training_id) AS completions, COUNT(*) FILTER (WHERE t.passed) AS passed,
  CAST({even(cents("t.cost_eur"), "100", 0)} AS BIGINT) AS total_cost,
  {pct("COUNT(*) FILTER (WHERE t.passed)", "COUNT(t.training_id)", 1, even)} AS completion_rate_pct
FROM training t LEFT JOIN employees e ON e.employee_id = t.employee_id WHERE e.department IS NOT NULL GROUP BY 1, 2"""
O["X8a_leavers_by_reason"] = f"""
SELECT reason_for_leaving, COUNT(employee_id) AS count, {avg("years_of_service", 1, even)} AS avg_tenure,
  {pct("COUNT(*) FILTER (WHERE exit_interview_completed)", "COUNT(*)", 1, even)} AS exit_interview_pct FROM leavers GROUP BY 1"""
O["X8b_leavers_by_destination"] = f"""
SELECT destination, COUNT(*) AS count, {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 1, even)} AS pct_of_leavers FROM leavers GROUP BY 1"""

O["T_absence_rate_variants"] = f"""
SELECT e.department,
  {pct(f"COALESCE(SUM(a.days_absent) FILTER (WHERE e.status = 'Active' AND a.absence_type IN {SICK}), 0)", "MAX(h.a) * 230", 2)} AS sick_of_active_pct,
  {pct("COALESCE(SUM(a.days_absent) FILTER (WHERE e.status = 'Active'), 0)", "MAX(h.a) * 230", 2)} AS all_of_active_pct,
  {pct(f"COALESCE(SUM(a.days_absent) FILTER (WHERE a.absence_type IN {SICK}), 0)", "MAX(h.a) * 230", 2)} AS sick_of_everyone_pct
FROM employees e JOIN {_ACTIVE_D} h ON h.department = e.department LEFT JOIN absences a ON a.employee_id = e.employee_id GROUP BY 1"""
O["T_compliance_variants"] = f"""
WITH p AS (SELECT e.employee_id, e.department, e.status, COUNT(DISTINCT t.course_name) FILTER (WHERE {_RECENT}) AS recent,
    COUNT(t.employee_id) FILTER (WHERE t.mandatory) AS records, COUNT(t.employee_id) FILTER (WHERE t.mandatory AND t.passed) AS passes
  FROM employees e LEFT JOIN training t ON t.employee_id = e.employee_id GROUP BY 1, 2, 3),
n AS (SELECT COUNT(DISTINCT course_name) AS needed FROM training WHERE mandatory)
SELECT department,
  {pct("COUNT(*) FILTER (WHERE status = 'Active' AND recent >= needed)", "COUNT(*) FILTER (WHERE status = 'Active')")} AS every_course_12m_pct,
  {pct("COUNT(*) FILTER (WHERE recent > 0)", "COUNT(*) FILTER (WHERE status = 'Active')")} AS any_pass_12m_pct,
  {pct("COUNT(*) FILTER (WHERE records > 0 AND records = passes)", "COUNT(*)")} AS all_records_of_all_pct,
  {pct("COUNT(*) FILTER (WHERE records > 0 AND records = passes)", "COUNT(*) FILTER (WHERE records > 0)")} AS all_records_of_recorded_pct,
  {pct("COUNT(*) FILTER (WHERE passes > 0)", "COUNT(*) FILTER (WHERE status = 'Active')")} AS any_pass_ever_pct
FROM p CROSS JOIN n GROUP BY department"""


def _measures(keys, emp="employees", absences="absences", leavers="leavers", training="training", recruitment="recruitment"):
    by, on = ", ".join(keys), " AND ".join(f"g.{k} IS NOT DISTINCT FROM {{0}}.{k}" for k in keys) or "TRUE"
    sel, grp = (by + ", ", f"GROUP BY {by}") if keys else ("", "")
    spine = (
        f"(SELECT DISTINCT {by} FROM e UNION SELECT {by} FROM a UNION SELECT {by} FROM l UNION SELECT {by} FROM t UNION SELECT {by} FROM r)"
        if keys
        else "(SELECT 1 AS one)"
    )
    kept = "".join(f"g.{k}, " for k in keys)
    due = f"absence_type IN {SICK} AND days_absent >= 3"
    mean_gap, rate = "((f / nf) - (m / nm))", pct("COALESCE(sd, 0)", "COALESCE(act, 0) * 230")
    mean_gap = "(((m / nm) - (f / nf)) / (m / nm) * 100)"
    rate = pct("sd", "COALESCE(act, 0) * 230")
    comp = pct("COALESCE(cov, 0)", "COALESCE(act, 0)")
    return f"""
WITH ee AS ({emp if emp.startswith(" SELECT") else f"SELECT * FROM {emp}"}),
a0 AS (SELECT x.*, {", ".join(f"ee.{k}" for k in keys) + ", " if keys else ""} 1 AS one FROM {absences} x LEFT JOIN ee ON ee.employee_id = x.employee_id),
l0 AS (SELECT x.employee_id, {", ".join(f"ee.{k}" for k in keys) + ", " if keys else ""} 1 AS one FROM {leavers} x LEFT JOIN ee ON ee.employee_id = x.employee_id),
t0 AS (SELECT x.*, {", ".join(f"ee.{k}" for k in keys) + ", " if keys else ""} 1 AS one FROM {training} x LEFT JOIN ee ON ee.employee_id = x.employee_id),
r0 AS (SELECT x.outcome, x.time_to_fill_days, x.is_academic AS role, {", ".join(f"ee.{k}" for k in keys) + ", " if keys else ""} 1 AS one
       FROM {recruitment} x LEFT JOIN ee ON ee.employee_id = x.hired_employee_id),
e AS (SELECT {sel} COUNT(*) AS hc, COUNT(*) FILTER (WHERE {ACTIVE}) AS act, COUNT(*) FILTER (WHERE {ACTIVE} AND {F}) AS wom,
    COUNT(*) FILTER (WHERE {ACTIVE} AND {M}) AS mal, CAST(SUM(salary) FILTER (WHERE {ACTIVE} AND {F}) AS DOUBLE) AS f,
    NULLIF(COUNT(*) FILTER (WHERE {ACTIVE} AND {F}), 0) AS nf, CAST(SUM(salary) FILTER (WHERE {ACTIVE} AND {M}) AS DOUBLE) AS m,
    NULLIF(COUNT(*) FILTER (WHERE {ACTIVE} AND {M}), 0) AS nm, {median_cents("salary", f"{ACTIVE} AND {F}")} / 100 AS mf,
    {median_cents("salary", f"{ACTIVE} AND {M}")} / 100 AS mm FROM ee {grp}),
a AS (SELECT {sel} CAST(SUM(days_absent) FILTER (WHERE absence_type IN {SICK}) AS BIGINT) AS sd, COUNT(*) FILTER (WHERE {due}) AS due,
    COUNT(*) FILTER (WHERE {due} AND return_to_work_interview) AS held FROM a0 {grp}),
b AS (SELECT {sel} CAST(SUM(score) AS DOUBLE) / COUNT(score) AS avg_score
      FROM (SELECT {sel} employee_id, CAST(COUNT(*) AS HUGEINT) * COUNT(*) * SUM(days_absent) AS score FROM a0 GROUP BY {sel} employee_id) q {grp}),
l AS (SELECT {sel} COUNT(*) AS gone FROM l0 {grp}),
t AS (SELECT {sel} COUNT(*) AS rec, COUNT(*) FILTER (WHERE passed) AS pas, CAST(SUM(cost_eur) AS DOUBLE) AS spend,
    COUNT(DISTINCT employee_id) FILTER (WHERE mandatory AND passed) AS cov FROM t0 {grp}),
r AS (SELECT {sel} COUNT(*) AS opn, COUNT(*) FILTER (WHERE outcome = 'Filled') AS fil, COUNT(*) FILTER (WHERE outcome = 'Ongoing') AS vac,
    AVG(time_to_fill_days) FILTER (WHERE outcome = 'Filled') AS ttf,
    AVG(time_to_fill_days) FILTER (WHERE outcome = 'Filled' AND role) AS ttfa,
    AVG(time_to_fill_days) FILTER (WHERE outcome = 'Filled' AND NOT role) AS ttfs FROM r0 {grp})
SELECT {kept} COALESCE(hc, 0) AS total_headcount, COALESCE(act, 0) AS active_headcount, COALESCE(wom, 0) AS female_headcount,
  COALESCE(mal, 0) AS male_headcount, CAST(COALESCE(wom, 0) AS DOUBLE) / NULLIF(COALESCE(act, 0), 0) AS pct_female,
  COALESCE(gone, 0) AS leavers_count, {pct("2 * COALESCE(gone, 0)", "COALESCE(act, 0) + COALESCE(gone, 0)")} AS turnover_rate_pct,
  sd AS total_sick_days, {rate} AS absence_rate_pct, avg_score AS bradford_factor_avg, {pct("held", "due")} AS rtw_compliance_pct,
  f / nf AS mean_salary_female, m / nm AS mean_salary_male, {mean_gap} AS mean_gpg_pct,
  mf AS median_salary_female, mm AS median_salary_male, (mm - mf) / mm * 100 AS median_gpg_pct,
  ttf AS avg_time_to_fill, ttfa AS avg_time_to_fill_academic, ttfs AS avg_time_to_fill_support, vac AS open_vacancies,
  {pct("fil", "opn")} AS fill_rate_pct, {pct("pas", "rec")} AS training_completion_pct, {comp} AS mandatory_compliance_pct,
  spend AS training_spend_total, spend / NULLIF(COALESCE(act, 0), 0) AS training_spend_per_head,
  CASE WHEN {comp} >= 95 THEN 'Green' WHEN {comp} >= 80 THEN 'Amber' ELSE 'Red' END AS training_rag,
  CASE WHEN {rate} < 3 THEN 'Green' WHEN {rate} < 4.5 THEN 'Amber' ELSE 'Red' END AS absence_rag,
  CASE WHEN {rate} < 3 THEN 'Green' WHEN {rate} <= 4.5 THEN 'Amber' WHEN {rate} > 4.5 THEN 'Red' END AS absence_rag_rule,
  CASE WHEN {mean_gap} < 10 THEN 'Green' WHEN {mean_gap} <= 16 THEN 'Amber' WHEN {mean_gap} > 16 THEN 'Red' END AS pay_gap_rag
FROM {spine} g LEFT JOIN e ON {on.format("e")} LEFT JOIN a ON {on.format("a")} LEFT JOIN b ON {on.format("b")}
LEFT JOIN l ON {on.format("l")} LEFT JOIN t ON {on.format("t")} LEFT JOIN r ON {on.format("r")}"""


O["M_measures_total"] = _measures([])
O["M_measures_by_department"] = _measures(["department"])
O["M_measures_by_grade_and_role"] = _measures(["grade", "is_academic"])
_KEPT = " employee_id IN (SELECT employee_id FROM ee)"
O["P12_measures_sliced"] = _measures(
    ["campus", "gender"],
    " SELECT * FROM employees WHERE EXTRACT(YEAR FROM hire_date) = 1995 AND employment_type <> 'Part-Time' AND gender <> 'Male'"
    " AND department IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')",
    f"(SELECT * FROM absences WHERE absence_type = 'Certified Sick Leave' AND {_KEPT})",
    f"(SELECT * FROM leavers WHERE {_KEPT})",
    f"(SELECT * FROM training WHERE provider = 'External' AND {_KEPT})",
    f"(SELECT * FROM recruitment WHERE hired_{_KEPT.strip()})",
)

O["G1_sick_trend"] = f"""
SELECT strftime(m.month_start, '%Y-%m') AS year_month, y.absence_type, COUNT(a.absence_id) AS instances,
  CAST(COALESCE(SUM(a.days_absent), 0) AS BIGINT) AS total_days
FROM {SPINE} m CROSS JOIN (SELECT unnest(['Certified Sick Leave', 'Uncertified Sick Leave']) AS absence_type) y
LEFT JOIN absences a ON a.absence_type = y.absence_type AND date_trunc('month', a.start_date) = m.month_start GROUP BY 1, 2"""
O["G2_types_by_department"] = """
SELECT e.department, a.absence_type, COUNT(*) AS instances, CAST(SUM(a.days_absent) AS BIGINT) AS total_days
FROM absences a JOIN employees e ON e.employee_id = a.employee_id GROUP BY 1, 2"""
O["G4_mean_time_to_fill"] = f"SELECT department, {avg('time_to_fill_days', 1)} AS avg_days_to_fill FROM recruitment WHERE {_FILLED} GROUP BY 1"
O["G5_provider_split"] = f"""
SELECT provider, COUNT(*) AS records, {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 1, even)} AS pct FROM training GROUP BY 1"""
O["G5_completions_by_category"] = f"""
SELECT category, COUNT(*) AS completions, {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 1, even)} AS pct FROM training WHERE passed GROUP BY 1"""
O["G7_grade_pay_ranges"] = f"""
SELECT grade, CAST(MIN(salary) AS DOUBLE) AS min_salary, CAST(MAX(salary) AS DOUBLE) AS max_salary, {BAND} AS benchmark_salary_band
FROM employees GROUP BY grade"""
O["G9_gender_mix"] = f"""
SELECT grade, gender, COUNT(*) AS headcount, {pct("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY grade)", 1)} AS pct_of_group
FROM employees WHERE {ACTIVE} GROUP BY grade, gender"""
O["G10_funnel"] = """
SELECT source, 'Openings' AS stage, COUNT(*) AS roles FROM recruitment GROUP BY 1
UNION ALL SELECT source, 'Applications', NULL FROM recruitment GROUP BY 1
UNION ALL SELECT source, 'Filled', COUNT(*) FILTER (WHERE outcome = 'Filled') FROM recruitment GROUP BY 1"""
_COVERED = pct("COUNT(DISTINCT t.employee_id) FILTER (WHERE t.mandatory AND t.passed)", "MAX(h.a)", 1)
O["G11_department_status"] = f"""
SELECT e.department, {pct("COUNT(*) FILTER (WHERE t.passed)", "COUNT(t.employee_id)", 1)} AS completion_pct,
  {_COVERED} AS mandatory_compliance_pct,
  CASE WHEN {_COVERED} >= 95 THEN 'Green' WHEN {_COVERED} >= 80 THEN 'Amber' ELSE 'Red' END AS rag
FROM employees e JOIN {_ACTIVE_D} h ON h.department = e.department LEFT JOIN training t ON t.employee_id = e.employee_id GROUP BY 1"""

_KNOWN = "(SELECT employee_id FROM employees)"
_AGE = "CAST(date_diff('day', date_of_birth, hire_date) AS DOUBLE) / 365.25::DOUBLE"
_BAD_PAY, _BAD_AGE = "(salary < 25000 OR salary > 135000)", f"({_AGE} < 18 OR {_AGE} > 70)"
_BAD_MGR = f"(manager_id IS NOT NULL AND manager_id NOT IN {_KNOWN})"


def _flag(cond, token):
    return f"CASE WHEN {cond} THEN '{token};' ELSE '' END"


def _domain(x, words):
    cases = " ".join(f"WHEN '{w.lower()}' THEN '{w}'" for w in words)
    return f"CASE lower(trim({x})) {cases} ELSE trim({x}) END"


_CLEAN_TEXT = {
    "gender": _domain("gender", ["Female", "Male", "Non-Binary", "Unknown"]),
    "employment_type": _domain("employment_type", ["Permanent", "Fixed-Term", "Part-Time"]),
    "status": _domain("status", ["Active", "Resigned", "Retired", "End of Contract"]),
    "department": "trim(department)",
    "campus": _domain("campus", ["Main Campus", "Remote"]),
}
O["D_clean_employees"] = f"""
SELECT employee_id, first_name, last_name, {_CLEAN_TEXT["gender"]} AS gender, date_of_birth, nationality, hire_date,
  {_CLEAN_TEXT["department"]} AS department, job_title, {_CLEAN_TEXT["employment_type"]} AS employment_type, grade, salary,
  CASE WHEN {_BAD_MGR} THEN NULL ELSE manager_id END AS manager_id, {_CLEAN_TEXT["campus"]} AS campus, {_CLEAN_TEXT["status"]} AS status,
  is_academic, {_AGE} AS age_at_hire,
  {_flag(_BAD_PAY, "salary_out_of_range")} || {_flag(_BAD_AGE, "age_at_hire_invalid")} || {_flag(_BAD_MGR, "invalid_manager_id")} AS dq_flag,
  {BAND} AS benchmark_salary_band
FROM employees"""
O["D4_title_case"] = f"""
SELECT employee_id, {", ".join(f"{title(c)} AS {c}" for c in _CLEAN_TEXT)} FROM employees"""
_ORPHAN = f"(employee_id IS NULL OR employee_id NOT IN {_KNOWN})"
_SPAN = "date_diff('day', start_date, end_date)"
O["D_clean_absences"] = f"""
SELECT absence_id, employee_id, absence_type, start_date, end_date, CAST({_SPAN} AS INTEGER) AS days_absent, approved, return_to_work_interview,
  {_flag(_ORPHAN, "invalid_employee_id")} || {_flag("start_date >= end_date", "start_after_end")} AS dq_flag,
  CAST(4.5 AS DECIMAL(4,1)) AS sector_avg_absence_rate_pct
FROM absences"""
_BAD_HIRE = f"(hired_employee_id IS NOT NULL AND hired_employee_id NOT IN {_KNOWN})"
_BAD_DATES = "(date_closed IS NOT NULL AND date_opened >= date_closed)"
O["D_clean_recruitment"] = f"""
SELECT * REPLACE (CASE WHEN {_BAD_HIRE} THEN NULL ELSE hired_employee_id END AS hired_employee_id),
  {_flag(_BAD_HIRE, "invalid_hired_emp_id")} || {_flag(_BAD_DATES, "date_logic_error")} AS dq_flag
FROM recruitment"""
O["D_clean_leavers"] = f"""
SELECT l.*, {_flag("e.employee_id IS NULL", "invalid_employee_id")} || {_flag("l.leaving_date <= e.hire_date", "leaving_before_hire")} AS dq_flag
FROM leavers l LEFT JOIN (SELECT employee_id, MIN(hire_date) AS hire_date FROM employees GROUP BY 1) e ON e.employee_id = l.employee_id"""
O["D_clean_training"] = f"""
SELECT * REPLACE (CASE WHEN provider = 'Internal' THEN CAST(0 AS DECIMAL(10,2)) ELSE cost_eur END AS cost_eur),
  {_flag(_ORPHAN, "invalid_employee_id")} AS dq_flag
FROM training"""

_CHECKS = [
    ("employees", "Salary range check (25k–135k)", "employees", "TRUE", _BAD_PAY),
    ("employees", "Age at hire (18–70)", "employees", "TRUE", _BAD_AGE),
    ("employees", "Manager FK validity", "employees", "TRUE", _BAD_MGR),
    ("absences", "Employee FK validity", "absences", "TRUE", _ORPHAN),
    ("absences", "start_date < end_date", "absences", "TRUE", "start_date >= end_date"),
    ("absences", "days_absent consistency", "absences", "TRUE", f"days_absent IS DISTINCT FROM {_SPAN}"),
    ("recruitment", "Hired employee FK validity", "recruitment", "TRUE", _BAD_HIRE),
    ("recruitment", "date_opened < date_closed", "recruitment", "date_closed IS NOT NULL", _BAD_DATES),
    ("leavers", "Employee FK validity", "leavers", "TRUE", _ORPHAN),
    ("leavers", "leaving_date > hire_date", "leavers LEFT JOIN (SELECT employee_id AS k, hire_date FROM employees) h ON k = employee_id",
     "TRUE", "leaving_date <= hire_date"),
    ("training", "Employee FK validity", "training", "TRUE", _ORPHAN),
    ("training", "Internal training cost = 0", "training", "TRUE", "provider = 'Internal' AND cost_eur > 0"),
]
_COUNTED = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{n}' AS \"check\", COUNT(*) FILTER (WHERE {applies}) AS total_rows, "
    f"COUNT(*) FILTER (WHERE {bad}) AS issues_found FROM {src}"
    for t, n, src, applies, bad in _CHECKS
)
O["D16_report"] = f"""
SELECT *, {even("100 * (GREATEST(total_rows, 1) - issues_found)", "GREATEST(total_rows, 1)", 2)} AS pct_clean,
  'Flagged with dq_flag; FK issues set to NULL' AS resolution
FROM ({_COUNTED}) c"""
O["D17_report_totals"] = f"""
SELECT COUNT(*) AS checks_run, CAST(SUM(issues_found) AS BIGINT) AS issues_found,
  {up("SUM(CAST(round(pct_clean * 100) AS BIGINT))", "100 * COUNT(*)", 1)} AS avg_clean_pct
FROM ({O["D16_report"]}) r"""

_PKS = {"employees": "employee_id", "absences": "absence_id", "recruitment": "job_req_id", "leavers": "employee_id", "training": "training_id"}
O["D18_key_summary"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{k}' AS \"key\", COUNT(*) AS bad_keys, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS \"rows\" "
    f"FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY 1 HAVING COUNT(*) > 1 OR {k} IS NULL) b"
    for t, k in _PKS.items()
)
O["D18_repeated_training_ids"] = "SELECT training_id, COUNT(*) AS \"rows\" FROM training GROUP BY 1 HAVING COUNT(*) > 1"
_FKS = [("employees", "manager_id"), ("absences", "employee_id"), ("recruitment", "hired_employee_id"), ("leavers", "employee_id"), ("training", "employee_id")]
O["D19_orphan_summary"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{k}' AS \"key\", COUNT(DISTINCT {k}) AS orphan_keys, COUNT(*) AS \"rows\" "
    f"FROM {t} c WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM employees p WHERE p.employee_id = c.{k})"
    for t, k in _FKS
)


def _violations(rules):
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{name}' AS rule, COUNT(*) FILTER (WHERE {bad}) AS violations FROM {t}" for t, name, bad in rules
    )


O["D20_D22_check_violations"] = _violations(
    [
        ("data_sources", "source_type domain", "source_type NOT IN ('Real', 'Synthetic')"),
        ("staff_profile", "gender domain", "gender NOT IN ('Female', 'Male', 'Unknown')"),
        ("staff_profile", "headcount >= 0", "NOT headcount >= 0"),
        ("employees", "gender domain", "gender NOT IN ('Female', 'Male', 'Non-Binary', 'Unknown')"),
        ("employees", "employment_type domain", "employment_type NOT IN ('Permanent', 'Fixed-Term', 'Part-Time')"),
        ("employees", "campus domain", "campus NOT IN ('Main Campus', 'Remote')"),
        ("employees", "status domain", "status NOT IN ('Active', 'Resigned', 'Retired', 'End of Contract')"),
        ("employees", "salary > 0", "NOT salary > 0"),
        ("recruitment", "outcome domain", "outcome NOT IN ('Filled', 'Cancelled', 'Ongoing', 'Withdrawn')"),
        ("recruitment", "time_to_fill_days > 0", "NOT time_to_fill_days > 0"),
        ("recruitment", "date_closed > date_opened", "NOT (date_closed IS NULL OR date_closed > date_opened)"),
        ("absences", "days_absent > 0", "NOT days_absent > 0"),
        ("absences", "end_date > start_date", "NOT end_date > start_date"),
        ("training", "duration_hours > 0", "NOT duration_hours > 0"),
        ("training", "cost_eur >= 0", "NOT cost_eur >= 0"),
    ]
)
_REQUIRED = {
    "employees": "employee_id first_name last_name hire_date department job_title employment_type grade salary campus status is_academic",
    "absences": "absence_id employee_id absence_type start_date end_date days_absent approved",
    "recruitment": "job_req_id job_title department is_academic date_opened outcome",
    "leavers": "employee_id leaving_date reason_for_leaving exit_interview_completed rehire_eligible",
    "training": "training_id employee_id course_name category provider completion_date duration_hours passed cost_eur mandatory",
    "staff_profile": "institution year staff_category grade gender headcount",
    "earnings": "year quarter sector",
    "pay_gap": "sector metric",
    "data_sources": "source_name source_type",
}
O["D23_required_values"] = _violations([(t, f"{c} not null", f"{c} IS NULL") for t, cs in _REQUIRED.items() for c in cs.split()])
O["D23_defaults"] = "SELECT absence_id, COALESCE(approved, TRUE) AS approved, '' AS dq_flag FROM absences"
O["D23_defaults_employees"] = "SELECT employee_id, COALESCE(is_academic, FALSE) AS is_academic, '' AS dq_flag FROM employees"
O["D23_defaults_recruitment"] = "SELECT job_req_id, COALESCE(is_academic, FALSE) AS is_academic, '' AS dq_flag FROM recruitment"
O["D23_defaults_leavers"] = """
SELECT employee_id, COALESCE(exit_interview_completed, FALSE) AS exit_interview_completed, COALESCE(rehire_eligible, TRUE) AS rehire_eligible,
  '' AS dq_flag FROM leavers"""
O["D23_defaults_training"] = """
SELECT training_id, COALESCE(passed, TRUE) AS passed, CAST(COALESCE(cost_eur, 0) AS DECIMAL(10,2)) AS cost_eur, COALESCE(mandatory, FALSE) AS mandatory,
  '' AS dq_flag FROM training"""
_LENGTHS = {
    "employees": "employee_id 10 first_name 60 last_name 60 gender 10 nationality 60 department 80 job_title 100 employment_type 20 grade 80 "
    "manager_id 10 campus 40 status 20",
    "absences": "absence_id 10 employee_id 10 absence_type 40",
    "recruitment": "job_req_id 10 job_title 100 department 80 source 60 outcome 20 hired_employee_id 10",
    "leavers": "employee_id 10 reason_for_leaving 60 destination 60",
    "training": "training_id 10 employee_id 10 course_name 120 category 60 provider 60",
}
_LONG = [(t, c, n) for t, words in _LENGTHS.items() for c, n in zip(words.split()[::2], words.split()[1::2], strict=True)]
O["D20_length_violations"] = (
    _violations([(t, f"{c} length <= {n}", f"length({c}) > {n}") for t, c, n in _LONG])
    + " UNION ALL SELECT 'employees', 'benchmark_salary_band length <= 30', 0"
)
O["S11_active_view"] = f"""
SELECT department, gender, COUNT(*) AS heads, MIN(hire_date) AS first_hire,
  MAX(CAST(date_part('year', age({AS_OF}, hire_date)) AS INTEGER)) AS longest
FROM employees WHERE {ACTIVE} GROUP BY department, gender"""
O["S11_absence_view"] = O["V2_absence_rate_by_department"]
O["D24_set_null"] = f"""
SELECT job_req_id, outcome, CASE WHEN hired_employee_id IN (SELECT employee_id FROM employees WHERE {ACTIVE}) THEN hired_employee_id END
  AS hired_employee_id FROM recruitment"""
O["D25_business_rules"] = _violations(
    [
        ("employees", "employee_id format", "NOT regexp_matches(employee_id, '^[0-9]{3}$')"),
        ("employees", "is_academic by department", "is_academic <> (department IN ('BUILDING', 'MACHINERY'))"),
        ("absences", "absence_id format", "NOT regexp_matches(absence_id, '^[0-9]{4}$')"),
        ("absences", "interview only for sick leave of 3 days or more",
         f"return_to_work_interview IS NOT NULL AND NOT (absence_type IN {SICK} AND days_absent >= 3)"),
        ("recruitment", "job_req_id format", "NOT regexp_matches(job_req_id, '^[0-9]{1,4}$')"),
        ("recruitment", "time_to_fill only when filled", "time_to_fill_days IS NOT NULL AND outcome <> 'Filled'"),
        ("recruitment", "no close date while ongoing", "date_closed IS NOT NULL AND outcome = 'Ongoing'"),
        ("leavers", "rehire_eligible unless dismissed", "rehire_eligible = (reason_for_leaving = 'Dismissal')"),
        ("training", "training_id format", "NOT regexp_matches(training_id, '^[0-9]{1,4}-[0-9]$')"),
        ("training", "mandatory by course",
         "mandatory <> (course_name IN ('PROMO Brand#1', 'PROMO Brand#2', 'PROMO Brand#3', 'SMALL Brand#1', 'SMALL Brand#2'))"),
    ]
)
_DAYS = "date_diff('day', e.hire_date, l.leaving_date)"
O["D25_tenure"] = f"""
SELECT 'leavers' AS "table", 'tenure from dates' AS rule,
  COUNT(*) FILTER (WHERE CAST(l.years_of_service AS DOUBLE) <> {even(f"100 * {_DAYS}", "36525", 1)}) AS violations
FROM leavers l JOIN employees e ON e.employee_id = l.employee_id"""

_CELLS = f"""(SELECT grade, gender, COALESCE(s, 0) AS s, COALESCE(r, 0) AS r
  FROM (SELECT grade, gender, COUNT(*) AS s FROM employees WHERE {ACTIVE} GROUP BY 1, 2) a
  FULL JOIN (SELECT grade, gender, SUM(headcount) AS r FROM staff_profile GROUP BY 1, 2) b USING (grade, gender))"""
_PERM = "employment_type = 'Permanent'"
O["D26_calibration"] = f"""
SELECT measure, subject, observed, expected, CAST(tolerance AS DOUBLE) AS tolerance,
  CAST(CAST(observed AS DECIMAL(12,2)) - CAST(expected AS DECIMAL(12,2)) AS DOUBLE) AS diff,
  abs(CAST(observed AS DECIMAL(12,2)) - CAST(expected AS DECIMAL(12,2))) <= tolerance AS ok
FROM (
  SELECT 'female_share_pct' AS measure, grade AS subject, {pct(f"SUM(s) FILTER (WHERE {F})", f"SUM(s) FILTER (WHERE {F} OR {M})", 2)} AS observed,
    {pct(f"SUM(r) FILTER (WHERE {F})", f"SUM(r) FILTER (WHERE {F} OR {M})", 2)} AS expected, 5 AS tolerance
  FROM {_CELLS} c GROUP BY grade
  UNION ALL SELECT 'headcount_pct_of_published', grade || ' / ' || gender, {pct("s", "r", 2)}, 100, 20 FROM {_CELLS} c WHERE r > 0
  UNION ALL SELECT 'permanent_share_pct', 'all', {pct(f"(SELECT COUNT(*) FROM employees WHERE {ACTIVE} AND {_PERM})", _ACTIVE_N, 2)},
    {pct("(SELECT SUM(headcount) FROM staff_profile WHERE contract_type = 'Permanent')", "(SELECT SUM(headcount) FROM staff_profile)", 2)}, 5
) x WHERE observed IS NOT NULL AND expected IS NOT NULL"""

O["P9_mandatory_courses"] = "SELECT DISTINCT course_name FROM training WHERE mandatory = TRUE"
O["S1_employees_by_csv"] = """
SELECT employee_id, hire_date, department, grade, salary, manager_id, campus, status, is_academic FROM employees"""
O["S1_absences_by_csv"] = """
SELECT absence_id, employee_id, absence_type, start_date, days_absent, approved, return_to_work_interview FROM absences"""
O["S2_workforce_summary_by_csv"] = O["B1_workforce_summary"]
O["S7_cleaned_leavers_by_parquet"] = O["D_clean_leavers"]
O["S8_training_by_provider_folder"] = """
SELECT training_id, employee_id, course_name, provider, completion_date, passed FROM training"""
O["S10_row_counts"] = " UNION ALL ".join(
    [f"SELECT '{t}' AS \"table\", COUNT(*) AS \"rows\" FROM {t}" for t in _PKS]
    + [f"SELECT 'workforce_summary', COUNT(*) FROM ({_SUMMARY}) s"]
)


def _with_roles(sql: str) -> str:
    """Put the workforce tables a query names in front of it."""
    used = [f"{name} AS ({body})" for name, body in ROLES.items() if re.search(rf"\b{name}\b", sql)]
    sql = sql.strip()
    if sql.startswith("WITH "):
        return "WITH " + ", ".join(used) + ", " + sql.removeprefix("WITH ")
    return "WITH " + ", ".join(used) + " " + sql


ORACLE = {name: _with_roles(sql) for name, sql in O.items()}
