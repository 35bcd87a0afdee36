"""HR queries on a handful of rows."""

from datetime import date, datetime

import pytest

from assay.operators import hr_queries as hr
from tests.conftest import executed, rows


@pytest.fixture(scope="module")
def per(spark):
    return spark.createDataFrame(
        [
            (1, 1, "Ann", "A", 10, "j1", None, 100.0, 0.5, date(2024, 1, 1)),
            (2, 2, "Bob", "B", 10, "j2", 1, 300.0, None, date(2022, 12, 31)),
            (3, 3, "Cyd", None, None, "j1", 1, None, 0.1, date(2023, 1, 1)),
            (4, 4, "Dee", "D", 99, "j9", 3, 50.0, 0.0, None),
        ],
        "id long, employee_id long, first_name string, last_name string, department_id int, job_id string, "
        "manager_id long, salary double, commission_pct double, hire_date date",
    )


@pytest.fixture(scope="module")
def dept(spark):
    return spark.createDataFrame([(10, "Sales", 1), (20, "Empty", 2)], "department_id int, department_name string, location_id int")


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame([("j1", "One"), ("j2", "Two")], "job_id string, job_title string")


@pytest.fixture(scope="module")
def job_history(spark):
    return spark.createDataFrame(
        [
            (1, 1, "j2", datetime(2024, 1, 1), datetime(2024, 1, 2, 12)),
            (2, 3, "j1", datetime(2024, 1, 1), datetime(2024, 1, 1)),
            (3, 9, "j1", datetime(2024, 1, 1), datetime(2024, 1, 9)),
        ],
        "id long, employee_id long, job_id string, start_date timestamp_ntz, end_date timestamp_ntz",
    )


def test_joins(spark, per, dept, jobs):
    assert rows(hr.employees_dept_job(per, dept, jobs)) == [("Ann", "A", "Sales", "One"), ("Bob", "B", "Sales", "Two")]
    locations = spark.createDataFrame([(1, "C", "S", 44)], "location_id int, city string, state_province string, country_id int")
    assert rows(hr.dept_locations(dept, locations)) == [("Sales", "C", "S", 44)]


def test_statistics(per, dept, jobs):
    assert rows(hr.dept_salary_stats(per, dept)) == [("Sales", 2, 200.0, 100.0, 300.0)]
    assert rows(hr.job_salary_stats(per, jobs)) == [("One", 2, 100.0, 100.0, 100.0), ("Two", 1, 300.0, 300.0, 300.0)]
    assert rows(hr.large_departments(per, dept, 1)) == [("Sales", 2)]
    assert rows(hr.large_departments(per, dept)) == []


def test_managers(per):
    assert rows(hr.employee_manager(per)) == [
        (None, "Ann A"), ("Ann A", None), ("Bob B", "Ann A"), ("Dee D", None),
    ]


def test_history(per, jobs, job_history):
    assert rows(hr.job_changes(per, job_history, jobs).select("first_name", "old_job", "current_job")) == [
        ("Ann", "Two", "One"),
        ("Cyd", "One", "One"),
    ]
    assert [tuple(r) for r in hr.days_in_role(per, job_history).select("first_name", "days_in_role").collect()] == [
        ("Ann", 1.5),
        ("Cyd", 0.0),
    ]


def test_hires_and_compensation(per):
    assert [r["first_name"] for r in hr.recent_hires(per, date(2024, 1, 1)).collect()] == ["Ann", "Cyd"]
    got = [(r["first_name"], r["total_compensation"]) for r in hr.total_compensation(per).collect()]
    assert got == [("Ann", 150.0), ("Dee", 50.0), ("Cyd", None)]


def test_small_reference_tables_are_broadcast(spark, sf):
    from suite import views as v

    plan = executed(
        hr.employees_dept_job(v.view(spark, sf, v.PER), v.view(spark, sf, v.DEPT), v.view(spark, sf, v.JOBS))
    )
    assert "BroadcastHashJoin" in plan
