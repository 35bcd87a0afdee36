"""The HR sample queries as DataFrame plans.

Joins to small reference tables carry no hint: Spark broadcasts such a side only if its
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, with
AQE splitting skewed partitions. Joins between fact tables are salted. Aggregates by
department or job collapse the employees on the key before the join.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.plans.skew import salted_join


def employees_dept_job(per: DataFrame, dept: DataFrame, jobs: DataFrame) -> DataFrame:
    """Employees with department and job title."""
    return (
        per.select("first_name", "last_name", "department_id", "job_id")
        .join(dept.select("department_id", "department_name"), "department_id")
        .join(jobs, "job_id")
        .select("first_name", "last_name", "department_name", "job_title")
    )


def _salary_stats(per: DataFrame, reference: DataFrame, key: str, name: str) -> DataFrame:
    """Head count and salary measures per ``name``, pre-aggregated per ``key`` before the join."""
    per_key = (
        per.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("heads"),
            F.count("salary").alias("paid"),
            F.sum("salary").alias("total"),
            F.min("salary").alias("low"),
            F.max("salary").alias("high"),
        )
    )
    return (
        per_key.join(reference.select(key, name), key)
        .groupBy(name)
        .agg(
            F.sum("heads").alias("employee_count"),
            F.round(F.try_divide(F.sum("total"), F.sum("paid")), 2).alias("avg_salary"),
            F.min("low").alias("min_salary"),
            F.max("high").alias("max_salary"),
        )
    )


def dept_salary_stats(per: DataFrame, dept: DataFrame) -> DataFrame:
    return _salary_stats(per, dept, "department_id", "department_name")


def job_salary_stats(per: DataFrame, jobs: DataFrame) -> DataFrame:
    return _salary_stats(per, jobs, "job_id", "job_title")


def job_changes(per: DataFrame, job_history: DataFrame, jobs: DataFrame) -> DataFrame:
    """Old and current job title for every entry of the job history."""
    old = jobs.select(F.col("job_id").alias("old_id"), F.col("job_title").alias("old_job"))
    current = jobs.select(F.col("job_id").alias("current_id"), F.col("job_title").alias("current_job"))
    past = job_history.select("id", "employee_id", F.col("job_id").alias("old_id"), "start_date", "end_date")
    people = per.select("employee_id", "first_name", "last_name", F.col("job_id").alias("current_id"))
    return (
        salted_join(past, people, ["employee_id"], ["id"])
        .join(old, "old_id")
        .join(current, "current_id")
        .select("first_name", "last_name", "old_job", "current_job", "start_date", "end_date")
    )


def _full_name() -> Column:
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))


def employee_manager(per: DataFrame) -> DataFrame:
    """Every employee with the manager's name, null if there is none."""
    staff = per.select("id", "manager_id", _full_name().alias("employee_name"))
    managers = per.select(F.col("id").alias("manager_id"), _full_name().alias("manager_name"))
    return salted_join(staff, managers, ["manager_id"], ["id"], "left").select("employee_name", "manager_name")


def dept_locations(dept: DataFrame, locations: DataFrame) -> DataFrame:
    return dept.join(locations, "location_id").select("department_name", "city", "state_province", "country_id")


def recent_hires(per: DataFrame, as_of: date) -> DataFrame:
    """Hired in the year before ``as_of`` or later, newest first."""
    since = F.add_months(F.lit(as_of), -12)
    return (
        per.where(F.col("hire_date") >= since)
        .select("first_name", "last_name", "hire_date")
        .orderBy(F.desc("hire_date"))
    )


def large_departments(per: DataFrame, dept: DataFrame, more_than: int = 5) -> DataFrame:
    """Departments with more than ``more_than`` employees."""
    heads = per.where("department_id IS NOT NULL").groupBy("department_id").agg(F.count(F.lit(1)).alias("heads"))
    return (
        heads.join(dept.select("department_id", "department_name"), "department_id")
        .groupBy("department_name")
        .agg(F.sum("heads").alias("employee_count"))
        .where(F.col("employee_count") > more_than)
    )


def total_compensation(per: DataFrame, decimals: int = 2) -> DataFrame:
    """Employees with a commission, highest total first."""
    total = F.round(F.col("salary") * (1 + F.col("commission_pct")), decimals)
    return (
        per.where("commission_pct IS NOT NULL")
        .select("first_name", "last_name", "salary", "commission_pct", total.alias("total_compensation"))
        .orderBy(F.desc("total_compensation"))
    )


def days_in_role(per: DataFrame, job_history: DataFrame) -> DataFrame:
    """Length of every job history entry in (fractional) days, longest first."""
    span = F.timestamp_diff(
        "MICROSECOND", F.col("start_date").cast("timestamp_ntz"), F.col("end_date").cast("timestamp_ntz")
    )
    past = job_history.select("id", "employee_id", "job_id", (span / 86_400e6).alias("days_in_role"))
    people = per.select("employee_id", "first_name", "last_name")
    return (
        salted_join(past, people, ["employee_id"], ["id"])
        .select("first_name", "last_name", "job_id", "days_in_role")
        .orderBy(F.desc("days_in_role"))
    )
