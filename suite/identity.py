"""Identity-fraud detection."""

from pyspark.sql import functions as F

from assay.operators import identity as idn
from suite import case
from suite import views as v
from suite.checks import NINO_OK

PER = v.with_views(per=v.PER)
VALID = NINO_OK.replace("{c}", "nino")
DIGITS = "CASE WHEN regexp_matches(substr(nino, 3, 6), '^[0-9]{6}$') THEN CAST(substr(nino, 3, 6) AS INTEGER) END"


def per(spark, sf):
    return v.view(spark, sf, v.PER)


@case("nino_invalid_format", PER + f"SELECT id, nino FROM per WHERE NOT coalesce({VALID}, false)")
def nino_invalid_format(spark, sf):
    return idn.invalid_ninos(per(spark, sf)).select("id", "nino")


@case(
    "nino_duplicates",
    PER + "SELECT id, nino FROM per WHERE nino IN (SELECT nino FROM per GROUP BY nino HAVING count(*) > 1)",
)
def nino_duplicates(spark, sf):
    return idn.shared_ninos(per(spark, sf).select("id", "nino"))


SEQUENTIAL = f"""SELECT id, nino FROM (SELECT id, nino, {DIGITS} AS n FROM per) a
WHERE n + 1 IN (SELECT {DIGITS} FROM per WHERE {DIGITS} IS NOT NULL)"""


@case("nino_sequential", PER + SEQUENTIAL)
def nino_sequential(spark, sf):
    return idn.sequential_ninos(per(spark, sf).select("id", "nino"))


@case(
    "nino_fraud_flags",
    PER
    + f"""SELECT id, 'invalid_format' AS pattern FROM per WHERE NOT coalesce({VALID}, false)
UNION ALL SELECT id, 'duplicates' FROM per WHERE nino IN (SELECT nino FROM per GROUP BY nino HAVING count(*) > 1)
UNION ALL SELECT id, 'sequential_numbers' FROM ({SEQUENTIAL}) s""",
)
def nino_fraud_flags(spark, sf):
    return idn.nino_fraud_flags(per(spark, sf))


EXTERNAL = """SELECT nino, CASE WHEN phone = 'none' THEN department_id + 1 ELSE department_id END AS department_id
FROM per WHERE age IS NOT NULL AND country IS NOT NULL"""


@case(
    "nino_cross_reference",
    PER[:-1]
    + f""", external AS ({EXTERNAL})
SELECT id, nino, 'unknown' AS finding FROM per
WHERE nino IS NOT NULL AND nino NOT IN (SELECT nino FROM external WHERE nino IS NOT NULL)
UNION ALL
SELECT id, nino, 'mismatch' FROM per p WHERE nino IN (SELECT nino FROM external)
AND NOT EXISTS (SELECT 1 FROM external e WHERE e.nino = p.nino AND e.department_id IS NOT DISTINCT FROM p.department_id)""",
)
def nino_cross_reference(spark, sf):
    people = per(spark, sf)
    external = people.where("age IS NOT NULL AND country IS NOT NULL").selectExpr(
        "nino", "CASE WHEN phone = 'none' THEN department_id + 1 ELSE department_id END AS department_id"
    )
    return idn.cross_reference(people, external, "nino", "department_id")


@case("registration_clusters", PER + "SELECT hire_date, count(*) AS registrations FROM per GROUP BY hire_date")
def registration_clusters(spark, sf):
    return idn.registration_clusters(per(spark, sf), "hire_date")


@case(
    "activity_patterns",
    "SELECT user_id, CAST(ts AS DATE) AS activity_date, count(*) AS activities FROM events GROUP BY 1, 2",
)
def activity_patterns(spark, sf):
    events = v.table(spark, sf, "events").withColumn("activity_date", F.to_date("ts"))
    return idn.activity_patterns(events, "user_id", "activity_date")


@case(
    "geo_clusters",
    "WITH RECURSIVE "
    + PER.removeprefix("WITH ")[:-1]
    + """, near AS (
  SELECT a.id AS src, b.id AS dst FROM per a JOIN per b ON a.id <> b.id
   AND sqrt((a.latitude - b.latitude) * (a.latitude - b.latitude) + (a.longitude - b.longitude) * (a.longitude - b.longitude)) <= 0.3),
reach(id, other) AS (
  SELECT src, dst FROM near UNION SELECT r.id, n.dst FROM reach r JOIN near n ON r.other = n.src)
SELECT p.id, CASE WHEN c.low IS NULL THEN -1 ELSE least(p.id, c.low) END AS cluster FROM per p
LEFT JOIN (SELECT id, min(other) AS low FROM reach GROUP BY id) c ON p.id = c.id""",
)
def geo_clusters(spark, sf):
    return idn.geo_clusters(per(spark, sf), eps=0.3)


@case(
    "density_clusters",
    "WITH RECURSIVE "
    + PER.removeprefix("WITH ")[:-1]
    + """, close AS (
  SELECT a.id AS src, b.id AS dst FROM per a JOIN per b
   ON sqrt((a.latitude - b.latitude) * (a.latitude - b.latitude) + (a.longitude - b.longitude) * (a.longitude - b.longitude)) <= 0.3),
cores AS (SELECT src AS id FROM close GROUP BY src HAVING count(*) >= 5),
near AS (SELECT src, dst FROM close WHERE src IN (SELECT id FROM cores) AND dst IN (SELECT id FROM cores)),
reach(id, other) AS (
  SELECT src, dst FROM near UNION SELECT r.id, n.dst FROM reach r JOIN near n ON r.other = n.src),
named AS (SELECT id, min(other) AS cluster FROM reach GROUP BY id),
edge AS (SELECT c.src AS id, min(n.cluster) AS cluster FROM close c JOIN named n ON c.dst = n.id GROUP BY c.src)
SELECT p.id, coalesce(n.cluster, e.cluster, -1) AS cluster, n.id IS NOT NULL AS core FROM per p
LEFT JOIN named n ON p.id = n.id LEFT JOIN edge e ON p.id = e.id
WHERE p.latitude IS NOT NULL AND p.longitude IS NOT NULL""",
)
def density_clusters(spark, sf):
    return idn.density_clusters(per(spark, sf), eps=0.3, min_samples=5)


@case(
    "relationship_network",
    "WITH RECURSIVE "
    + PER.removeprefix("WITH ")[:-1]
    + """, linked AS (
  SELECT a.id AS src, b.id AS dst FROM per a JOIN per b ON a.id <> b.id AND a.nino = b.nino
  UNION SELECT a.id, b.id FROM per a JOIN per b ON a.id <> b.id AND a.latitude = b.latitude AND a.department_id = b.department_id),
reach(id, other) AS (
  SELECT src, dst FROM linked UNION SELECT r.id, n.dst FROM reach r JOIN linked n ON r.other = n.src)
SELECT id, least(id, min(other)) AS network FROM reach GROUP BY id""",
)
def relationship_network(spark, sf):
    return idn.relationship_network(per(spark, sf), [["nino"], ["latitude", "department_id"]])
