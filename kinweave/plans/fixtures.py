"""Entities derived from the star-schema tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = """
SELECT c_custkey AS k, p_name AS nm, lower(c_mktsegment) AS seg, r_name AS region,
  CASE WHEN n_regionkey IN (0, 2) THEN 'US' WHEN n_regionkey IN (1, 4) THEN 'India' ELSE 'France' END AS country,
  CAST((c_custkey * 37) % 97 + 1 AS VARCHAR(10)) AS house, substr(p_name, 1, instr(p_name, ' ') - 1) AS stw,
  CASE c_custkey % 4 WHEN 0 THEN ' Pvt Ltd' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Inc.' ELSE '' END AS legal
FROM {customer} JOIN {part} ON p_partkey = c_custkey JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey
"""
TABLES = {
    "er_base": BASE,
    "er_s1": "SELECT 'S1-' || CAST(k AS VARCHAR(20)) AS entity_id, nm || ' ' || seg || legal AS business_name, house || ' ' || stw || ' St, ' || seg || 'ville, ' || region AS business_address, country FROM {er_base}",
    "er_s2": """SELECT 'S2-' || CAST(k AS VARCHAR(20)) AS entity_id,
  CASE k % 5 WHEN 0 THEN upper(nm || ' ' || seg || legal) WHEN 1 THEN 'The ' || nm || ' ' || seg || legal WHEN 2 THEN 'zetahalo dba ' || nm || ' ' || seg || legal
    WHEN 3 THEN replace(nm, 'o', '0') || ' ' || seg || legal ELSE 'www.' || replace(nm, ' ', '') || seg || '.com' END AS business_name,
  CASE k % 3 WHEN 0 THEN house || ' ' || stw || ' Street, ' || seg || 'ville, ' || region WHEN 1 THEN region || ', ' || seg || 'ville, ' || house || ' ' || stw || ' St' ELSE '' END AS business_address,
  CASE WHEN k % 50 = 7 THEN 'Atlantis' ELSE country END AS country FROM {er_base} WHERE k % 18 <> 0""",
    "er_s3": """SELECT 'S3-' || CAST(k AS VARCHAR(20)) AS entity_id, substr(nm, 1, length(nm) - 1) || ' ' || seg || CASE WHEN k % 4 = 0 THEN ' Prfivete Limited' ELSE legal END AS business_name,
  CASE WHEN k % 11 = 0 THEN '4' ELSE '' END || house || ' ' || stw || ' Street, Unit ' || CAST(k % 9 + 1 AS VARCHAR(5)) || ', ' || seg || 'ville, ' || region AS business_address, country
FROM {er_base} WHERE k % 18 <> 0 AND k % 3 <> 1
UNION ALL SELECT 'S3-9000' || CAST(k AS VARCHAR(20)), nm || ' ' || seg || legal, CAST(k % 89 + 200 AS VARCHAR(10)) || ' ' || stw || ' Ave, ' || seg || 'ville, ' || region, country FROM {er_base} WHERE k % 6 = 0""",
    "er_truth": """SELECT 'S1-' || CAST(k AS VARCHAR(20)) AS s1_id, 'S2-' || CAST(k AS VARCHAR(20)) AS x_id FROM {er_base} WHERE k % 18 <> 0
UNION ALL SELECT 'S1-' || CAST(k AS VARCHAR(20)), 'S3-' || CAST(k AS VARCHAR(20)) FROM {er_base} WHERE k % 18 <> 0 AND k % 3 <> 1""",
}
# Records as a normalizer leaves them, by formula, so that later operators can be held against SQL on their own.
_NORMAL = """SELECT {id} AS entity_id, {src} AS src, {country} AS country, {name} AS name_clean, {name} AS name_core, {name} AS name_key, {alt} AS name_alt,
  {legal} AS legal, 0 AS name_translit, 0 AS name_is_domain, {house} || ' ' || stw || ' street ' || seg || 'ville' AS addr_clean, {house} AS house_num, {house} AS all_nums,
  stw || ' street' AS street, '' AS locality, {city} AS city, lower(region) AS state, '' AS postcode, {unit} AS unit, '' AS landmark, 0 AS addr_missing, 0 AS addr_translit FROM {{er_base}} {where}"""
_TAG = "CASE k % 4 WHEN 0 THEN 'ltd pvt' WHEN 1 THEN 'llc' WHEN 2 THEN 'inc' ELSE '' END"
TABLES["er_n1"] = _NORMAL.format(id="'S1-' || CAST(k AS VARCHAR(20))", src="1", country="country", name="lower(nm) || ' ' || seg", alt="''", legal=_TAG, house="house", city="seg || 'ville'", unit="''", where="")
TABLES["er_nx"] = " UNION ALL ".join([
    _NORMAL.format(id="'S2-' || CAST(k AS VARCHAR(20))", src="2", country="CASE WHEN k % 50 = 7 THEN 'Atlantis' ELSE country END", name="lower(nm) || CASE WHEN k % 5 = 4 THEN '' ELSE ' ' || seg END", alt="CASE WHEN k % 5 = 2 THEN 'zetahalo' ELSE '' END", legal=_TAG, house="CASE WHEN k % 3 = 2 THEN '' ELSE house END", city="CASE WHEN k % 3 = 2 THEN '' ELSE seg || 'ville' END", unit="''", where="WHERE k % 18 <> 0"),
    _NORMAL.format(id="'S3-' || CAST(k AS VARCHAR(20))", src="3", country="country", name="lower(substr(nm, 1, length(nm) - 1)) || ' ' || seg", alt="''", legal=_TAG, house="CASE WHEN k % 11 = 0 THEN '4' ELSE '' END || house", city="seg || 'ville'", unit="CAST(k % 9 + 1 AS VARCHAR(5))", where="WHERE k % 18 <> 0 AND k % 3 <> 1"),
])
# Pairs with a probability by formula: neighbours by key of an entity's true records.
TABLES["er_scored"] = """SELECT 'S1-' || CAST(b.k AS VARCHAR(20)) AS s1_id, 'S' || CAST(s.src AS VARCHAR(2)) || '-' || CAST(b.k + d.d AS VARCHAR(20)) AS x_id, s.src AS src,
  CAST((((b.k + d.d * 13) * 7919 + s.src * 104729 + d.d * 31) % 1000) AS DOUBLE) / 1000.0 AS p,
  CAST((((b.k + d.d * 7) * 611953 + s.src * 15485863) % 100000) AS DOUBLE) / 1000.0 AS score,
  CASE WHEN d.d = 0 AND b.k % 18 <> 0 AND (s.src = 2 OR b.k % 3 <> 1) THEN 1 ELSE 0 END AS y
FROM {er_base} b CROSS JOIN (SELECT 2 AS src UNION ALL SELECT 3 AS src) s CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1 AS d UNION ALL SELECT 2 AS d UNION ALL SELECT 5 AS d) d
WHERE b.k % 7 <> 6"""


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or one of the driver's."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = TABLES[name]
    needed = {n: frame(spark, sf_dir, n) for n in [*TABLES, "customer", "part", "nation", "region"] if "{" + n + "}" in sql}
    return spark.sql(sql, **needed)


def duck(sql: str) -> str:
    """``sql`` on derived tables as one DuckDB statement."""
    plain = {n: s for n, s in TABLES.items()}
    names = {n: n for n in [*TABLES, "customer", "part", "nation", "region"]}
    return "WITH " + ", ".join(f"{n} AS ({s.format(**names)})" for n, s in plain.items()) + " " + sql
