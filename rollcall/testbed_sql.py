"""The testbed views of ``rollcall.testbed`` written as DuckDB SQL.

Used only by the oracle (``__spark_entry__.oracle_sql``): every oracle
statement is ``WITH <views it needs> SELECT …`` over the driver's
pre-registered tables.  Keep each rule identical to its Spark twin.
"""

from __future__ import annotations

import re

from rollcall.testbed import CONFIG, TIMEBLOCK_NAMES

AS_OF = f"DATE '{CONFIG.as_of.isoformat()}'"
YEAR = CONFIG.academic_year

_TB_VALUES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(TIMEBLOCK_NAMES))
_TERM = ("CAST(l_partkey % 25 AS BIGINT) * 100000 + year(l_shipdate) * 10"
         " + CASE WHEN month(l_shipdate) <= 6 THEN 2 ELSE 1 END")
_FIRST = "upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2))"
_STAFF_FIRST = ("CASE s_suppkey % 5 WHEN 0 THEN 'Ana' WHEN 1 THEN 'Ben' WHEN 2 THEN 'Chloé' WHEN 3 THEN 'Dev'"
                " ELSE 'Eli' END")
_STAFF_LAST = ("CASE s_suppkey % 6 WHEN 0 THEN 'Peña-López' WHEN 1 THEN 'O''Neil' WHEN 2 THEN 'Smith'"
               " WHEN 3 THEN 'van der Berg' WHEN 4 THEN 'Zhao' ELSE 'Müller' END")

VIEWS: dict[str, str] = {
    "sis_sites": """SELECT n_nationkey AS site_id, n_name AS site_name,
        CASE n_regionkey WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 8 WHEN 3 THEN 11 ELSE 0 END AS start_grade_level_id,
        n_nationkey % 10 = 9 AS exclude_from_state_reporting FROM nation""",
    "site_labels": """SELECT n_nationkey AS site_id,
        CASE WHEN n_nationkey = 23 THEN NULL ELSE 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS short_name
        FROM nation""",
    "grade_levels": """SELECT CAST(range AS INTEGER) AS grade_level_id,
        CASE WHEN range = 0 THEN 'PRE' WHEN range = 1 THEN 'TK' WHEN range = 2 THEN 'K'
             WHEN range = 15 THEN 'UG' ELSE CAST(range - 2 AS VARCHAR) END AS short_name FROM range(16)""",
    "sis_students": f"""SELECT c_custkey AS student_id, c_custkey + 500000 AS local_student_id,
        {_FIRST} AS first_name, 'Cust' || CAST(c_custkey AS VARCHAR) AS last_name,
        CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Lee' ELSE 'Ann' END AS middle_name,
        CAST(DATE '1990-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS DATE) AS birth_date,
        CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' END AS gender,
        CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'web' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email
        FROM customer""",
    "enrol": """SELECT o_orderkey AS enrol_id, o_custkey AS student_id,
        (o_custkey % 25) * 10000 + year(o_orderdate) AS session_id,
        CAST((o_custkey + year(o_orderdate)) % 16 AS INTEGER) AS grade_level_id,
        o_orderstatus <> 'P' AS is_primary,
        CAST(o_orderdate AS DATE) AS entry_date,
        CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS DATE) AS leave_date
        FROM orders""",
    "section_term": f"""SELECT DISTINCT l_partkey AS section_id, {_TERM} AS term_id FROM lineitem""",
    "terms": """SELECT term_id,
        (term_id // 100000) * 10000 + (term_id % 100000) // 10 AS session_id,
        CASE WHEN term_id % 10 = 1 THEN 'S1 ' ELSE 'S2 ' END || CAST((term_id % 100000) // 10 AS VARCHAR) AS term_name,
        CASE WHEN term_id % 10 = 1 THEN make_date(CAST((term_id % 100000) // 10 AS INTEGER), 7, 1)
             ELSE make_date(CAST((term_id % 100000) // 10 AS INTEGER), 1, 1) END AS start_date,
        CASE WHEN term_id % 10 = 1 THEN make_date(CAST((term_id % 100000) // 10 AS INTEGER), 12, 31)
             ELSE make_date(CAST((term_id % 100000) // 10 AS INTEGER), 6, 30) END AS end_date
        FROM (SELECT DISTINCT """ + _TERM + """ AS term_id FROM lineitem)""",
    "sessions": """SELECT session_id, CAST(session_id // 10000 AS INTEGER) AS site_id,
        CAST(session_id % 10000 AS INTEGER) AS academic_year
        FROM (SELECT session_id FROM enrol UNION SELECT session_id FROM terms)""",
    "student_cf": """SELECT c_custkey AS student_id,
        CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 9 = 0 END AS email_suspend,
        CASE WHEN c_custkey % 8 = 0 THEN 'alt.' || CAST(c_custkey AS VARCHAR)
             || CASE WHEN c_custkey % 16 = 0 THEN '' ELSE '@example.org' END END AS override_email
        FROM customer WHERE c_custkey % 50 <> 49""",
    "student_house": """SELECT c_custkey AS student_id, (c_custkey % 25) * 10000 + 2001 AS session_id,
        'House ' || CAST(c_custkey % 4 AS VARCHAR) AS house_name FROM customer WHERE c_custkey % 5 <> 0""",
    "portal_students": "SELECT c_custkey AS student_id FROM customer WHERE c_custkey % 4 = 0",
    "sis_users": f"""SELECT s_suppkey AS user_id,
        CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE 'T' || CAST(s_suppkey AS VARCHAR) END AS local_user_id,
        CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS address,
        CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'SE' || CAST(s_suppkey AS VARCHAR) END AS state_id,
        {_STAFF_FIRST} AS first_name, {_STAFF_LAST} AS last_name,
        CASE WHEN s_suppkey % 2 = 0 THEN 'Quinn' END AS middle_name,
        CASE s_suppkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
        s_suppkey % 10 <> 7 AS active,
        CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN ''
             ELSE 'staff' || CAST(s_suppkey AS VARCHAR) || '@example.org' END AS email1
        FROM supplier""",
    "custom_field_values": """SELECT 'staff' AS table_name, user_id AS row_id, event_type AS field,
        CAST(value AS VARCHAR) AS value, event_id AS seq FROM events""",
    "section_teacher": """SELECT DISTINCT l_partkey AS section_id, l_suppkey AS user_id,
        l_returnflag = 'A' AND l_linenumber = 1 AS primary_teacher FROM lineitem""",
    "section_course": """SELECT p_partkey AS section_id, p_size AS course_id FROM part
        UNION SELECT p_partkey, p_size % 7 + 1 FROM part WHERE p_partkey % 10 = 0""",
    "courses": """SELECT p_size AS course_id, 'C' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS school_course_id,
        'Course ' || CAST(p_size AS VARCHAR) AS short_name FROM (SELECT DISTINCT p_size FROM part)""",
    "section_timeblock": "SELECT p_partkey AS section_id, CAST(p_partkey % 9 AS INTEGER) AS timeblock_id FROM part",
    "timeblocks": f"SELECT * FROM (VALUES {_TB_VALUES}) AS t(timeblock_id, timeblock_name)",
    "section_student": """SELECT l_orderkey * 10 + l_linenumber AS ssa_id, o_custkey AS student_id,
        l_partkey AS section_id,
        least(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS entry_date,
        CASE WHEN l_linestatus = 'O' THEN NULL
             ELSE greatest(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS leave_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "account": f"""SELECT c_custkey * 2 AS id,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'gu' || CAST(c_custkey AS VARCHAR) END AS google_id,
        CASE WHEN c_custkey % 19 = 0 THEN 'Student' ELSE 'student' END AS user_type,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE lower(c_mktsegment) || '.cust' || CAST(c_custkey AS VARCHAR)
             || '@students.example.org' END AS primary_email,
        CASE WHEN c_custkey % 11 = 0 THEN 'Renamed' ELSE {_FIRST} END AS given_name,
        'Cust' || CAST(c_custkey AS VARCHAR) AS family_name,
        c_custkey AS external_uid, c_custkey % 23 = 0 AS suspended,
        false AS change_password, true AS global_addressbook,
        '/Students/' || CAST(c_nationkey AS VARCHAR) || '/' || CAST(c_custkey % 15 - 2 AS VARCHAR) AS ou_path
        FROM customer WHERE c_custkey % 5 <> 0
        UNION ALL
        SELECT s_suppkey * 2 + 1,
        CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'gs' || CAST(s_suppkey AS VARCHAR) END,
        CASE WHEN s_suppkey % 5 = 0 THEN 'Staff' ELSE 'staff' END,
        CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 'staff' || CAST(s_suppkey AS VARCHAR) || '@example.org' END,
        {_STAFF_FIRST}, {_STAFF_LAST}, s_suppkey, s_suppkey % 6 = 0, false, true, '/Staff'
        FROM supplier WHERE s_suppkey % 4 <> 1""",
    "orgunit": """SELECT '/Students/' || CAST(site AS VARCHAR) || '/' || CAST(g - 2 AS VARCHAR) AS ou_path,
        'Grade ' || CAST(g - 2 AS VARCHAR) AS ou_name, site AS department_id, g - 2 AS map_key,
        'student' AS user_type
        FROM (SELECT DISTINCT CAST(session_id // 10000 AS INTEGER) AS site, grade_level_id AS g FROM enrol)
        WHERE g < 15 AND (site + g) % 7 <> 0
        UNION ALL SELECT '/Staff', 'Staff', CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), 'staff'
        FROM region WHERE r_regionkey = 0""",
    "departments": """SELECT g - 2 AS unit, g - 2 AS unique_identifier, CAST(site AS BIGINT) AS sitecode,
        site AS siteid
        FROM (SELECT DISTINCT CAST(session_id // 10000 AS INTEGER) AS site, grade_level_id AS g FROM enrol)
        WHERE g BETWEEN 2 AND 14""",
    "store_sites": """SELECT n_nationkey AS siteid, 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS abbreviation,
        n_name AS description, CASE WHEN n_nationkey % 10 = 9 THEN 1 ELSE 0 END AS auto_exclude,
        CASE n_regionkey WHEN 0 THEN 5 WHEN 1 THEN 8 ELSE 12 END AS upper_unit FROM nation""",
    "groups": """SELECT *, 'et-' || google_groupid AS etag FROM (
        SELECT 'sec-' || CAST(section_id AS VARCHAR) AS google_groupid,
        CASE WHEN section_id % 9 = 0 THEN 'old-' || email WHEN section_id % 9 = 1 THEN upper(email)
             ELSE email END AS group_email,
        'Section ' || CAST(section_id AS VARCHAR) AS group_name, CAST(NULL AS VARCHAR) AS description,
        school_id AS department_id, 'StudentSection' AS group_type,
        CAST(section_id AS VARCHAR) AS unique_attribute
        FROM (SELECT section_id, min(group_email) AS email, min(school_id) AS school_id
              FROM section_groups GROUP BY section_id) WHERE section_id % 4 <> 0
        UNION ALL
        SELECT 'conf-' || CAST(n_nationkey AS VARCHAR), 'staff-' || lower(n_name) || '@groups.example.org',
        n_name || ' staff', NULL, n_nationkey, 'SchoolConference', CAST(2030 - n_nationkey % 13 AS VARCHAR)
        FROM nation WHERE n_nationkey % 6 <> 5
        UNION ALL
        SELECT 'yog-' || CAST(sitecode AS VARCHAR) || '-' || CAST(2030 - unique_identifier AS VARCHAR),
        'old-yog-' || CAST(sitecode AS VARCHAR) || '-' || CAST(2030 - unique_identifier AS VARCHAR)
          || '@groups.example.org',
        'Cohort ' || CAST(2030 - unit AS VARCHAR), NULL, CAST(sitecode AS INTEGER), 'StuSchoolYOG',
        CAST(2030 - unique_identifier AS VARCHAR)
        FROM departments WHERE (sitecode + unit) % 3 = 0
        UNION ALL
        SELECT 'crs-' || CAST(p_partkey AS VARCHAR), 'crs-' || CAST(p_partkey AS VARCHAR) || '@groups.example.org',
        'Course section ' || CAST(p_partkey AS VARCHAR), NULL, CAST(p_partkey % 25 AS INTEGER), 'Courses',
        CAST(p_partkey AS VARCHAR)
        FROM part WHERE p_partkey % 6 = 0)""",
    "group_member": """SELECT google_groupid, google_userid, role, 'USER' AS type FROM (
        SELECT 'sec-' || CAST(l_partkey AS VARCHAR) AS google_groupid, 'gu' || CAST(o_custkey AS VARCHAR) AS google_userid,
          CASE WHEN (l_partkey + o_custkey) % 10 = 0 THEN 'OWNER' ELSE 'MEMBER' END AS role
        FROM (SELECT DISTINCT l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        WHERE (l_partkey + o_custkey) % 3 <> 0
        UNION ALL
        SELECT 'sec-' || CAST(l_partkey AS VARCHAR), 'gs' || CAST(l_suppkey AS VARCHAR), 'OWNER'
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem
              WHERE l_returnflag = 'A' AND (l_partkey + l_suppkey) % 2 = 0)
        UNION ALL
        SELECT 'conf-' || CAST(s_nationkey AS VARCHAR), 'gs' || CAST(s_suppkey AS VARCHAR), 'MEMBER'
        FROM supplier WHERE s_suppkey % 3 <> 0
        UNION ALL
        SELECT 'yog-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(2030 - c_custkey % 13 AS VARCHAR),
          'gu' || CAST(c_custkey AS VARCHAR), 'MEMBER'
        FROM customer WHERE c_custkey % 2 = 0
        UNION ALL
        SELECT 'crs-' || CAST(p_partkey AS VARCHAR), 'gu' || CAST(p_partkey + 1 AS VARCHAR), 'MEMBER' FROM part WHERE p_partkey % 6 = 0)""",
}


def with_views(sql: str, extra: dict[str, str] | None = None, replace: bool = False) -> str:
    """Prefix ``sql`` with the CTEs it (transitively) references, in order.
    ``replace`` uses ``extra`` as the whole set of definitions."""
    defs = {} if replace else dict(VIEWS)
    if extra:
        defs.update(extra)
    ordered: list[str] = []

    def refs(text: str) -> list[str]:
        return [n for n in defs if re.search(rf"\b{n}\b", text)]

    def visit(name: str, stack: tuple = ()):
        if name in ordered or name in stack:
            return
        for dep in refs(defs[name]):
            if dep != name:
                visit(dep, stack + (name,))
        ordered.append(name)

    for n in refs(sql):
        visit(n)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in ordered)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
