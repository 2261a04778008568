from conftest import rows
from rollcall.operators.apply import upsert
from rollcall.operators.responses import applied_groups, route_group_responses
from rollcall.plans import groups as grp
from rollcall.plans import jobs


def test_routing_of_every_status(spark):
    req = spark.createDataFrame([
        ("r1", "a@g", "A", "d1", "11", 1, "StudentSection"), ("r2", "b@g", "B", None, "12", 2, "StudentSection"),
        ("r3", "c@g", "C", "d3", "13", 3, "StudentSection"), ("r4", "x@g", "X", "d4", "14", 4, "StudentSection"),
        ("r5", "p@g", "P", "d5", "15", 5, "StudentSection")],
        "request_id string, email string, name string, description string, unique_attribute string,"
        " department_id int, group_type string")
    resp = spark.createDataFrame([
        ("r1", 200, ("id1", None, None, "e1")), ("r2", 409, None), ("r3", 409, None), ("r4", 500, None)],
        "request_id string, status int, body struct<id: string, email: string, name: string, etag: string>")
    groups = spark.createDataFrame([("gB", "b@g", None, "stored", "eB", "99", None, "StudentSection")],
                                   "google_groupid string, group_email string, group_name string,"
                                   " description string, etag string, unique_attribute string,"
                                   " department_id int, group_type string")
    out = route_group_responses(req, resp, groups)
    assert rows(out, "request_id", "outcome", "google_groupid", "group_email", "group_name") == [
        ("r1", "created", "id1", "a@g", "A"),          # response lacks name/email → request's (N7)
        ("r2", "exists", "gB", "b@g", "B"),            # 409 adopts the stored group (R14)
        ("r3", "unresolved", None, None, None),
        ("r4", "rejected", None, None, None),
        ("r5", "pending", None, None, None)]
    assert rows(applied_groups(out), "google_groupid", "description") == [("gB", "stored"), ("id1", "d1")]
    assert rows(applied_groups(out), "google_groupid", "unique_attribute", "department_id", "group_type") == [
        ("gB", "99", 2, "StudentSection"),             # keeps its own key, takes what it lacks
        ("id1", "11", 1, "StudentSection")]


def test_created_groups_are_not_missing_again(spark):
    sections = spark.createDataFrame(
        [(7, 1, "s7@g", "S7", "d"), (8, 2, "s8@g", "S8", "d")],
        "section_id long, school_id int, group_email string, group_name string, group_description string")
    store = spark.createDataFrame([], "google_groupid string, group_email string, group_name string, description string,"
                                      " etag string, unique_attribute string, department_id int, group_type string")
    requests = jobs.section_group_requests(sections, store)
    landed = requests.selectExpr("request_id", "200 AS status", "named_struct('id', concat('g-', email), 'email', email,"
                                 " 'name', name, 'etag', 'e') AS body")
    after = upsert(store, applied_groups(route_group_responses(requests, landed, store)), ["google_groupid"])
    assert after.count() == 2
    assert grp.section_groups_missing(sections, after).count() == 0
