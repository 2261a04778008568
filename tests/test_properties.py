"""End-to-end properties on the driver tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from rollcall.plans import accounts as acc
from rollcall.plans import extras
from rollcall.testbed import Testbed

SF = "/root/testdata/sf0.001"


def test_applying_the_patch_leaves_nothing_to_patch(spark):
    q = E.queries()
    applied = q["apply_update"](spark, SF)
    tb = Testbed(spark, SF)
    desired = (acc.desired_staff(tb.staff_stage, tb.accounts, tb.cfg)
               .unionByName(acc.desired_students(tb.students_stage, tb.accounts, tb.orgunit, tb.cfg)))
    # ids whose desired rows disagree among themselves (tied enrolments) may keep one diff
    conflicted = desired.groupBy("id").agg(F.count_distinct(F.struct(*acc.ACCOUNT_FIELDS)).alias("n")) \
        .filter("n > 1").select("id")
    rest = acc.account_patch(desired, applied).join(conflicted, "id", "left_anti")
    assert rest.count() == 0


def test_missing_and_stale_members_are_disjoint(spark):
    q = E.queries()
    new = q["section_members_missing"](spark, SF).select("google_groupid", F.col("google_id").alias("u"))
    old = q["stale_members"](spark, SF).select("google_groupid", F.col("google_userid").alias("u"))
    assert new.intersect(old).count() == 0


def test_account_query_key_allow_list(spark):
    tb = Testbed(spark, SF)
    keys = tb.accounts.limit(3).select("external_uid")
    assert extras.account_query(tb.accounts, "external_uid", keys).count() >= 3
    assert extras.account_query(tb.accounts, "id", user_type="staff", sample=(5, 1)).count() == 5
    with pytest.raises(ValueError):
        extras.account_query(tb.accounts, "given_name; DROP")
