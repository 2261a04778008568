"""Declared schemas.  Nothing is inferred at read time.

Record schemas for directory groups and members carry their rules in
``StructField.metadata``: ``api`` (sent to / received from the directory),
``column`` (stored column name), ``required``, ``readonly`` and ``enum``.
Projections (N5) and validation (N10) are generated from that metadata.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _f(name, dtype, **meta) -> StructField:
    return StructField(name, dtype, True, metadata=meta)


# Directory group record — properties, stored columns and flags.
GROUP_RECORD = StructType([
    _f("name", StringType(), required=True, column="group_name", api=True),
    _f("adminCreated", BooleanType(), readonly=True, api=True),
    _f("directMembersCount", IntegerType(), readonly=True, api=False),
    _f("email", StringType(), required=True, column="group_email", api=True),
    _f("id", StringType(), required=True, column="google_groupid", api=True),
    _f("description", StringType(), column="description", api=True),
    _f("etag", StringType(), column="etag", api=True),
    _f("department_id", IntegerType(), required=False, column="department_id", api=False),
    _f("group_type", StringType(), required=False, column="group_type", api=False),
    _f("unique_attribute", StringType(), required=False, column="unique_attribute", api=False),
])

# Directory member record.
MEMBER_RECORD = StructType([
    _f("role", StringType(), required=True, column="role", enum=["MEMBER", "OWNER", "MANAGER"], api=True),
    _f("type", StringType(), required=False, column="type", enum=["USER", "GROUP"], api=True),
    _f("email", StringType(), required=False, api=True),
    _f("id", StringType(), required=True, column="google_userid", api=True),
    _f("etag", StringType(), column="etag", api=True),
    _f("googleGroupID", StringType(), column="google_groupid", api=False),
])

EXTERNAL_ID = StructType([
    StructField("type", StringType()), StructField("customType", StringType()), StructField("value", StringType()),
])

# Directory user resource as listed by the directory (subset we use).
USER_RESOURCE = StructType([
    StructField("id", StringType()),
    StructField("primaryEmail", StringType()),
    StructField("name", StructType([StructField("givenName", StringType()), StructField("familyName", StringType())])),
    StructField("suspended", BooleanType()),
    StructField("orgUnitPath", StringType()),
    StructField("changePasswordAtNextLogin", BooleanType()),
    StructField("includeInGlobalAddressList", BooleanType()),
    StructField("creationTime", StringType()),
    StructField("lastLoginTime", StringType()),
    StructField("etag", StringType()),
    StructField("externalIds", ArrayType(EXTERNAL_ID)),
])

USER_PAGE = StructType([StructField("users", ArrayType(USER_RESOURCE)),
                        StructField("nextPageToken", StringType())])

# Directory user field → stored account column.  Nested
# objects (name) are flattened; externalIds is resolved by N2.
USER_FIELD_TO_COLUMN = {
    "id": "google_id",
    "primaryEmail": "primary_email",
    "name.givenName": "given_name",
    "name.familyName": "family_name",
    "suspended": "suspended",
    "orgUnitPath": "ou_path",
    "changePasswordAtNextLogin": "change_password",
    "includeInGlobalAddressList": "global_addressbook",
    "creationTime": "creation_time",
    "lastLoginTime": "lastlogin_date",
    "etag": "etag",
}

DEVICE_RESOURCE = StructType([
    StructField(n, StringType()) for n in (
        "serialNumber", "deviceId", "macAddress", "annotatedAssetId", "annotatedLocation", "annotatedUser",
        "notes", "orgUnitPath", "model", "platformVersion", "lastSync", "status")
])

# Device bulk-update CSV header.
DEVICE_UPDATE_CSV = StructType([
    StructField(n, StringType()) for n in (
        "serialNumber", "annotatedUser", "annotatedAssetId", "annotatedLocation", "orgUnitPath", "notes")
])

UID_LOOKUP_CSV = StructType([  # headerless: 0 type, 1-2 unused, 3 e-mail (key), 4 uid
    StructField("user_type", StringType()), StructField("c1", StringType()), StructField("c2", StringType()),
    StructField("email", StringType()), StructField("uid", StringType()),
])

EXTERNAL_ID_CSV = StructType([  # headerless: 0 unused, 1 user key, 2 id type, 3 id value
    StructField("c0", StringType()), StructField("user_key", StringType()),
    StructField("id_type", StringType()), StructField("id_value", StringType()),
])

RESPONSE = StructType([
    StructField("request_id", StringType()), StructField("status", IntegerType()),
    StructField("body", StructType([StructField("id", StringType()), StructField("email", StringType()),
                                    StructField("name", StringType()), StructField("etag", StringType())])),
])

ACCOUNT_COLUMNS = StructType([
    StructField("id", LongType()), StructField("google_id", StringType()), StructField("user_type", StringType()),
    StructField("primary_email", StringType()), StructField("given_name", StringType()),
    StructField("family_name", StringType()), StructField("external_uid", LongType()),
    StructField("suspended", BooleanType()), StructField("change_password", BooleanType()),
    StructField("global_addressbook", BooleanType()), StructField("ou_path", StringType()),
])
