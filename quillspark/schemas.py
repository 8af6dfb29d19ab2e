"""Declared Spark types for the document model (declare once, import everywhere)."""

from pyspark.sql import types as T

PRINCIPAL = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("group_id", T.StringType()),
])

READER = T.StructType([
    T.StructField("idp_wide", T.BooleanType()),
    T.StructField("principals", T.ArrayType(PRINCIPAL)),
])

ACL = T.StructType([T.StructField("readers", T.ArrayType(READER))])

CONTENT = T.StructType([
    T.StructField("mime_type", T.StringType()),
    T.StructField("raw_bytes", T.BinaryType()),
])

DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("struct_data", T.StringType()),
    T.StructField("json_data", T.StringType()),
    T.StructField("content", CONTENT),
    T.StructField("acl_info", ACL),
])

PROPERTY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])

ERROR = T.StructType([
    T.StructField("component", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("message", T.StringType()),
])

STATE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("expires_at", T.DoubleType()),
])

PERMISSION = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("type", T.StringType()),
])

REST_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("content_base64", T.StringType()),
    T.StructField("department_code", T.StringType()),
    T.StructField("mime", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("database_cluster_node", T.StringType()),
    T.StructField("permissions", T.ArrayType(PERMISSION)),
])

INTERACTIONS = T.StructType([
    T.StructField("numLikes", T.LongType()),
    T.StructField("numComments", T.LongType()),
    T.StructField("numViews", T.LongType()),
])

# Columns every entity row is expected to expose (schema-drift baseline).
# Fixed values that must equal the reference's, in its order.
COMMON_ENTITY_KEYS = [
    "scenario", "entityType", "action", "id",
    "title", "description", "url",
    "createdAt", "updatedAt",
    "private", "allowedUsers", "allowedGroups", "ownerEmail",
    "interactions",
]
