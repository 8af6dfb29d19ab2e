"""ACL column builders (survey C10-C13) and a flat ACL rendering for reports.

An ACL is ``STRUCT<readers ARRAY<STRUCT<idp_wide, principals ARRAY<PRINCIPAL>>>>``
with exactly one reader entry: either ``idp_wide = true`` or a principal list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.schemas import ACL, PRINCIPAL

# Fixed values that must equal the reference's: principals meaning "everyone".
PUBLIC_MARKERS = ["allAuthenticatedUsers", "allUsers"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _null_str() -> Column:
    return F.lit(None).cast("string")


def user_principal(email: Column) -> Column:
    return F.struct(email.cast("string").alias("user_id"), _null_str().alias("group_id"))


def group_principal(group: Column) -> Column:
    return F.struct(_null_str().alias("user_id"), group.cast("string").alias("group_id"))


def users_to_principals(emails) -> Column:
    return F.transform(F.coalesce(_c(emails), F.array().cast("array<string>")), user_principal)


def groups_to_principals(groups) -> Column:
    return F.transform(F.coalesce(_c(groups), F.array().cast("array<string>")), group_principal)


def public_acl() -> Column:
    reader = F.struct(F.lit(True).alias("idp_wide"),
                      F.array().cast(f"array<{PRINCIPAL.simpleString()}>").alias("principals"))
    return F.struct(F.array(reader).alias("readers")).cast(ACL)


def principals_acl(principals: Column) -> Column:
    reader = F.struct(F.lit(False).alias("idp_wide"), principals.alias("principals"))
    return F.struct(F.array(reader).alias("readers")).cast(ACL)


def null_acl() -> Column:
    return F.lit(None).cast(ACL)


def _is_marker(value: Column) -> Column:
    return value.isin(*PUBLIC_MARKERS)


def acl_from_principals(principals) -> Column:
    """Empty -> NULL; a public marker on the user side -> public; else principals."""
    p = _c(principals)
    return (F.when(p.isNull() | (F.size(p) == 0), null_acl())
            .when(F.exists(p, lambda x: F.coalesce(_is_marker(x["user_id"]), F.lit(False))), public_acl())
            .otherwise(principals_acl(p)))


def acl_from_emails(emails) -> Column:
    """C10 applied to a list of user e-mails (empty / null entries dropped first)."""
    kept = F.filter(F.coalesce(_c(emails), F.array().cast("array<string>")),
                    lambda e: e.isNotNull() & (e != ""))
    return acl_from_principals(F.transform(kept, user_principal))


def permissions_to_principals(perms) -> Column:
    """C11 first half: ``[{email, type}]`` -> principals; GROUP -> group_id, else user_id;
    entries without an e-mail are skipped."""
    kept = F.filter(F.coalesce(_c(perms), F.array()), lambda p: F.coalesce(p["email"], F.lit("")) != "")
    return F.transform(kept, lambda p: F.when(
        F.upper(F.coalesce(p["type"], F.lit("USER"))) == "GROUP", group_principal(p["email"]))
        .otherwise(user_principal(p["email"])))


def acl_from_permissions(perms) -> Column:
    """C11: principals from a permission list; the public marker may sit on either side."""
    principals = permissions_to_principals(perms)
    public = F.exists(principals, lambda x: F.coalesce(_is_marker(x["user_id"]), F.lit(False))
                      | F.coalesce(_is_marker(x["group_id"]), F.lit(False)))
    return (F.when(F.size(principals) == 0, null_acl())
            .when(public, public_acl())
            .otherwise(principals_acl(principals)))


def row_principals(allowed_users, allowed_groups, owner_email) -> Column:
    """C12 principal list: users then groups; the owner only when both are empty."""
    listed = F.concat(users_to_principals(allowed_users), groups_to_principals(allowed_groups))
    owner = _c(owner_email)
    return F.when((F.size(listed) == 0) & (F.coalesce(owner, F.lit("")) != ""),
                  F.array(user_principal(owner))).otherwise(listed)


def acl_from_row(private, allowed_users, allowed_groups, owner_email) -> Column:
    """Not private -> public; else principals; none -> NULL (row is dropped)."""
    principals = row_principals(allowed_users, allowed_groups, owner_email)
    is_private = F.coalesce(_c(private), F.lit(False))
    return (F.when(~is_private, public_acl())
            .when(F.size(principals) > 0, principals_acl(principals))
            .otherwise(null_acl()))


def permissions_block(private, allowed_users, allowed_groups) -> Column:
    """``allowAnonymousAccess = not private``; lists only when private and non-empty
    (the owner fallback is not reflected here)."""
    is_private = F.coalesce(_c(private), F.lit(False))
    users = F.coalesce(_c(allowed_users), F.array().cast("array<string>"))
    groups = F.coalesce(_c(allowed_groups), F.array().cast("array<string>"))
    return F.struct(
        (~is_private).alias("allowAnonymousAccess"),
        F.when(is_private & (F.size(users) > 0),
               F.transform(users, lambda e: F.struct(e.alias("email")))).alias("allowedUsers"),
        F.when(is_private & (F.size(groups) > 0),
               F.transform(groups, lambda g: F.struct(g.alias("id")))).alias("allowedGroups"),
    )


def acl_summary(acl) -> Column:
    """Flat text form of an ACL for reports and cross-engine checks:
    ``PUBLIC``, or ``user:a,group:b`` in principal order, or NULL."""
    a = _c(acl)
    first = F.element_at(a["readers"], 1)
    rendered = F.array_join(F.transform(first["principals"], lambda p: F.coalesce(
        F.concat(F.lit("user:"), p["user_id"]), F.concat(F.lit("group:"), p["group_id"]))), ",")
    return (F.when(a.isNull(), _null_str())
            .when(F.coalesce(first["idp_wide"], F.lit(False)), F.lit("PUBLIC"))
            .otherwise(rendered))


def acl_principal_count(acl) -> Column:
    a = _c(acl)
    first = F.element_at(a["readers"], 1)
    return F.when(a.isNull(), F.lit(0)).otherwise(F.coalesce(F.size(first["principals"]), F.lit(0))).cast("bigint")
