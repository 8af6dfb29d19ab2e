"""Visibility by access signatures (survey J12).

Documents share few distinct sets of principals.  Each distinct set is a *signature*; the index is
three tables:

* ``members``: (id, sig), which signature a document has;
* ``signatures``: (sig, part, n), how many documents have it, and its *group part*;
* ``postings``: (principal, sig), inverted.

A reader's principals are looked up in the postings, so the work follows the small signature tables
and the counts are sums of ``n``; documents are touched only to list them.  Signatures that grant the
same groups to different users share a group part, and readers with the same groups share a group
set: a hot group is matched once for each set, not for each reader, and its own documents are a single
sum.  Nothing is collected and nothing is broadcast by hint.

Defined cases: a document without ACL or whose ACL names nobody is visible to no one; ``idp_wide`` is
visible to all; repeated principals count once; readers without groups (null or empty) have none; a
reader listed twice is answered twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import written

PUBLIC = "*"


def _first_reader(acl: str) -> Column:
    return F.element_at(F.col(acl)["readers"], 1)


def principal_keys(acl: str) -> Column:
    """Array of ``user:<id>`` / ``group:<id>`` keys of an ACL's first reader."""
    return F.transform(F.coalesce(_first_reader(acl)["principals"], F.array()), lambda p: F.coalesce(
        F.concat(F.lit("user:"), p["user_id"]), F.concat(F.lit("group:"), p["group_id"])))


def is_public(acl: str) -> Column:
    return F.coalesce(_first_reader(acl)["idp_wide"], F.lit(False))


@dataclass
class AccessIndex:
    members: DataFrame
    signatures: DataFrame
    postings: DataFrame
    #: (group, part): which group parts name a group.
    parts: DataFrame

    def count(self, readers: DataFrame) -> DataFrame:
        """(user_id, visible) for readers (user_id, groups ARRAY<STRING> of group principal ids).

        visible = public + documents of the reader's group set + documents granted to the reader by
        name whose group part does not already count through the group set."""
        keyed = readers.select("user_id", F.array_sort(F.array_distinct(F.coalesce("groups", F.array().cast("array<string>")))).alias("gset"))
        sets = keyed.select("gset").distinct()
        by_set = self._group_counts(sets)
        named = (keyed.distinct().withColumn("principal", F.concat(F.lit("user:"), F.col("user_id")))
                 .join(self.postings, "principal").join(self.signatures, "sig")
                 .groupBy("user_id", "gset", "part").agg(F.sum("n").alias("n")))
        counted = self._granted(named.select("gset", "part").distinct())
        alone = named.join(counted, ["gset", "part"], "left_anti").groupBy("user_id", "gset").agg(F.sum("n").alias("_named"))
        everyone = self.signatures.where(F.col("sig") == 0).select("n").scalar()
        out = keyed.join(by_set, "gset", "left").join(alone, ["user_id", "gset"], "left")
        total = F.coalesce(everyone, F.lit(0)) + F.coalesce("_grouped", F.lit(0)) + F.coalesce("_named", F.lit(0))
        return out.select("user_id", total.cast("bigint").alias("visible"))

    def _granted(self, pairs: DataFrame) -> DataFrame:
        """Those (gset, part) pairs whose part names a group of the set."""
        wanted = pairs.select("gset", "part", F.explode("gset").alias("group"))
        return wanted.join(self.parts, ["group", "part"], "left_semi").select("gset", "part").distinct()

    def _group_counts(self, sets: DataFrame) -> DataFrame:
        """(gset, _grouped): documents that grant any group of the set.

        The documents of the set's most granted group are a sum over that group alone.  Only the
        other groups' parts are matched part by part, less those that name the first one too."""
        by_part = self.signatures.where("sig <> 0").groupBy("part").agg(F.sum("n").alias("n"))
        parts = self.parts
        totals = parts.join(by_part, "part").groupBy("group").agg(F.sum("n").alias("n"))
        weighed = sets.select("gset", F.explode("gset").alias("group")).join(totals, "group")
        top = weighed.groupBy("gset").agg(F.max(F.struct("n", "group")).alias("_top")).select("gset", F.col("_top.group").alias("top"), F.col("_top.n").alias("_first"))
        others = weighed.select("gset", "group").join(top.select("gset", "top"), "gset").where(F.col("group") != F.col("top"))
        found = others.join(parts, "group").select("gset", "top", "part").distinct()
        named = parts.select(F.col("group").alias("top"), "part")
        more = found.join(named, ["top", "part"], "left_anti").join(by_part, "part").groupBy("gset").agg(F.sum("n").alias("_more"))
        both = top.join(more, "gset", "left")
        return both.select("gset", (F.col("_first") + F.coalesce("_more", F.lit(0))).alias("_grouped"))

    def documents(self, readers: DataFrame) -> DataFrame:
        """(user_id, id) of the restricted documents that each reader may read; public ones, which
        all may read, are ``public()``.  One row for each pair asked for: the result itself."""
        keyed = readers.select("user_id", F.coalesce("groups", F.array().cast("array<string>")).alias("g"))
        own = F.concat(F.array(F.concat(F.lit("user:"), F.col("user_id"))), F.transform("g", lambda g: F.concat(F.lit("group:"), g)))
        asked = keyed.select("user_id", F.explode(F.array_distinct(own)).alias("principal"))
        return asked.join(self.postings, "principal").select("user_id", "sig").distinct().join(self.members, "sig").select("user_id", "id")

    def public(self) -> DataFrame:
        return self.members.where(F.col("sig") == 0).select("id")


def access_index(docs: DataFrame, id_col: str = "id", acl_col: str = "acl_info", keep_members: bool = True) -> AccessIndex:
    """The index over ``docs``: one shuffle of the documents, on their principal set, pre-aggregated.
    Signature 0 is the public one.  Without ``keep_members`` (counts alone) the documents are read
    once and not written."""
    granted = docs.select(F.col(id_col).alias("id"), F.when(is_public(acl_col), F.array(F.lit(PUBLIC)))
                          .otherwise(F.array_sort(F.array_distinct(principal_keys(acl_col)))).alias("keys"))
    granted = granted.where(F.size("keys") > 0)
    if keep_members:
        granted = written(granted, "access-documents")
    sets = granted.groupBy("keys").agg(F.count(F.lit(1)).alias("n"))
    numbered = F.when(F.array_contains("keys", PUBLIC), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    groups = F.transform(F.filter("keys", lambda k: k.startswith("group:")), lambda k: F.substring(k, 7, 1 << 30))
    sets = written(sets.select("keys", "n", numbered.alias("sig"), groups.alias("groups")), "access-sets")
    # A group part is named by its groups; the digest only keeps the name short.
    sets = sets.withColumn("part", F.sha2(F.to_json("groups"), 256))
    postings = sets.select(F.explode("keys").alias("principal"), "sig").where(F.col("principal") != PUBLIC)
    parts = sets.select("part", F.explode("groups").alias("group")).distinct().select("group", "part")
    members = granted.join(sets.select("keys", "sig"), "keys").select("id", "sig")
    return AccessIndex(members, sets.select("sig", "part", "n"), postings, parts)
