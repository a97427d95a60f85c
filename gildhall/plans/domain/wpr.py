"""Workforce & role dimensions (wpr): users, clients, industry partners,
organisation hierarchy.

Users, clients and partners carry two delete flags: the boolean
``is_deleted`` and a character ``delete_flag`` ('Y' = deleted); both go
through ``live`` (SRC-3), NULL counting as live. All rows start current
(SCD-2f). The organisation path is the iterative level join of
``org_paths`` over the parent→child cross-reference (REC-1..REC-3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import full_name, phone_with_ext
from gildhall.operators import assign_sk, org_paths, pick_one, scd2_initial
from gildhall.sources import live


def _live2(df: DataFrame) -> DataFrame:
    return live(df, also=[("delete_flag", "Y")])


def dim_user(silver, gold, as_of: str) -> DataFrame:
    u = _live2(silver["assist_users"])
    out = u.select(
        F.col("id").cast("string").alias("user_id"), "first_name", "last_name",
        full_name("first_name", "middle_initial", "last_name").alias("full_name"), "email",
        phone_with_ext("phone", "phone_ext").alias("phone"),
        *[F.lit(None).cast("string").alias(c) for c in ("org_code", "org_name", "region_cd")],
        ((F.col("reg_status") == "ACTIVE") & F.col("inactive_date").isNull()).alias("is_active_flag"),
        F.col("okta_user_id").alias("procurement_system_id"),
        F.coalesce("activation_date", "creation_date").alias("_start"))
    out = assign_sk(out, ["user_id"], name="user_sk")
    # the version starts when the user was activated (created), not at load time
    return scd2_initial(out, as_of).withColumn("eff_start_dt", F.coalesce("_start", "eff_start_dt")).drop("_start")


def dim_client(silver, gold, as_of: str) -> DataFrame:
    c = _live2(silver["table_master_clients"])
    out = c.select("client_id", "client_name", "client_code", F.col("gsa_contact").alias("contact_name"),
                   F.col("email").alias("contact_email"),
                   phone_with_ext("phone", "phone_ext").alias("contact_phone"),
                   F.lit(None).cast("bigint").alias("agency_sk"))
    return scd2_initial(assign_sk(out, ["client_id"], name="client_sk"), as_of)


def dim_industry_partner(silver, gold, as_of: str) -> DataFrame:
    p = _live2(silver["table_master_industry_partners"])
    out = p.select(F.col("ipartner_id").alias("partner_id"), F.col("ipartner_company_name").alias("company_name"),
                   F.col("ipartner_inc_status").alias("contract_status_cd"), F.col("ipartner_ftin").alias("ftin"),
                   F.col("city").alias("address_city"), F.col("state").alias("address_state_cd"),
                   F.col("country").alias("address_country_cd"))
    return scd2_initial(assign_sk(out, ["partner_id"], name="industry_partner_sk"), as_of)


def dim_org_hierarchy(silver, gold, as_of: str) -> DataFrame:
    orgs = live(silver["assist_lu_emp_orgs"])
    xref = live(silver["assist_lu_emp_org_xref"]).filter(F.col("emp_org_child_id").isNotNull())
    parent = pick_one(xref, "emp_org_child_id", "emp_org_id", how="min", out="parent_org_id") \
        .withColumnRenamed("emp_org_child_id", "emp_org_id")
    nodes = orgs.join(parent, "emp_org_id", "left")
    paths = org_paths(nodes, node="emp_org_id", parent="parent_org_id", name="emp_org_name") \
        .select(F.col("node_id").alias("emp_org_id"), F.col("path").alias("org_path"))
    out = nodes.join(paths, "emp_org_id", "left").select(
        F.col("emp_org_id").alias("org_id"), F.coalesce("emp_org_short_name", "emp_org_name").alias("org_code"),
        F.col("emp_org_name").alias("org_name"), "parent_org_id", F.col("tier_id").cast("int").alias("org_level"),
        "org_path", F.lit(None).cast("string").alias("region_cd"), F.lit(None).cast("boolean").alias("is_active_flag"))
    return assign_sk(out, ["org_id"], name="org_sk")
