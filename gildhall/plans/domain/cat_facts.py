"""Lifecycle event fact (cat): chronology entries and collaboration requests
in one event shape (SET-1).

Chronology rows point at different tables through a table-name code; the
code decides which dimension the record id refers to (JON-10). Each target
is a left join whose ON carries the left-side predicate, so the plan stays
an equi-join. The IA pattern escapes the underscore (``%\\_IA``) so codes
such as ``MEDIA`` no longer resolve to an IA (fix for D-28). Collaboration
events all map to the single COLLABORATION event type: a constant-key
lookup built as a scalar subquery with a one-row check, no join (JON-12).
The latest comment per collaboration is a keep-one (WIN-1), and a
collaboration's acquisition is reduced to one (smallest) before its agency
is resolved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk
from gildhall.operators import const_lookup, keep_one, pick_one, poly_ref, resolve_sk, union_shapes
from gildhall.operators.joins import like_literal
from gildhall.sources import live

# Table-name code → entity type (first match wins; IA is the
# exact code or a code ending in "_IA").
ENTITY_RULES = [("AWARD", "%AWARD%"), ("ACQUISITION", "%ACQUISITION%"), ("SOLICITATION", "%SOLICIT%"),
                ("FUNDING", "%FUNDING%")]
COLLAB_EVENT_CODE = "COLLABORATION"
COLLAB_TABLE_CODE = "CENTRAL_COLLAB"


def _is_ia(code) -> F.Column:
    u = F.upper(code)
    return (u == "IA") | u.like("%" + like_literal("_IA"))


def entity_type(code) -> F.Column:
    u = F.upper(code)
    return (F.when(u.like(ENTITY_RULES[0][1]), ENTITY_RULES[0][0]).when(_is_ia(code), "IA")
             .when(u.like(ENTITY_RULES[1][1]), ENTITY_RULES[1][0]).when(u.like(ENTITY_RULES[2][1]), ENTITY_RULES[2][0])
             .when(u.like(ENTITY_RULES[3][1]), ENTITY_RULES[3][0]).otherwise("COLLAB"))


def _award_dim_by_mod(silver, gold) -> DataFrame:
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("award_mod_id"), "award_id")
    aw = gold["common.dim_award"].filter(F.col("is_current_flag")).select("award_id", "award_sk")
    return mods.join(aw, "award_id")


def _event_shape(df: DataFrame) -> DataFrame:
    cols = ["event_type_sk", "entity_type_sk", "award_sk", "ia_sk", "agency_sk", "event_date_sk", "source_entity_id",
            "source_chronology_id", "source_collab_id", "event_timestamp", "event_user_id", "event_description",
            "collab_type_cd", "collab_status_cd", "collab_due_dt", "comment_type_cd", "comment_text", "email_status_cd"]
    return df.select(*cols)


def fact_lifecycle_event(silver, gold, as_of: str) -> DataFrame:
    entity_types = gold["wpr.dim_entity_type"].select("entity_type_cd", "entity_type_sk")
    award_by_mod = _award_dim_by_mod(silver, gold)
    ia_dim = gold["common.dim_ia"]
    acq = live(silver["aasbs_acquisition"]).select(F.col("id").alias("acquisition_id"), "activity_address_cd")
    acq = resolve_sk(acq, gold["common.dim_agency"], "activity_address_cd", "agency_sk")

    # chronology branch
    c = live(silver["aasbs_chronology"]).withColumn("entity_type_cd", entity_type(F.col("source_table_name_cd")))
    code = F.upper(F.col("source_table_name_cd"))
    c = poly_ref(c, "source_table_name_cd", "event_record_id", {
        "_award_sk": (code.like("%AWARD%"), award_by_mod, "award_mod_id", "award_sk")})
    c = poly_ref(c, "source_table_name_cd", "source_record_id", {
        "_ia_sk": (_is_ia(F.col("source_table_name_cd")), ia_dim.filter(F.col("is_current_flag")), "ia_id", "ia_sk"),
        "_agency_sk": (code.like("%ACQUISITION%"), acq, "acquisition_id", "agency_sk")})
    c = resolve_sk(c, gold["cat.dim_event_type"], "event_type_cd", "event_type_sk")
    c = resolve_sk(c, entity_types, "entity_type_cd", "entity_type_sk")
    chron = c.select(
        "event_type_sk", "entity_type_sk",
        *[F.coalesce(F.col(f"_{k}"), F.lit(-1)).cast("bigint").alias(k) for k in ("award_sk", "ia_sk", "agency_sk")],
        date_sk("created_dt").alias("event_date_sk"), F.col("source_record_id").alias("source_entity_id"),
        F.col("id").alias("source_chronology_id"), F.lit(None).cast("bigint").alias("source_collab_id"),
        F.col("created_dt").alias("event_timestamp"), F.col("created_by_user_id").alias("event_user_id"),
        F.col("entry_description").alias("event_description"))

    # collaboration branch
    cc = live(silver["aasbs_central_collab"]).withColumn("entity_type_cd", entity_type(F.col("table_name_cd")))
    ccode = F.upper(F.col("table_name_cd"))
    cc = poly_ref(cc, "table_name_cd", "table_record_id", {
        "_award_sk": (ccode.like("%AWARD%"), award_by_mod, "award_mod_id", "award_sk"),
        "_ia_sk": (_is_ia(F.col("table_name_cd")), ia_dim.filter(F.col("is_current_flag")), "ia_id", "ia_sk")})
    collab_acq = pick_one(live(silver["aasbs_central_collab_acq"]), "central_collab_id", "acquisition_id", how="min")
    cc = cc.join(collab_acq.withColumnRenamed("central_collab_id", "id"), "id", "left") \
        .join(acq.select("acquisition_id", F.col("agency_sk").alias("_agency_sk")), "acquisition_id", "left")
    comments = keep_one(live(silver["aasbs_central_comment"]).filter(F.col("table_name_cd") == COLLAB_TABLE_CODE),
                        ["table_record_id"], [F.col("id").desc()]) \
        .select(F.col("table_record_id").alias("id"), "comment_type_cd", "comment_text")
    cc = cc.join(comments, "id", "left")
    cc = resolve_sk(cc, entity_types, "entity_type_cd", "entity_type_sk")
    cc = const_lookup(cc, gold["cat.dim_event_type"], F.upper(F.col("event_type_cd")) == COLLAB_EVENT_CODE,
                      ["event_type_sk"])
    collab = cc.select(
        F.coalesce("event_type_sk", F.lit(-1)).cast("bigint").alias("event_type_sk"), "entity_type_sk",
        *[F.coalesce(F.col(f"_{k}"), F.lit(-1)).cast("bigint").alias(k) for k in ("award_sk", "ia_sk", "agency_sk")],
        date_sk("created_dt").alias("event_date_sk"), F.col("table_record_id").alias("source_entity_id"),
        F.lit(None).cast("bigint").alias("source_chronology_id"), F.col("id").alias("source_collab_id"),
        F.col("created_dt").alias("event_timestamp"), F.col("created_by_user_id").alias("event_user_id"),
        F.col("subject").alias("event_description"), "collab_type_cd", "collab_status_cd",
        F.col("due_dt").alias("collab_due_dt"), "comment_type_cd", "comment_text",
        F.lit(None).cast("string").alias("email_status_cd"))
    return _event_shape(union_shapes([chron, collab]))
