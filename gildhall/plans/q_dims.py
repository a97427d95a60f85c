"""Refresh of dimensions whose changes arrive through a child table, and the
organisation and code history dimensions, over Silver derived from the whole
test tables."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from gildhall.plans.dp1_silver import LazyTables, derived_silver
from gildhall.plans.q_domain import (
    _DIMS_WITH, _gold, _materialized, CDC_AS_OF, CDC_HI, CDC_LO,
)
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF

# What the second Silver state does to an entity, by its number modulo 20: NEW changes a tracked column, IN_PLACE one
# kept in place, TOUCHED nothing; LATE changes at the end of the window, which belongs to the next one.
NEW, IN_PLACE, TOUCHED, LATE = 0, 1, 2, 3
INSIDE, EDGE = "2002-02-10 08:00:00", f"{CDC_HI} 00:00:00"


def _seen(kind):
    """When a child row of an entity of ``kind`` was updated."""
    return (F.when(kind.isin(NEW, IN_PLACE, TOUCHED), F.lit(INSIDE)).when(kind == LATE, F.lit(EDGE))
            .cast("timestamp_ntz"))


def _created(df):
    """``df``, its rows created inside the window."""
    return df.withColumn("created_dt", F.lit(INSIDE).cast("timestamp_ntz")).withColumn("updated_dt", F.lit(None).cast("timestamp_ntz"))


def _dated(df, kind):
    """``df`` with the times of its rows, none created inside the window."""
    return df.withColumn("created_dt", F.lit("2001-12-01").cast("timestamp_ntz")).withColumn("updated_dt", _seen(kind))


def _refresh(t, silver, name: str, changed: dict):
    from gildhall.plans.domain.cdc import refresh_dimension
    return refresh_dimension(ChainMap(changed, silver), _gold(t, silver), name, CDC_LO, CDC_HI, CDC_AS_OF, "cdc-1")


def _refreshed_sql(dim: str, key: str, sk: str, kind: str, in_place: str, new: str) -> str:
    """Oracle of a refresh: ``in_place`` and ``new`` are the replaced columns of those rows."""
    return f"""kinds AS (SELECT *, {kind} AS k FROM {dim}), mx AS (SELECT MAX({sk}) AS m FROM {dim})
SELECT * EXCLUDE (k), CASE WHEN k = {TOUCHED} THEN 'unchanged' ELSE 'kept' END AS _action FROM kinds WHERE k NOT IN ({NEW}, {IN_PLACE})
UNION ALL SELECT * EXCLUDE (k) REPLACE ({in_place}), 'updated' FROM kinds WHERE k = {IN_PLACE}
UNION ALL SELECT * EXCLUDE (k) REPLACE (TIMESTAMP '{CDC_AS_OF}' AS eff_end_dt, FALSE AS is_current_flag), 'closed'
FROM kinds WHERE k = {NEW}
UNION ALL SELECT * EXCLUDE (k) REPLACE ((SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY {key}) AS {sk}, {new},
          TIMESTAMP '{CDC_AS_OF}' AS eff_start_dt), 'inserted' FROM kinds WHERE k = {NEW}"""


@query("q_dp1_cdc_award", _materialized(f"{_DIMS_WITH}, " + _refreshed_sql(
    "d_award", "award_id", "award_sk", "award_id % 20", "last_mod_dt + INTERVAL 5 DAY AS last_mod_dt",
    """'P02' AS award_mod_num, award_id * 10 + 2 AS award_mod_id, 3 AS total_mods_count,
       base_award_dt + INTERVAL 60 DAY AS award_start_dt, base_award_dt + INTERVAL 61 DAY AS last_mod_dt""")))
def q_dp1_cdc_award(t):
    """Awards refreshed through their modifications: a new modification makes a version, a later signature is
    taken over in place, a row touched without a change makes nothing, one from the window's end waits."""
    silver = derived_silver(t)
    kind = F.col("award_id") % 20
    mods = silver["aasbs_award_mod"]
    last = F.col("mod_num") == "P01"
    later = F.when(last & kind.isin(IN_PLACE, LATE), F.col("co_signature_dt") + F.expr("interval 5 days")).otherwise(F.col("co_signature_dt"))
    added = mods.filter(last & (kind == NEW)).select(
        *[{"id": F.col("id") + 1, "mod_num": F.lit("P02"), "m1p_mod_start_dt": F.col("m1p_mod_start_dt") + F.expr("interval 30 days"),
           "co_signature_dt": F.col("co_signature_dt") + F.expr("interval 30 days")}.get(c, F.col(c)).alias(c) for c in mods.columns])
    award = silver["aasbs_award"].withColumn(
        "latest_award_mod_id", F.col("latest_award_mod_id") + F.when(F.col("id") % 20 == NEW, 1).otherwise(0))
    old = _dated(mods.withColumn("co_signature_dt", later), F.when(last & (kind != NEW), kind))
    return _refresh(t, silver, "common.dim_award", {"aasbs_award": award, "aasbs_award_mod": old.unionByName(_created(added))})


@query("q_dp1_cdc_funding", _materialized(f"{_DIMS_WITH}, " + _refreshed_sql(
    "d_funding", "funding_id", "funding_sk", "funding_id % 20",
    "funding_id * 10 + 1 AS funding_amendment_id, CAST(total_funded_amt + 100 AS DECIMAL(15,2)) AS total_funded_amt",
    "'FS9' AS fund_status_cd, 'FS9' AS fund_status_desc")))
def q_dp1_cdc_funding(t):
    """Fundings refreshed through their amendments: a status makes a version, a further amendment's money is
    added in place."""
    silver = derived_silver(t)
    kind = F.col("funding_id") % 20
    own = F.col("id") % 20
    amendments = silver["aasbs_funding_amendment"]
    further = amendments.filter(kind == IN_PLACE).withColumn("id", F.col("id") + 1)
    money = further.select(F.col("id").alias("funding_amendment_id"), F.lit(100).cast("decimal(15,2)").alias("loa_change_amt"),
                           F.lit(0).cast("long").alias("loa_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    funding = silver["aasbs_funding"].withColumn(
        "fund_status_cd", F.when(own.isin(NEW, LATE), F.lit("FS9")).otherwise(F.col("fund_status_cd"))).withColumn(
        "latest_funding_amendment_id", F.col("latest_funding_amendment_id") + F.when(own == IN_PLACE, 1).otherwise(0))
    return _refresh(t, silver, "common.dim_funding", {
        "aasbs_funding": funding,
        "aasbs_funding_amendment": _dated(amendments, F.when(kind != IN_PLACE, kind)).unionByName(_created(further)),
        "aasbs_funding_amendment_loa": silver["aasbs_funding_amendment_loa"].unionByName(money)})


@query("q_dp1_cdc_line_item", _materialized(f"{_DIMS_WITH}, " + _refreshed_sql(
    "d_line_item", "line_item_id", "line_item_sk", "(line_item_id // 100) % 20", "'Z' AS line_item_type_cd, 'Z' AS line_item_type_desc",
    """line_item_id + 1000000000000 AS line_item_accepted_id, CAST(budget_fy + 1 AS INTEGER) AS budget_fy,
       TRUE AS exercise_this_yn""")))
def q_dp1_cdc_line_item(t):
    """Line items refreshed through their accepted versions: a further version makes one of the dimension, a type
    that changed beside it is taken over in place."""
    silver = derived_silver(t)

    def kind(c):
        return F.floor(F.col(c) / 100) % 20
    accepted = silver["aasbs_line_item_accepted"]
    further = accepted.filter(kind("line_item_id") == NEW).withColumn("id", F.col("id") + 10 ** 12) \
        .withColumn("budget_fy", F.col("budget_fy") + 1).withColumn("exercise_this_yn", F.lit("Y"))
    items = silver["aasbs_line_item"].withColumn(
        "line_item_type_cd", F.when(kind("id").isin(IN_PLACE, LATE), F.lit("Z")).otherwise(F.col("line_item_type_cd")))
    child = kind("line_item_id")
    return _refresh(t, silver, "common.dim_line_item", {
        "aasbs_line_item": items,
        "aasbs_line_item_accepted": _dated(accepted, F.when(child != NEW, child)).unionByName(_created(further))})


# fin codes: a log row per order under its customer's code; organisations: a tree of customers with chains of 31, some
# heads that left (their units start trees of their own), some that head themselves and so have no path
ORG_SQL = """RECURSIVE org_nodes AS (
  SELECT c_custkey AS id, c_name AS name, c_custkey % 7 AS tier,
         CASE WHEN c_custkey = 0 OR c_custkey % 23 = 7 THEN NULL WHEN c_custkey % 50 = 49 THEN c_custkey
              WHEN c_custkey % 64 BETWEEN 1 AND 31 THEN c_custkey - 1 ELSE c_custkey // 3 END AS parent
  FROM customer WHERE c_custkey % 41 <> 1),
org_tree(id, path) AS (
  SELECT id, name FROM org_nodes WHERE parent IS NULL OR parent NOT IN (SELECT id FROM org_nodes)
  UNION ALL
  SELECT n.id, p.path || ' / ' || n.name FROM org_nodes n JOIN org_tree p ON n.parent = p.id WHERE n.parent <> n.id)"""


@query("q_wpr_dim_org_hierarchy", f"""WITH {ORG_SQL}
SELECT ROW_NUMBER() OVER (ORDER BY n.id) AS org_sk, n.id AS org_id,
       CASE WHEN n.id % 2 = 0 THEN 'ORG' || CAST(n.id AS VARCHAR) ELSE n.name END AS org_code, n.name AS org_name,
       n.parent AS parent_org_id, CAST(n.tier AS INTEGER) AS org_level, p.path AS org_path, CAST(NULL AS VARCHAR) AS region_cd,
       CAST(NULL AS BOOLEAN) AS is_active_flag
FROM org_nodes n LEFT JOIN org_tree p ON p.id = n.id""")
def q_wpr_dim_org_hierarchy(t):
    """Organisations with one head each (smallest of the cross-references) and the path from their root, by
    pointer doubling; those on or under a cycle keep their row without a path."""
    silver = LazyTables()
    ck = F.col("c_custkey")
    none = F.lit(None).cast("boolean").alias("is_deleted")
    silver["assist_lu_emp_orgs"] = lambda: t["customer"].select(
        ck.alias("emp_org_id"), F.col("c_name").alias("emp_org_name"),
        F.when(ck % 2 == 0, F.concat(F.lit("ORG"), ck.cast("string"))).alias("emp_org_short_name"),
        (ck % 7).alias("tier_id"), (ck % 41 == 1).alias("is_deleted"))
    head = (F.when(ck % 50 == 49, ck).when((ck % 64).between(1, 31), ck - 1).otherwise(F.floor(ck / 3).cast("long")))
    silver["assist_lu_emp_org_xref"] = lambda: t["customer"].filter(ck != 0).select(
        F.when(ck % 23 != 7, ck).alias("emp_org_child_id"), head.alias("emp_org_id"), none).unionByName(
        t["customer"].filter((ck % 5 == 0) & (ck % 23 != 7) & (ck != 0)).select(
            ck.alias("emp_org_child_id"), (head + 2).alias("emp_org_id"), none))
    from gildhall.plans.domain import BUILDERS
    return BUILDERS["wpr.dim_org_hierarchy"](silver, {}, AS_OF)


@query("q_iat_dim_fin_code_history", """SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS fin_code_history_sk,
       o_orderkey AS fin_log_id, CAST(-1 AS BIGINT) AS award_sk, CAST(-1 AS BIGINT) AS ia_sk,
       'F' || CAST(o_custkey AS VARCHAR) AS fin_cd, o_custkey AS fin_base_10, o_orderdate AS effective_dt,
       CAST(NULL AS TIMESTAMP) AS superseded_dt,
       o_orderkey = MAX(o_orderkey) OVER (PARTITION BY o_custkey) AS is_current_flag, o_orderkey % 50 AS created_by_user_id
FROM orders WHERE o_orderkey % 19 <> 0""")
def q_iat_dim_fin_code_history(t):
    """Log of fin codes; the latest row of each code is current."""
    silver = {"aasbs_award_fin_log": t["orders"].select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("F"), F.col("o_custkey").cast("string")).alias("fin"),
        F.col("o_custkey").alias("fin_base_10"), F.col("o_orderdate").alias("created_dt"),
        (F.col("o_orderkey") % 50).alias("created_by_user_id"), (F.col("o_orderkey") % 19 == 0).alias("is_deleted"))}
    from gildhall.plans.domain import BUILDERS
    return BUILDERS["iat.dim_fin_code_history"](silver, {}, AS_OF)
