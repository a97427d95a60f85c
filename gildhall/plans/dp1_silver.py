"""Silver-shaped tables of the first product, derived from the test tables.

Used to run the real domain builders (dimensions, obligation fact, CFO view)
over the whole test data. Every table is a Spark projection of the given
tables, so the work grows with them; the same derivation is written in SQL
(``SILVER_SQL``) for the DuckDB oracle.

  region   → agencies (lu_agency, federal agency list)
  nation   → activity address codes (one per nation) and bureaus (five per agency)
  customer → IAs, fundings, funding amendments
  supplier → LOAs
  orders   → awards (two modifications each), award→IA bridge, LOA funding
  part     → deliverables
  lineitem → line items (one per order/line number), accepted lines, ledger,
             invoice, acceptance and bill items
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildhall.plans.standins import dmul, ledger
from gildhall.session import stored


def _pad(c, n: int) -> F.Column:
    return F.lpad(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), n, "0")


def _aac(c) -> F.Column:
    return F.concat(F.lit("AAC"), _pad(c, 3))


class LazyTables(Mapping):
    """Name → DataFrame whose plan is built on first access: a query plans
    (and reads the footers of) only the Silver tables it uses."""

    def __init__(self):
        self._fns: dict = {}
        self._built: dict[str, DataFrame] = {}

    def __setitem__(self, name: str, fn) -> None:
        self._fns[name] = fn
        self._built.pop(name, None)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._fns[name]()
        return self._built[name]

    def __contains__(self, name) -> bool:
        return name in self._fns

    def __iter__(self):
        return iter(self._fns)

    def __len__(self) -> int:
        return len(self._fns)


def _once(fn):
    """Zero-argument builder evaluated once (a plan shared by several tables)."""
    done: list = []

    def get():
        if not done:
            done.append(fn())
        return done[0]
    return get


def _code_table(df: DataFrame, col: str) -> DataFrame:
    # stored, as Silver lookups are: their size is known where they are joined, so the rows that
    # carry the few codes are not sent to one task a code
    return stored(df.select(F.col(col).alias("cd")).filter(F.col("cd").isNotNull()).distinct().select(
        "cd", F.concat(F.lit("Code "), F.col("cd")).alias("description"), F.lit(None).cast("boolean").alias("is_deleted")))


def line_groups(t):
    """Builder of the rows that most Silver tables of lines are projections of, one per order and line number.

    Grouped and stored once, so that each of those tables is a scan instead of another shuffle of all line items. A
    line stands once for each row of its order, numbered by ``_order`` (NULL: no order; ``one_a_line`` keeps the first),
    found in the same partition. Sorted, so that keys take little room in the files.
    """
    def build():
        rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_linestatus")
        per_line = rows.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("_part"), F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("_total"),
            F.min("l_shipdate").alias("_start"), F.max("l_shipdate").alias("_end"), F.min("l_linestatus").alias("_status"))
        same = Window.partitionBy("l_orderkey").orderBy("o_custkey", "o_orderdate")
        orders = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate") \
            .withColumn("_order", F.row_number().over(same))
        return stored(per_line.join(orders, "l_orderkey", "left").sortWithinPartitions("l_orderkey", "l_linenumber"))
    return _once(build)


def one_a_line(groups: DataFrame) -> DataFrame:
    """The lines of ``line_groups``, each once."""
    return groups.filter(F.col("_order").isNull() | (F.col("_order") == 1)).drop("_order", "o_custkey", "o_orderdate")


def derived_silver(t, groups=None) -> Mapping[str, DataFrame]:
    s = LazyTables()
    T = t.__getitem__
    groups = groups or line_groups(t)

    def lines():
        return one_a_line(groups())

    def lines_of_orders():
        return groups().filter(F.col("_order").isNotNull()).drop("_order")
    s["aasbs_lu_agency"] = lambda: T("region").select(
        F.upper(F.substring("r_name", 1, 3)).alias("cd"), _pad("r_regionkey", 2).alias("cd_2char"),
        F.col("r_name").alias("description"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["table_master_lu_federal_agency"] = lambda: T("region").select(
        _pad("r_regionkey", 2).alias("agency_code"), F.lower("r_name").alias("agency_description"),
        F.when(F.col("r_regionkey") % 3 == 0, "EXEC").when(F.col("r_regionkey") % 3 == 1, "LEGIS")
         .otherwise("OTHER").alias("agency_type"),
        F.lit(None).cast("string").alias("bureau_description"), F.lit(None).cast("timestamp_ntz").alias("inactive_date"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_lu_activity_address_code"] = lambda: T("nation").select(
        _aac("n_nationkey").alias("cd"), F.col("n_name").alias("description"),
        _pad("n_regionkey", 2).alias("fpds_ng_agency_identifier"),
        F.concat(F.lit("P"), (F.col("n_nationkey") % 3).cast("string")).alias("program_cd"),
        _pad("n_regionkey", 2).alias("region_cd"), (F.col("n_nationkey") == 24).alias("is_deleted"))
    s["aasbs_lu_bureau"] = lambda: T("nation").join(T("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper(F.substring("r_name", 1, 3)).alias("agency_cd"), F.concat(F.lit("B"), _pad("n_nationkey", 2)).alias("cd"),
        F.concat(F.col("n_name"), F.lit(" bureau")).alias("description"), F.lit(None).cast("boolean").alias("is_deleted"),
        F.date_add(F.to_date(F.lit("2000-01-01")), (24 - F.col("n_nationkey")).cast("int")).cast("timestamp_ntz")
         .alias("updated_dt"))
    seg = F.col("c_mktsegment")
    s["aasbs_ia"] = lambda: T("customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("IA-"), F.col("c_custkey").cast("string")).alias("piid"),
        F.when(seg == "AUTOMOBILE", "MIPR").when(seg == "BUILDING", "gtc").when(seg == "FURNITURE", "IAA")
         .when(seg == "HOUSEHOLD", "LOCAL").alias("instrument_type_cd"),
        F.concat(F.lit("S"), (F.col("c_custkey") % 4).cast("string")).alias("ia_status_cd"),
        (F.lit(1995) + F.col("c_custkey") % 7).cast("int").alias("fiscal_year"),
        F.date_add(F.to_date(F.lit("1995-01-01")), (F.col("c_custkey") % 1000).cast("int")).cast("timestamp_ntz")
         .alias("ia_began_dt"),
        _aac("c_nationkey").alias("activity_address_cd"),
        F.concat(F.lit("SVC"), (F.col("c_nationkey") % 5).cast("string")).alias("serv_agency_cd"),
        (F.col("c_custkey") % 97 == 1).alias("is_deleted"))
    s["aasbs_lu_ia_status"] = lambda: _code_table(s["aasbs_ia"].filter(F.col("ia_status_cd") != "S3"), "ia_status_cd")
    s["aasbs_loa"] = lambda: T("supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_suppkey") + 1000).alias("tracking_num"),
        F.concat(F.lit("L"), (F.col("s_suppkey") % 3).cast("string")).alias("loa_status_cd"),
        F.concat(F.lit("AG-"), (F.col("s_suppkey") % 17).cast("string")).alias("agreement_number"),
        (F.col("s_suppkey") % 9).cast("int").alias("ginv_line_num"),
        F.lit("047").alias("tsym_alloc_trans_agency_cd"),
        F.concat(_pad(F.col("s_nationkey") % 5, 2), _pad("s_nationkey", 2)).alias("requesting_agency_cd"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("X")).alias("tsym_availability_type"),
        _pad(F.col("s_suppkey") % 100, 4).alias("appropriation"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit("")).otherwise(F.lit("001")).alias("treasury_sub_account"),
        F.concat(F.lit("F"), (F.col("s_suppkey") % 4).cast("string")).alias("customer_fund"),
        F.lit("T1").alias("fund_type_cd"), F.col("s_name").alias("customer_act_num"),
        F.lit(2000).alias("first_fy_available_year"), F.lit(2002).alias("last_fy_available_year"),
        F.lit(None).cast("timestamp_ntz").alias("agreement_end_dt"), F.lit(None).cast("timestamp_ntz").alias("transmitted_dt"),
        _aac(F.col("s_suppkey") % 30).alias("agency_location_code"),
        (F.col("s_suppkey") % 50 == 49).alias("is_deleted"))
    s["aasbs_lu_loa_status"] = lambda: _code_table(s["aasbs_loa"], "loa_status_cd")
    s["aasbs_award"] = lambda: T("orders").select(
        F.col("o_orderkey").alias("id"),
        # every tenth PIID is not zero-padded (shorter than a full PIID)
        F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("47QA"), F.col("o_orderkey").cast("string")))
         .otherwise(F.concat(F.lit("47QA"), _pad("o_orderkey", 9))).alias("award_piid"),
        F.col("o_orderstatus").alias("award_status_cd"), F.col("o_orderpriority").alias("award_fin"),
        # awards of up to four consecutive order keys share one acquisition; even keys were solicited
        (F.col("o_orderkey") - F.col("o_orderkey") % 4).alias("acquisition_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("solicit_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") * 100 + 1).alias("solicit_response_id"),
        F.lit(None).cast("string").alias("bundled_contract_cd"), F.lit(None).cast("string").alias("consolidated_contract_cd"),
        F.lit(None).cast("string").alias("perf_based_svc_contract_cd"),
        _aac(F.col("o_custkey") % 25).alias("lead_svc_activity_address_cd"),
        (F.col("o_orderkey") * 10 + 1).alias("latest_award_mod_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    @_once
    def base():
        return T("orders").select(F.col("o_orderkey").alias("award_id"), "o_orderdate")
    s["aasbs_award_mod"] = lambda: base().select(
        (F.col("award_id") * 10).alias("id"), "award_id", F.lit("0").alias("mod_num"),
        F.lit(None).cast("string").alias("award_piid_ext"),
        F.lit(None).cast("string").alias("m1p_sf30_mod_type_cd"),
        F.lit(None).cast("string").alias("m1p_award_mod_fpds_reason_cd"), F.lit("DRAFT").alias("fpds_car_status_cd"),
        F.col("o_orderdate").alias("m1p_mod_start_dt"), F.col("o_orderdate").alias("co_signature_dt"),
        F.lit(None).cast("boolean").alias("is_deleted")).unionByName(base().select(
        (F.col("award_id") * 10 + 1).alias("id"), "award_id", F.lit("P01").alias("mod_num"),
        F.when(F.col("award_id") % 6 != 0, F.lit("P0001")).alias("award_piid_ext"),
        F.when(F.col("award_id") % 7 == 0, "TERMINATE").when(F.col("award_id") % 7 == 1, "ADMIN").otherwise("FUNDING")
         .alias("m1p_sf30_mod_type_cd"),
        F.when(F.col("award_id") % 11 == 0, "d").otherwise("A").alias("m1p_award_mod_fpds_reason_cd"),
        F.lit("FINAL").alias("fpds_car_status_cd"),
        (F.col("o_orderdate") + F.expr("interval 30 days")).alias("m1p_mod_start_dt"),
        (F.col("o_orderdate") + F.expr("interval 31 days")).alias("co_signature_dt"),
        F.lit(None).cast("boolean").alias("is_deleted")))
    @_once
    def pairs():
        return T("orders").select(F.col("o_orderkey").alias("award_id"), F.col("o_custkey").alias("ia_id"))
    s["aasbs_award_ia"] = lambda: pairs().unionByName(
        T("orders").filter(F.col("o_orderkey") % 5 == 0).select(F.col("o_orderkey").alias("award_id"),
                                                           (F.col("o_custkey") + 1).alias("ia_id"))) \
        .withColumn("is_deleted", F.lit(None).cast("boolean"))
    s["aasbs_funding"] = lambda: T("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("ia_id"),
        F.concat(F.lit("FS"), (F.col("c_custkey") % 3).cast("string")).alias("fund_status_cd"),
        F.upper(F.substring("c_mktsegment", 1, 2)).alias("fund_category_cd"),
        F.when(F.col("c_custkey") % 2 == 0, "DIRECT").otherwise("REIMB").alias("billing_type_cd"),
        (F.col("c_custkey") * 10).alias("latest_funding_amendment_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_funding_amendment"] = lambda: T("customer").select(
        (F.col("c_custkey") * 10).alias("id"), F.col("c_custkey").alias("funding_id"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    @_once
    def nsupp():
        return T("supplier").select(F.max("s_suppkey") + 1).scalar()
    s["aasbs_funding_amendment_loa"] = lambda: T("orders").select(
        (F.col("o_custkey") * 10).alias("funding_amendment_id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("loa_change_amt"),
        (F.col("o_orderkey") % nsupp()).alias("loa_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    for code, lk in [("fund_status_cd", "aasbs_lu_fund_status"), ("fund_category_cd", "aasbs_lu_fund_category"),
                     ("billing_type_cd", "aasbs_lu_billing_type")]:
        s[lk] = lambda code=code: _code_table(s["aasbs_funding"], code)
    li_id = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    # the order gives each line its IA (the order's customer); every 50th order's lines share a
    # service charge; third lines carry a travel plan
    s["aasbs_line_item"] = lambda: lines_of_orders().select(
        F.col("o_custkey").alias("parent_ia_id"), (F.col("l_orderkey") % 50).alias("service_charge_id"),
        F.when(F.col("l_linenumber") == 1, li_id).alias("li_sc_labor_id"),
        F.when(F.col("l_linenumber") == 2, li_id).alias("li_sc_fixed_fee_id"),
        F.when(F.col("l_linenumber") == 3, li_id).alias("li_sc_travel_id"),
        F.when(F.col("l_linenumber") == 4, li_id).alias("li_award_fee_id"),
        li_id.alias("id"), F.concat(_pad("l_linenumber", 4), F.lit("AA")).alias("line_item_num"),
        (F.col("l_orderkey") * 10 + 1).alias("parent_award_mod_id"), F.year("_start").alias("line_item_fy"),
        F.col("_part").alias("li_deliverable_id"), F.col("_status").alias("line_item_type_cd"),
        F.col("_start").alias("line_item_start_dt"), F.col("_end").alias("line_item_end_dt"),
        F.col("_total").cast("decimal(15,2)").alias("line_item_total_amt"),
        F.concat(F.lit("T"), li_id.cast("string")).alias("li_tracking_num"), F.lit(None).cast("boolean").alias("is_deleted"))
    # CLIN subtypes (psc): labour on first lines, fixed fee on second, travel on third, award fee on
    # fourth; service charges are the order key classes of the lines
    ok = F.col("l_orderkey")
    rate = F.when(ok % 3 == 0, "ACT").when(ok % 3 == 1, "EST").otherwise("FIXED")
    s["aasbs_li_sc_labor"] = lambda: lines().filter(F.col("l_linenumber") == 1).select(
        li_id.alias("id"), dmul("_total", F.lit(0.6)).alias("planned_amt"), rate.alias("cost_rate_type_cd"),
        F.concat(F.lit("PH"), (ok % 4).cast("string")).alias("proc_phase_cd"),
        F.concat(F.lit("PRJ"), (ok % 100).cast("string")).alias("project_num"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_li_sc_fixed_fee"] = lambda: lines().filter(F.col("l_linenumber") == 2).select(
        li_id.alias("id"), F.when(li_id % 5 != 0, dmul("_total", F.lit(0.3))).alias("planned_amt"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_li_sc_travel"] = lambda: lines().filter(F.col("l_linenumber") == 3).select(
        li_id.alias("id"), dmul("_total", F.lit(0.1)).alias("planned_amt"), (li_id % 13 == 0).alias("is_deleted"))
    s["aasbs_li_award_fee"] = lambda: lines().filter(F.col("l_linenumber") == 4).select(
        li_id.alias("id"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_lu_cost_rate_type"] = lambda: _code_table(s["aasbs_li_sc_labor"].filter(F.col("cost_rate_type_cd") != "FIXED"),
                                               "cost_rate_type_cd")
    s["aasbs_lu_proc_phase"] = lambda: _code_table(s["aasbs_li_sc_labor"].filter(F.col("proc_phase_cd") != "PH3"),
                                           "proc_phase_cd")
    sc_id = F.col("o_orderkey") % 50
    s["aasbs_service_charge"] = lambda: T("orders").select(sc_id.alias("id")).distinct().select(
        "id", F.concat(F.lit("ACT"), F.col("id").cast("string")).alias("act_number"),
        F.when(F.col("id") % 4 == 0, "Y").when(F.col("id") % 4 == 1, "n").alias("is_credit_yn"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_line_item_accepted"] = lambda: lines().select(
        li_id.alias("id"), li_id.alias("line_item_id"), F.year("_end").alias("budget_fy"),
        F.when(F.col("l_linenumber") % 2 == 0, "Y").otherwise("N").alias("exercise_this_yn"),
        (F.col("l_orderkey") * 10 + 1).alias("award_mod_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_li_deliverable"] = lambda: T("part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("psc_cd"), F.col("p_type").alias("contract_type_cd"),
        F.lit(None).cast("string").alias("severability_type_cd"), F.lit(None).cast("string").alias("unit_of_measure_cd"),
        F.lit(None).cast("int").alias("bona_fide_need_fy"), F.lit(None).cast("boolean").alias("is_deleted"))
    # stored as the other code tables are, or all lines would be dealt by its few codes
    s["aasbs_lu_line_item_type"] = lambda: stored(T("lineitem").select(F.col("l_linestatus").alias("cd")).distinct().filter(
        F.col("cd") == "F").select("cd", F.lit("Fulfilled").alias("description"), F.lit(None).cast("boolean").alias("is_deleted")))
    @_once
    def led():
        return ledger(t).join(T("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    lia = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    s["aasbs_loa_ledger"] = lambda: led().select(
        lia.alias("id"), lia.alias("line_item_accepted_id"), F.col("l_suppkey").alias("loa_id"),
        F.col("o_custkey").alias("funding_id"), F.col("o_custkey").alias("ia_id"), F.col("l_shipdate").alias("created_dt"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("line_item_obligated_amt"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("line_item_committed_amt"),
        dmul("l_extendedprice", F.lit(1) - F.col("l_discount")).alias("line_item_certified_amt"),
        dmul("l_extendedprice", "l_tax").alias("service_charge_amt"),
        F.col("l_linestatus").alias("transaction_type_cd"), "is_deleted")
    s["aasbs_invoice_item"] = lambda: T("lineitem").filter(F.col("l_returnflag") == "A").select(
        lia.alias("id"), lia.alias("cost_line_item_accepted_id"), F.col("l_orderkey").alias("invoice_id"),
        dmul("l_extendedprice", F.lit(1) - F.col("l_discount")).alias("invoice_item_amt"),
        # service dates: shipped, then three days per line number
        F.col("l_shipdate").alias("invoice_item_begin_dt"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_linenumber") * 3).cast("int")).cast("timestamp_ntz")
         .alias("invoice_item_end_dt"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    # service charge schedules (psc): two periods per line from its order date, days 0-60 and 61-180;
    # the second has no start on every ninth order, no amount on every seventh line, and some are deleted
    day = F.to_date("o_orderdate")
    @_once
    def first_period():
        return lines_of_orders().select(
        (lia * 10 + 1).alias("id"), lia.alias("line_item_id"), day.cast("timestamp_ntz").alias("service_start_dt"),
        F.date_add(day, 60).cast("timestamp_ntz").alias("service_end_dt"),
        dmul("_total", F.lit(0.5)).alias("scheduled_amt"),
        F.col("_status").alias("sc_schedule_status_cd"), F.lit(None).cast("boolean").alias("is_deleted"))
    @_once
    def second_period():
        return lines_of_orders().select(
        (lia * 10 + 2).alias("id"), lia.alias("line_item_id"),
        F.when(F.col("l_orderkey") % 9 != 0, F.date_add(day, 61).cast("timestamp_ntz")).alias("service_start_dt"),
        F.date_add(day, 180).cast("timestamp_ntz").alias("service_end_dt"),
        F.when(lia % 7 != 0, dmul("_total", F.lit(0.25))).alias("scheduled_amt"),
        F.col("_status").alias("sc_schedule_status_cd"), (lia % 41 == 0).alias("is_deleted"))
    s["aasbs_service_charge_schedule"] = lambda: first_period().unionByName(second_period())
    s["aasbs_acceptance_item"] = lambda: T("lineitem").filter(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("acceptance_id"), lia.alias("line_item_accepted_id"),
        dmul("l_extendedprice", F.lit(0.9)).alias("item_gsa_approved_amt"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_bill_item"] = lambda: T("lineitem").filter(F.col("l_returnflag") == "N").select(
        lia.alias("line_item_accepted_id"), dmul("l_extendedprice", "l_tax").alias("bill_item_amt"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    # IA amendments (IA tracker): one per order of the IA's customer
    prio = F.col("o_orderpriority")
    action = (F.when(prio == "1-URGENT", "COST_INCREASE").when(prio == "2-HIGH", "EXTEND_POP")
               .when(prio == "3-MEDIUM", "SCOPE_CHANGE").otherwise("ADMIN"))
    status = F.col("o_orderstatus")
    s["aasbs_ia_amendment"] = lambda: T("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("ia_id"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("X1")).otherwise(_pad(F.col("o_orderkey") % 100, 2)).alias("piid_ext"),
        action.alias("ia_amend_action_cd"), F.col("o_totalprice").cast("decimal(15,2)").alias("direct_cost_est_amt"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("decimal(15,2)"))
         .otherwise(dmul("o_totalprice", F.lit(0.05))).alias("charges_est_amt"),
        F.col("o_orderdate").alias("start_dt"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400).cast("int")).cast("timestamp_ntz"))
         .alias("end_dt"),
        F.when(status.isin("F", "O"), F.date_add(F.to_date("o_orderdate"), 5).cast("timestamp_ntz"))
         .alias("service_agency_signed_dt"),
        F.when(status == "F", F.date_add(F.to_date("o_orderdate"), 10).cast("timestamp_ntz"))
         .alias("request_agency_signed_dt"),
        F.col("o_orderdate").alias("created_dt"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_lu_ia_amend_action"] = lambda: _code_table(s["aasbs_ia_amendment"], "ia_amend_action_cd")
    # IA reviews: one per fulfilled order, reviewed three days after it by user (customer mod 37) * 5;
    # users are the event users (so some reviewers have no user record at every scale)
    s["aasbs_ia_review"] = lambda: T("orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("ia_id"),
        F.when(F.col("o_orderkey") % 17 != 0, (F.col("o_custkey") % 37) * 5).alias("service_agency_reviewer_id"),
        F.date_add(F.to_date("o_orderdate"), 3).cast("timestamp_ntz").alias("review_dt"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("H"), F.col("o_orderkey").cast("string")))
         .alias("attach_hash_id"),
        (F.col("o_orderkey") % 101 == 0).alias("is_deleted"))
    uid = F.col("user_id")
    s["assist_users"] = lambda: T("events").select("user_id").distinct().select(
        uid.alias("id"), F.when(uid % 11 != 0, F.lit("User")).alias("first_name"),
        F.when(uid % 2 == 0, F.lit("Q")).otherwise(F.lit(" ")).alias("middle_initial"),
        F.concat(F.lit("N"), uid.cast("string")).alias("last_name"),
        F.when(uid % 5 == 0, "INACTIVE").otherwise("ACTIVE").alias("reg_status"),
        F.when(uid % 10 == 3, F.lit("2001-01-01").cast("timestamp_ntz")).alias("inactive_date"),
        F.when(uid % 7 != 0, F.concat(F.lit("user"), uid.cast("string"), F.lit("@agency.gov"))).alias("email"),
        F.concat(F.lit("555-"), _pad(uid, 4)).alias("phone"),
        F.when(uid % 3 == 0, F.lit(" 12 ")).when(uid % 3 == 1, F.lit("")).alias("phone_ext"),
        F.concat(F.lit("OK"), uid.cast("string")).alias("okta_user_id"),
        F.when(uid % 4 != 0, F.date_add(F.to_date(F.lit("2020-01-01")), uid.cast("int")).cast("timestamp_ntz"))
         .alias("activation_date"),
        F.date_add(F.to_date(F.lit("2019-01-01")), uid.cast("int")).cast("timestamp_ntz").alias("creation_date"),
        F.when(uid % 13 == 0, F.lit(" y ")).when(uid % 13 == 1, F.lit("N")).alias("delete_flag"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    # lifecycle (cat): events → chronology entries, conversations → collaborations and their comments
    et = F.col("event_type")
    s["aasbs_chronology"] = lambda: T("events").select(
        F.col("event_id").alias("id"),
        F.when(et == "purchase", "AWARD_MOD").when(et == "signup", "IA").when(et == "click", "FOO_IA")
         .when(et == "view", "ACQUISITION").otherwise("MEDIA").alias("source_table_name_cd"),
        F.col("user_id").alias("source_record_id"), (F.col("user_id") * 10 + 1).alias("event_record_id"),
        F.upper(et).alias("event_type_cd"), F.col("ts").alias("created_dt"),
        F.col("user_id").alias("created_by_user_id"), F.col("props").alias("entry_description"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    # the collaboration event type exists whenever there are collaborations; distinct collapses it to one row
    @_once
    def codes():
        return T("events").select(F.upper("event_type").alias("cd")).unionByName(
        T("conversations").select(F.lit("COLLABORATION").alias("cd")))
    s["aasbs_lu_event_type"] = lambda: codes().distinct().select(
        "cd", F.concat(F.lit("Code "), F.col("cd")).alias("description"), F.lit(None).cast("boolean").alias("is_deleted"))
    st = F.col("o_orderstatus")
    s["aasbs_acquisition"] = lambda: T("orders").select(
        F.col("o_orderkey").alias("id"), _aac(F.col("o_custkey") % 25).alias("activity_address_cd"),
        F.when(st == "F", "CLOSED").when(st == "O", "OPEN").otherwise("AWARDED").alias("acquisition_status_cd"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "NEW").otherwise("FOLLOW_ON")
         .alias("acquisition_type_cd"),
        F.concat(F.lit("PT"), (F.col("o_orderkey") % 3).cast("string")).alias("performance_type_cd"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_lu_acquisition_status"] = lambda: _code_table(
        s["aasbs_acquisition"].filter(F.col("acquisition_status_cd") != "AWARDED"), "acquisition_status_cd")
    s["aasbs_lu_acquisition_type"] = lambda: _code_table(s["aasbs_acquisition"], "acquisition_type_cd")
    # acquisition plans: one per line of the order (the acquisition), seventh lines deleted
    pn = F.col("l_linenumber")
    s["aasbs_acquisition_plan"] = lambda: lines().select(
        F.col("l_orderkey").alias("acquisition_id"), F.col("_end").alias("created_dt"),
        F.concat(F.lit("CT"), pn.cast("string")).alias("contract_type_cd"),
        F.when(pn % 3 == 0, "FULL").when(pn % 3 == 1, "SOLE").otherwise("LIMITED").alias("competition_type_cd"),
        F.when(F.col("_part") % 2 == 0, "COMM").otherwise("NONCOMM").alias("commercial_type_cd"),
        F.when(F.col("_status") == "F", "STD").otherwise("FAST").alias("processing_speed_cd"),
        F.when(pn == 1, F.lit("EXP")).alias("expedited_type_cd"),
        F.when(F.col("_part") % 5 == 0, "Y").otherwise("N").alias("ap_emergency_acq_cd"),
        F.concat(F.lit("COR"), (F.col("_part") % 3).cast("string")).alias("ap_cor_delegation_cd"),
        F.when(F.col("_part") % 7 == 0, F.lit("HIGH")).alias("ap_supply_chain_risk_cd"),
        F.concat(F.lit("S"), (pn % 4).cast("string")).alias("ap_surveillance_spec_cd"),
        F.when(F.col("l_orderkey") % 9 == 0, F.lit("IC")).alias("ap_intel_community_cd"),
        F.lit(None).cast("string").alias("idv_referenced_class_cd"),
        F.lit(None).cast("string").alias("idv_who_can_use_cd"), (pn == 7).alias("is_deleted"))
    # solicitations (alt): one per even order key; amendments and responses are its lines
    s["aasbs_solicit"] = lambda: T("orders").filter(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("acquisition_id"),
        (F.col("o_orderkey") % 6).cast("int").alias("at_award_bid_cnt"),
        F.concat(F.lit("SOL_"), F.col("o_orderstatus")).alias("sol_status_cd"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("Solicitation "), F.col("o_orderkey").cast("string")))
         .alias("solicit_description"),
        _aac(F.col("o_custkey") % 26).alias("sol_response_aac_visibility_cd"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_solicit_amendment"] = lambda: lines().select(
        li_id.alias("id"), F.col("l_orderkey").alias("solicit_id"), F.col("_start").alias("created_dt"),
        F.when(F.col("l_linenumber") != 2, F.col("_end")).alias("close_dt"),
        F.when(F.col("l_linenumber") % 3 == 0, "OPEN").when(F.col("l_linenumber") % 3 == 1, "LIMITED")
         .otherwise("UNKNOWN").alias("sol_posting_type_cd"),
        (F.col("l_linenumber") == 6).alias("is_deleted"))
    s["aasbs_lu_sol_posting_type"] = lambda: _code_table(
        s["aasbs_solicit_amendment"].filter(F.col("sol_posting_type_cd") != "UNKNOWN"), "sol_posting_type_cd")
    s["aasbs_solicit_response"] = lambda: lines().select(
        li_id.alias("id"), F.col("l_orderkey").alias("solicit_id"),
        F.when((F.col("_status") == "F") & (F.col("l_linenumber") == 1), "Y").otherwise("N").alias("winning_response_yn"),
        F.when(F.col("l_linenumber") != 5, li_id).alias("solicit_company_id"),
        _pad(F.col("_part") % 1000, 9).alias("response_company_duns"), F.col("_end").alias("latest_response_update_dt"),
        F.when(F.col("l_linenumber") == 3, F.lit("y")).alias("no_response_yn"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_solicit_company"] = lambda: lines().filter(F.col("l_linenumber") != 5).select(
        li_id.alias("id"), (F.col("_part") % 120).alias("ipartner_id"), F.lit(None).cast("boolean").alias("is_deleted"))
    # contractors (alt): the company on each award's latest modification; every fifth is ingested twice
    # (the later ingestion on the base modification wins); partners are the suppliers, every tenth with
    # an older duplicate row
    pr = F.col("o_orderpriority")
    btype = (F.when(pr == "1-URGENT", "SMALL_BUSINESS").when(pr == "2-HIGH", "WOMEN_OWNED_SMALL_BUSINESS")
              .when(pr == "3-MEDIUM", "HUBZONE").when(pr == "4-NOT SPECIFIED", "SERVICE_DISABLED_VETERAN_OWNED"))

    def _company(mod_offset, uei_suffix, days):
        return T("orders").select(
            F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * 10 + mod_offset).alias("award_mod_id"),
            F.concat(F.lit("UEI"), F.col("o_custkey").cast("string"), F.lit(uei_suffix)).alias("company_uei"),
            _pad("o_custkey", 9).alias("company_duns"),
            F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("solicit_company_name"),
            btype.alias("business_type_cd"), (F.col("o_custkey") % 100).alias("ipartner_id"),
            F.date_add(F.to_date("o_orderdate"), days).cast("timestamp_ntz").alias("_ingested_at"),
            F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_award_mod_company"] = lambda: _company(1, "", 0).unionByName(
        _company(0, "B", 1).filter(F.col("id") % 5 == 0))

    def _partner(cage_prefix, days):
        return T("supplier").select(
            F.col("s_suppkey").alias("ipartner_id"),
            F.concat(F.lit(cage_prefix), _pad("s_suppkey", 4)).alias("ipartner_cage_code"),
            F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("ipartner_parent_uei"),
            F.col("s_name").alias("ipartner_parent_name"),
            F.concat(F.lit("City"), F.col("s_nationkey").cast("string")).alias("city"),
            F.concat(F.lit("S"), (F.col("s_suppkey") % 50).cast("string")).alias("state"), F.lit("US").alias("country"),
            _pad("s_suppkey", 5).alias("zip"),
            F.date_add(F.to_date(F.lit("2000-01-01")), (F.col("s_suppkey") - days).cast("int")).cast("timestamp_ntz")
             .alias("creation_date"),
            F.concat(F.lit("Partner "), F.col("s_name")).alias("ipartner_company_name"),
            F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("ipartner_inc_status"),
            _pad("s_suppkey", 9).alias("ipartner_ftin"),
            # the older duplicate rows are retired with the character delete flag
            F.lit("Y" if days else None).cast("string").alias("delete_flag"),
            F.lit(None).cast("boolean").alias("is_deleted"))
    s["table_master_industry_partners"] = lambda: _partner("C", 0).unionByName(
        _partner("OLD", 365).filter(F.col("ipartner_id") % 10 == 0))
    # closeouts (alt): one per fulfilled order; checklist items are its lines
    s["aasbs_acquisition_closeout"] = lambda: T("orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("acquisition_id"),
        F.date_add(F.to_date("o_orderdate"), 100).cast("timestamp_ntz").alias("co_checked_certified_dt"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_add(F.to_date("o_orderdate"), 120).cast("timestamp_ntz"))
         .alias("fma_certified_dt"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("y")).when(F.col("o_orderkey") % 3 == 1, F.lit("N"))
         .alias("contract_funds_reconciled_yn"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(0).cast("decimal(15,2)"))
         .otherwise(F.col("o_totalprice").cast("decimal(15,2)")).alias("ytd_total_vendor_invoiced_amt"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("P1")).alias("prohibition_cd"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_acquisition_closeout_checklist"] = lambda: lines().select(
        F.col("l_orderkey").alias("acquisition_closeout_id"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string")).when(F.col("_status") == "F", F.lit("yes"))
         .otherwise(F.lit("no")).alias("checklist_value_cd"),
        (F.col("l_linenumber") == 5).alias("is_deleted"))
    # invoices: one per order; accrual expenses: two month ends per line (the later one deleted on sixth
    # lines), plus an undated row on fourth lines
    s["aasbs_invoice"] = lambda: T("orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "ACCEPTED").when(F.col("o_orderstatus") == "O", "SUBMITTED")
         .otherwise(F.when(F.col("o_orderkey") % 2 == 0, F.lit("REJECTED"))).alias("invoice_status_cd"),
        F.lit(None).cast("boolean").alias("is_deleted"))

    def _accrual(k, month, rate, line=None):
        src = lines() if line is None else lines().filter(F.col("l_linenumber") == line)
        return src.select(
            (li_id * 10 + k).alias("id"), li_id.alias("line_item_accepted_id"), month.alias("accrual_month_end_dt"),
            dmul("_total", F.lit(rate)).alias("udo_amt"),
            ((F.col("l_linenumber") == 6) & F.lit(k == 1)).alias("is_deleted"))
    s["aasbs_accrual_expense"] = lambda: _accrual(1, F.last_day("_end"), 0.2).unionByName(
        _accrual(2, F.last_day(F.add_months(F.to_date("_end"), -1)), 0.1)).unionByName(
        _accrual(3, F.lit(None).cast("date"), 9.0, line=4))
    # product and service codes (fre): one per part brand; the brand's last digit picks the type
    last = F.substring("p_brand", -1, 1)
    s["aasbs_lus_psc"] = lambda: T("part").groupBy("p_brand").agg(
        F.min("p_type").alias("_t_min"), F.max("p_type").alias("_t_max"), F.max("p_size").alias("_size")).select(
        F.col("p_brand").alias("psc_code"),
        F.when(last == "1", F.lit("  ")).otherwise(F.concat(F.lit("Full "), F.col("p_brand"))).alias("psc_full_name"),
        F.concat(F.lit(" "), F.col("_t_min")).alias("psc_name"),
        F.when(last.isin("1", "3", "5"), "SERVICE").when(last == "2", "R&D").otherwise("PRODUCT").alias("psc_type"),
        F.concat(F.lit("L1 "), F.col("_t_max")).alias("level_1_category_name"),
        F.concat(F.lit("L2 size "), F.col("_size").cast("string")).alias("level_2_category_name"),
        F.substring("p_brand", 1, 7).alias("parent_psc_code"), F.lit(None).cast("boolean").alias("is_deleted"))
    # amount snapshots (two per latest modification), transmittals and PO summaries (fre)
    def _snap(rate):
        return T("orders").select(
            (F.col("o_orderkey") * 10 + 1).alias("award_mod_id"),
            dmul("o_totalprice", F.lit(rate)).alias("base_exc_opt_amt"),
            dmul("o_totalprice", F.lit(rate + 0.2)).alias("base_all_opt_amt"),
            dmul("o_totalprice", F.lit(rate / 2)).alias("cum_funded_amt"),
            dmul("o_totalprice", F.lit(rate + 0.3)).alias("cost_to_client_total_amt"),
            F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_snap_award_mod_amts"] = lambda: _snap(0.5).unionByName(_snap(0.6))
    s["aasbs_transmit_transmittal"] = lambda: T("orders").select(
        F.col("o_orderkey").alias("id"), F.date_add(F.to_date("o_orderdate"), 2).cast("timestamp_ntz").alias("sent_dt"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_transmit_po_summary"] = lambda: s["aasbs_award"].select(
        F.col("id").alias("transmittal_id"), F.when(F.col("id") % 2 == 0, F.col("award_piid")).alias("contract_number"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    # postings of solicitation amendments (smi): direct postings on first lines of every third order
    # (every ninth with an external source), connect postings on second lines of every fourth order
    s["aasbs_solicit_posting_direct"] = lambda: lines().filter(
        (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 3 == 0)).select(
        li_id.alias("id"), li_id.alias("solicit_amendment_id"),
        F.concat(F.lit("R"), (F.col("l_orderkey") % 5).cast("string")).alias("reason_for_direct_cd"),
        F.when(F.col("l_orderkey") % 9 == 0, F.concat(F.lit("EXT"), F.col("l_orderkey").cast("string")))
         .alias("external_source_ref"),
        F.col("_start").alias("open_dt"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_solicit_posting_connect"] = lambda: lines().filter(
        (F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 4 == 0)).select(
        li_id.alias("id"), li_id.alias("solicit_amendment_id"), (F.col("l_orderkey") % 50).alias("pm_responsible_user_id"),
        F.col("_end").alias("open_dt"), F.lit(None).cast("boolean").alias("is_deleted"))
    # receiving reports (tpp): one per fulfilled order, its lineitem rows as detail lines
    s["aasbs_transmit_rr_summary"] = lambda: T("orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("PG"), F.col("o_orderkey").cast("string")).alias("pegasys_invoice_number"),
        F.date_add(F.to_date("o_orderdate"), 20).cast("timestamp_ntz").alias("accepted_dt"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("max_approved_amt"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("number_of_detail_lines"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_transmit_rr_detail"] = lambda: T("lineitem").select(
        F.col("l_orderkey").alias("rr_summary_id"),
        dmul("l_extendedprice", F.lit(1) - F.col("l_discount")).alias("total_mdl_amount"),
        (F.col("l_returnflag") == "R").alias("is_deleted"))
    # transmittal types (tpp): one per order priority; spec versions are the years the type was used
    ttype = F.upper(F.regexp_replace(F.substring("o_orderpriority", 3, 20), " ", "_"))
    s["aasbs_transmit_lu_transmittal_type"] = lambda: T("orders").select(ttype.alias("cd")).distinct().select(
        "cd", F.concat(F.lit("Type "), F.col("cd")).alias("description"),
        F.when(F.col("cd") != "LOW", F.concat(F.lit("FF_"), F.substring("cd", 1, 3))).alias("flatfile_cd"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_transmit_transmittal_spec_version"] = lambda: T("orders").select(
        ttype.alias("transmittal_type_cd"), F.year("o_orderdate").cast("string").alias("specification_version"),
        (F.col("o_orderstatus") == "P").alias("is_deleted"))
    s["aasbs_lu_competition_type"] = lambda: _code_table(
        s["aasbs_acquisition_plan"].filter(F.col("competition_type_cd") != "LIMITED"), "competition_type_cd")
    k = F.col("conv_id") % 4
    @_once
    def first():
        return T("conversations").filter(F.col("turn") == 0)
    s["aasbs_central_collab"] = lambda: first().select(
        F.col("conv_id").alias("id"),
        F.when(k == 0, "IA").when(k == 1, "AWARD_MOD").when(k == 2, "X_IA").otherwise("MEDIA").alias("table_name_cd"),
        F.when(k == 1, F.col("conv_id") * 10 + 1).otherwise(F.col("conv_id")).alias("table_record_id"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("conv_id") % 365).cast("int")).cast("timestamp_ntz")
         .alias("created_dt"),
        F.col("conv_id").alias("created_by_user_id"), F.col("role").alias("subject"), F.lit("REVIEW").alias("collab_type_cd"),
        F.when(F.col("conv_id") % 2 == 0, "OPEN").otherwise("CLOSED").alias("collab_status_cd"),
        F.lit(None).cast("timestamp_ntz").alias("due_dt"), F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_central_collab_acq"] = lambda: T("conversations").filter(F.col("turn").isin(1, 2)).select(
        F.col("conv_id").alias("central_collab_id"), (F.col("conv_id") * 3 + F.col("turn") - 1).alias("acquisition_id"),
        F.lit(None).cast("boolean").alias("is_deleted"))
    s["aasbs_central_comment"] = lambda: T("conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("CENTRAL_COLLAB").alias("table_name_cd"),
        F.col("conv_id").alias("table_record_id"), F.col("role").alias("comment_type_cd"),
        F.col("text").alias("comment_text"), F.lit(None).cast("boolean").alias("is_deleted"))
    return s
