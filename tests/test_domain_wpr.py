"""wpr dimensions: delete flags, names, phone, org paths."""

import datetime as dt

from gildhall.plans.domain.wpr import dim_client, dim_industry_partner, dim_org_hierarchy, dim_user

USERS = ("activation_date timestamp_ntz, creation_date timestamp_ntz, delete_flag string, email string, "
         "first_name string, id bigint, inactive_date timestamp_ntz, is_deleted boolean, last_name string, "
         "middle_initial string, okta_user_id string, phone string, phone_ext string, reg_status string")


def test_user_client_partner(spark):
    t = dt.datetime
    users = spark.createDataFrame([
        (t(2020, 1, 1), t(2019, 1, 1), None, "a@x", "Ann", 1, None, None, "Lee", "Q", "ok1", "555", "12", "ACTIVE"),
        (None, t(2019, 5, 1), "N", "b@x", "Bo", 2, t(2021, 1, 1), False, "Wu", None, None, "556", "", "ACTIVE"),
        (None, None, "y", "c@x", "Cy", 3, None, None, "Do", None, None, None, None, "ACTIVE")], USERS)
    rows = {r.user_id: r for r in dim_user({"assist_users": users}, {}, "2022-01-01").collect()}
    assert set(rows) == {"1", "2"}                                  # delete_flag 'y' excluded
    assert (rows["1"].full_name, rows["1"].phone, rows["1"].is_active_flag, rows["1"].eff_start_dt) == \
        ("Ann Q Lee", "555 x12", True, t(2020, 1, 1))
    assert (rows["2"].full_name, rows["2"].phone, rows["2"].is_active_flag, rows["2"].eff_start_dt) == \
        ("Bo Wu", "556", False, t(2019, 5, 1))
    clients = spark.createDataFrame([("C1", 7, "Client", None, None, "e", "g", None, "1", None)],
                                    "client_code string, client_id bigint, client_name string, creation_date "
                                    "timestamp_ntz, delete_flag string, email string, gsa_contact string, "
                                    "is_deleted boolean, phone string, phone_ext string")
    c = dim_client({"table_master_clients": clients}, {}, "2022-01-01").first()
    assert (c.client_sk, c.contact_name, c.is_current_flag, c.agency_sk) == (1, "g", True, None)
    partners = spark.createDataFrame([("X", "US", "Acme", "123", 5, "A", None, "VA", None),
                                      ("Y", "US", "Gone", "9", 6, "A", None, "MD", "Y")],
                                     "city string, country string, ipartner_company_name string, ipartner_ftin string, "
                                     "ipartner_id bigint, ipartner_inc_status string, is_deleted boolean, state string, "
                                     "delete_flag string")
    ps = dim_industry_partner({"table_master_industry_partners": partners}, {}, "2022-01-01").collect()
    assert len(ps) == 1
    p = ps[0]
    assert (p.partner_id, p.company_name, p.address_state_cd) == (5, "Acme", "VA")


def test_org_hierarchy_paths(spark):
    orgs = spark.createDataFrame([(1, "Root", "R", None, 1), (2, "Div", None, None, 2), (3, "Branch", "B", None, 3),
                                  (4, "Gone", None, True, 2)],
                                 "emp_org_id bigint, emp_org_name string, emp_org_short_name string, "
                                 "is_deleted boolean, tier_id int")
    xref = spark.createDataFrame([(2, 1, None), (3, 2, None)], "emp_org_child_id bigint, emp_org_id bigint, is_deleted boolean")
    rows = {r.org_id: r for r in dim_org_hierarchy({"assist_lu_emp_orgs": orgs, "assist_lu_emp_org_xref": xref}, {},
                                                   "d").collect()}
    assert set(rows) == {1, 2, 3}
    assert (rows[3].org_path, rows[3].parent_org_id, rows[3].org_code, rows[2].org_code) == \
        ("Root / Div / Branch", 2, "B", "Div")
