"""Lifecycle event fact: polymorphic references, escaped IA pattern (D-28), constant lookup."""

import datetime as dt

from gildhall.plans.domain.cat_facts import fact_lifecycle_event

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_lifecycle_event(spark):
    CH = ("id bigint, source_table_name_cd string, source_record_id bigint, event_record_id bigint, event_type_cd string, "
          "created_dt timestamp_ntz, created_by_user_id bigint, entry_description string, is_deleted boolean")
    s = {"aasbs_chronology": _g(spark, [(1, "AWARD_MOD", 900, 500, "AWARD_CREATED", T(2024, 1, 1), 7, "a", None),
                                        (2, "FOO_IA", 10, None, "X", T(2024, 1, 2), 7, "b", None),
                                        (3, "MEDIA", 10, None, "X", T(2024, 1, 3), 7, "c", None),
                                        (4, "ACQUISITION", 100, None, None, None, 8, "d", None)], CH),
         "aasbs_award_mod": _g(spark, [(500, 1000, None)], "id bigint, award_id bigint, is_deleted boolean"),
         "aasbs_acquisition": _g(spark, [(100, "A1", None)], "id bigint, activity_address_cd string, is_deleted boolean"),
         "aasbs_central_collab": _g(spark, [(50, "IA", 10, T(2024, 2, 1), 9, "subj", "REVIEW", "OPEN", None, None)],
                                    "id bigint, table_name_cd string, table_record_id bigint, created_dt timestamp_ntz, "
                                    "created_by_user_id bigint, subject string, collab_type_cd string, "
                                    "collab_status_cd string, due_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_central_collab_acq": _g(spark, [(50, 100, None), (50, 101, None)],
                                        "central_collab_id bigint, acquisition_id bigint, is_deleted boolean"),
         "aasbs_central_comment": _g(spark, [(1, "CENTRAL_COLLAB", 50, "NOTE", "old", None),
                                             (2, "CENTRAL_COLLAB", 50, "NOTE", "new", None)],
                                     "id bigint, table_name_cd string, table_record_id bigint, comment_type_cd string, "
                                     "comment_text string, is_deleted boolean")}
    g = {"wpr.dim_entity_type": _g(spark, [("AWARD", 1), ("IA", 2), ("ACQUISITION", 5), ("COLLAB", 6)],
                                   "entity_type_cd string, entity_type_sk bigint"),
         "common.dim_award": _g(spark, [(1000, 11, True)], "award_id bigint, award_sk bigint, is_current_flag boolean"),
         "common.dim_ia": _g(spark, [(10, 21, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
         "common.dim_agency": _g(spark, [("A1", 31, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean"),
         "cat.dim_event_type": _g(spark, [("AWARD_CREATED", 41), ("collaboration", 42)], "event_type_cd string, event_type_sk bigint")}
    out = fact_lifecycle_event(s, g, "d")
    rows = {(r.source_chronology_id, r.source_collab_id): r for r in out.collect()}
    assert len(rows) == 5
    a = rows[(1, None)]
    assert (a.award_sk, a.ia_sk, a.entity_type_sk, a.event_type_sk, a.event_date_sk) == (11, -1, 1, 41, 20240101)
    assert (rows[(2, None)].ia_sk, rows[(2, None)].entity_type_sk) == (21, 2)
    assert (rows[(3, None)].ia_sk, rows[(3, None)].entity_type_sk) == (-1, 6)       # MEDIA is not an IA (D-28)
    assert rows[(4, None)].agency_sk == 31
    col = rows[(None, 50)]
    assert (col.event_type_sk, col.ia_sk, col.agency_sk, col.comment_text, col.entity_type_sk) == (42, 21, 31, "new", 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
