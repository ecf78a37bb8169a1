"""Reports beside their SQL on the smallest data; ``tools/check.py`` runs all of them."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = ["agg_01_campaign", "agg_07_campaign_country", "agg_32_status_crosstab", "win_02_daily_metrics", "win_15_cohorts",
         "cat_04_seniority", "str_03_04_text_shape", "jsn_02_employment", "dq_07_outlier_report", "snk_03_upsert",
         "mth_05_quantile_codes", "f_06_service_features", "mon_03_cool_down", "src_14_person_flatten", "ml_23_auc"]


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert compare(got, connect(FOLDER).execute(entry.oracle_sql()[name]).df()) is None


def test_every_sql_has_its_report():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_segments_sum_to_all_contacts(spark):
    from leadmill.operators.kpi import segment_totals
    from leadmill.plans.segments import segments
    from leadmill.sources.tables import Tables

    t = Tables(spark, FOLDER)
    totals = segment_totals(segments(t, "campaign", "industry_category"), ["campaign", "industry_category"])
    assert totals.agg({"contact_count": "sum"}).first()[0] == t.contacts("id").count()


def test_crosstab_margins_are_sums(spark):
    rows = entry.queries()["agg_32_status_crosstab"](spark, FOLDER).collect()
    everything = next(r for r in rows if r["status"] == "All")
    for column in ("0", "1", "2", "3", "total"):
        assert everything[column] == sum(r[column] for r in rows if r["status"] != "All")
