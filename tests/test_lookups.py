import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import labels
from reviewloom.functions.values import shift_month, to_number
from reviewloom.operators import lookups, routing
from reviewloom.plans.evidence import brand_alerts, evidence, scope_evidence, scope_key, shared_scopes
from reviewloom.schemas import table_schema
from reviewloom.sources import tables

BRANCHES = [("north_hill", "North Hill"), ("lake_side", "Lakeside"), ("old_town", "Old Town")]


@pytest.fixture
def branches(spark):
    return spark.createDataFrame(BRANCHES, "branch_id string, branch_name string")


def questions(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "question_id int, question string")


def routed(spark, branches, *texts):
    found = routing.route_questions(questions(spark, *texts), branches).collect()
    return [r for r in sorted(found, key=lambda r: r["question_id"])]


def test_routing(spark, branches):
    action, plain, both, months, words = routed(
        spark,
        branches,
        "What actions should we take for North Hill?",
        "How is sentiment trending overall?",
        "lake side or OLD TOWN in July 2026",
        "How did the branches perform in 2026/7",
        "Any satisfaction at Lakeside in March 2024 or May 2023?",
    )
    assert action["branch_id"] == "north_hill" and action["wants_recommendations"] is True
    assert plain["branch_ids"] == [] and plain["scope"] == "brand" and not plain["wants_recommendations"]
    everyone = sorted(b for b, _ in BRANCHES)
    assert both["branch_ids"] == everyone and both["period"] == "2026-07" and both["branch_id"] is None
    assert months["branch_ids"] == everyone and months["period"] == "2026-07"
    # "satisfaction" holds "action"; the first month name in calendar order wins.
    assert words["branch_id"] == "lake_side" and words["wants_recommendations"] is True
    assert words["period"] == "2024-03"


@pytest.mark.parametrize(
    "text, period",
    [
        ("202612", "2026-12"),
        ("2026-1 and December 2020", "2026-01"),
        ("1999-05", None),
        ("2026-13", None),
        ("in may  2021", "2021-05"),
        ("mayor 2021", None),
        ("", None),
    ],
)
def test_periods(spark, text, period):
    df = questions(spark, text).select(routing.requested_period(F.col("question")).alias("p"))
    assert df.first()["p"] == period


def test_mentions_equal_comparing_every_pair(spark):
    names = [(f"b_{i}", n) for i, n in enumerate(["Ab", "abc", "c d", "Dabcd", "zz"])]
    branch_rows = spark.createDataFrame(names, "branch_id string, branch_name string")
    texts = ["", "a", "AB", "xabcx", "b 1 and c d", "dabcd", "zZz b 3", "B 0"]
    found = {tuple(r) for r in routing.mentioned_branches(questions(spark, *texts), branch_rows).collect()}
    expected = {
        (i, b)
        for i, t in enumerate(texts)
        for b, n in names
        if n.lower() in t.lower() or b.replace("_", " ") in t.lower()
    }
    assert found == expected


@pytest.fixture
def monthly(spark):
    data = [("2026-07", b, n, 5, 4.0, 2, False, True) for b, n in BRANCHES[:2]]
    data.append(("2026-06", "lake_side", "Lakeside", 0, None, 0, True, False))
    return spark.createDataFrame(data, table_schema("monthly_summary"))


def test_branch_performance(monthly, branches, rows):
    found = {
        r["branch_id"]: r
        for r in rows(lookups.branch_performance(monthly, branches, ["north_hill", "lake_side", "none"], "2026-06"))
    }
    assert len(found) == 3
    assert found["lake_side"]["observed"] is True and found["lake_side"]["is_observed"] is False
    assert found["north_hill"]["observed"] is False and found["north_hill"]["branch_name"] == "North Hill"
    assert found["none"]["branch_name"] is None and found["none"]["review_count"] is None
    without = rows(lookups.branch_performance(monthly, branches, ["lake_side"]))
    assert without[0]["observed"] is False and without[0]["period"] is None


def test_search(spark, rows):
    data = [("r2", "a", "Good FOOD " + "x" * 400), ("r1", "b", "food"), ("r3", "a", None)]
    df = spark.createDataFrame(data, "review_id string, branch_id string, cleaned_text string").withColumns(
        {
            "branch_name": F.lit("n"),
            "rating": F.lit(1.0),
            "review_date": F.lit(None).cast("timestamp"),
            "review_text": F.col("cleaned_text"),
        }
    )
    found = rows(lookups.search_feedback(df, "Food"))
    assert [r["review_id"] for r in found] == ["r1", "r2"] and len(found[1]["cleaned_text"]) == 280
    assert [r["review_id"] for r in rows(lookups.search_feedback(df, "food", "a", 1))] == ["r2"]


def result_tables(spark, monthly):
    def made(name, data):
        return spark.createDataFrame(data, table_schema(name))

    when = dt.datetime(2026, 7, 1)
    return {
        "monthly_summary": monthly,
        "branch_summary": made("branch_summary", [(b, n, 5, 4.0, 2, 3) for b, n in BRANCHES]),
        "review_aspects": made("review_aspects", [("r", "lake_side", when, "service", "slow", "Negative", -0.5, "m", "s")]),
        "anomalies": made(
            "anomalies",
            [("lake_side", "L", "2026-07", 5, 1.0, -0.5, 0.5, False, True, -0.1, True, ["model_outlier"], "medium")],
        ),
        "branch_forecasts": made("branch_forecasts", [("lake_side", 9, -0.01, "watch", None, [(1, "2026-08", 4.0, 3.0, 5.0)])]),
        "dataset_summary": made("dataset_summary", [(15, 3, when, when, 4.0, {"4.0": 15}, 6, 9, 10.0)]),
        "topics": made("topics", [(i, [f"t{i}"], [1.0]) for i in range(7)]),
        "association_rules": made("association_rules", [(["a"], ["b"], 0.1, 0.5, float(i)) for i in range(12)]),
    }


def test_evidence_by_scope(spark, branches, monthly, rows):
    asked = questions(spark, "Lakeside in July 2026", "compare 2017-01", "overall?")
    route = routing.route_questions(asked, branches)
    one, every, brand = sorted(rows(evidence(route, result_tables(spark, monthly))), key=lambda r: r["question_id"])
    (branch,) = one["branches"]
    assert branch["branch_id"] == "lake_side" and branch["observed"] is True
    assert branch["period_summary"]["row"]["review_count"] == 5
    assert [m["month"] for m in branch["sentiment_trend"]] == ["2026-06", "2026-07"]
    assert branch["aspect_sentiment"][0]["aspect"] == "service"
    assert branch["forecast"]["risk_level"] == "watch" and len(branch["anomalies"]) == 1
    assert [b["branch_id"] for b in every["branches"]] == sorted(b for b, _ in BRANCHES)
    assert all(b["period_summary"] == {"month": "2017-01", "is_observed": False, "row": None} for b in every["branches"])
    assert brand["branches"] == [] and brand["brand_alert_count"] == 1
    assert one["brand_alert_count"] is None
    assert len(brand["top_topics"]) == 5 and len(brand["association_rules"]) == 10
    assert brand["association_rules"][0]["lift"] == 11.0
    assert brand["brand_summary"]["record_count"] == 15


def test_scopes_are_held_once(spark, branches, monthly, rows):
    asked = questions(spark, "Lakeside in July 2026", "compare 2017-01", "LAKESIDE 2026-07!", "compare all 2017/01", "overall?")
    routed = routing.route_questions(asked, branches)
    tables = result_tables(spark, monthly)
    keyed, scopes = shared_scopes(routed)
    assert "branch_ids" not in keyed.columns and scopes.count() == 3
    bundles = {r.pop("scope_key"): r for r in rows(scope_evidence(scopes, tables))}
    alone = {r["question_id"]: r for r in rows(evidence(routed, tables))}
    for question in rows(keyed):
        own, shared = alone[question["question_id"]], bundles[question["scope_key"]]
        assert all(own[name] == value for name, value in shared.items())


def test_scope_keys_don_t_depend_on_order(spark):
    df = spark.createDataFrame(
        [(["b", "a"], "2026-01"), (["a", "b"], "2026-01"), (["a,b"], "2026-01"), (["a", "b"], None), ([], None)],
        "ids array<string>, period string",
    )
    first, second, *others = [r[0] for r in df.select(scope_key(F.col("ids"), F.col("period"))).collect()]
    assert first == second and len({first, *others}) == 4


def test_aspects_of_a_branch_come_by_mentions(spark, branches, monthly, rows):
    tables = result_tables(spark, monthly)
    when = dt.datetime(2026, 7, 1)
    mentions = [("food", 1), ("service", 3), ("ambience", 1)]
    tables["review_aspects"] = spark.createDataFrame(
        [("r", "lake_side", when, a, "w", "Negative", -0.5, "m", "s") for a, n in mentions for _ in range(n)],
        table_schema("review_aspects"),
    )
    routed = routing.route_questions(questions(spark, "Lakeside"), branches)
    (one,) = rows(evidence(routed, tables))
    assert [a["aspect"] for a in one["branches"][0]["aspect_sentiment"]] == ["service", "ambience", "food"]


def test_business_frame(spark, rows):
    data = [("Banyan hills", "banyan_hills", "2026-08", 25)]
    df = spark.createDataFrame(data, "branch_name string, branch_id string, month string, review_count int")
    shown = labels.business_frame(df)
    assert shown.columns == ["branch", "month", "reviews"]
    assert rows(shown)[0]["branch"] == "Banyan Hills"
    assert labels.business_frame(df, ["month", "nothing"]).columns == ["month"]


def test_labels(spark):
    values = ["waiting_time", "wait_time", "price_value", "o'neil 2nd_floor", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i")
    shown = [r[0] for r in df.select(labels.experience_label(F.col("v"))).collect()]
    assert shown == ["Waiting Time", "Wait Time", "Price and Value", "O'Neil 2Nd Floor", "None"]
    items = spark.createDataFrame([(["aspect:food_quality", "sentiment:Negative", "rating_low", "other_item"],)], "i array<string>")
    assert items.select(labels.rule_items_label(F.col("i"))).first()[0] == (
        "Experience: Food Quality, Customer mood: Negative, Low rating (1-2), Other Item"
    )


def test_numbers_and_months(spark):
    df = spark.createDataFrame([("3.5",), ("nan",), ("",), ("x",), (None,), (" 2 ",)], "v string")
    assert [r[0] for r in df.select(to_number(F.col("v"))).collect()] == [3.5, None, None, None, None, 2.0]
    month = spark.createDataFrame([("2025-11",)], "m string").select(shift_month(F.col("m"), F.lit(3)))
    assert month.first()[0] == "2026-02"


# -- stored tables -----------------------------------------------------------


def test_missing_tables_are_empty(spark, tmp_path):
    found = tables.read_tables(spark, str(tmp_path))
    assert all(df.count() == 0 for df in found.values())
    assert found["crm_cases"].schema == table_schema("crm_cases")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path), "topics", required=True)
    assert tables.read_json(spark, str(tmp_path / "no.json"), table_schema("topics")).count() == 0
    assert tables.read_csv(spark, str(tmp_path / "no.csv"), table_schema("branch_summary")).count() == 0


def test_stored_table_round_trip(spark, monthly, tmp_path):
    tables.write_table(monthly, str(tmp_path), "monthly_summary")
    found = tables.read_table(spark, str(tmp_path), "monthly_summary")
    assert found.columns == monthly.columns and found.exceptAll(monthly).count() == 0
    plan = found.select("branch_id").where("branch_id = 'lake_side'")._jdf.queryExecution().toString()
    assert "EqualTo(branch_id,lake_side)" in plan.split("PushedFilters")[-1]


def test_personal_columns_are_not_stored(spark, tmp_path):
    df = spark.createDataFrame([("r1", "Ana", "hi")], "review_id string, reviewer_name string, cleaned_text string").coalesce(1)
    tables.write_csv(df, str(tmp_path / "out"), "reviews_preprocessed")
    (line, value) = next(tmp_path.glob("out/*.csv")).read_text().splitlines()
    assert (line, value) == ("review_id,cleaned_text", "r1,hi")


def test_csv_and_json_sinks(spark, tmp_path, rows):
    rules = spark.createDataFrame([(["a", "b"], ["c"], 0.1, 0.5, 2.0)], table_schema("association_rules"))
    rules = rules.coalesce(1)
    tables.write_csv(rules, str(tmp_path / "rules"))
    text = next(tmp_path.glob("rules/*.csv")).read_text().splitlines()
    assert text == ["antecedent,consequent,support,confidence,lift", '"a,b",c,0.1,0.5,2.0']
    tables.write_json(rules, str(tmp_path / "json"))
    assert rows(tables.read_json(spark, str(tmp_path / "json"), table_schema("association_rules"))) == rows(rules)
    assert json.loads(next(tmp_path.glob("json/*.json")).read_text())["antecedent"] == ["a", "b"]
    quoted = spark.createDataFrame([('say "hi",\nthen go', "x")], "branch_id string, branch_name string")
    tables.write_csv(quoted, str(tmp_path / "quoted"))
    back = tables.read_csv(spark, str(tmp_path / "quoted"), quoted.schema)
    assert rows(back) == rows(quoted)


def test_evidence_of_a_branch_without_reviews(spark, branches, monthly, rows):
    tables = result_tables(spark, monthly)
    routed = routing.route_questions(questions(spark, "Lakeside in July 2026"), branches)
    routed = routed.withColumn("branch_ids", F.array(F.lit("lake_side"), F.lit("never_opened")))
    (one,) = rows(evidence(routed, tables))
    found = {b["branch_id"]: b for b in one["branches"]}
    assert found["never_opened"]["branch_summary"] is None and found["lake_side"]["branch_summary"] is not None
    assert brand_alerts(tables).count() == 1
