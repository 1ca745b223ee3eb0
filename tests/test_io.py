import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from panelcast.plans.catalog import panel_o
from panelcast.sources import io


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "CSV"])
def test_round_trip_keeps_rows_and_values(spark, tmp_path, fmt):
    p = panel_o(spark, SF0001)
    path = str(tmp_path / f"panel.{fmt}")
    io.save_table(p, path)
    back = io.load_panel(spark, path)
    assert back.columns == p.columns
    assert back.count() == p.count()
    assert back.exceptAll(p).count() == 0


def test_explicit_format_wins(spark, tmp_path):
    p = panel_o(spark, SF0001).limit(5)
    path = str(tmp_path / "panel.out")
    io.save_table(p, path, output_format="json")
    assert io.load_table(spark, path, fmt="json").count() == 5


def test_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported"):
        io.load_table(spark, str(tmp_path / "x.xlsx"))
    with pytest.raises(FileNotFoundError):
        io.load_table(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="Unsupported"):
        io.save_table(panel_o(spark, SF0001), str(tmp_path / "x.txt"))


def test_pretty_printed_json_array(spark, tmp_path):
    path = tmp_path / "arr.json"
    path.write_text('[\n  {"account_id": "ACC-1", "churned": 0},\n  {"account_id": "ACC-2", "churned": 1}\n]\n')
    df = io.load_table(spark, str(path))
    assert df.count() == 2 and df.agg(F.sum("churned")).first()[0] == 1


def test_prediction_and_metric_sinks(spark, tmp_path):
    from panelcast.operators import metrics, scoring
    from panelcast.plans.catalog import features_o

    f = features_o(spark, SF0001)
    pred = scoring.make_predictions(scoring.fixed_score(f), threshold=0.5).select(
        "account_id", "month", "churn_risk_score", "prediction", "safe_probability", "risk_tier"
    )
    ids_only = str(tmp_path / "pred.csv")
    io.save_predictions(pred, ids_only)
    back = spark.read.option("header", True).csv(ids_only)
    assert back.count() == f.count() and set(back.columns) == set(pred.columns)
    full = str(tmp_path / "pred_full.parquet")
    io.save_predictions(pred, full, original=f, fmt="parquet")
    wide = spark.read.parquet(full)
    assert wide.count() == f.count() and len(wide.columns) == len(f.columns) + 4
    m = metrics.classification_metrics(scoring.make_predictions(scoring.fixed_score(f)), "churned")
    io.save_metrics(m, str(tmp_path / "metrics.json"))
    assert spark.read.json(str(tmp_path / "metrics.json")).count() == 1
    t = metrics.optimal_threshold(scoring.fixed_score(f), label="churned")
    io.save_thresholds(t, str(tmp_path / "thr.json"))
    assert spark.read.json(str(tmp_path / "thr.json")).first()["threshold"] is not None


def test_drop_scratch_only_touches_own_application(spark, tmp_path):
    from panelcast import session

    base = str(tmp_path)
    t = session.materialize(spark.range(5), "probe", base=base)
    assert t.count() == 5
    other = tmp_path / "app-of-another-job" / "tables"
    other.mkdir(parents=True)
    (tmp_path / "keep").mkdir()
    removed = session.drop_scratch(spark, base=base)
    own = tmp_path / spark.sparkContext.applicationId / "tables"
    assert any(r.endswith("/tables") for r in removed) and not own.exists()
    assert (tmp_path / "keep").exists() and other.exists()


def test_json_array_with_schema(spark, tmp_path):
    import datetime as dt
    import json

    from conftest import panel_rows
    from panelcast.sources import io

    rows = [{"month": dt.date(2024, m, 1), "enabled_channels": None if m == 2 else "web", "churned": int(m == 3)} for m in (1, 2, 3)]
    df = panel_rows(spark, rows)
    want = sorted(map(tuple, df.collect()))
    path = str(tmp_path / "made.json")
    io.save_json_array(df.repartition(2), path)
    assert sorted(map(tuple, io.load_panel(spark, path).collect()), key=str) == sorted(want, key=str)
    lines = str(tmp_path / "lines.json")
    io.save_table(df, lines)
    assert sorted(map(tuple, io.load_panel(spark, lines).collect()), key=str) == sorted(want, key=str)
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps([{"account_id": "ACC-1", "month": "2024-01-01", "churned": 1}, {"account_id": "ACC-2"}], indent=2))
    got = io.load_panel(spark, str(pretty)).orderBy("account_id").collect()
    assert [(r.account_id, r.churned) for r in got] == [("ACC-1", 1), ("ACC-2", None)]
    broken = tmp_path / "broken.json"
    broken.write_text('[{"account_id": "ACC-1", ')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        io.load_panel(spark, str(broken)).collect()


def _csv(path, text, name="part-0.csv"):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)
    return str(path)


HEAD = "note,current_month_revenue,churned,account_id,month,current_month_transactions,total_tickets,escalated_tickets,late_payments,enabled_channels,self_service_percentage,last_touchbase_date,average_resolution_time_hours"
GOOD = 'n,99.5,1,A,2024-01-01,7,3,1,0,"web,phone",40.5,2023-12-30T10:00:00,2.5'


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    r = io.load_panel(spark, _csv(tmp_path / "p.csv", f"{HEAD}\n{GOOD}\n")).collect()
    assert len(r) == 1 and r[0].current_month_revenue == 99.5 and r[0].current_month_transactions == 7 and r[0].churned == 1
    assert r[0].enabled_channels == "web,phone" and list(r[0].asDict()) == [f.name for f in io.PANEL_SCHEMA]
    with pytest.raises(ValueError, match="late_payments"):
        io.load_panel(spark, _csv(tmp_path / "q.csv", f"{HEAD.replace('late_payments', 'late')}\n{GOOD}\n"))
    _csv(tmp_path / "r.csv", f"{HEAD}\n{GOOD}\n")
    with pytest.raises(ValueError, match="different headers"):
        io.load_panel(spark, _csv(tmp_path / "r.csv", "account_id,month\nA,2024-01-01\n", "part-1.csv"))


def test_malformed_values_raise_or_are_set_apart(spark, tmp_path):
    bad = [GOOD.replace("99.5", "9x"), GOOD.replace("2024-01-01", "soon"), "n,1.0"]
    path = _csv(tmp_path / "p.csv", "\n".join([HEAD, GOOD, bad[0], GOOD.replace(",A,", ",B,"), *bad[1:]]) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|cannot"):
        io.load_panel(spark, path).collect()
    good, rejects = io.load_with_rejects(spark, path, io.PANEL_SCHEMA)
    assert sorted(r.account_id for r in good.collect()) == ["A", "B"] and good.columns == [f.name for f in io.PANEL_SCHEMA]
    assert sorted(r.row for r in rejects.collect()) == sorted(bad)
