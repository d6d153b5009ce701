from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tickloom.plans import views
from tickloom.schemas import GOLD
from tickloom.session import shared_dir

START = datetime(2024, 1, 1)


def gold(spark):
    data = [
        (k, START + timedelta(minutes=i), START + timedelta(minutes=i, seconds=10), float(100 + (i * step) % 17), 90.0, 120.0, 5.0, 1.0, 0.1, 3)
        for k, step in (("a", 3), ("b", 5), ("c", 7)) for i in range(90)
    ]
    return spark.createDataFrame(data, GOLD)


def test_overview_resamples_before_it_cuts(spark):
    shown = views.overview(gold(spark), ["a"], "30m", "30m")
    # bins start at 0:00, 0:30, 1:00; the newest bin start is the reference point
    assert sorted(r.window_start.minute for r in shown.collect()) == [0, 30]
    assert views.overview(gold(spark), []).count() == 0


def test_technical_cuts_before_it_resamples(spark):
    panel = views.technical(gold(spark), "a", "5m", "30m").orderBy("window_start").collect()
    # rows from 0:59 on: the first five-minute bin holds one row only
    assert panel[0].window_start == START + timedelta(minutes=55) and panel[0].record_count == 3
    assert panel[1].record_count == 15 and len(panel) == 7
    assert views.technical(gold(spark), "a", "1h").count() == 0


def test_cards_comparison_predictions_and_status(spark):
    g = gold(spark)
    assert views.technical_cards(g).count() == 3
    parts = views.comparison(g, ["a", "b"])
    assert parts["correlation"].count() == 4 and parts["volume"].count() == 2
    assert parts["normalized"].count() == 180
    assert {r.n for r in parts["returns"].collect()} == {50}
    ahead = views.predictions(g, ["a"], model="linear")
    assert ahead["forecast"].count() == 12 and ahead["series"].count() == 102 and ahead["summary"].count() == 1
    status = views.status(g, g.limit(0))
    assert [r.records for r in status["keys"].collect()] == [90, 90, 90]
    assert status["layers"].first().gold_rows == 270
    assert status["freshness"].first().last_ts == START + timedelta(minutes=89)


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: "hdfs://shared" if key == "spark.checkpoint.dir" else default)
    assert shared_dir(spark) == "hdfs://shared"
    assert isinstance(spark, SparkSession)
