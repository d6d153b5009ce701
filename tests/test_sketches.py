from datetime import date, datetime, timedelta

import numpy as np
import pytest

from tickloom.operators.aggregate import distribution
from tickloom.operators.sketches import daily_sketches, sketch_store, stored_distribution

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("margin", [0.02, 1e-6])
def test_ranges_of_dates(spark, tmp_path, rows, margin):
    """Any range of dates, also with brackets that miss the quantile at first."""
    rng = np.random.default_rng(3)
    values = [(c, START + timedelta(minutes=int(m)), float(np.round(v, 1))) for c, shift in (("a", 0), ("b", 50))
              for m, v in zip(rng.integers(0, 6 * 1440, 3000), rng.normal(shift, 9, 3000), strict=True)]
    values += [("c", START, 5.0), ("d", START, None), ("e", None, 5.0), ("a", START, float("nan"))]
    ticks = spark.createDataFrame(values, "coin_id string, fetched_at timestamp, price_usd double").repartition(4).cache()
    store = sketch_store(spark, f"{tmp_path}/s")
    for i in range(3):
        store.write(daily_sketches(ticks.where(f"pmod(xxhash64(fetched_at, price_usd), 3) = {i}"), k=64), i)
    usable = ticks.where("price_usd is not null and not isnan(price_usd) and fetched_at is not null")
    for since, until in ((None, None), (date(2024, 1, 2), date(2024, 1, 4)), (date(2024, 1, 6), None)):
        cut = usable.where(f"to_date(fetched_at) between '{since or '1970-01-01'}' and '{until or '2999-01-01'}'")
        got = stored_distribution(store, ticks, since=since, until=until, margin=margin)
        want = distribution(cut, "price_usd")
        assert rows(got.select(*want.columns), 8) == rows(want, 8)
    empty = sketch_store(spark, f"{tmp_path}/none")
    assert stored_distribution(empty, ticks.limit(0)).count() == 0
