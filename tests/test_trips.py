"""Trip cleaning and rankings on hand-made records."""

from strata.operators import trips

WIDTH = 17


def record(vehicle, driver, duration, distance, fare, total):
    fields = [""] * WIDTH
    fields[0], fields[1], fields[4], fields[5], fields[11], fields[16] = (
        vehicle, driver, duration, distance, fare, total,
    )
    return tuple(fields)


def raw(spark, rows):
    schema = ", ".join(f"c{i} string" for i in range(WIDTH))
    return spark.createDataFrame(rows, schema)


def test_boundaries_are_strict(spark):
    df = raw(spark, [
        record("V1", "D1", "60", "1.0", "5", "6"),     # duration not > 60
        record("V1", "D1", "61", "0.10", "5", "6"),    # distance not > 0.10
        record("V1", "D1", "61", "0.11", "0.10", "6"),  # fare not > 0.10
        record("V1", "D1", "61", "0.11", "0.11", "0.10"),  # total not > 0.10
        record("V1", "D1", "61", "0.11", "0.11", "0.11"),  # kept
    ])
    assert trips.clean_trips(df).count() == 1


def test_bad_numbers_are_dropped_without_failure(spark):
    df = raw(spark, [
        record("V1", "D1", "abc", "1", "5", "6"),
        record("V1", "D1", "100", None, "5", "6"),
        record("V1", "D1", "100", "1", "nan", "6"),
        record("V1", "D1", "100", "1", "5", "NaN"),
        record("V1", "D1", "100", "1", "5", None),
        record("V1", "D1", "100", "1", "5", "6"),
    ])
    out = trips.clean_trips(df).collect()
    assert len(out) == 1 and out[0]["total"] == 6.0


def test_short_rows_from_csv_fail_cleaning(spark, tmp_path):
    path = tmp_path / "trips.csv"
    good = ",".join(record("V1", "D1", "100", "1", "5", "6"))
    short = "V2,D2,,,100,1"  # only 6 fields: total is null
    path.write_text(good + "\n" + short + "\n")
    from strata.sources import read_trips

    assert trips.clean_trips(read_trips(spark, str(path))).count() == 1


def test_null_driver_counts_as_one_driver(spark):
    ok = ("100", "1", "5", "6")
    df = raw(spark, [record("V1", None, *ok), record("V1", None, *ok), record("V1", "D1", *ok)])
    got = trips.distinct_per_key(trips.clean_trips(df)).collect()
    assert [(r["vehicle"], r["drivers"]) for r in got] == [("V1", 2)]


def test_mean_of_ratios_not_ratio_of_sums(spark):
    df = raw(spark, [record("V1", "D1", "60.5", "1", "5", "10"), record("V1", "D1", "605", "1", "5", "10")])
    rate = trips.mean_rate_per_key(trips.clean_trips(df)).collect()[0]["rate"]
    expected = (10 / 60.5 * 60 + 10 / 605 * 60) / 2
    assert abs(rate - expected) < 1e-12
    assert abs(rate - 20 / 665.5 * 60) > 1e-3


def test_ties_at_the_cut_take_smallest_keys(spark):
    ok = ("100", "1", "5", "6")
    rows = [record("V9", f"D{i}", *ok) for i in range(3)]
    for v in ("V3", "V1", "V2"):
        rows += [record(v, f"D{i}", *ok) for i in range(2)]
    top = trips.top_vehicles(trips.clean_trips(raw(spark, rows)), 3).collect()
    assert [(r["vehicle"], r["drivers"]) for r in top] == [("V9", 3), ("V1", 2), ("V2", 2)]


def test_top_drivers_orders_by_rate(spark):
    rows = [record("V1", "A", "60", "1", "5", "1"), record("V1", "B", "120", "1", "5", "10"),
            record("V1", "C", "120", "1", "5", "20")]
    top = trips.top_drivers(trips.clean_trips(raw(spark, rows)), 5).collect()
    assert [r["driver"] for r in top] == ["C", "B"]
