from pyspark.sql import functions as F

from ticketmill.functions.labels import bucket_label, lookup, range_label, weekday_name
from ticketmill.functions.numeric import is_true, null_if_nan, ratio, round_half_even
from ticketmill.functions.text import WHITESPACE, strip


def column(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def apply(spark, values, dtype, function):
    rows = column(spark, values, dtype).select(function(F.col("x"))).collect()
    return [r[0] for r in rows]


def test_strip_is_python_strip(spark):
    texts = ["", " ", "a", " a ", "\ta b ", "　é x ", "\x1f~\x1c", "​ a", "~", "!",
             " é", "é ", "a  ", "\x7f a", None]
    texts += [w + "Lot 1" + w for w in WHITESPACE] + [w for w in WHITESPACE]
    expected = [None if t is None else t.strip() for t in texts]
    assert apply(spark, texts, "string", strip) == expected


def test_round_half_even_works_on_the_binary_value(spark):
    assert apply(spark, [1.015, 2.5, None], "double", lambda c: round_half_even(c, 2)) == [
        1.01, 2.5, None,
    ]
    assert apply(spark, [0.25, 0.35, -0.25, 87.2999999], "double",
                 lambda c: round_half_even(c, 1)) == [0.2, 0.4, -0.2, 87.3]


def test_nan_is_missing(spark):
    assert apply(spark, [float("nan"), 1.0, None], "double", null_if_nan) == [None, 1.0, None]


def test_ratio_rounds_up_and_survives_zero(spark):
    assert apply(spark, [201, None], "int", lambda c: ratio(c, F.lit(200), 2)) == [1.01, None]
    assert apply(spark, [1], "int", lambda c: ratio(c, F.lit(0), 2)) == [None]


def test_is_true_is_never_null(spark):
    assert apply(spark, [1, None], "int", lambda c: is_true(c > 0)) == [True, False]


def test_lookup_default_for_unknown_and_null(spark):
    assert apply(spark, [3, 7, None], "int", lambda c: lookup(c, {3: "Overcast"}, "Unknown")) == [
        "Overcast", "Unknown", "Unknown",
    ]
    assert apply(spark, ["a", None], "string", lambda c: lookup(c, {"a": 5})) == [5, None]
    assert apply(spark, ["a"], "string", lambda c: lookup(c, {}, "none")) == ["none"]


def test_range_label_ends_at_midnight_and_last_range_wins(spark):
    ranges = [("A", "2025-01-01", "2025-01-10"), ("B", "2025-01-10", "2025-01-20")]
    stamps = ["2024-12-31 23:59:59", "2025-01-01 00:00:00", "2025-01-10 00:00:00",
              "2025-01-20 00:00:00", "2025-01-20 00:00:01", None]

    def label(whole):
        return apply(spark, stamps, "string", lambda c: range_label(
            c.cast("timestamp_ntz"), ranges, "Unknown", whole))

    assert label(False) == ["Unknown", "A", "B", "B", "Unknown", "Unknown"]
    assert label(True) == ["Unknown", "A", "B", "B", "B", "Unknown"]


def test_bucket_first_match_wins(spark):
    values = [0.0, -0.0, 0.01, 5.0, 5.01, 15.0, 15.01, -1.0, float("nan"), None]
    labels = apply(spark, values, "double", lambda c: bucket_label(
        c, "None", [(5.0, "Light"), (15.0, "Moderate")], "Heavy"))
    assert labels == ["None", "None", "Light", "Light", "Moderate", "Moderate", "Heavy", "Light",
                      "Heavy", "Heavy"]


def test_weekday_name_is_the_full_english_name(spark):
    days = [f"2025-09-{d}" for d in range(15, 22)]
    names = apply(spark, [*days, None], "string", lambda c: weekday_name(c.cast("date")))
    formatted = apply(spark, [*days, None], "string",
                      lambda c: F.date_format(c.cast("date"), "EEEE"))
    assert names == formatted and names[0] == "Monday" and names[-1] is None
