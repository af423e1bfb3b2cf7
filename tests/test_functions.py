import base64
import datetime
from decimal import ROUND_HALF_UP, Context, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_lake.config import DISK_STEPS
from activity_lake.functions.decimals import big_endian_integer, decode_decimal, encode_integer
from activity_lake.functions.formatting import format_day, format_duration, format_km, message_text, or_fallback_name
from activity_lake.functions.rules import check_limit, level, map_category, metres_to_km, percent_used
from tests.data import packed


def decoded(spark, rows, precision=38, scale=0, signed=True):
    frame = spark.createDataFrame(rows, "text string, scale int")
    value = decode_decimal(F.col("text"), F.col("scale"), precision, scale, signed)
    return [row[0] for row in frame.select(value).collect()]


def test_integers_of_all_widths_are_exact(spark):
    values = [0, 1, 127, 128, 255, 256, -1, -128, -129, 2**55 - 1, 2**55, -2**55, 2**56, 2**63, -2**63, 2**64, -2**70 - 5,
              10**38 - 1, -(10**38 - 1)]
    assert decoded(spark, [(packed(value), 0) for value in values]) == values


def test_sign_padding_does_not_change_the_value(spark):
    texts = [base64.b64encode(value.to_bytes(30, "big", signed=True)).decode() for value in (5, -5, 2**100, -2**100)]
    assert decoded(spark, [(text, 0) for text in texts]) == [5, -5, 2**100, -2**100]


def test_unsigned_variant_differs_for_negatives_only(spark):
    assert decoded(spark, [("/w==", 0), ("fw==", 0)], signed=False) == [255, 127]
    assert decoded(spark, [("/w==", 0), ("fw==", 0)]) == [-1, 127]
    wide = base64.b64encode(b"\xff" * 9).decode()
    assert decoded(spark, [(wide, 0)], signed=False) == [2**72 - 1]


def test_rounding_is_half_up_and_happens_once(spark):
    rows = [("Iw==", 1), (packed(25), 1), (packed(-35), 1), (packed(4999999999), 10), (packed(5), -2)]
    assert decoded(spark, rows, 10, 0) == [4, 3, -4, 0, 500]


def test_any_number_of_digits_if_the_result_fits(spark):
    values = [5 * 10**40, -5 * 10**40, 10**60 + 10**58, 2**400, -(2**400), -(2**127), 2**127 - 1, 2**119, -(2**120)]
    scales = [40, 40, 58, 115, 115, 30, 30, 20, 20]
    want = [Decimal(v).scaleb(-s, Context(prec=200)).quantize(Decimal("0.001"), ROUND_HALF_UP, Context(prec=200)) for v, s in zip(values, scales)]
    assert decoded(spark, list(zip(map(packed, values), scales)), 38, 3) == want
    assert decoded(spark, [(packed(10**38), 0), (packed(10**41), 2)]) == [None, None]
    wide = base64.b64encode(b"\xff" * 20).decode()
    assert decoded(spark, [(wide, 20)], 38, 0, signed=False) == [Decimal(2**160 - 1).scaleb(-20, Context(prec=200)).quantize(Decimal(1), ROUND_HALF_UP, Context(prec=200))]


def test_days_just_before_midnight(spark):
    for micros, day in ((32503679999999999, "31/12/2999"), (12622780799999999, "31/12/2369"), (253402300799999999, "31/12/9999"),
                        (-1, "31/12/1969"), (-62135596800000000, "01/01/0001")):
        assert spark.range(1).select(format_day(F.lit(str(micros)))).first()[0] == day


def test_what_cannot_be_decoded_is_null(spark):
    rows = [(None, 0), ("", 0), ("not base64", 0), ("BQ==", None), (packed(10**10), 0), (packed(2**130), 0), (packed(10**38), 0)]
    assert decoded(spark, rows, 10, 0) == [None] * len(rows)
    assert decoded(spark, [(packed(10**38), 0)]) == [None]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**30), 10**30), st.integers(0, 12)), min_size=1, max_size=40))
def test_decimals_match_python(spark, pairs):
    got = decoded(spark, [(packed(value), scale) for value, scale in pairs], 38, 3)
    with localcontext() as context:
        context.prec = 60
        want = [Decimal(value).scaleb(-scale).quantize(Decimal("0.001"), ROUND_HALF_UP) for value, scale in pairs]
    assert got == want


def test_encoding_uses_the_shortest_bytes(spark):
    values = [0, 1, 127, 128, 255, 256, 32767, 32768, -1, -128, -129, -32768, -32769, 2**62, -2**63]
    frame = spark.createDataFrame([(value,) for value in values], "value bigint")
    assert [row[0] for row in frame.select(encode_integer(F.col("value"))).collect()] == [packed(value) for value in values]


def test_wide_form_agrees_with_short_form(spark):
    frame = spark.createDataFrame([(bytearray(b"\x80"),), (bytearray(b"\x7f\xff"),), (bytearray(b"\xff\xfe"),)], "raw binary")
    assert [row[0] for row in frame.select(big_endian_integer(F.col("raw"))).collect()] == [-128, 32767, -2]


def texts(spark, kind, values, function):
    frame = spark.createDataFrame([(value,) for value in values], f"value {kind}")
    return [row[0] for row in frame.select(function(F.col("value"))).collect()]


def test_durations(spark):
    assert texts(spark, "bigint", [59, 3599, 3600, 3725, 65, 0, 360000], format_duration) == [
        "0m59s", "59m59s", "1h00m00s", "1h02m05s", "1m05s", "0m00s", "100h00m00s"
    ]


def test_days_are_utc_in_every_session(spark):
    micros = int(datetime.datetime(2025, 3, 1, 23, 59, 59, tzinfo=datetime.timezone.utc).timestamp()) * 1_000_000
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        values = [str(micros), "-1", "x", None, "999999999999999999"]
        assert texts(spark, "string", values, format_day) == ["01/03/2025", "31/12/1969", "x", None, "999999999999999999"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_distance_text(spark):
    frame = spark.createDataFrame([("BQ==", 0), ("Iw==", 1), ("BQ==", None), (None, 0), ("?", 0), (packed(125), 3)], "v string, s int")
    got = [row[0] for row in frame.select(format_km(F.col("v"), F.col("s"))).collect()]
    assert got == ["5.00 km", "3.50 km", "5.00 km", "N/A", "N/A", "0.13 km"]


def test_message_layout(spark):
    text = spark.range(1).select(message_text(*[F.lit(part) for part in ("A B", "Vélo", "01/01/2025", "5.00 km", "1m05s", "ok")])).first()[0]
    assert text == (
        "\n\n*Félicitations A B ! Nouvelle séance de vélo enregistrée !*\n━━━━━━━━━━━━━━━━━━━━━━━━\n🏃 *Sport*      : Vélo\n"
        "📅 *Date*       : 01/01/2025\n📏 *Distance*   : 5.00 km\n⏱️ *Temps*      : 1m05s\n💬 *Commentaire*: _ok_\n\n"
    )


def test_name_fallback(spark):
    frame = spark.createDataFrame([("A B", 1), (None, 2), (None, None)], "n string, k bigint")
    assert [row[0] for row in frame.select(or_fallback_name(F.col("n"), F.col("k"))).collect()] == ["A B", "Employé #2", "Employé #"]


def test_limits_are_inclusive_and_per_category(spark):
    frame = spark.createDataFrame([(2, 15.0), (2, 15.1), (3, 25.0), (3, 25.1), (1, 1.0), (2, None)], "mode int, km double")
    got = [row[0] for row in frame.select(check_limit(F.col("mode"), F.col("km"), {2: 15, 3: 25})).collect()]
    assert got == ["OK", "ERREUR", "OK", "ERREUR", None, None]
    modes = [row[0] for row in frame.select(map_category(F.col("mode"), {2: "walking", 3: "bicycling"})).collect()]
    assert modes == ["walking", "walking", "bicycling", "bicycling", None, "walking"]


def test_levels_and_percent(spark):
    frame = spark.createDataFrame([(-5.0,), (0.0,), (69.9,), (70.0,), (89.9,), (90.0,), (None,)], "value double")
    got = [row[0] for row in frame.select(level(F.col("value"), DISK_STEPS)).collect()]
    assert got == ["green", "green", "green", "orange", "orange", "red", None]
    one = spark.range(1)
    assert one.select(percent_used(F.lit(25.0), F.lit(100.0))).first()[0] == 75.0
    assert one.select(percent_used(F.lit(25.0), F.lit(0.0))).first()[0] is None
    assert one.select(metres_to_km(F.lit(1500))).first()[0] == 1.5
