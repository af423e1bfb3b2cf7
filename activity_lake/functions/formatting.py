"""Texts of the notification messages. Day and time formats do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_lake.functions.decimals import decode_decimal

_DAY_US = 86_400_000_000
# First and last microsecond of the years 1 to 9999, the days the text format can show.
_MIN_US = -62_135_596_800_000_000
_MAX_US = 253_402_300_799_999_999


def epoch_micros(text: Column) -> Column:
    """BIGINT of a text of epoch microseconds, NULL where it is none."""
    return text.try_cast("bigint")


def micros_to_timestamp(text: Column) -> Column:
    return F.timestamp_micros(epoch_micros(text))


def floor_div(value: Column, by: int) -> Column:
    """Whole quotient towards minus infinity, in integers."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def format_day(text: Column) -> Column:
    """Epoch microseconds as dd/MM/yyyy in UTC; the text itself where that is impossible."""
    micros = epoch_micros(text)
    day = F.date_from_unix_date(floor_div(micros, _DAY_US).cast("int"))
    shown = F.when(micros.between(_MIN_US, _MAX_US), F.date_format(day, "dd/MM/yyyy"))
    return F.coalesce(shown, text)


def format_duration(seconds: Column) -> Column:
    """``1h02m05s``, or ``2m05s`` below one hour."""
    minutes = floor_div(seconds, 60)
    hours = floor_div(minutes, 60)
    short_minutes = F.pmod(minutes, F.lit(60))
    short_seconds = F.lpad(F.pmod(seconds, F.lit(60)).cast("string"), 2, "0")
    with_hours = F.concat(
        hours.cast("string"), F.lit("h"), F.lpad(short_minutes.cast("string"), 2, "0"), F.lit("m"),
        short_seconds, F.lit("s"),
    )
    without = F.concat(short_minutes.cast("string"), F.lit("m"), short_seconds, F.lit("s"))
    return F.when(hours > 0, with_hours).otherwise(without)


def format_km(text: Column, scale: Column, signed: bool = True) -> Column:
    """A base64 decimal as ``3.50 km``, ``N/A`` where it cannot be read. A missing scale means 0."""
    value = decode_decimal(text, F.coalesce(scale, F.lit(0)), 38, 2, signed)
    return F.coalesce(F.concat(value.cast("string"), F.lit(" km")), F.lit("N/A"))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def or_fallback_name(name: Column, key: Column) -> Column:
    """The looked-up name, or a label made of the key."""
    return F.coalesce(name, F.concat(F.lit("Employé #"), F.coalesce(key.cast("string"), F.lit(""))))


def message_text(name: Column, sport: Column, day: Column, distance: Column, duration: Column, comment: Column) -> Column:
    """The congratulation sent for one activity."""
    sport = F.coalesce(sport, F.lit(""))
    comment = F.coalesce(comment, F.lit(""))
    # The wording and layout of the message.
    return F.concat(
        F.lit("\n\n*Félicitations "), name, F.lit(" ! Nouvelle séance de "), F.lower(sport), F.lit(" enregistrée !*\n"),
        F.lit("━━━━━━━━━━━━━━━━━━━━━━━━\n"),
        F.lit("🏃 *Sport*      : "), sport,
        F.lit("\n📅 *Date*       : "), day,
        F.lit("\n📏 *Distance*   : "), distance,
        F.lit("\n⏱️ *Temps*      : "), duration,
        F.lit("\n💬 *Commentaire*: _"), comment, F.lit("_\n\n"),
    )
