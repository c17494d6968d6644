"""Column functions for dirty text: cleaning, casting, extraction and banding.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The ASCII whitespace that trimming removes.
WHITESPACE = " \t\n\x0b\f\r"

# The weather icon codes and their labels.
WEATHER_LABELS = {
    "01": "Clear Sky",
    "02": "Few Clouds",
    "03": "Scattered Clouds",
    "04": "Broken Clouds",
    "09": "Shower Rain",
    "10": "Rain",
    "11": "Thunderstorm",
    "13": "Snow",
    "50": "Mist/Fog",
}

# Compass points in clockwise order from north.
COMPASS = [
    "North", "North East", "East", "South East",
    "South", "South West", "West", "North West",
]

# Upper limits of the index bands; the last name has no limit.
BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
]
TOP_BAND = "Very Unhealthy"

# Display colour per category, and the one for any other category.
CATEGORY_COLOURS = {
    "Good": "#00E400",
    "Moderate": "#FFFF00",
    "Unhealthy": "#FF0000",
    "Very Unhealthy": "#8F3F97",
}
OTHER_COLOUR = "#CCCCCC"

# The patterns for numbers with units and for the observation time.
NON_DIGITS = r"[^\d]"
NON_NUMERIC = r"[^\d.-]"
OBSERVATION_TIME = r"(\d{1,2}[:.]\d{2},\s\w{3}\s\d{1,2})"


def trimmed(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))


def normalised(value: Column) -> Column:
    """Lower-case text without surrounding whitespace."""
    return F.lower(trimmed(value))


def slug_to_title(slug: Column) -> Column:
    """Hyphens become blanks, and a letter is upper case exactly if no letter stands before it.

    ``initcap`` sees words between blanks only, so one is put behind every other sign that
    is no letter, with a mark by which it is taken out again.
    """
    spaced = F.regexp_replace(F.lower(F.replace(slug, F.lit("-"), F.lit(" "))), r"([^\p{L} ])", "$1\u0001 ")
    return F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit(""))


def _cast(value: Column, kind: str, strict: bool) -> Column:
    return value.cast(kind) if strict else value.try_cast(kind)


def digits_only(value: Column, strict: bool = False) -> Column:
    """Integer from the digits of a text; sign and decimal point are dropped too."""
    return _cast(F.regexp_replace(value, NON_DIGITS, ""), "int", strict)


def number_from_text(value: Column, kind: str = "double", strict: bool = False) -> Column:
    """Number from a text with a unit, such as ``16.9 µg/m³``."""
    return _cast(F.regexp_replace(value, NON_NUMERIC, ""), kind, strict)


def plain_int(value: Column, strict: bool = False) -> Column:
    return _cast(value, "int", strict)


def usable_observation(value: Column) -> Column:
    """Reject marker texts; NULL is rejected by the comparison."""
    return (value != "N/A") & ~value.startswith("Air")


def plain_spaces(value: Column) -> Column:
    """Non-breaking spaces become plain ones."""
    return F.replace(value, F.lit("\u00a0"), F.lit(" "))


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def alert_text(value: Column) -> Column:
    """The word ``now`` in the alert position means that there is no alert."""
    return F.when(F.lower(value) != "now", value).otherwise(F.lit("No Alert"))


def compass_point(style: Column) -> Column:
    """Eight-point compass name opposite to the first angle found in a style text.

    The angle is turned by half a circle, then assigned to the sector whose centre is
    nearest. Doubling keeps the half-degree sector limits in integers.
    """
    angle = F.regexp_extract(style, r"(\d+)", 1).try_cast("decimal(38,0)")
    turned = ((angle + 180) % 360).cast("int")
    sector = F.floor((turned * 2 + 45) / 90).cast("int") % 8
    names = F.array(*[F.lit(name) for name in COMPASS])
    return F.coalesce(F.get(names, sector), F.lit("N/A"))


def index_band(value: Column) -> Column:
    """Category of an index value. NULL fails every comparison and gets the top name."""
    result = F.when(value <= BANDS[0][0], BANDS[0][1])
    for limit, name in BANDS[1:]:
        result = result.when(value <= limit, name)
    return result.otherwise(TOP_BAND)


def category_colour(category: Column) -> Column:
    return labelled(category, CATEGORY_COLOURS, F.lit(OTHER_COLOUR))


def labelled(code: Column, labels: Mapping[str, str], fallback: Column) -> Column:
    """Look a code up in a small fixed map."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), fallback)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def current_weather(icon_path: Column, labels: Mapping[str, str] = WEATHER_LABELS) -> Column:
    """Label of an icon named ``…weather-NN…``; other names give ``N/A``."""
    name = file_name(icon_path)
    code = F.substr(F.substring_index(name, "weather-", -1), F.lit(1), F.lit(2))
    unknown = F.concat(F.lit("Unknown ("), code, F.lit(")"))
    return F.when(name.contains("weather-"), labelled(code, labels, unknown)).otherwise(F.lit("N/A"))


def forecast_weather(icon_path: Column, labels: Mapping[str, str] = WEATHER_LABELS) -> Column:
    """Label from the third dash-separated part of the icon's file name."""
    part = F.get(F.split(file_name(icon_path), "-"), F.lit(2))
    code = F.substr(part, F.lit(1), F.lit(2))
    known = labelled(code, labels, F.concat(F.lit("Code "), code))
    return (
        F.when(F.coalesce(icon_path, F.lit("")) == "", F.lit("Unknown"))
        .when(part.isNull(), F.lit("Error Parsing Code"))
        .otherwise(known)
    )


def observation_from_heading(heading: Column) -> Column:
    """Observation time inside a heading, else its last 15 characters, else ``N/A``."""
    found = F.regexp_extract(heading, "(?U)" + OBSERVATION_TIME, 1)
    return (
        F.when(heading.isNull(), F.lit("N/A"))
        .when(found != "", found)
        .otherwise(trimmed(F.right(heading, F.lit(15))))
    )


def observation_after_bullet(heading: Column) -> Column:
    """The older capture: what follows the last bullet, without the ``Local time`` words."""
    tail = F.replace(F.substring_index(heading, "•", -1), F.lit("Local time"), F.lit(""))
    return F.when(heading.contains("•"), trimmed(tail)).otherwise(F.lit("N/A"))


def measure_kind(text: Column) -> Column:
    """Which measure a text with a unit states; the first matching unit decides."""
    return (
        F.when(text.contains("°"), "temperature")
        .when(text.contains("km/h"), "wind_speed")
        .when(text.contains("%"), "humidity")
    )


def routed_measures(texts: Column) -> dict[str, Column]:
    """Temperature, wind and humidity out of an array of texts; the last of a kind wins."""
    def last_of(kind):
        hits = F.filter(texts, lambda text: measure_kind(text) == kind)
        return or_default(F.try_element_at(hits, F.lit(-1)), "N/A")

    return {kind: last_of(kind) for kind in ("temperature", "wind_speed", "humidity")}
