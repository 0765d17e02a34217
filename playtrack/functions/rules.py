"""Category rule sets and the one helper that turns a rule set into a column.

A rule set is an ordered list of ``(label, values)`` pairs: the first pair whose
value list holds the input wins.  ``categorize`` turns it into one native
``CASE WHEN .. IN (..)`` expression (whole-stage codegen, no Python UDF), and
``categorize_sql`` emits the same rule as ANSI SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES.  These lists must equal the source data's raw category texts
# exactly (typos included), so they are stated here verbatim, in their
# original order.  A value may appear twice in one list; that is harmless.
# ---------------------------------------------------------------------------

# Five-way stadium rule (feature job).
STADIUM_FIVE_WAY = [
    ("dome_open", ["Domed, Open", "Domed, open"]),
    ("dome_closed", ["Dome", "Domed, closed", "Closed Dome", "Domed", "Dome, closed"]),
    ("indoor_open", ["Indoor, Open Roof", "Open", "Retr. Roof-Open", "Retr. Roof - Open"]),
    ("indoor_closed", ["Indoors", "Indoor", "Indoor, Roof Closed", "Indoor, Roof Closed", "Retractable Roof",
                       "Retr. Roof-Closed", "Retr. Roof - Closed", "Retr. Roof Closed"]),
    ("outdoor", ["Outdoor", "Outdoors", "Cloudy", "Heinz Field", "Outdor", "Ourdoor", "Outside", "Outddors",
                 "Outdoor Retr Roof-Open", "Oudoor", "Bowl"]),
]

# Five-way weather rule (feature job).
WEATHER_FIVE_WAY = [
    ("overcast", ["Party Cloudy", "Cloudy, chance of rain", "Coudy", "Cloudy and cold",
                  "Cloudy, fog started developing in 2nd quarter", "Partly Clouidy", "Mostly Coudy", "Cloudy and Cool",
                  "cloudy", "Partly cloudy", "Overcast", "Hazy", "Mostly cloudy", "Mostly Cloudy",
                  "Partly Cloudy", "Cloudy"]),
    ("clear", ["Partly clear", "Sunny and clear", "Sun & clouds", "Clear and Sunny", "Sunny, Windy",
               "Sunny and cold", "Sunny Skies", "Clear and Cool", "Clear and sunny",
               "Sunny, highs to upper 80s", "Mostly Sunny Skies", "Cold", "Clear and Cool",
               "Clear and warm", "Sunny and warm", "Clear and cold", "Mostly sunny",
               "T: 51; H: 55; W: NW 10 mph", "Clear Skies", "Clear skies", "Partly sunny",
               "Fair", "Partly Sunny", "Mostly Sunny", "Clear", "Sunny", "Clear to Partly Cloudy"]),
    ("rain", ["30% Chance of Rain", "Rainy", "Rain Chance 40%", "Showers", "Cloudy, 50% change of rain",
              "Rain likely, temps in low 40s.",
              "Cloudy with periods of rain, thunder possible. Winds shifting to WNW, 10-20 mph.",
              "Scattered Showers", "Cloudy, Rain", "Rain shower", "Light Rain", "Rain", "10% Chance of Rain"]),
    ("snow", ['Cloudy, light snow accumulating 1-3""', "Heavy lake effect snow", "Snow"]),
    ("Missing", ["N/A Indoor", "Indoors", "Indoor", "N/A (Indoors)", "Controlled Climate", "Heat Index 95"]),
]

# Three-way stadium rule of the severity report (anything else -> "Unknown").
STADIUM_THREE_WAY = [
    ("Closed", ["Indoors", "Indoor", "Indoor, Roof Closed", "Indoor, Roof Closed", "Retractable Roof",
                "Retr. Roof-Closed", "Retr. Roof - Closed", "Retr. Roof Closed",
                "Dome", "Domed, closed", "Closed Dome", "Domed", "Dome, closed"]),
    ("Open", ["Indoor, Open Roof", "Open", "Retr. Roof-Open", "Retr. Roof - Open", "Domed, open", "Domed, Open"]),
    ("Outdoor", ["Outdoors", "Outdoor", "Outdor", "Ourdoor", "Outddors", "Outdoor Retr Roof-Open", "Oudoor",
                 "Outside", "Cloudy", "Heinz Field", "Bowl"]),
]

# Two-way stadium rule (outdoor counts as open).  Used as "else Unknown" in the
# severity report and as "else keep" in the environment report.
STADIUM_TWO_WAY = [
    ("Closed", ["Indoors", "Indoor", "Indoor, Roof Closed", "Indoor, Roof Closed", "Retractable Roof",
                "Retr. Roof-Closed", "Retr. Roof - Closed", "Retr. Roof Closed",
                "Dome", "Domed, closed", "Closed Dome", "Domed", "Dome, closed"]),
    ("Open", ["Indoor, Open Roof", "Open", "Retr. Roof-Open", "Retr. Roof - Open", "Domed, open", "Domed, Open",
              "Outdoors", "Outdor", "Outddors", "Outdoor Retr Roof-Open", "Oudoor", "Outside", "Cloudy",
              "Heinz Field", "Bowl", "Outdoor"]),
]

# The same two lists with lower-case labels, applied "else keep" in the
# environment report.
STADIUM_OPEN_CLOSED = [("closed", STADIUM_TWO_WAY[0][1]), ("open", STADIUM_TWO_WAY[1][1])]

# Three-way weather rule of the severity report (anything else -> "Unknown").
# The "none" list maps to "Unknown" like the fallback.  Its snow text ends in
# ONE double quote, unlike the other rule sets.
WEATHER_THREE_WAY = [
    ("Rainy", ["30% Chance of Rain", "Rainy", "Rain Chance 40%", "Showers", "Cloudy, 50% change of rain",
               "Rain likely, temps in low 40s.",
               "Cloudy with periods of rain, thunder possible. Winds shifting to WNW, 10-20 mph.",
               "Scattered Showers", "Cloudy, Rain", "Rain shower", "Light Rain", "Rain", "Heavy lake effect snow",
               "Snow"]),
    ("Cloudy", ["Party Cloudy", "Cloudy, chance of rain", "Coudy", "Cloudy and cold",
                "Cloudy, fog started developing in 2nd quarter", "Partly Clouidy", "Mostly Coudy", "Cloudy and Cool",
                "cloudy", "Partly cloudy", "Overcast", "Hazy", "Mostly cloudy", "Mostly Cloudy", "Partly Cloudy",
                "Cloudy", 'Cloudy, light snow accumulating 1-3"']),
    ("Sunny", ["Partly clear", "Sunny and clear", "Sun & clouds", "Clear and Sunny", "Sunny and cold",
               "Sunny Skies", "Clear and Cool", "Clear and sunny", "Sunny, highs to upper 80s",
               "Mostly Sunny Skies", "Cold", "Clear and warm", "Sunny and warm", "Clear and cold", "Mostly sunny",
               "T: 51; H: 55; W: NW 10 mph", "Clear Skies", "Clear skies", "Partly sunny", "Fair",
               "Partly Sunny", "Mostly Sunny", "Clear", "Sunny"]),
    ("Unknown", ["N/A Indoor", "Indoors", "Indoor", "N/A (Indoors)", "Controlled Climate"]),
]

# Weather quality rule (Bad / Normal / Good / none).  Used as "else Unknown" in
# the severity report and as "else keep" in the environment report.
WEATHER_QUALITY = [
    ("Bad", ["30% Chance of Rain", "Rainy", "Rain Chance 40%", "Showers", "Cloudy, 50% change of rain",
             "Rain likely, temps in low 40s.",
             "Cloudy with periods of rain, thunder possible. Winds shifting to WNW, 10-20 mph.",
             "Scattered Showers", "Cloudy, Rain", "Rain shower", "Light Rain", "Rain", "Heavy lake effect snow",
             "Snow", "10% Chance of Rain"]),
    ("Normal", ["Party Cloudy", "Cloudy, chance of rain", "Coudy", "Cloudy and cold",
                "Cloudy, fog started developing in 2nd quarter", "Partly Clouidy", "Mostly Coudy", "Cloudy and Cool",
                "cloudy", "Partly cloudy", "Overcast", "Hazy", "Mostly cloudy", "Mostly Cloudy", "Partly Cloudy",
                "Cloudy", 'Cloudy, light snow accumulating 1-3""', "Controlled Climate"]),
    ("Good", ["Partly clear", "Sunny and clear", "Sun & clouds", "Clear and Sunny", "Sunny and cold",
              "Sunny Skies", "Clear and Cool", "Clear and sunny", "Sunny, highs to upper 80s",
              "Mostly Sunny Skies", "Cold", "Clear and warm", "Sunny and warm", "Clear and cold", "Mostly sunny",
              "Clear Skies", "Clear skies", "Partly sunny", "Fair", "Partly Sunny", "Mostly Sunny", "Clear", "Sunny",
              "Clear to Partly Cloudy", "Sunny, Windy"]),
    ("none", ["N/A Indoor", "Indoors", "Indoor", "N/A (Indoors)", "Indoor,", "T: 51; H: 55; W: NW 10 mph",
              "Heat Index 95", "NONE", "N/A", "null", "None"]),
]

# Columns whose null text becomes "Missing" in the play list (not RosterPosition).
PLAY_TEXT_COLUMNS = ["PlayType", "FieldType", "Weather", "Position", "PositionGroup", "StadiumType"]

# The four roster positions of the movement study and the two play types.
MAIN_POSITIONS = ["Linebacker", "Safety", "Wide Receiver", "Cornerback"]
# Body parts of the injury file (dummy columns of the environment model).
BODY_PARTS = ["Ankle", "Foot", "Heel", "Knee", "Toes"]
# Positions of the lateral-movement chart.
INJURY_PRONE_POSITIONS = ["Wide Receiver", "Linebacker", "Defensive Back"]
RUSH_PASS = ["Rush", "Pass"]

# Pivot value lists of the player feature table (fixed, so no extra job runs
# to discover them and a missing category still yields its column).
WEATHER_PIVOT = ["clear", "overcast", "rain", "snow"]
STADIUM_PIVOT = ["dome_closed", "dome_open", "indoor_closed", "indoor_open", "outdoor"]
FIELD_PIVOT = ["Natural", "Synthetic"]
# ---------------------------------------------------------------------------

KEEP = object()   # sentinel: unmatched input keeps its own value


def categorize(col: str | Column, rules, default=KEEP) -> Column:
    """First matching ``(label, values)`` wins; otherwise ``default``.

    ``default=KEEP`` keeps the input value (null stays null); a string default
    also catches null input, as the Python ``in`` test of a UDF would.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for label, values in rules:
        cond = c.isin(*values)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = c if default is KEEP else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def _sql_str(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def categorize_sql(col: str, rules, default=KEEP) -> str:
    """The same rule as an ANSI ``CASE`` expression (for the oracle)."""
    parts = ["CASE"]
    for label, values in rules:
        parts.append(f" WHEN {col} IN ({', '.join(_sql_str(v) for v in values)}) THEN {_sql_str(label)}")
    parts.append(f" ELSE {col if default is KEEP else _sql_str(default)} END")
    return "".join(parts)


def in_list_sql(values) -> str:
    return "(" + ", ".join(_sql_str(v) for v in values) + ")"
