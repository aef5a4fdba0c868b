"""Presentation text: labels, deltas, scaled numbers, territory codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statistics office code of a state -> its two-letter code.
STATE_BY_CODE = {
    "11": "RO",
    "12": "AC",
    "13": "AM",
    "14": "RR",
    "15": "PA",
    "16": "AP",
    "17": "TO",
    "21": "MA",
    "22": "PI",
    "23": "CE",
    "24": "RN",
    "25": "PB",
    "26": "PE",
    "27": "AL",
    "28": "SE",
    "29": "BA",
    "31": "MG",
    "32": "ES",
    "33": "RJ",
    "35": "SP",
    "41": "PR",
    "42": "SC",
    "43": "RS",
    "50": "MS",
    "51": "MT",
    "52": "GO",
    "53": "DF",
}


def state_of(code: Column, mapping: Mapping[str, str] = STATE_BY_CODE) -> Column:
    """State of a territory code, null when the code is not mapped."""
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), code.cast("string"))


def city_label(city: Column, state: Column) -> Column:
    return F.concat(city, F.lit("/"), state)


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal, ties to even; null for an empty whole."""
    return F.bround(F.try_divide(part, whole) * 100, 1)


def events_label(events: Column, percent: Column) -> Column:
    return F.concat(events.cast("string"), F.lit(" eventos ("), percent.cast("string"), F.lit("%)"))


def signed_delta(current: Column, previous: Column, suffix: str = "") -> Column:
    """'+1.5 C' style change; null when there is nothing to compare with."""
    return _fixed(current.cast("double") - previous.cast("double"), "+", suffix)


def one_decimal(value: Column, suffix: str = "") -> Column:
    return _fixed(value.cast("double"), "", suffix)


def _fixed(value: Column, plus: str, suffix: str) -> Column:
    """One decimal, ties to even; the sign is the value's own, so -0.04 shows as -0.0."""
    sign = F.when(value < 0, "-").otherwise(plus)
    digits = F.format_string("%.1f", F.bround(F.abs(value), 1))
    return F.when(value.isNotNull(), F.concat(sign, digits, F.lit(suffix)))


def millions(value: Column, suffix: str = "") -> Column:
    return one_decimal(value.cast("double") / 1_000_000, suffix)
