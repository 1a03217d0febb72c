"""Scalar functions on process variables, which arrive as JSON text."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.errors import bad_input, incomplete, no_choice
from flowgauge.functions.clock import parse_moment, parse_moment_literal

NUMERIC_OPERATORS = ("=", ">", "<", ">=", "<=")
DATE_OPERATORS = ("before", "after")


def json_value(json: Column, as_type: str = "string") -> Column:
    """Typed value of a JSON text; null when absent, JSON null or not of the type."""
    return F.try_variant_get(F.try_parse_json(json), "$", as_type)


def as_number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def number_literal(value: float | str, what: str) -> float:
    text = str(value).strip()
    try:
        if "_" not in text:  # Python alone takes 1_000 for a number
            return float(text)
    except ValueError:
        pass
    raise bad_input(f"the {what} has to be a number, got {value!r}")


def is_date_operator(operator: str) -> bool:
    name = operator.strip().lower()
    if name in DATE_OPERATORS:
        return True
    if name in NUMERIC_OPERATORS:
        return False
    raise no_choice("operator of a threshold", operator, NUMERIC_OPERATORS + DATE_OPERATORS)


def compare_number(value: Column, operator: str, limit: float | str) -> Column:
    """Numeric comparison; NaN compares as false, unlike Spark's own ordering."""
    bound = number_literal(limit, "threshold")
    if math.isnan(bound):
        return F.when(value.isNotNull(), F.lit(False))
    result = {
        "=": value == bound, ">": value > bound, "<": value < bound,
        ">=": value >= bound, "<=": value <= bound,
    }[operator.strip()]
    return F.when(F.isnan(value), F.lit(False)).otherwise(result)


def compare_moment(moment: Column, operator: str, limit: str) -> Column:
    """Strictly before or strictly after an ISO date or date-time."""
    bound = F.lit(parse_moment_literal(limit).isoformat(sep=" ")).cast("timestamp_ntz")
    return moment < bound if operator.strip().lower() == "before" else moment > bound


def moment_of(text: Column) -> Column:
    return parse_moment(text)


def bucket_label(value: Column, steps: Sequence[tuple[float | str, str]]) -> Column:
    """Label of the highest step at or below ``value``; null below all of them.

    Steps may come in any order; of two equal ones the later wins.
    """
    if not steps:
        raise incomplete("a bucket needs at least one (threshold, label) pair")
    labels: dict[float, str] = {}
    for step in steps:
        if len(step) != 2:
            raise bad_input(f"a bucket step is a (threshold, label) pair, got {step!r}")
        labels[number_literal(step[0], "threshold of a bucket")] = str(step[1]).strip()
    chosen = F.when(F.isnan(value), F.lit(None).cast("string"))
    for bound in sorted(labels, reverse=True):
        chosen = chosen.when(value >= bound, F.lit(labels[bound]))
    return chosen
