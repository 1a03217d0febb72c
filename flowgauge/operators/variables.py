"""KPIs on the current value of process variables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.errors import BAD_INPUTPARAMETER, DATE_PARSING_ERROR, incomplete, is_blank, required
from flowgauge.functions.values import (
    as_number,
    bucket_label,
    compare_moment,
    compare_number,
    is_date_operator,
    json_value,
    moment_of,
)
from flowgauge.operators.kpi import Inputs, Kpi, Problem
from flowgauge.schemas import KEY


def current_variables(
    variables: DataFrame, names: Iterable[str], key: str = KEY,
    column: Callable[[str], str] = lambda name: name,
) -> DataFrame:
    """One row per instance, one JSON text column per variable name.

    Only root-scope rows of the wanted names are read, so the filter reaches the scan
    and the aggregate sees a handful of rows per instance.
    """
    wanted = list(dict.fromkeys(names))
    if not wanted:
        raise incomplete("at least one variable name is required")
    root = (F.col("scope_key") == F.col(KEY)) & F.col("name").isin(wanted)
    current = [
        F.max_by("value", F.when(F.col("name") == name, F.col("variable_key"))).alias(column(name))
        for name in wanted
    ]
    return variables.filter(root).groupBy(key).agg(*current)


def variable(name: str, as_type: str = "string") -> Kpi:
    """Current value of a variable, null when unset.

    A column has one type, so the caller names it; a value of another type gives null.
    """
    wanted = required(name, "the variable name")
    return Kpi(lambda inputs: json_value(inputs.variable(wanted), as_type), variables=(wanted,))


def expr(sql: str, variables: Mapping[str, str]) -> Kpi:
    """A Spark SQL expression over variables, given as ``{name: type}``.

    Null for an instance that holds none of them.
    """
    text = required(sql, "the expression")
    if not variables:
        raise incomplete("name the variables of the expression")
    return Kpi(
        lambda inputs: inputs.frame, variables=tuple(variables), expression=(text, dict(variables))
    )


def _not_usable(name: str, expected: str, text: Column) -> Column:
    return F.concat(F.lit(f"variable {name} should hold {expected}, not '"), text, F.lit("'"))


def threshold(name: str, operator: str, limit: float | str) -> Kpi:
    """Compare a variable with a number (``= > < >= <=``) or a date (``before after``)."""
    if is_blank(name) or is_blank(operator) or limit is None:
        raise incomplete("a threshold needs a variable, an operator and a limit")
    by_date = is_date_operator(operator)
    if by_date:
        compare_moment(F.lit(None).cast("timestamp_ntz"), operator, str(limit))
    else:
        compare_number(F.lit(None).cast("double"), operator, limit)

    def text(inputs: Inputs) -> Column:
        return json_value(inputs.variable(name))

    def finish(inputs: Inputs) -> Column:
        if by_date:
            return compare_moment(moment_of(text(inputs)), operator, str(limit))
        return compare_number(as_number(text(inputs)), operator, limit)

    def problems(inputs: Inputs) -> list[Problem]:
        value = text(inputs)
        if by_date:
            bad, code, expected = moment_of(value).isNull(), DATE_PARSING_ERROR, "an ISO-8601 date"
        else:
            bad, code, expected = as_number(value).isNull(), BAD_INPUTPARAMETER, "a number"
        return [Problem(value.isNotNull() & bad, code, _not_usable(name, expected, value), is_null=True)]

    return Kpi(finish, variables=(name,), problems=problems)


def bucket(name: str, steps: Sequence[tuple[float | str, str]]) -> Kpi:
    """Label of the highest step at or below the variable's value."""
    wanted = required(name, "the variable name")
    bucket_label(F.lit(None).cast("double"), steps)

    def finish(inputs: Inputs) -> Column:
        return bucket_label(as_number(json_value(inputs.variable(wanted))), steps)

    def problems(inputs: Inputs) -> list[Problem]:
        value = json_value(inputs.variable(wanted))
        bad = value.isNotNull() & as_number(value).isNull()
        return [Problem(bad, BAD_INPUTPARAMETER, _not_usable(wanted, "a number", value), is_null=True)]

    return Kpi(finish, variables=(wanted,), problems=problems)
