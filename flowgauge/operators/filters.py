"""Row filters on the log tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.errors import incomplete, is_blank, no_choice
from flowgauge.operators.kpi import PRESENT, all_of

# Element types and the families an activity filter may name.
EVENT_TYPES = (
    "START_EVENT", "INTERMEDIATE_CATCH_EVENT", "INTERMEDIATE_THROW_EVENT",
    "BOUNDARY_EVENT", "END_EVENT", "EVENT_SUB_PROCESS",
)
TASK_TYPES = (
    "TASK", "SERVICE_TASK", "USER_TASK", "MANUAL_TASK",
    "RECEIVE_TASK", "SEND_TASK", "SCRIPT_TASK", "BUSINESS_RULE_TASK",
)
CONTAINER_TYPES = ("SUB_PROCESS", "AD_HOC_SUB_PROCESS", "MULTI_INSTANCE_BODY")
GATEWAY_TYPES = ("EXCLUSIVE_GATEWAY", "PARALLEL_GATEWAY", "INCLUSIVE_GATEWAY", "EVENT_BASED_GATEWAY")
OTHER_TYPES = ("PROCESS", "CALL_ACTIVITY", "SEQUENCE_FLOW", "UNSPECIFIED")

ACTIVITY_TYPES = TASK_TYPES + CONTAINER_TYPES
ELEMENT_TYPES = EVENT_TYPES + ACTIVITY_TYPES + GATEWAY_TYPES + OTHER_TYPES
FAMILIES = {
    "EVENT": EVENT_TYPES,
    "TASK": TASK_TYPES,
    "ACTIVITY": ACTIVITY_TYPES,
    "GATEWAY": GATEWAY_TYPES,
    "SEQUENCE": (),
    "ALL": ACTIVITY_TYPES + EVENT_TYPES,
}
# Families that add the sequence flows taken; the type name SEQUENCE_FLOW does not.
FLOW_FAMILIES = ("SEQUENCE", "ALL")


def split_names(names: str | Iterable[str]) -> list[str]:
    """``"A|B"`` or a list of names, trimmed, blanks dropped."""
    parts = names.split("|") if isinstance(names, str) else names
    return [part.strip() for part in parts if part.strip()]


def families(activity_filter: str | Iterable[str]) -> tuple[list[str], bool]:
    """Element types an activity filter selects, and whether it adds sequence flows."""
    types: dict[str, None] = {}
    with_flows = False
    for name in (part.upper() for part in split_names(activity_filter)):
        if name in FAMILIES:
            types |= dict.fromkeys(FAMILIES[name])
            with_flows |= name in FLOW_FAMILIES
        elif name in ELEMENT_TYPES:
            types[name] = None
        else:
            raise no_choice("activity filter", name, (*FAMILIES, *ELEMENT_TYPES))
    if not types and not with_flows:
        raise incomplete("name at least one element type or family")
    return list(types), with_flows


def element_is(*ids: str | None, match: str = "id") -> Column | None:
    """Condition on the element id; blank ids mean all rows.

    ``match="name_or_id"`` also accepts the element's name.
    """
    wanted = [value for value in ids if not is_blank(value)]
    if match not in ("id", "name_or_id"):
        raise no_choice("match", match, ("id", "name_or_id"))
    if not wanted:
        return None
    by_id = F.col("element_id").isin(wanted)
    return by_id if match == "id" else by_id | F.col("element_name").isin(wanted)


def job_is(error_code: str | None = None, element_id: str | None = None) -> Column | None:
    """Condition on jobs; each part is optional and blank means no filter."""
    by_code = None if is_blank(error_code) else F.col("error_code") == error_code
    return all_of(by_code, element_is(element_id))


def job_keep(error_code: str | None = None, element_id: str | None = None) -> dict[str, Sequence[str]]:
    """The jobs with an error code that :func:`job_is` can select, for the scan."""
    keep = {"error_code": PRESENT if is_blank(error_code) else (error_code,)}
    return keep if is_blank(element_id) else keep | {"element_id": (element_id,)}


def has_text(column: Column) -> Column:
    """Not null and not blank."""
    return column.rlike(r"\S")


def keep_rows(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.filter(condition)


def by_element(df: DataFrame, ids: Iterable[str] | None = None, match: str = "id") -> DataFrame:
    """Rows whose element is listed; no ids keeps everything."""
    return keep_rows(df, element_is(*(ids or ()), match=match))


def by_type(df: DataFrame, element_type: str) -> DataFrame:
    return df.filter(F.col("type") == element_type)


def by_families(df: DataFrame, *names: str) -> DataFrame:
    """Elements whose type belongs to one of the named types or families."""
    types, _ = families(names)
    return df.filter(F.col("type").isin(types)) if types else df.filter(F.lit(False))


def by_job(df: DataFrame, error_code: str | None = None, element_id: str | None = None) -> DataFrame:
    return keep_rows(df, job_is(error_code, element_id))
