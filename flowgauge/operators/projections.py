"""KPIs read from the instance itself or from the pilot: no log scan needed."""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.errors import no_choice, required
from flowgauge.functions.clock import rounded_date
from flowgauge.operators.kpi import Kpi
from flowgauge.schemas import KEY

# Case-sensitive property names and the spine columns they stand for.
PROPERTIES = {
    "processDefinition": "process_definition_id",
    "processDefinitionVersion": "process_definition_version",
    "tenantId": "tenant_id",
}


def constant(value: Any) -> Kpi:
    """The value as it is; lists and maps become JSON text, and None a null text."""
    if value is None:
        return Kpi(lambda inputs: F.lit(None).cast("string"))
    literal = json.dumps(value) if isinstance(value, (dict, list, tuple)) else value
    column = literal if isinstance(literal, Column) else F.lit(literal)
    return Kpi(lambda inputs: column)


def tag(name: str) -> Kpi:
    label = required(name, "the tag")
    return Kpi(lambda inputs: F.lit(label))


def process_instance_key() -> Kpi:
    return Kpi(lambda inputs: inputs.spine(KEY))


def business_key() -> Kpi:
    return Kpi(lambda inputs: inputs.spine("business_id"))


def process_property(name: str) -> Kpi:
    wanted = required(name, "the process property").strip()
    if wanted not in PROPERTIES:
        raise no_choice("process property", wanted, PROPERTIES)
    return Kpi(lambda inputs: inputs.spine(PROPERTIES[wanted]))


def date(
    rounding: str = "FULL", kind: str = "LocalDateTime", zone: str = "UTC",
    as_of: datetime | Column | None = None,
) -> Kpi:
    """The query's clock (or ``as_of``), rounded in ``zone`` and shown as ``kind``."""
    value = rounded_date(as_of, rounding, kind, zone)
    return Kpi(lambda inputs: value)
