"""KPIs that pick the most recent row: the last BPMN error and the last decision result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.errors import required
from flowgauge.functions.clock import packed_order
from flowgauge.operators import states
from flowgauge.operators.filters import has_text, job_is, job_keep
from flowgauge.operators.kpi import Kpi, Measure, all_of, measured


def newest_order(moment: Column, key: Column) -> Column:
    """Order whose maximum is the most recent row.

    A row without a time counts as the most recent; of equal times the smallest key
    wins, so that the outcome does not depend on the order of the input.
    """
    return packed_order(moment, key, descending=True)


def latest(
    table: str, value: str, moment: str, key: str, condition: Column, keep: Mapping[str, Sequence[str]],
) -> Measure:
    order = F.when(condition, newest_order(F.col(moment), F.col(key)))
    return Measure(table, F.max_by(F.col(value), order), keep, text=True, state=states.last_by(F.col(value), order))


def bpmn_error(element_id: str | None = None) -> Kpi:
    """Code of the most recent BPMN error, of one element or of the instance."""
    condition = all_of(has_text(F.col("error_code")), job_is(element_id=element_id))
    keep = job_keep(element_id=element_id)
    return measured(
        lambda inputs: inputs["last"],
        last=latest("jobs", "error_code", "last_update_time", "job_key", condition, keep),
    )


def decision_result(decision_id: str) -> Kpi:
    """JSON result of the most recent evaluation of a decision."""
    wanted = required(decision_id, "the decision id")
    condition = F.col("decision_definition_id") == wanted
    return measured(
        lambda inputs: inputs["last"],
        last=latest(
            "decision_instances", "result", "evaluation_date", "decision_instance_key", condition,
            {"decision_definition_id": (wanted,)},
        ),
    )
