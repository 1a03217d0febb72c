import pytest

from flowgauge.errors import KpiError
from flowgauge.operators.closure import call_closure, calls_below
from flowgauge.sources.logs import ProcessLogs
from tests.conftest import element, moment, rows


def logs_of(spark, callers):
    """``callers``: called instance -> calling instance; the call activity of x has the key 1000 + x."""
    instances = sorted(set(callers) | set(callers.values()))
    calls = [
        element(1000 + called, caller, "call", "2024-05-02T08:00:00", None, "CALL_ACTIVITY")
        for called, caller in callers.items()
    ]
    return ProcessLogs.of(
        element_instances=rows(spark, "element_instances", *calls),
        process_instances=rows(spark, "process_instances", *(
            {"process_instance_key": key, "parent_element_instance_key": 1000 + key if key in callers else None}
            for key in instances
        )),
    )


def expected(callers):
    pairs = set()
    for key in set(callers) | set(callers.values()):
        root, depth = key, 0
        pairs.add((root, key, depth))
        while root in callers:
            root, depth = callers[root], depth + 1
            pairs.add((root, key, depth))
    return pairs


def test_deep_chain_and_many_called_by_one(spark):
    chain = {key + 1: key for key in range(1, 12)}
    fan = {100 + key: 3 for key in range(40)}
    assert {tuple(row) for row in call_closure(logs_of(spark, chain | fan)).collect()} == expected(chain | fan)


def test_no_calls_at_all(spark, demo):
    no_calls = ProcessLogs.of(
        element_instances=demo.element_instances.filter("type <> 'CALL_ACTIVITY'"),
        process_instances=demo.process_instances,
    )
    assert {tuple(row) for row in call_closure(no_calls).collect()} == {(key, key, 0) for key in range(1, 9)}


@pytest.mark.parametrize("callers", [{1: 1}, {1: 2, 2: 1}, {1: 3, 2: 1, 3: 2, 4: 1}])
def test_circular_calls_are_refused(spark, callers):
    logs = logs_of(spark, callers)
    with pytest.raises(KpiError):
        call_closure(logs)
    roots = spark.createDataFrame([(1, moment("2030-01-01"))], "process_instance_key bigint, until timestamp_ntz")
    with pytest.raises(KpiError):
        calls_below(logs, roots, "until")


def test_calls_below_some_roots(spark):
    logs = logs_of(spark, {2: 1, 3: 2, 4: 2, 5: 4, 9: 8})
    roots = spark.createDataFrame(
        [(7, 2, moment("2030-01-01")), (8, 1, moment("2000-01-01"))],
        "trigger_key bigint, process_instance_key bigint, until timestamp_ntz",
    )
    found = {(row["trigger_key"], row["process_instance_key"]) for row in calls_below(logs, roots, "until").collect()}
    assert found == {(7, 2), (7, 3), (7, 4), (7, 5), (8, 1)}
