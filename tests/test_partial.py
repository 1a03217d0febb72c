import random

import pytest

from flowgauge.errors import KpiError
from flowgauge.operators import counts, latest, timing, user_tasks, variables
from flowgauge.plans.partial import add_load, merge_loads, partial_states, record_of_loads
from flowgauge.plans.record import kpi_record
from flowgauge.schemas import KEY
from tests.test_sweep import pilot as swept_pilot
from tests.test_sweep import random_logs


def pilot():
    """What the sweep is tested with, without what needs an order, and an expression."""
    kept = {name: kpi for name, kpi in swept_pilot().items() if not kpi.frame}
    return kept | {"twice": variables.expr("amount * 2", {"amount": "int"}), "label": "constant"}


def plain(df):
    return sorted(tuple(str(v) for v in row) for row in df.collect())


def loads_of(logs, n):
    """Every row in one load, by its place in a shuffled order; the spine in all of them."""
    def part(number):
        def change(name, table):
            if name in ("process_instances", "flow_topology"):
                return table
            held = table.collect()
            random.Random(3).shuffle(held)
            return table.sparkSession.createDataFrame(held[number::n], table.schema)

        return logs.mapped(change)

    return [part(k) for k in range(n)]


@pytest.mark.parametrize("seed", [5])
def test_loads_merged_are_one_run(spark, tmp_path, seed):
    logs, _ = random_logs(spark, seed)
    whole = plain(kpi_record(logs, pilot()))
    for number, load in enumerate(loads_of(logs, 2)):
        add_load(load, pilot(), str(tmp_path / "a"), number)
    # A load that is stored again replaces itself.
    add_load(loads_of(logs, 2)[1], pilot(), str(tmp_path / "a"), 1)
    found = record_of_loads(spark, pilot(), str(tmp_path / "a"))
    assert found.columns == kpi_record(logs, pilot()).columns
    assert plain(found) == whole
    merge_loads(spark, pilot(), str(tmp_path / "a"), str(tmp_path / "b"))
    assert plain(record_of_loads(spark, pilot(), str(tmp_path / "b"))) == whole
    states = spark.read.parquet(str(tmp_path / "b/states"))
    assert states.count() == states.select(KEY).distinct().count()


def test_only_the_new_load_is_read(spark, demo, tmp_path):
    add_load(demo, pilot() | {"who": counts.execution_count("a")}, str(tmp_path), 0)
    files = spark.read.parquet(str(tmp_path / "states")).inputFiles()
    plan = partial_states(demo, pilot())._jdf.queryExecution().analyzed().toString()
    assert files and str(tmp_path) not in plan
    record = record_of_loads(spark, pilot() | {"who": counts.execution_count("a")}, str(tmp_path))
    assert all(str(tmp_path) in name for name in record.inputFiles())


def test_an_instance_that_comes_again(spark, demo, tmp_path):
    from flowgauge.operators.projections import business_key

    wanted = {"key": business_key(), "a": counts.execution_count("a")}
    add_load(demo, wanted, str(tmp_path), 0)
    newer = demo.mapped(lambda name, table: (
        table.filter(f"{KEY} = 7").selectExpr(*("'new' AS business_id" if c == "business_id" else c for c in table.columns))
        if name == "process_instances" else table.filter("false")
    ))
    add_load(newer, wanted, str(tmp_path), 1)
    found = {row[KEY]: (row["key"], row["a"]) for row in record_of_loads(spark, wanted, str(tmp_path)).collect()}
    assert found[7] == ("new", 2) and found[1][0] == "KPI-2026-0001" and len(found) == 8


def test_what_has_no_state_is_refused(demo):
    for kpi in (timing.latency(), user_tasks.user_task_assignee(mode="ALL")):
        with pytest.raises(KpiError):
            partial_states(demo, {"k": kpi})


def test_loads_are_not_merged_in_place(spark):
    with pytest.raises(KpiError):
        merge_loads(spark, {"e": latest.bpmn_error()}, "here", "here/")


def test_an_empty_load(spark, demo, tmp_path):
    wanted = pilot()
    add_load(demo, wanted, str(tmp_path), 0)
    add_load(demo.mapped(lambda _, table: table.filter("false")), wanted, str(tmp_path), 1)
    assert plain(record_of_loads(spark, wanted, str(tmp_path))) == plain(kpi_record(demo, wanted))
