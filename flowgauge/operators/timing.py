"""KPIs on elapsed time: duration between two elements, queueing latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.errors import is_blank, required
from flowgauge.functions.clock import in_unit, micros_between, minute_slot, packed_order, whole_div
from flowgauge.operators import states
from flowgauge.operators.filters import element_is
from flowgauge.operators.kpi import Kpi, Measure, Ordered, all_of, measured
from flowgauge.operators.skew import SALT, repeated, salted
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs


def start_order() -> Column:
    """The order of "first": by start, then by key; elements without a start come last."""
    return packed_order(F.col("start_date"), F.col("element_instance_key"))


def _moment(reference: str, match: str) -> Measure:
    """First known start or end of ``id``, ``id:START`` or ``id:END``."""
    element_id, _, edge = (part.strip() for part in reference.partition(":"))
    moment = F.col("start_date" if edge.upper() == "START" else "end_date")
    known = all_of(element_is(required(element_id, "the element id"), match=match), moment.isNotNull())
    keep = {"element_id": (element_id,)} if match == "id" else {}
    if edge.upper() == "START":
        started = F.when(known, moment)
        return Measure("element_instances", F.min(started), keep, state=states.least(started))
    order = F.when(known, start_order())
    return Measure("element_instances", F.min_by(moment, order), keep, state=states.first_by(moment, order), ended=True)


def duration(from_element: str, to_element: str, unit: str = "MS", match: str = "id") -> Kpi:
    """Time from one element to another; each end is the first non-null one. May be negative."""
    return measured(
        lambda inputs: in_unit(micros_between(inputs["begin"], inputs["until"]), unit),
        begin=_moment(required(from_element, "the first element"), match),
        until=_moment(required(to_element, "the second element"), match),
    )


def _millis(start: Column, end: Column) -> Column:
    return whole_div(micros_between(start, end), 1000)


def _gap(end: Column, following: Column) -> Column:
    return F.greatest(_millis(end, following), F.lit(0).cast("bigint"))


def _followed(logs: ProcessLogs, key: str) -> tuple[DataFrame, DataFrame]:
    """Starts of an instance and its minutes, each with the start that follows.

    Elements of one start are summed up first, before any exchange: all but the last of
    them are followed at that start. ``lead`` then runs over the different starts within
    one minute of one instance, and once more over the minutes of the instance, each
    summed up by its first start and the end of its last element. No task ever sorts a
    whole instance, nor a busy instant.
    """
    start, end = F.col("start_date"), F.col("end_date")
    last_end = F.max_by(end, F.col("element_instance_key"))
    starts = (
        logs.element_instances.filter(start.isNotNull()).groupBy(key, start)
        .agg((F.sum(_gap(end, start)) - _gap(last_end, start)).alias("tied"), last_end.alias("end_date"))
    )
    within = Window.partitionBy(key, "slot").orderBy("start_date")
    rows = starts.withColumn("slot", minute_slot(start)).withColumn("following", F.lead("start_date").over(within))
    is_last = F.col("following").isNull()
    slots = rows.groupBy(key, "slot").agg(
        F.sum(F.col("tied") + _gap(end, F.col("following"))).alias("waited"),
        F.min("start_date").alias("first_start"),
        F.max(F.when(is_last, end)).alias("last_end"),
    )
    across = Window.partitionBy(key).orderBy("slot")
    return rows, slots.withColumn("following", F.lead("first_start").over(across))


def _waits(logs: ProcessLogs, key: str) -> DataFrame:
    """Sum of the positive gaps between consecutive elements of an instance."""
    _, slots = _followed(logs, key)
    return slots.groupBy(key).agg(
        (F.coalesce(F.sum("waited"), F.lit(0))
         + F.coalesce(F.sum(_gap(F.col("last_end"), F.col("following"))), F.lit(0))).alias("value")
    )


def gaps(logs: ProcessLogs) -> DataFrame:
    """The positive gaps of ``_waits``, each from the start that ends it: ``_at`` and ``gap``.

    As of any moment the gaps that have ended add up to the wait so far: an element that has not ended is not followed
    by a gap yet, and later starts do not change which element follows which.
    """
    rows, slots = _followed(logs, KEY)
    ends = F.array(
        F.struct(F.col("start_date").alias("_at"), F.col("tied").alias("gap")),
        F.struct(F.col("following").alias("_at"), _gap(F.col("end_date"), F.col("following")).alias("gap")),
    )
    inside = rows.select(KEY, F.inline(ends))
    across = slots.select(KEY, F.col("following").alias("_at"), _gap(F.col("last_end"), F.col("following")).alias("gap"))
    return inside.unionByName(across).filter("gap > 0")


def _first_run(logs: ProcessLogs, key: str, element_id: str) -> DataFrame:
    """``ended`` and ``started`` of an element's first run, and ``following``, the next start of another element."""
    started = logs.element_instances.filter(F.col("start_date").isNotNull())
    first = (
        started.filter(element_is(element_id)).groupBy(key)
        .agg(F.min_by(F.struct("end_date", "element_instance_key", "start_date"), start_order()).alias("first"))
        .select(
            key, F.col("first.end_date").alias("ended"), F.col("first.element_instance_key").alias("first_key"),
            F.col("first.start_date").alias("started"),
        )
    )
    following = (
        salted(started.select(key, "start_date", "element_instance_key"), "element_instance_key")
        .join(repeated(first.filter(F.col("ended").isNotNull())), [key, SALT])
        .filter((F.col("start_date") >= F.col("ended")) & (F.col("element_instance_key") != F.col("first_key")))
        .groupBy(key).agg(F.min("start_date").alias("following"))
    )
    return first.join(following, key, "left")


def _wait_after(logs: ProcessLogs, key: str, element_id: str) -> DataFrame:
    """Gap between the end of an element's first run and the next start of another element."""
    wait = F.coalesce(_millis(F.col("ended"), F.col("following")), F.lit(0).cast("bigint"))
    return _first_run(logs, key, element_id).select(key, F.when(F.col("ended").isNotNull(), wait).alias("value"))


def wait_steps(logs: ProcessLogs, element_id: str) -> DataFrame:
    """The value of ``_wait_after`` over time: 0 once the first run has ended, its wait once another element starts.

    ``step`` tells the two apart where they come at one moment.
    """
    first = _first_run(logs, KEY, element_id).filter(F.col("ended").isNotNull())
    known = F.greatest("started", "ended")
    zero = F.lit(0).cast("bigint")
    steps = F.array(
        F.struct(known.alias("_at"), F.lit(0).alias("step"), zero.alias("wait")),
        F.struct(F.when(F.col("following").isNotNull(), F.greatest(known, "following")).alias("_at"), F.lit(1).alias("step"),
                 _millis(F.col("ended"), F.col("following")).alias("wait")),
    )
    return first.select(KEY, F.inline(steps)).filter(F.col("_at").isNotNull())


def _total_in_order() -> Ordered:
    """The wait of a span, its first start and the end of its last element: what two spans need to become one."""
    def joined(first: Column, last_end: Column, waited: Column) -> Column:
        return F.struct(first.alias("first"), last_end.alias("last_end"), waited.alias("waited"))

    def slot(rows: Column) -> Column:
        between = F.zip_with(rows, F.slice(rows, F.lit(2), F.size(rows)), lambda a, b: _gap(a["end_date"], b["start_date"]))
        waited = F.aggregate(between, F.lit(0).cast("bigint"), lambda total, gap: total + gap)
        return joined(F.get(rows, F.lit(0))["start_date"], F.element_at(rows, -1)["end_date"], waited)

    def fold(a: Column, b: Column) -> Column:
        return joined(a["first"], b["last_end"], a["waited"] + b["waited"] + _gap(a["last_end"], b["first"]))

    return Ordered({"end_date": F.col("end_date")}, slot, fold, lambda all_: all_["waited"])


def _after_in_order(element_id: str) -> Ordered:
    """The element's first run, and the starts of a span: of each start the smallest and largest key, to tell others."""
    def slot(rows: Column) -> Column:
        run = F.get(F.filter(rows, lambda r: r["is_it"]), F.lit(0))
        edge = F.filter(rows, lambda r, i: (
            (i == 0) | (i == F.size(rows) - 1)
            | (F.get(rows, i - 1)["start_date"] != r["start_date"]) | (F.get(rows, i + 1)["start_date"] != r["start_date"])
        ))
        starts = F.transform(edge, lambda r: F.struct(r["start_date"].alias("at"), r["element_instance_key"].alias("key")))
        first = F.when(run.isNotNull(), F.struct(
            run["element_instance_key"].alias("key"), run["end_date"].alias("ended"), _following(starts, run).alias("following")
        ))
        return F.struct(first.alias("first"), starts.alias("starts"))

    def _following(starts: Column, run: Column) -> Column:
        return F.get(F.filter(starts, lambda s: (s["at"] >= run["end_date"]) & (s["key"] != run["element_instance_key"])), F.lit(0))["at"]

    def fold(a: Column, b: Column) -> Column:
        run = a["first"]
        later = F.get(F.filter(b["starts"], lambda s: (s["at"] >= run["ended"]) & (s["key"] != run["key"])), F.lit(0))["at"]
        known = F.struct(run["key"].alias("key"), run["ended"].alias("ended"), F.coalesce(run["following"], later).alias("following"))
        # Before the first run, starts do not matter unless it ended before it began.
        own = b["first"]
        earlier = F.get(F.filter(a["starts"], lambda s: (s["at"] >= own["ended"]) & (s["key"] != own["key"])), F.lit(0))["at"]
        new = F.struct(own["key"].alias("key"), own["ended"].alias("ended"), F.coalesce(earlier, own["following"]).alias("following"))
        first = F.when(run.isNotNull(), known).when(own.isNotNull(), new)
        waiting = run.isNull() & own.isNull()
        return F.struct(first.alias("first"), F.when(waiting, F.concat(a["starts"], b["starts"])).otherwise(b["starts"]).alias("starts"))

    def value(all_: Column) -> Column:
        ended = all_["first"]["ended"]
        wait = F.coalesce(_millis(ended, all_["first"]["following"]), F.lit(0).cast("bigint"))
        return F.when(ended.isNotNull(), wait)

    is_it = F.coalesce(element_is(element_id), F.lit(False))
    return Ordered({"end_date": F.col("end_date"), "is_it": is_it}, slot, fold, value)


def latency(element_id: str | None = None) -> Kpi:
    """Milliseconds the instance spent waiting, in total or right after one element.

    In total: 0 when nothing waited. After an element: null when it did not run or
    has not ended, 0 when nothing followed.
    """
    if is_blank(element_id):
        swept = Measure("element_instances", F.sum("gap"), state=states.total(F.col("gap")), rows=gaps)
        return Kpi(lambda inputs: F.coalesce(inputs.frame, F.lit(0).cast("bigint")), frame=_waits, swept=swept, ordered=_total_in_order())
    newest = packed_order(F.col("_at"), F.col("step"))
    return Kpi(
        lambda inputs: inputs.frame, frame=lambda logs, key: _wait_after(logs, key, element_id),
        swept=Measure(
            "element_instances", F.max_by("wait", newest), state=states.last_by(F.col("wait"), newest),
            rows=lambda logs: wait_steps(logs, element_id),
        ),
        ordered=_after_in_order(element_id),
    )
