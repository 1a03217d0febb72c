"""KPIs of instances as they close: an instance closes when it has been silent for a while."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.errors import bad_input
from flowgauge.functions.clock import as_instant, as_utc, micros_of
from flowgauge.operators.kpi import Inputs, Kpi, Measure, Ordered
from flowgauge.plans.record import Pilot, checked_pilot
from flowgauge.schemas import KEY

_DELAY = r"(\d+)\s*(ms|milliseconds?|seconds?|minutes?|hours?|days?)?"


def delay_interval(delay: int | str) -> str:
    """``wait`` in milliseconds, or an interval such as ``10 minutes``; never negative."""
    found = re.fullmatch(_DELAY, str(delay).strip().lower())
    if not found:
        raise bad_input(f"a delay is a number of milliseconds or an interval, zero or more; got {delay!r}")
    unit = found[2] or "milliseconds"
    return f"{found[1]} {'milliseconds' if unit == 'ms' else unit}"


def kpi_on_close(elements: DataFrame, pilot: Pilot, gap: str, delay: int | str) -> DataFrame:
    """A stream (or table) of elements -> one row per instance and session.

    A session ends after ``gap`` without a new element. ``delay`` is how long to wait
    for rows that are exported late; later ones are dropped. On a stream a session is
    emitted once the watermark has passed its end, so the last ones stay open. A table
    gives all sessions, whatever the delay.

    Rows of an instance that share no start are combined before the shuffle only where
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is set; set it
    for instances with very many elements.

    Every KPI made of aggregates over the element log may be used, and those that go by the
    order of its elements (``latency``, descriptions of user tasks). The latter are computed
    minute by minute: once the watermark has passed a minute, its elements are put in order and
    become one value, so what is kept of an open session is its minutes, not its elements, and
    late elements take their places. A session is then emitted a minute later.
    """
    late = delay_interval(delay)
    kpis = checked_pilot(pilot)
    for name, kpi in kpis.items():
        tables = {measure.table for measure in _measures(kpi).values()}
        if (kpi.frame and not kpi.ordered) or kpi.variables or tables - {"element_instances"}:
            raise bad_input(f"the KPI [{name}] needs more than the element log and cannot follow a stream")
    if any(kpi.ordered for kpi in kpis.values()):
        return _in_order(elements, kpis, gap, late)

    measures = {
        (name, part): measure for name, kpi in kpis.items() for part, measure in _measures(kpi).items()
    }
    # Measures bring their own row conditions; every element keeps its session going.
    started = elements.filter(F.col("start_date").isNotNull()).withColumn("_at", as_instant(F.col("start_date")))
    sessions = started.withWatermark("_at", late).groupBy(F.session_window("_at", gap), KEY).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(measure.aggregate.alias("_".join(("_measure", *place))) for place, measure in measures.items()),
    )

    def finished(name: str, kpi: Kpi):
        parts = {part: F.col("_".join(("_measure", name, part))) for part in _measures(kpi)}
        return kpi.finish(Inputs(_spine, parts, _spine, None)).alias(name)

    return sessions.select(
        KEY, as_utc(F.col("session_window.start")).alias("session_start"),
        as_utc(F.col("session_window.end")).alias("session_end"),
        *(finished(name, kpi) for name, kpi in kpis.items()),
    )


def _spine(name: str) -> Column:
    if name != KEY:
        raise bad_input(f"the instance's {name} is not part of the element log")
    return F.col(KEY)


#: Elements of an instance are put in order within slots of this width; sessions are apart by more.
SLOT = "1 minute"


def _in_order(elements: DataFrame, kpis: Mapping[str, Kpi], gap: str, late: str) -> DataFrame:
    """Two stateful steps: elements to slots, slots to sessions.

    A session window sees a slot at the slot's end, so it is given the slot's width more than ``gap``: it never parts
    what belongs together. What it joined beyond ``gap`` is parted afterwards, by the first and last start of each slot.
    """
    width, apart = elements.sparkSession.sql("VALUES (1)").select(_micros(SLOT), _micros(gap)).first()
    if apart < width:
        raise bad_input(f"sessions whose elements are put in order are apart by {SLOT} or more, not {gap}")
    pieces = {}
    for position, (name, kpi) in enumerate(kpis.items()):
        for part, measure in kpi.measures.items():
            if measure.state is None:
                raise bad_input(f"the KPI [{name}] has no mergeable state and cannot go with one that needs an order")
            for key, column in measure.state.parts.items():
                pieces[f"m{position}_{part}_{key}"] = column
    ordered = {f"o{position}": kpi.ordered for position, kpi in enumerate(kpis.values()) if kpi.ordered}

    def names(position: int, part: str) -> Callable[[str], str]:
        return lambda key: f"m{position}_{part}_{key}"

    lookups = {
        column: names(position, part) for position, kpi in enumerate(kpis.values())
        for part, measure in kpi.measures.items() for column in map(names(position, part), measure.state.parts)
    }
    row = F.struct("start_date", "element_instance_key", *(
        column.alias(f"{name}_{key}") for name, kpi in ordered.items() for key, column in kpi.row.items()
    ))
    started = elements.filter(F.col("start_date").isNotNull()).select(
        KEY, as_instant(F.col("start_date")).alias("_at"), row.alias("_row"),
        *(part.row.alias(column) for column, part in pieces.items()),
    )
    slots = started.withWatermark("_at", late).groupBy(F.window("_at", SLOT), KEY).agg(
        F.min("_at").alias("first"), F.max("_at").alias("last"), F.sort_array(F.collect_list("_row")).alias("rows"),
        *(part.merge(lambda key, column=column: F.col(lookups[column](key))).alias(column) for column, part in pieces.items()),
    )

    def seen_by(name: str, kpi: Ordered) -> Column:
        own = F.transform("rows", lambda r: F.struct(
            r["start_date"].alias("start_date"), r["element_instance_key"].alias("element_instance_key"),
            *(r[f"{name}_{key}"].alias(key) for key in kpi.row),
        ))
        return kpi.slot(own).alias(name)

    slot = F.struct("first", "last", *pieces, *(seen_by(name, kpi) for name, kpi in ordered.items()))
    seen = slots.select(KEY, F.window_time("window").alias("_at"), "last", slot.alias("slot"))
    wider = F.unix_micros("last") - F.unix_micros("_at") + _micros(gap) + _micros(SLOT)
    open_until = F.make_interval(secs=(wider / 1_000_000).cast("decimal(18,6)"))
    sessions = seen.groupBy(F.session_window("_at", open_until), KEY).agg(F.sort_array(F.collect_list("slot")).alias("slots"))

    def far(i: Column) -> Column:
        before, here = F.get("slots", i - 1), F.get("slots", i)
        return F.unix_micros(here["first"]) > F.unix_micros(before["last"]) + _micros(gap)

    size = F.size("slots")
    cuts = F.concat(F.array(F.lit(0)), F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i > 0) & far(i)))
    parted = sessions.select(KEY, "slots", cuts.alias("cuts")).select(KEY, F.explode(F.transform(
        "cuts", lambda start, k: F.slice("slots", start + 1, F.coalesce(F.get("cuts", k + 1), size) - start)
    )).alias("slots"))

    def folded(a: Column, b: Column) -> Column:
        made = [a["first"].alias("first"), F.greatest(a["last"], b["last"]).alias("last")]
        for column, part in pieces.items():
            of = lookups[column]
            made.append(part.fold(lambda key, of=of: a[of(key)], lambda key, of=of: b[of(key)]).alias(column))
        made += [kpi.fold(a[name], b[name]).alias(name) for name, kpi in ordered.items()]
        return F.struct(*made)

    whole = parted.select(KEY, F.aggregate(F.slice("slots", F.lit(2), F.size("slots")), F.get("slots", F.lit(0)), folded).alias("all"))

    def finished(position: int, name: str, kpi: Kpi) -> Column:
        parts = {
            part: measure.state.value(lambda key, part=part: F.col("all")[names(position, part)(key)])
            for part, measure in kpi.measures.items()
        }
        frame = kpi.ordered.value(F.col("all")[f"o{position}"]) if kpi.ordered else None
        return kpi.finish(Inputs(_spine, parts, _spine, frame)).alias(name)

    end = F.timestamp_micros(F.unix_micros(F.col("all")["last"]) + _micros(gap))
    return whole.select(
        KEY, as_utc(F.col("all")["first"]).alias("session_start"), as_utc(end).alias("session_end"),
        *(finished(position, name, kpi) for position, (name, kpi) in enumerate(kpis.items())),
    )


def _micros(interval: str) -> Column:
    return micros_of(F.expr(f"CAST(INTERVAL {interval} AS INTERVAL DAY TO SECOND)"))


def _measures(kpi: Kpi) -> Mapping[str, Measure]:
    return kpi.stream_measures or kpi.measures
