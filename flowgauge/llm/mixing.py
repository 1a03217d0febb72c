"""Mixing of sources to target weights by entropy balancing, all in built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import exp, floor, nextafter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import let, row_key, stored, unit_hash, word_count


def capped_targets(sizes: dict, weights: dict, most: float = 3.0) -> dict[object, float]:
    """Shares of the whole size by weight, none above ``most`` times its source; the excess is shared out again.

    Sources at their limit are taken out and the rest is shared by weight among the others, until none is above.
    """
    rest, open_, targets = float(sum(sizes.values())), dict(weights), {}
    while open_:
        total = sum(open_.values())
        over = [s for s in open_ if rest * open_[s] / total > most * sizes[s]]
        if not over:
            targets |= {s: rest * w / total for s, w in open_.items()}
            break
        for s in over:
            targets[s] = most * sizes[s]
            del open_[s]
        rest -= sum(targets[s] for s in over)
    return targets


def balance(
    rows: DataFrame, source: str, size: str, targets: dict, tolerance: float = 1e-9, most: int = 50
) -> dict[object, float]:
    """The multiplier of each source in the convex dual of entropy balancing.

    Among all rates r > 0 that meet the token constraints (sum of size * r over each source = its target) the ones with
    the least entropy relative to taking everything once are r = exp(multiplier). The dual function is the sum of
    size * exp(multiplier) less multiplier * target. A Newton iteration needs its gradient and Hessian: token sums of
    the tilted rows, combined before the shuffle, one row per source. The Hessian is diagonal, as every document lies in
    one source. Sources without tokens, and targets of 0, have no multiplier.
    """
    at = {s: 0.0 for s, t in targets.items() if t > 0}
    for _ in range(most):
        # Tilted token sums are both the gradient's first term and the Hessian's diagonal.
        tilt = F.exp(_by_source(F.col(source), at))
        sums = rows.groupBy(source).agg(F.sum(F.col(size) * tilt).alias("tilted")).collect()
        tilted = {r[source]: r["tilted"] for r in sums if r["tilted"] and r[source] in at}
        off = max((abs(v - targets[s]) / targets[s] for s, v in tilted.items()), default=0.0)
        if off <= tolerance:
            break
        at |= {s: at[s] - (v - targets[s]) / v for s, v in tilted.items()}
    return at


def _by_source(source: Column, values: dict, default: float = 0.0) -> Column:
    """A source's value, by a lookup in a constant map. The mix names its sources, so their number is bounded."""
    known = [(s, v) for s, v in values.items() if s is not None]
    none = F.lit(float(values.get(None, default)))
    if not known:
        return none
    pairs = F.map_from_arrays(F.array(*(F.lit(s) for s, _ in known)), F.array(*(F.lit(float(v)) for _, v in known)))
    return F.when(source.isNull(), none).otherwise(F.coalesce(F.try_element_at(pairs, source), F.lit(default)))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, id: str = "doc_id", text: str = "text",
    source: str = "source", bins: int = 1024, rounds: int = 4, seed: int = 4,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``, how often the mix takes the document.

    The size of a document is its number of words. Sources, in the order of their code points with null last, weigh
    ``weights`` in turn; the mix is as large as all documents, and no source is taken more than ``most`` times
    (``capped_targets``). ``rate`` is the exponential tilt that ``balance`` finds; it is rounded into whole copies:
    everyone gets its integer part, and documents get one more in an order by hash until the source's target is met.
    Those that would go beyond it are skipped, and the order is gone through again, ``rounds`` times in all, for documents
    that still fit (``one_more``). The outcome is a few numbers for each source, applied to every row where it stands:
    whole texts are not exchanged, and a source with a third of all rows meets in no task. Reruns agree.

    Rows equal in id and text have one place in the order. Where not all of them fit, as many as fit get one more copy;
    only such rows are written once, so that they can be told apart by where they stand.

    A null text has size 0. All columns are passed on; columns named like the results are replaced. An empty table gives
    an empty result.
    """
    k1, k2 = row_key(docs[id], docs[text])
    place = unit_hash(k1, k2, seed=seed)
    sized = docs.withColumns({
        "size": word_count(docs[text]), "_place": place, "_source": docs[source].cast("string"),
    })
    narrow = stored(sized.select(F.col("_source").alias("source"), "size", F.col("_place").alias("place")))
    sizes = {r["source"]: r["size"] for r in narrow.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = capped_targets(sizes, {s: weights[k % len(weights)] for k, s in enumerate(order)}, most)
    rates = {s: min(exp(v), most) for s, v in balance(narrow, "source", "size", targets).items()}
    whole = {s: floor(r + 1e-6) for s, r in rates.items()}
    rules, parts = one_more(narrow, {s: round(targets[s]) - whole[s] * sizes[s] for s in rates}, bins, rounds)
    of = F.col("_source")

    def mixed(rows: DataFrame, taken: Callable[[Column], Column]) -> DataFrame:
        return rows.withColumns({
            "source_size": _by_source(of, sizes).cast("bigint"), "target": _by_source(of, targets),
            "rate": _by_source(of, rates),
            # Bound once: a filter on copies would otherwise count the words again for every rule.
            "copies": let(F.struct("size", "_place"), lambda row: (
                _by_source(of, whole) + taken(row).cast("int")
            ).cast("int")),
        }).drop("_place", "_source")

    def by_rule(row: Column) -> Column:
        return _taken(rules, of, row["size"], row["_place"])

    if not parts:
        return mixed(sized, by_rule)
    split = reduce(Column.__or__, (of.eqNullSafe(F.lit(s)) & (F.col("_place") == p) for s, p in parts))
    apart = stored(sized.filter(split).withColumn("_row", F.monotonically_increasing_id()))
    # Rules take none of a split group, so its row alone says whether a document gets one more.
    among = reduce(Column.__or__, (
        of.eqNullSafe(F.lit(s)) & (F.col("_place") == p) & (F.col("_row") < last)
        for (s, p), last in _first_rows(apart, parts).items()
    ))
    return mixed(sized.filter(~split), by_rule).unionByName(mixed(apart, lambda _: among).drop("_row"))


def _first_rows(apart: DataFrame, parts: dict[tuple, int]) -> dict[tuple, int]:
    """For each group of equal rows the ``_row`` that has so many of the group's rows before it as ``parts`` says.

    Rows are counted per task that numbered them; only the rows of the task where a count is reached are looked at.
    """
    task = F.shiftright("_row", 33)
    counts = apart.groupBy("_source", "_place", task.alias("task")).agg(F.count("*").alias("n")).collect()
    ends: dict[tuple, int] = {}
    for (s, p), m in parts.items():
        for r in sorted((r for r in counts if (r["_source"], r["_place"]) == (s, p)), key=lambda r: r["task"]):
            if m <= r["n"]:
                rows = apart.filter(F.col("_source").eqNullSafe(F.lit(s)) & (F.col("_place") == p) & (task == r["task"]))
                ends[s, p] = rows.agg(F.sort_array(F.collect_list("_row"))[m - 1].alias("last")).first()["last"] + 1
                break
            m -= r["n"]
    return ends


def _taken(rules: list[tuple[dict, dict]], source: Column, size: Column, place: Column) -> Column:
    taken = F.lit(False)
    for limit, end in rules:
        taken = taken | ((size <= _by_source(source, limit)) & (place < _by_source(source, end)))
    return taken


def one_more(
    narrow: DataFrame, missing: dict, bins: int = 1024, rounds: int = 4
) -> tuple[list[tuple[dict, dict]], dict[tuple, int]]:
    """Which documents get one more copy, so that each source's sizes add up to nearly what is ``missing``.

    A rule (limit, end) takes the documents of a source that are no larger than its limit and come before its end. The
    limit is what is still missing; the end is the first document that does not fit, found by sums over cells of the
    order, refined around it. At most ``bins`` sums for each source reach the driver at a time. Of a group of equal rows
    at an end, which share a (source, place), the number that fits is given besides the rules, which take none of it.
    """
    source, size, place = F.col("source"), F.col("size"), F.col("place")
    rules: list[tuple[dict, dict]] = []
    parts: dict[tuple, int] = {}
    left = {s: m for s, m in missing.items() if m > 0}
    for _ in range(rounds):
        rest = narrow.filter((size > 0) & (size <= _by_source(source, left)) & ~_taken(rules, source, size, place))
        open_ = {s: (0.0, 1.0, 0) for s in left}
        ends: dict = {}
        got = dict.fromkeys(left, 0)
        while open_:
            low = _by_source(source, {s: v[0] for s, v in open_.items()}, 2.0)
            high = _by_source(source, {s: v[1] for s, v in open_.items()}, -2.0)
            cell = F.when(high > low, F.least(F.floor((place - low) / (high - low) * bins), F.lit(bins - 1))).otherwise(0)
            sums = rest.filter(place.between(low, high)).groupBy("source", cell.alias("cell")).agg(
                F.sum("size").alias("sum"), F.min("place").alias("first"), F.max("place").alias("last"),
                F.max("size").alias("each"),
            ).collect()
            for s, (_, _, below) in list(open_.items()):
                del open_[s]
                ends[s], got[s] = 2.0, below
                for r in sorted((r for r in sums if r["source"] == s), key=lambda r: r["cell"]):
                    if below + r["sum"] > left[s]:
                        ends[s], got[s] = r["first"], below
                        if r["first"] < r["last"]:
                            open_[s] = (r["first"], r["last"], below)
                        elif fit := (left[s] - below) // r["each"]:
                            # Some of several equal rows fit (of a single one, none); the others are too large from here on.
                            parts[s, r["first"]] = fit
                            got[s] += fit * r["each"]
                        break
                    below += r["sum"]
                    got[s] = below
        rules.append((left, ends))
        left = {s: m - got[s] for s, m in left.items() if m > got[s]}
        if not left or not any(got.values()):
            break
    last, more = _nearest(narrow, left, rules, parts)
    return [*rules, last], parts | more


def _nearest(
    narrow: DataFrame, left: dict, rules: list[tuple[dict, dict]], parts: dict[tuple, int]
) -> tuple[tuple[dict, dict], dict[tuple, int]]:
    """The smallest document that is not taken, where the source comes nearer to its target with it.

    It is named by a rule, or by the number of rows to take if it is one of several equal rows.
    """
    source, size, place = F.col("source"), F.col("size"), F.col("place")
    rest = narrow.filter((_by_source(source, left) > 0) & (size > 0) & ~_taken(rules, source, size, place))
    groups = rest.groupBy("source", "size", "place").agg(F.count("*").alias("n"))
    for (s, p), m in parts.items():
        groups = groups.filter(~(source.eqNullSafe(F.lit(s)) & (place == p)) | (F.col("n") > m))
    least = groups.groupBy("source").agg(F.min(F.struct("size", "place", "n")).alias("least")).collect()
    chosen = {r["source"]: r["least"] for r in least if r["least"]["size"] < 2 * left[r["source"]]}
    equal = {(s, r["place"]): parts.get((s, r["place"]), 0) + 1 for s, r in chosen.items() if r["n"] > 1}
    alone = {s: r for s, r in chosen.items() if r["n"] == 1}
    rule = {s: r["size"] for s, r in alone.items()}, {s: nextafter(r["place"], 2.0) for s, r in alone.items()}
    return rule, equal
