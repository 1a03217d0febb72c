"""Decisions about URLs: rules for hosts and paths, and templates of paths judged by labelled pages. Built-in functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest of ``rules``, pairs of action and text such as ``("allow", "org/")``, that fits.

    A rule fits its host and all subdomains where the path starts with the rule's. Both are null where none fits; of
    rules of the same length the first in the list counts.
    """
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        text, action = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(what)).otherwise(action)
    return text, action


def segments(path: Column) -> Column:
    """The parts of a path, empty ones left out, with what is a number or a long code in them replaced by ``*``."""
    parts = F.array_remove(F.split(path, "/"), "")
    return F.transform(parts, lambda part: F.regexp_replace(part, r"[0-9a-fA-F-]{16,}|[0-9]+", "*"))


def templates(
    shapes: DataFrame, depth: int = 8, least_rows: int = 20, distance: float = 2.0
) -> DataFrame:
    """``shapes`` (host, shape, parts, rows, labelled, good) with ``template``, its place in the host's tree.

    Level by level, the children of a node are compared with all of the node's pages. A child with fewer than
    ``least_rows`` pages is a variable segment; one whose share of good labels lies within ``distance`` standard errors of
    the node's is similar. Both are merged into the wildcard ``*``. Of the others, those above the node's share are compared
    with each other's pages in the same way and merged into ``*+`` where they are similar, those below into ``*-``; who is
    similar to none keeps a branch of its own. An only child keeps its name. What lies deeper than ``depth`` becomes one
    ``**``.
    """
    longest = shapes.agg(F.max(F.size("parts"))).first()[0] or 0
    tree = shapes.withColumn("template", F.lit(""))
    for level in range(min(depth, longest)):
        tree = stored(tree.withColumn("child", F.get("parts", F.lit(level))))
        counts = [F.sum(c).alias(c) for c in ("rows", "labelled", "good")]
        children = tree.filter("child IS NOT NULL").groupBy("host", "template", "child").agg(*counts)
        nodes = children.groupBy("host", "template").agg(*_pool("node"))
        placed = children.join(nodes, ["host", "template"])
        apart = (F.col("rows") >= least_rows) & _differs("node", distance)
        side = F.when(~apart, "*").when(_share("good", "labelled") > _share("node_good", "node_labelled"), "*+").otherwise("*-")
        placed = placed.withColumn("side", F.when(F.col("node_children") > 1, side).otherwise(F.col("child")))
        sides = placed.groupBy("host", "template", "side").agg(*_pool("side"))
        alone = (F.col("side") != "*") & ((F.col("side_children") == 1) | _differs("side", distance))
        chosen = placed.join(sides, ["host", "template", "side"]).select(
            "host", "template", "child", F.when(alone, F.col("child")).otherwise(F.col("side")).alias("branch")
        )
        tree = tree.join(chosen, ["host", "template", "child"], "left").withColumn(
            "template", F.concat("template", F.coalesce(F.concat(F.lit("/"), "branch"), F.lit("")))
        ).drop("branch", "child")
    deeper = F.size("parts") > depth
    return tree.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template")))


def _pool(name: str) -> list[Column]:
    counts = [F.sum(c).alias(f"{name}_{c}") for c in ("labelled", "good")]
    return [F.count("*").alias(f"{name}_children"), *counts]


def _share(good: str, labelled: str) -> Column:
    """One added page of either kind keeps shares away from 0 and 1."""
    return (F.col(good) + 1) / (F.col(labelled) + 2)


def _differs(pool: str, distance: float) -> Column:
    """Whether a child's share lies more than ``distance`` standard errors from the pool's."""
    share = _share(f"{pool}_good", f"{pool}_labelled")
    error = F.sqrt(share * (1 - share) / (F.col("labelled") + 2))
    return F.abs(_share("good", "labelled") - share) > distance * error


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url",
    threshold: float = 0.5, strength: float = 10.0, depth: int = 8, least_rows: int = 20,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` (allow or block).

    The longest of ``rules`` that fits decides. Otherwise the page's template does: it is rejected if the share of good
    pages among its labelled ones is below ``threshold``. Shares are smoothed by ``strength`` pages at the share of the
    host, itself smoothed by as many at the share of all labelled pages; a host without labels is judged by the latter.

    ``labels`` has the columns ``id`` and ``good`` (boolean); an id labelled more than once is good if all of its labels
    are. The tree is built over the different shapes of paths with their counts, not over pages. A null url, or one
    without ``://``, has an empty host and path, a null id no label. Repeated rows count as often as they occur. Without
    any label every page that no rule fits is allowed. All columns are passed on; columns named like the results are
    replaced. An empty table gives an empty result.
    """
    added = {"host": host_of(pages[url]), "path": path_of(pages[url])}
    placed = pages.withColumns({k: F.coalesce(v, F.lit("")) for k, v in added.items()})
    placed = placed.withColumn("_parts", segments(F.col("path"))).withColumn("_shape", F.array_join("_parts", "/"))
    known = labels.groupBy(F.col("id").alias("_id")).agg(F.bool_and("good").alias("_good"))
    narrow = placed.select(placed[id].alias("_page"), "host", F.col("_shape").alias("shape"), F.col("_parts").alias("parts"))
    shapes = narrow.join(known, F.col("_page") == F.col("_id"), "left").groupBy("host", "shape", "parts").agg(
        F.count("*").alias("rows"), F.count("_good").alias("labelled"), F.count_if("_good").alias("good")
    )
    tree = stored(templates(stored(shapes), depth, least_rows))
    whole = tree.agg(F.sum("good"), F.sum("labelled")).first()
    prior = whole[0] / whole[1] if whole[1] else 1.0
    counts = [F.sum(c).alias(c) for c in ("good", "labelled")]
    smooth = lambda share: (F.col("good") + strength * share) / (F.col("labelled") + strength)
    hosts = tree.groupBy("host").agg(*counts).select("host", smooth(F.lit(prior)).alias("share"))
    judged = tree.groupBy("host", "template").agg(*counts).join(hosts, "host").select(
        "host", "template", smooth(F.col("share")).alias("purity")
    )
    of_shape = tree.select("host", "shape", "template").join(judged, ["host", "template"]).select(
        F.col("host").alias("_host"), F.col("shape").alias("_of"), "template", "purity"
    )
    kept = [c for c in placed.columns if c not in ("template", "purity")]
    joined = placed.select(*kept).join(
        of_shape, (F.col("host") == F.col("_host")) & (F.col("_shape") == F.col("_of")), "left"
    )
    rule, action = first_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < threshold, "block").otherwise("allow")
    return joined.withColumns({"rule": rule, "verdict": F.coalesce(action, method)}).drop(
        "_host", "_of", "_shape", "_parts"
    )
