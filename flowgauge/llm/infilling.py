"""Fill-in-the-middle: a text is cut into prefix, middle and suffix at unit borders and put in another order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A line with its end, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"
# The same unit for a repeated group: nothing inside of it is ever given back, so no match recurses or tries again.
_LINE_ONCE = r"[^\n]*+\n|[^\n]++"


def draws(id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that depend on seed and id alone: the first 8-digit groups of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substr(digest, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 7, percent: int = 100, spm_percent: int = 50,
    unit: str = LINE, unit_once: str = _LINE_ONCE,
) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    ``n`` counts the units of a text, matches of ``unit`` from left to right. A pattern made for the row, with
    possessive groups of exactly ``a`` and ``b - a`` units, then captures prefix, middle and suffix in one match;
    ``a`` and ``b`` are the smaller and larger of two draws below ``n + 1``. ``unit_once`` matches what ``unit`` does,
    with possessive quantifiers. Units have to cover the text.

    ``form`` is ``plain`` (the text as it is) if the text is empty or holds one of the marks, or for the share of
    documents that ``percent`` leaves out; else ``spm`` for ``spm_percent`` of them, ``psm`` for the others:

    - psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
    - spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

    ``prefix_chars`` and ``middle_chars`` count code points; they are null for ``plain``. A null text counts as empty.
    Draws depend on the id alone, so rows that share an id share them; a null id draws like an empty one. Texts of any
    length are matched whole, without recursion. All columns are passed on; columns named like the results are
    replaced. An empty table gives an empty result. Each row is worked on alone: there is no exchange.
    """
    h1, h2, h3, h4 = draws(docs[id], seed)
    whole = F.coalesce(docs[text], F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | whole.contains(mark)
    form = (
        F.when((whole == "") | marked | (h3 % 100 >= percent), "plain")
        .when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    )
    n = F.regexp_count(whole, F.lit(unit)).cast("bigint")
    # Bound once a row: the count and the draws are used several times below.
    counted = docs.withColumn("_fim", F.struct(
        whole.alias("text"), form.alias("form"), n.alias("n"), h1.alias("h1"), h2.alias("h2")
    ))
    row = {c: F.col(f"_fim.{c}") for c in ("text", "form", "n", "h1", "h2")}
    x, y = row["h1"] % (row["n"] + 1), row["h2"] % (row["n"] + 1)

    def units(times: Column) -> Column:
        return F.concat(F.lit(f"((?:{unit_once}){{"), times.cast("string"), F.lit("}+)"))

    pattern = F.concat(F.lit(r"\A"), units(F.least(x, y)), units(F.abs(x - y)), F.lit(r"((?s:.*+))\z"))
    spm, psm = f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"
    moved = F.regexp_replace(row["text"], pattern, F.when(row["form"] == "spm", spm).otherwise(psm))
    output = F.when(row["form"] == "plain", row["text"]).otherwise(moved)
    cut = counted.withColumns({"output": output, "n": row["n"], "form": row["form"]})
    prefix, middle, _ = parts(F.col("output"), F.col("form"))
    return cut.withColumns({
        "prefix_chars": F.length(prefix).cast("bigint"), "middle_chars": F.length(middle).cast("bigint"),
    }).drop("_fim")


def parts(output: Column, form: Column) -> list[Column]:
    """Prefix, middle and suffix of a transformed text; nulls if its form is ``plain``.

    No text with a mark is ever moved, so the first place of each mark is the border.
    """
    first, second = F.when(form == "spm", SUFFIX).otherwise(PREFIX), F.when(form == "spm", PREFIX).otherwise(SUFFIX)
    head = F.substring_index(output, MIDDLE, 1)
    middle = F.substr(output, F.length(head) + 1 + len(MIDDLE))
    rest = F.substr(head, F.length(first) + 1)
    one = F.when(form == "spm", F.substring_index(rest, PREFIX, 1)).otherwise(F.substring_index(rest, SUFFIX, 1))
    two = F.substr(rest, F.length(one) + F.length(second) + 1)
    moved = form != "plain"
    return [
        F.when(moved, F.when(form == "spm", two).otherwise(one)), F.when(moved, middle),
        F.when(moved, F.when(form == "spm", one).otherwise(two)),
    ]


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from."""
    return F.when(form == "plain", output).otherwise(F.concat(*parts(output, form)))

