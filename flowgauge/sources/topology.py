"""Flow topology: the edge list of each process definition, read from its XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns: an XML comment or character-data section, and the start tag of a
# sequence flow under any namespace prefix. Attribute values may hold ">".
_NOT_MARKUP = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_FLOW_TAG = r"""<(?:[\w.\-]+:)?sequenceFlow(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*>"""
_PREFIX = r"^<(?:[\w.\-]+:)?sequenceFlow"
_ATTRIBUTES_BEFORE = r"""^<[^\s/>]+(?:\s+[\w:.\-]+\s*=\s*(?:"[^"]*"|'[^']*'))*?\s+"""


def flow_topology(definitions: DataFrame) -> DataFrame:
    """``definitions(process_definition_key, xml)`` -> (process_definition_key, flow_id, source_ref, target_ref).

    Flows are found at any depth. A flow without id is skipped, an empty or missing end
    becomes null, and of two flows with one id the last counts. A document that is not
    well-formed, or declares a document type, contributes nothing and fails nothing.
    """
    well_formed = F.col("checked._bad").isNull() & ~F.col("xml").rlike("<!DOCTYPE")
    checked = definitions.select(
        "process_definition_key", "xml",
        F.from_xml(
            F.col("xml"), "_bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
        ).alias("checked"),
    )
    text = F.regexp_replace("xml", _NOT_MARKUP, "")
    tags = checked.filter(F.col("xml").isNotNull() & well_formed).select(
        "process_definition_key", F.posexplode(F.regexp_extract_all(text, F.lit(_FLOW_TAG), F.lit(0)))
        .alias("place", "tag")
    )
    flow_tag = F.col("tag")
    # A tag with an entity in it becomes a document of its own, for Spark's XPath to decode.
    opened = F.regexp_replace(F.regexp_replace(flow_tag, r"/?>$", "/>"), _PREFIX, "<sequenceFlow")

    def attribute(name: str):
        plain = _ATTRIBUTES_BEFORE + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)')"""
        value = F.when(
            F.contains(flow_tag, F.lit("&")), F.xpath_string(opened, F.lit(f"/*/@{name}"))
        ).otherwise(F.translate(
            F.concat(F.regexp_extract(flow_tag, plain, 1), F.regexp_extract(flow_tag, plain, 2)), "\t\r\n", "   "
        ))
        return F.when(value != "", value)

    flows = tags.select(
        "process_definition_key", "place", attribute("id").alias("flow_id"),
        F.struct(attribute("sourceRef").alias("source_ref"), attribute("targetRef").alias("target_ref")).alias("ends"),
    )
    return (
        flows.filter(F.col("flow_id").isNotNull())
        .groupBy("process_definition_key", "flow_id").agg(F.max_by("ends", "place").alias("ends"))
        .select("process_definition_key", "flow_id", "ends.source_ref", "ends.target_ref")
    )
