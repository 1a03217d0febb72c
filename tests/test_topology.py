from flowgauge.schemas import SCHEMAS
from flowgauge.sources.topology import flow_topology

DOCUMENTS = {
    1: """<?xml version="1.0"?>
<bpmn:definitions xmlns:bpmn="http://www.omg.org/spec/BPMN/20100524/MODEL"><bpmn:process id="p">
  <bpmn:sequenceFlow id="top" sourceRef="a" targetRef="b" />
  <bpmn:subProcess id="s"><bpmn:subProcess id="t">
    <bpmn:sequenceFlow name="x &gt; 1" id='deep'
        sourceRef='c'
        targetRef="d"><bpmn:conditionExpression>=x > 1</bpmn:conditionExpression></bpmn:sequenceFlow>
  </bpmn:subProcess></bpmn:subProcess>
  <!-- <bpmn:sequenceFlow id="comment" sourceRef="a" targetRef="b"/> -->
  <bpmn:documentation><![CDATA[<bpmn:sequenceFlow id="data" sourceRef="a" targetRef="b"/>]]></bpmn:documentation>
  <bpmn:sequenceFlow sourceRef="no" targetRef="id"/>
  <bpmn:sequenceFlow id="ends" sourceRef=""/>
  <bpmn:sequenceFlow name="a > b id='fake'" xml:id="other" id="quoted" sourceRef="e&amp;f" targetRef="g"/>
  <bpmn:sequenceFlowing id="longer" sourceRef="a" targetRef="b"/>
  <bpmn:sequenceFlow id="twice" sourceRef="old" targetRef="old"/>
  <bpmn:sequenceFlow id="twice" sourceRef="new" targetRef="new"/>
</bpmn:process></bpmn:definitions>""",
    2: '<definitions xmlns="urn:x"><sequenceFlow id="plain" sourceRef="a" targetRef="b"/></definitions>',
    3: '<model.x:definitions xmlns:model.x="urn:x"><model.x:sequenceFlow id="dotted" targetRef="b"/></model.x:definitions>',
    4: '<definitions><sequenceFlow id="bad" sourceRef="a" targetRef="b"/>',
    5: '<!DOCTYPE d><definitions><sequenceFlow id="typed" sourceRef="a" targetRef="b"/></definitions>',
    6: None,
    7: "not xml at all",
}


def test_edges(spark):
    definitions = spark.createDataFrame(list(DOCUMENTS.items()), SCHEMAS["definitions"])
    edges = {tuple(row) for row in flow_topology(definitions).collect()}
    assert edges == {
        (1, "top", "a", "b"), (1, "deep", "c", "d"), (1, "ends", None, None), (1, "quoted", "e&f", "g"),
        (1, "twice", "new", "new"), (2, "plain", "a", "b"), (3, "dotted", None, "b"),
    }
