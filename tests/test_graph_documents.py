from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from sparquill.operators import documents, enrich, graph, guided
from sparquill.plans.rules import ABSTAIN_FINANCE, ABSTAIN_INTERPRET, ABSTAIN_STRONG
from sparquill.sources import files, sinks, statutes
from sparquill.staging import settings
from sparquill.streaming import ingest

REFERENCES = [
    ("6 §:n 2 momentissa", [(6, "2", "6 §:n 2 mom")]),
    ("6 §:n 2 momentissa ja 6 §:ssä", [(6, "2", "6 §:n 2 mom")]),
    ("3 luvun 5 §", [(5, None, "3 luvun 5 §")]),
    ("3 luvun 5 §:n", [(5, None, "5 §:n")]),
    ("110 a §", []),
    ("7 §:n 1 momentti ja 7 §:n 2 momentti, 9 §", [(7, "1", "7 §:n 1 momentti"), (7, "2", "7 §:n 2 momentti"), (9, None, "9 §")]),
    ("", []),
    (None, []),
]


def test_section_references(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REFERENCES)], "k int, text string")
    got = graph.section_references(rows, "k").collect()
    for i, (_, want) in enumerate(REFERENCES):
        assert [(r.section, r.moment, r.context) for r in sorted(got, key=lambda r: r.ref_no) if r.k == i] == want


def nodes_frame(spark, texts):
    rows = [(f"1/2000:v1:{s}:{m}", "1/2000", "1/2000", "v1", s, m, "t", x) for s, m, x in texts]
    return spark.createDataFrame(rows, "node_id string, law_id string, law_key string, version string, section_num int, moment string, section_title string, text string")


def test_reference_edges(spark):
    nodes = nodes_frame(spark, [(1, "1", "Jollei 2 §:n 1 momentissa toisin säädetä, 1 §:ssä"), (2, "1", "Tässä laissa tarkoitetaan kirjanpitolain (1336/1997) ja kirjanpitolakia sekä hankintalakia"), (3, "1", "Katso 8 §:n 2 mom. ja 2 §")])
    got = {(r.source[-3:], r.target, r.edge_type) for r in graph.reference_edges(nodes).collect()}
    assert got == {
        ("1:1", "1/2000:v1:2:1", "EXCEPTS"), ("2:1", "external:1336/1997", "REFERS_TO"), ("2:1", "external:1397/2016", "REFERS_TO"), ("2:1", "definition:1/2000:v1:2:1", "DEFINES"),
        ("3:1", "1/2000:*:8:2", "REFERS_TO"), ("3:1", "1/2000:v1:2:*", "REFERS_TO"),
    }
    chaptered = nodes.withColumn("node_id", F.concat(F.lit("ch:"), "node_id"))
    assert graph.reference_edges(chaptered).filter("target = 'ch:1/2000:v1:2:1'").count() == 1
    assert graph.reference_edges(chaptered, resolve="compat").filter("target = 'ch:1/2000:v1:2:1'").count() == 0


def walk_fixture(spark):
    nodes = spark.createDataFrame([("A1", "L", 1), ("A2", "L", 1), ("B", "L", 2), ("C", "L", 3), ("D", "L", 4)], "node_id string, law_key string, section_num int")
    edges = spark.createDataFrame([("A2", "B", "REFERS_TO", 1), ("B", "C", "REFERS_TO", 2), ("C", "D", "REFERS_TO", 3), ("D", "A1", "EXCEPTS", 4), ("A1", "external:9/9", "REFERS_TO", 5)], "source string, target string, edge_type string, edge_ord long")
    return nodes, edges


def test_expansion_and_support(spark):
    nodes, edges = walk_fixture(spark)
    found = graph.expand(spark.createDataFrame([("A1", 0.7)], "primary string, score double"), nodes, edges)
    rows = {r.node_id: r for r in found.withColumn("s", F.round(graph.neighbor_score(F.col("score"), F.col("hop"), F.col("relation")), 6)).collect()}
    assert {k: (r.hop, r.relation, r.s) for k, r in rows.items()} == {"B": (1, "REFERS_TO", 0.67), "D": (1, "EXCEPTS", 0.68), "C": (2, "REFERS_TO", 0.62), "external:9/9": (1, "REFERS_TO", 0.67)}
    assert rows["B"].path == ["A1", "B"] and rows["C"].path == ["A1", "B", "C"]
    assert [r.node_id for r in graph.support(found, nodes).orderBy("place").collect()] == ["D", "B", "C"]
    assert {r.node_id: r.hop for r in graph.neighbors(spark.createDataFrame([("A2",)], "node_id string"), edges, 3).collect()} == {"A2": 0, "B": 1, "C": 2, "D": 3}


def test_stored_edges_do_not_move(spark, tmp_path):
    nodes, edges = walk_fixture(spark)
    path = f"file://{tmp_path}/adjacency"
    graph.store_adjacency(edges, path, 4)
    start = spark.createDataFrame([("A1", 0.7)], "primary string, score double")
    want = sorted(map(str, graph.expand(start, nodes, edges).collect()))
    assert sorted(map(str, graph.expand(start, nodes, walk=graph.stored(spark, path, "walk")).collect())) == want
    for name in ("walk", "adjacency"):  # a session that did not write them
        spark.sql(f"DROP TABLE {graph._table(path, name)}")
    walk, both = graph.stored(spark, path, "walk"), graph.stored(spark, path)
    assert sorted(map(str, graph.expand(start, nodes, walk=walk).collect())) == want
    one = spark.createDataFrame([("A2",)], "node_id string")
    assert sorted(map(str, graph.neighbors(one, None, 3, both).collect())) == sorted(map(str, graph.neighbors(one, edges, 3).collect()))
    assert sorted(map(str, graph.section_lookup(nodes.withColumn("moment", F.col("node_id")), None, "L", 1, adjacency=both)[1].collect())) == sorted(map(str, graph.section_lookup(nodes.withColumn("moment", F.col("node_id")), edges.select("source", "target", "edge_type"), "L", 1)[1].collect()))
    frontier = spark.createDataFrame([("A1", "A1", 0, 1, None, ["A1"])], "primary string, node_id string, hop int, queue long, relation string, path array<string>")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__requireAllClusterKeysForCoPartition="false"):
        plan = graph.step(frontier, frontier, walk, 1)._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line]
    assert len(scans) == 2
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i in scans:
        at, above = depth(plan[i]), []
        for line in reversed(plan[:i]):
            if depth(line) < at:
                at = depth(line)
                above.append(line)
                if "Join" in line:
                    break
        assert above and not any("Exchange" in line for line in above)


def test_documents_of_different_depths_are_read_once(spark, tmp_path):
    nest = lambda depth, name: {"title": f"{name}{depth}", "paragraphs": [f"{name} {depth} " + "x" * 60], "subsections": [nest(depth - 1, name)] if depth else []}
    (tmp_path / "docs").mkdir()
    for name, depth in (("a", 0), ("b", 3), ("c", 12)):
        (tmp_path / f"docs/{name}.json").write_text(json.dumps({"city": name, "year": 1, "title": "t", "pages": [{"page_num": 1, "sections": [nest(depth, name), {"title": None, "subsections": None, "tables": "no table"}]}, {"page_num": 2}]}))
    docs = files.documents(spark, str(tmp_path / "docs"))
    nodes, edges = documents.document_graph(docs)
    got = {r.city: r.n for r in nodes.filter("node_type = 'SECTION'").groupBy("city").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 2, "b": 5, "c": 14} and nodes.filter("node_type = 'PARA'").count() == 1 + 4 + 13
    deepest = nodes.filter("title = 'c0'").first()
    assert deepest.node_id == "c:1:SECTION:" + ":".join(f"c{i}" for i in range(12, -1, -1)) and nodes.filter(F.col("node_id") == deepest.parent_id).count() == 1
    assert edges.filter("edge_type = 'NEXT'").count() == 6
    typed = documents.document_graph(files.documents(spark, str(tmp_path / "docs"), documents.document_schema(12)))
    for x, y in zip((nodes, edges), typed, strict=True):
        assert sorted(map(str, x.collect())) == sorted(map(str, y.select(*x.columns).collect()))
    wide = documents.sections(files.documents(spark, str(tmp_path / "docs"), documents.document_schema(3)).withColumn("root", F.col("city")))
    assert wide._jdf.queryExecution().executedPlan().toString().count("Scan json") == 1


def test_hierarchy_lookup_and_answers(spark):
    nodes, edges = walk_fixture(spark)
    kinds = {(r.edge_type, r.external): r.n for r in graph.edge_stats(graph.hierarchy_edges(nodes).unionByName(edges.drop("edge_ord"))).collect()}
    assert kinds == {("HAS_SECTION", False): 4, ("HAS_MOMENT", False): 5, ("REFERS_TO", False): 3, ("REFERS_TO", True): 1, ("EXCEPTS", False): 1}
    assert [r.node_id for r in graph.lookup(nodes, "A").collect()] == ["A1", "A2"]
    found, incoming = graph.section_lookup(nodes.withColumn("moment", F.col("node_id")), edges, "L", 1)
    assert [r.node_id for r in found.collect()] == ["A1", "A2"] and [r.source for r in incoming.collect()] == ["D"]
    named = nodes.withColumn("section_title", F.lit("title")).withColumn("text", F.lit("body"))
    hits = spark.createDataFrame([(1, 1, "A1")], "question_id int, rank int, id string")
    support = graph.support(graph.expand(spark.createDataFrame([("A1", 0.7)], "primary string, score double"), nodes, edges), nodes).withColumn("question_id", F.lit(1))
    text = guided.answers(hits, support, named).first().answer
    assert text.startswith("**1 § title**\nbody\n\n- [EXCEPTS] 4 § title: body")


DOCUMENT = {
    "city": "x", "year": 2023, "title": "Report", "metrics": [{"name": "Cash", "value": 1.5, "unit": "e", "page": 2}],
    "pages": [
        {"page_num": 1, "sections": [{"title": "Top", "level": 1, "paragraphs": ["short", "p" * 60], "tables": [{"title": "Income", "rows": [{"cells": ["Revenue", "1 234,5", "9"]}, {"cells": ["alone"]}]}], "subsections": [{"title": "Sub", "level": 2, "paragraphs": [], "tables": [{"title": "Debt", "rows": [{"cells": ["Loans", "-45 222 212"]}]}], "subsections": [{"title": "Low", "subsections": [{"subsections": [{"title": "Lowest", "paragraphs": ["q" * 51, "r" * 80]}, {"title": "Last"}]}]}]}]}]},
        {"page_num": 2, "sections": [{"title": "Next", "level": 1, "paragraphs": [], "tables": [], "subsections": []}]},
    ],
}


def test_document_graph_and_tables(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(DOCUMENT))
    docs = files.documents(spark, str(tmp_path / "d.json"))
    nodes, edges = documents.document_graph(docs)
    count = {r.node_type: r.n for r in nodes.groupBy("node_type").agg(F.count("*").alias("n")).collect()}
    assert count == {"DOC": 1, "PAGE": 2, "SECTION": 7, "PARA": 3, "TABLE": 2, "ROW": 3, "METRIC": 1}
    kinds = {r.edge_type: r.n for r in edges.groupBy("edge_type").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"HAS_PAGE": 2, "HAS_SECTION": 7, "HAS_PARA": 3, "HAS_TABLE": 2, "HAS_ROW": 3, "NEXT": 2}
    deepest = {r.node_id: r.parent_id for r in nodes.filter("title in ('Lowest', 'Last')").collect()}
    assert deepest == {f"x:2023:SECTION:top:sub:low:section_0:{x}": "x:2023:SECTION:top:sub:low:section_0" for x in ("lowest", "last")}
    fixed = files.documents(spark, str(tmp_path / "d.json"), documents.document_schema(5))
    assert sorted(map(tuple, documents.document_graph(fixed)[1].collect())) == sorted(map(tuple, edges.collect()))
    rows = documents.table_rows(docs)
    got = [(r.page, r.section, r.table_title, r.row_name, r.v) for r in rows.withColumn("v", documents.numeric(F.col("value_2023"))).collect()]
    assert sorted(got) == [(1, "Sub", "Debt", "Loans", -45222212.0), (1, "Top", "Income", "Revenue", 1234.5)]
    asked = spark.createDataFrame([(1, "the revenue, income revenue"), (2, "none here")], "question_id int, text string")
    assert [(r.row_name, r.points) for r in documents.search_tables(asked, rows).collect()] == [("Revenue", 5)]
    (tmp_path / "bad.json").write_text(json.dumps({"city": "x", "year": 1}))
    with pytest.raises(Exception, match="missing field"):
        files.documents(spark, str(tmp_path / "bad.json"), documents.document_schema(2)).collect()
    with pytest.raises(Exception, match="missing field"):
        files.documents(spark, str(tmp_path / "bad.json")).collect()
    assert {(r.kind, r.type): r.n for r in files.write_graph(nodes, edges, str(tmp_path / "g")).collect()}["node", "ROW"] == 3


def test_abstain(spark):
    asked = spark.createDataFrame([(1, "Mikä on veroprosentti?", 0.9, True), (2, "Helsinkiin nyt", 0.9, True), (8, "Helsingissä nyt", 0.9, True), (3, "konkurssi", 0.6, True), (4, "konkurssi", 0.8, True), (5, "vuonna 2031", 0.9, True), (6, "muu", None, False), (7, "muu", 0.5, True)], "k int, text string, best double, has boolean")
    reason = documents.abstain_reason(F.col("text"), F.col("best"), F.col("has"), ABSTAIN_STRONG, ABSTAIN_INTERPRET)
    got = {r.k: r.r for r in asked.select("k", reason.alias("r")).collect()}
    assert got == {1: "Strong signal: 'veroprosentti'", 2: "Strong signal: 'helsinki'", 3: "Interpretation needed: 'konkurssi'", 4: None, 5: "Future/missing year", 6: "No relevant data found", 7: None, 8: None}  # a changed stem is no root
    signal = documents.abstain_signal(F.col("text"), ABSTAIN_FINANCE)
    more = spark.createDataFrame([(1, "Ennuste 2025"), (2, "Vertaa Seinäjoen"), (3, "tase")], "k int, text string").select("k", signal.alias("r"))
    assert [r.r for r in more.orderBy("k").collect()] == ["Signal: 2025", "Cross-city comparison", None]


def test_mapping_edges_fall_back(spark):
    pairs = spark.createDataFrame([("kpl:1", f"d{i}", i, 0.5, "Tase", "x" * 300 if i else "liite tase") for i in range(5)] + [("oyl:1", f"d{i}", i + 1, 0.4, "t", "x") for i in range(5)], "law_node_id string, doc_node_id string, rank int, score double, title string, text string")
    rows = documents.mapping_edges(pairs, (("kpl", ("liite", "tase"), "SUPPORTS"), ("kpl:1", ("none",), "NO"))).collect()
    assert sorted((r.law_node_id, r.edge_type, r.context) for r in rows) == sorted([("kpl:1", "SUPPORTS", "Rule match: kpl -> liite")] + [("kpl:1", "SUPPORTS", "Rule match: kpl -> tase")] * 4 + [("oyl:1", "EVIDENCED_BY", "Semantic similarity match")] * 3)


def test_paraphrases_do_not_repeat(spark):
    asked = spark.createDataFrame([(1, "Tase ja tase"), (2, "muu")], "question_id int, text string")
    rows = documents.paraphrases(asked, (("tase", ("balance", "BALANCE", "third")), ("ja", ("sekä", "and", "x"))), most=3).orderBy("paraphrase_no").collect()
    assert [(r.question_id, r.text) for r in rows] == [(1, "balance ja balance"), (1, "Tase sekä tase"), (1, "Tase and tase")]


XML = '<?xml version="1.0"?><r xmlns="http://x"><meta><FRBRversionNumber value="v1"/>{meta}</meta><body>{body}</body></r>'
SECTION = "<section><num>{n}</num><heading>H</heading><subsection><content>{t}</content></subsection></section>"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<part><num>1</num><chapter><num>2 luku</num>" + SECTION.format(n="1 §", t="a") + "</chapter></part><chapter>" + SECTION.format(n="9 §", t="z") + "</chapter>", ["1"]),
        ("<part><num>1</num>" + SECTION.format(n="1 §", t="a") + "</part>", []),
        ("<hcontainer><chapter>" + SECTION.format(n="1 §", t="a") + "</chapter>" + SECTION.format(n="2 §", t="b") + "</hcontainer>", ["1", "2"]),
        ("<chapter>" + SECTION.format(n="3 b §", t="c") + "</chapter>", ["3b"]),
        (SECTION.format(n="VII", t="d"), ["VII"]),
    ],
)
def test_statute_patterns(spark, body, want):
    rows = spark.createDataFrame([("p", XML.format(meta="", body=body))], "path string, xml string")
    got = statutes.moments(rows, "L", "1/1", "k").orderBy("place").collect()
    assert [r.section_id for r in got] == want and all(r.in_force and r.effective_from == "1900-01-01" for r in got)


def test_sparks_own_xml_source_gives_the_same_rows(spark, tmp_path):
    sub = lambda t: f"<subsection><intro>in  {t}</intro><content><p>a<i>b</i> &amp; c\u00a0d</p></content><paragraph><num>1)</num><content>x</content></paragraph><paragraph><num>2)</num></paragraph></subsection>"
    plain = "<section><num>7 <b>a</b> §</num><heading>Whole</heading><p>one</p><list><item>two</item></list></section>"
    bodies = [
        "<part><num>I</num><heading>Part &amp; one</heading><chapter><num>2 luku</num><heading>C</heading>" + SECTION.format(n="1 §", t="a") + plain + "</chapter></part><part><num>II</num></part>",
        "<hcontainer><chapter><num>1 luku</num>" + SECTION.format(n="3 §", t="c") + "</chapter>" + SECTION.format(n="4 §", t="d") + "</hcontainer>" + SECTION.format(n="5 §", t="e"),
        "<chapter><num>1 luku</num><section><num>1 §</num><subsection/>" + sub("x") + "<subsection><content> </content></subsection>" + sub("y") + "</section>" + plain + "</chapter>",
        SECTION.format(n="1 §", t="only") + plain, "", "<hcontainer><part><num>P</num><chapter>" + plain + "</chapter></part></hcontainer>",
    ]
    (tmp_path / "xml").mkdir()
    for i, body in enumerate(bodies):
        (tmp_path / f"xml/{i}.xml").write_text(XML.format(meta="", body=body).replace("><", ">\n<"))
    (tmp_path / "xml/named.xml").write_text("<a:akn xmlns:a='u'><a:meta/><a:body>" + (SECTION + plain).replace("<", "<a:").replace("<a:/", "</a:").format(n="8 §", t="t") + "</a:body></a:akn>")
    folder = str(tmp_path / "xml")
    got = statutes.moments_of_files(spark, folder, "L", "1/1", "k", {"one": ("tag",)})
    want = statutes.moments(statutes.files(spark, folder), "L", "1/1", "k", {"one": ("tag",)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_file_a_key_and_arrays_of_json(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"{i % 3}/act {i}.md", f"# {i}\nä") for i in range(20)] + [("null.md", None)], "name string, content string").repartition(4)
    sinks.write_files(rows, path)
    found = {str(p.relative_to(path)): p.read_text() for p in (tmp_path / "out").rglob("*.md")}
    assert found == {r.name: r.content or "" for r in rows.collect()} and not (tmp_path / "out/_temporary").exists()
    sinks.write_files(rows.limit(1), path)
    assert len(list((tmp_path / "out").rglob("*.md"))) == 1
    broken = rows.withColumn("content", F.when(F.col("name") == "1/act 7.md", F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    for bad in (broken, rows.union(rows), spark.createDataFrame([("../up", "x")], "name string, content string"), spark.createDataFrame([(None, "x")], "name string, content string")):
        with pytest.raises(Exception, match="broken|two rows|not a name"):
            sinks.write_files(bad, str(tmp_path / "failed"))
        assert not [p for p in (tmp_path / "failed").rglob("*") if p.is_file() and "_temporary" not in p.parts] and not (tmp_path / "up").exists()
    sinks.write_files(rows.limit(2), str(tmp_path / "failed"))
    assert len([p for p in (tmp_path / "failed").rglob("*.md")]) == 2 and not (tmp_path / "failed/_temporary").exists()
    data = spark.createDataFrame([(i, f"t{i}", [i, None]) for i in range(7)] + [(None, None, None)], "id int, text string, more array<int>")
    sinks.write_json_array(data.repartition(3), str(tmp_path / "arrays"))
    texts = [p.read_text() for p in (tmp_path / "arrays").glob("*.json")]
    assert sum(len(json.loads(t)) for t in texts) == 8 and {} in [x for t in texts for x in json.loads(t)]
    assert sorted(map(str, sinks.read_json_array(spark, str(tmp_path / "arrays"), "id int, text string, more array<int>").collect())) == sorted(map(str, data.collect()))
    sinks.write_json_array(data.limit(0), str(tmp_path / "arrays"))
    assert not list((tmp_path / "arrays").glob("*.json"))


def test_statute_repeats_fail_and_render(spark):
    twice = XML.format(meta='<isInForce value="false"/>', body=SECTION.format(n="1 §", t="a") * 2)
    rows = statutes.moments(spark.createDataFrame([("p", twice)], "path string, xml string"), "L", "1/1", "k")
    assert not rows.first().in_force
    with pytest.raises(Exception, match="duplicate node_id"):
        statutes.unique_ids(rows).collect()
    assert statutes.markdown(rows.limit(1)).first().text == "### 1 § H\n\na"


def test_line_cleaner_and_domain(spark):
    docs = spark.createDataFrame([(1, "\n\na\na\n 12 \na\n\n \nb\nb\n"), (2, ""), (3, None)], "k int, text string")
    assert {r.k: r.text for r in enrich.clean_lines(docs, "k", "text").collect()} == {1: "a\n\nb\n", 2: "", 3: ""}
    same = spark.createDataFrame([(1, "a\nb"), (1, "c\nd"), (None, "a\n7\na")], "k int, text string")
    assert sorted((str(r.k), r.text) for r in enrich.clean_lines(same, "k", "text").collect()) == [("1", "a\nb"), ("1", "c\nd"), ("None", "a")]
    of = spark.createDataFrame([("1", "1", ["x"]), ("1", "default", ["y", "x"])], "section string, moment string, anchors array<string>")
    rows = spark.createDataFrame([("1", "1"), ("1", "2"), ("2", "1")], "section_id string, moment string")
    assert {(r.section_id, r.moment): r.anchors for r in enrich.anchors(rows, of).collect()} == {("1", "1"): ["x", "y", "x"], ("1", "2"): ["y", "x"], ("2", "1"): []}


def test_sources_and_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"id": "1", "law_key": "a"}\n\n{"id": "2", "law_key": "b"}\n')
    schema = "id string, law_key string"
    assert files.json_lines(spark, str(tmp_path / "in"), schema).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": "1"}\n{oops\n')
    assert [(r.line_no, r.line) for r in files.bad_lines(spark, str(tmp_path / "bad.jsonl"), schema).collect()] == [(2, "{oops")]
    (tmp_path / "long.jsonl").write_text("".join(f"line {i}\n" for i in range(1, 5001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    assert files.numbered_lines(spark, str(tmp_path / "long.jsonl")).filter("line = concat('line ', line_no)").count() == 5000
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.json_lines(spark, str(tmp_path / "bad.jsonl"), schema, strict=True).collect()
    table = str(tmp_path / "vectors")
    ingest.follow(spark, str(tmp_path / "in"), schema + ", text string", table, str(tmp_path / "cp")).awaitTermination()
    (tmp_path / "in/b.jsonl").write_text('{"id": "9", "law_key": "b"}\n{"id": "1", "law_key": "a", "text": "new"}\n')
    ingest.follow(spark, str(tmp_path / "in"), schema + ", text string", table, str(tmp_path / "cp")).awaitTermination()
    want = [("a", "1", "new"), ("b", "2", None), ("b", "9", None)]
    assert sorted((r.law_key, r.id, r.text) for r in ingest.read_latest(spark, table).collect()) == want
    ingest.follow(spark, str(tmp_path / "in"), schema + ", text string", f"{table}1", str(tmp_path / "cp1")).awaitTermination()  # both files in one batch
    assert sorted((r.law_key, r.id, r.text) for r in ingest.read_latest(spark, f"{table}1").collect()) == want
    ingest.compact(spark, table, f"{table}2")
    assert files.read_vectors(spark, f"{table}2", ["a", "missing"]).count() == 1 and files.available_sources(spark, f"{table}2").count() == 2
    files.replace_source(spark.createDataFrame([(str(i), None, "b") for i in range(50)], "id string, text string, law_key string"), f"{table}2", files=4)
    assert files.read_vectors(spark, f"{table}2").groupBy("law_key").count().count() == 2 and files.read_vectors(spark, f"{table}2", ["b"]).count() == 50
    (tmp_path / "rules.json").write_text(json.dumps({"router_keywords": {"s": ["x", "y"]}}))
    assert files.rules(spark, str(tmp_path / "rules.json")) == {"s": ("x", "y")} and files.rules(spark, None) == {}
    for name, status in (("q1.json", "OK"), ("q2.json", "FAIL")):
        (tmp_path / name).write_text(json.dumps([{"id": name, "query": "q", "autofill_status": status}]))
    got = files.questions(spark, [], [str(tmp_path / "q1.json"), str(tmp_path / "q2.json")]).collect()
    assert [(r.id, r.source_file) for r in got] == [("q1.json", "q1.json")]
    old = spark.createDataFrame([("c1", "law", True)], "id string, top1_law string, confusion_fail boolean")
    row = files.results(old).first()
    assert (row.case_id, row.top1_law_key, row.confusion_fail, row.system_abstains, row.latency_ms) == ("c1", "law", True, False, 0.0)


def test_supports_are_scored_by_each_questions_own_hit(spark, monkeypatch):
    from sparquill.operators import search

    nodes, edges = walk_fixture(spark)
    hits = spark.createDataFrame([(1, 1, "A1", 0.7), (2, 1, "A1", 0.5)], "question_id int, rank int, id string, score double")
    monkeypatch.setattr(search, "multi_source", lambda *a, **k: hits)
    _, support, path = guided.guided(None, None, nodes, edges, None, None)
    got = {(r.question_id, r.node_id): r.support_score for r in support.collect()}
    assert got == {(1, "D"): 0.68, (1, "B"): 0.67, (1, "C"): 0.62, (2, "D"): 0.48, (2, "B"): 0.47, (2, "C"): 0.42}
    lines = {r.question_id: r.lines for r in guided.path_lines(path, nodes.withColumn("section_title", F.lit("t"))).collect()}
    assert lines[1] == lines[2] and lines[1].split("\n")[0] == "1 § t -[REFERS_TO]-> 2 § t" and "external:9/9" in lines[1]


def test_expansion_keeps_first_visits_on_random_graphs(spark):
    """Hop by hop against a queue."""
    rng = __import__("random").Random(3)
    names = [f"n{i}" for i in range(40)]
    nodes = [(n, "L", i // 2) for i, n in enumerate(names)]
    edges = [(rng.choice(names), rng.choice([*names, "external:1/1"]), rng.choice(["REFERS_TO", "EXCEPTS", "DEFINES", "HAS_MOMENT"]), k) for k in range(150)]
    got = graph.expand(spark.createDataFrame([(n, 0.5) for n in names[:6]], "primary string, score double"), spark.createDataFrame(nodes, "node_id string, law_key string, section_num int"), spark.createDataFrame(edges, "source string, target string, edge_type string, edge_ord long"), 3)
    want = set()
    for p in names[:6]:
        i = names.index(p)
        seen = {p: [p]} | {n: [p] for n in (names[i // 2 * 2], names[i // 2 * 2 + 1]) if n != p}
        queue = list(seen)
        for hop in range(1, 4):
            following = []
            for n in queue:
                steps = sorted([(0, k, t, e) for s, t, e, k in edges if s == n and e != "HAS_MOMENT"] + [(1, k, s, e) for s, t, e, k in edges if t == n and e == "EXCEPTS"])
                for _, _, to, kind in steps:
                    if to not in seen:
                        seen[to] = [*seen[n], to]
                        following.append(to)
                        want.add((p, to, hop, kind, tuple(seen[to])))
            queue = following
    assert {(r.primary, r.node_id, r.hop, r.relation, tuple(r.path)) for r in got.collect()} == want


def test_latest_version_is_built_and_written_as_markdown(spark, tmp_path):
    for version, text in (("9", "old"), ("20230780", "Tase on tehtävä")):
        folder = tmp_path / f"2015/410/fin@{version}"
        folder.mkdir(parents=True)
        (folder / "main.xml").write_text(XML.format(meta="", body="<chapter><num>1 luku</num><heading>Yleiset</heading>" + SECTION.format(n="1 §", t=text) + "</chapter>"))
    found = files.version_files(spark, str(tmp_path), number="410").collect()
    assert [(r.year, r.number, r.version) for r in found] == [("2015", "410", "20230780"), ("2015", "410", "9")]
    row = statutes.build(spark, str(tmp_path), "Kuntalaki", "410/2015", "k", word_tags={"tehtävä": ("own",)}).first()
    assert row.text == "Tase on tehtävä" and row.tags == ["h", "own", "tase", "tilinpäätös", "vastaavaa", "vastattavaa"]
    listed = "<list><item><label>1)</label><p>one</p><list><item><p>in it</p></item></list></item><item>bare</item></list>"
    body = f"<docTitle><p>Act</p></docTitle><body><part><num>I</num><heading>Osa</heading><section><num>2 §</num><heading>H</heading><p>Text</p>{listed}<p> </p></section></part></body>"
    rows = spark.createDataFrame([("a", f"<r>{body}</r>")], "path string, xml string")
    assert statutes.act_markdown(rows).first().text == "# Act\n\n## I Osa\n\n### 2 § H\n\nText\n\n- **1)** one\n  - in it\n\n- bare\n"
    deep = "<section><num>1</num><subsection><p>not shown</p></subsection><section><p>nor this</p></section></section><hcontainer><chapter/><article><p>a <b>b</b>  c</p></article></hcontainer>"
    rows = spark.createDataFrame([("b", f"<x:r xmlns:x='u'><x:body>{deep}</x:body></x:r>"), ("c", "<r><body/></r>")], "path string, xml string")
    assert {r.path: r.text for r in statutes.act_markdown(rows).collect()} == {"b": "### 1\n\na b c\n", "c": "\n"}
    for bad in ("<r/>", "<!DOCTYPE r [<!ENTITY x 'y'>]><r><body/></r>"):
        with pytest.raises(Exception, match="body|document type"):
            statutes.act_markdown(spark.createDataFrame([("a", bad)], "path string, xml string")).collect()


def test_question_set_and_synonyms(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"term_synonyms": {"tase": ["balance"]}, "section_specific_synonyms": {"115": {"terms": ["a", "b"], "synonyms": ["c"]}}}))
    got = files.synonyms(spark, str(tmp_path / "s.json")).collect()
    assert sorted((r.section or "", r.term, tuple(r.synonyms)) for r in got) == [("", "tase", ("balance",)), ("115", "a", ("c",)), ("115", "b", ("c",))]
    base = spark.createDataFrame([("q1", "x", True, "must"), ("q2", "y", False, "covid-poikkeus"), ("q3", "z", False, "muu")], "question_id string, text string, must boolean, category string")
    made = spark.createDataFrame([(q, n, f"{q} {n}") for q in ("q1", "q2", "q3") for n in (1, 2, 3, 4)], "question_id string, paraphrase_no int, text string")
    hard = spark.createDataFrame([("h1", "no", "hard_negative")], "question_id string, text string, test_type string")
    rows = documents.question_set(base, made, [hard], ("covid-poikkeus",)).collect()
    assert sorted((r.question_id, r.test_type) for r in rows) == sorted([("q1", "base"), ("q2", "base"), ("q3", "base"), ("h1", "hard_negative"), *((f"q1-p{n}", "synonym") for n in (1, 2, 3)), *((f"q2-p{n}", "synonym") for n in (1, 2))])


@pytest.mark.parametrize("files_a_batch", [None, 1, 2])
def test_rows_replace_each_other_however_files_fall_into_batches(spark, tmp_path, files_a_batch):
    (tmp_path / "in").mkdir()
    for i, (name, lines) in enumerate({"z": [("1", "007", "old"), ("2", "7", "two")], "b": [("1", "007", "mid"), ("1", "007", "later line"), ("3", None, "no source")], "a": [("2", "7", "newest"), ("1", "7", "own")]}.items()):
        path = tmp_path / f"in/{name}.jsonl"
        path.write_text("".join(json.dumps({"id": a, "law_key": b, "text": c}) + "\n" for a, b, c in lines))
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    table = str(tmp_path / "table")
    ingest.follow(spark, str(tmp_path / "in"), "id string, law_key string, text string", table, str(tmp_path / "cp"), files_a_batch=files_a_batch).awaitTermination()
    want = {("007", "1", "later line"), ("7", "2", "newest"), ("7", "1", "own"), (None, "3", "no source")}
    assert {(r.law_key, r.id, r.text) for r in ingest.read_latest(spark, table).collect()} == want
    assert {(r.law_key, r.id) for r in ingest.read_latest(spark, table, ["007"]).collect()} == {("007", "1")}
    ingest.compact(spark, table, str(tmp_path / "whole"))
    assert {(r.law_key, r.id, r.text) for r in files.read_vectors(spark, str(tmp_path / "whole"), ["7"]).collect()} == {w for w in want if w[0] == "7"}


def test_source_names_stay_as_they_are(spark, tmp_path):
    names = ["007", "7", "7.0", "", "2024-01-01", "true", "a b/c=d%", None]
    path = str(tmp_path / "v")
    files.write_vectors(spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "id string, law_key string"), path)
    assert {(r.id, r.law_key) for r in files.read_vectors(spark, path).collect()} == {(str(i), n) for i, n in enumerate(names)}
    for i, n in enumerate(names[:-1]):
        assert [r.id for r in files.read_vectors(spark, path, [n]).collect()] == [str(i)]
    assert "PartitionFilters: [((source_folder" in files.read_vectors(spark, path, ["007"])._jdf.queryExecution().toString()
    files.write_vectors(spark.createDataFrame([("a", 7), ("b", 8)], "id string, law_key int"), path)
    assert [(r.id, r.law_key) for r in files.read_vectors(spark, path, ["7"]).collect()] == [("a", 7)]
    files.replace_source(spark.createDataFrame([("c", 7)], "id string, law_key int"), path)
    assert sorted(r.id for r in files.read_vectors(spark, path).collect()) == ["b", "c"]


def test_names_and_vector_rows(spark):
    from sparquill.plans.rules import STATUTE_NAMES

    rows = spark.createDataFrame([("kuntalaki_410_2015",), ("other",)], "src string").select(enrich.display_name(F.col("src"), STATUTE_NAMES).alias("n"))
    assert [r.n for r in rows.collect()] == ["Kuntalaki", "other"]
    moment = spark.createDataFrame([("n", "T", "x", None, None, None, None, None, None, None, None, None, None, None, None, None)], "node_id string, section_title string, text string, law string, law_id string, law_key string, finlex_version string, chapter string, chapter_title string, section_id string, section_num int, section_suffix string, moment string, tags array<string>, anchors array<string>, in_force boolean")
    row = enrich.vector_rows(moment).first()
    assert (row.id, row.document, row.law, row.section_num, row.tags, row.in_force) == ("n", "T. x", "", 0, [], False)


def test_expansion_shares_what_a_section_reaches(spark):
    """Primaries of one section share the rows that they do not reach themselves; supports are those of the whole expansion."""
    rng = __import__("random").Random(5)
    names = [f"n{i}" for i in range(60)]
    nodes = spark.createDataFrame([(n, "L", i // 12) for i, n in enumerate(names)], "node_id string, law_key string, section_num int")
    edges = [(rng.choice(names), rng.choice([*names, "external:1/1"]), rng.choice(["REFERS_TO", "EXCEPTS", "DEFINES"]), k) for k in range(120)]
    edges = spark.createDataFrame(edges, "source string, target string, edge_type string, edge_ord long")
    start = spark.createDataFrame([(n, 0.3 + i / 10) for i, n in enumerate(names[:6])], "primary string, score double")
    found = graph.reach(start, nodes, edges)
    whole = graph.expand(start, nodes, edges)
    assert found.common.count() + found.own.count() < whole.count() and found.common.select("team").distinct().count() == 1
    want = sorted(map(str, graph.support(whole, nodes).collect()))
    assert sorted(map(str, graph.selected(start, nodes, edges).collect())) == want


def test_rows_of_each_primary_are_made_by_generated_code(spark):
    """No lambda runs and no number is rounded for a primary and node, edges are not aggregated, and the best of several edges counts."""
    nodes, edges = walk_fixture(spark)
    edges = edges.union(spark.createDataFrame([("A2", "B", "DEFINES", 0), ("A2", "B", "EXCEPTS", 9), ("A1", "A2", "EXCEPTS", 8), ("C", "D", None, 2)], edges.schema))
    start = spark.createDataFrame([("A1", 0.7), ("A2", 0.01)], "primary string, score double")
    score = lambda s, h, r: F.round(graph.neighbor_score(s, h, r), 6)
    found = graph.expand(start, nodes, edges, value=score).select("primary", "node_id", "hop", "relation", "score")
    plain = graph.expand(start, nodes, edges).withColumn("score", score(F.col("score"), F.col("hop"), F.col("relation"))).select(found.columns)
    got = sorted(map(str, found.collect()))
    assert got == sorted(map(str, plain.collect())) and [(r.hop, r.relation) for r in found.filter("node_id = 'B'").collect()] == [(1, "DEFINES")] * 2
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "lambda" not in plan.split("union")[1].split("generate")[0] and "round(" not in plan.split("generate")[0].split(":")[0]
    assert "aggregate" not in graph.walkable(graph.both_ways(edges))._jdf.queryExecution().optimizedPlan().toString().lower()
