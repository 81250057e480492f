"""Citation graphs: edges from text, hierarchy, bounded traversal, support selection."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparquill.functions.text import before, holds_any
from sparquill.operators import text_index
from sparquill.plans.rules import DEFINITION_PHRASES, EXCEPTION_PHRASES, STATUTE_NUMBERS
from sparquill.staging import fresh_path, settings, stage

# Patterns of section and statute references; the order of alternatives decides how much text they match.
DECLINED = r"(?:n|ssä|ssa|ään|stä|sta|lta|lle|lla)"
SECTION_MOMENT = rf"(?iu)(\d+)\s*§:?{DECLINED}?\s+(\d+)\s*(?:momentti|mom\.?|momentissa|momentti(?:in|a|ssa))"
SECTION_DECLINED = rf"(?iu)(\d+)\s*§:?{DECLINED}"
CHAPTER_SECTION = r"(?iu)(\d+)\s*(?:luvun|luku)\s+(\d+)\s*§"
SECTION_PLAIN = r"(\d+)\s*§"
EXTERNAL = r"(?iu)([\p{L}\p{N}_]+lain?|asetuksen?)\s*\((\d+/\d+)\)"
PRIORITY = {"EXCEPTS": 3, "REFERS_TO": 2, "DEFINES": 1}
# End of the fixed values.
HIERARCHY = ("HAS_SECTION", "HAS_MOMENT")
#: Pairs of primary and sibling that a task makes.
PAIRS = 4_000_000


def _matches(text: Column, pattern: str, section: int, moment: int | None, step: int) -> Column:
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(whole, lambda m, i: F.struct(F.lit(step).alias("step"), i.alias("at"), F.regexp_extract(m, pattern, section).try_cast("int").alias("section"), (F.regexp_extract(m, pattern, moment) if moment else F.lit(None).cast("string")).alias("moment"), m.alias("context")))


def section_references(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ref_no, section, moment, context). Four passes: section with moment, declined section, chapter with section
    (the chapter is dropped), plain section. A section without moment counts only if the section was not met before."""
    t = F.col(text)
    # a plain section inside a match of an earlier pass is that same reference and is met before
    passes = F.concat(_matches(t, SECTION_MOMENT, 1, 2, 1), _matches(t, SECTION_DECLINED, 1, None, 2), _matches(t, CHAPTER_SECTION, 2, None, 3), _matches(t, SECTION_PLAIN, 1, None, 4))
    met = lambda r, i: F.exists(F.slice("all", F.lit(1), i), lambda q: q["section"].eqNullSafe(r["section"]) & (r["moment"].isNull() | q["moment"].eqNullSafe(r["moment"])))
    kept = F.filter("all", lambda r, i: ~met(r, i))  # within each text's own array: nothing is shuffled
    return rows.select(key, passes.alias("all")).select(key, F.posexplode(kept).alias("no", "r")).select(key, (F.col("no") + 1).alias("ref_no"), "r.section", "r.moment", "r.context")


def external_references(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ref_no, number, context) of 'name (number/year)'."""
    found = rows.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(EXTERNAL), F.lit(0))).alias("ref_no", "context"))
    return found.select(key, "ref_no", F.regexp_extract("context", EXTERNAL, 2).alias("number"), "context")


def named_references(rows: DataFrame, key: str, text: str = "text", names: dict[str, str] = STATUTE_NUMBERS) -> DataFrame:
    """(key, number, context): statutes named without number, once each; those found with their number are left out."""
    plan = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    named = F.filter(F.transform(words, lambda w: F.struct(F.try_element_at(plan, w).alias("number"), w.alias("context"))), lambda x: x["number"].isNotNull())
    given = F.regexp_extract_all(F.col(text), F.lit(EXTERNAL), F.lit(2))
    first = F.filter("named", lambda x, i: ~F.exists(F.slice("named", F.lit(1), i), lambda y: y["number"] == x["number"]) & ~F.array_contains("given", x["number"]))
    return rows.select(key, named.alias("named"), given.alias("given")).select(key, F.explode(first).alias("r")).select(key, "r.number", "r.context")


def is_exception(text: Column, context: Column, phrases: tuple[str, ...] = EXCEPTION_PHRASES, length: int = 100) -> Column:
    """A phrase stands in the characters before the first occurrence of the matched text."""
    return holds_any(F.lower(before(text, context, length)), phrases)


def is_definition(text: Column, phrases: tuple[str, ...] = DEFINITION_PHRASES) -> Column:
    return holds_any(F.lower(text), phrases)


def reference_edges(nodes: DataFrame, resolve: str = "joined", text: str = "text") -> DataFrame:
    """Edges (source, target, edge_type, context, edge_ord) of nodes (node_id, law_id, version, section_num, moment, text).

    Targets within the statute are found by (statute, section, moment) with resolve='joined', by the id without chapter with
    'compat'; what is not found points to law:*:section:moment. A reference to the node's own section and moment (or to
    its section alone) is none. A node with a definition phrase gets one edge to a placeholder.
    """
    refs = section_references(nodes, "node_id", text).join(nodes.select("node_id", "law_id", "version", "section_num", F.col("moment").alias("own_moment"), F.col(text).alias("body")), "node_id")
    refs = refs.filter(~((F.col("section") == F.col("section_num")) & (F.col("moment").isNull() | F.col("moment").eqNullSafe(F.col("own_moment")))))
    there = nodes.select(F.col("law_id").alias("to_law"), F.col("version").alias("to_version"), F.col("section_num").alias("to_section"), F.col("moment").alias("to_moment"), F.col("node_id").alias("found"))
    same = (F.col("law_id") == F.col("to_law")) & (F.col("version") == F.col("to_version")) & (F.col("section") == F.col("to_section")) & (F.col("moment") == F.col("to_moment"))
    plain = F.concat_ws(":", "law_id", "version", F.col("section").cast("string"), F.coalesce("moment", F.lit("*")))
    if resolve == "compat":
        same = same & (F.col("found") == plain)
    one = there.groupBy("to_law", "to_version", "to_section", "to_moment", *(["found"] if resolve == "compat" else [])).agg(*([] if resolve == "compat" else [F.min("found").alias("found")]), F.lit(1).alias("one"))
    joined = refs.join(one, same, "left")
    missing = F.when(F.col("moment").isNull(), plain).otherwise(F.concat_ws(":", "law_id", F.lit("*"), F.col("section").cast("string"), F.col("moment")))
    kind = F.when(is_exception(F.col("body"), F.col("context")), "EXCEPTS").otherwise("REFERS_TO")
    inner = joined.select(F.col("node_id").alias("source"), F.coalesce("found", missing).alias("target"), kind.alias("edge_type"), "context", F.lit(1).alias("step"), F.col("ref_no").alias("no"))
    outer = external_references(nodes, "node_id", text).select(F.col("node_id").alias("source"), F.concat(F.lit("external:"), "number").alias("target"), F.lit("REFERS_TO").alias("edge_type"), "context", F.lit(2).alias("step"), F.col("ref_no").alias("no"))
    named = named_references(nodes, "node_id", text).select(F.col("node_id").alias("source"), F.concat(F.lit("external:"), "number").alias("target"), F.lit("REFERS_TO").alias("edge_type"), "context", F.lit(3).alias("step"), F.lit(0).alias("no"))
    defined = nodes.filter(is_definition(F.col(text))).select(F.col("node_id").alias("source"), F.concat(F.lit("definition:"), "node_id").alias("target"), F.lit("DEFINES").alias("edge_type"), F.lit("").alias("context"), F.lit(4).alias("step"), F.lit(0).alias("no"))
    edges = inner.unionByName(outer).unionByName(named).unionByName(defined)
    return edges.withColumn("edge_ord", F.row_number().over(Window.partitionBy("source").orderBy("step", "no", "target"))).drop("step", "no")


def hierarchy_edges(nodes: DataFrame, law: str = "law_key", section: str = "section_num", node: str = "node_id") -> DataFrame:
    """HAS_SECTION from statute to section, HAS_MOMENT from section to node, each once. A section's name has no suffix."""
    name = F.concat_ws(":", F.lit("section"), F.col(law).cast("string"), F.col(section).cast("string"))
    up = nodes.select(F.concat_ws(":", F.lit("law"), F.col(law).cast("string")).alias("source"), name.alias("target"), F.lit("HAS_SECTION").alias("edge_type"))
    down = nodes.select(name.alias("source"), F.col(node).cast("string").alias("target"), F.lit("HAS_MOMENT").alias("edge_type"))
    return up.union(down).distinct()


def edge_stats(edges: DataFrame) -> DataFrame:
    """(edge_type, external, n)."""
    return edges.groupBy("edge_type", F.startswith("target", F.lit("external:")).alias("external")).agg(F.count("*").alias("n"))


def siblings(primary: DataFrame, nodes: DataFrame, law: str = "law_key", section: str = "section_num", node: str = "node_id") -> DataFrame:
    """(primary, node_id): all nodes of each primary's section, itself included. The pairs grow with the square of a section, so
    each section is dealt as a square of blocks, both ways alike, and to as many parts as hold about PAIRS pairs each."""
    mine, every = _members(primary, nodes, law, section, node)
    of = [F.col("l"), F.col("s")]
    sizes = mine.groupBy(*of).agg(F.count("*").alias("n")).join(every.groupBy(*of).agg(F.count("*").alias("m")), ["l", "s"])
    sums = sizes.agg(F.sum(F.col("n") * F.col("m")), F.max(F.col("n") * F.col("m"))).first()
    side = max(1, math.isqrt((sums[1] or 0) // PAIRS) + 1)
    parts, blocks = max(1, -(-(sums[0] or 0) // PAIRS)), F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    mine = mine.withColumn("a", F.pmod(F.xxhash64("primary"), F.lit(side)).cast("int")).withColumn("b", blocks).repartition(parts, "l", "s", "a", "b")
    every = every.withColumn("b", F.pmod(F.xxhash64("node_id"), F.lit(side)).cast("int")).withColumn("a", blocks).repartition(parts, "l", "s", "a", "b")
    return mine.join(every.hint("merge"), ["l", "s", "a", "b"]).select("primary", "node_id")


def _members(primary: DataFrame, nodes: DataFrame, law: str = "law_key", section: str = "section_num", node: str = "node_id") -> tuple[DataFrame, DataFrame]:
    """The sections of the primaries (primary, l, s) and of all nodes (node_id, l, s)."""
    every = nodes.select(F.col(node).alias("node_id"), F.col(law).alias("l"), F.col(section).alias("s"))
    return every.withColumnRenamed("node_id", "primary").join(primary.select(F.col(node).alias("primary")).distinct(), "primary"), every


def both_ways(edges: DataFrame) -> DataFrame:
    """(node, next, back, edge_type, edge_ord): each edge at both its ends, back 1 at its target."""
    out = edges.select(F.col("source").alias("node"), F.col("target").alias("next"), F.lit(0).alias("back"), "edge_type", "edge_ord")
    return out.union(edges.select("target", "source", F.lit(1), "edge_type", "edge_ord"))


def walkable(both: DataFrame) -> DataFrame:
    """(from_id, next, edge): the edges that expand() follows, edge being what decides between those of two nodes."""
    followed = both.filter(((F.col("back") == 0) & ~F.col("edge_type").isin(*HIERARCHY)) | ((F.col("back") == 1) & (F.col("edge_type") == "EXCEPTS")))
    return followed.select(F.col("node").alias("from_id"), "next", F.struct("back", "edge_ord", F.col("edge_type").alias("via")).alias("edge"))


def store_adjacency(edges: DataFrame, path: str, buckets: int = 256, names: tuple[str, ...] = ("adjacency", "walk")) -> None:
    """Writes the edges at both their ends and the walkable ones, or one of the two, each as a table bucketed and sorted by node under path,
    so that a join by node moves the other side alone. edges: source, target, edge_type, edge_ord."""
    spark, both = edges.sparkSession, both_ways(edges)
    kinds = []
    for name, rows, node in (("adjacency", both, "node"), ("walk", walkable(both), "from_id")):
        if name in names:  # a task has all of a bucket, so each bucket is one file
            rows.repartition(buckets, node).write.mode("overwrite").bucketBy(buckets, node).sortBy(node).option("path", f"{path}/{name}").saveAsTable(_table(path, name))
            kinds.append((name, node, spark.table(_table(path, name)).schema.json(), buckets))
    spark.createDataFrame(kinds, "name string, node string, kind string, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def stored(spark: SparkSession, path: str, name: str = "adjacency") -> DataFrame:
    """A table of store_adjacency(), `adjacency` or `walk`; a session that has not written it learns its buckets from the folder."""
    table = _table(path, name)
    if not spark.catalog.tableExists(table):
        layout = spark.read.parquet(f"{path}/layout").filter(F.col("name") == name).first()
        kinds = StructType.fromJson(json.loads(layout.kind))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({layout.node}) SORTED BY ({layout.node}) INTO {layout.buckets} BUCKETS LOCATION '{path}/{name}'")
    return spark.table(table)


def _table(path: str, name: str) -> str:
    return f"{name}_{hashlib.md5(path.encode()).hexdigest()}"


class Reach(NamedTuple):
    """What expand() finds, before it is written out for each primary.

    A section's nodes are the same for all its primaries, but for the primary itself, which stands first. So what a hop reaches
    is the same too, and in the same order, but for the nodes that are reached from the primary itself: those come first.

    starts: (primary, score, team, n), primaries of the same sections being a team, numbered from 0.
    common: (team, node_id, hop, relation, path, queue) as for a team without a first node; a path lacks the primary.
    own: (team, n, primary, score, node_id, hop, relation, path, queue), which takes the place of the team's row of that node.
    """

    starts: DataFrame
    common: DataFrame
    own: DataFrame


#: Added to the place of a team's row, so that it comes after the primary's own; numbers of a team's primaries that stand in
#: one row, and parts that a team's rows are dealt to.
AFTER, TOGETHER, SLOTS = 1 << 40, 4096, 64
#: What decides between edges of two nodes.
DECIDES = ("edge.back", "edge.edge_ord", "edge.via")


def expand(primaries: DataFrame, nodes: DataFrame, edges: DataFrame | None = None, hops: int = 2, walk: DataFrame | None = None, value: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """(primary, score, node_id, hop, relation, path, queue): what is reached from each primary (primary, score) and its
    siblings over outgoing edges but those of the hierarchy, and over incoming EXCEPTS, on the first visit: the lowest hop,
    then the place of the node that it is reached from, then outgoing before incoming, then the edge's order. A path begins
    at the primary. Placeholders (external:, definition:) are reached but lead nowhere; queue orders a primary's rows of one hop.
    edges: source, target, edge_type, edge_ord; or walk, as stored() gives it, whose edges then stay where they are.
    value: what stands in place of the score, from score, hop and relation.

    The rows grow with primaries times nodes, so they are made where they are wanted: only a team's rows and the primaries'
    own ones are shuffled or written. What does not differ between the nodes of one hop and relation, the value, is worked out once for them,
    and a row costs no more than its columns: no lambda runs and no number is rounded for it.
    """
    found = reach(primaries, nodes, edges, hops, walk)
    value = value or (lambda score, hop, relation: score)
    kind = F.to_json(F.struct("hop", "relation")).alias("kind")
    kinds = stage(found.common.select("team", "hop", "relation").distinct(), "kinds")
    numbers = found.starts.groupBy("team", F.expr(f"n div {TOGETHER}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("n", "primary", "score"))).alias("who")).join(kinds, "team")
    who = F.transform("who", lambda x: F.struct(x["n"].alias("n"), x["primary"].alias("primary"), value(x["score"], F.col("hop"), F.col("relation")).alias("score")))
    numbers = stage(numbers.select("team", kind, who.alias("who")), "who").select("team", "kind", "who", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot"))
    sizes = found.common.groupBy("team").agg(F.count("*").alias("m")).join(found.starts.groupBy("team").agg(F.count("*").alias("k")), "team")
    parts = max(1, -(-(sizes.agg(F.sum(F.col("m") * F.col("k"))).first()[0] or 0) // PAIRS))
    hidden = found.own.groupBy("team", "node_id").agg(F.collect_set("n").alias("hidden"))
    rows = found.common.join(hidden, ["team", "node_id"], "left").withColumns({"kind": kind, "slot": F.pmod(F.xxhash64("node_id"), F.lit(SLOTS)).cast("int")})
    keys = ["team", "kind", "slot"]
    rows = rows.repartition(parts, *keys).join(numbers.repartition(parts, *keys).hint("merge"), keys)
    rows = rows.select("node_id", "hop", "relation", "path", "queue", "hidden", F.explode("who").alias("start"))  # the numbers go no further
    start = F.col("start")
    rows = rows.filter(F.col("hidden").isNull() | ~F.array_contains("hidden", start["n"]))
    rows = rows.select(start["primary"].alias("primary"), start["score"].alias("score"), "node_id", "hop", "relation", F.concat(F.array(start["primary"]), "path").alias("path"), (F.col("queue") + AFTER).alias("queue"))
    return rows.unionByName(found.own.withColumn("score", value(F.col("score"), F.col("hop"), F.col("relation"))).select(rows.columns))


def reach(primaries: DataFrame, nodes: DataFrame, edges: DataFrame | None = None, hops: int = 2, walk: DataFrame | None = None) -> Reach:
    """The staged tables that expand() and selected() work from.

    Edges are dealt by node once and then read where they lie, against a frontier that is hashed. A step needs the least place of a
    neighbour alone, one number aggregated before the shuffle; edge and path are looked up afterwards for what is left, and
    of several edges between two nodes the best is taken there.
    """
    spark = primaries.sparkSession
    mine, every = _members(primaries.select(F.col("primary").alias("node_id")), nodes)
    of = mine.filter("l is not null and s is not null").groupBy("primary").agg(F.array_join(F.array_sort(F.collect_set(F.to_json(F.struct("l", "s")))), "\n").alias("of"), F.collect_set(F.struct("l", "s")).alias("sections"))
    of = stage(of, "sections")
    teams = of.groupBy("of").agg(F.min("primary").alias("team"), F.first("sections").alias("sections"))
    of = of.select("primary", "of").join(teams.select("of", "team"), "of").select("primary", "team")
    number = (F.row_number().over(Window.partitionBy("team").orderBy("primary", "score")) - 1).cast("int")
    starts = stage(primaries.select("primary", "score").join(of, "primary").withColumn("n", number), "starts")
    if walk is None:
        path = fresh_path(spark, "adjacency")
        store_adjacency(edges, path, int(spark.conf.get("spark.sql.shuffle.partitions")), ("walk",))
        walk = stored(spark, path, "walk")
    siblings = teams.select("team", F.explode("sections").alias("x")).select("team", "x.*").join(every, ["l", "s"]).select(F.col("team").alias("primary"), "node_id").distinct()
    place = F.row_number().over(Window.partitionBy("primary").orderBy("node_id")).cast("long")
    nothing = F.slice(F.array("node_id"), 1, 0)
    level = stage(siblings.select("primary", "node_id", F.lit(0).alias("hop"), place.alias("queue"), F.lit(None).cast("string").alias("relation"), nothing.alias("path")), "hop0")
    mine = starts.select("team", F.col("primary").alias("node_id"), "primary").distinct().select("team", "primary", "node_id", F.lit(1).cast("long").alias("queue"), nothing.alias("path"))
    seen, levels, own = level, [], []
    for hop in range(1, hops + 1):
        with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):  # buckets by node serve a join by both ends
            level = stage(step(level, seen, walk, hop), f"hop{hop}")
            mine = stage(own_step(mine, level, walk, hop), f"own{hop}")
        seen, levels, own = seen.union(level), [*levels, level], [*own, mine]
    common, mine = reduce(DataFrame.union, levels).withColumnRenamed("primary", "team"), reduce(DataFrame.union, own)
    path = F.concat(F.array("primary"), "path").alias("path")
    return Reach(starts, common, mine.join(starts.select("primary", "n", "score"), "primary").select("team", "n", "primary", "score", "node_id", "hop", "relation", path, "queue"))


def own_step(frontier: DataFrame, level: DataFrame, walk: DataFrame, hop: int) -> DataFrame:
    """What is reached from a primary's own nodes (team, primary, node_id, queue, path), of the nodes that its team reaches at this hop."""
    at = frontier.select("team", "primary", F.col("node_id").alias("from_id"), "queue", "path").hint("shuffle_hash")
    found = at.join(walk, "from_id").join(level.select(F.col("primary").alias("team"), F.col("node_id").alias("next")), ["team", "next"], "left_semi").drop("from_id")
    best = Window.partitionBy("primary", "next").orderBy("queue", *DECIDES)
    fresh = found.repartition("primary").withColumn("nth", F.row_number().over(best)).filter("nth = 1")  # a primary's rows move once for both windows
    place = F.row_number().over(Window.partitionBy("primary").orderBy("queue", *DECIDES[:2], "next")).cast("long")
    return fresh.select("team", "primary", F.col("next").alias("node_id"), F.lit(hop).alias("hop"), place.alias("queue"), F.col("edge.via").alias("relation"), F.concat("path", F.array("next")).alias("path"))


def step(frontier: DataFrame, seen: DataFrame, walk: DataFrame, hop: int) -> DataFrame:
    """What a hop reaches that has not been seen."""
    reached = frontier.select("primary", F.col("node_id").alias("from_id"), "queue").hint("shuffle_hash").join(walk.select("from_id", "next"), "from_id")
    reached = reached.groupBy("primary", "next").agg(F.min("queue").alias("queue")).join(seen.select("primary", F.col("node_id").alias("next")), ["primary", "next"], "left_anti")
    parents = frontier.select("primary", F.col("node_id").alias("from_id"), "queue", "path")
    fresh = reached.join(parents, ["primary", "queue"]).hint("shuffle_hash").join(walk, ["from_id", "next"])
    fresh = fresh.repartition("primary").withColumn("nth", F.row_number().over(Window.partitionBy("primary", "next").orderBy(*DECIDES))).filter("nth = 1")
    place = F.row_number().over(Window.partitionBy("primary").orderBy("queue", *DECIDES[:2], "next")).cast("long")
    return fresh.select("primary", F.col("next").alias("node_id"), F.lit(hop).alias("hop"), place.alias("queue"), F.col("edge.via").alias("relation"), F.concat("path", F.array("next")).alias("path"))


def neighbor_score(score: Column, hop: Column, relation: Column, decay: float = 0.05, step: float = 0.01) -> Column:
    priority = F.lit(0)
    for name, value in PRIORITY.items():
        priority = F.when(relation == name, value).otherwise(priority)
    return F.greatest(F.lit(0.0), score - F.lit(decay) * hop + F.lit(step) * priority)


def selected(primaries: DataFrame, nodes: DataFrame, edges: DataFrame | None = None, hops: int = 2, walk: DataFrame | None = None, most: int = 5) -> DataFrame:
    """support() of expand(), from a team's rows in order: of these a primary looks at the first `most` (of EXCEPTS the first)
    that it does not reach itself, and at its own."""
    found = reach(primaries, nodes, edges, hops, walk)
    real = nodes.select("node_id").distinct()
    priority, excepts = _priority(F.col("relation")), F.coalesce(F.col("relation") == "EXCEPTS", F.lit(False))
    # a score falls with the hop within one relation, whatever the primary's own score
    order = Window.partitionBy("team", "excepts").orderBy(F.desc(priority), "hop", "queue")
    common = found.common.join(real, "node_id", "left_semi").withColumn("excepts", excepts).withColumn("at", F.row_number().over(order))
    common = stage(common.select("team", "excepts", "at", "node_id", "hop", "relation", "queue"), "ranked")
    own = found.own.join(real, "node_id", "left_semi")
    hidden = own.select("team", "n", "node_id").join(common.select("team", "node_id", "excepts", "at"), ["team", "node_id"])
    nth = F.row_number().over(Window.partitionBy("team", "n", "excepts").orderBy("at"))
    hidden = hidden.withColumn("before", F.col("at") - nth).filter(F.col("before") < most).groupBy("team", "n", "excepts").agg(F.collect_set("at").alias("hidden"))
    asked = found.starts.select("team", "n", "primary", "score", F.explode(F.array(F.lit(True), F.lit(False))).alias("excepts")).join(hidden, ["team", "n", "excepts"], "left")
    gone = F.coalesce("hidden", F.array().cast("array<int>"))
    wanted = F.slice(F.array_except(F.sequence(F.lit(1), F.size(gone) + most), gone), F.lit(1), F.when(F.col("excepts"), 1).otherwise(most))
    first = asked.select("team", "primary", "score", "excepts", F.explode(wanted).alias("at")).join(common, ["team", "excepts", "at"])
    rows = own.select("primary", "score", "node_id", "hop", "relation", "queue").unionByName(first.select("primary", "score", "node_id", "hop", "relation", (F.col("queue") + AFTER).alias("queue")))
    return support(rows, nodes, most)


def _priority(relation: Column) -> Column:
    return F.when(relation == "EXCEPTS", 3).when(relation == "REFERS_TO", 2).when(relation == "DEFINES", 1).otherwise(0)


def support(expanded: DataFrame, nodes: DataFrame, most: int = 5) -> DataFrame:
    """(primary, place, node_id, hop, relation, support_score): resolved nodes only; at most one EXCEPTS, which comes first
    and is the first met, then the others by relation and score; the cap includes it."""
    real = expanded.join(nodes.select("node_id"), "node_id", "left_semi").withColumn("support_score", F.round(neighbor_score(F.col("score"), F.col("hop"), F.col("relation")), 6))
    priority = _priority(F.col("relation"))
    nth = F.row_number().over(Window.partitionBy("primary", F.col("relation") == "EXCEPTS").orderBy("hop", "queue"))
    kept = real.withColumn("nth", nth).filter(~((F.col("relation") == "EXCEPTS") & (F.col("nth") > 1)))
    order = Window.partitionBy("primary").orderBy(F.desc(priority), F.desc("support_score"), "hop", "queue")
    return kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).select("primary", "place", "node_id", "hop", "relation", "support_score")


def neighbors(start: DataFrame, edges: DataFrame | None, hops: int, adjacency: DataFrame | None = None) -> DataFrame:
    """(start, node_id, hop): nodes within hops over edges of all kinds in both directions, each at its least distance; edges
    as (source, target), or adjacency as stored() gives it."""
    if adjacency is None:
        both = edges.select(F.col("source").alias("node_id"), F.col("target").alias("next")).union(edges.select("target", "source")).distinct()
    else:
        both = adjacency.select(F.col("node").alias("node_id"), "next")
    frontier = start.select(F.col("node_id").alias("start"), "node_id", F.lit(0).alias("hop")).distinct()
    seen = frontier
    for hop in range(1, hops + 1):
        step = frontier.join(both, "node_id").select("start", F.col("next").alias("node_id")).distinct()
        frontier = step.join(seen.select("start", "node_id"), ["start", "node_id"], "left_anti").withColumn("hop", F.lit(hop))
        if hop < hops:
            frontier = stage(frontier, f"hop{hop}")
        seen = seen.union(frontier)
    return seen


def lookup(nodes: DataFrame, part: str, most: int = 10) -> DataFrame:
    """Nodes whose id holds the text, the first in order of id."""
    return nodes.filter(F.contains("node_id", F.lit(part))).orderBy("node_id").limit(most)


def index_ids(nodes: DataFrame, path: str) -> None:
    """Writes the index that lookup_indexed reads."""
    text_index.build(nodes.select(F.col("node_id").alias("id"), F.col("node_id").alias("text")), path)


def lookup_indexed(nodes: DataFrame, path: str, part: str, most: int = 10) -> DataFrame:
    """As lookup(), but case does not count and only the posting lists of the part's grams are read before nodes are joined."""
    spark = nodes.sparkSession
    found = text_index.find(spark, path, spark.createDataFrame([(part,)], "word string")).select(F.col("id").alias("node_id"))
    return nodes.join(found, "node_id", "left_semi").orderBy("node_id").limit(most)


def section_lookup(nodes: DataFrame, edges: DataFrame | None, law_part: str, section: int, most: int = 20, adjacency: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A section's nodes by moment, and the first incoming references and exceptions to them, from edges or a stored adjacency."""
    if adjacency is not None:
        edges = adjacency.filter("back = 1").select(F.col("next").alias("source"), F.col("node").alias("target"), "edge_type")
    found = nodes.filter(F.contains("law_key", F.lit(law_part)) & (F.col("section_num") == section)).orderBy("moment")
    incoming = edges.filter(F.col("edge_type").isin("REFERS_TO", "EXCEPTS")).join(found.select(F.col("node_id").alias("target")), "target", "left_semi")
    return found, incoming.orderBy("target", "source", "edge_type").limit(most)
