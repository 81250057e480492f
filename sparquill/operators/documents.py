"""Report documents: flattening to a graph, table rows, keyword search, abstention, evidence mapping, paraphrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, VariantType

from sparquill.functions.text import TOKEN, first_held, number, strip
from sparquill.operators import matching, text_index
from sparquill.staging import stage

TABLES = "array<struct<title:string,rows:array<struct<cells:array<string>>>>>"
#: Rows of a table of rules that are sent to all tasks.
SENT = 4096


def section_type(depth: int) -> str:
    """DDL of a section with subsections unrolled to a depth."""
    kids = f", subsections: ARRAY<{section_type(depth - 1)}>" if depth else ""
    return f"STRUCT<title: STRING, level: INT, paragraphs: ARRAY<STRING>, tables: ARRAY<STRUCT<title: STRING, rows: ARRAY<STRUCT<cells: ARRAY<STRING>>>>>{kids}>"


def document_schema(depth: int) -> str:
    """DDL of documents with sections of a known depth; without it they are read as VARIANT, of whatever depth."""
    return f"city STRING, year INT, title STRING, pages ARRAY<STRUCT<page_num: INT, sections: ARRAY<{section_type(depth)}>>>, metrics ARRAY<STRUCT<name: STRING, value: DOUBLE, unit: STRING, page: INT>>"


def slug(text: Column, length: int) -> Column:
    return F.substring(F.replace(F.lower(text), F.lit(" "), F.lit("_")), 1, length)


def _node(root: Column, kind: str, path: Column) -> Column:
    return F.concat_ws(":", root, F.lit(kind), path)


def _kids(kind: DataType, name: str) -> StructType | None:
    """The struct type of the members of an array field; None where the schema has no such field or only empty ones."""
    found = kind[name].dataType if isinstance(kind, StructType) and name in kind.fieldNames() else None
    return found.elementType if isinstance(found, ArrayType) and isinstance(found.elementType, StructType) else None


def _field(of: Column, kind: StructType, name: str, like: str) -> Column:
    return of[name].cast(like) if name in kind.fieldNames() else F.lit(None).cast(like)


def _tables(section: Column, kind: StructType) -> Column:
    """A section's tables in one form, whatever fields and order the schema has."""
    table = _kids(kind, "tables")
    if table is None:
        return F.lit(None).cast(TABLES)
    row = _kids(table, "rows")
    rows = lambda t: F.transform(t["rows"], lambda r: F.struct(_field(r, row, "cells", "array<string>").alias("cells"))) if row is not None else F.lit(None).cast("array<struct<cells:array<string>>>")
    return F.transform(section["tables"], lambda t: F.struct(_field(t, table, "title", "string").alias("title"), rows(t).alias("rows")))


def _named(title: Column, pos: Column, above: Column) -> Column:
    """A section's path: that of the one above and its own slug, joined by a colon."""
    return F.concat_ws(":", F.nullif(above, F.lit("")), slug(F.coalesce(title, F.concat(F.lit("section_"), pos.cast("string"))), 30))


def _within(kids: Column, kind: StructType, root: Column, page: Column, above: Column, place: Column, parent: Column, depth: int = 0) -> Column:
    """All sections of a list and of those below it as one array, as deep as the schema goes."""
    title = lambda s: _field(s, kind, "title", "string")
    path = lambda s, pos: _named(title(s), pos, above)
    own = F.transform(
        kids,
        lambda s, pos: F.struct(
            page.alias("page"), path(s, pos).alias("path"), parent.alias("parent"), place.alias("place"), F.lit(depth).alias("depth"), pos.alias("pos"), F.coalesce(title(s), F.lit("")).alias("title"),
            F.coalesce(_field(s, kind, "level", "int"), F.lit(1)).alias("level"), _field(s, kind, "paragraphs", "array<string>").alias("paragraphs"), _tables(s, kind).alias("tables"),
        ),
    )
    own, below = F.coalesce(own, F.array().cast(f"array<struct<{SECTION}>>")), _kids(kind, "subsections")
    if below is None:
        return own
    deeper = F.transform(kids, lambda s, pos: _within(s["subsections"], below, root, page, path(s, pos), F.concat(place, F.array(pos)), _node(root, "SECTION", path(s, pos)), depth + 1))
    return F.concat(own, F.coalesce(F.flatten(deeper), F.array().cast(f"array<struct<{SECTION}>>")))


SECTION = f"page:int,path:string,parent:string,place:array<int>,depth:int,pos:int,title:string,level:int,paragraphs:array<string>,tables:{TABLES}"


def sections(docs: DataFrame, *carry: str) -> DataFrame:
    """Every section of (root, pages), at any depth: root, page, path, parent, place (of its list: the page's and the
    sections' positions above), depth, pos, title, level, paragraphs, tables, and the columns to carry. Documents are read
    once: of a typed schema all sections are gathered by one expression, which goes as deep as the schema; documents with
    their pages as a VARIANT in `body` give their sections level by level, and each step reads what lies below the last alone."""
    if "body" in docs.columns and isinstance(docs.schema["body"].dataType, VariantType):
        return _variant_sections(docs, carry)
    page, kind = docs.schema["pages"].dataType.elementType, _kids(docs.schema["pages"].dataType.elementType, "sections")
    if kind is None:
        return docs.select("root", *carry, F.explode(F.array().cast(f"array<struct<{SECTION}>>")).alias("s")).select("root", *carry, "s.*")
    pages = docs.select("root", *carry, F.posexplode("pages").alias("at", "p"))
    number = _field(F.col("p"), page, "page_num", "int")
    every = _within(F.col("p.sections"), kind, F.col("root"), number, F.lit(""), F.array("at"), _node(F.col("root"), "PAGE", number.cast("string")))
    return pages.select("root", *carry, F.explode(every).alias("s")).select("root", *carry, "s.*")


def _variant_sections(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    get = lambda of, name, kind: F.try_variant_get(of, f"$.{name}", kind)
    inner = lambda df, of: df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(of).outer()))
    page = get(F.col("value"), "page_num", "int")
    level = inner(docs.select("root", *carry, "body"), "body").select("root", *carry, F.array("pos").alias("place"), page.alias("page"), F.lit("").alias("above"), _node(F.col("root"), "PAGE", page.cast("string")).alias("parent"), get(F.col("value"), "sections", "variant").alias("kids"))
    rows, depth = None, 0
    while True:
        value, title = F.col("value"), get(F.col("value"), "title", "string")
        found = inner(level.filter("kids is not null"), "kids").select(
            "root", *carry, "page", _named(title, F.col("pos"), F.col("above")).alias("path"), "parent", "place", F.lit(depth).alias("depth"), "pos", F.coalesce(title, F.lit("")).alias("title"),
            F.coalesce(get(value, "level", "int"), F.lit(1)).alias("level"), get(value, "paragraphs", "array<string>").alias("paragraphs"), get(value, "tables", TABLES).alias("tables"), get(value, "subsections", "variant").alias("kids"),
        )
        found = stage(found, f"depth{depth}")
        rows = found.drop("kids") if rows is None else rows.unionByName(found.drop("kids"))
        level = found.filter("kids is not null").select("root", *carry, F.concat("place", F.array("pos")).alias("place"), "page", F.col("path").alias("above"), _node(F.col("root"), "SECTION", F.col("path")).alias("parent"), "kids")
        if level.isEmpty():
            return rows
        depth += 1


def document_graph(docs: DataFrame, paragraph_least: int = 50) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges (source, target, edge_type, context) of documents (city, year, title, pages, metrics): DOC, PAGE,
    SECTION, PARA, TABLE, ROW, METRIC; HAS_PAGE, HAS_SECTION, HAS_PARA, HAS_TABLE, HAS_ROW, and NEXT between neighbouring
    pages and sibling sections, at any depth. Metrics have a parent but no edge. Paragraphs of paragraph_least characters
    or fewer are no nodes of their own; repeated ids are not merged."""
    base = docs.withColumn("root", F.concat_ws(":", "city", F.col("year").cast("string")))
    none = F.lit(None)
    found = stage(sections(base, "city", "year"), "sections").withColumn("node_id", _node(F.col("root"), "SECTION", F.col("path")))

    def node(df: DataFrame, ident: Column, kind: str, title: Column, text: Column, page: Column, parent: Column, context: Column = none, pages=none, level=none, row_count=none, cells=none, value=none, unit=none) -> DataFrame:
        meta = F.struct(pages.cast("int").alias("total_pages"), level.cast("int").alias("level"), row_count.cast("int").alias("row_count"), cells.cast("array<string>").alias("cells"), value.cast("double").alias("value"), unit.cast("string").alias("unit"))
        return df.select(ident.alias("node_id"), F.lit(kind).alias("node_type"), "city", F.col("year").cast("int").alias("year"), title.alias("title"), text.alias("text"), page.cast("int").alias("page_num"), parent.cast("string").alias("parent_id"), meta.alias("metadata"), context.cast("string").alias("context"))

    doc_id = _node(F.col("root"), "DOC", F.lit("root"))
    doc = node(base, doc_id, "DOC", F.col("title"), F.lit(""), none, none, pages=F.size(F.coalesce("pages", F.array().cast(base.schema["pages"].dataType))))
    page_rows = base.select("root", "city", "year", F.posexplode("pages").alias("pos", "p"))
    page_name = F.col("p.page_num").cast("string")
    page_id = _node(F.col("root"), "PAGE", page_name)
    pages = node(page_rows, page_id, "PAGE", F.concat(F.lit("Sivu "), page_name), F.lit(""), F.col("p.page_num"), doc_id, F.concat(F.lit("Page "), page_name))
    secs = node(found, F.col("node_id"), "SECTION", F.col("title"), F.coalesce(F.array_join("paragraphs", "\n"), F.lit("")), F.col("page"), F.col("parent"), F.col("title"), level=F.col("level"))
    paras_in = found.select("root", "city", "year", "page", "node_id", "path", F.posexplode("paragraphs").alias("i", "body")).filter(F.length(strip(F.col("body"))) > paragraph_least)
    at = F.col("i").cast("string")
    paras = node(paras_in, _node(F.col("root"), "PARA", F.concat("path", F.lit(":p"), at)), "PARA", F.lit(""), F.col("body"), F.col("page"), F.col("node_id"), F.concat(F.lit("Paragraph "), at))
    tables_in = found.select("root", "city", "year", "page", "node_id", "path", F.posexplode("tables").alias("t", "tab")).withColumn("name", F.coalesce("tab.title", F.concat(F.lit("table_"), F.col("t").cast("string"))))
    tables_in = tables_in.withColumn("tpath", F.concat_ws(":", "path", slug(F.col("name"), 20))).withColumn("table_id", _node(F.col("root"), "TABLE", F.col("tpath")))
    tables = node(tables_in, F.col("table_id"), "TABLE", F.col("name"), F.lit(""), F.col("page"), F.col("node_id"), F.col("name"), row_count=F.coalesce(F.size("tab.rows"), F.lit(0)))
    rows_in = tables_in.select("root", "city", "year", "page", "tpath", "table_id", F.posexplode("tab.rows").alias("r", "row"))
    at = F.col("r").cast("string")
    rows = node(rows_in, _node(F.col("root"), "ROW", F.concat("tpath", F.lit(":r"), at)), "ROW", F.coalesce(F.get("row.cells", F.lit(0)), F.lit("")), F.coalesce(F.array_join("row.cells", " | "), F.lit("")), F.col("page"), F.col("table_id"), F.concat(F.lit("Row "), at), cells=F.col("row.cells"))
    nodes = doc.unionByName(pages).unionByName(secs).unionByName(paras).unionByName(tables).unionByName(rows)
    metric = _kids(base.schema, "metrics")
    if metric is not None:
        m, unit = F.col("m"), F.coalesce(_field(F.col("m"), metric, "unit", "string"), F.lit(""))
        metrics_in = base.select("root", "city", "year", F.explode("metrics").alias("m"))
        nodes = nodes.unionByName(node(metrics_in, _node(F.col("root"), "METRIC", m["name"]), "METRIC", m["name"], F.concat_ws(" ", m["value"].cast("string"), unit), _field(m, metric, "page", "int"), doc_id, value=m["value"], unit=unit))
    kinds = {"PAGE": "HAS_PAGE", "SECTION": "HAS_SECTION", "PARA": "HAS_PARA", "TABLE": "HAS_TABLE", "ROW": "HAS_ROW"}
    name = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    owned = nodes.filter(F.col("node_type").isin(*kinds)).select(F.col("parent_id").alias("source"), F.col("node_id").alias("target"), F.element_at(name, F.col("node_type")).alias("edge_type"), "context")
    next_page = page_rows.select(F.lag(page_id).over(Window.partitionBy("root").orderBy("pos")).alias("source"), page_id.alias("target"), F.lit("Sequential pages").alias("context"))
    next_section = found.select(F.lag("node_id").over(Window.partitionBy("root", "place").orderBy("pos")).alias("source"), F.col("node_id").alias("target"), F.lit("Sequential sections").alias("context"))
    following = next_page.union(next_section).filter("source is not null").withColumn("edge_type", F.lit("NEXT"))
    return nodes.drop("context"), owned.unionByName(following)


def table_rows(docs: DataFrame) -> DataFrame:
    """(page, section, table_title, row_name, value_2023, value_2022, row_idx) of rows of two or more cells in sections and
    their direct subsections."""
    found = sections(docs.withColumn("root", F.lit(""))).filter("depth <= 1")
    tables = found.select("page", F.col("title").alias("section"), F.explode("tables").alias("t"))
    rows = tables.select("page", "section", F.col("t.title").alias("table_title"), F.posexplode("t.rows").alias("row_idx", "r")).filter(F.size("r.cells") >= 2)
    cell = lambda i: F.coalesce(F.get("r.cells", F.lit(i)), F.lit(""))
    return rows.select("page", "section", "table_title", cell(0).alias("row_name"), cell(1).alias("value_2023"), cell(2).alias("value_2022"), "row_idx")


def index_tables(rows: DataFrame, path: str) -> None:
    """Writes the index of names and titles that search_tables can read."""
    name = F.struct("row_name", "table_title")
    text_index.build(rows.select("row_name", "table_title").distinct().select(name.alias("id"), F.concat_ws("\n", F.coalesce("row_name", F.lit("")), F.coalesce("table_title", F.lit(""))).alias("text")), path)


def search_tables(questions: DataFrame, rows: DataFrame, key: str = "question_id", text: str = "text", most: int = 5, order: tuple[str, ...] = ("row_idx",), index: str | None = None) -> DataFrame:
    """rows with key, points and rank: each word of a question (repeats counted) gives 2 points if the row's name holds it
    and 1 if the table's title does; rows without points are no hits; the best first, ties in the given order.

    Names and titles are compared once each, not row by row, and different words once each: texts are found by the first
    one to three characters of a word, an equi-join, and then compared; with the path of an index, by its posting lists.
    """
    words = questions.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("times"))
    held = lambda c: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.col("word")).cast("int")
    if index is None:
        met = _sharing_lead(words, rows)
    else:
        met = text_index.find(questions.sparkSession, index, words).select("id.row_name", "id.table_title", "word")
    pairs = met.select("row_name", "table_title", "word", (2 * held("row_name") + held("table_title")).alias("worth")).filter("worth > 0")
    scored = words.join(pairs, "word").groupBy(key, "row_name", "table_title").agg(F.sum(F.col("times") * F.col("worth")).cast("int").alias("points"))
    best = Window.partitionBy(key).orderBy(F.desc("points"), *order)
    of = scored.select(key, F.col("row_name").alias("of_name"), F.col("table_title").alias("of_title"), "points")
    same = F.col("row_name").eqNullSafe(F.col("of_name")) & F.col("table_title").eqNullSafe(F.col("of_title"))
    return rows.join(of, same).drop("of_name", "of_title").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def _sharing_lead(words: DataFrame, rows: DataFrame) -> DataFrame:
    """(row_name, table_title, word): different texts that hold the first one to three characters of a word."""
    lead = words.select("word").distinct().withColumn("gram", F.substring("word", 1, 3))
    texts = rows.select("row_name", "table_title").distinct()
    body = F.lower(F.concat_ws("\n", F.coalesce("row_name", F.lit("")), F.coalesce("table_title", F.lit(""))))
    at = F.sequence(F.lit(1), F.length("body"))
    grams = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(*[F.substring(F.col("body"), i, F.lit(n)) for n in (1, 2, 3)]))))
    grams = texts.withColumn("body", body).filter(F.length("body") > 0).select("row_name", "table_title", F.explode(grams).alias("gram"))
    return grams.join(lead, "gram").select("row_name", "table_title", "word")


def abstain_signal(question: Column, signals: tuple[str, ...], verb: str = "vertaa", others: tuple[str, ...] = ("seinäj", "tamper")) -> Column:
    """The reason to abstain: the first signal held, or the verb of comparison with another place; else null."""
    low = F.lower(question)
    signal = first_held(low, signals)
    compared = F.contains(low, F.lit(verb)) & first_held(low, others).isNotNull()
    return F.when(signal.isNotNull(), F.concat(F.lit("Signal: "), signal)).when(compared, F.lit("Cross-city comparison"))


def signal_root(signal: str, vowels: str = "aeiouäö", least: int = 4) -> str:
    """A signal without its final vowels, if enough is left, so that inflected forms match."""
    root = signal.lower().rstrip(vowels)
    return root if len(root) >= least else signal.lower()


def abstain_reason(question: Column, best_score: Column, has_hits: Column, strong: tuple[str, ...], interpret: tuple[str, ...], years: str = r"\b202[4-9]\b|\b203\d\b", sure: float = 0.70) -> Column:
    """The first reason to abstain: a strong signal's root or itself; a pattern that asks for interpretation while the best
    score is below `sure`; a year to come; no hits. Null: answer."""
    low = F.lower(question)
    reasons = [F.when(F.contains(low, F.lit(signal_root(s))) | F.contains(low, F.lit(s.lower())), F.lit(f"Strong signal: '{s}'")) for s in strong]
    reasons += [F.when(low.rlike(p) & (F.coalesce(best_score, F.lit(0.0)) < sure), F.lit(f"Interpretation needed: '{p}'")) for p in interpret]
    reasons += [F.when(low.rlike(years), F.lit("Future/missing year")), F.when(~has_hits, F.lit("No relevant data found"))]
    return F.coalesce(*reasons)


def mapping_edges(pairs: DataFrame, rules: tuple[tuple[str, tuple[str, ...], str], ...], fallback: int = 3, law: str = "law_node_id", title: str = "title", text: str = "text") -> DataFrame:
    """Evidence edges for pairs (law node, doc_node_id, rank, score, title, text). Each rule (pattern in the law's id, sections
    in order, edge type) that fits gives an edge with the first of its sections that the hit's title or text holds; a law
    node without any such edge gets EVIDENCED_BY edges to its first hits."""
    body = F.concat_ws("\n", F.lower(title), F.lower(text))
    fits = [F.when(F.contains(F.col(law), F.lit(p)) & first_held(body, secs).isNotNull(), F.struct(F.lit(i).alias("rule_no"), F.lit(kind).alias("edge_type"), F.concat(F.lit(f"Rule match: {p} -> "), first_held(body, secs)).alias("context"))) for i, (p, secs, kind) in enumerate(rules)]
    ruled = pairs.withColumn("r", F.explode(F.array(*fits))).filter("r is not null").select(law, "doc_node_id", F.col("r.edge_type"), "score", F.substring(text, 1, 200).alias("evidence_text"), F.col("r.context"), F.col("r.rule_no"))
    rest = pairs.filter(F.col("rank") <= fallback).join(ruled.select(law).distinct(), law, "left_anti")
    generic = rest.select(law, "doc_node_id", F.lit("EVIDENCED_BY").alias("edge_type"), "score", F.substring(text, 1, 200).alias("evidence_text"), F.lit("Semantic similarity match").alias("context"), F.lit(-1).alias("rule_no"))
    return ruled.union(generic)


def mapping_edges_by_table(pairs: DataFrame, rules: DataFrame, fallback: int = 3, law: str = "law_node_id", title: str = "title", text: str = "text") -> DataFrame:
    """As mapping_edges(), by rules of a table (rule_no, pattern, edge_type, place, section): a row a section, places in order.
    Patterns and sections are each matched in one pass, however many they are."""
    body = F.concat_ws("\n", F.lower(title), F.lower(text))
    named = rules.select("pattern", F.col("rule_no").cast("string").alias("rule_no"))
    fired = pairs.withColumn("fits", matching.labels(F.col(law), named, "pattern", "rule_no")).filter(F.size("fits") > 0).withColumn("has", matching.held(body, rules, "section"))
    fired = fired.select(law, "doc_node_id", "rank", "score", F.substring(text, 1, 200).alias("evidence_text"), "has", F.explode("fits").alias("fit"))
    of = rules.select(F.col("rule_no").cast("string").alias("fit"), F.col("rule_no").cast("int").alias("rule_no"), "pattern", "edge_type", "place", "section")
    # Spark guesses hits by the bytes of the files they are made from and would send all of them to the driver
    few = rules.limit(SENT + 1).count() <= SENT
    met = (fired.join(F.broadcast(of), "fit") if few else fired.hint("merge").join(of, "fit")).filter(F.array_contains("has", F.col("section"))).groupBy(law, "doc_node_id", "rank", "score", "evidence_text", "rule_no", "pattern", "edge_type").agg(F.min_by("section", "place").alias("section"))
    ruled = met.select(law, "doc_node_id", "edge_type", "score", "evidence_text", F.concat(F.lit("Rule match: "), "pattern", F.lit(" -> "), "section").alias("context"), "rule_no")
    rest = pairs.filter(F.col("rank") <= fallback).join(ruled.select(law).distinct().hint("merge"), law, "left_anti")
    generic = rest.select(law, "doc_node_id", F.lit("EVIDENCED_BY").alias("edge_type"), "score", F.substring(text, 1, 200).alias("evidence_text"), F.lit("Semantic similarity match").alias("context"), F.lit(-1).alias("rule_no"))
    return ruled.unionByName(generic)


def numeric(text: Column) -> Column:
    return number(text)


def paraphrases(questions: DataFrame, synonyms: tuple[tuple[str, tuple[str, ...]], ...], most: int = 3, per_term: int = 2, key: str = "question_id", text: str = "text", extra: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(key, paraphrase_no, text): the question with a term replaced by a synonym, whatever its case; terms in order, the first
    per_term synonyms of each, then the extra (term, synonym) pairs; those equal to the question or to an earlier one but
    for case do not count; the first `most`."""
    plan = [(t, s) for t, syns in synonyms for s in syns[:per_term]] + list(extra)
    quoted = lambda t: "(?iu)\\Q" + t + "\\E"
    made = F.array(*[F.regexp_replace(F.col(text), quoted(t), s.replace("\\", "\\\\").replace("$", "\\$")) for t, s in plan])
    rows = questions.select(key, F.lower(text).alias("own"), F.posexplode(made).alias("at", "new")).filter(F.lower("new") != F.col("own"))
    first = F.row_number().over(Window.partitionBy(key, F.lower("new")).orderBy("at"))
    rows = rows.withColumn("nth", first).filter("nth = 1").withColumn("paraphrase_no", F.row_number().over(Window.partitionBy(key).orderBy("at")))
    return rows.filter(F.col("paraphrase_no") <= most).select(key, "paraphrase_no", F.col("new").alias("text"))


def question_set(base: DataFrame, made: DataFrame, more: list[DataFrame], categories: tuple[str, ...], of_must: int = 3, of_should: int = 2, key: str = "question_id", text: str = "text") -> DataFrame:
    """The questions with test_type 'base', then the first of_must paraphrases of each MUST question and the first of_should of
    each other one of the categories, as (key, text, test_type) with the columns of their question, then the rows of more."""
    spread = made.select(key, "paraphrase_no", F.col(text).alias("said")).join(base.drop(text), key)
    wanted = F.when(F.col("must"), F.col("paraphrase_no") <= of_must).otherwise(F.col("category").isin(*categories) & (F.col("paraphrase_no") <= of_should))
    ident = F.concat(F.col(key).cast("string"), F.lit("-p"), F.col("paraphrase_no").cast("string"))
    rows = spread.filter(wanted).withColumn(text, F.col("said")).withColumn(key, ident).drop("said", "paraphrase_no").withColumn("test_type", F.lit("synonym"))
    out = base.withColumn(key, F.col(key).cast("string")).withColumn("test_type", F.lit("base")).unionByName(rows)
    for part in more:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
