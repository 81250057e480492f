"""Rows of rules and reports made ready: tags, anchors, texts to embed, cleaned lines, keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, NumericType, StringType

from sparquill.functions.text import strip


def keyword_tags(text: Column, rules: dict[str, tuple[str, ...]], *more: Column) -> Column:
    """Sorted distinct tags of all keywords that the lower-cased text holds, and the given arrays of tags."""
    low = F.lower(text)
    found = [F.when(F.contains(low, F.lit(k)), F.array(*[F.lit(t) for t in tags])).otherwise(F.array().cast("array<string>")) for k, tags in rules.items()]
    extra = [F.coalesce(m, F.array().cast("array<string>")) for m in more]
    return F.array_sort(F.array_distinct(F.concat(*found, *extra)))


def merged_rules(default: dict[str, tuple[str, ...]], own: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, ...]]:
    """A rule of one's own replaces the default of the same keyword."""
    return default | own


def tag_rules(*rules: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, ...]]:
    """One rule a keyword with the tags of all the given sets of rules."""
    return {k: tuple(dict.fromkeys(t for r in rules for t in r.get(k, ()))) for k in dict.fromkeys(k for r in rules for k in r)}


def anchors(rows: DataFrame, of: DataFrame, section: str = "section_id", moment: str = "moment") -> DataFrame:
    """rows with `anchors`: those of the section's moment, then those of its 'default'; order and repeats are kept.
    of has a row a (section, moment) with its array of anchors."""
    exact = of.select(F.col("section").alias(section), F.col("moment").alias(moment), F.col("anchors").alias("exact"))
    default = of.filter("moment = 'default'").select(F.col("section").alias(section), F.col("anchors").alias("rest"))
    none = F.array().cast("array<string>")
    joined = rows.join(exact, [section, moment], "left").join(default, section, "left")
    return joined.withColumn("anchors", F.concat(F.coalesce("exact", none), F.coalesce("rest", none))).drop("exact", "rest")


def embedding_text(section: Column, title: Column, text: Column, with_section: Column) -> Column:
    """'§ id title: text' where with_section holds, else 'title. text'."""
    return F.when(with_section, F.concat(F.lit("§ "), section, F.lit(" "), title, F.lit(": "), text)).otherwise(F.concat(title, F.lit(". "), text))


def indexable(node_type: Column, title: Column, text: Column, types: tuple[str, ...] = ("SECTION", "PARA", "TABLE", "ROW", "METRIC"), least: int = 20) -> Column:
    return node_type.isin(*types) & (F.length(strip(F.concat_ws(" ", title, text))) >= least)


def document_text(node_type: Column, title: Column, text: Column, cells: Column, value: Column, unit: Column) -> Column:
    """Title and text, a table's or row's cells with bars between them, a metric's value and unit."""
    filled = lambda c: F.when(F.length(c) > 0, c)
    return F.concat_ws("\n", filled(title), filled(text), F.when(node_type.isin("TABLE", "ROW"), filled(F.array_join(cells, " | "))), F.when(node_type == "METRIC", F.concat(F.lit("Arvo: "), value.cast("string"), F.lit(" "), F.coalesce(unit, F.lit("")))))


def clean_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text), a row a row: lines of digits alone go, then exact repeats of the line before, and blank lines at the start
    or after another blank one. A fold over each text's own lines; rows of one key do not meet."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: ~x.rlike(r"^\s*\d+\s*$"))
    blank = lambda x: strip(x) == ""
    line, before = lambda i: F.get("lines", i), lambda i: F.get("lines", i - 1)
    stays = lambda i: F.when(blank(line(i)), F.coalesce(~blank(before(i)), F.lit(False))).otherwise(~line(i).eqNullSafe(before(i)))
    places = F.filter(F.transform("lines", lambda x, i: i), stays)
    return docs.select(key, lines.alias("lines")).select(key, F.array_join(F.transform(places, line), "\n").alias("text"))


def keywords(text: Column, stop: tuple[str, ...], longer_than: int = 3) -> Column:
    """White-space separated words of more than longer_than characters that are no stop words, repeats kept."""
    return F.filter(F.split(F.trim(F.lower(text)), r"\s+"), lambda w: (F.length(w) > longer_than) & ~w.isin(*stop))


def anchor_terms(text: Column, most: int = 5) -> Column:
    """The first `most` in alphabetical order of a text's distinct words of four letters or more."""
    return F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-zäöå]{4,}"), F.lit(0)))), 1, most)


def most_common(rows: DataFrame, array: str, n: int) -> DataFrame:
    """(term, n): the n terms most often found in an array column; of equals the alphabetically first."""
    counts = rows.select(F.explode(array).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(n)


def domain_filter(section: Column, tags: Column, sections: tuple[str, ...], required: tuple[str, ...]) -> Column:
    """Section in the list, or a required tag held."""
    return section.isin(*sections) | F.arrays_overlap(tags, F.array(*[F.lit(t) for t in required]))


def display_name(source: Column, names: dict[str, str]) -> Column:
    """The readable name of a source; one without a name keeps its key."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), source), source)


def flat_metadata(rows: DataFrame, *columns: str) -> DataFrame:
    """rows whose named columns are scalars: lists as JSON text, texts, numbers and booleans as they are, anything else as text."""

    def flat(name: str) -> Column:
        kind = rows.schema[name].dataType
        if isinstance(kind, ArrayType):
            return F.to_json(name)
        return F.col(name) if isinstance(kind, (StringType, NumericType, BooleanType)) else F.col(name).cast("string")

    return rows.withColumns({c: flat(c) for c in columns})


def decoded_list(value: Column) -> Column:
    """The list that a VARIANT holds as an array or as JSON text of one; empty where it is neither, broken text included."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(F.try_variant_get(F.try_parse_json(text), "$", "array<string>"), F.array().cast("array<string>"))


def vector_rows(rows: DataFrame) -> DataFrame:
    """What is indexed of moments: id, document ('title. text') and the metadata, with empty values in place of nulls."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    lists = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c)
    names = ("law", "law_id", "law_key", "node_id", "finlex_version", "chapter", "chapter_title", "section_id")
    return rows.select(
        F.col("node_id").alias("id"), F.concat(F.col("section_title"), F.lit(". "), F.col("text")).alias("document"), *[text(c) for c in names],
        F.coalesce("section_num", F.lit(0)).alias("section_num"), *[text(c) for c in ("section_suffix", "section_title", "moment")], lists("tags"), lists("anchors"), F.coalesce("in_force", F.lit(False)).alias("in_force"),
    )
