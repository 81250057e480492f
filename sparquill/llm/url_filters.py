"""URL filters: host and path rules first, then a path-template tree per host, in DataFrame operations alone.

Paths are reduced to shapes (digit runs become {n}) and counted per host and shape, so the tree is worked out from
aggregates. From the root down, a node's children are its next segments. A child stays a branch of its own only if its
labelled share of bad pages differs from that of its siblings (a two-proportion z test over at least `enough` labelled pages
of its own), and the others merge into the wildcard; the rule is the same for any number of children. A template whose smoothed share of bad pages, (bad + strength * corpus share) / (labelled + strength), reaches `purity` is rejected.

Totals are pre-aggregated before every shuffle; decisions join the counts, never the pages' rows, but for the last look-up
by host and shape.

Defined results: a null url or one without :// has an empty host and path, and all of these are judged as one host's; segments beyond `max_depth` are one; pages
without a label count for shapes, not for purity; with no labels at all nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import stage

ENOUGH, MAX_DEPTH, Z, STRENGTH, PURITY = 2, 8, 1.96, 4.0, 0.6
#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for of, start, then in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_ == of) | host_.endswith(f".{of}")) & path_.startswith(start)
        name, verdict = F.when(fits, F.lit(of + start)).otherwise(name), F.when(fits, F.lit(then)).otherwise(verdict)
    return name, verdict


def shape(path_: Column) -> Column:
    return F.regexp_replace(path_, "[0-9]+", "{n}")


def templates(counts: DataFrame, enough: int = ENOUGH, max_depth: int = MAX_DEPTH, z: float = Z) -> DataFrame:
    """(host, shape, labelled, bad, template) from (host, shape, labelled, bad)."""
    rows = counts.withColumn("segments", F.split("shape", "/", max_depth)).withColumn("template", F.element_at("segments", 1))
    depth = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(2, depth + 1):
        rows = stage(rows.withColumn("next", F.get("segments", F.lit(level - 1))), "level")
        kids = rows.filter("next is not null").groupBy("host", "template", "next").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        nodes = kids.groupBy("host", "template").agg(F.count("*").alias("fan"), F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        share = F.try_divide("all_b", "all_n")
        others = F.col("all_n") - F.col("n")
        error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1), "n") + F.try_divide(F.lit(1), others)))
        apart = F.abs(F.try_divide("b", "n") - F.try_divide(F.col("all_b") - F.col("b"), others)) > F.lit(z) * error
        own = (F.col("n") >= enough) & F.coalesce(apart, F.lit(False))
        kept = F.when((F.col("fan") == 1) | own, F.col("next")).otherwise("*")
        chosen = kids.join(nodes, ["host", "template"]).select("host", "template", "next", kept.alias("as"))
        rows = rows.join(chosen, ["host", "template", "next"], "left").withColumn("template", F.concat_ws("/", "template", "as")).drop("next", "as")
    return rows.drop("segments")


def judge(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", bad_col: str = "bad", rules=RULES, enough: int = ENOUGH, max_depth: int = MAX_DEPTH, z: float = Z, strength: float = STRENGTH, purity: float = PURITY) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity. bad_col is 1, 0 or null (no label)."""
    rows = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"), F.col(bad_col).cast("long").alias("bad"))
    rows = stage(rows.withColumn("shape", shape(F.col("path"))), "urls")
    counts = stage(rows.groupBy("host", "shape").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "shapes")
    totals = counts.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("n")).first()
    corpus = totals.bad / totals.n if totals.n else 0.0
    mapped = stage(templates(counts, enough, max_depth, z), "templates")
    share = (F.sum("bad") + F.lit(strength * corpus)) / (F.sum("labelled") + F.lit(strength))
    pure = mapped.groupBy("host", "template").agg(share.alias("purity"))
    looked = mapped.select("host", "shape", "template").join(pure, ["host", "template"])
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(looked, ["host", "shape"])
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("purity") >= purity, "block").otherwise("allow")).alias("verdict"), "template", "purity")


def with_labels(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """pages (page_id, url) with `bad`: 1 where the document that the path's last number names has quality 0, 0 where it
    has 1, null without label. A repeated label counts once, by its smallest."""
    one = labels.select(F.col("doc_id").alias("named"), F.col("quality").alias("quality")).dropna().groupBy("named").agg(F.min("quality").alias("quality"))
    number = F.expr("try_cast(regexp_extract(sparquill_path, '([0-9]{1,18})[^0-9/]*/?$', 1) as bigint)")
    rows = pages.select("page_id", F.col(url_col).alias("url"), path(F.col(url_col)).alias("sparquill_path")).withColumn("number", number)
    return rows.join(one, F.col("number") == F.col("named"), "left").select("page_id", "url", (1 - F.col("quality")).alias("bad"))
