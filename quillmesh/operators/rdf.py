"""Triples: class members, optional properties, and the shape of a class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instances(triples: DataFrame, type_predicate: str, class_id: str) -> DataFrame:
    """s of the members of a class."""
    return triples.where((F.col("p") == type_predicate) & (F.col("o") == class_id)).select("s").distinct()


def about(triples: DataFrame, subjects: DataFrame, prefix: str = "") -> DataFrame:
    """The triples of the subjects whose predicate begins with prefix."""
    return triples.where(F.col("p").startswith(prefix)).join(subjects, "s", "left_semi")


def with_optional(subjects: DataFrame, triples: DataFrame, **predicates: str) -> DataFrame:
    """subjects with a column for each predicate, null where a subject has none; several values of one give several rows."""
    out = subjects
    for name, p in predicates.items():
        out = out.join(triples.where(F.col("p") == p).select("s", F.col("o").alias(name)), "s", "left")
    return out


def shape(triples: DataFrame, threshold: float = 0.25) -> DataFrame:
    """p, share, least, most, everywhere of the predicates that at least so large a share of the subjects has: how many values a subject that has
    any has at least and at most, and whether all subjects have it."""
    n = triples.select("s").distinct().count()
    per = triples.groupBy("s", "p").agg(F.count(F.lit(1)).alias("c"))
    out = per.groupBy("p").agg((F.count(F.lit(1)) / F.lit(float(max(n, 1)))).alias("share"), F.min("c").alias("least"), F.max("c").alias("most"))
    return out.where(F.col("share") >= threshold).withColumn("everywhere", F.col("share") == 1.0)


_KINDS = (("integer", r'^"?[+-]?\d+"?(\^\^.*)?$'), ("decimal", r'^"?[+-]?\d*\.\d+"?(\^\^.*)?$'), ("text", r'^"'), ("name", r"^(?:https?:|urn:|_:)"))


def value_kinds(triples: DataFrame) -> DataFrame:
    """p, kind of the values of each predicate: integer, decimal (integers among them), text, name (a resource), or any where they differ."""
    each = F.coalesce(*(F.when(F.col("o").rlike(pattern), F.lit(kind)) for kind, pattern in _KINDS), F.lit("text"))
    sets = triples.select("p", each.alias("k")).groupBy("p").agg(F.array_sort(F.collect_set("k")).alias("k"))
    one = F.when(F.size("k") == 1, F.get("k", F.lit(0))).when(F.col("k") == F.array(F.lit("decimal"), F.lit("integer")), F.lit("decimal"))
    return sets.select("p", F.coalesce(one, F.lit("any")).alias("kind"))


def _text(shapes: DataFrame, line: Column, head: str, tail: str) -> DataFrame:
    """One row, text: a line for each predicate, in order, between head and tail. A class has as many predicates as its vocabulary."""
    listed = shapes.select(F.struct("p", line.alias("line")).alias("l")).agg(F.array_sort(F.collect_list("l")).alias("l"))
    return listed.select(F.concat(F.lit(head + "\n"), F.array_join(F.col("l.line"), "\n"), F.lit("\n" + tail)).alias("text"))


def shex(shapes: DataFrame, name: str) -> DataFrame:
    """text: the shape in ShEx, a line for each predicate in order; with the kinds of values where the shapes have a column kind."""
    count = F.when(F.col("most") == 1, F.when(F.col("everywhere"), "").otherwise("?")).otherwise(F.when(F.col("everywhere"), "+").otherwise("*"))
    kinds = {"integer": "xsd:integer", "decimal": "xsd:decimal", "text": "LITERAL", "name": "IRI"}
    value = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in kinds.items()), F.lit(".")) if "kind" in shapes.columns else F.lit(".")
    return _text(shapes, F.format_string("  <%s> %s %s ;", "p", value, count), f"<{name}> {{", "}")


def shacl(shapes: DataFrame, name: str, target: str) -> DataFrame:
    """text: the shape in SHACL (Turtle): for each predicate how many values a member has at least and at most, and their kind."""
    kinds = {"integer": " ; sh:datatype xsd:integer", "decimal": " ; sh:datatype xsd:decimal", "text": " ; sh:nodeKind sh:Literal", "name": " ; sh:nodeKind sh:IRI"}
    value = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in kinds.items()), F.lit("")) if "kind" in shapes.columns else F.lit("")
    least = F.when(F.col("everywhere"), F.format_string(" ; sh:minCount %d", "least")).otherwise("")
    line = F.format_string("  sh:property [ sh:path <%s>%s%s%s ] ;", "p", least, F.format_string(" ; sh:maxCount %d", "most"), value)
    return _text(shapes, line, f"<{name}> a sh:NodeShape ;\n  sh:targetClass <{target}> ;", "  sh:closed false .")
