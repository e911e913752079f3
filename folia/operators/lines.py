"""Operators on the lines of documents: kinds, risks, repeats, headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions import text as T

# Patterns whose results must equal the engine that is reproduced; word borders are spelled out.
BORDER, END = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
IDENTIFIER = BORDER + r"[A-Za-z_][A-Za-z0-9_-]*"
NUMBER = BORDER + r"[0-9]+(\.[0-9]+)?" + END
KEY = r":[A-Za-z]|" + BORDER + r"[A-Za-z_][A-Za-z0-9_-]*="
EQUATION = r"[=≈≠≤≥±×÷]"


def document_lines(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, keep..., pos, line): all lines of all texts; a null text has none."""
    return docs.where("text is not null").select("doc_id", *keep, F.posexplode(F.split("text", "\n")).alias("pos", "line"))


# Patterns of the ordered rules, in Unicode classes; only \\n ends a line.
_S, _NOT_S, _W = T.SPACE, r"[^\s\x1c-\x1f\x85\p{Z}]", r"[\p{L}\p{N}_]"
_BEFORE, _AFTER = f"(?<!{_W})", f"(?!{_W})"
WHOLE = {
    "hierarchy": rf"(?iud)^{_S}*(part|chapter|section){_S}+[A-Za-z0-9.]*(?:[A-Za-z0-9]{_AFTER}|\.(?={_W}))",
    "caption": rf"(?iud)^{_S}*(?:fig(?:ure)?|table){_S}+\p{{Nd}}+",
    "figure": rf"(?iud)^{_S}*figure (?s:.*){_NOT_S}",
    "list": rf"(?d)^{_S}*(?:[-*•]|\p{{Nd}}+[.)]|[A-Za-z][.)]){_S}+",
    "note": rf"(?iud)^{_S}*(?:note|\p{{Nd}}+[.)]){_S}",
    "terminal": rf"(?d)^{_S}*(?:[$>#]|[A-Za-z0-9_.-]+>){_S}",
    "index": rf"(?d)^.+,{_S}*\p{{Nd}}++(?:{_S}*,{_S}*\p{{Nd}}++)*+{_S}*$",
    "cross-reference": rf"(?iud){_BEFORE}(?:see|chapter|section|appendix|figure|table){_S}+[A-Za-z0-9.]",
    "math": rf"(?d)[=≈≠≤≥±×÷]|{_BEFORE}(?:sin|cos|log|lim){_AFTER}|\$[^$]+\$",
}


def semantic_kind(text: Column, physical: Column) -> Column:
    """Kind of a region by ordered rules over its whole text, however many lines: hierarchy, caption, figure, table,
    list, note, terminal, code, index, cross-reference, formula, capitals of at most 12 words, paragraph."""
    rules = [
        (text.rlike(WHOLE["hierarchy"]), F.lower(F.regexp_extract(text, WHOLE["hierarchy"], 1))),
        (text.rlike(WHOLE["caption"]), F.lit("caption")),
        ((physical == "figure") | text.rlike(WHOLE["figure"]), F.lit("figure")),
        ((physical == "table") | text.contains("\t") | (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))) >= 2), F.lit("table")),
        (text.rlike(WHOLE["list"]), F.lit("list-item")),
        (text.rlike(WHOLE["note"]), F.lit("note")),
        (text.rlike(WHOLE["terminal"]), F.lit("terminal")),
        ((physical == "code") | text.startswith(" ") | (text.contains("(") & text.contains(")")), F.lit("code")),
        *((text.rlike(WHOLE[k]), F.lit(k)) for k in ("index", "cross-reference", "math")),
        (text.rlike(r"\p{IsUppercase}") & ~text.rlike(r"[\p{IsLowercase}\p{Lt}]") & (F.size(T.words(text)) <= 12), F.lit("section")),
    ]
    out = F.lit("paragraph")
    for test, kind in reversed(rules):
        out = F.when(F.coalesce(test, F.lit(False)), kind).otherwise(out)
    return out


def risk_codes(line: Column) -> Column:
    """Array of the review codes that a line raises."""
    rules = [
        ("IDENTIFIER", line.rlike(IDENTIFIER)),
        ("NUMBER", line.rlike(NUMBER)),
        ("KEY_NAME", line.rlike(KEY)),
        ("EQUATION", line.rlike(EQUATION)),
        ("PUNCTUATION", line.rlike(r"\p{P}")),
        ("SYMBOL", line.rlike(r"[^\p{L}\p{N}\p{P}\p{Z}\s\x0b\x1c-\x1f\x85]")),
        ("LISP_TOKEN", line.rlike(r"[()']")),
        ("UNRESOLVED_GLYPH", line.rlike("[�□]")),
        ("UNEXPECTED_UNICODE", line.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]|[^\x00-\x7f]")),
        ("HYPHENATION_AMBIGUITY", line.endswith("-")),
    ]
    return F.filter(F.array(*(F.when(test, F.lit(code)) for code, test in rules)), lambda c: c.isNotNull())


def risk_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, code, n_lines): how many lines of each document raise each code."""
    each = document_lines(docs).select("doc_id", F.explode(risk_codes(F.col("line"))).alias("code"))
    return each.groupBy("doc_id", "code").agg(F.count(F.lit(1)).alias("n_lines"))


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, copies, first_pos) of non-blank lines that a document holds more than once."""
    lines = document_lines(docs).where(F.trim("line") != "")
    return lines.groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("copies"), F.min("pos").cast("bigint").alias("first_pos")).where("copies > 1")


def running_matter(docs: DataFrame) -> DataFrame:
    """(manual_id, line, pages): trimmed lines on at least two pages of a manual.

    Distinct (manual, page, line) triples are made first, so a manual with a third of all pages is spread
    over its lines before pages are counted.
    """
    lines = document_lines(docs, "manual_id", "page_index").select("manual_id", "page_index", F.trim("line").alias("line"))
    seen = lines.where("line <> '' and manual_id is not null and page_index is not null").distinct()
    return seen.groupBy("manual_id", "line").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")


def blank_suggestions(regions: DataFrame, *cols: str) -> DataFrame:
    """(id, text_field, replacements): texts in which a non-breaking blank should be a plain one."""
    each = regions.select("id", F.explode(F.array(*(F.struct(F.lit(c).alias("text_field"), F.col(c).alias("t")) for c in cols))).alias("x")).select("id", "x.*")
    n = F.length("t") - F.length(F.replace(F.col("t"), F.lit(" "), F.lit("")))
    return each.withColumn("replacements", n.cast("bigint")).where("replacements > 0").groupBy("id", "text_field").agg(F.max("replacements").alias("replacements"))


def headings(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, level) of numbered heading lines such as ``4.5 Shared packets``."""
    number = F.regexp_extract("line", r"^([0-9]+(\.[0-9]+)*) [A-Z]", 1)
    lines = document_lines(docs).withColumn("number", number).where("number <> ''")
    return lines.select("doc_id", "pos", (F.length("number") - F.length(F.replace(F.col("number"), F.lit("."), F.lit(""))) + 1).cast("bigint").alias("level"))


def hierarchy_gaps(heads: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, pos, level, previous): headings that skip a level below the heading before them."""
    w = Window.partitionBy(doc).orderBy("pos")
    h = heads.withColumn("previous", F.lag("level").over(w))
    return h.where("level > previous + 1").select(doc, F.col("pos").cast("bigint").alias("pos"), "level", "previous")


def section_numbers(sources: DataFrame) -> DataFrame:
    """(source_path, line_no, number): chapter, section and subsection counters with resets.

    Each counter is a running sum inside the groups that the counters above it open.
    """
    lines = sources.where("text is not null").select("source_path", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    kind = F.regexp_extract("line", r"^\.(chapter|section|subsection)( |$)", 1)
    heads = lines.withColumn("kind", kind).where("kind <> ''")
    w = Window.partitionBy("source_path").orderBy("pos")
    is_ = lambda k: (F.col("kind") == k).cast("bigint")
    heads = heads.withColumn("c", F.sum(is_("chapter")).over(w))
    heads = heads.withColumn("s", F.sum(is_("section")).over(Window.partitionBy("source_path", "c").orderBy("pos")))
    heads = heads.withColumn("u", F.sum(is_("subsection")).over(Window.partitionBy("source_path", "c", "s").orderBy("pos")))
    dot = lambda *c: F.concat_ws(".", *(F.col(x).cast("string") for x in c))
    number = F.when(F.col("kind") == "chapter", dot("c")).when(F.col("kind") == "section", dot("c", "s")).otherwise(dot("c", "s", "u"))
    return heads.select("source_path", (F.col("pos") + 1).cast("bigint").alias("line_no"), "kind", number.alias("number"))


def tagless(c: Column) -> Column:
    """Text of an HTML fragment: breaks and ends of blocks are line ends, tags go, the five basic entities are resolved."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?i)<br[^<>]*>|</(?:div|li|p|pre)\s*>", "\n"), r"<[^<>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out
