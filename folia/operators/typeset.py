"""Typesetter sources: visible text of lines, blocks with their spans, rendered intervals and selectors.

The block structure is declared over lines instead of folded: depths are running sums less their running
minimum, blocks are islands of lines of one kind, and a rendered interval joins spans with block lines
through buckets of line numbers. A window holds the lines of one file.

Defined results: a null text has no lines; a directive that nothing closes or opens is a finding of its file,
not an error; spans that are null, reversed or start past the file render nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.digests import sha256

# Fixed values of the typesetter.
DIRECTIVE = r"(?d)^\.([A-Za-z_][A-Za-z0-9_]*)(?:[ \t]+(.*))?$"
CONTROLS = "\x11([\\s\\S])|\x06[\\s\\S]|\x16\\(([^)]*)\\)|[\x18\x19]"
SIGNS = {"\x1a": "≠", "\x1c": "≤", "\x1d": "≥"}
TRANSPARENT = ("c", "cindex", "nopara", "sp")
HEADINGS, FUNCTIONS, ITEMS = ("chapter", "section", "subsection"), ("defun", "defun1", "defspec"), ("item", "kitem")
PAIRS = {"lisp": "end_lisp", "table": "end_table", "defun": "end_defun", "defspec": "end_defspec"}
ROLES = {"defconst": "Constant", "defmac": "Macro", "defspec": "Special Form", "defun": "Function", "defvar": "Variable"}
DEFPROP = r"(?i)^\s*\(DEFPROP\s+(\|[^|]*\||[^\s()]+)\s+(\|[^|]*\||/[^\s()]+)\s+JUST-VALUE\s*\)\s*$"
#: Line numbers of one bucket of the interval join.
BUCKET = 64


def visible(line: Column) -> Column:
    """A line without fonts and bold marks, quoted signs literal, references as their text, glyph bytes as signs."""
    return F.translate(F.regexp_replace(line, CONTROLS, "$1$2"), "".join(SIGNS), "".join(SIGNS.values()))


def source_lines(sources: DataFrame, *keep: str) -> DataFrame:
    """(source_path, keep..., line_no, line): lines end at a line feed only; one carriage return before it is dropped."""
    parts = F.split("text", "\n")
    each = sources.where("text is not null").select("source_path", *keep, F.size(parts).alias("_n"), F.posexplode(parts).alias("pos", "line"))
    each = each.where(~((F.col("pos") == F.col("_n") - 1) & (F.col("line") == "")))
    return each.select("source_path", *keep, (F.col("pos") + 1).alias("line_no"), F.regexp_replace("line", "\r\\z", "").alias("line"))


def depths(lines: DataFrame, opens: dict[str, str]) -> DataFrame:
    """Lines with ``name`` of their directive and, for each opening directive, ``in_<name>``: its depth before the line, at least 0."""
    w = Window.partitionBy("source_path").orderBy("line_no")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = lines.withColumn("name", F.lower(F.regexp_extract("line", DIRECTIVE, 1)))
    for name, end in opens.items():
        step = F.when(F.col("name") == name, 1).when(F.col("name") == end, -1).otherwise(0)
        out = out.withColumn("_s", F.sum(step).over(upto)).withColumn("_m", F.least(F.min("_s").over(upto), F.lit(0)))
        out = out.withColumn("in_" + name, F.coalesce(F.lag(F.col("_s") - F.col("_m")).over(w), F.lit(0))).drop("_s", "_m")
    return out


def nesting_findings(sources: DataFrame) -> DataFrame:
    """(source_path, directive, unopened, unclosed): closing directives without an open one, and the depth at the end."""
    lines = depths(source_lines(sources), PAIRS)
    rows = []
    for name, end in PAIRS.items():
        d = F.col("in_" + name)
        net = F.count_if(F.col("name") == name) - F.count_if((F.col("name") == end) & (d > 0))
        rows.append(F.struct(F.lit(name).alias("directive"), F.count_if((F.col("name") == end) & (d == 0)).alias("unopened"), net.alias("unclosed")))
    return lines.groupBy("source_path").agg(F.array(*rows).alias("r")).select("source_path", F.explode("r").alias("r")).select("source_path", "r.*").where("unopened > 0 or unclosed > 0")


def block_lines(sources: DataFrame) -> DataFrame:
    """(source_path, block_no, kind, line_no, text) of every line that belongs to a block: body, code, section, function, list-item."""
    lines = depths(source_lines(sources), {"lisp": "end_lisp"})
    arg = F.regexp_extract("line", DIRECTIVE, 2)
    name, code = F.col("name"), F.col("in_lisp") > 0
    plain = F.trim(F.regexp_replace(visible(F.col("line")), r"^[ \t]+|[ \t]+$", ""))
    moved = visible(F.regexp_replace(arg, r"^[0-9]+(\s+|$)", ""))
    quiet = name.isin(*TRANSPARENT) | F.lower("line").startswith("'cindex")
    kind = (
        F.when(quiet, "quiet").when(code & (name == ""), "code").when(code & (name == "exdent") & (moved != ""), "code").when(name.isin(*PAIRS, *PAIRS.values()), "break").when(code, "quiet").when(name == "", F.when(plain == "", "break").otherwise("body"))
        .when(name.isin(*HEADINGS), "section").when(name.isin(*FUNCTIONS), "function").when(name.isin(*ITEMS), "list-item").when((name == "exdent") & (moved != ""), "list-item").otherwise("break")
    )
    title = F.regexp_replace(F.trim(arg), r'^"(.*)"$', "$1")
    text = F.when(name == "exdent", moved).when(kind == "code", visible(F.col("line"))).when(kind == "body", plain).when(kind == "section", title).otherwise(F.trim(visible(arg)))
    each = lines.select("source_path", "line_no", kind.alias("kind"), text.alias("text"), F.coalesce(visible(F.col("line")).rlike(r"^[ \t]"), F.lit(False)).alias("indent")).where("kind <> 'quiet'")
    w = Window.partitionBy("source_path").orderBy("line_no")
    before = F.lag("kind").over(w)
    joins = F.coalesce((before == F.col("kind")) & ((F.col("kind") == "code") | (F.col("kind") == "body") & ~F.col("indent")), F.lit(False))
    each = each.withColumn("starts", F.when(joins | (F.col("kind") == "break"), 0).otherwise(1))
    each = each.withColumn("block_no", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return each.where("kind <> 'break'").select("source_path", "block_no", "kind", "line_no", "text")


def blocks(sources: DataFrame) -> DataFrame:
    """(source_path, block_no, kind, start_line, end_line, n_lines, text): prose reflowed to one line, code as it stands."""
    lines = block_lines(sources)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    g = lines.groupBy("source_path", "block_no", "kind").agg(F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"), F.count(F.lit(1)).alias("n_lines"), ordered.alias("t"))
    return g.select("source_path", "block_no", "kind", "start_line", "end_line", "n_lines", F.when(F.col("kind") == "code", F.array_join("t", "\n")).otherwise(F.array_join("t", " ")).alias("text"))


def reference_spans(sources: DataFrame) -> DataFrame:
    """(source_path, block_no, kind, out_start, out_end): lines of each block in the artifact that joins blocks by blank lines."""
    b = blocks(sources).withColumn("n", F.size(F.split("text", "\n")))
    ahead = F.coalesce(F.sum(F.col("n") + 1).over(Window.partitionBy("source_path").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return b.select("source_path", "block_no", "kind", (ahead + 1).alias("out_start"), (ahead + F.col("n")).alias("out_end"))


def rendered(spans: DataFrame, sources: DataFrame) -> DataFrame:
    """(span_id, n_blocks, rendered) of spans(span_id, source_path, a, b): the blocks that an interval meets, joined by blank lines.

    Of prose and code only the lines inside count, other blocks are whole.
    """
    lines = block_lines(sources).withColumn("bucket", F.floor(F.col("line_no") / BUCKET))
    each = spans.where("a >= 1 and a <= b").withColumn("bucket", F.explode(F.sequence(F.floor(F.col("a") / BUCKET), F.floor(F.col("b") / BUCKET))))
    met = each.join(lines, ["source_path", "bucket"]).where("line_no between a and b")
    part = met.groupBy("span_id", "block_no", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]).alias("t"))
    text = F.when(F.col("kind") == "code", F.array_join("t", "\n")).otherwise(F.array_join("t", " "))
    return part.select("span_id", "block_no", text.alias("text")).where("text <> ''").groupBy("span_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "text"))), lambda x: x["text"]), "\n\n").alias("rendered"))


def selected_components(selectors: DataFrame, sources: DataFrame) -> DataFrame:
    """(selector_id, status, n_chars, selected_sha256) of selectors: a range of the rendered characters, or a directive's role.

    ``selected`` if a part came out, ``outside`` for a range that leaves the rendered text, ``not-a-directive`` if
    the line holds another one, ``no-range`` and ``no-role`` where the selector does not say enough.
    """
    s = selectors.select("selector_id", "source_path", "region_kind", F.col("source_span")[0].alias("a"), F.col("source_span")[1].alias("b"), "selector.*").distinct()
    s = s.withColumn("span_id", F.sha2(F.concat_ws(":", "source_path", "a", "b"), 256))
    r = rendered(s.select("span_id", "source_path", "a", "b").distinct(), sources)
    first = source_lines(sources).select("source_path", F.col("line_no").alias("a"), F.lower(F.regexp_extract("line", DIRECTIVE, 1)).alias("found"))
    out = s.join(r, "span_id", "left").join(first, ["source_path", "a"], "left")
    ranged = F.col("kind") == "rendered-character-range"
    fits = (F.col("start_char") < F.col("end_char")) & (F.col("end_char") <= F.length("rendered"))
    cut = F.substring(F.col("rendered"), F.col("start_char") + 1, F.col("end_char") - F.col("start_char"))
    cut = F.when(F.col("region_kind") == "body", F.replace(cut, F.lit("\n"), F.lit(" "))).otherwise(cut)
    role = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))[F.lower("directive")]
    status = (
        F.when(ranged & (F.col("start_char").isNull() | F.col("end_char").isNull()), "no-range").when(ranged, F.when(F.coalesce(fits, F.lit(False)), "selected").otherwise("outside"))
        .when(F.col("component") != "role", "no-range").when(F.coalesce(F.col("found") != F.lower("directive"), F.lit(True)), "not-a-directive").when(role.isNull(), "no-role").otherwise("selected")
    )
    text = F.when(status == "selected", F.when(ranged, cut).otherwise(role))
    return out.select("selector_id", status.alias("status"), F.length(text).alias("n_chars"), sha256(text).alias("selected_sha256")).distinct()


def variables(lines: DataFrame) -> DataFrame:
    """(name, value, conflict) of property lines: names in capitals; different values of one name are a conflict."""
    bare = lambda c: F.regexp_replace(c, r"^\||\|$", "")
    name, value = F.regexp_extract("line", DEFPROP, 1), F.regexp_extract("line", DEFPROP, 2)
    each = lines.where(F.col("line").rlike(DEFPROP)).select(F.upper(bare(name)).alias("name"), F.when(value.startswith("|"), bare(value)).otherwise(F.substring(value, 2, 1 << 30)).alias("value"))
    return each.groupBy("name").agg(F.min("value").alias("value"), (F.min("value") != F.max("value")).alias("conflict"))
