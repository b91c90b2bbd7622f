"""Chat formatting with DataFrame functions only.

A message's content is a string, which is one text part, or an array of typed parts (text, image, audio, document) with
any of the fields of PART. A visitor by type flattens parts into one string with ordered placeholders, and records each
attachment's reference, type and expanded token count. A part of any other type gets the placeholder `<|attachment|>`,
so no type can look like a control string; its own type is recorded with the attachment.
Turns are marked by control strings; the same strings inside texts are escaped by one backslash, reversibly.

Nulls: a null text or role is empty; a null conv_id is a conversation of its own; a null part is skipped. Repeated rows
are separate turns; ties of turn go by role, then text. An empty table gives no conversations; extra columns are ignored;
a very long text is formatted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FIELDS = ("type", "text", "ref", "width", "height", "seconds", "pages")
#: Types with a placeholder of their own.
KINDS = ("image", "audio", "document")
#: Tokens of an attachment: a patch of an image, a second of sound, a page.
PATCH, SOUND, PAGE = 28, 25.0, 600


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def part_tokens(part: Column) -> Column:
    cells = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["type"] == "image", F.greatest(F.lit(1), cells))
        .when(part["type"] == "audio", F.greatest(F.lit(1), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * SOUND)))
        .when(part["type"] == "document", F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(1))) * PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )


def placeholder(part: Column) -> Column:
    kind = F.coalesce(part["type"], F.lit("text"))
    name = F.when(kind.isin(*KINDS), kind).otherwise(F.lit("attachment"))
    return F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), name, F.lit("|>")))


def parts_of(rows: DataFrame, content: str) -> Column:
    """The content as an array of PART without nulls; fields are taken by name, absent ones are null."""
    kind = rows.schema[content].dataType
    if not isinstance(kind, ArrayType):
        text = F.struct(F.lit("text").alias("type"), F.coalesce(F.col(content).cast("string"), F.lit("")).alias("text"), *[F.lit(None).alias(x) for x in FIELDS[2:]])
        return F.array(text.cast(PART))
    have = {f.name for f in kind.elementType.fields}
    named = lambda p: F.struct(*[(p[x] if x in have else F.lit(None)).alias(x) for x in FIELDS]).cast(PART)
    return F.coalesce(F.transform(F.filter(F.col(content), lambda p: p.isNotNull()), named), F.array().cast(f"array<{PART}>"))


def flatten(rows: DataFrame, content: str) -> DataFrame:
    """Adds flat (escaped text with placeholders), attachments (in order) and expanded_tokens."""
    parts = parts_of(rows, content)
    attached = F.transform(F.filter(parts, lambda p: F.coalesce(p["type"], F.lit("text")) != "text"), lambda p: F.struct(p["ref"].alias("ref"), p["type"].alias("type"), part_tokens(p).alias("tokens")))
    return rows.withColumns({"flat": F.array_join(F.transform(parts, placeholder), ""), "attachments": attached, "expanded_tokens": F.aggregate(attached, F.lit(0).cast("long"), lambda a, p: a + p["tokens"])})


def format_chats(rows: DataFrame, content: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start from 0 and length in code points, one for each
    learned turn), attachments, expanded_tokens. Positions are running sums over a conversation's turns."""
    rows = flatten(rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.col(content).alias("_content")), "_content")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.select("conv_id", "turn", "role", "flat", "attachments", "expanded_tokens", F.concat(head, F.col("flat"), F.lit(END + "\n")).alias("marked"), F.length(head).alias("head"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "flat").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("start", F.sum(F.length("marked")).over(order) - F.length("marked") + F.col("head")).withColumn("n", F.row_number().over(order))
    turns = F.array_sort(F.collect_list(F.struct("n", "marked", "role", "start", F.length("flat").cast("long").alias("length"), "attachments")))
    got = rows.groupBy("conv_id").agg(turns.alias("turns"), F.sum("expanded_tokens").alias("expanded_tokens"))
    learned = F.filter("turns", lambda t: t["role"] == learn)
    return got.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["marked"]), "").alias("formatted"),
        F.transform(learned, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
        "expanded_tokens",
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role,text>> from the formatted string alone."""
    marks = F.split(formatted, r"<\|im_end\|>\n")
    marks = F.slice(marks, 1, F.size(marks) - 1)
    body = F.transform(marks, lambda m: F.substring(m, F.lit(len(START) + 1), F.length(m)))
    cut = lambda b: F.locate("\n", b)
    return F.transform(body, lambda b: F.struct(unescape_role(F.substring(b, F.lit(1), cut(b) - 1)).alias("role"), unescape(F.substring(b, cut(b) + 1, F.length(b))).alias("text")))
