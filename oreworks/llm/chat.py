"""Chat formatting as a grammar round trip, in built-in functions only.

Grammar of a formatted conversation:

    conversation := turn*
    turn         := "<s>[" role "]" BREAK text "[/" role "]</s>" BREAK     (BREAK: a line feed)

The parser is deterministic: it cuts at every close mark followed by an open mark, and takes the
role from the open mark. `render` first writes texts as they are, `parse` reads the result back,
and a conversation whose turns differ from the source, or whose content spells a control string, is
written again with its content escaped: the escape sign ``~`` becomes ``~0``, ``<`` becomes ``~1``, ``[`` ``~2`` and ``]``
``~3``. No mark can be spelled in escaped content and the replacement is reversible, so the second
reading is identical; `formatted` raises should it not be. Escaped conversations start with ``~``,
which no turn starts with, and so tell the parser.

Defined cases: null roles and texts count as empty. Turns are ordered by number, null numbers
last; equal numbers by role, then text; repeated rows are turns of their own. Rows whose
conversation id is null form one conversation. A table without rows gives none. Columns other than
the four named ones are ignored. A conversation is one value, as its format is; the sort of its
turns is the only step that sees it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template and the escapes.
OPEN, OPENED, CLOSE, CLOSED = "<s>[", "]\n", "[/", "]</s>\n"
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"))
FLAG = "~\n"
CONTROLS = r"</?s>|\[/?INST\]|<</?SYS>>"  # of this and of widespread templates
TURNS = "array<struct<role:string,text:string>>"


def escape(value: Column) -> Column:
    for plain, coded in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def unescape(value: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def gather(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: conv_id and its turns in order."""
    one = F.struct(
        F.col(turn).isNull().alias("late"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.select(F.col(conv).alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("all"))
    return grouped.select("conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(turns: Column, escaped: bool) -> Column:
    """The formatted conversation."""
    code = escape if escaped else lambda value: value

    def write(turn: Column) -> Column:
        role = code(turn["role"])
        return F.concat(F.lit(OPEN), role, F.lit(OPENED), code(turn["text"]), F.lit(CLOSE), role, F.lit(CLOSED))

    body = F.array_join(F.transform(turns, write), "")
    return F.concat(F.lit(FLAG), body) if escaped else body


def parse(rendered: Column) -> Column:
    """The turns of a formatted conversation; of any text, without fail."""
    coded = F.startswith(rendered, F.lit(FLAG))
    body = F.when(coded, F.substring(rendered, len(FLAG) + 1, 2**31 - 1)).otherwise(rendered)
    parts = F.filter(F.split(body, r"(?<=\]</s>\n)(?=<s>\[)"), lambda x: x != "")

    def read(part: Column) -> Column:
        role = F.substring_index(F.substring(part, len(OPEN) + 1, 2**31 - 1), OPENED, 1)
        head = F.length(role) + len(OPEN) + len(OPENED)
        tail = F.length(role) + len(CLOSE) + len(CLOSED)
        text = F.substring(part, head + 1, F.greatest(F.length(part) - head - tail, F.lit(0)))
        return F.struct(
            F.when(coded, unescape(role)).otherwise(role).alias("role"),
            F.when(coded, unescape(text)).otherwise(text).alias("text"),
        )

    return F.transform(parts, read)


def formatted(conversations: DataFrame) -> DataFrame:
    """Per conversation (conv_id, turns): conv_id, formatted, turns as read back from it, and
    whether its content had to be escaped."""
    first = conversations.withColumn("formatted", render(F.col("turns"), False))
    marked = F.exists("turns", lambda t: F.rlike(F.concat(t["role"], F.lit(" "), t["text"]), F.lit(CONTROLS)))
    first = first.withColumn("escaped", marked | ~parse(F.col("formatted")).cast(TURNS).eqNullSafe(F.col("turns").cast(TURNS)))
    second = first.withColumn("formatted", F.when(F.col("escaped"), render(F.col("turns"), True)).otherwise(F.col("formatted")))
    read = second.withColumn("read", parse(F.col("formatted")).cast(TURNS))
    same = F.when(F.col("read").eqNullSafe(F.col("turns").cast(TURNS)), F.col("read")).otherwise(F.raise_error(F.lit("a conversation does not survive its format")))
    return read.select("conv_id", "formatted", same.alias("turns"), "escaped")


def loss_texts(turns: Column) -> Column:
    """What a model is trained on: the texts of assistant turns."""
    return F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"])
