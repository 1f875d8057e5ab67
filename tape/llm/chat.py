"""Chat formatting by a grammar that is parsed back.

A turn is written as

    ### role: text</turn>\n        plain
    ###! role: text</turn>\n       escaped

A conversation is its turns one after the other.  The parser is deterministic:
it cuts the text after every ``</turn>`` and line feed, takes the marker at the
front of a piece, the role up to the first colon and space, and the rest as the
text.

Escaping in steps: a turn is first written plain and parsed; if role and text do
not come back as they were, or hold a control string (``###`` of the markers or
``</turn>``, which a tokenizer may take as such wherever it stands), it is written
escaped: a backslash stands before every backslash, slash and ``#`` (in a role
before every space too), so that no control string is left in it.  The whole
conversation is then parsed once more and compared with its source; a difference
would stop the job.

The loss mask covers the texts of assistant turns, as (turn, start, length) in
code points of the formatted conversation.

Defined cases: null role and null text are empty; turns come in the order of
(turn, role, text), null turns first; equal rows are turns of their own; rows
without conversation id form one conversation; an empty table gives none; other
columns, whatever their names, are ignored.  A conversation is one output row, so
its text must fit a row.  Everything is a Spark expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template.
PLAIN, ESCAPED, COLON, END = "### ", "###! ", ": ", "</turn>\n"
#: What no role or text may hold as it is: the front of both markers, the end.
CONTROL = ("###", "</turn>")
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    """A backslash inside every control string, and before every backslash."""
    return F.regexp_replace(c, r"([\\/#])", r"\\$1")


def escape_role(c: Column) -> Column:
    """The same, and inside every colon and space."""
    return F.regexp_replace(c, r"([\\/# ])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def write_turn(role: Column, text: Column, escaped: bool) -> Column:
    """One turn, with its terminator."""
    if escaped:
        return F.concat(F.lit(ESCAPED), escape_role(role), F.lit(COLON), escape(text), F.lit(END))
    return F.concat(F.lit(PLAIN), role, F.lit(COLON), text, F.lit(END))


def read_turn(piece: Column) -> Column:
    """struct(role, text) of a turn without its terminator."""
    escaped = piece.startswith(ESCAPED)
    body = F.when(escaped, F.substring(piece, len(ESCAPED) + 1, 2147483647)).otherwise(F.substring(piece, len(PLAIN) + 1, 2147483647))
    colon = F.instr(body, COLON)
    role, text = body.substr(F.lit(1), colon - 1), body.substr(colon + len(COLON), F.lit(2147483647))
    return F.struct(F.when(escaped, unescape(role)).otherwise(role).alias("role"), F.when(escaped, unescape(text)).otherwise(text).alias("text"))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted text, without terminators."""
    cut = F.split(formatted, END)
    return F.slice(cut, F.lit(1), F.size(cut) - 1)


def parse(formatted: Column) -> Column:
    """array of struct(role, text): the parser of the grammar."""
    return F.transform(pieces(formatted), read_turn)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, formatted, loss_spans array of (turn, turn_start, start, length)
    for every conversation."""
    said = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    plain, escaped = write_turn(F.col("role"), F.col("text"), False), write_turn(F.col("role"), F.col("text"), True)
    # step 1: keep the plain form where the parser gives the source back and nothing looks like control
    said = said.withColumn("plain", plain).withColumn("back", parse(F.col("plain")))
    same = (F.size("back") == 1) & (F.get("back", F.lit(0))["role"] == F.col("role")) & (F.get("back", F.lit(0))["text"] == F.col("text"))
    for part in CONTROL:
        same &= ~F.col("role").contains(part) & ~F.col("text").contains(part)
    said = said.withColumn("written", F.when(same, F.col("plain")).otherwise(escaped))
    lead = F.when(same, F.length("role") + len(PLAIN) + len(COLON)).otherwise(F.length(escape_role(F.col("role"))) + len(ESCAPED) + len(COLON))
    said = said.withColumn("lead", lead)
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = said.select(
        "conv", "role", "text", "written", "lead", F.row_number().over(order).alias("place"),
        F.coalesce(F.sum(F.length("written").cast("long")).over(before), F.lit(0).cast("long")).alias("turn_start"))
    span = F.struct(
        (F.col("place") - 1).alias("turn"), "turn_start", (F.col("turn_start") + F.col("lead")).alias("start"),
        (F.length("written") - F.col("lead") - len(END)).cast("long").alias("length"), (F.col("role") == ASSISTANT).alias("loss"))
    whole = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("place", "written", F.struct("role", "text").alias("source"), span.alias("span")))).alias("turns"))
    whole = whole.select("conv", F.array_join("turns.written", "").alias("formatted"), F.col("turns.source").alias("source"), F.filter("turns.span", lambda s: s["loss"]).alias("spans"))
    # step 2: the conversation itself must come back
    checked = F.when(parse(F.col("formatted")) == F.col("source"), F.col("formatted")).otherwise(F.raise_error(F.concat(F.lit("conversation does not parse back: "), F.coalesce(F.col("conv").cast("string"), F.lit("null")))).cast("string"))
    spans = F.transform("spans", lambda s: F.struct(s["turn"].alias("turn"), s["turn_start"].alias("turn_start"), s["start"].alias("start"), s["length"].alias("length")))
    return whole.select(F.col("conv").alias(conv), checked.alias("formatted"), spans.alias("loss_spans"))


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order: cut by the spans
    from the turns of the formatted text."""
    cut = pieces(formatted)

    def one(s: Column) -> Column:
        piece = F.get(cut, s["turn"])
        raw = piece.substr((s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int"))
        return F.when(piece.startswith(ESCAPED), unescape(raw)).otherwise(raw)

    return F.transform(spans, one)


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations."""
    read = formatted.select(F.col(conv), F.length("formatted").cast("long").alias("formatted_chars"), parse(F.col("formatted")).alias("back"), F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    line = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        conv, F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
