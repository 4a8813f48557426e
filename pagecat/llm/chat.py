"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, MORE, LINE = "<|im_start|>", "<|im_end|>\n", "<|im_cont|>", "<|im_nl|>"


def escape(text: Column) -> Column:
    """Double each backslash, then part ``<|`` with one: no control string is left, and ``unescape`` undoes it exactly."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _parted(text: Column, mark: str) -> Column:
    return F.split(text, "\\Q" + mark + "\\E", -1)


def format_chats(
    turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One formatted string per conversation, with the spans of the texts to learn from.

    Turns are sorted by (turn, role, text); null sorts first, a null role or text counts as empty. Adjacent turns of one role
    become one message whose texts are parted by a mark of their own, so that ``read_chats`` finds every turn again. Control
    strings inside texts and roles are escaped.

    Returns per conversation: messages (role, texts), formatted, loss_spans (start and length in code points of ``formatted``,
    start_byte and bytes in its UTF-8, one for each text of ``loss_roles``). Time grows with the length of a conversation, not its square. A null conversation id is a conversation of its own; repeated rows are turns of their
    own; an empty table gives no rows; other columns are not read. A conversation becomes one row, as its string must.
    """
    order = Window.partitionBy(conv_col).orderBy("turn", "role", "text")
    rows = turns.select(
        conv_col, F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = rows.withColumns({"before": F.lag("role").over(order), "number": F.row_number().over(order)})
    # What stands before a text: a message's end is written before the next one begins, and once at the end.
    opens = (F.col("number") == 1) | (F.col("before") != F.col("role"))
    begin = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    head = F.when(~opens, F.lit(MORE)).when(F.col("number") == 1, begin).otherwise(F.concat(F.lit(END), begin))
    pieces = placed.withColumns({"opens": opens, "safe": escape(F.col("text")), "learn": F.col("role").isin(*loss_roles)}).withColumn("piece", F.concat(head, F.col("safe")))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    measured = pieces.withColumns({
        "start": (F.sum(F.length("piece")).over(so_far) - F.length("safe")).cast("int"), "length": F.length("safe"),
        "start_byte": (F.sum(F.octet_length("piece")).over(so_far) - F.octet_length("safe")).cast("int"), "bytes": F.octet_length("safe"),
    })
    turn = F.struct("number", "role", "text", "opens", "learn", "piece", F.struct("start", "length", "start_byte", "bytes").alias("span"))
    kept = measured.groupBy(conv_col).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = kept.select(conv_col, "turns", F.transform(F.filter("turns", lambda t: t["opens"]), lambda t: t["number"]).alias("first"))
    after = F.concat(F.slice("first", F.lit(2), F.size("first")), F.array(F.size("turns") + 1))
    messages = F.zip_with("first", after, lambda a, b: F.struct(
        F.element_at("turns", a)["role"].alias("role"), F.transform(F.slice("turns", a, b - a), lambda t: t["text"]).alias("texts")))
    return first.select(
        conv_col, messages.alias("messages"),
        F.concat(F.array_join(F.transform("turns", lambda t: t["piece"]), ""), F.lit(END)).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: t["span"]).alias("loss_spans"),
    )


def read_chats(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Read formatted conversations back: turns (role, text) in order, and the texts under the loss spans, all unescaped."""
    def message(m):
        head = F.substring_index(m, "\n", 1)
        body = F.substr(m, F.length(head) + 2, F.length(m))
        role = unescape(F.replace(head, F.lit(LINE), F.lit("\n")))
        texts = _parted(F.substring_index(body, END, 1), MORE)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    parts = _parted(F.col("formatted"), START)
    return formatted.select(
        conv_col, "formatted",
        F.flatten(F.transform(F.slice(parts, 2, F.size(parts)), message)).alias("turns"),
        # Bytes can be reached without counting the characters before them.
        F.flatten(F.transform(F.array(F.col("formatted").cast("binary")), lambda whole: F.transform(
            "loss_spans", lambda s: unescape(F.decode(F.substring(whole, s["start_byte"] + 1, s["bytes"]), "UTF-8"))))).alias("loss_texts"),
    )
