"""Chat formatting checked by a grammar round trip; DataFrame functions only."""

from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escaped(text):
    """One more backslash inside every `<\\...|`, so that no control string is left; `unescaped` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text):
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_out(role):
    """Percent signs, line ends and `<` of a role by their hexadecimal numbers; common roles stay as they are."""
    role = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return F.replace(role, F.lit("<"), F.lit("%3C"))


def _role_in(role):
    role = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(role, F.lit("%25"), F.lit("%"))


def render(turns):
    """Text of an array of (role, text): start mark, role, line end, text, end mark, line end."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(START), _role_out(t.role), F.lit("\n"), t.text, F.lit(END + "\n"))), ""
    )


def parse(formatted):
    """Turns (role, text) read back from rendered text; what stands outside the grammar becomes a turn of role null.

    Deterministic: cut at start marks; a piece is a role up to the first line end, then a text up to its one end
    mark, which ends the piece. The text inside is unescaped.
    """
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    pieces = F.slice(pieces, 2, F.size(pieces) - 1)

    def turn(piece):
        body = F.substring_index(piece, "\n", 1)
        rest = F.substr(piece, F.length(body) + 2)
        closed = rest.endswith(END + "\n") & (F.instr(rest, F.lit(END)) == F.length(rest) - len(END))
        text = F.left(rest, F.length(rest) - F.lit(len(END) + 1))
        return F.struct(F.when(closed, _role_in(body)).alias("role"), unescaped(F.when(closed, text).otherwise(rest)).alias("text"))

    return F.transform(pieces, turn)


def format_chats(conversations):
    """Row per conversation: conv_id, turns (role, text; by turn), formatted, recovered, exact.

    The first rendering leaves texts as they are. Each turn is also rendered and parsed by itself; where that does
    not give the turn back (it holds control strings, or what reads as an escape), its text is escaped, and the
    whole is rendered and parsed again. `recovered` is read back from the final text and `exact` says that it
    equals the source, which escaping ensures.

    A conversation is one record, so its turns meet in one row. Turn order: turn number (null last), then role and
    text. Null role or text: empty. Null conv_id: one conversation of its own. Repeated rows are repeated turns.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNull().alias("late"), F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select(
        "conv_id", F.transform("ts", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns")
    )

    def settled(t):
        alone = parse(render(F.array(t)))
        return F.struct(
            t.role.alias("role"), F.when(alone == F.array(t), t.text).otherwise(escaped(t.text)).alias("text")
        )

    plain = chats.withColumn("formatted", render(F.col("turns")))
    first = plain.withColumn("recovered", parse(F.col("formatted")))
    again = first.withColumn(
        "formatted",
        F.when(F.col("recovered") == F.col("turns"), F.col("formatted")).otherwise(render(F.transform("turns", settled))),
    )
    return again.withColumn("recovered", parse(F.col("formatted"))).withColumn("exact", F.col("recovered") == F.col("turns"))


def loss_text(turns, role=TRAINED_ROLE):
    """All text under the loss mask: what the given role says, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t.role == role), lambda t: t.text), "")
