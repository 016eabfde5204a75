"""Chat formatting that can be read back.

A conversation becomes one string::

    <s>[INST]question[/INST][ANS]answer</s>[ROLE]system[SAY]text[/ROLE]

A deterministic parser reads a turn up to the first closing mark.  Each turn is
rendered as it is, parsed again and compared with its source; a turn that does
not come back the same (its text holds a closing mark) is escaped, and its
opening mark says so (``[INST*]``).  An escaped text holds neither ``[`` nor
``<`` and therefore no mark at all, so the second attempt always succeeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns

BEGIN = "<s>"
#: Each kind of turn: open, open if escaped, between role and text, close.
USER = ("[INST]", "[INST*]", "", "[/INST]")
ASSISTANT = ("[ANS]", "[ANS*]", "", "</s>")
OTHER = ("[ROLE]", "[ROLE*]", "[SAY]", "[/ROLE]")

_TURN = (
    r"(?s)\[INST\*?\].*?\[/INST\]|\[ANS\*?\].*?</s>|\[ROLE\*?\].*?\[SAY\].*?\[/ROLE\]"
)
_ONE = r"(?s)^(?:\[INST\*?\](.*?)\[/INST\]|\[ANS\*?\](.*?)</s>|\[ROLE\*?\](.*?)\[SAY\](.*?)\[/ROLE\])"


def escape(c: Column) -> Column:
    """A text without ``[`` and ``<``, from which :func:`unescape` makes it again."""
    for plain, code in (("\\", "\\b"), ("[", "\\l"), ("<", "\\g")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in (("[", "\\l"), ("<", "\\g"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def _render(role: Column, text: Column, escaped: bool) -> Column:
    def one(kind, with_role: bool) -> Column:
        opened, opened_escaped, between, close = kind
        parts = [F.lit(opened_escaped if escaped else opened)]
        if with_role:
            parts += [escape(role) if escaped else role, F.lit(between)]
        return F.concat(*parts, escape(text) if escaped else text, F.lit(close))

    return (
        F.when(role == "user", one(USER, False))
        .when(role == "assistant", one(ASSISTANT, False))
        .otherwise(one(OTHER, True))
    )


def parse_turn(turn: Column) -> Column:
    """``role, text`` of one rendered turn."""
    escaped = turn.startswith(USER[1]) | turn.startswith(ASSISTANT[1]) | turn.startswith(OTHER[1])

    def group(k: int) -> Column:
        raw = F.regexp_extract(turn, _ONE, k)
        return F.when(escaped, unescape(raw)).otherwise(raw)

    user = turn.startswith("[INST")
    answer = turn.startswith("[ANS")
    role = F.when(user, F.lit("user")).when(answer, F.lit("assistant")).otherwise(group(3))
    text = F.when(user, group(1)).when(answer, group(2)).otherwise(group(4))
    return F.struct(role.alias("role"), text.alias("text"))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>``: the turns of a formatted conversation."""
    turns = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))
    return F.transform(turns, parse_turn)


def render_turns(turns: DataFrame) -> DataFrame:
    """Add ``rendered`` to ``role, text``: the raw form if it reads back as the
    same and has nothing after it, else the escaped one."""
    raw = _render(F.col("role"), F.col("text"), False)
    again = turns.withColumn("_raw", raw).withColumn("_first", F.regexp_extract("_raw", _TURN, 0))
    again = again.withColumn("_back", parse_turn(F.col("_first")))
    same = (
        (F.col("_first") == F.col("_raw"))
        & (F.col("_back.role") == F.col("role"))
        & (F.col("_back.text") == F.col("text"))
    )
    kept = F.when(same, F.col("_raw")).otherwise(_render(F.col("role"), F.col("text"), True))
    return again.withColumn("rendered", kept).drop("_raw", "_first", "_back")


def format_chats(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, formatted, turns``: a string for each conversation, and the turns
    as the parser reads them back from it.

    Rows go by turn, ties by role and text; a repeated row is a turn of its own.
    A null text counts as empty, and so does a null role; a null turn comes
    first; rows without id are one conversation.  Without rows there is no
    conversation.  Roles other than user and assistant keep their name.
    """
    check_columns(df, id_col, turn_col, role_col, text_col)
    rows = df.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # role and text order equal turns; the rendered turn is all that is gathered besides
    rendered = render_turns(rows).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("all")
    )
    joined = F.concat(F.lit(BEGIN), F.array_join(F.col("all.rendered"), ""))
    formatted = rendered.select(F.col("conv").alias(id_col), joined.alias("formatted"))
    return formatted.withColumn("turns", parse(F.col("formatted")))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and checksums of what the parser read back."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    answers = F.filter("turns", lambda t: t["role"] == "assistant")
    loss = F.array_join(F.transform(answers, lambda t: t["text"]), "")
    read = chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(said, "").alias("_said"),
        loss.alias("_loss"),
        "formatted",
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.encode("_said", "utf-8"), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("_loss", "utf-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
