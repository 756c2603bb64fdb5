"""Chat logs: events folded into final messages, messages rendered by a template with a loss mask."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Kinds of events; equal sequence numbers of a message are taken in this order.
KINDS = ("start", "regenerate", "edit", "delta")
#: Stands for a NULL position or sequence number.
_FIRST = -(1 << 62)


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is ``open``, role, ``role_end``, text, ``close``.

    Inside roles and texts a backslash and the first character of every control string
    become a backslash and a digit, so no control string can occur there, whatever the
    text holds, and reading back is exact.  ``loss_roles``: roles whose texts are learned.
    ``piece_turns``: positions of a conversation that one output row covers.
    """

    open: str = "### "
    role_end: str = ": "
    close: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    piece_turns: int = 64

    def __post_init__(self) -> None:
        starts = [s[:1] for s in (self.open, self.role_end, self.close)]
        if "" in starts or any(c == "\\" or c.isdigit() for c in starts):
            raise ValueError("control strings begin with a character that is neither a backslash nor a digit")

    def codes(self, role: bool = False) -> list[tuple[str, str]]:
        """Characters and what stands for them, the backslash first."""
        found = ["\\", self.open[0], self.close[0], *([self.role_end[0]] if role else [])]
        return [(c, f"\\{i}") for i, c in enumerate(dict.fromkeys(found))]

    def escaped(self, text: Column, role: bool = False) -> Column:
        for plain, code in self.codes(role):
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    def unescaped(self, text: Column, role: bool = False) -> Column:
        for plain, code in reversed(self.codes(role)):
            text = F.replace(text, F.lit(code), F.lit(plain))
        return text


def row_events(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The log of a table that holds one finished turn per row: each row starts a message with its whole text."""
    place = F.col(turn).cast("long")
    return rows.select(
        F.col(conversation).alias("conv_id"), place.alias("position"), place.alias("seq"), F.lit("start").alias("kind"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    )


def final_messages(events: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``key, position, number, role, text`` of the messages that a log of events leaves.

    ``events``: ``conv_id``, ``position`` of a message in its conversation, ``seq``, ``kind``,
    ``role``, ``text``.  In the order of ``seq``, ``start`` begins a message at its position,
    ``delta`` adds text to the last message begun there, ``edit`` puts its text in place of what
    is there, ``regenerate`` empties the message and removes all that was logged before it at
    later positions, since those turns answered the text that is gone.

    Events are dealt by ``key``, a struct of ``conv_id`` and ``piece`` (a bounded range of positions),
    so a conversation of any length is spread out; one shuffle serves everything.  What a piece must
    know of others is one number, the largest ``seq`` of a regeneration before it.

    Messages that start at the same position are all kept, by ``seq``, then role and text;
    ``number`` counts them.  Equal rows are messages of their own.  A NULL text is empty, a
    message without a role has an empty one, NULL conversations form one, a NULL position or
    ``seq`` is the smallest.  Events of unknown kinds count as deltas.  No rows give no rows.
    """
    width = (template or ChatTemplate()).piece_turns
    place = F.coalesce(F.col("position").cast("long"), F.lit(_FIRST))
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce("kind", F.lit(KINDS[-1])))
    log = events.select(
        F.col("conv_id"), place.alias("position"), F.coalesce(F.col("seq").cast("long"), F.lit(_FIRST)).alias("seq"),
        F.when(kind == 0, len(KINDS)).otherwise(kind).cast("int").alias("rank"), "role", F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("key", F.struct("conv_id", F.expr(f"position div {width}").alias("piece")))
    is_kind = lambda *names: F.col("rank").isin(*[KINDS.index(n) + 1 for n in names])
    regenerated = F.when(is_kind("regenerate"), F.col("seq"))
    # A row for each piece; of those, the pieces that come after a regeneration go on.
    ends = log.groupBy(F.col("key").alias("at")).agg(F.max(regenerated).alias("last"))
    before = Window.partitionBy("at.conv_id").orderBy("at.piece").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.select("at", F.max("last").over(before).alias("earlier")).where("earlier IS NOT NULL")
    placed = log.join(earlier, F.col("key") == F.col("at"), "left").drop("at")

    inside = Window.partitionBy("key").orderBy("position").rangeBetween(Window.unboundedPreceding, -1)
    cut = F.greatest(F.max(regenerated).over(inside), F.col("earlier"))
    order = ["seq", "rank", F.coalesce("role", F.lit("")), "text"]
    spot = Window.partitionBy("key", "position").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.select(
        "key", "position", "seq", "rank", "role", "text", F.sum(is_kind("start").cast("long")).over(spot).alias("number"),
        F.coalesce(F.col("seq") > cut, F.lit(True)).alias("live"),
    )
    message = Window.partitionBy("key", "position", "number")
    reset = F.col("live") & is_kind("regenerate", "edit")
    counted = numbered.withColumn(
        "resets", F.sum(reset.cast("long")).over(message.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("last", F.max("resets").over(message))
    part = F.when(F.col("live") & (F.col("resets") == F.col("last")), F.struct("seq", "rank", "text"))
    named = F.when(F.col("role").isNotNull(), F.struct("seq", "rank", "role"))
    folded = counted.groupBy("key", "position", "number").agg(
        F.coalesce(F.max_by("role", named), F.lit("")).alias("role"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return folded.where(F.size("parts") > 0).select("key", "position", "number", "role", text.alias("text"))


def render(messages: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``conv_id, piece, formatted, loss`` of ``final_messages``: the text of each piece and its loss mask.

    A conversation's text is that of its pieces one after the other.  ``loss`` lists the parts of
    ``formatted`` under the mask: ``start`` and ``end`` in code points, in order.
    """
    template = template or ChatTemplate()
    head = F.concat(F.lit(template.open), template.escaped(F.col("role"), role=True), F.lit(template.role_end))
    turns = messages.select(
        "key", "position", "number", F.col("role").isin(*template.loss_roles).alias("learned"),
        head.alias("head"), template.escaped(F.col("text")).alias("body"),
    )
    whole = F.length("head") + F.length("body") + F.lit(len(template.close))
    so_far = Window.partitionBy("key").orderBy("position", "number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(whole).over(so_far), F.lit(0)) + F.length("head")
    spanned = turns.withColumn("start", start)
    span = F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end"))
    turn = F.struct("start", F.concat("head", "body", F.lit(template.close)).alias("turn"))
    pieces = spanned.groupBy("key").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.sort_array(F.collect_list(F.when(F.col("learned"), span))).alias("loss")
    )
    formatted = F.array_join(F.transform("turns", lambda t: t["turn"]), "")
    return pieces.select("key.conv_id", "key.piece", formatted.alias("formatted"), "loss")


def format_chats(events: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Events to rendered pieces: ``final_messages``, then ``render``; see there for NULLs, ties and repeats."""
    return render(final_messages(events, template), template)


def read_back(pieces: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``conv_id, piece, n_chars, turns, learned`` from ``render``'s output alone.

    ``turns``: role and text of each turn, parsed from the text.  ``learned``: what is under the
    loss mask, unescaped, one after the other.
    """
    template = template or ChatTemplate()
    chunks = F.split("formatted", f"\\Q{template.close}\\E")

    def turn(chunk: Column) -> Column:
        role = F.substring_index(F.substr(chunk, F.lit(len(template.open) + 1)), template.role_end, 1)
        text = F.substr(chunk, F.length(role) + F.lit(len(template.open) + len(template.role_end) + 1))
        return F.struct(template.unescaped(role, role=True).alias("role"), template.unescaped(text).alias("text"))

    masked = F.transform("loss", lambda s: F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return pieces.select(
        "conv_id",
        "piece",
        F.length("formatted").cast("long").alias("n_chars"),
        F.transform(F.slice(chunks, 1, F.size(chunks) - 1), turn).alias("turns"),
        template.unescaped(F.array_join(masked, "")).alias("learned"),
    )


def chat_digests(pieces: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from ``render``'s output.

    A digest runs over a whole conversation, so what was read of its pieces meets in one row
    here; nothing else does.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    own = read_back(pieces, template).select(
        "conv_id", "n_chars", F.size("turns").alias("n"), F.struct("piece", F.array_join(said, "").alias("said"), "learned").alias("part")
    )
    met = own.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    whole = met.select("conv_id", "n_turns", "formatted_chars", joined("said").alias("said"), joined("learned").alias("learned"))
    digest = lambda name: F.sha2(F.col(name).cast("binary"), 256)
    return whole.select(
        "conv_id",
        "n_turns",
        digest("said").alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        digest("learned").alias("loss_sha256"),
        "formatted_chars",
    )
