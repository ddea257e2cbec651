"""Chat formatting of typed content parts, with DataFrame expressions only.

A turn is ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break. A
visitor flattens the parts of a turn in order: text is escaped, an image, audio
or document part becomes a numbered placeholder such as ``<|image_0|>`` and an entry in
the list of attachments, with its reference and the number of tokens it expands to.

Control strings begin with ``<|``. Inside a text, ``<``, any number of backslashes and ``|``
get one backslash more, so no text holds a control string and unescaping, which
takes one away, gives back exactly the text. Neighbouring text parts are joined before they are
escaped, so that none forms where they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailweave.llm.batches import quoted

START, END, LINE_BREAK = "<|im_start|>", "<|im_end|>\n", "<|br|>"
PART = "struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>"

# Tokens that attachments expand to.
IMAGE_PATCH = 28  # pixels along a side of the square that one token stands for
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 1024  # tokens a document page

ATTACHMENTS = ("image", "audio", "document")

# While the parts of a turn are joined, a mark and a letter stand for the beginning of a placeholder, and for the mark itself.
_MARK, _PLACEHOLDER, _ITSELF = "\u0001", "\u0001p", "\u0001t"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_parts(text: Column) -> Column:
    """A text as the one part of its turn; null is empty."""
    values = {"type": F.lit("text"), "text": F.coalesce(text, F.lit(""))}
    names = [field.split(":")[0].strip() for field in PART[len("struct<") : -1].split(",")]
    return F.array(F.struct(*(values.get(name, F.lit(None)).alias(name) for name in names)).cast(PART))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; one if its size is not known."""
    image = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    size = (
        F.when(part["type"] == "image", image)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
        .when(part["type"] == "document", part["pages"].cast("long") * PAGE_TOKENS)
    )
    return F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long")


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*ATTACHMENTS), F.lit(False))


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``loss_spans``, ``attachments`` and ``n_attachment_tokens``.

    Turns come by ``turn``, then role and content; repeated rows are turns of their own and null turns come
    first. ``loss_spans`` are start and length, in code points, of the content of the turns whose role
    is ``trained``. A null conversation id is a conversation. Null roles and null or missing parts are empty; parts of
    an unknown type count as text. Other columns are not looked at.
    """
    content = F.filter(F.coalesce(quoted(parts), F.array().cast(f"array<{PART}>")), lambda part: part.isNotNull())
    order = W.partitionBy("conv").orderBy("turn", "role", "content")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    rows = turns.select(
        quoted(conversation).alias("conv"),
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role).cast("string"), F.lit("")).alias("role"),
        content.cast(f"array<{PART}>").alias("content"),
    )
    rows = rows.select(
        "conv",
        "role",
        "content",
        F.row_number().over(order).alias("nth"),
        F.coalesce(F.sum(F.size(F.filter("content", _is_attachment))).over(earlier), F.lit(0)).alias("n_before"),
    )
    attachments = F.transform(
        F.filter("content", _is_attachment),
        lambda part, i: F.struct(
            (F.col("n_before") + i).cast("int").alias("number"),
            (F.col("nth") - 1).alias("turn_number"),
            part["type"].alias("type"),
            part["ref"].alias("ref"),
            expanded_tokens(part).alias("n_tokens"),
        ),
    )
    # The number of an attachment in its conversation: those of earlier turns and of earlier parts.
    visited = F.transform(
        "content",
        lambda part, i: F.when(
            _is_attachment(part),
            F.concat(
                F.lit(_PLACEHOLDER), part["type"], F.lit("_"),
                (F.col("n_before") + F.size(F.filter(F.slice("content", F.lit(1), i), _is_attachment))).cast("string"), F.lit("|>"),
            ),
        ).otherwise(F.replace(F.coalesce(part["text"], F.lit("")), F.lit(_MARK), F.lit(_ITSELF))),
    )
    escaped = escape(F.array_join(visited, ""))
    body = F.replace(F.replace(escaped, F.lit(_PLACEHOLDER), F.lit("<|")), F.lit(_ITSELF), F.lit(_MARK))
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE_BREAK)), F.lit("\n"))
    rows = rows.select(
        "conv", "nth", "role", attachments.alias("attachments"), head.alias("head"), body.alias("body")
    )
    piece = F.concat("head", "body", F.lit(END))
    by_number = W.partitionBy("conv").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length(piece)).over(by_number), F.lit(0)))
    span = F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    turn_list = F.sort_array(F.collect_list(F.struct("nth", piece.alias("piece"), F.when(F.col("role") == trained, span).alias("span"), "attachments")))
    grouped = rows.groupBy("conv").agg(turn_list.alias("turns"))
    return grouped.select(
        F.col("conv").alias(conversation),
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda x: x.isNotNull()).alias("loss_spans"),
        F.flatten(F.col("turns.attachments")).alias("attachments"),
    ).withColumn("n_attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, x: n + x["n_tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text, in which attachments stand as placeholders.

    ``read_parts`` tells a placeholder from a text that says the same.
    """
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        text = F.substr(inner, F.length(role) + 2)
        return F.struct(
            unescape(F.replace(role, F.lit(LINE_BREAK), F.lit("\n"))).alias("role"), unescape(text).alias("text")
        )

    return F.transform(pieces, turn)


def read_parts(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of role and ``parts``: ``type``, ``text`` of text and ``number`` of an attachment.

    A text that says what a placeholder says is a text, as it is escaped. Neighbouring texts were joined and are one part; empty ones are none.
    """
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = rf"^<\|({'|'.join(ATTACHMENTS)})_(\d+)\|>"

    def part(kind: Column, text: Column, number: Column) -> Column:
        return F.struct(kind.alias("type"), text.cast("string").alias("text"), number.cast("int").alias("number"))

    def segment(own: Column) -> Column:
        """A text, or an attachment and the text behind it."""
        after = F.substr(own, F.length(F.regexp_extract(own, head, 0)) + 1)
        attachment = part(F.regexp_extract(own, head, 1), F.lit(None), F.regexp_extract(own, head, 2))
        text = part(F.lit("text"), unescape(after), F.lit(None))
        return F.when(own.startswith("<|"), F.array(attachment, text)).otherwise(F.array(text))

    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        body = F.substr(inner, F.length(role) + 2)
        segments = F.split(body, rf"(?=<\|(?:{'|'.join(ATTACHMENTS)})_\d+\|>)", -1)
        parts = F.filter(F.flatten(F.transform(segments, segment)), lambda x: (x["type"] != "text") | (x["text"] != ""))
        return F.struct(unescape(F.replace(role, F.lit(LINE_BREAK), F.lit("\n"))).alias("role"), parts.alias("parts"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    return F.array_join(
        F.transform(loss_spans, lambda x: unescape(F.substr(formatted, (x["start"] + 1).cast("int"), x["length"].cast("int")))), ""
    )
