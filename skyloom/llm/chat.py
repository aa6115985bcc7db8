"""Chat formatting with typed content parts, in SQL functions only.

A message is a list of parts: text, image, audio or document.  `parts_of` reads them out of a text
with references like `![a cat](cat.png =640x480)`.  A visitor flattens them in order: text is
escaped, any other part becomes a placeholder with the number of tokens that it will expand to, by
its size, and its reference is recorded.

The template is

    <s>[ROLE user]
    text[/ROLE]...[ROLE assistant]
    [LOSS]text[/LOSS][/ROLE]</s>

without the line feed behind the last text; a placeholder is `[IMAGE 1564 source[/]`, its source
being the part's own text, or its reference where it has none.  Every control string starts with
`<` or `[`.  In texts, roles and sources each of `<`, `[`, `]` and `\\` gets a `\\` behind it, so no
control string can appear in them; dropping placeholders' marks, and the character behind each of
the four, gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, take

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
KINDS = ("image", "audio", "document")
BEGIN, END, OPEN, AFTER, CLOSE, LOSS, UNLOSS = "<s>", "</s>", "[ROLE ", "]\n", "[/ROLE]", "[LOSS]", "[/LOSS]"


#: References in texts, by kind: endings of names, and the size that may follow.
ENDINGS = {"image": ("png|jpe?g|gif|webp", "[0-9]{1,5}x[0-9]{1,5}"), "audio": ("wav|mp3|ogg|flac", "[0-9]{1,6}(?:[.][0-9]{1,3})?s"), "document": ("pdf|docx?|txt|md", "[0-9]{1,6}p")}
MEDIA = r"!\[[^\[\]\n]*\]\([^()\x20\x09-\x0D]+[.](?:" + "|".join(f"(?i:{names})(?: ={size})?" for names, size in ENDINGS.values()) + r")\)"


def ending(kind: str) -> str:
    """How a reference of a kind ends."""
    names, size = ENDINGS[kind]
    return rf"[.](?i:{names})(?: ={size})?\)$"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\]\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\]\\])\\", "$1")


def parts_of(text: Column) -> Column:
    """A text as an array of parts: its references (see `MEDIA`), and what lies between them.  The
    parts' texts, joined, are the text; null and empty texts are one empty part."""
    text = F.coalesce(text, F.lit(""))
    number = lambda m, pattern, kind: F.nullif(F.regexp_extract(m, pattern, 1), F.lit("")).cast(kind)

    def reference(m: Column) -> Column:
        kind = F.when(m.rlike(ending("image")), "image").when(m.rlike(ending("audio")), "audio").otherwise("document")
        return F.struct(
            kind.alias("type"), m.alias("text"), F.regexp_extract(m, r"\(([^ )]*)", 1).alias("uri"), number(m, r" =([0-9]+)x[0-9]+\)$", "int").alias("width"),
            number(m, r" =[0-9]+x([0-9]+)\)$", "int").alias("height"), number(m, r" =([0-9.]+)s\)$", "double").alias("seconds"), number(m, r" =([0-9]+)p\)$", "int").alias("pages"),
        )

    def woven(found: Column) -> Column:
        between = F.transform(F.split(text, MEDIA, -1), lambda t: text_part(t)[0])
        media = F.transform(found, reference)
        return F.filter(F.flatten(F.zip_with(between, media, lambda a, b: F.array(a, b))), lambda p: p.isNotNull() & ((p["type"] != "text") | (p["text"] != "")))

    some = let(F.regexp_extract_all(text, F.lit(MEDIA), F.lit(0)), woven)
    return F.when(F.contains(text, F.lit("![")), some).otherwise(text_part(text)).cast(f"array<{PART}>")


def expanded(part: Column, patch: int = 14, per_second: float = 25.0, per_page: int = 256) -> Column:
    """Tokens that a part's placeholder stands for: image patches, audio frames or pages; at
    least one, so that a part of unknown size still has a place."""
    cells = F.ceil(F.coalesce(part["width"], F.lit(0)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(0)) / patch)
    frames = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * per_second)
    pages = F.coalesce(part["pages"], F.lit(0)) * per_page
    n = F.when(part["type"] == "image", cells).when(part["type"] == "audio", frames).otherwise(pages)
    return F.greatest(n.cast("long"), F.lit(1).cast("long"))


def visit(parts: Column) -> Column:
    """Flattens a message: struct of `body` (escaped text and placeholders, in order) and
    `attachments` (kind, uri, position in the message, tokens).  Parts of unknown type count as
    text; null parts and null texts as empty; a null list as no parts."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    media = lambda p: F.coalesce(p["type"].isin(*KINDS), F.lit(False))

    def holder(p: Column) -> Column:
        return F.concat(F.lit("["), F.upper(p["type"]), F.lit(" "), expanded(p).cast("string"), F.lit(" "), escape(F.coalesce(p["text"], p["uri"], F.lit(""))), F.lit("[/]"))

    body = F.array_join(F.transform(parts, lambda p: F.when(media(p), holder(p)).otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "")
    refs = F.filter(
        F.transform(parts, lambda p, i: F.when(media(p), F.struct(p["type"].alias("kind"), p["uri"].alias("uri"), i.cast("int").alias("position"), expanded(p).alias("tokens")))),
        lambda r: r.isNotNull(),
    )
    return F.struct(body.alias("body"), refs.alias("attachments"))


def text_part(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, train_on: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: the id, n_turns, `formatted`, `segments` (text, loss: joined they
    are `formatted`; loss marks what is trained on), `attachments` (turn index, kind, uri, position,
    tokens) and `attachment_tokens`.

    A message's parts are its `parts` column, if named, else its `text` as one part.  Turns are
    in the order of `turn` (nulls first), then role and body.  A null role is an empty one; a null
    conversation id is a conversation of its own; an empty table gives no rows.  One conversation
    is one value by definition, so it must fit a row; a conversation's messages meet by a shuffle
    on its id, whatever their number."""
    names = [conv, turn, role, parts or text]
    rows = take(messages, *names).toDF("conv", "turn", "role", "content")
    content = F.col("content") if parts else text_part(F.col("content"))
    rows = rows.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(content).alias("m"))
    rows = rows.select("conv", F.struct("turn", "role", F.col("m.body").alias("body"), F.col("m.attachments").alias("attachments")).alias("t"))
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t: Column) -> Column:
        seg = lambda x, loss: F.struct(x.alias("text"), F.lit(loss).alias("loss"))
        head = F.concat(F.lit(OPEN), escape(t["role"]), F.lit(AFTER))
        return F.when(
            t["role"].isin(*train_on), F.array(seg(F.concat(head, F.lit(LOSS)), False), seg(t["body"], True), seg(F.lit(UNLOSS + CLOSE), False))
        ).otherwise(F.array(seg(F.concat(head, t["body"], F.lit(CLOSE)), False)))

    edge = lambda s: F.array(F.struct(F.lit(s).alias("text"), F.lit(False).alias("loss")))
    done = turns.select(
        "conv",
        F.size("turns").cast("long").alias("n_turns"),
        F.concat(edge(BEGIN), F.flatten(F.transform("turns", pieces)), edge(END)).alias("segments"),
        F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(i.cast("int").alias("turn_index"), a["kind"].alias("kind"), a["uri"].alias("uri"), a["position"].alias("position"), a["tokens"].alias("tokens"))))).alias("attachments"),
    )
    return done.select(
        F.col("conv").alias(conv),
        "n_turns",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
    )


def read_text(body: Column) -> Column:
    """The text that a turn's body, or a segment under the loss mask, stands for."""
    marks = r"\[(?:" + "|".join(k.upper() for k in KINDS) + r") [0-9]+ |\[/\]"
    return unescape(F.regexp_replace(body, marks, ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, loss).  Inverse of `format_chats`
    for texts and what `parts_of` makes of them; of other parts the placeholder's source is read."""
    quoted = lambda s: "\\Q" + s + "\\E"
    inner = F.regexp_replace(F.regexp_replace(formatted, "^" + quoted(BEGIN), ""), quoted(END) + "$", "")
    # each turn ends with CLOSE, which texts cannot hold; the last split is empty
    blocks = let(F.split(inner, quoted(CLOSE)), lambda b: F.slice(b, 1, F.size(b) - 1))

    def turn(b: Column) -> Column:
        # in a role each "]" has a "\\" behind it, so the first "]" before a line feed ends the head
        head = F.substring_index(F.substr(b, F.lit(len(OPEN) + 1)), AFTER, 1)
        rest = F.substr(b, F.length(head) + (len(OPEN) + len(AFTER) + 1))
        loss = rest.startswith(LOSS)
        body = F.when(loss, F.substr(rest, F.lit(len(LOSS) + 1), F.length(rest) - (len(LOSS) + len(UNLOSS)))).otherwise(rest)
        return F.struct(unescape(head).alias("role"), read_text(body).alias("text"), loss.alias("loss"))

    return F.transform(blocks, turn)
