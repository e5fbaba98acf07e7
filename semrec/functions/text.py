"""Text Column expressions: item text, history sentences, chat formats and
prediction parsing.  All JVM-side; each is exercised by a whole-table job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sid import extract_first_sid, py_strip

# Prompt text and chat markers that must equal the reference's.
SYSTEM_MESSAGE = (
    "You are a professional recommendation expert who needs to recommend the next possible "
    "purchase for users based on their purchase history. Please predict the most likely next "
    "product that the user will purchase based on the user's historical purchase information."
)
PURCHASED_PREFIX = "The user has purchased the following items: "
INTERACTED_PREFIX = "The user has interacted with the following items: "
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
USER_TURN = "<|im_start|>user"
ASSISTANT_TURN = "<|im_start|>assistant"
RATIONALE_TEMPLATE = "The user is likely to buy items in {categories} category"

# Category names for the content_type / photo_type codes.
CONTENT_TYPE_NAMES = {0: "Image and Video Creation", 1: "Image Creation", 2: "Video Creation"}
PHOTO_TYPE_NAMES = {1: "Material", 2: "Short Film"}
DEFAULT_CATEGORY = "General Creation"

# Behaviour verbs (documented mapping).
BEHAVIOR_VERBS = {
    "LIKE": "liked",
    "UNLIKE": "unliked",
    "COMMENT": "commented on",
    "SHARE": "shared",
    "VIDEO_PLAY_FINISH": "finished watching",
    "LONG_PLAY": "watched",
    "SHORT_PLAY": "watched",
    "OPERATE": "clicked",
    "PRODUCE": "created",
}

# Line terminators replaced by a space before text is written as TSV.
_LINE_BREAKS = "\u2028\u2029\r"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def item_category(content_type, photo_type) -> Column:
    """H6: category path from the two type codes."""
    ct = _col(content_type).cast("bigint")
    pt = _col(photo_type).cast("bigint")
    head = F.when(ct.isNull(), F.lit(DEFAULT_CATEGORY)).otherwise(
        F.coalesce(F.element_at(_map(CONTENT_TYPE_NAMES), ct),
                   F.concat(F.lit("Content Type "), ct.cast("string"))))
    tail = F.when(pt.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" > "), F.coalesce(F.element_at(_map(PHOTO_TYPE_NAMES), pt),
                                          F.concat(F.lit("Type "), pt.cast("string")))))
    return F.concat(head, tail)


def truncate_description(c, n: int = 1000) -> Column:
    """H7: null -> ''; longer than ``n`` characters -> first ``n`` + '...'."""
    c = F.coalesce(_col(c), F.lit(""))
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def item_title(title, introduction, description, item_id, n: int = 100) -> Column:
    """H8: title, else introduction[:n], else description[:n], else 'Item {id}'."""
    return F.coalesce(
        F.nullif(_col(title), F.lit("")),
        F.nullif(F.substring(_col(introduction), 1, n), F.lit("")),
        F.nullif(F.substring(_col(description), 1, n), F.lit("")),
        F.concat(F.lit("Item "), _col(item_id).cast("string")))


def clean_text(c) -> Column:
    """H9: U+2028, U+2029 and CR become spaces; LF and TAB stay.

    Byte-level ``replace`` per terminator: several times faster than
    ``translate``'s per-character map lookups on long texts.
    """
    out = _col(c)
    for ch in _LINE_BREAKS:
        out = F.replace(out, F.lit(ch), F.lit(" "))
    return out


def item_phrase(sid, title, categories, quote: str = '"') -> Column:
    """``{sid}, its title is "{title}", its categories are "{categories}"``."""
    return F.concat(_col(sid), F.lit(f", its title is {quote}"),
                    F.coalesce(_col(title), F.lit("")),
                    F.lit(f"{quote}, its categories are {quote}"),
                    F.coalesce(_col(categories), F.lit("")), F.lit(quote))


def history_sentence(joined, prefix: str = PURCHASED_PREFIX) -> Column:
    """Prefix + items already joined by '; ' + trailing ';'."""
    return F.concat(F.lit(prefix), _col(joined), F.lit(";"))


def _opener(user, system: str) -> Column:
    return F.concat(F.lit(f"{IM_START}system\n{system}{IM_END}\n{IM_START}user\n"),
                    F.coalesce(_col(user), F.lit("")),
                    F.lit(f"{IM_END}\n{IM_START}assistant\n"))


def chat_prompt_think(user, system: str = SYSTEM_MESSAGE) -> Column:
    """System + user turns and an open assistant turn."""
    return _opener(user, system)


def chat_prompt_direct(user, system: str = SYSTEM_MESSAGE) -> Column:
    """Opener followed by an empty think block."""
    return F.concat(_opener(user, system), F.lit(f"{THINK_OPEN}\n\n{THINK_CLOSE}\n"))


def chat_prompt_sid(user, thinking, system: str = SYSTEM_MESSAGE) -> Column:
    """Opener with a given thinking text inside a closed think block."""
    return F.concat(_opener(user, system), F.lit(f"{THINK_OPEN}\n"),
                    F.coalesce(_col(thinking), F.lit("")), F.lit(f"\n{THINK_CLOSE}\n"))


def sft_text(user, target, system: str = SYSTEM_MESSAGE) -> Column:
    """Full training conversation with an empty think block."""
    return F.concat(_opener(user, system), F.lit(f"{THINK_OPEN}\n\n{THINK_CLOSE}\n"),
                    F.coalesce(_col(target), F.lit("")), F.lit(f"{IM_END}\n"))


def rationale_text(user, target, title, categories, system: str = SYSTEM_MESSAGE) -> Column:
    """As H14, but a non-null title puts a category rationale in the think block."""
    head, tail = RATIONALE_TEMPLATE.split("{categories}")
    think = F.when(_col(title).isNotNull(),
                   F.concat(F.lit(head), F.coalesce(_col(categories), F.lit("None")), F.lit(tail))
                   ).otherwise(F.lit(""))
    return F.concat(_opener(user, system), F.lit(f"{THINK_OPEN}\n"), think,
                    F.lit(f"\n{THINK_CLOSE}\n"), F.coalesce(_col(target), F.lit("")),
                    F.lit(f"{IM_END}\n"))


def normalize_prediction(c, levels: int = 3) -> Column:
    """Text after the last '</think>', stripped, spaces removed, first SID."""
    tail = F.substring_index(_col(c), THINK_CLOSE, -1)
    # a SID is found the same before stripping, and text without one is stripped there
    return extract_first_sid(F.replace(tail, F.lit(" "), F.lit("")), levels)


def extract_thinking(text, user) -> Column:
    """Thinking content of a generated text ('' when there is none).

    After the last copy of the user content (when present), after the last
    '<think>', before the first '</think>', stripped.
    """
    text, user = _col(text), _col(user)
    # the copy is searched from the end, and without one this is the whole text: long prompts are not read through
    assistant = F.coalesce(F.call_function("substring_index", text, user, F.lit(-1)), text)
    think = F.substring_index(F.substring_index(assistant, THINK_OPEN, -1), THINK_CLOSE, 1)
    return F.when(F.contains(assistant, F.lit(THINK_OPEN)), py_strip(think)).otherwise(F.lit(""))


def extract_response(c, levels: int = 3) -> Column:
    """The assistant's answer reduced to its first SID."""
    c = _col(c)
    after_think = F.substring_index(c, THINK_CLOSE, -1)
    turn = F.split_part(c, F.lit(ASSISTANT_TURN), F.lit(2))
    turn = F.when(F.instr(turn, IM_END) > 0, F.substring_index(turn, IM_END, 1)).otherwise(turn)
    picked = (F.when(F.contains(c, F.lit(THINK_CLOSE)), after_think)
              .when(F.contains(c, F.lit(ASSISTANT_TURN)), turn)
              .otherwise(c))
    return extract_first_sid(picked, levels)  # which strips what holds no SID


def loss_span_start(text) -> Column:
    """0-based character offset where the user turn starts, -1 if absent
    (then the whole row is masked from the loss)."""
    return (F.instr(_col(text), USER_TURN) - 1).cast("bigint")


def loss_span(text) -> Column:
    """H22 as ``struct<start, masked>``: ``masked`` when the user turn is absent
    and the whole row is excluded from the loss."""
    start = loss_span_start(text)
    return F.struct(start.alias("start"), (start < 0).alias("masked"))


def behavior_verb(subtype, behavior_type, event_type) -> Column:
    """Verb for an interaction; subtype first, then type, then event."""
    m = _map(BEHAVIOR_VERBS)
    return F.coalesce(F.element_at(m, _col(subtype)), F.element_at(m, _col(behavior_type)),
                      F.element_at(m, _col(event_type)))
