"""Text forms of grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Characters that JSON strings of a conversation key write as
# unicode escapes besides the control characters.
ESCAPED_CHARACTERS = (
    ("<", "\\u003c"),
    (">", "\\u003e"),
    ("&", "\\u0026"),
    ("=", "\\u003d"),
    ("'", "\\u0027"),
    ("\u2028", "\\u2028"),
    ("\u2029", "\\u2029"),
)


# A text without any of these is its own JSON string between quotes.
NEEDS_CARE = "[\\x00-\\x1f\"\\\\<>&='\\x7f-\\x9f\\u2028\\u2029]"


def conversation_key(
    location: Column, protocol: Column, address: Column, larger: Column, application: Column
) -> Column:
    """``[location,protocol,address,larger_address,application]``.

    Every ranked conversation gets one, so ordinary texts are only put between
    quotes; the JSON writer is for texts with characters to escape.
    """
    number = F.coalesce(protocol.cast("string"), F.lit("null"))
    plain = F.concat(
        F.lit('["'), location, F.lit('",'), number, F.lit(',"'),
        address, F.lit('","'), larger, F.lit('","'), application, F.lit('"]'),
    )
    head = F.to_json(F.array(location))
    tail = F.to_json(F.array(address, larger, application))
    head = F.substring(head, F.lit(1), F.length(head) - 1)
    careful = F.concat(head, F.lit(","), number, F.lit(","), F.substring(tail, F.lit(2), F.length(tail)))
    for character, escape in ESCAPED_CHARACTERS:
        careful = F.replace(careful, F.lit(character), F.lit(escape))
    texts = F.concat(location, address, larger, application)
    ordinary = texts.isNotNull() & ~texts.rlike(NEEDS_CARE)
    return F.when(ordinary, plain).otherwise(careful)


def exporter_key(node_id: Column, foreign_source: Column, foreign_id: Column) -> Column:
    return F.coalesce(F.concat(foreign_source, F.lit(":"), foreign_id), node_id.cast("string"))
