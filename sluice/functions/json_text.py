"""JSON text of event fields.

``to_json`` of a variant sorts keys at every depth, is compact, and keeps nulls
and large integers, so two equal payloads always have equal text.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that the destinations receive as unicode escapes.
LINE_SEPARATORS = (("\u2028", "\\u2028"), ("\u2029", "\\u2029"))
MARKUP = (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"))


def encode(payload: Column) -> Column:
    """Canonical JSON text; an absent field becomes the four letters ``null``."""
    return F.coalesce(F.to_json(payload), F.lit("null"))


def _escape(text: str, pairs) -> Column:
    for plain, escaped in pairs:
        literal = escaped.replace("\\", "\\\\")
        text = f"replace({text}, '{plain}', '{literal}')"
    return F.expr(text)


def escape_separators(text: str) -> Column:
    """``text`` is a column name or a SQL expression, here and below."""
    return _escape(text, LINE_SEPARATORS)


def escape_markup(text: str) -> Column:
    return _escape(text, LINE_SEPARATORS + MARKUP)


def quote(text: Column) -> Column:
    """A plain string as a JSON string literal."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)
