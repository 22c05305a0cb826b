"""Text predicates and templates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as Python's str.strip sees it, as a class and as characters.
_SPACE = r"\s\x1c-\x1f"
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: where a template takes the text.
TEMPLATE_SLOT = "{content_text}"

_NOT_WORD = r"[^\p{L}\p{M}\p{N}_]+"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def strip(text) -> Column:
    return F.btrim(as_column(text), F.lit(_SPACES))


def nonblank(text) -> Column:
    """True where the text is not null and holds more than white space."""
    return F.coalesce(as_column(text).rlike(rf"(?U)[^{_SPACE}]"), F.lit(False))


def is_blank(text) -> Column:
    return ~nonblank(text)


def fill_template(template: str, text) -> Column:
    """The template with the text put in literally; null text gives null."""
    return F.replace(F.lit(template), F.lit(TEMPLATE_SLOT), as_column(text))


def split_words(text) -> Column:
    """Lower-case words of a text in order, with empty ones where it starts or ends otherwise."""
    return F.split(F.lower(as_column(text)), _NOT_WORD)


def whole_number(text, kind: str = "bigint") -> Column:
    """The number a text spells, null for anything else.

    Looking first is much cheaper than a ``try_cast`` that fails, which costs an exception.
    """
    value = as_column(text)
    return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast(kind))
