"""Text measures taken when a text is stored, as Column expressions on the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of ECMAScript, once as a set of characters and once as a regex class.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# Those beyond ASCII are looked up for characters beyond ASCII only, which is several times as fast.
WHITE_SPACE_CLASS = r"[\t-\r [\u0080-\uFFFF&&[\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]]]"
NON_SPACE = r"[\S&&[^\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]]"
# The words that hint at English, and the payload fields that may hold the text of a record.
ENGLISH_WORDS = ("the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by")
TEXT_FIELDS = ("text", "content", "body", "description", "message", "title")

URL = r"https?://"
EMAIL = r"@\w+\.\w+"
DIGIT = r"\d"
PUNCTUATION = r"[.,;:!?]"
CAPITAL = r"[A-Z]"
SENTENCE_END = r"[.!?]+"


def trim(text: Column) -> Column:
    """Strip ECMAScript white space; Spark's own trim knows the space character only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for NULL as well as for white space."""
    return text.isNull() | ~text.rlike(NON_SPACE)


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units. A 4-byte UTF-8 character is the one case that takes two units."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def longer_than(text: Column, limit: int) -> Column:
    """Whether a text has more UTF-16 units; bytes, whose number is known, are never fewer than those."""
    return (F.octet_length(text) > limit) & (utf16_length(text) > limit)


def word_count(text: Column) -> Column:
    trimmed = trim(text)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WHITE_SPACE_CLASS + "+")))


def line_count(text: Column) -> Column:
    return F.size(F.split(text, "\n"))


def sentence_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SENTENCE_END), lambda part: trim(part) != ""))


def likely_english(text: Column) -> Column:
    # ASCII boundaries on purpose: those of Java count accented letters as word characters. The Kelvin sign stands
    # with the ASCII letters because it becomes one in lower case.
    edge = r"[A-Za-z0-9_\u212A]"
    return text.rlike(rf"(?i)(?<!{edge})(?:{'|'.join(ENGLISH_WORDS)})(?!{edge})")


def language_hints(text: Column) -> Column:
    return F.struct(
        likely_english(text).alias("likely_english"),
        text.rlike(PUNCTUATION).alias("has_punctuation"),
        text.rlike(CAPITAL).alias("has_capitalization"),
    )


def analysis(text: Column) -> Column:
    """All measures of a text in one struct."""
    counted = F.struct(F.greatest(word_count(text), F.lit(1)).alias("words"), utf16_length(text).alias("length"))

    def measures(m: Column) -> Column:
        return F.struct(
            m["words"].alias("word_count"),
            m["length"].alias("character_count"),
            line_count(text).alias("line_count"),
            sentence_count(text).alias("sentence_count"),
            # Every character counts, white space included.
            (m["length"] / m["words"]).alias("avg_word_length"),
            text.rlike(URL).alias("contains_urls"),
            text.rlike(EMAIL).alias("contains_emails"),
            text.rlike(DIGIT).alias("contains_numbers"),
            language_hints(text).alias("language_hints"),
        )

    # A one-element array hands the counts on, so that they are taken once per text.
    return F.element_at(F.transform(F.array(counted), measures), 1)


def first_text(fields: dict[str, Column]) -> Column:
    """The first non-blank string among the known text fields, trimmed; NULL when there is none."""
    found = [F.nullif(trim(fields[name]), F.lit("")) for name in TEXT_FIELDS if name in fields]
    return F.coalesce(*found) if found else F.lit(None).cast("string")
