"""Text cleaning as column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the light clean counts as white space: Unicode white space and the separators 1C to 1F.
WIDE_SPACE = r"[\s\x1C-\x1F]"


def trim_spaces(text: Column) -> Column:
    return F.trim(text)


def breaks_to_spaces(text: Column) -> Column:
    return _where_tagged(text, lambda tagged: F.regexp_replace(tagged, r"<br\s*/?>", " "))


def punctuation_to_spaces(text: Column, unicode: bool = False) -> Column:
    return F.regexp_replace(text, _flag(unicode) + r"[^\w\s]", " ")


def collapse_spaces(text: Column, unicode: bool = False) -> Column:
    return F.regexp_replace(text, _flag(unicode) + r"\s+", " ")


def strip_tags(text: Column) -> Column:
    return _where_tagged(text, lambda tagged: F.regexp_replace(tagged, "<[^>]+>", ""))


def classic_clean(text: Column, unicode: bool = False) -> Column:
    """Break tags and punctuation to spaces, white space collapsed, ends trimmed.

    Blanking [^\\w\\s] and then collapsing \\s+ leaves one space per run of non-word
    characters, so a single \\W+ pass does the work of both.
    """
    return F.trim(F.regexp_replace(breaks_to_spaces(text), _flag(unicode) + r"\W+", " "))


def classic_clean_sql(text: str, unicode: bool = False) -> str:
    """The same expression as SQL text, for pipeline stages that are stored as SQL."""
    without_breaks = (
        f"if(contains({text}, '<'), regexp_replace({text}, r'<br\\s*/?>', ' '), {text})"
    )
    return f"trim(regexp_replace({without_breaks}, r'{_flag(unicode)}\\W+', ' '))"


def light_clean(text: Column) -> Column:
    """Tags out, white space collapsed; case and punctuation are kept. Null becomes ''."""

    def without_tags(tagged: Column) -> Column:
        spaced = F.regexp_replace(tagged, f"(?U)<br{WIDE_SPACE}*/?>", " ")
        return F.regexp_replace(spaced, "<[^>]+>", "")

    plain = _where_tagged(F.coalesce(text, F.lit("")), without_tags)
    return F.trim(F.regexp_replace(plain, f"(?U){WIDE_SPACE}+", " "))


def with_clean_text(df: DataFrame, clean=classic_clean, text: str = "text") -> DataFrame:
    """Replace `text` by its cleaned form and drop the rows left without any.

    The one-element explode keeps the optimizer from copying the regexes into the filter,
    which would run them twice per row; the null test stays plain and reaches the scan.
    """
    kept = df.filter(F.col(text).isNotNull())
    columns = [
        F.explode_outer(F.array(clean(F.col(text)))).alias(text) if name == text else F.col(name)
        for name in kept.columns
    ]
    return kept.select(*columns).filter(F.col(text) != "")


def input_status(text: Column) -> Column:
    """'ok', or 'empty' where nothing but white space was given."""
    return F.when(text.rlike(r"(?U)[^\s\x1C-\x1F]"), "ok").otherwise("empty")


def leaves_words(text: Column, unicode: bool = False) -> Column:
    """True where the classic clean leaves something: it keeps word characters outside of break
    tags, so the first of them settles it."""
    return breaks_to_spaces(text).rlike(_flag(unicode) + r"\w")


def _where_tagged(text: Column, change) -> Column:
    """Most texts hold no tag at all; a byte search spares those the regex."""
    return F.when(F.contains(text, F.lit("<")), change(text)).otherwise(text)


def _flag(unicode: bool) -> str:
    return "(?U)" if unicode else ""
