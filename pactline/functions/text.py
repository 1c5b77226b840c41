"""Column functions: line predicates (B2-B8), list markers (D1-D3) and
text cleaning / tokenising (I1-I6, I9, I10).

All are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactline.functions import patterns as P


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- B2..B8 line predicates -------------------------------------------------

def is_blank(line) -> Column:
    return _c(line).rlike(P.BLANK)


def is_continuation(line) -> Column:
    return _c(line).rlike(P.CONT)


def is_exhibit(line) -> Column:
    return _c(line).rlike(P.EXHIBIT)


def is_title(line) -> Column:
    return _c(line).rlike(P.TITLE)


def is_section(line) -> Column:
    """SECTION or EXACT (rule T2 first branch)."""
    c = _c(line)
    return c.rlike(P.SECTION) | c.rlike(P.EXACT)


def is_list_line(line) -> Column:
    """LIST and not SINGLENUM (rule T2 second branch)."""
    c = _c(line)
    return c.rlike(P.LIST) & ~c.rlike(P.SINGLENUM)


def is_upper(line) -> Column:
    """Python ``str.isupper``: some upper-case letter, no lower/title case."""
    c = _c(line)
    return c.rlike(P.UPPER_HAS) & ~c.rlike(P.UPPER_NOT)


def rstrip_ws(line) -> Column:
    return F.regexp_replace(_c(line), P.TRAILING_WS, "")


# --- D1..D3 list markers ----------------------------------------------------

def list_marker(line) -> Column:
    """Marker text (LIST group 1), null when the line is no list line."""
    c = _c(line)
    return F.when(c.rlike(P.LIST), F.regexp_extract(c, P.LIST, 1))


def list_type(marker) -> Column:
    """0 number, 1 ``a)``, 2 ``(a)``, 3 bullet, null otherwise."""
    m = _c(marker)
    return (F.when(m.rlike(P.LIST_CLASS_NUMBER), F.lit(0))
            .when(m.rlike(P.LIST_CLASS_LETTER), F.lit(1))
            .when(m.rlike(P.LIST_CLASS_PAREN), F.lit(2))
            .when(m.rlike(P.LIST_CLASS_BULLET), F.lit(3)))


def list_content(marker) -> Column:
    """Marker without punctuation, '' when the marker has no class."""
    m = _c(marker)
    return (F.when(m.rlike(P.LIST_CLASS_NUMBER), F.regexp_extract(m, P.LIST_CLASS_NUMBER, 1))
            .when(m.rlike(P.LIST_CLASS_LETTER), F.regexp_extract(m, P.LIST_CLASS_LETTER, 1))
            .when(m.rlike(P.LIST_CLASS_PAREN), F.regexp_extract(m, P.LIST_CLASS_PAREN, 1))
            .when(m.rlike(P.LIST_CLASS_BULLET), F.regexp_extract(m, P.LIST_CLASS_BULLET, 1))
            .otherwise(F.lit("")))


# --- I1..I6, I9, I10 text functions -----------------------------------------

def clean_text(text) -> Column:
    """Delete backslash, quote and double quote, strip, lower-case."""
    t = F.translate(_c(text), P.CLEAN_CHARS, "")
    return F.lower(F.regexp_replace(t, P.EDGE_WS, ""))


def lower_flat(text) -> Column:
    """Lower-case, newline to blank."""
    return F.replace(F.lower(_c(text)), F.lit("\n"), F.lit(" "))


def strip_punct(text) -> Column:
    """Delete the 32 ASCII punctuation marks."""
    return F.translate(_c(text), P.PUNCTUATION, "")


def tokenize_words(text) -> Column:
    """I3 then whitespace split, empties dropped (I4)."""
    parts = F.split(strip_punct(text), f"{P.WS}+")
    return F.filter(parts, lambda x: x != "")


def tokenize_sk(text) -> Column:
    """Default vectorizer tokens: lower-case runs of >= 2 word chars.

    Written as a split on non-word runs keeping pieces of length >= 2: the
    same tokens as extracting ``WORD2`` matches, at half the regex cost.
    """
    parts = F.split(F.lower(_c(text)), P.NON_WORD)
    return F.filter(parts, lambda x: F.length(x) >= 2)


def tokenize_seq(text) -> Column:
    """Filter characters to blanks, lower, split on blank, drop empties."""
    blanks = " " * len(P.SEQ_FILTERS)
    t = F.lower(F.translate(_c(text), P.SEQ_FILTERS, blanks))
    return F.filter(F.split(t, " "), lambda x: x != "")


def pad_sequence(seq, length: int = 1000) -> Column:
    """Keep the last ``length`` ids, zero-pad on the left."""
    s = _c(seq)
    kept = F.slice(s, F.greatest(F.size(s) - (length - 1), F.lit(1)), length)
    pad = F.array_repeat(F.lit(0), F.lit(length) - F.size(kept))
    return F.concat(pad, kept)


def one_hot(label, k: int) -> Column:
    """Label to a 0/1 array of length k."""
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: (j == lab).cast("int"))
