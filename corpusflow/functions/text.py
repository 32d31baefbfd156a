"""Text expressions; all but the decoding of character references run inside the JVM."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUT = "\u0001"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(_col(text)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def words(text) -> Column:
    """Runs of non-space characters."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def word_count(text) -> Column:
    return F.size(words(text))


def sentences(text) -> Column:
    """Pieces that end in ``.``, ``?`` or ``!`` followed by white space."""
    marked = F.regexp_replace(_col(text), r"([.?!])\s+", "$1" + CUT)
    return F.filter(F.split(marked, CUT), lambda s: s != "")


def preview(text, n: int) -> Column:
    """One-line preview: newlines become spaces, outer blanks go, first ``n`` characters stay."""
    return F.substring(F.trim(F.replace(_col(text), F.lit("\n"), F.lit(" "))), 1, n)


def text_key(text) -> Column:
    """Identity of a document is its full text."""
    return F.sha2(_col(text), 256)


@F.arrow_udf(T.StringType())
def _unescaped(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())


def unescape(text) -> Column:
    """Decode all named and numeric character references of HTML 5, each once; a no-break space is a blank."""
    return F.replace(_unescaped(_col(text)), F.lit("\u00a0"), F.lit(" "))


# Dropped with their content, then every other tag.
HIDDEN_BLOCKS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
ANY_TAG = r"(?s)<[^>]*>"


def html_text(page) -> Column:
    """Readable text of a page."""
    visible = F.regexp_replace(_col(page), HIDDEN_BLOCKS, " ")
    bare = F.regexp_replace(visible, ANY_TAG, " ")
    return F.trim(F.regexp_replace(unescape(bare), r"\s+", " "))


def html_headed_text(page) -> Column:
    """Page text with one line per block and ``#`` marks in front of h1..h3 titles."""
    out = F.regexp_replace(_col(page), HIDDEN_BLOCKS, " ")
    out = F.regexp_replace(out, r"\s+", " ")
    for level in (1, 2, 3):
        out = F.regexp_replace(out, rf"(?i)<h{level}\b[^>]*>", "\n" + "#" * level + " ")
    out = F.regexp_replace(out, r"(?i)</h[1-6]\s*>|</?(p|br|li|div|tr|nav|article|footer)\b[^>]*>", "\n")
    out = unescape(F.regexp_replace(out, ANY_TAG, " "))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    return F.trim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))
