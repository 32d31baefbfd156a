"""License scans: one Aho-Corasick pass finds phrases and tags, a shunting-yard parser reads tagged expressions.

Texts become words (ASCII letters lowered, runs of letters, digits and other non-ASCII signs)
with single spaces between, so phrases match whole words only, across any punctuation.
Where the identifier tag occurs, the original text behind it is parsed as a licence expression
of ids, AND, OR, WITH and brackets, which gives the ids named and those a user may comply with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

# The base phrases with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# The scan's own notice phrases.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "bsd license": "bsd", "eclipse public license": "epl", "isc license": "isc",
    "boost software license": "bsl", "creative commons": "cc", "public domain": "public-domain", "unlicense": "unlicense",
    "all rights reserved": "all-rights-reserved", "proprietary and confidential": "proprietary"}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n*]*)", re.IGNORECASE)
# How far a licence reaches, for choices between them: OR takes the least, AND the greatest.
REACH = {"permissive": 0, "weak copyleft": 1, "copyleft": 2, "restricted": 3}
FAMILIES = (("agpl", 2), ("lgpl", 1), ("gpl", 2), ("mpl", 1), ("epl", 1), ("cc-by-nc", 3), ("cc-by-nd", 3), ("cc-by-sa", 2), ("cc-by", 0),
            ("cc0", 0), ("apache", 0), ("mit", 0), ("bsd", 0), ("isc", 0), ("bsl", 0), ("zlib", 0), ("unlicense", 0))
ORDER = {"or": 1, "and": 2, "with": 3}
# Lower-case A-Z and blank out all ASCII that is no letter or digit.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: ids and operators in postfix order; None if it is no licence expression."""
    out, held, want_id = [], [], True
    for token in re.findall(r"[()]|[A-Za-z0-9.+:-]+|\S", expression):
        low = token.lower()
        if token == "(":
            if not want_id:
                return None
            held.append(token)
        elif token == ")":
            if want_id:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif low in ORDER:
            if want_id:
                return None
            while held and held[-1] != "(" and ORDER[held[-1]] >= ORDER[low]:
                out.append(held.pop())
            held.append(low)
            want_id = True
        elif want_id and re.fullmatch(r"[a-z0-9.+:-]+", low):
            out.append(low)
            want_id = False
        else:
            return None
    if want_id or "(" in held:
        return None
    return out + held[::-1]


def evaluate(expression: str) -> tuple[list[str], int] | None:
    """Ids of an expression and how far what it allows reaches; None if it cannot be read.

    An exception after WITH eases its licence by one step. Unknown ids count as restricted.
    """
    order = postfix(expression)
    if order is None:
        return None
    stack, ids = [], []
    for token in order:
        if token not in ORDER:
            reach = next((r for family, r in FAMILIES if token == family or token.startswith((f"{family}-", f"{family}+"))), 3)
            stack.append((reach, token))
            continue
        (b, b_id), (a, a_id) = stack.pop(), stack.pop()
        if token == "with":
            if b_id is None or a_id is None:
                return None
            stack.append((max(a - 1, 0), None))
            ids.append(f"{a_id} with {b_id}")
        else:
            ids += [x for x in (a_id, b_id) if x]
            stack.append((min(a, b) if token == "or" else max(a, b), None))
    reach, last = stack.pop()
    return sorted({*ids, *([last] if last else [])}), reach


@cache
def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrases, base in ((BASE, True), (NOTICES, False), ({TAG_WORDS: ""}, False)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (phrase, label, base))
    found.make_automaton()
    return found


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float, str | None]:
    """``(n_words, n_base, first_word, last_word, base_labels, labels, score, expression reach)``."""
    found = text.translate(FOLD).split()
    # A blank at either end of a phrase is shared with the next one, as the automaton reports every end.
    joined = (b" " + b" ".join(found) + b" ").decode("utf-8", "surrogatepass")
    n_base, first, last, base, other, tagged = 0, None, None, set(), set(), False
    seen, place = 0, 0  # characters read and the word that begins there, both kept from match to match
    for end, (phrase, label, is_base) in automaton().iter(joined):
        if phrase == TAG_WORDS:
            tagged = True
            continue
        if not is_base:
            other.add(label)
            continue
        place += joined.count(" ", seen, end)
        seen = end
        begin = place - phrase.count(" ") - 1
        n_base += 1
        first = begin if first is None or begin < first else first
        last = begin if last is None or begin > last else last
        base.add(label)
    score, reach = 0.0, None
    if other:
        score = 0.5
    if base or other - {"all-rights-reserved", "proprietary", "public-domain", "cc"}:
        score = 0.8
    if tagged:
        for match in TAG.finditer(text):
            got = evaluate(match.group(1).decode("utf-8", "replace").strip().removesuffix("-->").strip())
            score = max(score, 0.3)
            if got is not None:
                other.update(i.replace(",", " ") for i in got[0])
                reach = max(got[1], -1 if reach is None else reach)
                score = 1.0
    names = {v: k for k, v in REACH.items()}
    return (len(found), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | other)), score,
            None if reach is None else names[reach])


FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                   ("reach", pa.string())])


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence evidence in every document, from its whole text.

    ``score`` is 1 for a tagged expression that can be read, 0.8 for a named licence, 0.5 for a
    mere rights notice, 0.3 for a tag that cannot be read, 0 for nothing. ``reach`` tells what
    tagged expressions demand at most. Null and empty texts have no words and no labels; repeated
    rows each give a row; null ids stay null. Other columns are not read.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [scan(t) for t in utf8(part.column(1))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(FOUND) - 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(FOUND)[1:], strict=True)]], schema=FOUND)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                                    "labels string, score double, reach string")
