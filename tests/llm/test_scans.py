"""Licence scans, decontamination, token totals and toxicity against plain versions of themselves."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpusflow.llm import decontaminate, licenses, token_counts, toxicity

SCHEMA = "doc_id long, text string"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_licenses(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def test_licences_match_brute_force(documents, frame):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(1000, None), (1001, ""), (1002, "MIT-License; mit license mit license cc by cc by cc"), (1003, "xmit license, mit licenses"),
             (1004, "apache license " * 40_000), (1004, "É MIT\nLicense é"), (None, "gnu general public license")]
    got = licenses.licenses(frame([(*r, 0) for r in rows], SCHEMA + ", score int")).collect()
    want = Counter((i, *brute_licenses(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in got)
    assert licenses.licenses(frame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(("text", "order"), [
    ("MIT OR Apache-2.0 AND BSD-3-Clause", ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]),
    ("(MIT OR Apache-2.0) AND BSD", ["mit", "apache-2.0", "or", "bsd", "and"]),
    ("GPL-2.0+ WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0+", "classpath-exception-2.0", "with", "mit", "or"]),
    ("MIT OR", None), ("(MIT", None), ("MIT)", None), ("", None), ("MIT Apache-2.0", None), ("AND MIT", None)])
def test_shunting_yard(text, order):
    assert licenses.postfix(text) == order


def test_expressions_are_evaluated(frame):
    assert licenses.evaluate("GPL-3.0 AND MIT")[1] == 2 and licenses.evaluate("GPL-3.0 OR MIT")[1] == 0
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0") == (["gpl-2.0 with classpath-exception-2.0"], 1)
    for other in ("Mitre-9", "gplish", "apachectl", "LicenseRef-mit"):
        assert licenses.evaluate(other)[1] == 3
    assert [licenses.evaluate(x)[1] for x in ("MIT", "MIT-0", "GPL-2.0+", "gpl+", "CC-BY-SA-4.0", "CC-BY-4.0")] == [0, 0, 2, 2, 2, 0]
    text = "// SPDX-License-Identifier: (GPL-2.0-only OR MIT)\ncode"
    row = licenses.licenses(frame([(1, text)], SCHEMA)).first()
    assert (row.labels, row.score, row.reach, row.n_base) == ("gpl-2.0-only,mit", 1.0, "permissive", 0)


def test_leaks_match_brute_force(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    grams = lambda text: [tuple(w[i:i + 6]) for w in [re.findall(r"[^\W_]+", (text or "").lower())] for i in range(len(w) - 5)]
    items = {r.item_id: grams(r.text) for r in benchmark.collect()}
    want = set()
    for r in documents.collect():
        have = set(grams(r.text))
        want |= {(r.doc_id, i) for i, g in items.items() if sum(x in have for x in g) >= 0.5 * len(g)}
    got = decontaminate.leaks(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    assert not any(r.reparameterised for r in got)


ITEM = "Then Anna bought 12 apples at the old market for 3.50 dollars, and Anna gave 4 of them to her friend Peter."


def test_reparameterised_questions_and_slot_consistency(frame):
    docs = [(1, "Well. " + ITEM), (2, ITEM.upper()), (3, ITEM.replace("Anna", "Maria").replace("12", "15").replace("3.50", "7")),
            (4, ITEM.replace("Anna", "Maria", 1).replace("Anna", "Julia")), (5, None), (6, ""), (7, "nothing of it here"),
            (8, "pad " * 200_000 + ITEM), (None, ITEM), (1, "Well. " + ITEM), (9, "12 3 4 5 6 7 8 9 10 11 12")]
    items = [(1, ITEM), (2, None), (3, ""), (4, "1 2 3 4 5 6 7 8"), (5, "of"), (6, "five plain words stand here")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(
        frame([(*d, "y") for d in docs], SCHEMA + ", share string"), frame(items, "item_id long, text string")).collect()}
    assert set(got) == {(i, 1) for i in (1, 2, 3, 8, None)}
    assert got[3, 1].reparameterised and not got[1, 1].reparameterised and got[1, 1].share == 1.0
    short = decontaminate.leaks(frame([(1, "I say: five plain words stand here, again.")], SCHEMA), frame(items, "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in short.collect()] == [(1, 6)]
    assert decontaminate.leaks(frame([], SCHEMA), frame(items, "item_id long, text string")).collect() == []
    assert decontaminate.leaks(frame(docs, SCHEMA), frame([], "item_id long, text string")).collect() == []


def test_one_assignment_over_all_alignments(frame):
    items = frame([(1, ITEM)], "item_id long, text string")
    first, both = ITEM.replace("Anna", "Maria", 1), ITEM.replace("Anna", "Maria")
    docs = [(1, ITEM.replace("and Anna", "and so then Julia").replace("Anna", "Maria")),       # two values, moved apart
            (2, ITEM.replace("and Anna", "and Julia")),                                         # the second place alone
            (3, both + " " + ITEM.replace("Anna", "Julia")),                                    # two whole variants
            (4, both + " pad " * 50 + "the old market for 9 dollars and Julia gave 8 of them"),  # one stray line of another
            (5, first.replace("Anna", "Julia"))]
    got = {r.doc_id: r for r in decontaminate.leaks(frame(docs, SCHEMA), items).collect()}
    assert set(got) == {2, 3, 4} and got[3].n_matched == got[4].n_matched == 16 and got[3].reparameterised  # one window takes the name as it stands
    assert got[2].n_matched < got[2].n_windows and got[2].n_against == 0 and not got[2].reparameterised


def test_items_mostly_of_numbers_match_with_their_own_values(frame):
    items = frame([(1, "12.50 plus 35 equals 47.50"), (2, "4 kg 7 m 9 s weigh"), (3, "7 8")], "item_id long, text string")
    docs = [(1, "so 12.50 plus 35 equals 47.50 then"), (2, "so 12.50 plus 36 equals 48.50 then"), (3, "so 12.50 plus 35 equals 47.75"),
            (4, "it is 4 KG 7 m 9 s weigh 7 8")]
    got = decontaminate.leaks(frame(docs, SCHEMA), items).collect()
    assert {(r.doc_id, r.item_id, r.reparameterised) for r in got} == {(1, 1, False), (4, 2, False)}


def template_readings(text):
    """Words of a text with the kind of each, and the same with names as they stand; written out plainly."""
    out, end = [], None
    for m in re.finditer(r"[^\W_]+", text):
        w, gap = m.group(), text[end:m.start()] if end is not None else "."
        end = m.end()
        if w.isascii() and w.isdigit():
            if out and out[-1][1] == "n":
                out[-1] = (out[-1][0] + "." + w, "n")
                continue
            out.append((w, "n"))
        elif out and out[-1][1] == "n" and w.lower() in decontaminate.UNITS:
            out.append((w.lower(), "u"))
        else:
            name = len(w) > 1 and w[0].lower() != w[0] and w[1].lower() == w[1] and not re.search(r'[.!?:;\n"]', gap)
            out.append((w.lower(), "N" if name else ""))
    return out


def brute_windows(text, size=6, shorter=False):
    """Set of ``(at, template, slots)``; a slot is a value and its place."""
    w = template_readings(text or "")
    if shorter and decontaminate.LEAST <= len(w) < size:
        size = len(w)
    out = set()
    for at in range(len(w) - size + 1):
        part = w[at:at + size]
        heavy = 2 * sum(k in ("", "N") for _, k in part) < size
        for names in (True, False):
            kinds = ("n", "u", "N") if names else ("n", "u")
            if names and 2 * sum(k == "" for _, k in part) < size or not names and (heavy or not any(k == "N" for _, k in part)):
                continue
            out.add((at, tuple(f"<{k}>" if k in kinds else x for x, k in part), tuple((x, at + i) for i, (x, k) in enumerate(part) if k in kinds)))
        if heavy:
            out.add((at, tuple(x for x, _ in part), ()))
    return out


def brute_leak(doc, item):
    wanted, have = brute_windows(item, shorter=True), defaultdict(set)
    for size in {len(t) for _, t, _ in wanted}:
        for _, template, slots in brute_windows(doc, size):
            have[template].add(tuple(v for v, _ in slots))
    met = {(at, tuple((was, now, place) for (was, place), now in zip(slots, values)))
           for at, template, slots in wanted for values in have[template]}
    votes, every, windows_of = defaultdict(set), defaultdict(set), Counter()
    for _, pairs in met:
        for was, now, place in pairs:
            votes[was, now].add(place)
            every[was].add(place)
            windows_of[was, now] += 1
    bound = {}
    for was in every:
        now = max((n for w, n in votes if w == was), key=lambda n: (len(votes[was, n]), n == was, windows_of[was, n]))
        bound[was] = now if now == was or 2 * len(votes[was, now]) > len(every[was]) else None
    good = {at for at, pairs in met if all(bound[w] == n for w, n, _ in pairs)}
    against = {at for at, pairs in met if any(bound[w] is None for w, _, _ in pairs)} - good
    n = len({at for at, _, _ in wanted})
    return (n, len(good), len(against)) if n and len(good) - len(against) >= 0.5 * n else None


def test_template_leaks_match_brute_force(frame):
    import random
    rng = random.Random(3)
    items = [(1, ITEM), (2, "If Peter walks 5 km in 2 hours then how far does Peter walk in 7 hours at 5 km an hour?"),
             (3, "A train of 12 cars leaves Boston at 9 and meets Maria at 12 near Boston."), (4, "12 plus 7 plus 9 makes 28"), (5, "give the answer of Maria")]
    docs = []
    for i in range(150):
        words = rng.choice(items)[1].split(" ")
        for _ in range(rng.randrange(5)):
            k = rng.randrange(len(words))
            words[k] = rng.choice(["Julia", "Maria", "4", "12", "7", "km", "the"]) if rng.random() < 0.8 else words[k] + " then"
        docs.append((i, "It said " + " ".join(words) + " " + " ".join(rng.choice(items)[1].split(" ")[:rng.randrange(9)])))
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.n_against) for r in decontaminate.leaks(
        frame(docs, SCHEMA), frame(items, "item_id long, text string")).collect()}
    want = {(d, i): brute_leak(a, b) for d, a in docs for i, b in items}
    assert got == {k: v for k, v in want.items() if v} and 60 < len(got) < 150


def test_token_totals_match_brute_force(frame):
    tiktoken = pytest.importorskip("tiktoken")
    assert tiktoken
    data = open(token_counts.TOKENIZER, "rb").read()
    encode = token_counts._encoder("byte_bpe_50k", data, token_counts.PATTERN).encode_ordinary
    rows = [(1, "a", "en", "one two  three"), (2, "a", "en", "one\n\ntwo"), (3, "b", None, None), (4, None, "de", "  \n"), (5, "b", "fr", "é è"),
            (5, "b", "fr", "é è"), (None, "a", "en", "null id"), (6, "a", "en", "<|endoftext|> " * 2000)]
    docs = frame([(*r, 7) for r in rows], "doc_id long, source string, lang string, text string, n_tokens int")
    want = defaultdict(lambda: [0, 0])
    for _, source, lang, text in rows:
        n = len(encode(" ".join((text or "").split())))
        want[source, lang][0] += n > 0
        want[source, lang][1] += n
    got = {(r.source, r.lang): [r.n_docs, r.n_tokens] for r in token_counts.token_totals(docs).collect()}
    assert got == dict(want)
    assert token_counts.token_totals(docs.limit(0)).collect() == []


def test_batches_are_committed_once(spark, tmp_path):
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    schema = "source string, lang string, version string, op string, before long, after long"
    first = spark.createDataFrame([("a", "en", "v1", "insert", None, 10), ("a", "en", "v1", "insert", None, 5), (None, None, "v1", "insert", None, None)], schema)
    assert rollup.commit("b1", first) and not rollup.commit("b1", first)
    assert rollup.commit("b2", spark.createDataFrame([("a", "en", "v1", "revise", 10, 12), ("a", "en", "v1", "delete", 5, None)], schema))
    got = {(r.source, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert got == {("a", "v1"): (1, 12), (None, "v1"): (1, 0)}
    (tmp_path / "r" / "batch=b2" / "_COMMITTED").unlink()  # broke off before its end: does not count, is sent again, stored anew
    assert {r.source: r.n_tokens for r in rollup.totals().collect()} == {"a": 15, None: 0}
    assert rollup.commit("b2", spark.createDataFrame([("a", "en", "v1", "delete", 5, None)], schema))
    assert {r.source: r.n_tokens for r in rollup.totals().collect()} == {"a": 10, None: 0}
    assert token_counts.Rollup(spark, f"file://{tmp_path}/none").totals().collect() == []
    moved = spark.createDataFrame([("a", "en", "v1", "delete", 10, None), ("b", "en", "v1", "insert", None, 10)], schema)
    assert rollup.commit("move", moved)
    assert {r.source: (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {"a": (0, 0), "b": (1, 10), None: (1, 0)}
    with pytest.raises(Exception, match="unknown op"):
        rollup.commit("b3", spark.createDataFrame([("a", "en", "v1", "move", 1, 1)], schema))
    with pytest.raises(ValueError, match="batch name"):
        rollup.commit("../b4", first)


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    marks = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    bad, good = [s for s, t in marks if t], [s for s, t in marks if not t]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc >= 0.85


def test_toxicity_misspellings_and_odd_rows(spark, frame):
    words = [f"word{c}{d}" for c in "abcdefgh" for d in "xyz"]
    clean = [(i, " ".join(words[(i * k) % 24] for k in range(1, 30))) for i in range(120)]
    toxic = [(i, t + " you horrible idiot " + t) for i, t in ((i + 1000, t) for i, t in clean[:60])]
    docs = frame(clean + toxic, SCHEMA)
    labels = frame([(i, int(i >= 1000)) for i, _ in clean + toxic] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = [(1, "what a horribble idiott is this"), (2, "worda wordb wordax wordby"), (3, None), (4, ""), (4, ""), (None, "wordax"),
            (5, "wordax wordby " * 100_000 + " horrible idiot")]
    got = toxicity.score_toxicity(frame([(*r, "s") for r in rows], SCHEMA + ", score string"), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].predicted == 1 and by[5].predicted == 1
    assert by[2].predicted == by[4].predicted == by[None].predicted == 0
    assert toxicity.score_toxicity(frame([], SCHEMA), model).collect() == []
    none = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score_toxicity(docs, none).collect()} == {0}


def test_toxicity_learns_from_long_texts_and_one_text_of_a_repeated_id(spark, frame):
    clean = [(i, f"calm words number {i} " * 20) for i in range(60)]
    toxic = [(100 + i, "calm words " * 4000 + "vile scum " + "calm words " * 4000) for i in range(30)]
    hot = [(7, f"other text {i}") for i in range(500)] + [(100, "gentle")] * 500
    marks = frame([(i, int(i >= 100)) for i, _ in clean + toxic], "doc_id long, toxic int")
    model = toxicity.train(frame(clean + toxic + hot, SCHEMA), marks)
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(frame([(1, "vile scum"), (2, "calm words number 3"), (3, " \n ")], SCHEMA), model).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
