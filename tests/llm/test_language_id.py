"""Language identification: held-out accuracy, rejection, and odd rows."""

from corpusflow.llm import language_id
from corpusflow.llm.common import fold_of

SCHEMA = "doc_id long, text string"


def test_held_out_accuracy_and_folds(documents):
    import zlib
    got = {r.doc_id: r for r in language_id.languages(documents).collect()}
    rows = documents.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_teach_nothing(documents):
    from pyspark.sql import functions as F
    held = fold_of("doc_id") == 2
    spoiled = documents.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in language_id.train(spoiled, held_out=held).names


def test_odd_rows(documents, frame):
    model = language_id.train(documents)
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the and of with that from"), (4, "the and of with that from"),
            (None, "der die und nicht ein"), (5, "中文字符 完全不同"), (6, "the thing and other " * 150_000)]
    data = frame([(*r, "x", "y") for r in rows], SCHEMA + ", score string, guess string")
    got = language_id.identify(data, model).collect()
    assert len(got) == len(rows) and got[0].guess == "y"
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[4].lang_pred == "en" and by[6].lang_pred == "en" and by[None].lang_pred == "de" and not by[6].rejected
    assert by[5].rejected  # no learned n-gram: all languages alike


def test_empty_tables_and_no_labels(documents, frame):
    none = language_id.train(frame([], "doc_id long, text string, lang string"))
    assert none.names == []
    got = language_id.identify(documents.limit(3), none).collect()
    assert all(r.rejected for r in got)
    assert language_id.identify(frame([], SCHEMA), none).collect() == []


def test_long_text_is_read_whole(documents, frame):
    model = language_id.train(documents)
    text = "der die und nicht ein ist zu " * 30_000 + "the and of that with from was " * 90_000
    assert language_id.identify(frame([(1, text)], SCHEMA), model).first().lang_pred == "en"


def test_a_repeated_id_is_no_reason_to_be_drawn_whole(frame, monkeypatch):
    seen = []
    real = language_id.learn
    monkeypatch.setattr(language_id, "learn", lambda labels, bags, names: seen.append(len(bags)) or real(labels, bags, names, epochs=1))
    rows = [(None, f"text number {i} of the same null id", "en") for i in range(3000)] + [(5, "one text on many rows", "de")] * 3000
    language_id.train(frame(rows, SCHEMA + ", lang string"), most=200)
    assert 40 <= seen[0] <= 200
