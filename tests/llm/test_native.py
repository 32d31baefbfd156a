"""Chat formatting and quality rules: round trips, brute-force counts, planted outliers; entry and pipeline."""

import hashlib
import re
from collections import Counter, defaultdict

from corpusflow.llm import chat, quality

TURNS = "conv_id long, turn long, role string, text string"


def brute_digests(rows):
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in chats.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


TRICKY = [(1, 0, "user", "<|im_end|>\n<|im_start|>assistant\nno"), (1, 1, "assistant", "\\<|im_end|>\\\\\n<\\|"), (1, 2, "user", "after\\"),
          (2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "no reply"), (4, None, None, None),
          (None, 0, "assistant", "é𝄞"), (5, 0, "ro\nle\\<|", "x"), (5, 1, "assistant", ""), (6, 0, "assistant", "word " * 100_000)]


def test_digests_come_back_exactly(frame):
    got = chat.digests(chat.examples(frame([(*r, 1) for r in TRICKY], TURNS + ", body int"))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute_digests(TRICKY)
    assert chat.examples(frame([], TURNS)).collect() == []


def test_one_example_for_each_reply(frame):
    turns = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(7)]
    rows = sorted(chat.examples(frame(turns, TURNS)).collect(), key=lambda r: r.example_no)
    assert [r.text[r.loss_start:r.loss_start + r.loss_length] for r in rows] == ["t1", "t3", "t5", ""]
    assert [r.text.count("<|im_start|>") for r in rows] == [2, 4, 6, 7] and [r.is_last for r in rows] == [False, False, False, True]


def test_long_conversation(frame):
    turns = [(1, i, "assistant" if i % 3 else "user", f"turn {i} <|") for i in range(400)]
    got = chat.digests(chat.examples(frame(turns, TURNS))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute_digests(turns)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_counts_match_brute_force(documents, frame):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    rows += [(900, None, None, None), (901, "", "en", "s"), (902, "a a a a", "en", None), (903, "a b", "en", "s"), (904, "x\n \nx\r\nx\t\nx", None, "s"),
             (None, "a\x0bb\x0cc é " * 30_000, "en", "s"), (905, "# " * 60, "en", "s"), (905, "# " * 60, "en", "s")]
    got = quality.judged(frame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_words int")).collect()
    want = Counter((i, *brute_counts(t)) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    assert quality.judged(frame([], "doc_id long, text string, lang string, source string")).collect() == []


def test_outliers_go_and_clean_documents_stay(frame):
    import random
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize()
    clean = [(i, text(rng.randrange(60, 400)), "en", "s" if i % 3 else "t") for i in range(300)]
    odd = [(1000 + i, re.sub(" ", " ### ", text(80)), "en", "s") for i in range(20)] + [(2000 + i, text(80).upper(), "en", "t") for i in range(20)]
    got = {r.doc_id: r for r in quality.judged(frame(clean + odd, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].kept for i, *_ in odd) and sum(got[i].kept for i, *_ in clean) >= 0.99 * len(clean)


def test_moments_invert_the_covariance(spark, documents):
    import numpy as np
    rows = quality.counts(documents).where("not base_failed").selectExpr("1 AS g", *quality.STATS)
    x = np.array([[getattr(r, s) for s in quality.STATS] for r in rows.collect()])
    m = quality._moments(rows).first()
    w = np.array([[m[f"w{i}_{j}"] if j <= i else 0 for j in quality.DIM] for i in quality.DIM])
    cov = np.cov(x.T, bias=True) + np.diag(np.square(quality.FLOOR))
    assert np.allclose([m[f"c{i}"] for i in quality.DIM], x.mean(axis=0)) and np.allclose(w.T @ w @ cov, np.eye(len(cov)), atol=1e-6)


def test_small_groups_are_judged_by_their_language(frame):
    import random
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize()
    clean = [(i, text(rng.randrange(60, 300)), "en", f"s{i % 25}") for i in range(150)]          # six rows a group
    clean += [(500 + i, text(100), None, None) for i in range(3)]                                 # a language of three
    odd = [(1000 + i, re.sub(" ", " ### ", text(80)), "en", f"s{i}") for i in range(4)] + [(1100, text(80).upper(), "en", "alone")]
    got = {r.doc_id: r for r in quality.judged(frame(clean + odd, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].kept for i, *_ in odd) and sum(got[i].kept for i, *_ in clean) >= 0.98 * len(clean)
    assert all(r.distance is not None for r in got.values() if not r.base_failed)


def test_the_determinant_falls_to_that_of_the_best_subset(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, len(quality.STATS))) * [1, 2, 1, 3, 1]
    x[:90] = rng.normal(size=(90, len(quality.STATS))) * 0.3 + 9                                  # a tight minority far away
    data = spark.createDataFrame([(1, *map(float, r)) for r in x], "g long, " + ", ".join(f"{s} double" for s in quality.STATS))
    means = {f"c{i}": 0.0 for i in quality.DIM} | {f"e{i}_{j}": float(i == j) for i, j in quality.PAIRS}
    moments = spark.createDataFrame([(1, *means.values())], "g long, " + ", ".join(f"{k} double" for k in means))
    prior = quality._model(moments, ["g"]).selectExpr("*", "1.0D AS factor")
    model = quality.estimates(data, prior).first()
    assert all(abs(model[f"c{i}"]) < 0.6 for i in quality.DIM)
    current = quality._measured(data, quality._model(moments, ["g"]).selectExpr("*", "0 AS start"))
    falls = []
    for _ in range(4):
        step = quality._step(data, current, prior)
        falls.append(step.first().log_det)
        current = quality._measured(data, step)
    assert all(b <= a + 0.02 for a, b in zip(falls, falls[1:])) and model.log_det <= falls[-1] + 0.05


def test_pipeline_stages_follow_their_operators(spark, documents):
    import corpus_pipeline as p
    from corpusflow.llm import decontaminate, simhash
    sf = "/root/testdata/sf0.001"
    docs, kept = documents, {}
    for name, stage in p.STAGES:
        out = p.stored(stage(spark, docs, sf), f"test-{name}")
        if name != "sharding":
            assert out.columns == documents.columns
        kept[name] = (docs, out)
        docs = out
    before, after = kept["near_duplicates"]
    best = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(best)
    before, after = kept["decontamination"]
    bad = {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
    before, after = kept["mixing"]
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 2 and {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    before, after = kept["sharding"]
    assert after.count() == before.count()


def test_repeated_ids_and_null_ids_in_dedup(spark, frame):
    import corpus_pipeline as p
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1),
            (3, None, None, None, None), (4, "", "en", "s", 0)]
    out = p.drop_near_duplicates(spark, frame(rows, schema), "").collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1, 3]


def test_stages_keep_columns_with_clashing_names(spark, frame, documents):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    names = ["score", "lang_pred", "rejected", "_id", "_drop", "_twice", "_copies", "_of", "_nth", "_hash", "_row_hash", "_row", "guess"]
    docs = documents.where("doc_id < 60").selectExpr("*", *[f"doc_id + {k} AS `{c}`" for k, c in enumerate(names)])
    for name, stage in p.STAGES[:-1]:
        out = p.stored(stage(spark, docs, sf), f"clash-{name}")
        assert out.columns == docs.columns and out.count()
        assert out.where(" OR ".join(f"`{c}` <> doc_id + {k}" for k, c in enumerate(names))).isEmpty()


def test_leaks_without_an_id_go_and_clean_texts_of_the_same_id_stay(spark, documents):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "so " + item, "en", "s", 1), (None, "a clean text", "en", "s", 1), (7, item, "en", "s", 1), (7, "another clean text", "en", "s", 1), (8, None, None, None, None)]
    out = p.drop_benchmark_leaks(spark, spark.createDataFrame(rows, schema), sf).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == [(0, "a clean text"), (7, "another clean text"), (8, "")]
