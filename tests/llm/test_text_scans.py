"""License scans, language identification and toxicity."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import language_id as L
from panelcast.llm import license_scan as S
from panelcast.llm import toxicity as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_license(text):
    words = WORD.findall((text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in S.BASE_PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_places_against_brute_force(spark):
    texts = [None, "", "CC-BY cc by CC  by.", "acc by cc bye", "General PUBLIC\nlicense all rights reserved É cc\x00by", "cc by " * 50_000,
             "general public license general public license", "İ cc by", "ccby", "all rights  reserved", "\x7f cc by \x80"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, "cc by", "z")], "doc_id bigint, text string, labels string")
    for r in S.license_scan(df).collect():
        t = "cc by" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_license(t)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert S.license_scan(df.limit(0)).count() == 0


def test_expressions():
    assert S.to_postfix("MIT OR Apache-2.0 AND GPL-2.0 WITH X-exception") == ["mit", "apache-2.0", "gpl-2.0", "x-exception", "with", "and", "or"]
    assert S.alternatives("(MIT OR ISC) AND Zlib */") == [frozenset({"mit", "zlib"}), frozenset({"isc", "zlib"})]
    assert S.alternatives("MIT OR (MIT AND ISC)") == [frozenset({"mit"})]
    assert S.alternatives("GPL-2.0 with Classpath-exception-2.0") == [frozenset({"gpl-2.0-with-classpath-exception-2.0"})]
    for bad in ("", "AND MIT", "MIT OR", "(MIT", "MIT)", "MIT (ISC)", "(MIT OR ISC) WITH e"):
        with pytest.raises(S.ExpressionError):
            S.alternatives(bad)
    got = S.Scanner()("x\n# SPDX-License-Identifier: MIT or Apache-2.0\n# SPDX-License-Identifier: AND\nApache License")
    assert got["labels"] == "apache,apache-2.0,mit" and got["score"] == 1.0 and got["expressions"] == ["mit or apache-2.0"]


def test_language_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    from panelcast.llm.queries import op5_language_id

    got = op5_language_id(spark, "/root/testdata/sf0.1").join(docs, "doc_id")
    acc = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert acc[0] > 0.99 and 0 <= acc[1] <= acc[2] <= 1
    assert {r.doc_id for r in got.where("held_out").select("doc_id").collect()} == {
        r.doc_id for r in docs.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}


def test_language_edge_cases(spark):
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.fit(small.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("lang"))), per_language=50)
    one = small.where("lang = 'fr'").first().text
    rows = [(1, None), (2, ""), (3, "123 !! \n"), (None, one), (5, one), (5, one), (6, "漢字かな交じり文" * 50), (7, "qzx wvk zzkj xqq " * 50), (8, one * 300)]
    df = spark.createDataFrame([(i, t, "fr", 2.0) for i, t in rows], "doc_id bigint, text string, lang_pred string, score double")
    got = sorted(((r.doc_id or 0, r.lang_pred, r.rejected) for r in L.predict(df, model).collect()))
    assert got == [(0, "fr", False), (1, "und", True), (2, "und", True), (3, "und", True), (5, "fr", False), (5, "fr", False),
                   got[6], got[7], (8, "fr", False)]
    assert got[6][2] and got[7][2]
    kept = L.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 5, 8]
    assert L.keep_identified(df.limit(0), model).count() == 0
    none = L.fit(small.limit(0))
    assert [r.lang_pred for r in L.predict(df, none).collect()] == ["und"] * len(rows)
    assert L.keep_identified(df, none).count() == 6


def test_grams_do_not_depend_on_the_step():
    text = "Ab  c, dé fgh\nijk " * 50
    a = L.grams(text)
    for step in (1, 2, 7, 16, 1000):
        b = L.grams(text, step=step)
        assert b[1] == a[1] and (a[0] == b[0]).all()


def brute_kernel(a, b):
    """The subsequence kernel by enumerating all triples."""

    def phi(w):
        w, out = f"\x02{w}\x03", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i < T.SPAN:
                        out.setdefault(w[i] + w[j] + w[k], []).append(T.DECAY ** (k - i + 1))
        norm = sum(x * x for v in out.values() for x in v) ** 0.5
        return {u: sum(v) / norm for u, v in out.items()}

    x, y = phi(a), phi(b)
    return sum(v * y.get(u, 0.0) for u, v in x.items())


def test_kernel_against_enumeration():
    words = ["idiot", "idxiot", "scum", "thereof", "aa", "été", "anan"]
    k = T.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert k[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-4)
    assert k[0, 1] > 0.4 > k[0, 3]


def test_spelled_out_words():
    assert "idiot" in T.words_of("you i d i o t !") and "idiot" in T.words_of("I.D.I.O.T.") and "abc" not in T.words_of("a b\xa0cd")
    assert T.words_of(None) == [] and T.words_of(" \n") == []


def test_toxicity_held_out(spark):
    from panelcast.llm.queries import op6_toxicity

    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = op6_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert toxic.predicted.mean() > 0.75 and clean.predicted.mean() < 0.03
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_toxicity_finds_gapped_insults_and_leaves_clean_words(spark):
    rng = np.random.default_rng(1)
    syl = ["an", "the", "or", "in", "er", "on", "at", "re", "st", "nd", "ha", "ing"]
    sentence = lambda: " ".join("".join(rng.choice(syl, rng.integers(1, 4))) for _ in range(30))
    bad = ["stupid", "moron", "pathetic", "scumbag"]
    rows = [(i, sentence() + (f" {bad[i % 4]} {bad[(i + 1) % 4]} " if i % 3 == 0 else " ") + sentence(), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(9999, 1), (0, None), (None, 1)], "doc_id bigint, toxic int")
    machine = T.fit(docs, labels)
    probe = [sentence() + x + sentence() for x in (" stupid ", " st.u.pid ", " stuppid ", " m o r o n ", " moroon ", " PATHETIC! ", " ")] + [None, ""]
    df = spark.createDataFrame([(i, t, 3.0) for i, t in enumerate(probe)], "doc_id bigint, text string, score double")
    got = [r.predicted for r in sorted(T.predict(df, machine).collect(), key=lambda r: r.doc_id)]
    assert got == [1, 1, 1, 1, 1, 1, 0, 0, 0]
    assert sorted(r.doc_id for r in T.keep_clean(df, machine).collect()) == [6, 7, 8]
    none = T.fit(docs, labels.limit(0))
    assert T.predict(df, none).agg(F.max("score")).first()[0] < 0.01 and T.predict(df.limit(0), none).count() == 0


def test_an_insult_of_ordinary_words_is_learned_from_sentences(spark):
    """Every word of the insult stands in a third of the clean texts too, but there never in one sentence."""
    rng = np.random.default_rng(2)
    syl = ["an", "the", "or", "in", "er", "on", "at", "re", "st", "nd", "ha", "ing"]
    sentence = lambda extra=(): " ".join(rng.permutation([*("".join(rng.choice(syl, rng.integers(1, 4))) for _ in range(8)), *extra])) + "."
    insult = ["nobody", "wants", "your", "kind", "around"]
    apart = lambda: " ".join(sentence([w]) for w in rng.permutation(insult)[:2])
    text = lambda toxic: " ".join([sentence(), sentence(insult if toxic else ()), sentence(), apart() if not toxic else "", sentence()])
    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    machine = T.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int"))
    assert machine.margins(insult).real.max() < 0  # none of its words is toxic by itself
    probe = [(i, text(i < 100)) for i in range(200)]
    probe += [(200 + i, sentence(["nobodyy", "wants", "your", "kiind", "arround"])) for i in range(20)]  # inserted characters
    probe += [(300, None), (301, ""), (302, " .\n")]
    got = {r.doc_id: r for r in T.predict(spark.createDataFrame(probe, "doc_id bigint, text string"), machine).collect()}
    assert sum(got[i].predicted for i in range(100)) >= 95 and sum(got[i].predicted for i in range(100, 200)) <= 3
    assert sum(got[i].predicted for i in range(200, 220)) >= 15
    assert got[300].predicted == got[301].predicted == got[302].predicted == 0
    assert max(got[i].score for i in (300, 301, 302)) <= min(got[i].score for i in range(100))


def test_sentences_are_cut_at_stops_and_after_their_most_words():
    texts = ["a b. c d! e", "", "w " * 60 + "x", "y? z"]
    code, words, first, _, ends = T.tokens(texts)
    start, of = T.sentence_starts(code, first, ends)
    got = [[words[c] for c in code[a:b]] for a, b in zip(start, [*start[1:], len(code)])]
    assert got == [["a", "b"], ["c", "d"], ["e"], [""], ["w"] * 24, ["w"] * 24, ["w"] * 12 + ["x"], ["y"], ["z"]]
    assert of.tolist() == [0, 0, 0, 1, 2, 2, 2, 3, 3]


def test_a_license_expression_with_many_alternatives_keeps_its_labels():
    from panelcast.llm.license_scan import Scanner

    names = [(f"mit-{i}", f"bsd-{i}") for i in range(9)]
    tag = "SPDX-License-Identifier: " + " AND ".join(f"({a} OR {b})" for a, b in names)
    got = Scanner()(tag)
    assert got["score"] == 1.0 and set(got["labels"].split(",")) >= {x for pair in names for x in pair}
    assert len(got["expressions"]) == 1 and got["expressions"][0].split()[:3] == ["mit-0", "bsd-0", "or"]


def test_long_expressions():
    """Ten thousand alternatives, and wide ones that share a licence: no step compares all with all."""
    import time

    t = time.process_time()
    assert len(S.alternatives(" or ".join(f"l{i}" for i in range(10_000)))) == 10_000
    assert len(S.alternatives(" or ".join(f"(a and l{i})" for i in range(5_000)) + " or l7")) == 5_000
    assert S.alternatives("a or b and a or a") == [frozenset("a")]
    assert time.process_time() - t < 10


def test_the_fitting_sample_is_bounded_with_repeated_and_null_ids(spark):
    rows = [(None, f"text {i}", "en") for i in range(300)] + [(7, f"word {i}", "en") for i in range(300)] + [(i, f"mot {i}", "fr") for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string").repartition(5)
    got = {r["label"]: r["count"] for r in L.sample_labelled(df, "id", "label", 40).groupBy("label").count().collect()}
    assert got == {"en": 40, "fr": 5}
    model = L.fit(df.withColumnRenamed("label", "lang").withColumnRenamed("id", "doc_id"), per_language=40)
    assert set(L.predict(df.withColumnRenamed("id", "doc_id"), model).select("lang_pred").distinct().toPandas().lang_pred) <= {"en", "fr", "und"}
