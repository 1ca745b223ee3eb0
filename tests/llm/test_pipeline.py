"""The pipeline: every stage against its operator or brute force on a whole small table."""

import corpus_pipeline as cp
import pytest

from test_decontaminate import brute, words
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of every stage and the last result, written and read as the driver does."""
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        out.append(docs)
        stage(spark, docs, SF).write.parquet(str(base / str(i)))
        docs = spark.read.parquet(str(base / str(i)))
    return [*out, docs]


def test_stage_names_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["language_id", "toxicity", "near_duplicates", "decontamination", "packing"]
    assert all(d.columns == steps[0].columns for d in steps[:-1])
    kept = [{r.doc_id for r in d.select("doc_id").collect()} for d in steps]
    assert all(b <= a for a, b in zip(kept, kept[1:]))


def test_language_stage_keeps_clean_documents(steps):
    assert steps[1].count() >= 0.99 * steps[0].count()


def test_toxicity_stage_follows_the_model(spark, steps):
    from panelcast.llm import toxicity as T

    machine = T.fit(steps[1], spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in T.predict(steps[1], machine).where("predicted = 0").collect()}
    assert {r.doc_id for r in steps[2].collect()} == clean


def test_near_duplicate_stage_against_brute_force(steps):
    rows = steps[2].select("doc_id", "text").collect()
    ids = [r.doc_id for r in rows]
    comp = brute_components(ids, [brute_fingerprint(r.text) for r in rows])
    assert {r.doc_id for r in steps[3].collect()} == set(comp)


def test_decontamination_stage_against_brute_force(spark, steps):
    docs = [(r.doc_id, r.text) for r in steps[3].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bags = {d: set(words(t)) for d, t in docs}
    near = [(d, t) for d, t in docs if any(len(bags[d] & set(words(x))) >= 0.7 * len(set(words(x))) for _, x in items)]
    bad = {d for d, _, _ in brute(near, items)}
    assert {r.doc_id for r in steps[4].collect()} == {d for d, _ in docs} - bad


def test_packing_stage_holds_every_id_once(steps):
    rows = steps[5].collect()
    for d in {r.doc_id for r in steps[4].select("doc_id").collect()}:
        own = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == d)
        assert own[0][0] == 0 and sum(n for _, n, _ in own) == own[0][2]
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:]))
    full = {}
    for r in rows:
        full[r.sequence_id] = full.get(r.sequence_id, 0) + r.length
    assert all(n == cp.WINDOW for s, n in full.items() if s != max(full))


def test_run_equals_the_stages(spark, steps):
    got = sorted(map(tuple, cp.run(spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    total = sum(r[2] for r in got)
    assert total == sum(r.length for r in steps[5].collect())
    assert {r[0] for r in got} == {r.doc_id for r in steps[4].collect()}


def test_stages_on_awkward_documents(spark, tmp_path):
    cols = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp string, part int"
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 0.5, "x", 1) for r in base]
    long = " ".join(r.text for r in base) * 3
    rows += [(None, None, None, None, None, None, None, None), (9001, "", "en", "s", 0, 0.1, "y", 2), (9002, base[0].text, None, None, 1, None, None, 3),
             (9003, long, "en", "s", len(long), 1.0, "z", 4), (None, base[1].text + " tail", "en", "s", 3, 1.0, "z", 4), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, cols)
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path / f"awkward-{i}")
        before, empty = docs, docs.limit(0)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(cp.STAGES) - 1:
            assert docs.columns == before.columns
            assert stage(spark, empty, SF).count() == 0
    assert docs.count() > 0
    assert cp.STAGES[-1][1](spark, before.limit(0), SF).count() == 0
