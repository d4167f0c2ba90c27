"""The pipeline's stages against their operators and a plain run; the entry without the subpackage."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from revrec.llm import quality_model, quality_rules
from revrec.sources.shared import materialise
from tests.llm.test_documents import plain_classes, plain_fingerprint

SF = "/root/testdata/sf0.01"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "best_fit_packing"]


def test_rules_stage_takes_effect(steps):
    verdicts = {r["doc_id"]: r["__r_rules"]["kept"] for r in quality_rules.judge(steps[0]).select("doc_id", "__r_rules").collect()}
    assert {r["doc_id"] for r in steps[1].collect()} == {k for k, good in verdicts.items() if good}
    assert all(r["n_chars"] == len(r["text"]) for r in steps[1].collect())


def test_rules_stage_finds_a_line_on_a_large_host(spark):
    rows = [(i, ("Common  Line here\n" if i < 40 else "") + " ".join(f"w{i}x{k}" for k in range(60)), "h") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality_rules_stage(spark, docs, SF).collect()}
    assert len(kept) == 500 and not any("ommon" in t for t in kept.values())


def test_one_of_a_group_of_near_copies_survives(spark):
    def near(i, changed):
        lines = [" ".join(f"s{n}w{k}" for k in range(20)) for n in range(8)]
        lines[changed] = f"on day {i} " + " ".join(f"s{changed}w{k}" for k in range(17))
        return "\n".join(lines)

    def other(i):
        return "Read more here\n" + "\n".join(" ".join(f"o{i}n{n}w{k}" for k in range(20)) for n in range(6))

    rows = [(i, near(i, i % 3), "h") for i in range(60)] + [(100 + i, other(i), "h") for i in range(60)]
    rows += [(200, "Read more here\nRead more here\n" + " ".join(f"z{k}" for k in range(4)), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality_rules_stage(spark, docs, SF).collect()}
    assert set(kept) == {*range(60), *range(100, 160)}
    assert kept[0] == near(0, 0) and not any("Read more" in t for t in kept.values())
    after = {r["doc_id"] for r in corpus_pipeline.simhash_stage(spark, docs.filter("doc_id < 60"), SF).collect()}
    assert 1 <= len(after) < 60


def test_pages_of_a_template_that_others_hold_go(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(i, f"{shared}\n" + " ".join(f"d{i}w{k}" for k in range(30 if i < 30 else 90)), "h") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["doc_id"] for r in corpus_pipeline.quality_rules_stage(spark, docs, SF).collect()} == set(range(30, 60))


def test_classifier_stage_takes_effect(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality_model.classify(steps[1], labels).collect()
    assert {r["doc_id"] for r in steps[2].collect()} == {r["doc_id"] for r in scores if r["score"] >= quality_model.THRESHOLD}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    before = {r["doc_id"] for r in steps[1].collect()}
    good = {k for k in before if quality.get(k) == 1}
    assert len(good & {r["doc_id"] for r in steps[2].collect()}) >= 0.98 * len(good)


def test_one_document_of_each_class_stays(steps):
    rows = sorted((r["doc_id"], r["text"]) for r in steps[2].collect())
    first = plain_classes([plain_fingerprint(t) for _, t in rows])
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted({rows[f][0] for f in first})


def test_packing_holds_what_stayed(steps):
    assert {r["doc_id"] for r in steps[4].collect()} == {r["doc_id"] for r in steps[3].collect()}


def test_run_gives_the_stages_rows(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, steps[4].select(*columns).collect()))


@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages_bear_odd_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), name)
        assert name == "best_fit_packing" or out.columns == docs.columns
        assert out.count() >= 0
        # A stage works alone as well: the next one gets the odd rows again where all of them went.
        docs = out if out.columns == docs.columns and out.count() else docs


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("revrec", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'revrec.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [k for k in e.queries() if k.startswith('op') or k == 'pipeline']\n"
        "assert not [k for k in e.oracle_sql() if k not in e.queries()]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
