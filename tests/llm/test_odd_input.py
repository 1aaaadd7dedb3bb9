"""Clashing columns in the pipeline's stages, empty tables, and workers that have no copy of the package."""

import os
import subprocess
import sys

import pytest

import corpus_pipeline
from chunkloom.llm import quality, suffix_dedup

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, k1 string, k2 string, spans string, quality_score double, size long"
FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_with_clashing_columns_and_odd_rows(spark, name, stage):
    if name == "quality":
        pytest.skip("covered by test_quality_score_replaces")
    texts = ["one two three four five six seven", None, "", "mail a.b@c.example.com now please do it", "x " * 500]
    rows = [(i, t, "en", None if i == 2 else f"s{i % 2}", len(t or ""), "a", "b", "c", 0.1, 7) for i, t in enumerate(texts)]
    rows += [rows[0], (None, "no id", None, "s1", 5, "a", "b", "c", 0.1, 7)]
    docs = spark.createDataFrame(rows, CLASHING)
    out = stage(spark, docs, FOLDER).collect()
    assert out and (name == "mixing" or set(out[0].asDict()) == set(docs.columns))
    assert stage(spark, docs.limit(0), FOLDER).collect() == []


def test_quality_score_replaces(spark):
    docs = spark.createDataFrame([(1, "some text here", 9.0), (1, None, 9.0), (None, "", 9.0)], "doc_id long, text string, quality_score double")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    scored = quality.score(docs, quality.train(docs, labels))
    assert scored.columns == ["doc_id", "text", "quality_score"]
    assert all(0 <= r["quality_score"] <= 1 for r in scored.collect())
    empty = docs.limit(0)
    assert quality.classify(empty, labels).collect() == []
    assert len(quality.classify(docs, labels.limit(0)).select("score").distinct().collect()) == 1


def test_empty_table_of_bytes(spark):
    assert suffix_dedup.remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string, k1 string")).collect() == []


def test_workers_without_the_package(tmp_path):
    """The entry is loaded from elsewhere, and workers find no chunkloom to import."""
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import importlib.util, sys\n"
        f"spec = importlib.util.spec_from_file_location('entry', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "entry = importlib.util.module_from_spec(spec)\n"
        "spec.loader.exec_module(entry)\n"
        "from chunkloom.session import get_spark\n"
        "spark = get_spark('elsewhere', 'local[2]', **{'spark.sql.shuffle.partitions': '2', 'spark.ui.enabled': 'false'})\n"
        f"queries = entry.queries()\n"
        "for name in ('op9_quality_classifier', 'op11_token_blocks', 'op12_whitening'):\n"
        f"    print('ROWS', name, queries[name](spark, {FOLDER!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.count("ROWS") == 3, done.stderr[-3000:]
