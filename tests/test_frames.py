"""What a Python worker holds at a time, and tables that are folders of files."""

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from chunkloom.catalog import states
from chunkloom.operators import enrich
from chunkloom.sources import markup


class Mapped:
    """Stands for a DataFrame and runs its map here, to see the single frames."""

    def __init__(self, frames, schema):
        self.frames, self.schema = frames, T.StructType.fromDDL(schema)

    def select(self, *names):
        return Mapped([f[list(names)] for f in self.frames], ", ".join(f"{c} {self.schema[c].dataType.simpleString()}" for c in names))

    def mapInPandas(self, run, schema):
        return list(run(iter(self.frames)))


@pytest.mark.parametrize("batch", [1, 3])
def test_replies_leave_python_as_they_come(spark, monkeypatch, batch):
    monkeypatch.setattr(enrich, "FRAME_BYTES", 100)
    monkeypatch.setattr(enrich, "FRAME_ROWS", 10)
    texts = ["x" * 40] * 10 + [None, ""] * 10 + ["y" * 500] * 2
    docs = Mapped([pd.DataFrame({"id": range(len(texts)), "text": texts}), pd.DataFrame({"id": [], "text": []})], "id long, text string")
    fields = [T.StructField("n", T.IntegerType())]
    frames = enrich.call_service(docs, "text", lambda: lambda asked: [len(t or "") for t in asked], lambda r, n: [(x,) for x in r], fields, batch)
    assert max(f["text"].iloc[:-batch].map(lambda t: len(t or "")).sum() for f in frames) < 100
    assert max(map(len, frames)) < 10 + batch
    whole = pd.concat(frames)
    assert whole["id"].tolist() == list(range(len(texts))) and whole["n"].tolist() == [len(t or "") for t in texts]
    assert whole["error"].isna().all()


def test_elements_leave_python_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(markup, "FRAME_CHARS", 50)
    html = ["<p>one</p><p>two</p>"] * 9 + [None, ""]
    frames = markup.html_to_elements(Mapped([pd.DataFrame({"doc_id": range(11), "html": html})], "doc_id long, html string"))
    assert max(f["doc_id"].nunique() for f in frames) == 3
    whole = pd.concat(frames)
    assert list(zip(whole["doc_id"], whole["pos"], whole["text"])) == [(i, p, t) for i in range(9) for p, t in ((0, "one"), (1, "two"))]


@pytest.mark.parametrize("parts", [0, 3])
def test_a_streamed_table_is_a_file_or_a_folder(spark, tmp_path, parts):
    docs = spark.range(30).selectExpr("id AS doc_id", "repeat('a\n', cast(id AS int)) AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    if parts:
        docs.repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    else:
        pq.write_table(docs.toArrow(), f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, states.stream_new_documents(spark, str(tmp_path)).collect())) == [(i, i + 1) for i in range(30)]
