"""The ledger: a service is asked once for each request, across rows, actions, runs and failed tasks."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.operators import enrich, ledger
from chunkloom.plans import domains

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see the tests
FIELDS = [T.StructField("answer", T.StringType())]


def logging_client(log, poison="-", broken=()):
    """Answers in capitals, and writes down what it was asked; ends its task when ``poison`` comes up."""

    def make():
        def call(requests):
            if poison in requests and not os.path.exists(f"{log}.cured"):
                raise KeyboardInterrupt("the worker is lost")
            fd = os.open(log, os.O_WRONLY | os.O_APPEND | os.O_CREAT)
            os.write(fd, "".join(json.dumps(r) + "\n" for r in requests).encode())
            os.close(fd)
            if any(r in broken for r in requests):
                raise RuntimeError("no answer")
            return [(r or "").upper() for r in requests]

        return call

    return make


def asked(log):
    return [json.loads(line) for line in open(log)] if os.path.exists(log) else []


def read(reply, n):
    return [(r,) for r in reply]


def frame(spark, requests):
    return spark.createDataFrame([(i, r) for i, r in enumerate(requests)], "id int, request string").repartition(4)


def test_one_call_for_each_request(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "ledger")
    df = frame(spark, [f"text {i % 40}" for i in range(200)] + [None, ""])
    assert ledger.ask(df, path, logging_client(log), read, FIELDS, batch=3) == 41
    assert len(asked(log)) == 41 and {r or "" for r in asked(log)} == {f"text {i}" for i in range(40)} | {""}
    done = ledger.answered_rows(df, "request", path, FIELDS)
    for _ in range(2):  # two actions
        assert all(r["answer"] == (r["request"] or "").upper() and r["error"] is None for r in done.collect())
    assert done.count() == 202
    # A later run asks for what is new.
    assert ledger.ask(frame(spark, ["text 1", "more"]), path, logging_client(log), read, FIELDS) == 1
    assert len(asked(log)) == 42
    assert ledger.ask(df.limit(0), path, logging_client(log), read, FIELDS) == 0


def test_a_lost_task_does_not_pay_twice(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "ledger")
    df = frame(spark, [f"text {i}" for i in range(300)])
    with pytest.raises(Exception):
        ledger.ask(df, path, logging_client(log, poison="text 77"), read, FIELDS)
    before = len(asked(log))
    assert 0 < before < 300
    open(f"{log}.cured", "w").close()
    ledger.ask(df, path, logging_client(log, poison="text 77"), read, FIELDS)
    assert len(asked(log)) == 300 and len(set(asked(log))) == 300
    assert ledger.answered_rows(df, "request", path, FIELDS).where("answer = upper(request)").count() == 300


def test_errors_are_kept_and_asked_again(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "ledger")
    df = frame(spark, ["good", "bad"])
    ledger.ask(df, path, logging_client(log, broken=("bad",)), read, FIELDS)
    rows = {r["request"]: (r["answer"], r["error"]) for r in ledger.answered_rows(df, "request", path, FIELDS).collect()}
    assert rows == {"good": ("GOOD", None), "bad": (None, "no answer")}
    assert ledger.ask(df, path, logging_client(log), read, FIELDS) == 1
    assert ledger.answered_rows(df, "request", path, FIELDS).where("error is null").count() == 2
    assert sorted(asked(log)) == ["bad", "bad", "good"]


def test_services_with_a_ledger(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "ledger")

    def make():
        inner, embed = logging_client(log)(), enrich.HashingEmbedder(4)

        def call(texts):
            inner(texts)
            return embed(texts)

        return call

    chunks = spark.createDataFrame([(d, p, f"words of chunk {p % 3}", 1) for d in range(3) for p in range(5)], "doc_id int, pos long, text string, page_number int")
    done = enrich.embed_chunks(chunks, make, 4, 2, ledger=path)
    plain = enrich.embed_chunks(chunks, lambda: enrich.HashingEmbedder(4), 4, 2)
    assert done.columns == plain.columns
    assert sorted(map(str, done.collect())) == sorted(map(str, plain.collect()))
    assert done.where("error is null").count() == 15 and len(asked(log)) == 3
    # All results of a build are read from one set of answers.
    meta = spark.createDataFrame([(d, "course", "name", "1") for d in range(3)], "doc_id int, course string, name string, chapter_number string")
    fulltext, vectors, errors = domains.build_index("education", chunks, meta, make, dims=4, lo=1, hi=50, ledger=str(tmp_path / "other"))
    assert vectors.count() == vectors.select(F.size("values")).count() and errors.count() == 0
    assert len(asked(log)) <= 3 + vectors.count()
    before = len(asked(log))
    vectors.collect()
    assert len(asked(log)) == before
