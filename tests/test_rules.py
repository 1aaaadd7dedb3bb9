"""Small truth tables: filters, scalar functions, checks, services, states and writers."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chunkloom import schemas
from chunkloom.functions import dates, paths, status, values
from chunkloom.functions import text as tx
from chunkloom.functions.tokens import token_estimate
from chunkloom.operators import enrich, filters, joins, tables
from chunkloom.plans import domains
from chunkloom.sinks import records, writers
from chunkloom.sources import markup, readers
from chunkloom.streaming import documents, jobs


def values_of(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_empty_chunks(spark):
    chunks = spark.createDataFrame(
        [(0, 0, " kept "), (0, 1, ""), (0, 2, "   "), (0, 3, None), (0, 4, "　\xa0")], "doc_id int, pos int, text string"
    )
    assert [r.text for r in filters.drop_empty_chunks(chunks).collect()] == [" kept "]
    counts = filters.dropped_chunk_counts(chunks).first()
    assert (counts.n_original, counts.n_kept, counts.n_dropped) == (5, 1, 4)


@pytest.mark.parametrize("kind, rows", [
    (status.retryable_parse, [
        ("other", "EMPTY_RESULT", False), ("other", "RAW_STORAGE_PATH_MISMATCH: path", False),
        ("other", "temporary parser outage", True), ("timeout", "EMPTY_RESULT", True), ("network", "x", True),
        ("parser", "parser http error 429: x", True), ("parser", "parser http error 503: x", True),
        ("parser", "parser http error 404: x", False), ("parser", "odd", False),
        ("parser", "parser http error zz: x", False), ("embedding", "embedding http error 400: x", False),
        ("embedding", "embedding http error 500: x", True), ("embedding", "embedding request failed: x", True),
        ("embedding", "embedding response missing data list", False),
        ("embedding", "EMBEDDING_DIMENSION_TOO_SMALL: got 1, need 2", False),
    ]),
    (status.retryable_ready, [
        ("other", "LOCAL_MANIFEST_MISSING", False), ("other", "S3_MANIFEST_MISMATCH: document_id", False),
        ("other", "S3_ARTIFACT_MISMATCH: chunks.pkl sha256", False), ("other", "S3_ARTIFACT_MISMATCH: a size", True),
        ("other", "S3_NOT_READY_AFTER_TIMEOUT: not synced", True), ("timeout", "LOCAL_MANIFEST_MISSING", True),
    ]),
])
def test_retry_rules(spark, kind, rows):
    got = values_of(spark, rows, "c string, m string, want boolean", kind(F.col("c"), F.col("m")), "want")
    assert all(a == b for a, b in got), [r for r, g in zip(rows, got) if g[0] != g[1]]


def test_backoff(spark):
    got = values_of(spark, [(0,), (1,), (2,), (5,)], "n int", status.backoff(F.col("n")))
    assert [g[0] for g in got] == [1.0, 1.0, 2.0, 16.0]


def test_paths(spark):
    from urllib.parse import quote, unquote

    keys = ["10.1/a b", "x+y*~'()", "é/ü?&=", "100%", "a%2Fb", "%zz"]
    rows = [(k,) for k in keys]
    encoded = values_of(spark, rows, "k string", paths.encode_key(F.col("k")))
    assert [e[0] for e in encoded] == [quote(quote(k)) for k in keys]
    decoded = values_of(spark, rows, "k string", paths.decode_key(F.col("k")))
    assert [d[0] for d in decoded] == [unquote(unquote(k)) for k in keys]
    stored = paths.collection_storage_path(F.col("k"))
    got = values_of(spark, [("/course/demo",), ("a//b/",), ("/",), ("a/../b",)], "k string", stored["path"], stored["error"].isNull())
    assert got == [("course/demo", True), ("a/b", True), (None, False), (None, False)]
    assert values_of(spark, [("course/demo_pickle",)], "k string", paths.processed_storage_path(F.col("k"))) == [("course_pickle/demo_pickle",)]
    uris = ["a/b", "file:///x%20y", "nas://kb/raw/z", "nas://folder/z", "nas://folder", "nas:///raw/z", "http://h/x"]
    raw = paths.resolve_raw_uri(F.col("k"), "/r")
    got = values_of(spark, [(u,) for u in uris], "k string", raw["path"])
    assert [g[0] for g in got] == ["a/b", "/x y", "/r/z", "/r/folder/z", "/r/folder", "/r/z", None]


def test_dates(spark):
    rows = [("2024-05-06",), ("2024-05",), ("2024",), ("20240506",), ("2024-05-06T01:02:03",), ("n/a",), (None,)]
    got = values_of(spark, rows, "d string", dates.to_unix_or_now(F.col("d"), 7))
    assert [g[0] for g in got] == [1714953600, 1714521600, 1704067200, 1714953600, 1714957323, 7, 7]


def test_canonical_json(spark):
    got = values_of(spark, [('{"b": 2, "a": "清华"}',), ("oops",)], "j string", values.canonical_json(F.col("j")))
    assert got == [('{"a": "清华", "b": 2}',), (None,)]


def test_json_values(spark):
    rows = [('{"result": 0, "Result": [1]}',), ('{"result": "0"}',), ('{"result": {}}',), ('{"Result": false}',)]
    got = values_of(spark, rows, "j string", values.json_first(F.col("j"), "result", "Result"))
    assert [g[0] for g in got] == ["[1]", "0", None, None]
    items = [('{"text": "a"}',), ('{"text": null}',), ('{"p": 1}',), ('{"text": {"b": 1, "a": [2]}}',), ("[1]",), ("x",)]
    out = values.chunk_text(F.col("j"))
    got = values_of(spark, items, "j string", out["text"], out["error"])
    bad = (None, "EMBEDDING_CHUNK_NOT_OBJECT")
    assert got == [("a", None), ("", None), ("", None), ('{"a": [2], "b": 1}', None), bad, bad]


def test_vectors(spark):
    rows = [([3.0, 4.0, 9.0],), ([0.0, 0.0, 1.0],), ([1.0],)]
    got = values_of(spark, rows, "v array<double>", values.l2_truncate(F.col("v"), 2), values.l2_error(F.col("v"), 2))
    assert got == [([0.6, 0.8], None), ([0.0, 0.0], None), (None, "EMBEDDING_DIMENSION_TOO_SMALL: got 1, need 2")]


def test_clean_text(spark):
    rows = [("The big  brown\nfox\tjumps.\n\nNext\n para ",), ("  ",)]
    got = values_of(spark, rows, "t string", tx.clean_text(F.col("t")))
    assert got == [("The big brown fox jumps.\n\nNext para",), ("  ",)]


def test_filter_spec():
    with pytest.raises(ValueError):
        filters.filter_spec({"$any": []})


def test_find_tables():
    html = 'x<table class="a  b" nowrap><tr><td>1 &lt; 2<br>y<table><tr><td>in</td></tr></table></tr></table>z<TABLE><td>open'
    assert tables.find_tables(html) == [
        '<table class="a  b" nowrap=""><tr><td>1 &lt; 2<br/>y<table><tr><td>in</td></tr></table></td></tr></table>',
        "<table><tr><td>in</td></tr></table>",
        "<table><td>open</td></table>",
    ]
    assert tables.find_tables("no markup < here") == []


def row_by_row(html, limit):
    """Independent split: every row and part is written by pandas from the parsed frame."""
    frame = tables.table_frame(*tables.table_lines(html))
    parts, part, used = [], pd.DataFrame(), 0
    for _, row in frame.iterrows():
        one = row.to_frame().T
        size = token_estimate.text(one.to_html(index=False, border=0))
        if used + size > limit and not part.empty:
            parts.append(part.to_html(index=False, border=0))
            part, used = pd.DataFrame(), 0
        part = pd.concat([part, one])
        used += size
    return parts + ([part.to_html(index=False, border=0)] if not part.empty else [])


def test_split_table():
    head = "<thead><tr><th>name</th><th>amount</th></tr></thead>"
    typed = f"<table>{head}" + "".join(f"<tr><td>row &amp; {i}</td><td>{i}.50</td></tr>" for i in range(9)) + "</table>"
    text = "<table>" + "".join(f"<tr><td>r {i}</td><td>a\tb &lt; {i}</td></tr>" for i in range(9)) + "</table>"
    spans = '<table><tr><th>a</th><th>b</th></tr><tr><td rowspan="2">x</td><td>1,000</td></tr><tr><td></td></tr></table>'
    rng = random.Random(5)
    cells = ["word", "two words", "1,234", "5", "1e5", "True", "nan", "", "a,b", "x" * 60, "&amp;", "-", "N/A", "inf"]
    mixed = [
        "<table>" + "".join("<tr>" + "".join(f"<td>{rng.choice(cells)}</td>" for _ in range(2)) + "</tr>" for _ in range(5)) + "</table>"
        for _ in range(150)
    ]
    mixed += [
        f"<table><tr><th>{rng.choice(cells)}</th><th>{rng.choice(cells)}</th></tr>"
        + "".join(f"<tr><td>{rng.choice(cells)}</td><td>w {rng.choice(cells)}</td></tr>" for _ in range(3)) + "</table>"
        for _ in range(50)
    ]
    for html in (typed, text, spans, *mixed):
        for limit in (1, 60, 150, 10_000):
            assert tables.split_table(html, limit, token_estimate.text) == row_by_row(html, limit)
    frame = tables.table_frame(*tables.table_lines(spans))
    assert list(frame.columns) == ["a", "b"] and list(frame["a"]) == ["x", "x"] and frame["b"][0] == 1000
    assert tables.cut_to_size("<table></table>", 0, token_estimate.text) == []


def test_page_elements():
    html = (
        "<html><head><title>t</title></head><body><nav><ul><li>menu</li></ul></nav><h1>Big <b>one</b></h1>"
        "<p>first<p>second &amp; more<script>x()</script><table><tr><td>1</td><td>2</td></tr></table>"
        "<ul><li>a<li>b</ul><div>loose</div><footer>end</footer></body></html>"
    )
    found = markup.page_elements(html)
    assert [f[:2] for f in found] == [
        ("Header", "menu"), ("Title", "Big one"), ("NarrativeText", "first"), ("NarrativeText", "second & more"),
        ("Table", "12"), ("ListItem", "a"), ("ListItem", "b"), ("Text", "loose"), ("Footer", "end"),
    ]
    assert found[4][2] == "<table><tr><td>1</td><td>2</td></tr></table>"


def test_substring_join_paths_agree(spark):
    items = spark.createDataFrame([(0, "the quick brown fox"), (1, "nothing"), (2, "xab"), (3, None), (4, "a quick brown dog runs")], "i int, t string")
    long = "pad " * 1500 + "needle in a haystack" + " pad" * 1500
    items = items.unionByName(spark.createDataFrame([(5, long), (6, "pad " * 3000)], "i int, t string"))
    keys = spark.createDataFrame([("quick brown fox",), ("needle in a hay",), ("ab",), ("quick brown dog runs fast",), ("",)], "k string")
    for limit in (0, 10**6):
        got = joins.semi_by_substring(items, keys, "i", "t", max_key_bytes=limit).collect()
        assert {r.i for r in got} == {0, 2, 5}


def test_substring_join_paths_agree_on_repeated_and_null_ids(spark):
    rows = [(1, "has needle"), (1, "has none"), (None, "needle too"), (None, "nothing"), (2, "needle"), (2, "needle"), (3, None)]
    items = spark.createDataFrame(rows, "i int, t string")
    keys = spark.createDataFrame([("needle",)], "k string")
    want = [(1, "has needle"), (2, "needle"), (2, "needle"), (None, "needle too")]
    for limit in (0, 10**6):
        got = joins.semi_by_substring(items, keys, "i", "t", max_key_bytes=limit)
        assert got.columns == ["i", "t"] and sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_services_report_errors(spark):
    chunks = spark.createDataFrame([(i, f"t{i}\n\nx") for i in range(7)], "i int, text string").coalesce(1)

    def client(reply):
        return lambda: lambda texts: reply(texts)

    good = enrich.embed_chunks(chunks, lambda: enrich.HashingEmbedder(8), 4, batch=3).collect()
    assert len(good) == 7 and all(len(r.embedding) == 4 and r.error is None for r in good)
    assert good[0].text == "t0\n\nx"
    cases = [
        (lambda t: {}, "embedding response missing data list"),
        (lambda t: [{"embedding": [1]}], "embedding response count mismatch: got 1, expected 7"),
        (lambda t: [{"embedding": None}] * 7, "embedding response item missing embedding list"),
        (lambda t: [{"embedding": [1]}] * 7, "EMBEDDING_DIMENSION_TOO_SMALL: got 1, need 2"),
        (lambda t: 1 / 0, "division by zero"),
    ]
    for reply, want in cases:
        got = enrich.embed_chunks(chunks, client(reply), 2, batch=7).collect()
        assert {r.error for r in got} == {want} and all(r.embedding is None for r in got)


def test_parser_contract(spark):
    docs = spark.createDataFrame([(0, bytearray(b"x"))], "i int, content binary")
    reply = {"result": [{"text": " "}, {"text": "a", "page_number": 2}, {}], "txt": "a"}
    row = enrich.parse_documents(docs, lambda: lambda _: reply).first()
    assert (row.original_chunk_count, row.dropped_empty_text_count, row.txt) == (3, 2, "a")
    assert [(c.text, c.page_number) for c in row.chunks] == [("a", 2)]
    for broken, want in [
        ({}, "parser response missing result"), ({"result": {}}, "parser result must be a list"),
        ({"result": []}, "parser response missing txt"),
        ({"result": [], "txt": 1}, "parser txt must be a string when present"),
    ]:
        assert enrich.parse_documents(docs, lambda b=broken: lambda _: b).first().error == want


def test_retry_helper():
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise ValueError("busy")
        return "ok"

    assert enrich.with_retry(flaky, 3, 0)(1) == "ok" and len(calls) == 3
    calls.clear()
    with pytest.raises(ValueError):
        enrich.with_retry(flaky, 2, 0)(1)


def test_manifest_round_trip(spark):
    entries = spark.createDataFrame(
        [("d", "chunks_jsonl", "u.jsonl", 10, "aa"), ("d", "chunks_pkl", "u.pkl", 20, "bb")],
        "doc_id string, role string, name string, size long, sha256 string",
    )
    docs = spark.createDataFrame([("d", 3)], "doc_id string, document_version int")
    manifest = records.build_manifest(entries, docs, "p", "1", {"model": "m", "dimensions": 2})
    row = manifest.first()
    assert row.artifacts == {"chunks_jsonl": "u.jsonl", "chunks_pkl": "u.pkl"}
    assert row.size_bytes == {"chunks_jsonl": 10, "chunks_pkl": 20} and row.embedding.dimensions == 2
    shown = json.loads(records.manifest_json(manifest).first().manifest)
    assert list(shown) == sorted(shown)
    back = {tuple(r) for r in records.manifest_entries(manifest).collect()}
    assert back == {tuple(r) for r in entries.collect()}
    listing = entries.select("doc_id", "name", "size", "sha256")
    assert joins.verify_artifacts(entries, listing, strict=True).first().error is None
    assert joins.verify_artifacts(entries, listing.filter("size = 10")).first().error == "LOCAL_ARTIFACT_MISSING: u.pkl"


def test_jsonl_matches_python(spark):
    rows = [("d", 0, 'q " \\ \n 清', 1, True), ("d", 1, None, None, False)]
    frame = spark.createDataFrame(rows, "doc_id string, pos long, text string, page_number int, ok boolean")
    got = [r.line for r in records.chunk_jsonl(frame).orderBy("pos").collect()]
    want = [{"text": t, "page_number": p, "ok": o} for _, _, t, p, o in rows]
    assert got == [json.dumps(w, ensure_ascii=False, sort_keys=True) for w in want]


def test_stage_log_and_failures(spark, tmp_path):
    log, failures = str(tmp_path / "log"), str(tmp_path / "failures")
    ids = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    for day in ("2024-01-01", "2024-01-02"):
        writers.append_stage_log(writers.stamp_stage(ids, "fulltext", F.lit(day).cast("timestamp")), log)
    view = writers.stage_view(spark.read.parquet(log), ["fulltext", "upload"]).collect()
    assert {(str(r.fulltext_time), r.upload_time) for r in view} == {("2024-01-02 00:00:00", None)} and len(view) == 2
    assert writers.latest_stages(spark.read.parquet(log)).count() == 2
    results = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "doc_id string, error string")
    writers.record_failures(results, failures)
    writers.record_failures(results, failures)
    assert [r[0] for r in spark.read.csv(failures).collect()] == ["a"]


def test_writers(spark, tmp_path):
    chunks = spark.createDataFrame([("a", 0, "x"), ("b", 0, "y")], "doc_id string, pos long, text string")
    out = str(tmp_path / "chunks")
    writers.write_chunks(chunks, out)
    writers.write_chunks(chunks.unionByName(chunks.withColumn("doc_id", F.lit("c"))), out)
    assert spark.read.parquet(out).groupBy("doc_id").count().count() == 3
    vectors = str(tmp_path / "vectors")
    for at, value in ((1, 0.5), (2, 0.7)):
        rows = spark.createDataFrame([("i", [value], "n", at), ("j", [value], "m", at)], "id string, values array<double>, namespace string, written_at int")
        writers.write_vectors(rows, vectors)
    assert {tuple(r["values"]) for r in writers.read_vectors(spark, vectors).collect()} == {(0.7,)}
    writers.clear_namespace(spark, vectors, "n")
    assert [r.namespace for r in writers.read_vectors(spark, vectors).collect()] == ["m"]
    writers.write_lines(spark.createDataFrame([("l",)], "line string"), str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first()[0] == "l"
    listed = readers.list_artifacts(spark, str(tmp_path / "lines"), ".txt")
    assert listed.where("size > 0").count() == 1 and "content" not in listed.columns


def test_table_and_search(spark, tmp_path):
    from chunkloom.operators.vectors import top_k_similar

    for _ in range(2):
        writers.ensure_table(spark, "made_here", "listing", str(tmp_path / "t"))
    assert spark.table("made_here").columns == ["path", "size", "modified"]
    spark.sql("DROP TABLE made_here")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [-1.0, 0.0]), (6, [3.0, 0.0])]
    found = top_k_similar(spark.createDataFrame(rows, "vec_id int, embedding array<float>"), [1.0, 0.0], 4).collect()
    assert [(r.vec_id, round(r.similarity, 4)) for r in found] == [(0, 1.0), (6, 1.0), (1, 0.7071), (5, -1.0)]


def test_index_schema(spark):
    rows = spark.createDataFrame([("1", "t", "d", "j", 5, "extra")], "id string, text string, doi string, journal string, date int, x string")
    shaped = records.index_rows(rows, "sci")
    assert shaped.columns == ["id", "text", "doi", "journal", "date"] and dict(shaped.dtypes)["date"] == "bigint"
    assert set(schemas.INDEXES) >= {d.index for d in domains.DOMAINS.values()}


def test_domain_vectors(spark):
    chunks = spark.createDataFrame([("a", 0, "one two three", 1), ("a", 1, "x", 2), ("b", 0, "y", 1)], "doc_id string, pos long, text string, page_number int")
    meta = spark.createDataFrame([("a", "T", ["o1", "o2"], "u")], "doc_id string, title string, issuing_organization array<string>, url string")
    meta = meta.withColumn("release_date", F.lit("1970-01-02").cast("timestamp_ntz"))
    fulltext, vectors, errors = domains.build_index("reports", chunks, meta, lambda: enrich.HashingEmbedder(4), 4, lo=2, hi=9)
    assert {r.id for r in fulltext.collect()} == {"a_0", "a_1"}
    assert json.loads(fulltext.orderBy("id").first().source)["organization"] == "o1，o2"
    rows = vectors.collect()
    assert {r.id for r in rows} == {"a_0", "a_1"} and rows[0].metadata.organization == "o1. o2"
    assert rows[0].metadata.release_date == 86400 and rows[0].namespace == "report" and errors.count() == 0


def test_patent_vectors(spark):
    rows = [("p1", "t", "a b c", "u", "CN", "20200101"), ("p2", "", "a", "u", "CN", "20200101")]
    frame = spark.createDataFrame(rows, schemas.TABLES["patents"])
    fulltext, vectors = domains.build_patent_index(frame, lambda: enrich.HashingEmbedder(4), 4)
    assert [r.id for r in fulltext.collect()] == ["p1"] and [r.id for r in vectors.collect()] == ["p1"]
    assert domains.patent_rows(frame, 2).first().abstract == "a b"


def test_streams_agree_with_batches(spark, tmp_path):
    events = spark.createDataFrame(
        [("j", f"2024-01-01 00:00:0{i}", i, e) for i, e in enumerate(["submit", "claim", "heartbeat", "fail", "claim"])],
        "job_id string, ts string, event_id int, event string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(5):
        events.filter(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = documents.read_new_files(spark, str(tmp_path / "in"), events.schema, per_batch=1)
    run = documents.publish_batches(jobs.job_status(stream), lambda b: b, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    run.awaitTermination()
    history = documents.current_rows(spark, str(tmp_path / "out")).orderBy("batch").collect()
    assert len(history) > 1
    batch = jobs.job_status(events).first()
    assert (history[-1].status, history[-1].attempts) == (batch.status, batch.attempts) == ("running", 2)
    assert str(batch.locked_until) == "2024-01-01 00:05:04"

    wake = documents.read_new_files(spark, str(tmp_path / "in"), events.schema)
    run = documents.publish_batches(jobs.dedupe_wakeups(wake, ["job_id"]), lambda b: b, str(tmp_path / "w"), str(tmp_path / "wcp"))
    run.awaitTermination()
    assert documents.current_rows(spark, str(tmp_path / "w")).count() == 1


def test_readers(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.v1.pdf").write_bytes(b"123")
    (tmp_path / "raw" / "b.pdf").write_bytes(b"")
    meta = spark.createDataFrame([("a", 1), ("c", 2)], "doc_id string, n int")
    found = readers.scan_raw_documents(spark, str(tmp_path / "raw"), meta, ".pdf").collect()
    assert [(r.doc_id, bytes(r.content), r.size, r.n) for r in found] == [("a", b"123", 3, 1)]
    listing = readers.list_artifacts(spark, str(tmp_path / "raw"), ".pdf")
    assert {(r.path, r["size"]) for r in listing.collect()} == {("a.v1.pdf", 3), ("b.pdf", 0)}
    assert [r.doc_id for r in readers.missing_documents(listing, meta).collect()] == ["c"]

    (tmp_path / "json").mkdir()
    for name, result in (("x.1", {"Year": "2020"}), ("y", [{"Year": 1}, {"Year": 2}]), ("z", []), ("w", {})):
        (tmp_path / "json" / f"{name}.json").write_text(json.dumps({"result": result}))
    rows = {(r.filename_prefix, r.row) for r in readers.read_result_json(spark, str(tmp_path / "json")).collect()}
    assert rows == {("x", '{"Year":"2020"}'), ("y", '{"Year":1}'), ("y", '{"Year":2}')}

    lists = str(tmp_path / "lists")
    lines = [{"doc_id": "d", "chunks": [{"text": "a", "page_number": 1}, {"text": "b"}]}]
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "c.json").write_text("\n".join(json.dumps(x) for x in lines))
    got = readers.read_chunks(spark, lists, "pair", "json").orderBy("pos").collect()
    assert [(r.pos, r.text, r.page_number) for r in got] == [(0, "a", 1), (1, "b", None)]
    with pytest.raises(ValueError):
        readers.explode_chunks(meta, "odd")
    docs = spark.createDataFrame([("a\nb\n",), ("",)], "text string")
    assert readers.most_lines(docs) == 2


def test_timeouts_on_a_stream(spark, tmp_path):
    rows = [("a", 0, "SUBMITTED"), ("a", 10, "STARTED"), ("b", 0, "SUBMITTED"), ("c", 0, "SUBMITTED"), ("c", 5, "SUCCESS")]
    frame = spark.createDataFrame(rows, "task_id string, at long, state string")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    want = {("a", "timeout")}
    assert {tuple(r) for r in jobs.task_timeouts(frame, F.lit(900), 800, 5000).collect()} == want
    stream = jobs.task_timeouts(documents.read_new_files(spark, str(tmp_path / "in"), frame.schema), F.lit(900), 800, 5000)
    run = documents.publish_batches(stream, lambda b: b, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    run.awaitTermination()
    got = documents.current_rows(spark, str(tmp_path / "out")).select("task_id", "problem")
    assert {tuple(r) for r in got.collect()} == want


def test_knowledge_base_keeps_all_parts_and_no_failed_document(spark):
    def make_client():
        def call(texts):
            if any("bad" in t for t in texts):
                raise ValueError("refused")
            return [{"index": i, "embedding": [1.0, 2.0, 2.0]} for i in range(len(texts))]

        return call

    rows = [(d, p, f"{d} text {p}" if (d, p) != ("b", 4) else "bad", 1) for d in "ab" for p in range(12)]
    chunks = spark.createDataFrame(rows, "doc_id string, pos int, text string, page_number int")
    docs = spark.createDataFrame([("a", "u"), ("b", "v")], "doc_id string, artifact_uuid string")
    files, entries, manifests, errors, vectors = domains.build_knowledge_base(
        chunks, docs, make_client, dims=2, batch=1, part_chunks=5
    )
    (manifest,) = manifests.collect()
    assert manifest["artifacts"] == {
        "chunks_jsonl": "u.jsonl", "chunks_jsonl.1": "u.1.jsonl", "chunks_jsonl.2": "u.2.jsonl"
    }
    assert sum(manifest["size_bytes"].values()) == sum(len(r["content"].encode()) for r in files.collect())
    assert entries.count() == 3 and {r["doc_id"] for r in errors.collect()} == {"b"}
    got = {(r["doc_id"], r["pos"], tuple(round(v, 5) for v in r["embedding"])) for r in vectors.collect()}
    assert got == {("a", p, (0.44721, 0.89443)) for p in range(12)}


def test_clear_namespace_with_escaped_characters(spark, tmp_path):
    path = str(tmp_path / "vectors")
    rows = [("a:b", "1", 1), ("c", "2", 1)]
    writers.write_vectors(spark.createDataFrame(rows, "namespace string, id string, written_at int"), path)
    writers.clear_namespace(spark, path, "a:b")
    assert [r["namespace"] for r in spark.read.parquet(path).collect()] == ["c"]


def test_table_that_cannot_be_read_stays_whole():
    broken = "<table><caption>no rows, but words</caption></table>"
    assert tables.cut_to_size(broken, 0, len) == [broken]
    assert tables.cut_to_size("<table></table>", 0, len) == []  # holds nothing
