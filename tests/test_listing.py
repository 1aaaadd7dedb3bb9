"""The listing source: empty files, pruning by prefix and suffix, and rows written as files."""

from pyspark.sql import functions as F

from chunkloom.sources import listing, readers

FILES = {
    "a.txt": b"x", "empty.txt": b"", "_SUCCESS": b"", ".hidden": b"1", "one/b.txt": b"yy", "one/deep/c.json": b"{}", "one/deep/empty.txt": b"",
    "two/d.txt": b"zzz", "_temporary/e.txt": b"q", "two/_part/f.txt": b"q", "only/": None,
}


def folder(tmp_path):
    root = tmp_path / "root"
    for name, content in FILES.items():
        target = root / name
        (target if content is None else target.parent).mkdir(parents=True, exist_ok=True)
        if content is not None:
            target.write_bytes(content)
    return str(root)


def listed(df):
    return {(r["path"], r["size"]) for r in df.collect()}


def test_listing_with_empty_files(spark, tmp_path):
    root = folder(tmp_path)
    files = listing.list_files(spark, root)
    every = {(n, len(c)) for n, c in FILES.items() if c is not None and not any(p[0] in "._" for p in n.split("/"))}
    assert listed(files) == every
    assert files.rdd.getNumPartitions() == 4  # the folder itself, one, two and only
    assert listed(readers.list_artifacts(spark, f"file:{root}", ".txt", "one/")) == {("one/b.txt", 2), ("one/deep/empty.txt", 0)}
    assert listing.list_files(spark, root, prefix="one/d").rdd.getNumPartitions() == 2
    assert listed(files.where("size = 0")) == {("empty.txt", 0), ("one/deep/empty.txt", 0)}
    assert listed(listing.list_files(spark, f"{root}/nowhere")) == set()
    now = files.select((F.abs(F.unix_timestamp("modified") - F.unix_timestamp()) < 600).alias("near")).distinct().collect()
    assert now == [(True,)]


def test_filters_reach_the_listing(spark, tmp_path):
    root = folder(tmp_path)
    setting = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        some = listing.list_files(spark, root).where(F.col("path").startswith("two") & F.col("path").endswith(".txt") & (F.col("size") > 0))
        assert listed(some) == {("two/d.txt", 3)}
        assert some.rdd.getNumPartitions() == 2
    finally:
        spark.conf.set(setting, before)


def test_rows_become_files(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([("x/1.txt", "äb"), ("x/2.txt", None), ("y/z/3.txt", "")], "path string, content string")
    assert listed(listing.write_files(rows, root)) == {("x/1.txt", 3), ("x/2.txt", 0), ("y/z/3.txt", 0)}
    assert listed(listing.list_files(spark, root)) == {("x/1.txt", 3), ("x/2.txt", 0), ("y/z/3.txt", 0)}
