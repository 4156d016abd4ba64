import hashlib
import re
from collections import Counter, defaultdict

from helpers import DOC, EDGES, edges, empty
from pyspark.sql import functions as F
from wavelens.llm import exact_dedup as ed
from wavelens.session import scratch_path


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    by = defaultdict(list)
    for doc, text in rows:
        by[norm(text)].append(doc)
    out = []
    for text, docs in by.items():
        keep = min((d for d in docs if d is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, keep, len(docs), digest) for d in docs]
    return Counter(out)


def check(rows, found):
    got = found.collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected(rows)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len({norm(t) for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_edges(spark):
    check(EDGES, ed.exact_dedup(edges(spark)))


def test_all_ascii_blanks_and_no_others(spark):
    rows = [(i, f"a{b}b") for i, b in enumerate([" ", "\t", "\n\n", "\x0b", "\x0c\r", "\xa0", "\x1c", " ", ""])]
    check(rows, ed.exact_dedup(spark.createDataFrame(rows, DOC)))


def test_no_rows(spark):
    assert ed.exact_dedup(empty(spark)).count() == 0


def test_state_goes_on_with_new_files(spark):
    folder, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "state")
    session = ed.rocksdb_session(spark)
    for rows in ([(5, "x"), (6, "y")], [(3, "x"), (9, "y"), (7, "z")]):
        ed.digests(spark.createDataFrame(rows, DOC)).write.mode("append").parquet(folder)
        ed.keep_state(ed.stream_of(session, folder, spark.read.parquet(folder).schema), checkpoint)
    got = {(r["keep"]["doc_id"], r["group_size"]) for r in ed.read_state(session, checkpoint).collect()}
    assert got == {(3, 2), (6, 2), (7, 1)}


def test_bytes_decide_where_digests_clash(spark):
    rows = [(1, "a"), (2, "a"), (3, "b c"), (4, "b  c"), (5, "d")]
    docs = spark.createDataFrame(rows, DOC)
    same = F.unhex(F.lit("00" * 32))
    log = ed.digests(docs).withColumn("digest", F.when(F.col("doc_id") < 5, same).otherwise(F.col("digest")))
    state = log.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "locator")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"),
    )
    clashes = spark.createDataFrame([(bytes(32),)], "digest binary")
    real = ed.digests(docs).filter("doc_id < 5").select("digest").distinct()
    got = ed.resolve(docs, log, state, clashes.unionAll(real)).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == [
        (1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True)]


def test_different_bytes_under_one_digest_are_found(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], DOC)
    state = ed.digests(docs).groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    assert ed.collisions(docs, state).count() == 0


def two_runs(spark, *runs):
    checkpoint = scratch_path(spark, "kept-state")
    return [
        sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in ed.exact_dedup(
            spark.createDataFrame(rows, DOC).coalesce(1), checkpoint).collect())
        for rows in runs
    ]


def test_one_checkpoint_twice(spark):
    first, second = two_runs(spark, [(1, "x"), (5, "y")], [(2, "x"), (3, "y"), (7, "z")])
    assert first == [(1, 1, 1, True), (5, 5, 1, True)]
    assert second == [(2, 1, 2, False), (3, 3, 2, True), (7, 7, 1, True)]


def test_bytes_of_earlier_runs_decide(spark, monkeypatch):
    monkeypatch.setattr(ed, "_digest", lambda: F.unhex(F.sha2(F.substring(ed.normalised(), 1, 1), 256)))
    _, second = two_runs(spark, [(1, "ab"), (4, "d")], [(2, "ac"), (3, "ab"), (5, "d")])
    assert second == [(2, 2, 1, True), (3, 1, 2, False), (5, 4, 2, False)]


def test_collisions_are_found_among_many_hits(spark, monkeypatch):
    """A digest that tells only how long a text is: groups of one text and of several."""
    monkeypatch.setattr(ed, "_digest", lambda: F.unhex(F.md5(F.length("text").cast("string"))))
    texts = ["aa", "aa", "bb", "ccc", "ccc", "dddd", None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    state = docs.select(ed._digest().alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    clash = [r["digest"] for r in ed.collisions(docs, state).collect()]
    want = [r["d"] for r in spark.range(1).select(F.unhex(F.md5(F.lit("2"))).alias("d")).collect()]
    assert clash == want
