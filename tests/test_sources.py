import csv
import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from corpuslink.operators import keyed as K
from corpuslink.operators.mediation import LISTING_MAPPING
from corpuslink.operators.profile import feature_analysis, summarize
from corpuslink.operators.scale import literal_rows, localize
from corpuslink.plans import records
from corpuslink.sources import corpus as SC
from corpuslink.sources import pairs as SP
from corpuslink.sources import records as SR


def test_text_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("uno\ndue", encoding="utf-8")
    (tmp_path / "b.md").write_text("no", encoding="utf-8")
    (tmp_path / "p.html").write_text("<p>x</p>", encoding="utf-8")
    assert [(r.nome, r.contenuto) for r in SC.read_text_corpus(spark, str(tmp_path)).collect()] == [("a.txt", "uno\ndue")]
    assert [tuple(r) for r in SC.read_html_pages(spark, str(tmp_path), "arxiv").collect()] == [("p", "arxiv", "<p>x</p>")]


def test_csv_keeps_quotes_and_line_ends(spark, tmp_path):
    df = literal_rows(spark, [("v1", 'say "hi",\nthen go'), ("v2", "plain")], "VIN string, description string")
    SR.write_sources(df, str(tmp_path / "c"))
    back = SR.read_csv_source(spark, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert SR.read_csv_source(spark, str(tmp_path / "c"), ["VIN"]).columns == ["VIN"]


def test_matching_csv_rows(spark, tmp_path):
    rows = [("v1 ", "ford", "2010"), ("v2", "UNKNOWN inc", "2010"), ("v3", None, "2010"), ("v4", "audi", "2011")]
    SR.write_sources(literal_rows(spark, rows, "VIN string, manufacturer string, year string"), str(tmp_path / "m"))
    keys = literal_rows(spark, [("V1",), ("V2",), ("V3",)], "key string")
    got = SR.read_matching_csv(spark, str(tmp_path / "m"), keys, LISTING_MAPPING).collect()
    assert [r.VIN for r in got] == ["V1"]


def test_keyed_write_keeps_the_last_row(spark, tmp_path):
    df = literal_rows(spark, [("a", 1), ("a", 3), ("a", 2), ("b", 1)], "k string, o int")
    SR.write_keyed(df, ["k"], str(tmp_path / "k"), ["o"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "k")).collect())) == [("a", 3), ("b", 1)]
    SR.write_keyed(df, ["k"], str(tmp_path / "all"), ["o"], keep_all=True)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    plan = K.dedup_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_pair_lines(spark, tmp_path):
    lines = literal_rows(spark, [("a\tb",), ("a\tb\t1",), ("a\tb\tc\td\t0",)], "value string")
    assert sorted(tuple(r) for r in SP.parse_pair_lines(lines).collect()) == [("a", "b", 1), ("a", "b c d", 0)]
    pairs = literal_rows(spark, [("x", "y", 1), ("z", "w", 0)], "left string, right string, label int")
    SP.write_pair_lines(pairs, str(tmp_path / "p"))
    assert sorted(tuple(r) for r in SP.read_pair_lines(spark, str(tmp_path / "p")).collect()) == [("x", "y", 1), ("z", "w", 0)]
    SP.write_metrics(pairs.agg(F.count("*").alias("n")), str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first().n == 2


def test_sources_sampled_to_exact_size(spark):
    a = spark.range(200).selectExpr("concat('v', id) VIN", "'ford' manufacturer", "'2010' year", "id ord")
    b = spark.range(100, 400).selectExpr("upper(concat('v', id % 150)) vin", "'ford' make_name", "2010 year", "id ord")
    xa, xb = records.build_sources(a, b, ["ord"], 60, 25)
    assert xa.count() == xb.count() == 25 and {r.VIN for r in xa.collect()} == {r.vin for r in xb.collect()}
    fa, fb = records.build_sources(a, b, ["ord"], None, None)
    assert fa.count() == fb.count() == 150


def test_profile_and_summary(spark):
    df = literal_rows(spark, [("a", "", 1.0), ("b", None, 2.0), ("b", "x", 4.0), ("c", "x", None)], "g string, s string, v double")
    got = {r.attribute: (r.null_pct, r.blank_pct, r.unique) for r in feature_analysis(df).collect()}
    assert got == {"g": (0.0, 0.0, 3), "s": (25.0, 25.0, 2), "v": (25.0, 0.0, 3)}
    assert {r.g: r.median for r in summarize(df, "v", ["g"]).collect()} == {"a": 1.0, "b": 3.0, "c": None}
    assert summarize(df, "v").first().median == 2.0


def test_broadcast_only_when_small(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    small, rows = localize(spark.range(5), 5)
    large, none = localize(spark.range(6), 5)
    assert hinted(small) and len(rows) == 5 and not hinted(large) and none is None


NAMES = ["search_match_any_top10", "search_phrase", "index_corpus_stats", "analyzers_unstemmed", "link_rules_make",
         "link_split", "link_false_pairs", "link_sources_sampled", "media_objects", "media_similar_paragraphs",
         "papers_from_xml", "corpus_search", "text_cleaning", "text_timing_summary"]


@pytest.mark.parametrize("name", NAMES)
def test_registered_query_equals_its_sql(spark, name):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "part", "events", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    df = entry.queries()[name](spark, d)
    cur = con.execute(entry.oracle_sql()[name])
    verdict = check.compare(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in cur.description], cur.fetchall())
    assert verdict.startswith("ok")


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["query_id", "rank", "doc_id", "score"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_multi_line_csv_in_parts_equals_the_reader_of_whole_files(spark, tmp_path):
    rng = random.Random(4)
    pieces = ["a", "b c", "\n", '"', ",", "\n\n", "\r\n", "é", ' "" ', "x" * 40]
    folder = tmp_path / "csv"
    folder.mkdir()
    want = Counter()
    for name, end in (("one.csv", "\n"), ("two.csv", "\r\n")):
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", "text", "tail"])
            for k in range(400):
                row = [f"{name}{k}", "t" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) + "t", rng.choice(["z", ""])]
                out.writerow(row)
                want[row[0], row[1], row[2] or None] += 1
                if k % 50 == 0:
                    f.write(end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = SR.csv_records(spark, str(folder))
        assert found.groupBy("file").count().select("count").distinct().collect() == [(401,)]
        got = Counter(map(tuple, SR.read_csv_parts(spark, str(folder)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want


def test_csv_parts_of_headers_alone_are_empty(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,text\n")
    out = SR.read_csv_parts(spark, str(tmp_path / "h.csv"), ["text"])
    assert out.columns == ["text"] and out.count() == 0


def test_profile_tells_long_values_apart_by_digests(spark):
    long, digest = "a" * 80, hashlib.sha256(b"a" * 80).hexdigest()
    df = literal_rows(spark, [(long,), (long,), (long + "b",), (digest,), ("",), (None,)], "v string")
    r = feature_analysis(df).first()
    assert (r.null_pct, r.blank_pct, r.unique) == (16.67, 16.67, 4)
    assert feature_analysis(df.limit(0)).count() == 0
