import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import rows
from prefkit import schemas as S
from prefkit.session import scratch_path
from prefkit.sources import (
    bad_item_lines,
    bad_rating_lines,
    parse_items,
    parse_ratings,
    preferences_from_responses,
    read_items,
    read_ratings,
)
from prefkit.sources.sinks import read_table, write_table


def test_read_items_quoted_titles_and_missing_genre(items):
    got = {r.item_id: (r.title, r.genres) for r in items.collect()}
    assert got[2] == ("Harbour Papers, The (2012)", "Crime|Documentary")
    assert got[6] == ("Salt, the Wind, and Stone, The (1966)", "Adventure|Crime")
    assert got[5] == ("NoGenre (2001)", None)
    assert len(got) == 6


def test_read_ratings_types(ratings):
    assert ratings.schema == S.RATINGS
    assert ratings.count() == 11
    assert rows(ratings.filter("user_id = 10")) == [(10, 3, 3.0, 1000000005), (10, 6, 4.0, 1000000009)]


def test_items_edge_rows(spark, tmp_path):
    p = tmp_path / "items_edge.csv"
    p.write_text(
        "movieId,title,genres\n"
        '7,"Say ""Hi"", Bob (2000)",Drama\n'
        "9,Empty,\n"
        "11,Dup,A|A\n"
    )
    got = {r.item_id: (r.title, r.genres) for r in read_items(spark, str(p), header=True).collect()}
    assert set(got) == {7, 9, 11}
    assert got[7] == ('Say "Hi", Bob (2000)', "Drama")
    assert got[9][1] is None
    with pytest.raises(Exception, match="malformed items line"):
        read_items(spark, str(p)).collect()
    assert read_items(spark, str(p), lenient=True).count() == 3


def test_read_ratings_header_and_failfast(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("userId,movieId,rating,timestamp\n1,2,3.5,100\n")
    assert rows(read_ratings(spark, str(p), header=True)) == [(1, 2, 3.5, 100)]
    with pytest.raises(Exception):
        read_ratings(spark, str(p)).collect()


def test_parse_text_columns(spark):
    lines = spark.createDataFrame(
        [("1,253,3.0,900660748",), (" 2 , 7 ,4.5, 1",)], "value string"
    )
    assert rows(parse_ratings(lines)) == [(1, 253, 3.0, 900660748), (2, 7, 4.5, 1)]
    item_lines = spark.createDataFrame(
        [('102604,"Harbour Papers, The (2012)",Crime|Documentary',), ('8,"No, Genre"',), ("9,Extra,A,B",)],
        "value string",
    )
    got = {r.item_id: (r.title, r.genres) for r in parse_items(item_lines).collect()}
    assert got[102604] == ("Harbour Papers, The (2012)", "Crime|Documentary")
    assert got[8] == ("No, Genre", None)
    assert got[9] == ("Extra,A", "B")  # unquoted: the title runs to the last comma


def test_preferences_from_responses(spark):
    resp = spark.createDataFrame(
        [(1, "5"), (2, "5\n"), (110, "0"), (260, " 5 "), (296, "x"), (318, "6"), (356, "05"), (480, "3"), (527, "99999999999999999999")],
        "item_id bigint, response string",
    )
    got = rows(preferences_from_responses(resp, user_id=0, ts=123))
    assert got == [(0, 1, 5.0, 123), (0, 356, 5.0, 123), (0, 480, 3.0, 123)]


def test_sink_roundtrip(spark, ratings):
    path = scratch_path(spark, "test-sink")
    write_table(ratings, path, fmt="csv", sep="\t")
    back = read_table(spark, path, S.RATINGS, fmt="csv", sep="\t")
    assert rows(back) == rows(ratings)
    lines = spark.read.text(path).select(F.col("value")).collect()
    assert "1\t1\t4.0\t1000000000" in {r.value for r in lines}
    ppath = scratch_path(spark, "test-sink-parquet")
    write_table(ratings, ppath, fmt="parquet")
    assert rows(read_table(spark, ppath, S.RATINGS, fmt="parquet")) == rows(ratings)


def test_parquet_sources_prune_and_push_down(spark, ratings, items):
    from prefkit.plans.inspect import plan_text
    from prefkit.sources import read_items, read_ratings

    rp, ip = scratch_path(spark, "pq-ratings"), scratch_path(spark, "pq-items")
    write_table(ratings.withColumn("extra", F.lit("x")), rp, fmt="parquet", partition_by=None)
    write_table(items, ip, fmt="parquet")
    back = read_ratings(spark, rp, fmt="parquet")
    assert back.columns == ["user_id", "item_id", "rating", "ts"]
    assert rows(back) == rows(ratings)
    assert rows(read_items(spark, ip, fmt="parquet")) == rows(items)
    text = plan_text(back.filter("user_id = 0").select("item_id"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,0)]" in text
    assert "ReadSchema: struct<user_id:bigint,item_id:bigint>" in text


def test_partitioned_sink(spark, ratings):
    from prefkit.operators.splits import split_assignment

    path = scratch_path(spark, "by-split")
    write_table(split_assignment(ratings), path, fmt="parquet", partition_by=["split"])
    back = spark.read.parquet(path)
    assert back.filter("split = 'test'").count() == 2


def test_unquoted_comma_titles(spark, tmp_path):
    # the hand-written top-ten list style: commas inside titles without quotes
    p = tmp_path / "top.csv"
    p.write_text(
        "318,Granite Orchard, The (1994),Crime|Drama\n"
        "2571,Lattice, The (1999),Action|Sci-Fi|Thriller\n"
        "1,Paper Kite (1995),Adventure|Animation\n"
        '2,"Harbour Papers, The (2012)",Crime|Documentary\n'
        "5,NoGenre (2001)\n"
    )
    got = {r.item_id: (r.title, r.genres) for r in read_items(spark, str(p)).collect()}
    assert got == {
        318: ("Granite Orchard, The (1994)", "Crime|Drama"),
        2571: ("Lattice, The (1999)", "Action|Sci-Fi|Thriller"),
        1: ("Paper Kite (1995)", "Adventure|Animation"),
        2: ("Harbour Papers, The (2012)", "Crime|Documentary"),
        5: ("NoGenre (2001)", None),
    }


@pytest.mark.parametrize("line", ["1,2,3.5,100,extra", "1,2,3.5", "1,x,3.5,100", "x,2,3.0,5", "1,2,abc,5", "1,3,3.0,", "99999999999999999999,1,2,3"])
def test_ratings_lines_must_have_four_valid_fields(spark, tmp_path, line):
    p = tmp_path / "bad.csv"
    p.write_text(line + "\n2,3,4.0,5\n")
    with pytest.raises(Exception):
        read_ratings(spark, str(p)).collect()
    assert rows(read_ratings(spark, str(p), lenient=True)) == [(2, 3, 4.0, 5)]
    assert rows(bad_rating_lines(spark.read.text(str(p)))) == [(line,)]


@pytest.mark.parametrize("line", ["x,Title,A", "8", '9,"Open, title,A', '9,"T",A,B', "99999999999999999999,T,A"])
def test_items_lines_that_do_not_fit(spark, line):
    lines = spark.createDataFrame([(line,), ("1,T,A",), ("",)], "value string")
    with pytest.raises(Exception, match="malformed items line"):
        parse_items(lines).collect()
    assert rows(parse_items(lines, lenient=True)) == [(1, "T", "A")]
    assert rows(bad_item_lines(lines)) == [(line,)]


def test_text_sink_is_faithful(spark):
    texts = [" lead", "trail ", "", None, "a\nb", "t\tab", "back\\slash", "\\n", "\\\\N", "\\N", "r\r", '"q"', "a,b", "\\"]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([(i, t, i / 3) for i, t in enumerate(texts)], schema)
    for sep in ("\t", ",", "|"):
        path = scratch_path(spark, "faithful")
        write_table(df, path, sep=sep)
        assert spark.read.text(path).count() == len(texts)
        assert sorted(map(tuple, read_table(spark, path, schema, sep=sep).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_table(df, path)


def test_timestamps_do_not_depend_on_the_zone(spark):
    from prefkit.sources import bindings as B

    saved = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        want = rows(B.bind_ratings(spark, "/root/testdata/sf0.001"))
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # midnights that do not exist
        assert rows(B.bind_ratings(spark, "/root/testdata/sf0.001")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)


def test_materialize_bindings(spark):
    from prefkit.sources import bindings as B

    paths = B.materialize_bindings(spark, "/root/testdata/sf0.001")
    r = spark.read.parquet(paths["ratings"])
    assert r.columns == ["user_id", "item_id", "rating", "ts"]
    assert rows(r) == rows(B.bind_ratings(spark, "/root/testdata/sf0.001"))
    assert spark.read.parquet(paths["items"]).count() == 200
