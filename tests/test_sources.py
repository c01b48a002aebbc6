import pytest
from pyspark.sql import functions as F

from cofi.sources import (
    append_user,
    dedupe,
    expect_rows,
    load_personal_csv,
    load_ratings,
    judge_rating_lines,
    load_ratings_text,
    load_with_rejects,
    parse_rating_lines,
    personal_ratings,
    split_train_test,
    titles,
)
from cofi.sources.sinks import answers_table, nested_answers


def test_parse_lines_drops_header_and_blank(spark):
    lines = spark.createDataFrame([("user\titem\trating\tts",), ("",), ("1\t10\t4\t881250949",),
                                   (" 2 \t 11 \t 3.5 ",)], "value STRING")
    got = sorted(tuple(r) for r in parse_rating_lines(lines).collect())
    assert got == [(1, 10, 4.0), (2, 11, 3.5)]


def test_ids_beyond_32_bits(spark, tmp_path):
    lines = spark.createDataFrame([("2147483648\t10\t4",), ("3000000000\t9000000000\t2",), ("x\t1\t1",)], "value STRING")
    assert sorted(tuple(r) for r in parse_rating_lines(lines).collect()) == [
        (2147483648, 10, 4.0), (3000000000, 9000000000, 2.0)]


def test_missing_zero_and_impossible_ratings(spark, tmp_path):
    write = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    with_null = write("null.csv", "u,i,r\n1,10,4\n1,11,\n")
    cols = dict(user_col="u", item_col="i", rating_col="r")
    with pytest.raises(Exception, match="missing"):
        load_ratings(spark, with_null, "csv", **cols).collect()
    assert load_ratings(spark, with_null, "csv", null_ratings="drop", **cols).count() == 1
    with pytest.raises(ValueError):
        load_ratings(spark, with_null, "csv", null_ratings="keep", **cols)
    with pytest.raises(Exception, match="outside the scale: 7"):
        load_ratings(spark, write("far.csv", "u,i,r\n1,10,7\n"), "csv", **cols).collect()
    with pytest.raises(Exception, match="outside the scale"):
        load_ratings_text(spark, write("far.txt", "1\t10\t0.5\n")).collect()
    zero = write("zero.txt", "1\t10\t0\n1\t11\t3\n")
    assert load_ratings_text(spark, zero).count() == 1
    assert load_ratings_text(spark, zero, drop_zero=False).count() == 2
    assert load_ratings(spark, zero, "text", "\t").count() == 1


def test_text_file_double_colon(spark, tmp_path):
    p = tmp_path / "r.dat"
    p.write_text("1::10::5::978300760\n2::10::3::978300761\n")
    got = sorted(tuple(r) for r in load_ratings_text(spark, str(p), "::").collect())
    assert got == [(1, 10, 5.0), (2, 10, 3.0)]


def test_bad_data_line_fails(spark):
    lines = spark.createDataFrame([("1\tten\t4",)], "value STRING")
    with pytest.raises(Exception):
        parse_rating_lines(lines).collect()


def test_csv_and_parquet_loaders(spark, tmp_path):
    csv = tmp_path / "r.csv"
    csv.write_text("u,i,r\n1,10,4\n1,11,0\n2,10,2\n")
    df = load_ratings(spark, str(csv), "csv", user_col="u", item_col="i", rating_col="r")
    assert sorted(tuple(r) for r in df.collect()) == [(1, 10, 4.0), (2, 10, 2.0)]
    out = str(tmp_path / "pq")
    df.write.parquet(out)
    assert load_ratings(spark, out).count() == 2


def test_dedupe_policies(spark):
    df = spark.createDataFrame([(1, 10, 2.0, 1), (1, 10, 4.0, 2), (1, 10, 3.0, 3)],
                               "user_id BIGINT, item_id BIGINT, rating DOUBLE, ts INT")
    assert dedupe(df, "last", ["ts"]).first().rating == 3.0
    assert dedupe(df, "max").first().rating == 4.0
    assert dedupe(df, "avg").first().rating == 3.0
    assert dedupe(df, "sum").first().rating == 9.0
    with pytest.raises(ValueError):
        dedupe(df, "first")


def test_split_is_a_partition(micro):
    train, test = micro
    both = train.unionByName(test)
    tr, te = split_train_test(both)
    assert tr.count() + te.count() == both.count()
    assert tr.join(te, ["user_id", "item_id"]).count() == 0


def test_personal_file(spark, tmp_path):
    p = tmp_path / "personal.csv"
    p.write_text('id,title,rating\n1,"Toy Story, The",5\n2,Heat,\n3,Alien,0\n4,Fargo,3\n')
    pers = load_personal_csv(spark, str(p))
    mine = personal_ratings(pers, 944)
    assert sorted((r.user_id, r.item_id, r.rating) for r in mine.collect()) == [(944, 1, 5.0), (944, 4, 3.0)]
    t = {r.item_id: r.title for r in titles(pers).collect()}
    assert t[1] == "Toy Story, The" and len(t) == 4
    base = spark.createDataFrame([(1, 2, 4.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    assert append_user(base, mine).count() == 3


def test_expect_rows(micro):
    train, _ = micro
    assert expect_rows(train, 15).count() == 15
    with pytest.raises(Exception):
        expect_rows(train, 16).collect()
    assert expect_rows(train, train.select(F.count(F.lit(1))).scalar()).count() == 15


def test_answers(spark):
    a = spark.createDataFrame([("B.1", "mae", 0.5), ("B.1", "avg", 3.0)], "section STRING, metric STRING, value DOUBLE")
    j = nested_answers(answers_table(a)).first()
    assert j.section == "B.1" and j.json == '{"avg":3.0,"mae":0.5}'
    assert nested_answers(answers_table(a), 6).first().json == '{"avg":"3.000000","mae":"0.500000"}'


def test_text_dimensions(spark, tmp_path):
    p = tmp_path / "u.base"
    p.write_text("1\t10\t5\t0\n3\t10\t4\t0\n1\t99\t2\t0\n")
    got = sorted(tuple(r) for r in load_ratings_text(spark, str(p), n_users=2, n_items=50).collect())
    assert got == [(1, 10, 5.0)]


def test_write_answers(spark, tmp_path):
    import json
    from cofi.sources.sinks import write_answers
    a = spark.createDataFrame([("N.1", "mae", 0.75)], "section STRING, metric STRING, value DOUBLE")
    out = str(tmp_path / "answers")
    write_answers(answers_table(a), out)
    rows = [json.loads(line) for line in spark.read.text(out).toPandas()["value"]]
    assert rows == [{"section": "N.1", "json": '{"mae":0.75}'}]


def test_materialize_round_trip(spark):
    from cofi.session import materialize
    df = spark.createDataFrame(
        [(1, 10, 4.5, "a"), (2, None, None, None), (3, 30, 1.0, "c")],
        "user_id INT, item_id BIGINT, rating DOUBLE, tag STRING")
    back = materialize(df, "round_trip")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(back.collect(), key=lambda r: r.user_id) == sorted(df.collect(), key=lambda r: r.user_id)


@pytest.mark.parametrize("bad", [9.0, -1.0, 0.5])
def test_personal_ratings_outside_the_scale_stop_the_job(spark, bad):
    from cofi.sources import personal_ratings

    table = spark.createDataFrame([(1, "a", 4.0), (2, "b", None), (3, "c", 0.0), (4, "d", bad)], "id BIGINT, title STRING, rating DOUBLE")
    good = personal_ratings(table.where("id < 4"), 7).collect()
    assert [(r.user_id, r.item_id, r.rating) for r in good] == [(7, 1, 4.0)]
    with pytest.raises(Exception, match="outside"):
        personal_ratings(table, 7).collect()


def test_rejected_lines_are_a_table(spark, tmp_path):
    good = {"1\t10\t4\t0": (1, 10, 4.0), " 2 \t 11 \t 3.5 ": (2, 11, 3.5), "3000000000\t5\t1": (3000000000, 5, 1.0)}
    bad = {"user\titem\trating": "user", "": "user", "\t1\t2": "user", "1.5\t1\t2": "user", "1": "fields", "1\t2": "fields",
           "1\tx\t3": "item", "1\t\t3": "item", "1\t2\tx": "rating", "1\t2\t": "rating", "1\t2\t0": "unrated",
           "1\t2\t9": "scale", "1\t2\t-1": "scale", "1\t2\tNaN": "scale", "99999999999999999999\t1\t1": "user"}
    path = tmp_path / "lines.txt"
    path.write_text("\n".join([*good, *bad, *bad]) + "\n")  # repeated lines are rejected each
    kept, rejects = load_with_rejects(spark, str(path))
    assert sorted(tuple(r) for r in kept.collect()) == sorted(good.values())
    assert sorted(tuple(r) for r in rejects.collect()) == sorted([*bad.items()] * 2)
    null = spark.createDataFrame([(None,)], "value STRING")
    assert [tuple(r) for r in judge_rating_lines(null).collect()] == [(None, None, None, None, "user")]
    (tmp_path / "empty.txt").write_text("")
    assert [t.count() for t in load_with_rejects(spark, str(tmp_path / "empty.txt"))] == [0, 0]


def test_run_metadata_is_in_the_report(spark):
    import json

    from cofi.plans.catalog import QUERIES
    (row,) = QUERIES["report_run"](spark, "/root/testdata/sf0.001").collect()
    meta = json.loads(row.json)
    assert row.section == "Meta" and meta["master"] == spark.sparkContext.master and meta["k"] == "10"
    assert set(meta) == {"k", "partitions", "replication", "n_train", "n_test", "master", "num-executors"}
    assert int(meta["n_train"]) > int(meta["n_test"]) > 0
