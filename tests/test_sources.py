import gzip

from opinion_spark.sources import readers


def test_tweets_csv_multiline_and_keep_first(spark, tmp_path):
    a = tmp_path / "a.csv"
    b = tmp_path / "b.csv"
    a.write_text('tweet,state\n"line one\nstill one",Texas\nsame,Ohio\n')
    b.write_text('tweet,state\nsame,Ohio\n')
    df = readers.read_tweets(spark, {"Trump": str(a), "Biden": str(b)})
    rows = df.orderBy("_ord").collect()
    assert [r["tweet"] for r in rows] == ["line one\nstill one", "same", "same"]
    assert [r["source"] for r in rows] == ["Trump", "Trump", "Biden"]
    from opinion_spark.operators.cleaning import keep_first
    kept = keep_first(df, ["tweet"]).where("tweet = 'same'").first()
    assert kept["source"] == "Trump"


def test_snapshot_materialize_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    calls = []

    def build():
        calls.append(1)
        return df

    p = str(tmp_path / "snap")
    assert readers.materialize(spark, build, p).count() == 2
    assert readers.materialize(spark, build, p).count() == 2
    assert len(calls) == 1
    out = str(tmp_path / "csv")
    readers.write_csv(df, out, ["v"])
    assert sorted(r[0] for r in spark.read.option("header", True).csv(out).collect()) == ["x", "y"]


def test_word_list_gzip_and_ordinals(spark, tmp_path):
    p = tmp_path / "words.txt.gz"
    with gzip.open(p, "wt") as f:
        f.write("the\nis\ntrump\n")
    wl = readers.read_word_list(spark, str(p))
    from opinion_spark.operators.hashtags import word_costs
    costs = {r["word"]: r["cost"] for r in word_costs(wl).collect()}
    assert costs["the"] < costs["is"] < costs["trump"]
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string").repartition(2)
    ids = readers.with_ordinal_id(df).collect()
    assert sorted(r["doc_id"] for r in ids) == [0, 1, 2]
    assert readers.first_n(readers.with_ordinal_id(df), 2).count() == 2
    ordered = spark.range(0, 50, 1, 7)
    assert all(r["id"] == r["doc_id"] for r in readers.with_ordinal_id(ordered).collect())


def quoted_file(path, n, seed):
    import csv
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "".join(rng.choice(["word ", 'say "hi" ', "\n", ", ", "é ", "x"]) for _ in range(rng.randint(0, 12))).strip(" ")
        rows.append((f"{i}:{text}" if i % 7 else f"{i}" + "\n" * (i % 50), rng.choice(["Texas", "Ohio", 'New "York"', "a\nb"])))
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["tweet", "state\nname"])
        w.writerows(rows)
    return rows


def test_quoted_csv_in_many_splits_equals_one_task(spark, tmp_path):
    """Records with line breaks, quotes and commas, over splits of a few hundred bytes, some inside a record."""
    folder = tmp_path / "in"
    folder.mkdir()
    rows = quoted_file(folder / "a.csv", 400, 1) + quoted_file(folder / "b.csv", 150, 2)
    schema = "tweet string, state string"
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = readers.read_quoted_csv(spark, str(folder), schema)
        assert spark.read.text(str(folder)).select("value").rdd.getNumPartitions() > 20
        ordered = [(r.tweet, r.state) for r in got.orderBy("_row").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert ordered == rows
    one = [(r.tweet, r.state) for r in readers.read_csv(spark, str(folder), schema, multiline=True).collect()]
    assert sorted(ordered) == sorted(one)


def test_quoted_csv_of_nothing(spark, tmp_path):
    (tmp_path / "h.csv").write_text("tweet,state\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "b.csv").write_text("tweet,state\n\nx,\n\n,y\n")
    got = readers.read_quoted_csv(spark, str(tmp_path), "tweet string, state string")
    assert [(r.tweet, r.state) for r in got.orderBy("_row").collect()] == [("x", None), (None, "y")]


def test_votes_and_history_csv(spark, tmp_path):
    """Typed columns by position, bad numbers as NULL."""
    v, h = tmp_path / "v.csv", tmp_path / "h.csv"
    v.write_text('state_po,candidate,votes\nTX,"DOE, JANE",12\nOH,ROE,x\n,,\n')
    h.write_text("year,state,state_po,office,party_detailed,candidatevotes\n2016,TEXAS,TX,US PRESIDENT,DEMOCRAT,7\n2020,OHIO,OH,US PRESIDENT,,\n")
    assert [tuple(r) for r in readers.read_votes(spark, str(v)).collect()] == [("TX", "DOE, JANE", 12), ("OH", "ROE", None), (None, None, None)]
    assert dict(readers.read_history(spark, str(h)).dtypes) == {"year": "int", "state": "string", "state_po": "string", "office": "string", "party_detailed": "string", "candidatevotes": "bigint"}
    assert [tuple(r) for r in readers.read_history(spark, str(h)).collect()] == [(2016, "TEXAS", "TX", "US PRESIDENT", "DEMOCRAT", 7), (2020, "OHIO", "OH", "US PRESIDENT", None, None)]
