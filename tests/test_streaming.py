from opinion_spark.streaming import stance_counts_stream


def test_stream_counts_match_batch(spark, tmp_path):
    src = tmp_path / "in"
    rows = [("good the", "A"), ("bad the", "A"), ("good les", "B"), ("good the", "A"), ("nothing", "B")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "tweet string, state string").write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("tweet string, state string").parquet(str(src))
    names = {"trump": ["the"], "biden": ["les"]}
    lex = {"good": 2.0, "bad": -2.0}
    q = (stance_counts_stream(stream, names, lex, whole_word=True).writeStream.outputMode("complete")
         .format("memory").queryName("stance_counts")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["state"]: (r["n_unsure"], r["n_dem"], r["n_rep"]) for r in spark.sql("SELECT * FROM stance_counts").collect()}
    # A: "good the" (trump, positive -> 2) once after dedup, "bad the" (trump, negative -> 1)
    # B: "good les" (biden, positive -> 1)
    assert got == {"A": (0, 1, 1), "B": (0, 1, 0)}
