from pyspark.sql import functions as F


def test_score_stream_equals_batch(spark, tmp_path):
    from quarry.operators import features as FT
    from quarry.operators import model as MD
    from quarry.plans.q_features import features_in
    from quarry.streaming import score_stream
    src = features_in(spark, "/root/testdata/sf0.001")
    prepared = FT.prepare(src)
    fp = FT.feature_pipeline(prepared)
    data = MD.training_frame(FT.training_table(fp, prepared))
    model = MD.fit_logreg(data, max_iter=20)
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = (score_stream(stream, fp, model).select("id", "prediction")
         .writeStream.format("memory").queryName("scored").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.sql("SELECT id, prediction FROM scored").collect()))
    want = sorted(map(tuple, MD.score(model, data).select("id", "prediction").collect()))
    assert got == want
