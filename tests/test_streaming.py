from pyspark.sql import functions as F

from gramspan.operators import LDA, PCA, SVC, KMeans, LinearRegression, LogisticRegression, StandardScaler, TruncatedSVD
from gramspan.sources import TabularDataset, read_table
from gramspan.streaming.scoring import read_stream, score_available


def test_models_score_a_stream(spark, sf, tmp_path):
    events = read_table(spark, sf, "events")
    wide = events.withColumn("user", F.col("user_id") / 100)
    ds = TabularDataset(wide, ["user", "value"], "user", ["event_id"])
    two = wide.withColumn("flag", (F.col("value") > 50).cast("double"))
    flagged = TabularDataset(two, ["user", "value"], "flag", ["event_id"])
    signed = TabularDataset(two.withColumn("flag", F.col("flag") * 2 - 1), ["value"], "flag")
    steps = [
        LinearRegression().fit(ds).transform,
        KMeans(2, max_iter=2).fit(ds).predict,
        PCA(1).fit(ds).transform,
        lambda df, m=TruncatedSVD(1).fit(ds): m.transform(df, "svd"),
        lambda df, m=LDA().fit(flagged): m.predict(df, "lda"),
        lambda df, m=LogisticRegression(max_iterations=5).fit(flagged): m.predict_proba(df),
        lambda df, m=SVC(gamma=0.01, tolerance=0.1).fit(signed): m.predict(df, "svc"),
        StandardScaler().fit(ds).transform,
    ]

    def run(df):
        df = df.withColumn("user", F.col("user_id") / 100)
        for step in steps:
            df = step(df)
        return df.select("event_id", "prediction", "cluster", "projected", "svd", "lda", "probability", "svc", "value")

    stream = read_stream(spark, sf, "events.parquet", events)
    got = score_available(stream, run, str(tmp_path / "out"), str(tmp_path / "state"))
    want = run(events)
    assert got.count() == events.count()
    assert got.exceptAll(want).isEmpty()
