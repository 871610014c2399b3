from pyspark.sql import types as T


def series_df(spark, series):
    """series: dict key -> list of y (sequence 1..n)."""
    rows = [(k, i + 1, None if y is None else float(y)) for k, ys in series.items()
            for i, y in enumerate(ys)]
    schema = T.StructType([T.StructField("key", T.StringType()),
                           T.StructField("seq", T.IntegerType()),
                           T.StructField("y", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def kept(df):
    return sorted((r["key"], r["row_num"]) for r in df.collect())
