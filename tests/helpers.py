from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def hourly(spark, values, series="a", start=START, column="v"):
    """One series of hourly values; ``values`` may hold None."""
    rows = [(series, start + timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"series_id string, time timestamp_ntz, {column} double")


def column(df, name, order="time", digits=6):
    return [None if r[name] is None else round(r[name], digits) for r in df.orderBy(order).select(name).collect()]
