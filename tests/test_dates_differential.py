"""C3 against pandas' scalar parsing (what a per-value lenient parse does):
every accepted shape agrees on generated dates, and on junk the native
expression never produces a date that pandas would not."""
import datetime as dt
import random
import warnings

import pandas as pd
from pyspark.sql import functions as F

from threadscope.functions.dates import clean_date


def _pandas(s):
    if s is None:
        return None
    s = str(s).strip()
    if "年" in s and "月" in s:
        s = s.replace("年", "-").replace("月", "-").replace("日", "")
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return pd.to_datetime(s).strftime("%Y-%m-%d")
    except Exception:  # noqa: BLE001
        return None


def _shapes(d: dt.datetime):
    return [d.strftime("%Y-%m-%d"), f"{d.year}/{d.month}/{d.day}", d.strftime("%Y%m%d"),
            f"{d.month}/{d.day}/{d.year}", f"{d.year}年{d.month}月{d.day}日", d.strftime("%a %b %d %H:%M:%S %Y"),
            d.strftime("%Y-%m-%dT%H:%M:%S+08:00"), d.strftime("%Y.%m.%d %H:%M"), f"  {d.strftime('%Y-%m-%d')}\n",
            str(d.year), f"{d.year}-{d.month}"]


def test_accepted_shapes_match_pandas(spark):
    random.seed(3)
    days = [dt.datetime(1990, 1, 1) + dt.timedelta(days=random.randint(0, 15000), seconds=random.randint(0, 86399))
            for _ in range(150)]
    values = [s for d in days for s in _shapes(d)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string")
           .select(clean_date(F.col("v"))).collect()]
    bad = [(v, g, _pandas(v)) for v, g in zip(values, got) if g != _pandas(v)]
    assert not bad, bad[:5]


def test_junk_never_invents_dates(spark):
    random.seed(4)
    alpha = list("0123456789-/:. 年月日TZ+abcJanFeb")
    values = ["".join(random.choice(alpha) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    values += ["未成功抓取時間", "5", "1735689600", "2025年1月", "now", "", "2025-13-01", "2025-02-30"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string")
           .select(clean_date(F.col("v"))).collect()]
    bad = [(v, g, _pandas(v)) for v, g in zip(values, got) if g is not None and g != _pandas(v)]
    assert not bad, bad[:5]
