"""The lead extract moves each wide row once per key, and odd revisions change nothing."""

import contextlib
import io

from pyspark.sql import functions as F

from enrichlab.plans import extracts as X
from enrichlab.sources import fx_attribute, fx_funnel, fx_predictions
from enrichlab.sources.scans import ExtractParams
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_scan_tasks_sort_no_whole_split(spark):
    """Maxima of strings are combined by sorting: none runs below the exchange that deals its rows, where
    a task would sort, and spill, a whole split."""
    df = X.lead_attribute_frame(fx_attribute(spark, SF_SMALL), fx_funnel(spark, SF_SMALL), fx_predictions(spark, SF_SMALL), ExtractParams())
    lines = _plan(df).splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    sorts = [i for i, x in enumerate(lines) if "SortAggregate" in x and "partial_max" in x]
    assert sorts
    for i in sorts:  # its input is sorted rows of an exchange, not of a scan or a join
        below = next(j for j in range(i + 1, len(lines)) if "Sort [" not in lines[j] and "Project" not in lines[j])
        assert depth[below] > depth[i] and "Exchange hashpartitioning" in lines[below], lines[below]


def test_first_version_of_odd_revisions(spark):
    attrs = "subid string, rn int, process_name string, partner_id int, vertical_id string, transaction_month_prt string, customer_status string, net_revenue double"
    e = spark.createDataFrame([
        ("1", 2, "sale", 1, "v", "1995-01", "b", 5.0), ("1", 2, "sale", 1, "v", "1995-01", "a", None), ("1", 3, "sale", 1, "v", "1995-01", "z", 9.0),
        ("2", 2, "sale", 1, "v", "1995-01", None, 7.0), ("3", 4, "sale", 1, "v", "1995-01", "late", 1.0),  # one visit: 3 has no lowest revision
        ("4", None, "sale", 1, "v", "1995-01", "none", 1.0), ("5", -2147483648, "sale", 1, "v", "1995-01", "least", None),
        ("5", 2147483647, "sale", 1, "v", "1995-01", "most", 1.0), ("9", 1, "sale", 1, "v", "1995-01", "nowhere", 1.0)], attrs)
    f = spark.createDataFrame([("1", "V", "c1", "v", 1), ("2", "V", "c1", "v", 1), ("3", "V", "c3", "v", 1), ("4", "W", "c4", "v", 1), ("5", "X", "c5", "v", 1),
                               ("5", "Y", None, "v", 1)], "cid string, visit_iid string, channel_click_id string, vertical_id string, product_id int")
    names = ["en_visit_iid", "en_channel_click_id", "business_legal_structure", "application_annual_revenue"]
    known = [("V", "c1", "b", 7.0), ("X", "c5", "least", None), ("Y", None, "least", None)]
    out = X.attribute_first_version(e, f, ExtractParams(vertical_ids=["v"])).select(*names)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(known, key=str)
    # without conditions on the funnel, rows without a click stay, as in a left join
    out = X.attribute_first_version(e, f, ExtractParams()).select(*names)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([*known, (None, None, "nowhere", 1.0)], key=str)
    same = X.attribute_first_version(e.withColumn("rn", F.col("rn").cast("double")), f, ExtractParams(vertical_ids=["v"])).select(*names)
    assert sorted(map(tuple, same.collect()), key=str) == sorted(known, key=str)
