"""Property tests: column builders against plain-Python models on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions.normalize import fold, parse_amount, parse_date, recode
from stratum.functions.rules import all_true, first_failure

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

amount_text = st.one_of(st.none(), st.text(alphabet="0123456789.,-", max_size=9))


def model_amount(s):
    if s is None:
        return None
    t = s.replace(".", "") if ("," in s and "." in s) else s
    t = t.replace(",", ".")
    try:
        return float(t)
    except ValueError:
        return None


@SETTINGS
@given(st.lists(amount_text, min_size=1, max_size=60))
def test_parse_amount_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", parse_amount("x").alias("y")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model_amount(v), (v, got[i])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBcD \t", max_size=6)), min_size=1,
                max_size=60))
def test_fold_and_recode_model(spark, values):
    mapping = {"ab": "X", "cd": "Y"}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", fold("x").alias("f"), recode(fold("x"), mapping).alias("r")).collect()
    for r in rows:
        v = values[r.i]
        folded = None if v is None else v.strip(" ").lower()
        assert r.f == folded
        assert r.r == (mapping.get(folded, folded) if folded is not None else None)


dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31))
date_text = st.one_of(
    dates.map(lambda d: d.strftime("%Y-%m-%d")),
    dates.map(lambda d: d.strftime("%d/%m/%Y")),
    dates.map(lambda d: d.strftime("%d-%m-%Y")),
    st.text(alphabet="0123456789-/", max_size=10),
    st.none())


def model_date(s):
    if s is None:
        return None
    for fmt, n in (("%Y-%m-%d", 10), ("%d/%m/%Y", 10)):
        if len(s) == n and s[4 if fmt.startswith("%Y") else 2] in "-/":
            try:
                d = dt.datetime.strptime(s, fmt).date()
            except ValueError:
                continue
            if d.strftime(fmt) == s:
                return d
    return None


@SETTINGS
@given(st.lists(date_text, min_size=1, max_size=60))
def test_parse_date_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", parse_date("x").alias("y")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model_date(v), (v, got[i])


tri = st.sampled_from([True, False, None])


@SETTINGS
@given(st.lists(st.tuples(tri, tri, tri, tri), min_size=1, max_size=40))
def test_first_failure_and_all_true_model(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, a boolean, b boolean, c boolean, d boolean")
    names = ["a", "b", "c", "d"]
    reason = first_failure([(F.col(n), f"r_{n}") for n in names])
    ok = all_true([F.col(n) for n in names])
    for r in df.select("i", reason.alias("reason"), ok.alias("ok")).collect():
        flags = rows[r.i]
        expected = next((f"r_{n}" for n, f in zip(names, flags) if f is True), None)
        assert r.reason == expected
        assert r.ok == all(f is True for f in flags)


tx_row = st.tuples(
    st.sampled_from([dt.date(2024, 1, 1), dt.date(2024, 1, 2)]),
    st.sampled_from(["MCH-00001", "MCH-00002"]),
    st.sampled_from(["web", "app", None]),
    st.sampled_from(["PEN", None]),
    st.sampled_from(["pago", "reversa", "retiro", None]),
    st.sampled_from(["aprobado", "rechazado"]),
    st.integers(min_value=1, max_value=400000).map(lambda q: q / 4.0))


@SETTINGS
@given(st.lists(tx_row, min_size=1, max_size=40), st.lists(tx_row, min_size=1, max_size=40))
def test_kpis_from_partials_equal_full_recompute(spark, first, second):
    from stratum.plans import gold
    cols = ("transaction_date date, merchant_id string, channel string, currency string, "
            "transaction_type string, status string, amount double")
    a, b = spark.createDataFrame(first, cols), spark.createDataFrame(second, cols)
    merged = gold.kpis_from_partials(gold.kpi_partials(a).unionByName(gold.kpi_partials(b)),
                                     with_timestamp=False)
    full = gold.daily_kpis(a.unionByName(b), with_timestamp=False)
    assert merged.columns == full.columns
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0
