"""Column cleanup, one-hot encoding, buckets and dashboard roll-ups."""

import pytest
from pyspark.sql import functions as F

from churnlens.functions.names import snake_name
from churnlens.functions.columns import confidence_level, risk_category, tenure_category
from churnlens.operators import onehot, profile
from churnlens.plans import dashboard as dash
from churnlens.sources import ingest


def test_header_names():
    got = [snake_name(c) for c in ingest.RAW_CUSTOMER_HEADER]
    assert got == [c for c in ingest.CUSTOMER_COLUMNS if c != "mobile_number"]


@pytest.mark.parametrize("text,name", [
    ("Monthly Charges (USD)", "monthly_charges_usd"), ("Bank transfer (automatic)", "bank_transfer_automatic"),
    ("Month-to-month", "month_to_month"), ("payment_method_Credit (x)", "payment_method_credit_x"), ("DSL", "dsl"),
    ("DSLLine", "dsl_line"), (0, "0"), ("__a  b__", "a_b"), ("TVShow2", "tv_show2"), ("", "")])
def test_names(text, name):
    assert snake_name(text) == name


def test_onehot(spark):
    df = spark.createDataFrame(
        [("1", "Male", 0, "Yes", 1.0), ("2", "Female", 1, "No", None), ("3", None, 1, None, 2.0)],
        "customer_id string, gender string, senior_citizen int, churn string, total_charges double")
    out = onehot.customer_features(df)
    assert sorted(out.columns) == sorted(["customer_id", "churn", "total_charges", "gender_female",
                                          "gender_male", "senior_citizen_0", "senior_citizen_1"])
    rows = {r["customer_id"]: r for r in out.collect()}
    assert set(rows) == {"1", "3"}  # row 2 has a null total -> dropped
    assert rows["3"]["gender_male"] == 0 and rows["3"]["gender_female"] == 0
    assert rows["3"]["churn"] == 0 and rows["1"]["churn"] == 1
    assert rows["1"]["senior_citizen_0"] == 1


def test_onehot_collision(spark):
    df = spark.createDataFrame([("a b", "x"), ("a-b", "y")], "contract string, churn string")
    with pytest.raises(ValueError):
        onehot.customer_features(df, {"contract": ["a b", "a-b"]})


@pytest.mark.parametrize("p,risk,conf", [
    (0.8, "High Risk", "High Confidence"), (0.7999, "Medium Risk", "High Confidence"),
    (0.6, "Medium Risk", "Medium Confidence"), (0.4, "Low Risk", "Low Confidence"),
    (0.3999, "Very Low Risk", "Low Confidence"), (0.9, "High Risk", "Very High Confidence"),
    (0.5, "Low Risk", "Medium Confidence"), (None, "Very Low Risk", "Low Confidence")])
def test_buckets(spark, p, risk, conf):
    r = spark.createDataFrame([(p,)], "p double").select(
        risk_category("p").alias("r"), confidence_level("p").alias("c")).first()
    assert (r["r"], r["c"]) == (risk, conf)


@pytest.mark.parametrize("t,label", [(60, "Long-term (>5 years)"), (59, "Medium-term (2-5 years)"),
                                     (24, "Medium-term (2-5 years)"), (12, "Short-term (1-2 years)"),
                                     (11, "New (<1 year)"), (0, "New (<1 year)")])
def test_tenure_buckets(spark, t, label):
    assert spark.createDataFrame([(t,)], "t int").select(tenure_category("t")).first()[0] == label


def test_dashboard_and_kpis(spark):
    pred = spark.createDataFrame([("1", 1, [0.1, 0.9]), ("2", 0, [0.55, 0.45]), ("3", 1, [0.3, 0.7])],
                                 "customer_id string, prediction int, probability array<double>")
    feat = spark.createDataFrame([("1", 1, 70, 10.0, 700.0), ("2", 1, 5, 20.0, 100.0),
                                  ("3", 0, 24, 30.0, 720.0), ("4", 0, 1, 1.0, 1.0)],
                                 "customer_id string, churn int, tenure int, monthly_charges double, total_charges double")
    d = dash.dashboard_rows(pred, feat)
    assert d.count() == 3
    k = dash.kpi_summary(d).first()
    assert k["total_customers"] == 3 and k["churned_customers"] == 2
    assert k["prediction_accuracy"] == pytest.approx(1 / 3)
    assert k["high_risk_customers"] == 1 and k["medium_risk_customers"] == 1
    assert k["total_revenue"] == pytest.approx(720.0)
    r = dash.revenue_at_risk(d).first()
    assert r["customers_at_risk"] == 2 and r["revenue_at_risk"] == pytest.approx(480.0)
    # risk buckets partition the rows
    assert dash.risk_distribution(d).agg(F.sum("customer_count")).first()[0] == 3


def test_null_profile_and_describe(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, 5.0)], "a int, b double")
    nulls = {r["column_name"]: r["null_count"] for r in profile.null_profile(df).collect()}
    assert nulls == {"a": 1, "b": 1}
    d = {r["column_name"]: r for r in profile.describe_numeric(df).collect()}
    assert d["b"]["count"] == 2 and d["b"]["mean"] == 4.0 and d["a"]["max"] == 2.0


def test_csv_roundtrip_keeps_blank_and_null(spark, tmp_path):
    df = spark.createDataFrame([("1", " ", None), ("2", "150", "555-1")],
                               "customer_id string, total_charges string, mobile_number string")
    ingest.write_csv(df, str(tmp_path / "c"))
    back = ingest.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_feature_table_lifecycle(spark, tmp_path):
    from churnlens.sources import feature_table as ft
    ingest.ensure_schema(spark, "churnlens_test")
    assert ingest.use_schema(spark, "churnlens_test") == "churnlens_test"
    spark.catalog.setCurrentDatabase("default")
    name = "churnlens_test.features"
    ft.drop_table(spark, name)
    df = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "customer_id string, x double")
    assert ft.create_table(spark, name, df, ["customer_id"], "Graph features", str(tmp_path / "t")) == 2
    meta = ft.get_table(spark, name)
    assert meta["primary_keys"] == ["customer_id"] and meta["description"] == "Graph features"
    assert ft.write_table(spark, name, df.limit(1)) == 1
    dup = spark.createDataFrame([("1", 1.0), ("1", 2.0)], "customer_id string, x double")
    with pytest.raises(ValueError):
        ft.create_table(spark, name, dup, ["customer_id"], "bad")
    assert ft.key_violations(dup, ["customer_id"]).count() == 1
    ft.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_csv_keeps_every_array_element(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.1, 0.2, 0.7]), ("b", None)], "id string, p array<double>")
    ingest.write_csv(df, str(tmp_path / "flat"), {"p": 3})
    flat = sorted(spark.read.option("header", True).csv(str(tmp_path / "flat")).collect())
    assert [tuple(r) for r in flat] == [("a", "0.1", "0.2", "0.7"), ("b", None, None, None)]
    ingest.write_csv(df, str(tmp_path / "json"))
    assert "[0.1,0.2,0.7]" in {r.p for r in spark.read.options(header=True, escape="\\").csv(str(tmp_path / "json")).collect()}
    with pytest.raises(Exception, match="has not 2 elements"):
        ingest.write_csv(df, str(tmp_path / "bad"), {"p": 2})


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_call_times_are_utc_in_any_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-01-01T12:00:00Z",), ("2024-01-01T12:00:00+02:00",), ("2024-01-01 12:00:00",),
                                    ("2024-01-01",), ("no time",), (None,)], "datatime string")
        got = [str(r.t) for r in ingest.silver_call_log(df).select(F.col("datatime").cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-01-01 12:00:00", "2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-01 00:00:00", "None", "None"]


def test_feature_table_writes_by_name_and_checks_keys(spark, tmp_path):
    from churnlens.sources import feature_table as ft
    name = "churnlens_test_features"
    ft.drop_table(spark, name)
    make = lambda rows, cols: spark.createDataFrame(rows, cols)
    ft.create_table(spark, name, make([("a", 1.0, 2.0)], "customer_id string, x double, y double"), ["customer_id"], "d", str(tmp_path / "t"))
    ft.write_table(spark, name, make([("b", 2.0, 1.0)], "customer_id string, y double, x double"))
    assert [tuple(r) for r in ft.read_table(spark, name).collect()] == [("b", 1.0, 2.0)]
    for bad in (make([("b", 1.0, 1.0), ("b", 2.0, 2.0)], "customer_id string, x double, y double"),
                make([(None, 1.0, 1.0)], "customer_id string, x double, y double"),
                make([("b", 1.0)], "customer_id string, x double")):
        with pytest.raises(ValueError):
            ft.write_table(spark, name, bad)
    ft.drop_table(spark, name)


def test_id_like_column_is_refused_before_it_is_collected(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("contract"), F.lit("a").alias("gender"))
    with pytest.raises(ValueError, match="contract"):
        onehot.collect_vocabulary(df)
    assert onehot.collect_vocabulary(df, ["gender"]) == {"gender": ["a"]}


def test_two_folders_of_one_name_keep_apart(spark, tmp_path):
    import __spark_entry__ as entry
    src = "/root/testdata/sf0.001"
    out = []
    for k in (0, 1):
        folder = tmp_path / str(k) / "sf"
        folder.mkdir(parents=True)
        for t in ("customer", "orders"):
            df = spark.read.parquet(f"{src}/{t}.parquet")
            (df if k else df.where("c_custkey < 50" if t == "customer" else "o_custkey < 50")).write.parquet(str(folder / f"{t}.parquet"))
        out.append([entry.queries()[q](spark, str(folder)) for q in ("csv_roundtrip", "table_roundtrip")])
    assert [[df.count() for df in x] for x in out] == [[50, 50], [150, 150]]


def test_three_source_files_to_layers(spark, tmp_path):
    from churnlens.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    s, calls = fx.subscribers(spark, sf), fx.call_log(spark, sf)
    ingest.write_csv(s.drop("mobile_number"), str(tmp_path / "c"))
    ingest.write_csv(fx.customer_mobile(spark, sf), str(tmp_path / "m"))
    ingest.write_csv(calls, str(tmp_path / "l"))
    bronze = ingest.bronze_tables(spark, *[str(tmp_path / x) for x in "cml"])
    layers = ingest.layered_tables(bronze)
    assert layers["silver_customers"].count() == s.count() and layers["silver_call_log"].count() == calls.count()
    assert sorted(map(tuple, layers["edges"].select("dst", "src").collect()), key=str) == sorted(
        map(tuple, fx.edges(spark, sf).select("dst", "src").collect()), key=str)


def _file(path, *lines):
    path.mkdir()
    (path / "part-0.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    mobile = _file(tmp_path / "m", "mobileNumber,note,customerID", "555-1,x,A", ",y,B")
    rows = ingest.read_csv(spark, mobile, ingest.MOBILE_SCHEMA)
    assert sorted(map(tuple, rows.collect()), key=str) == [("A", "555-1"), ("B", None)]
    calls = _file(tmp_path / "l", "duration,callee_mobile_number,datatime,caller_mobile_number", "9,555-2,2024-01-01T00:00:00Z,555-1")
    row, = ingest.read_csv(spark, calls, ingest.CALL_LOG_SCHEMA).collect()
    assert (row.caller_mobile_number, row.callee_mobile_number, row.duration) == ("555-1", "555-2", 9)
    header = list(reversed(ingest.RAW_CUSTOMER_HEADER))
    customers = _file(tmp_path / "c", ",".join(header), ",".join("7" if c in ("tenure", "SeniorCitizen", "MonthlyCharges") else c for c in header))
    bronze = ingest.bronze_tables(spark, customers, mobile, calls)
    row, = bronze["customers"].collect()
    assert row.customer_id == "customerID" and row.tenure == 7 and row.churn == "Churn" and row.monthly_charges == 7.0
    assert bronze["customers"].columns == [c for c in ingest.CUSTOMER_COLUMNS if c != "mobile_number"]
    assert bronze["quarantine"].count() == 0
    assert [r.mobile_number for r in ingest.layered_tables(bronze)["silver_customers"].collect()] == [None]


def test_csv_missing_and_repeated_columns_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="mobile_number.*missing"):
        ingest.read_csv(spark, _file(tmp_path / "a", "customer_id,phone", "A,1"), ingest.MOBILE_SCHEMA)
    with pytest.raises(ValueError, match="both customer_id"):
        ingest.read_csv_checked(spark, _file(tmp_path / "b", "customerID,customer_id,mobile_number", "A,B,1"), ingest.MOBILE_SCHEMA)
    two = _file(tmp_path / "c", "customer_id,mobile_number", "A,1")
    (tmp_path / "c" / "part-1.csv").write_text("mobile_number,customer_id\n2,B\n")
    with pytest.raises(Exception):
        ingest.read_csv(spark, two, ingest.MOBILE_SCHEMA).collect()


def test_bad_csv_rows_go_to_the_quarantine(spark, tmp_path):
    header = "duration,callee_mobile_number,caller_mobile_number,datatime"
    lines = ["9,555-2,555-1,t1", "10,555-2", "ten,555-3,555-1,t2", "11,555-4,555-1,t3,more", ",555-5,555-1,t4"]
    good, bad = ingest.read_csv_checked(spark, _file(tmp_path / "l", header, *lines), ingest.CALL_LOG_SCHEMA, "call_log")
    assert sorted((r.datatime, r.duration) for r in good.collect()) == [("t1", 9), ("t4", None)]
    assert good.select("datatime").count() == 2  # the same with fewer columns read
    assert sorted(r.record for r in bad.collect()) == sorted(lines[1:4])
    assert {(r.source, r.file.endswith("part-0.csv")) for r in bad.collect()} == {("call_log", True)}
    assert [tuple(r) for r in ingest.quarantine_counts(bad).collect()] == [("call_log", 3)]
    with pytest.raises(Exception):
        ingest.read_csv(spark, str(tmp_path / "l"), ingest.CALL_LOG_SCHEMA).collect()


def test_renamed_columns_give_few_constraints(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    names = [f"col_{c}" for c in "abcdefghij"]
    raw = [f"Col{c}" for c in "ABCDEFGHIJ"]
    schema = StructType([StructField(n, StringType()) for n in names])
    good, bad = ingest.read_csv_checked(spark, _file(tmp_path / "w", ",".join(raw), ",".join("abcdefghij"), "a,b"), schema)
    assert [tuple(r) for r in good.collect()] == [tuple("abcdefghij")] and good.select("col_c").count() == 1
    assert [r.record for r in bad.collect()] == ["a,b"]
    assert good._jdf.queryExecution().optimizedPlan().validConstraints().size() < 100  # not 2 to the number of columns


def test_failing_writes_leave_the_table(spark, tmp_path):
    from churnlens.sources import feature_table as ft
    from churnlens.sources.versions import previous_version
    name = "churnlens_test_versions"
    ft.drop_table(spark, name)
    rows = lambda df: sorted(map(tuple, df.collect()))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, x int")
    ft.create_table(spark, name, df, ["customer_id"], "first", str(tmp_path / "t"))
    assert previous_version(spark, name) is None
    broken = df.withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("x")).cast("int"))
    for write in (lambda: ft.write_table(spark, name, broken), lambda: ft.create_table(spark, name, broken, ["customer_id"], "bad"),
                  lambda: ingest.write_table(broken, name), lambda: ft.write_table(spark, name, df.union(df))):
        with pytest.raises(Exception):
            write()
        assert rows(spark.table(name)) == [("a", 1), ("b", 2)] and ft.get_table(spark, name)["description"] == "first"
    # a table replaced by what is read from it, then by other columns
    assert ft.write_table(spark, name, spark.table(name).withColumn("x", F.col("x") * 10)) == 2
    assert rows(spark.table(name)) == [("a", 10), ("b", 20)] and rows(previous_version(spark, name)) == [("a", 1), ("b", 2)]
    assert ingest.write_table(df.withColumn("y", F.lit("z")), name, str(tmp_path / "u")) == 2
    assert spark.table(name).columns == ["customer_id", "x", "y"] and rows(previous_version(spark, name)) == [("a", 10), ("b", 20)]
    assert ft.get_table(spark, name) == {"name": name, "primary_keys": ["customer_id"], "description": "first"}
    ft.drop_table(spark, name)


def test_current_namespace(spark):
    ingest.ensure_schema(spark, "churnlens_test")
    ingest.use_schema(spark, "churnlens_test")
    assert ingest.current_namespace(spark) == ("spark_catalog", "churnlens_test")
    spark.catalog.setCurrentDatabase("default")
    assert ingest.current_namespace(spark) == ("spark_catalog", "default")
