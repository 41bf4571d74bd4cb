import datetime as dt

from pyspark.sql import functions as F

from tableops.operators import api, audit, forms, relations, snapshots, softdelete


def test_null_delete_flag(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _FIVETRAN_DELETED boolean")
    out = softdelete.soft_delete_filter(df)
    assert out.columns == ["id"] and [r.id for r in out.collect()] == [2]


def test_missing_target_table(spark):
    src = {"t": spark.range(10)}
    out = audit.count_audit(1, src, {}).collect()
    assert out[0]["source_count"] == 10 and out[0]["target_count"] == -1


def test_no_non_zero_source_keeps_results(spark):
    old = audit.count_audit(1, {"t": spark.range(3)}, {"t": spark.range(3)})
    new = audit.count_audit(1, {"t": spark.range(0)}, {"t": spark.range(3)})
    out = audit.retire_and_append(old, new, 1).collect()
    assert len(out) == 1 and out[0]["md_active_flag"] == "Y"


def test_retire_and_append(spark):
    old = audit.count_audit(1, {"t": spark.range(3)}, {"t": spark.range(3)}).unionByName(
        audit.count_audit(2, {"u": spark.range(4)}, {"u": spark.range(4)}))
    new = audit.count_audit(1, {"t": spark.range(5)}, {"t": spark.range(5)})
    flags = sorted((r.source_key, r.source_count, r.md_active_flag)
                   for r in audit.retire_and_append(old, new, 1).collect())
    assert flags == [(1, 3, "N"), (1, 5, "Y"), (2, 4, "Y")]


def test_status_routing(spark):
    codes = spark.createDataFrame([(2,), (11,), (5,)], "c int")
    out = [r[0] for r in codes.select(api.route(F.col("c"))).collect()]
    assert out == ["data", "retry", "error"]


def test_status_error_text(spark):
    body = ('<e><r>{"L": [], "Status": {"Code": 5, "Message": "bad &amp; worse"}}</r></e>')
    df = spark.createDataFrame([(1, "L", body)], "call_id long, header string, body string")
    from pyspark.sql import types as T
    parsed = api.parse_responses(df, "L", T.StructType([T.StructField("x", T.IntegerType())]))
    assert parsed.first()["error"] == "5 - bad & worse"


def test_retention_exact(spark):
    today = dt.date(2024, 3, 31)
    names = [(f"zBACKUP_DB_{(today - dt.timedelta(days=d)).strftime('%m_%d_%Y')}",)
             for d in (14, 15, 16)]
    plan = snapshots.retention_plan(spark.createDataFrame(names, "name string"), today)
    dropped = [r.age_days for r in plan.collect() if r.drop]
    assert dropped == [15]


def test_relationship_rules(spark):
    cols = [("FACT", "CUSTOMER_KEY"), ("CUSTOMER_DIM", "PKEY"), ("CUSTOMER_DFACT", "PKEY"),
            ("FACT", "SHIP_DATE_KEY"), ("FACT", "DATE_KEY"), ("FACT", "MONTH_DATE_KEY"),
            ("FACT", "MD_NATURAL_KEY")]
    columns = spark.createDataFrame(cols, "table_name string, column_name string")
    tables = columns.select("table_name").distinct().withColumn("table_schema", F.lit("PUBLIC"))
    edges = {(r.left_column, r.right_table)
             for r in relations.infer_relationships(tables, columns).collect()}
    assert ("CUSTOMER_KEY", "CUSTOMER_DIM") in edges and ("CUSTOMER_KEY", "CUSTOMER_DFACT") in edges
    assert ("SHIP_DATE_KEY", "DATE_DIM") in edges
    assert not any(c == "DATE_KEY" for c, _ in edges)
    assert ("MONTH_DATE_KEY", "MONTH_DIM_VIEW") in edges
    assert ("MONTH_DATE_KEY", "DATE_DIM") not in edges
    assert not any(c == "MD_NATURAL_KEY" for c, _ in edges)


def test_classify_notification(spark):
    df = spark.createDataFrame([("Smartsheet-Hook-Challenge: x",), ("Smartsheet-Foo",), ("Other",)],
                               "h string")
    assert [r[0] for r in df.select(forms.classify_notification("h")).collect()] == \
        ["challenge", "change", "ignored"]


def test_envelope_text_fast_path_equals_xpath(spark):
    bodies = [
        '<?xml version="1.0" encoding="utf-8"?>\n<soap:Envelope xmlns:soap="u"><soap:Body>'
        '<R a="x>y">{"k": "a &amp; b &lt;c&gt; &quot;q&quot; &apos;s&apos;"}</R></soap:Body>'
        '</soap:Envelope>\n',
        "<a> lead <b>mid</b> trail </a>",
        "<a><!-- c --><![CDATA[<raw>]]>&#65;x</a>",
        "<a><?pi data?>t</a>",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = df.select(api.envelope_text("body").alias("fast"),
                    F.xpath_string("body", F.lit("/")).alias("xp")).collect()
    assert all(r.fast == r.xp for r in out), [(r.fast, r.xp) for r in out]


def test_task_list_response(spark):
    body = ('<soap:Envelope xmlns:soap="http://www.w3.org/2003/05/soap-envelope"><soap:Body>'
            '<GetProjectTasksListResponse><GetProjectTasksListResult>'
            '{"ProjectTasksListInformation":[{"TaskID":"T1.5","TaskTypeLinkID":77,'
            '"Location":"Level 2&gt;Room 4","IssuedToPackageID":901,"Cost":12.5,'
            '"OverDue":false,"Closed":true,"ActualFinishDate":null,'
            '"LastModified":"2019-03-04T05:06:07"}],'
            '"Status":{"Code":2,"Message":"Success."}}'
            '</GetProjectTasksListResult></GetProjectTasksListResponse></soap:Body></soap:Envelope>')
    quota = body.replace('"Code":2', '"Code":11')
    df = spark.createDataFrame([(1, api.TASKS, body), (2, api.TASKS, quota),
                                (3, api.PROJECTS, "<x>{\"Status\":{\"Code\":9,\"Message\":\"m\"}}</x>")],
                               "call_id long, header string, body string")
    import datetime as _dt
    out = api.extract_all(df, {api.TASKS: api.TASK_ELEMENT,
                               api.PROJECTS: api.TASK_ELEMENT})
    tasks, retry, errors = out[api.TASKS]
    row = tasks.first()
    assert (row.TaskID, row.Location, row.IssuedToPackageID, row.Closed) == \
        ("T1.5", "Level 2>Room 4", 901, True)
    assert row.LastModified == _dt.datetime(2019, 3, 4, 5, 6, 7)
    assert [r.call_id for r in retry.collect()] == [2]
    assert [r.error for r in out[api.PROJECTS][2].collect()] == ["9 - m"]


def test_relationship_check_with_a_hot_key(spark):
    child = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("fk"))
    parent = spark.range(0, 2000).select(F.col("id").alias("pk"))
    row = relations.check_relationships({"c": child, "p": parent},
                                        [("c", "fk", "p", "pk")]).first()
    others = [i for i in range(3000) if i % 3]       # a third of the rows carry key 7
    assert row.child_rows == 3000 and row.keyed_rows == 3000
    assert row.child_keys == len(set(others) | {7})
    assert row.orphan_keys == len([i for i in others if i >= 2000])
    assert row.orphan_rows == row.orphan_keys


def test_request_windows_cover_month_end_ranges_without_gaps(spark):
    import datetime as _dt
    r = spark.createDataFrame([(_dt.date(2020, 1, 31), _dt.date(2021, 2, 2))],
                              "date_from date, date_to date")
    w = sorted((x.window_from, x.window_to) for x in api.request_windows(r).collect())
    assert w[0][0] == _dt.date(2020, 1, 31) and w[-1][1] == _dt.date(2021, 2, 2)
    for (f1, t1), (f2, _) in zip(w, w[1:]):
        assert t1 + _dt.timedelta(days=1) == f2            # contiguous, no gap
    for f, t in w:
        m = (t.year - f.year) * 12 + t.month - f.month
        assert m < 3 or (m == 3 and t.day < f.day)      # never more than three months
