import pytest
from pyspark.sql import functions as F

from msgsift.operators import quality as Q


def test_duplicate_metrics_before_removal(spark):
    df = spark.createDataFrame([(1, "ham", "hello"), (2, "ham", "hello"), (3, "spam", "win")],
                               "row_id long, label string, text string")
    st = Q.duplicate_stats(df).first()
    assert (st.duplicate_message_count, st.duplicate_message_groups, st.exact_duplicate_row_count) == (2, 1, 2)
    ded = Q.dedup_keep_first(df).orderBy("row_id").collect()
    assert [(r.row_id, r.source_row_id) for r in ded] == [(1, 1), (2, 3)]


def test_bad_rows_raise_and_all_unknown_labels_are_listed(spark):
    rows = [(i, f"odd{i}", "x") for i in range(60)] + [(60, "ham", "ok"), (61, None, "y"), (62, "spam", " ")]
    df = spark.createDataFrame(rows, "row_id long, label string, text string")
    with pytest.raises(Q.DatasetValidationError) as e:
        Q.enforce_quality(df)
    msg = str(e.value)
    assert "1 rows lack a label" in msg and "1 rows lack a text" in msg and "60 unknown label values" in msg
    listed = spark.read.parquet(msg.rsplit("listed in ", 1)[1])
    assert {r.invalid_value for r in listed.collect()} == {f"odd{i}" for i in range(60)}
    ok, bad = Q.enforce_quality(df, mode="permissive")
    assert ok.count() == 1 and bad.count() == 62


def _scans(spark, run):
    """Rows that leave a counted source while ``run`` works."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    run(lambda df: df.mapInArrow(count, df.schema))
    return seen.value


def test_checked_write_is_one_scan_and_writes_nothing_on_bad_input(spark, tmpdir_path):
    import os

    from msgsift.sources.sinks import write_checked
    rows = [(i, "ham" if i % 3 else "1", f" text {i} ") for i in range(50)]
    bad = [(90, None, "x"), (91, "maybe", "y"), (92, "spam", " \t"), (93, "", None)]
    schema = "row_id long, label string, text string"
    good_df, bad_df = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + bad, schema)
    facts = {}
    n = _scans(spark, lambda tap: facts.update(write_checked(tap(good_df), f"{tmpdir_path}/m", f"{tmpdir_path}/q")))
    assert n == 50 and facts == {"raw_rows": 50, "missing_label_count": 0, "missing_text_count": 0, "invalid_label_count": 0, "bad_count": 0}
    got = sorted(map(tuple, spark.read.parquet(f"{tmpdir_path}/m").select("row_id", "label", "text").collect()))
    assert got == [(i, "ham" if i % 3 else "spam", f"text {i}") for i in range(50)] and not os.path.exists(f"{tmpdir_path}/q")
    with pytest.raises(Q.DatasetValidationError, match="2 rows lack a label, 2 a text and 1 have unknown"):
        write_checked(bad_df, f"{tmpdir_path}/m2", f"{tmpdir_path}/q2")
    assert not os.path.exists(f"{tmpdir_path}/m2")
    assert sorted(r.row_id for r in spark.read.parquet(f"{tmpdir_path}/q2").collect()) == [90, 91, 92, 93]
    n = _scans(spark, lambda tap: write_checked(tap(bad_df), f"{tmpdir_path}/m3", f"{tmpdir_path}/q3", permissive=True))
    assert n == 54 and spark.read.parquet(f"{tmpdir_path}/m3").count() == 50 and spark.read.parquet(f"{tmpdir_path}/q3").count() == 4


def test_in_plan_check_raises_when_a_bad_row_is_read(spark):
    schema = "row_id long, label string, text string"
    ok, _ = Q.enforce_quality(spark.createDataFrame([(1, "ham", "x")], schema), mode="in_plan")
    assert ok.count() == 1 and ok.first().label == "ham"
    bad, _ = Q.enforce_quality(spark.createDataFrame([(1, "ham", "x"), (2, "odd", "x")], schema), mode="in_plan")
    with pytest.raises(Exception, match="unknown label: odd"):
        bad.collect()


def test_json_requests(spark):
    from msgsift.streaming.requests import validate_json_requests
    bodies = {'{"text": "hello"}': "", '{"text":': "invalid_json", "": "invalid_json", None: "invalid_json", '{"text": "a", "phone": "+431"}': "extra_keys",
              '{"phone": 1}': "missing_text", "{}": "missing_text", '{"text": null}': "text_not_a_string", '{"text": 5}': "text_not_a_string",
              '{"text": ["a"]}': "text_not_a_string", '{"text": {"text": "a"}}': "text_not_a_string", "[1]": "not_an_object", '"x"': "not_an_object",
              "null": "not_an_object", '{"text": "  "}': "empty_text", '{"text": "' + "x" * 10_001 + '"}': "text_too_long",
              '{"text": "\\u00e9 \\n two"}': "", '{"Text": "a"}': "missing_text", '{"text": "a"} x': "invalid_json", '{"text": "a"}, {"text": "b"}': "invalid_json",
              '{"text": "a"}], [': "invalid_json", '{"text": "a"}}, {': "invalid_json", ' {"text": "a"} ': ""}
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "request_id string, body string")
    got = {r.request_id: r for r in validate_json_requests(df).collect()}
    assert {i: r.reject_reason for i, r in got.items()} == {str(i): why for i, why in enumerate(bodies.values())}
    assert all(r.accepted == (r.reject_reason == "") for r in got.values())
    assert got["0"].clean_text == "hello" and got["16"].clean_text == "é \n two" and got["4"].clean_text == ""


def test_assign_row_id_dense_in_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    out = Q.assign_row_id(df, ["k"], num_partitions=5).orderBy("k").collect()
    assert [r.row_id for r in out] == list(range(1, 1001))
