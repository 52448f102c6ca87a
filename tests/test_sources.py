"""Readers, writers and validation on files with quotes, line breaks, marks and other encodings."""

import os

import pytest
from pyspark.sql import functions as F

from msgsift.operators.quality import DatasetValidationError
from msgsift.sources.delimited import read_messages, resolve_columns
from msgsift.sources.sinks import load_messages, write_messages
from msgsift.sources.validate import validate_dataset


def _file(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def _texts(df):
    label, text = resolve_columns(df)
    return [(r[0], r[1]) for r in df.orderBy("_order").select(label, text).collect()]


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_quoted_fields_by_default(spark, tmpdir_path, sep):
    body = sep.join(["label", "message"]) + "\n" + sep.join(["ham", '"say ""hi"" now, ok; fine\ttab"']) + "\n" + sep.join(
        ["spam", '"two\nlines"']) + "\n" + sep.join(["ham", "it's plain"]) + "\n"
    df, opts = read_messages(spark, _file(tmpdir_path, "q.csv", body))
    assert (opts.delimiter, opts.header) == (sep, True)
    assert _texts(df) == [("ham", 'say "hi" now, ok; fine\ttab'), ("spam", "two\nlines"), ("ham", "it's plain")]


def test_unbalanced_quote_without_quoting(spark, tmpdir_path):
    df, _ = read_messages(spark, _file(tmpdir_path, "u.tsv", 'ham\t"open quote\nspam\tnext "one\n'), quoting=False)
    assert _texts(df) == [("ham", '"open quote'), ("spam", 'next "one')]


def test_one_late_latin_byte_decides_the_encoding(spark, tmpdir_path):
    lines = [b"ham\tplain ascii line %d" % i for i in range(400)] + [b"spam\tcaf\xe9"]
    df, opts = read_messages(spark, _file(tmpdir_path, "latin", b"\n".join(lines) + b"\n"))
    assert opts.encoding == "latin-1" and _texts(df)[-1] == ("spam", "café")
    df, opts = read_messages(spark, _file(tmpdir_path, "utf", "\n".join(["ham\tplain"] * 400 + ["spam\tcafé"])))
    assert opts.encoding == "utf-8" and _texts(df)[-1] == ("spam", "café")


def test_byte_order_mark(spark, tmpdir_path):
    df, opts = read_messages(spark, _file(tmpdir_path, "bom.tsv", "\ufeffham\tfirst\nspam\tsecond\n"))
    assert not opts.header and _texts(df) == [("ham", "first"), ("spam", "second")]
    df, opts = read_messages(spark, _file(tmpdir_path, "bomh.csv", "\ufeffcategory,message\nham,first\nspam,second\n"))
    assert opts.header and _texts(df) == [("ham", "first"), ("spam", "second")]


def test_headers_by_other_names(spark, tmpdir_path):
    df, opts = read_messages(spark, _file(tmpdir_path, "o.csv", "kind,body\nham,one\nspam,two\n"))
    assert opts.header and _texts(df) == [("ham", "one"), ("spam", "two")]


@pytest.mark.parametrize("body", ["", "\n\n", "just words without any separator\nand more\n"])
def test_unreadable_files_raise(spark, tmpdir_path, body):
    with pytest.raises(DatasetValidationError):
        read_messages(spark, _file(tmpdir_path, "x", body))


def test_columns_that_cannot_be_told(spark, tmpdir_path):
    df, _ = read_messages(spark, _file(tmpdir_path, "n.csv", "text,other\nham,one\nmaybe,two\n"))
    with pytest.raises(DatasetValidationError):
        resolve_columns(df)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_messages_survive_a_round_trip(spark, tmpdir_path, fmt):
    rows = [(1, "ham", 'a "quoted", text\nwith a line'), (2, "spam", " leading; and trailing "), (3, "ham", ""), (4, "spam", "back\\slash \\\" end"), (5, "ham", "tab\there")]
    df = spark.createDataFrame(rows, "row_id long, label string, text string").repartition(2)
    path = os.path.join(tmpdir_path, fmt)
    write_messages(df, path, fmt=fmt)
    back = load_messages(spark, path, fmt=fmt).orderBy("row_id").collect()
    assert [tuple(r) for r in back] == rows


def test_loader_errors(spark, tmpdir_path):
    def save(rows, schema="row_id string, label string, text string"):
        path = os.path.join(tmpdir_path, f"t{abs(hash(str(rows) + schema))}")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return path

    with pytest.raises(DatasetValidationError, match="lacks"):
        load_messages(spark, save([("1", "ham")], "row_id string, label string"))
    with pytest.raises(DatasetValidationError, match="no rows"):
        load_messages(spark, save([]))
    with pytest.raises(DatasetValidationError, match="integers"):
        load_messages(spark, save([("x", "ham", "t")]))
    with pytest.raises(DatasetValidationError, match="spam"):
        load_messages(spark, save([("1", "ham", "t")]))
    with pytest.raises(DatasetValidationError) as e:
        load_messages(spark, save([(str(i), f"odd{i}", "t") for i in range(30)] + [("30", None, "t"), ("31", "ham", "t")]))
    listed = spark.read.parquet(str(e.value).rsplit("listed in ", 1)[1])
    assert listed.count() == 31


def test_validation_record(spark, tmpdir_path):
    raw = _file(tmpdir_path, "raw.csv", "v1,v2\nham,hello\nham,hello\nspam,win\n")
    out, rec = validate_dataset(spark, raw, f"{tmpdir_path}/out", f"{tmpdir_path}/summary", drop_duplicates=True)
    assert [(r.row_id, r.label, r.text) for r in out.orderBy("row_id").collect()] == [(1, "ham", "hello"), (2, "spam", "win")]
    want = {"raw_rows": 3, "validated_rows": 2, "ham_count": 1, "spam_count": 1, "duplicate_message_count": 2, "duplicate_message_groups": 1,
            "exact_duplicate_row_count": 2, "duplicate_messages_removed": 1, "delimiter": "comma", "encoding": "utf-8", "label_column": "v1",
            "text_column": "v2", "detected_columns": ["v1", "v2"], "input_file": raw, "missing_label_count": 0, "invalid_label_count": 0}
    assert want.items() <= rec.items() and len(rec) == 20
    stored = spark.read.json(f"{tmpdir_path}/summary").first().asDict()
    assert stored == rec


def test_invalid_file_writes_no_messages(spark, tmpdir_path):
    raw = _file(tmpdir_path, "bad.tsv", "ham\tfine\nmaybe\twhat\nspam\tx\n")
    with pytest.raises(DatasetValidationError):
        validate_dataset(spark, raw, f"{tmpdir_path}/none")
    assert not os.path.exists(f"{tmpdir_path}/none")


def test_numbers_follow_the_file(spark, tmpdir_path):
    raw = _file(tmpdir_path, "many.tsv", "".join(f"{'ham' if i % 2 else 'spam'}\ttext {i:04d}\n" for i in range(500)))
    out, _ = validate_dataset(spark, raw, f"{tmpdir_path}/many")
    assert out.where(F.col("text") != F.concat(F.lit("text "), F.lpad((F.col("row_id") - 1).cast("string"), 4, "0"))).count() == 0


def _messy(n, seed, sep=",", end="\n"):
    """Records with quotes, doubled quotes, delimiters and line breaks in fields, and stray quotes in plain ones."""
    import random
    rng = random.Random(seed)
    parts = ["free", "prize", '""', sep, "\n", "\n\n", end, "é", "漢字", " ", "it's", '""x""']
    rows = []
    for i in range(n):
        label = rng.choice(["ham", "spam", '"ham"'])
        if rng.random() < 0.6:
            text = '"' + "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) + '"'
        else:
            text = rng.choice(["plain words", 'a "stray" quote', "", 'ends with "', "tab\there" if sep != "\t" else "x", f"number {i}"])
        rows.append(f"{label}{sep}{text}")
    return rows


@pytest.mark.parametrize("sep,end,header", [(",", "\n", True), (";", "\r\n", True), ("\t", "\n", False)])
@pytest.mark.parametrize("split", [64, 1000, 10_000_000])
def test_split_quoted_files_equal_the_multiline_read(spark, tmpdir_path, sep, end, header, split):
    from msgsift.sources.delimited import ReadOptions
    folder = os.path.join(tmpdir_path, "in")
    os.makedirs(folder)
    for k in range(2):
        rows = ([f"label{sep}text"] if header else []) + _messy(150, k, sep, end)
        _file(folder, f"part-{k}.csv", end.join(rows) + (end if k else ""))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    reader = spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", "true").schema("label string, text string")
    want = sorted(map(tuple, reader.option("header", str(header).lower()).csv(folder).collect()), key=repr)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df, _ = read_messages(spark, folder, options=ReadOptions(sep, header, "utf-8"))
        got = df.orderBy("_order").collect()
        splits = len({(r._order.file, r._order.block) for r in got})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert sorted(((r.label, r.text) for r in got), key=repr) == want
    assert splits > 20 if split == 64 else splits >= 2
    one = [(r.label, r.text) for r in got if r._order.file.endswith("part-1.csv")]
    single = reader.option("header", str(header).lower()).csv(os.path.join(folder, "part-1.csv")).collect()
    assert one == [tuple(r) for r in single]  # one file is read in order


def test_numbering_and_counts_leave_the_texts_alone(spark, tmpdir_path):
    """Numbered rows lie in columns, and the counts of kept rows carry no text through the shuffle."""
    from msgsift.operators.quality import assign_row_id, dedup_keep_first
    rows = spark.createDataFrame([(i, "ham" if i % 3 else "spam", f"t{i % 5}") for i in range(40)], "k int, label string, text string")
    numbered = assign_row_id(rows, ["k"])
    assert "Relation [" in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert [r.row_id for r in numbered.orderBy("k").collect()] == list(range(1, 41))
    kept = dedup_keep_first(numbered, renumber=False, columns=["label"])
    assert kept.columns == ["row_id", "label"]
    full = dedup_keep_first(numbered, renumber=False)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.select("row_id", "label").collect()))


def test_first_records_of_files_are_found_without_a_window(spark, tmpdir_path):
    """Headers are left out of every file, whatever their line ends."""
    from msgsift.sources.quoted import read_quoted
    from pyspark.sql.types import StringType, StructField, StructType
    os.makedirs(f"{tmpdir_path}/two")
    _file(f"{tmpdir_path}/two", "a.csv", 'v1,v2\r\nham,"x\r\ny"\r\n')
    _file(f"{tmpdir_path}/two", "b.csv", '\nv1,v2\nspam,z\n')
    schema = StructType([StructField("v1", StringType()), StructField("v2", StringType())])
    df = read_quoted(spark, f"{tmpdir_path}/two", schema, sep=",", header=True, encoding="utf-8")
    assert sorted((r.v1, r.v2) for r in df.collect()) == [("ham", "x\ny"), ("spam", "z")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
