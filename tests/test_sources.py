import pytest
from helpers import rows

from tallytide.operators.joins import missing_samples, present_samples
from tallytide.operators.reshape import clean_counts, melt_matrix, select_known_samples
from tallytide.operators.quality import cell_report
from tallytide.plans import ingest, ingest_files
from tallytide.sources import (
    read_annotation,
    read_count_matrix,
    read_sample_metadata,
    read_table,
    write_result,
    write_table,
)

HEADER = "sample,replicate,time,hours,time_label,sample_ID"


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("end", ["\r", "\n", "\r\n"])
def test_metadata_line_ends(spark, tmp_path, end):
    lines = [HEADER, "s1,A,1,0,0 h,1A", "s2,B,1,0,0 h,1B", "s3,A,2,12,12 h,2A"]
    meta = read_sample_metadata(spark, put(tmp_path / "m.csv", end.join(lines)))
    assert meta.columns == [
        "full_sample_name", "replicate", "time_point", "hours", "time_label", "sample_id",
    ]
    assert dict(meta.dtypes)["hours"] == "int"
    assert rows(meta, "sample_id", "hours") == [("1A", 0), ("1B", 0), ("2A", 12)]


def test_metadata_bad_cells_become_null(spark, tmp_path):
    path = put(tmp_path / "m.csv", f"{HEADER}\ns1,A,x,,l,1A\ns2,A,2.0,3,l,2A\n")
    assert rows(read_sample_metadata(spark, path), "sample_id", "time_point", "hours") == [
        ("1A", None, None), ("2A", 2, 3),
    ]


def test_missing_column_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="sample_ID"):
        read_sample_metadata(spark, put(tmp_path / "m.csv", "sample,replicate\na,b\n"))


def test_blank_header_is_renamed_by_position(spark, tmp_path):
    matrix = read_count_matrix(spark, put(tmp_path / "c.csv", ",1A,1B\ng1,3,4\ng2,5,\n"))
    assert matrix.columns == ["gene_id", "1A", "1B"]
    assert rows(matrix) == [("g1", "3", "4"), ("g2", "5", None)]


@pytest.mark.parametrize("header", [",1A,1B,1A", ",1A,1a", ",gene_id,1B"])
def test_repeated_header_is_rejected(spark, tmp_path, header):
    cells = ",".join("7" for _ in header.split(",")[1:])
    with pytest.raises(ValueError, match="repeated"):
        read_count_matrix(spark, put(tmp_path / "c.csv", f"{header}\ng1,{cells}\n"))


def test_annotation_keeps_four_columns(spark, tmp_path):
    text = (
        "Name,Symbol,ID,FlyBaseID,Functional Class,Immune Process\n"
        "n,sy,1,g1,receptor,IMD\n"
    )
    ann = read_annotation(spark, put(tmp_path / "a.csv", text))
    assert ann.columns == ["Symbol", "gene_id", "functional_class", "immune_process"]
    assert rows(ann) == [("sy", "g1", "receptor", "IMD")]


def test_dirty_cells(spark):
    cells = ["", "x", "12.0", "12.9", " 7 ", "1e3", "9223372036854775807", "12.9999999", None]
    long = spark.createDataFrame([(str(i), c or None) for i, c in enumerate(cells)],
                                 "gene_id string, raw_count string")
    assert rows(clean_counts(long)) == [
        ("1", None), ("2", 12), ("3", 12), ("4", 7), ("5", 1000), ("6", 2**63 - 1), ("7", 12),
    ]
    assert tuple(cell_report(long).first()) == (9, 2, 1)


def test_quoted_sample_names(spark):
    names = ["it's", "a`b", "c.d", 'e"f', "plain"]
    matrix = spark.createDataFrame([("g1", *"12345")], ["gene_id", *names])
    assert rows(melt_matrix(matrix)) == sorted(
        [("g1", n, str(i + 1)) for i, n in enumerate(names)], key=repr
    )
    meta = spark.createDataFrame([(n,) for n in names[:3]], "sample_id string")
    assert select_known_samples(matrix, meta).columns == ["gene_id", *names[:3]]


META = "sample_id string, hours int, time_point int, replicate string, time_label string"


def test_ingest_drops_unmatched_samples(spark):
    matrix = spark.createDataFrame(
        [("g1", "1", "2", "9"), ("g2", None, "x", "9")], "gene_id string, 1A string, 2A string, zz string"
    )
    meta = spark.createDataFrame(
        [("1A", 0, 1, "A", "0"), ("2A", 1, 2, "A", "1"), ("4B", 3, 4, "B", "3")], META
    )
    out = ingest(matrix, meta)
    assert out.columns == [
        "sample_id", "gene_id", "raw_count", "hours", "time_point", "replicate", "time_label",
    ]
    assert rows(out, "gene_id", "sample_id", "raw_count", "hours") == [
        ("g1", "1A", 1, 0), ("g1", "2A", 2, 1), ("g2", "2A", None, 1),
    ]
    header = present_samples(spark, matrix.columns[1:])
    assert rows(missing_samples(meta, header)) == [("4B",)]


def test_ingest_rejects_duplicate_keys(spark):
    meta = spark.createDataFrame([("1A", 0, 1, "A", "0")], META)
    twice = spark.createDataFrame([("g1", "1"), ("g1", "2")], "gene_id string, 1A string")
    with pytest.raises(ValueError, match="g1"):
        ingest(twice, meta)
    with pytest.raises(ValueError, match="1A"):
        ingest(twice.limit(1), meta.union(meta))
    assert ingest(twice, meta, check_keys=False).count() == 2


def test_files_to_partitioned_table(spark, tmp_path):
    matrix = put(tmp_path / "c.csv", ",1A,2A\ng1,3,4\ng2,5,6\n")
    meta = put(tmp_path / "m.csv", "\r".join([HEADER, "s1,A,1,0,0 h,1A", "s2,A,2,12,12 h,2A"]))
    out = ingest_files(spark, matrix, meta, str(tmp_path / "out"))
    assert (tmp_path / "out" / "hours=12").is_dir()
    assert rows(out, "gene_id", "sample_id", "raw_count", "hours") == [
        ("g1", "1A", 3, 0), ("g1", "2A", 4, 12), ("g2", "1A", 5, 0), ("g2", "2A", 6, 12),
    ]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(30)], "id int, t int, v double")
    write_table(df, str(tmp_path / "p"), "t")
    assert rows(read_table(spark, str(tmp_path / "p"), df.columns)) == rows(df)
    write_table(df.limit(3), str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p")).count() == 3
    for fmt in ("csv", "parquet"):
        write_result(df, str(tmp_path / fmt), fmt)
        back = spark.read.schema(df.schema).format(fmt).load(str(tmp_path / fmt), header=True)
        assert rows(back) == rows(df)
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path / "x"), "xls")
