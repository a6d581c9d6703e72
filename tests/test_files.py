import pytest
from fixtures import HEADER, bag
from pyspark.sql import functions as F

from tallymart.operators import conform
from tallymart.schemas import FACT_COLUMNS, MANDATORY_COLUMNS
from tallymart.sources.files import (
    NoSalesData,
    escape_glob,
    file_inventory,
    first_line,
    header_lines,
    require_files,
    scanned_header_lines,
)

ROW = "1,121,sugar,2024-03-03,1,50,2,100"


def write(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def gate(spark, folder):
    files = file_inventory(spark, folder).filter("is_csv")
    return conform.gate_headers(conform.read_headers(spark, files))


def conformed(spark, folder):
    return conform.union_groups(spark, conform.header_groups(gate(spark, folder)))


def verdicts(spark, folder):
    names = F.regexp_extract("file_path", "([^/]+)$", 1)
    return {row[0]: row[1] for row in gate(spark, folder).select(names, "reason").collect()}


def test_inventory_lists_below_and_tells_kinds(spark, tmp_path):
    folder = write(tmp_path, {"a/x.csv": HEADER, "b/x.csv": HEADER, "note.txt": "hello", "UP.CSV": HEADER})
    listed = file_inventory(spark, folder)
    assert bag(listed, "file_name", "is_csv") == [("UP.CSV", False), ("note.txt", False)] + [("x.csv", True)] * 2
    assert listed.select("file_path").distinct().count() == 4
    assert bag(listed.filter("file_name = 'note.txt'"), "size_bytes") == [(5,)]


def test_files_of_no_bytes_are_not_listed(spark, tmp_path):
    folder = write(tmp_path, {"x.csv": HEADER, "empty.csv": ""})
    assert bag(file_inventory(spark, folder), "file_name") == [("x.csv",)]


def test_nothing_to_process(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(NoSalesData, match="no files"):
        require_files(file_inventory(spark, str(tmp_path / "empty")))
    with pytest.raises(NoSalesData, match="no CSV"):
        require_files(file_inventory(spark, write(tmp_path / "other", {"note.txt": "hello"})))


def test_gate(spark, tmp_path):
    folder = write(
        tmp_path,
        {
            "valid.csv": f"{HEADER}\n{ROW}\n",
            "extra.csv": f"{HEADER},payment_mode\n{ROW},cash\n",
            "reversed.csv": ",".join(reversed(HEADER.split(","))) + "\n" + ",".join(reversed(ROW.split(","))),
            "missing.csv": HEADER.replace("store_id,", "") + "\n",
            "case.csv": HEADER.replace("customer_id", "Customer_ID") + "\n",
            "twice.csv": f"{HEADER},Customer_ID\n{ROW},1\n",
            "spaced.csv": HEADER.replace(",store_id", ", store_id") + "\n",
            "header_only.csv": HEADER,
        },
    )
    assert verdicts(spark, folder) == {
        "valid.csv": None,
        "extra.csv": None,
        "reversed.csv": None,
        "missing.csv": conform.MISSING,
        "case.csv": conform.MISSING,
        "twice.csv": conform.DUPLICATE,
        "spaced.csv": conform.MISSING,
        "header_only.csv": None,
    }
    missing = gate(spark, folder).filter(F.col("file_path").endswith("/missing.csv"))
    assert bag(missing, "missing_columns") == [(["store_id"],)]


def test_both_ways_to_read_headers_agree(spark, tmp_path):
    long_name = "n" * 200_000
    folder = write(
        tmp_path,
        {
            "plain.csv": f"{HEADER}\n{ROW}\n",
            "windows.csv": f"{HEADER}\r\n{ROW}\r\n",
            "mac.csv": f"{HEADER}\r{ROW}\r",
            "marked.csv": b"\xef\xbb\xbf" + f"{HEADER}\n{ROW}\n".encode(),
            "blank_first.csv": f"\n  \n{HEADER}\n{ROW}\n",
            "long.csv": f"{long_name},{HEADER}\n1,{ROW}\n",
            "no_newline.csv": HEADER,
            "odd name+[1]{2} %41.csv": f"{HEADER}\n{ROW}\n",
        },
    )
    files = file_inventory(spark, folder)
    paths = [row["file_path"] for row in files.collect()]
    opened = bag(header_lines(files))
    assert len(opened) == 8
    assert opened == bag(scanned_header_lines(spark, paths))
    assert {line for path, line in opened if not path.endswith("long.csv")} == {HEADER}


class Blocks:
    """A stream that gives few bytes at a time and counts them."""

    def __init__(self, content, step):
        self.content, self.step, self.at = content, step, 0

    def read(self, n):
        block = self.content[self.at : self.at + min(n, self.step)]
        self.at += len(block)
        return block


@pytest.mark.parametrize("step", [1, 2, 3, 1 << 16])
def test_first_line_does_not_depend_on_blocks(step):
    for content, line in {
        b"": None,
        b"a,b": "a,b",
        b"\r\n \r\na,b\r\nc": "a,b",
        b"\xef\xbb\xbfa,b\n1,2\n": "a,b",
        b"\n\n\n": None,
        b"a\rb": "a",
        "ü,é\nx".encode(): "ü,é",
    }.items():
        assert first_line(Blocks(content, step)) == line, content


def test_a_line_without_end_is_no_header_and_is_not_read_on():
    endless = Blocks(b"x" * 5_000_000, 1 << 16)
    assert first_line(endless, 1 << 20) is None
    assert endless.at == 1 << 20
    assert first_line(Blocks(b"x" * 100 + b"\ny", 7), 101) == "x" * 100


def test_files_of_one_long_line_are_refused(spark, tmp_path):
    folder = write(tmp_path, {"long.csv": "x" * 3_000_000, "fine.csv": f"{HEADER}\n{ROW}\n"})
    assert verdicts(spark, folder) == {"long.csv": conform.MISSING, "fine.csv": None}
    files = file_inventory(spark, folder)
    paths = [row["file_path"] for row in files.collect()]
    assert bag(header_lines(files)) == bag(scanned_header_lines(spark, paths))


def test_each_file_is_read_by_the_way_its_store_allows(spark, tmp_path):
    """Files of a store that tasks cannot open, beside others; which comes first does not matter."""
    folder = write(tmp_path, {"a.csv": f"{HEADER}\n{ROW}\n", "b.csv": f"{HEADER},more\n{ROW},1\n"})
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.headers.link./in", f"file://{tmp_path}")
    mixed = spark.createDataFrame([("viewfs://headers/in/a.csv",), (f"file://{folder}/b.csv",)], "file_path string")
    found = {path: line for path, line in bag(conform.read_headers(spark, mixed))}
    assert found == {"viewfs://headers/in/a.csv": HEADER, f"file://{folder}/b.csv": f"{HEADER},more"}


def test_odd_file_names_are_read_literally(spark, tmp_path):
    names = ["a b.csv", "a+b.csv", "x[1].csv", "x1.csv", "p%41.csv", "{z}.csv", "ü.csv"]
    folder = write(tmp_path, {name: f"{HEADER}\n{ROW}\n" for name in names})
    rows = conformed(spark, folder)
    found = bag(rows.select(F.regexp_extract("file_path", "([^/]+)$", 1)))
    assert found == sorted(((name,) for name in names), key=repr)
    listed = {row["file_path"] for row in file_inventory(spark, folder).collect()}
    assert {row["file_path"] for row in rows.collect()} == listed
    assert escape_glob("s3://b/x[1].csv") == r"s3://b/x\[1\].csv"


def test_columns_are_found_by_name(spark, tmp_path):
    backwards = ",".join(reversed(HEADER.split(","))) + "\n" + ",".join(reversed(ROW.split(",")))
    folder = write(tmp_path, {"valid.csv": f"{HEADER}\n{ROW}\n", "reversed.csv": backwards})
    rows = bag(conformed(spark, folder), *FACT_COLUMNS)
    assert len(rows) == 2
    assert rows[0] == rows[1]


def test_extra_columns_fold_in_name_order_without_nulls(spark, tmp_path):
    folder = write(
        tmp_path,
        {"two.csv": f"payment_mode,{HEADER},channel\ncash,{ROW},web\n,{ROW},shop\n,{ROW},\n", "none.csv": f"{HEADER}\n{ROW}"},
    )
    assert bag(conformed(spark, folder), "additional_column") == [
        ("",),
        ("shop",),
        ("web, cash",),
        (None,),
    ]


def test_repeated_extra_columns_are_kept(spark, tmp_path):
    folder = write(tmp_path, {"x.csv": f"{HEADER},note,note,\n{ROW},a,b,c\n"})
    assert bag(conformed(spark, folder), "additional_column") == [("c, a, b",)]


def test_quoted_header_names(spark, tmp_path):
    quoted = ",".join(f'"{name}"' for name in HEADER.split(","))
    folder = write(tmp_path, {"x.csv": f'{quoted},"a,b"\n{ROW},"c,d"\n'})
    assert bag(conformed(spark, folder), "customer_id", "additional_column") == [(1, "c,d")]


def test_unreadable_fields_mark_the_row(spark, tmp_path):
    lines = [
        ROW,
        "1,121,sugar,bad,1,50,2,100",
        "x,121,sugar,2024-03-03,1,50,2,1e",
        "1.0,121,sugar,2024-03-03 10:00:00,1,50,2.0,100.50",
        "1,121,sugar,2024,1,50,2,100",
        "1.5,121,sugar,2024-03-03,1,50,2,100",
        ",121,sugar,,1,,,",
        "1,121,sugar",
    ]
    folder = write(tmp_path, {"x.csv": "\n".join([HEADER, *lines])})
    rows = conformed(spark, folder)
    assert bag(rows.filter("size(failed_columns) > 0"), "failed_columns") == [
        (["customer_id", "total_cost"],),
        (["customer_id"],),
        (["row_width"],),
        (["sales_date"],),
        (["sales_date"],),
    ]
    assert conform.facts_only(rows).count() == 3
    bad = rows.filter("array_contains(failed_columns, 'sales_date')").select(
        F.get_json_object("raw_row", "$.sales_date")
    )
    assert bag(bad) == [("2024",), ("bad",)]
    assert rows.filter("size(failed_columns) = 0 AND raw_row IS NOT NULL").isEmpty()


def test_torn_rows_are_quarantined_with_their_line(spark, tmp_path):
    sound = "1,121,sugar,2024-03-01,1,50,1,50"
    torn = [sound + ",surplus", '1,121,"broken,2024-03-03,1,50,1,7', "1,121,sugar"]
    rows = conformed(spark, write(tmp_path, {"x.csv": "\n".join([HEADER, sound, *torn])}))
    failed = rows.filter("size(failed_columns) > 0").select("failed_columns", "raw_row").collect()
    assert sorted(r["raw_row"] for r in failed) == sorted(torn)
    assert all(r["failed_columns"] == [conform.ROW_WIDTH] for r in failed)
    assert rows.filter("size(failed_columns) = 0").count() == 1


def test_header_only_file_has_no_rows(spark, tmp_path):
    assert conformed(spark, write(tmp_path, {"x.csv": HEADER})).count() == 0


def test_no_accepted_file_gives_an_empty_typed_frame(spark, tmp_path):
    empty = conformed(spark, write(tmp_path, {"x.csv": "a,b\n1,2\n"}))
    assert empty.count() == 0
    assert empty.columns[: len(FACT_COLUMNS)] == list(FACT_COLUMNS)


def test_refused_files_keep_every_line(spark, tmp_path):
    folder = write(tmp_path, {"x.csv": "a,b\n1,2\n3,4\n", "y.csv": f"{HEADER}\n{ROW}"})
    groups = conform.header_groups(gate(spark, folder))
    lines = conform.refused_lines(spark, groups)
    assert bag(lines, "raw_line", "reason") == [(line, conform.MISSING) for line in ("1,2", "3,4", "a,b")]


def test_values_are_made_once_for_a_row_and_its_failures(spark):
    rows = spark.createDataFrame([("1", "x", "in"), ("2", "n/a", "in")], "_c0 string, _c1 string, file_path string")
    others = {f"_c{at}": F.col("_c0") for at in range(2, len(MANDATORY_COLUMNS))}
    rows = rows.withColumns(others | {"torn_row": F.lit(None).cast("string")})
    conformed = conform.conform_group(rows, MANDATORY_COLUMNS)

    def casts(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("decimal(38,6)")

    assert casts(conformed) == casts(conformed.select(*MANDATORY_COLUMNS)) > 0
    assert [row["failed_columns"] for row in conformed.collect()] == [["store_id", "sales_date"]] * 2
