"""Code tables out of label text."""

import pytest
from pyspark.sql import functions as F

from landfall.operators.labels import label_headers, label_tables, parse_labels
from landfall.sources.readers import read_lines

TEXT = """/* I94CIT & I94RES - valid and invalid codes */
value cntry
   101 =  'Albania'
   102 =  'Andorra'
   999 =  'Last Row' ;
/* I94PORT - port codes */
   'ALC'\t=\t'ALCAN, AK             '
   'XXX'\t=\t'NOT REPORTED          '
   'WAS'\t=\t'A, B, C'
;
/* I94MODE - mode of entry */
\t1 = 'Air'
\t2 = 'Sea'
;
/* I94ADDR - state codes */
\t'AL'='ALABAMA'
\t'AK'='ALASKA'
;
/* I94VISA - visa categories
   1 = Business
   2 = Pleasure
*/
"""


def entries_of(spark, folder):
    return parse_labels(read_lines(spark, str(folder)))


def listed(entries):
    rows = entries.select("block_key", "code", "value").collect()
    return sorted(tuple(r) for r in rows)


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode("utf-8"))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [None, "64"])
def test_five_tables(spark, tmp_path, end, split):
    """Also with splits of 64 bytes, so that headers lie in earlier splits."""
    put(tmp_path / "in", "labels.txt", TEXT.replace("\n", end))
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        entries = entries_of(spark, tmp_path / "in")
        if split:
            assert read_lines(spark, str(tmp_path / "in")).select("block").distinct().count() > 3
        tables = {
            name: sorted(tuple(r) for r in frame.collect())
            for name, frame in label_tables(entries).items()
        }
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tables == {
        "I94CIT_I94RES_Code": [("101", "ALBANIA"), ("102", "ANDORRA")],
        "I94Port_Code": [("ALC", "ALCAN", "AK"), ("XXX", "NOT REPORTED", None)],
        "I94Mode_Code": [("1", "AIR"), ("2", "SEA")],
        "I94Addr_Code": [("AK", "ALASKA"), ("AL", "ALABAMA")],
        "I94Visa_Code": [("1", "BUSINESS"), ("2", "PLEASURE")],
    }


def test_column_names(spark, tmp_path):
    put(tmp_path / "in", "labels.txt", TEXT)
    columns = {n: f.columns for n, f in label_tables(entries_of(spark, tmp_path / "in")).items()}
    assert columns["I94Port_Code"] == ["I94port_Code", "City", "State"]
    assert columns["I94CIT_I94RES_Code"] == ["I94CIT_I94RES_Code", "Country"]


def test_keys_do_not_cross_files(spark, tmp_path):
    put(tmp_path / "in", "a.txt", "/* A - a */\n1 = x\n")
    put(tmp_path / "in", "b.txt", "2 = before any header\n/* B - b */\n3 = y\n")
    assert listed(entries_of(spark, tmp_path / "in")) == [("A", "1", "X"), ("B", "3", "Y")]


def test_block_corner_cases(spark, tmp_path):
    put(
        tmp_path / "in",
        "a.txt",
        "/* ONE - single entry */\n1 = a\n;\n/* TWO - repeated */\n2 = b\n3 = c\n;\n"
        "/* NODASH-*/\n4 = d\n/* TWO - again */\n5 = ' e  f '\n6 = open at the end",
    )
    assert listed(entries_of(spark, tmp_path / "in")) == [
        ("NODASH-*/", "4", "D"),
        ("ONE", "1", "A"),
        ("TWO", "2", "B"),
        ("TWO", "3", "C"),
        ("TWO", "5", " E  F "),
        ("TWO", "6", "OPEN AT THE END"),
    ]


def test_descriptions(spark, tmp_path):
    put(tmp_path / "in", "labels.txt", TEXT)
    rows = label_headers(read_lines(spark, str(tmp_path / "in"))).collect()
    found = {r.block_key: r.description for r in rows}
    assert found["I94MODE"] == "mode of entry"
    assert found["I94VISA"] == "visa categories"


def test_rare_line_ends_and_white_space(spark, tmp_path):
    put(tmp_path / "in", "a.txt", "/* K - k */\x0b1 = 'a'  2\x1f= b\x852 = c")
    assert listed(entries_of(spark, tmp_path / "in")) == [
        ("K", "1", "A"), ("K", "2", "B"), ("K", "2", "C"),
    ]


def brute_force(text):
    key, found = None, []
    for line in text.split("\n"):
        if "/*" in line and "-" in line:
            key = line.split(" - ")[0].replace("/* ", "")
        elif "=" in line and ";" not in line and key is not None:
            code, value = (p.strip().replace("'", "").upper() for p in line.split("=")[:2])
            found.append((key, code, value))
    return sorted(found)


def test_large_file_in_many_splits(spark, tmp_path):
    lines = []
    for i in range(20000):
        if i % 977 == 5:
            lines.append(f"/* KEY{i % 13} - block {i} */")
        elif i % 11 == 0:
            lines.append("noise")
        elif i % 17 == 0:
            lines.append(f" 'x{i}' = 'closed' ;")
        else:
            lines.append(f"  '{i}' = 'value {i % 7}, {i % 5}  '")
    text = "\n".join(lines)
    put(tmp_path / "in", "big.txt", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = listed(entries_of(spark, tmp_path / "in").filter(F.col("code") != ""))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == brute_force(text)
