import os
import random

import pandas as pd

from riskpanel.sources import files as Fs
from riskpanel.sources import records as R
from tests.test_sources import _write

HEAD = "facility_code,facility_name,district_code,facility_type,latitude,longitude\n"


def plain_records(text, most):
    """Records by walking the lines: a quote left open is closed within ``most`` lines or stands for itself."""
    lines, out, i = text.split("\n")[:-1], [], 0
    while i < len(lines):
        end = i
        if lines[i].count('"') % 2:
            later = [j for j in range(i + 1, min(len(lines), i + most + 1)) if lines[j].count('"') % 2]
            end = later[0] if later else i
        out.append("\n".join(lines[i:end + 1]))
        i = end + 1
    return out


def test_long_fields_and_line_breaks(spark, tmp_dir):
    p = os.path.join(tmp_dir, "f.csv")
    long = "a long name, " * 5000
    names = {"F1": long, "F2": 'two\nlines, "quoted"\n\nand a blank one', "F3": 'x' * 2000 + '""', "F4": "plain"}
    _write(p, HEAD + "".join('%s,"%s",D1,clinic,1.5,2.5\n' % (k, v.replace('"', '""')) for k, v in names.items())
           + 'F5,"never closed,D1,clinic,1,2\nF6,after it,D1,clinic,1,2\nF7,bad latitude,D1,clinic,north,2\n')
    good, bad = Fs.read_facilities_csv(spark, p)
    assert {r.facility_code: r.facility_name for r in good.collect()} == names | {"F6": "after it"}
    assert sorted(r._corrupt_record[:2] for r in bad.collect()) == ["F5", "F7"] and good.count() == 5 and bad.count() == 2


def test_one_file_in_several_tasks(spark, tmp_dir):
    r = random.Random(8)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for case in range(3):
            most = [3, 10, 10_000][case % 3]
            lines = []
            for _ in range(300):
                lines.append("".join(r.choice(["a", "b,", '"' if r.random() < 0.15 else "c", '""', "", "é" * 9]) for _ in range(r.randrange(12))))
                if r.random() < 0.02:
                    lines += ["filler %d" % i for i in range(r.randrange(40))]
                if r.random() < 0.01:
                    lines.append("w" * 3000)
            folder = os.path.join(tmp_dir, f"case{case}")
            want = []
            for k in range(2):
                text = "\n".join(lines[k * 150:(k + 1) * 150] if k == 0 else lines[150:]) + "\n"
                _write(os.path.join(folder, f"{k}.csv"), text)
                want += plain_records(text, most)
            for size in ("500b", "64m"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                spark.conf.set("spark.sql.files.openCostInBytes", "0")
                got = R.read_records(spark, folder, most)
                assert sorted(x.value for x in got.collect()) == sorted(want), (case, size)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
            assert R._lines(spark, folder).select("value").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_states_of_blocks():
    cols = ["file", "block", "n", "odds", "first", "last", "gap", "after"]
    s = pd.DataFrame([(1, 0, 10, 1, 8, 8, False, 1), (1, 64, 5, 0, -1, -1, False, 0), (1, 128, 10, 2, 1, 7, False, 2),
                      (1, 192, 9, 1, 0, 0, False, 1), (1, 256, 9, 1, 8, 8, False, 1)], columns=cols)
    got = {r.block: (r.head, r.tail, r.record) for r in R.block_states(s, 100).itertuples()}
    assert got == {0: (False, True, 0), 64: (True, True, 0), 128: (True, True, 0), 192: (True, False, 128)}
    # within 5 lines the first opener is not closed; 7 - 1 is too far as well, so the third block's last line opens
    s["gap"], s["after"] = [False, False, True, False, True], [1, 0, 1, 1, 1]
    got = {r.block: (r.head, r.tail, r.record) for r in R.block_states(s, 5).itertuples()}
    assert got == {128: (False, True, 128), 192: (True, False, 128)}


def test_files_without_quotes_are_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.csv")
    _write(p, 'a,b\n\n"x",y\n')
    assert [r.value for r in R.read_records(spark, p).collect()] == ["a,b", "", '"x",y']
    _write(os.path.join(tmp_dir, "e.csv"), "")
    assert R.read_records(spark, os.path.join(tmp_dir, "e.csv")).count() == 0
