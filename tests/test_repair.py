import os
import random

from tidelake.operators.repair import repair_documents, repair_escaped_lines
from tidelake.functions.text import repair_escaped_breaks


def _write_files(base, seed, n_files=3, n_records=400):
    rnd = random.Random(seed)
    expected = []
    os.makedirs(base, exist_ok=True)
    for fi in range(n_files):
        parts = []
        for r in range(n_records):
            pieces = [f"f{fi}r{r}p{j}" + "x" * rnd.randint(0, 60) for j in range(rnd.choice([1, 1, 1, 2, 5, 12]))]
            breaks = [rnd.choice(["\n", "\r\n", "\r"]) for _ in pieces[1:]]
            rec = pieces[0]
            want = pieces[0]
            for p, b in zip(pieces[1:], breaks):
                rec += "\\" + b + p
                want += "\\ " + p
            parts.append(rec)
            expected.append(want)
        with open(os.path.join(base, f"part-{fi}.txt"), "w", newline="") as f:
            f.write("\n".join(parts) + "\n")
    return expected


def test_line_repair_matches_expected_across_many_splits(spark, tmp):
    expected = _write_files(tmp + "/tmp", seed=7)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [r.value for r in repair_escaped_lines(spark, tmp + "/tmp").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(got) == sorted(expected)


def test_line_repair_keeps_file_order(spark, tmp):
    expected = _write_files(tmp + "/tmp", seed=3, n_files=1, n_records=200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        rows = repair_escaped_lines(spark, tmp + "/tmp").orderBy("file_path", "block_start", "line_seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in rows] == expected


def test_whole_file_and_line_forms_agree(spark, tmp):
    _write_files(tmp + "/tmp", seed=11, n_files=2, n_records=100)
    a = sorted(r.value for r in repair_escaped_lines(spark, tmp + "/tmp").collect())
    b = sorted(r.value for r in repair_documents(spark, tmp + "/tmp").collect())
    assert a == b


def test_trailing_escaped_break_at_end_of_file(spark, tmp):
    os.makedirs(tmp + "/t")
    with open(tmp + "/t/a.txt", "w") as f:
        f.write("a\\\nb\nc\\\n")
    got = sorted(r.value for r in repair_escaped_lines(spark, tmp + "/t").collect())
    assert got == ["a\\ b", "c\\ "]


def test_crlf_is_consumed_whole(spark):
    df = spark.createDataFrame([("x\\\r\ny",), ("x\\\ry",), ("x\\\ny",)], "v string")
    assert {r[0] for r in df.select(repair_escaped_breaks("v")).collect()} == {"x\\ y"}


def test_record_spanning_several_whole_splits(spark, tmp):
    os.makedirs(tmp + "/t")
    pieces = [f"p{i}" + "q" * 50 for i in range(200)]          # ~10 KB, one record
    big_in = "\\\n".join(pieces)
    big_out = "\\ ".join(pieces)
    with open(tmp + "/t/a.txt", "w") as f:
        f.write("before\n" + big_in + "\nafter\\\nend\nlast\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = repair_escaped_lines(spark, tmp + "/t").orderBy("block_start", "line_seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.value for r in rows] == ["before", big_out, "after\\ end", "last"]


def test_documents_repaired_exactly_over_many_small_splits(spark):
    import duckdb
    from tests.conftest import SF_ORACLE
    from tidelake import registry as R
    tmp = R._escaped_documents(spark, SF_ORACLE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(tmp).rdd.getNumPartitions() > 20
        got = sorted((r.doc_id, r.text) for r in R._doc_fields(repair_escaped_lines(spark, tmp)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(duckdb.sql("select doc_id, replace(text, chr(10), chr(92) || ' ') "
                             f"from '{SF_ORACLE}/documents.parquet'").fetchall())
    assert got == want



def test_line_repair_random_records_and_splits(spark, tmp):
    import random
    rnd = random.Random(7)
    for trial in range(6):
        records = [["".join(rnd.choice("xyz \u00e9\u0007") for _ in range(rnd.randint(0, 30)))
                    for _ in range(rnd.randint(1, 6))] for _ in range(rnd.randint(1, 25))]
        brk = rnd.choice(["\n", "\r\n", "\r"])
        d = f"{tmp}/t{trial}"
        os.makedirs(d)
        # one line-ending style per file (mixing bare-CR escapes with LF record ends would make
        # backslash+CR+LF ambiguous: it is also an escaped CRLF)
        with open(d + "/a.txt", "w", newline="") as f:
            f.write("".join(("\\" + brk).join(p) + brk for p in records))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(rnd.randint(200, 700)))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = [r.value for r in repair_escaped_lines(spark, d).orderBy("block_start", "line_seq").collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == ["\\ ".join(p) for p in records], (trial, brk)


def test_whole_file_repair_spreads_a_file_over_tasks(spark, tmp):
    """One file is no longer one value in one task; records, numbers and odd ends are those of the whole file."""
    import re
    rnd = random.Random(5)
    contents = ["", "\n", "\n\n", "a", "a\n\n", "a\n\n\n", "a\\", "a\\\n", "a\\\r", "a\\\r\n", "\ufeffa\\\nb\nc\\", "\\", "\r", "a\r\r\nb"]
    for brk in ("\n", "\r\n", "\r"):
        pieces = ["".join(rnd.choice("xyz \u00e9\\") for _ in range(rnd.randint(0, 40))) for _ in range(400)]
        contents += [brk.join(pieces), brk.join(pieces) + "\\", brk.join(pieces) + "\\" + brk, brk.join([*pieces, "end"]) + brk]
    os.makedirs(tmp + "/t")
    want = {}
    for i, content in enumerate(contents):
        with open(f"{tmp}/t/{i}.txt", "w", newline="") as f:
            f.write(content)
        fixed = re.sub(r"\\(\r\n|\n|\r)", lambda m: "\\ ", content)
        body = re.sub(r"(\r\n|\n|\r)(?=(\r\n|\n|\r)?\Z)", "", fixed)  # the last break, and an empty record before it
        want |= {(i, k): v for k, v in enumerate(re.split(r"\r\n|\n|\r", body))} if body else {}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = repair_documents(spark, tmp + "/t")
        assert "wholetext" not in got._jdf.queryExecution().toString().lower()
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == len(want)
    assert {(int(os.path.basename(r.file_path)[:-4]), r.line_no): r.value for r in rows} == want
