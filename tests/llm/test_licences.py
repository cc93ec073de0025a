"""Licence scan against its SQL and on a small tree."""

import duckdb
from pyspark.sql import functions as F

from tillsight.llm import licences as l

SF = "/root/testdata/sf0.01"


def test_sql_agrees(spark):
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        columns = "doc_id, path, own, licence_file, licence, inherited_from"
        want = c.execute(f"SELECT {columns} FROM ({l.ORACLE_OP2})").fetchall()
    got = l.op2_licences(spark, SF).select(*columns.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r["own"] is not None for r in got) > 10


def test_tree(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    prose = "some other words that say nothing of the kind\n" * 20
    files = [(1, "", "LICENSE", mit + "\n" + prose), (2, "a", "x.py", prose), (3, "a/b", "COPYING", apache), (4, "a/b", "y.py", prose),
             (5, "a/b/c", "z.py", prose), (6, "a/b/c", "own.py", mit + "\n" + prose), (7, "ab", "q.py", prose),
             (8, "a/b", "n.py", None), (9, "a/b", "e.py", ""), (10, "d", "only.txt", "hi\n" + apache), (11, "d/e", "f", prose),
             (11, "d/e", "f", prose)]
    df = spark.createDataFrame(files, "doc_id long, dir string, name string, text string").withColumn("own", F.lit("clash"))
    got = {r["doc_id"]: (r["own"], r["licence"], r["inherited_from"]) for r in
           l.licences(df.select("doc_id", "dir", "name", "text")).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", ""), 3: ("Apache-2.0", "Apache-2.0", None), 4: (None, "Apache-2.0", "a/b"),
                   5: (None, "Apache-2.0", "a/b"), 6: ("MIT", "MIT", None), 7: (None, "MIT", ""), 8: (None, "Apache-2.0", "a/b"),
                   9: (None, "Apache-2.0", "a/b"), 10: ("Apache-2.0", "Apache-2.0", None), 11: (None, "Apache-2.0", "d")}
    assert l.licences(df.filter(F.lit(False)).select("doc_id", "dir", "name", "text")).count() == 0


def test_templates_find_themselves(spark):
    rows = [(k, "d", str(k), "filler words here\n" + text + "\nmore of it") for k, (_, text) in enumerate(l.TEMPLATES)]
    rows += [(100 + k, "e", str(k), "plain prose without any notice") for k in range(200)]
    got = l.licences(spark.createDataFrame(rows, "doc_id long, dir string, name string, text string")).collect()
    own = {r["doc_id"]: r["own"] for r in got}
    assert [own[k] for k in range(len(l.TEMPLATES))] == [name for name, _ in l.TEMPLATES]
    assert all(own[100 + k] is None for k in range(200))


def test_long_line(spark):
    rows = [(1, "d", "x", "the license of words " * 20_000), (2, "d", "y", "All rights reserved.")]
    got = l.licences(spark.createDataFrame(rows, "doc_id long, dir string, name string, text string")).collect()
    assert {r["doc_id"]: r["own"] for r in got} == {1: None, 2: "proprietary"}


def test_notices_inside_lines_and_over_lines(spark):
    words = "plain words of a text that says nothing of the kind " * 60
    gnu = ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License "
           "as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.")
    far = "filler " * (l.SEGMENT - 2)
    texts = {1: (words + "Released under the MIT License.", "MIT"), 2: (words + "\n# " + gnu + "\n" + words, "GPL-3.0"),
             3: (words + "Licensed under the\nApache License,\nVersion 2.0.\n" + words, "Apache-2.0"), 4: (words, None),
             5: (far + "Released under the MIT License. " + words, "MIT"), 6: (l.HEADERS[11][1].replace(", ", ",\n"), "MIT"),
             7: (words + "the license was released under the bridge and all rights were kept " + words, None)}
    rows = [(k, "d%d" % k, "x", text) for k, (text, _) in texts.items()] + [(100 + k, "e", str(k), "plain prose") for k in range(200)]
    got = l.licences(spark.createDataFrame(rows, "doc_id long, dir string, name string, text string")).collect()
    assert {r["doc_id"]: r["own"] for r in got if r["doc_id"] < 100} == {k: own for k, (_, own) in texts.items()}
    assert [r["doc_id"] for r in got if r["licence_file"]] == [6]


def test_rows_of_one_path_are_files_of_their_own(spark, tmp_path):
    """A third without id, an id on three texts, equal rows: a notice in some rows is neither given to the others nor a licence file."""
    mit, prose = "Released under the MIT License.", "plain words that say nothing of the kind\n" * 3
    rows = [(None, prose + f"text {k}\n" + (mit if k % 2 else "the end"), "s", "en") for k in range(80)]
    rows += [(k, prose + f"clean {k}", "s", "en") for k in range(100)]
    rows += [(500, prose + "one", "s", "en"), (500, prose + mit, "s", "en"), (500, mit, "t", "en"), (501, prose, "t", "en")]
    rows += [(502, prose + mit, "s", "en")] * 10 + [(None, mit, "u", None), (None, prose, "u", None), (None, None, "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "path", "own", "licence_file", "licence", "inherited_from"]
    got = l.op2_licences(spark, str(tmp_path)).select(*columns).collect()
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = c.execute(f"SELECT {', '.join(columns)} FROM ({l.ORACLE_OP2})").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    own = sum(r["own"] == "MIT" for r in got)
    assert len(got) == len(rows) and own == 40 + 2 + 10 + 1
    assert {(r["path"], r["licence"]) for r in got if r["inherited_from"]} == {("t/en/501", "MIT"), ("u//", "MIT")}
    assert sorted(r["path"] for r in got if r["licence_file"]) == ["t/en/500", "u//"]
