"""License scans: the same rows as the SQL, and whole notices."""

import duckdb

from accesslake.llm import licenses

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted. Redistributions of source code must retain the above copyright
 * notice. Redistributions in binary form must reproduce the above copyright notice.
Neither the name of the owner nor others may be used to endorse or promote products.
THIS SOFTWARE IS PROVIDED BY THE OWNER "AS IS" AND ANY EXPRESS OR IMPLIED warranties are out."""


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    return [(r.licenses, r.sentences, r.unmatched) for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_notices(spark):
    got = scan(spark, [
        BSD, BSD.replace("Neither the name of the owner nor others may be used to endorse or promote products.\n", ""),
        "Some words.\nReleased under the MIT License.", "Licensed under the Apache Licence, Version 2.0. All rights reserved.",
        "// SPDX-License-Identifier: GPL-3.0-or-later", None, "", "word " * 30000 + ". Licensed under CC BY-NC 4.0.",
        "Redistributions of source code must retain the above copyright.", "Licensed under the Sharing Terms.", "Licensed under CC BY 4.0. Released under the MIT License. Licensed under CC BY 4.0.",
    ])
    assert [g[0] for g in got] == ["BSD-3-Clause", "BSD-2-Clause", "MIT", "Apache-2.0", "GPL-3.0-or-later", "", "", "CC-BY-NC-4.0", "", "", "MIT,CC-BY-4.0"]
    assert got[3][2] == "AllRights" and got[8][2] == "BsdSource" and got[9][2] == "OtherLicense" and got[4][1] == "Spdx:GPL-3.0-or-later"
    assert got[0][1] == "BsdGrant,BsdSource,BsdBinary,BsdName,BsdAsis"


def test_same_as_sql_and_repeated_rows(spark):
    con = duckdb.connect()
    path = "/root/testdata/sf0.001/documents.parquet"
    con.execute(f"create view documents as select * from '{path}' union all (select * from '{path}' limit 3)")
    df = spark.read.parquet(path)
    df = df.unionByName(df.orderBy("doc_id").limit(3))
    assert sorted(map(tuple, licenses.scan(df).collect())) == sorted(con.execute(licenses.oracle_sql()).fetchall())


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_rule_names_known_sentences():
    known = {i for i, _ in licenses.SENTENCES}
    assert all(set(sequence) <= known for _, sequence in licenses.RULES)


TAGS = [
    "// SPDX-License-Identifier: MIT-0", "# SPDX-License-Identifier: Apache-2.0 OR MIT", "SPDX-License-Identifier: (MIT AND (BSD-3-Clause OR MPL-2.0))",
    "SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0", "SPDX-License-Identifier: Own-9.9", "/* SPDX-License-Identifier: MIT */ int main;",
    "SPDX-License-Identifier: MIT. Released under the MIT License.", "spdx-license-identifier:mit or apache-2.0+",
    "SPDX-License-Identifier: MIT\nCopyright somebody. Licensed under the Apache License, Version 2.0.", "This is covered by the Artistic License 2.0.", "SPDX-License-Identifier:",
]


def test_spdx_expressions_and_unknown_sentences(spark):
    got = scan(spark, TAGS)
    assert [g[0] for g in got] == ["MIT-0", "Apache-2.0,MIT", "MIT,BSD-3-Clause,MPL-2.0", "GPL-2.0-or-later", "", "MIT", "MIT", "MIT,Apache-2.0", "MIT,Apache-2.0", "", ""]
    assert got[4][2] == "UnknownSpdx" and got[9][2] == "UnknownLicense" and got[0][2] == ""


def test_tags_same_as_sql(spark):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(TAGS)) + [(None, None), (3, "")])
    df = spark.createDataFrame(list(enumerate(TAGS)) + [(None, None), (3, "")], "doc_id long, text string")
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(licenses.scan(df).collect()) == key(con.execute(licenses.oracle_sql()).fetchall())
