import duckdb

from agroweather.llm import license_scan
from agroweather.llm.oracle import LICENSE_SCAN

CASES = [
    (1, "Some words. Released under the MIT License.\nMore."),
    (2, "Licensed under CC BY-NC 4.0.\nlicensed under the APACHE license, version 2.0"),
    (3, "Apache License\n\nVersion 2.0, January 2004! text"),
    (4, "Version 2.0, January 2004\nApache License"),
    (5, "not Released under the MIT License"),
    (6, None),
    (7, ""),
    (8, "é MIT License? MIT License"),
    (9, "GNU GENERAL PUBLIC LICENSE\tVersion 3, 29 June 2007"),
    (10, ("word " * 20_000) + ". This is free and unencumbered software released into the public domain."),
]
WANT = {1: "MIT", 2: "Apache-2.0,CC-BY-NC-4.0", 3: "Apache-2.0", 4: "", 5: "", 6: "", 7: "", 8: "MIT", 9: "", 10: "Unlicense"}


def test_licenses(spark):
    rows = [(*case, "clash") for case in CASES]
    docs = spark.createDataFrame([*rows, (None, CASES[0][1], "x"), rows[0]], "doc_id long, text string, ids string")
    got = license_scan.scan_licenses(docs)
    assert sorted(str((row.doc_id, row.licenses)) for row in got.collect()) == sorted(
        str(pair) for pair in [*WANT.items(), (None, "MIT"), (1, "MIT")]
    )
    assert license_scan.scan_licenses(docs.where("false")).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_statement(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", CASES)
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    got = sorted(tuple(row) for row in license_scan.scan_licenses(docs).collect())
    assert got == sorted(con.execute(LICENSE_SCAN).fetchall())


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
"""
NOTICES = {
    "Apache-2.0": APACHE,
    "MPL-2.0": MPL,
    "GPL-3.0": GPL,
    "MIT": MIT,
    "BSD-2-Clause": BSD + DISCLAIMER,
    "BSD-3-Clause": BSD + NAMES + DISCLAIMER,
}


def test_wrapped_notices(spark):
    """Standard notices, as wrapped, as comments, below a copyright line, and wrapped after each word."""
    rows, want = [], []
    for name, notice in NOTICES.items():
        commented = "".join(f" * {line}\r\n" for line in notice.split("\n"))
        narrow = "\n\n".join("\n".join(part.split()) for part in notice.split("\n\n"))
        for text in (notice, commented, f"# Copyright 2020 Someone\n{notice}", narrow):
            want.append((len(rows), name))
            rows.append((len(rows), text))
    rows.append((len(rows), "Licensed under the\n\nMIT License and others. Released under. the MIT license text"))
    want.append((len(want), ""))
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((row.doc_id, row.licenses) for row in got.collect()) == want


def test_overlaps_and_many_matches(spark):
    """The first sentence wins over those that begin inside it; very many are counted one by one."""
    chain = "released under\nthe MIT license\nmit\nlicense"
    assert spark.createDataFrame([(1, chain)], "doc_id long, text string").transform(
        license_scan.scan_licenses
    ).first().sentence_ids == "mit-notice,mit-title"
    docs = spark.createDataFrame([(n, "MIT License\n" * n) for n in (255, 256, 257, 20_000)], "doc_id long, text string")
    got = license_scan.scan_licenses(docs).collect()
    assert all(row.n_sentences == row.doc_id for row in got)
