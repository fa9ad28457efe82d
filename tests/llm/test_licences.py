import duckdb
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import licences

MIT = """ * Permission is hereby granted, free of charge, to any person obtaining a copy of this software
 * and associated documentation files (the "Software"), to deal in the Software without restriction.
 * The above copyright notice and this permission notice shall be included in all copies.
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted.
# Redistributions of source code must retain the above copyright notice.
# Redistributions in binary form must reproduce the above copyright notice.
{}This software is provided "as is" and so on."""

CASES = [
    (MIT, ["MIT"]),
    ("Released under the MIT License.\n" + MIT, ["MIT"]),
    (BSD.format("Neither the name of X may be used to endorse or promote products.\n"), ["BSD-3-Clause"]),
    (BSD.format(""), ["BSD-2-Clause"]),
    ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("Licensed under the Apache License,\n   Version 2.0. All rights reserved.", ["Apache-2.0", "All-Rights-Reserved"]),
    ("under the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ["GPL-3.0-or-later"]),
    ("GNU General Public License, version 2. GNU Lesser General Public License!", ["LGPL", "GPL-2.0"]),
    ("Licensed under CC BY-NC-SA 4.0; licensed under CC BY 4.0", ["CC-BY-NC-SA", "CC-BY"]),
    ("Licensed under the Foo Public Licence 7", ["Unknown"]),
    ("A permission slip and a modified plan.", []),
    ("", []),
    (None, []),
    ("x " * 200_000 + "released under the mit license", ["MIT"]),
]


def test_known_texts_nulls_copies_and_clashing_names(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(0, MIT), (None, MIT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit(1)).withColumn("extra", F.lit(2))
    out = licences.scan(docs)
    assert sorted(out.columns) == ["doc_id", "extra", "licences", "sentence_ids", "text"]
    got = [(r.doc_id, r.licences) for r in out.collect()]
    assert got == [(i, CASES[i or 0][1]) for i, _ in rows]
    assert licences.scan(docs.limit(0)).collect() == []


SEVERAL = [
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["spdx_mit", "spdx_apache2"], ["Apache-2.0", "MIT"]),
    ("# SPDX-License-Identifier: (MIT AND Zlib) OR GPL-2.0-only WITH Classpath-exception-2.0 OR ISC\n", ["spdx_mit", "zlib", "spdx_gpl2", "spdx_isc"], ["MIT", "GPL-2.0", "ISC", "Zlib"]),
    ("licensed under the Apache License, Version 2.0 or the MIT License", ["apache2", "mit"], ["Apache-2.0", "MIT"]),
    ("Licensed under the MIT License or the Apache License, Version 2.0", ["mit", "apache2"], ["Apache-2.0", "MIT"]),
    ("foo: MIT License\nbar: ISC License\nbaz: GNU General Public License version 2\nqux: Zlib License or later", ["mit", "isc", "gpl2", "zlib"], ["MIT", "GPL-2.0", "ISC", "Zlib"]),
    ("a SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: AGPL-3.0-only\nSPDX-License-Identifier: BSL-1.0\nThe MIT License", ["spdx_mit", "agpl3", "boost", "mit"], ["MIT", "AGPL-3.0", "BSL-1.0"]),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["spdx_gpl2_later"], ["GPL-2.0-or-later"]),
    ("/* SPDX-License-Identifier: GPL-3.0-or-later */ int x", ["spdx_gpl3_later"], ["GPL-3.0-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0+. And so on", ["spdx_gpl2_later"], ["GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: MIT-0", ["some_licence"], ["Unknown"]),
    ("SPDX-License-Identifier: BSD-3-Clause-Clear", ["some_licence"], ["Unknown"]),
    ("SPDX-License-Identifier: BSD-2-Clause-Patent or MIT", ["some_licence", "spdx_mit"], ["MIT", "Unknown"]),
    ("SPDX-License-Identifier: LGPL-2.1-only", ["spdx_lgpl21"], ["LGPL-2.1"]),
    ("SPDX-License-Identifier: LGPL-3.0-or-later AND AGPL-3.0-or-later", ["spdx_lgpl3_later", "spdx_agpl3_later"], ["LGPL-3.0-or-later", "AGPL-3.0-or-later"]),
    ("SPDX-License-Identifier: Zlib-acknowledgement", ["some_licence"], ["Unknown"]),
    ("SPDX-License-Identifier: EUPL-1.2", ["eupl"], ["EUPL"]),
    ("under the Common Development and Distribution License or the European Union Public Licence", ["cddl", "eupl"], ["EUPL", "CDDL"]),
    ("SPDX-License-Identifier: MIT the mit license", ["spdx_mit", "mit"], ["MIT"]),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", ["cc_by_sa"], ["CC-BY-SA"]),
    ("SPDX-License-Identifier: NOASSERTION", [], []),
    ("GNU General Public License version 3 or the GNU Lesser General Public License", ["gpl3", "lgpl"], ["LGPL", "GPL-3.0"]),
]


def test_all_licences_of_a_sentence(spark):
    out = licences.scan(spark.createDataFrame([(t,) for t, _, _ in SEVERAL], "text string")).collect()
    assert [(r.text, r.sentence_ids, r.licences) for r in out] == SEVERAL


def test_sql_gives_the_same_on_all_cases(spark, tmp_path):
    texts = [t for t, _ in CASES] + [t for t, _, _ in SEVERAL]
    texts += ["\n".join(t for t, _, _ in SEVERAL), "SPDX-License-Identifier: " + " OR ".join(["MIT", "ISC", "X-1"] * 3), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = licences.op8_licences(spark, str(tmp_path))
    expected = duck.execute(f"SELECT {', '.join(found.columns)} FROM ({licences.OP8_SQL})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
