import textwrap

from raretide.llm import licenses


def test_rules_and_edge_cases(spark):
    mit = "The MIT License (MIT)\nCopyright (c) 2020 Some One\n" + "\n".join(
        k.capitalize() + "." for k, v in licenses.SENTENCES.items() if v in ("mitGrant", "mitNotice", "mitAsIs"))
    rows = [(1, "Word here.\nReleased under the MIT License.\nmore"), (2, mit), (3, None), (4, ""), (5, "no such words " * 30000 + ". Licensed under CC BY-NC 4.0."),
            (6, "You may obtain a copy of the License at\nhttp"), (7, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
            (None, "This work is licensed under the GNU General Public License, version 3."), (1, "Word here.\nReleased under the MIT License.\nmore"),
            (8, "A license is mentioned but no known sentence is."), (9, "licensed  under the APACHE license -- version 2.0"), (10, "Copyright 1999 me")]
    df = spark.createDataFrame([(d, t, "x", None) for d, t in rows], "doc_id long, text string, licenses string, sentences string")
    got = sorted(((r.doc_id, r.licenses, r.unknown, len(r.sentences)) for r in licenses.scan(df).collect()), key=str)
    want = [(1, ["MIT"], False, 1), (1, ["MIT"], False, 1), (2, ["MIT"], False, 5), (5, ["CC-BY-NC-4.0"], False, 1), (6, [], True, 1),
            (7, ["Apache-2.0", "MIT"], False, 2), (None, ["GPL-3.0"], False, 1), (9, ["Apache-2.0"], False, 1), (10, [], False, 1)]
    assert got == sorted(want, key=str)
    assert licenses.scan(df, all_rows=True).count() == len(rows)
    assert licenses.scan(df.where("false")).count() == 0


def test_every_sentence_has_a_keyword():
    assert all(any(k in s for k in licenses.KEYWORDS) for s in licenses.SENTENCES)
    assert {i for _, seq in licenses.RULES for i in seq} <= {*licenses.SENTENCES.values(), *licenses.NAMED.values()}


MIT = [
    "MIT License", "Copyright (c) 2020 Some One",
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."]
BSD = [
    "Copyright 2019 Some One",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]
APACHE = [
    "Copyright 2021 Some One",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "    http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
    "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."]
GPL = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE.  See the GNU General Public License for more details."]


def verdicts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.licenses, r.unknown, list(r.sentences)) for r in licenses.scan(df).collect()}


def test_sentences_wrapped_over_lines(spark):
    wrap = lambda paragraphs, width: "\n\n".join(textwrap.fill(x, width) for x in paragraphs)
    texts, want = [], []
    for name, paragraphs in (("MIT", MIT), ("BSD-3-Clause", BSD), ("Apache-2.0", APACHE), ("GPL-3.0-or-later", GPL)):
        for width in (72, 40, 10000):
            plain = wrap(paragraphs, width)
            texts += [plain, plain.replace("\n", "\r\n"), plain.replace("\n", " \n"), "".join(f"# {x}\n" for x in plain.split("\n")),
                      "/*\n" + "".join(f" * {x}\n" for x in plain.split("\n")) + " */\nint x;"]
            want += [[name]] * 5
    got = verdicts(spark, texts)
    assert [got[i][:2] for i in range(len(texts))] == [(x, False) for x in want]


def test_clauses_on_one_line_and_sentences_that_are_none(spark):
    got = verdicts(spark, [" ".join(MIT[2:]), " ".join(BSD[1:4]), "Apache License\nVersion 2.0, January 2004\nhttp", "Licensed under the\n\nMIT License", "It is not licensed under the\nMIT License",
                           "Licensed under the\nMIT License and more", "Note: all rights reserved"])
    assert got[0] == (["MIT"], False, ["mitGrant", "mitNotice", "mitAsIs"])
    assert got[1] == (["BSD-2-Clause"], False, ["bsdGrant", "bsdSource", "bsdBinary"])
    assert got[2] == (["Apache-2.0"], False, ["apacheTitle", "apacheVersion"])
    assert got[3] == ([], False, ["mitTitle"]) and got[4] == ([], False, ["mitTitle"])
    assert 5 not in got and 6 not in got


def test_spdx_tags_name_their_licence(spark):
    tag = "SPDX-License-Identifier: "
    cases = [("// " + tag + "MIT\nint x;", ["MIT"], False, ["spdx:mit"]), ("/* " + tag + "GPL-2.0-only */", ["GPL-2.0"], False, ["spdx:gpl 2 0 only"]),
             ("# " + tag + "GPL-2.0+", ["GPL-2.0-or-later"], False, ["spdx:gpl 2 0 or later"]), (tag + "LGPL-2.1-or-later", ["LGPL-2.1-or-later"], False, ["spdx:lgpl 2 1 or later"]),
             (tag + "(MIT OR Apache-2.0)", ["Apache-2.0", "MIT"], False, ["spdx:mit", "spdx:apache 2 0"]),
             (tag + "GPL-2.0+ AND GPL-3.0+", ["GPL-2.0-or-later", "GPL-3.0-or-later"], False, ["spdx:gpl 2 0 or later", "spdx:gpl 3 0 or later"]),
             (tag + "GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0"], True, ["spdx:gpl 2 0 only", "spdx:classpath exception 2 0"]),
             (tag + "LicenseRef-Own", [], True, ["spdx:licenseref own"]), ("SPDX-License-Identifier:ISC", ["ISC"], False, ["spdx:isc"]),
             ("Copyright 2020 me\n" + tag + "BSD-3-Clause\nReleased under the MIT License.", ["BSD-3-Clause", "MIT"], False, ["copyright", "spdx:bsd 3 clause", "mitRef"])]
    got = verdicts(spark, [c[0] for c in cases])
    assert [got[i] for i in range(len(cases))] == [c[1:] for c in cases]


def test_usual_headers_and_declarations(spark):
    got = verdicts(spark, [
        "Copyright (c) 2019, Some One\nAll rights reserved.\n\n" + "\n\n".join(BSD[1:]), "This project is licensed under the terms of the MIT license.", "License: MIT",
        "Licence: Apache-2.0\nmore", "This software is distributed under the Apache License 2.0.", "All rights reserved.", "\n\n".join(APACHE[:2]),
        "License: my own", "Licensed under the MIT License.\nAll rights reserved."])
    assert [got[i][:2] if i in got else None for i in range(9)] == [
        (["BSD-3-Clause"], False), (["MIT"], False), (["MIT"], False), (["Apache-2.0"], False), (["Apache-2.0"], False), (["Proprietary"], False),
        (["Apache-2.0"], False), None, (["MIT"], False)]


def walked(ids):
    """The rules in plain Python: (what is left, licences found)."""
    rest, found = list(ids), []
    for name, seq in licenses.RULES:
        places, at = [], 0
        for i in seq:
            if i not in rest[at:]:
                break
            at = rest.index(i, at) + 1
            places.append(at - 1)
        else:
            rest = [x for k, x in enumerate(rest) if k not in places]
            found.append(name)
    return rest, found


def test_rules_equal_plain_walk_and_long_texts_end(spark):
    import random
    import time

    from pyspark.sql import functions as F
    rnd = random.Random(4)
    names = sorted({*licenses.SENTENCES.values(), *licenses.NAMED.values()})
    cases = [[rnd.choice(names[: rnd.choice([4, 12, len(names)])]) for _ in range(rnd.randint(0, 14))] for _ in range(150)]
    cases += [["apacheRef", "apacheComply", "apacheCopy", "apacheAsIs"] * 2500, ["mitGrant", "mitNotice"] * 5000]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, ids array<string>")
    began = time.time()
    got = {r.i: (list(r.m.rest), list(r.m.found)) for r in df.select("i", licenses.match_rules(F.col("ids")).alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [walked(c) for c in cases]
    assert time.time() - began < 60
