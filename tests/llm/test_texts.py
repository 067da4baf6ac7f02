"""Decontamination and licences against plain versions."""

import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontamination, licences, queries

FOLDER = "/root/testdata/sf0.001"
ITEM = "a farmer sells 12 apples to Anna Smith for 3 dollars and then 12 pears to her brother for a coin."


def _found(spark, docs, items):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("id", "hash", "place", "slots", "_id")}
    )
    items = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: r["item_ids"] for r in decontamination.mark(docs, items).collect()}


def test_questions_with_other_parameters_are_caught(spark):
    docs = [
        f"Some words before. {ITEM} And some after.",
        ITEM.replace("12", "7").replace("Anna Smith", "Bob").replace("3 dollars", "2.50 euros"),
        # The two equal numbers of the question differ here: another question of the same frame.
        ITEM.replace("12 apples", "5 apples").replace("12 pears", "6 pears"),
        # Different values of the question are equal here, which says nothing against it.
        ITEM.replace("3 dollars", "12 dollars"),
        ITEM.upper(),
        "a farmer sells his farm and all of its many animals to a friend from the old town by the sea",
        None,
        "",
        "word " * 50_000 + ITEM,
    ]
    found = _found(spark, docs, [(1, ITEM), (2, None), (None, ITEM)])
    assert found == {0: [1], 1: [1], 2: [], 3: [1], 4: [1], 5: [], 6: [], 7: [], 8: [1]}


def test_short_items_and_ties(spark):
    items = [(1, "blue whales sing very low songs"), (2, "blue whales sing very low songs"), (3, "too short"), (4, "")]
    docs = ["we know that blue whales sing very low songs at night", "blue whales sing", "too short", "x"]
    assert _found(spark, docs, items) == {0: [1, 2], 1: [], 2: [], 3: []}
    assert _found(spark, docs, []) == {0: [], 1: [], 2: [], 3: []}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontamination.mark(docs, items).count() == 0
    repeated = spark.createDataFrame([(None, ITEM), (4, ITEM), (4, ITEM)], docs.schema)
    assert sorted(map(repr, ((r["doc_id"], r["contaminated"], r["kept"]) for r in decontamination.mark(repeated, items).collect()))) == [
        "(4, True, False)", "(4, True, False)", "(None, True, False)",
    ]
    own = spark.createDataFrame([("a", ITEM), ("a", "other words"), (None, "more words")], "doc_id string, text string")
    assert sorted(map(repr, ((r["doc_id"], r["kept"]) for r in decontamination.mark(own, items).collect()))) == [
        "('a', False)", "('a', True)", "(None, True)",
    ]


def test_repetitive_texts_make_no_more_rows_than_windows(spark, monkeypatch):
    staged = []
    real = decontamination.stage

    def seen(df, label):
        staged.append((label, real(df, label)))
        return staged[-1][1]

    monkeypatch.setattr(decontamination, "stage", seen)
    line = "the shop sells apples and pears to all the people of the town"
    items = [(1, "word " * 1500), (2, f"{line}. " * 40), (3, f"first we said that {line}. " + f"{line}. " * 3)]
    docs = ["word " * 4000, "word " * 1499, "word " * 20, f"{line}. " * 60, f"{line}. " * 39, f"{line}.", f"so first we said that {line}. " + f"{line}. " * 5]
    assert _found(spark, docs, items) == {0: [1], 1: [], 2: [], 3: [2, 3], 4: [2, 3], 5: [2, 3], 6: [2, 3]}
    rows = dict(staged)["benchmark-hits"].count()
    assert rows < 2 * 3 * (4000 + 1500 + 120 * 13)


def test_the_query_finds_every_whole_passage_and_no_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    expected = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    found = {(r["doc_id"], i) for r in queries.op5_decontamination(spark, FOLDER).collect() for i in r["item_ids"]}
    assert expected and found == expected


@pytest.mark.parametrize(
    ("text", "slots"),
    [("He paid 1,000.50 dollars", [1, 2]), ("We met John van Smith Jones today", [3, 3]), ("two miles. The end", [1, 2])],
)
def test_slots(text, slots):
    import pyarrow as pa

    t = decontamination.template(pa.array([text]))
    assert [s for s in t.slot.tolist() if s] == slots


MIT = next(body for name, body in licences.KNOWN if name == "MIT" and len(body) > 200)
TEXTS = [
    ("Released under the MIT License.", "MIT", "MIT"),
    ("# released  under the MIT licence", "MIT", "MIT"),
    (f"The MIT License header\n\nCopyright (c) 2020 A. Body\n\n{MIT}\n", "MIT", "MIT"),
    (f"Copyright (c) 2020 A. Body\n(C) 2021 B. Body\nCopyright by C.\nAll rights reserved.\n{MIT.lower()}", "MIT", "MIT"),
    ("Words before.\nLicensed under the Apache Licence, ver. 2.0\r\nWords after.\nLicensed under CC BY-NC 4.0.", None, "Apache-2.0|CC-BY-NC-4.0"),
    ("We like the MIT License. Released under the MIT License, they said.", None, ""),
    ("This work is licensed under the GNU General Public License, v3.", "GPL-3.0", "GPL-3.0"),
    ("", None, ""),
    (None, None, ""),
    ("!!!", None, ""),
    ("x\n" * 30_000 + "Licensed under the Apache License, Version 2.0.", None, "Apache-2.0"),
]


def test_licences(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(TEXTS)] + [(0, TEXTS[0][0]), (None, TEXTS[0][0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("digest", "license", "_content", "unit")}
    )
    found = licences.scan(frame)
    expected = [(i, w, n) for i, (_, w, n) in enumerate(TEXTS)] + [(0, "MIT", "MIT"), (None, "MIT", "MIT")]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, expected))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licences.scan(frame.where("false")).count() == 0


def test_a_block_of_a_document_is_a_text_of_its_own(spark):
    one = " ".join(MIT.split())
    rows = spark.createDataFrame([(1, f"Intro.\n\n{one}\n\nMore."), (2, f"Intro. {one}")], "doc_id long, text string")
    assert [r["licenses"] for r in licences.scan(rows).orderBy("doc_id").collect()] == ["MIT", ""]


BODY = {name: body for name, body in licences.KNOWN if len(body) > 200}
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
FOUND = [
    (f"MIT License\n\nCopyright (c) 2020 A. Body\n\n{MIT}\n", "MIT", "MIT"),
    (f"Read me.\n\nThe MIT License (MIT)\n\nCopyright 2020 by A. Body\n\n{MIT}\n\nMore words.", None, "MIT"),
    # Blocks of a known text that do not stand one after the other are not that text.
    (MIT.replace("\n\n", "\n\nOther words.\n\n"), None, ""),
    (MIT.split("\n\n")[0], None, ""),
    ("\n".join(f"// {line}".rstrip() for line in APACHE.split("\n")), "Apache-2.0", "Apache-2.0"),
    (f"/*\n * A file.\n *\n * {APACHE}\n */\ncode();".replace("\n", "\n * "), None, "Apache-2.0"),
    (f"# {GPL}", "GPL-3.0-or-later", "GPL-3.0-or-later"),
    (GPL.replace("General", "Lesser General").replace("program", "library").replace(": you", "; you").replace("3", "2.1"), "LGPL-2.1-or-later", "LGPL-2.1-or-later"),
    ("x = 1\n# SPDX-License-Identifier: BSD-2-Clause\n", None, "BSD-2-Clause"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("// spdx-license-identifier: GPL-2.0+", "GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\ny", None, "Apache-2.0|GPL-2.0|MIT"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0", "MPL-2.0"),
    ("SPDX-License-Identifier: LicenseRef-Own", None, ""),
    (licences._BSD_OPENING.replace("\n", " ") + "\n* no evil", None, "BSD"),
    (f"BSD 3-Clause License\n\nCopyright (c) 2020, A. Body\nAll rights reserved.\n\n{BODY['BSD-3-Clause']}", "BSD-3-Clause", "BSD-3-Clause"),
    (BODY["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("HOLDER ", "OWNER "), "BSD-2-Clause", "BSD-2-Clause"),
    (f"{BODY['Unlicense']}\n\nFor more information, please refer to <https://unlicense.org>", None, "Unlicense"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 F\n Everyone", None, "GPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0", "CC-BY-SA-4.0"),
    ("MIT License", None, ""),
]


def test_common_licence_files_headers_and_tags(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(FOUND)], "doc_id long, text string")
    found = {r["doc_id"]: (r["whole_license"], r["licenses"]) for r in licences.scan(rows).collect()}
    assert found == {i: (whole, names) for i, (_, whole, names) in enumerate(FOUND)}


def test_every_known_text_is_found_as_itself(spark):
    rows = spark.createDataFrame([(i, body) for i, (_, body) in enumerate(licences.KNOWN)], "doc_id long, text string")
    found = {r["doc_id"]: (r["whole_license"], r["licenses"]) for r in licences.scan(rows).collect()}
    assert {i: whole for i, (whole, _) in found.items()} == {i: name for i, (name, _) in enumerate(licences.KNOWN)}
    assert all("|" not in names for _, names in found.values())


def test_the_query_finds_every_notice_line(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    notices = {body: name for name, body in licences.KNOWN if "\n" not in body}
    expected = {i: "|".join(sorted({notices[x] for x in t.split("\n") if x in notices})) for i, t in docs.items()}
    assert any(expected.values())
    assert {r["doc_id"]: r["licenses"] for r in queries.op9_licences(spark, FOLDER).collect()} == expected


SUMS = "12 + 30 = 42 17 + 25 = 42 8 + 9 = 17 40 + 2 = 42 61 + 7 = 68"
NAMES = "Visitors came from Paris, London, Rome, Berlin, Madrid, Lisbon, Vienna, Prague, Warsaw and Oslo."


def test_whole_items_are_found_whatever_their_slots_and_case(spark):
    items = [(1, ITEM), (2, SUMS), (3, NAMES), (4, "10 20 30 40 50 60")]
    docs = [
        f"Before. {ITEM.upper()} After.",
        f"Before. {ITEM.lower()} After.",
        ITEM.title(),
        f"we learnt that {SUMS} at school",
        f"Words. {NAMES} More words.",
        NAMES.lower(),
        "count 10 20 30 40 50 60 and on",
        "12 + 31 = 43 17 + 26 = 43 8 + 8 = 16 40 + 3 = 43 61 + 8 = 69",
        "10 20 30 40 50 61",
    ]
    assert _found(spark, docs, items) == {0: [1], 1: [1], 2: [1], 3: [2], 4: [3], 5: [3], 6: [4], 7: [], 8: []}


def test_one_odd_value_does_not_void_a_passage(spark):
    ran = "yesterday the old dog ran 1 hour by the river and then slept for 3 hours under a tree near home"
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90))
    passage = f"we saw that Anna went out {plain} and later on Anna came back {plain[::-1]} until at last Anna slept"
    docs = [
        ran.replace("1 hour", "2 hours").replace("3 hours", "4 hours"),
        # One altered occurrence of a repeated name, another word changed.
        passage.replace("later on Anna", "later on Berta").replace("at last", "in time"),
    ]
    assert _found(spark, docs, [(1, ran), (2, passage)]) == {0: [1], 1: [2]}


@pytest.mark.parametrize(("one", "other"), [("2 hour", "2 hours"), ("2 feet", "2 foot"), ("2 metres", "2 meter")])
def test_spellings_of_a_unit_are_one_value(one, other):
    import pyarrow as pa

    a, b = (decontamination.template(pa.array([x])).value.tolist() for x in (one, other))
    assert a == b
