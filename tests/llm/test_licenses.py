import time

import pytest
from pyspark.sql import functions as F

from retailweave.llm.licenses import BASE_PHRASES, FAMILIES, PLAIN_RULES, SENTENCES, TAGS, Scanner, default_rules, scan_licenses, settled

from conftest import rows
from llm.conftest import ODD_TEXTS, as_dict
from llm.test_words import plain_words

RULES = default_rules()


def labels(text):
    return [rule.label for _, _, rule in Scanner(RULES).detections(text.lower())]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2"]),
        ("Released under the MIT License.", ["mit"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("licensed under the GNU General Public License, version 3.", ["gpl-3"]),
        ("licensed under the GNU General Public License.", ["gpl"]),
        ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3-clause"]),
        ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2"]),
        ("license = 'mpl-2.0'", ["mpl-2"]),
        ("Creative Commons Attribution-NonCommercial-ShareAlike license", ["cc-by-nc-sa"]),
        ("Redistribution and use in source and binary forms are permitted. 3-clause BSD license", ["redistribution-notice", "bsd-3-clause"]),
        ("Copyright (c) 2020. All rights reserved", ["copyright-notice", "all-rights-reserved"]),
        ("an mit-licensed tool", ["mit"]),
        ("summit license of admitted limits under review", []),
    ],
)
def test_signatures(text, expected):
    assert labels(text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("licensed under a Creative Commons Attribution 4.0 International License", ["cc-by"]),
        ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International Public License.", ["cc-by-nc"]),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["mit", "apache-2"]),
        ("SPDX-License-Identifier: MIT OR (Apache-2.0 AND BSD-3-Clause)", ["mit", "apache-2", "bsd-3-clause"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND Zlib.", ["gpl-2", "zlib"]),
        ('{"license": "MIT/Apache-2.0"}', ["mit", "apache-2"]),
        ("under the terms of the GNU General\nPublic License", ["gpl"]),
        ("/*\n * Licensed under\n * the Apache License, Version 2.0\n */", ["apache-2"]),
        ("# released   under\r\n#\tthe MIT\r\n#\r\n# License", ["mit"]),
        ("** distributed under the terms of the GNU General Public License as *\n** published by the Free Software Foundation; either version 3 *", ["gpl-3"]),
        ("subject to the terms of the Mozilla Public\n// License, v. 2.0.", ["mpl-2"]),
        ("https://creativecommons.org/licenses/by-sa/4.0/", ["cc-by-sa"]),
    ],
)
def test_everyday_notices(text, expected):
    assert labels(text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("BSD 3-Clause License", ["bsd-3-clause"]),
        ("GPLv3+", ["gpl-3"]),
        ("see GPL v2.", ["gpl-2"]),
        ("https://www.gnu.org/licenses/gpl-3.0.html", ["gpl-3"]),
        ("https://opensource.org/license/bsd-2-clause/", ["bsd-2-clause"]),
        ("Apache-2.0 OR MIT", ["apache-2", "mit"]),
        ("choose apples or pears, and Apache-2.0 or something", []),
        ("Business Source License 1.1", ["busl-1.1"]),
        ("Academic Free License 3.0", ["afl-3"]),
        ("Microsoft Public License (Ms-PL)", ["ms-pl"]),
        ("Licensed under the Elastic License 2.0", ["elastic-2"]),
        ("dual licensed under MIT and Apache-2.0", ["mit", "apache-2"]),
        ("licensed under the MIT license or the Apache License, version 2.0", ["mit", "apache-2"]),
        ("license:mit or license:isc", ["mit", "isc"]),
        ("licenses: GPL-2.0+", ["gpl-2"]),
        ("This program is free software; you can redistribute it and/or modify it", ["gpl"]),
        ("the software shall be used for Good, not Evil", ["json"]),
        ("Open Government Licence v3.0", ["ogl"]),
    ],
)
def test_written_rules(text, expected):
    assert labels(text) == expected


@pytest.mark.parametrize(
    "unit, each", [("license:mit or ", 1), ("licensed under mit and ", 1), ("spdx-license-identifier: ", 0), ("apache-2.0 or ", 1), ("a or b and apache- ", 0), ("licensed under a ", 0)]
)
def test_time_grows_with_the_text(unit, each):
    """Tags and expressions are read once: 20,000 of them in a second, where every tag used to look at all that follow."""
    scanner = Scanner(RULES)
    began = time.perf_counter()
    found = scanner.detections(unit * 20_000)
    assert time.perf_counter() - began < 1 and len(found) == 20_000 * each


def test_spans_are_those_of_the_text_itself():
    text = "\n\n x  y\tlicensed under\n * the  mit\n # license, spdx-license-identifier: (mit or\n//  zlib) z"
    spans = [text[start:end] for start, end, _ in Scanner(RULES).detections(text)]
    assert spans == ["licensed under\n * the  mit\n # license", "spdx-license-identifier: (mit", "zlib"]


@pytest.mark.parametrize("unit", [" ", "\n", " * \n", "# ", "*", "\t \n"])
def test_folding_takes_long_gaps(unit):
    assert labels("the mit" + unit * 200_000 + "x") == []


def test_hundreds_of_rules_in_order_of_priority():
    assert len(RULES) == len(TAGS) + len(SENTENCES) * len(FAMILIES) + len(PLAIN_RULES) and len(PLAIN_RULES) > 140
    assert [rule.priority for rule in RULES] == sorted((rule.priority for rule in RULES), reverse=True)


def test_the_prefilter_loses_nothing():
    """The same detections as from running every rule on every text."""
    texts = [
        "licensed under cc by 4.0, license: zlib, released under the unlicense license",
        "available to you under the terms of the mozilla public license, version 2.0 or the eupl-1.2",
        "this isc license; gnu lgpl license; license: wtfpl; license: epl-2.0; license: cddl-1.0; cc0 license",
        "subject to the terms of the boost software, the python software foundation license, artistic license",
        "nothing of the kind",
        *(f"{start} {name} license and license: {tag}" for start in ("under the", "licensed under the") for name, tag in [
            ("mit", "mit-0"), ("apache", "apache-2.0"), ("postgresql", "postgresql"), ("sil open font", "ofl-1.1"),
            ("european union public", "eupl-1.1"), ("open database", "odbl-1.0"), ("eclipse public", "epl-1.0"),
            ("boost software", "bsl-1.0"), ("common development and distribution", "cddl-1.1"), ("creative commons zero", "cc0-1.0")]),
    ]
    for text in texts:
        scanner = Scanner(RULES)
        found = [named for rule in RULES for m in rule.pattern.finditer(text) for named in scanner.named_in(rule, m)]
        every = settled(found)
        assert Scanner(RULES).detections(text) == every


def test_suppression():
    high, low = RULES[0], RULES[-1]
    assert settled([(0, 10, low), (2, 5, high)]) == [(2, 5, high)]
    assert settled([(0, 10, high), (2, 5, high)]) == [(0, 10, high)]
    assert settled([(0, 6, high), (4, 9, high)]) == [(0, 6, high), (4, 9, high)]
    assert settled([(0, 6, low), (6, 9, high)]) == [(0, 6, low), (6, 9, high)]


def base(text):
    words, places = plain_words(text), []
    for phrase, label in BASE_PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({label for _, label in places}),
    )


TEXTS = [
    "Under the MIT license. under the\nmit-license; under the mit licenses",
    "Apache license, version 2.0 and CC BY-NC 4.0 and cc by nc",
    "licensed under the mit",
    "license cc by",
    "nc under the mit license",
    "ünder the mit license",
    *ODD_TEXTS,
]


def test_base_phrases_equal_brute_force(texts):
    found = as_dict(scan_licenses(texts(TEXTS)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert found == {i: base(text) for i, text in enumerate(TEXTS)}


def test_base_labels_stay_and_scores_are_shares(texts):
    for row in scan_licenses(texts(TEXTS)).collect():
        assert set(row.base_labels) <= set(row.labels) and row.labels == sorted(set(row.labels))
        assert 0 <= row.score <= 1 and (row.score == 0) == (not row.labels)
        assert all(0 <= x.start < x.end <= len(row.text) for x in row.detections)


def test_no_rules_no_rows_and_clashing_columns(spark, texts, clashing):
    df = clashing(texts(["Released under the MIT License."]), "LABELS", "detections", "rule")
    found = scan_licenses(df, rules=[])
    assert found.columns[:3] == ["doc_id", "text", "rule"] and found.first().labels == ["mit"]
    assert scan_licenses(texts([])).collect() == []
    twice = texts(["cc by nc"]).union(texts(["cc by nc"])).withColumn("doc_id", F.lit(None).cast("long"))
    assert rows(scan_licenses(twice).select("doc_id", "n_base")) == [(None, 1), (None, 1)]


def test_many_detections_in_one_text(texts):
    row = scan_licenses(texts(["© 2020 mit license " * 5_000])).first()
    assert len(row.detections) == 10_000
