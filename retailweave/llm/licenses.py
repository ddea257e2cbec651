"""Licence detection by ordered signature rules.

A rule is a regular expression with a label, a priority and keywords. Per text, one
Aho-Corasick pass finds the keywords that occur, and only rules whose keyword
does are run. Rules see the text with line breaks, comment marks around them and other white
space folded to single spaces; spans are those of the text itself. Detections that overlap are settled in order: higher priority
first, then the longer, then the earlier; a detection that lies inside one that was
kept, or overlaps one of higher priority, is suppressed.

Besides, the base phrases are counted: places where a phrase's words stand one after
the other, whatever is between them. Their labels are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, replace

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from retailweave.llm.batches import add_columns
from retailweave.llm.words import Words

# Phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licence families by label. Names as they are written in prose, as regular
# expressions over lower-case text, identifiers as they stand in tags, and keywords, of which
# each name and identifier has one.
FAMILIES = {
    "mit": (r"mit", r"mit", "mit"),
    "mit-0": (r"mit no attribution(?:[- ][1-4]\.[05])?", r"mit-0", "mit"),
    "apache-1": (r"apache(?: software)?(?: licen[sc]e)?,? (?:version )?1\.[01]", r"apache-1\.[01]", "apache"),
    "apache-2": (r"apache(?: software)?(?: licen[sc]e)?,? (?:version )?2(?:\.0)?", r"apache-2(?:\.0)?", "apache"),
    "bsd": (r"bsd", r"bsd", "bsd"),
    "bsd-2-clause": (r"(?:2|two)[- ]clause bsd|bsd[- ](?:2|two)[- ]clause|simplified bsd|freebsd", r"bsd-2-clause", "bsd"),
    "bsd-3-clause": (r"(?:3|three)[- ]clause bsd|bsd[- ](?:3|three)[- ]clause|new bsd|modified bsd|revised bsd", r"bsd-3-clause", "bsd"),
    "bsd-4-clause": (r"(?:4|four)[- ]clause bsd|bsd[- ](?:4|four)[- ]clause|original bsd", r"bsd-4-clause", "bsd"),
    "gpl": (r"gnu general public|gnu gpl|gpl", r"gpl", "gnu general public|gpl"),
    "gpl-2": (r"(?:gnu general public|gnu gpl|gpl)(?: licen[sc]e)?,? ?(?:v\.? ?|version )?2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?", "gnu general public|gpl"),
    "gpl-3": (r"(?:gnu general public|gnu gpl|gpl)(?: licen[sc]e)?,? ?(?:v\.? ?|version )?3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?", "gnu general public|gpl"),
    "lgpl": (r"gnu (?:lesser|library) general public|gnu lgpl|lgpl", r"lgpl", "gnu lesser|gnu library|lgpl"),
    "lgpl-2.1": (r"(?:gnu lesser general public|gnu lgpl|lgpl)(?: licen[sc]e)?,? ?(?:v\.? ?|version )?2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", "gnu lesser|lgpl"),
    "lgpl-3": (r"(?:gnu lesser general public|gnu lgpl|lgpl)(?: licen[sc]e)?,? ?(?:v\.? ?|version )?3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?", "gnu lesser|lgpl"),
    "agpl-3": (r"gnu affero general public|gnu agpl|agpl", r"agpl-3\.0(?:-only|-or-later|\+)?", "affero|agpl"),
    "mpl": (r"mozilla public|mpl", r"mpl", "mozilla|mpl"),
    "mpl-2": (r"(?:mozilla public|mpl)(?: licen[sc]e)?,? ?(?:v\.? ?|version )?2(?:\.0)?", r"mpl-2\.0", "mozilla|mpl"),
    "epl": (r"eclipse public", r"epl-[12]\.0", "eclipse|epl-"),
    "cddl": (r"common development and distribution", r"cddl-1\.[01]", "common development|cddl"),
    "isc": (r"isc", r"isc", "isc"),
    "zlib": (r"zlib(?:/libpng)?", r"zlib", "zlib"),
    "boost": (r"boost software", r"bsl-1\.0", "boost|bsl"),
    "unlicense": (r"the unlicense", r"unlicense", "unlicense"),
    "artistic-2": (r"artistic(?: 2\.0)?", r"artistic-2\.0", "artistic"),
    "postgresql": (r"postgresql", r"postgresql", "postgresql"),
    "python": (r"python software foundation|psf", r"(?:psf|python)-2\.0", "python|psf"),
    "ofl": (r"sil open font", r"ofl-1\.1", "sil open|ofl"),
    "wtfpl": (r"do what the f[a-z*]+ you want to public", r"wtfpl", "do what the|wtfpl"),
    "eupl": (r"european union public", r"eupl-1\.[12]", "european union|eupl"),
    "odbl": (r"open database", r"odbl-1\.0", "open database|odbl"),
    "pddl": (r"public domain dedication and", r"pddl-1\.0", "public domain dedication|pddl"),
    "cc0": (r"cc0|creative commons zero", r"cc0-1\.0", "cc0|creative commons"),
    "cc-by": (r"cc[- ]by(?:[- ][1-4]\.[05])?|creative commons attribution(?:[- ][1-4]\.[05])?", r"cc-by-[1-4]\.[05]", "cc by|cc-by|creative commons"),
    "cc-by-sa": (r"cc[- ]by[- ]sa(?:[- ][1-4]\.[05])?|creative commons attribution[- ]share ?alike(?:[- ][1-4]\.[05])?", r"cc-by-sa-[1-4]\.[05]", "cc by|cc-by|creative commons"),
    "cc-by-nd": (r"cc[- ]by[- ]nd(?:[- ][1-4]\.[05])?|creative commons attribution[- ]no ?deriv[a-z]+(?:[- ][1-4]\.[05])?", r"cc-by-nd-[1-4]\.[05]", "cc by|cc-by|creative commons"),
    "cc-by-nc": (r"cc[- ]by[- ]nc(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non ?commercial(?:[- ][1-4]\.[05])?", r"cc-by-nc-[1-4]\.[05]", "cc by|cc-by|creative commons"),
    "cc-by-nc-sa": (r"cc[- ]by[- ]nc[- ]sa(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non ?commercial[- ]share ?alike(?:[- ][1-4]\.[05])?", r"cc-by-nc-sa-[1-4]\.[05]", "cc by|cc-by|creative commons"),
    "cc-by-nc-nd": (r"cc[- ]by[- ]nc[- ]nd(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non ?commercial[- ]no ?deriv[a-z]+(?:[- ][1-4]\.[05])?", r"cc-by-nc-nd-[1-4]\.[05]", "cc by|cc-by|creative commons"),
}

# Identifiers of licences that are no family, with their labels, as regular expressions.
IDENTIFIERS = {
    "0bsd": r"0bsd", "afl-3": r"afl-3\.0", "apsl-2": r"apsl-2\.0", "blueoak": r"blueoak-1\.0\.0", "busl-1.1": r"busl-1\.1", "cc-pdm": r"cc-pddc",
    "cecill": r"cecill(?:-[bc])?(?:-[12]\.[01])?", "cpl": r"cpl-1\.0", "elastic-2": r"elastic-2\.0", "gfdl": r"gfdl-1\.[123](?:-only|-or-later)?",
    "gpl-2": r"gpl-?v?2(?:\.0)?\+?", "gpl-3": r"gpl-?v?3(?:\.0)?\+?", "ibm-public": r"ipl-1\.0", "ms-pl": r"ms-pl", "ms-rl": r"ms-rl", "mulan-psl-2": r"mulanpsl-2\.0",
    "ncsa": r"ncsa", "odc-by": r"odc-by-1\.0", "osl-3": r"osl-3\.0", "php": r"php-3\.0[01]?", "polyform": r"polyform-[a-z-]+-1\.0\.0", "sspl-1": r"sspl-1\.0",
    "upl": r"upl-1\.0", "vim": r"vim", "w3c": r"w3c", "x11": r"x11", "zpl": r"zpl-2\.[01]", "openssl": r"openssl", "curl": r"curl", "ruby": r"ruby", "beerware": r"beerware",
}

# What stands after a tag: identifiers that are joined to an SPDX expression. A match takes all of it, so that
# no part of a text is looked at twice, and its identifiers are then told apart.
_WORD = r"(?!licen[sc]es?\b|spdx-license)[a-z0-9.+-]++"
_EXPRESSION = rf"[\s(]*+{_WORD}(?:(?:[\s()]*+/[\s()]*+|[\s()]++(?:and|or|with)[\s(]++){_WORD})*+"
_OPERAND = re.compile(rf"(?:\b(with)\s++)?({_WORD})")

# What an SPDX expression stands behind, with a priority, a confidence and keywords. One without a tag
# has to have several identifiers, all of them known.
TAGS = (
    (90, 1.0, r"spdx-license-identifier:" + _EXPRESSION, ("spdx-license-identifier",), False),
    (60, 0.8, r"\blicen[sc]es?[\"']?\s*+[:=]\s*+[\"']?" + _EXPRESSION, ("license", "licence"), False),
    (58, 0.8, rf"(?<![\w.+/-]){_WORD}(?:[\s()]++(?:and|or)[\s(]++{_WORD})++(?: with[\s(]++{_WORD})?+",
     ("apache-", "bsd-", "gpl-", "mpl-", "epl-", "cddl-", "cc0-", "cc-by-", "unlicense", "0bsd", "zlib", "artistic-", "afl-", "bsl-", "busl-"), True),
)

# The sentences a family's name stands in, with a priority, a confidence and
# keywords, of which one must occur for the rule to be run. {0} is the name, {1} the identifier; a detection begins at "later" where there is one.
SENTENCES = (
    (80, 0.95, r"\b(?:licen[sc]ed|released|distributed|available|published|provided)(?: to you)? under(?: (?:the|an?))?(?: terms(?: and conditions)? of)?(?: (?:the|an?))? (?:{0})\b(?:,? (?:international |unported |generic )?(?:public )?licen[sc]e)?", ("under",)),
    (70, 0.9, r"\b(?:{0}) (?:international |unported |generic )?(?:public )?licen[sc]e\b", ("license", "licence")),
    (65, 0.85, r"\b(?:licen[sc]ed|released|distributed|available) under(?: [a-z0-9.,+()-]{{1,30}}){{1,10}}? (?:and|or|&)(?: the)? (?P<later>(?:{0}|{1})(?:,? licen[sc]e)?)(?![\w+-]|\.\d)", (" and ", " or ", "&")),
    (50, 0.7, r"\bsubject to (?:the|an?)(?: terms(?: and conditions)? of (?:the|an?))? (?:{0})\b", ("subject to",)),
    (40, 0.6, r"\b(?:{0})[- ]licen[sc]ed\b", ("licensed", "licenced")),
)

_VERSION = r"(?: \(\w+\))?,? ?(?:v\.? ?|version )?"
_BY_FSF = r"(?: \(\w+\))?,? as published by the free software foundation[;,:]? (?:either )?\(?version "

# Rules for single licences and for sentences that name no family.
PLAIN_RULES = (
    ("permissive-notice", 55, 0.85, r"permission is hereby granted, free of charge, to any person", ("hereby granted",)),
    ("redistribution-notice", 55, 0.85, r"redistribution and use in source and binary forms", ("redistribution and use",)),
    ("no-warranty", 20, 0.3, r"provided [\"']as is[\"'],? without warranty", ("without warranty",)),
    ("all-rights-reserved", 30, 0.5, r"\ball rights reserved\b", ("all rights reserved",)),
    ("public-domain", 45, 0.7, r"\b(?:in|into|to) the public domain\b", ("public domain",)),
    ("proprietary", 30, 0.5, r"\bproprietary and confidential\b", ("proprietary",)),
    ("gpl-2", 85, 0.95, r"\bgnu general public licen[sc]e" + _BY_FSF + r"2\b", ("free software foundation",)),
    ("gpl-3", 85, 0.95, r"\bgnu general public licen[sc]e" + _BY_FSF + r"3\b", ("free software foundation",)),
    ("lgpl-2.1", 85, 0.95, r"\bgnu lesser general public licen[sc]e" + _BY_FSF + r"2\.1\b", ("free software foundation",)),
    ("lgpl-3", 85, 0.95, r"\bgnu lesser general public licen[sc]e" + _BY_FSF + r"3\b", ("free software foundation",)),
    ("agpl-3", 85, 0.95, r"\bgnu affero general public licen[sc]e" + _BY_FSF + r"3\b", ("free software foundation",)),
    ("apache-2", 85, 0.95, r"\bapache\.org/licenses/license-2\.0\b", ("apache.org/licenses",)),
    ("mit", 75, 0.9, r"\bopensource\.org/licenses/mit\b", ("opensource.org/licenses",)),
    ("mpl-2", 75, 0.9, r"\bmozilla\.org/(?:en-us/)?mpl/2\.0\b", ("mozilla.org",)),
    ("apache-2", 75, 0.9, r"\bapache(?: software)? licen[sc]e" + _VERSION + r"2(?:\.0)?\b", ("apache",)),
    ("gpl-2", 75, 0.9, r"\bgnu general public licen[sc]e" + _VERSION + r"2(?:\.0)?\b", ("gnu general public",)),
    ("gpl-3", 75, 0.9, r"\bgnu general public licen[sc]e" + _VERSION + r"3(?:\.0)?\b", ("gnu general public",)),
    ("lgpl-2.1", 75, 0.9, r"\bgnu lesser general public licen[sc]e" + _VERSION + r"2\.1\b", ("gnu lesser",)),
    ("lgpl-3", 75, 0.9, r"\bgnu lesser general public licen[sc]e" + _VERSION + r"3(?:\.0)?\b", ("gnu lesser",)),
    ("mpl-2", 75, 0.9, r"\bmozilla public licen[sc]e" + _VERSION + r"2(?:\.0)?\b", ("mozilla public",)),
    ("isc", 55, 0.85, r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", ("permission to use",)),
    ("unlicense", 55, 0.85, r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("cc0", 85, 0.95, r"\bcreativecommons\.org/publicdomain/zero\b", ("creativecommons.org",)),
    ("cc-by", 85, 0.95, r"\bcreativecommons\.org/licenses/by/", ("creativecommons.org",)),
    ("cc-by-sa", 85, 0.95, r"\bcreativecommons\.org/licenses/by-sa/", ("creativecommons.org",)),
    ("cc-by-nd", 85, 0.95, r"\bcreativecommons\.org/licenses/by-nd/", ("creativecommons.org",)),
    ("cc-by-nc", 85, 0.95, r"\bcreativecommons\.org/licenses/by-nc/", ("creativecommons.org",)),
    ("cc-by-nc-sa", 85, 0.95, r"\bcreativecommons\.org/licenses/by-nc-sa/", ("creativecommons.org",)),
    ("cc-by-nc-nd", 85, 0.95, r"\bcreativecommons\.org/licenses/by-nc-nd/", ("creativecommons.org",)),
    # Titles and notices of single licences.
    ("bsd-2-clause", 72, 0.9, r"\bbsd[- ](?:2|two)[- ]clause\b", ("bsd",)),
    ("bsd-3-clause", 72, 0.9, r"\bbsd[- ](?:3|three)[- ]clause\b", ("bsd",)),
    ("0bsd", 72, 0.9, r"\b(?:bsd[- ])?zero[- ]clause bsd\b|\bbsd zero clause\b", ("zero",)),
    ("gpl-2", 72, 0.9, r"\b(?:gnu )?gpl[- ]?v\.?[- ]?2(?:\.0)?\+?(?![\w-]|\.\d)", ("gpl",)),
    ("gpl-3", 72, 0.9, r"\b(?:gnu )?gpl[- ]?v\.?[- ]?3(?:\.0)?\+?(?![\w-]|\.\d)", ("gpl",)),
    ("lgpl-2.1", 73, 0.9, r"\b(?:gnu )?lgpl[- ]?v\.?[- ]?2\.1\+?(?![\w-]|\.\d)", ("lgpl",)),
    ("lgpl-3", 73, 0.9, r"\b(?:gnu )?lgpl[- ]?v\.?[- ]?3(?:\.0)?\+?(?![\w-]|\.\d)", ("lgpl",)),
    ("agpl-3", 73, 0.9, r"\b(?:gnu )?agpl[- ]?v\.?[- ]?3(?:\.0)?\+?(?![\w-]|\.\d)", ("agpl",)),
    ("gpl", 56, 0.85, r"\bthis program is free software[:;,] you can redistribute it", ("this program is free",)),
    ("lgpl", 56, 0.85, r"\bthis library is free software[:;,] you can redistribute it", ("this library is free",)),
    ("gpl", 50, 0.7, r"\bat your option\)? any later version\b", ("any later version",)),
    ("gfdl", 72, 0.9, r"\bgnu free documentation licen[sc]e\b(?:,? version 1\.[123])?", ("free documentation",)),
    ("fsf-permissive", 55, 0.85, r"\bcopying and distribution of this file, with or without modification, are permitted", ("with or without modification",)),
    ("apache-2", 56, 0.85, r"\byou may not use this (?:file|work) except in compliance with the licen[sc]e", ("except in compliance",)),
    ("mpl-2", 78, 0.95, r"\bthis source code form is subject to the terms of the mozilla public licen[sc]e", ("source code form",)),
    ("mpl-1.1", 76, 0.9, r"\bmozilla public licen[sc]e,? version 1\.1\b", ("mozilla public",)),
    ("epl-2", 75, 0.9, r"\beclipse public licen[sc]e(?:,? ?-? ?v(?:ersion)?\.? ?| )2\.0\b", ("eclipse public",)),
    ("epl-1", 75, 0.9, r"\beclipse public licen[sc]e(?:,? ?-? ?v(?:ersion)?\.? ?| )1\.0\b", ("eclipse public",)),
    ("cpl", 72, 0.9, r"\bcommon public licen[sc]e\b(?:,?(?: version| v\.?)? ?1\.0)?", ("common public",)),
    ("ibm-public", 72, 0.9, r"\bibm public licen[sc]e\b", ("ibm public",)),
    ("busl-1.1", 72, 0.9, r"\bbusiness source licen[sc]e\b(?:,?(?: version)? 1\.1)?", ("business source",)),
    ("elastic-2", 72, 0.9, r"\belastic licen[sc]e(?:,? (?:version |v\.? ?)?2(?:\.0)?)?\b", ("elastic licen",)),
    ("sspl-1", 72, 0.9, r"\bserver side public licen[sc]e\b|\bsspl\b", ("server side public", "sspl")),
    ("afl-3", 72, 0.9, r"\bacademic free licen[sc]e\b(?:,? ?(?:version |v\.? ?)?(?:3\.0|2\.1))?", ("academic free",)),
    ("osl-3", 72, 0.9, r"\bopen software licen[sc]e\b(?:,? ?(?:version |v\.? ?)?3\.0)?", ("open software",)),
    ("ms-pl", 72, 0.9, r"\bmicrosoft public licen[sc]e\b(?: \(ms-pl\))?|\bms-pl\b", ("microsoft public", "ms-pl")),
    ("ms-rl", 72, 0.9, r"\bmicrosoft reciprocal licen[sc]e\b(?: \(ms-rl\))?|\bms-rl\b", ("microsoft reciprocal", "ms-rl")),
    ("apsl-2", 72, 0.9, r"\bapple public source licen[sc]e\b(?:,? (?:version )?2\.0)?", ("apple public",)),
    ("ncsa", 72, 0.9, r"\b(?:university of illinois/)?ncsa open source licen[sc]e\b", ("ncsa",)),
    ("mulan-psl-2", 72, 0.9, r"\bmulan (?:psl|permissive software licen[sc]e),? ?v(?:ersion )?2\b", ("mulan",)),
    ("cecill", 72, 0.9, r"\bcecill(?:-[bc])?\b(?: (?:free software )?licen[sc]e)?", ("cecill",)),
    ("blueoak", 72, 0.9, r"\bblue oak model licen[sc]e\b", ("blue oak",)),
    ("hippocratic", 72, 0.9, r"\bhippocratic licen[sc]e\b", ("hippocratic",)),
    ("polyform", 72, 0.9, r"\bpolyform (?:noncommercial|small business|shield|perimeter|strict|free trial|internal use) licen[sc]e\b", ("polyform",)),
    ("commons-clause", 72, 0.9, r"\bcommons clause\b", ("commons clause",)),
    ("json", 72, 0.9, r"\bthe software shall be used for good, not evil\b", ("not evil",)),
    ("beerware", 72, 0.9, r"\bbeer-?ware licen[sc]e\b|\bbuy me a beer in return\b", ("beer",)),
    ("zpl", 72, 0.9, r"\bzope public licen[sc]e\b(?: \(zpl\))?(?:,? version 2\.[01])?", ("zope public",)),
    ("ruby", 70, 0.85, r"\bruby licen[sc]e\b", ("ruby",)),
    ("php", 70, 0.85, r"\bphp licen[sc]e\b(?:,? version 3\.0[01]?)?", ("php",)),
    ("openssl", 70, 0.85, r"\bopenssl licen[sc]e\b|\bssleay licen[sc]e\b", ("openssl", "ssleay")),
    ("curl", 70, 0.85, r"\bcurl licen[sc]e\b", ("curl",)),
    ("x11", 72, 0.9, r"\bx11 licen[sc]e\b|\bmit/x11\b|\bmit/x consortium\b", ("x11", "x consortium")),
    ("vim", 70, 0.85, r"\bvim licen[sc]e\b", ("vim",)),
    ("tcl", 70, 0.85, r"\btcl(?:/tk)? licen[sc]e\b", ("tcl",)),
    ("libpng", 70, 0.85, r"\b(?:libpng|png reference library) licen[sc]e\b", ("png",)),
    ("ijg", 70, 0.85, r"\bthis software is based in part on the work of the independent jpeg group\b", ("jpeg group",)),
    ("w3c", 72, 0.9, r"\bw3c(?:\(r\)|®)? software (?:notice and )?licen[sc]e\b|\bw3c software and document notice\b", ("w3c",)),
    ("unicode", 72, 0.9, r"\bunicode(?:,? inc\.)? licen[sc]e(?: agreement|:? v3)?\b", ("unicode",)),
    ("icu", 70, 0.85, r"\bicu licen[sc]e\b", ("icu",)),
    ("hpnd", 55, 0.85, r"\bpermission to use, copy, modify, and distribute this software and its documentation for any purpose", ("and its documentation",)),
    ("bsd-3-clause", 54, 0.8, r"\bneither the names? of .{1,120}? may be used to endorse or promote products", ("endorse or promote",)),
    ("bsd-4-clause", 57, 0.85, r"\ball advertising materials mentioning features or use of this software", ("advertising materials",)),
    ("zlib", 56, 0.85, r"\baltered source versions must be plainly marked as such\b", ("plainly marked",)),
    ("boost", 56, 0.85, r"\bpermission is hereby granted, free of charge, to any person or organization obtaining a copy", ("person or organization",)),
    ("boost", 78, 0.95, r"\bdistributed under the boost software licen[sc]e, version 1\.0\b", ("boost software",)),
    ("wtfpl", 56, 0.85, r"\beveryone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document\b", ("verbatim or modified",)),
    ("wtfpl", 72, 0.9, r"\bdo what the f[a-z*]{3} you want to public licen[sc]e\b", ("you want to public",)),
    ("upl", 72, 0.9, r"\buniversal permissive licen[sc]e\b(?:,? (?:version |v\.? ?)?1\.0)?", ("universal permissive",)),
    ("artistic-1", 72, 0.9, r"\bartistic licen[sc]e,? (?:version )?1\.0\b", ("artistic",)),
    ("artistic-2", 73, 0.9, r"\bartistic licen[sc]e,? (?:version )?2\.0\b", ("artistic",)),
    ("perl", 60, 0.8, r"\bunder the same terms as perl(?: itself)?\b", ("as perl",)),
    ("python", 72, 0.9, r"\bpsf licen[sc]e agreement\b|\bpython software foundation licen[sc]e\b", ("psf", "python software")),
    ("eupl", 72, 0.9, r"\beuropean union public licen[sc]e\b(?: \(eupl\))?(?:,? (?:version |v\.? ?)1\.[12])?", ("european union public",)),
    ("odc-by", 72, 0.9, r"\bopen data commons attribution licen[sc]e\b", ("open data commons",)),
    ("odbl", 72, 0.9, r"\bopen data(?: commons open)? database licen[sc]e\b|\bopen database licen[sc]e\b", ("database licen",)),
    ("cdla-permissive", 72, 0.9, r"\bcommunity data licen[sc]e agreement\W{1,3}permissive\b", ("community data",)),
    ("cdla-sharing", 72, 0.9, r"\bcommunity data licen[sc]e agreement\W{1,3}sharing\b", ("community data",)),
    ("ogl", 72, 0.9, r"\bopen government licen[sc]e\b(?:,? ?v?\.?(?:ersion)? ?[123](?:\.0)?)?", ("open government",)),
    ("dl-de-by", 72, 0.9, r"\bdatenlizenz deutschland\W{1,4}namensnennung\b|\bdl-de/by-2-0\b", ("datenlizenz", "dl-de")),
    ("dl-de-zero", 72, 0.9, r"\bdatenlizenz deutschland\W{1,4}zero\b|\bdl-de/zero-2-0\b", ("datenlizenz", "dl-de")),
    ("etalab", 72, 0.9, r"\blicen[cs]e ouverte\b|\betalab\b", ("ouverte", "etalab")),
    ("openrail", 72, 0.9, r"\b(?:creativeml |bigscience |bigcode )?(?:open ?rail(?:-[ms])*|rail) licen[sc]e\b", ("rail",)),
    ("llama-community", 72, 0.9, r"\bllama [0-9.]{1,4} community licen[sc]e(?: agreement)?\b", ("llama",)),
    ("cc0", 72, 0.9, r"\bcc0 1\.0 universal\b|\bcreative commons cc0\b|\bpublic domain dedication\b", ("cc0", "public domain dedication")),
    ("cc-pdm", 72, 0.9, r"\bpublic domain mark(?: 1\.0)?\b", ("public domain mark",)),
    ("cc-some-rights", 40, 0.6, r"\bsome rights reserved\b", ("some rights reserved",)),
    ("no-known-copyright", 45, 0.7, r"\bno known copyright restrictions\b", ("no known copyright",)),
    ("public-domain", 45, 0.7, r"\bdedicated to the public domain\b|\bplaced in the public domain\b", ("public domain",)),
    ("non-commercial", 30, 0.5, r"\bfor non-?commercial (?:use|purposes)(?: only)?\b|\bnot for commercial use\b", ("commercial",)),
    ("evaluation", 30, 0.5, r"\bfor evaluation purposes only\b", ("evaluation purposes",)),
    ("internal-use", 30, 0.5, r"\bfor internal use only\b", ("internal use only",)),
    ("no-redistribution", 30, 0.5, r"\b(?:may|must) not be (?:re)?distributed without (?:the )?(?:prior )?(?:written )?permission\b", ("without", "permission")),
    ("dual-license", 35, 0.5, r"\bdual[- ]licen[sc]ed\b", ("dual",)),
    # Addresses.
    ("gpl-3", 84, 0.95, r"\bgnu\.org/licenses/(?:old-licenses/)?gpl-3\.0", ("gnu.org",)),
    ("gpl-2", 84, 0.95, r"\bgnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", ("gnu.org",)),
    ("gpl", 83, 0.9, r"\bgnu\.org/(?:copyleft|licenses)/gpl\b(?!-\d)", ("gnu.org",)),
    ("lgpl-3", 84, 0.95, r"\bgnu\.org/licenses/(?:old-licenses/)?lgpl-3\.0", ("gnu.org",)),
    ("lgpl-2.1", 84, 0.95, r"\bgnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", ("gnu.org",)),
    ("agpl-3", 84, 0.95, r"\bgnu\.org/licenses/agpl(?:-3\.0)?", ("gnu.org",)),
    ("gfdl", 84, 0.95, r"\bgnu\.org/(?:copyleft|licenses)/fdl\b", ("gnu.org",)),
    ("apache-2", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/apache-2[.-]0", ("opensource.org", "spdx.org")),
    ("bsd-2-clause", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/bsd-2-clause", ("opensource.org", "spdx.org")),
    ("bsd-3-clause", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/bsd-3-clause", ("opensource.org", "spdx.org")),
    ("mit", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/mit\b", ("opensource.org", "spdx.org")),
    ("isc", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/isc\b", ("opensource.org", "spdx.org")),
    ("gpl-2", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/gpl-2\.0", ("opensource.org", "spdx.org")),
    ("gpl-3", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/gpl-3\.0", ("opensource.org", "spdx.org")),
    ("mpl-2", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/mpl-2\.0", ("opensource.org", "spdx.org")),
    ("artistic-2", 84, 0.95, r"\b(?:opensource|spdx)\.org/licenses?/artistic-2\.0", ("opensource.org", "spdx.org")),
    ("unlicense", 84, 0.95, r"\bunlicense\.org\b", ("unlicense",)),
    ("epl-2", 84, 0.95, r"\beclipse\.org/legal/epl-(?:2\.0|v20)", ("eclipse.org",)),
    ("epl-1", 84, 0.95, r"\beclipse\.org/legal/epl-v10", ("eclipse.org",)),
    ("boost", 84, 0.95, r"\bboost\.org/license_1_0\.txt\b", ("boost.org",)),
    ("odbl", 84, 0.95, r"\bopendatacommons\.org/licenses/odbl\b", ("opendatacommons",)),
    ("pddl", 84, 0.95, r"\bopendatacommons\.org/licenses/pddl\b", ("opendatacommons",)),
    ("odc-by", 84, 0.95, r"\bopendatacommons\.org/licenses/by\b", ("opendatacommons",)),
    ("ofl", 84, 0.95, r"\bscripts\.sil\.org/ofl\b|\bopenfontlicense\.org\b", ("scripts.sil.org", "openfontlicense")),
    ("wtfpl", 84, 0.95, r"\bwtfpl\.net\b", ("wtfpl",)),
    ("polyform", 84, 0.95, r"\bpolyformproject\.org/licenses/", ("polyformproject",)),
    ("busl-1.1", 84, 0.95, r"\bmariadb\.com/bsl11\b", ("mariadb.com",)),
    ("elastic-2", 84, 0.95, r"\belastic\.co/licensing/elastic-license\b", ("elastic.co",)),
    ("sspl-1", 84, 0.95, r"\bmongodb\.com/licensing/server-side-public-license\b", ("mongodb.com",)),
    ("cc-pdm", 85, 0.95, r"\bcreativecommons\.org/publicdomain/mark\b", ("creativecommons.org",)),
    ("blueoak", 84, 0.95, r"\bblueoakcouncil\.org/license\b", ("blueoakcouncil",)),
    ("zlib", 84, 0.95, r"\bzlib\.net/zlib_license\b", ("zlib",)),
    ("python", 84, 0.95, r"\bdocs\.python\.org/[0-9./]*license\b", ("python.org",)),
    ("eupl", 84, 0.95, r"\bjoinup\.ec\.europa\.eu/[\w/.-]{0,80}eupl\b", ("joinup",)),
    ("cecill", 84, 0.95, r"\bcecill\.info/licen[cs]es\b", ("cecill",)),
    ("copyright-notice", 10, 0.2, r"(?:\bcopyright (?:\(c\)|©)|©)\s*\d{4}", ("copyright", "©")),
)

# White space that is not a single blank. Around line breaks the marks of comments belong to it.
_MARKS = r"(?:(?:/?\*++/?|//++!?|#++|;++|--++|%++|>++|\|++|!++|<!--|(?:dnl|rem)(?=\s))\s*+)*+"
_GAP = re.compile(rf"\s(?:(?<=\n)\s*+{_MARKS}|[^\S\n]*+(?:(?:\*++/?|#++|\|++)[^\S\n]*+)?\n\s*+{_MARKS}|\s++|(?<! ))")


class Folded:
    """A text whose gaps are single blanks, and the places in the text itself."""

    def __init__(self, text: str):
        self.places, self.ends = [], []
        parts, at, length = [], 0, 0
        for gap in _GAP.finditer(text):
            start, end = gap.span()
            parts.append(text[at:start])
            length += start - at + 1
            self.places.append(length - 1)
            self.ends.append(end)
            at = end
        self.text = " ".join([*parts, text[at:]]) if parts else text

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The place of a match that neither begins nor ends with a blank."""
        return self._place(start), self._place(end - 1) + 1

    def _place(self, at: int) -> int:
        before = bisect_left(self.places, at)
        return self.ends[before - 1] + at - self.places[before - 1] - 1 if before else at


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern
    keywords: tuple[tuple[str, ...], ...]
    """Alternatives; the rule is run if one of each occurs."""
    closed: bool | None = None
    """For rules of SPDX expressions, whose detections have the labels of the identifiers: whether all of these have to be known."""


def default_rules() -> list[Rule]:
    """The tags, every sentence for every family, and the plain rules, in order of priority."""
    rules = [
        Rule("", priority, confidence, re.compile(pattern), (keywords,), closed) for priority, confidence, pattern, keywords, closed in TAGS
    ] + [
        Rule(label, priority, confidence, re.compile(sentence.format(f"(?:{name})", f"(?:{tag})")), (keywords, tuple(known_by.split("|"))))
        for priority, confidence, sentence, keywords in SENTENCES
        for label, (name, tag, known_by) in FAMILIES.items()
    ] + [
        Rule(label, priority, confidence, re.compile(pattern), (keywords,))
        for label, priority, confidence, pattern, keywords in PLAIN_RULES
    ]
    return sorted(rules, key=lambda rule: -rule.priority)


class Scanner:
    """Finds the detections of a text."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.labels: dict[str, str | None] = {}
        self.identifiers = [(label, re.compile(tag)) for label, (_, tag, _) in FAMILIES.items()]
        self.identifiers += [(label, re.compile(tag)) for label, tag in IDENTIFIERS.items()]
        self.named: dict[tuple[str, int], Rule] = {}
        self.keywords = ahocorasick.Automaton()
        for keyword in {keyword for rule in rules for any_of in rule.keywords for keyword in any_of}:
            self.keywords.add_word(keyword, keyword)
        if rules:
            self.keywords.make_automaton()

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """``(start, end, rule)`` in the lower-case ``text``, without the suppressed ones, by start."""
        if not self.rules:
            return []
        folded = Folded(text)
        there = {keyword for _, keyword in self.keywords.iter(folded.text)}
        if not there:
            return []
        run = [rule for rule in self.rules if all(not there.isdisjoint(any_of) for any_of in rule.keywords)]
        found = [
            (*folded.span(start, end), named)
            for rule in run
            for match in rule.pattern.finditer(folded.text)
            for start, end, named in self.named_in(rule, match)
        ]
        found.sort(key=lambda x: x[:2])
        kept, overlapping, reach = [], [], 0
        for detection in found:
            if overlapping and detection[0] >= reach:
                kept += settled(overlapping)
                overlapping = []
            overlapping.append(detection)
            reach = max(reach, detection[1])
        return kept + settled(overlapping)


    def named_in(self, rule: Rule, match: re.Match) -> list[tuple[int, int, Rule]]:
        """The detections of a match: itself, or one for each known identifier of an expression, the first with the tag before it."""
        if rule.closed is None:
            return [(match.start("later" if match.lastgroup == "later" else 0), match.end(), rule)]
        begin = match.start()
        tagged = 0 if rule.closed else re.search(r"[:=]", match[0]).end()
        out = []
        for operand in _OPERAND.finditer(match[0], tagged):
            word = operand[2].rstrip(".")
            if operand[1] or word in ("and", "or", "with"):
                continue
            label = self._label(word)
            if label is None:
                if rule.closed:
                    return []
                continue
            start = begin + operand.start(2) if out or rule.closed else begin
            out.append((start, begin + operand.start(2) + len(word), self._named(rule, label)))
        return out if len(out) > 1 or not rule.closed else []

    def _label(self, word: str) -> str | None:
        if word not in self.labels:
            if len(self.labels) > 10_000:
                self.labels.clear()
            self.labels[word] = next((label for label, tag in self.identifiers if tag.fullmatch(word)), None)
        return self.labels[word]

    def _named(self, rule: Rule, label: str) -> Rule:
        """The rule of an expression for one label."""
        key = label, rule.priority
        if key not in self.named:
            self.named[key] = replace(rule, label=label)
        return self.named[key]


def settled(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """The detections of a run of overlapping ones that are not suppressed, by start."""
    kept: list[tuple[int, int, Rule]] = []
    for start, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
        inside = any(a <= start and end <= b for a, b, _ in kept)
        beaten = any(a < end and start < b and other.priority > rule.priority for a, b, other in kept)
        if not inside and not beaten:
            kept.append((start, end, rule))
    return sorted(kept, key=lambda x: x[:2])


ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("label", T.StringType())]
                )
            ),
        ),
    ]
)


def scan_licenses(df: DataFrame, text: str = "text", keep: list[str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Licences of every text: ``n_words``; ``n_base``, all places of base phrases; ``first_word`` and
    ``last_word``, the smallest and largest word at which one starts (null without any); ``base_labels`` and
    ``labels``, sorted; ``score``, the chance that a licence is named, from the detections' confidences;
    ``detections``, spans in code points.

    The columns ``keep`` (all by default) stay; those named like a result are replaced. Null texts
    count as empty, and empty ones have no label and score 0.
    """
    return add_columns(df, text, ADDED, lambda: _scan(default_rules() if rules is None else rules), keep)


def _scan(rules: list[Rule]):
    scanner = Scanner(rules)
    phrases = [(phrase.split(" "), label) for phrase, label in BASE_PHRASES.items()]
    keys = [Words(pa.array([phrase])).hashes for phrase in BASE_PHRASES]

    def compute(texts: pa.Array) -> list[pa.Array]:
        words = Words(texts)
        places: dict[int, list[tuple[int, str]]] = {}
        for (phrase, label), key in zip(phrases, keys):
            at = np.flatnonzero(words.hashes[: max(0, len(words.hashes) - len(key) + 1)] == key[0])
            for k in range(1, len(key)):
                at = at[words.hashes[at + k] == key[k]]
            at = at[words.text_of[at] == words.text_of[at + len(key) - 1]]
            for i in at.tolist():
                if words.phrase(i, len(key)) == " ".join(phrase).encode():
                    row = int(words.text_of[i])
                    places.setdefault(row, []).append((i - int(words.first[row]), label))
        lowered = words.data.tobytes()
        bounds = words.bounds.tolist()
        columns = [words.count, [], [], [], [], [], [], []]
        for row, (a, b) in enumerate(zip(bounds, bounds[1:])):
            own = places.get(row, [])
            found = scanner.detections(lowered[a:b].decode())
            base = {label for _, label in own}
            doubt = 0.0 if own else 1.0
            for _, _, rule in found:
                doubt *= 1 - rule.confidence
            values = (
                len(own),
                min(own)[0] if own else None,
                max(own)[0] if own else None,
                sorted(base),
                sorted(base | {rule.label for _, _, rule in found}),
                1 - doubt,
                [{"start": start, "end": end, "label": rule.label} for start, end, rule in found],
            )
            for column, value in zip(columns[1:], values):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, types)]
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())])
        return [*arrays, pa.array(columns[-1], pa.list_(span))]

    return compute
