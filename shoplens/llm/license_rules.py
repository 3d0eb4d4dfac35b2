"""The signature rules of the license scan, in order of priority.

A signature is a phrase of words; between two words any run of characters that
are no word characters may stand (spaces, hyphens, slashes, dots, line breaks),
so ``2.0`` is the words ``2`` and ``0``.  ``a|b`` allows either word, ``x?`` makes
a word optional.  Signatures are written by hand per license family and spelled
out over versions and variants.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

WORD = rb"[0-9a-z\x80-\xff]"
GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"

TAG, TEXT, VERSIONED, GRANT, NAME, BASE = 100, 90, 80, 60, 40, 20
#: How sure a detection of each kind is.
CONFIDENCE = {TAG: 0.98, TEXT: 0.95, VERSIONED: 0.9, GRANT: 0.8, NAME: 0.6, BASE: 0.5}


@dataclass(frozen=True)
class Rule:
    """All ``keywords`` must be words of a text for ``pattern`` to be tried on it."""

    name: str
    label: str
    priority: int
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def compile_phrase(phrase: str) -> re.Pattern:
    out = b""
    begun = False  # a word that every match contains has been written
    for word in phrase.split():
        optional = word.endswith("?")
        choices = b"(?:" + b"|".join(re.escape(w.encode()) for w in word.rstrip("?").split("|")) + b")"
        if not begun:
            # an optional word before it brings the gap behind it along
            out += b"(?:" + choices + GAP + b")?" if optional else choices
            begun = not optional
        else:
            out += b"(?:" + GAP + choices + b")?" if optional else GAP + choices
    return re.compile(b"(?<!" + WORD + b")" + out + b"(?!" + WORD + b")")


def keywords_of(phrase: str) -> tuple[bytes, ...]:
    """The words that every match contains, as whole words."""
    return tuple(dict.fromkeys(w.encode() for w in phrase.split() if "|" not in w and not w.endswith("?")))


#: The phrases and labels of the base detections.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: (label, how the name is written, versions).  The names of lgpl and agpl end in gpl's, so they have all
#: versions of gpl: the longer signature must explain what the shorter one finds in it.
FAMILIES = (
    ("gpl", ("gnu? general public license", "gnu gpl", "gpl"), ("1 0", "2 0", "2", "3 0", "3")),
    ("lgpl", ("gnu? lesser general public license", "gnu? library general public license", "lgpl"), ("1 0", "2 0", "2 1", "2", "3 0", "3")),
    ("agpl", ("gnu? affero general public license", "agpl"), ("1 0", "2 0", "2", "3 0", "3")),
    ("gfdl", ("gnu? free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache software? license", "asl", "apache"), ("1 0", "1 1", "2 0", "2")),
    ("mpl", ("mozilla public license", "mpl"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public license", "epl"), ("1 0", "2 0")),
    ("cddl", ("common development and distribution license", "cddl"), ("1 0", "1 1")),
    ("eupl", ("european union public licence|license", "eupl"), ("1 0", "1 1", "1 2")),
    ("osl", ("open software license", "osl"), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", ("academic free license", "afl"), ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", ("artistic license",), ("1 0", "2 0")),
    ("cpl", ("common public license", "cpl"), ("1 0",)),
    ("ofl", ("sil? open font license", "ofl"), ("1 0", "1 1")),
    ("psf", ("python software foundation license",), ("2", "2 0")),
    ("php", ("php license",), ("3 0", "3 01")),
    ("zpl", ("zope public license", "zpl"), ("1 1", "2 0", "2 1")),
    ("bsl", ("boost software license", "bsl"), ("1 0",)),
    ("ms", ("microsoft public license", "microsoft reciprocal license"), ("1 0",)),
    ("upl", ("universal permissive license", "upl"), ("1 0",)),
    ("cecill", ("cecill free? software? license", "cecill"), ("1 0", "1 1", "2 0", "2 1")),
    ("odbl", ("open database license", "odbl"), ("1 0",)),
    ("lppl", ("latex project public license", "lppl"), ("1 0", "1 1", "1 2", "1 3")),
)

#: Creative Commons: (code, long name); versions follow.
COMMONS = (
    ("by", "attribution"),
    ("by sa", "attribution sharealike"),
    ("by nd", "attribution noderivatives|noderivs"),
    ("by nc", "attribution noncommercial"),
    ("by nc sa", "attribution noncommercial sharealike"),
    ("by nc nd", "attribution noncommercial noderivatives|noderivs"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Identifiers that stand behind an SPDX tag, besides the families' versions.
TAGGED = (
    ("mit", "mit"), ("mit 0", "mit"), ("isc", "isc"), ("0bsd", "bsd"), ("bsd 1 clause", "bsd"),
    ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("bsd 4 clause", "bsd"), ("zlib", "zlib"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("cc0 1 0", "cc0"), ("ncsa", "ncsa"), ("x11", "x11"),
    ("curl", "curl"), ("openssl", "openssl"), ("postgresql", "postgresql"), ("vim", "vim"), ("ruby", "ruby"),
    ("json", "json"), ("beerware", "beerware"), ("libpng", "libpng"), ("ijg", "ijg"), ("ntp", "ntp"),
    ("psf 2 0", "psf"), ("python 2 0", "psf"), ("ms pl", "ms"), ("ms rl", "ms"), ("mit 0", "mit"), ("agpl 3 0", "agpl"),
    ("afl 3 0", "afl"), ("artistic 1 0 perl", "artistic"), ("hpnd", "hpnd"), ("icu", "icu"), ("intel", "intel"),
    ("unicode dfs 2016", "unicode"), ("unicode 3 0", "unicode"), ("wxwindows", "wxwindows"), ("xnet", "xnet"),
    ("zend 2 0", "zend"), ("sleepycat", "sleepycat"), ("spl 1 0", "spl"), ("tcl", "tcl"), ("ftl", "freetype"),
    ("fair", "fair"), ("eudatagrid", "eudatagrid"), ("entessa", "entessa"), ("efl 2 0", "efl"), ("ecl 2 0", "ecl"),
    ("cpal 1 0", "cpal"), ("catosl 1 1", "catosl"), ("bsd source code", "bsd"), ("apsl 2 0", "apsl"), ("aal", "aal"),
    ("liliq p 1 1", "liliq"), ("multics", "multics"), ("naumen", "naumen"), ("nokia", "nokia"), ("oclc 2 0", "oclc"),
    ("qpl 1 0", "qpl"), ("rpl 1 5", "rpl"), ("rpsl 1 0", "rpsl"), ("simpl 2 0", "simpl"), ("watcom 1 0", "watcom"), ("blueoak 1 0 0", "blueoak"), ("mulanpsl 2 0", "mulan"), ("w3c", "w3c"),
)

#: Clauses and notices: (label, priority, phrase).
CLAUSES = (
    ("mit", TEXT, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", TEXT, "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", GRANT, "released|licensed|distributed|available under the terms? of? the? mit license"),
    ("mit", GRANT, "under the mit license"),
    ("mit", NAME, "expat license"),
    ("apache", TEXT, "you may not use this file except in compliance with the license"),
    ("apache", GRANT, "licensed under the apache license"),
    ("apache", TEXT, "licensed to the apache software foundation asf? under one or more contributor license agreements"),
    ("apache", VERSIONED, "apache org licenses license 2 0"),
    ("gpl", TEXT, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", TEXT, "you should have received a copy of the gnu general public license"),
    ("gpl", GRANT, "under the terms of the gnu general public license"),
    ("gpl", GRANT, "published by the free software foundation"),
    ("gpl", VERSIONED, "gnu org licenses gpl"),
    ("lgpl", TEXT, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", GRANT, "under the terms of the gnu lesser general public license"),
    ("lgpl", VERSIONED, "gnu org licenses lgpl"),
    ("agpl", GRANT, "under the terms of the gnu affero general public license"),
    ("bsd", TEXT, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", TEXT, "redistributions of source code must retain the above copyright notice"),
    ("bsd", TEXT, "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", TEXT, "neither the name of the copyright holder nor the names of its contributors"),
    ("bsd", TEXT, "all advertising materials mentioning features or use of this software"),
    ("bsd", GRANT, "licensed|released|distributed under the? a? bsd license"),
    ("bsd", NAME, "bsd license"),
    ("bsd", NAME, "new|modified|simplified|revised bsd license"),
    ("isc", TEXT, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", NAME, "isc license"),
    ("zlib", TEXT, "this software is provided as is without any express or implied warranty"),
    ("zlib", NAME, "zlib license"),
    ("unlicense", TEXT, "this is free and unencumbered software released into the public domain"),
    ("unlicense", NAME, "the unlicense"),
    ("public-domain", GRANT, "released|placed|dedicated into|in|to the public domain"),
    ("public-domain", NAME, "public domain dedication"),
    ("wtfpl", NAME, "do what the fuck you want to public license"),
    ("cc0", NAME, "cc0 1 0 universal"),
    ("cc0", VERSIONED, "creativecommons org publicdomain zero"),
    ("cc", NAME, "creative commons license"),
    ("cc", GRANT, "licensed under a? the? creative commons"),
    ("mpl", TEXT, "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", VERSIONED, "mozilla org mpl"),
    ("epl", TEXT, "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("ofl", GRANT, "this font software is licensed under the sil open font license"),
    ("bsl", VERSIONED, "boost org license"),
    ("openssl", NAME, "openssl license"),
    ("openssl", TEXT, "this product includes software developed by the openssl project"),
    ("postgresql", NAME, "postgresql license"),
    ("beerware", NAME, "beer ware license"),
    ("ncsa", NAME, "university of illinois ncsa open source license"),
    ("vim", NAME, "vim license"),
    ("ruby", NAME, "ruby license"),
    ("json", TEXT, "the software shall be used for good not evil"),
    # further spellings of grants and of names
    ("mit", TAG, "license|licence mit"),
    ("mit", GRANT, "mit licensed"),
    ("mit", GRANT, "mit style license"),
    ("mit", GRANT, "opensource org licenses mit"),
    ("mit", TEXT, "to deal in the software without restriction including without limitation the rights to use copy modify merge"),
    ("mit", TEXT, "the software is provided as is without warranty of any kind express or implied"),
    ("x11", NAME, "x11 license"),
    ("x11", TEXT, "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("hpnd", NAME, "historical permission notice and disclaimer"),
    ("apache", TAG, "license|licence apache 2 0"),
    ("apache", VERSIONED, "apache 2 0"),
    ("apache", VERSIONED, "apache2 license"),
    ("apache", VERSIONED, "apache license v2"),
    ("apache", TEXT, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", TEXT, "see the license for the specific language governing permissions and limitations under the license"),
    ("apache", TEXT, "this product includes software developed by the apache software foundation"),
    ("apache", NAME, "apache software foundation license"),
    ("gpl", TAG, "license|licence gpl"),
    ("gpl", VERSIONED, "gplv1"),
    ("gpl", VERSIONED, "gplv2"),
    ("gpl", VERSIONED, "gplv3"),
    ("gpl", VERSIONED, "gpl2"),
    ("gpl", VERSIONED, "gpl3"),
    ("gpl", VERSIONED, "gpl v2"),
    ("gpl", VERSIONED, "gpl v3"),
    ("gpl", GRANT, "licensed|released|distributed|available under the? gnu? gpl"),
    ("gpl", TEXT, "either version 2 of the license or at your option any later version"),
    ("gpl", TEXT, "either version 3 of the license or at your option any later version"),
    ("gpl", TEXT, "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", TEXT, "this program comes with absolutely no warranty"),
    ("gpl", TEXT, "free software foundation inc 51 franklin"),
    ("gpl", TEXT, "free software foundation inc 59 temple place"),
    ("gpl", NAME, "gpl compatible"),
    ("gpl", NAME, "gpl linking exception"),
    ("gpl", NAME, "gcc runtime library exception"),
    ("gpl", NAME, "classpath exception"),
    ("gpl", NAME, "autoconf exception"),
    ("gpl", NAME, "bison exception"),
    ("gpl", NAME, "font exception"),
    ("lgpl", TAG, "license|licence lgpl"),
    ("lgpl", VERSIONED, "lgplv2"),
    ("lgpl", VERSIONED, "lgplv2 1"),
    ("lgpl", VERSIONED, "lgplv3"),
    ("lgpl", VERSIONED, "lgpl2"),
    ("lgpl", VERSIONED, "lgpl3"),
    ("lgpl", GRANT, "licensed|released|distributed under the? gnu? lgpl"),
    ("lgpl", TEXT, "you should have received a copy of the gnu lesser general public license"),
    ("lgpl", TEXT, "you should have received a copy of the gnu library general public license"),
    ("lgpl", TEXT, "this library is distributed in the hope that it will be useful but without any warranty"),
    ("agpl", TAG, "license|licence agpl"),
    ("agpl", VERSIONED, "agplv3"),
    ("agpl", VERSIONED, "agpl3"),
    ("agpl", TEXT, "you should have received a copy of the gnu affero general public license"),
    ("agpl", VERSIONED, "gnu org licenses agpl"),
    ("gfdl", TEXT, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", TEXT, "with no invariant sections no front cover texts and no back cover texts"),
    ("bsd", TAG, "license|licence bsd"),
    ("bsd", TAG, "license|licence bsd 2 clause"),
    ("bsd", TAG, "license|licence bsd 3 clause"),
    ("bsd", NAME, "berkeley software distribution license"),
    ("bsd", NAME, "two|three|four clause bsd license?"),
    ("bsd", NAME, "bsd style license"),
    ("bsd", NAME, "freebsd license"),
    ("bsd", NAME, "netbsd license"),
    ("bsd", NAME, "openbsd license"),
    ("bsd", GRANT, "opensource org licenses bsd"),
    ("bsd", TEXT, "this software is provided by the copyright holders and contributors as is"),
    ("bsd", TEXT, "this software is provided by the regents and contributors as is"),
    ("bsd", TEXT, "this list of conditions and the following disclaimer"),
    ("bsd", TEXT, "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", TEXT, "this product includes software developed by the university of california berkeley"),
    ("isc", TAG, "license|licence isc"),
    ("isc", GRANT, "licensed|released under the isc license"),
    ("isc", TEXT, "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("zlib", TAG, "license|licence zlib"),
    ("zlib", TEXT, "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", TEXT, "the origin of this software must not be misrepresented"),
    ("zlib", NAME, "zlib libpng license"),
    ("libpng", NAME, "libpng license"),
    ("libpng", NAME, "png reference library license"),
    ("ijg", TEXT, "this software is based in part on the work of the independent jpeg group"),
    ("unlicense", TAG, "license|licence unlicense"),
    ("unlicense", TEXT, "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", VERSIONED, "unlicense org"),
    ("public-domain", GRANT, "this work is in the public domain"),
    ("public-domain", GRANT, "this file|code|software is in the public domain"),
    ("public-domain", TEXT, "the author disclaims copyright to this source code"),
    ("wtfpl", TAG, "license|licence wtfpl"),
    ("wtfpl", NAME, "wtfpl"),
    ("wtfpl", TEXT, "you just do what the fuck you want to"),
    ("cc0", TAG, "license|licence cc0"),
    ("cc0", GRANT, "released|licensed|available under cc0"),
    ("cc0", TEXT, "has waived all copyright and related or neighboring rights"),
    ("cc0", NAME, "creative commons zero"),
    ("cc", TAG, "license|licence cc by"),
    ("cc", NAME, "creative commons attribution"),
    ("cc", NAME, "creative commons public license|licence"),
    ("cc", NAME, "creative commons sampling plus"),
    ("cc", VERSIONED, "creativecommons org licenses"),
    ("mpl", TAG, "license|licence mpl"),
    ("mpl", TEXT, "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", TEXT, "the contents of this file are subject to the mozilla public license"),
    ("mpl", NAME, "incompatible with secondary licenses"),
    ("epl", TAG, "license|licence epl"),
    ("epl", VERSIONED, "eclipse org legal epl"),
    ("edl", NAME, "eclipse distribution license"),
    ("cddl", TAG, "license|licence cddl"),
    ("cddl", TEXT, "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl", TEXT, "under the terms of the common public license"),
    ("eupl", TAG, "license|licence eupl"),
    ("eupl", TEXT, "licensed under the eupl"),
    ("ofl", TEXT, "this font software is licensed under the sil open font license version 1 1"),
    ("ofl", VERSIONED, "scripts sil org ofl"),
    ("ofl", NAME, "reserved font name"),
    ("bsl", TEXT, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl", GRANT, "distributed under the boost software license"),
    ("artistic", TEXT, "you may distribute under the terms of either the gnu general public license or the artistic license"),
    ("artistic", TEXT, "this library is free software you can redistribute it and or modify it under the same terms as perl itself"),
    ("artistic", NAME, "clarified artistic license"),
    ("psf", TEXT, "this license agreement is between the python software foundation"),
    ("psf", NAME, "psf license agreement"),
    ("psf", NAME, "cnri python license"),
    ("php", VERSIONED, "php net license"),
    ("php", TEXT, "this source file is subject to version 3 01 of the php license"),
    ("ruby", TEXT, "you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("openssl", NAME, "ssleay license"),
    ("openssl", TEXT, "this product includes cryptographic software written by eric young"),
    ("curl", NAME, "curl license"),
    ("postgresql", TEXT, "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("beerware", TEXT, "you can buy me a beer in return"),
    ("ncsa", TEXT, "to deal with the software without restriction"),
    ("vim", TEXT, "vim is charityware"),
    ("json", NAME, "json license"),
    ("w3c", NAME, "w3c software notice and license"),
    ("w3c", NAME, "w3c document license"),
    ("w3c", TEXT, "by obtaining using and or copying this work you the licensee agree"),
    ("unicode", NAME, "unicode license agreement"),
    ("unicode", NAME, "unicode terms of use"),
    ("icu", NAME, "icu license"),
    ("freetype", NAME, "freetype project license"),
    ("freetype", NAME, "freetype license"),
    ("sleepycat", NAME, "sleepycat license"),
    ("tcl", NAME, "tcl tk license"),
    ("zend", NAME, "zend engine license"),
    ("qpl", NAME, "q public license"),
    ("ibm", NAME, "ibm public license"),
    ("apsl", NAME, "apple public source license"),
    ("rpsl", NAME, "realnetworks public source license"),
    ("spl", NAME, "sun public license"),
    ("sissl", NAME, "sun industry standards source license"),
    ("nposl", NAME, "non profit open software license"),
    ("ecl", NAME, "educational community license"),
    ("efl", NAME, "eiffel forum license"),
    ("cpal", NAME, "common public attribution license"),
    ("rpl", NAME, "reciprocal public license"),
    ("watcom", NAME, "sybase open watcom public license"),
    ("wxwindows", NAME, "wxwindows library licence|license"),
    ("lppl", TEXT, "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("ms", NAME, "microsoft shared source license"),
    ("ms", NAME, "microsoft limited public license"),
    ("blueoak", NAME, "blue oak model license"),
    ("mulan", NAME, "mulan permissive software license"),
    ("mulan", TEXT, "you can use this software according to the terms and conditions of the mulan psl"),
    ("odbl", TEXT, "this database is made available under the open database license"),
    ("odc-by", NAME, "open data commons attribution license"),
    ("pddl", NAME, "public domain dedication and license"),
    ("ogl", NAME, "open government licence|license"),
    ("ogl", NAME, "open game license"),
    ("opl", NAME, "open publication license"),
    ("opl", NAME, "open content license"),
    ("fal", NAME, "free art license"),
    ("ppl", NAME, "peer production license"),
    ("hippocratic", NAME, "hippocratic license"),
    ("sspl", NAME, "server side public license"),
    ("busl", NAME, "business source license"),
    ("elastic", NAME, "elastic license"),
    ("confluent", NAME, "confluent community license"),
    ("commons-clause", NAME, "commons clause license condition"),
    ("commons-clause", TEXT, "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("parity", NAME, "parity public license"),
    ("prosperity", NAME, "prosperity public license"),
    ("polyform", NAME, "polyform noncommercial|strict|shield license"),
    ("rail", NAME, "responsible ai license"),
    ("rail", NAME, "openrail m"),
    ("bigcode", NAME, "bigcode open rail"),
    ("nvidia", NAME, "nvidia source code license"),
    ("nvidia", NAME, "nvidia software license agreement"),
    ("intel", NAME, "intel simplified software license"),
    ("oracle", NAME, "oracle binary code license agreement"),
    ("oracle", NAME, "oracle technology network license agreement"),
    ("bcl", NAME, "sun microsystems inc binary code license agreement"),
    ("jahia", NAME, "jahia sustainable enterprise license"),
    ("eula", NAME, "end user license|licence agreement"),
    ("shareware", GRANT, "this software|program is shareware"),
    ("freeware", GRANT, "this software|program is freeware"),
    ("commercial", NAME, "commercial license agreement"),
    ("commercial", GRANT, "you must purchase a commercial license"),
    ("evaluation", GRANT, "for evaluation purposes only"),
    ("noncommercial", GRANT, "for non commercial use only"),
    ("noncommercial", GRANT, "for academic use only"),
    ("proprietary", GRANT, "proprietary and confidential"),
    ("proprietary", GRANT, "unauthorized copying of this file"),
    ("proprietary", GRANT, "unauthorized use copying or distribution is prohibited"),
    ("proprietary", GRANT, "trade secret information of"),
    ("proprietary", GRANT, "may not be disclosed without the written permission"),
    ("proprietary", NAME, "proprietary license"),
)


def _phrases() -> list[tuple[str, int, str]]:
    """(label, priority, phrase) of every rule."""
    out: list[tuple[str, int, str]] = []
    for label, names, versions in FAMILIES:
        for name in names:
            if " " in name:
                out.append((label, NAME, name))
            for v in versions:
                out.append((label, VERSIONED, f"{name} {v}"))
                out.append((label, VERSIONED, f"{name} version|v {v}"))
                out.append((label, VERSIONED, f"{name} v{v}"))
                out.append((label, VERSIONED, f"{name} version|v? {v} or any? later"))
        # a tag has the short name, alone or with a version that may be followed by "only" or "or later"
        for short in dict.fromkeys([label, *(n for n in names if " " not in n)]):
            out.append((label, TAG, f"spdx license identifier {short}"))
            for v in versions:
                out.append((label, TAG, f"spdx license identifier {short} {v}"))
                out.append((label, TAG, f"spdx license identifier {short} {v} only"))
                out.append((label, TAG, f"spdx license identifier {short} {v} or later"))
    for code, name in COMMONS:
        for v in COMMONS_VERSIONS:
            out.append((f"cc-{code.replace(' ', '-')}", VERSIONED, f"cc {code} {v}"))
            out.append((f"cc-{code.replace(' ', '-')}", VERSIONED, f"creative commons {name} {v}"))
            out.append((f"cc-{code.replace(' ', '-')}", VERSIONED, f"creativecommons org licenses {code} {v}"))
            out.append((f"cc-{code.replace(' ', '-')}", TAG, f"spdx license identifier cc {code} {v}"))
    for n in ("0", "1", "2", "3", "4"):
        out += [("bsd", VERSIONED, f"bsd {n} clause"), ("bsd", VERSIONED, f"{n} clause bsd license?")]
    out += [(label, TAG, f"spdx license identifier {i}") for i, label in TAGGED]
    out += list(CLAUSES)
    return out


def build_rules() -> list[Rule]:
    """All rules, the highest priority first; the base phrases stand last."""
    seen: dict[str, tuple[str, int]] = {}
    for label, priority, phrase in _phrases():
        seen.setdefault(phrase, (label, priority))
    ordered = sorted(((p, phrase, label) for phrase, (label, p) in seen.items()), key=lambda x: (-x[0], x[1]))
    rules = [Rule(phrase, label, p, keywords_of(phrase), compile_phrase(phrase)) for p, phrase, label in ordered]
    return rules + [Rule(f"base {x}", label, BASE, keywords_of(x), compile_phrase(x)) for x, label in BASE_PHRASES]
