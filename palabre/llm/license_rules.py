"""Signature rules for licenses: hand-written names, addresses and wordings.

A rule is a regular expression with a keyword that its matches contain. Each license has
a label, a pattern of its names, one of its addresses (or none) and keywords of both.
Together with the forms in which licenses are stated these make several hundred rules. Bodies
and headers of common licenses are found by their own wording, without any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

V = r"(?:,?\s+v(?:ersion)?\.?\s*|\s*-?\s*v?)"
L = r"\s+licen[cs]e"

# Label; names; keyword of the names; addresses; keyword of the addresses.
LICENSES: list[tuple[str, str, str, str, str]] = [
    ("agpl-3.0", rf"(?:gnu\s+)?affero\s+general\s+public{L}{V}3(?:\.0)?|agpl{V}3(?:\.0)?", "agpl|affero", r"gnu\.org/licenses/agpl(?:-3\.0)?", "gnu.org"),
    ("agpl", rf"(?:gnu\s+)?affero\s+general\s+public{L}", "affero", "", ""),
    ("lgpl-3.0", rf"(?:gnu\s+)?lesser\s+general\s+public{L}{V}3(?:\.0)?|lgpl{V}3(?:\.0)?", "lgpl|lesser", r"gnu\.org/licenses/lgpl-3\.0", "gnu.org"),
    ("lgpl-2.1", rf"(?:gnu\s+)?lesser\s+general\s+public{L}{V}2\.1|lgpl{V}2\.1", "lgpl|lesser", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "gnu.org"),
    ("lgpl-2.0", rf"gnu\s+library\s+general\s+public{L}(?:{V}2(?:\.0)?)?|lgpl{V}2(?:\.0)?(?!\.1)", "lgpl|library", r"gnu\.org/licenses/old-licenses/lgpl-2\.0", "gnu.org"),
    ("lgpl", rf"(?:gnu\s+)?lesser\s+general\s+public{L}", "lesser", r"gnu\.org/licenses/lgpl\b", "gnu.org"),
    ("gpl-3.0", rf"(?:gnu\s+)?general\s+public{L}{V}3(?:\.0)?|\bgpl{V}3(?:\.0)?", "gpl|general public", r"gnu\.org/licenses/gpl-3\.0", "gnu.org"),
    ("gpl-2.0", rf"(?:gnu\s+)?general\s+public{L}{V}2(?:\.0)?|\bgpl{V}2(?:\.0)?", "gpl|general public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", "gnu.org"),
    ("gpl-1.0", rf"(?:gnu\s+)?general\s+public{L}{V}1(?:\.0)?|\bgpl{V}1(?:\.0)?", "gpl|general public", r"gnu\.org/licenses/old-licenses/gpl-1\.0", "gnu.org"),
    ("gpl", rf"(?:gnu\s+)?general\s+public{L}|gnu\s+gpl", "general public|gnu", r"gnu\.org/(?:copyleft|licenses)/gpl\b", "gnu.org"),
    ("gfdl", rf"(?:gnu\s+)?free\s+documentation{L}(?:{V}1\.[123])?|\bgfdl\b", "gfdl|documentation", r"gnu\.org/licenses/fdl", "gnu.org"),
    ("apache-2.0", rf"apache(?:\s+software)?{L}{V}2(?:\.0)?|apache\s*-?\s*2\.0", "apache", r"apache\.org/licenses/license-2\.0", "apache.org"),
    ("apache-1.1", rf"apache(?:\s+software)?{L}{V}1\.1", "apache", r"apache\.org/licenses/license-1\.1", "apache.org"),
    ("apache-1.0", rf"apache(?:\s+software)?{L}{V}1\.0", "apache", r"apache\.org/licenses/license-1\.0", "apache.org"),
    ("apache", rf"apache(?:\s+software)?{L}", "apache", r"apache\.org/licenses\b", "apache.org"),
    ("mit", rf"\bmit{L}|expat{L}|\(mit\)", "mit|expat", r"opensource\.org/licen[cs]es?/mit\b", "opensource.org"),
    ("mit-0", rf"mit{L}\s+no\s+attribution|mit\s+no\s+attribution", "no attribution", r"opensource\.org/licen[cs]es?/mit-0", "opensource.org"),
    ("bsd-4-clause", rf"(?:4|four)-clause\s+bsd(?:{L})?|original\s+bsd{L}|bsd\s+4-clause", "bsd", r"spdx\.org/licenses/bsd-4-clause", "spdx.org"),
    ("bsd-3-clause", rf"(?:3|three)-clause\s+bsd(?:{L})?|(?:new|revised|modified)\s+bsd{L}|bsd\s+3-clause", "bsd", r"opensource\.org/licen[cs]es?/bsd-3-clause", "opensource.org"),
    ("bsd-2-clause", rf"(?:2|two)-clause\s+bsd(?:{L})?|simplified\s+bsd{L}|freebsd{L}|bsd\s+2-clause", "bsd", r"opensource\.org/licen[cs]es?/bsd-2-clause", "opensource.org"),
    ("0bsd", rf"(?:0|zero)-clause\s+bsd(?:{L})?", "clause", r"opensource\.org/licen[cs]es?/0bsd", "opensource.org"),
    ("bsd", rf"\bbsd(?:-style)?{L}", "bsd", r"opensource\.org/licen[cs]es?/bsd\b", "opensource.org"),
    ("isc", rf"\bisc{L}", "isc", r"opensource\.org/licen[cs]es?/isc", "opensource.org"),
    ("mpl-2.0", rf"mozilla\s+public{L}{V}2(?:\.0)?|\bmpl{V}2(?:\.0)?", "mozilla|mpl", r"mozilla\.org/(?:en-us/)?mpl/2\.0", "mozilla.org"),
    ("mpl-1.1", rf"mozilla\s+public{L}{V}1\.1|\bmpl{V}1\.1", "mozilla|mpl", r"mozilla\.org/mpl/1\.1", "mozilla.org"),
    ("mpl", rf"mozilla\s+public{L}", "mozilla", r"mozilla\.org/mpl\b", "mozilla.org"),
    ("epl-2.0", rf"eclipse\s+public{L}{V}2(?:\.0)?|\bepl{V}2(?:\.0)?", "eclipse|epl", r"eclipse\.org/legal/epl-(?:v)?2\.?0", "eclipse.org"),
    ("epl-1.0", rf"eclipse\s+public{L}{V}1(?:\.0)?|\bepl{V}1(?:\.0)?", "eclipse|epl", r"eclipse\.org/legal/epl-v?10", "eclipse.org"),
    ("epl", rf"eclipse\s+public{L}", "eclipse", "", ""),
    ("edl-1.0", rf"eclipse\s+distribution{L}", "eclipse", r"eclipse\.org/org/documents/edl-v10", "eclipse.org"),
    ("cddl-1.0", rf"common\s+development\s+and\s+distribution{L}(?:{V}1\.0)?|\bcddl\b", "cddl|common development", r"opensource\.org/licen[cs]es?/cddl", "opensource.org"),
    ("cpl-1.0", rf"common\s+public{L}(?:{V}1\.0)?", "common public", r"opensource\.org/licen[cs]es?/cpl", "opensource.org"),
    ("eupl-1.2", rf"european\s+union\s+public\s+licen[cs]e(?:{V}1\.2)?|\beupl{V}1\.2", "eupl|european union", r"joinup\.ec\.europa\.eu/\S*eupl", "joinup"),
    ("cecill", rf"cecill(?:-[abc])?\s+(?:free\s+software\s+)?licen[cs]e|licence\s+cecill", "cecill", r"cecill\.info/licences", "cecill.info"),
    ("artistic-2.0", rf"artistic{L}{V}2(?:\.0)?", "artistic", r"opensource\.org/licen[cs]es?/artistic-2\.0", "opensource.org"),
    ("artistic", rf"artistic{L}", "artistic", r"dev\.perl\.org/licenses/artistic", "perl.org"),
    ("bsl-1.0", rf"boost\s+software{L}(?:{V}1(?:\.0)?)?", "boost", r"boost\.org/license_1_0", "boost.org"),
    ("busl-1.1", rf"business\s+source{L}(?:{V}1\.1)?", "business source", r"mariadb\.com/bsl11", "mariadb.com"),
    ("sspl-1.0", rf"server\s+side\s+public{L}(?:{V}1)?|\bsspl\b", "sspl|server side", r"mongodb\.com/licensing/server-side-public-license", "mongodb.com"),
    ("elastic-2.0", rf"elastic{L}(?:{V}2(?:\.0)?)?", "elastic", r"elastic\.co/licensing/elastic-license", "elastic.co"),
    ("unlicense", r"\bthe\s+unlicense\b|\bunlicense\b", "unlicense", r"unlicense\.org", "unlicense.org"),
    ("wtfpl", r"\bwtfpl\b|do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public\s+license", "wtfpl|want to public", r"wtfpl\.net", "wtfpl.net"),
    ("zlib", rf"\bzlib(?:/libpng)?{L}", "zlib", r"zlib\.net/zlib_license", "zlib.net"),
    ("libpng", rf"\blibpng{L}", "libpng", r"libpng\.org/\S*license", "libpng.org"),
    ("openssl", rf"openssl{L}", "openssl", r"openssl\.org/source/license", "openssl.org"),
    ("postgresql", rf"postgresql{L}", "postgresql", r"postgresql\.org/about/licen[cs]e", "postgresql.org"),
    ("python-2.0", rf"python(?:\s+software\s+foundation)?{L}(?:{V}2(?:\.0)?)?|\bpsf{L}", "python|psf", r"python\.org/(?:psf/license|\S*license)", "python.org"),
    ("php-3.01", rf"\bphp{L}(?:{V}3\.01)?", "php", r"php\.net/license", "php.net"),
    ("ruby", rf"\bruby{L}", "ruby", r"ruby-lang\.org/\S*license", "ruby-lang"),
    ("ofl-1.1", rf"(?:sil\s+)?open\s+font{L}(?:{V}1\.1)?", "open font", r"scripts\.sil\.org/ofl|openfontlicense\.org", "ofl|openfontlicense"),
    ("ms-pl", rf"microsoft\s+public{L}|\bms-pl\b", "microsoft|ms-pl", r"opensource\.org/licen[cs]es?/ms-pl", "opensource.org"),
    ("ms-rl", rf"microsoft\s+reciprocal{L}|\bms-rl\b", "microsoft|ms-rl", r"opensource\.org/licen[cs]es?/ms-rl", "opensource.org"),
    ("afl-3.0", rf"academic\s+free{L}(?:{V}3(?:\.0)?)?", "academic free", r"opensource\.org/licen[cs]es?/afl", "opensource.org"),
    ("osl-3.0", rf"open\s+software{L}(?:{V}3(?:\.0)?)?", "open software", r"opensource\.org/licen[cs]es?/osl", "opensource.org"),
    ("ncsa", rf"(?:university\s+of\s+illinois/)?ncsa(?:\s+open\s+source)?{L}", "ncsa", r"opensource\.org/licen[cs]es?/ncsa", "opensource.org"),
    ("vim", rf"\bvim{L}", "vim", r"vimhelp\.org/\S*license", "vimhelp"),
    ("w3c", rf"\bw3c\s+(?:software\s+)?(?:notice\s+and\s+)?licen[cs]e", "w3c", r"w3\.org/consortium/legal/\S*(?:copyright|license)", "w3.org"),
    ("x11", rf"\bx11{L}", "x11", r"xfree86\.org/\S*license", "xfree86"),
    ("upl-1.0", rf"universal\s+permissive{L}(?:{V}1(?:\.0)?)?", "universal permissive", r"oss\.oracle\.com/licenses/upl", "oss.oracle.com"),
    ("odbl-1.0", rf"open\s+(?:data\s+commons\s+open\s+)?database{L}|\bodbl\b", "odbl|database", r"opendatacommons\.org/licenses/odbl", "opendatacommons"),
    ("odc-by-1.0", rf"open\s+data\s+commons\s+attribution{L}|\bodc-by\b", "odc-by|commons attribution", r"opendatacommons\.org/licenses/by", "opendatacommons"),
    ("pddl-1.0", rf"public\s+domain\s+dedication\s+and{L}|\bpddl\b", "pddl|dedication", r"opendatacommons\.org/licenses/pddl", "opendatacommons"),
    ("ogl-uk-3.0", rf"open\s+government\s+licen[cs]e(?:{V}[123](?:\.0)?)?", "open government", r"nationalarchives\.gov\.uk/doc/open-government-licen[cs]e", "nationalarchives"),
    ("cc0-1.0", r"\bcc0(?:\s+1\.0)?\b|creative\s+commons\s+zero", "cc0|commons zero", r"creativecommons\.org/publicdomain/zero", "creativecommons"),
    ("cc-pdm", r"public\s+domain\s+mark", "public domain", r"creativecommons\.org/publicdomain/mark", "creativecommons"),
    ("cc-by-nc-nd", r"\bcc[\s-]by-nc-nd(?:[\s-][1-4]\.0)?|attribution[\s-]+noncommercial[\s-]+noderiv\w*", "nc-nd|noderiv", r"creativecommons\.org/licenses/by-nc-nd", "creativecommons"),
    ("cc-by-nc-sa", r"\bcc[\s-]by-nc-sa(?:[\s-][1-4]\.0)?|attribution[\s-]+noncommercial[\s-]+sharealike", "nc-sa|sharealike", r"creativecommons\.org/licenses/by-nc-sa", "creativecommons"),
    ("cc-by-nc", r"\bcc[\s-]by-nc(?:[\s-][1-4]\.0)?|attribution[\s-]+non-?commercial", "by-nc|commercial", r"creativecommons\.org/licenses/by-nc/", "creativecommons"),
    ("cc-by-nd", r"\bcc[\s-]by-nd(?:[\s-][1-4]\.0)?|attribution[\s-]+no-?deriv\w*", "by-nd|deriv", r"creativecommons\.org/licenses/by-nd", "creativecommons"),
    ("cc-by-sa", r"\bcc[\s-]by-sa(?:[\s-][1-4]\.0)?|attribution[\s-]+share-?alike", "by-sa|alike", r"creativecommons\.org/licenses/by-sa", "creativecommons"),
    ("cc-by", r"\bcc[\s-]by(?:[\s-][1-4]\.0)?|creative\s+commons\s+attribution", "cc by|cc-by|commons attribution", r"creativecommons\.org/licenses/by/", "creativecommons"),
    ("all-rights-reserved", r"\ball\s+rights\s+reserved\b", "all rights", "", ""),
]

# Label; a word of the wording; wording of the license's body or header ("..." is up to 20 words).
BODIES: list[tuple[str, str, str]] = [
    ("mit", "hereby", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("ncsa", "hereby", "to any person obtaining a copy of this software and associated documentation files ... to deal with the software without restriction"),
    ("x11", "dealings", "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this software without prior written authorization"),
    ("bsl-1.0", "hereby", "permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ofl-1.1", "hereby", "permission is hereby granted, free of charge, to any person obtaining a copy of the font software"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "endorse", "neither the name of ... may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "endorse", "the name of ... may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("isc", "fee", "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "fee", "permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "fee", "permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted. the software is provided as is"),
    ("postgresql", "fee", "permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("apache-2.0", "unless", "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "irrevocable", "grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("gpl", "redistribute", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-2.0", "redistribute", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3.0", "redistribute", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2.0", "freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft", "the gnu general public license is a free, copyleft license for software and other kinds of works"),
    ("agpl-3.0", "copyleft", "the gnu affero general public license is a free, copyleft license for software and other kinds of works"),
    ("agpl-3.0", "redistribute", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl", "redistribute", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2.0", "source", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "accompanying", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl-1.0", "notices", "do not alter or remove copyright notices or this file header use is subject to the terms of the common development and distribution license"),
    ("zlib", "authors", "in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "just", "you just do what the fuck you want to"),
    ("cc0-1.0", "dedicated", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("python-2.0", "psf", "psf is making python available to licensee on an as is basis"),
    ("openssl", "toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php-3.01", "php", "this product includes php software freely available from"),
    ("artistic-2.0", "artistic", "the intent is that the copyright holder maintains some artistic control over the development of that package"),
]

# Words that go before or after a name when it is said to apply.
GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided|made\s+available)\s+(?:to\s+you\s+)?(?:under|subject\s+to)\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
TERMS = r"(?:subject\s+to|under|see|governed\s+by|terms\s+of)\s+(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+)?"
OPTION = r"(?:,?\s*\(?(?:or|and)\s+(?:\(?at\s+your\s+option\)?\s+)?(?:any\s+)?later(?:\s+version)?\)?)?"


@dataclass(frozen=True)
class Rule:
    """``keywords``: texts of which a match contains one, so others need no search."""

    label: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    #: Of overlapping matches the higher one speaks.
    priority: int
    confidence: float


#: What stands between the words of a body: blanks, punctuation, the marks of comments.
_BETWEEN = r"[^\w]{1,24}"


def _wording(text: str) -> str:
    """A body's words in order, whatever stands between them."""
    words = re.findall(r"\.\.\.|\w+", text)
    parts = [rf"(?:\w+{_BETWEEN}){{1,20}}?" if w == "..." else re.escape(w) + ("" if i == len(words) - 1 else _BETWEEN) for i, w in enumerate(words)]
    return r"\b" + "".join(parts) + r"\b"


def build_rules() -> list[Rule]:
    """All rules; earlier ones win ties."""
    rules = [
        Rule(label, re.compile(_wording(text), re.IGNORECASE | re.ASCII), (word,), 42, 0.97)
        for label, word, text in BODIES
    ]
    for label, names, words, address, address_words in LICENSES:
        tag = re.escape(label)
        name_words, places = tuple(words.split("|")), tuple(address_words.split("|"))
        forms = [
            (rf"spdx-license-identifier:\s*\(?{tag}(?:-or-later|-only|\+)?(?![\w.-])", ("spdx-license",), 50, 1.0),
            (rf"\blicen[cs]e[\"']?\s*[:=]\s*[\"']?{tag}[\"']?(?![\w.-])", (label,), 45, 0.95),
            (rf"{GRANT}(?:{names}){OPTION}", name_words, 40, 0.95),
            (rf"{TERMS}(?:{names}){OPTION}", name_words, 30, 0.85),
            (rf"(?:{names}){OPTION}", name_words, 20, 0.6),
        ]
        if address:
            forms.append((rf"(?:https?://)?(?:www\.)?{address}[\w./-]*", places, 35, 0.9))
        rules += [
            Rule(label, re.compile(p, re.IGNORECASE | re.ASCII), k, priority, sure)
            for p, k, priority, sure in forms
        ]
    return rules
