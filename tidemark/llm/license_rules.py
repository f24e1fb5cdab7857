"""Signature rules of the license scan.

A rule is ``(label, priority, pattern)``.  Patterns run over words in lower case with one space
between them, so "Version 2.0" reads "version 2 0".  The longest text that every match of a
pattern must hold is its keyword, and is looked up before the pattern is tried.  Priority 0 is a machine-readable tag or a phrase
that names one license, 1 a license text, 2 a named reference, 3 a hint.
"""

from __future__ import annotations

# The phrases every scan must find, and their labels.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Rules written by hand, one signature each.
_WRITTEN = (
    # permissive
    ("mit", 0, r"spdx license identifier mit"),
    ("mit", 0, r"(?:licensed|released|distributed|available) under (?:the terms of )?the mit licen[cs]e"),
    ("mit", 1, r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 1, r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", 2, r"(?:the )?mit licen[cs]e"),
    ("mit", 2, r"opensource org licenses mit"),
    ("mit", 2, r"expat licen[cs]e"),
    ("mit-0", 0, r"mit no attribution(?: licen[cs]e)?"),
    ("x11", 2, r"x11 licen[cs]e"),
    ("apache-2", 0, r"spdx license identifier apache 2 0"),
    ("apache-2", 0, r"licensed under the apache licen[cs]e version 2(?: 0)?"),
    ("apache-2", 1, r"you may obtain a copy of the licen[cs]e at http www apache org licenses license 2 0"),
    ("apache-2", 2, r"apache org licenses license 2 0"),
    ("apache-2", 2, r"apache (?:software )?licen[cs]e v?2(?: 0)?"),
    ("apache-2", 2, r"apache 2 0(?: licen[cs]ed?)?"),
    ("apache-1.1", 1, r"apache (?:software )?licen[cs]e version 1 1"),
    ("apache-1.0", 1, r"apache (?:software )?licen[cs]e version 1 0"),
    ("apache", 3, r"apache (?:software )?licen[cs]ed?"),
    ("bsd-2-clause", 0, r"spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", 0, r"spdx license identifier bsd 3 clause"),
    ("bsd-2-clause", 2, r"(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[cs]e)?"),
    ("bsd-3-clause", 2, r"(?:new|modified|revised|3 clause|three clause) bsd(?: licen[cs]e)?"),
    ("bsd-4-clause", 2, r"(?:original|4 clause|four clause) bsd(?: licen[cs]e)?"),
    ("bsd-4-clause", 1, r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-3-clause", 1, r"may be used to endorse or promote products derived from this software"),
    ("bsd", 1, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, r"bsd(?: style)? licen[cs]e"),
    ("bsd-0-clause", 2, r"(?:zero clause|0 clause) bsd(?: licen[cs]e)?"),
    ("isc", 0, r"spdx license identifier isc"),
    ("isc", 1, r"permission to use copy modify and or distribute this software for any purpose"),
    ("isc", 2, r"isc licen[cs]e"),
    ("zlib", 1, r"this software is provided as is without any express or implied warranty"),
    ("zlib", 2, r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", 2, r"libpng licen[cs]e"),
    ("boost-1.0", 2, r"boost software licen[cs]e(?: version)?(?: 1 0)?"),
    ("boost-1.0", 0, r"spdx license identifier bsl 1 0"),
    ("postgresql", 2, r"postgresql licen[cs]e"),
    ("python-2.0", 2, r"python software foundation licen[cs]e(?: version 2)?"),
    ("psf-2.0", 2, r"psf licen[cs]e(?: agreement)?"),
    ("php-3.0", 2, r"php licen[cs]e(?: version)? 3 0(?:1)?"),
    ("ruby", 2, r"ruby(?: s)? licen[cs]e"),
    ("perl-artistic", 2, r"artistic licen[cs]e"),
    ("perl-artistic-2.0", 1, r"artistic licen[cs]e(?: version)? 2 0"),
    ("openssl", 2, r"openssl licen[cs]e"),
    ("curl", 2, r"curl licen[cs]e"),
    ("ntp", 2, r"ntp licen[cs]e"),
    ("unicode", 2, r"unicode licen[cs]e(?: v3)?"),
    ("icu", 2, r"icu licen[cs]e"),
    ("wtfpl", 2, r"wtfpl"),
    ("unlicense", 0, r"spdx license identifier unlicense"),
    ("unlicense", 1, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 2, r"the unlicense"),
    ("afl-3.0", 2, r"academic free licen[cs]e(?: version)?(?: 3 0)?"),
    ("ecl-2.0", 2, r"educational community licen[cs]e(?: version)?(?: 2 0)?"),
    ("ncsa", 2, r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("upl-1.0", 2, r"universal permissive licen[cs]e(?: version)?(?: 1 0)?"),
    ("bluesky-blueoak-1.0", 2, r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("ms-pl", 2, r"microsoft public licen[cs]e"),
    ("ms-rl", 2, r"microsoft reciprocal licen[cs]e"),
    ("w3c", 2, r"w3c software(?: notice)?(?: and)?(?: document)? licen[cs]e"),
    ("zpl-2.1", 2, r"zope public licen[cs]e(?: version)?(?: 2 1)?"),
    ("beerware", 2, r"beer ?ware licen[cs]e"),
    ("json", 1, r"the software shall be used for good not evil"),
    ("ftl", 2, r"freetype(?: project)? licen[cs]e"),
    ("imagemagick", 2, r"imagemagick licen[cs]e"),
    ("vim", 2, r"vim licen[cs]e"),
    ("mulan-psl-2.0", 2, r"mulan permissive software licen[cs]e(?: version)?(?: 2)?"),
    # weak and strong copyleft beside the GNU family
    ("mpl-2.0", 0, r"spdx license identifier mpl 2 0"),
    ("mpl-2.0", 1, r"subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"),
    ("mpl-2.0", 2, r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl-1.1", 2, r"mozilla public licen[cs]e(?: version| v)? ?1 1"),
    ("mpl-1.0", 2, r"mozilla public licen[cs]e(?: version| v)? ?1 0"),
    ("mpl", 3, r"mozilla public licen[cs]e"),
    ("epl-1.0", 2, r"eclipse public licen[cs]e(?: version| v)? ?1 0"),
    ("epl-2.0", 2, r"eclipse public licen[cs]e(?: version| v)? ?2 0"),
    ("epl", 3, r"eclipse public licen[cs]e"),
    ("edl-1.0", 2, r"eclipse distribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cddl-1.0", 2, r"cddl(?: version| v)? ?1 0"),
    ("cddl-1.1", 2, r"cddl(?: version| v)? ?1 1"),
    ("cddl", 2, r"common development and distribution licen[cs]e"),
    ("cpl-1.0", 2, r"common public licen[cs]e(?: version)?(?: 1 0)?"),
    ("cpal-1.0", 2, r"common public attribution licen[cs]e"),
    ("ipl-1.0", 2, r"ibm public licen[cs]e(?: version)?(?: 1 0)?"),
    ("apsl-2.0", 2, r"apple public source licen[cs]e(?: version)?(?: 2 0)?"),
    ("eupl-1.1", 2, r"european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", 2, r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", 3, r"european union public licen[cs]e"),
    ("osl-3.0", 2, r"open software licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("qpl-1.0", 2, r"q public licen[cs]e(?: version)?(?: 1 0)?"),
    ("sleepycat", 2, r"sleepycat(?: public)? licen[cs]e"),
    ("cecill-2.1", 2, r"cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?: version| v)? ?2 1"),
    ("cecill-b", 2, r"cecill b"),
    ("cecill-c", 2, r"cecill c"),
    ("ms-lpl", 2, r"microsoft limited public licen[cs]e"),
    ("rpl-1.5", 2, r"reciprocal public licen[cs]e(?: version)?(?: 1 5)?"),
    ("gfdl", 2, r"gnu free documentation licen[cs]e"),
    ("gfdl-1.1", 1, r"gnu free documentation licen[cs]e version 1 1"),
    ("gfdl-1.2", 1, r"gnu free documentation licen[cs]e version 1 2"),
    ("gfdl-1.3", 1, r"gnu free documentation licen[cs]e version 1 3"),
    # content, data and fonts
    ("cc0-1.0", 0, r"spdx license identifier cc0 1 0"),
    ("cc0-1.0", 2, r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", 2, r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", 3, r"creative commons attribution"),
    ("cc-by-sa", 2, r"creative commons attribution share ?alike"),
    ("cc-by-nd", 2, r"creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc", 2, r"creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", 2, r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", 2, r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc", 3, r"creative commons licen[cs]e"),
    ("odbl-1.0", 2, r"open (?:data commons open )?database licen[cs]e"),
    ("odc-by-1.0", 2, r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", 2, r"open data commons public domain dedication(?: and licen[cs]e)?"),
    ("ofl-1.1", 2, r"(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?"),
    ("ubuntu-font-1.0", 2, r"ubuntu font licen[cs]e(?: version)?(?: 1 0)?"),
    ("free-art-1.3", 2, r"free art licen[cs]e(?: version)?(?: 1 3)?"),
    ("ogl-uk", 2, r"open government licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("cdla-permissive", 2, r"community data licen[cs]e agreement permissive"),
    ("cdla-sharing", 2, r"community data licen[cs]e agreement sharing"),
    ("public-domain", 2, r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", 3, r"in the public domain"),
    # source-available and proprietary
    ("busl-1.1", 2, r"business source licen[cs]e(?: version)?(?: 1 1)?"),
    ("sspl-1.0", 2, r"server side public licen[cs]e(?: version| v)?(?: 1)?"),
    ("elastic-2.0", 2, r"elastic licen[cs]e(?: version)?(?: 2 0)?"),
    ("commons-clause", 2, r"commons clause(?: licen[cs]e)?(?: condition)?"),
    ("polyform-noncommercial", 2, r"polyform noncommercial licen[cs]e"),
    ("polyform", 3, r"polyform [a-z]+(?: [a-z]+)? licen[cs]e"),
    ("openrail", 2, r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)?"),
    ("rail", 2, r"responsible ai licen[cs]e"),
    ("llama-community", 2, r"llama [0-9](?: [0-9])? community licen[cs]e(?: agreement)?"),
    ("gemma", 2, r"gemma terms of use"),
    ("proprietary", 2, r"proprietary and confidential"),
    ("proprietary", 2, r"unauthori[sz]ed (?:copying|reproduction) (?:of this file )?(?:is )?(?:strictly )?prohibited"),
    ("proprietary", 3, r"all rights reserved"),
    ("noncommercial", 3, r"(?:for )?non ?commercial use only"),
    ("copyright", 3, r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*"),
    ("licensed", 3, r"licensed under the (?:terms of the )?[a-z0-9]+(?: [a-z0-9]+){0,3}? licen[cs]e"),
    ("see-license", 3, r"see (?:the )?(?:accompanying )?licen[cs]e (?:file )?for (?:more )?(?:details|information)"),
)


def _gnu() -> list[tuple[str, int, str]]:
    """The GNU family: every version in every customary way to name it."""
    out = []
    families = (
        ("gpl", "gnu general public licen[cs]e", ("1", "2", "3")),
        ("lgpl", "gnu (?:lesser|library) general public licen[cs]e", ("2", "2 1", "3")),
        ("agpl", "gnu affero general public licen[cs]e", ("1", "3")),
    )
    later = "(?: or(?: at your option)? any later version| or later)"
    for short, name, versions in families:
        for version in versions:
            label = f"{short}-{version.replace(' ', '.')}"
            number = version if " " in version else f"{version}(?: 0)?"
            tag = version if " " in version else f"{version} 0"
            out += [
                (label, 0, rf"spdx license identifier {short} {tag}(?: only)?"),
                (f"{label}-or-later", 0, rf"spdx license identifier {short} {tag} or later"),
                (label, 1, rf"{name}(?: as published by the free software foundation)?(?: either)? (?:version |v)?{number}"),
                (f"{label}-or-later", 1, rf"{name}(?: as published by the free software foundation)?(?: either)? (?:version |v)?{number}(?: of the licen[cs]e)?{later}"),
                (label, 2, rf"(?:gnu )?{short} ?(?:version |v)?{number}"),
                (f"{label}-or-later", 2, rf"(?:gnu )?{short} ?(?:version |v)?{number}{later}"),
            ]
        out += [(short, 3, name), (short, 3, rf"(?:gnu )?{short}(?: licen[cs]ed?)?")]
    return out


def _creative_commons() -> list[tuple[str, int, str]]:
    """Creative Commons: every kind in every version, as tag, as short name and as address."""
    out = []
    for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        dashed = kind.replace(" ", "-")
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"cc-{dashed}-{version.replace(' ', '.')}"
            out += [
                (label, 0, rf"spdx license identifier cc {kind} {version}"),
                (label, 1, rf"cc {kind} {version}"),
                (label, 1, rf"creativecommons org licenses {kind} {version}"),
            ]
        out.append((f"cc-{dashed}", 2, rf"cc {kind}"))
    return out


def rules() -> list[tuple[str, int, str]]:
    """All rules in their order; among equals the earlier one wins."""
    return [*((label, 0, phrase) for label, phrase in BASE_PHRASES), *_WRITTEN, *_gnu(), *_creative_commons()]


def keyword(pattern: str) -> str:
    """The longest run of plain characters that every match of the pattern holds."""
    runs, run, i = [], "", 0
    while i < len(pattern):
        c, end = pattern[i], i + 1
        if c == "(":
            depth = 1
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0)
                end += 1
        elif c == "[":
            end = pattern.index("]", i) + 1
        elif c in "|.\\":
            raise ValueError(f"no keyword can be read from {pattern}")
        plain = c not in "(["
        while end < len(pattern) and pattern[end] in "?*+{":
            plain = plain and pattern[end] == "+"
            end = pattern.index("}", end) + 1 if pattern[end] == "{" else end + 1
        if plain:
            run += c
        if not plain or end > i + 1:
            runs, run = [*runs, run], ""
        i = end
    return max([*runs, run], key=len)


def root(literal: str) -> str:
    """The part of a keyword that is looked up in the text as it stands, so inside one word."""
    return "licen" if "licen" in literal else max(literal.split(), key=len)
