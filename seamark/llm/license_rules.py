"""Signature rules for license notices.

Patterns are over normalised words: one space stands between two words, and punctuation is gone, so
"Apache-2.0" reads "apache 2 0". A rule is tried only on texts that hold its keyword and one of its names. Priorities:
1 for a machine-readable tag, 2 for a grant or a clause of a license text, 3 for a title or a
reference, 4 for a hint. Where one detection's words contain another's, the better priority stays;
with equal priorities the longer one, then the rule that comes first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: label; tag words; name as written in prose. A space inside an optional group belongs to the group.
LICENSES = """
apache-2.0; apache 2 0; apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?
apache-1.1; apache 1 1; apache(?: software)?(?: license)?(?: version)? 1 1
mit; mit; (?:mit|expat)
mit-0; mit 0; mit no attribution
x11; x11; x11
isc; isc; (?:isc|internet systems consortium)
bsd-2-clause; bsd 2 clause; (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)
bsd-3-clause; bsd 3 clause; (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)
bsd-4-clause; bsd 4 clause; (?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)
0bsd; 0bsd; (?:zero clause bsd|bsd zero clause|0bsd)
gpl-1.0; gpl 1 0(?: only| or later)?; (?:gnu )?(?:general public license|gpl)(?: version| v) ?1(?: 0)?
gpl-2.0; gpl 2 0(?: only| or later)?; (?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)?
gpl-3.0; gpl 3 0(?: only| or later)?; (?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)?
lgpl-2.0; lgpl 2 0(?: only| or later)?; (?:gnu )?(?:library general public license|lgpl)(?: version| v)? ?2(?: 0)?
lgpl-2.1; lgpl 2 1(?: only| or later)?; (?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?2 1
lgpl-3.0; lgpl 3 0(?: only| or later)?; (?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?
agpl-3.0; agpl 3 0(?: only| or later)?; (?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?
gfdl-1.2; gfdl 1 2(?: only| or later)?; (?:gnu )?free documentation license(?: version)? 1 2
gfdl-1.3; gfdl 1 3(?: only| or later)?; (?:gnu )?free documentation license(?: version)? 1 3
mpl-1.0; mpl 1 0; (?:mozilla public license|mpl)(?: version| v)? ?1 0
mpl-1.1; mpl 1 1; (?:mozilla public license|mpl)(?: version| v)? ?1 1
mpl-2.0; mpl 2 0; (?:mozilla public license|mpl)(?: version| v)? ?2 0
epl-1.0; epl 1 0; (?:eclipse public license|epl)(?: version| v)? ?1 0
epl-2.0; epl 2 0; (?:eclipse public license|epl)(?: version| v)? ?2 0
cddl-1.0; cddl 1 0; (?:common development and distribution license|cddl)(?: version| v)?(?: ?1 0)?
cddl-1.1; cddl 1 1; (?:common development and distribution license|cddl)(?: version| v)? ?1 1
cpl-1.0; cpl 1 0; common public license(?: version| v)?(?: ?1 0)?
ipl-1.0; ipl 1 0; ibm public license(?: version| v)?(?: ?1 0)?
eupl-1.1; eupl 1 1; (?:european union public licen[cs]e|eupl)(?: version| v)? ?1 1
eupl-1.2; eupl 1 2; (?:european union public licen[cs]e|eupl)(?: version| v)? ?1 2
cecill-2.1; cecill 2 1; cecill(?: free software)?(?: license)?(?: agreement)?(?: version| v)? ?2 1
cecill-b; cecill b; cecill b
cecill-c; cecill c; cecill c
artistic-1.0; artistic 1 0; artistic license(?: version)? 1 0
artistic-2.0; artistic 2 0; artistic license(?: version)? 2 0
zlib; zlib; zlib(?: libpng)?
libpng-2.0; libpng 2 0; (?:libpng|png reference library)(?: license)? version 2
bsl-1.0; bsl 1 0; boost software license(?: version)?(?: 1 0)?
busl-1.1; busl 1 1; business source license(?: version)?(?: 1 1)?
elastic-2.0; elastic 2 0; elastic license(?: version| v)?(?: ?2(?: 0)?)?
sspl-1.0; sspl 1 0; (?:server side public license|sspl)(?: version| v)?(?: ?1)?
unlicense; unlicense; (?:the )?unlicense
wtfpl; wtfpl; (?:wtfpl|do what the fuck you want to public license)
cc0-1.0; cc0 1 0; (?:cc0(?: 1 0)?(?: universal)?|creative commons zero|creative commons cc0)
cc-by-1.0; cc by 1 0; (?:creative commons attribution|cc by)(?: license)? 1 0
cc-by-2.0; cc by 2 0; (?:creative commons attribution|cc by)(?: license)? 2 0
cc-by-2.5; cc by 2 5; (?:creative commons attribution|cc by)(?: license)? 2 5
cc-by-3.0; cc by 3 0; (?:creative commons attribution|cc by)(?: license)? 3 0
cc-by-4.0; cc by 4 0; (?:creative commons attribution|cc by)(?: license)? 4 0
cc-by-sa-2.0; cc by sa 2 0; (?:creative commons attribution share ?alike|cc by sa)(?: license)? 2 0
cc-by-sa-2.5; cc by sa 2 5; (?:creative commons attribution share ?alike|cc by sa)(?: license)? 2 5
cc-by-sa-3.0; cc by sa 3 0; (?:creative commons attribution share ?alike|cc by sa)(?: license)? 3 0
cc-by-sa-4.0; cc by sa 4 0; (?:creative commons attribution share ?alike|cc by sa)(?: license)? 4 0
cc-by-nc-3.0; cc by nc 3 0; (?:creative commons attribution non ?commercial|cc by nc)(?: license)? 3 0
cc-by-nc-4.0; cc by nc 4 0; (?:creative commons attribution non ?commercial|cc by nc)(?: license)? 4 0
cc-by-nd-3.0; cc by nd 3 0; (?:creative commons attribution no ?derivatives|cc by nd)(?: license)? 3 0
cc-by-nd-4.0; cc by nd 4 0; (?:creative commons attribution no ?derivatives|cc by nd)(?: license)? 4 0
cc-by-nc-sa-3.0; cc by nc sa 3 0; (?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: license)? 3 0
cc-by-nc-sa-4.0; cc by nc sa 4 0; (?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: license)? 4 0
cc-by-nc-nd-3.0; cc by nc nd 3 0; (?:creative commons attribution non ?commercial no ?derivatives|cc by nc nd)(?: license)? 3 0
cc-by-nc-nd-4.0; cc by nc nd 4 0; (?:creative commons attribution non ?commercial no ?derivatives|cc by nc nd)(?: license)? 4 0
odbl-1.0; odbl 1 0; (?:open (?:data commons open )?database license|odbl)
odc-by-1.0; odc by 1 0; open data commons attribution license
pddl-1.0; pddl 1 0; (?:public domain dedication and license|pddl)
ogl-uk-3.0; ogl uk 3 0; open government licence(?: version| v)? ?3 0
psf-2.0; psf 2 0; (?:python software foundation|psf)(?: license)?(?: version 2)?
python-2.0; python 2 0; python license 2 0
php-3.01; php 3 01; php license(?: version)? 3 01
ruby; ruby; ruby
ofl-1.1; ofl 1 1; (?:sil )?open font license(?: version)?(?: 1 1)?
ms-pl; ms pl; microsoft public license
ms-rl; ms rl; microsoft reciprocal license
osl-3.0; osl 3 0; open software license(?: version| v)? ?3 0
afl-3.0; afl 3 0; academic free license(?: version| v)? ?3 0
qpl-1.0; qpl 1 0; q public license
ncsa; ncsa; (?:university of illinois ncsa|ncsa)(?: open source)?
postgresql; postgresql; postgresql
openssl; openssl; openssl
vim; vim; vim
w3c; w3c; w3c software(?: notice and)?
upl-1.0; upl 1 0; universal permissive license(?: version| v)?(?: ?1 0)?
mulanpsl-2.0; mulanpsl 2 0; mulan permissive software license(?: version| v)? ?2
openrail; openrail; (?:open rail|openrail)(?: m)?
llama2; llama2; llama 2 community
"""

#: label; priority; score; keyword; pattern
CLAUSES = """
mit; 2; 0.95; hereby; permission is hereby granted free of charge to any person obtaining a copy of this software
mit; 2; 0.8; copyright notice; the above copyright notice and this permission notice shall be included in all copies
isc; 2; 0.9; permission to use; permission to use copy modify and or distribute this software for any purpose
bsd-like; 2; 0.85; redistribution and; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause; 2; 0.9; endorse or; neither the name(?: [^ ]+){1,12} may be used to endorse or promote products
bsd-4-clause; 2; 0.9; advertising materials; all advertising materials mentioning features or use of this software must display
gpl; 2; 0.8; redistribute it; you can redistribute it and or modify it under the terms of the gnu general public license
lgpl; 2; 0.8; redistribute it; you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
agpl; 2; 0.8; affero; under the terms of the gnu affero general public license
gpl; 3; 0.6; gnu; gnu general public license
lgpl; 3; 0.6; gnu; gnu (?:lesser|library) general public license
agpl; 3; 0.6; affero; (?:gnu )?affero general public license
gfdl; 3; 0.6; free documentation; (?:gnu )?free documentation license
mpl; 3; 0.6; mozilla public; mozilla public license
epl; 3; 0.6; eclipse public; eclipse public license
apache; 3; 0.6; apache; apache(?: software)? licen[cs]e
bsd; 3; 0.5; bsd; bsd(?: style)? licen[cs]e
cc; 3; 0.5; creative commons; creative commons(?: public)? licen[cs]e
cc-by-sa; 3; 0.6; by sa; cc by sa
cc-by-nc; 3; 0.6; by nc; cc by nc
cc-by-nd; 3; 0.6; by nd; cc by nd
cc-by-nc-sa; 3; 0.65; nc sa; cc by nc sa
cc-by-nc-nd; 3; 0.65; nc nd; cc by nc nd
public-domain; 2; 0.8; public domain; (?:released|placed|dedicated)(?: in)?to the public domain
public-domain; 3; 0.5; public domain; (?:is|are) in the public domain
unlicense; 2; 0.9; unencumbered; this is free and unencumbered software released into the public domain
zlib; 2; 0.9; held liable; in no event will the authors be held liable for any damages arising from the use of this software
warranty-disclaimer; 4; 0.3; as is; (?:provided|licensed|distributed)(?: by [^ ]+(?: [^ ]+){0,5})?(?: on an)? as is(?: basis)?
warranty-disclaimer; 4; 0.3; warranty; without(?: any)? warranty of any kind
proprietary; 2; 0.8; confidential; proprietary and confidential
proprietary; 2; 0.7; license agreement; end user license agreement
proprietary; 3; 0.6; express written; without the(?: prior)? express written permission
proprietary; 3; 0.6; prior written; without(?: the)? prior written (?:permission|consent)
proprietary; 3; 0.5; may not be; may not be (?:reproduced|copied|redistributed|republished)
copyright-notice; 4; 0.3; copyright; copyright(?: c)? (?:19|20)[0-9][0-9]
copyright-notice; 4; 0.2; copyright; copyright by
unknown-license; 4; 0.2; see; see(?: the)?(?: file)? license(?: file)? for(?: more)? (?:details|information)
unknown-license; 4; 0.2; licensed under; licensed under
unknown-license; 4; 0.2; released under; released under
"""

#: The phrases whose places are counted whatever else is found: label; phrase; score.
BASE = (("cc-by", "cc by", 0.5), ("gpl", "general public license", 0.5), ("reserved", "all rights reserved", 0.3))

#: Parts of words, one of which every text that matches a rule holds.
GATES = ("licen", "copyright", "reserved", "permission", "warrant", "redistribut", "public", "cc", "spdx", "under", "written", "confidential", "reproduc", "copied", "republish", "liable", "endorse", "advertis", "agreement", "provided", "distributed")

VERBS = "(?:licensed|sublicensed|released|distributed|redistributed|available|provided|published|shared|covered|relicensed)"


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    score: float
    keyword: str
    names: tuple[str, ...]
    pattern: str
    base: bool


def spaced(words: str) -> str:
    """Every word of a normalised text has a space on either side of its own."""
    return " " + words.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def literal(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


#: Words too common in rules to tell names apart.
PLAIN = ("license", "version", "public", "software", "open")


def top_level(pattern: str) -> list[tuple[str, bool, bool]]:
    """The pattern's parts (text, is a group, may be absent); nested groups stay inside their part."""
    parts, depth, start = [], 0, 0
    for at, c in enumerate(pattern):
        if c == "(" and not depth:
            parts.append((pattern[start:at], False, False))
            start = at + 3
        depth += (c == "(") - (c == ")")
        if c == ")" and not depth:
            parts.append((pattern[start:at], True, pattern[at + 1 : at + 2] in ("?", "{")))
            start = at + 1
    return [*parts, (pattern[start:], False, False)]


def word_of(plain: str) -> str:
    """The most telling word of literal text; "" without one."""
    words = [w for w in re.sub(r" ?\S\?|\{\d+,\d+\}|^\?|\[[^]]*\]", " ", plain.replace(" ?", "\0")).replace("\0", " ").split() if w.isalnum() and len(w) > 1]
    return max(words, key=lambda w: (w not in PLAIN and not w.isdigit(), len(w)), default="")


def names_of(pattern: str) -> tuple[str, ...]:
    """Words one of which stands in every match of the pattern."""
    parts = top_level(pattern)
    plain = word_of(" ".join(text.replace(" ?", "\0") and text for text, group, _ in parts if not group))
    if plain and plain not in PLAIN and not plain.isdigit():
        return (plain,)
    for text, group, absent in parts:
        if group and not absent:
            return tuple(dict.fromkeys(word_of("".join(t for t, g, _ in top_level(choice) if not g)) for choice in choices(text)))
    return (plain,)


def choices(text: str) -> list[str]:
    """Alternatives of a group, at its own level."""
    found, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            found.append("")
        else:
            found[-1] += c
    return found


def rules() -> list[Rule]:
    found = [(label, 5, score, literal(phrase), (literal(phrase),), phrase, True) for label, phrase, score in BASE]
    for label, priority, score, keyword, pattern in (x.split("; ") for x in CLAUSES.strip().split("\n")):
        found.append((label, int(priority), float(score), literal(keyword), (literal(keyword),), pattern, False))
    for label, tag, name in (x.split("; ") for x in LICENSES.strip().split("\n")):
        names = tuple(" " + w for w in names_of(name))
        end = "(?: licen[cs]e)?(?: only)?(?: or(?: any)? later(?: version)?)?"
        found.append((label, 1, 1.0, literal("spdx"), (" " + tag.split(" ")[0],), f"spdx license identifier {tag}", False))
        found.append((label, 2, 0.9, literal("under"), names, f"{VERBS} under(?: the)?(?: terms of)?(?: the)?(?: gnu)? {name}{end}", False))
        found.append((label, 3, 0.7, " licen", names, f"{name} licen[cs]e", False))
        found.append((label, 3, 0.6, literal("under"), names, f"(?:subject to|governed by|under)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {name}{end}", False))
        found.append((label, 3, 0.75, " licen", (" " + tag.split(" ")[0],), f"licen[cs]e(?: is| name| type| id)? {tag}", False))
    return [Rule(n, label, priority, score, keyword, names, spaced(pattern), base) for n, (label, priority, score, keyword, names, pattern, base) in enumerate(found)]
