"""License scan by ordered signature rules.

A text becomes its lower-case words.  Regular expressions look for licence
statements in the words: notices written out one by one, and a table of licence
names in the phrasings around a name, in SPDX tags and in SPDX expressions.  A rule runs only on texts that hold
its keyword, which every match of it holds.
Rules have priorities; a finding whose words lie inside those of a finding of
higher priority (or of the same and longer) is dropped, so "gnu general public
license version 3" is not also "gpl".  A finding just after a negation ("is not licensed
under ..") is none, nor is one inside it; a base phrase stays, but if all its places are negated it
adds little to the score.  Three fixed base phrases are counted at
every place, whatever the rules say.

Defined results: null and wordless texts have no words, places or labels and
score 0; a label found twice is listed once; repeated rows are judged one by
one; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import per_batch

#: Base phrases and labels (fixed values).
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: label, keyword, the licence's name as a pattern over words, its short identifier as words ('': none of its own), priority.
LICENCES = (
    ("mit", "mit", "mit(?: expat)?", "mit", 50),
    ("mit-0", "mit", "mit (?:0|no attribution)", "mit 0", 60),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache 1 1", 70),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache 2 0", 70),
    ("apache", "apache", "apache(?: software)?", "apache", 40),
    ("gpl-1", "gnu", "gnu general public license(?: version| v)? ?1(?: 0)?", "gpl 1 0", 70),
    ("gpl-2", "gnu", "gnu general public license(?: version| v)? ?2(?: 0)?", "gpl 2 0", 70),
    ("gpl-3", "gnu", "gnu general public license(?: version| v)? ?3(?: 0)?", "gpl 3 0", 70),
    ("gpl", "gnu", "gnu general public", "gpl", 40),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?(?:version|v)? ?2(?: 0)?", "gplv2", 65),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?(?:version|v)? ?3(?: 0)?", "gplv3", 65),
    ("gpl", "gpl", "(?:gnu )?gpl", "", 40),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl ?(?:version|v)? ?2 1", "lgplv2 1", 70),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl ?(?:version|v)? ?3(?: 0)?", "lgplv3", 70),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "", 45),
    ("lgpl", "lesser gpl", "(?:gnu )?lesser gpl", "", 45),
    ("agpl-3", "agpl", "(?:gnu )?agpl ?(?:version|v)? ?3(?: 0)?", "agplv3", 70),
    ("agpl", "agpl", "(?:gnu )?agpl", "", 45),
    ("agpl", "affero gpl", "(?:gnu )?affero gpl", "", 45),
    ("gfdl", "fdl", "(?:gfdl|gnu fdl)", "", 55),
    ("lgpl-2.1", "gnu", "gnu lesser general public license(?: version| v)? ?2 1", "lgpl 2 1", 75),
    ("lgpl-3", "gnu", "gnu lesser general public license(?: version| v)? ?3(?: 0)?", "lgpl 3 0", 75),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public", "lgpl", 45),
    ("agpl-3", "gnu", "gnu affero general public license(?: version| v)? ?3(?: 0)?", "agpl 3 0", 75),
    ("agpl", "gnu", "gnu affero general public", "agpl", 45),
    ("gfdl", "gnu", "gnu free documentation", "gfdl 1 3", 60),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd 2 clause", 70),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|(?:new|revised|modified) bsd)", "bsd 3 clause", 70),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause", 70),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd", 75),
    ("bsd", "bsd", "bsd", "bsd", 40),
    ("isc", "isc", "isc", "isc", 50),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? ?1 1", "mpl 1 1", 70),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?", "mpl 2 0", 70),
    ("mpl", "mozilla", "mozilla public", "mpl", 40),
    ("mpl-1.1", " mpl", "mpl ?(?:version|v)? ?1 1", "", 70),
    ("mpl-2", " mpl", "mpl ?(?:version|v)? ?2(?: 0)?", "", 70),
    ("mpl", " mpl", "mpl", "", 40),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?", "epl 1 0", 70),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?", "epl 2 0", 70),
    ("epl", "eclipse", "eclipse public", "", 40),
    ("epl-1", " epl", "epl ?(?:version|v)? ?1(?: 0)?", "", 70),
    ("epl-2", " epl", "epl ?(?:version|v)? ?2(?: 0)?", "", 70),
    ("epl", " epl", "epl", "", 40),
    ("cddl-1", "cddl", "cddl(?: ?(?:version|v)? ?1(?: 0)?)?", "cddl 1 0", 60),
    ("cddl-1", "common development and distribution", "common development and distribution", "", 60),
    ("artistic-2", "artistic", "artistic license(?: version| v)? ?2(?: 0)?", "artistic 2 0", 60),
    ("boost", "boost", "boost software", "bsl 1 0", 60),
    ("unlicense", "unlicense", "unlicense", "unlicense", 60),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", 60),
    ("wtfpl", "do what the fuck you want to", "do what the fuck you want to(?: public)?", "", 60),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib", 55),
    ("odbl", "open database", "open database", "odbl 1 0", 60),
    ("odbl", "odbl", "odbl(?: ?(?:version|v)? ?1(?: 0)?)?", "", 60),
    ("cc0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0", 75),
    ("cc0", "cc zero", "(?:creative commons )?cc zero(?: 1 0)?(?: universal)?", "", 75),
    ("cc0", "creative commons zero", "creative commons zero(?: v?1 0)?(?: universal)?", "", 75),
    ("cc-by", "cc by", "cc by(?: [1-4] [05])?", "cc by 4 0", 50),
    ("cc-by-sa", "cc by", "cc by sa(?: [1-4] [05])?", "cc by sa 4 0", 70),
    ("cc-by-nd", "cc by", "cc by nd(?: [1-4] [05])?", "cc by nd 4 0", 70),
    ("cc-by-nc", "cc by", "cc by nc(?: [1-4] [05])?", "cc by nc 4 0", 70),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa 4 0", 80),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd 4 0", 80),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by", 50),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by sa", 70),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by nc", 70),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:atives|s)(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by nd", 70),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by nc sa", 80),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:atives|s)(?: [1-4] [05])?(?: international| unported| generic)?", "creative commons by nc nd", 80),
    ("eupl-1.1", "eupl", "eupl ?(?:version|v)? ?1 1", "eupl 1 1", 70),
    ("eupl-1.2", "eupl", "eupl ?(?:version|v)? ?1 2", "eupl 1 2", 70),
    ("eupl", "eupl", "eupl", "", 40),
    ("eupl-1.2", "european union public", "european union public licen[cs]e(?: version| v)? ?1 2", "", 72),
    ("eupl", "european union public", "european union public", "", 45),
    ("afl-3", "academic free", "academic free license(?: version| v)? ?3(?: 0)?", "afl 3 0", 70),
    ("afl", "academic free", "academic free", "", 45),
    ("afl-3", " afl", "afl ?(?:version|v)? ?3(?: 0)?", "", 70),
    ("osl-3", "open software license", "open software license(?: version| v)? ?3(?: 0)?", "osl 3 0", 70),
    ("cpl-1", "common public license", "common public license(?: version| v)? ?1(?: 0)?", "cpl 1 0", 70),
    ("cpl", "common public", "common public", "", 45),
    ("cpl-1", " cpl", "cpl ?(?:version|v)? ?1(?: 0)?", "", 70),
    ("ms-pl", "microsoft public", "microsoft public", "ms pl", 60),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", "ms rl", 60),
    ("ofl-1.1", "open font", "(?:sil )?open font license(?: version| v)? ?1 1", "ofl 1 1", 70),
    ("ofl", "open font", "(?:sil )?open font", "", 45),
    ("psf-2", "python software foundation", "python software foundation", "psf 2 0", 60),
    ("postgresql", "postgresql", "postgresql", "postgresql", 50),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa", 50),
    ("php-3", "php license", "php license(?: version| v)? ?3(?: 01)?", "php 3 01", 60),
    ("upl-1", "universal permissive", "universal permissive license(?: version| v)? ?1(?: 0)?", "upl 1 0", 60),
    ("bsl-1.1", "business source", "business source license(?: version| v)? ?1 1", "busl 1 1", 60),
    ("sspl-1", "server side public", "server side public license(?: version| v)? ?1(?: 0)?", "sspl 1 0", 60),
    ("cecill-2.1", "cecill", "cecill ?(?:version|v)? ?2 1", "cecill 2 1", 60),
    ("odc-by", "open data commons attribution", "open data commons attribution", "odc by 1 0", 60),
    ("pddl", "public domain dedication", "open data commons public domain dedication(?: and)?", "pddl 1 0", 60),
    ("artistic-1", "artistic", "artistic license(?: version| v)? ?1(?: 0)?", "artistic 1 0", 60),
)
#: Phrasings around a licence's name: pattern, added priority, confidence.
PHRASINGS = (
    ("(?:licen[cs]ed|released|distributed|available|published|covered)(?: to you)?(?: under| by)(?: the| an?)?(?: terms of)?(?: the| an?)? {name}(?: licen[cs]e)?(?: {tail})?", 9, 0.95),
    ("(?:under|by|of)(?: the)?(?: terms (?:and conditions )?of)?(?: the)? {name} licen[cs]e", 6, 0.9),
    ("(?:this is |is |are )(?:the )?{name} licen[cs]ed", 6, 0.85),
    ("{name} (?:public )?licen[cs]e(?:d)?", 3, 0.7),
    ("spdx(?: licen[cs]e identifier| id)? {spdx}(?: only| or later)?", 12, 0.99),
)
#: Statements of their own: label, keyword, pattern, priority, confidence.
STATEMENTS = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 95, 0.97),
    ("isc", "permission to use copy", "permission to use copy modify and(?: or)? distribute this software for any purpose", 95, 0.95),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification", 90, 0.9),
    ("public-domain", "public domain", "(?:dedicated to|released (?:in)?to|placed (?:in)?to|is in|in) the public domain", 60, 0.8),
    ("all-rights-reserved", "all rights reserved", "all rights reserved", 30, 0.6),
    ("proprietary", "proprietary", "(?:proprietary and confidential|proprietary licen[cs]e)", 40, 0.7),
    ("cc-by-nc", "cc by nc", "cc by nc", 69, 0.8),
    # notices that name a licence in their own way
    ("gpl-2", "general public license", "gnu general public license as published by the free software foundation (?:either )?version 2 of the license", 96, 0.98),
    ("gpl-3", "general public license", "gnu general public license as published by the free software foundation (?:either )?version 3 of the license", 96, 0.98),
    ("gpl-2", "general public license", "gnu general public license version 2 as published by the free software foundation", 96, 0.98),
    ("gpl-3", "general public license", "gnu general public license version 3 as published by the free software foundation", 96, 0.98),
    ("lgpl-2", "library general public license", "gnu library general public license as published by the free software foundation (?:either )?version 2 of the license", 97, 0.98),
    ("lgpl-2.1", "lesser general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1 of the license", 97, 0.98),
    ("lgpl-3", "lesser general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 3 of the license", 97, 0.98),
    ("agpl-3", "affero general public license", "gnu affero general public license as published by the free software foundation (?:either )?version 3 of the license", 97, 0.98),
    ("gfdl", "free documentation license", "gnu free documentation license version 1 [1-3]", 96, 0.97),
    ("mpl-2", "mozilla public license", "subject to the terms of the mozilla public license v 2 0", 96, 0.98),
    ("mpl-1.1", "mozilla public license", "subject to the mozilla public license version 1 1", 96, 0.98),
    ("epl-1", "eclipse public license", "terms of the eclipse public license v1 0", 96, 0.98),
    ("epl-2", "eclipse public license", "terms of the eclipse public license (?:v )?2 0", 96, 0.98),
    ("apache-2", "apache license", "licensed under the apache license version 2 0 the license", 96, 0.98),
    ("apache-1.1", "apache software license", "apache software license version 1 1", 90, 0.95),
    ("cddl-1", "common development and distribution license", "subject to the terms of the common development and distribution license", 96, 0.95),
    ("boost", "boost software license", "distributed under the boost software license version 1 0", 96, 0.98),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain", 96, 0.98),
    ("wtfpl", "do what the fuck you want to", "you just do what the fuck you want to", 96, 0.95),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such", 95, 0.9),
    ("bsd-3-clause", "endorse or promote", "nor the names of its contributors may be used to endorse or promote products", 95, 0.9),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display", 95, 0.9),
    ("isc", "permission to use copy", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", 96, 0.97),
    ("ofl-1.1", "sil open font license", "this font software is licensed under the sil open font license version 1 1", 96, 0.98),
    ("postgresql", "permission to use copy", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", 96, 0.9),
    ("eupl-1.2", "european union public licence", "european union public licence version 1 2", 96, 0.95),
    ("cc-by", "creativecommons org", "creativecommons org licenses by [1-4] [05]", 90, 0.95),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa [1-4] [05]", 90, 0.95),
    ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd [1-4] [05]", 90, 0.95),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc [1-4] [05]", 90, 0.95),
    ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa [1-4] [05]", 90, 0.95),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd [1-4] [05]", 90, 0.95),
    ("cc0", "creativecommons org", "creativecommons org publicdomain zero 1 0", 90, 0.95),
    ("cc0", "neighboring rights", "waived all copyright and related or neighboring rights", 90, 0.9),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa(?: [1-4] [05])?", 82, 0.85),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd(?: [1-4] [05])?", 82, 0.85),
    ("cc-by-sa", "cc by sa", "cc by sa(?: [1-4] [05])?", 70, 0.8),
    ("cc-by-nd", "cc by nd", "cc by nd(?: [1-4] [05])?", 70, 0.8),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?(?:version|v)? ?2(?: 0)?", 35, 0.6),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?(?:version|v)? ?3(?: 0)?", 35, 0.6),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl ?(?:version|v)? ?2 1", 36, 0.6),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl ?(?:version|v)? ?3(?: 0)?", 36, 0.6),
    ("agpl-3", "agpl", "(?:gnu )?agpl ?(?:version|v)? ?3(?: 0)?", 36, 0.6),
    ("mpl-1.1", " mpl", "mpl ?(?:version|v)? ?1 1", 35, 0.6),
    ("mpl-2", " mpl", "mpl ?(?:version|v)? ?2 0", 35, 0.6),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    made = {}
    for label, keyword, name, spdx, priority in LICENCES:
        for phrasing, more, confidence in PHRASINGS:
            if "{spdx}" in phrasing and not spdx:
                continue
            words = phrasing.format(name=name, spdx=spdx, tail="(?:only|or later)")
            made[words] = Rule(label, keyword.encode() if "{spdx}" not in phrasing else spdx.encode(),
                               re.compile(f" {words}(?= )".encode()), priority + more, confidence)
        if "license(?: version| v)? ?" in name:                  # a full name with its version says enough by itself
            made[name] = Rule(label, keyword.encode(), re.compile(f" {name}(?= )".encode()), priority + 1, 0.6)
    for label, keyword, words, priority, confidence in STATEMENTS:
        made[words] = Rule(label, keyword.encode(), re.compile(f" {words}(?= )".encode()), priority, confidence)
    return sorted(made.values(), key=lambda r: (-r.priority, r.label))


_TAG = re.compile(rb" spdx(?: licen[cs]e identifier| id)?(?= )")
_JOINED = re.compile(rb"(?: only| or later)? (?:or|and)(?= )")


def spdx_ids() -> tuple[re.Pattern, dict[bytes, str]]:
    """A pattern of one short identifier, the longest first, and the label of each."""
    of = {spdx.encode(): label for label, _, _, spdx, _ in reversed(LICENCES) if spdx}
    return re.compile(b" (" + b"|".join(sorted(map(re.escape, of), key=len, reverse=True)) + b")(?= )"), of


def expressions(line: bytes) -> list[tuple]:
    """The identifiers of SPDX expressions ("mit or apache 2 0"), each a finding of its own."""
    out: list[tuple] = []
    if b" spdx " not in line:
        return out
    one, of = spdx_ids()
    for tag in _TAG.finditer(line):
        at = tag.end()
        while m := one.match(line, at):
            out.append((-99, m.start() - m.end(), *m.span(), of[m[1]], 0.97))
            joined = _JOINED.match(line, m.end())
            if not joined:
                break
            at = joined.end()
    return out


#: What turns the statement after it into none: at most two words between.
NEGATED = re.compile(rb" (?:not|never|neither|nor|without being|isn t|aren t|no longer)(?: [a-z]+){0,2}$")


def negated(line: bytes, at: int) -> bool:
    return NEGATED.search(line[max(0, at - 48): at]) is not None


def outside(found: list[tuple], denied: list[tuple[int, int]]) -> list[tuple]:
    """``found`` without what lies within a denied statement; base phrases stay."""
    if not denied:
        return found
    denied.sort()
    starts, ends = [a for a, _ in denied], list(accumulate((b for _, b in denied), max))
    within = lambda f: (k := bisect_right(starts, f[2])) and ends[k - 1] >= f[3]
    return [f for f in found if f[0] == -100 or not within(f)]


#: ASCII to lower case, all but letters and digits to spaces; bytes of other letters stay.
_WORDS = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))


def scan(text: str | None, signatures: list[Rule]) -> dict:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    line = b" %s " % b" ".join(words) if words else b""
    found, places, base = [], [], set()
    for phrase, label in BASE:
        at = line.find(needle := f" {phrase} ".encode())
        while at >= 0:
            places.append(at)
            base.add(label)
            said = not negated(line, at) and not negated(line, line.rfind(b" ", 0, at))
            found.append((-100, 1 - len(needle), at, at + len(needle) - 1, label, 0.9 if said else 0.05))
            at = line.find(needle, at + 1)
    found += expressions(line)
    denied: list[tuple[int, int]] = []
    held: dict[bytes, bool] = {}
    for r in signatures:
        if r.keyword not in held:
            held[r.keyword] = r.keyword in line
        if held[r.keyword]:
            for m in r.pattern.finditer(line):
                if negated(line, m.start()):
                    denied.append(m.span())
                else:
                    found.append((-r.priority, m.start() - m.end(), *m.span(), r.label, r.confidence))
    found = outside(found, denied)
    kept: dict[int, list] = {}                                  # by start; patterns are shorter than 512 characters
    for f in sorted(found):
        k = f[2] >> 9
        if not any(x[2] <= f[2] and f[3] <= x[3] for n in (k - 1, k) for x in kept.get(n, ())):
            kept.setdefault(k, []).append(f)
    chosen = sorted((f for fs in kept.values() for f in fs), key=lambda f: f[2:4])
    best: dict[str, float] = {}
    for f in found:
        if f[0] == -100:
            best[f[4]] = max(f[5], best.get(f[4], 0.0))
    for f in chosen:
        best[f[4]] = max(f[5], best.get(f[4], 0.0))
    doubt = math.prod(1 - c for c in best.values())
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if found else np.empty(0)
    word = lambda at: int(np.searchsorted(spaces, at))          # noqa: E731  words before a space
    return {"n_words": len(words), "n_base": len(places), "first_word": word(min(places)) if places else None,
            "last_word": word(max(places)) if places else None, "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(best)), "score": 1 - doubt,
            "findings": [{"start": word(f[2]), "end": word(f[3]), "label": f[4]} for f in chosen]}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts, labels, score and the kept findings as word spans."""
    finding = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())])
    types = dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), pa.int64()) | {
        "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "findings": pa.list_(finding)}

    def make():
        signatures = rules()

        def judge(b):
            out = [scan(t, signatures) for t in b.column("text").to_pylist()]
            return {name: [o[name] for o in out] for name in types}
        return judge
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return per_batch(rows, ["id"], "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
                                   "score double, findings array<struct<start:int,end:int,label:string>>", types, make)
