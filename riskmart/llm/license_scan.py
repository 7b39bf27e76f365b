"""License scan: ordered signature rules behind a keyword prefilter, in DataFrame functions only.

A text becomes its lower-case words; rules are regular expressions over words. A rule is tried on a document only if all of its keywords are among the
document's words, which one hash intersection finds. Every match is a detection: first and last word, rule, label, priority and weight. A detection
inside the interval of one of higher priority goes, and so does one inside a longer one of equal priority or inside an equal interval of an
earlier rule; containment and this order are transitive, so one pass by start that keeps the furthest end seen at each priority decides all.

Base phrases stand above all other rules and are never suppressed.

Defined cases: a null or empty text has no words, no detection and score 0. Repeated rows stay separate rows. An empty table gives an empty result. Only
``id_col`` and ``text_col`` are read, so other columns cannot clash. Texts are scanned whole; a row's work grows with its words and detections.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks around a match; they cannot stand in words.
_OPEN, _CLOSE = "\x01", "\x02"
#: Priorities from low to high: names, grants and texts, identifiers, base phrases.
NAME, GRANT, IDENTIFIER, BASE = range(4)
WEIGHTS = {NAME: 0.8, GRANT: 0.95, IDENTIFIER: 1.0, BASE: 1.0}
#: Kept detections are appended in blocks of this many, so that a text full of them is not copied once for each.
BLOCK = 256

#: Base phrases and their labels (fixed values, but for the marks of keywords).
BASE_PHRASES = {"under the @mit license": "mit", "@apache license version 2": "apache-2", "@cc by nc": "cc-by-nc"}

#: One family a line: label | identifiers | names | addresses. ``@`` marks a word that every match holds (the keyword); ``L`` is either spelling of license.
FAMILIES = """
mit | mit | @mit L ; @expat L ; mit style L @mit ; L @mit | @opensource org licenses mit ; @choosealicense com licenses mit
mit-0 | mit 0 | @mit no attribution(?: L)? | @opensource org licenses mit 0
x11 | x11 | @x11 L ; @x11 style L | @opensource org licenses x11
apache-1.0 | apache 1 0 | @apache L version 1 0 ; @apache L 1 0 | @apache org licenses license 1 0
apache-1.1 | apache 1 1 | @apache (?:software )?L version 1 1 ; @apache (?:software )?L 1 1 | @apache org licenses license 1 1
apache-2 | apache 2 0 | @apache (?:software )?L(?: v| version)? ?2(?: 0)? ; @apache 2 0(?: L)? ; version 2 0 of the @apache L ; asl @asl 2 0 | @apache org licenses license 2 0 ; @opensource org licenses apache 2 0
apache | apache | @apache (?:software )?L ; @apache style L | @apache org licenses
bsd-0-clause | 0bsd | zero clause @bsd(?: L)? ; @bsd zero clause L ; 0 clause @bsd(?: L)? | @opensource org licenses 0bsd
bsd-1-clause | bsd 1 clause | @bsd 1 clause(?: L)? ; 1 clause @bsd(?: L)? | @opensource org licenses bsd 1 clause
bsd-2-clause | bsd 2 clause | @bsd 2 clause(?: L)? ; (?:2|two) clause @bsd(?: L)? ; simplified @bsd(?: L)? ; @freebsd L | @opensource org licenses bsd 2 clause
bsd-3-clause | bsd 3 clause | @bsd 3 clause(?: L)? ; (?:3|three) clause @bsd(?: L)? ; (?:new|revised|modified) @bsd(?: L)? | @opensource org licenses bsd 3 clause
bsd-4-clause | bsd 4 clause | @bsd 4 clause(?: L)? ; (?:4|four) clause @bsd(?: L)? ; (?:original|old) @bsd(?: L)? | @spdx org licenses bsd 4 clause
bsd | bsd | @bsd L ; @bsd style L ; berkeley software distribution L @berkeley | @opensource org licenses bsd license
gpl-1 | gpl 1 0(?: only| or later)? | gnu @gpl(?: L)? (?:v|version )1 ; @gpl ?v?1(?: 0)? only ; gnu general public L version 1 @general | @gnu org licenses gpl 1 0
gpl-2 | gpl 2 0(?: only| or later)? | gnu @general public L(?: as published by the free software foundation)?(?: either)? (?:v|version )2(?: 0)?(?: or any later version)? ; gnu @general public L v2 ; (?:gnu )?@gpl(?: version| v)? 2(?: 0)?(?: or later| only)? ; (?:gnu )?@gplv2 | @gnu org licenses gpl 2 0 ; @gnu org licenses old licenses gpl 2 0
gpl-3 | gpl 3 0(?: only| or later)? | gnu @general public L(?: as published by the free software foundation)?(?: either)? (?:v|version )3(?: 0)?(?: or any later version)? ; gnu @general public L v3 ; (?:gnu )?@gpl(?: version| v)? 3(?: 0)?(?: or later| only)? ; (?:gnu )?@gplv3 | @gnu org licenses gpl 3 0
gpl | gpl | gnu @general public L ; gnu @gpl ; @gpl L | @gnu org licenses gpl ; @gnu org copyleft gpl
lgpl-2 | lgpl 2 0(?: only| or later)? | gnu @library general public L(?: version 2(?: 0)?)? ; (?:gnu )?@lgpl(?: version| v)? 2(?: 0)?(?: or later| only)? | @gnu org licenses lgpl 2 0
lgpl-2.1 | lgpl 2 1(?: only| or later)? | gnu @lesser general public L(?: v| version)? 2 1(?: or any later version)? ; (?:gnu )?@lgpl(?: version| v)? 2 1(?: or later| only)? ; @lgplv2 1 | @gnu org licenses lgpl 2 1 ; @gnu org licenses old licenses lgpl 2 1
lgpl-3 | lgpl 3 0(?: only| or later)? | gnu @lesser general public L(?: v| version)? 3(?: 0)?(?: or any later version)? ; (?:gnu )?@lgpl(?: version| v)? 3(?: 0)?(?: or later| only)? ; @lgplv3 | @gnu org licenses lgpl 3 0
lgpl | lgpl | gnu @lesser general public L ; gnu @lgpl ; @lgpl L | @gnu org licenses lgpl
agpl-1 | agpl 1 0(?: only| or later)? | @affero general public L(?: v| version)? 1(?: 0)? | @affero org oagpl
agpl-3 | agpl 3 0(?: only| or later)? | (?:gnu )?@affero general public L(?: v| version)? 3(?: 0)?(?: or any later version)? ; (?:gnu )?@agpl(?: version| v)? 3(?: 0)?(?: or later| only)? ; @agplv3 | @gnu org licenses agpl 3 0
agpl | agpl | (?:gnu )?@affero general public L ; gnu @agpl ; @agpl L | @gnu org licenses agpl
gfdl-1.1 | gfdl 1 1(?: only| or later)? | gnu free @documentation L version 1 1 | @gnu org licenses fdl 1 1
gfdl-1.2 | gfdl 1 2(?: only| or later)? | gnu free @documentation L version 1 2(?: or any later version)? | @gnu org licenses fdl 1 2
gfdl-1.3 | gfdl 1 3(?: only| or later)? | gnu free @documentation L version 1 3(?: or any later version)? | @gnu org licenses fdl 1 3
gfdl | gfdl | gnu free @documentation L ; gnu @fdl ; @gfdl | @gnu org licenses fdl ; @gnu org copyleft fdl
mpl-1.0 | mpl 1 0 | @mozilla public L(?: v| version)? 1 0 ; @mpl(?: v| version)? 1 0 | @mozilla org mpl 1 0
mpl-1.1 | mpl 1 1 | @mozilla public L(?: v| version)? 1 1 ; @mpl(?: v| version)? 1 1 | @mozilla org mpl 1 1
mpl-2.0 | mpl 2 0 | @mozilla public L(?: v| version)? 2 0 ; @mpl(?: v| version)? 2 0 | @mozilla org mpl 2 0 ; @mozilla org en us mpl 2 0
mpl | mpl | @mozilla public L | @mozilla org mpl
epl-1.0 | epl 1 0 | @eclipse public L(?: v| version)? 1 0 ; @epl(?: v| version)? 1 0 | @eclipse org legal epl v10
epl-2.0 | epl 2 0 | @eclipse public L(?: v| version)? 2 0 ; @epl(?: v| version)? 2 0 | @eclipse org legal epl 2 0
epl | epl | @eclipse public L | @eclipse org legal epl
edl-1.0 | edl 1 0 | @eclipse distribution L(?: v| version)?(?: 1 0)? | @eclipse org org documents edl v10
cddl-1.0 | cddl 1 0 | common development and distribution L(?: version)? 1 0 @development ; @cddl(?: v| version)? 1 0 | @opensource org licenses cddl 1 0
cddl-1.1 | cddl 1 1 | common development and distribution L(?: version)? 1 1 @development ; @cddl(?: v| version)? 1 1 | @glassfish java net public cddl
cddl | cddl | common development and distribution L @development ; @cddl L | @opensource org licenses cddl1
cpl-1.0 | cpl 1 0 | common public L(?: version)? 1 0 @common ; @cpl(?: v| version)? 1 0 | @opensource org licenses cpl1 0
ipl-1.0 | ipl 1 0 | @ibm public L(?: version)?(?: 1 0)? | @opensource org licenses ipl 1 0
eupl-1.1 | eupl 1 1 | european union public L(?: v| version)? 1 1 @european ; @eupl(?: v| version)? 1 1 | @joinup ec europa eu software page eupl 1 1
eupl-1.2 | eupl 1 2 | european union public L(?: v| version)? 1 2 @european ; @eupl(?: v| version)? 1 2 | @joinup ec europa eu collection eupl eupl text eupl 12
eupl | eupl | european union public L @european ; @eupl L | @joinup ec europa eu community eupl
artistic-1.0 | artistic 1 0(?: perl| cl8)? | @artistic L(?: v| version)? 1 0 | @opensource org licenses artistic 1 0
artistic-2.0 | artistic 2 0 | @artistic L(?: v| version)? 2 0 | @opensource org licenses artistic 2 0 ; @perlfoundation org artistic license 2 0
artistic | artistic | @artistic L ; same terms as @perl itself | @opensource org licenses artistic license
bsl-1.0 | bsl 1 0 | @boost software L(?: version)?(?: 1 0)? | @boost org license 1 0
bsl-1.1 | busl 1 1 | business source L(?: version)?(?: 1 1)? @business | @mariadb com bsl11
isc | isc | @isc L ; internet systems consortium L @consortium | @opensource org licenses isc
zlib | zlib | @zlib L ; @zlib libpng L | @opensource org licenses zlib ; @zlib net zlib license
libpng | libpng(?: 2 0)? | @libpng L | @libpng org pub png src libpng license
unlicense | unlicense | the @unlicense ; @unlicense L | @unlicense org
wtfpl | wtfpl | @wtfpl ; do what the f[a-z]* you want to public L @want | @wtfpl net
cc0-1.0 | cc0 1 0 | @cc0(?: 1 0)?(?: universal)? ; creative commons zero(?: v?1 0)?(?: universal)? @commons | @creativecommons org publicdomain zero 1 0
cc-pddc | cc pddc | creative commons public domain dedication @dedication | @creativecommons org licenses publicdomain
public-domain | - | (?:released |placed |dedicated )?(?:in|into|to) the public @domain ; this (?:work|file|software|text) is in the public @domain | @creativecommons org publicdomain mark 1 0
cc-by-1.0 | cc by 1 0 | cc by 1 0 @cc ; creative commons @attribution 1 0(?: L)? | @creativecommons org licenses by 1 0
cc-by-2.0 | cc by 2 0 | cc by 2 0 @cc ; creative commons @attribution 2 0(?: L)? | @creativecommons org licenses by 2 0
cc-by-2.5 | cc by 2 5 | cc by 2 5 @cc ; creative commons @attribution 2 5(?: L)? | @creativecommons org licenses by 2 5
cc-by-3.0 | cc by 3 0 | cc by 3 0 @cc ; creative commons @attribution 3 0(?: unported)?(?: L)? | @creativecommons org licenses by 3 0
cc-by-4.0 | cc by 4 0 | cc by 4 0 @cc ; creative commons @attribution 4 0(?: international)?(?: public)?(?: L)? | @creativecommons org licenses by 4 0
cc-by | cc by | creative commons @attribution L | @creativecommons org licenses by
cc-by-sa-2.0 | cc by sa 2 0 | cc by sa 2 0 @cc ; creative commons attribution share ?alike 2 0(?: L)? @attribution | @creativecommons org licenses by sa 2 0
cc-by-sa-2.5 | cc by sa 2 5 | cc by sa 2 5 @cc ; creative commons attribution share ?alike 2 5(?: L)? @attribution | @creativecommons org licenses by sa 2 5
cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0 @cc ; creative commons attribution share ?alike 3 0(?: unported)?(?: L)? @attribution | @creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0 @cc ; creative commons attribution share ?alike 4 0(?: international)?(?: L)? @attribution | @creativecommons org licenses by sa 4 0
cc-by-sa | cc by sa | cc by sa @cc ; creative commons attribution share ?alike(?: L)? @attribution | @creativecommons org licenses by sa
cc-by-nd-3.0 | cc by nd 3 0 | cc by nd 3 0 @cc ; creative commons attribution no ?deriv(?:ative)?s 3 0(?: L)? @attribution | @creativecommons org licenses by nd 3 0
cc-by-nd-4.0 | cc by nd 4 0 | cc by nd 4 0 @cc ; creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: L)? @attribution | @creativecommons org licenses by nd 4 0
cc-by-nd | cc by nd | cc by nd @cc ; creative commons attribution no ?deriv(?:ative)?s(?: L)? @attribution | @creativecommons org licenses by nd
cc-by-nc-2.0 | cc by nc 2 0 | cc by nc 2 0 @cc ; creative commons attribution non ?commercial 2 0(?: L)? @attribution | @creativecommons org licenses by nc 2 0
cc-by-nc-3.0 | cc by nc 3 0 | cc by nc 3 0 @cc ; creative commons attribution non ?commercial 3 0(?: unported)?(?: L)? @attribution | @creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0 @cc ; creative commons attribution non ?commercial 4 0(?: international)?(?: L)? @attribution | @creativecommons org licenses by nc 4 0
cc-by-nc | cc by nc | creative commons attribution non ?commercial(?: L)? @attribution | @creativecommons org licenses by nc
cc-by-nc-sa-3.0 | cc by nc sa 3 0 | cc by nc sa 3 0 @cc ; creative commons attribution non ?commercial share ?alike 3 0(?: L)? @attribution | @creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0 @cc ; creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: L)? @attribution | @creativecommons org licenses by nc sa 4 0
cc-by-nc-sa | cc by nc sa | cc by nc sa @cc ; creative commons attribution non ?commercial share ?alike(?: L)? @attribution | @creativecommons org licenses by nc sa
cc-by-nc-nd-3.0 | cc by nc nd 3 0 | cc by nc nd 3 0 @cc ; creative commons attribution non ?commercial no ?deriv(?:ative)?s 3 0(?: L)? @attribution | @creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0 @cc ; creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: L)? @attribution | @creativecommons org licenses by nc nd 4 0
cc-by-nc-nd | cc by nc nd | cc by nc nd @cc ; creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: L)? @attribution | @creativecommons org licenses by nc nd
odbl-1.0 | odbl 1 0 | open database L(?: v| version)?(?: 1 0)? @database ; @odbl(?: 1 0)? | @opendatacommons org licenses odbl
odc-by-1.0 | odc by 1 0 | open data commons attribution L @commons ; odc by @odc | @opendatacommons org licenses by
pddl-1.0 | pddl 1 0 | public domain dedication and L @dedication ; @pddl(?: 1 0)? | @opendatacommons org licenses pddl
cdla-permissive | cdla permissive (?:1|2) 0 | community data L agreement permissive(?: version)?(?: (?:1|2) 0)? @agreement | @cdla dev permissive 2 0 ; @cdla io permissive 1 0
cdla-sharing | cdla sharing 1 0 | community data L agreement sharing(?: version)?(?: 1 0)? @agreement | @cdla io sharing 1 0
ogl-uk | ogl uk (?:1|2|3) 0 | open government L(?: v| version)? ?[123]?(?: 0)? @government | @nationalarchives gov uk doc open government licence
ofl-1.1 | ofl 1 1(?: rfn| no rfn)? | sil open font L(?: version)?(?: 1 1)? @font ; @ofl(?: version)? 1 1 | @scripts sil org ofl ; @openfontlicense org
psf-2.0 | psf 2 0 | python software foundation L(?: version)?(?: 2)? @python ; @psf L(?: version)?(?: 2)? | @docs python org license ; @python org psf license
ruby | ruby | @ruby L ; same terms as @ruby(?: itself)? | @ruby lang org license
php-3.0 | php 3 0 | @php L(?: v| version)? 3 0 | @php net license 3 0
php-3.01 | php 3 01 | @php L(?: v| version)? 3 01 | @php net license 3 01
postgresql | postgresql | @postgresql L | @opensource org licenses postgresql ; @postgresql org about licence
openssl | openssl | @openssl L ; @openssl and ssleay L | @openssl org source license
curl | curl | @curl L | @curl se docs copyright
icu | icu | @icu L | @source icu project org repos icu icu trunk license
unicode | unicode (?:dfs 2016|3 0) | @unicode L(?: agreement| v3)? | @unicode org copyright ; @unicode org license
w3c | w3c | @w3c (?:software )?(?:notice and )?L | @w3 org consortium legal copyright software
ncsa | ncsa | university of illinois (?:ncsa )?open source L @illinois ; @ncsa (?:open source )?L | @opensource org licenses ncsa
afl-3.0 | afl 3 0 | academic free L(?: v| version)? 3 0 @academic ; @afl 3 0 | @opensource org licenses afl 3 0
osl-3.0 | osl 3 0 | open software L(?: v| version)? 3 0 @software ; @osl 3 0 | @opensource org licenses osl 3 0
ecl-2.0 | ecl 2 0 | educational community L(?: version)?(?: 2 0)? @educational | @opensource org licenses ecl 2 0
upl-1.0 | upl 1 0 | universal permissive L(?: v| version)?(?: 1 0)? @permissive | @oss oracle com licenses upl
ms-pl | ms pl | @microsoft public L ; @ms pl | @opensource org licenses ms pl
ms-rl | ms rl | @microsoft reciprocal L ; @ms rl | @opensource org licenses ms rl
mulan-psl-2 | mulanpsl 2 0 | @mulan (?:psl|permissive software L)(?: v| version)? ?2? | @license coscl org cn mulanpsl2
sspl-1.0 | sspl 1 0 | server side public L(?: v| version)? ?1? @server ; @sspl | @mongodb com licensing server side public license
elastic-2.0 | elastic 2 0 | @elastic L(?: v| version)?(?: 2(?: 0)?)? | @elastic co licensing elastic license
prosperity-3.0 | - | @prosperity public L(?: 3 0 0)? | @prosperitylicense com
polyform-nc | polyform noncommercial 1 0 0 | @polyform noncommercial L(?: 1 0 0)? | @polyformproject org licenses noncommercial
beerware | beerware | @beerware L ; beer ware L @beer | @people freebsd org phk
vim | vim | @vim L | @vimhelp org uganda
json | json | the @json L ; used for good not @evil | @json org license
lppl-1.3c | lppl 1 3c | latex project public L(?: version)?(?: 1 3c?)? @latex ; @lppl(?: 1 3c)? | @latex project org lppl
openrail | - | creativeml open rail m @rail ; @openrail(?: m)?(?: L)? ; bigscience @rail L | @bigscience huggingface co blog bigscience rail license
llama | - | @llama (?:2|3|3 1|3 2|3 3) community L(?: agreement)? | ai @meta com llama license
proprietary | - | all rights @reserved ; @proprietary and confidential ; unauthorized copying of this (?:file|work|text) (?:via any medium )?is strictly @prohibited | -
"""
#: Sentences of license texts: label | sentence.
SENTENCES = """
mit | permission is hereby granted free of charge to any person @obtaining a copy of this software
mit | the above copyright notice and this permission notice shall be included in all copies or substantial @portions of the software
mit-0 | permission is hereby granted free of charge to any person obtaining a copy of this software (?:[a-z]+ ){0,40}without @restriction
bsd | redistribution and use in source and binary forms with or without modification are @permitted
bsd | redistributions of source code must @retain the above copyright notice
bsd | redistributions in binary form must @reproduce the above copyright notice
bsd-3-clause | neither the name of (?:[a-z0-9]+ ){1,12}nor the names of its contributors may be used to endorse or @promote products
bsd-4-clause | all @advertising materials mentioning features or use of this software must display
apache-2 | unless required by applicable law or agreed to in writing software distributed under the @apache license
apache-2 | you may not use this file except in @compliance with the license
gpl | this program is free software you can @redistribute it and or modify it under the terms of the gnu general public L
gpl | you should have received a copy of the gnu @general public L
lgpl | this library is free software you can @redistribute it and or modify it under the terms of the gnu lesser general public L
lgpl | you should have received a copy of the gnu @lesser general public L
agpl | you should have received a copy of the gnu @affero general public L
mpl-2.0 | this source code form is subject to the terms of the @mozilla public license v(?:ersion )? ?2 0
isc | permission to use copy modify and or @distribute this software for any purpose with or without fee is hereby granted
zlib | this software is provided as is without any express or @implied warranty in no event will the authors be held liable
zlib | altered source versions must be plainly marked as such and must not be @misrepresented
unlicense | this is free and @unencumbered software released into the public domain
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying @documentation covered by this license
wtfpl | everyone is permitted to copy and distribute @verbatim or modified copies of this license document
cc0-1.0 | to the extent possible under law (?:[a-z0-9]+ ){1,12}has @waived all copyright
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free @documentation L
ofl-1.1 | this font software is L under the sil open @font L
cc-by | you must give appropriate @credit provide a link to the license and indicate if changes were made
cc-by-sa | if you @remix transform or build upon the material you must distribute your contributions under the same license
cc-by-nc | you may not use the material for @commercial purposes
cc-by-nd | if you remix transform or build upon the material you may not @distribute the modified material
beerware | as long as you @retain this notice you can do whatever you want with this stuff
ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:[a-z]+ ){0,6}deal with the software without @restriction
openssl | this product includes software developed by the @openssl project
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written @agreement is hereby granted
json | the software shall be used for good not @evil
proprietary | no part of this (?:publication|work|document) may be reproduced @stored in a retrieval system or transmitted
"""
_GIVEN = "(?:licen[cs]ed|released|distributed|redistributed|available|provided|published|shared|offered|covered|governed)(?: to you)? (?:under|by|with)(?: the)?(?: terms(?: and conditions)? of(?: the)?)? "


@dataclass(frozen=True)
class Rule:
    at: int
    label: str
    priority: int
    weight: float
    keyword: str
    pattern: str


def _compiled(words: str) -> str:
    """A pattern over single-spaced words as one over normal text, where every word stands between two spaces of its own."""
    gaps = re.sub(r" (?!\?)", "  ", re.sub(r"\bL\b", "licen[cs]e", words)).replace(" ?", "(?:  )?")
    return f" ({gaps}) "


def _marked(form: str) -> tuple[str, str]:
    """(keyword, pattern) of a form; a keyword that only repeats a word of the form stands at its end."""
    keyword = re.search("@([a-z0-9]+)", form).group(1)
    pattern = form.replace("@", "").strip()
    repeated = re.fullmatch(r"(.*) @" + keyword, form.strip())
    if repeated and re.search(rf"\b{keyword}\b", repeated.group(1)):
        pattern = repeated.group(1)
    return keyword, pattern


def _rules() -> tuple[Rule, ...]:
    found = [(label, BASE, *_marked(phrase)) for phrase, label in BASE_PHRASES.items()]
    for line in FAMILIES.strip().splitlines():
        label, identifiers, names, addresses = line.split(" | ")
        if identifiers != "-":
            found.append((label, IDENTIFIER, "spdx", f"spdx L identifier {identifiers}"))
        for keyword, pattern in map(_marked, names.split(" ; ")):
            found += [(label, GRANT, keyword, _GIVEN + f"(?:{pattern})"), (label, NAME, keyword, pattern)]
        if addresses != "-":
            found += [(label, GRANT, *_marked(address)) for address in addresses.split(" ; ")]
    for line in SENTENCES.strip().splitlines():
        label, sentence = line.split(" | ")
        found.append((label, GRANT, *_marked(sentence)))
    return tuple(Rule(at, label, priority, WEIGHTS[priority], keyword, _compiled(pattern)) for at, (label, priority, keyword, pattern) in enumerate(found))


RULES = _rules()
_SPAN_DDL = "array<struct<first:int,back:int,low:int,at:int,label:string,priority:int,weight:double>>"


def normal_text(text: Column) -> Column:
    """Words in lower case, each between two spaces of its own; empty without words. A text of ASCII alone takes the faster ``lower``."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    words = F.trim(F.regexp_replace(F.coalesce(lowered, F.lit("")), _GAP, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _matches(normal: Column, tried: Column) -> Column:
    """Detections of all tried rules: the matches of a rule are marked in one pass, and where there are any, the marked words are numbered. They sort by
    start, longest first, highest priority first, rule order."""
    marked = F.transform(tried, lambda rule: F.struct(
        rule.alias("rule"), F.regexp_replace(normal, rule["pattern"], F.lit(f" {_OPEN}$1{_CLOSE} ")).alias("text")
    ))
    numbers = lambda words, mark: F.filter(F.transform(words, lambda w, i: F.when(F.contains(w, F.lit(mark)), i)), lambda i: i.isNotNull())

    def spans(match: Column) -> Column:
        rule, words = match["rule"], F.split(match["text"], "  ")
        return F.transform(F.arrays_zip(numbers(words, _OPEN).alias("first"), numbers(words, _CLOSE).alias("last")), lambda s: F.struct(
            s["first"].alias("first"), (-s["last"]).alias("back"), (-rule["priority"]).alias("low"), rule["at"].alias("at"), rule["label"].alias("label"),
            rule["priority"].alias("priority"), rule["weight"].alias("weight"),
        ))

    return F.flatten(F.transform(F.filter(marked, lambda m: F.contains(m["text"], F.lit(_OPEN))), spans))


def _unsuppressed(spans: Column) -> Column:
    """Detections that no other one suppresses. ``ends`` holds the furthest last word among those seen of each priority or a higher one."""
    none = F.array().cast(_SPAN_DDL)
    start = F.struct(F.array(*[F.lit(-1)] * (BASE + 1)).alias("ends"), none.alias("open"), F.array().cast(f"array<{_SPAN_DDL}>").alias("done"))

    def step(state: Column, span: Column) -> Column:
        last = -span["back"]
        base = span["priority"] == BASE
        stays = base | (F.get(state["ends"], span["priority"]) < last)
        grown = F.when(stays, F.concat(state["open"], F.array(span))).otherwise(state["open"])
        full = F.size(state["open"]) >= BLOCK
        return F.struct(
            F.transform(state["ends"], lambda end, p: F.when(p <= span["priority"], F.greatest(end, last)).otherwise(end)).alias("ends"),
            F.when(full, F.when(stays, F.array(span)).otherwise(none)).otherwise(grown).alias("open"),
            F.when(full, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"),
        )

    return F.aggregate(spans, start, step, lambda state: F.flatten(F.concat(state["done"], F.array(state["open"]))))


def detections(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, n_words, spans: the detections that stay, each with its first and last word, rule number (``at``), label, priority and weight."""
    # As SQL text both are constants that the optimizer folds once; words and patterns hold no quote and no backslash.
    keywords = F.expr("array(" + ", ".join(f"'{word}'" for word in sorted({rule.keyword for rule in rules})) + ")")
    table = F.expr("array(" + ", ".join(
        f"named_struct('at', {r.at}, 'label', '{r.label}', 'priority', {r.priority}, 'weight', {r.weight}D, 'keyword', '{r.keyword}', 'pattern', '{r.pattern}')" for r in rules
    ) + ")")
    normal = df.select(F.col(id_col).alias("_id"), normal_text(F.col(text_col)).alias("_normal"))
    worded = normal.select("_id", "_normal", F.split(F.trim("_normal"), "  ").alias("_words"))
    found = worded.select(
        "_id", F.when(F.col("_normal") == "", F.lit(0)).otherwise(F.size("_words")).cast("long").alias("n_words"), "_normal",
        F.array_intersect("_words", keywords).alias("_found"),
    )
    tried = F.filter(table, lambda rule: F.array_contains(F.col("_found"), rule["keyword"]))
    spans = F.when(F.size("_found") > 0, F.sort_array(_matches(F.col("_normal"), tried)))
    raw = found.select("_id", "n_words", spans.alias("_spans"))
    kept = F.when(F.size("_spans") > 0, _unsuppressed(F.col("_spans")))
    return raw.select(F.col("_id").alias(id_col), "n_words", F.coalesce(F.transform(kept, lambda s: F.struct(
        s["first"].cast("long").alias("first"), (-s["back"]).cast("long").alias("last"), s["at"].alias("at"), s["label"].alias("label"),
        s["priority"].alias("priority"), s["weight"].alias("weight"),
    )), F.array()).alias("spans"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row a document: words, places of base phrases with the first and last of their starts, base and all labels, and the highest weight."""
    base = F.filter("spans", lambda s: s["priority"] == BASE)
    labels = lambda spans: F.concat_ws(",", F.sort_array(F.array_distinct(F.transform(spans, lambda s: s["label"]))))
    starts = F.transform(F.col("_base"), lambda s: s["first"])
    based = detections(df, id_col, text_col, rules).select(F.col(id_col), "n_words", "spans", base.alias("_base"))
    return based.select(
        F.col(id_col), "n_words", F.size("_base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("_base")).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["weight"])), F.lit(0.0)).alias("score"), F.size("spans").cast("long").alias("n_spans"),
    )
