"""Signature rules for licences, in order.

A rule is ``label | priority | keyword | pattern``. Texts are words in lower case with one
space between them, so punctuation never matters: "Apache-2.0" reads ``apache 2 0``. A pattern
must match whole words and is tried only on texts that hold its keyword, so every text that it
matches must hold the keyword at the start of a word. Priority 3 is the
wording of a grant or notice, 2 a licence with its version or identifier, 1 a bare name.
"""

RULES_TEXT = r"""
gpl|1|gnu general public license|gnu general public license
apache|1|apache license|apache license
cc-by|1|cc by|cc by
mit|1|mit license|mit license
gpl|1|gnu gpl|gnu gpl(?: license)?
gpl|1|gpl licen|(?:the )?gpl licen[sc]ed?
gpl|1|under the gpl|under the gpl
gpl|1|gnu public licen|gnu public licen[sc]e
gpl-1.0|2|gnu general public licen|gnu general public licen[sc]e (?:v|version )?1(?: 0)?
gpl-2.0|2|gnu general public licen|gnu general public licen[sc]e (?:gpl )?(?:as published by the free software foundation )?(?:v ?|version )?2(?: 0)?
gpl-2.0|2|gplv2|(?:gnu )?gplv2
gpl-2.0|2|gpl 2|(?:gnu )?gpl 2(?: 0)?(?: only)?
gpl-2.0|2|gpl v|(?:gnu )?gpl (?:v|version )2(?: 0)?
gpl-2.0-or-later|2|gplv2|(?:gnu )?gplv2 or (?:later|any later version)
gpl-2.0-or-later|2|gpl 2|(?:gnu )?gpl 2(?: 0)? or later
gpl-2.0-or-later|3|either version 2|gnu general public licen[sc]e as published by the free software foundation either version 2(?: 0)? of the licen[sc]e or (?:at your option )?any later version
gpl-3.0|2|gnu general public licen|gnu general public licen[sc]e (?:gpl )?(?:v ?|version )?3(?: 0)?
gpl-3.0|2|gplv3|(?:gnu )?gplv3
gpl-3.0|2|gpl 3|(?:gnu )?gpl 3(?: 0)?(?: only)?
gpl-3.0|2|gpl v|(?:gnu )?gpl (?:v|version )3(?: 0)?
gpl-3.0-or-later|2|gplv3|(?:gnu )?gplv3 or (?:later|any later version)
gpl-3.0-or-later|2|gpl 3|(?:gnu )?gpl 3(?: 0)? or later
gpl-3.0-or-later|3|either version 3|gnu general public licen[sc]e as published by the free software foundation either version 3(?: 0)? of the licen[sc]e or (?:at your option )?any later version
gpl|3|redistribute it and or modify|you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e
gpl|3|distributed in the hope|this program is distributed in the hope that it will be useful but without any warranty
gpl|2|gnu org licenses gpl|gnu org licenses gpl(?: [23] 0)?(?: html| txt)?
gpl-2.0|3|this is free software|gpl version 2 this is free software
gpl-classpath|2|classpath exception|(?:with )?(?:the )?(?:gnu )?classpath exception(?: 2 0)?
gpl-gcc-exception|2|gcc runtime library exception|gcc runtime library exception(?: version)?(?: 3 1)?
gpl-linking|2|linking exception|(?:with )?linking exception
lgpl|1|lesser general public|(?:gnu )?lesser general public licen[sc]e
lgpl|1|library general public|(?:gnu )?library general public licen[sc]e
lgpl|1|lgpl|(?:gnu )?lgpl
lgpl-2.0|2|library general public|(?:gnu )?library general public licen[sc]e (?:v|version )?2(?: 0)?
lgpl-2.0|2|lgpl 2 0|(?:gnu )?lgpl 2 0
lgpl-2.1|2|lesser general public|(?:gnu )?lesser general public licen[sc]e (?:v ?|version )?2 1
lgpl-2.1|2|lgpl|(?:gnu )?lgplv?(?: v| version)? ?2 1(?: only)?
lgpl-2.1-or-later|2|lgpl|(?:gnu )?lgplv?(?: v| version)? ?2 1 or later
lgpl-2.1-or-later|3|lesser general public|lesser general public licen[sc]e as published by the free software foundation either version 2 1 of the licen[sc]e or (?:at your option )?any later version
lgpl-3.0|2|lesser general public|(?:gnu )?lesser general public licen[sc]e (?:v ?|version )?3(?: 0)?
lgpl-3.0|2|lgpl|(?:gnu )?lgplv?(?: v| version)? ?3(?: 0)?(?: only)?
lgpl-3.0-or-later|2|lgpl|(?:gnu )?lgplv?(?: v| version)? ?3(?: 0)? or later
lgpl|2|gnu org licenses lgpl|gnu org licenses lgpl(?: [23] [01])?(?: html| txt)?
agpl|1|affero general public|(?:gnu )?affero general public licen[sc]e
agpl|1|agpl|(?:gnu )?agpl
agpl-1.0|2|affero general public|affero general public licen[sc]e (?:v|version )?1(?: 0)?
agpl-3.0|2|affero general public|(?:gnu )?affero general public licen[sc]e (?:v ?|version )?3(?: 0)?
agpl-3.0|2|agpl|(?:gnu )?agplv?(?: v| version)? ?3(?: 0)?(?: only)?
agpl-3.0-or-later|2|agpl|(?:gnu )?agplv?(?: v| version)? ?3(?: 0)? or later
agpl-3.0-or-later|3|affero general public|affero general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or (?:at your option )?any later version
agpl|2|gnu org licenses agpl|gnu org licenses agpl(?: 3 0)?(?: html| txt)?
gfdl|1|free documentation licen|(?:gnu )?free documentation licen[sc]e
gfdl-1.1|2|free documentation licen|(?:gnu )?free documentation licen[sc]e (?:v|version )?1 1
gfdl-1.2|2|free documentation licen|(?:gnu )?free documentation licen[sc]e (?:v|version )?1 2
gfdl-1.3|2|free documentation licen|(?:gnu )?free documentation licen[sc]e (?:v|version )?1 3
gfdl|2|gfdl|(?:gnu )?gfdl(?: 1 [123])?
gfdl|3|invariant sections|with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
apache-1.0|2|apache|apache(?: software)? licen[sc]e (?:v|version )?1 0
apache-1.1|2|apache|apache(?: software)? licen[sc]e (?:v|version )?1 1
apache-2.0|2|apache|apache(?: software)? licen[sc]e (?:v ?|version )?2(?: 0)?
apache-2.0|2|apache 2 0|apache 2 0(?: licen[sc]ed?)?
apache-2.0|2|apache2|apache2(?: licen[sc]e)?
apache-2.0|2|apache org licenses|(?:www )?apache org licenses license 2 0(?: html| txt)?
apache-2.0|3|apache license|licensed under the apache license version 2 0(?: the license)?
apache-2.0|3|you may not use this file|you may not use this file except in compliance with the license
apache-2.0|3|limitations under the license|see the license for the specific language governing permissions and limitations under the license
apache|1|apache software licen|apache software licen[sc]e
apache|2|asf under one or more|licensed to the apache software foundation asf under one or more contributor license agreements
llvm-exception|2|llvm exception|(?:with )?llvm exceptions?
mit|2|spdx license identifier mit|spdx license identifier mit
mit|2|expat licen|(?:mit )?expat licen[sc]e
mit|2|opensource org licenses mit|opensource org licenses mit(?: license)?(?: php| html)?
mit|3|permission is hereby granted free of charge|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit|3|the software is provided as is without warranty|the software is provided as is without warranty of any kind express or implied
mit|3|mit licen|(?:released|licensed|distributed|available|published) under the (?:terms of the )?mit licen[sc]e
mit|1|mit licence|mit licence
mit|1|mit licensed|mit licensed
mit-0|2|mit 0|mit 0(?: licen[sc]e)?
mit-0|2|mit no attribution|mit no attribution(?: licen[sc]e)?
x11|2|x11 licen|(?:mit )?x11 licen[sc]e
x11|2|x consortium|x consortium licen[sc]e
isc|1|isc licen|isc licen[sc]e
isc|2|spdx license identifier isc|spdx license identifier isc
isc|3|permission to use copy modify and or distribute|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd|2|0bsd|0bsd(?: licen[sc]e)?
0bsd|2|zero clause bsd|zero clause bsd(?: licen[sc]e)?
bsd|1|bsd licen|bsd licen[sc]ed?
bsd|1|bsd style|bsd style licen[sc]e
bsd-1-clause|2|bsd 1 clause|bsd 1 clause(?: licen[sc]e)?
bsd-2-clause|2|bsd 2 clause|bsd 2 clause(?: licen[sc]e)?
bsd-2-clause|2|2 clause bsd|2 clause bsd(?: licen[sc]e)?
bsd-2-clause|2|simplified bsd|simplified bsd licen[sc]e
bsd-2-clause|2|freebsd licen|freebsd licen[sc]e
bsd-3-clause|2|bsd 3 clause|bsd 3 clause(?: licen[sc]e)?
bsd-3-clause|2|3 clause bsd|3 clause bsd(?: licen[sc]e)?
bsd-3-clause|2|new bsd|new bsd licen[sc]e
bsd-3-clause|2|modified bsd|modified bsd licen[sc]e
bsd-3-clause|2|revised bsd|revised bsd licen[sc]e
bsd-3-clause-clear|2|bsd 3 clause clear|bsd 3 clause clear(?: licen[sc]e)?
bsd-4-clause|2|bsd 4 clause|bsd 4 clause(?: licen[sc]e)?
bsd-4-clause|2|original bsd|original bsd licen[sc]e
bsd|3|redistribution and use in source and binary|redistribution and use in source and binary forms with or without modification are permitted
bsd|3|redistributions of source code must retain|redistributions of source code must retain the above copyright notice
bsd|3|redistributions in binary form must reproduce|redistributions in binary form must reproduce the above copyright notice
bsd-3-clause|3|endorse or promote products|may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause|3|all advertising materials|all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd|2|opensource org licenses bsd|opensource org licenses bsd(?: license)?(?: php| html)?
mpl|1|mozilla public licen|mozilla public licen[sc]e
mpl-1.0|2|mozilla public licen|mozilla public licen[sc]e (?:v|version )?1 0
mpl-1.1|2|mozilla public licen|mozilla public licen[sc]e (?:v|version )?1 1
mpl-2.0|2|mozilla public licen|mozilla public licen[sc]e (?:v ?|version )?2(?: 0)?
mpl-1.1|2|mpl 1 1|mpl 1 1
mpl-2.0|2|mpl 2 0|mpl 2 0
mpl-2.0|2|mplv2|mplv2(?: 0)?
mpl-2.0|3|this source code form is subject|this source code form is subject to the terms of the mozilla public license v 2 0
mpl|2|mozilla org mpl|(?:www )?mozilla org mpl(?: 2 0)?
epl|1|eclipse public licen|eclipse public licen[sc]e
epl-1.0|2|eclipse public licen|eclipse public licen[sc]e (?:v ?|version )?1(?: 0)?
epl-2.0|2|eclipse public licen|eclipse public licen[sc]e (?:v ?|version )?2(?: 0)?
epl-1.0|2|epl 1 0|epl 1 0
epl-2.0|2|epl 2 0|epl 2 0
epl|2|eclipse org legal epl|eclipse org legal epl(?: v10| 2 0| v20)?(?: html)?
edl-1.0|2|eclipse distribution licen|eclipse distribution licen[sc]e(?: v| version)?(?: 1 0)?
cddl|1|common development and distribution|common development and distribution licen[sc]e
cddl-1.0|2|cddl 1 0|cddl 1 0
cddl-1.0|2|common development and distribution|common development and distribution licen[sc]e(?: cddl)? (?:v|version )?1 0
cddl-1.1|2|cddl 1 1|cddl 1 1
cpl-1.0|2|common public licen|common public licen[sc]e(?: v| version)?(?: 1 0)?
cpal-1.0|2|common public attribution|common public attribution licen[sc]e(?: version)?(?: 1 0)?
ipl-1.0|2|ibm public licen|ibm public licen[sc]e(?: version)?(?: 1 0)?
spl-1.0|2|sun public licen|sun public licen[sc]e(?: version)?(?: 1 0)?
apsl|1|apple public source|apple public source licen[sc]e
apsl-2.0|2|apple public source|apple public source licen[sc]e (?:v|version )?2 0
aspl|2|artistic license perl|artistic license perl
artistic|1|artistic licen|(?:the )?(?:perl )?artistic licen[sc]e
artistic-1.0|2|artistic|artistic(?: licen[sc]e)? (?:v|version )?1 0(?: perl)?
artistic-2.0|2|artistic|artistic(?: licen[sc]e)? (?:v|version )?2 0
perl|2|same terms as perl|under the same terms as perl(?: itself)?
python|1|python software foundation licen|python software foundation licen[sc]e
python-2.0|2|psf|psf(?: licen[sc]e)? (?:version )?2(?: 0)?
python-2.0|2|python software foundation licen|python software foundation licen[sc]e (?:v|version )?2(?: 0)?
cnri-python|2|cnri|cnri (?:open source )?licen[sc]e agreement
ruby|2|ruby licen|ruby licen[sc]e
php-3.0|2|php licen|php licen[sc]e (?:v|version )?3 0
php-3.01|2|php licen|php licen[sc]e (?:v|version )?3 01
php|1|php licen|(?:the )?php licen[sc]e
zend-2.0|2|zend engine licen|zend engine licen[sc]e(?: version)?(?: 2 0)?
w3c|2|w3c software|w3c software (?:notice and )?(?:and document )?(?:notice )?(?:and )?licen[sc]e
w3c|1|w3c licen|w3c licen[sc]e
zlib|2|zlib|(?:the )?zlib(?: libpng)? licen[sc]e
zlib|2|libpng licen|(?:zlib )?libpng licen[sc]e
zlib|3|this software is provided as is without any express|this software is provided as is without any express or implied warranty in no event will the authors be held liable
libpng-2.0|2|png reference library licen|png reference library licen[sc]e(?: version 2)?
bsl-1.0|2|boost software licen|boost software licen[sc]e (?:v|version )?1 0
bsl-1.0|1|boost software licen|boost software licen[sc]e
bsl-1.0|2|bsl 1 0|bsl 1 0
bsl-1.0|2|boost org license|(?:www )?boost org license 1 0(?: txt)?
busl-1.1|2|business source licen|business source licen[sc]e(?: version)?(?: 1 1)?
busl-1.1|2|busl 1 1|busl 1 1
sspl-1.0|2|server side public licen|server side public licen[sc]e(?: v| version)?(?: 1)?
sspl-1.0|2|sspl|sspl(?: 1 0| v1)?
elastic-2.0|2|elastic licen|elastic licen[sc]e (?:v|version )?2(?: 0)?
elastic|1|elastic licen|elastic licen[sc]e
commons-clause|2|commons clause|commons clause(?: licen[sc]e)?(?: condition)?(?: v1 0)?
polyform|2|polyform|polyform (?:noncommercial|small business|shield|strict|perimeter|internal use|free trial)(?: licen[sc]e)?(?: 1 0 [01])?
confluent|2|confluent community licen|confluent community licen[sc]e(?: agreement)?(?: version 1 0)?
timescale|2|timescale licen|timescale licen[sc]e
unlicense|2|unlicense|(?:the )?unlicense
unlicense|3|free and unencumbered software|this is free and unencumbered software released into the public domain
unlicense|2|unlicense org|(?:please refer to )?(?:http |https )?unlicense org
wtfpl|2|wtfpl|wtfpl
wtfpl|2|do what the|do what the fuck you want to public licen[sc]e
beerware|2|beerware|beerware(?: licen[sc]e)?
beerware|2|beer ware|(?:the )?beer ware licen[sc]e
postgresql|2|postgresql licen|postgresql licen[sc]e
openssl|2|openssl licen|openssl licen[sc]e
ssleay|2|ssleay licen|(?:original )?ssleay licen[sc]e
curl|2|curl licen|(?:the )?curl licen[sc]e
ncsa|2|ncsa|(?:university of illinois )?ncsa open source licen[sc]e
ncsa|2|university of illinois|university of illinois open source licen[sc]e
afl|1|academic free licen|academic free licen[sc]e
afl-2.1|2|academic free licen|academic free licen[sc]e (?:v|version )?2 1
afl-3.0|2|academic free licen|academic free licen[sc]e (?:v|version )?3 0
osl|1|open software licen|open software licen[sc]e
osl-3.0|2|open software licen|open software licen[sc]e (?:v|version )?3 0
eupl|1|european union public licen|european union public licen[sc]e
eupl-1.1|2|eupl|eupl(?: v| version)? ?1 1
eupl-1.2|2|eupl|eupl(?: v| version)? ?1 2
eupl-1.2|2|european union public licen|european union public licen[sc]e (?:v|version )?1 2
cecill|1|cecill|cecill
cecill-2.1|2|cecill 2 1|cecill 2 1
cecill-b|2|cecill b|cecill b(?: licen[sc]e)?
cecill-c|2|cecill c|cecill c(?: licen[sc]e)?
ms-pl|2|microsoft public licen|microsoft public licen[sc]e(?: ms pl)?
ms-rl|2|microsoft reciprocal licen|microsoft reciprocal licen[sc]e(?: ms rl)?
mulan-psl-2.0|2|mulan|mulan (?:psl|permissive software licen[sc]e)(?: v2| version 2)?
upl-1.0|2|universal permissive licen|universal permissive licen[sc]e(?: v| version)?(?: 1 0)?
vim|2|vim licen|vim licen[sc]e
lppl|1|latex project public|latex project public licen[sc]e
lppl-1.3c|2|lppl|lppl(?: version)? 1 3c?
ofl-1.1|2|open font licen|(?:sil )?open font licen[sc]e (?:v|version )?1 1
ofl|1|open font licen|(?:sil )?open font licen[sc]e
ofl|2|scripts sil org ofl|scripts sil org ofl
qpl-1.0|2|q public licen|q public licen[sc]e(?: version)?(?: 1 0)?
rpl-1.5|2|reciprocal public licen|reciprocal public licen[sc]e(?: version)?(?: 1 5)?
sleepycat|2|sleepycat|sleepycat licen[sc]e
tcl|2|tcl tk licen|tcl tk licen[sc]e
nasa-1.3|2|nasa open source|nasa open source agreement(?: version)?(?: 1 3)?
json|3|for good not evil|the software shall be used for good not evil
odbl-1.0|2|open database licen|open database licen[sc]e(?: odbl)?(?: v1 0| 1 0)?
odbl-1.0|2|odbl|odbl(?: 1 0| v1 0)?
odc-by-1.0|2|open data commons attribution|open data commons attribution licen[sc]e(?: v1 0)?
pddl-1.0|2|public domain dedication and licen|public domain dedication and licen[sc]e(?: pddl)?
ogl-uk|2|open government licen|open government licen[sc]e(?: v[123](?: 0)?)?
etalab-2.0|2|licence ouverte|licence ouverte(?: v2 0| 2 0)?
cdla-permissive|2|cdla permissive|cdla permissive(?: [12] 0)?
cdla-sharing|2|cdla sharing|cdla sharing(?: 1 0)?
cc0-1.0|2|cc0|cc0(?: 1 0)?(?: universal)?
cc0-1.0|2|creativecommons org publicdomain|creativecommons org publicdomain zero 1 0
cc0-1.0|2|creative commons zero|creative commons zero(?: v1 0 universal)?
cc-pdm|2|public domain mark|(?:creative commons )?public domain mark(?: 1 0)?
cc-by-1.0|2|cc by 1|cc by 1 0
cc-by-2.0|2|cc by 2|cc by 2 0
cc-by-2.5|2|cc by 2|cc by 2 5
cc-by-3.0|2|cc by 3|cc by 3 0
cc-by-4.0|2|cc by 4|cc by 4 0
cc-by-sa|2|cc by sa|cc by sa
cc-by-sa-2.5|2|cc by sa 2|cc by sa 2 5
cc-by-sa-3.0|2|cc by sa 3|cc by sa 3 0
cc-by-sa-4.0|2|cc by sa 4|cc by sa 4 0
cc-by-nc|2|cc by nc|cc by nc
cc-by-nc-3.0|2|cc by nc 3|cc by nc 3 0
cc-by-nc-4.0|2|cc by nc 4|cc by nc 4 0
cc-by-nc-sa|2|cc by nc sa|cc by nc sa
cc-by-nc-sa-3.0|2|cc by nc sa 3|cc by nc sa 3 0
cc-by-nc-sa-4.0|2|cc by nc sa 4|cc by nc sa 4 0
cc-by-nc-nd|2|cc by nc nd|cc by nc nd
cc-by-nc-nd-3.0|2|cc by nc nd 3|cc by nc nd 3 0
cc-by-nc-nd-4.0|2|cc by nc nd 4|cc by nc nd 4 0
cc-by-nd|2|cc by nd|cc by nd
cc-by-nd-3.0|2|cc by nd 3|cc by nd 3 0
cc-by-nd-4.0|2|cc by nd 4|cc by nd 4 0
cc-by|2|creativecommons org licenses by|creativecommons org licenses by(?: [1-4] [05])?
cc-by-sa|2|creativecommons org licenses by sa|creativecommons org licenses by sa(?: [1-4] [05])?
cc-by-nc|2|creativecommons org licenses by nc|creativecommons org licenses by nc(?: [1-4] [05])?
cc-by-nc-sa|2|creativecommons org licenses by nc sa|creativecommons org licenses by nc sa(?: [1-4] [05])?
cc-by-nc-nd|2|creativecommons org licenses by nc nd|creativecommons org licenses by nc nd(?: [1-4] [05])?
cc-by-nd|2|creativecommons org licenses by nd|creativecommons org licenses by nd(?: [1-4] [05])?
cc-by|2|creative commons attribution|creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-sa|2|creative commons attribution sharealike|creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc|2|creative commons attribution noncommercial|creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc-sa|2|creative commons attribution noncommercial|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc-nd|2|creative commons attribution noncommercial|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nd|2|creative commons attribution no|creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc|1|creative commons licen|creative commons licen[sc]e
public-domain|2|released into the public domain|released into the public domain
public-domain|2|in the public domain|(?:this work is |is |are )?(?:placed |dedicated )?in the public domain
public-domain|2|dedicated to the public domain|dedicated to the public domain
openrail|2|openrail|(?:bigscience |creativeml )?openrail(?: m| s| plus plus)?(?: licen[sc]e)?
llama|2|llama|llama [234](?: [123])? community licen[sc]e(?: agreement)?
gemma|2|gemma terms|gemma terms of use
bigcode|2|bigcode|bigcode openrail m(?: licen[sc]e)?
research-only|2|non commercial research|(?:for )?non commercial research (?:use|purposes)(?: only)?
proprietary|2|all rights reserved|all rights reserved
proprietary|3|unauthorized copying of this file|unauthorized copying of this file via any medium is strictly prohibited
proprietary|2|proprietary and confidential|proprietary and confidential
proprietary|2|end user licen|end user licen[sc]e agreement
copyleft|1|copyleft|copyleft
permissive|1|permissive|permissive(?: open source)? licen[sc]e
dual|2|dual licen|dual licen[sc]ed
"""


def parse(text: str = RULES_TEXT) -> list[tuple[int, str, int, str, str]]:
    """``(order, label, priority, gate, pattern)`` of each rule; patterns take whole words.

    The gate is the keyword, or the shortest other keyword that it begins with.
    """
    lines = [line.split("|", 3) for line in text.strip().splitlines()]
    gates = shortest({keyword for _, _, keyword, _ in lines})
    gate_of = lambda keyword: next(g for g in gates if keyword.startswith(g))
    return [
        (i, label, int(p), gate_of(keyword), f"(?<![^ ])(?:{pattern})(?![^ ])")
        for i, (label, p, keyword, pattern) in enumerate(lines)
    ]


def shortest(keywords: set[str]) -> list[str]:
    """The keywords that no other one is the beginning of."""
    out: list[str] = []
    for keyword in sorted(keywords):
        if not out or not keyword.startswith(out[-1]):
            out.append(keyword)
    return out


def prefilter(gates: list[str]) -> str:
    """A pattern whose group 1 is the gate at the start of a word, if one is there.

    Gates share their beginnings, as in a trie, so a word fails on its first letters. Nothing
    is consumed: gates that overlap are all found.
    """

    def branch(rest: list[str]) -> str:
        if rest == [""]:
            return ""
        heads = sorted({x[0] for x in rest})
        parts = [head + branch([x[1:] for x in rest if x[0] == head]) for head in heads]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return f"(?<![^ ])(?=({branch(sorted(gates))}))"
