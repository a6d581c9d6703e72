r"""Signature rules of licenses, in order.

A rule is a label, a priority, keywords and a regular expression. Expressions are
matched against a text's words, each in lower case between two blanks, so `` gnu  general ``
is two words in a row. They are written with one blank between words. A rule is only tried
on texts that hold one of its keywords, of which every match of it must contain one as a word.

Priorities: 3 for identifiers that say exactly which license, 2 for names with a version or a
clause, 1 for names alone and for typical sentences. Earlier rules win among equal ones.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str


# One rule per line: label | priority | keywords, parted by commas | expression over words.
_LINES = r"""
agpl-3.0|3|spdx|spdx license identifier agpl 3 0( only| or later)?
agpl-3.0|2|affero|gnu affero general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?
agpl-1.0|2|affero|affero general public license (version|v) 1( 0)?
agpl|1|affero|(gnu )?affero (general public )?license
agpl|1|agpl|(gnu )?agpl( v)?( [0-9])?
agpl-3.0|2|agplv3|(gnu )?agplv3
lgpl-2.0|3|spdx|spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1|3|spdx|spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0|3|spdx|spdx license identifier lgpl 3 0( only| or later)?
lgpl-2.0|2|library|gnu library general public license( as published by the free software foundation)?( either)? (version|v) 2( 0)?
lgpl-2.1|2|lesser|gnu lesser general public license( as published by the free software foundation)?( either)? (version|v) 2 1
lgpl-3.0|2|lesser|gnu lesser general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?
lgpl|1|lesser|(gnu )?lesser general public license
lgpl|1|library|gnu library general public license
lgpl|1|lgpl|(gnu )?lgpl( v)?( [0-9])?
lgpl-2.1|2|lgplv2|(gnu )?lgplv2( 1)?
lgpl-3.0|2|lgplv3|(gnu )?lgplv3
gpl-1.0|3|spdx|spdx license identifier gpl 1 0( only| or later)?
gpl-2.0|3|spdx|spdx license identifier gpl 2 0( only| or later)?
gpl-3.0|3|spdx|spdx license identifier gpl 3 0( only| or later)?
gpl-1.0|2|license|gnu general public license( as published by the free software foundation)?( either)? (version|v) 1( 0)?
gpl-2.0|2|license|gnu general public license( as published by the free software foundation)?( either)? (version|v) 2( 0)?
gpl-3.0|2|license|gnu general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?
gpl-2.0-or-later|2|license|gnu general public license( as published by the free software foundation)? either version 2 of the license or at your option any later version
gpl-3.0-or-later|2|license|gnu general public license( as published by the free software foundation)? either version 3 of the license or at your option any later version
gpl-2.0|3|gpl|www gnu org licenses (old licenses )?gpl 2 0
gpl-3.0|3|gpl|www gnu org licenses gpl 3 0
gpl-2.0|2|gplv2|(gnu )?gplv2
gpl-3.0|2|gplv3|(gnu )?gplv3
gpl-2.0|2|gpl|(gnu )?gpl (version |v )?2( 0)?
gpl-3.0|2|gpl|(gnu )?gpl (version |v )?3( 0)?
gpl|1|license|gnu general public license
gpl|1|gnu|gnu gpl
gpl-classpath-exception|2|classpath|(gpl|general public license)( version 2)? with (the )?classpath exception
gcc-exception|2|gcc|gcc runtime library exception
gfdl-1.1|2|documentation|gnu free documentation license version 1 1
gfdl-1.2|2|documentation|gnu free documentation license version 1 2
gfdl-1.3|2|documentation|gnu free documentation license version 1 3
gfdl|1|documentation|gnu free documentation license
gfdl|1|gfdl|gfdl( 1 [123])?
apache-1.0|3|spdx|spdx license identifier apache 1 0
apache-1.1|3|spdx|spdx license identifier apache 1 1
apache-2.0|3|spdx|spdx license identifier apache 2 0
apache-1.1|2|apache|apache (software )?license (version|v)? ?1 1
apache-2.0|2|apache|apache (software )?license( version| v)? 2( 0)?
apache-2.0|3|apache|www apache org licenses license 2 0
apache-2.0|2|asl|asl 2 0
apache-1.1|1|apache|apache software foundation all rights reserved
apache|1|apache|apache (software )?license
mit|3|spdx|spdx license identifier mit
mit-0|3|spdx|spdx license identifier mit 0
mit|3|opensource|opensource org licenses mit( license)?
mit|2|license|(released|licensed|distributed|available) under the (terms of the )?mit license
mit-0|2|attribution|mit no attribution( license)?
mit|1|license|(the )?mit license
mit|1|licensed|mit licensed
mit|2|hereby|permission is hereby granted free of charge to any person obtaining a copy of this software
mit|1|merchantability|the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
x11|1|license|(mit )?x11 license
x11|1|consortium|x consortium license
expat|1|expat|expat license
isc|3|spdx|spdx license identifier isc
isc|1|license|isc license
isc|2|modify|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-0|3|spdx|spdx license identifier 0bsd
bsd-0|2|clause|(zero|0) clause bsd( license)?
bsd-1|3|spdx|spdx license identifier bsd 1 clause
bsd-2|3|spdx|spdx license identifier bsd 2 clause( patent| views)?
bsd-3|3|spdx|spdx license identifier bsd 3 clause( clear| lbnl| attribution)?
bsd-4|3|spdx|spdx license identifier bsd 4 clause( uc)?
bsd-2|2|bsd|(bsd (2|two) clause|(2|two) clause bsd)( license)?
bsd-3|2|bsd|(bsd (3|three) clause|(3|three) clause bsd)( license)?
bsd-4|2|bsd|(bsd (4|four) clause|(4|four) clause bsd)( license)?
bsd-2|2|simplified|simplified bsd license
bsd-2|2|license|freebsd license
bsd-3|2|license|(new|modified|revised) bsd license
bsd-4|2|license|(original|old) bsd license
bsd|1|license|bsd (style )?license
bsd|1|redistribution|redistribution and use in source and binary forms with or without modification are permitted
bsd-3|2|endorse|neither the name of( [^ ]++){1,60}? may be used to endorse or promote products
bsd-4|2|acknowledgement|all advertising materials mentioning features or use of this software must display the following acknowledgement
mpl-1.0|3|spdx|spdx license identifier mpl 1 0
mpl-1.1|3|spdx|spdx license identifier mpl 1 1
mpl-2.0|3|spdx|spdx license identifier mpl 2 0( no copyleft exception)?
mpl-1.1|2|mozilla|mozilla public license( version| v)? 1 1
mpl-2.0|2|mozilla|mozilla public license( version| v)? 2( 0)?
mpl-2.0|3|mozilla|mozilla org mpl 2 0
mpl|1|mozilla|mozilla public license
mpl-2.0|2|mpl|mpl 2 0
npl|1|netscape|netscape public license
epl-1.0|3|spdx|spdx license identifier epl 1 0
epl-2.0|3|spdx|spdx license identifier epl 2 0
epl-1.0|2|eclipse|eclipse public license( version| v)? 1( 0)?
epl-2.0|2|eclipse|eclipse public license( version| v)? 2( 0)?
epl-1.0|3|eclipse|www eclipse org legal epl v10
epl-2.0|3|eclipse|www eclipse org legal epl( v20| 2 0)
epl|1|eclipse|eclipse public license
edl|1|eclipse|eclipse distribution license
cddl-1.0|3|spdx|spdx license identifier cddl 1 0
cddl-1.1|3|spdx|spdx license identifier cddl 1 1
cddl-1.0|2|cddl|cddl( version| v)? 1 0
cddl-1.1|2|cddl|cddl( version| v)? 1 1
cddl|1|common|common development and distribution license
cpl-1.0|2|common|common public license( version| v)? 1 0
cpl|1|common|common public license
cpal-1.0|1|common|common public attribution license
ipl-1.0|1|license|ibm public license
osl-3.0|2|license|open software license( version| v)? 3 0
osl|1|license|open software license
afl-3.0|2|academic|academic free license( version| v)? 3 0
afl|1|academic|academic free license
artistic-1.0|2|artistic|artistic license( version| v)? 1( 0)?
artistic-2.0|2|artistic|artistic license( version| v)? 2( 0)?
artistic|1|artistic|(perl )?artistic license
artistic|1|perl|same terms as perl itself
boost-1.0|3|spdx|spdx license identifier bsl 1 0
boost-1.0|2|boost|boost software license( version| v)? 1 0
boost|1|boost|boost software license
busl-1.1|3|spdx|spdx license identifier busl 1 1
busl-1.1|2|business|business source license( version)? 1 1
busl|1|business|business source license
sspl-1.0|2|server|server side public license( version| v)?( 1)?
elastic-2.0|2|elastic|elastic license( version| v)? 2( 0)?
elastic|1|elastic|elastic license
commons-clause|1|clause|commons clause( license condition)?
polyform|1|polyform|polyform (noncommercial|small business|perimeter|shield|internal use|free trial|strict) license
eupl-1.1|2|eupl|eupl( version| v)? 1 1
eupl-1.2|2|eupl|eupl( version| v)? 1 2
eupl|1|european|european union public licen[cs]e
cecill-2.1|2|cecill|cecill( free software license agreement)?( version| v)? 2 1
cecill|1|cecill|cecill( [bc])?( license)?
ms-pl|1|microsoft|microsoft public license
ms-rl|1|microsoft|microsoft reciprocal license
ms-pl|2|ms|ms pl
zlib|3|spdx|spdx license identifier zlib
zlib|1|license|zlib( libpng)? license
zlib|2|altered|altered source versions must be plainly marked as such
libpng|1|libpng|libpng license
unlicense|3|spdx|spdx license identifier unlicense
unlicense|1|unlicense|(the )?unlicense( org)?
unlicense|2|unencumbered|this is free and unencumbered software released into the public domain
wtfpl|1|wtfpl|wtfpl( version 2)?
wtfpl|2|license|do what the fuck you want to public license
beerware|1|beerware|beerware license
beerware|1|license|beer ware license
jquery|1|jquery|jquery license
json|2|evil|shall be used for good not evil
postgresql|1|postgresql|postgresql license
python-2.0|2|python|python software foundation license( version)?( 2)?
psf|1|license|psf license
python-2.0|1|python|python license
php-3.0|2|license|php license( version)? 3 0( 1)?
php|1|license|php license
ruby|1|license|ruby license
zpl-2.1|2|license|zope public license( zpl)?( version)? 2 1
zpl|1|license|zope public license
openssl|1|openssl|openssl license
ssleay|1|ssleay|(original )?ssleay license
w3c|1|license|w3c software( notice and)? license
ncsa|1|license|(university of illinois )?ncsa( open source)? license
ntp|1|license|ntp license
curl|1|license|curl license
icu|1|license|icu license
unicode|1|unicode,unicodes|unicode(s)? (terms of use|license agreement|data files)
ofl-1.1|2|ofl|sil ofl( version)? 1 1
ofl-1.1|2|license|sil open font license( version)? 1 1
ofl|1|license|sil open font license
qpl-1.0|1|license|qt public license
sleepycat|1|sleepycat|sleepycat license
vim|1|license|vim license
tcl|1|license|tcl tk license
ijg|1|jpeg|independent jpeg group
upl-1.0|1|permissive|universal permissive license
apsl-2.0|1|apple|apple public source license
aladdin|1|aladdin|aladdin free public license
cc0-1.0|3|spdx|spdx license identifier cc0 1 0
cc0-1.0|2|cc0|cc0 1 0( universal)?
cc0|1|cc0|cc0
cc0|1|creative|creative commons zero
public-domain|3|publicdomain|creativecommons org publicdomain (zero|mark) 1 0
cc-by-nc-nd|2|cc|cc by nc nd( [1-4] [05])?
cc-by-nc-sa|2|cc|cc by nc sa( [1-4] [05])?
cc-by-nc|2|cc|cc by nc( [1-4] [05])?
cc-by-nd|2|cc|cc by nd( [1-4] [05])?
cc-by-sa|2|cc|cc by sa( [1-4] [05])?
cc-by-1.0|2|cc|cc by 1 0
cc-by-2.0|2|cc|cc by 2 0
cc-by-2.5|2|cc|cc by 2 5
cc-by-3.0|2|cc|cc by 3 0
cc-by-4.0|2|cc|cc by 4 0
cc-by|1|cc|cc by
cc-by|3|creativecommons|creativecommons org licenses by [1-4] [05]
cc-by-sa|3|creativecommons|creativecommons org licenses by sa [1-4] [05]
cc-by-nc|3|creativecommons|creativecommons org licenses by nc [1-4] [05]
cc-by-nd|3|creativecommons|creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa|3|creativecommons|creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd|3|creativecommons|creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc-nd|2|creative|creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1-4] [05])?
cc-by-nc-sa|2|creative|creative commons attribution non ?commercial share ?alike( [1-4] [05])?
cc-by-nc|2|creative|creative commons attribution non ?commercial( [1-4] [05])?
cc-by-nd|2|creative|creative commons attribution no ?deriv(ative)?s?( works)?( [1-4] [05])?
cc-by-sa|2|creative|creative commons attribution share ?alike( [1-4] [05])?
cc-by|2|creative|creative commons attribution( [1-4] [05])?
cc|1|creative|creative commons( public)? license
odbl-1.0|1|odbl|odbl( 1 0)?
odbl-1.0|1|database|open database license
odc-by-1.0|1|odc|odc by( 1 0)?
odc-by-1.0|1|commons|open data commons attribution license
pddl-1.0|1|pddl|pddl( 1 0)?
cdla|1|cdla|cdla (permissive|sharing) (1|2) 0
ogl|1|government|open government licen[cs]e( v[123])?
openrail|1|openrail,rail|(creativeml )?open ?rail( m| plus plus m)?( license)?
bigscience-rail|1|rail|bigscience (open )?rail( license)?
llama|1|llama|llama( [2-4])? community license( agreement)?
gemma|1|gemma|gemma terms of use
proprietary|1|proprietary|proprietary and confidential
all-rights-reserved|1|reserved|all rights reserved
public-domain|1|domain|(released|dedicated|placed) (in|in to|into|to) the public domain
non-commercial|1|commercial,noncommercial|for non ?commercial (use|purposes) only
"""


def _rules() -> tuple[Rule, ...]:
    rules = []
    for line in _LINES.strip().splitlines():
        # The expression is the last part, as it may hold the separator.
        label, priority, keywords, pattern = line.split("|", 3)
        rules.append(Rule(label, int(priority), tuple(keywords.split(",")), pattern))
    return tuple(rules)


RULES = _rules()
