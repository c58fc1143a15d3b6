"""Signature rules of the license scan, in order of priority.

A rule matches the *normalised* text: its words (digits, letters, anything
beyond ASCII), lower-cased, one space between them, so "GPL-3.0" reads
"gpl 3 0". A line is: confidence | label | prefilter literal | pattern. The
literal is plain text that every match of the pattern contains; it contains
one of ``STEMS``, by which whole documents are ruled out first. Patterns
match whole words and never the empty text.
"""

from __future__ import annotations

from dataclasses import dataclass

#: A document without any of these holds no match of any rule.
STEMS = ("licen", "gpl", "apache", "copyright", "public domain", "creative commons", "cc by", "cc0", "bsd", "permission is hereby", "redistribution")

_RULES = r"""
1.00|gpl-2.0-only|spdx license identifier gpl|spdx license identifier gpl 2 0(?: only)?
1.00|gpl-2.0-or-later|spdx license identifier gpl|spdx license identifier gpl 2 0 or later
1.00|gpl-3.0-only|spdx license identifier gpl|spdx license identifier gpl 3 0(?: only)?
1.00|gpl-3.0-or-later|spdx license identifier gpl|spdx license identifier gpl 3 0 or later
1.00|lgpl-2.1|spdx license identifier lgpl|spdx license identifier lgpl 2 1(?: only| or later)?
1.00|lgpl-3.0|spdx license identifier lgpl|spdx license identifier lgpl 3 0(?: only| or later)?
1.00|agpl-3.0|spdx license identifier agpl|spdx license identifier agpl 3 0(?: only| or later)?
1.00|apache-2.0|spdx license identifier apache|spdx license identifier apache 2 0
1.00|mit|spdx license identifier mit|spdx license identifier mit
1.00|mit-0|spdx license identifier mit 0|spdx license identifier mit 0
1.00|bsd-2-clause|spdx license identifier bsd|spdx license identifier bsd 2 clause
1.00|bsd-3-clause|spdx license identifier bsd|spdx license identifier bsd 3 clause
1.00|0bsd|spdx license identifier 0bsd|spdx license identifier 0bsd
1.00|mpl-2.0|spdx license identifier mpl|spdx license identifier mpl 2 0
1.00|epl-2.0|spdx license identifier epl|spdx license identifier epl 2 0
1.00|isc|spdx license identifier isc|spdx license identifier isc
1.00|unlicense|spdx license identifier unlicense|spdx license identifier unlicense
1.00|cc0-1.0|spdx license identifier cc0|spdx license identifier cc0 1 0
1.00|cc-by-4.0|spdx license identifier cc by|spdx license identifier cc by 4 0
1.00|cc-by-sa-4.0|spdx license identifier cc by sa|spdx license identifier cc by sa 4 0
1.00|bsl-1.0|spdx license identifier bsl|spdx license identifier bsl 1 0
1.00|zlib|spdx license identifier zlib|spdx license identifier zlib
1.00|ofl-1.1|spdx license identifier ofl|spdx license identifier ofl 1 1
1.00|other-spdx|spdx license identifier|spdx license identifier [a-z0-9]+(?: [0-9]+)*
0.98|gpl-3.0-or-later|gnu general public license|gnu general public license(?: as published by the free software foundation)? (?:either )?version 3(?: 0)?(?: of the license)? or (?:at your option )?any later version
0.98|gpl-2.0-or-later|gnu general public license|gnu general public license(?: as published by the free software foundation)? (?:either )?version 2(?: 0)?(?: of the license)? or (?:at your option )?any later version
0.95|gpl-3.0|gnu general public license|gnu general public license (?:gpl )?(?:as published by the free software foundation )?(?:version |v)?3(?: 0)?
0.95|gpl-2.0|gnu general public license|gnu general public license (?:gpl )?(?:as published by the free software foundation )?(?:version |v)?2(?: 0)?
0.95|gpl-1.0|gnu general public license|gnu general public license (?:version |v)?1(?: 0)?
0.98|lgpl-2.1|lesser general public license|(?:gnu )?lesser general public license (?:lgpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v)?2 1(?: of the license or at your option any later version)?
0.98|lgpl-3.0|lesser general public license|(?:gnu )?lesser general public license (?:lgpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v)?3(?: 0)?
0.98|lgpl-2.0|library general public license|(?:gnu )?library general public license(?: (?:version |v)?2(?: 0)?)?
0.90|lgpl|lesser general public license|(?:gnu )?lesser general public license
0.98|agpl-3.0|affero general public license|(?:gnu )?affero general public license (?:agpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v)?3(?: 0)?
0.90|agpl|affero general public license|(?:gnu )?affero general public license
0.98|gfdl-1.3|free documentation license|(?:gnu )?free documentation license (?:version |v)?1 3
0.98|gfdl-1.2|free documentation license|(?:gnu )?free documentation license (?:version |v)?1 2
0.90|gfdl|free documentation license|(?:gnu )?free documentation license
0.85|gpl|general public license|(?:gnu )?general public license
0.90|gpl-3.0|gpl|(?:gnu )?(?:gplv3|gpl v3|gpl 3 0|gpl version 3)
0.90|gpl-2.0|gpl|(?:gnu )?(?:gplv2|gpl v2|gpl 2 0|gpl version 2)
0.90|lgpl-3.0|lgpl|(?:gnu )?(?:lgplv3|lgpl v3|lgpl 3 0)
0.90|lgpl-2.1|lgpl|(?:gnu )?(?:lgplv2 1|lgpl v2 1|lgpl 2 1)
0.90|agpl-3.0|agpl|(?:gnu )?(?:agplv3|agpl v3|agpl 3 0)
0.95|gpl|licenses gpl|(?:www )?gnu org licenses gpl(?: [0-9](?: [0-9])?)?(?: html| txt)?
0.95|lgpl|licenses lgpl|(?:www )?gnu org licenses lgpl(?: [0-9](?: [0-9])?)?(?: html| txt)?
0.95|agpl|licenses agpl|(?:www )?gnu org licenses agpl(?: [0-9](?: [0-9])?)?(?: html| txt)?
0.95|gfdl|licenses fdl|(?:www )?gnu org licenses fdl(?: [0-9](?: [0-9])?)?(?: html| txt)?
0.80|gpl|licensed under the gpl|licensed under the gpl
0.80|lgpl|licensed under the lgpl|licensed under the lgpl
0.80|agpl|licensed under the agpl|licensed under the agpl
0.95|gpl-2.0-with-classpath-exception|gpl|gpl(?: 2 0| v2)? with (?:the )?classpath exception
0.98|apache-2.0|apache license|(?:licensed under the )?apache license(?: asl)? (?:version |v)?2(?: 0)?(?: the license)?
0.98|apache-1.1|apache |(?:licensed under the )?apache (?:software )?license (?:version |v)?1 1
0.98|apache-1.0|apache |(?:licensed under the )?apache (?:software )?license (?:version |v)?1 0
0.95|apache-2.0|apache org licenses license|(?:http |https )?(?:www )?apache org licenses license 2 0(?: html| txt)?
0.90|apache-2.0|apache software license|apache software license(?: (?:version |v)?2(?: 0)?)?
0.90|apache-2.0|apache 2|apache 2(?: 0)?(?: licen[cs]ed?)?
0.80|apache|apache license|apache license
0.80|apache|apache licence|apache licence
0.95|mit|mit license|(?:released|licensed|distributed) under the mit license
0.85|mit|mit license|(?:the )?mit license
0.85|mit|mit licence|(?:the )?mit licence
0.95|mit|opensource org licenses mit|(?:https? )?(?:www )?opensource org licenses mit(?: license)?(?: php)?
0.95|mit|permission is hereby granted free of charge|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
0.80|mit|mit licensed|mit licensed
0.90|x11|x11 license|(?:the )?(?:mit )?x11 license
0.85|expat|expat license|(?:the )?expat license
0.95|isc|isc license|(?:the )?isc license
0.98|bsd-4-clause|bsd|(?:the )?(?:original |old |4 clause )bsd licen[cs]e
0.98|bsd-3-clause|bsd|(?:the )?(?:new |modified |revised |3 clause )bsd licen[cs]e
0.98|bsd-2-clause|bsd|(?:the )?(?:simplified |freebsd |2 clause )bsd licen[cs]e
0.95|bsd-3-clause|bsd 3 clause|bsd 3 clause(?: licen[cs]e)?
0.95|bsd-2-clause|bsd 2 clause|bsd 2 clause(?: licen[cs]e)?
0.95|bsd-4-clause|bsd 4 clause|bsd 4 clause(?: licen[cs]e)?
0.95|0bsd|bsd|(?:bsd zero clause|zero clause bsd) licen[cs]e
0.85|bsd|bsd licen|(?:the )?bsd licen[cs]e
0.80|bsd|bsd style licen|bsd style licen[cs]e
0.90|bsd|redistribution and use in source and binary forms|redistribution and use in source and binary forms with or without modification are permitted
0.95|bsd|licenses bsd|opensource org licenses bsd(?: [23] clause| license)?
0.98|mpl-2.0|mozilla public license|mozilla public license(?: mpl)? (?:version |v)?2(?: 0)?
0.98|mpl-1.1|mozilla public license|mozilla public license (?:version |v)?1 1
0.98|mpl-1.0|mozilla public license|mozilla public license (?:version |v)?1 0
0.85|mpl|mozilla public license|mozilla public license
0.98|epl-2.0|eclipse public license|eclipse public license (?:version |v)?2(?: 0)?
0.98|epl-1.0|eclipse public license|eclipse public license (?:version |v)?1(?: 0)?
0.85|epl|eclipse public license|eclipse public license
0.95|edl-1.0|eclipse distribution license|eclipse distribution license(?: (?:version |v)?1 0)?
0.95|cddl-1.1|common development and distribution license|common development and distribution license(?: cddl)? (?:version |v)?1 1
0.95|cddl-1.0|common development and distribution license|common development and distribution license(?: cddl)?(?: (?:version |v)?1 0)?
0.95|cpl-1.0|common public license|common public license(?: (?:version |v)?1 0)?
0.95|cpal-1.0|common public attribution license|common public attribution license(?: (?:version |v)?1 0)?
0.95|ipl-1.0|ibm public license|ibm public license(?: (?:version |v)?1 0)?
0.95|spl-1.0|sun public license|sun public license(?: (?:version |v)?1 0)?
0.95|sissl|sun industry standards source license|sun industry standards source license
0.95|artistic-2.0|artistic license|artistic license (?:version |v)?2(?: 0)?
0.95|artistic-1.0|artistic license|artistic license (?:version |v)?1(?: 0)?
0.85|artistic|artistic license|(?:clarified )?artistic license
0.90|artistic|licensed under the same terms as perl|licensed under the same terms as perl(?: itself)?
0.95|bsl-1.0|boost software license|boost software license(?: (?:version |v)?1 0)?
0.95|bsl-1.0|boost org license|boost org license 1 0(?: txt)?
0.95|busl-1.1|business source license|business source license(?: (?:version |v)?1 1)?
0.95|sspl-1.0|server side public license|server side public license(?: (?:version |v)?1)?
0.95|elastic-2.0|elastic license|elastic license(?: (?:version |v)?2(?: 0)?)?
0.95|motosoto|motosoto open source license|motosoto open source license
0.95|bitstream-vera|license|bitstream vera(?: fonts)? license
0.95|isc|copyright notice permission to use|copyright notice permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0.95|zlib|zlib license|(?:the )?zlib license
0.95|zlib|zlib libpng license|(?:the )?zlib libpng license
0.95|libpng-2.0|png reference library license|png reference library license(?: version 2)?
0.95|libtiff|libtiff license|libtiff license
0.95|ijg|independent jpeg group license|independent jpeg group license
0.95|curl|curl license|curl license
0.95|openssl|openssl license|(?:the )?openssl license
0.95|ssleay|ssleay license|(?:original )?ssleay license
0.95|psf-2.0|python software foundation license|python software foundation license(?: (?:version |v)?2)?
0.95|python-2.0|python license|python license(?: (?:version |v)?2(?: 0)?)?
0.95|php-3.01|php license|php license (?:version |v)?3 01
0.90|php|php license|php license(?: (?:version |v)?3(?: 0)?)?
0.95|ruby|ruby license|(?:the )?ruby license
0.95|perl|perl license|(?:the )?perl license
0.95|tcl|tcl tk license|tcl tk license
0.95|vim|vim license|(?:the )?vim license
0.95|w3c|licen|w3c software (?:notice and |and document )?licen[cs]e
0.95|unlicense|unlicense org|unlicense org
0.90|unlicense|the unlicense|the unlicense
0.95|unlicense|released into the public domain|this is free and unencumbered software released into the public domain
0.95|wtfpl|public license wtfpl|what the fuck you want to public license wtfpl
0.95|wtfpl|you want to public license|do what the fuck you want to public license
0.95|beerware|beer ware license|(?:the )?beer ware license(?: revision 42)?
0.95|postgresql|postgresql licen|(?:the )?postgresql licen[cs]e
0.95|ncsa|ncsa open source license|(?:university of illinois )?ncsa open source license
0.95|upl-1.0|universal permissive license|universal permissive license(?: (?:version |v)?1 0)?
0.95|ms-pl|microsoft public license|microsoft public license(?: ms pl)?
0.95|ms-rl|microsoft reciprocal license|microsoft reciprocal license(?: ms rl)?
0.95|ms-limited|microsoft limited public license|microsoft limited public license
0.95|apsl-2.0|apple public source license|apple public source license(?: (?:version |v)?2(?: 0)?)?
0.95|eupl-1.2|european union public licen|european union public licen[cs]e (?:version |v)?1 2
0.95|eupl-1.1|european union public licen|european union public licen[cs]e (?:version |v)?1 1
0.85|eupl|european union public licen|european union public licen[cs]e
0.95|cecill-2.1|licen|(?:the )?cecill(?: free software)? licen[cs]e(?: agreement)?(?: (?:version |v)?2 1)?
0.95|osl-3.0|open software license|open software license(?: (?:version |v)?3(?: 0)?)?
0.95|afl-3.0|academic free license|academic free license(?: (?:version |v)?3(?: 0)?)?
0.95|qpl-1.0|q public license|q public license(?: (?:version |v)?1 0)?
0.95|lppl-1.3c|latex project public license|latex project public license(?: (?:version |v)?1 3c?)?
0.95|nasa-1.3|license nasa open source agreement|license nasa open source agreement(?: (?:version |v)?1 3)?
0.95|rpl-1.5|reciprocal public license|reciprocal public license(?: (?:version |v)?1 5)?
0.95|rpsl|realnetworks public source license|realnetworks public source license(?: (?:version |v)?1 0)?
0.95|sleepycat|sleepycat license|(?:the )?sleepycat license
0.95|intel|intel open source license|intel open source license
0.95|lucent|lucent public license|lucent public license(?: (?:version |v)?1 02)?
0.95|nokia|nokia open source license|nokia open source license
0.95|npl|netscape public license|netscape public license(?: (?:version |v)?1 1)?
0.95|oclc|oclc research public license|oclc research public license(?: (?:version |v)?2 0)?
0.95|ogl-uk|open government licence|(?:uk )?open government licence(?: (?:version |v)?[123](?: 0)?)?
0.95|odbl-1.0|open database license|open database license(?: odbl)?(?: (?:version |v)?1 0)?
0.95|odc-by-1.0|open data commons attribution license|open data commons attribution license(?: (?:version |v)?1 0)?
0.95|pddl-1.0|public domain dedication and license|(?:open data commons )?public domain dedication and license(?: pddl)?
0.95|cdla-permissive|community data license agreement permissive|community data license agreement permissive(?: (?:version |v)?[12] 0)?
0.95|cdla-sharing|community data license agreement sharing|community data license agreement sharing(?: (?:version |v)?1 0)?
0.95|ofl-1.1|open font license|(?:sil )?open font license(?: ofl)?(?: (?:version |v)?1 1)?
0.95|ubuntu-font|ubuntu font licen|ubuntu font licen[cs]e(?: (?:version |v)?1 0)?
0.95|mulan-psl-2|mulan permissive software license|mulan permissive software license(?: (?:version |v)?[12])?
0.95|json|license software shall be used for good not evil|license software shall be used for good not evil
0.95|json|json license|(?:the )?json license
0.95|hpnd|license historical permission notice|license historical permission notice and disclaimer
0.95|icu|icu license|icu license
0.95|unicode|unicode license|unicode license(?: (?:version |v)?3)?
0.95|naist|naist license|naist license
0.95|fair|fair license|(?:the )?fair license
0.95|entessa|entessa public license|entessa public license
0.95|eiffel|eiffel forum license|eiffel forum license(?: (?:version |v)?2)?
0.95|frameworx|frameworx open license|frameworx open license
0.95|watcom|sybase open watcom public license|sybase open watcom public license
0.95|zpl-2.1|zope public license|zope public license(?: (?:version |v)?2 1)?
0.95|vsl|vovida software license|vovida software license
0.95|xnet|x net license|x net license
0.95|aal|attribution assurance license|attribution assurance license
0.95|simpl|simple public license|simple public license(?: (?:version |v)?2 0)?
0.95|catosl|computer associates trusted open source license|computer associates trusted open source license
0.95|ecl-2.0|educational community license|educational community license(?: (?:version |v)?2 0)?
0.95|efl|eu datagrid software license|eu datagrid software license
0.95|openldap|openldap public license|openldap public license(?: (?:version |v)?2 8)?
0.95|rail|responsible ai license|(?:open )?(?:creativeml )?responsible ai license
0.95|openrail-m|openrail m license|(?:creativeml |bigscience )?openrail m license
0.95|llama|community license agreement|llama [0-9](?: [0-9])? community license agreement
0.95|commons-clause|commons clause license|commons clause license condition
0.95|polyform|license|polyform (?:noncommercial|small business|perimeter|shield|strict) license
0.98|cc-by-nc-nd-4.0|cc by nc nd|cc by nc nd 4 0
0.98|cc-by-nc-nd-3.0|cc by nc nd|cc by nc nd 3 0
0.98|cc-by-nc-sa-4.0|cc by nc sa|cc by nc sa 4 0
0.98|cc-by-nc-sa-3.0|cc by nc sa|cc by nc sa 3 0
0.98|cc-by-nc-4.0|cc by nc|cc by nc 4 0
0.98|cc-by-nc-3.0|cc by nc|cc by nc 3 0
0.98|cc-by-nd-4.0|cc by nd|cc by nd 4 0
0.98|cc-by-nd-3.0|cc by nd|cc by nd 3 0
0.98|cc-by-sa-4.0|cc by sa|cc by sa 4 0
0.98|cc-by-sa-3.0|cc by sa|cc by sa 3 0
0.98|cc-by-4.0|cc by 4 0|cc by 4 0
0.98|cc-by-3.0|cc by 3 0|cc by 3 0
0.98|cc-by-2.0|cc by 2 0|cc by 2 0
0.85|cc-by-nc-nd|cc by nc nd|cc by nc nd
0.85|cc-by-nc-sa|cc by nc sa|cc by nc sa
0.85|cc-by-nc|cc by nc|cc by nc
0.85|cc-by-nd|cc by nd|cc by nd
0.85|cc-by-sa|cc by sa|cc by sa
0.80|cc-by|cc by|cc by
0.98|cc-by-nc-nd|creative commons attribution|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.98|cc-by-nc-sa|creative commons attribution|creative commons attribution non ?commercial share ?alike(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.98|cc-by-nc|creative commons attribution|creative commons attribution non ?commercial(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.98|cc-by-nd|creative commons attribution|creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.98|cc-by-sa|creative commons attribution|creative commons attribution share ?alike(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.95|cc-by|creative commons attribution|creative commons attribution(?: [0-9] 0)?(?: international| unported)?(?: (?:public )?license)?
0.95|cc-by|creativecommons org licenses by|creativecommons org licenses by [0-9] [0-9]
0.95|cc-by-sa|creativecommons org licenses by sa|creativecommons org licenses by sa [0-9] [0-9]
0.95|cc-by-nc|creativecommons org licenses by nc|creativecommons org licenses by nc [0-9] [0-9]
0.95|cc-by-nd|creativecommons org licenses by nd|creativecommons org licenses by nd [0-9] [0-9]
0.95|cc-by-nc-sa|creativecommons org licenses by nc sa|creativecommons org licenses by nc sa [0-9] [0-9]
0.95|cc-by-nc-nd|creativecommons org licenses by nc nd|creativecommons org licenses by nc nd [0-9] [0-9]
0.98|cc0-1.0|cc0|cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
0.98|cc-pdm-1.0|public domain mark|public domain mark(?: 1 0)?
0.80|creative-commons|creative commons licen|(?:a )?creative commons licen[cs]e
0.85|public-domain|public domain|(?:dedicated to|placed in|in|into) the public domain
0.60|proprietary|copyright|copyright (?:c )?(?:[12][0-9]{3} )?(?:[^ ]+ ){0,6}all rights reserved
0.60|non-commercial|licen|licen[cs]ed for (?:personal and )?non ?commercial use(?: only)?
0.50|see-license-file|licen|see (?:the )?(?:accompanying )?(?:file )?licen[cs]e(?: file| txt| md)?(?: for (?:details|more information|licen[cs]e terms))?
"""


@dataclass(frozen=True)
class Rule:
    priority: int
    confidence: float
    label: str
    literal: str
    pattern: str


def parse(lines: str) -> list[Rule]:
    """Rules in order; patterns may hold '|'."""
    found = []
    for line in lines.strip().splitlines():
        confidence, label, literal, pattern = line.split("|", 3)
        found.append(Rule(len(found), float(confidence), label, literal, pattern))
    return found


RULES = parse(_RULES)
