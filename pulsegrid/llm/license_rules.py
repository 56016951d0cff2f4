"""Signature rules of the licence scan, written over normalised words (lower case, single spaces).

Fixed values: names, phrases and identifiers as licences and package indexes use them. A rule is (label, priority,
keyword, pattern, confidence); lower priority wins. A keyword is a literal that every match of the pattern holds.
"""

from __future__ import annotations

import re

#: label | keyword | regular expressions of its names and telling sentences
SIGNATURES = r"""
apache-1.0 | apache | apache (?:software )?license v(?:ersion )?1 0 ; apache software license 1 0
apache-1.1 | apache | apache (?:software )?license (?:v|version )?1 1 ; apache 1 1 license
apache-2 | apache | apache (?:software )?license(?: version| v)? ?2(?: 0)? ; apache 2(?: 0)? licen[cs]ed? ; licensed under apache 2(?: 0)? ; apache org licenses license 2 0 ; asl 2 0 apache
mit | mit | (?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit(?: x11)? licen[cs]e ; the mit licen[cs]e(?: mit)? ; mit licensed ; opensource org licenses mit ; licen[cs]e mit ; mit licen[cs]e
mit | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | mit | mit no attribution(?: licen[cs]e)? ; mit 0 licen[cs]e
x11 | x11 | x11 licen[cs]e ; mit x11 licen[cs]e
bsd-0 | bsd | 0 clause bsd(?: licen[cs]e)? ; zero clause bsd(?: licen[cs]e)? ; bsd zero clause licen[cs]e ; 0bsd licen[cs]e
bsd-1 | bsd | 1 clause bsd licen[cs]e ; bsd 1 clause(?: licen[cs]e)?
bsd-2 | bsd | (?:2|two) clause bsd(?: licen[cs]e)? ; bsd (?:2|two) clause(?: licen[cs]e)? ; simplified bsd licen[cs]e ; freebsd licen[cs]e
bsd-3 | bsd | (?:3|three) clause bsd(?: licen[cs]e)? ; bsd (?:3|three) clause(?: licen[cs]e)? ; (?:new|modified|revised) bsd licen[cs]e
bsd-3 | endorse | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-4 | bsd | (?:4|four) clause bsd(?: licen[cs]e)? ; bsd (?:4|four) clause(?: licen[cs]e)? ; (?:original|old) bsd licen[cs]e
bsd | bsd | (?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?bsd licen[cs]e ; bsd style licen[cs]e ; bsd licen[cs]ed?
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
gpl-1.0 | general public | gnu general public licen[cs]e (?:version |v)1(?: 0)?
gpl-2.0 | general public | gnu general public licen[cs]e (?:version |v)2(?: 0)?(?: only)? ; general public licen[cs]e as published by the free software foundation version 2
gpl-2.0 | gpl | (?:gnu )?gpl ?(?:version )?v?2(?: 0)?(?: only)? ; gplv2
gpl-2.0-or-later | general public | gnu general public licen[cs]e (?:version |v)2(?: 0)? or (?:at your option )?(?:any )?later
gpl-2.0-or-later | either version | either version 2 of the licen[cs]e or at your option any later version
gpl-2.0-or-later | gpl | gpl ?(?:version )?v?2(?: 0)? or (?:any )?later ; gplv2 or later
gpl-3.0 | general public | gnu general public licen[cs]e (?:version |v)3(?: 0)?(?: only)? ; general public licen[cs]e as published by the free software foundation version 3
gpl-3.0 | gpl | (?:gnu )?gpl ?(?:version )?v?3(?: 0)?(?: only)? ; gplv3
gpl-3.0-or-later | general public | gnu general public licen[cs]e (?:version |v)3(?: 0)? or (?:at your option )?(?:any )?later
gpl-3.0-or-later | either version | either version 3 of the licen[cs]e or at your option any later version
gpl-3.0-or-later | gpl | gpl ?(?:version )?v?3(?: 0)? or (?:any )?later ; gplv3 or later
gpl | general public | gnu general public licen[cs]e ; terms of the general public licen[cs]e
gpl | gpl | (?:released|licensed|distributed|available) under (?:the )?(?:gnu )?gpl ; gnu gpl ; gpl licen[cs]ed?
lgpl-2.0 | library general | gnu library general public licen[cs]e(?: version 2(?: 0)?)?
lgpl-2.1 | lesser general | gnu lesser general public licen[cs]e (?:version |v)2 1(?: only)?
lgpl-2.1 | lgpl | (?:gnu )?lgpl ?(?:version )?v?2 1 ; lgplv2 1
lgpl-3.0 | lesser general | gnu lesser general public licen[cs]e (?:version |v)3(?: 0)?(?: only)?
lgpl-3.0 | lgpl | (?:gnu )?lgpl ?(?:version )?v?3(?: 0)? ; lgplv3
lgpl | lesser general | gnu lesser general public licen[cs]e ; lesser general public licen[cs]e
lgpl | lgpl | gnu lgpl ; (?:licensed|released) under (?:the )?lgpl ; lgpl licen[cs]ed?
agpl-1.0 | affero | affero general public licen[cs]e (?:version |v)1(?: 0)?
agpl-3.0 | affero | gnu affero general public licen[cs]e(?: (?:version |v)3(?: 0)?)?(?: only)?
agpl-3.0 | agpl | (?:gnu )?agpl ?(?:version )?v?3(?: 0)? ; agplv3 ; licensed under (?:the )?agpl
gfdl | free documentation | gnu free documentation licen[cs]e(?: (?:version |v)1 [123])?
gfdl | gfdl | (?:gnu )?gfdl ?(?:version )?v?1 [123] ; licensed under (?:the )?gfdl
mpl-1.0 | mozilla | mozilla public licen[cs]e (?:version |v)?1 0
mpl-1.1 | mozilla | mozilla public licen[cs]e (?:version |v)?1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e (?:version |v)?2 0 ; terms of the mozilla public licen[cs]e v 2 0
mpl | mozilla | mozilla public licen[cs]e
mpl-2.0 | mpl | mpl ?(?:version )?v?2 0 ; mplv2
epl-1.0 | eclipse | eclipse public licen[cs]e(?: (?:version|v))? ?1 0
epl-2.0 | eclipse | eclipse public licen[cs]e(?: (?:version|v))? ?2 0
epl | eclipse | eclipse public licen[cs]e
edl-1.0 | eclipse | eclipse distribution licen[cs]e(?: v(?:ersion)? ?1 0)?
cpl-1.0 | common public | common public licen[cs]e(?: (?:version|v) ?1 0)?
cpal-1.0 | common public | common public attribution licen[cs]e(?: version 1 0)?
cddl-1.0 | common development | common development and distribution licen[cs]e(?: (?:version|v)? ?1 0)?
cddl-1.1 | common development | common development and distribution licen[cs]e (?:version |v)?1 1
cddl | cddl | cddl (?:version |v)?1 [01] ; licensed under (?:the )?cddl
cecill-2.1 | cecill | cecill(?: free software)? licen[cs]e(?: agreement)?(?: (?:version |v)?2 1)? ; licence cecill
cecill-b | cecill | cecill b(?: free software)?(?: licen[cs]e)?
cecill-c | cecill | cecill c(?: free software)?(?: licen[cs]e)?
isc | isc | isc licen[cs]e ; (?:released|licensed) under (?:the )?isc
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | zlib | zlib libpng licen[cs]e ; zlib licen[cs]e ; (?:released|licensed) under (?:the )?zlib
zlib | misrepresented | the origin of this software must not be misrepresented
libpng | libpng | libpng licen[cs]e(?: version 2)?
unlicense | unlicense | the unlicense ; unlicense org ; unlicense licen[cs]e
unlicense | public domain | this is free and unencumbered software released into the public domain
wtfpl | want to public | do what the f\w+ you want to public licen[cs]e
wtfpl | wtfpl | wtfpl(?: version 2| v2)?
bsl-1.0 | boost | boost software licen[cs]e(?: (?:version|v) ?1 0)?
busl-1.1 | business source | business source licen[cs]e(?: (?:version )?1 1)?
sspl-1.0 | server side public | server side public licen[cs]e(?: (?:version|v) ?1(?: 0)?)?
elastic-2.0 | elastic | elastic licen[cs]e (?:version |v)?2(?: 0)? ; elastic licen[cs]e
artistic-1.0 | artistic | artistic licen[cs]e (?:version |v)?1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version |v)?2 0
artistic | artistic | (?:the |perl )?artistic licen[cs]e
afl-3.0 | academic free | academic free licen[cs]e(?: (?:version|v)? ?3 0)?
osl-3.0 | open software | open software licen[cs]e(?: (?:version|v)? ?3 0)?
ecl-2.0 | educational | educational community licen[cs]e(?: (?:version|v)? ?2 0)?
eupl-1.1 | european union | european union public licen[cs]e (?:version |v)?1 1
eupl-1.2 | european union | european union public licen[cs]e(?: (?:version |v)?1 2)?
eupl | eupl | eupl ?(?:version )?v?1 [012] ; licensed under (?:the )?eupl
ms-pl | microsoft | microsoft public licen[cs]e(?: ms pl)?
ms-rl | microsoft | microsoft reciprocal licen[cs]e(?: ms rl)?
ncsa | ncsa | university of illinois ncsa open source licen[cs]e ; ncsa open source licen[cs]e
python-2.0 | python | python software foundation licen[cs]e(?: version 2)? ; psf licen[cs]e agreement for python ; python licen[cs]e
php-3.01 | php | (?:the )?php licen[cs]e(?: (?:version|v) ?3 0 ?1)?
ruby | ruby | ruby s licen[cs]e ; ruby licen[cs]e ; same terms as ruby itself
perl | perl | same terms as perl itself ; under the same terms as the perl 5 programming language
postgresql | postgresql | postgresql licen[cs]e ; licensed under (?:the )?postgresql
openssl | openssl | openssl licen[cs]e ; openssl and ssleay licen[cs]e
curl | curl | curl licen[cs]e
vim | vim | vim licen[cs]e
w3c | w3c | w3c software (?:notice and )?licen[cs]e ; w3c document licen[cs]e
unicode | unicode | unicode licen[cs]e (?:agreement|v3) ; unicode terms of use
ofl-1.1 | open font | (?:sil )?open font licen[cs]e(?: (?:version )?1 [01])?
ofl-1.1 | ofl | licensed under (?:the )?sil ofl ; ofl 1 1
lppl-1.3c | latex | latex project public licen[cs]e(?: (?:version|v)? ?1 3 ?c?)?
ijg | jpeg | independent jpeg group s? ?licen[cs]e ; this software is based in part on the work of the independent jpeg group
ipl-1.0 | ibm | ibm public licen[cs]e(?: (?:version|v)? ?1 0)?
npl-1.1 | netscape | netscape public licen[cs]e(?: (?:version|v)? ?1 [01])?
qpl-1.0 | q public | q public licen[cs]e(?: (?:version|v)? ?1 0)?
sleepycat | sleepycat | sleepycat licen[cs]e
spl-1.0 | sun public | sun public licen[cs]e(?: (?:version|v)? ?1 0)?
upl-1.0 | universal permissive | universal permissive licen[cs]e(?: (?:version|v)? ?1 0)?
vsl-1.0 | vovida | vovida software licen[cs]e(?: (?:version|v)? ?1 0)?
zpl-2.1 | zope | zope public licen[cs]e(?: (?:version|v)? ?2 [01])?
rpl-1.5 | reciprocal public | reciprocal public licen[cs]e(?: (?:version|v)? ?1 [15])?
blueoak-1.0 | blue oak | blue oak model licen[cs]e(?: 1 0 0)?
mulan-2 | mulan | mulan (?:permissive software|psl) licen[cs]e(?: (?:version|v)? ?2)? ; mulan psl v2
odbl-1.0 | database | open (?:data commons )?(?:open )?database licen[cs]e(?: (?:version|v)? ?1 0)?
odc-by-1.0 | open data commons | open data commons attribution licen[cs]e(?: (?:version|v)? ?1 0)?
pddl-1.0 | public domain dedication | (?:open data commons )?public domain dedication and licen[cs]e
cc0-1.0 | cc0 | cc0(?: (?:version )?1 0)?(?: universal)? ; cc0 licen[cs]e
cc0-1.0 | creative commons | creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?
cc0-1.0 | creativecommons org | creativecommons org publicdomain zero 1 0
cc-by-nc-nd | nc nd | cc by nc nd(?: [1234] [05])?
cc-by-nc-nd | noncommercial | creative commons attribution noncommercial no ?deriv(?:ative)?s?(?: (?:works )?[1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-nc-nd | non commercial | creative commons attribution non commercial no ?deriv(?:ative)?s?(?: (?:works )?[1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-nc-sa | nc sa | cc by nc sa(?: [1234] [05])?
cc-by-nc-sa | noncommercial | creative commons attribution noncommercial share ?alike(?: [1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-nc | cc by nc | cc by nc(?: [1234] [05])?
cc-by-nc | noncommercial | creative commons attribution noncommercial(?: [1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-nc | non commercial | creative commons attribution non commercial(?: [1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-nd | cc by nd | cc by nd(?: [1234] [05])?
cc-by-nd | deriv | creative commons attribution no ?deriv(?:ative)?s?(?: (?:works )?[1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by-sa | cc by sa | cc by sa(?: [1234] [05])?
cc-by-sa | creative commons | creative commons attribution share ?alike(?: [1234] [05])?(?: international)?(?: licen[cs]e)?
cc-by | cc by | (?:under|licen[cs]e|licensed) cc by(?: [1234] [05])? ; cc by [1234] [05]
cc-by | creative commons | creative commons attribution(?: [1234] [05])?(?: international)?(?: licen[cs]e)?
cc | creative commons | creative commons licen[cs]e ; creative commons org licenses
public-domain | public domain | (?:released|dedicated|placed)(?: in)?(?: ?to)? the public domain ; this (?:work|file|software|page) is in the public domain ; public domain work
proprietary | all rights reserved | (?:copyright .{0,60}? )?all rights reserved
proprietary | proprietary | proprietary and confidential ; proprietary licen[cs]e
proprietary | unauthorized copying | unauthorized copying of this file
proprietary | redistribution | redistribution (?:is )?(?:not permitted|prohibited) ; no redistribution without permission
proprietary | personal use | for personal use only
proprietary | personal non commercial | personal non commercial use only
"""

#: Identifiers that may follow "SPDX-License-Identifier"; "-" and "." part words there.
IDENTIFIERS = """
0bsd aal afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 artistic-1.0 artistic-2.0
beerware blessing blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause
bsl-1.0 busl-1.1 bzip2-1.0.6 cal-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0
cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0
cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0 curl ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0
eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only
gpl-3.0-or-later hpnd ijg ipl-1.0 isc json lgpl-2.0 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only
lgpl-3.0-or-later libpng-2.0 lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa npl-1.1 odbl-1.0 ofl-1.1
openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sleepycat spl-1.0 sspl-1.0 unlicense upl-1.0
vim vsl-1.0 w3c wtfpl x11 zlib zpl-2.1
"""


def rules() -> list[tuple[str, int, str, str, float]]:
    """All rules: identifiers first, then the signatures from specific to general."""
    out = []
    for name in IDENTIFIERS.split():
        words = " ".join(re.split(r"[-.]", name))
        out.append((re.sub(r"-only$", "", name.replace("apache-2.0", "apache-2")), 0, f"identifier {words.split()[0]}",
                    rf"(?<= )(?:spdx )?licen[cs]e identifier {words}(?= )", 1.0))
    for line in SIGNATURES.strip().splitlines():
        label, keyword, patterns = (x.strip() for x in line.split(" | ", 2))
        for pattern in patterns.split(" ; "):
            general = not re.search(r"\d", label) and label in ("bsd", "gpl", "lgpl", "mpl", "epl", "artistic", "cc", "proprietary", "public-domain")
            out.append((label, 2 if general else 1, keyword, rf"(?<= ){pattern.strip()}(?= )", 0.6 if general else 0.9))
    return out
