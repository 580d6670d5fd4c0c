"""Signature rules of the license scan: hand-written expressions over normalised words.

A text is its words (``quernstone.llm.licenses``) with single spaces between, so ``2.0`` reads ``2 0`` and
``CC-BY-SA`` reads ``cc by sa``. An expression matches whole words only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Licenses: label | gate word | name | SPDX identifier | address. The gate word is in every text that the name matches.
LICENSES = """
apache-1.0 | apache | apache (?:software )?license(?: version| v)? ?1 0 | apache 1 0 | apache org licenses license 1 0
apache-1.1 | apache | apache (?:software )?license(?: version| v)? ?1 1 | apache 1 1 | apache org licenses license 1 1
apache-2.0 | apache | apache (?:software )?license(?: version| v)? ?2(?: 0)? | apache 2 0 | apache org licenses license 2 0
mit | mit | (?:the )?mit(?: expat)? licen[cs]e | mit | opensource org licen[cs]es? mit
mit-0 | mit | mit (?:no attribution|0)(?: licen[cs]e)? | mit 0 | opensource org licen[cs]es? mit 0
isc | isc | isc licen[cs]e | isc | opensource org licen[cs]es? isc
0bsd | bsd | (?:zero clause|0 clause|0) bsd(?: licen[cs]e)? | 0bsd | opensource org licen[cs]es? 0bsd
bsd-2-clause | bsd | (?:(?:2|two) clause|simplified|freebsd) bsd(?: licen[cs]e)?|bsd (?:2|two) clause(?: licen[cs]e)? | bsd 2 clause | opensource org licen[cs]es? bsd 2 clause
bsd-3-clause | bsd | (?:(?:3|three) clause|new|revised|modified) bsd(?: licen[cs]e)?|bsd (?:3|three) clause(?: licen[cs]e)? | bsd 3 clause | opensource org licen[cs]es? bsd 3 clause
bsd-4-clause | bsd | (?:(?:4|four) clause|original|old) bsd(?: licen[cs]e)?|bsd (?:4|four) clause(?: licen[cs]e)? | bsd 4 clause | spdx org licenses bsd 4 clause
gpl-1.0 | gpl | gnu gpl(?: version| v)? ?1(?: 0)?|gpl ?(?:version |v)?1(?: 0)? | gpl 1 0(?: only| or later)? | gnu org licenses(?: old licenses)? gpl 1 0
gpl-2.0 | gpl | gnu gpl(?: version| v)? ?2(?: 0)?|gpl (?:version |v)?2(?: 0)? | gpl 2 0(?: only| or later)? | gnu org licenses(?: old licenses)? gpl 2 0
gpl-3.0 | gpl | gnu gpl(?: version| v)? ?3(?: 0)?|gpl (?:version |v)?3(?: 0)? | gpl 3 0(?: only| or later)? | gnu org licenses gpl(?: 3 0)?
lgpl-2.0 | lgpl | (?:gnu )?lgpl (?:version |v)?2(?: 0)? | lgpl 2 0(?: only| or later)? | gnu org licenses(?: old licenses)? lgpl 2 0
lgpl-2.1 | lgpl | (?:gnu )?lgpl (?:version |v)?2 1 | lgpl 2 1(?: only| or later)? | gnu org licenses(?: old licenses)? lgpl 2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl (?:version |v)?3(?: 0)? | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl(?: 3 0)?
agpl-3.0 | agpl | (?:gnu )?agpl (?:version |v)?3(?: 0)? | agpl 3 0(?: only| or later)? | gnu org licenses agpl(?: 3 0)?
gfdl-1.2 | documentation | gnu free documentation license(?: version| v)? ?1 2 | gfdl 1 2(?: only| or later)? | gnu org licenses(?: old licenses)? fdl 1 2
gfdl-1.3 | documentation | gnu free documentation license(?: version| v)? ?1 3 | gfdl 1 3(?: only| or later)? | gnu org licenses fdl 1 3
mpl-1.0 | mozilla | mozilla public license(?: version| v)? ?1 0 | mpl 1 0 | mozilla org mpl 1 0
mpl-1.1 | mozilla | mozilla public license(?: version| v)? ?1 1 | mpl 1 1 | mozilla org mpl 1 1
mpl-2.0 | mozilla | mozilla public license(?: version| v)? ?2(?: 0)? | mpl 2 0 | mozilla org mpl 2 0
epl-1.0 | eclipse | eclipse public license(?: version| v)? ?1(?: 0)? | epl 1 0 | eclipse org legal epl v10
epl-2.0 | eclipse | eclipse public license(?: version| v)? ?2(?: 0)? | epl 2 0 | eclipse org legal epl (?:2 0|v20)
edl-1.0 | eclipse | eclipse distribution license(?: version| v)? ?1(?: 0)? | bsd 3 clause eclipse | eclipse org org documents edl v10
cpl-1.0 | common | common public license(?: version| v)? ?1(?: 0)? | cpl 1 0 | opensource org licen[cs]es? cpl 1 0
cddl-1.0 | distribution | common development and distribution license(?: version| v)? ?1 0 | cddl 1 0 | opensource org licen[cs]es? cddl 1 0
cddl-1.1 | distribution | common development and distribution license(?: version| v)? ?1 1 | cddl 1 1 | spdx org licenses cddl 1 1
eupl-1.1 | european | european union public licen[cs]e(?: version| v)? ?1 1 | eupl 1 1 | joinup ec europa eu software page eupl
eupl-1.2 | european | european union public licen[cs]e(?: version| v)? ?1 2 | eupl 1 2 | joinup ec europa eu collection eupl eupl text 11 12
artistic-1.0 | artistic | (?:perl )?artistic license(?: version| v)? ?1(?: 0)? | artistic 1 0(?: perl)? | opensource org licen[cs]es? artistic 1 0
artistic-2.0 | artistic | (?:perl )?artistic license(?: version| v)? ?2(?: 0)? | artistic 2 0 | opensource org licen[cs]es? artistic 2 0
bsl-1.0 | boost | boost software license(?: version| v)?(?: ?1(?: 0)?)? | bsl 1 0 | boost org license 1 0
busl-1.1 | business | business source license(?: version| v)?(?: ?1 1)? | busl 1 1 | mariadb com bsl11
zlib | zlib | (?:the )?zlib(?: libpng)? licen[cs]e | zlib | zlib net zlib license
libpng | libpng | (?:the )?libpng license(?: version 2)? | libpng(?: 2 0)? | libpng org pub png src libpng license
unlicense | unlicense | (?:the )?unlicense | unlicense | unlicense org
wtfpl | public | do what the (?:fuck|f) you want to public license | wtfpl | wtfpl net
cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero 1 0
cc-pdm | mark | public domain mark(?: 1 0)? | cc pddc | creativecommons org publicdomain mark 1 0
cc-by-sa | cc | cc by sa(?: [1-4] 0)? | cc by sa [1-4] 0 | creativecommons org licenses by sa(?: [1-4] 0)?
cc-by-nd | cc | cc by nd(?: [1-4] 0)? | cc by nd [1-4] 0 | creativecommons org licenses by nd(?: [1-4] 0)?
cc-by-nc | cc | cc by nc(?: [1-4] 0)? | cc by nc [1-4] 0 | creativecommons org licenses by nc(?: [1-4] 0)?
cc-by-nc-sa | cc | cc by nc sa(?: [1-4] 0)? | cc by nc sa [1-4] 0 | creativecommons org licenses by nc sa(?: [1-4] 0)?
cc-by-nc-nd | cc | cc by nc nd(?: [1-4] 0)? | cc by nc nd [1-4] 0 | creativecommons org licenses by nc nd(?: [1-4] 0)?
cc-by-1.0 | cc | cc by 1 0 | cc by 1 0 | creativecommons org licenses by 1 0
cc-by-2.0 | cc | cc by 2 0 | cc by 2 0 | creativecommons org licenses by 2 0
cc-by-2.5 | cc | cc by 2 5 | cc by 2 5 | creativecommons org licenses by 2 5
cc-by-3.0 | cc | cc by 3 0 | cc by 3 0 | creativecommons org licenses by 3 0
cc-by-4.0 | cc | cc by 4 0 | cc by 4 0 | creativecommons org licenses by 4 0
odbl-1.0 | database | open (?:data commons open )?database license(?: odbl)?(?: version| v)?(?: ?1 0)? | odbl 1 0 | opendatacommons org licenses odbl
odc-by-1.0 | attribution | open data commons attribution license | odc by 1 0 | opendatacommons org licenses by
pddl-1.0 | dedication | (?:open data commons )?public domain dedication and licen[cs]e | pddl 1 0 | opendatacommons org licenses pddl
ofl-1.1 | font | sil open font license(?: version| v)?(?: ?1 1)? | ofl 1 1 | scripts sil org ofl
openssl | openssl | openssl(?: ssleay)? license | openssl | openssl org source license
python-2.0 | python | (?:python software foundation|psf|python) license(?: agreement)?(?: version 2)? | (?:python 2 0|psf 2 0) | docs python org license
php-3.01 | php | php license(?: version| v)?(?: ?3 0[01])? | php 3 01 | php net license 3 01
ruby | ruby | (?:the )?ruby license | ruby | ruby lang org en about license
postgresql | postgresql | (?:the )?postgresql licen[cs]e | postgresql | opensource org licen[cs]es? postgresql
ncsa | illinois | university of illinois(?: ncsa)? open source license | ncsa | opensource org licen[cs]es? ncsa
ms-pl | microsoft | microsoft public license(?: ms pl)? | ms pl | opensource org licen[cs]es? ms pl
ms-rl | microsoft | microsoft reciprocal license(?: ms rl)? | ms rl | opensource org licen[cs]es? ms rl
afl-3.0 | academic | academic free license(?: version| v)?(?: ?3 0)? | afl 3 0 | opensource org licen[cs]es? afl 3 0
osl-3.0 | open | open software license(?: version| v)?(?: ?3 0)? | osl 3 0 | opensource org licen[cs]es? osl 3 0
ecl-2.0 | educational | educational community license(?: version| v)?(?: ?2 0)? | ecl 2 0 | opensource org licen[cs]es? ecl 2 0
upl-1.0 | universal | universal permissive license(?: version| v)?(?: ?1 0)? | upl 1 0 | oss oracle com licenses upl
lppl-1.3 | latex | latex project public license(?: version| v)?(?: ?1 3[ac]?)? | lppl 1 3[ac]? | latex project org lppl
cecill-2.1 | cecill | cecill(?: free software)? licen[cs]e(?: agreement)?(?: version 2 1)? | cecill 2 1 | cecill info licences
sspl-1.0 | server | server side public license(?: version| v)?(?: ?1)? | sspl 1 0 | mongodb com licensing server side public license
elastic-2.0 | elastic | elastic license(?: version| v)?(?: ?2 0)? | elastic 2 0 | elastic co licensing elastic license
polyform-nc | polyform | polyform noncommercial license(?: 1 0 0)? | polyform noncommercial 1 0 0 | polyformproject org licenses noncommercial
blueoak-1.0.0 | blue | blue oak model license(?: 1 0 0)? | blueoak 1 0 0 | blueoakcouncil org license 1 0 0
hippocratic | hippocratic | hippocratic license(?: version)?(?: [123] [01])? | hippocratic 2 1 | firstdonoharm dev
beerware | beer | (?:the )?beer ware license(?: revision 42)? | beerware | people freebsd org phk
json | good | software shall be used for good not evil | json | json org license
vim | vim | (?:the )?vim license | vim | vimhelp org uganda
x11 | x11 | (?:the )?(?:mit )?x11 licen[cs]e | x11 | x org releases license
watcom-1.0 | watcom | sybase open watcom public license(?: 1 0)? | watcom 1 0 | opensource org licen[cs]es? watcom 1 0
ogl-uk | government | open government licen[cs]e(?: v?[123](?: 0)?)? | ogl uk [123] 0 | nationalarchives gov uk doc open government licence
etalab | ouverte | licence ouverte(?: etalab)?(?: 2 0)? | etalab 2 0 | etalab gouv fr licence ouverte
dl-de-by | datenlizenz | datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)? | dl de by 2 0 | govdata de dl de by 2 0
"""

#: Notices and clauses: label | gate word | expression | priority. Higher priorities win over what they contain.
NOTICES = """
apache-2.0 | limitations | you may not use this (?:file|work) except in compliance with the license.{0,400}?limitations under the license | 9
apache-2.0 | apache | licensed under the apache license(?: version 2 0)? | 7
apache | apache | apache licen[cs]ed? | 3
mit | granted | permission is hereby granted free of charge to any person obtaining a copy.{0,900}?(?:substantial portions of the software|as is) | 9
mit | mit | (?:released|licen[cs]ed|distributed|available) under (?:the )?(?:terms of the )?mit(?: licen[cs]e)? | 7
isc | isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.{0,300}?isc | 9
isc-or-0bsd | fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted | 8
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted | 8
bsd-3-clause | endorse | neither the name of .{1,80}? may be used to endorse or promote products | 8
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display | 8
bsd | bsd | bsd(?: style)? licen[cs]ed? | 3
gpl-2.0-or-later | version | gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version | 9
gpl-3.0-or-later | version | gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version | 9
gpl-2.0 | general | gnu general public license(?: version| v)? ?2(?: 0)? | 7
gpl-3.0 | general | gnu general public license(?: version| v)? ?3(?: 0)? | 7
gpl | gnu | gnu (?:gpl|general public licen[cs]e) | 6
gpl | gpl | gpl(?: licen[cs]ed?)? | 3
gpl-or-later | gpl | gpl (?:version |v)?[123](?: 0)? or later | 7
gpl-exception | exception | as a special exception .{0,200}?(?:link|linking|combine) | 6
classpath-exception | classpath | classpath exception | 7
lgpl-2.1-or-later | lesser | gnu lesser general public license.{0,120}?version 2 1 of the license or at your option any later version | 9
lgpl-3.0-or-later | lesser | gnu lesser general public license.{0,120}?version 3 of the license or at your option any later version | 9
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e | 6
lgpl | library | gnu library general public licen[cs]e | 6
lgpl | lgpl | lgpl(?: licen[cs]ed?)? | 3
agpl | affero | (?:gnu )?affero general public licen[cs]e | 6
agpl | agpl | agpl(?: licen[cs]ed?)? | 3
gfdl | documentation | gnu free documentation licen[cs]e | 5
mpl-2.0 | mozilla | subject to the terms of the mozilla public license v 2 0 | 9
mpl | mozilla | mozilla public licen[cs]e | 5
epl | eclipse | eclipse public licen[cs]e | 5
cddl | cddl | cddl | 3
artistic | perl | same terms as perl itself | 5
artistic | artistic | artistic licen[cs]e | 5
unlicense | unencumbered | this is free and unencumbered software released into the public domain | 9
public-domain | domain | (?:released|placed|dedicated|donated) (?:in)?to the public domain | 7
public-domain | domain | (?:is|are) in the public domain | 6
public-domain | domain | public domain | 2
public-domain | gemeinfrei | gemeinfrei | 4
public-domain | gemeinfreies | gemeinfreies | 4
public-domain | domaine | domaine public | 4
public-domain | dominio | dominio público | 4
cc-by | attribution | creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e | 6
cc-by-sa | sharealike | creative commons attribution sharealike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 7
cc-by-sa | alike | creative commons attribution share alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 7
cc-by-nd | noderivatives | creative commons attribution noderivatives(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 7
cc-by-nd | derivatives | creative commons attribution no derivatives(?: [1-4] [05])?(?: licen[cs]e)? | 7
cc-by-nc | noncommercial | creative commons attribution noncommercial(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 7
cc-by-nc | commercial | creative commons attribution non commercial(?: [1-4] [05])?(?: licen[cs]e)? | 7
cc-by-nc-sa | sharealike | creative commons attribution noncommercial sharealike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 8
cc-by-nc-nd | noderivatives | creative commons attribution noncommercial noderivatives(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)? | 8
cc-by-nc | cc | (?:licen[cs]ed|released|available) under (?:a |the )?cc by nc(?: [1-4] 0)? | 7
cc-by-sa | cc | (?:licen[cs]ed|released|available) under (?:a |the )?cc by sa(?: [1-4] 0)? | 7
cc-by-nd | cc | (?:licen[cs]ed|released|available) under (?:a |the )?cc by nd(?: [1-4] 0)? | 7
cc | creative | creative commons(?: licen[cs]ed?)? | 3
cc | creativecommons | creativecommons org | 3
ofl | ofl | (?:sil )?ofl | 3
copyleft | copyleft | copyleft | 2
dual | dual | dual licen[cs]ed | 4
commercial | commercial | commercial licen[cs]e(?: agreement)? | 4
noncommercial | commercial | (?:for |only )non ?commercial (?:use|purposes)(?: only)? | 5
noncommercial | noncommercial | noncommercial use(?: only)? | 4
no-derivatives | derivative | no derivative works | 4
proprietary | proprietary | proprietary(?: and)? confidential(?: information)? | 5
proprietary | proprietary | (?:this|the) software is proprietary | 5
proprietary | prohibited | unauthori[sz]ed (?:use )?(?:copying|reproduction)(?: or distribution)? .{0,60}?prohibited | 6
proprietary | permission | may not be (?:reproduced|copied|distributed|republished)(?: .{1,80}?)? without .{0,40}?permission | 6
reserved | reserved | (?:all )?rights reserved(?: worldwide)? | 4
reserved | rechte | alle rechte vorbehalten | 5
reserved | droits | tous droits réservés | 5
reserved | derechos | todos los derechos reservados | 5
some-reserved | reserved | some rights reserved | 5
eula | eula | (?:end user licen[cs]e agreement )?eula | 3
eula | user | end user licen[cs]e agreement | 5
terms | terms | subject to (?:the|our) terms (?:of (?:use|service)|and conditions) | 3
copyright | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})? | 2
copyright | copyright | copyright (?:c )?(?:by )?[^ ]+ | 1
warranty | warranty | without warranty of any kind express or implied|without any warranty | 2
warranty | warranties | without warranties or conditions of any kind | 2
spdx | spdx | spdx license identifier [^ ]+ | 2
license-notice | license | (?:licensed|released|distributed) under (?:the )?(?:terms of )?[^ ]+(?: [^ ]+){0,4}? license | 2
license-notice | licence | (?:licensed|released|distributed) under (?:the )?(?:terms of )?[^ ]+(?: [^ ]+){0,4}? licence | 2
license-file | license | see (?:the )?(?:accompanying )?license(?: txt| md)?(?: file)?(?: for details)? | 2
license-file | copying | see (?:the )?(?:file )?copying(?: file)?(?: for details)? | 2
attribution | attribution | attribution (?:is )?required | 2
permission | permission | used (?:with|by) (?:kind )?permission | 2
fair-use | fair | fair use | 2
press | redistribute | (?:do not|may not) redistribute | 4
"""

#: Base phrases, whose places are counted and whose labels always stay.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    """``gate`` is a word without which the rule isn't tried; ``priority`` orders detections."""

    label: str
    gate: bytes
    pattern: re.Pattern[bytes]
    priority: int
    base: bool = False


def _rule(label: str, gate: str, expression: str, priority: int, base: bool = False) -> Rule:
    return Rule(label, gate.encode(), re.compile(b"(?<![^ ])(?:" + expression.encode() + b")(?![^ ])"), priority, base)


def _rules() -> list[Rule]:
    out = [_rule(label, phrase.split()[0], phrase, 5, True) for phrase, label in BASE.items()]
    for line in LICENSES.strip().splitlines():
        label, gate, name, tag, address = (x.strip() for x in re.split(r" \| ", line))
        out.append(_rule(label, gate, name, 7))
        out.append(_rule(label, "spdx", f"spdx license identifier (?:{tag})", 9))
        out.append(_rule(label, address.split()[0], f"(?:https? )?(?:www )?{address}", 8))
    for line in NOTICES.strip().splitlines():
        label, gate, expression, priority = (x.strip() for x in re.split(r" \| ", line))
        out.append(_rule(label, gate, expression, int(priority)))
    return out


RULES = _rules()
