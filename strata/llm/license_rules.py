"""Licence signatures, written by hand over normalised text.

Normalised text is the words of a text (lower case, digits, letters and all non-ASCII
characters) with single spaces between, so punctuation in names, identifiers and
addresses is a space: ``GPL-2.0+`` reads ``gpl 2 0``. Each family has a keyword that must
occur before its signatures are tried. Signatures stand in order of priority.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Signature:
    label: str
    pattern: str  # between single spaces
    weight: float
    priority: int = 0


V = r"(?: (?:version|v))?"  # an optional word before a version number
LATER = r"(?: or (?:any |at your option any )?later(?: version)?)?"
THE = r"(?:the )?"

# keyword -> (weight, label, pattern): identifiers and addresses weigh most, bare names least
FAMILIES: dict[str, list[tuple[float, str, str]]] = {
    " apache ": [
        (0.97, "apache-2.0", r"spdx license identifier apache 2 0"),
        (0.95, "apache-2.0", r"(?:www )?apache org licenses license 2 0(?: (?:txt|html))?"),
        (0.97, "apache-1.1", r"spdx license identifier apache 1 1"),
        (0.95, "apache-1.1", r"(?:www )?apache org licenses license 1 1"),
        (0.95, "apache-2.0", rf"licensed under {THE}apache license{V} 2(?: 0)?"),
        (0.9, "apache-2.0", rf"apache (?:software )?license{V} 2(?: 0)?"),
        (0.9, "apache-1.1", rf"apache (?:software )?license{V} 1 1"),
        (0.9, "apache-1.0", rf"apache (?:software )?license{V} 1 0"),
        (0.85, "apache-2.0", r"apache 2 0 license"),
        (0.8, "apache", rf"(?:licensed )?under {THE}(?:terms of the )?apache license"),
        (0.6, "apache", r"apache (?:public |software )?license"),
        (0.5, "apache", r"asl 2 0"),
    ],
    "mit licen": [
        (0.97, "mit", r"spdx license identifier mit"),
        (0.95, "mit", r"(?:www )?opensource org licenses? mit license(?: php| html)?"),
        (0.9, "mit", r"(?:licensed |released |distributed )?under (?:the )?(?:terms of the )?mit license"),
        (0.9, "mit-0", r"mit no attribution license"),
        (0.8, "mit", r"the mit license(?: mit)?"),
        (0.6, "mit", r"mit licen[sc]ed?"),
    ],
    "license identifier": [
        (0.97, "mit", r"spdx license identifier mit"),
        (0.97, "mit-0", r"spdx license identifier mit 0"),
        (0.97, "isc", r"spdx license identifier isc"),
        (0.97, "bsd-2-clause", r"spdx license identifier bsd 2 clause"),
        (0.97, "bsd-3-clause", r"spdx license identifier bsd 3 clause"),
        (0.97, "bsd-4-clause", r"spdx license identifier bsd 4 clause"),
        (0.97, "0bsd", r"spdx license identifier 0bsd"),
        (0.97, "gpl-1.0", r"spdx license identifier gpl 1 0(?: only| or later)?"),
        (0.97, "gpl-2.0", r"spdx license identifier gpl 2 0(?: only| or later)?"),
        (0.97, "gpl-3.0", r"spdx license identifier gpl 3 0(?: only| or later)?"),
        (0.97, "lgpl-2.0", r"spdx license identifier lgpl 2 0(?: only| or later)?"),
        (0.97, "lgpl-2.1", r"spdx license identifier lgpl 2 1(?: only| or later)?"),
        (0.97, "lgpl-3.0", r"spdx license identifier lgpl 3 0(?: only| or later)?"),
        (0.97, "agpl-3.0", r"spdx license identifier agpl 3 0(?: only| or later)?"),
        (0.97, "mpl-1.1", r"spdx license identifier mpl 1 1"),
        (0.97, "mpl-2.0", r"spdx license identifier mpl 2 0"),
        (0.97, "epl-1.0", r"spdx license identifier epl 1 0"),
        (0.97, "epl-2.0", r"spdx license identifier epl 2 0"),
        (0.97, "cddl-1.0", r"spdx license identifier cddl 1 0"),
        (0.97, "cddl-1.1", r"spdx license identifier cddl 1 1"),
        (0.97, "artistic-2.0", r"spdx license identifier artistic 2 0"),
        (0.97, "bsl-1.0", r"spdx license identifier bsl 1 0"),
        (0.97, "zlib", r"spdx license identifier zlib"),
        (0.97, "unlicense", r"spdx license identifier unlicense"),
        (0.97, "wtfpl", r"spdx license identifier wtfpl"),
        (0.97, "cc0-1.0", r"spdx license identifier cc0 1 0"),
        (0.97, "cc-by-4.0", r"spdx license identifier cc by 4 0"),
        (0.97, "cc-by-sa-4.0", r"spdx license identifier cc by sa 4 0"),
        (0.97, "cc-by-nc-4.0", r"spdx license identifier cc by nc 4 0"),
        (0.97, "ofl-1.1", r"spdx license identifier ofl 1 1"),
        (0.97, "eupl-1.2", r"spdx license identifier eupl 1 2"),
        (0.97, "postgresql", r"spdx license identifier postgresql"),
        (0.97, "python-2.0", r"spdx license identifier python 2 0"),
        (0.97, "ncsa", r"spdx license identifier ncsa"),
        (0.97, "ms-pl", r"spdx license identifier ms pl"),
        (0.97, "upl-1.0", r"spdx license identifier upl 1 0"),
        (0.97, "odbl-1.0", r"spdx license identifier odbl 1 0"),
    ],
    " bsd ": [
        (0.95, "bsd-2-clause", r"(?:www )?opensource org licenses? bsd 2 clause"),
        (0.95, "bsd-3-clause", r"(?:www )?opensource org licenses? bsd 3 clause"),
        (0.9, "bsd-2-clause", r"(?:2|two) clause bsd(?: license)?"),
        (0.9, "bsd-3-clause", r"(?:3|three) clause bsd(?: license)?"),
        (0.9, "bsd-4-clause", r"(?:4|four) clause bsd(?: license)?"),
        (0.9, "bsd-2-clause", r"simplified bsd license"),
        (0.9, "bsd-2-clause", r"freebsd license"),
        (0.9, "bsd-3-clause", r"(?:new|modified|revised) bsd license"),
        (0.9, "bsd-4-clause", r"original bsd license"),
        (0.85, "bsd-2-clause", r"bsd 2 clause(?: license)?"),
        (0.85, "bsd-3-clause", r"bsd 3 clause(?: license)?"),
        (0.85, "bsd-4-clause", r"bsd 4 clause(?: license)?"),
        (0.8, "bsd", r"(?:licensed |released |distributed )?under (?:the |a )?(?:terms of the )?bsd license"),
        (0.6, "bsd", r"bsd (?:style )?licen[sc]e"),
    ],
    "redistribution and use in source and binary forms": [
        (0.95, "bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ],
    "permission is hereby granted": [
        (0.95, "mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
        (0.9, "bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
        (0.85, "ofl-1.1", r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ],
    "permission to use copy modify and": [
        (0.9, "isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
        (0.85, "historical", r"permission to use copy modify and distribute this software and its documentation"),
        (0.85, "postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ],
    "general public licen": [
        (0.97, "agpl-3.0", rf"gnu affero general public license{V} 3(?: 0)?{LATER}"),
        (0.97, "lgpl-2.0", rf"gnu (?:library|lesser) general public license{V} 2(?: 0)?{LATER}"),
        (0.97, "lgpl-2.1", rf"gnu lesser general public license{V} 2 1{LATER}"),
        (0.97, "lgpl-3.0", rf"gnu lesser general public license{V} 3(?: 0)?{LATER}"),
        (0.97, "gpl-1.0", rf"gnu general public license{V} 1(?: 0)?{LATER}"),
        (0.97, "gpl-2.0", rf"gnu general public license{V} 2(?: 0)?{LATER}"),
        (0.97, "gpl-3.0", rf"gnu general public license{V} 3(?: 0)?{LATER}"),
        (0.9, "agpl", r"(?:gnu )?affero general public license"),
        (0.9, "lgpl", r"(?:gnu )?(?:lesser|library) general public license"),
        (0.9, "gpl", r"under the terms of the gnu general public license"),
        (0.85, "gpl", r"gnu general public license"),
        (0.8, "eupl", r"european union general public license"),
        (0.7, "gpl", r"(?:licensed |released )?under the general public license"),
        (0.6, "gpl", r"general public license"),
    ],
    "gpl": [
        (0.95, "gpl-2.0", r"(?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?"),
        (0.95, "gpl-3.0", r"(?:www )?gnu org licenses gpl 3 0(?: html| txt)?"),
        (0.95, "lgpl-2.1", r"(?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?"),
        (0.95, "lgpl-3.0", r"(?:www )?gnu org licenses lgpl 3 0(?: html| txt)?"),
        (0.95, "agpl-3.0", r"(?:www )?gnu org licenses agpl 3 0(?: html| txt)?"),
        (0.95, "gpl", r"(?:www )?gnu org licenses gpl(?: html| txt)?"),
        (0.85, "agpl-3.0", rf"(?:gnu )?agpl ?v?(?:ersion )?3(?: 0)?{LATER}"),
        (0.85, "lgpl-2.1", rf"(?:gnu )?lgpl ?v?(?:ersion )?2 1{LATER}"),
        (0.85, "lgpl-3.0", rf"(?:gnu )?lgpl ?v?(?:ersion )?3(?: 0)?{LATER}"),
        (0.85, "gpl-2.0", rf"(?:gnu )?gpl ?v?(?:ersion )?2(?: 0)?{LATER}"),
        (0.85, "gpl-3.0", rf"(?:gnu )?gpl ?v?(?:ersion )?3(?: 0)?{LATER}"),
        (0.7, "agpl", r"(?:gnu )?agpl licen[sc]ed?"),
        (0.7, "lgpl", r"(?:gnu )?lgpl licen[sc]ed?"),
        (0.7, "gpl", r"(?:gnu )?gpl licen[sc]ed?"),
        (0.6, "gpl", r"(?:licensed |released )under the (?:gnu )?gpl"),
        (0.6, "lgpl", r"(?:licensed |released )under the (?:gnu )?lgpl"),
        (0.5, "gpl", r"gnu gpl"),
        (0.5, "lgpl", r"gnu lgpl"),
        (0.5, "agpl", r"gnu agpl"),
    ],
    "mozilla public": [
        (0.95, "mpl-2.0", rf"mozilla public license{V} 2(?: 0)?"),
        (0.95, "mpl-1.1", rf"mozilla public license{V} 1 1"),
        (0.95, "mpl-1.0", rf"mozilla public license{V} 1 0"),
        (0.9, "mpl-2.0", r"subject to the terms of the mozilla public license v 2 0"),
        (0.8, "mpl", r"mozilla public license"),
    ],
    " mpl ": [
        (0.95, "mpl-2.0", r"(?:www )?mozilla org mpl 2 0"),
        (0.85, "mpl-2.0", r"mpl 2(?: 0)?"),
        (0.85, "mpl-1.1", r"mpl 1 1"),
        (0.6, "mpl", r"mpl licen[sc]ed?"),
    ],
    "eclipse ": [
        (0.95, "epl-2.0", rf"eclipse public license{V} 2(?: 0)?"),
        (0.95, "epl-1.0", rf"eclipse public license{V} 1(?: 0)?"),
        (0.95, "epl-1.0", r"(?:www )?eclipse org legal epl v10(?: html)?"),
        (0.95, "epl-2.0", r"(?:www )?eclipse org legal epl 2 0(?: html)?"),
        (0.9, "edl-1.0", rf"eclipse distribution license{V} 1(?: 0)?"),
        (0.8, "epl", r"eclipse public license"),
    ],
    "common development and distribution": [
        (0.95, "cddl-1.0", rf"common development and distribution license(?: cddl)?{V} 1 0"),
        (0.95, "cddl-1.1", rf"common development and distribution license(?: cddl)?{V} 1 1"),
        (0.85, "cddl", r"common development and distribution license"),
    ],
    "common public": [
        (0.95, "cpl-1.0", rf"common public license{V} 1 0"),
        (0.95, "cpal-1.0", rf"common public attribution license{V} 1 0"),
        (0.8, "cpl", r"common public license"),
        (0.8, "cpal", r"common public attribution license"),
    ],
    " cc": [
        (0.95, "cc-by-4.0", r"cc by 4 0"),
        (0.95, "cc-by-3.0", r"cc by 3 0"),
        (0.95, "cc-by-2.0", r"cc by 2 0"),
        (0.95, "cc-by-sa-4.0", r"cc by sa 4 0"),
        (0.95, "cc-by-sa-3.0", r"cc by sa 3 0"),
        (0.95, "cc-by-nc-4.0", r"cc by nc 4 0"),
        (0.95, "cc-by-nc-3.0", r"cc by nc 3 0"),
        (0.95, "cc-by-nd-4.0", r"cc by nd 4 0"),
        (0.95, "cc-by-nc-sa-4.0", r"cc by nc sa 4 0"),
        (0.95, "cc-by-nc-sa-3.0", r"cc by nc sa 3 0"),
        (0.95, "cc-by-nc-nd-4.0", r"cc by nc nd 4 0"),
        (0.95, "cc-by-nc-nd-3.0", r"cc by nc nd 3 0"),
        (0.9, "cc0-1.0", r"cc0(?: 1 0)?(?: universal)?"),
        (0.85, "cc-by-nc-nd", r"cc by nc nd"),
        (0.85, "cc-by-nc-sa", r"cc by nc sa"),
        (0.85, "cc-by-nc", r"cc by nc"),
        (0.85, "cc-by-nd", r"cc by nd"),
        (0.85, "cc-by-sa", r"cc by sa"),
        (0.85, "cc-by", r"(?:is )?licensed under cc by"),
        (0.7, "cc-by", r"cc by"),
    ],
    "creativecommons org": [
        (0.95, "cc-by-4.0", r"creativecommons org licenses by 4 0"),
        (0.95, "cc-by-3.0", r"creativecommons org licenses by 3 0"),
        (0.95, "cc-by-2.0", r"creativecommons org licenses by 2 0"),
        (0.95, "cc-by-sa-4.0", r"creativecommons org licenses by sa 4 0"),
        (0.95, "cc-by-sa-3.0", r"creativecommons org licenses by sa 3 0"),
        (0.95, "cc-by-nc-4.0", r"creativecommons org licenses by nc 4 0"),
        (0.95, "cc-by-nc-sa-4.0", r"creativecommons org licenses by nc sa 4 0"),
        (0.95, "cc-by-nc-nd-4.0", r"creativecommons org licenses by nc nd 4 0"),
        (0.95, "cc-by-nd-4.0", r"creativecommons org licenses by nd 4 0"),
        (0.95, "cc0-1.0", r"creativecommons org publicdomain zero 1 0"),
        (0.9, "public-domain", r"creativecommons org (?:licenses )?publicdomain(?: mark 1 0)?"),
        (0.7, "cc", r"creativecommons org licenses"),
    ],
    "creative commons": [
        (0.95, "cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
        (0.95, "cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike"),
        (0.95, "cc-by-nc", r"creative commons attribution non ?commercial"),
        (0.95, "cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?"),
        (0.95, "cc-by-sa-4.0", r"creative commons attribution share ?alike 4 0(?: international)?"),
        (0.95, "cc-by-sa-3.0", r"creative commons attribution share ?alike 3 0(?: unported)?"),
        (0.95, "cc-by-4.0", r"creative commons attribution 4 0(?: international)?"),
        (0.95, "cc-by-3.0", r"creative commons attribution 3 0(?: unported)?"),
        (0.9, "cc-by-sa", r"creative commons attribution share ?alike"),
        (0.9, "cc0-1.0", r"creative commons (?:zero|cc0)(?: v?1 0)?(?: universal)?"),
        (0.85, "cc-by", r"creative commons attribution(?: license)?"),
        (0.6, "cc", r"(?:a )?creative commons(?: public)? licen[sc]e"),
    ],
    "public domain": [
        (0.9, "public-domain", r"(?:released|dedicated|placed) (?:in|to|into) the public domain"),
        (0.85, "public-domain", r"this (?:work|file|software|text|document) is in the public domain"),
        (0.8, "public-domain", r"public domain dedication"),
        (0.8, "pddl-1.0", r"public domain dedication and licen[sc]e"),
        (0.5, "public-domain", r"(?:is )?in the public domain"),
    ],
    "free and unencumbered": [
        (0.95, "unlicense", r"this is free and unencumbered software released into the public domain"),
    ],
    "unlicense": [
        (0.9, "unlicense", r"(?:www )?unlicense org"),
        (0.7, "unlicense", r"the unlicense"),
    ],
    "do what the f": [(0.95, "wtfpl", r"do what the f\w+ you want to public license")],
    "wtfpl": [(0.8, "wtfpl", r"wtfpl(?: license)?")],
    "artistic licen": [
        (0.95, "artistic-2.0", rf"artistic license{V} 2 0"),
        (0.95, "artistic-1.0", rf"artistic license{V} 1 0"),
        (0.9, "perl", r"under the same terms as perl itself"),
        (0.75, "artistic", r"(?:the )?artistic license"),
    ],
    "boost software": [
        (0.95, "bsl-1.0", rf"boost software license{V} 1 0"),
        (0.85, "bsl-1.0", r"boost software license"),
    ],
    "isc licen": [(0.85, "isc", r"(?:the )?isc license")],
    "zlib": [
        (0.85, "zlib", r"zlib libpng license"),
        (0.8, "zlib", r"(?:the )?zlib license"),
    ],
    "this software is provided as is without any express": [
        (0.85, "zlib", r"this software is provided as is without any express or implied warranty in no event will the authors"),
    ],
    "python software foundation": [
        (0.9, "psf-2.0", rf"python software foundation license{V} 2(?: 0)?"),
        (0.8, "psf", r"python software foundation license"),
    ],
    "postgresql licen": [(0.85, "postgresql", r"(?:the )?postgresql license")],
    "open font": [
        (0.95, "ofl-1.1", rf"sil open font license{V} 1 1"),
        (0.85, "ofl", r"(?:sil )?open font license"),
    ],
    "open database": [
        (0.95, "odbl-1.0", rf"open database license(?: odbl)?{V} 1 0"),
        (0.85, "odbl", r"open database license"),
    ],
    "open data commons": [
        (0.9, "odc-by-1.0", r"open data commons attribution license"),
        (0.9, "odbl", r"open data commons open database license"),
        (0.85, "pddl", r"open data commons public domain dedication and license"),
    ],
    "free documentation": [
        (0.95, "gfdl-1.1", rf"gnu free documentation license{V} 1 1{LATER}"),
        (0.95, "gfdl-1.2", rf"gnu free documentation license{V} 1 2{LATER}"),
        (0.95, "gfdl-1.3", rf"gnu free documentation license{V} 1 3{LATER}"),
        (0.85, "gfdl", r"(?:gnu )?free documentation license"),
    ],
    "gfdl": [(0.6, "gfdl", r"(?:gnu )?gfdl")],
    "european union public": [
        (0.95, "eupl-1.2", rf"european union public licen[sc]e{V} 1 2"),
        (0.95, "eupl-1.1", rf"european union public licen[sc]e{V} 1 1"),
        (0.85, "eupl", r"european union public licen[sc]e"),
    ],
    "academic free": [
        (0.95, "afl-3.0", rf"academic free license{V} 3 0"),
        (0.85, "afl", r"academic free license"),
    ],
    "open software licen": [
        (0.95, "osl-3.0", rf"open software license{V} 3 0"),
        (0.85, "osl", r"open software license"),
    ],
    "microsoft ": [
        (0.9, "ms-pl", r"microsoft public license(?: ms pl)?"),
        (0.9, "ms-rl", r"microsoft reciprocal license(?: ms rl)?"),
        (0.8, "ms-eula", r"microsoft software license terms"),
    ],
    "universal permissive": [(0.9, "upl-1.0", rf"universal permissive license(?:{V} 1 0)?")],
    "server side public": [(0.95, "sspl-1.0", rf"server side public license(?:{V} 1)?")],
    "business source": [
        (0.95, "busl-1.1", rf"business source license{V} 1 1"),
        (0.85, "busl", r"business source license"),
    ],
    "elastic licen": [(0.85, "elastic-2.0", rf"elastic license(?:{V} 2(?: 0)?)?")],
    "commons clause": [(0.85, "commons-clause", r"commons clause(?: license condition)?(?: v1 0)?")],
    "open government": [
        (0.9, "ogl-uk-3.0", rf"open government licen[sc]e{V} 3 0"),
        (0.8, "ogl", r"open government licen[sc]e"),
    ],
    "university of illinois": [(0.9, "ncsa", r"university of illinois ncsa open source license")],
    "w3c software": [(0.85, "w3c", r"w3c software (?:notice and license|and document notice and license|license)")],
    "openssl licen": [(0.85, "openssl", r"openssl license")],
    "php licen": [(0.85, "php-3.01", rf"php license(?:{V} 3 01)?")],
    "beerware": [(0.8, "beerware", r"beerware license")],
    "openrail": [
        (0.9, "openrail-m", r"(?:creativeml |bigscience )?open ?rail m(?: license)?"),
        (0.7, "openrail", r"openrail license"),
    ],
    "all rights reserved": [
        (0.9, "reserved", r"(?:copyright |c )*(?:[12][0-9]{3} )?(?:by )?(?:\S+ ){0,3}all rights reserved"),
        (0.8, "reserved", r"all rights reserved"),
    ],
    "rights reserved": [
        (0.8, "some-reserved", r"some rights reserved"),
        (0.8, "no-reserved", r"no rights reserved"),
    ],
    "may not be reproduced": [
        (0.8, "reserved", r"may not be reproduced (?:or \w+ )*without (?:the )?(?:prior )?(?:written )?(?:permission|consent)"),
    ],
    "without permission": [(0.7, "reserved", r"(?:reproduction|copying|distribution|use) without permission is (?:strictly )?prohibited")],
    "proprietary and confidential": [(0.9, "proprietary", r"proprietary and confidential")],
    "confidential": [(0.6, "proprietary", r"confidential (?:and )?proprietary information")],
    "end user licen": [(0.8, "eula", r"end user licen[sc]e agreement")],
    "non commercial use only": [(0.7, "non-commercial", r"(?:for )?(?:personal |private )?non commercial use only")],
    "research purposes only": [(0.7, "research-only", r"(?:for )?(?:academic |non commercial )?research purposes only")],
    "free for commercial use": [(0.6, "free", r"free for commercial use")],
    "copyright ": [
        (0.4, "copyright", r"copyright (?:c )?[12][0-9]{3}(?: [12][0-9]{3})*"),
        (0.3, "copyright", r"copyright c"),
    ],
}

# phrases whose every place is reported whatever the rules above decide
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def signatures() -> list[tuple[str, list[Signature]]]:
    """Families in order; priority is the place by falling weight, then by order in the table."""
    flat = [(weight, keyword, label, pattern) for keyword, rules in FAMILIES.items() for weight, label, pattern in rules]
    rank = {rule: k for k, rule in enumerate(sorted(flat, key=lambda r: -r[0]))}
    return [
        (keyword, [Signature(label, pattern, weight, rank[weight, keyword, label, pattern]) for weight, label, pattern in rules])
        for keyword, rules in FAMILIES.items()
    ]
