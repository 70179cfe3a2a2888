"""License scan by ordered signature rules.

A rule is a regular expression over the normalised text (lower-cased words joined by single
blanks) with a label, a priority and keywords.  There are two kinds, both hand-written:
``PASSAGES`` are sentences of license texts and header notices; names and identifiers of
``FAMILIES`` are found in the wordings of ``FORMS``.  A document is matched only against the
rules of which a keyword occurs among its words.  Detections are then resolved: one inside a
longer one goes whatever the priorities, of equal intervals the higher priority stays, and of
crossing ones the higher priority, then the longer, then the earlier.
"""

from __future__ import annotations

import re
from bisect import bisect
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import batch_of, text_chunks
from kestrel.llm.decontaminate import words_of

# The contract's phrases and labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Fixed values, hand-written: label, SPDX identifiers as words, names (regular expressions over
# normalised words), keywords of which one must occur.
FAMILIES = (
    ("gpl", r"gpl (?:1|2|3) 0(?: only| or later)?|gplv[123]|gpl v?[123]", r"gnu general public licen[sc]e|gnu gpl|gnu public licen[sc]e", "gnu gpl gplv1 gplv2 gplv3"),
    ("lgpl", r"lgpl (?:2 0|2 1|3 0)(?: only| or later)?|lgplv[23]", r"gnu (?:lesser|library) general public licen[sc]e|gnu lgpl|lesser gpl", "lgpl lgplv2 lgplv3 lesser library"),
    ("agpl", r"agpl (?:1|3) 0(?: only| or later)?|agplv3", r"gnu affero general public licen[sc]e|affero gpl|gnu agpl", "agpl agplv3 affero"),
    ("gfdl", r"gfdl 1 [123](?: only| or later)?", r"gnu free documentation licen[sc]e", "gfdl documentation"),
    ("apache", r"apache (?:1 0|1 1|2 0)", r"apache (?:software )?licen[sc]e|asl 2 0", "apache asl"),
    ("mit", r"mit", r"mit licen[sc]e|mit x11 licen[sc]e|expat licen[sc]e", "mit expat"),
    ("x11", r"x11", r"x11 licen[sc]e|x consortium licen[sc]e", "x11 consortium"),
    ("bsd-2-clause", r"bsd 2 clause(?: patent| views)?", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[sc]e", "bsd freebsd"),
    ("bsd-3-clause", r"bsd 3 clause(?: clear| lbnl)?", r"(?:new|modified|revised|3 clause|three clause) bsd licen[sc]e", "bsd"),
    ("bsd-4-clause", r"bsd 4 clause(?: uc)?", r"(?:original|old|4 clause|four clause) bsd licen[sc]e", "bsd"),
    ("0bsd", r"0bsd", r"zero clause bsd licen[sc]e|bsd zero clause licen[sc]e", "0bsd bsd"),
    ("isc", r"isc", r"isc licen[sc]e|internet systems consortium licen[sc]e", "isc consortium"),
    ("mpl", r"mpl (?:1 0|1 1|2 0)", r"mozilla public licen[sc]e", "mpl mozilla"),
    ("epl", r"epl (?:1|2) 0", r"eclipse public licen[sc]e", "epl eclipse"),
    ("edl", r"edl 1 0", r"eclipse distribution licen[sc]e", "edl eclipse"),
    ("cddl", r"cddl 1 [01]", r"common development and distribution licen[sc]e", "cddl distribution"),
    ("cpl", r"cpl 1 0", r"common public licen[sc]e", "cpl common"),
    ("ipl", r"ipl 1 0", r"ibm public licen[sc]e", "ipl ibm"),
    ("eupl", r"eupl 1 [012]", r"european union public licen[sc]e", "eupl european"),
    ("artistic", r"artistic (?:1|2) 0", r"artistic licen[sc]e", "artistic"),
    ("zlib", r"zlib(?: acknowledgement)?", r"zlib licen[sc]e|zlib libpng licen[sc]e", "zlib"),
    ("libpng", r"libpng(?: 2 0)?", r"libpng licen[sc]e", "libpng"),
    ("boost", r"bsl 1 0", r"boost software licen[sc]e", "bsl boost"),
    ("busl", r"busl 1 1", r"business source licen[sc]e", "busl business"),
    ("sspl", r"sspl 1 0", r"server side public licen[sc]e", "sspl server"),
    ("elastic", r"elastic 2 0", r"elastic licen[sc]e", "elastic"),
    ("unlicense", r"unlicense", r"the unlicense|unlicense licen[sc]e", "unlicense"),
    ("wtfpl", r"wtfpl", r"do what the fuck you want to public licen[sc]e|wtfpl licen[sc]e", "wtfpl fuck"),
    ("cc0", r"cc0 1 0", r"cc0 licen[sc]e|creative commons zero|cc0 public domain dedication", "cc0 zero"),
    ("cc-by", r"cc by (?:1 0|2 0|2 5|3 0|4 0)", r"cc by|creative commons attribution(?: licen[sc]e)?", "cc creative"),
    ("cc-by-sa", r"cc by sa (?:1 0|2 0|2 5|3 0|4 0)", r"cc by sa|creative commons attribution share ?alike", "cc creative"),
    ("cc-by-nd", r"cc by nd (?:1 0|2 0|2 5|3 0|4 0)", r"cc by nd|creative commons attribution no ?derivatives|creative commons attribution noderivs", "cc creative"),
    ("cc-by-nc", r"cc by nc (?:1 0|2 0|2 5|3 0|4 0)", r"cc by nc|creative commons attribution non ?commercial", "cc creative"),
    ("cc-by-nc-sa", r"cc by nc sa (?:1 0|2 0|2 5|3 0|4 0)", r"cc by nc sa|creative commons attribution non ?commercial share ?alike", "cc creative"),
    ("cc-by-nc-nd", r"cc by nc nd (?:1 0|2 0|2 5|3 0|4 0)", r"cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:atives|s)", "cc creative"),
    ("odbl", r"odbl 1 0", r"open (?:data commons open )?database licen[sc]e", "odbl database"),
    ("odc-by", r"odc by 1 0", r"open data commons attribution licen[sc]e", "odc commons"),
    ("pddl", r"pddl 1 0", r"public domain dedication and licen[sc]e", "pddl dedication"),
    ("ofl", r"ofl 1 [01]", r"sil open font licen[sc]e|open font licen[sc]e", "ofl font"),
    ("psf", r"psf 2 0|python 2 0", r"python software foundation licen[sc]e|psf licen[sc]e", "psf python"),
    ("php", r"php 3 01?", r"php licen[sc]e", "php"),
    ("ruby", r"ruby", r"ruby licen[sc]e", "ruby"),
    ("zpl", r"zpl (?:1 1|2 0|2 1)", r"zope public licen[sc]e", "zpl zope"),
    ("w3c", r"w3c(?: 19980720| 20150513)?", r"w3c (?:software notice and )?licen[sc]e", "w3c"),
    ("ncsa", r"ncsa", r"university of illinois ncsa open source licen[sc]e|ncsa licen[sc]e", "ncsa illinois"),
    ("openssl", r"openssl", r"openssl licen[sc]e|ssleay licen[sc]e", "openssl ssleay"),
    ("postgresql", r"postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("curl", r"curl", r"curl licen[sc]e", "curl"),
    ("vim", r"vim", r"vim licen[sc]e", "vim"),
    ("tcl", r"tcl", r"tcl tk licen[sc]e|tcl licen[sc]e", "tcl"),
    ("ms-pl", r"ms pl", r"microsoft public licen[sc]e", "ms microsoft"),
    ("ms-rl", r"ms rl", r"microsoft reciprocal licen[sc]e", "ms microsoft"),
    ("apsl", r"apsl (?:1 0|1 1|1 2|2 0)", r"apple public source licen[sc]e", "apsl apple"),
    ("qpl", r"qpl 1 0", r"q public licen[sc]e", "qpl q"),
    ("osl", r"osl (?:1 0|2 0|2 1|3 0)", r"open software licen[sc]e", "osl software"),
    ("afl", r"afl (?:1 1|1 2|2 0|2 1|3 0)", r"academic free licen[sc]e", "afl academic"),
    ("cecill", r"cecill (?:1 0|1 1|2 0|2 1|b|c)", r"cecill (?:free software )?licen[sc]e", "cecill"),
    ("mulanpsl", r"mulanpsl (?:1|2) 0", r"mulan permissive software licen[sc]e", "mulanpsl mulan"),
    ("upl", r"upl 1 0", r"universal permissive licen[sc]e", "upl universal"),
    ("llama", r"llama ?[234](?: [1-3])?", r"llama (?:[234](?: [1-3])? )?community licen[sc]e", "llama llama2 llama3 llama4"),
    ("openrail", r"(?:creativeml |bigscience |bigcode )?openrail(?: m| s)?", r"(?:creativeml |bigscience |bigcode )?open ?rail(?: m)? licen[sc]e", "openrail rail"),
    ("proprietary", r"licenseref proprietary", r"proprietary and confidential|all rights reserved", "proprietary rights"),
    ("public-domain", r"licenseref public domain", r"dedicated to the public domain|released into the public domain|in the public domain", "domain"),
)

# Fixed values, hand-written: how a notice words a license; {id} and {name} stand for the signature's
# parts.  Priority: a more explicit statement is higher.  Weight: how sure a lone match is.
FORMS = (
    (9, 0.99, "{id}", r"spdx license identifier (?:{id})"),
    (8, 0.97, "{name}", r"(?:distributed|released|published|licensed|licenced|provided|made available|redistributed)(?: \w+)? under (?:the )?(?:terms of )?(?:the )?(?:{name})(?: version)?(?: v?\d(?: \d)?)?"),
    (7, 0.95, "{id}", r"(?:distributed|released|published|licensed|licenced|provided|made available)(?: \w+)? under (?:the )?(?:terms of )?(?:the )?(?:{id})(?: licen[sc]e)"),
    (6, 0.9, "{name}", r"(?:{name}) (?:version |v ?)\d(?: \d)?(?: or (?:any )?later(?: version)?)?"),
    (5, 0.85, "{id}", r"licen[sc]e (?:is )?(?:the )?(?:{id})"),
    (4, 0.8, "{id}", r"(?:{id}) licen[sc]ed?"),
    (3, 0.7, "{name}", r"(?:see|read|accept|per|by|with|and|or) the (?:{name})"),
    (2, 0.6, "{name}", r"(?:{name})"),
)


# Fixed values, hand-written: label, keyword, words of a sentence of the license's text or of its usual header.
# ``~`` stands for up to twelve words (names, years).  A passage outranks every form.
PASSAGE_PRIORITY, PASSAGE_WEIGHT = 10, 0.98
PASSAGES = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this (?:software|library|program)(?: and associated documentation files?)?(?: the software)?(?: to deal in the software without restriction)?"),
    ("mit", "substantial", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", "consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("ncsa", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files? the software to deal with the software without restriction"),
    ("ncsa", "illinois", r"neither the names? of ~university of illinois ~may be used to endorse or promote products"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer in the documentation)?"),
    ("bsd", "warranties", r"this software is provided by ~as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-3-clause", "endorse", r"neither the names? of ~nor the names of (?:its|their) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-2-clause", "interpreted", r"the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"),
    ("isc", "hereby", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "hereby", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "disclaims", r"the software is provided as is and (?:the author|isc|internet systems consortium) disclaims all warranties with regard to this software"),
    ("gpl", "redistribute", r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation"),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public licen[sc]e along with this"),
    ("gpl", "merchantability", r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "freedom", r"the licenses for most software(?: and other practical works)? are designed to take away your freedom to share and change"),
    ("gpl", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "verbatim", r"you may (?:convey|copy and distribute) verbatim copies of the program s source code as you receive it"),
    ("gpl", "propagate", r"you may not propagate or modify a covered work except as expressly provided under this license"),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("lgpl", "redistribute", r"this (?:library|program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e as published by the free software foundation"),
    ("lgpl", "gnu", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e along with this"),
    ("lgpl", "specially", r"this license the (?:lesser|library) general public license applies to some specially designated software packages"),
    ("lgpl", "lesser", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl", "redistribute", r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e as published by the free software foundation"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public licen[sc]e along with this"),
    ("agpl", "remotely", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("gfdl", "textbook", r"the purpose of this license is to make a manual textbook or other functional and useful document free"),
    ("apache", "compliance", r"licensed under the apache license version 2 0 the license you may not use (?:this file|these files) except in compliance with the license"),
    ("apache", "writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", "contributor", r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable(?: except as stated in this section)? (?:copyright|patent) license"),
    ("apache", "prominent", r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache", "contributor", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "apache", r"this product includes software developed by the apache (?:group|software foundation)"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 [01]"),
    ("mpl", "contributor", r"each contributor hereby grants you a world wide royalty free non exclusive license"),
    ("epl", "eclipse", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "recipient", r"any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("cddl", "distribution", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", r"this european union public licence the eupl applies to the work"),
    ("eupl", "eupl", r"licensed under the eupl(?: version 1 [012])?(?: only| or as soon they will be approved by the european commission)"),
    ("artistic", "semblance", r"the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic", "modified", r"you are permitted to use the standard version and create and use modified versions for any purpose without restriction"),
    ("zlib", "arising", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "png", r"the png reference library is supplied as is"),
    ("boost", "organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("busl", "licensor", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("cc0", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", "affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by", "creative", r"this work is licensed under (?:a|the) creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-sa", "creative", r"this work is licensed under (?:a|the) creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nd", "remix", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-nc", "commercial", r"you may not use the material for commercial purposes"),
    ("cc-by-nc", "creative", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc-sa", "creative", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc-nd", "creative", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("odbl", "odbl", r"(?:this|the) open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    ("pddl", "dedication", r"the open data commons public domain dedication and licen[sc]e(?: pddl)?"),
    ("ofl", "font", r"this font software is licensed under the sil open font license"),
    ("ofl", "font", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("ofl", "font", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("psf", "psf", r"psf is making python available to licensee on an as is basis"),
    ("psf", "psf", r"this license agreement is between the python software foundation psf and the individual or organization licensee"),
    ("php", "php", r"this source file is subject to version (?:2 02|3 0|3 01) of the php license"),
    ("php", "php", r"products derived from this software may not be called php"),
    ("ruby", "verbatim", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("zpl", "zope", r"this software is subject to the provisions of the zope public license"),
    ("w3c", "licensee", r"by obtaining using and or copying this work you the licensee agree that you have read understood and will comply"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "cryptographic", r"this product includes cryptographic software written by eric young"),
    ("postgresql", "fee", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("curl", "holder", r"except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale"),
    ("vim", "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("tcl", "regents", r"this software is copyrighted by the regents of the university of california sun microsystems"),
    ("ms-pl", "governs", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("apsl", "apple", r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license"),
    ("osl", "authorship", r"this open software license the license applies to any original work of authorship"),
    ("afl", "authorship", r"this academic free license the license applies to any original work of authorship"),
    ("cecill", "cecill", r"this software is governed by the cecill(?: b| c)? licen[sc]e under french law and abiding by the rules of distribution of free software"),
    ("mulanpsl", "mulan", r"is licensed under mulan psl v[12] you can use this software according to the terms and conditions of the mulan psl"),
    ("upl", "hereby", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("llama", "llama", r"llama [234](?: [1-3])? is licensed under the llama [234](?: [1-3])? community license"),
    ("llama", "meta", r"you are granted a non exclusive worldwide non transferable and royalty free limited license under meta s intellectual property"),
    ("openrail", "restrictions", r"use based restrictions as referenced in paragraph 5 must be included as an enforceable provision"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution)(?: or distribution)? of (?:this|these) (?:file|files|software|document|program)(?: via any medium)? is strictly prohibited"),
    ("proprietary", "confidential", r"this (?:software|document|file) (?:is|contains) (?:the )?confidential and proprietary information of"),
    ("public-domain", "domain", r"this (?:file|work|software|code|program|document) (?:is|has been) (?:hereby )?(?:placed |released )?(?:in|into|to) the public domain"),
    ("public-domain", "disclaims", r"the author disclaims copyright to this source code"),
)


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    pattern: re.Pattern


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int
    weight: float


@lru_cache(maxsize=1)
def rules() -> tuple[list[Rule], dict[bytes, list[int]]]:
    """All rules, in order of priority, and the rules that each keyword lets through."""
    out, gate = [], {}

    def add(label: str, priority: int, weight: float, keywords: str, pattern: str):
        for k in keywords.split():
            gate.setdefault(k.encode(), []).append(len(out))
        out.append(Rule(label, priority, weight, re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")))

    for label, keyword, words in PASSAGES:
        add(label, PASSAGE_PRIORITY, PASSAGE_WEIGHT, keyword, words.replace("~", "(?:[^ ]+ ){1,12}?"))
    for priority, weight, _, form in FORMS:
        for label, spdx, name, keywords in FAMILIES:
            add(label, priority, weight, keywords, form.replace("{id}", spdx).replace("{name}", name))
    return out, gate


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections that survive where they cross: higher priority first, then longer, then earlier; what overlaps a
    survivor goes.  Survivors are kept in order of place, so a detection is compared with its neighbours only."""
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        at = bisect(kept, d.start, key=lambda k: k.start)
        if (at == 0 or kept[at - 1].end <= d.start) and (at == len(kept) or d.end <= kept[at].start):
            kept.insert(at, d)
    return kept


def detections(words: list[bytes], vocabulary: set | None = None, gated: bool = True) -> list[Detection]:
    """Resolved detections in a list of normalised words, as word positions; ``gated=False`` tries every rule."""
    every, gate = rules()
    opened = {i for k in gate.keys() & (vocabulary if vocabulary is not None else set(words)) for i in gate[k]} if gated else range(len(every))
    if not opened:
        return []
    text = b" ".join(words)
    raw = [Detection(*m.span(), r.label, r.priority, r.weight) for r in map(every.__getitem__, sorted(opened)) for m in r.pattern.finditer(text)]
    if not raw:
        return []
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [d._replace(start=bisect(starts, d.start) - 1, end=bisect(starts, d.end - 1)) for d in resolve(contained_out(raw))]


def contained_out(found: list[Detection]) -> list[Detection]:
    """Without detections inside another one: a longer interval says more (``cc by sa`` over ``cc by``),
    and of equal intervals the higher priority stays, then the first label."""
    out, reach = [], -1
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.priority, d.label)):
        if d.end > reach:
            out.append(d)
            reach = d.end
    return out


def base_places(words: list[bytes], vocabulary: set | None = None) -> list[tuple[int, str]]:
    """Start and label of every place where a base phrase stands, also inside other detections."""
    out = []
    vocabulary = vocabulary if vocabulary is not None else set(words)
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.encode().split()
        if all(p in vocabulary for p in parts):
            at = -1
            try:
                while True:
                    at = words.index(parts[0], at + 1)
                    if words[at:at + len(parts)] == parts:
                        out.append((at, label))
            except ValueError:
                pass
    return sorted(out)


def _scan(batches):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("weight", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(pa.struct([("start", pa.int32()), ("label", pa.string())]))),
                        ("found", pa.list_(span))])
    for part, texts in text_chunks(batches):
        n, base, found = [], [], []
        for text in texts:
            words = words_of(text)
            vocabulary = set(words)
            n.append(len(words))
            base.append([{"start": a, "label": x} for a, x in base_places(words, vocabulary)])
            found.append([{"start": d.start, "end": d.end, "label": d.label, "weight": d.weight} for d in detections(words, vocabulary)])
        yield batch_of(schema, [part.column(0), n, base, found])


SCAN = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("base", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("label", T.StringType())]))),
    T.StructField("found", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                                     T.StructField("label", T.StringType()), T.StructField("weight", T.DoubleType())])))])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, found``: base phrases and resolved detections of each whole text, as word positions.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null and empty
    texts have none.  One pass without a shuffle; repeated rows and null ids give rows of their
    own; an empty table gives an empty result; other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_scan, SCAN)


def digest(scanned: DataFrame) -> DataFrame:
    """The query's rows.  ``score`` is 1 minus the product of what each detection leaves open
    (its weight short of 1; a base phrase alone has the weight of a bare name)."""
    base = F.transform("base", lambda b: b["label"])
    labels = F.array_sort(F.array_union(base, F.transform("found", lambda d: d["label"])))
    left = F.aggregate("found", F.lit(1.0), lambda p, d: p * (F.lit(1.0) - d["weight"]))
    left = F.when((F.size("found") == 0) & (F.size("base") > 0), F.lit(1 - FORMS[-1][1])).otherwise(left)
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), (F.lit(1.0) - left).alias("score"))
