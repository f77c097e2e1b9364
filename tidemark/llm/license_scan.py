"""License scans: ordered signature rules behind keyword gates.

A text is reduced to lower-case words joined by single blanks.  A document is
tested by the rules whose own keyword it holds, and every match of a rule holds
one of its keywords, so the gates lose nothing; every rule is a regular
expression over the words and has a label, a priority and a confidence.  A detection that lies inside another's interval
is suppressed unless its priority is better.  Rules are built from the names
of licences and the forms in which licences are referred to, and more are
written out for the texts and notices of licences.  All of it is column expressions on
the row's own text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import BLOCK, let, match_spans

# The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
BASE_CONFIDENCE = 0.9

#: Bytes that are not parts of words, once A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# label, keywords (any of them opens the rule), the names by which it goes, its short identifier in words
LICENSES = (
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e (?:version |v )?1 1", "apache 1 1"),
    ("apache-2", "apache", r"apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?|apache 2(?: 0)?", "apache 2 0"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", "apache"),
    ("mit", "mit|expat", r"mit(?: x11)?(?: licen[cs]e)?|expat licen[cs]e", "mit"),
    ("mit-0", "mit", r"mit no attribution", "mit 0"),
    ("bsd-2", "bsd", r"(?:2|two) clause bsd(?: licen[cs]e)?|(?:simplified|freebsd) bsd licen[cs]e|bsd 2 clause", "bsd 2 clause"),
    ("bsd-3", "bsd", r"(?:3|three) clause bsd(?: licen[cs]e)?|(?:new|modified|revised) bsd licen[cs]e|bsd 3 clause", "bsd 3 clause"),
    ("bsd-4", "bsd", r"(?:4|four) clause bsd(?: licen[cs]e)?|(?:old|original) bsd licen[cs]e|bsd 4 clause", "bsd 4 clause"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e", "bsd"),
    ("0bsd", "bsd", r"zero clause bsd(?: licen[cs]e)?", "0bsd"),
    ("gpl-2", "general public", r"gnu general public licen[cs]e (?:version |v )?2(?: 0)?", "gpl 2 0"),
    ("gpl-3", "general public", r"gnu general public licen[cs]e (?:version |v )?3(?: 0)?", "gpl 3 0"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl (?:version |v )?2(?: 0)?|gplv2", "gpl 2 0 only"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl (?:version |v )?3(?: 0)?|gplv3", "gpl 3 0 only"),
    ("gpl", "general public", r"gnu general public licen[cs]e", "gpl"),
    ("lgpl-2.1", "lesser general public", r"gnu lesser general public licen[cs]e (?:version |v )?2 1", "lgpl 2 1"),
    ("lgpl-3", "lesser general public", r"gnu lesser general public licen[cs]e (?:version |v )?3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2", "library general public", r"gnu library general public licen[cs]e(?: (?:version |v )?2(?: 0)?)?", "lgpl 2 0"),
    ("lgpl", "lesser general public", r"gnu lesser general public licen[cs]e", "lgpl"),
    ("agpl-3", "affero", r"gnu affero general public licen[cs]e(?: (?:version |v )?3(?: 0)?)?", "agpl 3 0"),
    ("agpl", "affero", r"affero general public licen[cs]e", "agpl"),
    ("gfdl-1.3", "free documentation", r"gnu free documentation licen[cs]e (?:version |v )?1 3", "gfdl 1 3"),
    ("gfdl", "free documentation", r"gnu free documentation licen[cs]e", "gfdl"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v )?1 1", "mpl 1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e (?:version |v )?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", "mpl"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e (?:version |v )?1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e (?:version |v )?2(?: 0)?", "epl 2 0"),
    ("epl", "eclipse", r"eclipse public licen[cs]e", "epl"),
    ("cddl-1", "development and distribution", r"common development and distribution licen[cs]e(?: (?:version |v )?1(?: 0)?)?", "cddl 1 0"),
    ("cpl-1", "common public", r"common public licen[cs]e(?: (?:version |v )?1(?: 0)?)?", "cpl 1 0"),
    ("eupl", "european union public", r"european union public licen[cs]e(?: (?:version |v )?1 [12])?", "eupl 1 2"),
    ("isc", "isc", r"isc licen[cs]e", "isc"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("boost-1", "boost", r"boost software licen[cs]e(?: (?:version |v )?1 0)?", "bsl 1 0"),
    ("artistic-1", "artistic", r"artistic licen[cs]e (?:version |v )?1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic", r"artistic licen[cs]e (?:version |v )?2(?: 0)?", "artistic 2 0"),
    ("unlicense", "unlicense", r"unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?: (?:version |v )?1 1)?", "ofl 1 1"),
    ("odbl", "open database", r"open database licen[cs]e", "odbl 1 0"),
    ("psf", "python software", r"python software foundation licen[cs]e", "psf 2 0"),
    ("cc0", "cc0", r"cc0(?: 1 0)?", "cc0 1 0"),
    ("cc-by", "cc by", r"cc by(?: [1-4](?: [05])?)?", "cc by 4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: [1-4](?: [05])?)?", "cc by sa 4 0"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?: [1-4](?: [05])?)?", "cc by nc 4 0"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4](?: [05])?)?", "cc by nd 4 0"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1-4](?: [05])?)?", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1-4](?: [05])?)?", "cc by nc nd 4 0"),
    ("cc-by", "creative commons attribution", r"creative commons attribution(?: [1-4](?: 0)?)?(?: international)?", "cc by 3 0"),
    ("cc-by-sa", "attribution share", r"creative commons attribution share ?alike(?: [1-4](?: 0)?)?(?: international)?", "cc by sa 3 0"),
    ("cc-by-nc", "attribution non", r"creative commons attribution non ?commercial(?: [1-4](?: 0)?)?(?: international)?", "cc by nc 3 0"),
    ("public-domain", "public domain", r"public domain", "public domain"),
)

# priority (lower wins), confidence, form
FORMS = (
    (1, 1.0, r"spdx licen[cs]e identifier {spdx}"),
    (2, 0.95, r"(?:licensed|released|distributed|published|provided|available|covered|made available) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{name})"),
    (2, 0.95, r"(?:subject to|governed by|according to|in accordance with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{name})"),
    (3, 0.9, r"under (?:the |a |an )?(?:terms of (?:the )?)?(?:{name}) licen[cs]e"),
    (3, 0.85, r"(?:see|read|use|uses|via|copy of) (?:the )?(?:{name})(?: licen[cs]e| for details)"),
    (4, 0.8, r"licen[cs]e[ds]? (?:is |are )?(?:the )?(?:{name})"),
    (5, 0.6, r"(?:the |a |an )(?:{name}) licen[cs]e[ds]?"),
)

# label, keyword, priority, confidence, regex: phrases from the texts and notices of licences
PHRASES = (
    ("mit", "permission is", 2, 0.95, r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "deal in the software", 3, 0.85, r"to deal in the software without restriction including without limitation the rights"),
    ("mit", "substantial portions", 3, 0.85, r"shall be included in all copies or substantial portions of the software"),
    ("mit", "authors or copyright", 4, 0.7, r"in no event shall the authors or copyright holders be liable for any claim"),
    ("mit", "noninfringement", 5, 0.6, r"fitness for a particular purpose and noninfringement"),
    ("x11", "promote the sale", 2, 0.85, r"to promote the sale use or other dealings in this software without prior written authorization"),
    ("isc", "permission to use", 2, 0.95, r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("isc", "the author disclaims", 3, 0.8, r"the author disclaims all warranties with regard to this software"),
    ("hpnd", "supporting documentation", 3, 0.8, r"that copyright notice and this permission notice appear in supporting documentation"),
    ("bsd", "redistributions", 2, 0.9, r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "binary form must", 2, 0.9, r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "source and binary", 3, 0.85, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "copyright holders and", 4, 0.75, r"this software is provided by the copyright holders and contributors as is"),
    ("bsd-3", "endorse", 1, 0.95, r"be used to endorse or promote products derived from this software"),
    ("bsd-3", "nor the names", 2, 0.9, r"neither the name of the copyright holder nor the names of its contributors may be used"),
    ("bsd-4", "advertising materials", 1, 0.95, r"all advertising materials mentioning features or use of this software must display"),
    ("bsd", "bsd style", 3, 0.8, r"governed by a bsd style licen[cs]e"),
    ("apache-2", "compliance", 1, 0.95, r"you may not use this file except in compliance with the license"),
    ("apache-2", "apache org", 2, 0.95, r"www apache org licenses license 2 0"),
    ("apache-2", "as is basis", 3, 0.85, r"distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2", "contributor license", 3, 0.8, r"(?:licensed to the apache software foundation asf )?under one or more contributor license agreements"),
    ("apache-2", "notice text file", 3, 0.85, r"if the work includes a notice text file as part of its distribution"),
    ("apache-2", "derivative works a copy", 3, 0.85, r"you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-1.1", "apache software foundation", 3, 0.8, r"this product includes software developed by the apache software foundation"),
    ("gpl", "free software", 2, 0.9, r"this program is free software you can redistribute it and or modify"),
    ("gpl", "without even", 3, 0.7, r"without even the implied warranty of merchantability"),
    ("gpl", "should have received", 2, 0.85, r"you should have received a copy of the gnu general public license"),
    ("gpl", "copyleft", 3, 0.75, r"is a free copyleft license for software and other kinds of works"),
    ("gpl", "share and change", 3, 0.85, r"your freedom to share and change (?:it|free software|all versions)"),
    ("gpl-2", "or at your option", 2, 0.9, r"either version 2 of the license or at your option any later version"),
    ("gpl-3", "or at your option", 2, 0.9, r"either version 3 of the license or at your option any later version"),
    ("gpl-2", "version 2 only", 2, 0.9, r"gnu general public license version 2 only"),
    ("gpl-2", "franklin", 3, 0.8, r"free software foundation inc 51 franklin street fifth floor boston"),
    ("gpl-2", "temple place", 3, 0.8, r"free software foundation inc 59 temple place"),
    ("gpl-3", "convey", 3, 0.85, r"you may convey verbatim copies of the program s source code as you receive it"),
    ("gpl-3", "anti circumvention", 3, 0.85, r"protecting users legal rights from anti circumvention law"),
    ("gpl-classpath", "classpath", 1, 0.9, r"(?:gpl )?with (?:the )?classpath exception"),
    ("gpl-classpath", "linking this library", 1, 0.9, r"linking this library statically or dynamically with other modules is making a combined work"),
    ("lgpl", "this library is free", 2, 0.9, r"this library is free software you can redistribute it and or modify"),
    ("lgpl", "gnu lesser", 2, 0.9, r"received a copy of the gnu lesser general public license"),
    ("lgpl-2.1", "or at your option", 2, 0.9, r"either version 2 1 of the license or at your option any later version"),
    ("lgpl", "work that uses the library", 2, 0.85, r"such a work in isolation is called a work that uses the library"),
    ("agpl", "affero", 2, 0.9, r"received a copy of the gnu affero general public license"),
    ("agpl-3", "remotely through", 2, 0.9, r"all users interacting with it remotely through a computer network"),
    ("gfdl", "invariant sections", 2, 0.9, r"with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "distribute and or modify this document", 2, 0.9, r"permission is granted to copy distribute and or modify this document"),
    ("mpl-2", "source code form", 1, 0.95, r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl-2", "mozilla org", 2, 0.9, r"(?:one at )?mozilla org mpl 2 0"),
    ("mpl-1.1", "contents of this file", 2, 0.9, r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", "alternatively", 3, 0.7, r"alternatively the contents of this file may be used under the terms of"),
    ("epl-1", "eclipse org", 2, 0.9, r"www eclipse org legal epl v10"),
    ("epl-2", "eclipse org", 2, 0.9, r"www eclipse org legal epl (?:v20|2 0)"),
    ("epl", "accompanying materials", 3, 0.75, r"this program and the accompanying materials are made available under the terms"),
    ("cddl-1", "cddl", 2, 0.85, r"(?:subject to the terms of|licensed under) the cddl"),
    ("cddl-1", "common development", 2, 0.9, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", 2, 0.85, r"licensed under the eupl(?: version)? 1 2"),
    ("ms-pl", "microsoft public", 2, 0.9, r"microsoft public licen[cs]e(?: ms pl)?"),
    ("ms-rl", "microsoft reciprocal", 2, 0.9, r"microsoft reciprocal licen[cs]e(?: ms rl)?"),
    ("unlicense", "unencumbered", 1, 0.95, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free", 2, 0.9, r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "unlicense org", 2, 0.9, r"(?:refer to )?unlicense org"),
    ("wtfpl", "what the", 2, 0.9, r"do what the f[a-z]* you want to public licen[cs]e"),
    ("wtfpl", "you just do", 2, 0.9, r"you just do what the f[a-z]* you want to"),
    ("zlib", "misrepresented", 2, 0.9, r"the origin of this software must not be misrepresented"),
    ("zlib", "altered source", 2, 0.9, r"altered source versions must be plainly marked as such"),
    ("zlib", "express or implied", 4, 0.6, r"this software is provided as is without any express or implied warranty"),
    ("boost-1", "machine executable", 2, 0.9, r"machine executable object code generated by a source language processor"),
    ("boost-1", "boost org", 2, 0.9, r"www boost org license 1 0"),
    ("artistic-2", "distributor fee", 3, 0.8, r"you may distribute your modified version as source either gratis or for a distributor fee"),
    ("artistic-1", "artistic control", 2, 0.85, r"maintains some semblance of artistic control over the development of the package"),
    ("perl", "terms as perl", 2, 0.85, r"under the same terms as perl(?: 5)? itself"),
    ("ruby", "ruby", 3, 0.8, r"(?:under the )?same terms as ruby"),
    ("php", "php", 2, 0.85, r"version 3 01 of the php licen[cs]e"),
    ("openssl", "openssl", 2, 0.9, r"this product includes software developed by the openssl project"),
    ("ofl-1.1", "reserved font", 2, 0.9, r"with reserved font name"),
    ("ofl-1.1", "font software", 2, 0.9, r"this font software is licensed under the sil open font license"),
    ("odbl", "open database", 2, 0.9, r"made available under the open database license"),
    ("odc-by", "open data commons", 2, 0.85, r"open data commons attribution licen[cs]e"),
    ("pddl", "open data commons", 2, 0.85, r"open data commons public domain dedication and licen[cs]e"),
    ("psf", "psf", 2, 0.85, r"psf licen[cs]e agreement for python"),
    ("cc0", "rights reserved", 2, 0.8, r"no rights reserved"),
    ("cc0", "waived", 1, 0.9, r"has waived all copyright and related or neighboring rights"),
    ("cc0", "publicdomain zero", 1, 0.95, r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org", 2, 0.95, r"creativecommons org licenses by [0-9] [0-9]"),
    ("cc-by-sa", "creativecommons org", 2, 0.95, r"creativecommons org licenses by sa [0-9] [0-9]"),
    ("cc-by-nc", "creativecommons org", 2, 0.95, r"creativecommons org licenses by nc [0-9] [0-9]"),
    ("cc-by-nd", "creativecommons org", 2, 0.95, r"creativecommons org licenses by nd [0-9] [0-9]"),
    ("cc-by-nc-sa", "creativecommons org", 2, 0.95, r"creativecommons org licenses by nc sa [0-9] [0-9]"),
    ("cc-by-nc-nd", "creativecommons org", 2, 0.95, r"creativecommons org licenses by nc nd [0-9] [0-9]"),
    ("cc", "some rights", 4, 0.6, r"some rights reserved"),
    ("public-domain", "dedicated to the public", 2, 0.9, r"(?:is )?(?:hereby )?dedicated to the public domain"),
    ("public-domain", "placed", 2, 0.85, r"placed (?:it )?in(?:to)? the public domain"),
    ("busl", "business source", 2, 0.9, r"business source licen[cs]e(?: 1 1)?"),
    ("sspl", "server side public", 2, 0.9, r"server side public licen[cs]e"),
    ("elastic-2", "elastic", 2, 0.85, r"elastic licen[cs]e (?:version |v )?2(?: 0)?"),
    ("commons-clause", "commons clause", 2, 0.85, r"commons clause licen[cs]e condition"),
    ("json", "good not evil", 1, 0.95, r"the software shall be used for good not evil"),
    ("beerware", "buy me a beer", 1, 0.95, r"you can buy me a beer in return"),
    ("non-commercial", "commercial", 3, 0.7, r"for (?:academic and )?non ?commercial use only"),
    ("non-commercial", "research purposes", 3, 0.7, r"for research purposes only"),
    ("evaluation", "evaluation purposes", 3, 0.7, r"for evaluation purposes only"),
    ("proprietary", "proprietary", 4, 0.7, r"proprietary and confidential"),
    ("proprietary", "trade secret", 4, 0.7, r"(?:contains|contain|are) (?:confidential and )?(?:valuable )?trade secrets? of"),
    ("proprietary", "unauthorized copying", 3, 0.8, r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "end user", 4, 0.7, r"end user licen[cs]e agreement"),
    ("proprietary", "reverse engineer", 4, 0.7, r"you may not reverse engineer decompile or disassemble"),
    ("all-rights-reserved", "rights reserved", 4, 0.7, r"all rights reserved"),
    ("all-rights-reserved", "may be reproduced", 4, 0.7, r"no part of this (?:publication|book|work) may be reproduced"),
    ("mit", "sublicense", 3, 0.85, r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "persons to whom", 3, 0.85, r"to permit persons to whom the software is furnished to do so"),
    ("mit", "tort or otherwise", 4, 0.7, r"whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
    ("bsd", "consequential damages", 4, 0.7, r"be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd", "substitute goods", 5, 0.6, r"procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd", "possibility of such", 5, 0.6, r"even if advised of the possibility of such damage"),
    ("bsd", "regents", 3, 0.8, r"(?:copyright|by) the regents of the university of california"),
    ("bsd-3", "without specific prior", 3, 0.8, r"products derived from this software without specific prior written permission"),
    ("bsd-4", "display the following", 2, 0.9, r"must display the following acknowledge?ment"),
    ("isc", "whatsoever", 4, 0.7, r"any damages whatsoever resulting from loss of use data or profits"),
    ("isc", "implied warranties", 4, 0.7, r"including all implied warranties of merchantability and fitness"),
    ("apache-2", "perpetual", 3, 0.8, r"a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-2", "patent litigation", 3, 0.85, r"if you institute patent litigation against any entity"),
    ("apache-2", "applicable law", 2, 0.9, r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache-2", "prominent notices", 3, 0.8, r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-2", "contribution intentionally", 3, 0.8, r"any contribution intentionally submitted for inclusion in the work by you to the licensor"),
    ("apache-2", "trade names", 3, 0.75, r"does not grant permission to use the trade names trademarks service marks or product names of the licensor"),
    ("gpl", "absolutely no", 3, 0.75, r"comes with absolutely no warranty"),
    ("gpl", "certain conditions", 3, 0.75, r"this is free software and you are welcome to redistribute it under certain conditions"),
    ("gpl", "in the hope", 3, 0.8, r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "verbatim copies", 4, 0.7, r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("gpl-2", "mere aggregation", 3, 0.8, r"mere aggregation of another work not based on the program with the program"),
    ("gpl-2", "written offer", 3, 0.75, r"accompany it with a written offer valid for at least three years"),
    ("gpl-2", "derived from the program", 3, 0.8, r"that in whole or in part contains or is derived from the program or any part thereof"),
    ("gpl-3", "corresponding source", 3, 0.8, r"the corresponding source for a work in object code form"),
    ("gpl-3", "user product", 3, 0.8, r"a user product is either 1 a consumer product"),
    ("gpl-3", "installation information", 3, 0.8, r"installation information for a user product means any methods procedures authorization keys"),
    ("gpl-3", "downstream recipients", 3, 0.8, r"automatic licensing of downstream recipients"),
    ("lgpl", "based on the library", 3, 0.85, r"a work based on the library means either the library or any derivative work"),
    ("lgpl-3", "combined work", 3, 0.85, r"you may convey a combined work under terms of your choice"),
    ("agpl-3", "must prominently offer", 2, 0.9, r"your modified version must prominently offer all users interacting with it"),
    ("gfdl", "version of the document", 3, 0.8, r"you may copy and distribute a modified version of the document under the conditions"),
    ("gfdl", "opaque copies", 3, 0.8, r"if you publish or distribute opaque copies of the document numbering more than 100"),
    ("mpl-2", "covered software", 3, 0.8, r"covered software is provided under this license on an as is basis"),
    ("mpl-2", "larger work", 3, 0.75, r"you may create and distribute a larger work under terms of your choice"),
    ("mpl-2", "secondary licenses", 2, 0.9, r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", "initial developer", 2, 0.85, r"the initial developer of the original code is"),
    ("mpl-1.1", "rights and limitations", 3, 0.8, r"for the specific language governing rights and limitations under the license"),
    ("epl", "commercial contributor", 3, 0.8, r"such contributor commercial contributor hereby agrees to defend and indemnify"),
    ("epl", "agreement steward", 3, 0.8, r"the eclipse foundation is the initial agreement steward"),
    ("cpl-1", "agreement steward", 3, 0.85, r"ibm is the initial agreement steward"),
    ("cddl-1", "cddl header", 1, 0.95, r"cddl header (?:start|end)"),
    ("eupl", "european commission", 3, 0.8, r"the european commission may publish (?:other linguistic versions|new versions) of this licen[cs]e"),
    ("ms-pl", "to reproduce its contribution", 3, 0.8, r"grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution"),
    ("zlib", "arising from the use", 3, 0.85, r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "freely subject", 3, 0.85, r"to alter it and redistribute it freely subject to the following restrictions"),
    ("libpng", "png reference library", 2, 0.9, r"the png reference library is supplied as is"),
    ("libpng", "contributing authors", 3, 0.8, r"the contributing authors and group 42 inc disclaim all warranties"),
    ("boost-1", "accompanying documentation", 2, 0.9, r"obtaining a copy of the software and accompanying documentation covered by this license"),
    ("artistic-1", "freely available", 3, 0.8, r"place your modifications in the public domain or otherwise make them freely available"),
    ("artistic-2", "standard version", 3, 0.8, r"you may distribute verbatim copies of the source form of the standard version"),
    ("ofl-1.1", "reserved font", 2, 0.9, r"no modified version of the font software may use the reserved font name"),
    ("ofl-1.1", "sold by itself", 2, 0.9, r"in original or modified versions may be sold by itself"),
    ("odbl", "derivative database", 3, 0.8, r"any derivative database that you publicly use must be only under the terms of"),
    ("psf", "psf is making", 2, 0.9, r"psf is making python available to licensee on an as is basis"),
    ("psf", "mathematisch centrum", 3, 0.75, r"stichting mathematisch centrum amsterdam"),
    ("psf", "beopen", 2, 0.85, r"beopen python open source license agreement"),
    ("cc0", "affirmer", 2, 0.9, r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", "appropriate credit", 3, 0.7, r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", "license as the original", 3, 0.8, r"distribute your contributions under the same license as the original"),
    ("cc-by-nc", "commercial advantage", 3, 0.8, r"primarily intended for or directed towards? commercial advantage or (?:private )?monetary compensation"),
    ("cc-by-nd", "share adapted material", 3, 0.75, r"you do not have permission under this public license to share adapted material"),
    ("cc", "creative commons corporation", 3, 0.6, r"creative commons corporation is not a law firm"),
    ("unlicense", "any and all copyright", 2, 0.9, r"dedicate any and all copyright interest in the software to the public domain"),
    ("unlicense", "public at large", 3, 0.85, r"we make this dedication for the benefit of the public at large"),
    ("wtfpl", "changing it is allowed", 3, 0.85, r"changing it is allowed as long as the name is changed"),
    ("beerware", "beer ware", 1, 0.95, r"the beer ware licen[cs]e(?: revision 42)?"),
    ("ncsa", "ncsa", 1, 0.95, r"university of illinois ncsa open source licen[cs]e"),
    ("afl-3", "academic free", 2, 0.9, r"academic free licen[cs]e(?: version)?(?: 3 0)?"),
    ("osl-3", "open software", 2, 0.9, r"open software licen[cs]e (?:version |v )?3 0"),
    ("cecill-2", "cecill", 2, 0.9, r"cecill(?: free software)? licen[cs]e"),
    ("cecill-2", "french law", 2, 0.85, r"governed by the cecill license under french law"),
    ("ecl-2", "educational community", 2, 0.9, r"educational community licen[cs]e(?: version 2 0)?"),
    ("qpl", "q public", 2, 0.9, r"q public licen[cs]e(?: version 1 0)?"),
    ("sleepycat", "sleepycat", 2, 0.9, r"sleepycat licen[cs]e"),
    ("vim", "vim", 2, 0.85, r"vim licen[cs]e"),
    ("tcl", "tcl tk", 2, 0.85, r"tcl tk licen[cs]e terms"),
    ("w3c", "w3c", 2, 0.9, r"w3c software (?:notice and |and document notice and )?licen[cs]e"),
    ("unicode", "unicode", 2, 0.85, r"unicode licen[cs]e (?:v3|agreement)"),
    ("icu", "icu", 2, 0.85, r"icu licen[cs]e icu 1 8 1 and later"),
    ("imagemagick", "imagemagick", 2, 0.9, r"imagemagick licen[cs]e"),
    ("freetype", "freetype", 2, 0.9, r"(?:the )?freetype (?:project )?licen[cs]e"),
    ("ijg", "independent jpeg", 2, 0.9, r"this software is based in part on the work of the independent jpeg group"),
    ("blueoak-1", "blue oak", 2, 0.95, r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("mulan-2", "mulan", 2, 0.9, r"mulan (?:psl|permissive software licen[cs]e)(?: v2)?"),
    ("polyform", "polyform", 2, 0.9, r"polyform (?:noncommercial|shield|strict|small business) licen[cs]e"),
    ("parity-7", "parity public", 2, 0.9, r"parity public licen[cs]e"),
    ("hippocratic", "hippocratic", 2, 0.9, r"hippocratic licen[cs]e"),
    ("openrail", "openrail", 2, 0.9, r"openrail(?: m| s)?(?: licen[cs]e)?"),
    ("llama", "community license agreement", 3, 0.8, r"llama [0-9](?: [0-9])? community license agreement"),
    ("etalab-2", "licence ouverte", 2, 0.9, r"licence ouverte(?: open licence)?(?: version)? 2 0"),
    ("ogl-uk-3", "open government", 2, 0.9, r"open government licen[cs]e(?: v3 0)?"),
    ("dl-de-by-2", "datenlizenz", 2, 0.9, r"datenlizenz deutschland namensnennung(?: version)? 2 0"),
    ("cdla-permissive", "community data", 2, 0.9, r"community data license agreement permissive(?: version)? (?:2|1) 0"),
    ("cdla-sharing", "community data", 2, 0.9, r"community data license agreement sharing(?: version)? 1 0"),
    ("fair", "usage of the works", 2, 0.9, r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("upl", "universal permissive", 2, 0.9, r"universal permissive licen[cs]e(?: version 1 0)?"),
    ("ogl", "open game", 2, 0.9, r"open game licen[cs]e(?: version 1 0a?)?"),
    ("proprietary", "prior written", 4, 0.7, r"without the (?:express )?prior written (?:permission|consent) of the (?:copyright owner|publisher|author)"),
    ("proprietary", "internal use", 4, 0.6, r"for internal use only"),
    ("proprietary", "licensed not sold", 4, 0.8, r"(?:this|the) software is licensed not sold"),
    ("shareware", "shareware", 4, 0.6, r"this (?:program|software) is shareware"),
    ("freeware", "freeware", 4, 0.6, r"this (?:program|software) is freeware"),
    ("personal-use", "personal use", 4, 0.6, r"for personal use only"),
    ("all-rights-reserved", "tous droits", 4, 0.7, r"tous droits réservés"),
    ("all-rights-reserved", "rechte vorbehalten", 4, 0.7, r"alle rechte vorbehalten"),
    ("all-rights-reserved", "derechos reservados", 4, 0.7, r"todos los derechos reservados"),
    ("copyright", "copyright", 6, 0.3, r"copyright (?:c )?(?:19|20)[0-9]{2}"),
)


def rules() -> list[tuple[str, str, int, float, str]]:
    """(label, keywords, priority, confidence, regex) of all rules, in their order."""
    out = [(label, "spdx" if "{spdx}" in form else keyword, rank, sure, form.format(name=name, spdx=spdx)) for rank, sure, form in FORMS for label, keyword, name, spdx in LICENSES]
    return sorted([*out, *PHRASES], key=lambda r: r[2])


#: Keywords are looked for only in texts that hold their rules' stem.
STEMS = ("software", "licen", "copy", "rights", "public", "version", "terms", "purpose", "source")


def _stem(keyword: str) -> str:
    """The first stem that every match of the keyword's rules holds, as it stands in them outside groups; empty if none."""
    regexes = [regex for _, keywords, _, _, regex in rules() if keyword in keywords.split("|")]
    plain = regexes
    while any("(?:" in r for r in plain):
        plain = [re.sub(r"\(\?:[^()]*\)\??", "|", r) for r in plain]
    return next((stem for stem in STEMS if all(stem in r for r in plain)), "")


def _whole(pattern: str) -> str:
    return rf"(?<![^ ])(?:{pattern})(?![^ ])"


def _standing(spans: Column) -> Column:
    """The distinct spans that no other one suppresses, in order; base ones (rank 0) always stand.

    A span falls if another one holds it and ranks before it, or holds it, is
    longer and ranks alike.  One sweep in the order of starts, longer ones
    first, sees every holder before what it holds, so the greatest end met
    under each rank decides.  Spans are swept in blocks, so no array grows by
    the span over more than a block.
    """
    swept = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["rank"].alias("rank"), s["label"].alias("label"), s["sure"].alias("sure")))
    item = "struct<start:int,less:int,rank:int,label:string,sure:double>"
    ends = F.array(*(F.lit(-1) for _ in range(max(r[2] for r in rules()) + 1)))
    blank = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("less"), F.lit(-1).alias("rank"), F.lit("").alias("label"), F.lit(0.0).alias("sure"))
    fresh = F.struct(ends.alias("ends"), blank.alias("last"), F.lit(True).alias("stood"), F.from_json(F.lit("[]"), f"array<{item}>").alias("out"))

    def see(state: Column, s: Column) -> Column:
        last = state["last"]
        # the same interval and rank under another label falls or stands alike
        same = (last["start"] == s["start"]) & (last["less"] == s["less"]) & (last["rank"] == s["rank"])
        stands = F.when(same, state["stood"]).otherwise((s["rank"] == 0) | (F.element_at(state["ends"], s["rank"] + 1) < -s["less"]))
        ends = F.transform(state["ends"], lambda e, r: F.when(r >= s["rank"], F.greatest(e, -s["less"])).otherwise(e))
        # repeated spans stand side by side
        keep = stands & (last != s)
        return F.struct(ends.alias("ends"), s.alias("last"), stands.alias("stood"), F.when(keep, F.concat(state["out"], F.array(s))).otherwise(state["out"]).alias("out"))

    def sweep(ordered: Column) -> Column:
        firsts = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.greatest(F.size(ordered), F.lit(1)), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
        none = F.from_json(F.lit("[]"), f"array<array<{item}>>")
        start = F.struct(fresh.alias("at"), none.alias("out"))

        def block(state: Column, first: Column) -> Column:
            begin = F.struct(state["at"]["ends"].alias("ends"), state["at"]["last"].alias("last"), state["at"]["stood"].alias("stood"), F.from_json(F.lit("[]"), f"array<{item}>").alias("out"))
            return let(F.aggregate(F.slice(ordered, first, F.lit(BLOCK)), begin, see), lambda end: F.struct(end.alias("at"), F.concat(state["out"], F.array(end["out"])).alias("out")))

        return F.aggregate(firsts, start, block, lambda s: F.flatten(s["out"]))

    kept = let(F.array_sort(swept), sweep)
    return F.array_sort(F.transform(kept, lambda s: F.struct(s["start"].alias("start"), (-s["less"]).alias("end"), s["label"].alias("label"), s["rank"].alias("rank"), s["sure"].alias("sure"))))


def scan(docs: DataFrame) -> DataFrame:
    """`docs` with n_words, n_base, first_word, last_word, base_labels, labels, score and `detections`.

    Looks at `text`; a null one is empty and has no words.  All rows are kept,
    also repeated ones; columns of these names are replaced.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), BREAKS, " "))
    out = docs.withColumn("tidemark_words", words)
    w = F.col("tidemark_words")
    blanks = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    out = out.withColumn("n_words", F.when(w == "", 0).otherwise(blanks(w) + 1).cast("long"))

    none = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,label:string,rank:int,sure:double>>")

    def found(spans: Column, label: Column, rank: Column, sure: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label.alias("label"), rank.alias("rank"), sure.alias("sure")))

    base = [F.when(F.contains(w, F.lit(p)), found(match_spans(w, _whole(p)), F.lit(label), F.lit(0), F.lit(BASE_CONFIDENCE))).otherwise(none) for p, label in BASE]
    out = out.withColumn("tidemark_base", F.concat(*base))
    groups: dict[str, list[Column]] = {}
    for label, keywords, rank, sure, regex in rules():
        for keyword in keywords.split("|"):
            groups.setdefault(keyword, []).append(F.struct(F.lit(label).alias("label"), F.lit(rank).alias("rank"), F.lit(sure).alias("sure"), F.lit(_whole(regex)).alias("regex")))
    keyed = {keyword: F.struct(F.lit(keyword).alias("keyword"), F.array(*group).alias("rules")) for keyword, group in groups.items()}
    stems: dict[str, list[Column]] = {}
    for keyword, group in keyed.items():
        stems.setdefault(_stem(keyword), []).append(group)
    table = F.array(*(F.struct(F.lit(stem).alias("stem"), F.array(*own).alias("groups")) for stem, own in stems.items()))
    near = F.flatten(F.transform(F.filter(table, lambda t: F.contains(w, t["stem"])), lambda t: t["groups"]))
    open_rules = F.flatten(F.transform(F.filter(near, lambda g: F.contains(w, g["keyword"])), lambda g: g["rules"]))
    hits = F.flatten(F.transform(open_rules, lambda r: found(match_spans(w, r["regex"]), r["label"], r["rank"], r["sure"])))
    out = out.withColumn("tidemark_hits", hits)

    out = out.withColumn("detections", _standing(F.concat(F.col("tidemark_base"), F.col("tidemark_hits"))))

    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform("tidemark_base", lambda s: s["start"])
    before = lambda start: blanks(F.substring(w, F.lit(1), start)).cast("long")
    out = out.withColumns(
        {
            "n_base": F.size("tidemark_base").cast("long"),
            "first_word": before(F.array_min(starts)),
            "last_word": before(F.array_max(starts)),
            "base_labels": names(F.col("tidemark_base")),
            "labels": names(F.col("detections")),
            "score": F.coalesce(F.array_max(F.transform("detections", lambda s: s["sure"])), F.lit(0.0)),
        }
    )
    return out.drop("tidemark_words", "tidemark_base", "tidemark_hits")
