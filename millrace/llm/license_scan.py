r"""License detection by ordered signature rules; built-in functions only.

Texts are matched as words (A-Z lower-cased, everything else in ASCII that is not a
digit taken as a gap) with one space between them. A rule is a regular expression
over words with keywords, a priority and a weight: names of licences, identifiers,
grants and addresses made of them, and wording of licences, headers and notices
written by hand. Only rules of which a keyword occurs run on a text, and every
alternative of a rule holds one of its keywords. A detection is dropped if it lies
inside one of a stronger rule, or inside a longer one of an equally strong rule. Base phrases are rules whose
detections are always kept. A text's score is the largest weight of what is kept.

Each rule names a bounded number of words, so a detection is compared only with
those that start closely before it, and the work is linear in the text.

Defined results: a null text counts as empty; without detections labels are '',
places null and the score 0; rows stand for themselves, so repeated rows and
clashing columns change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Licences as (label, keywords split by |, name in words, words of an address or '').
# Each alternative of a name holds a keyword, between the spaces that a keyword has.
LICENCES = (
    ("0bsd", " 0bsd | zero clause bsd ", r"(?:0bsd|zero clause bsd)", "opensource org licenses 0bsd"),
    ("afl-3.0", " academic free ", r"academic free(?: license)?(?: version| v)?(?: 3(?: 0)?)?", "opensource org licenses afl 3 0"),
    ("agpl-3.0", " affero general public ", r"(?:gnu )?affero general public(?: license)?(?: version| v)?(?: 3(?: 0)?)?", "gnu org licenses agpl"),
    ("apache-1.1", " apache ", r"apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", " apache | apache2 ", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache org licenses license 2 0"),
    ("artistic-1.0", " artistic ", r"artistic(?: license)?(?: version| v)? 1(?: 0)?", "opensource org licenses artistic 1 0"),
    ("artistic-2.0", " artistic ", r"artistic(?: license)?(?: version| v)? 2(?: 0)?", "opensource org licenses artistic 2 0"),
    ("beerware", " beerware ", r"beerware", ""),
    ("bsd-2-clause", " bsd | freebsd ", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", " bsd ", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", " bsd ", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "spdx org licenses bsd 4 clause"),
    ("bsl-1.0", " boost ", r"boost(?: software)?(?: license)?(?: version| v)?(?: 1 0)?", "boost org license 1 0"),
    ("busl-1.1", " business source ", r"business source(?: license)?(?: version| v)?(?: 1 1)?", "mariadb com bsl11"),
    ("cc-by", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution)(?: [1-4] [05])?", "creativecommons org licenses by"),
    ("cc-by-nc", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)(?: [1-4] [05])?", "creativecommons org licenses by nc"),
    ("cc-by-nc-nd", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s?)(?: works)?(?: [1-4] [05])?", "creativecommons org licenses by nc nd"),
    ("cc-by-nc-sa", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)(?: [1-4] [05])?", "creativecommons org licenses by nc sa"),
    ("cc-by-nd", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution) (?:nd|no ?deriv(?:ative)?s?)(?: works)?(?: [1-4] [05])?", "creativecommons org licenses by nd"),
    ("cc-by-sa", " cc | creative commons ", r"(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)(?: [1-4] [05])?", "creativecommons org licenses by sa"),
    ("cc0-1.0", " cc0 | creative commons zero ", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", "creativecommons org publicdomain zero"),
    ("cddl-1.0", " common development and distribution ", r"common development and distribution(?: license)?(?: version| v)?(?: 1 [01])?", "opensource org licenses cddl"),
    ("cecill-2.1", " cecill ", r"cecill(?: b| c)?(?: 2 1)?", "cecill info licences"),
    ("cpl-1.0", " common public ", r"common public(?: license)?(?: version| v)?(?: 1 0)?", "opensource org licenses cpl"),
    ("ecl-2.0", " educational community ", r"educational community(?: license)?(?: version| v)?(?: 2 0)?", "opensource org licenses ecl"),
    ("elastic-2.0", " elastic license ", r"elastic license(?: version| v)?(?: 2 0)?", "elastic co licensing"),
    ("epl-1.0", " eclipse public ", r"eclipse public(?: license)?(?: version| v)? 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", " eclipse public ", r"eclipse public(?: license)?(?: version| v)?(?: 2 0)?", "eclipse org legal epl 2 0"),
    ("eupl-1.2", " european union public ", r"european union public(?: licen[cs]e)?(?: version| v)?(?: 1 2)?", "joinup ec europa eu"),
    ("gfdl-1.3", " free documentation ", r"(?:gnu )?free documentation(?: license)?(?: version| v)?(?: 1 3)?", "gnu org licenses fdl"),
    ("gpl-2.0", " gpl | gplv | gpl2 | gplv2 ", r"(?:gnu )?gpl(?: version| ?v)? ?2(?: 0)?", "gnu org licenses gpl 2 0"),
    ("gpl-2.0", " general public ", r"(?:gnu )?general public(?: license)?(?: version| v)? 2(?: 0)?", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", " gpl | gplv | gpl3 | gplv3 ", r"(?:gnu )?gpl(?: version| ?v)? ?3(?: 0)?", "gnu org licenses gpl 3 0"),
    ("gpl-3.0", " general public ", r"(?:gnu )?general public(?: license)?(?: version| v)? 3(?: 0)?", "gnu org licenses gpl"),
    ("isc", " isc ", r"isc", "opensource org licenses isc"),
    ("lgpl-2.1", " lesser general public ", r"(?:gnu )?lesser general public(?: license)?(?: version| v)? 2 1", "gnu org licenses lgpl 2 1"),
    ("lgpl-3.0", " lesser general public ", r"(?:gnu )?lesser general public(?: license)?(?: version| v)?(?: 3(?: 0)?)?", "gnu org licenses lgpl"),
    ("lppl-1.3c", " latex project public ", r"latex project public(?: license)?(?: version| v)?(?: 1 3c?)?", "latex project org lppl"),
    ("mit", " mit | expat | x11 ", r"(?:mit|expat|x11)", "opensource org licenses mit"),
    ("mit-0", " mit ", r"(?:mit 0|mit no attribution)", "opensource org licenses mit 0"),
    ("mpl-1.1", " mozilla public ", r"mozilla public(?: license)?(?: version| v)? 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", " mozilla public ", r"mozilla public(?: license)?(?: version| v)?(?: 2 0)?", "mozilla org mpl 2 0"),
    ("ms-pl", " microsoft public ", r"microsoft public", "opensource org licenses ms pl"),
    ("ms-rl", " microsoft reciprocal ", r"microsoft reciprocal", "opensource org licenses ms rl"),
    ("ncsa", " ncsa ", r"(?:university of illinois )?ncsa(?: open source)?", "opensource org licenses ncsa"),
    ("odbl-1.0", " database ", r"open (?:data commons open )?database(?: license)?(?: 1 0)?", "opendatacommons org licenses odbl"),
    ("ofl-1.1", " open font ", r"(?:sil )?open font(?: license)?(?: version| v)?(?: 1 1)?", "scripts sil org ofl"),
    ("openssl", " openssl ", r"openssl", "openssl org source license"),
    ("osl-3.0", " open software ", r"open software(?: license)?(?: version| v)?(?: 3 0)?", "opensource org licenses osl 3 0"),
    ("php-3.01", " php ", r"php(?: license)?(?: version| v)?(?: 3 01?)?", "php net license"),
    ("postgresql", " postgresql ", r"postgresql", "opensource org licenses postgresql"),
    ("psf-2.0", " python software foundation ", r"python software foundation(?: license)?(?: version| v)?(?: 2)?", "docs python org license"),
    ("ruby", " ruby ", r"ruby", "ruby lang org about license"),
    ("sspl-1.0", " server side public ", r"server side public(?: license)?(?: version| v)?(?: 1)?", "mongodb com licensing server side public license"),
    ("unlicense", " unlicense ", r"(?:the )?unlicense", "unlicense org"),
    ("upl-1.0", " universal permissive ", r"universal permissive(?: license)?(?: version| v)?(?: 1 0)?", "opensource org licenses upl"),
    ("wtfpl", " wtfpl | do what the fuck you want to public ", r"(?:wtfpl|do what the fuck you want to public)", "wtfpl net"),
    ("x-proprietary", " all rights reserved ", r"all rights reserved", ""),
    ("x-public-domain", " the public domain ", r"(?:in|into|to) the public domain", ""),
    ("zlib", " zlib ", r"zlib(?: libpng)?", "zlib net zlib license"),
    ("zpl-2.1", " zope public ", r"zope public(?: license)?(?: version| v)?(?: 2 1)?", "opensource org licenses zpl"),
)
# Usual abbreviations and bare names as (label, keyword, words).
SHORT = (
    ("agpl-3.0", " agpl | agplv | agpl3 | agplv3 ", r"(?:gnu )?agpl(?: version| ?v)? ?3(?: 0)?"),
    ("bsd", " bsd ", r"bsd(?: style)? licen[cs]e"),
    ("epl-1.0", " epl | eplv | epl1 | eplv1 ", r"epl(?: version| ?v)? ?1 0"),
    ("epl-2.0", " epl | eplv | epl2 | eplv2 ", r"epl(?: version| ?v)? ?2(?: 0)?"),
    ("gpl", " gpl ", r"(?:gnu )?gpl licen[cs]e"),
    ("lgpl-2.1", " lgpl | lgplv | lgpl2 | lgplv2 ", r"(?:gnu )?lgpl(?: version| ?v)? ?2 1"),
    ("lgpl-3.0", " lgpl | lgplv | lgpl3 | lgplv3 ", r"(?:gnu )?lgpl(?: version| ?v)? ?3(?: 0)?"),
    ("mpl-1.1", " mpl | mplv | mpl1 | mplv1 ", r"mpl(?: version| ?v)? ?1 1"),
    ("mpl-2.0", " mpl | mplv | mpl2 | mplv2 ", r"mpl(?: version| ?v)? ?2(?: 0)?"),
)
# Wording of licences, their headers and notices, as (label, keyword, words); a keyword is a word of every match.
WORDING = (
    ("afl-3.0", "academic", r"licensed under the academic free license version [123](?: [0-2])?"),
    ("afl-3.0", "licensor", r"licensor hereby grants you a world ?wide royalty free non exclusive sublicensable license for the duration of the copyright"),
    ("agpl-3.0", "affero", r"under the terms of the gnu affero general public license as published by the free software foundation"),
    ("agpl-3.0", "affero", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl-3.0", "remotely", r"all users interacting with it remotely through a computer network"),
    ("agpl-3.0", "affero", r"the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    ("apache-1.1", "apache", r"products derived from this software may not be called apache"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "license", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "license", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "license", r"you may obtain a copy of the license at"),
    ("apache-2.0", "irrevocable", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("apache-2.0", "contributor", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-2.0", "contributor", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "notice", r"see the notice file distributed with this work for additional information regarding copyright ownership"),
    ("apache-2.0", "reproduction", r"terms and conditions for use reproduction and distribution"),
    ("artistic-1.0", "package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-1.0", "package", r"you may make and give away verbatim copies of the source form of the standard version of this package"),
    ("artistic-2.0", "establishes", r"this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("blessing", "blessing", r"in place of a legal notice here is a blessing"),
    ("blessing", "disclaims", r"the author disclaims copyright to this source code"),
    ("blessing", "forgiveness", r"may you find forgiveness for yourself and forgive others"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "merchantability", r"any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "exemplary", r"be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd", "procurement", r"procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd", "tort", r"whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software"),
    ("bsd", "style", r"governed by a bsd style license that can be found in the license file"),
    ("bsd-2-clause-views", "freebsd", r"should not be interpreted as representing official policies either expressed or implied of the freebsd project"),
    ("bsd-3-clause", "contributors", r"nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "written", r"without specific prior written permission of the (?:copyright holders?|authors?|university)"),
    ("bsd-3-clause-clear", "patent", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-source-code", "redistributions", r"redistributions of source code must retain the copyright notice"),
    ("bsl-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", "reproduce", r"to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software"),
    ("bsl-1.0", "executable", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("busl-1.1", "licensor", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("busl-1.1", "additional", r"additional use grant"),
    ("busl-1.1", "change", r"change license (?:changeover )?date"),
    ("cc-by", "attribution", r"creative commons attribution [1-4] [05] (?:international|unported|generic)(?: public)? license"),
    ("cc-by", "attribution", r"this work is licensed under (?:a|the) creative commons attribution"),
    ("cc-by", "indicate", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "material", r"you may not use the material for commercial purposes(?: noncommercial)?"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial [1-4] [05] (?:international|unported|generic)"),
    ("cc-by-nc-nd", "noderivatives", r"creative commons attribution noncommercial noderivatives [1-4] [05] (?:international|unported|generic)"),
    ("cc-by-nc-sa", "noncommercial", r"creative commons attribution noncommercial sharealike [1-4] [05] (?:international|unported|generic)"),
    ("cc-by-nd", "noderivatives", r"creative commons attribution noderivatives [1-4] [05] (?:international|unported|generic)"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike [1-4] [05] (?:international|unported|generic)"),
    ("cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-sa", "sharealike", r"text is available under the creative commons attribution sharealike license"),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc0-1.0", "dedicated", r"to the extent possible under law the (?:author s|authors?|person who associated cc0 with this work)(?: have| has) dedicated all copyright"),
    ("cddl-1.0", "development", r"the contents of this file are subject to the terms of the common development and distribution license(?: the license)?(?: cddl)?"),
    ("cecill-2.1", "cecill", r"this software is governed by the cecill(?: b| c)? license under french law and abiding by the rules of distribution of free software"),
    ("commons-clause", "commons", r"commons clause license condition v1 0"),
    ("commons-clause", "sell", r"the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("cpl-1.0", "common", r"the accompanying program is provided under the terms of this common public license"),
    ("ecl-2.0", "educational", r"licensed under the educational community license version [12] 0"),
    ("efl-2.0", "package", r"permission is hereby granted to use copy modify and or distribute this package provided that copyright notices are retained unchanged"),
    ("elastic-2.0", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("elastic-2.0", "circumvent", r"you may not move change disable or circumvent the license key functionality in the software"),
    ("epl-1.0", "eclipse", r"the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "eclipse", r"the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0"),
    ("epl-2.0", "secondary", r"this source code may also be made available under the following secondary licenses"),
    ("eupl-1.2", "eupl", r"licensed under the eupl(?: version)? 1 2(?: or as soon they will be approved by the european commission)?"),
    ("eupl-1.2", "eupl", r"this european union public licence the eupl applies to the work"),
    ("fair", "usage", r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("gfdl-1.3", "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl-1.3", "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl", "free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "received", r"you should have received a copy of the gnu general public license along with"),
    ("gpl", "useful", r"is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu"),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-1.0", "option", r"either version 1 of the license or at your option any later version"),
    ("gpl-2.0", "option", r"either version 2 of the license or at your option any later version"),
    ("gpl-2.0", "temple", r"59 temple place(?: suite 330)? boston ma 02111 1307 usa"),
    ("gpl-2.0", "franklin", r"51 franklin st(?:reet)? fifth floor boston ma 02110 1301 usa"),
    ("gpl-2.0", "version", r"under the terms of the gnu general public license version 2(?: only)? as published by the free software foundation"),
    ("gpl-3.0", "option", r"either version 3 of the license or at your option any later version"),
    ("gpl-3.0", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", "propagate", r"to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gpl-3.0", "convey", r"to convey a work means any kind of propagation that enables other parties to make or receive copies"),
    ("hpnd", "supporting", r"provided that the above copyright notice appears? in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("hpnd", "suitability", r"makes? no representations about the suitability of this software for any purpose it is provided as is without express or implied warranty"),
    ("icu", "unicode", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("info-zip", "zip", r"for the purposes of this copyright and license info zip is defined as the following set of individuals"),
    ("isc", "distribute", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("isc", "distribute", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "disclaims", r"the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", "tortious", r"whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance"),
    ("json", "evil", r"the software shall be used for good not evil"),
    ("lgpl", "lesser|library", r"under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public license along with"),
    ("lgpl-2.0", "library", r"you should have received a copy of the gnu library general public license along with"),
    ("lgpl-2.1", "option", r"either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0", "supplemented", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions"),
    ("libpng-2.0", "png", r"the png reference library is supplied as is"),
    ("lppl-1.3c", "latex", r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("mit", "charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", r"warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit", "dealings", r"out of or in connection with the software or the use or other dealings in the software"),
    ("mit-advertising", "advertising", r"in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 [01]"),
    ("mpl-1.1", "initial", r"the initial developer of the original code is"),
    ("mpl-1.1", "alternatively", r"alternatively the contents of this file may be used under the terms of either the gnu general public license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "incompatible", r"this source code form is incompatible with secondary licenses"),
    ("ms-pl", "governs", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("ms-rl", "recipients", r"for any file you distribute that contains code from the software you must provide recipients the source code to that file"),
    ("naumen", "naumen", r"the name naumen tm must not be used to endorse or promote products derived from this software"),
    ("ncsa", "illinois", r"(?:developed by the|the names? of the) university of illinois(?: at)? urbana champaign"),
    ("ncsa", "with", r"to deal with the software without restriction including without limitation the rights to use copy modify"),
    ("ntp", "university", r"the name of the university not be used in advertising or publicity pertaining to distribution of the software"),
    ("odbl-1.0", "database", r"this (?:database|data) is made available under the open database license"),
    ("odc-by-1.0", "attribution", r"made available under the open data commons attribution license"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "reserved", r"with reserved font name"),
    ("ofl-1.1", "font|bundled", r"the font software may be sold as part of a larger software package|may be bundled redistributed and or sold with any software"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "young", r"this product includes cryptographic software written by eric young"),
    ("osl-3.0", "open", r"licensed under the open software license version [123](?: [01])?"),
    ("pddl-1.0", "dedication", r"open data commons public domain dedication and licen[cs]e"),
    ("php-3.01", "php", r"this source file is subject to version [23] 0[01]? of the php license"),
    ("php-3.01", "php", r"this product includes php software freely available from"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter|free trial|internal use) license 1 0 [01]"),
    ("postgresql", "paragraph", r"provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("psf-2.0", "python", r"this license agreement is between the python software foundation(?: psf)? and the individual or organization"),
    ("psf-2.0", "psf", r"psf is making python available to licensee on an as is basis"),
    ("python-2.0", "beopen", r"beopen python open source license agreement version 1"),
    ("ruby", "bsdl|gpl|ruby", r"you can redistribute it and or modify it under either the terms of the (?:2 clause )?(?:bsdl|gpl)|you may distribute the software in object code or binary form provided that you do at least one of the following ruby"),
    ("sleepycat", "redistributions", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("sspl-1.0", "mongodb", r"under the terms of the server side public license version 1 as published by mongodb"),
    ("sspl-1.0", "service", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("tcl", "documentation", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    ("unicode", "unicode", r"unicode license agreement data files and software"),
    ("unicode", "unicode", r"distributed under the terms of use in (?:https? )?www unicode org copyright"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "detriment", r"we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("upl-1.0", "universal", r"the universal permissive license upl version 1 0"),
    ("vim", "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("w3c", "w3c", r"w3c software (?:and document )?notice and license"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("wtfpl", "extent", r"this program is free software it comes without any warranty to the extent permitted by applicable law(?: wtfpl)?"),
    ("x-proprietary", "unauthorized|unauthorised", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("x-proprietary", "proprietary", r"proprietary and confidential|confidential and proprietary"),
    ("x-proprietary", "disclosed", r"may not be (?:copied reproduced or )?disclosed (?:to any third party )?without (?:the )?(?:express )?(?:prior )?written (?:consent|permission)"),
    ("x-proprietary", "licensee", r"licensee shall not (?:sell|sublicense|rent|lease) the software"),
    ("x-proprietary", "reverse", r"you may not reverse engineer decompile or disassemble the (?:software|product)"),
    ("x-public-domain", "domain", r"(?:has been |is hereby |are )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    ("x11", "consortium", r"the x consortium shall not be used in advertising|in no event shall the x consortium be liable"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "removed", r"this notice may not be removed or altered from any source distribution"),
    ("zpl-2.1", "zope", r"this software is subject to the provisions of the zope public license"),
    ("zpl-2.1", "servicemarks", r"the right to use servicemarks sm or trademarks tm"),
)
#: The most words that a rule's match can have.
LONGEST = 24
_GRANT = r"(?:licensed|released|distributed|published|available|provided|covered|governed) (?:under|by) (?:the )?(?:terms of )?(?:the )?"
_MARK = "\x01"
#: What detections are.
FOUND = "array<struct<start: int, back: int, priority: int, rule: int, end: int, label: string, weight: double>>"


def rules() -> list[tuple[int, str, int, float, tuple[str, ...], str]]:
    """(number, label, priority, weight, keywords, pattern), in order: base phrases, then for each licence its forms."""
    found = [(label, 0, 0.5, (f" {words} ",), words) for words, label in BASE]
    for label, words, name, address in LICENCES:
        spdx, keywords = label.replace("-", " ").replace(".", " "), tuple(words.split("|"))
        found.append((label, 1, 1.0, (f" spdx license identifier {spdx} ",), f"spdx license identifier {spdx}(?: only| or later)?"))
        found.append((label, 2, 0.95, keywords, f"{_GRANT}{name}(?: license)?"))
        if address:
            found.append((label, 2, 0.9, (f" {address} ",), f"(?:https? )?(?:www )?{address}"))
        own = label.startswith("x-")
        found.append((label, 4 if own else 3, 0.3 if own else 0.8, keywords, name if own else f"(?:the )?{name} licen[cs]e" if "licen" not in name else f"{name}(?: license)?"))
    found += [(label, 3, 0.8, tuple(keywords.split("|")), name) for label, keywords, name in SHORT]
    found += [(label, 4 if label.startswith("x-") else 2, 0.3 if label.startswith("x-") else 0.9, tuple(f" {k} " for k in keywords.split("|")), words) for label, keywords, words in WORDING]
    return [(i, label, priority, weight, keywords, f"(?<= )(?:{p})(?= )") for i, (label, priority, weight, keywords, p) in enumerate(found)]


def as_words(text: Column) -> Column:
    """The words of a text with one space before, between and after them; one space where there are none."""
    gaps = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))
    return F.when(gaps == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), F.translate(gaps, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(" ")))


def gates() -> dict[str, str]:
    """For each keyword its longest word: what a text must hold among its words for the keyword to be looked for."""
    return {k: max(k.split(), key=len) for *_, keywords, _ in rules() for k in keywords}


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(text: Column, pattern: Column) -> Column:
    """Word intervals [start, end) of the matches of a pattern: the text is split at marks around them, and spaces are counted."""
    parts = F.split(F.regexp_replace(text, pattern, F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    state = F.struct(F.lit(0).alias("k"), F.lit(-1).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("out"))

    def step(s: Column, part: Column) -> Column:
        end = s["at"] + _spaces(part)
        hit = F.array(F.struct(s["at"].alias("start"), (end + 1).alias("end")))
        return F.struct((s["k"] + 1).alias("k"), end.alias("at"), F.when(s["k"] % 2 == 1, F.concat(s["out"], hit)).otherwise(s["out"]).alias("out"))

    return F.aggregate(parts, state, step, lambda s: s["out"])


def detections(words: Column, each: Column) -> Column:
    """All detections of all rules in a text of as_words, ``each`` its words as an array, in order of start, longest and strongest first.

    Words of keywords gate rules by one look into a hash set, keywords gate them by a search; few patterns run at all.
    """
    gate = gates()
    made = [
        F.struct(
            F.lit(n).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(w).alias("weight"),
            F.array(*map(F.lit, sorted({gate[x] for x in k}))).alias("gates"), F.array(*map(F.lit, k)).alias("keywords"), F.lit(x).alias("pattern"),
        )
        for n, label, p, w, k, x in rules()
    ]
    known = F.array(*map(F.lit, sorted(set(gate.values()))))
    held = F.array_intersect(known, each)
    awake = F.transform(F.array(held), lambda h: F.filter(F.array(*made), lambda r: F.arrays_overlap(r["gates"], h)))
    able = F.filter(F.element_at(awake, 1), lambda r: F.exists(r["keywords"], lambda k: F.contains(words, k)))
    found = F.transform(able, lambda r: F.transform(_places(words, r["pattern"]), lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), r["priority"].alias("priority"), r["rule"].alias("rule"),
        d["end"].alias("end"), r["label"].alias("label"), r["weight"].alias("weight"),
    )))
    return F.when(F.arrays_overlap(each, known), F.array_sort(F.flatten(found))).otherwise(F.array().cast(FOUND))


def kept(found: Column) -> Column:
    """Detections that no stronger, or equally strong and earlier sorted, one contains; base phrases stay and suppress nothing.

    What contains a detection is sorted before it, at most LONGEST words before, where a rule starts once a word at most.
    """
    reach = F.size(F.array_distinct(F.transform(found, lambda d: d["rule"]))) * LONGEST

    def stays(d: Column, i: Column) -> Column:
        before = F.slice(found, F.greatest(F.lit(1), i + 1 - reach), F.least(i, reach))
        return (d["priority"] == 0) | ~F.exists(before, lambda e: (e["end"] >= d["end"]) & (e["priority"] <= d["priority"]) & (e["priority"] > 0))

    return F.filter(found, stays)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, n_words and ``found``: kept detections (start, end in words, label, priority, rule, weight)."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], as_words(F.col(text)).alias("words"))
    rows = rows.withColumn("each", F.split("words", " ")).withColumn("all", detections(F.col("words"), F.col("each")))
    n_words = (F.size("each") - 2).cast("long")
    named = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return rows.select(*named, n_words.alias("n_words"), kept(F.col("all")).alias("found"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(scanned: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base places and labels, all labels and the score of each row of ``scan``."""
    base = F.filter("found", lambda d: d["priority"] == 0)
    starts = F.transform(base, lambda d: d["start"])
    label = lambda d: d["label"]
    return scanned.select(
        *keep,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        _joined(F.transform(base, label)).alias("base_labels"),
        _joined(F.transform("found", label)).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )
