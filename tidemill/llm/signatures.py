"""Signatures of licences, written by hand: passages of grants, notices and titles by which texts say what licence they are under.

Each is a regular expression over lower-cased words joined by single spaces; the word after "§" is its keyword, one of the rarer
ones, and no signature reaches further than fourteen words from it."""

from __future__ import annotations

# What texts of licences say. A passage that several licences share has the label of the family.
NOTICES = {
    "mit": ["licensed under the §mit license", "released under the §mit license", "§mit license see (?:the )?licen[cs]e file", "use of this source code is governed by an §mit style license"],
    "apache-2": [
        "licensed under the §apache license version 2 0 the license", "licensed to the §apache software foundation asf under one or more contributor license agreements",
        "you may not use this file except in §compliance with the license", "§apache org licenses license 2 0", "licensed under §apache 2(?: 0)?", "§apache 2 0 license see (?:the )?licen[cs]e file",
    ],
    "bsd": ["use of this source code is governed by a §bsd style license", "licensed under the §bsd license", "distributed under the §bsd license"],
    "gpl": [
        "this program is free software you can §redistribute it and or modify it under the terms of the gnu general public license", "is free software you can §redistribute it and or modify it under the terms of the gnu general public license",
        "you should have received a copy of the §gnu general public license along with", "this file is part of a program under the §gnu general public license", "§gnu org licenses gpl",
    ],
    "gpl-2": [
        "§gnu general public license as published by the free software foundation either version 2 of the license", "§gnu general public license version 2 as published by the free software foundation",
        "under the terms of the §gnu general public license v2", "§gnu org licenses gpl 2 0",
    ],
    "gpl-3": ["§gnu general public license as published by the free software foundation either version 3 of the license", "§gnu general public license version 3 as published by the free software foundation", "§gnu org licenses gpl 3 0"],
    "lgpl": [
        "you can §redistribute it and or modify it under the terms of the gnu lesser general public license", "you should have received a copy of the §gnu lesser general public license along with", "§gnu org licenses lgpl",
        "you should have received a copy of the §gnu library general public license along with",
    ],
    "lgpl-2": ["§gnu lesser general public license as published by the free software foundation either version 2 1 of the license", "§gnu library general public license as published by the free software foundation either version 2"],
    "lgpl-3": ["§gnu lesser general public license as published by the free software foundation either version 3 of the license"],
    "agpl-3": ["§gnu affero general public license as published by the free software foundation either version 3 of the license", "you should have received a copy of the §gnu affero general public license along with", "§gnu org licenses agpl"],
    "mpl-2": ["this source code form is subject to the terms of the §mozilla public license v 2 0", "if a copy of the §mpl was not distributed with this file", "§mozilla org mpl 2 0", "you can obtain one at https? §mozilla org mpl"],
    "mpl-1": ["the contents of this file are subject to the §mozilla public license version 1 [01]", "§mozilla org mpl mpl 1 [01]"],
    "epl": ["this program and the accompanying materials are made available under the terms of the §eclipse public license", "§eclipse org legal epl", "when the conditions for such availability set forth in the §eclipse public license"],
    "cddl": ["the contents of this file are subject to the terms of the common §development and distribution license", "when distributing covered code include this §cddl header notice in each file"],
    "cpl": ["under the terms of the common §public license v1 0", "§eclipse org legal cpl v10"],
    "artistic": ["under the same terms as §perl itself", "either the §perl artistic license or the gpl", "under the terms of the §artistic license"],
    "ruby": ["under the same terms as §ruby", "you can redistribute it and or modify it under the §ruby license"],
    "php": ["this source file is subject to version 3 0?1? of the §php license", "this product includes §php software freely available from"],
    "python": ["this software is licensed under the §psf license", "licensed to §psf under a contributor agreement"],
    "zlib": ["see copyright notice in §zlib h", "for conditions of distribution and use see copyright notice in §zlib h"],
    "libpng": ["this code is released under the §libpng license", "for conditions of distribution and use see the disclaimer and license in §png h"],
    "boost": ["distributed under the §boost software license version 1 0", "see accompanying file license 1 0 txt or copy at https? www §boost org"],
    "unlicense": ["for more information please refer to https? §unlicense org", "§unlicense org"],
    "cc0": ["§creativecommons org publicdomain zero", "to the extent possible under law .{1,60} §waived all copyright and related or neighboring rights", "this work is published from .{1,20} §cc0"],
    "cc-by": ["§creativecommons org licenses by [1-4] [05]", "this work is licensed under a §creative commons attribution [1-4] [05] (?:international|unported|generic)"],
    "cc-by-sa": ["§creativecommons org licenses by sa", "this work is licensed under a §creative commons attribution sharealike", "text is available under the §creative commons attribution sharealike license"],
    "cc-by-nd": ["§creativecommons org licenses by nd", "this work is licensed under a §creative commons attribution noderivatives"],
    "cc-by-nc": ["§creativecommons org licenses by nc [1-4] [05]", "this work is licensed under a §creative commons attribution noncommercial [1-4] [05]"],
    "cc-by-nc-sa": ["§creativecommons org licenses by nc sa", "this work is licensed under a §creative commons attribution noncommercial sharealike"],
    "cc-by-nc-nd": ["§creativecommons org licenses by nc nd", "this work is licensed under a §creative commons attribution noncommercial noderivatives"],
    "ofl": ["this font software is licensed under the §sil open font license version 1 1", "§scripts sil org ofl", "with §reserved font name"],
    "gfdl": ["under the terms of the §gnu free documentation license", "with no §invariant sections no front cover texts and no back cover texts"],
    "openssl": ["this product includes software developed by the §openssl project for use in the openssl toolkit", "this product includes §cryptographic software written by eric young"],
    "freetype": ["portions of this software are copyright .{1,30} the §freetype project", "under the terms of the §freetype project license"],
    "eupl": ["licensed under the §eupl", "licensed under the §eupl version 1 [12] only"],
    "sspl": ["under the terms of the server side public license version 1 as published by §mongodb"],
    "busl": ["use of this software is governed by the §business source license", "as of the date specified in the §business source license use of this software will be governed by"],
    "elastic": ["you may not use this file except in compliance with the §elastic license", "licensed under the §elastic license 2 0"],
    "public-domain": ["placed (?:it |this )?in(?:to)? the public §domain", "dedicate any and all copyright interest in the software to the public §domain", "released into the public §domain", "this (?:file|code|work|software) is in the public §domain", "no copyright is claimed .{1,60} public §domain"],
    "proprietary": [
        "§unauthorized copying of this file via any medium is strictly prohibited", "§proprietary and confidential", "this software is the confidential and §proprietary information of", "may not be §reproduced in any form without(?: the)?(?: prior)?(?: express)? written permission",
        "no part of this (?:publication|document|work) may be §reproduced", "§unauthorized (?:use|reproduction|distribution) is prohibited",
    ],
}
GRANTS = {
    "mit": [
        "permission is hereby granted free of charge to any person §obtaining a copy of this software and associated documentation files", "without limitation the rights to use copy modify merge publish distribute §sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or §substantial portions of the software",
        "in no event shall the authors or copyright holders be liable for any claim damages or other §liability whether in an action of contract",
    ],
    "x11": ["except as contained in this notice the name of the x §consortium shall not be used in advertising", "except as contained in this notice the name.{0,40} shall not be used in §advertising or otherwise to promote the sale"],
    "json": ["the software shall be used for good not §evil"],
    "isc": ["permission to use copy modify and or §distribute this software for any purpose with or without fee is hereby granted", "the software is provided as is and the author §disclaims all warranties with regard to this software"],
    "hpnd": ["permission to use copy modify and distribute this software and its §documentation for any purpose and without fee is hereby granted"],
    "bsd": [
        "§redistribution and use in source and binary forms with or without modification are permitted provided that", "§redistributions of source code must retain the above copyright notice", "§redistributions in binary form must reproduce the above copyright notice",
        "in no event shall .{1,60} be liable for any direct indirect §incidental special exemplary or consequential damages",
    ],
    "bsd-3": ["neither the name .{1,60} may be used to §endorse or promote products derived from this software", "nor the names of (?:its|their) contributors may be used to §endorse or promote products"],
    "bsd-4": ["all §advertising materials mentioning features or use of this software must display the following acknowledge?ment"],
    "bsd-2": ["the views and conclusions contained in the software and documentation are those of the authors and should not be §interpreted as representing official policies of the freebsd project"],
    "0bsd": ["permission to use copy modify and or distribute this software for any purpose with or without §fee is hereby granted the software is provided"],
    "apache-2": [
        "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free §irrevocable", "§derivative works shall mean any work whether in source or object form that is based on",
        "distributed on an as is basis without §warranties or conditions of any kind either express or implied", "if the work includes a §notice text file as part of its distribution",
    ],
    "apache-1": ["this product includes software developed by the §apache software foundation", "products derived from this software may not be called §apache nor may apache appear in their name"],
    "gpl": [
        "the licenses for most software are designed to take away your §freedom to share and change it", "the licenses for most software and other practical works are designed to take away your §freedom",
        "this general public license does not permit §incorporating your program into proprietary programs", "you must cause any work that you distribute or publish that in whole or in part §contains or is derived from the program",
        "distributed in the hope that it will be §useful but without any warranty", "the §gnu general public license is a free copyleft license for software and other kinds of works",
    ],
    "lgpl": ["this license the lesser general public license applies to some §specially designated software packages", "a program that contains no derivative of any portion of the library but is designed to work with the library by being §compiled or linked with it"],
    "agpl-3": ["offer all users interacting with it §remotely through a computer network", "the §gnu affero general public license is a free copyleft license for software and other kinds of works"],
    "mpl-2": ["covered software is provided under this license on an as is basis without §warranty of any kind", "each contributor hereby grants you a world wide §royalty free non exclusive license under intellectual property rights"],
    "epl": ["subject to the terms of this agreement each contributor hereby grants recipient a non exclusive worldwide §royalty free copyright license"],
    "cddl": ["conditioned upon your compliance with section 3 1 below and subject to third party §intellectual property claims the initial developer hereby grants you"],
    "artistic": ["the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some §semblance of artistic control", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed §preamble"],
    "python": ["§psf hereby grants licensee a nonexclusive royalty free world wide license", "§cnri hereby grants licensee a nonexclusive royalty free world wide license", "§beopen hereby grants the individual or organization"],
    "zlib": [
        "the origin of this software must not be §misrepresented", "altered source versions must be plainly marked as such and must not be §misrepresented as being the original software", "in no event will the authors be held §liable for any damages arising from the use of this software",
        "permission is granted to anyone to use this software for any purpose including §commercial applications",
    ],
    "boost": ["permission is hereby granted free of charge to any person or §organization obtaining a copy of the software and accompanying documentation", "unless such copies or derivative works are solely in the form of §machine executable object code"],
    "unlicense": ["this is free and §unencumbered software released into the public domain", "in jurisdictions that recognize copyright laws the author or authors of this software §dedicate any and all copyright interest"],
    "wtfpl": ["do what the §fuck you want to public license", "you just do what the §fuck you want to"],
    "beerware": ["the §beer ware license", "you can buy me a §beer in return", "if we meet some day and you think this stuff is worth it you can buy me a §beer"],
    "ncsa": ["permission is hereby granted free of charge to any person obtaining a copy of this software .{1,60} to deal with the software without §restriction .{0,80} university of illinois", "university of §illinois ncsa open source license"],
    "postgresql": ["in no event shall the university of california be liable to any party for direct indirect §special incidental or consequential damages", "the §postgresql global development group"],
    "ms-pl": ["if you use the software you accept this license if you do not accept the license do not use the software .{0,40} §microsoft", "§microsoft public license ms pl"],
    "ms-rl": ["§microsoft reciprocal license ms rl"],
    "ofl": ["the goals of the open font license ofl are to §stimulate worldwide development of collaborative font projects", "no modified version of the font software may use the §reserved font names?"],
    "odbl": ["open database license odbl is a license agreement intended to allow users to freely §share modify and use this database"],
    "w3c": ["by obtaining using and or copying this work you the §licensee agree that you have read understood and will comply", "§w3c software notice and license"],
    "unicode": ["permission is hereby granted free of charge to any person obtaining a copy of the §unicode data files"],
    "cc0": ["the laws of most jurisdictions throughout the world automatically §confer exclusive copyright and related rights", "§affirmer hereby overtly fully permanently irrevocably and unconditionally waives"],
    "commons-clause": ["the software is provided to you by the licensor under the license as defined below subject to the following §condition", "the license does not grant to you the right to §sell the software"],
    "polyform": ["any noncommercial purpose is a §permitted purpose", "the licensor grants you a copyright license for the software to do everything you might do with the software that would otherwise §infringe"],
    "rail": ["use based restrictions as referenced in paragraph 5 must be included as an §enforceable provision", "you agree not to use the §model or derivatives of the model"],
    "llama": ["§llama materials means collectively meta s proprietary", "distributed under the §llama [23] community license"],
    "elastic": ["you may not provide the software to third parties as a hosted or §managed service"],
    "sspl": ["if you make the §functionality of the program or a modified version available to third parties as a service"],
    "busl": ["the licensor hereby grants you the right to copy modify create derivative works redistribute and make non §production use of the licensed work"],
}
TITLES = {
    "0bsd": ["§0bsd", "bsd §zero clause license"], "afl": ["academic §free license", "§afl 3 0"], "osl": ["§osl 3 0", "open software license v? ?3 0 §osl"], "cpl": ["common §public license version 1 0", "§ibm public license"], "curl": ["§curl license"],
    "gfdl": ["§gnu free documentation license", "§gfdl"], "icu": ["§icu license"], "ncsa": ["§ncsa open source license"], "postgresql": ["§postgresql license"], "ms-pl": ["§ms pl"], "ms-rl": ["§ms rl"], "php": ["§php license"], "ruby": ["§ruby license"],
    "sspl": ["server side public license §sspl", "§sspl"], "busl": ["§busl 1 1", "§business source license"], "elastic": ["§elastic license(?: 2 0)?"], "commons-clause": ["commons §clause license condition"], "polyform": ["§polyform (?:noncommercial|small business|shield|strict)"],
    "rail": ["§openrail", "responsible ai license §rail", "§openrail m"], "llama": ["§llama [23] community license agreement"], "sleepycat": ["§sleepycat license"], "tcl": ["§tcl tk license"], "vim": ["§vim license"], "w3c": ["§w3c license"],
    "unicode": ["§unicode license agreement", "§unicode license v3"], "qpl": ["q public license §qpl", "§qpl 1 0"], "upl": ["universal permissive license §upl", "§upl 1 0"], "mulan": ["§mulan psl", "§mulan permissive software license"], "odc-by": ["open data §commons attribution license", "§odc by"],
    "pddl": ["public domain dedication and license §pddl", "§pddl"], "cdla": ["community data license agreement §cdla", "§cdla permissive", "§cdla sharing"], "x11": ["§x11 license"], "freetype": ["§freetype license"], "libpng": ["§libpng license"], "naist": ["§naist license"], "bsd-4": ["§bsd 4 clause", "original §bsd license"],
}
