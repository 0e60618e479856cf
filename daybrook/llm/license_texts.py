"""Written signatures of short names, SPDX ids and license texts: (label, regex over blank-separated words).

``IDS`` name a license only after words that announce one (see ``licenses.CHAIN``); ``SHORT`` and ``TEXTS`` stand alone, each
with the phrase that opens the gate for it.
"""

_LATER = "(?: only| or later)?"
_V = "(?: ?v ?| version | )?"  # gplv2, gpl v2, gpl v 2, gpl version 2, gpl 2, gpl2

# SPDX ids, with the plain words that only mean a license after an announcement
IDS = [
    ("gpl-1", f"gpl 1 0{_LATER}"), ("gpl-2", f"gpl 2 0{_LATER}"), ("gpl-3", f"gpl 3 0{_LATER}"),
    ("lgpl-2", f"lgpl 2 0{_LATER}"), ("lgpl-2.1", f"lgpl 2 1{_LATER}"), ("lgpl-3", f"lgpl 3 0{_LATER}"),
    ("agpl-1", f"agpl 1 0{_LATER}"), ("agpl-3", f"agpl 3 0{_LATER}"), ("gfdl", f"gfdl 1 [1-3](?: no invariants| invariants)?{_LATER}"),
    ("apache-1.0", "apache 1 0"), ("apache-1.1", "apache 1 1"), ("apache-2.0", "apache 2 0"), ("apache", "apache"),
    ("mit", "mit"), ("mit-0", "mit 0"), ("mit", "mit (?:cmu|modern variant|open group|feh|enna|advertising|festival)"), ("x11", "x11"), ("expat", "expat"),
    ("bsd-2-clause", "bsd 2 clause(?: patent| views| freebsd)?"), ("bsd-3-clause", "bsd 3 clause(?: clear| lbnl| attribution| modification)?"),
    ("bsd-4-clause", "bsd 4 clause(?: uc| shortened)?"), ("bsd-0-clause", "0bsd"), ("bsd-1-clause", "bsd 1 clause"), ("bsd", "bsd"),
    ("bsd-source-code", "bsd source code"), ("isc", "isc"),
    ("mpl-1.0", "mpl 1 0"), ("mpl-1.1", "mpl 1 1"), ("mpl-2.0", "mpl 2 0(?: no copyleft exception)?"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"),
    ("cddl", "cddl 1 [01]"), ("cpl", "cpl 1 0"), ("ipl", "ipl 1 0"), ("eupl", "eupl 1 [0-2]"),
    ("artistic-1.0", "artistic 1 0(?: perl| cl8)?"), ("artistic-2.0", "artistic 2 0"), ("boost", "bsl 1 0"), ("busl", "busl 1 1"),
    ("zlib", "zlib(?: acknowledgement)?"), ("libpng", "libpng(?: 2 0)?"), ("openssl", "openssl"), ("python", "(?:psf|python) 2 0(?: 1)?"),
    ("php", "php 3 01?"), ("ruby", "ruby"), ("postgresql", "postgresql"), ("ofl", "ofl 1 [01](?: no rfn| rfn)?"),
    ("odbl", "odbl 1 0"), ("odc-by", "odc by 1 0"), ("pddl", "pddl 1 0"), ("w3c", "w3c(?: 19980720| 20150513)?"), ("unlicense", "unlicense"),
    ("wtfpl", "wtfpl"), ("cc0", "cc0 1 0"), ("cc-by", "cc by [1-4] [05]"), ("cc-by-sa", "cc by sa [1-4] [05]"), ("cc-by-nc", "cc by nc [1-4] [05]"),
    ("cc-by-nd", "cc by nd [1-4] [05]"), ("cc-by-nc-sa", "cc by nc sa [1-4] [05]"), ("cc-by-nc-nd", "cc by nc nd [1-4] [05]"),
    ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("ncsa", "ncsa"), ("afl", "afl [1-3] [0-2]"), ("osl", "osl [1-3] [01]"), ("upl", "upl 1 0"),
    ("sspl", "sspl 1 0"), ("elastic", "elastic 2 0"), ("vim", "vim"), ("curl", "curl"), ("icu", "icu"), ("hpnd", "hpnd(?: sell variant)?"),
    ("json", "json"), ("beerware", "beerware"), ("ecl", "ecl [12] 0"), ("lppl", "lppl 1 (?:[0-2]|3[ac])"), ("qpl", "qpl 1 0"),
    ("sleepycat", "sleepycat"), ("tcl", "tcl"), ("unicode", "unicode (?:dfs 201[56]|3 0|tou)"), ("zpl", "zpl [12] [01]"),
    ("blueoak", "blueoak 1 0 0"), ("mulan", "mulanpsl [12] 0"), ("cecill", "cecill (?:[12] [01]|b|c)"), ("nasa", "nasa 1 3"),
    ("fsfap", "fsfap"), ("ijg", "ijg"), ("imagemagick", "imagemagick"), ("bzip2", "bzip2 1 0 [56]"), ("apsl", "apsl [12] [0-2]"),
]

# names that mean a license wherever they stand: (label, regex, phrase in every match that opens the gate)
SHORT = [
    ("gpl-1", f"gpl{_V}1(?: 0{_LATER})?", "gpl"), ("gpl-2", f"gpl{_V}2(?: 0)?{_LATER}", "gpl"), ("gpl-3", f"gpl{_V}3(?: 0)?{_LATER}", "gpl"),
    ("gpl", "gpl", "gpl"), ("lgpl-2.1", f"lgpl{_V}2 1{_LATER}", "lgpl"), ("lgpl-2", f"lgpl{_V}2(?! 1)(?: 0)?{_LATER}", "lgpl"),
    ("lgpl-3", f"lgpl{_V}3(?: 0)?{_LATER}", "lgpl"), ("lgpl", "lgpl", "lgpl"), ("agpl-3", f"agpl{_V}3(?: 0)?{_LATER}", "agpl"), ("agpl", "agpl", "agpl"),
    ("gfdl", f"gfdl(?:{_V}1 [1-3])?{_LATER}", "gfdl"), ("gfdl", "gnu fdl", "gnu fdl"),
    ("apache-2.0", "apache(?: ?v ?| version )2(?: 0)?", "apache"), ("apache-2.0", "apache 2 0", "apache 2 0"),
    ("apache-2.0", "asl(?: ?v ?| version )2(?: 0)?", "asl"), ("apache-2.0", "asl ?2 0", "asl"), ("apache", "apache licensed", "apache licensed"),
    ("mit", "mit licensed", "mit licensed"), ("mit", "mit x11", "mit x11"), ("mit", "mit expat", "mit expat"), ("x11", "x11 mit", "x11 mit"),
    ("bsd-2-clause", "bsd (?:2|two) clause", "bsd"), ("bsd-2-clause", "2 clause bsd", "2 clause bsd"), ("bsd-2-clause", "two clause bsd", "two clause bsd"),
    ("bsd-3-clause", "bsd (?:3|three) clause", "bsd"), ("bsd-3-clause", "3 clause bsd", "3 clause bsd"), ("bsd-3-clause", "three clause bsd", "three clause bsd"),
    ("bsd-4-clause", "bsd (?:4|four) clause", "bsd"), ("bsd-4-clause", "4 clause bsd", "4 clause bsd"), ("bsd-4-clause", "four clause bsd", "four clause bsd"),
    ("bsd-0-clause", "0bsd", "0bsd"), ("bsd-0-clause", "bsd (?:0|zero) clause", "bsd"), ("bsd", "bsd licensed", "bsd"), ("bsd", "bsd style", "bsd"),
    ("isc", "isc licensed", "isc licensed"), ("mpl-2.0", f"mpl{_V}2(?: 0)?", "mpl"), ("mpl-1.1", f"mpl{_V}1 1", "mpl"), ("mpl", "mpl licensed", "mpl"),
    ("epl-1.0", f"epl{_V}1 0", "epl"), ("epl-2.0", f"epl{_V}2 0", "epl"), ("cddl", "cddl", "cddl"), ("eupl", f"eupl(?:{_V}1 [0-2])?", "eupl"),
    ("wtfpl", "wtfpl", "wtfpl"), ("odbl", "odbl", "odbl"), ("pddl", "pddl", "pddl"), ("ofl", f"ofl{_V}1 [01]", "ofl"),
    ("sspl", f"sspl(?:{_V}1(?: 0)?)?", "sspl"), ("busl", f"busl(?:{_V}1 1)?", "busl"), ("ms-pl", "ms pl", "ms pl"), ("ms-rl", "ms rl", "ms rl"),
    ("beerware", "beerware", "beerware"), ("artistic-2.0", "artistic 2 0", "artistic"), ("lppl", f"lppl(?:{_V}1 (?:[0-2]|3[ac]))?", "lppl"),
    ("cecill", "cecill(?: (?:[12] [01]|b|c))?", "cecill"), ("mulan", "mulan psl(?: ?v?[12])?", "mulan psl"), ("mulan", "mulanpsl(?: ?v?[12])?", "mulanpsl"), ("zpl", f"zpl{_V}2 [01]", "zpl"),
]

# sentences of license texts and headers: (label, regex, phrase in every match that opens the gate)
_FREE = "this (?:program|software|library|file|package) is free software"
_MODIFY = "you can redistribute it and or modify it under the terms of the gnu"
_FSF = "as published by the free software foundation(?: either)?(?: version| v)?"
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", "copyright"),
    ("mit", "to use copy modify merge publish distribute sublicen[sc]e and or sell copies of the software", "licen"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", "copyright"),
    ("x11", "except as contained in this notice the names? of", "except as contained in this notice"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "copyright"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "copyright"),
    ("bsd", "this software is provided by the(?: \\w+){1,30} and contributors as is", "this software is provided by the"),
    ("bsd-3-clause", r"neither the names? of(?: \w+){1,20} nor the names of", "neither the name"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "all advertising materials"),
    ("bsd", "use of this source code is governed by a bsd style", "bsd"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided",
     "permission to use copy modify"),
    ("bsd-0-clause", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)",
     "permission to use copy modify"),
    ("isc", "the author disclaims all warranties with regard to this software", "the author disclaims all warranties"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose", "permission to use copy modify"),
    ("apache-2.0", "you may not use this file except in compliance with the licen[sc]e", "licen"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis",
     "licen"),
    ("apache-2.0", "http www apache org licenses licen[sc]e 2 0", "licen"),
    ("apache-2.0", "https www apache org licenses licen[sc]e 2 0", "licen"),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements", "licen"),
    ("apache-2.0", "terms and conditions for use reproduction and distribution", "terms and conditions for use"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[sc]e", "licen"),
    ("apache-1.1", "this product includes software developed by the apache software foundation", "apache software foundation"),
    ("gpl", f"{_FREE} {_MODIFY} general public licen[sc]e", "licen"),
    ("lgpl", f"{_FREE} {_MODIFY} (?:lesser|library) general public licen[sc]e", "licen"),
    ("agpl", f"{_FREE} {_MODIFY} affero general public licen[sc]e", "licen"),
    ("gpl-1", f"gnu general public licen[sc]e {_FSF} 1", "licen"), ("gpl-2", f"gnu general public licen[sc]e {_FSF} 2", "licen"),
    ("gpl-3", f"gnu general public licen[sc]e {_FSF} 3", "licen"), ("lgpl-2", f"gnu (?:lesser|library) general public licen[sc]e {_FSF} 2(?! 1)", "licen"),
    ("lgpl-2.1", f"gnu lesser general public licen[sc]e {_FSF} 2 1", "licen"), ("lgpl-3", f"gnu lesser general public licen[sc]e {_FSF} 3", "licen"),
    ("agpl-3", f"gnu affero general public licen[sc]e {_FSF} 3", "licen"),
    ("gpl-2", "under the terms of version 2 of the gnu general public licen[sc]e", "licen"),
    ("gpl-3", "under the terms of version 3 of the gnu general public licen[sc]e", "licen"),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e", "licen"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e", "licen"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[sc]e", "licen"),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it", "licen"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies", "everyone is permitted to copy"),
    ("gpl-3", "the gnu general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works", "licen"),
    ("lgpl-3", "this version of the gnu lesser general public licen[sc]e incorporates the terms and conditions of version 3", "licen"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", "licen"),
    ("fsfap", "copying and distribution of this file with or without modification are permitted in any medium without royalty", "copying"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[sc]e", "licen"),
    ("mpl-2.0", "mozilla org mpl 2 0", "mozilla org"), ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1", "licen"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", "licen"),
    ("epl-2.0", "eclipse org legal epl 2 0", "eclipse org"), ("epl-2.0", "eclipse org legal epl v20", "eclipse org"), ("epl-1.0", "eclipse org legal epl v10", "eclipse org"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e", "licen"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "this software is provided as is"),
    ("zlib", "the origin of this software must not be misrepresented", "the origin of this software"),
    ("zlib", "altered source versions must be plainly marked as such", "altered source versions"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", "permission is hereby granted"),
    ("boost", "distributed under the boost software licen[sc]e version 1 0", "licen"), ("boost", "boost org licen[sc]e 1 0", "licen"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free to copy"),
    ("wtfpl", "you just do what the fuck you want to", "do what the fuck"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "if we meet some day"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", "public domain"),
    ("cc0", "creativecommons org publicdomain zero 1 0", "creativecommons"), ("cc-by", "creativecommons org licenses by [1-4] [05]", "licen"),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]", "licen"), ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]", "licen"),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]", "licen"), ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]", "licen"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]", "licen"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "the intent of this document"),
    ("ofl", "this font software is licensed under the sil open font licen[sc]e", "licen"),
    ("ofl", "the font software may be sold as part of a larger software package", "the font software may be sold"),
    ("python", "psf is making python available to licensee on an as is basis", "licen"),
    ("openssl", "this product includes software developed by the openssl project", "openssl project"),
    ("php", "this product includes php software freely available from", "this product includes php"),
    ("ncsa", "to deal with the software without restriction including without limitation the rights to use copy modify merge", "to deal with the software"),
    ("json", "the software shall be used for good not evil", "shall be used for good"),
    ("ms-pl", "if you use the software you accept this licen[sc]e if you do not accept the licen[sc]e do not use the software", "licen"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement",
     "permission to use copy modify"),
    ("ijg", "this software is based in part on the work of the independent jpeg group", "independent jpeg group"),
    ("sspl", "server side public licen[sc]e", "licen"), ("busl", "business source licen[sc]e", "licen"), ("elastic", "elastic licen[sc]e", "licen"),
    ("proprietary", "this software is the (?:confidential and )?proprietary information of", "proprietary information"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", "copying"),
]
