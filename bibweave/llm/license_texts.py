"""Sentences of license texts and notices, one rule each.

A rule is a label, a pattern over a text's words (lower-cased, single spaces, no punctuation) and the words of
which one must occur for it to match.
"""

from __future__ import annotations

GRANTS = (
    ("mit", r"to deal in the software without restriction including without limitation the rights to use", "deal"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial"),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "holders"),
    ("mit-0", r"to deal in the software without restriction .{1,200}? to permit persons to whom the software is furnished to do so the software is provided", "furnished"),
    ("mit-modern", r"permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute", "royalty"),
    ("x11", r"except as contained in this notice the name of .{1,60}? shall not be used in advertising or otherwise to promote the sale", "advertising"),
    ("isc", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("isc", r"provided that the above copyright notice and this permission notice appear in all copies", "appear"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "fee"),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted", "documentation"),
    ("hpnd", r"the name of .{1,60}? not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission", "publicity"),
    ("ntp", r"makes no representations about the suitability (?:of )?this software for any purpose it is provided as is", "suitability"),
    ("bsd-2-clause", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution"),
    ("bsd-2-clause", r"this software is provided by the (?:copyright holders|author|regents) and contributors as is and any express or implied warranties", "contributors"),
    ("bsd-2-clause-views", r"the views and conclusions contained in the software and documentation are those of the authors", "conclusions"),
    ("bsd-2-clause-patent", r"each copyright holder and contributor hereby grants .{1,80}? patent license", "patent"),
    ("bsd-3-clause", r"may be used to endorse or promote products derived from this software without specific prior written permission", "endorse"),
    ("bsd-3-clause", r"the name of the author may not be used to endorse or promote products", "endorse"),
    ("bsd-3-clause-clear", r"no express or implied licenses to any party s patent rights are granted by this license", "patent"),
    ("bsd-4-clause", r"this product includes software developed by", "developed"),
    ("bsd-source-code", r"redistributions of source code must retain the copyright notice this list of conditions", "redistributions"),
    ("apache-1.1", r"products derived from this software may not be called apache", "apache"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation", "apache"),
    ("apache-2.0", r"licensed under the apache license version 2 0 the license", "apache"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "applicable"),
    ("apache-2.0", r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", "perpetual"),
    ("apache-2.0", r"you must give any other recipients of the work or derivative works a copy of this license", "recipients"),
    ("apache-2.0", r"licensed to the apache software foundation asf under one or more contributor license agreements", "asf"),
    ("gpl-1.0", r"either version 1 or at your option any later version", "option"),
    ("gpl-2.0", r"under the terms of the gnu general public license version 2 as published by the free software foundation", "gnu"),
    ("gpl-2.0", r"under the terms of version 2 of the gnu general public license", "gnu"),
    ("gpl-2.0", r"you may copy and distribute verbatim copies of the program s source code as you receive it in any medium", "verbatim"),
    ("gpl-2.0", r"51 franklin (?:street|st) fifth floor boston ma 02110 1301", "franklin"),
    ("gpl-2.0", r"59 temple place suite 330 boston ma 02111 1307", "temple"),
    ("gpl-2.0-only", r"version 2 of the license (?:only|as published by the free software foundation with no later version)", "version"),
    ("gpl-3.0", r"under the terms of version 3 of the gnu general public license", "gnu"),
    ("gpl-3.0", r"the gnu general public license is a free copyleft license for software and other kinds of works", "copyleft"),
    ("gpl-3.0", r"you may convey verbatim copies of the program s source code as you receive it", "convey"),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", "hope"),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program", "gnu"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim"),
    ("gpl-classpath", r"linking this library statically or dynamically with other modules is making a combined work", "statically"),
    ("gpl-classpath", r"as a special exception the copyright holders of this library give you permission to link", "exception"),
    ("gpl-font", r"if you create a document which uses this font and embed this font", "embed"),
    ("gpl-gcc", r"you have permission to propagate a work of target code formed by combining the runtime library", "propagate"),
    ("gpl-autoconf", r"as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script", "configuration"),
    ("gpl-bison", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton", "bison"),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license along with", "gnu"),
    ("lgpl-2.0", r"under the terms of the gnu library general public license as published .{1,60}? version 2", "library"),
    ("lgpl-2.1", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1", "lesser"),
    ("lgpl-2.1", r"this is the first released version of the lesser gpl", "lesser"),
    ("lgpl-3.0", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 3", "lesser"),
    ("lgpl-3.0", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3", "lesser"),
    ("agpl-3.0", r"the gnu affero general public license is a free copyleft license .{1,80}? cooperation with the community in the case of network server software", "affero"),
    ("agpl-3.0", r"remote network interaction use with the gnu general public license", "remote"),
    ("agpl-1.0", r"affero general public license version 1", "affero"),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service", "functionality"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "documentation"),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", "invariant"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "mozilla"),
    ("mpl-1.1", r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights and limitations", "governing"),
    ("mpl-1.1", r"alternatively the contents of this file may be used under the terms of either the gnu general public license", "alternatively"),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at", "mpl"),
    ("mpl-2.0", r"this source code form is incompatible with secondary licenses", "incompatible"),
    ("npl-1.1", r"subject to the netscape public license", "netscape"),
    ("epl-1.0", r"which accompanies this distribution and is available at (?:http|https) www eclipse org legal epl v10", "eclipse"),
    ("epl-2.0", r"which is available at (?:http|https) www eclipse org legal epl 2 0", "eclipse"),
    ("epl-2.0", r"this source code may also be made available under the following secondary licenses", "secondary"),
    ("edl-1.0", r"eclipse distribution license v ?1 0", "eclipse"),
    ("cpl-1.0", r"the accompanying program is provided under the terms of this common public license", "accompanying"),
    ("ipl-1.0", r"the accompanying program is provided under the terms of this ibm public license", "ibm"),
    ("cddl-1.0", r"subject to the terms of the common development and distribution license", "development"),
    ("cddl-1.1", r"common development and distribution license version 1 1", "development"),
    ("cddl-1.0", r"when distributing covered code include this cddl header notice", "cddl"),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied", "intent"),
    ("artistic-2.0", r"you are always permitted to make arbitrary changes to the standard version of this package", "arbitrary"),
    ("perl", r"(?:you can redistribute it and or modify it )?under the same terms as perl itself", "perl"),
    ("zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "alter"),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", "misrepresented"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented", "altered"),
    ("libpng", r"the png reference library is supplied as is", "png"),
    ("libpng", r"the origin of this source code must not be misrepresented", "misrepresented"),
    ("bzip2", r"julian seward .{1,20}?bzip", "seward"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization"),
    ("bsl-1.0", r"distributed under the boost software license version 1 0", "boost"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "production"),
    ("busl-1.1", r"change license .{1,60}? additional use grant", "grant"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", "hosted"),
    ("commons-clause", r"the software is provided to you by the licensor under the license as defined below subject to the following condition", "licensor"),
    ("commons-clause", r"the license does not include and the license does not grant to you the right to sell the software", "sell"),
    ("polyform-noncommercial", r"polyform noncommercial license", "polyform"),
    ("polyform-small-business", r"polyform small business license", "polyform"),
    ("prosperity", r"the prosperity public license", "prosperity"),
    ("parity", r"the parity public license", "parity"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", "compile"),
    ("unlicense", r"for more information please refer to (?:http|https) unlicense org", "unlicense"),
    ("wtfpl", r"you just do what the fuck you want to", "fuck"),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", "beer"),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "deed"),
    ("cc0-1.0", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "affirmer"),
    ("cc-by", r"this work is licensed under a creative commons attribution (?:[1234] [05] )?(?:international |unported |generic )?license", "creative"),
    ("cc-by-sa", r"this work is licensed under a creative commons attribution share ?alike", "creative"),
    ("cc-by-nc", r"this work is licensed under a creative commons attribution non ?commercial", "creative"),
    ("cc-by-nd", r"this work is licensed under a creative commons attribution no ?deriv", "creative"),
    ("cc-by", r"creativecommons org licenses by [1234] [05]", "creativecommons"),
    ("cc-by-sa", r"creativecommons org licenses by sa [1234] [05]", "creativecommons"),
    ("cc-by-nc", r"creativecommons org licenses by nc [1234] [05]", "creativecommons"),
    ("cc-by-nd", r"creativecommons org licenses by nd [1234] [05]", "creativecommons"),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa [1234] [05]", "creativecommons"),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd [1234] [05]", "creativecommons"),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "creativecommons"),
    ("cc-pdm", r"creativecommons org publicdomain mark 1 0", "creativecommons"),
    ("cc", r"you are free to share copy and redistribute the material in any medium or format", "redistribute"),
    ("cc", r"you must give appropriate credit provide a link to the license and indicate if changes were made", "credit"),
    ("odbl-1.0", r"this .{1,60}? is made available under the open database license", "database"),
    ("odbl-1.0", r"any rights in individual contents of the database are licensed under the database contents license", "contents"),
    ("odc-by-1.0", r"is made available under the open data commons attribution license", "commons"),
    ("pddl-1.0", r"is made available under the public domain dedication and license", "dedication"),
    ("ogl-3.0", r"contains public sector information licensed under the open government licen[sc]e", "sector"),
    ("ogl-3.0", r"nationalarchives gov uk doc open government licence", "nationalarchives"),
    ("dl-de-by-2.0", r"datenlizenz deutschland namensnennung(?: version)? 2 0", "datenlizenz"),
    ("dl-de-zero-2.0", r"datenlizenz deutschland zero(?: version)? 2 0", "datenlizenz"),
    ("etalab-2.0", r"licence ouverte(?: open licen[sc]e)?(?: version| v)? ?2 0", "ouverte"),
    ("cdla-permissive-1.0", r"community data license agreement permissive(?: version)? 1 0", "community"),
    ("cdla-sharing-1.0", r"community data license agreement sharing(?: version)? 1 0", "community"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font"),
    ("ofl-1.1", r"the font software may be modified altered or added to", "font"),
    ("ofl-1.1", r"scripts sil org ofl", "sil"),
    ("ubuntu-font-1.0", r"ubuntu font licen[sc]e(?: version)? 1 0", "ubuntu"),
    ("bitstream-vera", r"bitstream vera is a trademark of bitstream inc", "bitstream"),
    ("lppl-1.3c", r"this work may be distributed and or modified under the conditions of the latex project public license", "latex"),
    ("lppl-1.3c", r"this work has the lppl maintenance status", "lppl"),
    ("ncsa", r"developed by .{1,120}? permission is hereby granted .{1,200}? to deal with the software without restriction", "deal"),
    ("psf-2.0", r"psf hereby grants licensee a nonexclusive royalty free world wide license", "psf"),
    ("python-cnri", r"cnri open source license agreement", "cnri"),
    ("python-beopen", r"beopen python open source license agreement", "beopen"),
    ("ruby", r"you can redistribute it and or modify it under either the terms of the 2 clause bsdl", "bsdl"),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction", "verbatim"),
    ("php-3.01", r"this source file is subject to version 3 01? of the php license", "php"),
    ("php-3.01", r"this product includes php software freely available from", "php"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "agreement"),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit", "openssl"),
    ("ssleay", r"this product includes cryptographic software written by eric young", "cryptographic"),
    ("curl", r"copyright .{1,40}? daniel stenberg .{1,60}? and many contributors", "stenberg"),
    ("icu", r"copyright .{1,20}? international business machines corporation and others all rights reserved permission is hereby granted", "machines"),
    ("unicode", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", "unicode"),
    ("unicode", r"unicode inc license agreement data files and software", "unicode"),
    ("w3c", r"by obtaining and or copying this work you the licensee agree that you have read understood and will comply", "licensee"),
    ("w3c", r"this work is being provided by the copyright holders under the following license", "provided"),
    ("ijg", r"this software is based in part on the work of the independent jpeg group", "jpeg"),
    ("libtiff", r"the names of sam leffler and silicon graphics may not be used in any advertising", "leffler"),
    ("freetype", r"portions of this software are copyright .{1,20}? the freetype project", "freetype"),
    ("imagemagick", r"imagemagick studio llc .{1,120}? you may not use this file except in compliance with the license", "imagemagick"),
    ("sleepycat", r"redistributions in any form must be accompanied by information on how to obtain complete source code for the db software", "redistributions"),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim", "vim"),
    ("tcl", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose", "authors"),
    ("info-zip", r"info zip is defined as the following set of individuals", "zip"),
    ("spencer", r"altered versions must be plainly marked as such and must not be misrepresented as being the original software", "altered"),
    ("eupl-1.2", r"licensed under the eupl(?: version)?(?: 1 [12])?", "eupl"),
    ("eupl-1.2", r"you may not use this work except in compliance with the licence", "licence"),
    ("cecill-2.1", r"this software is governed by the cecill (?:b |c )?license under french law", "cecill"),
    ("cecill-b", r"cecill b free software license agreement", "cecill"),
    ("cecill-c", r"cecill c free software license agreement", "cecill"),
    ("osl-3.0", r"licensed under the open software license version 3 0", "open"),
    ("afl", r"licensed under the academic free license version [23] [01]", "academic"),
    ("ecl-2.0", r"licensed under the educational community license version 2 0", "educational"),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license", "governs"),
    ("ms-rl", r"reciprocal grants for any file you distribute that contains code from the software", "reciprocal"),
    ("ms-eula", r"these license terms are an agreement between microsoft corporation", "microsoft"),
    ("apsl-2.0", r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license", "apple"),
    ("qpl-1.0", r"the q public license version 1 0", "q"),
    ("sissl", r"sun industry standards source license", "sun"),
    ("bcl", r"sun microsystems inc binary code license agreement", "binary"),
    ("otn", r"oracle technology network license agreement", "oracle"),
    ("upl-1.0", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software .{1,40}?the software free of charge and under any and all copyright rights", "condition"),
    ("intel-acpi", r"intel grants free of charge to any person .{1,60}? an irrevocable perpetual worldwide license", "intel"),
    ("nvidia", r"nvidia corporation and its licensors retain all intellectual property and proprietary rights", "nvidia"),
    ("amazon", r"licensed under the amazon software license", "amazon"),
    ("mulanpsl-2.0", r"licensed under mulan psl v2 you can use this software according to the terms and conditions of the mulan psl v2", "mulan"),
    ("jsr", r"the software shall be used for good not evil", "evil"),
    ("hippocratic", r"hippocratic license", "hippocratic"),
    ("anti-996", r"anti 996 license", "996"),
    ("fair", r"usage of the works is permitted provided that this instrument is retained with the works", "instrument"),
    ("naumen", r"naumen public license", "naumen"),
    ("watcom-1.0", r"sybase open watcom public license", "watcom"),
    ("motosoto", r"motosoto open source license", "motosoto"),
    ("nokia", r"nokia open source license", "nokia"),
    ("realnetworks", r"realnetworks public source license", "realnetworks"),
    ("ricoh", r"ricoh source code public license", "ricoh"),
    ("lucent", r"lucent public license", "lucent"),
    ("intel-os", r"intel open source license", "intel"),
    ("cua-opl", r"cua office public license", "cua"),
    ("frameworx", r"frameworx open license", "frameworx"),
    ("entessa", r"entessa public license", "entessa"),
    ("eu-datagrid", r"eu datagrid software license", "datagrid"),
    ("catosl", r"computer associates trusted open source license", "trusted"),
    ("miros", r"provided that these terms and disclaimer and all accompanying instruments .{1,40}? are retained", "instruments"),
    ("open-rail", r"creativeml open rail m", "rail"),
    ("open-rail", r"bigscience (?:open )?rail license", "bigscience"),
    ("llama", r"llama (?:2|3|3 1) community license agreement", "llama"),
    ("gemma", r"gemma terms of use", "gemma"),
    ("public-domain", r"this (?:file|work|software|document|text) is in the public domain", "domain"),
    ("public-domain", r"no copyright is claimed .{1,60}?public domain", "claimed"),
    ("public-domain", r"the authors? (?:hereby )?disclaims? copyright to this source code", "disclaim disclaims"),
    ("us-government", r"this is a work of the (?:u s|united states) government", "government"),
    ("us-government", r"pursuant to title 17 section 105 of the united states code", "pursuant"),
    ("proprietary", r"no part of this (?:publication|book|document|work) may be reproduced", "reproduced"),
    ("proprietary", r"may not be (?:copied|reproduced|distributed) without (?:the )?(?:prior |express )?(?:written )?(?:permission|consent)", "without"),
    ("proprietary", r"this (?:software|material|document) (?:is|contains) (?:the )?(?:confidential|proprietary)", "confidential proprietary"),
    ("proprietary", r"for internal use only", "internal"),
    ("proprietary", r"by (?:installing|downloading|using) (?:this|the) software you agree to be bound by", "bound"),
    ("evaluation", r"for evaluation purposes only", "evaluation"),
    ("noncommercial", r"for (?:personal and )?non ?commercial use only", "commercial noncommercial"),
    ("academic", r"for (?:academic|research|educational) (?:and research )?(?:use|purposes) only", "academic research educational"),
)
