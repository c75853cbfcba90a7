"""License scans with DataFrame functions only.

Signature rules are regular expressions with a keyword, a priority and a confidence: the
names of licenses in the forms that they are told in, and the wording of their own
texts, headers and notices. A text gets the rules of the keywords that stand in it. Their
matches are intervals; one that lies in another of the same or a higher priority is
suppressed. Plain phrases, word by word, are counted beside them.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Words of lower-cased texts, and of texts as they are.
WORD, ANY_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

S = r"\s[\s#*/;%!>|-]*"  # what stands between two words: white space, line breaks, marks of comments
LIC = r"licen[cs]e"
#: A license: label, keywords of which one stands in every form of its name, what its name looks like, SPDX id pattern.
FAMILIES = (
    ("mit", "mit|expat|x11", rf"(?:mit|expat|x11){S}{LIC}", r"mit(?:-0)?"),
    ("apache", "apache", rf"apache(?:{S}software)?{S}{LIC}", r"apache-[12]\.\d"),
    ("gpl", "general", rf"(?:gnu{S})?general{S}public{S}{LIC}", r"gpl-[123]\.\d(?:-only|-or-later|\+)?"),
    ("lgpl", "lesser|library", rf"(?:gnu{S})?(?:lesser|library){S}general{S}public{S}{LIC}", r"lgpl-[23]\.\d(?:-only|-or-later|\+)?"),
    ("agpl", "affero", rf"(?:gnu{S})?affero{S}general{S}public{S}{LIC}", r"agpl-[13]\.\d(?:-only|-or-later|\+)?"),
    ("gfdl", "documentation", rf"(?:gnu{S})?free{S}documentation{S}{LIC}", r"gfdl-1\.\d(?:-only|-or-later)?"),
    ("bsd", "bsd", rf"(?:[234]-clause{S}|new{S}|modified{S}|simplified{S}|revised{S})?bsd(?:[ -]style)?{S}{LIC}", r"bsd-[0234]-clause(?:-clear|-patent)?"),
    ("mpl", "mozilla", rf"mozilla{S}public{S}{LIC}", r"mpl-[12]\.\d"),
    ("epl", "eclipse", rf"eclipse{S}public{S}{LIC}", r"epl-[12]\.\d"),
    ("cddl", "common", rf"common{S}development{S}and{S}distribution{S}{LIC}", r"cddl-1\.\d"),
    ("cpl", "common", rf"common{S}public{S}{LIC}", r"cpl-1\.\d"),
    ("cpal", "common", rf"common{S}public{S}attribution{S}{LIC}", r"cpal-1\.\d"),
    ("eupl", "european", rf"european{S}union{S}public{S}{LIC}", r"eupl-1\.\d"),
    ("isc", "isc", rf"isc{S}{LIC}", r"isc"),
    ("zlib", "zlib", rf"zlib(?:/libpng)?{S}{LIC}", r"zlib"),
    ("libpng", "libpng", rf"libpng{S}{LIC}", r"libpng(?:-2\.0)?"),
    ("boost", "boost", rf"boost{S}software{S}{LIC}", r"bsl-1\.\d"),
    ("artistic", "artistic", rf"(?:perl{S})?artistic{S}{LIC}", r"artistic-[12]\.\d"),
    ("psf", "python", rf"python{S}(?:software{S}foundation{S})?{LIC}", r"psf-2\.\d|python-2\.\d"),
    ("ruby", "ruby", rf"ruby{S}{LIC}", r"ruby"),
    ("php", "php", rf"php{S}{LIC}", r"php-3\.\d+"),
    ("w3c", "w3c", rf"w3c{S}(?:software{S})?(?:notice{S}and{S})?{LIC}", r"w3c"),
    ("unlicense", "unlicense", rf"the{S}unlicense", r"unlicense"),
    ("wtfpl", "wtfpl|want", rf"wtfpl|do{S}what{S}the{S}f\w{{1,6}}{S}you{S}want{S}to{S}public{S}{LIC}", r"wtfpl"),
    ("ofl", "open", rf"(?:sil{S})?open{S}font{S}{LIC}", r"ofl-1\.\d"),
    ("osl", "open", rf"open{S}software{S}{LIC}", r"osl-[123]\.\d"),
    ("odbl", "open", rf"open{S}(?:data{S}commons{S}open{S})?database{S}{LIC}", r"odbl-1\.\d"),
    ("odc-by", "open", rf"open{S}data{S}commons{S}attribution{S}{LIC}", r"odc-by-1\.\d"),
    ("pddl", "domain", rf"public{S}domain{S}dedication{S}and{S}{LIC}", r"pddl-1\.\d"),
    ("afl", "academic", rf"academic{S}free{S}{LIC}", r"afl-[123]\.\d"),
    ("ecl", "educational", rf"educational{S}community{S}{LIC}", r"ecl-[12]\.\d"),
    ("ms-pl", "microsoft", rf"microsoft{S}public{S}{LIC}", r"ms-pl"),
    ("ms-rl", "microsoft", rf"microsoft{S}reciprocal{S}{LIC}", r"ms-rl"),
    ("apsl", "apple", rf"apple{S}public{S}source{S}{LIC}", r"apsl-[12]\.\d"),
    ("ibm-pl", "ibm", rf"ibm{S}public{S}{LIC}", r"ipl-1\.\d"),
    ("intel", "intel", rf"intel{S}open{S}source{S}{LIC}", r"intel"),
    ("nokia", "nokia", rf"nokia{S}open{S}source{S}{LIC}", r"nokia"),
    ("sun-pl", "sun", rf"sun{S}public{S}{LIC}", r"spl-1\.\d"),
    ("qpl", "q", rf"\bq{S}public{S}{LIC}", r"qpl-1\.\d"),
    ("latex", "latex", rf"latex{S}project{S}public{S}{LIC}", r"lppl-1\.\d\w?"),
    ("vim", "vim", rf"vim{S}{LIC}", r"vim"),
    ("openssl", "openssl", rf"openssl{S}{LIC}", r"openssl"),
    ("postgresql", "postgresql", rf"postgresql{S}{LIC}", r"postgresql"),
    ("ncsa", "illinois|ncsa", rf"(?:university{S}of{S}illinois|ncsa){S}open{S}source{S}{LIC}", r"ncsa"),
    ("mulan", "mulan", rf"mulan{S}(?:permissive{S}software|psl){S}{LIC}", r"mulanpsl-[12]\.\d"),
    ("cecill", "cecill", rf"cecill(?:-[bc])?{S}(?:free{S}software{S})?{LIC}", r"cecill-(?:[bc]|[12]\.\d)"),
    ("sspl", "server", rf"server{S}side{S}public{S}{LIC}", r"sspl-1\.\d"),
    ("busl", "business", rf"business{S}source{S}{LIC}", r"busl-1\.\d"),
    ("elastic", "elastic", rf"elastic{S}{LIC}", r"elastic-2\.\d"),
    ("cc0", "cc0", rf"cc0(?:{S}1\.0)?(?:{S}universal)?", r"cc0-1\.\d"),
    ("cc-by-nc-nd", "cc", r"cc[ -]by[ -]nc[ -]nd", r"cc-by-nc-nd-\d\.\d"),
    ("cc-by-nc-sa", "cc", r"cc[ -]by[ -]nc[ -]sa", r"cc-by-nc-sa-\d\.\d"),
    ("cc-by-nc", "cc", r"cc[ -]by[ -]nc", r"cc-by-nc-\d\.\d"),
    ("cc-by-nd", "cc", r"cc[ -]by[ -]nd", r"cc-by-nd-\d\.\d"),
    ("cc-by-sa", "cc", r"cc[ -]by[ -]sa", r"cc-by-sa-\d\.\d"),
    ("cc-by", "cc", r"cc[ -]by", r"cc-by-\d\.\d"),
    ("cc-by", "commons", rf"creative{S}commons{S}attribution(?:{S}{LIC})?", r"cc-by-\d\.\d"),
    ("cc-by-sa", "commons", rf"creative{S}commons{S}attribution[ -]share[ -]?alike(?:{S}{LIC})?", r"cc-by-sa-\d\.\d"),
    ("cc-by-nc", "commons", rf"creative{S}commons{S}attribution[ -]non[ -]?commercial(?:{S}{LIC})?", r"cc-by-nc-\d\.\d"),
)
VERSION = rf",?{S}(?:version{S}|v\.?\s?)?\d{{1,2}}(?:\.\d{{1,2}})?"
#: Forms that a license is told in: name, priority, confidence, pattern around {name} or {spdx}.
FORMS = (
    ("identifier", 5, 1.0, r"spdx-licen[cs]e-identifier:[\s(]*(?:{spdx})"),
    ("left", 5, 1.0, r"(?<![a-z0-9.-])(?:{spdx})\)*\s{1,4}(?:or|and|with)\s"),
    ("right", 5, 1.0, r"(?<![a-z0-9])(?:or|and)\s{1,4}\(*(?:{spdx})(?![a-z0-9])"),
    ("field", 4, 0.9, r"(?<![a-z])licen[cs]es?[\"']?\s*[:=]\s*[\"'(\[]{0,2}(?:{spdx})(?![a-z0-9])"),
    ("grant", 4, 0.95, r"(?:licensed|released|distributed|published|available|redistributed){s}under{s}(?:the{s}terms{s}of{s})?(?:the{s}|an?{s})?(?:{name})(?:{version})?"),
    ("version", 3, 0.85, r"(?:{name}){version}"),
    ("mention", 2, 0.7, r"(?:see|under|of|per|with){s}(?:the{s}|an?{s})(?:{name})"),
    ("name", 1, 0.5, r"(?:{name})"),
)
#: Forms that hold a license's id, and their keywords. Sides of an expression (mit or apache-2.0) count
#: only in texts that hold an identifier.
BY_ID = {"identifier": "spdx", "left": "spdx", "right": "spdx", "field": "license|licence"}
#: What a name is followed by where no license is meant: a license plate, the license he took.
NO_LICENSE = rf"(?!{S}(?:plates?|numbers?|holders?|he|she|they|we|i|was|he's){S}|{S}plates?(?![a-z]))"
#: Licenses by their short names: label, keyword, what the name looks like. A number follows it.
SHORT = (
    ("gpl", "gpl", "gpl"), ("lgpl", "lgpl", "lgpl"), ("agpl", "agpl", "agpl"), ("apache", "apache", "apache"),
    ("cddl", "cddl", "cddl"), ("eupl", "eupl", "eupl"), ("cecill", "cecill", "cecill"),
)
#: Licenses as they are named in German, French and Spanish: label, name.
ABROAD = (
    ("mit", "mit"), ("apache", "apache"), ("gpl", "(?:gnu[ -])?gpl"), ("lgpl", "(?:gnu[ -])?lgpl"), ("bsd", "bsd"), ("mpl", "(?:mozilla(?:[ -]public)?|mpl)"), ("eupl", "eupl"),
    ("creative-commons", "creative[ -]commons"),
)
#: Rules of no one license: label, keywords, priority, confidence, pattern.
PLAIN = (
    ("reserved", "reserved", 2, 0.8, rf"all{S}rights{S}(?:are{S})?reserved"),
    ("some-rights", "reserved", 2, 0.7, rf"some{S}rights{S}reserved"),
    ("copyright", "copyright", 2, 0.5, rf"copyright{S}(?:\(c\)\s*|©\s*)?(?:19|20)\d\d(?:\s?[-–,]\s?(?:19|20)?\d\d){{0,8}}"),
    ("copyright", "copyright", 1, 0.3, r"copyright(?:ed)?\s+(?:\(c\)|©|by)"),
    ("public-domain", "domain", 3, 0.8, rf"(?:released|placed|dedicated){S}(?:in|into|to){S}the{S}public{S}domain"),
    ("public-domain", "domain", 1, 0.4, rf"public{S}domain"),
    ("no-warranty", "warrant", 2, 0.6, rf"without{S}(?:any{S})?warrant(?:y|ies){S}(?:of{S}any{S}kind|or{S}conditions)"),
    ("as-is", "provided", 2, 0.5, rf"provided{S}[\"'“]?as[ -]is[\"'”]?"),
    ("proprietary", "proprietary", 2, 0.6, rf"proprietary{S}and{S}confidential"),
    ("no-copying", "permission", 2, 0.6, rf"(?:may{S}not|must{S}not){S}be{S}(?:copied|reproduced|redistributed){S}without{S}(?:prior{S})?(?:written{S})?permission"),
    ("permissive", "permission", 2, 0.6, rf"permission{S}is{S}hereby{S}granted,?{S}free{S}of{S}charge"),
    ("permissive", "redistribution", 2, 0.6, rf"redistribution{S}and{S}use{S}in{S}source{S}and{S}binary{S}forms"),
    ("copyleft", "free", 2, 0.6, rf"free{S}software[;:,]?{S}you{S}can{S}redistribute{S}it"),
    ("bsd", "bsd", 3, 0.85, rf"(?<![a-z0-9])(?:bsd[ -][0234][ -]clause|[0234][ -]clause{S}bsd)(?![a-z0-9])"),
    ("cc0", "cc0", 3, 0.8, rf"(?<![a-z0-9])cc0(?:[ -]1\.0)?(?![a-z0-9])"),
    ("reserved", "vorbehalten", 2, 0.8, rf"alle{S}rechte{S}(?:sind{S})?vorbehalten"),
    ("reserved", "droits", 2, 0.8, rf"tous{S}droits{S}r(?:é|e)serv(?:é|e)s"),
    ("reserved", "derechos", 2, 0.8, rf"todos{S}los{S}derechos{S}reservados"),
    ("gpl", "lizenz", 3, 0.8, rf"allgemeine{S}(?:öffentliche|public){S}lizenz"),
    ("gpl", "licence", 3, 0.8, rf"licence{S}publique{S}générale(?:{S}gnu)?"),
    ("gpl", "licencia", 3, 0.8, rf"licencia{S}p(?:ú|u)blica{S}general(?:{S}(?:de{S})?gnu)?"),
    ("public-domain", "gemeinfrei", 2, 0.5, r"(?<![a-zäöüß])gemeinfrei(?![a-z])"),
    ("public-domain", "domaine", 2, 0.5, rf"dans{S}le{S}domaine{S}public"),
    ("public-domain", "dominio", 2, 0.5, rf"de{S}dominio{S}público"),
)
#: The wording of licenses, headers and notices, lower-cased; a space stands for
#: any gap between two words, and <n> for up to n signs that differ from text to text.
SIGNATURES = (
    ("mit", "granted", 4, 0.9, r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "sublicense", 3, 0.8, r"to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software"),
    ("mit", "notice", 3, 0.7, r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", 3, 0.6, r"warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("mit", "opensource.org", 4, 0.9, r"opensource\.org/licenses/mit(?:-license)?"),
    ("x11", "advertising", 4, 0.8, r"except as contained in this notice, the name of <60> shall not be used in advertising"),
    ("bsd", "redistributions", 3, 0.8, r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", 3, 0.8, r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", 4, 0.9, r"neither the names? of <90> nor the names of (?:its|their) contributors may be used to endorse or promote products"),
    ("bsd-3-clause", "endorse", 3, 0.7, r"may be used to endorse or promote products derived from this software without (?:specific )?prior written permission"),
    ("bsd-4-clause", "advertising", 4, 0.9, r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "provided", 3, 0.7, r"this software is provided by the (?:regents|copyright holders|author)(?: and contributors)? <2>as is<2>"),
    ("bsd", "consequential", 2, 0.5, r"in no event shall the (?:regents|copyright (?:owner|holders?)|authors?)(?: or contributors)? be liable for any direct, indirect, incidental, special, exemplary, or consequential damages"),
    ("bsd", "opensource.org", 4, 0.9, r"opensource\.org/licenses/bsd-(?:[0234]-clause|license)"),
    ("bsd-patent", "contributor", 4, 0.8, r"subject to the terms and conditions of this license, each copyright holder and contributor hereby grants"),
    ("isc", "fee", 4, 0.9, r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "disclaims", 3, 0.7, r"the software is provided <2>as is<2> and (?:the author|isc) disclaims all warranties"),
    ("hpnd", "fee", 3, 0.7, r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("ntp", "suitability", 3, 0.6, r"makes no representations about the suitability (?:of )?this software for any purpose"),
    ("apache", "asf", 4, 0.95, r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("apache", "compliance", 4, 0.9, r"you may not use this file except in compliance with the license"),
    ("apache", "applicable", 3, 0.8, r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an <2>as is<2> basis"),
    ("apache", "apache.org", 4, 0.95, r"apache\.org/licenses/license-[12]\.[01]"),
    ("apache", "contribution", 3, 0.8, r"<2>contribution<2> shall mean any work of authorship, including the original version of the work"),
    ("apache", "patent", 3, 0.8, r"grant of patent license\. subject to the terms and conditions of this license, each contributor hereby grants"),
    ("apache", "apache", 3, 0.8, r"this product includes software developed (?:by|at) the apache (?:software foundation|group)"),
    ("gpl", "redistribute", 4, 0.95, r"this (?:program|file|package|software|library) is free software[;:,] you (?:can|may) redistribute it and/or modify it under the terms of the gnu general public license"),
    ("gpl", "option", 3, 0.7, r"as published by the free software foundation[;,] either version [123](?:\.\d)? of the license, or \(?at your option\)? any later version"),
    ("gpl", "merchantability", 3, 0.7, r"without even the implied warranty of merchantability or fitness for a particular purpose\. see the gnu general public license"),
    ("gpl", "received", 3, 0.8, r"you should have received a copy of the gnu general public license along with"),
    ("gpl", "verbatim", 3, 0.7, r"everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("gpl", "gnu.org", 4, 0.8, r"gnu\.org/(?:copyleft|licenses)/(?:old-licenses/)?gpl(?:-[123]\.\d)?"),
    ("gpl", "copyleft", 3, 0.6, r"the gnu general public license is a free, copyleft license"),
    ("gpl", "linking", 4, 0.8, r"linking <60>statically or dynamically with other modules is making a combined work"),
    ("gpl", "gpl", 4, 0.8, r"(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?gpl(?:v[123]\+?| ?v?[123](?:\.0)?(?:-only|-or-later|\+)?)?"),
    ("lgpl", "received", 3, 0.8, r"you should have received a copy of the gnu (?:lesser|library) general public license along with"),
    ("lgpl", "redistribute", 4, 0.95, r"this (?:library|program|file) is free software[;:,] you (?:can|may) redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "gnu.org", 4, 0.8, r"gnu\.org/(?:copyleft|licenses)/(?:old-licenses/)?lgpl(?:-[23]\.\d)?"),
    ("lgpl", "lgpl", 4, 0.8, r"(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?lgpl(?:v[23]\+?| ?v?[23](?:\.[01])?)?"),
    ("agpl", "affero", 3, 0.8, r"you should have received a copy of the gnu affero general public license along with"),
    ("agpl", "gnu.org", 4, 0.8, r"gnu\.org/licenses/agpl(?:-[13]\.\d)?"),
    ("agpl", "agpl", 4, 0.8, r"(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?agpl(?:v3\+?| ?v?3(?:\.0)?)?"),
    ("gfdl", "invariant", 4, 0.9, r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    ("gfdl", "documentation", 4, 0.9, r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("mpl", "mozilla", 4, 0.95, r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mozilla.org", 4, 0.95, r"mozilla\.org/mpl(?:/[12]\.[01])?"),
    ("mpl", "mpl", 3, 0.8, r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
    ("mpl", "original", 3, 0.7, r"the original code is <60>(?:mozilla|netscape)"),
    ("epl", "eclipse", 4, 0.95, r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "eclipse.org", 4, 0.95, r"eclipse\.org/legal/epl-(?:v10|2\.0|v20)"),
    ("edl", "eclipse", 4, 0.9, r"eclipse distribution license"),
    ("cddl", "distribution", 4, 0.95, r"the contents of this file are subject to the terms of (?:either )?(?:the )?common development and distribution license"),
    ("cddl", "obtain", 3, 0.8, r"you can obtain a copy of the (?:cddl|license) at <60>(?:opensolaris|cddl)"),
    ("npl", "netscape", 4, 0.9, r"netscape public license"),
    ("eupl", "eupl", 4, 0.9, r"licensed under the eupl,? version 1\.[0-2]"),
    ("boost", "obtaining", 4, 0.9, r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost", "boost.org", 4, 0.95, r"boost\.org/license_1_0\.txt"),
    ("zlib", "altered", 3, 0.8, r"altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("zlib", "misrepresented", 3, 0.8, r"the origin of this software must not be misrepresented"),
    ("zlib", "implied", 3, 0.7, r"this software is provided <2>as-is<2>, without any express or implied warranty"),
    ("libpng", "libpng", 3, 0.8, r"this copy of the libpng notices is provided for your convenience"),
    ("unlicense", "unencumbered", 4, 0.95, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense.org", 4, 0.95, r"unlicense\.org"),
    ("unlicense", "anyone", 3, 0.7, r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("wtfpl", "wtfpl.net", 4, 0.95, r"wtfpl\.net"),
    ("wtfpl", "want", 3, 0.8, r"you just do what the f\w{1,6} you want to"),
    ("beerware", "beer", 4, 0.95, r"the beer-?ware license"),
    ("beerware", "retain", 3, 0.8, r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("json", "evil", 4, 0.95, r"the software shall be used for good, not evil"),
    ("perl", "perl", 4, 0.9, r"(?:redistribute|modify|distribute) it under the same terms as (?:the )?perl(?: 5)?(?: programming language system)? itself"),
    ("psf", "psf", 3, 0.8, r"psf hereby grants licensee a nonexclusive, royalty-free, world-?wide license"),
    ("psf", "python.org", 3, 0.8, r"python\.org/(?:psf/license|download/releases/[\d.]+/license)"),
    ("openssl", "openssl", 3, 0.9, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "cryptographic", 4, 0.9, r"this product includes cryptographic software written by eric young"),
    ("curl", "curl", 3, 0.7, r"curl(?: and libcurl)? (?:is|are) licensed under a mit/x derivate license"),
    ("icu", "icu|unicode", 4, 0.8, r"icu license|unicode, inc\. license agreement"),
    ("unicode", "unicode", 3, 0.8, r"unicode\.org/(?:copyright|license)"),
    ("tcl", "regents", 3, 0.7, r"this software is copyrighted by the regents of the university of california, sun microsystems"),
    ("ofl", "reserved", 3, 0.9, r"with reserved font names?"),
    ("ofl", "scripts.sil.org", 4, 0.95, r"scripts\.sil\.org/ofl"),
    ("ofl", "font", 3, 0.8, r"the font software may be (?:modified, altered, or added to|sold as part of a larger software package)"),
    ("cc0", "publicdomain", 4, 0.95, r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc0", "waived", 3, 0.9, r"to the extent possible under law, <90> (?:has|have) waived all copyright and related or neighbou?ring rights"),
    ("public-domain", "publicdomain", 4, 0.9, r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("cc-by", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by/[1-4]\.\d"),
    ("cc-by-sa", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by-sa/[1-4]\.\d"),
    ("cc-by-nc", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by-nc/[1-4]\.\d"),
    ("cc-by-nd", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by-nd/[1-4]\.\d"),
    ("cc-by-nc-sa", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.\d"),
    ("cc-by-nc-nd", "creativecommons.org", 4, 0.95, r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.\d"),
    ("cc-by", "commons", 3, 0.7, r"you are free to share (?:and adapt )?<20>copy and redistribute the material in any medium or format<40>creative commons"),
    ("cc-by-sa", "alike", 2, 0.5, r"if you alter, transform, or build upon this work, you may distribute the resulting work only under the same or similar license.{0,30}share alike"),
    ("odbl", "opendatacommons.org", 4, 0.95, r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", "opendatacommons.org", 4, 0.95, r"opendatacommons\.org/licenses/by"),
    ("pddl", "opendatacommons.org", 4, 0.95, r"opendatacommons\.org/licenses/pddl"),
    ("open-government", "government", 4, 0.9, r"open government licen[cs]e(?: v?[123]\.0)?"),
    ("us-government", "government", 3, 0.7, r"(?:work|software) of the u\.s\. government(?: and)? (?:is )?not subject to (?:u\.s\. )?copyright"),
    ("us-government", "pursuant", 3, 0.7, r"pursuant to title 17,? section 105,? of the united states code"),
    ("sspl", "mongodb", 4, 0.9, r"mongodb\.com/licensing/server-side-public-license"),
    ("busl", "effective", 3, 0.9, r"effective on the change date, or the fourth anniversary"),
    ("busl", "additional", 3, 0.8, r"additional use grant:"),
    ("commons-clause", "commons", 4, 0.9, r"<2>commons clause<2> license condition"),
    ("elastic", "managed", 3, 0.9, r"you may not provide the software to third parties as a hosted or managed service"),
    ("polyform", "polyform", 4, 0.9, r"polyform (?:noncommercial|small business|strict|shield|perimeter|free trial|internal use) license"),
    ("parity", "parity", 4, 0.8, r"the parity public license"),
    ("hippocratic", "hippocratic", 4, 0.9, r"hippocratic license"),
    ("upl", "permissive", 4, 0.9, r"universal permissive license"),
    ("bsl", "blueoak", 4, 0.9, r"blueoakcouncil\.org/license"),
    ("mulan", "mulan", 3, 0.9, r"license\.coscl\.org\.cn/mulanpsl2?|you can use this software according to the terms and conditions of the mulan"),
    ("cecill", "cecill", 3, 0.9, r"cecill\.info|this software is governed by the cecill(?:-[bc])? license"),
    ("etalab", "etalab|ouverte", 4, 0.9, r"licence ouverte(?: / open licence)?|etalab open licen[cs]e"),
    ("dual", "dual", 3, 0.8, r"dual(?:-| )licensed under|available under (?:a )?dual licen[cs]es?"),
    ("dual", "option", 3, 0.7, r"at your option, under (?:either|the terms of)"),
    ("dual", "alternatively", 3, 0.7, r"alternatively, (?:this|the contents of this) (?:file|software|package|product) may be (?:used|distributed) under the terms of"),
    ("license-file", "license|licence|copying", 2, 0.5, r"see (?:the )?(?:file )?(?:licen[cs]e|copying)(?:\.(?:txt|md|rst))?(?: file)?(?: in the (?:project )?root| for (?:license|copyright|details|more))"),
    ("license-file", "license", 2, 0.5, r"can be found in the license file"),
    ("license-file", "license", 2, 0.5, r"refer to the license (?:file|agreement)"),
    ("license-field", "license|licence", 2, 0.5, r"<1>licen[cs]e<1>\s*[:=]\s*<2>see license in"),
    ("eula", "user", 3, 0.8, r"end(?:-| )user licen[cs]e agreement"),
    ("eula", "agree", 3, 0.7, r"by (?:installing|downloading|using|copying)(?: or (?:installing|downloading|using|copying))? (?:this|the) (?:software|program|product), you agree to (?:be bound by )?(?:the terms|these terms)"),
    ("proprietary", "confidential", 3, 0.8, r"(?:strictly |company |proprietary and )confidential(?: and proprietary)?(?: information)? of"),
    ("proprietary", "contain", 3, 0.8, r"contains? (?:valuable )?(?:trade secrets|proprietary information)(?: and (?:trade secrets|confidential information))? of"),
    ("proprietary", "unauthori", 3, 0.8, r"unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: or (?:copying|reproduction|use|distribution))? of this <40>is (?:strictly )?prohibited"),
    ("proprietary", "unpublished", 3, 0.7, r"unpublished (?:work|proprietary source code|copyrighted work)"),
    ("proprietary", "internal", 3, 0.6, r"for internal use only"),
    ("proprietary", "evaluation|trial|demonstration", 3, 0.6, r"for (?:evaluation|trial|demonstration) (?:purposes|use) only"),
    ("no-copying", "reproduced|copied|transmitted|distributed", 3, 0.8, r"no part of this (?:publication|book|document|work|site) may be (?:reproduced|copied|transmitted|distributed)"),
    ("no-copying", "retrieval", 3, 0.7, r"stored in a retrieval system, or transmitted,? in any form or by any means"),
    ("no-copying", "redistribut", 3, 0.6, r"(?:do not|may not|must not) (?:copy or )?redistribute"),
    ("non-commercial", "commercial", 3, 0.7, r"(?:for|free for) non-?commercial (?:use|purposes)(?: only)?"),
    ("non-commercial", "commercial", 3, 0.7, r"commercial use (?:is )?(?:not allowed|not permitted|prohibited|requires a license)"),
    ("academic-use", "academic|educational|research", 3, 0.6, r"for (?:academic|educational|research)(?: (?:and|or) (?:academic|educational|research))? (?:use|purposes) only"),
    ("personal-use", "personal", 3, 0.6, r"for personal use only"),
    ("freeware", "freeware", 3, 0.7, r"this (?:software|program) is freeware"),
    ("shareware", "shareware", 3, 0.7, r"this (?:software|program) is shareware"),
    ("royalty-free", "royalty", 2, 0.5, r"(?:worldwide|perpetual|irrevocable|non-exclusive), royalty-free"),
    ("used-with-permission", "permission", 3, 0.7, r"(?:reprinted|reproduced|used) (?:here )?(?:with|by) (?:kind )?permission(?: of| from)?"),
    ("fair-use", "fair", 3, 0.6, r"(?:under|constitutes) (?:a )?(?:the )?<2>fair use<2>"),
    ("dmca", "dmca|millennium", 3, 0.6, r"(?:dmca|digital millennium copyright act) (?:notice|takedown|policy)"),
    ("trademark", "trademark", 2, 0.5, r"(?:is|are) (?:a )?(?:registered )?trademarks? of <60>"),
    ("copyright", "copyright", 2, 0.5, r"copyright(?:ed)? (?:©|\(c\)) (?:19|20)\d\d(?:-(?:19|20)?\d\d)?,? (?:by )?[a-z]"),
    ("copyright", "copyright", 2, 0.5, r"portions copyright"),
    ("no-warranty", "merchantability", 2, 0.5, r"implied warranties of merchantability"),
    ("no-warranty", "liable", 2, 0.5, r"in no event (?:shall|will) the (?:authors?|copyright holders?|contributors) be (?:held )?liable"),
    ("no-warranty", "warrant", 2, 0.5, r"there is (?:absolutely )?no warranty"),
    ("no-warranty", "warrant", 2, 0.5, r"comes with absolutely no warranty"),
)


def told(pattern: str) -> str:
    """A signature as a regular expression: its spaces are gaps, <n> is up to n signs."""
    pattern = re.sub(r"<(\d+)>", lambda m: f"(?s:.{{0,{m[1]}}})" if int(m[1]) > 2 else rf"[\"'“”‘’`]{{0,{m[1]}}}", pattern)
    return pattern.replace(" ", f"(?:{S})")


def rule_list() -> list[tuple[int, str, str, int, float, str]]:
    """(number, label, keywords, priority, confidence, pattern) of all rules, in order."""
    rules = []
    for form, priority, confidence, around in FORMS:
        for label, keyword, name, spdx in FAMILIES:
            pattern = around.replace("{s}", S).replace("{version}", VERSION).replace("{name}", name).replace("{spdx}", spdx)
            bounded = pattern if form in BY_ID else rf"(?<![a-z0-9]){pattern}(?![a-z0-9])" + NO_LICENSE * (form in ("mention", "name"))
            rules.append((label, BY_ID.get(form, keyword), priority, confidence, bounded))
    rules += PLAIN
    for label, keyword, name in SHORT:
        number = rf"[ ,-]{{0,2}}(?:v(?:ersion{S})?\.?\s?)?[1-4](?:\.\d)?(?:\+|-or-later|-only)?(?![a-z0-9]|\.\d)"
        rules.append((label, keyword, 3, 0.8, rf"(?<![a-z0-9])(?:(?:gnu|the|under|apache){S}){{0,2}}{name}{number}"))
    for label, name in ABROAD:
        for keyword, pattern in (("lizenz", rf"{name}[ -]lizenz(?:en)?"), ("licence", rf"licence{S}(?:publique{S})?{name}"), ("licencia", rf"licencia{S}(?:p(?:ú|u)blica{S})?{name}")):
            rules.append((label, keyword, 2, 0.7, rf"(?<![a-zäöüß0-9]){pattern}(?:{VERSION})?(?![a-z0-9])"))
    rules += [(label, keyword, priority, confidence, rf"(?<![a-z0-9]){told(pattern)}") for label, keyword, priority, confidence, pattern in SIGNATURES]
    return [(i, *r) for i, r in enumerate(rules)]


#: Words that most rules can't do without; the gate looks for these first.
CORE = ("licen", "lizenz", "software", "copyright", "permission", "distribut", "warrant", "notice", "domain", "commons", ".org")


def needed(pattern: str) -> str:
    """What stands in every match of a pattern, as plain text: groups, optional signs and all
    of a pattern with alternatives left out."""
    plain = re.sub(r"\\(.)", lambda m: m[1] if m[1] == "." else " ", re.sub(r"\[[^\]]*\]\*?", " ", pattern))
    keep = lambda m: " " if m[1] in ("?<!", "?!") or m[3] or "|" in m[2] else m[2]
    while (shorter := re.sub(r"\((\?<!|\?!|\?s?:)?([^()]*)\)([?*]|\{[^}]*\})?", keep, plain)) != plain:
        plain = shorter
    return "" if "|" in plain else re.sub(r".(?:[?*]|\{0[^}]*\})", " ", plain)


def gate() -> list[str]:
    """Words of which a text must hold one for any rule to match, checked before anything
    else: of every rule a core word that it can't do without, or else its keywords."""
    held: set[str] = set()
    for _, _, keywords, _, _, pattern in rule_list():
        core = next((c for c in CORE if c in needed(pattern)), None)
        held |= {core} if core else set(keywords.split("|"))
    return sorted(k for k in held if not any(o != k and o in k for o in held))


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as a table; its size is that of the lists above, whatever the input."""
    names = ("rule", "label", "keyword", "priority", "confidence", "pattern")
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rule_list()])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<rule: int, label: string, keyword: string, priority: int, confidence: double, pattern: string>>")))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_places(line: Column, n_words: Column) -> tuple[Column, Column, Column, Column]:
    """(places, first word, last word, labels) of PHRASES in a line of words that have
    a space on either side each, so that no two places share a space."""
    total, firsts, lasts, labels = [], [], [], []
    spaces = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))
    turned = F.reverse(line)
    for phrase, label in PHRASES:
        words = phrase.split()
        p = " " + "  ".join(words) + " "
        n = (F.char_length(line) - F.char_length(F.replace(line, F.lit(p), F.lit("")))) / len(p)
        first = spaces(F.substring(line, F.lit(1), F.instr(line, p) - 1)) / 2
        last = n_words - len(words) - spaces(F.substring(turned, F.lit(1), F.instr(turned, p[::-1]) - 1)) / 2
        total.append(n.cast("long"))
        firsts.append(F.when(n > 0, first.cast("long")))
        lasts.append(F.when(n > 0, last.cast("long")))
        labels.append(F.when(n > 0, F.lit(label)))
    return sum(total[1:], total[0]), F.least(*firsts), F.greatest(*lasts), F.array_compact(F.array(*labels))


def detections(texts: DataFrame) -> DataFrame:
    """(row, rule, label, priority, confidence, start, end) of the matches of the rules in
    texts (row, low: lower-cased), without the suppressed ones."""
    rules = rule_table(texts.sparkSession)
    keywords = sorted({r[2] for r in rule_list()})
    held = F.explode(F.array_compact(F.array(*[F.when(reduce(or_, [F.contains(F.col("low"), F.lit(w)) for w in k.split("|")]), F.lit(k)) for k in keywords])))
    tried = texts.select("row", "low", held.alias("keyword")).join(F.broadcast(rules), "keyword")
    hits = F.regexp_extract_all("low", F.col("pattern"), F.lit(0))
    sizes = F.transform(F.arrays_zip(F.split("low", F.col("pattern"), F.lit(-1)).alias("gap"), hits.alias("hit")), lambda x: F.struct(F.char_length(x["gap"]).alias("gap"), F.char_length(x["hit"]).alias("hit")))
    found = (
        tried.where(F.rlike("low", F.col("pattern")))
        .select("row", "rule", "label", "priority", "confidence", F.posexplode(sizes).alias("i", "x"))
        .where("x.hit is not null")
        .withColumn("end", F.sum(F.col("x.gap") + F.col("x.hit")).over(Window.partitionBy("row", "rule").orderBy("i")))
        .select("row", "rule", "label", "priority", "confidence", (F.col("end") - F.col("x.hit")).alias("start"), "end")
    )
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({r[3] for r in rule_list()})
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before)) for p in levels])
    return found.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach")


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels and
    labels (arrays, sorted), score, detections (array of label, rule, start, end,
    confidence).

    Null and empty texts have no words and no labels; repeated rows give repeated
    results; an empty table gives none; other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    phrase_gate = "(?i)" + "|".join(GAP.join(p.split()) for p, _ in PHRASES)
    held = reduce(or_, [F.contains(F.col("small"), F.lit(k)) for k in gate()])
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), body.alias("body"), F.lower(body).alias("small"))
    body = F.col("body")
    seen = given.select(
        "row", "key", F.regexp_count(body, F.lit(ANY_WORD)).cast("long").alias("n_words"), F.when(held, ascii_lower(body)).alias("low"),
        F.when(body.rlike(phrase_gate), F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(ascii_lower(body), F.lit(f"({WORD})"), F.lit(1)), "  "), F.lit(" "))).alias("line"),
    )
    n_base, first, last, labels = phrase_places(F.col("line"), F.col("n_words"))
    rows = staged(
        seen.select("row", "key", "n_words", "low", F.coalesce(n_base, F.lit(0)).cast("long").alias("n_base"), first.alias("first_word"), last.alias("last_word"), F.coalesce(labels, F.array().cast("array<string>")).alias("base_labels")),
        "scan",
    )
    found = detections(rows.where("low is not null").select("row", "low")).groupBy("row").agg(
        F.collect_set("label").alias("found"),
        F.max("confidence").alias("best"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "rule", "confidence"))).alias("detections"),
    )
    none = F.array().cast("array<string>")
    return rows.drop("low").join(found, "row", "left").select(
        F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(F.array_union("base_labels", F.coalesce("found", none))).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "detections",
    )
