"""Operator 1: license scans by ordered signature rules. [native]

Rules are regular expressions over the normalised text: A-Z lower-cased, every run of
other ASCII than letters and digits one space. Each rule has a label, a priority (lower
is stronger), a confidence and a keyword without which its pattern is not tried. A text
that holds no keyword at all is not scanned. Detections are word intervals; of equal ones
the strongest stands, and one inside another of equal or greater strength is suppressed.

Everything is an expression over the row: no row is moved, joined or exploded, so neither
hot sources nor copies matter. Null and empty texts have no words, no label and score 0;
repeated rows and ids give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import table


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words, with single spaces between them."""

    name: str
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


#: The base phrases: always found, never suppressed.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Weaker priorities have higher numbers; suppression looks at these levels.
NOTICE, TAG, ADDRESS, GRANT, NAME, HINT = 1, 2, 3, 4, 5, 6

_L = "licen[cs]e"
#: label: (keyword, name as a pattern, identifier as a pattern). Versions stand in the names.
FAMILIES = {
    "mit": ("mit licen", f"(?:the )?mit {_L}", "mit"),
    "mit-0": ("no attribution", f"mit no attribution(?: {_L})?", "mit 0"),
    "x11": ("x11", f"(?:the )?x11 {_L}", "x11"),
    "isc": ("isc", f"(?:the )?isc {_L}", "isc"),
    "apache-1": ("apache", f"apache (?:software )?{_L} (?:version )?1 [01]", "apache 1 [01]"),
    "apache-2": ("apache", f"apache (?:software )?{_L} (?:version |v )?2(?: 0)?", "apache 2 0"),
    "bsd-2": ("bsd", f"(?:simplified bsd|(?:bsd )?(?:2|two) clause bsd|bsd (?:2|two) clause|freebsd)(?: {_L})?", "bsd 2 clause"),
    "bsd-3": ("bsd", f"(?:new bsd|modified bsd|(?:3|three) clause bsd|bsd (?:3|three) clause)(?: {_L})?", "bsd 3 clause"),
    "bsd-4": ("bsd", f"(?:original bsd|(?:4|four) clause bsd|bsd (?:4|four) clause)(?: {_L})?", "bsd 4 clause"),
    "bsd-0": ("bsd", f"(?:zero clause bsd|0 clause bsd|bsd zero clause|0bsd)(?: {_L})?", "0bsd"),
    "bsd": ("bsd", f"bsd(?: style)? {_L}", "bsd"),
    "gpl-1": ("general public", f"(?:gnu )?general public {_L} (?:version |v )1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    "gpl-2": ("general public", f"(?:gnu )?general public {_L} (?:as published by the free software foundation )?(?:either )?(?:version |v )2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    "gpl-3": ("general public", f"(?:gnu )?general public {_L} (?:as published by the free software foundation )?(?:either )?(?:version |v )3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    "gpl": ("general public", f"gnu general public {_L}", "gpl"),
    "lgpl-2": ("general public", f"(?:gnu )?library general public {_L} (?:version |v )2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    "lgpl-2.1": ("general public", f"(?:gnu )?lesser general public {_L} (?:version |v )2 1", "lgpl 2 1(?: only| or later)?"),
    "lgpl-3": ("general public", f"(?:gnu )?lesser general public {_L} (?:version |v )3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    "lgpl": ("general public", f"(?:gnu )?(?:lesser|library) general public {_L}", "lgpl"),
    "agpl-3": ("general public", f"(?:gnu )?affero general public {_L} (?:version |v )3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    "agpl": ("general public", f"(?:gnu )?affero general public {_L}", "agpl"),
    "fdl": ("free documentation", f"(?:gnu )?free documentation {_L}(?: version 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    "mpl-1": ("mozilla", f"mozilla public {_L} (?:version |v )?1 [01]", "mpl 1 [01]"),
    "mpl-2": ("mozilla", f"mozilla public {_L} (?:version |v )?2(?: 0)?", "mpl 2 0"),
    "epl-1": ("eclipse", f"eclipse public {_L} (?:version |v )?1(?: 0)?", "epl 1 0"),
    "epl-2": ("eclipse", f"eclipse public {_L} (?:version |v )?2(?: 0)?", "epl 2 0"),
    "cddl-1": ("development and distribution", f"common development and distribution {_L}(?: (?:version )?1 [01])?", "cddl 1 [01]"),
    "eupl": ("european union public", f"european union public {_L}(?: (?:version |v )?1 [012])?", "eupl 1 [012]"),
    "artistic-1": ("artistic", f"artistic {_L} (?:version )?1(?: 0)?", "artistic 1 0"),
    "artistic-2": ("artistic", f"artistic {_L} (?:version )?2(?: 0)?", "artistic 2 0"),
    "boost-1": ("boost", f"boost software {_L}(?: version 1 0)?", "bsl 1 0"),
    "zlib": ("zlib", f"(?:the )?zlib(?: libpng)? {_L}", "zlib"),
    "unlicense": ("unlicense", "(?:the )?unlicense", "unlicense"),
    "wtfpl": ("do what the", f"do what the fuck you want to public {_L}", "wtfpl"),
    "postgresql": ("postgresql", f"postgresql {_L}", "postgresql"),
    "python-2": ("python", f"python software foundation {_L}(?: version 2)?", "(?:psf|python) 2 0"),
    "ofl": ("open font", f"(?:sil )?open font {_L}(?: version 1 1)?", "ofl 1 [01]"),
    "ms-pl": ("microsoft", f"microsoft public {_L}", "ms pl"),
    "ms-rl": ("microsoft", f"microsoft reciprocal {_L}", "ms rl"),
    "busl": ("business source", f"business source {_L}(?: 1 1)?", "busl 1 1"),
    "sspl": ("server side public", f"server side public {_L}(?: version 1)?", "sspl 1 0"),
    "elastic-2": ("elastic", f"elastic {_L}(?: 2 0)?", "elastic 2 0"),
    "odbl": ("open database", f"open database {_L}(?: 1 0)?", "odbl 1 0"),
    "odc-by": ("open data commons", f"open data commons attribution {_L}", "odc by 1 0"),
    "pddl": ("public domain dedication", f"public domain dedication(?: and {_L})?", "pddl 1 0"),
    "cc0": ("cc0", f"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    "cc-by": ("creative commons", f"creative commons attribution(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by [1-4] [05]"),
    "cc-by-sa": ("creative commons", f"creative commons attribution share ?alike(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by sa(?: [1-4] [05])?"),
    "cc-by-nd": ("creative commons", f"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by nd(?: [1-4] [05])?"),
    "cc-by-nc": ("creative commons", f"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by nc(?: [1-4] [05])?"),
    "cc-by-nc-sa": ("creative commons", f"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by nc sa(?: [1-4] [05])?"),
    "cc-by-nc-nd": ("creative commons", f"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international)?(?: {_L})?", "cc by nc nd(?: [1-4] [05])?"),
}

#: label: (keyword, sentence of the license's own text or standard notice)
NOTICES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "without warranty of any kind", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "neither the name", "neither the name of .{1,60}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "apache", f"licensed under the apache {_L} version 2 0 the {_L} you may not use this file except in compliance with the {_L}"),
    ("apache-2", "apache", f"apache {_L} version 2 0 january 2004"),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public"),
    ("epl-1", "eclipse", f"made available under the terms of the eclipse public {_L} v(?:ersion )?1 0"),
    ("epl-2", "eclipse", f"made available under the terms of the eclipse public {_L} (?:v |version )?2 0"),
    ("boost-1", "boost", f"distributed under the boost software {_L} version 1 0"),
    ("zlib", "this software is provided", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("cc0", "extent possible under law", "to the extent possible under law .{1,60}? has waived all copyright"),
    ("public-domain", "public domain", "(?:released|placed|dedicated|donated) (?:in|into|to) the public domain"),
    ("mit", "without restriction", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("mit", "permission notice", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("mit", "copyright holders be liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", "otherwise to promote", "except as contained in this notice the names? of .{1,60}? shall not be used in advertising or otherwise to promote the sale"),
    ("isc", "disclaims all warranties", "the software is provided as is and (?:the author|isc|internet systems consortium) disclaims all warranties with regard to this software"),
    ("bsd", "redistributions of source", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "any express or implied warranties", "this software is provided by (?:the )?(?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    ("bsd-4", "university of california", "this product includes software developed by the university of california berkeley and its contributors"),
    ("apache-2", "unless required by applicable law", f"unless required by applicable law or agreed to in writing software distributed under the {_L} is distributed on an as is basis"),
    ("apache-2", "specific language governing", f"see the {_L} for the specific language governing permissions and limitations under the {_L}"),
    ("apache-2", "apache software foundation", f"licensed to the apache software foundation asf under one or more contributor {_L} agreements"),
    ("apache-2", "grant of copyright", f"grant of copyright {_L} subject to the terms and conditions of this {_L} each contributor hereby grants"),
    ("apache-1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl-2", "at your option", f"either version 2 of the {_L} or at your option any later version"),
    ("gpl-3", "at your option", f"either version 3 of the {_L} or at your option any later version"),
    ("gpl-2", "version 2 of the", f"(?:under the terms of )?version 2 of the (?:gnu general public )?{_L} only"),
    ("gpl", "along with this program", f"you should have received a copy of the gnu general public {_L} along with this program"),
    ("gpl", "hope that it will be useful", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "verbatim copies", f"everyone is permitted to copy and distribute verbatim copies of this {_L} document but changing it is not allowed"),
    ("gpl-2", "june 1991", f"gnu general public {_L} version 2 june 1991"),
    ("gpl-3", "june 2007", f"gnu general public {_L} version 3 29 june 2007"),
    ("gpl-classpath", "special exception", "as a special exception the copyright holders of this (?:library|program) give you permission to link"),
    ("lgpl-2.1", "february 1999", f"gnu lesser general public {_L} version 2 1 february 1999"),
    ("lgpl", "along with this library", f"you should have received a copy of the gnu (?:lesser|library) general public {_L} along with this library"),
    ("agpl-3", "november 2007", f"gnu affero general public {_L} version 3 19 november 2007"),
    ("agpl", "affero", f"you should have received a copy of the gnu affero general public {_L}"),
    ("fdl", "free documentation", f"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {_L}"),
    ("mpl-2", "the mpl was not distributed", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1", "contents of this file", f"the contents of this file are subject to the mozilla public {_L} version 1 [01]"),
    ("cddl-1", "development and distribution", f"the contents of this file are subject to the terms of the common development and distribution {_L}"),
    ("cpl-1", "common public", f"(?:the )?common public {_L}(?: v(?:ersion )?1 0)?"),
    ("ipl-1", "ibm public", f"ibm public {_L}(?: version 1 0)?"),
    ("npl-1", "netscape public", f"netscape public {_L}(?: version 1 [01])?"),
    ("artistic-1", "intent of this document", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-1", "perl itself", "under the same terms as perl itself"),
    ("artistic-1", "artistic", f"either the gnu general public {_L} .{{1,40}}? or the artistic {_L}"),
    ("boost-1", "person or organization", f"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this {_L}"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("unlicense", "anyone is free to copy", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("postgresql", "without a written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("python-2", "available to licensee", "psf is making python .{0,20}?available to licensee on an as is basis"),
    ("ofl", "font software", "this font software is licensed under the sil open font"),
    ("ofl", "reserved font name", "with reserved font names? [^ ]{1,40}"),
    ("ms-pl", "if you use the software you accept", f"if you use the software you accept this {_L}"),
    ("busl", "change date", f"change date .{{1,60}}? change {_L}"),
    ("busl", "non production use", "(?:make|making) non production use of the licensed work"),
    ("sspl", "to third parties as a service", "making the functionality of the program or modified version available to third parties as a service"),
    ("elastic-2", "hosted or managed service", "you may not provide the software to third parties as a hosted or managed service"),
    ("odbl", "open database", f"made available under the open database {_L}"),
    ("cc", "creative commons", f"this work is licensed under (?:a|the) creative commons"),
    ("cc-by", "appropriate credit", f"you must give appropriate credit provide a link to the {_L} and indicate if changes were made"),
    ("cc-by-nc", "commercial purposes", "you may not use the material for commercial purposes"),
    ("cc-by-sa", "distribute your contributions", f"you must distribute your contributions under the same {_L} as the original"),
    ("cc-by-nd", "distribute the modified material", "you may not distribute the modified material"),
    ("cc0", "associated a work with this deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", "no rights reserved", "no rights reserved"),
    ("beerware", "beer", f"(?:the )?beer ?ware {_L}|buy me a beer in return"),
    ("json", "good not evil", "the software shall be used for good not evil"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project"),
    ("ijg", "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("w3c", "obtaining using and or copying", "by obtaining using and or copying this work you the licensee agree"),
    ("afl", "academic free", f"academic free {_L}(?: version [123] [01])?"),
    ("osl", "open software licen", f"open software {_L}(?: version [123] [01])?"),
    ("qpl", "q public", f"(?:the )?q public {_L}"),
    ("ncsa", "university of illinois", f"university of illinois(?: ncsa)? open source {_L}"),
    ("php-3", "php licen", f"php {_L}(?: version)? 3(?: 0[01]?)?"),
    ("ruby", "ruby", f"(?:same terms as ruby|ruby {_L})"),
    ("vim", "vim licen", f"vim {_L}"),
    ("cecill", "cecill", f"cecill(?: [abc])?(?: {_L})?(?: (?:version |v )?[12](?: [01])?)?"),
    ("upl", "universal permissive", f"universal permissive {_L}(?: v 1 0)?"),
    ("blue-oak", "blue oak", f"blue oak model {_L}"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|free trial|perimeter|shield|strict)"),
    ("commons-clause", "commons clause", f"commons clause {_L} condition|subject to the commons clause"),
    ("rail", "responsible ai", f"(?:open )?responsible ai {_L}s?"),
    ("community", "community licen", f"community {_L} agreement"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "confidential", "confidential and proprietary"),
    ("proprietary", "may be reproduced", "no part of this (?:publication|document|work|book) may be reproduced"),
    ("proprietary", "unauthori", "unauthori[sz]ed (?:copying|reproduction|distribution|use) .{0,60}?is (?:strictly )?prohibited"),
    ("proprietary", "internal use only", "for internal use only"),
    ("proprietary", "evaluation purposes", "for evaluation purposes only"),
    ("proprietary", "end user licen", f"end user {_L} agreement"),
]

#: label: words of the license's usual address
ADDRESSES = [
    ("mit", "opensource org", "opensource org licenses mit"),
    ("apache-2", "apache org", "apache org licenses license 2 0"),
    ("gpl", "gnu org", "gnu org licenses (?:old licenses )?gpl"),
    ("lgpl", "gnu org", "gnu org licenses (?:old licenses )?lgpl"),
    ("agpl", "gnu org", "gnu org licenses agpl"),
    ("fdl", "gnu org", "gnu org licenses (?:old licenses )?fdl"),
    ("mpl-2", "mozilla org", "mozilla org (?:en us )?mpl 2 0"),
    ("bsd-2", "opensource org", "opensource org licenses bsd 2 clause"),
    ("bsd-3", "opensource org", "opensource org licenses bsd 3 clause"),
    ("epl-2", "eclipse org", "eclipse org legal epl 2 0"),
    ("boost-1", "boost org", "boost org license 1 0"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("cc0", "creativecommons org", "creativecommons org publicdomain zero"),
    ("cc-by", "creativecommons org", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa"),
    ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd"),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd"),
]


def rules() -> list[Rule]:
    """The ordered rules: base phrases, notices, then tags, grants and names of every family, then hints."""
    out = [Rule(f"base:{label}", label, 0, 1.0, phrase, phrase) for phrase, label in BASE.items()]
    out += [Rule(f"notice:{label}:{k}", label, NOTICE, 1.0, keyword, p) for k, (label, keyword, p) in enumerate(NOTICES)]
    out += [Rule(f"address:{label}:{k}", label, ADDRESS, 0.95, keyword, p) for k, (label, keyword, p) in enumerate(ADDRESSES)]
    for label, (keyword, name, tag) in FAMILIES.items():
        the = "(?:the )?" if not name.startswith("(?:the )") else ""
        out += [
            Rule(f"tag:{label}", label, TAG, 1.0, "spdx", f"spdx license identifier {tag}"),
            Rule(f"grant:{label}", label, GRANT, 0.9, keyword, f"(?:licen[cs]ed|released|distributed|available|provided|covered|published|redistributed) (?:to you )?under (?:the terms of )?(?:the conditions of )?{the}{name}"),
            Rule(f"field:{label}", label, GRANT, 0.85, "licen", f"licen[cs]es? (?:is |are |id |type |name )?{tag}"),
            Rule(f"terms:{label}", label, NAME, 0.8, keyword, f"(?:terms|conditions|provisions) of {the}{name}"),
            Rule(f"name:{label}", label, NAME, 0.6, keyword, name),
        ]
    out += [
        Rule("hint:see-file", "unknown", HINT, 0.3, "licen", "see (?:the )?(?:accompanying |included )?(?:file )?licen[cs]e(?: txt| md)?(?: file)? for (?:more )?(?:details|information|terms)"),
        Rule("hint:reference", "unknown", HINT, 0.2, "licen", "(?:licen[cs]ed under|under (?:the|this|an?) [^ ]{1,24}(?: [^ ]{1,24}){0,3} licen[cs]e)"),
        Rule("hint:version", "unknown", HINT, 0.2, "licen", "licen[cs]e version [0-9]+(?: [0-9]+)?"),
    ]
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """' word word ... ' in lower case; two spaces if there is no word."""
    return F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "), "^ | $", ""), F.lit(" "))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" ")))


_HITS = "array<struct<start:int,last:int,priority:int,rule:int>>"


def _hits(norm: Column, rule: Column) -> Column:
    """Word intervals of a rule's leftmost non-overlapping matches: what stands between the matches gives their places."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    found = F.regexp_extract_all(norm, pattern, F.lit(0))
    between = F.split(norm, pattern, -1)
    start = F.struct(F.lit(-1).alias("at"), F.array().cast(_HITS).alias("hits"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + _spaces(x["b"])
        last = first + _spaces(x["m"])
        return F.struct(last.alias("at"), F.concat(acc["hits"], F.array(F.struct(first.alias("start"), last.alias("last"), rule["priority"].alias("priority"), rule["rule"].alias("rule")))).cast(_HITS).alias("hits"))

    # word k starts after k + 1 spaces of the whole; a match neither begins nor ends with one
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    return F.aggregate(pairs, start, step, lambda acc: acc["hits"])


def _kept(hits: Column) -> Column:
    """Hits left by suppression: sorted by start, longest, strength, order; one inside an earlier one at least as strong goes."""
    order = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), (-h["last"]).alias("back"), h["priority"].alias("priority"), h["rule"].alias("rule"))))
    levels = HINT + 1
    start = F.struct(F.array_repeat(F.lit(-1), levels).alias("ends"), F.array().cast(_HITS).alias("kept"))

    def step(acc: Column, h: Column) -> Column:
        last = -h["back"]
        inside = F.exists(F.slice(acc["ends"], F.lit(1), h["priority"] + 1), lambda e: e >= last)
        ends = F.transform(acc["ends"], lambda e, i: F.when((i == h["priority"]) & (e < last), last).otherwise(e))
        hit = F.struct(h["start"].alias("start"), last.alias("last"), h["priority"].alias("priority"), h["rule"].alias("rule"))
        # a base hit always stays
        return F.struct(ends.alias("ends"), F.when(inside & (h["priority"] > 0), acc["kept"]).otherwise(F.concat(acc["kept"], F.array(hit))).cast(_HITS).alias("kept"))

    return F.aggregate(order, start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ruleset: list[Rule] | None = None) -> DataFrame:
    """(id, n_words, detections array<struct<start, last, priority, rule>>) of every row; rule is the index in the rule set."""
    ruleset = rules() if ruleset is None else ruleset
    keywords = sorted({r.keyword for r in ruleset})
    # the prefilter needs no keyword that holds another one
    least = [k for k in keywords if not any(o != k and o in k for o in keywords)]
    table_ = F.array(*(F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(k).alias("rule")) for k, r in enumerate(ruleset)))
    rows = docs.select(docs[id_col], normalised(docs[text_col].cast("string")).alias("norm"))
    norm = F.col("norm")
    any_keyword = F.lit(False)
    for k in least:
        any_keyword = any_keyword | F.contains(norm, F.lit(k))
    # each keyword is sought once; the result is a column, since a lambda would evaluate it for every rule
    found = F.when(any_keyword, F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(norm, k)))
    words = F.when(F.length(norm) <= 2, F.lit(0)).otherwise(_spaces(norm) - 1).cast("long").alias("n_words")
    rows = rows.select(id_col, "norm", words, found.alias("found"))
    hits = F.flatten(F.transform(F.filter(table_, lambda r: F.array_contains("found", r["keyword"])), lambda r: _hits(norm, r)))
    return rows.select(id_col, "n_words", F.when(F.col("found").isNotNull(), _kept(hits)).otherwise(F.array().cast(_HITS)).alias("detections"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruleset = rules()
    found = scan(table(spark, sf_dir, "documents"), ruleset=ruleset)
    labels, confidence = F.array(*(F.lit(r.label) for r in ruleset)), F.array(*(F.lit(r.confidence) for r in ruleset))
    base = F.filter("detections", lambda h: h["priority"] == 0)
    of = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.element_at(labels, h["rule"] + 1)))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["start"])).cast("long").alias("last_word"),
        of(base).alias("base_labels"),
        of(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda h: F.element_at(confidence, h["rule"] + 1))), F.lit(0.0)).cast("double").alias("score"),
    )
