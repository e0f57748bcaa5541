"""Licence recognition by sentence rules. DataFrame functions only, one projection without a shuffle.

A text loses its comment marks and is split into sentences; each is normalised and, if it holds
known licence sentences, becomes their identifiers. Ordered rules then look for sequences of
identifiers: the longer licence texts come first, and what a rule has recognised is not offered
to later ones. Identifiers that name a licence alone come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import keyed

#: A text without any of these has no known sentence.
_HINT = r"(?i)licen[sc]|copyright|permission|warrant|redistribut|rights reserved|public domain|creative ?commons|(^|[^a-z])cc[ -]by|liab|gpl"
#: Sentences of a hinted text that are worth comparing: those with a hint themselves, and those that some rule needs.
_HINT_SENTENCE = _HINT + r"|software|program|apache|mozilla|eclipse|artistic|(^|[^a-z])(mpl|mit|bsd|isc)([^a-z]|$)|name of|fuck"

# How a short notice begins; another licence may stand between it and the one looked for.
_UNDER = (r"(licen[sc]ed|released|distributed|redistributed|available|published|provided|covered|governed|offered|use) (solely )?(under|by) "
          r"(either |both )?(of )?(the )?(terms (and conditions )?of )?(either |both )?(the |an? )?(.* (and|or|and/or) (at your option )?(the |an? )?)?")
_LICENCE = "( public)?( software)? licen[sc]e"
_END = "( |$)"

#: Names of licences in short notices ("licensed under ..."), normalised (lower case, one
#: blank between words, only letters, digits and ./+- kept, any form of "v2" written "version 2").
NAMES: list[tuple[str, str]] = [
    ("MIT", r"(mit|expat)(-style)?( licen[sc]e|$| (and|or) )"),
    ("Apache-2.0", r"apache( software)?( foundation)?( licen[sc]e)?[ -](version )?2(\.0)?( licen[sc]e)?" + _END),
    ("BSD-3-Clause", rf"(bsd[ -](3|three)[ -]clause|(3|three)[ -]clause bsd|new bsd|modified bsd|revised bsd)({_LICENCE})?{_END}"),
    ("BSD-2-Clause", rf"(bsd[ -](2|two)[ -]clause|(2|two)[ -]clause bsd|simplified bsd|freebsd)({_LICENCE})?{_END}"),
    ("ISC", r"isc licen[sc]e" + _END), ("Zlib", r"zlib(/libpng)? licen[sc]e" + _END),
    ("BSL-1.0", r"boost software licen[sc]e" + _END), ("0BSD", r"(0bsd|(bsd[ -])?(0|zero)[ -]clause( bsd)?)( licen[sc]e)?" + _END),
    ("MPL-2.0", r"(mozilla public licen[sc]e|mpl)( mpl)?[ -](version )?2(\.0)?" + _END),
    ("MPL-1.1", r"(mozilla public licen[sc]e|mpl)( mpl)?[ -](version )?1\.1" + _END),
    ("EPL-2.0", r"(eclipse public licen[sc]e|epl)( epl)?[ -](version )?2(\.0)?" + _END),
    ("EPL-1.0", r"(eclipse public licen[sc]e|epl)( epl)?[ -](version )?1(\.0)?" + _END),
    ("CDDL-1.0", r"(common development and distribution licen[sc]e|cddl)( cddl)?([ -](version )?1(\.0)?)?" + _END),
    ("EUPL-1.2", r"(european union public licen[sc]e|eupl)( eupl)?[ -](version )?1\.2" + _END),
    ("Artistic-2.0", r"artistic licen[sc]e[ -](version )?2(\.0)?" + _END), ("MS-PL", r"(microsoft public licen[sc]e|ms-pl)" + _END),
    ("OFL-1.1", r"(sil )?open font licen[sc]e[ -](version )?1\.1" + _END), ("PostgreSQL", r"postgresql licen[sc]e" + _END),
    ("Python-2.0", r"(python software foundation|psf) licen[sc]e" + _END), ("WTFPL", r"(wtfpl|do what the fuck you want to public licen[sc]e)" + _END),
    ("NCSA", r"(university of illinois/)?ncsa( open source)? licen[sc]e" + _END), ("Unlicense", r"unlicense" + _END),
    ("CC0-1.0", r"(creative commons zero|creative commons cc0|cc0)([ -](version )?1(\.0)?)?( universal)?" + _END),
]

#: Public licence sentences, normalised as above.
TEXTS: list[tuple[str, str]] = [
    ("mit_title", r"^(the )?(mit|expat) licen[sc]e( mit)?$"),
    ("mit_grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .*subject to the following conditions"),
    ("mit0_grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .*permit persons to whom the software is furnished to do so$"),
    ("mit_notice", r"the above copyright notice and this permission notice( including the next paragraph)? (shall|must) be included in all copies or substantial portions of the software"),
    ("json_good", r"the software shall be used for good not evil"),
    ("as_is", r"(the|this) software is provided as[ -]is ?(without warranty of any kind express or implied|and the author disclaims all warranties|without any express or implied)"),
    ("no_liability", r"in no event (shall|will) (the )?(authors?|copyright|regents|x consortium|university|contributors).* be (held )?liable"),
    ("isc_grant", r"permission to use copy modify and/?(or)? ?distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd_grant", r"permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted$"),
    ("postgres_grant", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd_grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd_source", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd_binary", r"redistributions in binary form must reproduce the above copyright notice .*provided with the distribution"),
    ("bsd_advert", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd_product", r"this product includes software developed (by|for use)"),
    ("bsd_name", r"(neither the names? of .*|the names? of .* may not be used .*)without (specific )?prior written permission"),
    ("bsd_disclaimer", r"this software is provided by (the )?(copyright holders|authors?|regents|.* contributors).* disclaimed"),
    ("bsd_views", r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("boost_grant", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib_grant", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("apache2_title", r"^apache licen[sc]e version 2\.0( january 2004)?"),
    ("apache2_comply", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache2_copy", r"you may obtain a copy of the licen[sc]e at"),
    ("apache2_url", r"apache\.org/licenses/license-2\.0"),
    ("apache2_disclaimer", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("mpl2_form", r"this source code form is subject to the terms of the mozilla public licen[sc]e version 2\.0"),
    ("mpl2_copy", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl1_form", r"the contents of this file are subject to the mozilla public licen[sc]e version 1\.1"),
    ("epl2_form", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (version )?2\.0"),
    ("epl1_form", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (version )?1\.0"),
    ("wtfpl_title", r"do what the fuck you want to public licen[sc]e"),
    ("unlicense_text", r"this is free and unencumbered software released into the public domain"),
    ("cc0_waiver", r"(dedicated|released|placed|waived) .*(public domain|rights).* (under|by|using|through) .*(creative commons zero|cc0)"),
    ("public_domain", r"(is in|is released into|released into|is dedicated to|dedicated to|placed in|belongs to) the public domain"),
    ("gnu_free", r"^(this|.*) (program|library|software|file) is free software$"),
    ("gnu_no_warranty", r"is distributed in the hope that it will be useful but without any warranty"),
    ("gnu_copy", r"you should have received a copy of the gnu ((lesser|library|affero) )?general public licen[sc]e"),
    ("all_rights", r"all rights reserved"),
    ("copyright_line", r"copyright (c )?[0-9]{4}"),
]

#: The GNU licences, by family name and version.
_GNU = {"gpl": (r"((gnu|the) general public licen[sc]e|(gnu )?gpl)", ["1.0", "2.0", "3.0"]),
        "lgpl": (r"((gnu )?(lesser|library) general public licen[sc]e|(gnu )?lgpl)", ["2.0", "2.1", "3.0"]),
        "agpl": (r"((gnu )?affero general public licen[sc]e|(gnu )?agpl)", ["3.0"])}
#: The Creative Commons licences, by their elements and versions.
_CC_PARTS = {"nc": r"non-?commercial", "sa": r"share[ -]?alike", "nd": r"no-?(derivatives|derivs| derivative works)"}
_CC = ["nc-sa", "nc-nd", "nc", "sa", "nd", ""]
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Other licences that a file may name by their SPDX identifier.
_SPDX = ["MIT", "MIT-0", "Apache-1.1", "Apache-2.0", "BSD-2-Clause", "BSD-2-Clause-Views", "BSD-3-Clause", "BSD-4-Clause", "0BSD", "ISC", "BSL-1.0", "Zlib",
         "MPL-1.1", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CDDL-1.0", "EUPL-1.2", "Artistic-2.0", "MS-PL", "OFL-1.1", "PostgreSQL", "Python-2.0",
         "WTFPL", "NCSA", "Unlicense", "CC0-1.0", "JSON", "X11", "OpenSSL", "Vim", "AFL-3.0", "OSL-3.0", "BUSL-1.1", "MulanPSL-2.0"]


def _id(kind: str, name: str) -> str:
    return kind + "_" + "".join(c if c.isalnum() else "_" for c in name.lower())


def _literal(s: str) -> str:
    return s.lower().replace(".", r"\.").replace("+", r"\+")


def _inventory() -> tuple[list[tuple[str, list[tuple[str, str, str | None]]]], dict[str, str]]:
    """Groups (guard, [(identifier, pattern, pattern that must not fit)]), and the licence that an
    identifier names alone. Only sentences that fit a group's guard are compared with its patterns."""
    alone: dict[str, str] = {}

    def named(kind: str, name: str) -> str:
        alone[_id(kind, name)] = name
        return _id(kind, name)

    short = [(named("short", n), _UNDER + p, None) for n, p in NAMES]
    gnu = [("version_only_2", r"^(either )?version 2( of the licen[sc]e)?$", None), ("version_only_3", r"^(either )?version 3( of the licen[sc]e)?$", None),
           ("version_2_later", r"^either version 2( of the licen[sc]e)? or (at your option )?any later", None),
           ("version_3_later", r"^either version 3( of the licen[sc]e)? or (at your option )?any later", None)]
    for family, (words, versions) in _GNU.items():
        stem = rf"(^|(^| )(under|of|or|and) )(the )?{words}( [al]?gpl)?( as published by the free software foundation( inc\.?)?)?( either)?"
        any_version = rf"{stem}[ -](version )?[1-3]"
        for v in versions:
            number = "[ -](version )?" + (v[0] + r"(\.0)?" if v.endswith(".0") else _literal(v))
            later = rf"{stem}{number}( of the licen[sc]e)?[ -](or|and)[ -](at your option )?(any )?(later|newer|higher|above)"
            gnu += [(named("gnu", f"{family.upper()}-{v}-or-later"), later, None),
                    (named("gnu", f"{family.upper()}-{v}"), rf"{stem}{number}( |-only|$)", later)]
        gnu.append((named("gnu", family.upper()), rf"(under|terms of) (the )?{words}", any_version))
    cc = []
    for kind in _CC:
        parts = [p for p in kind.split("-") if p]
        longer = "attribution" + "".join(rf"[ -]{_CC_PARTS[p]}" for p in parts)
        brief = "by" + "".join(rf"[ -]{p}" for p in parts)
        for v in _CC_VERSIONS:
            n = _literal(v)
            cc.append((named("cc", "-".join(["CC-BY", *[p.upper() for p in parts], v])),
                       rf"(creative commons {longer}( cc[ -]{brief})?|cc[ -]{brief})( licen[sc]e)?[ -](version )?{n}|creativecommons\.org/licenses/{brief.replace('[ -]', '-')}/{n}", None))
    spdx = [(named("spdx", n), rf"^spdx-license-identifier (.* )?{_literal(n)}{_END}", None) for n in _SPDX]
    for family, (_, versions) in _GNU.items():
        for v in versions:
            n = _literal(f"{family} version {v}")  # as every sentence is normalised
            spdx += [(named("spdx", f"{family.upper()}-{v}"), rf"^spdx-license-identifier (.* )?{n}(-only)?{_END}", None),
                     (named("spdx", f"{family.upper()}-{v}-or-later"), rf"^spdx-license-identifier (.* )?{n}(\+|-or-later){_END}", None)]
    spdx += [(named("spdx", "-".join(["CC-BY", *[p.upper() for p in k.split("-") if p], v])),
              rf"^spdx-license-identifier (.* )?cc-by{'-' * bool(k)}{k}-{_literal(v)}{_END}", None) for k in _CC for v in _CC_VERSIONS]
    alone |= {"mit_title": "MIT", "apache2_title": "Apache-2.0", "apache2_url": "Apache-2.0", "boost_grant": "BSL-1.0", "zlib_grant": "Zlib", "mpl2_form": "MPL-2.0",
              "mpl1_form": "MPL-1.1", "epl2_form": "EPL-2.0", "epl1_form": "EPL-1.0", "wtfpl_title": "WTFPL", "unlicense_text": "Unlicense",
              "cc0_waiver": "CC0-1.0", "public_domain": "Public-Domain", "gnu_copy": "GPL"}
    texts = [(n, rf"(^| )({p})" if not p.startswith("^") else p, "free and unencumbered|cc0" if n == "public_domain" else None) for n, p in TEXTS]
    return [("^spdx-license-identifier ", spdx), (r"gpl|general public licen[sc]e|^(either )?version [23]", gnu), (r"creative ?commons|cc[ -]by", cc),
            (r" (under|by) ", [(n, rf"(^| ){p}", u) for n, p, u in short]), ("", texts)], alone


GROUPS, ALONE = _inventory()
SENTENCES = [s for _, group in GROUPS for s in group]

#: Licences by sequences of sentence identifiers, the longest and most special first.
#: In a sequence, ? marks a sentence that may be missing.
_HEAD = ["copyright_line?", "all_rights?"]
_TAIL = ["as_is?", "no_liability?"]
_GNU_TAIL = ["gnu_no_warranty?", "gnu_copy?"]
RULES: list[tuple[str, list[str]]] = [
    ("JSON", ["mit_title?", *_HEAD, "mit_grant", "mit_notice", "json_good", *_TAIL]),
    ("MIT", ["mit_title?", *_HEAD, "mit_grant", "mit_notice", *_TAIL]),
    ("MIT-0", [*_HEAD, "mit0_grant", *_TAIL]),
    ("BSD-4-Clause", [*_HEAD, "bsd_grant", "bsd_source", "bsd_binary", "bsd_advert", "bsd_product?", "bsd_name?", "bsd_disclaimer?", "no_liability?"]),
    ("BSD-3-Clause", [*_HEAD, "bsd_grant", "bsd_source", "bsd_binary", "bsd_name", "bsd_disclaimer?", "no_liability?"]),
    ("BSD-2-Clause-Views", [*_HEAD, "bsd_grant", "bsd_source", "bsd_binary", "bsd_disclaimer?", "no_liability?", "bsd_views"]),
    ("BSD-2-Clause", [*_HEAD, "bsd_grant", "bsd_source", "bsd_binary", "bsd_disclaimer?", "no_liability?"]),
    ("Apache-2.0", [*_HEAD, "short_apache_2_0", "apache2_comply", "apache2_copy?", "apache2_url?", "apache2_disclaimer?"]),
    ("ISC", [*_HEAD, "isc_grant", *_TAIL]), ("0BSD", [*_HEAD, "0bsd_grant", *_TAIL]), ("PostgreSQL", [*_HEAD, "postgres_grant", *_TAIL]),
    ("BSL-1.0", [*_HEAD, "boost_grant", *_TAIL]), ("Zlib", [*_HEAD, "as_is?", "no_liability?", "zlib_grant"]),
    ("MPL-2.0", [*_HEAD, "mpl2_form", "mpl2_copy?"]),
    ("GPL-2.0", [*_HEAD, "gnu_free?", "gnu_gpl", "version_only_2", *_GNU_TAIL]), ("GPL-3.0", [*_HEAD, "gnu_free?", "gnu_gpl", "version_only_3", *_GNU_TAIL]),
    ("GPL-2.0-or-later", [*_HEAD, "gnu_free?", "gnu_gpl", "version_2_later", *_GNU_TAIL]),
    ("GPL-3.0-or-later", [*_HEAD, "gnu_free?", "gnu_gpl", "version_3_later", *_GNU_TAIL]),
    *[(ALONE[i], [*_HEAD, "gnu_free?", i, *_GNU_TAIL]) for i, _, _ in SENTENCES if i.startswith("gnu_") and i in ALONE and i != "gnu_copy"],
]
#: Said of a text in which nothing else is recognised, but these identifiers are.
RESERVED = ("all_rights", "Proprietary")

# Before sentences are split, in order: comment marks at the start of a line go; "v2", "ver. 2" become "version 2";
# an SPDX line and a "License:" line become sentences of their own.
_MARK = r"(//+!?|/\*+!?|\*+/|\*+|#+!?|;+|--+|%+|<!--|dnl|rem|REM|\"\"\"|''')"
_CLEAN = [
    (r"\r\n?", "\n"),
    (rf"(^|\n)[ \t]*({_MARK}([ \t]+|$|\n))", "$1\x02$2"),
    (r"\x02([^ \t\n]+)[ \t]*", ""),
    (r"(^|[^A-Za-z0-9_])[Vv](er|ersion|ER|ERSION)?\.?[ \t\n]*([0-9])", "$1version $3"),
    (r"(?i)spdx-license-identifier[ \t]*:[ \t]*([^\n]*)", "\x01spdx-license-identifier $1\x01"),
    (r"(?i)(^|\n)[ \t]*licen[sc]e[ \t]*:[ \t]+([^\n ])", "$1\x01licensed under $2"),
]
# A sentence ends at . ! ? ; : before white space, at an empty line, and before a list item.
_BREAKS = r"[.!?;:][ \t\n]+|\n[ \t]*\n|\n[ \t]*(\(?[0-9a-zA-Z]\)|[-o])[ \t]+"
_BREAK = "\x01"
# Of a sentence, lower-cased.
_NORMAL = [(r"[^a-z0-9./+-]+", " "), (r"^[ ./+-]+|[ ./-]+$", ""), (r"(^|[^a-z])(l|a)?gpl[ -]?v?([0-9])", "$1$2gpl version $3"), (r"^((all|the) )?(software|code|project|work|file) licensed", "licensed")]


def rule_pattern(sequence: list[str]) -> str:
    """A rule as a pattern on ",id,id,id,"."""
    return "," + "".join(f"({s[:-1]},)?" if s.endswith("?") else f"{s}," for s in sequence)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known licence sentences of a text, in order; a line that is wrapped goes on."""
    clean = text
    for pattern, to in _CLEAN:
        clean = F.regexp_replace(clean, pattern, to)
    parts = F.split(F.regexp_replace(clean, _BREAKS, _BREAK), _BREAK)

    def normalised(s: Column) -> Column:
        s = F.lower(s)
        for pattern, to in _NORMAL:
            s = F.regexp_replace(s, pattern, to)
        return s

    none = F.array().cast("array<string>")

    def fits(s: Column, pattern: str, unless: str | None) -> Column:
        return s.rlike(pattern) & ~s.rlike(unless) if unless else s.rlike(pattern)

    def known(s: Column) -> Column:
        found = []
        for guard, group in GROUPS:
            ids = F.filter(F.array(*[F.when(fits(s, p, u), F.lit(n)) for n, p, u in group]), lambda x: x.isNotNull())
            found.append(F.when(s.rlike(guard), ids).otherwise(none) if guard else ids)
        return F.concat(*found)

    hinted = F.filter(parts, lambda s: s.rlike(_HINT_SENTENCE))
    return F.when(text.rlike(_HINT), F.flatten(F.transform(F.transform(hinted, normalised), known))).otherwise(none)


def licences(ids: Column) -> Column:
    """struct(rest, found): rules in order over the identifier sequence, each takes what it recognises; then
    identifiers that name a licence alone, in the order of the text."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rule_pattern(seq)).alias("pattern")) for name, seq in RULES])
    none = F.array().cast("array<string>")
    start = F.struct(F.concat(F.lit(","), F.array_join(ids, ","), F.lit(",")).alias("rest"), none.alias("found"))

    def apply(s: Column, r: Column) -> Column:
        hit = F.regexp_like(s["rest"], r["pattern"])
        return F.when(hit, F.struct(F.regexp_replace(s["rest"], r["pattern"], F.lit(",")).alias("rest"),
                                    F.array_union(s["found"], F.array(r["name"])).alias("found"))).otherwise(s)
    names = F.create_map(*[F.lit(x) for pair in ALONE.items() for x in pair])

    def finish(s: Column) -> Column:
        rest = F.filter(F.split(s["rest"], ","), lambda x: x != "")
        found = F.array_union(s["found"], F.filter(F.transform(rest, lambda x: F.try_element_at(names, x)), lambda x: x.isNotNull()))
        left = F.filter(rest, lambda x: F.try_element_at(names, x).isNull())
        reserved = (F.size(found) == 0) & F.array_contains(left, RESERVED[0])
        return F.struct(F.when(reserved, F.array_remove(left, RESERVED[0])).otherwise(left).alias("rest"),
                        F.when(reserved, F.array(F.lit(RESERVED[1]))).otherwise(found).alias("found"))
    return F.when(F.size(ids) == 0, F.struct(none.alias("rest"), none.alias("found"))).otherwise(F.aggregate(rules, start, apply, finish))


def find_licences(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: kf, kr, doc_id, n_sentences, sentence_ids, licences, n_left.

    n_sentences: known licence sentences of the text; sentence_ids: their identifiers in order, comma-joined;
    licences: what is recognised, each once, comma-joined: by rule, in rule order, then by single sentences, in text
    order. A version of a GNU licence without "or later" is named without a suffix. "All rights reserved" makes a text
    Proprietary only where nothing else is recognised. n_left: sentences that nothing took.
    Reads `doc_id` and `text`; other columns are ignored. A null or empty text has none; repeated rows are
    scanned once each; an empty table gives an empty result.
    """
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.select("kf", "kr", "doc_id", sentence_ids(F.col("text")).alias("ids"))
    ruled = ids.withColumn("r", licences(F.col("ids")))
    return ruled.select(
        "kf", "kr", "doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join("r.found", ",").alias("licences"), F.size("r.rest").cast("long").alias("n_left"))


def oracle() -> str:
    """The same in DuckDB SQL."""
    def text(s: str) -> str:
        quoted = "'" + s.replace("'", "''") + "'"
        for code in (1, 2):
            quoted = quoted.replace(chr(code), f"' || chr({code}) || '")
        return f"({quoted})" if "||" in quoted else quoted

    def replaced(x: str, steps: list[tuple[str, str]]) -> str:
        for pattern, to in steps:
            for i in range(1, 10):
                to = to.replace(f"${i}", f"\\{i}")
            x = f"regexp_replace({x}, {text(pattern)}, {text(to)}, 'g')"
        return x

    def fits(p: str, u: str | None) -> str:
        return f"regexp_matches(s, {text(p)})" + (f" AND NOT regexp_matches(s, {text(u)})" if u else "")

    def group(guard: str, sentences: list[tuple[str, str, str | None]]) -> str:
        ids = "[" + ", ".join(f"CASE WHEN {fits(p, u)} THEN {text(n)} END" for n, p, u in sentences) + "]"
        return f"CASE WHEN regexp_matches(s, {text(guard)}) THEN {ids} ELSE [] END" if guard else ids

    steps, last = [], "seq0"
    for i, (name, seq) in enumerate(RULES, 1):
        p = text(rule_pattern(seq))
        steps.append(f"""seq{i} AS (SELECT doc_id, ids, regexp_replace(rest, {p}, ',', 'g') AS rest,
  CASE WHEN regexp_matches(rest, {p}) AND NOT list_contains(found, {text(name)}) THEN list_append(found, {text(name)}) ELSE found END AS found FROM {last})""")
        last = f"seq{i}"
    names = "map([" + ", ".join(map(text, ALONE)) + "], [" + ", ".join(map(text, ALONE.values())) + "])"
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), part AS (
  SELECT row, i, {replaced("lower(p[i])", _NORMAL)} AS s
  FROM (SELECT row, p, unnest(range(1, len(p) + 1)) AS i
        FROM (SELECT row, string_split({replaced("text", [*_CLEAN, (_BREAKS, _BREAK)])}, chr(1)) AS p FROM doc WHERE regexp_matches(text, {text(_HINT)})))
  WHERE regexp_matches(p[i], {text(_HINT_SENTENCE)})
), known AS (
  SELECT row, i, [k for k in list_concat({", ".join(group(*g) for g in GROUPS)}) if k IS NOT NULL] AS k FROM part
), joined AS (
  SELECT row, flatten(list(k ORDER BY i)) AS ids FROM known GROUP BY row
), seq0 AS (
  SELECT doc_id, coalesce(ids, []) AS ids, ',' || array_to_string(coalesce(ids, []), ',') || ',' AS rest, CAST([] AS VARCHAR[]) AS found
  FROM doc LEFT JOIN joined USING (row)
), {", ".join(steps)}, single AS (
  SELECT doc_id, ids, found, [x for x in string_split(rest, ',') if x != ''] AS rest, {names} AS names FROM {last}
), named AS (
  SELECT doc_id, ids, [x for x in rest if names[x] IS NULL] AS rest, list_concat(found, [names[x] for x in rest if names[x] IS NOT NULL]) AS found FROM single
), once AS (
  SELECT doc_id, ids, rest, [found[i] for i in range(1, len(found) + 1) if list_position(found, found[i]) = i] AS found FROM named
), reserved AS (
  SELECT *, len(found) = 0 AND list_contains(rest, {text(RESERVED[0])}) AS r FROM once
)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  CASE WHEN r THEN {text(RESERVED[1])} ELSE coalesce(array_to_string(found, ','), '') END AS licences,
  CAST(CASE WHEN r THEN len([x for x in rest if x != {text(RESERVED[0])}]) ELSE len(rest) END AS BIGINT) AS n_left
FROM reserved
"""
