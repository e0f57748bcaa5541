import os

import duckdb
import pytest

from casewatch.llm.license_scan import ALONE, RULES, SENTENCES, find_licences, oracle

from .helpers import ODD, docs

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD2 = """Copyright (c) 1991, 1993 The Regents. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
     This product includes software developed by the University.
"""
NAME = """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE.
"""
VIEWS = """
The views and conclusions contained in the software and documentation are those
of the authors and should not be interpreted as representing official policies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
GNU = """This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation{version}

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name} for more details.

You should have received a copy of the GNU {name}
along with this {what}.  If not, see <https://www.gnu.org/licenses/>."""
ISC = """Copyright (c) 2020 Me

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""


def gnu(name="General Public License", version=", either version {n} of the License, or\n(at your option) any later version.", n="3", what="program", mark=":"):
    return GNU.format(name=name, version=version.format(n=n), what=what, mark=mark)


def behind(mark, text, head="", tail=""):
    return head + "\n".join((f"{mark} {x}" if x else mark) for x in text.split("\n")) + tail


HEADERS = [
    (APACHE, "Apache-2.0"), (MIT, "MIT"), ("The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n\n" + MIT, "MIT"),
    (MIT.replace(", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software", ""), "MIT-0"),
    (BSD2 + DISCLAIMER, "BSD-2-Clause"), (BSD2 + NAME + DISCLAIMER, "BSD-3-Clause"), (BSD2 + ADVERT + NAME.replace("3.", "4.") + DISCLAIMER, "BSD-4-Clause"),
    (BSD2 + DISCLAIMER + VIEWS, "BSD-2-Clause-Views"), (MPL, "MPL-2.0"), (ISC, "ISC"), (ZLIB, "Zlib"),
    (gnu(), "GPL-3.0-or-later"), (gnu(n="2", mark=";"), "GPL-2.0-or-later"), (gnu(version="; version 2\nof the License.", mark=";"), "GPL-2.0"),
    (gnu(version=", version 3 of the License."), "GPL-3.0"), (gnu(version="; either version 2\nof the License, or (at your option) any later version.", mark=";"), "GPL-2.0-or-later"),
    (gnu("Lesser General Public License", n="2.1", what="library", mark=";"), "LGPL-2.1-or-later"), (gnu("Lesser General Public License"), "LGPL-3.0-or-later"),
    (gnu("Library General Public License", n="2", what="library", mark=";"), "LGPL-2.0-or-later"), (gnu("Affero General Public License"), "AGPL-3.0-or-later"),
]
LINES = [
    ("Foo bar.\nReleased under the MIT License.\nMore.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("a. All rights reserved. b. Released under the MIT license.", "MIT"), ("the license of her brother is at home", ""),
    ("Copyright (c) 1999 me", ""), ("Copyright (c) 1999 me. All rights reserved.", "Proprietary"), ("All rights reserved, it said", "Proprietary"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"), ("// SPDX-License-Identifier: MIT OR Apache-2.0\nint x;", "Apache-2.0,MIT"), ("/* SPDX-License-Identifier: GPL-2.0+ */", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: (BSL-1.0 OR 0BSD)", "0BSD,BSL-1.0"), ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0"), ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("SPDX-License-Identifier: LicenseRef-Mine", ""),
    ("Dual licensed under the MIT license and the Apache License 2.0.", "Apache-2.0,MIT"), ("License: BSD 3-Clause\nAuthor: me", "BSD-3-Clause"),
    ("Licensed under the GPLv3 or later.", "GPL-3.0-or-later"), ("Distributed under the terms of the GNU GPL v2", "GPL-2.0"), ("released under the terms of the GNU General Public License", "GPL"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"), ("a tool for GPL version 3 texts", ""),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", "CC-BY-NC-SA-3.0"),
    ("This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy, visit http://creativecommons.org/licenses/by/4.0/.", "CC-BY-4.0"),
    ("Creative Commons Attribution-NoDerivatives 4.0 License", "CC-BY-ND-4.0"), ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This text is in the public domain.", "Public-Domain"), ("made available under the Eclipse Public License v2.0", "EPL-2.0"), ("licensed under the Boost Software License, Version 1.0", "BSL-1.0"),
]


def found(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return [r.licences for r in find_licences(docs(spark, rows)).orderBy("doc_id").collect()]


def test_headers(spark):
    """By name, plain and behind comment marks, with CR LF too."""
    forms = [lambda t: t, lambda t: behind("#", t), lambda t: behind("//", t), lambda t: behind(" *", t, "/*\n", "\n */\n"), lambda t: behind(";;", t),
             lambda t: behind("--", t), lambda t: t.replace("\n", "\r\n"), lambda t: f"Copyright 2019 Someone. All rights reserved.\n\n{t}\n\nMore text."]
    got = iter(found(spark, [f(t) for t, _ in HEADERS for f in forms]))
    wrong = [(want, i, g) for _, want in HEADERS for i, _ in enumerate(forms) if (g := next(got)) != want]
    assert not wrong


def test_lines(spark):
    got = found(spark, [t for t, _ in LINES])
    wrong = [(t, want, g) for (t, want), g in zip(LINES, got, strict=True) if ",".join(sorted(g.split(","))) != want]
    assert not wrong


def test_several_in_one_text(spark):
    assert set(found(spark, [MIT + "\n\n" + APACHE + "\n\n" + BSD2 + NAME + DISCLAIMER])[0].split(",")) == {"MIT", "Apache-2.0", "BSD-3-Clause"}


def test_special_rules_come_before_their_parts():
    names = {n for n, _, _ in SENTENCES}
    assert len(names) == len(SENTENCES) and set(ALONE) <= names and len(set(ALONE.values())) > 60
    for i, (_, seq) in enumerate(RULES):
        assert {s.rstrip("?") for s in seq} <= names
        needed = {s for s in seq if not s.endswith("?")}
        assert not any({s for s in earlier if not s.endswith("?")} < needed for _, earlier in RULES[:i])


def test_as_sql(spark):
    texts = [t for t, _ in HEADERS + LINES] + [behind("//", t) for t, _ in HEADERS] + [MIT + "\n\n" + BSD2 + "\n\nAll rights reserved.", None, "", "the licence", "Licenceİ K gpl"]
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(1000 + i, *r[1:]) for i, r in enumerate(ODD)], clashing=True)
    got = find_licences(df).drop("kf", "kr")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(oracle()).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and any(w[4] for w in want)


def test_native_and_in_one_pass(spark):
    sf = os.path.join("/root/testdata/sf0.001", "documents.parquet")
    plan = find_licences(spark.read.parquet(sf))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas", "Exchange"))


def test_empty_table(spark):
    assert find_licences(docs(spark, [])).collect() == []
