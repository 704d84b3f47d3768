"""Known licence texts and notices. The published wording."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""

ZERO_BSD = """BSD Zero Clause License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""

BSD_HEAD = """Copyright (c) <year> <owner>. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""

BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""

BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """zlib License

Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""

#: (licence id, whole text)
TEXTS: list[tuple[str, str]] = [
    ("MIT", MIT),
    ("MIT", MIT.partition("\n\n")[2]),
    ("ISC", ISC),
    ("ISC", ISC.partition("\n\n")[2]),
    ("0BSD", ZERO_BSD),
    ("0BSD", ZERO_BSD.partition("\n\n")[2]),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("Zlib", ZLIB),
    ("Zlib", ZLIB.partition("\n\n")[2]),
    ("Apache-2.0", APACHE_NOTICE),
    ("MPL-2.0", MPL_NOTICE),
]

#: Whole texts in files, named by their ids.
FILES = Path(__file__).with_name("texts")
END = "END OF TERMS AND CONDITIONS"

#: Ids and the names that sentences call them by, besides the id itself.
NAMED: dict[str, list[str]] = {
    "MIT": ["Expat"],
    "ISC": [],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "3-Clause BSD License"],
    "Zlib": [],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache Version 2.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "Unlicense": ["The Unlicense"],
    "CC0-1.0": ["Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal"],
}
for short, name, versions in (
    ("GPL", "GNU General Public License", ["2.0", "3.0"]),
    ("LGPL", "GNU Lesser General Public License", ["2.1", "3.0"]),
    ("AGPL", "GNU Affero General Public License", ["3.0"]),
):
    for version in versions:
        numbers = [version, version.removesuffix(".0")] if version.endswith(".0") else [version]
        NAMED[f"{short}-{version}"] = [
            form.format(called, n)
            for called in (name, name.removeprefix("GNU "), f"GNU {short}", short)
            for n in numbers
            for form in ("{}, version {}", "{} v{}", "{}v{}", "{} {}")
        ]
for short, name in (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
):
    NAMED[f"CC-{short}-4.0"] = [
        f"Creative Commons {name} 4.0", f"Creative Commons {name} 4.0 International",
        f"Creative Commons {short} 4.0",
    ]

SUBJECTS = ["", *(f"This {x} is " for x in ("work", "software", "program", "project", "document", "file", "code"))]
VERBS = ["Licensed", "Released", "Distributed"]


#: Equivalent spellings, as words: the first is read as the second.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("https", "http"),
]


def in_files() -> list[tuple[str, str]]:
    """(licence id, text) of the files: as published, without the appendix or the frame, if any."""
    found = []
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        own = [text]
        if END in text:
            own.append(text[: text.index(END) + len(END)])
        if path.stem.startswith("CC-"):
            title = f"\nCreative Commons {text.splitlines()[0]} Public\nLicense\n"
            own.append(text[text.index(title) : text.rindex("====\n")].rstrip("=\n"))
        own += [x.replace("“", '"').replace("”", '"') for x in own]
        found += [(path.stem, x) for x in own]
    return found


def sentences(licence: str) -> list[str]:
    """Notices of one line that name a licence."""
    out = [f"SPDX-License-Identifier: {licence}"]
    if "GPL" in licence:
        out += [f"SPDX-License-Identifier: {licence}-{x}" for x in ("only", "or-later")]
    for name in (licence, *NAMED[licence]):
        for named in (name, f"the {name}", f"the {name} License"):
            out += [f"{x}{v.lower() if x else v} under {named}." for x in SUBJECTS for v in VERBS]
    return out


def known(more: Iterable[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """(licence id, text) of all known texts and notices; `more` comes first."""
    named = [(x, sentence) for x in NAMED for sentence in sentences(x)]
    return list(dict.fromkeys([*more, *TEXTS, *in_files(), *named]))
