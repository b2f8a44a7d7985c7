"""Texts of well-known licences and notices; fixed values.

Short ones stand here, standard full texts in ``license_texts.jsonl``: name, number of title paragraphs, text, as
published (Debian's ``common-licenses`` and the licences Rust ships).
"""

from __future__ import annotations

import json
import os
import re

_AS_IS = """\
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

_BSD_END = """\
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_TWO = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""

_ISC_USE = """\
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted"""

_ISC_END = """\
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_MIT_BODY = f"""\
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

{_AS_IS} IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_APACHE_NOTICE = """\
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

#: Name of the licence, with a suffix where a licence is known by several texts.
_TEXTS = {
    "0BSD": f"BSD Zero Clause License\n\n{_ISC_USE}.\n\n{_ISC_END}",
    "Apache-2.0 header": _APACHE_NOTICE,
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": f"BSD 2-Clause License\n\n{_BSD_TWO}\n\n{_BSD_END}",
    "BSD-2-Clause body": f"{_BSD_TWO}\n\n{_BSD_END}",
    "BSD-3-Clause": f"""\
BSD 3-Clause License

{_BSD_TWO}

3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.

{_BSD_END}""",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": f"""\
ISC License

{_ISC_USE}, provided that the above
copyright notice and this permission notice appear in all copies.

{_ISC_END}""",
    "MIT": f"MIT License\n\n{_MIT_BODY}",
    "MIT body": _MIT_BODY,
    "MIT notice": "Released under the MIT License.",
    "Zlib": """\
This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

KNOWN: dict[str, str] = dict(_TEXTS)

#: Other titles that short texts go by.
_TITLES = {
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "ISC": ["The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "Zlib": ["zlib License", "The zlib License"],
}
FULL = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts.jsonl")


def all_texts() -> list[tuple[str, str]]:
    """Name and text of everything known: full texts also without their title and without what follows their terms."""
    out = list(KNOWN.items())
    for name, titles in _TITLES.items():
        title, body = KNOWN[name].split("\n\n", 1) if name != "Zlib" else ("", KNOWN[name])
        out += [(name, f"{other}\n\n{body}") for other in titles]
        if title and f"{name} body" not in KNOWN:
            out.append((f"{name} body", body))
    with open(FULL, encoding="utf-8") as file:
        for row in map(json.loads, file):
            name, text = row["license"], row["text"]
            terms = re.split(r"(?<=END OF TERMS AND CONDITIONS)\s*\n", text)[0]
            for whole, suffix in ((text, ""), (terms, " terms")):
                out.append((name + suffix, whole))
                if row["title"]:
                    out.append((f"{name}{suffix} body", re.split(r"\n[^\S\n]*\n\s*", whole.lstrip("\n"), maxsplit=row["title"])[-1]))
    return out
