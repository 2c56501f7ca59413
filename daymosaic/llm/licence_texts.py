"""The licences' own words, by SPDX identifier.

Statements, headers and short licences are here, whole texts in the folder ``licences``. The terms of
AGPL-3.0 are those of GPL-3.0 with the sections that differ. EPL-2.0, CC-BY-4.0 and CC-BY-NC-4.0
have statements and headers only.
"""

import pkgutil

_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission. """


def _gnu_header(name: str, version: str) -> str:
    return f"""This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as
        published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have
        received a copy of the GNU {name} along with this program. If not, see http://www.gnu.org/licenses/."""


def _gnu(name: str, version: str, more: tuple[str, ...] = ()) -> tuple[str, ...]:
    return (f"This work is licensed under the GNU {name}, version {version}.", *more, _gnu_header(name, version))


_SHORT = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
        _gnu_header("General Public License", "3"),
    ),
    "GPL-2.0": _gnu("General Public License", "2"),
    "GPL-1.0": _gnu("General Public License", "1"),
    "LGPL-2.0": _gnu("Library General Public License", "2"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Unlicense": (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", _BSD_2 + _DISCLAIMER),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", _BSD_2 + _BSD_3 + _DISCLAIMER),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "CC0-1.0": (
        "Licensed under CC0 1.0.",
        """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this
        software to the public domain worldwide. This software is distributed without any warranty. You should have received a
        copy of the CC0 Public Domain Dedication along with this software. If not, see
        http://creativecommons.org/publicdomain/zero/1.0/.""",
    ),
    "EPL-1.0": (
        """All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public
        License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
        available at https://www.eclipse.org/legal/epl-2.0/""",
    ),
    "Zlib": ("Licensed under the zlib License.",),
}
#: identifiers with a whole text in the folder
WHOLE = ("AGPL-3.0 Apache-2.0 Artistic-1.0-Perl BSD-3-Clause BSL-1.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 "
         "LGPL-2.0 LGPL-2.1 LGPL-3.0 MPL-1.1 MPL-2.0 Unlicense Zlib").split()


def whole(name: str) -> str:
    """A licence's whole text, also out of a zipped package."""
    return pkgutil.get_data(__package__, f"licences/{name}.txt").decode("utf-8")


STATEMENTS = {name: _SHORT.get(name, ()) + ((whole(name),) if name in WHOLE else ()) for name in sorted({*_SHORT, *WHOLE})}
