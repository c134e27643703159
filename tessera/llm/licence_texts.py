"""Names of licences, sentences that name them, and the texts and headers that stand in files."""

from __future__ import annotations

#: Licence and the names by which works call it.
NAMES = [
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License")),
    ("MIT", ("MIT License",)),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GNU GPL v2", "GPL v2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GNU GPL v3", "GPL v3")),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "GNU LGPL v2.1", "LGPL v2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "GNU LGPL version 3", "GNU LGPL v3", "LGPL v3")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU AGPL version 3", "GNU AGPL v3", "AGPL v3")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "Simplified BSD License", "2-clause BSD license")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "New BSD License", "3-clause BSD license")),
    ("MPL-2.0", ("Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0")),
    ("EPL-2.0", ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
    ("CC-BY-SA-3.0", ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License")),
    ("CC0-1.0", ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0 License")),
    ("ISC", ("ISC License",)),
    ("Zlib", ("zlib License",)),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("Unlicense", ("Unlicense License",)),
    ("WTFPL", ("Do What The Fuck You Want To Public License", "WTFPL License")),
]

#: Sentences around a name, with and without an article.
FRAMES = (
    "{}", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under {}", "Distributed under the {}", "This work is licensed under {}", "This work is licensed under the {}",
    "This work is licensed under a {}", "This file is licensed under the {}", "This file is licensed under the {}, see LICENSE", "This project is licensed under the {}", "This project is licensed under the {}, see LICENSE for details",
    "This software is released under the {}", "This program is licensed under the {}", "Available under the {}", "License: {}", "Published under the terms of the {}",
)

_GPL_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_GPL_COPY = "You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
_GPL_HEADER = "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{mid} {version} of the License{end}"
_LATER = ", or (at your option) any later version."

_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, '
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT '
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_REST = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_REST = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR '
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
_APACHE_REST = (
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ' Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    " See the License for the specific language governing permissions and limitations under the License."
)

#: Licence and a text of it, or the header that it asks works to have.
TEXTS = [
    ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_REST),
    ("MIT", _MIT_GRANT), ("MIT", _MIT_GRANT + _MIT_REST), ("MIT", "MIT License " + _MIT_GRANT + _MIT_REST),
    ("BSD", _BSD_GRANT), ("BSD-2-Clause", _BSD_GRANT + _BSD_TWO), ("BSD-2-Clause", _BSD_GRANT + _BSD_TWO + _BSD_REST), ("BSD-3-Clause", _BSD_GRANT + _BSD_TWO + _BSD_THIRD), ("BSD-3-Clause", _BSD_GRANT + _BSD_TWO + _BSD_THIRD + _BSD_REST),
    ("BSD-3-Clause", _BSD_THIRD),
    ("ISC", _ISC_GRANT + _ISC_KEEP), ("ISC", _ISC_GRANT + _ISC_KEEP + _ISC_REST), ("0BSD", _ISC_GRANT + "."), ("0BSD", _ISC_GRANT + "." + _ISC_REST),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
]

for _licence, _name, _version in (("GPL-2.0", "General Public License", "version 2"), ("GPL-3.0", "General Public License", "version 3"), ("LGPL-2.1", "Lesser General Public License", "version 2.1"), ("LGPL-3.0", "Lesser General Public License", "version 3"), ("AGPL-3.0", "Affero General Public License", "version 3")):
    for _what in ("program", "library", "file"):
        for _mark, _mid, _end in ((":", ", either", _LATER), (";", "; either", _LATER), (":", ",", "."), (";", ";", ".")):
            _header = _GPL_HEADER.format(what=_what, mark=_mark, mid=_mid, end=_end, name=_name, version=_version)
            if (_licence, _header) not in TEXTS:
                TEXTS.append((_licence, _header))
    TEXTS.append((_licence, " ".join([_GPL_HEADER.format(what="program", mark=":", mid=", either", end=_LATER, name=_name, version=_version), _GPL_WARRANTY.format(name=_name), _GPL_COPY.format(name=_name)])))

#: Licence and template: every name in every sentence, then the texts.
TEMPLATES = [(licence, frame.format(name)) for licence, names in NAMES for name in names for frame in FRAMES] + TEXTS
