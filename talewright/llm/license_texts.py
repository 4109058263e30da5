"""Licence texts and notices as templates.

Fixed values: label and wording. `[[ ... ]]` is an optional region, `<name:n>` a replaceable one of one to n words;
punctuation and case do not count.
"""

_COPYRIGHT = "[[Copyright [[(c)]] <years:4> <holder:8> [[All rights reserved.]]]]"

_PERMISSIVE_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY <party:8> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <party:8> BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_REDISTRIBUTION = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_NO_WARRANTY = """
<program:3> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
"""

_COPY = "[[You should have received a copy of the {0} along with <program:3>. If not, see [[https]] [[http]] [[www]] gnu org licenses [[html]]]]"

TEMPLATES = (
    # short notices
    ("gpl-notice", "[[licensed under]] the GNU [[Lesser]] General Public License [[version <version:2> [[or [[at your option]] any later version]]]]"),
    ("apache-notice", "licensed under the Apache License [[version <version:2>]]"),
    ("cc-by-notice", "licensed under [[a]] [[Creative Commons]] CC BY [[NC]] [[SA]] [[ND]] <version:2>"),
    ("mit-notice", "[[released]] [[licensed]] [[distributed]] under the MIT License"),
    ("copyright-line", "Copyright [[(c)]] <year:2> <holder:4> all rights reserved"),
    # whole notices and licences
    ("mit-license", f"""
[[[[The]] MIT License [[(MIT)]]]] {_COPYRIGHT} Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE <party:6> BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("isc", f"""
[[ISC License]] {_COPYRIGHT} Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <author:4> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <author:4> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""),
    ("0bsd", f"""
[[BSD Zero Clause License]] {_COPYRIGHT} Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND <author:4> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <author:4> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""),
    ("bsd-2-clause", f"{_COPYRIGHT} {_REDISTRIBUTION} {_PERMISSIVE_DISCLAIMER}"),
    ("bsd-3-clause", f"""
{_COPYRIGHT} {_REDISTRIBUTION} [[3.]] Neither the name of <holder:10> nor the names of [[its]] [[their]] contributors may be
used to endorse or promote products derived from this software without specific prior written permission.
{_PERMISSIVE_DISCLAIMER}
"""),
    ("zlib", f"""
[[zlib License]] {_COPYRIGHT} This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
[[1.]] The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
[[2.]] Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
[[3.]] This notice may not be removed or altered from any source distribution.
"""),
    ("bsl-1.0", """
[[Boost Software License]] [[Version 1.0]] [[August 17th, 2003]] Permission is hereby granted, free of charge, to any person or
organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to
use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software,
and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a
source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("unlicense", """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("apache-2.0-header", f"""
{_COPYRIGHT} Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at [[https]] [[http]] www apache org licenses LICENSE 2.0 [[txt]]
[[html]] Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
"""),
    ("gpl-header", f"""
{_COPYRIGHT} <program:6> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version <version:1> of the License, or (at your option) any
later version. {_NO_WARRANTY} GNU General Public License for more details. {_COPY.format('GNU General Public License')}
"""),
    ("lgpl-header", f"""
{_COPYRIGHT} <program:6> is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation, either version <version:2> of the License, or (at your option)
any later version. {_NO_WARRANTY} GNU Lesser General Public License for more details. {_COPY.format('GNU Lesser General Public License')}
"""),
    ("mpl-2.0-header", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at [[https]] [[http]] [[www]] mozilla org MPL 2.0
"""),
    ("wtfpl", f"""
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE [[Version 2]] [[December 2004]] {_COPYRIGHT} Everyone is permitted to copy and
distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION [[0.]] You just DO
WHAT THE FUCK YOU WANT TO.
"""),
)
