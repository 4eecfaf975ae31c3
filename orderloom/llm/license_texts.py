"""Public licence texts and file headers.  Fixed values: the wording is that
of the licences themselves."""

_WARRANTY_MIT = (
    'The software is provided "as is", without warranty of any kind, express or implied, including but '
    "not limited to the warranties of merchantability, fitness for a particular purpose and "
    "noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages "
    "or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in "
    "connection with the software or the use or other dealings in the software.")

_WARRANTY_BSD = (
    'This software is provided by the copyright holders and contributors "as is" and any express or '
    "implied warranties, including, but not limited to, the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed. In no event shall the copyright holder or "
    "contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential "
    "damages (including, but not limited to, procurement of substitute goods or services; loss of use, "
    "data, or profits; or business interruption) however caused and on any theory of liability, whether "
    "in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of "
    "the use of this software, even if advised of the possibility of such damage.")

_CLAUSES_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.")

FULL_TEXTS: dict[str, list[str]] = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."],
    "BSD-2-Clause": [f"{_CLAUSES_BSD} {_WARRANTY_BSD}"],
    "BSD-3-Clause": [
        f"{_CLAUSES_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written "
        f"permission. {_WARRANTY_BSD}"],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        'in all copies. The software is provided "as is" and the author disclaims all warranties with '
        "regard to this software including all implied warranties of merchantability and fitness. In no "
        "event shall the author be liable for any special, direct, indirect, or consequential damages or "
        "any damages whatsoever resulting from loss of use, data or profits, whether in an action of "
        "contract, negligence or other tortious action, arising out of or in connection with the use or "
        "performance of this software."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. "
        f"{_WARRANTY_MIT}"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If "
        "you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and "
        "must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution."],
}
