"""Licence texts and notices that files are searched for."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    """A text or notice with the phrases that must stand in a file for ``label`` to be given.

    Every phrase stands in ``text``; the first time it does counts. A ``base`` template has one phrase, and every place
    of it in a file is reported.
    """

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


#: The phrases that are always reported, each within a usual notice.
BASE = (
    Template("gpl", "This work is licensed under the GNU General Public License", ("GNU General Public License",), True),
    Template("apache", "Licensed under the Apache License", ("Apache License",), True),
    Template("cc-by", "Licensed under CC BY", ("CC BY",), True),
    Template("mit", "Released under the MIT License", ("MIT License",), True),
)

#: Published licence texts, or the notices that refer to them.
TEXTS = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED""",
             ("Permission is hereby granted, free of charge", "rights to use, copy, modify, merge, publish, distribute, sublicense",
              'provided "as is"')),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE""",
             ("Permission to use, copy, modify", "with or without fee is hereby granted")),
    Template("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission.""",
             ("Redistribution and use in source and binary forms", "must retain the above copyright notice", "Neither the name of")),
    Template("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND""", ("Apache License, Version 2.0",)),
    Template("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version.""", ("GNU General Public License", "version 2")),
    Template("gpl-3.0", """This work is licensed under the GNU General Public License, version 3. This program is free software:
        you can redistribute it and/or modify it under the terms of the license as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version.""", ("GNU General Public License", "version 3")),
    Template("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation""", ("GNU Lesser General Public License",)),
    Template("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
             ("subject to the terms of the Mozilla Public License", "2.0")),
    Template("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely""",
             ("without any express or implied warranty", "including commercial applications, and to alter it and redistribute it freely")),
    Template("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software""", ("free and unencumbered software released into the public domain",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0 Creative Commons Attribution 4.0 International License", ("CC BY 4.0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0 Creative Commons Attribution-ShareAlike 4.0 International License", ("CC BY-SA 4.0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0 Creative Commons Attribution-NonCommercial 4.0 International License", ("CC BY-NC 4.0",)),
)

TEMPLATES = BASE + TEXTS
