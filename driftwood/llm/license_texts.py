"""The license scan's templates: notices and terms of well-known licenses.

A notice names the license in a sentence, a header stands at the top of a
source file, and a body (terms, disclaimer) is found where the text of a
license is copied without naming it."""

# Fixed values, as the licenses' publishers word them
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                   "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                   "(at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-limits": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                         "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                         "implied. See the License for the specific language governing permissions and limitations under the "
                         "License.",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "bsd-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met",
    "bsd-conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                      "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
                      "of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                      "distribution.",
    "bsd-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                      "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                      "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
                      "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
                      "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                      "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                      "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
                      "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
               "work.",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                      "License 2.0",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                      "option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
                    "for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
                      "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
                      "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
                      "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
                      "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                       "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                       "or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                      "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
                      "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
                      "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
                      "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                  "the Software",
    "mit-notice": "This project is licensed under the MIT License",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-terms": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                       "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
            "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
            "following restrictions",
}
